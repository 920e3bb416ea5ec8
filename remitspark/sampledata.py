"""Payment data derived from the star-schema tables ``orders customer nation region``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from remitspark import schema as S
from remitspark.functions import iso_text

ORDERS_PER_ROUND = 524288  # eight files of 65,536 rows each
CORRECTED, CORRECTED_DAYS = 3, 31


def transactions(spark: SparkSession, sf_dir: str, with_region: bool = True) -> DataFrame:
    """One clean transaction per order. Every order has a customer, whose nation gives the region.

    Without the region only the orders are read.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    if not with_region:
        return orders.select(*_order_columns())
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    homes = customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "r_name"
    )
    joined = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(*_order_columns(), F.col("r_name").alias("region"))


def _order_columns() -> list[Column]:
    """All columns of a transaction but the region."""
    k = F.col("o_orderkey")
    seconds = ((k * 37) % 86400).cast("int")
    return [
        F.concat(F.lit("T"), k).alias("transaction_id"),
        (
            F.col("o_orderdate").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        ).alias("transaction_ts"),
        F.concat(F.lit("M"), (k * 7) % 53).alias("merchant_id"),
        F.when(k % 23 != 0, F.concat(F.lit("C"), F.col("o_custkey"))).alias("customer_id"),
        F.concat(F.lit("PM"), F.substring("o_orderpriority", 1, 1)).alias("payment_method_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(k % 3 == 0, "USD").otherwise("INR").alias("currency"),
        _pick(k % 10, {0: "FAILED", 1: "DECLINED", 2: "REFUNDED", 3: "PENDING"})
        .otherwise("SUCCESS")
        .alias("status"),
        (k % 37 == 0).alias("is_fraud_flag"),
        _pick(k % 7, {0: "MOBILE", 1: "MOBILE", 2: "WEB", 3: "WEB", 4: "POS", 5: "TABLET"}).alias(
            "device_type"
        ),
    ]


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as raw text with faults, spread over files of bounded size."""
    k = F.col("row_pos")
    fault = k % 97
    file_number = F.floor(k / ORDERS_PER_ROUND).cast("long") * 8 + k % 8
    iso = iso_text(F.col("transaction_ts"))
    rows = transactions(spark, sf_dir).withColumn(
        "row_pos", F.substring("transaction_id", 2, 20).cast("long")
    ).withColumn("iso", iso)

    def part(start: int, length: int) -> Column:
        return F.substring("iso", start, length)

    year, month, day, hour, minute = part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2)
    hour12 = F.lpad(((hour.cast("int") + 11) % 12 + 1).cast("string"), 2, "0")
    half = F.when(hour < "12", " AM").otherwise(" PM")
    ts_text = (
        F.when(k % 4 == 0, F.col("iso"))
        .when(k % 4 == 1, F.format_string("%s-%s-%s %s:%s", day, month, year, hour, minute))
        .when(k % 4 == 2, F.format_string("%s/%s/%s %s:%s%s", month, day, year, hour12, minute, half))
        .otherwise(F.format_string("%s/%s/%s", year, month, day))
    )
    return rows.select(
        F.concat(F.lit("batch_"), file_number, F.lit(".csv")).alias("source_file"),
        "row_pos",
        F.when(fault == 0, "")
        .when(fault.isin(1, 17) & (k >= 9), F.concat(F.lit("T"), k - 8))
        .otherwise(F.col("transaction_id"))
        .alias("transaction_id"),
        _pick(fault, {2: "", 3: "   ", 4: "2026-13-45T00:00:00"}).otherwise(ts_text).alias("transaction_ts"),
        _pick(fault, {11: ""}).otherwise(F.col("merchant_id")).alias("merchant_id"),
        "customer_id",
        F.when(fault != 12, F.col("payment_method_id")).alias("payment_method_id"),
        _pick(fault, {5: "", 6: "abc", 7: "0.001", 8: "10000000.01"})
        .otherwise(F.col("amount").cast("string"))
        .alias("amount"),
        F.when(fault.isin(9, 14), "EUR")
        .when(fault == 15, F.concat(F.lit(" "), F.lower("currency"), F.lit(" ")))
        .otherwise(F.col("currency"))
        .alias("currency"),
        F.when(fault == 10, "UNKNOWN")
        .when(fault == 15, F.lower("status"))
        .otherwise(F.col("status"))
        .alias("status"),
        F.when(F.col("is_fraud_flag"), "1").otherwise("0").alias("is_fraud_flag"),
        "device_type",
        _pick(fault, {13: " ", 14: ""}).otherwise(F.col("region")).alias("region"),
    )


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One arrival message per order: both envelopes, other places, other types, broken ones."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    k = F.col("k")
    name = F.concat(F.lit("day+"), k, _pick(k % 5, {0: ".CSV", 1: ".txt"}).otherwise(".csv"))
    key = F.concat(F.when(k % 7 == 0, "other/").otherwise("raw/"), name)
    bucket = F.when(k % 11 == 0, "archive").otherwise("landing")

    def thing(key: Column) -> Column:
        return F.struct(
            F.struct(bucket.alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object")
        )

    bus = F.to_json(
        F.struct(F.lit("aws.s3").alias("source"), F.lit("Object Created").alias("detail-type"), thing(key).alias("detail"))
    )
    direct = F.to_json(
        F.struct(
            F.array(
                F.struct(thing(key).alias("s3")), F.struct(thing(F.concat(key, F.lit(".csv"))).alias("s3"))
            ).alias("Records")
        )
    )
    message = (
        F.when(k % 13 == 0, '{"source":"other"}')
        .when(k % 13 == 1, "not json")
        .when(k % 2 == 0, bus)
        .otherwise(direct)
    )
    return orders.select(k.alias("message_id"), message.alias("json"))


def _pick(value: Column, choices: dict[int, str]) -> Column:
    first, *others = choices.items()
    result = F.when(value == first[0], first[1])
    for number, text in others:
        result = result.when(value == number, text)
    return result


def write_raw_files(spark: SparkSession, sf_dir: str, raw_dir: str) -> None:
    """Writes :func:`raw_transactions` as CSV: a folder ``batch=<name>`` with one file each.

    Rows of a file are in order and in one part, as the meaning of a file demands; the
    number of files grows with the data, their size does not.
    """
    (
        raw_transactions(spark, sf_dir)
        .repartition("source_file")
        .sortWithinPartitions("source_file", "row_pos")
        .select(F.col("source_file").alias("batch"), *S.REQUIRED_COLUMNS)
        .write.partitionBy("batch")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(raw_dir)
    )


def corrected_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text of the files that are sent again: without faults and on later days."""
    k = F.substring("transaction_id", 2, 20).cast("long")
    number = F.floor(k / ORDERS_PER_ROUND).cast("long") * 8 + k % 8
    later = F.col("transaction_ts") + F.make_dt_interval(F.lit(CORRECTED_DAYS))
    text = [F.col(c).cast("string").alias(c) for c in S.REQUIRED_COLUMNS if c != "transaction_ts"]
    rows = transactions(spark, sf_dir).filter(k % 8 == CORRECTED)
    return rows.select(
        F.concat(F.lit("batch_"), number, F.lit(".csv")).alias("batch"), k.alias("row_pos"), iso_text(later).alias("transaction_ts"), *text
    )


def send_corrected_files(spark: SparkSession, sf_dir: str, raw_dir: str) -> list[str]:
    """Puts corrected files in the place of those of :func:`write_raw_files`; returns their paths."""
    jvm = spark.sparkContext._jvm
    new_dir = f"{raw_dir}-corrected"
    (
        corrected_transactions(spark, sf_dir)
        .repartition("batch")
        .sortWithinPartitions("batch", "row_pos")
        .select("batch", *S.REQUIRED_COLUMNS)
        .write.partitionBy("batch")
        .option("header", True)
        .csv(new_dir)
    )
    system = jvm.org.apache.hadoop.fs.Path(raw_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    sent = []
    for status in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{new_dir}/batch=*/*.csv")):
        old = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{raw_dir}/{status.getPath().getParent().getName()}/*.csv"))[0].getPath()
        system.delete(old, False)
        system.rename(status.getPath(), old)
        sent.append(old.toString())
    return sent


def write_odd_files(spark: SparkSession, raw_dir: str) -> None:
    """Adds files that need more than a plain scan: hidden, empty, undecodable, odd headers, open quotes."""
    header, row = ",".join(S.REQUIRED_COLUMNS), "T1,2026/1/5,M1,C1,PM1,12.50,INR,SUCCESS,0,WEB,ASIA"
    swapped = [",".join(reversed(line.split(","))) for line in (header, row)]
    files = {
        "odd/empty.csv": b"",
        "odd/_under.csv": f"{header}\n{row}\n".encode(),
        "_odd/in_hidden_folder.csv": f"{header}\n{row}\n".encode(),
        "odd/.dot.csv": b"",
        "odd/lacks_region.csv": f"{header.removesuffix(',region')}\n{row}\n".encode(),
        "odd/bytes.csv": header.encode() + b"\nT1,2026/1/5,M\xff1,C1,PM1,12.50,INR,SUCCESS,0,WEB,ASIA\n",
        "odd/swapped.csv": b"\xef\xbb\xbf" + "\r\n".join(swapped).encode(),
        "odd/lines.csv": f'{header},note\n{row.replace("ASIA", chr(34) + "A" + chr(10) + "B" + chr(34))},x,y\n{row}\n'.encode(),
        "odd/shapes.csv": f"{header}\n{row.replace('T1', ' T2 ').replace('12.50', '1_2.5e1')}\n{row.replace('2026/1/5', '1-2-2026 3:4')}\n".encode(),
        "odd/open.csv": f'{header}\n{row.replace(",M1", "," + chr(34) + "M1")}\n'.encode() + f'{row.replace("C1", chr(34) * 2)}\n'.encode() * 4000,
    }
    jvm = spark.sparkContext._jvm
    system = jvm.org.apache.hadoop.fs.Path(raw_dir).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, data in files.items():
        out = system.create(jvm.org.apache.hadoop.fs.Path(f"{raw_dir}/{name}"))
        if data:
            out.write(bytearray(data))
        out.close()


def announcements(spark: SparkSession, raw_dir: str) -> DataFrame:
    """Arrival messages of the files in a folder ``raw``, in both envelopes and two buckets, some twice."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_dir).select("path")
    key = F.regexp_extract("path", "(raw/batch=[^/]+/.*)$", 1)
    number = F.regexp_extract("path", "batch_([0-9]+)", 1).cast("long")
    bucket = F.when(number % 4 == 2, "archive").otherwise("landing")
    thing = F.struct(F.struct(bucket.alias("name")).alias("bucket"), F.struct(key.alias("key")).alias("object"))
    bus = F.struct(F.lit("aws.s3").alias("source"), F.lit("Object Created").alias("detail-type"), thing.alias("detail"))
    direct = F.struct(F.array(F.struct(thing.alias("s3"))).alias("Records"))
    messages = files.select(F.when(number % 2 == 0, F.to_json(bus)).otherwise(F.to_json(direct)).alias("json"))
    return messages.union(messages.limit(3))


def batch_name(source_file: Column) -> Column:
    """The ``source_file`` of :func:`raw_transactions` for a file of :func:`write_raw_files`; others as they are."""
    batch = F.regexp_extract(source_file, "batch=([^/]+)/", 1)
    return F.when(batch == "", source_file).otherwise(batch)
