"""Tables that a job writes to the shared work folder and reads back.

They cut lineage, survive the loss of executors, and have a size that can be checked
before one of them is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from remitspark.session import conf_bytes

HEAVY_SHARE = 10_000
HEAVY_KEY_CHARS = 1_000
#: Words of 64 bits in the bitmap of hashed keys: 4 MB, whatever the table's size.
BITMAP_WORDS = 1 << 18


def store(df: DataFrame, path: str, unlike: tuple[str, ...] = ()) -> DataFrame:
    """``unlike`` names columns whose values hardly repeat: no dictionary of them is tried."""
    plain = {f"parquet.enable.dictionary#{name}": "false" for name in unlike}
    df.write.mode("overwrite").options(**plain).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the table's values stay under the session's broadcast threshold."""
    spark = df.sparkSession
    limit = conf_bytes(spark, "spark.sql.autoBroadcastJoinThreshold")
    if limit <= 0:
        return False
    size = F.lit(0)
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0)) + 16
        elif isinstance(field.dataType, T.ArrayType):
            size = size + F.greatest(F.size(field.name), F.lit(0)) * 8 + 32
        else:
            size = size + 16
    total = df.agg(F.sum(size).alias("bytes")).first()["bytes"] or 0
    return total <= limit


def without_match(rows: DataFrame, table: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that may have their key in ``table``, and rows that surely do not.

    A bitmap of the table's hashed keys tells, which is broadcast: it has at most
    ``BITMAP_WORDS`` rows. The more keys the table has, the fewer rows it can rule out.
    """
    at = F.pmod(F.xxhash64(*keys), F.lit(BITMAP_WORDS * 64))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    bitmap = table.select(F.shiftright(at, 6).alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    marked = rows.withColumn("word", F.shiftright(at, 6)).join(F.broadcast(bitmap), "word", "left")
    bits = F.coalesce("bits", F.lit(0).cast("long"))
    may = F.call_function("shiftright", bits, (at % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
    marked = marked.withColumn("may", may).drop("word", "bits")
    return marked.filter("may").select(*rows.columns), marked.filter("NOT may").select(*rows.columns)


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    spread: Column,
    small: bool | None = None,
    sparse: bool = False,
) -> DataFrame:
    """Left join of ``rows`` to a stored table with one row per key and its number of rows.

    A table under the broadcast threshold is broadcast. Else the rows are shuffled by key,
    apart from rows of heavy keys, those with more than a ten-thousandth of all rows. There
    are fewer than ten thousand of them, so they are broadcast at any scale; their rows get
    a shuffle key of their own, a space and ``spread``, which no key of the table looks like.

    ``sparse`` says that most rows have no match. Then ``rows`` should be a stored table: it
    is read twice, and only rows that may have a match are shuffled.
    """
    if fits_broadcast(table) if small is None else small:
        return rows.join(F.broadcast(table.drop(weight)), keys, "left")
    values = [c for c in table.columns if c not in (*keys, weight)]
    if sparse:
        may, never = without_match(rows, table, keys)
        found = lookup(may, table, keys, weight, spread, small=False)
        types = dict(table.dtypes)
        return found.unionByName(never.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in values]))
    *first, last = keys
    total = table.agg(F.sum(weight).alias("rows")).first()["rows"] or 0
    is_heavy = (F.col(weight) * HEAVY_SHARE > total) & (F.length(last) <= HEAVY_KEY_CHARS)

    heavy = table.filter(is_heavy).select(
        *keys, F.lit(True).alias("is_heavy"), *[F.col(c).alias(f"heavy_{c}") for c in values]
    )
    light = table.filter(~is_heavy).select(
        *first, F.col(last).alias("light_key"), *[F.col(c).alias(f"light_{c}") for c in values]
    )
    own_key = F.when(F.col("is_heavy"), F.concat(F.lit(" "), spread)).otherwise(F.col(last))
    joined = (
        rows.join(F.broadcast(heavy), keys, "left")
        .withColumn("light_key", own_key)
        .join(light.hint("merge"), [*first, "light_key"], "left")
    )
    found = [
        F.when(F.col("is_heavy"), F.col(f"heavy_{c}")).otherwise(F.col(f"light_{c}")).alias(c) for c in values
    ]
    return joined.select(*rows.columns, *found)
