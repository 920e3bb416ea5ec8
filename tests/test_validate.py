from __future__ import annotations

import random

from pyspark.sql import functions as F

from remitspark import schema as S
from remitspark.operators import audit as A
from remitspark.operators import validate as V
from tests import rowwise

GOOD = {
    "transaction_id": "T1",
    "transaction_ts": "2026-01-05T03:04:05",
    "merchant_id": "M1",
    "customer_id": "C1",
    "payment_method_id": "PM1",
    "amount": "12.50",
    "currency": "INR",
    "status": "SUCCESS",
    "is_fraud_flag": "0",
    "device_type": "WEB",
    "region": "ASIA",
}

# One way to break each rule, in rule order. The duplicate needs an earlier valid row.
BREAKS = [
    ("transaction_id", " ", S.MISSING_TRANSACTION_ID),
    ("transaction_id", " SEEN ", S.DUPLICATE_TRANSACTION_ID),
    ("transaction_ts", "", S.EMPTY_TIMESTAMP),
    ("transaction_ts", "  ", S.INVALID_TIMESTAMP),
    ("amount", " ", S.EMPTY_AMOUNT),
    ("amount", "abc", S.INVALID_AMOUNT),
    ("amount", "0", S.AMOUNT_OUT_OF_RANGE),
    ("currency", "EUR", S.INVALID_CURRENCY),
    ("status", None, S.INVALID_STATUS),
    ("merchant_id", "\t", S.MISSING_MERCHANT_ID),
    ("payment_method_id", None, S.MISSING_PAYMENT_METHOD_ID),
    ("region", "", S.MISSING_REGION),
]

RAW = "source_file string, row_pos bigint, " + ", ".join(f"{c} string" for c in S.REQUIRED_COLUMNS)


def raw_frame(spark, files: dict[str, list[dict]], parts: int = 3):
    rows = [
        (name, 10 * i, *[row.get(c) for c in S.REQUIRED_COLUMNS])
        for name, file_rows in files.items()
        for i, row in enumerate(file_rows)
    ]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, RAW).repartition(parts)


def reasons(spark, files):
    out = {name: [None] * len(rows) for name, rows in files.items()}
    for r in V.annotate(raw_frame(spark, files)).select("source_file", "row_pos", "rejection_reason").collect():
        out[r.source_file][r.row_pos // 10] = r.rejection_reason
    return out


def test_each_rule_and_every_pair_in_order(spark):
    rows, want = [GOOD | {"transaction_id": "SEEN"}], [None]
    for i, (column, value, reason) in enumerate(BREAKS):
        rows.append(GOOD | {"transaction_id": f"A{i}", column: value})
        want.append(reason)
        for j, (other, bad, later) in enumerate(BREAKS[i + 1 :]):
            if other != column:
                rows.append(GOOD | {"transaction_id": f"B{i}.{j}", other: bad, column: value})
                want.append(reason)
    assert reasons(spark, {"f": rows}) == {"f": want}


def test_duplicates_follow_the_first_valid_row(spark):
    bad = {"currency": "EUR"}
    files = {
        "a": [
            GOOD | bad,  # before the first valid row: keeps its own reason
            GOOD | {"transaction_id": " T1 "},
            GOOD | bad,  # after it: a duplicate, whatever else is wrong
            GOOD,
            GOOD | {"transaction_id": "t1"},  # case matters
        ],
        "b": [GOOD],  # another file, another scope
        "c": [GOOD | bad, GOOD | bad],  # never valid, never a duplicate
        "d": [GOOD | {"transaction_id": ""}, GOOD | {"transaction_id": None}],
    }
    dup = S.DUPLICATE_TRANSACTION_ID
    assert reasons(spark, files) == {
        "a": [S.INVALID_CURRENCY, None, dup, dup, None],
        "b": [None],
        "c": [S.INVALID_CURRENCY] * 2,
        "d": [S.MISSING_TRANSACTION_ID] * 2,
    }


def random_row(rnd: random.Random, ids: int) -> dict:
    row = GOOD | {"transaction_id": rnd.choice(["", " "] + [f"T{i}" for i in range(ids)])}
    for column, value, _ in rnd.sample(BREAKS[2:], rnd.choice([0, 0, 0, 1, 2])):
        row[column] = value
    return row


def test_random_files_equal_the_row_loop(spark):
    rnd = random.Random(5)
    files = {f"f{n}": [random_row(rnd, 12) for _ in range(rnd.randint(1, 120))] for n in range(6)}
    assert reasons(spark, files) == {name: rowwise.reasons_of(rows) for name, rows in files.items()}


def test_one_hot_id_and_one_hot_file(spark, conf):
    # Everything shuffled, nothing broadcast, and skewed join partitions cut.
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4096")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4096")
    rnd = random.Random(6)
    hot = [GOOD | {"transaction_id": "HOT"} if i % 3 else random_row(rnd, 900) for i in range(3000)]
    files = {"hot": hot, "cold": [random_row(rnd, 50) for _ in range(100)]}
    annotated = V.annotate(raw_frame(spark, files, parts=12)).select("source_file", "row_pos", "rejection_reason")
    got = {name: [None] * len(rows) for name, rows in files.items()}
    for r in annotated.collect():
        got[r.source_file][r.row_pos // 10] = r.rejection_reason
    assert got == {name: rowwise.reasons_of(rows) for name, rows in files.items()}
    assert "skew=true" in annotated._jdf.queryExecution().executedPlan().toString()


def test_valid_rows_are_normalised_and_rejected_rows_untouched(spark):
    odd = GOOD | {"transaction_id": " T9\t", "currency": " inr ", "status": "refunded", "customer_id": " ",
                  "device_type": None, "is_fraud_flag": " 1 ", "region": " EU ", "amount": " 1_0.005 "}
    bad = odd | {"amount": " x "}
    annotated = V.annotate(raw_frame(spark, {"f": [odd, bad | {"transaction_id": "T8"}]}))
    [valid] = V.valid_rows(annotated).collect()
    assert (valid.transaction_id, valid.currency, valid.status) == ("T9", "INR", "REFUNDED")
    assert (valid.customer_id, valid.device_type, valid.is_fraud_flag, valid.region) == (None, None, True, "EU")
    assert str(valid.amount) == "10.01"
    [rejected] = V.rejected_rows(annotated).collect()
    assert {c: rejected[c] for c in S.REQUIRED_COLUMNS} == bad | {"transaction_id": "T8"}
    assert rejected.rejection_reason == S.INVALID_AMOUNT


def test_valid_row_types(spark):
    valid = V.valid_rows(V.annotate(raw_frame(spark, {"f": [GOOD]})))
    got = [(f.name, f.dataType) for f in valid.schema.fields][:11]
    assert got == [(f.name, f.dataType) for f in S.TRANSACTIONS.fields]


def test_audit_and_partition_date(spark):
    files = {
        "a.csv": [
            GOOD | {"transaction_ts": "2026/02/03", "currency": "EUR"},
            GOOD | {"transaction_ts": "2026/03/04"},
            GOOD | {"transaction_id": "T2"},
        ],
        "b.csv": [GOOD | {"region": ""}],
    }
    summary = A.file_summary(V.annotate(raw_frame(spark, files)))
    rows = [tuple(r) for r in A.audit_rows(summary).orderBy("source_file").collect()]
    assert rows == [
        ("a.csv", 2, 1, "processed/year=2026/month=03/day=04/a.parquet", "rejected/a_rejected.csv"),
        ("b.csv", 0, 1, None, "rejected/b_rejected.csv"),
    ]
    assert [(r[0], str(r[1])) for r in A.partition_dates(summary).collect()] == [("a.csv", "2026-03-04")]


def test_ids_are_aggregated_before_the_shuffle(spark):
    plan = V.first_valid(V.check_rows(raw_frame(spark, {"f": [GOOD]})))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("HashAggregate") == 2 and "SortAggregate" not in physical


def test_rules_run_without_python_or_shuffle(spark):
    checked = V.check_rows(spark.createDataFrame([], RAW))
    physical = checked._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in physical and "Exchange" not in physical


def test_reason_counts(spark):
    rnd = random.Random(8)
    rows = [random_row(rnd, 30) for _ in range(200)]
    annotated = V.annotate(raw_frame(spark, {"f": rows}))
    got = {r.rejection_reason: r["count"] for r in annotated.groupBy("rejection_reason").count().collect()}
    want: dict = {}
    for reason in rowwise.reasons_of(rows):
        want[reason] = want.get(reason, 0) + 1
    assert got == want
    assert annotated.filter(F.col("rejection_reason").isNull()).count() == V.valid_rows(annotated).count()
