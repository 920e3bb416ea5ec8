from __future__ import annotations

import random
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from remitspark import functions as R
from remitspark import schema as S
from tests import rowwise


def evaluate(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, c string")
    rows = df.select("i", *[c.alias(f"o{n}") for n, c in enumerate(columns)]).collect()
    return [tuple(r)[1:] for r in sorted(rows, key=lambda r: r.i)]


TIMESTAMPS = {
    datetime(2026, 1, 5, 3, 4, 5): [
        "2026-01-05T03:04:05",
        "2026-1-5T3:4:5",
        "2026-01-05T03:04:05 ",
        "2026-01-05t03:04:05",
    ],
    datetime(2026, 1, 5, 3, 4): ["05-01-2026 03:04", "5-1-2026 3:4", "05-01-2026   03:04", "05-01-2026\t03:04"],
    datetime(2026, 1, 5, 15, 4): ["1/5/2026 3:04 pm", "01/ 5/2026 3:04 PM"],
    datetime(2026, 1, 5, 0, 4): ["01/05/2026 12:04 AM"],
    datetime(2026, 1, 5, 12, 4): ["01/05/2026 12:04 PM"],
    datetime(2026, 1, 5): ["2026/1/5"],
    datetime(1, 1, 1): ["0001/01/01"],
    datetime(9999, 12, 31): ["9999/12/31"],
    None: [
        None,
        "",
        "   ",
        "2026-01-05T03:04:60",
        "2026-01-05T03:04:05.123",
        "2026-01-05T03:04:05Z",
        "2026-01-05 03:04:05",
        "05-01-26 03:04",
        "01/05/2026 13:04 PM",
        "01/05/2026 00:04 AM",
        "1/5/2026 3:04PM",
        "2026/02/30",
        "0000/01/01",
        "31/01/2026 03:04 PM",
        "005-1-2026 3:4",
        "+12026/1/5",
        "01/\t5/2026 3:04 PM",
    ],
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamp_table(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    cases = [(text, want) for want, texts in TIMESTAMPS.items() for text in texts]
    cases.append(("2026-03-08T02:30:00", datetime(2026, 3, 8, 2, 30)))  # no such time in New York
    got = evaluate(spark, [t for t, _ in cases], R.parse_timestamp(F.col("c")))
    assert [(t, g[0]) for (t, _), g in zip(cases, got)] == cases


def mutated(seeds: list[str], alphabet: str, count: int, seed: int) -> list[str]:
    rnd = random.Random(seed)
    out = []
    for _ in range(count):
        text = list(rnd.choice(seeds))
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, len(text))
            if rnd.random() < 0.4 and text:
                del text[min(at, len(text) - 1)]
            elif rnd.random() < 0.5 and text:
                text[min(at, len(text) - 1)] = rnd.choice(alphabet)
            else:
                text.insert(at, rnd.choice(alphabet))
        out.append("".join(text))
    return out


def test_timestamps_equal_strptime(spark):
    seeds = [t for texts in TIMESTAMPS.values() for t in texts if t]
    seeds += ["29-02-2024 23:59", "12/31/1999 11:59 pm", "2024/2/29", "2023-02-29T00:00:00"]
    texts = mutated(seeds, "0123456789-/: TtaApPmM\t\x1c ", 12000, 7)
    got = evaluate(spark, texts, R.parse_timestamp(F.col("c")))
    want = [rowwise.ts_of(t) for t in texts]
    wrong = [(t, g[0], w) for t, g, w in zip(texts, got, want) if g[0] != (None if isinstance(w, str) else w)]
    assert wrong == []
    assert sum(not isinstance(w, str) for w in want) > 1000


VALID = ["12.5", " 12.5 ", "+5", ".5", "5.", "1e5", "1E-2", "1_000", "_1__0_", "0.01", "10000000.00", "9999999." + "9" * 40, "0.01" + "0" * 40 + "1"]
AMOUNTS = {
    None: VALID,
    S.EMPTY_AMOUNT: [None, "", "   ", "\t "],
    S.INVALID_AMOUNT: ["1,000", "$5", "0x10", "--1", "5d", "5f", "abc", "NaN", "sNaN", "_", "1 0", ".", "e5", "1e",
        "1e1000000000000000000", "0E+01000000000000000000", "1e-2000000000000000000", "0e-90000000000000000000"],
    S.AMOUNT_OUT_OF_RANGE: [
        "0",
        "-1",
        "0.005",
        "0.009999",
        "0.0099999999999999999999999",
        "0.00999999999999999999999999999999999999",
        "10000000.001",
        "10000000." + "0" * 40 + "1",
        "1e400",
        "1e-400",
        "1e-999999999",
        "1e999999999",
        "1e999999999999999999",
        "1e-1999999999999999997",
        "1e-1000000000000000000",
        "0e0000009999999",
        "Infinity",
        "-Infinity",
        "inf",
    ],
}


def amounts(spark, texts):
    text = R.clean(F.col("c"))
    literal = R.literal_of(text)
    return evaluate(
        spark, texts, R.amount_fault(text, literal, R.parse_amount(F.col("c"))), R.stored_amount(literal)
    )


def test_amount_table(spark):
    cases = [(text, want) for want, texts in AMOUNTS.items() for text in texts]
    got = amounts(spark, [t for t, _ in cases])
    assert [(t, g[0]) for (t, _), g in zip(cases, got)] == cases


def test_amounts_equal_decimal(spark):
    seeds = [t for texts in AMOUNTS.values() for t in texts if t] + ["9999999.995", "1e7", "10000000"]
    # Python's limit for exponents moves with the digits in front, by as much as a text is long.
    texts = [t for t in mutated(seeds, "0123456789.-+eE_ dinfa", 6000, 11) if not re.search("[eE][+-]?0*[1-9][0-9_]{17,18}$", t.strip())]
    got = amounts(spark, texts)
    want = [rowwise.amount_of(t) for t in texts]
    wrong = [
        (t, g, w)
        for t, g, w in zip(texts, got, want)
        if g[0] != (w if isinstance(w, str) else None)
    ]
    assert wrong == []
    assert sum(not isinstance(w, str) for w in want) > 1000


def test_stored_amount_is_rounded_once(spark):
    texts = ["0.015", "2.675", "1.004" + "9" * 40, "1_000.5", "1e3"]
    assert [str(g[1]) for g in amounts(spark, texts)] == ["0.02", "2.68", "1.00", "1000.50", "1000.00"]


def test_text_functions(spark):
    space = "　 \x1f\xa0 "
    texts = [None, "", space, f"{space}a b{space}", "ınr", "ſuccess ", "~", "~ ", " ~~", "!", "é\x85", "a\u2003", "日本"]
    texts += [w + "a" + v for w in "\t \x1c\x85\u3000a~!" for v in "\n \x1f\xa0\u2028z~!"]
    c = F.col("c")
    got = evaluate(spark, texts, R.clean(c), R.clean_upper(c), R.blank_to_null(c))
    want = [((t or "").strip(), (t or "").strip().upper(), (t or "").strip() or None) for t in texts]
    assert got == want


def test_flag(spark):
    texts = ["1", " 1 ", "0", "true", "TRUE", "1.0", "", None]
    assert [g[0] for g in evaluate(spark, texts, R.flag(F.col("c")))] == [True, True] + [False] * 6


def test_output_names(spark):
    texts = ["raw/a/x.csv", "X.CSV", "a.csv.csv"]
    day = F.lit("2026-01-05").cast("date")
    got = evaluate(spark, texts, R.processed_key(F.col("c"), day), R.rejected_key(F.col("c")))
    head = "processed/year=2026/month=01/day=05/"
    assert got == [
        (head + "x.parquet", "rejected/x_rejected.csv"),
        (head + "X.CSV", "rejected/X.CSV"),
        (head + "a.parquet.parquet", "rejected/a_rejected.csv_rejected.csv"),
    ]


def test_iso_text(spark):
    got = evaluate(spark, ["05-01-2026 03:04"], R.iso_text(R.parse_timestamp(F.col("c"))))
    assert got == [("2026-01-05T03:04:00",)]
