from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = (
    "row", "rank", "text_key", "size", "salt", "copies", "taken", "target", "key", "node", "kept", "score", "bucket",
    "place", "position", "removed", "gone", "site", "good", "log_ratio", "weight", "sequence_id", "length", "start",
    "component_id", "n_shingles", "toxic", "held_out", "id_text", "words", "clean_text", "payload", "digest",
)


def with_clashes(df):
    return df.withColumns({name: F.lit(name) for name in CLASHING if name not in df.columns})


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts():
    rnd = random.Random(7)
    words = ["of", "the", "And", "éa", "ñandú", "x1", "don't", "größe,", "end.", "Zug", "漢字", "a|b"] + [f"w{i}" for i in range(200)]

    def text(n: int) -> str:
        return "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", " ", "\n", "\t", "  "]) for _ in range(n))

    return [text(rnd.randint(0, 120)) for _ in range(60)]


@pytest.fixture(scope="session")
def odd_docs(spark, texts):
    """Ties, repeated rows, nulls, empty, blank and long texts, clashing names."""
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(texts)]
    rows += [(i, texts[3], "en", "s1", 5) for i in range(100, 130)]  # copies
    rows += [(200, None, None, None, None), (201, "", "en", "s0", 0), (202, " \n\t ", "en", None, 4), (203, "one", "en", "s2", 3)]
    rows += [(204, texts[5] * 60, "en", "s3", 1)]  # long
    rows += [(None, texts[7], "en", "s1", 1), (None, None, "en", "s1", None), (None, texts[8], None, "s0", 1)]
    rows += [(5, texts[5], "en", "s1", len(texts[5]))] * 3  # repeated rows
    rows += [(6, texts[9], "en", "s2", 2)]  # an id with two texts
    return with_clashes(spark.createDataFrame(rows, DOCS).repartition(3)).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], DOCS))


def rows_of(df, *names):
    return [tuple(r[n] for n in names) for r in df.select(*names).collect()]
