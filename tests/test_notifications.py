from __future__ import annotations

import json
from urllib.parse import unquote_plus

from pyspark.sql import functions as F

from remitspark.sources import notifications as N


def bus(key, bucket="landing", **top):
    return {"source": "aws.s3", "detail-type": "Object Created",
            "detail": {"bucket": {"name": bucket}, "object": {"key": key}}} | top


def direct(*keys):
    return {"Records": [{"s3": {"bucket": {"name": "landing"}, "object": {"key": k}}} for k in keys]}


BAD = (None, None, N.INVALID)

CASES = [
    (bus("raw/a.csv"), [("landing", "raw/a.csv", N.ACCEPTED, None)]),
    (bus("raw/a+b%20c.csv"), [("landing", "raw/a b c.csv", N.ACCEPTED, None)]),
    (bus("raw/X.CSV"), [("landing", "raw/X.CSV", N.ACCEPTED, None)]),
    (bus("raw/notes.txt"), [("landing", "raw/notes.txt", N.IGNORED, None)]),
    (bus("processed/a.csv"), [("landing", "processed/a.csv", N.NOT_MATCHED, None)]),
    (bus("raw/a.csv", bucket="other"), [("other", "raw/a.csv", N.NOT_MATCHED, None)]),
    (direct("raw/a.csv"), [("landing", "raw/a.csv", N.ACCEPTED, None)]),
    (direct("raw/a.csv", "x.txt"), [("landing", "raw/a.csv", N.ACCEPTED, None), ("landing", "x.txt", N.IGNORED, None)]),
    (direct(), [(*BAD, N.INVALID)]),
    (bus("raw/a.csv", **{"detail-type": "Object Deleted"}), [(*BAD, N.UNSUPPORTED)]),
    (bus("raw/a.csv", **{"detail-type": "x"}) | direct("b.csv"), [("landing", "b.csv", N.ACCEPTED, None)]),
    (bus("raw/a.csv", detail={}), [(*BAD, N.INVALID)]),
    (bus("raw/a.csv", detail=None), [(*BAD, N.INVALID)]),
    ({"Records": None}, [(*BAD, N.INVALID)]),
    ({"hello": 1}, [(*BAD, N.UNSUPPORTED)]),
    ("not json", [(*BAD, N.UNSUPPORTED)]),
    ([1], [(*BAD, N.UNSUPPORTED)]),
]


def test_routes(spark):
    rows = [(i, m if isinstance(m, str) else json.dumps(m)) for i, (m, _) in enumerate(CASES)]
    log = spark.createDataFrame(rows, "i int, json string")
    got: dict[int, list] = {}
    for r in N.route_notifications(log, bucket="landing").collect():
        got.setdefault(r.i, []).append((r.bucket, r.key, r.status, r.error))
    assert [sorted(got[i], key=str) for i in range(len(CASES))] == [sorted(w, key=str) for _, w in CASES]


def test_key_decoding(spark):
    keys = ["a+b", "%41%zz+", "100%", "%", "%e4%bd%a0.csv", "%ff", "a%2Bb", "plain", "%%41", "%4"]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", N.decode_key(F.col("k")).alias("d"))
    assert {r.k: r.d for r in df.collect()} == {k: unquote_plus(k) for k in keys}
