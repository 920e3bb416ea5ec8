from __future__ import annotations

import glob
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from remitspark import schema as S
from remitspark import tables
from remitspark.operators import sinks, warehouse
from remitspark.operators import validate as V
from remitspark.plans import ingest as ingest_plan
from remitspark.plans.checks import CHECKS
from remitspark.plans.ingest import audit_unseen, ingest, ingest_and_load, ingest_notifications
from remitspark.session import new_work_folder
from remitspark.sources.records import literal_path
from remitspark.sources.walk import walk
from remitspark.streaming import versions
from remitspark.streaming.announced import ingest_announced_stream
from remitspark.streaming.arrivals import ingest_stream
from tests import rowwise
from tests.test_csv_files import HEADER, ROW, line
from tests.test_notifications import bus, direct
from tests.test_validate import BREAKS, GOOD


def csv_text(rows: list[dict]) -> str:
    return "\n".join([HEADER] + [",".join(r[c] or "" for c in S.REQUIRED_COLUMNS) for r in rows]) + "\n"


def sample_files() -> dict[str, bytes]:
    rnd = random.Random(3)
    files = {}
    for n in range(5):
        rows = []
        for i in range(60):
            row = GOOD | {"transaction_id": f"T{rnd.randint(0, 80)}", "transaction_ts": f"2026/0{1 + n}/{1 + i % 28}"}
            for column, value, _ in rnd.sample(BREAKS, rnd.choice([0, 0, 0, 1])):
                row[column] = value
            rows.append(row)
        files[f"in/f{n}.csv"] = csv_text(rows).encode()
    files["quoted.csv"] = (f"{HEADER}\n" + line(region='"A\n""B"" "') + "\n" + line(amount='" 1\n2 "') + "\n").encode()
    files["all bad.csv"] = f"{HEADER}\n{line(status='?')}\n".encode()
    files["none.csv"] = f"{HEADER}\n".encode()
    files["broken.csv"] = f"transaction_id\nT1\n".encode()
    return files


def put(folder, files: dict[str, bytes]) -> None:
    for name, data in files.items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def expected(files):
    """Per file: valid ids in order, rejected (raw row, reason) in order; None if unreadable."""
    out = {}
    for name, data in files.items():
        rows = rowwise.read_file(data)
        if rows is None:
            out[name] = None
            continue
        reasons = rowwise.reasons_of(rows)
        valid = [r for r, why in zip(rows, reasons) if why is None]
        out[name] = (valid, [(r, why) for r, why in zip(rows, reasons) if why])
    return out


def verify(spark, out, files, also=()):
    want, audit = expected(files), sinks.read_audit(spark, out)
    audit = {r.source_file: r for r in sinks.current(audit, audit).collect()}
    assert set(audit) == {*files, *also}
    valid, rejected = {}, {}
    for r in sinks.read_processed(spark, out).collect():
        valid.setdefault(r.source_file, []).append(r)
    for r in sinks.read_rejected(spark, out).collect():
        rejected.setdefault(r.source_file, []).append(r)
    for name, w in want.items():
        if w is None:
            assert audit[name].file_error.startswith(S.MISSING_REQUIRED_COLUMNS)
            assert (audit[name].total_valid_records, audit[name].total_rejected_records) == (0, 0)
            assert name not in valid and name not in rejected
            continue
        good, bad = w
        assert audit[name].file_error is None
        assert audit[name].total_valid_records == len(good) == len(valid.get(name, [])), name
        assert audit[name].total_rejected_records == len(bad) == len(rejected.get(name, [])), name
        assert (audit[name].processed_key is None) == (not good)
        assert (audit[name].rejected_key is None) == (not bad)
        got = sorted((r.transaction_id, r.transaction_ts, str(r.amount)) for r in valid.get(name, []))
        assert got == sorted(
            (g["transaction_id"].strip(), rowwise.ts_of(g["transaction_ts"]),
             f"{rowwise.amount_of(g['amount']):.2f}")
            for g in good
        )
        # The CSV file keeps no difference between empty and missing text.
        assert [({c: r[c] or "" for c in S.REQUIRED_COLUMNS}, r.rejection_reason) for r in rejected.get(name, [])] == [
            ({c: row[c] or "" for c in S.REQUIRED_COLUMNS}, why) for row, why in bad
        ]
    return valid


@pytest.mark.parametrize("threshold, share", [("10MB", 10_000), ("-1", 10_000), ("-1", 12), ("-1", 0)])
def test_ingest(spark, conf, monkeypatch, tmp_path, threshold, share):
    # No broadcast of whole tables: every key is heavy, then some, then none.
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    monkeypatch.setattr(tables, "HEAVY_SHARE", share)
    files = sample_files()
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    audit = ingest(spark, str(tmp_path / "raw"), out)
    assert audit.count() == len(files)
    valid = verify(spark, out, files)
    for name, rows in valid.items():
        first = rowwise.ts_of(expected(files)[name][0][0]["transaction_ts"])
        assert {(r.year, r.month, r.day) for r in rows} == {
            (str(first.year), f"{first.month:02d}", f"{first.day:02d}")
        }
    # A directory per date and run, not per source file.
    assert {r.run_id for r in audit.collect()} == {p.rsplit("=", 1)[1] for p in glob.glob(f"{out}/processed/*/*/*/*")}
    dates = {(r.year, r.month, r.day) for rows in valid.values() for r in rows}
    assert len(glob.glob(f"{out}/processed/*/*/*/*")) == len(dates)
    assert glob.glob(f"{out}/processed/**/*.snappy.parquet", recursive=True)


def test_partition_by_row_date(spark, tmp_path):
    files = sample_files()
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    ingest(spark, str(tmp_path / "raw"), out, partition_by="row")
    for rows in verify(spark, out, files).values():
        assert all((int(r.year), int(r.month), int(r.day)) == r.transaction_ts.timetuple()[:3] for r in rows)
    with pytest.raises(ValueError):
        ingest(spark, str(tmp_path / "raw"), out, partition_by="hour")


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_a_corrected_file_replaces_its_output(spark, conf, tmp_path, threshold):
    """Its rows on another date, its rejects, and its rows in the table."""
    conf("spark.sql.autoBroadcastJoinThreshold", threshold)
    files, table = sample_files(), f"corrected_{abs(int(threshold.removesuffix('MB')))}"
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    ingest_and_load(spark, str(tmp_path / "raw"), out, table=table)
    again = {"in/f0.csv": csv_text([GOOD | {"transaction_id": "NEW", "transaction_ts": "2031/05/06"}]).encode(),
             "all bad.csv": csv_text([GOOD]).encode(), "quoted.csv": csv_text([GOOD | {"status": "?"}]).encode()}
    files |= again
    put(tmp_path / "raw", again)
    audit = ingest_and_load(spark, str(tmp_path / "raw"), out, table=table, paths=[str(tmp_path / "raw" / name) for name in again])
    assert sorted((r.source_file, r.total_valid_records, r.total_rejected_records) for r in audit.collect()) == [
        ("all bad.csv", 1, 0), ("in/f0.csv", 1, 0), ("quoted.csv", 0, 1),
    ]
    want = expected(files)
    rows = sinks.read_processed(spark, out)
    assert rows.filter("source_file = 'in/f0.csv'").select("year", "transaction_id").collect() == [("2031", "NEW")]
    assert rows.count() == spark.table(table).count() == sum(len(w[0]) for w in want.values() if w)
    rejected = {r.source_file: r["count"] for r in sinks.read_rejected(spark, out).groupBy("source_file").count().collect()}
    assert rejected == {name: len(w[1]) for name, w in want.items() if w and w[1]}


def test_a_run_again_under_its_id_replaces_itself(spark, tmp_path):
    files = sample_files()
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    for _ in range(2):
        ingest(spark, str(tmp_path / "raw"), out, run_id="r1")
        verify(spark, out, files)


def test_no_paths_is_nothing(spark, tmp_path):
    put(tmp_path / "raw", {"a.csv": f"{HEADER}\n{ROW}\n".encode()})
    out = str(tmp_path / "out")
    assert ingest(spark, str(tmp_path / "raw"), out, paths=[]).collect() == []
    assert not (tmp_path / "out").exists()


def test_every_admitted_file_has_an_audit_row(spark, tmp_path):
    files = {
        "a.csv": f"{HEADER}\n{ROW}\n".encode(), "empty.csv": b"", "d/EMPTY.CSV": b"", "_u.csv": ROW.encode(), "d/.dot.Csv": b"",
        "_h/deep/er/x.csv": ROW.encode(), "_k=1/b.csv": f"{HEADER}\n{ROW}\n".encode(), "d/[x]{y}/_z.csv": b"x", "_no.txt": b"x",
    }
    put(tmp_path / "raw", files)
    want = {name for name in files if name.lower().endswith(".csv")}
    for n, paths in enumerate((None, [literal_path(str(tmp_path / "raw" / name)) for name in sorted(want)])):
        audit = {r.source_file: r.file_error for r in ingest(spark, str(tmp_path / "raw"), str(tmp_path / f"out{n}"), paths).collect()}
        assert set(audit) == want
        assert {k for k, v in audit.items() if v is None} == {"a.csv", "_k=1/b.csv"}
        assert {k for k, v in audit.items() if v == S.HIDDEN_NAME} == {"_u.csv", "d/.dot.Csv", "_h/deep/er/x.csv", "d/[x]{y}/_z.csv"}
        assert audit["empty.csv"] == audit["d/EMPTY.CSV"] == f"{S.MISSING_REQUIRED_COLUMNS}: {', '.join(S.REQUIRED_COLUMNS)}"
    only_hidden = ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out3"), [str(tmp_path / "raw" / "_u.csv")])
    assert [(r.source_file, r.file_error) for r in only_hidden.collect()] == [("_u.csv", S.HIDDEN_NAME)]


def test_files_that_the_stream_does_not_see(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    put(tmp_path / "raw", {"a.csv": f"{HEADER}\n{ROW}\n".encode(), "empty.csv": b"", "d/_u.csv": b"x"})
    assert {r.source_file for r in audit_unseen(spark, raw, out).collect()} == {"empty.csv", "d/_u.csv"}
    ingest_stream(spark, raw, out, str(tmp_path / "checkpoint")).awaitTermination()
    assert {r.source_file for r in sinks.read_audit(spark, out).collect()} == {"a.csv", "empty.csv", "d/_u.csv"}
    assert audit_unseen(spark, raw, out).collect() == []
    put(tmp_path / "raw", {"d/e.csv": b""})
    assert [r.source_file for r in audit_unseen(spark, raw, out).collect()] == ["d/e.csv"]
    assert sinks.read_processed(spark, out).count() == 1


def test_longest_field_is_an_option(spark, tmp_path):
    put(tmp_path / "raw", {"a.csv": f"{HEADER}\n{line(region='r' * 50)}\n".encode(), "b.csv": (f"{HEADER}\n" + line(region='"' + 'r\n' * 30 + '"')).encode()})
    for limit, error in ((40, S.FIELD_TOO_LARGE), (80, None)):
        audit = ingest(spark, str(tmp_path / "raw"), str(tmp_path / f"out{limit}"), max_field_chars=limit)
        assert {r.file_error for r in audit.collect()} == {error}


def test_notifications_start_the_ingest(spark, tmp_path):
    files = {"raw/a b.csv": f"{HEADER}\n{ROW}\n".encode(), "raw/c.csv": f"{HEADER}\n{line(status='?')}\n".encode(), "raw/d.csv": f"{HEADER}\n{ROW}\n".encode()}
    put(tmp_path / "landing", files)
    messages = [bus("raw/a+b.csv"), direct("raw/a+b.csv", "raw/c.csv"), bus("raw/x.txt"), bus("raw/d.csv", bucket="other"), bus("raw/c.csv")]
    log = spark.createDataFrame([(json.dumps(m),) for m in messages] + [("no json",)], "json string")
    out = str(tmp_path / "out")
    audit = ingest_notifications(spark, log, str(tmp_path / "landing"), out, bucket="landing", max_files=1)
    got = sorted((r.source_file, r.total_valid_records, r.total_rejected_records) for r in audit.collect())
    assert got == [("raw/a b.csv", 1, 0), ("raw/c.csv", 0, 1)]
    assert audit.select("run_id").distinct().count() == 2
    nothing = ingest_notifications(spark, log.filter("json = 'no json'"), str(tmp_path / "landing"), out, bucket="landing")
    assert nothing.collect() == []


def test_messages_as_a_stream_start_each_version_once(spark, tmp_path):
    """Repeats within a batch and after a restart start nothing; a new sequencer does."""
    files = {f"raw/{name}.csv": f"{HEADER}\n{ROW}\n".encode() for name in "abcde"}
    put(tmp_path / "landing", files)
    (tmp_path / "log").mkdir()
    out = str(tmp_path / "out")

    def sent(key, sequencer):
        message = bus(key)
        message["detail"]["object"]["sequencer"] = sequencer
        return message

    def run(name, messages):
        (tmp_path / "log" / name).write_text("".join(json.dumps(m) + "\n" for m in messages))
        where = (str(tmp_path / "log"), str(tmp_path / "landing"), out, str(tmp_path / "checkpoint"))
        query = ingest_announced_stream(spark, *where, bucket="landing", max_files=2)
        query.awaitTermination()
        assert query.exception() is None
        return Counter(r.source_file for r in sinks.read_audit(spark, out).collect())

    first = [sent("raw/a.csv", "1"), sent("raw/a.csv", "1"), direct("raw/b.csv", "raw/c.csv"), bus("raw/b.csv"), bus("raw/x.txt"), bus("raw/d.csv", bucket="other")]
    once = {"raw/a.csv": 1, "raw/b.csv": 1, "raw/c.csv": 1}
    assert run("1", first) == once
    assert run("2", first + ["no json"]) == once
    assert run("3", [sent("raw/a.csv", "2"), bus("raw/c.csv"), bus("raw/e.csv")]) == once | {"raw/a.csv": 2, "raw/e.csv": 1}
    assert sinks.read_processed(spark, out).groupBy("source_file").count().agg(F.max("count")).first()[0] == 1


def test_work_folder_is_left_clean(spark, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(glob.glob(f"{shared}/*"))
    put(tmp_path / "raw", {"a.csv": f"{HEADER}\n{ROW}\n".encode()})
    ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert set(glob.glob(f"{shared}/*")) == before
    folder = new_work_folder(spark, "x")
    assert folder.startswith(shared) and folder != new_work_folder(spark, "x")


def test_no_files(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "notes.txt").write_text("no")
    assert ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out")).collect() == []


def test_names_are_below_the_raw_folder(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    put(tmp_path / "raw dir" / "x", {"raw dir/x/a.csv": f"{HEADER}\n{ROW}\n".encode()})
    for n, raw in enumerate([str(tmp_path / "raw dir"), f"file://{tmp_path}/raw dir/"]):
        audit = ingest(spark, raw, str(tmp_path / f"out{n}"))
        assert [r.source_file for r in audit.collect()] == ["x/raw dir/x/a.csv"]


def test_nothing_valid_anywhere(spark, tmp_path):
    put(tmp_path / "raw", {"a.csv": f"{HEADER}\n{line(status='?')}\n".encode(), "b.csv": b"x\n1\n"})
    out = str(tmp_path / "out")
    audit = ingest_and_load(spark, str(tmp_path / "raw"), out, table="none_valid")
    assert audit.count() == 2
    assert spark.table("none_valid").count() == 0
    assert glob.glob(f"{out}/processed/**/*.parquet", recursive=True) == []


def test_load_modes(spark, tmp_path):
    files = sample_files()
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    ingest_and_load(spark, str(tmp_path / "raw"), out, table="tx_load")
    total = sum(len(w[0]) for w in expected(files).values() if w)
    assert spark.table("tx_load").count() == total
    assert spark.table("tx_load").dtypes == [(f.name, f.dataType.simpleString()) for f in S.TRANSACTIONS.fields]

    some = sinks.read_audit(spark, out).first().run_id
    plan = warehouse.runs(sinks.all_processed(spark, out), [some])._jdf.queryExecution().executedPlan().toString()
    partitions = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "run_id" in partitions and some in partitions

    more = {"late.csv": f"{HEADER}\n{ROW}\n".encode()}
    put(tmp_path / "raw", more)
    ingest(spark, str(tmp_path / "raw"), out, paths=[str(tmp_path / "raw" / "late.csv")])
    for _ in range(2):
        warehouse.load(spark, out, "tx_load", mode="incremental")
        assert spark.table("tx_load").count() == total + 1
    warehouse.load(spark, out, "tx_load", mode="append")
    assert spark.table("tx_load").count() == 2 * (total + 1)
    with pytest.raises(ValueError):
        warehouse.load(spark, out, "tx_load", mode="merge")

    tx = warehouse.transactions(spark, "tx_load")
    assert CHECKS["loaded_count"](tx).first()[0] == 2 * (total + 1)
    assert CHECKS["preview"](tx).columns == S.REQUIRED_COLUMNS
    assert [tuple(r) for r in CHECKS["table_structure"](tx).limit(2).collect()] == [
        ("transaction_id", "string", 1),
        ("transaction_ts", "timestamp_ntz", 2),
    ]


def test_a_load_is_seen_as_a_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    """Between all steps, and after a kill at each, readers see one version of every file."""
    files, table = sample_files(), "tx_step"
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    ingest_and_load(spark, str(tmp_path / "raw"), out, table=table)
    ids = lambda: sorted(r.transaction_id for r in spark.table(table).collect())
    before = ids()
    again = {"in/f0.csv": csv_text([GOOD | {"transaction_id": "NEW", "transaction_ts": "2031/05/06"}]).encode()}
    put(tmp_path / "raw", again)
    ingest(spark, str(tmp_path / "raw"), out, paths=[str(tmp_path / "raw" / "in/f0.csv")])
    seen, killed = [], []

    def step(name: str, kill: str | None):
        done = getattr(warehouse, name)

        def run(*args):
            seen.append(ids())
            if kill == f"before {name}":
                raise InterruptedError
            done(*args)
            if name != "commit":
                seen.append(ids())
            if kill == f"after {name}":
                raise InterruptedError

        return run

    steps = ("write_rows", "write_superseded", "commit")
    for kill in [f"{when} {name}" for name in steps for when in ("before", "after")][:-1]:
        with monkeypatch.context() as patch:
            for name in steps:
                patch.setattr(warehouse, name, step(name, kill))
            with pytest.raises(InterruptedError):
                warehouse.load(spark, out, table, mode="incremental")
        killed.append(ids())
    assert len(killed) == 5 and all(rows == before for rows in seen + killed)
    for _ in range(2):
        warehouse.load(spark, out, table, mode="incremental")
        want = expected(files | again)
        assert len(ids()) == sum(len(w[0]) for w in want.values() if w) and "NEW" in ids()
        assert spark.table(f"{table}_loads").select("load_id").distinct().count() == 2


def test_filters_read_some_rows_of_the_table(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    n, table = 200_000, "tx_skip"
    values = {"transaction_id": "concat('T', id)", "amount": "id * 7919 % 1000", "source_file": "'f'", "run_id": "'r'"}
    columns = [F.expr(f"CAST({values.get(x.name, 'NULL')} AS {x.dataType.simpleString()}) AS {x.name}") for x in S.TRANSACTIONS.fields]
    files = [F.expr(f"{values[name]} AS {name}") for name in ("source_file", "run_id")]
    warehouse.create_transactions(spark, table)
    warehouse.write_rows(spark.range(n).repartition(4, "id").select(*columns, *files), table, "l", F.lit("l"))
    warehouse.commit(spark.createDataFrame([("l",)], "claim string"), table, "l")

    def read(condition: str) -> tuple[int, int]:
        """Rows found, and rows that the scan gave."""
        found = spark.table(table).filter(condition)
        rows = len(found.collect())
        leaves = found._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return rows, max(scan.metrics().apply("numOutputRows").value() for scan in scans if "amount" in scan.toString())

    rows, scanned = read("amount > 949")
    assert rows == n // 20 and rows <= scanned < n // 2
    assert read("transaction_id = 'T4711'")[0] == 1 and read("transaction_id = 'T4711'")[1] < n // 2
    assert read("transaction_id = 'none'") == (0, 0)


def test_two_loads_at_once_bring_a_run_once(spark, tmp_path, monkeypatch):
    files, table = sample_files(), "tx_twice"
    put(tmp_path / "raw", files)
    out = str(tmp_path / "out")
    ingest(spark, str(tmp_path / "raw"), out)
    total = sum(len(w[0]) for w in expected(files).values() if w)
    commit, held = warehouse.commit, []
    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "commit", lambda *args: held.append(args))
        for _ in range(2):  # neither sees the other
            warehouse.load(spark, out, table, mode="incremental")
    assert spark.table(table).count() == 0
    for args in reversed(held):
        commit(*args)
        assert spark.table(table).count() == total
    assert warehouse.current_rows(spark, table).select("source_file").distinct().count() == sum(bool(w and w[0]) for w in expected(files).values())


def test_stream_equals_batch_and_restarts_where_it_stopped(spark, tmp_path):
    files = sample_files()
    put(tmp_path / "raw", files)
    (tmp_path / "raw" / "notes.txt").write_text("no")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = ingest_stream(spark, str(tmp_path / "raw"), out, checkpoint, max_files=4)
        query.awaitTermination()
        assert query.exception() is None

    run()
    verify(spark, out, files)
    assert sinks.read_audit(spark, out).select("run_id").distinct().count() == 3
    before = sorted(glob.glob(f"{out}/**/*.*", recursive=True))
    run()
    assert sorted(glob.glob(f"{out}/**/*.*", recursive=True)) == before

    more = {"in/[new] f+g%41.CSV": f"{HEADER}\n{ROW}\n".encode()}
    put(tmp_path / "raw", more)
    run()
    verify(spark, out, files | more)


def test_versions_stream_takes_files_that_are_sent_again(spark, tmp_path, monkeypatch):
    """New, changed, hidden and empty files, in chunks; restarts, and a failure after the ingest."""
    files = sample_files()
    put(tmp_path / "raw", files | {"in/_hidden.csv": b"x", "in/deep/er/none.csv": b""})
    (tmp_path / "raw" / "notes.txt").write_text("no")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run():
        query = versions.ingest_versions(spark, str(tmp_path / "raw"), out, checkpoint, max_files=4)
        query.awaitTermination()
        assert query.exception() is None

    def errors():
        audit = sinks.read_audit(spark, out)
        last = sinks.current(audit, audit).filter("file_error IS NOT NULL").collect()
        return {r.source_file: r.file_error.split(":")[0] for r in last}

    run()
    assert errors()["in/_hidden.csv"] == S.HIDDEN_NAME and errors()["in/deep/er/none.csv"] == S.MISSING_REQUIRED_COLUMNS
    verify(spark, out, files, also=("in/_hidden.csv", "in/deep/er/none.csv"))
    written = sorted(glob.glob(f"{out}/**/*.*", recursive=True))
    run()
    assert sorted(glob.glob(f"{out}/**/*.*", recursive=True)) == written

    again = {
        "in/f0.csv": csv_text([GOOD | {"transaction_id": "NEW", "transaction_ts": "2031/05/06"}]).encode(),
        "in/deep/er/none.csv": f"{HEADER}\n{ROW}\n".encode(),
        "in/[new] f+g%41.CSV": f"{HEADER}\n{ROW}\n".encode(),
    }
    put(tmp_path / "raw", again)

    def fail(*args):
        ingest(*args)
        raise InterruptedError

    with monkeypatch.context() as patch:
        patch.setattr(versions, "ingest", fail)
        with pytest.raises(Exception, match="InterruptedError"):
            run()
    run()
    assert "in/deep/er/none.csv" not in errors()
    verify(spark, out, files | again, also=("in/_hidden.csv",))
    rows = sinks.read_processed(spark, out)
    assert [r.transaction_id for r in rows.filter("source_file = 'in/f0.csv'").collect()] == ["NEW"]


def test_walk_lists_all_files(spark, tmp_path):
    names = ["a.csv", "b/c.txt", "b/.d/e.csv", "f/g/h/i j%41.csv", "_k.csv", "b/[l].csv"]
    put(tmp_path / "raw", {name: b"x" * k for k, name in enumerate(names)})
    (tmp_path / "raw" / "empty folder").mkdir()
    found = walk(spark, str(tmp_path / "raw"), str(tmp_path / "work")).collect()
    assert {r.name: r.length for r in found} == {name: k for k, name in enumerate(names)}
    assert all(r.modified == (tmp_path / "raw" / r.name).stat().st_mtime_ns for r in found)


def test_only_rows_that_may_be_repeated_are_shuffled(spark, conf, tmp_path, monkeypatch):
    """With more repeated ids than a broadcast takes, the other rows stay in the tasks that read them."""
    row = "2026-01-05T03:04:05,M1,C1,PM1,12.50,INR,SUCCESS,0,WEB,ASIA"
    ids = [f"T{n}" for n in range(2000)] + [f"T{n}" for n in range(0, 200, 5)]
    (tmp_path / "raw").mkdir()
    header = ",".join(S.REQUIRED_COLUMNS)
    (tmp_path / "raw" / "a.csv").write_text(header + "\n" + "".join(f"{i},{row}\n" for i in ids))
    stored = {}

    def counting(df, path, *more):
        table = tables.store(df, path, *more)
        stored[path.rsplit("/", 1)[-1]] = (table.count(), df.columns)
        return table

    monkeypatch.setattr(ingest_plan, "store", counting)
    conf("spark.sql.autoBroadcastJoinThreshold", "1000b")
    audit = ingest(spark, str(tmp_path / "raw"), str(tmp_path / "out")).collect()
    assert [(a.total_valid_records, a.total_rejected_records) for a in audit] == [(2000, 40)]
    raw_text = [n for n, (rows, columns) in stored.items() if "merchant_id" in columns and rows > 100]
    assert raw_text == [], "rows that cannot be repeated are written again"
    processed = sinks.read_processed(spark, str(tmp_path / "out"))
    assert sorted(r.transaction_id for r in processed.collect()) == sorted(set(ids))


def test_parts_by_repeated_ids_are_the_rows_as_marked_at_once(spark):
    """Rows without an id, with a null id and in several files, in parts or at once."""
    faults = {0: "INVALID_AMOUNT"}
    rows = [(f"f{n % 3}", n, "" if n % 7 == 0 else f"T{n % 50}", faults.get(n % 11)) for n in range(400)]
    checked = spark.createDataFrame(rows, "source_file string, row_pos long, clean_id string, fault string")
    repeated = V.first_valid(checked)
    stays, shuffled = V.mark_in_parts(checked, repeated)
    at_once = V.mark_duplicates(checked, repeated, True).select(stays.columns)
    assert sorted(map(str, stays.unionByName(shuffled).collect())) == sorted(map(str, at_once.collect()))
    assert {r.rejection_reason for r in stays.collect()} <= {None, "INVALID_AMOUNT"}
