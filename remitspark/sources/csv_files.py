"""Raw CSV scan: admission, header contract, and binding of values by each file's header."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from remitspark import schema as S
from remitspark.functions import is_csv
from remitspark.session import new_work_folder, qualified
from remitspark.sources import csv_text as C
from remitspark.sources import records as L
from remitspark.tables import lookup, store

OPEN = "OPEN"
FEW_FILES = 1000
#: Columns of parsed and checked rows whose values hardly repeat.
UNLIKE = ("row_pos", "transaction_id", "transaction_ts", "customer_id", "amount", "clean_id", "parsed_ts", "parsed_amount")


def admit(paths: DataFrame) -> DataFrame:
    """Keeps rows whose ``path`` names a CSV file, in any letter case."""
    return paths.filter(is_csv(F.col("path")))


def check_header(headers: DataFrame) -> DataFrame:
    """Replaces ``header`` (an array of names) by ``missing`` and ``positions``.

    ``missing`` lists required names that the header lacks; ``positions`` holds, for each
    required name in order, where its value stands. A repeated name counts where it stands last.
    """
    header = F.col("header")

    def last_position(name: str) -> Column:
        return (F.size(header) - F.array_position(F.reverse(header), name)).cast("int")

    required = F.array(*[F.lit(c) for c in S.REQUIRED_COLUMNS])
    return headers.withColumns(
        {
            "missing": F.array_except(required, header),
            "positions": F.array(*[last_position(c) for c in S.REQUIRED_COLUMNS]),
        }
    ).drop("header")


def read_raw(
    spark: SparkSession,
    raw_dir: str,
    paths: list[str] | None = None,
    folder: str | None = None,
    derive: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    max_field_chars: int = S.MAX_FIELD_CHARS,
) -> tuple[DataFrame, DataFrame]:
    """Reads every admitted file below ``raw_dir``, or only ``paths``.

    Returns ``rows`` (``source_file, row_pos`` and the 11 text columns, passed through
    ``derive``) and ``files`` (``source_file, file_error``). Both are tables in the shared
    work folder: positions in a file depend on how the scan is cut, so they are fixed by
    one scan and never computed twice. Files with a ``file_error`` have no rows. The header
    is the first row of its file in ``rows``; it never passes validation, and
    :func:`without_headers` removes it.

    Files that a scan does not show are in ``files`` too: those without a byte lack all
    columns, and those with a hidden name (``_`` or ``.`` in front, of the file or a folder)
    are refused for it. A field of more than ``max_field_chars`` refuses its file.
    """
    folder = folder or new_work_folder(spark, "raw")
    if paths is None:
        scanned, hidden = [raw_dir], L.hidden_files(spark, raw_dir)
    else:
        names = {path: _name_below(raw_dir, path) for path in paths}
        scanned = [path for path in paths if not L.is_hidden(names[path])]
        hidden = sorted({names[path] for path in paths if L.is_hidden(names[path])})
    lines = L.scan_lines(spark, scanned) if scanned else spark.createDataFrame([], L.LINES)

    # collect_set holds at most the three kinds; being an object aggregate it also lets
    # min_by keep its text buffer in a hash map instead of sorting every line by file. It
    # interprets what it is given, so the kind is a column before.
    kind = F.when(C.ends_open_from_outside(F.col("line")), OPEN).otherwise(
        C.record_fault(C.trim_line_end(F.col("line")), max_field_chars)
    )
    profile = store(
        lines.select("path", "row_pos", "line", kind.alias("kind"))
        .groupBy("path")
        .agg(
            F.min_by("line", "row_pos").alias("header_line"),
            F.array_sort(F.collect_set("kind")).alias("kinds"),
            F.count("*").alias("line_count"),
        ),
        f"{folder}/profile",
    )
    is_quoted = F.array_contains("kinds", OPEN)
    plain_files = profile.filter(~is_quoted).select(
        "path", "line_count", "header_line", F.get("kinds", F.lit(0)).alias("fault")
    )
    quoted_names = profile.filter(is_quoted).select("path", "line_count")
    spanning = not quoted_names.isEmpty()

    headers = plain_files
    if spanning:
        records, quoted_files = _spanning_records(lines, quoted_names, folder, max_field_chars)
        headers = headers.unionByName(quoted_files)
    checked = check_header(headers.withColumn("header", C.fields(C.trim_line_end(F.col("header_line")))))
    missing = F.when(
        F.size("missing") > 0,
        F.concat(F.lit(S.MISSING_REQUIRED_COLUMNS + ": "), F.array_join("missing", ", ")),
    )
    empty = L.empty_files(spark, scanned, profile) if scanned else spark.createDataFrame([], "path string")
    root = qualified(spark, raw_dir)
    seen = checked.select(
        "path",
        "line_count",
        _below(root, F.col("path")).alias("source_file"),
        "positions",
        F.coalesce(missing, F.col("fault")).alias("file_error"),
    )
    files = store(_with_unseen(seen, empty, hidden, root), f"{folder}/files")

    readable = files.filter(F.col("file_error").isNull()).select("path", "line_count", "source_file", "positions")
    plain = readable.join(quoted_names.select("path"), "path", "left_anti") if spanning else readable
    rows = _bind(lines, plain)
    if spanning:
        rows = rows.unionByName(_bind(records, readable.join(quoted_names.select("path"), "path", "left_semi")))
    return store(derive(rows), f"{folder}/rows", UNLIKE), files.select("source_file", "file_error")


def unseen_files(spark: SparkSession, raw_dir: str) -> DataFrame:
    """``source_file, file_error`` of the admitted files that neither a scan nor a stream shows."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").option("recursiveFileLookup", True)
    with_bytes = listed.load(raw_dir).select("path")  # contents are not read
    empty = L.empty_files(spark, [raw_dir], with_bytes)
    nothing = spark.createDataFrame([], "path string, line_count long, source_file string, positions array<int>, file_error string")
    found = _with_unseen(nothing, empty, L.hidden_files(spark, raw_dir), qualified(spark, raw_dir))
    return found.select("source_file", "file_error")


def without_headers(rows: DataFrame, first_positions: DataFrame, weight: str) -> DataFrame:
    """Drops the first row of each file.

    ``first_positions`` has ``source_file, first_pos`` and the file's number of ``rows``.
    """
    firsts = first_positions.select("source_file", "first_pos", weight)
    return (
        lookup(rows, firsts, ["source_file"], weight, F.col("row_pos"))
        .filter(F.col("row_pos") > F.col("first_pos"))
        .drop("first_pos")
    )


def _bind(lines: DataFrame, files: DataFrame) -> DataFrame:
    filled = lines.withColumn("line", C.trim_line_end(F.col("line"))).filter(F.col("line") != "")
    values = (
        lookup(filled, files, ["path"], "line_count", F.col("row_pos"))
        .filter(F.col("positions").isNotNull())
        .select("source_file", "row_pos", "positions", C.fields(F.col("line")).alias("v"))
    )
    bound = [
        F.get("v", F.get("positions", F.lit(i))).alias(name) for i, name in enumerate(S.REQUIRED_COLUMNS)
    ]
    return values.select("source_file", "row_pos", *bound)


def _name_below(raw_dir: str, path: str) -> str:
    """Path relative to the raw folder if both are written alike, else the file's own name."""
    root, file = (re.sub(r"\\(.)", r"\1", re.sub("^file:/*", "/", p)).rstrip("/") for p in (raw_dir, path))
    return file.removeprefix(root + "/") if file.startswith(root + "/") else file.rsplit("/", 1)[-1]


def _with_unseen(files: DataFrame, empty: DataFrame, hidden: list[str], root: str) -> DataFrame:
    """The files of a scan and those it does not show, with the reason."""
    lacks_all = f"{S.MISSING_REQUIRED_COLUMNS}: {', '.join(S.REQUIRED_COLUMNS)}"
    nothing = F.lit(None)

    def refused(rows: DataFrame, name: Column, error: str) -> DataFrame:
        columns = {"line_count": F.lit(0), "source_file": name, "positions": nothing, "file_error": F.lit(error)}
        return rows.select("path", *[v.cast(files.schema[k].dataType).alias(k) for k, v in columns.items()])

    names = files.sparkSession.createDataFrame([(name,) for name in hidden], "path string")
    return files.unionByName(refused(empty, _below(root, F.col("path")), lacks_all)).unionByName(
        refused(names, F.col("path"), S.HIDDEN_NAME)
    )


def _below(root: str, path: Column) -> Column:
    """Decoded path relative to ``root``. A plus sign in a path is a plus sign."""
    path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    path = F.regexp_replace(path, "^file:/+", "file:/")
    return F.when(path.startswith(root + "/"), F.substring(path, len(root) + 2, 2**31 - 1)).otherwise(path)


def _spanning_records(
    lines: DataFrame, names: DataFrame, folder: str, max_field_chars: int
) -> tuple[DataFrame, DataFrame]:
    """Whole records of the files in which some record spans lines, and those files' headers."""

    def flagged(rows: DataFrame, files: DataFrame) -> DataFrame:
        marked = files.select("path", "line_count", F.lit(True).alias("flag"))
        return lookup(rows, marked, ["path"], "line_count", F.col("row_pos"))

    some = names.limit(FEW_FILES + 1).collect()
    if len(some) <= FEW_FILES:
        # Only these files are read again.
        mine = L.scan_lines(lines.sparkSession, [L.literal_path(unquote(r.path)) for r in some])
    else:
        mine = flagged(lines, names).filter("flag").drop("flag")
    resolved = store(L.resolve_lines(store(mine, f"{folder}/quoted_lines")), f"{folder}/resolved")
    overlong = store(L.overlong_files(resolved, max_field_chars).join(names, "path"), f"{folder}/overlong")
    bounded = flagged(resolved, overlong).filter(F.col("flag").isNull()).drop("flag")
    records = store(L.join_lines(bounded), f"{folder}/records")

    fault = C.record_fault(C.trim_line_end(F.col("line")), max_field_chars).alias("fault")
    faults = (
        records.select("path", fault)
        .unionByName(overlong.select("path", F.lit(S.FIELD_TOO_LARGE).alias("fault")))
        .groupBy("path")
        .agg(F.min("fault").alias("fault"))
    )
    firsts = store(
        records.groupBy("path").agg(F.min("row_pos").alias("first_pos"), F.count("*").alias("line_count")),
        f"{folder}/firsts",
    )
    header_lines = (
        lookup(records, firsts, ["path"], "line_count", F.col("row_pos"))
        .filter(F.col("row_pos") == F.col("first_pos"))
        .select("path", F.col("line").alias("header_line"))
    )
    headers = names.join(faults, "path").join(header_lines, "path", "left")
    return records, headers.select("path", "line_count", "header_line", "fault")
