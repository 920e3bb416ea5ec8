"""Physical lines of CSV files, and records whose quoted fields span lines.

Files are read as splittable text, so one huge file is read by many tasks. A record with
a line break inside quotes is put together again from the lines, also across splits.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from remitspark import schema as S
from remitspark.session import conf_bytes
from remitspark.sources import csv_text as C


LINES = "path string, block long, row_pos long, line string"


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, block, row_pos, line`` for every line of the admitted files.

    ``path`` is the file as Spark names it. ``row_pos`` grows with the position in
    the file: the number of the split, then the running number within the task. Two splits
    of a file start at least ``quantum`` bytes apart, hence never share a number.
    """
    quantum = min(
        conf_bytes(spark, "spark.sql.files.maxPartitionBytes"),
        conf_bytes(spark, "spark.sql.files.openCostInBytes"),
    )
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return (
        _text(spark, paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            in_task.alias("in_task"),
            F.col("value").alias("line"),
        )
        .select(
            "path",
            "block",
            (F.shiftleft(F.floor(F.col("block") / quantum).cast("long"), 33) + F.col("in_task")).alias("row_pos"),
            "line",
        )
    )


def is_hidden(name: str) -> bool:
    """Whether file listings skip the name: a part of it starts with ``.``, or with ``_`` and has no ``=``."""
    return any(part.startswith(".") or (part.startswith("_") and "=" not in part) for part in name.split("/"))


def hidden_files(spark: SparkSession, raw_dir: str) -> list[str]:
    """Admitted files below ``raw_dir`` that the listing of a scan skips, relative to it.

    Asks for hidden names only, depth by depth, so that other files never reach this process.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(raw_dir)
    system = root.getFileSystem(conf)
    base = literal_path(system.makeQualified(root).toString().rstrip("/"))
    top = len(system.makeQualified(root).toUri().getPath().rstrip("/")) + 1
    found, level = [], ""
    while True:
        for status in system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base}{level}/[_.]*")) or []:
            files = system.listFiles(status.getPath(), True)
            while files.hasNext():
                found.append(files.next().getPath().toUri().getPath()[top:])
        level += "/*"
        if not system.globStatus(jvm.org.apache.hadoop.fs.Path(base + level)):
            return sorted({name for name in found if name.lower().endswith(".csv") and is_hidden(name)})


def _text(spark: SparkSession, paths: list[str]) -> DataFrame:
    return (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("recursiveFileLookup", True)
        .text(paths)
    )


def empty_files(spark: SparkSession, paths: list[str], profile: DataFrame) -> DataFrame:
    """``path`` of every admitted file without a byte: listed, but not in ``profile``, one row a file.

    Names come to this process only if the listing has more files than the profile.
    """
    listed = _text(spark, paths)._jdf.inputFiles()
    if len(listed) == profile.count():
        return spark.createDataFrame([], "path string")
    names = spark.createDataFrame([(name,) for name in listed], "path string")
    same = F.regexp_replace("path", "^file:/+", "file:/").alias("plain")
    return names.select("path", same).join(profile.select(same), "plain", "left_anti").select("path")


def literal_path(path: str) -> str:
    """Keeps ``[x]`` and the like in a file name from being read as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _with_entry_state(rows: DataFrame, order: W, opens: str, stays: str) -> DataFrame:
    """Adds ``if_out`` and ``if_in``: each row's state, given the state before the first.

    A row maps the state before it (0 outside quotes, 1 inside) to ``opens`` or ``stays``.
    If both are equal the row is an anchor: what came before does not matter. If they are
    1 and 0 the row flips the state. So the state before a row is the last anchor's value,
    or the initial state, plus the flips since, modulo 2. An anchor is stored with the
    flips up to its own row already taken off.
    """
    before = order.rowsBetween(W.unboundedPreceding, -1)
    o, s = F.col(opens), F.col(stays)
    flip = F.when((o == 1) & (s == 0), 1).otherwise(0)
    rows = rows.withColumn("flips", F.coalesce(F.sum(flip).over(before), F.lit(0)))
    anchor = F.when(o == s, (o + F.col("flips")) % 2)
    rows = rows.withColumn("anchor", F.last(anchor, ignorenulls=True).over(before))
    return rows.withColumns(
        {
            "if_out": (F.coalesce(F.col("anchor"), F.lit(0)) + F.col("flips")) % 2,
            "if_in": (F.coalesce(F.col("anchor"), F.lit(1)) + F.col("flips")) % 2,
        }
    ).drop("flips", "anchor")


def resolve_lines(lines: DataFrame) -> DataFrame:
    """Adds ``inside`` (1 if the line starts within quotes) and ``record_pos`` to every line.

    Two levels: lines within a split, then one summary row per split within its file. No
    task holds more than one split's lines or one file's split summaries.
    """
    in_split = W.partitionBy("path", "block").orderBy("row_pos")
    in_file = W.partitionBy("path").orderBy("block")

    marked = lines.withColumns(
        {
            "opens": C.ends_open_from_outside(F.col("line")).cast("int"),
            "stays": C.ends_open_from_inside(F.col("line")).cast("int"),
        }
    )
    local = _with_entry_state(marked, in_split, "opens", "stays")

    def end_state(start: str) -> Column:
        return F.when(F.col(start) == 0, F.col("opens")).otherwise(F.col("stays"))

    splits = local.groupBy("path", "block").agg(
        F.max_by(end_state("if_out"), F.col("row_pos")).alias("opens"),
        F.max_by(end_state("if_in"), F.col("row_pos")).alias("stays"),
        F.max(F.when(F.col("if_out") == 0, F.col("row_pos"))).alias("last_if_out"),
        F.max(F.when(F.col("if_in") == 0, F.col("row_pos"))).alias("last_if_in"),
    )
    starts = (
        _with_entry_state(splits, in_file, "opens", "stays")
        .withColumn("last_record", F.when(F.col("if_out") == 0, F.col("last_if_out")).otherwise(F.col("last_if_in")))
        .select(
            "path",
            "block",
            F.col("if_out").alias("split_inside"),
            F.last("last_record", ignorenulls=True)
            .over(in_file.rowsBetween(W.unboundedPreceding, -1))
            .alias("carried_record"),
        )
    )
    up_to_here = in_split.rowsBetween(W.unboundedPreceding, 0)
    return (
        local.join(starts, ["path", "block"])
        .withColumn("inside", F.when(F.col("split_inside") == 0, F.col("if_out")).otherwise(F.col("if_in")))
        .withColumn(
            "record_pos",
            F.coalesce(
                F.last(F.when(F.col("inside") == 0, F.col("row_pos")), ignorenulls=True).over(up_to_here),
                F.col("carried_record"),
            ),
        )
        # The number of lines so far that do not belong wholly to a field which is open
        # before them tells the fields that go on over lines apart.
        .withColumn("is_within", (F.col("inside") == 1) & C.within_field(F.col("line")))
        .withColumn("run", F.count(F.when(~F.col("is_within"), 1)).over(up_to_here))
        .select("path", "block", "row_pos", "record_pos", "inside", "opens", "is_within", "run", "line")
    )


def overlong_files(resolved: DataFrame, max_field_chars: int = S.MAX_FIELD_CHARS) -> DataFrame:
    """Files with a quoted field whose whole lines run past the limit within one split.

    Keeps an unclosed quote from gathering the rest of a file into one record: a field that
    no split finds too long is shorter than the limit in each split it touches. Doubled
    quotes count once, as in the field's value.
    """
    chars = F.length(F.replace(F.col("line"), F.lit('""'), F.lit('"'))) + 1
    return (
        resolved.filter("is_within")
        .groupBy("path", "block", "run")
        .agg(F.sum(chars).alias("chars"))
        .filter(F.col("chars") > max_field_chars)
        .select("path")
        .distinct()
    )


def join_lines(resolved: DataFrame) -> DataFrame:
    """``path, row_pos, line`` with one row per record.

    Only lines of records that span lines are shuffled, grouped by record.
    """
    spans = (F.col("inside") == 1) | (F.col("opens") == 1)
    single = resolved.filter(~spans).select("path", "row_pos", "line")
    joined = (
        resolved.filter(spans)
        .groupBy("path", F.col("record_pos").alias("row_pos"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("row_pos").alias("p"), F.col("line")))).alias("parts"))
        .select("path", "row_pos", F.array_join(F.col("parts.line"), "\n").alias("line"))
    )
    return single.unionByName(joined)
