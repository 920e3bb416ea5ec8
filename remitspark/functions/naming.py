"""File names: which files come in, and what their outputs are called."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def is_csv(path: Column) -> Column:
    return F.lower(path).endswith(".csv")


def _base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def processed_key(path: Column, day: Column) -> Column:
    """``processed/year=2026/month=01/day=05/name.parquet`` for the date of ``day``."""
    name = F.replace(_base_name(path), F.lit(".csv"), F.lit(".parquet"))
    return F.format_string(
        "processed/year=%d/month=%02d/day=%02d/%s", F.year(day), F.month(day), F.dayofmonth(day), name
    )


def rejected_key(path: Column) -> Column:
    """``rejected/name_rejected.csv``."""
    return F.concat(F.lit("rejected/"), F.replace(_base_name(path), F.lit(".csv"), F.lit("_rejected.csv")))
