"""Bulk rewrite of path columns, with a count of what changes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_at_marker


def rewrite_paths(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Cut the columns at ``/<name>/``. A value without the marker is kept, so a
    second run changes nothing."""
    return df.withColumns({c: cut_at_marker(F.col(c), name) for c in columns})


def changed_rows(df: DataFrame, columns: Sequence[str], name: str, table: str = "") -> DataFrame:
    """(location, rows_changed) per column in one aggregate pass; writes nothing."""
    prefix = f"{table}." if table else ""
    counts = df.agg(*[F.count_if(cut_at_marker(F.col(c), name) != F.col(c)).alias(c) for c in columns])
    rows = [F.struct(F.lit(prefix + c).alias("location"), F.col(c).alias("rows_changed")) for c in columns]
    return counts.select(F.inline(F.array(*rows)))


def rewrite_tables(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Sequence[str]],
    name: str,
    dry_run: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """(rewritten tables, change report). A dry run returns the tables untouched."""
    report = reduce(
        DataFrame.unionByName,
        [changed_rows(tables[t], cs, name, t) for t, cs in columns.items()],
    )
    if dry_run:
        return dict(tables), report
    return {t: rewrite_paths(df, columns.get(t, ()), name) for t, df in tables.items()}, report
