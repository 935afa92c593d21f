"""Exploratory profile: descriptive tables of a data set and its label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip, to_number
from ..session import stored
from .quantiles import exact_quantiles, numeric_view



def head(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """First n rows in a stated order (top-k: no full sort)."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)


def schema_info(df: DataFrame) -> DataFrame:
    """(position, column, dtype, rows, non_null), one aggregate pass."""
    names = df.columns
    counts = df.agg(F.count("*").alias("__rows"), *[F.count(F.col(c)).alias(c) for c in names])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.col("__rows").alias("rows"),
            F.col(c).alias("non_null"),
        )
        for i, c in enumerate(names)
    ]
    return counts.select(F.inline(F.array(*rows)))


def table_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, mean, std, min, p25, p50, p75, max); sample deviation."""
    columns = list(columns)
    values = numeric_view(df, columns)
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs = []
    for i, c in enumerate(columns):
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.avg(c).alias(f"a{i}"),
            F.stddev_samp(c).alias(f"s{i}"),
            F.min(c).alias(f"l{i}"),
            F.max(c).alias(f"h{i}"),
        ]
    rows = []
    for i, c in enumerate(columns):
        q = quartiles[c] or [None] * 3
        rows.append(
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("count"),
                F.col(f"a{i}").alias("mean"),
                F.col(f"s{i}").alias("std"),
                F.col(f"l{i}").alias("min"),
                *[F.lit(v).cast("double").alias(n) for n, v in zip(("p25", "p50", "p75"), q)],
                F.col(f"h{i}").alias("max"),
            )
        )
    return values.agg(*aggs).select(F.inline(F.array(*rows)))


def _missing(df: DataFrame, c: str) -> Column:
    if df.schema[c].dataType.typeName() in ("double", "float"):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def missing_report(df: DataFrame, keep_complete: bool = False) -> DataFrame:
    """(column, missing, missing_pct) with gaps only, largest share first."""
    names = df.columns
    counts = df.agg(
        F.count("*").alias("__rows"), *[F.count_if(_missing(df, c)).alias(c) for c in names]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("missing"),
            F.round(F.when(F.col("__rows") > 0, F.col(c) / F.col("__rows") * 100), 2).alias("missing_pct"),
        )
        for c in names
    ]
    out = counts.select(F.inline(F.array(*rows)))
    if not keep_complete:
        out = out.where(F.col("missing") > 0)
    return out.orderBy(F.desc("missing"), "column")


def missing_cells(df: DataFrame) -> DataFrame:
    """One row: number of missing cells in the table."""
    total = sum((_missing(df, c).cast("int") for c in df.columns), F.lit(0))
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).alias("missing_cells"))


def value_shares(df: DataFrame, column: str, dropna: bool = True) -> DataFrame:
    """(value, rows, share), most frequent first."""
    kept = df.where(F.col(column).isNotNull()) if dropna else df
    counted = kept.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))
    total = counted.agg(F.sum("rows").alias("t")).scalar()
    return counted.select("value", "rows", (F.col("rows") / total).alias("share")).orderBy(
        F.desc("rows"), "value"
    )


def rate_by_group(df: DataFrame, key: str, label: str, digits: int | None = 3) -> DataFrame:
    """(value, mean, count) of the label per non-null key, lowest mean first."""
    mean = F.avg(F.col(label).cast("double"))
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("value"))
        .agg((F.round(mean, digits) if digits is not None else mean).alias("mean"), F.count(label).alias("count"))
        .orderBy("mean", "value")
    )


def rate_by_category(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, value, rate, rows, base_rate) for all features in one grouping; the
    base rate is a scan of the label column alone."""
    features = list(features)
    y = F.col(label).cast("double").alias("__y")
    long = df.select(*[F.col(c).cast("string").alias(c) for c in features], y).unpivot(
        ["__y"], features, "feature", "value"
    )
    grouped = long.groupBy("feature", "value").agg(
        F.sum("__y").alias("hits"), F.count("__y").alias("rows")
    )
    whole = df.agg(F.avg(F.col(label).cast("double")).alias("r"))
    return (
        grouped.where(F.col("value").isNotNull())
        .select(
            "feature",
            "value",
            (F.col("hits") / F.col("rows")).alias("rate"),
            "rows",
            whole.scalar().alias("base_rate"),
        )
        .orderBy("feature", "rate", "value")
    )


def correlation_ranking(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """(column, corr) of every column with the label, ascending; pairwise complete."""
    columns = list(columns)
    values = numeric_view(df, [*columns, label])
    row = values.agg(*[F.corr(c, label).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("corr")) for c in columns])
    return row.select(F.inline(pairs)).orderBy("corr", "column")


def class_histogram(
    df: DataFrame,
    columns: Sequence[str],
    label: str,
    bins: int = 30,
    upper: float | None = None,
) -> DataFrame:
    """(feature, label, bin, low, high, rows, density): equal-width bins over each
    class's own range, last bin closed. ``upper`` clips values first."""
    columns = list(columns)
    types = {f.name: f.dataType for f in df.schema}
    exprs = [clip(to_number(F.col(c), types[c]), upper=upper).alias(c) for c in columns]
    long = (
        df.select(F.col(label).alias("label"), *exprs)
        .unpivot(["label"], columns, "feature", "v")
        .where(F.col("v").isNotNull() & F.col("label").isNotNull())
    )
    spans = long.groupBy("feature", "label").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("n"))
    # a constant column gets the unit range around its value
    flat = F.col("lo") == F.col("hi")
    span = stored(
        spans.select(
            "feature", "label", "n",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        ),
        "histogram-spans",
    )
    width = (F.col("hi") - F.col("lo")) / bins
    index = F.least(F.lit(bins - 1), F.floor((F.col("v") - F.col("lo")) / width)).cast("int")
    counted = (
        long.join(span, ["feature", "label"])  # stored, so the planner knows whether to broadcast
        .groupBy("feature", "label", "lo", "hi", "n", index.alias("bin"))
        .agg(F.count("*").alias("rows"))
        .groupBy("feature", "label", "lo", "hi", "n")
        .agg(F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("filled"))  # <= bins
    )
    grid = counted.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    rows = F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0))
    return grid.select(
        "feature",
        "label",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("high"),
        rows.alias("rows"),
        (rows / (F.col("n") * width)).alias("density"),
    )
