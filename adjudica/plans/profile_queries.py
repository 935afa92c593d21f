"""Catalogue: exploratory profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile
from .registry import query, table

NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _per_column(template: str, columns) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in columns)


@query(
    "profile_table",
    _per_column(
        """SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        min({c}) AS "min", quantile_cont({c}, 0.25) AS p25, median({c}) AS p50, quantile_cont({c}, 0.75) AS p75,
        max({c}) AS "max" FROM lineitem""",
        NUMERIC,
    ),
)
def profile_table(spark, sf):
    out = profile.table_profile(table(spark, sf, "lineitem"), NUMERIC)
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "schema_info",
    """
    SELECT i::INTEGER AS position, c AS "column", t AS dtype, (SELECT count(*) FROM part) AS rows, n AS non_null FROM (
      SELECT 0 AS i, 'p_partkey' AS c, 'bigint' AS t, (SELECT count(p_partkey) FROM part) AS n
      UNION ALL SELECT 1, 'brand', 'string', (SELECT count(nullif(p_brand, 'Brand#4')) FROM part)
      UNION ALL SELECT 2, 'p_size', 'int', (SELECT count(p_size) FROM part)
      UNION ALL SELECT 3, 'p_retailprice', 'double', (SELECT count(p_retailprice) FROM part))
    """,
)
def schema_info(spark, sf):
    part = table(spark, sf, "part").select(
        "p_partkey", F.nullif("p_brand", F.lit("Brand#4")).alias("brand"), "p_size", "p_retailprice"
    )
    return profile.schema_info(part)


_PART_GAPS = """
    src AS (SELECT p_partkey, nullif(p_brand, 'Brand#4') AS brand, nullif(p_type, 'ECONOMY') AS kind,
      CASE WHEN p_size < 10 THEN NULL ELSE p_size END AS size, p_retailprice FROM part)"""


def part_gaps(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.nullif("p_brand", F.lit("Brand#4")).alias("brand"),
        F.nullif("p_type", F.lit("ECONOMY")).alias("kind"),
        F.when(F.col("p_size") >= 10, F.col("p_size")).alias("size"),
        "p_retailprice",
    )


@query(
    "missing_report",
    f"""
    WITH {_PART_GAPS},
    m AS ({_per_column('''SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS missing,
      round(count(*) FILTER ({c} IS NULL) / count(*) * 100, 2) AS missing_pct FROM src''',
      ['p_partkey', 'brand', 'kind', 'size', 'p_retailprice'])})
    SELECT * FROM m WHERE missing > 0 ORDER BY missing DESC, "column"
    """,
)
def missing_report(spark, sf):
    return profile.missing_report(part_gaps(spark, sf))


@query(
    "missing_cells",
    f"""
    WITH {_PART_GAPS}
    SELECT (count(*) FILTER (brand IS NULL) + count(*) FILTER (kind IS NULL) + count(*) FILTER (size IS NULL))::BIGINT
      AS missing_cells FROM src
    """,
)
def missing_cells(spark, sf):
    return profile.missing_cells(part_gaps(spark, sf))


@query(
    "value_shares",
    """
    SELECT event_type AS value, count(*) AS rows, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM events GROUP BY 1 ORDER BY 2 DESC, 1
    """,
)
def value_shares(spark, sf):
    return profile.value_shares(table(spark, sf, "events"), "event_type").withColumn(
        "share", F.round("share", 6)
    )


@query(
    "rate_by_group",
    """
    SELECT l_linenumber AS value, round(avg((l_returnflag = 'R')::INT), 6) AS mean, count(*) AS "count" FROM lineitem
    WHERE l_linenumber <> 4 GROUP BY 1
    """,
)
def rate_by_group(spark, sf):
    """Rows with a null key do not count."""
    src = table(spark, sf, "lineitem").select(
        F.nullif("l_linenumber", F.lit(4)).alias("line"), (F.col("l_returnflag") == "R").cast("int").alias("y")
    )
    return profile.rate_by_group(src, "line", "y", digits=6)


@query(
    "rate_by_category",
    f"""
    WITH src AS (SELECT l_linestatus, l_linenumber, nullif(l_tax, 0.03) AS tax, (l_returnflag = 'R')::INT AS y FROM lineitem)
    SELECT * FROM ({_per_column('''SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, round(avg(y), 6) AS rate,
      count(*) AS rows, (SELECT round(avg(y), 6) FROM src) AS base_rate FROM src WHERE {c} IS NOT NULL GROUP BY 2''',
      ['l_linestatus', 'l_linenumber', 'tax'])})
    """,
)
def rate_by_category(spark, sf):
    src = table(spark, sf, "lineitem").select(
        "l_linestatus",
        "l_linenumber",
        F.nullif("l_tax", F.lit(0.03)).alias("tax"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )
    rates = profile.rate_by_category(src, ["l_linestatus", "l_linenumber", "tax"], "y")
    return rates.withColumns({"rate": F.round("rate", 6), "base_rate": F.round("base_rate", 6)})


_CORR = [*NUMERIC, "gaps"]


@query(
    "corr_ranking",
    f"""
    WITH src AS (SELECT *, nullif(l_quantity, 11) AS gaps, (l_returnflag = 'R')::INT AS y FROM lineitem)
    {_per_column('''SELECT '{c}' AS "column", round(corr({c}, y), 6) AS corr FROM src''', _CORR)}
    """,
)
def corr_ranking(spark, sf):
    src = table(spark, sf, "lineitem").select(
        *NUMERIC,
        F.nullif("l_quantity", F.lit(11.0)).alias("gaps"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )
    return profile.correlation_ranking(src, _CORR, "y").withColumn("corr", F.round("corr", 6))


def _histogram_sql(value: str, bins: int) -> str:
    return f"""
    WITH src AS (SELECT l_linestatus AS label, {value} AS v FROM lineitem),
    span AS (SELECT label, min(v) AS lo, max(v) AS hi, count(*) AS n FROM src GROUP BY 1),
    cnt AS (SELECT label, least({bins - 1}, floor((v - lo) / ((hi - lo) / {bins})))::INTEGER AS bin, count(*) AS rows
      FROM src JOIN span USING (label) GROUP BY 1, 2)
    SELECT 'v' AS feature, span.label AS label, b::INTEGER AS bin, round(lo + b * ((hi - lo) / {bins}), 6) AS low,
      round(lo + (b + 1) * ((hi - lo) / {bins}), 6) AS high, coalesce(rows, 0) AS rows,
      round(coalesce(rows, 0) / (n * ((hi - lo) / {bins})), 9) AS density
    FROM span CROSS JOIN range({bins}) AS r(b) LEFT JOIN cnt ON cnt.label = span.label AND cnt.bin = r.b"""


def _histogram(spark, sf, value, bins, upper=None):
    src = table(spark, sf, "lineitem").select(F.col("l_linestatus").alias("y"), value.alias("v"))
    out = profile.class_histogram(src, ["v"], "y", bins, upper)
    return out.withColumns(
        {"low": F.round("low", 6), "high": F.round("high", 6), "density": F.round("density", 9)}
    )


@query("class_histogram", _histogram_sql("l_extendedprice", 30))
def class_histogram(spark, sf):
    return _histogram(spark, sf, F.col("l_extendedprice"), 30)


@query("clipped_histogram", _histogram_sql("least(l_extendedprice / 30000, 2.0::DOUBLE)", 40))
def clipped_histogram(spark, sf):
    return _histogram(spark, sf, F.col("l_extendedprice") / 30000, 40, upper=2.0)


@query(
    "head_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def head_rows(spark, sf):
    """First rows in a stated order: a distributed top-k."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.negate("o_totalprice").alias("__k")
    )
    return profile.head(orders, 5, ["__k", "o_orderkey"]).drop("__k")
