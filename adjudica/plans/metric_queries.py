"""Catalogue: hold-out metrics on line items. The label is "returned"; the scores are
a heavily tied one (discount) and a nearly distinct one (price)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.labels import decide
from .registry import query, table

_SRC = """
    src AS (SELECT (l_returnflag = 'R')::INT AS y, l_discount * 10 AS tied, l_extendedprice / 110000 AS fine,
      (l_discount * 10 > 0.5)::INT AS p FROM lineitem)"""

_CONFUSION = """
    m AS (SELECT count(*) FILTER (y = 0 AND p = 0) AS tn, count(*) FILTER (y = 0 AND p = 1) AS fp,
      count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 1 AND p = 1) AS tp FROM src)"""


def scored(spark, sf):
    return table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        (F.col("l_discount") * 10).alias("tied"),
        (F.col("l_extendedprice") / 110_000).alias("fine"),
        decide(F.col("l_discount") * 10, 0.5, inclusive=False).alias("p"),
    )


def _auc(score: str) -> str:
    """Scalar subquery: tie-averaged rank form of the area."""
    return f"""(SELECT (sum(CASE WHEN y = 1 THEN r END) - any_value(np) * (any_value(np) + 1) / 2.0)
      / (any_value(np) * any_value(nn)) FROM (
        SELECT y, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0 AS r,
          sum(y) OVER () AS np, sum(1 - y) OVER () AS nn FROM src))"""


@query(
    "confusion",
    f"""
    WITH {_SRC}, {_CONFUSION}
    SELECT tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive,
      tn + fp + fn + tp AS support FROM m
    """,
)
def confusion(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf), "y", "p")


_METRICS = f"""
    WITH {_SRC}, {_CONFUSION},
    row_ AS (SELECT round((tp + tn) / (tn + fp + fn + tp), 6) AS accuracy, round(tp / (tp + fp), 6) AS "precision",
      round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
      round({_auc('tied')}, 6) AS roc_auc FROM m)"""


@query("clf_metrics", f"{_METRICS} SELECT * FROM row_")
def clf_metrics(spark, sf):
    return metrics.classification_metrics(scored(spark, sf), "y", "p", "tied")


@query(
    "roc_auc",
    f"""
    WITH {_SRC}
    SELECT 'tied' AS score, round({_auc('tied')}, 9) AS roc_auc
    UNION ALL SELECT 'fine', round({_auc('fine')}, 9)
    """,
)
def roc_auc(spark, sf):
    df = scored(spark, sf)
    out = None
    for score in ("tied", "fine"):
        one = metrics.roc_auc_frame(df, "y", score).select(
            F.lit(score).alias("score"), F.round("roc_auc", 9).alias("roc_auc")
        )
        out = one if out is None else out.unionByName(one)
    return out


def _curve(score: str) -> str:
    return f"""
    WITH {_SRC},
    pts AS (SELECT {score} AS s, sum(y) AS pos, sum(1 - y) AS neg FROM src GROUP BY 1),
    cum AS (SELECT s, pos, neg, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn, lead(pos) OVER w AS npos,
      lead(neg) OVER w AS nneg, row_number() OVER w AS rn, sum(pos) OVER () AS p, sum(neg) OVER () AS n
      FROM pts WINDOW w AS (ORDER BY s DESC)),
    corner AS (SELECT s, cp, cn, p, n FROM cum WHERE rn = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg),
    num AS (SELECT row_number() OVER (ORDER BY s DESC) AS ordinal, cn / n AS fpr, cp / p AS tpr, s AS threshold FROM corner
      UNION ALL SELECT 0, 0.0, 0.0, 1.0),
    size AS (SELECT greatest(1, count(*) // 100) AS step FROM num)
    SELECT ordinal, round(fpr, 5) AS fpr, round(tpr, 5) AS tpr, round(threshold, 5) AS threshold
    FROM num, size WHERE ordinal % step = 0"""


@query("roc_curve", _curve("fine"))
def roc_curve(spark, sf):
    return metrics.roc_curve(scored(spark, sf), "y", "fine")


@query("roc_curve_tied", _curve("tied"))
def roc_curve_tied(spark, sf):
    return metrics.roc_curve(scored(spark, sf), "y", "tied")


@query(
    "gate",
    f"""
    {_METRICS}
    SELECT 'roc_auc' AS metric, roc_auc AS observed, 0.7::DOUBLE AS minimum, roc_auc >= 0.7 AS passed FROM row_
    UNION ALL SELECT 'f1', f1, 0.4::DOUBLE, f1 >= 0.4 FROM row_
    """,
)
def gate(spark, sf):
    return metrics.gate_frame(clf_metrics(spark, sf), min_roc_auc=0.7, min_f1=0.4)
