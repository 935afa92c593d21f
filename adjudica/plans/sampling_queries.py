"""Catalogue: deduplication, split, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sampling
from .registry import query, table


@query(
    "dedupe_keep_first",
    """
    SELECT doc_id, lang, source, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
    """,
)
def dedupe_keep_first(spark, sf):
    kept = sampling.dedupe_keep_first(table(spark, sf, "documents"), ["text"], ["doc_id"])
    return kept.select("doc_id", "lang", "source", "n_chars")


@query(
    "dedupe_full_row",
    "SELECT lang, source, n_chars, md5(text) AS digest FROM (SELECT DISTINCT lang, source, n_chars, text FROM documents)",
)
def dedupe_full_row(spark, sf):
    docs = table(spark, sf, "documents").select("lang", "source", "n_chars", "text")
    return sampling.dedupe(docs, ["doc_id"]).select("lang", "source", "n_chars", F.md5("text").alias("digest"))


@query(
    "dedupe_null_keys",
    """
    SELECT o_orderkey, k FROM (SELECT o_orderkey, nullif(o_custkey % 40, 3) AS k,
      row_number() OVER (PARTITION BY nullif(o_custkey % 40, 3) ORDER BY o_orderkey) AS rn FROM orders) WHERE rn = 1
    """,
)
def dedupe_null_keys(spark, sf):
    """Few, heavy keys; the null keys form one group."""
    keyed = table(spark, sf, "orders").select(
        "o_orderkey", F.nullif(F.col("o_custkey") % 40, F.lit(3)).alias("k")
    )
    return sampling.dedupe_keep_first(keyed, ["k"], ["o_orderkey"])


_QUOTA = """
    cnt AS (SELECT {y} AS y, count(*) AS n FROM {t} GROUP BY 1),
    tot AS (SELECT sum(n) AS total, sum(n) - ceil(sum(n) * 0.2) AS n_train FROM cnt),
    flo AS (SELECT y, n, floor(n * n_train / total) AS f, (n * n_train) % total AS rem, n_train FROM cnt, tot),
    quota AS (SELECT y, n - f - CASE WHEN row_number() OVER (ORDER BY rem DESC, y)
      <= n_train - sum(f) OVER () THEN 1 ELSE 0 END AS held FROM flo)"""

_SPLIT = f"""
    WITH {_QUOTA.format(y='o_orderstatus', t='orders')},
    ranked AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (
      PARTITION BY o_orderstatus ORDER BY md5(o_orderkey::VARCHAR || '|42'), o_orderkey) AS rk FROM orders),
    parts AS (SELECT o_orderkey, o_orderstatus, CASE WHEN rk <= held THEN 'test' ELSE 'train' END AS part
      FROM ranked JOIN quota ON y = o_orderstatus)"""


def _named(df):
    return df.withColumn("part", F.when(F.col("__part") == 0, "test").otherwise("train"))


@query("split_stratified", f"{_SPLIT} SELECT * FROM parts")
def split_stratified(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    marked = sampling.mark_split(orders, "o_orderstatus", "o_orderkey", 0.2, 42)
    return _named(marked).select("o_orderkey", "o_orderstatus", "part")


@query("split_counts", f"{_SPLIT} SELECT o_orderstatus, part, count(*) AS rows FROM parts GROUP BY 1, 2")
def split_counts(spark, sf):
    return (
        split_stratified(spark, sf).groupBy("o_orderstatus", "part").agg(F.count("*").alias("rows"))
    )


@query(
    "split_plain",
    """
    SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (
      ORDER BY md5(o_orderkey::VARCHAR || '|7'), o_orderkey) AS rk FROM orders)
    WHERE rk <= (SELECT ceil(count(*) * 0.25) FROM orders)
    """,
)
def split_plain(spark, sf):
    """Held-out keys of the unstratified split."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.split_dataset(orders, "o_orderstatus", "o_orderkey", 0.25, 7, stratify=False)[1].select(
        "o_orderkey"
    )


@query(
    "kfold_stratified",
    """
    WITH cnt AS (SELECT quality AS y, count(*) AS n, coalesce(sum(count(*)) OVER (
        ORDER BY quality ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM labels GROUP BY 1),
    deal AS (SELECT y, p % 5 AS fold FROM cnt, unnest(range(off::BIGINT, (off + n)::BIGINT)) AS u(p)),
    bound AS (SELECT y, fold, sum(count(*)) OVER (PARTITION BY y ORDER BY fold) AS upto FROM deal GROUP BY y, fold),
    ranked AS (SELECT doc_id, quality, row_number() OVER (
      PARTITION BY quality ORDER BY md5(doc_id::VARCHAR || '|42'), doc_id) AS rk FROM labels)
    SELECT doc_id, quality, min(fold)::INTEGER AS fold FROM ranked JOIN bound ON y = quality AND rk <= upto
    GROUP BY doc_id, quality
    """,
)
def kfold_stratified(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.stratified_folds(labels, "quality", "doc_id", 5, 42)
