"""Catalogue: coercion, features, labels, decisions, rewrites, preprocessing."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import percent, to_number
from ..operators import features, labels, rewrite
from ..operators.drift import classify
from ..operators.models import logit_score
from ..operators.preprocess import build_preprocessor, feature_names, most_frequent
from ..session import small_table, work_dir
from ..sources.tables import write_parquet
from .registry import query, table

ROLES = features.Roles("income", "coincome", "amount", "term")

_LOAN_SRC = """
    src AS (SELECT l_orderkey, l_linenumber, l_partkey, c_acctbal AS income,
      CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice * l_discount END AS coincome,
      nullif(l_quantity, 7) AS amount, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_linenumber * 12 END AS term
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""


def _feature_sql(fill: str) -> str:
    return f"""
    WITH {_LOAN_SRC},
    a AS (SELECT *, coalesce(income, 0) + coalesce(coincome, 0) AS total,
      amount * 1000.0 / CASE WHEN coalesce(term, 360) < 1 THEN 1 ELSE coalesce(term, 360) END AS monthly FROM src),
    m AS (SELECT {fill} AS fill)
    SELECT l_orderkey, l_linenumber, l_partkey, total AS "TotalIncome",
      CASE WHEN total > -1 THEN round(ln(1 + total), 6) END AS "LogTotalIncome",
      monthly AS "LoanAmountPerMonth",
      monthly / CASE WHEN total < 1 THEN 1 ELSE total END AS "DebtToIncomeRatio",
      total / CASE WHEN coalesce(amount, fill) * 1000 < 1 THEN 1 ELSE coalesce(amount, fill) * 1000 END
        AS "IncomeToLoanRatio",
      CASE WHEN coalesce(coincome, 0) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS "HasCoapplicant"
    FROM a, m"""


def loan_roles(spark, sf):
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_returnflag"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    joined = line.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        customer, F.col("o_custkey") == F.col("c_custkey")
    )
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.col("c_acctbal").alias("income"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * F.col("l_discount")).alias("coincome"),
        F.nullif("l_quantity", F.lit(7.0)).alias("amount"),
        F.when(F.col("l_returnflag") != "N", F.col("l_linenumber") * 12).alias("term"),
    )


def _rounded(df):
    # plain arithmetic agrees to the last bit between engines, the logarithm does not
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        *[F.round(c, 6).alias(c) if c == "LogTotalIncome" else F.col(c) for c in features.ENGINEERED],
    )


@query("features_affordability", _feature_sql("26.0"))
def features_affordability(spark, sf):
    """Row-wise form: the amount fill is a fitted constant."""
    return _rounded(features.add_engineered_features(loan_roles(spark, sf), ROLES, fill=26.0))


@query("features_fill_batch", _feature_sql("(SELECT median(amount) FROM src)"))
def features_fill_batch(spark, sf):
    """The amount fill is the median of the frame itself. The frame is written once:
    the median then reads one column instead of repeating the joins."""
    path = work_dir(spark, "loan-roles")
    write_parquet(loan_roles(spark, sf), path)
    frame = spark.read.parquet(path)
    return _rounded(features.add_engineered_features(frame, ROLES, fill="batch"))


@query(
    "model_feature_contract",
    f"""
    WITH {_LOAN_SRC}
    SELECT l_partkey, income::DOUBLE AS income, round(coincome, 4) AS coincome,
      round(coalesce(income, 0) + coalesce(coincome, 0), 4) AS "TotalIncome", l_linenumber::VARCHAR AS line
    FROM src
    """,
)
def model_feature_contract(spark, sf):
    """Exactly the model's columns, in order, with the key kept in the same row."""
    src = loan_roles(spark, sf).withColumn("line", F.col("l_linenumber").cast("string"))
    picked = features.select_model_features(
        src, ["income", "coincome", "amount", "term"], ["line"], ROLES, fill=26.0, keep=["l_partkey"]
    )
    return picked.select(
        "l_partkey",
        "income",
        F.round("coincome", 4).alias("coincome"),
        F.round("TotalIncome", 4).alias("TotalIncome"),
        "line",
    )


@query(
    "coerce_numeric",
    """
    WITH src AS (SELECT event_id, CASE event_type
      WHEN 'view' THEN props WHEN 'click' THEN ' ' || user_id::VARCHAR || ' '
      WHEN 'error' THEN user_id::VARCHAR || 'd' WHEN 'signup' THEN user_id::VARCHAR || 'e2' ELSE 'NaN' END AS raw
      FROM events)
    SELECT event_id, raw, CASE WHEN raw SIMILAR TO '.*[dDfF]\\s*' THEN NULL
      WHEN isnan(TRY_CAST(raw AS DOUBLE)) THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS number FROM src
    """,
)
def coerce_numeric(spark, sf):
    """Whatever does not read as a number is NULL: JSON text, a Java suffix, NaN."""
    user = F.col("user_id").cast("string")
    raw = (
        F.when(F.col("event_type") == "view", F.col("props"))
        .when(F.col("event_type") == "click", F.concat(F.lit(" "), user, F.lit(" ")))
        .when(F.col("event_type") == "error", F.concat(user, F.lit("d")))
        .when(F.col("event_type") == "signup", F.concat(user, F.lit("e2")))
        .otherwise("NaN")
    )
    return (
        table(spark, sf, "events")
        .select("event_id", raw.alias("raw"))
        .withColumn("number", to_number(F.col("raw")))
    )


@query(
    "label_encode",
    """
    SELECT l_returnflag AS flag, CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END AS label,
      CASE l_returnflag WHEN 'R' THEN 'Approved' ELSE 'Rejected' END AS decoded, count(*) AS rows
    FROM lineitem GROUP BY 1
    """,
)
def label_encode(spark, sf):
    src = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_returnflag").alias("label")
    )
    coded = labels.encode_target(src, "label", {"R": 1, "A": 0, "N": 0})
    return (
        coded.withColumn("decoded", labels.decode_target(F.col("label"), "Approved", "Rejected"))
        .groupBy("flag", "label", "decoded")
        .agg(F.count("*").alias("rows"))
    )


@query(
    "unknown_labels",
    "SELECT l_returnflag AS value, count(*) AS rows FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1",
)
def unknown_labels(spark, sf):
    """Of the flags only N is an accepted label spelling."""
    return labels.unknown_labels(table(spark, sf, "lineitem"), "l_returnflag")


@query(
    "decision_band",
    """
    WITH src AS (SELECT o_orderkey, o_totalprice / 510000 AS p, md5(o_orderkey::VARCHAR || '|run') AS run FROM orders)
    SELECT o_orderkey, CASE WHEN p >= 0.5 THEN 'Approved' ELSE 'Rejected' END AS loan_status,
      CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction, round(p, 6) AS approval_probability,
      0.5::DOUBLE AS threshold, 'linear' AS model_name,
      CASE WHEN o_orderkey % 3 = 0 THEN 'local' ELSE left(run, 8) END AS model_version,
      CASE WHEN p >= 0.9 THEN 'alert' WHEN p >= 0.4 THEN 'warning' ELSE 'stable' END AS band,
      printf('%.1f%%', round(p, 2) * 100) AS shown
    FROM src
    """,
)
def decision_band(spark, sf):
    key = F.col("o_orderkey")
    p = F.col("o_totalprice") / 510_000
    run = F.when(key % 3 != 0, F.md5(F.concat(key.cast("string"), F.lit("|run"))))
    scored = table(spark, sf, "orders").select("o_orderkey", p.alias("p"))
    out = labels.decision_columns(scored, "p", 0.5, "linear", run, F.md5(key.cast("string")))
    return out.select(
        "o_orderkey",
        "loan_status",
        "prediction",
        "approval_probability",
        "threshold",
        "model_name",
        "model_version",
        classify(F.col("p"), 0.4, 0.9).alias("band"),
        percent(F.round("p", 2)).alias("shown"),
    )


_CUT = "CASE WHEN strpos(url, '/en/') > 0 THEN substr(url, strpos(url, '/en/') + 4) ELSE url END"


@query("path_rewrite", f"SELECT page_id, {_CUT} AS url FROM pages")
def path_rewrite(spark, sf):
    return rewrite.rewrite_paths(table(spark, sf, "pages").select("page_id", "url"), ["url"], "en")


@query(
    "path_rewrite_report",
    f"""
    SELECT 'pages.url' AS location, count(*) FILTER ({_CUT} <> url) AS rows_changed FROM pages
    UNION ALL SELECT 'documents.source', count(*) FILTER (strpos(source, '/en/') > 0) FROM documents
    """,
)
def path_rewrite_report(spark, sf):
    tables = {"pages": table(spark, sf, "pages"), "documents": table(spark, sf, "documents")}
    columns = {"pages": ["url"], "documents": ["source"]}
    return rewrite.rewrite_tables(tables, columns, "en", dry_run=True)[1]


# --- preprocessing -----------------------------------------------------------

_PART_SRC = """
    src AS (SELECT p_partkey, p_partkey % 5 = 4 AS held, nullif(p_size, 11)::DOUBLE AS size,
      p_retailprice AS price, CASE WHEN p_partkey % 5 = 4 AND p_size > 40 THEN 'UNSEEN' ELSE nullif(p_type, 'ECONOMY') END
        AS kind FROM part)"""


def part_view(spark, sf):
    held = F.col("p_partkey") % 5 == 4
    return table(spark, sf, "part").select(
        "p_partkey",
        held.alias("held"),
        F.nullif("p_size", F.lit(11)).cast("double").alias("size"),
        F.col("p_retailprice").alias("price"),
        F.when(held & (F.col("p_size") > 40), "UNSEEN")
        .otherwise(F.nullif("p_type", F.lit("ECONOMY")))
        .alias("kind"),
    )


@query(
    "impute_scale",
    f"""
    WITH {_PART_SRC},
    med AS (SELECT median(size) AS ms, median(price) AS mp FROM src WHERE NOT held),
    fit AS (SELECT avg(coalesce(size, ms)) AS a1, stddev_pop(coalesce(size, ms)) AS s1,
      avg(coalesce(price, mp)) AS a2, stddev_pop(coalesce(price, mp)) AS s2 FROM src, med WHERE NOT held)
    SELECT p_partkey, round((coalesce(size, ms) - a1) / s1, 6) AS size,
      round((coalesce(price, mp) - a2) / s2, 6) AS price FROM src, med, fit
    """,
)
def impute_scale(spark, sf):
    """Fitted on the rows not held out, applied to all."""
    df = part_view(spark, sf)
    fitted = build_preprocessor(["size", "price"], []).fit(df.where(~F.col("held")))
    v = vector_to_array("features")
    return fitted.transform(df).select(
        "p_partkey", F.round(v[0], 6).alias("size"), F.round(v[1], 6).alias("price")
    )


@query(
    "onehot_unseen",
    f"""
    WITH {_PART_SRC},
    cnt AS (SELECT kind, count(*) AS n FROM src WHERE NOT held AND kind IS NOT NULL GROUP BY 1),
    mode_ AS (SELECT kind AS fill FROM cnt ORDER BY n DESC, kind LIMIT 1)
    SELECT p_partkey, 'kind_' || cnt.kind AS slot, (coalesce(src.kind, fill) = cnt.kind)::INT::DOUBLE AS value
    FROM src, cnt, mode_
    """,
)
def onehot_unseen(spark, sf):
    """All training levels keep a slot; an unseen level is zero in every slot."""
    df = part_view(spark, sf)
    fitted = build_preprocessor([], ["kind"]).fit(df.where(~F.col("held")))
    names = feature_names(fitted, [], ["kind"])
    return (
        fitted.transform(df)
        .select("p_partkey", F.posexplode(vector_to_array("features")).alias("i", "value"))
        .select("p_partkey", F.element_at(F.lit(names), F.col("i") + 1).alias("slot"), "value")
    )


@query(
    "most_frequent_values",
    """
    SELECT 'o_orderpriority' AS "column",
      (SELECT o_orderpriority FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS value
    UNION ALL SELECT 'o_custkey', (SELECT o_custkey::VARCHAR AS k FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    """,
)
def most_frequent_values(spark, sf):
    modes = most_frequent(table(spark, sf, "orders"), ["o_orderpriority", "o_custkey"])
    return small_table(spark, list(modes.items()), "column string, value string")


@query(
    "logit_score",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, round(1 / (1 + exp(-(-1.0 + 0.04 * l_quantity - 8.0 * l_discount
      + 5.0 * l_tax + 0.3 * CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END))), 6) AS score FROM lineitem
    """,
)
def logit_score_query(spark, sf):
    line = table(spark, sf, "lineitem").withColumn(
        "returned", F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)
    )
    weights = {"l_quantity": 0.04, "l_discount": -8.0, "l_tax": 5.0, "returned": 0.3}
    return line.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(logit_score(-1.0, weights), 6).alias("score")
    )
