"""Catalogue: data contract, record admission, duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import admission, contracts
from ..operators.admission import FieldRule, RecordContract
from ..operators.contracts import ColumnSpec, Contract
from ..session import work_dir
from .registry import query, table

CUSTOMER_CONTRACT = Contract(
    (
        ColumnSpec("c_acctbal", "numeric", minimum=0, maximum=9000),
        ColumnSpec("segment", "categorical", allowed=("AUTOMOBILE", "FURNITURE", "HOUSEHOLD"), nullable=True),
        ColumnSpec("balance_gap", "numeric", minimum=-2000, nullable=False),
        ColumnSpec("c_phone", "categorical"),
    )
)

_CUSTOMER_SRC = """
    src AS (SELECT c_custkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS segment,
      CASE WHEN c_acctbal < 3000 THEN NULL ELSE c_acctbal END AS balance_gap FROM customer)"""


def gaps_in(customers):
    return customers.select(
        "c_custkey",
        "c_acctbal",
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 3000, F.col("c_acctbal")).alias("balance_gap"),
    )


def customer_view(spark, sf):
    return gaps_in(table(spark, sf, "customer"))


def report_rows(report):
    """Numeric observations as numbers, listings as text: engine-neutral columns."""
    number = F.round(F.col("observed").try_cast("double"), 4)
    return report.select(
        F.coalesce("column", F.lit("-")).alias("column"),
        "check",
        number.alias("observed_value"),
        F.when(number.isNull(), F.col("observed")).alias("observed_text"),
        "ok",
        "message",
    )


@query(
    "contract_report",
    f"""
    WITH {_CUSTOMER_SRC},
    n AS (SELECT count(*) AS n, count(*) FILTER (c_acctbal IS NULL) AS n1, min(c_acctbal) AS lo, max(c_acctbal) AS hi,
      avg(c_acctbal) AS mean, count(*) FILTER (segment IS NULL) AS n2,
      count(*) FILTER (balance_gap IS NULL) AS n3, min(balance_gap) AS lo3, max(balance_gap) AS hi3,
      avg(balance_gap) AS mean3 FROM src),
    seen AS (SELECT DISTINCT segment AS v FROM src WHERE segment IS NOT NULL),
    odd AS (SELECT v FROM seen WHERE v NOT IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')),
    dup AS (SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM src)) AS d FROM src)
    SELECT '-' AS "column", 'min_rows' AS "check", n::DOUBLE AS observed_value, NULL::VARCHAR AS observed_text,
      n >= 2000000000 AS ok, n || ' rows, 2000000000 or more are needed' AS message FROM n
    UNION ALL SELECT '-', 'columns', 4, NULL, true, NULL
    UNION ALL SELECT '-', 'duplicate_rows', d, NULL, true, NULL FROM dup
    UNION ALL SELECT 'c_acctbal', 'missing_fraction', round(n1 / n, 4), NULL, true, NULL FROM n
    UNION ALL SELECT 'c_acctbal', 'nulls', n1, NULL, true, NULL FROM n
    UNION ALL SELECT 'c_acctbal', 'non_numeric', 0, NULL, true, NULL
    UNION ALL SELECT 'c_acctbal', 'minimum', round(lo, 4), NULL, lo >= 0,
      CASE WHEN lo < 0 THEN '''c_acctbal'': smallest value is under 0' END FROM n
    UNION ALL SELECT 'c_acctbal', 'maximum', round(hi, 4), NULL, hi <= 9000,
      CASE WHEN hi > 9000 THEN '''c_acctbal'': largest value is over 9000' END FROM n
    UNION ALL SELECT 'c_acctbal', 'mean', round(mean, 4), NULL, true, NULL FROM n
    UNION ALL SELECT 'segment', 'missing_fraction', round(n2 / n, 4), NULL, n2 / n <= 0.15,
      CASE WHEN n2 / n > 0.15 THEN printf('''segment'': %.1f%% of the values are missing, at most 15%% may be', 100 * n2 / n) END FROM n
    UNION ALL SELECT 'segment', 'observed_values', (SELECT count(*) FROM seen), NULL, true, NULL
    UNION ALL SELECT 'segment', 'unexpected_values', (SELECT count(*) FROM odd), NULL, (SELECT count(*) = 0 FROM odd),
      (SELECT '''segment'': ' || count(*) || ' values are not allowed' FROM odd HAVING count(*) > 0)
    UNION ALL SELECT 'segment', 'unexpected_value', NULL, v, false, '''segment'': ''' || v || ''' is not allowed' FROM odd
    UNION ALL SELECT 'balance_gap', 'missing_fraction', round(n3 / n, 4), NULL, n3 / n <= 0.15,
      CASE WHEN n3 / n > 0.15 THEN printf('''balance_gap'': %.1f%% of the values are missing, at most 15%% may be', 100 * n3 / n) END FROM n
    UNION ALL SELECT 'balance_gap', 'nulls', n3, NULL, n3 = 0,
      CASE WHEN n3 > 0 THEN '''balance_gap'': nulls are not allowed' END FROM n
    UNION ALL SELECT 'balance_gap', 'non_numeric', 0, NULL, true, NULL
    UNION ALL SELECT 'balance_gap', 'minimum', round(lo3, 4), NULL, true, NULL FROM n
    UNION ALL SELECT 'balance_gap', 'maximum', round(hi3, 4), NULL, true, NULL FROM n
    UNION ALL SELECT 'balance_gap', 'mean', round(mean3, 4), NULL, true, NULL FROM n
    UNION ALL SELECT 'c_phone', 'present', NULL, 'absent', false, '''c_phone'': required, but absent'
    """,
)
def contract_report(spark, sf):
    report = contracts.contract_report(
        customer_view(spark, sf), CUSTOMER_CONTRACT, min_rows=2_000_000_000, count_duplicates=True
    )
    return report_rows(report)


_TARGETS = """
    WITH src AS (
      SELECT 'quality' AS dataset, quality AS y FROM labels
      UNION ALL SELECT 'toxic', toxic FROM labels
      UNION ALL SELECT 'gaps', CASE WHEN toxic = 1 THEN NULL ELSE quality END FROM labels
      UNION ALL SELECT 'wrong', quality + toxic * 7 FROM labels),
    n AS (SELECT dataset, count(*) FILTER (y IS NULL) AS nulls,
      count(*) FILTER (y IS NOT NULL AND y NOT IN (0, 1)) AS bad, avg(y) AS rate FROM src GROUP BY 1)
    SELECT dataset, 'target_nulls' AS "check", nulls::DOUBLE AS observed_value, nulls = 0 AS ok,
      CASE WHEN nulls > 0 THEN 'label has nulls' END AS message FROM n
    UNION ALL SELECT dataset, 'target_values', bad, bad = 0,
      CASE WHEN bad > 0 THEN 'label has values besides 0 and 1' END FROM n
    UNION ALL SELECT dataset, 'positive_rate', CASE WHEN bad = 0 THEN round(rate, 4) END,
      bad > 0 OR rate BETWEEN 0.25 AND 0.75,
      CASE WHEN bad = 0 AND rate NOT BETWEEN 0.25 AND 0.75
        THEN printf('share of positive labels %.2f%% is outside of [25%%, 75%%]', rate * 100) END FROM n"""


@query("contract_target", _TARGETS)
def contract_target(spark, sf):
    """Label rules over several named tables in one combined report."""
    labels = table(spark, sf, "labels")
    quality, toxic = F.col("quality"), F.col("toxic")
    splits = {
        "quality": labels.select(quality.alias("y")),
        "toxic": labels.select(toxic.alias("y")),
        "gaps": labels.select(F.when(toxic != 1, quality).alias("y")),
        "wrong": labels.select((quality + toxic * 7).alias("y")),
    }
    report = contracts.validate_splits(splits, Contract(), target="y", target_balance=(0.25, 0.75))
    return report.where(F.col("column") == "y").select(
        "dataset",
        "check",
        F.round(F.col("observed").try_cast("double"), 4).alias("observed_value"),
        "ok",
        "message",
    )


@query(
    "contract_errors",
    """
    SELECT 'labels: ' || count(*) || ' rows, 2000000000 or more are needed; ''doc_id'': smallest value is under '
      || '1000000000; ''lang'': required, but absent; ''grade'': the label column is absent' AS message FROM labels
    """,
)
def contract_errors(spark, sf):
    """All broken rules of a table in one error: rows, a bound, a missing column and a missing label."""
    contract = Contract((ColumnSpec("doc_id", "numeric", minimum=10**9), ColumnSpec("lang", "categorical")))
    try:
        contracts.validate_frame(
            table(spark, sf, "labels"), contract, dataset="labels", target="grade", min_rows=2_000_000_000
        )
        message = "none"
    except contracts.ContractViolation as broken:
        message = str(broken)
    return spark.createDataFrame([(message,)], "message string")


@query(
    "observed_categories",
    """
    SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS rows, o_orderstatus IN ('O', 'F') AS allowed
    FROM orders GROUP BY 2
    UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*), true FROM orders GROUP BY 2
    """,
)
def observed_categories(spark, sf):
    spec = Contract(
        (
            ColumnSpec("o_orderstatus", "categorical", allowed=("O", "F")),
            ColumnSpec("o_orderpriority", "categorical"),
        )
    )
    return contracts.observed_categories(table(spark, sf, "orders"), spec)


@query(
    "duplicate_rows",
    """
    SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents)) AS distinct_rows,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents)) AS duplicate_rows
    FROM documents
    """,
)
def duplicate_rows(spark, sf):
    return contracts.duplicate_rows(table(spark, sf, "documents").select("lang", "source", "text"))


ORDER_RECORD = RecordContract(
    (
        FieldRule("status", "enum", allowed=("O", "F"), nullable=True),
        FieldRule("o_orderpriority", "enum", allowed=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"), required=True),
        FieldRule("o_totalprice", "number", ge=5000, le=400_000, required=True),
        FieldRule("scaled", "number", gt=0, le=1000, nullable=True),
        FieldRule("flag", "number", ge=0, le=1, one_of=(0.0, 1.0), nullable=True),
        FieldRule("discount", "number", ge=0, le=1, default=0.0),
    )
)

_ORDER_SRC = """
    src AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status, o_orderpriority, o_totalprice,
      CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE (o_custkey % 1003) * 1.0 END AS scaled,
      CASE o_orderstatus WHEN 'O' THEN 0.0 WHEN 'F' THEN 0.5 END AS flag FROM orders),
    hits AS (SELECT o_orderkey, list_filter([
      CASE WHEN status NOT IN ('O', 'F') THEN 'status: must be one of O, F' END,
      CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
        THEN 'o_orderpriority: must be one of 1-URGENT, 2-HIGH, 3-MEDIUM, 5-LOW' END,
      CASE WHEN o_totalprice < 5000 THEN 'o_totalprice: must be >= 5000' END,
      CASE WHEN o_totalprice > 400000 THEN 'o_totalprice: must be <= 400000' END,
      CASE WHEN scaled <= 0 THEN 'scaled: must be > 0' END,
      CASE WHEN scaled > 1000 THEN 'scaled: must be <= 1000' END,
      CASE WHEN flag NOT IN (0.0, 1.0) THEN 'flag: must be one of 0, 1' END],
      lambda x: x IS NOT NULL) AS violations FROM src)"""


def order_records(spark, sf):
    key = F.col("o_custkey")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        "o_orderpriority",
        "o_totalprice",
        F.when(key % 10 != 0, (key % 1003).cast("double")).alias("scaled"),
        F.when(F.col("o_orderstatus") == "O", 0.0).when(F.col("o_orderstatus") == "F", 0.5).alias("flag"),
    )


@query(
    "row_admission",
    f"""
    WITH {_ORDER_SRC}
    SELECT o_orderkey, 0.0::DOUBLE AS discount FROM hits WHERE len(violations) = 0
    """,
)
def row_admission(spark, sf):
    """Admitted keys; the absent ``discount`` takes its default."""
    admitted, _ = admission.admit(order_records(spark, sf), ORDER_RECORD)
    return admitted.select("o_orderkey", "discount")


@query(
    "quarantine",
    f"""
    WITH {_ORDER_SRC}
    SELECT o_orderkey, array_to_string(violations, '; ') AS reasons FROM hits WHERE len(violations) > 0
    """,
)
def quarantine(spark, sf):
    _, quarantined = admission.admit(order_records(spark, sf), ORDER_RECORD)
    return quarantined.select("o_orderkey", F.array_join("violations", "; ").alias("reasons"))


@query(
    "violation_counts",
    f"""
    WITH {_ORDER_SRC}
    SELECT violation, count(*) AS rows FROM (SELECT unnest(violations) AS violation FROM hits) GROUP BY 1
    """,
)
def violation_counts(spark, sf):
    return admission.violation_counts(order_records(spark, sf), ORDER_RECORD)


@query(
    "batch_explode_rollup",
    """
    SELECT vec_id, count(*) AS "count", sum((v >= 0.05)::INT)::BIGINT AS approved_count
    FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings WHERE len(embedding) BETWEEN 1 AND 1000)
    GROUP BY 1
    """,
)
def batch_explode_rollup(spark, sf):
    """Each vector is a request of records: explode, decide, roll up per request."""
    rows, _ = admission.explode_batches(table(spark, sf, "embeddings"), "vec_id", "embedding")
    decided = rows.withColumn("prediction", (F.col("record").cast("double") >= 0.05).cast("int"))
    return admission.rollup_batches(decided, "vec_id")


@query(
    "batch_rejected",
    """
    WITH b AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY 1)
    SELECT user_id, CASE WHEN n < 1 THEN 'batch: at least 1 record' ELSE 'batch: at most 1 records' END AS violation
    FROM b WHERE n < 1 OR n > 1
    """,
)
def batch_rejected(spark, sf):
    """Each user's purchases as a request of at most one record: those refused, with the reason."""
    bought = F.when(F.col("event_type") == "purchase", F.col("event_id"))
    requests = table(spark, sf, "events").groupBy("user_id").agg(F.collect_list(bought).alias("batch"))
    return admission.explode_batches(requests, "user_id", "batch", 1)[1].select("user_id", "violation")


@query(
    "response_bounds",
    """
    SELECT CASE WHEN p > 1 THEN 'approval_probability: must be <= 1' ELSE 'ok' END AS outcome, count(*) AS rows
    FROM (SELECT o_totalprice / 400000 AS p FROM orders) GROUP BY 1
    """,
)
def response_bounds(spark, sf):
    """Served decisions against their own bounds."""
    p = F.col("o_totalprice") / 400_000
    served = table(spark, sf, "orders").select(
        F.when(p >= 0.5, "Approved").otherwise("Rejected").alias("loan_status"),
        p.alias("approval_probability"),
        F.lit(0.5).alias("threshold"),
    )
    checked = admission.with_violations(served, admission.DECISION_RECORD)
    outcome = F.when(F.size("violations") == 0, F.lit("ok")).otherwise(F.array_join("violations", "; "))
    return checked.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("rows"))


_WRITTEN_SQL = f"""
    WITH {_CUSTOMER_SRC},
    n AS (SELECT count(*) AS n, count(*) FILTER (c_acctbal IS NULL) AS n1, min(c_acctbal) AS lo, max(c_acctbal) AS hi,
      avg(c_acctbal) AS mean, count(*) FILTER (segment IS NULL) AS n2,
      count(*) FILTER (segment NOT IN ('AUTOMOBILE', 'FURNITURE', 'HOUSEHOLD')) AS odd,
      count(*) FILTER (balance_gap IS NULL) AS n3, min(balance_gap) AS lo3, max(balance_gap) AS hi3,
      avg(balance_gap) AS mean3 FROM src)
    SELECT '-' AS "column", 'min_rows' AS "check", n::DOUBLE AS observed, n >= 1 AS ok FROM n
    UNION ALL SELECT '-', 'columns', 4, true
    UNION ALL SELECT 'c_phone', 'present', NULL, false
    UNION ALL SELECT 'c_acctbal', 'missing_fraction', round(n1 / n, 4), n1 / n <= 0.15 FROM n
    UNION ALL SELECT 'c_acctbal', 'nulls', n1, n1 = 0 FROM n
    UNION ALL SELECT 'c_acctbal', 'non_numeric', 0, true
    UNION ALL SELECT 'c_acctbal', 'minimum', round(lo, 4), lo >= 0 FROM n
    UNION ALL SELECT 'c_acctbal', 'maximum', round(hi, 4), hi <= 9000 FROM n
    UNION ALL SELECT 'c_acctbal', 'mean', round(mean, 4), true FROM n
    UNION ALL SELECT 'segment', 'missing_fraction', round(n2 / n, 4), n2 / n <= 0.15 FROM n
    UNION ALL SELECT 'segment', 'unexpected_rows', odd, odd = 0 FROM n
    UNION ALL SELECT 'balance_gap', 'missing_fraction', round(n3 / n, 4), n3 / n <= 0.15 FROM n
    UNION ALL SELECT 'balance_gap', 'nulls', n3, n3 = 0 FROM n
    UNION ALL SELECT 'balance_gap', 'non_numeric', 0, true
    UNION ALL SELECT 'balance_gap', 'minimum', round(lo3, 4), lo3 >= -2000 FROM n
    UNION ALL SELECT 'balance_gap', 'maximum', round(hi3, 4), true FROM n
    UNION ALL SELECT 'balance_gap', 'mean', round(mean3, 4), true FROM n"""


def _written(report):
    number = F.round(F.col("observed").try_cast("double"), 4)
    return report.select(F.coalesce("column", F.lit("-")).alias("column"), "check", number.alias("observed"), "ok")


@query("contract_on_write", _WRITTEN_SQL)
def contract_on_write(spark, sf):
    """The contract of a table, judged by the pass that writes it."""
    return _written(contracts.write_checked(customer_view(spark, sf), work_dir(spark, "checked"), CUSTOMER_CONTRACT))


@query("stream_contract_on_write", _WRITTEN_SQL)
def stream_contract_on_write(spark, sf):
    """The same on a stream: the customers arrive in one micro-batch, which is written and judged in one pass."""
    schema = table(spark, sf, "customer").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "customer.parquet").parquet(sf)
    root = work_dir(spark, "checked-stream")
    contracts.write_checked_stream(gaps_in(stream), root, f"{root}/state", CUSTOMER_CONTRACT).awaitTermination()
    found = spark.read.schema("dataset string, column string, check string, observed string, expected string, ok boolean, message string")
    return _written(found.parquet(f"{root}/report"))
