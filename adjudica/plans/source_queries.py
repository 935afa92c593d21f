"""Catalogue: CSV and JSON edges, run log, synthetic applications."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..operators.admission import FieldRule, RecordContract
from ..session import work_dir
from ..sources import payloads, reports, runlog, runs, synth, tables
from .registry import ORACLES, query, table


@query(
    "csv_roundtrip",
    """
    SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment,
      CASE WHEN c_acctbal >= 3000 THEN c_acctbal END AS balance, c_name || ', "' || c_nationkey || '"' AS note FROM customer
    """,
)
def csv_roundtrip(spark, sf):
    """Write with header, read with an explicit schema; gaps come back as NULL."""
    src = table(spark, sf, "customer").select(
        "c_custkey",
        F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("N/A")).alias("segment"),
        F.when(F.col("c_acctbal") >= 3000, F.col("c_acctbal")).alias("balance"),
        F.concat("c_name", F.lit(', "'), "c_nationkey", F.lit('"')).alias("note"),
    )
    path = work_dir(spark, "csv")
    tables.write_csv(src, path)
    schema = StructType(
        [
            StructField("c_custkey", LongType()),
            StructField("segment", StringType()),
            StructField("balance", DoubleType()),
            StructField("note", StringType()),
        ]
    )
    return tables.read_csv(spark, path, schema)


_REPORT_SCHEMA = "name string, rows long, range struct<low double, high double>, flags array<string>"


def _report_aggs():
    return [
        F.count("*").alias("rows"),
        F.struct(F.min("l_quantity").alias("low"), F.max("l_quantity").alias("high")).alias("range"),
        F.array_sort(F.collect_set("l_returnflag")).alias("flags"),  # three flags
    ]


def _report_columns(df):
    return df.select(
        "name", "rows", "range.high", "range.low", F.array_join("flags", ",").alias("flags")
    )


@query(
    "report_document",
    """
    SELECT 'all' AS name, count(*) AS rows, max(l_quantity) AS high, min(l_quantity) AS low,
      string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem
    """,
)
def report_document(spark, sf):
    """A one-row nested report as an indented document, read back."""
    report = table(spark, sf, "lineitem").agg(F.lit("all").alias("name"), *_report_aggs())
    path = work_dir(spark, "report")
    reports.write_report(report, path)
    return _report_columns(reports.read_report(spark, path, _REPORT_SCHEMA))


@query(
    "report_lines",
    """
    SELECT l_linestatus AS name, count(*) AS rows, max(l_quantity) AS high, min(l_quantity) AS low,
      string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags FROM lineitem GROUP BY 1
    """,
)
def report_lines(spark, sf):
    """A report table, one document per line."""
    report = table(spark, sf, "lineitem").groupBy(F.col("l_linestatus").alias("name")).agg(*_report_aggs())
    path = work_dir(spark, "report")
    reports.write_report(report, path, lines=True)
    return _report_columns(reports.read_report(spark, path, _REPORT_SCHEMA, lines=True))


@query(
    "json_payloads",
    """
    SELECT event_id, '{"event_type":"' || event_type || '"' || CASE WHEN value > 50 THEN '' ELSE ',"value":' || value::VARCHAR END
      || ',"user_id":' || user_id || '}' AS payload FROM events
    """,
)
def json_payloads(spark, sf):
    """Null fields are left out of the body."""
    src = table(spark, sf, "events").select(
        "event_id", "event_type", F.when(F.col("value") <= 50, F.col("value")).alias("value"), "user_id"
    )
    return payloads.to_payloads(src, ["event_type", "value", "user_id"]).select("event_id", "payload")


PAYLOAD_RECORD = RecordContract(
    (
        FieldRule("kind", "enum", allowed=("view", "click", "error", "signup"), required=True),
        FieldRule("user", "number", ge=1, le=120, required=True),
        FieldRule("value", "number", gt=0, le=100, nullable=True),
        FieldRule("bonus", "number", ge=0, le=1, default=0.0),
    )
)


@query(
    "json_admission",
    """
    WITH base AS (SELECT event_id, event_type AS e, user_id AS u, value AS v FROM events),
    lists AS (SELECT event_id, e, u, v, list_filter(CASE e
      WHEN 'view' THEN [CASE WHEN u < 1 THEN 'user: must be >= 1' END, CASE WHEN u > 120 THEN 'user: must be <= 120' END,
        CASE WHEN v > 100 THEN 'value: must be <= 100' END]
      WHEN 'click' THEN [CASE WHEN u < 1 THEN 'user: must be >= 1' END, CASE WHEN u > 120 THEN 'user: must be <= 120' END,
        'bonus: value required']
      WHEN 'error' THEN ['kind: must be one of view, click, error, signup', CASE WHEN u < 1 THEN 'user: must be >= 1' END,
        CASE WHEN u > 120 THEN 'user: must be <= 120' END, 'bonus: must be <= 1']
      WHEN 'signup' THEN ['kind: field required', CASE WHEN u < 1 THEN 'user: must be >= 1' END,
        CASE WHEN u > 120 THEN 'user: must be <= 120' END, 'value: not a number']
      ELSE ['body: not a JSON object'] END, lambda x: x IS NOT NULL) AS bad FROM base)
    SELECT event_id, CASE WHEN e IN ('view', 'click') THEN e WHEN e = 'error' THEN '7' END AS kind,
      CASE WHEN e <> 'purchase' THEN u::DOUBLE END AS "user", CASE WHEN e = 'view' THEN v END AS value,
      CASE WHEN e IN ('view', 'signup') THEN 0.0 WHEN e = 'error' THEN 2.0 END::DOUBLE AS bonus,
      array_to_string(bad, '; ') AS reasons
    FROM lists
    """,
)
def json_admission(spark, sf):
    """Absent, null, mistyped and malformed bodies are told apart."""
    u, v = F.col("user_id").cast("string"), F.col("value").cast("string")
    body = (
        F.when(
            F.col("event_type") == "view",
            F.concat(F.lit('{"kind":"view","user":'), u, F.lit(',"value":'), v, F.lit(',"other":[1]}')),
        )
        .when(
            F.col("event_type") == "click",
            F.concat(F.lit('{"kind":"click","user":'), u, F.lit(',"bonus":null}')),
        )
        .when(
            F.col("event_type") == "error",
            F.concat(F.lit('{"kind":7,"user":"'), u, F.lit('","value":null,"bonus":2}')),
        )
        .when(
            F.col("event_type") == "signup",
            F.concat(F.lit('{"user":'), u, F.lit(',"value":"abc"}')),
        )
        .otherwise('{"kind":"purchase", "user":')
    )
    src = table(spark, sf, "events").select("event_id", body.alias("body"))
    parsed = payloads.from_payloads(src, "body", PAYLOAD_RECORD, ["event_id"])
    return parsed.select(
        "event_id", "kind", "user", "value", "bonus", F.array_join("violations", "; ").alias("reasons")
    )


_RUNS = """
    child AS (SELECT l_suppkey AS parent, l_linenumber AS ordinal, round(avg(l_discount), 4) AS score
      FROM lineitem GROUP BY 1, 2)"""


def run_log(spark, sf):
    """Suppliers as training runs, line numbers as their candidates."""
    scores = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_linenumber")
        .agg(F.round(F.avg("l_discount"), 4).alias("score"))
    )
    parent = F.concat(F.lit("run-"), F.col("l_suppkey").cast("string"))
    return scores.select(
        F.concat(parent, F.lit("-"), F.col("l_linenumber").cast("string")).alias("run_id"),
        parent.alias("parent_run_id"),
        F.col("l_linenumber").alias("ordinal"),
        F.concat(F.lit("candidate-"), F.col("l_linenumber").cast("string")).alias("name"),
        F.lit(None).cast("timestamp").alias("started_at"),
        F.create_map(F.lit("model_type"), F.lit("candidate")).alias("params"),
        F.create_map(F.lit("cv_mean"), F.col("score")).alias("metrics"),
        F.create_map(F.lit("stage"), F.lit("model_training")).alias("tags"),
    )


@query(
    "run_log_best",
    f"""
    WITH {_RUNS}
    SELECT 'run-' || parent AS parent_run_id, 'run-' || parent || '-' || ordinal AS run_id,
      'candidate-' || ordinal AS name, score FROM (
        SELECT *, row_number() OVER (PARTITION BY parent ORDER BY score DESC, ordinal) AS rn FROM child) WHERE rn = 1
    """,
)
def run_log_best(spark, sf):
    """Appended to the run table, read back, best candidate per run."""
    path = work_dir(spark, "runs")
    runs.append_runs(run_log(spark, sf), path)
    return runs.best_runs(spark.read.parquet(path), "cv_mean")


@query("run_log_atomic", ORACLES["run_log_best"])
def run_log_atomic(spark, sf):
    """Runs committed to the log, and the same runs again with a child that fails: the log keeps the first write alone."""
    folder = work_dir(spark, "run-log")
    found = run_log(spark, sf)
    runlog.append_run(found, folder)
    lost = F.when(F.col("ordinal") == 1, F.raise_error(F.lit("this child is lost"))).otherwise(F.col("name"))
    try:
        runlog.append_run(found.withColumn("name", lost), folder)
    except (PySparkException, Py4JJavaError):
        pass
    return runs.best_runs(runlog.read_runs(spark, folder), "cv_mean")


@query(
    "fold_summary",
    """
    WITH f AS (SELECT l_linestatus AS name, l_linenumber AS fold, avg(l_discount) AS score FROM lineitem GROUP BY 1, 2)
    SELECT name, round(avg(score), 6) AS cv_mean, round(stddev_pop(score), 6) AS cv_std FROM f GROUP BY 1
    """,
)
def fold_summary(spark, sf):
    folds = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_linestatus").alias("name"), F.col("l_linenumber").alias("fold"))
        .agg(F.avg("l_discount").alias("score"))
    )
    out = runs.fold_summary(folds, ["name"], "score")
    return out.withColumns({"cv_mean": F.round("cv_mean", 6), "cv_std": F.round("cv_std", 6)})


def _uniform(purpose: str) -> str:
    return f"(('0x' || substr(md5(c_custkey::VARCHAR || '|{purpose}|42'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def _normal(purpose: str) -> str:
    return f"(sqrt(-2 * ln(1 - {_uniform(purpose + '.r')})) * cos(2 * pi() * {_uniform(purpose + '.a')}))"


def _choice(u: str, weights: dict) -> str:
    out, upto, values = "CASE", 0.0, list(weights)

    def lit(v):
        return f"'{v}'" if isinstance(v, str) else f"{v}::DOUBLE"

    for v in values[:-1]:
        upto = round(upto + weights[v], 10)
        out += f" WHEN {u} < {upto}::DOUBLE THEN {lit(v)}"
    return f"{out} ELSE {lit(values[-1])} END"


def _gap(c: str) -> str:
    return f"CASE WHEN {_uniform('missing.' + c)} >= 0.04::DOUBLE THEN {c} END AS {c}"


_CHOICES = ", ".join(f"{_choice(_uniform(c), w)} AS {c}" for c, w in synth.CATEGORY_WEIGHTS.items())
_SYNTH = f"""
    WITH a AS (SELECT c_custkey, {_CHOICES}, {_choice(_uniform('term'), synth.TERM_WEIGHTS)} AS Loan_Amount_Term,
      {_choice(_uniform('history'), synth.HISTORY_WEIGHTS)} AS Credit_History,
      round(exp(8.4 + 0.55 * {_normal('income')}))::BIGINT AS ApplicantIncome FROM customer),
    b AS (SELECT *, CASE WHEN Married = 'Yes' AND {_uniform('co')} < 0.7::DOUBLE
      THEN round(exp(7.6 + 0.7 * {_normal('coincome')})) ELSE 0.0::DOUBLE END AS CoapplicantIncome FROM a),
    c AS (SELECT *, round(least(greatest((ApplicantIncome + CoapplicantIncome)
      * (0.010 + 0.035 * {_uniform('amount')}), 15.0::DOUBLE), 700.0::DOUBLE)) AS LoanAmount FROM b),
    d AS (SELECT *, -1.15 + 3.30 * Credit_History + 0.45 * (Education = 'Graduate')::INT
      + 0.30 * (Property_Area = 'Semiurban')::INT - 0.25 * (Property_Area = 'Rural')::INT + 0.20 * (Married = 'Yes')::INT
      - 0.20 * (Self_Employed = 'Yes')::INT + 0.55 * ln(1 + (ApplicantIncome + CoapplicantIncome) / 5000.0::DOUBLE)
      - 1.45 * (LoanAmount / greatest(Loan_Amount_Term / 12, 1)) / greatest((ApplicantIncome + CoapplicantIncome) / 1000.0::DOUBLE, 0.1)
      - 0.15 * (Dependents = '3+')::INT + 0.45 * {_normal('noise')} AS logit FROM c)
    SELECT 'LP' || (1000000 + c_custkey) AS Loan_ID, {', '.join(_gap(c) for c in ('Gender', 'Married', 'Dependents'))},
      Education, {_gap('Self_Employed')}, ApplicantIncome, CoapplicantIncome, {_gap('LoanAmount')},
      {_gap('Loan_Amount_Term')}, {_gap('Credit_History')}, Property_Area,
      CASE WHEN {_uniform('label')} < 1 / (1 + exp(-logit)) THEN 'Y' ELSE 'N' END AS Loan_Status FROM d"""


@query("synth_loans", _SYNTH)
def synth_loans(spark, sf):
    """One labelled application per customer."""
    return synth.loan_applications(table(spark, sf, "customer"), "c_custkey")


