import json

from pyspark.sql import functions as F

from adjudica.operators import admission
from adjudica.operators.admission import LOAN_RECORD
from adjudica.sources.payloads import from_payloads, to_payloads

RULES = {r.name: r for r in LOAN_RECORD.rules}


def middle(rule):
    """A value well inside the rule."""
    if rule.kind == "enum":
        return rule.allowed[-1]
    if rule.one_of:
        return rule.one_of[-1]
    low = rule.ge if rule.ge is not None else rule.gt
    return float(int((low + rule.le) / 2))


GOOD = {name: middle(rule) for name, rule in RULES.items()}


def edge_cases():
    """(field, value, accepted): on and beyond each bound of every rule."""
    for name, rule in RULES.items():
        if rule.kind == "enum":
            yield from ((name, v, True) for v in rule.allowed)
            yield name, rule.allowed[0] + "?", False
            yield name, rule.allowed[0].swapcase() + " ", False
        elif rule.one_of:
            yield from ((name, v, True) for v in rule.one_of)
            yield name, sum(rule.one_of) / 3, False
        else:
            if rule.ge is not None:
                yield from ((name, rule.ge, True), (name, rule.ge - 0.5, False))
            if rule.gt is not None:
                yield from ((name, rule.gt + 0.5, True), (name, rule.gt, False))
            yield from ((name, rule.le, True), (name, rule.le + 0.5, False), (name, "none of it", False))
        yield name, None, rule.nullable


def parse(spark, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, body string")
    return from_payloads(df, "body", LOAN_RECORD, ["id"]).orderBy("id").collect()


def test_good_body(spark):
    row = parse(spark, GOOD)[0]
    assert row.violations == [] and row.asDict()["LoanAmount"] == GOOD["LoanAmount"] and row.Dependents == GOOD["Dependents"]


def test_bounds_of_every_rule(spark):
    cases = list(edge_cases())
    rows = parse(spark, *[{**GOOD, name: value} for name, value, _ in cases])
    for (name, value, accepted), row in zip(cases, rows):
        assert bool(row.violations) != accepted, (name, value, row.violations)
        assert all(v.startswith(f"{name}: ") for v in row.violations)


def test_absent_null_and_malformed(spark):
    absent = {k: v for k, v in GOOD.items() if k not in ("CoapplicantIncome", "Gender")}
    required = {k: v for k, v in GOOD.items() if k != "Education"}
    nulls = {**GOOD, "Gender": None, "LoanAmount": None}
    rows = parse(spark, absent, required, nulls, "{", "[1]")
    assert rows[0].CoapplicantIncome == 0.0 and rows[0].Gender is None and rows[0].violations == []
    assert rows[1].violations == ["Education: field required"]
    assert rows[2].violations == [] and rows[2].LoanAmount is None
    assert rows[3].violations == rows[4].violations == ["body: not a JSON object"]


def test_numeric_text_is_accepted(spark):
    assert parse(spark, {**GOOD, "LoanAmount": "128"})[0].LoanAmount == 128.0


def test_round_trip(spark, loans):
    bodies = to_payloads(loans, LOAN_RECORD.names(), "body")
    back = from_payloads(bodies, "body", LOAN_RECORD, ["Loan_ID"])
    assert back.where(F.size("violations") > 0).count() == 0
    same = back.join(loans.alias("l"), "Loan_ID").where(
        back["LoanAmount"].eqNullSafe(F.col("l.LoanAmount")) & back["Gender"].eqNullSafe(F.col("l.Gender"))
    )
    assert same.count() == 400


def test_admit_splits_without_loss(spark, loans):
    spoiled = loans.withColumn(
        "LoanAmount", F.when(F.col("Loan_ID").endswith("7"), 0.0).otherwise(F.col("LoanAmount"))
    )
    good, bad = admission.admit(spoiled.drop("Loan_Status"), LOAN_RECORD)
    assert good.count() + bad.count() == 400 and bad.count() == 40
    assert bad.first().violations == ["LoanAmount: must be > 0"]


def test_batch_size(spark):
    df = spark.createDataFrame([(0,), (1,), (1000,), (1001,)], "n int").select(
        F.when(F.col("n") == 0, F.array().cast("array<int>"))
        .otherwise(F.sequence(F.lit(1), F.col("n")))
        .alias("batch"),
        F.col("n").alias("id"),
    )
    admitted, rejected = admission.explode_batches(df, "id", "batch")
    assert {r["id"]: r["count"] for r in admitted.groupBy("id").count().collect()} == {1: 1, 1000: 1000}
    assert {r.id: r.violation for r in rejected.collect()} == {0: "batch: at least 1 record", 1001: "batch: at most 1000 records"}
    shown = df.select(admission.batch_size_violation(F.col("batch")).alias("v")).collect()
    assert [r.v for r in shown] == ["batch: at least 1 record", None, None, "batch: at most 1000 records"]


def test_a_filter_on_the_violations_repeats_no_step(spark):
    """Pushed below the steps, it took a copy of each along and read every body once for each rule."""
    bodies = spark.createDataFrame([(0, json.dumps(GOOD)), (1, "{}"), (2, "no object"), (3, None)], "id int, body string")
    parsed = from_payloads(bodies, "body", LOAN_RECORD, ["id"])

    def reads(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get")

    admitted, refused = [parsed.where(F.size("violations") == 0), parsed.where(F.size("violations") > 0)]
    assert reads(admitted) == reads(refused) == reads(parsed) > 0
    assert [r.id for r in admitted.collect()] == [0] and sorted(r.id for r in refused.collect()) == [1, 2, 3]
