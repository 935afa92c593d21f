"""Per-record contract: every row gets its list of violations, and a table (or
stream) divides into admitted and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.numeric import to_number

MAX_BATCH = 1000  # fixed value: records per request


@dataclass(frozen=True)
class FieldRule:
    """One field of a record.

    ``default`` replaces an absent value only; an explicit null stays a violation
    when the field is not nullable.
    """

    name: str
    kind: str  # "number" | "enum"
    allowed: tuple[str, ...] = ()
    ge: float | None = None
    gt: float | None = None
    le: float | None = None
    one_of: tuple[float, ...] = ()
    nullable: bool = False
    required: bool = False
    default: float | str | None = None


def _violation(rule: FieldRule, bad: Column, why: str) -> Column:
    return F.when(bad, F.lit(f"{rule.name}: {why}"))


def field_violations(rule: FieldRule, c: Column, dtype=None) -> list[Column]:
    """Message-or-null columns for one field whose value is present."""
    out = []
    if not rule.nullable:
        out.append(_violation(rule, c.isNull(), "value required"))
    if rule.kind == "enum":
        wrong = c.isNotNull() & ~c.cast("string").isin(*rule.allowed)
        return [*out, _violation(rule, wrong, f"must be one of {', '.join(rule.allowed)}")]
    number = to_number(c, dtype)
    if not isinstance(dtype, NumericType):
        out.append(_violation(rule, c.isNotNull() & number.isNull(), "not a number"))
    if rule.ge is not None:
        out.append(_violation(rule, number < rule.ge, f"must be >= {rule.ge:g}"))
    if rule.gt is not None:
        out.append(_violation(rule, number <= rule.gt, f"must be > {rule.gt:g}"))
    if rule.le is not None:
        out.append(_violation(rule, number > rule.le, f"must be <= {rule.le:g}"))
    if rule.one_of:
        allowed = ", ".join(f"{v:g}" for v in rule.one_of)
        out.append(_violation(rule, ~number.isin(*rule.one_of), f"must be one of {allowed}"))
    return out


@dataclass(frozen=True)
class RecordContract:
    rules: tuple[FieldRule, ...] = field(default_factory=tuple)

    def names(self) -> list[str]:
        return [r.name for r in self.rules]


def _checked(df: DataFrame, contract: RecordContract) -> tuple[DataFrame, list[Column]]:
    """(rows with defaults for absent columns, message-or-null column per rule)."""
    present = [r for r in contract.rules if r.name in df.columns]
    absent = [r for r in contract.rules if r.name not in df.columns]
    found: list[Column] = []
    for r in present:
        found += field_violations(r, F.col(r.name), df.schema[r.name].dataType)
    found += [F.lit(f"{r.name}: field required") for r in absent if r.required]
    kinds = {"number": "double", "enum": "string"}
    return df.withColumns({r.name: F.lit(r.default).cast(kinds[r.kind]) for r in absent}), found


def _messages(found: Sequence[Column]) -> Column:
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def with_violations(df: DataFrame, contract: RecordContract, column: str = "violations") -> DataFrame:
    """Add the array of violated rules; an absent column takes the rule's default."""
    rows, found = _checked(df, contract)
    return rows.withColumn(column, _messages(found))


def admit(df: DataFrame, contract: RecordContract) -> tuple[DataFrame, DataFrame]:
    """(admitted rows, quarantined rows with their violations).

    The filter is a plain conjunction inside generated code; only quarantined rows
    build the array of messages.
    """
    rows, found = _checked(df, contract)
    valid = reduce(Column.__and__, [m.isNull() for m in found], F.lit(True))
    return rows.where(valid), rows.where(~valid).withColumn("violations", _messages(found))


def violation_counts(df: DataFrame, contract: RecordContract) -> DataFrame:
    """(violation, rows) over the whole table."""
    return (
        with_violations(df, contract)
        .select(F.explode("violations").alias("violation"))
        .groupBy("violation")
        .agg(F.count("*").alias("rows"))
    )


# --- batches of records ------------------------------------------------------


def batch_size_violation(batch: Column, maximum: int = MAX_BATCH) -> Column:
    """Message when a request carries no record or more than ``maximum``."""
    n = F.coalesce(F.size(batch), F.lit(0))
    return F.when(n < 1, F.lit("batch: at least 1 record")).when(
        n > maximum, F.lit(f"batch: at most {maximum} records")
    )


def explode_batches(
    df: DataFrame, request: str, batch: str, maximum: int = MAX_BATCH
) -> tuple[DataFrame, DataFrame]:
    """((request, position, record) of the admitted requests, rejected requests with ``violation``)."""
    violation = batch_size_violation(F.col(batch), maximum)
    admitted = df.where(violation.isNull()).select(request, F.posexplode(batch).alias("position", "record"))
    return admitted, df.where(violation.isNotNull()).withColumn("violation", violation)


def rollup_batches(scored: DataFrame, request: str, prediction: str = "prediction") -> DataFrame:
    """(request, count, approved_count); partial sums collapse before the shuffle."""
    return scored.groupBy(request).agg(
        F.count("*").alias("count"), F.sum(F.col(prediction).cast("long")).alias("approved_count")
    )


# The record contract of the loan-application instance.
LOAN_RECORD = RecordContract(
    (
        FieldRule("Gender", "enum", allowed=("Male", "Female"), nullable=True),
        FieldRule("Married", "enum", allowed=("Yes", "No"), nullable=True),
        FieldRule("Dependents", "enum", allowed=("0", "1", "2", "3+"), nullable=True),
        FieldRule("Education", "enum", allowed=("Graduate", "Not Graduate"), required=True),
        FieldRule("Self_Employed", "enum", allowed=("Yes", "No"), nullable=True),
        FieldRule("ApplicantIncome", "number", ge=0, le=1_000_000, required=True),
        FieldRule("CoapplicantIncome", "number", ge=0, le=1_000_000, default=0.0),
        FieldRule("LoanAmount", "number", gt=0, le=1_000, nullable=True),
        FieldRule("Loan_Amount_Term", "number", ge=12, le=480, nullable=True),
        FieldRule("Credit_History", "number", ge=0, le=1, one_of=(0.0, 1.0), nullable=True),
        FieldRule("Property_Area", "enum", allowed=("Urban", "Semiurban", "Rural"), required=True),
    )
)

# Bounds of a served decision.
DECISION_RECORD = RecordContract(
    (
        FieldRule("loan_status", "enum", allowed=("Approved", "Rejected"), required=True),
        FieldRule("approval_probability", "number", ge=0, le=1, required=True),
        FieldRule("threshold", "number", ge=0, le=1, required=True),
    )
)
