"""JSON request bodies to typed records and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ..functions.numeric import to_number
from ..operators.admission import FieldRule, RecordContract, field_violations


def to_payloads(df: DataFrame, columns: Sequence[str], output: str = "payload") -> DataFrame:
    """Rows plus a JSON object of the named columns, null fields left out."""
    body = F.to_json(F.struct(*columns), {"ignoreNullFields": "true"})
    return df.withColumn(output, body)


def _extracted(rule: FieldRule, document: Column, keys: Column) -> dict[str, Column]:
    """Helper columns of one field: is it present, its JSON kind, its text."""
    raw = F.try_variant_get(document, f"$.{rule.name}", "variant")
    return {
        f"__has_{rule.name}": F.array_contains(keys, rule.name),
        f"__kind_{rule.name}": F.schema_of_variant(raw),  # VOID for null, NULL when absent
        f"__text_{rule.name}": F.try_variant_get(document, f"$.{rule.name}", "string"),
    }


def _value(rule: FieldRule) -> Column:
    kind, text = F.col(f"__kind_{rule.name}"), F.col(f"__text_{rule.name}")
    if rule.kind == "enum":
        value = F.when(kind != "VOID", text)
    else:
        truth = F.when(text == "true", F.lit(1.0)).otherwise(F.lit(0.0))
        value = F.when(kind == "BOOLEAN", truth).when(kind != "VOID", to_number(text))
    if rule.default is not None:
        value = F.when(~F.col(f"__has_{rule.name}"), F.lit(rule.default)).otherwise(value)
    return F.when(F.col("__ok"), value)


def _violations(rule: FieldRule) -> list[Column]:
    has, kind = F.col(f"__has_{rule.name}"), F.col(f"__kind_{rule.name}")
    value, out = F.col(rule.name), []
    if rule.required:
        out.append(F.when(~has, F.lit(f"{rule.name}: field required")))
    if rule.kind == "enum":
        # a JSON number never equals a text choice, not even 1 for "1"
        wrong = (kind != "VOID") & (kind != "STRING")
        message = f"{rule.name}: must be one of {', '.join(rule.allowed)}"
    else:
        wrong = (kind != "VOID") & value.isNull()
        message = f"{rule.name}: not a number"
    wrong = F.coalesce(wrong, F.lit(False))
    out.append(F.when(has & wrong, F.lit(message)))
    # an absent optional field has nothing to check; an explicit null does
    dtype = StringType() if rule.kind == "enum" else DoubleType()
    return [*out, *[F.when(has & ~wrong, v) for v in field_violations(rule, value, dtype)]]


def from_payloads(
    df: DataFrame, payload: str, contract: RecordContract, keep: Sequence[str] = ()
) -> DataFrame:
    """(keep..., fields..., violations): typed records with their violations.

    Absent and null are told apart: an absent field takes its default, an explicit
    null does not. Unknown keys are ignored; a body that is no JSON object is one
    violation.
    """
    rules = contract.rules
    # each step reads the columns of the one before, so a body is parsed once
    parsed = df.select(
        *keep, F.try_parse_json(payload).alias("__doc"), F.json_object_keys(payload).alias("__keys")
    )
    helpers: dict[str, Column] = {"__ok": F.col("__keys").isNotNull() & F.col("__doc").isNotNull()}
    for rule in rules:
        helpers |= _extracted(rule, F.col("__doc"), F.col("__keys"))
    typed = parsed.select(*keep, *[c.alias(n) for n, c in helpers.items()])
    valued = typed.withColumns({rule.name: _value(rule) for rule in rules})
    found = [F.when(~F.col("__ok"), F.lit("body: not a JSON object"))]
    for rule in rules:
        found += [F.when(F.col("__ok"), v) for v in _violations(rule)]
    violations = F.array_compact(F.array(*found)).alias("violations")
    # a generator of one row: below it, a filter on the violations would take a copy of every step along
    return valued.select(*keep, F.inline(F.array(F.struct(*contract.names(), violations))))
