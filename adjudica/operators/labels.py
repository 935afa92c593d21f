"""Label encoding, decoding and decisions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Accepted spellings of the two label classes.
TARGET_MAP = {"Y": 1, "N": 0, "y": 1, "n": 0, "1": 1, "0": 0}


class UnknownLabels(ValueError):
    """The label column holds values outside the accepted spellings.

    ``table`` has every such value with its rows; the message names the most frequent.
    """

    def __init__(self, message: str, table: DataFrame):
        super().__init__(message)
        self.table = table


def encoded(c: Column, mapping: Mapping[str, int] = TARGET_MAP, numeric: bool = False) -> Column:
    """Label as an int, NULL where it is not an accepted spelling.

    Numeric labels (1, 0, 1.0) match by value.
    """
    if numeric:
        table = {float(k): v for k, v in mapping.items() if k.lstrip("-").replace(".", "", 1).isdigit()}
        c = c.cast("double")
    else:
        table = dict(mapping)
    out: Column | None = None
    for spelling, value in table.items():
        out = F.when(c == F.lit(spelling), value) if out is None else out.when(c == F.lit(spelling), value)
    return (out if out is not None else F.lit(None)).cast("int")


def _is_numeric(df: DataFrame, target: str) -> bool:
    return df.schema[target].dataType.typeName() not in ("string", "char", "varchar")


def unknown_labels(df: DataFrame, target: str, mapping: Mapping[str, int] = TARGET_MAP) -> DataFrame:
    """Distinct label values (null included) that do not encode, with their counts."""
    value = encoded(F.col(target), mapping, _is_numeric(df, target))
    return (
        df.where(value.isNull())
        .groupBy(F.col(target).cast("string").alias("value"))
        .agg(F.count("*").alias("rows"))
    )


def encode_target(
    df: DataFrame, target: str, mapping: Mapping[str, int] = TARGET_MAP, check: bool = True
) -> DataFrame:
    """Replace the label by 1/0. With ``check``, unknown or null labels raise; the error
    says how many values there are and holds the table of all of them."""
    if check:
        unknown = stored(unknown_labels(df, target, mapping), "unknown-labels")
        facts = unknown.agg(F.count(F.lit(1)).alias("values"), F.sum("rows").alias("rows")).first()
        if facts["values"]:
            frequent = [r.value for r in unknown.orderBy(F.desc("rows"), "value").limit(20).collect()]
            raise UnknownLabels(
                f"'{target}' has {facts['values']} values that are no label, in {facts['rows']} rows; most frequent: {frequent}",
                unknown,
            )
    return df.withColumn(target, encoded(F.col(target), mapping, _is_numeric(df, target)))


def decode_target(c: Column, positive: str = "Y", negative: str = "N") -> Column:
    return F.when(c == 1, F.lit(positive)).when(c == 0, F.lit(negative))


def decide(probability: Column, threshold: float = 0.5, inclusive: bool = True) -> Column:
    """1 when the probability reaches the threshold. Serving is inclusive; hold-out
    metrics use ``inclusive=False``, the strict 0.5 of a classifier's own prediction."""
    hit = probability >= threshold if inclusive else probability > threshold
    return hit.cast("int")


def decision_columns(
    df: DataFrame,
    probability: str,
    threshold: float = 0.5,
    model_name: str | Column = "unknown",
    run_id: str | Column | None = None,
    request_id: Column | None = None,
) -> DataFrame:
    """Add the response columns of a served decision."""
    p = F.col(probability)
    name = model_name if isinstance(model_name, Column) else F.lit(model_name)
    run = run_id if isinstance(run_id, Column) else F.lit(run_id).cast("string")
    version = F.when(F.coalesce(run, F.lit("")) != "", F.substring(run, 1, 8)).otherwise(F.lit("local"))
    hit = decide(p, threshold)
    return df.withColumns(
        {
            "loan_status": F.when(hit == 1, F.lit("Approved")).otherwise(F.lit("Rejected")),
            "prediction": hit,
            "approval_probability": F.round(p, 6),
            "threshold": F.lit(float(threshold)),
            "model_name": name,
            "model_version": version,
            "request_id": F.uuid() if request_id is None else request_id,
        }
    )
