"""Admission and scoring of a stream of applications, with the batch functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.admission import RecordContract
from ..operators.features import Roles, add_engineered_features
from ..operators.models import predict
from ..sources.payloads import from_payloads


def score_payloads(
    stream: DataFrame,
    payload: str,
    contract: RecordContract,
    model: PipelineModel,
    amount_fill: float,
    roles: Roles = Roles(),
    keep: Sequence[str] = (),
    threshold: float = 0.5,
    model_name: str = "unknown",
    run_id: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(scored decisions, quarantined payloads). ``amount_fill`` is the median of the
    training table: a stream has no batch of its own to take one from."""
    parsed = from_payloads(stream, payload, contract, keep)
    valid = F.size("violations") == 0
    featured = add_engineered_features(
        parsed.where(valid).drop("violations"), roles, fill=amount_fill
    )
    scored = predict(model, featured, threshold, model_name, run_id)
    return scored, parsed.where(~valid).select(*keep, "violations")
