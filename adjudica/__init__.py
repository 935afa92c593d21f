"""Spark-native operators for the life of a tabular approve/reject decision."""

from .functions import cut_at_marker
from .operators.admission import LOAN_RECORD, FieldRule, RecordContract, admit
from .operators.contracts import (
    LOAN_CONTRACT,
    ColumnSpec,
    Contract,
    ContractViolation,
    contract_report,
    validate_frame,
    validate_splits,
)
from .operators.drift import (
    DriftProfile,
    categorical_drift,
    classify,
    detect_drift,
    drift_gate,
    fit_profile,
    population_stability_index,
)
from .operators.features import Roles, add_engineered_features, select_model_features
from .operators.labels import decode_target, encode_target
from .operators.metrics import (
    ModelQualityError,
    compute_metrics,
    confusion_matrix,
    quality_gate,
    roc_curve,
)
from .operators.models import (
    ModelNotLoadedError,
    build_candidates,
    load_model,
    predict,
    predict_proba,
    save_model,
    train_and_select,
)
from .operators.preprocess import build_preprocessor
from .operators.rewrite import rewrite_paths, rewrite_tables
from .operators.sampling import dedupe, split_dataset, stratified_folds
from .plans.stages import FlowConfig, check_drift, evaluate, ingest, run_flow, transform, validate
from .sources.synth import generate_loan_dataset

__version__ = "0.1.0"

__all__ = [n for n in dir() if not n.startswith("_")]
