import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adjudica.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, "adjudica-tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("work"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def loans(spark):
    """400 synthetic applications with 5 % gaps, label encoded."""
    from adjudica.operators.labels import encode_target
    from adjudica.sources.synth import generate_loan_dataset

    raw = generate_loan_dataset(spark, 400, 0.05, 7)
    return encode_target(raw, "Loan_Status").persist()
