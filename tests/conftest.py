from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from palate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", memory="4g", shuffle_partitions=2)
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def few_steps(monkeypatch):
    """The toy sets separate in a few steps."""
    from palate.operators import models

    monkeypatch.setattr(models, "MAX_STEPS", 15)


@pytest.fixture()
def column(spark):
    """Value of a column expression for one text."""

    def value(make, text, schema="t string"):
        from pyspark.sql import functions as F

        return spark.createDataFrame([(text,)], schema).select(make(F.col("t")).alias("v")).first()["v"]

    return value
