from __future__ import annotations

import datetime as dt
import os
import sys
from contextlib import contextmanager

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from agora.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session("local[4]", app_name="agora-tests", shuffle_partitions=4,
                            extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def rows(df, *cols):
    """Collected rows as tuples (in the order given), sorted."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, str(v)) for v in t))


@pytest.fixture(scope="session")
def shop(spark):
    from tests.fixtures import shop_pipeline
    return shop_pipeline(spark)


@contextmanager
def conf(spark, **settings):
    """Set runtime SQL settings for a block and restore them after."""
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
