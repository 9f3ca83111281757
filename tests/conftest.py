import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillwork.session import build_session, scratch_folder  # noqa: E402
from tillwork.sources.tables import create_layers  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return scratch_folder(spark, "test")


@pytest.fixture
def layers(spark, folder):
    """Names a table in fresh databases: ``layers("silver", "t")``."""
    prefix = f"test_{uuid.uuid4().hex[:10]}_"
    create_layers(spark, folder, prefix)
    return lambda layer, table: f"{prefix}{layer}.{table}"


def rows(df, *names):
    """All rows as tuples, in a fixed order."""
    selected = df.select(*names) if names else df
    return sorted((tuple(r) for r in selected.collect()), key=repr)


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
