import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from epispan.session import build_session

    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Values of one column expression applied to literal inputs, in order."""
    def apply(values, schema, expression):
        numbered = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
        frame = spark.createDataFrame(numbered, f"_i int, {schema}")
        return [r[0] for r in frame.orderBy("_i").select(expression).collect()]

    return apply
