import pytest

from rentrank.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Values of a Column function over a list of single values."""

    def run(function, values, kind="string"):
        rows = list(enumerate(values))
        frame = spark.createDataFrame(rows, f"n int, v {kind}")
        found = frame.select("n", function(frame["v"]).alias("r")).collect()
        return [row.r for row in sorted(found, key=lambda row: row.n)]

    return run
