import pytest

from tickloom import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def hot_limit(spark):
    """Make groups of more than a few rows count as hot."""
    spark.conf.set("tickloom.maxGroupRows", "5")
    yield 5
    spark.conf.unset("tickloom.maxGroupRows")


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
