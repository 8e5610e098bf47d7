import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaugeworks.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows of SQL literals as a DataFrame: table("1, 'a'", "2, 'b'", names="id, x")."""

    def make(*rows: str, names: str):
        body = ", ".join(f"({r})" for r in rows)
        return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")

    return make


def rows(df, *columns):
    """Sorted tuples of a DataFrame."""
    picked = df.select(*columns) if columns else df
    return sorted([tuple(r) for r in picked.collect()], key=repr)
