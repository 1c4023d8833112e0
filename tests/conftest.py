import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for p in Path(SF).iterdir():
        c.sql(f"CREATE VIEW {p.name.split('.')[0]} AS SELECT * FROM '{p}'")
    return c


def rows_of(rows, columns):
    """Rows as sorted tuples, with doubles rounded, columns by name."""
    order = sorted(columns)
    plain = lambda v: float(f"{v:.10g}") if isinstance(v, float) else v
    return sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in rows), key=repr)


@pytest.fixture(scope="session")
def compare(spark, duck):
    """Runs a query and its SQL on the smallest tables and compares all rows."""

    def run(query, sql):
        df = query(spark, SF)
        got = rows_of([tuple(r) for r in df.collect()], df.columns)
        found = duck.execute(sql)
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(found.fetchall(), columns)

    return run
