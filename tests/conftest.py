import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = os.environ.get("FAIRLEAD_TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    """DuckDB over the smallest tables."""
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for p in Path(small).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def rows_of(names, rows):
    """Rows as sorted tuples of text, doubles to nine places, columns by name."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    show = lambda v: repr(round(v, 9)) if isinstance(v, float) else v.isoformat() if hasattr(v, "isoformat") else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def same_as_sql(spark, duck, small):
    def check(query, sql):
        df = query(spark, small)
        got = duck.execute(sql)
        names = [d[0] for d in got.description]
        assert sorted(names) == sorted(df.columns)
        assert rows_of(df.columns, df.collect()) == rows_of(names, got.fetchall())

    return check
