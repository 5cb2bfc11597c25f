from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("quire-tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def same_rows(df, relation) -> bool:
    """Equal rows, whatever their order, columns by name."""
    columns = sorted(df.columns)
    place = [relation.columns.index(c) for c in columns]
    key = lambda row: tuple((x is None, str(x)) for x in row)
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key) == sorted((tuple(r[i] for i in place) for r in relation.fetchall()), key=key)
