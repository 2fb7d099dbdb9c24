import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('checkpoints')}")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """DuckDB over the smallest tables."""
    import duckdb

    connection = duckdb.connect()
    for name in os.listdir(f"{TESTDATA}/sf0.001"):
        connection.execute(f"create view {name.removesuffix('.parquet')} as select * from read_parquet('{TESTDATA}/sf0.001/{name}')")
    return connection


@pytest.fixture(scope="session")
def same(spark, duck, tmp_path_factory):
    """Compare a query with its SQL as multisets of rows."""

    def compare(name, run, sql):
        path = str(tmp_path_factory.mktemp("out") / name)
        df = run(spark, f"{TESTDATA}/sf0.001")
        df.write.parquet(path)
        columns = ", ".join(f'"{c}"' for c in sorted(df.columns))
        duck.execute(f"create or replace temp table want as {sql}")
        duck.execute(f"create or replace temp table got as select * from read_parquet('{path}/*.parquet')")
        for a, b in (("want", "got"), ("got", "want")):
            assert duck.execute(f"select {columns} from {a} except all select {columns} from {b} limit 3").fetchall() == []

    return compare
