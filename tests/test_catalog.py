import duckdb
import pytest
from pyspark.sql import functions as F

from palimpsest.operators import audit
from palimpsest.plans import fixtures as fx
from palimpsest.plans.catalog import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(same, name):
    same(name, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("rows", [1, 2])
def test_deep_audit_matches_sql_where_the_extra_record_meets_a_shard(spark, tmp_path, rows):
    """with 1,000 shards and more, the record of shard 999 that is one too many stands beside its own."""
    size = -(-fx.TARGET_BYTES // rows)
    spark.range(1_003 * rows).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), size).alias("text")).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["audit_deep"](spark, str(tmp_path)).select("shard_index", "n_rows_out", "counted").collect())
    with duckdb.connect() as own:
        own.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
        want = sorted(own.execute(f"select shard_index, n_rows_out, counted from ({ORACLES['audit_deep']})").fetchall())
    assert got == want and (999, 1, 0) in got and ((999, 1, rows) in got) == (rows != 1)


def test_deep_count_of_repeated_records(spark):
    rows = spark.createDataFrame([(s,) for s in (0, 0, 1, 1, 2, None)], "shard_index int")
    stats = spark.createDataFrame([(0, 2), (0, 2), (1, 5), (1, 3), (2, 1), (2, 0), (4, 7), (4, 7), (5, 0), (None, 1)], "shard_index int, n_rows_out long")
    got = sorted(map(repr, map(tuple, audit.deep_count(rows, stats).collect())))
    assert got == sorted(map(repr, [(0, 2, 0), (1, 3, 2), (1, 5, 2), (1, 5, 0), (2, 0, 1), (4, 7, 0), (4, 7, 0), (None, 1, 0), (None, -1, 1)]))


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
