"""What the optimizer makes of the plans: narrow scans, native rules, no cross joins."""

import re

import pytest

from palimpsest.plans import fixtures as fx
from palimpsest.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,columns", [("corpus_profile", {"lang", "source", "text"}), ("text_identity", {"doc_id", "lang", "text"}), ("wiki_admission", {"doc_id", "text"}), ("copies_histogram", {"doc_id"})])
def test_scans_read_only_what_is_needed(spark, name, columns):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(QUERIES[name](spark, SF)))
    assert read and all({c.split(":")[0] for c in r.split(",")} <= columns for r in read)


@pytest.mark.parametrize("name", ["trim_wiki", "trim_distill", "trim_wrap", "rewrite_wiki", "text_identity", "wiki_admission", "shard_stats", "audit_problems"])
def test_native_queries_run_no_python(spark, name):
    shown = plan(QUERIES[name](spark, SF))
    assert not re.search("Python|Pandas|Arrow", shown) and "CartesianProduct" not in shown


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [" in plan(fx.arm(spark, SF, "even")) or "EqualTo" in plan(fx.arm(spark, SF, "even"))
    shown = plan(spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").select("doc_id"))
    assert "EqualTo(quality,1)" in shown and "toxic" not in shown


def test_trimming_adds_no_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["trim_wrap"](spark, SF))


@pytest.mark.parametrize("rows_per_range", [1 << 20, 50])
def test_ordering_reads_texts_in_as_many_tasks_as_the_scan(spark, monkeypatch, rows_per_range):
    """Hashes are written by the scan's own tasks; only ids, digests and sizes are put in order."""
    from palimpsest.operators import order, sharding

    monkeypatch.setattr(order, "ROWS_PER_RANGE", rows_per_range)
    written = []
    monkeypatch.setattr(order, "materialize", lambda df, name: written.append(plan(df)) or __import__("palimpsest.runtime").runtime.materialize(df, name))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shown = plan(sharding.cut(sharding.ordered(docs), 10))
    assert "sha1" in written[0] and not re.search("Exchange|Coalesce 1", written[0])
    assert not any("text#" in p for p in [*written[1:], shown])
