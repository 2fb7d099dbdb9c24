"""Trimming rewritten rows and the statistics of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.text import Tokenizer, opening, share
from palimpsest.functions.trim import RULES


def trim_rows(rows: DataFrame, rule: str, tokenizer: Tokenizer) -> DataFrame:
    """Apply a rule to status-2 rows; add `stripped` and `tokens_before`. Other rows stay as they are.

    The raw rows are never overwritten, so applying it again to them gives the same result.
    """
    text, hit = RULES[rule](F.col("rewritten_text"))
    marked = rows.withColumn("stripped", (F.col("status") == 2) & hit).withColumn("tokens_before", F.col("n_output_tokens_llama2")).withColumn("_new", text)
    return marked.withColumn("n_output_tokens_llama2", F.when(F.col("stripped"), tokenizer.count(F.col("_new"))).otherwise(F.col("n_output_tokens_llama2"))).withColumn("rewritten_text", F.when(F.col("stripped"), F.col("_new")).otherwise(F.col("rewritten_text"))).drop("_new")


def dry_run(rows: DataFrame, rule: str, sample: int) -> DataFrame:
    """What a rule would strip among the first `sample` rows in id order."""
    first = rows.orderBy("doc_id").limit(sample)
    _, hit = RULES[rule](F.col("rewritten_text"))
    done = F.col("status") == 2
    counted = first.agg(F.count(F.lit(1)).alias("n"), F.count_if(done).alias("n_status2"), F.count_if(done & hit).alias("n_would_strip"))
    return counted.withColumn("pct", share(F.col("n_would_strip"), F.col("n_status2"), 4, 100.0))


def trim_summary(trimmed: DataFrame) -> DataFrame:
    """One row: rows, status-2 rows, stripped ones, and their tokens before and after."""
    done = F.col("status") == 2
    out = trimmed.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(done).alias("n_status2"),
        F.count_if("stripped").alias("n_stripped"),
        F.coalesce(F.sum(F.when(done, F.col("tokens_before"))), F.lit(0)).alias("tok_before"),
        F.coalesce(F.sum(F.when(done, F.col("n_output_tokens_llama2"))), F.lit(0)).alias("tok_after"),
    )
    return out.withColumn("pct_stripped", share(F.col("n_stripped"), F.col("n_status2"), 4, 100.0)).withColumn("tok_saved", F.col("tok_before") - F.col("tok_after"))


def style_summary(trimmed: DataFrame) -> DataFrame:
    """Per style, the empty one left out: counts, tokens, and shares of documents and tokens."""
    by = (
        trimmed.filter((F.col("status") == 2) & (F.col("wrap_style") != ""))
        .groupBy("wrap_style")
        .agg(F.count(F.lit(1)).alias("n_status2"), F.count_if("stripped").alias("n_stripped"), F.sum("tokens_before").alias("tok_before"), F.sum("n_output_tokens_llama2").alias("tok_after"))
    )
    # Four rows at most, so the totals are one tiny cross-row window.
    every = Window.partitionBy(F.lit(1))
    return by.select(
        "*",
        share(F.col("tok_after"), F.col("n_status2"), 1).alias("tok_per_doc"),
        share(F.col("n_status2"), F.sum("n_status2").over(every), 3, 100.0).alias("doc_share_pct"),
        share(F.col("tok_after"), F.sum("tok_after").over(every), 3, 100.0).alias("token_share_pct"),
    )


def top_openings(trimmed: DataFrame, k: int = 5) -> DataFrame:
    """The k most frequent beginnings of status-2 texts, exactly; first seen wins ties."""
    counted = trimmed.filter("status = 2").groupBy(opening(F.col("rewritten_text")).alias("opening")).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc_id"))
    return counted.orderBy(F.desc("n"), "first_doc_id").limit(k)


def sampled_openings(trimmed: DataFrame, k: int = 5, shards: int = 5) -> DataFrame:
    """The heuristic form: only the first `shards` shards, each cut to its own top k before merging."""
    key = opening(F.col("rewritten_text")).alias("opening")
    low = trimmed.select("shard_index").distinct().orderBy("shard_index").limit(shards)
    counted = trimmed.filter("status = 2").join(F.broadcast(low), "shard_index", "left_semi").groupBy("shard_index", key).agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first"))
    own = Window.partitionBy("shard_index").orderBy(F.desc("n"), "first")
    kept = counted.withColumn("_rank", F.row_number().over(own)).filter(F.col("_rank") <= k)
    merged = kept.groupBy("opening").agg(F.sum("n").alias("n"), F.min(F.struct("shard_index", "_rank")).alias("_seen"))
    return merged.orderBy(F.desc("n"), "_seen").limit(k).select("opening", "n")


def shard_stats(rows: DataFrame, job: str, fingerprint: str) -> DataFrame:
    """The record of each output shard: rows, statuses and token sums."""
    return (
        rows.groupBy("shard_index")
        .agg(
            F.count(F.lit(1)).alias("n_rows_in"),
            F.count(F.lit(1)).alias("n_rows_out"),
            *(F.count_if(F.col("status") == k).alias(f"status_{k}") for k in (0, 1, 2)),
            F.sum("n_prompt_tokens").alias("n_prompt_tokens"),
            F.sum("n_output_tokens").alias("n_output_tokens"),
            F.sum("n_output_tokens_llama2").alias("n_output_tokens_llama2"),
        )
        .select(F.lit(job).alias("job_id"), F.lit(fingerprint).alias("input_fingerprint"), "*")
    )


def style_counts(rows: DataFrame, styles: list[str]) -> DataFrame:
    """Rows of each style in each shard."""
    return rows.groupBy("shard_index").agg(*(F.count_if(F.col("wrap_style") == s).alias(f"n_{s}") for s in styles))
