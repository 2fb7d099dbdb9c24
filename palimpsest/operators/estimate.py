"""Estimates of size, time and capacity from job dimensions and shard records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import human_time

# Bytes a token and a row take on disk, and compression's share.
BYTES_PER_TOKEN, BYTES_PER_ROW, ZSTD_SHARE = 4.2, 297, 0.30
#: Prompt tokens for each output token that the whole run expects.
EXPECTED_MIX = 720.0 / 261.5


def job_dimension(spark, arms) -> DataFrame:
    """arm, prompt_id, docs, source_tokens, ratio, est_output_tokens: one row for each job."""
    rows = [(a.name, p, a.docs, a.source_tokens, r, int(a.source_tokens * r)) for a in arms for p, r in zip(a.prompts, a.ratios)]
    return spark.createDataFrame(rows, "arm string, prompt_id string, docs long, source_tokens long, ratio double, est_output_tokens long")


def corpus_totals(jobs: DataFrame) -> DataFrame:
    arms = jobs.groupBy("arm").agg(F.max("docs").alias("docs"), F.max("source_tokens").alias("source_tokens"), F.count(F.lit(1)).alias("n"), F.sum("est_output_tokens").alias("tokens"))
    return arms.agg(F.sum("n").alias("n_jobs"), F.sum(F.col("docs") * F.col("n")).alias("est_rows"), F.sum("source_tokens").alias("source_tokens"), F.sum("tokens").alias("est_output_tokens"))


def rollup(jobs: DataFrame, manifests: DataFrame) -> DataFrame:
    """Per arm: what its manifest counted beside what its jobs expect."""
    arms = jobs.groupBy("arm").agg(F.count(F.lit(1)).alias("n_jobs"), F.sum("est_output_tokens").alias("est_output_tokens"), F.max("source_tokens").alias("source_tokens"))
    return manifests.select("arm", "total_rows", "total_text_bytes", "n_shards", "content_sha1").join(arms, "arm", "left")


def disk_estimate(jobs: DataFrame) -> DataFrame:
    """Raw and compressed bytes of each job's output."""
    raw = F.col("est_output_tokens") * F.lit(BYTES_PER_TOKEN) + F.col("docs") * F.lit(BYTES_PER_ROW)
    return jobs.select("arm", "prompt_id", raw.alias("raw_bytes"), (raw * F.lit(ZSTD_SHARE)).alias("zstd_bytes"))


def throughput(stats: DataFrame, min_shards: int = 1) -> DataFrame:
    """Measured rates over records that have a duration; no row under `min_shards` of them."""
    timed = stats.filter(F.coalesce("elapsed_s", F.lit(0.0)) != 0)
    out = timed.agg(
        F.count(F.lit(1)).alias("shards"),
        (F.sum("n_output_tokens") / F.sum("elapsed_s")).alias("tok_s_per_gpu"),
        (F.sum("n_output_tokens") / F.greatest(F.lit(1), F.sum("n_rows_out"))).alias("tok_per_doc"),
        (F.sum("n_prompt_tokens") / F.sum("elapsed_s")).alias("in_tok_s_per_gpu"),
        (F.sum("n_prompt_tokens") / F.greatest(F.lit(1), F.sum("n_rows_out"))).alias("in_tok_per_doc"),
        F.count_distinct("host").alias("hosts"),
        F.array_join(F.array_sort(F.collect_set("gpu_name")), ",").alias("cards"),
        F.sum("elapsed_s").alias("_s"),
    )
    return out.filter((F.col("shards") >= min_shards) & (F.col("_s") > 0)).drop("_s")


def prefill_mix(rates: DataFrame) -> DataFrame:
    """Prompt tokens for each output token, and whether that is within a quarter of what is expected."""
    mix = F.when(F.col("tok_per_doc") > 0, F.col("in_tok_per_doc") / F.col("tok_per_doc")).otherwise(0.0)
    return rates.select(mix.alias("mix"), (F.abs(mix - F.lit(EXPECTED_MIX)) / F.lit(EXPECTED_MIX) < 0.25).alias("as_expected"))


def project(jobs: DataFrame, tokens_per_second: float, gpus: int) -> DataFrame:
    """Hours of each job at a rate for each GPU, and as text."""
    hours = F.col("est_output_tokens") / F.lit(tokens_per_second * gpus) / 3600
    return jobs.select("arm", "prompt_id", "docs", "est_output_tokens", (F.col("est_output_tokens") / F.col("docs")).alias("tok_per_doc"), hours.alias("hours"), human_time(hours).alias("wall"))


def sensitivity(projected: DataFrame) -> DataFrame:
    """Total hours at half, the same and double speed, on 1, 5, 10 and 25 nodes."""
    total = projected.agg(F.sum("hours").alias("total"))
    cells = total.select("total", F.explode(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0))).alias("speed")).select("total", "speed", F.explode(F.array(*map(F.lit, (1, 5, 10, 25)))).alias("nodes"))
    return cells.select("speed", "nodes", (F.col("total") / F.col("speed") / F.col("nodes")).alias("hours"))


def cross_check(jobs: DataFrame, measured_tok_per_doc: float) -> DataFrame:
    """Measured over predicted tokens a document; fine between a half and two."""
    ratio = F.lit(measured_tok_per_doc) / (F.col("est_output_tokens") / F.col("docs"))
    return jobs.select("arm", "prompt_id", ratio.alias("ratio"), ratio.between(0.5, 2.0).alias("ok"))


def gpu_ceiling(jobs: DataFrame, target_rows: int = 5000, min_ratio: int = 20) -> DataFrame:
    """GPUs each arm's shards can keep busy; the least of them binds."""
    arms = jobs.groupBy("arm").agg(F.max("docs").alias("docs"))
    shards = F.ceil(F.col("docs") / target_rows)
    return arms.select("arm", shards.alias("n_shards"), F.floor(shards / min_ratio).alias("max_gpus"))


def headroom(jobs: DataFrame, needed: int) -> DataFrame:
    """What each arm's jobs make beyond the tokens needed."""
    made = jobs.groupBy("arm").agg(F.sum("est_output_tokens").alias("produced"))
    return made.select("arm", "produced", (F.col("produced") / F.lit(needed) - 1).alias("headroom"))


def progress(stats: DataFrame, total_rows: int) -> DataFrame:
    """Rows done, rates over the time recorded, and the seconds left at them."""
    done = stats.agg(F.coalesce(F.sum("n_rows_out"), F.lit(0)).alias("rows_done"), F.coalesce(F.sum("n_output_tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("elapsed_s"), F.lit(0.0)).alias("seconds"))
    rate = F.when(F.col("seconds") > 0, F.col("rows_done") / F.col("seconds"))
    return done.select("rows_done", rate.alias("docs_s"), F.when(F.col("seconds") > 0, F.col("tokens") / F.col("seconds")).alias("tok_s"), ((F.lit(total_rows) - F.col("rows_done")) / rate).alias("eta_s"))
