"""Token budgets, selections and joins across arms.

The budget operators are extensions: they are described for users of such corpora, not
part of the rewriting pipeline itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.order import running_sum


def fill_budget(rows: DataFrame, tokens: Column, budget: int, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    """Rows in `order` until their tokens reach `budget` (within each of `keys`); the last may overshoot."""
    return running_sum(rows, tokens, order, "tokens_before", keys).filter(F.col("tokens_before") < budget)


def budget_report(rows: DataFrame, kept: DataFrame, tokens: Column, score: Column) -> DataFrame:
    """One row: kept rows and tokens, the share kept, and the cutoff score."""
    sides = rows.select(F.lit(False).alias("_kept"), tokens.alias("_tokens"), score.alias("_score")).unionByName(kept.select(F.lit(True).alias("_kept"), tokens.alias("_tokens"), score.alias("_score")))
    own = F.col("_kept")
    both = sides.agg(
        F.count_if(~own).alias("n_rows"), F.sum(F.when(~own, F.col("_tokens"))).alias("total_tokens"), F.count_if(own).alias("n_kept"), F.coalesce(F.sum(F.when(own, F.col("_tokens"))), F.lit(0)).alias("kept_tokens"), F.min(F.when(own, F.col("_score"))).alias("cutoff")
    )
    return both.withColumn("kept_pct", F.when(F.col("total_tokens") > 0, F.col("kept_tokens") * 100.0 / F.col("total_tokens")).otherwise(0.0))


def token_prefix(rows: DataFrame, tokens: Column, budgets: list[int], order: list[Column]) -> DataFrame:
    """Add in_<budget> for nested prefixes of one order: a smaller budget's rows are in every larger one."""
    held = running_sum(rows, tokens, order, "tokens_before")
    return held.withColumns({f"in_{b}": F.col("tokens_before") < b for b in budgets})


def remainder(rows: DataFrame, core: DataFrame, tokens: Column, budget: int, order: list[Column], keys: list[str] | None = None) -> DataFrame:
    """A budget fill of what the core doesn't hold."""
    return fill_budget(rows.join(core.select("doc_id").distinct(), "doc_id", "left_anti"), tokens, budget, order, keys)


def selection_order(kind: str, score: str = "score", other: str | None = None, seed: int = 42) -> list[Column]:
    """The orders in which a remainder is taken: best quality, greatest disagreement of two scores, or uniform draws.

    A stratified selection is a quality order within `keys`. Ties go by id.
    """
    if kind == "quality":
        return [F.col(score).desc(), F.col("doc_id")]
    if kind == "disagreement":
        if other is None:
            raise ValueError("a disagreement needs two scores")
        return [F.abs(F.col(score) - F.col(other)).desc(), F.col("doc_id")]
    if kind == "uniform":
        return [F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string"))), F.col("doc_id")]
    raise ValueError(f"{kind!r} is no selection order")


def assemble_passes(first: DataFrame, second: DataFrame, tokens: Column, budget: int, order: list[Column]) -> DataFrame:
    """All status-2 rows of the first pass, topped up from the second in `order`."""
    both = first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2))).filter("status = 2")
    return fill_budget(both, tokens, budget, [F.col("pass"), *order])


def copies_histogram(rows: DataFrame) -> DataFrame:
    """How many documents have how many rows."""
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("copies")).groupBy("copies").agg(F.count(F.lit(1)).alias("n_docs"))


def duplicate_rate(rows: DataFrame, key: str = "record_id") -> DataFrame:
    """One row: rows, distinct keys, and the share of rows beyond the first of their key."""
    per = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    out = per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"))
    return out.withColumn("dup_pct", F.when(F.col("n_rows") > 0, (F.col("n_rows") - F.col("n_distinct")) * 100.0 / F.col("n_rows")).otherwise(0.0))


def join_source(output: DataFrame, source: DataFrame, columns: list[str]) -> DataFrame:
    """Upstream columns back onto an arm's output, by doc_id; columns named like the output's get src_."""
    named = source.select(F.col("doc_id").alias("_id"), *(F.col(c).alias(f"src_{c}" if c in output.columns else c) for c in columns))
    return output.join(named, F.col("doc_id") == F.col("_id"), "left").drop("_id")


def repair_by_record(output: DataFrame, master: DataFrame) -> DataFrame:
    """Find ids again by record_id and text hash. record_id alone repeats, and would fan out."""
    once = master.groupBy("record_id", "source_text_sha1").agg(F.min("doc_id").alias("repaired_doc_id"))
    return output.join(once, ["record_id", "source_text_sha1"], "left")


def record_fanout(output: DataFrame, master: DataFrame) -> DataFrame:
    """One row: the rows that joining on record_id alone would give, beside the rows there are."""
    a = output.groupBy("record_id").agg(F.count(F.lit(1)).alias("n"))
    b = master.groupBy("record_id").agg(F.count(F.lit(1)).alias("m"))
    return a.join(b, "record_id").agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") * F.col("m")).alias("n_joined"))


def reassemble(core: DataFrame, rest: DataFrame) -> DataFrame:
    """Core and remainder as one corpus, by name, each row marked."""
    return core.withColumn("is_core", F.lit(True)).unionByName(rest.withColumn("is_core", F.lit(False)))


def arm_overlap(arms: dict[str, DataFrame]) -> DataFrame:
    """Documents that each pair of arms shares (small dimension by few arms: one pass over all ids)."""
    tagged = None
    for name, df in sorted(arms.items()):
        own = df.select("doc_id", F.lit(name).alias("arm")).distinct()
        tagged = own if tagged is None else tagged.unionByName(own)
    held = tagged.groupBy("doc_id").agg(F.array_sort(F.collect_set("arm")).alias("arms"))
    pairs = F.flatten(F.transform("arms", lambda a: F.transform(F.filter("arms", lambda b: a < b), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return held.select(F.explode(pairs).alias("p")).groupBy(F.col("p.a").alias("arm_a"), F.col("p.b").alias("arm_b")).agg(F.count(F.lit(1)).alias("n_shared"))
