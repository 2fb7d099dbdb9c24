"""Prompt assembly, admission by length, and the seeded style draw."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import Tokenizer, drop_threshold, filled, output_allowance
from palimpsest.plans.jobs import PLACEHOLDER, STYLES, ChatTemplate, Limits, PromptSpec
from palimpsest.runtime import ship

BASE_SEED = 42


def draw_styles(shard_index: int, n_rows: int, seed: int = BASE_SEED) -> list[str]:
    """The styles of a shard's rows: one vectorised draw, seeded by (seed, shard) alone."""
    if n_rows < 0:
        raise ValueError(f"a shard can't have {n_rows} rows")
    return [STYLES[k] for k in np.random.default_rng([seed, shard_index]).integers(0, len(STYLES), size=n_rows)]


def with_styles(sharded: DataFrame, seed: int = BASE_SEED) -> DataFrame:
    """doc_id, shard_index, row_in_shard and wrap_style, row by row as `draw_styles` gives them.

    Only ids and row numbers reach Python; a shard is a group of bounded size.
    """
    ship(sharded.sparkSession)

    def draw(part: pd.DataFrame) -> pd.DataFrame:
        styles = np.array(draw_styles(int(part["shard_index"].iloc[0]), int(part["row_in_shard"].max()) + 1, seed))
        return part.assign(wrap_style=styles[part["row_in_shard"].to_numpy()])

    return sharded.select("doc_id", "shard_index", "row_in_shard").groupBy("shard_index").applyInPandas(draw, "doc_id long, shard_index int, row_in_shard long, wrap_style string")


def unknown_styles(styled: DataFrame) -> DataFrame:
    """Styles in the data that no prompt defines, with their rows."""
    return styled.filter(~F.coalesce(F.col("wrap_style"), F.lit("")).isin(*STYLES)).groupBy("wrap_style").agg(F.count(F.lit(1)).alias("n_rows"))


def content(prompt: PromptSpec, text: Column, style: Column | None = None) -> Column:
    """The user message: the document in the prompt's place, or behind its style's text.

    A row whose style the prompt doesn't have stops the job with the style's name.
    """
    if prompt.mode == "grounded":
        return F.replace(F.lit(prompt.text), F.lit(PLACEHOLDER), filled(text))
    if style is None:
        raise ValueError("a styled prompt needs a style for each row")
    lead = F.raise_error(F.concat(F.lit(f"prompt {prompt.name} has no style "), F.coalesce(style, F.lit("null")))).cast("string")
    for name, words in prompt.styles.items():
        lead = F.when(style == name, F.lit(words)).otherwise(lead)
    return F.concat(lead, filled(text))


def assemble(docs: DataFrame, prompt: PromptSpec, limits: Limits, chat: ChatTemplate, tokenizer: Tokenizer, text_col: str = "text", style_col: str | None = None) -> DataFrame:
    """Add final_prompt, n_prompt_tokens, drop_threshold, admitted and max_new_tokens.

    No row is dropped: a document over the threshold is marked, not removed.
    """
    if style_col and prompt.mode == "grounded":
        raise ValueError("a grounded prompt takes no styles")
    final = F.concat(F.lit(chat.prefix), content(prompt, F.col(text_col), F.col(style_col) if style_col else None), F.lit(chat.suffix))
    threshold, _ = drop_threshold(F.lit(prompt.input_drop).cast("int"), limits.max_tokens, limits.max_model_len)
    out = docs.withColumn("final_prompt", final).withColumn("n_prompt_tokens", tokenizer.count(F.col("final_prompt"))).withColumn("drop_threshold", threshold)
    return out.withColumn("admitted", F.col("n_prompt_tokens") <= F.col("drop_threshold")).withColumn("max_new_tokens", output_allowance(F.col("n_prompt_tokens"), limits.max_tokens, limits.max_model_len))


def prompt_overheads(spark, prompts: list[PromptSpec], chat: ChatTemplate, tokenizer: Tokenizer) -> DataFrame:
    """Tokens of each prompt text around an empty document, beside what its spec expects."""
    rows = []
    for p in prompts:
        for style, text in p.styles.items() if p.mode != "grounded" else [("", p.text.replace(PLACEHOLDER, ""))]:
            rows.append((p.name, style, chat.prefix + text + chat.suffix, p.overheads.get(style)))
    df = spark.createDataFrame(rows, "prompt_id string, style string, final_prompt string, expected int")
    return df.withColumn("overhead", tokenizer.count(F.col("final_prompt"))).withColumn("ok", F.col("expected").isNull() | (F.col("overhead") == F.col("expected"))).drop("final_prompt")


def prompt_users(spark, jobs: list[tuple[str, PromptSpec]]) -> DataFrame:
    """Each distinct prompt text with how many jobs use it and which."""
    rows = [(f"{arm}__{p.name}{'/' + s if s else ''}", t) for arm, p in jobs for s, t in (p.styles.items() if p.styles else [("", p.text)])]
    df = spark.createDataFrame(rows, "user string, text string")
    return df.groupBy("text").agg(F.count(F.lit(1)).alias("n_users"), F.array_join(F.array_sort(F.collect_list("user")), ",").alias("users"))
