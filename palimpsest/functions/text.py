"""Scalar expressions of the rewriting pipeline."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from palimpsest.runtime import ship


def filled(text: Column) -> Column:
    """Null as the empty text."""
    return F.coalesce(text, F.lit(""))


def text_sha1(text: Column) -> Column:
    """SHA-1 of the UTF-8 text; null hashes as empty."""
    return F.sha1(filled(text))


def text_bytes(text: Column) -> Column:
    return F.octet_length(filled(text)).cast("long")


def opening(text: Column, n: int = 80) -> Column:
    """The first `n` code points."""
    return F.substring(filled(text), 1, n)


def job_id(arm: Column, prompt: Column) -> Column:
    return F.concat_ws("__", arm, prompt)


def share(part: Column, whole: Column, digits: int, scale: float = 1.0) -> Column:
    """A rounded ratio; 0 where the denominator is."""
    return F.when(whole > 0, F.round(F.lit(scale) * part / whole, digits)).otherwise(F.lit(0.0))


def shard_number(name: Column) -> Column:
    """The number in part_NNNNN.parquet; -1 for other names."""
    return F.coalesce(F.regexp_extract(name, r"part_(\d+)\.parquet$", 1).try_cast("int"), F.lit(-1))


def human_time(hours: Column) -> Column:
    """Minutes under an hour, hours under two days, else days."""
    return (
        F.when(hours < 1, F.concat(F.format_string("%.0f", hours * 60), F.lit(" min")))
        .when(hours < 48, F.concat(F.format_string("%.1f", hours), F.lit(" h")))
        .otherwise(F.concat(F.format_string("%.1f", hours / 24), F.lit(" days")))
    )


def output_allowance(n_prompt: Column, max_tokens: int, max_model_len: int) -> Column:
    """Tokens a prompt may still generate, 1 at least."""
    return F.greatest(F.lit(1), F.least(F.lit(max_tokens), F.lit(max_model_len) - n_prompt))


def drop_threshold(input_drop: Column, max_tokens: int, max_model_len: int) -> tuple[Column, Column]:
    """The longest admitted prompt, and whether it was derived rather than given."""
    return F.coalesce(input_drop, F.lit(max_model_len - max_tokens)), input_drop.isNull()


def status_code(admitted: Column, finish_reason: Column) -> Column:
    """0 not generated, 1 cut off by length, 2 anything else generated."""
    return F.when(~admitted, F.lit(0)).when(F.coalesce(finish_reason, F.lit("")) == "length", F.lit(1)).otherwise(F.lit(2)).cast("byte")


@dataclass(frozen=True)
class Tokenizer:
    """Counts tokens of a text column. `count` is a column function, native or a Pandas UDF."""

    name: str
    count: Callable[[Column], Column]


def length_tokenizer(floor: int = 1) -> Tokenizer:
    """A quarter of the characters, rounded down: a native stand-in for tests and estimates."""
    return Tokenizer(f"length/4>={floor}", lambda text: F.greatest(F.lit(floor), F.floor(F.length(filled(text)) / 4)).cast("int"))


@cache
def _library(path: str):
    """A tokenizers library file, once for each Python worker, on the one core that its task has."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import tokenizers

    return tokenizers.Tokenizer.from_file(path)


def _library_counts(path: str, text: pa.Array) -> pa.Array:
    """Tokens of each text. Encoded, a text takes many times its bytes, so only one is at a time."""
    held = _library(path)
    return pa.array([len(held.encode_batch_fast([t.as_py() or ""], add_special_tokens=False)[0]) for t in text], pa.int32())


def library_tokenizer(path: str) -> Tokenizer:
    """A tokenizers library file, by Arrow batches; loaded once for each Python worker."""

    def count(text: Column) -> Column:
        @F.arrow_udf("int")
        def counts(text: pa.Array) -> pa.Array:
            return _library_counts(path, text)

        ship(SparkSession.active())
        return counts(text)

    return Tokenizer(path, count)


def check_vocabulary(path: str, size: int) -> None:
    """Refuse a tokenizers library file of another vocabulary size, before anything is counted with it."""
    import tokenizers

    found = tokenizers.Tokenizer.from_file(path).get_vocab_size()
    if found != size:
        raise ValueError(f"{path} has {found} tokens where {size} are expected")
