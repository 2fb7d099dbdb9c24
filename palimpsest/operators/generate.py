"""The generator seam: admitted rows are generated, all rows come out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.text import Tokenizer, filled, status_code, text_sha1
from palimpsest.functions.trim import LEAK_ANCHOR
from palimpsest.plans.jobs import OUTPUT_KEYS
from palimpsest.runtime import ship


class Generator(Protocol):
    """Adds rewritten_text, finish_reason and n_output_tokens; what it gives rows that aren't `admitted` is ignored."""

    def __call__(self, rows: DataFrame) -> DataFrame: ...


def batch_generator(load: Callable[[], Callable[[list[str], list[int]], list[tuple[str, str | None, int]]]]) -> Generator:
    """A model behind Arrow batches: loaded once in a task, only if an admitted row arrives, and given no other rows."""

    def generate(rows: DataFrame) -> DataFrame:
        ship(rows.sparkSession)
        names = rows.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for b in batches:
                wanted = [k for k, ok in enumerate(b.column("admitted").to_pylist()) if ok]
                made: list[tuple[str, str | None, int]] = [("", "", 0)] * b.num_rows
                if wanted:
                    model = model or load()
                    asked = b.take(pa.array(wanted))
                    found = model(asked.column("final_prompt").to_pylist(), asked.column("max_new_tokens").to_pylist())
                    if len(found) != len(wanted):
                        raise ValueError(f"{len(found)} outputs for {len(wanted)} prompts")
                    for k, one in zip(wanted, found):
                        made[k] = one
                cols = [pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.string()), pa.array([m[2] for m in made], pa.int32())]
                yield pa.RecordBatch.from_arrays([*b.columns, *cols], [*names, "rewritten_text", "finish_reason", "n_output_tokens"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        return rows.mapInArrow(run, f"{schema}, rewritten_text string, finish_reason string, n_output_tokens int")

    return generate


def mock_text(doc_id: Column, text: Column) -> Column:
    """A stand-in rewrite whose beginning depends on the id: all trim rules meet their cases."""
    body = F.concat(F.lit("REWRITTEN body "), doc_id.cast("string"), F.lit(" "), F.substring(filled(text), 1, 200))
    lead = (
        F.when(doc_id % 5 == 0, F.lit("Here is a paraphrased version:\n\n"))
        .when(doc_id % 5 == 1, F.lit("Here is the rewritten passage:\n\n"))
        .when(doc_id % 5 == 2, F.lit("### Paraphrased Version\n\n"))
        .when((doc_id % 5 == 3) & (doc_id % 3 == 0), F.lit(LEAK_ANCHOR + " explicitly stated.\n\n"))
        .when((doc_id % 5 == 3) & (doc_id % 3 == 1), F.lit("**Condensed Version:**\n"))
        .when(doc_id % 5 == 3, F.lit("### Case Summary\n\n"))
        .otherwise(F.lit(""))
    )
    return F.concat(lead, body)


def mock_generator(rows: DataFrame) -> DataFrame:
    """A native generator for tests: a function of id and text alone."""
    made = rows.withColumn("rewritten_text", mock_text(F.col("doc_id"), F.col("text")))
    made = made.withColumn("finish_reason", F.when(F.col("doc_id") % 11 == 0, F.lit("length")).otherwise(F.lit("stop")))
    return made.withColumn("n_output_tokens", F.greatest(F.lit(1), F.floor(F.length("rewritten_text") / 4)).cast("int"))


def rewrite(assembled: DataFrame, arm: str, prompt_id: str, generator: Generator, output_tokens: Tokenizer, keys: list[str] | None = None, style_col: str | None = None) -> DataFrame:
    """One output row for every input row, with the declared columns in order.

    All rows pass the generator once, so prompts are assembled and counted once; it generates
    for admitted rows alone. Others, those without a count included, get status 0 and empty
    results.
    """
    keys = keys or OUTPUT_KEYS
    ok = F.col("admitted")
    rows = generator(assembled.withColumn("admitted", F.coalesce(ok, F.lit(False))))
    rows = rows.withColumns({"rewritten_text": F.when(ok, filled(F.col("rewritten_text"))).otherwise(""), "finish_reason": F.when(ok, F.coalesce("finish_reason", F.lit(""))).otherwise(""), "n_output_tokens": F.when(ok, F.col("n_output_tokens")).otherwise(0)})
    columns = {
        "doc_id": F.col("doc_id").cast("long"),
        "record_id": F.col("record_id") if "record_id" in assembled.columns else F.lit(None).cast("string"),
        "arm": F.lit(arm),
        "prompt_id": F.lit(prompt_id),
        "source_text_sha1": text_sha1(F.col("text")),
        "rewritten_text": F.col("rewritten_text"),
        "finish_reason": F.col("finish_reason"),
        "n_prompt_tokens": F.col("n_prompt_tokens").cast("int"),
        "n_output_tokens": F.col("n_output_tokens").cast("int"),
        "status": status_code(F.col("admitted"), F.col("finish_reason")),
        "n_output_tokens_llama2": F.when(F.col("admitted"), output_tokens.count(F.col("rewritten_text"))).otherwise(F.lit(0)).cast("int"),
        "wrap_style": F.col(style_col) if style_col else F.lit(""),
    }
    extra = [c for c in ("shard_index", "row_in_shard") if c in assembled.columns]
    return rows.select(*(columns[k].alias(k) for k in keys), *extra)
