"""The registered queries' job table: small limits, so that every status and rule occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.text import length_tokenizer
from palimpsest.operators.generate import mock_generator, rewrite
from palimpsest.operators.prompts import assemble
from palimpsest.operators.sharding import cut, ordered
from palimpsest.plans.jobs import STYLE_END, STYLES, Arm, ChatTemplate, JobTable, Limits, PromptSpec
from palimpsest.runtime import table

LIMITS = Limits(max_model_len=4096, max_tokens=512)
CHAT = ChatTemplate()
TARGET_ROWS, TARGET_BYTES, ROWS_PER_FILE, BUCKETS, SEED = 50, 60_000, 137, 16, 42
PROMPT_TOKENS, OUTPUT_TOKENS = length_tokenizer(1), length_tokenizer(0)
WIKI = PromptSpec("wiki", "grounded", "wiki", "Put this document into the plain words of an encyclopedia and add nothing to it.\n\nDocument:\n[TEXT]", input_drop=3840)
DISTILL = PromptSpec("distill", "grounded", "distill", "Shorten this document but keep its facts.\n\nDocument:\n[TEXT]\n\nShort form:\n")
STYLED = PromptSpec("styled", "wrap_multi", "wrap", styles={s: f"Say this passage again in the {s} style.{STYLE_END}" for s in STYLES}, input_drop=3840)
JOBS = JobTable([Arm("every", "every", ("wiki", "distill")), Arm("even", "even", ("styled",))], {p.name: p for p in (WIKI, DISTILL, STYLED)}, LIMITS, target_rows=TARGET_ROWS, target_bytes=TARGET_BYTES)


def library_path() -> str:
    """A public vocabulary as a tokenizers library file; production passes its model's own."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with a record id that repeats where the text does."""
    h = F.md5("text")
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return table(spark, sf_dir, "documents").withColumn("record_id", F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">")))


def arm(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Overlapping arms: all documents, even ids, and those labelled good."""
    docs = corpus(spark, sf_dir)
    if name == "even":
        return docs.filter("doc_id % 2 = 0")
    if name == "good":
        return docs.join(table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id", "left_semi")
    return docs


def sharded(spark: SparkSession, sf_dir: str, name: str = "every") -> DataFrame:
    return cut(ordered(arm(spark, sf_dir, name)), TARGET_ROWS, TARGET_BYTES)


def rewritten(spark: SparkSession, sf_dir: str, prompt: PromptSpec, with_shards: bool = False) -> DataFrame:
    """A job's output under the mock generator; styles go round by id."""
    docs = arm(spark, sf_dir, "even" if prompt is STYLED else "every")
    style = None
    if prompt is STYLED:
        docs, style = docs.withColumn("style", F.element_at(F.array(*map(F.lit, STYLES)), (F.pmod(F.floor(F.col("doc_id") / 2), F.lit(4)) + 1).cast("int"))), "style"
    if with_shards:
        docs = docs.join(sharded(spark, sf_dir, "even" if prompt is STYLED else "every").select("doc_id", "shard_index"), "doc_id")
    made = assemble(docs, prompt, LIMITS, CHAT, PROMPT_TOKENS, style_col=style)
    return rewrite(made, "even" if prompt is STYLED else "every", prompt.name, mock_generator, OUTPUT_TOKENS, style_col=style)
