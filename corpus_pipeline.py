"""A training-data pipeline: quality rules, near copies, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of the
documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.contamination import find_contamination
from palimpsest.llm.neardup import BROADCAST_IDS, fingerprint, near_duplicates
from palimpsest.llm.packing import pack_documents
from palimpsest.llm.pseudonyms import pseudonymise
from palimpsest.llm.quality import base_failed, fit, verdict, with_counts
from palimpsest.llm.queries import tokenizer_files
from palimpsest.runtime import discard, materialize, table

#: Words of a benchmark in a row that a clean document may not have; shorter items go by their share.
LEAST_RUN = 8


def _marked(docs: DataFrame) -> DataFrame:
    """The documents with every column's name marked, so that no name an operator uses is taken."""
    return docs.withColumnsRenamed({c: f"_d_{c}" for c in docs.columns})


def _unmarked(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"_d_{c}").alias(c) for c in docs.columns))


def _joinable(rows: DataFrame) -> DataFrame:
    """Rows to join whole documents with: broadcast up to a bound, so that texts stay where they are."""
    held = materialize(rows, "rows")
    return F.broadcast(held) if held.count() <= BROADCAST_IDS else held


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what neither the base rules nor the learned list rejects.

    Null and empty texts have no words and go; repeated rows and null ids are judged alike;
    an empty table stays empty.
    """
    rules = fit(docs, table(spark, sf_dir, "labels"))
    marked = _marked(docs)
    counted = with_counts(marked, marked.columns, text_col="_d_text", prefix="_q_")
    return _unmarked(counted.filter(~base_failed("_q_") & verdict(rules, "_q_")), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class, and one row of those that agree in id and text.

    Rows go by id and text, so a text isn't lost when its id has another text too. Null ids
    are compared like others; texts without words are alone in their class and stay; an empty
    table stays empty.
    """
    judged = materialize(near_duplicates(docs), "judged")
    row = ["_id", "_fp"]
    marked = _marked(docs).withColumns({"_id": F.col("_d_doc_id").cast("long"), "_fp": fingerprint(F.coalesce("_d_text", F.lit("")))})
    same = (F.col("_fp") == F.col("text_md5")) & F.col("_id").eqNullSafe(F.col("doc_id"))
    drop = _joinable(judged.filter("not kept").select("doc_id", "text_md5").distinct())
    left = marked.join(drop, same, "left_anti")
    repeated = judged.filter("kept").groupBy("doc_id", "text_md5").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    again = _joinable(repeated)
    if again.limit(1).count():
        left = left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates(row))
    return _unmarked(left, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that repeat LEAST_RUN words or more of a benchmark, or of which a twentieth does.

    A passage in a long document counts like one in a short document. Null and empty texts are
    clean and stay, repeated rows and null ids are judged alike, an empty table stays empty.
    """
    marked = _marked(docs)
    found = find_contamination(marked, table(spark, sf_dir, "benchmark"), marked.columns, text_col="_d_text")
    return _unmarked(found.filter((F.col("longest_hit") < LEAST_RUN) & ~F.col("contaminated")), docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put pseudonyms in place of validated personal values, and count the characters anew.

    Null texts stay null, empty ones empty; repeated rows and null ids are treated like
    others; an empty table stays empty.
    """
    marked = _marked(docs)
    hidden = _unmarked(pseudonymise(marked, marked.columns, text_col="_d_text", counts=False), docs)
    return hidden.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else hidden


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048: one row for each piece of a document.

    Null and empty texts are one piece of the end id alone; repeated rows and ids are packed
    like others; an empty table gives an empty result.
    """
    return pack_documents(docs, *tokenizer_files())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("hide_personal_data", hide_personal_data),
    ("pack", pack),
]

#: The stages learn, hash and search; SQL can't express them. Tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what one returns is written and reread for the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
            discard(before)
    return docs
