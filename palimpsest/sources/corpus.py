"""Reading arms, shards and rows; writing shards, rows and records."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.functions.text import shard_number
from palimpsest.plans.jobs import OUTPUT_KEYS
from palimpsest.runtime import materialize

#: Types of the output columns.
OUTPUT_TYPES: dict[str, T.DataType] = {
    "doc_id": T.LongType(), "record_id": T.StringType(), "arm": T.StringType(), "prompt_id": T.StringType(), "source_text_sha1": T.StringType(),
    "rewritten_text": T.StringType(), "finish_reason": T.StringType(), "n_prompt_tokens": T.IntegerType(), "n_output_tokens": T.IntegerType(),
    "status": T.ByteType(), "n_output_tokens_llama2": T.IntegerType(), "wrap_style": T.StringType(),
}
STATS_SCHEMA = "shard_index int, job_id string, worker_id int, host string, n_rows_in long, n_rows_out long, input_fingerprint string, status_0 long, status_1 long, status_2 long, n_prompt_tokens long, n_output_tokens long, n_output_tokens_llama2 long, elapsed_s double, gpu_name string, finished_at long"


def output_schema(keys: list[str] | None = None) -> T.StructType:
    """The declared output columns in order; an undeclared one is a string."""
    return T.StructType([T.StructField(k, OUTPUT_TYPES.get(k, T.StringType())) for k in keys or OUTPUT_KEYS])


def read_arm(spark: SparkSession, root: str, subdir: str, columns: list[str] | None = None) -> DataFrame:
    """One arm by its own folder's files alone, and only the columns asked for."""
    df = spark.read.option("recursiveFileLookup", "false").parquet(f"{root.rstrip('/')}/{subdir.strip('/')}/*.parquet")
    return df.select(*columns) if columns else df


def read_shards(spark: SparkSession, path: str, shard: int | None = None) -> DataFrame:
    """Shards written by `write_shards`; one alone prunes the others' folders."""
    df = spark.read.parquet(path)
    return df if shard is None else df.filter(F.col("shard_index") == shard)


def scan_order(df: DataFrame) -> DataFrame:
    """Add `ord`, the running row number over files by path and rows within them, to a parquet scan.

    Files are counted from their footers and numbered among themselves; rows are not moved:
    a row's number is its file's start and its place in the file. Use it as the order, as the
    key to join a shard back to its texts, and as the id of an arm without one.
    """
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    counts = rows.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(1)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    starts = materialize(counts.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "file-starts")
    return rows.join(starts, "_file").withColumn("ord", F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")


def list_shards(spark: SparkSession, path: str) -> DataFrame:
    """shard_index, path, n_rows of the shards under `path`, in order; other files are left out.

    Shards are folders shard_index=N, as `write_shards` makes them, or files part_N.parquet.
    """
    files = spark.read.option("recursiveFileLookup", "true").parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
    number = F.coalesce(F.regexp_extract("file", r"/shard_index=(\d+)/[^/]*$", 1).try_cast("int"), shard_number(F.col("file")))
    held = files.select(number.alias("shard_index"), F.regexp_extract("file", r"(shard_index=\d+|part_\d+\.parquet)(/[^/]*)?$", 1).alias("path"), "n").filter("shard_index >= 0")
    return held.groupBy("shard_index", "path").agg(F.sum("n").alias("n_rows")).orderBy("shard_index")


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder for each shard, rows in order; overwriting clears what a failed run left.

    A shard is bounded by its caps, so it is one task; thousands of them spread over the cluster.
    """
    sharded.repartition("shard_index").sortWithinPartitions("shard_index", "ord").write.mode("overwrite").partitionBy("shard_index").option("compression", "zstd").parquet(path)


def write_files(placed: DataFrame, path: str) -> None:
    """Shuffled rows as files of exactly the rows their file_no says."""
    placed.repartition("file_no").sortWithinPartitions("file_no", "row_in_file").write.mode("overwrite").partitionBy("file_no").option("compression", "zstd").parquet(path)


def read_rows(spark: SparkSession, path: str, keys: list[str] | None = None) -> DataFrame:
    """JSON lines, plain or compressed, as the declared columns; a malformed line is an error."""
    return spark.read.schema(output_schema(keys)).option("mode", "FAILFAST").json(path)


def write_rows(rows: DataFrame, path: str) -> None:
    """JSON lines with every key in every row, gzipped: Spark's JSON writer has no zstd."""
    rows.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def write_shard_rows(rows: DataFrame, path: str) -> None:
    """Rows of some shards as JSON lines, a folder for each; a shard written again replaces itself alone."""
    rows.repartition("shard_index").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("shard_index").option("compression", "gzip").option("ignoreNullFields", "false").json(path)


def write_stats(stats: DataFrame, path: str) -> None:
    """Shard records, appended after the data they describe."""
    stats.coalesce(1).write.mode("append").json(path)


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Shard records; unreadable lines are left out, and of a shard's several the last counts."""
    schema = T.StructType([*T._parse_datatype_string(STATS_SCHEMA).fields, T.StructField("_corrupt", T.StringType())])
    read = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    kept = spark.read.text(path).select(read.alias("r")).select("r.*").filter("_corrupt is null and shard_index is not null").drop("_corrupt")
    return kept.groupBy("shard_index").agg(F.max_by(F.struct(*[c for c in kept.columns if c != "shard_index"]), F.coalesce("finished_at", F.lit(0))).alias("r")).select("shard_index", "r.*")


def write_manifest(manifest: DataFrame, path: str) -> None:
    """The one manifest row as JSON, written last: its presence says the shards are complete."""
    manifest.coalesce(1).write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def manifest_shards(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's shards as a table: shard_index, path, n_rows, text_bytes."""
    return spark.read.json(path).select(F.explode("shards").alias("s")).select(F.col("s.index").cast("int").alias("shard_index"), "s.path", "s.n_rows", "s.text_bytes")


def _folder(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def mark_done(spark: SparkSession, path: str, stage: str) -> None:
    """Leave `_<stage>.done` beside a stage's output, after all of it is written and checked."""
    files, marker = _folder(spark, f"{path.rstrip('/')}/_{stage}.done")
    files.create(marker, True).close()


def is_done(spark: SparkSession, path: str, stage: str) -> bool:
    files, marker = _folder(spark, f"{path.rstrip('/')}/_{stage}.done")
    return files.exists(marker)


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _folder(spark, path)
    return files.exists(folder)


def payload(spark: SparkSession, path: str) -> DataFrame:
    """path, length of the files under `path` that an export takes: no temporary, hidden or marker ones."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    return files.filter(~F.regexp_like("path", F.lit(r"(\.tmp|\.done|\.crc|/[._][^/]*)$"))).orderBy("path")


def missing_weights(spark: SparkSession, path: str) -> list[str]:
    """Weight files that a model's index names and its folder lacks; without an index, the one file there must be."""
    root = path.rstrip("/")
    if not exists(spark, f"{root}/model.safetensors.index.json"):
        return [] if exists(spark, f"{root}/model.safetensors") else ["model.safetensors"]
    index = json.loads("\n".join(r[0] for r in spark.read.text(f"{root}/model.safetensors.index.json").collect()))
    return sorted(f for f in set(index["weight_map"].values()) if not exists(spark, f"{root}/{f}"))


def write_progress(progress: DataFrame, root: str, worker: int) -> None:
    """A worker's counters in a folder of its own; the last ones replace those before."""
    progress.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/worker={worker}")


def write_summary(summary: DataFrame, root: str, job_id: str) -> None:
    """One job's summary in a folder of its own, so that concurrent jobs never meet."""
    summary.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/job_id={job_id}")


def read_summaries(spark: SparkSession, root: str) -> DataFrame:
    """All jobs' summaries as one table; whatever is there counts."""
    return spark.read.json(root)


def dataset_card(job_id: str, rows: int, tokens: int, keys: list[str]) -> str:
    """A Markdown card for an exported job."""
    lines = [f"# {job_id}", "", f"Rows: {rows:,}. Output tokens: {tokens:,}.", "", "Use rows of status 2; 0 was too long, 1 was cut off.", "", "| column |", "|---|", *(f"| {k} |" for k in keys)]
    return "\n".join(lines) + "\n"
