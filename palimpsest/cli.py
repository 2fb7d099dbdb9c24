"""Command line over the library: shard, describe, rewrite, status, verify, sweep, trim, shuffle."""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.text import Tokenizer, length_tokenizer, library_tokenizer
from palimpsest.operators import audit, generate, postprocess, prompts, sharding, shuffle
from palimpsest.plans.jobs import OUTPUT_KEYS, ChatTemplate, ConfigError, JobTable, load_jobs
from palimpsest.runtime import materialize
from palimpsest.sources import corpus

#: Generators by name; a deployment adds its own.
GENERATORS: dict[str, generate.Generator] = {"mock": generate.mock_generator}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="palimpsest", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    tokenizer = argparse.ArgumentParser(add_help=False)
    tokenizer.add_argument("--tokenizer", metavar="FILE", help="a tokenizers library file to count output tokens with; a quarter of the characters if not given")
    jobs = argparse.ArgumentParser(add_help=False)
    jobs.add_argument("jobs", help="the job table as a JSON file; prompt files are read beside it")
    shard = sub.add_parser("shard", help="cut an arm into shards and write its manifest last")
    shard.add_argument("source")
    shard.add_argument("out")
    shard.add_argument("--arm", default="arm")
    shard.add_argument("--rows", type=int, default=5000)
    shard.add_argument("--bytes", type=int, default=64 << 20)
    sub.add_parser("describe", parents=[jobs], help="list the jobs of a table")
    rewrite = sub.add_parser("rewrite", parents=[jobs, tokenizer], help="generate the shards of a job that have no record of the same input yet")
    rewrite.add_argument("job")
    rewrite.add_argument("input", help="what `shard` wrote")
    rewrite.add_argument("out")
    rewrite.add_argument("--generator", choices=sorted(GENERATORS), default="mock")
    rewrite.add_argument("--worker-id", type=int, default=0)
    rewrite.add_argument("--num-workers", type=int, default=1)
    rewrite.add_argument("--limit-shards", type=int, metavar="N")
    rewrite.add_argument("--force", action="store_true", help="also shards that have a record")
    status = sub.add_parser("status", parents=[jobs], help="how far every job of a table is")
    status.add_argument("input", help="a folder with what `shard` wrote for each arm")
    status.add_argument("out", help="a folder with what `rewrite` wrote for each job")
    verify = sub.add_parser("verify", help="hold a job's records, and with --deep its rows, against its input's manifest")
    verify.add_argument("input")
    verify.add_argument("out")
    verify.add_argument("--deep", action="store_true")
    after = sub.add_parser("sweep", parents=[jobs, tokenizer], help="trim and shuffle every job that is done and wasn't yet")
    after.add_argument("input")
    after.add_argument("out")
    after.add_argument("--rows-per-file", type=int, default=500_000)
    after.add_argument("--seed", type=int, default=42)
    trim = sub.add_parser("trim", parents=[tokenizer], help="trim rewritten rows by a rule")
    trim.add_argument("rows")
    trim.add_argument("out")
    trim.add_argument("--rule", choices=["wiki", "distill", "wrap"], required=True)
    trim.add_argument("--dry-run", type=int, metavar="N", help="only report on the first N rows")
    trim.add_argument("--force", action="store_true", help="again, though it is done")
    mix = sub.add_parser("shuffle", help="write rows in a seeded order as files of equal length")
    mix.add_argument("rows")
    mix.add_argument("out")
    mix.add_argument("--rows-per-file", type=int, default=500_000)
    mix.add_argument("--seed", type=int, default=42)
    mix.add_argument("--force", action="store_true", help="again, though it is done")
    return p


def _counter(args: argparse.Namespace) -> Tokenizer:
    return library_tokenizer(args.tokenizer) if args.tokenizer else length_tokenizer(0)


def _table(args: argparse.Namespace) -> JobTable:
    beside = os.path.dirname(os.path.abspath(args.jobs))
    with open(args.jobs, encoding="utf-8") as f:
        config = json.load(f)

    def read(name: str) -> str:
        with open(os.path.join(beside, name), encoding="utf-8") as f:
            return f.read()

    return load_jobs(config, read)


def shard_arm(spark: SparkSession, source: str, out: str, arm: str, rows: int, size: int) -> None:
    """Shards in scan order with every column of the source; rows are told apart by that order, not by id."""
    docs = spark.read.parquet(source)
    audit.check_source(docs, [], path=source, out_root=out)
    numbered = corpus.scan_order(docs)
    order = materialize(sharding.cut(materialize(sharding.ordered(numbered), "order"), rows, size), "cut")
    new = [c for c in order.columns if c not in ("doc_id", "ord")]
    whole = numbered.drop("doc_id", *new).join(order, "ord")
    corpus.write_shards(whole, f"{out}/shards")
    corpus.write_manifest(sharding.manifest(order, arm, rows, size, OUTPUT_KEYS, "dataset" if "doc_id" in docs.columns else "row_index"), f"{out}/manifest")
    wrong = audit.shards_on_disk(corpus.manifest_shards(spark, f"{out}/manifest"), corpus.list_shards(spark, f"{out}/shards")).collect()
    if wrong:
        raise audit.SourceError(f"shards differ from the manifest: {[tuple(r) for r in wrong[:5]]}")


def rewrite_job(spark: SparkSession, table: JobTable, job: str, source: str, out: str, generator: generate.Generator, tokenizer: Tokenizer, worker: int = 0, workers: int = 1, limit: int | None = None, force: bool = False) -> int:
    """Generate a worker's pending shards; returns their number. Records are written after the rows they count."""
    arm, prompt = table.job(job)
    identity = corpus.read_manifest(spark, f"{source}/manifest")["fingerprint"]
    todo = audit.owned_shards(corpus.manifest_shards(spark, f"{source}/manifest"), worker, workers)
    if not force and corpus.exists(spark, f"{out}/stats"):
        todo = audit.pending_shards(todo, corpus.read_stats(spark, f"{out}/stats"), identity)
    if limit is not None:
        todo = audit.first_shards(todo, limit)
    todo = materialize(todo.select("shard_index"), "todo")
    docs = corpus.read_shards(spark, f"{source}/shards").join(todo, "shard_index", "left_semi")
    style = None
    if prompt.styles:
        style = "style"
        drawn = prompts.with_styles(docs).select("shard_index", "row_in_shard", F.col("wrap_style").alias(style))
        docs = docs.join(drawn, ["shard_index", "row_in_shard"])
    made = prompts.assemble(docs, prompt, table.limits, ChatTemplate(), tokenizer, style_col=style)
    rows = materialize(generate.rewrite(made, arm.name, prompt.name, generator, tokenizer, table.keys, style), "rows")
    corpus.write_shard_rows(rows, f"{out}/rows")
    stats = postprocess.shard_stats(rows, job, identity).withColumns({"worker_id": F.lit(worker), "finished_at": F.unix_timestamp()})
    corpus.write_stats(stats, f"{out}/stats")
    return todo.count()


def verify_job(spark: SparkSession, source: str, out: str, deep: bool = False) -> DataFrame:
    """The job's one-row state; with `deep`, shards whose counted rows differ make it PARTIAL."""
    identity = corpus.read_manifest(spark, f"{source}/manifest")["fingerprint"]
    stats = materialize(corpus.read_stats(spark, f"{out}/stats"), "stats")
    state = audit.verify_job(corpus.manifest_shards(spark, f"{source}/manifest"), stats, identity)
    if not deep:
        return state
    rows = corpus.read_rows(spark, f"{out}/rows", [*OUTPUT_KEYS, "shard_index"]).withColumn("shard_index", F.col("shard_index").cast("int"))
    wrong = audit.deep_count(rows, stats).count()
    return state.withColumn("n_miscounted", F.lit(wrong)).withColumn("state", F.when((F.col("state") == "DONE") & (F.lit(wrong) > 0), "PARTIAL").otherwise(F.col("state")))


def status_table(spark: SparkSession, table: JobTable, source: str, out: str) -> DataFrame:
    """job_id, done, n_shards, rows_out, out_tokens, n_problems, state; NO-INPUT where no manifest is."""
    found = []
    for a, p in table.jobs():
        job = f"{a.name}__{p.name}"
        if not corpus.exists(spark, f"{source}/{a.name}/manifest"):
            found.append((job, 0, 0, 0, 0, 0, "NO-INPUT"))
        elif not corpus.exists(spark, f"{out}/{job}/stats"):
            found.append((job, 0, corpus.read_manifest(spark, f"{source}/{a.name}/manifest")["n_shards"], 0, 0, 0, "PENDING"))
        else:
            r = verify_job(spark, f"{source}/{a.name}", f"{out}/{job}").first()
            found.append((job, r["done"], r["n_shards"], r["rows_out"], r["out_tokens"], r["n_problems"], r["state"]))
    return spark.createDataFrame(found, "job_id string, done long, n_shards long, rows_out long, out_tokens long, n_problems long, state string")


def trim_job(spark: SparkSession, source: str, out: str, rule: str, tokenizer: Tokenizer) -> None:
    """Trimmed rows of all raw ones; the done marker follows once their number agrees."""
    raw = corpus.read_rows(spark, source)
    corpus.write_rows(postprocess.trim_rows(raw, rule, tokenizer).select(*OUTPUT_KEYS), out)
    before, after = raw.count(), corpus.read_rows(spark, out).count()
    if before != after:
        raise audit.SourceError(f"{before} rows before trimming, {after} after")
    corpus.mark_done(spark, out, "trimmed")


def shuffle_job(spark: SparkSession, source: str, out: str, rows_per_file: int, seed: int) -> None:
    """Shuffled files of all rows; the done marker follows once the ids are the same as often."""
    rows = corpus.read_rows(spark, source)
    corpus.write_files(shuffle.shuffle_native(rows, rows_per_file, seed), out)
    if not shuffle.check_permutation(rows, spark.read.parquet(out)).first()["conserved"]:
        raise audit.SourceError("the shuffled rows are not the rows that were read")
    corpus.mark_done(spark, out, "shuffle")


def sweep(spark: SparkSession, table: JobTable, source: str, out: str, tokenizer: Tokenizer, rows_per_file: int, seed: int) -> list[tuple[str, str]]:
    """Trim and shuffle every job that is DONE and wasn't yet; what was done with each job."""
    found = []
    for r in status_table(spark, table, source, out).collect():
        job, root = r["job_id"], f"{out}/{r['job_id']}"
        if r["state"] != "DONE":
            found.append((job, r["state"]))
            continue
        fresh = not corpus.is_done(spark, f"{root}/trimmed", "trimmed")
        if fresh:
            trim_job(spark, f"{root}/rows", f"{root}/trimmed", table.job(job)[1].trim, tokenizer)
        if fresh or not corpus.is_done(spark, f"{root}/shuffled", "shuffle"):
            shuffle_job(spark, f"{root}/trimmed", f"{root}/shuffled", rows_per_file, seed)
            fresh = True
        found.append((job, "post-processed" if fresh else "was done"))
    return found


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    try:
        if args.command == "shard":
            shard_arm(spark, args.source, args.out, args.arm, args.rows, args.bytes)
        elif args.command == "describe":
            audit.job_listing(spark, _table(args)).show(1000, truncate=False)
        elif args.command == "rewrite":
            n = rewrite_job(spark, _table(args), args.job, args.input, args.out, GENERATORS[args.generator], _counter(args), args.worker_id, args.num_workers, args.limit_shards, args.force)
            print(f"{n} shards")
        elif args.command == "status":
            status_table(spark, _table(args), args.input, args.out).show(1000, truncate=False)
        elif args.command == "verify":
            found = verify_job(spark, args.input, args.out, args.deep).first()
            print(found.asDict())
            return 0 if found["state"] == "DONE" else 1
        elif args.command == "sweep":
            for job, what in sweep(spark, _table(args), args.input, args.out, _counter(args), args.rows_per_file, args.seed):
                print(job, what)
        elif args.command == "trim" and args.dry_run:
            postprocess.dry_run(corpus.read_rows(spark, args.rows), args.rule, args.dry_run).show(truncate=False)
        elif args.force or not corpus.is_done(spark, args.out, {"trim": "trimmed", "shuffle": "shuffle"}[args.command]):
            if args.command == "trim":
                trim_job(spark, args.rows, args.out, args.rule, _counter(args))
            else:
                shuffle_job(spark, args.rows, args.out, args.rows_per_file, args.seed)
    except (ConfigError, audit.SourceError) as e:
        print(f"stopped: {e}")
        return 2
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
