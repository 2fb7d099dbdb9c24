import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from palimpsest.functions.text import library_tokenizer
from palimpsest.operators import audit, budget, generate, prompts, sharding, shuffle
from palimpsest.operators.order import dense_rank_from_zero, running_sum
from palimpsest.plans import fixtures as fx
from palimpsest.plans.jobs import Arm, ConfigError, JobTable, PromptSpec, architecture, expand, parse_env, placeholders


def fold(sizes, rows, size):
    """The cuts one row after another."""
    out, n, b, k = [], 0, 0, 0
    for s in sizes:
        out.append((k, n))
        n, b = n + 1, b + s
        if n >= rows or b >= size:
            n, b, k = 0, 0, k + 1
    return out


@pytest.mark.parametrize("rows,size,block", [(7, 100, 8), (5, 10**9, 5), (10, 1, 16), (3, 60, 50), (20, 400, 20)])
def test_parallel_fold_equals_the_sequential_one(spark, rows, size, block):
    rng = random.Random(rows)
    sizes = [rng.choice([0, 1, 5, 30, 99, 250]) for _ in range(197)]
    df = spark.createDataFrame([(k, s) for k, s in enumerate(sizes)], "ord long, text_bytes long").repartition(3)
    got = {r["ord"]: (r["shard_index"], r["row_in_shard"]) for r in sharding.cut(df, rows, size, block).collect()}
    assert [got[k] for k in range(len(sizes))] == fold(sizes, rows, size)


def test_manifest_identity(spark):
    docs = spark.createDataFrame([(k, None if k == 3 else f"text {k}") for k in range(25)], "doc_id long, text string")
    held = sharding.cut(sharding.ordered(docs), 10, 10**6)
    row = sharding.manifest(held, "a", 10, 10**6, ["doc_id", "arm"]).first()
    digest = hashlib.sha1("".join(hashlib.sha1(b"" if k == 3 else f"text {k}".encode()).hexdigest() for k in range(25)).encode()).hexdigest()
    assert (row["content_sha1"], row["total_rows"], row["n_shards"], [s["n_rows"] for s in row["shards"]]) == (digest, 25, 3, [10, 10, 5])
    other = sharding.fingerprint(digest, 10, 10**6, "dataset", ["arm", "doc_id"])
    assert row["fingerprint"] != other
    empty = sharding.cut(sharding.ordered(docs.filter("false")), 10, 100)
    assert empty.count() == 0


def test_shard_guard():
    assert sharding.check_shard_count(200, 10**6, 10) is None
    assert sharding.check_shard_count(199, 10**6, 10) == 5000
    assert sharding.check_shard_count(1, 100, 10) == 200


GOLDEN = {
    0: "easy,qa,wiki,hard,hard,qa,easy,wiki,easy,easy,wiki,qa,wiki,qa,wiki,qa",
    7: "hard,wiki,hard,easy,hard,wiki,wiki,qa,hard,qa,easy,easy,easy,hard,wiki,easy",
}


def test_style_draw(spark):
    for shard, line in GOLDEN.items():
        assert prompts.draw_styles(shard, 16) == line.split(",")
        assert prompts.draw_styles(shard, 5) == line.split(",")[:5]
    assert prompts.draw_styles(3, 0) == []
    with pytest.raises(ValueError):
        prompts.draw_styles(0, -1)
    rows = spark.createDataFrame([(k, k // 16 * 7, k % 16) for k in range(32)], "doc_id long, shard_index int, row_in_shard long").repartition(5)
    got = {r["doc_id"]: r["wrap_style"] for r in prompts.with_styles(rows).collect()}
    assert [got[k] for k in range(32)] == GOLDEN[0].split(",") + GOLDEN[7].split(",")


def test_parity_shuffle(spark):
    counts, buckets, per_file = [40, 7, 33], 5, 17
    rows = [(100 * s + k, s, k) for s, n in enumerate(counts) for k in range(n)]
    rng, held = np.random.default_rng(42), [[] for _ in range(buckets)]
    for s, n in enumerate(counts):
        for k, b in enumerate(rng.integers(0, buckets, size=n)):
            held[b].append(100 * s + k)
    want = [h[k] for b, h in enumerate(held) for k in np.random.default_rng([42, b]).permutation(len(h))]
    df = spark.createDataFrame(rows, "doc_id long, shard_index int, row_in_shard long").repartition(4)
    got = sorted((r["pos"], r["doc_id"], r["file_no"], r["row_in_file"]) for r in shuffle.shuffle_parity(df, buckets, per_file).collect())
    assert [d for _, d, _, _ in got] == want
    assert all((f, i) == divmod(p, per_file) for p, _, f, i in got)


def test_native_shuffle_does_not_depend_on_partitions(spark):
    ids = spark.range(500).select(F.col("id").alias("doc_id"))
    orders = [[r["doc_id"] for r in shuffle.shuffle_native(ids.repartition(n), 100).orderBy("pos").collect()] for n in (1, 7, 16)]
    assert orders[0] == orders[1] == orders[2] != sorted(orders[0])
    assert shuffle.choose_buckets(0) == 16 and shuffle.choose_buckets(100 << 30, 64 << 30) == 23


def test_order_helpers(spark, monkeypatch):
    from palimpsest.operators import order

    monkeypatch.setattr(order, "ROWS_PER_RANGE", 50)
    df = spark.range(300).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"), (F.col("id") % 7).alias("v"))
    assert [r["n"] for r in dense_rank_from_zero(df, [F.col("k").desc()], "n").orderBy(F.desc("k")).collect()] == list(range(300))
    got = running_sum(df, F.col("v"), [F.col("k")], "s", ["g"]).collect()
    for r in got:
        assert r["s"] == sum(k % 7 for k in range(r["k"]) if k % 3 == r["g"])


def test_generation_sees_only_admitted_rows(spark):
    docs = spark.createDataFrame([(k, "x" * (40 * k)) for k in range(20)] + [(20, None)], "doc_id long, text string")
    limits = fx.Limits(max_model_len=200, max_tokens=50)
    made = prompts.assemble(docs, PromptSpec("p", "grounded", "wiki", "a [TEXT] b"), limits, fx.CHAT, fx.PROMPT_TOKENS)
    seen = spark.sparkContext.accumulator(0)

    def load():
        def model(texts, allowed):
            seen.add(len(texts))
            return [("out", "length" if a < 60 else None, 3) for a in allowed]

        return model

    rows = generate.rewrite(made, "a", "p", generate.batch_generator(load), fx.OUTPUT_TOKENS).collect()
    admitted = {r["doc_id"] for r in made.filter("admitted").collect()}
    assert len(rows) == 21 and seen.value == len(admitted) < 21
    for r in rows:
        assert (r["status"] == 0) == (r["doc_id"] not in admitted)
        assert r["finish_reason"] in ("", "length") and (r["status"] or r["rewritten_text"] == "")
    text = prompts.content(PromptSpec("p", "grounded", "wiki", "a [TEXT] b"), F.lit("[TEXT] $1 \\"))
    assert spark.range(1).select(text).first()[0] == "a [TEXT] $1 \\ b"


def test_audit_reports_instead_of_failing(spark):
    manifest = spark.createDataFrame([(0, 10), (1, 10), (2, 5)], "shard_index int, n_rows long")
    stats = spark.createDataFrame([(0, 10, 10, "f", 1), (1, 10, 9, "g", 1), (8, 1, 1, "f", 1)], "shard_index int, n_rows_in long, n_rows_out long, input_fingerprint string, n_output_tokens long")
    got = {(r[0], r[1]) for r in audit.shard_problems(manifest, stats, "f").collect()}
    assert got == {(2, "missing"), (8, "extra"), (1, "stale fingerprint"), (1, "rows out")}
    assert audit.verify_job(manifest, stats, "f").first()["state"] == "PARTIAL"
    assert audit.verify_job(manifest, stats.filter("false"), "f").first()["state"] == "PENDING"
    with pytest.raises(audit.SourceError):
        audit.check_source(manifest, [])
    with pytest.raises(audit.SourceError):
        audit.check_source(spark.createDataFrame([(1, " ")], "doc_id long, text string"), ["doc_id"])
    with pytest.raises(audit.SourceError):
        audit.check_source(spark.createDataFrame([(1, "a")], "doc_id long, text string"), ["record_id"])
    audit.check_source(spark.createDataFrame([(1, "a")], "doc_id long, text string"), ["doc_id"], path="/in/a", out_root="/out")


def test_record_id_alone_fans_out(spark):
    rows = spark.createDataFrame([(1, "r", "h1"), (2, "r", "h2"), (3, "s", "h3")], "doc_id long, record_id string, source_text_sha1 string")
    assert tuple(budget.record_fanout(rows, rows).first()) == (3, 5)
    assert {(r["doc_id"], r["repaired_doc_id"]) for r in budget.repair_by_record(rows, rows).collect()} == {(1, 1), (2, 2), (3, 3)}


GOOD = PromptSpec("p", "grounded", "wiki", "a [TEXT]")


@pytest.mark.parametrize(
    "arms,prompts_",
    [
        ([Arm("a", "x", ("q",))], {"p": GOOD}),
        ([Arm("a", "x", ("p",)), Arm("a", "y", ("p",))], {"p": GOOD}),
        ([Arm("a", "x", ("p",)), Arm("b", "x", ("p",))], {"p": GOOD}),
        ([Arm("a", "x", ("p", "p"))], {"p": GOOD}),
        ([], {"p": PromptSpec("p", "grounded", "wiki", "no place")}),
        ([], {"p": PromptSpec("p", "odd", "wiki", "[TEXT]")}),
        ([], {"p": PromptSpec("p", "grounded", "odd", "[TEXT]")}),
        ([], {"p": PromptSpec("p", "wrap_multi", "wrap", styles={"hard": "x"})}),
        ([], {"p": PromptSpec("p", "wrap_multi", "wrap", styles={s: "same\n\nPassage:\n" for s in ("easy", "hard", "wiki", "qa")})}),
        ([], {"p": PromptSpec("p", "grounded", "wiki", "[TEXT]", input_drop=0)}),
        ([], {"p": PromptSpec("p", "grounded", "wrap", "[TEXT]")}),
        ([], {"p": PromptSpec("p", "wrap_multi", "wiki", styles=fx.STYLED.styles)}),
        ([], {"p": PromptSpec("p", "wrap_multi", "wrap", "text too", styles=fx.STYLED.styles)}),
        ([Arm("a", "x", ())], {"p": GOOD}),
        ([Arm("a", "x", ("p",), ratios=(1.0, 2.0))], {"p": GOOD}),
        ([Arm("a", "x", ("p",), docs=-1)], {"p": GOOD}),
    ],
)
def test_bad_job_tables(arms, prompts_):
    with pytest.raises(ConfigError):
        JobTable(arms, prompts_).check()


def test_loading_jobs(tmp_path):
    from palimpsest.plans.jobs import load_jobs

    (tmp_path / "p.txt").write_text("Say it again: [TEXT]")
    config = {"arms": [{"name": "a", "subdir": "a", "prompts": ["p"]}], "prompts": {"p": {"mode": "grounded", "trim": "wiki", "file": "p.txt"}}, "sharding": {"target_rows": 10}, "expected_jobs": 1}
    read = lambda f: (tmp_path / f).read_text()
    assert load_jobs(config, read).job("a__p")[1].text == "Say it again: [TEXT]"
    for change in ({"expected_jobs": 2}, {"odd": 1}, {"limits": {"odd": 1}}, {"arms": [{"name": "a"}]}, {"prompts": {"p": {"mode": "grounded"}}}):
        with pytest.raises(ConfigError):
            load_jobs(config | change, read)


def test_summaries_of_several_jobs(spark, tmp_path):
    from palimpsest.sources import corpus

    for n in (1, 2):
        corpus.write_summary(spark.createDataFrame([(n,)], "n_rows long"), str(tmp_path), f"a__p{n}")
    assert {(r["job_id"], r["n_rows"]) for r in corpus.read_summaries(spark, str(tmp_path)).collect()} == {("a__p1", 1), ("a__p2", 2)}


def test_config_helpers():
    assert fx.JOBS.check().job("even__styled")[1].name == "styled"
    with pytest.raises(ConfigError):
        fx.JOBS.job("none")
    assert expand({"a": "/r", "b": "${a}/s", "c": "${b}/t"})["c"] == "/r/s/t"
    for bad in ({"a": "${b}", "b": "${a}"}, {"a": "${z}"}):
        with pytest.raises(ConfigError):
            expand(bad)
    assert parse_env("# c\nA=1\nexport B='x y'\n\nbad") == {"A": "1", "B": "x y"}
    assert placeholders("a: 1\nb: <YOUR TOKEN>\n") == [(2, "<YOUR TOKEN>")]
    assert [architecture(c, ["9.0", "10.0"]) for c in ("9.0", "9.1", "8.0")] == ["ok", "warn", "fail"]


def test_sources_round_trip(spark, tmp_path):
    from palimpsest.sources import corpus

    rows = fx.rewritten(spark, "/root/testdata/sf0.001", fx.WIKI).limit(20)
    corpus.write_rows(rows, str(tmp_path / "rows"))
    back = corpus.read_rows(spark, str(tmp_path / "rows"))
    assert back.schema == corpus.output_schema() and back.exceptAll(rows.select(*back.columns)).count() == 0
    (tmp_path / "stats.json").write_text('{"shard_index": 1, "n_rows_out": 5, "finished_at": 1}\nbroken\n{"shard_index": 1, "n_rows_out": 6, "finished_at": 2}\n')
    assert [(r["shard_index"], r["n_rows_out"]) for r in corpus.read_stats(spark, str(tmp_path / "stats.json")).collect()] == [(1, 6)]
    (tmp_path / "bad.json").write_text("{broken\n")
    with pytest.raises(Exception):
        corpus.read_rows(spark, str(tmp_path / "bad.json")).collect()
    held = sharding.cut(sharding.ordered(spark.createDataFrame([(k, "abc") for k in range(9)], "doc_id long, text string")), 4, 100)
    corpus.write_shards(held, str(tmp_path / "shards"))
    assert sorted(r["doc_id"] for r in corpus.read_shards(spark, str(tmp_path / "shards"), 1).collect()) == [4, 5, 6, 7]
    placed = shuffle.shuffle_native(spark.range(10).select(F.col("id").alias("doc_id")), 4)
    corpus.write_files(placed, str(tmp_path / "files"))
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "files")).groupBy("file_no").agg(F.count("*").alias("n")).collect()) == [2, 4, 4]
    manifest = sharding.manifest(held, "a", 4, 100, ["doc_id"])
    corpus.write_manifest(manifest, str(tmp_path / "manifest"))
    named = corpus.manifest_shards(spark, str(tmp_path / "manifest"))
    on_disk = corpus.list_shards(spark, str(tmp_path / "shards"))
    assert [r["path"] for r in on_disk.collect()] == [r["path"] for r in named.orderBy("shard_index").collect()] == ["shard_index=0", "shard_index=1", "shard_index=2"]
    assert spark.read.parquet(str(tmp_path / "shards" / named.filter("shard_index = 1").first()["path"])).count() == 4
    assert audit.shards_on_disk(named, on_disk).count() == 0
    odd = named.filter("shard_index > 0").union(spark.createDataFrame([(9, "shard_index=9", 1, 1)], named.schema))
    assert {tuple(r) for r in audit.shards_on_disk(odd, on_disk).collect()} == {(0, "not in the manifest"), (9, "not on disk")}
    assert corpus.read_manifest(spark, str(tmp_path / "manifest"))["total_rows"] == 9
    assert "| doc_id |" in corpus.dataset_card("a__p", 9, 5, ["doc_id"])


def test_command_line_round_trip(spark, tmp_path, capsys):
    """Repeated and null ids, record ids and scan order survive; what is done isn't done again."""
    import json

    from palimpsest import cli
    from palimpsest.sources import corpus

    ids = [5, 5, None, 3, 3, 3, None, 9, 1, 2]
    rows = [(i, f"r{k}", f"text {k} " + "w " * (40 * k)) for k, i in enumerate(ids)]
    for k in (0, 1):
        spark.createDataFrame(rows[5 * k : 5 * k + 5], "doc_id long, record_id string, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / f"arm/{k}"))
    source, root, out = str(tmp_path / "arm/*"), str(tmp_path / "in/a"), str(tmp_path / "out")
    assert cli.main(["shard", source, root, "--arm", "a", "--rows", "3", "--bytes", "100000"]) == 0
    held = corpus.read_shards(spark, f"{root}/shards").orderBy("ord").collect()
    assert [(r["doc_id"], r["record_id"], r["text"]) for r in held] == rows
    assert [(r["shard_index"], r["row_in_shard"]) for r in held] == [divmod(k, 3) for k in range(10)]
    config = {"arms": [{"name": "a", "subdir": "a", "prompts": ["p", "s"]}], "prompts": {"p": {"mode": "grounded", "trim": "distill", "text": "[TEXT]"}, "s": {"mode": "wrap_multi", "trim": "wrap", "styles": fx.STYLED.styles}}, "limits": {"max_model_len": 250, "max_tokens": 100}}
    (tmp_path / "jobs.json").write_text(json.dumps(config))
    jobs, job = str(tmp_path / "jobs.json"), f"{out}/a__p"
    assert cli.main(["describe", jobs]) == 0 and "a__p" in capsys.readouterr().out
    assert cli.main(["rewrite", jobs, "a__p", root, job, "--limit-shards", "1"]) == 0
    assert cli.main(["verify", root, job]) == 1
    assert cli.main(["rewrite", jobs, "a__p", root, job, "--worker-id", "1", "--num-workers", "2"]) == 0
    assert cli.main(["rewrite", jobs, "a__p", root, job]) == 0 and cli.main(["rewrite", jobs, "a__p", root, job]) == 0
    assert capsys.readouterr().out.splitlines()[-1] == "0 shards"
    assert cli.main(["verify", root, job, "--deep"]) == 0
    assert cli.main(["rewrite", jobs, "a__s", root, f"{out}/a__s"]) == 0
    assert [r["state"] for r in cli.status_table(spark, cli._table(cli.parser().parse_args(["describe", jobs])), str(tmp_path / "in"), out).collect()] == ["DONE", "DONE"]
    table = cli._table(cli.parser().parse_args(["describe", jobs]))
    for what in ("post-processed", "was done"):
        assert cli.sweep(spark, table, str(tmp_path / "in"), out, fx.OUTPUT_TOKENS, 4, 1) == [("a__p", what), ("a__s", what)]
    assert spark.read.parquet(f"{out}/a__s/shuffled").count() == 10
    made = corpus.read_rows(spark, f"{job}/rows")
    assert sorted((str(r["doc_id"]), r["record_id"]) for r in made.collect()) == sorted((str(i), r) for i, r, _ in rows)
    assert {r["status"] for r in made.collect()} == {0, 2}
    assert cli.main(["trim", f"{job}/rows", f"{out}/trimmed", "--rule", "distill", "--tokenizer", fx.library_path()]) == 0
    real = {r["record_id"]: r for r in corpus.read_rows(spark, f"{out}/trimmed").collect()}
    counter = __import__("tokenizers").Tokenizer.from_file(fx.library_path())
    changed = [r for r in real.values() if r["rewritten_text"] != {m["record_id"]: m["rewritten_text"] for m in made.collect()}[r["record_id"]]]
    assert changed and all(r["n_output_tokens_llama2"] == len(counter.encode(r["rewritten_text"], add_special_tokens=False).ids) for r in changed)
    assert corpus.is_done(spark, f"{out}/trimmed", "trimmed") and cli.main(["trim", f"{job}/rows", f"{out}/trimmed", "--rule", "wrap"]) == 0
    assert cli.main(["shuffle", f"{job}/rows", f"{out}/mixed", "--rows-per-file", "4"]) == 0 and corpus.is_done(spark, f"{out}/mixed", "shuffle")
    assert spark.read.parquet(f"{out}/mixed").count() == 10
    assert cli.main(["rewrite", jobs, "a__none", root, job]) == 2


def test_ids_follow_the_scan_where_an_arm_has_none(spark, tmp_path):
    from palimpsest.sources import corpus

    for k in range(3):
        spark.range(10 * k, 10 * k + 10).select(F.concat(F.lit("t"), "id").alias("text")).coalesce(1).write.parquet(str(tmp_path / f"part{2 - k}"))
    got = sharding.ordered(corpus.scan_order(spark.read.parquet(str(tmp_path / "part*"))))
    texts = [f"t{k}" for k in (*range(20, 30), *range(10, 20), *range(10))]
    assert [(r["doc_id"], r["source_text_sha1"]) for r in got.orderBy("ord").collect()] == [(k, hashlib.sha1(t.encode()).hexdigest()) for k, t in enumerate(texts)]
    with pytest.raises(ValueError):
        sharding.ordered(spark.createDataFrame([("a",)], "text string"))


def test_unknown_styles_are_refused(spark):
    docs = spark.createDataFrame([(1, "a", "easy"), (2, "b", "loud")], "doc_id long, text string, style string")
    made = prompts.assemble(docs, fx.STYLED, fx.LIMITS, fx.CHAT, fx.PROMPT_TOKENS, style_col="style")
    assert made.filter("doc_id = 1").count() == 1
    for odd in (docs, docs.withColumn("style", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="has no style"):
            prompts.assemble(odd, fx.STYLED, fx.LIMITS, fx.CHAT, fx.PROMPT_TOKENS, style_col="style").collect()


def test_generator_input_is_worked_out_once(spark):
    """One pass over the assembled rows; a row without a count is kept and not generated."""
    docs = spark.createDataFrame([(k, "x" * (40 * k)) for k in range(20)], "doc_id long, text string").repartition(2)
    calls = spark.sparkContext.accumulator(0)

    @F.pandas_udf("int")
    def count(text):
        calls.add(len(text))
        return text.str.len().where(text.str.len() < 500).astype("Int32")

    from palimpsest.functions.text import Tokenizer

    made = prompts.assemble(docs, PromptSpec("p", "grounded", "wiki", "a [TEXT] b"), fx.Limits(600, 50), fx.CHAT, Tokenizer("t", count))
    rows = generate.rewrite(made, "a", "p", generate.batch_generator(lambda: lambda texts, allowed: [("out", None, 3) for _ in texts]), fx.OUTPUT_TOKENS).collect()
    assert len(rows) == 20 and calls.value == 20
    assert sum(r["status"] == 0 and r["n_prompt_tokens"] is None for r in rows) > 0


def test_library_tokens(spark):
    from palimpsest.plans import catalog

    counter = __import__("tokenizers").Tokenizer.from_file(fx.library_path())
    n = lambda t: len(counter.encode(t, add_special_tokens=False).ids)
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in catalog.QUERIES["library_prompt_tokens"](spark, "/root/testdata/sf0.001").collect():
        assert r["n_prompt_tokens"] == n(fx.CHAT.prefix + fx.WIKI.text.replace("[TEXT]", texts[r["doc_id"]]) + fx.CHAT.suffix)
        assert r["n_output_tokens_llama2"] <= r["tokens_before"] and (r["stripped"] or r["n_output_tokens_llama2"] == r["tokens_before"])


def worker_peaks(begin=False):
    """Peak MB of each Python worker, from now on if `begin`."""
    out = {}
    for status in Path("/proc").glob("[0-9]*/status"):
        try:
            if b"pyspark.daemon" in (status.parent / "cmdline").read_bytes():
                if begin:
                    (status.parent / "clear_refs").write_text("5")
                out[status.parent.name] = int(re.search(r"VmHWM:\s+(\d+)", status.read_text()).group(1)) / 1024
        except OSError:
            pass
    return out


def test_library_tokens_take_no_more_memory_than_texts(spark):
    """encoded at once, the texts of this one batch took a worker 1,141 MB."""
    words = np.random.default_rng(1).integers(0, 20_000, (4_000, 800))
    texts = [(k, " ".join(f"w{x}" for x in row) if k else None) for k, row in enumerate(words)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    counter = __import__("tokenizers").Tokenizer.from_file(fx.library_path())
    before = worker_peaks(begin=True)
    got = {r["doc_id"]: r["n"] for r in docs.select("doc_id", library_tokenizer(fx.library_path()).count(F.col("text")).alias("n")).collect()}
    least = min(before.values(), default=0)
    assert max(peak - before.get(worker, least) for worker, peak in worker_peaks().items()) < 250
    assert len(got) == len(texts) and all(got[k] == len(counter.encode(texts[k][1] or "", add_special_tokens=False).ids) for k in (0, 1, 1_999, 3_999))


def test_settings():
    from palimpsest.plans.jobs import check_architecture, check_settings

    assert check_settings({})["compute"]["num_gpus"] == 1
    engine = check_settings({})["engine"]
    check_settings({"upload": {"enabled": True, "repo_template": "x/{arm}-{prompt_id}"}, "compute": {"num_gpus": 2, "gpu_ids": [0, 1], "fleet_gpus": 16}})
    for bad in (
        {"odd": {}}, {"engine": {"dtype": "x"}}, {"engine": engine | {"odd": 1}}, {"engine": engine | {"tensor_parallel_size": 2}}, {"sampling": {"seed": 1}},
        {"compute": {"num_gpus": 0}}, {"compute": {"num_gpus": "two"}}, {"compute": {"num_gpus": True}}, {"compute": {"gpu_ids": [1, 2]}}, {"compute": {"fleet_gpus": 0}}, {"compute": {"num_gpus": 4, "fleet_gpus": 2}},
        {"compute": {"shard_assignment": "odd"}}, {"compute": {"scheduler": "odd"}}, {"compute": {"allowed_gpu_arch": []}}, {"compute": {"allowed_gpu_arch": ["9.0"]}},
        {"output": {"compression": "gzip"}}, {"upload": {"enabled": "yes"}}, {"upload": {"enabled": True}}, {"upload": {"repo_template": "x/{arm}"}}, {"upload": {"stage": "odd"}},
    ):
        with pytest.raises(ConfigError):
            check_settings(bad)
    check_architecture("9.0", ["9.0"])
    with pytest.raises(ConfigError):
        check_architecture("8.0", ["9.0"])


def test_models_and_exports(spark, tmp_path):
    from palimpsest.functions.text import check_vocabulary
    from palimpsest.sources import corpus

    model = tmp_path / "model"
    model.mkdir()
    assert corpus.missing_weights(spark, str(model)) == ["model.safetensors"]
    (model / "model.safetensors.index.json").write_text('{"weight_map": {"a": "one.safetensors", "b": "two.safetensors", "c": "one.safetensors"}}')
    (model / "one.safetensors").write_text("x")
    assert corpus.missing_weights(spark, str(model)) == ["two.safetensors"]
    for name in ("x.tmp", "_trimmed.done", ".hidden"):
        (model / name).write_text("")
    assert [r["path"].rsplit("/", 1)[1] for r in corpus.payload(spark, str(model)).collect()] == ["model.safetensors.index.json", "one.safetensors"]
    size = __import__("tokenizers").Tokenizer.from_file(fx.library_path()).get_vocab_size()
    check_vocabulary(fx.library_path(), size)
    with pytest.raises(ValueError):
        check_vocabulary(fx.library_path(), size + 1)


def test_preflight_and_monitor(spark):
    jobs = JobTable([Arm("a", "a", ("p",), 10, 1000, (0.5,)), Arm("b", "b", ("p",), 10, 1000, (0.5,))], {"p": GOOD})
    docs = spark.createDataFrame([(1, "r", "text")], "doc_id long, record_id string, text string")
    got = {r["check"]: r["ok"] for r in audit.preflight(spark, jobs, {"a": docs}, free_bytes=100).collect()}
    assert got == {"jobs": True, "source a": True, "source b": False, "disk": False}
    rows = spark.createDataFrame([(1, "- a\n- a"), (2, "word " * 30)], "doc_id long, rewritten_text string")
    assert {tuple(r) for r in audit.monitor(rows, per=1).collect()} == {(1, True, True, True), (2, False, False, False)}
    many = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("rewritten_text"))
    assert 10 < audit.monitor(many).count() < 40
    listed = audit.job_listing(spark, fx.JOBS).collect()
    assert [(r["job_id"], r["derived"], r["prompts"]) for r in listed] == [("every__wiki", False, 1), ("every__distill", True, 1), ("even__styled", False, 4)]


def test_streaming_takes_each_file_once(spark, tmp_path):
    from palimpsest.streaming.incremental import follow_shards

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.range(1).withColumn("text", F.lit("a")).schema
    job = lambda df: df.withColumn("n", F.length("text"))
    for start in (0, 10):
        spark.range(start, start + 10).withColumn("text", F.lit("abc")).write.mode("append").parquet(source)
        follow_shards(spark, source, schema, job, out, str(tmp_path / "check")).awaitTermination()
        assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == list(range(start + 10))
