"""The registered queries of the engine's own operators, and DuckDB SQL written for each by hand."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import trim
from palimpsest.functions.text import job_id, library_tokenizer, opening, text_bytes, text_sha1
from palimpsest.operators import audit, budget, estimate, postprocess, prompts, sharding, shuffle
from palimpsest.operators.generate import mock_generator, rewrite
from palimpsest.plans import fixtures as fx
from palimpsest.plans.jobs import OUTPUT_KEYS, STYLES, Arm
from palimpsest.runtime import materialize, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FLAGSHIP = "dual_cap_shards"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def text(value: str) -> str:
    """A value as an SQL literal."""
    return "'" + value.replace("'", "''") + "'"


def any_of(test: str, column: str, phrases: list[str]) -> str:
    return "(" + " or ".join(f"{test}({column}, {text(p)})" for p in phrases) + ")"


# --- scans, hashes, shards -------------------------------------------------------------


@query("select lang, source, count(*) as n_docs, sum(strlen(text)) as text_bytes, count(distinct sha1(text)) as n_texts from documents group by lang, source")
def corpus_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(text_bytes(F.col("text"))).alias("text_bytes"), F.count_distinct(text_sha1(F.col("text"))).alias("n_texts"))


@query("select doc_id, sha1(coalesce(text, '')) as source_text_sha1, strlen(coalesce(text, '')) as text_bytes, substr(coalesce(text, ''), 1, 80) as opening, 'every__' || lang as job_id from documents")
def text_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    t = F.col("text")
    return docs.select("doc_id", text_sha1(t).alias("source_text_sha1"), text_bytes(t).alias("text_bytes"), opening(t).alias("opening"), job_id(F.lit("every"), F.col("lang")).alias("job_id"))


#: Documents in scan order.
ORDERED_SQL = "o as (select doc_id, sha1(coalesce(text, '')) as h, strlen(coalesce(text, '')) as b, row_number() over (order by doc_id) - 1 as ord from documents)"
#: The fold, one row at a time: a shard closes once it has its rows or its bytes.
FOLD_SQL = f"""{ORDERED_SQL}, fold as (
  select ord, doc_id, b, 0 as shard_index, 1 as rows_held, b as bytes_held from o where ord = 0
  union all
  select o.ord, o.doc_id, o.b,
    case when f.rows_held >= {fx.TARGET_ROWS} or f.bytes_held >= {fx.TARGET_BYTES} then f.shard_index + 1 else f.shard_index end,
    case when f.rows_held >= {fx.TARGET_ROWS} or f.bytes_held >= {fx.TARGET_BYTES} then 1 else f.rows_held + 1 end,
    case when f.rows_held >= {fx.TARGET_ROWS} or f.bytes_held >= {fx.TARGET_BYTES} then o.b else f.bytes_held + o.b end
  from fold f join o on o.ord = f.ord + 1)"""
MANIFEST_SQL = "select shard_index, count(*) as n_rows, sum(b) as text_bytes, min(doc_id) as first_doc_id, max(doc_id) as last_doc_id, 'shard_index=' || shard_index as path from {0} group by shard_index"


def _shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(fx.sharded(spark, sf_dir))


@query(f"with recursive {FOLD_SQL} {MANIFEST_SQL.format('fold')}")
def dual_cap_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shards(spark, sf_dir)


@query(f"with {ORDERED_SQL}, s as (select *, ord // {fx.TARGET_ROWS} as shard_index from o) {MANIFEST_SQL.format('s')}")
def row_cap_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(sharding.cut(sharding.ordered(table(spark, sf_dir, "documents")), fx.TARGET_ROWS))


@query(f"with recursive {FOLD_SQL} select doc_id, shard_index, rows_held - 1 as row_in_shard from fold")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.sharded(spark, sf_dir).select("doc_id", "shard_index", "row_in_shard")


@query(
    f"with {ORDERED_SQL}, c as (select count(*) as total_rows, sum(b) as total_text_bytes, sha1(string_agg(h, '' order by ord)) as content_sha1 from o) "
    f"select total_rows, total_text_bytes, content_sha1, sha1(content_sha1 || '|{fx.TARGET_ROWS}|{fx.TARGET_BYTES}|{sharding.DOC_ID_POLICY}|dataset|{','.join(OUTPUT_KEYS)}') as fingerprint from c"
)
def corpus_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = materialize(fx.sharded(spark, sf_dir), "sharded")
    return sharding.manifest(held, "every", fx.TARGET_ROWS, fx.TARGET_BYTES, OUTPUT_KEYS).select("total_rows", "total_text_bytes", "content_sha1", "fingerprint")


@query(f"with recursive {FOLD_SQL}, s as (select count(distinct shard_index) as n_shards, count(*) as total_rows from fold) select n_shards, total_rows, case when n_shards >= 20 * 8 then null else greatest(200, total_rows // 160 // 100 * 100) end as suggested_rows from s")
def shard_count_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = _shards(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_shards"), F.sum("n_rows").alias("total_rows")).first()
    return spark.createDataFrame([(one["n_shards"], one["total_rows"], sharding.check_shard_count(one["n_shards"], one["total_rows"], 8))], "n_shards long, total_rows long, suggested_rows long")


# --- prompts, admission, generation ----------------------------------------------------


def _prompt_sql(prompt, docs: str = "documents") -> str:
    """Documents with their final prompt's tokens and the threshold."""
    style = "''"
    if prompt is fx.STYLED:
        style = "case (doc_id // 2) % 4 " + " ".join(f"when {k} then {text(s)}" for k, s in enumerate(STYLES)) + " end"
        lead = "case (doc_id // 2) % 4 " + " ".join(f"when {k} then {text(prompt.styles[s])}" for k, s in enumerate(STYLES)) + " end"
        body, docs = f"{lead} || coalesce(text, '')", "(select * from documents where doc_id % 2 = 0)"
    else:
        body = f"replace({text(prompt.text)}, '[TEXT]', coalesce(text, ''))"
    drop = prompt.input_drop or fx.LIMITS.max_model_len - fx.LIMITS.max_tokens
    return f"p as (select *, {style} as wrap_style, greatest(1, length({text(fx.CHAT.prefix)} || {body} || {text(fx.CHAT.suffix)}) // 4) as n_in, {drop} as dropped from {docs} d)"


@query(f"with {_prompt_sql(fx.WIKI)} select doc_id, n_in as n_prompt_tokens, n_in <= dropped as admitted, greatest(1, least({fx.LIMITS.max_tokens}, {fx.LIMITS.max_model_len} - n_in)) as max_new_tokens from p")
def wiki_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = prompts.assemble(fx.corpus(spark, sf_dir), fx.WIKI, fx.LIMITS, fx.CHAT, fx.PROMPT_TOKENS)
    return made.select("doc_id", "n_prompt_tokens", "admitted", "max_new_tokens")


@query("select * from (values " + ", ".join(f"({text(p.name)}, {text(s)}, {max(1, len(fx.CHAT.prefix + t + fx.CHAT.suffix) // 4)})" for p in (fx.WIKI, fx.DISTILL, fx.STYLED) for s, t in (p.styles.items() or [("", p.text.replace("[TEXT]", ""))])) + ") as v(prompt_id, style, overhead)")
def prompt_overheads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.prompt_overheads(spark, [fx.WIKI, fx.DISTILL, fx.STYLED], fx.CHAT, fx.PROMPT_TOKENS).select("prompt_id", "style", "overhead")


@query(
    f"select text, count(*) as n_users, string_agg(u, ',' order by u) as users from (values ('every__wiki', {text(fx.WIKI.text)}), ('even__wiki', {text(fx.WIKI.text)}), ('every__distill', {text(fx.DISTILL.text)}), "
    + ", ".join(f"('even__styled/{s}', {text(t)})" for s, t in fx.STYLED.styles.items())
    + ") as v(u, text) group by text"
)
def prompt_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prompts.prompt_users(spark, [("every", fx.WIKI), ("even", fx.WIKI), ("every", fx.DISTILL), ("even", fx.STYLED)])


def _rows_sql(prompt) -> str:
    """A job's output rows under the mock generator."""
    lead = (
        f"case doc_id % 5 when 0 then {text(trim.WIKI_PREFIX)} when 1 then 'Here is the rewritten passage:' || chr(10) || chr(10) when 2 then '### Paraphrased Version' || chr(10) || chr(10) "
        f"when 3 then case doc_id % 3 when 0 then {text(trim.LEAK_ANCHOR)} || ' explicitly stated.' || chr(10) || chr(10) when 1 then '**Condensed Version:**' || chr(10) else '### Case Summary' || chr(10) || chr(10) end else '' end"
    )
    name = "even" if prompt is fx.STYLED else "every"
    return f"""{_prompt_sql(prompt)}, g as (
      select *, n_in <= dropped as ok, case when n_in <= dropped then {lead} || 'REWRITTEN body ' || doc_id || ' ' || substr(coalesce(text, ''), 1, 200) else '' end as rt from p),
    job as (select doc_id, '<urn:uuid:' || substr(md5(text), 1, 8) || '-' || substr(md5(text), 9, 4) || '-' || substr(md5(text), 13, 4) || '-' || substr(md5(text), 17, 4) || '-' || substr(md5(text), 21, 12) || '>' as record_id,
      '{name}' as arm, '{prompt.name}' as prompt_id, sha1(coalesce(text, '')) as source_text_sha1, rt as rewritten_text,
      case when not ok then '' when doc_id % 11 = 0 then 'length' else 'stop' end as finish_reason, n_in as n_prompt_tokens,
      case when ok then greatest(1, length(rt) // 4) else 0 end as n_output_tokens, case when not ok then 0 when doc_id % 11 = 0 then 1 else 2 end as status,
      length(rt) // 4 as n_output_tokens_llama2, wrap_style from g)"""


@query(f"with {_rows_sql(fx.WIKI)} select * from job")
def rewrite_wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.rewritten(spark, sf_dir, fx.WIKI)


@query(f"with {_rows_sql(fx.DISTILL)} select * from job")
def rewrite_distill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.rewritten(spark, sf_dir, fx.DISTILL)


@query(f"with {_rows_sql(fx.STYLED)} select * from job")
def rewrite_styled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.rewritten(spark, sf_dir, fx.STYLED)


@query()
def style_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """numpy's seeded draw, which SQL can't express; golden vectors test it."""
    return prompts.with_styles(fx.sharded(spark, sf_dir))


@query("with s as (select case when doc_id % 5 = 0 then 'loud' when doc_id % 7 = 0 then null when doc_id % 3 = 0 then 'qa' else 'easy' end as wrap_style from documents) select wrap_style, count(*) as n_rows from s where wrap_style is null or wrap_style not in ('easy', 'hard', 'wiki', 'qa') group by wrap_style")
def unknown_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id")
    style = F.when(k % 5 == 0, F.lit("loud")).when(k % 7 == 0, F.lit(None)).when(k % 3 == 0, F.lit("qa")).otherwise(F.lit("easy"))
    return prompts.unknown_styles(table(spark, sf_dir, "documents").select(style.alias("wrap_style")))


@query()
def library_prompt_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt tokens, admission and trimmed output tokens by a real vocabulary; SQL has none, tests hold them against the library."""
    real = library_tokenizer(fx.library_path())
    made = prompts.assemble(fx.corpus(spark, sf_dir), fx.WIKI, fx.LIMITS, fx.CHAT, real)
    rows = rewrite(made, "every", "wiki", mock_generator, real)
    trimmed = postprocess.trim_rows(rows, "wiki", real)
    return trimmed.select("doc_id", "n_prompt_tokens", "status", "stripped", "tokens_before", "n_output_tokens_llama2")


# --- trimming and its statistics -------------------------------------------------------

_SPACES = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||' '||chr(133)||chr(160)||chr(5760)||" + "||".join(f"chr({k})" for k in range(0x2000, 0x200B)) + "||chr(8232)||chr(8233)||chr(8239)||chr(8287)||chr(12288)"
_NN = "chr(10)||chr(10)"


def _leak_sql(source: str) -> str:
    return f"""leaked as (select *, starts_with(cut, {text(trim.LEAK_ANCHOR)}) as leak from {source}),
    done as (select * exclude (cut, leak, hit), case when leak then case when strpos(cut, {_NN}) > 0 then substr(cut, strpos(cut, {_NN}) + 2) else '' end else cut end as new_text, hit or leak as hit from leaked)"""


_WIKI_SQL = f"""cutted as (select *, starts_with(rewritten_text, {text(trim.WIKI_PREFIX)}) as hit, case when starts_with(rewritten_text, {text(trim.WIKI_PREFIX)}) then substr(rewritten_text, {len(trim.WIKI_PREFIX) + 1}) else rewritten_text end as cut from job),
  {_leak_sql("cutted")}"""
_DISTILL_SQL = f"""places as (select *, strpos(rewritten_text, {_NN}) as pp, strpos(rewritten_text, chr(10)) as lp from job),
  heads as (select *, trim(substr(rewritten_text, 1, pp - 1), {_SPACES}) as ph, trim(substr(rewritten_text, 1, lp - 1), {_SPACES}) as lh from places),
  judged as (select *,
    pp between 1 and 121 and ((({any_of("starts_with", "ph", trim.HEADERS)} or {any_of("starts_with", "lower(ph)", trim.DISTILL_OPENERS)}) and {any_of("contains", "lower(ph)", trim.DISTILL_WORDS)}) or (starts_with(lower(ph), 'paraphrased') and ends_with(ph, ':'))) as para,
    lp between 1 and 121 and ends_with(lh, ':') and {any_of("contains", "lower(lh)", trim.DISTILL_WORDS)} and ({any_of("starts_with", "lh", trim.HEADERS)} or {any_of("starts_with", "lower(lh)", trim.DISTILL_OPENERS)} or starts_with(lower(lh), 'paraphrased')) as line
    from heads),
  done as (select * exclude (pp, lp, ph, lh, para, line), case when para then substr(rewritten_text, pp + 2) when line then ltrim(substr(rewritten_text, lp + 1), chr(10)) else rewritten_text end as new_text, para or line as hit from judged)"""
_WRAP_SQL = f"""places as (select *, strpos(coalesce(rewritten_text, ''), {_NN}) as pp from job),
  heads as (select *, substr(rewritten_text, 1, pp - 1) as ph from places),
  judged as (select * exclude (ph, pp), pp, pp between 1 and 301 and (({any_of("starts_with", "ph", trim.WRAP_OPENERS)} and {any_of("contains", "lower(ph)", trim.WRAP_SIGNALS)})
    or (({any_of("starts_with", f"ltrim(ph, {_SPACES})", trim.HEADERS)} or starts_with(lower(ph), 'paraphrased') or starts_with(lower(ph), 'rewritten passage')) and {any_of("contains", "lower(ph)", trim.WRAP_STRICT)})) as hit from heads),
  cutted as (select * exclude (pp), case when hit then substr(rewritten_text, pp + 2) else rewritten_text end as cut from judged),
  {_leak_sql("cutted")}"""
_TRIMMED = """trimmed as (select * exclude (hit, new_text, rewritten_text, n_output_tokens_llama2), status = 2 and hit as stripped, n_output_tokens_llama2 as tokens_before,
  case when status = 2 and hit then new_text else rewritten_text end as rewritten_text, case when status = 2 and hit then length(new_text) // 4 else n_output_tokens_llama2 end as n_output_tokens_llama2 from done)"""
_TRIM_SQL = {"wiki": (fx.WIKI, _WIKI_SQL), "distill": (fx.DISTILL, _DISTILL_SQL), "wrap": (fx.STYLED, _WRAP_SQL)}


def _trim_sql(rule: str) -> str:
    prompt, steps = _TRIM_SQL[rule]
    return f"{_rows_sql(prompt)}, {steps}, {_TRIMMED}"


def _trimmed(spark: SparkSession, sf_dir: str, rule: str, with_shards: bool = False) -> DataFrame:
    prompt, _ = _TRIM_SQL[rule]
    return postprocess.trim_rows(fx.rewritten(spark, sf_dir, prompt, with_shards), rule, fx.OUTPUT_TOKENS)


@query(f"with {_trim_sql('wiki')} select * from trimmed")
def trim_wiki(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir, "wiki")


@query(f"with {_trim_sql('distill')} select * from trimmed")
def trim_distill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir, "distill")


@query(f"with {_trim_sql('wrap')} select * from trimmed")
def trim_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trimmed(spark, sf_dir, "wrap")


@query(
    f"with {_trim_sql('distill')} select count(*) as n_rows, count(*) filter (status = 2) as n_status2, count(*) filter (stripped) as n_stripped, sum(tokens_before) filter (status = 2) as tok_before, sum(n_output_tokens_llama2) filter (status = 2) as tok_after, "
    "round(100.0 * count(*) filter (stripped) / count(*) filter (status = 2), 4) as pct_stripped, sum(tokens_before - n_output_tokens_llama2) filter (status = 2) as tok_saved from trimmed"
)
def trim_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.trim_summary(_trimmed(spark, sf_dir, "distill"))


@query(
    f"with {_trim_sql('wrap')}, s as (select wrap_style, count(*) as n_status2, count(*) filter (stripped) as n_stripped, sum(tokens_before) as tok_before, sum(n_output_tokens_llama2) as tok_after from trimmed where status = 2 and wrap_style <> '' group by wrap_style) "
    "select *, round(tok_after / n_status2, 1) as tok_per_doc, round(100.0 * n_status2 / sum(n_status2) over (), 3) as doc_share_pct, round(100.0 * tok_after / sum(tok_after) over (), 3) as token_share_pct from s"
)
def style_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.style_summary(_trimmed(spark, sf_dir, "wrap"))


@query(f"with {_trim_sql('wiki')} select substr(rewritten_text, 1, 80) as opening, count(*) as n, min(doc_id) as first_doc_id from trimmed where status = 2 group by 1 order by n desc, first_doc_id limit 5")
def top_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.top_openings(_trimmed(spark, sf_dir, "wiki"))


@query(
    f"with recursive {FOLD_SQL}, {_trim_sql('wiki')}, c as (select f.shard_index, substr(t.rewritten_text, 1, 80) as opening, count(*) as n, min(t.doc_id) as first from trimmed t join fold f using (doc_id) where t.status = 2 and f.shard_index < 5 group by all), "
    "r as (select *, row_number() over (partition by shard_index order by n desc, first) as k from c) select opening, sum(n) as n from r where k <= 5 group by opening order by sum(n) desc, min(shard_index * 10 + k) limit 5"
)
def sampled_openings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.sampled_openings(_trimmed(spark, sf_dir, "wiki", True))


@query(
    f"with {_rows_sql(fx.DISTILL)}, first as (select * from job order by doc_id limit 200), {_DISTILL_SQL.replace('from job)', 'from first)')} "
    "select count(*) as n, count(*) filter (status = 2) as n_status2, count(*) filter (status = 2 and hit) as n_would_strip, round(100.0 * count(*) filter (status = 2 and hit) / count(*) filter (status = 2), 4) as pct from done"
)
def trim_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.dry_run(fx.rewritten(spark, sf_dir, fx.DISTILL), "distill", 200)


_STATS = "stats as (select 'every__wiki' as job_id, 'fp' as input_fingerprint, f.shard_index, count(*) as n_rows_in, count(*) as n_rows_out, count(*) filter (status = 0) as status_0, count(*) filter (status = 1) as status_1, count(*) filter (status = 2) as status_2, sum(n_prompt_tokens) as n_prompt_tokens, sum(n_output_tokens) as n_output_tokens, sum(n_output_tokens_llama2) as n_output_tokens_llama2 from job join fold f using (doc_id) group by f.shard_index)"


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postprocess.shard_stats(fx.rewritten(spark, sf_dir, fx.WIKI, True), "every__wiki", "fp")


@query(f"with recursive {FOLD_SQL}, {_rows_sql(fx.WIKI)}, {_STATS} select * from stats")
def shard_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stats(spark, sf_dir)


@query(f"with {_rows_sql(fx.STYLED)}, o as (select doc_id, row_number() over (order by doc_id) - 1 as ord from job) select ord // 50 as shard_index, " + ", ".join(f"count(*) filter (wrap_style = '{s}') as n_{s}" for s in STYLES) + " from job join o using (doc_id) group by 1")
def style_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.rewritten(spark, sf_dir, fx.STYLED)
    placed = sharding.cut(sharding.ordered(fx.arm(spark, sf_dir, "even")), 50).select("doc_id", "shard_index")
    return postprocess.style_counts(rows.join(placed, "doc_id"), STYLES)


# --- audits ----------------------------------------------------------------------------

#: Records with one shard missing, one too many, a wrong count and a stale identity.
_BROKEN = "broken as (select shard_index, n_rows_in, case when shard_index = 5 then n_rows_out - 1 else n_rows_out end as n_rows_out, case when shard_index = 7 then 'old' else input_fingerprint end as input_fingerprint, n_output_tokens from stats where shard_index <> 3 union all select 999, 1, 1, 'fp', 1)"
_MANIFEST = f"manifest as ({MANIFEST_SQL.format('fold')})"
_PROBLEMS = """problems as (
  select shard_index, 'missing' as problem from manifest where shard_index not in (select shard_index from broken)
  union all select shard_index, 'extra' from broken where shard_index not in (select shard_index from manifest)
  union all select shard_index, 'stale fingerprint' from broken where input_fingerprint <> 'fp'
  union all select b.shard_index, 'rows in' from broken b join manifest m using (shard_index) where b.n_rows_in <> m.n_rows
  union all select b.shard_index, 'rows out' from broken b join manifest m using (shard_index) where b.n_rows_out <> m.n_rows)"""


def _broken(spark: SparkSession, stats: DataFrame) -> DataFrame:
    out = stats.filter("shard_index <> 3").select(
        "shard_index", "n_rows_in", F.when(F.col("shard_index") == 5, F.col("n_rows_out") - 1).otherwise(F.col("n_rows_out")).alias("n_rows_out"), F.when(F.col("shard_index") == 7, F.lit("old")).otherwise(F.col("input_fingerprint")).alias("input_fingerprint"), "n_output_tokens"
    )
    return out.unionByName(spark.createDataFrame([(999, 1, 1, "fp", 1)], "shard_index int, n_rows_in long, n_rows_out long, input_fingerprint string, n_output_tokens long"))


_AUDIT = f"with recursive {FOLD_SQL}, {_rows_sql(fx.WIKI)}, {_STATS}, {_BROKEN}, {_MANIFEST}, {_PROBLEMS}"


@query(f"{_AUDIT} select * from problems")
def audit_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.shard_problems(_shards(spark, sf_dir), _broken(spark, _stats(spark, sf_dir)), "fp")


@query(
    f"{_AUDIT}, v as (select 'broken' as job_id, (select count(*) from manifest) as n_shards, (select sum(n_rows) from manifest) as total_rows, (select count(*) from broken) as done, (select sum(n_rows_out) from broken) as rows_out, (select sum(n_output_tokens) from broken) as out_tokens, "
    "(select count(*) filter (problem = 'missing') from problems) as n_missing, (select count(*) filter (problem = 'extra') from problems) as n_extra, (select count(*) from problems) as n_problems "
    "union all select 'whole', (select count(*) from manifest), (select sum(n_rows) from manifest), (select count(*) from stats), (select sum(n_rows_out) from stats), (select sum(n_output_tokens) from stats), 0, 0, 0) "
    "select *, n_missing = 0 and rows_out <> total_rows as total_differs, case when n_problems = 0 and rows_out = total_rows then 'DONE' when done = 0 then 'PENDING' else 'PARTIAL' end as state from v"
)
def audit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    held, stats = materialize(_shards(spark, sf_dir), "manifest"), materialize(_stats(spark, sf_dir), "stats")
    return audit.job_overview([("broken", audit.verify_job(held, _broken(spark, stats), "fp")), ("whole", audit.verify_job(held, stats, "fp"))])


@query(f"{_AUDIT} select s.shard_index, b.n_rows_out, s.n_rows_out as counted from stats s join broken b using (shard_index) where b.n_rows_out <> s.n_rows_out union all select 999, 1, 0 union all select 3, -1, n_rows_out from stats where shard_index = 3")
def audit_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.deep_count(fx.rewritten(spark, sf_dir, fx.WIKI, True), _broken(spark, _stats(spark, sf_dir)))


@query("select doc_id, 1 as n_in, 0 as n_out from documents where doc_id % 97 = 0 union all select doc_id, 1, 2 from documents where doc_id % 89 = 1 and doc_id % 97 <> 0")
def audit_conservation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    rows = docs.filter("doc_id % 97 <> 0")
    return audit.conservation(docs, rows.unionByName(rows.filter("doc_id % 89 = 1")))


@query(f"{_AUDIT} select shard_index, n_rows, text_bytes from manifest where shard_index % 3 = 1 and shard_index not in (select shard_index from broken where input_fingerprint = 'fp') union all select shard_index, n_rows, text_bytes from manifest where shard_index in (3, 7) and shard_index % 3 <> 1")
def pending_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.pending_shards(_shards(spark, sf_dir), _broken(spark, _stats(spark, sf_dir)), "fp").select("shard_index", "n_rows", "text_bytes")


@query(f"with recursive {FOLD_SQL}, {_MANIFEST} select shard_index, n_rows from manifest where shard_index % 4 = 1")
def owned_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.owned_shards(_shards(spark, sf_dir), 1, 4).select("shard_index", "n_rows")


@query("with c as (select source as arm, count(*) as total_rows from documents group by source), d as (select source as arm, count(*) as declared_docs from documents where text is not null and length(text) > 300 group by source union all select 'unseen', 12 union all select 'undeclared', null) select coalesce(c.arm, d.arm) as arm, declared_docs, coalesce(total_rows, 0) as total_rows from c full join d on c.arm = d.arm where declared_docs is not null and declared_docs <> coalesce(total_rows, 0)")
def declared_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source as an arm that declares its texts of more than 300 characters, and two arms without documents."""
    docs = table(spark, sf_dir, "documents")
    counted = docs.groupBy(F.col("source").alias("arm")).agg(F.count(F.lit(1)).alias("total_rows"))
    declared = docs.filter(F.length("text") > 300).groupBy(F.col("source").alias("arm")).agg(F.count(F.lit(1)).alias("declared_docs"))
    return audit.declared_counts(counted, declared.unionByName(spark.createDataFrame([("unseen", 12), ("undeclared", None)], "arm string, declared_docs long")))


@query(f"with recursive {FOLD_SQL}, {_MANIFEST} select * from manifest order by shard_index limit 3")
def first_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.first_shards(_shards(spark, sf_dir), 3)


# --- shuffles --------------------------------------------------------------------------


@query(f"with s as (select doc_id, row_number() over (order by md5('{fx.SEED}:' || doc_id), doc_id) - 1 as pos from documents) select doc_id, pos, pos // {fx.ROWS_PER_FILE} as file_no, pos % {fx.ROWS_PER_FILE} as row_in_file from s")
def shuffle_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle.shuffle_native(table(spark, sf_dir, "documents").select("doc_id"), fx.ROWS_PER_FILE, fx.SEED)


@query()
def shuffle_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """numpy's streams, which SQL can't express; tests hold it against a sequential restatement."""
    return shuffle.shuffle_parity(materialize(fx.sharded(spark, sf_dir), "sharded"), fx.BUCKETS, fx.ROWS_PER_FILE, fx.SEED)


#: The documents before a shuffle, and what three writers made of them: all, one lost, one twice for another.
_WRITTEN = "w as (select 'all' as writer, doc_id from documents union all select 'lost', doc_id from documents where doc_id <> 7 union all select 'doubled', case when doc_id = 7 then 8 else doc_id end from documents)"
_SAME = "not exists (select doc_id from documents except all select doc_id from w where w.writer = n.writer) and not exists (select doc_id from w where w.writer = n.writer except all select doc_id from documents)"


@query(f"with {_WRITTEN}, n as (select writer, count(*) as n_after from w group by writer) select writer, (select count(*) from documents) as n_before, n_after, {_SAME} as conserved from n")
def shuffle_conserves(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    placed = materialize(shuffle.shuffle_native(docs, fx.ROWS_PER_FILE, fx.SEED).select("doc_id"), "placed")
    twice = placed.select(F.when(F.col("doc_id") == 7, F.lit(8)).otherwise(F.col("doc_id")).alias("doc_id"))
    found = [shuffle.check_permutation(docs, after).select(F.lit(name).alias("writer"), "*") for name, after in (("all", placed), ("lost", placed.filter("doc_id <> 7")), ("doubled", twice))]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("select d.disk_bytes, cast(greatest(16, ceil(2.0 * d.disk_bytes * 4 / (0.55 * 274877906944))) as bigint) as n_buckets from (select source, sum(strlen(text)) * 1000000 as disk_bytes from documents group by source) d")
def bucket_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shuffle buckets for each source, were it a million times as large."""
    sizes = table(spark, sf_dir, "documents").groupBy("source").agg((F.sum(text_bytes(F.col("text"))) * 1_000_000).alias("disk_bytes"))
    return sizes.select("disk_bytes", shuffle.bucket_count(F.col("disk_bytes")).alias("n_buckets"))


# --- budgets and joins -----------------------------------------------------------------

_SCORED = "s as (select doc_id, source, lang, length(coalesce(text, '')) // 4 + 1 as tokens, md5('score:' || doc_id) as score from documents)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", "lang", (F.floor(F.length(F.coalesce("text", F.lit(""))) / 4) + 1).alias("tokens"), F.md5(F.concat(F.lit("score:"), F.col("doc_id").cast("string"))).alias("score"))



def _order() -> list:
    return [F.col("score").desc(), F.col("doc_id")]


@query(f"with {_SCORED}, c as (select *, coalesce(sum(tokens) over (order by score desc, doc_id rows between unbounded preceding and 1 preceding), 0) as tokens_before from s) select * from c where tokens_before < 100000")
def budget_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.fill_budget(_scored(spark, sf_dir), F.col("tokens"), 100_000, _order())


@query(f"with {_SCORED}, c as (select *, coalesce(sum(tokens) over (partition by lang order by score desc, doc_id rows between unbounded preceding and 1 preceding), 0) as tokens_before from s) select * from c where tokens_before < 20000")
def budget_by_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.fill_budget(_scored(spark, sf_dir), F.col("tokens"), 20_000, _order(), ["lang"])


@query(f"with {_SCORED}, c as (select *, coalesce(sum(tokens) over (order by score desc, doc_id rows between unbounded preceding and 1 preceding), 0) as tb from s), k as (select * from c where tb < 100000) select (select count(*) from s) as n_rows, (select sum(tokens) from s) as total_tokens, count(*) as n_kept, sum(tokens) as kept_tokens, min(score) as cutoff, sum(tokens) * 100.0 / (select sum(tokens) from s) as kept_pct from k")
def budget_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    return budget.budget_report(rows, budget.fill_budget(rows, F.col("tokens"), 100_000, _order()), F.col("tokens"), F.col("score"))


@query(f"with {_SCORED}, c as (select *, coalesce(sum(tokens) over (order by score desc, doc_id rows between unbounded preceding and 1 preceding), 0) as tb from s) select doc_id, tb < 50000 as in_50000, tb < 100000 as in_100000 from c")
def token_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.token_prefix(_scored(spark, sf_dir), F.col("tokens"), [50_000, 100_000], _order()).select("doc_id", "in_50000", "in_100000")


@query(f"with {_SCORED}, r as (select * from s where doc_id % 5 <> 0), c as (select *, coalesce(sum(tokens) over (order by score desc, doc_id rows between unbounded preceding and 1 preceding), 0) as tokens_before from r) select * from c where tokens_before < 50000")
def remainder_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir)
    return budget.remainder(rows, rows.filter("doc_id % 5 = 0"), F.col("tokens"), 50_000, _order())


_REMAINDERS = {"quality": ("a desc, doc_id", ""), "stratified": ("a desc, doc_id", "lang"), "disagreement": ("abs(a - b) desc, doc_id", ""), "uniform": (f"md5('{fx.SEED}:' || doc_id), doc_id", "")}


@query(
    "with r as (select doc_id, lang, length(coalesce(text, '')) // 4 + 1 as tokens, doc_id * 37 % 101 as a, doc_id * 53 % 89 as b from documents where doc_id % 5 <> 0) "
    + " union all ".join(
        f"select '{kind}' as kind, doc_id, tokens_before from (select doc_id, coalesce(sum(tokens) over ({'partition by ' + by if by else ''} order by {order} rows between unbounded preceding and 1 preceding), 0) as tokens_before from r) where tokens_before < 20000"
        for kind, (order, by) in _REMAINDERS.items()
    )
)
def remainder_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the core leaves, by quality, by quality within each language, by disagreement, and by uniform draws."""
    k = F.col("doc_id")
    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", (F.floor(F.length(F.coalesce("text", F.lit(""))) / 4) + 1).alias("tokens"), (k * 37 % 101).alias("a"), (k * 53 % 89).alias("b"))
    core, found = rows.filter("doc_id % 5 = 0"), []
    for kind, (_, by) in _REMAINDERS.items():
        order = budget.selection_order("quality" if by else kind, "a", "b", fx.SEED)
        found.append(budget.remainder(rows, core, F.col("tokens"), 20_000, order, [by] if by else None).select(F.lit(kind).alias("kind"), "doc_id", "tokens_before"))
    return reduce(DataFrame.unionByName, found)


@query(
    f"with a as (with {_rows_sql(fx.WIKI)} select * from job), b as (with {_rows_sql(fx.DISTILL)} select * from job), u as (select doc_id, prompt_id, n_output_tokens_llama2, 1 as pass from a where status = 2 union all select doc_id, prompt_id, n_output_tokens_llama2, 2 from b where status = 2), "
    "c as (select *, coalesce(sum(n_output_tokens_llama2) over (order by pass, md5('42:' || doc_id), doc_id rows between unbounded preceding and 1 preceding), 0) as tb from u) select doc_id, prompt_id, pass from c where tb < 60000"
)
def assemble_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["doc_id", "prompt_id", "n_output_tokens_llama2", "status"]
    first, second = (fx.rewritten(spark, sf_dir, p).select(*cols) for p in (fx.WIKI, fx.DISTILL))
    order = [F.md5(F.concat(F.lit("42:"), F.col("doc_id").cast("string"))), F.col("doc_id")]
    return budget.assemble_passes(first, second, F.col("n_output_tokens_llama2"), 60_000, order).select("doc_id", "prompt_id", "pass")


@query("with r as (select doc_id from documents union all select doc_id from documents where doc_id % 2 = 0 union all select doc_id from documents where doc_id % 6 = 0) select copies, count(*) as n_docs from (select doc_id, count(*) as copies from r group by doc_id) group by copies")
def copies_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return budget.copies_histogram(docs.unionByName(docs.filter("doc_id % 2 = 0")).unionByName(docs.filter("doc_id % 6 = 0")))


@query("select count(*) as n_rows, count(distinct md5(text)) as n_distinct, (count(*) - count(distinct md5(text))) * 100.0 / count(*) as dup_pct from documents")
def record_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.duplicate_rate(fx.corpus(spark, sf_dir))


@query("with k as (select md5(text) as k, count(*) as n from documents group by 1) select sum(n) as n_rows, sum(n * n) as n_joined from k")
def record_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.corpus(spark, sf_dir)
    return budget.record_fanout(docs, docs)


@query("select d.doc_id, m.repaired_doc_id from documents d join (select text, min(doc_id) as repaired_doc_id from documents group by text) m using (text)")
def record_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = fx.corpus(spark, sf_dir).select("doc_id", "record_id", text_sha1(F.col("text")).alias("source_text_sha1"))
    return budget.repair_by_record(held, held).select("doc_id", "repaired_doc_id")


@query(f"with {_rows_sql(fx.WIKI)} select j.doc_id, j.status, d.lang, d.source, l.quality from job j join documents d using (doc_id) left join labels l on l.doc_id = j.doc_id")
def join_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = budget.join_source(fx.rewritten(spark, sf_dir, fx.WIKI), table(spark, sf_dir, "documents"), ["lang", "source"])
    return budget.join_source(rows, table(spark, sf_dir, "labels"), ["quality"]).select("doc_id", F.col("status").cast("int").alias("status"), "lang", "source", "quality")


@query("select doc_id, doc_id % 5 = 0 as is_core from documents")
def reassembled(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return budget.reassemble(docs.filter("doc_id % 5 = 0"), docs.filter("doc_id % 5 <> 0"))


@query("with a as (select doc_id, 'every' as arm from documents union all select doc_id, 'even' from documents where doc_id % 2 = 0 union all select doc_id, 'good' from documents where doc_id in (select doc_id from labels where quality = 1)) select x.arm as arm_a, y.arm as arm_b, count(*) as n_shared from a x join a y on x.doc_id = y.doc_id and x.arm < y.arm group by 1, 2")
def arm_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget.arm_overlap({n: fx.arm(spark, sf_dir, n) for n in ("every", "even", "good")})


# --- estimates -------------------------------------------------------------------------

_RATIOS = (0.4, 0.3)
_DIM = "arms as (select 'every' as arm, count(*) as docs, sum(length(coalesce(text, '')) // 4) as source_tokens from documents union all select 'even', count(*), sum(length(coalesce(text, '')) // 4) from documents where doc_id % 2 = 0), jobs as (select arm, p.prompt_id, docs, source_tokens, p.ratio, cast(floor(source_tokens * p.ratio) as bigint) as est_output_tokens from arms, (values ('p1', 0.4::double), ('p2', 0.3::double)) p(prompt_id, ratio))"


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    arms = []
    for name in ("every", "even"):
        n, tokens = fx.arm(spark, sf_dir, name).agg(F.count(F.lit(1)), F.sum(F.floor(F.length(F.coalesce("text", F.lit(""))) / 4))).first()
        arms.append(Arm(name, name, ("p1", "p2"), n, tokens, _RATIOS))
    return estimate.job_dimension(spark, arms)


_TIMED = _STATS.replace("stats as", "raw_stats as") + ", timed as (select *, case when shard_index % 7 = 0 then null else 1.0 + shard_index % 5 end as elapsed_s, 'host' || shard_index % 3 as host, case when shard_index % 2 = 0 then 'card-a' else 'card-b' end as gpu_name from raw_stats)"


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("shard_index")
    return _stats(spark, sf_dir).withColumns({"elapsed_s": F.when(k % 7 != 0, 1.0 + k % 5), "host": F.concat(F.lit("host"), (k % 3).cast("string")), "gpu_name": F.when(k % 2 == 0, F.lit("card-a")).otherwise(F.lit("card-b"))})


@query(f"with {_DIM} select (select count(*) from jobs) as n_jobs, (select sum(docs) from jobs) as est_rows, (select sum(source_tokens) from arms) as source_tokens, (select sum(est_output_tokens) from jobs) as est_output_tokens")
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.corpus_totals(_dim(spark, sf_dir))


@query(f"with {_DIM}, {ORDERED_SQL} select 'every' as arm, (select count(*) from o) as total_rows, (select sum(b) from o) as total_text_bytes, (select count(distinct ord // {fx.TARGET_ROWS}) from o) as n_shards, (select sha1(string_agg(h, '' order by ord)) from o) as content_sha1, count(*) as n_jobs, sum(est_output_tokens) as est_output_tokens, max(source_tokens) as source_tokens from jobs where arm = 'every'")
def corpus_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = materialize(sharding.cut(sharding.ordered(table(spark, sf_dir, "documents")), fx.TARGET_ROWS), "sharded")
    return estimate.rollup(_dim(spark, sf_dir), sharding.manifest(held, "every", fx.TARGET_ROWS, fx.TARGET_BYTES, OUTPUT_KEYS))


@query(f"with {_DIM} select arm, prompt_id, round(est_output_tokens * 4.2::double + docs * 297, 3) as raw_bytes, round((est_output_tokens * 4.2::double + docs * 297) * 0.3::double, 3) as zstd_bytes from jobs")
def disk_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.disk_estimate(_dim(spark, sf_dir)).select("arm", "prompt_id", F.round("raw_bytes", 3).alias("raw_bytes"), F.round("zstd_bytes", 3).alias("zstd_bytes"))


@query(
    f"with recursive {FOLD_SQL}, {_rows_sql(fx.WIKI)}, {_TIMED} select count(*) as shards, round(sum(n_output_tokens) / sum(elapsed_s), 6) as tok_s_per_gpu, round(sum(n_output_tokens) / sum(n_rows_out), 6) as tok_per_doc, round(sum(n_prompt_tokens) / sum(elapsed_s), 6) as in_tok_s_per_gpu, "
    "round(sum(n_prompt_tokens) / sum(n_rows_out), 6) as in_tok_per_doc, count(distinct host) as hosts, string_agg(distinct gpu_name, ',' order by gpu_name) as cards from timed where elapsed_s > 0"
)
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = estimate.throughput(_timed(spark, sf_dir))
    return rates.withColumns({c: F.round(c, 6) for c in ("tok_s_per_gpu", "tok_per_doc", "in_tok_s_per_gpu", "in_tok_per_doc")})


@query(f"with recursive {FOLD_SQL}, {_rows_sql(fx.WIKI)}, {_TIMED}, m as (select sum(n_prompt_tokens) / sum(n_output_tokens) as mix from timed where elapsed_s > 0) select round(mix, 6) as mix, abs(mix - 720.0 / 261.5) / (720.0 / 261.5) < 0.25 as as_expected from m")
def prefill_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.prefill_mix(estimate.throughput(_timed(spark, sf_dir))).withColumn("mix", F.round("mix", 6))


_HOURS = "h as (select *, est_output_tokens / 10000.0::double / 3600 as hours from jobs)"


@query(f"with {_DIM}, {_HOURS} select arm, prompt_id, docs, est_output_tokens, round(est_output_tokens / docs, 6) as tok_per_doc, round(hours, 9) as hours, case when hours < 1 then printf('%.0f min', hours * 60) when hours < 48 then printf('%.1f h', hours) else printf('%.1f days', hours / 24) end as wall from h")
def job_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.project(_dim(spark, sf_dir), 2500.0, 4).withColumns({"tok_per_doc": F.round("tok_per_doc", 6), "hours": F.round("hours", 9)})


@query(f"with {_DIM}, {_HOURS}, t as (select sum(hours) as total from h) select speed, nodes, round(total / speed / nodes, 9) as hours from t, (values (0.5::double), (1.0::double), (2.0::double)) s(speed), (values (1), (5), (10), (25)) n(nodes)")
def projection_sensitivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.sensitivity(estimate.project(_dim(spark, sf_dir), 2500.0, 4)).withColumn("hours", F.round("hours", 9))


@query(f"with {_DIM}, r as (select arm, prompt_id, 300.0::double / (est_output_tokens / docs) as ratio from jobs) select arm, prompt_id, round(ratio, 6) as ratio, ratio between 0.5 and 2.0 as ok from r")
def rate_cross_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.cross_check(_dim(spark, sf_dir), 300.0).withColumn("ratio", F.round("ratio", 6))


@query(f"with {_DIM} select arm, cast(ceil(docs / 5.0) as bigint) as n_shards, cast(ceil(docs / 5.0) as bigint) // 20 as max_gpus from arms")
def gpu_ceiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.gpu_ceiling(_dim(spark, sf_dir), 5)


@query(f"with {_DIM} select arm, sum(est_output_tokens) as produced, round(sum(est_output_tokens) / 100000.0::double - 1, 6) as headroom from jobs group by arm")
def budget_headroom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return estimate.headroom(_dim(spark, sf_dir), 100_000).withColumn("headroom", F.round("headroom", 6))


@query(f"with recursive {FOLD_SQL}, {_rows_sql(fx.WIKI)}, {_TIMED}, d as (select * from timed where elapsed_s > 0 and shard_index < 6) select sum(n_rows_out) as rows_done, round(sum(n_rows_out) / sum(elapsed_s), 6) as docs_s, round(sum(n_output_tokens) / sum(elapsed_s), 6) as tok_s, round((1000 - sum(n_rows_out)) / (sum(n_rows_out) / sum(elapsed_s)), 6) as eta_s from d")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = estimate.progress(_timed(spark, sf_dir).filter("elapsed_s is not null and shard_index < 6"), 1000)
    return out.withColumns({c: F.round(c, 6) for c in ("docs_s", "tok_s", "eta_s")})
