"""The registered queries of this subpackage, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.contamination import find_contamination
from palimpsest.llm.licenses import scan_licenses
from palimpsest.llm.lmscore import score_documents
from palimpsest.llm.neardup import near_duplicates
from palimpsest.llm.packing import pack_documents
from palimpsest.llm.pseudonyms import pseudonymise
from palimpsest.llm.quality import fit, judge_quality
from palimpsest.llm.sharding import shard_documents
from palimpsest.llm.tokencount import count_tokens
from palimpsest.llm.urlfilter import Rule, judge_urls
from palimpsest.runtime import table

#: The rules of the URL query.
URL_RULES = [
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
]


def op1_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), ["doc_id", "text"])


def op2_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in block list: hosts whose MD5 starts with 0 to 3."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES, F.md5(F.col("host")) < F.lit("4"))


OP2_SQL = r"""
with split as (
  select page_id,
    case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
  from pages),
parts as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from split),
fits as (
  select page_id, host, path, case
    when (host = 'www.example.com' or host like '%.www.example.com') and path like '/en/%' then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and path like '/en/%' then 'example.com/en/'
    when (host = 'net' or host like '%.net') and path like '/es/%' then 'net/es/'
    when (host = 'net' or host like '%.net') and path like '/fr/%' then 'net/fr/'
    when (host = 'com' or host like '%.com') and path like '/%' then 'com/' end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
       when md5(host) < '4' then 'block' else 'allow' end as verdict,
  md5(host) < '4' as listed
from fits
"""


def tokenizer_files() -> tuple[str, str, str]:
    """The byte-level vocabulary: the library's file, the same as ranks, and the split pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op3_grouping_genetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), *tokenizer_files())


def op4_resynchronised_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), *tokenizer_files())


def op5_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge_quality(docs, fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])


def op7_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.drop("item_ids", "longest_hit")


_OP7_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP7_SQL = f"""
with d as (select doc_id, {_OP7_WORDS} as w from documents),
b as (select cast(item_id as varchar) as item, {_OP7_WORDS} as w from benchmark),
passages as (
  select distinct item, least(13, len(w)) as n, array_to_string(w[i:i + 12], ' ') as p
  from (select item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
lengths as (select distinct n from passages),
windows as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as p
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths where len(w) >= n)),
found as (select doc_id, i, n, item from windows join passages using (n, p)),
covered as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from found) group by doc_id),
named as (select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as digest from (select distinct doc_id, item from found where item is not null) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, coalesce(digest, sha256('')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered using (doc_id) left join named using (doc_id)
"""


def as_files(docs: DataFrame) -> DataFrame:
    """The documents as a source tree: source/language/group/name, every eighth a licence file by name."""
    name = F.when(F.col("doc_id") % 8 == 0, F.lit("LICENSE-")).otherwise(F.lit("file-"))
    path = F.concat_ws("/", "source", "lang", F.concat(F.lit("group"), F.pmod(F.col("doc_id"), F.lit(5))), F.concat(name, F.col("doc_id")))
    return docs.select("doc_id", path.alias("path"), "text")


def op8_license_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(as_files(table(spark, sf_dir, "documents")))


def op9_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_best_fit_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel_pseudonyms": op1_feistel_pseudonyms,
    "op2_bloom_cascade": op2_bloom_cascade,
    "op3_grouping_genetic": op3_grouping_genetic,
    "op4_resynchronised_counts": op4_resynchronised_counts,
    "op5_context_tree": op5_context_tree,
    "op6_decision_list": op6_decision_list,
    "op7_wu_manber": op7_wu_manber,
    "op8_license_tfidf": op8_license_tfidf,
    "op9_prob_min_hash": op9_prob_min_hash,
    "op10_best_fit_decreasing": op10_best_fit_decreasing,
}
ORACLES: dict[str, str] = {"op2_bloom_cascade": OP2_SQL, "op7_wu_manber": OP7_SQL}
