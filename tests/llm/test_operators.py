"""Each operator on awkward tables: nulls, empty and long texts, ties, repeats, clashing columns, no rows."""

import collections
import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from palimpsest.llm import bpe, contamination, licenses, lmscore, neardup, packing, pseudonyms, quality, queries, sharding, tokencount, urlfilter

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{k % 997}" for k in range(20000))


@pytest.fixture(scope="module")
def rows():
    prose = [" ".join(f"{c}{k}{j}" for j in range(40)) for k, c in enumerate("abc")]
    out = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one two three"), (5, "one two three"), (6, prose[0]), (7, prose[0]), (7, prose[0]), (8, prose[0] + " end"),
        (9, prose[1]), (None, prose[1]), (None, None), (10, LONG), (11, LONG + " tail"), (12, "mail bob@mail1.example.com 13.216.148.142"), (13, "Released under the MIT License."), (14, "<|endoftext|> é\u3000漢 \xa0x"),
    ]
    return [(i, t, "en", "s", len(t or "")) for i, t in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns that are named like what the operators add or use inside."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("n_words", "kept", "shard", "score", "length", "block", "_text_read", "n_tokens", "label", "node", "key", "size"):
        df = df.withColumn(c, F.lit("clash"))
    return df


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def by_row(df):
    return collections.Counter(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def library():
    return bpe.Encoder(queries.tokenizer_files()[0])


def test_pseudonyms(docs, none, rows):
    got = pseudonyms.pseudonymise(docs, ["doc_id", "text"]).collect()
    assert len(got) == len(rows) and pseudonyms.pseudonymise(none, ["doc_id", "text"]).count() == 0
    changed = {r["doc_id"]: r for r in got if r["n_replaced"]}
    assert list(changed) == [12] and (changed[12]["n_email"], changed[12]["n_ipv4"]) == (1, 1) and "bob@" not in changed[12]["text"]
    rest = collections.Counter((i, t) for i, t, *_ in rows if i != 12)
    assert collections.Counter((r["doc_id"], r["text"]) for r in got if r["doc_id"] != 12) == rest


def test_urls(spark, same):
    same("op2", queries.QUERIES["op2_bloom_cascade"], queries.ORACLES["op2_bloom_cascade"])
    urls = [None, "", "no scheme", "http://A.Example.COM/en/x?y#z", "http://www.example.com/en/", "x://net/es/a://b", "http://net?q/fr/", "http://a.net/fr", "https://é.org", "http://notexample.com/en/"]
    pages = spark.createDataFrame([(k, u, "c") for k, u in enumerate(urls)] + [(3, urls[3], "c")], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in urlfilter.judge_urls(pages, queries.URL_RULES, F.col("host") == "a.net").collect()}
    assert [(got[k]["host"], got[k]["path"]) for k in (0, 1, 2)] == [("", "")] * 3
    assert (got[3]["host"], got[3]["path"], got[3]["rule"], got[3]["verdict"]) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert (got[4]["rule"], got[4]["verdict"]) == ("www.example.com/en/", "allow") and got[9]["rule"] == "com/"
    assert (got[5]["host"], got[5]["rule"]) == ("net", "net/es/") and (got[6]["host"], got[6]["path"]) == ("net", "")
    assert (got[7]["rule"], got[7]["verdict"]) == (None, "block") and got[8]["verdict"] == "allow"
    assert urlfilter.judge_urls(pages.filter("false"), queries.URL_RULES, F.lit(True)).count() == 0


def test_cascade_in_passes(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "KEYS_PER_SEGMENT", 100)
    monkeypatch.setattr(urlfilter, "BROADCAST_BYTES", 60)
    keys = spark.range(1000).select(F.concat(F.lit("h"), "id").alias("host"), "id")
    cascade, segments = urlfilter.build_cascade(keys, "host", F.col("id") % 7 == 0)
    got = urlfilter.mark_listed(keys, "host", cascade, segments).collect()
    assert segments == 10 and all(r["listed"] == (r["id"] % 7 == 0) for r in got) and len(got) == 1000


def check_packing(got, want, library):
    """`want`: (doc_id, text) rows, each packed whole."""
    pieces = collections.Counter()
    for i, t in want:
        ids = library.whole(t or "") + [0]
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            pieces[i, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))] += 1
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == pieces
    held = collections.defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(held)


def test_packing(spark, docs, none, rows, library):
    got = packing.pack_documents(docs, *queries.tokenizer_files()).collect()
    check_packing(got, [r[:2] for r in rows], library)
    assert packing.pack_documents(none, *queries.tokenizer_files()).count() == 0
    table = spark.read.parquet(f"{SF}/documents.parquet")
    got = queries.op3_grouping_genetic(spark, SF).collect()
    n = check_packing(got, [(r["doc_id"], r["text"]) for r in table.collect()], library)
    assert n <= -(-sum(r["length"] for r in got) // 2048) * 1.02 + 1


def test_islands_improve_on_best_fit(spark):
    from palimpsest.llm.grouping import bins, fill

    rng = np.random.default_rng(3)
    counts = collections.Counter(rng.integers(300, 1100, 120).tolist())
    got = packing.pack_histogram(spark, counts, islands=3, epochs=2, generations=8)
    assert sum(fill(p) * n for p, n in got.items()) == sum(s * n for s, n in counts.items())
    assert bins(got) <= bins(packing.best_fit(counts, 2048))


def test_token_counts(docs, none, rows, library):
    got = by_row(tokencount.count_tokens(docs, *queries.tokenizer_files(), huge=4000, chunk=700, overlap=20))
    want = collections.Counter((i, len((t or "").encode()), n := len(library.whole(t or "")), n > 512) for i, t, *_ in rows)
    assert got == want
    assert tokencount.count_tokens(none, *queries.tokenizer_files()).count() == 0


def test_resynchronisation(library):
    splice = tokencount.Resynchroniser(library, 50, 6)
    rng = np.random.default_rng(2)
    parts = ["a", "the", "é", " ", "  ", "\n", "\xa0", "23", "'s", "<|endoftext|>", "漢", "x" * 90, "!"]
    for _ in range(200):
        t = "".join(rng.choice(parts, rng.integers(1, 90)))
        assert splice.encode(t).tolist() == library.whole(t)
    assert splice.widened > 0


def test_encoder(library):
    fast = bpe.Encoder(*queries.tokenizer_files())
    rng = np.random.default_rng(5)
    parts = ["a", "the", "é", " ", "  ", "\n", "\t", "\xa0", "\u3000", "23", "'s", "'", "<|endoftext|>", "<|", "漢", "!", "🙂"]
    texts = ["".join(rng.choice(parts, rng.integers(0, 40))) for _ in range(1500)] + ["", " ", "a ", " a"]
    counts, ids = fast.encode(pa.array(texts))
    assert [len(library.whole(t)) for t in texts] == counts.tolist() and sum((library.whole(t) for t in texts), []) == ids.tolist()


def test_scores(spark, docs, none, rows, monkeypatch):
    from palimpsest.llm import ctw

    got = lmscore.score_documents(docs, block_bytes=40_000).collect()
    assert len(got) == len(rows) and lmscore.score_documents(none).count() == 0
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, *_ in rows}
    words = [(i, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()) for i, t, *_ in rows]
    known = collections.Counter(w for i, ws in words for w in [*ws, b"\xff"] if not held[i])
    total, distinct = sum(known.values()), len(known)
    want = collections.Counter((i, len(w) + 1, sum(known[x] > 0 for x in [*w, b"\xff"]), round(sum(np.log10((known[x] + 0.1) / (total + 0.1 * (distinct + 1))) for x in [*w, b"\xff"]), 4)) for i, w in words)
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in got) == want
    # The distributed tree equals one built in a single piece.
    texts = pa.array([t or "" for _, t, *_ in rows])
    data, ends = ctw.stream(texts)
    number, keys = ctw.index(data)
    counted, starts = lmscore._scored(ends, len(number), ctw.DEPTH)
    learn = counted & np.repeat([not held[i] for i, *_ in rows], ends - starts)
    values = ctw.code_length(keys, ctw.subtree(keys, np.bincount(number[learn], minlength=len(keys)), 0))
    score = np.add.reduceat(np.where(counted, values[number], 0), starts)
    assert collections.Counter((r["doc_id"], round(r["score"], 4)) for r in got) == collections.Counter((i, round(s, 4)) for (i, *_), s in zip(rows, score))
    assert all(r["train_tokens"] == total and r["held_out"] == held[r["doc_id"]] for r in got)


def test_scores_beat_the_base_on_held_out_documents(spark):
    scored = lmscore.score_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), block_bytes=1 << 20)
    total = scored.filter("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert total[2] > 50 and total[0] > total[1]


def test_quality(spark, docs, none, rows):
    got = quality.judge_quality(docs, [], ["doc_id"]).collect()
    assert len(got) == len(rows) and all(r["kept"] == (not r["base_failed"]) for r in got)
    assert quality.judge_quality(none, [], ["doc_id"]).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit(docs, empty) == []
    labels, table = spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = quality.judge_quality(table, quality.fit(table, labels), ["doc_id"]).join(labels, "doc_id")
    n = {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0)) and n.get((1, False), 0) <= 0.05 * n[1, True]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_contamination(spark, docs, none, rows, limit):
    a = " ".join(f"a0{j}" for j in range(5, 20))
    benchmark = spark.createDataFrame([(20, a), (3, a), (4, "one two"), (5, None), (6, ""), (None, "w1 w2")], "item_id long, text string")
    got = contamination.find_contamination(docs, benchmark, ["doc_id"], pass_bytes=limit).collect()
    assert len(got) == len(rows)
    one = {r["doc_id"]: r for r in got}
    assert (one[6]["n_words"], one[6]["n_hit"], one[6]["n_items"], one[6]["contaminated"]) == (40, 15, 2, True)
    assert one[6]["items_sha256"] == hashlib.sha256(b"20,3").hexdigest() and one[6]["item_ids"] == ["20", "3"]
    assert (one[4]["n_hit"], one[4]["item_ids"]) == (2, ["4"]) and one[1]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (one[10]["n_hit"] > 0, one[10]["n_items"], one[10]["contaminated"]) == (True, 0, False)
    assert contamination.find_contamination(none, benchmark, ["doc_id"]).count() == 0
    assert contamination.find_contamination(docs, benchmark.filter("false"), ["doc_id"]).filter("n_hit > 0").count() == 0


def test_contamination_matches_sql(same):
    same("op7", queries.QUERIES["op7_wu_manber"], queries.ORACLES["op7_wu_manber"])


def test_two_benchmarks_in_one_worker(spark):
    """Tables of an earlier benchmark are never searched again, whatever object held them."""
    texts = spark.createDataFrame([(k, " ".join(f"t{k}x{j}" for j in range(30))) for k in range(6)], "doc_id long, text string").coalesce(1)
    for k in [0, 1, 2, 3, 4, 5, 0, 3]:
        own = spark.createDataFrame([(k, " ".join(f"t{k}x{j}" for j in range(14)))], "item_id long, text string")
        assert [r["doc_id"] for r in contamination.find_contamination(texts, own, ["doc_id"]).filter("n_hit > 0").collect()] == [k]


def test_long_items_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(contamination, "CHUNK_WINDOWS", 5)
    words = [f"q{j}" for j in range(60)]
    benchmark = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:12])), (3, " ".join(words[40:53]))], "item_id long, text string")
    runs = [(a, b) for a in range(0, 60, 7) for b in (a + 12, a + 13, a + 20) if b <= 60]
    docs = spark.createDataFrame([(k, "x " + " ".join(words[a:b]) + " y z") for k, (a, b) in enumerate(runs)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in contamination.find_contamination(docs, benchmark, ["doc_id"], pass_bytes=120).collect()}
    for k, (a, b) in enumerate(runs):
        hit, names = set(), set()
        for item, lo, hi, width in ((1, 0, 60, 13), (2, 0, 12, 12), (3, 40, 53, 13)):
            for s in range(lo, hi - width + 1):
                if a <= s and s + width <= b:
                    hit |= set(range(s, s + width))
                    names.add(str(item))
        assert (got[k]["n_hit"], got[k]["item_ids"], got[k]["longest_hit"]) == (len(hit), sorted(names), len(hit))


def test_licenses(spark, docs, none):
    files = spark.createDataFrame(
        [(1, "a/LICENSE", "words. Released under the MIT License. words"), (2, "a/b/c.txt", None), (3, "a/b/COPYING.txt", "licensed under the apache license, version 2.0"), (4, "x/y", ""), (5, None, "Licensed under CC BY-NC 4.0."), (6, "top", "prose about a license"), (7, "a/b/d/e.txt", "Released under the BSD 3-Clause License.")],
        "doc_id long, path string, text string",
    ).withColumn("license", F.lit("clash"))
    got = {r["doc_id"]: (r["own_license"], r["license"], r["inherited_from"]) for r in licenses.scan_licenses(files).collect()}
    assert got == {1: ("MIT", "MIT", None), 2: (None, "Apache-2.0", "a/b"), 3: ("Apache-2.0", "Apache-2.0", None), 4: (None, None, None), 5: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None), 6: (None, None, None), 7: ("BSD-3-Clause", "BSD-3-Clause", None)}
    assert licenses.scan_licenses(files.filter("false")).count() == 0
    assert queries.op8_license_tfidf(spark, SF).count() == 200
    # Repeated rows, null ids and clashing columns.
    got = licenses.scan_licenses(docs.withColumn("path", F.concat(F.lit("p/"), "doc_id")), path_col="path").collect()
    assert len(got) == docs.count() and {r["doc_id"] for r in got if r["own_license"]} == {13}


def as_comment(text, mark="# ", width=9):
    words = text.split()
    return "\n".join(mark + " ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_real_licences(spark):
    """Licence files, notices and tags as they stand in repositories, among code and prose."""
    from palimpsest.llm import license_texts as t

    code = "\n\nimport os\n\ndef main(argv):\n    return os.path.join(*argv)  # the rest of the file\n" * 20
    gpl = "This file is part of Foo.\n\nFoo is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.\n\nFoo is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.\n\nYou should have received a copy of the GNU General Public License along with Foo.  If not, see <https://www.gnu.org/licenses/>."
    cases = [
        ("MIT", "MIT License\n\nCopyright (c) 2019 Jane Doe\n\n" + t._MIT), ("MIT", as_comment(t._MIT, " * ") + code), ("MIT", "// SPDX-License-Identifier: MIT" + code),
        ("Apache-2.0", "Copyright 2021 The Authors\n\n" + as_comment(t._APACHE_NOTICE) + code), ("Apache-2.0", t._APACHE_HEAD + " " + code * 5),
        ("BSD-3-Clause", "Copyright (c) 2001, Someone\nAll rights reserved.\n\n" + t._BSD_HEAD + t._BSD_THIRD + t._BSD_TAIL), ("BSD-2-Clause", as_comment(t._BSD_HEAD + t._BSD_TAIL)),
        ("GPL-3.0-or-later", as_comment(gpl) + code), ("GPL-3.0-or-later", gpl.replace("either version 3", "either version 3")), ("GPL-2.0-or-later", as_comment(gpl.replace("version 3", "version 2"), "; ")),
        ("GPL-3.0-only", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.\n\nPreamble\n\n" + code),
        ("GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nCopyright (C) 1989, 1991 Free Software Foundation, Inc.,\n51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed." + code),
        ("LGPL-2.1-only", "# SPDX-License-Identifier: LGPL-2.1-only" + code), ("MPL-2.0", as_comment(t._MPL_NOTICE) + code), ("ISC", "Copyright (c) 2010, A B <a@b.org>\n\n" + t._ISC), ("Unlicense", t._UNLICENSE + code), ("Zlib", as_comment(t._ZLIB)),
        (None, "# SPDX-License-Identifier: Foo-1.0" + code), (None, code), (None, "A licence is a document. The software is provided to us as a gift, under the terms of our friends." + code),
        (None, "Permission is hereby granted to park here." + code),
    ]
    files = spark.createDataFrame([(k, f"f{k}", text) for k, (_, text) in enumerate(cases)], "doc_id long, path string, text string")
    # Among a corpus in which licences are rare, as their terms then weigh most.
    others = spark.read.parquet(f"{SF}/documents.parquet").select((F.col("doc_id") + 1000).alias("doc_id"), F.lit("x").alias("path"), "text")
    got = {r["doc_id"]: r["own_license"] for r in licenses.scan(files.union(others)).collect()}
    assert [(k, got[k]) for k in range(len(cases))] == [(k, name) for k, (name, _) in enumerate(cases)]


def test_licences_against_all_windows(spark):
    """Cosines by brute force over every window of every text."""
    import math

    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.lit("x").alias("path"), "text").orderBy("doc_id").limit(80)
    held = [(r["doc_id"], r["text"]) for r in table.collect()] + [(900, "so licensed under the gnu lesser public license version 3 of the gnu"), (901, "mit the mit"), (902, "")]
    files = spark.createDataFrame([(i, "x", t) for i, t in held], "doc_id long, path string, text string")
    templates = [x for x in licenses.TEMPLATES if len(x[1]) < 120 or x[0] == "ISC"]
    terms = {w for _, t, keys in templates for w in licenses.tokens(t + " " + keys)}
    df = collections.Counter(w for _, t in held for w in set(licenses.tokens(t or "")) & terms)
    idf = lambda w: math.log((1 + len(held)) / (1 + df[w])) + 1

    def vector(counts):
        return {w: n * idf(w) for w, n in counts.items() if n}

    want = {}
    for i, t in held:
        words, best = licenses.tokens(t or ""), (None, 0.0)
        for name, text, keys in templates:
            own, keys = vector(collections.Counter(licenses.tokens(text))), set(licenses.tokens(keys))
            size = min(len(licenses.tokens(text)), len(words))
            window = collections.Counter(words[:size])
            for s in range(len(words) - size + 1 if words else 0):
                if s:
                    window[words[s - 1]] -= 1
                    window[words[s + size - 1]] += 1
                if all(window[w] > 0 for w in keys) and any(window[w] > 0 for w in own):
                    other = vector(window)
                    c = sum(v * other.get(w, 0) for w, v in own.items()) / math.sqrt(sum(v * v for v in own.values()) * sum(v * v for v in other.values()))
                    if c >= licenses.SIMILARITY and c > best[1] + 1e-9:
                        best = (name, c)
        want[i] = (best[0], round(best[1], 6))
    got = {r["doc_id"]: (r["own_license"], round(r["score"], 6)) for r in licenses.scan(files, templates).collect()}
    assert got == want and sum(name is not None for name, _ in want.values()) > 1


def classes(texts):
    """Brute force over all pairs of (id, text)."""
    ids = [i for i, _ in texts]
    doc, h, w = neardup.shingles(pa.array([t or "" for _, t in texts]))
    at = np.searchsorted(doc, np.arange(len(texts) + 1))
    sets = [(h[a:b], w[a:b]) for a, b in zip(at[:-1], at[1:])]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = collections.defaultdict(set)
    for k, (s, _) in enumerate(sets):
        for x in s.tolist():
            where[x].add(k)
    for a, b in {(min(a, b), max(a, b)) for held in where.values() for a in held for b in held if a != b}:
        if neardup.probability_jaccard(sets[a], sets[b]) >= 0.8 - 1e-9:
            x, y = find(ids[a]), find(ids[b])
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near_duplicates(spark, docs, none, rows):
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(rows) and neardup.near_duplicates(none).count() == 0
    one = {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None}
    assert one == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 9, 10: 10, 11: 10, 12: 12, 13: 13, 14: 14}
    assert sorted((r["class_id"], r["kept"]) for r in got if r["doc_id"] is None and r["class_id"]) == [(9, False)]
    assert [r["kept"] for r in got if r["doc_id"] is None and r["class_id"] is None] == [True]
    assert sum(r["kept"] for r in got) == 11
    table = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r["doc_id"]: r["class_id"] for r in queries.op9_prob_min_hash(spark, SF).collect()}
    assert got == classes(table)


def test_chains_and_families(spark, monkeypatch):
    """A base with variants that are only like the base, and a chain whose ends are unlike each other."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 4)
    monkeypatch.setattr(neardup, "TURN_MEMBERS", 3)
    monkeypatch.setattr(neardup, "AT_ONCE", 2)
    rng = np.random.default_rng(8)
    base = [f"b{k}" for k in range(200)]
    texts = []
    for v in range(20):
        words = list(base)
        for k in rng.choice(200, 3, replace=False):
            words[k] = f"v{v}x{k}"
        texts.append(" ".join(words))
    texts.insert(11, " ".join(base))
    for v in range(12):
        texts.append(" ".join(f"c{k}" for k in range(v * 6, v * 6 + 120)))
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == classes(rows)


def test_components(spark):
    from palimpsest.llm.components import components

    edges = [(k, k + 1) for k in range(0, 30)] + [(40, 42), (41, 42), (43, 43)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {40: 40, 41: 40, 42: 40}


def test_sharding(spark, docs, none, rows):
    got = sharding.shard_documents(docs, 3).collect()
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert sharding.shard_documents(none).count() == 0
    got = queries.op10_best_fit_decreasing(spark, SF).collect()
    slots, size, group = collections.defaultdict(list), collections.Counter(), {}
    for r in got:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
        assert group.setdefault((r["size"], r["text_crc32"]), r["shard"]) == r["shard"] and r["law"] == "bytes" and r["grown_shard"] is None
    assert sorted(slots) == list(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) - min(size.values()) <= max(r["size"] for r in got)
