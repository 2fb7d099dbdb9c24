import collections

import corpus_pipeline
from palimpsest.llm import neardup
from palimpsest.llm.contamination import find_contamination
from test_operators import SF, by_row, check_packing, classes, docs, library, none, rows  # noqa: F401


def test_stages_keep_columns_and_survive_awkward_rows(spark, docs, none):  # noqa: F811
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert out.count() <= docs.count()
        assert stage(spark, none, SF).count() == 0
    kept = [r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, SF).collect()]
    assert collections.Counter(kept) == collections.Counter([1, 2, 3, 4, 6, 9, 10, 12, 13, 14, None])


def test_run_equals_the_stages_by_hand(spark, library):  # noqa: F811
    table = spark.read.parquet(f"{SF}/documents.parquet")
    good = corpus_pipeline.quality_rules(spark, table, SF)
    texts = {r["doc_id"]: r["text"] for r in good.collect()}
    label = classes(sorted(texts.items()))
    first = {i for i in texts if label[i] == i}
    dirty = {r["doc_id"] for r in find_contamination(table, spark.read.parquet(f"{SF}/benchmark.parquet"), ["doc_id"]).filter("n_hit > 0").collect()}
    from palimpsest.llm.pseudonyms import DEMO_KEY, Pseudonymiser

    work = Pseudonymiser(DEMO_KEY)
    want = [(i, work.replace(texts[i])[0]) for i in sorted(first - dirty)]
    check_packing(corpus_pipeline.run(spark, SF).collect(), want, library)


def test_passage_in_a_long_document(spark):
    """A whole benchmark passage far under a twentieth of its document, and a short item's words by chance."""
    item = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()][0]
    prose = " ".join(f"w{k}" for k in range(4000))
    rows = [(1, f"{prose} {item} {prose}"), (2, prose), (3, None), (4, ""), (None, prose), (2, prose)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.decontaminate(spark, docs, SF).orderBy("doc_id").collect()] == [None, 2, 2, 3, 4]


def test_no_text_is_lost_when_its_id_repeats(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(40)) for c in "ab")
    def left(rows):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        return sorted(map(tuple, corpus_pipeline.near_copies(spark, docs, SF).collect()), key=str)

    assert left([(5, a), (7, a), (3, b), (5, b)]) == [(3, b), (5, a)]
    assert left([(5, a), (5, b), (5, a)]) == [(5, a), (5, b)]
    assert left([(None, a), (None, a), (None, b), (2, b)]) == [(2, b), (None, a)]
    assert left([(1, a), (1, a + " more"), (1, b)]) in ([(1, a), (1, b)], [(1, a + " more"), (1, b)])
