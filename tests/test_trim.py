import random

from pyspark.sql import functions as F

from palimpsest.functions import trim


def restated_leak(t):
    if t and t.startswith(trim.LEAK_ANCHOR):
        _, mark, rest = t.partition("\n\n")
        return (rest if mark else ""), True
    return t, False


def restated_wiki(t):
    had = t is not None and t.startswith(trim.WIKI_PREFIX)
    rest, leaked = restated_leak(t[len(trim.WIKI_PREFIX) :] if had else t)
    return rest, had or leaked


def restated_distill(t):
    if not t:
        return t, False

    def facts(head):
        low = head.lower()
        return low, any(w in low for w in trim.DISTILL_WORDS), head.startswith(tuple(trim.HEADERS)), low.startswith(tuple(trim.DISTILL_OPENERS)), low.startswith("paraphrased")

    p = t.find("\n\n")
    if 0 <= p <= 120:
        head = t[:p].strip()
        _, word, header, opener, label = facts(head)
        if (word and (header or opener)) or (label and head.endswith(":")):
            return t[p + 2 :], True
    q = t.find("\n")
    if 0 <= q <= 120:
        head = t[:q].strip()
        _, word, header, opener, label = facts(head)
        if head.endswith(":") and word and (header or opener or label):
            return t[q + 1 :].lstrip("\n"), True
    return t, False


def restated_wrap(t):
    t, hit = t or "", False
    p = t.find("\n\n")
    if 0 <= p <= 300:
        head = t[:p]
        low = head.lower()
        sentence = head.startswith(tuple(trim.WRAP_OPENERS)) and any(w in low for w in trim.WRAP_SIGNALS)
        header = (head.lstrip().startswith(tuple(trim.HEADERS)) or low.startswith(("paraphrased", "rewritten passage"))) and any(w in low for w in trim.WRAP_STRICT)
        if sentence or header:
            t, hit = t[p + 2 :], True
    rest, leaked = restated_leak(t)
    return rest, hit or leaked


def cases():
    fixed = [
        None, "", "\n\n", "Q: a?\nA: b", "### Frequently Asked Questions\n\nx", "### Case Summary\n\nx", "### Passage\n\nx", trim.WIKI_PREFIX, trim.WIKI_PREFIX + trim.LEAK_ANCHOR,
        trim.LEAK_ANCHOR + "\n\nbody", trim.LEAK_ANCHOR.lower() + "\n\nbody", "here is a paraphrased version:\n\nbody", "Here is the rewritten passage:\r\n\r\nbody", "Paraphrased text:\n\nbody", "**Condensed Version:**\n\n\nbody",
        " ### Paraphrased \n\nbody", "\U0001f600" * 119 + " rewritten\n\nbody", "Here is \U0001f600 version\n\nbody", "Sure, here's the summary:\nbody",
    ]
    for n in (118, 119, 120, 121, 298, 299, 300, 301):
        for lead in ("Here is the rewritten version ", "### Paraphrased "):
            fixed.append(lead + "x" * (n - len(lead)) + "\n\nbody")
            fixed.append(lead + "x" * (n - len(lead) - 1) + ":\nbody")
    rng = random.Random(7)
    bits = [*trim.WRAP_OPENERS, *trim.DISTILL_OPENERS, *trim.WRAP_SIGNALS, *trim.WRAP_STRICT, *trim.DISTILL_WORDS, *trim.HEADERS, trim.LEAK_ANCHOR, trim.WIKI_PREFIX, "\n", "\n\n", ":", " ", "\t", " ", "\x1c", "é", "Paraphrased", "Rewritten passage", "body text"]
    return fixed + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 7))) for _ in range(4000)]


def test_rules_match_a_restatement(spark):
    texts = cases()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    for name, rule in (("wiki", restated_wiki), ("distill", restated_distill), ("wrap", restated_wrap)):
        new, hit = trim.RULES[name](F.col("t"))
        for r in df.select("i", new.alias("new"), hit.alias("hit")).collect():
            assert (r["new"], r["hit"]) == rule(texts[r["i"]]), (name, texts[r["i"]])


def test_only_status_two_is_trimmed(spark):
    from palimpsest.functions.text import length_tokenizer
    from palimpsest.operators.postprocess import trim_rows

    rows = spark.createDataFrame([(k, trim.WIKI_PREFIX + "body", s, 9) for k, s in enumerate((0, 1, 2))], "doc_id long, rewritten_text string, status byte, n_output_tokens_llama2 int")
    got = {r["status"]: r for r in trim_rows(rows, "wiki", length_tokenizer(0)).collect()}
    assert got[2]["rewritten_text"] == "body" and got[2]["n_output_tokens_llama2"] == 1 and got[2]["stripped"]
    assert all(got[s]["rewritten_text"].startswith("Here") and got[s]["n_output_tokens_llama2"] == 9 and not got[s]["stripped"] for s in (0, 1))
