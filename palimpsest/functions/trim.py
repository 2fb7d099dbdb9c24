"""Start-anchored trim rules for rewritten texts, as native column expressions.

Each rule takes a text column and returns (new text, stripped?). Positions are code points.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The phrases and limits the rules test.
LEAK_ANCHOR = "Important: Do not add any information, claims, or details that are not"
WIKI_PREFIX = "Here is a paraphrased version:\n\n"
DISTILL_LIMIT = 120
DISTILL_WORDS = ["paraphras", "condensed", "rewrit", "summary", "version"]
DISTILL_OPENERS = ["here is", "here's", "here are", "certainly", "sure", "below is", "of course", "the following is"]
WRAP_LIMIT = 300
WRAP_OPENERS = [
    "Here is", "Here's", "Here are", "Below is", "Below are",
    "Sure, here", "Sure! Here", "Sure, here's", "Sure thing, here",
    "Certainly! Here", "Certainly, here", "Of course! Here", "Of course, here",
    "I have rewritten", "I've rewritten", "I have reworded", "I've reworded",
    "The following is", "This is the rewritten", "This is a rewritten",
    "Rewritten passage", "Rewritten version", "Rewritten text",
    "Here is a paraphrased", "Here's the rewritten", "Here is the rewritten",
]
WRAP_SIGNALS = [
    "passage", "rewritten", "rewrite", "reworded", "rephrased", "paraphrase",
    "version", "simplified", "simpler", "plain language", "neutral", "factual",
    "summary", "question", "q&a", "style", "reading level", "young child", "requested",
]
WRAP_STRICT = [
    "paraphras", "rewritten", "rewrite", "reworded", "rephrased",
    "simple version", "simpler version", "simplified version", "plain language",
    "condensed version", "scholarly language", "young child version",
]
HEADERS = ["###", "##", "**"]
#: White space that stripping a head removes.
SPACES = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

Trimmed = tuple[Column, Column]


def _any(test: Callable[[Column, Column], Column], text: Column, phrases: list[str]) -> Column:
    found = F.lit(False)
    for p in phrases:
        found = found | test(text, F.lit(p))
    return found


def _starts(text: Column, phrases: list[str]) -> Column:
    return _any(F.startswith, text, phrases)


def _holds(text: Column, phrases: list[str]) -> Column:
    return _any(F.contains, text, phrases)


def _lstrip(text: Column) -> Column:
    return F.regexp_replace(text, F.lit("^" + SPACES + "+"), F.lit(""))


def _strip(text: Column) -> Column:
    return F.regexp_replace(_lstrip(text), F.lit(SPACES + r"+\z"), F.lit(""))


def _within(text: Column, mark: str, limit: int) -> tuple[Column, Column]:
    """1-based place of the first `mark`, and whether at most `limit` characters precede it."""
    at = F.instr(text, mark)
    return at, at.between(1, limit + 1)


def leak(text: Column) -> Trimmed:
    """Cut a leaked instruction paragraph; all of the text where nothing follows it."""
    at = F.instr(text, "\n\n")
    hit = F.coalesce(F.startswith(text, F.lit(LEAK_ANCHOR)), F.lit(False))
    return F.when(hit, F.when(at > 0, F.substr(text, at + 2)).otherwise(F.lit(""))).otherwise(text), hit


def wiki(text: Column) -> Trimmed:
    """Slice the exact prefix, then the leak rule. Null stays null."""
    hit = F.coalesce(F.startswith(text, F.lit(WIKI_PREFIX)), F.lit(False))
    rest, leaked = leak(F.when(hit, F.substr(text, F.lit(len(WIKI_PREFIX) + 1))).otherwise(text))
    return rest, hit | leaked


def distill(text: Column) -> Trimmed:
    """A meta paragraph within the limit; failing that, a meta line that ends in a colon."""

    def parts(at: Column) -> tuple[Column, Column, Column, Column, Column]:
        head = _strip(F.substr(text, F.lit(1), at - 1))
        low = F.lower(head)
        return F.endswith(head, F.lit(":")), _holds(low, DISTILL_WORDS), _starts(head, HEADERS), _starts(low, DISTILL_OPENERS), F.startswith(low, F.lit("paraphrased"))

    p, near = _within(text, "\n\n", DISTILL_LIMIT)
    colon, word, header, opener, label = parts(p)
    paragraph = F.coalesce(near & ((header & word) | (opener & word) | (label & colon)), F.lit(False))
    q, near = _within(text, "\n", DISTILL_LIMIT)
    colon, word, header, opener, label = parts(q)
    line = F.coalesce(near & colon & word & (header | opener | label), F.lit(False))
    after_line = F.regexp_replace(F.substr(text, q + 1), F.lit(r"^\n+"), F.lit(""))
    return F.when(paragraph, F.substr(text, p + 2)).when(line, after_line).otherwise(text), paragraph | line


def wrap(text: Column) -> Trimmed:
    """A meta paragraph by opener or header, then the leak rule. Null becomes empty."""
    text = F.coalesce(text, F.lit(""))
    at, near = _within(text, "\n\n", WRAP_LIMIT)
    head = F.substr(text, F.lit(1), at - 1)
    low = F.lower(head)
    sentence = _starts(head, WRAP_OPENERS) & _holds(low, WRAP_SIGNALS)
    header = (_starts(_lstrip(head), HEADERS) | _starts(low, ["paraphrased", "rewritten passage"])) & _holds(low, WRAP_STRICT)
    hit = near & (sentence | header)
    rest, leaked = leak(F.when(hit, F.substr(text, at + 2)).otherwise(text))
    return rest, hit | leaked


#: Rules by the name a prompt gives in its `trim` field.
RULES: dict[str, Callable[[Column], Trimmed]] = {"wiki": wiki, "distill": distill, "wrap": wrap}
