"""Query understanding: complexity, splitting, normalising, rephrasing. Columns only."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from . import fixed_values as fv
from .text import strip, word_count, words

_QUESTIONS = r"\?"


def is_complex(q: Column) -> Column:
    """More than one question mark, any complexity sign, or more than 20 words."""
    low = F.lower(q)
    signs = F.lit(False)
    for p in fv.COMPLEXITY_PATTERNS:
        if p != "?.*?":  # not a valid expression; its meaning, two question marks, is tested below
            signs = signs | low.rlike(p)
    marks = F.regexp_count(q, F.lit(_QUESTIONS))
    return (marks > 1) | signs | (word_count(q) > fv.COMPLEX_WORDS)


def split_by_rule(q: Column) -> Column:
    """Sub-queries: the questions when there are several, else the parts around the first conjunction.

    The conjunction is looked for in lower case but split on as written.
    """
    questions = F.transform(
        F.filter(F.split(q, _QUESTIONS), lambda p: strip(p) != ""), lambda p: F.concat(strip(p), F.lit("?"))
    )
    out = F.array(q)
    for c in reversed(fv.SPLIT_CONJUNCTIONS):
        parts = F.transform(F.split(q, re.escape(c)), strip)
        out = F.when(F.lower(q).contains(c), parts).otherwise(out)
    return F.when(F.size(questions) > 1, questions).otherwise(out)


def decompose(q: Column) -> Column:
    """array<struct<query, dependent>>: the query itself unless it is complex."""
    parts = F.when(is_complex(q), split_by_rule(q)).otherwise(F.array(q))
    return F.transform(parts, lambda p: F.struct(p.alias("query"), F.lit(False).alias("dependent")))


def listed_subqueries(generated: Column, original: Column) -> Column:
    """array<struct<query, dependent>> from a numbered or bulleted list; the first is never dependent."""
    lines = F.transform(F.split(generated, "\n"), strip)
    marked = F.filter(lines, lambda x: x.rlike(r"^(\p{Nd}|-)"))
    bare = F.transform(
        marked,
        lambda x: F.regexp_replace(F.regexp_replace(x, r"^\d+[.)]\s*", ""), r"^[-•]\s*", ""),
    )
    kept = F.filter(bare, lambda x: x != "")

    def depends(x):
        low, hit = F.lower(x), F.lit(False)
        for w in fv.LIST_DEPENDENCY_WORDS:
            hit = hit | low.contains(w)
        return hit

    rows = F.transform(
        kept, lambda x, i: F.struct(x.alias("query"), F.when(i == 0, F.lit(False)).otherwise(depends(x)).alias("dependent"))
    )
    alone = F.array(F.struct(original.alias("query"), F.lit(False).alias("dependent")))
    return F.when(F.size(kept) > 0, rows).otherwise(alone)


def normalise(q: Column) -> Column:
    """Spelling and abbreviation replacements on whole words, whatever their case, in order."""
    for old, new in fv.NORMALISATIONS.items():
        q = F.regexp_replace(q, rf"(?iuU)\b{old}\b", new)
    return q


def to_statement(q: Column) -> Column:
    """The question rewritten as a statement by the first form that matches, else unchanged."""
    out = q
    for pattern, form in reversed(fv.QUESTION_FORMS):
        p = "(?iud)" + pattern
        rewritten = F.regexp_replace(q, p, re.sub(r"\{(\d)\}", r"$\1", form))
        out = F.when(q.rlike(p), rewritten).otherwise(out)
    return out


def with_context(q: Column, terms: list[str] | None = None) -> Column:
    """Domain context appended to a short query that has none of the context terms."""
    low, has = F.lower(q), F.lit(False)
    for t in terms or fv.CONTEXT_TERMS:
        has = has | low.contains(t.lower())
    return F.when(~has & (word_count(q) < 10), F.concat(q, F.lit(fv.CONTEXT_SUFFIX))).otherwise(q)


def variations(q: Column, n: int = 3) -> Column:
    """The query and up to `n` different versions of it, first seen first."""
    from ..operators.lexical import synonym_expansion

    none = F.lit(None).cast("string")
    expanded, contextual = synonym_expansion(q), with_context(q)
    versions = F.array(
        q,
        normalise(q),
        F.when(q.contains("?"), to_statement(q)).otherwise(none),
        F.when(expanded != q, expanded).otherwise(none),
        F.when(contextual != q, contextual).otherwise(none),
    )
    clean = F.filter(F.transform(F.array_compact(versions), strip), lambda v: v != "")
    return F.slice(F.array_distinct(clean), 1, n + 1)


def transformed(q: Column, intent: Column | None = None) -> Column:
    """The version of a query to search with; counting and time questions have their own."""
    if intent is None:
        return normalise(q)
    return F.when(intent == "aggregation", with_context(q, fv.COUNTING_TERMS)).otherwise(normalise(q))


def refers_back(q: Column) -> Column:
    low, hit = F.lower(q), F.lit(False)
    for m in fv.REFERENCE_MARKERS:
        hit = hit | low.contains(m)
    return hit


def resolved(q: Column, names: Column, places: Column, dates: Column) -> Column:
    """The query with up to two names, places and dates of the earlier step appended, if it refers back."""

    def part(label, xs):
        two = F.slice(F.coalesce(xs, F.array().cast("array<string>")), 1, 2)
        return F.when(F.size(two) > 0, F.concat(F.lit(f" ({label}: "), F.array_join(two, ", "), F.lit(")"))).otherwise("")

    full = F.concat(q, part("personas", names), part("lugares", places), part("fechas", dates))
    return F.when(refers_back(q), strip(full)).otherwise(q)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("F", "Column", "fv", "re", "annotations", "words")]
