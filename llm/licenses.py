"""Licence notices by an Aho-Corasick automaton, and licence expressions by a shunting-yard parser."""

from __future__ import annotations

import functools
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from llm.common import LOWER_WORD, ascii_lowered, map_batches, table, texts_of

#: Phrases of lower-case words and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further phrases, their labels and how surely each means that a licence is stated.
NOTICES = {
    "mit license": ("mit", 0.8),
    "permission is hereby granted free of charge": ("mit", 0.95),
    "apache license": ("apache", 0.8),
    "apache license version 2 0": ("apache-2.0", 0.95),
    "redistribution and use in source and binary forms": ("bsd", 0.95),
    "bsd license": ("bsd", 0.8),
    "isc license": ("isc", 0.8),
    "mozilla public license": ("mpl", 0.9),
    "lesser general public license": ("lgpl", 0.9),
    "affero general public license": ("agpl", 0.9),
    "general public license version 2": ("gpl-2.0", 0.95),
    "general public license version 3": ("gpl-3.0", 0.95),
    "eclipse public license": ("epl", 0.9),
    "cc by sa": ("cc-by-sa", 0.9),
    "cc by nc": ("cc-by-nc", 0.9),
    "cc by nd": ("cc-by-nd", 0.9),
    "cc by nc sa": ("cc-by-nc-sa", 0.9),
    "cc by nc nd": ("cc-by-nc-nd", 0.9),
    "creative commons attribution": ("cc-by", 0.8),
    "creative commons zero": ("cc0", 0.9),
    "dedicated to the public domain": ("public-domain", 0.8),
    "boost software license": ("bsl", 0.9),
}
#: How surely a base phrase means that a licence is stated.
BASE_WEIGHT = {"cc by": 0.7, "general public license": 0.8, "all rights reserved": 0.6}
TAG, TAG_WEIGHT = "spdx license identifier", 0.99
#: Beginnings of identifiers whose texts may be used freely.
FREE = ("mit", "apache", "bsd", "isc", "cc0", "cc-by-3", "cc-by-4", "unlicense", "zlib", "bsl", "0bsd", "python", "postgresql")
#: Beginnings of other identifiers.
BOUND = ("gpl", "lgpl", "agpl", "mpl", "epl", "cddl", "cc-by", "eupl", "artistic", "ofl", "osl", "ms-pl", "ms-rl", "cecill", "wtfpl", "openssl", "ncsa", "x11", "gfdl", "bsl")
_WORD = re.compile(LOWER_WORD)
_TAG = re.compile(r"spdx-license-identifier\s*:", re.I)
_TOKEN = re.compile(r"\s*([()]|[A-Za-z0-9][A-Za-z0-9.\-]*\+?)")
_NAME = re.compile(r"[^\S\n]*(?:\([(\s]*)?([A-Za-z0-9][A-Za-z0-9.\-]*)")
#: A name's beginning ends where its letters end.
_FREE = re.compile(f"(?:{'|'.join(map(re.escape, FREE))})(?![a-z])", re.I)
_FAMILY = re.compile(f"(?:{'|'.join(map(re.escape, (*FREE, *BOUND)))})(?![a-z])", re.I)
#: Operators by rank: the higher binds the closer.
RANK = {"OR": 1, "AND": 2, "WITH": 3}


def expression(text: str, at: int = 0) -> list[str] | None:
    """The licence expression that starts at `at`, in postfix order; None if there is none.

    Shunting-yard over identifiers, parentheses and OR, AND, WITH. Operators are written in capitals; in
    small letters within parentheses, and elsewhere where the name of a licence or exception follows in the
    same line. The expression ends where no operand or operator can follow, however far that is; an operator without
    a second operand and open parentheses are left off.
    """
    out: list[str] = []
    stack: list[str] = []
    best, depth, operand = None, 0, True
    while m := _TOKEN.match(text, at):
        token = m[1]
        word = token
        if token.islower() and token.upper() in RANK and not operand and (depth or ("\n" not in m[0] and _named(text, m.end(), token))):
            word = token.upper()
        if operand and token == "(":
            stack.append("(")
            depth += 1
        elif operand and token != ")" and token not in RANK:
            out.append(token)
            operand = False
        elif not operand and token == ")" and depth:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
            depth -= 1
        elif not operand and word in RANK:
            while stack and RANK.get(stack[-1], 0) >= RANK[word]:
                out.append(stack.pop())
            stack.append(word)
            operand = True
        else:
            break
        at = m.end()
        if not operand and not depth:
            best = (len(out), stack[::-1])  # three operators at most wait outside parentheses
        if not operand and not stack and "\n" in text[at : at + 1]:
            break
    return None if best is None else out[: best[0]] + best[1]


def _named(text: str, at: int, operator: str) -> bool:
    """Whether a name comes next that is surely a licence's or, after `with`, an exception's."""
    m = _NAME.match(text, at)
    name = m[1].lower() if m else ""
    return bool(_FAMILY.match(name)) or (operator == "with" and "exception" in name)


def allowed(postfix: list[str]) -> bool:
    """Whether the expression leaves a choice all of whose parts may be used freely; an exception
    after WITH does not change its licence."""
    stack: list[bool] = []
    for token in postfix:
        if token in RANK:
            right, left = stack.pop(), stack.pop()
            stack.append({"OR": left or right, "AND": left and right, "WITH": left}[token])
        else:
            stack.append(bool(_FREE.match(token)))
    return stack[0]


def licences_of(postfix: list[str]) -> list[str]:
    """The licences named, without exceptions, in lower case."""
    stack: list[list[str]] = []
    for token in postfix:
        if token in RANK:
            right, left = stack.pop(), stack.pop()
            if token != "WITH":
                left += right
            stack.append(left)
        else:
            stack.append([token.lower()])
    return stack[0]


@functools.cache
def automaton():
    a = ahocorasick.Automaton()
    for phrase in {*BASE, *NOTICES, TAG}:
        a.add_word(f" {phrase} ", phrase)
    a.make_automaton()
    return a


def scanned_text(text: str) -> dict:
    """n_words; places (phrase, first word); labels; score; allowed (null without an expression)."""
    words = _WORD.findall(ascii_lowered(text))
    begins = np.cumsum([0, *(len(w) + 1 for w in words)])
    line = f" {' '.join(words)} " if words else ""
    places = []
    for end, phrase in automaton().iter(line):
        places.append((phrase, int(np.searchsorted(begins, end - len(phrase) - 1))))
    doubt, labels, free = 1.0, set(), []
    for phrase in {p for p, _ in places}:
        if phrase in BASE:
            labels.add(BASE[phrase])
            doubt *= 1 - BASE_WEIGHT[phrase]
        if phrase in NOTICES:
            labels.add(NOTICES[phrase][0])
            doubt *= 1 - NOTICES[phrase][1]
        if phrase == TAG:
            for m in _TAG.finditer(text):
                if found := expression(text, m.end()):
                    labels.update(licences_of(found))
                    free.append(allowed(found))
            if free:
                doubt *= 1 - TAG_WEIGHT
    return {"n_words": len(words), "places": places, "labels": sorted(labels), "score": 1 - doubt, "allowed": all(free) if free else None}


def licensed(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, places (array of phrase, word), licences, license_score and license_allowed.

    Words are those of the lower-case kind in whole texts, very long ones too; expressions are read to their
    end, in time that grows with their length. No rows give no rows. A null or empty text has no words, no places
    and the score 0. Repeated rows and places each count; columns with the names of the results are
    replaced. license_allowed is null where no licence expression is given, and where several are,
    whether all of them allow free use.
    """
    names = ["n_words", "places", "licences", "license_score", "license_allowed"]
    docs = docs.drop(*names)
    place = StructType([StructField("phrase", StringType()), StructField("word", LongType())])

    def scan(batch: pa.RecordBatch):
        found = [scanned_text(t) for t in texts_of(batch, text)]
        cols = [
            pa.array([f["n_words"] for f in found], pa.int64()),
            pa.array([[{"phrase": p, "word": w} for p, w in f["places"]] for f in found], pa.list_(pa.struct([("phrase", pa.string()), ("word", pa.int64())]))),
            pa.array([f["labels"] for f in found], pa.list_(pa.string())),
            pa.array([f["score"] for f in found], pa.float64()),
            pa.array([f["allowed"] for f in found], pa.bool_()),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *cols], [*batch.schema.names, *names])

    kinds = [LongType(), ArrayType(place), ArrayType(StringType()), DoubleType(), BooleanType()]
    return map_batches(docs, scan, StructType([*docs.schema.fields, *(StructField(n, k) for n, k in zip(names, kinds, strict=True))]))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licensed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    words = F.transform(F.filter("places", lambda p: p["phrase"].isin(*BASE)), lambda p: p["word"])
    names = F.transform(F.filter("places", lambda p: p["phrase"].isin(*BASE)), lambda p: F.create_map(*[F.lit(x) for kv in BASE.items() for x in kv])[p["phrase"]])
    return found.select(
        "doc_id",
        "n_words",
        F.size(words).cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("base_labels"),
        F.array_join("licences", ",").alias("labels"),
        F.col("license_score").alias("score"),
        F.col("license_allowed").alias("allowed"),
    )


QUERIES = {"op8_licenses": op8_licenses}
