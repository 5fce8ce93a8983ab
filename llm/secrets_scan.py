"""Secret scan: candidates by their shape, judged by a random forest over their text and surroundings."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from llm.common import map_batches, table, texts_of

#: Most findings of each label that the forest learns from; trees, their depth, least findings in a leaf.
TRAIN_FINDINGS, TREES, DEPTH, LEAF = 4000, 24, 8, 3
MASK = "[SECRET]"
#: Rows whose texts and findings a Python worker holds at once.
SLICE = 500
#: A run of at least 12 key characters with a digit in it, or anything of 8 or more that is assigned to a key's name.
_CANDIDATE = re.compile(
    r"(?:(?P<name>(?i:passw(?:or)?d|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth|credential)s?)(?P<sign>[\"']?\s{0,2}(?:=>|:=|=|:)\s{0,2}[\"']?)(?P<given>[^\s\"'<>;,]{8,}))"
    r"|(?<![A-Za-z0-9+/_\-])(?P<bare>(?=[A-Za-z+/_\-]*[0-9])[A-Za-z0-9][A-Za-z0-9+/_\-]{11,}={0,2})"
)
_ISSUED = re.compile(r"(?:AKIA|ASIA)[A-Z0-9]{16}$|gh[pousr]_[A-Za-z0-9]{36,}$|xox[abprs]-[A-Za-z0-9-]{10,}$|sk_(?:live|test)_[A-Za-z0-9]{16,}$|AIza[A-Za-z0-9_\-]{35}$|eyJ[A-Za-z0-9_\-]{20,}$")
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
#: Words that stand in for a secret, near one that is none, and in paths of examples.
DICTIONARY = "password passwd secret token example sample test dummy changeme placeholder your user admin root default value here none null true false string config local host server client name account number order invoice version page image file data path index total report public private access login email phone address street world hello this that with from have will they what when where which there their about would could should".split()
_KNOWN = frozenset(DICTIONARY)
NEAR_NOTHING = frozenset("example sample dummy placeholder test fake sha sha1 sha256 md5 commit checksum digest hash uuid guid id order invoice card phone isbn version build".split())
NEAR_KEY = frozenset("password passwd pwd secret token key apikey auth bearer credential credentials aws login".split())
PATH_WORDS = re.compile(r"test|spec|example|sample|mock|fixture|doc|vendor|lock", re.I)
_WORDS = re.compile("|".join(sorted({w for w in DICTIONARY if len(w) > 3}, key=len, reverse=True)), re.I)
_NEAR = re.compile(r"[A-Za-z0-9]+")
#: One word in ordinary writing: a vowel in it, and no capital behind its first letter unless all are.
_PLAIN = re.compile(r"(?=.*[aeiouyAEIOUY])(?:[A-Za-z][a-z]+|[A-Z]+)[.:!?)]*$")


def candidates(text: str):
    """(start, end, name, sign) of each candidate, in characters."""
    for m in _CANDIDATE.finditer(text):
        which = "given" if m["given"] else "bare"
        yield m.start(which), m.end(which), m["name"], m["sign"]


def features(text: str, start: int, end: int, name: str | None, sign: str | None, path: str) -> list[float]:
    """What the forest sees of a candidate."""
    value = text[start:end]
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
    share = Counter(kinds)
    turns = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))
    vowels = sum(a in "aeiou" and b not in "aeiou" or a not in "aeiou" and b in "aeiou" for a, b in zip(value.lower(), value.lower()[1:], strict=False) if a.isalpha() and b.isalpha())
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    covered = sum(len(m[0]) for m in _WORDS.finditer(value)) / n
    before = [w.lower() for w in _NEAR.findall(text[max(0, start - 60) : start])][-4:]
    after = [w.lower() for w in _NEAR.findall(text[end : end + 40])][:2]
    near = before + after
    hexes = sum(c in "0123456789abcdefABCDEF" for c in value) / n
    return [
        n, math.log(n), share["d"] / n, share["u"] / n, share["l"] / n, share["s"] / n, turns / max(1, n - 1), vowels / max(1, n - 1), entropy, entropy / math.log2(n + 1),
        covered, hexes, float(bool(name)), float(bool(sign) and ("=" in sign or ":" in sign)), float(start > 0 and text[start - 1] in "\"'"),
        float(any(w in NEAR_KEY for w in before)), float(any(w in NEAR_NOTHING for w in near)), float(np.mean([w.isalpha() for w in near]) if near else 0.5),
        float(bool(PATH_WORDS.search(path))), path.count("/"), len(path),
    ]


def verdict_by_rule(text: str, start: int, end: int, name: str | None) -> int | None:
    """The label of a finding that needs no judging, for want of reviewed ones: keys of a known issuer
    and assigned values of mixed characters are secrets, numbers, ids and plain words are not; null if
    neither is sure, as of values with many separators or no digit that are assigned to a key's name:
    keys in base64 and passwords with symbols look like that, paths and code too."""
    value = text[start:end]
    if _ISSUED.match(value):
        return 1
    if value.isdigit() or _UUID.match(value):
        return 0
    runs = _NEAR.findall(value)
    if not any(c.isdigit() for c in value) or len(runs) > 3:
        return 0 if not name or _PLAIN.match(value) or all(r.lower() in _KNOWN for r in runs) else None
    if name and len(set(value)) >= 6:
        return 0 if _WORDS.search(value) else 1
    return None


@dataclass
class Forest:
    """Trees as arrays: feature (-1 in a leaf), threshold, left and right child, share of secrets."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    share: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or not len(x):
            return np.full(len(x), self.share)
        total = np.zeros(len(x))
        for feature, threshold, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                go = x[np.arange(len(x)), np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += value[at]
        return total / len(self.trees)


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, leaf: int = LEAF, seed: int = 11) -> Forest:
    """A random forest by Gini gain: each tree on a bootstrap, each split over a few random features."""
    rng = np.random.default_rng(seed)
    share = float((y.sum() + 0.5) / (len(y) + 1))
    if len(set(y.tolist())) < 2:
        return Forest([], share)
    tries = max(2, round(x.shape[1] ** 0.5) + 1)
    grown = []
    for _ in range(trees):
        rows = rng.integers(0, len(y), len(y))
        nodes: list[list] = []

        def split(which: np.ndarray, level: int, nodes=nodes) -> int:
            k = len(nodes)
            nodes.append([-1, 0.0, 0, 0, float(y[which].mean())])
            if level == depth or len(which) < 2 * leaf or nodes[k][4] in (0.0, 1.0):
                return k
            best = (1e-9, -1, 0.0)
            whole = len(which) * nodes[k][4] * (1 - nodes[k][4])
            for f in rng.choice(x.shape[1], tries, replace=False):
                order = which[np.argsort(x[which, f], kind="stable")]
                v, ones = x[order, f], np.cumsum(y[order])
                n = np.arange(1, len(order))
                p = ones[:-1] / n
                q = (ones[-1] - ones[:-1]) / (len(order) - n)
                gain = whole - n * p * (1 - p) - (len(order) - n) * q * (1 - q)
                gain[(v[1:] == v[:-1]) | (n < leaf) | (len(order) - n < leaf)] = -1
                at = int(gain.argmax())
                if gain[at] > best[0]:
                    best = (float(gain[at]), int(f), float((v[at] + v[at + 1]) / 2))
            if best[1] >= 0:
                go = x[which, best[1]] <= best[2]
                nodes[k][:2] = best[1], best[2]
                nodes[k][2] = split(which[go], level + 1)
                nodes[k][3] = split(which[~go], level + 1)
            return k

        split(rows, 0)
        columns = list(zip(*nodes, strict=True))
        grown.append(tuple(np.array(c, t) for c, t in zip(columns, (np.int64, float, np.int64, np.int64, float), strict=True)))
    return Forest(grown, share)


def labelled_findings(docs: DataFrame, text: str = "text", path: str = "source", limit: int = TRAIN_FINDINGS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most `limit` findings of each label, judged by rule, of the documents
    whose crc32(doc_id) mod 5 is not 0. Equal values count once."""

    def judge(batch: pa.RecordBatch):
        out = []
        for t, p in zip(texts_of(batch, "text"), batch.column("path").to_pylist(), strict=True):
            for start, end, name, sign in candidates(t):
                label = verdict_by_rule(t, start, end, name)
                if label is not None:
                    out.append((zlib.crc32(t[start:end].encode("utf-8", "surrogatepass")), label, features(t, start, end, name, sign, p or "")))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.list_(pa.float64()))], ["h", "label", "x"])

    source = docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0).select(F.col(text).alias("text"), (F.col(path) if path in docs.columns else F.lit("")).cast("string").alias("path"))
    found = map_batches(source, judge, "h long, label int, x array<double>", SLICE).groupBy("h", "label").agg(F.min("x").alias("x"))
    rows = []
    for label in (0, 1):
        rows += found.where(F.col("label") == label).orderBy("h").limit(limit).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["label"], r["h"]))
    width = len(features("x", 0, 1, None, None, ""))
    return np.array([r["x"] for r in rows], float).reshape(-1, width), np.array([r["label"] for r in rows], float)


_FINDING = StructType([StructField("start", LongType()), StructField("end", LongType()), StructField("value_sha256", StringType()), StructField("score", DoubleType())])


def scanned(docs: DataFrame, forest: Forest, text: str = "text", path: str = "source", mask: bool = False) -> DataFrame:
    """`docs` with `findings`: the candidates of each text with start, end, value_sha256 and score.

    The score is the forest's share for a secret; 0.5 or more counts as one. With `mask` secrets are
    replaced by "[SECRET]" in the text; places are those before masking. Null texts stay null and have no
    findings; a null path is an empty one; every repeat of a value is a finding. A column with the
    result's name is replaced.
    """
    docs = docs.drop("findings")
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def scan(batch: pa.RecordBatch):
        texts = batch.column(text).to_pylist()
        paths = batch.column(path).cast(pa.string()).to_pylist() if path in batch.schema.names else [""] * len(texts)
        owner, spots, x = [], [], []
        for k, (t, p) in enumerate(zip(texts, paths, strict=True)):
            for start, end, name, sign in candidates(t or ""):
                owner.append(k)
                spots.append((start, end))
                x.append(features(t, start, end, name, sign, p or ""))
        scores = shared.value.scores(np.array(x)) if x else []
        found: list[list[dict]] = [[] for _ in texts]
        for k, (a, b), s in zip(owner, spots, scores, strict=True):
            found[k].append({"start": a, "end": b, "value_sha256": hashlib.sha256(texts[k][a:b].encode("utf-8", "surrogatepass")).hexdigest(), "score": float(s)})
        columns = list(batch.columns)
        if mask:
            for k, some in enumerate(found):
                for f in reversed(some):
                    if f["score"] >= 0.5:
                        texts[k] = texts[k][: f["start"]] + MASK + texts[k][f["end"] :]
            columns[batch.schema.get_field_index(text)] = pa.array(texts, batch.schema.field(text).type)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value_sha256", pa.string()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*batch.schema.names, "findings"])

    return map_batches(docs, scan, StructType([*docs.schema.fields, StructField("findings", ArrayType(_FINDING))]), SLICE)


def fitted(docs: DataFrame) -> Forest:
    return grow(*labelled_findings(docs))


def masked(docs: DataFrame) -> DataFrame:
    """`docs` with the secrets in their texts masked; no document is dropped."""
    return scanned(docs, fitted(docs), mask=True).drop("findings")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = scanned(docs, fitted(docs)).select("doc_id", F.explode("findings").alias("f"))
    return found.select("doc_id", "f.start", "f.end", "f.value_sha256", "f.score", (F.col("f.score") >= 0.5).alias("is_secret"))


QUERIES = {"op5_secrets": op5_secrets}
