"""A convolutional text classifier for toxicity: hashed word embeddings, several filter widths, max pooling."""

from __future__ import annotations

import os
import pickle
import re
import subprocess
import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from llm.common import in_arrow, map_batches, table, texts_of

#: Rows of the embedding table, its columns, filters of each width, widths, and pieces of a word.
BUCKETS, DIMS, FILTERS, WIDTHS, PIECES = 1 << 17, 8, 8, (1, 2, 3), 9
#: Most labelled rows of a class that are learned from, and most characters of such a row.
TRAIN_ROWS, TRAIN_CHARS = 2000, 60_000
#: Words whose vectors a task keeps at most, beside those of the texts in hand, words of texts scored at once, and new words whose vectors are made at once.
KNOWN_WORDS, HELD_WORDS, NEW_WORDS = 150_000, 50_000, 20_000
#: Frequent short words by which the language of a text is guessed.
FUNCTION_WORDS = {
    "en": "the of and to in is that it with as for was on are by".split(),
    "de": "der die das und ist von zu den mit im auf für nicht ein es".split(),
    "fr": "le les et un une est dans pour du des sur pas qui au ce".split(),
    "es": "el los las y en por con una para se lo como su al del".split(),
}
_WORD = re.compile(r"\w+")


def pieces_of(word: str) -> list[int]:
    """Rows of the table for a word: the word, its beginnings and its ends."""
    ends = [word[:n] + "-" for n in (3, 4, 5, 6) if len(word) > n] + ["-" + word[-n:] for n in (3, 4, 5, 6) if len(word) > n]
    return [1 + zlib.crc32(p.encode("utf-8", "surrogatepass")) % (BUCKETS - 1) for p in [word, *ends]]


class Vocabulary:
    """Words met so far as rows of pieces; row 0 is the gap between texts. Forgets all when told to."""

    def __init__(self):
        self.clear()
        self.marks = {w: k for k, ws in enumerate(FUNCTION_WORDS.values()) for w in ws}

    def clear(self):
        self.rows: dict[str, int] = {}
        self.pieces = np.zeros((1 << 12, PIECES), np.int32)
        self.language = np.full(1 << 12, -1, np.int8)
        self.n = 1

    def of(self, text: str) -> np.ndarray:
        words = _WORD.findall(text.lower())
        rows, get = self.rows, self.rows.get
        out = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        for k in np.flatnonzero(out == 0).tolist():
            word = words[k]
            if word not in rows:
                if self.n == len(self.pieces):
                    self.pieces = np.concatenate([self.pieces, np.zeros_like(self.pieces)])
                    self.language = np.concatenate([self.language, np.full_like(self.language, -1)])
                p = pieces_of(word)
                self.pieces[self.n, : len(p)] = p
                self.language[self.n] = self.marks.get(word, -1)
                rows[word] = self.n
                self.n += 1
            out[k] = rows[word]
        return out

    def language_of(self, ids: np.ndarray) -> int:
        """The language with most function words in the text; English if there are none."""
        marks = self.language[ids]
        return int(np.argmax(np.bincount(marks[marks >= 0], minlength=len(FUNCTION_WORDS))))


def joined(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts end to end with gaps as wide as the widest filter reaches: (ids, starts, lengths)."""
    gap = np.zeros(max(WIDTHS) - 1, np.int32)
    parts, starts, lengths, at = [], [], [], 0
    for d in docs:
        d = d if len(d) else gap[:1]
        parts += [d, gap]
        starts.append(at)
        lengths.append(len(d))
        at += len(d) + len(gap)
    return np.concatenate(parts), np.array(starts), np.array(lengths)


@dataclass
class Model:
    table: np.ndarray
    filters: list[np.ndarray]  # for each width: (width, DIMS, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    base: float
    scale: np.ndarray  # for each language: slope and shift of the calibrated logit

    def responses(self, x: np.ndarray) -> np.ndarray:
        """(tokens, widths * FILTERS): each filter laid on from each token."""
        made = []
        for w in self.filters:
            y = x @ w[0]
            for j in range(1, len(w)):
                y[:-j] += x[j:] @ w[j]
            made.append(y)
        return np.concatenate(made, 1) + self.bias

    def logits(self, x: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        y = self.responses(x)
        bounds = np.stack([starts, starts + lengths], 1).ravel()
        pooled = np.maximum.reduceat(y, bounds[: -1] if bounds[-1] >= len(y) else bounds, axis=0)[::2]
        return np.maximum(pooled, 0) @ self.out + self.base

    def scores(self, logits: np.ndarray, language: np.ndarray) -> np.ndarray:
        z = logits * self.scale[language, 0] + self.scale[language, 1]
        return np.round(1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))), 6)  # single precision sums differ beyond


def evidence(pieces: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Per row of the table the log odds of the label where it occurs, drawn to the base rate while rare."""
    n, pos = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for p, label in zip(pieces, labels, strict=True):
        n[p] += 1
        pos[p] += label
    rate = (labels.sum() + 0.5) / (len(labels) + 1)
    share = (pos + 6 * rate) / (n + 6)
    out = np.log(share / (1 - share)) - np.log(rate / (1 - rate))
    out[n == 0] = 0
    return (out / 4).astype(np.float32)


def fit(texts: list[str], labels: np.ndarray, seed: int = 5, epochs: int = 4, batch: int = 32, share: float | None = None) -> Model:
    """Learn the classifier.

    One column of the table holds the evidence of the labels for each piece, taken for a text from
    the other half of the texts so that it is not its own witness; all else is learned by gradient.
    Logits are then calibrated for each guessed language, drawn to the slope and shift of all. `share`
    is the label's share among all rows that may be learned from, to which the shifts are moved if the
    texts have another: labels are sampled apart, so the odds differ by one factor in every language.
    With one kind of label only, or none, every score is that label's smoothed share.
    """
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, float)
    k = len(WIDTHS) * FILTERS
    model = Model(np.zeros((BUCKETS, DIMS), np.float32), [(rng.normal(0, 0.3, (w, DIMS, FILTERS))).astype(np.float32) for w in WIDTHS], np.full(k, -0.2, np.float32), rng.normal(0, 0.3, k).astype(np.float32), 0.0, np.tile([1.0, 0.0], (len(FUNCTION_WORDS), 1)))
    own = (labels.sum() + 0.5) / (len(labels) + 1)
    share = own if share is None else share
    if len(set(labels.tolist())) < 2:
        model.out[:], model.base = 0, float(np.log(share / (1 - share)))
        return model
    vocabulary = Vocabulary()
    docs = [vocabulary.of(t) for t in texts]
    held = [np.unique(vocabulary.pieces[np.unique(d)]) for d in docs]
    held = [p[p > 0] for p in held]
    half = np.zeros(len(docs), int)
    for label in (0, 1):
        which = rng.permutation(np.flatnonzero(labels == label))
        half[which[::2]] = 1
    seen = [evidence([p for p, h in zip(held, half, strict=True) if h != side], labels[half != side]) for side in (0, 1)]
    model.table[1:, 1:] = rng.normal(0, 0.05, (BUCKETS - 1, DIMS - 1))
    for f in model.filters:
        f[0, 0, : FILTERS // 2] = 1.0
    model.out[: FILTERS // 2] = 0.5
    params = [*model.filters, model.bias, model.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    gathered = np.full(BUCKETS, 1e-3, np.float32)
    steps, logits = 0, np.zeros(len(docs))

    def vectors(ids, side):
        kinds, back = np.unique(ids, return_inverse=True)
        p = vocabulary.pieces[kinds]
        v = model.table[p].sum(1)
        v[:, 0] = seen[side][p].sum(1)
        v[kinds == 0] = 0
        return v[back]

    for epoch in range(epochs + 1):
        parts = []
        for side in (0, 1):
            order = rng.permutation(np.flatnonzero(half == side))
            parts += [(side, order[i : i + batch]) for i in range(0, len(order), batch)]
        for side, which in [parts[i] for i in rng.permutation(len(parts))]:
            ids, starts, lengths = joined([docs[i] for i in which])
            x = vectors(ids, side)
            if epoch == epochs:  # the last round only reads
                logits[which] = model.logits(x, starts, lengths)
                continue
            y = model.responses(x)
            at = np.stack([s + y[s : s + n].argmax(0) for s, n in zip(starts, lengths, strict=True)])
            pooled = y[at, np.arange(k)]
            z = np.maximum(pooled, 0) @ model.out + model.base
            error = (1 / (1 + np.exp(-z)) - labels[which]) * np.where(labels[which] == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
            error = (error / len(which)).astype(np.float32)
            back = error[:, None] * model.out * (pooled > 0)
            grads = []
            for i, w in enumerate(model.filters):
                cols = slice(i * FILTERS, (i + 1) * FILTERS)
                g, to = np.zeros_like(w), at[:, cols]
                for j in range(len(w)):
                    there = x[to + j]  # (docs, FILTERS, DIMS)
                    g[j] = np.einsum("df,dfe->ef", back[:, cols], there)
                    pull = np.einsum("df,ef->dfe", back[:, cols], w[j]).reshape(-1, DIMS)
                    rows = vocabulary.pieces[ids[(to + j).ravel()]]
                    flat, pull = rows.ravel(), np.repeat(pull, PIECES, 0)
                    np.add.at(gathered, flat, (pull[:, 1:] ** 2).mean(1))
                    np.add.at(model.table, flat, np.concatenate([np.zeros((len(pull), 1), np.float32), -0.05 * pull[:, 1:] / np.sqrt(gathered[flat])[:, None]], 1))
                grads.append(g + 1e-4 * w)
            model.table[0] = 0
            grads += [back.sum(0), (error[:, None] * np.maximum(pooled, 0)).sum(0) + 1e-4 * model.out]
            model.base -= 0.05 * float(error.sum())
            steps += 1
            for p, (m, v), g in zip(params, moments, grads, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)
    model.table[:, 0] = evidence(held, labels)
    model.table[0] = 0
    languages = np.array([vocabulary.language_of(d) for d in docs])
    everywhere = _calibrated(logits, labels, np.array([1.0, 0.0]), 1e-3)
    for k in range(len(FUNCTION_WORDS)):
        model.scale[k] = _calibrated(logits[languages == k], labels[languages == k], everywhere, 1.0)
    model.scale[:, 1] += np.log(share / (1 - share)) - np.log(own / (1 - own))
    return model


def _calibrated(z: np.ndarray, y: np.ndarray, prior: np.ndarray, strength: float) -> np.ndarray:
    """Slope and shift by penalised logistic regression towards `prior`, a few Newton steps."""
    w = prior.copy()
    x = np.stack([z, np.ones_like(z)], 1)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + strength * np.eye(2)
        step = np.linalg.solve(hess, x.T @ (p - y) + strength * (w - prior))
        w = w - np.clip(step, -2, 2)
    return w if w[0] > 0 else prior


def _learnable(docs: DataFrame, labels: DataFrame, label: str, chars: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, label) of the ids that may be learned from, and (doc_id, text) of the texts that are short enough."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    known = labels.where(F.col(label).isin(0, 1) & (crc % 5 != 0)).groupBy("doc_id").agg(F.max(label).alias("label"))
    return known, docs.select("doc_id", "text").where(F.length("text") <= chars)


def _sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int) -> DataFrame:
    """(doc_id, label, text): at most `rows` texts of each label, of at most `chars` characters each, from the ids that may be learned from."""
    known, text = _learnable(docs, labels, label, chars)
    picked = None
    for value in (0, 1):
        some = known.where(F.col("label") == value).withColumn("_order", F.md5(F.col("doc_id").cast("string").cast("binary"))).orderBy("_order").limit(rows).select("doc_id", "label")
        picked = some if picked is None else picked.union(some)
    # at most two times `rows` ids, so their broadcast is bounded
    return text.join(F.broadcast(picked), "doc_id").select("doc_id", "label", "text")


def _in_order(found: list[dict]) -> tuple[list[str], np.ndarray]:
    found = sorted(found, key=lambda r: (str(r["doc_id"]), r["text"]))
    return [r["text"] for r in found], np.array([r["label"] for r in found], float)


def labelled(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> tuple[list[str], np.ndarray]:
    """At most `rows` texts of each label, of at most `chars` characters each, from the ids that may be learned from."""
    return _in_order(_sample(docs, labels, label, rows, chars).toArrow().to_pylist())


def share_of(docs: DataFrame, labels: DataFrame, label: str, chars: int = TRAIN_CHARS) -> float:
    """The label's smoothed share among all rows that may be learned from, of which `labelled` takes a sample."""
    known, text = _learnable(docs, labels, label, chars)
    n, pos = text.select("doc_id").join(known, "doc_id").agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0))).first()
    return (pos + 0.5) / (n + 1)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (score >= 0.5), from whole texts alone.

    A null or empty text has no words and gets the score of a text in which no filter answers. Columns
    with the names of the results are replaced; repeated rows are scored alike.
    """
    docs = docs.drop("score", "predicted")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    vocabulary = Vocabulary()
    vectors = {"x": np.zeros((0, DIMS), np.float32)}

    def forget():
        vocabulary.clear()
        vectors["x"] = np.zeros((0, DIMS), np.float32)

    def score(batch: pa.RecordBatch):
        m, n = shared.value, batch.num_rows
        logits, languages, docs_ids, held, done = np.zeros(n), np.zeros(n, int), [], 0, 0
        # texts are decoded a few at a time, so a batch's are not all held twice
        texts = chain.from_iterable(texts_of(batch.slice(a, 250), text) for a in range(0, n, 250))
        for k, t in enumerate(chain(texts, [None])):
            if t is None or held > HELD_WORDS:
                if docs_ids:
                    if len(vectors["x"]) < vocabulary.n:
                        new = vocabulary.pieces[len(vectors["x"]) : vocabulary.n]
                        more = np.concatenate([m.table[p].sum(1) for p in np.array_split(new, len(new) // NEW_WORDS + 1)])
                        vectors["x"] = np.concatenate([vectors["x"], more])
                    ids, starts, lengths = joined(docs_ids)
                    logits[done : done + len(docs_ids)] = m.logits(vectors["x"][ids], starts, lengths)
                    done += len(docs_ids)
                    docs_ids, held = [], 0
                if vocabulary.n > KNOWN_WORDS:
                    forget()
            if t is not None:
                ids = vocabulary.of(t)
                languages[k] = vocabulary.language_of(ids)
                docs_ids.append(ids)
                held += len(ids)
        s = m.scores(logits, languages)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return map_batches(docs, score, schema, done=forget)


def fit_apart(texts: list[str], labels: np.ndarray, share: float | None = None) -> Model:
    """`fit` in a process of its own, whose memory the driver does not keep."""
    code = "import pickle, sys; from llm.toxicity import fit; given = pickle.load(sys.stdin.buffer); pickle.dump(fit(given[0], given[1], share=given[2]), sys.stdout.buffer)"
    root = str(Path(__file__).resolve().parents[1])
    env = os.environ | {"PYTHONPATH": os.pathsep.join([root, *sys.path])}
    done = subprocess.run([sys.executable, "-c", code], input=pickle.dumps((texts, labels, share)), stdout=subprocess.PIPE, env=env, check=True)
    return pickle.loads(done.stdout)


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = TRAIN_ROWS) -> Model:
    """A model of the bounded sample, fitted in one task: its texts and the work on them stay off the driver, which gets the model."""
    share = share_of(docs, labels, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit_apart(*_in_order(found), share=share))], pa.binary())], ["model"])

    got = in_arrow(_sample(docs, labels, label, rows, TRAIN_CHARS).repartition(1), run, "model binary").first()
    return pickle.loads(got.model) if got else fit([], np.zeros(0), share=share)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fitted(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


QUERIES = {"op2_toxicity": op2_toxicity}
