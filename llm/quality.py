"""Quality classifier: a document's own evidence joined with what its host and path are worth.

Hierarchical empirical Bayes. The documents' probabilities are added up by path and host; a path's
share of good documents is drawn to its host's and a host's to that of all, the stronger the fewer
documents there are and the less the shares of hosts (paths) differ beyond chance.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from llm.common import kept, map_batches, table, texts_of
from llm.toxicity import FUNCTION_WORDS, labelled, share_of

#: Most labelled rows of a label that are learned from, and most characters of such a row.
TRAIN_ROWS, TRAIN_CHARS = 2000, 60_000
_FUNCTION = frozenset(w for ws in FUNCTION_WORDS.values() for w in ws)
_SYMBOL = re.compile(r"[#$%&*|~^<>{}\[\]=_\\@+!?]")
_LETTERS = re.compile(r"[^\W\d_]+")
_CAPITALS = re.compile(r"\b[^\W\d_a-zß-öø-ÿ]{3,}\b")


def evidence_of(text: str) -> list[float]:
    """What speaks for or against a text by itself; an empty text has a vector too."""
    words = text.split()
    n, chars = max(1, len(words)), max(1, len(text))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    longest = run = 0
    for a, b in zip(words, words[1:], strict=False):
        run = run + 1 if a == b else 0
        longest = max(longest, run)
    symbols = len(_SYMBOL.findall(text))
    lines = [x for x in text.split("\n") if x]
    worst = max((len(_SYMBOL.findall(x)) / len(x) for x in lines if len(x) > 20), default=0.0)
    letters = _LETTERS.findall(text)
    length = sum(map(len, letters)) / max(1, len(letters))
    low = [w.lower() for w in letters]
    return [
        np.log1p(len(words)), same / n, np.log1p(longest), symbols / chars, worst, np.sqrt(worst), len(set(words)) / n, np.log(n) * len(set(words)) / n,
        sum(w in _FUNCTION for w in low) / n, length, length**2 / 10, len(_CAPITALS.findall(text)) / n, sum(map(str.isdigit, text)) / chars,
        (len(lines) - len(set(lines))) / max(1, len(lines)), text.count("|") / n, text.count("!!") / n, float(not words), len(letters) / n,
    ]


@dataclass
class Scorer:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    base: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8) @ self.weights + self.base
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[str], labels: np.ndarray, share: float | None = None, penalty: float = 1.0) -> Scorer:
    """Penalised logistic regression by Newton steps. `share` is the label's share among all labelled
    rows, to which the base is moved if the sample has another; one kind of label gives that share."""
    x = np.array([evidence_of(t) for t in texts], float).reshape(len(texts), len(evidence_of("")))
    k, n = x.shape[1], len(labels)
    own = (labels.sum() + 0.5) / (n + 1)
    share = own if share is None else share
    if len(set(labels.tolist())) < 2:
        return Scorer(np.zeros(k), np.ones(k), np.zeros(k), float(np.log(share / (1 - share))))
    mean, spread = x.mean(0), x.std(0) + 1e-6
    z = np.column_stack([np.clip((x - mean) / spread, -8, 8), np.ones(n)])
    w, ridge = np.zeros(k + 1), np.diag([penalty] * k + [1e-6])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge, z.T @ (p - labels) + ridge @ w)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return Scorer(mean, spread, w[:-1], float(w[-1] + np.log(share / (1 - share)) - np.log(own / (1 - own))))


def judged(docs: DataFrame, scorer: Scorer, text: str = "text") -> DataFrame:
    """`docs` with `own`, the probability from the whole text alone; null texts count as empty."""
    docs = docs.drop("own")
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def judge(batch: pa.RecordBatch):
        x = np.array([evidence_of(t) for t in texts_of(batch, text)]).reshape(batch.num_rows, -1)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.probabilities(x))], [*batch.schema.names, "own"])

    return map_batches(docs, judge, StructType([*docs.schema.fields, StructField("own", DoubleType())]))


def _logit(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def _strength(groups: DataFrame, n: str, good: str, mean: Column) -> Column:
    """How many documents a prior counts as: from the spread of the groups' shares around `mean` beyond
    what documents drawn alike would show (method of moments)."""
    d = F.col(good) / F.col(n) - mean
    found = groups.where(F.col(n) > 1).agg(F.sum(F.col(n) * d * d).alias("spread"), F.count(F.lit(1)).alias("groups"), F.sum(n).alias("all"), F.sum(F.col(n) * mean * (1 - mean)).alias("chance")).first()
    if not found or not found.groups or not found["all"]:
        return F.lit(1e6)
    chance = found.chance / found["all"]  # m (1 - m)
    beyond = (found.spread - found.groups * chance) / max(found["all"] - found.groups, 1)
    return F.lit(float(min(1e6, max(1.0, chance / beyond - 1)))) if beyond > 0 else F.lit(1e6)


def with_sites(judged_docs: DataFrame, host: Column, path: Column) -> DataFrame:
    """Adds host_share, path_share and score to documents with `own`.

    Each share leaves the document itself out. Sums are made before rows are moved; sites are met in
    joins that Spark splits where one is hot. A null host or path is a site of its own; no rows give no rows. The
    length of a text plays no part here.
    """
    docs = judged_docs.drop("host_share", "path_share", "score").withColumns({"_host": F.coalesce(host.cast("string"), F.lit("")), "_path": F.coalesce(path.cast("string"), F.lit(""))})
    paths = kept(docs.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("n"), F.sum("own").alias("good")), "paths")
    hosts = paths.groupBy("_host").agg(F.sum("n").alias("hn"), F.sum("good").alias("hgood"))
    every = hosts.agg(F.sum("hn").alias("n"), F.sum("hgood").alias("good")).first()
    mean = every.good / every.n if every.n else 0.5
    k_host = _strength(hosts, "hn", "hgood", F.lit(mean))
    sites = paths.join(hosts, "_host")
    k_path = _strength(sites, "n", "good", (F.col("hgood") + k_host * mean) / (F.col("hn") + k_host))
    out = docs.join(sites, ["_host", "_path"])
    host_share = (F.col("hgood") - F.col("own") + k_host * mean) / (F.col("hn") - 1 + k_host)
    path_share = (F.col("good") - F.col("own") + k_path * F.col("host_share")) / (F.col("n") - 1 + k_path)
    out = out.withColumn("host_share", host_share).withColumn("path_share", path_share)
    z = _logit(F.col("own")) + _logit(F.col("path_share")) - _logit(F.lit(float(mean)))
    return out.withColumn("score", 1 / (1 + F.exp(-z))).drop("_host", "_path", "n", "good", "hn", "hgood")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts are the sources of the documents, paths the languages within them."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scorer = fit(*labelled(docs, labels, "quality", TRAIN_ROWS, TRAIN_CHARS), share_of(docs, labels, "quality", TRAIN_CHARS))
    own = kept(judged(docs.select("doc_id", "text", "source", "lang"), scorer).drop("text"), "own")
    scored = with_sites(own, F.col("source"), F.concat_ws("/", "source", "lang"))
    return scored.select("doc_id", "own", "host_share", "path_share", "score", (F.col("score") >= 0.5).alias("keep"))


QUERIES = {"op6_quality": op6_quality}
