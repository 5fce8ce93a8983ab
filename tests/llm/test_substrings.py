import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from llm import substrings
from llm.common import runs as substrings_runs
from llm.substrings import levels, repeated_windows


def plain(rows, window):
    words = [[w for w in (t or "").replace("\n", " ").replace("\t", " ").split(" ") if w] for _, t in rows]
    seen = Counter(tuple(w[s : s + window]) for w in words for s in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone.update(range(s, s + window))
        left = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("window", "seed_words"), [(35, 18), (12, 3), (7, 7), (5, 1)])
def test_against_a_plain_count(spark, window, seed_words):
    rng = np.random.default_rng(window)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for k in range(60):
        w = [f"w{x}" for x in rng.integers(0, 4 if k % 3 else 400, int(rng.integers(0, 90)))]
        if k % 4 == 0:
            a, b = sorted(rng.integers(0, 61, 2))
            w[len(w) // 2 : len(w) // 2] = passage[a:b]
        rows.append((k if k % 9 else None, " ".join(w)))
    rows += rows[5:9]
    got = repeated_windows(spark.createDataFrame(rows, "doc_id long, text string"), window=window, seed_words=seed_words)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == plain(rows, window)


def test_windows_that_meet_in_one_hash_only_stay(spark, monkeypatch):
    """Were the first hash the same for all windows, the second would still tell them apart."""
    h = np.arange(100, 109).astype(np.uint64)
    v, g = substrings.runs(h, 4), substrings.checks(h, 4)
    monkeypatch.setattr(substrings, "runs", lambda x, n: substrings_runs(x, n) & np.uint64(0) if n == 4 and x is h else substrings_runs(x, n))
    live = pa.scalar([{"h": 0, "g": int(g[k].view(np.int64))} for k in (1, 4)], pa.list_(pa.struct([("h", pa.int64()), ("g", pa.int64())])))
    assert len(set(v.tolist())) == 6 and substrings._repeated(h, 4, live).tolist() == [1, 4]
    (kinds, counts, others) = substrings._counted_pairs([(np.array([5, 5, 5, 7], np.uint64), np.array([1, 2, 1, 1], np.uint64)), (np.zeros(0, np.uint64), np.zeros(0, np.uint64))])
    assert [kinds.to_pylist(), counts.to_pylist(), others.to_pylist()] == [[[5, 5, 7], []], [[2, 1, 1], []], [[1, 2, 1], []]]


def test_many_copies_of_one_text(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(k, text if k < 3000 else f"{k} " + text) for k in range(3100)] + [(None, "alone " * 3)]
    got = {(r.n_words, r.n_removed) for r in repeated_windows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(40, 40), (41, 40), (3, 0)}


def test_odd_rows(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = repeated_windows(odd)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == plain(rows, 35)
    assert repeated_windows(none).count() == 0
    assert levels(35, 18) == [18, 35] and levels(35, 9) == [9, 18, 35] and levels(5, 9) == [5]
