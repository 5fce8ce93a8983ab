import numpy as np
import pytest

from llm.common import WordHashes
from llm.near_dedup import _others, bag_of, bag_signatures, first_of_each, near_classes, overlap


def plain_classes(rows):
    bags = [bag_of(t or "", WordHashes()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if overlap(bags[i], bags[j]) >= 0.8:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 300).astype(np.uint64)
    a = rng.integers(1, 9, 300)
    b = np.maximum(0, a + rng.integers(-3, 4, 300))
    some = b > 0
    share = [np.mean(np.equal(*bag_signatures([(h + np.uint64(t), a), ((h + np.uint64(t))[some], b[some])], 304))) for t in range(1, 15)]
    assert abs(np.mean(share) - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.02


def test_families_of_edited_texts(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(3):
        base = [words[i] for i in rng.integers(0, 3000, int(rng.integers(40, 120)))]
        for _ in range(50):
            w = list(base)
            for _ in range(int(rng.integers(0, 6))):
                w[int(rng.integers(0, len(w)))] = words[int(rng.integers(0, 3000))]
            texts.append(" ".join(w[: len(w) - int(rng.integers(0, 9))]))
    texts += [" ".join(words[i] for i in rng.integers(0, 3000, 40)) for _ in range(40)]
    rows = [(k, texts[p]) for k, p in enumerate(rng.permutation(len(texts)).tolist())]
    got = {r.doc_id: r.class_id for r in near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == plain_classes(rows)


@pytest.mark.parametrize(("n", "both", "to_centre"), [(35, 28, (0.5, 0.5)), (25, 20, (0.5, 0.5)), (10, 8, (0.9, 0.7))])
def test_pairs_of_just_the_similarity_meet_outside_their_centre(spark, n, both, to_centre):
    bags = spark.createDataFrame([(1, list(range(1000, 1030))), (2, list(range(both))), (3, list(range(n)))], "id long, bag array<long>")
    filed = spark.createDataFrame([(7, 1, 1), (7, 2, 1), (7, 3, 1)], "band long, id long, centre long")
    checked = spark.createDataFrame([(1, 2, to_centre[0]), (1, 3, to_centre[1])], "a long, b long, s double")
    classes = spark.createDataFrame([], "id long, class long")
    assert overlap(*(np.arange(k).astype(np.uint64) for k in (both, n))) == 0.8
    assert [tuple(r) for r in _others(filed, checked, classes, bags, 0.8).collect()] == [(2, 3)]


def test_odd_rows(spark, odd, none):
    got = [(r.doc_id, r.class_id, r.n_copies) for r in near_classes(odd).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 3), (2, 1, 3), (6, 1, 3), (3, 3, 1), (4, 4, 3), (4, 4, 3), (5, 4, 3), (7, 7, 1), (None, None, 1)], key=str)
    assert near_classes(none).count() == 0
    left = first_of_each(odd)
    assert left.columns == odd.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 3, 4, 4, 7, None], key=str)
