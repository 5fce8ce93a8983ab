import numpy as np
import pytest
import xxhash

from llm import simhash
from llm.simhash import Sets, Tree, fingerprint, links, near_components


def plain_print(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\n", " ").replace("\t", " ").split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints):
    """Component of every index by trying all pairs."""
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2 and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def near_prints(rng, n):
    """Fingerprints around few centres, so that many are a few bits apart and many shards' borders are met."""
    out = []
    for _ in range(n):
        x = int(rng.integers(0, 1 << 63)) if not out or rng.random() < 0.4 else out[int(rng.integers(len(out)))]
        for _ in range(int(rng.integers(0, 5))):
            x ^= 1 << int(rng.integers(64))
        out.append(x)
    return sorted(set(out))


def test_fingerprint():
    for text in ("", "  \n", "One", "a b", "a b c d", "Ä b C " * 50, "x y\tz\nw " * 7):
        assert fingerprint(text) == plain_print(text)
    text = " ".join(str(k * k % 1013) for k in range(150_000))  # over the size of a block
    assert fingerprint(text).bit_count() > 10


@pytest.mark.parametrize("leaf", [1, 8, 500])
def test_tree_finds_all_pairs(leaf):
    rng = np.random.default_rng(leaf)
    p = np.array(near_prints(rng, 400), np.uint64)
    tree = Tree(p, leaf)
    assert sorted(tree.points) == sorted(p)
    got = {(int(p[a]), int(tree.points[b])) for x, y in tree.pairs(p, 2) for a, b in zip(x, y, strict=True)}
    assert got == {(int(a), int(b)) for a in p for b in p if (int(a) ^ int(b)).bit_count() <= 2}


def test_sets():
    sets = Sets(10)
    sets.join(np.array([1, 2, 8]), np.array([2, 3, 9]))
    sets.join(np.array([3]), np.array([8]))
    assert sets.root(np.arange(10)).tolist() == [0, 1, 1, 1, 4, 5, 6, 7, 1, 1]


def test_links_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 40)
    monkeypatch.setattr(simhash, "SAMPLE", 8)
    monkeypatch.setattr(simhash, "LEAF", 4)
    prints = near_prints(np.random.default_rng(9), 700)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    rows = links(spark.createDataFrame([(x,) for x in signed], "fingerprint long").repartition(5), len(prints)).collect()
    place = {x: k for k, x in enumerate(signed)}
    sets = Sets(len(prints))
    sets.join(np.array([place[r.a] for r in rows]), np.array([place[r.b] for r in rows]))
    assert sets.root(np.arange(len(prints))).tolist() == plain_components(prints)


def test_components_of_documents(spark, odd, none):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(rng.choice(words, int(rng.integers(0, 60)))) for _ in range(60)]
    texts += [t.upper() for t in texts[:20]] + [t.replace("w1", "w2", 1) for t in texts[:30]] + [None, ""]
    rows = [(k * 7 % 113 if k % 17 else None, t) for k, t in enumerate(texts)]
    got = near_components(spark.createDataFrame(rows, "doc_id long, text string"))
    prints = [plain_print(t) for _, t in rows]
    group = plain_components(prints)
    ids = {g: min((d for (d, _), h in zip(rows, group, strict=True) if h == g and d is not None), default=None) for g in group}
    want = [(d, f"{p:016x}", ids[g]) for (d, _), p, g in zip(rows, prints, group, strict=True)]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    rows = near_components(odd).collect()
    assert len(rows) == odd.count() and near_components(none).count() == 0
    assert {r.component_id for r in rows if r.fingerprint == "0" * 16} == {1}


def test_hot_fingerprint(spark):
    docs = spark.range(5_000).selectExpr("id as doc_id", "if(id % 3 > 0, 'the same words again', cast(id as string)) as text")
    got = near_components(docs)
    assert got.count() == 5_000 and got.where("doc_id % 3 > 0").select("component_id").distinct().count() == 1
