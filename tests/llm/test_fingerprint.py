import hashlib

import numpy as np

from llm.common import WordHashes
from llm.fingerprint import containment, edited, merged, sketch_of, sketched


def test_edited_texts_in_order(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 500, int(rng.integers(0, 80))))) for i in rng.choice(10_000, 300, replace=False)]
    rows[3] = (rows[3][0], None)
    got = {r.doc_id: r for r in edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        new = text[: len(text) - cut] + after[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        a, b, c = (sketch_of(t, WordHashes()) for t in (text, new, after))
        assert (r.near_edited, r.near_next) == (containment(a, b), containment(a, c))


def test_containment_of_unequal_texts_and_merging():
    rng = np.random.default_rng(5)
    words = [f"w{x}" for x in rng.integers(0, 10**6, 20_000)]
    h = WordHashes()
    whole, part, other = sketch_of(" ".join(words), h), sketch_of(" ".join(words[4000:6000]), h), sketch_of(" ".join(f"x{k}" for k in range(3000)), h)
    assert containment(whole, part) > 0.95 and containment(whole, other) == 0
    mixed = sketch_of(" ".join(words[:2000] + [f"x{k}" for k in range(2000)]), h)
    assert abs(containment(whole, mixed) - 0.5) < 0.1
    assert np.array_equal(merged(part, whole), np.union1d(part, whole))
    short = sketch_of("one two three four five six seven", h)
    assert len(short) == 3 and containment(short, short) == 1 and len(merged(short, part)) > 200


def test_odd_rows(spark, odd, none):
    rows = sketched(odd).collect()
    by = {}
    for r in rows:
        assert by.setdefault((r.text or "").lower().split().__str__(), r.fingerprint) == r.fingerprint
    assert edited(odd).count() == 9 and edited(none).count() == 0 and sketched(none).count() == 0
    one = edited(odd.where("doc_id = 3")).first()
    assert one.near_next == 1 and one.near_edited > 0.5
