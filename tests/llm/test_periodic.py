import numpy as np
import pytest

from llm.periodic import Lce, collapsed, periodic_runs, runs_of, stretched, word_runs


def plain(s, least, times):
    """Runs by trying every period: stretches in which symbols one period apart agree."""
    out = {}
    for q in range(1, len(s) // times + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            if j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((a, n, q) for (a, n), q in out.items())


def made(rng, n, symbols):
    s = rng.integers(0, symbols, n).tolist()
    for _ in range(int(rng.integers(0, 4))):
        a, q = int(rng.integers(0, n)), int(rng.integers(1, 12))
        root = s[a : a + q]
        s[a:a] = (root * 9)[: int(rng.integers(0, 8 * q))]
    return s


@pytest.mark.parametrize(("least", "times"), [(6, 4), (2, 2), (9, 3)])
def test_runs_against_every_period(least, times):
    rng = np.random.default_rng(least)
    for k in range(300):
        s = made(rng, int(rng.integers(1, 60)), 1 + k % 5)
        want = plain(s, least, times)
        assert [tuple(r) for r in runs_of(s, least, times).tolist()] == want
        assert [tuple(r) for r in word_runs([str(x) for x in s], least, times).tolist()] == want


def test_extensions():
    rng = np.random.default_rng(3)
    s = made(rng, 300, 2)
    lce = Lce(s)
    i, j = rng.integers(0, len(s) + 1, (2, 4000))
    i, j = i[i != j], j[i != j]
    got = lce.of(i, j).tolist()
    for a, b, n in zip(i.tolist(), j.tolist(), got, strict=True):
        assert s[a : a + n] == s[b : b + n]
        assert max(a, b) + n == len(s) or s[a + n] != s[b + n]


def test_long_texts():
    rng = np.random.default_rng(5)
    words = [str(x) for x in rng.integers(0, 30, 20_000)]
    words[5_000:5_000] = words[100:900] * 5
    words += ["a"] * 50_000
    found = [tuple(r) for r in word_runs(words).tolist()]
    # the copied stretch starts where words one period apart begin to agree
    assert any(r[2] == 800 and r[1] >= 4_000 for r in found) and found[-1][1:] == (50_000, 1)
    assert len(collapsed(words, np.array(found))) <= 20_000 + 800 + 1


def test_odd_rows(spark, odd, none):
    got = {(r.doc_id, r.n_words): r for r in periodic_runs(odd).collect()}
    assert periodic_runs(odd).count() == odd.count() and periodic_runs(none).count() == 0
    assert got[(1, 0)].runs == [] and got[(1, 0)].collapsed == "" and got[(2, 0)].collapsed == ""
    long = got[(3, 30_000)]
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 977)] and long.collapsed.split() == [f"w{k}" for k in range(977)]
    assert got[(None, 3)].collapsed == "one two three"


def test_change_of_the_contract():
    words = [f"w{k}" for k in range(100)]
    changed = [d for d in range(2_000) if stretched(d, words) != words]
    assert 120 < len(changed) < 230
    assert stretched(None, words) == words and stretched(0, []) == []
    for d in changed[:50]:
        new = stretched(d, words)
        a = next(k for k in range(100) if new[k] != words[k])
        assert len(new) == 100 and set(new) <= set(words[:a])
