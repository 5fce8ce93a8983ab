"""Spelling variants: words one code point apart, found through numbered nodes of two tries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import LOWER, UPPER, in_arrow, kept, long_list, table
from llm.periodic import CRC32

#: Code points of a word and places it occurs in, at least; and how many times as often its form must occur.
LEAST_CHARS, LEAST_PLACES, TIMES = 7, 2, 10
#: Maximal runs of these letters are words.
LETTERS = "A-Za-zÀ-ÿ"
_PART = 40  # bits of a node's number that count within a partition
_FLUSH = 1 << 19  # nodes of a batch that is handed on


def word_counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least_chars: int = LEAST_CHARS, least_places: int = LEAST_PLACES, edit=None) -> DataFrame:
    """(word, n): the words of all texts with how often they occur.

    Words are maximal runs of LETTERS, A-Z in lower case. Only runs of `least_chars` letters on are looked
    at, as `edit(doc_id, word)`, a function of columns that may change a word first, may only shorten it.
    """
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    found = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_chars},}}"), F.lit(0))
    words = docs.select("id", F.explode(found).alias("word")).select("id", F.translate("word", UPPER, LOWER).alias("word"))
    if edit:
        words = words.select(edit(F.col("id"), F.col("word")).alias("word")).where(F.length("word") >= least_chars)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_places)


def _common(a: str, b: str) -> int:
    """Length of the longest common beginning."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def numbered(words: DataFrame, key: str) -> tuple[DataFrame, dict[int, int]]:
    """(`words` with the column `nodes`, stand-ins): the numbers of the trie nodes on the path of the string `key`.

    In sorted order a word adds the nodes below what it shares with the word before, so a partition of
    sorted words numbers its nodes in one pass that holds a single path. A node on the border of
    partitions gets a number in each; the first one counts, and the dictionary gives it for the others. It
    has at most a word's length of entries for each partition. Words have to be distinct.
    """

    def walk(batches: Iterator[pa.RecordBatch]):
        last, path, count = None, [0], 0
        for batch in batches:
            paths, done, held = [], 0, 0
            for row, (word, part) in enumerate(zip(batch.column(key).to_pylist(), batch.column("_part").to_pylist(), strict=True)):
                if last is not None:
                    del path[_common(last, word) + 1 :]
                while len(path) <= len(word):
                    count += 1
                    path.append((part << _PART) + count)
                paths.append(np.array(path, np.int64))
                last, held = word, held + len(path)
                if held > _FLUSH or row + 1 == batch.num_rows:
                    some = batch.slice(done, row + 1 - done)
                    yield pa.RecordBatch.from_arrays([*some.columns, long_list(paths)], [*some.schema.names, "nodes"])
                    paths, done, held = [], row + 1, 0

    ordered = words.repartitionByRange(key).sortWithinPartitions(key).withColumn("_part", F.spark_partition_id().cast("long"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema.fields)
    out = kept(in_arrow(ordered, walk, f"{fields}, _part long, nodes array<long>"), "trie")
    border = F.struct(key, "nodes")
    edges = out.groupBy("_part").agg(F.min(border).alias("first"), F.max(border).alias("last")).collect()
    stands, before = {}, None
    for row in sorted(edges, key=lambda r: r["_part"]):
        if before is not None:
            for depth in range(1, _common(before[key], row["first"][key]) + 1):
                there = before["nodes"][depth]
                stands[row["first"]["nodes"][depth]] = stands.get(there, there)
        before = row["last"]
    return out.drop("_part"), stands


def _counted_up(sizes: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of `sizes`, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _standing(nodes: np.ndarray, stands: dict[int, int]) -> np.ndarray:
    """The nodes, each with the number that stands for it."""
    if not stands:
        return nodes
    known = np.array(sorted(stands), np.int64)
    at = np.minimum(np.searchsorted(known, nodes), len(known) - 1)
    return np.where(known[at] == nodes, np.array([stands[int(k)] for k in known], np.int64)[at], nodes)


def gaps(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, word, n), (id, n, prefix, suffix, skipped, last)): words named by their trie nodes, and their pairs.

    `id` is the number of the word's own node in the forward trie; they are in the order of the words. A
    skipped place gives the nodes of what lies before and behind it; `last` tells that the letter behind
    it is another one. A place between two letters, and both ends, gives the nodes of both parts.
    """
    ahead, stands = numbered(words.select("word", "n"), "word")
    back, stands_back = numbered(words.select("word", F.reverse("word").alias("drow")), "drow")
    both = ahead.join(back.select("word", F.col("nodes").alias("_back")), "word")
    names = ["id", "n", "prefix", "suffix", "skipped", "last"]

    def paired(batch: pa.RecordBatch):
        held = batch.column("word").to_pylist()
        m = np.array([len(w) for w in held], np.int64)
        n = np.asarray(batch.column("n"))
        f = _standing(np.asarray(batch.column("nodes").flatten()), stands)
        b = _standing(np.asarray(batch.column("_back").flatten()), stands_back)
        start = np.cumsum(m + 1) - (m + 1)  # of a word's paths in f and b
        points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32)
        last = np.append(points[1:] != points[:-1], True)
        last[(np.cumsum(m) - 1)[m > 0]] = True
        skip, place = np.repeat(np.arange(len(m)), m), _counted_up(m)
        split, between = np.repeat(np.arange(len(m)), m + 1), _counted_up(m + 1)
        who = np.concatenate([skip, split])
        prefix = np.concatenate([f[start[skip] + place], f[start[split] + between]])
        suffix = np.concatenate([b[start[skip] + m[skip] - place - 1], b[start[split] + m[split] - between]])
        skipped = np.arange(len(who)) < len(skip)
        flags = np.concatenate([last[: len(skip)], np.zeros(len(split), bool)])
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (f[start + m][who], n[who], prefix, suffix, skipped, flags)], names)

    def emit(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            ends = np.cumsum(np.asarray(batch.column("nodes").value_lengths()))
            cuts = np.flatnonzero(np.diff(ends // _FLUSH, prepend=0)).tolist()
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if b > a:
                    yield paired(batch.slice(a, b - a))

    pairs = in_arrow(both, emit, "id long, n long, prefix long, suffix long, skipped boolean, last boolean")
    return ahead.select(F.element_at("nodes", -1).alias("id"), "word", "n"), pairs


def _best(mask: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per group the place of its first row in `mask`, or the number of rows."""
    return np.minimum.reduceat(np.where(mask, np.arange(len(mask)), len(mask)), starts)


def _nearest(prefix, suffix, skipped, last, n, who) -> list[np.ndarray]:
    """(id, near words, the best one's n and id) of rows sorted by pair of nodes, then n downward and id."""
    new = np.append(True, (prefix[1:] != prefix[:-1]) | (suffix[1:] != suffix[:-1]))
    starts = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    rows = np.arange(len(prefix))
    skips = np.add.reduceat(skipped.astype(np.int64), starts)[group]
    splits = np.add.reduceat((~skipped).astype(np.int64), starts)[group]
    lacking = np.add.reduceat((skipped & last).astype(np.int64), starts)[group]
    near = np.where(skipped, skips - 1 + np.where(last, splits, 0), lacking)

    def other(mask):
        """The first row of the group in `mask` that is not the row itself."""
        one = _best(mask, starts)[group]
        two = _best(mask & (one != rows), starts)[group]
        return np.where(one == rows, two, one)

    best = np.where(skipped, np.where(last, other(np.ones(len(rows), bool)), other(skipped)), other(skipped & last))
    some = near > 0
    return [who[some], near[some], n[best[some]], who[best[some]]]


def nearest(pairs: DataFrame) -> DataFrame:
    """(id, near, best_n, best): for each word and pair of nodes how many words are near it through that pair, and their best.

    Words that skip one place between the same nodes differ in that letter; the word that is split between
    those nodes lacks it. Of equal letters in a row only the last counts as left out, so two near words
    meet once. At most one word has the split, and the skipping ones differ by a single letter: a pair of
    nodes holds at most one more word than there are letters. The best has the greatest n, then the least id.
    """
    names = ["prefix", "suffix", "skipped", "last", "n", "id"]

    def meet(batches: Iterator[pa.RecordBatch]):
        held: list[np.ndarray] = []
        for batch in batches:
            rows = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)] if held else rows
            new = np.flatnonzero((rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])) + 1
            cut = int(new[-1]) if len(new) else 0  # the last pair may go on in the next batch
            held = [x[cut:] for x in rows]
            if cut:
                yield out(*(x[:cut] for x in rows))
        if held and len(held[0]):
            yield out(*held)

    def out(*rows):
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _nearest(*rows)], ["id", "near", "best_n", "best"])

    met = pairs.repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix", F.desc("n"), "id")
    return in_arrow(met.select(*names), meet, "id long, near long, best_n long, best long")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every word of `words` (word, n; distinct) with each word exactly one inserted, deleted or replaced code point away."""
    names, pairs = gaps(words)
    pairs = kept(pairs, "trie-pairs")
    other = pairs.select("prefix", "suffix", F.col("id").alias("other"), F.col("skipped").alias("_skipped"), F.col("last").alias("_last"))
    links = pairs.join(other, ["prefix", "suffix"]).where("(skipped and _skipped and id != other) or (last and not _skipped) or (_last and not skipped)")
    near = names.select(F.col("id").alias("other"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return links.select("id", "other").join(names, "id").join(near, "other").select("word", "n", "near", "near_n")


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root): the last word reached from `id` over `form`; each round jumps twice as far.

    A form occurs several times as often as its word, so there are no cycles and few rounds.
    """
    reached = kept(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("id").alias("root"), F.col("root").alias("_next"))
        reached = kept(reached.join(further, "root", "left").select("id", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if reached.where("moved").isEmpty():
            return reached.select("id", "root")
        reached = reached.select("id", "root")


def spelling_groups(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word of `words` (word, n) with the spelling it varies.

    Near words are one inserted, deleted or replaced code point apart. `form` is the near word of greatest
    n, the least in code-point order of several, if that n is at least `times` (over 1) the word's; else
    null, as form_n. `root` is reached from the word by following forms. Words have to be distinct and not
    null; ties of n follow the order of the words; the empty word is near to those of one letter; very long
    words cost memory in proportion to their length; no rows give no rows; other columns are left out.

    Each letter of a word gives two pairs of node numbers, which are grouped by equality alone: there is no
    bucket of similar words, and a pair of nodes holds at most one more word than there are letters.
    """
    words = kept(words.select("word", F.col("n").cast("long").alias("n")), "words")
    names, pairs = gaps(words)
    best = F.max(F.struct("best_n", (-F.col("best")).alias("best"))).alias("best")
    near = kept(nearest(pairs).groupBy("id").agg(F.sum("near").alias("n_near"), best), "near")
    forms = near.join(names.select("id", "n"), "id").where(F.col("best.best_n") >= times * F.col("n"))
    forms = forms.select("id", (-F.col("best.best")).alias("form"), F.col("best.best_n").alias("form_n"))
    forms = forms.join(_roots(forms), "id")
    form_name, root_name = (names.select(F.col("id").alias(c), F.col("word").alias(f"_{c}")) for c in ("form", "root"))
    forms = forms.join(form_name, "form").join(root_name, "root").select("id", "_form", "_root", "form_n")
    out = names.join(near.select("id", "n_near"), "id", "left").join(forms, "id", "left")
    return out.select("word", F.col("_form").alias("form"), F.coalesce("_root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")


def misspelt(doc_id, word):
    """Column: the change of the query's contract, one letter left out of one word in 31."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    place = F.pmod(h, F.length(word)).cast("int")
    return F.when(h % 31 == 0, F.concat(word.substr(F.lit(1), place), word.substr(place + 2, F.length(word)))).otherwise(word)


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(table(spark, sf_dir, "documents"), edit=misspelt))


ORACLE = rf"""
with recursive r as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]{{7,}}')) w from documents),
o as (select coalesce(doc_id::varchar, '') || ':' || translate(w, '{UPPER}', '{LOWER}') x, translate(w, '{UPPER}', '{LOWER}') w, count(*) c from r group by all),
h as (select w, c, xor({CRC32.format("x")}, 4294967295) h from o),
e as (select case when h % 31 = 0 then left(w, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end word, c from h),
v as materialized (select word, sum(c)::bigint n from e where length(word) >= 7 group by word having sum(c) >= 2),
d as materialized (select word, n, i, left(word, i::int) || substr(word, i::int + 2) s from (select word, n, unnest(range(0, length(word))) i from v)),
near as materialized (
  select a.word, a.n, b.word near, b.n near_n from d a join d b on a.i = b.i and a.s = b.s and a.word <> b.word
  union select d.word, d.n, v.word, v.n from d join v on d.s = v.word
  union select v.word, v.n, d.word, d.n from d join v on d.s = v.word),
k as (select word, count(*) n_near from near group by word),
f as materialized (select word, near form, near_n form_n from near qualify row_number() over (partition by word order by near_n desc, near) = 1 and near_n >= 10 * n),
up as (select word, form root, 1 step from f union all select up.word, f.form, step + 1 from up join f on up.root = f.word),
top as (select word, arg_max(root, step) root from up group by word)
select v.word, f.form, coalesce(top.root, v.word) root, v.n, coalesce(k.n_near, 0)::bigint n_near, f.form_n
from v left join k using (word) left join f using (word) left join top using (word)
"""

QUERIES = {"op12_variants": op12_variants}
ORACLES = {"op12_variants": ORACLE}
