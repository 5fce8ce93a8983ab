import re

from llm.licenses import BASE, allowed, expression, licences_of, licensed, op8_licenses
from tests.llm.conftest import SF


def test_base_places_against_a_plain_search(spark):
    got = {r.doc_id: r for r in op8_licenses(spark, "/root/testdata/sf0.01").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(k, label) for p, label in BASE.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.base_labels) == (len(words), len(places), ",".join(sorted({x for _, x in places})))
        assert (g.first_word, g.last_word) == (min([k for k, _ in places], default=None), max([k for k, _ in places], default=None))
        assert set(filter(None, g.base_labels.split(","))) <= set(g.labels.split(",")) and (g.score > 0) == bool(g.labels)
    assert SF


def test_expressions():
    assert expression(" (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 and more") == ["MIT", "Apache-2.0", "OR", "GPL-2.0-only", "Classpath-exception-2.0", "WITH", "AND"]
    assert expression("MIT AND") == ["MIT"] and expression("") is None and expression(") MIT") is None and expression("MIT\nAll") == ["MIT"]
    assert not allowed(expression("(MIT OR Apache-2.0) AND GPL-2.0")) and allowed(expression("GPL-3.0+ OR MIT")) and not allowed(expression("MIT AND GPL-2.0 OR AGPL-3.0"))
    assert licences_of(expression("GPL-2.0 WITH Classpath-exception-2.0 OR MIT")) == ["gpl-2.0", "mit"]


def test_small_operators():
    assert expression("MIT or Apache-2.0") == ["MIT", "Apache-2.0", "OR"] and expression("mit and gpl-2.0") == ["mit", "gpl-2.0", "AND"]
    assert expression("GPL-2.0 with Classpath-exception-2.0 or (mit and bsd)") == ["GPL-2.0", "Classpath-exception-2.0", "WITH", "mit", "bsd", "AND", "OR"]
    assert expression("MIT and more") == expression("MIT or you choose") == expression("MIT\nor gpl-2.0 elsewhere") == expression("MIT and (c) 2020") == ["MIT"]
    assert not allowed(["mitre-x"]) and allowed(["MIT-0"]) and allowed(["bsd"]) and not allowed(["iscx-1.0"])


def test_expressions_are_read_to_their_end(spark):
    many = [f"GPL-2.{k}" for k in range(1000)]
    text = "SPDX-License-Identifier: " + " OR ".join([*many, "MIT"])
    row = licensed(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.licences == sorted({"mit", *map(str.lower, many)}) and row.license_allowed
    assert licences_of(expression("(" * 20_000 + "MIT" + ")" * 20_000 + " OR ISC")) == ["mit", "isc"]
    assert len(licences_of(expression(" OR ".join(many * 40)))) == 40_000


def test_tags_and_odd_rows(spark, odd, none):
    docs = spark.createDataFrame([(1, "CC BY CC-BY cc by-nc All rights reserved.\n# SPDX-License-Identifier: (MIT OR GPL-2.0)"), (2, "SPDX-License-Identifier:")], "doc_id long, text string")
    one, two = licensed(docs).orderBy("doc_id").collect()
    assert one.licences == ["cc-by", "cc-by-nc", "gpl-2.0", "mit", "reserved"] and one.license_allowed and one.license_score > 0.99
    assert [(p.phrase, p.word) for p in one.places][:2] == [("cc by", 0), ("cc by", 2)]
    assert (two.licences, two.license_score, two.license_allowed) == ([], 0, None)
    rows = licensed(odd).collect()
    assert len(rows) == 9 and all(r.places == [] and r.license_score == 0 for r in rows) and licensed(none).count() == 0
