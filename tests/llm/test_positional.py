"""Positional index, phrase and proximity search, and contamination against brute force."""

import hashlib
import random

import pytest
from brute import alnum

from zoneflow.llm import positional as ps


def brute(docs, items, size=13):
    out = []
    wins = []
    for item, text in items:
        w = alnum(text)
        wins += [(item, w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
    for doc, text in docs:
        w = alnum(text)
        hit, found = set(), set()
        for item, s in wins:
            for i in range(len(w) - len(s) + 1):
                if w[i : i + len(s)] == s:
                    hit |= set(range(i, i + len(s)))
                    found |= {item} - {None}
        out.append((doc, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    rows = ps.contamination(d, i, **options).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(sorted(r["items"])), r.contaminated) for r in rows), key=str)


def material():
    rng = random.Random(4)
    vocabulary = ["the", "of", "Straße", "ÉTÉ", "été"] + [f"t{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", ".", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([3, 12, 13, 14, 40]))) for i in range(12)]
    docs = []
    for i in range(60):
        parts = [text(rng.randrange(5, 120))]
        if i % 3 == 0:
            parts.insert(0, rng.choice(items)[1].upper())
        if i % 5 == 0:
            parts.append(rng.choice(items)[1])
        docs.append((i, "\n".join(parts)))
    return docs, items


def test_against_brute_force(spark):
    docs, items = material()
    assert run(spark, docs, items) == brute(docs, items)


def test_several_packs_and_blocks(spark, monkeypatch):
    docs, items = material()
    monkeypatch.setattr(ps, "PACK", 40)
    monkeypatch.setattr(ps, "BLOCK_BYTES", 500)
    assert run(spark, docs, items) == brute(docs, items)


def test_defined_cases(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = [(1, None), (2, ""), (3, "..."), (None, item), (4, item), (4, item), (5, "z " * 400 + item), (6, "z " * 20_000 + item)]
    items = [(7, item), (7, item), (8, item.upper()), (None, item), (9, None), (10, ""), (11, "one two")]
    docs += [(12, "one, TWO"), (13, "one 2 two")]
    assert run(spark, docs, items) == brute(docs, items)


def test_phrase_does_not_reach_over_documents(spark):
    words = [f"q{i}" for i in range(13)]
    docs = [(1, " ".join(words[:6])), (2, " ".join(words[6:]))]
    assert all(n == 0 for _, _, n, _, _ in run(spark, docs, [(1, " ".join(words))]))


def test_empty_tables(spark):
    docs, items = material()
    assert run(spark, [], items) == []
    assert all(r[2] == 0 for r in run(spark, docs, []))


@pytest.mark.parametrize("slop,found", [(0, False), (1, False), (2, True), (5, True)])
def test_proximity(spark, slop, found):
    item = [f"q{i}" for i in range(13)]
    near = item[:5] + ["x", "y"] + item[5:]
    rows = run(spark, [(1, " ".join(["a"] * 20 + near + ["b"] * 20))], [(1, " ".join(item))], slop=slop)
    assert (rows[0][2] > 0) == found


def test_clean_keeps_columns(spark):
    item = " ".join(f"q{i}" for i in range(13))
    d = spark.createDataFrame([(1, item, 5), (None, item, 6), (2, "fine", 7), (None, None, 8)], "doc_id long, text string, _n int")
    out = ps.clean(d, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert out.columns == d.columns and sorted(r._n for r in out.collect()) == [7, 8]


def test_text_key_is_sha256(spark):
    d = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    row = ps.contamination(d, spark.createDataFrame([], "item_id long, text string")).first()
    assert bytes(row.text_sha256).hex() == hashlib.sha256(b"abc").hexdigest()


def test_search_of_windows_given_directly(spark):
    index = ps.build_index(spark.createDataFrame([(1, "a b c d"), (2, "b c"), (3, None)], "doc_id long, text string"))
    words = ps.wd.words_of
    hashes = {}
    for text in ("b c", "c d", "d a", "zz b"):
        array = ps.pa.array([text])
        hashes[text] = [int(x) for w in words(array, ps.wd.ALNUM_WORDS, 1000) for x in w.hashes.view("int64")]
    rows = [(n, hashes[t], "x") for n, t in enumerate(hashes)] + [(0, hashes["b c"], "y"), (9, [], "x")]
    windows = spark.createDataFrame(rows, "window_id long, terms array<long>, block string")
    found = ps.search(index.persist(), windows).collect()
    assert sorted((sorted(r.window_ids), [(s.first, s.end) for s in r.spans]) for r in found) == [([0], [(0, 2)]), ([0, 1], [(1, 4)])]
    assert ps.search(index, windows.limit(0)).collect() == []
