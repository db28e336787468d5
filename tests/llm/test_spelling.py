"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from brute import UPPER

from zoneflow.llm import spelling as sp


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs, p=sp.Params()):
    counts = Counter()
    for number, text in docs:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            r = r.translate(UPPER)
            h = zlib.crc32(f"{number}:{r}".encode())
            if number is not None and h % p.noise == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            counts[r] += len(r) >= p.least_length
    n = {w: c for w, c in counts.items() if c >= p.least_count}
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: f for w, f in form.items() if n[f] >= p.factor * n[w]}

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root(w)) for w in n}


def found(df, p=sp.Params()):
    rows = [tuple(r) for r in sp.group_variants(df, p).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def edited(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("abcdÀéz")
    return rng.choice([word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :], word + c])


def material():
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(6, 14))) for _ in range(60)]
    words += [edited(rng, w) for w in words for _ in range(4)]
    words += [edited(rng, w) for w in words[60:] for _ in range(2)]
    weights = [600] * 60 + [30] * 240 + [2] * 480
    bag = rng.choices(words, weights, k=30_000)
    return [(i, rng.choice([" ", "1", "ß ", "\n"]).join(bag[i * 100 : i * 100 + 100]).replace("a", rng.choice("aaA"))) for i in range(300)]


def test_all_pairs(spark):
    docs = material()
    want = plain(docs)
    assert sum(r[2] > 0 for r in want) > 300 and sum(r[3] is not None for r in want) > 100
    assert any(r[3] != r[5] and r[3] for r in want)
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == want


def test_lists_in_chunks(spark, monkeypatch):
    """Words of one half in several chunks and scans give the same pairs."""
    rng = random.Random(6)
    words = ["verylong" + "".join(rng.choice("abc") for _ in range(8)) for _ in range(300)]
    words += ["".join(rng.choice("abc") for _ in range(8)) + "andthesame" for _ in range(300)]
    docs = [(i, " ".join(rng.choices(words, k=200))) for i in range(20)]
    monkeypatch.setattr(sp, "CHUNK", 50)
    monkeypatch.setattr(sp, "SCAN_WORDS", 70)
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == plain(docs)


def test_one_edit_on_lists():
    rng = random.Random(7)
    for _ in range(30):
        groups = [sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(40)}) for _ in range(3)]
        strings = [w for g in groups for w in g]
        list_of = np.repeat(np.arange(3), [len(g) for g in groups])
        queries = np.repeat(np.arange(len(strings)), 3)
        targets = np.tile(np.arange(3), len(strings))
        q, s = sp.one_edit(sp.Lists.of(strings, list_of), queries, targets)
        want = {(a, b) for a in range(len(strings)) for b in range(len(strings)) if one_edit(strings[a], strings[b])}
        assert sorted(zip(q.tolist(), s.tolist())) == sorted(want)


def test_defined_cases(spark):
    long = "x" * 50_000
    rows = [(1, None), (2, ""), (None, "kettles kettles kettle"), (3, "short 123 7777777"), (3, "mittens"), (3, "mittens")]
    rows += [(4, f"{long} {long} {long}a {long}a"), (5, "mitten" * 3000)]
    df = spark.createDataFrame([(*r, "?") for r in rows], "doc_id long, text string, word string")
    assert found(df) == plain(rows)
    assert found(df.limit(0)) == set()
