"""Passages that repeat across documents against a search of all runs of words."""

import random
import time
from itertools import combinations

import numpy as np
import pyarrow as pa
from brute import spaced
from pyspark.sql import functions as F

from zoneflow.llm import paragraphs as pg
from zoneflow.llm import words as wd
from zoneflow.llm.scratch import Scratch


def sentence(rng, n):
    return " ".join(f"v{rng.randrange(4000)}" for _ in range(n)) + rng.choice(".!?")


def material():
    rng = random.Random(8)
    text = lambda n: " ".join(sentence(rng, rng.randrange(3, 25)) for _ in range(n))
    passage, line = text(9), sentence(rng, 10)
    docs = []
    for i in range(60):
        parts = [text(4), text(5)]
        if i % 4 == 0:
            parts.insert(1, passage)
        if i % 3 == 0:
            parts.append(line)
        docs.append((i, rng.choice(["\n", " "]).join(parts)))
    return docs, passage


def test_planted_passage(spark):
    docs, passage = material()
    rows = pg.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows} == {i for i, _ in docs if i % 4 == 0}
    texts = dict(docs)
    for r in rows:
        words = spaced(texts[r.doc_id])
        covered = " ".join(" ".join(words[s.first : s.end]) for s in r.passages)
        assert len(set(spaced(passage)) & set(covered.split())) > 0.8 * len(set(spaced(passage)))
        assert r.first_docs[0] == 0 and (r.n_removed > 0) == (r.doc_id != 0)


def test_edited_paragraphs_are_linked(spark):
    """Sentences of 60 words with one word changed are similar to their base, not equal; all links come from the bands."""
    rng = random.Random(9)
    base = [f"v{i}" for i in range(60)]
    docs = []
    for i in range(40):
        words = list(base)
        words[rng.randrange(5, 55)] = f"x{i}"
        docs.append((i, " ".join(words) + "."))
    docs.append((50, " ".join(base) + "."))
    docs += [(100 + i, sentence(rng, 60)) for i in range(20)]
    rows = pg.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows} >= {*range(40), 50} and not any(r.doc_id >= 100 for r in rows)


def test_defined_cases(spark):
    rng = random.Random(10)
    long = " ".join(sentence(rng, 15) for _ in range(2000))
    p = " ".join(sentence(rng, 20) for _ in range(3))
    rows = [(1, None), (2, ""), (3, "one two"), (4, p), (4, p), (None, p), (5, long), (6, "Kopf. " + long), (7, p + "\n" + p)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, passages int")
    found = {r.doc_id: r for r in pg.find_repeats(df).collect()}
    assert set(found) == {4, 5, 6, 7} and found[4].n_removed == 0 and found[7].n_removed == 120
    kept = pg.remove_repeats(df)
    assert kept.columns == df.columns and kept.count() == len(rows)
    texts = {r.doc_id: r.text for r in kept.where("doc_id is not null").collect()}
    assert texts[1] is None and texts[4] == p and texts[5] == long and texts[6].startswith("Kopf.")
    assert len(texts[6].split()) < 30 and texts[7].strip() == ""
    alone = spark.createDataFrame([(1, p + "\n" + p)], "doc_id long, text string")
    assert pg.find_repeats(alone).count() == 0 and pg.find_repeats(df.limit(0)).count() == 0


def test_every_word_lies_in_a_paragraph():
    rng = random.Random(11)
    ends = ["", "", ".", "!", "\n"]
    texts = [" ".join(f"v{rng.randrange(300)}{rng.choice(ends)}" for _ in range(n)) for n in (5, 6, 9, 200, 3000)]
    texts += ["BUY!! NOW!! " * 40, "a\nb\nc\n" * 30, "", "one two", "x. " * 7]
    for w in wd.words_of(pa.array(texts), wd.SPACED_WORDS):
        u = pg.units(w, 5)
        for i, text in enumerate(texts):
            mine = u.row == i
            covered = np.zeros(len(spaced(text)), dtype=int)
            for a, n in zip(u.first[mine], u.words[mine]):
                assert n >= 5
                covered[a : a + n] += 1
            assert (covered == (len(covered) >= 5)).all()


def test_equal_texts_of_short_lines(spark):
    rng = random.Random(12)
    lines = lambda: "\n".join(" ".join(f"v{rng.randrange(4000)}" for _ in range(rng.randrange(1, 5))) for _ in range(60))
    shouts = " ".join(f"v{rng.randrange(4000)}!!" for _ in range(169))
    menu = lines()
    docs = [(1, menu), (2, menu), (3, shouts), (4, shouts), (5, lines())]
    rows = pg.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_words for r in rows} == {i: len(spaced(t)) for i, t in docs if i < 5}


def test_every_repeated_run_of_words(spark):
    """Runs of 30 words and more that begin and end inside sentences, against all windows of 30 words."""
    rng = random.Random(13)
    plain = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    ended = lambda n: [x + rng.choice(["", "", "", ".", "!"]) for x in plain(n)]
    shared = [make(n) for make in (plain, ended) for n in (29, 30, 31, 51, 60, 81, 169)]
    shared.append(["na"] * 70)
    docs = []
    for i in range(45):
        run = shared[i % len(shared)]
        cut = rng.randrange(0, 4) if i % 2 else 0
        docs.append((i, " ".join(plain(rng.randrange(40, 60)) + run[cut:] + plain(rng.randrange(40, 60)))))
    docs += [(100, docs[0][1]), (101, docs[0][1]), (102, " ".join(plain(80)))]
    found = {r.doc_id: r for r in pg.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    holders = {}
    for i, text in docs:
        words = spaced(text)
        for at in range(len(words) - 29):
            holders.setdefault(tuple(words[at : at + 30]), set()).add(i)
    for i, text in docs:
        words = spaced(text)
        inside = {x for s in (found[i].passages if i in found else []) for x in range(s.first, s.end)}
        removed = {x for s in (found[i].passages if i in found else []) for x in range(s.first, s.end) if s.removed}
        for at in range(len(words) - 29):
            held = holders[tuple(words[at : at + 30])]
            if len(held) > 1:
                assert inside >= set(range(at, at + 30))
                assert min(held) == i or removed >= set(range(at, at + 30))
    assert 102 not in found and sum(r.n_words for r in found.values()) > 1500


def test_all_pairs_of_short_sets():
    """Sets of under nine shingles against all others at 0.8, with texts that repeat their words as well."""
    rng = random.Random(14)
    texts = []
    for _ in range(400):
        words = [f"v{rng.randrange(rng.choice([2, 3, 500]))}" for _ in range(rng.randrange(8, 15))]
        texts += [words, words[1:], words[:-1], words[2:], words[1:-1], words + words[:1]]
    p, sets, held = pg.Params(), {}, {}
    for w in wd.words_of(pa.array([" ".join(x) for x in texts]), wd.SPACED_WORDS):
        u = pg.units(w, p.shingle)
        ends = np.cumsum(u.sizes)
        sets |= {int(u.key[i]): frozenset(u.values[ends[i] - u.sizes[i] : ends[i]].tolist()) for i in range(len(ends))}
        for i, key in zip(*pg.held_keys(w, u, p)):
            held.setdefault(int(u.key[i]), set()).add(int(key))
    near = {
        tuple(sorted((x, y), key=lambda z: len(sets[z])))
        for x, y in combinations(sets, 2)
        if min(len(sets[x]), len(sets[y])) < p.banded and len(sets[x] & sets[y]) * 100 >= len(sets[x] | sets[y]) * p.percent
    }
    assert len(near) > 300 and {len(sets[x]) for x, _ in near} == {4, 5, 6, 7, 8}
    assert {(x, y) for y, keys in held.items() for x in keys if x in sets} == near


def test_short_lines_with_a_word_more(spark):
    rng = random.Random(15)
    lines = [[f"w{rng.randrange(9000)}" for _ in range(12)] for _ in range(6)]
    more = [["and", *x] if i % 2 else [*x, "too"] for i, x in enumerate(lines)]
    docs = [(i, "\n".join(" ".join(x) for x in part)) for i, part in enumerate([lines, more])]
    rows = pg.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.n_words for r in rows} == {0: 72, 1: 78}


def test_written_tables_leave_no_shuffle_files(spark):
    """What a step has shuffled goes when its table is written, so steps do not add up on disk."""

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while files.hasNext():
            names.add(files.next().getName())
        return {n for n in names if n.startswith("shuffle_")}

    before = shuffled()
    kept = Scratch(spark).keep(spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).count())
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before
    assert sorted(r["count"] for r in kept.collect()) == [142] + [143] * 6


def test_windows_of_an_anchor_are_one_row(spark):
    """Runs of windows hold every window of the asked anchors once, and equal runs have equal keys."""
    rng = random.Random(16)
    p = pg.Params()
    same = [f"v{rng.randrange(4000)}" for _ in range(90)]
    texts = [" ".join([f"x{i}{j}" for j in range(50)] + same + [f"y{i}{j}" for j in range(50)]) for i in range(2)]
    texts.append(" ".join(["na"] * 40))
    grams = {}
    for w in wd.words_of(pa.array(texts), wd.SPACED_WORDS):
        for i in range(w.n):
            h = wd.shingle_hashes(w.hashes[w.bounds[i] : w.bounds[i + 1]], p.anchor)
            for at in range(len(h) - p.least_words + p.anchor):
                place = at + int(np.argmin(h[at : at + p.least_words - p.anchor + 1]))
                grams.setdefault((i, place, int(h[place].view(np.int64))), []).append(at)
    asked = [sorted({a for i, _, a in grams if i == t}) for t in range(3)]
    rows = spark.createDataFrame(
        [(i, t, i, a) for i, (t, a) in enumerate(zip(texts, asked))], "id long, text string, last long, anchors array<long>"
    )
    found = pg.asked_runs(rows, p).collect()
    assert {(r.id, r.place, r.anchor): list(range(r["first"], r["first"] + r["count"])) for r in found} == grams
    assert len(found) == len(grams) < sum(map(len, grams.values())) and all(len(r.windows) == r["count"] for r in found)
    first, second = ({(r.place, r.key): r.windows for r in found if r.id == i} for i in range(2))
    both = first.keys() & second.keys()
    assert len(both) > 2 and all(first[x] == second[x] for x in both)


def test_sets_are_read_once(spark, monkeypatch):
    """The search of open buckets takes the sets that the first comparison has read; texts are not read again."""
    calls, read = [], pg.unit_sets
    monkeypatch.setattr(pg, "unit_sets", lambda docs, p: calls.append(1) or read(docs, p))
    docs, _ = material()
    assert pg.find_repeats(spark.createDataFrame(docs, "doc_id long, text string")).count() == 15 and len(calls) == 1
