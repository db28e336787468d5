"""Piece encoding against the library that the model belongs to, and exact round trips."""

import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from zoneflow.llm import pieces as ps
from zoneflow.llm import words as wd
from zoneflow.llm.catalogue import PIECE_MODEL


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)


def encode(texts):
    t, memory, out = ps.tables(open(PIECE_MODEL, "rb").read()), ps.Memory(), []
    for _, data, offsets in wd.text_slices(ps._plain(pa.array(texts, pa.string())), 3_000):
        ids, sizes = ps.encode_texts(data, offsets, t, memory)
        at = 0
        for n in sizes:
            out.append(ids[at : at + n].tolist())
            at += n
    return out


def test_random_texts(library):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdeinorst  \n\té中▁=-.,1😀") for _ in range(rng.randrange(200))) for _ in range(1500)]
    assert encode(texts) == [library.encode(t) for t in texts]


@pytest.mark.parametrize(
    "text",
    ["", "a", " a", "  a", "   ", "\n\n  \n x  梦 梦想", "aaaaaaa " + "a" * 500, "    def f(x):\n        return x\n", " 𝄞  𝄞 ",
     "trailing   ", " " * 45 + "x", "x  \U0001F600", "\x00\x01 a", "The quick brown fox's http://www.example.com/?q=a&b"],
)
def test_odd_texts(library, text):
    assert encode([text]) == [library.encode(text)]


def test_documents_of_the_test_tables(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = ps.encode(docs, PIECE_MODEL).collect()
    assert [r.ids for r in rows] == [library.encode(r.text) for r in rows]
    assert all(r.round_trip for r in rows)


def test_frames(spark, library):
    df = spark.createDataFrame(
        [(1, "a b", "x"), (1, "a b", "x"), (None, None, None), (2, "", "y"), (3, "a▁b", "z"), (4, "word " * 30_000, "w")],
        "doc_id long, text string, ids string",
    )
    rows = ps.encode(df, PIECE_MODEL).collect()
    assert [(r.doc_id, r.round_trip) for r in rows] == [(1, True), (1, True), (None, True), (2, True), (3, False), (4, True)]
    assert rows[2].ids == [] and rows[3].ids == [] and rows[4].ids == library.encode("a▁b")
    back = ps.decode(ps.encode(df, PIECE_MODEL), PIECE_MODEL).collect()
    assert [r.decoded for r in back] == [("" if r.text is None else r.text.replace("▁", " ")) for r in back]
    assert ps.encode(df.limit(0), PIECE_MODEL).count() == 0
    odd = spark.createDataFrame([([40000, -1, None],), (None,), ([200],)], "ids array<int>")
    assert [r.decoded for r in ps.decode(odd, PIECE_MODEL).collect()] == ["", None, "�"]


def test_suffix_array_finds_every_occurrence():
    t = ps.tables(open(PIECE_MODEL, "rb").read())
    import numpy as np

    raw = b" the\0 there\0hello the\0"
    which, at = ps.occurrences(np.frombuffer(raw, dtype=np.uint8), t)
    got = {(t.pieces[t.matched[w]], int(a)) for w, a in zip(which, at)}
    matched = {t.pieces[i] for i in t.matched}
    want = {(raw[a:b], a) for a in range(len(raw)) for b in range(a + 1, len(raw) + 1) if raw[a:b] in matched}
    assert got == want


def test_only_tied_suffixes_are_sorted_by_all_their_bytes(monkeypatch):
    """The order of the words' suffixes, with few of them in the sort by several keys."""
    rng = np.random.default_rng(4)
    words = [bytes(rng.integers(97, 123, rng.integers(1, 24)).astype(np.uint8)) for _ in range(2_000)] + [b"abcdefghijklmnop"] * 3
    text = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)
    t = ps.tables(open(PIECE_MODEL, "rb").read())
    sorted_rows = []
    lexsort = np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys: sorted_rows.append(len(keys[0])) or lexsort(keys))
    which, at = ps.occurrences(text, t)
    assert sum(sorted_rows) < 100
    raw = text.tobytes()
    found = {}
    for i, a in zip(which.tolist(), at.tolist()):
        found.setdefault(t.pieces[t.matched[i]], []).append(a)
    for piece in ("abcdefghijklmnop", "abcdefgh", "abc", "ing", "q", "international"):
        piece = piece.encode()
        places = [a for a in range(len(raw)) if raw.startswith(piece, a)]
        if t.id_of.get(piece) in set(t.matched.tolist()):
            assert sorted(found.get(piece, [])) == places
