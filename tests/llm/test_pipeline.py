"""The pipeline's stages, each against a plain version on its own input, and the queries against their SQL."""

import re

import pytest
import sentencepiece
from brute import Union, alnum, shingles, spaced
from comparing import differences, duck
from pyspark.sql import functions as F

import corpus_pipeline as cp
from zoneflow.llm import quality
from zoneflow.llm.catalogue import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


def planted(spark, folder):
    """The tables with a secret at the end of every second document."""
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    text = F.when(F.col("doc_id") % 2 == 0, F.concat("text", F.lit("\napi_key = Zx81kq77pl\n"))).otherwise(F.col("text"))
    docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages(spark, tmp_path):
    folder = planted(spark, str(tmp_path / "tables"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    names = docs.columns
    frames = []
    for number, (name, stage) in enumerate(cp.STAGES):
        stage(spark, docs, folder).write.parquet(str(tmp_path / f"{number}-{name}"))
        docs = spark.read.parquet(str(tmp_path / f"{number}-{name}"))
        frames.append(docs)
        assert number == len(cp.STAGES) - 1 or docs.columns == names
    kept, deduped, cleaned, redacted, encoded = ({r.doc_id: r for r in f.collect()} for f in frames)

    start = spark.read.parquet(f"{folder}/documents.parquet")
    scored = quality.score(start, quality.fit(start, labels.where(~quality.held_out())))
    assert set(kept) == {r.doc_id for r in scored.collect() if r.score >= 0.3}

    sets = {i: shingles(spaced(r.text), 5) for i, r in kept.items()}
    union = Union(sets)
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                union.join(a, b)
    assert set(deduped) == {union.find(i) for i in ids}

    items = [alnum(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 13]) for w in items if w for i in range(max(1, len(w) - 12))}
    sizes = {len(w) for w in windows}

    def clean(text):
        words, hit = alnum(text), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
        return not (hit and 20 * len(hit) >= len(words))

    assert set(cleaned) == {i for i, r in deduped.items() if clean(r.text)}
    assert len(before) > len(kept) > len(deduped) > len(cleaned)

    assert set(redacted) == set(cleaned) == set(encoded)
    pattern = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})""", re.I | re.A)
    for i, r in redacted.items():
        assert not pattern.search(r.text) and r.n_chars == len(r.text)
        assert not re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r.text)
    hidden = {i for i, r in redacted.items() if "<secret>" in r.text}
    assert hidden >= {i for i in redacted if i % 2 == 0} and len(hidden) > 20

    library = sentencepiece.SentencePieceProcessor(model_file=cp.PIECE_MODEL)
    assert all(encoded[i].ids == library.encode(r.text) for i, r in redacted.items())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    found = [d for d in differences(QUERIES[name](spark, FOLDER), duck(FOLDER), ORACLE[name]) if not d.startswith("kinds")]
    assert found == []


def test_each_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
