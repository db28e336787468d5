"""Secret scan against a scan of every text by every rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from zoneflow.llm import secrets as sc


def brute(text, rules):
    out = []
    for number, r in enumerate(rules):
        for m in re.finditer(r.pattern, text or "", re.IGNORECASE | re.ASCII if r.any_case else re.ASCII):
            if len(m.group(r.group)) >= r.least:
                out.append((m.start(), number, f"{r.kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def material():
    rng = random.Random(2)
    key = lambda n, s="abcdefXYZ0189+/_.=-": "".join(rng.choice(s) for _ in range(n))
    parts = [
        lambda: f"password = '{key(12)}'", lambda: f"API_KEY:{key(5)}", lambda: f'apikey"= "{key(6)}', lambda: "AKIA" + key(16, "ABC09"),
        lambda: "AKIA" + key(15, "ABC09"), lambda: key(24, "abc0189"), lambda: key(23, "abc0189"), lambda: "secret:token:" + key(9),
        lambda: "ghp_" + key(36, "abcZ09"), lambda: "-----BEGIN RSA PRIVATE KEY-----", lambda: "xoxb-" + key(14, "ab09-"),
        lambda: "Été ça 漢字 \U0001F600", lambda: "pass ass ret sec ecr cre ken tok oke", lambda: "pw", lambda: "SECRET=abcdefg",
    ]
    rows = [(i, rng.choice(["", " ", "\n"]).join(rng.choice(parts)() for _ in range(rng.randrange(8)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (None, "token=abcdefgh"), (202, rows[3][1]), (202, rows[3][1]),
                   (203, "x " * 60_000 + "token=abcdefgh é AKIA" + "A" * 16)]


def test_against_scanning_everything(spark):
    rules = sc.BASE + sc.ADDED
    df = spark.createDataFrame([(*r, n) for n, r in enumerate(material())], "doc_id long, text string, kinds int")
    df = df.withColumn("spans", F.lit(1)).select("spans", *df.columns)
    found = sc.scan(df).withColumn("line", sc.span_list(F.col("spans")))
    assert found.columns == [*df.columns[1:], "spans", "line"]
    assert sc.redact(df).columns == df.columns and sc.redact(df).where("spans = 1").count() == df.count()
    rows = found.collect()
    assert len(rows) == df.count()
    for r in rows:
        assert r.line == brute(r.text, rules), r.text[:200]
    assert sum(len(r.spans) > 0 for r in rows) > 60


def test_no_python_in_the_plan(spark):
    plan = sc.scan(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sc.scan(df).count() == 0 and sc.redact(df).count() == 0


@pytest.mark.parametrize("pattern", [r.pattern for r in sc.BASE + sc.ADDED] + ["ab(cd|e+f)gh", "(foo|bar)?bazqux", "x{3}yz+w", "a.cdef", "(ab|cd){2}e"])
def test_queries_are_met_by_matches(pattern):
    """Every match holds one alternative of the query: strings are drawn from the pattern."""
    query = sc.trigram_query(pattern)
    samples = {
        "ab(cd|e+f)gh": ["abcdgh", "abeefgh"], "(foo|bar)?bazqux": ["bazqux", "foobazqux"], "x{3}yz+w": ["xxxyzzw"],
        "a.cdef": ["aXcdef"], "(ab|cd){2}e": ["abcde", "ababe"],
    }.get(pattern, [])
    for s in samples:
        assert re.fullmatch(pattern, s)
        assert query is None or any(all(g in s for g in clause) for clause in query)
    assert (query is None) == (pattern in (sc.BASE[2].pattern, "ab(cd|e+f)gh"))  # nothing of three characters must occur


def test_redact(spark):
    df = spark.createDataFrame([(1, "a token=abcdefgh b"), (2, "fine"), (3, None), (4, "AKIA" + "A" * 16 + " token: " + "a" * 30)], "doc_id long, text string")
    out = {r.doc_id: r.text for r in sc.redact(df).collect()}
    assert out == {1: "a <secret> b", 2: "fine", 3: None, 4: "<secret> <secret>"}
