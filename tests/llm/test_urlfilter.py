"""Dated lists against a look at every entry for every capture."""

import datetime as dt
import random
from urllib.parse import urlsplit

from zoneflow.llm import urlfilter as uf

DAY = dt.date(2024, 1, 1)


def brute(captures, entries):
    valid = []
    entries = [(a, b and b.rstrip("/"), x, d) for a, b, x, d in entries]
    for name, key in {(a, b) for a, b, _, d in entries if None not in (a, b, d)}:
        dated = {}
        for a, b, listed, d in entries:
            if (a, b) == (name, key) and d is not None:
                dated[d] = min(listed, dated.get(d, True))
        times = sorted(dated)
        valid += [(name, key, t, (times[i + 1 :] or [None])[0]) for i, t in enumerate(times) if dated[t]]
    out = []
    for number, url, day in captures:
        parts = urlsplit(url or "")
        host, steps = (parts.hostname or "").lower().rstrip("."), parts.path[1:].split("/")
        labels = host.split(".")
        keys = {".".join(labels[i:]) for i in range(len(labels))} if host else set()
        for i, step in enumerate(steps if host else []):
            if not step:
                break
            keys.add("/".join([host, *steps[: i + 1]]))
        if host and "?" in (url or ""):
            keys.add(f"{host}{parts.path}?{parts.query}")
        active = [n for n, k, a, b in valid if day and k in keys and a <= day and (b is None or day < b)]
        out.append((number, tuple(sorted(set(active))), len(active)))
    return sorted(out, key=str)


def run(spark, captures, entries):
    c = spark.createDataFrame(captures, "id long, url string, fetched date").selectExpr("*", "'x' as lists", "1 as n_active")
    e = spark.createDataFrame(entries, "list string, key string, listed boolean, at date")
    found = uf.evaluate(c, e)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    rows = found.collect()
    assert all(r.blocked == (r.n_active > 0) for r in rows)
    return sorted(((r.id, tuple(r.lists), r.n_active) for r in rows), key=str)


def test_against_brute_force(spark):
    rng = random.Random(6)
    hosts = ["a.example.com", "b.example.com", "example.com", "X.Example.ORG", "hot.net", "www.hot.net"]
    day = lambda: DAY + dt.timedelta(days=rng.randrange(400))
    captures = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['a', 'b/c', '', 'b/c/d', 'b//c', 'b/cc', 'a/'])}?x={i % 3}", day()) for i in range(300)]
    captures += [(900 + i, "https://u:p@hot.net:8080/a", day()) for i in range(100)]
    keys = ["example.com", "a.example.com", "hot.net", "hot.net/a", "com", "x.example.org", "ot.net", "hot.net/b/c", "example.com/b/",
            "hot.net/b/c/d/e", "hot.net/a?x=1", "www.hot.net/?x=2"]
    entries = [(rng.choice(["l1", "l2"]), rng.choice(keys), rng.random() < 0.6, day()) for _ in range(160)]
    entries += [("l1", "hot.net", True, DAY), ("l1", "hot.net", False, DAY), (None, "com", True, DAY), ("l1", "com", True, None)]
    assert run(spark, captures, entries) == brute(captures, entries)


def test_defined_cases(spark):
    captures = [(1, None, DAY), (2, "http://a.b/", None), (3, "no url", DAY), (4, "http://a.b/", DAY), (4, "http://a.b/", DAY),
                (None, "http://a.b./" + "x" * 100_000, DAY)]
    entries = [("l", "b", True, DAY), ("l", "b", False, DAY + dt.timedelta(days=1))]
    assert run(spark, captures, entries) == brute(captures, entries)
    assert run(spark, captures, []) == brute(captures, [])
    assert run(spark, [], entries) == []


def test_entries_with_a_path_or_a_query_hold_what_lies_below(spark):
    urls = ["http://h.org/a/b/c", "http://h.org/a/b", "http://h.org/a/bb", "http://h.org/a", "http://h.org/a/b?q=1", "http://h.org/a/b?q=2#x"]
    captures = [(i, u, DAY) for i, u in enumerate(urls)]
    blocked = lambda key: [i for i, _, n in run(spark, captures, [("l", key, True, DAY)]) if n]
    assert blocked("h.org/a/b") == [0, 1, 4, 5]
    assert blocked("h.org/a/b?q=2") == [5]
    deep = "http://h.org" + "/x" * 50_000
    assert run(spark, [(1, deep, DAY)], [("l", "h.org/x/x/x", True, DAY)]) == [(1, ("l",), 1)]
