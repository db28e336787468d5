"""Secret scans: a trigram inverted index chooses the texts that each rule has to be tried on.

Only DataFrame functions are used.  Python derives the trigram queries of the rules, once, on the driver.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass
from re import _constants as code
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.scratch import Scratch

MAX_STRINGS = 64  # exact strings or alternatives that a query may grow to before it is left weaker
TEXTS_PER_BLOCK = 5_000


@dataclass(frozen=True)
class Rule:
    """A pattern of the syntax that Java and Python share.  ``least`` is the length that ``group`` must reach."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# The three base rules, then those added for keys of known form.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
)

# --- trigram queries ---------------------------------------------------------

Query = list[frozenset[str]] | None  # alternatives of trigrams that must all occur; None where any text may match


def _all_of(a: Query, b: Query) -> Query:
    if a is None or b is None:
        return a if b is None else b
    if len(a) * len(b) > MAX_STRINGS:
        return min(a, b, key=len)
    return _minimal({x | y for x in a for y in b})


def _minimal(clauses: set[frozenset[str]]) -> list[frozenset[str]]:
    return sorted((c for c in clauses if not any(d < c for d in clauses)), key=sorted)


def _needs(strings: set[str]) -> Query:
    """Trigrams of texts that hold one of the strings."""
    clauses = set()
    for s in strings:
        grams = frozenset(s[i : i + 3] for i in range(len(s) - 2))
        if not grams:
            return None
        clauses.add(grams)
    return _minimal(clauses)


def _class_strings(items) -> set[str] | None:
    out: set[str] = set()
    for op, value in items:
        if op is code.LITERAL:
            out.add(chr(value).lower())
        elif op is code.RANGE and value[1] - value[0] < 8:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 8 else None


def _sequence(items) -> tuple[set[str] | None, Query]:
    """(strings that the sequence equals, or None where unknown; what any text with a match must hold)."""
    query: Query = None
    current, exact = {""}, True

    def close() -> None:
        nonlocal query, current, exact
        query, current, exact = _all_of(query, _needs(current)), {""}, False

    for op, value in items:
        strings, inner = _item(op, value)
        if strings is not None and len(strings) * len(current) <= MAX_STRINGS:
            current = {a + b for a, b in itertools.product(current, strings)}
        else:
            close()
            query = _all_of(query, inner)
    full = current
    query = _all_of(query, _needs(current))
    return (full if exact else None), query


def _item(op, value) -> tuple[set[str] | None, Query]:
    if op is code.LITERAL:
        return {chr(value).lower()}, None
    if op is code.AT:
        return {""}, None
    if op is code.IN:
        return _class_strings(value), None
    if op is code.SUBPATTERN:
        return _sequence(value[-1])
    if op is code.BRANCH:
        parts = [_sequence(x) for x in value[1]]
        queries = [q for _, q in parts]
        query = None if any(q is None for q in queries) else _minimal(set(itertools.chain(*queries)))
        known = all(s is not None for s, _ in parts)
        strings = set().union(*(s for s, _ in parts)) if known else None
        return (strings if strings is not None and len(strings) <= MAX_STRINGS else None), query
    if op in (code.MAX_REPEAT, code.MIN_REPEAT):
        least, most, body = value
        strings, query = _sequence(body)
        if strings is not None and (least, most) == (0, 1):
            return strings | {""}, None
        if strings is not None and least == most and len(strings) ** least <= MAX_STRINGS:
            return {"".join(x) for x in itertools.product(strings, repeat=least)}, None
        if least and strings is not None:
            return None, _all_of(query, _needs({"".join(x) for x in itertools.product(strings, repeat=min(least, 3))}
                                               if len(strings) ** min(least, 3) <= MAX_STRINGS else strings))
        return None, query if least else None
    return None, None


def trigram_query(pattern: str) -> Query:
    """Alternatives of lower-case trigrams, one of which every matching text holds; None if the rule has none."""
    return _sequence(_parser.parse(pattern))[1]


# --- index -------------------------------------------------------------------


def build_index(docs: DataFrame, trigrams: list[str], blocks: int, text_column: str = "text") -> DataFrame:
    """``block, trigram, keys``: postings of the trigrams that the rules ask for.

    A text is known by the hash of its content, so copies share one posting; blocks bound the length of a list.
    """
    low = docs.select(
        F.xxhash64(F.coalesce(text_column, F.lit(""))).alias("key"), F.lower(F.col(text_column)).alias("low")
    )
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    rows = low.select("key", F.explode(held).alias("trigram"))
    return (
        rows.withColumn("block", F.pmod("key", F.lit(blocks)))
        .groupBy("block", "trigram")
        .agg(F.collect_set("key").alias("keys"))
    )


def _matching(query: list[frozenset[str]]) -> Column:
    """Keys of a block that satisfy the query: lists are intersected from the shortest, alternatives united."""
    none = F.array().cast("array<long>")
    out = none
    for clause in query:
        lists = F.array(*[F.coalesce(F.col("postings")[t], none) for t in sorted(clause)])
        by_size = F.array_sort(F.transform(lists, lambda x: F.struct(F.size(x).alias("n"), x.alias("x"))))
        first = F.element_at(by_size, 1)["x"]
        out = F.array_union(out, F.aggregate(by_size, first, lambda s, x: F.array_intersect(s, x["x"])))
    return out


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """``key, kinds``: for each text, the rules whose trigram query it satisfies."""
    per_block = index.groupBy("block").agg(
        F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("postings")
    )
    asked = [(r.kind, trigram_query(r.pattern)) for r in rules]
    found = [F.struct(F.lit(k).alias("kind"), _matching(q).alias("keys")) for k, q in asked if q is not None]
    rows = per_block.select(F.explode(F.array(*found)).alias("r")).select("r.kind", F.explode("r.keys").alias("key"))
    return rows.groupBy("key").agg(F.collect_set("kind").alias("kinds"))


# --- verification ------------------------------------------------------------


def _spans(rule: Rule, number: int, text: str, found: str) -> Column:
    """Spans of a rule's matches from the text between them: code points, end exclusive."""
    pieces = F.split(text, rule.java, -1)
    values = F.regexp_extract_all(text, F.lit(rule.java), F.lit(rule.group))
    rows = F.arrays_zip(
        pieces.alias("piece"), F.col(found).alias("match"), values.alias("value")
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,number:int,end:int,ok:boolean>>").alias("out"))

    def step(s, x):
        begin = s["at"] + F.length(x["piece"])
        end = begin + F.length(x["match"])
        span = F.struct(
            begin.alias("start"), F.lit(number).alias("number"), end.alias("end"),
            (F.length(x["value"]) >= rule.least).alias("ok"),
        )
        return F.struct(end.alias("at"), F.array_append(s["out"], span).alias("out"))

    kept = F.aggregate(F.slice(rows, 1, F.size(found)), start, step)["out"]
    spans = F.transform(F.filter(kept, lambda x: x["ok"]), lambda x: F.struct(x["start"], x["number"], x["end"]))
    empty = F.array().cast("array<struct<start:int,number:int,end:int>>")
    return F.when(F.size(found) > 0, spans).otherwise(empty)


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, text_column: str = "text", output: str = "spans"
) -> DataFrame:
    """``docs`` with ``output``: the matches of all rules, by start, then by the order of the rules.

    Rules with trigrams are tried on their candidates only; a rule without is tried on every text.

    Defined cases: a null or empty text has no spans; a text that the index holds by a clashing hash is only tried in
    vain; repeated rows each get their spans; other columns are kept, but one named like ``output`` is replaced.
    """
    scratch = Scratch(docs.sparkSession)
    indexed = [r for r in rules if trigram_query(r.pattern) is not None]
    grams = sorted(set().union(*(c for r in indexed for c in trigram_query(r.pattern)))) if indexed else []
    text = docs.columns.index(text_column)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("_text", F.coalesce(names[text], F.lit("")))
    if grams:
        blocks = max(1, math.ceil(docs.count() / TEXTS_PER_BLOCK))
        index = scratch.keep(build_index(docs, grams, blocks, text_column))
        found = candidates(index, indexed).withColumnRenamed("key", "_key")
        rows = rows.withColumn("_key", F.xxhash64("_text")).join(found, "_key", "left")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    kinds = {r.kind for r in indexed}
    none = F.array().cast("array<string>")
    for i, r in enumerate(rules):
        matches = F.regexp_extract_all("_text", F.lit(r.java), F.lit(0))
        if r.kind in kinds:
            matches = F.when(F.array_contains("kinds", r.kind), matches).otherwise(none)
        rows = rows.withColumn(f"_m{i}", F.coalesce(matches, none))
    spans = F.array_sort(F.concat(*[_spans(r, i, "_text", f"_m{i}") for i, r in enumerate(rules)]))
    shown = F.transform(
        spans,
        lambda x: F.struct(
            F.element_at(F.array(*[F.lit(r.kind) for r in rules]), x["number"] + 1).alias("kind"),
            x["start"].alias("start"), x["end"].alias("end"),
        ),
    )
    kept = [F.col(n).alias(c) for n, c in zip(names, docs.columns) if c != output]
    return rows.select(*kept, shown.alias(output))


def span_list(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(docs: DataFrame, mask: str = "<secret>", text_column: str = "text") -> DataFrame:
    """``docs`` with each run of overlapping spans replaced by ``mask``; texts without spans are unchanged."""
    found = scan(docs, text_column=text_column, output="_found")
    text = F.col(text_column)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s, x):
        apart = x["start"] >= s["at"]
        between = F.substring(text, s["at"] + 1, x["start"] - s["at"])
        return F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(apart, F.concat(s["out"], between, F.lit(mask))).otherwise(s["out"]).alias("out"),
        )

    done = F.aggregate("_found", start, step)
    new = F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return found.withColumn(text_column, F.when(F.size("_found") > 0, new).otherwise(text)).select(*docs.columns)
