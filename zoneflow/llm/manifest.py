"""Merkle manifest of a dataset, with a proof for every row found by pointer jumping."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from zoneflow.llm.scratch import Scratch

FAN = 3  # consecutive nodes under one parent
TOP = -1  # number of the tree over the subroots; the others are numbered by the rank of their first leaf
DIGEST = 32
NODE = ["t", "l", "p"]  # a node: its tree, its level in it, its place in the level


def leaf_digest(columns: Sequence[Column | str]) -> Column:
    """Sha256 in hex of the values one after the other, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    values = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    framed = [F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]
    return F.sha2(F.concat(*framed), 256)


def ranked(rows: DataFrame, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Rows with their number from 0 in the given order as ``rank``, and the range that they were dealt to as ``range``.

    Ranges are sorted apart; their sizes, one row for each range, shift the places within them.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = scratch.keep(dealt.withColumn("range", F.spark_partition_id()).withColumn("place", place))
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    sizes = dealt.groupBy("range").agg(F.count("*").alias("n"))
    firsts = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return dealt.join(F.broadcast(firsts), "range").withColumn("rank", F.col("first") + F.col("place")).drop("first", "place")


def leaves_of_trees(leaves: DataFrame, part: str, order: Sequence[str], scratch: Scratch) -> DataFrame:
    """Nodes of the first level: ``leaves(leaf, ...)`` in their order within each value of ``part``, a tree each.

    ``tree, pos, cnt``: the rank of the tree's first leaf, the leaf's place in the tree, and the tree's leaves.
    """
    names = [part, *order]
    packed = leaves.select(F.struct(*leaves.columns).alias("payload"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(names)])
    held = ranked(packed, [f"o{i}" for i in range(len(names))], scratch)
    # One row for each tree and range, so that the leaves of a large tree meet it range by range.
    whole = W.partitionBy("o0")
    pieces = held.groupBy("o0", "range").agg(F.min("rank").alias("first"), F.count("*").alias("n"))
    pieces = pieces.select(
        F.col("o0").alias("part"), F.col("range").alias("of"), F.min("first").over(whole).alias("tree"),
        F.sum("n").over(whole).alias("cnt"),
    )
    joined = held.join(pieces, F.col("o0").eqNullSafe(F.col("part")) & (F.col("range") == F.col("of")))
    return joined.withColumn("pos", F.col("rank") - F.col("tree")).select(
        "tree", "pos", "cnt", F.col("tree").alias("t"), F.lit(0).cast("long").alias("l"), F.col("pos").alias("p"),
        F.unhex("payload.leaf").alias("digest"), "payload",
    )


def runs(nodes: DataFrame) -> DataFrame:
    """``tree, up, cnt, members``: every ``FAN`` consecutive nodes of a tree, in order; ``cnt`` counts the tree's nodes."""
    return nodes.groupBy("tree", F.floor(F.col("pos") / FAN).alias("up")).agg(
        F.first("cnt").alias("cnt"), F.array_sort(F.collect_list(F.struct("pos", *NODE, "digest", "payload"))).alias("members")
    )


def parents(made: DataFrame) -> DataFrame:
    """Nodes of the next level: a run's digest is that of its members' digests in hex."""
    text = F.array_join(F.transform("members", lambda x: F.lower(F.hex(x["digest"]))), "")
    return made.select(
        "tree", F.col("up").alias("pos"), F.ceil(F.col("cnt") / FAN).alias("cnt"), F.unhex(F.sha2(text, 256)).alias("digest")
    )


def edges(made: DataFrame, level: int, of_subroots: bool) -> DataFrame:
    """``t, l, p, pt, pl, pp, segment, payload``: every member of a run, its parent, and what folds it into the parent.

    A segment holds a byte (four times the place in the run, plus the run's size) and the digests of the other members;
    where members are subroots, their own digest behind a zero byte comes first.
    """
    each = made.select("tree", "up", "members", F.posexplode("members").alias("at", "m"))
    others = F.filter("members", lambda x, i: i != F.col("at"))
    head = F.unhex(F.lpad(F.hex(F.col("at") * 4 + F.size("members")), 2, "0"))
    head = F.concat(F.unhex(F.lit("00")), F.col("m.digest"), head) if of_subroots else head
    segment = F.aggregate(others, head, lambda s, x: F.concat(s, x["digest"]))
    return each.select(
        *[F.col(f"m.{c}").alias(c) for c in NODE], F.col("tree").alias("pt"), F.lit(level + 1).cast("long").alias("pl"),
        F.col("up").alias("pp"), segment.alias("segment"), F.col("m.payload").alias("payload"),
    )


def grow(nodes: DataFrame, tree: int | None, scratch: Scratch) -> tuple[DataFrame, list[DataFrame], int]:
    """Roots of the trees, the written edges of all levels, and the number of levels, by levels from the leaves up.

    Roots keep ``t, l, p`` and, if they are leaves themselves, their payload.
    """
    roots, found, level = None, [], 0
    empty = nodes.schema["payload"].dataType
    while True:
        done = nodes.where("cnt = 1").select("t", "l", "p", "digest", "payload")
        roots = done if roots is None else roots.union(done)
        made = scratch.keep(runs(nodes.where("cnt > 1")))
        if made.isEmpty():
            return roots, found, level
        found.append(scratch.keep(edges(made, level, tree is not None and level == 0)))
        level += 1
        nodes = parents(made).select(
            "tree", "pos", "cnt", F.col("tree").alias("t"), F.lit(level).cast("long").alias("l"), F.col("pos").alias("p"),
            "digest", F.lit(None).cast(empty).alias("payload"),
        )
        nodes = scratch.keep(nodes)
        scratch.drop(made)


def jump(nodes: DataFrame, others: DataFrame) -> DataFrame:
    """Nodes with their pointer moved to where the node there points, and its segment added to theirs.

    A node that points to the root already finds nothing; it is joined under its own name, so that such nodes spread.
    """
    key = [F.coalesce("pt", F.lit(-3) - F.col("t")), F.coalesce("pl", "l"), F.coalesce("pp", "p")]
    left = nodes.select("*", *[k.alias(n) for k, n in zip(key, ("kt", "kl", "kp"))])
    names = {"t": "kt", "l": "kl", "p": "kp", "pt": "qt", "pl": "ql", "pp": "qp", "segment": "more"}
    right = others.select(*[F.col(a).alias(b) for a, b in names.items()])
    joined = left.join(right, ["kt", "kl", "kp"], "left")
    return joined.select(
        *NODE, F.col("qt").alias("pt"), F.col("ql").alias("pl"), F.col("qp").alias("pp"),
        F.concat("segment", F.coalesce("more", F.unhex(F.lit("")))).alias("segment"), "payload",
    )


@dataclass
class Manifest:
    """``root``, the digest of all rows in hex (null without rows), and ``proofs``: ``payload``, the leaf's columns, and
    ``segment``."""

    root: str | None
    proofs: DataFrame


def build(leaves: DataFrame, part: str, order: Sequence[str]) -> Manifest:
    """Manifest of ``leaves(leaf, ...)``: a tree for each value of ``part`` in the given order, and one over their roots.

    1. Levels are built from the leaves up; each node learns its parent and the siblings on the way to it.
    2. Pointers jump: a node's pointer moves to where its ancestor's pointer goes, and the ancestor's siblings are added
       to its own, so the distance doubles in every round.  An ancestor ``2 ** k`` levels up has at most
       ``3 ** 2 ** k`` leaves below it, so the key of a round is shared by few rows until the last round.  Nodes that no
       later round asks for are left behind: only those of at least ``2 ** k`` levels are.

    Defined cases: a null ``part`` is a tree of its own and the first; null order values come first; repeated leaves stand
    next to each other and have a proof each; a tree of one leaf has that leaf as its root; a table without rows has no
    root.  Columns of any name go along.
    """
    scratch = Scratch(leaves.sparkSession)
    nodes = scratch.keep(leaves_of_trees(leaves, part, order, scratch))
    subroots, below, levels = grow(nodes, None, scratch)
    subroots = ranked(scratch.keep(subroots), ["t"], scratch)
    count = subroots.count()
    top = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("rank").alias("pos"), F.lit(count).cast("long").alias("cnt"), *NODE,
        "digest", "payload",
    )
    roots, above, upper = grow(top, TOP, scratch)
    root = roots.select(F.lower(F.hex("digest"))).first()
    if root is None:
        return Manifest(None, nodes.select("payload", F.lit(b"").alias("segment")))
    if not below and not above:
        return Manifest(root[0], nodes.select("payload", F.lit(b"").alias("segment")))
    points = [e for e in below + above]
    everything = points[0]
    for e in points[1:]:
        everything = everything.union(e)
    mine = everything.where("payload is not null")
    others = scratch.keep(everything.where("payload is null"))
    reach = 1
    while reach < levels + upper:
        mine = jump(mine, others)
        reach *= 2
        if reach < levels + upper:
            high = others.where((F.col("l") >= reach) | (F.col("t") == TOP))
            others = scratch.keep(jump(high, others))
    return Manifest(root[0], mine.select("payload", "segment"))


def check(manifest: Manifest, presented: str) -> DataFrame:
    """The leaves' columns with ``subroot, root, proof_sha256, folded_root, verified``.

    ``presented`` names the column with the digest, in hex, of the row as it is now; folded with the siblings of its
    proof it must give the root.  ``proof_sha256`` is the digest of all siblings in hex from left to right, level by level.
    Columns of the leaves that are named like these results are left out.
    """
    names = [c for c in manifest.proofs.schema["payload"].dataType.names if c not in VERDICT]
    rows = manifest.proofs.select(*[F.col("payload")[c].alias(c) for c in names], F.col("segment").alias("_segment"))
    root, at = manifest.root, names.index(presented)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            out = [fold(s.hex(), d, root) for s, d in zip(columns[-1].to_pylist(), columns[at].to_pylist())]
            subroots, proofs, folded = zip(*out) if out else ((), (), ())
            added = [pa.array(list(x), pa.string()) for x in (subroots, [root] * len(out), proofs, folded)]
            added.append(pa.array([x == root for x in folded], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*columns[:-1], *added], names=[*names, *VERDICT])

    texts = rows.select(*names).withColumns({c: F.lit("") for c in VERDICT[:-1]})
    return rows.mapInArrow(run, texts.withColumn("verified", F.lit(True)).schema)


VERDICT = ["subroot", "root", "proof_sha256", "folded_root", "verified"]


def fold(segment: str, digest: str, root: str) -> tuple[str, str, str]:
    """Subroot, digest of the siblings, and folded root from the segment in hex and a leaf's digest."""
    subroot, siblings, at, size = root, [], 0, 2 * DIGEST
    while at < len(segment):
        head = int(segment[at : at + 2], 16)
        at += 2
        if head == 0:
            subroot = segment[at : at + size]
            at += size
            continue
        turn = at + head // 4 * size
        end = at + (head % 4 - 1) * size
        siblings.append(segment[at:end])
        digest = hashlib.sha256((segment[at:turn] + digest + segment[turn:end]).encode()).hexdigest()
        at = end
    return subroot, hashlib.sha256("".join(siblings).encode()).hexdigest(), digest
