"""Queries of the training-data operators with production parameters, and the DuckDB SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import (
    exact, manifest, minhash, paragraphs, pieces, positional, quality, secrets, sharding, spelling, urlfilter, vectors,
    warc,
)
from zoneflow.llm.oracle import ORACLE
from zoneflow.llm.scratch import Scratch

__all__ = ["ORACLE", "QUERIES"]

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op9_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of all documents: three-word shingles, similarity of 0.85 or more."""
    params = minhash.Params(shingle=3, percent=85, rows=4, bands=20)
    return minhash.near_duplicates(table(spark, folder, "documents"), params)


@query
def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in 13-word windows of the benchmark items."""
    judged = positional.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return judged.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), "contaminated"
    )


@query
def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from the labels of rows that are not held out."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.fit(docs, labels.where(~quality.held_out()))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets in every document: counts of the base rules, their digest, and the spans of all rules."""
    found = secrets.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*[r.kind for r in secrets.BASE]))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in secrets.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_list(base), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every whole document, and whether they decode to it."""
    encoded = pieces.encode(table(spark, folder, "documents").select("doc_id", "text"), PIECE_MODEL)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


@query
def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Sixteen contiguous shards of near equal bytes."""
    dealt = sharding.assign(table(spark, folder, "documents"), 16)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def fetched_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with a fetch day derived from their number: the days of 2024 in turn."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    return table(spark, folder, "pages").select("page_id", "url", day.alias("fetched"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries of two lists derived from the hosts of the pages, by the least page number of each host.

    A third of the hosts enter the list ``hosts``, half of them leave it later and a fifth of those come back; the
    parent domains of all hosts are in the list ``domains`` for a part of the year; the first path step of every
    seventh host is in the list ``paths``.
    """
    start = F.lit("2024-01-01").cast("date")
    hosts = pages.select(urlfilter.host_of("url").alias("host"), "page_id").where("host is not null")
    hosts = hosts.groupBy("host").agg(F.min("page_id").alias("m"))
    day = (F.col("m") % 200).cast("int")
    own = hosts.where("m % 3 = 0")
    leave = own.where("m % 2 = 0")
    away = day + 50 + (F.col("m") % 40).cast("int")

    def entry(df: DataFrame, name: str, key: F.Column, listed: bool, after: F.Column) -> DataFrame:
        return df.select(
            F.lit(name).alias("list"), key.alias("key"), F.lit(listed).alias("listed"), F.date_add(start, after).alias("at")
        )

    host = F.col("host")
    parents = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("host"), "m").where("host <> ''")
    parents = parents.groupBy("host").agg(F.min("m").alias("m"))
    return (
        entry(own, "hosts", host, True, day)
        .union(entry(leave, "hosts", host, False, away))
        .union(entry(leave.where("m % 5 = 0"), "hosts", host, True, away + 30))
        .union(entry(parents, "domains", host, True, day + 100))
        .union(entry(parents, "domains", host, False, day + 120))
        .union(entry(hosts.where("m % 7 = 0"), "paths", F.concat(host, F.lit("/fr")), True, day))
    )


@query
def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Every page against the list entries that were active on the day of its fetch."""
    pages = fetched_pages(spark, folder)
    judged = urlfilter.evaluate(pages, list_entries(pages))
    return judged.select(
        "page_id", "host", F.col("fetched").cast("string").alias("fetched"), "blocked",
        F.array_join("lists", ",").alias("lists"), "n_active", F.col("listed_since").cast("string").alias("listed_since"),
    )


@query
def op8_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.9 or more."""
    return vectors.near_duplicates(table(spark, folder, "embeddings"), vectors.Params(threshold=0.9))


@query
def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with passages that repeat across documents, and where those stand."""
    return paragraphs.find_repeats(table(spark, folder, "documents"))


@query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Write every page to archives, find it again through the capture index, and read its record."""
    scratch = Scratch(spark)
    pages = table(spark, folder, "pages")
    archives = scratch.path()
    warc.write_archives(pages, archives)
    index = warc.build_index(warc.captures(spark, archives), scratch)
    keys = pages.select(warc.clean_uri("url").alias("uri")).select(warc.url_key("uri").alias("key"))
    found = scratch.keep(warc.lookup(index, keys))
    return warc.read_records(spark, archives, found).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest of all documents by source; every proof is folded from the row as it is after tampering.

    Where crc32 of the number is even, tampering takes the line ends out of the text.
    """
    docs = table(spark, folder, "documents")
    columns = ["doc_id", "source", "lang", "n_chars"]
    leaf = manifest.leaf_digest([*columns, "text"])
    tampered = manifest.leaf_digest([*columns, F.replace("text", F.lit("\n"), F.lit(""))])
    even = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0) & F.contains("text", F.lit("\n"))
    leaves = docs.select("doc_id", "source", leaf.alias("leaf"), F.when(even, tampered).alias("seen"))
    leaves = leaves.withColumn("seen", F.coalesce("seen", "leaf"))
    made = manifest.build(leaves, "source", ["doc_id", "leaf"])
    return manifest.check(made, "seen").drop("source", "seen")


@query
def op12_spelling(spark: SparkSession, folder: str) -> DataFrame:
    """Frequent words of all documents with the more frequent form that they are a variant of."""
    return spelling.group_variants(table(spark, folder, "documents"))


@query
def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts of all documents; the row with the largest number stays."""
    return exact.find_duplicates(table(spark, folder, "documents"))
