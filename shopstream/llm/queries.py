"""The queries of this subpackage, by name; each takes a session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm import audit, chat, decontaminate, embeddings, html, licenses, mixing, neardup, packing, pii, quality, tokens, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    return public_tokenizers.path(name)


@query
def op1_licenses(spark, sf):
    return licenses.scan(table(spark, sf, "documents"))


ORACLE_SQL["op1_licenses"] = licenses.SQL


@query
def op2_token_counts(spark, sf):
    return tokens.count_tokens(table(spark, sf, "documents"), vocabulary("byte_bpe_50k.tiktoken"))


@query
def op3_chat(spark, sf):
    return chat.render(table(spark, sf, "conversations"))


ORACLE_SQL["op3_chat"] = chat.SQL


@query
def op4_quality(spark, sf):
    docs = table(spark, sf, "documents")
    net = quality.learn(docs, table(spark, sf, "labels"))
    found = quality.scored(docs.select("doc_id", "text"), net)
    predicted = (F.col("score") >= quality.GOOD).cast("int").alias("predicted")
    return found.select("doc_id", quality.held_out().alias("held_out"), "score", predicted)


@query
def op5_html(spark, sf):
    return html.extract(table(spark, sf, "pages"))


@query
def op6_pii(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = pii.find_private(docs, pii.learn(docs))
    counts = [pii.count(kind) for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.written_out("base"), 256).alias("base_sha256"), pii.written_out("spans").alias("spans"))


@query
def op7_near_duplicates(spark, sf):
    return neardup.dedup(table(spark, sf, "documents"))


@query
def op8_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.judge(decontaminate.find_benchmark(docs, table(spark, sf, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op9_embeddings(spark, sf):
    return embeddings.near_vectors(table(spark, sf, "embeddings"))


@query
def op10_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), vocabulary())
    columns = ["doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"]
    return pieces.select(*columns)


@query
def op11_whitening(spark, sf):
    return whitening.by_component(whitening.whiten(table(spark, sf, "embeddings")))


@query
def op12_filter_audit(spark, sf):
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


ORACLE_SQL["op12_filter_audit"] = audit.SQL


@query
def op13_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")
