"""Queries of the training-data operators: name -> fn(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path, table
from . import chat, lm, neighbours, repair, secret_scan, toxicity
from .alignment import align_documents
from .common import held_out
from .decontaminate import find_contamination
from .multiset import edit_likeness
from .packing import pack_documents
from .simhash import near_duplicates
from .token_file import read_documents, write_token_file
from .warc import page_archive

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


@query("op1_packing")
def op1_packing(spark, sf):
    pieces = pack_documents(table(spark, sf, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("token_ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query("op6_decontaminate")
def op6_decontaminate(spark, sf):
    found = find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                        "contaminated")


@query("op7_simhash")
def op7_simhash(spark, sf):
    classes = near_duplicates(table(spark, sf, "documents"))
    return classes.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                          "component_id")


@query("op8_toxicity")
def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    model = toxicity.train(docs, table(spark, sf, "labels"))
    return toxicity.score_documents(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query("op9_token_file")
def op9_token_file(spark, sf):
    path = scratch_path(spark, "token-ids")
    write_token_file(table(spark, sf, "documents"), path)
    return read_documents(spark, path)


@query("op10_fingerprint")
def op10_fingerprint(spark, sf):
    return edit_likeness(table(spark, sf, "documents"))


@query("op3_lm")
def op3_lm(spark, sf):
    return lm.score_documents(table(spark, sf, "documents"))


@query("op4_warc")
def op4_warc(spark, sf):
    pages = page_archive(table(spark, sf, "pages"), scratch_path(spark, "warc"), bodies=False)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id > f.first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > f.first_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


# The conversation that every run of op5 formats besides those of the table.
CONTROL_TEXT = r"\### Assistant: </turn> ok"


@query("op5_chat")
def op5_chat(spark, sf):
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat.format_conversations(turns.unionByName(more))
    new = F.slice(chat.parse_turns(F.col("text")), F.col("n_context") + 1, F.col("n_turns"))
    said = F.array_join(F.transform(new, lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(chat.masked_texts("text", "loss"), "")
    part = F.struct("window", said.alias("said"), learned.alias("learned"))
    parts = F.array_sort(F.collect_list(part))
    read = windows.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"), F.sum(F.length("text")).alias("formatted_chars"),
        parts.alias("parts"))
    whole = lambda f: F.array_join(F.transform("parts", lambda p: p[f]), "")
    return read.select("conv_id", "n_turns", F.sha2(whole("said"), 256).alias("turns_sha256"),
                       F.length(whole("learned")).cast("long").alias("loss_chars"),
                       F.sha2(whole("learned"), 256).alias("loss_sha256"), "formatted_chars")


@query("op2_secrets")
def op2_secrets(spark, sf):
    found = secret_scan.scan(table(spark, sf, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    count = lambda kind: F.size(of(kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secret_scan.listed(of(*secret_scan.BASE)), 256).alias("base_sha256"),
                        secret_scan.listed(F.col("spans")).alias("spans"),
                        secret_scan.listed_credentials(F.col("credentials")).alias("credentials"))


@query("op11_repair")
def op11_repair(spark, sf):
    turns = repair.damaged(table(spark, sf, "conversations"))
    return repair.conversations_of(repair.repair(turns, times_column="times")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@query("op13_neighbours")
def op13_neighbours(spark, sf):
    return neighbours.nearest(table(spark, sf, "embeddings"))


@query("op12_alignment")
def op12_alignment(spark, sf):
    return align_documents(table(spark, sf, "documents"))
