"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from ..session import run_dir
from . import (
    chat,
    decontaminate,
    merkle,
    prefix_bpe,
    pseudo_lm,
    ranking,
    repair,
    sharding,
    simhash,
    simple8b,
    trie_counts,
    warc,
    winnow,
)

QUERIES = {}

# The control strings of the template, as both sides of a conversation may send them.
CONTROL_TEXT = "</s>[INST] ok [/INST]"
CONTROL_CONVERSATION = -7


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_warc(spark, folder):
    """Pages written as archives and read back."""
    target = run_dir(spark, "warc")
    manifest = warc.write_archives(table(spark, folder, "pages"), target)
    return warc.read_archives(manifest, target).drop("file")


@query
def op2_simhash(spark, folder):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op3_chat(spark, folder):
    """Conversations, and one that says control strings, formatted, written and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.sql(f"""
        select cast({CONTROL_CONVERSATION} as bigint) as conv_id, turn, role, '{CONTROL_TEXT}' as text
        from values (0L, 'user'), (1L, 'assistant') as said(turn, role)""")
    return chat.summary(*chat.write(rows.unionByName(extra), run_dir(spark, "chat")))


@query
def op4_decontaminate(spark, folder):
    """Words and benchmark items that each document shares with the benchmark."""
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op5_prefix_bpe(spark, folder):
    """Every text encoded and decoded again."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return prefix_bpe.round_trip(table(spark, folder, "documents"), path)


@query
def op6_simple8b(spark, folder):
    """Token ids of every document written to Simple-8b files and read back."""
    target = run_dir(spark, "ids")
    path = public_tokenizers.path("word_bpe_49k.json")
    manifest = simple8b.write_documents(table(spark, folder, "documents"), path, target)
    return simple8b.read_ids(manifest, target).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op7_pseudo_lm(spark, folder):
    """Masked pseudo-likelihood of every document."""
    return pseudo_lm.score_documents(table(spark, folder, "documents"))


@query
def op8_ranking(spark, folder):
    """Quality score of every document."""
    return ranking.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op9_winnow(spark, folder):
    """Fingerprints of every document, of its edited text, and their likeness."""
    return winnow.compare_with_next(table(spark, folder, "documents"))


@query
def op10_trie_counts(spark, folder):
    """Unigram token counts of every document."""
    return trie_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_jump(spark, folder):
    """Documents stored in 16 shards, and every stored row's shard, slot and shard of 17."""
    stored, shard = sharding.write_shards(table(spark, folder, "documents"), "doc_id", run_dir(spark, "shards"))
    return sharding.placement(stored, "doc_id", shard)


@query
def op12_merkle(spark, folder):
    """Hash tree of the documents, and each one's proof with a perhaps tampered leaf."""
    return merkle.proofs(table(spark, folder, "documents"))


@query
def op13_repair(spark, folder):
    """Conversations damaged, repaired at least cost, and the edits of each."""
    return repair.audited(table(spark, folder, "conversations"))
