"""Queries of the operators over whole tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers

from talkscout.llm import chat, hmm, licenses, neardup, packing, periodic, pieces, quality, repair, tokencounts, topk, toxicity, warc
from talkscout.llm.shared import shared_folder

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_chat_formatting(spark, sf_dir):
    return chat.read_back(chat.prefix_targets(chat.with_probe(table(spark, sf_dir, "conversations"))))


@query
def op2_warc_salvage(spark, sf_dir):
    folder = shared_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.pages_of(warc.read_archives(spark, folder, with_payload=False))


@query
def op3_maxscore(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


@query
def op4_near_duplicates(spark, sf_dir):
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op5_license_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return licenses.license_report(documents, licenses.train(licenses.sample_paragraphs(documents)))


@query
def op6_piece_encoding(spark, sf_dir):
    return pieces.encoding_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op8_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return toxicity.scores(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


@query
def op9_hidden_markov(spark, sf_dir):
    return hmm.score(table(spark, sf_dir, "documents"))


@query
def op10_quality_rules(spark, sf_dir):
    return quality.quality_report(table(spark, sf_dir, "documents"))


@query
def op11_conversation_repair(spark, sf_dir):
    return repair.repaired(repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_token_counts(spark, sf_dir):
    return tokencounts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op13_periodic_runs(spark, sf_dir):
    return periodic.periodic_runs(table(spark, sf_dir, "documents"), plant=True)
