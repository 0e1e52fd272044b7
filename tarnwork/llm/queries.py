"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tarnwork.llm import chat, decontam, htmltext, importance, langid, lm, mtree, packing, sharding, simhash, suffix, tokens, trie
from tarnwork.llm.registry import ORACLES, QUERIES, query

__all__ = ["ORACLES", "QUERIES"]


@query("op1_token_counts")
def op1(t):
    return tokens.token_counts(t.documents)


@query("op2_decontaminate", decontam.SQL)
def op2(t):
    return decontam.contaminated(t.documents, t.benchmark)


@query("op3_pack")
def op3(t):
    return packing.pack_documents(t.documents)


@query("op4_suffix_dedup")
def op4(t):
    return suffix.remove_repeats(t.documents)


@query("op5_html_text")
def op5(t):
    return htmltext.extract_pages(t.pages, ["page_id", "url"])


@query("op6_top_k")
def op6(t):
    return mtree.top_k(t.embeddings)


@query("op7_lm_score")
def op7(t):
    return lm.score_documents(t.documents)


@query("op8_simhash")
def op8(t):
    return simhash.near_duplicates(t.documents)


@query("op9_language")
def op9(t):
    docs = t.documents.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    profiles = langid.fit_profiles(docs.filter("NOT held_out"))
    return langid.predict(docs, profiles, ["doc_id", "held_out"])


@query("op10_hilbert_shards")
def op10(t):
    return sharding.shard_documents(t.documents)


@query("op11_importance", importance.SQL)
def op11(t):
    found = importance.importance(t.documents, t.benchmark, ["doc_id"])
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


@query("op12_chat_format", chat.SQL)
def op12(t):
    return chat.format_conversations(t.conversations)


@query("op13_prefix_trie", trie.SQL)
def op13(t):
    return trie.prefix_trie(t.conversations)
