"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fptree, maxscore, minhash, mixing, packing, pii, quality_model, quality_rules, simhash, substring_dedup, token_counts, token_store, turn_trie
from .encoding import public_path
from .oracles import ORACLES  # noqa: F401  the queries DuckDB can compute too; tests/llm holds the others against plain versions


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "documents")


def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_pii(_documents(spark, sf))


def op2_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, sf), public_path("word_bpe_49k.json"), 2048)


def op3_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.fingerprint_edits(_documents(spark, sf))


def op4_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return quality_model.score(docs, quality_model.fit(docs, _table(spark, sf, "labels")))


def op5_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, sf), ["doc_id"])
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf)).select("doc_id", "size", "source_size", "target", "taken")


def op7_token_store(spark: SparkSession, sf: str) -> DataFrame:
    return token_store.stored_documents(_documents(spark, sf), public_path("byte_bpe_50k.json"), 2)


def op8_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cut = substring_dedup.drop_repeated(_documents(spark, sf))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_documents(spark, sf), public_path("word_bpe_49k.json"), 0, 2048)


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_lexical_search(spark: SparkSession, sf: str) -> DataFrame:
    return fptree.ranked_search(_documents(spark, sf), _table(spark, sf, "benchmark"))


def op12_turn_trie(spark: SparkSession, sf: str) -> DataFrame:
    return turn_trie.prefix_trie(_table(spark, sf, "conversations"))


def op13_vector_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return maxscore.exact_top_k(_table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES = {f.__name__: f for f in (op1_pii, op2_token_counts, op3_fingerprints, op4_quality_model, op5_quality_rules, op6_mixing,
                                   op7_token_store, op8_substring_dedup, op9_packing, op10_simhash, op11_lexical_search, op12_turn_trie, op13_vector_top_k)}
