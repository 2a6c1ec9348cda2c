"""Registered queries of the text operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from stocktide.llm import (
    bpe, conversation_repair, fill_middle, fingerprints, license_scan, line_dedup, mixing, near_dedup, preference,
    quality_rules, sharding, token_files, warc_store,
)
from stocktide.llm.common import table
from stocktide.session import shared_folder

BYTE_RANKS, BYTE_JSON, END_ID = "byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", 2


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encoded(documents):
    return bpe.encode_documents(documents, tokenizer(BYTE_RANKS), pretoken_pattern())


def _byte_bpe(spark, folder):
    return bpe.digests(encoded(table(spark, folder, "documents")))


def _preference(spark, folder):
    pairs = preference.format_pairs(preference.paired_by_number(table(spark, folder, "conversations")))
    return pairs.select(
        "pair", "chosen_id", "rejected_id", "prompt_turns", "prompt",
        F.col("chosen.text").alias("chosen"), preference.spelled_spans(F.col("chosen.spans")).alias("chosen_spans"),
        F.col("rejected.text").alias("rejected"), preference.spelled_spans(F.col("rejected.spans")).alias("rejected_spans"),
    )


def _quality(spark, folder):
    found = quality_rules.score(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_bad_lines",
    )


def _token_files(spark, folder):
    manifest = token_files.write_dataset(
        table(spark, folder, "documents"), f"{shared_folder(spark).rstrip('/')}/token_files",
        tokenizer(BYTE_JSON), END_ID,
    )
    return token_files.read_dataset(manifest)


def _warc(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    archive = warc_store.write_archive(pages, f"{shared_folder(spark).rstrip('/')}/warc")
    return warc_store.describe(warc_store.read_records(archive))


def _mix(spark, folder):
    return mixing.copies(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def queries():
    return {
        "op1_byte_bpe": _byte_bpe,
        "op2_preference_pairs": _preference,
        "op3_quality_rules": _quality,
        "op4_fingerprints": lambda s, f: fingerprints.compare_edits(table(s, f, "documents")),
        "op5_token_files": _token_files,
        "op6_line_dedup": lambda s, f: line_dedup.report(table(s, f, "documents")),
        "op7_warc_store": _warc,
        "op8_near_dedup": lambda s, f: near_dedup.report(table(s, f, "documents")),
        "op9_license_scan": lambda s, f: license_scan.scan(table(s, f, "documents")),
        "op10_mixing": _mix,
        "op11_fill_middle": lambda s, f: fill_middle.digests(fill_middle.transformed(table(s, f, "documents"))),
        "op12_hash_tree_shards": lambda s, f: sharding.assign(table(s, f, "documents")),
        "op13_conversation_repair": lambda s, f: conversation_repair.report_of_damaged(table(s, f, "conversations")),
    }


def oracle_sql():
    from stocktide.llm import oracles

    return oracles.statements()
