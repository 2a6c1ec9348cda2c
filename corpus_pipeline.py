"""From raw documents to token ids: five text operators one after another.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and read
again as the next stage's `docs`. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import uuid

from stocktide.llm import line_dedup, mixing, near_dedup, quality_rules
from stocktide.llm.common import table
from stocktide.llm.queries import encoded
from stocktide.session import delete_folder, released_tables, shared_folder

#: Pseudo-random rounding and byte-pair encoding have no SQL; the stages are tested against brute force.
ORACLE_SQL = None

#: Words of a shingle in the near-dedup stage; the four words of `op8_near_dedup` are that query's own.
SHINGLE = 5


def keep_good(spark, docs, sf_dir):
    """Quality rules: rejected documents go, the others lose their failing lines."""
    return quality_rules.cleaned(docs)


def drop_repeated_lines(spark, docs, sf_dir):
    """Line dedup: repeated runs of lines stay only at their first place; emptied documents go."""
    return line_dedup.cleaned(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Near dedup by shingles of five words: the document with the smallest id of each group stays."""
    return near_dedup.deduplicated(docs, SHINGLE)


def mix_sources(spark, docs, sf_dir):
    """Mixing: every document as often as its source's target asks for."""
    return mixing.mix(docs)


def encode(spark, docs, sf_dir):
    """Byte-pair encoding: ids (little-endian unsigned 32-bit integers) and the bytes they decode to."""
    return encoded(docs)


STAGES = [
    ("quality rules", keep_good),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte bpe", encode),
]


def run(spark, sf_dir):
    """All stages over `documents`, each one's result stored in the shared folder.

    What a stage stored for itself, and its input, are deleted once its result is written.
    """
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline/{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        with released_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        if i:
            delete_folder(spark, f"{folder}/{i - 1}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
