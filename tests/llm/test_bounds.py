"""Results at the edges: workers without the library, ids with several texts, very long texts, small sources."""

import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stocktide.llm import fingerprints, mixing, near_dedup, token_files, warc_store
from stocktide.llm.queries import BYTE_JSON, END_ID, tokenizer
from tests.llm.conftest import prose, table

ROOT = Path(__file__).resolve().parents[2]
ALONE = """
import sys
sys.path.insert(0, {root!r})
from stocktide.llm import bpe, conversation_repair, near_dedup, token_files
from stocktide.llm.queries import BYTE_JSON, BYTE_RANKS, END_ID, pretoken_pattern, tokenizer
from stocktide.session import build_session
spark = build_session("alone", master="local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.checkpoint.dir": {shared!r}}})
probe = spark.range(1).mapInArrow(lambda batches: __import__("stocktide"), "id long")
try:
    probe.collect()
    raise SystemExit("workers do find the library")
except Exception as error:
    assert "No module named 'stocktide'" in str(error), error
docs = spark.createDataFrame([(1, "some words here"), (2, None)], "doc_id long, text string")
assert bpe.digests(bpe.encode_documents(docs, tokenizer(BYTE_RANKS), pretoken_pattern())).count() == 2
assert token_files.read_dataset(token_files.write_dataset(docs, {shared!r}, tokenizer(BYTE_JSON), END_ID)).count() == 2
assert near_dedup.report(docs).count() == 2
turns = spark.createDataFrame([(1, 1, "user", "Hi."), (1, 2, "assistant", "Yes.")], "conv_id long, turn long, role string, text string")
assert conversation_repair.report(turns).first().audit == "KK"
print("all ran")
"""


def test_workers_need_no_copy_of_the_library(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", ALONE.format(root=str(ROOT), shared=str(tmp_path))], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]


def test_ids_are_the_library_s_for_every_kind_of_space_and_for_added_tokens():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer(BYTE_JSON))
    encoder = token_files.LibraryEncoder(Path(tokenizer(BYTE_JSON)).read_text(encoding="utf-8"), END_ID)
    parts = ["a", "the ", " ", "  ", "\n", " \n", "\t", "é", "ß", "12", "'s", "'", "!", "***", "日本", "aaaa", "😀", "\r\n", "\x1c", "\x85",
             "　", "\xa0", " ", " x", "<|endoftext|>", "<|endof", "text|>", "\x00", "—", "\x7f"]
    r = random.Random(1)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 16))) for _ in range(4000)] + ["", "a" * 20000, " " * 5000, "a <|endoftext|> b"]
    for at in range(0, len(texts), 400):
        some = texts[at : at + 400]
        ids, counts = encoder([t.encode() for t in some])
        assert len(counts) == len(some)
        for text, n in zip(some, counts):
            assert ids[:n].tolist() == [*library.encode(text, add_special_tokens=False).ids, END_ID], repr(text)
            ids = ids[n:]


def test_words_are_encoded_once_whatever_mark_follows_and_outlive_a_full_memory(monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer(BYTE_JSON))
    encoder = token_files.LibraryEncoder(Path(tokenizer(BYTE_JSON)).read_text(encoding="utf-8"), END_ID)
    asked, whole = [], encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda texts: asked.extend(texts) or whole(texts))
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 3)
    texts = ["so stürmische nächte", "so stürmische. so nächte, so stürmische***", "so nächté; so stürmische! it's stürmische's 5%, a.b×. 2÷?", "so nächte", "so stürmische"]
    for text in texts:
        ids, counts = encoder([text.encode()])
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, END_ID] and counts.tolist() == [len(ids)]
    assert "".join(asked).count(" stürmische") == 2  # alone, and once as the beginning of another cut
    assert encoder([])[1].tolist() == [] and encoder([b"", b""])[0].tolist() == [END_ID, END_ID]


def test_token_files_of_one_id_on_many_rows(spark, tmp_path):
    rows = [(7, f"text number {i} " * (i % 5)) for i in range(300)] + [(None, "x")] * 40 + [(1, "a <|endoftext|> b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    manifest = token_files.write_dataset(docs, str(tmp_path), tokenizer(BYTE_JSON), END_ID)
    found = sorted(token_files.read_dataset(manifest).collect(), key=lambda r: r.start)
    assert len(found) == len(rows) and [r.doc_id for r in found] == [None] * 40 + [1] + [7] * 300
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:])) and found[0].start == 0
    assert found[40].ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in (64, 220, 50256, 275, END_ID)))
    assert manifest.count() > 1  # rows of one id are parted
    assert token_files.read_dataset(manifest).rdd.getNumPartitions() > 1


@pytest.mark.parametrize("turned", [False, True])
def test_ids_with_several_texts_keep_all_links(spark, turned):
    a, b = prose(1, 80, 3000), prose(2, 80, 3000)
    rows = [(1, a, "s"), (1, b, "s"), (2, b + " z", "s"), (3, a + " z", "s"), (4, prose(3, 80, 3000), "s")]
    found = near_dedup.report(table(spark, rows[::-1] if turned else rows).coalesce(1)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_likeness_of_very_long_texts(spark):
    n = (1 << 20) + 60000
    made = spark.createDataFrame([(2,), (1,)], "doc_id long").withColumn("text", F.repeat(F.when(F.col("doc_id") == 2, "a,").otherwise("b,"), n))
    found = fingerprints.compare_edits(made).collect()
    assert all(r.near_next < 0.01 for r in found) and len({r.fingerprint for r in found}) == 2


def test_fingerprints_follow_edits(spark):
    texts = {1: "First line, here.\nSecond line.\nThird line, too.", 2: "Second line.", 3: "New line; more.", 4: "Third line, too.\nNew line; more.\nFirst line, here."}
    made = fingerprints.vectors(spark.createDataFrame(sorted(texts.items()), "id long, text string"), ["id"])
    of = {i: made.where(f"id = {i}").select(F.struct(*fingerprints.ENTRIES).alias(f"v{i}")) for i in texts}
    rows = of[1].crossJoin(of[2]).crossJoin(of[3]).crossJoin(of[4])  # four single rows
    side = lambda i: (lambda c: F.col(f"v{i}.{c}"))
    less = rows.select(F.struct(*fingerprints.remove(side(1), side(2))).alias("v1"), "v3", "v4")
    more = less.select(F.struct(*fingerprints.add(side(1), side(3))).alias("v1"), "v4")
    assert more.select((fingerprints.spelled(side(1)) == fingerprints.spelled(side(4))).alias("same")).first().same


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_small_sources_come_near_their_targets(spark, seed):
    r = random.Random(40 + seed)
    rows = [(i, prose(i, int(min(20000, r.lognormvariate(5.0, 1.3))) + 1), f"s{i % 20:02d}") for i in range(1000)]
    found = mixing.copies(table(spark, rows).repartition(5), seed=seed).collect()
    source_of, taken, target, sizes = {i: s for i, _, s in rows}, Counter(), {}, {}
    for x in found:
        s = source_of[x.doc_id]
        taken[s] += x.taken
        target[s] = x.target
        sizes.setdefault(s, []).append(x["size"])
    for s, n in sizes.items():
        n.sort(reverse=True)
        # The stated bound: a hundredth of the source, or a document that all smaller ones can't balance.
        bound = max([sum(n) / mixing.LARGE] + [w for i, w in enumerate(n) if w > sum(n[i + 1 :])])
        assert abs(taken[s] - target[s]) <= bound, (s, taken[s], target[s], bound)


def test_headers_hold_what_the_format_asks_for(spark, tmp_path):
    pages = [(5, "u5", "<p>a</p>"), (2, "u2", "<p>a</p>"), (5, "u5", "<p>a</p>"), (None, "n", "<p>a</p>"), (None, "n", "<p>a</p>"), (9, "u9", "x" * 3_000_000)]
    when = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    archive = warc_store.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path), written=when)
    headers = [bytes(r.header).decode() for r in archive.headers().collect()]
    ids = [re.search(r"\r\nWARC-Record-ID: (<urn:page:[^>]+>)\r\n", h)[1] for h in headers]
    assert len(set(ids)) == len(pages)
    assert all("\r\nWARC-Date: 2024-05-06T07:08:09Z\r\n" in h and "\r\nContent-Type: text/html; charset=utf-8\r\n" in h for h in headers)
    refers = {m[1] for h in headers if (m := re.search(r"\r\nWARC-Refers-To: (<[^>]+>)\r\n", h))}
    first = [i for i, h in zip(ids, headers) if ":2:" in i]
    assert refers == set(first)


def test_a_header_with_another_digest_is_noticed(spark, tmp_path):
    archive = warc_store.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), str(tmp_path))
    records = warc_store.read_records(archive)
    wrong = F.encode(F.regexp_replace(F.decode("header", "UTF-8"), "sha1:..", "sha1:AA"), "UTF-8")
    with pytest.raises(Exception, match="header's digest"):
        warc_store.describe(records.withColumn("header", wrong)).collect()
