"""Operators whose result follows from one row, or from the rows' order, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import regex

from stocktide.llm import bpe, fingerprints, license_scan, preference, quality_rules, token_files, warc_store
from stocktide.llm.queries import BYTE_JSON, BYTE_RANKS, END_ID, pretoken_pattern, tokenizer

tiktoken = pytest.importorskip("tiktoken")
pytest.importorskip("public_tokenizers")
WORD = re.compile("[^\x20\x09-\x0d]+")


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r[:2]))


@pytest.fixture(scope="module")
def codec():
    return bpe.BytePairCodec(bpe.read_ranks(tokenizer(BYTE_RANKS)), pretoken_pattern())


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("t", pat_str=pretoken_pattern(), mergeable_ranks=codec.ranks, special_tokens={})


def test_bpe_equals_the_library_on_random_text(codec, library):
    parts = ["a", "the ", " ", "  ", "\n", " \n", "\t", "é", "ß", "12", "'s", "'", "!", "***", "日本", "aaaa", "😀", "\r\n", "\x1c", "\x85"]
    r = random.Random(1)
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert list(memoryview(codec.encode(text)).cast("I")) == library.encode_ordinary(text), repr(text)


def test_bpe_of_long_pretokens(codec, library):
    r = random.Random(2)
    for text in ("a" * 5000, " " * 3000, "ab" * 2000, "é" * 1000, "".join(r.choice("abeorstin") for _ in range(20000))):
        assert list(memoryview(codec.encode(text)).cast("I")) == library.encode_ordinary(text)


def test_pairs_fit_exactly_if_merging_keeps_them(codec):
    r = random.Random(3)
    tokens = [t for t in r.sample(sorted(codec.ranks), 400) if codec.merged(t) == [t]] + [b"a" * n for n in (1, 2, 3, 4) if b"a" * n in codec.ranks]
    for _ in range(4000):
        a, b = r.choice(tokens), r.choice(tokens)
        assert codec.fits(codec.ranks[a], codec.ranks[b]) == (codec.merged(a + b) == [a, b])


def test_bpe_query(documents, rows, library, odd, nothing):
    encode = lambda d: bpe.digests(bpe.encode_documents(d, tokenizer(BYTE_RANKS), pretoken_pattern()))
    want = []
    for i, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want.append((i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert collected(encode(documents)) == sorted(want)
    assert encode(odd).count() == 4 and encode(nothing).count() == 0


def test_token_files(documents, rows, odd, nothing, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer(BYTE_JSON))

    def written(d):
        return token_files.read_dataset(token_files.write_dataset(d, str(tmp_path), tokenizer(BYTE_JSON), END_ID))

    want, start = [], 0
    for i, text, _ in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, END_ID]
        want.append((i, start, len(ids), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))))
        start += len(ids)
    assert sorted(tuple(r) for r in written(documents).collect()) == sorted(want)
    found = written(odd).collect()
    assert sorted(r.start for r in found)[0] == 0 and [r.doc_id for r in found].count(None) == 2
    assert written(nothing).count() == 0


def brute_quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_quality_base(documents, rows, odd, nothing):
    found = quality_rules.score(documents).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert collected(found) == sorted((i, *brute_quality(t)) for i, t, _ in rows)
    assert quality_rules.score(odd).count() == 4 and quality_rules.score(nothing).count() == 0


def test_lines_fail_first_then_documents(spark):
    good = "This is a plain line of some length that ends as lines do."
    cases = {
        good: True, "Home | Products | About | Contact": False, "All rights reserved.": False, "### *** ### *** ###": False,
        "read more ...": False, "Menu": False, "Yes.": True, "two words": False, "a line of four": True,
    }
    rows = [(i, "\n".join([f"Some other words open this text, number {i}, before it.", "So there is enough to keep.", line])) for i, line in enumerate(cases)]
    found = {r.doc_id: r for r in quality_rules.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (line, stays) in enumerate(cases.items()):
        assert (found[i].n_bad_lines == 0) == stays, line
        assert found[i].kept and (line in found[i].cleaned.split("\n")) == stays
    menus = [
        "Home", "Startseite", "Zum Inhalt springen", "Accueil et services", "Rechercher un article", "Inicio", "Iniciar sesión aquí mismo",
        "Wir sagen es so: Alle Rechte vorbehalten von uns.", "Ce site utilise des cookies pour vous servir.",
        "Este sitio utiliza cookies para servirle mejor.", "TOUS DROITS RÉSERVÉS à la maison.", "Ver la Política de privacidad de la casa.",
    ]
    prose_lines = [
        "Die Suchenden kamen spät nach Hause und fanden die Tür offen.", "Iniciado el viaje, nadie quiso volver.",
        "Les accueillir fut un plaisir pour nous tous.", "Homeward they went, all of them.", "Weiterhin gilt, was gestern galt.",
    ]
    body = "Some other words open this text before it.\nSo there is enough to keep of it all.\n"
    given = spark.createDataFrame([(i, body + x) for i, x in enumerate(menus + prose_lines)], "doc_id long, text string")
    bad = {r.doc_id: r.n_bad_lines for r in quality_rules.score(given).collect()}
    for i, line in enumerate(menus + prose_lines):
        assert bad[i] == (1 if i < len(menus) else 0), line
    mostly_menu = "\n".join(["Home | Shop | Login | Search | Help | Imprint"] * 4 + ["One line of prose with ten words that does stay here."])
    kept = quality_rules.score(spark.createDataFrame([(1, mostly_menu.replace("Help", "H"))], "doc_id long, text string")).first()
    assert not kept.kept


def test_cleaned_keeps_all_columns(documents):
    found = quality_rules.cleaned(documents)
    assert found.columns == documents.columns
    assert all(r.n_chars == len(r.text) and r["size"] == 1 and r["row"] == "r" for r in found.collect())


def test_edited_texts_and_fingerprints(documents, rows, odd, nothing, spark):
    found = fingerprints.compare_edits(documents).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    want = []
    for k, (i, text, _) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        want.append((i, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    long_ones = [r for r in found if r.n_chars > 600 and r.near_next < 0.5]
    assert sum(r.near_edited for r in long_ones) > 5 * sum(r.near_next for r in long_ones)
    by_text = {}
    for r in found:
        by_text.setdefault(dict((a, b) for a, b, _ in rows)[r.doc_id] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert fingerprints.compare_edits(odd).count() == 4 and fingerprints.compare_edits(nothing).count() == 0
    one = fingerprints.compare_edits(spark.createDataFrame([(1, "a line")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_fingerprints_add_up_in_any_order(spark):
    a, b = "First paragraph, with a comma. And more.", "Second paragraph; other words."
    texts = [(1, a), (2, b), (3, f"{a}\n{b}"), (4, f"{b}\n{a}")]
    made = fingerprints.vectors(spark.createDataFrame(texts, "id long, text string"), ["id"]).collect()
    by = {r.id: r for r in made}
    for c in fingerprints.ENTRIES:
        assert by[1][c] + by[2][c] == by[3][c] == by[4][c]


def test_license_scan(documents, rows, odd, nothing):
    word = regex.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    want = []
    for i, text, _ in rows:
        words = word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        hits = [
            (at, label) for phrase, label in license_scan.PHRASES.items()
            for at in range(len(words)) if words[at : at + len(phrase.split())] == phrase.split()
        ]
        places = [a for a, _ in hits]
        want.append((i, len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits}))))
    found = license_scan.scan(documents)
    assert collected(found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) == sorted(want)
    labels = [r.labels for r in found.where("n_base > 2").collect()]
    assert labels and all({"mit", "mit-line", "gpl", "cc-by"} <= set(x.split(",")) for x in labels)
    assert license_scan.scan(odd).count() == 4 and license_scan.scan(nothing).count() == 0


def test_notice_with_words_put_in(spark):
    words = license_scan.NOTICES["mit-text"][0].split()
    words[12:12] = ["certain"]
    text = "before it " * 50 + " ".join(words) + " after it" * 50
    found = license_scan.scan(spark.createDataFrame([(1, text), (2, "any person obtaining a copy of it")], "doc_id long, text string"))
    got = {r.doc_id: r for r in found.collect()}
    assert got[1].labels == "mit-text" and 0.6 <= got[1].score < 1 and got[2].labels == "" and got[2].score == 0


def test_license_bodies_and_relatives(spark):
    filler = "some words before it " * 30
    texts, want = [], []
    for label, passages in license_scan.NOTICES.items():
        for passage in passages:
            texts.append(f"{filler}{passage} {filler}")
            want.append(label)
    body = " ".join(license_scan.NOTICES["mit-text"][1:])  # without its opening words
    texts += [body, " ".join(p for v in license_scan.NOTICES.values() for p in v), filler]
    found = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    got = {r.doc_id: set(r.labels.split(",")) - set(license_scan.PHRASES.values()) for r in found.collect()}
    extra = {"apache-2.0-notice": {"apache-2.0-line"}}  # the notice opens with the line
    for i, label in enumerate(want):
        assert label in got[i] and got[i] <= {label, *extra.get(label, set())}, (label, got[i], texts[i][len(filler):][:80])
    assert got[len(want)] == {"mit-text"} and set(license_scan.NOTICES) - got[len(want) + 1] == set() and got[len(want) + 2] == {""}


def test_warc_round_trip(spark, tmp_path):
    pages = [(5, "u5", "<p>a</p>"), (2, "u\r\n2", "<p>a</p>"), (9, None, None), (1, "u1", ""), (4, "u4", "é"), (None, "n", "<p>a</p>"), (5, "u5", "<p>a</p>")]
    table = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, payload string")
    archive = warc_store.write_archive(table, str(tmp_path))
    records = warc_store.read_records(archive)
    found = collected(warc_store.describe(records).drop("header_agrees"))
    import base64

    want = []
    for i, _, html in pages:
        body = (html or "").encode()
        first = min(p for p, _, h in pages if (h or "") == (html or "") and p is not None)
        later = i != first
        want.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if later else "response", first if later else None))
    assert found == sorted(want, key=lambda r: tuple((x is not None, x) for x in r[:2]))
    assert archive.payloads().count() == 3
    whole = records.select(warc_store.record_bytes(records["header"], records["payload"]).alias("r"), "page_id").collect()
    assert all(bytes(r.r).startswith(b"WARC/1.1\r\nWARC-Type: ") and bytes(r.r).endswith(b"\r\n\r\n") for r in whole)
    least = warc_store.write_archive(table, str(tmp_path), least_bytes=1)
    kinds = {r.page_id: r.record_type for r in warc_store.describe(warc_store.read_records(least)).collect()}
    assert kinds[9] == kinds[1] == "response"
    assert warc_store.describe(warc_store.read_records(warc_store.write_archive(table.limit(0), str(tmp_path)))).count() == 0


def test_a_changed_payload_is_noticed(spark, tmp_path):
    archive = warc_store.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), str(tmp_path))
    spark.createDataFrame([(bytearray(hashlib.sha256(b"abc").digest()), bytearray(b"abd"))], warc_store.PAYLOADS).write.mode("overwrite").parquet(f"{archive.folder}/payloads")
    assert [r.verified for r in warc_store.read_records(archive).collect()] == [False]
    with pytest.raises(Exception, match="doesn't match its address"):
        warc_store.describe(warc_store.read_records(archive)).collect()


def test_preference_pairs(spark):
    turns = [
        (0, 0, "system", "S"), (0, 1, "user", "Q"), (0, 2, "assistant", "good"), (1, 0, "system", "S"), (1, 1, "user", "Q"),
        (1, 2, "assistant", "bad"), (1, 3, "user", None), (1, 4, "assistant", "worse"), (2, 0, "user", "alone"),
        (4, 0, "user", "A"), (5, 0, "user", "A"), (None, 0, None, "lost"), (4, None, None, None), (5, None, None, None),
    ]
    table = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, pair long")
    found = {r.pair: r for r in preference.format_pairs(preference.paired_by_number(table)).collect()}
    assert set(found) == {0, 1, 2, None}
    first = found[0]
    assert first.prompt == "<|im_start|>system\nS<|im_end|>\n<|im_start|>user\nQ<|im_end|>\n" and first.prompt_turns == 2
    assert [first.chosen.text[s.start : s.end] for s in first.chosen.spans] == ["good<|im_end|>\n"]
    assert [first.rejected.text[s.start : s.end] for s in first.rejected.spans] == ["bad<|im_end|>\n", "worse<|im_end|>\n"]
    assert found[1].prompt == "" and found[1].rejected.text == "" and "alone" in found[1].chosen.text
    assert found[2].prompt_turns == 2 and found[2].chosen.text == found[2].rejected.text == ""
    assert found[None].chosen_id is None and "lost" in found[None].chosen.text
    assert preference.format_pairs(preference.paired_by_number(table.limit(0))).count() == 0
