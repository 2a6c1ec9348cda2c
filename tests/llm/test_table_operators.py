"""Operators that compare documents with each other, against plain Python, and the pipeline."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from stocktide.llm import line_dedup, mixing, near_dedup
from tests.llm.conftest import BASE, PASSAGE, edited, prose, table

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else ({tuple(words)} if words else set())


def brute_components(rows):
    sets = {i: shingles(t) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_near_dedup(documents, rows, odd, nothing):
    want = brute_components(rows)
    found = near_dedup.report(documents).collect()
    assert len(found) == len(rows)
    assert all((r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in found)
    assert near_dedup.report(odd).count() == 4 and near_dedup.report(nothing).count() == 0


def test_the_pipeline_takes_shingles_of_five_words(spark):
    import corpus_pipeline

    words = [f"w{i}" for i in range(42)]
    # 35 of 43 shingles of four words, but 33 of 43 of five.
    docs = table(spark, [(1, " ".join(words), "s"), (2, " ".join(words[:20] + ["new"] + words[21:]), "s"), (3, " ".join(words), "s")])
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, None).collect()) == [1, 2]
    assert [r.doc_id for r in near_dedup.deduplicated(docs).collect()] == [1]


def test_a_group_around_the_limit(spark):
    """Many copies, some linked to few others only: what the rounds miss the blocks must find."""
    rows = [(1000 - i, edited(BASE, 50 + i, 1 + i % 6), "s") for i in range(150)]
    rows += [(2000 + i, edited(prose(200 + i // 3, 60, 5000), i, 2), "s") for i in range(60)]
    want = brute_components(rows)
    found = near_dedup.report(table(spark, rows).repartition(7)).collect()
    assert [(r.doc_id, r.n_shingles, r.component_id) for r in found if (r.n_shingles, r.component_id) != want[r.doc_id]] == []
    assert len({r.component_id for r in found}) > 21


def test_near_dedup_keeps_one_of_each_group(documents, rows, odd):
    found = near_dedup.deduplicated(documents)
    assert found.columns == documents.columns
    want = brute_components(rows)
    assert {r.doc_id for r in found.collect()} == {i for i, (_, c) in want.items() if i == c}
    assert near_dedup.deduplicated(odd).where("doc_id IS NULL").count() == 2


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    copy = prose(7, 40, 3000)
    rows = [(5, copy, "a"), (5, copy, "a"), (5, copy, "b"), (9, copy, "a"), (6, "", "a"), (6, "", "a"), (7, None, "c"), (8, "", "c")]
    found = near_dedup.deduplicated(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in found) == [5, 6, 7, 8]
    again = near_dedup.deduplicated(table(spark, rows[::-1])).collect()
    assert {(r.doc_id, r.source) for r in found} == {(r.doc_id, r.source) for r in again}


def brute_repeats(rows):
    """Lines that must go: later whole-line repeats of 50 words and more; and those that may go."""
    seen, must = set(), defaultdict(set)
    for i, text in sorted({(i, t or "") for i, t, _ in rows}):
        for n, line in enumerate(text.split("\n")):
            words = len(WORD.findall(line))
            if words >= 50 and line.strip() in seen:
                must[i].add(n)
            seen.add(line.strip())
    return must


def test_line_dedup(documents, rows, odd, nothing):
    found = {r.doc_id: r for r in line_dedup.report(documents).collect()}
    texts = {i: t for i, t, _ in rows}
    must, first = brute_repeats(rows), {}
    for i in sorted(found):
        lines, left = (texts[i] or "").split("\n"), (found[i].text or "").split("\n")
        for line in lines:
            if WORD.search(line) and first.setdefault(line.strip(), i) == i:
                assert line in left
        for n in must[i]:
            assert lines.count(lines[n]) > left.count(lines[n])
    assert any(r.emptied for r in found.values())
    assert sum(PASSAGE in (r.text or "") for r in found.values()) == 1
    assert line_dedup.report(odd).count() == 4 and line_dedup.report(nothing).count() == 0


def test_runs_of_short_lines(spark):
    lines = [f"short line number {i} of the passage" for i in range(12)]  # 7 words each
    rows = [(1, "\n".join(["before one", *lines, "after one"])), (2, "\n".join(["x", "", *lines[:6], "", *lines[6:], "y z"])),
            (3, "\n".join(lines[:3] + ["own text"] + lines[9:]))]
    found = {r.doc_id: r.text for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1] == rows[0][1]
    assert [x for x in found[2].split("\n") if x] == ["x", "y z"]
    assert found[3] == rows[2][1]  # runs of 21 words are too short


def test_runs_whose_middle_stands_earlier_alone(spark):
    def line(k, part, n):
        return " ".join(f"{part}{k}n{i}" for i in range(n))

    rows, expected = [], {}
    for k in range(8):
        before, middle, after = line(k, "b", 13), line(k, "m", 25), line(k, "a", 13)
        rows += [
            (3 * k, f"alone {k}\n{middle}"), (3 * k + 1, "\n".join([before, middle, after])),
            (3 * k + 2, "\n".join([f"other {k}", before, middle, after, f"end {k}"])),
        ]
        expected[3 * k], expected[3 * k + 2] = rows[-3][1], f"other {k}\nend {k}"
    found = {r.doc_id: r.text for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: found[i] for i in expected} == expected
    assert all(found[3 * k + 1].startswith(f"b{k}n0 ") for k in range(8))


def test_runs_that_end_behind_a_long_line(spark):
    def text(k, *sizes):
        return [" ".join(f"{k}l{n}w{i}" for i in range(size)) for n, size in enumerate(sizes)]

    rows, expected = [], {}

    def add(lines, left=None):
        rows.append((len(rows), "\n".join(lines)))
        expected[len(rows) - 1] = rows[-1][1] if left is None else "\n".join(left)

    for k, sizes in enumerate([(77, 2), (100, 8), (9, 100, 8), (3, 60, 24, 24, 1), (100, 20, 20, 9, 100, 1)]):
        whole = text(f"copy{k}", *sizes)
        add(whole)
        add(whole, [])
        add([f"other {k}", *whole, f"end {k}"], [f"other {k}", f"end {k}"])
    for k, sizes in enumerate([(100, 8), (100, 20, 20, 9, 100, 1), (13, 80, 7, 5)]):
        whole = text(f"alone{k}", *sizes)
        long = max(whole, key=len)
        add([f"alone {k}", long])
        add([f"held {k}", *whole], [f"held {k}", *[x for x in whole if x != long]])
        add([f"again {k}", *whole, f"end {k}"], [f"again {k}", f"end {k}"])
    found = {r.doc_id: r.text for r in line_dedup.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == expected


def test_line_dedup_drops_emptied_documents(documents):
    found = line_dedup.cleaned(documents)
    assert found.columns == documents.columns
    assert sum(r.text == BASE for r in found.collect()) == 1


def brute_targets(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    stopped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(3 * sizes[s] for s in stopped)
        open_ = sum(weight[s] for s in names if s not in stopped)
        share = rest / open_ if open_ else 0
        over = {s for s in names if s not in stopped and share * weight[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    return {s: (sizes[s], 3.0 * sizes[s] if s in stopped else share * weight[s]) for s in names}


def mixture(spark):
    rows = [(i, prose(i, 3 + i % 40), ["big", "b", "c", None, "tiny"][0 if i % 3 else i % 5]) for i in range(900)]
    return rows + [(5000, prose(1, 5000), "big")], None


def test_mixing(spark):
    rows, _ = mixture(spark)
    docs = table(spark, rows).repartition(6)
    found = mixing.copies(docs).collect()
    again = mixing.copies(table(spark, rows[::-1]).repartition(3)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, found)) == sorted(map(key, again)) and len(found) == len(rows)
    want, source_of, taken = brute_targets(rows), {i: s for i, _, s in rows}, Counter()
    for r in found:
        size, target = want[source_of[r.doc_id]]
        assert r.source_size == size and r.target == pytest.approx(target) and r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[source_of[r.doc_id]] += r.taken
    for source, (size, target) in want.items():
        assert abs(taken[source] - target) <= max(50, 0.05 * target)


def test_copies_are_unbiased(spark):
    rows = [(i, prose(i, 10), "a" if i < 400 else "b") for i in range(600)]
    docs = table(spark, rows)
    hits = Counter()
    for seed in range(4):
        hits.update({r.doc_id: r.copies for r in mixing.copies(docs, seed=seed).collect()})
    halves = [sum(hits[i] for i in range(400) if i % 2 == k) for k in (0, 1)]
    assert abs(halves[0] - halves[1]) < 0.2 * sum(halves)


def test_mix_repeats_rows(documents, rows, odd, nothing):
    chosen = Counter()
    for r in mixing.copies(documents).collect():
        chosen[r.doc_id] += r.copies
    mixed = mixing.mix(documents)
    assert mixed.columns == documents.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +chosen
    assert mixing.copies(odd).count() == 4 and mixing.copies(nothing).count() == 0 and mixing.mix(nothing).count() == 0


def test_pipeline(spark, documents, rows, tmp_path):
    documents.drop("size", "row", "key").write.parquet(f"{tmp_path}/documents.parquet")
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "mixing", "byte bpe"]
    texts = [bytes(r.decoded).decode() for r in final]
    assert texts and "###" not in "".join(texts)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
    assert Counter(r.doc_id for r in docs.collect()) == Counter(r.doc_id for r in final)
