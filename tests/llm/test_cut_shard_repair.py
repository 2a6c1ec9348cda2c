"""Fill-in-middle, hash-tree sharding and conversation repair against plain Python."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stocktide.llm import conversation_repair as repair
from stocktide.llm import fill_middle, sharding


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def cut(doc_id, text):
    text, h = text or "", hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(text), sha(text))
    if h4 % 100 < 20:
        out, form = f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}", "spm"
    else:
        out, form = f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}", "psm"
    return (doc_id, n, form, a, b - a, sha(out), sha(text))


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_fill_middle(spark, documents, odd, nothing, rows):
    got = rows_of(fill_middle.digests(fill_middle.transformed(documents)))
    assert got == sorted((cut(i, t) for i, t, _ in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert rows_of(fill_middle.digests(fill_middle.transformed(odd))) == sorted([cut(None, None), cut(None, "some words here"), cut(7, None), cut(7, None)], key=repr)
    assert fill_middle.transformed(nothing).count() == 0


def test_fill_middle_of_long_and_odd_texts(spark):
    texts = ["😀é\n" * 700_000, "<S" * 9000 + "<", "a <M> b", "$1\\2" * 5000, "<P", "\x00\r\n " * 3000, "x" * fill_middle.BLOCK, "y" * (fill_middle.BLOCK * 3 + 1)]
    frame = spark.createDataFrame([(i, t) for t in texts for i in range(6)], "doc_id long, text string")
    assert rows_of(fill_middle.digests(fill_middle.transformed(frame))) == sorted((cut(i, t) for t in texts for i in range(6)), key=repr)


@pytest.mark.parametrize("unit", [fill_middle.WORD, fill_middle.LINE])
def test_other_units_and_markers(spark, documents, unit):
    markers = fill_middle.Markers("$pre\\", "[suf]", "(mid")
    made = fill_middle.transformed(documents, unit, seed=5, markers=markers)
    back = made.select("doc_id", "n", "form", "prefix_units", "middle_units", fill_middle.restored(F.col("output"), F.col("form"), markers).alias("t"), "output")
    want = {r.doc_id: r.text or "" for r in documents.collect()}
    for r in back.collect():
        units = re.findall(r"\s*\S+|\s+" if unit == fill_middle.WORD else r"[^\n]*\n|[^\n]+", want[r.doc_id], re.ASCII)
        assert r.t == want[r.doc_id] and r.n == len(units)
        if r.form == "psm":
            a, b = r.prefix_units, r.prefix_units + r.middle_units
            assert r.output == "$pre\\" + "".join(units[:a]) + "[suf]" + "".join(units[b:]) + "(mid" + "".join(units[a:b])


def descend(key, topology):
    def weights(i, among):
        found = defaultdict(float)
        for s in among:
            found[s[i]] += s.weight
        return found

    def choose(level, children):
        def score(c):
            bits = int(hashlib.md5(f"1:{level}:{c}:{'' if key is None else key}".encode()).hexdigest()[:13], 16)
            return math.log((bits + 0.5) / 2**52) / children[c]

        return max(sorted(children), key=score)

    region = choose("region", weights(2, topology))
    rack = choose("rack", weights(1, [s for s in topology if s.region == region]))
    return choose("shard", weights(0, [s for s in topology if s.rack == rack]))


def test_sharding(spark, documents, odd, nothing, rows):
    for frame, given in ((documents, rows), (odd, [(None, None, None), (None, "some words here", "s"), (7, None, None), (7, None, None)])):
        got = sharding.assign(frame).collect()
        want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), descend(i, sharding.layout(16)), descend(i, sharding.layout(17))) for i, t, _ in given]
        assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in got), key=repr) == sorted(want, key=repr)
        inside = defaultdict(list)
        for r in got:
            assert r.law == "key" and r.grown_shard in (r.shard, 16)
            inside[r.shard].append((r.slot, (r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size)))
        for found in inside.values():
            found.sort()
            assert [s for s, _ in found] == list(range(len(found))) and [k for _, k in found] == sorted(k for _, k in found)
    assert sharding.assign(nothing).count() == 0


def test_one_more_shard_and_larger_weights_move_little(spark):
    keys = spark.range(20000).select(F.col("id").alias("k"))
    for n in (1, 16, 17, 20):
        was, now = sharding.layout(n), sharding.layout(n + 1)
        moved = keys.select(sharding.shard_of(F.col("k"), was).alias("a"), sharding.shard_of(F.col("k"), now).alias("b")).where("a <> b")
        assert {r.b for r in moved.select("b").distinct().collect()} == {n}
        assert abs(moved.count() - 20000 / (n + 1)) < 5 * math.sqrt(20000 / (n + 1))
    was = sharding.layout(16)
    now = [s._replace(weight=3.0) if s.shard == 5 else s for s in was]
    of = {s.shard: s for s in was}
    both = keys.select(sharding.shard_of(F.col("k"), was).alias("a"), sharding.shard_of(F.col("k"), now).alias("b")).collect()
    counts = defaultdict(int)
    for r in both:
        counts[r.b] += 1
        a, b = of[r.a], of[r.b]
        if a.region != b.region:
            assert b.region == of[5].region  # into the region whose weight grew
        elif a.rack != b.rack:
            assert b.rack == of[5].rack
        elif a.shard != b.shard:
            assert b.shard == 5
    assert abs(counts[5] - 20000 * 3 / 18) < 300
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("k"), [])
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("k"), [sharding.Shard(0, 0, 0), sharding.Shard(1, 0, 1)])


def cheapest(rows):
    """Least (cost, letters) over all edits of up to six rows of (initial, fault), by enumeration."""
    best = None

    def finish(cost, letters, roles):
        nonlocal best
        if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, letters) < best):
            best = (cost, letters)

    def go(i, cost, letters, roles):
        if best and cost > best[0]:
            return
        for n in range(3):
            for new in itertools.product("ua", repeat=n):
                c, l, r = cost + 3 * n, letters + "I" * n, roles + "".join(new)
                if i == len(rows):
                    finish(c, l, r)
                    continue
                initial, fault = rows[i]
                go(i + 1, c + 4, l + "D", r)
                if fault not in ("blank", "duplicate"):
                    extra = 3 * (fault == "truncated")
                    go(i + 1, c + extra, l + "K", r + initial)
                    for role in "ua":
                        go(i + 1, c + extra + 3, l + "R", r + role)

    go(0, 0, "", "")
    return best


def test_solver_against_enumeration():
    r, faults = random.Random(4), ["", "blank", "duplicate", "truncated"]
    for _ in range(400):
        rows = [(r.choice("xsuuaa"), r.choice(faults + [""] * 4)) for _ in range(r.randrange(5))]
        codes = bytes("xsua".index(c) + 4 * faults.index(f) for c, f in rows)
        cost, marks = repair.solve(codes)
        assert (cost, marks.translate(str.maketrans(repair.MARKS, repair.AUDIT))) == cheapest(rows)


def report(given):
    """Plain Python of the whole report; `given` holds (conv_id, turn, role, text)."""
    out, groups = [], defaultdict(list)
    for conv, turn, role, text in given:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        groups[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for conv, rows in groups.items():
        rows.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        turns = {t for t, _, _ in rows if t is not None}
        seen, marked = set(), []
        for _, role, text in rows:
            body = text.rstrip(" \t\n\v\f\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role[:1] if role[:1] in ("s", "u", "a") else "x", fault))
        faults = [f for _, f in marked]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        faults_of = ["", "blank", "duplicate", "truncated"]
        codes = bytes("xsua".index(c) + 4 * faults_of.index(f) for c, f in marked)
        cost, marks = repair.solve(codes)
        lines, at = [], 0
        for m in marks:
            if m in "UA":
                lines.append({"U": "user:", "A": "assistant:"}[m])
                continue
            role, text = rows[at][1:]
            at += 1
            if m != "d":
                lines.append({"k": role, "u": "user", "a": "assistant"}[m] + ":" + text)
        letters = marks.translate(str.maketrans(repair.MARKS, repair.AUDIT))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, letters, sha("\n".join(lines))))
    return sorted(out, key=repr)


def conversations(spark):
    r = random.Random(9)
    roles, ends = ["system", "user", "assistant", "user", "assistant", "tool", "", None], [".", "!", "?", "", " \n", ","]
    rows = []
    for conv in [*range(40), None]:
        turn = 0
        for _ in range(r.randrange(1, 14)):
            turn += r.choice([1, 1, 1, 2])
            text = r.choice([None, "", " \t", "same text."] + [f"t{r.randrange(10**6)} é😀{r.choice(ends)}" for _ in range(9)])
            rows.append((conv, turn if r.random() < 0.95 else None, r.choice(roles), text))
    rows = list({(c, t, role): (c, t, role, x) for c, t, role, x in rows}.values())  # no ties but planted ones
    rows += [(77, i, ("user", "assistant", "user")[i % 3], f"turn {i // 2}.") for i in range(3000)]  # a long one
    rows += [(78, 5, "user", "again and again.")] * 50
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, "clash", 1) for x in rows], "conv_id long, turn long, role string, text string, marks string, place long")


def test_repair(spark):
    rows = conversations(spark)
    table = frame(spark, rows).repartition(7)
    got = sorted(map(tuple, repair.report_of_damaged(table).collect()), key=repr)
    assert got == report(rows)
    fixed = repair.repaired(table).orderBy("conv_id", "no").collect()
    roles = defaultdict(str)
    for x in fixed:
        roles[x.conv_id] += x.role[:1]
    assert all(re.fullmatch("s?(ua)+", x) for x in roles.values())
    assert repair.report_of_damaged(table.limit(0)).count() == 0 and repair.repaired(table.limit(0)).count() == 0


def test_conversation_without_rows_left(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:1".encode()) % 20 == 0)
    got = repair.report_of_damaged(frame(spark, [(gone, 1, "user", "hi.")])).collect()
    assert [tuple(x) for x in got] == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
