"""Repair of conversations by the cheapest edits, found with a checkpointed dynamic program.

A repaired conversation has the roles `(system? (user assistant)+)?`. Edits walk over its rows in order:
Keep (free), Rerole to user or assistant (3), Delete (4), and Insert of a user or assistant row with empty
text, anywhere (3). A blank row (no character but space and `\\t` to `\\r`) and a duplicate (its role and text
stood earlier in the conversation) must go; a truncated row (its last character that isn't blank is none of
`.!?`) costs 3 more if it stays. In each of the four states of the role pattern an edit's letter has one
outcome, so the letters alone spell a repair, and of all cheapest ones that with the ASCII-least letters is taken.

Costs-to-go come from the back: a vector of four numbers per row, of which only every `sqrt(n)`-th is
stored. Walking forward, each block's vectors are computed again from its stored end and dropped
after the block, so a conversation of n rows holds one byte a row and some 2 sqrt(n) vectors.

Spark does the rest: rows without their texts are sorted in ranges, not by conversation, so a long one is
spread over many tasks; duplicates are found by joining the first place of each repeated (role, text); runs of
rows become one byte a row, the only thing that a conversation's program reads. Texts are shuffled
once, after the program, and stream past the edits.

Defined results: null roles and texts are one space, so a null text is blank; a null `conv_id` is a
conversation; a null turn comes first and doesn't count for gaps; rows of equal turn follow each other by role
and a hash of the text; of equal rows all but one are duplicates; roles other than
system, user and assistant are known by their first letter (s, u, a), all others must be reroled or deleted;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import ship
from stocktide.session import cut_lineage, released_tables

REROLE, DELETE, INSERT, KEPT_TRUNCATED = 3, 4, 3, 3
#: Role classes and faults, two bits each of a row's byte.
OTHER, SYSTEM, USER, ASSISTANT = range(4)
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: States: nothing yet, after a system row, after a user row, after an assistant row. Where an inserted or
#: reroled row leads to from each, and where a kept one does by its class.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
NEXT = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
KEEP = {(START, SYSTEM): AFTER_SYSTEM, **{(q, USER if to == AFTER_USER else ASSISTANT): to for q, to in enumerate(NEXT)}}
NEVER = 1 << 60
#: Costs-to-go behind the last row: a conversation may end empty or after an assistant row.
END = (0, 6, 3, 0)
#: Marks of edits: inserted user and assistant, deleted, kept, reroled to user and assistant.
INSERTED, REROLED, AUDIT = {AFTER_USER: "U", AFTER_ASSISTANT: "A"}, {AFTER_USER: "u", AFTER_ASSISTANT: "a"}, "IIDKRR"
MARKS = "UAdkua"
NAMES = {"u": "user", "a": "assistant"}
ILLEGAL_NOT = frozenset([(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)])
BLANKS = r"[ \t-\r]"
BATCH = 2000
ORDER = ["conv_id", "turn", "role", "text_a", "text_b"]


def _steps() -> tuple:
    """Per row byte and state, the edits (mark, target state, cost) that take the row, in letter order."""
    table = []
    for code in range(16):
        role, fault = code & 3, code >> 2
        must_go, extra = fault in (BLANK, DUPLICATE), KEPT_TRUNCATED if fault == TRUNCATED else 0
        per_state = []
        for q in range(4):
            edits = [("d", q, DELETE)]
            if not must_go:
                if (q, role) in KEEP:
                    edits.append(("k", KEEP[q, role], extra))
                edits.append((REROLED[NEXT[q]], NEXT[q], REROLE + extra))
            per_state.append(tuple(edits))
        table.append(tuple(per_state))
    return tuple(table)


STEPS = _steps()


def before(code: int, after: tuple) -> tuple:
    """Costs-to-go in front of a row from those behind it: edits of the row, then inserts ahead of it."""
    v = [min([cost + after[to] for _, to, cost in STEPS[code][q]]) for q in range(4)]
    for _ in range(2):  # two inserts in a row reach every state that a third could
        v = [min(v[q], INSERT + v[NEXT[q]]) for q in range(4)]
    return tuple(v)


def solve(codes: bytes) -> tuple[int, str]:
    """Least cost, and the marks of the cheapest edits whose letters are ASCII-least."""
    n = len(codes)
    block = isqrt(max(0, n - 1)) + 1
    stored, v = {n: END}, END
    for i in range(n - 1, -1, -1):
        v = before(codes[i], v)
        if i % block == 0:
            stored[i] = v
    cost, q, marks = v[START], START, []
    for low in range(0, n, block):
        high = min(low + block, n)
        vectors = [stored[high]]
        for i in range(high - 1, low - 1, -1):
            vectors.append(before(codes[i], vectors[-1]))
        for i in range(low, high):
            now, after = vectors[high - i], vectors[high - i - 1]
            q = _walk(codes[i], q, now, after, marks)
    while q not in (START, AFTER_ASSISTANT):  # rows are over: only inserts are left
        q = NEXT[q]
        marks.append(INSERTED[q])
    return cost, "".join(marks)


def _walk(code: int, q: int, now: tuple, after: tuple, marks: list) -> int:
    """Append the least marks that keep the cost, up to the one that takes the row; return the new state."""
    while True:
        (mark, to, cost), *others = STEPS[code][q]  # Delete has the least letter
        if cost + after[to] == now[q]:
            marks.append(mark)
            return to
        if INSERT + now[NEXT[q]] == now[q]:
            q = NEXT[q]
            marks.append(INSERTED[q])
            continue
        for mark, to, cost in others:
            if cost + after[to] == now[q]:
                marks.append(mark)
                return to
        raise AssertionError("costs-to-go and edits disagree")


def rows_of(conversations: DataFrame) -> DataFrame:
    """`conv_id`, `turn`, `role`, `text` with nulls of the last two spelled as a space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role"), spaced("text"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults planted by crc32(`conv_id:turn`) % 20, to measure repairs on.

    0 drops the row, 1 empties its text, 2 takes `.!?` out of it, 3 repeats it, 4 makes it a user's; all others stay.
    """
    spelled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spelled("conv_id"), F.lit(":"), spelled("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    made = rows_of(conversations).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copies")
    )
    return made.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).drop("copy", "copies")


def _hashed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"text_a": F.xxhash64("text"), "text_b": F.xxhash64(F.lit("second"), "text")})


def _nulls_first(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]


def _codes(rows: DataFrame) -> DataFrame:
    """`place`, `conv_id`, `turn`, `code` of every row; places ascend in the order of conversations and rows."""
    first = F.substring("role", 1, 1)
    role = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    stripped = F.regexp_replace("text", f"{BLANKS}++$", "")
    fault = F.when(stripped == "", BLANK).when(~F.substring(stripped, -1, 1).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    narrow = _hashed(rows).select(*ORDER, role.alias("class"), fault.alias("fault"))
    # The last key parts even a large group of equal rows, which are interchangeable.
    keys = [*_nulls_first(ORDER), "tie"]
    ranged = narrow.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut_lineage(ranged.drop("tie").withColumn("place", F.monotonically_increasing_id()))
    same = ["conv_id", "role", "text_a", "text_b"]
    firsts = placed.groupBy(*same).agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    firsts = firsts.select("first", *[F.col(c).alias(f"_{c}") for c in same])
    near = F.col("conv_id").eqNullSafe(F.col("_conv_id"))
    for c in same[1:]:
        near = near & (F.col(c) == F.col(f"_{c}"))
    again = (F.col("place") > F.col("first")) & (F.col("fault") != BLANK)
    fault = F.when(F.coalesce(again, F.lit(False)), DUPLICATE).otherwise(F.col("fault"))
    return placed.join(firsts, near, "left").select(
        "place", "conv_id", "turn", (F.col("class") + 4 * fault).cast("int").alias("code")
    )


def _runs(batches: Iterator) -> Iterator:
    """One row per run of rows of a conversation in a partition: its first place, bytes and turns."""
    import numpy as np
    import pyarrow as pa

    schema = pa.schema([
        ("conv_id", pa.int64()), ("place", pa.int64()), ("codes", pa.binary()), ("first_turn", pa.int64()),
        ("last_turn", pa.int64()), ("turns", pa.int64()),
    ])
    for batch in batches:  # a run that spans batches becomes two
        if not batch.num_rows:
            continue
        conv = batch.column(1)
        null, ids = conv.is_null().to_numpy(zero_copy_only=False), conv.fill_null(0).to_numpy(zero_copy_only=False)
        codes = batch.column(3).to_numpy(zero_copy_only=False).astype("u1")
        turns = batch.column(2).to_pylist()
        places = batch.column(0).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])])
        rows = []
        for low, high in zip(starts, [*starts[1:], batch.num_rows]):
            known = [t for t in turns[low:high] if t is not None]  # ascending
            distinct = sum(1 for a, b in zip(known, known[1:]) if a != b) + bool(known)
            rows.append((
                None if null[low] else int(ids[low]), int(places[low]), codes[low:high].tobytes(),
                known[0] if known else None, known[-1] if known else None, distinct,
            ))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _solved(batches: Iterator) -> Iterator:
    """Counts, cost and marks of every conversation, from its runs in order."""
    import pyarrow as pa

    schema = pa.schema([
        ("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
        ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("marks", pa.string()),
    ])
    for batch in batches:
        rows = []
        for conv, runs in zip(batch.column(0), batch.column(1)):
            pieces = runs.as_py()
            codes = b"".join(p["codes"] for p in pieces)
            known = [p for p in pieces if p["turns"]]
            gaps = 0
            if known:
                shared = sum(1 for a, b in zip(known, known[1:]) if a["last_turn"] == b["first_turn"])
                gaps = known[-1]["last_turn"] - known[0]["first_turn"] + 1 - sum(p["turns"] for p in known) + shared
            faults = [sum(codes.count(4 * f + r) for r in range(4)) for f in range(4)]
            illegal = sum(1 for a, b in zip(codes, codes[1:]) if (a & 3, b & 3) not in ILLEGAL_NOT)
            rows.append((conv.as_py(), gaps, faults[BLANK], faults[DUPLICATE], faults[TRUNCATED], illegal, *solve(codes)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def solved(rows: DataFrame) -> DataFrame:
    """Per conversation its counts of faults, the least cost and the marks of its edits (`MARKS`)."""
    with released_tables(rows.sparkSession):
        runs = _codes(rows).repartitionByRange("place").sortWithinPartitions("place").mapInArrow(
            _runs, "conv_id long, place long, codes binary, first_turn long, last_turn long, turns long"
        )
        run = F.struct("place", "codes", "first_turn", "last_turn", "turns")
        together = runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(run)).alias("runs"))
        return cut_lineage(together.mapInArrow(
            _solved, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, marks string"
        ), keep=True)


def audit(marks: Column) -> Column:
    """The edits' initials: Delete, Insert, Keep, Rerole."""
    return F.translate(marks, MARKS, AUDIT)


def _stream(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Edits of each conversation and behind them its rows in order, for one pass over each partition."""
    head = edits.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("marks").alias("text"))
    both = head.unionByName(rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text"))
    sort = ["conv_id", "kind", *ORDER[1:]]
    return _hashed(both).repartition("conv_id").sortWithinPartitions(*_nulls_first(sort)).select("conv_id", "kind", "role", "text")


def _edited(batches: Iterator) -> Iterator:
    """(conv_id, edit letter, role, text) of all rows that a repair leaves; (conv_id, None, ..) starts a conversation."""
    conv, marks, at = None, "", 0
    for batch in batches:
        for conv_id, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                while at < len(marks):  # inserts behind the last row of the conversation before
                    yield conv, "I", NAMES[marks[at].lower()], ""
                    at += 1
                conv, marks, at = conv_id, text, 0
                yield conv, None, "", ""
                continue
            while marks[at] in "UA":
                yield conv, "I", NAMES[marks[at].lower()], ""
                at += 1
            mark, at = marks[at], at + 1
            if mark == "k":
                yield conv, "K", role, text
            elif mark in NAMES:
                yield conv, "R", NAMES[mark], text
    while at < len(marks):
        yield conv, "I", NAMES[marks[at].lower()], ""
        at += 1


def _repaired_rows(batches: Iterator) -> Iterator:
    import pyarrow as pa

    names, held, no = ["conv_id", "no", "role", "text", "edit"], [], 0
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for conv, edit, role, text in _edited(batches):
        if edit is None:
            no = 0
            continue
        held.append((conv, no, role, text, edit))
        no += 1
        if len(held) >= BATCH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


def _digests(batches: Iterator) -> Iterator:
    import hashlib

    import pyarrow as pa

    held, conv, digest, empty = [], None, None, True

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.string())], names=["conv_id", "sha"]
        )

    for now, edit, role, text in _edited(batches):
        if edit is None:
            if digest:
                held.append((conv, digest.hexdigest()))
                if len(held) >= BATCH:
                    yield sent()
                    held = []
            conv, digest, empty = now, hashlib.sha256(), True
            continue
        digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
        empty = False
    if digest:
        held.append((conv, digest.hexdigest()))
        yield sent()


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: `conv_id`, `no` from 0, `role`, `text` and the `edit` that left the row (K, R or I)."""
    rows = rows_of(conversations)
    return _stream(rows, solved(rows)).mapInArrow(_repaired_rows, "conv_id long, no long, role string, text string, edit string")


def report(conversations: DataFrame) -> DataFrame:
    """Per conversation its faults, the least cost, the edits' initials and the digest of the repaired rows.

    A digest of a whole conversation is made by one stream of its rows, in bounded memory.
    """
    rows = rows_of(conversations)
    found = solved(rows)
    digests = _stream(rows, found).mapInArrow(_digests, "_conv_id long, repaired_sha256 string")
    return found.join(digests, found["conv_id"].eqNullSafe(digests["_conv_id"])).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", audit(F.col("marks")).alias("audit"), "repaired_sha256"
    )


def report_of_damaged(conversations: DataFrame) -> DataFrame:
    """`report` on the `damaged` rows, with a row also for each conversation that has none left."""
    found = report(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(found, ids["_id"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


ship(__name__)
