"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A document is the set of its distinct word shingles; its signature is 80 symbols of 16 bits, each a MinHash of the set.
Signatures are split into 16 chunks of 5 symbols. If two signatures differ in at most `DISTANCE` = 31
symbols, then by the pigeonhole principle some chunk differs in at most one. So every chunk is indexed
under the keys that leave one of its symbols out: signatures within the distance always share a key.
(A pair of similarity 0.8 lies beyond it with a chance of 3 in 100,000, and shares a key even then with
all but a 10^-9 part of that chance.)

What shares a key is decided exactly, on whole sets, without emitting all pairs of a key:

1. Documents of equal sets are one class, known by a number of its own, as one id may stand on rows of several
   texts; only its smallest id's text goes on.
2. In two rounds every document meets one centre, of those that its keys point to the one it shares most
   keys with. Linked ones grow together to components.
3. A shingle that no other candidate has can't be shared. Documents with too many of them
   to reach the similarity go out (again, once others have gone).
4. Of a key whose documents are not one component yet, those outside the largest component are compared with all
   documents around that component, block against block of some 64 sets, each by one product of incidence matrices
   inside a task. Only links leave the task.

Links are 100 * intersection >= 80 * union. Components come from minimum labels with pointer jumping over
stored tables. Hot keys and hub nodes meet in joins that adaptive execution splits.

Defined results: a text without words has an empty set and is linked with nothing; a text of fewer words
than a shingle has one shingle; equal rows are one class; a null `doc_id` is alone and kept; other columns
are carried by `deduplicated`.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import packed, row_key, ship, text_or_empty, unpacked
from stocktide.llm.grams import WHITE, Hasher
from stocktide.llm.sketches import SCHEMA, batches_of, set_hashes, shingle_sets, sketch_batches
from stocktide.session import cut_lineage, released_tables

WIDTH, PER_CENT = 4, 80
CHUNKS, CHUNK = 16, 5
DISTANCE = 2 * CHUNKS - 1
#: Sets compared with each other at once, on average.
BLOCK = 64
#: Shingles whose incidence is held as one matrix.
COLUMNS = 8192


def _keys(signature: Column) -> Column:
    """Keys of a signature: for each chunk, each way to leave one symbol out."""
    keys = []
    for c in range(CHUNKS):
        symbols = [F.substring(signature, 2 * (c * CHUNK + i) + 1, 2) for i in range(CHUNK)]
        for out in range(CHUNK):
            rest = [s for i, s in enumerate(symbols) if i != out]
            keys.append(F.xxhash64(F.lit(c * CHUNK + out), *rest))
    return F.array(*keys)


def _linked(common: Column, a: Column, b: Column, per_cent: int) -> Column:
    return common * 100 >= (a + b - common) * per_cent


def _sets(width: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = Hasher(WHITE)
        for batch in batches:
            for first, texts in batches_of(batch.column(1)):
                hashes, counts = shingle_sets(hasher, texts, width)
                ends = np.concatenate(([0], np.cumsum(counts))).astype("i4")
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes.view("i8")))
                # Every text here has words, so no set is empty.
                a, b = (pa.array(h.view("i8")) for h in set_hashes(hashes, ends[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), a, b, pa.array(counts, pa.int64()), lists],
                    names=["doc_id", "set_a", "set_b", "n_shingles", "set"],
                )

    return run


def _compare(per_cent: int):
    """Links between two blocks of sets: overlaps of all pairs from incidence matrices.

    Of the links of two blocks only as many are sent on as join the components that they join.
    """

    def spanning(a, b, i, j):
        import numpy as np

        pairs, first = np.unique(np.stack((a[1][i], b[1][j])), axis=1, return_index=True)
        root: dict[int, int] = {}

        def of(x: int) -> int:
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        kept = []
        for u, v, at in zip(*pairs.tolist(), first.tolist()):
            if of(u) != of(v):
                root[of(u)] = of(v)
                kept.append((int(a[0][i[at]]), int(b[0][j[at]])))
        return kept

    def incidence(which, owner, rows, low):
        import numpy as np

        matrix = np.zeros((rows, COLUMNS), np.float32)
        here = (which >= low) & (which < low + COLUMNS)
        matrix[owner[here], which[here] - low] = 1
        return matrix

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def flat(block):
            sets = [np.asarray(s, "i8") for s in block["set"]]
            sizes = np.array([len(s) for s in sets])
            return np.array(block["id"]), np.array(block["comp"]), sizes, np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)

        for batch in batches:
            found = []
            for row in range(batch.num_rows):
                one = batch.slice(row, 1)
                a = flat({k: one.column(f"a_{k}")[0].as_py() for k in ("id", "comp", "set")})
                b = flat({k: one.column(f"b_{k}")[0].as_py() for k in ("id", "comp", "set")})
                both = np.intersect1d(a[3], b[3])
                in_a, in_b = np.isin(a[3], both), np.isin(b[3], both)
                col_a, col_b = np.searchsorted(both, a[3][in_a]), np.searchsorted(both, b[3][in_b])
                common = np.zeros((len(a[0]), len(b[0])))
                for low in range(0, len(both), COLUMNS):
                    common += incidence(col_a, a[4][in_a], len(a[0]), low) @ incidence(col_b, b[4][in_b], len(b[0]), low).T
                union = a[2][:, None] + b[2][None, :] - common
                links = (common * 100 >= union * per_cent) & (a[1][:, None] != b[1][None, :])
                found += spanning(a, b, *np.nonzero(links))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """`id` and `comp`, the smallest id reachable, for every node of the links `u`, `v`."""
    links = cut_lineage(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut_lineage(links.groupBy(F.col("u").alias("id")).agg(F.least("u", F.min("v")).alias("comp")))
    while True:
        of = labels.select(F.col("id").alias("v"), F.col("comp").alias("of_v"))
        least = links.join(of, "v").groupBy(F.col("u").alias("id")).agg(F.min("of_v").alias("near"))
        near = labels.join(least, "id").select("id", "comp", F.least("comp", "near").alias("near"))
        step = labels.select(F.col("id").alias("near"), F.col("comp").alias("jump"))
        jumped = cut_lineage(near.join(step, "near").select("id", F.least("near", "jump").alias("next"), "comp"))
        if jumped.where("next <> comp").isEmpty():
            return labels
        labels = jumped.select("id", F.col("next").alias("comp"))


def _met(shared: DataFrame, sets: DataFrame, comps: DataFrame | None, pick, per_cent: int) -> DataFrame:
    """One round: each document against the centre it shares most keys with."""
    rows = _labelled(shared, comps)
    centre = rows.groupBy("key").agg(pick(F.struct("id", "comp")).alias("centre"))
    rows = rows.join(cut_lineage(centre), "key").where("comp <> centre.comp")
    votes = rows.groupBy("id", F.col("centre.id").alias("to")).agg(F.count("*").alias("n"))
    best = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("to")).alias("to"))).alias("b"))
    pairs = best.select("id", (-F.col("b.to")).alias("to"))
    to = sets.select(F.col("id").alias("to"), F.col("n").alias("n_to"), F.col("set").alias("set_to"))
    both = pairs.join(sets, "id").join(to, "to")
    common = F.size(F.array_intersect("set", "set_to"))
    return both.where(_linked(common, F.col("n"), F.col("n_to"), per_cent)).select(F.col("id").alias("u"), F.col("to").alias("v"))


def _labelled(shared: DataFrame, comps: DataFrame | None) -> DataFrame:
    if comps is None:
        return shared.withColumn("comp", F.col("id"))
    return shared.join(comps, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))


def _prune(sets: DataFrame, per_cent: int) -> DataFrame:
    """Sets without those of which too many shingles are in no other set."""
    single = sets.select("id", F.explode("set").alias("h")).groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("c"))
    own = single.where("c = 1").groupBy("id").agg(F.count("*").alias("own"))
    kept = sets.join(own, "id", "left")
    return cut_lineage(kept.where((F.col("n") - F.coalesce("own", F.lit(0))) * 100 >= F.col("n") * per_cent).select("id", "n", "set"))


def _rest(shared: DataFrame, sets: DataFrame, comps: DataFrame, per_cent: int) -> DataFrame:
    """Links across components that the rounds have not met, block against block."""
    rows = cut_lineage(_labelled(shared, comps))
    per_key = rows.groupBy("key", "comp").agg(F.count("*").alias("n"))
    main = per_key.groupBy("key").agg(F.max(F.struct("n", (-F.col("comp")).alias("c"))).alias("m"), F.count("*").alias("parts"))
    main = cut_lineage(main.where("parts > 1").select("key", (-F.col("m.c")).alias("main")))
    around = cut_lineage(rows.join(main, "key").select("main", "id", "comp").distinct())
    size = around.groupBy("main").agg(F.count("*").alias("size"), F.count(F.when(F.col("comp") != F.col("main"), 1)).alias("out"))
    held = around.join(cut_lineage(size), "main").join(sets, "id")

    def blocks(df: DataFrame, count: str, name: str) -> DataFrame:
        number = F.pmod(F.xxhash64(F.lit(name), "id"), F.ceil(F.col(count) / BLOCK))
        grouped = df.withColumn("block", number).groupBy("main", "block").agg(F.collect_list(F.struct("id", "comp", "set")).alias("x"))
        return grouped.select("main", *[F.col(f"x.{c}").alias(f"{name}_{c}") for c in ("id", "comp", "set")])

    outside = blocks(held.where("comp <> main"), "out", "a")
    pairs = outside.join(blocks(held, "size", "b"), "main").drop("main")
    return pairs.mapInArrow(_compare(per_cent), "u long, v long")


def _number(rep: Column, seed: int) -> Column:
    """A class's number, from its smallest id and its set.

    Numbers of ids from 0 below 2^40 ascend with them, as what came first is the likeliest centre of what is like it.
    """
    code = F.xxhash64(F.lit(seed), "set_a", "set_b", "n_shingles")
    in_order = F.shiftleft(rep, 23).bitwiseOR(code.bitwiseAND(F.lit((1 << 23) - 1)))
    return F.when((rep >= 0) & (rep < 1 << 40), in_order).otherwise(F.xxhash64(rep, code))


def _numbered(of_set: DataFrame) -> tuple[DataFrame, int]:
    """Classes with their numbers, and the first seed that gives no two of them the same one."""
    held, seed = cut_lineage(of_set, keep=True), 0
    while True:
        numbered = held.withColumn("id", _number(F.col("rep"), seed))
        if numbered.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return numbered, seed
        seed += 1


def classify(documents: DataFrame, width: int = WIDTH, per_cent: int = PER_CENT) -> DataFrame:
    """Per row of `documents` its `doc_id`, `n_shingles` and `component_id`."""
    with released_tables(documents.sparkSession):
        return _classified(documents, width, per_cent)


def _classified(documents: DataFrame, width: int, per_cent: int) -> DataFrame:
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sketched = cut_lineage(texts.mapInArrow(sketch_batches(width, CHUNKS * CHUNK), SCHEMA), keep=True)
    real = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["set_a", "set_b", "n_shingles"]
    of_set = real.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("signature").alias("signature"))
    classes, seed = _numbered(of_set)

    keyed = classes.select("id", F.explode(_keys(F.col("signature"))).alias("key"))
    several = cut_lineage(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    shared = cut_lineage(keyed.join(several, "key").select("key", "id"))
    candidates = cut_lineage(shared.select("id").distinct())
    wanted = cut_lineage(classes.join(candidates, "id", "left_semi").select("rep").distinct())
    chosen = texts.where(F.col("text").rlike(r"[^ \t-\r]")).join(wanted, texts["doc_id"] == wanted["rep"], "left_semi")
    found = chosen.mapInArrow(_sets(width), "doc_id long, set_a long, set_b long, n_shingles long, set array<long>")
    # A wanted id may stand on other texts as well, whose numbers are no candidate's.
    of_class = found.withColumn("id", _number(F.col("doc_id"), seed)).join(candidates, "id", "left_semi")
    sets = cut_lineage(of_class.select("id", F.col("n_shingles").alias("n"), "set").dropDuplicates(["id"]))
    for _ in range(2):
        sets = _prune(sets, per_cent)
    shared = cut_lineage(shared.join(sets.select("id"), "id").select("key", "id"))

    links = cut_lineage(_met(shared, sets, None, F.min, per_cent))
    comps = components(links)
    links = cut_lineage(links.unionByName(_met(shared, sets, comps, F.max, per_cent)))
    comps = components(links)
    more = cut_lineage(_rest(shared, sets, comps, per_cent))
    if not more.isEmpty():
        comps = components(links.unionByName(more))
    grouped = classes.join(comps, "id").select("id", "comp", "rep")
    least = grouped.groupBy("comp").agg(F.min("rep").alias("least"))
    named = cut_lineage(grouped.join(least, "comp").select("id", "least"), keep=True)

    reps = classes.join(named, "id", "left").select(*same, F.coalesce("least", "rep").alias("comp"))
    members = sketched.withColumn("_real", (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    found = members.join(reps, same, "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("_real"), F.col("comp")).otherwise(F.col("doc_id")).alias("component_id"))


def report(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """`classify` with `kept`: whether the row's id is its component's smallest."""
    return classify(documents, width).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents that stay, one of each component by shingles of `width` words, with all their columns.

    Rows without an id stay. Of rows with the same id and text one stays. Whole rows are joined with the ids that go
    or repeat, which are fewer than those that stay."""
    columns = documents.columns
    with released_tables(documents.sparkSession):
        per_id = report(documents.select("doc_id", "text"), width).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
        marks = per_id.agg(F.max("kept").alias("stays"), F.count("*").alias("n")).where("NOT stays OR n > 1")
        marks = cut_lineage(marks, keep=True)
    rows = packed(documents).withColumn("id", F.col("row.doc_id").cast("long")).join(marks, "id", "left")
    once = rows.where("n IS NULL OR (stays AND n = 1)")
    repeated = marks.where("stays AND n > 1")
    if repeated.isEmpty():
        return unpacked(once, columns)
    several = rows.where("stays AND n > 1").withColumn("key", row_key(F.col("id"), text_or_empty("row.text")))
    first = several.groupBy("id", "key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return unpacked(once.select("row").unionByName(first.select("row")), columns)


ship(__name__)
