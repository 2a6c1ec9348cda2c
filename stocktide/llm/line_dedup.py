"""Removal of repeated runs of lines by winnowing.

Lines are compared by the hash of their trimmed text; blank lines count as no lines. A gram is a line and as
many following ones as are needed for `NOISE` words. Of the grams that start within `RUN - NOISE` words
of any line the one with the smallest hash is a fingerprint. So any run of whole lines with `RUN` or more words that
stands in two places has a fingerprint in common, whatever surrounds it, and nothing shorter than
`NOISE` words is ever matched.

Fingerprints meet by hash. Each later place is compared with the first one: the match is extended line
by line to both sides, as far as the lines carried along reach: `RUN` words before the gram, and as many after the
end of its first line. A run that goes on further has a later fingerprint within that reach, however long its lines are. Where
that first place lacks part of a run of `RUN` words or more around the gram, the later places meet once more, by the
hash of the whole run, for each line that it can end with. The lines of the match are deleted at the later place, so
the first place of every text stays.

A fingerprint in a third of all documents is one row per place: the first place is found by an
aggregate that combines before the shuffle, and the join back is one that adaptive execution splits.

Defined results: places are ordered by `doc_id` (null first), content and position; rows of equal content are
one document listed more than once and lose the same lines; a null text stays null; other columns are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import packed, quoted, row_key, text_or_empty, words_of
from stocktide.session import cut_lineage

#: Words that a repeated run needs to be found for certain, and below which nothing is matched.
RUN, NOISE = 50, 25


def _key(prefix: str = "") -> Column:
    doc, text = F.col(f"{prefix}doc_id").cast("long"), text_or_empty(f"{prefix}text")
    return row_key(doc, text)


def fingerprints(documents: DataFrame, run: int = RUN, noise: int = NOISE) -> DataFrame:
    """Winnowed grams: hash, place, and the line hashes and positions to both sides."""
    lines = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"),
        F.posexplode(F.split(text_or_empty(), "\n")).alias("pos", "line"),
    )
    lines = lines.select(
        "doc_id", "key", "pos", F.xxhash64(F.regexp_replace("line", r"\A[ \t-\r]+|[ \t-\r]+\z", "")).alias("h"),
        F.size(words_of(F.col("line"))).alias("w"),
    ).where("w > 0")
    # Rows of equal content come once: their lines are the same places.
    once = lines.groupBy("key", "pos").agg(F.first("doc_id").alias("doc_id"), F.first("h").alias("h"), F.first("w").alias("w"))
    doc = Window.partitionBy("key")
    before = doc.orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    # Frames count a line as `longest` words at most. Those of grams and of their choice are too short for that to matter;
    # those to both sides reach past a long line as past a short one.
    longest = max(noise, run - noise + 1)

    def words_before(w: Column) -> Column:
        return F.coalesce(F.sum(w).over(before), F.lit(0)).cast("long")

    placed = once.withColumns({"s": words_before(F.col("w")), "c": words_before(F.least("w", F.lit(longest)))})
    by_word = doc.orderBy("c")
    gram = by_word.rangeBetween(0, noise - 1)
    here = F.struct("h", "pos", "s", "w")
    grams = placed.withColumns(
        {
            "gram": F.xxhash64(F.collect_list("h").over(gram)),
            "words": F.sum("w").over(gram),
            "left": F.collect_list(here).over(by_word.rangeBetween(-run, -1)),
            "right": F.collect_list(here).over(by_word.rangeBetween(0, run + longest - 1)),
        }
    ).where(F.col("words") >= noise)
    least = F.min(F.struct("gram", "pos")).over(by_word.rangeBetween(0, run - noise))
    chosen = grams.withColumn("least", least)
    picked = F.array_contains(F.collect_set("least").over(by_word.rangeBetween(-(run - noise), 0)), F.struct("gram", "pos"))
    return chosen.withColumn("picked", picked).where("picked").select(
        "gram", "doc_id", "key", "pos", F.reverse("left").alias("left"), "right"
    )


def _alike(mine: Column, first: Column) -> Column:
    """Number of leading entries with the same line hash."""
    same = F.zip_with(mine, first, lambda a, b: a["h"].eqNullSafe(b["h"]))
    end = F.array_position(same, False)
    return F.when(end > 0, end - 1).otherwise(F.size(mine)).cast("int")


def _uncovered(run: int, noise: int) -> Column:
    """Hashes of the runs of `run` words or more around a gram that its match with the first place does not hold whole.

    A run is found by its last line that starts `run` words before its end or earlier, so it ends less than
    `run` words after that line; of those that end later, the shortest is enough."""
    start = F.get("right", F.lit(0))["s"]

    def stretches(i: Column) -> Column:
        line = F.when(i > 0, F.get("left", i - 1)).otherwise(F.get("right", F.lit(0)))

        def ends(x: Column) -> Column:
            """Numbers of lines of `right` that a run from line `x` on can have."""
            full, last = x["s"] + run, x["s"] + x["w"] + run
            numbered = F.transform("right", lambda r, j: F.struct((j + 1).alias("n"), r["s"].alias("s"), (r["s"] + r["w"]).alias("e")))
            found = F.filter(numbered, lambda r: (r["e"] >= full) & ((r["s"] < full) | (r["e"] < last)))
            # At the end of a text there are fewer words.
            return F.when(F.size(found) > 0, found["n"]).otherwise(F.array(F.size("right")))

        def content(n: Column) -> Column:
            lines = F.concat(F.slice("left", F.lit(1), i), F.slice("right", F.lit(1), n))
            return F.xxhash64(i, F.transform(lines, lambda r: r["h"]))

        def missing(x: Column) -> Column:
            return F.filter(ends(x), lambda n: (i > F.col("same_left")) | (n > F.col("same_right")))

        near = F.filter(F.array(line), lambda x: start - x["s"] <= run - noise)
        return F.flatten(F.transform(near, lambda x: F.transform(missing(x), content)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size("left")), stretches))


def _met(places: DataFrame, keys: list[str]) -> DataFrame:
    """Later places of the same keys with the number of lines, `same_left` and `same_right`, that the first place has too."""
    place = F.struct("doc_id", "key", "pos")
    firsts = places.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min(F.struct(place.alias("place"), "left", "right")).alias("first")
    )
    firsts = cut_lineage(firsts.where("n > 1"))
    later = places.join(firsts, keys).where(~place.eqNullSafe(F.col("first.place")))
    return later.select(
        "gram", "n", "doc_id", "key", "pos", "left", "right",
        _alike(F.col("left"), F.col("first.left")).alias("same_left"),
        _alike(F.col("right"), F.col("first.right")).alias("same_right"),
    )


def repeated_lines(documents: DataFrame, run: int = RUN, noise: int = NOISE) -> DataFrame:
    """`key` of a document and the sorted positions `lines` that repeat an earlier place."""
    found = cut_lineage(fingerprints(documents, run, noise))
    met = cut_lineage(_met(found, ["gram"]))
    # The first place of a gram may lack what later ones share around it: those meet by the whole run.
    apart = met.where("n > 2").select(
        "gram", F.explode(_uncovered(run, noise)).alias("stretch"), "doc_id", "key", "pos", "left", "right"
    )
    matches = met.unionByName(_met(cut_lineage(apart), ["gram", "stretch"]))
    deleted = F.concat(
        F.slice("left", F.lit(1), F.col("same_left")), F.slice("right", F.lit(1), F.col("same_right"))
    )
    marks = matches.select("key", F.explode(deleted["pos"]).alias("pos")).distinct()
    return marks.groupBy("key").agg(F.sort_array(F.collect_list("pos")).alias("lines"))


def deduplicated(documents: DataFrame, run: int = RUN, noise: int = NOISE) -> DataFrame:
    """All rows as struct `row`, with `text` as it is left, `n_lines`, `n_removed` and `emptied`."""
    marks = cut_lineage(repeated_lines(documents.select("doc_id", "text"), run, noise))
    rows = packed(documents).withColumn("key", _key("row."))
    # Marks grow with the rows: one plan at every size, which spills and splits hot keys, and no broadcast of them.
    joined = rows.join(marks.hint("merge"), "key", "left")
    lines = F.split(F.col("row.text").cast("string"), "\n")
    kept = F.array_except(F.transform(lines, lambda _, i: i), F.col("lines"))
    left = F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col("lines").isNull(), F.col("row.text")).otherwise(left)
    removed = F.coalesce(F.size("lines"), F.lit(0))
    return joined.select(
        "row", text.alias("text"), F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.greatest(removed, F.lit(0)).cast("long").alias("n_removed"),
    ).withColumn("emptied", (F.col("n_removed") > 0) & ~F.col("text").rlike(r"[^ \t-\r]"))


def report(documents: DataFrame) -> DataFrame:
    """Per document `doc_id`, its lines, how many were removed, and what is left."""
    return deduplicated(documents.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "emptied", "text"
    )


def cleaned(documents: DataFrame) -> DataFrame:
    """The documents without repeated runs; those of which nothing is left go. All columns stay."""
    rows = deduplicated(documents).where("NOT emptied")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[new.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in documents.columns])
