"""Mixing sources to target weights by pivotal dependent rounding of copy numbers.

Every document of a source should appear `target / source size` times, at most `MOST` times. The
whole part of that number is copied outright; the fraction is rounded dependently: two documents
are paired and words (fraction x size) are moved at random from one to the other until the fraction of
one of them is 0 or 1, with the chances that keep each document's expected number. The sum of words
never changes, so of all documents of a source only the very last one, which has no partner left, moves
the total, by less than its own size.

Documents above a `LARGE`-th of their source (fewer than `LARGE` of them) go first, in descending size, each
paired with all smaller ones of the source together, large or not. Where those can balance it only one way, it
goes that way (nearness to the target comes before chance here); where they can't balance it at all, which
takes a document larger than all smaller ones together, they end whole and it is the last one without a
partner. So a total misses its target by less than a `LARGE`-th of its source, or than such a document.

The pairs form a reduction tree: hashed blocks of about `BLOCK` documents of a source are folded in one
group each, the one undecided document of every block goes to the next level, and so on until one is
left. A source with a third of all rows is simply more blocks. What a level decides is stored, so a
lost executor never changes an outcome; chances come from hashes of the rows, so reruns agree.

Defined results: a null text has size 0; a null source is one source and ranks last; rows of equal
content are interchangeable; a source of size 0, and an empty table, get no words; other columns
are carried by `mix` and ignored by `copies`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import bind, packed, row_key, text_or_empty, unpacked, words_of
from stocktide.operators.ranking import with_row_number
from stocktide.session import cut_lineage, released_tables

WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MOST = 3
#: Documents folded together, on average.
BLOCK = 256
#: Fractions this near to 0 or 1 are taken for whole numbers.
NEAR = 1e-9
#: A document of more than this part of its source is decided before the others.
LARGE = 100


def sources(units: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Per source its number of documents, size, weight and target.

    Weights repeat along the sources in code-point order, null last. Targets share the whole size by
    weight; a source that would be above `most` times its size stops there and its excess is shared
    anew. Each round stops at least one source, usually all that will ever stop in two or three.
    """
    found = units.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum("size").cast("long").alias("source_size")
    )
    ranked = with_row_number(found, [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    table = cut_lineage(ranked.withColumn("weight", weight).drop("rank"))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    limit = F.col("source_size") * float(most)
    share, stopped = 0.0, -1
    while True:
        over = F.col("weight") * share > limit if share else F.lit(False)
        at_limit, open_weight, n = table.agg(
            F.sum(F.when(over, limit).otherwise(0.0)),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(over, 1)),
        ).first()
        if n == stopped:
            break
        stopped = n
        share = (total - (at_limit or 0.0)) / open_weight if open_weight else share
    target = F.least(limit, F.col("weight") * F.lit(float(share)))
    return table.withColumn("target", target)


def _chance(*parts: Column) -> Column:
    """A number from 0 to 1 that only depends on the parts."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11)).cast("double") / float(1 << 53)


def _state(p: Column, unit: Column) -> Column:
    return F.struct(unit["key"].alias("key"), unit["size"].alias("size"), p.alias("p"))


def _decided(unit: Column, taken: Column) -> Column:
    return F.array(F.struct(unit["key"].alias("key"), taken.cast("int").alias("extra")))


def _pair(acc: Column, new: Column, seed: int) -> Column:
    """Move words between the open unit and the next one until one of them is decided."""

    def step(old: Column) -> Column:
        w_old, w_new = old["size"].cast("double"), new["size"].cast("double")
        a, b = old["p"] * w_old, new["p"] * w_new
        to_old, to_new = F.least(w_old - a, b), F.least(a, w_new - b)
        up = _chance(F.lit(seed), old["key"], new["key"]) * (to_old + to_new) < to_new
        old_full, new_empty = up & (w_old - a <= b), up & (w_old - a > b)
        old_empty = ~up & (a <= w_new - b)
        rest = F.when(old_full, (a + b - w_old) / w_new).when(new_empty, (a + b) / w_old)
        rest = rest.when(old_empty, (a + b) / w_new).otherwise((a + b - w_new) / w_old)
        return F.when(
            old_full | old_empty,
            F.struct(_state(rest, new).alias("open"), _decided(old, old_full).alias("done")),
        ).otherwise(F.struct(_state(rest, old).alias("open"), _decided(new, ~new_empty).alias("done")))

    moved = bind(acc["open"], step)
    started = F.struct(
        _state(new["p"], new).alias("open"), F.slice(acc["done"], 1, 0).alias("done")
    )
    both = F.when(acc["open"].isNull(), started).otherwise(moved)
    return bind(both, lambda m: F.struct(m["open"].alias("open"), F.concat(acc["done"], m["done"]).alias("done")))


def _fold(block: Column, seed: int) -> Column:
    unit = "struct<key:struct<a:bigint,b:bigint>,size:bigint,p:double>"
    start = F.struct(
        F.lit(None).cast(unit).alias("open"),
        F.array().cast("array<struct<key:struct<a:bigint,b:bigint>,extra:int>>").alias("done"),
    )
    return F.aggregate(block, start, lambda acc, x: _pair(acc, x, seed))


def pivotal(units: DataFrame, most_units: int, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """`key` and `extra` (0 or 1) for units of `source`, `key`, `size`, `p`, `n_docs`; p lies inside (0, 1).

    `most_units` is the largest number of units of one source; it sets the height of the tree.
    """
    done, level = [], 0
    rows = units.withColumn("left", F.col("n_docs"))
    while True:
        blocks = F.ceil(F.col("left") / block).cast("long")
        rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "key"), blocks))
        unit = F.struct(F.xxhash64(F.lit(seed), "key").alias("order"), "key", F.col("size").cast("long").alias("size"), "p")
        groups = rows.groupBy("source", "block").agg(
            F.sort_array(F.collect_list(unit)).alias("units"), F.max(blocks).alias("left")
        )
        plain = F.transform("units", lambda u: F.struct(u["key"].alias("key"), u["size"].alias("size"), u["p"].alias("p")))
        folded = cut_lineage(groups.select("source", "left", _fold(plain, seed + level).alias("folded")))
        done.append(folded.select(F.explode("folded.done").alias("d")).select("d.key", "d.extra"))
        rows = folded.select("source", "left", "folded.open.*")
        if most_units <= 1:
            break
        most_units, level = math.ceil(most_units / block), level + 1
    last = rows.select("key", (_chance(F.lit(seed), F.lit("last"), "key") < F.col("p")).cast("int").alias("extra"))
    for part in done:
        last = last.unionByName(part)
    return last


def _against_rest(acc: Column, x: Column, seed: int) -> Column:
    """Move words between the largest open unit and all smaller ones, which share the fraction `p` and have `rest` words."""

    def step(m: Column) -> Column:
        w, a = x["size"].cast("double"), m["p"] * x["size"]
        fills, empties = (1 - m["p"]) * w <= m["p"] * m["rest"], m["p"] * w <= (1 - m["p"]) * m["rest"]
        drawn = _chance(F.lit(seed), F.lit("large"), x["key"]) * (m["to_unit"] + m["to_rest"]) < m["to_rest"]
        up = F.when(fills == empties, drawn).otherwise(fills)
        change = F.when(up, m["to_unit"]).otherwise(-m["to_rest"])
        now = (a + change) / w
        whole = (now < NEAR) | (now > 1 - NEAR)
        none_done, none_left = F.slice(acc["done"], 1, 0), F.slice(acc["left"], 1, 0)
        return F.struct(
            F.when(m["rest"] > 0, m["p"] - change / m["rest"]).otherwise(m["p"]).alias("p"), m["rest"].alias("rest"),
            F.concat(acc["done"], F.when(whole, _decided(x, now > 0.5)).otherwise(none_done)).alias("done"),
            F.concat(acc["left"], F.when(whole, none_left).otherwise(F.array(_state(now, x)))).alias("left"),
        )

    w, p = x["size"].cast("double"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), acc["p"]))
    rest = acc["rest"] - w
    able = F.struct(
        p.alias("p"), rest.alias("rest"),
        F.least((1 - p) * w, p * rest).alias("to_unit"), F.least(p * w, (1 - p) * rest).alias("to_rest"),
    )
    return bind(able, step)


def _large_first(rows: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Decisions on large units, and the others with the fraction that this leaves them."""
    large = F.col("size") * LARGE > F.col("source_size")
    unit = F.struct((-F.col("size")).alias("order"), "key", F.col("size").cast("long").alias("size"))
    groups = rows.where(large).groupBy("source", "source_size", "n_docs").agg(
        F.sort_array(F.collect_list(unit)).alias("units"), F.first("p").alias("p")
    )
    state = "struct<key:struct<a:bigint,b:bigint>,size:bigint,p:double>"
    start = F.struct(
        F.col("p").alias("p"), F.col("source_size").cast("double").alias("rest"),
        F.array().cast("array<struct<key:struct<a:bigint,b:bigint>,extra:int>>").alias("done"),
        F.array().cast(f"array<{state}>").alias("left"),
    )
    folded = cut_lineage(groups.select(
        "source", "n_docs", F.aggregate("units", start, lambda acc, x: _against_rest(acc, x, seed)).alias("f"),
    ))
    done = folded.select(F.explode("f.done").alias("d")).select("d.key", "d.extra")
    left = folded.select("source", "n_docs", F.explode("f.left").alias("u")).select("source", "u.*", "n_docs")
    changed = folded.select(F.col("source").alias("_source"), F.col("f.p").alias("_p"))
    rest = rows.where(~large).join(changed, F.col("source").eqNullSafe(F.col("_source")), "left")
    rest = rest.select("source", "key", "size", F.coalesce("_p", "p").alias("p"), "n_docs")
    return done, rest.unionByName(left)


def _units(documents: DataFrame) -> DataFrame:
    text = text_or_empty("row.text")
    return documents.select(
        F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").cast("string").alias("source"),
        F.size(words_of(text)).cast("long").alias("size"),
        row_key(F.col("row.doc_id").cast("long"), F.col("row.source").cast("string"), text).alias("key"),
    )


def copies(documents: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """Per document row `doc_id`, `size`, `source_size`, `target`, `copies`, `taken` and its `key`."""
    units = cut_lineage(_units(packed(documents.select("doc_id", "source", "text"))))
    table = cut_lineage(sources(units, weights, most))
    most_units = table.agg(F.max("n_docs")).first()[0] or 0
    near = units["source"].eqNullSafe(table["source"])
    rows = units.join(table, near).drop(table["source"])
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(wanted + NEAR)
    part = F.greatest(wanted - base, F.lit(0.0))
    rows = rows.withColumns({"base": base.cast("int"), "p": part})
    open_ = (F.col("p") > NEAR) & (F.col("size") > 0)
    large, rest = _large_first(rows.where(open_).select("source", "key", "size", "p", "n_docs", "source_size"), seed)
    whole = (F.col("p") < NEAR) | (F.col("p") > 1 - NEAR)
    decided = rest.where(whole).select("key", (F.col("p") > 0.5).cast("int").alias("extra"))
    extra = pivotal(rest.where(~whole), most_units, seed).unionByName(large).unionByName(decided)
    # Equal rows share a key: their copies are summed and dealt out among them by number.
    extra = extra.groupBy("key").agg(F.sum("extra").alias("extra"))
    same = rows.groupBy("key", "doc_id", "size", "source_size", "target", "base").agg(F.count("*").alias("times"))
    extra_of = F.coalesce(F.col("extra"), F.lit(0))
    numbered = same.join(extra, "key", "left").withColumn("no", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    n = F.col("base") + (F.col("no") <= extra_of).cast("int")
    return numbered.select(
        "doc_id", "size", "source_size", "target", n.alias("copies"), (n * F.col("size")).cast("long").alias("taken"), "key"
    )


def mix(documents: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 0) -> DataFrame:
    """The documents, each row as often as the mix takes it, with all their columns."""
    columns = documents.columns
    rows = packed(documents)
    key = row_key(F.col("row.doc_id").cast("long"), F.col("row.source").cast("string"), text_or_empty("row.text"))
    with released_tables(documents.sparkSession):
        chosen = copies(documents, weights, most, seed)
        per_key = chosen.groupBy("key").agg(F.sum("copies").alias("total"), F.count("*").alias("times"))
        per_key = cut_lineage(per_key.where("total > 0"), keep=True)
    # Rows of equal content split their copies: each takes a share, those that the share leaves over
    # go to the rows whose hash of all columns is smallest, which for fully equal rows is the same.
    once, repeated = per_key.where("times = 1"), per_key.where("times > 1")
    keyed = rows.withColumn("key", key)
    plain = keyed.join(once, "key").withColumn("no", F.explode(F.sequence(F.lit(1).cast("long"), "total")))
    if repeated.isEmpty():
        return unpacked(plain.select("row"), columns)
    spread = _spread(keyed.join(repeated, "key"))
    return unpacked(plain.select("row").unionByName(spread.select("row")), columns)


def _spread(shared: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
    whole = F.floor(F.col("total") / F.col("times"))
    mine = whole + (F.col("place") <= F.col("total") - whole * F.col("times")).cast("long")
    numbered = shared.withColumn("place", place).withColumn("mine", mine).where("mine > 0")
    return numbered.withColumn("no", F.explode(F.sequence(F.lit(1).cast("long"), "mine")))
