"""Sharding by a weighted hash tree: region, rack, shard.

A row descends the tree from its root. At each node every child draws a number from a hash of (seed, child,
key) and the child with the largest ln(u) / weight wins, which picks children in proportion to their
weights. A draw of one child doesn't depend on its siblings, so where a shard's weight changes, rows
only move between the subtrees whose weights change with it (that shard, its rack, its region) and the
rest; within a region whose racks keep their weights nothing moves.

Rows that come into a larger region are dealt among all its shards. So that one more shard takes rows
only into itself, `layout` puts shards beyond the first `BASE` into regions of their own: the key
and the number of shards decide alone (law `key`).

A shard's slots are the ranks of its rows by key, found by a distributed numbering: no step needs a whole
shard in one task, however large it is. Equal texts have other keys and may lie in other shards.

Defined results: a null text has no bytes, so size 1, and the checksum of the empty text; a null key is a
key of its own, first in its shard; rows of equal key lie in one shard, in the order of checksum and size;
fully equal rows are interchangeable; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import bind, text_or_empty
from stocktide.session import cut_lineage

SHARDS, SEED = 16, 1
#: Shards of the tree that `layout` builds before it adds single ones, shards of a rack, racks of a region.
BASE, RACK, REGION = 16, 4, 2
#: Hexadecimal digits of a draw: 52 bits, which a double holds exactly.
DIGITS = 13
LAW = "key"


class Shard(NamedTuple):
    """One shard of a topology; the weights of racks and regions are sums over their shards."""

    shard: int
    rack: int
    region: int
    weight: float = 1.0


def layout(shards: int, base: int = BASE, rack: int = RACK, region: int = REGION) -> list[Shard]:
    """The topology of so many equal shards: full racks and regions up to `base`, then single ones."""
    placed = [Shard(s, s // rack, s // (rack * region)) for s in range(min(shards, base))]
    racks, regions = (max((p[i] for p in placed), default=-1) + 1 for i in (1, 2))
    return placed + [Shard(s, racks + i, regions + i) for i, s in enumerate(range(base, shards))]


def _children(topology: Sequence[Shard]) -> tuple[dict, dict, dict]:
    """Children and weights of the root, of every region and of every rack."""
    if not topology or any(s.weight <= 0 for s in topology):
        raise ValueError("a topology needs shards of positive weight")
    if len({s.shard for s in topology}) < len(topology) or len({(s.rack, s.region) for s in topology}) > len({s.rack for s in topology}):
        raise ValueError("a shard stands in one rack, a rack in one region")
    root: dict[int, float] = {}
    regions: dict[int, dict[int, float]] = {}
    racks: dict[int, dict[int, float]] = {}
    for s in topology:
        root[s.region] = root.get(s.region, 0.0) + s.weight
        inside = regions.setdefault(s.region, {})
        inside[s.rack] = inside.get(s.rack, 0.0) + s.weight
        racks.setdefault(s.rack, {})[s.shard] = s.weight
    return root, regions, racks


def _literal(children: dict[int, float]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("id"), F.lit(float(w)).alias("weight")) for c, w in sorted(children.items())])


def _lookup(nodes: dict[int, dict[int, float]], node: Column) -> Column:
    pairs = [x for k, v in sorted(nodes.items()) for x in (F.lit(k), _literal(v))]
    return F.element_at(F.create_map(*pairs), node)


def _winner(children: Column, level: str, key: Column, seed: int) -> Column:
    """The child with the largest weighted draw; of equal ones the smallest."""

    def draw(child: Column) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(level), child["id"].cast("string"), key))
        bits = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
        u = (bits + 0.5) / float(1 << 4 * DIGITS)
        return F.struct((F.log(u) / child["weight"]).alias("score"), (-child["id"]).alias("id"))

    return (-F.array_max(F.transform(children, draw))["id"]).cast("int")


def shard_of(key: Column, topology: Sequence[Shard], seed: int = SEED) -> Column:
    """The shard of a key: three weighted choices, as many draws as the chosen nodes have children."""
    root, regions, racks = _children(topology)
    name = F.coalesce(key.cast("string"), F.lit(""))
    region = _winner(_literal(root), "region", name, seed)
    in_rack = bind(region, lambda r: _winner(_lookup(regions, r), "rack", name, seed))
    return bind(in_rack, lambda r: _winner(_lookup(racks, r), "shard", name, seed))


def with_slots(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`slot`: the rank of each row in its `shard`, from 0, without a task per shard.

    Rows are sorted in ranges of (shard, order) and stored with their place; a shard's rows in one range
    follow each other there, so a slot is the rows of the shard in earlier ranges and the way from its first
    place in this one. What is broadcast has at most as many rows as there are ranges and shards.
    """
    tie = F.monotonically_increasing_id()  # parts even a large group of equal rows
    keys = ["shard", *[F.col(c).asc_nulls_first() for c in order], "_tie"]
    ranged = rows.withColumn("_tie", tie).repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    placed = cut_lineage(ranged.withColumns({"_place": F.monotonically_increasing_id(), "_range": F.spark_partition_id()}))
    pieces = placed.groupBy("shard", "_range").agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    slots = placed.join(F.broadcast(pieces), ["shard", "_range"])
    slot = F.col("_before") + F.col("_place") - F.col("_first")
    return slots.withColumn("slot", slot.cast("long")).drop("_place", "_range", "_first", "_before")


def assign(documents: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every document's shard and slot, and its shard if there were one more.

    Texts are read once for size and checksum; only the narrow rows are shuffled.
    """
    text = text_or_empty()
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = F.col("doc_id")
    placed = rows.withColumns({
        "law": F.lit(LAW), "shard": shard_of(key, layout(shards), seed), "grown_shard": shard_of(key, layout(shards + 1), seed),
    })
    return with_slots(placed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
