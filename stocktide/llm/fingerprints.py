"""Document fingerprints: homomorphic multiset hashes of paragraphs.

A paragraph (a line that isn't blank) is hashed as a whole and in pieces (stretches of up to `PIECE` characters
without a mark); its vector is the sum of what its hashes spell. The fingerprint of a text is the sum
of its paragraphs' vectors, every entry modulo a power of two:

* 8 wide entries modulo 2^32, sums of uniform hash halves: they decide equality;
* 120 narrow entries modulo 2^30, sums of single hash bits: seen as +1 and -1 they are a random
  projection, so the squared distance of two fingerprints estimates in how many hashed units
  the texts differ. The likeness is 1 less that over what it would be if they shared none.

Sums don't depend on the order of paragraphs, and `add` and `remove` update a fingerprint by the
fingerprints of what comes or goes. The narrow entries are packed two to a 64-bit sum; none runs over below 2^30
units, more than a text of one gigabyte has.

Defined results: null and empty texts have the fingerprint of no paragraphs, alike 1 to each other;
equal texts have equal fingerprints; rows of equal `doc_id` follow each other by text; a null `doc_id`
is the smallest; one document alone is its own next one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import text_or_empty
from stocktide.session import shuffle_width

#: Longest piece of a paragraph that is hashed as one.
PIECE = 64
PIECES = rf"[^.,;:!?\n]{{1,{PIECE}}}"
SHIFTS, LANE_BITS, LANES, SIGNS = 30, 30, 2, 2
#: Bits 0 and 30: two counts to a packed sum.
SPREAD = (1 << LANE_BITS) | 1
LANE = (1 << LANE_BITS) - 1
WIDE = 4
PACKED = [f"p{s}_{j}" for s in range(SIGNS) for j in range(SHIFTS)]
EQUAL = [f"e{k}{half}" for k in range(WIDE) for half in "lh"]
ENTRIES = ["units", *PACKED, *EQUAL]
#: Ranges of `doc_id` per shuffle partition, so that hashing spreads them evenly.
RANGES_PER_PARTITION = 4


def units(text: Column) -> Column:
    """What is hashed: every non-blank line, and its pieces."""
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    return F.concat(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)))


def vectors(texts: DataFrame, keys: list[str]) -> DataFrame:
    """The entries of every text of (`keys`, `text`); rows of the same keys are added up."""
    rows = texts.select(*keys, F.explode_outer(units(F.col("text"))).alias("unit"))
    hashed = rows.select(
        *keys, F.col("unit").isNotNull().cast("long").alias("real"),
        *[F.xxhash64(F.lit(f"sign {s}"), "unit").alias(f"s{s}") for s in range(SIGNS)],
        *[F.xxhash64(F.lit(f"wide {k}"), "unit").alias(f"w{k}") for k in range(WIDE)],
    )
    real = F.col("real")
    sums = [F.sum(real).alias("units")]
    for s in range(SIGNS):
        for j in range(SHIFTS):
            bits = F.shiftrightunsigned(f"s{s}", j).bitwiseAND(F.lit(SPREAD))
            sums.append(F.sum(bits * real).alias(f"p{s}_{j}"))
    for k in range(WIDE):
        low, high = F.col(f"w{k}").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(f"w{k}", 32)
        sums += [F.sum(low * real).alias(f"e{k}l"), F.sum(high * real).alias(f"e{k}h")]
    return hashed.groupBy(*keys).agg(*sums)


def lanes(packed: Column) -> list[Column]:
    return [F.shiftrightunsigned(packed, LANE_BITS * i).bitwiseAND(F.lit(LANE)) for i in range(LANES)]


def spelled(entry) -> Column:
    """The fingerprint as text: number of units, then every entry in hexadecimal."""
    low = [F.lpad(F.hex(entry(c).bitwiseAND(F.lit((1 << 60) - 1))), 15, "0") for c in PACKED]
    wide = [F.lpad(F.hex(entry(c).bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0") for c in EQUAL]
    return F.lower(F.concat(F.lpad(F.hex(entry("units")), 8, "0"), *low, *wide))


def likeness(a, b) -> Column:
    """Likeness of two fingerprints (functions from entry name to column), 0 to 1."""

    def signed(side) -> Column:
        counts = F.array(*[lane for c in PACKED for lane in lanes(side(c))])
        return F.transform(counts, lambda n: (n * 2 - side("units")).cast("double"))

    def square(entries: Column) -> Column:
        return F.aggregate(entries, F.lit(0.0), lambda total, x: total + x * x)

    apart = square(F.zip_with(signed(a), signed(b), lambda x, y: x - y))
    whole = square(signed(a)) + square(signed(b))
    same = a("units") == b("units")
    for c in (*PACKED, *EQUAL):
        same = same & (a(c) == b(c))
    near = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - apart / whole))
    return F.when(same, F.lit(1.0)).when((a("units") == 0) | (b("units") == 0) | (whole == 0), F.lit(0.0)).otherwise(near)


def add(a, b, sign: int = 1) -> list[Column]:
    """Entries of a fingerprint with another one's paragraphs added (or removed, with `sign=-1`)."""
    return [(a(c) + b(c) * sign).alias(c) for c in ENTRIES]


def remove(a, b) -> list[Column]:
    return add(a, b, -1)


def with_next(documents: DataFrame) -> DataFrame:
    """Each row with `next_text`, that of the next row in descending `doc_id`, and its place in its range.

    Rows are dealt by ranges of `doc_id` whose bounds are ids of the table. The first row of a range is
    also dealt to the range before it, where it stands behind the last row, so no step needs all rows in
    one order. The number of ranges follows the shuffle's width.
    """
    spark = documents.sparkSession
    doc = F.col("doc_id").cast("long")
    rows = documents.select(doc.alias("doc_id"), text_or_empty().alias("text"))
    n = RANGES_PER_PARTITION * shuffle_width(spark)
    cuts = documents.agg(F.percentile_approx(doc, [i / n for i in range(1, n + 1)], 20 * n).alias("c"), F.max(doc).alias("m")).first()
    heads = sorted({*(cuts["c"] or []), *([cuts["m"]] if cuts["m"] is not None else [])})  # the first rows of ranges
    bounds = F.array(*[F.lit(h) for h in heads]).cast("array<bigint>")
    # Range i holds the ids from above head i-1 up to head i; nulls come after the smallest ids.
    low, high = F.lit(0), F.lit(len(heads) - 1)
    steps = F.sequence(F.lit(1), F.lit(max(1, len(heads).bit_length())))
    halves = F.aggregate(
        steps, F.struct(low.alias("lo"), high.alias("hi")),
        lambda s, _: _halved(s, bounds),
    )["lo"]
    place = F.when(F.col("doc_id").isNull() | F.lit(not heads), 0).otherwise(halves)
    placed = rows.withColumn("part", place)
    # Rows come in descending id: the range after (below) range i is i - 1, and after 0 comes the last.
    head = F.col("doc_id").eqNullSafe(F.get(bounds, F.col("part"))) if heads else F.lit(True)
    above = F.pmod(F.col("part") + 1, F.lit(max(1, len(heads))))
    home = F.struct(F.col("part"), F.lit(False).alias("guest"))
    both = placed.withColumn(
        "dealt",
        F.explode(F.when(head, F.array(home, F.struct(above.alias("part"), F.lit(True).alias("guest")))).otherwise(F.array(home))),
    ).select("doc_id", "text", "dealt.part", "dealt.guest")
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), "text")
    return both.withColumns({"next_text": F.lead("text").over(order), "place": F.row_number().over(order)})


def _halved(state: Column, bounds: Column) -> Column:
    """One step of the search for the first bound that isn't below `doc_id`."""
    middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
    below = F.get(bounds, middle) < F.col("doc_id")
    return F.struct(
        F.when((state["lo"] < state["hi"]) & below, middle + 1).otherwise(state["lo"]).alias("lo"),
        F.when((state["lo"] < state["hi"]) & ~below, middle).otherwise(state["hi"]).alias("hi"),
    )


def compare_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and the next.

    All of it happens in the ranges of `with_next`: texts are shuffled once, vectors not at all.
    """
    followed = with_next(documents)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), F.length("text") - half), F.substr("next_text", F.lit(1), half))
    own = F.struct(F.lit(0).alias("kind"), F.col("text").alias("text"))
    other = F.struct(F.lit(1).alias("kind"), edited.alias("text"))
    both = followed.select(
        "part", "place", "guest", "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.inline(F.when(F.col("guest"), F.array(own)).otherwise(F.array(own, other))),
    )
    sha = F.when(F.col("kind") == 1, F.sha2("text", 256)).alias("sha")
    keys = ["part", "place", "kind", "guest", "doc_id", "n_chars"]
    found = vectors(both.select(*keys, sha, "text"), [*keys, "sha"])
    entries = found.select(*keys, "sha", F.struct(*ENTRIES).alias("own"))
    order = Window.partitionBy("part").orderBy("place", "kind")
    beside = entries.withColumns(
        {"edited": F.lead("own", 1).over(order), "edited_sha256": F.lead("sha", 1).over(order), "next": F.lead("own", 2).over(order)}
    ).where("kind = 0 AND NOT guest")
    of = lambda side: (lambda c: F.col(f"{side}.{c}"))
    return beside.select(
        "doc_id", "n_chars", "edited_sha256",
        spelled(of("own")).alias("fingerprint"), spelled(of("edited")).alias("edited_fingerprint"),
        likeness(of("own"), of("edited")).alias("near_edited"), likeness(of("own"), of("next")).alias("near_next"),
    )
