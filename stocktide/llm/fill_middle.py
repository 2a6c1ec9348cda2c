"""Fill-in-middle by counted quantifiers: one regular-expression match cuts a text in three.

A text is a run of n units, matched left to right; the default unit is one code point, others
(`LINE`, `WORD`) are patterns whose matches tile the text. `regexp_count` gives n. Two cut points a <= b
then make the row's own pattern, `unit{a}+`, `unit{b-a}+` and the rest as three groups, and one match of
it captures prefix, middle and suffix; the replacement of that match is the output. The counted groups are
possessive, so the engine walks them in a loop: no backtracking and no recursion at any length.

Units are counted in blocks of `BLOCK`, so that counting a long text holds one string per block and not
one per unit.

Which form a row takes, and where it is cut, come from 32-bit numbers out of the SHA-256 of
`seed:doc_id`, so reruns and other partitionings agree. Forms: `plain` (the text as it is), `psm` (prefix,
suffix, middle, each after its marker) and `spm` (suffix, prefix, middle).

Defined results: a null text is empty; an empty text, and one that holds a marker, is plain, so that
every output can be undone; a null `doc_id` is spelled as nothing in the hash; equal rows give equal rows;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import text_or_empty

#: Units as patterns; the matches of each, one after another, make up the whole text.
CODE_POINT, WORD, LINE = r"(?s:.)", r"(?:\s*+\S++|\s++)", r"(?:[^\n]*+\n|[^\n]++)"
#: Units that are counted as one match.
BLOCK = 4096


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def any(self) -> str:
        return "|".join(re.escape(m) for m in (self.prefix, self.suffix, self.middle))


def n_units(text: Column, unit: str = CODE_POINT) -> Column:
    """Number of units of a text."""
    block = F.lit(f"(?:{unit}){{{BLOCK}}}+")
    rest = F.regexp_replace(text, block, F.lit(""))
    return (F.regexp_count(text, block).cast("long") * BLOCK + F.regexp_count(rest, F.lit(unit))).cast("long")


def draws(key: Column, seed: int, n: int = 4) -> list[Column]:
    """Unsigned 32-bit numbers that only depend on seed and key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def cut_pattern(first: Column, second: Column, unit: str = CODE_POINT) -> Column:
    """The row's pattern: groups of `first` units, of `second` units, and the rest."""
    counted = rf"((?:{unit}){{%d}}+)"
    return F.format_string(rf"(?s)\A{counted}{counted}(.*+)\z", first, second)


def transformed(
    documents: DataFrame, unit: str = CODE_POINT, seed: int = 1, plain_percent: int = 10,
    spm_percent: int = 20, markers: Markers = Markers(),
) -> DataFrame:
    """`doc_id`, `n` units, `form`, `prefix_units`, `middle_units` (null if plain) and the `output`."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    plain = (F.col("text") == "") | (h3 % 100 >= 100 - plain_percent) | F.col("text").rlike(markers.any())
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    counted = rows.select("doc_id", "text", n_units(F.col("text"), unit).alias("n"), form.alias("form"))
    a, b = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    placed = counted.withColumns({"first": F.least(a, b), "second": F.abs(a - b)})
    p, s, m = (x.replace("\\", r"\\").replace("$", r"\$") for x in (markers.prefix, markers.suffix, markers.middle))
    spelled = F.when(F.col("form") == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    cut = F.regexp_replace("text", cut_pattern(F.col("first"), F.col("second"), unit), spelled)
    is_plain = F.col("form") == "plain"
    return placed.select(
        "doc_id", "n", "form",
        F.when(~is_plain, F.col("first")).alias("prefix_units"), F.when(~is_plain, F.col("second")).alias("middle_units"),
        F.when(is_plain, F.col("text")).otherwise(cut).alias("output"),
    )


def restored(output: Column, form: Column, markers: Markers = Markers()) -> Column:
    """The text that an output was made from. As no part holds a marker, the first one found ends a part."""
    p, s, m = (re.escape(x) for x in (markers.prefix, markers.suffix, markers.middle))
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(made: DataFrame, markers: Markers = Markers()) -> DataFrame:
    """Digests of the output and of the text rebuilt from it."""
    return made.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form"), markers), 256).alias("restored_sha256"),
    )
