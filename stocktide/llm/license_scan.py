"""License scan by diagonal voting.

All rolling word 2-grams and 4-grams of every text are hashed and joined with the places they have in the
templates: 2-grams with those of short phrases, 4-grams with those of license notices. A hit at word
p of a text and word t of a template votes for the diagonal p - t, where the template would start. The votes of a
diagonal are summed before the shuffle. A phrase stands where its diagonal has the votes of all its 2-grams. Diagonals
of a notice that are at most `DRIFT` words apart (words put in or left out shift them) are merged, and the span is
verified: its votes must cover `LEAST_COVERED` of the notice's 4-grams within about its length. Licenses of one
family differ in few words, so of their notices that begin within `NEAR` words only the best covered one stands.

The templates (`license_texts`) are the only table that is broadcast; its size is checked. A document whose text holds a notice
thousands of times is as many diagonals, merged by a window over one document's diagonals of one template.

Defined results: a null or empty text has no words and no labels, which is the empty string; equal rows give
equal rows; a null `doc_id` stays null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stocktide.llm.common import ship, text_or_empty
from stocktide.llm.grams import NOT_ALNUM, Hasher, sequences, within
from stocktide.llm.license_texts import NOTICES
from stocktide.llm.sketches import batches_of

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
GRAM, DRIFT, LEAST_COVERED, NEAR = 4, 3, 0.6, 40
#: Licenses that share wording, by the first part of their labels.
FAMILIES = {"gpl": "gnu", "lgpl": "gnu", "agpl": "gnu", "cc": "cc", "cc0": "cc"}
#: More template places than this would not be broadcast but refused.
MOST_PLACES = 200_000
HASHED = "part int, row long, doc_id long, n_words long, pairs int, grams array<long>"


def _hash_batches(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    hasher, part, row = Hasher(NOT_ALNUM), TaskContext.get().partitionId(), 0
    for batch in batches:
        for first, texts in batches_of(batch.column(1)):
            words, counts = hasher.words(texts)
            found, owner, pairs = [], [], None
            for k in (2, GRAM):
                places, text = within(counts, k)
                found.append(sequences(words, k)[places] if len(places) else np.zeros(0, "u8"))
                owner.append(text)
                if pairs is None:
                    pairs = np.bincount(text, minlength=len(texts))
            owner = np.concatenate(owner)
            order = np.argsort(owner, kind="stable")
            ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts))))).astype("i4")
            grams = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)[order].view("i8")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(texts), part, "i4")), pa.array(np.arange(row, row + len(texts))), batch.column(0).slice(first, len(texts)),
                 pa.array(counts), pa.array(pairs.astype("i4")), grams],
                names=["part", "row", "doc_id", "n_words", "pairs", "grams"],
            )
            row += len(texts)


def template_places(spark, phrases: Mapping[str, str], notices: Mapping[str, Sequence[str]]) -> DataFrame:
    """Hash, template, label, place and number of k-grams of the template, for every k-gram of every template."""
    hasher, rows = Hasher(NOT_ALNUM), []
    for k, texts in ((2, dict(phrases)), (GRAM, {t: label for label, passages in notices.items() for t in passages})):
        for text, label in texts.items():
            words, _ = hasher.words([text.encode()])
            hashes = sequences(words, k).view("i8").tolist()
            family = FAMILIES.get(label.split("-")[0], label)
            rows += [(h, k, f"{k}:{text}", label, family, at, len(hashes)) for at, h in enumerate(hashes)]
    if len(rows) > MOST_PLACES:
        raise ValueError(f"{len(rows)} template places are too many to broadcast")
    return spark.createDataFrame(rows, "hash long, k int, template string, label string, family string, at long, of long")


def scan(documents: DataFrame, phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, Sequence[str]] = NOTICES) -> DataFrame:
    """Per document its words, the places of phrases, labels and score.

    `score` is the largest share of a template that stands in one place; a whole phrase counts 1.
    """
    spark = documents.sparkSession
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    hashed = texts.mapInArrow(_hash_batches, HASHED)
    document = ["part", "row", "doc_id", "n_words"]
    rolling = hashed.select(*document, "pairs", F.posexplode_outer("grams").alias("no", "hash"))
    places = F.broadcast(template_places(spark, phrases, notices))
    k = F.when(F.col("no") < F.col("pairs"), 2).otherwise(GRAM)
    rolling = rolling.select(*document, F.when(k == 2, F.col("no")).otherwise(F.col("no") - F.col("pairs")).alias("word"), k.alias("k_of"), "hash")
    hits = rolling.join(places, (rolling["hash"] == places["hash"]) & (F.col("k_of") == F.col("k")), "left")
    # Words without a hit come down to one row per document, so every document stays.
    votes = hits.groupBy(*document, "k", "template", "label", "family", "of", (F.col("word") - F.col("at")).alias("diagonal")).agg(
        F.count("at").alias("votes"),
        F.min("word").alias("first"), F.max("word").alias("last"),
    )
    by_place = Window.partitionBy(*document, "template").orderBy("diagonal")
    gap = F.col("diagonal") - F.lag("diagonal").over(by_place)
    apart = F.coalesce((gap > F.when(F.col("k") == 2, 0).otherwise(DRIFT)).cast("int"), F.lit(1))
    merged = (
        votes.withColumn("span", F.sum(apart).over(by_place))
        .groupBy(*document, "template", "k", "label", "family", "of", "span")
        .agg(F.sum("votes").alias("votes"), F.min("first").alias("first"), F.max("last").alias("last"), F.min("diagonal").alias("start"))
    )
    covered = F.least(F.lit(1.0), F.col("votes") / F.col("of"))
    phrase = (F.col("k") == 2) & (F.col("votes") == F.col("of"))
    whole = (F.col("k") == GRAM) & (covered >= LEAST_COVERED) & (F.col("last") - F.col("first") < 1.5 * F.col("of") + DRIFT)
    merged = merged.withColumn("stands", F.when(whole, covered))
    around = Window.partitionBy(*document, "family").orderBy("first").rangeBetween(-NEAR, NEAR)
    merged = merged.withColumn("best", F.max("stands").over(around))
    notice = F.col("stands") >= F.col("best")
    listed = lambda which: F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return merged.groupBy(*document).agg(
        F.count(F.when(phrase, 1)).alias("n_base"), F.min(F.when(phrase, F.col("start"))).alias("first_word"),
        F.max(F.when(phrase, F.col("start"))).alias("last_word"), listed(phrase).alias("base_labels"),
        listed(phrase | notice).alias("labels"), F.coalesce(F.max(F.when(phrase | notice, covered)), F.lit(0.0)).alias("score"),
    ).drop("part", "row")


ship(__name__)
