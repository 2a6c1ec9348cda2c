"""Shingle sets of texts and their b-bit MinHash signatures, computed inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

from stocktide.llm.common import ship
from stocktide.llm.grams import WHITE, Hasher, mixed, sequences, within

#: Texts of about this many bytes are sketched together.
BATCH_BYTES = 1 << 20
SCHEMA = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"


def batches_of(column, size: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of an Arrow string column as UTF-8 bytes, and where they start."""
    first, held, texts = 0, 0, []
    for i, text in enumerate(column):
        data = (text.as_py() or "").encode("utf-8", "surrogatepass")
        texts.append(data)
        held += len(data)
        if held >= size:
            yield first, texts
            first, held, texts = i + 1, 0, []
    if texts:
        yield first, texts


def shingle_sets(hasher: Hasher, texts: list[bytes], width: int):
    """Distinct shingle hashes, sorted within each text, and how many each text has.

    A text of fewer than `width` words has its whole sequence as its one shingle.
    """
    import numpy as np

    words, counts = hasher.words(texts)
    places, owner = within(counts, width)
    hashes = sequences(words, width)[places] if len(places) else np.zeros(0, "u8")
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        starts = np.cumsum(counts) - counts
        few = [sequences(words[starts[i] : starts[i] + counts[i]], int(counts[i]))[0] for i in short]
        hashes, owner = np.concatenate((hashes, np.array(few, "u8"))), np.concatenate((owner, short))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], np.bincount(owner[new], minlength=len(texts))


def set_hashes(hashes, starts):
    """Two 64-bit hashes of each set, whatever the order of its shingles; `hashes` lie set after set."""
    import numpy as np

    with np.errstate(over="ignore"):
        return np.add.reduceat(hashes, starts), np.bitwise_xor.reduceat(mixed(hashes + np.uint64(1)), starts)


class Sketcher:
    def __init__(self, width: int, symbols: int):
        self.width, self.symbols = width, symbols
        self.hasher = Hasher(WHITE)

    def __call__(self, texts: list[bytes]):
        """Per text the set's size, two set hashes and the 16-bit symbols."""
        import numpy as np

        hashes, counts = shingle_sets(self.hasher, texts, self.width)
        n, k = len(texts), self.symbols
        some = np.flatnonzero(counts)
        set_a, set_b = np.zeros(n, "u8"), np.zeros(n, "u8")
        signature = np.zeros((n, k), "<u2")
        if len(some):
            starts = (np.cumsum(counts) - counts)[some]
            with np.errstate(over="ignore"):
                set_a[some], set_b[some] = set_hashes(hashes, starts)
                keys = np.random.default_rng(7).integers(1, 1 << 63, (2, k), dtype=np.uint64)
                for i in range(k):
                    least = np.minimum.reduceat((hashes ^ keys[0, i]) * (keys[1, i] | np.uint64(1)), starts)
                    signature[some, i] = (mixed(least) >> np.uint64(48)).astype("u2")
        return counts, set_a, set_b, signature


def sketch_batches(width: int, symbols: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sketcher = Sketcher(width, symbols)
        for batch in batches:
            for first, texts in batches_of(batch.column(1)):
                counts, a, b, signature = sketcher(texts)
                rows = [signature[i].tobytes() for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(counts, pa.int64()), pa.array(a.view("i8")),
                     pa.array(b.view("i8")), pa.array(rows, pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return run


ship(__name__)
