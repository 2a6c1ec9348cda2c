"""Vectorised hashes of words and of word sequences over many texts at once.

Runs inside tasks on the UTF-8 bytes of a few texts. A word's hash is a polynomial in a table of random
numbers per byte, taken from prefix sums, so no word is ever a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

from stocktide.llm.common import ship

#: Bytes of text hashed together; a longer text is cut between words.
CHUNK = 1 << 20
#: Fixed odd multipliers of the word polynomial and of the places in a sequence.
BASE, PLACE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
#: White space that parts words of documents, and ASCII that is no letter or digit.
WHITE = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def mixed(h):
    """Bits of 64-bit numbers spread over all places."""
    import numpy as np

    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Word and sequence hashes for one set of gap bytes; letters A-Z count as a-z."""

    def __init__(self, gaps: bytes):
        self.gaps = gaps

    def __getstate__(self):
        return {"gaps": self.gaps}

    def __getattr__(self, name: str):
        if name not in ("gap", "byte", "power", "inverse"):
            raise AttributeError(name)
        import numpy as np

        self.gap = np.zeros(256, bool)
        self.gap[list(self.gaps)] = True
        self.byte = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.byte = self.byte[np.frombuffer(LOWER, "u1")]
        self._powers(1024)
        return self.__dict__[name]

    def _powers(self, n: int) -> None:
        import numpy as np

        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.concatenate((np.ones(1, "u8"), np.full(n, BASE, "u8"))))
            back = np.uint64(pow(BASE, -1, 1 << 64))
            self.inverse = np.multiply.accumulate(np.concatenate((np.ones(1, "u8"), np.full(n, back, "u8"))))

    def _words(self, data: bytes):
        """Start of each word and its hash."""
        import numpy as np

        raw = np.frombuffer(data, "u1")
        inside = np.concatenate(([False], ~self.gap[raw], [False]))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        self.gap  # noqa: B018  builds the tables
        if len(raw) >= len(self.power):
            self._powers(2 * len(raw))
        sums = np.concatenate((np.zeros(1, "u8"), np.cumsum(self.byte[raw] * self.power[: len(raw)])))
        found = (sums[ends] - sums[starts]) * self.inverse[starts]
        return starts, mixed(found + (ends - starts).astype("u8") * np.uint64(PLACE))

    def words(self, texts: list[bytes]):
        """Hashes of all words of the texts, one text after another, and each text's number of words."""
        import numpy as np

        counts, found = np.zeros(len(texts), "i8"), []
        first = 0
        while first < len(texts):
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= CHUNK):
                size += len(texts[last]) + 1
                last += 1
            if size > 2 * CHUNK:  # one long text
                for piece in self._pieces(texts[first]):
                    hashes = self._words(piece)[1]
                    counts[first] += len(hashes)
                    found.append(hashes)
            else:
                parts = texts[first:last]
                starts, hashes = self._words(self.gaps[:1].join(parts))
                ends = np.cumsum([len(p) + 1 for p in parts])
                counts[first:last] = np.diff(np.searchsorted(starts, ends), prepend=0)
                found.append(hashes)
            first = last
        return (np.concatenate(found) if found else np.zeros(0, "u8")), counts

    def _pieces(self, text: bytes) -> Iterator[bytes]:
        """Stretches of about CHUNK bytes that end between words."""
        import numpy as np

        at = 0
        while at < len(text):
            end = min(len(text), at + CHUNK)
            while end < len(text):
                gaps = np.flatnonzero(self.gap[np.frombuffer(text[max(at, end - 4096) : end], "u1")])
                if len(gaps):
                    end = max(at, end - 4096) + int(gaps[-1]) + 1
                    break
                end = min(len(text), end + 4096)
            yield text[at:end]
            at = end


def sequences(words, k: int):
    """Hash of the k words from each place on; the last k - 1 places have none."""
    import numpy as np

    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, "u8")
    with np.errstate(over="ignore"):
        found = np.full(n, k, "u8")
        for i in range(k):
            found = found * np.uint64(PLACE) + words[i : i + n]
        return mixed(found)


def within(counts, k: int):
    """Of the places in all texts' words those from which k words stand in the same text, and their text."""
    import numpy as np

    text = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    here = np.arange(len(text))
    inside = here + k <= ends[text] if len(text) else np.zeros(0, bool)
    return here[inside], text[inside]


ship(__name__)
