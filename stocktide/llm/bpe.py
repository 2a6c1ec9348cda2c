"""Byte-level BPE: exact encoding by backtracking over longest matches, and decoding.

A token sequence is the BPE result of a byte string exactly if each token and each adjacent pair
is what merging gives for its own bytes. So the encoder takes the longest vocabulary entry at each
place (found by an Aho-Corasick automaton over the bytes mapped to Latin-1), tests it against the
token before it with a memoised merge of only the two, falls back to the entry's next shorter
prefix, and steps back where nothing fits. A place from which no encoding continues is never
entered twice, which keeps the work linear in the length.

Defined results: a null or empty text has no ids and decodes to no bytes; a text of any length is
encoded whole; equal rows give equal rows; other columns are ignored; a null `doc_id` stays null.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.llm.common import ship, text_or_empty
from stocktide.llm.segments import SegmentEncoder

#: Remembered pairs before the memo starts anew.
MEMO_ENTRIES = 1_000_000
NO_RANK = 1 << 40
OUTPUT = "doc_id long, ids binary, decoded binary"
#: Output rows are sent on when they hold this many bytes.
BATCH_BYTES = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 token and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class BytePairCodec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import numpy as np
        import regex

        self.ranks = ranks
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        by_rank = [self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)]
        self.spelled = np.frombuffer(b"".join(by_rank), "u1")
        self.lengths = np.array([len(t) for t in by_rank], "i8")
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.matcher = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (len(token), rank))
        self.matcher.make_automaton()
        self.prefixes, self.memo, self.edges = {}, {}, {}
        self.text = SegmentEncoder(regex.compile(pattern).findall, self._piece)

    def merged(self, data: bytes, least: int = 1) -> list[bytes]:
        """Plain BPE: join the adjacent pair of lowest rank, the leftmost of equals, until none is left
        or only `least` parts are."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least:
            pairs = [(self.ranks.get(a + b, NO_RANK), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, at = min(pairs)
            if rank == NO_RANK:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edge(self, token: int, side: int) -> list[int] | None:
        """What stands at the left (0) or right (1) edge of a token while it is merged: from the single
        byte up to the token itself. None if merging its bytes doesn't give the token."""
        key = (token, side)
        if key not in self.edges:
            data = self.tokens[token]
            if len(data) == 1:
                self.edges[key] = [token]
            else:
                parts = self.merged(data, 2)
                ranks = [self.ranks[p] for p in parts]
                below = self.edge(ranks[side], side) if len(parts) == 2 else None
                other = self.edge(ranks[1 - side], 1 - side) if below else None
                self.edges[key] = [*below, token] if other else None
        return self.edges[key]

    def fits(self, before: int, token: int) -> bool:
        """Whether merging keeps `before` and `token` (or `token` alone after -1) as they are.

        Follows the two parts at the border while both sides are merged in order of rank: they fit
        if at no time the pair across the border is the next to be merged.
        """
        key = (before, token)
        known = self.memo.get(key)
        if known is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            known = self.memo[key] = self._fits(before, token)
        return known

    def _fits(self, before: int, token: int) -> bool:
        right = self.edge(token, 0)
        if right is None or before < 0:
            return right is not None
        left = self.edge(before, 1)
        i = j = 0
        while True:
            across = self.ranks.get(self.tokens[left[i]] + self.tokens[right[j]], NO_RANK)
            up_left = left[i + 1] if i + 1 < len(left) else NO_RANK
            up_right = right[j + 1] if j + 1 < len(right) else NO_RANK
            if across < up_left and across <= up_right and across != NO_RANK:
                return False
            if up_left == up_right == NO_RANK:
                return True
            if up_left <= up_right:
                i += 1
            else:
                j += 1

    def shorter(self, token: int) -> int:
        """The longest proper prefix of a token that is a token, or -1."""
        found = self.prefixes.get(token)
        if found is None:
            data = self.tokens[token]
            found = next((r for n in range(len(data) - 1, 0, -1) if (r := self.ranks.get(data[:n])) is not None), -1)
            self.prefixes[token] = found
        return found

    def encode_bytes(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size = len(data)
        longest = [-1] * size
        for end, (length, rank) in self.matcher.iter(data.decode("latin-1")):
            longest[end - length + 1] = rank  # ends ascend, so the longest is set last
        tokens, memo = self.tokens, self.memo
        dead: set[int] = set()
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while True:
            if token < 0:  # nothing continues from here: take the last token back
                if not out:
                    raise ValueError("bytes that the vocabulary can't spell")
                dead.add(at)
                token = out.pop()
                at -= len(tokens[token])
                last = out[-1] if out else -1
                token = self.shorter(token)
                continue
            end = at + len(tokens[token])
            if end not in dead:
                fits = memo.get((last, token))
                if self.fits(last, token) if fits is None else fits:
                    out.append(token)
                    if end == size:
                        return out
                    at, last, token = end, token, longest[end]
                    continue
            token = self.shorter(token)

    def _piece(self, piece: str) -> bytes:
        ids = self.encode_bytes(piece.encode("utf-8"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        return self.text(text)

    def decode(self, ids: bytes) -> bytes:
        if not ids:
            return b""
        import numpy as np

        tokens = np.frombuffer(ids, "<u4")
        lengths = self.lengths[tokens]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[tokens] - ends + lengths, lengths)
        places += np.arange(ends[-1])
        return self.spelled[places].tobytes()


def built(given: dict) -> BytePairCodec:
    """The codec of broadcast plain values, kept beside them: a worker builds it once and needs no library."""
    if "codec" not in given:
        given["codec"] = BytePairCodec(given["ranks"], given["pattern"])
    return given["codec"]


def _both_ways(shared):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        codec = built(shared.value)
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = codec.encode(text.as_py())
                rows.append((doc_id.as_py(), ids, codec.decode(ids)))
                held += len(ids)
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def encode_documents(documents: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """`doc_id`, `ids` (little-endian unsigned 32-bit integers) and the `decoded` bytes per document.

    The vocabulary is read once on the driver and broadcast: a file of some hundred kilobytes whose
    size doesn't depend on the data. Workers keep the built codec and its caches between tasks.
    """
    shared = documents.sparkSession.sparkContext.broadcast({"ranks": read_ranks(ranks_path), "pattern": pattern})
    texts = documents.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return texts.mapInArrow(_both_ways(shared), OUTPUT)


def digests(encoded: DataFrame) -> DataFrame:
    """`doc_id`, `n_tokens` and SHA-256 digests of ids and decoded bytes."""
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


ship(__name__)
