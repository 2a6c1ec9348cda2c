"""Cached encoding of texts that were cut at places where no pre-token spans.

In the pre-token pattern of the byte-level vocabularies a plain space before a non-space always
starts a new match, and so does a line feed that stands between two non-space characters, which
is a match of its own. Cutting there and encoding each cut alone gives the ids of the whole text;
as words repeat, nearly all cuts come from a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from stocktide.llm.common import ship

SAFE_CUT = re.compile(r"(?= \S)")
#: Pieces each cache holds before it starts anew, and the longest piece that is kept.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 40
MARKS = frozenset(".,;:!?")


class PieceCache(dict):
    """Id bytes by piece; `lead` is put before each key."""

    def __init__(self, lead: str, owner: SegmentEncoder):
        super().__init__()
        self.lead, self.owner = lead, owner

    def __missing__(self, cut: str) -> bytes:
        if cut[-1:] in MARKS and cut[:-1].isalpha():  # letters and a mark are two pieces
            return self[cut[:-1]] + self.owner.bare[cut[-1]]
        if not cut.isalpha():
            found = self.owner.split(self.lead + cut)
            if len(found) != 1:  # several pieces: each piece has an entry, the cut has none
                return b"".join([self.owner.piece(p) for p in found])
        ids = self.owner.encode(self.lead + cut)
        if len(cut) <= CACHE_CHARS:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[cut] = ids
        return ids


class SegmentEncoder:
    """Whole texts to id bytes; `split` gives a text's pre-tokens, `encode` the id bytes of one."""

    def __init__(self, split: Callable[[str], list[str]], encode: Callable[[str], bytes]):
        self.split, self.encode = split, encode
        self.bare, self.spaced = PieceCache("", self), PieceCache(" ", self)

    def piece(self, piece: str) -> bytes:
        return self.spaced[piece[1:]] if piece[0] == " " else self.bare[piece]

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if " ".join(text.split()) != text.replace("\n", " "):  # not all white space stands single
            return b"".join(map(self.bare.__getitem__, SAFE_CUT.split(text)))
        out = []
        for i, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            if i:
                out.append(self.bare["\n"])
            out.append(self.bare[first])
            out.extend(map(self.spaced.__getitem__, rest))
        return b"".join(out)


ship(__name__)
