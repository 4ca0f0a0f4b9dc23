"""Byte-pair encoding of whole texts through a memory of encoded pieces.

The public pre-tokenising pattern starts a new token at every run of blanks.
Of two blanks before a non-blank the first is a token, and the second is one
too unless it is a space, which then leads the next token.  So a text is cut
before its spaces and around its newlines, unless three blanks meet, or two
at its end; then it is cut only before spaces that a non-blank follows.  Each
piece is encoded on its own and remembered; pieces keep every byte.
"""

from __future__ import annotations

import re
from collections.abc import Callable

# These blanks are a superset of any library's, so a text is cut too rarely at worst.
UNSAFE = re.compile(r"\s\s(?:\s|\Z)")
CUT = re.compile(r"(?= \S)")
MEMORY_PIECES = 350_000
LONG_PIECE = 64
MARKS = frozenset(".,!?;:")
LAST_PLAIN = "\u024f"
PIECES_AT_ONCE = 1 << 17
BARE = "\n"


class Memory:
    """Codes of pieces, remembered in two generations of bounded size.

    ``encode`` gives the codes of a list of pieces.  When the newer
    generation is full it becomes the older one; a piece found there moves
    back, so pieces in use stay.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], pieces: int = MEMORY_PIECES):
        self.encode, self.bound = encode, pieces
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, missing: set[str]) -> dict[str, bytes]:
        """The codes of keys that the newer generation lacks, remembered unless they are too long."""
        known = {k: self.old[k] for k in missing if k in self.old}
        unknown = missing.difference(known)
        # a mark after a letter or digit is a token of its own, so such a piece is put together
        marked = [k for k in unknown if k[-1:] in MARKS and k[-2:-1].isalnum() and k[-2] <= LAST_PLAIN]
        parts = {part for k in marked for part in (k[:-1], BARE + k[-1])}.difference(known)
        held = {k: self.new[k] for k in parts if k in self.new}
        unknown = [*unknown.difference(marked).union(parts.difference(held))]
        known.update(zip(unknown, self.encode([_piece(k) for k in unknown]), strict=True))
        for k in marked:
            stem, mark = k[:-1], BARE + k[-1]
            known[k] = (held[stem] if stem in held else known[stem]) + (held[mark] if mark in held else known[mark])
        kept = {k: code for k, code in known.items() if len(k) <= LONG_PIECE}
        if len(self.new) + len(kept) > self.bound:
            self.old, self.new = self.new, {}
        self.new.update(kept)
        return known

    def codes(self, texts: list[str]) -> list[bytes]:
        """The codes of each whole text."""
        out: list[bytes] = []
        block: list[list[str]] = []
        held = 0
        for keys in map(_keys, texts):
            if block and held + len(keys) > PIECES_AT_ONCE:
                out += self._block(block)
                block, held = [], 0
            if len(keys) > PIECES_AT_ONCE:
                parts = (keys[at:at + PIECES_AT_ONCE] for at in range(0, len(keys), PIECES_AT_ONCE))
                out.append(b"".join(code for part in parts for code in self._block([part])))
            else:
                block.append(keys)
                held += len(keys)
        return out + self._block(block)

    def _block(self, block: list[list[str]]) -> list[bytes]:
        found = [list(map(self.new.get, keys)) for keys in block]
        holes = [[i for i, code in enumerate(codes) if code is None] for codes in found]
        learnt = self._learn({keys[i] for keys, at in zip(block, holes) for i in at})
        for keys, codes, at in zip(block, found, holes):
            for i in at:
                codes[i] = learnt[keys[i]]
        return [b"".join(codes) for codes in found]


def _piece(key: str) -> str:
    return key[1:] if key.startswith(BARE) else " " + key


def _keys(text: str) -> list[str]:
    """The keys of a text's pieces: what follows the piece's first blank, or BARE and a piece
    that has no first blank (or one that BARE follows)."""
    if UNSAFE.search(text):
        return [p[1:] if p[0] == " " and p[1:2] != BARE else BARE + p for p in CUT.split(text) if p]
    out: list[str] = []
    for line in text.split("\n"):
        words = line.split(" ")
        if words[0]:
            words[0] = BARE + words[0]
            out += words
        else:
            out += words[1:]
        out.append(BARE + "\n")
    out.pop()
    return out
