"""Texts cut at places where a byte-level tokenizer always cuts too, and ids remembered per piece."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

#: A white space character that is followed by text starts a pre-token of its own or leads the next one,
#: so the text may be cut in front of it. A run of white space keeps its other characters together.
PIECE = re.compile(r"\s?\S+|\s+(?!\S)")
CUT = re.compile(r"\s\S")
#: White space here, but not in the tokenizer's pattern.
SEPARATORS = "\x1c\x1d\x1e\x1f"
SLICE = 1 << 20
MOST_REMEMBERED = 1_000_000
LONGEST_REMEMBERED = 64


def pieces(text: str, specials: tuple[str, ...] = ()) -> Iterator[list[str]]:
    """Lists of pieces whose ids, one after the other, are the ids of the text.

    A text with a special token or an odd separator is one piece. A very long text
    comes in several lists.
    """
    if any(s in text for s in specials) or any(s in text for s in SEPARATORS):
        yield [text]
        return
    start = 0
    while len(text) - start > SLICE:
        cut = CUT.search(text, start + SLICE)
        if cut is None:
            break
        yield PIECE.findall(text, start, cut.start() + 1)[:-1] + _tail(text, start, cut.start())
        start = cut.start()
    yield PIECE.findall(text, start) if start else PIECE.findall(text)


def _tail(text: str, start: int, end: int) -> list[str]:
    """The last piece before a cut, read with the white space behind it in sight."""
    found = PIECE.findall(text, start, end + 1)
    last = found[-1] if found else ""
    return [last[:-1]] if last.strip() == "" and len(last) > 1 else []


class Remembered:
    """Ids of pieces as bytes, in little-endian numbers of ``width`` bytes; ``encode`` maps new pieces to such bytes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], specials: tuple[str, ...], most: int = MOST_REMEMBERED):
        self.encode, self.specials, self.most = encode, specials, most
        self.known: dict[str, bytes] = {}

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of every text; new pieces are encoded together, about SLICE characters of text at a time."""
        done: list[bytes] = []
        group: list[list] = []
        holes: list[tuple[list, int, str]] = []
        size = 0
        for text in texts:
            whole: list[bytes | None] = []
            for part in pieces(text, self.specials):
                ids = list(map(self.known.get, part))
                if whole:
                    holes += [(whole, len(whole) + k, part[k]) for k in absent(ids)]
                    whole += ids
                else:
                    whole = ids
                    holes += [(whole, k, part[k]) for k in absent(ids)]
            group.append(whole)
            size += len(text)
            if size > SLICE:
                done += self._filled(group, holes)
                group, holes, size = [], [], 0
        return done + self._filled(group, holes)

    def _filled(self, group: list[list], holes: list[tuple[list, int, str]]) -> list[bytes]:
        if holes:
            new = list({piece for _, _, piece in holes})
            fresh = dict(zip(new, self.encode(new)))
            for ids, k, piece in holes:
                ids[k] = fresh[piece]
            if len(self.known) + len(new) > self.most:
                self.known = {}
            self.known.update((piece, ids) for piece, ids in fresh.items() if len(piece) <= LONGEST_REMEMBERED)
        return list(map(b"".join, group))


def absent(ids: list[bytes | None]) -> Iterator[int]:
    """Places of None."""
    at = -1
    try:
        while True:
            at = ids.index(None, at + 1)
            yield at
    except ValueError:
        return
