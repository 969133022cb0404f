"""Word statistics of many texts at once, in numpy.

Words are ``[^\\x20\\x09-\\x0D]+``. Texts are laid end to end, up to ``PIECE`` bytes at a
time and long ones cut at white space, so that memory follows the piece and the
number of words. A word is known by a 64-bit hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

PIECE = 1 << 20
WINDOW = 5
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Characters of text handled at once; the word columns take some twenty bytes for each.
SLICE = 3_000_000
_SPACE = b" \t\n\x0b\x0c\r"


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters)] = True
    return out


IS_SPACE = _table(_SPACE)
#: What is counted in each word.
CLASSES = {
    "symbols": _table(b"#*$%&|<>"),
    "upper": _table(bytes(range(65, 91))),
    "digits": _table(bytes(range(48, 58))),
    "bangs": _table(b"!"),
    "pipes": _table(b"|"),
    "chars": ~_table(bytes(range(128, 192))),
    "wide": _table(bytes(range(192, 256))),
}

_powers: list[np.ndarray] = []


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < size:
        size = max(size, PIECE + 1)
        _powers[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, p)))) for p in (_P, _P_INVERSE)]
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    """Columns over all words of a batch, in order; ``first[i]:first[i+1]`` are those of text i."""

    first: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    counts: dict[str, np.ndarray]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[self.first[1:]] - total[self.first[:-1]]


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(bytes, end of each part, text of each part)."""
    held, ends, docs, size = [], [], [], 0
    for doc, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        at = 0
        while at < len(data):
            room = at + PIECE
            until = len(data)
            if room < until:
                # Back to the last white space, or on to the next where a word is longer than a piece.
                cut = max(data.rfind(s, at, room) for s in (b" ", b"\n"))
                if cut <= at:
                    later = [c for c in (data.find(bytes([s]), room) for s in _SPACE) if c >= 0]
                    cut = min(later, default=until)
                until = min(until, cut + 1)
            held.append(data[at:until])
            size += until - at + 1
            ends.append(size)
            docs.append(doc)
            at = until
            if size >= PIECE:
                yield b" ".join(held) + b" ", np.array(ends), np.array(docs)
                held, ends, docs, size = [], [], [], 0
    if held:
        yield b" ".join(held) + b" ", np.array(ends), np.array(docs)


def slices(texts: Sequence[str | None]) -> Iterator[Sequence[str | None]]:
    """The texts in order, in runs of ``SLICE`` characters or one longer text."""
    begin = size = 0
    for at, text in enumerate(texts):
        length = len(text or "")
        if at > begin and size + length > SLICE:
            yield texts[begin:at]
            begin, size = at, 0
        size += length
    if begin < len(texts):
        yield texts[begin:]


def words_of(texts: Sequence[str | None]) -> Words:
    docs, hashes, counts = [], [], {name: [] for name in CLASSES}
    for data, ends, owner in _pieces(texts):
        codes = np.frombuffer(data, np.uint8)
        word = ~IS_SPACE[codes]
        edge = np.flatnonzero(np.diff(word, prepend=False))
        starts, stops = edge[0::2], edge[1::2]
        if not len(starts):
            continue
        docs.append(owner[np.searchsorted(ends, starts, "right")])
        power, inverse = _power_tables(len(codes) + 1)
        total = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power[: len(codes)], out=total[1:])
        hashes.append(mix((total[stops] - total[starts]) * inverse[starts]))
        run = np.zeros(len(codes) + 1, np.int64)
        for name, table in CLASSES.items():
            np.cumsum(table[codes], out=run[1:])
            counts[name].append(run[stops] - run[starts])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    doc = join(docs, np.int64)
    return Words(
        np.searchsorted(doc, np.arange(len(texts) + 1)),
        doc,
        join(hashes, np.uint64),
        {name: join(parts, np.int64) for name, parts in counts.items()},
    )


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of words that its text has twice or more."""
    n = len(words.doc)
    covered = np.zeros(n, bool)
    if n < window:
        return covered
    last = n - window + 1
    key = np.zeros(last, np.uint64)
    for i in range(window):
        key = key * _P + words.hash[i : i + last]
    key = mix(key ^ mix(words.doc[:last].astype(np.uint64)))
    whole = np.flatnonzero(words.doc[:last] == words.doc[window - 1 :])
    order = whole[np.argsort(key[whole])]
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(last, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    for i in range(window):
        covered[i : i + last] |= twice
    return covered


def duplicate_lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in (text or "").split("\n") if line.strip(" \t\n\r\x0b\x0c")]
    return len(lines), len(lines) - len(set(lines))
