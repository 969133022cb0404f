"""Benchmark decontamination by pigeonhole edit matching.

Both sides are taken in plain form (lower case, no ASCII punctuation, single blanks).
An item of n characters may differ in ``int(n * rate)`` edits. It is cut into ``SPARE``
pieces more than that (fewer if they fell below ``PIECE_LEAST`` characters, one at least),
so that a passage within the budget has that many pieces unchanged. One Aho-Corasick pass
over a document finds the pieces; each hit tells where the item would lie. Only where
as many different pieces as are spared tell of places no further apart than the budget,
Myers' bit-parallel distance on that window decides: chance hits don't get there.

The test items are the stated query set: they are taken in blocks of a fixed size, each
block being shipped to the tasks and run over all documents. No document is shuffled.

Defined cases: NULL and empty texts and items match nothing; short items have a budget
of zero and match exactly; equal items, repeated rows and NULL ids are reported each;
documents of any length are scanned whole; empty tables give no rows; only doc_id and
text (item_id and text) are looked at, other columns pass through ``drop_leaks``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from strataflow.llm.plain import plain

#: A tenth: one or two words of a short passage may be others.
RATE = 0.1
#: Pieces that stay unchanged within the budget, where pieces are long enough.
SPARE, PIECE_LEAST = 3, 6
#: Characters of items taken at once; bounds what a task holds.
BLOCK_CHARS = 4_000_000

_FOUND = "doc_id long, item_id long, distance int, start long, end long"
_FOUND_KEYS = "doc_id long, key string, distance int, start long, end long"


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, char in enumerate(pattern):
        masks[char] |= 1 << i
    return masks


def best_end(pattern: str, text: str, anchored: bool = False) -> tuple[int, int]:
    """(distance, end) of the best match of the whole pattern in the text; the first of equal ones.

    Myers' recurrence on integers of the pattern's length. ``anchored`` makes the
    match begin where the text begins.
    """
    masks, top, full = _masks(pattern), 1 << (len(pattern) - 1), (1 << len(pattern)) - 1
    plus, minus, score = full, 0, len(pattern)
    best = (score, 0)
    for at, char in enumerate(text, 1):
        equal = masks.get(char, 0)
        vertical = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | (full & ~(across | plus)), plus & across
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1 | anchored) & full, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
        if score < best[0]:
            best = (score, at)
    return best


def pieces_of(item: str, rate: float) -> tuple[int, list[tuple[int, str]]]:
    """The error budget and (offset, piece) of at least one piece more, of near equal length."""
    budget = min(int(len(item) * rate), len(item) - 1)
    count = budget + max(1, min(SPARE, len(item) // PIECE_LEAST - budget))
    cuts = [len(item) * i // count for i in range(count + 1)]
    return budget, [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _agreed(told: list[tuple[int, int]], budget: int, spared: int) -> Iterator[int]:
    """Starts, ascending, that lie in a run within the budget with as many different pieces as are spared."""
    if spared == 1:
        yield from (start for start, _ in told)
        return
    seen: dict[int, int] = defaultdict(int)
    first = given = 0
    for at, (start, offset) in enumerate(told):
        seen[offset] += 1
        while told[first][0] < start - budget:
            gone = told[first][1]
            seen[gone] -= 1
            if not seen[gone]:
                del seen[gone]
            first += 1
        if len(seen) >= spared:
            for here in range(max(first, given), at + 1):
                yield told[here][0]
            given = at + 1


class Matcher:
    """All items of a block; ``find`` gives (item index, distance, start, end) of each item in a text."""

    def __init__(self, items: list[str], rate: float):
        self.items = items
        self.budgets, self.spared = [], []
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for index, item in enumerate(items):
            budget, pieces = pieces_of(item, rate)
            self.budgets.append(budget)
            self.spared.append(len(pieces) - budget)
            for offset, piece in pieces:
                where[piece].append((index, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Windows of the text in which an item may lie, overlapping ones as one."""
        hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, (length, places) in self.automaton.iter(text):
            for index, offset in places:
                hits[index].append((end + 1 - length - offset, offset))
        found = {}
        for index, told in hits.items():
            budget, size, spared = self.budgets[index], len(self.items[index]), self.spared[index]
            if len(told) < spared:
                continue
            merged: list[list[int]] = []
            for start in _agreed(sorted(told), budget, spared):
                low, high = max(0, start - budget), min(len(text), start + size + budget)
                if merged and low <= merged[-1][1]:
                    merged[-1][1] = max(high, merged[-1][1])
                else:
                    merged.append([low, high])
            if merged:
                found[index] = merged
        return found

    def find(self, text: str, first_only: bool = False) -> Iterator[tuple[int, int, int, int]]:
        for index, windows in self.windows(text).items():
            item, best = self.items[index], None
            for low, high in windows:
                exact = text.find(item, low, high)
                if exact >= 0:
                    distance, end = 0, exact + len(item)
                else:
                    distance, end = best_end(item, text[low:high])
                    end += low
                if distance <= self.budgets[index] and (best is None or distance < best[0]):
                    best = (distance, end)
                    if not distance:
                        break
            if best:
                distance, end = best
                back = text[max(0, end - len(item) - distance) : end][::-1]
                yield index, distance, end - (best_end(item[::-1], back, True)[1] if distance else len(item)), end
                if first_only:
                    return


def _key() -> Column:
    return F.sha1("text")


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple[str, str]]]:
    """(key, plain form) of the distinct item texts, a bounded number of characters at a time.

    An item that is repeated in the benchmark is one text here, so no block grows with its copies.
    """
    texts = benchmark.where(F.length("text") > 0).select("text").distinct().select(_key().alias("key"), "text")
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // block_chars)
    for number in range(count):
        block = texts.where(F.pmod(F.xxhash64("text"), F.lit(count)) == number)
        items = [(row["key"], plain(row["text"])) for row in block.toLocalIterator()]
        if items := sorted((i, t) for i, t in items if t):
            yield items


def _shared(documents: DataFrame, items: list, rate: float) -> Callable[[], Matcher]:
    """The block's matcher, built once in each worker."""
    shipped = documents.sparkSession.sparkContext.broadcast([text for _, text in items])
    kept: list[Matcher] = []

    def matcher() -> Matcher:
        if not kept:
            kept.append(Matcher(shipped.value, rate))
        return kept[0]

    return matcher


def find_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and item in it: the least distance, and where (characters of the plain text)."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = []
    for items in item_blocks(benchmark, block_chars):
        matcher, keys = _shared(documents, items, rate), [i for i, _ in items]

        def scan(frames: Iterator[pd.DataFrame], matcher=matcher, keys=keys) -> Iterator[pd.DataFrame]:
            for frame in frames:
                rows = [
                    (doc, keys[index], *rest)
                    for doc, text in zip(frame["doc_id"].astype("Int64"), frame["text"])
                    for index, *rest in matcher().find(plain(text))
                ]
                out = pd.DataFrame(rows, columns=["doc_id", "key", "distance", "start", "end"])
                yield out.astype({"doc_id": "Int64", "key": "string"})

        found.append(narrow.mapInPandas(scan, _FOUND_KEYS))
    if not found:
        return documents.sparkSession.createDataFrame([], _FOUND)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    ids = benchmark.select(_key().alias("key"), F.col("item_id").cast("long").alias("item_id"))
    return out.join(ids, "key").select("doc_id", "item_id", "distance", "start", "end")


def _leaks(matcher: Callable[[], Matcher]) -> Callable[[Column], Column]:
    """Whether a text holds an item of the block."""

    def leaks(text: pd.Series) -> pd.Series:
        return pd.Series([any(True for _ in matcher().find(plain(t), first_only=True)) for t in text], dtype="bool")

    return F.pandas_udf(leaks, BooleanType())


def drop_leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Documents in which no item was found, all columns as they were."""
    for items in item_blocks(benchmark, block_chars):
        documents = documents.where(~_leaks(_shared(documents, items, rate))(F.col("text")))
    return documents
