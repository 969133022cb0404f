"""Phrase collocation mining: Rabin-Karp fingerprints find frequent phrases, the text confirms them.

A-Z is lower-cased; texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces, and those into words
``[^\\x20\\x09]+``. Prefix polynomials modulo 2**64 over the bytes hash every word, and over
the word hashes every phrase of up to ``LONGEST`` words, all in numpy.

1. Fingerprints (salted with the language) are counted by one shuffle a level: words,
   pairs, then three and four words. A phrase is only counted where its shorter parts may be
   frequent themselves. A task adds its counts up and ships them sorted, a block for each bucket of
   fingerprints; a bucket is merged by one task at a time. What is frequent sets bits of a table of ``FILTER_BITS``
   at most, which is all that goes to the driver and on to the tasks; false hits cost
   counting, no exactness.
2. In a last pass each task sorts the occurrences that pass by fingerprint. Every
   occurrence is compared with the words under the pointer of the first one, and where they
   differ (a collision) they are told apart by their words, whose numbers stand for their
   bytes exactly. A task materialises each phrase once, from its pointer, and ships sorted blocks; they
   are added up by text, with the smallest doc_id that holds them. Counts are exact, whatever the fingerprints do.
3. Frequent phrases are cut, scored in decimals, pruned and ranked as tables.

Phrases and scores are by language. No list is gathered by one: hot parts of phrases are joined by
``join_hot``, ranks are limited on both sides of their shuffle.

Defined cases: NULL and empty texts have no words; a NULL lang is ``und``; a NULL doc_id is
never an example; repeated rows count as often as they come; a very long text is worked on in
chunks cut at piece ends, so that memory follows the longest piece; ties are broken as in
``rank_phrases``; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataflow.llm.rows import join_hot
from strataflow.llm.textstats import mix
from strataflow.session import settle

LONGEST = 4
LEAST = 30
COVERED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
FILTER_BITS = 1 << 27
#: Bytes of text worked on at once.
CHUNK = 2 << 20
#: Counts a task holds before it hands them on.
HELD = 2_000_000
#: Stretches of fingerprints that are merged one at a time, 1/4096 of all distinct ones of a
#: level in memory at once; and those of materialised phrases.
BUCKETS, PHRASE_BUCKETS = 4096, 256
#: Leading bits of a fingerprint that are shipped and looked up.
SHORT_BITS = 48

_BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
#: Odd multipliers and their inverses modulo 2**64.
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_NONE = np.int64(2**63 - 1)

_power_cache: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64."""
    found = _power_cache.get(base)
    if found is None or len(found) < size:
        factors = np.full(max(size, CHUNK + 2), base, np.uint64)
        factors[0] = 1
        found = _power_cache[base] = np.multiply.accumulate(factors)
    return found[:size]


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of the polynomial with these coefficients."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, stop: np.ndarray, base: int) -> np.ndarray:
    """Polynomials of the stretches, shifted to begin at power 0."""
    return (sums[stop] - sums[start]) * powers(pow(base, -1, 2**64), len(sums))[start]


def lang_salt(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


@dataclass
class Chunk:
    """Words of several texts laid end to end."""

    data: bytes
    start: np.ndarray
    stop: np.ndarray
    piece: np.ndarray
    hash: np.ndarray
    lang: np.ndarray
    langs: list[str]
    doc: np.ndarray
    sums: np.ndarray
    salts: np.ndarray

    def phrase(self, at: int, n: int) -> bytes:
        return b" ".join([self.data[a:b] for a, b in zip(self.start[at : at + n].tolist(), self.stop[at : at + n].tolist())])

    def starts(self, n: int) -> np.ndarray:
        """Words at which a phrase of ``n`` words begins that stays in its piece."""
        last = len(self.start) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[n - 1 :])

    def fingerprints(self, at: np.ndarray, n: int) -> np.ndarray:
        return mix(between(self.sums, at, at + n, _WORD) ^ (self.salts[self.lang[at]] + np.uint64(n)))


def read_chunk(parts: list[bytes], langs: list[str], docs: list[int | None]) -> Chunk:
    """``parts`` are lower-cased texts or pieces of them, with the language and doc_id of each."""
    data = b"\n".join(parts) + b"\n"
    codes = np.frombuffer(data, np.uint8)
    kind = _KIND[codes]
    edges = np.flatnonzero(np.diff(kind == 0, prepend=False))
    start, stop = edges[0::2], edges[1::2]
    sums = prefix(codes.astype(np.uint64) + np.uint64(1), _BYTE)
    hashed = mix(between(sums, start, stop, _BYTE) + (stop - start).astype(np.uint64))
    ends = np.cumsum([len(p) + 1 for p in parts])
    owner = np.searchsorted(ends, start, side="right")
    names = sorted(set(langs))
    code = {name: i for i, name in enumerate(names)}
    return Chunk(
        data, start, stop, np.cumsum(kind == 2, dtype=np.int32)[start], hashed,
        np.array([code[x] for x in langs], np.int64)[owner], names,
        np.array([_NONE if d is None else d for d in docs], np.int64)[owner],
        prefix(hashed, _WORD), np.array([lang_salt(x) for x in names], np.uint64),
    )


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    """The texts of a task, long ones cut where a piece ends."""
    parts, langs, docs, size = [], [], [], 0
    for batch in batches:
        for doc, lang, text in zip(*[batch.column(c) for c in ("doc_id", "lang", "text")]):
            data, at = text.as_py().lower(), 0  # bytes: A-Z alone
            while at < len(data):
                until = len(data)
                if until - at > CHUNK:
                    end = _BREAK.search(data, at + CHUNK)
                    until = until if end is None else end.end()
                parts.append(data[at:until])
                langs.append(lang.as_py())
                docs.append(doc.as_py())
                size += until - at
                at = until
                if size >= CHUNK:
                    yield read_chunk(parts, langs, docs)
                    parts, langs, docs, size = [], [], [], 0
    if parts:
        yield read_chunk(parts, langs, docs)


class Filter:
    """A bit for each fingerprint that may be frequent; ``None`` lets everything pass."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def passes(self, fingerprints: np.ndarray) -> np.ndarray:
        found = short(fingerprints)
        word = (found >> np.uint64(6)) & np.uint64(len(self.words) - 1)
        return (self.words[word] >> (found & np.uint64(63))) & np.uint64(1) == 1


def short(fingerprints: np.ndarray) -> np.ndarray:
    return fingerprints >> np.uint64(64 - SHORT_BITS)


def candidates(chunk: Chunk, n: int, filters: dict[int, Filter], cache: dict) -> np.ndarray:
    """Where phrases of ``n`` words begin whose longest counted parts may all be frequent."""
    if n == 1:
        return chunk.starts(1)
    at = chunk.starts(n)
    known = max(k for k in filters if k < n)
    if known not in cache:
        # By word: whether the phrase of ``known`` words from there may be frequent.
        ok = np.zeros(len(chunk.start) + 1, bool)
        here = candidates(chunk, known, filters, cache)
        ok[here] = filters[known].passes(chunk.fingerprints(here, known))
        cache[known] = ok
    ok = cache[known]
    for shift in range(n - known + 1):
        at = at[ok[at + shift]]
    return at


def add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[begin], np.add.reduceat(counts, begin)


class Tally:
    """Counts by fingerprint, added up whenever ``HELD`` of them have come in."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > HELD:
            self.keys, self.counts = ([x] for x in self.total())
            self.size = len(self.keys[0])

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return add_up(np.concatenate(self.keys), np.concatenate(self.counts))


def _narrow(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the greatest takes, behind how many that are."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _widen(data: bytes, n: int) -> tuple[np.ndarray, bytes]:
    """The first n numbers, and what is behind them."""
    width = data[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, n * width, 1).reshape(n, width)
    return out.reshape(-1).view("<u8").astype(np.uint64), data[1 + n * width :]


def pack(keys: np.ndarray, counts: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Sorted short fingerprints and their counts as a block for each bucket, by differences."""
    span = np.uint64((1 << SHORT_BITS) // buckets)
    cuts = np.searchsorted(keys, np.arange(buckets, dtype=np.uint64) * span)
    ends = np.append(cuts[1:], len(keys))
    for bucket in np.flatnonzero(ends > cuts).tolist():
        here = keys[cuts[bucket] : ends[bucket]]
        steps = np.diff(here, prepend=np.uint64(bucket) * span)
        yield bucket, len(here).to_bytes(4, "little") + _narrow(steps) + _narrow(counts[cuts[bucket] : ends[bucket]])


def unpack(bucket: int, block: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(block[:4], "little")
    steps, rest = _widen(block[4:], n)
    counts, _ = _widen(rest, n)
    return np.cumsum(steps, dtype=np.uint64) + np.uint64((1 << SHORT_BITS) // buckets * bucket), counts.astype(np.int64)


def _count(sizes: list[int], filters, buckets: int):
    """Blocks of the short fingerprints of phrases of the given sizes, with how often they come."""

    def told(tally: Tally) -> Iterator[pa.RecordBatch]:
        packed = list(pack(*tally.total(), buckets))
        if packed:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*packed), (pa.int32(), pa.binary()))], ["bucket", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tally = {k: Filter(w) for k, w in filters.value.items()}, Tally()
        for chunk in chunks(batches):
            cache: dict = {}
            for n in sizes:
                found = short(chunk.fingerprints(candidates(chunk, n, known, cache), n))
                tally.add(*add_up(found, np.ones(len(found), np.int64)))
            if tally.size > HELD // 2:
                yield from told(tally)
                tally = Tally()
        yield from told(tally)

    return run


def _frequent(least: int, buckets: int):
    """The fingerprints of a bucket that come often enough; blocks arrive bucket by bucket."""

    def told(bucket: int, tally: Tally) -> pa.RecordBatch:
        keys, counts = tally.total()
        return pa.RecordBatch.from_arrays([pa.array(keys[counts >= least].astype(np.int64))], ["fingerprint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tally = None, Tally()
        for batch in batches:
            for bucket, block in zip(batch.column("bucket").to_pylist(), batch.column("block").to_pylist()):
                if at is not None and bucket != at:
                    yield told(at, tally)
                    tally = Tally()
                at = bucket
                tally.add(*unpack(bucket, block, buckets))
        if at is not None:
            yield told(at, tally)

    return run


class Vocabulary:
    """Numbers of words, the same for the same bytes throughout a task."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.words: list[bytes] = []

    def number(self, word: bytes) -> int:
        found = self.numbers.setdefault(word, len(self.words))
        if found == len(self.words):
            self.words.append(word)
        return found

    def ids(self, chunk: Chunk, at: np.ndarray) -> np.ndarray:
        """The number of each word in ``at``; -1 for the other words of the chunk.

        Words of one hash are looked up once, after all bytes of each were compared with
        those of the first one.
        """
        out = np.full(len(chunk.start), -1, np.int64)
        if not len(at):
            return out
        _, first, group = np.unique(chunk.hash[at], return_index=True, return_inverse=True)
        rep = at[first][group]
        length, wanted = (chunk.stop - chunk.start)[at], (chunk.stop - chunk.start)[rep]
        same = length == wanted
        sizes = np.where(same, length, 0)
        ends = np.cumsum(sizes)
        within = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
        codes = np.frombuffer(chunk.data, np.uint8)
        unlike = codes[np.repeat(chunk.start[at], sizes) + within] != codes[np.repeat(chunk.start[rep], sizes) + within]
        if unlike.any():
            same[np.searchsorted(ends, np.flatnonzero(unlike), side="right")] = False
        numbers = np.array([self.number(chunk.phrase(i, 1)) for i in at[first].tolist()], np.int64)
        out[at] = numbers[group]
        for i in at[~same].tolist():
            out[i] = self.number(chunk.phrase(i, 1))
        return out


@dataclass
class Counted:
    """Phrases of n words by fingerprint: the numbers of their words, language, count and smallest doc_id."""

    prints: np.ndarray
    words: np.ndarray
    lang: np.ndarray
    count: np.ndarray
    doc: np.ndarray

    @staticmethod
    def joined(parts: list[Counted]) -> Counted:
        return Counted(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("prints", "words", "lang", "count", "doc")])

    def added_up(self) -> Counted:
        """One row a phrase. Rows of a fingerprint that differ from the first one in a word are sorted by their words."""
        if not len(self.prints):
            return self
        order = np.argsort(self.prints, kind="stable")
        prints, words, lang = self.prints[order], self.words[order], self.lang[order]
        fresh = np.concatenate(([True], prints[1:] != prints[:-1]))
        group = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)[group]
        same = (words == words[first]).all(axis=1) & (lang == lang[first])
        if not same.all():
            mixed = np.isin(group, group[~same])
            rank = np.lexsort([*words.T, np.where(mixed, lang, 0), group])
            rank = np.concatenate((np.flatnonzero(~mixed), rank[mixed[rank]]))
            order, words, lang, group = order[rank], words[rank], lang[rank], group[rank]
            unlike = (words[1:] != words[:-1]).any(axis=1) | (lang[1:] != lang[:-1])
            fresh = np.concatenate(([True], unlike | (group[1:] != group[:-1])))
        begin = np.flatnonzero(fresh)
        at = order[begin]
        return Counted(
            self.prints[at], self.words[at], self.lang[at], np.add.reduceat(self.count[order], begin),
            np.minimum.reduceat(self.doc[order], begin),
        )


def occurrences(chunk: Chunk, ids: np.ndarray, lang: np.ndarray, at: np.ndarray, n: int) -> Counted:
    """The phrases of n words that begin at these places, each occurrence held against the text of the first."""
    words = np.stack([ids[at + j] for j in range(n)], axis=1)
    return Counted(chunk.fingerprints(at, n), words, lang[chunk.lang[at]], np.ones(len(at), np.int64), chunk.doc[at]).added_up()


_BLOCK = pa.schema([("bucket", pa.int32()), ("lang", pa.string()), ("n", pa.int32()), ("block", pa.binary())])
_FOUND = pa.schema([("lang", pa.string()), ("n_words", pa.int32()), ("phrase", pa.string()), ("f", pa.int64()), ("first_doc", pa.int64())])
_FOUND_DDL = "lang string, n_words int, phrase string, f long, first_doc long"


def _materialise(filters, buckets: int):
    """Blocks of the phrases that may be frequent, each once a task with its exact count; for no words, that of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {k: Filter(w) for k, w in filters.value.items()}
        vocabulary, langs = Vocabulary(), Vocabulary()
        held: dict[int, list[Counted]] = {n: [] for n in range(1, LONGEST + 1)}
        totals: dict[str, int] = {}

        def told() -> Iterator[pa.RecordBatch]:
            words = vocabulary.words
            for n, parts in held.items():
                if not parts:
                    continue
                total = Counted.joined(parts).added_up()
                bucket = (total.prints % np.uint64(buckets)).astype(np.int64)
                order = np.lexsort([total.lang, bucket])
                edge = np.flatnonzero(np.diff(bucket[order], prepend=-1) | np.diff(total.lang[order], prepend=-1))
                rows = []
                for lo, hi in zip(edge.tolist(), [*edge[1:].tolist(), len(order)]):
                    here = order[lo:hi]
                    texts = [b" ".join([words[w] for w in row]) for row in total.words[here].tolist()]
                    sort = sorted(range(len(texts)), key=texts.__getitem__)
                    here = here[sort]
                    numbers = total.count[here].astype("<i8").tobytes() + total.doc[here].astype("<i8").tobytes()
                    block = zlib.compress(numbers + b"\n".join([texts[i] for i in sort]), 1)
                    rows.append((int(bucket[here[0]]), langs.words[total.lang[here[0]]].decode(), len(here), block))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)

        for chunk in chunks(batches):
            for name, f in zip(chunk.langs, np.bincount(chunk.lang, minlength=len(chunk.langs)).tolist()):
                totals[name] = totals.get(name, 0) + f
            lang = np.array([langs.number(name.encode()) for name in chunk.langs], np.int64)
            cache: dict = {}
            ids = None
            for n in held:
                at = candidates(chunk, n, known, cache)
                at = at[known[n].passes(chunk.fingerprints(at, n))]
                ids = vocabulary.ids(chunk, at) if ids is None else ids
                if len(at):
                    held[n].append(occurrences(chunk, ids, lang, at, n))
                if sum(len(p.prints) for p in held[n]) > HELD // 8:
                    held[n] = [Counted.joined(held[n]).added_up()]
            if sum(len(p.prints) for parts in held.values() for p in parts) > HELD // 2:
                yield from told()
                held = {n: [] for n in held}
                vocabulary = Vocabulary()
        yield from told()
        rows = [(0, name, 0, f.to_bytes(8, "little")) for name, f in totals.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _BLOCK)], schema=_BLOCK)

    return run


def _exact(least: int):
    """Blocks, bucket by bucket and in it by language, to the phrases that come often enough, counted by text."""

    def told(lang: str, held: dict, total: int | None) -> pa.RecordBatch:
        rows = [(lang, 0, "", total, None)] if total is not None else []
        for phrase, (f, doc) in held.items():
            if f >= least:
                rows.append((lang, phrase.count(b" ") + 1, phrase.decode("utf-8", "replace"), f, None if doc == _NONE else doc))
        columns = zip(*rows) if rows else [[]] * len(_FOUND)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, total = None, {}, None
        for batch in batches:
            for bucket, lang, n, block in zip(*[batch.column(c).to_pylist() for c in ("bucket", "lang", "n", "block")]):
                if at is not None and at != (bucket, lang):
                    yield told(at[1], held, total)
                    held, total = {}, None
                at = bucket, lang
                if n == 0:
                    total = (total or 0) + int.from_bytes(block, "little")
                    continue
                data = zlib.decompress(block)
                counts, docs = np.frombuffer(data, "<i8", 2 * n).reshape(2, n).tolist()
                for phrase, f, doc in zip(data[16 * n :].split(b"\n"), counts, docs):
                    before = held.get(phrase)
                    held[phrase] = (f, doc) if before is None else (before[0] + f, min(before[1], doc))
        if at is not None:
            yield told(at[1], held, total)

    return run


def _filter_words(blocks: DataFrame, least: int, bits: int, buckets: int) -> np.ndarray:
    """The table of bits of frequent fingerprints: ``bits`` of them at most, whatever the corpus."""
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket")
    frequent = dealt.mapInArrow(_frequent(least, buckets), "fingerprint long")
    word = F.shiftright(F.col("fingerprint"), 6).bitwiseAND(F.lit(bits // 64 - 1).cast("long"))
    bit = F.expr("shiftleft(1L, cast(fingerprint & 63 AS int))")
    rows = frequent.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return words.view(np.uint64)


def count_phrases(
    documents: DataFrame, *, least: int = LEAST, bits: int = FILTER_BITS, buckets: int = BUCKETS
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases (lang, n_words, phrase, f, first_doc), and the word count of each lang (lang, n). Both settled."""
    spark = documents.sparkSession
    read = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    filters: dict[int, np.ndarray] = {}
    for sizes in ([1], [2], [3, 4]):
        held = spark.sparkContext.broadcast(filters)
        found = _filter_words(read.mapInArrow(_count(sizes, held, buckets), "bucket int, block binary"), least, bits, buckets)
        held.unpersist()
        filters = filters | {n: found for n in sizes}
    held = spark.sparkContext.broadcast(filters)
    blocks = read.mapInArrow(_materialise(held, PHRASE_BUCKETS), "bucket int, lang string, n int, block binary")
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket", "lang")
    stored = settle(dealt.mapInArrow(_exact(least), _FOUND_DDL))
    held.unpersist()
    totals = stored.where(F.col("n_words") == 0).select("lang", F.col("f").alias("n"))
    return stored.where(F.col("n_words") > 0), totals


def rank_phrases(phrases: DataFrame, totals: DataFrame, *, top: int = TOP) -> DataFrame:
    """The best candidates of each lang by their weakest cut.

    Order: score, then count, both descending, then the phrase by its bytes.
    """
    counts = phrases.select("lang", "phrase", "f")
    longer = phrases.where(F.col("n_words") >= 2).withColumn("words", F.split("phrase", " "))
    cut = longer.select("lang", "phrase", F.col("f").alias("a"), "first_doc", "words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    text = lambda at, size: F.array_join(F.slice("words", at, size), " ")
    parts = cut.select(
        "lang", "phrase", "a", "first_doc", "k",
        text(F.lit(1), F.col("k")).alias("left"),
        text(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    # A phrase is as frequent as its parts at most, so both are there.
    with_l = join_hot(parts, counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    with_r = join_hot(settle(with_l), counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    score = F.expr(f"cast((cast(a AS decimal(19, 0)) * {SCALE}) div (cast(l AS decimal(19, 0)) + r) AS bigint)")
    weakest = with_r.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("first_doc").alias("first_doc"),
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"),
    )
    inner = F.transform(
        F.sequence(F.lit(2), F.size("words") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.size("words") - size + 1), lambda at: F.array_join(F.slice("words", at, size), " ")),
    )
    around = longer.where(F.col("n_words") >= 3).select("lang", F.explode(F.array_distinct(F.flatten(inner))).alias("phrase"), "f")
    covers = around.groupBy("lang", "phrase").agg(F.max("f").alias("cover"))
    hundred = F.expr("100 * cast(cover AS decimal(19, 0))") >= F.expr(f"{COVERED_PERCENT} * cast(a AS decimal(19, 0))")
    open_ = weakest.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(hundred, F.lit(False)))
    scored = open_.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score", "first_doc")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "first_doc")


def mine_phrases(documents: DataFrame, *, least: int = LEAST, top: int = TOP, bits: int = FILTER_BITS) -> DataFrame:
    """Collocations of each lang: rank, phrase, its counts, score, and the smallest doc_id that holds it."""
    phrases, totals = count_phrases(documents, least=least, bits=bits)
    return rank_phrases(phrases, totals, top=top)
