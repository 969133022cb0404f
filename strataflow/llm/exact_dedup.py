"""Exact dedup: Patricia tries own the texts of a length-and-content-hash partition.

Texts are equal when their bytes are, after lower-casing A-Z. Of each group of equal
texts one row is its owner.

1. Length and XXH64 of every text are counted. Keys that two rows share set bits of a
   filter of ``FILTER_WORDS`` words at most, which bounds its broadcast. A row whose bit is
   not set is alone, and its text goes nowhere. False hits, more of them the fuller
   the filter is, only send a text too many on.
2. Each scan task inserts the texts of the other rows whole into a compressed radix trie. A
   terminal node holds the smallest identifier (by the wanted order) and a count, so a
   text copied into a third of the rows leaves a task once.
3. The terminals are dealt by length and hash and inserted again, where tasks meet.
4. Rows find their group through (task, terminal), a key that one task's rows share at most.

A trie beyond ``TRIE_BYTES`` spills by subtree: the largest branch is cut off, its terminals are handed on, and later texts that lead there follow them. While scanning
that only means less combining. Where tasks meet, what was handed on is dealt anew in a
further round, until none is left; what isn't cut off is settled in each round.

Defined cases: a NULL text counts as empty, and all of them are equal; a NULL doc_id comes after all
others when the owner is chosen; of rows that repeat the owner's doc_id exactly one is kept;
a text longer than the bound has a trie of its own; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FILTER_WORDS = 1 << 22
TRIE_BYTES = 128 << 20
#: What a node takes besides its label, about.
NODE_BYTES = 400
#: Text bytes handed over at once, about.
_HANDED = 8 << 20

LABEL, CHILDREN, TERMINAL = 0, 1, 2


def _common(a: bytes, data: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``data[at:]``, by halving."""
    low, high = 0, min(len(a), len(data) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == data[at + low : at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Compressed radix trie over byte strings. A node is [label, children by first byte, terminal]."""

    def __init__(self):
        self.root = [b"", {}, None]
        self.bytes = 0
        #: Beginnings of texts whose subtree was cut off.
        self.cuts: tuple[bytes, ...] = ()

    def leads_out(self, data: bytes) -> bool:
        return data.startswith(self.cuts)

    def node(self, data: bytes) -> list:
        """The node of a text, made if it isn't there."""
        node, at = self.root, 0
        while at < len(data):
            child = node[CHILDREN].get(data[at])
            if child is None:
                leaf = [data[at:], {}, None]
                node[CHILDREN][data[at]] = leaf
                self.bytes += len(leaf[LABEL]) + NODE_BYTES
                return leaf
            label = child[LABEL]
            if data.startswith(label, at):
                node, at = child, at + len(label)
                continue
            shared = _common(label, data, at)
            middle = [label[:shared], {label[shared]: child}, None]
            child[LABEL] = label[shared:]
            node[CHILDREN][data[at]] = middle
            self.bytes += NODE_BYTES
            node, at = middle, at + shared
        return node

    def terminals(self, top: list | None = None, prefix: bytes = b"") -> Iterator[tuple[bytes, object]]:
        """(text, terminal) below a node, which is the root if none is named."""
        stack = [(self.root if top is None else top, prefix)]
        while stack:
            node, before = stack.pop()
            text = before + node[LABEL]
            if node[TERMINAL] is not None:
                yield text, node[TERMINAL]
            stack += [(child, text) for child in node[CHILDREN].values()]

    def spill(self) -> Iterator[tuple[bytes, object]]:
        """Cut off the largest child of the first node that has more than it, and give its terminals.

        A trie of one text has no such node and gives nothing.
        """
        node, path = self.root, b""
        while len(node[CHILDREN]) == 1 and node[TERMINAL] is None:
            (node,) = node[CHILDREN].values()
            path += node[LABEL]
        if not node[CHILDREN]:
            return iter(())
        sizes = {first: _weight(child) for first, child in node[CHILDREN].items()}
        first = max(sizes, key=lambda k: (sizes[k], k))
        top = node[CHILDREN].pop(first)
        self.bytes -= sizes[first]
        self.cuts += (path + bytes([first]),)
        return self.terminals(top, path)


def _weight(top: list) -> int:
    total, stack = 0, [top]
    while stack:
        node = stack.pop()
        total += len(node[LABEL]) + NODE_BYTES
        stack += node[CHILDREN].values()
    return total


def _rank(doc_id, largest: bool, part: int, row: int) -> tuple:
    """Smaller is better."""
    return (doc_id is None, 0 if doc_id is None else -doc_id if largest else doc_id, part, row)


_SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("part", pa.int32()),
        ("row", pa.int64()),
        ("terminal", pa.int64()),
        ("length", pa.int64()),
        ("hash", pa.int64()),
        ("n", pa.int64()),
        ("text", pa.binary()),
    ]
)
_SCANNED_DDL = "doc_id long, digest binary, part int, row long, terminal long, length long, hash long, n long, text binary"
_OWNED = pa.schema(
    [
        ("part", pa.int32()),
        ("terminal", pa.int64()),
        ("keep_id", pa.int64()),
        ("keep_part", pa.int32()),
        ("keep_row", pa.int64()),
        ("size", pa.int64()),
        ("length", pa.int64()),
        ("hash", pa.int64()),
        ("text", pa.binary()),
    ]
)
_OWNED_DDL = (
    "part int, terminal long, keep_id long, keep_part int, keep_row long, size long, length long, hash long, text binary"
)


def _batches(rows: Iterator[tuple], schema: pa.Schema, text: int) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches; ``text`` is the place of the text in a row, which bounds a batch."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 100 + len(row[text] or b"")
        if size >= _HANDED:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _scan(batches: Iterator[pa.RecordBatch], largest: bool, bound: int) -> Iterator[tuple]:
    """A row for each document, and one for each terminal (which has a text) of the task's trie."""
    part = TaskContext.get().partitionId()
    trie, row, made = PatriciaTrie(), -1, 0

    def told(found):
        for text, (number, length, hashed, n, best) in found:
            yield (best[0], None, part, best[2], number, length, hashed, n, text)

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("doc_id", "norm", "length", "hash", "shared")]
        for doc_id, data, length, hashed, shared in zip(*columns):
            row += 1
            terminal = None
            if shared:
                if trie.bytes > bound:
                    # Copies that come later begin a terminal of their own.
                    yield from told(trie.spill())
                node = trie.node(data)
                best = (doc_id, _rank(doc_id, largest, part, row), row)
                if node[TERMINAL] is None:
                    node[TERMINAL] = [made, length, hashed, 1, best]
                    made += 1
                else:
                    node[TERMINAL][3] += 1
                    if best[1] < node[TERMINAL][4][1]:
                        node[TERMINAL][4] = best
                terminal = node[TERMINAL][0]
            yield (doc_id, hashlib.sha256(data).digest(), part, row, terminal, length, hashed, 1, None)
    yield from told(trie.terminals())


def _own(batches: Iterator[pa.RecordBatch], largest: bool, bound: int) -> Iterator[tuple]:
    """The owner of each terminal; one that was handed on has a text instead."""
    trie = PatriciaTrie()

    def handed(text, members, best, size, length, hashed):
        # Members of one node go on one by one; only the first of them carries the count.
        for at, (part, terminal) in enumerate(members):
            yield (part, terminal, best[0], best[1], best[2], size if at == 0 else 0, length, hashed, text)

    for batch in batches:
        names = ("doc_id", "part", "row", "terminal", "length", "hash", "n", "text", "owner_part")
        columns = [batch.column(name).to_pylist() for name in names]
        for doc_id, part, row, terminal, length, hashed, n, text, owner_part in zip(*columns):
            best = (doc_id, owner_part, row)
            if trie.leads_out(text):
                yield from handed(text, [(part, terminal)], best, n, length, hashed)
                continue
            node = trie.node(text)
            if node[TERMINAL] is None:
                node[TERMINAL] = [[(part, terminal)], best, n, length, hashed]
            else:
                held = node[TERMINAL]
                held[0].append((part, terminal))
                held[2] += n
                if _rank(best[0], largest, *best[1:]) < _rank(held[1][0], largest, *held[1][1:]):
                    held[1] = best
            if trie.bytes > bound:
                for cut, held in trie.spill():
                    yield from handed(cut, *held)
    for _, (members, best, size, _, _) in trie.terminals():
        for part, terminal in members:
            yield (part, terminal, best[0], best[1], best[2], size, None, None, None)


def shared_keys(keyed: DataFrame, words: int = FILTER_WORDS) -> DataFrame:
    """The filter: a row for each word that has a bit set, (word, bits), ``words`` rows at most."""
    shared = keyed.groupBy("length", "hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return shared.groupBy(_word(words).alias("word")).agg(F.bit_or(_bit()).alias("bits"))


def _word(words: int) -> Column:
    return F.pmod(F.shiftright("hash", 6), F.lit(words).cast("long"))


def _bit() -> Column:
    return F.expr("shiftleft(1L, cast(hash & 63 AS int))")


def dedup_exact(
    documents: DataFrame, *, keep: str = "smallest", filter_words: int = FILTER_WORDS, trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """One row a document: doc_id, keep_id, group_size, kept, text_sha256; ``keep`` says which doc_id owns a text."""
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    largest = keep == "largest"
    norm = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    lowered = documents.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"))
    keyed = lowered.select(
        "doc_id", F.col("norm").cast("binary").alias("norm"),
        F.octet_length("norm").cast("long").alias("length"), F.xxhash64("norm").alias("hash"),
    )
    bits = shared_keys(keyed.select("length", "hash"), filter_words)
    marked = keyed.withColumn("word", _word(filter_words)).join(F.broadcast(bits), "word", "left").select(
        "doc_id", "norm", "length", "hash", F.coalesce(F.col("bits").bitwiseAND(_bit()) != 0, F.lit(False)).alias("shared")
    )
    scanned = settle(marked.mapInArrow(lambda b: _batches(_scan(b, largest, trie_bytes), _SCANNED, 8), _SCANNED_DDL))
    rows = scanned.where(F.col("digest").isNotNull()).select("doc_id", "digest", "part", "row", "terminal")
    open_terminals = scanned.where(F.col("text").isNotNull()).select(
        "doc_id", "part", "row", "terminal", "length", "hash", "n", "text", F.col("part").alias("owner_part")
    )
    owned, round_ = None, 0
    while True:
        # Another dealing each round, so that what one task handed on spreads out.
        dealt = open_terminals.repartition("length", "hash", F.lit(round_))
        met = settle(dealt.mapInArrow(lambda b: _batches(_own(b, largest, trie_bytes), _OWNED, 8), _OWNED_DDL))
        done = met.where(F.col("text").isNull()).select("part", "terminal", "keep_id", "keep_part", "keep_row", "size")
        owned = done if owned is None else owned.unionByName(done)
        spilled = met.where(F.col("text").isNotNull())
        if spilled.isEmpty():
            break
        open_terminals = spilled.select(
            F.col("keep_id").alias("doc_id"), "part", F.col("keep_row").alias("row"), "terminal", "length", "hash",
            F.col("size").alias("n"), "text", F.col("keep_part").alias("owner_part"),
        )
        round_ += 1
    grouped = rows.where(F.col("terminal").isNotNull()).join(owned, ["part", "terminal"]).select(
        "doc_id", "keep_id", F.col("size").alias("group_size"),
        ((F.col("part") == F.col("keep_part")) & (F.col("row") == F.col("keep_row"))).alias("kept"), "digest",
    )
    alone = rows.where(F.col("terminal").isNull()).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest"
    )
    both = grouped.unionByName(alone)
    return both.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
