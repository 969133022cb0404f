"""Mixing sources to target weights by Pfair scheduling of blocks.

Rows of a source form blocks of ``block_rows``, and time runs in slots of a block each. Block
k of a source of weight w, weights adding up to 1, may not start before slot floor(k / w) and
must be out by ceil((k + 1) / w), in exact integers. Taking the earliest deadline among the
released blocks meets all deadlines, as the utilisation is one, so after any number of
slots each source is less than one block off its target weight. One rule holds for any
number of sources and any weights; no weight is rounded to a period.

Nothing is dropped: the mixture runs until each source was used whole, and a source that is
through begins again (``epoch`` counts).

Whose turn it is depends on all turns before, so the schedule is planned in order, by
two heaps with a record for each source and ``PLANNED`` slots at a time, and handed on as a
settled table. Rows never pass there: they are numbered, repeated and joined to their slots as DataFrames.
A slot is a block, so ``block_rows`` decides how long planning takes.

Defined cases: NULL is a source of its own, and so is the empty name; repeated rows
are rows; texts, however long, are not looked at; an empty table gives no rows; a source with fewer
rows than a block has one short block; sources due at once go by name. Input columns named
as an added one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from heapq import heappop, heappush
from itertools import islice
from math import fsum

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.rows import number_rows
from strataflow.session import settle

BLOCK_ROWS = 16
TEMPER = 0.85
#: Repeats of one row made in one task; more are dealt out first.
EPOCHS_PER_TASK = 1024
#: Weights are taken as integers of this sum, about.
WEIGHT_SUM = 2**44
#: Slots planned at a time, and those of one row that is handed over.
PLANNED, HANDED = 1 << 20, 1 << 12

ADDED = ("epoch", "slot", "place")


def whole_weights(weights: Sequence[float]) -> list[int]:
    if any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    total = fsum(weights)
    return [max(1, round(w / total * WEIGHT_SUM)) for w in weights]


def run_slots(weights: Sequence[int], blocks: Sequence[int]) -> int:
    """Slots until the last block of each source is due."""
    total = sum(weights)
    return max(-(-b * total // w) for b, w in zip(blocks, weights))


def whole_run(weights: Sequence[int], slots: int) -> Iterator[int]:
    """The source of each slot: of the released blocks the one that is due first."""
    total, done = sum(weights), [0] * len(weights)
    waiting, released = [(0, i) for i in range(len(weights))], []
    for t in range(slots):
        while waiting and waiting[0][0] <= t:
            i = heappop(waiting)[1]
            heappush(released, (-(-(done[i] + 1) * total // weights[i]), i))
        i = heappop(released)[1]
        done[i] += 1
        heappush(waiting, (done[i] * total // weights[i], i))
        yield i


def run_schedule(spark, weights: Sequence[int], slots: int) -> tuple[DataFrame, list[int]]:
    """One row a slot: the source's index and which of its blocks (``k``); and how many slots each source has."""
    done, turns, chunks, tables = [0] * len(weights), whole_run(weights, slots), [], []
    at = 0
    while at < slots:
        here = []
        for i in islice(turns, HANDED):
            here.append((i, done[i]))
            done[i] += 1
        chunks.append((at, here))
        at += len(here)
        if at == slots or len(chunks) * HANDED >= PLANNED:
            handed = spark.createDataFrame(chunks, "first long, plan array<struct<source: int, k: bigint>>")
            tables.append(settle(handed.select("first", F.posexplode("plan").alias("i", "s")).select(
                (F.col("first") + F.col("i")).alias("t"), "s.source", "s.k"
            )))
            chunks = []
    return reduce(DataFrame.unionByName, tables), done


def mix_sources(
    df: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    *,
    source: str = "source",
    order: Sequence[Column | str] = ("doc_id",),
    block_rows: int = BLOCK_ROWS,
    temper: float = TEMPER,
) -> DataFrame:
    """Rows with ``epoch``, ``slot`` of their block and ``place`` in it, the mixture being in (slot, place) order.

    Without ``weights`` a source of n rows weighs n ** ``temper``. Sources that
    ``weights`` doesn't name are an error, since leaving them out would drop rows.
    """
    spark, kept = df.sparkSession, [name for name in df.columns if name not in ADDED]
    orders = [F.col(o) if isinstance(o, str) else o for o in order]
    name = F.col(source).cast("string")
    packed = df.select(
        F.struct("*").alias("row"),
        F.coalesce(F.concat(F.lit("s"), name), F.lit("n")).alias("key"),
        *[c.alias(f"o{i}") for i, c in enumerate(orders)],
    )
    ranks = ["key", *[F.col(f"o{i}").asc_nulls_first() for i in range(len(orders))]]
    numbered, _ = number_rows(packed, ranks, "number")
    found = numbered.groupBy("key").agg(F.min("number").alias("start"), F.count(F.lit(1)).alias("n"))
    sources = sorted(found.collect(), key=lambda r: r["key"])
    if not sources:
        return numbered.select("row.*").select(
            *kept, F.lit(0).cast("long").alias("epoch"), F.lit(0).cast("long").alias("slot"), F.lit(0).cast("int").alias("place")
        )
    named = [None if r["key"] == "n" else r["key"][1:] for r in sources]
    if weights is not None and (missing := [x for x in named if x not in weights]):
        raise ValueError(f"no weight for sources {missing}")
    exact = whole_weights([float(r["n"]) ** temper if weights is None else weights[x] for r, x in zip(sources, named)])
    blocks = [-(-r["n"] // block_rows) for r in sources]
    schedule, parts = run_schedule(spark, exact, run_slots(exact, blocks))
    table = spark.createDataFrame(
        [(r["key"], i, r["start"], b, a) for i, (r, b, a) in enumerate(zip(sources, blocks, parts))],
        "key string, source int, start long, blocks long, part long",
    )
    placed = numbered.join(table, "key").select("row", "source", "blocks", "part", (F.col("number") - F.col("start")).alias("index"))
    emitted = placed.withColumn("block", F.expr(f"index div {block_rows}"))
    last = F.col("part") - 1
    if max(-(-a // b) for b, a in zip(blocks, parts)) > EPOCHS_PER_TASK:
        step = F.col("blocks") * EPOCHS_PER_TASK
        emitted = emitted.withColumn("block", F.explode(F.sequence("block", last, step))).repartition("source", "index", "block")
        last = F.least(last, F.col("block") + step - 1)
    timed = emitted.withColumn("k", F.explode(F.sequence(F.col("block"), last, F.col("blocks")))).join(schedule, ["source", "k"])
    return timed.select(
        *[F.col("row")[c].alias(c) for c in kept],
        F.expr("k div blocks").alias("epoch"),
        F.col("t").alias("slot"),
        F.expr(f"index % {block_rows}").cast("int").alias("place"),
    )
