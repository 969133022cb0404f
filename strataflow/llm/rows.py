"""Row numbers and joins that hold up when one key has a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataflow.operators.dedup import comparable
from strataflow.session import settle

_BITS = 33  # of the row's place in its partition, in monotonically_increasing_id


def number_rows(df: DataFrame, order: Sequence[Column | str], number: str) -> tuple[DataFrame, int]:
    """``df`` with dense numbers from 0 in the given order, and how many rows there are.

    Rows are dealt by range and sorted; each partition is counted, and the counts
    (one row a partition) give the number of its first row. Ties go by a hash of the whole
    row, so a table gives the same numbers however its files are cut. Rows equal in every column, which
    it doesn't matter how to number, go by their place in the input: that spreads
    them over partitions, so a repeated row can fill more than one task. The sorted rows are
    settled, so that all later steps see one and the same order. ``df`` should be a scan
    or a settled table with row-local expressions: then a retried task reads its rows in
    the same order and repeats its tie-breaks.
    """
    tie, place, at, part = f"{number}_tie", f"{number}_place", f"{number}_at", f"{number}_part"
    keys = [F.col(o) if isinstance(o, str) else o for o in order] + [F.col(tie), F.col(place)]
    placed = df.withColumns({tie: F.xxhash64(*comparable(df)), place: F.xxhash64(F.monotonically_increasing_id())})
    ordered = placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie, place)
    stored = settle(ordered.withColumn(at, F.monotonically_increasing_id()))
    counts = stored.groupBy(F.shiftright(at, _BITS).alias(part)).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    in_part = F.col(at).bitwiseAND(F.lit((1 << _BITS) - 1))
    numbered = stored.withColumn(part, F.shiftright(at, _BITS)).join(F.broadcast(firsts), part)
    return numbered.withColumn(number, F.col("first") + in_part).drop(at, part, "first"), total


def join_hot(many: DataFrame, one: DataFrame, keys: str | Sequence[str], how: str = "inner") -> DataFrame:
    """``many`` joined to ``one``, which has one row a key at most.

    Adaptive execution splits a hot key only where both sides come straight out of a
    shuffle, which an aggregate or join on the same key does not. So ``one`` is settled
    and shuffled anew; the hint keeps it from being repeated to every executor.
    """
    return many.join(settle(one).hint("merge"), keys, how)
