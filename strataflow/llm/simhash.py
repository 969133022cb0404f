"""SimHash near-duplicates: fingerprints, linked by vantage-point trees, joined to components.

Fingerprint: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, shingles of
three (repeats included; a shorter text is one shingle), XXH64 with seed 42 of each; a
bit is set where over half of the hashes have it. A text without words has fingerprint
zero and is linked like any other. Fingerprints link at ``radius`` differing bits or fewer.

Only distinct fingerprints are searched. A vantage-point tree over a bounded sample deals
them to shards: a point goes near or far by its Hamming distance to the vantage point. A
point so close to the border that the ball of the radius reaches over it is sent into
the far side as a query too, so each pair meets in the shard of one of the two, and the
search is exact; the sample only decides how even the shards are. In a shard a tree over
its own points prunes by the same bounds down to small buckets. A shard hands back a
spanning forest of its links, at most one edge a row, never all pairs. Components come
from alternating star contraction of the edges, each round a settled table.

Defined cases: NULL text counts as empty; repeated rows and rows with equal ids are rows;
``component_id`` is the smallest doc_id in reach (NULLs are left out, and a component of
NULLs alone has NULL); texts under one id that don't link are components of their own;
an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from strataflow.llm.rows import join_hot
from strataflow.session import settle

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Points of a shard: a fixed size at first, then with the root of their number, as queries repeat with depth.
SHARD_POINTS, SHARD_ROOT = 2000, 4
#: Sample points behind each shard, and at most in all (documented bound of the collected sample).
SAMPLE_PER_SHARD, SAMPLE_MOST = 32, 1_000_000
BUCKET = 128
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    count = max(1, len(words) - SHINGLE + 1)
    starts = np.concatenate(([0], ends[:-1] + 1))[:count].tolist()
    stops = ends[len(words) - count :].tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    bits = np.zeros(64, np.int64)
    for at in range(0, count, _HASHES_AT_ONCE):
        until = at + _HASHES_AT_ONCE
        hashes = np.array([digest(view[a:b], SEED) for a, b in zip(starts[at:until], stops[at:until])], "<u8")
        bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > count, bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def fingerprints(text: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in text], dtype="int64")


def _distance(points: np.ndarray, vantage: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


def _border(distances: np.ndarray) -> int | None:
    """Greatest distance of the near half; None where all are equal."""
    middle = int(np.median(distances))
    if middle < distances.max():
        return middle
    return middle - 1 if distances.min() < middle else None


def build_tree(sample: np.ndarray, least: int, tries: int = 8) -> np.ndarray:
    """Rows (vantage, border, near, far); a negative child is shard -1 - child."""
    nodes: list[list[int]] = []
    shards = 0

    def grow(points: np.ndarray) -> int:
        nonlocal shards
        best = None
        if len(points) >= 2 * least:
            for vantage in points[:: max(1, len(points) // tries)][:tries]:
                apart = _distance(points, vantage)
                if (border := _border(apart)) is None:
                    continue
                # Points that must look on both sides, and how uneven the halves are.
                crossing = ((apart >= border - RADIUS + 1) & (apart <= border + RADIUS)).sum() + abs(2 * (apart <= border).sum() - len(points))
                if best is None or crossing < best[0]:
                    best = (crossing, vantage, border, apart)
        if best is None:
            shards += 1
            return -shards
        _, vantage, border, apart = best
        at = len(nodes)
        nodes.append([int(vantage.astype(np.int64)), border, 0, 0])
        nodes[at][2] = grow(points[apart <= border])
        nodes[at][3] = grow(points[apart > border])
        return at

    if grow(sample) < 0:
        return np.zeros((0, 4), np.int64)
    return np.array(nodes, np.int64)


def route(points: np.ndarray, tree: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(shard, points, whether it is their home) for all shards the points go to."""
    if not len(tree):
        yield 0, points, True
        return
    stack = [(0, points, True)]
    while stack:
        node, here, home = stack.pop()
        if not len(here):
            continue
        if node < 0:
            yield -1 - node, here, home
            continue
        vantage, border, near, far = tree[node]
        apart = _distance(here, np.int64(vantage).astype(np.uint64))
        if home:
            inner = apart <= border
            stack += [(int(near), here[inner], True), (int(far), here[~inner], True)]
            stack.append((int(far), here[inner & (apart + radius > border)], False))
        else:
            stack.append((int(near), here[apart - radius <= border], False))
            stack.append((int(far), here[apart + radius > border], False))


def close_pairs(points: np.ndarray, queries: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within the radius: points among themselves, and queries against points.

    Indices count the points first and then the queries.
    """
    every = np.concatenate((points, queries))
    stack = [(np.arange(len(points)), np.arange(len(points), len(every)))]
    while stack:
        own, asking = stack.pop()
        if not len(own):
            continue
        border = None
        if len(own) > BUCKET:
            vantage = every[own[len(own) // 2]]
            apart = _distance(every[own], vantage)
            border = _border(apart)
        if border is None:
            both = np.concatenate((own, asking))
            for at in range(0, len(both), 1024):
                some = both[at : at + 1024]
                q, p = np.nonzero(np.bitwise_count(every[some][:, None] ^ every[own][None, :]) <= radius)
                a, b = some[q], own[p]
                keep = a != b
                yield a[keep], b[keep]
            continue
        asked = _distance(every[asking], vantage)
        inner = apart <= border
        reach = own[inner & (apart + radius > border)]
        stack.append((own[inner], asking[asked - radius <= border]))
        stack.append((own[~inner], np.concatenate((asking[asked + radius > border], reach))))


def spanning_forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index each index is joined to."""
    parent = np.arange(n)
    for a, b in pairs:
        while len(a):
            low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
            open_ = low != high
            a, b, low, high = a[open_], b[open_], low[open_], high[open_]
            np.minimum.at(parent, high, low)
            while not np.array_equal(up := parent[parent], parent):
                parent = up
    return parent


def near_links(points: DataFrame, column: str = "fingerprint", radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that join all distinct fingerprints within the radius of each other, and no others."""
    spark, total = points.sparkSession, points.count()
    shard_points = max(SHARD_POINTS, SHARD_ROOT * isqrt(total))
    one_in = max(1, shard_points // SAMPLE_PER_SHARD, -(-total // SAMPLE_MOST))
    picked = points.where(F.pmod(F.xxhash64(column), F.lit(one_in)) == 0).select(column).collect()
    sample = np.sort(np.array([r[0] for r in picked], np.int64)).astype(np.uint64)
    tree = spark.sparkContext.broadcast(build_tree(sample, max(2, shard_points // one_in // 2)))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard, here, home in route(frame[column].to_numpy(np.int64).astype(np.uint64), tree.value, radius):
                yield pd.DataFrame({"shard": np.int32(shard), "point": here.astype(np.int64), "home": home})

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(frame.loc[frame["home"], "point"].to_numpy(np.int64))
        asking = np.unique(frame.loc[~frame["home"], "point"].to_numpy(np.int64))
        every = np.concatenate((values, asking))
        parent = spanning_forest(
            len(every), close_pairs(values.astype(np.uint64), asking.astype(np.uint64), radius)
        )
        moved = parent != np.arange(len(every))
        return pd.DataFrame({"a": every[moved], "b": every[parent[moved]]})

    dealt = points.select(column).mapInPandas(deal, "shard int, point long, home boolean")
    return dealt.groupBy("shard").applyInPandas(join, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes with an edge: the least node of the component.

    Alternates large and small star until nothing changes. The least neighbour of a
    node is a partial aggregate, and a hot node's edges are never gathered.
    """
    now = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = join_hot(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        down = settle(large.where("a <> b").distinct())
        lowest = down.groupBy("a").agg(F.min("b").alias("least"))
        small = join_hot(down, lowest, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        stars = small.unionByName(lowest.select("a", F.col("least").alias("b"))).where("a <> b").distinct()
        now = settle(stars)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen


def component_ids(rows: DataFrame, radius: int = RADIUS, links: DataFrame | None = None) -> DataFrame:
    """(fingerprint, root, component_id) of rows (doc_id, fingerprint), one row a distinct fingerprint.

    The root tells components apart even where they have no id or the same one. ``links``
    are further edges (a, b) of fingerprints.
    """
    classes = settle(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    edges = near_links(classes, radius=radius)
    roots = components(edges if links is None else edges.unionByName(links))
    rooted = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    # A component's classes are rows of one key here.
    return join_hot(rooted, firsts, "root").select("fingerprint", "root", "component_id")


def near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row a document: doc_id, fingerprint, component_id."""
    rows = settle(documents.select("doc_id", fingerprints("text").alias("fingerprint")))
    return rows.join(component_ids(rows, radius), "fingerprint").select("doc_id", "fingerprint", "component_id")


def hex_digits(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def duplicate_digest(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents).select("doc_id", hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def drop_near_duplicates(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component, with all columns: that of the smallest doc_id, the first of equal ones.

    The rows are settled with their fingerprint and a row number, so that the texts
    are read once for it and pass one shuffle, the last join.
    """
    packed = settle(
        documents.select(
            F.struct("*").alias("document"), "doc_id", fingerprints("text").alias("fingerprint"), F.monotonically_increasing_id().alias("row")
        )
    )
    return first_rows(packed, component_ids(packed.select("doc_id", "fingerprint"), radius))


def first_rows(packed: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents of settled rows (document, doc_id, fingerprint, row) that come first in their component."""
    named = packed.select("doc_id", "fingerprint", "row").join(ids, "fingerprint")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("late"), F.col("doc_id"), F.col("row")))
    stay = named.groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    return packed.join(stay, "row", "left_semi").select("document.*")
