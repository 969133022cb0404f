"""URL filter: rules on host and path, and a list of canonical URLs behind a blocked Bloom filter.

The listed URLs set bits in blocks of 256 (four words of 64): one hash picks the
block, and eight slices of a second one the bits, so a lookup reads one row of the filter.
The filter is a table of (block, words), built by one OR-aggregate and broadcast; its
number of blocks has a fixed upper bound, whatever the list's length. A longer list
means fuller blocks and more false hits, never another result: possible hits go to an
exact hash join with the list. URLs are made distinct first, and the page rows then meet
one row a URL at most, so adaptive execution can split the pages of a hot URL.

Defined cases: a NULL url, or one without ``://``, has empty host and path, fits no
rule, is on no list and is allowed. Repeated rows are judged each, very long URLs are read whole. Empty tables, of
pages or of listed URLs, are fine. A tie of rules of equal length goes to the one named
first. Other columns of the pages are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.rows import join_hot
from strataflow.session import settle

#: Fixed values of the contract: host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: Sites whose pages make up the list of the registered query.
LISTED_SITES = ("ads-track", "spam-farm", "casino-win", "adult-x", "cheap-pills", "free-bets")
BITS_PER_URL = 16
WORDS, PROBES = 4, 8
#: 32 MB of words at most, some 100 MB as a hash relation.
MAX_BLOCKS = 1 << 20
#: Query parameters that don't change what a page shows.
TRACKING = r"(?:utm_[^=&]*|ref|gclid|fbclid|sessionid)(?:=[^&]*)?"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without closing slash, query without tracking parameters.

    Scheme and fragment go; remaining parameters are sorted. NULL where there is no ``://``.
    """
    host = F.regexp_replace(host_of(url), r"^www\.|:(?:80|443)$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}$"))
    joined = F.array_join(F.array_sort(kept), "&")
    full = F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))
    return F.when(url.contains("://"), full)


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _probes(url: Column, blocks: int) -> tuple[Column, list[tuple[int, Column]]]:
    """Block, and for each probe the word it falls in and its bit; each word is hit twice."""
    block = F.pmod(F.xxhash64(url), F.lit(blocks))
    second = F.xxhash64(url, F.lit("bits"))

    def bit(i: int) -> Column:
        place = F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    return block, [(i % WORDS, bit(i)) for i in range(PROBES)]


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, w0..w3) of the blocks that have bits."""
    block, probes = _probes(F.col(url), blocks)
    words = [None] * WORDS
    for word, bit in probes:
        words[word] = bit if words[word] is None else words[word].bitwiseOR(bit)
    return listed.groupBy(block.alias("block")).agg(*[F.bit_or(w).alias(f"w{i}") for i, w in enumerate(words)])


def possible_hits(rows: DataFrame, url: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Rows whose URL may be on the list: all that are, and few others."""
    block, probes = _probes(F.col(url), blocks)
    found = rows.withColumn("block", block).join(F.broadcast(bloom), "block")
    hit = F.lit(True)
    for word, bit in probes:
        hit = hit & (F.col(f"w{word}").bitwiseAND(bit) != 0)
    return found.where(hit).select(*rows.columns)


def on_list(rows: DataFrame, listed: DataFrame, url: str, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Rows (any columns, ``url`` among them) whose URL is in ``listed`` (one column ``url``, distinct)."""
    known = settle(listed.where(F.col(url).isNotNull()).select(url).distinct())
    blocks = max(1, min(max_blocks, -(-known.count() * BITS_PER_URL // (64 * WORDS))))
    return possible_hits(rows, url, bloom_filter(known, url, blocks), blocks).join(known, url)


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, max_blocks: int = MAX_BLOCKS
) -> DataFrame:
    """One row a page: host, path, the rule that fits, whether its URL is listed, and the verdict.

    ``listed`` has canonical URLs in a column ``canonical``. A rule's verdict wins;
    without one listed URLs are blocked and others allowed.
    """
    url = F.col("url")
    read = pages.select(
        F.struct("page_id", "url").alias("page"), host_of(url).alias("host"), path_of(url).alias("path"), canonical(url).alias("canonical")
    )
    rows = read.withColumn("best", best_rule(F.col("host"), F.col("path"), rules))
    # Distinct URLs first: the page rows themselves only meet the hits.
    hits = on_list(rows.where(F.col("canonical").isNotNull()).select("canonical").distinct(), listed, "canonical", max_blocks)
    # Rows without a canonical URL meet nothing; a number deals them out instead of the NULL.
    dealt = F.when(F.col("canonical").isNull(), F.monotonically_increasing_id())
    rows = rows.withColumn("deal", F.coalesce(dealt, F.lit(-1).cast("long")))
    judged = join_hot(rows, hits.select("canonical", F.lit(-1).cast("long").alias("deal"), F.lit(True).alias("hit")), ["canonical", "deal"], "left")
    hit = F.coalesce("hit", F.lit(False))
    return judged.select(
        F.col("page.page_id").alias("page_id"),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(hit, "block").otherwise("allow")).alias("verdict"),
        hit.alias("listed"),
    )
