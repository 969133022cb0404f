"""Secret scan: patterns find candidates, corpus-wide ownership tells live ones from copied examples.

Base spans (kinds assign, access and hex) are always kept. Besides them come weaker
candidates: assigned values of 8 to 11 characters (``short``) and long runs that mix
digits with both cases (``mixed``). The hash of each candidate value is counted over the
whole corpus by distinct repositories and distinct owners. A weak candidate becomes a
span only where its value belongs to one owner and few repositories, as live credentials
do; a value that several owners or many repositories have is a copied example. Base
values are told apart in the same way, in ``n_live`` and ``n_shared``.

Positions are not collected per text in Python: the gaps that ``split`` leaves and the
lengths of the matches add up to them.

Defined cases: NULL and empty texts have no spans; repeated rows and rows with equal or
NULL ids each get a row (they are told apart by a row number); a NULL owner or
repository counts as one more owner or repository; a very long text is read whole, its matches in
chunks; spans that begin together go by kind; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.rows import join_hot
from strataflow.session import settle

#: Fixed patterns of the contract. A shorter access or hex run can't be part of a longer one.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
ASSIGN_LEAST = 12
#: Weak candidates.
MIXED = "[A-Za-z0-9+/_-]{24,}"
SHORT_LEAST = 8
KINDS = ("assign", "access", "hex", "short", "mixed")
LIVE_OWNERS = 1
#: Repositories of its owner that a live value is in at most; a value in more is a copied example.
LIVE_REPOSITORIES = 5

_SPAN = "struct<start: bigint, end: bigint, value: string>"
_CHUNK = 256


def found_spans(text: Column, pattern: str, value_group: int = 0) -> Column:
    """Array of (start, end, value) of the matches, leftmost and apart, in code points.

    A running sum over gap and match lengths, in chunks, so that a text with very
    many matches doesn't copy one long array for each of them.
    """
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.char_length(gap).cast("long"))
    parts = F.arrays_zip(
        gaps.alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )
    none = F.array().cast(f"array<{_SPAN}>")

    def step(state, part):
        start = state["at"] + part["gap"]
        end = start + F.char_length(part["match"])
        span = F.struct(start.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    def chunk(parts, at, number):
        first = F.struct(at.alias("at"), none.alias("out"))
        return F.aggregate(F.slice(parts, number * _CHUNK + 1, F.lit(_CHUNK)), first, step)

    def outer(parts):
        # The last gap has no match behind it.
        matches = F.slice(parts, F.lit(1), F.size(parts) - 1)
        numbers = F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / _CHUNK).cast("int"))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<array<{_SPAN}>>").alias("out"))
        merge = lambda state, number: F.transform(
            F.array(chunk(matches, state["at"], number)),
            lambda got: F.struct(got["at"].alias("at"), F.concat(state["out"], F.array(got["out"])).alias("out")),
        )[0]
        return F.flatten(F.aggregate(numbers, start, merge)["out"])

    some = F.transform(F.array(parts), outer)[0]
    return F.when(text.rlike(pattern), some).otherwise(none)


def _kind(spans: Column, kind: str, keep) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        F.filter(spans, keep),
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.xxhash64(s["value"]).alias("value")
        ),
    )


def scan(documents: DataFrame, owner: str, repository: str, row: str = "row") -> DataFrame:
    """One narrow row a document: a row number, owner, repository, base spans and weak ones."""
    text = F.coalesce(F.col("text"), F.lit(""))
    raw = documents.select(
        F.monotonically_increasing_id().alias(row),
        "doc_id",
        F.col(owner).cast("string").alias("owner"),
        F.col(repository).cast("string").alias("repository"),
        found_spans(text, ASSIGN, 2).alias("assign"),
        found_spans(text, ACCESS).alias("access"),
        found_spans(text, HEX).alias("hex"),
        found_spans(text, MIXED).alias("mixed"),
    )
    size = lambda s: F.char_length(s["value"])
    every = lambda s: F.lit(True)
    weak = F.concat(
        _kind(F.col("assign"), "short", lambda s: size(s).between(SHORT_LEAST, ASSIGN_LEAST - 1)),
        _kind(
            F.col("mixed"),
            "mixed",
            lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]"),
        ),
    )
    base = F.concat(
        _kind(F.col("assign"), "assign", lambda s: size(s) >= ASSIGN_LEAST),
        _kind(F.col("access"), "access", every),
        _kind(F.col("hex"), "hex", every),
    )
    return settle(raw.select(row, "doc_id", "owner", "repository", F.array_sort(base).alias("base"), weak.alias("weak")))


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each value; every step combines before its shuffle."""
    repositories = candidates.select("value", "owner", "repository").distinct()
    owners = repositories.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owners.groupBy("value").agg(F.sum("n").alias("repositories"), F.count(F.lit(1)).alias("owners"))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined, by start and then by kind."""
    names = F.array(*[F.lit(k) for k in KINDS])
    entry = lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, entry), ",")


def find_secrets(
    documents: DataFrame,
    owner: str = "source",
    repository: str = "doc_id",
    live_owners: int = LIVE_OWNERS,
    live_repositories: int = LIVE_REPOSITORIES,
) -> DataFrame:
    """One row a document: doc_id, base spans, all spans, and how many values are live or shared."""
    scanned = scan(documents, owner, repository)
    some = scanned.where((F.size("base") > 0) | (F.size("weak") > 0))
    candidates = some.select("row", "owner", "repository", F.explode(F.concat("base", "weak")).alias("span")).select(
        "row", "owner", "repository", "span", F.col("span.value").alias("value")
    )
    told = join_hot(candidates, ownership(candidates), "value")
    live = (F.col("owners") <= live_owners) & (F.col("repositories") <= live_repositories)
    is_base = F.col("span.rank") <= KINDS.index("hex")
    # Only spans that become part of the result are gathered, and only those of one text.
    per_row = told.groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(is_base | live, F.col("span")))).alias("spans"),
        F.count_if(live).alias("n_live"),
        F.count_if(~live).alias("n_shared"),
    )
    none = F.array().cast(scanned.schema["base"].dataType)
    return scanned.join(per_row, "row", "left").select(
        "doc_id",
        "base",
        F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_shared", F.lit(0)).cast("long").alias("n_shared"),
    )


def secret_digest(documents: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["rank"] == KINDS.index(kind))).cast("long")
    return find_secrets(documents).select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
        "n_live",
        "n_shared",
    )
