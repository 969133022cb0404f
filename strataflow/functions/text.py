"""Text keys, cell cleaning, formatting and URL titles."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.parsing import bind, col_of

_NON_ASCII = r"[^\x00-\x7f]"


@lru_cache(maxsize=1)
def _fold_table() -> tuple[str, str, dict[str, str]]:
    """How characters fold to ``a-z0-9`` under NFKD with combining marks dropped.

    Spark has no Unicode normalisation, but a name key keeps ASCII letters and
    digits only, so the rule reduces to a table: characters that become one
    ASCII character, marks that vanish, and the few that become several.
    """
    one_from, one_to, gone, many = [], [], [], {}
    keep = set("abcdefghijklmnopqrstuvwxyz0123456789")
    for point in range(128, sys.maxunicode + 1):
        if 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        if not unicodedata.decomposition(char) and not unicodedata.combining(char):
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if not base:
            gone.append(char)
        elif keep.intersection(base):
            if len(base) == 1:
                one_from.append(char)
                one_to.append(base)
            else:
                many[char] = base
    return "".join(one_from + gone), "".join(one_to), many


def _class_of(chars: Iterable[str], gap: int = 64) -> str:
    """Regular-expression class of a few ranges that hold all the characters, and some between."""
    ranges: list[list[int]] = []
    for point in sorted(map(ord, chars)):
        if ranges and point - ranges[-1][1] <= gap:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(rf"\x{{{lo:x}}}-\x{{{hi:x}}}" for lo, hi in ranges) + "]"


def fold_accents(value: Column | str) -> Column:
    """Replace every character by its ASCII base; the others are left as they are."""
    source, target, many = _fold_table()
    pairs = F.str_to_map(F.lit("\x01".join(f"{c}\x02{base}" for c, base in many.items())), F.lit("\x01"), F.lit("\x02"))

    some = _class_of(many)

    def spread(single: Column) -> Column:
        # Runs between these characters are taken whole.
        parts = F.regexp_extract_all(single, F.lit(f"{some}|[^{some[1:-1]}]+"), F.lit(0))
        letters = F.array_join(F.transform(parts, lambda p: F.when(F.length(p) == 1, F.coalesce(pairs[p], p)).otherwise(p)), "")
        return F.when(single.rlike(some), letters).otherwise(single)

    return bind(
        value,
        lambda text: F.when(
            text.rlike(_NON_ASCII), bind(F.translate(text, source, target), spread)
        ).otherwise(text),
    )


def name_key(value: Column | str) -> Column:
    """Join key of a name: lower case, no accents, runs of other characters to one blank."""
    folded = fold_accents(F.lower(col_of(value)))
    return F.coalesce(F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " ")), F.lit(""))


def collapse_space(value: Column | str) -> Column:
    return F.trim(F.regexp_replace(col_of(value), r"(?U)[\s\x1c-\x1f]+", " "))


def clean_cell(value: Column | str) -> Column:
    """Drop ``[...]`` foot-note marks, then collapse white space."""
    return collapse_space(F.regexp_replace(col_of(value), r"\[[^\]]*\]", ""))


def fixed_point(label: Column | str, value: Column | str, digits: int = 3) -> Column:
    return F.format_string(f"%s: %.{digits}f", col_of(label), col_of(value))


def url_path(url: Column | str) -> Column:
    """Path of a URL without query, fragment or trailing parameters."""
    path = F.regexp_extract(col_of(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def page_title(url: Column | str) -> Column:
    """What follows the first ``/wiki/`` of the path, else the path, percent-decoded."""
    path = url_path(url)
    raw = F.when(
        F.contains(path, F.lit("/wiki/")), F.regexp_extract(path, r"(?s)^.*?/wiki/(.*)$", 1)
    ).otherwise(F.regexp_replace(path, r"^/+", ""))
    # In a path a plus sign is itself, and so is a percent sign without two hex digits.
    safe = F.regexp_replace(F.replace(raw, F.lit("+"), F.lit("%2B")), "%(?![0-9a-fA-F]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), raw)


def partition_value(path: Column | str, name: str) -> Column:
    """Value of a ``name=value`` folder in a path, NULL when there is none."""
    found = F.regexp_extract(F.replace(col_of(path), F.lit("\\"), F.lit("/")), rf"(?:^|/){name}=([^/]+)", 1)
    return F.nullif(found, F.lit(""))
