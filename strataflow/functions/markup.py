"""HTML fragments as array expressions: elements, visible text, entities.

All of it is row-local, so pages are parsed where they are read: no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.parsing import bind, col_of
from strataflow.functions.text import clean_cell

_HIDDEN = r"(?is)<!--.*?-->|<(script|style|template)(?=[\s/>]).*?</\1\s*>"
_TAG = r"(?:</?[a-zA-Z](?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+>|</?[a-zA-Z][^>]*>|<![^>]*>|<\?[^>]*>)"
_ENTITY = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);?"

# Code points 128-159 of numeric references mean Windows-1252.
_CP1252 = {n: bytes([n]).decode("cp1252") for n in range(128, 160) if n not in (129, 141, 143, 144, 157)}


def _entity_table() -> dict[str, str]:
    """Named entities of HTML 5 without their semicolon, short names first."""
    names = {name.rstrip(";"): char for name, char in html5.items()}
    return {name: names[name] for name in sorted(names, key=lambda n: (len(n), n))}


def _code_point(number: Column) -> Column:
    """Character of a code point, by way of its four bytes in UTF-32."""
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(number.cast("bigint")), 8, "0")), "UTF-32")
    legacy = F.when(number.between(128, 159), _lookup(_CP1252)[number.cast("string")])
    return F.when(valid, F.coalesce(legacy, char)).otherwise(F.lit("\ufffd"))


def _lookup(table: dict) -> Column:
    """A constant map, written as one text literal to keep the plan small."""
    text = "\x01".join(f"{key}\x02{value}" for key, value in table.items())
    return F.str_to_map(F.lit(text), F.lit("\x01"), F.lit("\x02"))


def decode_entities(value: Column | str) -> Column:
    """Named and numeric character references to characters; unknown names stay."""

    def decode(token: Column) -> Column:
        body = F.rtrim(F.substring(token, 2, 64), F.lit(";"))
        decimal = F.substring(body, 2, 64).try_cast("int")
        hexadecimal = F.conv(F.substring(body, 3, 8), 16, 10).try_cast("int")
        return (
            F.when(~token.rlike(f"^{_ENTITY}$"), token)
            .when(token.rlike("^&#[xX]"), _code_point(F.coalesce(hexadecimal, F.lit(-1))))
            .when(token.startswith("&#"), _code_point(F.coalesce(decimal, F.lit(-1))))
            .otherwise(F.coalesce(_lookup(_entity_table())[body], token))
        )

    def decode_all(text: Column) -> Column:
        tokens = F.regexp_extract_all(text, F.lit(f"{_ENTITY}|[^&]+|&"), F.lit(0))
        return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(tokens, decode), "")).otherwise(text)

    return bind(value, decode_all)


def drop_hidden(html: Column | str) -> Column:
    """Remove comments, scripts and styles, whose text is never shown."""
    return F.regexp_replace(col_of(html), _HIDDEN, "")


def visible_text(fragment: Column | str) -> Column:
    """Text of a fragment, the pieces between tags joined by one blank."""
    spaced = F.regexp_replace(col_of(fragment), rf"(?U)(?:\s*+{_TAG}\s*+)++", " ")
    return F.trim(decode_entities(spaced))


def cell_text(fragment: Column | str) -> Column:
    return clean_cell(visible_text(fragment))


def tag_marks(tag: str) -> tuple[str, str]:
    """Patterns of where an opening and a closing tag begin; ``tag`` may be an alternation such as ``th|td``."""
    return rf"<(?:{tag})(?=[\s/>])", rf"</(?:{tag})(?=[\s>])"


def split_at(text: Column, *marks: str) -> Column:
    """Pieces of a text, each but the first beginning at a mark."""
    return F.split(text, rf"(?i)(?={'|'.join(marks)})")


def flat_or_nested(html: Column | str, tag: str, flat: Callable[[Column], Column], nested: Callable[[Column], Column]) -> Column:
    """``flat`` of the elements where the tag isn't nested in itself, which one regular expression finds; else ``nested`` of the text."""
    opening, _ = tag_marks(tag)
    # Possessive, so that long elements need neither backtracking nor stack.
    one_level = rf"(?i){opening}[^<]*+(?:<(?!/(?:{tag})[\s>])[^<]*+)*+"
    reopened = rf"(?i)^.[\s\S]*?{opening}"

    def find(text: Column) -> Column:
        return bind(
            F.regexp_extract_all(text, F.lit(one_level), F.lit(0)),
            lambda found: F.when(F.exists(found, lambda e: e.rlike(reopened)), nested(text)).otherwise(flat(found)),
        )

    return bind(html, find)


def elements(html: Column | str, tag: str) -> Column:
    """Every ``tag`` element in document order, as text without its closing tag.

    An element left open runs to the end of the text, and a closing tag that closes
    nothing is passed over.
    """
    opening, closing = tag_marks(tag)

    def nested(text: Column) -> Column:
        return bind(
            split_at(text, opening, closing),
            lambda pieces: F.transform(element_spans(pieces, tag), lambda s: joined(pieces, s)),
        )

    return flat_or_nested(html, tag, lambda found: found, nested)


def joined(pieces: Column, span: Column) -> Column:
    """Text of a span of pieces."""
    return F.array_join(F.slice(pieces, span["lo"] + 1, span["hi"] - span["lo"]), "")


#: Distances of a running fold by doubling; texts have fewer marks than their sum.
_DISTANCES = [1 << i for i in range(30)]


def _depths(steps: Column) -> Column:
    """Depth behind each of the steps +1 and -1, never below 0.

    A step is the function max(floor, x + shift). Functions are composed with those 1, 2, 4, ...
    places before, so n marks take n log n and no array grows.
    """
    functions = F.transform(steps, lambda s: F.struct(F.lit(0).alias("floor"), s.alias("shift")))

    def compose(found: Column, distance: Column) -> Column:
        def one(f: Column, i: Column) -> Column:
            return bind(
                F.get(found, i - distance),
                lambda before: F.when(before.isNull(), f).otherwise(
                    F.struct(
                        F.greatest(f["floor"], before["floor"] + f["shift"]).alias("floor"),
                        (before["shift"] + f["shift"]).alias("shift"),
                    )
                ),
            )

        return F.transform(found, one)

    distances = F.filter(F.array(*[F.lit(d) for d in _DISTANCES]), lambda d: d < F.size(steps))
    return F.transform(F.aggregate(distances, functions, compose), lambda f: F.greatest(f["floor"], f["shift"]))


def element_spans(pieces: Column, tag: str) -> Column:
    """Which pieces each element takes, as (lo, hi) in the order of their beginnings.

    Opening and closing tags are paired by depth: in the order of (depth, place) each is
    next to its partner.
    """
    opening, closing = tag_marks(tag)
    step = lambda p: F.when(p.rlike(rf"(?i)^{opening}"), 1).when(p.rlike(rf"(?i)^{closing}"), -1).otherwise(0)
    placed = F.filter(
        F.transform(pieces, lambda p, i: F.struct(i.alias("at"), step(p).alias("step"))), lambda m: m["step"] != 0
    )

    def pair(marks: Column) -> Column:
        def level(depths: Column) -> Column:
            # An element has the depth behind its opening tag, which is that before its closing tag.
            return F.transform(
                marks,
                lambda m, i: F.struct(
                    F.when(m["step"] == 1, F.get(depths, i)).otherwise(F.coalesce(F.get(depths, i - 1), F.lit(0))).alias("depth"),
                    m["at"].alias("at"),
                    m["step"].alias("step"),
                ),
            )

        def spans(ordered: Column) -> Column:
            def span(m: Column, i: Column) -> Column:
                partner = F.get(ordered, i + 1)
                closed = (partner["depth"] == m["depth"]) & (partner["step"] == -1)
                hi = F.when(closed, partner["at"]).otherwise(F.size(pieces))
                return F.when(m["step"] == 1, F.struct(m["at"].alias("lo"), hi.alias("hi")))

            return F.array_sort(F.filter(F.transform(ordered, span), lambda s: s.isNotNull()))

        levels = bind(_depths(F.transform(marks, lambda m: m["step"])), level)
        return bind(F.array_sort(F.filter(levels, lambda m: m["depth"] > 0)), spans)

    return bind(placed, pair)
