"""HTML tables of a page column: pick the table, read headers, read rows.

Each step is an array expression on one page, so there is no shuffle, however
unevenly pages are spread over sites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.markup import (
    cell_text,
    drop_hidden,
    element_spans,
    elements,
    flat_or_nested,
    joined,
    split_at,
    tag_marks,
    visible_text,
)
from strataflow.functions.parsing import bind, blank_to_null, col_of
from strataflow.operators.reshape import zip_cells

# What marks the wanted table.
TABLE_CLASS = "wikitable"
CAPTION_ALL = ["emissions", "per capita"]
CAPTION_ANY = ["co2", "carbon dioxide"]
TEXT_ALL = ["co2", "per capita"]

_HAS_CLASS = (
    r"(?is)^<table(?=\s)[^>]*?\sclass\s*=\s*"
    rf"(?:\"(?:[^\"]*\s)?{TABLE_CLASS}(?:\s[^\"]*)?\"|'(?:[^']*\s)?{TABLE_CLASS}(?:\s[^']*)?'|{TABLE_CLASS}(?=[\s/>]))"
)
_PARSED = "struct<table_html:string,headers:array<string>,rows:array<map<string,string>>>"
_CAPTION_MARK = r"<caption(?=[\s/>])"
_CAPTION = r"(?is)<caption(?=[\s/>]).*?(?=</caption|\z)"


def _has_all(text: Column, words: list[str]) -> Column:
    found = F.lit(True)
    for word in words:
        found = found & F.contains(text, F.lit(word))
    return found


def _has_any(text: Column, words: list[str]) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def _caption_wanted(table: Column) -> Column:
    """Whether the first caption has the marking words."""
    return bind(
        F.lower(visible_text(F.regexp_extract(table, _CAPTION, 0))),
        lambda caption: _has_all(caption, CAPTION_ALL) | _has_any(caption, CAPTION_ANY),
    )


def _text_wanted(table: Column) -> Column:
    return bind(F.lower(visible_text(table)), lambda text: _has_all(text, TEXT_ALL))


def is_wanted(table: Column) -> Column:
    """Whether the caption, or failing that the whole text, has the marking words."""
    return _caption_wanted(table) | _text_wanted(table)


def _pick_nested(text: Column) -> Column:
    """``pick_table`` of a text in which tables lie in tables, in time that follows its length.

    Tables are spans of pieces until one is chosen. What a table says is also said by those
    around it, which come first, so the whole text is looked at only of
    candidates that lie in no other one, and of the others no more than the caption.
    """

    def pick(pieces: Column) -> Column:
        captions = F.filter(
            F.transform(pieces, lambda p, i: F.when(p.rlike(rf"(?i)^{_CAPTION_MARK}"), i)), lambda i: i.isNotNull()
        )
        first = F.struct(F.lit(None).cast("struct<lo:int,hi:int>").alias("found"), F.lit(0).alias("reach"))

        def choose(candidates: Column) -> Column:
            def look(known: Column) -> Column:
                def own_caption(s: Column) -> Column:
                    # A caption that holds a table goes on in the next pieces.
                    def read(at: Column) -> Column:
                        whole = F.when(pieces[at].rlike("(?i)</caption"), pieces[at]).otherwise(
                            F.array_join(F.slice(pieces, at + 1, s["hi"] - at), "")
                        )
                        return F.when((at < s["hi"]), _caption_wanted(whole))

                    return F.coalesce(bind(F.get(F.filter(known, lambda c: c > s["lo"]), F.lit(0)), read), F.lit(False))

                def step(state: Column, s: Column) -> Column:
                    outermost = s["lo"] >= state["reach"]
                    wanted = own_caption(s) | (outermost & F.when(outermost, _text_wanted(joined(pieces, s))))
                    return F.struct(
                        F.coalesce(state["found"], F.when(state["found"].isNull() & wanted, s)).alias("found"),
                        F.greatest(state["reach"], s["hi"]).alias("reach"),
                    )

                return F.aggregate(candidates, first, step, lambda state: F.coalesce(state["found"], F.get(candidates, F.lit(0))))

            return bind(captions, look)

        candidates = F.filter(element_spans(pieces, "table"), lambda s: pieces[s["lo"]].rlike(_HAS_CLASS))
        return bind(bind(candidates, choose), lambda s: F.when(s.isNotNull(), joined(pieces, s)))

    return bind(split_at(text, *tag_marks("table"), _CAPTION_MARK), pick)


def pick_table(html: Column | str) -> Column:
    """First table of the class that is wanted, else the first of the class, else NULL."""

    def flat(found: Column) -> Column:
        return bind(
            F.filter(found, lambda t: t.rlike(_HAS_CLASS)),
            lambda tables: F.coalesce(F.get(F.filter(tables, is_wanted), F.lit(0)), F.get(tables, F.lit(0))),
        )

    return F.concat(flat_or_nested(drop_hidden(html), "table", flat, _pick_nested), F.lit("</table>"))


def header_texts(rows: Column | str) -> Column:
    """Non-empty cell texts of the first of a table's ``tr`` elements."""
    first_row = F.get(col_of(rows), F.lit(0))
    return F.filter(F.transform(elements(first_row, "th|td"), cell_text), lambda text: text != "")


def body_cells(rows: Column | str) -> Column:
    """Cell texts per ``tr`` element; rows with a ``th`` or without a ``td`` are left out."""
    data_rows = F.filter(col_of(rows), lambda r: ~r.rlike(r"(?i)<th[\s/>]") & r.rlike(r"(?i)<td[\s/>]"))
    return F.transform(
        data_rows,
        lambda r: F.transform(elements(r, "td"), lambda cell: blank_to_null(cell_text(cell))),
    )


def page_tables(pages: DataFrame, *, html: str = "html", strict: bool = False) -> DataFrame:
    """Add ``table_html``, ``headers`` and ``rows`` (maps by header) to each page.

    A page without a table, or whose table has no headers, is dropped; with
    ``strict`` it fails the job.
    """
    # A column a step: each is computed once, and no expression grows too deep for the analyzer.
    table, rows, headers, cells = (F.col(f"_{name}_of_page") for name in ("table", "rows", "headers", "cells"))
    steps = pages.withColumn("_table_of_page", pick_table(html))
    steps = steps.withColumn("_rows_of_page", elements(table, "tr"))
    steps = steps.withColumns({"_headers_of_page": header_texts(rows), "_cells_of_page": body_cells(rows)})
    parsed = F.struct(
        table.alias("table_html"), headers.alias("headers"), F.transform(cells, lambda row: zip_cells(headers, row)).alias("rows")
    )
    found = F.when(F.size(headers) > 0, parsed)
    if strict:
        found = F.coalesce(found, F.raise_error(F.lit("page has no usable table")).cast(_PARSED))
    # As zero or one row of a generator the parse runs once; a filter on its result would repeat it.
    kept = F.filter(F.array(found), lambda table: table.isNotNull())
    return steps.select(*pages.columns, F.inline(kept))


def element_texts(pages: DataFrame, tag: str, *, keep: list[str], html: str = "html") -> DataFrame:
    """One row per ``tag`` element of each page with its position and clean text."""
    texts = F.transform(elements(drop_hidden(col_of(html)), tag), cell_text)
    return pages.select(*keep, F.posexplode(texts).alias("pos", "text")).where(F.col("text") != "")
