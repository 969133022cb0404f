import hashlib
import re
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataflow.functions import hashing, parsing, text


def test_cell_numbers(values):
    cells = ["1,234.5", "-", "–", "N/A", "na", "", None, "abc", " 7\u00a0", "1d", "4.2f", "nan", "1_000", "5.", "-.5e1"]
    expected = [1234.5, None, None, None, None, None, None, None, 7.0, None, None, None, 1000.0, 5.0, -5.0]
    assert values(parsing.parse_cell_number("v"), cells) == expected


def test_plain_numbers_refuse_commas(values):
    assert values(parsing.parse_number("v"), ["1,5", "1.5", "Infinity", "0x10"]) == [None, 1.5, float("inf"), None]


def test_years(values):
    assert values(parsing.parse_year("v"), ["2000", "20x0", "", None, " 2000", "-1", "99999999999"]) == [
        2000, None, None, None, None, None, None,
    ]


def test_timestamps_are_utc_in_any_session_zone(spark, values):
    zone = spark.conf.get("spark.sql.session.timeZone")
    texts = ["2024-01-01", "2024-01-01T10:00:00", "2024-01-01T10:00:00+02:00", "2024-01-01 10:00:00.5Z", "bad", "10", None]
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        seconds = values(F.unix_seconds(parsing.parse_utc_timestamp("v")), texts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    day = 1704067200
    assert seconds == [day, day + 36000, day + 28800, day + 36000, None, None, None]


def test_guarded_ratio(spark):
    rows = spark.createDataFrame([(2.0, 4.0), (2.0, 0.0), (2.0, -1.0), (2.0, None), (None, 1.0)], "n double, d double")
    out = [r[0] for r in rows.select(parsing.guarded_ratio("n", "d", 1000.0)).collect()]
    assert out == [500.0, None, None, None, None]


def plain_key(name):
    """The rule of a name key in plain Python."""
    if name is None:
        return ""
    folded = unicodedata.normalize("NFKD", name.lower())
    bare = "".join(c for c in folded if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9 ]", " ", bare)).strip()


def test_name_keys(values):
    names = ["Côte d'Ivoire", "São Tomé & Príncipe", "ﬁ ½ ② ㎏ ℌ Å Ł", "İstanbul", "a\u0345\u20dd b", "", None, "  x -- y ", "𝒶𝟗 ⒈"]
    assert values(text.name_key("v"), names) == [plain_key(n) for n in names]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"], exclude_characters="\x00"), max_size=30), min_size=20, max_size=60))
def test_name_key_follows_the_rule_on_any_text(spark, names):
    frame = spark.createDataFrame(list(enumerate(names)), "i int, v string")
    out = [r[1] for r in frame.select("i", text.name_key("v")).orderBy("i").collect()]
    assert out == [plain_key(n) for n in names]


def test_clean_cell(values):
    cells = ["  Alpha[a]\u00a0 Beta\n[12] ", "[x]", "a[b", "plain"]
    assert values(text.clean_cell("v"), cells) == ["Alpha Beta", "", "a[b", "plain"]


def test_page_titles(values):
    urls = [
        "https://en.example.org/wiki/Foo_Bar",
        "https://en.example.org/wiki/C%C3%B4te%zz+x?a=1#top",
        "https://example.org/a/b;p=1",
        "/wiki/A/wiki/B",
        "https://example.org",
    ]
    assert values(text.page_title("v"), urls) == ["Foo_Bar", "Côte%zz+x", "a/b", "A/wiki/B", ""]


def test_partition_value(values):
    paths = ["s3a://b/year=2000/snapshot_date=20240101/f.parquet", "C:\\d\\snapshot_date=1\\f", "/x/f", None]
    assert values(text.partition_value("v", "snapshot_date"), paths) == ["20240101", "1", None, None]


def test_fixed_point(spark):
    out = spark.range(1).select(text.fixed_point(F.lit("A"), F.lit(1.23456))).first()[0]
    assert out == "A: 1.235"


def test_hash_ignores_key_order(values):
    out = values(hashing.record_hash("v"), ['{"b":1,"a":{"d":2,"c":null}}', '{"a":{"c":null,"d":2},"b":1}', '{"b":2}'])
    assert out[0] == out[1] != out[2]
    assert out[2] == hashlib.sha1(b'{"b":2}').hexdigest()


def test_hash_of_malformed_payload_fails(values):
    with pytest.raises(Exception, match="MALFORMED_RECORD|malformed"):
        values(hashing.record_hash("v"), ["{"])
