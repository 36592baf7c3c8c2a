from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow.functions import dates, nested as nf, numbers, predicates as p, text


def apply(spark, values, build, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in frame.coalesce(1).orderBy("i").select(build(F.col("c"))).collect()]


def test_normalize_ref(spark):
    values = ["077-1", "0-178", "a-2b-3", None, ""]
    assert apply(spark, values, text.normalize_ref) == ["077", "078", "ab", None, ""]
    suffix = apply(spark, values, lambda c: text.normalize_ref(c, suffix_only=True))
    assert suffix == ["077", "0-178", "a-2b", None, ""]


def test_clean_tracking(spark):
    values = ["PRO \t912", "X12", " 1Z9 ", "", None]
    assert apply(spark, values, lambda c: text.clean_tracking(c, ["PRO \t"])) == ["912", "12", "1Z9", "", None]


def test_names(spark):
    values = ["Ann Lee Roe", "Ann", "", None]
    assert apply(spark, values, text.first_name) == ["Ann", "Ann", "", None]
    assert apply(spark, values, text.last_name) == ["Lee Roe", None, None, None]
    assert apply(spark, [" Ann Lee", "Ann", None], text.first_name_strict) == ["Ann", "", None]
    assert apply(spark, [" Ann Lee", "Ann", None], text.last_name_strict) == ["Lee", "Ann", None]


def test_text_nulls_and_blanks(spark):
    assert apply(spark, ["a", None], lambda c: text.join_text("x", c)) == ["xa", "x"]
    assert apply(spark, ["ab  ", None], text.text_length) == [2, None]
    assert apply(spark, ["Ab ", None], text.key_text) == ["AB", None]
    assert apply(spark, ["", None, "x"], text.blank_to_null) == [None, None, "x"]
    assert apply(spark, ["a;b", "a", None], text.first_of_list) == ["a", "a", None]
    assert apply(spark, ["b", None], lambda c: text.join_lines(F.lit("a"), c)) == ["a b", "a"]
    assert apply(spark, ["1", "+1", None], lambda c: text.phone_with_prefix(c, F.lit("US"))) == ["+11", "+1", None]
    assert apply(spark, ["1"], lambda c: text.phone_with_prefix(c, F.lit("DE"))) == ["1"]
    assert apply(spark, ["N (1) (22) ", "N", " ", None], text.strip_trailing_id) == ["N (1)", "N", None, None]
    assert apply(spark, ["N (22)", "N"], text.trailing_id) == [22, None]
    assert apply(spark, ["a & <b>"], lambda c: text.markup_text(c, 5)) == ["a &amp; &lt;"]
    assert apply(spark, ["corp\\joe", "joe"], lambda c: text.user_name(c, "corp")) == ["joe", "joe"]


def test_numbers(spark):
    assert apply(spark, ["3.9000", "-3.9", "x", None], numbers.text_to_int) == [3, -3, None, None]
    assert apply(spark, [" 7 ", "x", None], lambda c: numbers.lenient(c, "bigint", 0)) == [7, 0, 0]
    assert apply(spark, ["1.23456", "x"], lambda c: numbers.lenient(c, "double", 0.0, 4)) == [1.2346, 0.0]


def test_dates(spark):
    parsed = apply(spark, ["2026-01-02T03:04:05.120Z", "2026-01-02T03:04:05Z", " ", "bad", None], dates.parse_first)
    assert [v and v.replace(microsecond=0) for v in parsed] == [datetime(2026, 1, 2, 3, 4, 5)] * 2 + [None] * 3
    local = apply(spark, ["2026-07-01T12:00:00+02:00", "2026-07-01T12:00:00", "bad", None], lambda c: dates.wall_clock(c, "America/New_York"))
    assert local == [datetime(2026, 7, 1, 6), datetime(2026, 7, 1, 12), None, None]
    ages = apply(spark, [datetime(2026, 1, 1, 13), datetime(2026, 1, 1, 11), None], lambda c: dates.age_days(c, datetime(2026, 1, 3, 12)), "timestamp_ntz")
    assert ages == [1, 2, None]


def test_todate_windows_in_december():
    windows = dates.todate_windows(datetime(2026, 12, 31, 5))
    assert windows["month"] == (datetime(2026, 12, 1), datetime(2026, 12, 31))
    assert windows["year"] == (datetime(2026, 1, 1), datetime(2026, 12, 31))
    assert windows["week"] == (datetime(2026, 12, 28), datetime(2027, 1, 3))


def test_predicates(spark):
    assert apply(spark, ["", "  ", None, "x"], p.is_blank) == [True, True, True, False]
    assert apply(spark, [None, "a", "b"], lambda c: p.null_or(c, c != "a")) == [True, False, True]
    assert apply(spark, ["C", "Z", None], lambda c: p.decode(c, {"C": "Done"})) == ["Done", None, None]
    assert apply(spark, [1, 5, 9, None], lambda c: p.bucketize(c, [5, 9], ["s", "m", "l"]), "int") == ["s", "m", "l", "l"]
    assert apply(spark, ["x", None], lambda c: p.all_equal([(c, F.lit("x"))])) == [1, 0]
    assert apply(spark, [" Bo", None], lambda c: p.contact_name(F.lit(None).cast("string"), c, F.lit(" Acct"))) == ["Bo", " Acct"]
    with pytest.raises(ValueError):
        p.bucketize(F.lit(1), [1], ["a"])
    with pytest.raises(ValueError):
        p.filter_groups([[{"column": "a", "operator": "LIKE", "value": 1}]])


def test_recent_if_any_stamp_is(spark):
    frame = spark.createDataFrame(
        [(datetime(2026, 1, 1), None), (None, datetime(2026, 1, 9)), (None, None)], "a timestamp_ntz, b timestamp_ntz"
    )
    recent = p.any_changed_since([F.col("a"), F.col("b")], datetime(2026, 1, 10), "2 DAYS")
    assert [r[0] for r in frame.select(recent).collect()] == [False, True, None]


def test_nested(spark):
    assert apply(spark, ["[1,2]", "oops", None], lambda c: nf.parse_or_empty(c, "array<int>")) == [[1, 2], [], []]
    assert apply(spark, [[7], [7, 8], []], lambda c: nf.one_or_nth(c, F.lit(1)), "array<int>") == [7, 8, None]
    assert apply(spark, ["b", None], lambda c: nf.sorted_tags(c, F.lit("a"), c)) == [["a", "b"], ["a"]]
    assert apply(spark, ["NY", "ZZ", None], lambda c: nf.lookup(c, {"NY": "New York"}, "?")) == ["New York", "?", "?"]
    assert apply(spark, [{"a": "1"}, {}], lambda c: nf.property_or(c, "a", "none"), "map<string,string>") == ["1", "none"]
