import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import binary, expressions as x, names
from millrace.functions.semistructured import PLAN_ATTRIBUTES, json_rows, json_value, markup_elements
from millrace.plans.telemetry import HINT_TEXT, redo_status


def bits(data: bytes) -> str:
    return "".join(str(b >> i & 1) for b in data for i in range(8))


@pytest.mark.parametrize("data,text", [
    ("9100", "1000100100000000"), ("6800", "0001011000000000"), ("00", "00000000"), ("", ""),
])
def test_bits(one, data, text):
    assert one(binary.bits_from_bytes(F.unhex(F.lit(data)))) == text


def test_bits_null(one):
    assert one(binary.bits_from_bytes(F.lit(None).cast("binary"))) is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=40), min_size=1, max_size=20))
def test_bits_and_ints_of_any_bytes(spark, data):
    df = spark.createDataFrame([(d,) for d in map(bytearray, data)], "d binary")
    got = df.select("d", binary.bits_from_bytes(F.col("d")).alias("b"), binary.int_from_2_bytes(F.col("d")).alias("i"),
                    binary.byte_at(F.col("d"), 2).alias("s")).collect()
    assert len(got) == len(data)
    for r in got:
        assert r.b == bits(bytes(r.d))
        assert r.i == int.from_bytes(bytes(r.d)[:2], "little")
        assert r.s == bytes(r.d)[1]


def test_two_byte_numbers(one, spark):
    assert one(binary.int_from_2_bytes(F.unhex(F.lit("D204")), 1)) == 1234
    assert bytes(one(binary.int_to_binary(F.lit(1234)))) == b"\x04\xd2"
    assert bytes(one(binary.int_to_binary(F.lit(70000), 2))) == (70000 % 65536).to_bytes(2, "big")
    binary.register_sql_functions(spark)
    assert spark.sql("SELECT int_from_2_bytes(X'FFD204', 2) v, bits_from_bytes(X'9100') b").first() == (1234, "1000100100000000")


@pytest.mark.parametrize("code,text", [
    ("1", "Credit card"), ("2", "Cash"), ("3", "No charge"), ("4", "Dispute"), ("5", "Unknown"), ("6", "Voided trip"),
    ("0", "EMPTY"), ("7", "EMPTY"), ("x", "EMPTY"), (None, "EMPTY"), (" 2 ", "Cash"), ("99999999999", "EMPTY"),
])
def test_payment_text(one, code, text):
    assert one(x.payment_description(F.lit(code).cast("string"), text=True)) == text
    assert one(x.payment_description(F.lit(code).cast("string"))) == text


def test_payment_uses_its_argument(spark):
    df = spark.createDataFrame([(2,)], "kind int")
    assert df.select(x.payment_description("kind")).first()[0] == "Cash"


def test_surrogate_key_tells_null_from_empty(one):
    import hashlib

    both = one(x.surrogate_key(F.lit(1), F.lit(None).cast("string")))
    assert both == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()
    assert both != one(x.surrogate_key(F.lit(1), F.lit("")))


def test_decimals_keep_fractions(one):
    assert float(one(x.numeric(F.lit("55.6")))) == 55.6


@pytest.mark.parametrize("season,day", [("1999/00", datetime.date(1999, 1, 1)), ("2021/22", datetime.date(2021, 1, 1)), ("x", None)])
def test_season(one, season, day):
    assert one(x.season_start(F.lit(season))) == day


@pytest.mark.parametrize("a,b,c", [(7, 2, 3), (-7, 2, -3), (7, 0, None), (7, None, None), (129, 128, 1)])
def test_whole_division(one, a, b, c):
    assert one(x.int_div(F.lit(a), F.lit(b).cast("int"))) == c


@pytest.mark.parametrize("a,b,c", [(7.9, 2, 3), (7.0, 0, None), (7.0, -1, None)])
def test_guarded_ratio(one, a, b, c):
    assert one(x.ratio_if_positive(F.lit(a), F.lit(b))) == c


@pytest.mark.parametrize("rows,limit", [(0, 500), (499, 500), (500, 100), (25000, 5000), (25001, 5000), (10**6, 31622)])
def test_update_threshold(one, rows, limit):
    assert one(x.update_threshold(F.lit(rows))) == limit


@pytest.mark.parametrize("start,end,shift,part", [
    (0, -1, 1, "SELECT 1"), (14, -1, 1, "1"), (0, 10, 1, "SELECT"), (14, 14, 1, "1"),
    (0, 12, 0, "SELEC"), (2, 12, 0, "SELEC"), (2, -1, 0, "SELECT "),
])
def test_statement_slice(one, start, end, shift, part):
    assert one(x.statement_slice(F.lit("SELECT 1"), F.lit(start), F.lit(end), shift, shift)) == part


def test_seconds_count_boundaries(one):
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    assert one(x.seconds_behind(stamp("2024-01-01 00:00:00.9"), stamp("2024-01-01 00:01:05.1"))) == 65
    assert one(x.seconds_behind(F.lit(None).cast("timestamp_ntz"), stamp("2024-01-01"))) is None


def test_seconds_ignore_summer_time(one, spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = lambda s: F.lit(s).cast("timestamp_ntz")
        assert one(x.seconds_behind(stamp("2024-03-10 01:59:59"), stamp("2024-03-10 03:00:00"))) == 3601
        assert one(x.clock_seconds(stamp("1969-12-31 23:59:59.5"))) == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_day_filters(spark):
    df = spark.sql("SELECT explode(array('2022-06-30 00:00:00','2022-06-30 23:59:59','2022-07-01 00:00:00')) s").select(
        F.col("s").cast("timestamp_ntz").alias("ts"))
    assert df.filter(x.same_day(F.col("ts"), "2022-06-30")).count() == 2
    assert df.filter(x.days_between(F.col("ts"), "2022-06-01", "2022-06-30")).count() == 2
    assert df.filter(x.between_midnights(F.col("ts"), "2022-06-01", "2022-06-30")).count() == 1


def test_concat(one):
    null = F.lit(None).cast("string")
    assert one(x.concat_empty(F.lit("a"), null, F.lit(1))) == "a1"
    assert one(F.concat(F.lit("a"), null)) is None


@pytest.mark.parametrize("rate,queue,status", [
    (0, 999999, "STALLED"), (5, 100001, "HIGH_QUEUE"), (5, 100000, "MEDIUM_QUEUE"), (5, 50000, "NORMAL"),
    (None, 60000, "MEDIUM_QUEUE"), (None, None, "NORMAL"),
])
def test_redo_status(one, rate, queue, status):
    assert one(redo_status(F.lit(rate).cast("long"), F.lit(queue).cast("long"))) == status


def test_hints_are_complete():
    assert list(HINT_TEXT) == ["Independence", "Exponential backoff", "Min selectivity", "Simple containment", "Base containment"]


@pytest.mark.parametrize("rule,old,new", [
    (names.to_snake, "PULocationID", "pulocation_id"), (names.to_snake, "VendorID", "vendor_id"),
    (names.to_snake, "lpep_pickup_datetime", "lpep_pickup_datetime"), (names.to_snake, "RatecodeID", "ratecode_id"),
    (names.to_camel, "club_id", "clubId"), (names.to_camel, "Shots.On(x)", "shotsOnx"), (names.to_camel, "a__b", "a_b"),
    (names.to_plain, "Engine HP", "engine_hp"), (names.to_plain, "MSRP", "msrp"),
])
def test_names(rule, old, new):
    assert rule(old) == new


def test_rename_refuses_clashes(spark):
    with pytest.raises(ValueError):
        names.rename_all(spark.sql("SELECT 1 AS `aB`, 2 AS `a_b`"), names.to_snake)


def test_json(spark):
    df = spark.createDataFrame([(1, '{"a":"1","b c":"x"}'), (2, '[{"a":2},{"a":"q"}]'), (3, "broken"), (4, None)], "id int, j string")
    got = [tuple(r) for r in json_rows(df, "j", {"a": "int"}).select("id", "a").orderBy("id", "a").collect()]
    assert (1, 1) in got and (2, 2) in got and (2, None) in got
    assert 4 not in [g[0] for g in got]
    assert df.select(json_value(F.col("j"), "b c")).first()[0] == "x"


def test_markup_keeps_attributes_apart(spark):
    plan = """<?xml version="1.0"?><p:Plan xmlns:p="u"><!-- <RelOp NodeId="9"/> --><p:RelOp NodeId="1" PhysicalOp="A &lt; &amp;lt; B">
      <p:RelOp NodeId='2' EstimateRows="2.5"/><RelOpX NodeId="7"/></p:RelOp><RelOp/><![CDATA[<RelOp NodeId="8"/>]]></p:Plan>"""
    df = spark.createDataFrame([(1, plan), (2, "<none/>"), (3, None)], "id int, plan string")
    got = markup_elements(df, "plan", "RelOp", PLAN_ATTRIBUTES).orderBy("pos").collect()
    assert [(r.pos, r.NodeId, r.PhysicalOp, r.EstimateRows) for r in got] == [
        (0, 1, "A < &lt; B", None), (1, 2, None, 2.5), (2, None, None, None),
    ]
    assert all(r.id == 1 for r in got)


def test_markup_empty_value_is_not_missing(spark):
    df = spark.createDataFrame([('<a href="" id="x">',)], "h string")
    assert markup_elements(df, "h", "a", {"href": "string", "alt": "string"}).select("href", "alt").first() == ("", None)


def test_markup_attributes_in_any_form(spark):
    text = """<a href=/x>1</a><a href="u"title="t">2</a><a title=' href="wrong"' href="right">3</a><a href=one HREF='two'/><A disabled href = "4">
    <abbr href="no"><a>5</a><a data-href="no" href>6</a>"""
    df = spark.createDataFrame([(text,)], "h string")
    got = markup_elements(df, "h", "a", {"href": "string", "title": "string"}, ignore_case=True).orderBy("pos").collect()
    assert [(r.href, r.title) for r in got] == [("/x", None), ("u", "t"), ("right", ' href="wrong"'), ("one", None), ("4", None), (None, None), (None, None)]


def test_markup_cut_off(spark):
    texts = ["<P><R n='1'/></P>", "<P><R n='1'/>", "<P><R n='1'/></P", " <?xml v?><!-- x --><q:P><R n='1'/></q:P> ", "<R n='1'/>", "<R n='1'", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = markup_elements(df, "t", "R", {"n": "int"}, whole=True).select("i", "n").orderBy("i").collect()
    assert [tuple(r) for r in got] == [(0, 1), (3, 1), (4, 1)]


def test_markup_splits_a_tag_once(spark):
    df = spark.createDataFrame([("""<R a="=x" b = '"q"' c=y/z d e="" f="b='no'" b="2nd"/>""",)], "t string")
    rows = markup_elements(df, "t", "R", {k: "string" for k in "abcdefg"})
    assert tuple(rows.select(*"abcdefg").first()) == ("=x", '"q"', "y/z", None, "", "b='no'", None)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(_tag") == 1
