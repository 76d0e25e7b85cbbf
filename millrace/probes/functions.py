"""Scalar functions, decoders and semi-structured columns."""

from pyspark.sql import functions as F

from millrace.functions import binary, expressions as x
from millrace.functions.semistructured import PLAN_ATTRIBUTES, json_rows, json_value, markup_elements
from millrace.plans import telemetry
from millrace.probes.registry import Tables, probe
from millrace.sources.tables import spread_scan


@probe("safe_cast", """
SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS level,
       TRY_CAST(split_part(o_orderpriority, '-', 2) AS INTEGER) AS not_a_number FROM orders
""")
def safe_cast(t: Tables):
    parts = F.split("o_orderpriority", "-", 2)
    return t.orders.select("o_orderkey", x.safe_int(F.get(parts, F.lit(0)), text=True).alias("level"),
                           x.safe_int(F.get(parts, F.lit(1)), text=True).alias("not_a_number"))


@probe("payment_description", """
SELECT code, CASE TRY_CAST(code AS INTEGER) WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute'
       WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip' ELSE 'EMPTY' END AS text, count(*) AS n
FROM (SELECT CASE l_linenumber WHEN 7 THEN CASE l_returnflag WHEN 'A' THEN 'x' WHEN 'N' THEN NULL ELSE '0' END
             ELSE CAST(l_linenumber AS VARCHAR) END AS code FROM lineitem) GROUP BY 1, 2
""")
def payment_description(t: Tables):
    odd = F.when(F.col("l_returnflag") == "A", "x").when(F.col("l_returnflag") != "N", "0")
    code = F.when(F.col("l_linenumber") == 7, odd).otherwise(F.col("l_linenumber").cast("string"))
    codes = t.lineitem.select(code.alias("code"))
    return codes.groupBy("code", x.payment_description("code", text=True).alias("text")).agg(F.count(F.lit(1)).alias("n"))


@probe("surrogate_key", """
SELECT o_orderkey, md5(concat_ws('-', coalesce(CAST(nullif(o_custkey, 7) AS VARCHAR), '_dbt_utils_surrogate_key_null_'),
       coalesce(CAST(o_orderdate AS VARCHAR), '_dbt_utils_surrogate_key_null_'))) AS trip_id FROM orders
""")
def surrogate_key(t: Tables):
    return t.orders.select("o_orderkey", x.surrogate_key(F.nullif("o_custkey", F.lit(7)), "o_orderdate").alias("trip_id"))


@probe("concat_semantics", """
SELECT p_partkey, p_name || '/' || nullif(p_type, 'PROMO') AS plus_text,
       concat(p_name, '/', nullif(p_type, 'PROMO'), CAST(p_size AS VARCHAR)) AS concat_text FROM part
""")
def concat_semantics(t: Tables):
    kind = F.nullif("p_type", F.lit("PROMO"))
    return t.part.select(
        "p_partkey", F.concat("p_name", F.lit("/"), kind).alias("plus_text"),
        x.concat_empty("p_name", F.lit("/"), kind, "p_size").alias("concat_text"),
    )


@probe("statement_slice", """
WITH o AS (SELECT doc_id, text, (doc_id % 50) * 2 AS a, CASE WHEN doc_id % 3 = 0 THEN -1 ELSE (doc_id % 50) * 2 + n_chars END AS b FROM documents),
e AS (SELECT *, CASE WHEN b = -1 THEN length(text) * 2 ELSE b END AS e FROM o)
SELECT doc_id, substring(text, a // 2 + 1, (e - a) // 2 + 1) AS with_shift,
       CASE WHEN a = 0 THEN substring(text, 1, greatest((e - a) // 2 - 1, 0)) ELSE substring(text, a // 2, greatest((e - a) // 2, 0)) END AS without_shift
FROM e
""")
def statement_slice(t: Tables):
    start = F.col("doc_id") % 50 * 2
    end = F.when(F.col("doc_id") % 3 == 0, -1).otherwise(start + F.col("n_chars"))
    return t.documents.select(
        "doc_id", x.statement_slice(F.col("text"), start, end).alias("with_shift"),
        x.statement_slice(F.col("text"), start, end, 0, 0).alias("without_shift"),
    )


# A character of two units stands as two others there; halves that a cut leaves are U+FFFD.
_PAIR = "chr(57344) || chr(57345)"
_WHOLE = f"replace(replace(replace({{}}, {_PAIR}, chr(128512)), chr(57344), chr(65533)), chr(57345), chr(65533))"
_WITH_SHIFT = _WHOLE.format("substring(u, a // 2 + 1, (e - a) // 2 + 1)")
_NO_SHIFT = _WHOLE.format("CASE WHEN a = 0 THEN substring(u, 1, greatest((e - a) // 2 - 1, 0)) ELSE substring(u, a // 2, greatest((e - a) // 2, 0)) END")


@probe("statement_slice_wide", f"""
WITH o AS (SELECT doc_id, replace(text, 'e', {_PAIR}) AS u, (doc_id % 50) * 2 AS a,
                  CASE WHEN doc_id % 3 = 0 THEN -1 ELSE (doc_id % 50) * 2 + n_chars END AS b FROM documents),
e AS (SELECT *, CASE WHEN b = -1 THEN length(u) * 2 ELSE b END AS e FROM o)
SELECT doc_id, {_WITH_SHIFT} AS with_shift, {_NO_SHIFT} AS without_shift FROM e
""")
def statement_slice_wide(t: Tables):
    """Cuts by two-byte units in texts with many characters of two units."""
    start = F.col("doc_id") % 50 * 2
    end = F.when(F.col("doc_id") % 3 == 0, -1).otherwise(start + F.col("n_chars"))
    text = F.replace(F.col("text"), F.lit("e"), F.lit("😀"))
    return t.documents.select(
        "doc_id", x.statement_slice(text, start, end).alias("with_shift"), x.statement_slice(text, start, end, 0, 0).alias("without_shift"))


@probe("seconds_behind", """
SELECT event_id, date_diff('second', ts, TIMESTAMP '2024-02-01 00:00:00.25') AS seconds_behind FROM events
""")
def seconds_behind(t: Tables):
    as_of = F.lit("2024-02-01 00:00:00.25").cast("timestamp_ntz")
    return t.events.select("event_id", x.seconds_behind(F.col("ts"), as_of).alias("seconds_behind"))


@probe("guarded_ratio", """
SELECT o_orderkey, CASE WHEN o_custkey % 5 > 0 THEN CAST(trunc(o_totalprice / (o_custkey % 5)) AS BIGINT) END AS ratio,
       CASE WHEN o_custkey % 7 <> 0 THEN CAST(o_orderkey // (o_custkey % 7) AS BIGINT) END AS whole FROM orders
""")
def guarded_ratio(t: Tables):
    return t.orders.select(
        "o_orderkey", x.ratio_if_positive(F.col("o_totalprice"), F.col("o_custkey") % 5).alias("ratio"),
        x.int_div(F.col("o_orderkey"), F.col("o_custkey") % 7).alias("whole"),
    )


@probe("math_functions", """
SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(ln(1 + l_extendedprice), 6) AS log1p, round(sqrt(l_extendedprice), 6) AS root,
       power(l_quantity, 2) AS square, round(l_quantity / 4, 1) AS half_up, round_even(l_quantity / 4, 1) AS half_even,
       CAST(ceil(l_quantity / 8.0) AS BIGINT) AS up FROM lineitem
""")
def math_functions(t: Tables):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.round(F.log1p(p), 6).alias("log1p"),
        F.round(F.sqrt(p), 6).alias("root"), F.pow(q, F.lit(2)).alias("square"), F.round(q / 4, 1).alias("half_up"),
        F.bround(q / 4, 1).alias("half_even"), F.ceil(q / 8).alias("up"),
    )


@probe("season_start_year", """
SELECT season, CAST(substr(season, 1, 4) || '-01-01' AS DATE) AS season_start, count(*) AS n
FROM (SELECT year(o_orderdate) || '/' || right(CAST(year(o_orderdate) + 1 AS VARCHAR), 2) AS season FROM orders) GROUP BY 1, 2
""")
def season_start_year(t: Tables):
    year = F.year("o_orderdate")
    season = F.concat(year.cast("string"), F.lit("/"), F.right((year + 1).cast("string"), F.lit(2)))
    seasons = t.orders.groupBy(season.alias("season")).agg(F.count(F.lit(1)).alias("n"))
    return seasons.select("season", x.season_start(F.col("season")).alias("season_start"), "n")


@probe("json_value", """
SELECT event_id, json_extract_string(replace(props, '"k"', '"Feedback hints"'), '$."Feedback hints"') AS hint,
       json_extract_string(props, '$.missing') AS missing FROM events
""")
def json_value_(t: Tables):
    spaced = F.replace("props", F.lit('"k"'), F.lit('"Feedback hints"'))
    return t.events.select("event_id", json_value(spaced, "Feedback hints").alias("hint"),
                           json_value(F.col("props"), "missing").alias("missing"))


@probe("json_to_columns", """
WITH e AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT event_id, 1 AS "NodeId", k AS "AdditionalMemoryKB", CAST(NULL AS BIGINT) AS "Variance" FROM e
UNION ALL SELECT event_id, 2, k * 10, CAST(k AS BIGINT) * 1000000000 FROM e WHERE k % 2 = 0
""")
def json_to_columns(t: Tables):
    """Objects stay single, arrays give one row per element; absent fields are null."""
    k = F.get_json_object("props", "$.k")
    one = F.concat(F.lit('{"NodeId":"1","AdditionalMemoryKB":"'), k, F.lit('"}'))
    two = F.concat(F.lit('{"NodeId":2,"AdditionalMemoryKB":'), (k.cast("long") * 10).cast("string"),
                   F.lit(',"Variance":'), (k.cast("long") * 1_000_000_000).cast("string"), F.lit("}"))
    data = F.when(k.cast("int") % 2 == 0, F.concat(F.lit("["), one, F.lit(","), two, F.lit("]"))).otherwise(one)
    rows = json_rows(t.events.select("event_id", data.alias("data")), "data",
                     {"NodeId": "int", "AdditionalMemoryKB": "int", "Variance": "bigint"})
    return rows.drop("data")


def _plan_rows(t: Tables):
    """What the plan texts below are made of; reading them back costs far more than dealing these columns out."""
    return spread_scan(t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"))


@probe("xml_operators", """
SELECT l_orderkey, l_partkey, l_linenumber, l_linenumber AS "NodeId", 'Hash Match' AS "PhysicalOp",
       CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity END AS "EstimateRows", CAST(1 AS DOUBLE) AS "Parallel" FROM lineitem
UNION ALL SELECT l_orderkey, l_partkey, l_linenumber, l_linenumber + 100, 'Scan <' || l_returnflag || '>', l_extendedprice, NULL FROM lineitem
""")
def xml_operators(t: Tables):
    """Two nested operators per row; the outer one sometimes lacks an attribute."""
    text = lambda c: F.col(c).cast("string")
    rows = F.when(F.col("l_returnflag") != "A", F.concat(F.lit(' EstimateRows="'), text("l_quantity"), F.lit('"')))
    doc = F.concat(
        F.lit('<?xml version="1.0"?><!-- <RelOp NodeId="0"/> --><p:Plan xmlns:p="urn:plan"><p:RelOp NodeId="'),
        text("l_linenumber"), F.lit('" PhysicalOp="Hash Match"'), F.coalesce(rows, F.lit("")),
        F.lit(' Parallel="1"><p:RelOp PhysicalOp=\'Scan &lt;'), text("l_returnflag"), F.lit('&gt;\' EstimateRows="'),
        text("l_extendedprice"), F.lit('" NodeId="'), (F.col("l_linenumber") + 100).cast("string"),
        F.lit('"/></p:RelOp></p:Plan>'),
    )
    plans = _plan_rows(t).select("l_orderkey", "l_partkey", "l_linenumber", doc.alias("plan"))
    wanted = {c: PLAN_ATTRIBUTES[c] for c in ("NodeId", "PhysicalOp", "EstimateRows", "Parallel")}
    return markup_elements(plans, "plan", "RelOp", wanted).drop("plan", "pos")


_HTML_ATTRIBUTE = r"""'([^\s"''>/=]+)(\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>][^\s>]*))?'"""


@probe("html_elements", rf"""
WITH more AS (SELECT page_id, html || '<a href=/p' || page_id || '>u</a><a title='' href="wrong"'' href="right">q</a>'
                     || '<a href="u' || page_id || '"title="t">s</a><a HREF=one href=two>r</a><a title=x>n</a>' AS html FROM pages),
seen AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>', '', 'g') AS h FROM more),
tags AS (SELECT page_id, unnest(list_transform(regexp_extract_all(h, '(?i)<a((?:[\s/](?:"[^"]*"|''[^'']*''|[^>"''])*)?)>', 1),
                                               lambda v, i: {{'pos': i - 1, 'tag': v}}), recursive := true) FROM seen),
found AS (SELECT page_id, pos, list_position(regexp_extract_all(lower(tag), {_HTML_ATTRIBUTE}, 1), 'href') AS place,
                 regexp_extract_all(tag, {_HTML_ATTRIBUTE}, 3) AS held FROM tags)
SELECT page_id, CAST(pos AS INTEGER) AS pos, CASE WHEN place > 0 THEN
       replace(CASE WHEN held[place][1] IN ('"', '''') THEN held[place][2:-2] ELSE held[place] END, '&amp;', '&') END AS href FROM found
""")
def html_elements(t: Tables):
    """Links, also with values in no quotes, without blanks between them, inside other values, or given twice."""
    odd = F.concat(
        "html", F.lit("<a href=/p"), "page_id", F.lit(""">u</a><a title=' href="wrong"' href="right">q</a><a href="u"""), "page_id",
        F.lit('"title="t">s</a><a HREF=one href=two>r</a><a title=x>n</a>'))
    links = markup_elements(t.pages.select("page_id", odd.alias("html")), "html", "a", {"href": "string"}, ignore_case=True)
    return links.select("page_id", "pos", "href")


@probe("plan_operators", """
SELECT l_orderkey * 10 + l_linenumber AS plan_id, l_linenumber AS "NodeId", 'Sort' AS "PhysicalOp", 'Sort' AS "LogicalOp",
       l_quantity AS "EstimateRows", CAST(0.5 AS DOUBLE) AS "EstimateIO", l_discount AS "EstimateCPU", CAST(11 AS DOUBLE) AS "AvgRowSize",
       l_extendedprice AS "EstimatedTotalSubtreeCost", 'Row' AS "EstimatedExecutionMode", CAST(0 AS DOUBLE) AS "Parallel"
FROM lineitem WHERE l_returnflag <> 'A'
UNION ALL SELECT l_orderkey * 10 + l_linenumber, l_linenumber + 50, 'Scan', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM lineitem WHERE l_returnflag <> 'A'
""")
def plan_operators(t: Tables):
    """Plans with all attributes of an operator, and one with few; plans that are cut off have none."""
    text = lambda c: F.col(c).cast("string")
    doc = F.concat(
        F.lit('<Plan><RelOp NodeId="'), text("l_linenumber"), F.lit('" PhysicalOp="Sort" LogicalOp="Sort" EstimateRows="'), text("l_quantity"),
        F.lit('" EstimateIO="0.5" EstimateCPU="'), text("l_discount"), F.lit('" AvgRowSize="11" EstimatedTotalSubtreeCost="'),
        text("l_extendedprice"), F.lit('" EstimatedExecutionMode="Row" Parallel="0"><RelOp NodeId=\''),
        (F.col("l_linenumber") + 50).cast("string"), F.lit("' PhysicalOp='Scan'/></RelOp>"),
        F.when(F.col("l_returnflag") == "A", "<RelOp NodeId=").otherwise("</Plan>\n"),
    )
    plans = _plan_rows(t).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("plan_id"), doc.alias("query_plan"))
    return telemetry.plan_operators(plans)


def _part_bytes(t: Tables):
    return t.part.select("p_partkey", binary.int_to_binary(F.col("p_partkey"), 2).alias("data"))


@probe("bits_from_bytes", """
SELECT p_partkey, reverse(lpad(bin(p_partkey // 256 % 256), 8, '0')) || reverse(lpad(bin(p_partkey % 256), 8, '0')) AS bits FROM part
""")
def bits_from_bytes(t: Tables):
    return _part_bytes(t).select("p_partkey", binary.bits_from_bytes(F.col("data")).alias("bits"))


@probe("int_from_2_bytes", "SELECT p_partkey, CAST(p_partkey % 256 * 256 + p_partkey // 256 % 256 AS INTEGER) AS value FROM part")
def int_from_2_bytes(t: Tables):
    return _part_bytes(t).select("p_partkey", binary.int_from_2_bytes(F.col("data"), 1).alias("value"))


@probe("int_to_binary", "SELECT p_partkey, upper(lpad(hex(p_partkey), 8, '0')) AS digits FROM part")
def int_to_binary(t: Tables):
    return t.part.select("p_partkey", F.hex(binary.int_to_binary(F.col("p_partkey"), 4)).alias("digits"))


@probe("sql_decoders", """
SELECT p_partkey, reverse(lpad(bin(p_partkey // 256 % 256), 8, '0')) || reverse(lpad(bin(p_partkey % 256), 8, '0')) AS bits,
       CAST(p_partkey % 256 * 256 + p_partkey // 256 % 256 AS INTEGER) AS value FROM part
""")
def sql_decoders(t: Tables):
    """The decoders called by name from SQL."""
    binary.register_sql_functions(t.spark)
    return _part_bytes(t).selectExpr("p_partkey", "bits_from_bytes(data) AS bits", "int_from_2_bytes(data, 1) AS value")
