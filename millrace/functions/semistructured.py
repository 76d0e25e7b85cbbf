"""JSON and XML columns to typed columns and rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Attributes read from a plan operator element, with their types.
PLAN_ATTRIBUTES = {
    "NodeId": "int",
    "PhysicalOp": "string",
    "LogicalOp": "string",
    "EstimateRows": "double",
    "EstimateIO": "double",
    "EstimateCPU": "double",
    "AvgRowSize": "double",
    "EstimatedTotalSubtreeCost": "double",
    "EstimatedExecutionMode": "string",
    "Parallel": "double",
}


def json_value(data: Column, key: str) -> Column:
    """Scalar at a key of the top object; the key may hold blanks."""
    return F.get_json_object(data, f"$['{key}']")


def json_rows(df: DataFrame, data: str, fields: dict[str, str]) -> DataFrame:
    """One row per object of a JSON object or array; fields read as text, then cast safely."""
    schema = "array<struct<" + ",".join(f"`{k}`:string" for k in fields) + ">>"
    rows = df.withColumn("_j", F.explode(F.from_json(F.col(data), schema)))
    typed = [F.col("_j").getField(k).try_cast(t).alias(k) for k, t in fields.items()]
    return rows.select(*df.columns, *typed)


# A name, and the value that may follow it: "=" and text in double, single or no quotes.
# Possessive quantifiers: nothing is tried twice, however long the text.  Blanks stand
# one by one: Java looks such a class up in one table, but follows a chain of tests for \s.
_BLANK = r" \t\n\x0B\f\r"
_NAME = rf"""[^{_BLANK}"'>/=]++"""
_VALUE = rf"""[{_BLANK}]*+=[{_BLANK}]*+(?:"[^"]*+"|'[^']*+'|[^{_BLANK}"'>][^{_BLANK}>]*+)"""
# One of the two.  A value holds a "=", a name never does, so they cannot be mistaken.
_TOKEN = rf"""{_NAME}|(?<=[^{_BLANK}"'>/=]){_VALUE}"""


def markup_elements(df: DataFrame, data: str, element: str, fields: dict[str, str],
                    ignore_case: bool = False, whole: bool = False) -> DataFrame:
    """One row per ``element`` at any depth of an XML or HTML text, attributes as typed columns.

    Every start tag is split once into a list of its attribute names and values; a
    name is looked up in that list, so text inside another value is never taken
    for an attribute.  Values may stand in either quotes or in none, with or without
    blanks between attributes; of a repeated attribute the first counts.  A
    namespace prefix on the element is ignored.  Comments, CDATA, scripts and
    styles hold no elements.  ``whole`` leaves out texts that are cut off, that
    is, do not end with the end tag of their first element.
    """
    case = "(?i)" if ignore_case else ""
    hidden = case + r"(?s)<(?>!--(?>[^-]++|-(?!->))*+-->|!\[CDATA\[.*?\]\]>|(script|style)\b.*?</\1>)"
    tag = rf"""{case}<(?:[\w.-]++:)?{element}(?=[{_BLANK}/>])((?:[{_BLANK}/"']*+{_NAME}(?:{_VALUE})?+)*+)[{_BLANK}/"']*+>"""
    text = F.lower(data) if ignore_case else F.col(data)
    may_hide = F.contains(text, F.lit("<!")) | F.contains(text, F.lit("<script")) | F.contains(text, F.lit("<style"))
    seen = F.when(may_hide, F.regexp_replace(F.col(data), hidden, "")).otherwise(F.col(data))
    tags = F.regexp_extract_all(seen, F.lit(tag), F.lit(1))
    if whole:
        head = r"^(?>\s|<\?[^>]*+>|<!--(?>[^-]++|-(?!->))*+-->|<![^>\[]*+>)*+<"
        root = F.regexp_extract(data, head + r"([\w:.-]++)", 1)
        ended = F.endswith(F.rtrim(F.col(data), F.lit(" \t\r\n")), F.concat(F.lit("</"), root, F.lit(">")))
        alone = F.rlike(F.col(data), F.lit(head + r"""(?>[^>"']++|"[^"]*+"|'[^']*+')*+(?<=/)>\s*+$"""))
        # not a filter: that would move below any shuffle of the texts, and be worked out there by the tasks of the scan
        tags = F.when((root != "") & (ended | alone), tags)
    rows = df.select("*", F.posexplode(tags).alias("pos", "_tag"))

    listed = lambda col: F.regexp_extract_all(col, F.lit(_TOKEN), F.lit(0))
    names = [listed(F.lower("_tag")).alias("_names")] if ignore_case else []
    rows = rows.select(*df.columns, "pos", listed(F.col("_tag")).alias("_tokens"), *names)
    # A list is cleaned as a whole: code of its own for every attribute soon makes a method that Java does not compile.
    rows = rows.withColumn("_values", F.transform("_tokens", _plain_value))
    # the value stands behind the name; null if the attribute or its value is missing
    place = lambda a: F.array_position("_names", a.lower()) if ignore_case else F.array_position("_tokens", a)
    rows = rows.select(*df.columns, "pos", *[F.get("_values", F.nullif(place(a), F.lit(0)).cast("int")).alias(a) for a in fields])
    typed = {a: unescape_markup(F.col(a)) if k == "string" else F.col(a).try_cast(k) for a, k in fields.items()}
    return rows.withColumns(typed)


def _plain_value(token: Column) -> Column:
    """A value without "=" and quotes, null if it holds nothing; null for a name."""
    starts = lambda c, *with_: reduce(or_, [F.startswith(c, F.lit(w)) for w in with_])
    value = F.ltrim(token, F.lit(" \t\r\n\f="))
    inside = F.when(starts(value, '"', "'"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(F.nullif(value, F.lit("")))
    # the usual form needs no look at blanks
    return F.when(starts(token, '="', "='"), F.substring(token, F.lit(3), F.length(token) - 3)).when(F.contains(token, F.lit("=")), inside)


def unescape_markup(text: Column) -> Column:
    # The five entities XML defines; the ampersand comes last.
    plain = text
    for entity, char in [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")]:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.when(F.contains(plain, F.lit("&")), text).otherwise(plain)
