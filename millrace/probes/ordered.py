"""Ordered jobs: ranges, borders, best-so-far flags, text blocks."""

from pyspark.sql import functions as F

from millrace.operators import profile
from millrace.operators.blocks import block_lists, line_block_lists
from millrace.operators.running import best_so_far as flag_best
from millrace.operators.running import previous_value, range_chunks
from millrace.probes.registry import Tables, probe
from millrace.sources.tables import materialize

# Borders of all orders: the first day of every quarter for each priority; one of
# them has its borders a day later from 1996 on.
_RANGES_SQL = """
b AS (SELECT DISTINCT o_orderpriority AS fn, date_trunc('quarter', o_orderdate)
             + CASE WHEN o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '1996-01-01' THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS v FROM orders),
r AS (SELECT fn, lag(v, 1, TIMESTAMP '1900-01-01 00:00:00') OVER (PARTITION BY fn ORDER BY v) AS left_border, v AS right_border,
             row_number() OVER (PARTITION BY fn ORDER BY v) AS number, fn = '5-LOW' AS include_left, fn <> '5-LOW' AS include_right FROM b
      UNION ALL SELECT fn, max(v), TIMESTAMP '9999-12-31 00:00:00', count(*) + 1, false, true FROM b GROUP BY fn)
"""


def _ranges(t: Tables):
    stamp = lambda s: F.lit(s).cast("timestamp_ntz")
    late = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderdate") >= stamp("1996-01-01"))
    quarter = F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz")
    border = F.when(late, quarter + F.expr("interval 1 day")).otherwise(quarter)
    borders = t.orders.select(F.col("o_orderpriority").alias("fn"), border.alias("v"))
    return profile.range_borders(
        borders, "fn", "v", stamp("1900-01-01"), stamp("9999-12-31"), F.year("v"), on_right=F.col("fn") == "5-LOW"
    )


@probe("range_borders", f"WITH {_RANGES_SQL} SELECT * FROM r")
def range_borders(t: Tables):
    return _ranges(t)


@probe("alignment_check", f"""
WITH {_RANGES_SQL} SELECT number, count(*) AS n_rows, count(DISTINCT left_border) AS n_borders FROM r GROUP BY 1
""")
def alignment_check(t: Tables):
    return profile.alignment(_ranges(t))


@probe("first_misaligned", f"""
WITH {_RANGES_SQL}, m AS (SELECT number FROM r GROUP BY 1 HAVING count(DISTINCT left_border) > 1)
SELECT * FROM r WHERE fn = '1-URGENT' AND number = (SELECT min(number) - 1 FROM m) ORDER BY left_border
""")
def first_misaligned(t: Tables):
    """The last range of one function before the borders of the functions part."""
    ranges = materialize(_ranges(t), t.scratch("ranges"))
    return profile.last_aligned(ranges, "fn", "1-URGENT")


@probe("lag_default", """
SELECT user_id, event_id, lag(event_id, 1, -1) OVER (PARTITION BY user_id ORDER BY event_id) AS prev_event FROM events
""")
def lag_default(t: Tables):
    events = range_chunks(t.events.select("user_id", "event_id"), [F.col("event_id"), F.col("user_id")])
    rows = previous_value(events, ["user_id"], F.col("_chunk"), "event_id", F.lit(-1).cast("long"), "prev_event")
    return rows.select("user_id", "event_id", "prev_event")


@probe("best_so_far", """
WITH p AS (SELECT user_id, event_id, value, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM events)
SELECT user_id, event_id, value, prev IS NULL OR value > prev AS is_best FROM p
""")
def best_so_far(t: Tables):
    order = [F.col("ts"), F.col("event_id")]
    events = range_chunks(t.events.select("user_id", "event_id", "ts", "value"), order)
    flagged = flag_best(events, ["user_id"], F.col("_chunk"), order, "value")
    return flagged.select("user_id", "event_id", "value", "is_best")


@probe("line_block_lines", r"""
WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS lines FROM documents),
b AS (SELECT doc_id, unnest(range(0, (len(lines) - 1) // 6 + 1)) AS block, lines FROM l),
f AS (SELECT doc_id, block, regexp_replace(lines[block * 6 + 1], '^\s+|\s+$', '', 'g') AS head,
             regexp_replace(coalesce(lines[block * 6 + 2], ''), '^\s+|\s+$', '', 'g') AS item FROM b),
g AS (SELECT doc_id, block, item, last_value(nullif(head, '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head FROM f)
SELECT doc_id, head, min(block) AS first_block, coalesce(string_agg(item, ', ' ORDER BY block) FILTER (WHERE item <> ''), '') AS items
FROM g WHERE head IS NOT NULL GROUP BY 1, 2
""")
def line_block_lines(t: Tables):
    """The same lists from numbered lines, in chunks of 4 blocks."""
    parts = F.posexplode(F.split("text", r"\r\n|\r|\n", -1)).alias("line", "text")
    return line_block_lists(t.documents.select("doc_id", parts), ["doc_id"], blocks_per_chunk=4)


@probe("line_block_records", r"""
WITH l AS (SELECT doc_id, regexp_split_to_array(text, '\r\n|\r|\n') AS lines FROM documents),
b AS (SELECT doc_id, unnest(range(0, (len(lines) - 1) // 6 + 1)) AS block, lines FROM l),
f AS (SELECT doc_id, block, regexp_replace(lines[block * 6 + 1], '^\s+|\s+$', '', 'g') AS head,
             regexp_replace(coalesce(lines[block * 6 + 2], ''), '^\s+|\s+$', '', 'g') AS item FROM b),
g AS (SELECT doc_id, block, item, last_value(nullif(head, '') IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY block
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head FROM f)
SELECT doc_id, head, CAST(min(block) AS INTEGER) AS first_block,
       coalesce(string_agg(item, ', ' ORDER BY block) FILTER (WHERE item <> ''), '') AS items
FROM g WHERE head IS NOT NULL GROUP BY 1, 2
""")
def line_block_records(t: Tables):
    return block_lists(t.documents, ["doc_id"], "text")
