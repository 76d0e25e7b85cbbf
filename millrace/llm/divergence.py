"""How far the sources of a language are apart in their words, in exact whole numbers.

A term is a run of letters (A-Z lower-cased) and characters beyond ASCII.  Each
language keeps the terms of at least ``least`` of its documents.  A group, one
(language, source), gives each kept term the share of ``SCALE`` that smoothed
counts ask for; so does the language as a whole.

Pairs of groups follow Gustavson's order.  Terms and groups of a language are
cut into blocks.  For one slice of terms and two blocks of groups a task holds
the term-major index of one block; each group of the other scatters its terms
through it into a dense row of one sum per peer, so no pair of postings is ever
a row.  A term that a group lacks still has its share of zero, so the sums start
from these baselines and the scattered values correct them:

    sum |p - q| = V |z - y| + sum over own terms (|p - y| - |z - y|)
                + sum over the peer's terms (|z - q| - |z - y|)
                + sum over shared terms (|p - q| - |p - y| - |z - q| + |z - y|)

with z and y the shares of zero of the two groups.

Null text, language and source count as empty.  Repeated rows are documents of
their own.  A group without terms has the share 1 of its language's terms, or
no term at all where the language keeps none.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.batches import byte_view, mapped, ranges, slices
from millrace.llm.scratch import Scratch

SCALE, SMOOTH = 10 ** 9, 5
#: Groups of a block, and counted terms that a slice of a block holds about.
BLOCK, SLICE_TERMS = 512, 200_000
#: Counts that a task holds before it hands them on, bytes of one text taken at a time.
HELD, PIECE = 400_000, 1 << 20

COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
COUNT_TYPES = "lang string, source string, term string, n long, docs long"

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = _LETTER[ord("A"):ord("Z") + 1] = _LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _terms(data: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The terms of some bytes, one after the other, and where each begins."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = _LETTER[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    at = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    kept = _LOWER[data[inside[1:-1].astype(bool)]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(kept)])
    return words, starts


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """(lang, source, term, n, docs) of some whole rows (lang, source, text), and a row without term for each group."""
    data, at = byte_view(batch.column(2))
    # no term reaches from one text into the next
    data, at = np.insert(data, at[1:-1], ord(" ")), at + np.minimum(np.arange(len(at)), max(0, len(at) - 2))
    groups = pa.StructArray.from_arrays([batch.column(0).cast(pa.string()), batch.column(1).cast(pa.string())], ["lang", "source"])
    codes: dict[tuple, int] = {}
    group_of = np.array([codes.setdefault((g["lang"], g["source"]), len(codes)) for g in groups.to_pylist()], np.int64)
    parts = []
    for begin, end, row in _pieces(data, at):
        words, starts = _terms(data[begin:end])
        coded = words.dictionary_encode()
        doc = np.searchsorted(at, starts + begin, side="right") - 1 if row is None else np.full(len(words), row)
        pairs, n = np.unique(doc * max(1, len(coded.dictionary)) + coded.indices.to_numpy(), return_counts=True)
        width = max(1, len(coded.dictionary))
        parts.append(pa.table({"doc": pairs // width, "term": coded.dictionary.take(pa.array(pairs % width)), "n": n}))
    each = pa.concat_tables(parts) if parts else pa.table({"doc": pa.array([], pa.int64()), "term": pa.array([], pa.large_binary()), "n": pa.array([], pa.int64())})
    if len(parts) > 1:
        # a long text comes in pieces: its terms are counted once
        each = each.group_by(["doc", "term"]).aggregate([("n", "sum")]).rename_columns(["doc", "term", "n"])
    each = each.append_column("group", pa.array(group_of[each["doc"].to_numpy()]))
    by = each.group_by(["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
    names = list(codes)
    group = by["group"].to_numpy()
    lang, source = [pa.array([k[i] for k in names], pa.string()) for i in (0, 1)]
    return pa.table({
        "lang": pa.concat_arrays([lang.take(pa.array(group)), lang]), "source": pa.concat_arrays([source.take(pa.array(group)), source]),
        "term": pa.concat_arrays([by["term"].combine_chunks().cast(pa.binary()).cast(pa.string()), pa.nulls(len(names), pa.string())]),
        "n": pa.concat_arrays([by["n_sum"].combine_chunks(), pa.array(np.zeros(len(names), np.int64))]),
        "docs": pa.concat_arrays([by["n_count"].combine_chunks(), pa.array(np.zeros(len(names), np.int64))])})


def _pieces(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, int | None]]:
    """All rows at once, or one long row cut where no term is."""
    if len(at) > 2 or len(data) <= 2 * PIECE:
        yield 0, len(data), None
        return
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + PIECE)
        while end < len(data) and _LETTER[data[end]]:
            step = data[end:end + 4096]
            gap = np.flatnonzero(~_LETTER[step])
            end += int(gap[0]) if len(gap) else len(step)
        yield begin, end, 0
        begin = end


def _count_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def summed() -> pa.Table:
        got = pa.concat_tables(held).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
        return got.rename_columns(COUNTS.names).cast(COUNTS).combine_chunks()

    for batch in slices(batches, 2):
        held.append(_counted(batch))
        rows += len(held[-1])
        if rows > HELD:
            held = [summed()]
            rows = len(held[0])
            if rows > HELD // 2:
                yield from held[0].to_batches(max_chunksize=50_000)
                held, rows = [], 0
    if held:
        yield from summed().to_batches(max_chunksize=50_000)


def counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents that have the term; a row without term for each group."""
    rows = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))])
    return mapped(rows, _count_rows, COUNT_TYPES).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (n + SMOOTH) / (total + SMOOTH kept)), exact beyond 64 bits; 1 where nothing is kept."""
    wide = "decimal(38,0)"
    over = (F.lit(Decimal(SCALE)) * (n + SMOOTH).cast("decimal(20,0)")).cast(wide)
    under = F.when(kept > 0, total + SMOOTH * kept).otherwise(F.lit(1).cast("long")).cast(wide)
    return F.lit(1).cast("long") + F.when(kept > 0, F.floor((over - over % under) / under).cast("long")).otherwise(F.lit(0).cast("long"))


def _distances(values: np.ndarray, points: np.ndarray) -> np.ndarray:
    """The sum of |v - x| over all values, for each point x."""
    v = np.sort(values)
    upto = np.zeros(len(v) + 1, np.int64)
    np.cumsum(v, out=upto[1:])
    below = np.searchsorted(v, points)
    return points * below - upto[below] + (upto[-1] - upto[below]) - points * (len(v) - below)


class _Block:
    """The groups of a block in one slice of terms: shares of zero, and terms with shares, group by group."""

    def __init__(self, groups: list[tuple[int, int]], entries: tuple[np.ndarray, np.ndarray, np.ndarray]):
        ids = sorted(set(groups))
        self.ids = np.array([g for g, _ in ids], np.int64)
        self.zero = np.array([z for _, z in ids], np.int64)
        group, self.term, self.share = entries
        place = np.searchsorted(self.ids, group)
        order = np.argsort(place, kind="stable")
        self.term, self.share = self.term[order], self.share[order]
        self.at = np.searchsorted(place[order], np.arange(len(ids) + 1))


def correct(rows: _Block, peers: _Block, terms: int) -> np.ndarray:
    """What the terms of a slice add to V |z - y|, one line a group, one column a peer."""
    # the index by term: peers and shares
    owner = np.repeat(np.arange(len(peers.ids)), np.diff(peers.at))
    order = np.argsort(peers.term, kind="stable")
    post, q = owner[order], peers.share[order]
    first = np.searchsorted(peers.term[order], np.arange(terms + 1))
    out = np.zeros((len(rows.ids), len(peers.ids)), np.int64)
    for j in range(len(peers.ids)):
        own = peers.share[peers.at[j]:peers.at[j + 1]]
        out[:, j] += _distances(own, rows.zero) - len(own) * np.abs(rows.zero - peers.zero[j])
    for g in range(len(rows.ids)):
        t, p, z = rows.term[rows.at[g]:rows.at[g + 1]], rows.share[rows.at[g]:rows.at[g + 1]], rows.zero[g]
        gap = np.abs(z - peers.zero)
        out[g] += _distances(p, peers.zero) - len(t) * gap
        many = first[t + 1] - first[t]
        spots = ranges(first[t], many)
        to, theirs, mine = post[spots], q[spots], np.repeat(p, many)
        both = np.abs(mine - theirs) - np.abs(mine - peers.zero[to]) - np.abs(z - theirs) + gap[to]
        # a dense sum per peer; whole numbers far below 2 ** 53, so exact
        out[g] += np.bincount(to, weights=both, minlength=len(peers.ids)).astype(np.int64)
    return out


PAIR_ROWS = "lang string, a long, b long, part long"
PART_TYPES = pa.schema([("lang", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("part", pa.int64())])


def _pair_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (lang, low, high, slice, block, group, term, share), those of one key together."""
    held: list[pa.RecordBatch] = []

    def solve() -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        low, high = whole.column(1)[0].as_py(), whole.column(2)[0].as_py()
        block, group, share = [whole.column(i).to_numpy() for i in (4, 5, 7)]
        coded = whole.column(6).combine_chunks().dictionary_encode()
        head = coded.indices.is_null().to_numpy(zero_copy_only=False)
        term = coded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)

        def side(b: int) -> _Block:
            top, rest = (block == b) & head, (block == b) & ~head
            return _Block(list(zip(group[top].tolist(), share[top].tolist())), (group[rest], term[rest], share[rest]))

        rows = side(low)
        peers = rows if low == high else side(high)
        found = correct(rows, peers, len(coded.dictionary))
        a, b = np.repeat(rows.ids, len(peers.ids)), np.tile(peers.ids, len(rows.ids))
        value, lang = found.ravel(), whole.column(0)[0].as_py()
        if low == high:
            apart = a != b
            a, b, value = a[apart], b[apart], value[apart]
        else:
            a, b, value = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([value, value])
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(value)], schema=PART_TYPES)

    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i) for i in range(4)]
        change = np.zeros(batch.num_rows, bool)
        for k in keys:
            change[1:] |= pc.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            key = tuple(k[begin].as_py() for k in keys)
            if key != last and held:
                yield from solve()
                held = []
            last = key
            held.append(batch.slice(begin, end - begin))
    if held:
        yield from solve()


def audit(spark: SparkSession, docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", least: int = 30,
          top: int = 50, block: int = BLOCK, slice_terms: int = SLICE_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): other sources by their distance, and the ``top`` terms a source has too many of."""
    scratch = Scratch(spark, "divergence")
    all_counts = scratch.write(counts(docs, lang, source, text), "counts")
    words = all_counts.filter("term is not null")
    kept = scratch.write(words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least).drop("docs"), "kept")
    langs = all_counts.select("lang").distinct().join(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total")), "lang", "left").fillna(0, ["kept", "lang_total"])
    entries = scratch.write(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "entries")
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    groups = all_counts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total", "terms"]).join(langs, "lang")
    # groups of a language by number, block by block
    inside = Window.partitionBy("lang").orderBy("source")
    size = F.sum("terms").over(Window.partitionBy("lang"))
    last = F.count(F.lit(1)).over(Window.partitionBy("lang"))
    groups = scratch.write(groups.select(
        "*", (F.row_number().over(inside) - 1).cast("long").alias("group"), last.alias("groups"), size.alias("entries")).withColumns({
            "block": F.floor(F.col("group") / block).cast("long"), "blocks": F.ceil(F.col("groups") / block).cast("long"),
            "zero": _share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))}).withColumn(
            "slices", F.greatest(F.lit(1), F.ceil(F.col("entries") / F.col("blocks") / slice_terms)).cast("long")), "groups")
    shares = scratch.write(entries.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "group", "block", "blocks", "slices", _share(F.col("n"), F.col("total"), F.col("kept")).alias("share"),
        _share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("usual")), "shares")
    scratch.drop("counts", "kept", "entries")

    piece = F.pmod(F.xxhash64("term"), F.col("slices"))
    rows = shares.select("lang", "block", "blocks", "group", "term", "share", piece.alias("slice"))
    heads = groups.select("lang", "block", "blocks", "group", F.lit(None).cast("string").alias("term"), F.col("zero").alias("share"),
                          F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
    met = rows.unionByName(heads).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = met.select("lang", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "slice", "block", "group", "term", "share")
    key = ["lang", "low", "high", "slice"]
    parts = mapped(dealt.repartition(*key).sortWithinPartitions(*key, "block", "group"), _pair_rows, PAIR_ROWS)
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    named = groups.select("lang", "source", "group", "zero", "kept")
    mine = named.select("lang", F.col("group").alias("a"), "source", F.col("zero").alias("z"), "kept")
    theirs = named.select("lang", F.col("group").alias("b"), F.col("source").alias("item"), F.col("zero").alias("y"))
    value = F.col("part") + F.col("kept") * F.abs(F.col("z") - F.col("y"))
    pairs = sums.join(mine, ["lang", "a"]).join(theirs, ["lang", "b"]).select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    more = shares.filter("share > usual").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("share") - F.col("usual")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return (pairs.withColumn("rank", F.row_number().over(order))
            .unionByName(more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)))


SQL = f"""
with d as (select coalesce(lang, '') lang, coalesce(source, '') source,
             regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') w, row_number() over () k from documents),
o as (select lang, source, k, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') term from d),
kept as (select lang, term, count(*) n from o group by 1, 2 having count(distinct k) >= 30),
langs as (select lang, count(*) v, sum(n) total from kept group by 1),
c as (select o.lang, o.source, o.term, count(*) n from o join kept on kept.lang = o.lang and kept.term = o.term group by 1, 2, 3),
g as (select x.lang, x.source, coalesce(t.total, 0) total from (select distinct lang, source from d) x
      left join (select lang, source, sum(n) total from c group by 1, 2) t on t.lang = x.lang and t.source = x.source),
p as (select g.lang, g.source, kept.term, coalesce(c.n, 0) n,
        1 + ({SCALE}::hugeint * (coalesce(c.n, 0) + {SMOOTH})) // (g.total + {SMOOTH} * langs.v) p,
        1 + ({SCALE}::hugeint * (kept.n + {SMOOTH})) // (langs.total + {SMOOTH} * langs.v) q
      from g join kept on kept.lang = g.lang join langs on langs.lang = g.lang
      left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term),
apart as (select a.lang, a.source, 'pair' part, b.source item, sum(abs(a.p - b.p)) f
          from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 4),
pairs as (select a.lang, a.source, 'pair' part, b.source item, coalesce(apart.f, 0)::bigint as value
          from g a join g b on a.lang = b.lang and a.source <> b.source
          left join apart on apart.lang = a.lang and apart.source = a.source and apart.item = b.source),
more as (select lang, source, 'term' part, term item, (p - q)::bigint as value from p where n > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
           from (select * from pairs union all select * from more))
select * from ranked where part = 'pair' or rank <= 50
"""
