"""Prefix trie of conversations by vertical bitmaps.

A conversation is the sequence of its turns (role and text, null as empty).
Every different sequence of first turns is a node; conversations that start with
it are its members.  Turns are numbered, dealt out by stretch of ``STRETCH``
positions and conversation, and taken in shards of ``SHARD`` conversations.  In a
shard each (position, turn) has a bitset of conversations; the children of a node
are its bitset and those of the next position's turns, depth first, one
intersection a child.  A shard gives its nodes with members and end lists.

Nodes of different shards meet by their path: the sum, modulo 2 ** 64 and twice,
of the hashes of (position, role, text) of their turns.  So a stretch knows the
path that each of its conversations comes from by sums over earlier stretches,
and one conversation may hold most of the turns.

Sums over subtrees need no walk: the smallest member of a node is the smallest
member of one child, too.  So a conversation stands for the nodes of its path
from some depth on.  Texts before that depth are those it shares with a smaller
one, and a leaf counts for the conversation that stands for it.

Turns go by ``turn``, nulls first, then by role and text.  Rows without a
conversation id belong to none.  Two of the paths, of about 10^18 different
ones, may share a hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.batches import mapped
from millrace.llm.scratch import Scratch

#: Positions that one stretch spans, conversations of one shard.
STRETCH, SHARD = 256, 1024
#: Sums of hashes are kept modulo this.
WRAP = 1 << 64

TURNS = ("conv", "pos", "t1", "t2", "size")
ROWS = ("stretch", "conv", "pos", "h1", "h2", "size", "ends", "s1", "s2", "before")
PIECES = pa.schema([(n, pa.int64()) for n in ("h1", "h2", "p1", "p2", "depth", "size", "before")]
                   + [(n, pa.list_(pa.int64())) for n in ("members", "ends")])
PIECE_TYPES = ", ".join(f"{n} long" for n in PIECES.names[:7]) + ", members array<long>, ends array<long>"


def numbered(convs: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, pos from 0, t1, t2, size) of all turns: the hashes of a turn and the code points of its text.

    One conversation may hold most rows.
    """
    # needed on the driver only; tasks have this subpackage alone
    from millrace.operators.running import row_numbers, slice_chunk

    rows = convs.filter(convs[conv].isNotNull()).select(
        convs[conv].cast("long").alias("conv"), convs[turn].alias("turn"),
        *[F.coalesce(convs[c].cast("string"), F.lit("")).alias(n) for n, c in (("role", role), ("text", text))])
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    plain = dict(rows.dtypes)["turn"] in ("void", "string", "binary", "boolean")
    counted = row_numbers(rows, ["conv"], F.lit(0) if plain else slice_chunk(rows, "turn"), order, "n")
    return counted.select("conv", (F.col("n") - 1).cast("long").alias("pos"),
                          *[F.xxhash64(F.lit(seed), "role", "text").alias(n) for n, seed in (("t1", "a"), ("t2", "b"))],
                          F.length("text").cast("long").alias("size"))


def spliced(turns: DataFrame, base: Column, taken: Column, most: int) -> DataFrame:
    """Every conversation with its first ``taken`` turns, ``most`` or fewer, replaced by those of conversation ``base``.

    Both are columns of ``conv``.  A shorter base lends what it has, one that is
    absent nothing.  Each conversation keeps a row of position -1, its root.
    """
    ids = turns.select("conv").distinct()
    first = turns.filter(F.col("pos") < most).withColumnRenamed("conv", "base")
    lent = ids.select("conv", base.alias("base"), taken.alias("taken")).join(first, "base").filter("pos < taken")
    many = lent.groupBy("conv").agg(F.count(F.lit(1)).alias("lent"))
    own = turns.filter(F.col("pos") >= taken).join(many, "conv", "left")
    place = F.col("pos") - taken + F.coalesce(F.col("lent"), F.lit(0).cast("long"))
    none = F.lit(0).cast("long")
    return (lent.select(*TURNS).unionByName(own.withColumn("pos", place).select(*TURNS))
            .unionByName(ids.select("conv", F.lit(-1).cast("long").alias("pos"), none.alias("t1"), none.alias("t2"), none.alias("size"))))


def _wrapped(total: Column) -> Column:
    """An exact sum of longs as the long that it is modulo 2 ** 64."""
    wrap = F.lit(Decimal(WRAP))
    rest = F.pmod(total, wrap)
    return F.when(rest >= F.lit(Decimal(WRAP // 2)), rest - wrap).otherwise(rest).cast("long")


class _Shard:
    """Bitsets of one stretch of positions of some conversations."""

    def __init__(self, rows: dict[str, np.ndarray]):
        ids, first, number = np.unique(rows["conv"], return_index=True, return_inverse=True)
        self.ids = ids.tolist()
        self.low = int(rows["pos"].min())
        self.starts = list(zip(*[rows[n][first].tolist() for n in ("s1", "s2", "before")]))
        # the turn that stands at a place, and per turn its conversations
        self.turns: list[dict[int, tuple]] = [{} for _ in self.ids]
        self.index: dict[tuple, int] = {}
        self.ended: dict[int, int] = {}
        for i, p, h1, h2, size, ends in zip(number.tolist(), *[rows[n].tolist() for n in ROWS[2:7]]):
            turn, bit = (p, h1, h2, size), 1 << i
            self.turns[i][p] = turn
            self.index[turn] = self.index.get(turn, 0) | bit
            if ends:
                self.ended[p] = self.ended.get(p, 0) | bit

    def _listed(self, bits: int) -> list[int]:
        out = []
        while bits:
            low = bits & -bits
            out.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return out

    def nodes(self) -> Iterator[tuple]:
        """Depth first, the members of each node by intersection."""
        stack: dict[tuple, int] = {}
        for i, start in enumerate(self.starts):
            if self.low in self.turns[i]:
                stack[start] = stack.get(start, 0) | 1 << i
        open_nodes = [(s1, s2, before, self.low, bits) for (s1, s2, before), bits in stack.items()]
        while open_nodes:
            s1, s2, before, p, parent = open_nodes.pop()
            rest = parent
            while rest:
                turn = self.turns[(rest & -rest).bit_length() - 1][p]
                child = parent & self.index[turn]
                rest &= ~child
                _, h1, h2, size = turn
                k1, k2 = (s1 + h1) % WRAP, (s2 + h2) % WRAP
                ends = child & self.ended.get(p, 0)
                yield k1, k2, s1, s2, p + 1, size, before, self._listed(child), self._listed(ends)
                # conversations that go on in this stretch; turns have no gaps
                on = child & ~ends
                if on and p + 1 in self.turns[(on & -on).bit_length() - 1]:
                    open_nodes.append((k1, k2, before + size, p + 1, on))


def _signed(values: Iterable[int]) -> np.ndarray:
    return np.array([v % WRAP for v in values], dtype=np.uint64).view(np.int64)


def _batch(nodes: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*nodes))
    flat = [pa.array(_signed(c)) for c in cols[:4]] + [pa.array(c, pa.int64()) for c in cols[4:7]]
    return pa.RecordBatch.from_arrays(flat + [pa.array(c, pa.list_(pa.int64())) for c in cols[7:]], schema=PIECES)


def _shards(batches: Iterable[pa.RecordBatch], shard: int) -> Iterator[dict[str, np.ndarray]]:
    """Runs of whole conversations of one stretch, from rows that come in order."""
    held: dict[str, np.ndarray] | None = None
    for batch in batches:
        new = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(ROWS)}
        held = new if held is None else {n: np.concatenate([held[n], new[n]]) for n in ROWS}
        while True:
            next_stretch = np.flatnonzero(np.diff(held["stretch"])) + 1
            next_conv = np.flatnonzero(np.diff(held["conv"])) + 1
            cut = min([*next_stretch[:1].tolist(), *next_conv[shard - 1:shard].tolist()], default=0)
            if not cut:
                break
            yield {n: v[:cut] for n, v in held.items()}
            held = {n: v[cut:] for n, v in held.items()}
    if held is not None and len(held["conv"]):
        yield held


def pieces(rows: DataFrame, shard: int = SHARD, stretch: int = STRETCH) -> DataFrame:
    """Nodes of every shard: path and its parent's, depth, size of the last text and of those before, members, end list.

    ``rows``: (conv, pos, t1, t2, size) without gaps from position -1 on.
    """
    place = F.floor((F.col("pos") + 1) / stretch).cast("long")
    hashed = rows.select(
        place.alias("stretch"), "conv", "pos",
        *[F.when(F.col("pos") < 0, F.lit(0).cast("long")).otherwise(F.xxhash64("pos", *turn)).alias(n)
          for n, turn in (("h1", ("t1", "t2")), ("h2", ("t2", "t1")))], "size")
    wide = "decimal(38,0)"
    sums = hashed.groupBy("conv", "stretch").agg(
        F.sum(F.col("h1").cast(wide)).alias("h1"), F.sum(F.col("h2").cast(wide)).alias("h2"), F.sum("size").alias("size"), F.max("pos").alias("upto"))
    along = Window.partitionBy("conv").orderBy("stretch")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast(wide)
    starts = sums.select(
        "conv", "stretch", "upto", F.lead("upto").over(along).isNull().alias("final"),
        *[_wrapped(F.coalesce(F.sum(_wrapped(F.col(h)).cast(wide)).over(earlier), none)).alias(s) for h, s in (("h1", "s1"), ("h2", "s2"))],
        F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("long")).alias("before"))
    full = hashed.join(starts, ["conv", "stretch"]).withColumn("ends", (F.col("final") & (F.col("pos") == F.col("upto"))).cast("long"))
    dealt = full.select(*ROWS).repartitionByRange("stretch", "conv").sortWithinPartitions("stretch", "conv", "pos")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _shards(batches, shard):
            found = []
            for node in _Shard(one).nodes():
                found.append(node)
                if len(found) == 4096:
                    yield _batch(found)
                    found = []
            if found:
                yield _batch(found)

    return mapped(dealt, run, PIECE_TYPES)


def _end_digests(found: DataFrame) -> DataFrame:
    """SHA-256 of each node's end list, read shard by shard in the order of ids and never held whole."""
    lists = found.filter(F.size("ends") > 0).select("h1", "h2", F.element_at("ends", 1).alias("first"), F.array_join(F.col("ends").cast("array<string>"), ",").alias("ids"))
    dealt = lists.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "first")
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            out = []
            for h1, h2, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3)]):
                if (h1, h2) != node:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (h1, h2), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], schema=schema)
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], schema=schema)

    return mapped(dealt, run, "h1 long, h2 long, ends_sha256 string")


def trie(spark: SparkSession, rows: DataFrame, shard: int = SHARD, stretch: int = STRETCH) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows``: (conv, pos, t1, t2, size) without gaps from position -1 on, the root.
    Without a conversation there is no node.
    """
    scratch = Scratch(spark, "trie")
    rows = scratch.write(rows, "rows")
    found = scratch.write(pieces(rows, shard, stretch), "pieces")
    key = ["h1", "h2"]
    nodes = scratch.write(found.groupBy(*key).agg(
        F.sum(F.size("members")).cast("long").alias("n_convs"), F.min(F.element_at("members", 1)).alias("conv"),
        *[F.max(c).alias(c) for c in ("p1", "p2", "depth", "before")]), "nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = scratch.write(nodes.join(children, key, "left").fillna(0, ["n_children"]), "counted")
    # where a conversation begins to stand for its path, and whether it stands for a leaf
    stands = nodes.groupBy("conv").agg(F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("long")).alias("leaf"))
    totals = rows.groupBy("conv").agg(F.sum("size").alias("total"))
    weights = scratch.write(totals.join(stands, "conv", "left").select(
        "conv", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0).cast("long")).alias("leaf")), "weights")
    member = found.select("h1", "h2", "before", F.explode("members").alias("conv"))
    again = F.greatest(F.col("shared") - F.col("before"), F.lit(0).cast("long"))
    sums = member.join(weights, "conv").groupBy(*key).agg(F.sum("leaf").alias("n_leaves"), F.sum(again).alias("saved_tokens"))
    above = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    placed = nodes.filter("depth > 0").join(above, ["p1", "p2"], "left").select(*key, "conv", "depth", "parent_conv_id", "n_convs", "n_children")
    top = nodes.filter("depth = 0").select(*key, "conv", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children")
    return (placed.unionByName(top).join(sums, key).join(_end_digests(found), key, "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
