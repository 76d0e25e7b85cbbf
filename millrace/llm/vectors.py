"""Near-duplicate vectors by dual traversal of cover trees.

Vectors are compared only under equal labels (and equal lengths).  Equal vectors
are collapsed first.  A label of more than ``chunk`` vectors is cut into cells:
each vector goes to the nearest of some centres, the first of a farthest-first
order of a bounded sample.  Two cells are compared only if their centres are not
farther apart than both covering radii and the threshold; a cell of more than
``chunk`` vectors goes in several parts, told apart by a hash.  So every pair of
vectors that may link meets in exactly one group, whatever the centres are; they
decide about the work, not the result.

In a group each side becomes a cover tree: nodes with halving radii, each
covering its points, down to single points.  Pairs of nodes whose distance
exceeds both covering radii and the threshold are left with all below them.
Pairs of points that remain are checked by their cosine in double precision.  A
group passes on how many vectors each one links to and a forest of the links.

Vectors without an id or a label, null, empty or zero ones and those that hold
null or non-finite numbers link with nothing.  Rows that repeat an id and its
vector are copies of each other; an id with several vectors is one node.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.batches import mapped
from millrace.llm.components import components, unite
from millrace.llm.scratch import Scratch

#: Vectors of one part of a cell; labels that get centres, centres in all, vectors a label that they are chosen from.
CHUNK, LABELS, CENTRES, SAMPLE = 4096, 1024, 8192, 512
#: Slack for rounding when pairs of nodes are left.
SLACK = 1e-6


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


class CoverTree:
    """Nested nets of unit vectors; node 0 is the root."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.centre: list[int] = []
        self.cover: list[float] = []
        self.children: list[np.ndarray | None] = []
        start = np.arange(len(points))
        self._node(0, float(0))
        todo = [(0, start, _distances(points[start], points[:1])[:, 0])]
        while todo:
            node, members, far = todo.pop()
            self.cover[node] = float(far.max())
            if len(members) == 1:
                continue
            # the next halving of the radius that parts the members; equal points are parted one by one
            radius = 2.0 ** np.ceil(np.log2(self.cover[node]) - 1) if self.cover[node] > 1e-7 else -1.0
            below, centre = [], self.centre[node]
            while len(members):
                inside = far <= radius
                inside[0] = True
                child = self._node(centre, 0.0)
                below.append(child)
                todo.append((child, members[inside], np.where(members[inside] == centre, 0.0, far[inside])))
                members = members[~inside]
                if len(members):
                    centre = int(members[0])
                    far = _distances(points[members], points[centre:centre + 1])[:, 0]
                    far[0] = 0.0
            self.children[node] = np.array(below)
        self.centre, self.cover = np.array(self.centre), np.array(self.cover)

    def _node(self, centre: int, cover: float) -> int:
        self.centre.append(centre)
        self.cover.append(cover)
        self.children.append(None)
        return len(self.centre) - 1


def close_points(a: CoverTree, b: CoverTree, limit: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of pairs of points that are not left by their nodes; of one tree with itself each pair once."""
    todo, held_i, held_j, held = [(0, 0)], [], [], 0
    single = lambda tree, nodes: np.array([tree.children[n] is None for n in nodes])
    while todo:
        x, y = todo.pop()
        xs = a.children[x] if a.children[x] is not None else np.array([x])
        ys = b.children[y] if b.children[y] is not None else np.array([y])
        lone_x, lone_y = single(a, xs), single(b, ys)
        for begin in range(0, len(xs), 512):
            some = xs[begin:begin + 512]
            apart = _distances(a.points[a.centre[some]], b.points[b.centre[ys]])
            i, j = np.nonzero(apart <= a.cover[some][:, None] + b.cover[ys][None, :] + (limit + SLACK))
            i = i + begin
            if a is b and x == y:
                i, j = i[i <= j], j[i <= j]
            lone = lone_x[i] & lone_y[j]
            p, q = a.centre[xs[i[lone]]], b.centre[ys[j[lone]]]
            if a is b:
                p, q = p[p != q], q[p != q]
            held_i.append(p)
            held_j.append(q)
            held += len(p)
            todo += list(zip(xs[i[~lone]].tolist(), ys[j[~lone]].tolist()))
            if held > 1 << 18:
                yield np.concatenate(held_i), np.concatenate(held_j)
                held_i, held_j, held = [], [], 0
    if held:
        yield np.concatenate(held_i), np.concatenate(held_j)


def linked(rows: np.ndarray, copies: np.ndarray, side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each row (counted with copies) and its root in the forest of links.

    side: 0 and 1 compare the two sides, all 0 compares the rows with each other.
    """
    limit = np.sqrt(max(0.0, 2 - 2 * least))
    points, degree, parent = unit(rows), np.zeros(len(rows), np.int64), np.arange(len(rows))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(left) or (len(right) == 0 and len(left) < 2):
        return degree, parent
    a = CoverTree(points[left])
    b, at = (CoverTree(points[right]), right) if len(right) else (a, left)
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    norms = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    for i, j in close_points(a, b, limit):
        i, j = left[i], at[j]
        for begin in range(0, len(i), 1 << 15):
            p, q = i[begin:begin + (1 << 15)], j[begin:begin + (1 << 15)]
            near = np.einsum("ij,ij->i", scaled[p], scaled[q]) / (norms[p] * norms[q]) >= least
            p, q = p[near], q[near]
            np.add.at(degree, p, copies[q])
            np.add.at(degree, q, copies[p])
            unite(parent, p, q)
    unite(parent, np.arange(len(rows)), parent.copy())
    return degree, parent


def _farthest_first(points: np.ndarray, n: int) -> np.ndarray:
    chosen, far = [0], _distances(points, points[:1])[:, 0]
    while len(chosen) < min(n, len(points)) and far.max() > 1e-6:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _distances(points, points[chosen[-1]:chosen[-1] + 1])[:, 0])
    return points[chosen]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def near_copies(spark: SparkSession, table: DataFrame, key: str, vector: str, label: str, least: float = 0.98,
                chunk: int = CHUNK, centres: int = CENTRES) -> DataFrame:
    """Per row of ``table``: ``key``, n_links, component_id, kept."""
    if not 0.5 <= least <= 1:
        raise ValueError("least must be a cosine of 0.5 to 1")
    scratch = Scratch(spark, "vectors")
    numbers = table[vector].cast("array<double>")
    bad = F.exists(numbers, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = table[key].isNotNull() & table[label].isNotNull() & numbers.isNotNull() & ~bad & F.exists(numbers, lambda x: x != 0)
    # -0.0 and 0.0 are the same vector
    plain = F.transform(numbers, lambda x: x + F.lit(0.0))
    named = table.select(table[key].alias("id"), F.coalesce(fine, F.lit(False)).alias("fine"), table[label].alias("label"), plain.alias("v"))
    named = named.select("id", "fine", F.xxhash64("label", F.size("v")).alias("code"), F.xxhash64(F.lit(1), "label", F.size("v")).alias("code2"),
                         F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2"), "v")
    same = ["code", "code2", "h1", "h2"]
    ids = scratch.write(named.select("id", "fine", *same), "ids")
    groups = scratch.write(ids.filter("fine").groupBy(*same).agg(F.min("id").alias("node"), F.count("*").alias("copies")), "groups")
    sizes = scratch.write(groups.groupBy("code", "code2").agg(F.count("*").alias("n")), "sizes")
    large = sizes.filter(F.col("n") > chunk).orderBy(F.desc("n"), "code").limit(LABELS).collect()
    single = named.filter("fine").select(F.col("id").alias("node"), *same, "v").join(groups, [*same, "node"]).select("node", *same, "copies", "v")

    nets: dict[tuple[int, int], np.ndarray] = {}
    if large:
        # at most LABELS * SAMPLE rows, of which centres stay
        each = max(1, centres // len(large))
        wanted = spark.createDataFrame([(r["code"], r["code2"]) for r in large], "code long, code2 long")
        order = Window.partitionBy("code", "code2").orderBy("h1", "h2", "node")
        few = single.join(F.broadcast(wanted), ["code", "code2"]).withColumn("k", F.row_number().over(order)).filter(
            F.col("k") <= min(SAMPLE, max(1, 8 * centres // len(large))))
        picked: dict[tuple[int, int], list] = {}
        for r in few.select("code", "code2", "v").collect():
            picked.setdefault((r["code"], r["code2"]), []).append(r["v"])
        for r in large:
            points = unit(np.array(picked[r["code"], r["code2"]]))
            nets[r["code"], r["code2"]] = _farthest_first(points, min(each, -(-2 * r["n"] // chunk)))

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            codes = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
            cell, far = np.zeros(part.num_rows, np.int32), np.zeros(part.num_rows)
            for code in {c for c in codes if c in nets}:
                some = np.array([i for i, c in enumerate(codes) if c == code])
                apart = _distances(unit(_matrix(part.column(6).take(pa.array(some)))), nets[code])
                cell[some], far[some] = apart.argmin(axis=1), apart.min(axis=1)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2), pa.array(cell), pa.array(far), part.column(5), part.column(6)],
                                             names=["node", "code", "code2", "cell", "far", "copies", "v"])

    cells = scratch.write(mapped(single, assign, "node long, code long, code2 long, cell int, far double, copies long, v array<double>"), "cells")
    # one row a cell: CENTRES at most, and one for each label without centres
    held = cells.groupBy("code", "code2", "cell").agg(F.max("far").alias("radius"), F.count("*").alias("n"))
    held = scratch.write(held.withColumn("parts", F.ceil(F.col("n") / chunk).cast("int")), "held")
    limit = float(np.sqrt(2 - 2 * least)) + SLACK
    meet, codes = [], {code: {} for code in nets}
    if nets:
        for r in held.join(F.broadcast(wanted), ["code", "code2"]).collect():
            codes[r["code"], r["code2"]][r["cell"]] = r["radius"]
        for code, radius in codes.items():
            own = sorted(radius)
            apart, reach = _distances(nets[code][own], nets[code][own]), np.array([radius[c] for c in own])
            for i, j in zip(*np.nonzero(apart <= reach[:, None] + reach[None, :] + limit)):
                if i < j:
                    meet.append((*code, own[i], own[j]))
    pairs = spark.createDataFrame(meet, "code long, code2 long, a int, b int")
    every = held.select("code", "code2", F.col("cell").alias("a"), F.col("cell").alias("b")).unionByName(pairs)
    parts = held.select("code", "code2", "cell", "parts")
    of = lambda name: parts.select("code", "code2", F.col("cell").alias(name), F.col("parts").alias(f"n{name}"))
    every = every.join(of("a"), ["code", "code2", "a"]).join(of("b"), ["code", "code2", "b"])
    every = every.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("na") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    every = every.filter((F.col("a") < F.col("b")) | (F.col("i") <= F.col("j"))).withColumn(
        "grp", F.xxhash64("code", "code2", "a", "i", "b", "j"))
    alone = (F.col("a") == F.col("b")) & (F.col("i") == F.col("j"))
    seat = lambda cell, part, side: F.struct(F.col(cell).alias("cell"), F.col(part).alias("part"), F.lit(side).alias("side"))
    seats = every.select("code", "code2", "grp", F.explode(F.when(alone, F.array(seat("a", "i", 0))).otherwise(
        F.array(seat("a", "i", 0), seat("b", "j", 1)))).alias("s")).select("code", "code2", "grp", "s.*")
    seats = scratch.write(seats, "seats")
    own = F.pmod(F.xxhash64("node", F.lit("part")), F.col("parts")).cast("int").alias("part")
    parted = cells.join(parts, ["code", "code2", "cell"]).select("code", "code2", "cell", own, "node", "copies", "v")
    seated = parted.join(seats, ["code", "code2", "cell", "part"]).select("grp", "code", "code2", "side", "node", "copies", "v")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _groups(batches):
            rows = _matrix(part.column(6))
            degree, root = linked(rows, part.column(5).to_numpy(), part.column(3).to_numpy(), least)
            some = np.flatnonzero(degree)
            node = part.column(4).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[root[some]]), pa.array(degree[some])], names=["node", "root", "n"])

    ordered = seated.repartition("grp", "code", "code2").sortWithinPartitions("grp", "code", "code2", "side", "node")
    found = scratch.write(mapped(ordered, compare, "node long, root long, n long"), "found")
    joined = scratch.write(components(spark, found, "node", "root"), "joined")
    degrees = scratch.write(found.groupBy("node").agg(F.sum("n").alias("n")), "degrees")
    known = groups.select(*same, "node", "copies")
    result = ids.join(known, same, "left").join(degrees, "node", "left").join(joined, "node", "left")
    links = F.when(F.col("fine"), F.coalesce("n", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long")
    component = F.when(F.col("fine"), F.coalesce("component", "node")).otherwise(F.col("id"))
    return result.select(F.col("id").alias(key), links.alias("n_links"), component.alias("component_id"),
                         (F.col("id") == component).alias("kept"))


def _groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One batch a group; rows come sorted by the first three columns."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if begin == end:
                continue
            key = tuple(keys[begin])
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(begin, end - begin))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
