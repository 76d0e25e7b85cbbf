"""SimHash fingerprints and their groups within a bit distance, by bit-sliced comparison.

Fingerprints: ASCII letters are lower-cased, words are what white space
separates, a shingle is ``shingle`` words joined by one space (a shorter text is
one shingle).  A bit is set if it is set in over half of the shingles' XXH64.
Null and empty texts and texts of white space have no shingle: fingerprint 0,
linked like any other.

Links: fingerprints are collapsed to distinct ones, cut into radius + 2 pieces,
and dealt out once for every two pieces; two fingerprints within the radius
agree in at least two pieces, so they meet.  Inside a bucket the fingerprints
lie as 64 bit planes.  Comparing each row with the row d places on is an
exclusive-or of planes shifted by d bits; carry-save counters add up 64 distances
a word, and a block of words is left as soon as all its distances exceed the
radius.  A bucket passes on a forest of its links, not its pairs.  Buckets of
over ``chunk`` fingerprints are cut into chunks, and pairs of chunks are
compared as groups of their own, so no bucket has to fit in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import fresh, mapped, slices
from millrace.llm.components import components, unite
from millrace.llm.scratch import Scratch

#: Fingerprints of one bucket that are compared in one group.
CHUNK = 2048
#: Rows of buckets that a task compares together, and words of a block.
ROWS, WORDS = 1 << 16, 1 << 11
#: Planes added between two looks at the counters.
STEP = 8
ONE = np.uint64(1)


def fingerprints_of(texts: list[str | None], shingle: int) -> np.ndarray:
    """Fingerprint of each text as uint64."""
    digest, hashes, counts = xxhash.xxh64_intdigest, [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(digest(line, 42))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-shingle] + 1])
        hashes += [digest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist())]
        counts[i] = len(starts)
    out, some = np.zeros(len(texts), np.uint64), np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begins = np.cumsum(counts[some]) - counts[some]
        ones = np.add.reduceat(bits, begins, axis=0, dtype=np.int64)
        over = (2 * ones > counts[some][:, None]).astype(np.uint8)
        out[some] = np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, keys: list[str | Column], text: str, shingle: int, into: str = "fp") -> DataFrame:
    """``keys`` and the fingerprint (a long) of every row of ``docs``."""
    chosen = docs.select(*keys, docs[text].cast("string").alias("_text"))
    names = chosen.columns[:-1]
    schema = T.StructType([*chosen.schema.fields[:-1], T.StructField(into, T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, len(names)):
            found = fingerprints_of(part.column(len(names)).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], names=[*names, into])

    return mapped(chosen, run, schema)


def _shifted(planes: np.ndarray, begin: int, end: int, by: int) -> np.ndarray:
    """Words begin..end of the planes moved down by ``by`` bits."""
    skip, bits = divmod(by, 64)
    low = planes[begin + skip:end + skip]
    if not bits:
        return low
    return (low >> np.uint64(bits)) | (planes[begin + skip + 1:end + skip + 1] << np.uint64(64 - bits))


def within(planes: np.ndarray, valid: np.ndarray, begin: int, by: int, radius: int) -> np.ndarray:
    """Bits of ``valid`` whose row and the row ``by`` on differ in at most ``radius`` planes.

    planes: (64, words and some zero words); valid: the words from ``begin`` on.
    """
    end, over = begin + len(valid), ~valid
    counters = [np.zeros_like(valid) for _ in range((radius + STEP).bit_length())]
    for j in range(0, 64, STEP):
        for plane in planes[j:j + STEP]:
            carry = plane[begin:end] ^ _shifted(plane, begin, end, by)
            for k, held in enumerate(counters):
                counters[k], carry = held ^ carry, held & carry
        # more than the radius: the highest counter bit that differs from the radius is one
        same, more = ~np.zeros_like(valid), np.zeros_like(valid)
        for k in reversed(range(len(counters))):
            if radius >> k & 1:
                same &= counters[k]
            else:
                more |= same & counters[k]
                same &= ~counters[k]
        over |= more
        if (over == ~np.uint64(0)).all():
            break
    return ~over


def forest(group: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (two arrays of fingerprints) that join what the radius joins inside each group; ``group`` is sorted."""
    starts = np.flatnonzero(np.diff(group, prepend=group[:1] - 1)) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(group)))
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 1]
    if not len(order):
        return prints[:0], prints[:0]
    rows = np.concatenate([np.arange(starts[g], starts[g] + sizes[g]) for g in order]) if len(order) < 64 else _rows(starts[order], sizes[order])
    of = np.repeat(np.arange(len(order)), sizes[order])
    prints, n, sizes = prints[rows], len(rows), sizes[order]
    words = -(-n // 64)
    bits = np.unpackbits(prints.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").T
    planes = np.zeros((64, words + int(sizes[0]) // 64 + 2), np.uint64)
    planes[:, :words] = _packed(bits, words)
    parent = np.arange(n)
    ends = np.cumsum(sizes)
    for by in range(1, int(sizes[0])):
        # larger groups come first: only they have rows that far apart
        active = int(ends[np.searchsorted(-sizes, -by, side="left") - 1])
        same = np.zeros(active, np.uint8)
        same[:active - by] = of[:active - by] == of[by:active]
        valid = _packed(same[None, :], -(-active // 64))[0]
        for begin in range(0, len(valid), WORDS):
            part = valid[begin:begin + WORDS]
            close = within(planes, part, begin, by, radius)
            if close.any():
                at = np.flatnonzero(np.unpackbits(close.view(np.uint8), bitorder="little")) + begin * 64
                unite(parent, at, at + by)
    unite(parent, np.arange(n), parent.copy())
    hung = np.flatnonzero(parent != np.arange(n))
    return prints[hung], prints[parent[hung]]


def _rows(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    begins = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - begins, sizes)


def _packed(bits: np.ndarray, words: int) -> np.ndarray:
    held = np.zeros((len(bits), words * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    held[:, :packed.shape[1]] = packed
    return held.view("<u8")


def links(spark: SparkSession, prints: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fp`` of ``prints`` that join all within the radius."""
    if not 0 <= radius <= 60:
        raise ValueError("radius must be 0 to 60 bits")
    scratch = Scratch(spark, "simhash-buckets")
    pieces = radius + 2
    edges = [64 * i // pieces for i in range(pieces + 1)]

    def piece(i: int) -> Column:
        return F.shiftrightunsigned("fp", edges[i]).bitwiseAND(F.lit((1 << (edges[i + 1] - edges[i])) - 1))

    # two pieces have at most 64 bits together, so a bucket is told by the pair's number and both pieces
    keys = [F.struct(F.lit(n).cast("short").alias("pair"), piece(i).alias("p"), piece(j).alias("q"))
            for n, (i, j) in enumerate(combinations(range(pieces), 2))]
    rows = prints.select(F.explode(F.array(*keys)).alias("k"), "fp").select(F.xxhash64("k.pair", "k.p", "k.q").alias("bucket"), "fp")
    large = scratch.write(rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
                          .select("bucket", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")), "large")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = rows.join(large, "bucket", "left").select("bucket", "fp", F.coalesce(own, F.lit(0)).alias("own"), other.alias("other"))
    dealt = dealt.select("fp", F.when(F.col("own") == F.col("other"), F.xxhash64("bucket", "own")).otherwise(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).alias("grp"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, fp in whole_groups(batches, ROWS):
            a, b = forest(group, fp.view(np.uint64), radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return mapped(dealt.select("grp", "fp").repartition("grp").sortWithinPartitions("grp"), run, "a long, b long")


def whole_groups(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Two long columns, sorted by the first, in parts of about ``rows`` rows that cut no group."""
    group, value = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        group = np.concatenate([group, batch.column(0).to_numpy()])
        value = np.concatenate([value, batch.column(1).to_numpy()])
        if len(group) >= rows:
            cut = int(np.searchsorted(group, group[-1], side="left"))
            if cut:
                yield group[:cut], value[:cut]
                group, value = group[cut:], value[cut:]
    if len(group):
        yield group, value


def grouped(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
            radius: int = 4) -> DataFrame:
    """Per row of ``docs``: ``key``, fp, digest of the text, component_id, first (whether it leads its component).

    component_id is the smallest key that can be reached over links (null if
    all keys reached are null); of the rows with that key, the one of the
    smallest digest leads.  Repeated rows share their result.
    """
    scratch = Scratch(spark, "simhash")
    digest = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit(""))).alias("digest")
    rows = scratch.write(fingerprints(docs, [docs[key].alias("_key"), digest], text, shingle), "rows")
    # nulls sort behind all keys
    lead = F.min(F.struct(F.col("_key").isNull().alias("none"), "_key", "digest"))
    prints = scratch.write(rows.groupBy("fp").agg(lead.alias("lead")), "prints")
    joined = scratch.write(components(spark, scratch.write(links(spark, prints.select("fp"), radius), "links")), "joined")
    rooted = scratch.write(prints.join(joined, prints["fp"] == joined["node"], "left")
                           .select("fp", "lead", F.coalesce("component", "fp").alias("root")), "rooted")
    leads = scratch.write(rooted.groupBy("root").agg(F.min("lead").alias("best")), "leads")
    found = scratch.write(rooted.select("fp", "root").join(leads, "root").select("fp", "best"), "found")
    return rows.join(found, "fp").select(
        F.col("_key").alias(key), "fp", "digest", F.col("best._key").alias("component_id"),
        (F.col("_key").eqNullSafe(F.col("best._key")) & (F.col("digest") == F.col("best.digest"))).alias("first"),
    )


def first_of_groups(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4,
                    radius: int = 4) -> DataFrame:
    """``docs`` with one row of each group: the smallest key; of rows that repeat it, one."""
    scratch = Scratch(spark, "simhash-kept")
    firsts = scratch.write(grouped(spark, docs, key, text, shingle, radius).filter("first")
                           .groupBy(key, "digest").agg(F.count("*").alias("n")), "firsts")
    digest = F.xxhash64(F.coalesce(docs[text].cast("string"), F.lit("")))
    on = docs[key].eqNullSafe(firsts[key]) & (digest == firsts["digest"])
    kept = docs.join(firsts, on, "left_semi")
    if firsts.filter("n > 1").isEmpty():
        return kept
    order = Window.partitionBy(key, text).orderBy(F.lit(0))
    number, = fresh(docs.columns, "number")
    return kept.withColumn(number, F.row_number().over(order)).filter(F.col(number) == 1).drop(number)
