"""Stupid-backoff scores of documents, computed relationally.

Words are runs of letters and digits, lower-cased.  N-grams are told by 64-bit
hashes of their words, and their count tables are dealt out by ranges of the hash.
A document is scored by the other documents: its own counts are taken off.  A
word whose n-gram of the highest order others have adds the logarithm of that
count less that of the context; one whose n-gram others have not costs the
logarithm of the discount and asks for the n-gram without its first word.  A
word that others have not counts as half an occurrence; the last denominator is
the number of all words of others, 1 at least.

What is joined are blocks, not rows: a slice of the corpus (about SLICE_WORDS
words) counts its n-grams and sends each once, sorted, to the range it falls in.
A range adds up what the slices sent and answers each in the order it asked, so
neither a document's number nor a frequent n-gram travels more than once a
slice.  The slice then sums its documents.  Slices are written before anything
is asked, so a task that runs again asks the same; they are bucketed by their
number, so only the answers move when both meet again.

Null and empty texts have no words and score 0.  Rows that repeat a key are one
document, also those of null key: their own counts are added up by the ranges.
N-grams do not cross rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import mapped, ship
from millrace.llm.scratch import Scratch

DISCOUNT = 0.4
#: Words of a slice (one longer text is taken alone) and n-grams asked for in one range of hashes.
SLICE_WORDS, RANGE_GRAMS = 1 << 20, 1 << 20
#: Slices are long rows: few of them make a row group, so that readers hold few at a time.
FEW_ROWS = {"parquet.block.row.count.limit": "4"}


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _packed(values: np.ndarray, ascending: bool = False) -> bytes:
    """64-bit values (the steps between them if ascending), first all lowest bytes, then all second ones, compressed.

    The number of values stands in front.
    """
    values = values.astype("<i8", copy=False) if values.dtype != np.uint64 else values.view("<i8")
    planes = (np.diff(values, prepend=0) if ascending else values).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _values(packed: bytes, ascending: bool = False) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = np.frombuffer(pa.decompress(packed[8:], 8 * n, "zstd", asbytes=True), np.uint8) if n else np.zeros(0, np.uint8)
    values = np.ascontiguousarray(planes.reshape(8, n).T).view("<i8").ravel()
    return np.cumsum(values) if ascending else values


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each value, equal ones the same, in order of appearance; the different values."""
    return pd.factorize(values)


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([_values(p) for p in column.to_pylist()] or [np.zeros(0, np.int64)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (document, owner, word hashes) as slices; those that have an owner are slices of their own."""
    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(held)
        alone = pc.is_null(whole.column(1))
        for part in (whole.filter(alone), whole.filter(pc.invert(alone))):
            if part.num_rows:
                part = part.combine_chunks()
                doc, owner, rows = (part.column(i).chunk(0) for i in range(3))
                sizes = pc.list_value_length(rows).to_numpy(zero_copy_only=False)
                codes, vocabulary = _numbered(rows.flatten().to_numpy(zero_copy_only=False))
                # frequent words get small numbers, which compress better
                order = np.argsort(-np.bincount(codes, minlength=len(vocabulary)), kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
                packed = [pa.array([_packed(v)], pa.binary()) for v in (sizes, vocabulary[order], rank[codes])]
                yield pa.RecordBatch.from_arrays([one(doc), one(owner), *packed, pa.array([len(codes)], pa.int64())],
                                                 names=["docs", "owners", "sizes", "vocabulary", "codes", "n"])

    held, n = [], 0
    for batch in batches:
        # a batch may hold many words: cut it where a slice is full
        ends = np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < batch.num_rows:
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_WORDS - n, side="right")))
            held.append(batch.slice(begin, end - begin))
            n += int(ends[end - 1]) - before
            begin = end
            if n >= SLICE_WORDS or begin < batch.num_rows:
                yield from made(held)
                held, n = [], 0
    if held:
        yield from made(held)


class _Slice:
    """N-grams of a slice: which ends at each word, by order, and what the slice asks the ranges for."""

    def __init__(self, table: pa.Table, order: int):
        def flat(name: str) -> pa.Array:
            return table.column(name).combine_chunks().flatten()

        self.docs = flat("docs")
        sizes, vocabulary, codes = (_values(table.column(name)[0].as_py()) for name in ("sizes", "vocabulary", "codes"))
        vocabulary = vocabulary.view(np.uint64)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.sizes, self.place = sizes, np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owners = flat("owners")
        self.owners = np.zeros(0, np.int64)
        if len(owners) and owners[0].is_valid:
            self.owners, owner = np.unique(owners.to_numpy(), return_inverse=True)
        # numbers go on from one order to the next; -1 where a row has no such n-gram
        numbers, names, first = codes, _mixed(vocabulary + np.uint64(1)), 0
        self.ends, every = [codes], [names]
        for n in range(2, order + 1):
            at = np.flatnonzero(self.place >= n - 1)
            which, some = _numbered(numbers[at - 1] * len(vocabulary) + codes[at])
            longer = np.full(len(codes), -1, np.int64)
            longer[at] = which
            if len(some):
                names = _mixed(names[some // len(vocabulary)] * np.uint64(0x9E3779B97F4A7C15) + vocabulary[some % len(vocabulary)] + np.uint64(n))
            else:
                names = names[:0]
            first += len(every[-1])
            self.ends.append(np.where(longer >= 0, longer + first, -1))
            every.append(names)
            numbers = longer
        names = np.concatenate(every)
        # an entry is an n-gram or, where owners count apart, an n-gram of an owner
        if len(self.owners):
            many = len(self.owners)
            pairs = [np.where(e >= 0, e * many + owner[self.doc], -1) for e in self.ends]
            entries = np.unique(np.concatenate(pairs))
            entries = entries[entries >= 0]
            self.entry = [np.searchsorted(entries, p) for p in pairs]
            names, self.owner = names[entries // many], self.owners[entries % many]
        else:
            self.entry, self.owner = self.ends, None
        self.counts = sum(np.bincount(e[k >= 0], minlength=len(names)) for e, k in zip(self.entry, self.ends))
        self.order = np.argsort(names, kind="stable" if len(self.owners) else None)
        self.names = names[self.order]

    def asked(self, ranges: int) -> Iterator[tuple[int, slice]]:
        """Ranges that the slice asks, and where what it asks stands among the sorted names."""
        of = ((self.names >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
        at = np.flatnonzero(np.diff(of, prepend=np.uint64(ranges)))
        for begin, end in zip(at, [*at[1:], len(of)]):
            yield int(of[begin]), slice(int(begin), int(end))

    def others(self, answers: np.ndarray) -> list[np.ndarray]:
        """By order, how often other documents have the n-gram that ends at each word."""
        got = np.zeros(len(self.names), np.int64)
        got[self.order] = answers
        found = []
        for entry, ends in zip(self.entry, self.ends):
            some = np.flatnonzero(ends >= 0)
            n = np.zeros(len(ends), np.int64)
            n[some] = got[entry[some]]
            if self.owner is None:
                # where the corpus has one, it is the document's own
                own = np.flatnonzero(n > 1)
                which, pairs = _numbered(ends[own] * len(self.sizes) + self.doc[own])
                n[some] = np.where(n[some] > 1, n[some], 0)
                n[own] -= np.bincount(which, minlength=len(pairs))[which]
            found.append(n)
        return found


def _add_up(table: pa.Table) -> pa.Table:
    """Answers of one range: how often the corpus has each n-gram, less what its owner has."""
    each = [_values(p, True) for p in table.column("grams").to_pylist()]
    sizes, counts = [len(e) for e in each], _joined(table.column("counts"))
    which, some = _numbered(np.concatenate(each))
    n = np.bincount(which, weights=counts, minlength=len(some)).astype(np.int64)[which]
    owners = table.column("owners")
    if owners.null_count < len(owners):
        owned = np.repeat(pc.is_valid(owners).to_numpy(), sizes)
        pair, _ = _numbered(_numbered(_joined(owners.drop_null()))[0] * len(some) + which[owned])
        n[owned] -= np.bincount(pair, weights=counts[owned]).astype(np.int64)[pair]
    ends = np.cumsum(sizes)
    return pa.table({"slice": table.column("slice"), "range": table.column("range"),
                     "answers": pa.array([_packed(n[e - s:e]) for s, e in zip(sizes, ends)], pa.binary())})


def scores(spark: SparkSession, docs: DataFrame, key: str, text: str, order: int = 3, discount: float = DISCOUNT) -> DataFrame:
    """Per different ``key``: n_words and score, the sum of the natural logarithms of its words' scores."""
    scratch = Scratch(spark, "backoff")
    ship(spark)
    rows = docs.select(docs[key].alias("doc"), docs[text].alias("t"))
    kind = rows.schema["doc"].dataType
    repeated = rows.groupBy(F.col("doc").alias("d")).count().filter("count > 1").select("d", F.monotonically_increasing_id().alias("owner"))
    repeated = scratch.write(repeated, "repeated")
    hashed = rows.join(repeated, F.col("doc").eqNullSafe(F.col("d")), "left").select(
        "doc", "owner", F.transform(words(F.col("t")), lambda w: F.xxhash64(w)).alias("w"))
    lists = [("docs", kind), ("owners", T.LongType())]
    cut = mapped(hashed, _cut, T.StructType([
        *[T.StructField(n, T.ArrayType(t)) for n, t in lists],
        *[T.StructField(n, T.BinaryType()) for n in ("sizes", "vocabulary", "codes")], T.StructField("n", T.LongType())]))
    # as many buckets as the session has shuffle partitions: fewer would make the planner shuffle the slices after all
    buckets, stored = int(spark.conf.get("spark.sql.shuffle.partitions")), f"backoff_{uuid.uuid4().hex}"
    cut.withColumn("slice", F.monotonically_increasing_id()).write.options(**FEW_ROWS).bucketBy(buckets, "slice").saveAsTable(
        stored, format="parquet", path=f"{scratch.base}/slices")
    slices = spark.table(stored)
    total = slices.agg(F.sum("n")).first()[0] or 0
    ranges = -(-total * order // RANGE_GRAMS) or 1

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part = pa.Table.from_batches([batch.slice(i, 1)]).rename_columns(["docs", "owners", "sizes", "vocabulary", "codes", "slice"])
                one = _Slice(part, order)
                counts, owner = one.counts[one.order], None if one.owner is None else one.owner[one.order]
                to = list(one.asked(ranges))
                yield pa.RecordBatch.from_pydict({
                    "range": pa.array([r for r, _ in to], pa.int32()), "slice": pa.array([part.column("slice")[0].as_py()] * len(to), pa.int64()),
                    "grams": pa.array([_packed(one.names[at], True) for _, at in to], pa.binary()),
                    "counts": pa.array([_packed(counts[at]) for _, at in to], pa.binary()),
                    "owners": pa.array([None if owner is None else _packed(owner[at]) for _, at in to], pa.binary())})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        one = _Slice(left, order)
        answers = _joined(right.sort_by("range").column("answers"))
        others = one.others(answers)
        value, bare, left_open = np.zeros(len(one.place)), np.zeros(len(one.place)), np.zeros(len(one.place), bool)
        for n in range(order, 0, -1):
            left_open |= one.place >= n - 1 if n == order else one.place == n - 1
            seen = others[n - 1]
            if n == 1:
                value[left_open] += np.log(np.maximum(seen[left_open], 0.5))
                bare[left_open] = 1
            else:
                has = np.flatnonzero(left_open & (seen > 0))
                value[has] += np.log(seen[has]) - np.log(np.maximum(others[n - 2][has - 1], 0.5))
                left_open[has] = False
                value[left_open] += np.log(discount)
        each = len(one.sizes)
        return pa.table({"doc": one.docs, "n_words": pa.array(one.sizes.astype(np.int64)),
                         "part": pa.array(np.bincount(one.doc, value, each), pa.float64()),
                         "bare": pa.array(np.bincount(one.doc, bare, each), pa.float64())})

    asked = mapped(slices.select("docs", "owners", "sizes", "vocabulary", "codes", "slice"), ask,
                   "range int, slice long, grams binary, counts binary, owners binary")
    answers = asked.groupBy("range").applyInArrow(_add_up, "slice long, range int, answers binary")
    scored = slices.drop("n").groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(score, T.StructType([
        T.StructField("doc", kind), T.StructField("n_words", T.LongType()), T.StructField("part", T.DoubleType()), T.StructField("bare", T.DoubleType())]))
    try:
        scored = scratch.write(scored, "scored")
    finally:
        spark.sql(f"drop table {stored}")
    scratch.drop("slices", "repeated")
    each = scored.groupBy("doc").agg(*[F.sum(c).alias(c) for c in ("n_words", "part", "bare")])
    rest = F.log(F.greatest(F.lit(total) - F.col("n_words"), F.lit(1)).cast("double"))
    return each.select(F.col("doc").alias(key), "n_words", (F.col("part") - F.col("bare") * rest).alias("score"))


#: The scores of order 3 in DuckDB's SQL, on words instead of hashes.
SQL = r"""
with d as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') w from documents),
sizes as (select doc_id, sum(len(w))::bigint n_words from d group by 1),
p as (select doc_id, w, unnest(range(1, len(w) + 1)) i from d),
t as (select doc_id, w[i] k1, case when i > 1 then w[i - 1] || ' ' || w[i] end k2,
             case when i > 2 then w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] end k3,
             case when i > 1 then w[i - 1] end x1, case when i > 2 then w[i - 2] || ' ' || w[i - 1] end x2 from p),
o1 as (select doc_id, k1 k, count(*) n from t group by 1, 2), o2 as (select doc_id, k2 k, count(*) n from t where k2 is not null group by 1, 2),
o3 as (select doc_id, k3 k, count(*) n from t where k3 is not null group by 1, 2),
c1 as (select k, sum(n) n from o1 group by 1), c2 as (select k, sum(n) n from o2 group by 1), c3 as (select k, sum(n) n from o3 group by 1),
r1 as (select doc_id, k, c1.n - o1.n n from o1 join c1 using (k)), r2 as (select doc_id, k, c2.n - o2.n n from o2 join c2 using (k)),
r3 as (select doc_id, k, c3.n - o3.n n from o3 join c3 using (k)),
s as (select t.doc_id,
        case when a3.n > 0 then ln(a3.n) - ln(b2.n)
             else case when k3 is not null then ln(0.4) else 0 end
                + case when a2.n > 0 then ln(a2.n) - ln(b1.n)
                       else case when k2 is not null then ln(0.4) else 0 end + ln(greatest(a1.n, 0.5))
                          - ln(greatest((select sum(n_words) from sizes) - sizes.n_words, 1)) end end score
      from t join sizes using (doc_id)
      left join r3 a3 on a3.doc_id = t.doc_id and a3.k = k3 left join r2 b2 on b2.doc_id = t.doc_id and b2.k = x2
      left join r2 a2 on a2.doc_id = t.doc_id and a2.k = k2 left join r1 b1 on b1.doc_id = t.doc_id and b1.k = x1
      left join r1 a1 on a1.doc_id = t.doc_id and a1.k = k1)
select sizes.doc_id, sizes.n_words, round(coalesce(sum(score), 0), 4) score from sizes left join s on s.doc_id = sizes.doc_id group by 1, 2
"""
