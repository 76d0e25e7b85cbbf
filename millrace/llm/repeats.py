"""Removal of repeated byte strings with suffix arrays by linear grouping.

Every byte that lies in a string of ``length`` bytes that also starts anywhere
else goes; matches never cross texts, and strings are judged on the input.

1. Equal texts are collapsed by a 128-bit hash.  A text of at least ``length``
   bytes that occurs more than once goes as a whole.
2. Each start of a string belongs to one anchor: the lowest hashed GRAM of bytes
   inside the string, the first of equals.  Equal strings have equal anchors at
   the same place.  Anchors that occur once in all texts are left at that.
3. The starts of one anchor make a context: from the first start to the end of
   the last string.  Equal contexts are counted and collapsed before they move.
4. Contexts of equal anchors meet in one task.  Cut into blocks of bytes from the
   anchor on, in lexicographic order as symbols, they are the text whose suffix
   array ``grouping_suffix_array`` builds.  Neighbours in it that agree in enough
   bytes, and whose few bytes in front of the block border are equal, start
   equal strings.
5. An anchor with more than ``crowd`` different contexts would not fit a task.
   Its contexts are cut into finer ones of a few starts, which mostly collapse
   or part, and go through 3 and 4 again; what is still crowded is cut into
   single strings, for which the count of 3 says it all.

Null texts count as empty; texts shorter than ``length`` keep all their bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import byte_view, columns, fresh, lists, mapped, ranges, slices
from millrace.llm.scratch import Scratch

#: Bytes whose hash chooses anchors, and bytes of a symbol (less for short lengths).
GRAM, BLOCK = 32, 32
#: Different contexts of one anchor that one task takes, and bytes of contexts it sorts together.
CROWD, SORTED_BYTES = 512, 4 << 20

#: What a context was cut from and where, its anchor's key, its own hash, anchor place, number of starts, bytes.
CONTEXT = "p1 long, p2 long, lo long, key long, c1 long, c2 long, left long, starts long, context binary"
CONTEXT_NAMES = [x.split()[0] for x in CONTEXT.split(", ")]

_base = 0x9E3779B97F4A7C15 | 1
_back = pow(_base, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def grouping_suffix_array(text: list[int]) -> list[int]:
    """Suffix array of numbers that end in a unique smallest one, in linear steps.

    Suffixes start out grouped by their first number.  From the highest group
    down, each member points to the last earlier suffix of a lower group (over
    higher ones by their own pointers).  Suffixes pointed at are followed by as
    many copies of the group's Lyndon prefix as pointers meet there, so they are
    split off behind the rest of their group, most copies last.  When all groups
    are done, the order comes out by following the same pointers back from each
    placed suffix: no renaming, no recursion.
    """
    n = len(text)
    symbols = np.asarray(text)
    order = np.argsort(symbols, kind="stable")
    first = np.diff(symbols[order], prepend=symbols[order[:1]] - 1) != 0
    begins = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    held = np.empty(n, np.int64)
    held[order] = begins
    group = held.tolist()  # where the suffix's group begins
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    place, sa = place.tolist(), order.tolist()
    end = [0] * (n + 1)
    starts = np.flatnonzero(first).tolist()
    for a, b in zip(starts, [*starts[1:], n]):
        end[a] = b
    lower = [-1] * n
    top = n
    while top:
        g = group[sa[top - 1]]
        members = sa[g:top]
        if len(members) > 1:
            members.sort()
        met: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] > g:
                j = lower[j]
            if j >= 0 and group[j] == g:
                j = lower[j]
            lower[i] = j
            if j >= 0:
                met[j] = met.get(j, 0) + 1
        top = g
        if not met:
            continue
        by_copies: dict[int, list[int]] = {}
        for j, copies in met.items():
            by_copies.setdefault(copies, []).append(j)
        for copies in sorted(by_copies, reverse=True):
            split: dict[int, list[int]] = {}
            for j in by_copies[copies]:
                split.setdefault(group[j], []).append(j)
            for old, moved in split.items():
                last = end[old]
                new = last - len(moved)
                if new == old:
                    continue
                at = last
                for j in moved:
                    at -= 1
                    other, k = sa[at], place[j]
                    sa[at], sa[k] = j, other
                    place[j], place[other] = at, k
                    group[j] = new
                end[old], end[new] = new, last
    out, free, placed = [0] * n, list(range(n)), bytearray(n)
    out[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            k = free[g]
            out[k] = j
            free[g] = k + 1
            placed[j] = 1
            j = lower[j]
    return out


def _gram(length: int) -> int:
    return max(1, min(GRAM, length // 4))


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Mixed 64-bit hash of the bytes from each place on; the last size - 1 places have none."""
    n = len(data)
    if n not in _powers:
        _powers.clear()
        up, down = np.full(n + 1, _base, np.uint64), np.full(n + 1, _back, np.uint64)
        up[0] = down[0] = 1
        _powers[n] = np.cumprod(up), np.cumprod(down)
    up, down = _powers[n]
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * down[:n])])
    held = (sums[size:] - sums[:-size]) * up[:n + 1 - size]
    held ^= held >> np.uint64(32)
    held *= np.uint64(0xD6E8FEB86659FD93)
    held ^= held >> np.uint64(29)
    held *= np.uint64(0xA24BAED4963EE407)
    return held ^ (held >> np.uint64(32))


def anchors(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of all texts data[at[i]:at[i + 1]]: text, first start, number of starts, place, key (int64)."""
    gram = _gram(length)
    window, n = length - gram + 1, len(data)
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if n < length:
        return none
    if n >= 1 << 32:
        raise ValueError("a text of over 4 GB")
    # powers of the hash depend on the place, so their tables are kept for a few sizes only
    padded = np.zeros(1 << (n - 1).bit_length(), np.uint8)
    padded[:n] = data
    hashes = _gram_hashes(padded, gram)[:n - gram + 1]
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    rows = -(-len(ranked) // window)
    blocks = np.full(rows * window, ~np.uint64(0))
    blocks[:len(ranked)] = ranked
    blocks = blocks.reshape(rows, window)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    lowest = np.minimum(behind[:n - length + 1], ahead[window - 1:window - 1 + n - length + 1])
    place = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    counts = np.maximum(0, np.diff(at) - length + 1)
    starts = ranges(at[:-1], counts)
    place = place[starts]
    text = np.repeat(np.arange(len(counts)), counts)
    first = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    return text[first], starts[first], np.diff(np.append(first, len(starts))), place[first], hashes[place[first]].view(np.int64)


def _blocks(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, left: np.ndarray, block: int) -> tuple[np.ndarray, ...]:
    """Symbols of all contexts, a 1 behind each and a 0 at the end; of each symbol its context and place in ``data``."""
    start = begins + left % block
    counts = -(-(ends - start) // block)
    of = np.repeat(np.arange(len(begins)), counts)
    place = ranges(np.zeros(len(begins), np.int64), counts) * block + start[of]
    padded = np.concatenate([data, np.zeros(block, np.uint8)])
    held = np.zeros((len(place), -(-block // 8) * 8), np.uint8)
    held[:, :block] = np.lib.stride_tricks.sliding_window_view(padded, block)[place]
    held[:, :block][np.arange(block) >= (ends[of] - place)[:, None]] = 0
    keys = held.view(">u8").astype(np.uint64)
    order = np.lexsort(keys.T[::-1])
    new = np.concatenate([[True], (keys[order[1:]] != keys[order[:-1]]).any(axis=1)])
    symbol = np.empty(len(place), np.int64)
    symbol[order] = np.cumsum(new) + 1
    text = np.ones(len(place) + len(begins) + 1, np.int64)
    text[np.arange(len(place)) + of] = symbol
    text[-1] = 0
    return text, of, place


def repeated_starts(data: np.ndarray, begins: np.ndarray, left: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Places in ``data`` where a string starts that also starts elsewhere.

    A context begins at ``begins``, has its anchor ``left`` bytes on, and as
    many possible ``starts``.
    """
    block = max(1, min(BLOCK, length // 8))
    ends = begins + starts + length - 1
    text, of, place = _blocks(data, begins, ends, left, block)
    order = np.array(grouping_suffix_array(text.tolist()), np.int64)
    # back from places in the text to borders of blocks, up to the anchor of each context
    border = np.full(len(text), -1, np.int64)
    border[np.arange(len(place)) + of] = np.where(place <= begins[of] + left[of], np.arange(len(place)), -1)
    order = border[order]
    order = order[order >= 0]
    of, place = of[order], place[order]
    if len(order) < 2:
        return np.zeros(0, np.int64)
    # bytes that neighbours share, up to the end of their contexts
    shared = np.zeros(len(order), np.int64)
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(length, np.uint8)]), length)
    for begin in range(1, len(order), 4096):
        some = np.arange(begin, min(len(order), begin + 4096))
        differ = view[place[some - 1]] != view[place[some]]
        agree = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
        shared[some] = np.minimum(agree, np.minimum(ends[of[some - 1]] - place[some - 1], ends[of[some]] - place[some]))
    found, front = [], np.zeros(len(order), np.int64)
    for back in range(block):
        start = place - back
        live = start >= begins[of]
        if back:
            byte = data[np.maximum(start, 0)].astype(np.int64)
            front = np.unique(front * 257 + np.where(live, byte, 256), return_inverse=True)[1]
        live &= start < begins[of] + starts[of]
        some = np.flatnonzero(live)
        if not len(some):
            continue
        alike = np.cumsum(shared < length - back)[some] * (len(order) + 1) + front[some]
        _, which, count = np.unique(alike, return_inverse=True, return_counts=True)
        found.append(start[some[count[which] > 1]])
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _runs(of: np.ndarray, starts: np.ndarray, n: int) -> pa.Array:
    """Per text or context the runs of its sorted starts: first, end, first, end, ..."""
    new = np.flatnonzero((np.diff(starts, prepend=-9) != 1) | (np.diff(of, prepend=-1) != 0))
    last = np.append(new[1:], len(starts)) - 1 if len(new) else new
    flat = np.stack([starts[new], starts[last] + 1], axis=1).ravel()
    return lists(flat, np.bincount(of[new], minlength=n) * 2, pa.int64())


def _identity(text: Column) -> list[Column]:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("t1"), F.xxhash64(F.lit(1), whole).alias("t2")]


def repeated_runs(spark: SparkSession, docs: DataFrame, key: str, text: str, length: int = 400, crowd: int = CROWD) -> DataFrame:
    """(t1, t2, runs, copies) per different text: first and end of each run of repeated starts, flat, and its copies.

    Texts without repeated starts are left out.
    """
    if length < 4:
        raise ValueError("length must be 4 or more")
    scratch = Scratch(spark, "repeats")
    whole = F.coalesce(docs[text].cast("string"), F.lit(""))
    named = docs.select(*_identity(docs[text]), docs[key].alias("_key"), whole.alias("_text"))
    long = T.LongType()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 3):
            data, at = byte_view(part.column(3))
            of, _, _, _, keys = anchors(data, at, length)
            yield pa.RecordBatch.from_arrays([*part.columns[:3], lists(keys, np.bincount(of, minlength=part.num_rows), pa.int64())],
                                             names=["t1", "t2", "_key", "keys"])

    schema = T.StructType([T.StructField("t1", long), T.StructField("t2", long), named.schema["_key"], T.StructField("keys", T.ArrayType(long))])
    lengthy = named.filter(F.octet_length("_text") >= length)
    found = mapped(lengthy, find, schema)
    different = scratch.write(found.groupBy("t1", "t2").agg(
        F.count("*").alias("copies"), F.min("_key").alias("rep"), F.first("keys").alias("keys")), "different")
    keyed = different.select("t1", "t2", "rep", F.explode("keys").alias("key"))
    twice = scratch.write(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "twice")
    wanted = scratch.write(keyed.join(twice, "key").groupBy("t1", "t2", "rep").agg(F.collect_set("key").alias("keys")), "wanted")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 2):
            data, at = byte_view(part.column(2))
            of, first, starts, place, keys = anchors(data, at, length)
            asked = part.column(3)
            ask_of = np.repeat(np.arange(part.num_rows), np.asarray(asked.value_lengths().fill_null(0)))
            pairs = np.empty(len(keys), bool)
            # both sides ordered by (text, key): membership by binary search inside each text
            values = asked.flatten().to_numpy()
            by = np.lexsort((values, ask_of))
            both = np.unique(np.concatenate([values, keys]), return_inverse=True)[1]
            code = ask_of[by] * (both.max() + 1 if len(both) else 1) + both[:len(values)][by]
            mine = of * (both.max() + 1 if len(both) else 1) + both[len(values):]
            pairs = np.isin(mine, code)
            of, first, starts, place, keys = of[pairs], first[pairs], starts[pairs], place[pairs], keys[pairs]
            ends, left = first + starts + length - 1, place - first
            held = data.tobytes()
            texts = [held[a:b] for a, b in zip(first.tolist(), ends.tolist())]
            names = [xxhash.xxh3_128_digest(t, seed=int(k)) for t, k in zip(texts, left.tolist())]
            ids = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
            rows = pa.array(of)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(rows), part.column(1).take(rows), pa.array(first - at[of]), pa.array(keys),
                pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(left), pa.array(starts), pa.array(texts, pa.binary())],
                names=CONTEXT_NAMES)

    # rows that repeat text and key may both get through; their strings are repeated in truth
    one = named.select("t1", "t2", "_text", F.xxhash64("_key").alias("r"))
    asked = wanted.select("t1", "t2", "keys", F.xxhash64("rep").alias("r"))
    flagged = one.join(asked, ["t1", "t2", "r"]).select("t1", "t2", "_text", "keys")
    contexts = scratch.write(mapped(flagged, cut, CONTEXT), "contexts")
    runs = _resolve(scratch, contexts, length, crowd, [max(1, length // 25), 1])
    each = _placed(contexts, runs)
    more = different.filter("copies > 1").select("t1", "t2", "copies")
    return scratch.write(each.withColumnsRenamed({"p1": "t1", "p2": "t2"}).join(more, ["t1", "t2"], "full").select("t1", "t2", "runs", F.coalesce("copies", F.lit(1).cast("long")).alias("copies")), "found")


def _placed(contexts: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs of contexts as runs of what they were cut from."""
    moved = F.transform("runs", lambda x: x + F.col("lo"))
    spans = contexts.select("p1", "p2", "lo", "c1", "c2").join(runs, ["c1", "c2"]).select("p1", "p2", moved.alias("runs"))
    return spans.groupBy("p1", "p2").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _resolve(scratch: Scratch, contexts: DataFrame, length: int, crowd: int, steps: list[int]) -> DataFrame:
    """(c1, c2, runs): the repeated starts of each different context."""
    tag = f"-{len(steps)}"
    where = F.xxhash64("p1", "p2", "lo")
    counted = scratch.write(contexts.groupBy("key", "c1", "c2").agg(
        F.count("*").alias("n"), F.min(where).alias("rep"), F.max("starts").alias("starts")), "counted" + tag)
    # the strings of a context that occurs more than once are all repeated
    parts = [counted.filter("n > 1").select("c1", "c2", F.array(F.lit(0).cast("long"), F.col("starts")).alias("runs"))]
    widths = scratch.write(counted.groupBy("key").agg(F.count("*").alias("width")).filter("width > 1"), "widths" + tag)
    asked = scratch.write(counted.join(widths, "key").select("key", "c1", "c2", "rep", "width"), "asked" + tag)
    chosen = contexts.withColumn("rep", where).join(asked, ["key", "c1", "c2", "rep"])

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_keys(batches, 5, SORTED_BYTES):
            data, at = byte_view(part.column(5))
            starts = part.column(4).to_numpy()
            hit = repeated_starts(data, at[:-1], part.column(3).to_numpy(), starts, length)
            of = np.searchsorted(at, hit, side="right") - 1
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), _runs(of, hit - at[of], part.num_rows)],
                                             names=["c1", "c2", "runs"])

    few = chosen.filter(F.col("width") <= crowd).select("key", "c1", "c2", "left", "starts", "context")
    parts.append(mapped(few.repartition("key").sortWithinPartitions("key"), sort, "c1 long, c2 long, runs array<long>"))
    if steps and not widths.filter(F.col("width") > crowd).isEmpty():
        crowded = chosen.filter(F.col("width") > crowd).select(*CONTEXT_NAMES)
        finer = scratch.write(mapped(crowded, _finer(length, steps[0]), CONTEXT), "finer" + tag)
        found = _resolve(scratch, finer, length, crowd, steps[1:])
        parts.append(_placed(finer, found).withColumnsRenamed({"p1": "c1", "p2": "c2"}))
    runs = parts[0]
    for part in parts[1:]:
        runs = runs.unionByName(part)
    return scratch.write(runs.filter(F.size("runs") > 0), "runs" + tag)


def _finer(length: int, step: int):
    """Cuts contexts into contexts of up to ``step`` starts, counted back from the anchor.

    All strings that start in such a range share the bytes in between: their
    hash takes the place of the anchor's key.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 8):
            rows: list[int] = []
            numbers: list[tuple[int, int, int]] = []
            keys, names, texts = [], [], []
            for i, (key, left, starts, held) in enumerate(zip(*(part.column(k).to_pylist() for k in (3, 6, 7, 8)))):
                # starts left - q for q in (r * step, (r + 1) * step)
                for r in range((left - starts + 1) // step, left // step + 1):
                    core = left - r * step
                    first, last = max(0, core - step + 1), min(starts - 1, core)
                    text = held[first:last + length]
                    rows.append(i)
                    numbers.append((first, core - first, last - first + 1))
                    keys.append(xxhash.xxh3_64_intdigest(held[core:core - step + 1 + length], seed=(key ^ r) & (2**64 - 1)))
                    names.append(xxhash.xxh3_128_digest(text, seed=core - first))
                    texts.append(text)
            if not rows:
                continue
            ids, held = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2), np.array(numbers, np.int64)
            of = pa.array(rows)
            yield pa.RecordBatch.from_arrays([
                part.column(4).take(of), part.column(5).take(of), pa.array(held[:, 0]), pa.array(np.array(keys, np.uint64).view(np.int64)),
                pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(held[:, 1]), pa.array(held[:, 2]), pa.array(texts, pa.binary())],
                names=CONTEXT_NAMES)

    return run


def _whole_keys(batches: Iterable[pa.RecordBatch], sized: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by their first column in parts of about ``limit`` bytes of column ``sized`` that cut no key."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in slices(batches, sized, max(1, limit // 4)):
        held.append(batch)
        size += batch.column(sized).nbytes
        if size < limit:
            continue
        keys = batch.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], side="left"))
        if cut:
            yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            held = [batch.slice(cut)]
            size = held[0].column(sized).nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _keep(data: np.ndarray, runs: list[int] | None, whole: bool, length: int) -> tuple[bytes, int, int]:
    """Bytes that stay, how many go, and in how many runs."""
    n = len(data)
    if whole and n >= length:
        return b"", n, 1
    if not runs:
        return data.tobytes(), 0, 0
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, runs[::2], 1)
    np.add.at(marks, np.array(runs[1::2]) + length - 1, -1)
    gone = np.cumsum(marks[:n]) > 0
    return data[~gone].tobytes(), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())


def without_repeats(spark: SparkSession, docs: DataFrame, carry: list[str], key: str = "doc_id", text: str = "text", length: int = 400,
                    names: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept"), characters: bool = False,
                    crowd: int = CROWD) -> DataFrame:
    """``carry`` columns of every row, and under ``names`` the bytes of its text, those removed, in how many runs, and the rest.

    The rest is binary; with ``characters`` it is text, without the bytes of characters that a cut has parted.
    """
    found = repeated_runs(spark, docs, key, text, length, crowd)
    inner = fresh([*docs.columns, *names], "t1", "t2", "text", "runs", "copies")
    t1, t2 = _identity(docs[text])
    rows = docs.select(*columns(carry), t1.alias(inner[0]), t2.alias(inner[1]), docs[text].cast("string").alias(inner[2]))
    found = found.select(F.col("t1").alias(inner[0]), F.col("t2").alias(inner[1]), F.col("runs").alias(inner[3]), F.col("copies").alias(inner[4]))
    joined = rows.join(found, inner[:2], "left").select(*columns(carry), *inner[2:])
    n = len(carry)
    schema = T.StructType([*docs.select(*columns(carry)).schema.fields, *[T.StructField(x, T.LongType()) for x in names[:3]],
                           T.StructField(names[3], T.StringType() if characters else T.BinaryType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, n):
            data, at = byte_view(part.column(n))
            out = [_keep(data[a:b], r, (c or 1) > 1, length) for a, b, r, c in
                   zip(at[:-1], at[1:], part.column(n + 1).to_pylist(), part.column(n + 2).to_pylist())]
            kept, removed, spans = zip(*out)
            rest = pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if characters else pa.array(kept, pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array(np.diff(at)), pa.array(removed, pa.int64()),
                                              pa.array(spans, pa.int64()), rest], names=[*carry, *names])

    return mapped(joined, run, schema)
