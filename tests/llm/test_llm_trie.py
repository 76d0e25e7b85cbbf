"""The prefix trie of conversations against brute force."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import trie
from millrace.llm.queries import ORACLES, QUERIES
from tools.check import compare, oracle

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, pos string, size int, `a.b` int"


def brute(rows):
    convs = collections.defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rest = abs(c) % 100
        built[c] = own.get(c - (rest if c >= 0 else -rest), [])[:h] + own[c][h:]
    nodes = collections.defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = lambda q: sum(len(p) == len(q) + 1 and p[:len(q)] == q for p in nodes)
        ends = ",".join(str(c) for c in members if len(built[c]) == len(path))
        out.append((members[0], len(path), nodes[path[:-1]][0] if path else None, len(members), kids(path), sum(kids(p) == 0 for p in below),
                    sum((len(nodes[p]) - 1) * (len(p[-1][1]) if p else 0) for p in below), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def built(spark, df, **sizes):
    turns = trie.numbered(df, "conv_id", "turn", "role", "text")
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % 6
    rows = trie.trie(spark, trie.spliced(turns, F.col("conv") - F.col("conv") % 100, taken, 5), **sizes)
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in rows.select(names).collect()), key=repr)


def made(seed, convs=40, long=0):
    rng = random.Random(seed)
    rows = []
    ids = rng.sample(range(-120, 420), convs)
    for c in ids:
        for _ in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([None, *range(7)]), rng.choice(["u", "a", None, ""]), rng.choice(["x", "yé", "", None, "😀😀"]), "p", 1, 2))
    rows += [(ids[0], n, "u", rng.choice("xy"), None, None, None) for n in range(long)]
    rows += rows[:5] + [(None, 1, "u", "x", None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"shard": 3, "stretch": 2}), (3, {"shard": 1, "stretch": 4})])
def test_nodes_against_brute_force(spark, seed, sizes):
    rows = made(seed, long=40 if sizes else 0)
    assert built(spark, spark.createDataFrame(rows, SCHEMA), **sizes) == brute(rows)


def test_one_first_turn_and_copies(spark):
    rows = [(c, t, "u", "same" if t == 0 or c % 3 else f"own {c}", None, None, None) for c in range(300, 400) for t in range(3)]
    assert built(spark, spark.createDataFrame(rows, SCHEMA), shard=16) == brute(rows)


def test_no_conversation_has_no_node(spark):
    assert built(spark, spark.createDataFrame([], SCHEMA)) == []
    assert built(spark, spark.createDataFrame([(None, 1, "u", "x", None, None, None)], SCHEMA)) == []


def test_shards_hold_whole_conversations():
    rows = {n: np.zeros(60, np.int64) for n in trie.ROWS}
    rows["conv"] = np.repeat(np.arange(20), 3)
    rows["stretch"] = np.repeat([0, 1], 30)
    got = list(trie._shards([_record(rows, 0, 7), _record(rows, 7, 60)], 4))
    assert [sorted(set(g["conv"].tolist())) for g in got] == [[0, 1, 2, 3], [4, 5, 6, 7], [8, 9], [10, 11, 12, 13], [14, 15, 16, 17], [18, 19]]


def _record(rows, a, b):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array(rows[n][a:b]) for n in trie.ROWS], names=list(trie.ROWS))


def test_query_against_sql(spark):
    state, n, detail = compare(QUERIES["op13_conversations"](spark, SMALL), oracle(SMALL), ORACLES["op13_conversations"])
    assert state == "ok" and n > 0, detail
