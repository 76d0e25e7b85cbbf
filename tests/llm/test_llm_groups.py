"""Near copies, repeats, vectors, components and the pipeline against brute force."""

import collections
import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from millrace.llm import components, repeats, scratch, simhash, vectors
from millrace.llm.batches import byte_view
from millrace.llm.queries import ORACLES, QUERIES
from tools.check import compare, oracle

SMALL = "/root/testdata/sf0.001"
ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..")


def roots(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    state, n, detail = compare(QUERIES[name](spark, SMALL), oracle(SMALL), ORACLES[name])
    assert state == "ok" and n > 0, detail


def test_components(spark):
    rng = random.Random(2)
    path = [(i, i + 1) for i in range(60)]
    pairs = path + [(rng.randrange(100, 200), rng.randrange(100, 200)) for _ in range(60)] + [(300, 301 + i) for i in range(40)] + [(7, 7), (None, 3)]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["component"] for r in components.components(spark, df).collect()}
    want = roots(400, [p for p in pairs if None not in p])
    assert got == {i: want[i] for p in pairs if None not in p and p[0] != p[1] for i in p}
    assert components.components(spark, df.limit(0)).count() == 0
    rows = np.arange(400)
    a, b = zip(*[p for p in pairs if None not in p])
    components.unite(rows, np.array(a), np.array(b))
    components.unite(rows, np.arange(400), rows.copy())
    assert rows.tolist() == want


def brute_print(text, shingle):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    s = [b" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows, radius, shingle=4):
    prints = [brute_print(t, shingle) for _, t in rows]
    root = roots(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= radius])
    low = collections.defaultdict(list)
    for (k, _), r in zip(rows, root):
        low[r] += [] if k is None else [k]
    return prints, [min(low[r], default=None) for r in root]


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7, 12])
def test_forest(radius):
    rng = np.random.default_rng(radius)
    prints = []
    for base in rng.integers(0, 2**63, 30):
        for _ in range(rng.integers(1, 9)):
            x = int(base)
            for k in rng.choice(64, rng.integers(0, radius + 3), replace=False):
                x ^= 1 << int(k)
            prints.append(x)
    prints = np.unique(np.array(prints, np.uint64))
    rng.shuffle(prints)
    group = np.sort(rng.integers(0, 5, len(prints)))
    a, b = simhash.forest(group, prints, radius)
    where = {int(p): i for i, p in enumerate(prints)}
    got = roots(len(prints), [(where[int(x)], where[int(y)]) for x, y in zip(a, b)])
    want = roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if group[i] == group[j] and bin(int(prints[i] ^ prints[j])).count("1") <= radius])
    assert got == want and len(a) < len(prints)


@pytest.mark.parametrize("chunk", [2, 2048])
def test_links_in_chunks(spark, chunk):
    rng = np.random.default_rng(5)
    base = int(rng.integers(0, 2**62))
    prints = sorted({base ^ (1 << int(k)) ^ (1 << int(j)) for k in range(12) for j in rng.integers(0, 62, 3)} | set(rng.integers(0, 2**62, 50).tolist()))
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = simhash.links(spark, df, 4, chunk).collect()
    where = {p: i for i, p in enumerate(prints)}
    pairs = [(i, j) for i in range(len(prints)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 4]
    assert roots(len(prints), [(where[r["a"]], where[r["b"]]) for r in found]) == roots(len(prints), pairs)


def test_simhash_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    prints, component = brute_groups(rows, 4)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op6_simhash"](spark, SMALL).collect()}
    assert got == {k: (f"{p:016x}", c) for (k, _), p, c in zip(rows, prints, component)}
    assert len(set(component)) < len(component)


def test_simhash_edges(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text, "a"), (3, text.upper(), "b"), (3, text.upper(), "b"), (9, None, None), (4, "", "c"), (None, " \t\n", "d"), (8, "other words", "e"),
            (8, "quite another text than the one before it", "f"), (None, "lonely words without an id stay too", "g"), (11, "x " * 50000, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumnRenamed("fp", "digest")
    got = simhash.grouped(spark, df).select("doc_id", "component_id").collect()
    _, component = brute_groups([(k, t) for k, t, _ in rows], 4)
    assert sorted(map(repr, map(tuple, got))) == sorted(repr((k, c)) for (k, _, _), c in zip(rows, component))
    kept = simhash.first_of_groups(spark, df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["11", "3", "4", "8", "8", "None"]
    assert simhash.first_of_groups(spark, df.limit(0)).count() == 0


def test_suffix_array_by_grouping():
    rng = random.Random(5)
    for _ in range(1500):
        text = [rng.randrange(1, rng.randrange(2, 6)) for _ in range(rng.randrange(0, 40))] + [0]
        assert repeats.grouping_suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])
    assert repeats.grouping_suffix_array([1] * 5000 + [0]) == list(range(5000, -1, -1))


def brute_starts(texts, length):
    found = collections.defaultdict(list)
    for i, t in enumerate(texts):
        for x in range(len(t) - length + 1):
            found[t[x:x + length]].append((i, x))
    return {p for v in found.values() if len(v) > 1 for p in v}


def brute_rest(texts, length):
    out, starts = [], brute_starts(texts, length)
    for i, t in enumerate(texts):
        gone = [any((i, x) in starts for x in range(max(0, p - length + 1), p + 1)) for p in range(len(t))]
        out.append((len(t), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), bytes(b for b, g in zip(t, gone) if not g)))
    return out


def shared_texts(rng, length, n):
    base = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(length // 2, length * 3))) for _ in range(3)]
    fresh = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(0, length)))
    return ["".join(rng.choice([rng.choice(base)[rng.randrange(0, length):], fresh()]) for _ in range(rng.randrange(0, 5))) for _ in range(n)]


@pytest.mark.parametrize("length", [8, 20, 60, 400])
def test_repeated_starts(length):
    rng = random.Random(length)
    for _ in range(25):
        texts = sorted({t.encode() for t in shared_texts(rng, length, rng.randrange(1, 8))})
        data, at = byte_view(pa.array(texts))
        _, first, starts, place, _ = repeats.anchors(data, at, length)
        if not len(first):
            continue
        ends = first + starts + length - 1
        held = b"".join(data[a:b].tobytes() for a, b in zip(first, ends))
        begins = np.concatenate([[0], np.cumsum(ends - first)])
        hit = repeats.repeated_starts(np.frombuffer(held, np.uint8), begins[:-1], place - first, starts, length)
        of = np.searchsorted(begins, hit, side="right") - 1
        assert set((first[of] + hit - begins[of]).tolist()) == {int(at[i]) + x for i, x in brute_starts(texts, length)}


@pytest.mark.parametrize("length,crowd", [(8, 512), (20, 1), (60, 2), (100, 512)])
def test_without_repeats(spark, length, crowd):
    rng = random.Random(crowd)
    texts = shared_texts(rng, length, 25) + [None, "", "ab" * length, "a" * (3 * length)]
    texts += [texts[0], texts[1]] + [texts[2] + "x" * 5] + ["q" * k + texts[3] + texts[0] for k in range(6)]
    rows = [(rng.choice([i, i, 1, None]), t, i, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, runs string").withColumnRenamed("runs", "t1")
    got = {r["n"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in
           repeats.without_repeats(spark, df, ["n", "t1"], length=length, crowd=crowd).collect()}
    want = brute_rest([(t or "").encode() for t in texts], length)
    assert [got[i] for i in range(len(texts))] == want and any(w[1] for w in want)


def test_repeats_edges(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in repeats.without_repeats(spark, df, ["doc_id"], length=10).select("doc_id", "n_bytes", "n_removed", "n_spans").collect()} == {(1, 0, 0, 0), (2, 0, 0, 0)}
    assert repeats.without_repeats(spark, df.limit(0), ["doc_id"]).count() == 0
    cut = spark.createDataFrame([(1, "xyzé" + "a" * 20), (2, "Ã" + "b" * 20 + "©" + "a" * 20)], "doc_id long, text string")
    rest = {r["doc_id"]: r["kept"] for r in repeats.without_repeats(spark, cut, ["doc_id"], length=20, characters=True).collect()}
    assert rest == {1: "xyz", 2: "Ã" + "b" * 20}  # the strings share the last byte of é and ©


def test_repeats_query(spark):
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    count = collections.Counter(xxhash.xxh3_64_intdigest(b[i:i + 400]) for b in texts.values() for i in range(len(b) - 399))
    rows = QUERIES["op8_repeats"](spark, SMALL).collect()
    assert len(rows) == len(texts) and sum(r["n_removed"] for r in rows) > 0
    for r in rows:
        b = texts[r["doc_id"]]
        marks = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 399):
            if count[xxhash.xxh3_64_intdigest(b[i:i + 400])] > 1:
                marks[i] += 1
                marks[i + 400] -= 1
        gone = np.cumsum(marks[:-1]) > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        assert tuple(r) == (r["doc_id"], len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())


def brute_vectors(rows, least):
    fine = [k is not None and v and l is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for k, v, l in rows]
    pairs = []
    for i in range(len(rows)):
        for j in range(i):
            if fine[i] and fine[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                    pairs.append((i, j))
    degree, low = collections.Counter(i for p in pairs for i in p), {}
    root = roots(len(rows), pairs)
    for i, r in enumerate(root):
        if fine[i]:
            low[r] = min(low.get(r, 1 << 60), rows[i][0])
    return [(rows[i][0], degree[i], low[root[i]] if fine[i] else rows[i][0]) for i in range(len(rows))]


@pytest.mark.parametrize("chunk", [5, 4096])
def test_vectors(spark, chunk):
    rng = np.random.default_rng(chunk)
    rows, base = [], rng.standard_normal((8, 6))
    for i in range(140):
        v = base[rng.integers(8)] + rng.choice([0, 0.02, 0.3]) * rng.standard_normal(6)
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 2])], int(rng.integers(3))))
    rows += [(200, None, 1), (201, [0.0] * 6, 1), (202, [float("nan")] * 6, 1), (203, [None, 1.0], 1), (204, [float("inf"), 1.0], 1), (205, [], 1),
             (206, rows[0][1], None), (None, rows[0][1], rows[0][2]), (207, [1.0, 2.0], 1), (208, [2.0, 4.0], 1), (209, [1e300, 2e300], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, node string")
    got = vectors.near_copies(spark, df, "vec_id", "embedding", "label", 0.98, chunk=chunk).collect()
    want = brute_vectors([r for r in rows if r[0] != 209], 0.98)
    mine = [(r["vec_id"], r["n_links"], r["component_id"]) for r in got if r["vec_id"] not in (207, 208, 209)]
    assert sorted(mine, key=repr) == sorted([w for w in want if w[0] not in (207, 208)], key=repr)
    assert [(r["n_links"], r["component_id"]) for r in got if r["vec_id"] in (207, 208, 209)] == [(2, 207)] * 3
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got if r["vec_id"] is not None)
    assert vectors.near_copies(spark, df.limit(0), "vec_id", "embedding", "label").count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_cover_trees(seed):
    rng = np.random.default_rng(seed)
    n, d = int(rng.integers(2, 120)), int(rng.integers(1, 8))
    base = rng.standard_normal((max(1, n // 4), d))
    rows = base[rng.integers(0, len(base), n)] + rng.choice([0, 0.01, 0.1, 0.5]) * rng.standard_normal((n, d))
    side, least, copies = np.sort(rng.integers(0, 2, n)) * (seed % 2), float(rng.choice([0.98, 0.9, 0.5])), rng.integers(1, 4, n)
    side[0] = 0
    degree, parent = vectors.linked(rows, copies, side, least)
    norm = np.linalg.norm(rows, axis=1)
    near = (rows @ rows.T) / np.outer(norm, norm) >= least
    near &= (side[:, None] != side[None, :]) if side.any() else ~np.eye(n, dtype=bool)
    assert (degree == (near * copies).sum(axis=1)).all()
    assert parent.tolist() == roots(n, list(zip(*np.nonzero(near))))


def test_cover_tree_covers():
    points = vectors.unit(np.random.default_rng(1).standard_normal((300, 5)))
    tree = vectors.CoverTree(points)

    def below(node):
        kids = tree.children[node]
        return [tree.centre[node]] if kids is None else [p for k in kids for p in below(k)]
    assert sorted(below(0)) == list(range(300))
    for node in range(len(tree.centre)):
        far = np.linalg.norm(points[below(node)] - points[tree.centre[node]], axis=1)
        assert far.max() <= tree.cover[node] + 1e-9
        if tree.children[node] is not None:
            assert all(tree.cover[k] <= tree.cover[node] + 1e-9 for k in tree.children[node])


def test_vector_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = [(r["vec_id"], r["n_links"], r["component_id"]) for r in QUERIES["op10_vectors"](spark, SMALL).collect()]
    assert sorted(got) == sorted(brute_vectors(rows, 0.98))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, names = docs.columns, [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    held = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        held.append(docs)
        assert n == 4 or docs.columns == columns
    texts = [{r["doc_id"]: r["text"] for r in d.collect()} for d in held[:4]]
    # one of each near group stays: the smallest id
    _, component = brute_groups(list(texts[0].items()), 4)
    assert texts[1] == {k: texts[0][k] for k in component}
    rest = brute_rest_fast([t.encode() for t in texts[1].values()], corpus_pipeline.REPEATED_BYTES)
    assert texts[2] == {k: b.decode(errors="ignore") for k, b in zip(texts[1], rest)}
    assert texts[3].items() <= texts[2].items() and len(texts[3]) < len(texts[2])
    assert all(r["n_chars"] == len(r["text"]) for r in held[2].collect())
    final = {r["doc_id"]: r["decoded_sha256"] for r in held[4].collect()}
    assert final == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts[3].items()}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, held[4].collect()))


def brute_rest_fast(texts, length):
    count = collections.Counter(xxhash.xxh3_64_intdigest(b[i:i + length]) for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        marks = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[xxhash.xxh3_64_intdigest(b[i:i + length])] > 1:
                marks[i] += 1
                marks[i + length] -= 1
        out.append(np.frombuffer(b, np.uint8)[np.cumsum(marks[:-1]) == 0].tobytes())
    return out


def test_pipeline_edges(spark):
    """Nulls, empty and repeated rows and columns of other names go through every stage."""
    rows = [(1, None, None, None, None, 1), (2, "", "en", "a", 0, 2), (None, "the and of to in a that is was", "en", "a", 30, 3), (3, "the and of to " * 300, "en", "a", 4200, 4),
            (3, "the and of to " * 300, "en", "a", 4200, 4), (4, "der die das und in zu den mit sich", "de", None, None, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `a.b` int").withColumns(
        {c: __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x") for c in ("fp", "digest", "n_words", "kept", "score", "t1", "_text")})
    for frame in (df, df.limit(0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:4]:
            out = stage(spark, docs, SMALL)
            assert out.columns == df.columns
            assert out.count() <= docs.count()
            docs = out
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, df, SMALL).collect()


def test_scratch_is_released(spark):
    held = scratch.Scratch(spark, "own")
    held.write(spark.range(3), "a")
    path = held.base.removeprefix("file:")
    assert os.path.isdir(path)
    scratch.release(spark)
    assert not os.path.isdir(path)


def test_entry_without_this_subpackage():
    """The other queries stand without it, and other import errors are not swallowed."""
    block = ("import sys\nclass No:\n    def find_spec(self, name, path=None, target=None):\n"
             "        if name in {hidden!r}: raise ModuleNotFoundError(name, name=name)\n"
             "sys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nprint(len(e.queries()), 'pipeline' in e.queries())")
    run = lambda hidden: subprocess.run([sys.executable, "-c", block.format(hidden=hidden)], cwd=ROOT, capture_output=True, text=True)
    assert run(("millrace.llm", "corpus_pipeline")).stdout.split()[1] == "False"
    assert run(("xxhash",)).returncode
    assert run(()).stdout.split()[1] == "True"
