import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import blocks, graph, joins, metrics, profile, rows


def test_first_per_key_is_sure_and_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (1, 3, "b"), (None, 1, "z"), (2, None, "n"), (2, 0, "m")], "k int, o int, v string")
    got = rows.first_per_key(df, ["k"], ["o", "v"])
    assert got.columns == ["k", "o", "v"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, [(1, 3, "a"), (None, 1, "z"), (2, None, "n")]))


def test_first_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = rows.first_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial") and plan.count("WindowGroupLimit") == 2


def test_first_per_key_reads_only_what_is_asked_for(spark, tmp_path):
    spark.range(9).select("id", (F.col("id") % 2).alias("k"), F.lit("x").alias("unused")).write.parquet(str(tmp_path / "t"))
    got = rows.first_per_key(spark.read.parquet(str(tmp_path / "t")), ["k"], ["id"]).select("k", "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan and sorted(map(tuple, got.collect())) == [(0, 0), (1, 1)]


def test_split_digits_follow_the_rows(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("key"))
    want = sorted(map(tuple, rows.exact_split(df, "key", 1, [("a", 0.7), ("b", 0.3)]).collect()))
    monkeypatch.setattr(rows, "PREFIX_ROWS", 0.001)  # 6 digits
    assert sorted(map(tuple, rows.exact_split(df, "key", 1, [("a", 0.7), ("b", 0.3)]).collect())) == want


@settings(max_examples=6, deadline=None)
@given(st.integers(1, 400), st.integers(0, 5))
def test_split_sizes(spark, n, seed):
    df = spark.range(n).select((F.col("id") * 7).alias("key"))
    got = rows.exact_split(df, "key", seed, [("train", 0.6), ("val", 0.2), ("test", 0.2)]).collect()
    sizes = {p: sum(r.split == p for r in got) for p in ("train", "val", "test")}
    assert sizes["val"] == sizes["test"] == int(n * 0.2)
    assert len(got) == len({r.key for r in got}) == n


def test_split_is_the_order_of_the_hashes(spark):
    import hashlib

    df = spark.range(1000).select(F.col("id").alias("key"))
    order = sorted(range(1000), key=lambda k: hashlib.md5(f"9|{k}".encode()).hexdigest())
    got = {r.key: r.split for r in rows.exact_split(df, "key", 9, [("a", 0.8), ("b", 0.2)]).collect()}
    assert [got[k] for k in order] == ["a"] * 800 + ["b"] * 200


def test_split_of_many_seeds(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("key"))
    many = rows.exact_split(df, "key", [1, 2], [("a", 0.7), ("b", 0.3)])
    for seed in (1, 2):
        alone = rows.exact_split(df, "key", seed, [("a", 0.7), ("b", 0.3)])
        assert sorted(map(tuple, many.filter(F.col("seed") == seed).select("key", "split").collect())) == sorted(map(tuple, alone.collect()))


def test_fills_and_flags(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (3, 4.0)], "id int, v double")
    assert [r.v for r in rows.fill_mean(df, "v").orderBy("id").collect()] == [2.0, 3.0, 4.0]
    assert [r.f for r in rows.at_least_mean(df, "v", "f").orderBy("id").collect()] == [0, 0, 1]
    assert rows.keep_positive(spark.createDataFrame([(1, 0), (2, 3), (None, 1)], "a int, b int"), "a", "b").count() == 1
    assert rows.sentinel_to_null(spark.createDataFrame([("\\N", "Null")], "a string, b string")).first() == (None, "Null")


def test_tag_union_and_repeat(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, 3)], "x int, y int")
    got = rows.tag_union({"A": a, "B": b}, "tag").orderBy("x").collect()
    assert [(r.x, r.y, r.tag) for r in got] == [(1, None, "A"), (2, 3, "B")]
    assert rows.repeat_rows(a, 1000).count() == 1000


def test_limited(spark):
    assert rows.limited(spark.range(50), True, 5).count() == 5
    assert rows.limited(spark.range(50), False, 5).count() == 50


def test_role_join_and_orphans(spark):
    fact = spark.createDataFrame([(1, 10, 20), (2, 10, 99)], "id int, p int, d int")
    dim = spark.createDataFrame([(10, "X"), (20, "Y")], "k int, name string")
    got = joins.role_join(fact, dim, "k", {"p": ("p_", {"name": "p_name"}), "d": ("d_", {"name": "d_name"})}).collect()
    assert [tuple(r) for r in got] == [(1, 10, 20, "X", "Y")]
    child = spark.createDataFrame([(99,), (99,), (10,), (None,)], "k int")
    assert [tuple(r) for r in joins.orphans(child, "k", dim, "k").collect()] == [(99, 2)]


def test_left_join_many(spark):
    few = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, name string")
    many = spark.createDataFrame([(1, 10), (1, 11), (3, None), (9, 5), (None, 6)], "k int, v int")
    want = few.join(many, "k", "left")
    got = joins.left_join_many(few, many, "k")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_graph_example(spark):
    points = spark.range(1, 7).select(F.col("id").cast("int").alias("v"))
    pairs = [(i, j) for i in range(1, 7) for j in range(i + 1, 7)]
    edges = spark.createDataFrame(pairs, "a int, b int")
    blockers = spark.createDataFrame([(4, 2)], "a int, b int")
    allowed = {tuple(r) for r in graph.allowed_edges(edges, blockers, "a", "b").collect()}
    assert len(allowed) == 14 and (2, 4) not in allowed
    counts = {r.vertex: r.partners for r in graph.allowed_partner_counts(points, "v", blockers, "a", "b").collect()}
    assert counts == {1: 5, 2: 4, 3: 5, 4: 4, 5: 5, 6: 5} and sum(counts.values()) == 28
    ring = spark.createDataFrame([(1, 2), (2, 5), (5, 1)], "a int, b int")
    assert graph.all_degrees_two(graph.degrees(ring, "a", "b")).first()[0] is True
    assert graph.all_degrees_two(graph.degrees(edges, "a", "b")).first()[0] is False


def blocks_by_hand(text, size=6):
    """Same rule in plain Python, written from the description."""
    out, head, first = {}, None, {}
    for i, line in enumerate(text.split("\n")):
        line = line.strip()
        if line and i % size == 0:
            head = line
            out.setdefault(head, [])
            first.setdefault(head, i // size)
        elif line and i % size == 1 and head is not None:
            out[head].append(line)
    return {h: (first[h], ", ".join(v)) for h, v in out.items()}


SAMPLE = "\n".join(
    line for n, (feature, item) in enumerate([("F1", "J1"), ("F1", "J2"), ("F2", "J3")], 1)
    for line in (feature, item, "", f"T{n}\tN{n}", "Assigned", f"D{n}")
)


def test_blocks_sample(spark):
    df = spark.createDataFrame([(1, SAMPLE)], "id int, text string")
    got = {r["head"]: r["items"] for r in blocks.block_lists(df, ["id"], "text").collect()}
    assert got == {"F1": "J1, J2", "F2": "J3"}


def test_blocks_know_all_line_ends(spark):
    df = spark.createDataFrame([(1, SAMPLE.replace("\n", "\r\n")), (2, SAMPLE.replace("\n", "\r"))], "id int, text string")
    got = {(r["id"], r["head"]): r["items"] for r in blocks.block_lists(df, ["id"], "text").collect()}
    assert got == {(i, h): v for i in (1, 2) for h, v in (("F1", "J1, J2"), ("F2", "J3"))}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", " c ", "", "\t"]), max_size=40), min_size=1, max_size=5))
def test_blocks_by_brute_force(spark, texts):
    texts = ["\n".join(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in blocks.block_lists(df, ["id"], "text").collect():
        got.setdefault(r["id"], {})[r["head"]] = (r["first_block"], r["items"])
    assert got == {i: blocks_by_hand(t) for i, t in enumerate(texts) if blocks_by_hand(t)}


def scores(spark, n=300):
    rng = random.Random(3)
    data = [(rng.randint(0, 20) / 20, rng.randint(0, 1)) for _ in range(n)]
    return data, spark.createDataFrame(data + [(None, 1)], "s double, y int")


@pytest.mark.parametrize("strict", [False, True])
def test_threshold_counts(spark, strict):
    data, df = scores(spark)
    got = {r.t: (r.tp, r.fp, r.fn, r.tn) for r in metrics.threshold_counts(df, "s", "y", 20, strict).collect()}
    for t in range(21):
        hit = lambda s: s > t / 20 if strict else s >= t / 20
        want = tuple(sum(1 for s, y in data if hit(s) == p and y == (c)) for p, c in ((True, 1), (True, 0), (False, 1), (False, 0)))
        assert got[t] == want


def test_auc(spark):
    data, df = scores(spark)
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = metrics.auc(df.filter("s is not null"), "s", "y", F.floor(F.col("s") * 4)).first()
    assert abs(got.auc - want) < 1e-12


def test_mutual_information(spark):
    import math

    data = [("a", 1), ("a", 1), ("a", 0), ("b", 0), ("b", 0), (None, 1), (None, 0)]
    df = spark.createDataFrame(data, "f string, y int").withColumn("same", F.col("y").cast("string"))
    n, want = len(data), 0.0
    for pair in set(data):
        p = data.count(pair) / n
        px, py = sum(d[0] == pair[0] for d in data) / n, sum(d[1] == pair[1] for d in data) / n
        want += p * math.log(p / (px * py))
    got = {r.feature: r.mi for r in profile.mutual_information(df, ["f", "same"], "y").collect()}
    assert abs(got["f"] - want) < 1e-12
    h = -sum(c / n * math.log(c / n) for c in (3, 4))
    assert abs(got["same"] - h) < 1e-12


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "a", 3.0), (2, None, 3.0)], "i int, s string, d double")
    assert {r.column: r.n_null for r in profile.null_profile(df).collect()} == {"i": 0, "s": 1, "d": 1}
    assert {r.column: (r.n_distinct, r.kind) for r in profile.type_profile(df).collect()} == {
        "i": (2, "number"), "s": (1, "text"), "d": (1, "number")}
    assert [tuple(r) for r in profile.value_counts(df, "s").collect()] == [("a", 2), (None, 1)]
    risk = {r.value: r.risk for r in profile.group_risk(df, ["s"], "i").collect()}
    assert abs(risk["a"] - 1.5 / (5 / 3)) < 1e-12
