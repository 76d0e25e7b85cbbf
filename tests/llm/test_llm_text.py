"""Tokens, windows, languages, licences and backoff scores against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import backoff, bpe, decontaminate, language, licences, tokencount, toxicity
from millrace.llm.queries import QUERIES, RANKS

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, ids string, score string, n_words int, `a.b` int"


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def split(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])]


def test_encode_equals_library(vocabulary, library):
    rng = random.Random(4)
    texts = ["", " ", "a" * 5000, "ab" * 3000, "the" * 900, "é" * 700, "😀" * 300, "\n" * 300 + "x", "=-" * 700,
             "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(900)), "".join(rng.choice("abcde") for _ in range(9000))]
    for _ in range(800):
        texts.append("".join(rng.choice("abcdefinorst ,.'é1") for _ in range(rng.randrange(120))))
        texts.append("".join(rng.choice("aeinst") for _ in range(rng.randrange(90))))
    flat, counts = vocabulary.encode(texts)
    assert split(flat, counts) == [library.encode_ordinary(t) for t in texts]
    held, at = vocabulary.decode(flat, counts)
    assert [held[a:b].decode() for a, b in zip(at[:-1], at[1:])] == texts


def test_forgets_without_other_results(vocabulary, library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for _ in range(3):
        flat, counts = vocabulary.encode(["some words here", "and others"])
        assert split(flat, counts) == [library.encode_ordinary("some words here"), library.encode_ordinary("and others")]


def test_bpe_query(spark, library):
    rows = QUERIES["op5_bpe"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_bpe_edges(spark):
    df = spark.createDataFrame([(1, None, "en", "x", "y", 1, 2), (1, "", None, None, None, None, None), (None, "hi", "en", "x", "y", 1, 2)], DOCS)
    rows = bpe.digest_rows(df, RANKS, public_tokenizers.PATTERN).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sorted((r["n_tokens"], r["ids_sha256"] == none) for r in rows) == [(0, True), (0, True), (1, False)]
    assert bpe.digest_rows(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    back = bpe.decode(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>"), ["k"], "ids", RANKS).collect()
    assert [bytes(r["decoded"]) for r in back] == [b"", b""]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_hits(docs, items, window):
    windows = []
    for key, text in items:
        w = words(text)
        windows += [(key, w)] if 0 < len(w) < window else [(key, w[i:i + window]) for i in range(len(w) - window + 1)]
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for key, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i:i + len(x)] == x:
                    hit.update(range(i, i + len(x)))
                    found.update([] if key is None else [key])
        out.append((len(w), len(hit), sorted(found)))
    return out


def random_case(rng):
    voc = ["a", "b", "Cé", "x1", "Dog", "cat", "é"][:rng.randrange(2, 8)]
    make = lambda n: rng.choice([" ", ". ", "\n"]).join(rng.choice(voc + ["zz"] * rng.randrange(3)) for _ in range(n))
    items = [(rng.choice([str(i), str(i), None]), rng.choice([make(rng.randrange(0, 20)), make(rng.randrange(0, 8)), None, ""])) for i in range(rng.randrange(0, 9))]
    docs = [rng.choice([make(rng.randrange(0, 60)), make(rng.randrange(5)), None, "", " ."]) for _ in range(rng.randrange(1, 8))]
    docs += [make(3) + " " + t.upper() + "! " + make(2) for _, t in items if t and rng.random() < 0.4]
    return docs, items


def test_windows_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        docs, items = random_case(rng)
        window = rng.choice([1, 2, 3, 4, 5, 13])
        b = decontaminate.Benchmark([k for k, _ in items], [t for _, t in items], window)
        symbols, starts, counts = decontaminate._spread(b, pa.array(docs, pa.string()))
        at, which = b.places(symbols)
        hit, found = [set() for _ in docs], [set() for _ in docs]
        for a, w in zip(at.tolist(), which.tolist()):
            d = int(np.searchsorted(starts, a, side="right")) - 1
            hit[d].update(range(a, a + int(b.lengths[w])))
            found[d].update(b.ids[i] for i in b.owners[b.owner_at[w]:b.owner_at[w + 1]] if b.ids[i] is not None)
        assert [(int(counts[i]), len(hit[i]), sorted(found[i])) for i in range(len(docs))] == brute_hits(docs, items, window)
        n, _ = b.longest(symbols)
        texts = [words(t) for t in docs]
        for q in range(len(n)):
            w = words(items[b.item[q]][1])[b.place[q]:]
            best = max([0] + [next((k for k in range(min(len(w), len(f) - i)) if w[k] != f[i + k]), min(len(w), len(f) - i)) for f in texts for i in range(len(f))])
            if best >= 3:
                assert n[q] == best


@pytest.mark.parametrize("block", [1, 40, 1 << 20])
def test_hits_in_blocks(spark, block):
    rng = random.Random(block)
    docs, items = random_case(rng)
    docs += ["A b cé x1 dog " * 5]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    bench = spark.createDataFrame(items or [("1", "a b")], "item_id string, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in
           decontaminate.hits(df, ["doc_id"], "text", bench, window=4, block_bytes=block).collect()}
    assert [got[i] for i in range(len(docs))] == brute_hits(docs, items or [("1", "a b")], 4)


def test_decontamination_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    grams = collections.defaultdict(set)
    for key, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12)):
            grams[tuple(w[i:i + 13])].add(key)
    rows = QUERIES["op1_decontaminate"](spark, SMALL).collect()
    assert len(rows) == len(texts) and any(r["contaminated"] for r in rows)
    for r in rows:
        w, hit, found = words(texts[r["doc_id"]]), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert tuple(r) == (r["doc_id"], len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w))


def test_clean_and_longest(spark):
    item = " ".join(f"w{i}" for i in range(20))
    df = spark.createDataFrame([(1, item, "en", "a", "b", 5, 6), (2, "clean text", "en", "a", "b", 5, 6), (None, None, None, None, None, None, None),
                                (2, "clean text", "en", "a", "b", 5, 6)], DOCS)
    bench = spark.createDataFrame([(7, item), (7, item), (8, None)], "item_id long, text string")
    kept = decontaminate.clean(df, "text", bench)
    assert kept.columns == df.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "2", "None"]
    assert decontaminate.clean(df, "text", bench.limit(0)).count() == 4
    assert decontaminate.clean(df.limit(0), "text", bench).count() == 0
    part = spark.createDataFrame([(5, "x w3 w4 w5 w6 y"), (6, "w9 w10 w11"), (4, "w9 w10 w11")], "doc_id long, text string")
    found = decontaminate.longest_matches(part, "doc_id", "text", bench).collect()
    assert [tuple(r) for r in found] == [("7", 3, 5, 1, 4)]


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op2_language"](spark, folder).collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert rows.keys() == truth.keys()
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, r in rows.items())
    tested = [k for k, r in rows.items() if r["held_out"]]
    assert np.mean([rows[k]["lang_pred"] == truth[k] for k in tested]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_language_edges(spark):
    rows = [(i, t, l, "a", "b", 1, 2) for i, (t, l) in enumerate([("the and of to " * 9, "en"), ("der die und das " * 9, "de")] * 8)]
    rows += [(100, None, "en", None, None, None, None), (101, "", None, "a", "b", 1, 2), (102, "12 34 | --", "en", "a", "b", 1, 2),
             (None, "the and of", None, "a", "b", 1, 2), (103, "the of and " * 9000, "en", "a", "b", 1, 2)]
    df = spark.createDataFrame(rows, DOCS)
    net = language.learn(df, "text", "lang", ~language.held_out(df["doc_id"]))
    got = {r["doc_id"]: r for r in language.predict(df, ["doc_id"], "text", net).collect()}
    assert [got[k]["lang_pred"] for k in (100, 101, 102)] == ["und"] * 3 and got[102]["score"] == 0
    assert got[103]["lang_pred"] == "en" and got[None]["lang_pred"] == "en"
    kept = language.known_language(df, "text", "lang", "doc_id")
    assert kept.columns == df.columns and not {100, 101, 102} & {r["doc_id"] for r in kept.collect()} and kept.count() == 18
    assert language.learn(df.limit(0), "text", "lang", ~language.held_out(df["doc_id"])) is None
    assert {r["lang_pred"] for r in language.predict(df, ["doc_id"], "text", None).collect()} == {"und"}
    assert language.known_language(df.limit(0), "text", "lang", "doc_id").count() == 0


def test_language_sample_of_copies(spark):
    """The bound counts different texts: copies do not thin them out."""
    texts = spark.range(60).selectExpr("concat('text number ', id, ' of some words') text", "'en' lang")
    copies = spark.range(40000).selectExpr("concat('text number ', id % 3, ' of some words') text", "'en' lang")
    rows = language.sample(texts.unionByName(copies), "text", "lang", F.lit(True), 50).collect()
    assert len({r["piece"] for r in rows}) == len(rows) == 50


def test_known_language_without_labels(spark):
    """Texts with a letter stay if nothing is labelled."""
    df = spark.createDataFrame([(1, "some text", None), (2, "été", None), (3, "12 | 3", None), (4, None, None), (5, "", None)], "doc_id long, text string, lang string")
    kept = language.known_language(df, "text", "lang", "doc_id")
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2]


def test_language_many_labels(spark):
    """No label is left out, however many there are."""
    rows = spark.range(1200).selectExpr("concat('some text ', id) text", "concat('l', id % 600) lang")
    assert language.sample(rows, "text", "lang", F.lit(True)).select("lang").distinct().count() == 600


def test_network_forward():
    """Filters, maxima and probabilities against plain loops; filters see no byte beyond their width."""
    rng = np.random.default_rng(5)
    mask, widest, size = language._width_mask(), max(language.WIDTHS), language.VECTOR
    draw = lambda *shape: rng.standard_normal(shape).astype(np.float32)
    net = language.Network(["a", "b", "c"], draw(256, size), draw(*mask.shape) * mask, draw(mask.shape[1]), draw(mask.shape[1], 3), draw(3))
    windows = rng.integers(0, 256, (130, language.WINDOW)).astype(np.uint8)
    got = net(windows)
    for k in (0, 1, 127, 128, 129):
        held = net.vectors[windows[k]].astype(np.float64)
        pooled = []
        for f in range(mask.shape[1]):
            width = language.WIDTHS[f // language.FILTERS]
            one = net.filters[:width * size, f].reshape(width, size)
            best = max((held[i:i + width] * one).sum() for i in range(language.WINDOW - widest + 1))
            pooled.append(max(best + net.bias[f], 0))
        logits = np.array(pooled) @ net.out + net.out_bias
        raised = np.exp(logits - logits.max())
        assert got[k] == pytest.approx(raised / raised.sum(), abs=1e-4)


def test_windows_cover_texts():
    """Windows of a text begin a window less the widest filter's overlap apart and hold each run of bytes that a filter can see."""
    rng = np.random.default_rng(6)
    sizes = [0, 1, 3, 255, 256, 257, 509, 510, 1000, 0, 5000]
    data = rng.integers(1, 256, sum(sizes)).astype(np.uint8)
    at = np.concatenate([[0], np.cumsum(sizes)])
    held, of, left = language._windows(data, at)
    overlap = max(language.WIDTHS) - 1
    for k, n in enumerate(sizes):
        mine = [held[i][:left[i]].tolist() for i in np.flatnonzero(of == k)]
        text = mine[0] if mine else []
        for part in mine[1:]:
            assert part[:overlap] == text[-overlap:]
            text = text + part[overlap:]
        assert text == data[at[k]:at[k + 1]].tolist()
    assert all((held[i][left[i]:] == 0).all() for i in range(len(of)))


def test_network_slopes():
    """Training tells two classes of windows apart."""
    rng = np.random.default_rng(0)
    windows = rng.integers(97, 123, (64, language.WINDOW)).astype(np.uint8)
    windows[:32, ::3] = 101
    labels = np.repeat([0, 1], 32)
    net = language.train(windows, labels, ["a", "b"])
    assert (net(windows).argmax(axis=1) == labels).mean() == 1


@pytest.mark.parametrize("seed", range(4))
def test_token_counts(spark, tmp_path, seed):
    rng = random.Random(seed)
    n, block = rng.choice([0, 1, 30, 200]), rng.choice([2, 4, 64, 1024])
    sizes = [rng.choice([0, 0, 1, 5, rng.randrange(300), rng.randrange(2000)]) for _ in range(n)]
    df = spark.createDataFrame([([rng.randrange(50) for _ in range(k)],) for k in sizes], "ids array<int>").repartition(rng.choice([1, 3, 7]))
    path = str(tmp_path / "tokens")
    tokencount.write_tokens(df, "ids", path, 50256, block)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.input.fileinputformat.split.maxsize", str(block * rng.choice([1, 7, 1000])))
    try:
        rows = tokencount.count_tokens(spark, path, 50256, block).collect()
    finally:
        conf.unset("mapreduce.input.fileinputformat.split.maxsize")
    assert collections.Counter(r["n_tokens"] for r in rows) == collections.Counter(sizes)
    assert len({r["doc_no"] for r in rows}) == n


def test_token_files(spark, tmp_path):
    df = spark.createDataFrame([([1, 2],), (None,), ([],)], "ids array<int>").coalesce(1)
    tokencount.write_tokens(df, "ids", str(tmp_path / "t"), 9, 2)
    held = b"".join(p.read_bytes() for p in (tmp_path / "t").glob("part-*"))
    assert np.frombuffer(held, "<u2").tolist() == [1, 2, 9, 9, 9]
    with pytest.raises(Exception, match="end-of-document"):
        tokencount.write_tokens(spark.createDataFrame([([9],)], "ids array<int>"), "ids", str(tmp_path / "u"), 9)


def test_token_count_query(spark, library):
    texts = [r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = QUERIES["op3_token_counts"](spark, SMALL).collect()
    assert collections.Counter(r["n_tokens"] for r in rows) == collections.Counter(len(library.encode_ordinary(t)) for t in texts)


def test_licences(spark):
    mit = dict(licences.LICENCES)["MIT"]
    wrapped = "// Copyright (c) 2019-2024 Some One\n\n" + "\r\n".join("  # " + x for x in re.findall(r".{1,60}(?:\s|$)", mit.upper().replace("SUBLICENSE", "sub-licence")))
    notice = "text\n  * licensed under the APACHE Licence, version 2.0 *\nReleased under the MIT License.\nReleased under the MIT License."
    rows = [(1, wrapped, "digest"), (2, notice, "x"), (3, None, None), (4, "", "x"), (5, "-- ...", "x"), (1, wrapped, "again"), (None, mit + " Not.", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, licence string")
    known = licences.known(spark, licences.LICENCES), licences.known(spark, licences.NOTICES)
    got = [tuple(r) for r in licences.scan(df, "doc_id", "text", *known).collect()]
    named = sorted(((k, l, names, n) for k, _, l, names, n in got), key=repr)
    assert named == sorted([(1, "MIT", "", 0), (1, "MIT", "", 0), (2, None, "Apache-2.0,MIT", 3), (3, None, "", 0), (4, None, "", 0),
                            (5, None, "", 0), (None, None, "", 0)], key=repr)
    empty = hashlib.sha256(b"").hexdigest()
    assert [d for k, d, *_ in got if k in (3, 4, 5)] == [empty] * 3
    assert licences.scan(df.limit(0), "doc_id", "text", *known).count() == 0


def test_licence_query_knows_titles_and_long_texts(spark, tmp_path):
    texts = {p.stem: p.read_text() for p in licences.TEXTS.glob("*.txt")}
    mit = "MIT License\n\nCopyright (c) 2020 Some One\n\n" + dict(licences.LICENCES)["MIT"]
    header = '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file'
    rows = [*texts.items(), ("mit", mit), ("header", header), ("spdx", "// SPDX-License-Identifier: MPL-2.0")]
    spark.createDataFrame(rows, "doc_id string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: (r["licence"], r["notices"]) for r in QUERIES["op4_licences"](spark, str(tmp_path)).collect()}
    assert all(got[name][0] == name for name in texts) and {"Apache-2.0", "BSD-3-Clause", "GPL-3.0"} <= texts.keys()
    assert (got["mit"], got["header"], got["spdx"]) == (("MIT", ""), (None, "Apache-2.0"), (None, "MPL-2.0"))


def brute_scores(rows, order):
    grams, own, n = collections.Counter(), collections.defaultdict(collections.Counter), collections.Counter()
    texts = [(k, re.findall(r"[^\W_]+", (t or "").lower())) for k, t in rows]
    for k, w in texts:
        n[k] += len(w)
        for m in range(1, order + 1):
            for i in range(len(w) - m + 1):
                grams[tuple(w[i:i + m])] += 1
                own[k][tuple(w[i:i + m])] += 1
    total, out = sum(n.values()), collections.Counter({k: 0.0 for k in n})
    for k, w in texts:
        others = lambda g: grams[g] - own[k][g]  # noqa: E731, B023
        for i in range(len(w)):
            g = tuple(w[max(0, i - order + 1):i + 1])
            while len(g) > 1 and others(g) <= 0:
                out[k] += math.log(0.4)
                g = g[1:]
            out[k] += math.log(max(others(g), 0.5)) - math.log(others(g[:-1]) if len(g) > 1 else max(1, total - n[k]))
    return {k: (n[k], out[k]) for k in n}


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_backoff(spark, order):
    rng = random.Random(order)
    rows = [(rng.choice([i, i, 3, None]), rng.choice([None, "", *[" ".join(rng.choice("abcdE") for _ in range(rng.randrange(1, 30))) for _ in range(6)]])) for i in range(25)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, own int")
    got = {r["doc_id"]: (r["n_words"], r["score"]) for r in backoff.scores(spark, df, "doc_id", "text", order).collect()}
    want = brute_scores(rows, order)
    assert got.keys() == want.keys()
    for k in got:
        assert got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-6)
    assert backoff.scores(spark, df.limit(0), "doc_id", "text", order).count() == 0


def test_backoff_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    for n in (0, 1, 1000):
        values = rng.integers(-2**63, 2**63, n)
        assert (backoff._values(backoff._packed(values)) == values).all()
        names = np.sort(values.view(np.uint64))
        assert (backoff._values(backoff._packed(names, True), True).view(np.uint64) == names).all()
    # slices of 10 words: rows stay whole, rows with an owner are apart, none is lost
    monkeypatch.setattr(backoff, "SLICE_WORDS", 10)
    rows = [rng.integers(0, 5, rng.integers(0, 25)).tolist() for _ in range(60)]
    owner = [None if i % 4 else i % 3 for i in range(60)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(a, a + 20)), pa.array(owner[a:a + 20], pa.int64()), pa.array(rows[a:a + 20], pa.list_(pa.int64()))],
                                          names=["c0", "c1", "c2"]) for a in (0, 20, 40)]
    cut = [pa.Table.from_batches([b]) for b in backoff._cut(batches)]
    seen, asked, others = {}, [], collections.Counter()
    for k, t in enumerate(cut):
        one = backoff._Slice(t, 2)
        owners = t.column("owners")[0].as_py()
        assert len(set(o is None for o in owners)) == 1 and (len(one.sizes) == 1 or sum(one.sizes) <= 34)
        words = backoff._values(t.column("vocabulary")[0].as_py())[backoff._values(t.column("codes")[0].as_py())]
        for d, w in zip(one.docs.to_pylist(), np.split(words, np.cumsum(one.sizes)[:-1])):
            seen[d] = w.tolist()
        counts, whose = one.counts[one.order], None if one.owner is None else one.owner[one.order]
        asked += [(r, k, backoff._packed(one.names[at], True), backoff._packed(counts[at]), None if whose is None else backoff._packed(whose[at])) for r, at in one.asked(3)]
    assert seen == dict(enumerate(rows)) and len(cut) > 10
    # the ranges' answers are the counts of the others, by documents or by owners
    kinds = [("range", pa.int32()), ("slice", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary()), ("owners", pa.binary())]
    answers = collections.defaultdict(list)
    for r in range(3):
        part = [a for a in asked if a[0] == r]
        for row in backoff._add_up(pa.table({n: pa.array([a[i] for a in part], t) for i, (n, t) in enumerate(kinds)})).to_pylist():
            answers[row["slice"]].append(backoff._values(row["answers"]))
    grams = {d: collections.Counter(tuple(w[i:i + 2]) for i in range(len(w) - 1)) for d, w in seen.items()}
    total = sum(grams.values(), others)
    for k, t in enumerate(cut):
        one = backoff._Slice(t, 2)
        found = one.others(np.concatenate(answers[k] or [np.zeros(0, np.int64)]))[1]
        for at, n in enumerate(found):
            if one.place[at] >= 1:
                d = one.docs[int(one.doc[at])].as_py()
                g = tuple(seen[d][one.place[at] - 1:one.place[at] + 1])
                own = sum(grams[x][g] for x in seen if owner[x] == owner[d]) if owner[d] is not None else grams[d][g]
                assert n == total[g] - own


def test_toxicity(spark):
    rng = random.Random(8)
    syllables = ["the", "re", "ti", "on", "an", "ed", "wh", "or", "st", "ble", "nd", "ea"]
    prose = lambda n: ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    docs, labels = [], []
    for i in range(900):
        w = prose(rng.randrange(20, 300))
        if i % 3 == 0:
            for _ in range(max(3, len(w) // 30)):
                w[rng.randrange(len(w))] = rng.choice(["wretched", "scoundrel", "blockhead", "pathetic"])
        docs.append((i, " ".join(w), "x"))
        labels.append((i, int(i % 3 == 0)))
    docs += [(1000, None, "x"), (1001, "", "x"), (None, "scoundrel", "x"), (1002, "wretched scoundrel " * 20000, "x")]
    labels += [(0, 0), (None, 1), (5, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    learned = ~language.held_out(marked["doc_id"], 5, 0)
    model = toxicity.learn(df, "doc_id", "text", marked, "doc_id", "toxic", learned)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, ["doc_id"], "text", model).collect()}
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.5) == (i % 3 == 0) for i in held]) >= 0.95
    assert got[1000] == got[1001] < 0.5 <= got[1002] and all(0 <= s <= 1 for s in got.values())
    none = toxicity.learn(df, "doc_id", "text", marked.limit(0), "doc_id", "toxic", learned)
    assert {r["score"] for r in toxicity.score(df, ["doc_id"], "text", none).collect()} == {0.0}
    assert toxicity.score(df.limit(0), ["doc_id"], "text", model).count() == 0


def test_toxicity_behind_long_prose(spark):
    """Marks that begin after 8000 characters are learned."""
    rng = random.Random(5)
    prose = lambda n: ["".join(rng.choice(["the", "re", "ti", "on", "an", "ed", "wh", "or"]) for _ in range(rng.randrange(1, 4))) for _ in range(n)]
    docs = [(i, " ".join(prose(2000) + (["wretched", "scoundrel"] * 4 if i % 2 else prose(8)))) for i in range(240)]
    assert min(len(t) for _, t in docs) > 8500
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marked = spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, toxic int")
    model = toxicity.learn(df, "doc_id", "text", marked, "doc_id", "toxic", marked["doc_id"] >= 30)
    assert all(b"wretched" in x and b"scoundrel" in x for x in model.toxic)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(df, ["doc_id"], "text", model).collect()}
    assert all((got[i] >= 0.5) == bool(i % 2) for i in range(30))


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES["op7_toxicity"](spark, folder).collect()}
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    tested = [k for k in truth if rows[k]["held_out"]]
    y, s = np.array([truth[k] for k in tested]), np.array([rows[k]["score"] for k in tested])
    order = np.argsort(np.argsort(s, kind="stable"), kind="stable") + 1
    area = (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))
    assert area >= 0.95 and np.mean((s >= 0.5) == y) >= 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows.values())


@pytest.mark.parametrize("size", ["32m", "64m", "67108864b", "4194304"])
def test_batch_setting_of_the_session_stays(spark, size):
    name, before = "spark.sql.execution.arrow.maxBytesPerBatch", spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None)
    spark.conf.set(name, size)
    try:
        df = spark.createDataFrame([(1, "hi there")], "doc_id long, text string")
        assert bpe.digest_rows(df, RANKS, public_tokenizers.PATTERN).first()["n_tokens"] == 2
        assert spark.conf.get(name) == size
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
