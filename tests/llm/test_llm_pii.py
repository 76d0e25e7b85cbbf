"""Personal data: base spans against plain patterns, weak supervision on known labelers."""

import hashlib
import random
import re

import numpy as np

from millrace.llm import pii
from millrace.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, spans string, base string, n_email int, `a.b` int"

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    for k, pattern, good in ((2, CARD, lambda d: 12 <= len(d) <= 19 and luhn(d)), (3, PHONE, lambda d: 9 <= len(d) <= 15)):
        out += [(m.start(), k, m.end()) for m in pattern.finditer(text) if good(re.sub("[^0-9]", "", m.group()))]
    return sorted(out)


def test_base_against_plain_patterns():
    rng = random.Random(5)
    parts = ["a", "b@", "@", ".", "x.y", "%", "-", " ", "1", "23", "255", "256", "007", "+", "+1", "(", ")", "4111111111111111", "4111 1111 1111 1111", "é", "😀", "\n", "0"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert pii.base(text) == brute(text), text
    for _ in range(2000):
        text = "".join(rng.choices("1.2+- (", k=rng.randrange(40)))
        assert pii.base(text) == brute(text), text


def test_long_runs_take_linear_time():
    for piece in ("a", "1", "1.", "+1(", "@", "a@", "1 ", "(1-", " at a", "a:1", "[.]1"):
        text = piece * (600_000 // len(piece))
        pii.base(text), pii.candidates(text)


def test_estimates_find_reliable_labelers():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.4
    right = np.array([0.95, 0.9, 0.8, 0.75, 0.7, 0.55])
    votes = np.where(rng.random((len(truth), 6)) < right, truth[:, None], ~truth[:, None]) + 1
    votes[rng.random(votes.shape) < 0.2] = 0
    codes, at, counts = np.unique(votes @ 3 ** np.arange(5, -1, -1), return_inverse=True, return_counts=True)
    belief, chances = pii.estimate(codes, counts)
    assert ((belief[at] > 0.5) == truth).mean() > 0.95
    assert np.abs(chances[1, :, pii.YES] - right).max() < 0.03
    assert np.abs(chances[0, :, pii.NO] - right).max() < 0.03


def test_estimates_stay_likelihoods():
    """One more round of the two steps, written plainly, changes nothing."""
    rng = np.random.default_rng(3)
    codes, counts = np.arange(0, 3 ** 6, 17), rng.integers(1, 50, len(range(0, 3 ** 6, 17)))
    belief, chances = pii.estimate(codes, counts, rounds=5000, least=1e-13)
    votes = pii._votes(codes)
    share = ((belief * counts).sum() + 1) / (counts.sum() + 2)
    for i in range(len(codes)):
        yes, no = share, 1 - share
        for j, v in enumerate(votes[i]):
            if v:
                yes, no = yes * chances[1, j, v], no * chances[0, j, v]
        assert abs(yes / (yes + no) - belief[i]) < 1e-6


def test_classifier_is_at_its_optimum():
    rng = np.random.default_rng(4)
    shapes, belief, counts = np.arange(64), rng.random(64), rng.integers(1, 9, 64).astype(float)
    w = pii.classifier(shapes, belief, counts)
    x = np.hstack([shapes[:, None] >> np.arange(len(pii.SHAPE)) & 1, np.ones((64, 1))])
    assert np.abs(x.T @ (counts * (1 / (1 + np.exp(-x @ w)) - belief)) + 0.1 * w).max() < 1e-6


PLANTED = ["mail jane.doe (at) example dot org now", "host 192[.]168[.]1[.]7 down", "call tel 030 123 45 67 today", "card 4111.1111.1111.1111 was", "at 2001:db8:0:1:2:3:4:5 up"]


def test_added_spans_and_decoys(spark):
    plain = ["write to a.b@mail.example.com or +1 (918) 555-3922, card 4111 1111 1111 1111, from 10.2.3.4", "number 4111111111111112 is none", "300.1.2.3 is none",
             "order 1234 5678 90 and version 1.2.3", 'token = "586908a73d53ffc777675612345678901d12d4663"', "no data at all at the end"]
    rows = [(i, t, "x", "y", 1, 2) for i, t in enumerate(plain * 30 + PLANTED * 10)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r for r in pii.find(df, ["doc_id"], "text", pii.learn(df, "text")).collect()}
    for i, t in enumerate(plain * 30):
        assert got[i]["n_added"] == 0 and got[i]["spans"] == pii._joined(brute(t)), t
    kinds = [got[len(plain) * 30 + i]["spans"].split(":")[0] for i in range(len(PLANTED))]
    assert kinds == ["email", "ip", "phone", "card", "ip"]


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "s", "b", 1, 2), (1, "", None, None, None, None), (None, "a@b.c 😀 +123456789", "s", "b", 1, 2)] * 2, SCHEMA)
    rows = pii.find(df, ["doc_id"], "text", pii.learn(df, "text")).collect()
    assert sorted(r["spans"] for r in rows) == ["", "", "", ""] + ["email:0:5,phone:8:18"] * 2
    empty = df.limit(0)
    assert pii.find(empty, ["doc_id"], "text", pii.learn(empty, "text")).count() == 0
    assert pii.learn(empty, "text").weights == [None] * 4


def test_query(spark):
    rows = QUERIES["op11_personal"](spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        spans = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in spans) for k in range(4)]
        joined = pii._joined(spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r["spans"].split(","))
