"""The divergence audit against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import divergence
from millrace.llm.queries import ORACLES, QUERIES
from tools.check import compare, oracle

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, term string, `n.x` int"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, least, top):
    groups, langs, df = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for _, text, lang, source, *_ in rows:
        lang, terms = lang or "", TERM.findall(lowered(text))
        groups[lang, source or ""].update(terms)
        langs[lang].update(terms)
        df[lang].update(set(terms))
    share = lambda n, total, kept: 1 + 10 ** 9 * (n + 5) // (total + 5 * kept)
    out = []
    for (lang, source), own in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        p = lambda c: {t: share(c[t], sum(c[x] for x in kept), len(kept)) for t in kept}
        mine, usual = p(own), p(langs[lang])
        pairs = [(s, sum(abs(mine[t] - q) for t, q in p(c).items())) for (x, s), c in groups.items() if x == lang and s != source]
        terms = [(t, mine[t] - usual[t]) for t in kept if own[t] and mine[t] > usual[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            found.sort(key=lambda f: (-f[1], f[0].encode()))
            out += [(lang, source, part, item, value, n + 1) for n, (item, value) in enumerate(found[:most])]
    return sorted(out)


def made(seed, docs=120, sources=9):
    rng = random.Random(seed)
    voc = [f"w{chr(97 + i)}" for i in range(20)] + ["Éa", "x y", "ÄB9c", "😀", "Wa"]
    rows = [(i, " ".join(rng.choices(voc, k=rng.randrange(40))), rng.choice(["en", "de", None]), rng.choice([None, *[f"s{j}" for j in range(sources)]]), "t", 1)
            for i in range(docs)]
    return rows + rows[:7] + [(1, None, "en", "only null", None, None), (None, "", "zz", None, None, None), (2, "9 .", "zz", "b", None, None)]


def audited(spark, rows, least=6, top=4, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in divergence.audit(spark, df, least=least, top=top, **sizes).select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"block": 2, "slice_terms": 5}), (3, {"block": 3, "slice_terms": 1000})])
def test_audit_against_brute_force(spark, seed, sizes):
    rows = made(seed)
    got = audited(spark, rows, **sizes)
    assert got == brute(rows, 6, 4)
    assert {r[2] for r in got} == {"pair", "term"}


def test_nothing_kept_and_empty(spark):
    rows = made(4, docs=10)
    got = audited(spark, rows, least=1000)
    assert got == brute(rows, 1000, 4) and {r[4] for r in got} == {0}
    assert audited(spark, []) == []


def test_counts_of_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 50)
    rng = random.Random(8)
    text = " ".join("".join(rng.choices("abÉZ", k=rng.choice([1, 2, 90]))) for _ in range(300))
    batch = pa.record_batch([pa.array(["en"]), pa.array(["s"]), pa.array([text])], names=["lang", "source", "text"])
    got = divergence._counted(batch).to_pylist()
    assert {r["term"]: r["n"] for r in got if r["term"]} == dict(collections.Counter(TERM.findall(lowered(text))))
    assert all(r["docs"] == (r["term"] is not None) for r in got)


def test_shares_beyond_64_bits(spark):
    n = 9_000_000_000_000_000
    df = spark.createDataFrame([(n, 2 * n, 7), (0, 0, 0), (0, 10, 3)], "n long, total long, kept long")
    got = [r[0] for r in df.select(divergence._share(df["n"], df["total"], df["kept"])).collect()]
    assert got == [1 + 10 ** 9 * (n + 5) // (2 * n + 35), 1, 1 + 5 * 10 ** 9 // 25]


def test_distances():
    rng = np.random.default_rng(1)
    values, points = rng.integers(0, 50, 30), rng.integers(-5, 60, 12)
    assert divergence._distances(values, points).tolist() == [int(np.abs(values - x).sum()) for x in points]
    assert divergence._distances(values[:0], points).tolist() == [0] * 12


def test_query_against_sql(spark):
    state, n, detail = compare(QUERIES["op12_divergence"](spark, SMALL), oracle(SMALL), ORACLES["op12_divergence"])
    assert state == "ok" and n > 0, detail
