"""Personal data in texts: fixed patterns, and looser forms judged by weak supervision.

Spans of four kinds are found.  Base spans follow fixed patterns with a check
and always stay.  Candidates are the base spans, what their patterns met but
their checks refused, and looser forms: ``name (at) host dot org``, ``1[.]2[.]3[.]4``,
IPv6, cards with other separators, numbers without a plus.

Labelers vote yes, no or nothing on every candidate: patterns and checks,
gazetteers (domain endings, card issuers, calling codes) and contexts (words
before, characters around).  The votes of the whole corpus are counted by pattern of
votes and shape, a table whose size does not depend on the corpus.  Over it,
expectation-maximisation estimates for each kind how reliable each labeler is
and how likely each pattern is personal data, where base spans are known to be
and refused matches and forms behind a contrary word not to be; a logistic classifier of the shape is trained on
these likelihoods.  Loose forms that it calls personal data and that cross no base
span are added, likelier ones first.

Null and empty texts have no spans.  Without candidates of a kind nothing of
that kind is added.  Repeated rows count as often as they occur.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.batches import columns, mapped, slices

EMAIL, IP, CARD, PHONE = range(4)
KINDS = ("email", "ip", "card", "phone")
NO, YES = 1, 2
#: Labelers in the order of their votes; bits of a candidate's shape.
LABELERS = ("pattern", "check", "layout", "gazetteer", "cue", "around")
SHAPE = ("sign", "brackets", "pieces", "long", "glued", "cued", "checked", "listed", "against")
#: Characters before a span in which cues are looked for; a local part of a mail address has at most 64.
CUE_REACH, LOCAL = 32, 64

# Gazetteers.
ENDINGS = frozenset("com org net edu gov mil int info biz io co ai app dev eu uk us de fr es it nl be ch at pl pt se no fi dk ie cz ru ua jp cn in au ca br mx".split())
FILE_ENDINGS = frozenset("png jpg jpeg gif svg css js html htm pdf txt csv zip gz py java md xml json".split())
CALLING = ("1", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49",
           "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "7", "81", "82", "84", "86", "90", "91", "92", "98")
ISSUERS = ("4", "51", "52", "53", "54", "55", "22", "23", "24", "25", "26", "27", "34", "37", "6011", "65", "35", "36", "38", "30")
CUES = (frozenset("mail email e-mail mailto contact write correo courriel".split()), frozenset("ip ipv4 ipv6 address server host client addr".split()),
        frozenset("card visa mastercard amex credit debit karte carte tarjeta".split()),
        frozenset("tel phone telephone call mobile cell fax telefon téléphone teléfono handy whatsapp".split()))
AGAINST = frozenset("order invoice isbn issn version release build token key hash id ref serial sku total price page section ticket".split())

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_dotted = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_card = re.compile(r"[0-9](?:[ -]?[0-9])+")
_phone = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_digit = re.compile(r"[0-9]")
_not_digit = re.compile(r"[^0-9]")
_hidden_at = re.compile(r"\s?[\[({<]\s?(?:at|AT|@)\s?[\])}>]\s?|\s(?:at|AT)\s")
_hidden_domain = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\.|\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s)[A-Za-z0-9-]{1,63}){1,8}")
_hidden_dot = re.compile(r"\s?[\[({<]\s?(?:dot|DOT|\.)\s?[\])}>]\s?|\s(?:dot|DOT)\s")
_defanged = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_six = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}|:)(?::[0-9A-Fa-f]{1,4}){0,6}(?![0-9A-Za-z:])")
_loose_card = re.compile(r"(?<![0-9A-Za-z.])[0-9]{3,6}(?:[./_– ]|\s{2,3})[0-9]{3,6}(?:(?:[./_– -]|\s{1,3})[0-9]{2,7}){1,4}(?![0-9A-Za-z])")
_loose_phone = re.compile(r"(?<![0-9A-Za-z.+$€£#=/_])\(?[0-9][ ().0-9/-]{5,24}[0-9](?![0-9A-Za-z_])")
_word = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    doubled = sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 and not p[:-3].strip("0") for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@``, so that a long run without one costs nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _domain.match(text, at + 1) if start < at else None
        done = found.end() if found else at + 1
        if found:
            yield start, done
        at = text.find("@", done)


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, whether the check holds) of every match of the fixed patterns."""
    for start, end in _emails(text):
        yield EMAIL, start, end, True
    if not _digit.search(text):
        return
    for chain in _dotted.finditer(text):
        if chain.end() - chain.start() < 7:
            continue
        parts, begin = chain.group().split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = begin + sum(map(len, four)) + 3
            yield IP, begin, end, _octets(four)
            begin = end + 1
    for found in _card.finditer(text):
        if 12 <= found.end() - found.start() <= 37:
            digits = _not_digit.sub("", found.group())
            if 12 <= len(digits) <= 19:
                yield CARD, *found.span(), luhn(digits)
    if "+" in text:
        for found in _phone.finditer(text):
            yield PHONE, *found.span(), 9 <= len(_not_digit.sub("", found.group())) <= 15


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns' spans, in that order."""
    return sorted((start, kind, end) for kind, start, end, good in _matches(text) if good)


class _Taken:
    """Stretches of a text that are spoken for; they do not cross one another."""

    def __init__(self, spans: Iterable[tuple[int, int]]):
        self.at: list[tuple[int, int]] = []
        for start, end in sorted(spans):
            if self.at and start < self.at[-1][1]:
                self.at[-1] = (self.at[-1][0], max(end, self.at[-1][1]))
            else:
                self.at.append((start, end))

    def crosses(self, start: int, end: int) -> bool:
        i = bisect.bisect_left(self.at, (end, -1))
        return i > 0 and self.at[i - 1][1] > start

    def add(self, start: int, end: int) -> None:
        bisect.insort(self.at, (start, end))


def _loose(text: str) -> Iterator[tuple[int, int, int]]:
    for found in _hidden_at.finditer(text):
        start = found.start()
        while start > max(0, found.start() - LOCAL) and text[start - 1] in _LOCAL:
            start -= 1
        rest = _hidden_domain.match(text, found.end()) if start < found.start() else None
        if rest and (found.group().strip() not in ("at", "AT") or _hidden_dot.search(rest.group())):
            yield EMAIL, start, rest.end()
    if not _digit.search(text):
        return
    for kind, pattern in ((IP, _defanged), (IP, _six), (CARD, _loose_card)):
        for found in pattern.finditer(text):
            yield kind, *found.span()
    for found in _loose_phone.finditer(text):
        # bare groups of digits are of many kinds; a bracketed area, an international prefix or a cue tells
        told = found.group().startswith(("(", "00")) or _cue(PHONE, text, found.start())
        if told and 7 <= len(_not_digit.sub("", found.group())) <= 15 and len(re.findall(r"[0-9]+", found.group())) > 1:
            yield PHONE, *found.span()


def candidates(text: str) -> list[tuple[int, int, int, int]]:
    """(kind, start, end, vote of the pattern): base spans, refused matches, and loose forms beside them."""
    firm = [(kind, start, end, YES if good else NO) for kind, start, end, good in _matches(text)]
    kept, met = _Taken((s, e) for _, s, e, v in firm if v == YES), _Taken((s, e) for _, s, e, _ in firm)
    # a card may be written with dots, which the pattern of addresses meets and refuses
    return firm + [(kind, start, end, 0) for kind, start, end in _loose(text) if not (kept if kind == CARD else met).crosses(start, end)]


def _checked(kind: int, span: str, digits: str) -> bool:
    if kind == EMAIL:
        return not any(x[:1] == "-" or x[-1:] == "-" for x in re.split(r"[.@]", _hidden_dot.sub(".", _hidden_at.sub("@", span))))
    if kind == IP:
        parts = re.findall(r"[0-9]+", span)
        if ":" in span:
            groups = span.split(":")
            return (len(groups) == 8 and all(groups)) or (span.count("::") == 1 and len(groups) <= 8)
        return len(parts) == 4 and _octets(parts)
    if kind == CARD:
        return 12 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


def _laid_out(kind: int, span: str) -> int:
    if kind == EMAIL:
        return YES if "@" in span or re.search(r"[\[({<]", span) else 0
    if kind == IP:
        return NO if re.search(r"(?<![0-9A-Fa-f])0[0-9]", span) and ":" not in span else YES
    sizes = [len(x) for x in re.findall(r"[0-9]+", span)]
    if kind == CARD:
        return YES if sizes in ([16], [15], [4, 4, 4, 4], [4, 6, 5]) else NO
    return YES if 3 <= len(sizes) <= 6 and sizes[-1] >= 2 else NO


def _listed(kind: int, span: str, digits: str) -> int:
    if kind == EMAIL:
        ending = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        return YES if ending in ENDINGS else NO if ending in FILE_ENDINGS or ending.isdigit() else 0
    if kind == IP:
        return NO if span.startswith(("0.", "0[")) else 0
    if kind == CARD:
        return YES if digits.startswith(ISSUERS) else 0
    return YES if (span[0] == "+" and digits.startswith(CALLING)) or digits.startswith("00") and digits[2:].startswith(CALLING) else 0


def _cue(kind: int, text: str, start: int) -> int:
    words = {w.lower() for w in _word.findall(text, max(0, start - CUE_REACH), start)}
    return NO if words & AGAINST else YES if words & CUES[kind] else 0


def features(text: str, kind: int, start: int, end: int, pattern: int) -> tuple[int, int]:
    """Votes of the labelers (base 3) and shape (bits) of a candidate."""
    span = text[start:end]
    digits = _not_digit.sub("", span)
    before, after = text[start - 1:start], text[end:end + 1]
    glued = before.isalnum() or after.isalnum() or before in ("_", "=", '"', "/", "#") or after in ("_", '"')
    checked, listed, cue = _checked(kind, span, digits), _listed(kind, span, digits), _cue(kind, text, start)
    votes = (pattern, YES if checked else NO, _laid_out(kind, span), listed, cue, NO if glued else YES)
    code = 0
    for v in votes:
        code = code * 3 + v
    signs = (span[0] == "+" or "@" in span, any(c in span for c in "[({<"), len(re.findall(r"[0-9A-Za-z]+", span)) > 2,
             len(digits) >= 12, glued, cue == YES, checked, listed == YES, cue == NO)
    return code, sum(1 << i for i, s in enumerate(signs) if s)


def _votes(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELERS) - 1, -1, -1) % 3


def estimate(codes: np.ndarray, counts: np.ndarray, known: np.ndarray | None = None, rounds: int = 200, least: float = 1e-9) -> tuple[np.ndarray, np.ndarray]:
    """(likelihood of each pattern of votes, (class, labeler, vote) probabilities) by expectation-maximisation.

    Begins with the majority of the votes; likelihoods that are ``known`` (not a
    number: unknown) stay.  A few counts in favour of labelers that are right more
    often than wrong keep the two classes from changing places.
    """
    votes = _votes(codes)
    known = np.full(len(codes), np.nan) if known is None else known
    belief = np.clip(0.5 + ((votes == YES).sum(1) - (votes == NO).sum(1)) / (2.0 * len(LABELERS)), 0.05, 0.95)
    belief = np.where(np.isnan(known), belief, known)
    prior = np.ones((2, len(LABELERS), 3))
    prior[:, :, 0], prior[0, :, NO], prior[1, :, YES] = 0.0, 3.0, 3.0
    # a labeler that abstains says nothing
    seen = np.stack([np.zeros(votes.shape, bool), votes == NO, votes == YES], axis=2).astype(float)
    chances = prior
    for _ in range(rounds):
        weight = np.stack([(1 - belief) * counts, belief * counts])
        chances = np.einsum("cp,plv->clv", weight, seen) + prior
        chances /= chances.sum(2, keepdims=True)
        open_rows = weight[:, np.isnan(known)]
        share = (open_rows.sum(1) + 1) / (open_rows.sum() + 2)
        log = np.log(share)[:, None] + np.einsum("clv,plv->cp", np.log(np.maximum(chances, 1e-300)), seen)
        new = np.where(np.isnan(known), 1 / (1 + np.exp(np.clip(log[0] - log[1], -500, 500))), known)
        done = np.abs(new - belief).max(initial=0.0) < least
        belief = new
        if done:
            break
    return belief, chances


def classifier(shapes: np.ndarray, belief: np.ndarray, counts: np.ndarray, ridge: float = 0.1, rounds: int = 50) -> np.ndarray:
    """Logistic weights of the shape bits and a last constant, by Newton steps on likelihoods as labels."""
    x = np.hstack([shapes[:, None] >> np.arange(len(SHAPE)) & 1, np.ones((len(shapes), 1), np.int64)]).astype(float)
    w, keep = np.zeros(x.shape[1]), ridge * np.eye(x.shape[1])

    def loss(v: np.ndarray) -> float:
        z = x @ v
        return float((counts * (np.logaddexp(0, z) - belief * z)).sum() + ridge * v @ v / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (counts * (p - belief)) + ridge * w
        step = np.linalg.solve((x.T * (counts * p * (1 - p))) @ x + keep, slope)
        size = 1.0
        while loss(w - size * step) > loss(w) and size > 1e-6:
            size /= 2
        w = w - size * step
        if np.abs(step).max() * size < 1e-10:
            break
    return w


@dataclass
class Model:
    """Per kind: weights of the classifier (None without candidates) and the labelers' vote probabilities."""

    weights: list[np.ndarray | None]
    reliability: list[np.ndarray | None]

    def chance(self, kind: int, shape: int) -> float:
        w = self.weights[kind]
        if w is None:
            return 0.0
        z = float(w[-1] + sum(w[i] for i in range(len(SHAPE)) if shape >> i & 1))
        return float(1 / (1 + np.exp(-max(-500.0, min(500.0, z)))))


PATTERNS = "kind long, votes long, shape long, n long"


def patterns(docs: DataFrame, text: str) -> DataFrame:
    """(kind, votes, shape, n): all candidates of all texts, counted."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for part in slices(batches, 0):
            for value in part.column(0).to_pylist():
                seen.update((kind, *features(value, kind, start, end, vote)) for kind, start, end, vote in candidates(value or ""))
        if seen:
            keys = list(zip(*seen))
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()) for k in (*keys, list(seen.values()))], names=["kind", "votes", "shape", "n"])

    rows = mapped(docs.select(docs[text].cast("string")), run, PATTERNS)
    return rows.groupBy("kind", "votes", "shape").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text: str) -> Model:
    """Reliabilities and classifiers from all candidates of ``docs``; at most 4 * 3^6 * 2^9 counts reach the driver."""
    rows = sorted(tuple(r) for r in patterns(docs, text).collect())
    model = Model([None] * len(KINDS), [None] * len(KINDS))
    for kind in range(len(KINDS)):
        own = np.array([r[1:] for r in rows if r[0] == kind], np.int64).reshape(-1, 3)
        if len(own):
            pattern, cue = _votes(own[:, 0])[:, [0, LABELERS.index("cue")]].T
            known = np.select([pattern == YES, (pattern == NO) | (cue == NO)], [1.0, 0.0], np.nan)
            belief, model.reliability[kind] = estimate(own[:, 0], own[:, 2], known)
            model.weights[kind] = classifier(own[:, 1], belief, own[:, 2].astype(float))
    return model


def added(text: str, model: Model, least: float = 0.5) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the loose forms that the classifier takes and no base span crosses."""
    every = candidates(text)
    taken = _Taken((start, end) for _, start, end, vote in every if vote == YES)
    rated = []
    for kind, start, end, vote in every:
        if not vote:
            chance = model.chance(kind, features(text, kind, start, end, vote)[1])
            if chance >= least:
                rated.append((-chance, start, kind, end))
    out = []
    for _, start, kind, end in sorted(rated):
        if not taken.crosses(start, end):
            taken.add(start, end)
            out.append((start, kind, end))
    return out


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


FOUND = tuple(f"n_{k}" for k in KINDS) + ("n_added", "base", "spans")


def find(docs: DataFrame, carry: list[str], text: str, model: Model) -> DataFrame:
    """``carry`` columns of every row, base spans by kind, spans added, and both lists as ``kind:start:end`` in code points."""
    n = len(carry)
    fields = [T.StructField(f, T.StringType() if f in ("base", "spans") else T.LongType()) for f in FOUND]
    schema = T.StructType([*docs.select(*columns(carry)).schema.fields, *fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, n):
            out = []
            for value in part.column(n).to_pylist():
                firm = base(value or "")
                more = added(value, model) if value else []
                kinds = Counter(kind for _, kind, _ in firm)
                out.append((*(kinds[k] for k in range(len(KINDS))), len(more), _joined(firm), _joined(firm + more)))
            made = [pa.array(c, pa.string() if f in ("base", "spans") else pa.int64()) for f, c in zip(FOUND, zip(*out))]
            yield pa.RecordBatch.from_arrays([*part.columns[:n], *made], names=[*carry, *FOUND])

    return mapped(docs.select(*columns(carry), docs[text].cast("string")), run, schema)
