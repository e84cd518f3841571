"""Personal data: exact patterns, and a character-level BiLSTM with a CRF on top.

The patterns give the base spans (kinds ``email``, ``ip``, ``card``, ``phone``).
The labeller adds spans that no pattern has.  It reads every stretch of the
text around a digit or ``@``: all four kinds have one, so nothing else can hold
a span.  A stretch is cut into overlapping windows; each character's scores come
from the window that has most context around it, and one Viterbi path over the
whole stretch reconciles them.  An added span must not touch a base span; base
spans always stay.

The labeller is trained in numpy on spans of a bounded sample of documents
(``TRAIN_DOCS``) and on made numbers put into their words.  All positions are code
points, ends exclusive.  Null and empty texts have no spans.  Rows are treated
by themselves, so repeated rows get equal spans; extra columns pass through;
an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm import lstm
from lexigrid.llm.common import sampled, text_of, whole_row

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 400  # documents whose spans and words are learned from
HIDDEN = 20
WINDOW, STRIDE, MARGIN = 96, 64, 16
_BATCH = 512  # windows labelled at once

Span = tuple[str, int, int]

# The end of a local part and the domain; what precedes the @ is found from there, so that long words cost nothing.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by start, then kind."""
    found = [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(int(x) <= 255 for x in m[0].split(".") if len(x) < 20) and all(len(x.lstrip("0")) <= 3 for x in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(ch.isdigit() for ch in m[0]) <= 15:
            found.append(("phone", m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text around digits and ``@``, disjoint."""
    found: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        low, high = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if found and low <= found[-1][1]:
            found[-1][1] = high
        else:
            found.append([low, high])
    return [(a, b) for a, b in found]


_GROUPS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", " ", "\n\t\r", ".", "@", "+", "-", "(", ")", ",;:", "/", "_%", "=\"'", "#*$&|<>!?")
_FEATURES = len(_GROUPS) + 2  # and one for all others, one for the edge of a word


def features(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    x = np.zeros((len(codes), _FEATURES), dtype=np.float32)
    x[np.arange(len(codes)), _TABLE[np.minimum(codes, 128)]] = 1.0
    return x


_TABLE = np.full(129, len(_GROUPS), dtype=np.int64)
for _i, _g in enumerate(_GROUPS):
    for _ch in _g:
        _TABLE[ord(_ch)] = _i

_TAGS = 1 + 2 * len(KINDS)  # outside; of each kind its first character and its others
_ALLOWED = np.array([[not (b and b % 2 == 0 and a not in (b - 1, b)) for b in range(_TAGS)] for a in range(_TAGS)])


def tags_of(spans: list[Span], low: int, high: int) -> np.ndarray:
    tags = np.zeros(high - low, dtype=np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        for i in range(max(a, low), min(b, high)):
            tags[i - low] = k if i == a else k + 1
    return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def crf_gradient(scores: np.ndarray, lengths: np.ndarray, tags: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log-likelihood by forward and backward sums, for the scores and the transitions."""
    batch, steps, n = scores.shape
    ahead, back = np.empty((steps, batch, n)), np.zeros((steps, batch, n))
    ahead[0] = scores[:, 0]
    for t in range(1, steps):
        ahead[t] = scores[:, t] + _logsum(ahead[t - 1][:, :, None] + trans, 1)
    for t in range(steps - 2, -1, -1):
        step = _logsum(trans[None] + (scores[:, t + 1] + back[t + 1])[:, None, :], 2)
        back[t] = np.where((t < lengths - 1)[:, None], step, 0.0)
    z = _logsum(ahead[lengths - 1, np.arange(batch)], 1)
    real = np.arange(steps)[None, :] < lengths[:, None]
    marginal = np.exp(ahead + back - z[None, :, None]).transpose(1, 0, 2) * real[:, :, None]
    d_scores = marginal - np.eye(n)[tags] * real[:, :, None]
    d_trans = np.zeros_like(trans)
    for t in range(1, steps):
        pair = np.exp(ahead[t - 1][:, :, None] + trans + (scores[:, t] + back[t])[:, None, :] - z[:, None, None])
        d_trans += (pair * real[:, t, None, None]).sum(axis=0)
        np.subtract.at(d_trans, (tags[real[:, t], t - 1], tags[real[:, t], t]), 1.0)
    return (d_scores / batch).astype(np.float32), d_trans / batch


def viterbi(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best path of tags over one stretch."""
    allowed = np.where(_ALLOWED, trans, -1e4)
    best = scores[0] + np.where(np.arange(_TAGS) % 2 == 0, np.where(np.arange(_TAGS) == 0, 0, -1e4), 0)
    back = np.zeros((len(scores), _TAGS), dtype=np.int64)
    for t in range(1, len(scores)):
        step = best[:, None] + allowed
        back[t] = step.argmax(axis=0)
        best = step.max(axis=0) + scores[t]
    path = [int(best.argmax())]
    for t in range(len(scores) - 1, 0, -1):
        path.append(int(back[t, path[-1]]))
    return np.array(path[::-1])


def windows(length: int) -> list[int]:
    """Starts of the overlapping windows of a stretch; the last one ends where it ends."""
    return [*range(0, max(1, length - WINDOW), STRIDE), max(0, length - WINDOW)] if length > WINDOW else [0]


def label(parts: list[str], w: dict[str, np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """For each stretch the spans ``kind number, start, end`` of its best path."""
    todo = [(i, s) for i, part in enumerate(parts) for s in windows(len(part))]
    xs = [features(p) for p in parts]
    scores = [np.zeros((len(p), _TAGS), dtype=np.float32) for p in parts]
    context = [np.full(len(p), -1) for p in parts]
    order = sorted(range(len(todo)), key=lambda k: min(WINDOW, len(parts[todo[k][0]])))
    for begin in range(0, len(order), _BATCH):
        now = [todo[k] for k in order[begin : begin + _BATCH]]
        lengths = np.array([min(WINDOW, len(parts[i]) - s) for i, s in now])
        x = np.zeros((len(now), lengths.max(), _FEATURES), dtype=np.float32)
        for k, (i, s) in enumerate(now):
            x[k, : lengths[k]] = xs[i][s : s + lengths[k]]
        out = lstm.forward(x, lengths, w)
        for k, (i, s) in enumerate(now):
            n = lengths[k]
            own = np.minimum(np.arange(n), n - 1 - np.arange(n))  # context inside the window
            better = own > context[i][s : s + n]
            scores[i][s : s + n][better] = out[k, :n][better]
            context[i][s : s + n][better] = own[better]
    found = []
    for part_scores in scores:
        spans, path = [], viterbi(part_scores, w["trans"])
        for t, tag in enumerate(path):
            if tag % 2:
                spans.append([(tag - 1) // 2, t, t + 1])
            elif tag:
                spans[-1][2] = t + 1
        found.append([tuple(s) for s in spans])
    return found


_DIGITS_NEEDED = {"ip": 4, "card": 13, "phone": 9}


def plausible(kind: str, part: str) -> bool:
    """Whether an added span has what its kind can't do without."""
    if kind == "email":
        return part.count("@") == 1 and not part.startswith("@") and not part.endswith("@")
    if kind == "ip" and part.count(".") != 3:
        return False
    return sum(ch.isdigit() for ch in part) >= _DIGITS_NEEDED[kind] and not any(ch.isalpha() for ch in part) and part[-1:].isdigit()


def all_spans(texts: list[str], w: dict[str, np.ndarray]) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and all spans."""
    bases = [base_spans(t) for t in texts]
    places = [(i, a, b) for i, t in enumerate(texts) for a, b in stretches(t)]
    added: list[list[Span]] = [[] for _ in texts]
    for begin in range(0, len(places), 4096):
        now = places[begin : begin + 4096]
        for (i, low, _), spans in zip(now, label([texts[i][a:b] for i, a, b in now], w)):
            for k, a, b in spans:
                span = (KINDS[k], low + a, low + b)
                if plausible(span[0], texts[i][span[1] : span[2]]) and all(span[2] <= x or y <= span[1] for _, x, y in bases[i]):
                    added[i].append(span)
    return [(base, sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))) for base, more in zip(bases, added)]


def _card_number(rng: random.Random) -> str:
    digits = "".join(rng.choice("0123456789") for _ in range(15))
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def _made(rng: random.Random, kind: str) -> str:
    """Something of a kind, not always as its pattern wants it."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    if kind == "email":
        name = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 10)))
        return f"{name}{rng.choice(['', '.', '_', '+'])}{d(rng.randint(0, 3))}x@{rng.choice(['mail', 'example', 'corp', 'post'])}.{rng.choice(['com', 'org', 'net', 'co.uk'])}"
    if kind == "ip":
        return ".".join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == "card":
        n = _card_number(rng)
        sep = rng.choice(["", "", " ", "-"])
        return sep.join(n[i : i + 4] for i in range(0, 16, 4))
    return rng.choice([f"+{rng.randint(1, 99)} ({d(3)}) {d(3)}-{d(4)}", f"+{rng.randint(1, 99)} {d(3)} {d(3)} {d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"+{d(11)}"])


def _other(rng: random.Random) -> str:
    """Numbers that are no personal data."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    hexed = "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([16, 32, 40])))
    return rng.choice([f"{rng.randint(1900, 2030)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}", hexed, f'token = "{hexed}"', d(rng.randint(1, 8)),
                       f"{rng.randint(0, 9)}.{rng.randint(0, 99)}", f"Version {rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)}", f"{d(2)}:{d(2)}", f"${d(3)},{d(3)}", f"@{hexed[:6]}", d(rng.randint(22, 30)), f"AKIA{hexed[:16].upper()}"])


def train(texts: list[str], seed: int = 9, made: int = 2400, epochs: int = 5) -> dict[str, np.ndarray]:
    """Weights of the labeller and its transitions."""
    rng, draw = np.random.default_rng(seed), random.Random(seed)
    cases: list[tuple[str, np.ndarray]] = []
    for text in texts:
        spans = base_spans(text)
        for low, high in stretches(text):
            if high - low <= WINDOW and any(low <= a and b <= high for _, a, b in spans):
                cases.append((text[low:high], tags_of(spans, low, high)))
    cases = draw.sample(cases, min(len(cases), made // 3))
    vocabulary = [x for t in texts for x in t.split() if not _TRIGGER.search(x)] or ["word", "and"]
    while len(cases) < made:
        kind = draw.choice([*KINDS, None])
        inside = _made(draw, kind) if kind else _other(draw)
        left, right = (" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 4))) for _ in range(2))
        left, right = (left + draw.choice([" ", "\n", ": ", ""]))[-30:] if left else "", (draw.choice([" ", "\n", ". ", ", "]) + right)[:30]
        whole = (left + inside + right)[:WINDOW]
        spans = [(kind, len(left), len(left) + len(inside))] if kind else []
        cases.append((whole, tags_of(spans, 0, len(whole))))
    w = lstm.initial(_FEATURES, HIDDEN, _TAGS, rng)
    w["trans"] = np.zeros((_TAGS, _TAGS), dtype=np.float32)
    adam, size = lstm.Adam(w, 0.02), 48
    for epoch in range(epochs):
        adam.rate = 0.02 / (1 + epoch)
        order = rng.permutation(len(cases))
        for start in range(0, len(order), size):
            batch = [cases[i] for i in order[start : start + size]]
            lengths = np.array([len(t) for t, _ in batch])
            x = np.zeros((len(batch), lengths.max(), _FEATURES), dtype=np.float32)
            y = np.zeros((len(batch), lengths.max()), dtype=np.int64)
            for k, (t, tags) in enumerate(batch):
                x[k, : len(t)], y[k, : len(t)] = features(t), tags
            scores, kept = lstm.forward(x, lengths, w, keep=True)
            d_scores, d_trans = crf_gradient(scores, lengths, y, w["trans"])
            adam.step(w, lstm.gradients(x, lengths, d_scores, kept, w) | {"trans": d_trans.astype(np.float32)})
    return w


def sample_texts(docs: DataFrame, text: str = "text") -> list[str]:
    """At most ``TRAIN_DOCS`` whole texts with a digit or ``@``, chosen by their hash."""
    return sampled(docs.select(text_of(text).alias("text")).where(F.col("text").rlike("[0-9@]")), TRAIN_DOCS)


def spans_column(w, text: Column) -> Column:
    """Base spans and all spans as arrays of ``kind, start, end``; ``w`` is a broadcast variable."""

    def batch(texts: pd.Series) -> pd.DataFrame:
        base, every = [], []
        for start in range(0, len(texts), 256):
            for b, a in all_spans(texts.iloc[start : start + 256].tolist(), w.value):
                base.append([{"kind": k, "start": x, "end": y} for k, x, y in b])
                every.append([{"kind": k, "start": x, "end": y} for k, x, y in a])
        return pd.DataFrame({"base": base, "every": every})

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return F.pandas_udf(batch, f"base {span}, every {span}")(text)


def find(docs: DataFrame, text: str = "text", weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The rows as struct ``row`` with ``base`` and ``every``: spans of the patterns, and those with the labeller's."""
    weights = train(sample_texts(docs, text)) if weights is None else weights
    shared = docs.sparkSession.sparkContext.broadcast(weights)
    found = docs.select(whole_row(docs), spans_column(shared, text_of(text)).alias("found"))
    return found.select("row", "found.base", "found.every")
