"""Main text of web pages: a recurrent labeller of blocks.

A page becomes the sequence of its leaf blocks, each with its tag path and its
words.  A bidirectional LSTM, in numpy, reads the hashed path and words of all
blocks and labels every one with the whole page as context; main blocks are
joined.  It is trained on pages composed from the text of a bounded sample of
the given ones (``TRAIN_PAGES``) in many layouts, whose labels are thus known.

Character references are decoded; white space in a block becomes one blank.
Null, empty and tagless HTML are allowed: without a block the text is empty.
Each row is labelled by itself, so repeated rows, null IDs and extra columns
change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm import lstm
from lexigrid.llm.common import sampled, text_of, whole_row

TRAIN_PAGES = 300  # pages of the table whose text the training pages are made of
MADE_PAGES = 700  # training pages
HIDDEN = 16
_PATH, _WORDS, _NUMBERS = 96, 24, 6
_CELLS = 60_000  # blocks with padding that are labelled at once

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_RAW = ("script", "style", "iframe", "head", "textarea")
_ENDED_BY_BLOCKS = ("svg", "select")  # an open one ends where a block begins
_INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset("p ul ol table h1 h2 h3 h4 h5 h6 div section article footer header aside nav form".split())
_CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SPACES = re.compile(r"\s+")


def blocks(page: str | None) -> list[tuple[tuple[str, ...], str, float]]:
    """``path, text, share of its text inside links`` of each leaf block with text, in page order."""
    page = page or ""
    found, stack, text, linked, in_link = [], [], [], 0, 0
    pos = 0

    def flush() -> None:
        nonlocal linked
        joined = _SPACES.sub(" ", html_lib.unescape("".join(text))).strip()
        if joined:
            found.append((tuple(stack), joined, min(1.0, linked / len(joined))))
        text.clear()
        linked = 0

    while True:
        token = _TOKEN.search(page, pos)
        part = page[pos : token.start() if token else len(page)]
        if part:
            text.append(part)
            linked += len(part) if in_link else 0
        if token is None:
            break
        pos = token.end()
        closing, name, rest = (token[1], token[2], token[3]) if token[2] else (token[4], token[5], token[6])
        if name is None:
            continue  # a comment or declaration
        name = name.lower()
        if name in _INLINE:
            if name == "a":
                in_link = 0 if closing else 1
            if name in ("br", "img"):
                text.append(" ")
            continue
        flush()
        if name in _RAW and not closing:
            if not rest.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*>", re.I).search(page, pos)
                body = re.compile(r"<body\b", re.I).search(page, pos) if name == "head" and not end else None
                pos = end.end() if end else body.start() if body else pos if name == "head" else len(page)
            continue
        if name in _VOID:
            continue
        if closing:
            if any(x.split(" ", 1)[0] == name for x in stack):
                while stack.pop().split(" ", 1)[0] != name:
                    pass
            continue
        if name in _BLOCKS and stack and stack[-1].split(" ", 1)[0] == "p":
            stack.pop()
        elif name in _BLOCKS and any(x.split(" ", 1)[0] in _ENDED_BY_BLOCKS for x in stack):
            while stack.pop().split(" ", 1)[0] not in _ENDED_BY_BLOCKS:
                pass
        elif name in _CLOSES and stack and stack[-1].split(" ", 1)[0] in _CLOSES[name]:
            stack.pop()
        marks = " ".join(v.strip("\"'").lower() for _, v in _ATTRIBUTE.findall(rest))
        stack.append(f"{name} {marks}" if marks else name)
    flush()
    return found


@lru_cache(maxsize=1 << 14)
def _path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(_PATH, dtype=np.float32)
    for depth, element in enumerate(reversed(path)):
        parts = re.split(r"[\s_\-]+", element)
        for k, part in enumerate(parts):
            v[zlib.crc32(f"{'t' if k == 0 else 'c'}{part}".encode()) % (_PATH - 16)] = 1.0
        if depth == 0:
            v[_PATH - 16 + zlib.crc32(parts[0].encode()) % 16] = 1.0
    return v


@lru_cache(maxsize=1 << 16)
def _word(word: str) -> int:
    return zlib.crc32(word.lower().encode()) % _WORDS


def features(page_blocks: list) -> np.ndarray:
    x = np.zeros((len(page_blocks), _PATH + _WORDS + _NUMBERS), dtype=np.float32)
    for i, (path, text, linked) in enumerate(page_blocks):
        words = text.split()
        x[i, :_PATH] = _path_vector(path)
        counts = np.bincount([_word(w) for w in words], minlength=_WORDS)
        x[i, _PATH : _PATH + _WORDS] = counts / len(words)
        x[i, _PATH + _WORDS :] = (np.log1p(len(words)) / 5, linked, text.count(".") / len(words), text.count("|") > 0, i / len(page_blocks), text[-1] in ".!?")
    return x


def label(pages: list[list], w: dict[str, np.ndarray]) -> list[np.ndarray]:
    """For each page, which of its blocks are main text."""
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    todo = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
    while todo:
        n, longest = 0, 0
        while n < len(todo) and (n == 0 or (n + 1) * len(pages[todo[n]]) <= _CELLS):
            longest = len(pages[todo[n]])
            n += 1
        now, todo = todo[:n], todo[n:]
        lengths = np.array([len(pages[i]) for i in now])
        x = np.zeros((n, longest, _PATH + _WORDS + _NUMBERS), dtype=np.float32)
        for k, i in enumerate(now):
            x[k, : lengths[k]] = features(pages[i])
        scores = lstm.forward(x, lengths, w)
        for k, i in enumerate(now):
            out[i] = scores[k, : lengths[k], 1] > scores[k, : lengths[k], 0]
    return out


# Names that pages give their parts, for training pages.
_MAIN = ["article", "article", "main", "div", "div", 'div class="content"', 'div class="post-body"', 'div class="entry-content"', 'div id="article"', 'div class="article-body"', 'section class="story"', 'div id="main-content"', 'div role="main"']
_NAVS = ["nav", 'div class="menu"', 'div id="navbar"', 'ul class="nav"', 'div class="breadcrumbs"', 'nav class="site-nav"', 'div class="topbar"']
_ADS = ['div class="ad"', 'div class="advert"', 'div class="ad-banner"', 'div class="sponsored"', 'aside class="promo"', 'div id="ads"', 'section class="advertisement"']
_SIDES = ["aside", 'div class="sidebar"', 'div id="sidebar"', 'aside class="related"', 'div class="widget"', 'section class="related-posts"']
_NOTES = ['div class="cookie"', 'div class="cookie-banner"', 'div id="notice"', 'div class="consent"', 'div class="alert notice"', 'div class="popup"', 'div class="paywall"']
_FORMS = ["form", 'form class="newsletter"', 'div class="subscribe"', 'form id="login"', 'form class="search"']
_TALK = ['div class="comments"', 'section id="comments"', 'ol class="comment-list"', 'div class="comment"', 'section class="responses"', 'div id="disqus"']
_HEADS = ["header", 'div class="header"', 'header class="site-header"', 'div id="masthead"']
_FEET = ["footer", 'div class="footer"', 'footer id="colophon"', 'div id="footer"', 'div class="copyright"']


def made_page(rng: random.Random, texts: list[str]) -> tuple[str, list[bool]]:
    """A page in a random layout, and which of its blocks are main text."""
    out, labels = [], []

    def some() -> str:
        return html_lib.escape(rng.choice(texts), quote=False)

    def short() -> str:
        return " ".join(some().split()[: rng.randint(1, 12)]) or "x"

    def put(inner: str, main: bool) -> None:
        out.append(inner)
        labels.append(main)

    def part(names: list[str], fill) -> None:
        element = rng.choice(names)
        out.append(f"<{element}>")
        fill()
        out.append(f"</{element.split()[0]}>")

    def links() -> None:
        out.append("<ul>")
        for _ in range(rng.randint(1, 8)):
            put(f'<li><a href="/x">{short()}</a></li>', False)
        out.append("</ul>")

    def aside_text() -> None:
        for _ in range(rng.choice([1, 1, 1, 2])):
            wrap = rng.choice(["{}", "<p>{}</p>", "<div>{}</div>", '<a href="/x">{}</a>'])
            put(wrap.format(short() if rng.random() < 0.5 else some()) if "<p>" in wrap or "<div>" in wrap else f"<div>{wrap.format(short() if rng.random() < 0.5 else some())}</div>", False)

    def plain() -> None:
        put(short() if rng.random() < 0.5 else some(), False)

    def form() -> None:
        put(f"<label>{short()}</label><input>", False)
        put(f"<button>{short()}</button>", False)

    def talk() -> None:
        for _ in range(rng.randint(1, 5)):
            out.append(rng.choice(['<div class="comment">', '<li class="comment">', "<div>"]))
            put(f"<p>{some()}</p>", False)
            out.append("</div>" if out[-2].startswith("<div") else "</li>")

    def hidden() -> None:
        kind = rng.choice(["select", "svg", "template", "noscript", "object"])
        inner = {"select": "<option>{}</option>", "svg": "<title>{}</title>"}.get(kind, "<div>{}</div>")
        put(f"<{kind}>{inner.format(short())}</{kind}>", False)

    def table(main: bool) -> None:
        out.append(rng.choice(["<table>", '<table class="data">', "<table><tbody>"]))
        for row in range(rng.randint(1, 5)):
            out.append("<tr>")
            for _ in range(rng.randint(1, 4)):
                cell = "th" if row == 0 and rng.random() < 0.5 else "td"
                put(f"<{cell}>{short() if rng.random() < 0.7 else some()}</{cell}>", main)
            out.append("</tr>")
        out.append("</table>")

    extras = [lambda: part(_ADS, rng.choice([plain, plain, aside_text])), lambda: part(_SIDES, rng.choice([links, aside_text])),
              lambda: part(_NOTES, rng.choice([plain, aside_text])), lambda: part(_FORMS, form)]

    def article() -> None:
        if rng.random() < 0.85:
            put(f"<h1>{short()}</h1>", True)
        for _ in range(rng.randint(1, 14)):
            kind = rng.random()
            if kind < 0.72:
                wrap = rng.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>"])
                put(wrap.format(some() if rng.random() < 0.8 else short()), True)
            elif kind < 0.8:
                put(f"<h2>{short()}</h2>", True)
            elif kind < 0.88:
                out.append("<ul>")
                for _ in range(rng.randint(1, 4)):
                    put(f"<li>{short()}</li>", True)
                out.append("</ul>")
            elif kind < 0.91:
                put(f"<blockquote>{some()}</blockquote>", True)
            elif kind < 0.94:
                table(True)
            elif kind < 0.95:
                put(f"<figure><img src=x><figcaption>{short()}</figcaption></figure>", True)
            elif kind < 0.97:
                # never closed, or closed round a paragraph of the article
                name = rng.choice(["object", "noscript", "template", "svg", "select"])
                put(f"<{name}><p>{some()}</p>" + rng.choice(["", f"</{name}>"]), True)
            elif rng.random() < 0.6:
                rng.choice(extras)()

    out.append("<body>")
    usual = rng.random() < 0.35  # the plainest layout of all
    if not usual and rng.random() < 0.3:
        hidden()
    if usual or rng.random() < 0.7:
        part(["nav"] if usual else _NAVS, links)
    if not usual and rng.random() < 0.5:
        part(_HEADS, rng.choice([plain, links, aside_text]))
    for extra in ([extras[0]] if usual else rng.sample(extras, rng.randint(0, 3))):
        extra()
    part(["article"] if usual else _MAIN, article)
    if not usual:
        for extra in rng.sample(extras, rng.randint(0, 2)):
            extra()
        if rng.random() < 0.1:
            part(_SIDES, lambda: table(False))
        if rng.random() < 0.5:
            part(_TALK, talk)
    if usual or rng.random() < 0.8:
        part(["footer"] if usual else _FEET, rng.choice([plain, aside_text, links]) if not usual else plain)
    return "".join(out), labels


def train(texts: list[str], seed: int = 5, pages: int = MADE_PAGES, epochs: int = 8) -> dict[str, np.ndarray]:
    """Weights of the labeller, from training pages made of ``texts``."""
    rng, draw = np.random.default_rng(seed), random.Random(seed)
    made = []
    for _ in range(pages):
        page, labels = made_page(draw, texts)
        found = blocks(page)
        if len(found) == len(labels):
            made.append((features(found), np.array(labels)))
    w = lstm.initial(_PATH + _WORDS + _NUMBERS, HIDDEN, 2, rng)
    adam, size = lstm.Adam(w, 0.01), 32
    for _ in range(epochs):
        order = rng.permutation(len(made))
        for start in range(0, len(order), size):
            batch = [made[i] for i in order[start : start + size]]
            lengths = np.array([len(y) for _, y in batch])
            x = np.zeros((len(batch), lengths.max(), batch[0][0].shape[1]), dtype=np.float32)
            y = np.zeros((len(batch), lengths.max()), dtype=np.int64)
            for k, (a, b) in enumerate(batch):
                x[k, : len(b)], y[k, : len(b)] = a, b
            scores, kept = lstm.forward(x, lengths, w, keep=True)
            p = np.exp(scores - scores.max(axis=2, keepdims=True))
            p /= p.sum(axis=2, keepdims=True)
            d = p - np.eye(2, dtype=np.float32)[y]
            d *= (np.arange(lengths.max())[None, :] < lengths[:, None])[:, :, None] / lengths.sum()
            adam.step(w, lstm.gradients(x, lengths, d.astype(np.float32), kept, w))
    return w


_WORDLESS = ["A short text for a page that has none.", "Another line of plain words, long enough to be a paragraph of its own."]


def sample_texts(pages: DataFrame, html: str = "html") -> list[str]:
    """Texts of the blocks of at most ``TRAIN_PAGES`` whole pages, chosen by the hash of their HTML."""
    chosen = sampled(pages.select(text_of(html).alias("html")).where("html != ''"), TRAIN_PAGES)
    return sorted({b[1] for page in chosen for b in blocks(page)}) or _WORDLESS


def text_column(w: dict[str, np.ndarray], html: Column) -> Column:
    """The main text as a column."""

    def batch(pages: pd.Series) -> pd.Series:
        out = []
        for start in range(0, len(pages), 256):
            found = [blocks(p) for p in pages.iloc[start : start + 256]]
            out += ["\n".join(b[1] for b, main in zip(f, marks) if main) for f, marks in zip(found, label(found, w))]
        return pd.Series(out, dtype=object)

    return F.pandas_udf(batch, "string")(html)


def extract(pages: DataFrame, html: str = "html", weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """The rows as struct ``row`` with ``text``, their main text."""
    weights = train(sample_texts(pages, html)) if weights is None else weights
    return pages.select(whole_row(pages), text_column(weights, text_of(html)).alias("text"))
