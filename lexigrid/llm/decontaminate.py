"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A first pass over the texts counts the words of the test items.  A second finds where texts share word pairs with
an item, and aligns those passages word by word; the score is the best local alignment over the item's own.

No alignment that reaches ``SCORE`` is lost.  With ``L`` words and matches, mismatches and gaps weighed 4, -2, -3, it
holds at least ``L - 1 - floor(4 L (1 - SCORE) / 3)`` of the item's neighbouring word pairs unchanged (``shared``),
however the copy was edited: a mismatch costs 6 of the item's own score and breaks two pairs, a gap costs 3 and breaks one.
So an item's commonest pairs can be left out: its seeds are its rarest ones, and a text with too few of them has no copy.
What was left out is up to half of ``shared``, so that two seeds or more are asked of items of some length; which
are left out changes the cost alone, not the result.

An alignment counts if its matched words would meet by chance, each as often as in the whole corpus, in at most one in
a hundred documents (``CHANCE``).  It does not follow from how often they do meet, as an item leaked into a third of all
documents must still be found.  For items of eight words or more this hardly ever refuses anything.

Test items are taken in blocks of a bounded number of words, two passes each; so
what is sent to executors is bounded, and no item is left out.  Words are runs
of letters, digits and underscores, lower-cased.

An item of three words is found where all three stand together.  Items of one or two words are too short to tell a
copy from ordinary text: they match texts that consist of just them.  Null and empty texts and items, and items without
a word, match nothing.  Items with equal texts are all reported.  Null and repeated IDs are
allowed; rows with the same ID and text are reported once.  Empty tables give an empty result.
Extra columns don't matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import text_of, without
from lexigrid.session import written

BLOCK_WORDS = 1 << 19  # words of test items that are sent to executors at once
CHUNK_WORDS = 1 << 17  # words of texts that are looked up at once; a longer text is by itself
CHANCE = 0.01  # a copy's words meet by chance in at most this share of documents
SCORE = 0.5
MATCH, MISMATCH, GAP = 4, -2, -3

_WORD = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shared(length: int) -> int:
    """The neighbouring word pairs that an alignment of enough score has in common with an item of so many words."""
    return length - 1 if length < 4 else length - 1 - lost(length)


def lost(length: int) -> int:
    """The most pairs that edits can break, and the most words they can add, before the score is too low."""
    return int(MATCH * length * (1 - SCORE) / 3 + 1e-9)


def _row(above: np.ndarray, same: np.ndarray) -> np.ndarray:
    """A row of the alignment table from the row above it and where the passage has the item's next word."""
    slope = GAP * np.arange(len(above))
    here = np.zeros(len(above), dtype=np.int64)
    here[1:] = np.maximum(above[:-1] + np.where(same, MATCH, MISMATCH), above[1:] + GAP)
    here = np.maximum(here, 0)
    return np.maximum(np.maximum.accumulate(here - slope) + slope, 0)  # gaps in the item, for the whole row at once


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman over word numbers: the best local score and where it ends in the passage."""
    best, end, above = 0, 0, np.zeros(len(passage) + 1, dtype=np.int64)
    for word in item:
        above = _row(above, passage == word)
        if above.max() > best:
            best, end = int(above.max()), int(above.argmax())
    return best, end


def rare_end(item: np.ndarray, passage: np.ndarray, least: float, rare) -> tuple[int, int] | None:
    """Of the alignments whose matched words are ``rare``: the best score of at least ``least``, and where it ends.

    For short items: the whole table is kept.
    """
    rows = [np.zeros(len(passage) + 1, dtype=np.int64)]
    for word in item:
        rows.append(_row(rows[-1], passage == word))
    table = np.stack(rows)
    ends = np.argwhere(table >= least)
    for i, j in ends[np.argsort(-table[tuple(ends.T)], kind="stable")].tolist():
        score, end, found = int(table[i, j]), j, []
        while table[i, j] > 0:
            same = item[i - 1] == passage[j - 1]
            if table[i, j] == table[i - 1, j - 1] + (MATCH if same else MISMATCH):
                found += [item[i - 1]] if same else []
                i, j = i - 1, j - 1
            elif table[i, j] == table[i - 1, j] + GAP:
                i -= 1
            else:
                j -= 1
        if rare(np.array(found, dtype=np.int64)):
            return score, end
    return None


class Items:
    """A block of test items as word numbers, with an index of their seeds once ``weigh`` knows how common words are."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        self.keys = [key for key, _ in rows]
        self.vocabulary: dict[str, int] = {}
        self.items = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws], dtype=np.int64) for _, ws in rows]
        self.base = len(self.vocabulary) + 1

    def numbers(self, text: str | None) -> np.ndarray:
        found = words(text)
        return np.fromiter(map(self.vocabulary.get, found, repeat(-1)), dtype=np.int64, count=len(found))

    def pairs(self, numbers: np.ndarray) -> np.ndarray:
        """A number for each two neighbouring words; -1 where one is no word of the items."""
        a, b = numbers[:-1], numbers[1:]
        return np.where((a >= 0) & (b >= 0), a * self.base + b, -1)

    def weigh(self, counts: np.ndarray, n_words: int, n_docs: int) -> Items:
        """Choose seeds, and say what must be rare; ``counts`` by word number, words and documents of the corpus."""
        with np.errstate(divide="ignore"):
            self.logs = np.log(counts / max(1, n_words))
        self.limit = float(np.log(CHANCE * max(1, n_docs) / max(1, n_words)))
        self.whole: dict[tuple[int, ...], list[int]] = {}
        self.least = np.zeros(len(self.items), dtype=np.int64)
        self.sure = []  # True: all copies are rare; False: none is; None: it depends on the words matched
        seeds, owners = [], []
        for i, item in enumerate(self.items):
            logs = -np.sort(-self.logs[item])
            fewest = len(item) if len(item) < 4 else -int(-SCORE * len(item) // 1)
            self.sure.append(True if logs[:fewest].sum() <= self.limit else None if logs.sum() <= self.limit else False)
            if len(item) < 3:
                self.whole.setdefault(tuple(item.tolist()), []).append(i)
                continue
            codes, needed = self.pairs(item), shared(len(item))
            self.least[i] = (needed + 1) // 2
            rarest = np.argsort(self.logs[item[:-1]] + self.logs[item[1:]], kind="stable")[: len(codes) - needed + self.least[i]]
            mine = np.unique(codes[rarest])
            seeds.append(mine)
            owners.append(np.full(len(mine), i, dtype=np.int64))
        seed, owner = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (seeds, owners))
        order = np.argsort(seed, kind="stable")
        self.index, first, self.many = np.unique(seed[order], return_index=True, return_counts=True)
        self.first, self.owner = first, owner[order]
        return self

    def candidates(self, texts: list[np.ndarray]) -> list[tuple[int, int]]:
        """``text, item`` of those that share enough seeds."""
        if not len(self.index):
            return []
        joined = np.concatenate([part for numbers in texts for part in (numbers, [-1])])
        text = np.repeat(np.arange(len(texts)), [len(numbers) + 1 for numbers in texts])
        codes = self.pairs(joined)
        at = np.nonzero(codes >= 0)[0]
        place = np.minimum(np.searchsorted(self.index, codes[at]), len(self.index) - 1)
        hit = self.index[place] == codes[at]
        at, place = at[hit], place[hit]
        many = self.many[place]
        nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owner = self.owner[np.repeat(self.first[place], many) + nth]
        key, times = np.unique(np.repeat(text[at], many) * len(self.items) + owner, return_counts=True)
        key = key[times >= self.least[key % len(self.items)]]
        return list(zip((key // len(self.items)).tolist(), (key % len(self.items)).tolist()))

    def passages(self, numbers: np.ndarray, i: int) -> Iterator[tuple[int, int]]:
        """The stretches of a text that can hold a copy of an item: all of an alignment lies in one of them."""
        item = self.items[i]
        needed, width = shared(len(item)), len(item) + lost(len(item))
        at = np.nonzero(np.isin(self.pairs(numbers), self.pairs(item)))[0]
        if len(at) < needed:
            return
        begin = at[: len(at) - needed + 1]
        begin = begin[at[needed - 1 :] - begin <= width]
        if not len(begin):
            return
        breaks = np.nonzero(np.diff(begin) > 2 * width)[0]
        for low, high in zip(begin[np.append(0, breaks + 1)], begin[np.append(breaks, len(begin) - 1)]):
            yield max(0, int(low) - width), min(len(numbers), int(high) + width + 2)

    def copies(self, numbers: np.ndarray, i: int) -> tuple[float, int] | None:
        """The best score of an item in a text and the word where it ends, if there is a copy."""
        item, best = self.items[i], None
        if self.sure[i] is False:
            return None
        least = 1 if len(item) < 4 else SCORE
        for low, high in self.passages(numbers, i):
            part = numbers[low:high]
            own = Counter(part.tolist())
            if sum(min(n, own[w]) for w, n in Counter(item.tolist()).items()) < least * len(item):
                continue  # even a perfect alignment of these words would not do
            pieces = [(low, part)] if self.sure[i] else self._pieces(low, part, len(item))
            for start, piece in pieces:
                rare = least * len(item) * MATCH, lambda found: self.logs[found].sum() <= self.limit
                found = align(item, piece) if self.sure[i] else rare_end(item, piece, *rare)
                if found is not None and found[0] >= rare[0] and (best is None or found[0] > best[0] * MATCH * len(item)):
                    best = (found[0] / (MATCH * len(item)), start + found[1])
        return best


    @staticmethod
    def _pieces(low: int, part: np.ndarray, length: int) -> Iterator[tuple[int, np.ndarray]]:
        """A stretch in pieces, each alignment whole in one."""
        width = length + lost(length)
        for start in range(0, len(part), 64 * width):
            yield low + start, part[start : start + 65 * width]


def _chunks(block, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int], list[np.ndarray]]]:
    """A batch of ``id, text_hash, text``, some of its rows, and the word numbers of their texts."""
    items = block.value
    for batch in batches:
        rows, texts, size = [], [], 0
        for row, text in enumerate(batch.column(2)):
            rows.append(row)
            texts.append(items.numbers(text.as_py()))
            size += len(texts[-1])
            if size >= CHUNK_WORDS:
                yield batch, rows, texts
                rows, texts, size = [], [], 0
        if rows:
            yield batch, rows, texts


def _count(block):
    """How often the items' words occur: ``start, counts`` by word number + 1, at 0 all other words, and the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, docs = block.value.base, 0
        counts = np.zeros(base, dtype=np.int64)
        for _, rows, texts in _chunks(block, batches):
            docs += len(rows)
            counts += np.bincount(np.concatenate(texts) + 1, minlength=base)
        for low in range(0, base if docs else 0, 1 << 16):
            columns = [[low], [counts[low : low + (1 << 16)].tolist()], [docs if low == 0 else 0]]
            types = (pa.int64(), pa.list_(pa.int64()), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=["start", "counts", "docs"])

    return run


def _find(block):
    """Batches of ``id, text_hash, text`` to ``id, text_hash, item_id, score, end_word`` of the copies in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value
        for batch, rows, texts in _chunks(block, batches):
            found = [(t, i, items.copies(texts[t], i)) for t, i in items.candidates(texts)]
            out = [(rows[t], items.keys[i], *copy) for t, i, copy in found if copy is not None]
            if items.whole:
                out += [(row, items.keys[i], 1.0, len(text)) for row, text in zip(rows, texts) if len(text) < 3
                        for i in items.whole.get(tuple(text.tolist()), ())]
            if out:
                keep = pa.array([o[0] for o in out], type=pa.int64())
                columns = [batch.column(0).take(keep), batch.column(1).take(keep)]
                columns += [pa.array([o[k] for o in out], type=t) for k, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "item_id", "score", "end_word"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text",
                 item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id, text_hash, item_id, score, end_word``: a row for each document and test item of which it holds a copy."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("bigint").alias("item_id"), text_of(item_text).alias("text")).where("text != ''")
    length = F.size(F.split("text", r"\W+")).cast("bigint") + 1
    total = items.agg(F.sum(length)).collect()[0][0] or 0
    n_blocks = -(-total // BLOCK_WORDS)
    texts = docs.select(F.col(id).alias("id"), F.xxhash64(text_of(text)).alias("text_hash"), text_of(text).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    found = spark.createDataFrame([], f"id {kind}, text_hash bigint, item_id bigint, score double, end_word bigint")
    for k in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).collect()
        split = [(r["item_id"], words(r["text"])) for r in rows]
        block_items = Items([(key, ws) for key, ws in split if ws])
        if not block_items.items:
            continue
        counted = written(texts.mapInArrow(_count(spark.sparkContext.broadcast(block_items)), "start bigint, counts array<bigint>, docs bigint"), "word-counts")
        n_docs = counted.agg(F.sum("docs")).collect()[0][0] or 0
        counts = np.zeros(block_items.base, dtype=np.int64)
        for r in counted.select("start", F.posexplode("counts")).groupBy((F.col("start") + F.col("pos")).alias("word")).agg(F.sum("col").alias("n")).collect():
            counts[r["word"]] = r["n"]
        block = spark.sparkContext.broadcast(block_items.weigh(counts[1:], int(counts.sum()), n_docs))
        copies = texts.mapInArrow(_find(block), found.schema).groupBy("id", "text_hash", "item_id")
        found = found.unionByName(copies.agg(F.max("score").alias("score"), F.max_by("end_word", "score").alias("end_word")))
    return found


def clean(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The documents that hold a copy of no test item, with their own columns."""
    return without(docs, written(contaminated(docs, benchmark, id, text, **names).select("id", "text_hash"), "leaks"), id, text)
