"""SentencePiece ids of whole texts, from a table of distinct marked words.

The library writes a text with a mark in front and a mark for each blank.  Where no piece of the model has a mark
after another character, no merge can cross the place between a character and the mark behind it.  So a text falls
into marked words, one or more marks and what follows them, whose ids do not depend on their neighbours.

Method.  Texts are cut into marked words where they are read.  About ``BLOCK_WORDS`` words of whole texts make a block,
whose distinct words are shuffled in ``BUCKETS`` parts by their hash.  So each different word of the corpus is
segmented in one place, once, by the library, and its ids go back to the blocks that have it.  A word in every
text comes once per block, and nothing is broadcast, however many words there are.  The block itself, shuffled
once to meet them, has only the places of its words in their order, common words first, so that places are small numbers.

The texts are read twice, for words and for places; nothing but words, ids and places is moved or stored.  Both readings must
give the same blocks, as those of stored tables do.  A block's hash is part of the key, and a block that does not
meet its own words is an error, never a wrong result; a table that is not the same when read again has to be written first.

``separable`` says whether a model is of that kind (no such piece, blanks kept, no other normalisation, bytes for
unknown characters); for other models the distinct whole texts take the place of the words, by the same plan.

Null and empty texts have no ids and decode to the empty text.  Each row gives a row, repeated ones too; null ids
are kept.  A text of any length is in one block, which then has more words than others.  An empty table gives no rows.
Other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import text_of

MARK = "▁"
BLOCK_WORDS = 3 << 20  # words of a block, about
BUCKETS = 4096  # parts of a block's distinct words
_SLICE = 1 << 22  # bytes of text cut into words at a time
_WORDS = 1 << 18  # words of texts put together at a time
_HELD = 1 << 20  # words of a bucket whose ids are kept at a time; beyond, words are looked up again
_KEY = "block bigint, hash bigint"
_FOUND = "array<struct<bucket: int, lengths: binary, pieces: binary>>"


@lru_cache(maxsize=4)
def processor(path: str) -> sentencepiece.SentencePieceProcessor:
    """The model at a path that every executor can read, loaded once per worker."""
    return sentencepiece.SentencePieceProcessor(model_file=path)


def _fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            size = varint() if size is None else size
            yield key >> 3, message[at : at + size]
            at += size


def separable(path: str) -> bool:
    """Whether the ids of a text are those of its marked words."""
    model = processor(path)
    # The numbers of the normaliser in the model, and of its table of characters, mark in front,
    # removal of blanks and marks for blanks in it.
    normaliser = dict(_fields(dict(_fields(model.serialized_model_proto())).get(3, b"")))
    plain = not normaliser.get(2) and normaliser.get(3, 1) and not normaliser.get(4, 1) and normaliser.get(5, 1)
    pieces = range(model.get_piece_size())
    crossing = any(MARK in model.id_to_piece(i).lstrip(MARK) for i in pieces)
    return bool(plain) and not crossing and sum(map(model.is_byte, pieces)) == 256


def marked_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The marked words of texts one after another, and how many each text has.

    A word comes without its first mark, its other marks as blanks.
    """
    # between blanks; an empty part is a mark that belongs to the word behind it, or to the end of the text
    parts = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
    flat, bounds = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
    closes = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    closes[bounds[1:] - 1] = True
    blank = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.flatnonzero(closes)
    before = np.diff(ends, prepend=-1) - 1
    closed = np.concatenate([[0], np.cumsum(closes)])[bounds]
    words = flat.take(pa.array(ends))
    if before.any():
        words = pc.binary_join_element_wise(pc.binary_repeat(" ", pa.array(before)), words, "")
    counts = np.diff(closed)
    if blank.any():  # an empty text has not even a mark
        words = words.filter(pa.array(np.repeat(~blank, counts)))
        counts[blank] = 0
    return words, counts


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as bytes, those of the same weight together: the upper ones are mostly zero and compress."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _text_of(words: pa.Array) -> tuple[bytes, np.ndarray]:
    """The bytes of words one after another, and where they begin and end."""
    ends = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    return (data.to_pybytes()[ends[0] : ends[-1]] if data else b""), ends - ends[0]


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """IDs and texts in slices of about ``size`` bytes, whole texts."""
    for batch in batches:
        ids, texts = batch.column("id"), batch.column("text")
        ends, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)), 0
        while start < len(ids):
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield ids.slice(start, stop - start), texts.slice(start, stop - start)
            start = stop


def _blocks_of(block_words: int, marked: bool, places: bool):
    """Rows ``id, text`` to the blocks' words by bucket, or to their places."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array]]:
        """IDs, words per text and coded words of consecutive slices with at least ``block_words`` words."""
        ids, counts, words, room = [], [], [], block_words
        for some, texts in _slices(batches, min(_SLICE, 8 * block_words)):
            cut, n = marked_words(texts) if marked else (texts, np.ones(len(texts), dtype=np.int64))
            ids, counts, words, room = [*ids, some], [*counts, n], [*words, cut.dictionary_encode()], room - len(cut)
            if room <= 0:
                yield pa.concat_arrays(ids), np.concatenate(counts), pa.chunked_array(words).unify_dictionaries().combine_chunks()
                ids, counts, words, room = [], [], [], block_words
        if ids:
            yield pa.concat_arrays(ids), np.concatenate(counts), pa.chunked_array(words).unify_dictionaries().combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for ids, counts, coded in gathered(batches):
            coded = coded if isinstance(coded, pa.Array) else coded.chunk(0)
            code = coded.indices.to_numpy(zero_copy_only=False)
            by_use = np.argsort(-np.bincount(code, minlength=len(coded.dictionary)), kind="stable")
            place = np.empty(len(by_use), dtype=np.uint32)
            place[by_use] = np.arange(len(by_use))
            at = place[code]
            words = coded.dictionary.take(pa.array(by_use))
            data, ends = _text_of(words)
            key = (block, xxhash.xxh64(data, seed=xxhash.xxh32_intdigest(at.tobytes())).intdigest() - (1 << 63))
            bucket = np.fromiter((zlib.crc32(data[a:b]) % BUCKETS for a, b in zip(ends.tolist(), ends[1:].tolist())), dtype=np.uint16, count=len(words))
            if places:
                yield _batch({"block": [key[0]], "hash": [key[1]], "ids": _one_list(ids), "sizes": [_planes(counts)], "at": [_planes(at)], "buckets": [bucket.tobytes()]})
            else:
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
                data, ends = _text_of(words.take(pa.array(order)))
                for part in range(0, len(edges) - 1, 512):
                    spans = list(zip(edges[part : part + 512].tolist(), edges[part + 1 : part + 513].tolist()))
                    yield _batch({
                        "block": [key[0]] * len(spans), "hash": [key[1]] * len(spans), "bucket": bucket[order[[a for a, _ in spans]]].astype(np.int32),
                        "lengths": [_planes(np.diff(ends[a : b + 1])) for a, b in spans], "words": [data[ends[a] : ends[b]] for a, b in spans],
                    })
            block += 1

    return run


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _segmenter(path: str, marked: bool):
    """The words of blocks, in order of buckets, to their ids; the library is asked once for each word of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = processor(path)
        known: dict[str, list[int]] = {}
        # the library puts the first mark there itself, but not into an empty text
        lone = {"": model.encode("a ")[len(model.encode("a")) :] if marked else []}
        current = None
        for batch in batches:
            lengths, pieces = [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("bucket", "lengths", "words")))
            for bucket, sizes, data in rows:
                if bucket != current or len(known) > _HELD:
                    current, known = bucket, dict(lone)
                ends = np.concatenate([[0], np.cumsum(_numbers(sizes), dtype=np.int64)]).astype(np.int32)
                words = pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)]).to_pylist()
                new = [w for w in words if w not in known]
                known.update(zip(new, model.encode(new, num_threads=1)))
                found = [known[w] for w in words]
                lengths.append(_planes(np.fromiter(map(len, found), dtype=np.int64, count=len(found))))
                pieces.append(_planes(np.fromiter(chain.from_iterable(found), dtype=np.int64)))
            kept = {c: batch.column(c) for c in ("block", "hash", "bucket")}
            yield _batch(kept | {"lengths": pa.array(lengths, pa.binary()), "pieces": pa.array(pieces, pa.binary())})

    return run


def _ordered(path: str, decoded: bool):
    """Blocks beside the ids of their words, ``ids, sizes, at, buckets, found``, to rows of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from texts(batch.slice(row, 1))

    def texts(block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        at, sizes = (_numbers(block.column(c)[0].as_py()) for c in ("at", "sizes"))
        bucket = np.frombuffer(block.column("buckets")[0].as_py(), dtype=np.uint16)
        found = sorted(block.column("found")[0].as_py(), key=lambda f: f["bucket"])
        # in order of buckets, and in one of places
        none = np.zeros(0, dtype=np.uint32)
        length = np.concatenate([none, *(_numbers(f["lengths"]) for f in found)]).astype(np.int64)
        pieces = np.concatenate([none, *(_numbers(f["pieces"]) for f in found)]).astype(np.int32)
        word = np.argsort(bucket, kind="stable")
        first, many = np.zeros((2, len(word)), dtype=np.int64)
        first[word], many[word] = np.cumsum(length) - length, length
        bounds, ids, start = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), block.column("ids").flatten(), 0
        while start < len(ids):  # some texts at a time
            stop = max(start + 1, int(np.searchsorted(bounds[1:], bounds[start] + _WORDS, side="right")))
            part = at[bounds[start] : bounds[stop]]
            n = many[part]
            ends = np.concatenate([[0], np.cumsum(n)])
            source = np.repeat(first[part] - ends[:-1], n) + np.arange(ends[-1])
            edges = ends[bounds[start : stop + 1] - bounds[start]].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(pieces[source]))
            columns = {"id": ids.slice(start, stop - start), "ids": lists}
            if decoded:
                columns["decoded"] = pa.array([processor(path).decode(x) for x in lists.to_pylist()], pa.string())
            yield pa.RecordBatch.from_pydict(columns)
            start = stop

    return run


def encode(docs: DataFrame, model_path: str, id: str = "doc_id", text: str = "text", decoded: bool = False,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """``id, ids``: the ids of every row's whole text, as the library's ``encode`` gives them; with ``decoded``, their text again."""
    marked = separable(model_path)
    rows = docs.select(F.col(id).alias("id"), text_of(text).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    words = rows.mapInArrow(_blocks_of(block_words, marked, places=False), f"{_KEY}, bucket int, lengths binary, words binary")
    by_bucket = words.repartition("bucket").sortWithinPartitions("bucket")
    pieces = by_bucket.mapInArrow(_segmenter(model_path, marked), f"{_KEY}, bucket int, lengths binary, pieces binary")
    found = pieces.groupBy("block", "hash").agg(F.collect_list(F.struct("bucket", "lengths", "pieces")).alias("found"))
    blocks = rows.mapInArrow(
        _blocks_of(block_words, marked, places=True), f"{_KEY}, ids array<{id_type}>, sizes binary, at binary, buckets binary"
    )
    # only a block without any word has none to meet
    met = F.when(F.col("found").isNotNull(), F.col("found")).when(F.length("at") == 0, F.array().cast(_FOUND)).otherwise(
        F.raise_error(F.lit("the table was not the same when read again; write it first")).cast(_FOUND)
    )
    whole = blocks.join(found, ["block", "hash"], "left").select("ids", "sizes", "at", "buckets", met.alias("found"))
    return whole.mapInArrow(_ordered(model_path, decoded), f"id {id_type}, ids array<int>" + ", decoded string" * decoded)


def decode(ids: Column, model_path: str) -> Column:
    """The text of ids, as the library's ``decode`` gives it."""

    def batch(lists: pd.Series) -> pd.Series:
        model = processor(model_path)
        return pd.Series([model.decode(x.tolist()) for x in lists], dtype=object)

    return F.pandas_udf(batch, "string")(ids)
