"""The positional inverted index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.functions.analysis import LETTERS, SEPARATORS, STANDARD, UNSPACED, by_site, known_text, site_tokens, stop_lists
from lexigrid.model import Analyzers

# tokens turned into postings at a time, and bytes of text cut into tokens; they bound the memory of a Python worker
_CHUNK_TOKENS = 1_000_000
_CHUNK_BYTES = 4_000_000

_POSTING_ROWS = (
    "site string, version bigint, id bigint, field string, term string, "
    "tf bigint, dl bigint, head boolean, positions array<int>"
)
_POSTING_BLOCKS = (
    "site string, version bigint, field string, term string, "
    "ids array<bigint>, tfs array<int>, dls array<int>, heads array<boolean>, starts array<int>, places array<int>"
)


def term_bucket(term: Column | str, n_buckets: Column | int) -> Column:
    """The storage bucket of a term.  Search computes the same, and reads only those."""
    count = F.lit(n_buckets) if isinstance(n_buckets, int) else n_buckets
    return F.pmod(F.xxhash64(term), count.cast("bigint")).cast("int")


def _token_grouper(chunk_tokens: int, stops: dict[str | None, list[str]] | None = None, packed: bool = False):
    """A ``mapInArrow`` function grouping each document's tokens by term.

    A row has its ``tokens``, or a ``text`` to be cut at ``SEPARATORS``, and where it is ``paired`` into pairs too.
    ``packed`` gives the postings that a chunk's documents have of a term in one row.  The helpers are nested so that
    tasks receive them whole and need not have this package installed.
    """
    separators, letters, unspaced, chunk_bytes = SEPARATORS, LETTERS, UNSPACED, _CHUNK_BYTES
    names = ("site", "version", "id", "field")

    def chunks(batch: pa.RecordBatch, bounds: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
        start = 0
        while start < batch.num_rows:
            last = np.searchsorted(bounds[1:], bounds[start] + most, side="right")
            stop = max(start + 1, int(last))
            yield batch.slice(start, stop - start)
            start = stop

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pc.split_pattern_regex(batch.column("text"), pattern=separators)
        words = found.flatten()
        kept = pc.greater(pc.binary_length(words), 0)  # a text that begins or ends with a separator has an empty piece there
        before = np.r_[0, np.cumsum(kept.to_numpy(zero_copy_only=False))]
        bounds = found.offsets.to_numpy()
        offsets = pa.array(before[bounds - bounds[0]].astype(np.int32))
        columns = {name: batch.column(name) for name in names}
        return pa.RecordBatch.from_pydict(columns | {"tokens": pa.ListArray.from_arrays(offsets, words.filter(kept))})

    def strings(points: np.ndarray, ends: np.ndarray) -> pa.StringArray:
        """Code points as strings, cut behind each of the ``ends``."""
        width = 1 + (points >= 0x80).astype(np.int32) + (points >= 0x800)
        offsets = np.r_[0, np.cumsum(width)][np.r_[0, ends]].astype(np.int32)
        data = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        return pa.StringArray.from_buffers(len(ends), pa.py_buffer(offsets), pa.py_buffer(data))

    def cut_pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds = np.zeros(1 << 16, dtype=np.uint8)  # 0 separates, 1 is of words with blanks between, 2 of others
        for kind, ranges in ((1, letters), (2, unspaced)):
            for low, high in ranges:
                kinds[low : high + 1] = kind
        texts = batch.column("text").to_pylist()
        ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        kind = kinds[points]
        new = np.r_[True, kind[1:] != kind[:-1]][: len(kind)]
        new[ends[ends < len(kind)]] = True  # a text's first character; an empty one has none
        last = np.r_[new[1:], True][: len(kind)]
        alone = (kind == 2) & (~last | new)  # begins a pair or, alone between others, is a term
        at = np.flatnonzero(alone | ((kind == 1) & new))
        is_word = kind[at] == 1

        lettered = kind == 1
        words = strings(points[lettered], np.flatnonzero(last[lettered]) + 1).dictionary_encode()
        pair = np.flatnonzero(alone)
        follows = np.where(last[pair], 0, points[np.minimum(pair + 1, len(points) - 1)])
        keys, nth = np.unique((points[pair].astype(np.int64) << 16) | follows, return_inverse=True)
        halves = np.column_stack([keys >> 16, keys & 0xFFFF]).ravel()
        pairs = strings(halves[halves > 0], np.cumsum(1 + (keys & 0xFFFF > 0)))

        code = np.empty(len(at), dtype=np.int32)
        code[is_word] = words.indices.to_numpy(zero_copy_only=False)
        code[~is_word] = nth + len(words.dictionary)
        coded = pa.DictionaryArray.from_arrays(pa.array(code), pa.concat_arrays([words.dictionary, pairs]))
        offsets = pa.array(np.searchsorted(at, np.r_[0, ends]).astype(np.int32))
        columns = {name: batch.column(name) for name in names}
        return pa.RecordBatch.from_pydict(columns | {"tokens": pa.ListArray.from_arrays(offsets, coded)})

    def tokenised(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if "text" in batch.schema.names:
            known = pc.is_valid(batch.column("text"))
            paired = pc.and_(known, batch.column("paired"))
            for rows, way in ((pc.and_not(known, paired), cut), (paired, cut_pairs)):
                texts = batch.filter(rows)
                size = np.r_[0, np.cumsum(pc.binary_length(texts.column("text")).to_numpy(zero_copy_only=False))]
                for part in chunks(texts, size, chunk_bytes):
                    yield way(part)
            batch = batch.filter(pc.invert(known))
        yield batch

    def stopped(site: pa.Array, row: np.ndarray, code: np.ndarray, words: pa.Array) -> np.ndarray:
        sites = site.dictionary_encode()
        listed = [stops.get(name) or stops.get(None) for name in sites.dictionary.to_pylist()]
        bad = np.zeros((len(listed) + 1, len(words)), dtype=bool)
        for k, names in enumerate(listed):
            if names:
                bad[k] = pc.is_in(words, value_set=pa.array(names, type=words.type)).to_numpy(zero_copy_only=False)
        return bad[sites.indices.fill_null(len(listed)).to_numpy(zero_copy_only=False)[row], code]

    def place(batch: pa.RecordBatch) -> np.ndarray:
        """A number for each row's site, version and field."""
        at = np.zeros(batch.num_rows, dtype=np.int64)
        for name in ("site", "version", "field"):
            encoded = batch.column(name).dictionary_encode(null_encoding="encode")
            at = at * len(encoded.dictionary) + encoded.indices.to_numpy(zero_copy_only=False)
        return at

    def group(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column("tokens")
        lengths = np.diff(lists.offsets.to_numpy())
        row = np.repeat(np.arange(len(lengths)), lengths)
        pos = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        encoded = lists.flatten().dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False)
        if stops:
            kept = ~stopped(batch.column("site"), row, code, encoded.dictionary)
            row, pos, code = row[kept], pos[kept], code[kept]
            lengths = np.bincount(row, minlength=len(lengths))
        start = np.r_[True, row[1:] != row[:-1]][: len(row)]  # of a row's first token that is kept
        lead = pos[start][np.cumsum(start) - 1]

        # tokens come in order of position, and a stable sort keeps that order
        group_of = row * len(encoded.dictionary) + code
        order = np.argsort(group_of, kind="stable")
        row, code, pos, lead, group_of = row[order], code[order], pos[order], lead[order], group_of[order]
        first = np.ones(len(row), dtype=bool)
        first[1:] = group_of[1:] != group_of[:-1]
        begin = np.flatnonzero(first)
        bounds = np.append(begin, len(row)).astype(np.int32)
        owner = pa.array(row[begin])
        keys = {name: batch.column(name).take(owner) for name in names}
        values = {
            "term": encoded.dictionary.take(pa.array(code[begin])),
            "tf": pa.array(np.diff(bounds).astype(np.int64)),
            "dl": pa.array(lengths[row[begin]].astype(np.int64)),
            "head": pa.array(pos[begin] == lead[begin]),
            "positions": pa.ListArray.from_arrays(pa.array(bounds), pa.array(pos.astype(np.int32))),
        }
        made = pa.RecordBatch.from_pydict(keys | values)
        return pack(made, place(batch)[row[begin]] * len(encoded.dictionary) + code[begin]) if packed else made

    def pack(made: pa.RecordBatch, block: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(block, kind="stable")  # documents stay in their order
        made, block = made.take(pa.array(order)), block[order]
        begin = np.flatnonzero(np.r_[True, block[1:] != block[:-1]][: len(block)])
        ends = np.append(begin, len(block)).astype(np.int32)
        positions = made.column("positions")
        bounds = positions.offsets.to_numpy()
        of_block = (bounds - bounds[0])[ends]  # a block's positions, one posting's after the other's
        starts = (bounds[:-1] - bounds[0]) - np.repeat(of_block[:-1], np.diff(ends))

        def lists(values: pa.Array, at: np.ndarray = ends) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), values)

        first = {name: made.column(name).take(pa.array(begin)) for name in ("site", "version", "field", "term")}
        return pa.RecordBatch.from_pydict(first | {
            "ids": lists(made.column("id")),
            "tfs": lists(made.column("tf").cast(pa.int32())),
            "dls": lists(made.column("dl").cast(pa.int32())),
            "heads": lists(made.column("head")),
            "starts": lists(pa.array(starts.astype(np.int32))),
            "places": lists(positions.flatten(), of_block),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in tokenised(batch):
                for part in chunks(rows, rows.column("tokens").offsets.to_numpy(), chunk_tokens):
                    yield group(part)

    return run


def posting_blocks(keywords: DataFrame, analyzer: Analyzers = STANDARD) -> DataFrame:
    """One row per term and chunk of documents, with their postings, without any shuffle; see ``unpacked``.

    A keyword row holds the whole text of one document's field, so all its
    postings are known where the row is read.  Spark cannot see that: the same
    grouping written as ``posexplode`` + ``groupBy`` would shuffle every text
    and sort every token.  Texts of known characters are cut into tokens in Arrow batches, others in the JVM; the grouping is
    done in Arrow batches, which leave out the sites' stop words: ``dl`` counts what is kept, positions count all.
    """
    known, none = known_text("text", analyzer), F.array().cast("array<string>")
    # never null: behind null lists Spark's writer of Arrow batches passes over the whole batch again for each row
    listed = F.when(known.isNull(), F.coalesce(site_tokens("text", analyzer), none)).otherwise(none)
    paired = by_site(analyzer, F.col("site"), lambda a: F.lit(a.pairs))
    rows = keywords.select(
        "site", "version", "id", "field", known.alias("text"), listed.alias("tokens"), F.coalesce(paired, F.lit(False)).alias("paired")
    )
    kept = F.col("text").isNotNull() | (F.size("tokens") > 0)
    return rows.where(kept).mapInArrow(_token_grouper(_CHUNK_TOKENS, stop_lists(analyzer), packed=True), _POSTING_BLOCKS)


def unpacked(blocks: DataFrame) -> DataFrame:
    """The postings of blocks, one in a row; further columns stay."""
    arrays = ("ids", "tfs", "dls", "heads", "starts", "places")
    keep = [c for c in blocks.columns if c not in arrays]

    def nth(name):
        return F.get(name, F.col("_nth"))

    return blocks.select(*keep, *arrays, F.posexplode("ids").alias("_nth", "id")).select(
        *keep, "id", nth("tfs").cast("bigint").alias("tf"), nth("dls").cast("bigint").alias("dl"), nth("heads").alias("head"),
        F.slice("places", nth("starts") + 1, nth("tfs")).alias("positions"),
    )


def posting_rows(keywords: DataFrame, analyzer: Analyzers = STANDARD) -> DataFrame:
    """One row per (document, field, term), without any shuffle."""
    return unpacked(posting_blocks(keywords, analyzer)).select("site", "version", "id", "field", "term", "tf", "dl", "head", "positions")


def postings(keywords: DataFrame, n_buckets: int = 1, analyzer: Analyzers = STANDARD) -> DataFrame:
    """Posting rows with their storage bucket."""
    return posting_rows(keywords, analyzer).withColumn("bucket", term_bucket("term", n_buckets))


def term_stats(posting_table: DataFrame) -> DataFrame:
    """Document frequency of each term, per site, version and field."""
    return posting_table.groupBy("site", "version", "bucket", "field", "term").agg(
        F.count(F.lit(1)).alias("df")
    )


def field_stats(posting_table: DataFrame) -> DataFrame:
    """Documents with a token, and their tokens, per site, version and field."""
    return (
        posting_table.where("head")
        .groupBy("site", "version", "field")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("dl").alias("sum_dl"))
    )


def doc_lengths(posting_table: DataFrame) -> DataFrame:
    """Tokens of each document's field."""
    return posting_table.where("head").select("site", "version", "field", "id", "dl")
