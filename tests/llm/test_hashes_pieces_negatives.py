"""Merkle manifest, SentencePiece ids and hard negatives against brute force, the library and the SQL; odd rows."""

import collections
import hashlib
import math
import random
import uuid

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from check import connect, difference
from lexigrid.llm import merkle, negatives, pieces
from lexigrid.llm.oracles import ORACLES
from lexigrid.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, pos int, path string, tree string, block int"


def table(spark, rows):
    """Rows of ``doc_id, text, lang, source, n_chars``, with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "node", 1, "path", "tree", 2) for r in rows], SCHEMA)


def collected(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("key", ["op12_hard_negatives", "op13_merkle"])
def test_queries_like_their_sql(spark, key):
    sf_dir = "/root/testdata/sf0.001"
    con = connect(sf_dir)
    assert difference(QUERIES[key](spark, sf_dir).toPandas(), con.execute(ORACLES[key]).df()) is None


def test_mixing_like_its_sql_with_a_tiny_source(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(1, 400), "en", rng.choice("abc"), 1) for i in range(1500)]
    rows += [(2000, "one two three four", "en", "tiny", 1), (2001, "five six seven eight", "en", "tiny", 1), (2002, None, "en", None, 1)]
    # the other tables are not read
    table(spark, rows).select("doc_id", "text", "lang", "source", "n_chars").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(QUERIES["op8_mixing"](spark, str(tmp_path)).toPandas(), con.execute(ORACLES["op8_mixing"]).df()) is None


# Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(i, text, lang, source, n):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def levels(nodes, arity):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h(*last[k : k + arity]) for k in range(0, len(last), arity)])
    return found


def siblings(found, i, arity):
    path = []
    for level in found[:-1]:
        run = i // arity * arity
        path.append(("".join(level[run:i]), "".join(level[i + 1 : run + arity])))
        i //= arity
    return path


def brute_manifest(rows, arity=2):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g])], arity) for g in order}
    top = levels([trees[g][-1][0] for g in order], arity)
    out = []
    for at, g in enumerate(order):
        for i, (given, number, node) in enumerate(sorted(groups[g])):
            path = siblings(trees[g], i, arity) + siblings(top, at, arity)
            out.append((number if given else None, g, node, trees[g][-1][0], top[-1][0], path))
    return out


def key_of(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    rows = [(i, f"text {i}", "en", "a", i) for i in range(-40, 90)]
    rows += [(7, "text 7", "en", "a", 7)] * 3  # the same row again
    rows += [(5, "other", "en", "a", 1), (None, "no id", "en", "a", 1), (None, None, None, None, None), (None, "", "de", None, 0)]
    rows += [(1, "é\U0001f600\u0000", "", "b", None), (2, "x" * 300_000, "fr", "c", 3), (3, "one", "Zz", "", 3), (4, "1:a", "=", "-", 3)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("arity, block", [(2, 4), (2, 256), (3, 9), (16, 256)])
def test_manifest_like_brute_force(spark, odd_rows, monkeypatch, arity, block):
    monkeypatch.setattr(merkle, "BLOCK", block)
    found = merkle.manifest(table(spark, odd_rows), arity=arity)
    got = [(r["id"], r["group"], r["leaf"], r["subroot"], r["root"], [tuple(s) for s in r["path"]]) for r in found.collect()]
    assert key_of(got) == key_of(brute_manifest(odd_rows, arity))


def test_proofs_lead_to_the_root_unless_a_row_changed(spark, odd_rows):
    claim = F.when(F.col("doc_id") == 5, merkle.leaf_of(F.lit("forged")))
    found = merkle.manifest(table(spark, odd_rows), carried={"claim": claim})
    ok = merkle.folded(F.coalesce("claim", "leaf"), F.col("path")) == F.col("root")
    rows = collected(found.select("id", ok, merkle.proof_of(F.col("path")), "path"))
    assert len(rows) == len(odd_rows) and all(good == (i != 5) for i, good, *_ in rows)
    assert all(proof == h(*[a + b for a, b in path]) for *_, proof, path in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_small_trees(spark, n):
    rows = [(i, "t", "en", "s", 1) for i in range(n)]
    got = merkle.manifest(table(spark, rows))
    want = brute_manifest(rows)
    assert key_of([(r["id"], r["root"], [tuple(s) for s in r["path"]]) for r in got.collect()]) == key_of([(w[0], w[4], w[5]) for w in want])


def test_manifest_of_an_empty_table(spark):
    empty = table(spark, [(1, "x", "a", "b", 1)]).where("doc_id = 2")
    assert merkle.manifest(empty).collect() == []


def test_sql_crc32_and_hash_agree_with_spark(spark):
    import zlib

    crc = ORACLES["op13_merkle"].split("coalesce(xor(")[1].split(" % 7")[0]
    rows = duckdb.sql(f"SELECT doc_id, xor({crc} FROM (SELECT unnest([0, 7, -12, 123456789012]) AS doc_id)").fetchall()
    assert all(c == zlib.crc32(str(i).encode()) for i, c in rows)


# SentencePiece

TEXTS = ["", None, " ", "  ", "a", " a", "a ", "a  b", "  two  words  ", "▁", "a▁b", "▁ ▁x", "line\none\ttab\r\n", "é \U0001f600 ﬁ 日本語 テスト", "\u0000 nul \u0000",
         "word " * 500, "x" * 20_000, " " * 40, "ab" * 3_000 + "  " + "c" * 5, "<s> </s> <unk> <0x41>", "tail　wide", "a b", "٣٤ и ещё", "� ﻿"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    made = ["".join(rng.choice("ab  ▁é日\n.,X") for _ in range(rng.randint(0, 60))) for _ in range(150)]
    return TEXTS + made + ["a  b", "", None]


@pytest.mark.parametrize("block_words, marked", [(1 << 20, True), (40, True), (7, True), (7, False)])
def test_ids_like_the_library(spark, texts, monkeypatch, block_words, marked):
    assert pieces.separable(MODEL)
    monkeypatch.setattr(pieces, "separable", lambda path: marked)
    docs = table(spark, [(i // 2, t, "en", "s", 1) for i, t in enumerate(texts)]).repartition(3)  # ids twice each
    found = pieces.encode(docs, MODEL, decoded=True, block_words=block_words)
    rows = found.withColumn("t", pieces.decode(F.col("ids"), MODEL)).collect()
    got = [(r["id"], r["ids"], r["t"]) for r in rows]
    assert all(r["t"] == r["decoded"] for r in rows)
    library = pieces.processor(MODEL)
    want = [(i // 2, library.encode(t or ""), library.decode(library.encode(t or ""))) for i, t in enumerate(texts)]
    assert sorted(got) == sorted(want)


def test_words_join_to_the_marked_text():
    words, counts = pieces.marked_words(pa.array([t or "" for t in TEXTS]))
    words, start = words.to_pylist(), 0
    for text, n in zip(TEXTS, counts):
        mine, start = words[start : start + n], start + n
        joined = "".join(f"▁{w}" for w in mine).replace(" ", "▁")
        assert joined == ("▁" + text.replace(" ", "▁") if text else "")
        assert not any("▁" in f"▁{w}".replace(" ", "▁").lstrip("▁") for w in mine)


def test_ids_of_null_ids_and_of_no_rows(spark):
    docs = table(spark, [(None, "a b", "en", "s", 1), (None, "a b", "en", "s", 1), (1, None, "en", "s", 1)])
    found = [(r["id"], r["ids"]) for r in pieces.encode(docs, MODEL).collect()]
    ids = pieces.processor(MODEL).encode("a b")
    assert sorted(found, key=repr) == sorted([(None, ids), (None, ids), (1, [])], key=repr)
    assert pieces.encode(docs.where("doc_id = 9"), MODEL).collect() == []


def test_each_word_is_segmented_once(monkeypatch):
    asked = []

    class Model:
        def encode(self, texts, **options):
            if isinstance(texts, str):
                return [1] * len(texts)
            asked.extend(texts)
            return [[len(t)] for t in texts]

    monkeypatch.setattr(pieces, "processor", lambda path: Model())
    rows = [(1, ["a", "b", "c"]), (1, ["c", "", "a"]), (1, ["dd", "a"]), (2, ["x"])]
    batches = [
        pa.RecordBatch.from_pydict({
            "block": [1] * len(part), "hash": [2] * len(part), "bucket": pa.array([b for b, _ in part], pa.int32()),
            "lengths": [pieces._planes(np.array([len(w) for w in words])) for _, words in part], "words": ["".join(words).encode() for _, words in part],
        })
        for part in (rows[:1], rows[1:])
    ]
    out = list(pieces._segmenter("", True)(iter(batches)))
    assert asked == ["a", "b", "c", "dd", "x"]
    assert [pieces._numbers(v).tolist() for b in out for v in b.column("lengths").to_pylist()] == [[1, 1, 1], [1, 1, 1], [1, 1], [1]]
    assert [pieces._numbers(v).tolist() for b in out for v in b.column("pieces").to_pylist()] == [[1, 1, 1], [1, 1, 1], [2, 1], [1]]


def test_a_table_that_changes_between_readings_is_an_error(spark):
    docs = table(spark, [(i, "a b", "en", "s", 1) for i in range(8)])
    docs = docs.withColumn("text", F.udf(lambda t: t + uuid.uuid4().hex)("text"))
    with pytest.raises(Exception, match="not the same"):
        pieces.encode(docs, MODEL).collect()


# Hard negatives

VECTORS = "vec_id bigint, embedding array<float>, label int, row int, q string, norm int, arena int"


def vector_table(spark, rows):
    return spark.createDataFrame([(*r, 1, "q", 2, 3) for r in rows], VECTORS)


def quantised(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute_negatives(rows, every=10):
    sound = [(i, quantised(v), label) for i, v, label in rows
             if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    last = lambda i: (i is None, i or 0)
    out = []
    for a, (i, v, label) in enumerate(sound):
        if i is None or i % every:
            continue
        scored = [(sum(x * y for x, y in zip(v, w)), j, other) for b, (j, w, other) in enumerate(sound) if b != a]
        ranked = sorted(scored, key=lambda s: (-s[0], last(s[1])))
        for p, pid, _ in [s for s in ranked if s[2] == label][:5]:
            inside = [s for s in ranked if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:10]
            out += [(i, pid, n, j, p, s) for n, (s, j, _) in enumerate(inside, 1)]
    return out


def mined(spark, rows, **sizes):
    source = vector_table(spark, rows)
    return negatives.mine(negatives.rows_of(source, "vec_id", F.col("label"), "embedding", F.col("vec_id") % 10 == 0), **sizes)


def vectors(rng, n, dim=12, near=0.6):
    centres = rng.normal(size=(4, dim))
    label = rng.integers(0, 4, n)
    return [(k, [float(x) for x in centres[c] * near + rng.normal(size=dim) * 0.5], int(c)) for k, c in enumerate(label)]


@pytest.mark.parametrize("sizes", [{}, {"n_rows": 40, "n_anchors": 6}])
def test_negatives_like_brute_force(spark, sizes):
    rng = np.random.default_rng(4)
    rows = vectors(rng, 260)
    rows += [(300 + k, rows[k][1], (rows[k][2] + k) % 4) for k in range(30)]  # ties, some of another label
    rows += [(400, None, 1), (401, [1.0] * 12, None), (402, [float("nan")] * 12, 1), (403, [None] * 12, 2), (404, [float("inf")] * 12, 2),
             (None, [0.5] * 12, 1), (410, [0.0] * 12, 2), (420, [0.5, -0.25], 3), (430, [], 3), (440, [2.0] * 14, 9), (100, rows[100][1], 1)]
    got = collected(mined(spark, rows, **sizes))
    assert sorted(got, key=repr) == sorted(brute_negatives(rows), key=repr) and len(got) > 200


def test_scores_too_large_for_doubles_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(np.float32(x)) for x in rng.integers(1, 1 << 20, 6)], k % 2) for k in range(40)]
    got = collected(mined(spark, rows))
    assert sorted(got) == sorted(brute_negatives(rows)) and max(r[4] for r in got) > 1 << 53


def test_numbers_beyond_a_long_do_not_fail(spark):
    rows = [(k, [1e30, float(k)], k % 2) for k in range(12)]
    assert isinstance(mined(spark, rows).collect(), list)


def test_no_anchors_no_rows(spark):
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]).collect() == []
    assert mined(spark, [(1, None, 0)]).collect() == []
    assert mined(spark, [(0, [0.0, 0.0], 0), (1, [0.0, 0.0], 0), (2, [0.0, 0.0], 1)]).collect() != []  # no direction at all


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    for scale in (1, 50, 3000):
        q = np.rint(rng.normal(size=(90, 8)) * scale)
        q[:5], q[5:9] = 0, q[20:24]
        axes = rng.normal(size=(5, 8))
        axes /= np.linalg.norm(axes, axis=1)[:, None]
        norm = np.linalg.norm(q, axis=1)
        angles = np.arccos(np.clip(q @ axes.T / np.where(norm > 0, norm, 1)[:, None], -1, 1))
        a, score = {"angles": angles, "norm": norm}, q @ q.T
        low, high = negatives._bounds(a, angles[None], angles[None], norm[None], norm[None])
        assert (low <= score).all() and (score <= high).all()
        low, high = negatives._bounds(a, angles.min(0)[None, None], angles.max(0)[None, None], norm.min()[None, None], norm.max()[None, None])
        assert (low <= score).all() and (score <= high).all()


def test_only_overlapping_pairs_are_scored(monkeypatch):
    """Two far clusters: rows of the one are never scored for anchors of the other."""
    rng = np.random.default_rng(2)
    q = np.concatenate([rng.integers(900, 1000, (300, 4)) * [1, 1, 0, 0], rng.integers(900, 1000, (300, 4)) * [0, 0, 1, 1]])
    axes = np.array([[1, 1, 0, 0], [0, 0, 1, 1]]) / math.sqrt(2)
    norm = np.linalg.norm(q, axis=1)
    angles = np.arccos(np.clip(q @ axes.T / norm[:, None], -1, 1))
    part = {"row": np.arange(600), "id": np.arange(600), "norm": norm, "angles": angles, "q": q}
    a = {k: v[:20] for k, v in part.items()}
    asked = []

    def every(i, c):
        asked.append((i, c))
        return np.ones((len(i), len(c)), dtype=bool)

    low = np.full((20, 1), 1_000_000)
    negatives._search(a, part, low, np.full_like(low, 1 << 40), 700, every)
    assert asked and all((c < 300).all() or len(c) < 600 for _, c in asked) and sum(len(c) for _, c in asked) < 600
