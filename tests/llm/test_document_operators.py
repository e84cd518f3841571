"""Rules, SimHash, decontamination, mixing, sharding, quality and personal data: brute force and odd rows."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexigrid.llm import decontaminate, mixing, pii, quality, rules, sharding, shingle_blocks, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, fp int, item string, size int"
LONG = "lorem ipsum dolor " * 4_000


def table(spark, rows):
    """Rows of ``doc_id, text, source``, with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, 1, "row", 2, "item", 3) for i, t, s in rows], SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty, blank, short and very long texts, ties and repeated rows."""
    rng = random.Random(1)
    text = prose(rng, 120)
    rows = [(1, text, "a"), (1, text, "a"), (2, text, "b"), (None, text, None), (3, None, "a"), (4, "", "a"), (None, None, None),
            (5, " \n\t ", "b"), (6, "word", "b"), (7, LONG, "c"), (8, text + " tail", "c"), (8, prose(rng, 80), "c"), (9, "é\u0000\U0001f600 " * 30, None)]
    rows += [(100 + i, prose(rng, rng.randint(1, 150)), rng.choice("abc")) for i in range(40)]
    return rows


def empty(spark):
    return table(spark, [(1, "x", "a")]).where("doc_id = 2")


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# rules

def measures(text):
    text = text or ""
    words = words_of(text)
    grams = list(zip(words, words[1:], words[2:]))
    counts = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_rules_measure_like_brute_force(spark, odd):
    extra = [(200, "a b c a b c d\na b c\na b c", "a"), (201, "x y x y x y x", "a"), (202, "# ** | < > a", "b"), (203, "a b c x a b c " * 20, "a")]
    rows = odd + extra
    got = rules.report(table(spark, rows)).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = []
    for i, t, _ in rows:
        m = measures(t)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert collections.Counter(tuple(r)[:7] for r in got.collect()) == collections.Counter(want)
    assert not any(r["kept"] and r["base_failed"] for r in got.collect())


def test_order_of_rules_changes_no_verdict(spark, odd):
    docs = table(spark, odd)
    kept = [sorted(map(str, rules.cascade(docs, order, ordered=True).where("failed_rule is null").select("row").collect()))
            for order in (rules.RULES, rules.RULES[::-1])]
    assert kept[0] == kept[1] and kept[0]
    assert rules.keep_good(docs).columns == docs.columns
    assert sorted(str(r) for r in rules.keep_good(docs).collect()) == sorted(x[len("Row(row="):-1] for x in kept[0])
    assert rules.keep_good(empty(spark)).count() == 0


def test_rules_reject_junk(spark):
    rng = random.Random(2)
    clean = "\n".join(prose(rng, 30).capitalize() + "." for _ in range(5))
    junk = [clean.upper(), clean.replace(" ", "### "), " | ".join(clean.split()), "\n".join(["same line again"] * 40)]
    got = rules.keep_good(table(spark, [(0, clean, "a")] + [(k + 1, t, "a") for k, t in enumerate(junk)])).collect()
    assert [r["doc_id"] for r in got] == [0]


# SimHash

def brute_classes(rows):
    fps = [simhash.fingerprint(t) for _, t, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                root[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for k, (i, _, _) in enumerate(rows):
        ids[find(k)].append(i)
    labelled = [(i, min((x for x in ids[find(k)] if x is not None), default=None)) for k, (i, _, _) in enumerate(rows)]
    return labelled, len(ids)


def test_classes_like_brute_force(spark, odd):
    rng = random.Random(3)
    base = prose(rng, 400)
    near = [(300 + k, base.replace(base.split()[k], "changed", 1), "a") for k in range(12)]
    rows = odd + near
    got = simhash.classes(table(spark, rows)).select("id", "component_id").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_classes(rows)[0])
    assert simhash.classes(empty(spark)).count() == 0


def test_fingerprint_by_the_rule():
    import xxhash

    text = "The quick  brown fox JUMPS É over\x0bit"
    words = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    words = words_of(words)
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in zip(words, words[1:], words[2:])]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text) == want
    assert simhash.fingerprint("Two words") == xxhash.xxh64_intdigest(b"two words", 42)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_blocks_miss_no_close_pair(spark):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(20)]
    fps = sorted({x for b in base for x in [b, *(b ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(20))]})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {tuple(r) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2}


def test_one_of_each_class_stays(spark, odd):
    kept = simhash.keep_one(table(spark, odd))
    assert kept.columns == table(spark, odd).columns
    assert kept.count() == brute_classes(odd)[1]
    assert simhash.keep_one(empty(spark)).count() == 0


def test_a_long_chain_is_one_class(spark):
    chain, x = [], 0
    for k in range(40):
        x |= 1 << k
        chain.append(x)
    pairs = [(a, b) for a, b in zip(chain, chain[1:])]
    star = simhash.stars(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert {(r["a"], r["b"]) for r in star} == {(chain[0], c) for c in chain[1:]}


def five_word_sets(texts):
    found = []
    for t in texts:
        w = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = words_of(w)
        found.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return found


def brute_similar(rows, similarity=0.8):
    """Per row the smallest ID of its class, by two bits or by shingles."""
    fps, sets = [simhash.fingerprint(t) for _, t, _ in rows], five_word_sets([t for _, t, _ in rows])
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if bin(fps[a] ^ fps[b]).count("1") <= 2 or sets[a] and sets[b] and common >= similarity * (len(sets[a]) + len(sets[b]) - common):
                group[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least.setdefault(find(k), []).append(i)
    return [(i, min((x for x in least[find(k)] if x is not None), default=None)) for k, (i, _, _) in enumerate(rows)]


def test_near_copies_by_shingles_like_brute_force(spark, odd):
    rng, rows = random.Random(8), list(odd)
    passage = prose(rng, 60)
    for size in (20, 70, 120, 128, 150, 300, 700):
        for k in range(6):
            base = prose(rng, size).split()
            texts = [base, base[: int(len(base) * 0.9)], base + prose(rng, size // 8).split(), [w.upper() for w in base]]
            for edits in (1, max(1, size // 60), size // 20):
                edited = list(base)
                for _ in range(edits):
                    edited[rng.randrange(len(edited))] = "changed"
                texts.append(edited)
            texts.append(prose(rng, size).split() + passage.split())  # shares a passage, no copy
            rows += [(1000 + len(rows) + i, " ".join(t), "a") for i, t in enumerate(texts)]
    got = simhash.similar_classes(table(spark, rows)).select("id", "component_id").collect()
    want = brute_similar(rows)
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)
    assert len({c for _, c in want}) < len(brute_classes(rows)[0]) / 2
    kept = simhash.keep_one(table(spark, rows), similarity=0.8)
    assert kept.columns == table(spark, rows).columns
    assert {r["doc_id"] for r in kept.collect()} == {c for _, c in want}
    assert simhash.keep_one(empty(spark), similarity=0.8).count() == 0


def test_one_large_group_of_edited_copies(spark):
    """Its texts meet their original, not each other: fewer pairs than three per text and block."""
    rng = random.Random(9)
    base = prose(rng, 200).split()
    rows = [(0, " ".join(base), "a")]
    for k in range(1, 400):
        edited = list(base)
        for _ in range(4):
            edited[rng.randrange(len(base))] = f"word{rng.randrange(10**9)}"
        rows.append((k, " ".join(edited), "a"))
    docs = table(spark, rows)
    assert [r["doc_id"] for r in simhash.keep_one(docs, similarity=0.8).collect()] == [0]
    keyed = docs.select(F.xxhash64("text").alias("text_hash"), simhash.keyed_of(F.col("text")).alias("m")).select("text_hash", "m.fp", "m.keys")
    assert shingle_blocks.candidates(keyed).count() < 2 * shingle_blocks.BLOCKS * len(rows)


def test_groups_without_their_original_like_brute_force(spark):
    """Many copies that resemble only some of the others, and none of them all."""
    rng, rows = random.Random(12), []
    for first, size, edits, copies in ((0, 100, (1, 3), 600), (1000, 400, (4, 14), 300)):
        base = prose(rng, size).split()
        for k in range(copies):
            edited = list(base)
            for at in rng.sample(range(size), rng.randint(*edits)):
                edited[at] = f"word{rng.randrange(10**9)}"
            rows.append((first + k, " ".join(edited), "a"))
    got = simhash.similar_classes(table(spark, rows)).select("id", "component_id").collect()
    want = brute_similar(rows)
    assert len({c for _, c in map(tuple, got)}) == len({c for _, c in want})
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


@pytest.mark.parametrize("edits", [2, 3, 4])
def test_joins_grow_with_the_texts_of_a_group_not_with_its_pairs(spark, monkeypatch, edits):
    """Copies with their own words, the original missing: every table of the search, links included, is linear."""
    written, rows_of = shingle_blocks.written, {}

    def counted(df, name):
        made = written(df, name)
        rows_of.setdefault(name, []).append(made.count())
        return made

    monkeypatch.setattr(shingle_blocks, "written", counted)
    rng = random.Random(5)
    base = prose(rng, 100).split()
    texts = []
    for _ in range(400):
        edited = list(base)
        for at in rng.sample(range(100), edits):
            edited[at] = f"word{rng.randrange(10**9)}"
        texts.append(" ".join(edited))
    links = []
    for n in (100, 400):
        docs = table(spark, [(k, t, "a") for k, t in enumerate(texts[:n])])
        keyed = docs.select(F.xxhash64("text").alias("text_hash"), simhash.keyed_of(F.col("text")).alias("m")).select("text_hash", "m.*")
        links.append(shingle_blocks.similar(docs, keyed).count())
    assert all(few[1] <= 6 * few[0] + 200 for few in rows_of.values())
    assert max(few[1] for few in rows_of.values()) < 130 * 400


def test_finer_blocks_of_similar_sets_meet():
    """Wherever two sets are similar enough, one stands for a block that the other looks for, whatever they have alone."""
    rng, met = np.random.default_rng(3), 0
    for n in (1, 2, 4, 9, 20, 60, 96, 150, 400, 2000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            gone, new = rng.integers(0, n // 5 + 1), rng.integers(0, n // 5 + 1)
            b = np.unique(np.concatenate([a[gone:], rng.integers(0, 1 << 63, new, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            if common < 0.8 * (len(a) + len(b) - common):
                continue
            # of the shingles that one lacks, any may be in no other text
            alone = [x[rng.random(len(x)) < rng.random()] for x in (np.setdiff1d(a, b), np.setdiff1d(b, a))]
            (fa, ka, ha), (fb, kb, hb) = (shingle_blocks.finer_blocks(x, y) for x, y in zip((a, b), alone))
            assert fa + fb >= -1e-9
            met += 1
            assert set(ka[ha]) & set(kb) or set(kb[hb]) & set(ka)
    assert met > 150


def test_copies_that_differ_in_repeats_of_a_line(spark):
    """Their sets are nearly equal, their SimHashes are not."""
    rng, rows = random.Random(10), []
    for k in range(40):
        base, line = prose(rng, 180), prose(rng, 8)
        rows += [(2 * k, f"{base}\n{line}", "a"), (2 * k + 1, base + f"\n{line}" * 15, "a")]
    sets, fps = five_word_sets([t for _, t, _ in rows]), [simhash.fingerprint(t) for _, t, _ in rows]
    assert all(len(a & b) >= 0.8 * len(a | b) for a, b in zip(sets[::2], sets[1::2]))
    assert any(bin(a ^ b).count("1") > 24 for a, b in zip(fps[::2], fps[1::2]))
    got = simhash.similar_classes(table(spark, rows)).select("id", "component_id").collect()
    assert {tuple(r) for r in got} == {(i, i - i % 2) for i, _, _ in rows}


def test_odd_sketches_lose_no_pair(spark):
    rng, rows = np.random.default_rng(11), []
    for size in (1, 5, 60, 127, 400, 3000):
        for share in (0.0, 0.1, 0.2, 0.25, 0.6):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[int(share * size) :], rng.integers(0, 1 << 63, int(share * size) // 3, dtype=np.uint64)]))
            common = len(np.intersect1d(a, b))
            one = [(len(x), shingle_blocks.odd_sketch(x).tolist()) for x in (a, b)]
            rows.append((*one, common >= 0.8 * (len(a) + len(b) - common)))
    frame = spark.createDataFrame(rows, "x struct<n:int,odd:array<bigint>>, y struct<n:int,odd:array<bigint>>, close boolean")
    got = frame.select("close", shingle_blocks.reachable("x", "y", 0.8).alias("passed")).collect()
    assert all(r["passed"] for r in got if r["close"]) and {r["passed"] for r in got} == {True, False}


def test_blocks_of_similar_sets_meet():
    rng = np.random.default_rng(1)
    missed = 0
    for n in (1, 5, 40, 63, 64, 127, 128, 129, 200, 255, 256, 3000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            b = a[: len(a) - int(0.2 * n)]  # similarity 0.8 by length alone
            missed += not set(shingle_blocks.blocks(a).tolist()) & set(shingle_blocks.blocks(b).tolist())
    assert missed == 0
    assert len(shingle_blocks.blocks(shingle_blocks.shingles([]))) == 0
    assert len(shingle_blocks.shingles([b"a", b"b"])) == 1
    assert len(shingle_blocks.shingles([b"x"] * 50)) == 1


# decontamination

ITEMS = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "one two three four five six seven eight nine ten eleven twelve", "x y", "", None]


def test_leaks_are_found_and_clean_documents_left(spark):
    rng = random.Random(5)
    fill = lambda: prose(rng, 60)
    edited = ITEMS[0].split()
    edited[3], edited[8] = "changed", "words"
    rows = [(1, f"{fill()} {ITEMS[0].upper()} {fill()}", "a"), (2, f"{fill()} {' '.join(edited)} {fill()}", "a"), (3, fill(), "a"), (None, ITEMS[1], "b"),
            (4, f"{fill()} alpha beta gamma {fill()}", "a"), (5, None, "a"), (6, "", "a"), (7, LONG + ITEMS[1] + LONG, "c"), (3, fill(), None)]
    rows += [(1000 + k, f"{fill()} {ITEMS[1]}", "hot") for k in range(60)]
    bench = spark.createDataFrame([(k, t, "x") for k, t in enumerate(ITEMS)], "item_id bigint, text string, doc_id string")
    docs = table(spark, rows)
    got = {(r["id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == {(1, 0), (2, 0), (None, 1), (7, 1)} | {(1000 + k, 1) for k in range(60)}
    left = decontaminate.clean(docs, bench)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 3, 4, 5, 6]
    assert decontaminate.contaminated(empty(spark), bench).count() == 0
    assert decontaminate.clean(docs, bench.where("item_id > 10")).count() == len(rows)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(ITEMS)], "item_id bigint, text string")
    docs = table(spark, [(k, f"start {t} end", "a") for k, t in enumerate(ITEMS)])
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 8)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole and len(whole) == 2


def _edited(words, rng, kind):
    if kind == "replaced":  # every third word
        return [f"new{rng.randrange(500)}" if k % 3 == 2 else w for k, w in enumerate(words)]
    if kind == "inserted":  # a word after every second
        return [x for k, w in enumerate(words) for x in ([w, f"more{rng.randrange(500)}"] if k % 2 else [w])]
    if kind == "cut":
        return words[len(words) // 3 :]
    if kind == "dropped":
        return [w for k, w in enumerate(words) if k % 6 != 3]
    return words


def test_copies_like_all_pairs_of_alignments(spark):
    """Every text against every item, whatever the edits and however common the words."""
    rng = random.Random(15)
    common, rare = [f"c{k}" for k in range(12)], [f"r{k}" for k in range(4000)]

    def some(n):
        return [rng.choice(common) if rng.random() < 0.6 else rng.choice(rare) for _ in range(n)]

    items = [some(n) for n in (4, 5, 6, 7, 8, 9, 10, 12, 16, 16, 17, 25, 40, 60)] + [[rng.choice(common) for _ in range(n)] for n in (9, 14, 20, 30)]
    texts = [some(rng.randint(0, 150)) for _ in range(120)]
    for item in items:
        for kind in ("replaced", "inserted", "cut", "dropped", "verbatim"):
            texts.append(some(rng.randint(0, 40)) + _edited(item, rng, kind) + some(rng.randint(0, 40)))
    texts.append(some(3000) + _edited(items[8], rng, "replaced") + some(3000))
    count = {}
    for w in (w for t in texts for w in t):
        count[w] = count.get(w, 0) + 1
    limit = decontaminate.CHANCE * len(texts) / sum(count.values())
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            number = {w: k for k, w in enumerate(sorted(set(item)))}
            share = np.array([count.get(w, 0) / sum(count.values()) for w in sorted(set(item))])
            found = decontaminate.rare_end(np.array([number[w] for w in item]), np.array([number.get(w, -1) for w in text], dtype=np.int64),
                                           decontaminate.SCORE * decontaminate.MATCH * len(item), lambda m: np.prod(share[m]) <= limit * (1 + 1e-9))
            if found is not None:
                expected[d, i] = found[0] / (decontaminate.MATCH * len(item))
    docs = table(spark, [(d, " ".join(t), "a") for d, t in enumerate(texts)])
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id bigint, text string")
    got = {(r["id"], r["item_id"]): r["score"] for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == expected
    planted = {(120 + 5 * i + k, i) for i, item in enumerate(items) for k in range(5) if len(item) >= 12}
    assert planted <= got.keys() and got[120 + 5 * len(items), 8] >= decontaminate.SCORE


def test_short_items(spark):
    rng = random.Random(16)
    fill = lambda: prose(rng, 60)
    bench = spark.createDataFrame([(1, "Yes"), (2, "x y"), (3, "alpha beta gamma"), (4, "?!"), (5, "alpha beta of the")], "item_id bigint, text string")
    rows = [(1, "yes", "a"), (2, "yes yes", "a"), (3, f"yes {fill()}", "a"), (4, "X, y!", "a"), (5, f"x y {fill()}", "a"), (6, f"{fill()} alpha beta gamma", "a"),
            (7, f"alpha {fill()} beta gamma", "a")]
    rows += [(100 + k, f"{fill()} of the {fill()} of the", "a") for k in range(60)]
    got = {(r["id"], r["item_id"]) for r in decontaminate.contaminated(table(spark, rows), bench).collect()}
    assert got == {(1, 1), (4, 2), (6, 3), (6, 5)}  # "of the" alone is half of the last item, but no copy


def test_alignment_like_the_textbook():
    rng = random.Random(6)
    for _ in range(40):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, 12))] for _ in range(2))
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                h[i + 1][j + 1] = max(0, h[i][j] + (decontaminate.MATCH if x == y else decontaminate.MISMATCH), h[i][j + 1] + decontaminate.GAP, h[i + 1][j] + decontaminate.GAP)
        assert decontaminate.align(np.array(a), np.array(b))[0] == max(map(max, h))


# mixing

def test_mix_keeps_its_promises(spark, odd):
    rows = odd + [(500 + k, prose(random.Random(k), 20), "a") for k in range(60)]
    got = mixing.mix(table(spark, rows)).collect()
    assert collections.Counter((r["id"], r["source"], r["size"]) for r in got) == collections.Counter((i, s, len(words_of(t))) for i, t, s in rows)
    taken, targets, sizes = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        sizes[r["source"]] += r["size"]
        targets[r["source"]] = r["target"]
        assert r["source_size"] == sum(len(words_of(t)) for _, t, s in rows if s == r["source"])
    total = sum(sizes.values())
    assert abs(sum(targets.values()) - total) < 1e-6 * total
    assert all(abs(taken[s] - targets[s]) <= 2 + 2 * total / mixing.BLOCKS for s in targets)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(table(spark, rows)).collect()))


def brute_sainte_lague(targets, seats):
    won = [0] * len(targets)
    for _ in range(seats):
        best = max(range(len(targets)), key=lambda s: (targets[s] / (2 * won[s] + 1), -s))
        won[best] += 1
    return won


def test_quotas_are_the_highest_quotients(spark):
    rng = random.Random(7)
    for sizes in ([900, 30, 70, 1, 500], [rng.randint(1, 1000) for _ in range(15)]):
        frame = spark.createDataFrame([(f"s{k:02d}", n) for k, n in enumerate(sizes)], "source string, source_size bigint")
        shared = mixing.targets(frame)
        target = {r["source"]: r["target"] for r in shared.collect()}
        got = collections.Counter()
        for r in mixing.quotas(shared, blocks=100, shards=5).collect():
            assert r["quota"] >= 0
            got[r["source"]] += r["quota"]
        block = max(1, sum(sizes) // 100)
        won = brute_sainte_lague([target[s] for s in sorted(target)], sum(sizes) // block)
        assert [got[s] for s in sorted(target)] == [min(w, 3 * n // block) for w, n in zip(won, sizes)]


@pytest.mark.parametrize("large", [4_000_000, 225_000_000])
def test_tiny_sources_beside_very_large_ones(spark, large):
    """Up to 4.5 G words: each source gets its target to a word or a block, however small it is."""
    sizes = [("empty", 0), ("t1", 1), ("t2", 100), ("t3", 400), ("t4", 2_000), ("t5", 8_000), *((f"x{i:02}", large) for i in range(20))]
    shared = mixing.targets(spark.createDataFrame(sizes, "source string, source_size bigint"))
    got = collections.defaultdict(int)
    for r in mixing.quotas(shared).collect():
        got[r["source"]] += r["quota"] * r["block_words"]
    for r in shared.collect():
        assert abs(got[r["source"]] - r["target"]) <= 2 + r["target"] / 1000, (r, got[r["source"]])


def test_a_tiny_source_is_in_the_mix(spark):
    rng = random.Random(13)
    rows = [(i, " ".join(["word"] * 20_000), "large") for i in range(100)] + [(1000, prose(rng, 2), "tiny")]
    got = {r["id"]: r["taken"] for r in mixing.mix(table(spark, rows)).collect()}
    assert got[1000] == 6
    assert [r["n"] for r in mixing.mixed(table(spark, rows)).where("doc_id = 1000").groupBy().agg(F.count("*").alias("n")).collect()] == [3]


def test_targets_stop_and_share_again(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 10), ("c", 989), (None, 0)], "source string, source_size bigint")
    got = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert got == {"a": 3.0, "b": 30.0, "c": 967.0, None: 0.0}


def test_mixed_documents(spark, odd):
    docs = table(spark, odd)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    times = collections.Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert all(n <= 3 * sum((i, t) == key for i, t, _ in odd) for key, n in times.items()) and all(words_of(t) for _, t in times)
    assert mixing.mixed(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    assert {r["taken"] for r in mixing.mix(table(spark, [(1, "", "a"), (2, None, None)])).collect()} == {0}


# sharding

def test_shards_are_gapless_and_balanced(spark, odd):
    rng = random.Random(8)
    hot = prose(rng, 60)
    rows = odd + [(1000 + k, hot if k % 3 == 0 else prose(rng, 60), "a") for k in range(600)]
    got = sharding.assign(table(spark, rows), shards=6, items=64).collect()
    assert collections.Counter((r["id"], r["bytes"], r["crc32"]) for r in got) == collections.Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    slots, size = collections.defaultdict(list), collections.Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["bytes"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 8 for _, t, _ in rows)
    rest = [n for n in size.values() if n < largest]
    assert len(size) == 6 and max(rest) < 1.1 * min(rest)


def test_placement_takes_the_highest_dot_product():
    items = np.array([[4.0, 1, 1], [1, 4, 1], [4, 1, 1], [1, 4, 1]])
    found = sharding.place(items, 2)
    assert sorted(map(tuple, ([items[found == s].sum(axis=0).tolist() for s in (0, 1)]))) == [(5.0, 5.0, 2.0)] * 2
    assert len(sharding.place(np.zeros((0, 3)), 2)) == 0


def test_sharded_rows(spark, odd):
    docs = table(spark, odd).withColumn("shard", F.lit("x"))
    out = sharding.sharded(docs, shards=4, items=16)
    assert out.columns == [*[c for c in docs.columns if c != "shard"], "shard", "slot"]
    assert collections.Counter((r["doc_id"], r["text"]) for r in out.collect()) == collections.Counter((i, t) for i, t, _ in odd)
    assert out.select("shard", "slot").distinct().count() == len(odd)
    assert sharding.sharded(empty(spark)).count() == 0


# quality

def test_quality_votes_like_brute_force():
    rng = random.Random(9)
    texts = [prose(rng, 80) for _ in range(60)] + [prose(rng, 80).upper() for _ in range(20)] + ["", "word"]
    labels = [1] * 60 + [0] * 20 + [0, 1]
    model = quality.fit([quality.terms(t) for t in texts], labels)
    some = [quality.terms(t) for t in [prose(rng, 90), prose(rng, 70).upper(), "", LONG]]
    got = model.score(some, k=7)
    z = model.project(some)
    for row, score in zip(z, got):
        cosine = model.vectors @ row
        near = np.argsort(-cosine)[:7]
        weight = np.maximum(cosine[near], 0).astype(float) ** 8
        assert abs(score - (weight * model.labels[near]).sum() / weight.sum()) < 1e-3
    assert got[0] > 0.9 and got[1] < 0.1 and ((got >= 0) & (got <= 1)).all()


def test_quality_over_tables(spark, odd):
    rng = random.Random(10)
    rows = odd + [(1000 + k, prose(rng, 60) if k % 2 else prose(rng, 60).upper(), "a") for k in range(60)]
    labels = spark.createDataFrame([(1000 + k, k % 2) for k in range(40)] + [(1000, 0), (None, 1), (1001, None), (77777, 1)], "doc_id bigint, quality int")
    model = quality.fit_from(table(spark, rows), labels)
    assert len(model.labels) == 40
    got = quality.scored(table(spark, rows), model).select("row.doc_id", "score").collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 2 == 1) for r in got if r["doc_id"] and r["doc_id"] >= 1000)
    bare = quality.fit_from(table(spark, rows), labels.where("doc_id < 0"))
    assert {r["score"] for r in quality.scored(table(spark, odd), bare).collect()} == {0.5}
    assert quality.scored(empty(spark), model).count() == 0


# personal data

def naive_spans(text):
    found = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub(r"\D", "", m[0])
        if 14 <= len(digits) <= 19 and pii.luhn(digits):
            found.append(("card", m.start(), m.end()))
    found += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(re.sub(r"\D", "", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def test_base_spans_like_the_patterns():
    rng = random.Random(11)
    for _ in range(3000):
        text = "".join(rng.choice("0123456789 ..@@ab-+_%()é\n") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(text) == naive_spans(text), text
    assert pii.base_spans("1.2.3.4.5.6.7.8 0001.2.3.4 a@b.c@d.e") == naive_spans("1.2.3.4.5.6.7.8 0001.2.3.4 a@b.c@d.e")
    assert pii.base_spans("9" * 200_000 + "a" * 200_000) == []


@pytest.fixture(scope="module")
def labeller():
    rng = random.Random(12)
    return pii.train([prose(rng, 50) + " mail bob.x@example.com or +1 (415) 555-0199 from 10.1.2.3 " + prose(rng, 20) for _ in range(60)])


def test_labeller_learns_its_spans(labeller):
    rng = random.Random(13)
    hit = total = 0
    for _ in range(80):
        kind = rng.choice(pii.KINDS)
        text = f"{prose(rng, 4)} {pii._made(rng, kind)} {prose(rng, 4)}"
        want = {s for s in pii.base_spans(text) if s[0] == kind}
        for low, high in pii.stretches(text):
            got = {(pii.KINDS[k], low + a, low + b) for k, a, b in pii.label([text[low:high]], labeller)[0]}
            hit += len(want & got)
        total += len(want)
    assert hit >= 0.85 * total > 0


def test_windows_cover_and_meet(labeller):
    for n in (1, 95, 96, 97, 160, 161, 1000):
        covered = np.zeros(n, dtype=bool)
        for s in pii.windows(n):
            covered[s : s + pii.WINDOW] = True
        assert covered.all()
    long = "call " + " ".join(["4111 1111 1111 1112"] * 12)
    assert all(a[2] <= b[1] for _, every in pii.all_spans([long], labeller) for a, b in zip(every, every[1:]))


def test_crf_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    scores, trans = rng.normal(size=(2, 4, pii._TAGS)), rng.normal(size=(pii._TAGS, pii._TAGS))
    lengths, tags = np.array([4, 2]), rng.integers(0, pii._TAGS, (2, 4))

    def loss(s, t):
        total = 0.0
        for b, n in enumerate(lengths):
            paths = s[b, 0]
            for k in range(1, n):
                paths = pii._logsum(paths[:, None] + t, 0) + s[b, k]
            own = sum(s[b, k, tags[b, k]] for k in range(n)) + sum(t[tags[b, k - 1], tags[b, k]] for k in range(1, n))
            total += pii._logsum(paths, 0) - own
        return total / len(lengths)

    d_scores, d_trans = pii.crf_gradient(scores, lengths, tags, trans)
    for at in [(0, 0, 1), (0, 3, 2), (1, 1, 4), (1, 3, 0)]:
        moved = scores.copy()
        moved[at] += 1e-5
        assert abs((loss(moved, trans) - loss(scores, trans)) / 1e-5 - d_scores[at]) < 1e-3
    moved = trans.copy()
    moved[1, 2] += 1e-5
    assert abs((loss(scores, moved) - loss(scores, trans)) / 1e-5 - d_trans[1, 2]) < 1e-3


def test_personal_data_over_tables(spark, odd, labeller):
    rows = odd + [(900, "mail a@b.co now", "a"), (901, "card 4111 1111 1111 1111.", "a"), (902, "call +1 (415) 555-0199", "a")]
    got = pii.find(table(spark, rows), weights=labeller).select("row.text", "base", "every").collect()
    assert len(got) == len(rows)
    for r in got:
        base = [(s["kind"], s["start"], s["end"]) for s in r["base"]]
        assert base == naive_spans(r["text"] or "") and set(base) <= {(s["kind"], s["start"], s["end"]) for s in r["every"]}
    assert pii.find(empty(spark), weights=labeller).count() == 0
