"""The pipeline against plain Python, stage by stage, over the smallest given tables."""

import collections

import pandas as pd

import corpus_pipeline
from lexigrid.llm import decontaminate, simhash
from lexigrid.session import written

SF_DIR = "/root/testdata/sf0.001"


def rejected(text):
    words = text.split()
    grams = list(zip(words, words[1:], words[2:]))
    counts = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.split()]
    n, chars = len(words), sum(map(len, words))
    upper, lower = sum("A" <= c <= "Z" for c in text), sum("a" <= c <= "z" for c in text)
    return (n < 50 or 2 * len(covered) > n or 100 * sum(c in "#*$%&|<>" for c in text) > 4 * chars
            or 2 * (len(lines) - len(set(lines))) > len(lines) or 100 * upper > 40 * (upper + lower) or chars > 20 * n)


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    common = len(a & b)
    return common >= 0.8 * (len(a) + len(b) - common)


def first_of_classes(docs):
    fps, group = {i: simhash.fingerprint(t) for i, t in docs.items()}, {i: i for i in docs}
    sets, changed = {i: shingles(t) for i, t in docs.items()}, True
    while changed:
        changed = False
        for a in docs:
            for b in docs:
                close = bin(fps[a] ^ fps[b]).count("1") <= 2 or similar(sets[a], sets[b])
                if close and group[a] > group[b]:
                    group[a], changed = group[b], True
    return {i for i in docs if group[i] == i}


def leaks(text, items):
    passage = decontaminate.words(text)
    return any(f" {' '.join(decontaminate.words(item))} " in f" {' '.join(passage)} " for item in items)


def test_stages_like_plain_python(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, texts = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    items = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")["text"]
    stages, kept = dict(corpus_pipeline.STAGES), docs
    ids = lambda: {r["doc_id"] for r in kept.select("doc_id").collect()}

    kept = written(stages["quality_rules"](spark, kept, SF_DIR), "t")
    want = {i: t for i, t in texts.items() if not rejected(t)}
    assert kept.columns == columns and ids() == set(want)
    kept = written(stages["simhash_dedup"](spark, kept, SF_DIR), "t")
    want = {i: want[i] for i in first_of_classes(want)}
    assert kept.columns == columns and ids() == set(want)
    kept = written(stages["decontamination"](spark, kept, SF_DIR), "t")
    want = {i: t for i, t in want.items() if not leaks(t, items)}
    assert kept.columns == columns and ids() == set(want)
    kept = written(stages["mixing"](spark, kept, SF_DIR), "t")
    mixed = collections.Counter(r["doc_id"] for r in kept.collect())
    assert kept.columns == columns and set(mixed) <= set(want) and max(mixed.values()) <= 3
    kept = written(stages["sharding"](spark, kept, SF_DIR), "t")
    slots = collections.defaultdict(list)
    for r in kept.collect():
        slots[r["shard"]].append(r["slot"])
    assert kept.columns == [*columns, "shard", "slot"] and collections.Counter(r["doc_id"] for r in kept.collect()) == mixed
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
