"""SuperMinHash groups against brute force on full sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from ledgerlens.llm import common, ngram_join
from ledgerlens.llm import superminhash as sm

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, percent=85):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and 100 * inter >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[root(i)].append(r[0])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    comp = [least[root(i)] if sets[i] else r[0] for i, r in enumerate(rows)]
    return sorted(str((r[0], len(s), c, r[0] == c)) for r, s, c in zip(rows, sets, comp))


def got(df):
    return sorted(str((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in df.collect())


def test_edge_rows_and_empty(spark, edge, empty):
    assert got(sm.near_duplicates(edge)) == brute([(r.doc_id, r.text) for r in edge.collect()])
    assert sm.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("direct", [0, 64])
def test_chains_and_large_groups(spark, monkeypatch, direct):
    """Copies with growing edits, some linked through others only; with 0 every
    open list goes through the heads of its sets."""
    monkeypatch.setattr(sm, "DIRECT", direct)
    rng = random.Random(direct)
    texts = []
    for base in range(4):
        words = [f"b{base}w{rng.randrange(10 ** 6)}" for _ in range(150)]
        for k in range(30):
            w = list(words)
            for _ in range(rng.choice((1, 1, 2, 3, 4, 8))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w))
            if k % 4 == 0:
                words = w  # the group drifts
    texts += [f"quite different {i} " * 6 for i in range(10)] + ["a b c d e f g h i", "a b c d e f g h i j", "tiny"] * 2
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, cls string, list int").repartition(3)
    assert got(sm.near_duplicates(df)) == brute(rows)


def test_signatures_estimate_similarity_with_less_variance():
    """Agreeing positions are the similarity on average, with a variance below
    that of independent hashes; parts of a set give the whole set's signature."""
    rng = np.random.default_rng(5)
    m, errors = 128, []
    for _ in range(300):
        pool = rng.integers(0, 2 ** 63, 100, dtype=np.uint64)
        x, y = np.unique(pool[:70]), np.unique(pool[30:])
        a, b = sm.signatures([x, y], m)
        errors.append((a == b).mean() - 0.4)
    assert abs(np.mean(errors)) < 0.008 and np.var(errors) < 0.8 * 0.4 * 0.6 / m
    for size in (1, 2, 50, 400):
        x = np.unique(rng.integers(0, 2 ** 63, size, dtype=np.uint64))
        whole = sm.signatures([x], m)
        assert (np.minimum.reduce([sm.signatures([p], m)[0] for p in np.array_split(x, min(3, len(x)))]) == whole[0]).all()
        if size < m:
            # every n-gram gives every position another rank
            assert sorted((sm.signatures([x[:1]], m)[0] >> np.uint64(32)).tolist()) == list(range(m))


def test_a_large_set_in_parts(monkeypatch):
    x = np.unique(np.random.default_rng(2).integers(0, 2 ** 63, 3000, dtype=np.uint64))
    whole = sm.signatures([x], 128)
    monkeypatch.setattr(sm, "STATE_BYTES", 128 * 100)
    assert (sm.signatures([x, x[:50]], 128)[0] == whole[0]).all()


def test_similar_sets_share_a_list():
    rng = np.random.default_rng(3)
    for _ in range(200):
        x = rng.integers(0, 2 ** 63, 200, dtype=np.uint64)
        y = np.concatenate([x[:184], rng.integers(0, 2 ** 63, 16, dtype=np.uint64)])  # similarity 0.852
        sets = [np.unique(x), np.unique(y)]
        a, b = sm.bands(sm.signatures(sets, sm.BANDS * sm.ROWS), sm.ROWS)
        assert (a == b).any()


def test_few_rows_are_not_dealt_over_many_tasks(spark, monkeypatch):
    """With many shuffle partitions that Spark does not join, steps over few rows
    take few tasks and files; the groups are those of brute force."""
    rng = random.Random(5)
    rows, stem = [], [f"w{rng.randrange(10 ** 6)}" for _ in range(120)]
    for i in range(400):
        w = [f"v{i}x{j}" for j in range(20)] if i % 2 else list(stem)
        w[rng.randrange(len(w))] = f"e{i}"
        rows.append((i, " ".join(w)))
    files, plain = defaultdict(int), common.stored

    def counted(df, name, *more):
        out = plain(df, name, *more)
        files[name] = max(files[name], len(out.inputFiles()))
        return out

    for module in (common, sm, ngram_join):
        monkeypatch.setattr(module, "stored", counted)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "96")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = got(sm.near_duplicates(df))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert out == brute(rows)
    few = max(2, spark.sparkContext.defaultParallelism)
    assert {k: n for k, n in files.items() if k != "signatures" and n > few} == {}
    assert files["components"]
