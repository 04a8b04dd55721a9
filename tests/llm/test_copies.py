"""Exact and near copies, benchmark windows: against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import decontaminate, exact_dedup, ngram_join
from ledgerlens.llm.common import components, id_text, join_groups

LOWER = {i: i + 32 for i in range(65, 91)}


# ------------------------------------------------------------- exact dedup
def test_exact_edge_cases(spark, edge, empty):
    rows = edge.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(LOWER)].append(r.doc_id)
    got = exact_dedup.ingest(edge, exact_dedup.DigestIndex(spark, buckets=4)).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).digest(): ids for t, ids in groups.items()}
    kept = Counter()
    for r in got:
        ids = by_digest[bytes(r.digest)]
        known = [i for i in ids if i is not None]
        assert r.group_size == len(ids) and r.keep_id == (max(known) if known else None)
        kept[bytes(r.digest)] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}  # one row of every group stays, also of repeated rows
    index = exact_dedup.DigestIndex(spark, buckets=4)
    assert exact_dedup.ingest(empty, index).count() == 0
    left = exact_dedup.drop_copies(edge, index)
    assert left.columns == edge.columns and left.count() == len(groups)


def test_index_persists_and_join_does_not_move_it(spark, documents):
    index = exact_dedup.DigestIndex(spark, buckets=4)
    first, second = documents.filter("doc_id % 2 = 0"), documents
    a = exact_dedup.ingest(first, index).filter("kept").count()
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)  # opened anew from its path
    got = exact_dedup.ingest(second, again)
    assert a + got.filter("kept").count() == documents.select(
        F.translate("text", "".join(map(chr, range(65, 91))), "".join(map(chr, range(97, 123))))).distinct().count()
    assert got.filter("kept and doc_id % 2 = 0").count() == 0
    groups = exact_dedup.digest(documents).select("digest", F.col("doc_id").alias("keep_id"))
    plan = again.unknown(groups)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") <= 1  # at most the new side is moved


def test_a_batch_that_runs_again_keeps_what_it_kept(spark):
    make = lambda rows: spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, __digest string")
    index = exact_dedup.DigestIndex(spark, buckets=4)
    one, two = make([(1, "a"), (2, "A"), (3, "b"), (None, "c"), (None, "c")]), make([(4, "B"), (5, "d"), (None, "c")])
    decide = lambda df, batch: sorted(str((r.doc_id, r.keep_id, r.kept)) for r in exact_dedup.ingest(df, index, batch).collect())
    first = decide(one, "one")
    assert decide(one, "one") == first and sum("True" in r for r in first) == 3
    second = decide(two, "two")
    assert second == sorted(["(4, 3, False)", "(5, 5, True)", "(None, None, False)"])
    assert decide(one, "one") == first and decide(two, "two") == second  # also after the other batch
    assert index.table().count() == 4
    left = exact_dedup.drop_copies(one, exact_dedup.DigestIndex(spark, buckets=4))
    assert left.columns == one.columns and left.filter("__digest = 'x'").count() == 3  # the caller's own column stays


def test_large_groups_go_by_broadcast(spark):
    rows = spark.range(5000).select((F.when(F.col("id") < 4000, 0).otherwise(F.col("id"))).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert join_groups(rows, groups, "k", "n", 5000).agg(F.sum("n")).first()[0] == 4000 * 4000 + 1000


# ------------------------------------------------------------- near copies
def sets_by_brute_force(rows):
    out = []
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER))
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def components_by_brute_force(rows):
    sets = sets_by_brute_force(rows)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if sets[i] and 100 * inter >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r.doc_id is not None:
            least[root(i)].append(r.doc_id)
    return sorted((r.doc_id is None, r.doc_id or 0, len(sets[i]),
                   (min(least[root(i)]) if sets[i] and least[root(i)] else r.doc_id) or -1) for i, r in enumerate(rows))


def as_rows(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id or -1) for r in df.collect())


def test_near_edge_cases(spark, edge, empty):
    assert as_rows(ngram_join.near_duplicates(edge)) == components_by_brute_force(edge.collect())
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.drop_near_copies(edge).columns == edge.columns


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_near_copies_in_chains_and_large_groups(spark, monkeypatch, rounds):
    """Copies with growing edits: some link only through others, whatever the number of pivot rounds."""
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", rounds)
    rng = random.Random(rounds)
    texts = []
    for base in range(4):
        words = [f"b{base}w{rng.randrange(10 ** 6)}" for _ in range(90)]
        for k in range(14):
            w = list(words)
            for _ in range(rng.choice((1, 2, 3, 6))):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
            texts.append(" ".join(w))
            if k % 3 == 0:
                words = w  # the group drifts
    texts += [f"quite different {i} " * 6 for i in range(10)]
    rng.shuffle(texts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(3)
    assert as_rows(ngram_join.near_duplicates(df)) == components_by_brute_force(df.collect())


def test_verification_equals_counting():
    rng = np.random.default_rng(1)
    for _ in range(1500):
        pool = np.sort(rng.choice(10 ** 6, 60, replace=False)).astype(np.int64)
        x = np.sort(rng.choice(pool, rng.integers(1, 60), replace=False))
        y = x.copy() if rng.random() < 0.2 else np.sort(rng.choice(pool, rng.integers(1, 60), replace=False))
        if rng.random() < 0.6:
            y = np.unique(np.concatenate([x[rng.random(len(x)) < 0.93], y[:rng.integers(0, 4)]]))
        if len(y):
            inter = len(np.intersect1d(x, y))
            assert ngram_join.similar(x, y) == (100 * inter >= 80 * (len(x) + len(y) - inter))


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}
    assert components(df.limit(0)).count() == 0


# ------------------------------------------------------------ benchmark
def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_report(rows, items, size=10):
    out = []
    for r in rows:
        w = words(r.text)
        hit, found = set(), set()
        for item_id, text in items:
            v = words(text)
            for i in range(max(1, len(v) - size + 1) if v else 0):
                win = v[i:i + size]
                for s in range(len(w) - len(win) + 1):
                    if w[s:s + len(win)] == win:
                        hit.update(range(s, s + len(win)))
                        found.add(str(item_id))
        out.append((r.doc_id is None, r.doc_id or 0, len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


ITEMS = [(1, "Alpha3 alpha4, alpha5 alpha6 alpha7 alpha8 alpha9 alpha10 alpha11 alpha12 alpha13 alpha14"), (2, "ONE"), (3, None),
         (10, "!!!"), (11, "two three"), (12, "word word word word word word word word word word word"), (2, "漢字"),
         (13, "not in any document at all, not even once or so")]


@pytest.mark.parametrize("block_words", [200_000, 8])
def test_report_edge_cases(spark, edge, empty, block_words):
    bench = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = edge.filter("doc_id is null or doc_id <> 9")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)
                 for r in decontaminate.report(docs, bench, block_words=block_words).collect())
    assert got == brute_report(docs.collect(), ITEMS)
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).filter("contaminated").count() == 0
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns


def test_adjacent_hits_do_not_cross_documents(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, ""), (4, "a b c")], "doc_id bigint, text string").coalesce(1)
    bench = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "b b"), (4, "b a")], "item_id bigint, text string")
    got = {r.doc_id: ([(s.start, s.end) for s in r.spans], r["items"]) for r in decontaminate.find(df, bench).collect()}
    assert got == {1: ([(0, 2)], ["1"]), 2: ([(0, 2)], ["2"]), 3: ([], []), 4: ([(0, 3)], ["1", "2"])}


def test_proximity(spark):
    rng = random.Random(4)
    docs = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 30))) for _ in range(60)]
    items = [" ".join(rng.sample("abcdefgh", 4)) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").coalesce(2)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    for r in decontaminate.find(df, bench, slack=2).collect():
        w = docs[r.doc_id].split()
        near, exact = set(), set()
        for i, t in enumerate(items):
            t = t.split()
            if any(w[s:s + 4] == t for s in range(len(w))):
                exact.add(str(i))
            elif any(set(t) <= set(w[s:s + 6]) for s in range(len(w))):
                near.add(str(i))
        assert r["items"] == sorted(exact) and r.near == sorted(near)


def test_near_items_are_reported_by_a_registered_query(spark, tmp_path):
    import __spark_entry__ as entry
    passage = [f"p{i}" for i in range(20)]
    moved = passage[:5] + ["extra", "words"] + passage[7:4:-1] + passage[8:]
    texts = ["aa bb " + " ".join(passage), " ".join(moved[:12]), "nothing of it p1 p2", " ".join(["aa", *moved[:6], "bb"])]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(passage[:10]))], "item_id bigint, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in entry.queries()["near_leaks"](spark, str(tmp_path)).collect()}
    assert {i: (r.n_hit, r.contaminated, r.n_near, r.near) for i, r in got.items()} == {
        0: (10, True, 0, []), 1: (0, False, 1, ["7"]), 2: (0, False, 0, []), 3: (0, False, 0, [])}
    exact = {r.doc_id: tuple(r) for r in entry.queries()["op10_decontaminate"](spark, str(tmp_path)).collect()}
    assert exact == {i: tuple(r)[:6] for i, r in got.items()}


def test_close_stretches_equal_trying_every_start():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        lists = sorted((np.unique(rng.integers(0, 80, rng.integers(1, 12))) for _ in range(rng.integers(1, 5))), key=len)
        span = int(rng.integers(1, 20))
        every = sorted({int(p) for x in lists for p in x})
        want = [p for p in every if all(((x >= p) & (x < p + span)).any() for x in lists)]
        assert decontaminate.Shard._close(lists, span).tolist() == want


def test_contaminated_rows_do_not_take_clean_ones_along(spark):
    leak = " ".join(f"p{i}" for i in range(12))
    rows = [(None, leak), (None, "a clean text"), (None, None), (5, leak + " more"), (5, "clean as well"), (6, "clean")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, digest string").repartition(2)
    bench = spark.createDataFrame([(1, leak)], "item_id bigint, text string")
    left = decontaminate.drop_contaminated(df, bench)
    assert left.columns == df.columns
    assert Counter(map(tuple, left.collect())) == Counter((*r, "x") for r in rows if "p1" not in (r[1] or ""))


def test_near_copies_under_one_id_leave_one(spark):
    base = [f"w{i}" for i in range(100)]
    near = " ".join([*base[:50], "other", *base[51:]])
    base = " ".join(base)
    last = [f"v{i}" for i in range(80)]
    rows = [(None, base), (None, near), (None, "quite another text"), (7, " ".join(last)), (7, " ".join(last[:-1])),
            (7, "unlike the others under its id"), (8, " ".join(last)), (None, " "), (None, " "), (7, "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, cls string").repartition(2)
    left = ngram_join.drop_near_copies(df)
    assert left.columns == df.columns
    got = Counter((r.doc_id, r.text) for r in left.collect())
    assert sum(got[(None, t)] for t in (base, near)) == 1 and sum(got[r] for r in rows[3:5]) == 1
    assert got[(8, rows[6][1])] == 0 and all(got[r] == 1 for r in (rows[2], rows[5], rows[9])) and got[(None, " ")] == 2
    assert sum(got.values()) == 7
