"""Periodic runs against brute force over every period and start."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from ledgerlens.llm import periodic_runs as pr
from ledgerlens.llm.queries import QUERIES


def brute_runs(w):
    """(start, length, period) of every run, by the definition."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q):
                part = w[i:i + length]
                smallest = next(p for p in range(1, q + 1) if part[p:] == part[:length - p])
                if smallest == q:
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_report(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(w)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def brute_planted(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        n, g = len(w), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return " ".join(w[i] if i < a else w[a + (i - a) % p] for i in range(n))
    return text


def some_texts(rng):
    out = []
    for _ in range(40):
        w = []
        while len(w) < rng.choice((5, 40, 300)):
            p = rng.choice((1, 1, 2, 3, 4, 5, 7, 8, 12, 16, 31))
            part = [f"w{rng.randrange(rng.choice((2, 3, 50)))}" for _ in range(p)]
            w += (part * rng.choice((1, 3, 4, 5, 6, 9)))[:rng.randint(1, 10 * p)]
            w += [f"z{rng.randrange(1000)}" for _ in range(rng.randrange(4))]
        out.append(" ".join(w))
    out += ["a " * 500, "a b " * 300, "a b a c " * 90 + "a b a", "x " + "a a b " * 100 + "a a a a a a a a"]
    return out


@pytest.mark.parametrize("few", [0, 2, 100])
def test_fragments_equal_brute_force(monkeypatch, few):
    monkeypatch.setattr(pr, "FEW", few)  # Z-functions always, sometimes, never
    rng = random.Random(few)
    for text in some_texts(rng):
        w = text.split()
        got = sorted((s, e - s + q, q) for q, s, e in pr.fragments(pr.numbered(w), 1, len(w), 0, len(w)))
        assert sorted(got, key=lambda r: (r[0], r[2])) == brute_runs(w)


@pytest.mark.parametrize("block", [16, 32, 64, 1 << 13])
def test_tiles_of_long_texts_are_stitched(spark, block):
    texts = some_texts(random.Random(block)) + [None, "", " \t\n", "one two"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, texts[5]), (7, texts[8])]
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "doc_id bigint, text string, key string, period string, start int").repartition(3)
    found = pr.find(df, block)
    assert found.columns == ["doc_id", "n_words", "runs", "collapsed"]
    order = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, pr.report(found).collect()), key=order) == sorted((brute_report(*r) for r in rows), key=order)


def test_z_function():
    rng = np.random.default_rng(1)
    for _ in range(200):
        s = rng.integers(0, 2, rng.integers(0, 30))
        z = pr.z_function(s)
        assert z == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


def test_edge_rows_and_empty(spark, edge, empty):
    got = sorted(map(str, (tuple(r) for r in pr.report(pr.find(edge.filter("doc_id is null or doc_id not in (9, 17)"))).collect())))
    rows = [r for r in edge.collect() if r.doc_id not in (9, 17)]
    assert got == sorted(str(brute_report(r.doc_id, r.text)) for r in rows)
    long = {r.doc_id: r for r in pr.find(edge.filter("doc_id in (9, 17)")).collect()}
    assert long[9].runs == [] and long[9].n_words == 60_000
    assert [tuple(r) for r in long[17].runs] == [(0, 5000, 1)] and long[17].collapsed == "word"
    assert pr.report(pr.find(empty)).count() == 0


def test_registered_query_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    want = sorted((brute_report(r.doc_id, brute_planted(r.doc_id, r.text)) for r in docs))
    out = QUERIES["op12_periodic_runs"](spark, path)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, out.collect())) == want
    assert sum(r[1] > 0 for r in want) >= 10
