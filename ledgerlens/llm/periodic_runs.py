"""Periodic runs of words: stretches that repeat with their smallest period.

A run has exponent (length / period) EXPONENT or more and MIN_LENGTH words, and
no neighbouring word extends it. Periods are treated by octave [P, 2P):

1. Explode. Anchors stand at every multiple of 2P; the tile of an anchor b spans
   the words from b - 2P to b + 5P, so tiles of neighbours overlap. A text of at
   most BLOCK words is one block whose tiles are solved where the text is read;
   a longer one is cut, octave by octave, into blocks of tiles (with the overlap),
   which are shuffled and solved apart, so no task solves one long text alone.
2. Solve. Where words i and i+q are equal for 3q positions in a row - as they are
   in a run of period q - one anchor of the octave has [b, b + P) among them. The
   hash of P words at b is compared with those at b + q, all q of the octave at
   once; what agrees is measured by Z-functions at the boundary b (a whole one where
   candidates are many, else its values at the candidates), forwards up to
   3P words and backwards up to 2P, on the words themselves, so hashes decide
   nothing. A q whose first q words repeat with a divisor of q is no smallest
   period of its run and is left to that divisor.
3. Stitch. Interval fragments are shuffled by (document, period); those that touch
   are parts of one stretch. Stretches that are long enough are the runs.

Defined cases: null and empty texts have no words and no runs; rows are told apart
by id and text, so rows with equal or null ids keep results of their own and fully
repeated rows all get the same; an empty table gives an empty result; other columns,
whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import as_bytes, chunks, id_text, id_type, stored

EXPONENT = 4
MIN_LENGTH = 6
BLOCK = 1 << 13     # words solved in one piece
FEW = 8             # candidates of a tile measured one by one; more get the whole Z-function

_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xBF58476D1CE4E5B9)


def words_of(text: bytes) -> list[bytes]:
    """What stands between ASCII white space."""
    return text.split()


def numbered(words: list[bytes]) -> np.ndarray:
    """The words as small numbers, equal for equal words of this text."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int32, len(words))


# ---------------------------------------------------------------- tiles
def z_function(s: np.ndarray) -> list[int]:
    """z[i]: how many items from i on equal those from the start; z[0] is the length."""
    items = s.tolist()
    n = len(items)
    z = [0] * n
    if n:
        z[0] = n
    lo = hi = 0
    for i in range(1, n):
        k = min(hi - i, z[i - lo]) if i < hi else 0
        while i + k < n and items[k] == items[i + k]:
            k += 1
        z[i] = k
        if i + k > hi:
            lo, hi = i, i + k
    return z


def _same(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the common start."""
    n = min(len(x), len(y))
    unequal = x[:n] != y[:n]
    at = int(unequal.argmax()) if n else 0
    return at if n and unequal[at] else n


def _primes(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] if q > 1 else out


def solve_tile(w: np.ndarray, b: int, octave: int, periods: list[int]) -> Iterator[tuple[int, int, int, bool, bool]]:
    """For an anchor ``b`` and candidate ``periods`` of [P, 2P): (q, start, end,
    cut_left, cut_right), positions i from start to end with w[i] = w[i+q] around
    b, as far as the tile sees; a side is cut where the tile ends before they do."""
    P = octave
    left = max(0, b - 2 * P)
    front = w[b:b + 5 * P]
    if len(periods) > FEW:
        z = z_function(front)
        back = w[left:b][::-1]
        shifted = w[left:b + 2 * P][::-1]
        zb = z_function(np.concatenate([back, np.array([-1], w.dtype), shifted]))
        ahead = lambda q: z[q] if q < len(front) else 0
        behind = lambda q: min(zb[len(back) + 1 + len(shifted) - (b - left) - q], b - left)
        primitive = lambda q: all(z[q // r] < q - q // r for r in _primes(q))
    else:
        ahead = lambda q: _same(front, front[q:])
        behind = lambda q: _same(w[left:b][::-1], w[left + q:b + q][::-1])
        primitive = lambda q: all(_same(front[:q - q // r], front[q // r:q]) < q - q // r for r in _primes(q))
    for q in periods:
        right = min(ahead(q), 3 * P)
        if right < P or not primitive(q):
            continue
        back_by = behind(q)
        yield q, b - back_by, b + right, back_by == 2 * P and b > 2 * P, right == 3 * P and b + right + q < len(w)


def candidates(w: np.ndarray, low: int, high: int, first: int, last: int, size: int) -> Iterator[tuple[int, int, list[int]]]:
    """(octave, anchor, periods) worth measuring, for the octaves from ``low``
    to ``high`` and anchors in [first, last) of ``w``, words of a text of ``size``."""
    h = (w.astype(np.uint64) + np.uint64(1)) * _MIX
    h ^= h >> np.uint64(29)
    P = 1
    while P <= high and EXPONENT * P <= size:
        if P >= low:
            start = -(-first // (2 * P)) * 2 * P
            stop = min(last, len(h))
            if start < stop:
                rows = -(-(stop - start) // (2 * P))
                piece = h[start:start + rows * 2 * P]
                grid = np.zeros(rows * 2 * P, np.uint64)
                grid[:len(piece)] = piece
                grid = grid.reshape(rows, 2 * P)
                tile, at = np.nonzero(grid[:, P:] == grid[:, :1])
                keep = start + tile * 2 * P + at + P < len(h)
                tile, at = tile[keep], at[keep]
                for t, a in _runs_of(tile):
                    yield P, start + t * 2 * P, (at[a] + P).tolist()
        # hashes of 2P words from those of P
        if len(h) <= P:
            break
        h = h[:-P] * _STEP + h[P:]
        h ^= h >> np.uint64(31)
        h *= _MIX
        P *= 2


def _runs_of(tile: np.ndarray) -> Iterator[tuple[int, slice]]:
    if len(tile):
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)]]).tolist()
        for i, j in zip(cuts, cuts[1:]):
            yield int(tile[i]), slice(i, j)


def fragments(w: np.ndarray, low: int, high: int, first: int, last: int, offset: int = 0,
              size: int | None = None) -> list[tuple[int, int, int]]:
    """(period, start, end) of equal stretches in a block: ``w`` are the words of
    a text of ``size`` from ``offset`` on. Fragments that touch are joined; one
    that ends inside the block and is too short for a run is left out."""
    size = len(w) if size is None else size
    parts: dict[int, list[list]] = {}
    for P, b, periods in candidates(w, low, high, first, last, size):
        for q, s, e, more_left, more_right in solve_tile(w, b, P, periods):
            of = parts.setdefault(q, [])
            # the left end of a block is cut as well if the text goes on there
            more_left, more_right = more_left or (s == 0 and offset > 0), more_right or (e + q == len(w) and offset + len(w) < size)
            if of and s <= of[-1][1]:
                of[-1][1] = max(of[-1][1], e)
                of[-1][3] = more_right
            else:
                of.append([s, e, more_left, more_right])
    return [(q, offset + s, offset + e) for q, of in parts.items() for s, e, a, z in of
            if a or z or e - s + q >= max(MIN_LENGTH, EXPONENT * q)]


# ------------------------------------------------------------- explosion
def blocks(n: int, block: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Blocks of tiles of a text of ``n`` words: (low, high, from, to, first,
    last): the octaves low..high, the words [from, to) and, in the text, the
    anchors [first, last). Octaves of small periods share blocks."""
    small = 1 << max(0, (block >> 4).bit_length() - 1)
    octaves = [(1, small)]
    P = 2 * small
    while EXPONENT * P <= n:
        octaves.append((P, P))
        P *= 2
    for low, high in octaves:
        step = -(-max(block, 2 * high) // (2 * high)) * 2 * high
        for at in range(0, n, step):
            yield low, high, max(0, at - 2 * high), min(n, at + step + 5 * high), at, min(n, at + step)


_SCAN = "kind string, key binary, doc_id {id}, n bigint, text string, period bigint, start bigint, stop bigint, low bigint, high bigint, first bigint, last bigint, words binary"


def scan(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Stored rows of three kinds: ``d`` per document (text: its words joined by
    one space; key: null if it has no run), ``f`` fragments of stretches, ``t``
    blocks of tiles of long texts that are still to be solved, a batch each."""
    names = [c.split()[0] for c in _SCAN.split(", ")]
    types = [pa.string(), pa.binary(), pa.int64(), pa.string(), *[pa.int64()] * 7, pa.binary()]

    def batch(ids: pa.Array, owner: list, out: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(zip(*out), types)]
        return pa.RecordBatch.from_arrays([*arrays[:2], ids.take(pa.array(owner, pa.int32())), *arrays[2:]], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, text in chunks(batches):
            out: list[tuple] = []
            owner: list[int] = []
            for row, raw in enumerate(as_bytes(text)):
                words = words_of(raw)
                n = len(words)
                w = numbered(words)
                parts = fragments(w, 1, n, 0, n) if MIN_LENGTH <= n <= block else []
                key = None
                if parts or n > block:
                    key = hashlib.sha256(f"{ids[row].as_py()}\n".encode() + raw).digest()
                out.append(("d", key, n, b" ".join(words).decode(), *[None] * 8))
                out += [("f", key, None, None, q, s, e, *[None] * 5) for q, s, e in parts]
                owner += [row, *[None] * len(parts)]
                if n > block:
                    for low, high, lo, hi, first, last in blocks(n, block):
                        yield batch(ids, [None], [("t", key, n, None, None, lo, None, low, high, first, last, w[lo:hi].tobytes())])
            yield batch(ids, owner, out)

    return stored(id_text(docs).mapInArrow(run, _SCAN.format(id=id_type(docs))), "run-scan", "zstd")


def solved(tiles: DataFrame) -> DataFrame:
    """(key, period, start, stop) of the fragments in blocks of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for key, n, at, low, high, first, last, data in zip(*(c.to_pylist() for c in b.columns)):
                w = np.frombuffer(data, np.int32)
                found = fragments(w, low, high, first - at, last - at, at, n)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key] * len(found), pa.binary()), *(pa.array(c, pa.int64()) for c in zip(*found))],
                        names=["key", "period", "start", "stop"])

    blocks = tiles.select("key", "n", "start", "low", "high", "first", "last", "words")
    # one row per block, spread evenly whichever text it is from
    return (blocks.repartition("key", "low", "first")
            .mapInArrow(run, "key binary, period bigint, start bigint, stop bigint"))


# ---------------------------------------------------------------- stitch
def stitched(parts: DataFrame) -> DataFrame:
    """Runs (key, start, length, period) from fragments (key, period, start,
    stop): those of one document and period that touch are one stretch."""
    here = Window.partitionBy("key", "period").orderBy("start", "stop")
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    marked = parts.distinct().withColumn("new", F.coalesce((F.col("start") > F.max("stop").over(before)).cast("int"), F.lit(0)))
    numbered = marked.withColumn("piece", F.sum("new").over(here.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("key", "period", "piece").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    length = F.col("stop") - F.col("start") + F.col("period")
    return (whole.select("key", "start", length.alias("length"), "period")
            .filter((F.col("length") >= MIN_LENGTH) & (F.col("length") >= EXPONENT * F.col("period"))))


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist()) if k]


def find(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, runs (start, length, period; by
    start, then period) and collapsed, the text without what its runs repeat."""
    rows = scan(docs, block)
    parts = rows.filter("kind = 'f'").select("key", "period", "start", "stop")
    parts = parts.unionByName(solved(rows.filter("kind = 't'").select(
        "key", "n", "start", "low", "high", "first", "last", "words")))
    runs = stitched(parts).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("of"))
    run_type = "array<struct<start:bigint,length:bigint,period:bigint>>"
    as_runs = F.transform("of", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    runs = stored(runs.select("key", as_runs.cast(run_type).alias("runs")), "runs")
    # a text without a possible run has no key: it is done, and does not move
    found = rows.filter("kind = 'd' and key is not null").select("key", "doc_id", "n", "text")
    schema = f"doc_id {id_type(docs)}, n_words bigint, runs {run_type}, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for text, of in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                texts.append(text if not of else " ".join(
                    collapsed(text.split(" "), [(r["start"], r["length"], r["period"]) for r in of])))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(3), pa.array(texts, pa.string())],
                                             names=["doc_id", "n_words", "runs", "collapsed"])

    none = F.array().cast(run_type)
    with_runs = (found.join(runs, "key", "left").select("doc_id", "n", "text", F.coalesce("runs", none).alias("runs"))
                 .mapInArrow(run, schema))
    without = rows.filter("kind = 'd' and key is null").select(
        "doc_id", F.col("n").alias("n_words"), none.alias("runs"), F.col("text").alias("collapsed"))
    return with_runs.unionByName(without)


def report(found: DataFrame) -> DataFrame:
    """``find`` as digests: n_runs, the run with the greatest length / period
    (ties: smallest start, then period), and SHA-256 of runs and collapsed text."""
    # exact comparison of two exponents: products of whole numbers
    better = lambda x, y: (x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)")
                           > y["length"].cast("decimal(19,0)") * x["period"].cast("decimal(19,0)"))
    first = F.get("runs", 0)
    best = F.aggregate(F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))), first,
                       lambda top, r: F.when(better(r, top), r).otherwise(top))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return top.select("doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
                      F.col("best.period").alias("period"), F.expr("(best.length * 1000) div best.period").alias("exponent_milli"),
                      "runs_sha256", "collapsed_sha256")


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with periods planted by a rule on the id: where
    crc32(id) is divisible by 10, the words from a on repeat with period p. A null
    id has no such number; its text stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, text in chunks(batches):
            out = []
            for doc, raw in zip(ids.to_pylist(), as_bytes(text)):
                h = zlib.crc32(str(doc).encode()) if doc is not None else 1
                if h % 10 == 0 and (words := words_of(raw)):
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    raw = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)])
                out.append(raw)
            yield pa.RecordBatch.from_arrays([ids, pa.array(out, pa.binary()).cast(pa.string())], names=["doc_id", "text"])

    return id_text(docs).mapInArrow(run, f"doc_id {id_type(docs)}, text string")
