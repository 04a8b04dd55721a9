"""Near-duplicate groups by SuperMinHash signatures, banding and verification.

1. Signatures. A position of a signature keeps the least value that any n-gram of
   the set gives it. In round j an n-gram gives the j-th position of its own random
   permutation (Fisher-Yates) a value in [j, j + 1), so the values of one n-gram are
   correlated and all different in rank: the estimate varies less than with
   independent hashes. A set stops after the first round at whose end no position
   holds more than j + 1, as later rounds cannot change any (few rounds for sets
   larger than the signature). Rounds run over the n-grams of many texts at once.
2. Bands of ROWS positions: classes (equal sets are one class) that agree on a band
   stand in one list. Sets at the threshold miss all lists with a probability of
   (1 - t^ROWS)^BANDS = 5e-11 at t = 0.85.
3. Every member of a list meets the list's pivot, the class that shares most lists
   with others; pairs are confirmed on the full sets, and union-find (as alternating
   star steps) groups them. Lists that still hold several groups are paired beyond
   their main group where that takes at most DIRECT pairs a list. For larger ones,
   whose pairs would grow with the square of a large group of mostly unlike members,
   there is an exact way: sets at the threshold share one of the first
   n - s + 1 of their n-grams, rarest first, s being the number they must share at
   least. Only the classes of such lists are joined on those heads. No list is cut.

Defined cases: null and empty texts and texts without words have an empty set and
are linked with nothing; a text of fewer words than n is one n-gram; rows with equal
ids share the class of their text, not of their id; the least id of a group is its
component (a group whose ids are all null has a null one, and all its rows are kept);
an empty table gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (as_bytes, chunks, components, id_text, id_type, in_few_tasks, join_groups,
                                   release_shuffles, stored)
from ledgerlens.llm.ngram_join import SEGMENT, SETS_A_TASK, SLOTS, class_of, count_levels, ordered_keys, prefix_length, sets_of, shingles

N = 5
PERCENT = 85
BANDS, ROWS = 32, 4
DIRECT = 64            # pairs of a list that are made without a look at its sets
KNOWN = 200_000        # classes that a task remembers to skip exact copies
STATE_BYTES = 32 << 20  # permutations held at once

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def _mixed(z: np.ndarray) -> np.ndarray:
    """The finaliser of the SplitMix64 generator."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


# ------------------------------------------------------------ signatures
def signatures(sets: list[np.ndarray], m: int) -> np.ndarray:
    """The signature, ``m`` numbers, of every non-empty set of 64-bit hashes: the
    round in the high half of a number, its fraction in the low half."""
    out = np.full((len(sets), m), np.iinfo(np.uint64).max, np.uint64)
    kind = np.uint8 if m <= 256 else np.uint16
    step = max(1, STATE_BYTES // (m * np.dtype(kind).itemsize))
    at = 0
    while at < len(sets):
        end, held = at + 1, len(sets[at])
        while end < len(sets) and held + len(sets[end]) <= step:
            held += len(sets[end])
            end += 1
        if held > step:  # one large set: its parts' least values are its own
            for i in range(0, held, step):
                _rounds([sets[at][i:i + step]], out[at:end], kind)
        else:
            _rounds(sets[at:end], out[at:end], kind)
        at = end
    return out


def _rounds(sets: list[np.ndarray], least: np.ndarray, kind) -> None:
    m = least.shape[1]
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    places = np.tile(np.arange(m, dtype=kind), (len(grams), 1))
    flat = least.reshape(-1)
    rows = np.arange(len(grams))
    for j in range(m):
        z = _mixed(grams[rows] + np.uint64((j + 1) * int(_GOLDEN) % (1 << 64)))
        k = (((z & _LOW) * np.uint64(m - j)) >> _32).astype(np.int64) + j
        place = places[rows, k]
        places[rows, k] = places[rows, j]
        np.minimum.at(flat, owner[rows] * m + place, (np.uint64(j) << _32) | (z >> _32))
        open_sets = (least >= np.uint64(j + 1) << _32).any(axis=1)
        if not open_sets.all():
            rows = rows[open_sets[owner[rows]]]
            if not len(rows):
                break


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key per signature and band of ``rows`` positions."""
    count = signature.shape[1] // rows
    parts = signature[:, :count * rows].reshape(len(signature), count, rows)
    key = np.arange(1, count + 1, dtype=np.uint64) * _GOLDEN + np.uint64(rows)
    key = np.broadcast_to(key, parts.shape[:2]).copy()
    for i in range(rows):
        key = _mixed(key + parts[:, :, i])
    return key.view(np.int64)


def profile(docs: DataFrame, n: int = N) -> DataFrame:
    """Stored rows of two kinds: (doc_id, cls, size) per document, and (list,
    cls, size) per band of a class. A task leaves out bands of classes that it has
    just met; other repeats may remain."""
    schema = f"doc_id {id_type(docs)}, cls bigint, size int, list bigint"
    names = ["doc_id", "cls", "size", "list"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for doc, text in chunks(batches):
            sets = [shingles(t, n) for t in as_bytes(text)]
            cls = [class_of(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(cls, pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                 pa.nulls(len(sets), pa.int64())], names=names)
            if len(met) >= KNOWN:
                met.clear()
            new = []
            for c, s in zip(cls, sets):
                if c is not None and c not in met:
                    met.add(c)
                    new.append((c, s))
            if new:
                keys = bands(signatures([s for _, s in new], BANDS * ROWS), ROWS)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(keys.size, doc.type), pa.array(np.repeat(np.array([c for c, _ in new], np.int64), BANDS)),
                     pa.array(np.repeat(np.array([len(s) for _, s in new], np.int32), BANDS)), pa.array(keys.reshape(-1))],
                    names=names)

    return stored(id_text(docs).mapInArrow(run, schema), "signatures")


# ---------------------------------------------------------- confirmation
def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Stored pairs (a, b) of the stored ``pairs`` whose full sets reach the threshold. ``sets`` are stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(y, x)
                shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.select("a", "b").join(sets.select(F.col("cls").alias("a"), F.col("keys").alias("x")), "a")
              .join(sets.select(F.col("cls").alias("b"), F.col("keys").alias("y")), "b").select("a", "b", "x", "y"))
    # all sets are read, also for few pairs
    joined = in_few_tasks(joined, pairs.count() + sets.count(), SETS_A_TASK)
    return stored(joined.mapInArrow(run, "a bigint, b bigint"), "links")


# ---------------------------------------------------------------- groups
def _fits(n1: str, n2: str, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    return (lists.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("label", F.coalesce("root", "cls")).drop("root"))


def _open(here: DataFrame) -> DataFrame:
    """(list, members, main, outside): lists of several groups, the group with most members, members outside it."""
    count = here.groupBy("list", "label").agg(F.count(F.lit(1)).alias("n"))
    per = count.groupBy("list").agg(F.sum("n").alias("members"), F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("groups"))
    return per.filter("groups > 1").select("list", "members", F.col("top.label").alias("main"),
                                           (F.col("members") - F.col("top.n")).alias("outside"))


def _beyond(here: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), a < b, of ``lists`` with one side outside the main group; with
    places (pos) in ``here``, those that meet in the heads of both sets."""
    rows = here.join(lists.select("list", "main"), "list")
    pos = F.col("pos") if "pos" in here.columns else F.lit(-1)
    left = rows.filter("label <> main").select("list", "main", F.col("cls").alias("x"), F.col("size").alias("n1"),
                                               pos.alias("p1"), F.col("label").alias("l1"))
    right = rows.select("list", F.col("cls").alias("y"), F.col("size").alias("n2"), pos.alias("p2"), F.col("label").alias("l2"))
    once = (F.col("l2") == F.col("main")) | (F.col("x") < F.col("y"))
    need = F.ceil(percent * (F.col("n1") + F.col("n2")) / (100.0 + percent) - 1e-9)
    heads = (F.col("p1") <= F.col("n1") - need) & (F.col("p2") <= F.col("n2") - need)
    met = left.join(right, "list").filter((F.col("l1") != F.col("l2")) & once & heads & _fits("n1", "n2", percent))
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _heads(found: DataFrame, percent: int) -> DataFrame:
    """Stored (list, cls, size, pos): the first n-grams of every set of ``found``
    (cls, keys), rarest first by a count in hashed slots, and their places."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        for b in batches:
            for x in b.column(0):
                np.add.at(counts, (np.frombuffer(x.as_buffer(), np.uint64) >> np.uint64(8)).astype(np.int64) % SLOTS, 1)
        parts = np.minimum(counts, 65535).astype("<u2").reshape(-1, SEGMENT)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())],
                                         names=["segment", "counts"])

    counts = found.select("keys").mapInArrow(count, "segment int, counts binary")
    levels = found.sparkSession.sparkContext.broadcast(count_levels(counts))  # SLOTS bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in b.column(1)]
            heads = [ordered_keys(s, levels.value)[:prefix_length(len(s), percent)] for s in sets]
            reps = [len(h) for h in heads]
            if heads:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(heads)), pa.array(np.repeat(b.column(0).to_numpy(), reps)),
                     pa.array(np.repeat(np.array([len(s) for s in sets], np.int32), reps)),
                     pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in reps]))], names=["list", "cls", "size", "pos"])

    return stored(found.mapInArrow(run, "list bigint, cls bigint, size int, pos int"), "heads", "zstd")


def link_classes(lists: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The components (node, root) of all links. ``lists``: stored (list, cls,
    size, rank) of lists with two classes at least."""
    spark = lists.sparkSession
    rows = lists.count()
    pivots = (lists.groupBy("list").agg(F.min(F.struct("rank", "cls", "size")).alias("p"))
              .select("list", F.col("p.cls").alias("pivot"), F.col("p.size").alias("n2")))
    pairs = (lists.join(pivots, "list").filter((F.col("cls") != F.col("pivot")) & _fits("size", "n2", percent))
             .select(F.least("cls", "pivot").alias("a"), F.greatest("cls", "pivot").alias("b")).distinct())
    pairs = stored(in_few_tasks(pairs, rows), "pivot-pairs")
    links = confirmed(pairs, sets, percent)
    labels = components(links, most=links.count())
    here = _labelled(lists, labels)
    open_lists = stored(in_few_tasks(_open(here), rows), "open-lists")
    if open_lists.isEmpty():
        return labels
    few = open_lists.filter(F.col("members") * F.col("outside") <= DIRECT)
    more = _beyond(here, few, percent)
    many = open_lists.filter(F.col("members") * F.col("outside") > DIRECT)
    most = rows * DIRECT
    if not many.isEmpty():
        classes = here.join(many.select("list"), "list", "left_semi").select("cls").distinct()
        asked = in_few_tasks(sets.join(classes, "cls", "left_semi").select("cls", "keys"), sets.count(), SETS_A_TASK)
        heads = _heads(asked, percent)
        beyond = _labelled(heads, labels)
        more = more.unionByName(_beyond(beyond, _open(beyond), percent)).distinct()
        most += heads.count() * DIRECT
    more = more.join(pairs, ["a", "b"], "left_anti")
    more = stored(in_few_tasks(more, most), "more-pairs")
    release_shuffles(spark)
    further = confirmed(more, sets, percent)
    found = further.count()
    if not found:
        return labels
    # the new links, between the components that are known
    for side in ("a", "b"):
        of = labels.select(F.col("node").alias(side), "root")
        further = further.join(of, side, "left").withColumn(side, F.coalesce("root", side)).drop("root")
    tops = components(further, most=found)
    moved = (labels.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
             .select("node", F.coalesce("top", "root").alias("root")))
    # and classes that had no link before
    moved = moved.unionByName(tops.join(labels.select("node"), "node", "left_anti"))
    return stored(in_few_tasks(moved, rows), "all-components")


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, cls (its
    class; null without words)."""
    spark = docs.sparkSession
    profiled = profile(docs, n)
    rows = profiled.filter("list is null").select("doc_id", "cls", "size")
    total = rows.count()
    classes = rows.filter("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = stored(in_few_tasks(classes, total), "classes")
    banded = profiled.filter("list is not null").select("list", "cls", "size")
    shared = banded.groupBy("list").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"), F.count(F.lit(1)).alias("n"))
    lists = banded.join(shared.filter("lo < hi").select("list", "n"), "list").dropDuplicates(["list", "cls"])
    lists = stored(in_few_tasks(lists, total * BANDS), "lists")
    # classes that meet most others come first, as a text which many copies derive from
    weight = lists.groupBy("cls").agg((-F.sum("n")).alias("rank"))
    met = lists.count()
    ranked = lists.drop("n").join(weight, "cls").select("list", "cls", "size", "rank")
    lists = stored(in_few_tasks(ranked, met), "ranked")
    wanted = classes.join(weight.select("cls"), "cls", "left_semi").select("cls", "rep")
    sets = sets_of(docs, wanted, n=n, most=min(total, met))
    release_shuffles(spark)

    roots = link_classes(lists, sets, percent)
    of = (classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
          .withColumn("root", F.coalesce("root", "cls")))
    least = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    groups = of.join(least, "root").select("cls", "component_id", "copies")
    groups = stored(in_few_tasks(groups, total), "groups")
    with_words = join_groups(rows.filter("cls is not null"), groups, "cls", "copies", total)
    none = rows.filter("cls is null").withColumn("component_id", F.col("doc_id"))
    out = with_words.select("doc_id", "size", "component_id", "cls").unionByName(none.select("doc_id", "size", "component_id", "cls"))
    return out.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id",
                      F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "cls")
