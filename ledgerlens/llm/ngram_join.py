"""N-gram Jaccard join for near-duplicates: rare-first prefix filtering.

1. One pass gives each document's class (a hash of its set of word n-grams: equal
   sets are one class from here on) and a count of all n-grams of all documents
   in a hashed table of fixed size.
2. N-grams are ordered by that count, ties by hash; in this order a class can only
   reach the threshold with classes that share one of its first
   ``n - ceil(t n) + 1`` n-grams (its prefix). Prefixes are joined on n-grams.
3. Candidates pass a length filter, a positional filter (sets that must share s
   n-grams share k of those that come before the last s - k) and a count filter,
   then, on the sets themselves, a suffix filter, and are verified once per pair.

Large groups of similar texts are not expanded into all pairs: first every member
of an n-gram's list meets one pivot of that list, the class whose prefix is shared
most; linked members are contracted; only lists that still hold different components
are paired in full, and there only rows outside the list's largest component meet the
others. Links inside a component cannot change the components, so these stay exact.

The order of n-grams only steers the cost. Counts are of hashed slots (an upper
bound of the frequency) so that the table stays small at any corpus size.

Defined cases: null and empty texts and texts without words have an empty set and
are linked with nothing; a text of fewer words than n is one n-gram; rows with equal
ids share the class of their text, not of their id; a group whose ids are all null
has a null component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations


from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import (add_tables, as_bytes, chunks, components, discard, id_text, id_type, in_few_tasks,
                                   join_groups, release_shuffles, row_key, stored)

N = 5
PERCENT = 80
SLOTS = 1 << 21       # slots of the count table
SEGMENT = 1 << 15     # slots of a row when tables of tasks are added up
KNOWN = 200_000       # classes that a task remembers to skip exact copies
ID_SLOTS = 1 << 20    # bits of the filter of wanted ids
SETS_A_TASK = 2000    # sets that a task handles where few are at hand
PIVOT_ROUNDS = 1
HEADS = 3             # n-grams that a pair must share in the heads of both sets

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                         0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingles(text: bytes, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text. Words are
    what stands between ASCII white space, A-Z lower-cased."""
    words = text.lower().split()
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if not len(h):
        return h
    k = min(n, len(h))
    acc = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        acc += h[i:len(h) - k + 1 + i] * _MULTIPLIERS[i % 8]
        acc ^= acc >> np.uint64(31 - (i % 8))
    acc += np.uint64(k)
    acc *= np.uint64(0xFF51AFD7ED558CCD)
    acc ^= acc >> np.uint64(33)
    return np.unique(acc)


def class_of(keys: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(keys.tobytes())).astype(np.int64))


def required(n1, n2, percent: int = PERCENT):
    """Least intersection of sets of these sizes at the threshold."""
    return -(-percent * (n1 + n2) // (100 + percent))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


# ------------------------------------------------------------ first pass
def profile(docs: DataFrame, n: int = N) -> DataFrame:
    """Stored rows of two kinds: (doc_id, cls, size) per document, and
    (segment, counts) with a task's counts of hashed n-grams."""

    schema = f"doc_id {id_type(docs)}, cls bigint, size int, segment int, counts binary"
    names = ["doc_id", "cls", "size", "segment", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.int64)
        doc_type = None
        for doc, text in chunks(batches):
            doc_type = doc.type
            sets = [shingles(t, n) for t in as_bytes(text)]
            flat = np.concatenate(sets)
            counts += np.bincount((flat >> np.uint64(8)).astype(np.int64) % SLOTS, minlength=SLOTS)
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int32()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())],
                names=names)
        if doc_type is not None:
            parts = np.minimum(counts, 65535).astype("<u2").reshape(-1, SEGMENT)
            m = len(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(m, doc_type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()),
                 pa.array(range(m), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=names)

    return stored(id_text(docs).mapInArrow(run, schema), "profile")


def count_levels(profiled: DataFrame) -> np.ndarray:
    """Order class (0 rarest .. 255) of every slot of the summed count table:
    SLOTS bytes, whatever the size of the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for segment, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(data, "<u2").astype(np.int64)
                sums[segment] = sums[segment] + part if segment in sums else part
        if sums:
            level = [np.minimum(255, 8 * np.log2(1 + s)).astype(np.uint8).tobytes() for s in sums.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(level, pa.binary())],
                                             names=["segment", "levels"])

    rows = (profiled.filter("segment is not null").select("segment", "counts")
            .repartition("segment").coalesce(SLOTS // SEGMENT).mapInArrow(run, "segment int, levels binary").collect())
    out = np.zeros(SLOTS, np.uint8)
    for r in rows:
        out[r.segment * SEGMENT:(r.segment + 1) * SEGMENT] = np.frombuffer(r.levels, np.uint8)
    return out


def ordered_keys(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The n-grams as sorted keys whose numeric order is the rare-first order:
    the level in the high byte, the hash below."""
    level = levels[(hashes >> np.uint64(8)).astype(np.int64) % SLOTS].astype(np.uint64)
    keys = (level << np.uint64(56)) | (hashes >> np.uint64(8))
    keys.sort()
    return (keys ^ np.uint64(1 << 63)).view(np.int64)  # the same order as signed numbers


# ---------------------------------------------------------- second pass
def prefixes(docs: DataFrame, levels, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Stored (gram, cls, size, pos): the prefix n-grams of every class and their
    places. A task leaves out classes that it has just met; other repeats may remain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        order = levels.value
        for _, text in chunks(batches):
            grams, cls, size = [], [], []
            for t in as_bytes(text):
                s = shingles(t, n)
                if not len(s) or (c := class_of(s)) in met:
                    continue
                if len(met) >= KNOWN:
                    met.clear()
                met.add(c)
                grams.append(ordered_keys(s, order)[:prefix_length(len(s), percent)])
                cls.append(c)
                size.append(len(s))
            if grams:
                reps = [len(g) for g in grams]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams)), pa.array(np.repeat(np.array(cls, np.int64), reps)),
                     pa.array(np.repeat(np.array(size, np.int32), reps)),
                     pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in reps]))],
                    names=["gram", "cls", "size", "pos"])

    return stored(id_text(docs).mapInArrow(run, "gram bigint, cls bigint, size int, pos int"), "prefixes", "zstd")


def sets_of(docs: DataFrame, wanted: DataFrame, levels=None, n: int = N, most: int | None = None) -> DataFrame:
    """Stored (cls, keys): the whole set of every class of ``wanted`` (cls, rep:
    the id of a document of it), one row per class; in rare-first order if the
    levels are given, else by hash. A bit per hash slot of the ids, of fixed size,
    spares most other texts where they are read; the class decides what stays.
    ``most``: no more rows are expected, and few of them go to few tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(ID_SLOTS, np.int32)
        for b in batches:
            bits[b.column(0).to_numpy()] = 1
        parts = bits.reshape(-1, SEGMENT)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()),
                                          pa.array([parts[i].tobytes() for i in some], pa.binary())],
                                         names=["segment", "counts"])

    def slot(col: str):
        return F.pmod(F.xxhash64(col), F.lit(ID_SLOTS)).cast("int").alias("slot")

    marks = in_few_tasks(wanted.select(slot("rep")).distinct(), ID_SLOTS).mapInArrow(count, "segment int, counts binary")
    bits = docs.sparkSession.sparkContext.broadcast(add_tables(marks, SEGMENT, ID_SLOTS) > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for b in batches:
            b = b.filter(pa.array(bits.value[b.column(2).to_numpy()]))
            for _, text in chunks([b]):
                cls, keys = [], []
                for t in as_bytes(text):
                    s = shingles(t, n)
                    if not len(s) or (c := class_of(s)) in met:
                        continue
                    if len(met) >= KNOWN:
                        met.clear()
                    met.add(c)
                    cls.append(c)
                    keys.append((s if levels is None else ordered_keys(s, levels.value)).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(keys, pa.binary())], names=["cls", "keys"])

    rows = id_text(docs).select("doc_id", "text", slot("doc_id"))
    found = rows.mapInArrow(run, "cls bigint, keys binary").join(wanted.select("cls"), "cls", "left_semi")
    found = found.dropDuplicates(["cls"])
    return stored(found if most is None else in_few_tasks(found, most, SETS_A_TASK), "sets")


# --------------------------------------------------------- verification
def similar(x: np.ndarray, y: np.ndarray, percent: int = PERCENT) -> bool:
    """Do two sets (sorted keys, rare first) reach the threshold?"""
    n1, n2 = len(x), len(y)
    if 100 * min(n1, n2) < percent * max(n1, n2):
        return False
    need = required(n1, n2, percent)
    # positional filter: the first shared n-gram bounds what can follow it
    head = x[:prefix_length(n1, percent)]
    at = np.searchsorted(y, head)
    same = np.flatnonzero(y[np.minimum(at, n2 - 1)] == head)
    if not len(same):
        return False
    i = int(same[0])
    j = int(at[i])
    if min(n1 - i, n2 - j) < need:
        return False
    # suffix filter: split both rests at a middle key; each side differs by its lengths at least
    a, b = x[i + 1:], y[j + 1:]
    spare = len(a) + len(b) - 2 * (need - 1)
    if len(b) and _differ(a, b, 2) > spare:
        return False
    at = np.searchsorted(y, x)
    inter = int((y[np.minimum(at, n2 - 1)] == x).sum())
    return 100 * inter >= percent * (n1 + n2 - inter)


def _differ(a: np.ndarray, b: np.ndarray, depth: int) -> int:
    """A lower bound of the size of the symmetric difference of sorted arrays."""
    if depth == 0 or not len(a) or not len(b):
        return abs(len(a) - len(b))
    mid = len(b) // 2
    cut = int(np.searchsorted(a, b[mid]))
    return _differ(a[:cut], b[:mid], depth - 1) + _differ(a[cut:], b[mid:], depth - 1)


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that reach the threshold, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64), percent)
                    for x, y in zip(batch.column("x"), batch.column("y"))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    joined = (pairs.select("a", "b").join(sets.select(F.col("cls").alias("a"), F.col("keys").alias("x")), "a")
              .join(sets.select(F.col("cls").alias("b"), F.col("keys").alias("y")), "b")
              .select("a", "b", "x", "y"))
    return stored(joined.mapInArrow(run, "a bigint, b bigint"), "links")


# ------------------------------------------------------------------ join
def _fits(n1, n2, percent: int):
    return (100 * F.least(n1, n2)) >= percent * F.greatest(n1, n2)


def _shared_needed(n1, n2, percent: int):
    """Prefix n-grams that two similar sets share at least: of the prefix that
    ends first, all but the n-grams which its set may lack."""
    def least(n, other):
        need = F.ceil(percent * (n + other) / (100.0 + percent) - 1e-9)
        return (n - F.ceil(percent * n / 100.0 - 1e-9) + 1) - (n - need)
    return F.greatest(F.lit(1), F.least(least(n1, n2), least(n2, n1)))


def link_classes(rows: DataFrame, sets_for: Callable[[DataFrame], DataFrame], percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between classes that have the same components as all links
    have. ``rows``: (gram, cls, size, pos), distinct, of n-grams that two classes share;
    with shared, the number of its rows, and rank, the order in which classes become pivots; ``sets_for`` gives the sets of the classes (id) it is asked for."""
    links: DataFrame | None = None
    labels = None
    for turn in range(PIVOT_ROUNDS + 1):
        if labels is None:
            here = rows.withColumn("label", F.col("cls"))
        else:
            here = (rows.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
                    .withColumn("label", F.coalesce("root", "cls")).drop("root"))
        if labels is not None:
            # lists that hold more than one component, and the largest of each
            count = here.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("n"))
            lists = count.groupBy("gram").agg(F.max(F.struct("n", "label")).alias("top"),
                                              F.min("label").alias("lo"), F.max("label").alias("hi"))
            open_lists = stored(lists.filter("lo < hi").select("gram", F.col("top.label").alias("main")), "open-lists")
            if open_lists.isEmpty():
                break
            here = stored(here.join(open_lists, "gram"), "open-rows", "zstd")
        else:
            here = here.withColumn("main", F.lit(None).cast("bigint"))  # every class is a component, every list open
        needed = _shared_needed(F.col("n1"), F.col("n2"), percent)
        possible = (_fits(F.col("n1"), F.col("n2"), percent) & (needed <= F.col("d1")) & (needed <= F.col("d2"))
                    & (F.col("l1") != F.col("l2")))
        left = here.select("gram", F.col("cls").alias("a"), F.col("size").alias("n1"), F.col("shared").alias("d1"),
                           F.col("pos").alias("p1"), F.col("label").alias("l1"), "main")
        right = here.select("gram", F.col("cls").alias("b"), F.col("size").alias("n2"), F.col("shared").alias("d2"),
                            F.col("pos").alias("p2"), F.col("label").alias("l2"), "rank")
        last = turn == PIVOT_ROUNDS
        if last:
            # of two sets that share `need` n-grams, the first n - need + k of each share k
            heads = F.least(needed, F.lit(HEADS))
            need = F.ceil(percent * (F.col("n1") + F.col("n2")) / (100.0 + percent) - 1e-9)
            ahead = ((F.col("p1") < F.col("n1") - need + heads) & (F.col("p2") < F.col("n2") - need + heads))
            met = left.filter("main is null or l1 != main").join(right, "gram").filter(
                possible & ahead & (F.col("l2").eqNullSafe(F.col("main")) | (F.col("a") < F.col("b"))))
            pairs = (met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                                F.when(F.col("a") < F.col("b"), F.col("n1")).otherwise(F.col("n2")).alias("n1"),
                                F.when(F.col("a") < F.col("b"), F.col("n2")).otherwise(F.col("n1")).alias("n2"))
                     .groupBy("a", "b", "n1", "n2").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") >= heads))
        else:
            # every member meets the list's pivot: the one whose prefix is shared most, as that of a text which many
            # copies derive from; where both share enough n-grams to look alike
            pivots = here.groupBy("gram").agg(F.min("rank").alias("rank"))
            pairs = (left.join(right.join(pivots, ["gram", "rank"]).drop("rank"), "gram").filter(possible)
                     .groupBy("a", "b", "n1").agg(F.count(F.lit(1)).alias("n"))
                     .filter(F.col("n") >= F.ceil(F.col("n1") * (100 - percent) / 500.0)))
        pairs = stored(pairs.select("a", "b"), "pairs")
        release_shuffles(rows.sparkSession)
        asked = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        found = verified(pairs, sets_for(asked), percent)
        links = found if links is None else stored(links.unionByName(found), "all-links")
        if last:
            break
        labels = components(links)
        release_shuffles(rows.sparkSession)
    if links is None:
        links = rows.select(F.col("cls").alias("a"), F.col("cls").alias("b")).limit(0)
    return links


def near_duplicates(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (the least doc_id
    reachable by links, itself included), cls (its class; null without words)."""
    spark = docs.sparkSession
    profiled = profile(docs, n)
    levels = spark.sparkContext.broadcast(count_levels(profiled))  # SLOTS bytes
    rows = profiled.filter("segment is null").select("doc_id", "cls", "size")
    classes = stored(rows.filter("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    release_shuffles(spark)

    grams = prefixes(docs, levels, n, percent)
    shared = grams.groupBy("gram").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi")
    shared = stored(shared.select("gram"), "shared-grams")
    release_shuffles(spark)
    met = stored(grams.join(shared, "gram").dropDuplicates(["gram", "cls"]), "met", "zstd")
    discard(grams, shared)
    release_shuffles(spark)
    degree = met.groupBy("cls").agg(F.count(F.lit(1)).cast("int").alias("shared"))
    # the share of the prefix that other classes have too, largest first; then a hash, so that ranks are distinct
    lacking = F.lit(1.0) - F.col("shared") / (F.col("size") - F.ceil(percent * F.col("size") / 100.0 - 1e-9) + 1)
    rank = F.floor(lacking * (1 << 18)) * F.lit(1 << 44) + F.pmod(F.xxhash64("cls"), F.lit(1 << 44))
    ranked = stored(met.join(degree, "cls").withColumn("rank", rank.cast("bigint")), "ranked", "zstd")
    discard(met)
    release_shuffles(spark)

    def sets_for(asked: DataFrame) -> DataFrame:
        reps = classes.join(asked.withColumnRenamed("id", "cls"), "cls", "left_semi")
        return sets_of(docs, reps.select("cls", "rep"), levels, n)

    roots = components(link_classes(ranked, sets_for, percent))
    of = (classes.join(roots.withColumnRenamed("node", "cls"), "cls", "left")
          .withColumn("root", F.coalesce("root", "cls")))
    least = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    groups = stored(of.join(least, "root").select("cls", "component_id", "copies"), "groups")
    with_words = join_groups(rows.filter("cls is not null"), groups, "cls", "copies", rows.count())
    out = with_words.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id", "cls")
    return out.unionByName(rows.filter("cls is null").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), "cls"))


def drop_near_copies(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """``docs`` (all its columns) with one document of each component: that
    with the least id (a null one only if there is no other). Rows are told
    apart by id and text, so near copies under one id or null are dropped as
    well, and unlike texts under one id stay. Rows without words have no copies."""
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    marked = docs.filter(worded).withColumn("__key", row_key())
    found = near_duplicates(marked.select(F.col("__key").alias("doc_id"), "text"), n, percent)
    kept = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias("__kept")).distinct())
    left = marked.join(kept, marked["__key"].eqNullSafe(kept["__kept"]), "left_semi").dropDuplicates(["__key"])
    return left.drop("__key").unionByName(docs.filter(~worded))
