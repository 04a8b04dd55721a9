"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path

ROWS_A_TASK = 50_000   # of a few numbers each
CHUNK_BYTES = 2 << 20  # text handled at once inside a task; a longer text is a chunk of its own


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table under ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and a
    lost executor costs only the tasks that were running."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def in_few_tasks(df: DataFrame, rows: int, each: int = ROWS_A_TASK) -> DataFrame:
    """``df``, which has about ``rows`` rows at most, in no more tasks than these need
    (``each`` rows a task; one per core at least). A job of many steps over few rows
    takes as long as its tasks and files are many. More rows keep Spark's partitions."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // each))
    return df.coalesce(tasks) if tasks < int(spark.conf.get("spark.sql.shuffle.partitions")) else df


def discard(*tables: DataFrame) -> None:
    """Remove the files of ``stored`` tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of frames nobody refers to any more
    (its cleaner works when the driver's JVM collects its garbage)."""
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def id_type(df: DataFrame, col: str = "doc_id") -> str:
    return df.schema[col].dataType.simpleString()


def id_text(df: DataFrame, col: str = "doc_id") -> DataFrame:
    """(doc_id, text) with null texts as empty ones; other columns are dropped,
    so names in them cannot clash with an operator's own."""
    return df.select(F.col(col), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def row_key() -> Column:
    """What tells rows apart whose ids repeat or are null: the id (null last in
    order) and the text's digest."""
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                    F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("digest"))


def give_back() -> None:
    """Return what this worker has freed to the system: a worker lives on between
    stages, beside an executor that needs the memory."""
    import ctypes
    import gc
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def chunks(batches: Iterator[pa.RecordBatch], max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Cut Arrow batches of (doc_id, text) into runs of at most ``max_bytes``
    of text (one row at least), so memory in a task does not depend on how
    long the texts of a batch are."""
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        ids, text = b.column(0), b.column(1)
        sizes = pc.binary_length(text).to_pylist()
        start = size = 0
        for i, s in enumerate(sizes):
            if i > start and size + s > max_bytes:
                yield ids.slice(start, i - start), text.slice(start, i - start)
                start, size = i, 0
            size += s
        yield ids.slice(start, n - start), text.slice(start, n - start)
        del ids, text, b, sizes
    give_back()


def as_bytes(text: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column without decoding it."""
    return text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary()).to_pylist()


HOT_SHARE = 1000


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` joined with ``groups`` (one row per ``key``; ``size`` is the
    number of rows it matches) without bringing a large group into one task:
    groups over 1/1000 of ``total`` rows - fewer than 1000 there can be - are
    broadcast, the others are joined by their key."""
    is_hot = F.col(size) * HOT_SHARE > F.lit(total)
    hot = F.broadcast(groups.filter(is_hot))
    return (rows.join(hot, key)
            .unionByName(rows.join(hot, key, "left_anti").join(groups.filter(~is_hot), key)))


def hashed_rows(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows of (doc_id, text), those with the least hash of
    both. The first cut, from the number of rows, leaves little more than that
    before anything is sorted, so no task receives more when the table grows."""
    scale = 1 << 30
    share = min(1.0, (1.5 * most + 50) / max(1, rows.count()))
    order = F.xxhash64("doc_id", "text")
    return (rows.filter(F.pmod(order, F.lit(scale)) < int(share * scale))
            .orderBy(order, "doc_id", "text").limit(most))


def bounded_sample(rows: DataFrame, key: str, quota: int) -> DataFrame:
    """At most ``quota`` rows (doc_id, digest and the other columns) of each value
    of ``key`` (few values), those with the least hash of doc_id and digest; fully
    repeated rows count once. A first cut by the hash, from the number of rows of
    each value, leaves little more than the quota, so that ranking them is a small
    job however large a value is."""
    rows = rows.distinct()
    counts = [(r[key], r["n"]) for r in rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).collect()]
    scale = 1 << 30
    cut = F.lit(0)
    for value, n in counts:
        # half as many again, and some to spare where the quota is small
        share = min(1.0, (1.5 * quota + 50) / n)
        cut = F.when(F.col(key) == F.lit(value), F.lit(int(share * scale))).otherwise(cut)
    order = Window.partitionBy(key).orderBy("__hash", "doc_id", "digest")
    return (rows.withColumn("__hash", F.xxhash64("doc_id", "digest")).filter(F.pmod("__hash", F.lit(scale)) < cut)
            .withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") <= quota)
            .drop("__hash", "__rank"))


def components(links: DataFrame, name: str = "components", most: int | None = None) -> DataFrame:
    """Connected components of ``links`` (a, b): a row (node, root) for every
    node with a link, root being the smallest node of its component. Large-star
    and small-star steps in turn until nothing changes; each step is a
    map-side combined minimum and a join, and is written to the shared folder.
    ``most``: the number of links or more, if known."""
    edges = (links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .filter("a > b").distinct())
    edges = stored(edges if most is None else in_few_tasks(edges, most), name)
    most = 2 * edges.count()  # rows of a step: one or two for an edge
    while True:
        # large star: neighbours above a node move to the least of its neighbourhood; one row for an edge, repeats stay
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = in_few_tasks(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), most)
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a > b")
        large = stored(in_few_tasks(large, most), name)
        # small star: neighbours below a node, and the node, move to the least of them
        least = in_few_tasks(large.groupBy("a").agg(F.min("b").alias("m")), most)
        small = (large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
                 .filter("a > b").distinct())
        edges = stored(in_few_tasks(small, most), name)
        # done when every node has one edge, to a root without one
        ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("n")).unionByName(
            edges.select(F.col("b").alias("v"), F.lit(0).alias("n")))
        per_node = ends.groupBy("v").agg(F.sum("n").alias("up"), F.min("n").alias("down"))
        if in_few_tasks(per_node.filter("up > 1 or (up = 1 and down = 0)"), most).isEmpty():
            break
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def add_tables(parts: DataFrame, segment: int, slots: int) -> "np.ndarray":
    """Sum count tables that tasks have cut into rows (segment, counts as
    little-endian int32): ``slots`` numbers on the driver, whatever the input."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for at, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                part = np.frombuffer(data, "<i4").astype(np.int64)
                sums[at] = sums[at] + part if at in sums else part
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()),
                                              pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                                             names=["segment", "counts"])

    out = np.zeros(slots, np.int64)
    parts = parts.repartition("segment").coalesce(-(-slots // segment))  # a task for a segment at most
    for r in parts.mapInArrow(run, "segment int, counts binary").collect():
        out[r.segment * segment:(r.segment + 1) * segment] = np.frombuffer(r.counts, np.int64)
    return out
