"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by digest. A batch of documents is
reduced to one row per digest (map-side combined, so a text that a third of
all rows share is counted in every task first), a sort-merge anti-join against
the index finds the digests it does not know - without moving the index, whose
buckets already lie as the join needs them - and those are appended.

Defined cases: texts are equal when identical after lower-casing A-Z only;
null counts as empty, so null and empty texts are equal; of equal texts in a
batch the largest doc_id stays (a null id only if the group has no other); of
fully repeated rows (same id and text) one stays; a text that the index already
has does not stay at all, its row names the document that did; an empty table
gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import id_type, scratch, stored

HOT_SHARE = 1000  # a group over 1/1000 of the rows is joined by broadcast: there are fewer than 1000 such


def text_digest(text: str = "text") -> Column:
    """SHA-256 of the text, A-Z lower-cased, null as empty."""
    folded = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.unhex(F.sha2(folded.cast("binary"), 256))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col("doc_id"), text_digest().alias("digest"))


class DigestIndex:
    """Digests of the documents kept so far, under ``path`` (kept between
    sessions; opening the same path again finds the same rows). The bucket
    count is fixed when the index is made: size it for the final corpus. A digest
    carries the batch that brought it: a batch that runs again under its name
    finds its own digests and decides as the first time."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = 64, id_type: str = "bigint"):
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch(spark, "digest-index")
        self.name = "digest_index_" + hashlib.md5(self.path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, doc_id {id_type}, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'")

    def table(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def _others(self, batch: str | None) -> DataFrame:
        t = self.table()
        return t if batch is None else t.filter(F.col("batch") != batch)

    def unknown(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """Rows of ``groups`` whose digest no (other) batch has brought."""
        return groups.join(self._others(batch).select("digest").hint("merge"), "digest", "left_anti")

    def known(self, groups: DataFrame, batch: str | None = None) -> DataFrame:
        """The other rows, with the document that the index keeps for them."""
        held = self._others(batch).select("digest", F.col("doc_id").alias("held_id"))
        return groups.join(held.hint("merge"), "digest").withColumn("keep_id", F.col("held_id")).drop("held_id")

    def append(self, fresh: DataFrame, batch: str) -> None:
        """Add the digests that this batch has not added yet; one file per bucket and batch."""
        here = self.table().filter(F.col("batch") == batch).select("digest")
        new = fresh.join(here.hint("merge"), "digest", "left_anti")
        (new.select("digest", F.col("keep_id").alias("doc_id"), F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest").sortWithinPartitions("digest")
         .write.insertInto(self.name))


def ingest(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """De-duplicate a batch in itself and against the index, and append what
    is new. One row per row of ``docs``: doc_id, keep_id, group_size (rows of
    this batch with that text), kept, digest. Give a batch that may run again
    (after a failure downstream, say) a name: it then keeps what it kept before;
    without a name every call is a batch of its own."""
    batch = batch or uuid.uuid4().hex
    digests = stored(digest(docs), "digests")
    rows = digests.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("copies"))
    groups = stored(digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                                  F.count(F.lit(1)).alias("group_size")), "groups")
    fresh = stored(index.unknown(groups, batch), "fresh")
    old = stored(index.known(groups, batch), "old")
    index.append(fresh, batch)
    resolved = (fresh.withColumn("fresh", F.lit(True))
                .unionByName(old.withColumn("fresh", F.lit(False))))

    total = digests.count()
    is_hot = F.col("group_size") * HOT_SHARE > F.lit(total)
    hot = F.broadcast(resolved.filter(is_hot))
    by_hot = rows.join(hot, "digest")
    by_rest = rows.join(hot, "digest", "left_anti").join(resolved.filter(~is_hot), "digest")
    return by_hot.unionByName(by_rest).select(
        "doc_id", "keep_id", "group_size", "digest", "fresh",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
    ).select(
        "doc_id", "keep_id", "group_size",
        (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "digest")


def drop_copies(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """``docs`` (all its columns) without the rows that ``ingest`` drops."""
    kept = ingest(docs, index, batch).filter("kept").select(F.col("doc_id").alias("id"), "digest")
    mine = f"digest_{uuid.uuid4().hex[:8]}"  # a name that no column of the caller has
    marked = docs.withColumn(mine, text_digest())
    joined = marked.join(kept, marked["doc_id"].eqNullSafe(kept["id"]) & (marked[mine] == kept["digest"]), "left_semi")
    return joined.dropDuplicates(["doc_id", mine]).drop(mine)
