"""Exact deduplication by skew-safe combining.

Texts are equal when their normalised forms are (every run of ASCII white
space replaced by one blank). A narrow pass finds the digests that occur more
than once; only their rows carry their text further. Those are combined three
times, each time by digest *and* full content: within the input partitions
(the map side of the first aggregate), in (digest, salt) groups, and over the
winners of the salts. A digest that holds a third of all rows is therefore a
few rows per partition before anything is shuffled, and ``salts`` groups
after. Should two contents share a digest, rows are matched by content.

The list of repeated digests is broadcast up to ``bound`` rows. Beyond it only
the hot digests are (more than ``hot_rows`` rows and than a 100,000th of all,
so never more than 100,000 digests); their rows are not shuffled before they
are combined, and the others, none of which is hot, meet in a shuffle join.

Rows: null counts as empty, and all empty texts are equal; a null ``doc_id``
sorts after every other id (a group of null ids keeps one row, ``keep_id``
null); of rows that repeat the smallest ``doc_id`` one stays. An empty table
gives an empty result. Texts of any length are compared whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, keep_rows, small_side, text_of, written

BLANKS = r"[\x20\x09-\x0D]+"
HOT_ROWS = 10_000
MOST_HOT = 100_000


def normalised(col: str = "text") -> Column:
    return F.regexp_replace(text_of(col), BLANKS, " ")


def sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def exact_groups(docs: DataFrame, salts: int = 32, digest=sha256, bound: int = BROADCAST_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) per row of ``docs``.

    ``digest`` maps the normalised text to a key (tests pass a weak one).
    """
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("norm"))
    src = src.withColumn("digest", digest(F.col("norm")))
    ids = written(src.select("doc_id", "digest").withColumn("place", F.monotonically_increasing_id()), "digests")
    often = written(ids.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "repeated-digests")
    n_often = often.count()
    hot = often.where(F.col("n") > max(hot_rows, ids.count() // MOST_HOT)).select("digest") if n_often > bound else None
    often = often.select("digest")

    def meet(rows: DataFrame, side: DataFrame, how: str) -> DataFrame:
        """Rows joined by digest with ``side``, one row per repeated digest."""
        if hot is None:
            return rows.join(F.broadcast(side), "digest", how)
        near = rows.join(F.broadcast(side.join(F.broadcast(hot), "digest", "left_semi")), "digest")
        return near.unionByName(rows.join(F.broadcast(hot), "digest", "left_anti").join(side, "digest", how))

    rows = meet(src, often, "inner")
    # 1 and 2: the aggregate's map side combines locally, its reduce side the
    # salted groups; 3: the winners of the salts. The content is always a key.
    salted = (rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
              .groupBy("digest", "salt", "norm").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("size")))
    whole = written(salted.groupBy("digest", "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("size").alias("size")), "winners")
    per = written(whole.groupBy("digest").agg(F.count(F.lit(1)).alias("contents"), F.min("keep_id").alias("keep_id"),
                                              F.min("size").alias("size")), "digest-winners")
    # every repeated digest has a row: one content decides for all its rows
    one = per.where("contents = 1").select("digest", "keep_id", F.col("size").alias("group_size"), F.lit(False).alias("mixed"))
    mixed = per.where("contents > 1").select("digest", F.lit(None).cast("long").alias("keep_id"),
                                            F.lit(None).cast("long").alias("group_size"), F.lit(True).alias("mixed"))
    n_mixed = mixed.count()
    side = one.unionByName(mixed) if n_mixed else one
    found = meet(ids, side, "left")
    if n_mixed:
        clash = (src.join(small_side(mixed.select("digest"), n_mixed), "digest", "left_semi")
                 .join(whole, ["digest", "norm"])
                 .select("digest", "doc_id", "keep_id", F.col("size").alias("group_size"), F.lit(False).alias("mixed"),
                         (-1 - F.monotonically_increasing_id()).alias("place"), F.xxhash64("norm").alias("content")))
        clash = written(clash, "clashes")
        found = found.withColumn("content", F.lit(None).cast("long"))
        found = found.where(~F.coalesce("mixed", F.lit(False))).unionByName(clash.select(*found.columns))
    content = [F.col("content")] if n_mixed else []
    found = found.select("doc_id", "digest", "place", *content,
                         F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                         F.coalesce("group_size", F.lit(1)).alias("group_size"))
    lead = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # one of the rows that repeat the smallest id stays: the first in place,
    # found by an aggregate and looked up by place, so no id gathers its rows
    again = found.where(lead & (F.col("group_size") > 1))
    first = again.groupBy("digest", *content).agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    again = again.join(first, "place", "left").withColumn("kept", F.coalesce("first", F.lit(False))).drop("first")
    rest = found.where(~(lead & (F.col("group_size") > 1))).withColumn("kept", lead)
    return again.unionByName(rest).select("doc_id", "keep_id", "group_size", "kept", "digest")


def deduplicate(docs: DataFrame, salts: int = 32) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = exact_groups(docs, salts).select("doc_id", F.col("digest").alias("key"), F.col("kept").alias("stay"))
    return keep_rows(docs, found, lambda df: df.withColumn("key", sha256(normalised())))
