"""WARC fixity audit: Merkle trees over records and ordered offset ranges, compared from the roots down.

A replica is a table of archive records (file, offset, length, digest). Leaves are digests of records; the nodes of the first
level cover ``RANGE`` bytes of a file's offsets, each further level ``FANOUT`` nodes of the one below, up to one root per
file. Replicas are compared by root; only children of differing nodes are looked at, level by level, and the
records of the differing ranges tell what happened there.

Defined results: a record at one offset in both replicas is ``changed`` if digest or length differ; one that only the first has is
``missing``, one that only the second has is ``extra``. Records without file or offset are kept apart under
a null file and range. Repeated records count as often as they occur. Equal or empty replicas give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskframe.sources.staging import stage

RANGE = 1 << 16  # bytes of offsets under a node of the first level
FANOUT = 16
LEVELS = 5  # above the records


def record(kind: Column, record_id: Column, uri: Column, body: Column) -> Column:
    """One WARC record as text; null parts are empty."""
    none = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: "), none(kind), F.lit("\r\nWARC-Record-ID: "), none(record_id), F.lit("\r\nWARC-Target-URI: "),
                    none(uri), F.lit("\r\nContent-Length: "), F.octet_length(none(body)).cast("string"), F.lit("\r\n\r\n"), none(body), F.lit("\r\n\r\n"))


def laid_out(records: DataFrame, order: Sequence[str], file_bytes: int) -> DataFrame:
    """Adds file and offset to records (length, ...) written one after the other in ``order`` to files of about file_bytes.

    Two-pass prefix sums: a range sort, sums inside each partition, and the partitions' totals in order.
    """
    spark = records.sparkSession
    rows = stage(records.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "records")
    part = F.shiftright("_at", 33)
    totals = sorted(rows.groupBy(part.alias("part")).agg(F.sum("length").alias("n")).collect())  # a row per partition
    bases, total = [], 0
    for r in totals:
        bases.append((r["part"], total))
        total += r["n"]
    base = F.broadcast(spark.createDataFrame(bases, "_part long, _base long"))
    inside = F.sum("length").over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.join(base, part == F.col("_part")).withColumn("_all", F.col("_base") + F.coalesce(inside, F.lit(0)))
    return placed.select(*records.columns, F.floor(F.col("_all") / F.lit(file_bytes)).cast("long").alias("file"),
                         F.pmod("_all", F.lit(file_bytes)).alias("offset"))


def _hash(children: Column) -> Column:
    """Digest of ordered (place, length, digest) children."""
    return F.sha2(F.array_join(F.transform(F.array_sort(children), lambda x: F.concat_ws(":", x["place"], x["length"], x["digest"])), ","), 256)


def tree(replica: DataFrame) -> DataFrame:
    """level, file, node, digest of all nodes above the records; a node gathers one range or FANOUT nodes."""
    leaf = replica.groupBy("file", F.floor(F.col("offset") / F.lit(RANGE)).cast("long").alias("node")).agg(
        _hash(F.collect_list(F.struct(F.col("offset").alias("place"), "length", "digest"))).alias("digest"))
    now = stage(leaf, "ranges")
    out = now.select(F.lit(1).alias("level"), "file", "node", "digest")
    for level in range(2, LEVELS + 1):
        up = F.floor(F.col("node") / F.lit(FANOUT)).cast("long") if level < LEVELS else F.lit(0).cast("long")
        now = stage(now.groupBy("file", up.alias("node")).agg(
            _hash(F.collect_list(F.struct(F.col("node").alias("place"), F.lit(0).alias("length"), "digest"))).alias("digest")), "nodes")
        out = out.unionByName(now.select(F.lit(level).alias("level"), "file", "node", "digest"))
    return out


def audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """file, offset, status, length and digest of both sides, for every record that differs."""
    a, b = stage(tree(first), "tree"), stage(tree(second), "tree")
    known = F.col("a.file").eqNullSafe(F.col("b.file")) & F.col("a.node").eqNullSafe(F.col("b.node"))
    suspects = None
    for level in range(LEVELS, 0, -1):
        mine, other = a.where(F.col("level") == level), b.where(F.col("level") == level)
        if suspects is not None:  # children of differing nodes only
            up = F.floor(F.col("node") / F.lit(FANOUT)).cast("long") if level < LEVELS - 1 else F.lit(0).cast("long")
            under = suspects.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
            mine, other = (t.join(under, F.col("file").eqNullSafe(F.col("_f")) & up.eqNullSafe(F.col("_n")), "left_semi") for t in (mine, other))
        both = mine.alias("a").join(other.alias("b"), known, "full").where(~F.col("a.digest").eqNullSafe(F.col("b.digest")))
        suspects = stage(both.select(F.coalesce("a.file", "b.file").alias("file"), F.coalesce("a.node", "b.node").alias("node")), "suspects")
    span = F.floor(F.col("offset") / F.lit(RANGE)).cast("long")
    under = suspects.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
    near = F.col("file").eqNullSafe(F.col("_f")) & span.eqNullSafe(F.col("_n"))
    sides = []
    for t in (first, second):
        rows = t.select("file", "offset", "length", "digest").join(under, near, "left_semi")
        sides.append(rows.groupBy("file", "offset").agg(F.array_sort(F.collect_list(F.struct("length", "digest"))).alias("held")))
    same = F.col("a.file").eqNullSafe(F.col("b.file")) & F.col("a.offset").eqNullSafe(F.col("b.offset"))
    found = sides[0].alias("a").join(sides[1].alias("b"), same, "full").where(~F.col("a.held").eqNullSafe(F.col("b.held")))
    return found.select(F.coalesce("a.file", "b.file").alias("file"), F.coalesce("a.offset", "b.offset").alias("offset"),
                        F.when(F.col("b.held").isNull(), "missing").when(F.col("a.held").isNull(), "extra").otherwise("changed").alias("status"),
                        F.col("a.held").alias("first"), F.col("b.held").alias("second"))
