"""Scoring, windowed drift and quarantine on unbounded input."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from riskframe.functions.frames import long_form, value_of
from riskframe.functions.scalars import col, edge_code, safe_div
from riskframe.operators.drift import EMPTY_SHARE, drift_level
from riskframe.operators.quality import UNIQUE, Rule, tag_violations
from riskframe.sources.staging import lookup_side


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet",
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", timeout: int | None = None) -> DataFrame:
    """Processes everything available into Parquet (exactly once per checkpoint) and reads it back."""
    query = (stream.writeStream.format("parquet").outputMode(mode).option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(query, timeout)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def finish(query, timeout: int | None) -> None:
    done = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if timeout and not done:
        query.stop()
        raise TimeoutError(f"stream did not finish within {timeout} s")


def stream_score(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                 timeout: int | None = None) -> DataFrame:
    """The batch scoring projection applied to a stream."""
    return run_to_table(score(stream), path, checkpoint, timeout=timeout)


def run_latest(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> DataFrame:
    """Complete-mode aggregates: every trigger overwrites the table with the current result."""
    query = (stream.writeStream.outputMode("complete")
             .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(query, timeout)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def windowed_bin_counts(df: DataFrame, ts: str, features: Mapping[str, Sequence[float]], width: str,
                        lateness: str | None = "1 hour") -> DataFrame:
    """``start, feature, bin, n`` per tumbling window against fixed reference edges.

    Works on a table and on a stream; on a stream the state is one count per open
    (window, feature, bin) and the watermark closes windows.
    """
    src = df.withWatermark(ts, lateness) if df.isStreaming and lateness else df
    codes = {f: edge_code(value_of(df, f).cast("double"), inner) for f, inner in features.items()}
    long = long_form(src, codes, keep=[col(ts)], value="bin").where("bin is not null")
    return (long.groupBy(F.window(col(ts), width).alias("w"), "feature", "bin").agg(F.count("*").alias("n"))
            .select(F.col("w.start").alias("start"), "feature", "bin", "n"))


def window_psi(counts: DataFrame, reference_bins: DataFrame) -> DataFrame:
    """``start, feature, psi, drift_level`` from window counts and ``feature, bin, n_ref``.

    Bins a window never saw still count: the missing share is 1e-4.
    """
    wr = Window.partitionBy("feature")
    ref = reference_bins.select("feature", "bin", safe_div(F.col("n_ref"), F.sum("n_ref").over(wr)).alias("r"))
    wc = Window.partitionBy("start", "feature")
    cur = counts.withColumn("c", safe_div(F.col("n"), F.sum("n").over(wc)))
    seen = cur.select("start", "feature").distinct()
    # bins x windows per feature, both short lists
    grid = seen.join(ref, "feature")
    both = grid.join(cur.select("start", "feature", "bin", "c"), ["start", "feature", "bin"], "full")
    fix = lambda x: F.when(F.coalesce(F.col(x), F.lit(0.0)) == 0, F.lit(EMPTY_SHARE)).otherwise(F.col(x))
    term = (fix("c") - fix("r")) * F.log(fix("c") / fix("r"))
    return (both.groupBy("start", "feature").agg(F.sum(term).alias("psi"))
            .withColumn("drift_level", drift_level(F.col("psi"))))


def closed_window_psi(stream: DataFrame, ts: str, features: Mapping[str, Sequence[float]], reference_bins: DataFrame, width: str,
                      lateness: str = "1 hour") -> DataFrame:
    """``start, feature, n, psi, drift_level`` of a stream's windows, each emitted once, when the watermark closes it (append mode).

    The state is one array of bin counts per open (window, feature), combined inside the tasks before rows move. A closed window meets the reference,
    ``feature, bin, n_ref``, in a stream-static join, so its PSI is a projection. Rows without a value have no bin; rows
    later than ``lateness`` are dropped (``run_closed`` counts them). Windows that are not closed yet stay in the state.
    """
    codes = {f: edge_code(value_of(stream, f).cast("double"), inner) for f, inner in features.items()}
    most = 1 + max((len(e) for e in features.values()), default=0)
    long = long_form(stream.withWatermark(ts, lateness), codes, keep=[col(ts)], value="bin").where("bin is not null")
    per = long.groupBy(F.window(col(ts), width).alias("w"), "feature").agg(
        F.array(*[F.count_if(F.col("bin") == b) for b in range(most)]).alias("held"))
    total = Window.partitionBy("feature")
    ref = (reference_bins.select("feature", F.col("bin").cast("int").alias("bin"), safe_div(F.col("n_ref"), F.sum("n_ref").over(total)).alias("r"))
           .groupBy("feature").agg(F.map_from_entries(F.collect_list(F.struct("bin", "r"))).alias("ref")))  # features x bins
    share = lambda v: F.when(F.coalesce(v, F.lit(0.0)) == 0, F.lit(EMPTY_SHARE)).otherwise(v)
    n = F.aggregate("held", F.lit(0).cast("long"), lambda a, x: a + x)

    def term(held: Column, i: Column) -> Column:
        c, r = share(held / F.col("n")), share(F.col("ref")[i])
        # a bin above the feature's last edge exists on neither side
        return F.when((held == 0) & F.col("ref")[i].isNull(), F.lit(0.0)).otherwise((c - r) * F.log(c / r))

    psi = F.aggregate(F.transform("held", term), F.lit(0.0), lambda a, x: a + x)
    joined = per.withColumn("n", n).join(lookup_side(ref, "reference"), "feature")
    return joined.select(F.col("w.start").alias("start"), "feature", "n", psi.alias("psi")).withColumn("drift_level", drift_level(F.col("psi")))


def run_closed(stream: DataFrame, path: str, checkpoint: str, timeout: int | None = None) -> tuple[DataFrame, int]:
    """Appends what the watermark has closed to a table; the table, and the groups of late rows dropped in this run.

    Late rows are counted after they were combined inside a task: one per task, batch, window and feature that came too late. Spark keeps the
    progress of the last ``spark.sql.streaming.numRecentProgressUpdates`` batches; only these are counted.
    """
    query = (stream.writeStream.format("parquet").outputMode("append").option("path", path)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(query, timeout)
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    return stream.sparkSession.read.schema(stream.schema).parquet(path), late


def stream_repeated_keys(stream: DataFrame, column: str, path: str, checkpoint: str, ts: str | None = None, within: int | None = None,
                         timeout: int | None = None) -> DataFrame:
    """``key``: the values of a column that arrived more than once, in one batch or in different ones, or before a restart.

    The state store holds one count per key, added up inside the tasks before keys move. With ``ts`` and ``within`` (seconds) it
    forgets: two rows count as repeated when they share a window of twice that length that starts every ``within``
    seconds, so all rows at most ``within`` apart do, and the watermark drops the counts of older windows. Without,
    counts stay for ever. A replayed batch overwrites its own folder. Null keys are no keys.
    """
    keyed = stream.where(col(column).isNotNull())
    if within is not None:
        keyed = keyed.withWatermark(ts, f"{within} seconds")
        groups = [F.window(col(ts), f"{2 * within} seconds", f"{within} seconds"), col(column).alias("key")]
    else:
        groups = [col(column).alias("key")]

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.where(F.col("count") > 1).select("key").distinct().write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (keyed.groupBy(*groups).count().writeStream.outputMode("update").foreachBatch(keep)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finish(query, timeout)
    schema = StructType().add("key", stream.schema[column].dataType)
    return stream.sparkSession.read.schema(schema).option("recursiveFileLookup", "true").parquet(path).distinct()


def stream_quarantine(stream: DataFrame, rules: Sequence[Rule], good_path: str, bad_path: str, checkpoint: str,
                      timeout: int | None = None, ts: str | None = None, unique_within: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Splits every micro-batch into valid and offending rows.

    Each batch overwrites its own folder, so a replayed batch leaves no duplicates. Keys of unique rules are counted in a
    state store across batches and restarts (``stream_repeated_keys``): a row written as valid is recalled, on reading, once its key has
    come again, so the result is that of a batch job on everything that has arrived.
    """
    row_rules = [r for r in rules if r.kind != UNIQUE]
    keys = [r for r in rules if r.kind == UNIQUE and r.column in stream.columns]

    def split(batch: DataFrame, batch_id: int) -> None:
        tagged = tag_violations(batch, row_rules).persist()  # evaluated once for both sides
        ok = F.size("broken_rules") == 0
        tagged.where(ok).drop("broken_rules").write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
        tagged.where(~ok).write.mode("overwrite").parquet(f"{bad_path}/batch={batch_id}")
        tagged.unpersist()

    query = (stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finish(query, timeout)
    spark = stream.sparkSession
    bad_schema = StructType(list(stream.schema.fields)).add("broken_rules", ArrayType(StringType()))
    read = lambda path, schema: spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    good, bad = read(good_path, stream.schema), read(bad_path, bad_schema)
    if not keys:
        return good, bad
    tagged = good.withColumn("broken_rules", F.array().cast("array<string>")).unionByName(bad)
    for i, r in enumerate(keys):
        repeated = stream_repeated_keys(stream, r.column, f"{bad_path}_keys/{r.column}", f"{checkpoint}_keys/{r.column}", ts, unique_within, timeout)
        marks = lookup_side(repeated.select(F.col("key").alias(f"__key{i}"), F.lit(r.id).alias(f"__mark{i}")), "repeated")
        tagged = tagged.join(marks, col(r.column) == F.col(f"__key{i}"), "left")
    found = F.concat("broken_rules", F.array_compact(F.array(*[F.col(f"__mark{i}") for i in range(len(keys))])))
    tagged = tagged.select(*stream.columns, found.alias("broken_rules"))
    return tagged.where(F.size("broken_rules") == 0).drop("broken_rules"), tagged.where(F.size("broken_rules") > 0)
