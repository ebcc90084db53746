"""Sources and sinks: table scans, layered storage, records, artefacts and the feature table."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from riskframe.functions.hashing import hash_unit
from riskframe.functions.scalars import col
from riskframe.sources.staging import stage

# fixed values: storage layers in processing order
LAYERS = ("01_raw", "02_intermediate", "03_primary", "04_feature", "05_model_input", "06_models", "07_model_output",
          "08_reporting")
UNLABELLED = -1
BUCKETS = 32  # of the keys of a feature group
_PARTITIONS = StructType([StructField("split", StringType()), StructField("key_bucket", IntegerType()), StructField("commit_id", StringType())])


def scan_table(spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str | None = None,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet, ORC, JSON or CSV table. Text formats need a declared schema; nothing is inferred."""
    fmt = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    fmt = fmt if fmt in ("csv", "json", "orc", "parquet") else "parquet"
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif fmt in ("csv", "json"):
        raise ValueError(f"{fmt} input needs a declared schema")
    df = reader.option("header", "true").csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return df.select(*[col(c) for c in columns]) if columns else df


def scan_sampled(df: DataFrame, key: str, share: float | None = None, n: int | None = None,
                 total: int | None = None, seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample, p = share or min(1, n / total); the predicate is part of the scan stage."""
    p = share if share is not None else min(1.0, n / max(1, total))
    return df.where(hash_unit(col(key), seed) < F.lit(float(p)))


def layer_path(root: str, layer: str, name: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}; known: {LAYERS}")
    return f"{root.rstrip('/')}/{layer}/{name}"


def write_layer(df: DataFrame, root: str, layer: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Persists a stage and returns it read back, so later stages scan columns instead of recomputing."""
    path = layer_path(root, layer, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, layer, name))


def write_record(record: DataFrame, path: str) -> DataFrame:
    """A one-row JSON record (threshold, metrics, alerts), read back with the schema it was written with."""
    record.write.mode("overwrite").json(path, ignoreNullFields=False)
    return record.sparkSession.read.schema(record.schema).json(path)


def write_artifact(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("overwrite").parquet(path)
    return table.sparkSession.read.parquet(path)


def clean_name(name: str) -> str:
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9_]", "_", name.lower())).strip("_")


def sanitize_names(df: DataFrame) -> DataFrame:
    """Store-safe column names; two names that become equal are an error."""
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"column names collide after cleaning: {twice}")
    return df.toDF(*names)


def feature_rows(splits: Mapping[str, DataFrame], label: str, stamp: Column | None = None) -> DataFrame:
    """The splits as one table with ``split``, the label (-1 when unlabelled) and the event time."""
    out = None
    for name, t in splits.items():
        lab = F.coalesce(col(label).cast("long"), F.lit(UNLABELLED)) if label in t.columns else F.lit(UNLABELLED).cast("long")
        t = sanitize_names(t.withColumn(label, lab).withColumn("split", F.lit(name)))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out.withColumn("event_time", F.current_timestamp() if stamp is None else stamp)


def append_features(rows: DataFrame, root: str, group: str, version: int, key: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Appends to a version of a feature group; returns the rows appended per split.

    With a primary ``key`` the rows replace stored rows of the version that have the same key, so a re-run doubles
    nothing: the key buckets they fall into are written anew beside the old ones (rows without key replace nothing).
    Files are never overwritten. An append counts once its commit, the list of the folders that make up the version, has been
    renamed into place: readers see the state before or after it, and one that fails half way leaves the old state.
    ``buckets`` (of the first keyed append) should make one bucket's rewrite a small share of the version.
    """
    spark = rows.sparkSession
    taken = sorted({"key_bucket", "commit_id", "version"} & set(rows.columns))
    if taken:
        raise ValueError(f"column names used by the feature table: {taken}")
    path = layer_path(root, "04_feature", group)
    last = _commits(spark, path, version)
    state = _commit(spark, path, version, last[-1]) if last else {"key": None, "buckets": buckets, "schema": None, "folders": []}
    new, replaced, folders = rows.withColumn("key_bucket", F.lit(-1)), [], state["folders"]
    if key is not None:
        n = state["buckets"] if state["key"] == key else buckets
        new = stage(rows.withColumn("key_bucket", F.pmod(F.xxhash64(col(key)), F.lit(n)).cast("int")), "appended")
        touched = {r[0] for r in new.select("key_bucket").distinct().collect()}  # at most ``buckets``
        replaced = [f for f in folders if touched and (state["key"] != key or f[1] in touched or f[1] < 0)]
        if replaced:
            kept = _folders(spark, path, version, state["schema"], replaced).drop("commit_id").withColumn(
                "key_bucket", F.pmod(F.xxhash64(col(key)), F.lit(n)).cast("int")).join(new.select(col(key)).distinct(), key, "left_anti")
            new = kept.unionByName(new, allowMissingColumns=True)
        state = {**state, "key": key, "buckets": n}
    stamp = uuid.uuid4().hex
    data = f"{path}/version={int(version)}"
    (new.withColumn("commit_id", F.lit(stamp)).hint("rebalance", "split", "key_bucket")
     .write.mode("append").partitionBy("split", "key_bucket", "commit_id").parquet(data))
    plain = [f for f in new.schema.fields if f.name not in ("split", "key_bucket")]
    if state["schema"]:
        known = {f.name for f in plain}
        plain += [f for f in StructType.fromJson(state["schema"]).fields if f.name not in known]
    schema = StructType([StructField(f.name, f.dataType) for f in plain]).jsonValue()
    written = _folders(spark, path, version, schema, None).where(F.col("commit_id") == stamp).select("split", "key_bucket").distinct()
    added = [[r["split"], r["key_bucket"], stamp] for r in written.collect()]  # splits x buckets
    _publish(spark, path, version, (last[-1] if last else 0) + 1,
             {**state, "schema": schema, "folders": [f for f in folders if f not in replaced] + added})
    return rows.groupBy("split").agg(F.count("*").alias("n_rows"))


def feature_view(spark: SparkSession, root: str, group: str, version: int, split: str | None = None, commit: int | None = None) -> DataFrame:
    """One version of a feature group as its last commit, or an earlier one, left it; folders of other commits and splits are pruned."""
    path = layer_path(root, "04_feature", group)
    known = _commits(spark, path, version)
    if not known or (commit is not None and commit not in known):
        raise ValueError(f"feature group {group!r} has no commit {commit if commit is not None else ''} of version {version}".replace("  ", " "))
    state = _commit(spark, path, version, commit if commit is not None else known[-1])
    folders = [f for f in state["folders"] if split is None or f[0] == split]
    view = _folders(spark, path, version, state["schema"], folders)
    return view.drop("key_bucket", "commit_id").withColumn("version", F.lit(int(version)))


def feature_commits(spark: SparkSession, root: str, group: str, version: int) -> list[int]:
    """The commits of a version, oldest first; ``feature_view`` reads any of them."""
    return _commits(spark, layer_path(root, "04_feature", group), version)


def _folders(spark: SparkSession, path: str, version: int, schema: dict, folders: Sequence[Sequence] | None) -> DataFrame:
    """The rows in the given (split, bucket, commit) folders, in all where None; a predicate on partition columns alone."""
    full = StructType([*StructType.fromJson(schema).fields, *_PARTITIONS.fields])
    rows = spark.read.schema(full).parquet(f"{path}/version={int(version)}")
    if folders is None:
        return rows
    groups: dict = {}
    for split, bucket, stamp in folders:
        groups.setdefault((stamp, split), []).append(bucket)
    wanted = F.lit(False)
    for (stamp, split), held in groups.items():
        wanted = wanted | ((F.col("commit_id") == stamp) & F.col("split").eqNullSafe(F.lit(split)) & F.col("key_bucket").isin(held))
    return rows.where(wanted)


def _files(spark: SparkSession, path: str):
    """File system and path object of the cluster's storage."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _commit_dir(path: str, version: int) -> str:
    return f"{path}/_commits/version={int(version)}"


def _commits(spark: SparkSession, path: str, version: int) -> list[int]:
    fs, at = _files(spark, _commit_dir(path, version))
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removesuffix(".json")) for n in names if re.fullmatch(r"\d+\.json", n))


def _commit(spark: SparkSession, path: str, version: int, number: int) -> dict:
    return json.loads(spark.read.option("wholetext", "true").text(f"{_commit_dir(path, version)}/{number:012d}.json").first()[0])


def _publish(spark: SparkSession, path: str, version: int, number: int, state: dict) -> None:
    """Writes a commit aside and renames it into place; a rename never replaces a commit of another writer."""
    place = _commit_dir(path, version)
    fs, aside = _files(spark, f"{place}/{uuid.uuid4().hex}.new")
    out = fs.create(aside)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(aside.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(aside, hadoop.Path(f"{place}/{number:012d}.json"), options)
    except Py4JJavaError as e:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(e.java_exception):
            raise RuntimeError(f"another append to version {version} was committed first; run this one again") from e
        raise
