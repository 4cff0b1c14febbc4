"""Stored tables: Parquet partitioned by a date, partitions replaced whole, and the ordered cold archive."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that spark.checkpoint.dir names; in a temporary one only where the session has none and is local."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")
    if not base and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{base or tempfile.mkdtemp(prefix='spark-scratch-')}/{name}-{uuid.uuid4().hex}"


#: Bytes of a row group of what is written to be read soon: a task reads whole ones, so that large ones leave the others idle.
BLOCK = 16 << 20


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written to the shared folder once and read from there: later steps neither repeat its work nor inline its expressions."""
    path = scratch(df.sparkSession, name)
    df.write.option("parquet.block.size", BLOCK).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def published(df: DataFrame, path: str) -> DataFrame:
    """df as the folder path, which appears whole or not at all: written beside it and renamed. A folder that is there already stays as it is."""
    spark = df.sparkSession
    if not exists(spark, path):
        parent, _, name = path.rpartition("/")
        staged = f"{parent}/.{name}-{uuid.uuid4().hex}"
        df.write.parquet(staged)
        moved(spark, staged, path)
    return spark.read.schema(df.schema).parquet(path)


def moved(spark: SparkSession, staged: str, path: str) -> None:
    """The folder staged, in one step, as path."""
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path))
    files = to.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    files.mkdirs(to.getParent())
    if not files.rename(at, to):
        raise OSError(f"{path} could not be published")


def folders(df: DataFrame, number: Column, count: int, to: str) -> Iterator[str]:
    """df cut by number (0 to count - 1, others are left out) in one pass; each folder to/batch=N appears as the iterator comes to it, whole, so that a stream may be run upon it before the next one is there."""
    staged = scratch(df.sparkSession, "staged")
    rows = df.withColumn("batch", number).where(F.col("batch").between(0, count - 1))
    rows.write.option("parquet.block.size", BLOCK).partitionBy("batch").parquet(staged)
    for k in range(count):
        path = f"{to}/batch={k}"
        if exists(df.sparkSession, f"{staged}/batch={k}"):
            moved(df.sparkSession, f"{staged}/batch={k}", path)
        else:
            published(df.limit(0), path)
        yield path


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [f.getPath().getName() for f in files.listStatus(at)] if files.exists(at) else []


def save(df: DataFrame, path: str, by: Column | None = None, name: str = "month") -> None:
    """Write df, partitioned by ``by``; only the partitions that df has are replaced."""
    if by is None:
        df.write.mode("overwrite").parquet(path)
        return
    rows = df.withColumn(name, by)
    rows.repartition(name).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)


def append(df: DataFrame, path: str, by: Column | None = None, name: str = "month") -> None:
    rows = df if by is None else df.withColumn(name, by)
    writer = rows.write.mode("append")
    (writer if by is None else writer.partitionBy(name)).parquet(path)


def archive(df: DataFrame, path: str, order: tuple[str, ...] = ("device_id", "metric_key", "time")) -> None:
    """Write df in order, zstd level 3: ranges of the order per file, so that readers skip files and row groups."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").parquet(path)


def checksum(df: DataFrame) -> DataFrame:
    """One row (n, digest) that does not depend on the order of rows: count and the sum of the rows' hashes."""
    return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")).alias("digest"))


def verified(spark: SparkSession, df: DataFrame, path: str) -> bool:
    """Whether what an archive holds is what df has."""
    return checksum(df).first() == checksum(spark.read.parquet(path)).first()


def sort_rewrite(spark: SparkSession, path: str, to: str, order: tuple[str, ...] = ("device_id", "time", "metric_key")) -> None:
    """A partition's files anew in physical order."""
    archive(spark.read.parquet(path), to, order)


def append_new(df: DataFrame, path: str, key: str = "message_id") -> None:
    """Append those rows of df whose key the table at path lacks, each key once: sending the same again changes nothing."""
    spark = df.sparkSession
    rows = df.dropDuplicates([key])
    try:
        rows = rows.join(spark.read.parquet(path).select(key), key, "left_anti")
    except AnalysisException:  # there is no table yet
        pass
    rows.select(*df.columns).write.mode("append").parquet(path)


ORGANIZATION, MONTH = "organization_id", "month"


def month_sums(rows: DataFrame) -> DataFrame:
    """Per organisation and month (a column) the rows' number and the sum of their hashes, which do not depend on order."""
    digest = F.sum(F.xxhash64(*sorted(c for c in rows.columns if c != MONTH)).cast("decimal(38,0)"))
    return rows.groupBy(ORGANIZATION, MONTH).agg(F.count("*").alias("n"), digest.alias("digest"))


def archive_months(points: DataFrame, path: str, registry: str, before: Column, exempt: Column | None = None, written: Callable[[str], None] | None = None) -> DataFrame:
    """Archive each organisation's months that end by ``before``, without exempt rows; the registry's rows (organization_id, month, n, digest, folder).

    All months that are not registered yet are written in one pass, in order and partitioned by organisation and month, into a folder of the run's own, while an Observation counts and
    digests what goes in. The folder is read again: if both agree all its months are registered, else only those whose own sums agree, and of an organisation none from the first
    broken month on, so that what the registry allows to delete has no hole. The registry's part of a run appears whole or not at all, after its files; only what it names counts, so
    a run that dies leaves nothing but files that nobody reads. written: called with the folder between writing and checking.
    """
    spark = points.sparkSession
    rows = points if exempt is None else points.where(~exempt)
    old = rows.where(F.add_months(F.date_trunc("month", "time"), 1).cast("timestamp") <= before).withColumn(MONTH, F.date_format("time", "yyyy-MM"))
    shape = "organization_id bigint, month string, n bigint, digest decimal(38,0), folder string"
    if exists(spark, registry):
        old = old.join(spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(registry).select(ORGANIZATION, MONTH), [ORGANIZATION, MONTH], "left_anti")
    old = old.select(*points.columns, MONTH)
    if old.isEmpty():
        return spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(registry) if exists(spark, registry) else spark.createDataFrame([], shape)
    run = uuid.uuid4().hex
    to, seen, order = f"{path}/run={run}", Observation(), (ORGANIZATION, MONTH, "device_id", "metric_key", "time")
    hashes = F.sum(F.xxhash64(*sorted(points.columns)).cast("decimal(38,0)"))
    writer = old.observe(seen, F.count("*").alias("n"), hashes.alias("digest")).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_organization", F.col(ORGANIZATION)).write
    writer.option("compression", "zstd").option("parquet.compression.codec.zstd.level", "3").option("maxRecordsPerFile", 10_000_000).partitionBy("_organization", MONTH).parquet(to)
    if written is not None:
        written(to)
    held = spark.read.schema(old.schema).option("basePath", to).parquet(to).select(*points.columns, MONTH)
    sums = kept = month_sums(held)
    total = kept.agg(F.sum("n").alias("n"), F.sum("digest").alias("digest")).first()
    if (total["n"], total["digest"]) != (seen.get["n"], seen.get["digest"]):
        want = month_sums(old)
        both = want.join(kept.withColumnsRenamed({"n": "_n", "digest": "_digest"}), [ORGANIZATION, MONTH], "left")
        broken = both.where(~F.coalesce((F.col("n") == F.col("_n")) & (F.col("digest") == F.col("_digest")), F.lit(False)))
        first = broken.groupBy(ORGANIZATION).agg(F.min(MONTH).alias("_broken"))
        sums = want.join(first, ORGANIZATION, "left").where(F.col("_broken").isNull() | (F.col(MONTH) < F.col("_broken"))).drop("_broken")
    published(sums.withColumn("folder", F.lit(f"run={run}")).select(ORGANIZATION, MONTH, "n", F.col("digest").cast("decimal(38,0)").alias("digest"), "folder"), f"{registry}/{run}")
    return spark.read.schema(shape).option("recursiveFileLookup", "true").parquet(registry)


def archived(spark: SparkSession, path: str, registry: DataFrame, schema: str) -> DataFrame:
    """The rows of the months that the registry's rows name."""
    held = spark.read.schema(f"{schema}, month string, run string").option("basePath", path).parquet(path)
    named = registry.select(ORGANIZATION, MONTH, F.expr("substr(folder, 5)").alias("run"))
    return held.join(named, [ORGANIZATION, MONTH, "run"], "left_semi")
