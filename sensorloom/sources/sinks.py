"""Sinks (J1-J5)."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.operators.quality import row_counts
from sensorloom.operators.reshape import conform


def write_table(
    df: DataFrame, path: str, form: str = "parquet", order: Sequence[str] = ()
) -> None:
    """A typed Parquet table, or CSV with a header; files follow the order, if one is given."""
    writer = (df.orderBy(*order) if order else df).write.mode("overwrite")
    if form == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.format(form).save(path)


def _folder(spark: SparkSession, path: str):
    """A path of Spark's file system, and that file system."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, folder: str) -> list[str]:
    """The complete versions below a folder, oldest first: those with a manifest."""
    path, system = _folder(spark, f"{folder}/manifests")
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def write_star(tables: Mapping[str, DataFrame], folder: str, keep: int = 2) -> str:
    """Replace the star schema, dimensions first, declared columns only; the version written.

    The tables go to a new folder, which counts once its manifest is there: a manifest is one small table under a
    new number, the last thing written and seen only as a whole. Until then, and after a failure at any point, readers
    have the version before. A number that another writer took is an error. The `keep` newest versions stay.
    """
    spark = next(iter(tables.values())).sparkSession
    past = versions(spark, folder)
    number = f"{int(past[-1]) + 1 if past else 0:012d}"
    data = f"{folder}/versions/{number}-{uuid.uuid4().hex}"
    for name in schemas.TABLE_ORDER:
        if name in tables:
            write_table(conform(tables[name], schemas.STAR[name]), f"{data}/{name}")
    listed = spark.range(1).select(F.lit(data.rsplit("/", 1)[1]).alias("version"), F.array(*[F.lit(n) for n in schemas.TABLE_ORDER if n in tables]).alias("tables"))
    listed.coalesce(1).write.parquet(f"{data}/manifest")
    manifest, system = _folder(spark, f"{folder}/manifests/{number}")
    system.mkdirs(manifest.getParent())
    if system.exists(manifest) or not system.rename(_folder(spark, f"{data}/manifest")[0], manifest):
        raise FileExistsError(f"version {number} of {folder} was written by another job")
    drop_versions(spark, folder, keep)
    return number


def drop_versions(spark: SparkSession, folder: str, keep: int = 2) -> None:
    """Delete all but the newest complete versions, manifests first, and no version that is still being written."""
    for number in versions(spark, folder)[: -max(keep, 1)]:
        data = spark.read.parquet(f"{folder}/manifests/{number}").first().version
        for path in (f"{folder}/manifests/{number}", f"{folder}/versions/{data}"):
            hadoop, system = _folder(spark, path)
            system.delete(hadoop, True)


def read_star(spark: SparkSession, folder: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of the newest complete version, or of a given one: all of one build."""
    past = versions(spark, folder)
    if not past or (version is not None and version not in past):
        raise FileNotFoundError(f"no complete star schema in {folder}")
    manifest = spark.read.parquet(f"{folder}/manifests/{version or past[-1]}").first()
    data = f"{folder}/versions/{manifest.version}"
    return {name: spark.read.schema(schemas.STAR[name]).parquet(f"{data}/{name}") for name in manifest.tables}


def reconcile(source: Mapping[str, DataFrame], stored: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table before and after storing."""
    return (
        row_counts(source, "n_source")
        .join(row_counts(stored, "n_stored"), "table", "full")
        .withColumn("ok", F.col("n_source").eqNullSafe(F.col("n_stored")))
    )


def write_partitioned(
    df: DataFrame,
    path: str,
    partition: str = "year",
    cluster: Sequence[str] = ("pollutant_code", "station_code"),
) -> None:
    """A folder per partition value, rows clustered inside the files.

    Tasks take ranges of the partition value and the cluster columns, so that a heavy value is dealt over as many
    tasks as its rows fill, whatever the number of values and of tasks before, and AQE merges light ones; the sort
    gives row groups narrow ranges of the cluster columns.
    """
    (
        df.repartitionByRange(partition, *cluster)
        .sortWithinPartitions(partition, *cluster)
        .write.mode("overwrite")
        .partitionBy(partition)
        .parquet(path)
    )


def write_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str], batch: int = 5000) -> None:
    """J2 into a database of the user's own; rows go in batches and the table is emptied first."""
    (
        df.write.mode("overwrite")
        .option("truncate", "true")
        .option("batchsize", str(batch))
        .jdbc(url, table, properties=dict(properties))
    )
