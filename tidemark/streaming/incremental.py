"""The incremental steps as streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from ..operators import history


def region_daily(points: DataFrame, *, lateness: str = "18 days", entity: tuple[str, ...] = ("region_id",), value: str = "sst") -> DataFrame:
    """Daily aggregates of a stream of points; a day is final once the watermark has passed it."""
    day = F.window("time", "1 day")
    out = points.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", lateness).groupBy(day, *entity).agg(
        F.avg(value).alias("mean_sst_c"), F.count(value).alias("cell_count"), F.min(value).alias("min_sst_c"), F.max(value).alias("max_sst_c")
    )
    return out.select(F.to_date("window.start").alias("date"), *entity, "mean_sst_c", "cell_count", "min_sst_c", "max_sst_c")


def keep_daily(daily: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Keep every day of a stream of daily aggregates, days that the watermark has not passed included.

    Each batch's new and changed rows go to a folder of their own under `target`,
    which a replay overwrites; `kept_daily` reads the last state of each key.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return daily.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_daily(spark: SparkSession, target: str, schema: StructType, *, key: tuple[str, ...] = history.KEY) -> DataFrame:
    """The table that `keep_daily` has written: of each key the row of its last batch."""
    rows = spark.read.schema(StructType([*schema, StructField("batch", LongType())])).parquet(target)
    return rows.groupBy(*key).agg(F.max_by(F.struct(*[c for c in schema.names if c not in key]), "batch").alias("_r")).select(*key, "_r.*").select(*schema.names)


def append_missing(rows: DataFrame, target: str, checkpoint: str, *, key: tuple[str, ...] = history.KEY, day: str = "date") -> StreamingQuery:
    """Append rows whose key the Parquet table at `target` lacks; replays and late rows add nothing.

    Of rows of one batch with equal keys one is added. A batch reads only the
    stored rows of its own range of days: of files by day those, of others the
    row groups of these days. Stored rows are only read, never rewritten.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = kept = batch.dropDuplicates(list(key)).persist()
        try:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
            if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
                first, last = fresh.agg(F.min(day), F.max(day)).first()
                stored = spark.read.schema(batch.schema).parquet(target)
                fresh_days = F.col(day).between(F.lit(first), F.lit(last)) if first is not None else F.lit(False)
                fresh = history.missing_only(fresh, stored.filter(fresh_days), key)
            fresh.write.mode("append").parquet(target)
        finally:
            kept.unpersist()

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
