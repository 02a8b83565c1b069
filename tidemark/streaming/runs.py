"""Running a stream over what is there, and reading its result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.sources.sinks import shared_dir


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 64) -> DataFrame:
    """A table's files as a stream, in micro-batches of a bounded number of files.

    The path is given as a pattern (its first letter in brackets), so that a table of a single file is accepted too.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{folder}/[{name[0]}]{name[1:]}.parquet")


def with_event_time(df: DataFrame, late: str | None = None, time: str = "ts") -> DataFrame:
    """Rows that come ``late`` behind the newest one may be dropped; without it none is, and all state is kept."""
    df = df.withColumn(time, F.col(time).cast("timestamp"))
    return df.withWatermark(time, late) if late else df


def finished(stream: DataFrame, mode: str) -> DataFrame:
    """Runs the stream over all that is there now; the result is a table with ``batch``, the micro-batch of each row.

    The sink overwrites a batch's own folder, so a batch that is run again after a failure doesn't double its rows.
    """
    spark, path = stream.sparkSession, shared_dir(stream.sparkSession)

    def put(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/out/batch={batch}")

    stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    schema = StructType([*stream.schema.fields, StructField("batch", IntegerType())])
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/out")
    if not fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(fs):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/out")


def newest(result: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each key that an update stream has given out."""
    rest = [c for c in result.columns if c not in keys]
    return result.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*keys, "x.*").drop("batch")
