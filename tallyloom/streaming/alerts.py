"""A polling alert as a stateless stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyloom.operators.filters import near

POLL_INTERVAL = "60 seconds"


def is_dark(hour: Column, sunrise: int, sunset: int) -> Column:
    """After sunset or before sunrise, both hours included."""
    return (hour >= sunset) | (hour <= sunrise)


def overhead_in_the_dark(
    df: DataFrame, x: Column, y: Column, ts: Column, centre: tuple[float, float], reach: float, sunrise: int, sunset: int
) -> DataFrame:
    """Sightings near the centre while it is dark; the same for a batch and a stream."""
    return df.filter(near(x, y, centre, reach) & is_dark(F.hour(ts), sunrise, sunset))


def open_stream(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """A stream of the Parquet files of a table: of its folder, or of the one file it is.

    Spark lists the path itself, so any file system will do.
    """
    listed = spark._jvm.org.apache.hadoop.fs.Path(table)
    files = listed.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(listed):
        raise FileNotFoundError(table)
    if files.getFileStatus(listed).isDirectory():
        return spark.readStream.schema(schema).parquet(table)
    folder, _, name = table.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def start_alerts(alerts: DataFrame, out: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Append alerts to ``out``, exactly once per file.

    ``once`` works off what is there and stops; otherwise new files are looked
    for every minute.
    """
    writer = alerts.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=POLL_INTERVAL)
    return writer.start(out)
