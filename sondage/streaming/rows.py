"""The row-wise operators on streaming tables: the same functions, fed by a file stream.

A checkpoint makes each run take only new files, which is the incremental processing of the batch operators for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sondage.functions import text as T
from sondage.operators.canonical import canonicalize
from sondage.operators.contract import finite
from sondage.operators.gate import gate


def profile_stream(spark: SparkSession, root: str, glob: str = "*.[cC][nN][vV]") -> DataFrame:
    """New profile files under a root with their header facts and the gate's verdict."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    head = T.header_part(F.decode("content", "ISO-8859-1"))
    return gate(files.select("path", "length", T.header_columns(head).alias("names"), T.has_start_time(head).alias("has_start_time")))


def canonical_stream(rows: DataFrame, years: tuple[int, int] = (1970, 2035)) -> DataFrame:
    """Canonical rows of a stream of tables with any known aliases."""
    return canonicalize(rows, years)


def range_flags(rows: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """``out_of_range`` for every row of a stream."""
    x = finite(value)
    return rows.withColumn("out_of_range", F.coalesce((x < low) | (x > high), F.lit(False)))


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Takes all files that came since the last run and appends them to a Parquet table."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
