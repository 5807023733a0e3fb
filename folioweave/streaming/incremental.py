"""Papers as they arrive: a file stream that handles new files once and stops (S12 as a stream).

The checkpoint of the stream takes the place of the status files: a file is processed exactly once
per checkpoint folder, however often the job is started. No late-data semantics are claimed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.operators import text as T


def new_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """A streaming table of the blocks of the Markdown files of a folder."""
    files = spark.readStream.schema("value string").option("wholetext", "true").option("pathGlobFilter", "*.md").text(folder)
    paper = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)
    return T.blocks(files.select(paper.alias("paper_id"), F.col("value").alias("text")), "paper_id")


def process_new(spark: SparkSession, folder: str, out: str, checkpoint: str) -> None:
    """Writes the blocks of the files not seen before to ``out`` as Parquet."""
    q = new_blocks(spark, folder).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    q.awaitTermination()
