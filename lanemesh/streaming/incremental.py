"""Loading tiles as they arrive: the file source's checkpoint is the ledger of what was loaded."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import scalars

KINDS = {"geometry": schemas.GEOMETRY_TILE, "metadata": schemas.METADATA_TILE, "reference": schemas.REFERENCE_TILE}


def load_new_tiles(spark: SparkSession, path: str, kind: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of tiles that were not loaded before to a Parquet table, then stop."""
    stream = spark.readStream.schema(KINDS[kind]).option("pathGlobFilter", f"*.{kind}.*").json(path)
    tile_id, _ = scalars.tile_parts(F.col("_metadata.file_name"))
    return stream.withColumn("tile_id", tile_id).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
