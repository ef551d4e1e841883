"""The row-wise operators on arriving files: features, contract failures, scores.

Nothing here keeps state, so no watermark is needed; the checkpoint only remembers
which files are done.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from riskloom.operators.features import add_features
from riskloom.operators.linear import LinearModel
from riskloom.operators.serving import score_units
from riskloom.roles import DEFAULT_ROLES, Roles
from riskloom.sources.tables import canonical_view


def read_arriving(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """Parquet files as they appear in a folder."""
    return spark.readStream.schema(schema).parquet(folder)


def scored_stream(
    stream: DataFrame,
    model: LinearModel,
    threshold: float,
    ranges: Mapping[str, tuple[float, float]] | None = None,
    roles: Roles = DEFAULT_ROLES,
) -> DataFrame:
    """Canonical label, derived columns, then risk, flag and contributions."""
    features = add_features(canonical_view(stream, roles), roles)
    return score_units(features, model, threshold, ranges, roles.unit_id)


def write_available(df: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived as Parquet and stop; a second run takes up new files only."""
    return (
        df.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )
