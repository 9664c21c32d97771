"""Score refresh fed by a stream: each micro-batch is one MERGE into the buckets it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from holdfast.operators.upsert import SCORE_COLUMNS, merge_scores
from holdfast.session import cut
from holdfast.sources.versioned import Versioned


def latest_scores(updates: DataFrame, key: str, order: str) -> DataFrame:
    """One update per key: the last one in ``order``; of equally late ones the one with the highest score, so that a
    repeated batch gives the same rows."""
    return updates.groupBy(key).agg(F.max(F.struct(order, *SCORE_COLUMNS)).alias("_s")).select(
        key, *[f"_s.{c}" for c in SCORE_COLUMNS])


def refresh(stream: DataFrame, root: str, checkpoint: str, order: str = "scored_at") -> DataStreamWriter:
    """Merge every micro-batch into the versioned table below ``root`` (``Versioned.create``).

    Only buckets with a changed row are written. A batch that is repeated after a restart is known by its number and
    changes nothing, so a restart neither loses nor doubles a change.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        table = Versioned(batch.sparkSession, root)
        key = table.manifest()["key"]
        latest = cut(latest_scores(batch, key, order))
        table.merge(latest, lambda rows, new: merge_scores(rows, new, key), checkpoint, batch_id)

    return (stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True))
