"""Matching a stream of S1 records against a stored index: every micro-batch runs the batch plan."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from kindred.plans.resolve import infer, load_index


def match_stream(records: DataFrame, index_path: str, classifier: PipelineModel, output: str, checkpoint: str, threshold: float = 0.56) -> StreamingQuery:
    """Write matches of each micro-batch of ``records`` under ``output``, one folder per batch id: replays overwrite their own."""

    def batch(df: DataFrame, batch_id: int) -> None:
        found, index = load_index(df.sparkSession, index_path)
        matches, _ = infer(df, found, index, classifier, threshold)
        matches.write.mode("overwrite").parquet(f"{output}/batch={batch_id}")

    return records.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
