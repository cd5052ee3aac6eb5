"""Document-at-a-time state as Structured Streaming.

Triples arrive as a stream; each micro-batch replaces its own documents in three Parquet tables (partitions by
document, overwritten dynamically), so a repeated batch or document changes nothing. Totals are views on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import schema_state
from ..operators.graph import merged_edges, merged_nodes
from ..sources.sinks import write_by_document


def start(triples: DataFrame, folder: str, checkpoint: str, bridge: DataFrame | None = None) -> StreamingQuery:
    """triples: a streaming DataFrame with doc_id, doc_seq, seq, id and the triple columns."""

    def batch(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        try:
            order = rows.groupBy("doc_id").agg(F.min("doc_seq").alias("doc_seq"))
            write_by_document(rows, f"{folder}/triples")
            write_by_document(schema_state.contributions(rows, order, bridge), f"{folder}/contributions")
        finally:
            rows.unpersist()

    return triples.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def master_schema(spark: SparkSession, folder: str) -> DataFrame:
    return schema_state.master(spark.read.parquet(f"{folder}/contributions"))


def graph(spark: SparkSession, folder: str, documents: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Merged nodes and edges of all documents, or of chosen ones (partition pruning)."""
    rows = spark.read.parquet(f"{folder}/triples")
    if documents is not None:
        rows = rows.filter(F.col("doc_id").isin(documents))
    return merged_nodes(rows), merged_edges(rows)
