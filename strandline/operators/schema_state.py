"""The property schema across documents: contributions are stored per document, totals are derived, so a rerun of a document changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import emergent_nodes, emergent_relations


def contributions(triples: DataFrame, doc_seq: DataFrame, bridge: DataFrame | None = None) -> DataFrame:
    """doc_id, doc_seq, scope, key (canonical), owner, cnt. doc_seq: doc_id and its order of arrival. bridge: scope, alias, canonical."""
    rows = emergent_nodes(triples).withColumn("scope", F.lit("node")).unionByName(emergent_relations(triples).withColumn("scope", F.lit("relation"))).filter("key is not null")
    if bridge is not None:
        rows = rows.join(bridge.select("scope", F.col("alias").alias("key"), "canonical"), ["scope", "key"], "left").withColumn("key", F.coalesce("canonical", "key"))
    return rows.join(doc_seq, "doc_id").groupBy("doc_id", "doc_seq", "scope", "key", "owner").agg(F.sum("cnt").alias("cnt"))


def master(contributed: DataFrame) -> DataFrame:
    """scope, key, count, owners (map), docs (in order of arrival), first_seen."""
    owned = contributed.groupBy("scope", "key", "owner").agg(F.sum("cnt").alias("cnt"))
    owners = owned.groupBy("scope", "key").agg(F.sum("cnt").alias("count"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("owner", "cnt")))).alias("owners"))
    docs = contributed.groupBy("scope", "key", "doc_id").agg(F.min("doc_seq").alias("at"))
    docs = docs.groupBy("scope", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "doc_id"))), lambda d: d["doc_id"]).alias("docs"), F.min_by("doc_id", F.struct("at", "doc_id")).alias("first_seen"))
    return owners.join(docs, ["scope", "key"])


def new_keys(contributed: DataFrame, bridge: DataFrame | None) -> DataFrame:
    """Keys that no alias table of their scope knows: scope, key, count, owners (sorted)."""
    rows = contributed if bridge is None else contributed.join(bridge.select("scope", F.col("alias").alias("key")), ["scope", "key"], "left_anti")
    return rows.groupBy("scope", "key").agg(F.sum("cnt").alias("count"), F.array_sort(F.collect_set("owner")).alias("owners"))


def consolidate(bridge: DataFrame, decisions: DataFrame) -> DataFrame:
    """A new version of the alias table: decisions (scope, alias, canonical) are added, existing canonical names stay."""
    fresh = decisions.join(bridge.select("scope", "alias"), ["scope", "alias"], "left_anti").select("scope", "alias", "canonical")
    own = fresh.select("scope", F.col("canonical").alias("alias"), "canonical").distinct().join(bridge.select("scope", "alias"), ["scope", "alias"], "left_anti")
    return bridge.select("scope", "alias", "canonical").unionByName(fresh).unionByName(own).distinct()
