"""Chunk extractions (JSON), triple documents, alias tables and registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.triples import document_label, node_bag, pred_code, pred_props
from .documents import chunk_id

#: Nodes and predicates stay JSON text, so that free keys never become columns, and a null key differs from none.
TRIPLE = "struct<id:string,subject:string,predicate:string,object:string,evidence:string,source_chunk:string>"
EXTRACTION = f"triples array<{TRIPLE}>"


def read_extractions(spark: SparkSession, path: str, glob: str = "meta_*.json") -> tuple[DataFrame, DataFrame]:
    """Triples of all chunk files, in file and list order, and warnings for files that don't parse.

    Columns: file, chunk_id, pos, s_name, s_type, s_props, code, p_props, o_name, o_type, o_props, evidence."""
    files = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.from_json("value", EXTRACTION, {"mode": "PERMISSIVE"}).alias("j"), "value")
    return flatten(files), files.filter("j.triples is null").select("file", F.lit("not a JSON object with triples").alias("warning"))


def flatten(files: DataFrame) -> DataFrame:
    rows = files.select("file", chunk_id(F.col("file")).alias("chunk_id"), F.posexplode("j.triples").alias("pos", "t"))
    return rows.select("file", "chunk_id", F.col("pos").cast("long").alias("pos"), *_of_triple(F.col("t")))


def _of_triple(t: Column) -> list[Column]:
    """The columns of a triple whose nodes and predicate are JSON text."""
    part = lambda r, k: F.get_json_object(t[r], f"$.{k}")
    return [
        part("subject", "name").alias("s_name"),
        part("subject", "type").alias("s_type"),
        node_bag(t["subject"]).alias("s_props"),
        pred_code(t["predicate"]).alias("code"),
        pred_props(t["predicate"]).alias("p_props"),
        part("object", "name").alias("o_name"),
        part("object", "type").alias("o_type"),
        node_bag(t["object"]).alias("o_props"),
        F.coalesce(t["evidence"], F.lit("")).alias("evidence"),
    ]


def read_triple_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Triples (doc_id, seq, id and the triple columns) and metadata (doc_id, source_document, ontology_version, triple_count) of
    triple documents: files of {"metadata": ..., "triples": [...]}. A document's id is its source, or else its file's name; a
    file whose metadata has first_seq continues its document from that triple."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.from_json("value", f"metadata struct<source_document:string,ontology_version:string,triple_count:long,first_seq:long>, triples array<{TRIPLE}>").alias("j"))
    named = files.withColumn("doc_id", document_label(F.lit(None).cast("string"), F.nullif("j.metadata.source_document", F.lit("")), F.col("file")))
    first = F.coalesce("j.metadata.first_seq", F.lit(1))
    rows = named.select("doc_id", first.alias("first"), F.posexplode("j.triples").alias("pos", "t"))
    triples = rows.select("doc_id", (F.col("pos") + F.col("first")).cast("long").alias("seq"), F.col("t.id").alias("id"), *_of_triple(F.col("t")), F.col("t.source_chunk").alias("chunk_id"))
    return triples, named.filter(first == 1).select("doc_id", "j.metadata.*").drop("first_seq")


def read_bridge(spark: SparkSession, path: str) -> DataFrame:
    """scope (node | relation), alias, canonical: every alias, and every canonical key as its own alias."""
    entry = "struct<aliases:array<string>,type:string,unit_hint:string,note:string>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"node_keys map<string,{entry}>, relation_keys map<string,{entry}>").alias("b"))
    rows = None
    for scope in ("node", "relation"):
        part = raw.select(F.lit(scope).alias("scope"), F.explode(f"b.{scope}_keys").alias("canonical", "e"))
        part = part.select("scope", F.explode(F.concat(F.array("canonical"), F.coalesce("e.aliases", F.array().cast("array<string>")))).alias("alias"), "canonical", "e.type", "e.unit_hint")
        rows = part if rows is None else rows.unionByName(part)
    return rows


def alias_map(bridge: DataFrame, scope: str | None) -> dict[str, str]:
    """The aliases as a constant: of one scope, or (None) of both with the relation scope over the node scope.

    An alias table is curated by hand; its size is checked."""
    rows = (bridge.filter(F.col("scope") == scope) if scope else bridge).filter("alias <> canonical").orderBy("scope", "canonical", "alias").limit(100_001).collect()
    if len(rows) > 100_000:
        raise ValueError("an alias table of over 100,000 rows is joined, not inlined")
    return {r["alias"]: r["canonical"] for r in rows}


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """canonical, type ('' where the entry has none: it then matches nodes of no type, unless it merges any), aliases, note,
    merge_any_type, pos (order in the file)."""
    entity = "struct<type:string,aliases:array<string>,note:string,merge_any_type:boolean>"
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", f"version int, entities map<string,{entity}>").alias("r"))
    return raw.select("r.version", F.posexplode("r.entities").alias("pos", "canonical", "e")).select(
        "canonical", F.coalesce("e.type", F.lit("")).alias("type"), F.coalesce("e.aliases", F.array().cast("array<string>")).alias("aliases"), "e.note", F.coalesce("e.merge_any_type", F.lit(False)).alias("merge_any_type"), F.col("pos").cast("long").alias("pos"), "version"
    )


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "canonical string, type string, aliases array<string>, note string, merge_any_type boolean, pos long, version int")
