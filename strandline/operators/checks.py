"""Checks that the vocabulary declares: they report rows and drop nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import ontology
from .merge import sides


def domain_range(triples: DataFrame) -> DataFrame:
    """Triples whose subject and object types their relation does not allow. The allowed table is a constant of 100 rows."""
    return triples.join(F.broadcast(ontology.allowed(triples.sparkSession)), ["code", "s_type", "o_type"], "left_anti")


def missing_attributes(triples: DataFrame) -> DataFrame:
    """doc_id, ord, name, type, attr: required attributes that a node does not carry."""
    rows = sides(triples, props=True).join(F.broadcast(ontology.required(triples.sparkSession)), "type")
    return rows.filter(F.coalesce(F.element_at("props", F.col("attr")), F.lit("")) == "").drop("props")


def bad_values(triples: DataFrame) -> DataFrame:
    """doc_id, ord, name, type, attr, value: values outside an attribute's list."""
    rows = sides(triples, props=True).join(F.broadcast(ontology.enums(triples.sparkSession)), "type").withColumn("value", F.element_at("props", F.col("attr")))
    return rows.filter(F.col("value").isNotNull() & ~F.array_contains("allowed", F.col("value"))).drop("props", "allowed")


def other_without_note(triples: DataFrame) -> DataFrame:
    """Nodes of type Other must carry a candidate note; UNKNOWN is no type or name."""
    rows = sides(triples, props=True)
    return rows.filter(((F.col("type") == "Other") & (F.coalesce(F.element_at("props", F.lit("candidate")), F.element_at("props", F.lit("note")), F.lit("")) == "")) | (F.upper("type") == "UNKNOWN") | (F.upper("name") == "UNKNOWN")).drop("props")


def disaster_types(triples: DataFrame) -> DataFrame:
    rows = sides(triples, props=True).withColumn("value", F.element_at("props", F.lit("disasterType")))
    return rows.filter(F.col("value").isNotNull() & ~F.col("value").isin(ontology.DISASTER_TYPES)).drop("props")


def across_chunks(mentions: DataFrame) -> DataFrame:
    """Event-to-event relations whose two names never occur in one chunk of the document."""
    rows = mentions.filter(F.col("code").isin(ontology.SAME_CHUNK))
    both = sides(mentions.select("doc_id", "ord", "s_name", "s_type", "o_name", "o_type")).join(mentions.select("doc_id", "ord", "chunk_id"), ["doc_id", "ord"]).select("doc_id", "chunk_id", "name").distinct()
    a, b = both.withColumnRenamed("name", "s_name"), both.withColumnRenamed("name", "o_name")
    return rows.join(a.join(b, ["doc_id", "chunk_id"]).select("doc_id", "s_name", "o_name").distinct(), ["doc_id", "s_name", "o_name"], "left_anti")


def subtype_view(triples: DataFrame) -> DataFrame:
    """The 16-way view: events by order and damages by category, other types as they are."""
    rows = sides(triples, props=True)
    order, category = F.element_at("props", F.lit("order")), F.element_at("props", F.lit("category"))
    event = F.when(order == "primary", "PrimaryEvent").when(order == "secondary", "SecondaryEvent").when(order.isin("cascading", "nth"), "CascadingEvent").otherwise("Event")
    damage = F.when(category == "human", "HumanDamage").when(category.isin("property", "economic"), "PropertyDamage").when(category.isin("service", "infra"), "ServiceDamage").otherwise("Damage")
    return rows.withColumn("subtype", F.when(F.col("type") == "Event", event).when(F.col("type") == "Damage", damage).otherwise(F.col("type"))).drop("props")
