"""The fixed vocabulary: entity types with their axes, relations with domain and range, attributes and enums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The published vocabulary, in its order.
ENTITY_TYPES = ["NaturalHazard", "ManmadeHazard", "RiskFactor", "Region", "Facility", "Population", "Event", "Damage", "ResponseAction", "ResponseActor", "Resilience", "Context", "Other"]
AXIS_TYPES = {
    "Hazard": ["NaturalHazard", "ManmadeHazard", "RiskFactor"],
    "Exposure": ["Region", "Facility", "Population"],
    "Event": ["Event"],
    "Damage": ["Damage"],
    "Response": ["ResponseAction", "ResponseActor", "Resilience"],
    "Context": ["Context"],
    "Other": ["Other"],
}
_HAZARDS, _PLACES, _ACTOR = AXIS_TYPES["Hazard"], AXIS_TYPES["Exposure"], ["ResponseActor"]
# Code -> (types of the subject, types of the object), phase 1 and phase 2.
RELATIONS = {
    "TRIGGERS": (_HAZARDS, ["Event"]),
    "AFFECTS": (_HAZARDS, _PLACES),
    "INCREASES_RISK_OF": (["RiskFactor", "NaturalHazard", "ManmadeHazard"], ["Event"]),
    "PRECONDITIONS": (["Context", "RiskFactor"], _HAZARDS),
    "COMPOUNDS": (_HAZARDS, _HAZARDS),
    "DERIVES_FROM": (_HAZARDS, _HAZARDS),
    "CASCADES_INTO": (["Event"], ["Event"]),
    "TRIGGERS_SECONDARY": (["Event"], ["Event"]),
    "CONCURRENT_WITH": (["Event"], ["Event"]),
    "CAUSES": (["Event"], ["Damage"]),
    "AMPLIFIES": (_PLACES, ["Damage"]),
    "HAS_RESILIENCE": (_PLACES, ["Resilience"]),
    "LOCATED_IN": (_PLACES, ["Context", "Region"]),
    "OCCURS_AT": (["NaturalHazard", "ManmadeHazard", "Event"], ["Context"]),
    "UNDER_CONDITION": (["NaturalHazard", "ManmadeHazard", "Event"], ["Context"]),
    "PREVENTS": (["ResponseAction"], _HAZARDS),
    "MODIFIES_RISK_OF": (["ResponseAction"], ["Event"]),
    "MITIGATES": (["ResponseAction"], ["Damage"]),
    "RESPONDS_TO": (["ResponseAction"], ["Event", "NaturalHazard", "ManmadeHazard"]),
    "BUILDS": (["ResponseAction"], ["Resilience"]),
    "OFFSETS": (["Resilience"], ["Damage"]),
    "PERFORMS": (_ACTOR, ["ResponseAction"]),
    "FAILS": (_ACTOR, ["ResponseAction"]),
    "COMMANDS": (_ACTOR, _ACTOR),
    "COORDINATES_WITH": (_ACTOR, _ACTOR),
    "BELONGS_TO": (_ACTOR, _ACTOR),
    "DEPLOYED_TO": (_ACTOR, ["Context"]),
    "QUANTIFIED_BY": (["Damage"], ["Context"]),
    "GUIDED_BY": (["ResponseAction"], ["Other"]),
}
INFERRED_RELATIONS = {"PRECEDES": (["Event", "ResponseAction"], ["Event", "ResponseAction"])}
# Sets of codes.
CAUSAL = ["TRIGGERS", "INCREASES_RISK_OF", "TRIGGERS_SECONDARY", "CASCADES_INTO", "CAUSES", "AMPLIFIES", "COMPOUNDS", "DERIVES_FROM", "MODIFIES_RISK_OF", "CONCURRENT_WITH", "PRECONDITIONS", "AFFECTS"]
CASCADE = ["TRIGGERS", "CASCADES_INTO", "TRIGGERS_SECONDARY"]
SAME_CHUNK = ["CASCADES_INTO", "TRIGGERS_SECONDARY", "CONCURRENT_WITH"]
# Required attributes, and the values that attributes may have.
REQUIRED = {"NaturalHazard": ["origin"], "ManmadeHazard": ["origin"], "Event": ["order"], "Damage": ["category"], "ResponseAction": ["phase"]}
ENUMS = {
    ("NaturalHazard", "origin"): ["meteorological", "geological", "hydrological", "biological", "climatological"],
    ("ManmadeHazard", "origin"): ["fire", "explosion", "structural", "chemical", "transport", "infra_failure", "crowd", "cyber"],
    ("RiskFactor", "nature"): ["latent", "emerging", "recurring", "unquantified"],
    ("Region", "scope"): ["macro", "meso", "micro"],
    ("Facility", "scope"): ["macro", "meso", "micro"],
    ("Population", "scope"): ["macro", "meso", "micro"],
    ("Event", "order"): ["primary", "secondary", "cascading", "nth"],
    ("Event", "subtype"): ["state_change"],
    ("Damage", "category"): ["human", "property", "service", "economic", "infra", "environmental"],
    ("Damage", "severity"): ["Money", "Count", "Ratio", "Area", "Duration"],
    ("ResponseAction", "phase"): ["prevention", "mitigation", "preparedness", "response", "recovery"],
    ("Resilience", "kind"): ["absorbing", "buffering", "recovery"],
    ("Context", "subkind"): ["DateTime", "Location", "Weather", "Metric", "Threshold"],
}
# Disaster types.
DISASTER_TYPES = ["natural_storm", "natural_quake", "natural_landslide", "natural_climate", "natural_epidemic", "social_fire", "social_collapse", "social_transport", "social_crowd", "social_chemical", "social_infra", "social_cyber"]
# Colours.
COLOURS = {
    "NaturalHazard": "#e15759", "ManmadeHazard": "#b4453a", "RiskFactor": "#ff9da7", "Region": "#4e79a7", "Facility": "#76b7b2", "Population": "#59a14f", "Event": "#f28e2b",
    "Damage": "#9c27b0", "ResponseAction": "#edc948", "ResponseActor": "#bab0ac", "Resilience": "#86bcb6", "Context": "#a0cbe8", "Other": "#cccccc",
}
DEFAULT_COLOUR = "#999"
# Lines of a chunk by density, and the names of densities.
DENSITY_LINES = {"high": 450, "medium": 900, "low": 1700}
DENSITY_NAMES = {"high": "high", "medium": "medium", "low": "low", "고밀": "high", "중밀": "medium", "저밀": "low"}

AXIS = {t: axis for axis, types in AXIS_TYPES.items() for t in types}


def lookup(of: dict[str, str], key: Column, default: str | None) -> Column:
    """A constant map as an expression; no join."""
    found = F.element_at(F.create_map(*[F.lit(x) for pair in of.items() for x in pair]), key)
    return found if default is None else F.coalesce(found, F.lit(default))


def axis_of(type_: Column) -> Column:
    return lookup(AXIS, type_, "Other")


def colour_of(type_: Column) -> Column:
    return lookup(COLOURS, type_, DEFAULT_COLOUR)


def is_causal(code: Column) -> Column:
    return code.isin(CAUSAL)


def entity_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, AXIS[t]) for t in ENTITY_TYPES], "type string, axis string")


def relations(spark: SparkSession) -> DataFrame:
    rows = [(c, phase, a, b) for phase, of in ((1, RELATIONS), (2, INFERRED_RELATIONS)) for c, (a, b) in of.items()]
    return spark.createDataFrame(rows, "code string, phase int, `from` array<string>, `to` array<string>")


def allowed(spark: SparkSession) -> DataFrame:
    """Every (code, subject type, object type) that the vocabulary allows."""
    return relations(spark).select("code", F.explode("from").alias("s_type"), "to").select("code", "s_type", F.explode("to").alias("o_type"))


def required(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, a) for t, xs in REQUIRED.items() for a in xs], "type string, attr string")


def enums(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, a, v) for (t, a), v in ENUMS.items()], "type string, attr string, allowed array<string>")


def read_ontology(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entity types and relations (both phases) of a vocabulary file."""
    raw = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "entity_types array<string>, entity_axis map<string,string>, relations_phase1 array<struct<code:string,from:array<string>,to:array<string>>>, relations_phase2 array<struct<code:string,from:array<string>,to:array<string>>>").alias("o")
    )
    types = raw.select(F.explode("o.entity_types").alias("type"), "o.entity_axis").select("type", F.coalesce(F.col("entity_axis")[F.col("type")], F.lit("Other")).alias("axis"))
    phases = [raw.select(F.inline(f"o.relations_phase{k}")).withColumn("phase", F.lit(k)) for k in (1, 2)]
    return types, phases[0].unionByName(phases[1]).select("code", "phase", "from", "to")
