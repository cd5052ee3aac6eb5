"""Column functions on nodes, predicates, property bags and paths."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..ontology import axis_of
from .text import safe_key

BAG = "map<string,string>"


def pred_code(p: Column) -> Column:
    """A predicate's code: of its JSON object, or the bare string itself."""
    return F.when(F.ltrim(p).startswith("{"), F.get_json_object(p, "$.code")).otherwise(p)


def pred_props(p: Column) -> Column:
    return F.coalesce(F.when(F.ltrim(p).startswith("{"), F.from_json(F.get_json_object(p, "$.properties"), BAG)), F.from_json(F.lit("{}"), BAG))


def node_props(properties: Column, attributes: Column) -> Column:
    """The JSON bag of a node; attributes stand in only where the key properties is absent."""
    return F.coalesce(F.from_json(F.coalesce(properties, attributes), BAG), F.from_json(F.lit("{}"), BAG))


def node_bag(node: Column) -> Column:
    """The bag of a node that is JSON text: a properties key counts even if its value is null."""
    given = F.array_contains(F.json_object_keys(node), "properties")
    raw = F.when(given, F.get_json_object(node, "$.properties")).otherwise(F.get_json_object(node, "$.attributes"))
    return F.coalesce(F.from_json(raw, BAG), F.from_json(F.lit("{}"), BAG))


def rename_keys(bag: Column, aliases: Column) -> Column:
    """Keys by an alias map; of keys that become equal the last value stays (at the first one's place).

    Built without duplicate map keys, so it does not depend on the session's policy for them."""
    named = F.transform(F.map_entries(bag), lambda e: F.struct(F.coalesce(F.element_at(aliases, e["key"]), e["key"]).alias("key"), e["value"].alias("value")))

    def renamed(named: Column) -> Column:
        keys = F.array_distinct(F.transform(named, lambda e: e["key"]))
        last = F.transform(keys, lambda k: F.element_at(F.filter(named, lambda e: e["key"] == k), -1)["value"])
        return F.map_from_arrays(keys, last)

    return bound(named, renamed)


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value), with value computed once however often f names it: within lambdas Spark computes an expression anew for
    each element, and nested ones as often as their product."""
    return F.element_at(F.transform(F.array(value), f), 1)


def overlay(bag: Column, extra: Column) -> Column:
    """bag with extra's entries, which win, in order of first appearance."""

    def laid(both: Column) -> Column:
        bag, extra = both["bag"], both["extra"]
        keys = F.array_union(F.map_keys(bag), F.map_keys(extra))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.when(F.map_contains_key(extra, k), F.element_at(extra, k)).otherwise(F.element_at(bag, k))))

    return bound(F.struct(bag.alias("bag"), extra.alias("extra")), laid)


def literal(value: Column, kind: Column | None = None) -> Column:
    """A graph literal: numbers and booleans (by kind) bare, else a quoted string."""
    text = F.replace(F.replace(F.regexp_replace(value, r"\\", r"\\\\"), F.lit("'"), F.lit("\\'")), F.lit("\n"), F.lit(" "))
    quoted = F.concat(F.lit("'"), F.regexp_replace(text, r"(?U)^\s+|\s+$", ""), F.lit("'"))
    return quoted if kind is None else F.when(kind.isin("BOOLEAN", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), value).otherwise(quoted)


def props_literal(bag: Column, kinds: Column | None = None) -> Column:
    """{k: v, ...} of the non-empty entries. kinds: map of key to the kind of its JSON value."""
    held = F.filter(F.map_entries(bag), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    pairs = F.transform(held, lambda e: F.concat(safe_key(e["key"]), F.lit(": "), literal(e["value"], None if kinds is None else F.element_at(kinds, e["key"]))))
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))


def json_kinds(raw: Column) -> Column:
    """Key -> kind of the value, of a JSON object's text."""
    return F.transform_values(F.from_json(raw, "map<string,variant>"), lambda k, v: F.schema_of_variant(v))


def typed(name: Column, type_: Column) -> tuple[Column, Column]:
    """Identity of a node."""
    return F.coalesce(name, F.lit("")), F.coalesce(F.nullif(type_, F.lit("")), F.lit("Other"))


def node_label(type_: Column) -> Column:
    axis = axis_of(type_)
    return F.when(axis == type_, type_).otherwise(F.concat(axis, F.lit(":"), type_))


def code_or_default(code: Column) -> Column:
    return F.coalesce(F.nullif(code, F.lit("")), F.lit("RELATED_TO"))


def triple_id(n: Column) -> Column:
    return F.format_string("T%04d", n)


def document_label(given: Column, source: Column, path: Column) -> Column:
    return F.coalesce(F.nullif(given, F.lit("")), source, F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1))


def is_complete(first_type: Column, last_type: Column) -> Column:
    """Whether a path runs from a hazard to a damage."""
    return (axis_of(first_type) == "Hazard") & (axis_of(last_type) == "Damage")


def edge_width(weight: Column, largest: Column) -> Column:
    return 1 + 7 * (weight - 1) / F.greatest(F.lit(1), largest - 1)


def edge_opacity(weight: Column, largest: Column) -> Column:
    return 0.45 + 0.5 * (weight - 1) / F.greatest(F.lit(1), largest - 1)


def node_radius(degree: Column) -> Column:
    return 3 + 1.5 * F.sqrt(degree)


def path_radius(weight: Column) -> Column:
    return 5 + 2.2 * F.sqrt(weight)
