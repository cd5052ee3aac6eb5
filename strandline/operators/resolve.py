"""Entity resolution: automatic merges, alias application, collisions and review clusters.

Nodes are (name, type, freq); a registry has canonical, type, aliases, note, merge_any_type, pos. Every alias table
is joined, left and equi, so Spark picks a broadcast from its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import base_name, contains_either, folded, is_specific, jaccard, loose_key, tokens, trivial_norm
from .graph import components, cut_lineage
from .merge import dedup_first, sides, with_ids

Fold = Callable[[Column], Column]


def as_is(s: Column) -> Column:
    """The fold of a name that is folded already."""
    return s


def node_frequency(triples: DataFrame) -> DataFrame:
    rows = sides(triples).filter(F.length("name") > 0)
    return rows.groupBy("name", F.coalesce("type", F.lit("Other")).alias("type")).agg(F.count("*").alias("freq"))


def alias_index(registry: DataFrame, fold: Fold = folded) -> DataFrame:
    """(norm, type) -> canonical; of several entries the last in registry order holds, a canonical name before its aliases."""
    forms = registry.select("canonical", "type", "pos", F.posexplode(F.concat(F.array("canonical"), "aliases")).alias("k", "form"))
    return forms.select(trivial_norm(F.col("form"), fold).alias("norm"), "type", F.struct("pos", "k").alias("at"), "canonical").groupBy("norm", "type").agg(F.max_by("canonical", "at").alias("canonical"))


def canonical_of(nodes: DataFrame, registry: DataFrame | None, fold: Fold = folded) -> DataFrame:
    """nodes with `form`: the canonical name by one hop, or the name itself."""
    if registry is None:
        return nodes.withColumn("form", F.col("name"))
    index = alias_index(registry, fold).withColumnRenamed("canonical", "form_of")
    return nodes.withColumn("norm", trivial_norm(F.col("name"), fold)).join(index, ["norm", "type"], "left").withColumn("form", F.coalesce("form_of", "name")).drop("norm", "form_of")


def _elected(formed: DataFrame, key: Column, nodes: DataFrame, keep: Column) -> DataFrame:
    """Groups of one key and type with several forms: canonical (most frequent, longest, first by name) and the others."""
    forms = formed.select(key.alias("key"), "type", F.col("form").alias("name")).distinct().filter(keep)
    own = forms.join(nodes.select("name", "type", "freq"), ["name", "type"], "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    best = own.groupBy("key", "type").agg(F.count("*").alias("forms"), F.min(F.struct((-F.col("freq")).alias("f"), (-F.length("name")).alias("l"), "name"))["name"].alias("canonical")).filter("forms > 1")
    return own.join(best, ["key", "type"]).filter("name <> canonical").select("key", "type", "canonical", F.col("name").alias("alias"))


def trivial_merges(nodes: DataFrame, registry: DataFrame | None = None, fold: Fold = folded) -> DataFrame:
    """Names that differ by white space, width or quotes only: key, type, canonical, alias."""
    formed = canonical_of(nodes, registry, fold)
    return _elected(formed, trivial_norm(F.col("form"), fold), nodes, F.lit(True))


def parenthetical_merges(nodes: DataFrame, registry: DataFrame | None = None, fold: Fold = folded) -> DataFrame:
    """Names that differ by trailing bracket groups only, if the rest is specific."""
    formed = canonical_of(nodes, registry, fold)
    return _elected(formed, base_name(F.col("form"), fold), nodes, is_specific(F.col("key")))


def extend_registry(registry: DataFrame, merges: DataFrame, note: str) -> DataFrame:
    """The registry with automatic aliases; its version grows only if an alias is new. New entities come last, by name."""
    new = merges.groupBy("canonical").agg(F.min("type").alias("new_type"), F.array_sort(F.collect_set("alias")).alias("new_aliases"))
    joined = registry.join(new, "canonical", "full_outer")
    known = F.coalesce("aliases", F.array().cast("array<string>"))
    added = F.array_except(F.coalesce("new_aliases", F.array().cast("array<string>")), known)
    out = joined.select(
        "canonical", F.coalesce("type", "new_type").alias("type"), F.concat(known, added).alias("aliases"), F.when(F.col("type").isNull(), F.lit(note)).otherwise(F.col("note")).alias("note"),
        F.coalesce("merge_any_type", F.lit(False)).alias("merge_any_type"), "pos", "version", (F.size(added) > 0).alias("grown"),
    )
    # known entities keep their places, new ones follow by name; one row of totals is joined, by a key that all share
    out = out.withColumn("all", F.lit(1))
    fresh = out.filter("pos is null").select("canonical", (F.row_number().over(Window.partitionBy("all").orderBy("canonical")) - 1).alias("nth"))
    totals = out.groupBy("all").agg((F.coalesce(F.max("version"), F.lit(1)) + F.max(F.col("grown").cast("int"))).alias("new_version"), (F.coalesce(F.max("pos"), F.lit(-1)) + 1).alias("next"))
    placed = out.join(fresh, "canonical", "left").join(totals, "all")
    return placed.select("canonical", "type", "aliases", "note", "merge_any_type", F.coalesce("pos", F.col("next") + F.col("nth")).cast("long").alias("pos"), F.col("new_version").cast("int").alias("version"))


def cross_type(nodes: DataFrame, registry: DataFrame | None = None, fold: Fold = folded) -> DataFrame:
    """Specific base names that occur under several types, unless merged across types already: base, types, names."""
    formed = canonical_of(nodes, registry, fold).withColumn("base", base_name(F.col("form"), fold)).filter(is_specific(F.col("base")) & (F.col("base") != ""))
    found = formed.groupBy("base").agg(F.array_sort(F.collect_set(F.struct(F.col("form").alias("name"), "type"))).alias("forms"), F.countDistinct("type").alias("types")).filter("types > 1")
    if registry is not None:
        handled = registry.filter("merge_any_type").select(base_name(F.col("canonical"), fold).alias("base")).distinct()
        found = found.join(handled, "base", "left_anti")
    return found


def similar_pairs(names: DataFrame, least: float = 0.45, fold: Fold = folded, gram: int = 3, stars: bool = False) -> DataFrame:
    """Pairs (type, a, b), a < b, of names of one type that have one loose key, contain one another, or share tokens
    (Jaccard >= least). names: name, type. stars: only pairs that connect what is connected; of names with one loose key
    each is paired with the first one, so that a key that many names share costs as many rows as names.

    The OR of three conditions is a union of equi-joins: on loose keys; on a rarest-first prefix of the tokens
    (a pair with enough similarity shares one of the first n - ceil(least n) + 1); and for containment on the
    shorter key's rarest gram of letters (one of its first letters where it is shorter), verified afterwards."""
    once = names.select("type", "name").distinct().withColumn("folded", fold(F.col("name")))
    keyed = once.select("type", "name", loose_key(F.col("folded"), as_is).alias("key"), tokens(F.col("folded"), as_is).alias("toks"))
    # tokens
    long = keyed.select("type", "name", F.size("toks").alias("n"), F.explode("toks").alias("token"))
    seen = long.groupBy("type", "token").agg(F.count("*").alias("df")).filter("df > 1")
    rank = Window.partitionBy("type", "name").orderBy("df", "token")
    shared = long.join(seen, ["type", "token"], "left").withColumn("df", F.coalesce("df", F.lit(1))).withColumn("rank", F.row_number().over(rank))
    prefix = shared.filter((F.col("rank") <= F.col("n") - F.ceil(F.col("n") * least) + 1) & (F.col("df") > 1)).select("type", "name", "token")
    by_token = prefix.alias("x").join(prefix.alias("y"), ["type", "token"]).filter("x.name < y.name").select("type", F.col("x.name").alias("a"), F.col("y.name").alias("b"))
    # containment
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - gram + 1, F.lit(1))), lambda i: F.substring(c, i, gram)))
    kinds = keyed.filter("key <> ''").select("type", "key").distinct()
    pieces = kinds.withColumn("gram", F.explode(grams(F.col("key"))))
    df = pieces.groupBy("type", "gram").agg(F.count("*").alias("df"))
    rare = pieces.filter(F.length("key") >= gram).join(df, ["type", "gram"]).groupBy("type", "key").agg(F.min(F.struct("df", "gram"))["gram"].alias("gram"))
    inner = rare.join(pieces.select("type", "gram", F.col("key").alias("outer")), ["type", "gram"]).filter((F.col("key") != F.col("outer")) & F.col("outer").contains(F.col("key")))
    tiny = kinds.filter(F.length("key") < gram).withColumn("size", F.length("key"))
    cut = lambda c: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(gram - 1)), lambda k: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - k + 1, F.lit(1))), lambda i: F.substring(c, i, k)))))
    small = kinds.select("type", F.col("key").alias("outer"), F.explode(cut(F.col("key"))).alias("key")).join(tiny, ["type", "key"]).filter("key <> outer")
    held = inner.select("type", "key", "outer").union(small.select("type", "key", "outer"))
    named = keyed.select("type", "key", "name")
    if stars:  # names of one key are linked among themselves: one of each is enough
        named = named.groupBy("type", "key").agg(F.min("name").alias("name"))
    by_key = held.join(named.withColumnRenamed("name", "x"), ["type", "key"]).join(named.select("type", F.col("key").alias("outer"), F.col("name").alias("y")), ["type", "outer"])
    by_key = by_key.select("type", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    # loose keys
    if stars:
        first = keyed.filter("key <> ''").groupBy("type", "key").agg(F.min("name").alias("a"))
        every = keyed.join(first, ["type", "key"]).filter("a < name").select("type", "a", F.col("name").alias("b"))
    else:
        every = keyed.filter("key <> ''").alias("x").join(keyed.filter("key <> ''").alias("y"), ["type", "key"]).filter("x.name < y.name").select("type", F.col("x.name").alias("a"), F.col("y.name").alias("b"))
    candidates = by_token.union(by_key).union(every).distinct()
    left = keyed.select("type", F.col("name").alias("a"), F.col("key").alias("ka"), F.col("toks").alias("ta"))
    right = keyed.select("type", F.col("name").alias("b"), F.col("key").alias("kb"), F.col("toks").alias("tb"))
    joined = candidates.join(left, ["type", "a"]).join(right, ["type", "b"])
    return joined.filter(contains_either(F.col("ka"), F.col("kb")) | (jaccard(F.col("ta"), F.col("tb")) >= least)).select("type", "a", "b")


def review_clusters(nodes: DataFrame, registry: DataFrame | None = None, least: float = 0.45, fold: Fold = folded) -> DataFrame:
    """Clusters of similar canonical names of a type: type, cluster (first name), name, freq, member_place (by frequency) and
    cluster_place (by size). Clusters of one are left out, and those whose names the registry already takes for one entity."""
    formed = canonical_of(nodes, registry, fold).groupBy(F.col("form").alias("name"), "type").agg(F.sum("freq").alias("seen"))
    edges = similar_pairs(formed.select("name", "type"), least, fold, stars=True)
    labels = components(edges.select("type", "a", "b"), by="type")
    own = nodes.select("name", "type", "freq")
    members = labels.select("type", F.col("component").alias("cluster"), F.col("node").alias("name")).join(own, ["name", "type"], "left").select("type", "cluster", "name", F.coalesce("freq", F.lit(0)).cast("long").alias("freq"))
    entities = canonical_of(members, registry, fold).groupBy("type", "cluster").agg(F.countDistinct("form").alias("entities"), F.count("*").alias("size")).filter("entities > 1")
    # the list that a person reads: clusters are few
    placed = entities.withColumn("cluster_place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("size"), "type", "cluster")).cast("long"))
    by_frequency = Window.partitionBy("type", "cluster").orderBy(F.desc("freq"), "name")
    return members.withColumn("member_place", F.row_number().over(by_frequency).cast("long")).join(placed.select("type", "cluster", "cluster_place"), ["type", "cluster"])


def apply_registry(triples: DataFrame, registry: DataFrame, fold: Fold = folded) -> DataFrame:
    """Names replaced by canonical ones (an entry that merges any type goes first and sets the type), deduplicated
    and numbered again. Persists nothing."""
    every = registry.filter("merge_any_type").select("canonical", "type", "pos", F.posexplode(F.concat(F.array("canonical"), "aliases")).alias("k", "form"))
    every = every.groupBy(trivial_norm(F.col("form"), fold).alias("norm")).agg(F.max_by(F.struct("canonical", F.coalesce(F.nullif("type", F.lit("")), F.lit("Other")).alias("type")), F.struct("pos", "k")).alias("any"))
    typed = alias_index(registry, fold)
    out = triples
    for p in ("s", "o"):
        name, type_ = F.col(f"{p}_name"), F.coalesce(F.col(f"{p}_type"), F.lit("Other"))
        joined = out.withColumn("norm", trivial_norm(name, fold)).withColumn("__type", type_)
        joined = joined.join(every, "norm", "left").join(typed.select("norm", F.col("type").alias("__type"), F.col("canonical").alias("__to")), ["norm", "__type"], "left")
        named = F.length(name) > 0
        out = joined.withColumn(f"{p}_type", F.when(named & F.col("any").isNotNull(), F.col("any.type")).otherwise(F.col(f"{p}_type")))
        out = out.withColumn(f"{p}_name", F.when(named, F.coalesce("any.canonical", "__to", name)).otherwise(name)).drop("norm", "__type", "any", "__to")
    return with_ids(dedup_first(out.drop("seq", "id")))


def resolve(triples: DataFrame, registry: DataFrame, least: float = 0.45, fold: Fold = folded) -> dict[str, DataFrame]:
    """The whole stage: registry after both merges, resolved triples, collisions and review clusters."""
    # each step is read several times by the next ones
    nodes = cut_lineage(node_frequency(triples))
    first = cut_lineage(extend_registry(registry, trivial_merges(nodes, registry, fold), "auto: trivial variant"))
    second = cut_lineage(extend_registry(first, parenthetical_merges(nodes, first, fold), "auto: bracket variant"))
    return {"registry": second, "triples": cut_lineage(apply_registry(triples, second, fold)), "cross_type": cut_lineage(cross_type(nodes, second, fold)), "clusters": cut_lineage(review_clusters(nodes, second, least, fold))}
