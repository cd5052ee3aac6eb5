"""Relational graph operators on deduplicated triples (doc_id, seq, s_*, code, o_*).

Analytic nodes are names (nodes()); stored nodes are (name, type) (merged_nodes()). The two differ where a name has
several types, and are kept apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import ontology
from ..functions.triples import code_or_default
from .durable import cut_lineage
from .merge import sides


def edges(triples: DataFrame) -> DataFrame:
    """doc_id, seq, src, dst, code, st, ot of triples with both names."""
    kept = triples.filter((F.length("s_name") > 0) & (F.length("o_name") > 0))
    other = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Other"))
    return kept.select("doc_id", "seq", F.col("s_name").alias("src"), F.col("o_name").alias("dst"), code_or_default(F.col("code")).alias("code"), other("s_type").alias("st"), other("o_type").alias("ot"))


def ends(edge: DataFrame) -> DataFrame:
    """Both ends of each edge as rows, source first: doc_id, at (order), name, type."""
    end = lambda k, n, t: F.struct((F.col("seq") * 2 + k).alias("at"), F.col(n).alias("name"), F.col(t).alias("type"))
    return edge.select("doc_id", F.inline(F.array(end(0, "src", "st"), end(1, "dst", "ot"))))


def nodes(edge: DataFrame) -> DataFrame:
    """doc_id, name, type (as last seen), first (order of appearance), deg (loops count 2, parallel edges each)."""
    return ends(edge).groupBy("doc_id", "name").agg(F.max_by("type", "at").alias("type"), F.min("at").alias("first"), F.count("*").alias("deg"))


def with_centrality(node: DataFrame) -> DataFrame:
    """node with deg_cent. Nodes are counted by an aggregation and a join: a window would hold a whole document in one task."""
    sizes = node.groupBy(F.col("doc_id").alias("__of")).agg(F.count("*").alias("__n"))
    n, sized = F.col("__n"), node.join(sizes, F.col("doc_id").eqNullSafe(F.col("__of")))
    return sized.withColumn("deg_cent", F.when(n > 1, F.col("deg") / (n - 1)).otherwise(F.lit(0.0))).drop("__of", "__n")


def type_distribution(node: DataFrame) -> DataFrame:
    return node.groupBy("doc_id", "type").agg(F.count("*").alias("nodes"))


def flows(edge: DataFrame) -> DataFrame:
    """One pass over the edges for all pair counters: st, ot, code, axes, n."""
    counted = edge.groupBy("doc_id", "st", "code", "ot").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    return counted.withColumn("axis_in", ontology.axis_of(F.col("st"))).withColumn("axis_out", ontology.axis_of(F.col("ot")))


def type_pairs(flow: DataFrame) -> DataFrame:
    return flow.groupBy("doc_id", "st", "ot").agg(F.sum("n").alias("n"))


def type_predicates(flow: DataFrame) -> DataFrame:
    return flow.groupBy("doc_id", "st", "code").agg(F.sum("n").alias("n"))


def pivot_types(flow: DataFrame) -> DataFrame:
    """Square table: a row per subject type, a column per type of the vocabulary, and one for all other types; absent pairs are 0."""
    return _pivoted(flow, "ot", ontology.ENTITY_TYPES)


def pivot_predicates(flow: DataFrame, codes: list[str] | None = None) -> DataFrame:
    return _pivoted(flow, "code", codes or [*ontology.RELATIONS, *ontology.INFERRED_RELATIONS])


def _pivoted(flow: DataFrame, column: str, values: list[str]) -> DataFrame:
    listed = F.when(F.col(column).isin(values), F.col(column)).otherwise(F.lit("unlisted"))
    return flow.withColumn(column, listed).groupBy("doc_id", "st").pivot(column, [*values, "unlisted"]).agg(F.sum("n")).na.fill(0)


def sankey(flow: DataFrame) -> DataFrame:
    """doc_id, stage (in | out), source, target, value, source_index, target_index: blocks in, codes, out, each sorted."""
    inflow = flow.groupBy("doc_id", F.col("axis_in").alias("source"), F.col("code").alias("target")).agg(F.sum("n").alias("value")).withColumn("stage", F.lit("in"))
    outflow = flow.groupBy("doc_id", F.col("code").alias("source"), F.col("axis_out").alias("target")).agg(F.sum("n").alias("value")).withColumn("stage", F.lit("out"))
    labels = inflow.select("doc_id", F.lit(0).alias("block"), F.col("source").alias("label")).union(inflow.select("doc_id", F.lit(1), "target")).union(outflow.select("doc_id", F.lit(2), "target")).distinct()
    index = labels.withColumn("index", (F.row_number().over(Window.partitionBy("doc_id").orderBy("block", "label")) - 1).cast("long"))
    both = inflow.unionByName(outflow).withColumn("sb", F.when(F.col("stage") == "in", 0).otherwise(1))
    left = index.select("doc_id", F.col("block").alias("sb"), F.col("label").alias("source"), F.col("index").alias("source_index"))
    right = index.select("doc_id", (F.col("block") - 1).alias("sb"), F.col("label").alias("target"), F.col("index").alias("target_index"))
    return both.join(left, ["doc_id", "sb", "source"]).join(right, ["doc_id", "sb", "target"]).select("doc_id", "stage", "source", "target", "value", "source_index", "target_index")


def catalog(triples: DataFrame) -> DataFrame:
    """Per document, and in total (doc_id null): triples, nodes (name, type) and cascade edges."""
    own = triples.rollup("doc_id").agg(F.count("*").alias("triples"), F.count_if(F.col("code").isin(ontology.CASCADE)).alias("cascade"))
    stored = sides(triples).filter("name <> ''").select("doc_id", "name", "type").distinct().groupBy("doc_id").agg(F.count("*").alias("nodes"))
    stored = stored.rollup("doc_id").agg(F.sum("nodes").alias("nodes"))
    return own.join(stored, own.doc_id.eqNullSafe(stored.doc_id), "left").select(own.doc_id, "triples", F.coalesce("nodes", F.lit(0)).alias("nodes"), "cascade")


def merged_nodes(triples: DataFrame) -> DataFrame:
    """Stored nodes over all documents: (name, type), props (the last value of each key, subject before object), source_docs in
    order of loading: doc_seq (where triples have it), then doc_id."""
    if "doc_seq" not in triples.columns:
        triples = triples.withColumn("doc_seq", F.lit(None).cast("int"))
    rows = sides(triples, props=True).filter(F.length("name") > 0).select("doc_id", "doc_seq", F.struct("doc_seq", "doc_id", "seq", "side").alias("at"), "name", F.coalesce(F.nullif("type", F.lit("")), F.lit("Other")).alias("type"), "props")
    bags = _last_bags(rows, ["name", "type"], "props")
    loaded = F.array_sort(F.collect_set(F.struct(F.coalesce("doc_seq", F.lit(0)).alias("doc_seq"), "doc_id")))
    seen = rows.groupBy("name", "type").agg(F.count("*").alias("mentions"), F.transform(loaded, lambda d: d["doc_id"]).alias("source_docs"))
    return seen.join(bags, ["name", "type"], "left").withColumn("props", F.coalesce("props", F.from_json(F.lit("{}"), "map<string,string>")))


def merged_edges(triples: DataFrame) -> DataFrame:
    """Stored edges over all documents: (s, code, o); evidence, id and document of the last triple, props key-wise from the last."""
    order = ["doc_seq", "doc_id", "seq"] if "doc_seq" in triples.columns else ["doc_id", "seq"]
    rows = triples.filter((F.length("s_name") > 0) & (F.length("o_name") > 0)).withColumn("at", F.struct(*order))
    keys = ["s_name", "s_type", "code", "o_name", "o_type"]
    last = rows.groupBy(*keys).agg(F.count("*").alias("triples"), F.max_by("id", "at").alias("id"), F.max("at")["doc_id"].alias("source_doc"))
    if "p_props" not in triples.columns:
        return last
    return last.join(_last_bags(rows, keys, "p_props"), keys, "left")


def _last_bags(rows: DataFrame, by: list[str], bag: str) -> DataFrame:
    """by, bag: the value that is last by `at`, of each key. Of rows whose bags have the same keys only the last can count, so
    the others go before bags are taken apart: aggregates of strings are sorted, and a task would sort every entry."""
    alike = rows.groupBy(*by, F.array_sort(F.map_keys(bag)).alias("keys")).agg(F.max_by(F.struct("at", bag), "at").alias("last"))
    entries = alike.select(*by, F.col("last.at").alias("at"), F.explode(f"last.{bag}").alias("key", "value")).groupBy(*by, "key").agg(F.max_by("value", "at").alias("value"))
    return entries.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias(bag))


def match_edges(edge: DataFrame, stored: DataFrame) -> DataFrame:
    """Edges whose both ends are stored under name and type."""
    a = stored.select(F.col("name").alias("s_name"), F.col("type").alias("s_type"))
    b = stored.select(F.col("name").alias("o_name"), F.col("type").alias("o_type"))
    return edge.join(a, ["s_name", "s_type"]).join(b, ["o_name", "o_type"])


def causal(edge: DataFrame) -> DataFrame:
    return edge.filter(ontology.is_causal(F.col("code")) & (F.col("src") != F.col("dst")))


def sources_and_sinks(edge: DataFrame) -> DataFrame:
    """doc_id, name, role: source (edges out, none in) or sink (edges in, none out) of the causal graph."""
    c = causal(edge)
    ins, outs = c.select("doc_id", F.col("dst").alias("name")).distinct(), c.select("doc_id", F.col("src").alias("name")).distinct()
    on = ["doc_id", "name"]
    return outs.join(ins, on, "left_anti").withColumn("role", F.lit("source")).union(ins.join(outs, on, "left_anti").withColumn("role", F.lit("sink")))


def stats(edge: DataFrame, node: DataFrame) -> DataFrame:
    e = edge.groupBy("doc_id").agg(F.count("*").alias("edges"), F.countDistinct("code").alias("predicates"), F.count_if(ontology.is_causal(F.col("code"))).alias("causal"))
    n = node.groupBy("doc_id").agg(F.count("*").alias("nodes"), F.countDistinct("type").alias("types"), F.max_by("name", F.struct("deg", -F.col("first"))).alias("hub"), F.max("deg").alias("hub_deg"))
    return n.join(e, "doc_id")


def top_cells(flow: DataFrame) -> DataFrame:
    """Most frequent type pair and (type, code) of each document; ties by name."""
    best = lambda a, b: F.min(F.struct((-F.col("n")).alias("m"), a, b))
    pair = type_pairs(flow).groupBy("doc_id").agg(best("st", "ot").alias("p"))
    pred = type_predicates(flow).groupBy("doc_id").agg(best("st", "code").alias("q"))
    return pair.join(pred, "doc_id").select("doc_id", F.concat_ws("→", "p.st", "p.ot").alias("pair"), (-F.col("p.m")).alias("pair_n"), F.concat_ws("→", "q.st", "q.code").alias("type_code"), (-F.col("q.m")).alias("type_code_n"))


def interpretation(edge: DataFrame, node: DataFrame) -> DataFrame:
    """Per document: most frequent type and code (ties by first appearance), and the causal edges' number and share."""
    types = node.groupBy("doc_id", "type").agg(F.count("*").alias("n"), F.min("first").alias("first"))
    codes = edge.groupBy("doc_id", "code").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    best = lambda df, c: df.groupBy("doc_id").agg(F.max_by(c, F.struct("n", -F.col("first"))).alias(f"top_{c}"), F.max("n").alias(f"top_{c}_n"), F.sum("n").alias(f"all_{c}"))
    causes = edge.groupBy("doc_id").agg(F.count_if(ontology.is_causal(F.col("code"))).alias("causal"))
    rows = best(types, "type").join(best(codes, "code"), "doc_id").join(causes, "doc_id")
    return rows.select("doc_id", "top_type", "top_type_n", "top_code", "top_code_n", "causal", (F.col("causal") / F.col("all_code")).alias("causal_share"))


def fragmentation(labels: DataFrame, label_col: str) -> DataFrame:
    """Per document: communities, the size of the largest, those of one node, and their share."""
    sizes = labels.groupBy("doc_id", label_col).agg(F.count("*").alias("size"))
    one = F.count_if(F.col("size") == 1)
    return sizes.groupBy("doc_id").agg(F.count("*").alias("communities"), F.max("size").alias("largest"), one.alias("singletons"), (one / F.count("*")).alias("singleton_share"))


def force_graph(edge: DataFrame, node: DataFrame) -> tuple[DataFrame, DataFrame]:
    return node.select("doc_id", F.col("name").alias("id"), "type", "deg", ontology.colour_of(F.col("type")).alias("color")), edge.select("doc_id", F.col("src").alias("source"), F.col("dst").alias("target"), "code")


def components(pairs: DataFrame, by: str) -> DataFrame:
    """Connected components of pairs (by, a, b) within `by`: by, node, component (smallest). Min-label rounds with
    pointer jumping; every round is cut by a checkpoint."""
    both = cut_lineage(pairs.select(by, "a", "b").union(pairs.select(by, F.col("b"), F.col("a"))).distinct())
    label = cut_lineage(both.groupBy(by, F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")))
    while True:
        near = both.join(label.select(by, F.col("node").alias("b"), F.col("component").alias("c")), [by, "b"]).groupBy(by, F.col("a").alias("node")).agg(F.min("c").alias("c"))
        nearer = label.join(near, [by, "node"], "left").select(by, "node", "component", F.least("component", F.coalesce("c", "component")).alias("c"))
        up = nearer.select(by, F.col("node").alias("c"), F.col("c").alias("jump"))
        new = cut_lineage(nearer.join(up, [by, "c"], "left").select(by, "node", F.col("component").alias("old"), F.least("c", F.coalesce("jump", "c")).alias("component")))
        changed = not new.filter("old <> component").isEmpty()
        label = new.drop("old")
        if not changed:
            return label
