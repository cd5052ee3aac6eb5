"""The dashboard of documents: all views of their graphs as one JSON payload in a page."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph, iterative, merge
from ..sources import sinks


def views(triples: DataFrame, top: int = 30) -> dict[str, DataFrame]:
    """The tables of the page, by name; each has doc_id."""
    edge = graph.cut_lineage(graph.edges(triples))
    node = graph.cut_lineage(graph.nodes(edge))
    flow = graph.cut_lineage(graph.flows(edge))
    paths = graph.cut_lineage(iterative.best_paths(iterative.all_causal_paths(edge, node)))
    placed, links = (graph.cut_lineage(df) for df in iterative.connectivity(edge, node, paths))
    labels = graph.cut_lineage(iterative.communities_in_order(edge, node))
    rank = graph.with_centrality(node).join(iterative.central(node, iterative.pagerank(edge, node), top).select("doc_id", "name", "place", "pagerank"), ["doc_id", "name"]).join(labels, ["doc_id", "name"])
    central = rank.select("doc_id", "place", "name", "type", "deg", F.round("deg_cent", 4).alias("deg_cent"), F.round("pagerank", 5).alias("pagerank"), "community")
    nodes, edges = graph.force_graph(edge, node)
    return {
        "stats": iterative.summary(edge, node, labels, "community", paths),
        "interpretation": graph.interpretation(edge, node),
        "types": merge.type_order(triples),
        "codes": merge.code_order(triples),
        "pair_table": graph.pivot_types(flow),
        "code_table": graph.pivot_predicates(flow),
        "central": central,
        "communities": iterative.community_table(labels, node, "community"),
        "fragmentation": graph.fragmentation(labels, "community"),
        "flows": graph.sankey(flow),
        "paths": paths.select("doc_id", "place", "text", "size", "score"),
        "trunk": iterative.trunk(links, placed),
        "placed": placed.select("doc_id", "name", "type", "layer", "slot", "in_layer", "weight", "deg", "color"),
        "links": links,
        "complete": iterative.complete_paths(paths, node),
        "nodes": nodes.join(labels.withColumnRenamed("name", "id"), ["doc_id", "id"]),
        "edges": edges,
    }


def payload(tables: dict[str, DataFrame]) -> DataFrame:
    """view, json and at: the rows of all views; those of a view are in the order of their columns by `at`, whose upper bits are
    the number of a range of that order. So no task has more of a view than its range."""
    one = [df.select(F.struct(*df.columns).alias("row")).orderBy("row").select(F.lit(name).alias("view"), F.to_json("row").alias("json"), F.monotonically_increasing_id().alias("at")) for name, df in tables.items()]
    return reduce(DataFrame.union, one)


def whole(tables: dict[str, DataFrame], title: str, home: str) -> DataFrame:
    """The page in parts: part, html."""
    return sinks.dashboard(payload(tables), sorted(tables), title, home)


def page(triples: DataFrame, title: str, home: str, top: int = 30) -> tuple[Iterator[str], dict]:
    """The page of one document, part by part, and its row of totals."""
    tables = views(triples, top)
    row = tables["stats"].drop("doc_id").first()
    parts = whole(tables, title, home).orderBy("part")
    return (r["html"] for r in parts.toLocalIterator()), row.asDict() if row else {}
