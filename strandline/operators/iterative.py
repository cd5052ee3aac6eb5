"""Iterative graph operators.

Per document they run in one task each (on the document's distinct edges, as numbers where a document's whole graph is needed);
PageRank and label propagation also have a mode of DataFrame rounds for graphs beyond one task's memory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import ontology
from ..functions.triples import is_complete
from .graph import causal, cut_lineage

DAMPING, ROUNDS, LPA_ROUNDS = 0.85, 60, 30
DEEPEST, BUDGET, KEEP = 6, 2500, 28


def _by_document(edge: DataFrame, node: DataFrame, value: str, kind: str, run: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """doc_id, name, value: run(n, a, b) on each document's distinct edges, in order, in one task. Nodes go there and back as numbers:
    names stay in the JVM, as a document's names take far more memory than its graph. Numbers go there packed by batches, as Spark sorts
    the rows of a task by document, and a row takes several times the memory of its numbers."""
    side = lambda c: node.select(F.col("doc_id").alias(f"of_{c}"), F.col("name").alias(f"name_{c}"), F.col("first").alias(c)).hint("merge")  # noqa: E731  Spark takes nodes for smaller than they are, and would broadcast them
    e = edge.groupBy("doc_id", "src", "dst").agg(F.min("seq").alias("at"))
    for c, end in (("a", "src"), ("b", "dst")):
        e = e.join(side(c), F.col("doc_id").eqNullSafe(F.col(f"of_{c}")) & (F.col(end) == F.col(f"name_{c}")))
    rows = node.select("doc_id", F.col("first").alias("at"), F.col("first").alias("a"), F.lit(-1).cast("long").alias("b")).union(e.select("doc_id", "at", "a", "b"))

    def task(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        nodes, at, a, b = _unpacked(table)
        del table
        nodes, order = np.sort(nodes), np.argsort(at, kind="stable")
        found = run(len(nodes), np.searchsorted(nodes, a[order]), np.searchsorted(nodes, b[order]))
        return pa.table({"of": pa.repeat(key[0], len(nodes)), "at": nodes, value: found})

    packed = rows.mapInArrow(_packed, "doc_id string, nodes long, wide boolean, numbers binary")
    found = packed.groupBy("doc_id").applyInArrow(task, f"of string, at long, {value} {kind}")
    return node.hint("merge").join(found, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("first") == F.col("at"))).select("doc_id", "name", value)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document of a batch: numbers are its nodes (as many as `nodes`), then at, a and b of its edges, of 8 bytes where
    one of them needs it (wide), else of 4."""
    for batch in batches:
        doc = batch.column("doc_id").dictionary_encode("encode")
        of, (at, a, b) = doc.indices.to_numpy(), (batch.column(c).to_numpy() for c in ("at", "a", "b"))
        order = np.argsort(of, kind="stable")
        out = []
        for rows in np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(order) else []:
            ends, edges = rows[b[rows] < 0], rows[b[rows] >= 0]
            numbers = np.concatenate((a[ends], at[edges], a[edges], b[edges]))
            wide = bool(numbers.max() >= 2**31)
            out.append((len(ends), wide, numbers.astype("<i8" if wide else "<i4").tobytes(), of[rows[0]]))
        if out:
            nodes, wide, numbers, which = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([doc.dictionary.take(pa.array(which)), pa.array(nodes, pa.int64()), pa.array(wide), pa.array(numbers, pa.binary())], ["doc_id", "nodes", "wide", "numbers"])


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nodes, and at, a and b of the edges, of a document's rows."""
    nodes, edges = [], []
    for n, wide, numbers in zip(table.column("nodes").to_pylist(), table.column("wide").to_pylist(), table.column("numbers"), strict=True):
        x = np.frombuffer(numbers.as_buffer(), "<i8" if wide else "<i4")
        nodes.append(x[:n])
        edges.append(x[n:].reshape(3, -1))
    at, a, b = np.concatenate(edges, axis=1).astype(np.int64)
    return np.concatenate(nodes).astype(np.int64), at, a, b


def pagerank(edge: DataFrame, node: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, name, pagerank: fixed rounds, parallel edges once, mass of nodes without out-edges spread over all."""

    def run(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.bincount(a, minlength=n)
        rank = np.full(n, 1.0 / n)
        for _ in range(rounds):
            share = np.divide(rank, out, out=np.zeros(n), where=out > 0)
            rank = (1 - damping) / n + damping * (np.bincount(b, weights=share[a], minlength=n) + rank[out == 0].sum() / n)
        return rank

    return _by_document(edge, node, "pagerank", "double", run)


def pagerank_rounds(edge: DataFrame, node: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """The same by DataFrame rounds: one join and one sum a round, each cut by a checkpoint."""
    links = edge.select("doc_id", "src", "dst").distinct()
    links = cut_lineage(links.join(links.groupBy("doc_id", "src").agg(F.count("*").alias("out")), ["doc_id", "src"]))
    size = node.groupBy("doc_id").agg(F.count("*").alias("n"))
    rank = cut_lineage(node.select("doc_id", "name").join(size, "doc_id").join(links.select("doc_id", F.col("src").alias("name"), F.lit(True).alias("leads")).distinct(), ["doc_id", "name"], "left").withColumn("r", 1 / F.col("n")))
    for _ in range(rounds):
        given = links.join(rank.select("doc_id", F.col("name").alias("src"), "r"), ["doc_id", "src"]).groupBy("doc_id", F.col("dst").alias("name")).agg(F.sum(F.col("r") / F.col("out")).alias("got"))
        lost = rank.groupBy("doc_id").agg(F.sum(F.when(F.col("leads").isNull(), F.col("r")).otherwise(0.0)).alias("lost"))
        new = (1 - damping) / F.col("n") + damping * (F.coalesce("got", F.lit(0.0)) + F.col("lost") / F.col("n"))
        rank = cut_lineage(rank.drop("r").join(lost, "doc_id").join(given, ["doc_id", "name"], "left").withColumn("r", new).drop("got", "lost"))
    return rank.select("doc_id", "name", F.col("r").alias("pagerank"))


def communities_in_order(edge: DataFrame, node: DataFrame, rounds: int = LPA_ROUNDS) -> DataFrame:
    """Label propagation in place, in order of appearance; most frequent neighbour label, the smallest of equals.
    doc_id, name, community (by size, then first appearance)."""

    def run(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = np.unique(np.concatenate((a * n + b, b * n + a)))
        src, dst = pairs // n, pairs % n
        at = np.searchsorted(src, np.arange(n + 1))
        label = np.arange(n)
        for _ in range(rounds):
            before = label.copy()
            for v in range(n):
                if at[v] + 1 == at[v + 1]:
                    label[v] = label[dst[at[v]]]
                elif at[v] < at[v + 1]:
                    kinds, counts = np.unique(label[dst[at[v] : at[v + 1]]], return_counts=True)
                    label[v] = kinds[counts.argmax()]
            if (before == label).all():
                break
        kinds, first, counts = np.unique(label, return_index=True, return_counts=True)
        order = np.lexsort((first, -counts))
        place = np.empty(len(kinds), np.int64)
        place[order] = np.arange(len(kinds))
        return place[np.searchsorted(kinds, label)]

    return _by_document(edge, node, "community", "long", run)


def communities_in_step(edge: DataFrame, node: DataFrame, rounds: int = LPA_ROUNDS) -> DataFrame:
    """Synchronous label propagation by DataFrame rounds, until no label changes or `rounds` are done: doc_id, name, label.
    A node's own label is one vote (without it a lone pair would swap labels for ever); labels are names, equal votes go to
    the smallest. Not equal to the other mode."""
    links = edge.filter("src <> dst").select("doc_id", F.col("src").alias("name"), F.col("dst").alias("other"))
    links = links.union(links.select("doc_id", "other", "name")).distinct()
    links = cut_lineage(links.union(node.select("doc_id", "name", "name")))
    label = node.select("doc_id", "name", F.col("name").alias("label"))
    own = F.max(F.when(F.col("other") == F.col("name"), F.col("label")))
    for _ in range(rounds):
        votes = links.join(label.select("doc_id", F.col("name").alias("other"), "label"), ["doc_id", "other"]).groupBy("doc_id", "name", "label").agg(F.count("*").alias("n"), own.alias("own"))
        new = cut_lineage(votes.groupBy("doc_id", "name").agg(F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"].alias("label"), F.max("own").alias("old")))
        label = new.drop("old")
        if new.filter("old <> label").isEmpty():
            break
    return label


def all_causal_paths(edge: DataFrame, node: DataFrame, deepest: int = DEEPEST) -> DataFrame:
    """doc_id, path (array), last_type, score: every simple path of 3 to `deepest` nodes from a source of the causal graph to a
    sink or a damage; a damage as the second node goes on. By joins of a frontier, so the number of paths is not bounded
    by one task; each length is a checkpoint. Parallel edges count once (ranking keeps one path of each pair of ends and length anyway)."""
    c = cut_lineage(causal(edge).select("doc_id", "src", "dst").distinct())
    ins, outs = c.select("doc_id", F.col("dst").alias("src")).distinct(), c.select("doc_id", F.col("src").alias("last"), F.lit(True).alias("leads")).distinct()
    kinds = node.select("doc_id", F.col("name").alias("last"), ontology.axis_of(F.col("type")).alias("axis"), "deg")
    about = cut_lineage(kinds.join(outs, ["doc_id", "last"], "left"))
    starts = c.join(ins, ["doc_id", "src"], "left_anti").select("doc_id", F.col("src").alias("last")).distinct()
    front = starts.join(about, ["doc_id", "last"]).select("doc_id", "last", F.array("last").alias("path"), F.col("deg").alias("score"))
    found = []
    for length in range(2, deepest + 1):
        step = front.join(c.withColumnRenamed("src", "last"), ["doc_id", "last"]).filter(~F.array_contains("path", F.col("dst")))
        step = step.select("doc_id", F.col("dst").alias("last"), F.array_append("path", F.col("dst")).alias("path"), "score")
        step = step.join(about, ["doc_id", "last"]).withColumn("score", F.col("score") + F.col("deg"))
        step = cut_lineage(step)
        if length >= 3:
            found.append(step.filter("leads is null or axis = 'Damage'").select("doc_id", "path", "score"))
            step = step.filter("leads is not null and axis <> 'Damage'")
        front = step.select("doc_id", "last", "path", "score")
    return reduce(DataFrame.union, found)


def best_paths(paths: DataFrame, keep: int = KEEP) -> DataFrame:
    """The longest, then heaviest paths, one for each first node, last node and length; `keep` of each document (place)."""
    named = paths.withColumn("size", F.size("path")).withColumn("text", F.array_join("path", " > "))
    one = named.groupBy("doc_id", F.element_at("path", 1).alias("a"), F.element_at("path", -1).alias("b"), "size").agg(F.min_by(F.struct("path", "score", "text"), F.struct((-F.col("score")).alias("s"), "text")).alias("p"))
    order = Window.partitionBy("doc_id").orderBy(F.desc("size"), F.desc("p.score"), "p.text")
    return one.withColumn("place", F.row_number().over(order).cast("long")).filter(F.col("place") <= keep).select("doc_id", "place", "p.path", F.col("size").cast("long").alias("size"), "p.score", "p.text")


def paths_in_order(edge: DataFrame, node: DataFrame, deepest: int = DEEPEST, budget: int = BUDGET, keep: int = KEEP) -> DataFrame:
    """doc_id, place, text of the kept paths by depth-first search in order of appearance, at most `budget` paths of a document."""
    rows = causal(edge).join(node.select("doc_id", F.col("name").alias("src"), F.col("type").alias("src_type"), F.col("deg").alias("src_deg"), F.col("first").alias("src_at")), ["doc_id", "src"])
    rows = rows.join(node.select("doc_id", F.col("name").alias("dst"), F.col("type").alias("dst_type"), F.col("deg").alias("dst_deg"), F.col("first").alias("dst_at")), ["doc_id", "dst"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        facts = {}
        for p in ("src", "dst"):
            facts |= {r[0]: r[1:] for r in zip(pdf[p], pdf[f"{p}_at"], pdf[f"{p}_deg"], pdf[f"{p}_type"], strict=True)}
        ahead: dict[str, list[str]] = {}
        for r in pdf.sort_values("seq").itertuples():
            ahead.setdefault(r.src, []).append(r.dst)
        damage = {x for x, f in facts.items() if ontology.AXIS.get(f[2]) == "Damage"}
        entered = {d for out in ahead.values() for d in out}
        starts = [x for x in sorted(facts, key=lambda x: facts[x][0]) if x in ahead and x not in entered]
        starts.sort(key=lambda x: (ontology.AXIS.get(facts[x][2]) != "Hazard", -facts[x][1]))
        found: list[tuple[str, ...]] = []
        stack = [(s,) for s in reversed(starts)]
        while stack and len(found) < budget:
            trail = stack.pop()
            end = trail[-1]
            if len(trail) >= 3 and (end not in ahead or end in damage):
                found.append(trail)
                if end in damage:
                    continue
            if len(trail) < deepest:
                stack += [(*trail, v) for v in reversed(ahead.get(end, [])) if v not in trail]
        found.sort(key=lambda p: (-len(p), -sum(facts[x][1] for x in p)))
        chosen = list({(p[0], p[-1], len(p)): p for p in reversed(found)}.values())
        chosen.sort(key=found.index)
        kept = chosen[:keep]
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]] * len(kept), "place": np.arange(1, len(kept) + 1), "text": [" > ".join(p) for p in kept]}).astype({"doc_id": object, "text": object})

    return rows.groupBy("doc_id").applyInPandas(run, "doc_id string, place long, text string")


def path_edges(paths: DataFrame) -> DataFrame:
    """doc_id, src, dst, weight: paths through each edge of the union of paths."""
    pairs = F.arrays_zip(F.slice("path", 1, F.size("path") - 1).alias("src"), F.slice("path", 2, F.size("path") - 1).alias("dst"))
    return paths.select("doc_id", F.explode(pairs).alias("e")).groupBy("doc_id", F.col("e.src").alias("src"), F.col("e.dst").alias("dst")).agg(F.count("*").alias("weight"))


def path_nodes(paths: DataFrame) -> DataFrame:
    return paths.select("doc_id", F.explode(F.array_distinct("path")).alias("name")).groupBy("doc_id", "name").agg(F.count("*").alias("weight"))


def layers(union: DataFrame) -> DataFrame:
    """doc_id, name, layer: longest distance from a start within the union of paths (doc_id, src, dst). Rounds end when
    nothing moves, or after as many as there are nodes; within a cycle the layer is the one reached by then."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        names, ends = np.unique(np.concatenate((pdf["src"], pdf["dst"])), return_inverse=True)
        a, b = ends[: len(pdf)], ends[len(pdf) :]
        layer = np.zeros(len(names), np.int64)
        for _ in range(len(names)):
            new = layer.copy()
            np.maximum.at(new, b, layer[a] + 1)
            if (new == layer).all():
                break
            layer = new
        return pd.DataFrame({"doc_id": pdf["doc_id"].iloc[0], "name": names, "layer": layer})

    return union.select("doc_id", "src", "dst").groupBy("doc_id").applyInPandas(run, "doc_id string, name string, layer long")


def connectivity(edge: DataFrame, node: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes (with layer, slot and weight) and edges (with the first causal code and weight) of the union of paths."""
    e = path_edges(paths)
    first = causal(edge).groupBy("doc_id", "src", "dst").agg(F.min_by("code", "seq").alias("code"))
    placed = layers(e).join(path_nodes(paths), ["doc_id", "name"]).join(node.select("doc_id", "name", "type", "deg"), ["doc_id", "name"])
    by_layer = Window.partitionBy("doc_id", "layer")
    slots = placed.withColumn("slot", (F.row_number().over(by_layer.orderBy(F.desc("deg"), "name")) - 1).cast("long")).withColumn("in_layer", F.count("*").over(by_layer))
    return slots.withColumn("color", ontology.colour_of(F.col("type"))), e.join(first, ["doc_id", "src", "dst"], "left").withColumn("code", F.coalesce("code", F.lit("")))


def trunk(links: DataFrame, placed: DataFrame) -> DataFrame:
    """doc_id, src, dst and weight of the edge that most kept paths share (ties by name), and the greatest layer."""
    heaviest = links.groupBy("doc_id").agg(F.min(F.struct((-F.col("weight")).alias("w"), "src", "dst")).alias("t"))
    deepest = placed.groupBy("doc_id").agg(F.max("layer").alias("max_layer"))
    return heaviest.join(deepest, "doc_id").select("doc_id", "t.src", "t.dst", (-F.col("t.w")).alias("weight"), "max_layer")


def summary(edge: DataFrame, node: DataFrame, labels: DataFrame, label_col: str, paths: DataFrame) -> DataFrame:
    """The row of totals of each document: nodes, edges, types, predicates, communities, major_paths."""
    e = edge.groupBy("doc_id").agg(F.count("*").alias("edges"), F.countDistinct("code").alias("predicates"))
    n = node.groupBy("doc_id").agg(F.count("*").alias("nodes"), F.countDistinct("type").alias("types"))
    c = labels.groupBy("doc_id").agg(F.countDistinct(label_col).alias("communities"))
    p = paths.groupBy("doc_id").agg(F.count("*").alias("major_paths"))
    return n.join(e, "doc_id").join(c, "doc_id").join(p, "doc_id", "left").na.fill(0, ["major_paths"])


def complete_paths(paths: DataFrame, node: DataFrame) -> DataFrame:
    """doc_id and number of kept paths that run from a hazard to a damage. Nodes are never broadcast: they are many, paths few."""
    kind = node.select("doc_id", "name", "type").hint("merge")
    joined = paths.select("doc_id", "place", F.element_at("path", 1).alias("a"), F.element_at("path", -1).alias("b"))
    joined = joined.join(kind.select("doc_id", F.col("name").alias("a"), F.col("type").alias("ta")), ["doc_id", "a"]).join(kind.select("doc_id", F.col("name").alias("b"), F.col("type").alias("tb")), ["doc_id", "b"])
    return joined.groupBy("doc_id").agg(F.count("*").alias("paths"), F.count_if(is_complete(F.col("ta"), F.col("tb"))).alias("complete"))


def community_table(labels: DataFrame, node: DataFrame, label_col: str, most: int = 15, members: int = 6, types: int = 3) -> DataFrame:
    """doc_id, community, size, top_members and top_types of the largest communities; each list is ranked in its own window."""
    rows = labels.join(node.select("doc_id", "name", "type", "deg", "first"), ["doc_id", "name"])
    size = rows.groupBy("doc_id", label_col).agg(F.count("*").alias("size"))
    ranked = size.withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("size"), label_col))).filter(F.col("place") <= most)
    key = ["doc_id", label_col]

    def top(of: DataFrame, value: str, k: int, name: str, *order) -> DataFrame:  # noqa: ANN002
        held = of.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("r") <= k)
        return held.groupBy(*key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", value))), lambda x: x[value]), ", ").alias(name))

    kinds = rows.groupBy(*key, "type").agg(F.count("*").alias("n"))
    out = ranked.join(top(rows, "name", members, "top_members", F.desc("deg"), "name"), key).join(top(kinds, "type", types, "top_types", F.desc("n"), "type"), key)
    return out.select("doc_id", F.col(label_col).alias("community"), "size", "top_members", "top_types")


def central(node: DataFrame, rank: DataFrame, top: int = 30) -> DataFrame:
    """The first max(top, 20) nodes of each document by degree, then PageRank, then name."""
    order = Window.partitionBy("doc_id").orderBy(F.desc("deg"), F.desc(F.round("pagerank", 9)), "name")
    rows = node.join(rank, ["doc_id", "name"]).withColumn("place", F.row_number().over(order).cast("long")).filter(F.col("place") <= max(top, 20))
    return rows.select("doc_id", "place", "name", "type", "deg", "pagerank")
