"""Exact near-duplicate join of embeddings by cosine: a metric range join on pivots.

On unit vectors cosine >= c is Euclidean distance <= r = sqrt(2 - 2c), a metric. Pivots (farthest-first from a
bounded sample of the vectors) split the space into cells by the nearest pivot. A vector x whose home pivot is p
can have partners in cell q only if it is within r of the border of p and q, which the triangle inequality bounds
by (d(x,q)^2 - d(x,p)^2) / (2 d(p,q)) <= r; there it is replicated. So every vector finds all its partners in its own
home cell, and cells join independently. Vectors of different dimensions are never compared: each dimension has its own
pivots and cells.

Equal vectors are one class (an aggregation on their values) and meet others once, with their multiplicity, so a
vector that many rows share costs as one. A cell's natives are dealt to shares of about CELL bytes by a hash. A task holds
one share and streams the rest past it: the natives of later shares (each pair of shares meets once, and counts
for both) and the vectors of other cells. Both sides are ordered by distance to the pivot, and a block meets only the ring
whose distance differs by at most r, in double-precision matrix products. So memory is bounded by CELL, whatever the
cell's size. Link counts are never emitted as pairs; for components a task emits at most one edge for each of its own
vectors and for each that streams past (its union-find's forest).

Where vectors have no structure (random ones of 64 dimensions lie within r of nearly every border) no partition by
distances prunes, and an exact join compares nearly all pairs; cells are therefore as large as memory allows, as a vector
is shipped once for each share it must meet.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. A null id can't name
a component, but its vector is one: others count it, and it has the component of those that it is linked with (null if none
has an id). Rows that repeat an id are separate vectors; an id's rows may have different components. An empty table gives
no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import stored
from .components import connected_components

#: Bytes of unit vectors that one task holds; pivots are chosen for about as many vectors each.
CELL = 16 << 20
#: Bounded sample (of each dimension) that pivots are chosen from, and most pivots.
SAMPLE, MOST_PIVOTS = 4096, 256
#: Vectors that meet the held ones in one matrix product.
ROWS = 256


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of doubles, each divided by its length; scaled first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def units(column: pa.Array, dimension: int) -> np.ndarray:
    return unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first traversal: spreads pivots, so that borders are far from clusters."""
    if not len(sample):
        return sample
    chosen, far = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(n, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (x @ pivots.T), 0))


class Share:
    """Vectors that a task holds, in order of their distance to the pivot, and what is known of their links."""

    def __init__(self, names: np.ndarray, x: np.ndarray, weight: np.ndarray, pivot: np.ndarray, cosine: float):
        self.pivot, self.cosine, self.radius = pivot, cosine, math.sqrt(max(2 - 2 * cosine, 0)) + 1e-9
        away = np.linalg.norm(x - pivot, axis=1)
        order = np.argsort(away, kind="stable")
        self.names, self.x, self.weight, self.away = names[order], x[order], weight[order], away[order]
        self.links, self.label = np.zeros(len(x), np.int64), np.arange(len(x))
        for k in range(0, len(x), ROWS):
            self._meet(self.x[k : k + ROWS], self.away[k : k + ROWS], self.weight[k : k + ROWS], k)

    def _meet(self, x: np.ndarray, away: np.ndarray, weight: np.ndarray, own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """For vectors in order of distance: their links to held ones, and the place of one of these (-1: none).

        own: place of the vectors where they are held ones themselves."""
        a, b = np.searchsorted(self.away, away[0] - self.radius), np.searchsorted(self.away, away[-1] + self.radius, "right")
        hit = self.x[a:b] @ x.T >= self.cosine
        if own is not None:
            hit[np.arange(len(x)) + own - a, np.arange(len(x))] = False
        i, j = np.nonzero(hit)
        if not len(i):
            return np.zeros(len(x), np.int64), np.full(len(x), -1)
        i += a
        links = np.bincount(j, weights=self.weight[i], minlength=len(x)).astype(np.int64)
        one = np.full(len(x), -1)
        one[j[::-1]] = i[::-1]
        if own is None:
            self.links += np.bincount(i, weights=weight[j], minlength=len(self.x)).astype(np.int64)
            self.label = _merge(self.label, i, one[j])
        else:
            self.links[own : own + len(x)] = links
            self.label = _merge(self.label, i, j + own)
        return links, one

    def stream(self, names: np.ndarray, x: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of vectors that aren't held, those with links: name, number of links to held ones, and one of these."""
        away = np.linalg.norm(x - self.pivot, axis=1)
        order = np.argsort(away, kind="stable")
        links, one = np.zeros(len(x), np.int64), np.full(len(x), -1)
        for k in range(0, len(x), ROWS):
            at = order[k : k + ROWS]
            links[at], one[at] = self._meet(x[at], away[at], weight[at])
        found = one >= 0
        return names[found], links[found], self.names[one[found]]

    def answer(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.names, self.links, self.names[self.label]


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining i and j: repeated min-hooking with pointer jumping."""
    while True:
        a, b = label[i], label[j]
        if (differ := a != b).sum() == 0:
            return label
        low, high = np.minimum(a, b)[differ], np.maximum(a, b)[differ]
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


#: What a vector is to a share: held itself, of a later share of the cell, of another cell.
HELD, LATER, FOREIGN = 0, 1, 2


def _natives(dimension: int) -> int:
    """Vectors of a share."""
    return max(64, CELL // (8 * dimension))


def _pivots(classes: DataFrame, dimension: int, n: int) -> np.ndarray:
    """About one pivot for every CELL bytes of the n vectors of a dimension."""
    wanted = max(1, min(MOST_PIVOTS, n // _natives(dimension)))
    own = classes.filter(F.col("dimension") == dimension)
    drawn = own.filter(F.pmod(F.xxhash64(F.lit("pivot"), "k1"), F.lit(n)) < SAMPLE).select("v").orderBy("k1").limit(SAMPLE).collect() if wanted > 1 else []
    drawn = drawn or own.select("v").orderBy("k1").limit(1).collect()
    return choose_pivots(unit(np.array([r["v"] for r in drawn], np.float64)), wanted)


def near_duplicates(df: DataFrame, id_col: str, vector_col: str, cosine: float = 0.9) -> DataFrame:
    """id, n_links, component_id and kept of every row."""
    spark = df.sparkSession
    item = "float" if df.schema[vector_col].dataType.elementType.typeName() == "float" else "double"
    zero = F.lit(0.0).cast(item)
    rows = df.select(F.col(id_col).alias("id"), F.transform(F.col(vector_col).cast(f"array<{item}>"), lambda e: F.when(e == 0, zero).otherwise(e)).alias("v"))
    bad = F.exists("v", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    good = F.coalesce((F.size("v") > 0) & ~bad & F.exists("v", lambda e: e != 0), F.lit(False))
    # A class is named by two hashes of the vector, and numbered; a row of it carries the vector.
    keyed = rows.select("id", good.alias("good"), F.when(good, F.xxhash64("v")).alias("k1"), F.when(good, F.xxhash64(F.lit(1), "v")).alias("k2"), "v")
    classes = keyed.filter("good").groupBy("k1", "k2").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("v").alias("v"))
    classes = stored(classes.withColumn("no", F.monotonically_increasing_id()).withColumn("dimension", F.size("v")))
    # one number for each dimension that occurs, and its pivots
    sizes = {r["dimension"]: r["n"] for r in classes.groupBy("dimension").agg(F.count("*").alias("n")).collect()}
    pivots = {d: _pivots(classes, d, n) for d, n in sizes.items()}
    radius = math.sqrt(max(2 - 2 * cosine, 0)) + 1e-9

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        between = {d: np.linalg.norm(p[:, None] - p[None], axis=2) for d, p in pivots.items()}
        for batch in batches:
            for d in pc.unique(batch.column(0)).to_pylist():
                part = batch.filter(pc.equal(batch.column(0), d))
                far = distances(units(part.column(3), d), pivots[d])
                home = far.argmin(axis=1)
                rows = np.arange(len(far))
                with np.errstate(divide="ignore", invalid="ignore"):
                    border = (far**2 - far[rows, home][:, None] ** 2) / (2 * between[d][home])
                near = np.where(between[d][home] > 0, border <= radius + 1e-6, False)
                near[rows, home] = True
                i, cell = np.nonzero(near)
                take = pa.array(i)
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), pa.array(cell.astype(np.int32)), pa.array(cell == home[i]), *[part.column(k).take(take) for k in (1, 2, 3)]], ["dimension", "cell", "native", "no", "copies", "v"])

    dealt = stored(classes.select("dimension", "no", "copies", "v").mapInArrow(deal, f"dimension int, cell int, native boolean, no long, copies long, v array<{item}>"))
    natives = F.coalesce(*[F.when(F.col("dimension") == d, F.lit(_natives(d))) for d in sizes], F.lit(1))
    shares = dealt.filter("native").groupBy("dimension", "cell").agg(F.count("*").alias("n")).withColumn("shares", F.ceil(F.col("n") / natives).cast("int"))
    own = F.pmod(F.xxhash64("no"), F.col("shares").cast("long")).cast("int")
    last = F.when(F.col("native"), own).otherwise(F.col("shares") - 1)
    members = dealt.join(shares, ["dimension", "cell"]).withColumn("share", F.explode(F.sequence(F.lit(0), last)))
    role = F.when(~F.col("native"), FOREIGN).when(F.col("share") == own, HELD).otherwise(LATER)
    members = members.select("dimension", "cell", "share", role.alias("role"), "no", "copies", "v")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        share: Share | None = None
        key: list[int] = []

        def told(names: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names), pa.array(links), pa.array(root)], ["no", "links", "root"])

        def settled() -> Share:
            table = pa.Table.from_batches(held).combine_chunks()
            x = units(table["v"].chunk(0), key[0])
            held.clear()
            return Share(table["no"].to_numpy(), x, table["copies"].to_numpy(), pivots[key[0]][key[1]], cosine)

        for batch in batches:
            marks = np.stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = np.concatenate(([0], np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1, [batch.num_rows]))
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if a == b:
                    continue
                *now, role = marks[:, a].tolist()
                if now != key:
                    share = settled() if held else share
                    if share is not None:
                        yield told(*share.answer())
                    share, key = None, now
                part = batch.slice(a, b - a)
                if role == HELD:
                    held.append(part)
                    continue
                share = settled() if held else share
                if share is not None:  # a share that the hash left empty has nothing to meet
                    names, links, root = share.stream(part.column(4).to_numpy(), units(part.column(6), key[0]), part.column(5).to_numpy())
                    yield told(names, links if role == LATER else np.zeros_like(links), root)
        share = settled() if held else share
        if share is not None:
            yield told(*share.answer())

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["dimension", "cell", "share"]
    joined = stored(members.repartition(n, *keys).sortWithinPartitions(*keys, "role").mapInArrow(join, "no long, links long, root long"))
    components = connected_components(joined.filter("no <> root").select(F.col("no").alias("a"), F.col("root").alias("b")))
    linked = stored(components.withColumnRenamed("node", "no").join(classes.select("no", "least"), "no"))
    named = linked.join(linked.groupBy("component").agg(F.min("least").alias("component_id")), "component").select("no", "component_id")
    counted = joined.groupBy("no").agg(F.sum("links").alias("links"))
    found = classes.select("no", "k1", "k2", "copies", "least").join(counted, "no", "left").join(named, "no", "left")
    of_class = stored(found.select("k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")))
    # Rows meet their class by the hashes of their vector.
    told = keyed.select("id", "good", "k1", "k2").join(of_class, ["k1", "k2"], "left")
    out = told.select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.when(F.col("good"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    kept = F.when(F.col("id").isNull(), F.col("component_id").isNull()).otherwise(F.col("id") == F.col("component_id"))
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", kept.alias("kept"))
