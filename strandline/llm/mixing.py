"""Mixing sources to target weights by Sainte-Lague apportionment, with built-in functions only.

Sizes are words. The targets of the sources share 100 % of all words by weight; a target stops at `most` times its
source's size, and what it can't use is shared again by weight (the level where this settles is found in closed
form: sources ascend by limit / weight, and the first whose limit lies above the level of those left ends it).

The words of a source lie in shards (a hash of the document; about SHARD words each, so a hot source has many), in
each shard in a seeded order, and are cut into blocks of BLOCK words (one: so that no source or shard has a short
last block, and a source of few words gets its part). Blocks are allocated to sources by their targets, then to each
source's shards by their sizes, one after another to the highest quotient v / (2 * seats + 1). Only the last few
seats need ranking, however many there are: all quotients above one bound are seats for certain, and all below another
one are none, and both bounds leave about two candidates for each party.

A shard that gets q of its n blocks takes q div n whole rounds and, from a seeded block on, q mod n
blocks in a circle of its (shuffled) order. A document's words taken are its whole rounds and its overlap with
that arc, at most `most` times its size. Seeds are MD5 digests of the id (of the text where the id is null), so reruns
agree; rows of one id are ordered by size and a hash of the text.

Windows over sources, and over the shards of one, hold a row for each (a shard is 262,144 words).

Null texts and texts without words have size 0 and take 0. A null source is a source of its own, the last in
order. Rows that repeat an id are separate documents. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import stored

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 1
SHARD = 1 << 18


def seeded(*parts: Column | str) -> Column:
    """32 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("null")) for p in parts])), 1, 8), 16, 10).cast("long")


def apportion(parties: DataFrame, within: list[str], party: list[str], votes: str, seats: str, as_name: str) -> DataFrame:
    """Sainte-Lague: parties with `as_name`, the seats of each out of the column `seats` of its group (`within`).

    Equal quotients go to the first party by name. A group without votes gets no seats."""
    group = Window.partitionBy(*within)
    n, v = F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(group), F.sum(F.col(votes).cast("double")).over(group)
    sized = parties.withColumn("__n", n).withColumn("__v", v)
    # With divisor V / (S - n/2) at most S seats are given, with V / (S + n/2) at least S.
    share = F.when(F.col("__v") > 0, F.col(votes).cast("double") / F.col("__v")).otherwise(0.0)
    sure = F.greatest(F.floor(share * F.greatest(F.col(seats) - F.col("__n") / 2 - 1, F.lit(0.0)) - 0.5), F.lit(0)).cast("long")
    most = F.when(share > 0, F.ceil(share * (F.col(seats) + F.col("__n") / 2 + 1) + 0.5)).otherwise(0).cast("long")
    sized = sized.withColumn("__sure", sure).withColumn("__most", most).withColumn("__left", F.col(seats) - F.sum("__sure").over(group))
    held = sized.filter("__most > __sure").withColumn("__seat", F.explode(F.sequence(F.col("__sure") + 1, F.col("__most"))))
    order = Window.partitionBy(*within).orderBy((F.col(votes).cast("double") / (2 * F.col("__seat") - 1)).desc(), *[F.col(p).asc_nulls_last() for p in party])
    won = held.withColumn("__place", F.row_number().over(order)).filter("__place <= __left").groupBy(*within, *party).agg(F.count("*").alias("__won"))
    keys = list(dict.fromkeys([*within, *party]))
    same = None
    renamed = won.select(*[F.col(k).alias(f"__{k}") for k in keys], "__won")
    for k in keys:
        c = sized[k].eqNullSafe(renamed[f"__{k}"])
        same = c if same is None else same & c
    return sized.join(renamed, same, "left").withColumn(as_name, F.col("__sure") + F.coalesce("__won", F.lit(0))).select(*parties.columns, as_name)


def targets(sizes: DataFrame, weights: list[int], most: int) -> DataFrame:
    """source, source_size, rank, target of each source of sizes (source, size); one row for each source is handled in order."""
    every = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = every.withColumn("rank", F.row_number().over(by_name)).withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1).cast("int") % len(weights) + 1))
    level = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("rank").asc())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    after = level.rowsBetween(0, Window.unboundedFollowing)
    whole = level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole)
    tried = weighed.withColumn("limit", (F.col("source_size") * most).cast("double")).withColumn(
        "level", (total - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))) / F.sum("w").over(after)
    )
    settled = tried.withColumn("level", F.min(F.when(F.col("level") <= F.col("limit") / F.col("w"), F.struct(F.col("limit") / F.col("w"), "rank", "level"))).over(whole)["level"])
    return settled.select("source", "source_size", "rank", F.coalesce(F.least("limit", F.col("w") * F.col("level")), F.lit(0.0)).alias("target"))


def mix_sources(df: DataFrame, id_col: str, source_col: str, text_col: str, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: int = 1, block: int = BLOCK, shard: int = SHARD, with_row: bool = False) -> DataFrame:
    """id, source, size, source_size, target and taken of every row; with_row: df's own columns too."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = df.select(F.struct(*df.columns).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"), F.when(F.col(id_col).isNull(), F.md5(text_col)).alias("unnamed"), F.xxhash64(text_col).alias("tie"))
    rows = rows if with_row else rows.drop("row")
    rows = stored(rows)
    shares = stored(targets(rows, list(weights), most))
    of_source = apportion(
        shares.withColumn("all", F.lit(1)).withColumn("seats", F.round(F.sum("target").over(Window.partitionBy("all")) / block).cast("long")), ["all"], ["source"], "target", "seats", "blocks"
    ).drop("all", "seats")
    name = F.coalesce(F.col("id").cast("string"), "unnamed")
    parts = F.greatest(F.ceil(F.col("source_size") / shard), F.lit(1)).cast("long")
    placed = rows.join(shares.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "rank")
    placed = placed.withColumn("shard", seeded(F.lit(seed), name) % parts).withColumn("place", seeded(F.lit(seed + 1), name))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    shards = shards.join(of_source.select(F.col("source").alias("__source"), "blocks"), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    shards = apportion(shards, ["source"], ["shard"], "shard_size", "blocks", "quota")
    there = F.ceil(F.col("shard_size") / block)
    quota = F.least(F.col("quota"), most * there)
    shards = shards.select(
        F.col("source").alias("__source"),
        F.col("shard").alias("__shard"),
        "shard_size",
        F.when(there > 0, F.floor(quota / there)).otherwise(0).alias("rounds"),
        F.when(there > 0, quota % there).otherwise(0).alias("arc"),
        F.when(there > 0, seeded(F.lit(seed + 2), "source", "shard") % there).otherwise(0).alias("from_block"),
        there.alias("there"),
    )
    order = Window.partitionBy("source", "shard").orderBy("place", F.col("id").asc_nulls_last(), "size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    laid = placed.withColumn("end", F.sum("size").over(order)).withColumn("begin", F.col("end") - F.col("size"))
    laid = laid.join(shards, F.col("source").eqNullSafe(F.col("__source")) & (F.col("shard") == F.col("__shard")))

    def overlap(a: Column, b: Column) -> Column:
        return F.greatest(F.least(F.col("end"), b, F.col("shard_size")) - F.greatest(F.col("begin"), a), F.lit(0))

    begin = F.col("from_block") * block
    wrapped = F.greatest(F.col("from_block") + F.col("arc") - F.col("there"), F.lit(0)) * block
    taken = F.col("rounds") * F.col("size") + overlap(begin, (F.col("from_block") + F.col("arc")) * block) + overlap(F.lit(0), wrapped)
    out = laid.withColumn("taken", taken.cast("long"))
    if with_row:
        return out.select("row.*", *[F.col(c).alias(f"mix_{c}" if c in df.columns else c) for c in ("size", "source_size", "target", "taken")])
    return out.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "taken")
