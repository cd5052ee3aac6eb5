"""Queries that the graph is built for, and inferred temporal order. Extensions: declared in the vocabulary, computed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def leading_time(text: Column) -> Column:
    """The instant that a free date text begins with (year, month, day or minute), else null."""
    day = F.regexp_extract(text, r"^\s*(\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2})?)", 1)
    month, year = F.regexp_extract(text, r"^\s*(\d{4}-\d{2})", 1), F.regexp_extract(text, r"^\s*(\d{4})", 1)
    full = F.when(day != "", day).when(month != "", F.concat(month, F.lit("-01"))).when(year != "", F.concat(year, F.lit("-01-01")))
    return F.try_to_timestamp(full)


def precedes(happenings: DataFrame, by: str = "doc_id", time_col: str = "ts", key: str = "name") -> DataFrame:
    """PRECEDES between neighbours in time within `by`: src, dst (ties by name). Linear, where all pairs are quadratic; the rest is transitive."""
    order = Window.partitionBy(by).orderBy(time_col, key)
    rows = happenings.filter(F.col(time_col).isNotNull()).withColumn("dst", F.lead(key).over(order)).withColumn("gap", F.lead(time_col).over(order))
    return rows.filter("dst is not null").select(by, F.col(key).alias("src"), "dst", F.lit("PRECEDES").alias("code"), (F.col(time_col) < F.col("gap")).alias("strict"))


def cascade_chains(edge: DataFrame, codes: tuple[str, ...] = ("TRIGGERS", "CASCADES_INTO", "TRIGGERS_SECONDARY")) -> DataFrame:
    """Two-step chains a -> b -> c of distinct nodes over cascade codes."""
    step = edge.filter(F.col("code").isin(*codes)).select("doc_id", "src", "dst").distinct()
    a, b = step.alias("x"), step.alias("y")
    joined = a.join(b, (F.col("x.doc_id") == F.col("y.doc_id")) & (F.col("x.dst") == F.col("y.src")))
    return joined.filter("x.src <> x.dst and y.src <> y.dst and x.src <> y.dst").select(F.col("x.doc_id").alias("doc_id"), F.col("x.src").alias("a"), F.col("x.dst").alias("b"), F.col("y.dst").alias("c"))


def amplifiers(edge: DataFrame) -> DataFrame:
    """Exposures that amplify damages: doc_id, name, damages."""
    return edge.filter("code = 'AMPLIFIES' and ot = 'Damage'").groupBy("doc_id", F.col("src").alias("name")).agg(F.countDistinct("dst").alias("damages"))


def risk_factors(edge: DataFrame) -> DataFrame:
    """Events with the number of risk factors that raise their risk."""
    return edge.filter("code = 'INCREASES_RISK_OF' and st = 'RiskFactor' and ot = 'Event'").groupBy("doc_id", F.col("dst").alias("event")).agg(F.countDistinct("src").alias("factors"))


def effectiveness(triples: DataFrame, codes: tuple[str, ...] = ("MITIGATES", "PREVENTS", "MODIFIES_RISK_OF", "RESPONDS_TO")) -> DataFrame:
    """code, effectiveness, n of response relations, by the relation's own property."""
    rows = triples.filter(F.col("code").isin(*codes))
    return rows.groupBy("code", F.coalesce(F.element_at("p_props", F.lit("effectiveness")), F.lit("")).alias("effectiveness")).agg(F.count("*").alias("n"))
