"""Triples derived from relational tables, so that every graph operator has data of any size to run on.

Three documents: geo (suppliers, customers, nations, regions), trade (parts, orders, line items) and behaviour (each
user's successive events). `ord` is a struct (src, k1, k2): the order in which mentions count as read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.durable import dealt, hashed
from ..operators.merge import dedup_first, with_ids


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def rows(df: DataFrame, doc: str, src: int, k1: str, k2, s, s_type: str, code: str, o, o_type: str) -> DataFrame:  # noqa: ANN001
        col = lambda c: F.col(c) if isinstance(c, str) else c
        order = F.struct(F.lit(src).alias("src"), F.col(k1).cast("long").alias("k1"), col(k2).cast("long").alias("k2"))
        return df.select(F.lit(doc).alias("doc_id"), order.alias("ord"), col(s).alias("s_name"), F.lit(s_type).alias("s_type"), F.lit(code).alias("code"), col(o).alias("o_name"), F.lit(o_type).alias("o_type"))

    zero = F.lit(0)
    nation, part, orders = t("nation"), t("part"), t("orders")
    flag, status = F.concat(F.lit("flag_"), "l_returnflag"), F.concat(F.lit("order_"), "o_orderstatus")
    item = t("lineitem")
    bought = item.join(hashed(part.select("p_partkey", "p_type")), F.col("l_partkey") == F.col("p_partkey"))
    filled = item.join(hashed(orders.select("o_orderkey", "o_orderstatus")), F.col("o_orderkey") == F.col("l_orderkey"))
    before = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    follows = dealt(t("events").select("user_id", "ts", "event_id", "event_type"), "user_id").withColumn("before", before).filter("before is not null")
    return reduce(
        DataFrame.unionByName,
        [
            rows(t("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")), "geo", 1, "s_suppkey", zero, "s_name", "ResponseActor", "DEPLOYED_TO", "n_name", "Region"),
            rows(nation.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")), "geo", 2, "n_nationkey", zero, "n_name", "Region", "LOCATED_IN", "r_name", "Region"),
            rows(t("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")), "geo", 3, "c_custkey", zero, "c_name", "Population", "LOCATED_IN", "n_name", "Region"),
            rows(part, "trade", 4, "p_partkey", zero, "p_brand", "RiskFactor", "INCREASES_RISK_OF", "p_type", "Event"),
            rows(bought, "trade", 5, "l_orderkey", "l_linenumber", "p_type", "Event", "CASCADES_INTO", flag, "Event"),
            rows(item, "trade", 6, "l_orderkey", "l_linenumber", flag, "Event", "CAUSES", F.concat(F.lit("status_"), "l_linestatus"), "Damage"),
            rows(orders, "trade", 7, "o_orderkey", zero, "o_orderpriority", "NaturalHazard", "TRIGGERS", status, "Event"),
            rows(filled, "trade", 8, "l_orderkey", "l_linenumber", status, "Event", "CASCADES_INTO", flag, "Event"),
            rows(follows, "behaviour", 9, "user_id", "event_id", "before", "Event", "CASCADES_INTO", "event_type", "Event"),
        ],
    )


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ids(dedup_first(mentions(spark, sf_dir)))


def bagged(found: DataFrame) -> DataFrame:
    """The triples with property bags derived from their names, one free key among them."""
    bag = lambda c, t: F.create_map(F.lit("kind"), F.substring(c, 1, 3), F.lit("deaths"), F.length(c).cast("string"), F.lit("order"), F.when(t == "Event", F.when(F.length(c) > 8, "primary").otherwise("late")).otherwise(""))
    out = found.withColumn("s_props", bag(F.col("s_name"), F.col("s_type"))).withColumn("o_props", bag(F.col("o_name"), F.col("o_type")))
    return out.withColumn("p_props", F.create_map(F.lit("time"), F.concat(F.lit("t"), (F.col("seq") % 7).cast("string")), F.lit("effectiveness"), F.element_at(F.array(F.lit("high"), F.lit("low")), (F.col("seq") % 2 + 1).cast("int")))).withColumn("evidence", F.concat_ws(" ", "s_name", "code", "o_name"))


#: The same in SQL, for checks.
MENTIONS_SQL = """
m AS (
  SELECT 'geo' AS doc_id, 1 AS src, s_suppkey::BIGINT AS k1, 0::BIGINT AS k2, s_name, 'ResponseActor' AS s_type, 'DEPLOYED_TO' AS code, n_name AS o_name, 'Region' AS o_type FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'geo', 2, n_nationkey, 0, n_name, 'Region', 'LOCATED_IN', r_name, 'Region' FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'geo', 3, c_custkey, 0, c_name, 'Population', 'LOCATED_IN', n_name, 'Region' FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'trade', 4, p_partkey, 0, p_brand, 'RiskFactor', 'INCREASES_RISK_OF', p_type, 'Event' FROM part
  UNION ALL SELECT 'trade', 5, l_orderkey, l_linenumber, p_type, 'Event', 'CASCADES_INTO', 'flag_' || l_returnflag, 'Event' FROM lineitem JOIN part ON l_partkey = p_partkey
  UNION ALL SELECT 'trade', 6, l_orderkey, l_linenumber, 'flag_' || l_returnflag, 'Event', 'CAUSES', 'status_' || l_linestatus, 'Damage' FROM lineitem
  UNION ALL SELECT 'trade', 7, o_orderkey, 0, o_orderpriority, 'NaturalHazard', 'TRIGGERS', 'order_' || o_orderstatus, 'Event' FROM orders
  UNION ALL SELECT 'trade', 8, l_orderkey, l_linenumber, 'order_' || o_orderstatus, 'Event', 'CASCADES_INTO', 'flag_' || l_returnflag, 'Event' FROM orders JOIN lineitem ON o_orderkey = l_orderkey
  UNION ALL SELECT 'behaviour', 9, user_id, event_id, before, 'Event', 'CASCADES_INTO', event_type, 'Event' FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE before IS NOT NULL
)"""
TRIPLES_SQL = (
    MENTIONS_SQL
    + """,
f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(regexp_replace(s_name, '\\s', '', 'g')), code, lower(regexp_replace(o_name, '\\s', '', 'g')) ORDER BY src, k1, k2, s_name, s_type, o_name, o_type) AS rn FROM m),
t AS (SELECT *, printf('T%04d', seq) AS id FROM (SELECT doc_id, s_name, s_type, code, o_name, o_type, row_number() OVER (PARTITION BY doc_id ORDER BY src, k1, k2, s_name, code, o_name) AS seq FROM f WHERE rn = 1)),
e AS (SELECT doc_id, seq, s_name AS src, o_name AS dst, code, s_type AS st, o_type AS ot FROM t),
ends AS (SELECT doc_id, 2 * seq AS pos, src AS name, st AS type FROM e UNION ALL SELECT doc_id, 2 * seq + 1, dst, ot FROM e),
n AS (SELECT doc_id, name, arg_max(type, pos) AS type, min(pos) AS appears, count(*) AS deg FROM ends GROUP BY ALL)"""
)
BAGS_SQL = """
sides AS (SELECT doc_id, seq, 0 AS side, s_name AS name, s_type AS type FROM t UNION ALL SELECT doc_id, seq, 1, o_name, o_type FROM t),
bags AS (SELECT *, [{'k': 'kind', 'v': left(name, 3)}, {'k': 'deaths', 'v': length(name)::VARCHAR}, {'k': 'order', 'v': CASE WHEN type = 'Event' THEN CASE WHEN length(name) > 8 THEN 'primary' ELSE 'late' END ELSE '' END}] AS bag FROM sides)"""
