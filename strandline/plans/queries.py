"""A query for each operator on the derived triples and the text tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import ontology
from ..functions import text as X
from ..functions import triples as P
from ..operators import checks, chunking, graph, iterative, merge, predict, resolve, schema_state
from ..operators.durable import scratch, stored
from ..sources import documents, extractions, sinks
from ..streaming import state
from . import dashboard
from .corpus import BAGS_SQL, MENTIONS_SQL, TRIPLES_SQL, bagged, mentions, triples

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

QUOTED = lambda xs: ", ".join(f"'{x}'" for x in xs)
CAUSAL, CASCADE, TYPES = QUOTED(ontology.CAUSAL), QUOTED(ontology.CASCADE), QUOTED(ontology.ENTITY_TYPES)
CODES = QUOTED([*ontology.RELATIONS, *ontology.INFERRED_RELATIONS])
AXIS_SQL = lambda c: "CASE " + " ".join(f"WHEN {c} IN ({QUOTED(ts)}) THEN '{a}'" for a, ts in ontology.AXIS_TYPES.items()) + " ELSE 'Other' END"
ALLOWED = ", ".join(f"('{c}', '{a}', '{b}')" for c, (xs, ys) in {**ontology.RELATIONS, **ontology.INFERRED_RELATIONS}.items() for a in xs for b in ys)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def on_triples(select: str, more: str = "", recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{TRIPLES_SQL}{',' + more if more else ''} {select}"


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def graph_of(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Edges and nodes, computed once for queries that use them repeatedly."""
    edge = graph.cut_lineage(graph.edges(triples(spark, sf_dir)))
    return edge, graph.cut_lineage(graph.nodes(edge))


def paths_of(edge: DataFrame, node: DataFrame) -> DataFrame:
    return graph.cut_lineage(iterative.best_paths(iterative.all_causal_paths(edge, node)))


# ---- text and documents


@query("SELECT doc_id, md5(lower(regexp_replace(coalesce(text, ''), '[\\s\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{000b}]+', '', 'g'))) AS norm_md5 FROM documents")
def norm_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir).select("doc_id", F.md5(X.norm(F.col("text"))).alias("norm_md5"))


NAMES = "SELECT p_partkey, p_name || ' ' || p_brand || ' (' || p_type || ') [' || p_size || ']' AS name FROM part"


def part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_name", F.lit(" "), "p_brand", F.lit(" ("), "p_type", F.lit(") ["), F.col("p_size").cast("string"), F.lit("]"))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))


@query(f"SELECT p_partkey, regexp_replace(regexp_replace(lower(name), '[\\(\\[][^\\)\\]]*[\\)\\]]', '', 'g'), '[^0-9a-z]', '', 'g') AS loose FROM ({NAMES})")
def loose_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_names(spark, sf_dir).select("p_partkey", X.loose_key(F.col("name")).alias("loose"))


@query(f"SELECT p_partkey, trim(regexp_replace(lower(name), '(\\s*[\\(\\[][^\\)\\]]*[\\)\\]]\\s*)+$', '')) AS base FROM ({NAMES})")
def base_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_names(spark, sf_dir).select("p_partkey", X.base_name(F.col("name")).alias("base"))


@query(f"SELECT p_partkey, regexp_replace(regexp_replace(trim(lower('  ' || name || ' \"x\" ')), '[''\"`´]', '''', 'g'), '\\s+', ' ', 'g') AS form FROM ({NAMES})")
def trivial_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_names(spark, sf_dir).select("p_partkey", X.trivial_norm(F.concat(F.lit("  "), "name", F.lit(' "x" '))).alias("form"))


@query(
    """WITH k AS (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_name || ' ' || p_type), '[0-9a-z]+')) AS a, list_distinct(regexp_extract_all(lower(p_type || ' ' || p_brand), '[0-9a-z]+')) AS b FROM part)
    SELECT p_partkey, round(CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard FROM k"""
)
def tokens_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = X.tokens(F.concat_ws(" ", "p_name", "p_type")), X.tokens(F.concat_ws(" ", "p_type", "p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", F.round(X.jaccard(a, b), 6).alias("jaccard"))


@query(
    "SELECT page_id, md5(replace(replace(replace(replace(replace(replace(replace(regexp_replace(replace(html, '</w:p>', chr(10)), '<[^>]+>', '', 'g'), '&#x27;', ''''), '&#39;', ''''), '&apos;', ''''), '&quot;', '\"'), '&gt;', '>'), '&lt;', '<'), '&amp;', '&')) AS text_md5 FROM pages"
)
def html_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.md5(X.strip_markup(F.col("html"), X.xml_unescape)).alias("text_md5"))


@query("SELECT p_partkey, CASE WHEN length(p_type) > 17 THEN left(p_type, 16) || '…' ELSE p_type END AS short, replace(replace(replace(replace(replace('<' || p_name || '&''\"', '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS escaped FROM part")
def short_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.shortened(F.col("p_type")).alias("short"), X.html_escape(F.concat(F.lit("<"), "p_name", F.lit("&'\""))).alias("escaped"))


@query("SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n_bytes, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(string_split(text, chr(10))) - (CASE WHEN ends_with(text, chr(10)) THEN 1 ELSE 0 END) END AS n_lines FROM documents")
def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.size_report(docs(spark, sf_dir))


LINES_SQL = """l AS (SELECT doc_id, ends_with(coalesce(text, ''), chr(10)) AS ended, CASE WHEN coalesce(text, '') = '' THEN []::VARCHAR[] ELSE string_split(CASE WHEN ends_with(text, chr(10)) THEN left(text, length(text) - 1) ELSE text END, chr(10)) END AS lines FROM documents),
c AS (SELECT *, len(lines) AS n, greatest(1, least(40, ceil(len(lines) / 5.0)::INT)) AS chunks FROM l),
p AS (SELECT doc_id, lines, n, ended, i AS chunk_no, greatest(0, i * (n // chunks + 1) - 2) AS "start", least(n, (i + 1) * (n // chunks + 1)) AS "end" FROM c, LATERAL (SELECT unnest(range(chunks)) AS i))"""


@query(f'WITH {LINES_SQL} SELECT doc_id, chunk_no::INT AS chunk_no, "start"::INT AS "start", "end"::INT AS "end" FROM p')
def chunk_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.plan(docs(spark, sf_dir).select("doc_id", "text"), F.lit(5), overlap=2).select("doc_id", "chunk_no", "start", "end")


@query(f"""WITH {LINES_SQL} SELECT doc_id, chunk_no::INT AS chunk_no, md5(array_to_string(lines["start" + 1 : "end"], chr(10)) || CASE WHEN "end" > "start" AND ("end" < n OR ended) THEN chr(10) ELSE '' END) AS text_md5, printf('chunk_%02d.txt', chunk_no) AS file FROM p""")
def chunk_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.chunks(docs(spark, sf_dir).select("doc_id", "text"), F.lit(5), overlap=2).select("doc_id", "chunk_no", F.md5("text").alias("text_md5"), "file")


@query("SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 450 WHEN doc_id % 5 = 1 THEN 900 WHEN doc_id % 5 = 2 THEN 1700 WHEN doc_id % 5 = 3 THEN 1700 ELSE 77 END AS target FROM documents")
def density_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("doc_id") % 5
    density = F.when(k == 0, "high").when(k == 1, "중밀").when(k == 2, "low").when(k == 3, "unknown").otherwise("high")
    return docs(spark, sf_dir).select("doc_id", chunking.target_lines(density, F.when(k == 4, 77).otherwise(0)).alias("target"))


@query("SELECT coalesce(nullif(regexp_replace(name, '\\D', '', 'g'), ''), name) AS chunk, CASE WHEN ext IN ('.pdf', '.docx', '.txt', '.md') THEN ext END AS ext, count(*) AS n FROM (SELECT regexp_extract(url, '([^/]*)$', 1) AS name, lower(regexp_extract(url, '\\.[^./]+$', 0)) AS ext FROM pages) GROUP BY ALL")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = documents.extension(F.col("url"))
    return table(spark, sf_dir, "pages").groupBy(documents.chunk_id(F.col("url")).alias("chunk"), F.when(ext.isin(*documents.FORMATS), ext).alias("ext")).agg(F.count("*").alias("n"))


# ---- merge and validation


@query(on_triples("SELECT doc_id, s_name, s_type, code, o_name, o_type FROM t"))
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.dedup_first(mentions(spark, sf_dir)).drop("ord")


@query(on_triples("SELECT doc_id, id, seq, s_name, code, o_name FROM t"))
def triple_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triples(spark, sf_dir).select("doc_id", "id", "seq", "s_name", "code", "o_name")


@query(on_triples("SELECT doc_id, type, count(*) AS mentions FROM ends GROUP BY ALL"))
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.entity_mentions(triples(spark, sf_dir))


@query(on_triples(f"SELECT doc_id, code, grouping_id(doc_id, code)::BIGINT AS level, count(*) AS triples, count(*) FILTER (code IN ({CASCADE})) AS cascade FROM (SELECT doc_id, CASE WHEN seq % 17 <> 0 THEN code END AS code FROM t) GROUP BY ROLLUP (doc_id, code)"))
def predicate_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = triples(spark, sf_dir)
    return merge.predicate_distribution(found.withColumn("code", F.when(F.col("seq") % 17 != 0, F.col("code"))))


@query(on_triples("SELECT doc_id, type, count(*) AS mentions, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(pos)) AS place FROM ends GROUP BY doc_id, type"))
def type_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.type_order(triples(spark, sf_dir))


@query(on_triples("SELECT doc_id, code, count(*) AS mentions, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, min(seq)) AS place FROM t GROUP BY doc_id, code"))
def code_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.code_order(triples(spark, sf_dir))


EMERGENT = "k AS (SELECT doc_id, type AS owner, unnest(bag).k AS key FROM bags)"


@query(
    on_triples(
        "SELECT *, row_number() OVER (PARTITION BY doc_id, owner ORDER BY cnt DESC, key) AS key_place, dense_rank() OVER (PARTITION BY doc_id ORDER BY owner_total DESC, owner) AS owner_place FROM (SELECT doc_id, owner, key, count(*) AS cnt, sum(count(*)) OVER (PARTITION BY doc_id, owner)::BIGINT AS owner_total FROM k GROUP BY doc_id, owner, key)",
        f"{BAGS_SQL}, {EMERGENT}",
    )
)
def emergent_node_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.ordered_schema(merge.emergent_nodes(bagged(triples(spark, sf_dir))))


@query(on_triples("SELECT doc_id, code AS owner, key, count(*) AS cnt FROM t, (VALUES ('time'), ('effectiveness')) v(key) GROUP BY ALL"))
def emergent_rel_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.emergent_relations(bagged(triples(spark, sf_dir)))


@query("SELECT event_id, (props::JSON ->> '$.k') AS count, event_type AS kind, CASE WHEN event_id % 2 = 0 THEN event_type ELSE (props::JSON ->> '$.k') END AS last FROM events")
def bridge_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    aliases = F.create_map(F.lit("k"), F.lit("count"), F.lit("type"), F.lit("kind"), F.lit("x"), F.lit("same"), F.lit("y"), F.lit("same"))
    read = F.from_json("props", P.BAG)
    bag = P.overlay(read, F.create_map(F.lit("type"), F.col("event_type"), F.lit("x"), F.element_at(read, "k"), F.lit("y"), F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise(F.element_at(read, "k"))))
    named = table(spark, sf_dir, "events").select("event_id", P.rename_keys(bag, aliases).alias("b"))
    return named.select("event_id", *[F.element_at("b", k).alias(as_) for k, as_ in (("count", "count"), ("kind", "kind"), ("same", "last"))])


@query("SELECT event_id, event_type AS code, (props::JSON ->> '$.k') AS k FROM events")
def predicate_decoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").withColumn("p", F.when(F.col("event_id") % 2 == 0, F.to_json(F.struct(F.col("event_type").alias("code"), F.from_json("props", P.BAG).alias("properties")))).otherwise(F.col("event_type")))
    props = F.coalesce(F.element_at(P.pred_props(F.col("p")), "k"), F.get_json_object("props", "$.k"))
    return rows.select("event_id", P.pred_code(F.col("p")).alias("code"), props.alias("k"))


MIXED = "x AS (SELECT doc_id, seq, CASE WHEN seq % 11 = 0 THEN 'Robot' ELSE s_type END AS s_type, o_type, CASE WHEN seq % 13 = 0 THEN 'LIKES' ELSE code END AS code FROM t)"


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = triples(spark, sf_dir)
    return found.withColumn("s_type", F.when(F.col("seq") % 11 == 0, "Robot").otherwise(F.col("s_type"))).withColumn("code", F.when(F.col("seq") % 13 == 0, "LIKES").otherwise(F.col("code")))


@query(on_triples(f"SELECT doc_id, type, count(*) AS n FROM (SELECT doc_id, s_type AS type FROM x UNION ALL SELECT doc_id, o_type FROM x) WHERE type NOT IN ({TYPES}) GROUP BY ALL", MIXED))
def invalid_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.invalid_types(mixed(spark, sf_dir)).groupBy("doc_id", "type").agg(F.count("*").alias("n"))


@query(on_triples(f"SELECT doc_id, code, count(*) AS n FROM x WHERE code NOT IN ({CODES}) GROUP BY ALL", MIXED))
def invalid_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.invalid_codes(mixed(spark, sf_dir)).groupBy("doc_id", "code").agg(F.count("*").alias("n"))


@query(on_triples(f"SELECT kind, count(*) AS warnings FROM (SELECT 'type' AS kind FROM x WHERE s_type NOT IN ({TYPES}) UNION ALL SELECT 'type' FROM x WHERE o_type NOT IN ({TYPES}) UNION ALL SELECT 'code' FROM x WHERE code NOT IN ({CODES})) GROUP BY kind", MIXED))
def warning_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.warnings(mixed(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("warnings"))


@query(
    on_triples(
        f"SELECT doc_id, place, total, seq, kind, value FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS total, row_number() OVER (PARTITION BY doc_id ORDER BY seq, side) AS place FROM (SELECT doc_id, seq, 0 AS side, 'type' AS kind, s_type AS value FROM x WHERE s_type NOT IN ({TYPES}) UNION ALL SELECT doc_id, seq, 1, 'type', o_type FROM x WHERE o_type NOT IN ({TYPES}) UNION ALL SELECT doc_id, seq, 2, 'code', code FROM x WHERE code NOT IN ({CODES}))) WHERE place <= 40",
        MIXED,
    )
)
def first_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.first_warnings(mixed(spark, sf_dir))


@query(on_triples(f"SELECT doc_id AS source_document, count(*) AS triple_count, max(types) AS types, max(codes) AS codes FROM t JOIN (SELECT doc_id, string_agg(type || '=' || c, ',' ORDER BY type) AS types FROM (SELECT doc_id, type, count(*) AS c FROM ends GROUP BY ALL) GROUP BY doc_id) a USING (doc_id) JOIN (SELECT doc_id, string_agg(code || '=' || c, ',' ORDER BY code) AS codes FROM (SELECT doc_id, code, count(*) AS c FROM t GROUP BY ALL) GROUP BY doc_id) b USING (doc_id) GROUP BY doc_id"))
def document_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return merge.document_metadata(triples(spark, sf_dir), "none", "v1").select("source_document", "triple_count", text("entity_mention_distribution").alias("types"), text("predicate_distribution").alias("codes"))


# ---- resolution

NODES_SQL = "fr AS (SELECT name, type, count(*) AS freq FROM ends GROUP BY ALL)"


@query(on_triples("SELECT name, type, freq FROM fr", NODES_SQL))
def node_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.node_frequency(triples(spark, sf_dir))


#: Spelling variants of part types and brands, with frequencies.
VARIANTS = """v AS (SELECT name, type, count(*) AS freq FROM (
  SELECT CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN upper(p_type) WHEN 2 THEN '  ' || p_type WHEN 3 THEN p_type || ' (' || p_size || ')' END AS name, 'Event' AS type FROM part
  UNION ALL SELECT CASE p_partkey % 3 WHEN 0 THEN p_brand ELSE p_brand || ' [' || p_partkey % 3 || ']' END, CASE WHEN p_partkey % 7 = 0 THEN 'Facility' ELSE 'RiskFactor' END FROM part) GROUP BY ALL)"""


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    a = F.when(k % 4 == 0, F.col("p_type")).when(k % 4 == 1, F.upper("p_type")).when(k % 4 == 2, F.concat(F.lit("  "), "p_type")).otherwise(F.concat("p_type", F.lit(" ("), F.col("p_size").cast("string"), F.lit(")")))
    b = F.when(k % 3 == 0, F.col("p_brand")).otherwise(F.concat("p_brand", F.lit(" ["), (k % 3).cast("string"), F.lit("]")))
    rows = part.select(a.alias("name"), F.lit("Event").alias("type")).union(part.select(b, F.when(k % 7 == 0, "Facility").otherwise("RiskFactor")))
    return rows.groupBy("name", "type").agg(F.count("*").alias("freq"))


ELECT = "SELECT key, type, first(name ORDER BY freq DESC, length(name) DESC, name) AS canonical, list(name) AS forms FROM {t} GROUP BY key, type HAVING count(*) > 1"
BASE = "trim(regexp_replace(lower(name), '(\\s*[\\(\\[][^\\)\\]]*[\\)\\]]\\s*)+$', ''))"
SPECIFIC = "(length(regexp_replace(key, '[^0-9a-z]', '', 'g')) >= 6 OR len(list_filter(string_split(key, ' '), lambda w: w <> '')) >= 2)"


@query(f"WITH {VARIANTS}, k AS (SELECT *, regexp_replace(trim(lower(name)), '\\s+', ' ', 'g') AS key FROM v), g AS ({ELECT.format(t='k')}) SELECT key, type, canonical, alias FROM (SELECT key, type, canonical, unnest(forms) AS alias FROM g) WHERE alias <> canonical")
def trivial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.trivial_merges(variants(spark, sf_dir))


@query(f"WITH {VARIANTS}, k AS (SELECT * FROM (SELECT *, {BASE} AS key FROM v) WHERE {SPECIFIC}), g AS ({ELECT.format(t='k')}) SELECT key, type, canonical, alias FROM (SELECT key, type, canonical, unnest(forms) AS alias FROM g) WHERE alias <> canonical")
def paren_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.parenthetical_merges(variants(spark, sf_dir))


@query(f"WITH {VARIANTS}, k AS (SELECT * FROM (SELECT *, {BASE} AS key FROM v) WHERE {SPECIFIC}) SELECT key AS base, count(DISTINCT type) AS types, count(DISTINCT name || '|' || type) AS forms FROM k GROUP BY key HAVING count(DISTINCT type) > 1")
def cross_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.cross_type(variants(spark, sf_dir)).select("base", "types", F.size("forms").cast("long").alias("forms"))


PAIRS = """d AS (SELECT DISTINCT p_type || CASE WHEN p_size % 10 = 0 THEN ' no ' || p_size ELSE '' END AS name, 'Event' AS type FROM part),
kk AS (SELECT *, regexp_replace(lower(name), '[^0-9a-z]', '', 'g') AS key, list_distinct(regexp_extract_all(lower(name), '[0-9a-z]+')) AS toks FROM d),
pr AS (SELECT x.type, x.name AS a, y.name AS b FROM kk x JOIN kk y ON x.type = y.type AND x.name < y.name
  WHERE contains(x.key, y.key) OR contains(y.key, x.key) OR len(list_intersect(x.toks, y.toks)) / len(list_distinct(list_concat(x.toks, y.toks))) >= 0.45)"""


def pair_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat("p_type", F.when(F.col("p_size") % 10 == 0, F.concat(F.lit(" no "), F.col("p_size").cast("string"))).otherwise(""))
    return table(spark, sf_dir, "part").select(name.alias("name"), F.lit("Event").alias("type")).distinct()


@query(f"WITH {PAIRS} SELECT type, a, b FROM pr")
def similar_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.similar_pairs(pair_names(spark, sf_dir))


@query(f"""WITH RECURSIVE {PAIRS}, u AS (SELECT a, b FROM pr UNION ALL SELECT b, a FROM pr UNION ALL SELECT a, a FROM pr UNION ALL SELECT b, b FROM pr),
r(a, b) AS (SELECT DISTINCT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT 'Event' AS type, cluster, name, row_number() OVER (PARTITION BY cluster ORDER BY freq DESC, name) AS member_place, dense_rank() OVER (ORDER BY size DESC, cluster) AS cluster_place
FROM (SELECT min(b) AS cluster, a AS name, length(a)::BIGINT AS freq FROM r GROUP BY a) JOIN (SELECT cluster, count(*) AS size FROM (SELECT min(b) AS cluster FROM r GROUP BY a) GROUP BY cluster) USING (cluster)""")
def entity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = pair_names(spark, sf_dir).withColumn("freq", F.length("name").cast("long"))
    return resolve.review_clusters(nodes).select("type", "cluster", "name", "member_place", "cluster_place")


RESOLVED = """h AS (SELECT doc_id, seq, CASE WHEN s_name = 'flag_R' THEN 'flag_A' WHEN s_name = 'order_P' THEN 'order pending' ELSE s_name END AS s_name, s_type, code,
  CASE WHEN o_name = 'flag_R' THEN 'flag_A' WHEN o_name = 'order_P' THEN 'order pending' ELSE o_name END AS o_name, CASE WHEN o_name = 'order_P' THEN 'Context' ELSE o_type END AS o_type, CASE WHEN s_name = 'order_P' THEN 'Context' ELSE s_type END AS st FROM t),
hh AS (SELECT *, row_number() OVER (PARTITION BY doc_id, lower(regexp_replace(s_name, '\\s', '', 'g')), code, lower(regexp_replace(o_name, '\\s', '', 'g')) ORDER BY seq) AS rn FROM h)"""


@query(on_triples("SELECT doc_id, 'T' || lpad((row_number() OVER (PARTITION BY doc_id ORDER BY seq))::VARCHAR, 4, '0') AS id, s_name, st AS s_type, code, o_name, o_type FROM hh WHERE rn = 1", RESOLVED))
def resolve_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([("flag_A", "Event", ["FLAG_R"], None, False, 0, 1), ("order pending", "Context", ["order_P"], None, True, 1, 1)], "canonical string, type string, aliases array<string>, note string, merge_any_type boolean, pos long, version int")
    found = triples(spark, sf_dir).withColumn("ord", F.col("seq"))
    return resolve.apply_registry(found, registry).select("doc_id", "id", "s_name", "s_type", "code", "o_name", "o_type")


@query(f"WITH {VARIANTS}, k AS (SELECT *, regexp_replace(trim(lower(name)), '\\s+', ' ', 'g') AS key FROM v), g AS ({ELECT.format(t='k')}), a AS (SELECT type, canonical, unnest(forms) AS alias FROM g) SELECT canonical, min(type) AS type, string_agg(DISTINCT alias, '|' ORDER BY alias) AS aliases, row_number() OVER (ORDER BY canonical) - 1 AS pos, 2 AS version FROM a WHERE alias <> canonical GROUP BY canonical")
def registry_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    grown = resolve.extend_registry(extractions.empty_registry(spark), resolve.trivial_merges(variants(spark, sf_dir)), "auto")
    return grown.select("canonical", "type", F.array_join("aliases", "|").alias("aliases"), "pos", "version")


# ---- schema state

ORDER_SQL = "(VALUES ('geo', 2), ('trade', 1), ('behaviour', 3)) o(doc_id, doc_seq)"
CONTRIB = f"""{BAGS_SQL}, kk AS (SELECT doc_id, 'node' AS scope, type AS owner, unnest(bag).k AS key FROM bags UNION ALL SELECT doc_id, 'relation', code, key FROM t, (VALUES ('time'), ('effectiveness')) v(key)),
cc AS (SELECT doc_id, doc_seq, scope, CASE WHEN scope = 'node' AND key = 'deaths' THEN 'death' WHEN scope = 'relation' AND key = 'time' THEN 'timing' ELSE key END AS key, owner, count(*) AS cnt FROM kk JOIN {ORDER_SQL} USING (doc_id) GROUP BY ALL)"""


def contributed(spark: SparkSession, sf_dir: str, bridge: DataFrame | None) -> DataFrame:
    order = spark.createDataFrame([("geo", 2), ("trade", 1), ("behaviour", 3)], "doc_id string, doc_seq int")
    return schema_state.contributions(bagged(triples(spark, sf_dir)), order, bridge)


def small_bridge(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("node", "deaths", "death"), ("node", "death", "death"), ("relation", "time", "timing"), ("relation", "timing", "timing")], "scope string, alias string, canonical string")


@query(
    f"""WITH {TRIPLES_SQL}, {CONTRIB}, s AS (SELECT scope, key, owner, sum(cnt)::BIGINT AS c FROM cc GROUP BY ALL), dd AS (SELECT scope, key, doc_id, min(doc_seq) AS q FROM cc GROUP BY ALL)
        SELECT scope, key, sum(c)::BIGINT AS count, string_agg(owner || '=' || c, ',' ORDER BY owner) AS owners, any_value(docs) AS docs, any_value(first_seen) AS first_seen
        FROM s JOIN (SELECT scope, key, string_agg(doc_id, ',' ORDER BY q) AS docs, arg_min(doc_id, q) AS first_seen FROM dd GROUP BY scope, key) USING (scope, key) GROUP BY scope, key"""
)
def master_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listed_schema(schema_state.master(contributed(spark, sf_dir, small_bridge(spark))))


def listed_schema(out: DataFrame) -> DataFrame:
    pairs = F.transform(F.array_sort(F.map_entries("owners")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("scope", "key", "count", F.array_join(pairs, ",").alias("owners"), F.array_join("docs", ",").alias("docs"), "first_seen")


@query(f"WITH {TRIPLES_SQL}, {CONTRIB} SELECT scope, key, sum(cnt)::BIGINT AS count, string_agg(DISTINCT owner, ',' ORDER BY owner) AS owners FROM cc WHERE key NOT IN ('death', 'timing') GROUP BY ALL")
def new_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = schema_state.new_keys(contributed(spark, sf_dir, small_bridge(spark)), small_bridge(spark))
    return out.withColumn("owners", F.array_join("owners", ","))


@query("SELECT * FROM (VALUES ('node', 'deaths', 'death'), ('node', 'death', 'death'), ('relation', 'time', 'timing'), ('relation', 'timing', 'timing'), ('node', 'killed', 'death'), ('node', 'note', 'remark'), ('node', 'remark', 'remark')) b(scope, alias, canonical)")
def bridge_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = spark.createDataFrame([("node", "killed", "death"), ("node", "note", "remark"), ("node", "deaths", "ignored")], "scope string, alias string, canonical string")
    return schema_state.consolidate(small_bridge(spark), decided)


# ---- sources: files that the query writes into the shared folder, and reads


EXTRACTED = """SELECT s_name, s_type, left(s_name, 3) AS s_kind, code, CASE WHEN seq % 2 = 0 THEN 't' || (seq % 7) END AS time, o_name, o_type, CASE WHEN seq % 3 <> 2 THEN left(o_name, 3) END AS o_kind, CASE WHEN seq % 5 = 0 THEN '' ELSE concat_ws(' ', s_name, code, o_name) END AS evidence FROM t"""


def extraction_files(spark: SparkSession, sf_dir: str) -> str:
    """Chunk extractions: bags as properties, as attributes, or as a null beside attributes; predicates as objects or bare codes."""
    found, seq = bagged(triples(spark, sf_dir)), F.col("seq")
    bag = lambda c: F.to_json(F.col(c))
    text = lambda c: F.to_json(F.struct(F.col(c).alias("v"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("v")))) - 6)
    node = lambda p, more: F.concat(F.lit('{"name":'), text(f"{p}_name"), F.lit(',"type":'), text(f"{p}_type"), F.lit(","), more, F.lit("}"))
    subject = node("s", F.concat(F.lit('"properties":'), bag("s_props"), F.lit(',"attributes":{"kind":"unread"}')))
    given = F.when(seq % 3 == 0, F.concat(F.lit('"properties":'), bag("o_props"))).when(seq % 3 == 1, F.concat(F.lit('"attributes":'), bag("o_props"))).otherwise(F.concat(F.lit('"properties":null,"attributes":'), bag("o_props")))
    predicate = F.when(seq % 2 == 0, F.concat(F.lit('{"code":'), text("code"), F.lit(',"properties":'), bag("p_props"), F.lit("}"))).otherwise(text("code"))
    evidence = F.when(seq % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(',"evidence":'), text("evidence")))
    triple = F.concat(F.lit('{"subject":'), subject, F.lit(',"predicate":'), predicate, F.lit(',"object":'), node("o", given), evidence, F.lit("}"))
    chunks = found.groupBy("doc_id", F.pmod(seq, F.lit(16)).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("seq", triple.alias("json")))).alias("t"))
    files, path = chunks.select("doc_id", "chunk", F.concat(F.lit('{"triples":['), F.array_join(F.col("t.json"), ","), F.lit("]}")).alias("value")), scratch(spark)
    files.repartition("doc_id", "chunk").write.partitionBy("doc_id", "chunk").text(path)
    return path


@query(on_triples(EXTRACTED))
def extraction_files_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = extractions.read_extractions(spark, extraction_files(spark, sf_dir), "*.txt")
    return rows.select("s_name", "s_type", F.element_at("s_props", "kind").alias("s_kind"), "code", F.element_at("p_props", "time").alias("time"), "o_name", "o_type", F.element_at("o_props", "kind").alias("o_kind"), "evidence")


@query(on_triples("SELECT doc_id, seq, id, s_name, s_type, code, o_name, o_type, left(s_name, 3) AS s_kind, 't' || (seq % 7) AS time, 'v9' AS ontology_version, count(*) OVER (PARTITION BY doc_id) AS triple_count FROM t"))
def triple_documents_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triple documents written as JSON and read again, with their metadata."""
    found, path = bagged(triples(spark, sf_dir)).withColumn("chunk_id", F.lit("1")), scratch(spark)
    sinks.triple_documents(found, merge.document_metadata(found, "none", "v9")).repartition("doc_id", "part").write.partitionBy("doc_id", "part").text(path)
    rows, about = extractions.read_triple_documents(spark, path)
    # three rows: joined by a shuffle, a document's triples would meet in one task
    joined = rows.join(F.broadcast(about.select("doc_id", "ontology_version", "triple_count")), "doc_id")
    return joined.select("doc_id", "seq", "id", "s_name", "s_type", "code", "o_name", "o_type", F.element_at("s_props", "kind").alias("s_kind"), F.element_at("p_props", "time").alias("time"), "ontology_version", "triple_count")


@query("SELECT 'node' AS scope, unnest(list_concat([p_brand], list(DISTINCT p_type ORDER BY p_type))) AS alias, p_brand AS canonical FROM part GROUP BY p_brand UNION ALL SELECT 'relation', unnest(['timing', 'time', 'when']), 'timing'")
def bridge_file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.array_sort(F.collect_set("p_type")).alias("aliases"), F.lit("string").alias("type"))
    keys = table(spark, sf_dir, "part").groupBy("p_brand").agg(entry.alias("e")).agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "e"))).alias("node_keys"))
    relation = F.create_map(F.lit("timing"), F.struct(F.array(F.lit("time"), F.lit("when")).alias("aliases")))
    path = scratch(spark)
    keys.select(F.to_json(F.struct(F.lit(1).alias("version"), "node_keys", relation.alias("relation_keys")))).coalesce(1).write.text(path)
    return extractions.read_bridge(spark, path).select("scope", "alias", "canonical")


@query(f"WITH {VARIANTS}, k AS (SELECT *, regexp_replace(trim(lower(name)), '\\s+', ' ', 'g') AS key FROM v), g AS ({ELECT.format(t='k')}), a AS (SELECT type, canonical, unnest(forms) AS alias FROM g) SELECT canonical, CASE WHEN min(type) = 'Facility' THEN '' ELSE min(type) END AS type, string_agg(DISTINCT alias, '|' ORDER BY alias) AS aliases, min(type) = 'Facility' AS merge_any_type, row_number() OVER (ORDER BY canonical) - 1 AS pos FROM a WHERE alias <> canonical GROUP BY canonical")
def registry_file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry written and read again; entries without a type keep none."""
    grown = resolve.extend_registry(extractions.empty_registry(spark), resolve.trivial_merges(variants(spark, sf_dir)), "auto")
    untyped, path = F.col("type") == "Facility", scratch(spark)
    sinks.registry_json(grown.withColumn("merge_any_type", untyped).withColumn("type", F.when(~untyped, F.col("type")))).coalesce(1).write.text(path)
    return extractions.read_registry(spark, path).select("canonical", "type", F.array_join("aliases", "|").alias("aliases"), "merge_any_type", "pos")


@query("SELECT * FROM (VALUES " + ", ".join(f"('{c}', {phase}, '{a}', '{b}')" for phase, of in ((1, ontology.RELATIONS), (2, ontology.INFERRED_RELATIONS)) for c, (xs, ys) in of.items() for a in xs for b in ys) + ") r(code, phase, s_type, o_type)")
def ontology_file_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary file written and read again: relations of both phases with their domains and ranges."""
    parts = {f"relations_phase{k}": F.array(*[F.struct(F.lit(c).alias("code"), F.array(*map(F.lit, a)).alias("from"), F.array(*map(F.lit, b)).alias("to")) for c, (a, b) in of.items()]) for k, of in ((1, ontology.RELATIONS), (2, ontology.INFERRED_RELATIONS))}
    path = scratch(spark)
    spark.range(1).coalesce(1).select(F.to_json(F.struct(F.array(*map(F.lit, ontology.ENTITY_TYPES)).alias("entity_types"), *[c.alias(n) for n, c in parts.items()]))).write.text(path)
    return ontology.read_ontology(spark, path)[1].select("code", "phase", F.explode("from").alias("s_type"), "to").select("code", "phase", "s_type", F.explode("to").alias("o_type"))


@query(ORACLE_SQL["master_schema"])
def streamed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """master_schema() by streaming: documents arrive one after another, each as many files, and each is a batch."""
    order = F.create_map(F.lit("geo"), F.lit(2), F.lit("trade"), F.lit(1), F.lit("behaviour"), F.lit(3))
    inbox, folder = scratch(spark), scratch(spark)
    found = bagged(triples(spark, sf_dir)).withColumn("doc_seq", F.element_at(order, F.col("doc_id")))
    for doc in ("geo", "trade", "behaviour"):
        found.filter(F.col("doc_id") == doc).write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(found.schema).parquet(inbox)
        state.start(arriving, folder, f"{folder}/checkpoint", small_bridge(spark)).awaitTermination()
    return listed_schema(state.master_schema(spark, folder))


# ---- relational graph


@query(
    on_triples(
        """SELECT name, type, sum(c)::BIGINT AS mentions, string_agg(doc_id, ',' ORDER BY doc_seq) AS source_docs, arg_max(kind, doc_seq) AS kind, arg_max(held, doc_seq) AS held FROM
        (SELECT left(name, 1) AS name, type, doc_id, doc_seq, count(*) AS c, arg_max(left(name, 3), 2 * seq + side) AS kind, arg_max(doc_id || seq || 'so'[side + 1], 2 * seq + side) AS held FROM sides JOIN """
        + ORDER_SQL
        + """ USING (doc_id) GROUP BY ALL) GROUP BY name, type""",
        BAGS_SQL,
    )
)
def node_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes are names' first letters here, so that one has many bags, of several documents."""
    order = F.create_map(F.lit("geo"), F.lit(2), F.lit("trade"), F.lit(1), F.lit("behaviour"), F.lit(3))
    found = bagged(triples(spark, sf_dir)).withColumn("doc_seq", F.element_at(order, F.col("doc_id")))
    for p in ("s", "o"):
        found = found.withColumn(f"{p}_props", P.overlay(F.col(f"{p}_props"), F.create_map(F.lit("held"), F.concat("doc_id", F.col("seq").cast("string"), F.lit(p))))).withColumn(f"{p}_name", F.substring(f"{p}_name", 1, 1))
    return graph.merged_nodes(found).select("name", "type", "mentions", F.array_join("source_docs", ",").alias("source_docs"), F.element_at("props", "kind").alias("kind"), F.element_at("props", "held").alias("held"))


@query(on_triples("SELECT s_name, s_type, code, o_name, o_type, count(*) AS triples, arg_max(id, doc_id || lpad(seq::VARCHAR, 12, '0')) AS id, max(doc_id) AS source_doc, 't' || (arg_max(seq, doc_id || lpad(seq::VARCHAR, 12, '0')) % 7) AS time FROM t GROUP BY s_name, s_type, code, o_name, o_type"))
def edge_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.merged_edges(bagged(triples(spark, sf_dir))).select("s_name", "s_type", "code", "o_name", "o_type", "triples", "id", "source_doc", F.element_at("p_props", "time").alias("time"))


@query(on_triples("SELECT t.doc_id, count(*) AS edges FROM t JOIN (SELECT DISTINCT name, type FROM ends) a ON s_name = a.name AND s_type = a.type JOIN (SELECT DISTINCT name, type FROM ends) b ON o_name = b.name AND o_type = b.type GROUP BY t.doc_id"))
def edge_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = triples(spark, sf_dir)
    return graph.match_edges(found, graph.merged_nodes(bagged(found))).groupBy("doc_id").agg(F.count("*").alias("edges"))


@query(on_triples("SELECT doc_id, name, type, deg, round(deg / (count(*) OVER (PARTITION BY doc_id) - 1), 6) AS deg_cent FROM n"))
def degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = graph.nodes(graph.edges(triples(spark, sf_dir)))
    return graph.with_centrality(node).select("doc_id", "name", "type", "deg", F.round("deg_cent", 6).alias("deg_cent"))


@query(on_triples("SELECT doc_id, type, count(*) AS nodes FROM n GROUP BY ALL"))
def node_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.type_distribution(graph.nodes(graph.edges(triples(spark, sf_dir))))


@query(on_triples("SELECT doc_id, o_type AS st, " + ", ".join(f"count(*) FILTER (s_type = '{t}') AS \"{t}\"" for t in ontology.ENTITY_TYPES) + f", count(*) FILTER (s_type NOT IN ({TYPES})) AS unlisted FROM x GROUP BY doc_id, o_type", MIXED))
def type_pair_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects against subjects, as subjects have types that the vocabulary doesn't list."""
    flow = graph.flows(graph.edges(mixed(spark, sf_dir)))
    return graph.pivot_types(flow.select("doc_id", F.col("ot").alias("st"), F.col("st").alias("ot"), "n"))


@query(on_triples("SELECT doc_id, s_type AS st, " + ", ".join(f"count(*) FILTER (code = '{c}') AS \"{c}\"" for c in [*ontology.RELATIONS, *ontology.INFERRED_RELATIONS]) + f", count(*) FILTER (code NOT IN ({CODES})) AS unlisted FROM x GROUP BY doc_id, s_type", MIXED))
def pred_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.pivot_predicates(graph.flows(graph.edges(mixed(spark, sf_dir))))


@query(
    on_triples(
        """SELECT w.doc_id, stage, source, target, "value", a.idx AS source_index, b.idx AS target_index FROM w
        JOIN ix a ON a.doc_id = w.doc_id AND a.label = source AND a.block = CASE stage WHEN 'in' THEN 0 ELSE 1 END JOIN ix b ON b.doc_id = w.doc_id AND b.label = target AND b.block = CASE stage WHEN 'in' THEN 1 ELSE 2 END""",
        f"""ax AS (SELECT doc_id, {AXIS_SQL('st')} AS ai, code, {AXIS_SQL('ot')} AS ao FROM e),
        w AS (SELECT doc_id, 'in' AS stage, ai AS source, code AS target, count(*) AS "value" FROM ax GROUP BY ALL UNION ALL SELECT doc_id, 'out', code, ao, count(*) FROM ax GROUP BY ALL),
        ix AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY block, label) - 1 AS idx FROM (SELECT DISTINCT doc_id, 0 AS block, ai AS label FROM ax UNION SELECT DISTINCT doc_id, 1, code FROM ax UNION SELECT DISTINCT doc_id, 2, ao FROM ax))""",
    )
)
def sankey_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.sankey(graph.flows(graph.edges(triples(spark, sf_dir))))


@query(
    on_triples(
        f"SELECT x.doc_id, triples, nodes, cascade FROM (SELECT doc_id, count(*) AS triples, count(*) FILTER (code IN ({CASCADE})) AS cascade FROM t GROUP BY ROLLUP (doc_id)) x JOIN (SELECT doc_id, sum(c)::BIGINT AS nodes FROM (SELECT doc_id, count(DISTINCT name || '|' || type) AS c FROM ends GROUP BY doc_id) GROUP BY ROLLUP (doc_id)) y ON x.doc_id IS NOT DISTINCT FROM y.doc_id"
    )
)
def catalog_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.catalog(triples(spark, sf_dir))


@query(on_triples(f"SELECT doc_id, name, role FROM (SELECT DISTINCT doc_id, src AS name, 'source' AS role FROM ca WHERE NOT EXISTS (FROM ca x WHERE x.doc_id = ca.doc_id AND x.dst = ca.src) UNION SELECT DISTINCT doc_id, dst, 'sink' FROM ca WHERE NOT EXISTS (FROM ca x WHERE x.doc_id = ca.doc_id AND x.src = ca.dst))", f"ca AS (SELECT * FROM e WHERE code IN ({CAUSAL}) AND src <> dst)"))
def sources_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.sources_and_sinks(graph.edges(triples(spark, sf_dir)))


@query(on_triples(f"SELECT a.doc_id, nodes, types, hub, hub_deg, edges, predicates, causal FROM (SELECT doc_id, count(*) AS nodes, count(DISTINCT type) AS types, first(name ORDER BY deg DESC, appears) AS hub, max(deg) AS hub_deg FROM n GROUP BY doc_id) a JOIN (SELECT doc_id, count(*) AS edges, count(DISTINCT code) AS predicates, count(*) FILTER (code IN ({CAUSAL})) AS causal FROM e GROUP BY doc_id) b USING (doc_id)"))
def stats_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = graph.edges(triples(spark, sf_dir))
    return graph.stats(edge, graph.nodes(edge))


@query(on_triples("""SELECT a.doc_id, pair, pair_n, type_code, type_code_n FROM (SELECT doc_id, first(st || '→' || ot ORDER BY c DESC, st, ot) AS pair, max(c) AS pair_n FROM (SELECT doc_id, st, ot, count(*) AS c FROM e GROUP BY ALL) GROUP BY doc_id) a
    JOIN (SELECT doc_id, first(st || '→' || code ORDER BY c DESC, st, code) AS type_code, max(c) AS type_code_n FROM (SELECT doc_id, st, code, count(*) AS c FROM e GROUP BY ALL) GROUP BY doc_id) b USING (doc_id)"""))
def top_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.top_cells(graph.flows(graph.edges(triples(spark, sf_dir))))


@query(
    on_triples(
        f"""SELECT a.doc_id, top_type, top_type_n, top_code, top_code_n, causal, round(causal / edges, 6) AS causal_share FROM (SELECT doc_id, first(type ORDER BY c DESC, f) AS top_type, max(c) AS top_type_n FROM (SELECT doc_id, type, count(*) AS c, min(appears) AS f FROM n GROUP BY ALL) GROUP BY doc_id) a
        JOIN (SELECT doc_id, first(code ORDER BY c DESC, f) AS top_code, max(c) AS top_code_n FROM (SELECT doc_id, code, count(*) AS c, min(seq) AS f FROM e GROUP BY ALL) GROUP BY doc_id) b USING (doc_id) JOIN (SELECT doc_id, count(*) AS edges, count(*) FILTER (code IN ({CAUSAL})) AS causal FROM e GROUP BY doc_id) c USING (doc_id)"""
    )
)
def interpretation(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = graph.edges(triples(spark, sf_dir))
    return graph.interpretation(edge, graph.nodes(edge)).withColumn("causal_share", F.round("causal_share", 6))


@query(on_triples("SELECT doc_id, name AS id, type, deg, CASE type " + " ".join(f"WHEN '{t}' THEN '{c}'" for t, c in ontology.COLOURS.items()) + f" ELSE '{ontology.DEFAULT_COLOUR}' END AS color FROM n"))
def force_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = graph.edges(triples(spark, sf_dir))
    return graph.force_graph(edge, graph.nodes(edge))[0]


@query(on_triples("SELECT doc_id, src AS source, dst AS target, code FROM e"))
def force_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = graph.edges(triples(spark, sf_dir))
    return graph.force_graph(edge, graph.nodes(edge))[1]


# ---- checks and extensions


@query(on_triples(f"SELECT doc_id, code, s_type, o_type, count(*) AS n FROM t WHERE NOT EXISTS (FROM (VALUES {ALLOWED}) a(c, x, y) WHERE c = code AND x = s_type AND y = o_type) GROUP BY ALL"))
def domain_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.domain_range(triples(spark, sf_dir)).groupBy("doc_id", "code", "s_type", "o_type").agg(F.count("*").alias("n"))


@query(on_triples("SELECT doc_id, type, attr, count(*) AS n FROM sides JOIN (VALUES ('NaturalHazard', 'origin'), ('ManmadeHazard', 'origin'), ('Damage', 'category'), ('ResponseAction', 'phase')) r(ty, attr) ON ty = type GROUP BY ALL", BAGS_SQL))
def required_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.missing_attributes(bagged(triples(spark, sf_dir))).groupBy("doc_id", "type", "attr").agg(F.count("*").alias("n"))


@query(on_triples("SELECT doc_id, type, 'order' AS attr, 'late' AS \"value\", count(*) AS n FROM sides WHERE type = 'Event' AND length(name) <= 8 GROUP BY ALL", BAGS_SQL))
def enum_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.bad_values(bagged(triples(spark, sf_dir))).groupBy("doc_id", "type", "attr", "value").agg(F.count("*").alias("n"))


KINDS = ["primary", "secondary", "cascading", "nth", "state", "human", "property", "economic", "service", "infra", "environmental"]
NOTED_SQL = f"sd AS (SELECT *, [{QUOTED(KINDS)}][((seq + side) % 11 + 1)::INT] AS kind FROM sides)"


def noted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triples whose nodes have one of KINDS as order, category, note and disaster type."""
    found = triples(spark, sf_dir)
    for p, side in (("s", 0), ("o", 1)):
        kind = F.element_at(F.array(*map(F.lit, KINDS)), ((F.col("seq") + side) % 11 + 1).cast("int"))
        found = found.withColumn(f"{p}_props", F.create_map(F.lit("order"), kind, F.lit("category"), kind, F.lit("note"), F.when(kind != "nth", kind), F.lit("disasterType"), F.when(kind == "human", "social_fire").otherwise(kind)))
    return found


@query(
    on_triples(
        "SELECT doc_id, CASE WHEN type = 'Event' THEN CASE kind WHEN 'primary' THEN 'PrimaryEvent' WHEN 'secondary' THEN 'SecondaryEvent' WHEN 'cascading' THEN 'CascadingEvent' WHEN 'nth' THEN 'CascadingEvent' ELSE 'Event' END WHEN type = 'Damage' THEN CASE WHEN kind = 'human' THEN 'HumanDamage' WHEN kind IN ('property', 'economic') THEN 'PropertyDamage' WHEN kind IN ('service', 'infra') THEN 'ServiceDamage' ELSE 'Damage' END ELSE type END AS subtype, count(*) AS n FROM sd GROUP BY ALL",
        f"{BAGS_SQL}, {NOTED_SQL}",
    )
)
def subtype_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.subtype_view(noted(spark, sf_dir)).groupBy("doc_id", "subtype").agg(F.count("*").alias("n"))


@query(on_triples(f"SELECT doc_id, name, type, kind AS value, count(*) AS n FROM sd WHERE kind <> 'human' AND kind NOT IN ({QUOTED(ontology.DISASTER_TYPES)}) GROUP BY ALL", f"{BAGS_SQL}, {NOTED_SQL}"))
def disaster_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.disaster_types(noted(spark, sf_dir)).groupBy("doc_id", "name", "type", "value").agg(F.count("*").alias("n"))


@query(on_triples("SELECT doc_id, name, CASE WHEN type = 'Event' THEN 'Other' ELSE type END AS type, count(*) AS n FROM (SELECT doc_id, type, kind, CASE WHEN (2 * seq + side) % 29 = 0 THEN 'unknown' ELSE name END AS name FROM sd) WHERE type = 'Event' AND kind = 'nth' OR name = 'unknown' GROUP BY ALL", f"{BAGS_SQL}, {NOTED_SQL}"))
def other_without_note(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events pass for Other here, and every 29th node for an unknown one."""
    found = noted(spark, sf_dir)
    for p, side in (("s", 0), ("o", 1)):
        found = found.withColumn(f"{p}_type", F.when(F.col(f"{p}_type") == "Event", "Other").otherwise(F.col(f"{p}_type"))).withColumn(f"{p}_name", F.when((2 * F.col("seq") + side) % 29 == 0, "unknown").otherwise(F.col(f"{p}_name")))
    return checks.other_without_note(found).groupBy("doc_id", "name", "type").agg(F.count("*").alias("n"))


@query(on_triples("SELECT doc_id, src AS name, count(DISTINCT dst) AS damages FROM e WHERE code = 'CAUSES' AND ot = 'Damage' GROUP BY ALL"))
def amplifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Causes pass for amplifying exposures here."""
    edge = graph.edges(triples(spark, sf_dir))
    return predict.amplifiers(edge.withColumn("code", F.when(F.col("code") == "CAUSES", "AMPLIFIES").otherwise(F.col("code"))))


@query("SELECT user_id, event_id AS src, dst, 'PRECEDES' AS code, ts < gap AS strict FROM (SELECT user_id, event_id, ts, lead(event_id) OVER w AS dst, lead(ts) OVER w AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE dst IS NOT NULL")
def precedes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict.precedes(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), by="user_id", key="event_id")


@query("SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 0 THEN date_trunc('day', ts) WHEN 1 THEN date_trunc('month', ts) WHEN 2 THEN date_trunc('year', ts) END AS at FROM events")
def leading_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id") % 4
    text = F.when(k == 0, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("~end"))).when(k == 1, F.concat(F.date_format("ts", "yyyy-MM"), F.lit(" on"))).when(k == 2, F.date_format("ts", "yyyy")).otherwise("soon")
    return table(spark, sf_dir, "events").select("event_id", predict.leading_time(text).cast("timestamp_ntz").alias("at"))


@query(on_triples(f"SELECT DISTINCT x.doc_id, x.src AS a, x.dst AS b, y.dst AS c FROM cs x JOIN cs y ON x.doc_id = y.doc_id AND x.dst = y.src WHERE x.src <> x.dst AND y.src <> y.dst AND x.src <> y.dst", f"cs AS (SELECT DISTINCT doc_id, src, dst FROM e WHERE code IN ({CASCADE}))"))
def cascade_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict.cascade_chains(graph.edges(triples(spark, sf_dir)))


@query(on_triples("SELECT doc_id, dst AS event, count(DISTINCT src) AS factors FROM e WHERE code = 'INCREASES_RISK_OF' AND st = 'RiskFactor' AND ot = 'Event' GROUP BY ALL"))
def risk_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict.risk_factors(graph.edges(triples(spark, sf_dir)))


@query(on_triples("SELECT CASE code WHEN 'TRIGGERS' THEN 'PREVENTS' ELSE 'MITIGATES' END AS code, CASE WHEN seq % 2 = 0 THEN 'high' ELSE 'low' END AS effectiveness, count(*) AS n FROM t WHERE code IN ('TRIGGERS', 'CAUSES') GROUP BY ALL"))
def effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two causal codes pass for two of the response."""
    found = bagged(triples(spark, sf_dir))
    return predict.effectiveness(found.withColumn("code", F.when(F.col("code") == "TRIGGERS", "PREVENTS").when(F.col("code") == "CAUSES", "MITIGATES").otherwise(F.col("code"))))


# ---- iterative graph


def rank(k: int) -> str:
    """One synchronous round; unrolled, as a recursive term can't be summed and joined at once everywhere."""
    given = f"SELECT lk.doc_id, lk.dst AS name, sum(r.r / nn.o) AS got FROM lk JOIN r{k - 1} r ON r.doc_id = lk.doc_id AND r.name = lk.src JOIN nn ON nn.doc_id = lk.doc_id AND nn.name = lk.src GROUP BY ALL"
    lost = f"SELECT nn.doc_id, sum(r.r) FILTER (nn.o IS NULL) AS lost FROM nn JOIN r{k - 1} r USING (doc_id, name) GROUP BY nn.doc_id"
    return f"r{k} AS MATERIALIZED (SELECT nn.doc_id, nn.name, 0.15 / nn.c + 0.85 * (coalesce(g.got, 0) + coalesce(l.lost, 0) / nn.c) AS r FROM nn JOIN ({lost}) l ON l.doc_id = nn.doc_id LEFT JOIN ({given}) g ON g.doc_id = nn.doc_id AND g.name = nn.name)"


RANKS_SQL = ", ".join(
    [
        "lk AS (SELECT DISTINCT doc_id, src, dst FROM e)",
        "nn AS MATERIALIZED (SELECT n.doc_id, n.name, count(*) OVER (PARTITION BY n.doc_id) AS c, od.o FROM n LEFT JOIN (SELECT doc_id, src, count(*) AS o FROM lk GROUP BY ALL) od ON od.doc_id = n.doc_id AND od.src = n.name)",
        "r0 AS (SELECT doc_id, name, 1.0::DOUBLE / c AS r FROM nn)",
        *[rank(k) for k in range(1, iterative.ROUNDS + 1)],
    ]
)


@query(on_triples(f"SELECT doc_id, name, round(r, 6) AS pagerank FROM r{iterative.ROUNDS}", RANKS_SQL))
def pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.pagerank(edge, node).select("doc_id", "name", F.round("pagerank", 6).alias("pagerank"))


@query(ORACLE_SQL["pagerank"])
def pagerank_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.pagerank_rounds(edge, node).select("doc_id", "name", F.round("pagerank", 6).alias("pagerank"))


PATHS_SQL = f"""ca AS (SELECT DISTINCT doc_id, src, dst FROM e WHERE code IN ({CAUSAL}) AND src <> dst),
nx AS (SELECT doc_id, name, deg, {AXIS_SQL('type')} AS axis, EXISTS (FROM ca WHERE ca.doc_id = n.doc_id AND ca.src = n.name) AS leads FROM n),
pa(doc_id, last, path, score, axis, leads) AS (
  SELECT doc_id, name, [name], deg, axis, leads FROM nx WHERE leads AND NOT EXISTS (FROM ca WHERE ca.doc_id = nx.doc_id AND ca.dst = nx.name)
  UNION ALL SELECT pa.doc_id, ca.dst, list_append(path, ca.dst), score + nx.deg, nx.axis, nx.leads FROM pa JOIN ca ON ca.doc_id = pa.doc_id AND ca.src = pa.last JOIN nx ON nx.doc_id = pa.doc_id AND nx.name = ca.dst
  WHERE len(path) < 6 AND NOT list_contains(path, ca.dst) AND NOT (len(path) >= 3 AND pa.axis = 'Damage')),
fp AS (SELECT doc_id, path, len(path) AS size, score, array_to_string(path, ' > ') AS text FROM pa WHERE len(path) >= 3 AND (NOT leads OR axis = 'Damage')),
bp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size DESC, score DESC, text) AS place FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, path[1], path[-1], size ORDER BY score DESC, text) AS rn FROM fp) WHERE rn = 1) WHERE place <= 28)"""


@query(on_triples("SELECT doc_id, text, size::BIGINT AS size, score::BIGINT AS score FROM fp", PATHS_SQL, recursive=True))
def causal_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.all_causal_paths(edge, node).select("doc_id", F.array_join("path", " > ").alias("text"), F.size("path").cast("long").alias("size"), F.col("score").cast("long").alias("score"))


@query(on_triples("SELECT doc_id, place, text, size::BIGINT AS size, score::BIGINT AS score FROM bp", PATHS_SQL, recursive=True))
def major_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.best_paths(iterative.all_causal_paths(edge, node)).select("doc_id", "place", "text", "size", F.col("score").cast("long").alias("score"))


@query()
def major_paths_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iterative.paths_in_order(*graph_of(spark, sf_dir))


UNION_SQL = PATHS_SQL + ", up AS (SELECT doc_id, path[i] AS src, path[i + 1] AS dst FROM bp, LATERAL (SELECT unnest(range(1, size)) AS i))"


@query(on_triples("SELECT doc_id, src, dst, count(*) AS weight, (SELECT arg_min(code, seq) FROM e WHERE e.doc_id = up.doc_id AND e.src = up.src AND e.dst = up.dst) AS code FROM up GROUP BY doc_id, src, dst", UNION_SQL, recursive=True))
def path_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.connectivity(edge, node, paths_of(edge, node))[1]


LAYERS_SQL = UNION_SQL + """, ue AS (SELECT DISTINCT doc_id, src, dst FROM up), uu AS (SELECT doc_id, src AS name FROM ue UNION SELECT doc_id, dst FROM ue),
la(doc_id, name, layer) AS (SELECT doc_id, name, 0 FROM uu UNION SELECT la.doc_id, ue.dst, layer + 1 FROM la JOIN ue ON ue.doc_id = la.doc_id AND ue.src = la.name),
ll AS (SELECT doc_id, name, max(layer) AS layer FROM la GROUP BY ALL), pw AS (SELECT doc_id, name, count(*) AS weight FROM (SELECT doc_id, place, unnest(path) AS name FROM bp) GROUP BY ALL)"""


@query(on_triples("SELECT doc_id, name, ll.layer::BIGINT AS layer, weight, deg, row_number() OVER (PARTITION BY doc_id, layer ORDER BY deg DESC, name) - 1 AS slot, count(*) OVER (PARTITION BY doc_id, layer) AS in_layer FROM ll JOIN pw USING (doc_id, name) JOIN n USING (doc_id, name)", LAYERS_SQL, recursive=True))
def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    placed = iterative.connectivity(edge, node, paths_of(edge, node))[0]
    return placed.select("doc_id", "name", "layer", "weight", "deg", "slot", "in_layer")


@query(on_triples("SELECT w.doc_id, src, dst, weight, max_layer::BIGINT AS max_layer FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, src, dst) AS rn FROM (SELECT doc_id, src, dst, count(*) AS weight FROM up GROUP BY ALL)) w JOIN (SELECT doc_id, max(layer) AS max_layer FROM ll GROUP BY doc_id) m USING (doc_id) WHERE rn = 1", LAYERS_SQL, recursive=True))
def trunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    placed, links = iterative.connectivity(edge, node, paths_of(edge, node))
    return iterative.trunk(links, placed)


@query(on_triples(f"SELECT bp.doc_id, count(*) AS paths, count(*) FILTER (({AXIS_SQL('a.type')}) = 'Hazard' AND ({AXIS_SQL('b.type')}) = 'Damage') AS complete FROM bp JOIN n a ON a.doc_id = bp.doc_id AND a.name = path[1] JOIN n b ON b.doc_id = bp.doc_id AND b.name = path[-1] GROUP BY bp.doc_id", PATHS_SQL, recursive=True))
def complete_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.complete_paths(paths_of(edge, node), node)


def vote(k: int) -> str:
    return f"l{k} AS MATERIALIZED (SELECT doc_id, name, label FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, name ORDER BY c DESC, label) AS rn FROM (SELECT ln.doc_id, ln.name, l.label, count(*) AS c FROM ln JOIN l{k - 1} l ON l.doc_id = ln.doc_id AND l.name = ln.other GROUP BY ALL)) WHERE rn = 1)"


LABELS_SQL = ", ".join(["ln AS (SELECT doc_id, src AS name, dst AS other FROM e WHERE src <> dst UNION SELECT doc_id, dst, src FROM e WHERE src <> dst UNION SELECT doc_id, name, name FROM n)", "l0 AS (SELECT doc_id, name, name AS label FROM n)", *[vote(k) for k in range(1, iterative.LPA_ROUNDS + 1)]])
SETTLED = f"l{iterative.LPA_ROUNDS}"


@query(on_triples(f"SELECT doc_id, name, label FROM {SETTLED}", LABELS_SQL))
def communities_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iterative.communities_in_step(*graph_of(spark, sf_dir))


@query(on_triples(f"SELECT doc_id, count(*) AS communities, max(c) AS largest, count(*) FILTER (c = 1) AS singletons, round(count(*) FILTER (c = 1) / count(*), 6) AS singleton_share FROM (SELECT doc_id, label, count(*) AS c FROM {SETTLED} GROUP BY ALL) GROUP BY doc_id", LABELS_SQL))
def fragmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = iterative.communities_in_step(*graph_of(spark, sf_dir))
    return graph.fragmentation(labels, "label").withColumn("singleton_share", F.round("singleton_share", 6))


@query(
    on_triples(
        f"SELECT a.doc_id, nodes, types, edges, predicates, communities, coalesce(major_paths, 0) AS major_paths FROM (SELECT doc_id, count(*) AS nodes, count(DISTINCT type) AS types FROM n GROUP BY doc_id) a JOIN (SELECT doc_id, count(*) AS edges, count(DISTINCT code) AS predicates FROM e GROUP BY doc_id) b USING (doc_id) JOIN (SELECT doc_id, count(DISTINCT label) AS communities FROM {SETTLED} GROUP BY doc_id) c USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS major_paths FROM bp GROUP BY doc_id) p USING (doc_id)",
        f"{LABELS_SQL}, {PATHS_SQL}",
        recursive=True,
    )
)
def summary_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.summary(edge, node, iterative.communities_in_step(edge, node), "label", paths_of(edge, node))


@query()
def communities_async(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iterative.communities_in_order(*graph_of(spark, sf_dir))


@query()
def community_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.community_table(iterative.communities_in_order(edge, node), node, "community")


@query(on_triples(f"SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY deg DESC, round(r, 9) DESC, name) AS place, name, type, deg, round(r, 6) AS pagerank FROM n JOIN r{iterative.ROUNDS} USING (doc_id, name) QUALIFY place <= 30", RANKS_SQL))
def centrality_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge, node = graph_of(spark, sf_dir)
    return iterative.central(node, iterative.pagerank(edge, node)).withColumn("pagerank", F.round("pagerank", 6))


def nearest(k: int) -> str:
    return f"w{k} AS MATERIALIZED (SELECT doc_id, name, min(least(w.label, coalesce(o.label, w.label))) AS label FROM w{k - 1} w LEFT JOIN (SELECT li.doc_id, li.name, min(label) AS label FROM li JOIN w{k - 1} x ON x.doc_id = li.doc_id AND x.name = li.other GROUP BY ALL) o USING (doc_id, name) GROUP BY ALL)"


#: Labels reach as far as there are rounds; no two nodes of a component are so many edges apart here.
REACHED = 16


@query(
    on_triples(
        f"SELECT doc_id, name, label AS component FROM w{REACHED}",
        ", ".join(["li AS (SELECT doc_id, src AS name, dst AS other FROM e UNION SELECT doc_id, dst, src FROM e)", "w0 AS (SELECT doc_id, name, name AS label FROM n)", *[nearest(k) for k in range(1, REACHED + 1)]]),
    )
)
def weak_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    edge = graph.edges(triples(spark, sf_dir))
    return graph.components(edge.select("doc_id", F.col("src").alias("a"), F.col("dst").alias("b")), by="doc_id").withColumnRenamed("node", "name")


# ---- sinks

LIT = lambda c: f"'''' || trim(replace(replace(replace({c}, '\\', '\\\\'), '''', '\\'''), chr(10), ' ')) || ''''"
LABEL = f"CASE WHEN ({AXIS_SQL('type')}) = type THEN type ELSE ({AXIS_SQL('type')}) || ':' || type END"


@query(on_triples(f"SELECT name, type, 'MERGE (n:' || {LABEL} || ' {{name: ' || {LIT('name')} || '}}) SET n += {{kind: ' || {LIT('left(name, 3)')} || ', p_1st: ' || {LIT('type')} || '}}, n.sourceDocs = CASE WHEN ''d''  IN x' AS line FROM (SELECT DISTINCT name, type FROM ends)".replace("''d''  IN x", "''d'' IN coalesce(n.sourceDocs, []) THEN n.sourceDocs ELSE coalesce(n.sourceDocs, []) + ''d'' END;")))
def node_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = graph.ends(graph.edges(triples(spark, sf_dir))).select("name", "type").distinct()
    bag = F.create_map(F.lit("kind"), F.substring("name", 1, 3), F.lit("1st"), F.col("type"), F.lit("empty"), F.lit(""))
    return node.select("name", "type", sinks.node_statement(F.col("name"), F.col("type"), bag, F.lit("d")).alias("line"))


@query(on_triples(f"SELECT id, doc_id, 'MATCH (a:' || s_type || ' {{name: ' || {LIT('s_name')} || '}}), (b:' || o_type || ' {{name: ' || {LIT('o_name')} || '}}) MERGE (a)-[r:' || code || ']->(b) SET r += {{tripleId: ' || {LIT('id')} || '}};' AS line FROM t"))
def edge_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = sinks.edge_statement(F.col("s_type"), F.col("s_name"), F.col("code"), F.col("o_type"), F.col("o_name"), F.create_map(F.lit("tripleId"), F.col("id")))
    return triples(spark, sf_dir).select("id", "doc_id", line.alias("line"))


NODE_LINES = f"""nd AS (SELECT doc_id, name, type, min(2 * seq + side) AS ord FROM sides GROUP BY ALL),
nl AS (SELECT doc_id, 1 AS part, ord, 'MERGE (n:' || {LABEL} || ' {{name: ' || {LIT('name')} || '}}) SET n += {{deaths: ''' || length(name) || ''', kind: ' || {LIT('left(name, 3)')} || CASE WHEN type = 'Event' THEN ', order: ''' || CASE WHEN length(name) > 8 THEN 'primary' ELSE 'late' END || '''' ELSE '' END || ', name: ' || {LIT('name')} || ', ekType: ''' || type || '''}}, n.sourceDocs = CASE WHEN ''' || doc_id || ''' IN coalesce(n.sourceDocs, []) THEN n.sourceDocs ELSE coalesce(n.sourceDocs, []) + ''' || doc_id || ''' END;' AS line FROM nd),
el AS (SELECT doc_id, 2 AS part, seq AS ord, 'MATCH (a:' || s_type || ' {{name: ' || {LIT('s_name')} || '}}), (b:' || o_type || ' {{name: ' || {LIT('o_name')} || '}}) MERGE (a)-[r:' || code || ']->(b) SET r += {{effectiveness: ''' || CASE WHEN seq % 2 = 0 THEN 'high' ELSE 'low' END || ''', time: ''t' || seq % 7 || ''', evidence: ' || {LIT("s_name || ' ' || code || ' ' || o_name")} || ', sourceDoc: ''' || doc_id || ''', tripleId: ' || {LIT('id')} || '}};' AS line FROM t),
hl AS (SELECT doc_id, 0 AS part, 0 AS ord, '// Property graph of ' || doc_id AS line FROM t GROUP BY doc_id UNION ALL SELECT doc_id, 0, 1, '// nodes=' || n || ' relationships=' || m FROM (SELECT doc_id, count(*) AS n FROM nd GROUP BY doc_id) JOIN (SELECT doc_id, count(*) AS m FROM t GROUP BY doc_id) USING (doc_id))""".replace("{{", "{").replace("}}", "}")


@query(on_triples("SELECT doc_id, part::INT AS part, ord::BIGINT AS ord, line FROM (SELECT * FROM hl UNION ALL SELECT * FROM nl UNION ALL SELECT * FROM el)", f"{BAGS_SQL}, {NODE_LINES}"))
def graph_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statement file of each document; relations already have a property that the file adds."""
    every, out = bagged(triples(spark, sf_dir)), None
    every = every.withColumn("p_props", P.overlay(F.create_map(F.lit("effectiveness"), F.element_at("p_props", "effectiveness"), F.lit("time"), F.element_at("p_props", "time")), F.create_map(F.lit("evidence"), F.lit("to be replaced"))))
    for doc in ("geo", "trade", "behaviour"):
        own = every.filter(F.col("doc_id") == doc)
        first = merge.sides(own).groupBy("name", "type").agg(F.min(2 * F.col("seq") + F.col("side")).alias("seq"))
        nodes = stored(graph.merged_nodes(own).join(first, ["name", "type"]))  # counted, and written
        lines = sinks.graph_statements(nodes, own, doc).withColumn("doc_id", F.lit(doc))
        out = lines if out is None else out.unionByName(lines)
    return out.select("doc_id", "part", "ord", "line")


@query(on_triples("SELECT s_type, s_name, code, o_type, o_name, count(*) AS n FROM t GROUP BY ALL"))
def statement_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.parse_statements(edge_statements(spark, sf_dir), "line").groupBy("s_type", "s_name", "code", "o_type", "o_name").agg(F.count("*").alias("n"))


@query()
def dashboard_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.whole(dashboard.views(triples(spark, sf_dir)), "Triples & graph", "index.html")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distribution of relations by document, with cascade counts and a total."""
    return predicate_distribution(spark, sf_dir)
