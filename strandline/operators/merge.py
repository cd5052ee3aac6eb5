"""Union, dedup, canonical keys, validation, ids and counts of triples.

Mentions have doc_id, ord (any sortable expression's value: the order in the document), s_name, s_type, code, o_name,
o_type and, where there are any, s_props, p_props, o_props, evidence, chunk_id.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from .. import ontology
from ..functions.text import norm
from ..functions.triples import BAG, rename_keys, triple_id
from .durable import stored

OPTIONAL = {"s_props": BAG, "p_props": BAG, "o_props": BAG, "evidence": "string", "chunk_id": "string"}


def dedup_first(mentions: DataFrame) -> DataFrame:
    """The first mention of each (document, subject, code, object), names compared by norm(), types ignored.

    One aggregation with min() of an ordered struct: copies combine before the shuffle."""
    payload = [c for c in mentions.columns if c not in ("doc_id", "ord")]
    orderable = [c for c in payload if not mentions.schema[c].dataType.simpleString().startswith("map")]
    if len(orderable) == len(payload):
        mentions = _combined(mentions, payload)
    keyed = mentions.withColumn("__s", norm(F.col("s_name"))).withColumn("__o", norm(F.col("o_name")))
    keys = ["doc_id", "__s", "code", "__o"]
    if len(orderable) == len(payload):
        first = keyed.groupBy(*keys).agg(F.min(F.struct("ord", *payload)).alias("f"))
    else:
        first = keyed.groupBy(*keys).agg(F.min_by(F.struct("ord", *payload), F.struct("ord", *orderable)).alias("f"))
    return first.select("doc_id", "f.ord", *[f"f.{c}" for c in payload])


def _combined(mentions: DataFrame, payload: list[str]) -> DataFrame:
    """The first of mentions that differ in ord only, where ord is a struct that ends in two whole numbers a and b.

    min() of a struct sorts all rows of a task; min() of a number combines them in a hash table. So the two become one,
    10^19 a + b; its other fields, and numbers below zero and nulls, are keys of the groups instead."""
    of = mentions.schema["ord"].dataType
    whole = [isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType)) for f in getattr(of, "fields", [])]
    if whole[-2:] != [True, True]:
        return mentions
    names = of.names
    *leading, a, b = [F.col("ord")[n] for n in names]
    fits, number, most = (a >= 0) & (b >= 0), "decimal(38,0)", F.lit(Decimal(10**19))
    fits = F.coalesce(fits, F.lit(False))
    odd = F.when(~fits, F.struct(a.alias("a"), b.alias("b")))
    heads = [c.alias(f"__{k}") for k, c in enumerate(leading)]
    packed = F.when(fits, (a.cast("decimal(19,0)") * most + b).cast(number))
    groups = mentions.select("doc_id", *payload, *heads, odd.alias("__odd"), packed.alias("__at")).groupBy("doc_id", *payload, *[f"__{k}" for k in range(len(leading))], "__odd").agg(F.min("__at").alias("__at"))
    back = [F.col(f"__{k}") for k in range(len(leading))] + [F.coalesce("__odd.a", F.expr("__at div 10000000000000000000BD")), F.coalesce("__odd.b", F.expr("cast(__at % 10000000000000000000BD as bigint)"))]
    return groups.select("doc_id", F.struct(*[c.cast(f.dataType).alias(n) for c, n, f in zip(back, names, of.fields, strict=True)]).alias("ord"), *payload)


def with_ids(triples: DataFrame) -> DataFrame:
    """seq (1-based in the document, equal places by name) and id.

    Triples are dealt by ranges of their order and stored with their places in the range; the triples of earlier ranges
    come on top, so that no task has more of a document than its range."""
    order = ["doc_id", "ord", "s_name", "code", "o_name"]
    placed = stored(triples.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    placed = placed.withColumn("__range", F.shiftright("__at", 33))
    earlier = Window.partitionBy("of").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = placed.groupBy(F.col("doc_id").alias("of"), F.col("__range").alias("range")).agg(F.min("__at").alias("first"), F.count("*").alias("n"))
    ranges = ranges.select("of", "range", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + 1 - F.col("first")).alias("plus"))
    numbered = placed.join(ranges, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("__range") == F.col("range")))
    return numbered.select(*triples.columns, (F.col("__at") + F.col("plus")).alias("seq")).withColumn("id", triple_id(F.col("seq")))


def canonical_keys(triples: DataFrame, node_aliases: dict[str, str], relation_aliases: dict[str, str]) -> DataFrame:
    """Property keys renamed by alias; scopes apart (pass the flat map twice for the merged behaviour)."""
    as_map = lambda of: F.create_map(*[F.lit(x) for p in of.items() for x in p]) if of else F.create_map().cast(BAG)
    out = triples
    for column, of in (("s_props", node_aliases), ("o_props", node_aliases), ("p_props", relation_aliases)):
        out = out.withColumn(column, rename_keys(F.col(column), as_map(of)))
    return out


def sides(triples: DataFrame, props: bool = False) -> DataFrame:
    """Subjects and objects as rows: doc_id, ord2 (subject first), name, type (and props)."""
    side = lambda p, k: F.struct(F.lit(k).alias("side"), F.col(f"{p}_name").alias("name"), F.col(f"{p}_type").alias("type"), *([F.col(f"{p}_props").alias("props")] if props else []))
    cols = [c for c in ("doc_id", "doc_seq", "ord", "seq") if c in triples.columns]
    return triples.select(*cols, F.inline(F.array(side("s", 0), side("o", 1))))


def entity_mentions(triples: DataFrame) -> DataFrame:
    return sides(triples).groupBy("doc_id", "type").agg(F.count("*").alias("mentions"))


def predicate_distribution(triples: DataFrame) -> DataFrame:
    """Rows for codes, documents and in total from one aggregation; level tells them apart (0: code, 1: document, 3: all),
    as a document or code may be null itself."""
    counts = [F.grouping_id().cast("long").alias("level"), F.count("*").alias("triples"), F.count_if(F.col("code").isin(ontology.CASCADE)).alias("cascade")]
    return triples.rollup("doc_id", "code").agg(*counts)


def type_order(triples: DataFrame) -> DataFrame:
    """entity_mentions() with place: by mentions, then by first mention."""
    counted = sides(triples).groupBy("doc_id", "type").agg(F.count("*").alias("mentions"), F.min(F.struct("seq", "side")).alias("first"))
    return _placed(counted)


def code_order(triples: DataFrame) -> DataFrame:
    """Codes of each document with place: by triples, then by first triple."""
    return _placed(triples.groupBy("doc_id", "code").agg(F.count("*").alias("mentions"), F.min("seq").alias("first")))


def _placed(counted: DataFrame) -> DataFrame:
    order = Window.partitionBy("doc_id").orderBy(F.desc("mentions"), "first")
    return counted.withColumn("place", F.row_number().over(order).cast("long")).drop("first")


def emergent_nodes(triples: DataFrame) -> DataFrame:
    """doc_id, owner (type), key, cnt; a type without keys has one row with a null key."""
    keys = sides(triples, props=True).select("doc_id", F.col("type").alias("owner"), F.explode_outer(F.map_keys("props")).alias("key"))
    return _counted(keys)


def emergent_relations(triples: DataFrame) -> DataFrame:
    return _counted(triples.select("doc_id", F.col("code").alias("owner"), F.explode_outer(F.map_keys("p_props")).alias("key")))


def _counted(keys: DataFrame) -> DataFrame:
    counted = keys.groupBy("doc_id", "owner", "key").agg(F.count("key").alias("cnt"))
    some = F.max(F.col("key").isNotNull()).over(Window.partitionBy("doc_id", "owner"))
    return counted.withColumn("__some", some).filter("key is not null or not __some").drop("__some")


def ordered_schema(counted: DataFrame) -> DataFrame:
    """owner_total, owner_place and key_place: owners by total, keys by count, both descending, equal ones by name."""
    total = F.sum("cnt").over(Window.partitionBy("doc_id", "owner"))
    sized = counted.withColumn("owner_total", total)
    placed = sized.withColumn("key_place", F.row_number().over(Window.partitionBy("doc_id", "owner").orderBy(F.desc("cnt"), "key")).cast("long"))
    return placed.withColumn("owner_place", F.dense_rank().over(Window.partitionBy("doc_id").orderBy(F.desc("owner_total"), "owner")).cast("long"))


def invalid_types(triples: DataFrame, known: list[str] | None = None) -> DataFrame:
    """Mentions of a type that is not in the vocabulary (null included); reported, never dropped."""
    return sides(triples).filter(~F.coalesce(F.col("type").isin(known or ontology.ENTITY_TYPES), F.lit(False)))


def invalid_codes(triples: DataFrame, known: list[str] | None = None) -> DataFrame:
    return triples.filter(~F.coalesce(F.col("code").isin(known or [*ontology.RELATIONS, *ontology.INFERRED_RELATIONS]), F.lit(False)))


def warnings(triples: DataFrame) -> DataFrame:
    """doc_id, ord, kind, value."""
    types = invalid_types(triples).select("doc_id", "ord", F.lit("type").alias("kind"), F.col("type").alias("value"))
    return types.unionByName(invalid_codes(triples).select("doc_id", "ord", F.lit("code").alias("kind"), F.col("code").alias("value")))


def first_warnings(triples: DataFrame, most: int = 40, types: list[str] | None = None, codes: list[str] | None = None) -> DataFrame:
    """The report: total of warnings and, in order of the triples, the first `most` of each document (types before codes)."""
    rows = invalid_types(triples, types).select("doc_id", "seq", "side", F.lit("type").alias("kind"), F.col("type").alias("value"))
    rows = rows.unionByName(invalid_codes(triples, codes).select("doc_id", "seq", F.lit(2).alias("side"), F.lit("code").alias("kind"), F.col("code").alias("value")))
    of_document = Window.partitionBy("doc_id")
    placed = rows.withColumn("total", F.count("*").over(of_document)).withColumn("place", F.row_number().over(of_document.orderBy("seq", "side")).cast("long"))
    return placed.filter(F.col("place") <= most).select("doc_id", "place", "total", "seq", "kind", "value")


def document_metadata(triples: DataFrame, label: str, version: str) -> DataFrame:
    """Per document: counts and both distributions as maps; always derived from the triples as they are; a null type or code is ''."""
    types = entity_mentions(triples).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("type", F.lit("")), "mentions")))).alias("entity_mention_distribution"))
    codes = triples.groupBy("doc_id", "code").agg(F.count("*").alias("n"))
    codes = codes.groupBy("doc_id").agg(F.sum("n").alias("triple_count"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.coalesce("code", F.lit("")), "n")))).alias("predicate_distribution"))
    return codes.join(types, "doc_id").withColumns({"source_document": F.coalesce("doc_id", F.lit(label)), "ontology_version": F.lit(version)})
