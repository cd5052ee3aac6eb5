"""One query for each operator, with its parameters in production, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embedding_join, language_id, mixing, ngram_join, quotations, suffix_dedup, token_counts, warc, wrappers
from .base import table


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), "doc_id", "source", "text").select("doc_id", "size", "source_size", "target", "taken")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return ngram_join.ngram_join(docs, "doc_id", "text", n=3, percent=90).select("doc_id", "n_shingles", "component_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", width=200)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.matches(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text", size=10)
    return decontaminate.digest(found.drop("text"), "doc_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = table(spark, sf_dir, "pages"), warc.archive_folder(spark)
    warc.write_archives(pages, folder, "page_id", "url", "html", least=0)
    kind = pages.schema["page_id"].dataType.simpleString()
    return warc.read_archives(spark, folder).select(F.col("record_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


def held_out() -> F.Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    seed = F.xxhash64(F.lit("language"), "doc_id")
    profiles = language_id.learn(docs.filter(~F.coalesce(held_out(), F.lit(False))).select("doc_id", "lang", "text"), "lang", "text", seed)
    found = language_id.identify(docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "text"), "text", profiles)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", vocabulary(), limit=512)


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table holds no quotation, so its messages are first written as mail that quotes the two before; the operator
    takes that apart: texts come back without quotes, and replies from the quotes alone."""
    return quotations.reply_ordered(quotations.as_replies(table(spark, sf_dir, "conversations"))).withColumn("reply_to", F.col("reply_to").cast("string"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", cosine=0.9)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"), "page_id", "url", "html")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_ngram_join,
        op3_suffix_dedup,
        op4_decontaminate,
        op5_warc,
        op6_language_id,
        op7_token_counts,
        op8_quotation_linking,
        op9_embedding_near_dedup,
        op10_html_extraction,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: op3 has none: by 200-byte windows it takes minutes on the smallest tables. Its tests are brute force.
#: Components of links l(a, b) over the ids of a table, by reachability.
_REACH = "u AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a), c AS (SELECT a, min(b) AS m FROM r GROUP BY a)"

ORACLE_SQL: dict[str, str] = {
    "op1_mixing": """
        WITH d AS (SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
        s AS (SELECT *, [5.0::DOUBLE, 2, 1][(rank - 1) % 3 + 1] AS w FROM (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM d GROUP BY source)),
        o AS (SELECT *, row_number() OVER (ORDER BY n / w, rank) AS k FROM s),
        v AS (SELECT *, 3.0::DOUBLE * n AS lim, (sum(n) OVER () - coalesce(sum(3 * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE / sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM o),
        t AS (SELECT source, n, rank, coalesce(least(lim, w * (SELECT arg_min(lev, k) FROM v WHERE lev <= lim / w)), 0) AS target FROM v),
        -- seats of one word, one by one: to sources by the highest quotients of target / (2 k - 1), then to each source's shards by their sizes
        q AS (SELECT *, round(sum(target) OVER ())::BIGINT AS seats FROM t),
        b AS (SELECT source, count(*) FILTER (place <= seats) AS blocks FROM (SELECT source, seats, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, source NULLS LAST) AS place FROM q, LATERAL (SELECT unnest(range(1, seats + 1)) AS k) WHERE target > 0 AND k <= target + 20) GROUP BY source),
        p AS (SELECT d.*, t.n AS source_size, t.target, ('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, md5(text), 'null')), 1, 8))::BIGINT % greatest(ceil(t.n / 262144)::BIGINT, 1) AS shard,
              ('0x' || substr(md5('2:' || coalesce(doc_id::VARCHAR, md5(text), 'null')), 1, 8))::BIGINT AS place FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        z AS (SELECT x.*, coalesce(blocks, 0) AS blocks, sum(z) OVER (PARTITION BY x.source) AS every FROM (SELECT source, shard, sum(size)::BIGINT AS z FROM p GROUP BY ALL) x LEFT JOIN b ON x.source IS NOT DISTINCT FROM b.source),
        h AS (SELECT source, shard, z, least(count(*) FILTER (place <= blocks), 3 * z) AS quota FROM (SELECT z.*, k, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN k IS NULL THEN -1 ELSE z / (2 * k - 1) END DESC, shard) AS place
              FROM z LEFT JOIN LATERAL (SELECT unnest(range(1, blocks + 1)) AS k) ON z > 0 AND k <= blocks * (z / every) + 20) WHERE k IS NOT NULL OR z = 0 GROUP BY source, shard, z),
        g AS (SELECT *, CASE WHEN z > 0 THEN quota // z ELSE 0 END AS rounds, CASE WHEN z > 0 THEN quota % z ELSE 0 END AS arc, CASE WHEN z > 0 THEN ('0x' || substr(md5('3:' || coalesce(source, 'null') || ':' || shard), 1, 8))::BIGINT % z ELSE 0 END AS f FROM h),
        y AS (SELECT p.*, z, rounds, arc, f, sum(size) OVER (PARTITION BY p.source, p.shard ORDER BY place, doc_id NULLS LAST, size) AS e FROM p JOIN g ON p.source IS NOT DISTINCT FROM g.source AND p.shard = g.shard)
        SELECT doc_id, size, source_size, target, (rounds * size + greatest(least(e, f + arc, z) - greatest(e - size, f), 0) + greatest(least(e, greatest(f + arc - z, 0)) - (e - size), 0))::BIGINT AS taken FROM y""",
    "op2_ngram_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)), {_REACH}
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = w.doc_id""",
    "op4_decontaminate": f"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
        k AS (SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i : i + least(len(w), 10) - 1], ' '))) AS t FROM b WHERE len(w) > 0),
        p AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS t FROM d, (SELECT DISTINCT n FROM k) x, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i)),
        h AS (SELECT doc_id, item_id, i, p.n FROM p JOIN k ON p.n = k.n AND p.t = k.t),
        s AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM h) GROUP BY doc_id),
        g AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY doc_id)
        SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN s USING (doc_id) LEFT JOIN g USING (doc_id)""",
    "op9_embedding_near_dedup": f"""
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
        l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id WHERE list_cosine_similarity(x.e, y.e) >= 0.9), {_REACH},
        n AS (SELECT a, count(*) AS n FROM u GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, least(vec_id, coalesce(m, vec_id)) = vec_id AS kept FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    # turns of a conversation are unique here, and no text has quote marks of its own
    "op8_quotation_linking": """
        WITH m AS (SELECT *, regexp_replace(coalesce(text, ''), '^\\s+|\\s+$', '', 'g') AS own, CASE WHEN coalesce(text, '') = '' THEN 0 ELSE len(regexp_split_to_array(text, '\r\n|\r|\n')) END AS lines FROM conversations),
        q AS (SELECT a.conv_id, a.turn, a.role, a.own, CASE WHEN coalesce(b.lines, 0) > 0 THEN b.lines + coalesce(c.lines, 0) ELSE 0 END AS n_quoted, CASE WHEN b.own <> '' THEN b.turn END AS reply_to
              FROM m a LEFT JOIN m b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 LEFT JOIN m c ON c.conv_id = a.conv_id AND c.turn = a.turn - 2),
        t AS (SELECT *, max(CASE WHEN reply_to IS NULL THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS thread_turn FROM q)
        SELECT conv_id, turn, role, own AS text, n_quoted::BIGINT AS n_quoted, reply_to::VARCHAR AS reply_to, thread_turn, turn - thread_turn AS depth,
               array_to_string(list_transform(range(thread_turn, turn + 1), lambda i: lpad(i::VARCHAR, 10, '0')), '/') AS reply_path FROM t""",
    "op5_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, h, unhex(sha1(h))::BIT::VARCHAR AS bits FROM p),
        f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
        SELECT d.page_id, octet_length(encode(d.h)) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + list_sum(list_transform(range(5), lambda j: CASE substr(bits, 5 * i + j + 1, 1) WHEN '1' THEN 1 << (4 - j) ELSE 0 END))::BIGINT, 1)), '') AS payload_digest,
               CASE WHEN d.page_id = f.first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN d.page_id <> f.first THEN f.first END AS refers_to
        FROM d JOIN f USING (h)""",
}
