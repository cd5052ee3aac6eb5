"""A corpus pipeline: language ID, near-duplicate removal, suffix-array dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents.
Repeated rows (of one id) stay or go together; null texts have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import decontaminate, language_id, mixing, ngram_join, suffix_dedup
from strandline.llm.base import apart, restored, stored, table

#: Near-duplicates: words of a shingle, and least similarity in percent.
SHINGLE, SIMILAR = 5, 80
REPEAT_BYTES, WINDOW_WORDS = 200, 10

#: SQL has no suffix arrays or language profiles; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; profiles come from the labelled rows, predictions from texts alone."""
    profiles = language_id.learn(docs, "lang", "text", F.xxhash64(F.lit("language"), "doc_id"))
    own, names = apart(docs)
    found = language_id.identify(own, names["text"], profiles)
    return restored(found.filter(F.col("lang_pred") != language_id.UNKNOWN), names, [])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; rows without an id stay."""
    groups = ngram_join.ngram_join(docs.select("doc_id", "text"), "doc_id", "text", n=SHINGLE, percent=SIMILAR)
    gone = groups.filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that repeat; a document of which nothing is left goes."""
    own, names = apart(docs)
    text, changed = names["text"], F.col("n_removed") > 0
    cut = suffix_dedup.remove_repeats(own, names["doc_id"], text, width=REPEAT_BYTES, with_text=True)
    left = cut.filter(~changed | (F.length(F.trim("kept")) > 0))
    if "n_chars" in names:
        left = left.withColumn(names["n_chars"], F.when(changed, F.length("kept")).otherwise(F.col(names["n_chars"])).cast(docs.schema["n_chars"].dataType))
    return restored(left.withColumn(text, F.when(changed, F.col("kept")).otherwise(F.col(text))), names, [])


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    own, names = apart(docs)
    found = decontaminate.matches(own, names["text"], table(spark, sf_dir, "benchmark"), "item_id", "text", size=WINDOW_WORDS, counted=False)
    return restored(found.filter(F.size("hits") == 0), names, [])


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with size, source_size, target and taken."""
    return mixing.mix_sources(docs, "doc_id", "source", "text", with_row=True).filter("taken > 0")


STAGES = [
    ("language ID", identified),
    ("n-gram Jaccard join", without_near_duplicates),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", decontaminated),
    ("mixing sources", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
