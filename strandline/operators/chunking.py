"""Overlapping line chunks, sized by density. All in expressions; a document never leaves its row."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..ontology import DENSITY_LINES, DENSITY_NAMES, lookup
from ..sources.documents import lines_of

OVERLAP, MOST_CHUNKS = 40, 40


def target_lines(density: Column, given: Column | None = None) -> Column:
    """Lines of a chunk: as given (0 counts as not given), else by density (low where unknown)."""
    name = lookup(DENSITY_NAMES, density, "low")
    by_name = F.element_at(F.create_map(*[F.lit(x) for p in DENSITY_LINES.items() for x in p]), name)
    return by_name if given is None else F.coalesce(F.nullif(given, F.lit(0)), by_name)


def chunk_count(n: Column, target: Column, most: int = MOST_CHUNKS) -> Column:
    return F.greatest(F.lit(1), F.least(F.lit(most), F.ceil(n / target).cast("int")))


def plan(docs: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text", overlap: int = OVERLAP, most: int = MOST_CHUNKS) -> DataFrame:
    """id, chunk_no, start and end line (end excluded). Overlap reaches back only; later chunks may be empty."""
    sized = docs.withColumn("__ended", F.coalesce(F.col(text_col), F.lit("")).rlike(r"[\r\n]\z")).withColumn("__lines", lines_of(F.col(text_col))).withColumn("__n", F.size("__lines")).withColumn("__chunks", chunk_count(F.col("__n"), target, most))
    sized = sized.withColumn("__size", F.floor(F.col("__n") / F.col("__chunks")).cast("int") + 1)
    rows = sized.select(id_col, "__lines", "__ended", "__n", "__size", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)).alias("chunk_no"))
    start, end = F.greatest(F.lit(0), F.col("chunk_no") * F.col("__size") - overlap), F.least(F.col("__n"), (F.col("chunk_no") + 1) * F.col("__size"))
    return rows.select(id_col, "chunk_no", start.alias("start"), end.alias("end"), "__lines", "__ended", "__n")


def chunks(docs: DataFrame, target: Column, id_col: str = "doc_id", text_col: str = "text", overlap: int = OVERLAP, most: int = MOST_CHUNKS) -> DataFrame:
    """plan() with the chunk's text, each line with its end (as "\\n"), and the name of its file."""
    planned = plan(docs, target, id_col, text_col, overlap, most)
    held = F.greatest(F.col("end") - F.col("start"), F.lit(0))
    end = F.when((held > 0) & ((F.col("end") < F.col("__n")) | F.col("__ended")), "\n").otherwise("")
    text = F.concat(F.array_join(F.slice(F.col("__lines"), F.col("start") + 1, held), "\n"), end)
    return planned.select(id_col, "chunk_no", "start", "end", text.alias("text"), F.format_string("chunk_%02d.txt", "chunk_no").alias("file"))


def extract_triples(chunked: DataFrame, extractor: Callable[[str], list[dict]], id_col: str = "doc_id") -> DataFrame:
    """Runs a pluggable extractor over each chunk; its triples as JSON text for sources.extractions."""
    import json

    kind = chunked.schema[id_col].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({id_col: frame[id_col], "chunk_no": frame["chunk_no"], "json": [json.dumps({"triples": extractor(t)}, ensure_ascii=False) for t in frame["text"]]})

    return chunked.select(id_col, "chunk_no", "text").mapInPandas(run, f"{id_col} {kind}, chunk_no int, json string")
