"""Documents: PDF, DOCX and plain text files as (path, ext, text), and their lines."""

from __future__ import annotations

import io
import shutil
import subprocess
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_markup

FORMATS = {".pdf", ".docx", ".txt", ".md"}


def extension(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.[^./]+$", 0))


def supported(path: Column) -> Column:
    """The extension; any other than those known is an error."""
    ext = extension(path)
    return F.when(ext.isin(*FORMATS), ext).otherwise(F.raise_error(F.concat(F.lit("unsupported format: "), path)))


def pdf_text(content: bytes) -> str:
    """By pdftotext where the machine has it, else by pypdf."""
    if shutil.which("pdftotext"):
        return subprocess.run(["pdftotext", "-", "-"], input=content, capture_output=True, check=True).stdout.decode("utf-8", "replace")  # noqa: S603, S607
    try:
        from pypdf import PdfReader
    except ImportError:
        from PyPDF2 import PdfReader
    return "".join((page.extract_text() or "") + "\n" for page in PdfReader(io.BytesIO(content)).pages)


def docx_xml(content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        return z.read("word/document.xml").decode("utf-8", "replace")


def _texts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        of = {".pdf": pdf_text, ".docx": docx_xml}
        frame["raw"] = [of.get(e, lambda c: bytes(c).decode("utf-8", "replace"))(c) for e, c in zip(frame["ext"], frame["content"], strict=True)]
        yield frame[["path", "ext", "raw"]]


def read_documents(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """path, ext, text of each file. A PDF needs pdftotext or the optional pypdf."""
    reader = spark.read.format("binaryFile")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", supported(F.col("path")).alias("ext"), "content")
    raw = files.mapInPandas(_texts, "path string, ext string, raw string")
    return raw.select("path", "ext", F.when(F.col("ext") == ".docx", strip_markup(F.col("raw"))).otherwise(F.col("raw")).alias("text"))


LINE_END = r"\r\n|\r|\n"


def lines_of(text: Column) -> Column:
    """Lines with universal ends; a final end makes no further line."""
    parts = F.split(F.coalesce(text, F.lit("")), LINE_END)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def line_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(id_col, F.posexplode(lines_of(F.col(text_col))).alias("line_no", "line"))


def size_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(id_col, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.size(lines_of(F.col(text_col))).cast("long").alias("n_lines"))


def chunk_id(file_name: Column) -> Column:
    """The digits of a file's base name, or else the name."""
    base = F.regexp_extract(file_name, r"([^/]*)$", 1)
    return F.coalesce(F.nullif(F.regexp_replace(base, r"\D", ""), F.lit("")), base)
