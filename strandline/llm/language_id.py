"""Language identification by rank-order profiles.

Of each learned language, a profile lists its most frequent character n-grams (lengths 1 to 3, words padded with
a blank) from the most to the least frequent. A text's own profile is made the same way over the whole text, and
its distance to a language is the sum of the out-of-place differences of ranks, the full profile length for an
n-gram that the language does not list. The nearest language is predicted.

Profiles are learned from a bounded sample (`per_language` rows of each language are expected, documented
parameter) that hashes of the id choose; labels serve for nothing else. Predictions read every whole text.

A null text, or one without a letter, gives `und` with score 0, and so does everything if nothing could be
learned. Equal distances go to the first language by name. The score is 1 - best / second-best distance, 0 to 1
(with a single learned language: 1 - distance / greatest distance). An empty table gives no rows; repeated rows
give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import pieces

LENGTHS = (1, 2, 3)
LISTED = 400
#: Bounded sample: rows of each language that learning expects to use.
PER_LANGUAGE = 2000
UNKNOWN = "und"
OTHER = regex.compile(r"[^\p{L}\p{M}']+")
LETTER = regex.compile(r"\p{L}")


def symbols(text: str) -> np.ndarray:
    """Code points of the lower-cased words, with a blank before, between and after."""
    return np.frombuffer(f" {OTHER.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """Packed n-grams (21 bits a code point); blanks only begin or end one."""
    wide = code.astype(np.uint64)
    out = wide[: len(wide) - n + 1].copy()
    for k in range(1, n):
        out = out << np.uint64(21) | wide[k : len(wide) - n + 1 + k]
    if n == 3:
        return out[code[1 : len(code) - 1] != 32]
    return out[code != 32] if n == 1 else out


def ranked(text: str, listed: int = LISTED) -> np.ndarray:
    """The n-grams of a text from the most frequent on; ties by code."""
    code = symbols(text)
    kinds, counts = [], []
    for n in LENGTHS:
        if len(code) < n:
            continue
        sorted_grams = np.sort(grams(code, n))
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(sorted_grams)), bool), sorted_grams[1:] != sorted_grams[:-1])))
        kinds.append(sorted_grams[first])
        counts.append(np.diff(np.append(first, len(sorted_grams))))
    kind, count = np.concatenate(kinds), np.concatenate(counts)
    if len(count) > listed:  # all that can be listed; ties at the border are settled below
        keep = count >= np.partition(count, len(count) - listed)[len(count) - listed]
        kind, count = kind[keep], count[keep]
    return kind[np.lexsort((kind, -count))][:listed]


class Profiles:
    def __init__(self, of: dict[str, np.ndarray], listed: int = LISTED):
        self.languages, self.listed = sorted(of), listed
        self.kind = np.unique(np.concatenate([of[x] for x in self.languages])) if of else np.zeros(0, np.uint64)
        self.rank = np.full((len(self.languages), len(self.kind) + 1), -1, np.int64)
        for k, x in enumerate(self.languages):
            self.rank[k, np.searchsorted(self.kind, of[x])] = np.arange(len(of[x]))

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return UNKNOWN, 0.0
        own = ranked(text, self.listed)
        at = np.searchsorted(self.kind, own)
        at[at < len(self.kind)] = np.where(self.kind[at[at < len(self.kind)]] == own[at < len(self.kind)], at[at < len(self.kind)], len(self.kind))
        there = self.rank[:, at]
        distance = np.where(there < 0, self.listed, np.abs(there - np.arange(len(own)))).sum(axis=1)
        best = int(np.argmin(distance))
        against = np.partition(distance, 1)[1] if len(distance) > 1 else len(own) * self.listed
        return self.languages[best], float(1 - distance[best] / against) if against else 0.0


def learn(labelled: DataFrame, lang_col: str, text_col: str, seed: Column, per_language: int = PER_LANGUAGE, listed: int = LISTED) -> Profiles:
    """Profiles from a bounded sample of labelled rows: those whose seed hash falls below per_language / (rows of the language)."""
    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy(F.col(lang_col).alias("lang")).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Profiles({}, listed)
    share = F.create_map(*[F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, per_language / n)])
    drawn = rows.filter(F.pmod(seed, F.lit(1 << 30)) < F.element_at(share, F.col(lang_col)) * F.lit(float(1 << 30)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[tuple[str, int], int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                code = symbols(text)
                for n in LENGTHS:
                    if len(code) >= n:
                        for g, c in zip(*(x.tolist() for x in np.unique(grams(code, n), return_counts=True)), strict=True):
                            out[lang, g] = out.get((lang, g), 0) + c
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in out], pa.string()), pa.array([k[1] for k in out], pa.int64()), pa.array(list(out.values()), pa.int64())], ["lang", "gram", "n"])

    counted = drawn.select(F.col(lang_col), F.col(text_col)).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    best = counted.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "gram"))), 1, listed).alias("top"))
    return Profiles({r["lang"]: np.array([g["gram"] for g in r["top"]], np.uint64) for r in best.collect()}, listed)


def identify(df: DataFrame, text_col: str, profiles: Profiles, lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """df with the predicted language and a score. Only the text goes to the predictor beside the columns of df; an own
    column of df that has the name of an added one gives way to it."""
    own = df.select(*[c for c in df.columns if c not in (lang_as, score_as)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(t) for part in pieces(batch, text_col) for t in part.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], [*batch.schema.names, lang_as, score_as])

    from pyspark.sql.types import DoubleType, StringType, StructType

    return own.mapInArrow(run, StructType([*own.schema.fields]).add(lang_as, StringType()).add(score_as, DoubleType()))
