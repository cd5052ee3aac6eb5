"""Benchmark decontamination on a distributed positional inverted index.

The index is stored in the shared folder. Texts are gathered in blocks; the words of a block have places, with a gap
between texts, and a row of the index has the posting lists of one block and one bucket of terms: terms (64-bit hashes,
ascending), where their lists end, and the ascending places. Rows are dealt by bucket of terms (and, so that the bucket of
a very common term is spread, by block) into a bucketed table, so that a search meets them where they lie: only what it asks
for is shuffled. A text of any length is in one block. Only terms
of the test items get lists, where these have at most TERMS distinct ones (whose hashes are broadcast); else all terms do.

A test window is searched from its rarest term. Frequencies are the lengths of the lists, so one pass over the index
(without places) ranks the terms of all windows; a window with a term that never occurs ends there. The rarest term's
list, shifted by the term's offset, gives candidate starts. These are intersected with the shifted list of the second
rarest term, and what is left with those of all other terms: a candidate asks the row of (bucket, block) for the
place where the term must be, and stays if every term of the window is there. What is left are exact phrase
matches. A proximity match asks for a posting of each term within `slop` words of its place beside the rarest one; the gaps
between texts are wider than that.

Items and windows are tables too; besides those hashes nothing of them, nor of the documents, goes through the driver.

Null or wordless texts have no words and no hits; null or wordless items have no windows; items that share a text
all count. Rows with a repeated id are separate documents. An own column named n_words or hits gives way to the added one.
Empty tables give no rows, or no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import apart, forget, pieces, restored, stored, stored_in_buckets, utf8
from .textscan import ALNUM, Words, mix

#: Bytes of text whose postings make a block of the index.
BLOCK_BYTES = 8 << 20
#: Term buckets: 2 ** BITS.
BITS = 6
#: Distinct terms of test items whose hashes are broadcast at most.
TERMS = 4 << 20
LISTS = "bucket int, block long, terms binary, ends binary, places binary"


def bucket_of(term: Column) -> Column:
    return F.shiftrightunsigned(term, 64 - BITS).cast("int")


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """w (hash of the words), item and terms (in order) of every window of items (item, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(*utf8(part.column(1)), ALNUM)
                names, keys, terms = [], [], []
                for item, a, b in zip(part.column(0).to_pylist(), words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
                    for k in range(a, max(b - size, a) + 1) if b > a else ():
                        own = words.hash[k : min(k + size, b)]
                        with np.errstate(over="ignore"):
                            keys.append(mix(np.sum(mix(own + mix(np.arange(1, len(own) + 1, dtype=np.uint64))), keepdims=True)).view(np.int64)[0])
                        names.append(item)
                        terms.append(own.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.string()), pa.array(terms, pa.list_(pa.int64()))], ["w", "item", "terms"])

    return items.mapInArrow(run, "w long, item string, terms array<long>")


def _postings(gap: int, block_bytes: int, vocabulary: Broadcast | None):  # noqa: ANN202
    """(row, text) -> rows of the index, and for each block (bucket -1) its rows, the places where they begin and their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, held, size = TaskContext.get().partitionId() << 32, [], 0

        def flush() -> pa.RecordBatch:
            rows, counts, term = (np.concatenate([h[k] for h in held]) for k in range(3))
            begin = np.cumsum(counts + gap) - (counts + gap)
            place = (np.arange(len(term)) + np.repeat(gap * np.arange(len(rows)), counts)).astype(np.int32)
            if vocabulary is not None:
                known = vocabulary.value
                asked = known[np.minimum(np.searchsorted(known, term), len(known) - 1)] == term if len(known) else np.zeros(len(term), bool)
                term, place = term[asked], place[asked]
            order = np.argsort(term, kind="stable")
            term, place = term[order], place[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(term)), bool), term[1:] != term[:-1])))
            terms, ends = term[first], np.append(first[1:], len(term))[: len(first)]
            cut = np.searchsorted(terms, np.arange(1 << BITS, dtype=np.uint64) << np.uint64(64 - BITS))
            out = [(-1, rows.astype(np.int64).tobytes(), begin.astype(np.int64).tobytes(), counts.astype(np.int64).tobytes())]
            for k, (a, b) in enumerate(zip(cut.tolist(), [*cut[1:].tolist(), len(terms)], strict=True)):
                if a < b:
                    out.append((k, terms[a:b].tobytes(), (ends[a:b] - first[a]).astype(np.int32).tobytes(), place[first[a] : ends[b - 1]].tobytes()))
            columns = [pa.array([r[0] for r in out], pa.int32()), pa.array([block] * len(out), pa.int64()), *[pa.array([r[k] for r in out], pa.binary()) for k in (1, 2, 3)]]
            return pa.RecordBatch.from_arrays(columns, ["bucket", "block", "terms", "ends", "places"])

        for batch in batches:
            for part in pieces(batch, "text", min(1 << 20, block_bytes)):
                data, offsets = utf8(part.column(1))
                words = Words(data, offsets, ALNUM)
                held.append((part.column(0).to_numpy(), words.count(), words.hash))
                size += len(data)
                if size >= block_bytes:
                    yield flush()
                    block, held, size = block + 1, [], 0
        if held:
            yield flush()

    return run


def build_index(texts: DataFrame, gap: int, block_bytes: int = BLOCK_BYTES, terms: DataFrame | None = None) -> DataFrame:
    """The stored index of texts (row, text), a table bucketed by (bucket, block); of terms (distinct, a column term) only, if
    these are few enough."""
    vocabulary = None
    if terms is not None:
        found = terms.limit(TERMS + 1).toArrow().column(0).to_numpy()
        vocabulary = texts.sparkSession.sparkContext.broadcast(np.sort(found.view(np.uint64))) if len(found) <= TERMS else None
    rows = texts.mapInArrow(_postings(gap, block_bytes, vocabulary), LISTS)
    return stored_in_buckets(rows, ["bucket", "block"])


class Lists:
    """The posting lists of a row of the index."""

    def __init__(self, terms: bytes, ends: bytes, places: bytes = b""):
        self.terms, self.ends, self.places = np.frombuffer(terms, np.uint64), np.frombuffer(ends, np.int32), np.frombuffer(places, np.int32)
        self.begin = np.concatenate((np.zeros(1, np.int32), self.ends[:-1]))

    def find(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the list of each term, and whether there is one."""
        asked = asked.view(np.uint64)
        at = np.minimum(np.searchsorted(self.terms, asked), len(self.terms) - 1)
        return at, self.terms[at] == asked

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of some lists, and which of them each belongs to."""
        n = (self.ends - self.begin)[at].astype(np.int64)
        which = np.repeat(np.arange(len(at)), n)
        return self.places[self.begin[at][which] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)].astype(np.int64), which

    def near(self, asked: np.ndarray, place: np.ndarray, slop: int) -> np.ndarray:
        """Whether each term has a posting at a place, or within slop words of it."""
        at, there = self.find(asked)
        keys = np.repeat(np.arange(len(self.terms), dtype=np.int64) << 32, self.ends - self.begin) + self.places
        found = np.searchsorted(keys, (at.astype(np.int64) << 32) + np.maximum(place - slop, 0))
        return there & (place + slop >= 0) & (found < len(keys)) & (keys[np.minimum(found, len(keys) - 1)] <= (at.astype(np.int64) << 32) + place + slop)


def _array(column: pa.Array, k: int) -> np.ndarray:
    return column[k].values.to_numpy(zero_copy_only=False)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    held = [np.concatenate([r[k] for r in rows]) if rows else np.zeros(0, np.int64) for k in range(len(names))]
    return pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)) for h in held], names)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(terms, ends, asked) -> (term, n)."""
    for batch in batches:
        rows = []
        for k in range(len(batch)):
            lists, asked = Lists(batch.column(0)[k].as_py(), batch.column(1)[k].as_py()), _array(batch.column(2), k)
            at, there = lists.find(asked)
            rows.append((asked[there], (lists.ends - lists.begin)[at[there]]))
        yield _batch(rows, ["term", "n"])


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, terms, ends, places, term, offset, w) -> candidates (block, w, start)."""
    for batch in batches:
        rows = []
        for k in range(len(batch)):
            lists = Lists(*(batch.column(c)[k].as_py() for c in (1, 2, 3)))
            term, offset, w = (_array(batch.column(c), k) for c in (4, 5, 6))
            at, there = lists.find(term)
            place, which = lists.of(at[there])
            rows.append((np.full(len(place), batch.column(0)[k].as_py()), w[there][which], place - offset[there][which]))
        yield _batch(rows, ["block", "w", "start"])


def _asked(slop: int):  # noqa: ANN202
    """(block, terms, ends, places, term, place, w, start, need) -> those candidates whose term is there, (block, w, start, need)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(len(batch)):
                lists = Lists(*(batch.column(c)[k].as_py() for c in (1, 2, 3)))
                term, place, w, start, need = (_array(batch.column(c), k) for c in range(4, 9))
                ok = lists.near(term, place, slop)
                rows.append((np.full(ok.sum(), batch.column(0)[k].as_py()), w[ok], start[ok], need[ok]))
            yield _batch(rows, ["block", "w", "start", "need"])

    return run


def _unpacked(structs: str, *fields: str) -> list[Column]:
    """Fields of an array of structs as arrays."""
    return [F.col(structs)[f].alias(f) for f in fields]


def intersected(candidates: DataFrame, plans: DataFrame, lists: DataFrame, first: int, last: int, slop: int) -> DataFrame:
    """Candidates that also have the terms of rank first to last (excluded) of their windows."""
    joined = candidates.join(plans, "w")
    asks = joined.filter(F.size("plan") > first).select("block", "w", "start", F.slice("plan", first + 1, last - first).alias("asked"))
    asks = asks.select("block", "w", "start", F.size("asked").cast("long").alias("need"), F.inline("asked"))
    packed = asks.groupBy(bucket_of(F.col("term")).alias("bucket"), "block").agg(F.collect_list(F.struct("term", (F.col("start") + F.col("offset")).alias("place"), "w", "start", "need")).alias("asks"))
    met = lists.hint("merge").join(packed, ["bucket", "block"]).select("block", "terms", "ends", "places", *_unpacked("asks", "term", "place", "w", "start", "need"))
    there = met.mapInArrow(_asked(slop), "block long, w long, start long, need long").groupBy("block", "w", "start").agg(F.count("*").alias("n"), F.max("need").alias("need"))
    return there.filter("n = need").select("block", "w", "start").union(joined.filter(F.size("plan") <= first).select("block", "w", "start"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rows, begins, place, w, size) of a block -> (row, w, from, to) in words of the row."""
    for batch in batches:
        out = []
        for k in range(len(batch)):
            rows, begin = (np.frombuffer(batch.column(c)[k].as_py(), np.int64) for c in (0, 1))
            place, w, size = (_array(batch.column(c), k) for c in (2, 3, 4))
            at = np.searchsorted(begin, place, "right") - 1
            out.append((rows[at], w, place - begin[at], place - begin[at] + size))
        yield _batch(out, ["row", "w", "from", "to"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rows, counts) of a block -> (row, n_words)."""
    for batch in batches:
        yield _batch([tuple(np.frombuffer(batch.column(c)[k].as_py(), np.int64) for c in (0, 1)) for k in range(len(batch))], ["row", "n_words"])


def found_in(texts: DataFrame, items: DataFrame, size: int, slop: int | None, block_bytes: int, counted: bool = True) -> DataFrame:
    """row, n_words and hits (null: none) of all texts (row, text); unless counted, with n_words null, of those only that windows of
    items (item, text) occur in. Stored."""
    windows = stored(windows_of(items, size))
    index = build_index(texts, size + (slop or 0), block_bytes, windows.select(F.explode("terms").alias("term")).distinct())
    lists = index.filter("bucket >= 0")
    distinct = stored(windows.groupBy("w").agg(F.first("terms").alias("terms")))
    # of equally rare terms the one nearest the window's middle goes first: the others are then within reach on both sides
    placed = distinct.select("w", F.size("terms").alias("length"), F.posexplode("terms").alias("offset", "term"))
    asked = placed.select("term").distinct().groupBy(bucket_of(F.col("term")).alias("bucket")).agg(F.collect_list("term").alias("asked"))
    sizes = lists.select("bucket", "terms", "ends").join(asked, "bucket").select("terms", "ends", "asked").mapInArrow(_sizes, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    ranked = placed.join(sizes, "term", "left").groupBy("w").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), F.abs(2 * F.col("offset") + 1 - F.col("length")).alias("beside"), F.col("offset").cast("long").alias("offset"), "term"))).alias("plan"))
    plans = stored(ranked.filter("plan[0].n > 0"))

    rarest = plans.select(F.col("plan")[0]["term"].alias("term"), F.col("plan")[0]["offset"].alias("offset"), "w")
    probes = rarest.groupBy(bucket_of(F.col("term")).alias("bucket")).agg(F.collect_list(F.struct("term", "offset", "w")).alias("p")).select("bucket", *_unpacked("p", "term", "offset", "w"))
    candidates = stored(lists.join(probes, "bucket").select("block", "terms", "ends", "places", "term", "offset", "w").mapInArrow(_starts, "block long, w long, start long"))
    for first, last in ((1, 2), (2, size)):
        if last > first:
            before, candidates = candidates, stored(intersected(candidates, plans, lists, first, last, slop or 0))
            forget(before)

    pivot = F.lit(0) if slop is None else F.col("plan")[0]["offset"]
    long = F.size("plan").cast("long") if slop is None else F.lit(1).cast("long")
    where = candidates.join(plans, "w").select("block", (F.col("start") + pivot).alias("place"), "w", long.alias("size"))
    packed = where.groupBy("block").agg(F.collect_list(F.struct("place", "w", "size")).alias("p"))
    blocks = index.filter("bucket = -1").select("block", "terms", "ends")
    hits = blocks.join(packed, "block").select("terms", "ends", *_unpacked("p", "place", "w", "size")).mapInArrow(_rows, "row long, w long, from long, to long")
    named = hits.join(windows.select("w", F.coalesce("item", F.lit("")).alias("item")).distinct(), "w")
    spans = named.groupBy("row", "item").agg(merged(F.array_sort(F.collect_set(F.struct("from", "to")))).alias("spans"))
    found = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("item", "spans"))).alias("hits"))
    counts = index.filter("bucket = -1").select("terms", "places").mapInArrow(_counted, "row long, n_words long")
    out = stored(counts.join(found, "row", "left") if counted else found.withColumn("n_words", F.lit(None).cast("long")))
    forget(windows, distinct, plans, candidates, index)
    return out


def merged(spans: Column) -> Column:
    """Ascending spans, with those that overlap or touch as one."""
    none = F.array().cast("array<struct<from:long,to:long>>")
    last = lambda acc: F.element_at(acc, -1)
    longer = lambda acc, s: F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last(acc)["from"].alias("from"), F.greatest(last(acc)["to"], s["to"]).alias("to"))))
    return F.aggregate(spans, none, lambda acc, s: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["to"] >= s["from"]), longer(acc, s)).otherwise(F.concat(acc, F.array(s))))


def matches(df: DataFrame, text_col: str, items: DataFrame, item_col: str, item_text_col: str, size: int = 10, slop: int | None = None, block_bytes: int = BLOCK_BYTES, counted: bool = True) -> DataFrame:
    """df with n_words (null unless counted) and `hits`: for each item with an occurring window {item, spans of words (from, to)}.

    slop None asks for exact phrases, a number for proximity matches (spans are then the rarest terms' places)."""
    own, names = apart(df)
    text = names[text_col]
    rows = stored(own.withColumn("__row", F.monotonically_increasing_id()), "zstd")
    asked = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).alias("text"))
    found = found_in(rows.select(F.col("__row").alias("row"), F.col(text).alias("text")), asked, size, slop, block_bytes, counted)
    none = F.array().cast("array<struct<item:string,spans:array<struct<from:long,to:long>>>>")
    told = rows.join(found.withColumnRenamed("row", "__row"), "__row", "left").withColumn("hits", F.coalesce("hits", none))
    return restored(told, names, ["n_words", "hits"])


def digest(found: DataFrame, id_col: str) -> DataFrame:
    """n_words, n_hit (words inside any span), n_items, items_sha256 and contaminated from matches()."""
    spans = F.array_sort(F.flatten(F.transform("hits", lambda h: h["spans"])))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    covered = F.aggregate(spans, start, lambda acc, s: F.struct((acc["n"] + F.greatest(s["to"] - F.greatest(s["from"], acc["to"]), F.lit(0))).alias("n"), F.greatest(acc["to"], s["to"]).alias("to")))["n"]
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item"])))
    return found.select(
        id_col,
        "n_words",
        covered.alias("n_hit"),
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"),
    )
