"""Repeated-substring removal by suffix arrays.

A byte goes if a string of `width` bytes that covers it also starts elsewhere, in another document or the same.

1. Anchors. Every window of `width` bytes is owned by the `GRAM`-byte string in it with the smallest hash (leftmost
   of equal ones): equal windows have equal owners at equal places. The run of windows with one owner, and the
   bytes they span, is a context (about 85 windows, 285 bytes). One slim row per context travels: hashes of owner
   and context, and where it is. An owner that occurs once ends here, and so does nearly all unrepeated text.
2. A context whose bytes occur twice is repeated as a whole. What is left, contexts whose owner recurs with other
   bytes around it, is cut from its text, one copy of each distinct context, and dealt into shards by owner.
3. Per shard: a suffix array by Larsson-Sadakane refinement (ranks of 8 bytes, then doubling, sorting only groups
   that are still unsorted) and Kasai's common prefixes (compared only where the preceding bytes differ, the rest
   follow from prefix[i] >= prefix[i-1] - 1). Owned windows in a run of common prefixes >= width are repeated.
   An owner with more contexts than one shard holds is cut into several; their sorted windows are merged by binary
   search, each shard's against those of the others.
   An owner with over HOT bytes of contexts (a phrase that very many texts share) is no task's: its windows are owned
   anew, by another hash, and equal windows meet again under the pair of owners. That is repeated, and each round parts
   windows by what surrounds the phrase; contexts that are alone with their owners then end there.
4. Ranges are gathered for each distinct text, merged, and cut out.

A text of over SEGMENT bytes is read in segments that overlap by a window. Work is per distinct text: copies of a text of at least `width` bytes are removed whole, with no text moved.
Null texts are empty. Texts shorter than width keep every byte. Rows that repeat an id are separate documents
(each repeats the other's text). An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .base import apart, forget, pieces, restored, stored, text_key, utf8
from .textscan import Rolling, mix

GRAM = 32
#: Bytes of contexts in one suffix array.
SHARD = 1 << 20
#: Bytes of one owner's contexts from which on it is split, and rounds of that at most.
HOT, ROUNDS = 4 << 20, 6
#: Bytes of a text whose windows are owned at a time.
SEGMENT = 2 << 20
#: 0xFF and 0xFE never occur in UTF-8.
END = 0xFF


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first `depth` bytes at least (shorter suffixes first), by Larsson-Sadakane refinement."""
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | padded[k : k + n]
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    head = np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))
    group = np.maximum.accumulate(np.where(head, np.arange(n), 0))  # a group is named by its first place
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = group
    h = 8
    while h < depth:
        unsorted = ~head | np.append(~head[1:], False)
        at = np.flatnonzero(unsorted)
        if not len(at):
            break
        suffix = order[at]
        second = rank[np.minimum(suffix + h, n)] + 1
        new = np.argsort(group[at] * (n + 2) + second, kind="stable")
        order[at], second = suffix[new], second[new]
        head[at] |= np.concatenate(([True], (second[1:] != second[:-1]) | (group[at][1:] != group[at][:-1])))
        fresh = np.where(head[at], at, 0)
        group[at] = np.maximum.accumulate(fresh)
        rank[order[at]] = group[at]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place of the order, the length of the common prefix with the place before (Kasai's relation)."""
    n = len(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    index = np.arange(n)
    follows = np.zeros(n, bool)  # as long as the one a byte earlier, less that byte
    follows[1:] = (before[1:] > 0) & (before[:-1] >= 0) & (data[:-1] == data[np.maximum(before[1:] - 1, 0)])
    # only where the preceding suffix's neighbour is this one's neighbour too
    follows[1:] &= before[:-1] + 1 == before[1:]
    lead = np.flatnonzero(~follows)
    a, b = lead, before[lead]
    length = np.zeros(len(lead), np.int64)
    live = np.flatnonzero(b >= 0)
    padded = np.concatenate((data, np.zeros(64, np.uint8)))
    step = 16
    window = np.lib.stride_tricks.sliding_window_view(padded, step)
    while len(live):
        x, y = a[live] + length[live], b[live] + length[live]
        ok = (x < n) & (y < n)
        live, x, y = live[ok], x[ok], y[ok]
        if not len(live):
            break
        differ = window[x] != window[y]
        any_differ = differ.any(axis=1)
        length[live] += np.where(any_differ, differ.argmax(axis=1), step)
        live = live[~any_differ]
    length = np.minimum(length, n - np.maximum(a, b))
    prefix = np.zeros(n, np.int64)
    at = np.maximum.accumulate(np.where(~follows, index, 0))
    place = np.zeros(n, np.int64)
    place[lead] = length
    prefix = np.maximum(place[at] - (index - at), 0)
    return prefix[order]


def anchors(data: np.ndarray, offsets: np.ndarray, width: int, salt: int = 0) -> tuple[np.ndarray, ...]:
    """Contexts of texts that lie end to end: text number, first and last window, hash of the owner, hash of the bytes.

    salt: owners by another hash."""
    n, wide = len(data), width - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    rolling = Rolling(data)
    gram = rolling.grams(GRAM) if n > GRAM else rolling.ranges(np.zeros(1, np.int64), np.full(1, GRAM))
    gram = np.append(gram, rolling.ranges(np.array([n - GRAM]), np.array([n])))[: n - GRAM + 1]
    if salt:
        gram = mix(gram ^ mix(np.array([salt], np.uint64)))
    bits = np.uint64(max(24, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    key = gram & ~low | np.arange(len(gram), dtype=np.uint64)
    rows = -(-len(key) // wide) + 1
    block = np.full(rows * wide, ~np.uint64(0))
    block[: len(key)] = key
    block = block.reshape(rows, wide)
    left = np.minimum.accumulate(block, axis=1).ravel()
    right = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = n - width + 1
    owner = (np.minimum(right[:windows], left[wide - 1 : wide - 1 + windows]) & low).astype(np.int64)
    valid = np.zeros(windows + 1, np.int64)
    sizes = np.diff(offsets)
    long = sizes >= width
    np.add.at(valid, offsets[:-1][long], 1)
    np.add.at(valid, offsets[1:][long] - width + 1, -1)
    inside = np.cumsum(valid[:windows]) > 0
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1])
    last = inside.copy()
    last[:-1] &= ~inside[1:] | (owner[1:] != owner[:-1])
    document_start = np.zeros(n + 1, bool)
    document_start[offsets[:-1][long]] = True
    first |= inside & document_start[:windows]
    last[:-1] |= inside[:-1] & document_start[1:windows]
    lo, hi = np.flatnonzero(first), np.flatnonzero(last)
    own = owner[lo]
    with np.errstate(over="ignore"):
        content = mix(rolling.ranges(lo, hi + width) + mix((own - lo).astype(np.uint64)) * np.uint64(3) + (hi - lo).astype(np.uint64))
    text = np.searchsorted(offsets, lo, "right") - 1
    return text, lo - offsets[text], hi - offsets[text], gram[own], content


class Shard:
    """A suffix array over contexts of whole owner groups, or of a part of one."""

    def __init__(self, contexts: list[bytes], windows: np.ndarray, width: int):
        self.width = width
        sizes = np.array([len(c) + 1 for c in contexts])
        self.data = np.frombuffer(b"".join(c + bytes([END]) for c in contexts), np.uint8)
        self.start = np.cumsum(sizes) - sizes
        owned = np.zeros(len(self.data) + 1, np.int64)
        np.add.at(owned, self.start, 1)
        np.add.at(owned, self.start + windows, -1)
        owned = np.cumsum(owned)[:-1] > 0
        order = suffix_array(self.data, width)
        prefix = common_prefixes(self.data, order)
        run = np.cumsum(prefix < width)
        mine = owned[order]
        self.sorted, run = order[mine], run[mine]
        _, at, sizes = np.unique(run, return_inverse=True, return_counts=True)
        self.repeated = sizes[at] > 1

    def strings(self) -> np.ndarray:
        """The owned windows in order, as fixed-width strings."""
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.width)
        return np.ascontiguousarray(view[self.sorted]).view(f"S{self.width}").ravel()

    def merge(self, other: Shard) -> None:
        """Marks the windows that the other shard also has, in both, by binary search."""
        mine, theirs = self.strings(), other.strings()
        for a, b, marks in ((mine, theirs, self.repeated), (theirs, mine, other.repeated)):
            at = np.minimum(np.searchsorted(b, a), len(b) - 1)
            marks |= b[at] == a

    def ranges(self) -> Iterator[tuple[int, int, int]]:
        """Context, first and last window of each run of repeated windows."""
        place = np.sort(self.sorted[self.repeated])
        if len(place):
            context = np.searchsorted(self.start, place, "right") - 1
            cut = np.flatnonzero((np.diff(place) > 1) | (np.diff(context) > 0))
            first, last = np.concatenate(([0], cut + 1)), np.append(cut, len(place) - 1)
            yield from zip(context[first].tolist(), (place[first] - self.start[context[first]]).tolist(), (place[last] - self.start[context[first]]).tolist(), strict=True)


def _anchor_rows(width: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                data, offsets = utf8(part.column(2))
                long = len(part) == 1 and len(data) > SEGMENT
                for begin in range(0, len(data) - width + 1, SEGMENT) if long else (0,):
                    segment = data[begin : begin + SEGMENT + width - 1] if long else data
                    text, lo, hi, owner, content = anchors(segment, np.array([0, len(segment)]) if long else offsets, width)
                    where = pa.array(text)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(where), part.column(1).take(where), pa.array((lo + begin).astype(np.int32)), pa.array((hi + begin).astype(np.int32)), pa.array(owner.view(np.int64)), pa.array(content.view(np.int64))],
                        ["k1", "k2", "lo", "hi", "owner", "content"],
                    )

    return run


#: Columns of contexts that are cut out.
CUT = "owner long, content long, k1 long, k2 long, lo int, n long, windows int, bytes binary"


def _owned_again(width: int, salt: int):  # noqa: ANN202
    """Contexts (CUT) -> contexts of their windows by a second owner; the owner is the pair of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "bytes"):
                data, offsets = utf8(part.column(7))
                context, lo, hi, owner, content = anchors(data, offsets, width, salt)
                old = part.column(0).to_numpy().view(np.uint64)[context]
                where, raw, begin = pa.array(context), data.tobytes(), offsets[context]
                held = [raw[a:b] for a, b in zip((begin + lo).tolist(), (begin + hi + width).tolist(), strict=True)]
                columns = [
                    pa.array(mix(old ^ mix(owner)).view(np.int64)), pa.array(content.view(np.int64)), part.column(2).take(where), part.column(3).take(where),
                    pa.array((part.column(4).to_numpy()[context] + lo).astype(np.int32)), part.column(5).take(where), pa.array((hi - lo + 1).astype(np.int32)), pa.array(held, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["owner", "content", "k1", "k2", "lo", "n", "windows", "bytes"])

    return run


def split_hot(cut: DataFrame, hot: DataFrame, width: int) -> DataFrame:
    """cut, with the contexts of hot owners (column owner) owned anew until an owner has at most HOT bytes."""
    done, part = [cut.join(hot, "owner", "left_anti")], cut.join(hot, "owner", "left_semi").dropDuplicates(["owner", "k1", "k2", "lo"])
    for salt in range(1, ROUNDS + 1):
        part = stored(part.mapInArrow(_owned_again(width, salt), CUT))
        sizes = stored(part.groupBy("owner").agg(F.count("*").alias("contexts"), F.sum(F.length("bytes")).alias("size")).filter("contexts > 1"))
        done.append(part.join(sizes.filter(F.col("size") <= HOT).select("owner"), "owner", "left_semi"))
        still = sizes.filter(F.col("size") > HOT).select("owner")
        if still.isEmpty():
            break
        part = part.join(still, "owner", "left_semi")
    else:
        done.append(part)
    return functools.reduce(DataFrame.union, done)


def _shard_rows(width: int):  # noqa: ANN202
    """Batches sorted by owner -> ranges of repeated windows of the contexts that occur once."""

    def found(shard: Shard, rows: list[tuple]) -> pa.RecordBatch:
        out = [(rows[k][2], rows[k][3], rows[k][4] + a, rows[k][4] + b) for k, a, b in shard.ranges() if rows[k][5] == 1]
        return pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["k1", "k2", "lo", "hi"])

    def made(rows: list[tuple]) -> Shard:
        return Shard([r[7] for r in rows], np.array([r[6] for r in rows]), width)

    def settle(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        """Small groups share a suffix array; a large one is cut into several, which are merged."""
        small: list[tuple] = []
        for group in groups:
            ends = np.cumsum([len(r[7]) for r in group])
            if ends[-1] <= SHARD:
                small += group
                continue
            part = (ends // SHARD).tolist()
            parts = [[r for r, p in zip(group, part, strict=True) if p == k] for k in sorted(set(part))]
            shards = [made(p) for p in parts]
            for k, shard in enumerate(shards):
                for other in shards[:k]:
                    shard.merge(other)
            for shard, rows in zip(shards, parts, strict=True):
                yield found(shard, rows)
        if small:
            yield found(made(small), small)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[tuple]] = []
        size, owner, seen = 0, None, set()
        for batch in batches:
            for r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r[0] != owner:
                    owner, seen = r[0], set()
                    if size > SHARD // 2:
                        yield from settle(groups)
                        groups, size = [], 0
                    groups.append([])
                if r[2:5] not in seen:  # rows that repeat an id bring a context twice
                    seen.add(r[2:5])
                    groups[-1].append(r)
                    size += len(r[7])
        if groups:
            yield from settle(groups)

    return run


def repeated_ranges(keyed: DataFrame, width: int) -> DataFrame:
    """k1, k2, spans (array of lo, hi: first and last repeated window, ascending) of the texts of keyed (k1, k2, id, text) that have any; stored."""
    every = stored(keyed.select("k1", "k2", "text").filter(F.octet_length("text") >= width).mapInArrow(_anchor_rows(width), "k1 long, k2 long, lo int, hi int, owner long, content long"))
    again = every.groupBy("owner").agg(F.count("*").alias("n"), F.min("content").alias("c1"), F.max("content").alias("c2")).filter("n > 1").select("owner", (F.col("c1") < F.col("c2")).alias("varied"))
    # tables of their own, so that a join's sides are shuffles and a hot key's rows can be dealt to several tasks
    again = stored(again)
    rows = stored(every.join(again, "owner"))
    forget(every, again)
    contexts = stored(rows.groupBy("owner", "content", "varied").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "lo", "hi")).alias("at")))
    whole = rows.join(contexts.filter("n > 1").select("owner", "content"), ["owner", "content"]).select("k1", "k2", "lo", "hi")
    open_groups = contexts.filter("varied").groupBy("owner").agg(F.min("n").alias("least")).filter("least = 1").select("owner")
    source = keyed.groupBy("k1", "k2").agg(F.min("id").alias("id"))
    wanted = contexts.filter("varied").join(open_groups, "owner").select("owner", "content", "at.*", "n").join(source, ["k1", "k2"])
    texts = keyed.withColumnRenamed("id", "text_id")
    cut = texts.join(wanted, (texts.k1 == wanted.k1) & (texts.k2 == wanted.k2) & texts.text_id.eqNullSafe(wanted.id)).select(
        "owner",
        "content",
        wanted.k1,
        wanted.k2,
        "lo",
        "n",
        (F.col("hi") - F.col("lo") + 1).cast("int").alias("windows"),
        F.substring(F.col("text").cast("binary"), F.col("lo") + 1, F.col("hi") - F.col("lo") + width).alias("bytes"),
    )
    sizes = contexts.filter("varied").groupBy("owner").agg(F.sum(F.col("at.hi") - F.col("at.lo") + width).alias("size"))
    hot = stored(sizes.filter(F.col("size") > HOT).select("owner"))
    held = [rows, contexts, hot]
    if not hot.isEmpty():
        held.append(stored(cut))
        cut = split_hot(held[-1], hot, width)
    single = cut.repartition("owner").sortWithinPartitions("owner", "content").mapInArrow(_shard_rows(width), "k1 long, k2 long, lo int, hi int")
    spans = stored(whole.union(single).groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans")))
    forget(*held)
    return spans


def _kept(raw: bytes, spans: pa.StructScalar, width: int) -> tuple[bytes, int]:
    """What is left of a text, and the number of maximal runs cut out."""
    ends = spans.values
    lo, hi = ends.field(0).to_numpy(), ends.field(1).to_numpy() + width
    reach = np.maximum.accumulate(hi)
    first = np.flatnonzero(np.concatenate(([True], lo[1:] > reach[:-1])))
    a, b = lo[first].tolist(), reach[np.append(first[1:] - 1, len(lo) - 1)].tolist()
    return b"".join(raw[x:y] for x, y in zip([0, *b], [*a, len(raw)], strict=True)), len(a)


def _cutter(width: int):  # noqa: ANN202
    """(k1, k2, text, spans) -> n_removed, n_spans and digest of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, runs, digests = [], [], []
            for text, spans in zip(batch.column(2), batch.column(3), strict=True):
                raw = text.as_py().encode()
                kept, n = _kept(raw, spans, width)
                removed.append(len(raw) - len(kept))
                runs.append(n)
                digests.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string())], ["k1", "k2", "n_removed", "n_spans", "kept_sha256"])

    return run


ADDED = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]


def _rewriter(width: int, text_col: str):  # noqa: ANN202
    """Whole rows with __n (copies of the text) and __spans -> the rows with ADDED instead of these two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: k for k, name in enumerate(batch.schema.names)}
            out: list[tuple] = []
            for text, n, spans in zip(*(batch.column(at[c]) for c in (text_col, "__n", "__spans")), strict=True):
                raw = (text.as_py() or "").encode()
                kept, runs = raw, 0
                if (n.as_py() or 0) > 1 and len(raw) >= width:
                    kept, runs = b"", 1
                elif spans.is_valid:
                    kept, runs = _kept(raw, spans, width)
                out.append((len(raw), len(raw) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            held = [name for name in batch.schema.names if name not in ("__n", "__spans")]
            yield pa.RecordBatch.from_arrays([*[batch.column(at[c]) for c in held], *[pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]], [*held, *ADDED])

    return run


def remove_repeats(df: DataFrame, id_col: str, text_col: str, width: int = 200, with_text: bool = False) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept_sha256 of every row; with_text: df's own columns before these, and the
    remaining text as `kept` (a character that a cut leaves incomplete is dropped from it, never from the digest)."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    keyed = df.select(*text_key(F.col(text_col)), F.col(id_col).alias("id"), raw.alias("text"))
    spans = repeated_ranges(keyed, width)
    if with_text:
        own, names = apart(df)
        copies = keyed.groupBy("k1", "k2").agg(F.count("*").alias("__n"))
        told = copies.join(spans.withColumnRenamed("spans", "__spans"), ["k1", "k2"], "left").filter("__n > 1 or __spans is not null")
        text = names[text_col]
        wide = own.withColumns({f"__{k}": c for k, c in zip(("k1", "k2"), text_key(F.col(text)), strict=True)})
        told = told.withColumnsRenamed({"k1": "__k1", "k2": "__k2"}).withColumn("__spans", F.when(F.col("__n") == 1, F.col("__spans")))
        schema = StructType([*own.schema.fields, *(StructField(c, LongType()) for c in ADDED[:3]), *(StructField(c, StringType()) for c in ADDED[3:])])
        rows = wide.join(told, ["__k1", "__k2"], "left").select(*own.columns, "__n", "__spans")
        return restored(rows.mapInArrow(_rewriter(width, text), schema), names, ADDED)
    slim = stored(df.select(id_col, *text_key(F.col(text_col)), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw.cast("binary"), 256).alias("__all")))
    copies = slim.groupBy("k1", "k2").agg(F.count("*").alias("n"))
    todo = spans.join(copies.filter("n = 1").select("k1", "k2"), ["k1", "k2"])
    cut = keyed.filter(F.octet_length("text") >= width).join(todo, ["k1", "k2"]).select("k1", "k2", "text", "spans")
    done = cut.mapInArrow(_cutter(width), "k1 long, k2 long, n_removed long, n_spans long, kept_sha256 string")
    rows = slim.join(copies, ["k1", "k2"]).join(done, ["k1", "k2"], "left")
    gone = (F.col("n") > 1) & (F.col("n_bytes") >= width)
    return rows.select(
        id_col,
        "n_bytes",
        F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(gone, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept_sha256", "__all")).alias("kept_sha256"),
    )
