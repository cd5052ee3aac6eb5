"""N-gram Jaccard self-join of documents by a prefix tree.

Sets of word n-grams (64-bit hashes), their members in one order for all (the most frequent first, so that alike sets share
long beginnings), are stored in a compressed trie. A probe walks the trie level by level, adds the overlap of an edge
once for all sets below it, and prunes a subtree when its overlap so far plus what can still match (the shorter of both
remainders) misses the least overlap that any set below needs. So far the method; around it:

- Equal sets are one class (128-bit fingerprint of the set), and one document of each class goes on.
- Blocks for the tries come from exact signatures, not from frequent n-grams. Sets with Jaccard >= t and sizes up to
  s differ in at most d = (1-t)/(1+t)*2s members, so if members are dealt by hash into d+1 parts, one part
  agrees as a whole. Each document emits one signature for each part (0.2 n of them at 0.9, for its own band of
  sizes and the next one if a partner can be there). An empty part, which would agree with too many, is replaced by
  its neighbour part with up to one member left out; by the same counting no pair is lost.
- Signatures travel in packed arrays, one row for each bucket of a task. With `sketched` (the default), a bucket names
  the members of each shared signature, and these meet again with their parity sketches: each member flips one of about n
  bits, so the bits in which two sketches differ never exceed the symmetric difference, and pairs that differ in too many
  are no candidates. It prunes (variants of a template that are all just too different fall apart), and loses no pair. Of
  a signature with over MANY members all are candidates of one another, as a star, without any comparison.
- Without `sketched`, a signature that several classes of a task have is settled there: its classes are linked to the
  smallest of them, and only that one goes on. A bucket sorts its signatures and links equal ones likewise.
- The components of these candidate links are blocks, and every block's sets travel to tries.
- Within a block of at most BLOCK sets a union-find keeps components; documents outside the largest one are probed, the
  most central first, until all that were not probed are in the one that is the largest then, so every link has a probed
  end or both ends in it. A family of copies with edits around one original ends after few probes.
- A larger block is dealt to shards of about BLOCK sets, one trie and task each. Its sets are first compared with a few
  of them (HUBS); those that these don't join with the largest component are the probes, and each probe visits every
  shard of its block. Again every link has a probed end or both ends in one component.

No pair with enough similarity is missed; two unequal n-grams share a hash with odds of 2**-64 a pair.

Words are [^\\x20\\x09-\\x0D]+ after lower-casing A-Z. With fewer words than n the whole sequence is the one
n-gram; a null or wordless text has an empty set and links with nothing. Ids may have any type with an order. A null id
can't name a class, so such a row links with nothing and its class and component are null. Rows that repeat an id are the
same vertex, with the links of all their texts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import pieces, stored, utf8
from .components import connected_components
from .textscan import NOT_SPACE, Words, mix

#: Of a band's sizes; about the fewest signatures for similarities of 0.8 and 0.9.
RATIO = 1.4


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The ascending distinct n-gram hashes of each text."""
    words = Words(*utf8(texts), NOT_SPACE)
    h, first = words.hash, words.first.tolist()
    whole = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            whole[: len(h) - k] += mix(h[k:] + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1)))
        whole = mix(whole)
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n:
                out.append(np.unique(whole[a : b - n + 1]))
            elif b > a:
                out.append(mix(np.array([b - a], np.uint64) + np.sum(mix(h[a:b] + np.arange(1, b - a + 1, dtype=np.uint64)))))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


class Bands:
    """Bands of set sizes, and for each the number of parts that proves a similarity of percent / 100."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        while self.low[-1] < 1 << 40:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * RATIO)))
        self.edges = np.array(self.low, np.int64)

    def of(self, n: int) -> range:
        largest = n * 100 // self.percent if self.percent else 1 << 40
        return range(int(np.searchsorted(self.edges, n, "right")) - 1, int(np.searchsorted(self.edges, largest, "right")))

    def parts(self, band: int) -> int:
        most = 2 * (int(self.edges[band + 1]) - 1)
        return (100 - self.percent) * most // (100 + self.percent) + 1


def signatures(members: np.ndarray, bands: Bands) -> np.ndarray:
    out = []
    spread = mix(members ^ np.uint64(0xA5A5A5A55A5A5A5A))
    value = mix(members + np.uint64(0x632BE59BD9B4E019))
    for band in bands.of(len(members)):
        k = bands.parts(band)
        if k == 1:  # such small sets are similar only if equal, and equal sets are one class already
            continue
        part = (spread % np.uint64(k)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[order])))
        begin = np.searchsorted(part[order], np.arange(k + 1))
        total = sums[begin[1:]] - sums[begin[:-1]]
        salt = mix(np.arange(k, dtype=np.uint64) + np.uint64(band << 44))
        empty = np.flatnonzero(begin[1:] == begin[:-1])
        out.append(mix(total + salt)[begin[1:] > begin[:-1]])
        for i in empty.tolist():
            j = (i + 1) % k
            left_out = np.concatenate((np.zeros(1, np.uint64), value[order[begin[j] : begin[j + 1]]]))
            out.append(mix(total[j] - left_out + mix(salt[i : i + 1] + np.uint64(7))))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class Trie:
    """A compressed prefix tree of sets, in arrays; members are named by their place in the order (the most frequent is 0),
    and rows of the tree are in lexicographic order."""

    def __init__(self, sets: list[np.ndarray]):
        self.members, counts = np.unique(np.concatenate(sets), return_counts=True)
        self.place = np.empty(len(counts), np.int64)
        self.place[np.argsort(-counts, kind="stable")] = np.arange(len(counts))
        local = [np.sort(self.place[np.searchsorted(self.members, s)]) for s in sets]
        keys = [x.astype(">u4").tobytes() for x in local]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        rows = [local[k] for k in self.order]
        self.rows, self.flat = rows, np.concatenate(rows)
        self.offset = np.concatenate(([0], np.cumsum([len(r) for r in rows])))
        depth, parent, row, end = [0], [-1], [0], [-1]
        stack = [0]
        for r, seq in enumerate(rows):
            common = 0
            if r:
                m = min(len(rows[r - 1]), len(seq))
                differ = np.flatnonzero(rows[r - 1][:m] != seq[:m])
                common = int(differ[0]) if len(differ) else m
            last = -1
            while depth[stack[-1]] > common:
                last = stack.pop()
            if depth[stack[-1]] < common:
                depth.append(common), parent.append(stack[-1]), row.append(row[last]), end.append(-1)
                parent[last] = len(depth) - 1
                stack.append(len(depth) - 1)
            depth.append(len(seq)), parent.append(stack[-1]), row.append(r), end.append(r)
            stack.append(len(depth) - 1)
        self.depth, self.parent, self.end = np.array(depth), np.array(parent), np.array(end)
        above = self.depth[np.maximum(self.parent, 0)]
        self.begin, self.stop = self.offset[row] + above, self.offset[row] + self.depth
        self.longest, self.shortest = np.zeros(len(depth), np.int64), np.full(len(depth), 1 << 60)
        level = np.zeros(len(depth), np.int64)
        for v in np.lexsort((np.arange(len(depth)), self.depth)).tolist():  # a parent is never deeper; equal depth: made earlier
            level[v] = 0 if parent[v] < 0 else level[parent[v]] + 1
        for v in np.argsort(-level, kind="stable").tolist():
            if end[v] >= 0:
                self.longest[v], self.shortest[v] = max(self.longest[v], depth[v]), min(self.shortest[v], depth[v])
            if parent[v] >= 0:
                p = parent[v]
                self.longest[p], self.shortest[p] = max(self.longest[p], self.longest[v]), min(self.shortest[p], self.shortest[v])
        self.children = np.argsort(self.parent, kind="stable")[1:]
        self.child_at = np.searchsorted(self.parent[self.children], np.arange(len(depth) + 1))

    def below(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Children of nodes, and which of the nodes each belongs to."""
        n = self.child_at[nodes + 1] - self.child_at[nodes]
        which = np.repeat(np.arange(len(nodes)), n)
        return self.children[self.child_at[nodes][which] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)], which

    def similar(self, r: int, percent: int) -> np.ndarray:
        """Rows whose sets have Jaccard similarity >= percent / 100 with row r (itself included)."""
        return self._walk(self.rows[r], len(self.rows[r]), percent)

    def near(self, members: np.ndarray, percent: int) -> np.ndarray:
        """As similar(), for any set."""
        at = np.minimum(np.searchsorted(self.members, members), len(self.members) - 1)
        return self._walk(np.sort(self.place[at[self.members[at] == members]]), len(members), percent)

    def _walk(self, own: np.ndarray, n: int, percent: int) -> np.ndarray:
        """own: those of n members that the tree knows, in its order."""
        mask = np.zeros(len(self.members) + 1, bool)
        mask[own] = True
        found = []
        node, which = self.below(np.zeros(1, np.int64))
        overlap, last = np.zeros(1, np.int64), np.full(1, -1)
        while len(node):
            begin, size = self.begin[node], self.stop[node] - self.begin[node]
            which_token = np.repeat(np.arange(len(node)), size)
            hit = mask[self.flat[begin[which_token] + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]]
            overlap = overlap[which] + np.bincount(which_token[hit], minlength=len(node))
            last = np.where(size > 0, self.flat[np.maximum(self.stop[node] - 1, 0)], last[which])
            remaining = np.minimum(len(own) - np.searchsorted(own, last, "right"), self.longest[node] - self.depth[node])
            other = np.maximum(self.shortest[node], -(-percent * n // 100))
            alive = (100 * self.longest[node] >= percent * n) & (percent * self.shortest[node] <= 100 * n)
            alive &= (100 + percent) * (overlap + remaining) >= percent * (n + other)
            row = self.end[node]
            ends = alive & (row >= 0)
            ends[ends] = (100 + percent) * overlap[ends] >= percent * (n + self.depth[node[ends]])
            found.append(row[ends])
            node, overlap, last = node[alive], overlap[alive], last[alive]
            node, which = self.below(node)
        return np.concatenate(found) if found else np.zeros(0, np.int64)


def block_components(ids: list, sets: list[np.ndarray], percent: int) -> list:
    """For each id the smallest id of its component of links within the block."""
    trie = Trie(sets)
    vertex = sorted(set(ids))
    place = {x: k for k, x in enumerate(vertex)}
    of = np.array([place[x] for x in ids])[trie.order]
    label = np.arange(len(vertex))
    held = [[k] for k in range(len(vertex))]
    frequency = np.bincount(trie.flat, minlength=len(trie.members))
    central = np.add.reduceat(frequency[trie.flat], trie.offset[:-1]) / np.maximum(np.diff(trie.offset), 1)
    waiting, left, largest = np.argsort(-central, kind="stable").tolist()[::-1], [], 0
    while waiting:
        r = waiting.pop()
        if label[of[r]] == largest:
            left.append(r)
            continue
        kinds = np.unique(label[of[trie.similar(r, percent)]]).tolist()
        into = max(kinds, key=lambda k: len(held[k]))
        for k in kinds:
            if k != into:
                label[held[k]] = into
                held[into] += held[k]
                held[k] = []
        if largest in kinds:
            largest = into
        elif len(held[into]) > len(held[largest]):  # what the former largest spared is to be probed after all
            waiting += left
            largest, left = into, []
    least = [min(h, default=None) for h in held]
    return [vertex[least[label[place[x]]]] for x in ids]


def linked(signs: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each signature with its smallest id, and a link (id, smallest id) for every other id that has it."""
    order = np.lexsort((ids, signs))
    signs, ids = signs[order], ids[order]
    first = np.concatenate((np.ones(min(1, len(signs)), bool), signs[1:] != signs[:-1]))
    hub = ids[np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))]
    other = ids != hub
    edges = np.unique(np.stack((ids[other], hub[other]), axis=1), axis=0)
    return signs[first], ids[first], edges[:, 0], edges[:, 1]


def parity_sketch(members: np.ndarray) -> bytes:
    """A power of two of bits, at least as many as members; each member flips one."""
    bits = 1 << max(6, (len(members) - 1).bit_length())
    at = (mix(members ^ np.uint64(0x3C79AC492BA7B653)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) % 2 == 1, bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words of one width, the smallest; the wider are folded onto it, which keeps parities."""
    width = min(map(len, sketches))
    rows = np.empty((len(sketches), width // 8), np.uint64)
    for k, s in enumerate(sketches):
        rows[k] = np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, width // 8), axis=0)
    return rows


def compatible(ids: np.ndarray, sizes: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Links that connect all members of a group that may be similar, as far as sizes and sketches tell."""
    words, label, out = folded(sketches), np.arange(len(ids)), []
    for k in range(len(ids) - 1):
        other = np.flatnonzero(label[k + 1 :] != label[k]) + k + 1
        if not len(other):
            continue
        differ = np.bitwise_count(words[other] ^ words[k]).sum(axis=1)
        near = (100 + percent) * differ.astype(np.int64) <= (100 - percent) * (sizes[other] + sizes[k])
        near &= (percent * np.maximum(sizes[other], sizes[k]) <= 100 * np.minimum(sizes[other], sizes[k]))
        for j in other[near].tolist():
            if label[j] != label[k]:
                out.append((max(ids[j], ids[k]), min(ids[j], ids[k])))
                label[label == label[j]] = label[k]
    return out


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _packed(whole=True) in order of bucket -> (class, signature) of every signature that several classes have."""

    def settle(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        signs, ids = (np.concatenate([np.frombuffer(h[k], np.int64) for h in held]) for k in (0, 1))
        order = np.argsort(signs, kind="stable")
        signs, ids = signs[order], ids[order]
        edge = signs[1:] != signs[:-1]
        shared = ~(np.concatenate(([True], edge)) & np.concatenate((edge, [True])))
        return pa.RecordBatch.from_arrays([pa.array(ids[shared]), pa.array(signs[shared])], ["f1", "sign"])

    now, held = None, []
    for batch in batches:
        for bucket, signs, ids, _ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != now and held:
                yield settle(held)
                held = []
            now = bucket
            held.append((signs, ids))
    if held:
        yield settle(held)


def _pruned(percent: int):  # noqa: ANN202
    """(sign, class, n_shingles, sketch) in order of sign -> candidate links (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, ...]] = set()
        edges: set[tuple[int, int]] = set()
        hub: int | None = None

        def settle(rows: list[tuple]) -> None:
            rows = sorted({r[0]: r for r in rows}.values())
            key = tuple(r[0] for r in rows)
            if len(rows) > 1 and key not in seen:  # the same members under another signature
                seen.add(key)
                edges.update(compatible(np.array(key), np.array([r[1] for r in rows]), [r[2] for r in rows], percent))

        def flush() -> pa.RecordBatch:
            found = sorted(e for e in edges if e[0] != e[1])
            edges.clear()
            if len(seen) > 100_000:
                seen.clear()
            return pa.RecordBatch.from_arrays([pa.array([int(e[0]) for e in found], pa.int64()), pa.array([int(e[1]) for e in found], pa.int64())], ["a", "b"])

        now, rows = None, []
        for batch in batches:
            for sign, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sign != now:
                    if rows:
                        settle(rows)
                    rows, hub = [], None
                now = sign
                if hub is not None:
                    edges.add((max(hub, row[0]), min(hub, row[0])))
                    continue
                rows.append(tuple(row))
                if len(rows) >= MANY:
                    hub = rows[0][0]
                    edges.update((max(hub, r[0]), min(hub, r[0])) for r in rows[1:])
                    rows = []
            yield flush()
        if rows:
            settle(rows)
            yield flush()

    return run


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set. The first names its class in signatures and candidate links."""
    with np.errstate(over="ignore"):
        one = np.array([np.sum(mix(s)) for s in sets], np.uint64)
        two = np.array([np.sum(mix(s ^ np.uint64(0xC3C3C3C33C3C3C3C))) for s in sets], np.uint64)
    return _signed(one), _signed(two)


#: Members of a signature that are compared with one another; of more, all are candidates.
MANY = 1 << 13
#: Sets of a block that one task holds, and sets that all those of a larger block are compared with first.
BLOCK, HUBS = 1 << 13, 4
#: Signatures that a task gathers before it deals them to buckets.
GATHERED = 1 << 20


def _packed(n: int, bands: Bands, buckets: int, whole: bool):  # noqa: ANN202
    """Texts -> (bucket, signs, classes) of a bucket, or with null signs the links found in the task: (bucket, null, classes, hubs).

    whole: every class of a shared signature goes on, none is linked here."""

    def dealt(signs: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        a = b = np.zeros(0, np.int64)
        if whole:
            signs, ids = (np.unique(np.stack((signs, ids), axis=1), axis=0).T if len(signs) else (signs, ids))
        else:
            signs, ids, a, b = linked(signs, ids)
        bucket = (mix(np.ascontiguousarray(signs).view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(buckets + 1))
        full = np.flatnonzero(at[1:] > at[:-1]).tolist()
        rows = [(k, signs[p].tobytes(), ids[p].tobytes(), None) for k in full for p in (order[at[k] : at[k + 1]],)]
        if len(a):
            rows.append((int(a[0]) % buckets, None, a.tobytes(), b.tobytes()))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], ["bucket", "signs", "ids", "hubs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signs, ids, size = [], [], 0
        for batch in batches:
            for part in pieces(batch, "text"):
                sets = shingle_sets(part.column(0), n)
                found = [_signed(signatures(s, bands)) for s in sets]
                signs += found
                ids.append(np.repeat(fingerprints(sets)[0], [len(f) for f in found]))
                size += len(ids[-1])
                if size >= GATHERED:
                    yield dealt(np.concatenate(signs), np.concatenate(ids))
                    signs, ids, size = [], [], 0
        if size:
            yield dealt(np.concatenate(signs), np.concatenate(ids))

    return run


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _packed() in order of bucket -> links (a, b)."""

    def links(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def settle(held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        found = linked(np.concatenate([np.frombuffer(s, np.int64) for s, _ in held]), np.concatenate([np.frombuffer(i, np.int64) for _, i in held]))
        return links(found[2], found[3])

    now, held = None, []
    for batch in batches:
        for bucket, signs, ids, hubs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if signs is None:
                yield links(np.frombuffer(ids, np.int64), np.frombuffer(hubs, np.int64))
                continue
            if bucket != now and held:
                yield settle(held)
                held = []
            now = bucket
            held.append((signs, ids))
    if held:
        yield settle(held)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _by_key(keys: int, settle):  # noqa: ANN001, ANN202
    """Batches in order of their first `keys` columns -> what settle() yields for the rows of each key (an iterator it may stop early)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for _, group in itertools.groupby(rows, key=lambda r: r[:keys]):
            yield from settle(group)

    return run


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def links_of_blocks(blocked: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect what is connected, of blocked (component, f1, members). sizes: component, sets."""
    read = lambda m: np.frombuffer(m, np.uint64)

    def whole(group: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held = {f1: read(m) for _, f1, m in group}
        if len(held) > 1:
            found = block_components(list(held), list(held.values()), percent)
            yield _links([(a, b) for a, b in zip(held, found, strict=True) if a != b])

    small = blocked.join(sizes.filter(F.col("sets") <= BLOCK).select("component"), "component", "left_semi")
    links = small.repartition("component").sortWithinPartitions("component", "f1").mapInArrow(_by_key(1, whole), "a long, b long")
    large = sizes.filter(F.col("sets") > BLOCK)
    if large.isEmpty():
        return links

    # every set of a large block against a few of them
    held = stored(blocked.join(large, "component").dropDuplicates(["component", "f1"]))
    drawn = held.groupBy("component").agg(*[F.min_by(F.struct("f1", "members"), F.xxhash64(F.lit(k), "f1")).alias(f"h{k}") for k in range(HUBS)])

    def hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for f1, members, *some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = read(members)
                out += [(f1, h["f1"]) for h in some if h["f1"] != f1 and _similar(own, read(h["members"]), percent)]
            yield _links(out)

    near = stored(held.join(stored(drawn), "component").select("f1", "members", *[f"h{k}" for k in range(HUBS)]).mapInArrow(hubs, "a long, b long"))
    label = connected_components(near).select(F.col("node").alias("f1"), F.col("component").alias("label"))
    told = stored(held.select("component", "f1").join(label, "f1", "left").withColumn("label", F.coalesce("label", "f1")))
    largest = told.groupBy("component", "label").agg(F.count("*").alias("n")).groupBy("component").agg(F.max_by("label", F.struct("n", "label")).alias("main"))
    probes = told.join(largest, "component").filter("label <> main").select("f1")

    # the others against every shard of their block
    shards = F.ceil(F.col("sets") / BLOCK).cast("long")
    natives = held.select("component", F.pmod(F.xxhash64("f1"), shards).alias("shard"), F.lit(False).alias("probe"), "f1", "members")
    visits = held.join(probes, "f1", "left_semi").select("component", F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)).alias("shard"), F.lit(True).alias("probe"), "f1", "members")

    def shard(group: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        trie, names, out = None, [], []
        for _, _, probe, f1, members in group:
            if not probe:
                own[f1] = read(members)
                continue
            if trie is None and own:
                trie = Trie(list(own.values()))
                names = np.array(list(own))[trie.order]
            if trie is not None:
                out += [(f1, other) for other in names[trie.near(read(members), percent)].tolist() if other != f1]
            if len(out) > 100_000:
                yield _links(out)
                out = []
        yield _links(out)

    met = natives.union(visits).repartition("component", "shard").sortWithinPartitions("component", "shard", "probe", "f1").mapInArrow(_by_key(2, shard), "a long, b long")
    return links.union(near).union(met)


def ngram_join(df: DataFrame, id_col: str, text_col: str, n: int = 3, percent: int = 90, sketched: bool = True) -> DataFrame:
    """id, n_shingles, class_id (smallest id with an equal set) and component_id of every row."""
    bands, kind = Bands(percent), df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = shingle_sets(part.column(1), n)
                one, two = fingerprints(found)
                sketches = pa.array([parity_sketch(s) if sketched and len(s) else None for s in found], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in found], pa.int64()), pa.array(one), pa.array(two), sketches], ["id", "n_shingles", "f1", "f2", "sketch"]
                )

    scanned = stored(docs.mapInArrow(sets, f"id {kind}, n_shingles long, f1 long, f2 long, sketch binary"))
    named = scanned.filter("n_shingles > 0 and id is not null")
    classes = stored(named.groupBy("f1", "f2", "n_shingles").agg(F.min("id").alias("class_id"), F.min("sketch").alias("sketch")))
    buckets = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.filter("id is not null").select("text").mapInArrow(_packed(n, bands, buckets, sketched), "bucket int, signs binary, ids binary, hubs binary")
    packed = packed.repartition("bucket").sortWithinPartitions("bucket")
    if sketched:
        members = packed.mapInArrow(_grouped, "f1 long, sign long").join(classes.hint("merge"), "f1").select("sign", "f1", "n_shingles", "sketch")
        candidates = members.repartition("sign").sortWithinPartitions("sign").mapInArrow(_pruned(percent), "a long, b long")
    else:
        candidates = packed.mapInArrow(_matched, "a long, b long")
    blocks = stored(connected_components(candidates).join(classes.select(F.col("f1").alias("node"), F.col("class_id").alias("id")), "node").select("component", "id", F.col("node").alias("f1")))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                found = shingle_sets(part.column(2), n)
                own = np.flatnonzero(fingerprints(found)[0] == part.column(1).to_numpy())  # an id may have other texts too
                yield pa.RecordBatch.from_arrays([c.take(pa.array(own)) for c in part.columns[:2]] + [pa.array([found[k].tobytes() for k in own], pa.binary())], ["component", "f1", "members"])

    blocked = docs.join(blocks, "id").select("component", "f1", "text").mapInArrow(again, "component long, f1 long, members binary")
    links = links_of_blocks(blocked, stored(blocks.groupBy("component").agg(F.count("*").alias("sets"))), percent)

    # texts of one id are one vertex
    ids = stored(scanned.filter("id is not null").groupBy("id").agg(F.min(F.when(F.col("n_shingles") > 0, F.col("f1"))).alias("least"), F.max(F.when(F.col("n_shingles") > 0, F.col("f1"))).alias("most"), F.min("n_shingles").alias("fewest")).filter("least <> most or least is not null and fewest = 0"))
    same = named.join(ids.filter("least <> most"), "id").select(F.col("f1").alias("a"), F.col("least").alias("b"))
    found = connected_components(links.union(same)).join(classes.select(F.col("f1").alias("node"), "class_id"), "node")
    least = found.groupBy("component").agg(F.min("class_id").alias("component_id"))
    of = stored(found.join(least, "component").select(F.col("node").alias("f1"), "component_id"))
    told = stored(classes.drop("sketch").join(of, "f1", "left").select("f1", "f2", "n_shingles", "class_id", F.coalesce("component_id", "class_id").alias("component_id")))
    wordless = ids.filter("fewest = 0").select("id", F.col("least").alias("f1")).join(told.groupBy("f1").agg(F.min("component_id").alias("of_id")), "f1").select("id", "of_id")
    rows = scanned.drop("sketch").join(told, ["f1", "f2", "n_shingles"], "left").join(wordless, "id", "left")
    known = F.col("id").isNotNull()
    component = F.coalesce("component_id", F.when(F.col("n_shingles") == 0, F.col("of_id")), "id")
    return rows.select(F.col("id").alias(id_col), "n_shingles", F.when(known, F.coalesce("class_id", "id")).alias("class_id"), F.when(known, component).alias("component_id"))
