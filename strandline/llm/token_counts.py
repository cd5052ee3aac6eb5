"""Token counts of a byte-level BPE vocabulary by rank-synchronous array merging.

The distinct pre-tokens of a batch are held as one ragged numpy array of symbols. In each round every sequence
finds its own lowest-rank adjacent pair and merges all its occurrences (left to right where they overlap); a
sequence with no pair left in the merge table is finished, and the symbols that survive are its token count.
Counts of pre-tokens are remembered between batches of a task; the memory is cleared at a size, never the work.

Null texts are empty and have 0 tokens. Added tokens of the vocabulary file inside a text count as one each, as
the tokenizer library treats them by default. A text of any length is read in parts of LONG pre-tokens. Repeated rows
give repeated results; an empty table gives none.
"""

from __future__ import annotations

import itertools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import pieces

#: Fixed value: the split pattern of the public byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = np.int64(1 << 40)
#: Characters from which on a text's pre-tokens are counted so many at a time.
LONG = 2 << 20
#: Most bytes of a vocabulary file that is broadcast.
LARGEST = 256 << 20


def byte_letters() -> dict[str, int]:
    """The letter that the vocabulary file writes for each byte: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class RankMerger:
    """Counts tokens of pre-tokens, given a vocabulary file of the tokenizers library (its contents, or its path)."""

    def __init__(self, file: bytes | str):
        if isinstance(file, str):
            with open(file, "rb") as f:
                file = f.read()
        spec = json.loads(file)
        vocab, merges = spec["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        letters = byte_letters()
        self.of_byte = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.of_byte[byte] = vocab[letter]
        key = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made
        added = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.split = regex.compile(PATTERN)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.rank[at], NEVER)

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """The number of symbols that each (non-empty) pre-token ends with."""
        out = np.zeros(len(tokens), np.int64)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbol = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), sizes)
        while len(symbol):
            rank = np.full(len(symbol), NEVER)
            same = owner[1:] == owner[:-1]
            at = np.flatnonzero(same)
            rank[at] = self.ranks(symbol[at], symbol[at + 1])
            first = np.flatnonzero(np.concatenate(([True], ~same)))
            lowest = np.minimum.reduceat(rank, first)
            lengths = np.diff(np.append(first, len(symbol)))
            done = lowest == NEVER
            out[owner[first[done]]] = lengths[done]
            lowest = np.repeat(lowest, lengths)
            hit = (rank == lowest) & (lowest < NEVER)
            run = np.flatnonzero(hit)
            if len(run) > 1:  # of overlapping pairs every second one, from the left
                begins = np.concatenate(([True], np.diff(run) > 1))
                index = np.arange(len(run))
                hit[run[(index - np.maximum.accumulate(np.where(begins, index, 0))) % 2 == 1]] = False
            run = np.flatnonzero(hit)
            symbol[run] = self.made[rank[run]]
            keep = lowest < NEVER
            keep[run + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        return out


class Counter:
    def __init__(self, file: bytes | str, remembered: int = 1_000_000):
        self.merger, self.remembered = RankMerger(file), remembered
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of added tokens between them."""
        added = self.merger.added
        if added is None or not added.search(text):
            return self.merger.split.findall(text), 0
        parts = added.split(text)
        return [t for part in parts for t in self.merger.split.findall(part)], len(parts) - 1

    def learn(self, tokens: set[str]) -> None:
        """Counts the tokens that aren't remembered."""
        if len(self.known) > self.remembered:
            self.known = {}
        new = list(tokens.difference(self.known))
        for k in range(0, len(new), 200_000):
            part = new[k : k + 200_000]
            self.known.update(zip(part, self.merger.counts([t.encode("utf-8", "surrogatepass") for t in part]).tolist(), strict=True))

    def of_long(self, text: str) -> int:
        """As of(), with at most LONG pre-tokens of the text in memory."""
        added = self.merger.added
        cuts = [m.span() for m in added.finditer(text)] if added is not None else []
        total = len(cuts)
        for begin, end in zip([0, *[b for _, b in cuts]], [*[a for a, _ in cuts], len(text)], strict=True):
            # an added token ends a part, as splitting would: the pattern must not look beyond it
            found = (m[0] for m in self.merger.split.finditer(text if (begin, end) == (0, len(text)) else text[begin:end]))
            while tokens := list(itertools.islice(found, LONG)):
                self.learn(set(tokens))
                total += sum(map(self.known.__getitem__, tokens))
        return total

    def of(self, texts: list[str | None]) -> list[int]:
        if any(t and len(t) > LONG for t in texts):
            return [self.of_long(t) if t and len(t) > LONG else self.of([t])[0] for t in texts]
        held = [self.pre_tokens(t or "") for t in texts]
        self.learn({t for tokens, _ in held for t in tokens})
        get = self.known.__getitem__
        return [sum(map(get, tokens)) + special for tokens, special in held]


def token_counts(df: DataFrame, id_col: str, text_col: str, vocabulary: str, limit: int) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every whole text. vocabulary: path of the file on the
    driver, whose bytes are broadcast."""
    with open(vocabulary, "rb") as f:
        file = f.read(LARGEST + 1)
    if len(file) > LARGEST:
        raise ValueError(f"{vocabulary} has over {LARGEST} bytes")
    shared = df.sparkSession.sparkContext.broadcast(file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            n: list[int] = []
            for part in pieces(batch, "text", 2 << 20):
                n += counter.of(part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    slim = df.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))
    counted = slim.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
