"""Byte-level BPE with a hierarchical-bitmap rank queue.

The bytes of many pre-tokens form one linked list, a separator between them. Every adjacent pair whose join has a rank
puts its left position into the bucket of that rank; a two-level bitmap over the ranks gives the lowest non-empty bucket
by find-first-set. Merging takes the positions of a bucket in ascending order, skips entries that have gone stale (the
left part is gone or no longer joins to this rank), relinks the list and enters the two new pairs. Pre-tokens do not
touch each other, so the lowest rank of all is the lowest of each pre-token that holds it, and one queue serves a whole
block of them. A pre-token of n bytes takes O(n log n) (the sorting of buckets), where scanning all pairs would take
n^2.

Texts are cut into units: a text each of whose spaces stands between characters that are not white space falls apart at
each space, as no match of the pattern crosses one; every unit is matched, merged once and remembered (bounded). Other texts are
matched whole.

Cases: null and empty texts have no ids; whole texts are encoded; ranks need not cover all pairs but must hold all 256
bytes; repeated rows and extra columns make no difference.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Units and pre-tokens that a worker remembers.
CACHE_UNITS, CACHE_TOKENS = 600_000, 600_000
LONGEST_CACHED = 64
#: Pre-tokens in one linked list: enough to share the queue, few enough to stay in a core's cache.
TOGETHER = 2000
#: Characters of texts whose new pre-tokens are gathered before they are merged, about.
BLOCK_CHARS = 6_000_000
SHIFT = 8  # bits of a rank below a bitmap word
MASK = (1 << SHIFT) - 1


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class RankQueue:
    """Buckets of positions by rank, and a two-level bitmap of the buckets that hold any."""

    __slots__ = ("buckets", "top", "low")

    def __init__(self, ranks: int) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.top, self.low = 0, [0] * ((ranks >> SHIFT) + 1)

    def fill(self, rank: int, positions: list[int]) -> None:
        self.buckets[rank] = positions
        hi = rank >> SHIFT
        self.low[hi] |= 1 << (rank & MASK)
        self.top |= 1 << hi

    def push(self, rank: int, pos: int) -> None:
        b = self.buckets.get(rank)
        if b is None:
            self.fill(rank, [pos])
        else:
            b.append(pos)

    def pop(self) -> tuple[int, list[int]]:
        """The lowest rank with entries and its bucket in ascending order, by find-first-set; the bucket leaves the queue."""
        t = self.top
        hi = (t & -t).bit_length() - 1
        w = self.low[hi]
        bit = w & -w
        rank = hi << SHIFT | bit.bit_length() - 1
        w ^= bit
        self.low[hi] = w
        if not w:
            self.top = t & (t - 1)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Merger:
    """Merges blocks of pre-tokens by the ranks; an id is the rank of its bytes."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks, self.most = ranks, max(ranks.values())
        self.shift = (self.most + 2).bit_length()
        #: Rank of two neighbours, by their ids.
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    self.pairs[a << self.shift | b] = rank
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.byte_pairs = np.full((256, 256), -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.byte_pairs[token[0], token[1]] = rank

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each pre-token: the pair of the lowest rank is joined first, of equal ones the leftmost."""
        data = np.frombuffer(b"\0" + b"\0".join(pieces) + b"\0", np.uint8)
        ends = np.cumsum([len(p) + 1 for p in pieces])
        gaps = np.concatenate([[0], ends])
        ids = self.byte_ids[data]
        ids[gaps] = self.most + 1  # joins with nothing
        first = np.full(len(data), -1, np.int64)
        first[:-1] = self.byte_pairs[data[:-1], data[1:]]
        first[gaps] = -1
        first[gaps[1:] - 1] = -1

        queue = RankQueue(self.most)
        at = np.flatnonzero(first >= 0)
        at = at[np.argsort(first[at], kind="stable")]
        found, where = np.unique(first[at], return_index=True)
        for rank, positions in zip(found.tolist(), np.split(at, where[1:])):
            queue.fill(rank, positions.tolist())

        sym, rank_at, shift = ids.tolist(), first.tolist(), self.shift
        nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        get, push = self.pairs.get, queue.push
        while queue.top:
            rank, bucket = queue.pop()
            left = rank << shift
            for nth, i in enumerate(bucket, 1):
                if rank_at[i] != rank:
                    continue  # stale
                j = nxt[i]
                k = nxt[j]
                sym[i], sym[j], rank_at[j] = rank, -1, -1
                nxt[i], prv[k] = k, i
                rank_at[i] = after = get(left | sym[k], -1)
                if after >= 0:
                    push(after, i)
                h = prv[i]
                rank_at[h] = before = get(sym[h] << shift | rank, -1)
                if before >= 0:
                    push(before, h)
                if 0 <= after < rank or 0 <= before < rank:  # a lower rank came up: it goes first
                    for p in bucket[nth:]:
                        push(rank, p)
                    break
        return [[x for x in sym[a + 1 : b] if x >= 0] for a, b in zip(gaps.tolist(), ends.tolist())]


_SPACES = re.compile(r"\s | \s|^ | $")
#: White space but space and line feed; most texts hold none of it.
_RARE = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def _falls_apart(text: str) -> bool:
    """Whether each space of a text stands between two characters that are not white space; tried by plain searches first."""
    if "  " in text or text[:1] in ("", " ") or text[-1] == " ":
        return False
    if "\n" in text and (" \n" in text or "\n " in text):
        return False
    return not (any(c in text for c in _RARE) and _SPACES.search(text))


class Codec:
    """Encodes whole texts to ids and back. What a unit or pre-token gives is kept as its decimal ids, joined by spaces,
    and as the bytes that these ids decode to; both of a text are those of its parts one behind the other."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.merger, self.find = Merger(ranks), regex.compile(pattern).findall
        self.decimal = {r: str(r) for r in ranks.values()}
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.units: tuple[dict[str, str], dict[str, bytes]] = ({}, {})
        self.tokens: tuple[dict[str, str], dict[str, bytes]] = ({}, {})

    def _learn(self, tokens: set[str]) -> None:
        shown, back = self.tokens
        dec, raw, ranks = self.decimal.__getitem__, self.bytes_of.__getitem__, self.merger.ranks
        new, pieces = [], []
        for t in tokens.difference(shown):
            piece = t.encode("utf-8", "surrogatepass")
            rank = ranks.get(piece)
            if rank is None:
                new.append(t)
                pieces.append(piece)
            else:  # a pre-token that has a rank itself is one id
                shown[t], back[t] = dec(rank), raw(rank)
        for at in range(0, len(new), TOGETHER):
            for t, ids in zip(new[at : at + TOGETHER], self.merger.merge(pieces[at : at + TOGETHER])):
                shown[t], back[t] = " ".join(map(dec, ids)), b"".join(map(raw, ids))

    def round_trip_block(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        for cache, most in ((self.units, CACHE_UNITS), (self.tokens, CACHE_TOKENS)):
            if len(cache[0]) > most:
                cache[0].clear()
                cache[1].clear()
        shown, back = self.tokens
        unit_shown, unit_back = self.units
        cut: list[tuple[list[str], list[str]]] = []  # pre-tokens, then units that a space precedes
        need: set[str] = set()
        fresh: set[str] = set()
        for text in texts:
            first, *rest = text.split(" ") if _falls_apart(text) else [text]
            found = self.find(first)
            need.update(found)
            fresh.update(rest)
            cut.append((found, rest))
        fresh.difference_update(unit_shown)
        matched = {u: self.find(" " + u) for u in fresh}
        need.update(chain.from_iterable(matched.values()))
        self._learn(need)
        for u, found in matched.items():
            if len(found) == 1:
                unit_shown[u], unit_back[u] = shown[found[0]], back[found[0]]
            else:
                unit_shown[u], unit_back[u] = " ".join([shown[t] for t in found]), b"".join([back[t] for t in found])
        for found, rest in cut:
            ids = " ".join(chain(map(shown.__getitem__, found), map(unit_shown.__getitem__, rest)))
            yield ids, b"".join(chain(map(back.__getitem__, found), map(unit_back.__getitem__, rest)))
        for parts, caches in ((fresh, self.units), (need, self.tokens)):
            for x in [x for x in parts if len(x) > LONGEST_CACHED]:
                for cache in caches:
                    cache.pop(x, None)

    def round_trip(self, texts: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Decimal ids joined by spaces, and the bytes that they decode to, of each text."""
        block, size = [], 0
        for t in texts:
            block.append(t)
            size += len(t)
            if size >= BLOCK_CHARS:
                yield from self.round_trip_block(block)
                block, size = [], 0
        yield from self.round_trip_block(block)

    def encode(self, text: str) -> list[int]:
        return list(map(int, next(self.round_trip([text]))[0].split()))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(load_ranks(path), pattern)
    return _CODECS[path, pattern]


def round_trip(docs: DataFrame, path: str, pattern: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, if kept)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for pdf in batches:
            rows = []
            for ids, back in c.round_trip(t or "" for t in pdf["text"]):
                row = (ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back).hexdigest())
                rows.append((*row, list(map(int, ids.split()))) if keep_ids else row)
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if keep_ids else [])])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy())
            yield out

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return src.mapInPandas(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as p

    return round_trip(table(spark, sf_dir, "documents"), p.path("byte_bpe_50k.tiktoken"), p.PATTERN)
