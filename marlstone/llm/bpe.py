"""Encoding of texts with a public byte-level BPE vocabulary.

Merging uses a rank queue under a hierarchical bitmap: a bucket per merge rank
holds the positions of a linked list of tokens, find-first-set over the bitmap's
three levels picks the lowest rank, and entries that a merge has outdated are
skipped when they come up. A pre-token of n bytes takes O(n log n), whatever
its length. Pre-tokens met before are looked up (bounded memory).

Defined results: null and empty texts have an empty list; strings that look
like special tokens are ordinary text; equal rows are encoded alike; an empty
table gives no rows.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

PUBLIC = "byte_bpe_50k.tiktoken"
CACHE_ENTRIES = 200_000
CACHE_BYTES = 64  # longer pre-tokens are rare and are merged each time

_loaded: dict[tuple[str, str], Encoder] = {}


class RankQueue:
    """Positions by rank; pop gives the lowest rank's leftmost position."""

    __slots__ = ("words", "mid", "top", "buckets")

    def __init__(self, ranks: int):
        n = (ranks + 63) >> 6
        self.words = [0] * n
        self.mid = [0] * ((n + 63) >> 6)
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, pos: int) -> None:
        b = self.buckets.get(rank)
        if b is None:
            self.buckets[rank] = [pos]
            w = rank >> 6
            self.words[w] |= 1 << (rank & 63)
            self.mid[w >> 6] |= 1 << (w & 63)
            self.top |= 1 << (w >> 6)
        else:
            heapq.heappush(b, pos)

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        m = (self.top & -self.top).bit_length() - 1
        w = (m << 6) | ((self.mid[m] & -self.mid[m]).bit_length() - 1)
        rank = (w << 6) | ((self.words[w] & -self.words[w]).bit_length() - 1)
        b = self.buckets[rank]
        pos = heapq.heappop(b)
        if not b:
            del self.buckets[rank]
            self.words[w] &= ~(1 << (rank & 63))
            if not self.words[w]:
                self.mid[w >> 6] &= ~(1 << (w & 63))
                if not self.mid[m]:
                    self.top &= ~(1 << m)
        return rank, pos


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern)
        self.size = max(ranks.values()) + 1
        self.cache: dict[str, tuple[int, ...]] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one pre-token."""
        ranks = self.ranks
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        end = list(range(1, n + 1))  # token at i is piece[i:end[i]]; end[i] == 0: merged away
        before = list(range(-1, n - 1))
        queue = RankQueue(self.size)
        pair = [-1] * n  # current rank of the pair that starts at i
        for i in range(n - 1):
            r = ranks.get(piece[i : i + 2], -1)
            if r >= 0:
                pair[i] = r
                queue.push(r, i)
        while (hit := queue.pop()) is not None:
            rank, i = hit
            if pair[i] != rank or not end[i]:
                continue  # outdated
            j = end[i]
            end[i] = end[j]
            end[j] = 0
            pair[j] = -1
            k = end[i]
            if k < n:
                before[k] = i
            r = ranks.get(piece[i : end[k]], -1) if k < n else -1
            pair[i] = r
            if r >= 0:
                queue.push(r, i)
            h = before[i]
            if h >= 0:
                r = ranks.get(piece[h : end[i]], -1)
                pair[h] = r
                if r >= 0:
                    queue.push(r, h)
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        cache = self.cache
        for word in self.split.findall(text):
            ids = cache.get(word)
            if ids is None:
                raw = word.encode("utf-8", "replace")
                ids = tuple(self.merge(raw))
                if len(raw) <= CACHE_BYTES:
                    if len(cache) >= CACHE_ENTRIES:
                        cache.clear()
                    cache[word] = ids
            out.extend(ids)
        return out


def load(path: str, pattern: str) -> Encoder:
    """Encoder of a .tiktoken file, once a worker process."""
    key = (path, pattern)
    if key not in _loaded:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _loaded[key] = Encoder(ranks, pattern)
    return _loaded[key]


def public_vocabulary(name: str = PUBLIC) -> tuple[str, str]:
    """Path and split pattern of an installed public vocabulary."""
    import public_tokenizers

    return name if "/" in name else public_tokenizers.path(name), public_tokenizers.PATTERN


def token_ids(text: Column, path: str = PUBLIC, pattern: str | None = None) -> Column:
    """array<int> of a text column: a Pandas UDF, no shuffle.

    path: a .tiktoken file that every executor can read, or the bare name of an
    installed public vocabulary, which each worker looks up for itself;
    pattern: of the pre-tokens, by default the public vocabularies'.
    """

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        where, split = path, pattern
        if "/" not in path or pattern is None:
            where, public = public_vocabulary(path)
            split = pattern or public
        enc = load(where, split)
        for s in batches:
            yield s.map(enc.encode, na_action=None)

    return encode(text)
