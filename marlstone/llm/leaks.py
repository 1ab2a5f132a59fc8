"""Evaluation passages inside training texts, by greedy string tiling.

Texts become word lists without case, punctuation, markup, number style,
invisible and look-alike characters. A document meets an item if they share
seeds: the item's telling words (names, numbers), those that few of all items
have. Documents and items meet in a join of their seeds; the hits are counted by
document and item, and only the pairs with enough of them are tiled:
Karp-Rabin hashes of falling length find common runs of words, the longest are
marked first and never overlap, so reordered passages count too; single words
changed, added or dropped between tiles are bridged. A sentence of the prompt
counts as held only as far as its telling words are there; an item has leaked if
the held words reach the threshold.

Items of the same words are one class while they are searched for. Rarity is
counted over all classes, so the result doesn't depend on how the items are
stored or split. The tasks over the documents hold a bitmap of the seeds of a
fixed size, nothing else of the items.

Defined results in odd cases
- null, empty and blank documents and prompts give no rows;
- a prompt without telling words is matched by its words alone;
- equal documents are all reported; equal items too, a repeated item row once;
- texts are processed whole, whatever their length;
- an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marlstone.llm.text import words
from marlstone.session import materialise


@dataclass(frozen=True)
class LeakRules:
    """share: of a prompt's words that makes a leak; telling: largest share of
    all items that have a telling word; few: as many items may have it in any
    case; seeds: telling words to share at least; tile: shortest run of words
    that is marked; bridge: words between two tiles that count as changed;
    backed: share of a stretch's telling words that must be there; bits: size
    of the seeds' bitmap (words of equal hash cost time, not results)."""

    share: float = 0.4
    telling: float = 0.02
    few: int = 6
    seeds: int = 2
    tile: int = 2
    bridge: int = 2
    backed: float = 0.5
    bits: int = 1 << 22


@dataclass
class Item:
    tokens: list[str]
    telling: frozenset[str]
    ends: list[int]  # sentence ends, as token positions


def prompt_words(prompt: str | None) -> tuple[list[str], list[int]]:
    """Words of a prompt and the ends of its sentences."""
    tokens, ends = [], []
    for sentence in re.split(r"(?<=[.?!])\s+", prompt or ""):
        tokens += words(sentence)
        ends.append(len(tokens))
    return tokens, ends


def tiles(a: list[int], b: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two integer lists: (start in a, start in b, length), longest first, without overlap.

    Karp-Rabin: runs of the search length s are hashed in a (short) and looked
    up while the hash rolls over b; matches of 2s or more raise s, marked
    matches lower it to ``least``.
    """
    mod, base = (1 << 61) - 1, 1_000_003
    used_a, used_b = bytearray(len(a)), bytearray(len(b))
    out = []
    s = max(least, min(len(a), 16))
    while True:
        power = pow(base, s - 1, mod)
        starts: dict[int, list[int]] = defaultdict(list)
        run = h = 0
        for i, x in enumerate(a):
            if used_a[i]:
                run = h = 0
                continue
            if run == s:
                h = (h - a[i - s] * power) % mod
                run -= 1
            h = (h * base + x) % mod
            run += 1
            if run == s:
                starts[h].append(i - s + 1)
        found: list[tuple[int, int, int]] = []
        longest = run = h = 0
        for j, x in enumerate(b):
            if used_b[j] or x < 0:
                run = h = 0
                continue
            if run == s:
                h = (h - b[j - s] * power) % mod
                run -= 1
            h = (h * base + x) % mod
            run += 1
            if run == s and h in starts:
                q = j - s + 1
                for p in starts[h]:
                    n = 0
                    while p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n] and not used_a[p + n] and not used_b[q + n]:
                        n += 1
                    if n >= s:
                        found.append((n, p, q))
                        longest = max(longest, n)
        if longest > 2 * s:
            s = longest
            continue
        for n, p, q in sorted(found, key=lambda x: (-x[0], x[1], x[2])):
            if not any(used_a[p : p + n]) and not any(used_b[q : q + n]):
                used_a[p : p + n] = used_b[q : q + n] = b"\x01" * n
                out.append((p, q, n))
        if s == least:
            return out
        s = max(least, s // 2 if s > 2 * least else s - 1)


def held_share(item: Item, doc: list[str], rules: LeakRules) -> float:
    """Share of the prompt's words that the document holds."""
    codes = {w: i for i, w in enumerate(dict.fromkeys(item.tokens))}
    a = [codes[w] for w in item.tokens]
    # the document's runs of the item's words; shorter ones than a tile can't be marked
    b: list[int] = []
    place: list[int] = []
    start = -1
    for k, w in enumerate([*doc, None]):
        if w in codes:
            start = k if start < 0 else start
        elif start >= 0:
            if k - start >= rules.tile:
                b += [codes[x] for x in doc[start:k]]
                b.append(-1)
                place += range(start, k + 1)
            start = -1
    marked = [False] * len(a)
    at: list[int] = [-1] * len(a)
    for p, q, n in tiles(a, b, rules.tile):
        for k in range(n):
            marked[p + k] = True
            at[p + k] = place[q + k]
    # lone telling words between or beside tiles, in their place
    last_p = -1
    for p in [i for i, m in enumerate(marked) if m]:
        if last_p >= 0 and 1 < p - last_p <= rules.bridge + 1 and 0 < at[p] - at[last_p] <= p - last_p + rules.bridge:
            window = doc[at[last_p] + 1 : at[p]]
            for k in range(last_p + 1, p):
                at[k] = -2 if item.tokens[k] not in window else -3  # changed or dropped; there
        last_p = p
    total = start = 0
    for end in item.ends:
        span = [k for k in range(start, end) if marked[k] or at[k] < -1]
        if span:
            stretch = range(span[0], span[-1] + 1)
            need = [k for k in stretch if item.tokens[k] in item.telling]
            there = sum(1 for k in need if marked[k] or at[k] == -3)
            if need and there >= rules.backed * len(need) and there:
                total += len(span)
        start = end
    return total / len(a)


# ---------------------------------------------------------------- items


def item_classes(items: DataFrame, rules: LeakRules) -> tuple[DataFrame, DataFrame]:
    """Members (cls, item_id) and classes (cls, tokens, ends, telling, need) of items with the same words.

    need: telling words a document must share to be looked at.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            each = [prompt_words(x) for x in pdf["prompt"]]
            yield pd.DataFrame({"item_id": pdf["item_id"], "tokens": [t for t, _ in each], "ends": [e for _, e in each]})

    rows = items.select("item_id", "prompt").where("prompt is not null").mapInPandas(cut, "item_id bigint, tokens array<string>, ends array<int>").where(F.size("tokens") > 0)
    rows = materialise(rows.withColumn("cls", F.md5(F.concat_ws(" ", F.concat_ws(" ", "tokens"), F.col("ends").cast("string")))))
    classes = rows.dropDuplicates(["cls"]).select("cls", "tokens", "ends")
    each = classes.select("cls", F.explode(F.array_distinct("tokens")).alias("word"))
    n = classes.count()
    rare = each.groupBy("word").agg(F.count(F.lit(1)).alias("df")).where((F.col("df") <= max(rules.few, rules.telling * n)) & (F.length("word") > 1))
    telling = each.join(rare, "word").groupBy("cls").agg(F.collect_set("word").alias("telling"))  # at most a prompt's words
    classes = classes.join(telling, "cls", "left")
    alone = F.col("telling").isNull()
    # without telling words: at least half of the share is marked, and no word counts for more than its places
    places = lambda w: F.size(F.filter("tokens", lambda x: x == w))
    most = F.array_max(F.transform(F.array_distinct("tokens"), places))
    bound = F.greatest(F.lit(rules.seeds), F.ceil(F.size("tokens") * (rules.share / 2) / most))
    need = F.when(alone, F.least(bound, F.size(F.array_distinct("tokens")))).otherwise(F.least(F.lit(rules.seeds), F.size("telling")))
    classes = classes.select("cls", "tokens", "ends", F.coalesce("telling", F.array_distinct("tokens")).alias("telling"), need.cast("int").alias("need"))
    return rows.select("cls", "item_id").distinct(), materialise(classes)


def seed_bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of the words' hashes: bits / 8 bytes, whatever the number of words."""
    at = seeds.select(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(bits)).cast("int").alias("b")).distinct().toPandas()["b"].to_numpy(np.int64)  # at most ``bits`` numbers
    flags = np.zeros(bits, bool)
    flags[at] = True
    return np.packbits(flags)


# ---------------------------------------------------------------- documents


def _met(docs: DataFrame, bitmap: np.ndarray, least: int, rules: LeakRules) -> DataFrame:
    """doc_id, mark, tokens, seeds of the documents with at least ``least`` words of the bitmap. mark tells repeated ids apart."""
    held = docs.sparkSession.sparkContext.broadcast(bitmap)
    bits = rules.bits

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        flags, known = np.unpackbits(held.value).view(bool), {}
        for pdf in batches:
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"]):
                if not text:
                    continue
                doc = words(text)
                seeds = []
                for w in set(doc):
                    hit = known.get(w)
                    if hit is None:
                        if len(known) > 500_000:
                            known.clear()
                        hit = known[w] = bool(flags[zlib.crc32(w.encode()) % bits])
                    if hit:
                        seeds.append(w)
                if len(seeds) >= least:
                    mark = zlib.crc32(text.encode("utf-8", "replace"))
                    out.append((doc_id, mark, doc, seeds))
            yield pd.DataFrame(out, columns=["doc_id", "mark", "tokens", "seeds"])

    return docs.select("doc_id", "text").where("text is not null").mapInPandas(run, "doc_id bigint, mark bigint, tokens array<string>, seeds array<string>")


def _tiled(pairs: DataFrame, rules: LeakRules) -> DataFrame:
    """doc_id, cls, share from rows of a document's tokens and the items it meets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, tokens, met in zip(pdf["doc_id"], pdf["tokens"], pdf["met"]):
                doc = list(tokens)
                for m in met:
                    share = held_share(Item(list(m["tokens"]), frozenset(m["telling"]), list(m["ends"])), doc, rules)
                    if share >= rules.share:
                        out.append((doc_id, m["cls"], share))
            yield pd.DataFrame(out, columns=["doc_id", "cls", "share"])

    return pairs.select("doc_id", "tokens", "met").mapInPandas(run, "doc_id bigint, cls string, share double")


def find_leaks(docs: DataFrame, items: DataFrame, rules: LeakRules = LeakRules()) -> DataFrame:
    """doc_id, item_id, share of every document that holds at least ``rules.share`` of an item's prompt."""
    members, classes = item_classes(items, rules)
    seeds = materialise(classes.select("cls", "need", F.explode("telling").alias("word")))  # a row an item and telling word
    least = classes.agg(F.min("need")).first()[0]
    if least is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, share double")
    met = materialise(_met(docs, seed_bitmap(seeds, rules.bits), least, rules))
    row = ["doc_id", "mark"]
    hits = met.select(*row, F.explode("seeds").alias("word")).distinct().join(seeds, "word")
    found = hits.groupBy(*row, "cls").agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("need")).where("n >= need")
    # a document gets the items it has met, at most all of them
    with_items = found.select(*row, "cls").join(classes, "cls").groupBy(*row).agg(F.collect_list(F.struct("cls", "tokens", "ends", "telling")).alias("met"))
    with_items = with_items.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "met")
    pairs = met.join(with_items, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))).select("doc_id", "tokens", "met")
    return _tiled(pairs, rules).join(members, "cls").select("doc_id", "item_id", "share")
