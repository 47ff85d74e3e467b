"""Benchmark decontamination: edited copies of benchmark items inside documents.

An item is found where some window of a document's words is within
`1 - similarity` word edits (insert, delete, replace) of the item's length.
Candidates come from the CGK embedding with bit sampling: a random walk reads a
sequence symbol by symbol and moves on or stays by a random bit of the step and
the symbol, so that two sequences at a small edit distance soon read the same
symbols at the same steps again. A repetition starts the walk at an offset into
the item, samples a few of its steps and takes the symbols read there as a key;
documents walk from every word whose symbol can begin a key. Enough repetitions
with their own offsets, bits and steps reach the target recall; their offsets go
over more different words of an item than it may have edits. Items of fewer than
`LONG` words have too few places to start from. They are cut into one piece more
than they may have edits, so that some piece stands unchanged in every window to
be found, and walks that always move on read whole pieces as keys: of these items
none is missed. Every candidate window is then verified by the exact edit distance, so nothing is reported that
does not hold, and exact copies, which agree in all repetitions, are never missed.

Items are the stated query set: they are taken in blocks of bounded size, whose
index is broadcast, and each block is one pass over the documents without any
shuffle of text.

* words: A-Z lower-cased, ASCII that is neither letter nor digit separates.
* null or empty documents and items without words: no hits.
* items of fewer than `MIN_WORDS` words are hit only by documents with exactly these words.
* repeated rows and ids: hits are reported per (document id, item id), the best window once.
* an empty table of documents or of items: no hits. A very long document is searched whole by one task.
* null ids are kept as null; other columns are ignored. Where documents go, only the rows whose own text holds an item go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import NO_ID, batches, map_arrow

SIMILARITY, MIN_WORDS = 0.8, 5
#: Repetitions, steps of a walk, sampled steps of a key.
REPEATS, STEPS, SAMPLES = 48, 12, 4
#: Items of so many words are found by walks, shorter ones by their pieces.
LONG = 2 * STEPS
#: Greatest number of items, and of characters in them, in one broadcast block.
BLOCK_ITEMS, BLOCK_CHARS = 20_000, 20_000_000
SEED = 20
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))
_HITS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("edits", pa.int64())])


def split(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclass
class Walk:
    """One repetition, or the pieces of one length."""
    moves: np.ndarray      # [symbol]: a bit a step, move on or stay
    sampled: list[int]     # steps of a key; the first is 0
    first: np.ndarray      # [symbol]: begins a key
    prefixes: list[np.ndarray]  # sorted keys of each sampled step: place of the key before * base + symbol, below 2**63
    items: dict[int, list[tuple[int, int]]]  # place of the last key: (item, offset)


class Index:
    """Walks and words of a block of items."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], similarity: float = SIMILARITY, repeats: int = REPEATS, seed: int = SEED):
        each = [(i, split(t)) for i, t in items]
        self.similarity = similarity
        self.short: dict[tuple, list[int | None]] = {}
        for i, w in each:
            if 0 < len(w) < MIN_WORDS:
                self.short.setdefault(tuple(w), []).append(i)
        each = [(i, w) for i, w in each if len(w) >= MIN_WORDS]
        self.symbol: dict[bytes, int] = {}
        self.ids = [i for i, _ in each]
        self.words = [np.array([self.symbol.setdefault(x, len(self.symbol) + 1) for x in w], dtype=np.int64) for _, w in each]
        self.base = len(self.symbol) + 1
        self.flat = np.concatenate(self.words) if each else np.zeros(0, dtype=np.int64)
        self.starts = np.cumsum([0, *map(len, self.words)])
        n = np.bincount(self.flat, minlength=self.base)
        self.common = n > max(3, 0.002 * n.sum())  # words that say little about an item
        self.walks: list[Walk] = []
        rng = np.random.default_rng(seed)
        long = [k for k, w in enumerate(self.words) if len(w) >= LONG]
        for r in range(repeats if long else 0):
            share = (r + rng.random()) / repeats
            sampled = [0, *sorted(rng.choice(np.arange(1, STEPS), size=SAMPLES - 1, replace=False).tolist())]
            moves = rng.integers(0, 1 << STEPS, size=self.base, dtype=np.int16)
            self.walks.append(self._walk(moves, sampled, [(k, self._offset(self.words[k], share)) for k in long]))
        pieces: dict[int, list[tuple[int, int]]] = {}
        for k, w in enumerate(self.words):
            if len(w) < LONG:
                n = min(len(w), self._most(w) + 1)
                starts = [len(w) * i // n for i in range(n + 1)]
                for a, b in zip(starts, starts[1:]):
                    pieces.setdefault(min(STEPS, b - a), []).append((k, a))
        for steps, members in sorted(pieces.items()):
            self.walks.append(self._walk(np.full(self.base, (1 << STEPS) - 1, dtype=np.int16), list(range(steps)), members))

    def _most(self, w: np.ndarray) -> int:
        """The greatest number of edits of an item."""
        return math.floor((1 - self.similarity) * len(w) + 1e-9)

    def _walk(self, moves: np.ndarray, sampled: list[int], members: list[tuple[int, int]]) -> Walk:
        """The walks of `members` (item, offset)."""
        at = np.array([self.starts[k] + offset for k, offset in members], dtype=np.int64)
        key, prefixes = np.zeros(len(members), dtype=np.int64), []
        for step in range(sampled[-1] + 1):
            now = self.flat[at]
            if step == sampled[len(prefixes)]:
                known, key = np.unique(key * self.base + now, return_inverse=True)
                prefixes.append(known)
            at += moves[now] >> step & 1
        found: dict[int, list[tuple[int, int]]] = {}
        for k, member in zip(key.tolist(), members):
            found.setdefault(k, []).append(member)
        first = np.zeros(self.base, dtype=bool)
        first[prefixes[0]] = True
        return Walk(moves, sampled, first, prefixes, found)

    def _offset(self, w: np.ndarray, share: float) -> int:
        """Where the walk starts: at this share of the words that are not common, or of all if edits could meet each of those."""
        places = len(w) - STEPS + 1
        rare = np.flatnonzero(~self.common[w[:places]])
        return int(rare[int(share * len(rare))]) if len(rare) > self._most(w) else int(share * places)

    def candidates(self, text: np.ndarray) -> set[tuple[int, int, int]]:
        """(item, where it would begin, where a walk agreed) in `text`, symbols with STEPS zeros behind each document."""
        out: set[tuple[int, int, int]] = set()
        for walk in self.walks:
            start = np.flatnonzero(walk.first[text])
            at, key, done = start, np.zeros(len(start), dtype=np.int64), 0
            for step in range(walk.sampled[-1] + 1):
                now = text[at]
                if step == walk.sampled[done]:
                    key = key * self.base + now
                    known = walk.prefixes[done]
                    place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    keep = known[place] == key
                    start, at, key, now = start[keep], at[keep], place[keep], now[keep]
                    done += 1
                    if not len(start):
                        break
                at = at + (walk.moves[now] >> step & 1)
            for s, k in zip(start.tolist(), key.tolist()):
                out.update((item, s - offset, s) for item, offset in walk.items.get(k, ()))
        return out

    def hits(self, words: list[bytes], text: np.ndarray, found: set[tuple[int, int]]) -> dict[int | None, tuple[int, int, int]]:
        """Best verified window of each item in one document: item id to (edits, start, length)."""
        best: dict[int | None, tuple[int, int, int]] = {i: (0, 0, len(words)) for i in self.short.get(tuple(words), ())} if self.short else {}
        for item, begin in sorted(found):
            w, name = self.words[item], self.ids[item]
            if name in best and best[name][0] == 0:
                continue
            most = self._most(w)
            if begin >= 0 and np.array_equal(text[begin:begin + len(w)], w):
                near = (0, begin, len(w))
            else:
                a = max(0, begin - most)
                region = text[a:max(a, begin + len(w) + 2 * most)]
                seen = set(region.tolist())
                if sum(x not in seen for x in w.tolist()) > most:  # each word that the region lacks is an edit
                    continue
                near = nearest(w, region)
                near = (near[0], near[1] + a, near[2])
            if near[0] <= most and (name not in best or near < best[name]):
                best[name] = near
        return best


def nearest(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, length) of the window of `text` with the least word edits to `pattern`; the first, then the shortest."""
    m, n = len(pattern), len(text)
    cost, begin = np.arange(m + 1), np.zeros(m + 1, dtype=np.int64)  # against windows that end here, and their starts
    best = (m, 0, 0)
    for j in range(1, n + 1):
        up, up_begin = cost, begin
        diagonal = up[:-1] + (pattern != text[j - 1])
        cost, begin = np.empty_like(up), np.empty_like(up_begin)
        cost[0], begin[0] = 0, j
        a = np.minimum(diagonal, up[1:] + 1)
        from_ = np.where(diagonal <= up[1:] + 1, up_begin[:-1], up_begin[1:])
        # a chain of deletions from above: cost[i] = min over k <= i of a[k] + (i - k)
        shifted = np.concatenate(([0], a)) - np.arange(m + 1)
        low = np.minimum.accumulate(shifted)
        source = np.maximum.accumulate(np.where(shifted == low, np.arange(m + 1), 0))
        cost = low + np.arange(m + 1)
        begin = np.concatenate(([j], from_))[source]
        if cost[m] < best[0]:
            best = (int(cost[m]), int(begin[m]), j - int(begin[m]))
    return best


def _blocks(items: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int | None, bytes | None]]]:
    """The items in blocks, each small enough for the driver and a broadcast."""
    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    n, chars = rows.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil((chars or 0) / BLOCK_CHARS))
    for b in range(blocks):
        yield [(r[0], None if r[1] is None else bytes(r[1])) for r in
               rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).orderBy("id", "text").collect()]


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
         item_text_col: str = "text", similarity: float = SIMILARITY, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, item_id, start, length, edits): every document and item that meet, with the best window in words."""
    return (_found(docs, items, id_col, text_col, item_id_col, item_text_col, similarity, repeats)
            .groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "start", "length")).alias("b"))
            .select("doc_id", "item_id", "b.start", "b.length", "b.edits"))


def _found(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
           item_text_col: str = "text", similarity: float = SIMILARITY, repeats: int = REPEATS) -> DataFrame:
    """(doc_id, text_hash, item_id, start, length, edits): a row for every row of `docs` and item that meet."""
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), _text_hash(text_col).alias("text_hash"),
                        F.col(f"`{text_col}`").cast("binary").alias("text"))
    out = None
    for block in _blocks(items, item_id_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(Index(block, similarity, repeats))
        part = map_arrow(given, _searcher(shared), "doc_id long, text_hash long, item_id long, start long, length long, edits long")
        out = part if out is None else out.unionByName(part)
    return out


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{text_col}`").cast("binary"))


def _searcher(shared):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value

        def rows():
            get = index.symbol.get
            for part in parts:
                for a in range(0, part.num_rows, 500):
                    some = part.slice(a, 500)
                    ids, hashes, each = some.column(0).to_pylist(), some.column(1).to_pylist(), [split(x.as_py()) for x in some.column(2)]
                    gap = [0] * STEPS
                    text, starts = [], []
                    for words in each:
                        starts.append(len(text))
                        text += [get(x, 0) for x in words]
                        text += gap
                    text = np.array(text, dtype=np.int64)
                    found: dict[int, set] = {}
                    if index.walks:
                        for item, begin, at in index.candidates(text):
                            found.setdefault(int(np.searchsorted(starts, at, side="right")) - 1, set()).add((item, begin))
                    for k in sorted(found) if not index.short else range(len(each)):
                        end = starts[k] + len(each[k])
                        own = {(item, begin - starts[k]) for item, begin in found.get(k, ())}
                        for item, (edits, start, length) in index.hits(each[k], text[starts[k]:end], own).items():
                            yield ids[k], hashes[k], item, start, length, edits

        yield from batches(rows(), _HITS)

    return run


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` in which no item is found, all columns. Rows that share an id, or have none, are told apart by their texts."""
    hit = _found(docs, items, id_col, text_col, **how).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_dc_id"), F.col("text_hash").alias("_dc_text")).distinct()
    same = (F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)) == F.col("_dc_id")) & (_text_hash(text_col) == F.col("_dc_text"))
    return docs.join(hit, same, "left_anti")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every (document, benchmark item) that meet, with the window in words and its edits."""
    return find(docs.select("doc_id", "text"), benchmark.select("item_id", "text"))
