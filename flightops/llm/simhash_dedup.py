"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked at a few differing bits.

Fingerprints are made document by document, equal ones are collapsed to one
row, and only those rows are compared. Two fingerprints that differ in at most
`radius` bits agree on at least `blocks - radius` of `blocks` blocks of bits,
so it is enough to compare rows that agree on such a choice of blocks. That is
an exact split of the comparison, not a filter that can miss a pair. The rows
of one agreement are cut into tiles by hash, each pair of tiles is a task's
cell, and inside a cell rows sorted by population count are compared 256 by
256 with exclusive-or and bit counts; pairs of sub-tiles whose population
counts differ by more than the radius are skipped. A cell returns a spanning
forest of its links, never all pairs of a group of near copies.

Components come from the links by alternating large-star and small-star steps
on tables in the shared checkpoint folder.

* null or empty text: fingerprint zero, linked like any other.
* null id: counts as the largest long. Nodes are fingerprints: rows that share an id, or have none, are linked by their texts only;
  the id only chooses and names the smallest of a group.
* ties: of rows of a group with the smallest id the smallest fingerprint, then the smallest text hash stays, with its equals.
* an empty table gives no rows; a very long text is counted 65,536 shingles at a time. `keep_one` passes all columns through.
* one block choice is a shuffle of (blocks over radius) narrow rows a fingerprint; more blocks
  mean shorter cells. The default of 5 gives 10 choices of 25 or 26 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import NO_ID, map_arrow
from flightops.session import stage_table

SHINGLE, RADIUS, SEED, BLOCKS = 3, 3, 42, 5
#: Rows of one block agreement that meet in one cell (two tiles), rows of a sub-tile, rows of a cell compared by shifts.
TILE, SUB, SHORT = 4096, 256, 48


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in over half of the shingle hashes; A-Z lower-cased, zero without words."""
    words = text.lower().split()  # bytes: only A-Z change, only [\x20\x09-\x0D] separate
    if not words:
        return 0
    if len(words) < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, n = xxhash.xxh64_intdigest, len(words) - shingle + 1
    counts = np.zeros(64, dtype=np.int64)
    for a in range(0, n, 1 << 16):
        part = words[a:a + (1 << 16) + shingle - 1]
        rows = zip(*(part[k:] for k in range(shingle)))
        hashes = np.array([digest(s, seed) for s in map(b" ".join, rows)], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(id, text_hash, fp): one row per row of `docs`, fp as a signed long."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            made = np.array([fingerprint(x.as_py() or b"", shingle, seed) for x in part.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(made.view(np.int64))], names=["id", "text_hash", "fp"])

    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _text_hash(text_col).alias("text_hash"),
                        F.col(f"`{text_col}`").cast("binary").alias("text"))
    return map_arrow(given, run, "id long, text_hash long, fp long")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.col(f"`{text_col}`").cast("binary"))


def _block_masks(blocks: int, radius: int) -> list[int]:
    """Masks of every choice of `blocks - radius` blocks of bits, as signed longs."""
    edges = [round(64 * k / blocks) for k in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    found = [sum(c) for c in combinations(each, blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(a, b), a > b: nodes joined by links that keep every group of near fingerprints connected.

    distinct: (fp, node), one row per fingerprint; a table that is cheap to read again.
    """
    masks = _block_masks(blocks, radius)
    rows = distinct.select("fp", "node", F.explode(F.array(*[
        F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for i, m in enumerate(masks)])).alias("at")).select("fp", "node", "at.table", "at.key")
    crowded = stage_table(rows.groupBy("table", "key").count().where(F.col("count") > tile)
                          .select("table", "key", F.ceil(F.col("count") / tile).cast("int").alias("tiles")), "crowded")
    placed = (rows.join(crowded, ["table", "key"], "left")
              .withColumn("tiles", F.coalesce("tiles", F.lit(1)))
              .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
              .where((F.col("tiles") == 1) | (F.col("own") != F.col("other")))
              .select("table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      F.bit_count("fp").alias("pop"), "fp", "node"))
    cells = placed.repartition("table", "key", "i", "j").sortWithinPartitions("table", "key", "i", "j", "pop", "node")
    found = map_arrow(cells, lambda parts: _cells(parts, radius), "a long, b long")
    return found.groupBy("a", "b").agg(F.lit(1).alias("n")).select("a", "b")


def _cells(parts: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links of whole cells; the last cell of a batch waits for the next batch."""
    held = None
    for part in parts:
        now = [part.column(k).to_numpy(zero_copy_only=False) for k in range(7)]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        starts = _starts(now)
        last = starts[-1] if len(starts) else 0
        yield from _linked([x[:last] for x in now], starts[:-1], radius)
        held = [x[last:] for x in now]
    if held is not None and len(held[0]):
        yield from _linked(held, _starts(held), radius)


def _starts(cols: list[np.ndarray]) -> np.ndarray:
    n = len(cols[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in cols[:4]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _linked(cols: list[np.ndarray], starts: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    pop, fp, node = cols[4].astype(np.int64), cols[5].view(np.uint64), cols[6]
    if not len(fp):
        return
    ends = np.append(starts[1:], len(fp))
    sizes = ends - starts
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    short = np.repeat(sizes <= SHORT, sizes)
    cell = np.repeat(np.arange(len(starts)), sizes)
    least = _Forest()
    for shift in range(1, int(sizes[sizes <= SHORT].max(initial=0))):
        a = np.flatnonzero(short[:-shift] & (cell[:-shift] == cell[shift:]) & (pop[shift:] - pop[:-shift] <= radius))
        a = a[np.bitwise_count(fp[a] ^ fp[a + shift]) <= radius]
        kept = [(x, x + shift) for x in a.tolist() if least.join(x, x + shift)]
        if kept:
            pairs.append(tuple(np.array(k) for k in zip(*kept)))
    for s, e in zip(starts[sizes > SHORT].tolist(), ends[sizes > SHORT].tolist()):
        a, b = tiled(fp[s:e], pop[s:e], radius)
        pairs.append((a + s, b + s))
    if pairs:
        a, b = node[np.concatenate([p[0] for p in pairs])], node[np.concatenate([p[1] for p in pairs])]
        keep = a != b
        yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)[keep]), pa.array(np.minimum(a, b)[keep])], names=["a", "b"])


class _Forest:
    """Union of small integers."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def tiled(fp: np.ndarray, pop: np.ndarray, radius: int, sub: int = SUB) -> tuple[np.ndarray, np.ndarray]:
    """Positions (a, b) of links that span every connected group; `pop` ascends."""
    n = len(fp)
    group, left, right = np.arange(n), [], []
    for s in range(0, n, sub):
        e = min(s + sub, n)
        for t in range(s, n, sub):
            if pop[t] - pop[e - 1] > radius:
                break  # later tiles have still higher counts
            near = np.bitwise_count(fp[s:e, None] ^ fp[None, t:t + sub]) <= radius
            a, b = np.nonzero(near & (group[s:e, None] != group[None, t:t + sub]))
            if not len(a):
                continue
            a, b = a + s, b + t
            _, first = np.unique(group[a] * n + group[b], return_index=True)  # a link for each two groups that meet
            forest = _Forest()
            for x, y in zip(a[first].tolist(), b[first].tolist()):
                if forest.join(int(group[x]), int(group[y])):
                    left.append(x)
                    right.append(y)
            to = np.arange(n)
            for x in forest.up:
                to[x] = forest.root(x)
            group = to[group]
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, least): for every node of `edges` (a, b) the smallest node that it reaches."""
    edges = stage_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    before = None
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage_table(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select("a", F.least("a", "m").alias("m")), "low")
        large = both.join(low, "a").where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage_table(large.distinct(), "large")
        low = stage_table(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        met = large.join(low, "a")
        small = met.select("a", F.col("m").alias("b")).unionByName(
            met.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        edges = stage_table(small.distinct(), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("least"))
        before = now
    raise RuntimeError(f"components did not settle in {most} rounds")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            radius: int = RADIUS, seed: int = SEED, blocks: int = BLOCKS) -> DataFrame:
    """(id, fp, component): one row per row of `docs`; component is the smallest id of the fingerprints reachable."""
    marked, known = _groups(docs, id_col, text_col, shingle, radius, seed, blocks)
    return marked.join(known, "fp").select("id", "fp", "component")


def _groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS,
            seed: int = SEED, blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(id, text_hash, fp) of every row of `docs`, and (fp, grp, component, chosen) of every fingerprint: its group's smallest
    fingerprint and smallest id, and of the fingerprints with that id the smallest."""
    marked = stage_table(fingerprints(docs, id_col, text_col, shingle, seed)
                         .withColumn("id", F.coalesce("id", F.lit(NO_ID))), "fingerprints")
    # the fingerprint is the node: an id that several texts share links nothing
    distinct = stage_table(marked.groupBy("fp").agg(F.min("id").alias("id")).withColumn("node", F.col("fp")), "distinct")
    least = components(links(distinct, radius, blocks))
    known = stage_table(distinct.join(least, "node", "left").select("fp", "id", F.coalesce("least", "node").alias("grp")), "group")
    smallest = (known.groupBy("grp").agg(F.min(F.struct("id", "fp")).alias("s"))
                .select("grp", F.col("s.id").alias("component"), F.col("s.fp").alias("chosen")))
    return marked, stage_table(known.join(smallest, "grp").select("fp", "grp", "component", "chosen"), "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs` with the smallest id of their group and one text, all columns; of repeated rows of these, all stay.

    A text is chosen by its fingerprint and hash where rows of a group share the smallest id or have none.
    """
    marked, known = _groups(docs, id_col, text_col, **how)
    chosen = (marked.join(known.where("fp = chosen").select("fp", "component"), "fp").where("id = component")
              .groupBy("fp").agg(F.min("id").alias("_sh_id"), F.min("text_hash").alias("_sh_text")).select("_sh_id", "_sh_text"))
    same = (F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)) == F.col("_sh_id")) & (_text_hash(text_col) == F.col("_sh_text"))
    return docs.join(chosen, same, "left_semi")


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of op7 over a table with doc_id and text."""
    return classes(docs).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                F.col("component").alias("component_id"))
