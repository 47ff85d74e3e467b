"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix with itself.

A document's row holds the distinct word n-grams of its text, as 64-bit hashes.
Equal rows are one node. Two nodes link at Jaccard similarity of at least
`percent`, which bounds what their overlap must be:

    size:      percent * larger <= 100 * smaller
    overlap:   at least ceil(percent * (n + m) / (100 + percent))
    prefix:    in one order of all n-grams, linked rows share some of their first n - ceil(percent * n / 100) + 1

The product runs over blocks of columns (n-grams) restricted to these prefixes,
rarest n-grams first, so common lines and passages make no long columns. A block
is the columns that share their hub, the row with the smallest hash; rows that
are alike meet in few blocks. A block's incidence matrix times its transpose
gives the overlap counts of its rows; pairs that cannot reach the bound, by
their places in the columns or by this count and all columns they have
elsewhere, are discarded at once, others when the blocks' counts are summed.
Rows bring a signature along, the parities of how many n-grams fall into each of
512 buckets: where two differ in more bits than linked rows differ in n-grams,
the pair cannot link, so few pairs leave a block that do not.
The pairs that remain get their whole overlap from blocks of at most `BLOCK`
n-grams, summed block by block, and the exact similarity decides.

Large groups of near copies would fill blocks with pairs that say nothing new.
So each long column first meets only a few hubs (linear in its rows); their
links make components, and the full product then pairs only rows of
different components. Blocks beyond `TILE` rows are cut into tiles, the largest
component apart from the rest, so no task holds a whole block.

The order of rarity comes from counts of hashed n-grams; it is the same for all
rows and decides about cost only, never about results.

* null or empty text, or only white space: no n-grams, linked with nothing.
* fewer words than an n-gram has: the whole sequence is the one n-gram.
* null id: such rows link by their texts; the smallest id of a component ignores nulls.
* rows that share an id or a text: one row each comes back; links go by text.
* an empty table gives no rows; other columns are not read.
* very long texts: rows of the incidence matrix are cut into blocks, never one record.
* two different sets of one 64-bit hash would count as equal: some N * N / 2**65 expected among N sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightops.llm.common import BROADCAST_ROWS, NO_ID, map_arrow
from flightops.llm.simhash_dedup import components
from flightops.session import stage_table

SHINGLE, PERCENT = 3, 90
#: Hashed counts that order n-grams by rarity; n-grams of one block; rows of one tile of a block; hubs of a column.
SKETCH_BITS, BLOCK, TILE, HUBS = 18, 4096, 1024, 16
#: Columns of fewer rows have no hubs: the product meets their few pairs.
HUB_ROWS = 4
#: Columns of a block that are multiplied at once.
CHUNK = 1024
#: Words of 64 bits of a signature; rows that may be broadcast with one (72 bytes a row: 36 MB).
SIGNATURE, SIGNED_ROWS = 8, BROADCAST_ROWS // 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(30))


def grams(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct n-grams; A-Z lower-cased, words parted by [\\x20\\x09-\\x0D]."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(shingle, len(words))
    made = np.zeros(len(words) - size + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            made = _mix(made * np.uint64(0x9E3779B97F4A7C15) + each[k:k + len(made)])
    made.sort()
    return made[np.concatenate(([True], made[1:] != made[:-1]))]


def node_of(found: np.ndarray) -> int:
    """A signed 64-bit name of a set of n-grams."""
    return xxhash.xxh64_intdigest(found.tobytes(), len(found)) - (1 << 63)


def _rarity(found: np.ndarray) -> np.ndarray:
    return (found >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def signature(found: np.ndarray) -> np.ndarray:
    """Parities of the numbers of n-grams in 64 * SIGNATURE buckets: two sets differ in at least as many n-grams as bits."""
    odd = np.bincount((found % np.uint64(64 * SIGNATURE)).astype(np.int64), minlength=64 * SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _given(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("binary")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))


def _rows_and_counts(given: DataFrame, shingle: int) -> DataFrame:
    """kind 0: (id, tag, node, n, sig) of every document; kind 1: n n-grams are in the hash bucket id."""
    names = ["kind", "id", "tag", "node", "n", "sig"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for part in parts:
            nodes, sizes, sigs, seen = [], [], [], [np.zeros(0, dtype=np.int64)]
            for text in part.column(2):
                found = grams(text.as_py(), shingle)
                seen.append(_rarity(found))
                nodes.append(node_of(found) if len(found) else None)
                sizes.append(len(found))
                sigs.append(signature(found) if len(found) else None)
            total += np.bincount(np.concatenate(seen), minlength=len(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sizes), np.int32)), part.column(0), part.column(1),
                                              pa.array(nodes, type=pa.int64()), pa.array(sizes, type=pa.int64()), pa.array(sigs, type=pa.list_(pa.int64()))], names=names)
        at = np.flatnonzero(total)
        none = pa.nulls(len(at), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int32)), pa.array(at), none, none, pa.array(total[at]),
                                          pa.nulls(len(at), pa.list_(pa.int64()))], names=names)

    return map_arrow(given, run, "kind int, id long, tag long, node long, n long, sig array<long>")


def _columns(given: DataFrame, counts: np.ndarray, shingle: int, percent: int) -> DataFrame:
    """(gram, node, n, at, c): of the first n-grams of each row in the order of rarity those that c rows have, more than one.

    One shuffle by n-gram drops equal rows and counts; what follows groups by n-gram again and finds each in one file.
    """
    shared = given.sparkSession.sparkContext.broadcast(counts)
    names = ["gram", "node", "n", "at"]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, size, seen = shared.value, [], 0, set()

        def flush():
            cols = [np.concatenate(c) for c in zip(*held)]
            for a in range(0, len(cols[0]), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + (1 << 17)]) for c in cols], names=names)

        for part in parts:
            for text in part.column(2):
                found = grams(text.as_py(), shingle)
                n = len(found)
                if not n:
                    continue
                node, length = node_of(found), n - -(-percent * n // 100) + 1
                if node in seen:
                    continue
                seen.add(node)
                first = found[np.lexsort((found, counts[_rarity(found)]))[:length]]
                held.append((first.view(np.int64), np.full(length, node), np.full(length, n, np.int32), np.arange(length, dtype=np.int32)))
                size += length
                if size >= 1 << 17:
                    yield from flush()
                    held, size, seen = [], 0, set()
        if held:
            yield from flush()

    made = map_arrow(given, run, "gram long, node long, n int, at int").repartition("gram")
    rows = made.groupBy("gram", "node").agg(F.min("n").alias("n"), F.min("at").alias("at"))  # equal rows once
    return rows.withColumn("c", F.count(F.lit(1)).over(Window.partitionBy("gram"))).where("c > 1")


def _least_overlap(n: Column, m: Column, percent: int) -> Column:
    return F.ceil((n + m) * percent / (100 + percent))


def _possible(n: Column, i: Column, m: Column, j: Column, percent: int) -> Column:
    """Whether rows of n and m n-grams that share one at the places i and j can link."""
    fits = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return fits & (most >= _least_overlap(n, m, percent))


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it has at most so many (narrow) rows; otherwise joined by shuffling."""
    return F.broadcast(df) if df.count() <= rows else df


def _alike(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The `pairs` (a, b, n, m) whose signatures differ in no more bits than linked rows may differ in n-grams."""
    for side in ("a", "b"):
        pairs = pairs.join(_small(rows.select(F.col("node").alias(side), F.col("sig").alias(f"sig_{side}")), SIGNED_ROWS), side)
    bits = F.aggregate(F.zip_with("sig_a", "sig_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    most = F.col("n") + F.col("m") - 2 * _least_overlap(F.col("n"), F.col("m"), percent)
    return pairs.where(bits <= most).select("a", "b", "n", "m")


def _hub_pairs(columns: DataFrame, percent: int) -> DataFrame:
    """(a, b, n, m): rows with the hubs of their columns of at least HUB_ROWS rows, the rows with the smallest hashes by several hash
    functions, if they meet in half as many columns as a link needs.

    These pairs only save work: what they miss is left to the full product.
    """
    some = columns.where(F.col("c") >= HUB_ROWS)
    hubs = some.groupBy("gram").agg(*[F.min(F.struct(F.xxhash64("node", F.lit(k)), "node", "n", "at")).alias(f"h{k}") for k in range(HUBS)])
    hubs = stage_table(hubs.select("gram", F.array_distinct(F.array(*[
        F.struct(F.col(f"h{k}.node").alias("node"), F.col(f"h{k}.n").alias("n"), F.col(f"h{k}.at").alias("at")) for k in range(HUBS)])).alias("hubs")), "hubs")
    met = some.join(_small(hubs, BROADCAST_ROWS // 16), "gram").select("node", "n", "at", F.explode("hubs").alias("h"))
    met = met.where((F.col("node") != F.col("h.node")) & _possible(F.col("n"), F.col("at"), F.col("h.n"), F.col("h.at"), percent))
    counted = _ordered(met, F.col("node"), F.col("n"), F.col("h.node"), F.col("h.n")).groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("c"))
    return _enough(counted.withColumn("c", F.col("c") * 2), percent)


def _enough(counted: DataFrame, percent: int) -> DataFrame:
    """(a, b, n, m) of the pairs whose prefixes share enough (c) for the overlap bound.

    What the pair shares beyond is at most the rest of the row whose prefix ends first in the order.
    """
    rest = F.greatest(F.ceil(F.col("n") * percent / 100), F.ceil(F.col("m") * percent / 100)) - 1
    return counted.where(F.col("c") + rest >= _least_overlap(F.col("n"), F.col("m"), percent)).select("a", "b", "n", "m")


def _ordered(df: DataFrame, a: Column, n: Column, b: Column, m: Column) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"),
                     F.when(a < b, n).otherwise(m).alias("n"), F.when(a < b, m).otherwise(n).alias("m"))


def _product(columns: DataFrame, known: DataFrame, nodes: DataFrame, percent: int, tile: int = TILE) -> DataFrame:
    """(a, b, n, m): pairs of rows of different components whose counts over all blocks reach the bound.

    known: (node, least) of the rows that already have a component of several; nodes: (node, sig) of all rows.
    """
    rows = columns.join(_small(known.select("node", F.col("least").alias("comp"))), "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = rows.groupBy("gram").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.min(F.struct(F.xxhash64("node"), "node")).alias("hub"))
    mixed = stage_table(mixed.where("x <> y").select("gram", F.col("hub.node").alias("block")), "mixed")
    members = rows.join(_small(mixed), "gram").groupBy("block", "node").agg(
        F.min("comp").alias("comp"), F.min("n").alias("n"), F.collect_list(F.struct("gram", "at")).alias("cols"))
    members = stage_table(members, "blocks")
    live = members.groupBy("node").agg(F.sum(F.size("cols")).cast("int").alias("live"))
    live = nodes.select("node", "sig").join(_small(live), "node")
    kinds = members.groupBy("block", "comp").agg(F.count(F.lit(1)).alias("c"))
    kinds = kinds.groupBy("block").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("kinds"), F.max(F.struct("c", "comp")).alias("top"))
    kinds = kinds.where("kinds > 1").select("block", "total", F.col("top.c").alias("main_n"), F.col("top.comp").alias("main"))
    met = members.join(_small(stage_table(kinds, "kinds")), "block").join(_small(stage_table(live, "live"), SIGNED_ROWS), "node")
    apart = F.col("total") > tile  # else the block is one cell
    others = F.when(apart, F.ceil((F.col("total") - F.col("main_n")) / tile)).otherwise(F.lit(1)).cast("int")
    mains = F.when(apart, F.ceil(F.col("main_n") / tile)).otherwise(F.lit(0)).cast("int")
    is_main = apart & (F.col("comp") == F.col("main"))
    h = F.xxhash64("node")
    met = met.withColumns({"own": F.when(is_main, others + F.pmod(h, mains)).otherwise(F.pmod(h, others)).cast("int"),
                           "to": F.when(is_main, F.sequence(F.lit(0), others - 1)).otherwise(F.sequence(F.lit(0), others + mains - 1))})
    cells = met.withColumn("other", F.explode("to")).select(
        "block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node", "own", "comp", "n", "live", "sig",
        F.col("cols.gram").alias("gram"), F.col("cols.at").alias("at"))
    cells = cells.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "node")
    counted = map_arrow(cells, lambda parts: _cells(parts, percent), "a long, b long, n int, m int, c int")
    return _enough(counted.groupBy("a", "b", "n", "m").agg(F.sum("c").alias("c")), percent)


def _cells(parts: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Counted pairs of whole cells; the last cell of a batch waits for the next batch."""
    held, out, size = None, [], 0
    for part in parts:
        now = _unpacked(part)
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        starts = _starts(now)
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            found = _multiplied(_cut(now, s, e), percent)
            if found is not None:
                out.append(found)
                size += len(found[0])
                if size >= 1 << 16:
                    yield _batch(out)
                    out, size = [], 0
        held = _cut(now, int(starts[-1]), len(now[0])) if len(starts) else now
    if held is not None and len(held[0]):
        found = _multiplied(held, percent)
        if found is not None:
            out.append(found)
    if out:
        yield _batch(out)


def _unpacked(part: pa.RecordBatch) -> list[np.ndarray]:
    """The columns of a batch of cells: one number a row, signatures, columns a row, and the rows' columns and places in a line."""
    each = [part.column(k).to_numpy(zero_copy_only=False) for k in range(8)]
    sig = part.column(8).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
    wide = pc.list_value_length(part.column(9)).to_numpy(zero_copy_only=False).astype(np.int64)
    return [*each, sig, wide, *[part.column(k).flatten().to_numpy(zero_copy_only=False) for k in (9, 10)]]


def _cut(cols: list[np.ndarray], s: int, e: int) -> list[np.ndarray]:
    """The rows from `s` to before `e` of what `_unpacked` gave."""
    first = int(cols[9][:s].sum())
    last = first + int(cols[9][s:e].sum())
    return [*[x[s:e] for x in cols[:10]], *[x[first:last] for x in cols[10:]]]


def _batch(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], names=["a", "b", "n", "m", "c"])


def _starts(cols: list[np.ndarray]) -> np.ndarray:
    new = np.zeros(len(cols[0]), dtype=bool)
    new[:1] = True
    for c in cols[:3]:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _multiplied(cols: list[np.ndarray], percent: int) -> tuple[np.ndarray, ...] | None:
    """(a, b, n, m, c) of a cell's pairs that may still link: rows sorted by node, one a node."""
    _, i, j, node, own, comp, n, live, sig, wide, gram, at = cols
    k = len(node)
    if k < 2 or (comp == comp[0]).all():
        return None
    row = np.repeat(np.arange(k), wide)
    _, column = np.unique(gram, return_inverse=True)
    count, shift = np.zeros((k, k), dtype=np.float32), np.zeros((k, k), dtype=np.float32)
    for a in range(0, int(column.max()) + 1, CHUNK):
        here = (column >= a) & (column < a + CHUNK)
        part = np.zeros((k, min(CHUNK, int(column.max()) + 1 - a)), dtype=np.float32)
        part[row[here], column[here] - a] = 1.0
        place = part.copy()
        place[row[here], column[here] - a] = at[here]
        count += part @ part.T
        moved = place @ part.T
        shift += moved - moved.T  # sum of the differences of places
    size, elsewhere = n.astype(np.int64), live - wide
    a, b = np.nonzero(np.triu(count > 0, 1))
    a, b = (x[(comp[a] != comp[b]) & ((i[0] == j[0]) | (own[a] != own[b]))] for x in (a, b))
    x, y, c = size[a], size[b], count[a, b].astype(np.int64)
    need = -(-percent * (x + y) // (100 + percent))
    rest = np.maximum(-(-percent * x // 100), -(-percent * y // 100)) - 1
    moved = shift[a, b] / np.maximum(c, 1)
    good = ((100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (c + np.minimum(elsewhere[a], elsewhere[b]) + rest >= need)
            & (y + moved >= need - 1e-3) & (x - moved >= need - 1e-3))
    a, b, c, need = a[good], b[good], c[good], need[good]
    near = np.bitwise_count((sig[a] ^ sig[b]).view(np.uint64)).sum(axis=1, dtype=np.int64) <= size[a] + size[b] - 2 * need
    a, b, c = a[near], b[near], c[near]
    if not len(a):
        return None
    return node[a], node[b], size[a].astype(np.int32), size[b].astype(np.int32), c.astype(np.int32)


def block_bits(n: int) -> int:
    """The hash bits that part a row of n n-grams into blocks of about BLOCK at most."""
    return ((n - 1) // BLOCK).bit_length()


def _entries(given: DataFrame, nodes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(node, bits, blk, grams): the rows named by `nodes` (node, id, tag, copies), cut into blocks of n-grams.

    Rows whose partners may be cut finer come in both cuts.
    """
    schema = pa.schema([("node", pa.int64()), ("bits", pa.int32()), ("blk", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for part in parts:
            for text in part.column(2):
                found = grams(text.as_py(), shingle)
                if not len(found):
                    continue
                node, n = node_of(found), len(found)
                for bits in {block_bits(n), block_bits(max(1, n * 100 // percent))}:
                    ends = np.searchsorted(found, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else []
                    for blk, some in enumerate(np.split(found, ends)):
                        if len(some):
                            rows.append((node, bits, blk, some.view(np.int64)))
                            size += len(some)
                    if size > 1 << 19:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def named(some: DataFrame) -> DataFrame:
        wanted = some.select(F.col("id").alias("w_id"), F.col("tag").alias("w_tag"))
        return given.join(_small(wanted), (F.coalesce("id", F.lit(NO_ID)) == F.col("w_id")) & (F.col("tag") == F.col("w_tag")), "left_semi")

    texts, repeated = named(nodes.where("copies = 1")), nodes.where("copies > 1")
    if not repeated.isEmpty():  # repeated rows once
        texts = texts.unionByName(named(repeated).groupBy("id", "tag").agg(F.any_value("text").alias("text")))
    return map_arrow(texts, run, "node long, bits int, blk long, grams array<long>")


def _linked(pairs: DataFrame, given: DataFrame, rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The (a, b) of `pairs` that link: overlaps summed block by block, then the exact similarity."""
    pairs = stage_table(pairs, "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    entries = stage_table(_entries(given, rows.join(_small(nodes), "node", "left_semi"), shingle, percent), "entries")
    held = entries.agg(F.coalesce(F.sum(F.size("grams")), F.lit(0))).first()[0]
    side = F.broadcast if held <= BROADCAST_ROWS // 8 else (lambda df: df)  # 8 bytes an n-gram: 2 MB
    bits = F.length(F.conv(F.floor((F.greatest("n", "m") - 1) / BLOCK).cast("string"), 10, 2))
    bits = F.when(F.greatest("n", "m") <= BLOCK, F.lit(0)).otherwise(bits).cast("int")
    cut = pairs.withColumn("bits", bits).withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1)))
    met = (cut.join(side(entries.withColumnsRenamed({"node": "a", "grams": "ga"})), ["a", "bits", "blk"])
           .join(side(entries.withColumnsRenamed({"node": "b", "grams": "gb"})), ["b", "bits", "blk"])
           .select("a", "b", "n", "m", F.size(F.array_intersect("ga", "gb")).alias("both")))
    summed = met.groupBy("a", "b", "n", "m").agg(F.sum("both").alias("both"))
    return stage_table(summed.where(F.col("both") * 100 >= (F.col("n") + F.col("m") - F.col("both")) * percent).select("a", "b"), "links")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
            tile: int = TILE) -> DataFrame:
    """(id, n, component): one row per row of `docs`, with the size of its set and the smallest id that links reach."""
    given = _given(docs, id_col, text_col)
    marked = stage_table(_rows_and_counts(given, shingle), "sets")
    got = marked.where("kind = 1").groupBy("id").agg(F.sum("n").alias("n")).toArrow()  # at most 2**SKETCH_BITS rows
    counts = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
    counts[got.column("id").to_numpy()] = got.column("n").to_numpy()
    docs_ = marked.where("kind = 0").select("id", "tag", "node", "n", "sig")
    rows = docs_.where("node is not null").groupBy("node", F.coalesce("id", F.lit(NO_ID)).alias("key"), "tag").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.min("sig").alias("sig"))
    rows = rows.groupBy("node").agg(F.min(F.struct("copies", "key", "tag")).alias("one"), F.min("id").alias("least_id"), F.min("sig").alias("sig"))
    rows = stage_table(rows.select("node", F.col("one.key").alias("id"), F.col("one.tag").alias("tag"), F.col("one.copies").alias("copies"), "least_id", "sig"), "nodes")

    columns = stage_table(_columns(given, counts, shingle, percent), "columns")
    links = _linked(_alike(_hub_pairs(columns, percent), rows, percent), given, rows, shingle, percent)
    more = _linked(_product(columns, components(links), rows, percent, tile), given, rows, shingle, percent)
    known = components(links.unionByName(more))  # all but the smallest node of each component
    known = known.unionByName(known.select(F.col("least").alias("node"), "least").distinct())
    named = rows.select("node", "least_id").join(_small(known), "node")
    ids = named.groupBy("least").agg(F.min("least_id").alias("component"))
    reached = stage_table(named.select("node", "least").join(ids, "least").select("node", F.col("component").alias("linked")), "reached")
    alone = rows.select("node", "least_id")
    of_node = stage_table(alone.join(_small(reached), "node", "left").select("node", F.coalesce("linked", "least_id").alias("component")), "classes")
    out = docs_.where("node is not null").join(_small(of_node), "node").select("id", "n", "component")
    return out.unionByName(docs_.where("node is null").select("id", "n", F.col("id").alias("component")))


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of op11 over a table with doc_id and text."""
    return classes(docs).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


ORACLE = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {SHINGLE} THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - {SHINGLE - 2}), lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' ')) END) AS gram FROM w)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= {PERCENT} * (x.n + y.n - c)),
pairs AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS start, doc_id AS reach FROM n UNION SELECT r.start, b FROM r JOIN pairs ON r.reach = pairs.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce((SELECT min(reach) FROM r WHERE start = d.doc_id), d.doc_id)::BIGINT AS component_id
FROM documents d LEFT JOIN n USING (doc_id)
"""
