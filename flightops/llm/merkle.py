"""Merkle manifest of a table: a tree of SHA-256 digests per source, and one over the sources.

Leaves of a source ascend by id. They are cut into aligned blocks of fanout**3
leaves (`BLOCK_LEVELS`); a block folds its own three levels. Above that, blocks
exchange subtree roots in a butterfly: in round r the blocks whose indices
differ in digit r only (base fanout) swap the roots of the subtrees that they
hold, and every block hashes the common ancestor itself and notes its siblings.
After the last round each block knows the root and its own upper proof, and no
pass goes down again. In the last, ragged group a subtree has fewer blocks than
its neighbours; its blocks then serve those with the same index modulo their
number. The roots of the sources are the leaves of one more such tree.

Positions come from ranges of the order (source, id, leaf), so a source that
holds most rows is spread over many ranges and blocks; no task holds more than
one block at a time, and a block's proof is sent to it once, not to each row.

* a field that is null counts as `-`; null source is a source of its own, the first; null ids come first in their source.
* rows that share an id are ordered by their leaf; equal rows are counted before the order and are leaves of their own each.
* an empty table gives no rows. A lone leaf is its source's root, a lone source's root is the root.
* very long texts are hashed in the JVM, never moved; other columns of `docs` are not read and cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import batches, crc32_sql, map_arrow
from flightops.operators.ranks import ranked
from flightops.session import stage_table

FANOUT, BLOCK_LEVELS = 16, 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(fields: list[Column]) -> Column:
    """Digest of a row's fields: each `-` if null, else UTF-8 byte count, `:`, value."""
    made = []
    for f in fields:
        text = f.cast("string")
        made.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*made).cast("binary"), 256)


def _h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _folded(nodes: list[str], total: int, fanout: int, most: int) -> list[list[str]]:
    """Levels of an aligned block, leaves first, up to `most` folds; `total` is the number of the whole group's leaves."""
    levels = [nodes]
    while total > 1 and len(levels) <= most:
        levels.append([_h("".join(levels[-1][a:a + fanout])) for a in range(0, len(levels[-1]), fanout)])
        total = -(-total // fanout)
    return levels


def _blocks_of(parts: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """((group, block), its rows) from sorted batches whose first two columns are group and block."""
    key, held = None, []
    for part in parts:
        for row in zip(*(part.column(k).to_pylist() for k in range(columns))):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row)
    if held:
        yield key, held


def in_blocks(leaves: DataFrame, width: int) -> DataFrame:
    """Leaves (grp, pos, n, ...) by aligned block: a row that stands for n equal leaves is cut where a block ends."""
    first, last = F.floor(F.col("pos") / width), F.floor((F.col("pos") + F.col("n") - 1) / width)
    cut = leaves.withColumn("blk", F.explode(F.sequence(first, last)))
    begin = F.greatest("pos", F.col("blk") * width)
    end = F.least(F.col("pos") + F.col("n"), (F.col("blk") + 1) * width)
    return cut.withColumns({"pos": begin, "n": end - begin})


def block_roots(leaves: DataFrame, fanout: int = FANOUT, levels: int = BLOCK_LEVELS) -> DataFrame:
    """(grp, blk, blocks, h): the subtree root of each aligned block of leaves (grp, pos, n, total, h)."""
    width = fanout ** levels
    schema = pa.schema([("grp", pa.string()), ("blk", pa.int64()), ("blocks", pa.int64()), ("h", pa.string())])

    def run(parts):
        def rows():
            for (grp, blk), held in _blocks_of(parts, 6):
                total = held[0][3]
                nodes = [r[4] for r in held for _ in range(r[5])]
                yield grp, blk, -(-total // width), _folded(nodes, total, fanout, levels)[-1][0]
        yield from batches(rows(), schema)

    given = (in_blocks(leaves, width).select("grp", "blk", "pos", "total", "h", "n")
             .repartition("grp", "blk").sortWithinPartitions("grp", "blk", "pos"))
    return map_arrow(given, run, "grp string, blk long, blocks long, h string")


def butterfly(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(grp, blk, root, upper): each block's root of its group, and its upper proof, an array of (run, at) from below:
    the digests that were hashed together, and the place of the block's own among them."""
    now = stage_table(blocks.select("grp", "blk", "blocks", "h", F.array().cast("array<struct<run:array<string>,at:int>>").alias("upper")), "butterfly")
    most = now.agg(F.max("blocks")).first()[0] or 1
    stride = 1
    while stride < most:
        own = F.floor(F.col("blk") / stride)                       # the subtree that the block holds now
        first = F.floor(own / fanout) * fanout                     # the first subtree of its group of fanout
        low = F.col("blk") - own * stride
        held = F.least(F.lit(stride).cast("long"), F.col("blocks") - own * stride)  # blocks of this subtree
        last = F.least(first + fanout, F.ceil(F.col("blocks") / stride)) - 1
        # to every block of the group whose index inside its subtree is mine modulo the number of blocks of my subtree
        to = F.explode(F.flatten(F.transform(F.sequence(first, last), lambda g: F.transform(
            F.sequence(low, F.lit(stride - 1).cast("long"), held), lambda k: F.struct((g * stride + k).alias("blk"), (g == own).alias("own"))))))
        going = now.where(F.col("blocks") > stride)
        sent = (going.select("grp", "blocks", own.alias("tree"), "h", F.col("blk").alias("from"), to.alias("to"))
                .where((F.col("to.blk") < F.col("blocks")) & (~F.col("to.own") | (F.col("to.blk") == F.col("from"))))
                .select("grp", F.col("to.blk").alias("blk"), "tree", "h"))
        met = (sent.groupBy("grp", "blk").agg(F.sort_array(F.collect_list(F.struct("tree", "h"))).alias("met"))
               .select("grp", "blk", F.col("met.h").alias("run"), F.col("met.tree").getItem(0).alias("tree0")))
        step = F.struct(F.col("run"), (F.floor(F.col("blk") / stride) - F.col("tree0")).cast("int").alias("at"))
        joined = now.join(met.withColumnsRenamed({"grp": "g2", "blk": "b2"}),
                          F.col("grp").eqNullSafe(F.col("g2")) & (F.col("blk") == F.col("b2")), "left").drop("g2", "b2")
        now = stage_table(joined.select(
            "grp", "blk", "blocks",
            F.when(F.col("run").isNull(), F.col("h")).otherwise(F.sha2(F.concat_ws("", "run").cast("binary"), 256)).alias("h"),
            F.when(F.col("run").isNull(), F.col("upper")).otherwise(F.concat("upper", F.array(step))).alias("upper")), "butterfly")
        stride *= fanout
    return now.select("grp", "blk", F.col("h").alias("root"), "upper")


def _with_proofs(leaves: DataFrame, uppers: DataFrame, run, schema: str, fanout: int, levels: int) -> DataFrame:
    """`run` over batches of (grp, blk, pos, total, h, id, other, n, upper): a block's upper proof comes first, then its leaves."""
    none = F.lit(None)
    heads = uppers.select("grp", "blk", F.lit(-1).cast("long").alias("pos"), none.cast("long").alias("total"), none.cast("string").alias("h"),
                          none.cast("long").alias("id"), none.cast("string").alias("other"), none.cast("long").alias("n"), "upper")
    rows = in_blocks(leaves, fanout ** levels).select("grp", "blk", "pos", "total", "h", "id", "other", "n",
                                                      none.cast(uppers.schema["upper"].dataType).alias("upper"))
    given = rows.unionByName(heads).repartition("grp", "blk").sortWithinPartitions("grp", "blk", "pos")
    return map_arrow(given, run, schema)


def _proof_rows(parts: Iterator[pa.RecordBatch], fanout: int, levels: int):
    """(grp, leaf row, proof) of every leaf; a proof is a list of (digests hashed together, own place)."""
    for (grp, _), held in _blocks_of(parts, 9):
        above = [(s["run"], s["at"]) for s in held[0][8]]
        rows = [r for r in held[1:] for _ in range(r[7])]
        inner = _folded([r[4] for r in rows], rows[0][3], fanout, levels) if rows else []
        for k, row in enumerate(rows):
            proof, at = [], k
            for level in inner[:-1]:
                first = at - at % fanout
                proof.append((level[first:first + fanout], at % fanout))
                at //= fanout
            yield grp, row, proof + above


def refold(node: str, proof: list[tuple[list[str], int]]) -> str:
    """The root that a leaf and the siblings of its proof give."""
    for run, at in proof:
        node = _h("".join(run[:at]) + node + "".join(run[at + 1:]))
    return node


def proof_text(proof: list[tuple[list[str], int]]) -> str:
    """All siblings, level by level, left to right."""
    return "".join("".join(run[:at]) + "".join(run[at + 1:]) for run, at in proof)


def leaves_of(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
              other: Column | None = None) -> DataFrame:
    """(grp, id, h, other, n, pos, total): a row for n equal rows, with the position of the first in the group."""
    rows = docs.select(F.col(f"`{group_col}`").cast("string").alias("grp"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       leaf([F.col(f"`{f}`") for f in fields]).alias("h"),
                       (other if other is not None else F.lit(None)).cast("string").alias("other"))
    once = rows.groupBy("grp", "id", "h", "other").agg(F.count(F.lit(1)).alias("n"))
    order = ranked(once, ["grp"], [F.col("id").asc_nulls_first(), F.col("h").asc(), F.col("other").asc_nulls_first()], "n", "leaves")
    totals = order.totals().withColumnsRenamed({"grp": "g2", "_total": "total"})
    return stage_table(order.with_position("pos").join(totals, F.col("grp").eqNullSafe(F.col("g2"))).drop("g2"), "leaves")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS,
             other: Column | None = None, fanout: int = FANOUT, levels: int = BLOCK_LEVELS, digest_only: bool = False) -> DataFrame:
    """(id, grp, leaf, subroot, root, proof, folded): one row per row of `docs`.

    proof: array of (run, at), from the leaf to the root. folded: the root refolded from `other` (a digest
    presented in place of the leaf, null: the leaf itself) and the siblings. With `digest_only` the proof is the
    digest of its siblings in order, which spares a row its kilobytes.
    """
    leaves = leaves_of(docs, id_col, group_col, fields, other)
    lower = stage_table(butterfly(block_roots(leaves, fanout, levels), fanout), "lower")
    tops = lower.where("blk = 0").select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.col("root").alias("h"))
    placed = ranked(tops, ["grp"], [F.col("name").asc_nulls_first()], name="sources")
    total = placed.totals().select(F.col("_total").alias("total"), F.col("grp").alias("g2"))
    sources = stage_table(placed.with_position("pos").join(F.broadcast(total), F.col("grp") == F.col("g2"))
                          .select("grp", "name", "pos", "total", "h", F.lit(1).cast("long").alias("n")), "sources")
    upper = butterfly(block_roots(sources, fanout, levels), fanout)
    # a source's way up: the same blocks and exchange, one leaf a source
    given = sources.select("grp", "pos", "total", "h", F.lit(None).cast("long").alias("id"), F.col("name").alias("other"), "n")
    step = "array<struct<run:array<string>,at:int>>"
    pairs = pa.list_(pa.struct([("run", pa.list_(pa.string())), ("at", pa.int32())]))
    ways = stage_table(_with_proofs(given, upper, partial(_ways, fanout=fanout, levels=levels, pairs=pairs),
                                    f"name string, subroot string, root string, way {step}", fanout, levels), "ways")
    heads = (lower.join(ways, F.col("grp").eqNullSafe(F.col("name")))
             .select("grp", "blk", F.concat("upper", F.array(F.struct(F.array("subroot").alias("run"), F.lit(-1).alias("at"))), "way").alias("upper")))
    proof = "string" if digest_only else step
    return _with_proofs(leaves, heads, partial(_finished, fanout=fanout, levels=levels, pairs=None if digest_only else pairs),
                        f"id long, grp string, leaf string, subroot string, root string, proof {proof}, folded string", fanout, levels)


def _ways(parts, fanout, levels, pairs):
    schema = pa.schema([("name", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("way", pairs)])
    rows = ((row[6], row[4], refold(row[4], proof), [{"run": r, "at": a} for r, a in proof])
            for _, row, proof in _proof_rows(parts, fanout, levels))
    yield from batches(rows, schema)


def _finished(parts, fanout, levels, pairs):
    names = [("id", pa.int64()), ("grp", pa.string()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
             ("proof", pairs or pa.string()), ("folded", pa.string())]

    def rows():
        for grp, row, marked in _proof_rows(parts, fanout, levels):
            cut = next(k for k, (_, at) in enumerate(marked) if at < 0)  # the source's root, no level of its own
            subroot, proof = marked[cut][0][0], marked[:cut] + marked[cut + 1:]
            root = refold(row[4], proof)
            folded = refold(row[6], proof) if row[6] is not None else root
            yield (row[5], grp, row[4], subroot, root,
                   [{"run": r, "at": a} for r, a in proof] if pairs else _h(proof_text(proof)), folded)

    yield from batches(rows(), pa.schema(names), max_rows=4096 if not pairs else 256)


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of op13 over a table with the columns FIELDS."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = leaf([F.col(f) if f != "text" else F.translate("text", UPPER, LOWER) for f in FIELDS])
    done = manifest(docs, other=F.when(picked, tampered), digest_only=True)
    return done.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                       F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def _oracle(levels: int = 6, tops: int = 3) -> str:
    """The same rows in DuckDB: level by level, for sources of up to 16**levels rows and up to 16**tops sources."""
    field = lambda c: f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"
    leaf_of = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    parts = [f"""rows AS MATERIALIZED (SELECT doc_id, source, {leaf_of("text")} AS leaf,
          CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 5 = 0 THEN {leaf_of(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents)""",
             """leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows)""",
             "a0 AS (SELECT source AS g, pos, leaf AS h, count(*) OVER (PARTITION BY source) AS c FROM leaves)"]

    def climb(name: str, count: int):
        for k in range(count):
            parts.append(f"""{name}s{k} AS MATERIALIZED (SELECT x.g, x.pos, x.c,
              coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos AND x.c > 1), '') AS l,
              coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos AND x.c > 1), '') AS r
              FROM {name}{k} x JOIN {name}{k} y ON x.g IS NOT DISTINCT FROM y.g AND x.pos // 16 = y.pos // 16 GROUP BY ALL)""")
            parts.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS c FROM (
              SELECT g, pos // 16 AS pos, CASE WHEN max(c) > 1 THEN sha256(string_agg(h, '' ORDER BY pos)) ELSE max(h) END AS h
              FROM {name}{k} GROUP BY g, pos // 16))""")

    climb("a", levels)
    parts.append(f"""tops AS MATERIALIZED (SELECT g, h, row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS pos FROM a{levels})""")
    parts.append("b0 AS (SELECT 0 AS g, pos, h, count(*) OVER () AS c FROM tops)")
    climb("b", tops)
    parts.append("p0 AS (SELECT doc_id, source, leaf, pos, coalesce(other, leaf) AS x, '' AS proof FROM leaves)")
    last = "p0"
    for k in range(levels):
        parts.append(f"""p{k + 1} AS (SELECT p.* REPLACE (CASE WHEN s.c > 1 THEN sha256(s.l || p.x || s.r) ELSE p.x END AS x, p.proof || s.l || s.r AS proof)
          FROM {last} p JOIN as{k} s ON p.source IS NOT DISTINCT FROM s.g AND p.pos // {16 ** k} = s.pos)""")
        last = f"p{k + 1}"
    parts.append(f"q0 AS (SELECT p.*, t.h AS subroot, t.pos AS top FROM {last} p JOIN tops t ON p.source IS NOT DISTINCT FROM t.g)")
    for k in range(tops):
        parts.append(f"""q{k + 1} AS (SELECT p.* REPLACE (CASE WHEN s.c > 1 THEN sha256(s.l || p.x || s.r) ELSE p.x END AS x, p.proof || s.l || s.r AS proof)
          FROM q{k} p JOIN bs{k} s ON p.top // {16 ** k} = s.pos)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, (SELECT h FROM b{tops}) AS root, sha256(proof) AS proof_sha256, x AS folded_root,
       x = (SELECT h FROM b{tops}) AS verified FROM q{tops}"""


ORACLE = _oracle()
