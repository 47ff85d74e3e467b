"""Target-distribution importance resampling: hashed-feature gains, Gumbel draws, ranks by regular sampling.

Features are runs of words hashed to a fixed number of buckets. The counts of
the raw table and of the target give each bucket a gain, one array that scores
every text by lookup. A text's weight is its mean gain; its score adds Gumbel
noise from a hash of its id, so the highest scores are a draw without
replacement with chances in proportion to exp(weight / 1000).

Ranks come from parallel sorting by regular sampling:

1. every partition sorts its scored rows and writes them as a run;
2. of every run each `stride`-th row is a sample; the sorted samples give regular splitters;
3. runs cut at the splitters are exchanged, one range of the order a partition;
4. a partition merges its segments; the counts of earlier ranges plus the place give the exact rank.

The order ends with (run, place), so ties, however many, are split like other rows.
Some SAMPLES narrow rows a range reach the driver, one row of tens of thousands;
the splitters only balance the ranges and do not touch the ranks.

* null or empty text: no features, weight 0, not eligible (too few words); the row stays, rank null.
* null id: hashed as the empty text, last among ties.
* rows that share an id share their noise; equal rows are ranked one after the other.
* an empty target or table: gains follow the formula with zero counts; an empty table gives no rows.
* very long texts: counted in Python one text at a time; columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightops.llm.common import NO_ID, crc32_sql, map_arrow
from flightops.session import stage_table

BUCKETS, LEAST, MOST, MIN_WORDS, SHARE, SEED = 10_000, 1, 1, 20, 10, 2024
#: Samples aimed at for each range of the order (at most twice as many are collected); rows of one range.
SAMPLES, RANGE_ROWS = 32, 1_000_000

#: Digits, a-z and all beyond ASCII are letters of words; A-Z are lower-cased, the rest separates.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def buckets_of(text: bytes | None, buckets: int = BUCKETS, least: int = LEAST, most: int = MOST) -> np.ndarray:
    """The bucket of every run of `least` to `most` words."""
    words = text.translate(_FOLD).split() if text else []
    made = []
    for n in range(least, most + 1):
        runs = words if n == 1 else map(b" ".join, zip(*(words[k:] for k in range(n))))
        made.append(np.fromiter(map(crc32, runs), dtype=np.int64, count=max(0, len(words) - n + 1)))
    return np.concatenate(made) % buckets if made else np.zeros(0, np.int64)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, least: int = LEAST, most: int = MOST) -> np.ndarray:
    """How often each bucket occurs in all texts: `buckets` numbers, whatever the table's size."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for part in parts:
            for text in part.column(0):
                total += np.bincount(buckets_of(text.as_py(), buckets, least, most), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counted = map_arrow(texts.select(F.col(f"`{text_col}`").cast("binary").alias("text")), run, "bucket long, n long")
    got = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, dtype=np.int64)
    out[got.column("bucket").to_numpy()] = got.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of each bucket."""
    all_raw, all_target, k = float(raw.sum()), float(target.sum()), float(len(raw))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_raw + k) / ((s + 1.0) * (all_target + k))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def noise(id_: int | None, seed: int = SEED) -> int:
    """floor(-1000 ln(-ln u)) with u from the id's hash."""
    h = int(hashlib.sha256(f"{seed}:{'' if id_ is None else id_}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
           buckets: int = BUCKETS, least: int = LEAST, most: int = MOST, seed: int = SEED) -> DataFrame:
    """(id, tag, n_words, n_features, weight, score): one row per row of `docs`; tag is a hash of the text."""
    array = gains(bucket_counts(docs, text_col, buckets, least, most), bucket_counts(target, target_col, buckets, least, most))
    shared = docs.sparkSession.sparkContext.broadcast(array)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for part in parts:
            ids, rows = part.column(0).to_pylist(), []
            for id_, text in zip(ids, part.column(2)):
                raw = text.as_py()
                found = buckets_of(raw, buckets, least, most)
                words = len(found) if (least, most) == (1, 1) else len(raw.translate(_FOLD).split()) if raw else 0
                weight = int(gain[found].sum()) // len(found) if len(found) else 0
                rows.append((words, len(found), weight, weight + noise(id_, seed)))
            made = [pa.array(c, type=pa.int64()) for c in zip(*rows)] if rows else [pa.array([], type=pa.int64())] * 4
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *made],
                                             names=["id", "tag", "n_words", "n_features", "weight", "score"])

    text = F.col(f"`{text_col}`").cast("binary")
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("tag"), text.alias("text"))
    return map_arrow(given, run, "id long, tag long, n_words long, n_features long, weight long, score long")


def ranks(rows: DataFrame, eligible: Column, order: list[str], share: int = SHARE, samples: int = SAMPLES,
          range_rows: int = RANGE_ROWS) -> DataFrame:
    """`rows` with `rank`: 1, 2, 3... by the long columns `order` (ascending, none null) among the eligible rows,
    as far as `share` per cent of them reach; null for all others."""
    spark = rows.sparkSession
    by = [F.col("_is_out"), *[F.col(c) for c in order]]
    runs = rows.withColumn("_is_out", ~F.coalesce(eligible, F.lit(False))).sortWithinPartitions(*by)
    runs = stage_table(runs.withColumns({"_is_run": F.spark_partition_id().cast("long"),
                                         "_is_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "runs")
    inside, keys = runs.where("not _is_out"), [*order, "_is_run", "_is_at"]
    n = inside.count()
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // range_rows))
    stride = max(1, n // (samples * ranges))
    # a run of m rows gives at most m / stride + 1/2 samples, and none below half a stride
    found = inside.where(F.col("_is_at") % stride == stride // 2).select(*keys).toArrow()
    sample = sorted(zip(*(found.column(k).to_pylist() for k in keys)))
    splitters = sorted({sample[k * len(sample) // ranges] for k in range(1, ranges)}) if sample else []
    shared = spark.sparkContext.broadcast(splitters)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for part in parts:
            key = zip(*(part.column(k).to_pylist() for k in keys))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([bisect_left(at, x) for x in key], type=pa.int32())],
                                             names=[*part.schema.names, "_is_range"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inside.schema.fields)
    dealt = map_arrow(inside, cut, f"{kinds}, _is_range int").repartitionById(ranges, F.col("_is_range"))
    merged = stage_table(dealt.sortWithinPartitions("_is_range", *keys).withColumn(
        "_is_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "merged")
    sizes = merged.groupBy("_is_range").agg(F.count(F.lit(1)).alias("_is_size"))
    before = sizes.select("_is_range", F.coalesce(F.sum("_is_size").over(
        Window.orderBy("_is_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_is_before"))
    rank = F.col("_is_before") + F.col("_is_place") + 1
    drawn = merged.join(F.broadcast(before), "_is_range").select(
        *rows.columns, F.when(rank <= share * n // 100, rank).cast("long").alias("rank"))
    return drawn.unionByName(runs.where("_is_out").select(*rows.columns, F.lit(None).cast("long").alias("rank")))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
             share: int = SHARE, samples: int = SAMPLES, range_rows: int = RANGE_ROWS, **how) -> DataFrame:
    """(id, tag, n_words, n_features, weight, score, rank): one row per row of `docs`; drawn rows have a rank."""
    rows = scored(docs, target, id_col, text_col, **how)
    rows = rows.withColumns({"_is_low": -F.col("score"), "_is_id": F.coalesce("id", F.lit(NO_ID))})
    return ranks(rows, F.col("n_words") >= min_words, ["_is_low", "_is_id", "n_features"], share, samples, range_rows).drop("_is_low", "_is_id")


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The drawn rows of `docs` with all their columns; of equal rows all stay if one is drawn."""
    drawn = resample(docs, target, id_col, text_col, **how).where("rank is not null").select(F.col("id").alias("_is_id"), F.col("tag").alias("_is_tag"))
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col("_is_id")) & (F.xxhash64(F.col(f"`{text_col}`").cast("binary")) == F.col("_is_tag"))
    return docs.join(drawn.distinct(), same, "left_semi")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Contract columns of op12 over a table with doc_id and text."""
    return resample(docs, benchmark).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


def _words_sql(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({folded}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


ORACLE = f"""
WITH d AS (SELECT doc_id, unnest({_words_sql("text")}) AS w FROM documents),
b AS (SELECT unnest({_words_sql("text")}) AS w FROM benchmark),
v AS MATERIALIZED (SELECT w, {crc32_sql("w")} % {BUCKETS} AS k FROM (SELECT DISTINCT w FROM (SELECT w FROM d UNION ALL SELECT w FROM b))),
s AS (SELECT k, count(*) AS s FROM d JOIN v USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN v USING (w) GROUP BY k),
g AS (SELECT k, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM d) + {BUCKETS})::DOUBLE
        / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
      FROM (SELECT DISTINCT k FROM v) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
f AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM d JOIN v USING (w) JOIN g USING (k) GROUP BY doc_id),
h AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, list_reduce(
        list_transform(range(1, 9), lambda i: (instr('0123456789abcdef', substr(sha256('{SEED}:' || doc_id::VARCHAR), i::INT, 1)) - 1)::BIGINT),
        lambda x, y: x * 16 + y) AS h FROM documents LEFT JOIN f USING (doc_id)),
e AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score FROM h),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM e WHERE n_features >= {MIN_WORDS})
SELECT doc_id, n_features, weight, score,
       CASE WHEN rank <= (SELECT {SHARE} * count(*) // 100 FROM r) THEN rank END::BIGINT AS rank
FROM e LEFT JOIN r USING (doc_id)
"""
