"""Line dedup: lines whose key occurs in several documents stay only in the first of them.

Lines are exploded and normalised, their keys hashed to 128 bits, the distinct
documents of each hash counted, and the lines of hashes over the threshold
dropped everywhere but in the document with the smallest id. What is left is
put together again by position. DataFrame functions only.

* null text: one empty line; null id: counts as the largest long.
* rows with one id count as one document; each row keeps or loses its own lines.
* several lines with one key in the keeping document all stay.
* an empty table gives no rows; a very long text is split and joined again by one task.
* every other column passes through; n_lines and n_dropped replace columns of those names.

Skew: a line that a third of the rows share is one row per map task in the
count (partial aggregation on hash and document, then on hash). The counted
side, one row a hash, is written to the shared folder, so that both sides of
the join back are dealt for the join alone and AQE can split the hot one.
Only ids, positions and hashes take part in these shuffles; the texts are
shuffled once, to meet the positions to drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import NO_ID, WHITE, ascii_lower_key
from flightops.session import stage_table

MIN_CHARS, MIN_DOCS = 10, 2


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`docs` with the remaining text in `text_col`, and n_lines (before) and n_dropped, both long."""
    base = docs.withColumns({"_ld_id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)),
                             "_ld_text": F.coalesce(F.col(f"`{text_col}`"), F.lit(""))})
    base = base.withColumn("_ld_tag", F.xxhash64("_ld_text"))
    lines = (base.select("_ld_id", "_ld_tag", F.posexplode(F.split("_ld_text", "\n", -1)).alias("_ld_pos", "_ld_line"))
             .withColumn("_ld_line", trimmed(F.col("_ld_line")))
             .where(F.char_length("_ld_line") >= min_chars)
             .withColumn("_ld_line", ascii_lower_key(F.col("_ld_line")))
             .select("_ld_id", "_ld_tag", "_ld_pos", F.xxhash64("_ld_line").alias("_ld_h1"),
                     F.xxhash64(F.lit("line"), "_ld_line").alias("_ld_h2")))
    repeated = (lines.groupBy("_ld_h1", "_ld_h2")
                .agg(F.countDistinct("_ld_id").alias("_ld_docs"), F.min("_ld_id").alias("_ld_keeper"))
                .where(F.col("_ld_docs") >= min_docs).drop("_ld_docs"))
    repeated = stage_table(repeated, "lines")
    drops = (lines.join(repeated, ["_ld_h1", "_ld_h2"])
             .where(F.col("_ld_id") != F.col("_ld_keeper"))
             .groupBy("_ld_id", "_ld_tag").agg(F.collect_set("_ld_pos").alias("_ld_drop")))
    split = (base.join(drops, ["_ld_id", "_ld_tag"], "left")
             .withColumn("_ld_lines", F.split("_ld_text", "\n", -1))
             .withColumns({"n_lines": F.size("_ld_lines").cast("long"),
                           "n_dropped": F.coalesce(F.size("_ld_drop"), F.lit(0)).cast("long")}))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.col("_ld_drop"))
    kept = F.when(F.col("_ld_drop").isNull(), F.col("_ld_text")).otherwise(
        F.array_join(F.transform(stay, lambda p: F.get(F.col("_ld_lines"), p)), "\n"))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return split.withColumn(text_col, kept).select(*[F.col(f"`{c}`") for c in names], "n_lines", "n_dropped")


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of op5 over a table with doc_id and text."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), r AS (
  SELECT key, min(doc_id) AS keeper FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), d AS (
  SELECT k.*, coalesce(k.doc_id <> r.keeper, false) AS dropped FROM k LEFT JOIN r USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (dropped))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id
"""
