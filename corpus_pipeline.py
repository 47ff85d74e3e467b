"""Documents to training tokens in five stages, each written as Parquet and read again by the next.

1. toxicity: documents predicted toxic go; labels of the corpus train the models.
2. line dedup: repeated lines go from all documents but the first that holds them.
3. SimHash near-dedup: the document with the smallest id of each group stays.
4. benchmark decontamination: documents that hold an item of `benchmark`, also with word edits, go.
5. byte-level BPE: token ids, their number, and whether they decode to the text's bytes.

A text that line dedup empties stays as an empty document until the near-dedup,
where all empty documents are one group. n_chars follows the text.

* null or empty text: scored and encoded as empty; one of all such documents stays in the near-dedup.
* null or repeated ids: rows are told apart by their texts; a null id counts as the largest.
* repeated rows: both stay until the near-dedup, where rows equal in id and text stay together.
* ties: of equal ids in a group the smallest fingerprint and text hash stays.
* very long texts are read whole, in batches of bounded size or one text. An empty table gives no rows.
* other columns pass through all stages untouched, also if they have the name of a result of a stage; then
  the last stage calls its own result `bpe_` and the name.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightops.llm import bpe, decontam, line_dedup, simhash_dedup, toxicity
from flightops.llm.common import read
from flightops.session import stage_table


def _apart(docs: DataFrame, names: set[str], run: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, Column]]:
    """`run` over `docs` whose columns of these names wait under others, and the columns of `docs` by name."""
    mine = {c: f"_kept_{c}" for c in docs.columns if c.lower() in names}
    return run(docs.withColumnsRenamed(mine)), {c: F.col(f"`{mine.get(c, c)}`").alias(c) for c in docs.columns}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity.score(docs, read(spark, sf_dir, "labels"), out_col="_tx_score")
    return scored.where(F.col("_tx_score") < toxicity.THRESHOLD).drop("_tx_score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done, own = _apart(docs, {"n_lines", "n_dropped"}, line_dedup.drop_repeated_lines)
    own["n_chars"] = F.char_length("text").cast("long").alias("n_chars")
    return done.select(*own.values())


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    done, own = _apart(docs, {"n_tokens", "ids", "decoded", "round_trip"}, lambda df: bpe.round_trip(df, ranks, public_tokenizers.PATTERN))
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    taken = {c.lower() for c in docs.columns}
    made = {"n_tokens": F.col("n_tokens"), "ids": F.col("ids"), "round_trip": same}
    return done.select(*own.values(), *[c.alias(f"bpe_{name}" if name in taken else name) for name, c in made.items()])


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("simhash_dedup", drop_near_copies),
          ("decontamination", drop_benchmark), ("byte_bpe", to_tokens)]

#: The toxicity models, the fingerprints and the tokens have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
