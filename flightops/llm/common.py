"""Helpers shared by the operators: reading tables, native text pieces, checked broadcasts."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every contract: [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = "[\\x20\\x09-\\x0D]+"
#: A missing document id counts as this one.
NO_ID = 2**63 - 1
#: A side with at most this many rows may be broadcast (16 bytes a row: 32 MB).
BROADCAST_ROWS = 2_000_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow, with the folder that holds this package on the Python path of local workers.

    On a cluster the package is installed or sent along (--py-files); there the entry does no harm.
    """
    given = df.sparkSession.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = given.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        given["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
    return df.mapInArrow(run, schema)


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as an array (null: empty)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE_RUN), "")


def ascii_lower_key(text: Column) -> Column:
    """Equal for two strings exactly if they are equal once A-Z are lower-cased.

    The UTF-8 bytes are read as one character each and those are lower-cased.
    That also moves the lead bytes C0-DE of other characters to E0-FE, always
    in the same way, and the number of continuation bytes that follow still
    tells the two apart, so no two different strings meet. It is a key, not a
    text to show.
    """
    return F.lower(F.decode(text.cast("binary"), "ISO-8859-1"))


def join_checked(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
                 max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join; `small` (a few narrow columns) is broadcast only if a count shows at most `max_rows` rows.

    Beyond that the ordinary shuffled join gives the same rows.
    """
    if small.count() <= max_rows:
        small = F.broadcast(small)
    return big.join(small, on, how)


def by_bytes(part: pa.RecordBatch, column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose values of a text or binary column have at most so many bytes together, or of one row."""
    first = held = 0
    for k, size in enumerate(pc.fill_null(pc.binary_length(part.column(column)), 0).to_pylist()):
        if k > first and held + size > most:
            yield part.slice(first, k - first)
            first, held = k, 0
        held += size
    if first < part.num_rows:
        yield part.slice(first)


def batches(rows: Iterable[tuple], schema: pa.Schema, max_bytes: int = 8 << 20, max_rows: int = 4096,
            weigh=lambda row: sum(len(x) for x in row if isinstance(x, (bytes, str)))) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded size from a stream of rows."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += weigh(row)
        if size >= max_bytes or len(held) >= max_rows:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def crc32_sql(text: str) -> str:
    """DuckDB expression: unsigned crc32 of a text's UTF-8 bytes."""
    hexed = f"hex(encode({text}))"
    digit = lambda at: f"instr('0123456789ABCDEF', substr({hexed}, {at}, 1)) - 1"
    each = f"list_transform(range(1, length({hexed}), 2), lambda i: (({digit('i::INT')}) * 16 + ({digit('i::INT + 1')}))::BIGINT)"
    bit = "lambda c, z: xor(c >> 1, (c & 1) * 3988292384)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {each}), "
            f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bit})), 4294967295::BIGINT)")
