"""Substring dedup: passages of `WINDOW` words that start anywhere else as well lose all their words.

Confirming what recurs. Each window of words has an anchor, the least hash of
the phrases of `PHRASE` words inside it, so equal windows have equal anchors.
A run of neighbouring windows with one anchor is a piece. Anchors are counted
over the corpus; those met twice go into a bitmap of fixed size that is
broadcast, and only pieces whose anchor may be in it take part in what follows.
Equal pieces are counted: all windows of a piece met twice recur. Where an
anchor has several different pieces (or one that repeats a window), the windows
are counted one by one, by anchor and window hash together (128 bits); that is
exact, and a window that occurs in a third of all rows is a few rows after
partial aggregation.

Locating. The `HOT` most frequent recurring pieces become phrases of words,
dealt to `SHARDS` Aho-Corasick automata (pyahocorasick) that every document is
streamed through, so hot passages are never shuffled by occurrence. The
occurrences of all other pieces meet their recurring windows in a join by
piece, and the positions found go to their documents.

Automata over everything that recurs would not do: 35 words a window are about
35 nodes of 46 bytes, and each shard must see every document (README, figures).

* words: `[^\\x20\\x09-\\x0D]+`, unchanged. null text: none.
* windows are judged on the input, overlapping ones and those of one document included.
* rows are told apart by id and text; rows that repeat both are copies of each other and lose all
  words of their windows. A null id counts as the largest long.
* an empty table gives no rows; a very long text is cut in many narrow rows, and put together again by one task.
* text becomes the kept words joined by one space; n_words and n_removed replace columns of
  those names; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh3_64_intdigest

from flightops.llm.common import NO_ID, map_arrow
from flightops.session import stage_table

WINDOW, PHRASE = 35, 18
#: Bits (log2) of the bitmap of anchors met twice: 8 MB.
BITMAP = 26
#: Pieces located by automata, and the automata they are dealt to.
HOT, SHARDS = 4000, 4
#: Windows of one piece at most; a longer run is several pieces. Words of texts taken together.
RUN, CHUNK_BYTES = 64, 2 << 20

_B, _SALT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _SALT
    x = (x ^ (x >> np.uint64(32))) * _SALT
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Pieces:
    """The pieces of some texts, as arrays: text, first window (word position), number of windows, anchor, piece hash."""

    def __init__(self, texts: list[bytes | None], window: int = WINDOW, phrase: int = PHRASE):
        self.words = [(t or b"").split() for t in texts]  # bytes: exactly [\x20\x09-\x0D] separate
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(ends) else 0
        self.text = self.first = self.count = np.zeros(0, dtype=np.int64)
        self.anchor = self.hash = np.zeros(0, dtype=np.uint64)
        self.windows = np.zeros(0, dtype=np.uint64)  # hashes of the windows of all pieces, one after the other
        if n < window:
            return
        value = np.fromiter(map(xxh3_64_intdigest, chain.from_iterable(self.words)), dtype=np.uint64, count=n)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(value * _powers(_B, n), dtype=np.uint64)))
        back = _powers(_INVERSE, n)
        short = _mix((sums[phrase:] - sums[:-phrase]) * back[:n - phrase + 1])
        long = _mix((sums[window:] - sums[:-window]) * back[:n - window + 1] + _B)
        least, width, wanted = short, 1, window - phrase + 1
        while width < wanted:  # least of the phrases inside each window
            step = min(width, wanted - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        least = least[:len(long)]
        of = np.repeat(np.arange(len(sizes)), sizes)
        at = np.flatnonzero(of[:len(long)] == of[window - 1:window - 1 + len(long)])
        if not len(at):
            return
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))
        new |= (np.arange(len(at)) - start) % RUN == 0
        begin = np.flatnonzero(new)
        self.count = np.diff(np.append(begin, len(at)))
        self.text, self.anchor = of[at[begin]], least[at[begin]]
        self.first = at[begin] - (ends - sizes)[self.text]
        self.windows = long[at]
        place = np.arange(len(at)) - np.repeat(begin, self.count)
        parts = _mix(self.windows * (np.uint64(2) * place.astype(np.uint64) + np.uint64(3)))
        self.hash = _mix(np.add.reduceat(parts, begin) + self.count.astype(np.uint64))

    def chosen(self, keep: np.ndarray) -> np.ndarray:
        """Window hashes of some pieces."""
        return self.windows[np.repeat(keep, self.count)]

    def doubled(self) -> np.ndarray:
        """Pieces that hold one window twice."""
        if not len(self.count):
            return np.zeros(0, dtype=bool)
        piece = np.repeat(np.arange(len(self.count)), self.count)
        order = np.lexsort((self.windows, piece))
        twice = (self.windows[order][1:] == self.windows[order][:-1]) & (piece[order][1:] == piece[order][:-1])
        out = np.zeros(len(self.count), dtype=bool)
        out[piece[order][1:][twice]] = True
        return out


def _chunks(part: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of bounded text."""
    at = size = 0
    for i, x in enumerate(part.column(column)):
        size += x.as_buffer().size if x.is_valid else 0
        if size >= CHUNK_BYTES or i + 1 == part.num_rows:
            yield part.slice(at, i + 1 - at)
            at, size = i + 1, 0


def _scan(docs: DataFrame, names: str, make) -> DataFrame:
    """`make(pieces, id, tag)` gives columns for each slice of (id, tag, text)."""
    fields = [f.split() for f in names.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for some in _chunks(part, 2):
                cols = make(Pieces(some.column(2).to_pylist()), *(some.column(k).to_numpy() for k in (0, 1)))
                if cols is not None and len(cols[0]):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=kinds[kind])
                                                      for c, (_, kind) in zip(cols, fields)], names=[name for name, _ in fields])

    return map_arrow(docs, run, ", ".join(f"{a} {b}" for a, b in fields))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _in_bitmap(bitmap: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    at = anchor >> np.uint64(64 - BITMAP)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def _bitmap(docs: DataFrame) -> np.ndarray:
    """Anchors met twice. What reaches the driver is at most one row for each 64 bits."""
    def make(p: Pieces, *_):
        keys, at = np.unique(p.anchor, return_inverse=True)
        times = np.bincount(at, weights=1 + p.doubled(), minlength=len(keys)).astype(np.int32) if len(keys) else at
        return _signed(keys), times

    twice = _scan(docs, "anchor long, times int", make).groupBy("anchor").agg(F.sum("times").alias("times")).where("times >= 2")
    place = F.shiftrightunsigned("anchor", 64 - BITMAP)
    bits = (twice.select(F.shiftright(place, 6).alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(anchor, {64 - BITMAP}) & 63 as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits"))).toArrow()
    out = np.zeros(1 << (BITMAP - 6), dtype=np.uint64)
    out[bits.column(0).to_numpy()] = bits.column(1).to_numpy().view(np.uint64)
    return out


def _recurring(docs: DataFrame, bitmap) -> DataFrame:
    """(anchor, piece, n, width, which): pieces with recurring windows; `which` lists them by their place, null for all."""
    def make(p: Pieces, *_):
        keep = _in_bitmap(bitmap.value, p.anchor)
        count = p.count[keep]
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), type=pa.int32()),
                                         pa.array(_signed(p.chosen(keep))))
        return _signed(p.anchor[keep]), _signed(p.hash[keep]), lists

    met = (_scan(docs, "anchor long, piece long, windows array<long>", make).groupBy("anchor", "piece")
           .agg(F.count(F.lit(1)).alias("n"), F.first("windows").alias("windows"))
           .withColumn("own", F.size(F.array_distinct("windows")) < F.size("windows")))
    met = stage_table(met, "pieces")
    # a window can only be found again in another piece of its anchor, or in its own piece
    mixed = stage_table(met.groupBy("anchor").agg(F.count(F.lit(1)).alias("pieces"), F.max("own").alias("own"))
                        .where("pieces >= 2 or own").select("anchor"), "mixed")
    each = (met.join(mixed, "anchor", "left_semi")
            .select("anchor", "piece", "n", F.posexplode("windows").alias("place", "window")))
    again = (each.groupBy("anchor", "window").agg(F.sum("n").alias("total")).where("total >= 2").select("anchor", "window"))
    again = stage_table(again, "windows")
    some = (each.where("n = 1").join(again, ["anchor", "window"]).groupBy("anchor", "piece")
            .agg(F.collect_list("place").alias("which")))
    whole = met.where("n >= 2").select("anchor", "piece", "n", F.size("windows").alias("width"), F.lit(None).cast("array<int>").alias("which"))
    return stage_table(whole.unionByName(some.select("anchor", "piece", F.lit(1).cast("long").alias("n"), F.lit(0).alias("width"), "which")),
                       "recurring")


def _phrases(docs: DataFrame, recurring: DataFrame, hot: int) -> tuple[np.ndarray, list[bytes]]:
    """Keys of the most frequent pieces, and their words. At most `hot` phrases reach the driver."""
    top = (recurring.where("which is null").orderBy(F.desc("n"), "anchor", "piece").limit(hot).select("anchor", "piece").toArrow())
    keys = np.sort(_key(*(top.column(k).to_numpy().view(np.uint64) for k in (0, 1))))
    if not len(keys):
        return keys, []
    shared = docs.sparkSession.sparkContext.broadcast(keys)

    def make(p: Pieces, *_):
        key = _key(p.anchor, p.hash)
        keep = _known(shared.value, key)
        firsts: dict[int, bytes] = {}
        for i in np.flatnonzero(keep).tolist():
            if int(key[i]) not in firsts:
                a = int(p.first[i])
                firsts[int(key[i])] = b" ".join(p.words[int(p.text[i])][a:a + int(p.count[i]) + WINDOW - 1])
        return pa.array(np.array(list(firsts), dtype=np.uint64).view(np.int64)), pa.array(list(firsts.values()), type=pa.binary())

    found = _scan(docs, "key long, phrase binary", make).groupBy("key").agg(F.min("phrase").alias("phrase")).toArrow()
    return keys, found.column(1).to_pylist()


def _key(anchor: np.ndarray, piece: np.ndarray) -> np.ndarray:
    return _mix(anchor * np.uint64(3) + piece)


def _known(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool)
    return keys[np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)] == wanted


def _others(docs: DataFrame, recurring: DataFrame, bitmap, hot_keys) -> DataFrame:
    """(id, tag, spans): first and last recurring window of each run, for the pieces that no automaton holds."""
    def make(p: Pieces, id_, tag):
        keep = _in_bitmap(bitmap.value, p.anchor) & ~_known(hot_keys.value, _key(p.anchor, p.hash))
        text = p.text[keep]
        return (_signed(p.anchor[keep]), _signed(p.hash[keep]), id_[text], tag[text], p.first[keep].astype(np.int32),
                p.count[keep].astype(np.int32))

    met = _scan(docs, "anchor long, piece long, id long, tag long, first int, width int", make)
    joined = met.join(recurring.select("anchor", "piece", "which"), ["anchor", "piece"])
    starts = F.when(F.col("which").isNull(), F.array(F.struct(F.col("first").alias("a"), (F.col("first") + F.col("width") - 1).alias("b")))) \
        .otherwise(F.transform("which", lambda i: F.struct((F.col("first") + i).alias("a"), (F.col("first") + i).alias("b"))))
    return (joined.select("id", "tag", starts.alias("spans")).groupBy("id", "tag")
            .agg(F.flatten(F.collect_set("spans")).alias("spans")))  # rows that repeat id and text give the same spans


class Automata:
    """Phrases in a few Aho-Corasick automata over bytes, with a space on both sides of each phrase."""

    def __init__(self, phrases: list[bytes], shards: int = SHARDS):
        self.shards = []
        for s in range(shards):
            own = ahocorasick.Automaton()
            for phrase in phrases[s::shards]:
                key = f" {phrase.decode('latin-1')} "
                own.add_word(key, len(key))
            if len(own):
                own.make_automaton()
                self.shards.append(own)

    def spans(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(first word, number of words) of every occurrence."""
        if not self.shards or len(words) < WINDOW:
            return []
        line = f" {b' '.join(words).decode('latin-1')} "
        starts = None
        out = []
        for own in self.shards:
            for end, size in own.iter(line):
                if starts is None:
                    starts = np.fromiter(accumulate((len(w) + 1 for w in words), initial=0), dtype=np.int64)
                a = int(np.searchsorted(starts, end + 1 - size))
                out.append((a, int(np.searchsorted(starts, end)) - a))
        return out


_built: dict[int, Automata] = {}


def _automata(phrases: list[bytes]) -> Automata:
    """Built once a worker, kept from task to task."""
    key = hash(tuple(phrases))
    if key not in _built:
        _built.clear()
        _built[key] = Automata(phrases)
    return _built[key]


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """`docs` with the kept words in `text_col`, n_words and n_removed (long)."""
    sc = docs.sparkSession.sparkContext
    base = docs.withColumns({"_sd_id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)),
                             "_sd_text": F.col(f"`{text_col}`").cast("binary")})
    base = base.withColumn("_sd_tag", F.coalesce(F.xxhash64("_sd_text"), F.lit(0)))
    narrow = base.select(F.col("_sd_id").alias("id"), F.col("_sd_tag").alias("tag"), F.col("_sd_text").alias("text"))
    bitmap = sc.broadcast(_bitmap(narrow))
    recurring = _recurring(narrow, bitmap)
    keys, phrases = _phrases(narrow, recurring, hot)
    hot_keys, shared = sc.broadcast(keys), sc.broadcast(phrases)
    spans = _others(narrow, recurring, bitmap, hot_keys)
    names = [c for c in docs.columns if c not in (text_col, "n_words", "n_removed")]
    given = (base.join(spans.select(F.col("id").alias("_sd_id"), F.col("tag").alias("_sd_tag"), F.col("spans").alias("_sd_spans")), ["_sd_id", "_sd_tag"], "left")
             .select(*[F.col(f"`{c}`") for c in names], "_sd_text", F.col("_sd_spans.a").alias("_sd_a"), F.col("_sd_spans.b").alias("_sd_b")))
    out = StructType([*(docs.schema[c] for c in names), StructField(text_col, StringType()),
                      StructField("n_words", LongType()), StructField("n_removed", LongType())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = _automata(shared.value)
        for part in parts:
            k = part.num_columns
            for some in _chunks(part, k - 3):
                texts, counts, removed = [], [], []
                for text, a, b in zip(*(some.column(i) for i in (k - 3, k - 2, k - 1))):
                    words = (text.as_py() or b"").split()
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    if a.is_valid:
                        np.add.at(gone, a.values.to_numpy(), 1)
                        np.add.at(gone, b.values.to_numpy() + WINDOW, -1)
                    for first, n in automata.spans(words):
                        gone[first] += 1
                        gone[first + n] -= 1
                    keep = np.cumsum(gone)[:-1] == 0
                    texts.append(b" ".join(words if keep.all() else [w for w, y in zip(words, keep.tolist()) if y]))
                    counts.append(len(words))
                    removed.append(int((~keep).sum()))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:k - 3], pa.array(texts, type=pa.binary()).cast(pa.string()), pa.array(counts, type=pa.int64()),
                     pa.array(removed, type=pa.int64())], names=out.names)

    return map_arrow(given, run, out)


def digest(docs: DataFrame) -> DataFrame:
    """Contract columns of op9 over a table with doc_id and text."""
    return remove(docs.select("doc_id", "text")).select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = f"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents
), s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS a FROM w WHERE len(words) >= {WINDOW}
), r AS (
  SELECT doc_id, a FROM (SELECT doc_id, a, md5(array_to_string(words[a:a + {WINDOW - 1}], ' ')) AS k FROM s) h
  QUALIFY count(*) OVER (PARTITION BY k) > 1
), g AS (
  SELECT DISTINCT doc_id, a + i AS pos FROM r, range({WINDOW}) t(i)
), u AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w
), k AS (
  SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.pos) FILTER (g.pos IS NULL) AS kept, count(g.pos) AS gone
  FROM u LEFT JOIN g ON g.doc_id = u.doc_id AND g.pos = u.pos GROUP BY u.doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""
