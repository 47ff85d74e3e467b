"""Toxicity by two class-conditional Kneser-Ney bigram models over one hashed vocabulary.

Counts come from every training text: for each word pair how often it occurs in
toxic and in ordinary documents. A model has three levels. Pairs keep
their discounted share after a context; the rest of the mass, one weight a
context shared by both classes, goes to the class's continuation counts (in how
many contexts a word occurs); their own rest goes to the continuation counts of
both classes together, to which every word adds `PRIOR` pseudo-counts. Rare
expressions that neither class has counted well so get nearly the same
likelihood from both; words that neither class has in two contexts are not kept. Exact copies count once, with the label of most of them.

Discounts are 1 for a count of one and 1.5 above. A pair that always follows
one and the same word in a class (31 bins) counts once there, as Kneser-Ney
counts do, so a passage that documents share is little evidence. Pairs without
discounted mass in the toxic class get what their words have in both classes.

Counts are exact: one pass counts every pair of every training text, for the
rows that fit the curve and for the others apart, and both models come from it.
They are tables whose size follows the corpus. Of at most `MODEL_ROWS` rows
(counted) the evidence is broadcast, 8 bytes a row, in slices by ranges of words;
a worker takes one slice after the other for some MB of text, so its memory does
not follow the model. Larger models are joined to the distinct words and
pairs of the documents, so that every document brings its own part of the model.
All ways give the same scores. Words are told apart by 32-bit hashes.

A text's evidence is the difference of the two log-likelihoods, normalised by
length: over the whole text, and over the runs of one and of `WINDOW`
neighbouring words where it is largest, so that one expression in a long text
counts. A logistic curve over the three makes the score. It is fitted on at most
a quarter of the training rows and at most `CURVE_ROWS`, with the evidence of a
model that counts all others; the model that scores counts all training rows.

* words: A-Z lower-cased, everything in ASCII that is no letter separates.
* null or empty text: no evidence; the score is the curve's value at zero.
* several label rows of a document: toxic if one says so; null labels are ignored.
* null ids are never trained on; rows sharing an id share their label.
* if the rows of the curve lack a class, the fixed curve `DEFAULT` is used.
* very long texts: batches hold some MB of text or one text; ties and repeated rows score alike.
* an empty table gives no rows; without labels, or with one class, the fixed curve scores all rows.
* other columns pass through; `out_col` replaces a column of that name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from flightops.llm.common import by_bytes, join_checked, map_arrow
from flightops.session import stage_table

WINDOW = 4
#: Pseudo-counts of a word at the shared level; of what a pair is seen and expected to be seen in a class.
PRIOR, PAIR_PRIOR = 10.0, 4.0
#: Rows of the model that may be broadcast (8 bytes a word or pair); rows of a slice of it, of which a worker holds one or two.
MODEL_ROWS, PART_ROWS = 256_000_000, 1_000_000
#: Bytes of text taken at once, with one or two slices of the model or with more; of text that a slice of the pairs counts.
TEXT_BYTES, PART_BYTES, SLICE_BYTES = 3 << 20, 8 << 20, 4 << 20
#: Counted pairs that a worker gathers before it merges them.
HELD_ROWS = 1 << 20
#: At most this many rows of a quarter, those with the smallest hash of their id, fit the curve.
CURVE_ROWS = 20_000
#: Bias, weights of the whole text, the strongest word and the strongest window.
DEFAULT = (-6.0, 1.0, 2.0, 1.0)
FEATURES = ("_tx_whole", "_tx_word", "_tx_run")
THRESHOLD = 0.7

#: ASCII letters lower-cased, other ASCII a space, bytes of other characters as they are.
_FOLD = bytes(b if b >= 128 else ord(chr(b).lower()) if chr(b).isalpha() else 32 for b in range(256))


def tokens(text: bytes | None) -> np.ndarray:
    """A 32-bit number for each word."""
    return np.array(list(map(crc32, text.translate(_FOLD).split())), dtype=np.uint32) if text else np.zeros(0, np.uint32)


def _batch_tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, word before it or 0 in front, number of words of each text), texts one after the other."""
    each = [tokens(t) for t in texts]
    sizes = np.array([len(x) for x in each], dtype=np.int64)
    now = np.concatenate(each) if each else np.zeros(0, np.uint32)
    return now, _before(now, sizes), sizes


def _before(now: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """What stands one place earlier in the same text, or 0."""
    out = np.zeros_like(now)
    out[1:] = now[:-1]
    out[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    return out


def fold(id_: Column) -> Column:
    """crc32 of the id as text (0 for null)."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")), F.lit(0))


def held_out(id_: Column) -> Column:
    return fold(id_) % 3 == 1


#: What is counted of a pair: occurrences in toxic and ordinary texts, and words (31 bins) in front of it in toxic
#: texts; each for the rows that the curve leaves to its own model, and for the rows of the curve.
_COUNTS, _SEEN = 4, 2
_BLOBS = "kind int, slice int, held binary"
_SUMS = ("kind", "key", "t0", "o0", "t1", "o1", "tm0", "om0", "rest0", "tm1", "om1", "rest1")


def pack(cols: list[np.ndarray]) -> bytes:
    """Columns of whole numbers, the first one sorted, as few bytes."""
    first = cols[0].astype(np.uint64)
    out = [np.uint64(len(first)).tobytes()]
    for c in (np.diff(first, prepend=np.uint64(0)), *cols[1:]):
        wide = (int(c.max()).bit_length() + 7) // 8 if len(c) else 0
        out += [bytes([wide]), np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes()]
    return compress(b"".join(out), 1)


def unpack(held: bytes) -> list[np.ndarray]:
    held = decompress(held)
    n, at, cols = int(np.frombuffer(held[:8], np.uint64)[0]), 8, []
    while at < len(held):
        wide = held[at]
        c = np.zeros((n, 8), np.uint8)
        c[:, :wide] = np.frombuffer(held, np.uint8, n * wide, at + 1).reshape(wide, n).T
        cols.append(c.view("<u8").ravel())
        at += 1 + n * wide
    return [np.cumsum(cols[0], dtype=np.uint64), *cols[1:]]


def _merged(parts: list[list[np.ndarray]], sums: int) -> list[np.ndarray]:
    """Rows of one key as one row: so many columns are added up, the others joined bit by bit."""
    cols = [np.concatenate(c) for c in zip(*parts)]
    order = np.argsort(cols[0], kind="stable")
    key = cols[0][order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), bool), key[1:] != key[:-1])))
    if len(first) == len(key):
        return [c[order] for c in cols]
    return [key[first], *[np.add.reduceat(c[order], first, dtype=c.dtype) for c in cols[1:1 + sums]],
            *[np.bitwise_or.reduceat(c[order], first) for c in cols[1 + sums:]]]


def _dealt(kind: int, of: np.ndarray, cols: list[np.ndarray], slices: int) -> pa.RecordBatch:
    """The rows (sorted by the first column) packed by a hash of `of`."""
    slice_ = ((of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) % np.uint64(slices)
    order = np.argsort(slice_, kind="stable")
    found, first = np.unique(slice_[order], return_index=True)
    held = [pack([c[at] for c in cols]) for at in np.split(order, first[1:])] if len(order) else []
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), kind, np.int32)), pa.array(found.astype(np.int32)),
                                       pa.array(held, pa.binary())], names=["kind", "slice", "held"])


def _pairs(train: DataFrame, slices: int) -> DataFrame:
    """The counts of the pairs of (text, toxic, left), packed by slices; a pair's key is word << 32 | word before it."""
    def counted(part: pa.RecordBatch) -> list[np.ndarray]:
        toxic, left = (part.column(k).to_numpy(zero_copy_only=False).astype(bool) for k in (1, 2))
        now, before, sizes = _batch_tokens(part.column(0).to_pylist())
        key = now.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64)
        bit = np.uint32(1) << (_before(before, sizes) % np.uint32(31))
        of, late = (np.repeat(x, sizes) for x in (toxic, left))
        cols = [x.astype(np.uint32) for x in (of & ~late, ~of & ~late, of & late, ~of & late)]
        return _merged([[key, *cols, *[np.where(x, bit, np.uint32(0)) for x in (of & ~late, of & late)]]], _COUNTS)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in (some for whole in parts for some in by_bytes(whole, 0, TEXT_BYTES)):
            held.append(counted(part))
            rows += len(held[-1][0])
            if rows > HELD_ROWS:
                cols = _merged(held, _COUNTS)
                yield _dealt(0, cols[0], cols, slices)
                held, rows = [], 0
        if rows:
            cols = _merged(held, _COUNTS)
            yield _dealt(0, cols[0], cols, slices)

    return map_arrow(train, run, _BLOBS)


def _merge(parts: Iterator[pa.RecordBatch], columns: int, sums: int) -> list[np.ndarray]:
    held, rows, done = [[np.zeros(0, np.uint64)] * columns], 0, 0
    for blob in (x for part in parts for x in part.column("held").to_pylist()):
        held.append(unpack(blob))
        rows += len(held[-1][0])
        if rows > HELD_ROWS + 2 * done:
            held = [_merged(held, sums)]
            rows = done = len(held[0][0])
    return _merged(held, sums)


def fit_counts(train: DataFrame, either: bool = False, slices: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(words, pairs) of every row of `train` (text, toxic 0/1, left 0/1), for model 0 (rows not left) and 1 (all rows).

    words: (model, word, tox, ord), in how many contexts a word occurs in each class.
    pairs: (model, pair, tox, ord, tox_mass, ord_mass, rest): discounted counts of a pair, the discounted mass after
    its context, and the share of the context that backs off; pairs that have some in the toxic class, or in either.

    Pairs are merged in slices of about SLICE_BYTES of text; what words, contexts and counted pairs need of each other is dealt
    once more, by word and by context. Both times packed columns travel, not rows.
    """
    given = train.select(F.col("text").cast("binary").alias("text"), F.col("toxic").cast("int"), F.col("left").cast("int"))
    if slices is None:
        slices = slices_of(train.sparkSession, given.agg(F.sum(F.octet_length("text"))).first()[0])

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, tox, ord_, tox_left, ord_left, after, after_left = _merge(parts, 1 + _COUNTS + _SEEN, _COUNTS)
        word, context = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
        less, seen, sums = [], [], []  # twice the discounted counts; whether a pair occurs; occurrences
        for t, o, bits in ((tox, ord_, after), (tox + tox_left, ord_ + ord_left, after | after_left)):
            less += [np.where((t > 1) & (np.bitwise_count(bits) > 1), 2 * t.astype(np.int64) - 3, 0), np.where(o > 1, 2 * o.astype(np.int64) - 3, 0)]
            seen += [t > 0, o > 0]
            sums += [*less[-2:], t + o]
        for kind, at, cols in ((0, word, seen), (1, context, sums)):
            keys, where = np.unique(at, return_inverse=True)
            yield _dealt(kind, keys, [keys, *[np.bincount(where, weights=c.astype(np.float64), minlength=len(keys)).astype(np.uint64) for c in cols]], slices)
        full = (less[2] > 0) | (less[3] > 0) if either else less[2] > 0
        yield _dealt(2, context[full], [pair[full], *[c[full] for c in less]], slices)

    def finished(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [[np.zeros(0, np.uint64)] * 5], 1: [[np.zeros(0, np.uint64)] * 7]}
        after = None
        for kind, blob in (x for part in parts for x in zip(part.column("kind").to_pylist(), part.column("held").to_pylist())):
            cols = unpack(blob)
            if kind < 2:  # words and contexts come before pairs
                held[kind].append(cols)
                if len(held[kind]) > 64:
                    held[kind] = [_merged(held[kind], 6)]
                continue
            after = _merged(held[1], 6) if after is None else after
            at = np.searchsorted(after[0], cols[0] & np.uint64(0xFFFFFFFF))
            x0, y0, z0, x1, y1, z1 = (c[at].astype(np.float64) for c in after[1:])
            masses = [m for x, y, z in ((x0, y0, z0), (x1, y1, z1)) for m in (x / 2, y / 2, 1 - (x + y) / 2 / np.maximum(z, 1))]
            yield _rows(2, cols[0], [c / 2 for c in cols[1:]] + masses)
        words = _merged(held[0], 4)
        yield _rows(0, words[0], [*words[1:], *[np.zeros(len(words[0]))] * 6])

    def _rows(kind: int, keys: np.ndarray, cols: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind, dtype=np.int32)), pa.array(keys.view(np.int64)),
                                           *[pa.array(c.astype(np.float64)) for c in cols]], names=_SUMS)

    sums = map_arrow(_pairs(given, slices).repartitionById(slices, F.col("slice")), summed, _BLOBS)
    sums = map_arrow(sums.repartitionById(slices, F.col("slice")).sortWithinPartitions("kind"), finished,
                     "kind int, key long, " + ", ".join(f"{c} double" for c in _SUMS[2:]))
    sums = stage_table(sums, "counts")
    words = [sums.where("kind = 0").select(F.lit(k).alias("model"), F.col("key").alias("word"), F.col(f"t{k}").alias("tox"), F.col(f"o{k}").alias("ord"))
             for k in (0, 1)]
    pairs = [sums.where("kind = 2").select(F.lit(k).alias("model"), F.col("key").alias("pair"), F.col(f"t{k}").alias("tox"), F.col(f"o{k}").alias("ord"),
                                           F.col(f"tm{k}").alias("tox_mass"), F.col(f"om{k}").alias("ord_mass"), F.col(f"rest{k}").alias("rest"))
             for k in (0, 1)]
    return (words[0].unionByName(words[1]).where("tox + ord > 0"),
            pairs[0].unionByName(pairs[1]).where("tox > 0 or ord > 0" if either else "tox > 0"))


def slices_of(spark: SparkSession, size: int | None) -> int:
    """How many slices so many bytes of text are counted in."""
    return max(spark.sparkContext.defaultParallelism, -(-int(size or 0) // SLICE_BYTES))


@dataclass
class Model:
    """Counts by sorted keys; each row of `word` and `pair` is one key's numbers."""
    totals: tuple[float, float, float]   # contexts of all words in toxic and in ordinary texts; words
    word_keys: np.ndarray                # hashes of words
    word: np.ndarray                     # [words, 2] tox, ord
    pair_keys: np.ndarray                # word << 32 | word before
    pair: np.ndarray                     # [pairs, 5] tox, ord, tox_mass, ord_mass, rest

    @classmethod
    def of(cls, totals, words, pairs) -> Model:
        """From the columns (key, numbers...) of both tables, in any order."""
        w, p = (np.argsort(c[0]) for c in (words, pairs))
        word, pair = (np.column_stack(c[1:]).astype(np.float32) for c in (words, pairs))
        return cls(totals, words[0][w], word[w], pairs[0][p], pair[p])

    @staticmethod
    def _find(keys: np.ndarray, numbers: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros((len(wanted), numbers.shape[1]))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((keys[at] == wanted)[:, None], numbers[at], 0.0)

    def _lower(self, kind: np.ndarray) -> np.ndarray:
        """What words have in both classes below the pairs; 0 and 0 in front of them say the same of both."""
        total, kinds = np.array(self.totals[:2])[:, None] + 1e-9, max(1.0, self.totals[2])
        count = self._find(self.word_keys, self.word, kind.astype(np.int64)).T
        less = np.where(count > 1, count - 1.5, 0.0)
        share = min(0.5, max(0.02, 1.2 * kinds / (total.sum() + kinds)))
        both = (count.sum(axis=0) + PRIOR) / (total.sum() + PRIOR * kinds)
        return (1 - share) * less / total + share * both

    def evidence(self, now: np.ndarray, before: np.ndarray) -> np.ndarray:
        """log p(word | word before, toxic) - log p(word | word before, ordinary)."""
        kind, where = np.unique(now, return_inverse=True)
        lower = self._lower(kind)[:, where]
        out = np.log(lower[0]) - np.log(lower[1])

        key = (now.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64)).view(np.int64)
        found = self._find(self.pair_keys, self.pair, key)
        some = (found[:, 0] > 0) | (found[:, 1] > 0)
        seen, mass, rest, lower = found[some, :2].T, found[some, 2:4].T, found[some, 4], lower[:, some]
        # what the classes would see of the pair if only its word told them apart
        share = lower * seen.sum(axis=0) / np.maximum((lower * mass).sum(axis=0), 1e-9)
        own = np.minimum(1.0, share * (seen + PAIR_PRIOR) / (share * mass + PAIR_PRIOR))
        p = (1 - rest) * own + rest * lower
        out[some] = np.log(p[0]) - np.log(p[1])
        return out.astype(np.float32)

    def known(self) -> list[np.ndarray]:
        """The evidence of all that the model knows, 8 bytes a word or pair: words and theirs; the words of pairs, how many each
        has, the words before, and the pairs' evidence."""
        lower = self._lower(self.word_keys)
        key = np.sort(self.pair_keys.view(np.uint64))
        now, before = (key >> np.uint64(32)).astype(np.uint32), key.astype(np.uint32)
        pairs = [self.evidence(now[a:a + (1 << 18)], before[a:a + (1 << 18)]) for a in range(0, len(key), 1 << 18)]
        words, sizes = np.unique(now, return_counts=True)
        return [self.word_keys.astype(np.uint32), (np.log(lower[0]) - np.log(lower[1])).astype(np.float32),
                words, sizes.astype(np.uint32), before, np.concatenate([np.zeros(0, np.float32), *pairs])]


def features(texts: list[bytes | None], evidence: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """Normalised evidence of each whole text, its strongest word and its strongest window."""
    now, before, sizes = _batch_tokens(texts)
    whole, word, run = (np.zeros(len(sizes)) for _ in range(3))
    if len(now):
        each = evidence(now, before).astype(np.float64)
        back = now
        for _ in range(WINDOW - 1):  # a word that a window repeats says nothing new
            back = _before(back, sizes)
            each[back == now] = 0.0
        sums = np.concatenate(([0.0], np.cumsum(each)))
        ends, some = np.cumsum(sizes), sizes > 0
        first = (ends - sizes)[some]
        whole[some] = (sums[ends] - sums[ends - sizes])[some] / sizes[some]
        word[some] = np.maximum.reduceat(each, first)
        until = np.minimum(np.arange(len(now)) + WINDOW, np.repeat(ends, sizes))
        run[some] = np.maximum.reduceat((sums[until] - sums[:-1]) / WINDOW, first)
    return [whole, word, run]


def _met(keys: np.ndarray, numbers: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether sorted keys hold what is wanted, and its numbers."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), numbers.dtype)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, numbers[at]


def evidence_of(slices: list, now: np.ndarray, before: np.ndarray) -> np.ndarray:
    """What `Model.evidence` says, from broadcast slices of `Model.known` by ranges of words; beyond two, one is held at a time."""
    key, where = np.unique(now.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64), return_inverse=True)
    out = np.zeros(len(key), np.float32)
    cuts = np.searchsorted(key, np.array([-(-(k << 32) // len(slices)) << 32 for k in range(len(slices))], np.uint64))
    for a, b, held in zip(cuts, [*cuts[1:], len(key)], slices):
        if a == b:
            continue
        words, alone, first, sizes, second, pairs = held.value
        met, value = _met(words, alone, (key[a:b] >> np.uint64(32)).astype(np.uint32))
        out[a:b][met] = value[met]
        met, value = _met(np.repeat(first.astype(np.uint64) << np.uint64(32), sizes) | second, pairs, key[a:b])
        out[a:b][met] = value[met]
        if len(slices) > 2:
            vars(held).pop("_value", None)
    return out[where]


def _shared(words: DataFrame, pairs: DataFrame, totals: tuple[float, float, float], rows: int) -> list:
    """The model as broadcast slices of about PART_ROWS rows, made one after the other."""
    n = max(1, -(-rows // PART_ROWS))
    out = []
    for k in range(n):
        some = (words.where(F.shiftright(F.col("word") * n, 32) == k).select(*_WORD),
                pairs.where(F.shiftright(F.shiftrightunsigned("pair", 32) * n, 32) == k).select(*_PAIR))
        tables = [[t.column(c).to_numpy() for c in range(t.num_columns)] for t in (x.toArrow() for x in some)]
        out.append(words.sparkSession.sparkContext.broadcast(Model.of(totals, *tables).known()))
    return out


def _gathered(parts: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches whose texts have about so many bytes together."""
    held, size = [], 0
    for part in (some for whole in parts for some in by_bytes(whole, column, most)):
        new = sum(x or 0 for x in pc.binary_length(part.column(column)).to_pylist())
        if held and size + new > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(part)
        size += new
    if held:
        yield pa.concat_batches(held)


_WORD, _PAIR = ("word", "tox", "ord"), ("pair", "tox", "ord", "tox_mass", "ord_mass", "rest")


def with_features(docs: DataFrame, words: DataFrame, pairs: DataFrame, text_col: str = "text", most: int = MODEL_ROWS,
                  held: list | None = None) -> DataFrame:
    """`docs` with the columns FEATURES (double) under the model of `words` and `pairs` (one model's rows); `held` gets what is broadcast."""
    got = words.agg(F.count(F.lit(1)), F.sum("tox"), F.sum("ord")).first()
    totals = (float(got[1] or 0), float(got[2] or 0), float(got[0]))
    given = docs.withColumn("_tx_in", F.col(f"`{text_col}`").cast("binary"))
    out = StructType([*docs.schema.fields, *(StructField(name, DoubleType()) for name in FEATURES)])
    width = len(docs.columns)
    words = words.where("tox > 1 or ord > 1")  # the others have no discounted count
    rows = words.count() + pairs.count()
    shared = None
    if rows <= most:
        shared = _shared(words, pairs, totals, rows)
        if held is not None:
            held += shared
    else:
        given = _with_slices(given, words, pairs)
    size = TEXT_BYTES if shared is None or len(shared) < 3 else PART_BYTES

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _gathered(parts, width, size):
            texts = some.column(width).to_pylist()
            if shared is not None:
                made = features(texts, lambda now, before: evidence_of(shared, now, before))
            else:  # each document with its own part of the model
                each = [features([t], Model.of(totals, _slice(w, _WORD), _slice(p, _PAIR)).evidence)
                        for t, w, p in zip(texts, some.column(width + 1), some.column(width + 2))]
                made = [np.concatenate(c) for c in zip(*each)]
            yield pa.RecordBatch.from_arrays([*some.columns[:width], *map(pa.array, made)], names=[*some.schema.names[:width], *FEATURES])

    return map_arrow(given, run, out)


def _slice(held: pa.Scalar, names: tuple[str, ...]) -> list[np.ndarray]:
    rows = held.as_py() or []
    return [np.array([r[n] for r in rows], dtype=np.int64 if k == 0 else np.float64) for k, n in enumerate(names)]


def _with_slices(given: DataFrame, words: DataFrame, pairs: DataFrame) -> DataFrame:
    """`given` with the rows of the model that its texts (_tx_in) use: distinct words and pairs of each distinct text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (some for whole in parts for some in by_bytes(whole, 1, TEXT_BYTES)):
            for tag, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                now, before, _ = _batch_tokens([text])
                for kind, key in ((0, np.unique(now.astype(np.int64))),
                                  (1, np.unique((now.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64)).view(np.int64)))):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), tag)), pa.array(np.full(len(key), kind, np.int32)), pa.array(key)],
                                                     names=["tag", "kind", "key"])

    tag = F.xxhash64("_tx_in")
    texts = given.where("_tx_in is not null").select(tag.alias("tag"), F.col("_tx_in").alias("text"))
    used = stage_table(map_arrow(texts, run, "tag long, kind int, key long").distinct(), "used")
    out = given.withColumn("_tx_tag", tag)
    for kind, table, names in ((0, words, _WORD), (1, pairs, _PAIR)):
        met = used.where(F.col("kind") == kind).join(table.withColumnRenamed(names[0], "key"), "key")
        met = met.groupBy("tag").agg(F.collect_list(F.struct(F.col("key").alias(names[0]), *names[1:])).alias(f"_tx_{names[0]}s"))
        out = out.join(met.withColumnRenamed("tag", "_tx_tag"), "_tx_tag", "left")
    return out.select(*given.columns, "_tx_words", "_tx_pairs")


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 100) -> tuple[float, ...]:
    """Bias and weights of a logistic curve by Newton's method with step halving."""
    if not 0 < y.sum() < len(y):
        return DEFAULT
    x = np.column_stack([np.ones(len(y)), x])
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + w @ penalty @ w / 2)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        while np.abs(step).max() >= 1e-8 and loss(w + step) > loss(w):
            step = step / 2
        if np.abs(step).max() < 1e-8:
            break
        w = w + step
    return tuple(float(k) for k in w)


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", out_col: str = "score", most: int = MODEL_ROWS) -> DataFrame:
    """`docs` with `out_col` in [0, 1]; learns from the labelled rows of `docs` that are not held out."""
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("_tx_id"), F.col(f"`{label_col}`").cast("int").alias("toxic"))
             .where("_tx_id is not null and toxic is not null").where(~held_out(F.col("_tx_id")))
             .groupBy("_tx_id").agg(F.max("toxic").alias("toxic")))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("_tx_id"), F.col(f"`{text_col}`").alias("text"))
    marked = join_checked(texts, known, "_tx_id")
    h = F.xxhash64("_tx_id")
    quarter = F.floor(fold(F.col("_tx_id")) / 3) % 4 == 0
    last = marked.where(quarter).select(h.alias("h")).orderBy("h").limit(CURVE_ROWS).agg(F.max("h")).first()[0]
    left_out = quarter & (h <= F.lit(last)) if last is not None else F.lit(False)
    # a text counts once, with most of its labels; it is left to the curve only if all its rows are
    once = marked.groupBy(F.xxhash64("text").alias("h")).agg(
        F.min(F.when(~left_out, F.col("_tx_id"))).alias("rest_id"), F.min("_tx_id").alias("id"), (F.avg("toxic") >= 0.5).cast("int").alias("most"),
        F.max(F.octet_length("text")).alias("size"))
    once = stage_table(once.select(F.coalesce("rest_id", "id").alias("_tx_id"), "most", F.col("rest_id").isNull().alias("left"), "size"), "toxicity")
    size = once.agg(F.sum("size")).first()[0]
    counted = join_checked(marked, once.drop("size"), "_tx_id").select("text", F.col("most").alias("toxic"), "left")
    words, pairs = fit_counts(counted, either=True, slices=slices_of(docs.sparkSession, size))

    # the curve is fitted on rows that its model has not counted; the model that scores counts every row
    held: list = []
    curve = (with_features(marked.where(left_out), words.where("model = 0"), pairs.where("model = 0"), most=most, held=held)
             .select("toxic", *FEATURES, h.alias("h")).orderBy("h", *FEATURES).limit(CURVE_ROWS).toArrow())
    for x in held:
        x.destroy()
    cols = [curve.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(1 + len(FEATURES))]
    bias, *weights = fit_curve(np.column_stack(cols[1:]), cols[0])
    names = [F.col(f"`{c}`") for c in docs.columns if c != out_col]
    z = sum((F.lit(w) * F.col(f) for w, f in zip(weights, FEATURES)), F.lit(bias))
    scored = with_features(docs, words.where("model = 1"), pairs.where("model = 1"), text_col, most)
    return scored.select(*names, (1 / (1 + F.exp(-z))).alias(out_col))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Contract columns of op2 over a table with doc_id and text."""
    done = score(docs.select("doc_id", "text"), labels)
    return done.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
