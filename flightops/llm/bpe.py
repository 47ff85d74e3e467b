"""Byte-level BPE by rank files: encoding with a hierarchical-bitmap rank queue, and decoding.

The bytes of many pre-tokens form one array of linked lists, a list for each
pre-token, so that no merge crosses a border. Each adjacent pair that has a
merge rank is filed, by its left position, in the bucket of that rank; a
two-level bitmap marks the buckets in use, and two find-first-set steps give
the lowest rank, whatever the length. The positions of that bucket are merged
together, leftmost first where they overlap. Entries are never removed when a
merge makes them wrong: they are skipped when met, if the pair at their
position no longer has the bucket's rank. A pre-token of millions of bytes
costs as much a byte as one of thousands. (Some tokens can take part in a merge
of lower rank than their own, which comes before their next occurrence. A
pre-token that holds such a merge more than once is finished one merge at a
time, with a heap of positions in each bucket.)

The tokens of pre-tokens seen before are kept in a per-worker table of bounded
size; only new ones go through the queue, all those of an Arrow batch at once.
Rows never move: both directions are one map over the documents.

* null text: empty; it has no ids and decodes to no bytes. An empty table gives no rows; repeated rows are encoded alike.
* ids travel as little-endian unsigned 32-bit integers in one binary column
  (`unpack_ids` gives an array); a decoder refuses ids that the vocabulary lacks.
* other columns pass through; the named output columns replace columns of those names.
"""

from __future__ import annotations

import base64
import re
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightops.llm.common import map_arrow

#: A worker remembers this many pre-tokens (one of more than 64 characters counts once for each 64).
MEMO_SIZE = 120_000
#: Texts of about this many characters are taken together, and rows of this many bytes returned together.
IN_CHARS, OUT_BYTES = 4 << 20, 2 << 20

# The letters, numbers and white space among the first 256 code points.
_LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_NUMBERS = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACES = r"\t-\r \x85\xa0"


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte string to rank, from lines of a base64 token and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Merges of one rank file: pre-tokens to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.byte_ids = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
        if self.byte_ids.min() < 0:
            raise ValueError("the vocabulary lacks single bytes")
        merges = {(ranks[token[:k]] << 32) + ranks[token[k:]]: rank for token, rank in ranks.items()
                  for k in range(1, len(token)) if token[:k] in ranks and token[k:] in ranks}
        self.keys = np.array(sorted(merges), dtype=np.int64)
        self.values = np.array([merges[k] for k in self.keys.tolist()], dtype=np.int64)
        self.plain_keys, self.plain_values = array("q", self.keys.tolist()), array("q", self.values.tolist())
        left, right = self.keys >> 32, self.keys & 0xFFFFFFFF
        #: Tokens with a merge of lower rank than their own.
        self.early = set(left[self.values < left].tolist()) | set(right[self.values < right].tolist())
        self.full = regex.compile(pattern)
        # The same alternatives over the first 256 code points, for a faster matcher.
        narrow = (pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{_SPACES}{_LETTERS}{_NUMBERS}]")
                  .replace(r"(?!\S)", f"(?![^{_SPACES}])")
                  .replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]").replace(r"\s", f"[{_SPACES}]"))
        self.narrow = re.compile(narrow) if not re.search(r"\\[pPsSwWdDbB]", narrow) else None
        self.memo = _Memo()

    def pieces(self, text: str) -> list[str]:
        if self.narrow is not None:
            try:
                text.encode("latin-1")
                return self.narrow.findall(text)
            except UnicodeEncodeError:
                pass
        return self.full.findall(text)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens, -1 where there is none."""
        wanted = (left << 32) + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.values[at], -1)

    def merge(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of each pre-token."""
        if not pieces:
            return []
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        ends = np.cumsum(sizes)
        ids = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        if not len(ids):
            return [b""] * len(pieces)
        after, before = np.arange(1, len(ids) + 1), np.arange(-1, len(ids) - 1)
        after[ends[sizes > 0] - 1] = -1
        before[(ends - sizes)[sizes > 0]] = -1
        now = np.full(len(ids), -1, dtype=np.int64)  # rank of the pair that begins here
        queue = _RankQueue()

        def file(positions: np.ndarray) -> None:
            ranks = self.rank_of(ids[positions], ids[after[positions]])
            now[positions] = ranks
            queue.push(ranks, positions)

        file(np.flatnonzero(after >= 0))
        while (found := queue.pop()) is not None:
            rank, at = found
            at = at[now[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                at = np.unique(at)
                touching = after[at[:-1]] == at[1:]
                if touching.any():  # of a chain of overlapping pairs the first, third, ... are merged
                    order = np.arange(len(at))
                    first = np.maximum.accumulate(np.where(np.concatenate(([True], ~touching)), order, 0))
                    at = at[(order - first) % 2 == 0]
                if rank in self.early:  # in a pre-token that holds it again, its merges may come in between
                    piece = np.searchsorted(ends, at, side="right")
                    again = np.unique(piece[1:][piece[1:] == piece[:-1]])
                    for a, b in zip((ends - sizes)[again].tolist(), ends[again].tolist()):
                        done = self.finish(ids[a:b][ids[a:b] >= 0].tolist())
                        ids[a:b], now[a:b] = -1, -1
                        ids[a:a + len(done)] = done
                    at = at[~np.isin(piece, again)]
                    if not len(at):
                        continue
            gone = after[at]
            ids[at], ids[gone], now[gone] = rank, -1, -1
            after[at] = ahead = after[gone]
            before[ahead[ahead >= 0]] = at[ahead >= 0]
            behind = before[at]
            changed = np.concatenate((at, behind[behind >= 0]))
            now[at] = -1
            file(changed[after[changed] >= 0])
        left = ids >= 0
        packed = ids[left].astype("<u4").tobytes()
        until = (np.cumsum(left)[np.maximum(ends, 1) - 1] * 4).tolist()
        if sizes[0] == 0:  # nothing before the first byte
            until = [0 if not e else u for e, u in zip(ends.tolist(), until)]
        return [packed[a:b] for a, b in zip([0, *until], until)]

    def finish(self, ids: list[int]) -> list[int]:
        """All merges of one pre-token, one by one, the leftmost of the lowest rank first: by the same buckets
        and bitmap, each bucket a heap of positions."""
        n = len(ids)
        after, before, now = [*range(1, n), -1], list(range(-1, n - 1)), [-1] * n
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}
        top = 0
        keys, values = self.plain_keys, self.plain_values

        def file(p: int) -> None:
            nonlocal top
            now[p] = -1
            if after[p] < 0:
                return
            pair = (ids[p] << 32) + ids[after[p]]
            k = bisect_left(keys, pair)
            if k == len(keys) or keys[k] != pair:
                return
            rank = now[p] = values[k]
            if rank in buckets:
                heappush(buckets[rank], p)
            else:
                buckets[rank] = [p]
                words[rank >> 8] = words.get(rank >> 8, 0) | 1 << (rank & 255)
                top |= 1 << (rank >> 8)

        for p in range(n):
            file(p)
        while top:
            w = (top & -top).bit_length() - 1
            rank = (w << 8) + (words[w] & -words[w]).bit_length() - 1
            held = buckets[rank]
            p = heappop(held)
            if not held:
                del buckets[rank]
                words[w] &= words[w] - 1
                if not words[w]:
                    top &= top - 1
            if now[p] != rank:
                continue  # stale
            gone = after[p]
            ids[p], ids[gone], now[gone] = rank, -1, -1
            after[p] = after[gone]
            if after[p] >= 0:
                before[after[p]] = p
            file(p)
            if before[p] >= 0:
                file(before[p])
        return [x for x in ids if x >= 0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian unsigned 32-bit integers."""
        memo, out = self.memo, []
        parts = [array("I", map(memo.__getitem__, self.pieces(text))) for text in texts]
        memo.packed += self.merge([piece.encode() for piece in memo.new])
        memo.new.clear()
        for part in parts:
            out.append(b"".join(map(memo.packed.__getitem__, part)))
        if len(memo) + memo.long > MEMO_SIZE:
            memo.clear()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


class _RankQueue:
    """Positions in buckets by merge rank, and a bitmap of two levels over the buckets in use."""

    def __init__(self):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.words: dict[int, int] = {}  # bits of 256 neighbouring ranks
        self.top = 0  # a bit for each word in use

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Files the positions whose rank is not -1."""
        keep = ranks >= 0
        ranks, positions = ranks[keep], positions[keep]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for rank, a, b in zip(ranks[cuts[:-1]].tolist(), cuts, cuts[1:]):
            if rank in self.buckets:
                self.buckets[rank].append(positions[a:b])
            else:
                self.buckets[rank] = [positions[a:b]]
                w = rank >> 8
                self.words[w] = self.words.get(w, 0) | 1 << (rank & 255)
                self.top |= 1 << w

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and all its positions; None when the queue is empty."""
        if not self.top:
            return None
        w = (self.top & -self.top).bit_length() - 1
        bits = self.words[w]
        rank = (w << 8) + (bits & -bits).bit_length() - 1
        self.words[w] = bits & (bits - 1)
        if not self.words[w]:
            self.top &= self.top - 1
        found = self.buckets.pop(rank)
        return rank, found[0] if len(found) == 1 else np.concatenate(found)


class _Memo(dict):
    """Pre-token to its place in `packed`; `new` holds those still to be merged."""

    def __init__(self):
        super().__init__()
        self.packed: list[bytes] = []
        self.new: list[str] = []
        self.long = 0

    def __missing__(self, piece: str) -> int:
        at = self[piece] = len(self)
        self.new.append(piece)
        self.long += len(piece) >> 6
        return at

    def clear(self) -> None:
        super().clear()
        self.packed, self.new, self.long = [], [], 0


_open: dict[str, Vocabulary] = {}


def _vocabulary(ranks: dict[bytes, int], pattern: str, key: str) -> Vocabulary:
    """One vocabulary a worker, kept from task to task."""
    if key not in _open:
        _open.clear()
        _open[key] = Vocabulary(ranks, pattern)
    return _open[key]


def _mapped(df: DataFrame, source: str, kind: str, targets: list[tuple[str, str]],
            worker: Callable[[], Callable[[list], list[tuple]]]) -> DataFrame:
    """`df` with `targets` computed from lists of values of the column `source` (as `kind`)."""
    names = [name for name, _ in targets]
    keep = [F.col(f"`{c}`") for c in df.columns if c not in names]
    given = df.select(*keep, F.col(f"`{source}`").cast(kind).alias("_bpe_in"))
    out = given.drop("_bpe_in").schema
    for name, kind_ in targets:
        out = out.add(name, kind_)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = worker()
        for part in parts:
            column = part.column(part.num_columns - 1)
            for a, b in _cuts([len(x) if x else 0 for x in map(_size, column)], IN_CHARS):
                done = apply([x.as_py() for x in column[a:b]])
                for c, d in _cuts([sum(len(x) for x in row if isinstance(x, bytes)) for row in done], OUT_BYTES):
                    made = [pa.array(values, type=pa.binary() if kind_ == "binary" else pa.int64())
                            for values, (_, kind_) in zip(zip(*done[c:d]), targets)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column(k).slice(a + c, d - c) for k in range(part.num_columns - 1)] + made,
                        names=part.schema.names[:-1] + names)

    return map_arrow(given, run, out)


def _size(value: pa.Scalar) -> bytes | None:
    return value.as_buffer() if value.is_valid else None


def _cuts(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Borders of runs whose sizes reach `most` only with their last item."""
    a = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield a, i + 1
            a, total = i + 1, 0
    if a < len(sizes):
        yield a, len(sizes)


def _encoder(df: DataFrame, ranks: dict[bytes, int], pattern: str, also_decode: bool) -> Callable:
    """Makes a task's function from texts to (packed ids, their number) or (packed ids, their number, decoded bytes)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    key = f"{len(ranks)} {hash(frozenset(ranks.items()))} {pattern}"

    def worker():
        vocabulary = _vocabulary(shared.value, pattern, key)
        vocabulary.memo.clear()  # a worker that waits for its next task holds no more than the vocabulary
        token = _tokens(shared.value) if also_decode else None

        def apply(texts: list[str | None]) -> list[tuple]:
            packed = vocabulary.encode_all([t or "" for t in texts])
            return [(x, len(x) // 4, _bytes_of(x, token)) if also_decode else (x, len(x) // 4) for x in packed]

        return apply

    return worker


def _tokens(ranks: dict[bytes, int]) -> dict[int, bytes]:
    return {rank: piece for piece, rank in ranks.items()}


def _bytes_of(packed: bytes | None, token: dict[int, bytes]) -> bytes:
    return b"".join(map(token.__getitem__, memoryview(packed or b"").cast("I")))


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text",
           ids_col: str = "ids", count_col: str = "n_tokens") -> DataFrame:
    """`df` with the packed ids of `text_col` in `ids_col` (binary) and their number in `count_col` (long).

    The vocabulary (a file of fixed size, about 1 MB) is broadcast.
    """
    return _mapped(df, text_col, "string", [(ids_col, "binary"), (count_col, "long")], _encoder(df, ranks, pattern, False))


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """`df` with the bytes that the packed ids in `ids_col` stand for in `bytes_col` (binary; null ids: empty)."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def worker():
        token = _tokens(shared.value)
        return lambda given: [(_bytes_of(x, token),) for x in given]

    return _mapped(df, ids_col, "binary", [(bytes_col, "binary")], worker)


def round_trip(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", ids_col: str = "ids",
               count_col: str = "n_tokens", bytes_col: str = "decoded") -> DataFrame:
    """`encode` and then `decode` of its ids in one pass, with half the workers of the two one after the other."""
    return _mapped(df, text_col, "string", [(ids_col, "binary"), (count_col, "long"), (bytes_col, "binary")],
                   _encoder(df, ranks, pattern, True))


def unpack_ids(packed: Column) -> Column:
    """Packed ids as an array of long (native; for small results)."""
    digits = F.hex(packed)
    at = F.sequence(F.lit(0), (F.octet_length(packed) / 4).cast("int") - 1)
    one = F.transform(at, lambda i: F.conv(F.concat(*[F.substring(digits, i * 8 + k, F.lit(2)) for k in (7, 5, 3, 1)]), 16, 10).cast("long"))
    return F.when(F.octet_length(packed) > 0, one).otherwise(F.array().cast("array<bigint>"))


def digest(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Contract columns of op1 over a table with doc_id and text."""
    ranks = load_ranks(path)
    done = round_trip(docs.select("doc_id", "text"), ranks, pattern)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
