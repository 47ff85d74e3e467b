"""Tokens, lines, passages and fingerprints against brute force on small and awkward tables."""

import collections
import hashlib
import random
import re
import struct

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from flightops.llm import bpe, line_dedup, queries, simhash_dedup, substring_dedup

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
RANKS = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
REFERENCE = tiktoken.Encoding("test", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "The line is here\nand Again here\n\n x"), (6, "the LINE is here \nother text\nAND again HERE"),
           (6, "the LINE is here \nother text\nAND again HERE"), (None, "THE line is here"), (9, "é" * 12 + "\n" + "É" * 12), (8, "é" * 12)]


def docs(spark, rows=AWKWARD):
    return spark.createDataFrame([(i, t, "en", "z") for i, t in rows], "doc_id long, text string, lang string, spans string")


def table(sf):
    return duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()


# ---- byte-level BPE

def ids(packed):
    return list(memoryview(packed).cast("I"))


def test_bpe_equals_the_library_on_random_texts():
    v, rnd = bpe.Vocabulary(RANKS, P.PATTERN), random.Random(5)
    pool = "abcthe 'sé ÀÿßñÑ12²½ \n\t\xa0\x85\x1c日本語🙂ا٣Ⅷ_-*&%.,!?́"
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 60))) for _ in range(1500)]
    for text, packed in zip(texts, v.encode_all(texts)):
        assert ids(packed) == REFERENCE.encode_ordinary(text)


def test_bpe_of_very_long_pre_tokens_and_a_full_table(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_SIZE", 50)
    v = bpe.Vocabulary(RANKS, P.PATTERN)
    for text in ("a" * 30_000, "abcab" * 5_000, "né" * 4_000 + "12" * 3_000, " ".join(f"w{i}x" for i in range(500))):
        assert ids(v.encode(text)) == REFERENCE.encode_ordinary(text)
    assert len(v.memo) <= 550


def test_bpe_columns_nulls_and_round_trip(spark):
    given = docs(spark).withColumn("ids", F.lit("clash"))
    done = bpe.decode(bpe.encode(given, RANKS, P.PATTERN), RANKS).withColumn("list", bpe.unpack_ids(F.col("ids"))).collect()
    assert len(done) == len(AWKWARD)
    for r in done:
        text = r["text"] or ""
        assert r["list"] == ids(bytes(r["ids"])) == REFERENCE.encode_ordinary(text) and r["n_tokens"] == len(r["list"])
        assert bytes(r["decoded"]) == text.encode() and r["lang"] == "en"
    both = bpe.round_trip(given, RANKS, P.PATTERN)
    assert sorted((bytes(r["ids"]), bytes(r["decoded"]), r["n_tokens"]) for r in both.collect()) == sorted((bytes(r["ids"]), bytes(r["decoded"]), r["n_tokens"]) for r in done)
    assert bpe.encode(docs(spark, []), RANKS, P.PATTERN).count() == 0


def test_op1_equals_the_library(spark):
    got = {r[0]: tuple(r[1:]) for r in queries.op1_byte_bpe(spark, SMALL).collect()}
    for i, text in table(SMALL):
        x = REFERENCE.encode_ordinary(text or "")
        assert got[i] == (len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest())


# ---- line dedup

def kept_lines(rows):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(2**63 - 1 if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == (2**63 - 1 if i is None else i)]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return out


def test_line_dedup_equals_brute_force_on_awkward_rows(spark):
    got = line_dedup.drop_repeated_lines(docs(spark).withColumn("n_lines", F.lit("clash")))
    assert got.columns == ["doc_id", "text", "lang", "spans", "n_lines", "n_dropped"]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=order) == sorted(kept_lines(AWKWARD), key=order)
    assert line_dedup.drop_repeated_lines(docs(spark, [])).count() == 0


def test_line_key_tells_strings_apart(spark):
    from flightops.llm.common import ascii_lower_key
    rows = ["é", "É", "ã©", "A", "a", "Ａ", "ß", "ẞ", "ÀB", "àb", "Àb"]
    got = spark.createDataFrame([(s,) for s in rows], "s string").select("s", ascii_lower_key(F.col("s")).alias("k")).collect()
    lower = {s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s) for s in rows}
    for a in got:
        for b in got:
            assert (a["k"] == b["k"]) == (lower[a["s"]] == lower[b["s"]])


@pytest.mark.parametrize("min_docs", [2, 3])
def test_line_dedup_threshold(spark, min_docs):
    rows = [(i, f"shared line of all\nonly {i} has this line") for i in range(4)] + [(7, "a pair of lines x"), (8, "a pair of lines x")]
    got = {r[0]: r[1] for r in line_dedup.drop_repeated_lines(docs(spark, rows), min_docs=min_docs).select("doc_id", "n_dropped").collect()}
    assert [got[i] for i in range(4)] == [0, 1, 1, 1] and got[8] == (1 if min_docs == 2 else 0)


# ---- SimHash

def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i:i + 3]).encode() for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=3):
    """Smallest index reachable, by comparing everything."""
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x
    for i, a in enumerate(prints):
        for j in range(i):
            if bin(a ^ prints[j]).count("1") <= radius:
                up[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(prints))]


def test_op7_equals_brute_force(spark):
    rows = sorted(table(SMALL))
    got = {r[0]: (r[1], r[2]) for r in queries.op7_simhash_dedup(spark, SMALL).collect()}
    prints = [fingerprint(t) for _, t in rows]
    for (i, _), p, g in zip(rows, prints, groups(prints)):
        assert got[i] == (f"{p:016x}", rows[g][0])


@pytest.mark.parametrize("blocks,tile", [(4, 4096), (5, 4), (6, 2)])
def test_links_keep_every_group_connected(spark, blocks, tile):
    rnd = random.Random(blocks)
    prints = []
    for _ in range(12):  # chains and clouds around a few centres
        x = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 90)):
            prints.append(x)
            x ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))
    prints = list(dict.fromkeys([0, *prints]))
    given = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p, i) for i, p in enumerate(prints)], "fp long, node long")
    least = {r["node"]: r["least"] for r in simhash_dedup.components(simhash_dedup.links(given, blocks=blocks, tile=tile)).collect()}
    assert [least.get(i, i) for i in range(len(prints))] == groups(prints)


def test_tiled_comparison_spans_groups():
    rnd = random.Random(2)
    prints = np.array(sorted({rnd.getrandbits(64) & ~0xFF | rnd.getrandbits(3) for _ in range(40)} | {7 << 60 | k for k in range(200)},
                             key=lambda p: bin(p).count("1")), dtype=np.uint64)
    a, b = simhash_dedup.tiled(prints, np.bitwise_count(prints).astype(np.int64), 3, sub=16)
    assert all(bin(int(prints[i] ^ prints[j])).count("1") <= 3 for i, j in zip(a, b))
    assert len(a) == len(prints) - len(set(groups([int(p) for p in prints])))  # a forest


def test_keep_one_on_awkward_rows(spark):
    kept = [(r["doc_id"], r["text"]) for r in simhash_dedup.keep_one(docs(spark)).collect()]
    assert [i for i, t in kept if not (t or "").split()] == [1]          # one of the documents without words
    assert sum(i == 6 for i, _ in kept) == 2                            # repeated rows of a kept id stay
    assert simhash_dedup.keep_one(docs(spark, [])).count() == 0


# ---- substring dedup

def kept_words(rows, window=35):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    count = collections.Counter(tuple(w[k:k + window]) for _, w in words for k in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if count[tuple(w[k:k + window])] > 1:
                gone |= set(range(k, k + window))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


def passages(seed):
    rnd = random.Random(seed)
    word = lambda n: [f"w{rnd.randrange(400)}" for _ in range(n)]
    shared, hot = [word(60) for _ in range(4)], word(36)
    rows = []
    for i in range(60):
        text = word(rnd.randrange(0, 80))
        if i % 2:
            text += hot
        if i % 3 == 0:
            p = rnd.choice(shared)
            a = rnd.randrange(0, 20)
            text += p[a:a + rnd.randrange(30, 60)] + word(rnd.randrange(10))
        rows.append((i, ("\n" if i % 5 else "  ").join(text)))
    return rows + [(70, "same " * 200), (71, "x y " * 60), (72, rows[3][1]), (73, None), (74, ""), (None, " ".join(shared[0])), (72, rows[3][1])]


@pytest.mark.parametrize("hot", [0, 3, 4000])
def test_substring_dedup_equals_brute_force(spark, hot):
    rows = passages(1)
    got = substring_dedup.remove(docs(spark, rows).withColumn("n_words", F.lit("clash")), hot=hot)
    assert got.columns == ["doc_id", "lang", "spans", "text", "n_words", "n_removed"]
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "text").collect()), key=order) == sorted(kept_words(rows), key=order)


def test_op9_equals_brute_force(spark):
    got = {r[0]: tuple(r[1:]) for r in queries.op9_substring_dedup(spark, MIDDLE).collect()}
    for i, n, gone, text in kept_words(table(MIDDLE)):
        assert got[i] == (n, gone, hashlib.sha256(text.encode()).hexdigest())


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.remove(docs(spark, [])).count() == 0
    assert [tuple(r) for r in substring_dedup.remove(docs(spark, [(1, None)])).select("text", "n_words", "n_removed").collect()] == [("", 0, 0)]
