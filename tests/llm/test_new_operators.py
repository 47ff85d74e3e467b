"""N-gram join, importance resampling and Merkle manifest against brute force."""

import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flightops.llm import importance, merkle, ngram_join, queries

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, rank int, node string"


def duck(sql, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con.execute(sql).fetchall()


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ---- n-gram join

def sets_of(texts, k=3):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t or ""))
        out.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def joined(rows, percent=90, k=3):
    """(id, size, component) of every row by comparing all pairs."""
    sets = sets_of([t for _, t in rows], k)
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                up[root(a)] = root(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[root(a)] = min(least.get(root(a), i), i)
    return sorted(((i, len(s), i if not s else least.get(root(a))) for a, ((i, _), s) in enumerate(zip(rows, sets))), key=str)


def family(seed, groups, words=60, most=8):
    """Texts in groups of near copies at similarities around the threshold."""
    rnd = random.Random(seed)
    texts = []
    for g in range(groups):
        base = [f"w{rnd.randrange(400)}" for _ in range(rnd.randint(2, words))]
        for _ in range(rnd.randint(1, 9)):
            t = list(base)
            for _ in range(rnd.randint(0, most)):
                at = rnd.randrange(len(t))
                t[at:at + 1] = rnd.choice([[], [f"x{rnd.randrange(99)}"], [t[at], "y"]])
                if not t:
                    t = ["z"]
            texts.append(" ".join(t))
            base = t if rnd.random() < 0.5 else base  # chains
    return texts


def classes(spark, rows, **how):
    got = ngram_join.classes(spark.createDataFrame(rows, "doc_id long, text string"), **how)
    return sorted((tuple(r) for r in got.select("id", "n", "component").collect()), key=str)


@pytest.mark.parametrize("percent,shingle,tile", [(90, 3, 2048), (80, 5, 4), (70, 1, 2048)])
def test_join_equals_all_pairs(spark, percent, shingle, tile):
    texts = family(percent, 40)
    common = " ".join(f"c{k}" for k in range(40))
    texts += [common + " " + " ".join(t.split()[:4]) for t in texts[:60]]  # a passage that many share
    rows = list(enumerate(texts, 100))
    assert classes(spark, rows, percent=percent, shingle=shingle, tile=tile) == joined(rows, percent, shingle)


def test_join_of_large_group_with_small_tiles(spark):
    rnd = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for _ in range(150):  # some copies link to none but a few of the others
        t = list(base)
        for _ in range(rnd.randint(1, 5)):
            t[rnd.randrange(len(t))] = f"n{rnd.randrange(10**6)}"
        texts.append(" ".join(t))
    rows = list(enumerate(texts))
    assert classes(spark, rows, tile=16) == joined(rows)


def test_join_on_awkward_rows(spark):
    long = " ".join(f"q{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b"), (6, "a b"), (7, "É x y"), (8, "é x y"), (None, "a b"), (None, "p q r s"),
            (9, long), (10, long + " end"), (11, long.replace("q7 ", "r7 ")), (12, " ".join(f"q{k}" for k in range(20_000)))]
    assert classes(spark, rows) == joined(rows)
    assert classes(spark, []) == []
    wide = spark.createDataFrame([(1, "a b c", "x", 2, "y"), (2, "a b c", None, None, None)], DOCS)
    assert sorted(tuple(r) for r in ngram_join.classes(wide).collect()) == [(1, 1, 1), (2, 1, 1)]


def test_rows_of_many_ngrams_are_cut():
    assert [ngram_join.block_bits(n) for n in (1, 4096, 4097, 8192, 8193)] == [0, 0, 1, 1, 2]


def test_signatures_differ_in_no_more_bits_than_sets_in_ngrams():
    rnd = random.Random(12)
    for _ in range(200):
        one = {rnd.getrandbits(64) for _ in range(rnd.randint(1, 900))}
        other = {x for x in one if rnd.random() < 0.9} | {rnd.getrandbits(64) for _ in range(rnd.randint(0, 60))}
        x, y = (ngram_join.signature(np.array(sorted(z), dtype=np.uint64)).view(np.uint64) for z in (one, other))
        assert np.bitwise_count(x ^ y).sum() <= len(one ^ other)


def test_rows_that_share_their_prefix_but_cannot_link_make_no_pairs():
    rnd = random.Random(13)
    draw = lambda k: [rnd.getrandbits(64) for _ in range(k)]
    first, shared = draw(11), draw(70)
    sets = [np.array(first + shared + draw(19), dtype=np.uint64) for _ in range(40)]  # Jaccard similarity 0.68
    sets.append(np.concatenate((sets[7][:-2], np.array(draw(2), dtype=np.uint64))))  # 0.96 with row 7
    k, same = len(sets), np.zeros(len(sets), dtype=np.int64)
    cell = pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (same, same, same, np.arange(k), same, np.arange(k), same + 100, same + 11)]
        + [pa.array([ngram_join.signature(x) for x in sets]), pa.array([np.array(first, dtype=np.uint64).view(np.int64)] * k), pa.array([np.arange(11)] * k)],
        names=["block", "i", "j", "node", "own", "comp", "n", "live", "sig", "gram", "at"])
    found = [tuple(r.values()) for part in ngram_join._cells(iter([cell]), 90) for r in part.to_pylist()]
    assert found == [(7, 40, 100, 100, 11)]


def test_op11_equals_sql_and_all_pairs(spark):
    got = sorted(tuple(r) for r in queries.op11_ngram_join(spark, SMALL).select("doc_id", "n_shingles", "component_id").collect())
    rows = duck("SELECT doc_id, text FROM documents", SMALL)
    assert got == sorted(joined(rows)) == sorted(duck(ngram_join.ORACLE, SMALL))


# ---- importance resampling

def resampled(docs, target, min_words=20, share=10, k=10000):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(t or ""))
    raw = collections.Counter(zlib.crc32(w.encode()) % k for _, t in docs for w in words(t))
    aim = collections.Counter(zlib.crc32(w.encode()) % k for t in target for w in words(t))
    s, t_ = sum(raw.values()), sum(aim.values())
    out = []
    for i, text in docs:
        at = [zlib.crc32(w.encode()) % k for w in words(text)]
        gain = [math.floor(1000 * math.log((aim[b] + 1) * (s + k) / ((raw[b] + 1) * (t_ + k)))) for b in at]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(at), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    order = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[3], r[0] if r[0] is not None else 1 << 63, r[1]))
    drawn = collections.defaultdict(list)
    for k_, r in enumerate(order[:share * len(order) // 100], 1):
        drawn[r].append(k_)
    return sorted((r + (drawn[r].pop() if drawn[r] else None,) for r in out), key=str)


def test_op12_equals_brute_force(spark):
    got = [tuple(r) for r in queries.op12_importance_resampling(spark, MIDDLE).select("doc_id", "n_features", "weight", "score", "rank").collect()]
    want = resampled(duck("SELECT doc_id, text FROM documents", MIDDLE), [r[0] for r in duck("SELECT text FROM benchmark", MIDDLE)])
    assert sorted(got, key=str) == want


def test_resampling_on_awkward_rows(spark):
    rnd = random.Random(1)
    docs = [(i, " ".join(f"W{rnd.randrange(50)}" for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    docs += [(None, "a b " * 20)] * 40 + [(7, "a b " * 20)] * 3 + [(400, None), (401, ""), (402, "É! é-x " * 9), (403, "w1 " * 50_000)]
    target = ["w1 w2 w3", None, ""]
    given = spark.createDataFrame([(*d, "s", 1, "n") for d in docs], DOCS)
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    for how in ({}, {"samples": 2, "range_rows": 20}):
        got = importance.resample(given, aim, share=30, **how).select("id", "n_features", "weight", "score", "rank")
        assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(docs, target, share=30)
    assert importance.resample(given.where("false"), aim).count() == 0
    drawn = importance.draw(given, aim, share=30)
    assert drawn.columns == given.columns and 0 < drawn.count() < len(docs)


def test_ties_are_split_over_ranges(spark):
    given = spark.range(20_000).select(F.lit(5).cast("long").alias("low"), F.lit(1).cast("long").alias("x")).repartition(8)
    done = importance.ranks(given, F.lit(True), ["low"], share=100, samples=8, range_rows=500)
    assert sorted(r["rank"] for r in done.collect()) == list(range(1, 20_001))
    sizes = [r["n"] for r in done.groupBy(F.floor((F.col("rank") - 1) / 1000)).agg(F.count("rank").alias("n")).collect()]
    assert sizes == [1000] * 20


def test_runs_of_several_words():
    assert list(importance.buckets_of(b"A b-c", 10**9, 2, 3)) == [zlib.crc32(x) % 10**9 for x in (b"a b", b"b c", b"a b c")]
    assert len(importance.buckets_of(b"a", 100, 2, 3)) == 0


# ---- Merkle manifest

def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves, fan):
    """Root, and for each leaf its siblings (left, right) level by level."""
    proofs, members, nodes = [[] for _ in leaves], [[k] for k in range(len(leaves))], list(leaves)
    while len(nodes) > 1:
        runs = [range(a, min(a + fan, len(nodes))) for a in range(0, len(nodes), fan)]
        for run in runs:
            for j in run:
                for k in members[j]:
                    proofs[k].append(("".join(nodes[x] for x in run if x < j), "".join(nodes[x] for x in run if x > j)))
        members = [sum((members[j] for j in run), []) for run in runs]
        nodes = [H("".join(nodes[j] for j in run)) for run in runs]
    return nodes[0], proofs


def manifest(rows, fan=16):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = collections.defaultdict(list)
    for i, source, lang, n, text in rows:
        leaf = H("".join(map(field, (i, source, lang, n, text))))
        other = H("".join(map(field, (i, source, lang, n, text if text is None else ascii_lower(text)))))
        groups[source].append((i, leaf, other if i is not None and zlib.crc32(str(i).encode()) % 5 == 0 else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        subs[s] = tree([r[1] for r in groups[s]], fan)
    root, tops = tree([subs[s][0] for s in order], fan) if order else (None, [])
    out = []
    for s, top in zip(order, tops):
        for (i, leaf, x), inner in zip(groups[s], subs[s][1]):
            for a, b in inner + top:
                x = H(a + x + b)
            out.append((i, leaf, subs[s][0], root, H("".join(a + b for a, b in inner + top)), x, x == root))
    return sorted(out, key=str)


TABLE = "doc_id long, source string, lang string, n_chars long, text string"


def test_op13_equals_brute_force(spark):
    got = sorted((tuple(r) for r in queries.op13_merkle_manifest(spark, MIDDLE).collect()), key=str)
    rows = duck("SELECT doc_id, source, lang, n_chars, text FROM documents", MIDDLE)
    assert got == manifest(rows)
    assert {r[6] for r in got} == {True, False}


def test_manifest_of_hot_source_and_awkward_rows(spark):
    rows = [(i, "a", "x", i, f"Text {i}") for i in range(9000)] + [(None, "a", "x", 1, "Same")] * 700 + [(5, None, None, None, None)]
    rows += [(7, "b", "l", 1, "T")] * 3 + [(8, "", "é", -1, ""), (15, "long", "l", 1, "LONG é " * 100_000)] + [(k, f"s{k}", "l", 1, "") for k in range(300)]
    given = spark.createDataFrame(rows, TABLE).withColumns({"pos": F.lit("p"), "n": F.lit(1), "h": F.lit(None).cast("string"), "_range": F.lit(3)})
    assert sorted((tuple(r) for r in merkle.digest(given).collect()), key=str) == manifest(rows)
    assert merkle.digest(given.where("false")).count() == 0


@pytest.mark.parametrize("n", [1, 4, 10, 28, 82])
def test_butterfly_with_ragged_groups(spark, n):
    rows = [(i, "a", "x", i, f"T{i}") for i in range(n)] + [(i, f"s{i % 5}", "x", i, "") for i in range(11)]
    done = merkle.manifest(spark.createDataFrame(rows, TABLE), fanout=3, levels=1).collect()
    want = {(r[0], r[1]): r for r in manifest(rows, 3)}
    for r in done:
        proof = [(step["run"], step["at"]) for step in r["proof"]]
        assert (r["subroot"], r["root"], H(merkle.proof_text(proof))) == want[r["id"], r["leaf"]][2:5]
        assert merkle.refold(r["leaf"], proof) == r["folded"] == r["root"]
        assert merkle.refold(H("other"), proof) != r["root"]
