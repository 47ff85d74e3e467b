"""The toxicity model holds the counted pairs of both classes; its slices, packed columns and joined parts say the same."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from flightops.llm import toxicity


def corpus(spark, n=240):
    rnd = random.Random(21)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{chr(97 + rnd.randrange(26))}{chr(97 + rnd.randrange(4))}" for _ in range(30)]
        w[4:4] = ["good", "day"] if i % 3 else ["vile", "rat"]
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 3 == 0)))
    rows += [(n, None), (n + 1, ""), (None, "good day vile rat"), (3, rows[3][1]), (n + 2, "rat good day " * 2000)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.mark.parametrize("wide", [0, 1, 2, 5, 8])
def test_packed_columns_come_back(wide):
    rng = np.random.default_rng(wide)
    cols = [rng.integers(0, 1 << 8 * wide, 300, dtype=np.uint64, endpoint=False) if wide and wide < 8 else rng.integers(0, 2**64 if wide else 1, 300, dtype=np.uint64)
            for _ in range(3)]
    cols[0].sort()
    assert all((a == b).all() for a, b in zip(cols, toxicity.unpack(toxicity.pack(cols)), strict=True))
    assert [len(c) for c in toxicity.unpack(toxicity.pack([c[:0] for c in cols]))] == [0, 0, 0]


@pytest.mark.parametrize("slices", [1, 7])
def test_pairs_of_ordinary_texts_alone_are_counted(spark, slices):
    rnd = random.Random(5)
    texts = [(" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 9))), int(i % 4 == 0), i % 2) for i in range(50)] + [(None, 0, 0), ("x x y", 0, 0), ("x y", 0, 1)]
    words, pairs = toxicity.fit_counts(spark.createDataFrame(texts, "text string, toxic int, left int"), either=True, slices=slices)
    code = {x: int(toxicity.tokens(x.encode())[0]) for x in "abcdxy"} | {"": 0}
    for model in (0, 1):
        n, front = {}, {}
        for text, toxic, left in texts:
            if text is None or left and not model:
                continue
            w = ["", "", *text.split()]
            for u, v, x in zip(w, w[1:], w[2:]):
                n[x, v, toxic] = n.get((x, v, toxic), 0) + 1
                front.setdefault((x, v, toxic), set()).add(code[u] % 31)
        less = {k: c - 1.5 if c > 1 and (not k[2] or len(front[k]) > 1) else 0.0 for k, c in n.items()}
        found = {r["pair"] % (1 << 64): tuple(r[2:]) for r in pairs.where(f"model = {model}").select("model", "pair", "tox", "ord", "tox_mass", "ord_mass", "rest").collect()}
        want = {}
        for x, v in {k[:2] for k, c in less.items() if c}:
            mass = [sum(c for k, c in less.items() if k[1] == v and k[2] == y) for y in (1, 0)]
            z = sum(c for k, c in n.items() if k[1] == v)
            want[code[x] << 32 | code[v]] = (less.get((x, v, 1), 0.0), less.get((x, v, 0), 0.0), *mass, 1 - sum(mass) / z)
        assert found == want and any(not t for t, *_ in want.values())
        seen = {r["word"]: (r["tox"], r["ord"]) for r in words.where(f"model = {model}").collect()}
        assert seen == {code[x]: tuple(sum(k[0] == x and k[2] == y for k in n) for y in (1, 0)) for x in {k[0] for k in n}}


def test_an_expression_of_ordinary_texts_speaks_for_them(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(600):  # both classes use all words; ordinary texts say "plain old rope" in that order
        w = [f"w{chr(97 + rnd.randrange(12))}" for _ in range(30)]
        if i % 3:
            w[9:9] = ["plain", "old", "rope"]
        else:
            for at, x in zip((3, 11, 19), rnd.sample(["plain", "old", "rope"], 3)):
                w.insert(at, x)
        rows.append((" ".join(w), int(i % 3 == 0), 0))
    train, docs = spark.createDataFrame(rows, "text string, toxic int, left int"), spark.createDataFrame([("wa plain old rope wb",)], "text string")
    said = [toxicity.with_features(docs, *(t.where("model = 1") for t in toxicity.fit_counts(train, either=e))).first()["_tx_whole"] for e in (False, True)]
    assert said[1] < said[0] - 0.1


@pytest.mark.parametrize("rows", [1, 150, 10**6])
def test_slices_of_the_model_score_like_joined_parts(spark, monkeypatch, rows):
    given = corpus(spark)
    key = lambda r: (str(r["doc_id"]), r["text"] or "")
    joined = sorted(toxicity.score(*given, most=0).collect(), key=key)
    if rows == 1:
        rows = 60
        monkeypatch.setattr(toxicity, "PART_BYTES", 400)
    monkeypatch.setattr(toxicity, "PART_ROWS", rows)
    sliced = sorted(toxicity.score(*given).collect(), key=key)
    assert len(sliced) == 245 and np.allclose([r["score"] for r in sliced], [r["score"] for r in joined], rtol=0, atol=1e-9)


def test_a_worker_holds_one_slice_of_a_large_model(spark, monkeypatch):
    class Held:
        def __init__(self, value):
            self.made = value

        @property
        def value(self):
            self._value = self.made
            return self.made

    monkeypatch.setattr(toxicity, "PART_ROWS", 200)
    docs, labels = corpus(spark)
    words, pairs = (t.where("model = 1") for t in toxicity.fit_counts(docs.join(labels, "doc_id").select("text", "toxic", F.lit(0).alias("left")), either=True))
    rows = words.count() + pairs.count()
    parts = toxicity._shared(words, pairs, (1000.0, 2000.0, 100.0), rows)
    sizes = [len(p.value[0]) + len(p.value[5]) for p in parts]
    assert sum(sizes) == rows and len(sizes) == -(-rows // 200) and max(sizes) < 600
    held = [Held(p.value) for p in parts]
    now, before, _ = toxicity._batch_tokens([r["text"].encode() for r in docs.where("text is not null").collect()])
    toxicity.evidence_of(held, now, before)
    assert not any("_value" in vars(h) for h in held)
