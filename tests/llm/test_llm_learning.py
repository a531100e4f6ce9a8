"""What is learned comes from all rows; what is compared is few."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from churnwright.llm import pii, simhash


def test_personal_data_is_learned_from_every_text(spark, monkeypatch):
    staged, stage = {}, pii.stage

    def kept(df, label):
        staged[label] = out = stage(df, label)
        return out

    monkeypatch.setattr(pii, "stage", kept)
    n = 24_000  # more texts, and more matches, than were asked before
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.format_string("write to u%d@example.org or u%d@example.org, a@b.c a@b.c", "id", "id").alias("text"))
    model = pii.learn(docs.repartition(4))
    # of each text three different matches: good and broken of an e-mail, good and broken of the three other kinds; broken e-mails may be no match
    got = staged["pii-examples"].where("y = 1").groupBy("kind").agg(F.sum("n").alias("n")).collect()
    assert {r.kind: r.n for r in got} == {float(k): 4.0 * n for k in range(4)}
    assert model["trees"] and set(model["cuts"]) == {0, 1, 2, 3}


def test_candidates_are_judged_before_their_texts_are_read(spark, monkeypatch):
    rnd = random.Random(31)
    text = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(120):  # copies of one text with words changed at places of their own: most are too far from each other
        made = list(text)
        for k in rnd.sample(range(60), 2):
            made[k] = f"x{i}_{k}"
        texts[i] = " ".join(made)
    texts |= {1000 + i: " ".join([*(f"p{k}" for k in range(12)), *(f"q{i}_{k}" for k in range(60))]) for i in range(60)}  # and texts that share a passage only
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    grams = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, w in ((d, t.split()) for d, t in texts.items())}
    near = {(a, b) for a, b in itertools.combinations(texts, 2) if len(grams[a] & grams[b]) / len(grams[a] | grams[b]) >= 0.8}
    root = {d: d for d in texts}
    for _ in texts:
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
    compared, verified = [], simhash.verified

    def counted(pairs, *rest):
        compared.extend((r.u, r.v) for r in pairs.collect())
        return verified(pairs, *rest)

    monkeypatch.setattr(simhash, "verified", counted)
    for few in (simhash.FEW, 1):
        monkeypatch.setattr(simhash, "FEW", few)
        compared.clear()
        assert {r.doc_id for r in simhash.keep_first(docs).collect()} == set(root.values())
        assert len(compared) < 1500  # there are 7,140 pairs that share a rare shingle among the first


def test_bitmaps_differ_in_no_more_bits_than_the_sets(spark):
    rnd = np.random.default_rng(5)
    for n, extra in ((1, 0), (40, 3), (500, 60), (3000, 400)):
        a = np.unique(rnd.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[extra:], rnd.integers(0, 2**63, extra, dtype=np.uint64)]))
        bits = [np.array(simhash.bitmap(x), np.int64).view(np.uint64) for x in (a, b)]
        assert len(bits[0]) == simhash.WORDS and np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(a, b))
