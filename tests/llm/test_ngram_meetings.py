"""Sets that share a frequent n-gram, but too few others, do not meet one by one."""

import random
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tessella.llm import ngram_join


def sets(n=60, common=40, own=20, seed=3):
    """Sets of one size with ``common`` n-grams in all of them: similarity 1/2 at most, if ``own`` is half of ``common``."""
    r = random.Random(seed)
    shared = [r.getrandbits(64) for _ in range(common)]
    return [np.unique(np.array(shared + [r.getrandbits(64) for _ in range(own)], np.uint64)) for _ in range(n)]


def test_parities_never_exceed_the_difference():
    r = random.Random(5)
    for _ in range(300):
        a = {r.getrandbits(64) for _ in range(r.randint(0, 900))}
        b = {x for x in a if r.random() < 0.8} | {r.getrandbits(64) for _ in range(r.randint(0, 90))}
        x, y = (ngram_join.parities(np.array(sorted(s), np.uint64)) for s in (a, b))
        assert len(x) * 64 == ngram_join.BITS
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(a ^ b)


def test_far_sets_of_one_list_do_not_meet(spark):
    found = sets()
    linked = np.unique(np.append(found[0][:-2], np.array([1, 2], np.uint64)))  # 58 of 62 shared: a link
    rows = [(i, len(s), 0, 7, ngram_join.parities(s).tolist()) for i, s in enumerate([*found, linked])]
    entries = spark.createDataFrame(rows, "id long, n int, pos int, token long, bits array<long>")
    met = ngram_join._meetings(entries, ["id", "n", "pos", "bits"], Fraction(4, 5)).where("id_a < id_b").collect()
    assert [(m.id_a, m.id_b) for m in met] == [(0, len(found))]


def test_a_pair_meets_at_its_first_shared_ngram(spark):
    """Sets that share most of a long prefix meet a few times, not once per n-gram, and no pair is lost."""
    r, rows = random.Random(9), []
    for i in range(12):
        p = [t for t in range(200) if r.random() < 0.7]  # 49 of 100 n-grams in both prefixes of a pair
        rows.append((i, 1000, len(p), [1, 2], p))
    sets_ = spark.createDataFrame(rows, "id long, n int, size int, bits array<long>, prefix array<long>")
    index = sets_.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    entries = ngram_join._entries(index, sets_.select("id", "bits", "prefix"), ["id"]).withColumn("bits", F.array(*[F.lit(0).cast("long")] * 8))
    assert entries.count() == index.count()
    met = ngram_join._meetings(entries, ["id", "n", "pos", "bits", "before"], Fraction(4, 5)).select("id_a", "id_b").collect()
    assert {(m.id_a, m.id_b) for m in met} == {(a, b) for b in range(12) for a in range(b)}
    assert len(met) < 1.2 * 66


def test_near_groups_keep_their_links(spark, monkeypatch):
    """Chains of texts that change a word a step and share most words with other chains; turns are off, so that every meeting counts."""
    monkeypatch.setattr(ngram_join, "CROSS", 1 << 40)
    r = random.Random(8)
    docs = []
    for g in range(6):
        text = [f"w{i}" for i in range(40)] + [f"g{g}x{i}" for i in range(30)]
        for _ in range(12):
            text = list(text)
            text[r.randrange(len(text))] = f"new{r.getrandbits(30)}"
            docs.append((len(docs), " ".join(text)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    grams = [set(ngram_join.shingle_set(t).tolist()) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i in range(len(docs)):
        for j in range(i):
            c = len(grams[i] & grams[j])
            if 5 * c >= 4 * (len(grams[i]) + len(grams[j]) - c):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = {x.doc_id: x.component_id for x in ngram_join.join(d).collect()}
    assert got == {i: find(i) for i in range(len(docs))} and len(set(got.values())) > 1
    pairs, _ = ngram_join.links(d)
    want = sum(5 * len(a & b) >= 4 * len(a | b) for i, a in enumerate(grams) for b in grams[:i])
    assert pairs.count() == want and pairs.where(F.col("common") * 5 < F.col("total") * 4).isEmpty()
