"""Components of near copies grow before their pairs are compared, and a written table leaves no shuffle files."""

import random
import time

from pyspark.sql import functions as F

from tessella.llm import ngram_join as N
from tessella.session import save


def near_copies(n, seed):
    rnd = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for i in range(n):
        words = list(base)
        for at in rnd.sample(range(150), rnd.randrange(1, 12)):
            words[at] = f"x{i}_{at}"
        texts.append(" ".join(words))
    return texts


def brute(texts):
    sets = [frozenset(N.shingle_set(t).tolist()) for t in texts]
    linked = [(a, b) for a, x in enumerate(sets) for b in range(a) if 9 * len(x & sets[b]) >= 4 * (len(x) + len(sets[b]))]
    root = list(range(len(texts)))
    while any(root[a] != root[b] for a, b in linked):
        for a, b in linked:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_most_pairs_of_near_copies_are_never_compared(spark, monkeypatch):
    texts = near_copies(600, 3)
    compared, plain = [], N.compare

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(N, "compare", counted)
    docs = spark.createDataFrame([*enumerate(texts), (900, None), (901, ""), (None, texts[0])], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in N.join(docs).where("n_shingles > 0 and doc_id is not null").collect()}
    assert got == dict(enumerate(brute(texts)))
    assert sum(compared) < 3 * len(texts), compared


def test_rows_among_ids(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(-500, 500)] + [(7, "twice"), (None, "none")], "id long, t string")
    ids = spark.createDataFrame([(i,) for i in (-500, -3, 0, 7, 7, 499, 10**12, None)], "id long")
    got = sorted((r.id, r.t) for r in N._among(rows, ids).collect())
    assert got == [(-500, "t-500"), (-3, "t-3"), (0, "t0"), (7, "t7"), (7, "twice"), (499, "t499")]


def test_a_written_table_leaves_no_shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {b for b in disk.getAllBlocks().mkString(" ").split() if b.startswith("shuffle_")}
    before = shuffled()
    t = save(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    end = time.time() + 10
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before
    assert t.agg(F.sum("count")).first()[0] == 1000
