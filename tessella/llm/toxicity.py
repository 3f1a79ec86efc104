"""Toxicity by multiple-instance learning.

Only documents carry labels. Each sentence gets a probability from its words; a document is toxic if any of its sentences is
(noisy-or), and the sentence model is fitted through that from the document labels. Afterwards the sentence probabilities
say where the offending sentences are.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import add_columns, text_of, worker_cached

SENTENCE = re.compile(r"[^.!?\n]+").finditer
WORD = re.compile(r"[^\W\d_]+").findall
SAMPLE_ROWS = 12_000  # labelled documents a model is fitted on, taken by a hash of the id within each label
SAMPLE_CODES = 8_000_000  # occurrences of telling features in the sample: 16 MB on the driver; documents beyond go, by the same hash
SLICE = 500  # documents of a gradient step's slice
NEVER = -30.0  # bias of a model without toxic examples: no document has enough sentences to come near even odds
VOCABULARY = 3_000  # features that may carry a weight, the most telling of toxic documents
LEAST = 3.0  # standard deviations by which toxic documents must prefer them
MEMO = 300_000  # words whose scores a worker keeps


def features(word: str) -> list[str]:
    """The word, and its beginnings and endings, so that new forms of an offensive stem are known."""
    n = len(word)
    return ["w" + word] + ["p" + word[:k] for k in range(3, 9) if k <= n] + ["s" + word[-k:] for k in (3, 4, 5) if k <= n]


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def word(self, word: str) -> float:
        get = self.weights.get
        return math.fsum(get(f, 0.0) for f in features(word))


class Scorer:
    """A model at work in one Python worker, with a memo of word scores that is emptied when full."""

    def __init__(self, model: Model):
        self.bias, self.memo = model.bias, _Memo(model)

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Probability of a document, and (start, end, probability) of its offending sentences."""
        bias, get = self.bias, self.memo.__getitem__
        quiet = math.log1p(math.exp(bias))
        log_clean, found, plain = 0.0, [], 0
        for m in SENTENCE(text):
            words = WORD(m[0].lower())
            if not words:
                continue
            z = math.fsum(map(get, set(words)))
            if not z:
                plain += 1
                continue
            z += bias
            log_clean -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
            if z >= 0:
                found.append((m.start(), m.end(), 1 / (1 + math.exp(-z))))
        return -math.expm1(log_clean - plain * quiet), found


class _Memo(dict):
    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > MEMO:
            self.clear()
        got = self[word] = self.model.word(word)
        return got


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", rows: int = SAMPLE_ROWS, occurrences: int = SAMPLE_CODES) -> Model:
    """A model from the labelled rows of ``docs``.

    At most ``rows`` labelled documents with ``occurrences`` telling features in all are used (all of them if there are fewer): toxic ones up to half the bound, or more if
    there are too few others, and clean ones for the rest, of each label the first by a hash of their id. Clean documents weigh as
    many times more as they were thinned out more, so rare toxic documents all count and the odds are those of all labels. Equal
    texts count once, and with contradicting labels as toxic. Null ids, texts and labels take no part. Without toxic documents in
    the sample every text scores next to 0; with nothing else in it, every text that has a sentence above 0.5.
    """
    known = labels.select(labels[f"`{key}`"].alias("id"), labels[f"`{label}`"].cast("int").alias("y")).where("id is not null and y in (0, 1)")
    known = known.groupBy("id").agg(F.max("y").alias("y"))
    there = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    toxic, clean = there.get(1, 0), there.get(0, 0)
    n_toxic = min(toxic, max(rows // 2, rows - clean))
    n_clean = min(clean, rows - n_toxic)
    known = [known.where(F.col("y") == y).sort(F.xxhash64("id"), "id").limit(n) for y, n in ((1, n_toxic), (0, n_clean))]
    known = known[0].unionByName(known[1])
    heavier = (clean / n_clean) / (toxic / n_toxic) if n_clean and n_toxic else 1.0
    plain = docs.select(docs[f"`{key}`"].alias("id"), docs[f"`{text}`"].alias("t")).where("t is not null")
    sample = plain.join(F.broadcast(known), "id")  # at most ``rows`` ids

    def words(texts):
        return [[[sorted(set(WORD(m[0].lower()))) for m in SENTENCE(t)] for t in texts]]

    bags = add_columns(sample, [sample["t"]], "s array<array<string>>", words, batch_rows=500)
    bags = bags.groupBy(F.xxhash64("t").alias("h"), F.octet_length("t").alias("n")).agg(F.max("y").alias("y"), F.first("s").alias("s")).select("y", "s", "h", "n")
    bags = bags.persist()
    try:
        n, n_pos = bags.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
        if not 0 < n_pos < n:
            return Model({}, NEVER if not n_pos else 0.01)
        by_feature = bags.mapInArrow(_count, "f string, df long, pos long").groupBy("f").agg(F.sum("df").alias("df"), F.sum("pos").alias("pos"))
        by_feature = by_feature.where("df >= 4")
        rate = n_pos / n
        z = (F.col("pos") - F.col("df") * rate) / F.sqrt(F.col("df") * rate * (1 - rate) * (1 - F.col("df") / n) + 1)
        best = by_feature.withColumn("z", z).where(F.col("z") >= LEAST).sort(F.desc("z"), "f").limit(VOCABULARY)
        index = {f: i for i, f in enumerate(sorted(r.f for r in best.select("f").collect()))}

        def codes(lists):
            import numpy as np

            n, sizes, flat = [], [], []
            for x in lists:
                own = [c for s in x if (c := [index[f] for w in s for f in features(w) if f in index])]
                n.append(sum(1 for s in x if s))
                sizes.append(np.array([len(c) for c in own], np.int32).tobytes())
                flat.append(np.array([i for c in own for i in c], np.int16).tobytes())
            return [n, sizes, flat]

        coded = add_columns(bags, [bags["s"]], "sentences int, sizes binary, flat binary", codes, batch_rows=500)
        coded = coded.where("h is not null").select("y", "h", "n", "sentences", "sizes", "flat").persist()
        try:
            heavy = coded.select("y", "h", "n", (F.octet_length("flat") / 2).cast("long").alias("c")).collect()  # four numbers for each of at most ``rows`` documents
            cuts = _cuts(heavy, occurrences)
            kept = coded.where(F.col("h") <= F.when(F.col("y") == 1, cuts[1][0]).otherwise(cuts[0][0]))
            packed = kept.sort("h", "n").select("y", "sentences", "sizes", "flat").toArrow()  # bounded by ``rows`` and ``occurrences``
        finally:
            coded.unpersist()
    finally:
        bags.unpersist()
    return _descend(packed, index, heavier * cuts[0][1] / cuts[1][1])


def _cuts(rows, most: int) -> list[tuple[int, float]]:
    """Per label the largest hash taken and how much the label is thinned out, so that at most ``most`` occurrences (and a document of each label) remain."""
    share, out = min(1.0, most / max(1, sum(r.c for r in rows))), []
    for y in (0, 1):
        own = sorted((r.h, r.n, r.c) for r in rows if r.y == y)
        room, taken = share * sum(c for _, _, c in own), 0
        for i, (_, _, c) in enumerate(own):
            taken += c
            if taken > room * (1 + 1e-9) and i:
                own_kept = own[:i]
                break
        else:
            own_kept = own
        out.append((own_kept[-1][0] if own_kept else 0, len(own) / max(1, len(own_kept))))
    return out


def _count(batches):
    """Documents and toxic documents per feature, summed within each batch."""
    import pyarrow as pa

    for b in batches:
        df, pos = Counter(), Counter()
        for y, sentences in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            own = {f for w in {w for s in sentences for w in s} for f in features(w)}
            df.update(own)
            if y:
                pos.update(own)
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.string()), pa.array(list(df.values()), pa.int64()), pa.array([pos[f] for f in df], pa.int64())], names=["f", "df", "pos"])


def _packed(column, dtype):
    """The bytes of a binary Arrow column as one array, and the number of values of each row; no copy per row."""
    import numpy as np
    import pyarrow as pa

    whole = pa.chunked_array([c.cast(pa.large_binary()) for c in column.chunks], pa.large_binary()).combine_chunks()
    whole = whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)
    at = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = np.frombuffer(whole.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    return data.view(dtype), np.diff(at) // np.dtype(dtype).itemsize


def _descend(packed, index: dict[str, int], heavier: float = 1.0, steps: int = 400, l1: float = 0.3, l2: float = 0.02) -> Model:
    """Fit by proximal Adam steps on the noisy-or likelihood, in which a clean row counts ``heavier`` times. ``packed``: a row per document with its label, its
    sentences, the features of each sentence that has any (``sizes``) and their numbers (``flat``). A step goes over slices of ``SLICE`` documents,
    so besides the packed numbers only one slice is in memory."""
    import numpy as np

    y = packed.column("y").to_numpy().astype(float)
    lens, told = _packed(packed.column("sizes"), np.int32)
    feat, _ = _packed(packed.column("flat"), np.int16)
    plain = packed.column("sentences").to_numpy().astype(float) - told
    n_feat = len(index)
    sent_at, feat_at = np.concatenate([[0], np.cumsum(told)]), np.concatenate([[0], np.cumsum(lens)])
    slices = []
    for a in range(0, len(y), SLICE):
        z = min(a + SLICE, len(y))
        s, e = sent_at[a], sent_at[z]
        slices.append((slice(a, z), slice(s, e), slice(feat_at[s], feat_at[e]), told[a:z]))
    w, b = np.zeros(n_feat), math.log(0.001)
    m, v = np.zeros(n_feat + 1), np.zeros(n_feat + 1)
    soft = lambda z: np.logaddexp(0, z)
    for step in range(1, steps + 1):
        grad = np.append(l2 * w, 0.0)
        for docs, sents, feats, counts in slices:
            f, size = feat[feats], lens[sents]
            doc = np.repeat(np.arange(len(counts)), counts)
            z = b + (np.add.reduceat(w[f], np.cumsum(size) - size) if len(f) else np.zeros(0))
            log_clean = -np.bincount(doc, soft(z), len(counts)) - plain[docs] * soft(b)
            clean = np.exp(log_clean)
            pull = np.where(y[docs] > 0, -clean / np.maximum(1 - clean, 1e-9), heavier)
            gz = pull[doc] / (1 + np.exp(-z))
            grad[:-1] += np.bincount(f, np.repeat(gz, size), n_feat)
            grad[-1] += gz.sum() + (pull * plain[docs]).sum() / (1 + math.exp(-b))
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        rate = 0.1 * (1 if step < steps / 2 else 0.2)
        scale = rate / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        move = scale * m / (1 - 0.9**step)
        w = w - move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - l1 * scale[:-1], 0)
        b -= move[-1]
    return Model({x: float(w[i]) for x, i in index.items() if w[i]}, float(b))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_sentences`` (array of (start, end, score) in code points, those with at
    least even odds). Each whole text is scored alone, no shuffle; null and empty text have no sentence and score 0."""

    uid = uuid.uuid4().hex

    def run(texts):
        scorer = worker_cached("toxicity", uid, lambda: Scorer(model))
        got = [scorer.score(t) for t in texts]
        return [[s for s, _ in got], [[{"start": a, "end": b, "score": p} for a, b, p in f] for _, f in got]]

    return add_columns(docs, [text_of(docs, text)], "toxicity double, toxic_sentences array<struct<start:int,end:int,score:double>>", run, batch_rows=1000)


def held_out(key: str, folds: int, fold: int) -> F.Column:
    """Whether crc32 of the id as text falls into one fold."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(folds)) == fold
