"""Language of words and documents by a linear-chain conditional random field.

Words carry affix, character n-gram and lexicon features; learned transitions tie neighbours together. The model is fitted on
sequences put together from passages of different languages, so that it learns what switching looks like. Forward-backward gives each
word of a line its marginal probabilities; a document's language is the one with most expected words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.llm.common import add_columns, text_of, worker_cached

WORD = re.compile(r"[^\W\d_]+").findall
SAMPLE_ROWS = 800  # documents per language the model is fitted on, the first by a hash of the id
PASSAGE, PASSAGES = 40, 4  # words and number of passages that a sampled document gives at most
SEQUENCES, LENGTH = 3_000, 36
MEMO = 300_000  # words whose scores a worker keeps; a full memo is emptied and fills again
SEGMENT = 128  # words of a line handled step by step; longer lines are cut, and the messages at the cuts make that exact
SCALE = 8  # steps after which messages are scaled again
BUCKETS = 32  # parts of a label's hashes that are ranked apart before they are ranked together


def features(word: str) -> list[str]:
    """Affixes, character n-grams with word borders, and the word itself."""
    n = len(word)
    out = ["w" + word] + ["p" + word[:k] for k in (1, 2, 3) if k <= n] + ["s" + word[-k:] for k in (1, 2, 3, 4) if k <= n]
    w = f"<{word}>"
    out += ["g" + w[i : i + 2] for i in range(n + 1)]
    out += ["g" + w[i : i + 3] for i in range(n)]
    return out


@dataclass
class Model:
    labels: list[str]
    weights: dict[str, tuple[float, ...]] = field(default_factory=dict)
    lexicon: dict[str, int] = field(default_factory=dict)  # word -> the label it belongs to
    lexical: tuple = ()  # per lexicon label, weights of being in it
    moves: list = field(default_factory=list)  # exp of transition weights, by label and next label
    start: list = field(default_factory=list)


class Tagger:
    """A model at work in one Python worker."""

    def __init__(self, model: Model):
        import numpy as np

        self.m = model
        self.k = len(model.labels)
        self.moves = np.array(model.moves).reshape(self.k, self.k)
        self.start = np.array(model.start)
        self.index = {f: i for i, f in enumerate(model.weights)}
        self.weights = np.array(list(model.weights.values()), float).reshape(len(self.index), self.k)
        self.lexical = np.array([*model.lexical, (0.0,) * self.k]).reshape(len(model.lexical) + 1, self.k)  # the last row for words outside the lexicon
        self.rows, self.memo = np.ones((0, self.k)), {}

    def scores(self, words: list[str]):
        """exp of the label scores of each word, the largest scaled to 1."""
        import numpy as np

        get, found, counts = self.index.get, [], []
        for w in words:
            own = [i for f in features(w) if (i := get(f)) is not None]
            found += own
            counts.append(len(own))
        owner, parts = np.repeat(np.arange(len(words)), counts), self.weights[np.array(found, np.int64)]
        e = np.stack([np.bincount(owner, parts[:, y], len(words)) for y in range(self.k)], 1)
        e = e + self.lexical[[self.m.lexicon.get(w, -1) for w in words]]
        return np.exp(e - e.max(axis=1, keepdims=True))

    def word(self, w: str):
        return self.scores([w])[0]

    def learn(self, words: list[str]) -> None:
        """Give a row of scores to each word that has none yet, all new ones at once."""
        import numpy as np

        if len(self.memo) > MEMO:
            self.memo, self.rows = {}, np.ones((0, self.k))
        new = list(dict.fromkeys(w for w in words if w not in self.memo))
        if new:
            self.memo.update(zip(new, range(len(self.memo), len(self.memo) + len(new))))
            self.rows = np.concatenate([self.rows, self.scores(new)])

    def lines(self, words: list[str], lengths):
        """Expected words per label of each line; ``lengths`` cuts ``words`` into lines.

        Lines are cut into segments of ``SEGMENT`` words. The segments of longer lines are first turned into matrices (label before, label at the end), all at once;
        chaining these gives the messages that enter each segment from both sides. Then all segments run forward and backward side by side."""
        import numpy as np

        self.learn(words)
        ids = np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))
        lengths = np.asarray(lengths)
        parts = -(-lengths // SEGMENT)
        line = np.repeat(np.arange(len(lengths)), parts)
        nth = np.arange(len(line)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = np.repeat(np.cumsum(lengths) - lengths, parts) + nth * SEGMENT
        size = np.minimum(lengths[line] - nth * SEGMENT, SEGMENT)
        into = np.broadcast_to(self.start, (len(line), self.k)).copy()
        beyond = np.ones((len(line), self.k))
        long = np.flatnonzero(parts[line] > 1)
        if len(long):
            self._messages(ids, begin, size, long, nth, parts, line, into, beyond)
        order = np.argsort(-size, kind="stable")
        total = np.zeros((len(line), self.k))
        total[order] = self._marginals(ids, begin[order], size[order], into[order], beyond[order])
        out = np.zeros((len(lengths), self.k))
        np.add.at(out, line, total)
        return out

    def _messages(self, ids, begin, size, long, nth, parts, line, into, beyond) -> None:
        """Fill ``into`` (before a segment's first word) and ``beyond`` (after its last) for the segments of cut lines."""
        import numpy as np

        long = long[np.argsort(-size[long], kind="stable")]
        first, live = begin[long], np.searchsorted(-size[long], -np.arange(size[long[0]]), "left")
        m = np.broadcast_to(np.eye(self.k), (len(long), self.k, self.k)).copy()
        for t, n in enumerate(live):
            x = self.rows[ids[first[:n] + t]][:, None, :]
            m[:n] = (m[:n] @ self.moves if t else m[:n]) * x
            if t % SCALE == SCALE - 1:
                m[:n] /= m[:n].max(axis=(1, 2), keepdims=True)
        whole = np.zeros((len(line), self.k, self.k))
        whole[long] = m
        by = [long[nth[long] == s] for s in range(parts.max())]
        for here in by[1:]:  # segment s of all cut lines that have one
            a = (into[here - 1][:, None, :] @ whole[here - 1])[:, 0] @ self.moves
            into[here] = a / a.sum(axis=1, keepdims=True)
        for here in by[:0:-1]:
            b = (whole[here] @ beyond[here][:, :, None])[:, :, 0] @ self.moves.T
            beyond[here - 1] = b / b.sum(axis=1, keepdims=True)

    def _marginals(self, ids, first, size, into, beyond):
        """Expected words per label of segments sorted by falling size."""
        import numpy as np

        live = np.searchsorted(-size, -np.arange(size[0]), "left") if len(size) else []  # segments longer than t
        alphas, xs, a = [], [], into
        for t, n in enumerate(live):
            x = self.rows[ids[first[:n] + t]]
            a = (a[:n] @ self.moves if t else a[:n]) * x
            if t % SCALE == SCALE - 1:
                a = a / a.sum(axis=1, keepdims=True)
            alphas.append(a)
            xs.append(x)
        total, beta = np.zeros((len(first), self.k)), beyond[:0]
        for t in range(len(alphas) - 1, -1, -1):
            n = live[t]
            if len(beta) < n:
                beta = np.concatenate([beta, beyond[len(beta) : n]])
            g = alphas[t] * beta
            total[:n] += g / g.sum(axis=1, keepdims=True)
            beta = (xs[t] * beta) @ self.moves.T
            if t % SCALE == 0:
                beta = beta / beta.sum(axis=1, keepdims=True)
        return total

    def documents(self, texts: list[str]):
        """``(label, share, expected words per label)`` of each text; label None if it has no letter."""
        import numpy as np

        words, lengths, owner, place, known = [], [], [], [], {}
        for d, t in enumerate(texts):
            for line in t.lower().split("\n"):
                at = known.get(line)
                if at is None:  # equal lines of a batch are worked out once
                    found = WORD(line)
                    at = known[line] = len(lengths) if found else -1
                    if found:
                        words += found
                        lengths.append(len(found))
                if at >= 0:
                    owner.append(d)
                    place.append(at)
        total = np.zeros((len(texts), self.k))
        if words and self.k:
            np.add.at(total, owner, self.lines(words, lengths)[place])
        out = []
        for t, x in zip(texts, total):
            n = x.sum()
            if not n or not any(map(str.isalpha, t)):
                out.append((None, 0.0, []))
            else:
                best = int(x.argmax())
                out.append((self.m.labels[best], float(min(1.0, x[best] / n)), x.tolist()))
        return out


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", rows: int = SAMPLE_ROWS) -> Model:
    """A model from the rows of ``docs`` with text and label.

    Per label at most ``rows`` documents are used, the first by a hash of id and text (all if there are fewer), and of each up to
    ``PASSAGES`` passages of ``PASSAGE`` words, spread over the whole text. Equal texts count once. Without labelled rows the model knows no
    label; with one label it always says that.
    """
    d = docs.select(docs[f"`{label}`"].cast("string").alias("l"), docs[f"`{text}`"].alias("t"), docs[f"`{key}`"].alias("id")).where("l is not null and t is not null")
    h = F.xxhash64("t")
    best = d.select("l", h.alias("h")).distinct()
    for by in (["l", F.pmod(F.col("h"), F.lit(BUCKETS))], ["l"]):  # at most ``BUCKETS * rows`` hashes of a label come to one task
        best = best.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("h"))).where(F.col("r") <= rows).drop("r")
    picked = d.withColumn("h", h).join(F.broadcast(best.select("l", "h")), ["l", "h"])  # at most ``rows`` per label

    def passages(texts):
        out = []
        for t in texts:
            w = WORD(t.lower())
            n = min(PASSAGES, -(-len(w) // PASSAGE))
            out.append([w[i * len(w) // n : i * len(w) // n + PASSAGE] for i in range(n)] if w else [])
        return [out]

    cut = add_columns(picked, [picked["t"]], "p array<array<string>>", passages, batch_rows=500).select("l", "h", "p").dropDuplicates(["l", "h"])
    got = sorted(((r.l, r.h, r.p) for r in cut.collect() if r.p), key=lambda x: x[:2])
    return _train([(lab, p) for lab, _, ps in got for p in ps])


def _train(passages: list[tuple[str, list[str]]], steps: int = 90, l2: float = 1e-3) -> Model:
    import numpy as np

    labels = sorted({lab for lab, _ in passages})
    k = len(labels)
    if k < 2:
        return Model(labels, {}, {}, (), [1.0] * k, [1.0] * k)
    rng = np.random.default_rng(20)
    by = [[p for lab, p in passages if lab == x] for x in labels]
    counts: dict[str, np.ndarray] = {}
    for y, ps in enumerate(by):
        for p in ps:
            for w in p:
                counts.setdefault(w, np.zeros(k))[y] += 1
    lexicon = {w: int(c.argmax()) for w, c in counts.items() if c.sum() >= 8 and c.max() >= 0.95 * c.sum()}
    types = {w: i for i, w in enumerate(sorted(counts))}
    seen: dict[str, int] = {}
    for w in types:
        for f in features(w):
            seen[f] = seen.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 3 or f[0] == "w" and counts[f[1:]].sum() >= 8))}
    n_feat = len(index) + k
    rows, cols = [], []
    for w, i in types.items():
        f = [index[x] for x in features(w) if x in index] + ([len(index) + lexicon[w]] if w in lexicon else [])
        rows += [i] * len(f)
        cols += f
    rows, cols = np.array(rows), np.array(cols)
    words, ys = np.zeros((LENGTH, SEQUENCES), int), np.zeros((LENGTH, SEQUENCES), int)
    for s in range(SEQUENCES):
        t = 0
        while t < LENGTH:
            y = int(rng.integers(k))
            p = by[y][int(rng.integers(len(by[y])))]
            take = p[: int(rng.integers(4, 25))][: LENGTH - t]
            words[t : t + len(take), s] = [types[w] for w in take]
            ys[t : t + len(take), s] = y
            t += len(take)
    par = np.zeros((n_feat, k))
    trans, start = np.zeros((k, k)), np.zeros(k)
    want_e = np.zeros((len(types), k))
    np.add.at(want_e, (words.ravel(), ys.ravel()), 1)
    want_t = np.zeros((k, k))
    np.add.at(want_t, (ys[:-1].ravel(), ys[1:].ravel()), 1)
    want_s = np.bincount(ys[0], minlength=k)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (par, trans, start)]
    for step in range(1, steps + 1):
        e = np.stack([np.bincount(rows, par[cols, y], len(types)) for y in range(k)], 1)
        x = np.exp(e - e.max(axis=1, keepdims=True))[words]  # by place, sequence, label
        move = np.exp(trans)
        alpha = np.zeros_like(x)
        a = np.exp(start) * x[0]
        for t in range(LENGTH):
            if t:
                a = (alpha[t - 1] @ move) * x[t]
            alpha[t] = a / a.sum(axis=1, keepdims=True)
        got_t, beta = np.zeros((k, k)), np.ones_like(x[0])
        gamma = np.zeros_like(x)
        for t in range(LENGTH - 1, -1, -1):
            g = alpha[t] * beta
            gamma[t] = g / g.sum(axis=1, keepdims=True)
            if t:
                right = x[t] * beta
                z = ((alpha[t - 1] @ move) * right).sum(axis=1, keepdims=True)
                got_t += move * ((alpha[t - 1] / z).T @ right)
                beta = right @ move.T
                beta = beta / beta.sum(axis=1, keepdims=True)
        got_e = np.stack([np.bincount(words.ravel(), gamma[:, :, y].ravel(), len(types)) for y in range(k)], 1)
        diff = got_e - want_e
        grads = (np.stack([np.bincount(cols, diff[rows, y], n_feat) for y in range(k)], 1) + l2 * SEQUENCES * par, got_t - want_t, gamma[0].sum(axis=0) - want_s)
        for p, g, mv in zip((par, trans, start), grads, state):
            mv[0][:] = 0.9 * mv[0] + 0.1 * g
            mv[1][:] = 0.99 * mv[1] + 0.01 * g * g
            p -= 0.05 * (mv[0] / (1 - 0.9**step)) / (np.sqrt(mv[1] / (1 - 0.99**step)) + 1e-6)
    weights = {f: tuple(par[i].tolist()) for f, i in index.items()}
    return Model(labels, weights, lexicon, tuple(tuple(x) for x in par[len(index) :].tolist()), np.exp(trans).ravel().tolist(), np.exp(start).tolist())


def identify(docs: DataFrame, model: Model, text: str = "text", unknown: str = "und") -> DataFrame:
    """``docs`` with ``language`` (a label of the model, or ``unknown`` if the text is null or has no letter, or the model knows no
    label), ``language_share`` (its share of expected words, 0 if unknown) and ``language_words`` (label -> expected words).

    Each whole text is labelled alone, line by line and word by word; no shuffle. Ties go to the smaller label.
    """
    import uuid

    shared, uid = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(texts):
        got = worker_cached("language", uid, lambda: Tagger(shared.value)).documents(texts)
        names = shared.value.labels
        return [[g[0] or unknown for g in got], [g[1] for g in got], [list(zip(names, g[2])) for g in got]]

    return add_columns(docs, [text_of(docs, text)], "language string, language_share double, language_words map<string,double>", run, batch_rows=1000)
