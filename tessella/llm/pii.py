"""Personal data in texts: base patterns, and further spans that a boosted model selects from generous candidates.

Generators propose overlapping spans: anything that might be an address with spelled-out or spaced separators, and any run of
digits with punctuation. Gradient-boosted trees judge each by its format and context, and a threshold per kind, calibrated on
candidates kept out of the fit, decides. Spans of the base patterns always stay. Trees and thresholds come from the examples of all
texts: equal binned examples are counted once, and Spark adds up the histograms from which the driver takes each split.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import add_columns, text_of, worker_cached
from tessella.session import discard, save

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.99  # of the candidates above a kind's threshold
GRID = 1 << 16  # thresholds are multiples of one such part
FINE = 1 << 24  # gradients are added up as whole numbers of such parts, so that sums do not depend on the order of the rows
PARTS = 64  # partitions whose sums go to the driver without a shuffle
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")
AT = re.compile(r"\s?(?:\(at\)|\[at\]|\{at\}|<at>)\s?|\sat\s|\s@\s?|@\s", re.I)
AFTER_AT = re.compile(r"[A-Za-z0-9-]{1,63}(?:(?:\s?(?:\(dot\)|\[dot\]|\{dot\}|<dot>)\s?|\sdot\s|\s?\.\s?)[A-Za-z0-9-]{2,63})+", re.I)
NUMBER = re.compile(r"(?<![0-9])[+(]?[0-9](?:[ ().\-/]{0,3}[0-9])++")
LOOSE_IP = re.compile(r"[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}(?![0-9.])")
DATE = re.compile(r"(?:19|20)[0-9]{2}[-/.][0-9]{1,2}[-/.][0-9]{1,2}|[0-9]{1,2}[-/.][0-9]{1,2}[-/.](?:19|20)?[0-9]{2}(?![0-9])")
# Words that announce a kind, and words that announce other numbers, in the languages of the corpus.
SIGNS = {
    "email": re.compile(r"e-?mail|mail|correo|courriel|contact|kontakt|write", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|adresse|direcci", re.I),
    "card": re.compile(r"card|karte|carte|tarjeta|visa|credit|kredit", re.I),
    "phone": re.compile(r"phone|tel\b|tel\.|tel:|call|mobile|fax|anruf|t[ée]l[ée]|llama|whatsapp", re.I),
}
OTHER = re.compile(r"version|\bv\.?$|date|datum|fecha|order|invoice|isbn|price|\$|€|£|no\.|nr\.|#|token|key|secret|hash", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str):
    last = 0
    at = text.find("@")
    while at >= 0:
        s = at
        while s > last and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            yield s, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def base(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Spans of the base patterns by start and kind, and the matches that fail their kind's test."""
    good, bad = [], []
    if "@" in text:
        good += [("email", s, e) for s, e in _emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            ok = all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split("."))
            (good if ok else bad).append(("ip", *m.span()))
        for m in CARD.finditer(text):
            d = m[0].replace(" ", "").replace("-", "")
            if len(d) > 6:
                (good if 12 <= len(d) <= 19 and luhn(d) else bad).append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                n = len(DIGIT.findall(m[0]))
                (good if 9 <= n <= 15 else bad).append(("phone", *m.span()))
    order = KINDS.index
    return sorted(good, key=lambda x: (x[1], order(x[0]), x[2])), bad


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Possibly overlapping spans beyond the base patterns."""
    out = []
    for m in AT.finditer(text):
        right = AFTER_AT.match(text, m.end())
        s = m.start()
        while s > max(0, m.start() - 64) and text[s - 1] in LOCAL:
            s -= 1
        if right and s < m.start():
            out.append(("email", s, right.end()))
    if DIGIT.search(text):
        for m in NUMBER.finditer(text):
            n = len(DIGIT.findall(m[0])) if len(m[0]) < 80 else 99
            if 7 <= n <= 15:
                out.append(("phone", *m.span()))
            if 12 <= n <= 19:
                out.append(("card", *m.span()))
        out += [("ip", *m.span()) for m in LOOSE_IP.finditer(text)]
    return out


def features(kind: str, span: str, before: str, after: str) -> list[float]:
    digits = "".join(DIGIT.findall(span))
    groups = [len(g) for g in re.findall("[0-9]+", span)] or [0]
    n = len(digits)
    parts = re.split(r"[^0-9]+", span.strip())
    tail = re.search(r"([A-Za-z]+)$", span)
    return [
        *(float(kind == k) for k in KINDS),
        len(span),
        n,
        len(groups),
        max(groups),
        min(groups),
        groups[0],
        groups[-1],
        span.count(" "),
        span.count("-"),
        span.count("."),
        span.count("/"),
        span.count("(") + span.count(")"),
        float(n > 1 and luhn(digits)),
        float(len(parts) == 4 and all(p and len(p) < 4 and int(p) <= 255 for p in parts)),
        float(digits[:2] in ("19", "20")),
        float(bool(DATE.search(span))),
        float(bool(SIGNS[kind].search(before))),
        float(bool(OTHER.search(before))),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in "\"'=" and before != ""),
        float(bool(re.search(r"[(\[{<]at[)\]}>]", span, re.I))),
        float(bool(re.search(r"[(\[{<]dot[)\]}>]", span, re.I))),
        float(bool(re.search(r"\sdot\s", span, re.I))),
        float("@" in span),
        len(tail[1]) if tail else 0,
        float(bool(re.search(r"\.\s", span))),
    ]


def _context(text: str, s: int, e: int) -> tuple[str, str, str]:
    return text[s:e], text[max(0, s - 30) : s], text[e : e + 10]


def examples(text: str) -> list[tuple[int, str, list[float]]]:
    """Self-labelled candidates of a text: its base spans rewritten in looser forms are what should be found; base matches
    that fail, the same forms with broken content, dates, versions and plain sentences are what should not."""
    good, bad = base(text)
    out = []

    def add(y, kind, span, before, after):
        out.append((y, kind, features(kind, span, before, after)))

    for kind, s, e in good:
        span, before, after = _context(text, s, e)
        d = "".join(DIGIT.findall(span))
        if kind == "email":
            user, host = span.rsplit("@", 1)
            for at, dot in (" at ", " dot "), ("(at)", "(dot)"), ("[at]", "[dot]"), (" (at) ", "."), (" [at] ", " [dot] "), (" @ ", "."):
                add(1, kind, user + at + host.replace(".", dot), before, after)
                add(1, kind, user[: 1 + len(at)] + at + dot.join(host.split(".")[-2:]), before, after)
            add(0, kind, f"{user} at {host.split('.')[0]}. {host.split('.')[-1].title()}", before, after)
        elif kind == "phone":
            d10 = d[-10:]
            for form in (f"({d10[:3]}) {d10[3:6]}-{d10[6:]}", f"{d10[:3]}-{d10[3:6]}-{d10[6:]}", f"{d10[:3]}.{d10[3:6]}.{d10[6:]}", f"1-{d10[:3]}-{d10[3:6]}-{d10[6:]}", f"00{d[:2]} {d10[:3]} {d10[3:]}"):
                add(1, kind, form, before, after)
            add(0, kind, d10, "token " + before[-10:], after)
            add(0, kind, f"20{d10[:2]}-{d10[2:4]}-{d10[4:6]}", before, after)
            add(0, kind, f"{d10[:2]}/{d10[2:4]}/20{d10[4:6]}", before, after)
        elif kind == "card" and len(d) >= 13:
            for sep in " ", "-", ".", "":
                form = sep.join(d[i : i + 4] for i in range(0, len(d), 4))
                add(1, kind, form, before, after)
                wrong = form[:-1] + str((int(form[-1]) + 1 + len(before) % 8) % 10)
                add(0, kind, wrong, before, after)
                add(0, "phone", form[:18], before, after)
        elif kind == "ip":
            for form in (span.replace(".", " . "), span.replace(".", "[.]"), span.replace(".", "(.)")):
                add(1, kind, form, before, after)
            add(0, kind, span.replace(".", " . ").replace(d[:1], "9" + d[:1] + "7"), before, after)
            add(0, "phone", span, before, after)
    for kind, s, e in bad:
        add(0, kind, *_context(text, s, e))
    found = [(s, e) for _, s, e in good]
    for kind, s, e in candidates(text):
        span, before, after = _context(text, s, e)
        if kind == "email" and "@" not in span and not re.search(r"[(\[{<]|\sdot\s", span) and not any(s < b and a < e for a, b in found):
            add(0, kind, span, before, after)
        elif re.search(r"[A-Za-z]$", before) or re.match(r"[A-Za-z]", after):
            add(0, kind, span, before, after)  # inside a longer code
    return out


@dataclass
class Model:
    trees: list = field(default_factory=list)  # per tree (feature, cut, value) arrays over a full binary tree
    start: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def probability(self, rows):
        import numpy as np

        x = np.asarray(rows, float)
        z = np.full(len(x), self.start)
        for feature, cut, value, depth in self.trees:
            z += value[_node(x, feature, cut, depth)]
        return 1 / (1 + np.exp(-z))


def _node(x, feature, cut, depth: int):
    """The node of a full binary tree that each row reaches after ``depth`` steps."""
    import numpy as np

    at, row = np.zeros(len(x), int), np.arange(len(x))
    for _ in range(depth):
        at = 2 * at + 1 + (x[row, feature[at]] > cut[at])
    return at


def _histograms(blocks: RDD, start: float, trees: list, feature, cut, level: int, width: int, bins: int):
    """Sums of the gradients and of the second-order terms ``(2, node, feature, bin)`` over all examples, for the nodes of one level of a growing
    tree after ``trees``. Each partition gives one part of the size of the result; beyond ``PARTS`` of them, executors add them up first."""
    import numpy as np

    cells = 2**level * width * bins

    def run(rows):
        import numpy as np

        sums = np.zeros((2, cells))
        for r in rows:
            y, n = np.frombuffer(r.y, np.int32), np.frombuffer(r.n, np.int64)
            x = np.frombuffer(r.x, np.uint8).reshape(len(y), width)
            z = np.full(len(y), start)
            for f, c, value, depth in trees:
                z += value[_node(x, f, c, depth)]
            p = 1 / (1 + np.exp(-z))
            node = _node(x, feature, cut, level) - (2**level - 1)
            cell = ((node[:, None] * width + np.arange(width)) * bins + x).ravel()
            for i, v in enumerate((y - p, p * (1 - p) + 1e-6)):
                sums[i] += np.bincount(cell, np.repeat(np.rint(v * FINE) * n, width), cells)
        yield sums

    sums = blocks.mapPartitions(run)
    total = sums.treeReduce(np.add) if sums.getNumPartitions() > PARTS else sums.reduce(np.add)
    return (total / FINE).reshape(2, 2**level, width, bins)


def boost(examples: DataFrame, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32) -> Model:
    """Gradient-boosted trees with logistic loss and second-order gains over histogram bins, from all of ``examples`` ``(y, x, n)``: label,
    features and number of equal examples. The driver sees one histogram per level of a tree, whatever the number of examples."""
    import numpy as np

    count = {r.y: r.n for r in examples.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    if len(count) < 2:
        return Model()
    values = examples.select("n", F.posexplode("x").alias("j", "v")).groupBy("j", "v").agg(F.sum("n").alias("n"))
    parts = F.array(*[F.lit(float(q)) for q in np.linspace(0, 1, bins + 1)[1:-1]])
    found = {r.j: r.q for r in values.groupBy("j").agg(F.percentile("v", parts, F.col("n")).alias("q")).collect()}
    width = len(found)
    cuts = [np.unique(np.asarray(found[j], float)) for j in range(width)]

    def to_bins(rows):
        x = np.asarray(rows, float)
        return [[r.tobytes() for r in np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1).astype(np.uint8)]]

    def pack(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            y, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "n"))
            packed = y.astype(np.int32).tobytes(), n.astype(np.int64).tobytes(), b"".join(batch.column("b").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in packed], names=["y", "n", "x"])

    start = float(np.log((count[1] + 1) / (count[0] + 1)))
    binned = add_columns(examples.select("y", "n", "x"), [examples["x"]], "b binary", to_bins, batch_rows=1000)
    binned = save(binned.groupBy("y", "b").agg(F.sum("n").alias("n")), "binned")
    blocks = binned.select("y", "n", "b").mapInArrow(pack, "y binary, n binary, x binary").rdd
    # every level of every tree is a job over them: a task a core, however many files they came in
    blocks = blocks.coalesce(blocks.context.defaultParallelism).persist(StorageLevel.MEMORY_AND_DISK)
    trees, over_bins = [], []
    size, first = 2 ** (depth + 1) - 1, 2**depth - 1
    for _ in range(rounds):
        feature, cut, value = np.zeros(size, int), np.full(size, np.inf), np.zeros(size)
        edge = np.full(size, bins)
        for level in range(depth):
            g, h = _histograms(blocks, start, over_bins, feature, edge, level, width, bins)
            for i in range(2**level):
                node, gs, hs = 2**level - 1 + i, g[i, 0].sum(), h[i, 0].sum()
                best, left = (1e-3, 0, np.inf, bins), (gs, hs)
                for j in range(width if hs else 0):
                    if not len(cuts[j]):
                        continue
                    gl, hl = (np.cumsum(v[i, j])[: len(cuts[j])] for v in (g, h))
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best, left = (gain[k], j, cuts[j][k], k), (gl[k], hl[k])
                _, feature[node], cut[node], edge[node] = best
                if 2 * node + 1 >= first:
                    value[2 * node + 1] = rate * left[0] / (left[1] + 1)
                    value[2 * node + 2] = rate * (gs - left[0]) / (hs - left[1] + 1)
        trees.append((feature, cut, value, depth))
        over_bins.append((feature, edge, value, depth))
    blocks.unpersist()
    discard(binned)
    return Model(trees, start)


def labelled(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(test, y, kind, x, n)``: the self-labelled candidates of all distinct texts, equal ones counted; every fifth by a hash is for tests."""
    d = docs.select(docs[f"`{text}`"].alias("t")).where("t is not null")
    d = d.select("t", F.xxhash64("t").alias("h"), F.xxhash64(F.lit(1), "t").alias("h2"))

    def run(texts):
        return [[[{"y": y, "kind": k, "x": [int(v) for v in x]} for y, k, x in examples(t)] for t in texts]]

    got = add_columns(d, [d["t"]], "t array<struct<y:int,kind:string,x:array<int>>>", run, batch_rows=1000)  # instead of the text
    one = got.where(F.size("t") > 0).groupBy("h", "h2").agg(F.first("t").alias("e"))  # equal texts have equal examples
    each = one.select("h", F.posexplode("e").alias("i", "e"))
    each = each.select((F.pmod(F.xxhash64("h", "i"), F.lit(5)) == 0).alias("test"), "e.y", "e.kind", "e.x")
    return each.groupBy("test", "y", "kind", "x").agg(F.count("*").alias("n"))


def fit(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> Model:
    """A model from the self-labelled candidates of all distinct texts.

    Every fifth candidate is kept out of the fit; each kind's threshold is the lowest from 0.5 up, in parts of ``GRID``, that keeps ``precision``
    there. A kind without examples of both labels gets no threshold and adds no spans.
    """
    data = save(labelled(docs, text), "examples")
    model = boost(data.where("not test"))
    test = data.where("test")
    if model.trees:

        def run(rows):
            p = model.probability(rows)
            return [[int(q * GRID) if q >= 0.5 else -1 for q in p.tolist()]]

        level = add_columns(test, [test["x"]], "level int", run, batch_rows=1000).groupBy("kind", "level")
        rows = level.agg(F.sum("n").alias("n"), F.sum(F.col("y") * F.col("n")).alias("hits")).collect()  # half of ``GRID`` and two per kind at most
        for kind in KINDS:
            got = sorted((r.level, r.n, r.hits) for r in rows if r.kind == kind)
            if not 0 < sum(x[2] for x in got) < sum(x[1] for x in got):
                continue
            n, hits, cut = 0, 0, None
            for at, more, right in reversed(got):
                n, hits = n + more, hits + right
                if at >= 0 and hits >= precision * n:
                    cut = at / GRID
            if cut is not None:
                model.thresholds[kind] = cut
    discard(data)
    return model


def find(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``pii_spans``: arrays of (kind, start, end) in code points, end exclusive, by start and kind.

    ``pii_spans`` holds the base spans and the candidates at or above their kind's threshold that overlap no base span; of
    overlapping ones the likelier stays, then the earlier. Each whole text is scanned alone (no shuffle); null counts as empty.
    """
    shared, uid = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(texts):
        m = worker_cached("pii", uid, lambda: shared.value)
        bases = [base(t)[0] for t in texts]
        rows, owner = [], []
        for i, t in enumerate(texts):
            taken = [(s, e) for _, s, e in bases[i]]
            for kind, s, e in candidates(t):
                if kind in m.thresholds and not any(s < b and a < e for a, b in taken):
                    owner.append((i, kind, s, e))
                    rows.append(features(kind, *_context(t, s, e)))
        more: dict[int, list] = {}
        if rows:
            for (i, kind, s, e), p in zip(owner, m.probability(rows).tolist()):
                if p >= m.thresholds[kind]:
                    more.setdefault(i, []).append((-p, s, KINDS.index(kind), e))
        full = []
        for i, b in enumerate(bases):
            spans = list(b)
            chosen: list[tuple[int, int]] = []
            for _, s, k, e in sorted(more.get(i, ())):
                if not any(s < b2 and a2 < e for a2, b2 in chosen):
                    chosen.append((s, e))
                    spans.append((KINDS[k], s, e))
            full.append(sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))
        as_rows = lambda spans: [{"kind": k, "start": s, "end": e} for k, s, e in spans]
        return [[as_rows(b) for b in bases], [as_rows(f) for f in full]]

    t = "array<struct<kind:string,start:int,end:int>>"
    return add_columns(docs, [text_of(docs, text)], f"base_spans {t}, pii_spans {t}", run, batch_rows=1000)


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """``found`` (of ``find``) with ``redacted``: each span replaced by its kind in brackets, overlapping ones as one by the first kind."""

    def run(texts, spans):
        out = []
        for t, xs in zip(texts, spans):
            parts, at = [], 0
            for x in xs or ():
                if x["start"] >= at:
                    parts += [t[at : x["start"]], f"[{x['kind']}]"]
                at = max(at, x["end"])
            out.append("".join(parts) + t[at:])
        return [out]

    return add_columns(found, [text_of(found, text), found["pii_spans"]], "redacted string", run, batch_rows=1000)
