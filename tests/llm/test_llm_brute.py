"""Operators against brute force on small tables, and the learned ones against held-out rows."""

import hashlib
import math
import random
from collections import Counter

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
import corpus_pipeline
from compare import DATA, connect, differences
from tessella.llm import bitslice, bpe, decontaminate, language, line_dedup, ngram_join, pii, suffix_dedup, toxicity
from tessella.llm.queries import SQL

SMALL = str(DATA / "sf0.001")
VOCAB = str(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(SMALL + "/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, SMALL), connect(DATA / "sf0.001"), SQL[name]) is None


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(sum(q.startswith(f"op{n}_") for q in names) == 1 for n in range(1, 11)) and "pipeline" in names


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "aa", "the", " ", "  ", "\n", "'s", "7", "é", "😀", "!", "<|endoftext|>", "ing", "　"]), max_size=20).map("".join))
def test_encoding_equals_library(text):
    from tokenizers import Tokenizer

    lib = test_encoding_equals_library.__dict__.setdefault("lib", Tokenizer.from_file(VOCAB))
    own = test_encoding_equals_library.__dict__.setdefault("own", bpe.Encoder(open(VOCAB, encoding="utf-8").read()))
    ids = own.encode(text).tolist()
    assert ids == lib.encode(text, add_special_tokens=False).ids
    assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False)


def test_bpe_query(spark, documents):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(VOCAB)
    for r in entry.queries()["op2_bpe"](spark, SMALL).collect():
        ids = lib.encode(documents[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(documents[r.doc_id].encode()).hexdigest()


def brute_bytes(texts):
    seen = Counter(b[i : i + 200] for b in texts for i in range(len(b) - 199))
    for b in texts:
        mark = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                mark[i : i + 200] = b"\1" * 200
        yield bytes(x for x, m in zip(b, mark) if not m)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_suffix_dedup(spark, hot):
    r = random.Random(4)
    base = ["".join(r.choice("ab \n") for _ in range(n)) for n in (150, 199, 200, 201, 260, 700, 900)]
    texts = []
    for _ in range(60):
        t = "".join(x[r.randint(0, 40) : len(x) - r.randint(0, 40)] for x in r.sample(base, r.randint(1, 3)))
        if r.random() < 0.6:
            i = r.randint(0, len(t))
            t = t[:i] + r.choice("xyzé") + t[i:]
        texts.append(t)
    texts += [texts[0], "q" * 199, "q" * 199, "ab" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {x.doc_id: bytes(x.kept) for x in suffix_dedup.remove(df, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == list(brute_bytes([t.encode() for t in texts]))


def test_suffix_query(spark, documents):
    got = {r.doc_id: r.kept_sha256 for r in entry.queries()["op4_suffix_dedup"](spark, SMALL).collect()}
    want = brute_bytes([t.encode() for t in documents.values()])
    assert got == {i: hashlib.sha256(k).hexdigest() for i, k in zip(documents, want)}


def test_merge_is_ordered():
    r = random.Random(5)
    runs = [sorted({bytes(r.choice(b"ab") for _ in range(r.randint(1, 80))) for _ in range(r.randint(0, 40))}) for _ in range(7)]
    coded = [suffix_dedup.decoded(suffix_dedup.front_coded([(s, False) for s in run])) for run in runs]
    got, before = [], b""
    for shared, s, _ in suffix_dedup.merge(coded):
        assert shared == suffix_dedup.common(before, s, 0)
        got.append(s)
        before = s
    assert got == sorted(s for run in runs for s in run)


def brute_lines(docs, min_words):
    """Every run of at least ``min_words`` words that occurs earlier goes."""
    lines = {d: t.split("\n") for d, t in docs}
    first, gone = {}, set()
    for d, x in lines.items():
        for i in range(len(x)):
            for j in range(i + 1, len(x) + 1):
                if sum(len(y.split()) for y in x[i:j]) >= min_words:
                    if first.setdefault(tuple(x[i:j]), (d, i)) != (d, i):
                        gone.update((d, k) for k in range(i, j))
    return {d: "\n".join(y for i, y in enumerate(x) if (d, i) not in gone) for d, x in lines.items()}


def test_line_dedup(spark):
    r = random.Random(6)
    lines = ["a b c", "d", "", "e f", "g h i j k l m", "a b c"]
    docs = [(d, "\n".join(r.choice(lines) for _ in range(r.randint(1, 14)))) for d in range(30)]
    got = line_dedup.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), min_words=6)
    assert {x.doc_id: x.text for x in got.collect()} == brute_lines(docs, 6)


def brute_components(docs):
    sets = {}
    for d, t in docs:
        w = t.translate({i: i + 32 for i in range(65, 91)}).encode().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    comp = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((comp[a], comp[b]))
                comp = {d: x if c == y else c for d, c in comp.items()}
    return {d: (len(s), comp[d]) for d, s in sets.items()}


def test_ngram_join(spark, monkeypatch):
    r = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    passage = r.sample(words, 30)
    docs = []
    for g in range(12):
        base = [r.choice(words) for _ in range(r.randint(3, 120))] + (passage if g % 2 else [])
        for _ in range(r.randint(1, 12)):
            x = list(base)
            for _ in range(r.randint(0, 4)):
                x[r.randrange(len(x))] = r.choice(words)
            docs.append((len(docs), " ".join(x[: len(x) - r.randint(0, 3)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute_components(docs)
    for hot in (ngram_join.HOT_COUNT, 2):
        monkeypatch.setattr(ngram_join, "HOT_COUNT", hot)
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.join(df).collect()} == want


def test_ngram_links(spark):
    """Also between texts of one component, and of one id."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    docs = [(None, "no id at all here"), (900, None), (901, " ")]
    for g in range(8):
        base = [r.choice(words) for _ in range(r.randint(3, 120))]
        for _ in range(8):
            x = list(base)
            for _ in range(r.randint(0, 3)):
                x[r.randrange(len(x))] = r.choice(words)
            docs.append((len(docs) // 2, " ".join(x)))
    found, members = ngram_join.links(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    sets = {}
    for d, t in docs:
        w = (t or "").split()
        if w and d is not None:
            sets.setdefault(frozenset(tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))), set()).add(d)
    of = {}
    for m in members.collect():
        of.setdefault(m.class_id, set()).add(m.doc_id)
    assert sorted(map(sorted, of.values())) == sorted(map(sorted, sets.values()))
    row = lambda x, y, c, t: (*sorted((sorted(x), sorted(y))), c, t)
    want = sorted(row(sets[x], sets[y], len(x & y), len(x | y)) for i, x in enumerate(sets) for y in list(sets)[:i] if 5 * len(x & y) >= 4 * len(x | y))
    assert want and sorted(row(of[f.a], of[f.b], f.common, f.total) for f in found.collect()) == want


def test_topk_blocks(spark, monkeypatch):
    monkeypatch.setattr(bitslice, "BLOCK", 37)
    monkeypatch.setattr(bitslice, "CHUNK", 3)
    r = random.Random(8)
    rows = {i: [r.choice([-1.0, 0.0, 0.5, 0.25, -0.3, 0.01, 2.7]) for _ in range(6)] for i in range(200)}
    v = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")
    got = {}
    for x in bitslice.search(bitslice.build(v), v.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    q = {x.vec_id: [int(c * 64 // 1) for c in x.embedding] for x in v.collect()}
    for i in range(0, 200, 20):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:20]
        assert sorted(got[i]) == [(n, j, -s) for n, (s, j) in enumerate(best, 1)]


def test_topk_large_components(spark, monkeypatch):
    """Rows with large components are answers and ask, ranked by exact scores; those beyond a long are given as the nearest one."""
    monkeypatch.setattr(bitslice, "BLOCK", 40)
    r = random.Random(18)
    sizes = [0.5, 3.0, 2.0**19, 2.0**21, 3e6, 2.0**31, 2.0**40 + 1, 2.0**49]
    rows = {i: [r.choice([-1, 1]) * r.choice(sizes if i % 3 else sizes[:2]) for _ in range(4)] for i in range(150)}
    rows |= {200: [2e6, 1.0, 0.0, 0.0], 201: [2.0**50, 0.0, 0.0, 0.0]}
    v = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    got = {}
    for x in bitslice.search(bitslice.build(v), v.where("vec_id % 20 = 0"), 20).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    q = {i: [math.floor(64 * c) for c in e] for i, e in rows.items() if i != 201}
    assert set(got) == {i for i in q if i % 20 == 0}
    for i in got:
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:20]
        assert sorted(got[i]) == [(n, j, max(-(2**63), min(2**63 - 1, -s))) for n, (s, j) in enumerate(best, 1)]


def test_decontaminate_blocks(spark, monkeypatch):
    r = random.Random(9)
    items = [(i, " ".join(r.choice("a b c d".split()) for _ in range(r.randint(0, 20)))) for i in range(12)]
    docs = [(i, " ".join([items[i % 12][1], *(r.choice("a b c d e".split()) for _ in range(40))])) for i in range(40)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(decontaminate.find(d, b).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    assert sorted(decontaminate.find(d, b).collect()) == whole and any(x.hit_items for x in whole)


def test_pii_base(spark, documents):
    import re

    rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def brute(t):
        for k, p in rules.items():
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                if not (k == "ip" and any(int(x) > 255 for x in m[0].split(".")) or k == "card" and not (12 <= len(d) <= 19 and pii.luhn(d)) or k == "phone" and not 9 <= len(d) <= 15):
                    yield k, *m.span()

    r = random.Random(10)
    parts = ["a", "_", "@", ".", "b.co", "+1", "(", ")", " ", "-", "12", "255", "256", "4111111111111111", "\n", "é"]
    texts = list(documents.values()) + ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(5000)]
    for t in texts:
        assert sorted(pii.base(t)[0]) == sorted(brute(t))
    rows = entry.queries()["op7_pii"](spark, SMALL).collect()
    for x in rows:
        spans = sorted(brute(documents[x.doc_id]), key=lambda s: (s[1], pii.KINDS.index(s[0])))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert x.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(filter(None, joined.split(","))) <= set(x.spans.split(","))


def test_pii_model_finds_loose_forms(spark):
    m = pii.fit(spark.read.parquet(str(DATA / "sf0.1") + "/documents.parquet"))
    text = "call (555) 123-4567 or write to joe.doe (at) mail (dot) example (dot) com today"
    r = pii.find(spark.createDataFrame([(1, text), (2, "we sat at home. The end, 2021-03-04")], "doc_id long, text string"), m).sort("doc_id").collect()
    assert {s.kind for s in r[0].pii_spans} == {"phone", "email"} and r[1].pii_spans == []


def test_language_held_out(spark):
    docs = spark.read.parquet(str(DATA / "sf0.01") + "/documents.parquet")
    rows = entry.queries()["op8_language"](spark, str(DATA / "sf0.01")).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    mixed = language.identify(spark.createDataFrame([(1, "the and of the und der die und der die nicht")], "doc_id long, text string"), language.fit(docs)).first()
    assert mixed.language_words["en"] > 2 and mixed.language_words["de"] > 3


def test_toxicity_held_out(spark):
    folder = str(DATA / "sf0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(folder + "/labels.parquet").collect()}
    rows = [r for r in entry.queries()["op3_toxicity"](spark, folder).collect() if r.held_out and labels.get(r.doc_id) is not None]
    clean = [r.predicted for r in rows if labels[r.doc_id] == 0]
    toxic = [r.predicted for r in rows if labels[r.doc_id] == 1]
    assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.75 * len(toxic)


def test_toxic_sentences_are_located():
    m = toxicity.Model({"wbad": 9.0}, -6.0)
    score, found = toxicity.Scorer(m).score("Fine here. So bad a thing! Fine.")
    assert score > 0.9 and [(a, b) for a, b, _ in found] == [(10, 25)]


def test_pipeline(spark, documents):
    docs = spark.read.parquet(SMALL + "/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, SMALL)
        if name == "encode":
            rows = out.collect()
            assert all(r.decodes for r in rows) and {r.doc_id for r in rows} == set(before)
            break
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
        if name == "line_dedup":
            want = brute_lines(sorted(before.items()), line_dedup.MIN_WORDS)
            assert kept[name] == {d: t for d, t in want.items() if t == before[d] or t.strip()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "near_duplicates":
            assert set(kept[name]) == {d for d, (_, c) in brute_components(sorted(before.items())).items() if c == d}
    assert {r.doc_id for r in corpus_pipeline.run(spark, SMALL).collect()} == set(before)


def test_html_query(spark):
    """The given pages have one shape: the article is one element whose blocks are its headings and paragraphs."""
    import html
    import re

    folder = str(DATA / "sf0.01")
    pages = {r.page_id: r.html for r in spark.read.parquet(folder + "/pages.parquet").collect()}
    rows = entry.queries()["op6_html"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text)


def test_cut_lines_equal_plain_forward_backward():
    """Lines of several segments against one pass over the whole line."""
    import random

    import numpy as np

    rnd = random.Random(3)
    weights = {"w" + x: tuple(rnd.gauss(0, 1) for _ in range(3)) for x in "abcdefgh"}
    m = language.Model(["x", "y", "z"], weights, {}, (), np.exp(np.random.default_rng(1).normal(size=9) * 2).tolist(), [1.0, 2.0, 0.5])
    lengths = [1, 5, language.SEGMENT, language.SEGMENT + 1, 300, 2000]
    words = [rnd.choice("abcdefgh") for _ in range(sum(lengths))]
    tagger, at = language.Tagger(m), 0
    known = np.sum([weights[f] for f in language.features("ab") if f in weights] or [(0.0, 0.0, 0.0)], axis=0)
    assert np.allclose(tagger.word("ab"), np.exp(known - known.max())) and np.allclose(tagger.word("a"), np.exp(np.array(weights["wa"]) - max(weights["wa"])))
    moves = np.array(m.moves).reshape(3, 3)
    for n, got in zip(lengths, tagger.lines(words, lengths)):
        x = [tagger.word(w) for w in words[at : at + n]]
        at += n
        alphas, a = [], np.array(m.start)
        for t in range(n):
            a = (a @ moves if t else a) * x[t]
            alphas.append(a := a / a.sum())
        beta, total = np.ones(3), np.zeros(3)
        for t in range(n - 1, -1, -1):
            g = alphas[t] * beta
            total += g / g.sum()
            beta = moves @ (x[t] * beta)
            beta = beta / beta.sum()
        assert np.allclose(total, got, rtol=1e-9)


def test_toxicity_sample_is_bounded_by_occurrences(spark):
    """Long documents: the sample stops at the bound, keeps both labels, and the model still tells them apart."""
    docs = [(i, ("bad word here. " if i % 4 == 0 else "good word here. ") * 500) for i in range(120)]
    df = spark.createDataFrame([(i, f"n{i} {t}") for i, t in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs], "doc_id long, toxic int")
    for most in (10**9, 5_000, 1):
        got = toxicity.score(df, toxicity.fit(df, labels, occurrences=most)).collect()
        assert all((r.toxicity >= 0.5) == (r.doc_id % 4 == 0) for r in got)
    Row = type("Row", (), {})
    rows = []
    for i in range(100):
        r = Row()
        r.y, r.h, r.n, r.c = int(i < 20), i * 37 % 101, 1, 10
        rows.append(r)
    (clean, thin0), (toxic, thin1) = toxicity._cuts(rows, 500)
    kept = [r for r in rows if r.h <= (toxic if r.y else clean)]
    assert sum(r.c for r in kept) <= 500 and thin0 == 2.0 and thin1 == 2.0
