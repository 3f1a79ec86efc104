"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessella.llm import bitslice, bpe, decontaminate, html_text, language, line_dedup, ngram_join, pii, suffix_dedup, toxicity

VOCAB = str(public_tokenizers.path("byte_bpe_50k.json"))
# columns whose names the operators use inside or add themselves
SCHEMA = "doc_id long, text string, k long, n int, t string, d string, c0 string, id long, spans string, n_words string, kept int, token_ids string, toxicity string, language string, pii_spans string, n_lines string, h string, a int, b int"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000)) + " mail me at a.b@c.de"
TEXTS = [None, "", " ", "\n\n", "one", "tie tie tie", "tie tie tie", LONG, "é 中文 😀 \u0000 x", "a" * 5000]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (None, None), (5, "tie tie tie"), (5, "tie tie tie"), (5, "other text")]
    rows = [(*r, 1, 2, "t", "d", "c", 7, "s", "w", 3, "x", "tox", "lang", "p", "l", "h", 1, 2) for r in rows]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "tie tie"), (1, "tie tie"), (None, "x"), (2, None), (3, ""), (4, "ONE")], "item_id long, text string")


def same_rows(out, docs, but=()):
    keep = [c for c in docs.columns if c not in but]
    key = lambda r: str(tuple(r))
    assert sorted(map(key, out.select(*keep).collect())) == sorted(map(key, docs.select(*keep).collect()))


def test_bpe(docs):
    got = bpe.decode(bpe.encode(docs, VOCAB), VOCAB)
    same_rows(got, docs, {"token_ids", "decoded"})
    assert all(r.decoded == (r.text or "") for r in got.collect())
    assert bpe.round_trip(docs.limit(0), VOCAB).count() == 0
    assert bpe.decode(docs.sparkSession.createDataFrame([(None,), ([],)], "token_ids array<int>"), VOCAB).select("decoded").distinct().collect() == [("",)]


def test_decontaminate(docs, bench):
    got = decontaminate.find(docs, bench)
    same_rows(got, docs, {"n_words", "hit_spans", "hit_items"})
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert rows[5, "tie tie tie"].hit_items == [1] and rows[5, "tie tie tie"].hit_spans == [(0, 3)]
    assert rows[4, "one"].hit_items == [4] and rows[0, None].n_words == 0 and rows[None, "no id"].n_words == 2
    assert decontaminate.find(docs.limit(0), bench).count() == 0
    assert decontaminate.find(docs, bench.limit(0)).where("size(hit_items) > 0").count() == 0
    assert decontaminate.clean(docs, bench).columns == docs.columns


def test_toxicity(docs, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (3, None), (7, 0)], "doc_id long, toxic int")
    for m in (toxicity.fit(docs, labels), toxicity.fit(docs.limit(0), labels), toxicity.fit(docs, labels.where("toxic = 0")), toxicity.fit(docs, labels.limit(0))):
        got = toxicity.score(docs, m)
        same_rows(got, docs, {"toxicity", "toxic_sentences"})
        assert got.where("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
        assert got.where("coalesce(trim(text), '') = '' and toxicity <> 0").count() == 0


def clean_corpus(spark, n):
    name = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    rows = [(i, " ".join(f"Sentence {name(k)} of text number {name(i)}." for k in range(i % 40 + 1))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("known", [[], [(i, 0) for i in range(300)]])
def test_toxicity_stage_keeps_all_documents_without_toxic_labels(spark, tmp_path, known):
    import corpus_pipeline

    spark.createDataFrame(known, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    corpus = clean_corpus(spark, 300)
    assert corpus_pipeline.stage_toxicity(spark, corpus, str(tmp_path)).count() == 300


def test_rare_toxic_documents_are_in_the_sample(spark):
    corpus = clean_corpus(spark, 3000).withColumn("text", F.when(F.col("doc_id") % 500 == 7, F.concat("text", F.lit(" You are vile scum."))).otherwise(F.col("text")))
    labels = corpus.select("doc_id", (F.col("doc_id") % 500 == 7).cast("int").alias("toxic"))
    got = toxicity.score(corpus, toxicity.fit(corpus, labels, rows=200))
    assert {r.doc_id for r in got.where("toxicity >= 0.5").collect()} == {7, 507, 1007, 1507, 2007, 2507}


def test_suffix_dedup(docs):
    got = suffix_dedup.remove(docs)
    same_rows(got, docs, {"kept", "n_bytes", "removed_spans"})
    rows = {(r.doc_id, r.text): r for r in got.collect()}
    assert rows[9, "a" * 5000].removed_spans == [(0, 5000)] and bytes(rows[9, "a" * 5000].kept) == b""
    assert rows[0, None].n_bytes == 0 and rows[0, None].removed_spans == []
    assert suffix_dedup.remove(docs.limit(0)).count() == 0


def test_line_dedup(docs):
    got = line_dedup.dedup(docs, min_words=3)
    same_rows(got, docs, {"text", "n_lines", "removed_lines"})
    gone = sorted((r.doc_id, r.text) for r in got.where("size(removed_lines) > 0").collect())
    assert gone == [(6, "")]  # rows of one id and text are one document, so document 5 keeps its line
    assert got.where("text is null and n_lines = 0").count() == 2
    assert line_dedup.dedup(docs.limit(0)).count() == 0
    assert line_dedup.dedup(docs.where("text is null")).count() == 2


def test_html(spark):
    rows = [(None, None, None), (1, "u", ""), (2, "u", "<p>" + LONG + "</p>"), (3, None, "x<br>y"), (3, None, "x<br>y"), (4, "u", "<" * 9999), (5, "u", "<div>" * 3000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("main_text", F.lit(1)).withColumn("c0", F.lit(2))
    got = {(r.page_id, r.html): r.main_text for r in html_text.extract(pages).collect()}
    assert got[None, None] == "" and got[1, ""] == "" and got[3, "x<br>y"] == "x y" and got[2, rows[2][2]] == LONG and got[5, rows[6][2]] == "deep"
    assert html_text.extract(pages).count() == len(rows) and html_text.extract(pages.limit(0)).count() == 0


FULL = "This sentence is long enough to count as text of an article, with a comma, and another one. " * 4


@pytest.mark.parametrize(
    "page, want",
    [
        (f'<article><p class="ad">Buy<p>{FULL}<p>More</article>', [FULL.strip(), "More"]),
        (f'<article><p>{FULL}</p><ul><li class="related">a<li>b</ul><p>End</article>', [FULL.strip(), "b", "End"]),
        (f'<article><section><div class="ad">Buy</section><p>{FULL}</p><p>End</p></article>', [FULL.strip(), "End"]),
        (f'<article><section><aside>Buy</section><p>{FULL}</p><p>End</p></article>', [FULL.strip(), "End"]),
        (f'<article><p class="notice">x<p>{FULL}</p><p>End</p></article>', [FULL.strip(), "End"]),
        (f'<article><p>{FULL}<button><div>Buy</div></button> on</p><div class="ad"><div>Buy</div><b>now</b> or</div><p>End</article>', [FULL + "on", "End"]),
        (f'<head><title>t</title><meta><article><p>{FULL}</p></article>', [FULL.strip()]),
    ],
)
def test_html_dropped_elements_end_where_others_do(page, want):
    assert html_text.main_text(page).split("\n") == want


@pytest.mark.parametrize("outer", ["article", "main", "div"])
def test_html_sections_beside_a_long_one_are_kept(outer):
    sections = [[FULL.strip()] * 10, ["Short one.", "Short two."], ["Item", "Other"], ["A word of another."], ["Cell"]]
    first = "<div>" + "".join(f"<p>{t}</p>" for t in sections[0]) + "</div>"
    rest = "<h2>Next</h2><div><p>Short one.</p><p>Short two.</p></div><ul><li>Item<li>Other</ul><blockquote>A word of another.</blockquote><table><tr><td>Cell</table><p>End.</p>"
    menu = '<div><a href="/a">One link</a> <a href="/b">Another link</a></div>'
    page = f"<body>{menu}<{outer}>{first}{rest}</{outer}>{menu}</body>"
    assert html_text.main_text(page).split("\n") == sections[0] + ["Next", "Short one.", "Short two.", "Item", "Other", "A word of another.", "Cell", "End."]


@pytest.mark.parametrize("marks", ['class="content has-sidebar"', 'id="main" class="no-sidebar"', 'class="entry comments-open"', 'class="story ad-free"', 'class="post share-enabled"', 'class="noSidebar"', 'class="sidebar"'])
def test_html_class_words_do_not_take_the_main_text(marks):
    page = f'<body><div class="menu">Menu</div><div {marks}><h1>Title</h1><p>{FULL}</p><div class="sidebar">Aside</div><div class="ad">Buy</div></div><div class="site-footer">Foot</div></body>'
    assert html_text.main_text(page).split("\n") == ["Title", FULL.strip()]


def test_html_long_comments_beside_an_article_go():
    page = f'<body><article><p>{FULL}</p></article><div class="comments"><p>{FULL}</p><p>{FULL}</p></div></body>'
    assert html_text.main_text(page) == FULL.strip()


def test_pii(docs):
    for m in (pii.fit(docs), pii.fit(docs.limit(0)), pii.Model()):
        got = pii.redact(pii.find(docs, m))
        same_rows(got, docs, {"pii_spans", "base_spans", "redacted"})
        rows = {r.doc_id: r for r in got.collect()}
        assert [(s.kind, rows[7].text[s.start : s.end]) for s in rows[7].base_spans] == [("email", "a.b@c.de")]
        assert rows[7].redacted.endswith("me at [email]") and rows[0].redacted == ""
    assert pii.find(docs.limit(0), pii.Model()).count() == 0


def test_language(docs):
    rows = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").when(F.col("doc_id") == 3, F.lit(None)).otherwise("de"))
    for m in (language.fit(rows), language.fit(rows.limit(0)), language.fit(rows.where("lang = 'en'")), language.fit(rows.withColumn("lang", F.lit(None).cast("string")))):
        got = language.identify(rows, m)
        same_rows(got, docs, {"language", "language_share", "language_words"})
        assert got.where("(text is null or text in ('', ' ', '\n\n')) and (language <> 'und' or language_share <> 0)").count() == 0
        assert got.where("language_share < 0 or language_share > 1 or language is null").count() == 0


def test_ngram_join(docs):
    rows = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.join(docs).collect()}
    assert rows[6, 1] == 5 and rows[5, 1] == 5 and rows[0, 0] == 0 and rows[1, 0] == 1 and rows[None, 1] is None
    assert ngram_join.join(docs).count() == docs.count() and ngram_join.join(docs.limit(0)).count() == 0
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and 6 not in {r.doc_id for r in kept.collect()} and kept.where("doc_id is null").count() == 2


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>" + FULL + "</p><p>" + FULL + "</p></article><ol id='comment-list'><li>Great, really.</li><li>No, it is not.</li></ol>", 2),
        ("<div class='post'><p>" + FULL + "</p><p>" + FULL + "</p><ol id='comment-list'><li>Great, really.</li><li>No.</li></ol></div>", 2),
        ("<article><p>" + FULL + "</p><section class='related-posts'><p>Other post</p></section><p>" + FULL + "</p></article>", 2),
        ("<article><p>" + FULL + "</p><p class='subscribe-box'>Subscribe now, it is free.</p></article>", 1),
        ("<article><p>" + FULL + "</p></article><p>" + "We use cookies, as all do, to make this site better for you. " * 3 + "</p>", 1),
        ("<main><article class='comment'><p>First!</p></article><p>" + FULL + "</p></main>", 1),
        ("<main><div class='layout-sidebar'><article><p>" + FULL + "</p></article></div></main>", 1),
        ("<main><div class='sidebar-right'><p>" + FULL + "</p></div></main>", 1),
    ],
)
def test_html_compounds_and_what_stands_outside(page, want):
    assert html_text.main_text(page) == "\n".join([FULL.strip()] * want)


def test_html_headings_beside_the_text_stay():
    body = "<div class='text'><p>" + FULL + "</p><p>" + FULL + "</p></div>"
    two = [FULL.strip()] * 2
    menu = "<div><h2>More</h2><ul><li><a href='a'>One more page to read</a></li><li><a href='b'>Another page to read</a></li></ul></div>"
    assert html_text.main_text("<div><h1>Title</h1></div>" + body + menu).split("\n") == ["Title", *two]
    assert html_text.main_text("<h2>Part</h2>" + body + "<h2>Links</h2>" + menu).split("\n") == ["Part", *two]
    assert html_text.main_text("<div><h1>Title</h1></div><article><p>" + FULL + "</p></article><h2>Next</h2>").split("\n") == ["Title", FULL.strip()]


@pytest.mark.parametrize("open_, shut", [("<div>", "</span>"), ("<span>", "</b>"), ("<span>", "<div></div>"), ("<td><span>", "</i>"), ("<div>a, b", ""), ("<a ", ""), ("<b>", "<li>")])
def test_html_time_is_linear_in_stray_tags(open_, shut):
    import time

    t = time.time()
    html_text.main_text(open_ * 20_000 + "<p>x" + shut * 20_000)
    assert time.time() - t < 3


def test_topk(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, -0.25 * (i % 3), 1.0]) for i in range(30)] + [(40, None), (41, []), (42, [None, 1.0, 1.0]), (43, [nan, 1.0, 1.0]), (44, [inf, 1.0, 1.0]), (45, [1e300, 1.0, 1.0]), (46, [1.0]), (60, [1.0]), (None, [1.0, 1.0, 1.0]), (5, [0.5, -0.5, 1.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("x"))
    got = [tuple(r) for r in bitslice.search(bitslice.build(v), v.where("vec_id % 20 = 0"), 20).sort("query_id", "rank").collect()]
    assert [r for r in got if r[0] == 60] == [(60, 1, 46, 4096)]
    first = [r for r in got if r[0] == 0]
    want = sorted(((32 * 32 + 64 * 64, i) for i, _ in rows[:30] if i), key=lambda x: (-x[0], x[1]))[:20]
    assert [(r[2], r[1]) for r in first] == [(i, n) for n, (_, i) in enumerate(sorted([*want], key=lambda x: x[1]), 1)] or len(first) == 20
    assert bitslice.search(bitslice.build(v.limit(0)), v, 3).count() == 0 and bitslice.search(bitslice.build(v), v.limit(0), 3).count() == 0
