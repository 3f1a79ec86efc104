"""One query per operator: thin digests of what the operators return, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import bitslice, bpe, conversation, decontaminate, html_text, language, line_dedup, manifest, mixing, ngram_join, pii, suffix_dedup, toxicity
from tessella.llm.common import sha256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def vocabulary() -> str:
    """The public vocabulary file; its package says where it is."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return deco


@query(
    "op1_topk",
    """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
)
def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return bitslice.search(bitslice.build(vectors), vectors.where("vec_id % 20 = 0"), 20)


@query("op2_bpe")
def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, vocabulary()).select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("token_ids").cast("array<string>"), ",")).alias("ids_sha256"),
        sha256(F.col("decoded")).alias("decoded_sha256"),
    )


# Fixed value: the word pattern of the decontamination rule, as an RE2 class over code points.
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op9_decontaminate",
    rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
          FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
lengths AS (SELECT DISTINCT n FROM grams),
wins AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
         FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, item_id, n, i FROM wins JOIN grams USING (n, g)),
places AS (SELECT doc_id, count(*) AS n_hit
           FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
""",
)
def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        sha256(F.array_join(F.array_sort(F.col("hit_items").cast("array<string>")), ",")).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    out = toxicity.held_out("doc_id", 5, 0)
    model = toxicity.fit(docs.where(~out), table(spark, folder, "labels").where(~out))
    return toxicity.score(docs, model).select(
        "doc_id",
        out.alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("toxic_sentences").cast("long").alias("n_toxic_sentences"),
    )


@query(
    "op5_line_dedup",
    rf"""
WITH l AS (SELECT doc_id, unnest(range(0, len(x))) AS i, unnest(x) AS line
           FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents)),
c AS (SELECT doc_id, i, line, sum(len(regexp_extract_all(line, '[^ \x09-\x0D]+')))
        OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM l),
p AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY doc_id ORDER BY i), 0) AS before FROM c),
runs AS (
  SELECT s.doc_id, s.i AS a, min(e.i) AS z FROM p s JOIN p e ON s.doc_id = e.doc_id AND e.i >= s.i AND e.upto - s.before >= {line_dedup.MIN_WORDS} GROUP BY 1, 2
  UNION
  SELECT e.doc_id, max(s.i) AS a, e.i AS z FROM p s JOIN p e ON s.doc_id = e.doc_id AND e.i >= s.i AND e.upto - s.before >= {line_dedup.MIN_WORDS} GROUP BY 1, 3),
body AS (SELECT r.doc_id, a, z, string_agg(line, chr(10) ORDER BY i) AS body
         FROM runs r JOIN p ON p.doc_id = r.doc_id AND p.i BETWEEN a AND z GROUP BY 1, 2, 3),
later AS (SELECT doc_id, a, z FROM (SELECT *, row_number() OVER (PARTITION BY body, z - a ORDER BY doc_id, a) AS nth FROM body) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(a, z + 1)) AS i FROM later)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_lines, CAST(coalesce(g, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM (SELECT doc_id FROM documents) d
LEFT JOIN (SELECT p.doc_id, count(*) AS n, count(gone.i) AS g, string_agg(CASE WHEN gone.i IS NULL THEN line END, chr(10) ORDER BY p.i) AS kept
           FROM p LEFT JOIN gone ON p.doc_id = gone.doc_id AND p.i = gone.i GROUP BY 1) x ON x.doc_id = d.doc_id
""",
)
def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    removed = F.aggregate("removed_lines", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return line_dedup.dedup(docs).select("doc_id", "n_lines", removed.alias("n_removed"), sha256(F.coalesce("text", F.lit(""))).alias("kept_sha256"))


@query(
    "op10_ngram_join",
    rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2)
          JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY 1) m USING (doc_id)
""",
)
def op10_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents").select("doc_id", "text"))


@query("op6_html")
def op6_html(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages)
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.char_length("main_text").cast("long").alias("n_chars"))


@query("op8_language")
def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    out = toxicity.held_out("doc_id", 4, 2)
    model = language.fit(docs.where(~out))
    return language.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), F.col("language").alias("lang_pred"), F.col("language_share").alias("score")
    )


@query("op7_pii")
def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias("n_" + kind)
    return found.select("doc_id", *[count(k) for k in pii.KINDS], sha256(joined("base_spans")).alias("base_sha256"), joined("pii_spans").alias("spans"))


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    removed = F.aggregate("removed_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return suffix_dedup.remove(docs).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    "op11_mixing",
    rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS every, sum(w) OVER () AS weight,
             sum(3 * source_size) OVER x - 3 * source_size AS fuller, sum(w) OVER x - w AS fuller_w
      FROM s WINDOW x AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, coalesce('=' || source, '') ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, (CAST(every AS DOUBLE) - CAST(fuller AS DOUBLE)) * w >= CAST(cap AS DOUBLE) * (CAST(weight AS DOUBLE) - CAST(fuller_w AS DOUBLE)) AS full_ FROM o),
t AS (SELECT source, source_size, CASE WHEN full_ THEN CAST(cap AS DOUBLE) ELSE w * ((CAST(every AS DOUBLE) - CAST(coalesce(sum(cap) FILTER (full_) OVER (), 0) AS DOUBLE))
             / CAST(sum(w) FILTER (NOT full_) OVER () AS DOUBLE)) END AS target FROM f),
e AS (SELECT *, CAST(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END * 4294967296.0) AS BIGINT) AS e,
             CAST('0x' || substr(sha256('11' || coalesce('=' || source, '')), 1, 8) AS BIGINT) AS u FROM t),
p AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.e, e.u, sum(e.e) OVER (PARTITION BY d.source ORDER BY d.size DESC, d.doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, CAST(size * ((upto + u) // 4294967296 - (upto - e + u) // 4294967296) AS BIGINT) AS taken FROM p
""",
)
def op11_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", mixing.words(F.col("text")).alias("size"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op12_conversation")
def op12_conversation(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations")
    found = conversation.repair(conversation.damage(turns))["conversations"].drop("conv")
    every = turns.select("conv_id").distinct().withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    number = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")]
    return every.join(found, "key", "left").select("conv_id", *number, *empty)


# crc32 of the decimal id as DuckDB can say it: the table-free bit loop over the bytes.
_CRC32 = (
    "CASE WHEN doc_id IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(4294967295::UBIGINT, "
    "list_transform(range(1, len(CAST(doc_id AS VARCHAR)) + 1), lambda i: CAST(unicode(CAST(doc_id AS VARCHAR)[i]) AS UBIGINT))), "
    "lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: CAST(z AS UBIGINT))), "
    "lambda r, z: CASE WHEN r % 2 = 1 THEN xor(r >> 1, 3988292384::UBIGINT) ELSE r >> 1 END)), 4294967295::UBIGINT) END"
)


def _manifest_sql(levels: int = 6, source_levels: int = 3) -> str:
    """Trees of up to 16^levels rows a source and 16^source_levels sources, level by level; one select each."""
    f = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: f"sha256(concat({f('doc_id')}, {f('source')}, {f('lang')}, {f('n_chars')}, {f(text)}))"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = [
        f"c AS (SELECT *, {_CRC32} % 5 = 0 AS hit FROM documents)",
        f"l0 AS (SELECT doc_id, coalesce('=' || source, '') AS s, {leaf('text')} AS h, CASE WHEN hit THEN {leaf(low)} ELSE {leaf('text')} END AS t FROM c)",
        "d AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, h) - 1 AS i FROM l0)",
        "n0 AS (SELECT s, i, h, count(*) OVER (PARTITION BY s) AS n FROM d)",
    ]
    for k in range(levels):
        out.append(
            f"n{k + 1} AS (SELECT s, i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 15) // 16 AS n "
            f"FROM n{k} GROUP BY s, i // 16)"
        )
    top = f"n{levels}"
    out.append(f"m0 AS (SELECT s, h, row_number() OVER (ORDER BY s) - 1 AS i, count(*) OVER () AS n FROM {top})")
    out.append("x0 AS (SELECT s, i, h AS subroot FROM m0)")
    for k in range(source_levels):
        out.append(
            f"m{k + 1} AS (SELECT i // 16 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h, (any_value(n) + 15) // 16 AS n FROM m{k} GROUP BY i // 16)"
        )
    steps = [(f"n{k}", f"d.i // {16**k}", "r.s = d.s AND") for k in range(levels)] + [(f"m{k}", f"x0.i // {16**k}", "") for k in range(source_levels)]
    fold, beside, joins, cols = "t", [], [], []
    for j, (level, at, same) in enumerate(steps):
        own = f"({at})"
        runs = f"r{j} AS (SELECT {'s,' if same else ''} i // 16 AS g, any_value(n) AS n, list(h ORDER BY i) AS h FROM {level} GROUP BY {'s,' if same else ''} i // 16)"
        out.append(runs)
        joins.append(f"JOIN r{j} ON {f'r{j}.s = d.s AND' if same else ''} r{j}.g = {own} // 16")
        cols.append(f"CASE WHEN r{j}.n > 1 THEN array_to_string(r{j}.h[1 : {own} % 16], '') ELSE '' END AS b{j}, CASE WHEN r{j}.n > 1 THEN array_to_string(r{j}.h[{own} % 16 + 2 :], '') ELSE '' END AS a{j}, r{j}.n AS n{j}")
    out.append(f"p AS (SELECT d.doc_id, d.h AS leaf, d.t AS f0, x0.subroot, {', '.join(cols)}, (SELECT h FROM m{source_levels}) AS root FROM d JOIN x0 ON x0.s = d.s {' '.join(joins)})")
    for j in range(len(steps)):
        out.append(f"p{j} AS (SELECT * EXCLUDE (f{j}), CASE WHEN n{j} > 1 THEN sha256(b{j} || f{j} || a{j}) ELSE f{j} END AS f{j + 1} FROM {'p' if j == 0 else f'p{j - 1}'})")
    beside = " || ".join(f"b{j} || a{j}" for j in range(len(steps)))
    end = len(steps)
    return f"WITH {', '.join(out)} SELECT doc_id, leaf, subroot, root, sha256({beside}) AS proof_sha256, f{end} AS folded_root, f{end} = root AS verified FROM p{end - 1}"


@query("op13_manifest", _manifest_sql())
def op13_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return manifest.build(docs, changed={"text": lower}, when=found).withColumnRenamed("id", "doc_id")
