"""Exact Jaccard self-join of documents on word n-grams, by components.

Sets are n-gram hashes in one global order: frequent n-grams last. Two linked sets share an n-gram within the prefix of each that
only a fifth of the set can follow, so an index over prefixes finds all candidates. Relations between sets skip the rest:

* equal sets are one class with one answer;
* index lists are cut into blocks of similar set size, and an entry whose position leaves too few n-grams after it is skipped;
* each list is first compared with its smallest set only, then, turn by turn, one member of each component in it with one of another,
  while that finds links and much is left to compare; members of one component need no further comparison;
* two sets meet at the first n-gram they share, not at those after it that either set has within ``BEFORE`` n-grams of another shared one;
* two sets meet only if the parities of their n-grams in ``BITS`` buckets differ in no more places than linked sets can differ in n-grams,
  and none is compared by its text before that is known.

Every pair from different components that is not skipped by a bound is compared exactly.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import add_columns, text_of, worker_cached
from tessella.operators.graph import components
from tessella.session import discard, save

SHINGLE = 5
SIMILARITY = Fraction(4, 5)
HOT_ROWS = 1 << 18  # n-grams ordered by their frequency; all others are ordered by their hash alone
HOT_COUNT = 16
BITS = 512  # buckets of a set's n-grams by their hash; the parity of each bucket's count is a bit
BEFORE = 8  # n-grams of the prefix before its own that an index entry brings along
CROSS = 16  # turns go on while the cross comparison would meet more than so many pairs per index entry (bounds decide most),
YIELD = 8  # one pair in so many that a turn compared was a link
GAIN = 256  # and it found a link per so many index entries
MARKS = 1 << 26  # bits of a broadcast bitmap of ids, 8 MB at most
# Fixed value: A-Z become lower case; words are what ASCII white space leaves.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shingle_set(text: str, width: int = SHINGLE):
    """Sorted distinct hashes of the word n-grams; of a shorter text the one hash of all its words."""
    import numpy as np
    import xxhash

    w = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = min(width, len(w))
    n = len(w) - k + 1
    acc = np.full(n, k, np.uint64)
    for j in range(k):
        acc ^= h[j : j + n]
        acc *= np.uint64(0x9E3779B97F4A7C15)
        acc ^= acc >> np.uint64(29)
    return np.unique(acc)


def parities(s):
    """``BITS`` parities as 64-bit numbers. An n-gram that only one of two sets holds changes one bit, so sets differ in as many n-grams as bits at least."""
    import numpy as np

    n = np.bincount((s % np.uint64(BITS)).astype(np.int64), minlength=BITS)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64)


def _signature(s) -> tuple[int, int]:
    import xxhash

    x = xxhash.xxh3_128_intdigest(s.tobytes())
    return (x >> 64) - (1 << 63), (x & (1 << 64) - 1) - (1 << 63)


def frequent(docs: DataFrame, width: int) -> bytes:
    """N-grams that sets of one batch of some thousands share, by counts over all batches, most frequent first; at most ``HOT_ROWS``
    hashes of 8 bytes. They only steer the global order: any order gives the same links."""
    import numpy as np

    def run(batches):
        import numpy as np
        import pyarrow as pa

        sets: dict = {}

        def counted():
            h, n = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            keep = n > 1
            sets.clear()
            return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(n[keep])], names=["h", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                s = shingle_set(t, width)
                sets[_signature(s)] = s
            if len(sets) >= 3000:
                yield counted()
        if sets:
            yield counted()

    counts = docs.select("t").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= HOT_COUNT).sort(F.desc("n"), "h").limit(HOT_ROWS).select("h").toPandas()
    return rows["h"].to_numpy(np.int64).tobytes()


def sets_of(docs: DataFrame, hot: bytes, width: int, similarity: Fraction) -> DataFrame:
    """``(id, n, s1, s2, bits, prefix)``: set size, set signature, parities and the prefix n-grams in global order."""
    import uuid

    shared, key = docs.sparkSession.sparkContext.broadcast(hot), uuid.uuid4().hex
    num, den = similarity.numerator, similarity.denominator

    def run(texts):
        import numpy as np

        def order():
            h = np.frombuffer(shared.value, np.uint64)
            rank = np.arange(len(h), 0, -1)  # the most frequent come last
            by = np.argsort(h)
            return h[by], rank[by]

        known, rank = worker_cached("ngram_join", key, order)
        out = [[], [], [], [], []]
        for t in texts:
            s = shingle_set(t, width)
            n = len(s)
            a, b = _signature(s)
            bits = parities(s)
            first = n - -(-num * n // den) + 1 if n else 0
            if n and len(known):
                at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                s = s[np.lexsort((s, np.where(known[at] == s, rank[at], 0)))]
            for o, v in zip(out, (n, a, b, bits, s[:first].view(np.int64))):
                o.append(v)
        return out

    return add_columns(docs, [docs["t"]], "n int, s1 bigint, s2 bigint, bits array<bigint>, prefix array<bigint>", run, batch_rows=1000).drop("t")


def compare(pairs: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """``(a, b, common, total)`` of pairs of ids: sizes of intersection and union, from the texts. One row at a time meets Python."""
    with_b = pairs.join(docs.select(F.col("id").alias("b"), F.col("t").alias("tb")), "b")
    both = with_b.join(docs.select(F.col("id").alias("a"), F.col("t").alias("ta")), "a")

    def run(left, right):
        import numpy as np

        common, total, last, s = [], [], None, None
        for x, y in zip(left, right):
            if x is not last and x != last:
                last, s = x, shingle_set(x, width)
            r = shingle_set(y, width)
            c = len(np.intersect1d(s, r, assume_unique=True))
            common.append(c)
            total.append(len(s) + len(r) - c)
        return [common, total]

    return add_columns(both, [both["ta"], both["tb"]], "common int, total int", run, batch_rows=1000).select("a", "b", "common", "total")


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The ``rows`` whose ``id`` is one of ``ids``. A bitmap of the hashes of the ids, bounded in size, keeps most others from being shuffled."""
    at = F.pmod(F.xxhash64("id"), F.lit(MARKS))
    ids = ids.select("id").distinct()
    marks = ids.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("marks"))
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("marks", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = rows.withColumn("bucket", F.bitmap_bucket_number(at)).join(F.broadcast(marks), "bucket").where(F.getbit(byte, (bit % 8).cast("int")) == 1)
    return likely.select(*rows.columns).join(ids, "id", "left_semi")


def _alike(both, similarity: Fraction):
    """Whether the parities ``bits_a`` and ``bits_b`` let sets of ``both`` sizes together link: linked sets differ in at most the share
    (1 - similarity) / (1 + similarity) of both sizes."""
    num, den = similarity.numerator, similarity.denominator
    differ = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(BITS // 64)), F.lit(0))
    return differ * (num + den) <= both * (den - num)


def _possible(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """Distinct ``(a, b)`` of ``pairs`` ``(a, n_a, b, n_b)`` with sets of these sizes whose parities allow a link."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias("n_" + c), F.col("bits").alias("bits_" + c))
    both = pairs.join(side("a"), ["a", "n_a"]).join(side("b"), ["b", "n_b"])
    return both.where(_alike(F.col("n_a") + F.col("n_b"), similarity)).select("a", "b").distinct()


def _entries(index: DataFrame, sets: DataFrame, on: list[str]) -> DataFrame:
    """``index`` with the parities of its sets and ``before``, the up to ``BEFORE`` n-grams in front of the entry's own in its set's prefix."""
    own = F.get("prefix", F.col("pos")) == F.col("token")  # an id may have several sets
    before = F.slice("prefix", F.greatest(F.col("pos") - BEFORE, F.lit(0)) + 1, F.least("pos", F.lit(BEFORE)))
    return index.join(sets, on).where(own).withColumn("before", before).drop("prefix")


def _meetings(entries: DataFrame, columns: list[str], similarity: Fraction) -> DataFrame:
    """Pairs of index entries of one token, ``columns`` with _a and _b, that sizes, positions and parities allow to link.

    With the column ``before`` a pair is left out where both entries have an n-gram in common before this one: it meets there, since both
    positions leave more room and the other bounds depend on the two sets alone, or by the same rule still earlier."""
    num, den = similarity.numerator, similarity.denominator
    block = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(float(1 / similarity))) + 1e-9).cast("int")
    entries = entries.withColumn("block", block)
    # each two blocks side by side meet once: the smaller sets come to the block of the larger ones
    a = entries.select("token", "block", *[F.col(c).alias(c + "_a") for c in columns], F.explode(F.array(F.lit(0), F.lit(1))).alias("up"))
    a = a.withColumn("block", F.col("block") + F.col("up"))
    b = entries.select("token", "block", *[F.col(c).alias(c + "_b") for c in columns])
    near = (num * F.col("n_a") <= den * F.col("n_b")) & (num * F.col("n_b") <= den * F.col("n_a"))
    room = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    both = F.col("n_a") + F.col("n_b")
    once = (F.col("id_a") < F.col("id_b")) | (F.col("up") == 1) & (F.col("id_a") != F.col("id_b"))
    allowed = once & near & (room * (num + den) >= both * num) & _alike(both, similarity)
    if "before" in columns:
        allowed &= ~F.arrays_overlap("before_a", "before_b")
    return a.join(b, ["token", "block"]).where(allowed)


def links(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, similarity: Fraction = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """All links: ``(a, b, common, total)`` of classes of equal sets, with the sizes of intersection and union, and the membership
    ``(doc_id, class_id)`` of documents with a text and an id.

    The terms are those of ``join``. Documents of one class link with each other, and with those of every class theirs is linked to.
    Pairs inside components are measured too, so the work grows with the number of pairs that share a prefix n-gram.
    """
    num, den = similarity.numerator, similarity.denominator
    plain = docs.select(docs[f"`{key}`"].cast("long").alias("doc_id"), text_of(docs, text).alias("t")).where("doc_id is not null")
    plain = plain.withColumn("id", F.sha2("t", 256))
    texts = save(plain.groupBy("id").agg(F.first("t").alias("t")), "texts")
    sets = save(sets_of(texts, frequent(texts, width), width, similarity).where("n > 0"), "sets")
    named = sets.groupBy("n", "s1", "s2").agg(F.min("id").alias("class_id"))
    named = save(sets.select("id", "n", "s1", "s2").join(named, ["n", "s1", "s2"]).select("id", "class_id"), "classes")
    entries = sets.join(named.where("id = class_id"), "id", "left_semi").select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = entries.groupBy("token").count().where("count > 1").select("token")
    index = _entries(entries.join(shared, "token"), sets.select("id", "bits", "prefix"), ["id"])
    pairs = _meetings(index, ["id", "n", "pos", "bits", "before"], similarity)
    pairs = save(pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct(), "pairs")
    found = compare(pairs, texts, width).where(F.col("common") * den >= F.col("total") * num)
    return save(found, "links"), plain.join(named, "id").select("doc_id", "class_id").distinct()


def join(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = SHINGLE, similarity: Fraction = SIMILARITY) -> DataFrame:
    """One row ``(doc_id, n_shingles, component_id)`` per row of ``docs``.

    Words are what ASCII white space leaves, with A-Z in lower case; a set holds the distinct ``width``-word n-grams, or the
    whole word sequence of a shorter text. Two documents link if the Jaccard similarity of their sets is at least ``similarity``;
    the component is the smallest id reachable over links. Null or empty texts link with nothing. A null id gets a null component
    and takes no part; rows that share an id are one vertex with the links of all their texts. Any other columns are ignored.
    """
    num, den = similarity.numerator, similarity.denominator
    plain = docs.select(docs[f"`{key}`"].cast("long").alias("id"), text_of(docs, text).alias("t"))
    sets = save(sets_of(plain, frequent(plain, width), width, similarity), "sets")
    size = sets.select("id", "n", "s1", "s2")
    classes = save(size.where("n > 0 and id is not null").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep")), "classes")

    entries = sets.join(classes.select(F.col("rep").alias("id"), "n", "s1", "s2"), ["id", "n", "s1", "s2"], "left_semi")
    entries = entries.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = entries.groupBy("token").count().where("count > 1").select("token")
    index = save(entries.join(shared, "token").distinct(), "index")

    near = lambda x, y: (num * F.col(x) <= den * F.col(y)) & (num * F.col(y) <= den * F.col(x))
    lead = index.groupBy("token").agg(F.min(F.struct("n", "id")).alias("lead"))
    star = index.join(lead, "token").select(F.col("lead.id").alias("a"), F.col("lead.n").alias("n_a"), F.col("id").alias("b"), F.col("n").alias("n_b"))
    star = save(_possible(star.where("a <> b").where(near("n_a", "n_b")).distinct(), sets, similarity), "star")
    needed = star.select(F.col("a").alias("id")).union(star.select("b")).distinct()
    measured = save(compare(star, _among(plain, needed), width), "measured")
    discard(star)
    is_link = F.col("common") * den >= F.col("total") * num
    links = measured.where(is_link).select("a", "b")
    comps = save(components(links.toDF("u", "v")), "components")
    grown = lambda new: comps.where("id <> root").select("id", "root").union(new).toDF("u", "v")
    turn, more = 0, True
    while True:
        # lists of several components: one member of each, another by chance in every list and turn, meets one of the first
        placed = index.join(comps, "id", "left").withColumn("comp", F.coalesce("root", "id")).drop("root")
        mixed = placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("token")
        placed = save(placed.join(mixed, "token"), "placed")
        share = placed.groupBy("token", "comp").agg(F.count("*").cast("double").alias("c")).groupBy("token")
        share = share.agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("own"))
        meets, entries_left = share.agg(F.sum((F.col("m") * F.col("m") - F.col("own")) / 2), F.sum("m")).first()
        if not more or (meets or 0) <= CROSS * (entries_left or 0):
            break
        chance = F.struct(F.xxhash64("id", "token", F.lit(turn)).alias("h"), "id", "n")
        drawn = placed.groupBy("token", "comp").agg(F.min(chance).alias("m"))
        first = drawn.groupBy("token").agg(F.min(F.struct("comp", "m")).alias("f"))
        meet = drawn.join(first, "token").where(F.col("comp") != F.col("f.comp")).where(near("m.n", "f.m.n"))
        meet = meet.select(F.col("f.m.id").alias("a"), F.col("f.m.n").alias("n_a"), F.col("m.id").alias("b"), F.col("m.n").alias("n_b")).distinct()
        known = measured.select("a", "b").union(measured.select("b", "a")).distinct()
        meet = save(_possible(meet.join(known, ["a", "b"], "left_anti"), sets, similarity), "meet")
        needed = meet.select(F.col("a").alias("id")).union(meet.select("b")).distinct()
        fresh = save(compare(meet, _among(plain, needed), width), "measured")
        new = fresh.where(is_link).select("a", "b")
        measured = measured.unionByName(fresh)
        discard(meet)
        met, linked = fresh.agg(F.count("*"), F.count_if(is_link)).first()
        if not linked:
            break
        comps = save(components(grown(new)), "components")
        more = YIELD * linked >= met and GAIN * linked >= entries_left
        turn += 1
        discard(placed)

    discard(index)
    # an id with several sets of one size meets with the parities of each
    own = _among(sets, placed).select("id", "n", "s1", "s2", "bits", "prefix")
    own = own.dropDuplicates(["id", "n", "s1", "s2"]).drop("s1", "s2")
    placed = _entries(placed, own, ["id", "n"])
    pairs = _meetings(placed, ["id", "n", "pos", "comp", "bits", "before"], similarity).where("comp_a <> comp_b")
    pairs = pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()
    gone = measured.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = save(pairs.join(gone, ["a", "b"], "left_anti"), "pairs")

    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    more = compare(pairs, _among(plain, needed), width).where(is_link).select("a", "b")
    more = save(more, "more")
    if not more.isEmpty():
        comps = save(components(grown(more)), "components")

    roots = classes.join(comps.select(F.col("id").alias("rep"), "root"), "rep", "left")
    roots = roots.select("n", "s1", "s2", F.coalesce("root", "rep").alias("root"))
    # rows that share an id are one vertex: each of its sets carries the smallest root of the id
    out = size.join(roots, ["n", "s1", "s2"], "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id. Rows without an id stay."""
    found = join(docs, text, key, **options)
    go = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(go, docs[f"`{key}`"].cast("long") == F.col("gone"), "left_anti")
