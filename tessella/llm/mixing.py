"""Mixing sources to target weights by systematic sampling.

Sources share the words of the whole corpus by weight; a source's target stops at ``ceiling`` times what it holds, and the
rest is shared again by the others. Within a source every document has the same expected number of copies, target / size.
The expected copies are summed up along the source, one random offset of the source is added, and a document is
taken once for each whole number that its stretch crosses: ``floor`` or ``ceil`` of the expectation, never more.

Documents stand in order of falling size. With D the running sum of (copies - expected copies), which lies between
offset - 1 and offset, the words taken differ from the target by the sum of D times the steps of the sizes,
so by less than the largest document of the source; in any other order the error grows with the number of documents.

Everything is DataFrame code. Running sums come from range partitions with offsets, so a source may hold any share of all rows;
sums of expectations are whole numbers of 2^-32 copies, so reruns agree and no copy is lost to rounding.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.operators.graph import lookup
from tessella.session import discard, save

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: words of the mixing rule
WEIGHTS = (1, 2, 3)
CEILING = 3
UNIT = 1 << 32  # one copy


def words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def running(df: DataFrame, by: Sequence[str], order: Sequence[str], totals: Sequence[str], name: str) -> DataFrame:
    """``df`` (written once, in range partitions) with ``nth`` (from 0) and ``upto_<total>``: rank and running sums within ``by``.
    ``by`` holds no nulls."""
    by, order = list(by), list(order)
    p = save(df.repartitionByRange(*by, *order).withColumn("part", F.spark_partition_id()), name)
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    before = W.partitionBy(*by).orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per range partition and ``by``
    parts = p.groupBy(*by, "part").agg(F.count("*").alias("c_"), *[F.sum(wide(t)).alias("c_" + t) for t in totals])
    parts = parts.select(*by, "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias("b" + c) for c in ["c_", *["c_" + t for t in totals]]])
    own = W.partitionBy(*by, "part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    ranks = [F.row_number().over(W.partitionBy(*by, "part").orderBy(*order)).alias("r_"), *[F.sum(wide(t)).over(own).alias("s_" + t) for t in totals]]
    r = p.select("*", *ranks).join(parts, [*by, "part"])
    sums = [(F.col("s_" + t) + F.col("bc_" + t)).cast("decimal(38,0)").alias("upto_" + t) for t in totals]
    return r.select(*df.columns, (F.col("r_") - 1 + F.col("bc_")).cast("long").alias("nth"), *sums)


def offset(key: Column, seed: int) -> Column:
    """The random offset of a source in units of 2^-32: eight hex digits of a digest of the seed and the source."""
    return F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}"), key), 256), 1, 8), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """``sizes`` (key, source, source_size; a row per source) with ``target``: shares of all words by weight, weights repeating over
    the sources in code point order (null last), filled up to ``ceiling`` times the source's size."""
    first = running(sizes.withColumn("last", F.col("source").isNull()), [], ["last", "source"], [], "mix-sources")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    s = first.withColumn("w", F.get(cycle, (F.col("nth") % len(weights)).cast("int")).cast("long"))
    s = s.select("key", "source", "source_size", "w", (F.col("source_size") * ceiling).alias("cap"))
    s = s.withColumn("ratio", F.col("cap").cast("double") / F.col("w"))
    s = save(running(s, [], ["ratio", "key"], ["cap", "w"], "mix-levels"), "mix-targets")
    every, weight = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0))).first()
    # in order of cap / weight: full if its share of what the fuller ones leave reaches its cap
    left = F.lit(float(every)) - (F.col("upto_cap") - F.col("cap")).cast("double")
    others = F.lit(float(weight)) - (F.col("upto_w") - F.col("w")).cast("double")
    s = s.withColumn("full", left * F.col("w") >= F.col("cap").cast("double") * others)
    open_ = F.col("full") == F.lit(False)
    held, rest = s.agg(F.sum(F.when(F.col("full"), F.col("cap"))), F.sum(F.when(open_, F.col("w")))).first()
    level = (float(every) - float(held or 0)) / float(rest or 1)
    return s.select("key", "source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("w") * F.lit(level)).alias("target"))


def mix(
    df: DataFrame,
    size: str = "size",
    source: str = "source",
    order: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    ceiling: int = CEILING,
    seed: int = 11,
) -> DataFrame:
    """``df`` with ``source_size`` and ``target`` of the row's source (long, double) and ``copies`` (long): how often the mix takes the row.

    All rows are kept. A null or negative size counts as 0; a null source is a source of its own, the last. A source without words has the target 0 and no
    copies. Rows equal in source, size and ``order`` are told apart by nothing, so copies among them go to any; repeated rows count each. Texts
    are measured whole, whatever their length. An empty table gives an empty table. Columns of ``df`` called like the three new ones
    are replaced; all other columns pass through. The rows are written once to the shared folder: drop what isn't needed.
    """
    spark = df.sparkSession
    own = [c for c in df.columns if c not in ("source_size", "target", "copies")]
    q = lambda c: df[f"`{c}`"]
    text = q(source).cast("string")
    rows = df.select(
        F.struct(*[q(c) for c in own]).alias("row"),
        F.coalesce(F.concat(F.lit("="), text), F.lit("")).alias("key"),
        F.greatest(F.coalesce(q(size), F.lit(0)), F.lit(0)).cast("long").alias("size"),
        q(order).alias("id"),
    )
    rows = save(rows, "mix-rows")
    sizes = rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = save(sizes.withColumn("source", F.when(F.col("key") != "", F.expr("substring(key, 2)"))), "mix-sizes")
    n = sizes.agg(F.sum("n")).first()[0] or 0
    plan = targets(sizes.drop("n"), weights, ceiling).drop("source")
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("e", F.floor(per * F.lit(float(UNIT))).cast("long")).withColumn("u", offset(F.col("key"), seed))
    planned = lookup(rows, "key", save(plan, "mix-plan"), n).withColumn("falling", -F.col("size"))
    done = running(planned, ["key"], ["falling", "id"], ["e"], "mix-sums")
    discard(rows)
    crossed = lambda to: F.call_function("div", (to + F.col("u")).cast("decimal(38,0)"), F.lit(UNIT).cast("decimal(38,0)"))
    copies = (crossed(F.col("upto_e")) - crossed(F.col("upto_e") - F.col("e"))).cast("long")
    return done.select(*[F.col("row")[c].alias(c) for c in own], "source_size", "target", copies.alias("copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix`` as often as it is taken, with ``copy`` counting from 1."""
    return mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
