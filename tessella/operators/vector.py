"""Vector outlines to raster: filters, ring assembly, projection and polygon fill."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessella.operators import runs as R
from tessella.operators.graph import components, lookup, ranked
from tessella.session import discard, save


def bbox_filter(points: DataFrame, s: float, w: float, n: float, e: float, tag: str = "water") -> DataFrame:
    """Points of natural=``tag`` elements inside the box."""
    return points.where(
        (F.col("tags")["natural"] == tag) & F.col("lat").between(s, n) & F.col("lon").between(w, e)
    )


def outer_lines(lines: DataFrame) -> DataFrame:
    """Ways, and relation members whose role is ``outer`` or empty; a missing role is not an empty one."""
    return lines.where((F.col("type") == "way") | F.col("role").isin("outer", ""))


def rivers_only(lines: DataFrame) -> DataFrame:
    """Relation arcs; stand-alone ways (lakes and ponds) go."""
    return lines.where(F.col("type") == "relation")


def line_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("type").agg(F.count("*").alias("lines"))


def _ends(arcs: DataFrame, tol: float) -> DataFrame:
    """Both ends of each arc ``(arc_id, side, node)``; nodes are numbered by latitude, then longitude. Equal places are one node at once. A place
    where only one end lies also meets all places within ``tol``, wherever grid lines run: it is looked up in its own and the eight neighbouring cells."""
    p = lambda i, side: F.struct(F.lit(side).alias("side"), F.element_at("geometry", i).lat.alias("lat"), F.element_at("geometry", i).lon.alias("lon"))
    ends = arcs.where(F.size("geometry") >= 2).select("arc_id", F.explode(F.array(p(1, 0), p(-1, 1))).alias("e")).select("arc_id", "e.*")
    ends = save(ends, "ends")
    places = save(ranked(ends.groupBy("lat", "lon").agg(F.count("*").alias("ends")), [], ["lat", "lon"], "place"), "places")
    q = lambda c: F.floor(F.col(c) / F.lit(tol)).cast("long")
    cell = places.select("place", "lat", "lon", q("lat").alias("ci"), q("lon").alias("cj"), "ends")
    step = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    near = cell.where("ends = 1").withColumn("s", F.explode(F.array(*step))).select(
        F.col("place").alias("u"), F.col("lat").alias("la"), F.col("lon").alias("lo"), (F.col("ci") + F.col("s.i")).alias("ci"), (F.col("cj") + F.col("s.j")).alias("cj")
    )
    same = near.join(cell, ["ci", "cj"]).where((F.col("u") != F.col("place")) & (F.abs(F.col("la") - F.col("lat")) <= tol) & (F.abs(F.col("lo") - F.col("lon")) <= tol))
    node = components(same.select("u", F.col("place").alias("v"))).select(F.col("id").alias("place"), "root")
    node = places.join(node, "place", "left").select("lat", "lon", F.coalesce("root", "place").cast("long").alias("node"))
    return save(ends.join(node, ["lat", "lon"]).select("arc_id", "side", "node"), "ends")


def _dart(arc: str = "arc_id", side: str = "side") -> Column:
    """An arc walked from its end ``side``: twice its id plus the side."""
    return F.col(arc) * 2 + F.col(side)


def _labels(arcs: DataFrame, mates: DataFrame) -> DataFrame:
    """The smallest arc of each chain or ring, ``(arc_id, root)``, where an arc has one mate at each end at most: by pointer doubling over both directions.
    After k rounds a dart knows the smallest of 2^k arcs ahead; once none learns a smaller one, all know their chain's."""
    came = mates.select(F.col("dart").bitwiseXOR(F.lit(1)).alias("dart"), F.col("mate").alias("nxt"))
    darts = arcs.select("arc_id", F.explode(F.array((F.col("arc_id") * 2), (F.col("arc_id") * 2 + 1))).alias("dart"))
    t = save(darts.join(came, "dart", "left").select("dart", "nxt", F.col("arc_id").alias("low"), F.lit(True).alias("new")), "labels")
    while not t.where("new").isEmpty():
        ahead = t.select(F.col("dart").alias("nxt"), F.col("nxt").alias("n2"), F.col("low").alias("l2"))
        far = t.join(ahead, "nxt", "left").select("dart", F.col("n2").alias("nxt"), F.least("low", "l2").alias("low"), F.coalesce(F.col("l2") < F.col("low"), F.lit(False)).alias("new"))
        far = save(far, "labels")
        discard(t)
        t = far
    return t.groupBy(F.shiftright("dart", 1).alias("arc_id")).agg(F.min("low").alias("root"))


def _peel(ends: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Take off what hangs on one end: the ends left, their chains ``(arc_id, chain)`` through nodes of two ends, and the chains taken off.

    Chains are found as a whole and taken off as a whole, so the rounds follow the logarithm of a hanging tree, not the length of a chain. They
    are found once: where two ends are left at a node that lost others, two chains grow together."""
    hung = None
    chains = save(_labels(ends.select("arc_id").distinct(), _plain(ends)).withColumnRenamed("root", "chain"), "chains")
    while True:
        tips = ends.groupBy("node").agg(F.count("*").alias("n"), F.min("arc_id").alias("arc_id")).where("n = 1")
        tips = tips.join(chains, "arc_id").select("chain").distinct()
        off = save(chains.join(tips, "chain", "left_semi").select("arc_id", "chain"), "hung")
        if off.isEmpty():
            return ends, chains, hung if hung is not None else off
        hung = off if hung is None else hung.unionByName(off)
        rest = save(ends.join(off, "arc_id", "left_anti"), "ends")
        chains = save(chains.join(off, "arc_id", "left_anti"), "chains")
        bare = save(rest.join(ends.join(off, "arc_id", "left_semi").select("node").distinct(), "node", "left_semi"), "bare")
        if bare.isEmpty():
            return rest, chains, hung
        ends = rest
        two = bare.join(chains, "arc_id").groupBy("node").agg(F.count("*").alias("n"), F.min("chain").alias("u"), F.max("chain").alias("v")).where("n = 2")
        one = components(two.select("u", "v")).withColumnRenamed("id", "chain")
        chains = save(lookup(chains, "chain", one, chains.count()).select("arc_id", F.coalesce("root", "chain").alias("chain")), "chains")


def _walks(chains: DataFrame, met: DataFrame) -> DataFrame:
    """The smallest arc of each walk, ``(arc_id, root)``, over ``chains`` that the mates ``met`` join at their ends. Chains are joined as wholes:
    each is an arc of that name, so the rounds and rows follow the chains that meet, not their arcs."""
    tips = met.select("dart", F.shiftright("dart", 1).alias("arc_id")).join(chains, "arc_id").select("dart", "chain")
    first = tips.groupBy("chain").agg(F.min("dart").alias("first"))
    tips = save(tips.join(first, "chain").select("dart", (F.col("chain") * 2 + (F.col("dart") != F.col("first")).cast("long")).alias("tip")).distinct(), "tips")
    ahead = tips.select(F.col("dart").alias("mate"), F.col("tip").alias("ahead"))
    mates = met.select("dart", "mate").distinct().join(tips, "dart").join(ahead, "mate").select(F.col("tip").alias("dart"), F.col("ahead").alias("mate"))
    whole = _labels(tips.select(F.shiftright("tip", 1).alias("arc_id")).distinct(), mates).withColumnRenamed("arc_id", "chain")
    return lookup(chains.select("arc_id", "chain"), "chain", whole, chains.count()).select("arc_id", F.coalesce("root", "chain").alias("root"))


def _turns(arcs: DataFrame) -> DataFrame:
    """The direction in which each end leaves its node ``(dart, angle, lat, lon)``: counterclockwise from due south, with the first other point."""
    g, n = F.col("geometry"), F.size("geometry")

    def other(points, at):
        return F.get(F.filter(points, lambda p: (p["lat"] != at["lat"]) | (p["lon"] != at["lon"])), F.lit(0))

    first, last = F.element_at(g, 1), F.element_at(g, -1)
    side = lambda s, at, points: F.struct(F.lit(s).alias("side"), at.alias("at"), other(points, at).alias("to"))
    e = arcs.select("arc_id", n.alias("points"), F.explode(F.array(side(0, first, g), side(1, last, F.reverse(g)))).alias("e")).select("arc_id", "points", "e.*")
    east, south = F.col("to.lon") - F.col("at.lon"), F.col("at.lat") - F.col("to.lat")
    turn = F.atan2(east, south)
    return e.select(_dart().alias("dart"), F.when(turn < 0, turn + 2 * math.pi).otherwise(turn).alias("angle"), "to.lat", "to.lon", "points")


def _order(darts: DataFrame) -> DataFrame:
    """List ranking by pointer doubling. ``(dart, nxt, w)`` with ``nxt`` null at the end of each list -> ``(dart, last, w)``: the last dart of
    the list and the weight from this dart to the end. Rounds: logarithm of the longest list."""
    t = save(darts.select("dart", "nxt", F.col("w").cast("long").alias("w"), F.col("dart").alias("last")), "ranks")
    while not t.where("nxt IS NOT NULL").isEmpty():
        ahead = t.select(F.col("dart").alias("nxt"), F.col("nxt").alias("n2"), F.col("w").alias("w2"), F.col("last").alias("l2"))
        far = t.join(ahead, "nxt", "left").select("dart", F.col("n2").alias("nxt"), (F.col("w") + F.coalesce("w2", F.lit(0))).alias("w"), F.coalesce("l2", "last").alias("last"))
        far = save(far, "ranks")
        discard(t)
        t = far
    return t.select("dart", "last", "w")


def _walk_lists(ends: DataFrame, mates: DataFrame, roots: DataFrame, start: DataFrame, weight: DataFrame) -> DataFrame:
    """Directed lists of walks: ``(dart, arc_id, side, node, root, last, w, mate)``. A dart leaves ``node``; a walk is cut where it
    leaves ``start`` (root, start), an open one where it ends. Every walk comes in both directions. ``mate``: the end it came from in the uncut walk."""
    d = ends.join(roots, "arc_id").select("arc_id", "side", _dart().alias("dart"), "node", "root")
    d = save(d.join(mates, "dart", "left").join(weight, "arc_id"), "darts")  # mate: the other end at the node of this dart
    arrives = d.select((F.col("arc_id") * 2 + 1 - F.col("side")).alias("dart"), F.col("mate").alias("nxt"))
    leaves = d.select(F.col("dart").alias("nxt"), F.col("node").alias("to"))
    nxt = arrives.join(leaves, "nxt").join(d.select("dart", "root"), "dart").join(start, "root", "left")
    nxt = nxt.where("start IS NULL OR to <> start").select("dart", "nxt")
    order = _order(d.join(nxt, "dart", "left").select("dart", "nxt", "w"))
    return d.drop("w").join(order, "dart")


def _pairs(placed: DataFrame) -> DataFrame:
    """Mates at junctions. ``placed``: dart, node, k (from 0, counterclockwise), n (even), x: 1 if the sector after end 0 is water.
    The two ends that bound a sector of water belong together; ``left``: the dart that has it on its left."""
    slot = F.floor((F.col("k") + F.when(F.col("x") == 1, 0).otherwise(F.col("n") - 1)) % F.col("n") / 2)
    left = (F.col("k") + F.col("x")) % 2 == 1
    p = placed.select("dart", "node", slot.alias("slot"), left.alias("left"))
    two = p.groupBy("node", "slot").agg(F.min("dart").alias("a"), F.max("dart").alias("b"), F.max(F.when(F.col("left"), F.col("dart"))).alias("l"))
    return two.select(F.explode(F.array(F.struct(F.col("a").alias("dart"), F.col("b").alias("mate"), "l"), F.struct(F.col("b").alias("dart"), F.col("a").alias("mate"), "l"))).alias("m")).select(
        "m.dart", "m.mate", (F.col("m.dart") == F.col("m.l")).alias("left")
    )


def _area(arcs: DataFrame) -> DataFrame:
    """Twice the signed area under each arc, walked forwards (east, north)."""
    g = F.col("geometry")
    cross = F.zip_with(F.slice(g, F.lit(1), F.size(g) - 1), F.slice(g, F.lit(2), F.size(g) - 1), lambda a, b: a["lon"] * b["lat"] - b["lon"] * a["lat"])
    return arcs.select("arc_id", F.aggregate(cross, F.lit(0.0), lambda s, v: s + v).alias("area"))


def _junctions(ends: DataFrame, chains: DataFrame, arcs: DataFrame) -> DataFrame:
    """Mates ``(dart, mate)`` at nodes where more than two ends meet, so that walks go around water.

    Ends stand counterclockwise around a node; sectors of water and land alternate. A chain that leaves node v as end k and reaches node w as end l has the same
    water on its side at both, which ties the two alternations together (their parities differ by k + l + 1); components over (node, parity) spread that. Which of the
    two is water is told by the sign of the area of all walks that belong together. At a node with an odd number of ends the last one stays loose."""
    meets = ends.groupBy("node").agg(F.count("*").alias("n")).where("n > 2")
    at = ends.join(meets, "node").withColumn("dart", _dart())
    near = arcs.join(at.select("arc_id").distinct(), "arc_id", "left_semi")
    at = at.join(_turns(near), "dart")
    w = W.partitionBy("node").orderBy("angle", "lat", "lon", "points", "dart")  # the ends that meet in one place of a map
    at = at.withColumn("k", F.row_number().over(w) - 1).withColumn("n", F.col("n") - F.col("n") % 2).where("k < n")
    at = save(at.select("dart", "arc_id", "node", "k", "n"), "junctions")
    ends2 = at.join(chains, "arc_id").groupBy("chain").agg(
        F.count("*").alias("c"), F.min("node").alias("v"), F.max("node").alias("w"), (F.sum("k") + 1).alias("tie")
    )
    both = F.array(*[F.struct((F.col("v") * 2 + c).alias("u"), (F.col("w") * 2 + (F.col("tie") + c) % 2).alias("v")) for c in (0, 1)])
    tied = components(ends2.where("c = 2").select(F.explode(both).alias("e")).select("e.u", "e.v"))
    # of the two alternations of a connected set the one that makes the sector after end 0 of its first node water
    half = tied.select(F.floor(F.col("id") / 2).cast("long").alias("node"), (F.col("id") % 2).alias("c"), "root")
    sets = half.groupBy("node").agg(F.floor(F.min("root") / 2).cast("long").alias("set"), F.max(F.when(F.col("root") % 2 == 1, F.col("c"))).alias("x"), F.countDistinct("root").alias("roots"))
    placed = at.join(sets, "node", "left")
    placed = placed.select("dart", "node", "k", "n", F.coalesce("set", "node").alias("set"), F.when(F.col("roots") == 2, F.col("x")).otherwise(F.lit(1)).alias("x"))
    placed = save(placed, "placed")
    first = _pairs(placed)
    # walks directed with their water on the left: whole sets of negative area are the other way round
    own = chains.join(at.select("arc_id").distinct().join(chains, "arc_id").select("chain").distinct(), "chain", "left_semi")
    here = ends.join(own, "arc_id", "left_semi")
    mates = save(first.select("dart", "mate").unionByName(_plain(here)), "mates")
    roots = save(_walks(own, first), "roots")
    start = here.join(roots, "arc_id").groupBy("root").agg(F.min("node").alias("start"))
    lists = save(_walk_lists(here, mates, roots, start, own.select("arc_id", F.lit(1).alias("w"))), "lists")
    facing = first.where("left").join(placed.select("dart", "set"), "dart").join(lists.select("dart", "last"), "dart").groupBy("last").agg(F.min("set").alias("set"))
    area = lists.join(facing, "last").join(_area(arcs), "arc_id").groupBy("set").agg(F.sum(F.when(F.col("side") == 0, F.col("area")).otherwise(-F.col("area"))).alias("area"))
    turned = placed.join(area.where("area < 0").select("set", F.lit(1).alias("turn")), "set", "left")
    return save(_pairs(turned.withColumn("x", F.when(F.col("turn") == 1, 1 - F.col("x")).otherwise(F.col("x")))).select("dart", "mate"), "mates")


def _plain(ends: DataFrame) -> DataFrame:
    """Mates at nodes where exactly two ends meet."""
    two = ends.groupBy("node").agg(F.count("*").alias("n"), F.min(_dart()).alias("a"), F.max(_dart()).alias("b")).where("n = 2")
    both = F.array(F.struct(F.col("a").alias("dart"), F.col("b").alias("mate")), F.struct(F.col("b").alias("dart"), F.col("a").alias("mate")))
    return two.select(F.explode(both).alias("m")).select("m.*")


def _open(ends: DataFrame, mates: DataFrame, roots: DataFrame) -> DataFrame:
    """Walks with a loose end."""
    return ends.withColumn("dart", _dart()).join(mates, "dart", "left_anti").join(roots, "arc_id").select("root").distinct()


def _split(ends: DataFrame, mates: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Closed walks that pass a node twice fall apart there, so that each ring passes a node once. Every round cuts each such walk at its first such node,
    and within the parts at all others at once (water walks nest, so one round is the rule)."""
    while True:
        twice = ends.join(roots, "arc_id").groupBy("root", "node").agg(F.count("*").alias("n")).where("n > 2")
        twice = twice.join(_open(ends, mates, roots), "root", "left_anti")
        start = save(twice.groupBy("root").agg(F.min("node").alias("start")), "twice")
        if start.isEmpty():
            return mates, roots
        busy = save(roots.join(start, "root", "left_semi"), "busy")
        here = ends.join(busy, "arc_id", "left_semi")
        lists = save(_walk_lists(here, mates, busy, start, busy.select("arc_id", F.lit(1).alias("w"))), "lists")
        # one of the two directions of each part
        part = lists.groupBy("last").agg(F.min("arc_id").alias("low"), F.max("w").alias("len"))
        part = part.groupBy("low", "len").agg(F.min("last").alias("last"))
        one = lists.join(part, "last")
        ended = F.when(F.col("w") == F.col("len"), F.col("last").bitwiseXOR(F.lit(1))).otherwise(F.col("mate"))  # the end by which the walk came here
        seen = W.partitionBy("last", "node").orderBy(F.desc("w"))
        came = F.coalesce(F.lead("came").over(seen), F.first("came").over(seen))
        again = one.withColumn("came", ended).select("dart", came.alias("mate"))
        again = again.where("mate IS NOT NULL").select(F.explode(F.array(F.struct("dart", "mate"), F.struct(F.col("mate").alias("dart"), F.col("dart").alias("mate")))).alias("m")).select("m.*")
        kept = mates.join(here.select(_dart().alias("dart")), "dart", "left_anti")
        mates = save(kept.unionByName(again), "mates")
        roots = save(roots.join(busy, "arc_id", "left_anti").unionByName(_labels(busy.select("arc_id"), again)), "roots")


def assemble(arcs: DataFrame, tol: float = 1e-7) -> tuple[DataFrame, DataFrame]:
    """Join arcs ``(arc_id, geometry)`` end to end: ``chain_rings`` of them and the table ``(dart, node, mate)`` behind it, which ``ring_points`` takes.

    An arc whose ends meet is a ring of its own. Chains that hang on one end only are taken off, again and again, and come back as open chains. Where more than two
    ends meet, the ends that bound the same water are joined, and walks that pass a node twice are split there: the
    result does not depend on the numbers of the arcs. Only ids and ends travel; rings of any length are found by component search, not by walking."""
    every = _ends(arcs, tol)
    pair = every.groupBy("arc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    own = save(pair.where("a = b").select("arc_id"), "closed")
    ends, chains, hung = _peel(save(every.join(own, "arc_id", "left_anti"), "ends"))
    mates = _plain(ends)
    if ends.groupBy("node").count().where("count > 2").isEmpty():
        roots = chains.select("arc_id", F.col("chain").alias("root"))
    else:
        met = _junctions(ends, chains, arcs)
        mates, roots = _split(ends, save(mates.unionByName(met), "mates"), save(_walks(chains, met), "roots"))
    loose = ends.withColumn("dart", _dart()).join(mates, "dart", "left_anti").select("arc_id")
    bad = loose.union(hung.select("arc_id")).distinct().withColumn("bad", F.lit(1))
    self_ = own.select(F.explode(F.array(*[F.struct((F.col("arc_id") * 2 + s).alias("dart"), (F.col("arc_id") * 2 + 1 - s).alias("mate")) for s in (0, 1)])).alias("m")).select("m.*")
    # within a chain taken off, the nodes that joined it
    gone = every.join(hung, "arc_id").withColumn("dart", _dart()).groupBy("chain", "node").agg(F.count("*").alias("n"), F.min("dart").alias("a"), F.max("dart").alias("b")).where("n = 2")
    gone = gone.select(F.explode(F.array(F.struct(F.col("a").alias("dart"), F.col("b").alias("mate")), F.struct(F.col("b").alias("dart"), F.col("a").alias("mate")))).alias("m")).select("m.*")
    mates = mates.unionByName(self_).unionByName(gone)
    r = roots.unionByName(own.select("arc_id", F.col("arc_id").alias("root"))).unionByName(hung.select("arc_id", F.col("chain").alias("root")))
    r = r.withColumnRenamed("root", "ring").join(bad, "arc_id", "left").join(arcs.select("arc_id", F.size("geometry").alias("n")), "arc_id")
    r = save(r, "rings")
    size = r.groupBy("ring").agg((F.sum(F.col("n") - 1) + 1).alias("points"), F.max("bad").alias("bad"))
    size = size.select("ring", "points", (F.col("bad").isNull() & (F.col("points") >= 4)).alias("closed"))
    return lookup(r.select("arc_id", "ring"), "ring", size, r.count()), every.select("arc_id", "side", _dart().alias("dart"), "node").join(mates, "dart", "left")


def chain_rings(arcs: DataFrame, tol: float = 1e-7) -> DataFrame:
    """Per arc of ``assemble``: ``ring`` (smallest arc of its chain), the number of points of the chain and ``closed``: no end is loose
    and the ring has at least four points. Arcs of fewer than two points are left out."""
    return assemble(arcs, tol)[0]


def ring_points(arcs: DataFrame, rings: DataFrame, mates: DataFrame) -> DataFrame:
    """The points of each ring in order, ``(ring, closed, seq, lat, lon)``, of what ``assemble`` gave for ``arcs``.

    A ring starts at its southernmost (then westernmost) node, runs counterclockwise and ends with its first point; an open chain starts at the
    first of its two ends in that order. Arcs are placed by list ranking over both directions of each ring: rounds follow
    the logarithm of its arcs, and no ring is gathered in one task."""
    roots = save(rings.select("arc_id", F.col("ring").alias("root"), "closed"), "placed")
    ends = mates.select("arc_id", "side", "node")
    join_ = mates.where("mate IS NOT NULL").select("dart", "mate")
    loose = save(_open(ends, join_, roots), "open")
    start = ends.join(roots, "arc_id").join(loose, "root", "left_anti").groupBy("root").agg(F.min("node").alias("start"))
    sizes = arcs.where(F.size("geometry") >= 2).select("arc_id", (F.size("geometry") - 1).alias("w"))
    lists = save(_walk_lists(ends, join_, roots.drop("closed"), start, sizes), "lists")
    signed = lists.join(_area(arcs), "arc_id").withColumn("area", F.when(F.col("side") == 0, F.col("area")).otherwise(-F.col("area")))
    part = signed.groupBy("root", "last").agg(F.max("w").alias("total"), F.sum("area").alias("area"), F.max_by("node", "w").alias("first"))
    part = part.join(roots.select("root", "closed").distinct(), "root").join(loose.withColumn("open", F.lit(1)), "root", "left")
    turn = F.struct(F.when(F.col("open") == 1, F.col("first").cast("double")).otherwise(-F.col("area")).alias("t"), "last")
    part = part.groupBy("root").agg(F.min_by(F.struct("last", "total", "closed"), turn).alias("p")).select(F.col("root").alias("ring"), "p.*")
    placed = lists.select("arc_id", "side", "last", "w").join(part, "last").join(arcs.select("arc_id", "geometry"), "arc_id")
    g = F.when(F.col("side") == 0, F.col("geometry")).otherwise(F.reverse("geometry"))
    at = F.col("total") - F.col("w")
    own = placed.select("ring", "closed", at.alias("at"), "total", g.alias("g"), F.size(g).alias("n"))
    pts = own.select("ring", "closed", "at", "total", "n", F.posexplode("g").alias("i", "p"))
    pts = pts.where((F.col("i") < F.col("n") - 1) | (F.col("at") + F.col("n") - 1 == F.col("total")))
    return pts.select("ring", "closed", (F.col("at") + F.col("i")).alias("seq"), F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))


def project(points: DataFrame, cal: dict, tile: int, scale: float) -> DataFrame:
    """lat/lon -> canvas pixels ``px, py`` by an equirectangular offset and a 3 x 2 affine map. ``cal`` holds the
    calibration's numbers or columns: a00…a21, clat, clng, mlat, mlng, col0, row0."""
    c = {k: v if not isinstance(v, (int, float)) else F.lit(float(v)) for k, v in cal.items()}
    e = (F.col("lon") - c["clng"]) * c["mlng"]
    n = (F.col("lat") - c["clat"]) * c["mlat"]
    k = F.lit(tile * scale)
    return points.select(
        "*",
        ((e * c["a00"] + n * c["a10"] + c["a20"] - c["col0"]) * k).alias("px"),
        ((e * c["a01"] + n * c["a11"] + c["a21"] - c["row0"]) * k).alias("py"),
    )


def segments(points: DataFrame, line: Sequence[str], seq: str = "seq") -> DataFrame:
    """Consecutive points of each line as edges ``(x0, y0, x1, y1)``. A line is one feature's geometry, which the
    source holds in one row anyway."""
    w = W.partitionBy(*line).orderBy(seq)
    rest = [c for c in points.columns if c not in ("px", "py", seq)]
    s = points.select(*rest, F.col("px").alias("x0"), F.col("py").alias("y0"), F.lead("px").over(w).alias("x1"), F.lead("py").over(w).alias("y1"))
    return s.where("x1 IS NOT NULL")


def rasterise(edges: DataFrame, ring: str, w: int, h: int, by: Sequence[str] = (), block: int = R.BLOCK) -> DataFrame:
    """Runs of the pixels whose centre lies in some ring (even-odd rule per ring, union of all rings).

    Needs only the edges of closed rings, in any order: every edge marks the scanlines it crosses, and the
    crossings of one ring on one scanline pair up from left to right."""
    by = list(by)
    lo, hi = F.least("y0", "y1"), F.greatest("y0", "y1")
    first = F.greatest(F.ceil(lo - F.lit(0.5)), F.lit(0))
    last = F.least(F.ceil(hi - F.lit(0.5)) - 1, F.lit(h - 1))
    e = edges.withColumn("first", first).withColumn("last", last).where("first <= last")
    e = e.withColumn("y", F.explode(F.sequence("first", "last")))
    # from the lower to the upper end, so that an edge gives the same crossing in both directions
    up = F.col("y0") <= F.col("y1")
    xa, ya = F.when(up, F.col("x0")).otherwise(F.col("x1")), lo
    xb, yb = F.when(up, F.col("x1")).otherwise(F.col("x0")), hi
    cross = xa + (F.col("y") + F.lit(0.5) - ya) * (xb - xa) / (yb - ya)
    c = e.select(*by, ring, "y", cross.alias("cx"))
    win = W.partitionBy(*by, ring, "y").orderBy("cx")
    c = c.select("*", F.row_number().over(win).alias("rn"), F.lead("cx").over(win).alias("nx")).where("rn % 2 = 1 AND nx IS NOT NULL")
    spans = c.select(
        *by, "y",
        F.greatest(F.ceil(F.col("cx") - F.lit(0.5)), F.lit(0)).alias("x0"),
        F.least(F.ceil(F.col("nx") - F.lit(0.5)) - 1, F.lit(w - 1)).alias("x1"),
    )
    return R.merge(spans.where("x0 <= x1").distinct(), by, block)
