"""Chains of arcs are found once; what grows together or meets is labelled by whole chains."""

from tessella.operators import vector as V


def test_chains_are_labelled_once(spark, monkeypatch):
    """A square of 40 arcs with one hanging arc: its chain stays a whole when the arc goes, without a second pass over all darts."""
    side = [(0, i) for i in range(10)] + [(i, 10) for i in range(10)] + [(10, 10 - i) for i in range(10)] + [(10 - i, 0) for i in range(10)]
    pieces = [[side[i], side[(i + 1) % 40]] for i in range(40)] + [[(0, 0), (-1, -1)]]
    arcs = spark.createDataFrame([(i, [(float(a), float(b)) for a, b in g]) for i, g in enumerate(pieces, 1)], "arc_id long, geometry array<struct<lat:double,lon:double>>")
    rows, plain = [], V._labels

    def counted(arcs, mates):
        rows.append(arcs.count())
        return plain(arcs, mates)

    monkeypatch.setattr(V, "_labels", counted)
    got = {(r.arc_id, r.ring, r.points, r.closed) for r in V.chain_rings(arcs).collect()}
    assert got == {(i, 1, 41, True) for i in range(1, 41)} | {(41, 41, 2, False)}
    assert rows == [41], rows


def test_walks_join_whole_chains(spark):
    """Chain 1 (arcs 1, 2) meets chain 5 at both ends, given twice; chain 9 meets nothing."""
    chains = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (9, 9)], "arc_id long, chain long")
    met = spark.createDataFrame([(2, 10), (10, 2), (5, 11), (11, 5)] * 2, "dart long, mate long")
    assert {(r.arc_id, r.root) for r in V._walks(chains, met).collect()} == {(1, 1), (2, 1), (5, 1), (9, 9)}
