"""Components of hand-made graphs, and the tables that finding them writes."""

import random

from tagtable.llm import components as module


def smallest_reachable(edges):
    known = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(known[a], known[b])
            changed |= known[a] != low or known[b] != low
            known[a] = known[b] = low
    return known


def found(spark, edges, monkeypatch):
    """The components, and how many tables were written."""
    written = []
    saved = module.saved
    with monkeypatch.context() as patch:
        patch.setattr(module, "saved", lambda frame: written.append(1) or saved(frame))
        rows = module.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r.id for r in rows})
    return {r.id: r.comp for r in rows}, len(written)


def test_stars_take_no_round(spark, monkeypatch):
    edges = [(1, v) for v in range(2, 30)] + [(v, 40) for v in range(41, 50)] + [(5, 1)]
    comps, written = found(spark, edges, monkeypatch)
    assert comps == smallest_reachable(edges)
    assert written == 1


def test_no_edges_and_loops(spark, monkeypatch):
    assert found(spark, [(3, 3)], monkeypatch) == ({}, 1)


def test_paths_and_random_graphs(spark, monkeypatch):
    dice = random.Random(3)
    path = [(v, v + 1) for v in range(40)]
    mixed = [(100 + dice.randrange(60), 100 + dice.randrange(60)) for _ in range(45)]
    edges = path + [(a, b) for a, b in mixed if a != b]
    dice.shuffle(edges)
    comps, _ = found(spark, edges, monkeypatch)
    assert comps == smallest_reachable(edges)
