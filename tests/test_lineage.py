import random

import pytest
from conftest import rows

from locusframe.operators import lineage

EDGES = "src long, dst long"


def brute_core(edges):
    left = set(edges)
    while True:
        sources, targets = {a for a, _ in left}, {b for _, b in left}
        kept = {(a, b) for a, b in left if a in targets and b in sources}
        if kept == left:
            return sorted(kept)
        left = kept


def brute_ancestors(edges, start):
    steps, frontier = {s: 0 for s in start}, set(start)
    while frontier:
        frontier = {b for a, b in edges if a in frontier} - set(steps)
        steps.update(dict.fromkeys(frontier, max(steps.values()) + 1))
    return sorted(steps.items())


@pytest.mark.parametrize("most_jumps", [0, 4])
def test_graph_loops_against_brute_force(spark, monkeypatch, most_jumps):
    """Sparse, dense, cyclic and empty graphs, with jumps and step by step."""
    monkeypatch.setattr(lineage, "MOST_JUMPS", most_jumps)
    draw = random.Random(2)
    graphs = [[], [(1, 1)], [(1, 2), (2, 3), (3, 1), (3, 4), (0, 1), (4, 5)], [(i, i + 1) for i in range(12)]]
    graphs += [[(draw.randrange(n), draw.randrange(n)) for _ in range(m)] for n, m in ((8, 6), (8, 30), (30, 32))]
    for edges in graphs[most_jumps and 2 :]:
        table = spark.createDataFrame(edges, EDGES)
        assert rows(lineage.cyclic_core(table), "src", "dst") == brute_core(edges)
        start = spark.createDataFrame([(0,), (3,)], "node long")
        assert rows(lineage.ancestors(table, start), "node", "steps") == brute_ancestors(edges, [0, 3])


def test_a_long_chain_takes_a_logarithm_of_rounds(spark, monkeypatch):
    calls = []
    real = lineage.reliable_checkpoint
    monkeypatch.setattr(lineage, "reliable_checkpoint", lambda df: calls.append(1) or real(df))
    chain = spark.range(100_000).selectExpr("id as src", "id + 1 as dst")
    got = lineage.ancestors(chain, spark.createDataFrame([(0,)], "node long"))
    assert got.selectExpr("count(*)", "max(steps)", "sum(node - steps)").first() == (100_001, 100_000, 0)
    assert len(calls) <= 2 * 18 + 1
    calls.clear()
    assert lineage.cyclic_core(chain).isEmpty() and len(calls) <= 20


def test_plans_and_rounds_of_graph_loops_stay_small(spark, monkeypatch):
    """The guessed size of a loop's plan does not grow by its rounds, and a cycle costs no rounds of its own."""
    calls = []
    real = lineage._written
    monkeypatch.setattr(lineage, "_written", lambda df: calls.append(1) or real(df))
    tail = spark.range(3, 3_000).selectExpr("id as src", "id - 1 as dst")
    cycle = spark.createDataFrame([(2, 1), (1, 0), (0, 2)], EDGES)
    jumps = lineage._Jumps(tail)
    while jumps.double():
        pass
    assert len(calls) <= 13 and jumps.pairs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length() < 64
    calls.clear()
    assert rows(lineage.cyclic_core(tail.unionByName(cycle)), "src", "dst") == [(0, 2), (1, 0), (2, 1)] and len(calls) <= 14
    calls.clear()
    short = spark.range(3, 3_000).selectExpr("id as src", "id % 3 as dst").unionByName(cycle)
    assert rows(lineage.cyclic_core(short), "src", "dst") == [(0, 2), (1, 0), (2, 1)] and len(calls) <= 3
    calls.clear()
    got = lineage.ancestors(tail, spark.createDataFrame([(2_999,)], "node long"))
    assert got.selectExpr("count(*)", "max(steps)").first() == (2_998, 2_997) and len(calls) <= 2 * 13 + 1


def test_hand_overs_that_labels_lack(spark):
    edges = spark.createDataFrame([("A", "x", "B", "x"), ("A", "y", "C", "y")], "from_process string, from_file string, to_process string, to_file string")
    art = [("A", "one", "output", "x", "h", 1), ("B", "one", "input", "x", "h", 1), ("A", "one", "output", "y", "h", 1), ("C", "one", "input", "y", "g", 1)]
    art += [("A", "two", "output", "x", "h", 1), ("Z", "three", "output", "q", "h", 1)]
    got = lineage.broken_edges(spark.createDataFrame(art, "process string, label string, side string, file string, sha256 string, bytes long"), edges)
    want = [("one", "y", "identity"), ("three", "x", "output_count"), ("three", "y", "output_count"), ("two", "x", "input_count"), ("two", "y", "output_count")]
    assert rows(got, "label", "from_file", "rule") == want


def test_inputs_of_callers(spark):
    seen = spark.createDataFrame([("h1", "a"), ("h1", "b"), ("h1", "b"), ("h2", "a"), ("h9", "a"), ("h1", "z")], "sha256 string, caller string")
    accepted = spark.createDataFrame([("h1",), ("h2",), ("h3",)], "sha256 string")
    callers = spark.createDataFrame([("a",), ("b",)], "caller string")
    want = [("a", "h3", "not_read"), ("a", "h9", "not_accepted"), ("b", "h2", "not_read"), ("b", "h3", "not_read"), ("z", "h1", "not_accepted")]
    assert rows(lineage.asymmetric_inputs(seen, accepted, callers), "caller", "sha256", "rule") == want
