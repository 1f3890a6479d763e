import random

from llm_helpers import components as brute

from spoolwire.llm.components import components


def test_random_chains_and_stars(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(201, 240)]
    edges += [(rng.randrange(300, 500), rng.randrange(300, 500)) for _ in range(150)] + [(5, 5), (7, 6), (7, 6)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges + [(None, 3)], "u long, v long")).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == brute(nodes, [e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
