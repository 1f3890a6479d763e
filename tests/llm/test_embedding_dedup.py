import math

import numpy as np
import pytest
from llm_helpers import components

from spoolwire.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, node long, codes string"


def hard_rows():
    rng = np.random.default_rng(6)
    rows = []
    for i in range(240):
        if i % 4 == 0 or i < 20:
            v = rng.standard_normal(32)
        else:
            v = np.array(rows[int(rng.integers(0, i))][1]) + rng.standard_normal(32) * rng.choice([0, 0.05, 0.15, 0.25])
        rows.append((i, [float(x) for x in v], int(i % 2)))
    tail = rows[5][1]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 32, 0), (303, [math.nan] + tail[1:], 1), (304, [None] + tail[1:], 1), (305, [math.inf] * 32, 1)]
    rows += [(306, tail, None), (307, tail, 1), (308, tail, 1), (309, [x * 1e-30 for x in tail], 1), (310, [x * 1e30 for x in tail], 1), (311, [-x for x in tail], 1), (312, tail[:5], 1), (None, tail, 1)]
    return [(*r, 1, "c") for r in rows]


def brute(rows):
    usable = {}
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.asarray(np.asarray(v, np.float32), np.float64)
            if np.abs(x).max() > 0:
                x = x / np.abs(x).max()
                usable[i] = (label, x / np.sqrt((x * x).sum()))
    links = [(a, b) for a in usable for b in usable if a != b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= E.COSINE]
    return {i: sum(a == i for a, _ in links) for i, *_ in rows}, components([r[0] for r in rows if r[0] is not None], links)


@pytest.mark.parametrize("block", [1500, 9])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "_ROWS", 5)
    rows = hard_rows()
    n_links, comps = brute(rows)
    got = E.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["vec_id"] is None:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, None, False)
            continue
        assert (r["n_links"], r["component_id"], r["kept"]) == (n_links[r["vec_id"]], comps[r["vec_id"]], comps[r["vec_id"]] == r["vec_id"])


def test_plan_grows_slowly_and_keeps_recall():
    for rows in (10, 10_000, 10**7, 10**10):
        k, tables = E.plan(rows)
        near = E._meet(math.sqrt(2 - 2 * E.COSINE), E.STEP_WIDTH)
        assert (1 - near**k) ** tables <= E.MISS
        assert E._meet(math.sqrt(2), E.STEP_WIDTH) ** k * rows <= 1.01 or k == 4
    assert E.plan(10**10)[1] < 400


def test_empty(spark):
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
