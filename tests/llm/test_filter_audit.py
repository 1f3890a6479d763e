import random
import re
from itertools import permutations

import numpy as np
import pytest
from llm_helpers import docs_table
from pyspark.sql import functions as F

from spoolwire.llm import filter_audit


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 100 else ""
    out += "B" if 100 * len(set(words)) < 80 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 10 * len(text) else ""
    return out + ("D" if re.search(r"[#$%&*|]", text) else "")


def brute(rows, labels):
    """Every order applied to every document, one filter after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, t, _, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = [(i, v or "", fails(t or "") + ("E" if i is not None and first[t or ""] < i else "")) for i, t, v, _ in rows]
    out = {}
    for part in {v for _, v, _ in docs}:
        mine = [(i, f) for i, v, f in docs if v == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = mine
            for s, k in enumerate(order):
                gone = [(i, f) for i, f in alive if k in f]
                dead = [f for _, f in mine if k in f and set(order[:s]) & set(f)]
                alive = [(i, f) for i, f in alive if k not in f]
                total[k] += len(gone)
                out[part, "".join(order), s + 1] = [
                    len(alive), len(gone), len(dead), sum(f == k for _, f in mine),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), k,
                ]
        for key, v in out.items():
            if key[0] == part:
                v[-1] = total[key[1][key[2] - 1]]
    return out


def hard_rows():
    rng = random.Random(3)
    long = [" ".join(f"w{rng.randrange(k)}" for _ in range(120)) for k in (5000, 30, 5000)]
    texts = ["", None, " \t\n", "a", "ABC", "x # y", *long, long[0].upper(), long[2] + " $", "é " * 130, "Über " * 20_000]
    out = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""]), "s") for i in range(200)]
    # repeated rows, one id with two texts, rows without an id, a group of copies
    out += [(7, "a b", "en", "s")] * 2 + [(7, long[0], "en", "s"), (3, long[0], "en", "s"), (None, long[0], "en", "s"), (None, None, None, None)]
    return out + [(1000 + i, "copy # of one", "fr", "s") for i in range(300)]


def test_against_every_order(spark):
    rows = hard_rows()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 1200, 2)] + [(4, 1, 1), (4, 0, None), (7, 1, 1), (None, 1, 1), (9, None, 1)]
    said = spark.createDataFrame([(*r, "x") for r in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.audit(filter_audit.document_masks(docs_table(spark, rows), said)).collect()
    counts = (*filter_audit.OUTCOMES, "shapley")
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in counts] for r in got} == brute(rows, labels)
    assert len(got) == 600 * 4


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.document_masks(docs_table(spark, []), labels)).count() == 0
    got = filter_audit.audit(filter_audit.document_masks(docs_table(spark, [(1, None, None, None)]), labels)).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {""} and {r["good_lost"] for r in got} == {0}


def test_fields_do_not_run_into_each_other(spark):
    weight = (1 << 62) - 1
    masks = spark.createDataFrame([("p", 0b1101, weight), ("p", 0b1101, weight), ("p", 0, 5)], "part string, mask int, weight long")
    got = {(r["filter_order"], r["step"]): r for r in filter_audit.audit(masks, "AB").collect()}
    assert len(got) == 4
    r = got["AB", 1]
    assert (r["kept"], r["removed"], r["good_lost"], r["toxic_lost"], r["unique_fails"]) == (5, 2 * weight, 2 * weight, 2 * weight, 2 * weight)
    assert got["AB", 2]["kept"] == 5 and got["AB", 2]["removed"] == 0


def test_many_parts_are_flushed_and_merged(spark, monkeypatch):
    masks = spark.range(0, 20_000, numPartitions=7).select(
        F.concat(F.lit("p"), F.col("id") % 1500).alias("part"), (F.col("id") % 16).cast("int").alias("mask"), F.lit(1).alias("weight")
    )
    got = filter_audit.audit(masks, "AB").where("step = 1 and filter_order = 'AB'").select("part", (F.col("kept") + F.col("removed")).alias("n"))
    n = {r["part"]: r["n"] for r in got.collect()}
    assert len(n) == 1500 and sum(n.values()) == 20_000


def test_outcome_fields():
    out = filter_audit.outcomes("ABC")
    assert out.shape == (32, 18, 6)
    assert (out[..., :3].sum(axis=2) <= 1).all()
    assert np.array_equal(out[0, :, 0], np.ones(18))
    with pytest.raises(ValueError):
        filter_audit.audit(None, "AA")
