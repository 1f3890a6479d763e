import math

from llm_helpers import docs_table, spaced_words
from pyspark.sql import functions as F

from spoolwire.llm import mixing


def water_fill(sizes, share=1.5, most=2.0):
    names = sorted((n for n in sizes if n is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {n: (3.0, 1.0, 2.0)[i % 3] for i, n in enumerate(names)}
    capped = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[n] for n in capped)
        open_ = [n for n in names if n not in capped]
        level = left / sum(weight[n] for n in open_) if open_ else 0
        over = [n for n in open_ if weight[n] * level > most * sizes[n] + 1e-9]
        if not over:
            return {n: most * sizes[n] if n in capped else weight[n] * level for n in names}
        capped |= set(over)


def rows():
    out = [(i, " ".join(["w"] * (i % 9)), "en", ["big", "b", "c", None][min(3, i % 7)]) for i in range(300)]
    return out + [(300, None, "en", "big"), (301, "", None, None), (5, "a b", "en", "big"), (5, "a b", "en", "big"), (None, "x y z", "en", "b"), (302, "v " * 50_000, "en", "long")]


def test_targets_and_prefix_sums(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    docs = docs_table(spark, rows()).withColumn("size", mixing.word_count(F.col("text")))
    got = mixing.assign(docs.select("doc_id", "source", "size"), ["doc_id"]).withColumn("taken", mixing.taken()).collect()
    assert len(got) == len(rows())
    sizes = {}
    for _, t, _, s in rows():
        sizes[s] = sizes.get(s, 0) + len(spaced_words(t))
    want = water_fill(sizes)
    for s, size in sizes.items():
        mine = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == size and math.isclose(r["target"], want[s]) for r in mine)
        assert sum(r["taken"] for r in mine) == math.floor(mine[0]["target"])
        place = 0
        for r in sorted(mine, key=lambda r: (r["before"], r["size"])):
            assert r["before"] == place  # each row starts where the one before ends
            place += r["size"]
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)


def test_mix_rows_and_reruns(spark):
    docs = docs_table(spark, rows())
    once, again = (sorted(map(repr, mixing.mix(docs).collect())) for _ in range(2))
    assert once == again
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = sum(len(spaced_words(r["text"])) for r in mixed.collect())
    total = sum(len(spaced_words(t)) for _, t, *_ in rows())
    assert abs(words - 1.5 * total) <= 5  # one word per source at most
    assert all(r["n_chars"] == len(r["text"]) and r["row"] == "r" for r in mixed.collect())


def test_first_words_keeps_white_space(spark):
    df = spark.createDataFrame([("a  b\n\nc d", 3), ("\t lead x", 1), ("one", 1)], "t string, n long")
    assert [r[0] for r in df.select(mixing.first_words(F.col("t"), F.col("n"))).collect()] == ["a  b\n\nc", "lead", "one"]


def test_empty(spark):
    assert mixing.mix(docs_table(spark, [])).count() == 0
