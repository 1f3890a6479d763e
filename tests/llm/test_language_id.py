import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import docs_table

from spoolwire.llm import language_id as L
from spoolwire.llm.common import utf8

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return L.fit(docs.where(~L.held_out()))


def test_held_out_accuracy(docs, model):
    got = L.identify(docs.where(L.held_out()), model, keep=("doc_id", "lang")).select("row.lang", "lang_pred", "score").collect()
    assert len(got) > 250
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_pooling_equals_single_positions(model):
    texts = ["Le chat est là. " * 9, "", "x", "über " * 200]
    pooled = model.probabilities(*utf8(pa.array(texts)))
    for text, p in zip(texts, pooled, strict=True):
        raw = text.encode()
        total = np.zeros(len(model.langs))
        for lo in range(0, len(raw), L.WINDOW):
            x = np.full((L.WINDOW, 1), L.PAD, np.intp)
            part = np.frombuffer(raw[lo : lo + L.WINDOW], np.uint8)
            x[: len(part), 0] = part
            total += model.positions(x)[: len(part), :, 0].sum(axis=0)
        assert np.allclose(p, total / max(1, len(raw)), atol=1e-5)


def test_hard_cases(spark, model):
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "12 + 3 !?", None, "s"), (4, "the of and with from", None, None), (4, "the of and with from", None, None), (None, "the of and " * 90_000, "en", "s")]
    out = L.identify(docs_table(spark, rows), model, keep=("doc_id", "lang_pred", "row", "text")).collect()
    by = {}
    for r in out:
        by.setdefault(r["row"]["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert by[1] == by[2] == by[3] == [("und", 0.0)]
    assert len(by[4]) == 2 and by[4][0] == by[4][1] and by[4][0][0] == "en" and by[None][0][0] == "en"
    assert L.identify(docs_table(spark, []), model).count() == 0


def test_nothing_to_learn(spark):
    docs = docs_table(spark, [(1, "some words", None, "s"), (2, None, "en", "s")])
    out = L.identify(docs, L.fit(docs)).collect()
    assert [(r["lang_pred"], r["score"]) for r in out] == [("und", 0.0)] * 2


def test_seventy_languages_are_learned(spark):
    """Languages of a letter of their own each, some frequent and most rare: none is left out."""
    names = [f"l{i:02}" for i in range(70)]
    letters = [chr(0x0430 + i) if i < 32 else chr(0x4E00 + 37 * i) for i in range(70)]
    rows = [(i, " ".join([letters[k] * (2 + i % 3)] * 8), names[k], "s") for i, k in enumerate(k for k in range(70) for _ in range(300 if k < 5 else 60))]
    model = L.fit(docs_table(spark, rows))
    assert model.langs == names
    fresh = docs_table(spark, [(k, " ".join([letters[k] * 3] * 9), None, "s") for k in range(70)])
    found = {r["row"]["doc_id"]: r["lang_pred"] for r in L.identify(fresh, model).collect()}
    assert sum(found[k] == names[k] for k in range(70)) >= 60
    assert len(set(found.values())) >= 60
