"""The pipeline on tables with repeated ids, nulls, clashing columns, and nothing at all."""

import os
import sys

import pytest
from llm_helpers import docs_table
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

from spoolwire.llm.common import materialize  # noqa: E402
from spoolwire.workspace import scratch_path  # noqa: E402


def text(i, n=30):
    return " ".join(f"{w}{'abcdefgh'[i % 8]}{'abcdefghij'[i // 8 % 10]}" for w in ("the house and a garden of some words which we read again in the morning" * 3).split()[:n])


def put(spark, rows, bench):
    folder = scratch_path(spark, "sf")
    docs_table(spark, rows).withColumn("kept", F.lit(1)).withColumn("size", F.lit("x")).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(bench, "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


ROWS = [(i, text(i), "en" if i % 2 else "de", ["a", "b", None][i % 3]) for i in range(60)]
ROWS += [(3, text(70), "en", "a"), (3, text(71), "en", "a"), (4, text(4), "de", "b"), (None, text(72), None, None), (None, None, None, None)]
ROWS += [(100, None, "en", "a"), (101, "", "en", "a"), (102, " 12 34 ", "en", "a"), (103, text(5), "en", "b"), (104, text(6) + " " + text(73), None, None)]


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], folder), name))
    return seen


def test_no_text_is_lost_but_copies_and_texts_without_a_letter(spark):
    folder = put(spark, ROWS, [("q", text(8)), ("r", None), (None, "x")])
    raw, lang, one, clean, mix, ids = stages(spark, folder)
    assert all(d.columns == raw.columns for d in (lang, one, clean, mix))
    with_letters = {r[1] for r in ROWS if r[1] and any(c.isalpha() for c in r[1])}
    assert {r["text"] for r in lang.collect()} == with_letters
    kept = [(r["doc_id"], r["text"]) for r in one.collect()]
    # three texts under id 3 stay, of exact copies one; a row without an id stays
    assert {t for _, t in kept} == with_letters
    assert sorted((i for i, _ in kept if i is not None)) == sorted([*range(60), 3, 3, 104])
    assert (None, text(72)) in kept
    assert {r["text"] for r in clean.collect()} == with_letters - {text(8)}
    out = ids.collect()
    assert len(out) == mix.count() and sum(r["n_tokens"] for r in out) == max(r["start"] + r["n_tokens"] for r in out)
    again = corpus_pipeline.run(spark, folder).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


@pytest.mark.parametrize("rows", [[], [(1, None, None, None)], [(1, "7", "en", "a"), (1, "", None, None)]])
def test_tables_without_text(spark, rows):
    folder = put(spark, rows, [])
    assert corpus_pipeline.run(spark, folder).count() == 0
