"""Registered SQL against the queries, and the pipeline against its brute-force stages."""

import hashlib
import os
import sys
import zlib

import numpy as np
import pytest
from llm_helpers import alnum_words, components, shingle_set, spaced_words

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from tools.oracle_check import TABLES, canon  # noqa: E402

from spoolwire.llm import mixing, pii, token_output  # noqa: E402
from spoolwire.llm.catalog import ORACLE, QUERIES  # noqa: E402
from spoolwire.llm.common import materialize  # noqa: E402
from spoolwire.llm.token_units import load  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert sorted(canon(df.columns, map(tuple, df.collect())), key=repr) == sorted(canon(cols, cur.fetchall()), key=repr)


def test_every_operator_is_registered():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op1_license_scan", "op4_language_id", "op5_pii", "op7_token_output", "op12_quality"])
def test_whole_table(spark, name):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = QUERIES[name](spark, SF).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    if name == "op5_pii":
        for r in out:
            base = pii.base_spans(texts[r["doc_id"]])
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == i for s in base) for i in range(len(pii.KINDS))]
            said = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
            assert r["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
            assert set(filter(None, said.split(","))) <= set(r["spans"].split(","))
    if name == "op7_token_output":
        tok, start = load(token_output.default_tokenizer()), 0
        for r in sorted(out):
            ids = np.array([*tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
            assert tuple(r) == (r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes()))
            start += len(ids)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(materialize(stage(spark, seen[-1], SF), name))
    assert all(d.columns == docs.columns for d in seen[:-1])
    raw, lang, one, clean, mix = ({r["doc_id"]: r for r in d.collect()} for d in seen[:-1])
    # language: what has letters stays
    assert set(lang) == {i for i, r in raw.items() if r["text"] and any(c.isalpha() for c in r["text"])}
    # near-duplicates: the smallest id of each component
    sets = {i: shingle_set(spaced_words(r["text"])) for i, r in lang.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert set(one) == set(components(list(sets), links).values())
    # benchmark: no window of an item is left, other documents are as they were
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = alnum_words(r["text"])
        grams |= {tuple(w[i : i + 10]) for i in range(len(w) - 9)}
    hit = lambda t: any(tuple(w[i : i + 10]) in grams for w in [alnum_words(t)] for i in range(len(w) - 9))
    dirty = {i for i, r in one.items() if hit(r["text"])}
    assert dirty and not any(hit(r["text"]) for r in clean.values())
    assert all(clean[i] == r for i, r in one.items() if i not in dirty)
    # mix: targets met
    size = sum(len(spaced_words(r["text"])) for r in clean.values())
    taken = sum(len(spaced_words(r["text"])) for r in seen[4].collect())
    assert abs(taken - mixing.SHARE * size) <= len({r["source"] for r in clean.values()})
    # token ids: each row of the mix, read back
    tok = load(token_output.default_tokenizer())
    want = sorted((r["doc_id"], zlib.crc32(np.array([*tok.encode(r["text"]).ids, 0], "<u4").tobytes())) for r in seen[4].collect())
    assert sorted((r["doc_id"], r["ids_crc32"]) for r in seen[5].collect()) == want
