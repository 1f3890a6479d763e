import random

from llm_helpers import alnum_words, docs_table

from spoolwire.llm import license_scan as L
from spoolwire.llm.licenses import TEMPLATES


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else ([tuple(words)] if words else [])


def brute(text, templates):
    doc, out = shingles(alnum_words(text)), set()
    for name, t in templates.items():
        want = set(shingles(alnum_words(t)))
        step = 1 << L.level_of(len(want))
        for i in range(0, len(doc), step):
            if want and len(want & set(doc[i : i + 5 * step])) >= 0.8 * len(want) - 1e-12:
                out.add(name)
                break
    return out


def test_against_every_window(spark, monkeypatch):
    rng = random.Random(3)
    templates = {**TEMPLATES, "none": "", "three-words": "all rights reserved"}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    rows = []
    for i, r in enumerate(docs):
        words = (r["text"] or "").split(" ")
        if i % 2 == 0:
            lic = templates[rng.choice(list(TEMPLATES))].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                lic[rng.randrange(len(lic))] = "xx"
            at = rng.randint(0, len(words))
            words[at:at] = lic
        rows.append((i, " ".join(words), "en", "s"))
    rows += [(900, None, "en", "s"), (901, "", None, "s"), (902, "All RIGHTS reserved!", "en", None), (902, "all rights reserved", "en", "s"), (None, TEMPLATES["mit"] + " x" * 100_000 + TEMPLATES["isc"], "en", "s")]
    for size in (1 << 20, 100):  # one block of templates, and several
        monkeypatch.setattr(L, "BLOCK_WORDS", size)
        got = L.scan_licenses(docs_table(spark, rows), templates, keep=("doc_id", "text", "row")).collect()
        assert len(got) == len(rows)
        for r in got:
            assert {m["license"] for m in r["matches"]} == brute(r["text"], templates), r["row"]
    long = next(r for r in got if r["row"]["doc_id"] is None)
    n = len(alnum_words(TEMPLATES["mit"]))
    assert ("mit", 0, n) in [(m["license"], m["first_word"], m["end_word"]) for m in long["matches"]]
    assert L.scan_licenses(docs_table(spark, []), templates).count() == 0


def test_bands_bound_the_miss_rate():
    for m in range(1, 400):
        assert (1 - L.floor_similarity(m)) ** L.bands_for([m]) <= L.MISS


def test_catalogue_holds_whole_texts(spark):
    for name in ("apache-2.0", "bsd-2-clause", "bsd-3-clause", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "mpl-2.0", "cc-by-sa-4.0", "cc0-1.0", "unlicense"):
        assert name in TEMPLATES
    assert "END OF TERMS AND CONDITIONS" in TEMPLATES["apache-2.0"] and "THE SOFTWARE IS PROVIDED" in TEMPLATES["unlicense"]
    rows = [(i, "words before " + TEMPLATES[name] + " and behind", "en", "s") for i, name in enumerate(sorted(TEMPLATES))]
    rows.append((-1, "This program is free software: you can redistribute it", "en", "s"))
    got = {r["row"]["doc_id"]: {m["license"] for m in r["matches"]} for r in L.scan_licenses(docs_table(spark, rows)).collect()}
    assert all(name in got[i] for i, name in enumerate(sorted(TEMPLATES)))
    assert got[-1] == set()
