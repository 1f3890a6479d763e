import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import docs_table

from spoolwire.llm import pii
from spoolwire.llm.common import utf8

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, m.start(), m.end()))
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def test_base_patterns():
    rng = random.Random(2)
    parts = ["1", "2", "25", "4", "0", "0000000", "4111111111111111", " ", "-", ".", "..", "@", "a", "b.c", "+", "(", ")", "é", "\n"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii.base_spans(t) == brute(t), t
    assert pii.base_spans("a" * 200_000 + "1" * 200_000 + "." * 1000) == brute("")  # no quadratic scan


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_held_out_recall_and_clean_text(model, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id between 400 and 700").collect()
    hit = total = wrong = 0
    for text, spans in pii.examples([r["text"] for r in docs if r["text"]], seed=77):
        sym, bounds = pii.symbols(*utf8(pa.array([text])))
        base = pii.base_spans(text)
        found = base + pii.added_spans(text, model.labels(sym, bounds), base)
        whole = [s for s in spans if s[2] < pii.WINDOW]
        total += len(whole)
        hit += sum(any(p[0] == s[0] and p[1] <= s[1] + 1 and p[2] >= s[2] - 1 for p in found) for s in whole)
        wrong += sum(not any(p[1] < s[2] and s[1] < p[2] for s in spans) for p in found if p not in base)
    assert hit / total >= 0.6
    assert wrong <= 0.01 * total


def test_windows_cover_every_character(model, monkeypatch):
    def marks(emit, trans):  # a decoder that labels digits
        return marks.x

    def emissions(self, x, tapes=(None, None)):
        marks.x = ((x >= 48) & (x < 58)).astype(np.uint8)
        return None, None

    monkeypatch.setattr(pii.crf, "decode", marks)
    monkeypatch.setattr(pii.PiiModel, "emissions", emissions)
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab1é") for _ in range(n)) for n in (0, 1, 31, 32, 33, 95, 96, 97, 127, 128, 129, 130, 300, 1000)]
    sym, bounds = pii.symbols(*utf8(pa.array(texts)))
    labels = model.labels(sym, bounds)
    for i, t in enumerate(texts):
        assert labels[bounds[i] : bounds[i + 1]].tolist() == [int(c == "1") for c in t]


def test_hard_cases(spark, model):
    rows = [(1, None, "en", "s"), (2, "", "en", "s"), (3, "écrire à a.b@c.de ou +49 30 1234567", "fr", "s"), (3, "10.0.0.1", "en", None), (None, "x " * 100_000 + "4111 1111 1111 1111", "en", "s")]
    out = pii.find_pii(docs_table(spark, rows), model, keep=("doc_id", "row")).collect()
    by = {}
    for r in out:
        by.setdefault(r["row"]["doc_id"], []).append([(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]])
    assert by[1] == by[2] == [[]]
    assert sorted(by[3]) == [[("email", 9, 17), ("phone", 21, 35)], [("ip", 0, 8)]]
    assert by[None] == [[("card", 200_000, 200_019)]]
    assert pii.find_pii(docs_table(spark, []), model).count() == 0


def test_every_trained_form_is_plausible():
    rng = random.Random(11)
    for _ in range(20_000):
        kind, made = pii._made(rng)
        assert kind < 0 or pii.plausible(kind, made), made
    assert not pii.plausible(3, "2024-01-31")


@pytest.mark.parametrize("kind, said", [(3, "0049 123 4567891"), (3, "030 1234567"), (3, "0171 2345678"), (2, "1234 - 5678 - 9012 - 3456"), (2, "1234567890123457")])
def test_decoded_numbers_stand(kind, said):
    text = f"call {said}, or not"
    labels = np.zeros(len(text), np.uint8)
    labels[5 : 5 + len(said)] = kind + 1
    assert pii.base_spans(text) == []
    assert pii.added_spans(text, labels, []) == [(kind, 5, 5 + len(said))]


def _forms():
    """``(name, kind, maker)``: forms that the training pieces can make, and forms that they can't."""
    rng = random.Random(21)
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9)))
    o = lambda: str(rng.randint(0, 255))
    h = lambda: f"{rng.randint(1, 65535):x}"
    trained = [
        (3, lambda: f"{d(3)}-{d(3)}-{d(4)}"), (3, lambda: f"({d(3)}) {d(3)}-{d(4)}"), (3, lambda: f"{d(3)}.{d(3)}.{d(4)}"),
        (3, lambda: f"(0{d(3)}) {d(6)}"), (3, lambda: f"0{d(1)} {d(2)} {d(2)} {d(2)} {d(2)}"), (3, lambda: f"0{d(2)} {d(7)}"), (3, lambda: f"0{d(3)}/{d(7)}"),
        (2, lambda: f"{d(4)} {d(6)} {d(5)}"), (2, lambda: f"{d(4)}.{d(4)}.{d(4)}.{d(4)}"), (2, lambda: d(16)),
        (0, lambda: f"{w()}[at]{w()}[dot]de"), (0, lambda: f"{w()} AT {w()} DOT com"), (0, lambda: f"{w()}(at){w()}.org"),
        (1, lambda: f"{o()}[.]{o()}[.]{o()}[.]{o()}"), (1, lambda: f"{o()} dot {o()} dot {o()} dot {o()}"), (1, lambda: ":".join(h() for _ in range(8))), (1, lambda: f"fe80::{h()}:{h()}"),
    ]
    untrained = [
        (3, lambda: f"{d(3)}_{d(3)}_{d(4)}"), (3, lambda: f"0{d(3)} / {d(3)} {d(4)}"), (3, lambda: f"tel:{d(3)}-{d(3)}-{d(4)}"),
        (2, lambda: f"{d(4)}:{d(4)}:{d(4)}:{d(4)}"), (2, lambda: f"{d(4)}–{d(4)}–{d(4)}–{d(4)}"),
        (0, lambda: f"{w()}{{at}}{w()}.com"), (0, lambda: f"{w()}*at*{w()}*dot*net"),
        (1, lambda: f"{o()}/{o()}/{o()}/{o()}"), (1, lambda: f"{o()}{{.}}{o()}{{.}}{o()}{{.}}{o()}"),
    ]
    return trained, untrained


def _recall(model, texts, forms, n=60):
    """Share of spans written into texts that are found with their kind and both ends, form by form."""
    rng, out = random.Random(22), []
    for kind, make in forms:
        rows = []
        for _ in range(n):
            text = rng.choice(texts)
            at = rng.randrange(max(1, len(text) - 300))
            part = text[at : at + 300]
            gap = rng.choice([m.start() for m in re.finditer(" ", part)] or [0])
            made = make()
            lead = made.index(":") + 1 if made.startswith("tel:") else 0
            rows.append((f"{part[:gap]} {made}{rng.choice([' ', ', ', '. '])}{part[gap:].lstrip()}", gap + 1 + lead, gap + 1 + len(made)))
        sym, bounds = pii.symbols(*utf8(pa.array([r[0] for r in rows])))
        labels = model.labels(sym, bounds)
        hit = 0
        for i, (text, a, b) in enumerate(rows):
            base = pii.base_spans(text)
            hit += (kind, a, b) in base + pii.added_spans(text, labels[bounds[i] : bounds[i + 1]], base)
        out.append(hit / n)
    return out


def test_recall_by_form(model, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id between 400 and 700").collect()
    texts = [r["text"] for r in docs if r["text"]]
    trained, untrained = (_recall(model, texts, forms) for forms in _forms())
    print("trained", trained, np.mean(trained), "untrained", untrained, np.mean(untrained))
    assert np.mean(trained) >= 0.75  # the aim of 0.9 is not met: README
    assert min(trained) >= 0.3
    # forms with signs that no training form has: written down, not aimed at
    assert np.mean(untrained) >= 0.1


def test_clean_texts_are_left_alone(model, spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id between 400 and 700").collect()
    texts = [r["text"] for r in docs if r["text"]]
    sym, bounds = pii.symbols(*utf8(pa.array(texts)))
    labels = model.labels(sym, bounds)
    added = [len(pii.added_spans(t, labels[bounds[i] : bounds[i + 1]], pii.base_spans(t))) for i, t in enumerate(texts)]
    assert sum(n > 0 for n in added) <= 0.02 * len(texts)
