"""Personal data: base patterns, and spans that a character-level bidirectional LSTM with CRF transitions adds.

The base patterns (``BASE``) are exact. The network labels every character of
the whole text: it runs over windows of ``WINDOW`` characters every ``STRIDE``
characters, each window is decoded by the CRF, every character takes its label
from the window in which it lies furthest inside, and runs of one label over
the whole text are spans. A span is added if it passes a light check of its kind
(an address has its marks or numbers, cards and phones their number of digits)
and overlaps no base span.

The weights are trained on the driver by backpropagation through time from a
bounded sample: windows of ``TRAIN_ROWS`` documents with their base spans as
labels, and the same windows with spans written into them, whose signs, words,
brackets, blanks and groupings are put together at random.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import crf
from .common import bounded_batches, hash_sample, table, utf8
from .recurrent import F4, LSTM, Adam, init

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 128, 96
HIDDEN = 10
TRAIN_ROWS = 600
TRAIN_CHARS = 256
#: Windows of a training text into which something is written.
WRITTEN = 14
EPOCHS = 14
BATCH = 128
SEED = 5
COLUMNS = 2048
#: Symbols: ASCII, two classes of longer characters, and padding.
PAD = 130

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# a match that doesn't start at the head of a run of digits fails where the head fails, so only heads are tried
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """``(kind, start, end)`` by kind and start: leftmost non-overlapping matches that pass their check."""
    out: list[Span] = []
    done = 0
    for m in _DOMAIN.finditer(text):  # the part before an @ is the run of its characters since the last match
        seg = text[done : m.start()]
        local = len(seg) - len(seg.rstrip(_LOCAL))
        if local:
            out.append((0, m.start() - local, m.end()))
            done = m.end()
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m[0])) <= 15:
            out.append((3, m.start(), m.end()))
    return out


_AT = re.compile(r"\w[^\w\n]{0,3}(?:@|(?<![^\W_])[Aa][Tt](?![^\W_]))[^\w\n]{0,3}\w")
_DOT = re.compile(r"\w[^\w\n]{0,3}(?:\.|(?<![^\W_])[Dd][Oo][Tt](?![^\W_]))[^\w\n]{0,3}[A-Za-z]")
_NUMBER = re.compile(r"[0-9]+")
_HEX = re.compile(r"[0-9A-Fa-f:.]+")
_DATE = re.compile(r"[0-9]{4}[-/.][0-9]{2}[-/.][0-9]{2}")
_LONGEST = 120


def plausible(kind: int, text: str) -> bool:
    """A light check of a decoded span: an address has its marks or its four or more numbers, cards and phones their digits."""
    if len(text) > _LONGEST:
        return False
    if kind == 0:
        at = _AT.search(text)
        return at is not None and _DOT.search(text, at.end() - 1) is not None
    if kind == 1:
        numbers = _NUMBER.findall(text)
        if ":" in text:
            return _HEX.fullmatch(text) is not None and 2 <= text.count(":") <= 7
        return len(numbers) == 4 and all(int(n) <= 255 for n in numbers)
    digits = len(_DIGITS.findall(text))
    return 13 <= digits <= 19 if kind == 2 else 7 <= digits <= 15 and not _DATE.fullmatch(text)


_CLASS = np.zeros(256, np.uint8)
_CLASS[:128] = np.arange(128)
_CLASS[0xC0:0xE0] = 128
_CLASS[0xE0:] = 129


def symbols(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One symbol per code point, and the texts' bounds in code points."""
    lead = (raw & 0xC0) != 0x80
    return _CLASS[raw[lead]], np.concatenate([[0], np.cumsum(lead)])[off]


class PiiModel:
    def __init__(self, params: dict[str, np.ndarray]):
        self.params = params

    def _nets(self) -> tuple[LSTM, LSTM]:
        return LSTM(self.params["Ef"], self.params["Uf"]), LSTM(self.params["Eb"], self.params["Ub"])

    def emissions(self, x: np.ndarray, tapes: tuple[list, list] | tuple[None, None] = (None, None)) -> tuple[np.ndarray, np.ndarray]:
        hid = self.params["Uf"].shape[1]
        states = np.empty((len(x), 2 * hid, x.shape[1]), F4)
        fwd, bwd = self._nets()
        fwd.run(x, states[:, :hid], False, tapes[0])
        bwd.run(x, states[:, hid:], True, tapes[1])
        return np.matmul(self.params["O"], states) + self.params["b"], states

    def labels(self, sym: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """A label for every symbol of the texts (0: none, else kind + 1)."""
        n = np.diff(bounds)
        per = np.maximum(-(-(n - (WINDOW - STRIDE)) // STRIDE), (n > 0).astype(np.int64))
        owner = np.repeat(np.arange(len(n)), per)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begin = bounds[owner] + at * STRIDE
        left = bounds[owner + 1] - begin
        # a window decides from its margin on (from its start, if first) to the next one's margin (to the end, if last)
        margin = (WINDOW - STRIDE) // 2
        lo = np.where(at == 0, 0, margin)
        hi = np.where(at == per[owner] - 1, np.minimum(left, WINDOW), margin + STRIDE)
        padded = np.concatenate([sym, np.full(WINDOW, PAD, np.uint8)])
        out = np.zeros(len(sym) + WINDOW, np.uint8)
        steps = np.arange(WINDOW)[:, None]
        for k in range(0, len(owner), COLUMNS):
            s = slice(k, k + COLUMNS)
            place = begin[s][None, :] + steps
            x = padded[place].astype(np.intp)
            x[steps >= left[s][None, :]] = PAD
            path = crf.decode(self.emissions(x)[0], self.params["T"])
            t, c = np.nonzero(path)
            ok = (t >= lo[s][c]) & (t < hi[s][c])
            out[place[t[ok], c[ok]]] = path[t[ok], c[ok]]
        return out[: len(sym)]


def train(examples: list[tuple[str, list[Span]]], seed: int = SEED, epochs: int = EPOCHS, hidden: int = HIDDEN) -> PiiModel:
    """Fit on texts (their first ``WINDOW`` characters) and labelled spans."""
    rng = np.random.default_rng(seed)
    params = init(rng, hidden, 4, PAD + 1, len(KINDS) + 1)
    params["Ef"][hidden : 2 * hidden] += F4(1)
    params["Eb"][hidden : 2 * hidden] += F4(1)
    params["T"] = (np.eye(len(KINDS) + 1) * 1.0).astype(F4)
    model = PiiModel(params)
    x = np.full((len(examples), WINDOW), PAD, np.intp)
    y = np.zeros((len(examples), WINDOW), np.intp)
    for i, (text, spans) in enumerate(examples):
        sym, _ = symbols(*utf8(pa.array([text[:WINDOW]])))
        x[i, : len(sym)] = sym
        for kind, a, b in spans:
            y[i, a : min(b, WINDOW)] = kind + 1
    adam = Adam(params, 0.03)
    total, done = max(1, epochs * -(-len(x) // BATCH)), 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for k in range(0, len(x), BATCH):
            pick = order[k : k + BATCH]
            xt, yt = np.ascontiguousarray(x[pick].T), y[pick].T
            tapes: tuple[list, list] = ([], [])
            emit, states = model.emissions(xt, tapes)
            _, d_emit, d_trans = crf.loss_grads(emit, params["T"], yt)
            d_emit = d_emit.astype(F4)
            d_states = np.matmul(params["O"].T, d_emit)
            fwd, bwd = model._nets()
            g = {"O": np.matmul(d_emit, states.transpose(0, 2, 1)).sum(0), "b": d_emit.sum(axis=(0, 2))[:, None], "T": d_trans.astype(F4)}
            g["Ef"], g["Uf"] = fwd.grads(xt, d_states[:, :hidden], tapes[0])
            g["Eb"], g["Ub"] = bwd.grads(xt, d_states[:, hidden:], tapes[1])
            adam.step(g, 1 - 0.9 * done / total)
            done += 1
    return model


#: Pieces that training forms are made of.
_BRACKETS = (("(", ")"), ("[", "]"), ("<", ">"), ("-", "-"), ("", ""), ("", ""))
_TOPS = ("com", "org", "net", "de", "fr", "es", "io", "co", "info")


def _marks(rng: random.Random) -> tuple[str, str]:
    """How an address says its ``@`` and its dots: by signs, or by words in brackets, blanks or both, mostly alike."""

    def one(word: str, style: tuple[str, str]) -> str:
        a, b = style
        return f"{blank or ('' if a else ' ')}{a}{write(word)}{b}{blank or ('' if a else ' ')}"

    if rng.random() < 0.25:
        return rng.choice([("@", "."), (" @ ", "."), (" @ ", " . "), ("(@)", ".")])
    style, blank = rng.choice(_BRACKETS), rng.choice(["", "", " "])
    write = rng.choice([str.lower, str.lower, str.upper, str.capitalize])
    at, dot = one("at", style), one("dot", style)
    return at, rng.choice([dot, dot, ".", one("dot", rng.choice(_BRACKETS))])


def _grouped(digits: str, sizes: list[int], sep: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(digits[at : at + n])
        at += n
    return sep.join(x for x in out if x)


def _sizes(rng: random.Random, n: int, low: int, high: int) -> list[int]:
    """Group sizes that add up to ``n``: all alike if that is possible in some draws, else at random."""
    if rng.random() < 0.5:
        k = rng.randint(low, high)
        return [k] * (n // k) + [n % k]
    out = []
    while sum(out) < n:
        out.append(min(rng.randint(low, high), n - sum(out)))
    return out


def _made(rng: random.Random) -> tuple[int, str]:
    """A span in a base or other form, or (kind -1) something alike that is none."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    w = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    h = lambda: f"{rng.randint(0, 65535):x}"
    kind = rng.choice([0, 0, 0, 0, 1, 1, 2, 2, 3, 3, 3, 3, -1, -1, -1])
    if kind == 0:
        name = rng.choice([w(), f"{w()}.{w()}", f"{w()}{d(2)}", d(2), f"{w()}_{w()}", f"{w()}-{w()}", w().capitalize()])
        host = [w(), *rng.choice([[], [], [w()], [f"{w()}{d(1)}"]]), rng.choice(_TOPS)]
        at, dot = _marks(rng)
        return 0, name + at + dot.join(host)
    if kind == 1:
        if rng.random() < 0.3:
            groups = [h() for _ in range(8)]
            if rng.random() < 0.6:
                groups = groups[: rng.randint(2, 6)]
                groups.insert(rng.randint(1, len(groups) - 1), "")
            return 1, ":".join(groups)
        dot = rng.choice([".", ".", " . ", "-", "_", "[.]", "(.)", _marks(rng)[1], _marks(rng)[1]])
        return 1, dot.join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        n = rng.choice([16, 16, 16, 13, 14, 15, 17, 18, 19])
        sep = rng.choice(["", "", " ", " ", "-", ".", " - ", "/", "  ", "_"])
        return 2, _grouped(d(n), _sizes(rng, n, 3, 6), sep)
    if kind == 3:
        sep = rng.choice([" ", " ", "-", "-", ".", "/", ""])
        if rng.random() < 0.45:
            a, b, c = d(3), d(3), d(4)
            lead = rng.choice(["", "", "1-", "+1 ", "1 "])
            return 3, lead + rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"{a}/{b}-{c}", f"({a}) {b} {c}"])
        n = rng.randint(5, 8)
        rest = _grouped(d(n), _sizes(rng, n, 2, 4), sep) if rng.random() < 0.6 else d(n)
        code = rng.choice([f"0{d(2)}", f"0{d(3)}", f"0{d(1)}", f"+{d(2)} {d(2)}", f"00{d(2)} {d(3)}", f"+{d(2)}-{d(3)}"])
        if rng.random() < 0.3:
            code = f"({code})" if code[0] == "0" else code
        return 3, rng.choice([f"{code}{sep or ' '}{rest}", f"{code}{sep or ' '}{rest}", f"{code} {rest}", d(10), "0" + d(9)])
    return -1, rng.choice([
        d(4), d(2), f"{d(4)}-{d(2)}-{d(2)}", f"{d(1)}.{d(1)}", f"{d(1)}.{d(2)}.{d(1)}", f"{d(2)}:{d(2)}", f"{d(1)},{d(3)}", f"{d(3)}.{d(2)}", w() + d(3),
        "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([8, 16, 32, 40]))), f"${d(3)}", f"{d(2)}%", f"@{w()}", f"#{d(3)}", d(6),
        f"{w()} at {w()}", f"v{d(1)}.{d(1)}.{d(1)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(2)}.{d(2)}.{d(4)}", f"{d(1)},{d(3)},{d(3)}", f"19{d(2)}-19{d(2)}",
        f"{d(2)}, {d(2)}, {d(2)}, {d(2)}", f"{d(2)}:{d(2)}:{d(2)}", f"{w()} dot {w()}", f"{w()}.{w()}", f"({w()})", f"[{w()}]", f"<{w()}>", f"{w()}_{w()}",
        f"{d(2)}.{d(4)}, {d(1)}.{d(4)}", f"({d(4)})", f"p. {d(3)}", f"{w()} at {w()} and {w()}", f"{d(3)} {w()}", f"{d(2)}-{d(2)}", f"{w()}-{w()}-{w()}",
    ])


def examples(texts: list[str], seed: int = SEED) -> list[tuple[str, list[Span]]]:
    """Labelled windows: each text as it is, and ``WRITTEN`` times with a made span at a word border."""
    rng = random.Random(seed)
    out = []
    for text in texts:
        out.append((text[:WINDOW], base_spans(text[:WINDOW])))
        for _ in range(WRITTEN):
            at = rng.randint(0, max(0, len(text) - WINDOW))
            part = text[at : at + WINDOW]
            gaps = [m.start() for m in re.finditer(" ", part[: WINDOW - 48])] or [0]
            place = rng.choice(gaps)
            kind, made = _made(rng)
            tail = rng.choice([" ", " ", ", ", ". ", "\n"])
            part = f"{part[:place]} {made}{tail}{part[place:]}"[:WINDOW]
            a, b = place + 1, min(place + 1 + len(made), WINDOW)
            spans = [s for s in base_spans(part) if s[2] <= a or s[1] >= b]
            out.append((part, spans + ([(kind, a, b)] if kind >= 0 else [])))
    return out


def fit(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> PiiModel:
    """Train on windows of a hash sample of ``TRAIN_ROWS`` documents, half of them with digits."""
    rows = docs.where(F.length(text) > 0).withColumn("h", F.xxhash64(F.col(id_col), F.col(text)))
    place = f"cast(pmod(h, greatest(length(`{text}`) - {TRAIN_CHARS}, 1)) as int) + 1"
    rows = rows.select("h", F.expr(f"substring(`{text}`, {place}, {TRAIN_CHARS})").alias("text"))
    half = TRAIN_ROWS // 2
    some = [r["text"] for r in hash_sample(rows, half, "h").collect()]
    some += [r["text"] for r in hash_sample(rows.where(F.col("text").rlike("[0-9]{2}")), half, "h").collect()]
    return train(examples(some))


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
SPANS_TYPE = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def added_spans(text: str, labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Runs of one label, trimmed, that fit their kind and overlap no base span."""
    edges = np.flatnonzero(np.diff(labels)) + 1
    cuts = np.concatenate([[0], edges, [len(labels)]])
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if a == b or not labels[a]:
            continue
        piece = text[a:b]
        a += len(piece) - len(piece.lstrip(" \n\t,;:.!?"))
        piece = piece.strip(" \n\t,;:.!?")
        b = a + len(piece)
        kind = int(labels[a]) - 1 if piece else -1
        inside = (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())
        if piece and inside and plausible(kind, piece) and all(e <= a or s >= b for _, s, e in base):
            out.append((kind, a, b))
    return out


def _find(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            texts = batch.column("text")
            sym, bounds = symbols(*utf8(texts))
            labels = m.labels(sym, bounds)
            marked = np.concatenate([[0], np.cumsum(labels != 0)])[bounds]
            found = []
            for i, text in enumerate(texts.to_pylist()):
                base = base_spans(text or "")
                spans = [(*s, True) for s in base]
                if marked[i + 1] > marked[i]:
                    spans += [(*s, False) for s in added_spans(text, labels[bounds[i] : bounds[i + 1]], base)]
                found.append([{"kind": KINDS[k], "start": a, "end": b, "base": own} for k, a, b, own in sorted(spans)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found, _SPANS)], ["row", "spans"])

    return run


def find_pii(docs: DataFrame, model: PiiModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns) and ``spans`` (kind, start, end, base), by kind and start.

    Places are code points, ends exclusive. Null and empty texts have no
    spans; a text of any length is labelled in whole; repeated rows each get
    theirs; an empty table gives an empty one; kept columns may have any name.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a few kilobytes
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).alias("text"))
    return rows.mapInArrow(_find(shared), f"row {rows.schema['row'].dataType.simpleString()}, spans {SPANS_TYPE}")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: base counts and digest, and all spans."""
    docs = table(spark, sf_dir, "documents")
    out = find_pii(docs, fit(docs))
    base = F.filter("spans", lambda s: s["base"])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.filter(base, lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("row.doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))
