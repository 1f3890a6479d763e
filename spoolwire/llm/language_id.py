"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes in both directions and gives
every byte position a probability for each language. A document's
probabilities are the mean over all positions of its whole text. The weights
are trained on the driver by backpropagation through time from a bounded
sample of labelled rows (``TRAIN_ROWS`` per language, of every language there
is, one window of a hash-random place per row) and are a few kilobytes, which
every task receives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, in_share, materialize, table, utf8
from .recurrent import F4, GRU, Adam, init

WINDOW = 64
HIDDEN = 12
#: The bound of the training sample: rows of each language.
TRAIN_ROWS = 600
EPOCHS = 10
BATCH = 64
SEED = 7
#: Symbol that fills the last window of a text.
PAD = 256
#: Windows that run through the network together.
COLUMNS = 2048
#: Text without a language, and the least score that a filter keeps.
UNKNOWN = "und"
MIN_SCORE = 0.3


class LanguageModel:
    """Weights and languages; ``probabilities`` labels positions and pools them by text."""

    def __init__(self, params: dict[str, np.ndarray], langs: list[str]):
        self.params, self.langs = params, langs

    def _nets(self) -> tuple[GRU, GRU]:
        return GRU(self.params["Ef"], self.params["Uf"]), GRU(self.params["Eb"], self.params["Ub"])

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities ``(steps, languages, windows)`` of every position of ``x (steps, windows)``."""
        hid = self.params["Uf"].shape[1]
        states = np.empty((len(x), 2 * hid, x.shape[1]), F4)
        fwd, bwd = self._nets()
        fwd.run(x, states[:, :hid], False)
        bwd.run(x, states[:, hid:], True)
        out = np.matmul(self.params["O"], states)
        out += self.params["b"]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out

    def probabilities(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Mean position probabilities ``(texts, languages)``; zero for empty texts."""
        n = np.diff(off)
        per = -(-n // WINDOW)
        owner = np.repeat(np.arange(len(n)), per)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        begin = off[owner] + at * WINDOW
        left = np.minimum(off[owner + 1] - begin, WINDOW)
        padded = np.concatenate([raw, np.zeros(WINDOW, np.uint8)])
        total = np.zeros((len(n), len(self.langs)))
        for lo in range(0, len(owner), COLUMNS):
            s = slice(lo, lo + COLUMNS)
            x = padded[begin[s][None, :] + np.arange(WINDOW)[:, None]].astype(np.intp)
            real = np.arange(WINDOW)[:, None] < left[s][None, :]
            x[~real] = PAD
            p = self.positions(x)
            p *= real[:, None, :]
            sums = p.sum(axis=0, dtype=F4)
            for k in range(len(self.langs)):
                total[:, k] += np.bincount(owner[s], weights=sums[k], minlength=len(n))
        return total / np.maximum(n, 1)[:, None]


def train(windows: list[bytes], labels: list[str], seed: int = SEED, epochs: int = EPOCHS, hidden: int = HIDDEN) -> LanguageModel:
    """Fit on byte windows and their languages by backpropagation through time."""
    langs = sorted(set(labels))
    rng = np.random.default_rng(seed)
    params = init(rng, hidden, 3, 257, max(1, len(langs)))
    model = LanguageModel(params, langs)
    if len(langs) < 2:
        return model
    x = np.full((len(windows), WINDOW), PAD, np.intp)
    for i, w in enumerate(windows):
        x[i, : len(w[:WINDOW])] = np.frombuffer(w[:WINDOW], np.uint8)
    y = np.array([langs.index(v) for v in labels])
    adam = Adam(params, 0.02)
    steps = epochs * -(-len(x) // BATCH)
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), BATCH):
            pick = order[lo : lo + BATCH]
            xt = np.ascontiguousarray(x[pick].T)
            real = (xt != PAD).astype(F4)
            fwd, bwd = model._nets()
            states = np.empty((WINDOW, 2 * hidden, len(pick)), F4)
            tape_f, tape_b = [], []
            fwd.run(xt, states[:, :hidden], False, tape_f)
            bwd.run(xt, states[:, hidden:], True, tape_b)
            out = np.matmul(params["O"], states) + params["b"]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            out /= out.sum(axis=1, keepdims=True)
            out[:, y[pick], np.arange(len(pick))] -= 1
            out *= real[:, None, :] / max(1.0, float(real.sum()))
            dstates = np.matmul(params["O"].T, out)
            g = {"O": np.matmul(out, states.transpose(0, 2, 1)).sum(0), "b": out.sum(axis=(0, 2))[:, None]}
            g["Ef"], g["Uf"] = fwd.grads(xt, dstates[:, :hidden], tape_f)
            g["Eb"], g["Ub"] = bwd.grads(xt, dstates[:, hidden:], tape_b)
            adam.step(g, 1 - 0.9 * done / steps)
            done += 1
    return model


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id") -> LanguageModel:
    """Train on a hash sample of the labelled ``rows``, at most ``TRAIN_ROWS`` of each language; without labels nothing is learned."""
    place = f"cast(pmod(h, greatest(length(`{text}`) - {WINDOW} + 1, 1)) as int) + 1"  # a hash-random window
    labelled = rows.where(F.col(lang).isNotNull() & (F.length(text) > 0)).withColumn("h", F.xxhash64(F.col(id_col), F.col(text)))
    rows = labelled.select(F.col(lang).alias("lang"), "h", F.expr(f"substring(`{text}`, {place}, {WINDOW})").alias("w"))
    # a share that leaves a few times TRAIN_ROWS of each language, of which the first by hash are taken
    shares = rows.groupBy("lang").count().select("lang", F.least(F.lit(1.0), F.lit(4.0 * TRAIN_ROWS) / F.col("count")).alias("share"))
    few = rows.join(materialize(shares, "language-shares"), "lang").where(in_share(F.xxhash64("h"), F.col("share")))
    first = W.partitionBy("lang").orderBy("h", "w")
    picked = few.withColumn("i", F.row_number().over(first)).where(F.col("i") <= TRAIN_ROWS)
    sample = picked.orderBy("lang", "i").collect()  # at most TRAIN_ROWS windows of each language
    windows = [(r["w"], r["lang"]) for r in sample]
    windows += [(w.upper(), v) for w, v in windows[::8]]  # capitals are rare in running text
    return train([w.encode()[:WINDOW] for w, _ in windows], [v for _, v in windows])


def _predict(model, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        langs = np.array([*m.langs, UNKNOWN], dtype=object)
        for batch in batches:
            row = batch.column("row")
            has = batch.column("has_letter").to_numpy(zero_copy_only=False).astype(bool)
            if len(m.langs):
                texts = batch.column("text") if "text" in batch.schema.names else row.field(text)
                p = m.probabilities(*utf8(texts))
                best, score = p.argmax(axis=1), np.clip(p.max(axis=1), 0, 1)
            else:
                best, score = np.zeros(len(has), int), np.zeros(len(has))
            best = np.where(has & (score > 0), best, len(m.langs))
            found = [pa.array(langs[best], pa.string()), pa.array(np.where(best < len(m.langs), score, 0.0))]
            yield pa.RecordBatch.from_arrays([row, *found], ["row", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), ``lang_pred`` and ``score`` (0 to 1) of every row.

    Null texts, and texts without a letter, are ``und`` with score 0; so is
    every text if the model has learned no language. Rows are independent of
    each other, so repeated rows repeat their answer, and an empty table gives
    an empty one. A text of any length counts in whole, window by window. Kept
    columns may have any name.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # a few kilobytes
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")
    own = [] if text in keep else [F.col(text).alias("text")]
    rows = docs.select(row, *own, F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False)).alias("has_letter"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"
    return rows.mapInArrow(_predict(shared, text), schema)


def held_out(id_col: str = "doc_id"):
    """Rows kept out of training: crc32 of the id's text leaves 1 when divided by 3; false without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language and score of every document; trained on rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out()))
    out = identify(docs, model).select("row.doc_id", "lang_pred", "score")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
