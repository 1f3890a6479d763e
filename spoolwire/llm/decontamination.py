"""Benchmark decontamination by a generalised suffix automaton of the items' words.

The automaton of the normalised items goes to every task. A document's words
stream through it, and the length of the longest suffix that occurs in an item
is tracked; from ``window`` words on, that suffix is a hit (as is a whole item
of fewer words). Runs of words in which every neighbouring pair occurs in some
item are found in numpy first, as the matching length can't pass one outside
of them; only those run through the automaton.

Items are cut into overlapping pieces (every window lies in one) and the pieces
dealt to blocks of bounded size (``BLOCK_WORDS``, ``BLOCK_CHARS``). Each block
is a pass of its own over the documents, written to the shared folder but for
the last, so that one automaton at a time is held by the driver and the
workers, however large the benchmark or one of its items is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from ..workspace import delete_path, scratch_path
from .common import bounded_batches, materialize, table, utf8
from .suffix_automaton import SuffixAutomaton

WINDOW = 10
#: Words and characters of items in one automaton, about (pieces are dealt by hash); a word takes about 1 KB in it.
BLOCK_WORDS = 1 << 17
BLOCK_CHARS = 8 << 20
#: Pieces that a block's words are at least cut into.
PIECES = 8
#: A cleaned document goes if a larger share of its words was hit.
MAX_COVERAGE = 0.5


class ItemIndex:
    """Vocabulary, neighbouring pairs and automaton of a block of items."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        raw, off = utf8(pa.array([t for _, t in items], pa.string()))
        data = words.lower(raw)
        s, e, first = words.cut(data, off, words.ALNUM)
        h = words.hashes(data, s, e)
        self.vocab = np.unique(h)
        ids = np.searchsorted(self.vocab, h)
        seqs = [ids[first[i] : first[i + 1]].tolist() for i in range(len(items))]
        self.names = [name for name, _ in items]
        self.automaton = SuffixAutomaton(seqs, window)
        self.pairs = self.automaton.pairs(seqs)
        self.least = min([min(len(q), window) for q in seqs if q], default=0)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocab >> np.uint64(44)).astype(np.int64)] = True

    def match(self, h: np.ndarray, first: np.ndarray) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
        """Hit word ranges and item names of each document of a batch."""
        n_docs = len(first) - 1
        spans, found = [[] for _ in range(n_docs)], [set() for _ in range(n_docs)]
        if not self.least or not len(h):
            return spans, found
        ids = np.full(len(h), -1, np.int64)
        at = np.flatnonzero(self.maybe[(h >> np.uint64(44)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.vocab, h[at]), len(self.vocab) - 1)
        ids[at] = np.where(self.vocab[k] == h[at], k, -1)
        known = ids >= 0
        joined = np.zeros(len(h), bool)  # to the word before
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        key = ids[both - 1] << 32 | ids[both]
        if len(self.pairs):
            k = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[both] = self.pairs[k] == key
        joined[first[:-1][first[:-1] < len(h)]] = False
        # runs of known words joined to each other
        begin = np.flatnonzero(known & ~joined)
        last = np.append(joined[1:], False)
        end = np.flatnonzero(known & ~last) + 1
        for lo, hi in zip(begin[end - begin >= self.least].tolist(), end[end - begin >= self.least].tolist(), strict=True):
            got, items = self.automaton.match(ids[lo:hi].tolist())
            if got:
                doc = int(np.searchsorted(first, lo, side="right")) - 1
                spans[doc] += [(lo - int(first[doc]) + a, lo - int(first[doc]) + b) for a, b in got]
                found[doc] |= {self.names[i] for i in items if self.names[i] is not None}
        return spans, found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and adjoining ranges as one."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


#: A word of an item, as ``words.ALNUM`` cuts it, before A-Z are lower-cased.
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_HITS = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
_NAMES = ["row", "text", "hits", "items", "n_words", "n_hit", "clean"]


def _match(index, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            raw, off = utf8(texts)
            data = words.lower(raw)
            s, e, first = words.cut(data, off, words.ALNUM)
            spans, found = index.value.match(words.hashes(data, s, e), first)
            clean, hits, items, n_hit = texts.to_pylist() if with_text else [None] * len(spans), [], [], []
            for i, (old, names) in enumerate(zip(batch.column("hits").to_pylist(), batch.column("items").to_pylist(), strict=True)):
                runs = merged(spans[i] + [(x["lo"], x["hi"]) for x in old or ()])
                hits.append([{"lo": lo, "hi": hi} for lo, hi in runs])
                items.append(sorted(found[i] | set(names or ())))
                n_hit.append(sum(hi - lo for lo, hi in runs))
                if runs and with_text:  # byte ranges from each run's first word to its last
                    f, at, kept = int(first[i]), int(off[i]), []
                    for lo, hi in runs:
                        kept.append(raw[at : s[f + lo]].tobytes())
                        at = int(e[f + hi - 1])
                    clean[i] = b"".join([*kept, raw[at : off[i + 1]].tobytes()]).decode()
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), texts, pa.array(hits, _HITS), pa.array(items, pa.list_(pa.string())), pa.array(np.diff(first)), pa.array(n_hit, pa.int64()), pa.array(clean, pa.string())],
                _NAMES,
            )

    return run


def item_pieces(benchmark: DataFrame, item_id: str, item_text: str, window: int) -> DataFrame:
    """``(id, text, n)``: the items' words in pieces of at most ``BLOCK_WORDS / PIECES`` windows.

    Pieces of one item overlap by ``window - 1`` words, so each of its windows
    is in one of them; an item of fewer words is one piece, one without words
    none. Repeated rows of an item give the same pieces, once.
    """
    step = max(BLOCK_WORDS // PIECES, 1)
    found = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("id"), F.regexp_extract_all(F.col(f"`{item_text}`"), F.lit(_WORD), F.lit(0)).alias("w"))
    found = found.where("size(w) > 0").withColumn("at", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)), F.lit(step))))
    part = F.slice("w", F.col("at"), F.lit(step + window - 1))
    return found.select("id", F.array_join(part, " ").alias("text"), F.size(part).cast("long").alias("n")).distinct()


def match_items(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """``row`` (a struct of the other columns), ``text``, ``hits`` (word ranges), ``items``, ``n_words``, ``n_hit``, ``clean``.

    ``clean`` is the text without its hit ranges (null unless ``with_text``).
    Null texts and items have no words; items without an id still hit but are
    not listed; equal items are listed each, repeated rows of an item once. An
    empty benchmark hits nothing; empty ``docs`` give an empty frame. Repeated
    documents are matched each; texts and items of any length count in whole.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    pieces = item_pieces(benchmark, item_id, item_text, window)
    n_words, n_chars = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = 1 + max(n_words // BLOCK_WORDS, n_chars // BLOCK_CHARS)
    if blocks > 1:
        pieces = materialize(pieces, "item-pieces")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("none")]
    out = docs.select(
        F.struct(*others).alias("row"), F.col(f"`{text}`").cast("string").alias("text"),
        F.lit(None).cast("array<struct<lo:long,hi:long>>").alias("hits"), F.lit(None).cast("array<string>").alias("items"),
    )
    row_type = out.schema["row"].dataType.simpleString()
    schema = f"row {row_type}, text string, hits array<struct<lo:long,hi:long>>, items array<string>, n_words long, n_hit long, clean string"
    before = None
    for b in range(blocks):
        part = pieces.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).select("id", "text").collect()  # about BLOCK_WORDS words
        index = spark.sparkContext.broadcast(ItemIndex([(r["id"], r["text"]) for r in part], window))
        last = b == blocks - 1
        found = out.select("row", "text", "hits", "items").mapInArrow(_match(index, with_text and last), schema)
        if last:
            return found
        path = scratch_path(spark, "hits")
        found.select("row", "text", "hits", "items").write.parquet(path)
        index.destroy()
        if before:
            delete_path(spark, before)
        out, before = spark.read.schema(out.schema).parquet(path), path


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without the passages of ``benchmark``: hit spans are cut out, documents hit beyond ``max_coverage`` go.

    Untouched documents come back as they were, null and empty texts included.
    ``n_chars``, if there is such a column, follows a changed text.
    """
    out = match_items(docs, benchmark, text).where(F.col("n_hit") <= F.col("n_words") * max_coverage)
    fields = []
    for c in docs.columns:
        if c == text:
            value = F.col("clean")
        elif c == "n_chars":
            value = F.when(F.col("n_hit") > 0, F.length("clean").cast(docs.schema[c].dataType)).otherwise(F.col("row")[c])
        else:
            value = F.col("row")[c]
        fields.append(value.alias(c))
    return out.select(*fields)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and hit words of every document, and the items whose windows occur in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = match_items(docs, table(spark, sf_dir, "benchmark"), with_text=False)
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP6_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') AS w FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+') FROM benchmark),
b AS (
  SELECT id AS item_id, least(10, len(w)) AS m, unnest(list_distinct(list_transform(range(1, len(w) - least(10, len(w)) + 2),
    lambda i: array_to_string(w[i:i + least(10, len(w)) - 1], ' ')))) AS g
  FROM t WHERE kind = 'b' AND len(w) > 0),
ms AS (SELECT DISTINCT m FROM b),
g AS (
  SELECT id AS doc_id, m, unnest(range(1, len(w) - m + 2)) AS i, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS g
  FROM t, ms WHERE kind = 'd' AND len(w) >= m),
hit AS (SELECT g.doc_id, g.i, g.m, b.item_id FROM g JOIN b ON g.g = b.g AND g.m = b.m),
pos AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY 1),
it AS (
  SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items, array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS s FROM hit GROUP BY 1)
SELECT t.id AS doc_id, len(t.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM t LEFT JOIN pos ON pos.doc_id = t.id LEFT JOIN it ON it.doc_id = t.id WHERE t.kind = 'd'
"""
