"""Audit of how filters interact: what every filter removes at every step of every order of them.

A document's outcomes depend on nothing but its mask: which filters it fails,
and whether it is good or toxic. Every mask maps to one wide integer with a
field of ``FIELD_BITS`` bits for each outcome of each of the n * n! steps. A
task adds the integers of its documents per part; the sums are added up per
part, and one unpacking of a part's sum gives all its rows. A field holds a
count of documents, which stays below 2^63, so no field runs into the next.

Filters are judged in one pass over the texts. Identity to an earlier text
needs the whole table: rows are collapsed by (fingerprint, part, mask), with
the smallest id and the rows that have it, before anything is grouped by
fingerprint, so a text with very many copies is a handful of rows by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_batches, table
from .packed_sums import HELD, merged

OUTCOMES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BITS = 64
#: The production filters, and their thresholds.
LETTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT_PERCENT = 80
MAX_CAPITALS_PERCENT = 10
SYMBOLS = "[#$%&*|]"


def steps(letters: str) -> list[tuple[str, int, int]]:
    """``(order, step from 0, filter)`` of every step of every order; the filter is its place in ``letters``."""
    return [("".join(p), s, letters.index(p[s])) for p in permutations(letters) for s in range(len(letters))]


def outcomes(letters: str) -> np.ndarray:
    """``(masks, steps, OUTCOMES)`` of 0 and 1. A mask's low bits are the filters it fails, then good, then toxic."""
    n = len(letters)
    mask = np.arange(1 << (n + 2))
    good, toxic = (mask >> n) & 1, (mask >> (n + 1)) & 1
    out = np.zeros((len(mask), len(steps(letters)), len(OUTCOMES)), "<u8")
    for i, (order, s, f) in enumerate(steps(letters)):
        before = sum(1 << letters.index(c) for c in order[:s])
        alive, fails = (mask & before) == 0, (mask >> f) & 1 == 1
        gone = alive & fails
        alone = (mask & ((1 << n) - 1)) == 1 << f
        out[:, i] = np.stack([alive & ~fails, gone, fails & ~alive, alone, gone & (good == 1), gone & (toxic == 1)], axis=1)
    return out


def packed(letters: str) -> list[int]:
    """The wide integer of every mask."""
    return [int.from_bytes(row.tobytes(), "little") for row in outcomes(letters)]


def _add(a: int, b: int) -> int:
    return a + b


def _load(payload: bytes) -> int:
    return int.from_bytes(payload, "little")


def _dump(value: int) -> bytes:
    return value.to_bytes((value.bit_length() + 7) // 8, "little")


def _pack(letters: str):
    """Per task and part: the sum of the integers of its rows, a row of weight w counting w times."""

    def emit(sums: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([_dump(v) for v in sums.values()], pa.binary())], ["key", "payload"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide, sums = packed(letters), {}
        for batch in batches:
            for part, mask, weight in zip(*(batch.column(c).to_pylist() for c in ("part", "mask", "weight"))):
                sums[part] = sums.get(part, 0) + wide[mask] * weight
                if len(sums) >= HELD:
                    yield emit(sums)
                    sums = {}
        if sums:
            yield emit(sums)

    return run


def _unpack(letters: str):
    plan = steps(letters)
    step_filter = np.array([f for _, _, f in plan])
    schema = pa.schema(
        [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
        + [(c, pa.int64()) for c in (*OUTCOMES, "shapley")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(plan) * len(OUTCOMES) * FIELD_BITS // 8
        for batch in batches:
            for part, payload in zip(batch.column("key").to_pylist(), batch.column("payload")):
                fields = np.frombuffer(_load(payload.as_py()).to_bytes(size, "little"), "<u8")
                counts = fields.reshape(len(plan), len(OUTCOMES)).astype(np.int64)
                removed = counts[:, OUTCOMES.index("removed")]
                total = np.array([removed[step_filter == f].sum() for f in range(len(letters))])
                columns = [[part] * len(plan), [o for o, _, _ in plan], [s + 1 for _, s, _ in plan]]
                columns += [*counts.T, total[step_filter]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """One row per part, order of the filters and step, of rows ``(part, mask, weight)``.

    ``mask`` has a bit for each of the (at most six) ``letters`` that a row
    fails, then one for good and one for toxic; ``weight`` says for how many
    documents the row stands. Columns: ``part, filter_order, step`` (from 1),
    the counts ``kept, removed, redundant, unique_fails, good_lost,
    toxic_lost``, and ``shapley``: what the step's filter removes, summed over
    all orders. A part that has a row has all steps, zeros included; without
    rows there are none. A null part is a part of its own.
    """
    if not 1 <= len(letters) <= 6 or len(set(letters)) != len(letters):
        raise ValueError("letters must be one to six different letters")
    bounded_batches(masks.sparkSession)
    rows = masks.select(F.col("part").cast("string"), F.col("mask").cast("int"), F.col("weight").cast("long"))
    partials = rows.mapInArrow(_pack(letters), "key string, payload binary")
    counts = ", ".join(f"{c} long" for c in (*OUTCOMES, "shapley"))
    return merged(partials, _add, _load, _dump).mapInArrow(_unpack(letters), f"part string, filter_order string, step int, {counts}")


def _bits(conditions: list[Column], first: int = 0) -> Column:
    out = F.lit(0)
    for i, c in enumerate(conditions):
        out = out + F.when(c, 1 << (first + i)).otherwise(0)
    return out


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, mask, weight)`` of ``documents`` under the five production filters.

    A: under 100 words; B: under 80 % of the words distinct; C: over 10 %
    capitals; D: holds one of ``#$%&*|``; E: identical to the text of a smaller
    doc_id anywhere in the table. A null text is empty, and so is identical to
    other empty ones. Rows of one id aren't copies of each other (none is
    smaller); a row without an id is no copy of any, and none is a copy of it.
    Repeated rows count each. A document is good (toxic) if any label row of
    its id says quality (toxic) 1. Part: lang, null as the empty string.
    """
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    d = docs.select(
        F.col("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("fp"),
        F.length(text).cast("long").alias("n"), (F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]", ""))).cast("long").alias("caps"),
        text.rlike(SYMBOLS).alias("symbol"), words.alias("words"),
    )
    d = d.select("*", F.size("words").cast("long").alias("n_words"), F.size(F.array_distinct("words")).cast("long").alias("n_distinct"))
    failed = [
        F.col("n_words") < MIN_WORDS, F.col("n_distinct") * 100 < F.col("n_words") * MIN_DISTINCT_PERCENT,
        F.col("caps") * 100 > F.col("n") * MAX_CAPITALS_PERCENT, F.col("symbol"),
    ]
    # rows without an id are spread by their text instead of meeting under null
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("fp")).otherwise(F.lit(0).cast("long"))
    d = d.select("doc_id", spread.alias("k"), "part", "fp", _bits(failed).alias("m"))
    said = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    d = d.join(said.select(F.lit(0).cast("long").alias("k"), "doc_id", "good", "toxic"), ["k", "doc_id"], "left")
    n = len(LETTERS)
    flags = _bits([F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False))], n)
    per_id = d.select("k", "doc_id", "part", "fp", (F.col("m") + flags).alias("m")).groupBy("k", "doc_id", "part", "fp", "m").agg(F.count("*").alias("c"))
    with_id = F.col("doc_id").isNotNull()
    few = per_id.groupBy("fp", "part", "m").agg(
        F.sum("c").alias("all"), F.sum(F.when(with_id, F.col("c")).otherwise(0)).alias("ids"),
        F.min(F.when(with_id, F.struct("doc_id", "c"))).alias("low"),
    )
    few = few.withColumn("first", F.min("low.doc_id").over(W.partitionBy("fp")))
    at_first = F.when(F.col("low.doc_id") == F.col("first"), F.col("low.c")).otherwise(0)
    copies = few.select("part", "m", "all", (F.col("ids") - F.coalesce(at_first, F.lit(0))).alias("copies"))
    both = F.array(
        F.struct(F.col("m").alias("mask"), (F.col("all") - F.col("copies")).alias("weight")),
        F.struct((F.col("m") + (1 << (n - 1))).alias("mask"), F.col("copies").alias("weight")),
    )
    return copies.select("part", F.inline(both)).where("weight > 0")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 600 steps of the five filters over every part of ``documents``."""
    return audit(document_masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP11_SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
f AS (
  SELECT doc_id, part, min(doc_id) OVER (PARTITION BY t) < doc_id AS e, len(ws) < 100 AS a,
         100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
         100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
x AS (
  SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
           || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN coalesce(e, false) THEN 'E' ELSE '' END AS fails,
         coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (
  SELECT p.k || q.k || r.k || s.k || t.k AS filter_order FROM c p, c q, c r, c s, c t
  WHERE len(list_distinct([p.k, q.k, r.k, s.k, t.k])) = 5),
z AS (SELECT filter_order, i::INTEGER AS step, filter_order[i] AS k, filter_order[1:i-1] AS before FROM o, range(1, 6) g(i)),
y AS (
  SELECT x.part, z.filter_order, z.step, z.k, n, good, toxic, fails = z.k AS alone, contains(fails, z.k) AS fail,
         fails = '' OR z.before = '' OR NOT regexp_matches(fails, '[' || z.before || '_]') AS alive
  FROM x, z),
g AS (
  SELECT part, filter_order, step, k, sum(n) FILTER (alive AND NOT fail) AS kept, sum(n) FILTER (alive AND fail) AS removed,
         sum(n) FILTER (fail AND NOT alive) AS redundant, sum(n) FILTER (alone) AS unique_fails,
         sum(n) FILTER (alive AND fail AND good) AS good_lost, sum(n) FILTER (alive AND fail AND toxic) AS toxic_lost
  FROM y GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, k), 0)::BIGINT AS shapley
FROM g
"""
