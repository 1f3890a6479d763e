"""Mixing sources to target weights, in DataFrame operations only.

Every row gets a hash-random key. Within a source, rows are cut into key
ranges small enough for one task each; per-range token sums give each range
its offset (a two-level distributed prefix sum), and a window inside the range
gives each row its own. The mix of a source is the run of its tokens from 0
to its budget along that order; past the source's end it starts over (a new
epoch). The row on the cut is taken in part, so every source meets its budget
exactly.

Only narrow columns (a 128-bit row key, source, size) are shuffled for the
prefix sums. A hot source is split into as many key ranges as its rows need.
The table of sources (one row per source) is ordered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table

WEIGHTS = (3.0, 1.0, 2.0)
#: The mix's size as a share of all tokens, and the most epochs of a source.
SHARE = 1.5
MAX_EPOCHS = 2
#: Rows that a key range holds on average, at most.
RANGE_ROWS = 4096
SEED = "mix-0"
#: The per-source plan is broadcast up to this many sources (counted), else joined by a shuffle.
BROADCAST_SOURCES = 2000

_SEP = "[\\x20\\x09-\\x0D]+"
#: A cut before the separators that lead a word: piece k holds word k and what precedes it.
_BEFORE_GAP = "(?<=[^\\x20\\x09-\\x0D])(?=[\\x20\\x09-\\x0D])"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, max_epochs: float = MAX_EPOCHS
) -> DataFrame:
    """Water-filled targets of ``sizes(source, source_size)``, one row per source.

    Sources by code point, null last, take the weights in turn. A target stops
    at ``max_epochs`` times its source's size, and the excess is shared again
    by weight among the others: with the sources in order of cap per weight,
    exactly a prefix of them is capped, and the rest share one level per
    weight.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    s = sizes.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", w)
    s = s.withColumn("cap", F.col("source_size").cast("double") * float(max_epochs))
    s = s.withColumn("ratio", F.col("cap") / F.col("weight"))
    by = W.orderBy("ratio", "rank")
    up = by.rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = (
        s.withColumn("capped", F.sum("source_size").over(up))
        .withColumn("used", F.sum("weight").over(up))
        .withColumn("total", F.sum("source_size").over(whole))
        .withColumn("weights", F.sum("weight").over(whole))
    )
    # the level if all sources before this one, in order of ratio, stop at their caps
    level = (F.col("total").cast("double") * float(share)) - (
        (F.col("capped") - F.col("source_size")).cast("double") * float(max_epochs)
    )
    s = s.withColumn("level", level / (F.col("weights") - (F.col("used") - F.col("weight"))))
    s = s.withColumn("fits", F.when(F.col("level") <= F.col("ratio"), F.col("level")))
    # the first level that no remaining cap undercuts
    s = s.withColumn("final", F.first("fits", ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("weight") * F.col("final")))
    return s.select("source", "source_size", "weight", target.alias("target"))


def assign(rows: DataFrame, key_columns: list[str], size: str = "size", source: str = "source", **options) -> DataFrame:
    """``rows`` plus ``source_size``, ``target``, ``before`` (tokens ahead of it in its source) and ``budget``.

    ``key_columns`` name what the hash-random key is made of; rows with equal
    keys, sizes and sources (repeated rows) are interchangeable, and take
    consecutive places. Reruns give the same mix.
    """
    key = F.md5(F.concat_ws("|", F.lit(options.pop("seed", SEED)), *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in key_columns]))
    narrow = rows.withColumn("_key", key).withColumn("_src", F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("n")))
    sizes = narrow.select("_src", F.col(source).alias("source"), F.col(size).alias("_n")).groupBy("_src").agg(F.first("source").alias("source"), F.sum("_n").alias("source_size"), F.count("*").alias("_rows"))
    sizes = materialize(sizes, "mix-sizes")
    targets = source_targets(sizes.select("source", "source_size"), **options)
    # key ranges: a power of two of them per source, by the leading key bits
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_rows") / F.lit(float(RANGE_ROWS)))).cast("int"))
    plan = materialize(
        sizes.select("_src", bits.alias("_bits"), F.col("source").alias("_s"))
        .join(targets, F.col("source").eqNullSafe(F.col("_s")))
        .select("_src", "_bits", "source_size", "target"),
        "mix-plan",
    )
    narrow = narrow.join(F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan, "_src")
    lead = F.conv(F.substring("_key", 1, 8), 16, 10).cast("long")
    narrow = narrow.withColumn("_range", F.floor(lead / F.pow(F.lit(2.0), 32 - F.col("_bits"))).cast("long"))
    sums = narrow.groupBy("_src", "_range").agg(F.sum(size).alias("_sum"))
    ahead = W.partitionBy("_src").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_src", "_range", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_src", "_range").orderBy("_key", size).rowsBetween(W.unboundedPreceding, -1)
    out = narrow.withColumn("_in", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(offsets, ["_src", "_range"])
    return (
        out.withColumn("before", F.col("_offset") + F.col("_in"))
        .withColumn("budget", F.floor("target").cast("long"))
        .drop("_key", "_src", "_bits", "_range", "_offset", "_in")
    )


def taken(epoch: int | None = None, size: str = "size", max_epochs: int = MAX_EPOCHS) -> Column:
    """Tokens that the mix takes of a row in one epoch, or in all of them."""
    if epoch is None:
        return sum((taken(e, size) for e in range(max_epochs)), F.lit(0).cast("long"))
    left = F.col("budget") - F.col("source_size") * epoch - F.col("before")
    return F.greatest(F.lit(0).cast("long"), F.least(F.col(size), left))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th word, its white space kept."""
    pieces = F.split(F.regexp_replace(text, "^[\\x20\\x09-\\x0D]+", ""), _BEFORE_GAP)
    return F.array_join(F.slice(pieces, F.lit(1), n.cast("int")), "")


def mix(docs: DataFrame, text: str = "text", source: str = "source", key_columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The mixed corpus with the columns of ``docs``: one row per document and epoch that takes it.

    A document on a cut keeps its first words only. Null and empty texts have
    no words, so the mix never takes them. Null sources form a source of
    their own; an empty table gives an empty mix. Columns other than ``text``,
    ``source`` and ``n_chars`` pass through, whatever their names.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = packed.select("row", word_count(F.col("row")[text]).alias("size"), F.col("row")[source].alias("src"), *[F.col("row")[c].alias(f"k{i}") for i, c in enumerate(key_columns)])
    placed = assign(rows, [f"k{i}" for i in range(len(key_columns))], source="src")
    parts = F.filter(F.array(*[F.struct(F.lit(e).alias("epoch"), taken(e).alias("n")) for e in range(MAX_EPOCHS)]), lambda p: p["n"] > 0)
    out = placed.select("row", "size", F.explode(parts).alias("part"))
    cut = F.col("part.n") < F.col("size")
    new_text = F.when(cut, first_words(F.col("row")[text], F.col("part.n"))).otherwise(F.col("row")[text])
    out = out.withColumn("new_text", new_text)
    fields = []
    for c in docs.columns:
        value = F.col("row")[c]
        if c == text:
            value = F.col("new_text")
        elif c == "n_chars":
            value = F.when(cut, F.length("new_text").cast(docs.schema[c].dataType)).otherwise(value)
        fields.append(value.alias(c))
    return out.select(*fields)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size, its source's size and target, and the words that the mix takes of it."""
    docs = table(spark, sf_dir, "documents")
    rows = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-rows")
    return assign(rows, ["doc_id"]).select("doc_id", "size", "source_size", "target", taken().alias("taken"))


OP10_SQL = r"""
WITH r AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-0|' || coalesce(doc_id::VARCHAR, '\N')) AS k
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source),
s1 AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rk FROM s0),
s2 AS (
  SELECT *, CASE rk % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight FROM s1),
s3 AS (
  SELECT *, source_size::DOUBLE * 2.0::DOUBLE AS cap, source_size::DOUBLE * 2.0::DOUBLE / weight AS ratio FROM s2),
s4 AS (
  SELECT *, sum(source_size) OVER u AS capped, sum(weight) OVER u AS used,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM s3 WINDOW u AS (ORDER BY ratio, rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s5 AS (
  SELECT *, (total::DOUBLE * 1.5::DOUBLE - (capped - source_size)::DOUBLE * 2.0::DOUBLE) / (weights - (used - weight)) AS level
  FROM s4),
f AS (SELECT arg_min(level, ratio) AS final FROM s5 WHERE level <= ratio),
s6 AS (
  SELECT source, source_size, CASE WHEN final IS NULL THEN cap ELSE least(cap, weight * final) END AS target
  FROM s5 LEFT JOIN f ON true),
p AS (
  SELECT r.doc_id, r.size, s6.source_size, s6.target, floor(s6.target)::BIGINT AS budget,
         coalesce(sum(r.size) OVER (PARTITION BY r.source ORDER BY r.k, r.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM r JOIN s6 ON r.source IS NOT DISTINCT FROM s6.source)
SELECT doc_id, size, source_size, target,
       greatest(0, least(size, budget - before)) + greatest(0, least(size, budget - source_size - before)) AS taken
FROM p
"""
