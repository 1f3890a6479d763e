"""Chat formatting by prefix-target expansion.

Every assistant turn is an example row of its own: the formatted text of all
turns before it, which is its context, and its own turn, whose text alone is
trained on (the loss range). So the output grows with the square of a
conversation's length, as the method asks; it is written with zstd over pages
that hold many examples, so that shared contexts take little disk.

A conversation's turns are cut into parts of about ``PART_CHARS`` characters.
A part's turns are one row; the text of all parts before is joined to it by
part numbers, and examples are exploded from it last, so what is shuffled has
one context per part, and no task needs a whole conversation's examples. An
example is one string, so a conversation is bounded by 2 GB.

Template: ``<|turn|>role<|text|>text<|end|>`` and a newline. In roles and
texts, a backslash is doubled and a control string gets a backslash behind its
first character; dropping each backslash that leads another character undoes
both.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..workspace import scratch_path
from .common import bounded_batches, materialize, table

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
#: Strings that never appear unescaped inside a role or text: the template's and those of common chat templates.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Turn numbers that share a partial sum of lengths.
TURN_RANGE = 1024
#: Characters of a conversation whose turns (by where they begin) are expanded together.
PART_CHARS = 1 << 16
#: Bytes of a page of the examples' file: examples of a page are compressed together.
PAGE_BYTES = 8 << 20
TRAINED_ROLE = "assistant"


def escape(value: Column) -> Column:
    """Reversibly keep control strings out of a string."""
    out = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(c[0] + "\\" + c[1:]))
    return out


def unescape(value: str) -> str:
    return re.sub(r"\\(.)", r"\1", value, flags=re.DOTALL)


def format_turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turn, place, formatted, begin, end, loss_begin, loss_end, replies_after)``, one row per turn.

    ``begin`` and ``end`` are code points of the conversation's formatted
    text; the loss range is null but for assistant turns; ``replies_after``
    counts the assistant turns behind. Turns are ordered by number (null
    first), then role and text, so ties have one order and repeated rows
    follow each other. Null roles and texts are empty; rows without a
    conversation id form one conversation of that id.
    """
    t = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    head, body = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)), escape(F.col("text"))
    t = t.withColumn("head_n", F.length(head).cast("long")).withColumn("body_n", F.length(body).cast("long"))
    t = t.withColumn("n", F.col("head_n") + F.col("body_n") + len(END)).withColumn("reply", (F.col("role") == TRAINED_ROLE).cast("long"))
    t = t.withColumn("range", F.floor(F.col("turn") / TURN_RANGE))
    # two-level prefix sums, so that a long conversation isn't one group
    sums = t.groupBy("conv_id", "range").agg(F.sum("n").alias("sum"), F.count("*").alias("m"), F.sum("reply").alias("replies"))
    ahead = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("range")).rowsBetween(W.unboundedPreceding, -1)
    onward = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("range")).rowsBetween(W.currentRow, W.unboundedFollowing)
    sums = sums.select(
        F.col("conv_id").alias("c"), F.col("range").alias("r"), F.sum("replies").over(onward).alias("onward"),
        F.coalesce(F.sum("sum").over(ahead), F.lit(0)).alias("offset"), F.coalesce(F.sum("m").over(ahead), F.lit(0)).alias("places"),
    )
    order = W.partitionBy("conv_id", "range").orderBy(F.asc_nulls_first("turn"), "role", "text")
    inside = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    t = t.withColumn("upto", F.sum("n").over(inside)).withColumn("nth", F.row_number().over(order)).withColumn("said", F.sum("reply").over(inside))
    t = t.join(sums, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("range").eqNullSafe(F.col("r")))
    begin = F.col("offset") + F.col("upto") - F.col("n")
    loss = begin + F.col("head_n")
    trained = F.col("reply") == 1
    return t.select(
        "conv_id", "turn", (F.col("places") + F.col("nth")).alias("place"), F.concat(head, body, F.lit(END)).alias("formatted"),
        begin.alias("begin"), (F.col("offset") + F.col("upto")).alias("end"),
        F.when(trained, loss).alias("loss_begin"), F.when(trained, loss + F.col("body_n")).alias("loss_end"),
        (F.col("onward") - F.col("said")).alias("replies_after"),
    )


def examples(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, context_chars, loss_begin, loss_end, end)``, one row per assistant turn.

    The example is the conversation's formatted text up to ``end``: all turns
    before (``context_chars``), then the turn itself, trained on its loss range.
    """
    rows = turns.where("loss_begin is not null")
    return rows.select("conv_id", F.col("place").alias("example"), F.col("begin").alias("context_chars"), "loss_begin", "loss_end", "end")


def example_rows(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, begin, text, loss_begin, loss_end)``: every example in full, and the turns that no example holds.

    ``turns`` is the output of ``format_turns``. An example has its assistant
    turn's place, begins at 0 and has a loss range. The turns behind a
    conversation's last assistant turn are rows without one, by parts; they
    have the place and begin of their first turn.
    """
    turn = F.struct("place", "begin", "end", "loss_begin", "loss_end", "replies_after", "formatted")
    parts = turns.groupBy("conv_id", F.floor(F.col("begin") / PART_CHARS).alias("part")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = parts.withColumn("said", F.array_join(F.transform("turns", lambda t: t["formatted"]), ""))
    # a part's context: the texts of all parts before
    later = turns.select("conv_id", F.floor(F.col("begin") / PART_CHARS).alias("part")).where("part > 0").distinct()
    later = later.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("part") - 1)).alias("before"))
    context = later.join(parts.select("conv_id", "part", "said"), F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("before") == F.col("part")))
    context = context.groupBy("c", "p").agg(F.sort_array(F.collect_list(F.struct("before", "said"))).alias("parts"))
    context = context.select("c", "p", F.array_join(F.transform("parts", lambda x: x["said"]), "").alias("context"))
    parts = parts.join(context, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")), "left")
    replies = F.filter("turns", lambda t: t["loss_begin"].isNotNull())
    rest = F.filter("turns", lambda t: t["loss_begin"].isNull() & (t["replies_after"] == 0))
    replies = F.transform(replies, lambda t: F.struct(t["place"].alias("place"), F.lit(0).cast("long").alias("begin"), t["end"].alias("end"), t["loss_begin"].alias("loss_begin"), t["loss_end"].alias("loss_end")))
    none = F.lit(None).cast("long")
    rest = F.transform(
        F.slice(rest, 1, 1),
        lambda t: F.struct(t["place"].alias("place"), t["begin"].alias("begin"), F.element_at("turns", -1)["end"].alias("end"), none.alias("loss_begin"), none.alias("loss_end")),
    )
    parts = parts.select("conv_id", F.coalesce("context", F.lit("")).alias("context"), "said", F.col("turns")[0]["begin"].alias("start"), F.explode(F.concat(replies, rest)).alias("x"))
    whole = F.concat("context", F.substring("said", F.lit(1), (F.col("x.end") - F.col("start")).cast("int")))
    behind = F.substring("said", (F.col("x.begin") - F.col("start") + 1).cast("int"), (F.col("x.end") - F.col("x.begin")).cast("int"))
    return parts.select(
        "conv_id", "x.place", "x.begin", F.when(F.col("x.loss_begin").isNotNull(), whole).otherwise(behind).alias("text"), "x.loss_begin", "x.loss_end"
    )


def expand(turns: DataFrame) -> DataFrame:
    """``(conv_id, example, text, loss_begin, loss_end)``: every example in full, from the output of ``format_turns``."""
    return example_rows(turns).where("loss_begin is not null").select("conv_id", F.col("place").alias("example"), "text", "loss_begin", "loss_end")


def write_examples(turns: DataFrame, path: str) -> None:
    """Write ``example_rows``; examples of a conversation lie together, so that their shared contexts compress."""
    example_rows(turns).write.option("compression", "zstd").option("parquet.page.size", PAGE_BYTES).parquet(path)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    head, _, rest = formatted.removeprefix(TURN).partition(TEXT)
    return unescape(head), unescape(rest.removesuffix(END))


_OUT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by conversation and place; a conversation streams through, whatever its length."""
    current, state = None, None

    def done() -> list:
        n, turns, chars, loss, total = state
        return [current, n, turns.hexdigest(), chars, loss.hexdigest(), total]

    def rows_out(rows: list[list]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    for batch in batches:
        out = []
        cols = [batch.column(c).to_pylist() for c in ("conv_id", "formatted", "begin", "end", "loss_begin", "loss_end")]
        for conv, formatted, begin, end, lo, hi in zip(*cols, strict=True):
            if state is None or conv != current:
                if state is not None:
                    out.append(done())
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            role, text = parse_turn(formatted)
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            if lo is not None:
                masked = unescape(formatted[lo - begin : hi - begin])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += end
        if out:
            yield rows_out(out)
    if state is not None:
        yield rows_out([done()])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """What a written output says of each conversation: turns, loss text, and the length of all its examples."""
    bounded_batches(spark)
    turns = spark.read.parquet(path).repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return turns.select("conv_id", "formatted", "begin", "end", "loss_begin", "loss_end").mapInArrow(_digests, _OUT)


_FRESH = "conv_id long, place long, n long, sha256 string, fresh string, loss string"


def fresh_from(text: str, loss_begin: int) -> int:
    """Where the turns of an example that follow its last earlier assistant turn begin."""
    start = text.rfind(TURN, 0, loss_begin)
    while start > 0:
        before = text.rfind(TURN, 0, start)
        if text.startswith(TURN + TRAINED_ROLE + TEXT, before):
            break
        start = before
    return start


def _fresh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row: its length, digest, the turns that no example before it holds, and its reply."""
    for batch in batches:
        n, sha, fresh, loss = [], [], [], []
        for text, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("text", "loss_begin", "loss_end")), strict=True):
            n.append(len(text))
            sha.append(None if lo is None else hashlib.sha256(text.encode()).hexdigest())
            fresh.append(text if lo is None else text[fresh_from(text, lo) :])
            loss.append(None if lo is None else unescape(text[lo:hi]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("place"), pa.array(n, pa.int64()), *(pa.array(x, pa.string()) for x in (sha, fresh, loss))],
            ["conv_id", "place", "n", "sha256", "fresh", "loss"],
        )


def _example_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows of ``_fresh`` sorted by conversation and place; an example that isn't all turns before and its own fails."""
    current, state, out = None, None, []

    def done() -> list:
        n, turns, chars, loss, total, _ = state
        return [current, n, turns.hexdigest(), chars, loss.hexdigest(), total]

    def rows_out() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for batch in batches:
        out = []
        for conv, place, n, sha, fresh, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or conv != current:
                if state is not None:
                    out.append(done())
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, hashlib.sha256()]
            for turn in fresh.split(TURN)[1:]:
                role, text = parse_turn(TURN + turn)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            state[5].update(fresh.encode())
            if sha is not None:
                if state[5].hexdigest() != sha:
                    raise ValueError(f"conversation {conv}: the example at place {place} is not its context and reply")
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += n
        if out:
            yield rows_out()
    if state is not None:
        out = [done()]
        yield rows_out()


def read_example_digests(spark: SparkSession, path: str) -> DataFrame:
    """What written examples say of each conversation: turns, loss text, and the length of all its examples.

    Every example is read in full where it lies; only its digest, reply and
    the turns new in it are shuffled, and each context is held against the
    conversation's turns so far.
    """
    bounded_batches(spark)
    rows = spark.read.parquet(path).select("conv_id", "place", "text", "loss_begin", "loss_end").mapInArrow(_fresh, _FRESH)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_example_digests, _OUT)


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings: every example written in full and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    path = scratch_path(spark, "chat")
    write_examples(materialize(format_turns(rows.unionByName(extra)), "chat-turns"), path)
    return read_example_digests(spark, path)


OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, replace(replace(replace(replace(replace(replace(replace(replace(replace(role || '<|text|>' || text, '<|text|>', chr(1)),
    '\', '\\'), '<|', '<\|'), '|>', '|\>'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '<<SYS>>', '<\<SYS>>') AS x
  FROM t),
f AS (SELECT *, length('<|turn|>') + length(replace(replace(x, '<</SYS>>', '<\</SYS>>'), chr(1), '<|text|>')) + length('<|end|>') + 1 AS n FROM e),
g AS (SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto FROM f)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""
