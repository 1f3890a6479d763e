"""N-gram Jaccard join of whole documents by a grouped prefix join.

1. Shingle counts of all texts give the hot shingles, which come last in the
   order of shingles (any total order is right; a rare-first one is fast).
2. Each document's set is ordered; its first ``n - ceil(t * n) + 1`` shingles
   are its prefix. Documents with the same prefix and size form one group, and
   only groups enter the index. Linked documents share a prefix shingle.
3. In each index list (the groups with one prefix shingle) groups without a
   partner of fitting size are dropped; the rest expand to their members
   (classes of equal sets).
4. Members are verified on their whole sets, first along stars (each member
   with one pivot of its first list, then one per component of each list),
   last every remaining pair of a list whose ends are not yet connected and
   whose sizes and prefix positions allow a link. So no list emits all its
   pairs, and no link between components is lost. This serves components;
   ``jaccard_links`` verifies every pair of a list and returns all links.

Lists longer than ``LIST_ROWS`` are cut into blocks, and each pair of blocks
is a unit of its own, so that no list has to fit one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import bounded_batches, discard, materialize, table, utf8
from .components import components

WIDTH = 5
#: A link has PERCENT * union <= 100 * intersection.
PERCENT = 80
#: Shingles sorted at once when counting, the least count in such a run, and the most shingles kept as hot.
RUN = 1 << 21
RUN_MIN = 3
HOT_MAX = 1 << 18
#: Prefix groups that a task remembers, to index each only once.
SEEN_MAX = 1 << 20
#: Members of an index list that one task compares at once.
LIST_ROWS = 20_000

_U = np.uint64


def doc_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, off = utf8(column)
    data = words.lower(raw)
    s, e, first = words.cut(data, off, words.SPACED)
    sh, bounds = words.shingles(words.hashes(data, s, e), first, width)
    return [np.unique(sh[bounds[i] : bounds[i + 1]]) for i in range(len(off) - 1)]


def prefix_length(n: np.ndarray | int, percent: int = PERCENT):
    """Shingles of which a linked pair shares at least one."""
    return n - -(-percent * n // 100) + 1


def _count_runs(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def flush():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            keep = c >= RUN_MIN
            return pa.RecordBatch.from_arrays([pa.array(h[keep].view(np.int64)), pa.array(c[keep].astype(np.int64))], ["token", "n"])

        for batch in batches:
            for x in doc_sets(batch.column(0), width):
                key = int(x.sum())
                if not len(x) or key in seen:
                    continue
                if len(seen) < SEEN_MAX:
                    seen.add(key)
                held.append(x)
                size += len(x)
                if size >= RUN:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return run


def hot_shingles(docs: DataFrame, text: str, width: int = WIDTH) -> np.ndarray:
    """Up to ``HOT_MAX`` of the most frequent shingles, rarest first.

    A shingle counts where it recurs within a run of ``RUN`` shingles. Only
    the order of shingles depends on the counts, never the result.
    """
    found = docs.select(text).mapInArrow(_count_runs(width), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    made: list[str] = []
    found = materialize(found, "hot-shingles", made)
    level = F.floor(F.log2("n") * 8).cast("int")
    steps = found.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # a few hundred levels at most
    least, total = 1 << 30, 0
    for r in steps:
        total += r["count"]
        if total > HOT_MAX:
            break
        least = r["level"]
    rows = found.where(level >= least).orderBy("n", "token").toPandas()  # at most HOT_MAX rows
    discard(docs.sparkSession, made)
    return rows["token"].to_numpy(np.int64).view(np.uint64)


class _Order:
    """The order of shingles: others by hash, then the hot ones by rank."""

    def __init__(self, hot: np.ndarray):
        self.by_hash = np.argsort(hot, kind="stable")
        self.hot = hot[self.by_hash]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(self.hot >> _U(42)).astype(np.int64)] = True

    def sorted(self, x: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return x
        cand = np.flatnonzero(self.maybe[(x >> _U(42)).astype(np.int64)])
        if not len(cand):
            return x
        at = np.searchsorted(self.hot, x[cand])
        hit = self.hot[np.minimum(at, len(self.hot) - 1)] == x[cand]
        if not hit.any():
            return x
        cold = np.ones(len(x), bool)
        cold[cand[hit]] = False
        return np.concatenate([x[cold], x[cand[hit]][np.argsort(self.by_hash[at[hit]], kind="stable")]])


def _signatures(hot, width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = _Order(hot.value), set()
        for batch in batches:
            n, f1, f2, g, prefixes = [], [], [], [], []
            for x in doc_sets(batch.column(1), width):
                n.append(len(x))
                if not len(x):
                    f1.append(0), f2.append(0), g.append(None), prefixes.append(None)
                    continue
                f1.append(int(words.mix(x).sum().view(np.int64)))
                f2.append(int(words.mix(x ^ words._C1).sum().view(np.int64)))
                p = order.sorted(x)[: prefix_length(len(x), percent)]
                spread = words.mix(p + np.arange(len(p), dtype=np.uint64) * words._C2)
                group = int(words.mix(spread.sum(keepdims=True) + _U(len(x)))[0].view(np.int64))
                g.append(group)
                prefixes.append(None if group in seen else p.view(np.int64))
                if len(seen) < SEEN_MAX:
                    seen.add(group)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(g, pa.int64()), pa.array(prefixes, pa.list_(pa.int64()))],
                ["doc_id", "n", "f1", "f2", "g", "prefix"],
            )

    return run


def _with_partner(percent: int):
    """Of rows sorted by token, size and group: one per token and group, if a neighbour's size fits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, fits = None, False  # the last row, and whether its predecessor fits
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate([[h], c]) for h, c in zip(held, cols, strict=True)]
            same = cols[0][1:] == cols[0][:-1]
            fresh = np.concatenate([[True], ~(same & (cols[1][1:] == cols[1][:-1]))])
            cols = [c[fresh] for c in cols]
            token, _, n, _ = cols
            ok = (token[1:] == token[:-1]) & (100 * n[:-1] >= percent * n[1:])
            keep = np.concatenate([[fits], ok])
            keep[:-1] |= ok
            fits, held = bool(keep[-1]), [c[-1] for c in cols]
            out = keep[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(c[:-1][out]) for c in cols], ["token", "g", "n", "pos"])
        if held is not None and fits:
            yield pa.RecordBatch.from_arrays([pa.array([h]) for h in held], ["token", "g", "n", "pos"])

    return run


def _cross_pairs(percent: int):
    """Of rows sorted by list (token and pair of blocks) and size: pairs of members of different components that may be linked."""

    def pairs(rows: list[np.ndarray], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        """All lists of ``rows`` at once: every row against the one ``d`` places on, while that is in its list and not too large."""
        _, i, j, node, n, pos, comp, block = rows
        live, d, a, b, held = np.arange(len(node)), 0, [], [], 0
        while True:
            d += 1
            live = live[live + d < ends[live]]
            live = live[100 * n[live] >= percent * n[live + d]]
            if not len(live):
                break
            other = live + d
            need = -(-percent * (n[live] + n[other]) // (100 + percent))
            ok = (comp[live] != comp[other]) & (1 + np.minimum(n[live] - pos[live], n[other] - pos[other]) >= need)
            ok &= (i[live] == j[live]) | (block[live] != block[other])
            p, q = node[live[ok]], node[other[ok]]
            a.append(np.minimum(p, q)), b.append(np.maximum(p, q))
            held += len(p)
            if held >= 1 << 18:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                a, b, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the rows of a list that may go on
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(8)]
            if not len(cols[0]):
                continue
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols, strict=True)]
            change = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
            cuts = np.flatnonzero(change) + 1
            last = int(cuts[-1]) if len(cuts) else 0
            if last:
                bounds = np.concatenate([[0], cuts])
                yield from pairs([c[:last] for c in cols], np.repeat(cuts, np.diff(bounds)))
            held = [c[last:] for c in cols]
        if held is not None:
            yield from pairs(held, np.full(len(held[0]), len(held[0])))

    return run


def _linked(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (x, y) in enumerate(zip(doc_sets(batch.column(2), width), doc_sets(batch.column(3), width), strict=True)):
                both = np.sort(np.concatenate([x, y]), kind="stable")
                inter = int((both[1:] == both[:-1]).sum())
                if inter and 100 * inter >= percent * (len(both) - inter):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).take(pa.array(keep, pa.int64()))

    return run


def _index(
    docs: DataFrame, id_col: str, text: str, width: int, percent: int, kept: list[str], made: list[str]
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, classes of equal sets, index lists of the classes that may have a partner, and those classes' texts.

    The paths of the first two are added to ``kept``, those of the others to ``made``.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    hot = spark.sparkContext.broadcast(hot_shingles(docs, "text", width))  # at most HOT_MAX hashes
    sigs = materialize(
        docs.mapInArrow(_signatures(hot, width, percent), "doc_id long, n long, f1 long, f2 long, g long, prefix array<long>"), "signatures", kept
    )
    classes = materialize(
        sigs.where("n > 0 and doc_id is not null").groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("node"), F.min("g").alias("g")), "classes", kept
    )
    # index of the groups, then of the members of those that may have a partner
    index = sigs.where("prefix is not null").select("g", "n", F.posexplode("prefix").alias("pos", "token"))
    index = index.select("token", "g", "n", (F.col("pos") + 1).cast("long").alias("pos")).repartition("token").sortWithinPartitions("token", "n", "g")
    index = index.mapInArrow(_with_partner(percent), "token long, g long, n long, pos long")
    alike = classes.groupBy("g").agg(F.count("*").alias("m")).where("m > 1").select("g")
    members = index.join(classes.select("g", "node"), "g").select("token", "node", "n", "pos")
    within = classes.join(alike, "g").select(F.col("g").alias("token"), "node", "n", F.lit(1).cast("long").alias("pos"))
    lists = materialize(members.unionByName(within), "lists", made)
    needed = lists.select(F.col("node").alias("doc_id")).distinct()
    texts = materialize(docs.join(needed, "doc_id", "left_semi").select(F.col("doc_id").alias("node"), "text"), "texts", made)
    return sigs, classes, lists, texts


def _verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int, label: str, made: list[str]) -> DataFrame:
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    both = both.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb")
    return materialize(both.mapInArrow(_linked(width, percent), "u long, v long"), label, made)


def _list_pairs(marked: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of a list of ``marked`` whose ``comp`` differs and that may be linked; ``sizes`` has the lists and their rows ``m``."""
    blocks = F.ceil(F.col("m") / LIST_ROWS).cast("int")
    rest = marked.join(sizes.select("token", blocks.alias("blocks")), "token")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = rest.select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "n", "pos", "comp", "block")
    rest = rest.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n")
    return rest.mapInArrow(_cross_pairs(percent), "a long, b long").distinct()


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(a, b)``: every verified link between two classes, by ``class_id``, smaller first.

    Documents are as in ``jaccard_components``, whose ``class_id`` is the
    membership: rows of one class link with each other, and rows of linked
    classes all do. Every pair of an index list whose sizes and prefix
    positions allow a link is verified, in a component or not, so the output
    (and work) grows with the number of links. Rows that share an id are one
    document: a link of one of its texts is a link of that ``class_id``.
    """
    made: list[str] = []
    _, _, lists, texts = _index(docs, id_col, text, width, percent, made, made)
    marked = lists.withColumn("comp", F.col("node"))
    sizes = lists.groupBy("token").agg(F.count("*").alias("m")).where("m > 1")
    links = _verified(_list_pairs(marked, sizes, percent), texts, width, percent, "links", [])
    discard(docs.sparkSession, made)
    return links.select(F.col("u").alias("a"), F.col("v").alias("b")).distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, class_id)``, one row per row of ``docs``.

    Two documents link when ``100 * |A & B| >= percent * |A | B|`` over their
    sets of lower-cased ``width``-word shingles. ``class_id`` is the smallest
    id with the same set, ``component_id`` the smallest reachable by links.

    Null and empty texts have no shingle, link with nothing and are their own
    component; a text of fewer than ``width`` words is one shingle. Rows that
    share an id are one document with each of their texts. Rows without an id
    have null components and link nothing. Texts of any length count in whole,
    and an empty table gives an empty one. Only the two named columns are read,
    so other columns may have any name.
    """
    return _components(docs, id_col, text, width, percent, [])


def _components(docs: DataFrame, id_col: str, text: str, width: int, percent: int, kept: list[str]) -> DataFrame:
    """``jaccard_components``, with the paths of tables that the result reads added to ``kept``; the others go as soon as they aren't needed."""
    made: list[str] = []
    sigs, classes, lists, texts = _index(docs, id_col, text, width, percent, kept, made)

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        return _verified(pairs, texts, width, percent, label, made)

    def labelled(links: DataFrame) -> DataFrame:
        return lists.join(components(links).withColumnRenamed("component", "c"), "node", "left").select(
            "token", "node", "n", "pos", F.coalesce("c", "node").alias("comp")
        )

    # rows that share an id are one document: all classes of its texts are linked through the id
    ids = sigs.where("n > 0 and doc_id is not null").join(classes.select("n", "f1", "f2", "node"), ["n", "f1", "f2"])
    ids = materialize(ids.select("doc_id", "node"), "ids", made)
    several = ids.groupBy("doc_id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("doc_id")
    links = ids.join(several, "doc_id").where("doc_id <> node").select(F.col("node").alias("u"), F.col("doc_id").alias("v")).distinct()

    # stars: each member with the smallest of its first list
    first = lists.groupBy("node", "n").agg(F.min(F.struct("pos", "token")).alias("f")).select("node", "n", F.col("f.token").alias("token"))
    pivot = first.groupBy("token").agg(F.min(F.struct("node", "n")).alias("p"))
    star = first.join(pivot, "token").where(
        (F.col("node") != F.col("p.node")) & (F.least("n", "p.n") * 100 >= F.greatest("n", "p.n") * percent)
    )
    links = links.unionByName(verified(star.select(F.col("p.node").alias("a"), F.col("node").alias("b")).distinct(), "star"))
    # stars over the components of each list
    reps = labelled(links).groupBy("token", "comp").agg(F.min(F.struct("node", "n")).alias("r"))
    pivot = reps.groupBy("token").agg(F.min("r").alias("p"), F.count("*").alias("m")).where("m > 1")
    star = reps.join(pivot, "token").where((F.col("r.node") != F.col("p.node")) & (F.least("r.n", "p.n") * 100 >= F.greatest("r.n", "p.n") * percent))
    links = links.unionByName(verified(star.select(F.col("p.node").alias("a"), F.col("r.node").alias("b")).distinct(), "star"))
    # what is left: pairs of a list whose ends are in different components
    marked = materialize(labelled(links), "marked", made)
    open_lists = marked.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m")).where("lo <> hi")
    cross = _list_pairs(marked, open_lists, percent)
    links = links.unionByName(verified(cross, "cross"))
    comps = components(links)
    discard(docs.sparkSession, made)

    named = classes.withColumnRenamed("node", "cls").join(comps.select(F.col("node").alias("cls"), "component"), "cls", "left")
    named = named.select("n", "f1", "f2", "cls", F.coalesce("component", "cls").alias("comp"))
    out = sigs.select("doc_id", "n", "f1", "f2").join(named, ["n", "f1", "f2"], "left")
    own = F.col("doc_id").isNotNull() & F.col("cls").isNull()
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(own, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("comp")).alias("component_id"),
        F.when(own, F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("cls")).alias("class_id"),
    )


#: Ids of several texts beyond which their table is joined as Spark chooses, not broadcast.
BROADCAST_IDS = 100_000
#: Rows of such ids are told apart by numbers from here on, above other ids.
OWN_IDS = 1 << 62


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` of every component of linked texts: that with the smallest id.

    Rows that share an id are documents of their own where their texts differ,
    so a text goes only if a row that it links with, directly or through
    others, stays; they come after rows whose id has one text, in an order by
    hash. Of rows with one id and one text the smallest by all columns
    stays; rows without an id all stay, and link with nothing. Texts without
    words stay. An empty table gives an empty one; column names are free.
    """
    h = F.xxhash64(F.col(f"`{text}`"))
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), h.alias("h")).where("id is not null")
    shared = materialize(ids.groupBy("id").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("id"), "shared-ids")
    n = shared.count()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(f"`{id_col}`").cast("long").alias("own"), F.col(f"`{text}`").alias("text"))
    if n:
        several = shared.select(F.col("id").alias("own"), F.lit(True).alias("several"))
        rows = rows.join(F.broadcast(several) if n <= BROADCAST_IDS else several, "own", "left")
        other = F.xxhash64("own", "text").bitwiseAND(F.lit(OWN_IDS - 1)).bitwiseOR(F.lit(OWN_IDS))
        rows = rows.withColumn("own", F.when(F.col("several"), other).otherwise(F.col("own"))).drop("several")
    read: list[str] = []
    found = _components(rows, "own", "text", WIDTH, PERCENT, read).where("doc_id = component_id").select(F.col("doc_id").alias("own")).distinct()
    found = materialize(found, "representatives")  # one long each, in place of the tables it comes from
    discard(docs.sparkSession, read)
    kept = rows.join(found, "own", "left_semi").groupBy("own").agg(F.min("row").alias("row"))
    return kept.select("row.*").unionByName(docs.where(F.col(f"`{id_col}`").isNull()))


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set and the component of its links."""
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_id")


OP2_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) >= 5
      THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i+4], ' ')))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh
  FROM w),
n AS (SELECT doc_id, coalesce(len(sh), 0)::BIGINT AS n FROM s),
u AS MATERIALIZED (SELECT doc_id, unnest(sh) AS t FROM s),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM u a JOIN u b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * i >= 80 * (p.n + q.n - i)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
k AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x),
f AS (SELECT doc_id, n, (SELECT min(b.doc_id) FROM s b WHERE list_sort(b.sh) = list_sort(a.sh)) AS cls FROM n JOIN s a USING (doc_id))
SELECT n.doc_id, n.n AS n_shingles, k.component_id,
       CASE WHEN n.n = 0 THEN n.doc_id ELSE f.cls END AS class_id
FROM n JOIN k USING (doc_id) JOIN f USING (doc_id)
"""
