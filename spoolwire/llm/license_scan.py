"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

A template of m shingles belongs to the smallest power of two s with
``4 * s >= 1.25 * m``. Windows of 5 * s shingles start every s shingles, so any
run of 4 * s shingles lies within one. A window that holds the template with a
containment of at least ``CONTAINMENT`` then has a Jaccard similarity with it
of at least ``floor_similarity``; ``bands_for`` picks as many bands (of one
MinHash value each) as make a miss less likely than ``MISS``. Values of a
level come from those of the level below, as minima over two blocks.

Windows that share a band with a template are verified on their whole shingle
sets. The templates and their bands go to every task in blocks of
``BLOCK_WORDS`` words, so a single broadcast doesn't grow with their number; a
task scans each batch with one block after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import bounded_batches, table, utf8
from .licenses import TEMPLATES

WIDTH = 5
CONTAINMENT = 0.8
MISS = 1e-4
BLOCK_WORDS = 1 << 20
_BLOCKS = 5


def level_of(m: int) -> int:
    """log2 of the window stride for a template of ``m`` shingles."""
    return 0 if m <= 1 else max(0, math.ceil(math.log2(1.25 * m / 4)))


def floor_similarity(m: int, containment: float = CONTAINMENT) -> float:
    """Least Jaccard similarity of a window that contains so much of the template."""
    s = 1 << level_of(m)
    inside = math.ceil(containment * m)
    return inside / (_BLOCKS * s + m - inside)


def bands_for(sizes: list[int], miss: float = MISS) -> int:
    return max(math.ceil(math.log(miss) / math.log1p(-min(floor_similarity(m), 0.999))) for m in sizes)


def _permuted(sh: np.ndarray, band: int) -> np.ndarray:
    """The shingles under the band's permutation (top 32 bits of an odd multiple)."""
    return ((sh * np.uint64((0x9E3779B97F4A7C15 * (2 * band + 1)) % 2**64)) >> np.uint64(32)).astype(np.uint32)


def _shingled(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw, off = utf8(column)
    data = words.lower(raw)
    s, e, first = words.cut(data, off, words.ALNUM)
    return *words.shingles(words.hashes(data, s, e), first, WIDTH), np.diff(first)


class TemplateIndex:
    """Shingle sets of a block of templates, and their MinHash values by level and band."""

    def __init__(self, items: list[tuple[str, str]], bands: int, containment: float):
        self.bands, self.containment = bands, containment
        sh, bounds, _ = _shingled(pa.array([t for _, t in items], pa.string()))
        self.names, self.sets, self.level = [], [], []
        for (name, _), a, b in zip(items, bounds[:-1], bounds[1:], strict=True):
            if b > a:
                self.names.append(name)
                self.sets.append(np.unique(sh[a:b]))
                self.level.append(level_of(len(self.sets[-1])))
        self.keys = {
            (lv, k): np.array([_permuted(self.sets[i], k).min() for i in range(len(self.sets)) if self.level[i] == lv], np.uint32)
            for lv in set(self.level) for k in range(bands)
        }
        self.owners = {lv: [i for i in range(len(self.sets)) if self.level[i] == lv] for lv in set(self.level)}
        self.sorted_keys = {at: np.unique(keys) for at, keys in self.keys.items()}
        self.owners_of: dict[tuple[int, int], dict[int, list[int]]] = {at: {} for at in self.keys}
        for (lv, k), keys in self.keys.items():
            for i, key in zip(self.owners[lv], keys.tolist(), strict=True):
                self.owners_of[lv, k].setdefault(key, []).append(i)

    def scan(self, sh: np.ndarray, bounds: np.ndarray) -> list[list[tuple[str, int, int, float]]]:
        """``(name, first shingle, last shingle, containment)`` of every match of each document, by name and place."""
        n = np.diff(bounds)
        found: list[dict] = [{} for _ in range(len(n))]
        if not len(sh) or not self.sets:
            return [[] for _ in n]
        top = max(self.owners)
        counts, starts = [n], [bounds[:-1]]  # blocks of each document by level, and the first one's number
        for _ in range(top):
            counts.append(-(-counts[-1] // 2))
            starts.append(np.cumsum(counts[-1]) - counts[-1])
        candidates: dict[int, set[tuple[int, int]]] = {lv: set() for lv in self.owners}
        doc_of = {lv: np.repeat(np.arange(len(n)), counts[lv]) for lv in self.owners}
        last = {lv: (starts[lv] + counts[lv])[doc_of[lv]] for lv in self.owners}
        for band in range(self.bands):
            block = _permuted(sh, band)
            for lv in range(top + 1):
                if lv:  # minima over pairs of blocks, never across documents
                    k = np.arange(int(counts[lv].sum())) - np.repeat(starts[lv], counts[lv])
                    block = np.minimum.reduceat(block, np.repeat(starts[lv - 1], counts[lv]) + 2 * k)
                if lv not in self.owners:
                    continue
                # block minima that are a template's value: the windows that begin up to four blocks before
                keys, owned = self.sorted_keys[lv, band], self.owners_of[lv, band]
                light = np.zeros(1 << 16, bool)
                light[keys >> np.uint32(16)] = True
                at = np.flatnonzero(light[block >> np.uint32(16)])
                at = at[keys[np.minimum(np.searchsorted(keys, block[at]), len(keys) - 1)] == block[at]]
                for b, key in zip(at.tolist(), block[at].tolist(), strict=True):
                    low = max(int(starts[lv][doc_of[lv][b]]), b - _BLOCKS + 1)
                    for w in range(low, b + 1):  # the key is the window's minimum
                        if block[w : min(w + _BLOCKS, int(last[lv][b]))].min() == key:
                            candidates[lv].update((w, i) for i in owned[key])
        for lv, some in candidates.items():
            s = 1 << lv
            for w, i in sorted(some):
                doc = int(doc_of[lv][w])
                lo = int(bounds[doc]) + (w - int(starts[lv][doc])) * s
                part = sh[lo : min(lo + _BLOCKS * s, int(bounds[doc + 1]))]
                inside = np.flatnonzero(np.isin(part, self.sets[i]))
                share = len(np.unique(part[inside])) / len(self.sets[i])
                if share >= self.containment:
                    a, b = lo - int(bounds[doc]) + int(inside[0]), lo - int(bounds[doc]) + int(inside[-1])
                    runs = found[doc].setdefault(i, [])
                    if runs and a <= runs[-1][1]:  # windows over the same place
                        runs[-1] = (runs[-1][0], max(b, runs[-1][1]), max(share, runs[-1][2]))
                    else:
                        runs.append((a, b, share))
        return [sorted((self.names[i], *r) for i, runs in f.items() for r in runs) for f in found]


MATCHES_TYPE = "array<struct<license:string,first_word:long,end_word:long,containment:double>>"
_MATCHES = pa.list_(pa.struct([("license", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("containment", pa.float64())]))


def _scan(indexes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sh, bounds, n_words = _shingled(batch.column("text"))
            found: list[list[dict]] = [[] for _ in range(len(n_words))]
            for index in indexes:
                for rows, new, n in zip(found, index.value.scan(sh, bounds), n_words.tolist(), strict=True):
                    rows += [{"license": name, "first_word": a, "end_word": min(b + WIDTH, n), "containment": c} for name, a, b, c in new]
            out = [sorted(rows, key=lambda r: (r["license"], r["first_word"])) for rows in found]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(out, _MATCHES)], ["row", "text", "matches"])

    return run


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, text: str = "text", keep: tuple[str, ...] = ("doc_id",), containment: float = CONTAINMENT
) -> DataFrame:
    """``row`` (a struct of the ``keep`` columns), ``text`` and ``matches`` (license, word range, containment).

    Null and empty texts match nothing, and neither does a template without
    words; a template of fewer than five words is one shingle that matches
    texts of just those words. Equal texts have equal matches; kept columns
    may have any name.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    sh, bounds, n_words = _shingled(pa.array(list(templates.values()), pa.string()))
    sizes = [len(np.unique(sh[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b > a]
    bands = bands_for(sizes) if sizes else 1
    block = np.cumsum(n_words) // BLOCK_WORDS
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(text).cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, matches {MATCHES_TYPE}"
    items = list(templates.items())
    blocks = [[x for x, k in zip(items, block, strict=True) if k == b] for b in np.unique(block)]
    return rows.mapInArrow(_scan([spark.sparkContext.broadcast(TemplateIndex(x, bands, containment)) for x in blocks]), schema)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the licenses whose text it holds, and where (word ranges)."""
    out = scan_licenses(table(spark, sf_dir, "documents"))
    places = F.transform("matches", lambda m: F.concat_ws(":", m["license"], m["first_word"].cast("string"), m["end_word"].cast("string")))
    return out.select(
        "row.doc_id", F.size("matches").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["license"]))), ",").alias("licenses"),
        F.array_join(places, ",").alias("places"),
        F.array_max(F.transform("matches", lambda m: m["containment"])).alias("best_containment"),
    )
