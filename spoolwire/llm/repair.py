"""Re-Pair grammar compression of a sequence of ids, with random access.

Rounds replace the most frequent pairs of neighbouring symbols by new symbols
(nonterminals). A round takes up to ``ROUND_PAIRS`` pairs at once; where two
occurrences overlap, the left one wins. Rounds go on until no pair occurs
``MIN_COUNT`` times, where a rule no longer pays for itself, or there are
``MAX_RULES`` rules. Once a round has taken all frequent pairs, the next one
looks only where it can find others: at the places of those pairs and beside
the new symbols. The rules, the length that each
expands to, and the sequence that is left are stored; a sum of lengths at
every ``STEP``-th symbol finds the place of any id.

Layout of a shard, little-endian: the header ``MAGIC, base, n_ids, n_rules,
n_symbols, n_docs, symbol bytes``; rules (2 x u32); expansion lengths (u32);
sums (u64); document bounds (u64, n_docs + 1); symbols (u16 or u32).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"RPAIR001"
STEP = 1024
#: Pairs of a round: taking many at once costs little, as most of them don't touch each other.
ROUND_PAIRS = 4096
#: With the ids of a vocabulary of 50,257, symbols stay below 2 ** 16.
MAX_RULES = 15_000
#: A pair is replaced from so many places on: a rule takes 12 bytes, each place saves 2.
MIN_COUNT = 8
#: Slots of the table in which a round looks up its pairs; of pairs that share one, the most frequent is taken first.
_BITS = 17
_HEAD = struct.Struct("<8sQQQQQQ")


def _frequent(key: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Up to ``limit`` of the most frequent keys, ascending, and their counts."""
    s = np.sort(key)
    # of each frequent key all elements but the last ones
    k = s.take(np.flatnonzero(s[MIN_COUNT - 1 :] == s[: max(0, len(s) - MIN_COUNT + 1)]))
    if not len(k):
        return k, np.zeros(0, np.intp)
    first = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1])
    k, n = k[first], np.diff(first, append=len(k)) + MIN_COUNT - 1
    if len(k) > limit:
        least = np.partition(n, len(k) - limit)[len(k) - limit]
        above, level = np.flatnonzero(n > least), np.flatnonzero(n == least)
        top = np.sort(np.concatenate([above, level[: limit - len(above)]]))
        k, n = k[top], n[top]
    return k, n


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rules, lengths, symbols)``; symbol ``base + i`` stands for the pair ``rules[i]``."""
    narrow = base + MAX_RULES <= 1 << 16 and (not len(ids) or int(ids.max()) < base)
    symbol, kind, half = ("<u2", np.uint32, 16) if narrow else ("<u4", np.uint64, 32)
    spread, down = kind(0x9E3779B1 if narrow else 0x9E3779B97F4A7C15), kind(2 * half - _BITS)
    slots = lambda k: ((k * spread) >> down).astype(np.intp)
    seq = ids.astype(symbol)
    rules: list[np.ndarray] = []
    lengths = np.zeros(0, np.int64)
    n_rules = 0
    near = None  # places that hold every frequent pair, if not all places have to be looked at
    while len(seq) > 1 and n_rules < MAX_RULES:
        # two neighbours read as one number, the right one in its upper half
        if near is None:
            key = np.empty(len(seq) - 1, kind)
            key[0::2] = seq[: len(seq) & ~1].view(kind)
            key[1::2] = seq[1 : 1 + (len(seq) - 1 & ~1)].view(kind)
        else:
            key = seq[near].astype(kind) | seq[near + 1].astype(kind) << kind(half)
        limit = min(ROUND_PAIRS, MAX_RULES - n_rules)
        pairs, count = _frequent(key, limit)
        if not len(pairs):
            break
        table = np.full(1 << _BITS, -1, np.int16)
        rank = np.argsort(count, kind="stable")
        table[slots(pairs[rank])] = rank
        which = table.take(slots(key), mode="clip")
        at = np.flatnonzero(which >= 0)
        which = which[at]
        hit = np.flatnonzero(pairs.take(which, mode="clip") == key.take(at, mode="clip"))
        seen = at if near is None else near[at]  # all places of these pairs
        at, which = seen.take(hit, mode="clip"), which.take(hit, mode="clip")
        # in a run of overlapping occurrences every second one stays
        fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
        i = np.arange(len(at), dtype=np.int32)
        run = np.maximum.accumulate(i * fresh)
        keep = np.flatnonzero(((i ^ run) & 1) == 0)
        at, which = at.take(keep, mode="clip"), which.take(keep, mode="clip")
        used = np.bincount(which, minlength=len(pairs)) >= 2
        if not used[which].all():
            good = used[which]
            at, which = at[good], which[good]
        if not len(at):
            break
        new = pairs[used].astype(np.int64)
        ends = np.stack([new & ((1 << half) - 1), new >> half], axis=1)
        rules.append(ends)
        size = np.ones(ends.shape, np.int64)
        inner = ends >= base
        size[inner] = lengths[ends[inner] - base]
        lengths = np.concatenate([lengths, size.sum(axis=1)])
        seq[at] = (base + n_rules + np.cumsum(used) - 1)[which].astype(symbol)
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq = seq[stay]
        n_rules += len(new)
        if len(pairs) < limit:
            made = at - np.arange(len(at))
            near = np.concatenate([seen - np.searchsorted(at, seen), made, made - 1])
            near = np.unique(near[(near >= 0) & (near < len(seq) - 1)])
        else:
            near = None
    return (np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)), lengths, seq.astype(np.int64)


def pack(ids: np.ndarray, doc_bounds: np.ndarray, base: int) -> bytes:
    """A shard of documents' ids; document i has ``ids[doc_bounds[i]:doc_bounds[i + 1]]``."""
    rules, lengths, seq = compress(ids, base)
    width = 2 if base + len(rules) <= 1 << 16 and (not len(ids) or int(ids.max()) < 1 << 16) else 4
    size = np.ones(len(seq), np.int64)
    inner = seq >= base
    size[inner] = lengths[seq[inner] - base]
    sums = (np.cumsum(size) - size)[::STEP]
    head = _HEAD.pack(MAGIC, base, len(ids), len(rules), len(seq), len(doc_bounds) - 1, width)
    return b"".join([
        head, rules.astype("<u4").tobytes(), lengths.astype("<u4").tobytes(), sums.astype("<u8").tobytes(),
        np.asarray(doc_bounds).astype("<u8").tobytes(), seq.astype(f"<u{width}").tobytes(),
    ])


class Shard:
    """Reads a packed shard; ``ids(lo, hi)`` expands only the symbols that cover the range."""

    def __init__(self, blob: bytes):
        magic, self.base, self.n_ids, n_rules, n_symbols, n_docs, width = _HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a Re-Pair shard")
        at = _HEAD.size

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u4", 2 * n_rules).reshape(-1, 2).astype(np.int64)
        self.lengths = take("<u4", n_rules).astype(np.int64)
        self.sums = take("<u8", -(-n_symbols // STEP)).astype(np.int64)
        self.doc_bounds = take("<u8", n_docs + 1).astype(np.int64)
        self.symbols = take(f"<u{width}", n_symbols)
        self._expanded = None

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids ``lo`` to ``hi`` (exclusive)."""
        hi = self.n_ids if hi is None else hi
        if lo >= hi:
            return np.zeros(0, np.uint32)
        first = (int(np.searchsorted(self.sums, lo, side="right")) - 1) * STEP
        last = int(np.searchsorted(self.sums, hi, side="left")) * STEP
        begin = int(self.sums[first // STEP])
        seq = self.symbols[first:last].astype(np.intp)
        pool, start, size = self._expansions()
        n = size[seq]
        upto = np.cumsum(n)
        out = pool[np.repeat(start[seq] - (upto - n), n) + np.arange(int(upto[-1]))]
        return out[lo - begin : hi - begin]

    def _expansions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids that each symbol stands for: ``pool[start:start + size]``."""
        if self._expanded is None:
            total = np.cumsum(self.lengths)
            seq = np.arange(self.base, self.base + len(self.rules))
            while len(inner := np.flatnonzero(seq >= self.base)):
                grow = np.ones(len(seq), np.int64)
                grow[inner] = 2
                place = np.cumsum(grow) - grow
                out = np.empty(len(seq) + len(inner), np.int64)
                out[place] = seq
                pair = self.rules[seq[inner] - self.base]
                out[place[inner]], out[place[inner] + 1] = pair[:, 0], pair[:, 1]
                seq = out
            # an id stands for itself
            pool = np.concatenate([np.arange(self.base), seq]).astype(np.uint32)
            start = np.concatenate([np.arange(self.base), self.base + total - self.lengths])
            size = np.concatenate([np.ones(self.base, np.int64), self.lengths])
            self._expanded = pool, start.astype(np.int64), size.astype(np.int64)
        return self._expanded

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.doc_bounds[i]), int(self.doc_bounds[i + 1]))
