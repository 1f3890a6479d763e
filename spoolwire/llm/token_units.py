"""Encoding texts with the tokenizers library, each distinct piece of text once.

A byte-level BPE splits a text into pieces before merging, and merges never
cross them. Texts are cut at places that are always such a border (an ASCII
letter before any other ASCII byte, and a lone space between two characters
that aren't white space), so equal units have equal ids. Units are told apart
by 64-bit hashes; those not seen lately go to the library. Units that are
plainly one piece (a word of letters, with or without a space before it) go
many to a call, one to a line, and skip the library's search for pieces.
"""

from __future__ import annotations

import itertools
import json
import os

import numpy as np
import pyarrow as pa

from . import words

#: Plain units of a text that the library gets.
LINES = 64
#: Units that the library gets in one call: it holds about 100 bytes a token until their ids are taken over.
CALL_UNITS = 1 << 13
#: Units hashed, or turned into ids, at once; what that takes beside a batch doesn't grow with the batch.
RUN_UNITS = 1 << 16
#: Units that a worker remembers; when there are more, those met most often since the last time stay.
CACHE_UNITS = 1_500_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# 1: letters, 2: other ASCII bytes, 4: the rest, so that only a step from the first to the second is 1
_KIND = np.where(_LETTER, 1, np.where(np.arange(256) < 128, 2, 4)).astype(np.uint8)
# bytes beside which a space may stand next to other white space
_BLANK = np.arange(256) <= 0x20
_BLANK[0x7F] = True
_NEXT_BLANK = _BLANK.copy()
_NEXT_BLANK[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_PREV_LEAD = np.zeros(256, bool)
_PREV_LEAD[[0xC2, 0x80, 0x81, 0x9A]] = True


# bytes of characters that are letters: ASCII, and all that start with one of these
_WORD = _LETTER.copy()
_WORD[0x80:0xC0] = True
_WORD[[*range(0xC3, 0xC9), 0xD0, 0xD1]] = True


def _byte_letters() -> np.ndarray:
    """The character that stands for each byte in the vocabulary of a byte-level BPE: itself if it can be seen, else one from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = np.arange(256, dtype="<u2")
    hidden = np.setdiff1d(np.arange(256), seen)
    letters[hidden] = 0x100 + np.arange(len(hidden))
    return letters


_LETTERS = _byte_letters()
#: What stands for a line break.
_BREAK = chr(_LETTERS[0x0A])


def load(path: str):
    """The tokenizer of a file, one thread per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def line_encoder(path: str, tok):
    """An encoder of lines that are one piece each, in the letters of ``_LETTERS``, and the id that ends a line; None if the file splits texts otherwise.

    It shares the vocabulary and merges of ``tok``, the tokenizer of that file.
    """
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    pieces = said.get("pre_tokenizer") or {}
    plain = pieces.get("type") == "ByteLevel" and pieces.get("use_regex", True) and not pieces.get("add_prefix_space")
    if not plain or said.get("normalizer") or said["model"].get("type") != "BPE" or tok.token_to_id(_BREAK) is None:
        return None
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import Split

    lines = Tokenizer(tok.model)
    lines.pre_tokenizer = Split(_BREAK, "isolated")
    return lines, tok.token_to_id(_BREAK)


def unit_starts(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Start of each unit of a batch of texts; every text that isn't empty starts one."""
    if not len(raw):
        return np.zeros(0, np.int64)
    kind = _KIND[raw]
    cut = np.zeros(len(raw), bool)
    np.equal(kind[1:] - kind[:-1], 1, out=cut[1:])  # an ASCII byte after a letter
    space = np.flatnonzero(raw[1:-1] == 0x20) + 1
    prev, nxt = raw[space - 1], raw[space + 1]
    odd = (prev >= 0x80) & _PREV_LEAD[raw[np.maximum(space - 2, 0)]]
    cut[space[~_BLANK[prev] & ~_NEXT_BLANK[nxt] & ~odd]] = True
    cut[off[:-1][np.diff(off) > 0]] = True
    return np.flatnonzero(cut)


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``np.unique`` with indices: values in ascending order, a place of each, and the value's number of every element."""
    found = pa.array(h).dictionary_encode()
    values, number = found.dictionary.to_numpy(), found.indices.to_numpy()
    order = np.argsort(values)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    place = np.empty(len(values), np.intp)
    place[number] = np.arange(len(h))
    return values[order], place[order], rank[number]


def _gathered(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, after: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """The bytes of units, one after the other, ``after`` (at most a byte) behind each, and their offsets."""
    size = ends - starts + len(after)
    off = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(int(off[-1])) + np.repeat(starts - off[:-1], size)
    data = raw.take(place, mode="clip")
    if after:
        data[off[1:] - 1] = after[0]
    return data, off


class UnitEncoder:
    """Ids of texts by units; ``added`` strings (special tokens) send a text to the library as a whole."""

    def __init__(self, path: str):
        self.tok = load(path)
        self.lines = line_encoder(path, self.tok)
        self.added = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        most = max(self.tok.get_vocab(with_added_tokens=True).values(), default=0)
        self.kind = np.uint16 if most < 1 << 16 else np.uint32  # of a remembered id
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.count = np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)
        self.pool = np.zeros(0, self.kind)

    def _shrink(self, room: int) -> None:
        """Forget the units least used, so that at most half of the cache, and ``room`` below its size, stay."""
        stay = max(0, min(CACHE_UNITS // 2, CACHE_UNITS - room))
        if stay < len(self.keys):
            keep = np.sort(np.argpartition(-self.used, stay)[:stay])
            count = self.count[keep]
            total = np.cumsum(count, dtype=np.int64)
            place = np.repeat(self.at[keep] - (total - count), count) + np.arange(int(total[-1]) if stay else 0)
            self.pool, self.keys, self.count = self.pool[place], self.keys[keep], count
            self.at = (total - count).astype(np.int32)
        self.used = np.zeros(len(self.keys), np.int32)

    @staticmethod
    def _ids(tok, texts: list[str], at_once: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one after the other, and how many each has."""
        flat, count = [np.zeros(0, np.uint32)], []
        for lo in range(0, len(texts), at_once):
            ids = [e.ids for e in tok.encode_batch_fast(texts[lo : lo + at_once], add_special_tokens=False)]
            flat.append(np.fromiter(itertools.chain.from_iterable(ids), np.uint32))
            count += map(len, ids)
        return np.concatenate(flat), np.array(count, np.int64)

    def _plain(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Which units are one word of letters, with or without a space before it."""
        if self.lines is None or not len(data):
            return np.zeros(len(off) - 1, bool)
        odd = ~_WORD[data]
        mark = np.flatnonzero(data[:-1] == 0xC3)
        odd[mark[np.isin(data[mark + 1], (0x97, 0xB7))]] = True  # the signs of multiplication and division
        odds = np.concatenate([[0], np.cumsum(odd)])
        begin = off[:-1] + (data[off[:-1]] == 0x20)
        return (off[1:] > begin) & (odds[off[1:]] == odds[begin])

    def _learn(self, keys: np.ndarray, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Ids of new units, from the library."""
        data, off = _gathered(raw, starts, ends)
        plain = self._plain(data, off)
        count = np.zeros(len(keys), np.int32)
        at = np.zeros(len(keys), np.int32)
        pools = [self.pool]
        size = len(self.pool)
        for which, encode in ((np.flatnonzero(plain), self._line_ids), (np.flatnonzero(~plain), self._unit_ids)):
            if len(which):
                flat, n = encode(data, off[:-1][which], off[1:][which])
                count[which], at[which] = n, size + np.cumsum(n) - n
                size += len(flat)
                pools.append(flat.astype(self.kind))
        self.pool = np.concatenate(pools)
        where = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, where, keys)
        self.at, self.count = np.insert(self.at, where, at), np.insert(self.count, where, count)
        self.used = np.insert(self.used, where, 0)

    def _line_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        tok, end = self.lines
        lines, off = _gathered(data, starts, ends, b"\n")
        whole = _LETTERS[lines].tobytes()  # two bytes a letter
        cuts = [*(2 * off[:-1:LINES]).tolist(), len(whole)]
        texts = [whole[a:b].decode("utf-16-le") for a, b in itertools.pairwise(cuts)]
        ids, _ = self._ids(tok, texts, CALL_UNITS // LINES)
        stops = np.flatnonzero(ids == end)
        return ids[ids != end], np.diff(stops, prepend=-1) - 1

    def _unit_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole = data.tobytes()
        return self._ids(self.tok, [whole[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], CALL_UNITS)

    def _unknown(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] != keys

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: text i has ``ids[bounds[i]:bounds[i + 1]]``."""
        starts = unit_starts(raw, off)
        ends = np.append(starts[1:], len(raw))
        runs = [slice(a, a + RUN_UNITS) for a in range(0, len(starts), RUN_UNITS)]
        h = np.zeros(len(starts), np.uint64)
        for r in runs:
            lo, hi = starts[r][0], ends[r][-1]
            h[r] = words.hashes(raw[lo:hi], starts[r] - lo, ends[r] - lo)
        distinct, first, back = _distinct(h)
        new = self._unknown(distinct)
        if len(self.keys) + int(new.sum()) > CACHE_UNITS:
            self._shrink(len(distinct))
            new = self._unknown(distinct)
        if new.any():
            self._learn(distinct[new], raw, starts[first[new]], ends[first[new]])
        del h, ends, first
        k = np.searchsorted(self.keys, distinct)
        self.used[k] += 1
        count, at = self.count[k][back], self.at[k][back]
        total = np.cumsum(count, dtype=np.int64)
        ids = np.empty(int(total[-1]) if len(total) else 0, np.uint32)
        for r in runs:
            n, upto = count[r], total[r]
            lo, hi = int(upto[0] - n[0]), int(upto[-1])
            ids[lo:hi] = self.pool[np.repeat(at[r] - (upto - n), n) + np.arange(lo, hi)]
        unit_bounds = np.searchsorted(starts, off)
        bounds = np.concatenate([[0], total])[unit_bounds]
        data = raw.tobytes() if self.added else b""
        for mark in self.added:
            if mark in data:
                return self._whole(data, off, ids, bounds)
        return ids, bounds

    def _whole(self, data: bytes, off: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        for i, (a, b) in enumerate(zip(off[:-1], off[1:], strict=True)):
            text = data[a:b]
            if any(mark in text for mark in self.added):
                parts[i] = self._ids(self.tok, [text.decode()], 1)[0]
        return np.concatenate([np.zeros(0, np.uint32), *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
