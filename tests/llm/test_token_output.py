import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import docs_table

from spoolwire.llm import repair, token_output
from spoolwire.llm.common import utf8
from spoolwire.llm.token_units import UnitEncoder, load
from spoolwire.workspace import scratch_path


@pytest.fixture(scope="module")
def tok():
    return load(token_output.default_tokenizer())


def test_units_equal_whole_texts(tok):
    rng = random.Random(1)
    parts = ["a", "b", "Z", " ", "  ", "\n", "\t", ".", ",", "'s", "'", "é", "ç", "1", "23", " ", "　", "<|endoftext|>", "!", "'re", " the", "漢", " ", "\x85", "\x1c", "😀"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + [""]
    encoder = UnitEncoder(token_output.default_tokenizer())
    for lo in range(0, len(texts), 500):
        batch = texts[lo : lo + 500]
        ids, bounds = encoder.encode(*utf8(pa.array(batch)))
        for i, t in enumerate(batch):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids


class _Noted:
    """A tokenizer that notes how many tokens a call returns."""

    def __init__(self, tok, calls):
        self.tok, self.calls = tok, calls

    def __getattr__(self, name):
        return getattr(self.tok, name)

    def encode_batch_fast(self, texts, **how):
        found = self.tok.encode_batch_fast(texts, **how)
        self.calls.append(sum(len(e.ids) for e in found))
        return found


def test_the_library_holds_few_tokens_at_once(tok):
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefghijklmnop", k=7)) + str(rng.randrange(10**6)) for _ in range(60_000))
    encoder, calls = UnitEncoder(token_output.default_tokenizer()), []
    encoder.tok, encoder.lines = _Noted(encoder.tok, calls), (_Noted(encoder.lines[0], calls), encoder.lines[1])
    ids, _ = encoder.encode(*utf8(pa.array([text])))
    assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids
    assert sum(calls) > 300_000 and max(calls) < 100_000


_AFTER_A_TASK = """
import ctypes, re, sys, random
import pyarrow as pa
from spoolwire.llm import token_output
def mb():
    return sum(map(int, re.findall("Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024
class Task:
    partitionId = staticmethod(lambda: 0)
token_output.TaskContext.get = staticmethod(lambda: Task)
rng = random.Random(3)
def batches():
    for k in range(2):
        words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(150_000)]
        yield pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array([" ".join(words[i::100]) for i in range(100)])], ["id", "text"])
def task():
    for _ in token_output._write(None)(batches()):
        pass
    ctypes.CDLL(None).malloc_trim(0) if "trim" in sys.argv else None
    pa.default_memory_pool().release_unused() if "trim" in sys.argv else None
    return mb()
print(task())
"""


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_worker_gives_memory_back_after_its_task():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    run = lambda *a: float(subprocess.run([sys.executable, "-c", _AFTER_A_TASK, *a], cwd=root, env=os.environ | {"PYTHONPATH": root}, capture_output=True, text=True, check=True, timeout=300).stdout)
    assert run() - run("trim") < 25


@pytest.mark.parametrize("n", [0, 1, 5, 5000])
def test_repair_round_trip_and_random_access(n):
    rng = np.random.default_rng(n)
    words = [rng.integers(0, 900, rng.integers(1, 6)) for _ in range(40)]
    ids = np.concatenate([words[i] for i in rng.integers(0, 40, n)])[:n] if n else np.zeros(0, np.int64)
    bounds = np.sort(np.concatenate([[0, len(ids)], rng.integers(0, len(ids) + 1, 7)]))
    shard = repair.Shard(repair.pack(ids, bounds, 1000))
    assert np.array_equal(shard.ids(), ids)
    for lo, hi in np.sort(rng.integers(0, len(ids) + 1, (50, 2)), axis=1).tolist():
        assert np.array_equal(shard.ids(lo, hi), ids[lo:hi])
    for i in range(len(bounds) - 1):
        assert np.array_equal(shard.document(i), ids[bounds[i] : bounds[i + 1]])
    if n == 5000:
        assert len(shard.rules) and len(shard.symbols) < len(ids) / 2


def test_repeats_compress():
    ids = np.zeros(10_000, np.int64)
    shard = repair.Shard(repair.pack(ids, np.array([0, len(ids)]), 10))
    assert np.array_equal(shard.ids(17, 9000), ids[17:9000]) and len(shard.symbols) < 100


def test_late_rounds_look_only_where_pairs_can_be(monkeypatch):
    rng = np.random.default_rng(2)
    phrases = [rng.integers(0, 20_000, 40) for _ in range(300)]
    ids = np.concatenate([x for i in rng.integers(0, 300, 600) for x in (phrases[i], rng.integers(0, 20_000, 60))] + [np.tile(phrases[0], 20)])
    looked, frequent = [], repair._frequent

    def noted(key, limit):
        looked.append(len(key))
        return frequent(key, limit)

    monkeypatch.setattr(repair, "_frequent", noted)
    monkeypatch.setattr(repair, "ROUND_PAIRS", 20_000)
    shard = repair.Shard(repair.pack(ids, np.array([0, len(ids)]), 20_000))
    assert np.array_equal(shard.ids(), ids)
    # no frequent pair is left, wherever it may be
    left = shard.symbols.astype(np.int64)
    assert np.unique(left[:-1] << 32 | left[1:], return_counts=True)[1].max() < repair.MIN_COUNT
    assert looked[0] == len(ids) - 1 and len(looked) > 3 and max(looked[1:]) < len(ids) / 3


def test_words_of_all_letters_equal_whole_texts(tok):
    rng = random.Random(4)
    letters = [chr(c) for c in [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250), *range(0x400, 0x460)] if chr(c).isalpha()]
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 9))) for _ in range(rng.randint(1, 200))) for _ in range(300)]
    encoder = UnitEncoder(token_output.default_tokenizer())
    ids, bounds = encoder.encode(*utf8(pa.array(texts)))
    for i, t in enumerate(texts):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_written_shards(spark, tok, monkeypatch):
    rows = [(i, f"text {i} of the corpus, with words. " * (i % 9), "en", "s") for i in range(60)]
    rows += [(60, None, None, None), (61, "", "en", "s"), (7, "other text", "en", "s"), (8, rows[8][1], "en", "s"), (None, "no id", "en", "s"), (-4, "long " * 30_000, "en", "s")]
    monkeypatch.setattr(token_output, "SHARD_IDS", 200)
    path = scratch_path(spark, "shards")
    token_output.write_shards(docs_table(spark, rows), path)
    want = {}
    for i, t, *_ in rows:
        want.setdefault(i, []).append([*tok.encode(t or "", add_special_tokens=False).ids, 0])
    got = {}
    for r in token_output.read_ids(spark, path).collect():
        got.setdefault(r["doc_id"], []).append(r["ids"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    digests = token_output.read_digests(spark, path).orderBy("start").collect()
    order = [r["doc_id"] for r in digests]
    assert order == sorted(order, key=lambda x: (x is not None, x))
    start = 0
    for r in digests:
        assert r["start"] == start
        start += r["n_tokens"]
        crcs = {zlib.crc32(np.array(x, "<u4").tobytes()) for x in want[r["doc_id"]]}
        assert r["ids_crc32"] in crcs


def test_empty(spark):
    assert token_output.write_and_digest(docs_table(spark, [])).count() == 0
