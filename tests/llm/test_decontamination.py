import random

from llm_helpers import alnum_words, docs_table

from spoolwire.llm import decontamination
from spoolwire.llm.decontamination import decontaminate, match_items
from spoolwire.llm.suffix_automaton import SuffixAutomaton


def brute(text, items, window=10):
    words = alnum_words(text)
    hit, found = set(), set()
    for name, item in items:
        w = alnum_words(item)
        m = min(window, len(w))
        grams = {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if w else set()
        for i in range(len(words) - m + 1):
            if tuple(words[i : i + m]) in grams:
                hit |= set(range(i, i + m))
                if name is not None:
                    found.add(name)
    return len(words), len(hit), sorted(found)


def test_automaton_lengths():
    rng = random.Random(1)
    items = [[rng.randrange(3) for _ in range(rng.randint(0, 14))] for _ in range(8)] + [[1], [0, 1, 2]]
    sam = SuffixAutomaton(items, 4)
    for _ in range(200):
        text = [rng.randrange(4) for _ in range(rng.randint(0, 25))]
        spans, found = sam.match(text)
        hit = set()
        want = set()
        for k, it in enumerate(items):
            m = min(4, len(it))
            for i in range(len(text) - m + 1):
                if m and any(text[i : i + m] == it[j : j + m] for j in range(len(it) - m + 1)):
                    hit |= set(range(i, i + m))
                    want.add(k)
        assert {p for a, b in spans for p in range(a, b)} == hit and found == want


def cases():
    rng = random.Random(2)
    v = [f"w{i}" for i in range(30)] + ["É", "x1"]
    items = [(i, " ".join(rng.choice(v) for _ in range(rng.randint(3, 30)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "short one"), (None, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11"), (53, items[0][1]), (0, items[0][1])]
    docs = []
    for i in range(80):
        words = [rng.choice(v) for _ in range(rng.randint(0, 60))]
        if i % 2:
            it = (rng.choice(items)[1] or "").split()
            cut = rng.randint(0, 4)
            words[len(words) // 2 : len(words) // 2] = it[cut:] if i % 4 == 1 else it
        docs.append((i, ", ".join(words).upper() if i % 3 == 0 else " ".join(words), "en", "s"))
    docs += [(90, None, None, None), (91, "", "en", "s"), (92, "q1 q2 q3 q4 q5 q6 q7 q8 q9 q10 q11", "en", "s"), (7, docs[7][1], "en", "s"), (None, docs[7][1], "en", "s")]
    docs += [(93, "pad " * 50_000 + items[1][1], "en", "s")]
    return docs, items


def test_against_brute_force_in_blocks(spark, monkeypatch):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [(None if i is None else str(i), t) for i, t in items]
    for size in (1 << 20, 400):  # one block, and several
        monkeypatch.setattr(decontamination, "BLOCK_CHARS", size)
        got = match_items(docs_table(spark, docs), bench, with_text=False).collect()
        want = {i: brute(t, named) for i, t, *_ in docs}
        assert len(got) == len(docs)
        for r in got:
            assert (r["n_words"], r["n_hit"], r["items"]) == want[r["row"]["doc_id"]]


def test_long_items_in_pieces_and_one_automaton_at_a_time(spark, monkeypatch):
    docs, items = cases()
    rng = random.Random(9)
    long_item = [f"w{rng.randrange(30)}" for _ in range(500)]
    items = [(i, t and t.title()) for i, t in items]
    items += [(60, " ".join(long_item).upper()), (61, " ".join(long_item)), (60, " ".join(long_item))]
    docs += [(100 + i, " ".join(["pad", *long_item[i * 40 : i * 40 + 90], "pad"]), "en", "s") for i in range(11)]
    docs += [(120, " ".join(long_item), "en", "s")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [(None if i is None else str(i), t) for i, t in items]
    want = {i: (n, hit, sorted(set(names))) for i, t, *_ in docs for n, hit, names in [brute(t, named)]}
    sizes, build = [], decontamination.ItemIndex.__init__

    def init(self, part, window):
        sizes.append(sum(len(t.split()) for _, t in part))
        build(self, part, window)

    monkeypatch.setattr(decontamination.ItemIndex, "__init__", init)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 400)
    got = match_items(docs_table(spark, docs), bench).collect()
    assert len(sizes) > 3 and max(sizes) <= 800  # one item alone has 500 words, all have over 1,300
    assert len(got) == len(docs)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"]) == want[r["row"]["doc_id"]]
        assert r["text"] is None or (r["clean"] == r["text"]) == (r["n_hit"] == 0)
    assert match_items(docs_table(spark, []), bench).count() == 0


def test_cleaning(spark):
    docs, items = cases()
    table = docs_table(spark, docs)
    out = decontaminate(table, spark.createDataFrame(items, "item_id long, text string"))
    assert out.columns == table.columns
    kept = {}
    for r in out.collect():
        kept[r["doc_id"]] = r["text"]
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    named = [(str(i), t) for i, t in items]
    for i, t, *_ in docs:
        n, hit, _ = brute(t, named)
        if not hit:
            assert kept[i] == t
        elif hit > n / 2:
            assert i not in kept
        else:
            assert kept[i] != t
    assert decontaminate(table.limit(0), spark.createDataFrame([], "item_id long, text string")).count() == 0
    assert decontaminate(table, spark.createDataFrame([], "item_id long, text string")).count() == len(docs)
