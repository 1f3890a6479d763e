import os
import random

from llm_helpers import components, docs_table, shingle_set, spaced_words

from spoolwire.llm import jaccard_join
from spoolwire.llm.jaccard_join import jaccard_components, one_per_component
from spoolwire.workspace import shared_root


def brute(rows):
    sets = {}
    for i, text, *_ in rows:
        sets.setdefault(i, []).append(shingle_set(spaced_words(text)))
    links = []
    for a in sets:
        for b in sets:
            if a < b and any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
                links.append((a, b))
    return components(list(sets), links)


def test_against_brute_force_with_hard_cases(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "LIST_ROWS", 7)  # blocks of lists
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Été", "a-b", "漢字"]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 60))] for _ in range(12)]
    common = [rng.choice(vocabulary) for _ in range(40)]
    rows = []
    for i in range(90):
        words = list(base[i % 12]) if i % 3 else list(rng.choice(base)) + (common if i % 2 else [])
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(words).upper() if i % 5 == 0 else " ".join(words), "en", "s"))
    rows += [(200, "", "en", None), (201, None, None, "s"), (202, " \n ", "en", "s"), (203, "one two", "en", "s"), (204, "ONE  two", "en", "s")]
    rows += [(205, "one two three", "en", "s"), (206, "x " * 60_000, "en", "s"), (207, "x " * 30_000, "en", "s"), (3, rows[3][1], "en", "s"), (3, rows[3][1], "en", "s")]
    got = jaccard_components(docs_table(spark, rows)).collect()
    expected = brute(rows)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == expected[r["doc_id"]], r
    sizes = {i: len(shingle_set(spaced_words(t))) for i, t, *_ in rows}
    assert all(r["n_shingles"] == sizes[r["doc_id"]] for r in got)


def test_one_stays_and_rows_without_id(spark):
    text = "one two three four five six seven"
    rows = [(5, text, "en", "s"), (2, text, "en", "s"), (2, text, "en", "s"), (None, text, "en", "s"), (9, None, None, None)]
    docs = docs_table(spark, rows)
    kept = one_per_component(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 2, 9]
    by_id = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    assert by_id[None] is None and by_id[5] == 2


def test_one_id_joins_the_classes_of_all_its_texts(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(12)) for x in "abcd")
    # 5 has a text of 2 and one of its own, which 8 shares; 6 one of 4 and one of 9; 1 has the same text twice
    rows = [(2, a), (5, a), (5, b), (8, b), (4, c), (6, c), (6, d), (9, d), (1, "x y z"), (1, "X y  z"), (3, None), (3, c + " e")]
    rows = [(i, t, "en", "s") for i, t in rows]
    got = {}
    for r in jaccard_components(docs_table(spark, rows)).where("n_shingles > 0").collect():
        got.setdefault(r["doc_id"], set()).add(r["component_id"])
    want = brute(rows)
    assert got == {i: {want[i]} for i in want}
    assert want[8] == 2 and want[9] == 3


def test_empty_table(spark):
    assert jaccard_components(docs_table(spark, [])).count() == 0


def test_links_are_all_verified_pairs(spark, monkeypatch):
    from spoolwire.llm.jaccard_join import jaccard_links

    rng = random.Random(8)
    base = [[f"w{rng.randrange(300)}" for _ in range(200)] for _ in range(4)]
    rows = []
    for i in range(60):  # groups of near copies, most of whose pairs lie inside a component
        words = list(base[i % 4])
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(9)}"
        rows.append((100 - i, " ".join(words), "en", "s"))
    rows += [(200, "", "en", "s"), (201, None, "en", "s"), (202, rows[0][1], "en", "s"), (None, rows[1][1], "en", "s")]
    sets = {i: shingle_set(spaced_words(t)) for i, t, *_ in rows if i is not None}
    own = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets if sets[i]}
    want = {(a, b) for a in own.values() for b in own.values() if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    classes = {i: r["class_id"] for r in jaccard_components(docs_table(spark, rows)).collect() if (i := r["doc_id"]) in own}
    assert classes == own
    assert len(want) > 2 * len(set(own.values()))  # more links than any spanning forest has
    for size in (jaccard_join.LIST_ROWS, 7):
        monkeypatch.setattr(jaccard_join, "LIST_ROWS", size)
        got = [(r["a"], r["b"]) for r in jaccard_links(docs_table(spark, rows)).collect()]
        assert len(got) == len(set(got))
        assert set(got) == want
    assert jaccard_links(docs_table(spark, [])).count() == 0


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    a, b, c = ("one two three four five six seven", "eight nine ten eleven twelve thirteen", "red green blue white black grey")
    rows = [(7, a, "en", "s"), (7, b, "en", "s"), (3, a, "de", "s"), (9, b, "en", "s"), (9, b, "en", "s"), (9, None, "en", "s"), (9, "", "en", "s"), (0, c, "fr", "z"), (0, c, "en", "z"), (1, c, "en", "s")]
    docs = docs_table(spark, rows)
    # c: the smallest id, and of its two rows the smallest; b: under one of its ids, which both have several texts
    want = [(0, c, "en"), (3, a, "de"), (9, "", "en"), (9, None, "en")]
    seen = set()
    for parts in (1, 3, 7):
        got = [(r["doc_id"], r["text"], r["lang"]) for r in one_per_component(docs.repartition(parts)).collect()]
        of_b = [r for r in got if r[1] == b]
        assert len(of_b) == 1 and of_b[0][0] in (7, 9)
        seen.add(of_b[0])
        assert sorted(map(repr, (r for r in got if r[1] != b))) == sorted(map(repr, want))
    assert len(seen) == 1


def test_one_id_for_every_row_loses_no_text(spark):
    rows = [(5, f"text number {i % 40} of one id " * 3 + f"and its own end {i % 40}", "en", "s") for i in range(120)]
    texts = {r[1] for r in rows}
    sets = {t: shingle_set(spaced_words(t)) for t in texts}
    links = [(x, y) for x in texts for y in texts if x < y and 100 * len(sets[x] & sets[y]) >= 80 * len(sets[x] | sets[y])]
    groups = len(set(components(list(texts), links).values()))
    kept = [r["text"] for r in one_per_component(docs_table(spark, rows)).collect()]
    assert len(kept) == len(set(kept)) == groups


def test_one_per_component_of_an_empty_table(spark):
    assert one_per_component(docs_table(spark, [])).count() == 0


def test_tables_that_nothing_reads_are_gone(spark):
    folder = f"{shared_root(spark).removeprefix('file:')}/spoolwire"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    text = "one two three four five six seven eight nine ten eleven twelve"
    docs = docs_table(spark, [(i, f"{text} {i % 3}", "en", "s") for i in range(9)] + [(9, "alone", "en", "s")])
    found = jaccard_components(docs)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left == {"signatures", "classes", "components"}
    assert found.count() == 10
    before = set(os.listdir(folder))
    kept = one_per_component(docs)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - before}
    assert left == {"shared-ids", "representatives", "components"}
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 9]
