import hashlib

from spoolwire.llm import chat_format as C
from spoolwire.workspace import scratch_path

SCHEMA = "conv_id long, turn long, role string, text string, head string"


def rows():
    out = [(1, t, ["user", "assistant"][t % 2], f"turn {t} é\n</s>[INST]", "x") for t in range(6)]
    out += [(2, 0, "system", None, "x"), (2, 1, "user", "a\\<|b|>\\", "x"), (2, 2, "assistant", "", "x"), (2, 3, None, "who", "x"), (2, 4, "we<|ird\n", "t", "x")]
    out += [(3, 0, "assistant", "tie b", "x"), (3, 0, "assistant", "tie a", "x"), (3, None, "user", "no turn", "x"), (3, 0, "assistant", "tie a", "x")]
    out += [(None, 0, "assistant", "no id", "x"), (4, 5000, "assistant", "late", "x"), (4, 3, "user", "y" * 100_000, "x"), (4, -2, "assistant", "<<SYS>>" * 3, "x")]
    return out


def brute():
    convs = {}
    for c, t, role, text, _ in rows():
        convs.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in convs.items()}


def test_examples_and_round_trip(spark):
    turns = C.format_turns(spark.createDataFrame(rows(), SCHEMA))
    want = brute()
    places = {(r["conv_id"], r["example"]): r for r in C.examples(turns).collect()}
    full = {}
    for r in C.expand(turns).collect():
        full.setdefault(r["conv_id"], []).append(r)
    for c, convo in want.items():
        examples = sorted(full.get(c, []), key=lambda r: r["example"])
        targets = [i for i, (role, _) in enumerate(convo) if role == "assistant"]
        assert len(examples) == len(targets)
        for r, i in zip(examples, targets, strict=True):
            parts = r["text"].split(C.TURN)[1:]
            assert [C.parse_turn(C.TURN + p) for p in parts] == convo[: i + 1]  # all turns before, and this one
            assert C.unescape(r["text"][r["loss_begin"] : r["loss_end"]]) == convo[i][1]
            assert r["text"][r["loss_end"] :] == C.END
            place = places[c, r["example"]]
            assert (place["end"], place["loss_begin"]) == (len(r["text"]), r["loss_begin"])
            assert r["text"][: place["context_chars"]].count(C.TURN) == i


def test_digests(spark):
    path = scratch_path(spark, "chat-test")
    C.format_turns(spark.createDataFrame(rows(), SCHEMA)).write.parquet(path)
    got = {r["conv_id"]: r for r in C.read_digests(spark, path).collect()}
    full = {}
    for r in C.expand(spark.read.parquet(path)).collect():
        full[r["conv_id"]] = full.get(r["conv_id"], 0) + len(r["text"])
    assert set(got) == set(brute())
    for c, convo in brute().items():
        r = got[c]
        loss = "".join(x for role, x in convo if role == "assistant")
        assert r["n_turns"] == len(convo)
        assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in convo).encode()).hexdigest()
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert r["formatted_chars"] == full.get(c, 0)


def test_no_control_string_inside(spark):
    out = C.format_turns(spark.createDataFrame(rows(), SCHEMA)).collect()
    for r in out:
        inner = r["formatted"].removeprefix(C.TURN).removesuffix(C.END).replace(C.TEXT, "", 1)
        assert not any(c in inner for c in C.CONTROL)


def test_empty(spark):
    assert C.format_turns(spark.createDataFrame([], SCHEMA)).count() == 0


def test_written_examples_hold_context_and_reply(spark, monkeypatch):
    for chars in (C.PART_CHARS, 90):  # one part, and conversations in many parts
        monkeypatch.setattr(C, "PART_CHARS", chars)
        path = scratch_path(spark, "chat-examples")
        C.write_examples(C.format_turns(spark.createDataFrame(rows(), SCHEMA)), path)
        written = spark.read.parquet(path).collect()
        got = {r["conv_id"]: r for r in C.read_example_digests(spark, path).collect()}
        assert set(got) == set(brute())
        for c, convo in brute().items():
            full = ["".join(C.TURN + p for p in r["text"].split(C.TURN)[1:]) for r in sorted((r for r in written if r["conv_id"] == c and r["loss_begin"] is not None), key=lambda r: r["place"])]
            targets = [i for i, (role, _) in enumerate(convo) if role == "assistant"]
            assert [[C.parse_turn(C.TURN + p) for p in text.split(C.TURN)[1:]] for text in full] == [convo[: i + 1] for i in targets]
            r, loss = got[c], "".join(convo[i][1] for i in targets)
            assert r["n_turns"] == len(convo)
            assert r["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in convo).encode()).hexdigest()
            assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
            assert r["formatted_chars"] == sum(map(len, full))


def test_query_writes_the_examples(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(C, "scratch_path", lambda s, label: seen.append(scratch_path(s, label)) or seen[-1])
    total = sum(r["formatted_chars"] for r in C.op8_chat_format(spark, "/root/testdata/sf0.001").collect())
    written = spark.read.parquet(seen[0]).where("loss_begin is not null")
    assert total == sum(len(r["text"]) for r in written.collect())


def test_a_wrong_context_is_noticed(spark):
    import pytest

    path, bad = scratch_path(spark, "chat-right"), scratch_path(spark, "chat-wrong")
    C.write_examples(C.format_turns(spark.createDataFrame(rows(), SCHEMA)), path)
    spark.read.parquet(path).selectExpr("conv_id", "place", "begin", "if(conv_id = 1 and place = 6, replace(text, 'turn 0', 'turn 9'), text) as text", "loss_begin", "loss_end").write.parquet(bad)
    with pytest.raises(Exception, match="is not its context and reply"):
        C.read_example_digests(spark, bad).collect()
