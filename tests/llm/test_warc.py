from spoolwire.llm import warc as A

SCHEMA = "record_id string, type string, url string, date long, status int, headers array<struct<name:string,value:string>>, payload string, c string, old string"


def head(**fields):
    return [(k.replace("_", "-"), v) for k, v in fields.items()]


def test_resolution(spark):
    url = "https://www.Example.org:443/a/?utm_source=x&b=2&a=1#frag"
    day = 86_400
    rows = [
        ("f1", "response", url, 10, 200, head(etag='"1"', content_type="text/html", date="d1"), "one"),
        ("f2", "response", "http://example.org/a?a=1&b=2", 10 + 3 * day, 200, head(etag='"2"', last_modified="m"), "two"),
        ("f2b", "response", url, 10 + 3 * day, 200, head(etag='"2"', last_modified="m2"), "two b"),
        ("e", "response", url, 10 + 4 * day, 500, head(), "error"),
        ("r0", "revisit", url, 10, 304, head(etag='"1"'), None),  # not later than f1
        ("r1", "revisit", url, 11, 304, head(etag='W/"1"', date="d2", content_type="no", connection="close"), None),
        ("r2", "revisit", url, 10 + 2 * day, 304, head(etag='"x"'), None),
        ("r3", "revisit", url, 10 + 9 * day, 304, head(last_modified="m2"), None),
        ("r4", "revisit", url, 11 + 3 * day, 304, None, None),
        ("r4", "revisit", url, 11 + 3 * day, 304, None, None),
        ("r5", "revisit", "http://other.org/", 99, 304, head(), None),
        ("r6", "revisit", None, 99, 304, head(), None),
        ("r7", "revisit", url, None, 304, head(), None),
        (None, "revisit", url, 12, 304, head(), None),
        ("w", "warcinfo", None, None, None, None, "info"),
        ("n", None, url, 5, 200, head(), "untyped"),
        ("f1", "response", url, 10, 200, head(etag='"1"', content_type="text/html", date="d1"), "one"),
    ]
    out = A.resolve_revisits(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).drop("c", "old")).collect()
    assert len(out) == len(rows)
    got = {}
    for r in out:
        got.setdefault(r["record_id"], []).append(r)
    said = {k: (v[0]["outcome"], v[0]["base_id"], v[0]["payload"]) for k, v in got.items()}
    assert said["r0"] == ("no_earlier_response", None, None)
    assert said["r1"] == ("resolved", "f1", "one")
    assert [tuple(h) for h in got["r1"][0]["headers"]] == [("content-type", "text/html"), ("date", "d2"), ("etag", 'W/"1"')]
    assert said["r2"] == ("validator_mismatch", "f1", None)
    assert said["r3"] == ("resolved", "f2b", "two b")
    assert len(got["r4"]) == 2 and all((r["outcome"], r["base_id"]) == ("resolved", "f2b") for r in got["r4"])
    assert said["r5"][0] == said["r6"][0] == said["r7"][0] == "no_earlier_response"
    assert said[None] == ("resolved", "f1", "one")
    assert said["w"] == ("no_earlier_response", None, "info") and said["e"][0] == "no_earlier_response"
    assert len(got["f1"]) == 2 and said["f1"] == ("full", None, "one")


def test_parse(spark):
    raw = [
        "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <a>\r\nWARC-Target-URI: http://x.org/?q=a:b\r\nWARC-Date: 2024-01-02T03:04:05Z\r\n\r\n"
        "HTTP/1.1 200 OK\r\nSet-Cookie: a\r\nset-cookie: b\r\n\r\nbody\r\n\r\nmore",
        "WARC/1.1\r\nWARC-Type: revisit\r\n\r\nHTTP/1.1 304 Not Modified\r\nETag: \"1\"\r\n\r\n", "", None, "garbage",
    ]
    out = A.parse_warc(spark.createDataFrame([(r,) for r in raw], "raw string")).collect()
    assert len(out) == 5
    a = out[0]
    assert (a["record_id"], a["type"], a["url"], a["date"], a["status"], a["payload"]) == ("<a>", "response", "http://x.org/?q=a:b", 1704164645, 200, "body\r\n\r\nmore")
    assert [tuple(h) for h in a["headers"]] == [("set-cookie", "a"), ("set-cookie", "b")]
    assert (out[1]["type"], out[1]["status"], out[1]["payload"], out[1]["url"]) == ("revisit", 304, None, None)
    assert all(r["type"] is None for r in out[2:])


def test_empty(spark):
    assert A.resolve_revisits(spark.createDataFrame([], SCHEMA).drop("c", "old")).count() == 0


def test_many_visits_against_brute_force(spark, monkeypatch):
    """Often crawled URLs, many records of one second and id: by every earlier response, looked at one by one."""
    import hashlib
    import random

    monkeypatch.setattr(A, "RANGE_SECONDS", 50)
    rng = random.Random(8)
    rows = []
    for i in range(600):
        kind = rng.choice(["response", "revisit", "revisit"])
        url = f"http://x.org/{rng.choice('aaaab')}"
        date, rid = rng.randrange(400), rng.choice(["p", "q", None, str(i)])
        tag = rng.choice(['"1"', '"2"'])
        rows.append((rid, kind, url, date, 200 if kind == "response" else 304, head(etag=tag), f"body {i}" if kind == "response" else None))
    full = [(r[2], r[3], r[0] is not None, r[0] or "", hashlib.md5(r[6].encode()).hexdigest(), r) for r in rows if r[1] == "response"]
    want = []
    for r in rows:
        if r[1] == "response":
            want.append((r[0], "full", None, r[6]))
            continue
        earlier = [f for f in full if f[0] == r[2] and f[1] < r[3]]
        base = max(earlier)[-1] if earlier else None
        ok = base is not None and base[5] == r[5]
        outcome = "resolved" if ok else "validator_mismatch" if base else "no_earlier_response"
        want.append((r[0], outcome, base and base[0], base[6] if ok else None))
    got = A.resolve_revisits(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).drop("c", "old").repartition(5)).collect()
    assert sorted(map(repr, want)) == sorted(repr((r["record_id"], r["outcome"], r["base_id"], r["payload"])) for r in got)
