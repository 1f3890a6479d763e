"""Brute-force versions and hard-case tables for the training-data operators."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, _key string, lang_pred string"


def docs_table(spark, rows):
    """``rows`` of (doc_id, text, lang, source), with extra columns whose names operators use inside."""
    full = [(i, t, v, s, None if t is None else len(t), "r", "k", "p") for i, t, v, s in rows]
    return spark.createDataFrame(full, DOCS)


def spaced_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def alnum_words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingle_set(words, width=5):
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def components(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
