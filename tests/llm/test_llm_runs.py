"""Runs of words against a search that tries every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from civgraph.llm import runs

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, runs string, collapsed int, start long, period long"


def brute(w):
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j - i >= q and j + q - i >= 12:
                found.setdefault((i, j + q), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, q, e - s) for (s, e), q in found.items())


def found(texts):
    _, ids, starts = runs.word_ids(texts)
    start, stop, period = runs.find_runs(ids, starts)
    out = [[] for _ in texts]
    for s, e, q in zip(start.tolist(), stop.tolist(), period.tolist()):
        i = int(np.searchsorted(starts, s, "right")) - 1
        while starts[i + 1] <= s:  # texts without words
            i += 1
        out[i].append((s - int(starts[i]), q, e - s))
    return out


def fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_brute_force():
    r = random.Random(4)
    for _ in range(60):
        texts = [None, "", "  \n"]
        for n in (11, 12, 13, 60, 300):
            few = [r.choice("ab") for _ in range(n)]
            block = [f"w{r.randrange(40)}" for _ in range(r.randrange(1, 60))]
            mixed = []
            while len(mixed) < n:
                mixed += ([r.choice("abcdefgh") for _ in range(r.randrange(1, 25))] * r.randrange(1, 6))[:r.randrange(1, 90)]
            noise = [f"v{r.randrange(500)}" for _ in range(n)]
            broken = (block * (n // len(block) + 2))[:n]
            broken[r.randrange(n)] = "other"
            texts += [" ".join(w) for w in (few, mixed, broken, noise[:5] + block * 3 + noise, ["a"] * n, fibonacci(n))]
        assert found(texts) == [brute((t or "").split()) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=120), max_size=4))
def test_runs_of_arbitrary_texts(texts):
    assert found([" ".join(t) for t in texts]) == [brute(list(t)) for t in texts]


def test_long_texts_and_slices(monkeypatch):
    for n, p in ((60_000, 1), (60_000, 7), (50_000, 16_000)):
        block = [f"w{i}" for i in range(p)]
        assert found([" ".join((block * (n // p + 1))[:n])]) == [[(0, p, n)]]
    rows = ["a b " * 20, None, "c " * 30, "x y z"]
    want = [r["runs"] for r in runs._texts_with_runs(rows)]
    monkeypatch.setattr(runs, "SLICE_BYTES", 10)
    monkeypatch.setattr(runs, "PIECE", 3)
    assert [r["runs"] for a, b in runs.slices(rows) for r in runs._texts_with_runs(rows[a:b])] == want
    assert list(runs.slices([])) == []


def digest_of(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    all_runs, gone = brute(w), set()
    for s, q, length in all_runs:
        gone |= set(range(s + q, s + length))
    best = min(((-length, s, q) for s, q, length in all_runs), default=None)
    top = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    lines = "".join(f"{s},{length},{q}\n" for s, q, length in all_runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return (doc_id, len(all_runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_run_digest(spark):
    r = random.Random(9)
    texts = [None, "", " \t\n", "one", "a " * 12, "a " * 11, "é ü " * 9, "x" * 100_000, "p q r s t u v w " * 40 + "end",
             " ".join(f"w{r.randrange(9)}" for _ in range(400)), "nb sp nb sp " * 8, "a b\x0bc\x0cd " * 9]
    rows = [(i, texts[i % len(texts)]) for i in range(150)] + [(None, "a b " * 9), (None, None), (7, "a " * 12), (7, "a " * 12)]
    long = [(i, " ".join(f"w{r.randrange(5000)}" for _ in range(700))) for i in range(1000, 1040)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, 2, 3) for i, t in rows + long], SCHEMA).repartition(3)
    got = sorted((tuple(x) for x in runs.run_digest(docs).collect()), key=repr)
    assert got == sorted((digest_of(i, t) for i, t in rows + long), key=repr)
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in long)


def test_run_digest_of_no_rows(spark):
    got = runs.run_digest(spark.createDataFrame([], SCHEMA))
    assert got.count() == 0 and got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}


@pytest.mark.parametrize("words", [["a"] * 5000, fibonacci(3000), list("abcab" * 900)])
def test_grammar_shrinks_periodic_text(words):
    _, ids, _ = runs.word_ids([" ".join(words)])
    grammar = runs.Grammar(ids, runs.names_of(ids)[1])
    assert (~grammar.inner).sum() < 60
