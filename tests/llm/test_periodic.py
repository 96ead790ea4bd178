"""Periodic runs against brute force: all periods of all words, then by definition."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from flightlake.llm import periodic
from flightlake.llm.queries import queries

SMALL = "/root/testdata/sf0.001"


def brute_runs(s, least):
    n, out = len(s), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and s[j] == s[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q):
                if not any(all(s[k] == s[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text, repeats):
    words = (text or "").encode().split()
    n = len(words)
    if repeats and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words, 12)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    told = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *told, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_equal_brute_force():
    rng = random.Random(3)
    cases = [fibonacci(150), [0] * 70, [0, 1] * 40, [0, 0, 1] * 8 + [0, 0, 1, 0, 0], [], [5], [5, 5], list(range(40)) * 2]
    for _ in range(600):
        s = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(70))]
        if s and rng.random() < 0.5:
            p = rng.randrange(1, len(s) + 1)
            s = [s[i % p] for i in range(len(s))]
        cases.append(s)
    for s in cases:
        for least in (1, 12):
            found = [tuple(map(int, r)) for r in periodic.runs_of(np.array(s, np.int64), least)]
            assert found == brute_runs(s, least), s


def test_small_lookup_steps_change_nothing(monkeypatch):
    s = np.array(fibonacci(400) + [0] * 100 + [1, 2] * 60, np.int64)
    whole = periodic.runs_of(s, 1).tolist()
    monkeypatch.setattr(periodic, "STEP", 7)
    assert periodic.runs_of(s, 1).tolist() == whole


def test_documents_share_no_runs(docs_of):
    """A run never goes on into the next document of its block."""
    rows = [(i, "a b c " * 4) for i in range(5)] + [(9, "x " * 11), (10, "x " * 12), (11, "x\ty\nx\x0by\x0cx\ry x y x y x y"), (12, "x y " * 20)]
    for r in periodic.digest(periodic.find_runs(docs_of(rows))).collect():
        assert tuple(r) == brute_row(r.doc_id, dict(rows)[r.doc_id], False)


def test_odd_rows(odd):
    found = sorted(map(str, (tuple(r) for r in periodic.digest(periodic.find_runs(odd)).where("doc_id is null or doc_id < 8").collect())))
    want = [brute_row(r.doc_id, r.text, False) for r in odd.collect() if r.doc_id is None or r.doc_id < 8]
    assert found == sorted(map(str, want))
    long = periodic.find_runs(odd).where("doc_id >= 8").collect()
    assert [len(r.runs) for r in long] == [0, 0] and all(r.n_words >= 300_000 for r in long)


def test_long_periodic_text_is_linear(docs_of):
    text = "head " + "one two three " * 100_000 + "tail"
    r = periodic.find_runs(docs_of([(1, text)])).first()
    assert [tuple(x) for x in r.runs] == [(1, 300_000, 3)]
    assert bytes(r.collapsed) == b"head one two three tail"


def test_empty_table(docs_of):
    assert periodic.digest(periodic.find_runs(docs_of([]))).count() == 0


def test_query_equals_brute_force(spark, small_docs):
    rows = {r.doc_id: r.text for r in small_docs.collect() if len((r.text or "").split()) <= 400}
    assert len(rows) > 100
    found = {r.doc_id: tuple(r) for r in queries()["op13_periodic_runs"](spark, SMALL).collect()}
    assert len(found) == small_docs.count()
    want = {i: brute_row(i, t, True) for i, t in rows.items()}
    assert {i: found[i] for i in want} == want
    assert any(r[1] for r in want.values())


def test_repeats_leave_other_texts_alone(docs_of):
    rows = [(i, f"w{i} a\tb  c\n d e") for i in range(60)] + [(None, "x y"), (70, None), (71, " ")]
    told = {r.doc_id: r.text for r in periodic.with_repeats(docs_of(rows)).collect()}
    for i, text in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            assert told[i] == text
