"""Repeated windows and byte strings against brute force."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from stayledger.llm import exchange, substring_dedup, suffix_dedup, units
from tests_llm_helpers import odd_rows, words_of


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def brute(rows, units_of, length, joiner):
    """(doc_id, units, removed, runs, hash) per row."""
    rank = lambda d: (d is None, d or 0)
    first = {}
    for doc, text in rows:
        u = units_of(text)
        for k in range(len(u) - length + 1):
            key = tuple(u[k : k + length])
            first[key] = min(first.get(key, (True, 1)), rank(doc))
    out = []
    for doc, text in rows:
        u = units_of(text)
        gone = [False] * len(u)
        for k in range(len(u) - length + 1):
            if first[tuple(u[k : k + length])] < rank(doc):
                gone[k : k + length] = [True] * length
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((doc, len(u), sum(gone), runs, sha(joiner(x for x, g in zip(u, gone) if not g))))
    return sorted(out, key=str)


def random_rows(seed, n=40):
    """Short texts of few words, so that repeats of every length and overlap occur."""
    rng = random.Random(seed)
    vocabulary = ["aa", "b", "ccc", "dé", "e.", "F"]
    shared = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60))) for _ in range(6)]
    rows = []
    for k in range(n):
        parts = []
        for _ in range(rng.randrange(0, 4)):
            if rng.random() < 0.5:
                own = rng.choice(shared).split()
                a = rng.randrange(len(own))
                parts.append(" ".join(own[a : a + rng.randrange(5, 60)]))
            else:
                parts.append(" ".join(rng.choice(vocabulary) + str(rng.randrange(4)) for _ in range(rng.randrange(30))))
        rows.append((rng.choice([k, k, k, None, 3]), "  ".join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_words(spark, make_docs, seed):
    rows = random_rows(seed) + odd_rows()
    got = substring_dedup.repeats_digest(make_docs(rows)).collect()
    wanted = brute(rows, words_of, substring_dedup.WINDOW, b" ".join)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == [(w[0], w[1], w[2], w[4]) for w in wanted]


def test_three_levels(spark, make_docs):
    assert substring_dedup.levels(13) == [7, 13]
    assert substring_dedup.levels(13, 4) == [4, 8, 13]
    rows = random_rows(3)
    got = substring_dedup.remove_repeats(make_docs(rows), 13, 4).select("n_removed").collect()
    assert sorted(r[0] for r in got) == sorted(w[2] for w in brute(rows, words_of, 13, b" ".join))


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes(spark, make_docs, seed):
    rows = random_rows(seed) + [(a, (b or "")[:3000]) for a, b in odd_rows()]
    got = suffix_dedup.repeats_digest(make_docs(rows)).collect()
    wanted = brute(rows, lambda t: list((t or "").encode()), suffix_dedup.LENGTH, bytes)
    assert sorted((tuple(r) for r in got), key=str) == wanted


def test_many_flushes(spark, make_docs, monkeypatch):
    """What tasks settle before the shuffle changes nothing."""
    for module, name, value in (
        (exchange, "FLUSH_CODES", 50), (suffix_dedup, "FLUSH_RUNS", 50), (suffix_dedup, "FLUSH_BYTES", 500)
    ):
        monkeypatch.setattr(module, name, value)
    rows = random_rows(4)
    for digest, units_of, length, joiner in (
        (substring_dedup.repeats_digest, words_of, 13, b" ".join),
        (suffix_dedup.repeats_digest, lambda t: list((t or "").encode()), 50, bytes),
    ):
        got = digest(make_docs(rows, 2)).select("doc_id", "n_removed", "kept_sha256").collect()
        wanted = [(w[0], w[2], w[4]) for w in brute(rows, units_of, length, joiner)]
        assert sorted((tuple(r) for r in got), key=str) == sorted(wanted, key=str)


def test_empty_table_and_more_columns(spark, make_docs):
    for digest in (substring_dedup.repeats_digest, suffix_dedup.repeats_digest):
        assert digest(make_docs([(1, "a")]).where("false")).collect() == []
        assert digest(make_docs([(1, "a b")]).selectExpr("*", "1 AS part", "2 AS doc", "3 AS kept")).count() == 1


def test_previous_factor_against_suffix_comparison():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 99, 300).astype(np.uint8)
    starts = np.arange(0, 240)
    docs = rng.integers(0, 5, 240)
    for length in (8, 11, 50):
        got = suffix_dedup.previous_factor(docs, starts, data, length)
        text = data.tobytes()
        for k in range(240):
            same = [d for s, d in zip(starts, docs) if text[s : s + length] == text[starts[k] : starts[k] + length]]
            assert got[k] == (min(same) < docs[k])


def test_units():
    values = np.arange(20, dtype=np.uint64)[::-1].copy()
    for width in (1, 2, 5, 7, 20):
        wanted = [values[k : k + width].min() for k in range(21 - width)]
        assert units.sliding_min(values, width).tolist() == wanted
    texts = [b"", b"a b", b"  a", b"", b"b"]
    offsets = np.cumsum([0, *map(len, texts)])
    starts, ends, rows = units.words(np.frombuffer(b"".join(texts), np.uint8), offsets)
    joined = b"".join(texts)
    assert [joined[s:e] for s, e in zip(starts, ends)] == [b"a", b"b", b"a", b"b"]
    assert rows.tolist() == [1, 1, 2, 4]
