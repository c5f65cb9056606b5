"""Phrase collocations against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from stayledger.llm import collocations
from stayledger.llm.collocations import collocations as phrases_of
from tests_llm_helpers import odd_rows

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) from (text, lang) rows."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(FOLD)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, 5):
                f.update((lang, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    kept = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    out = []
    for (lang, w), a in kept.items():
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        longer = [b for (g, v), b in kept.items() if g == lang and len(v) > len(w)
                  and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if not any(100 * b >= 80 * a for b in longer):
            out.append((lang, -score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    out.sort()
    result = []
    for lang in sorted({x[0] for x in out}):
        own = [x for x in out if x[0] == lang][:top]
        result += [(g, r, p.decode(), -a, x, y, t, -s) for r, (g, s, a, p, x, y, t) in enumerate(own, 1)]
    return result


def frame(spark, rows):
    return spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate(rows)], "doc_id long, text string, lang string")


def drawn(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["Ab", "b", "cé", "d-e", "E\x85f", "g", "new", "york", "city"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(0, 40)):
            parts.append("New  York\tCity hall" if rng.random() < 0.2 else rng.choice(vocabulary))
            if rng.random() < 0.2:
                parts.append(rng.choice([".", ",", "\n", "?!", "\x0b", " ; "]))
        rows.append((" ".join(parts), rng.choice(["en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = drawn(seed) + [(t, "en") for _, t in odd_rows()]
    found = phrases_of(frame(spark, rows).repartition(4))
    assert sorted(tuple(r) for r in found.collect()) == brute(rows)


def test_nothing_to_find(spark):
    assert phrases_of(frame(spark, [(None, None), ("", "en"), ("one two", "en")])).collect() == []
    assert phrases_of(frame(spark, [])).collect() == []


def test_clashing_columns(spark):
    rows = [("a b c", "en")] * 40
    wide = frame(spark, rows).selectExpr("*", "1 AS w1", "2 AS n", "3 AS words", "4 AS rank")
    assert sorted(tuple(r) for r in phrases_of(wide).collect()) == brute(rows)


def test_products_beyond_64_bits(spark):
    """Scores are exact for counts near the limit of a long."""
    big = 4_000_000_000_000_000_000
    rows = [([1], big), ([2], big - 1), ([1, 2], big - 7)]
    row = collocations.scored(spark.createDataFrame(rows, "words array<long>, n long")).first()
    assert row["score"] == 2_000_000 * (big - 7) // (2 * big - 1)


@pytest.mark.parametrize(("hot", "limit"), [(1, 1 << 18), (60, 1 << 18), (1 << 22, 0), (100, 4)])
def test_dealing_and_numbers_change_nothing(spark, monkeypatch, hot, limit):
    """Very frequent words dealt by longer prefixes, and words that keep their codes, give the same rows."""
    rows = drawn(3)
    monkeypatch.setattr(collocations, "HOT", hot)
    plain = collocations.dictionary_of
    monkeypatch.setattr(collocations, "dictionary_of", lambda frequent: plain(frequent, limit))
    assert sorted(tuple(r) for r in phrases_of(frame(spark, rows)).collect()) == brute(rows)


def test_windows_are_padded_where_prefixes_are_rare(spark):
    rows = [("x y z q", "en")] * 35 + [(f"x y u{k} q", "en") for k in range(9)] + [("y q x", "en")] * 3
    texts = frame(spark, rows).selectExpr("lang", "cast(text AS binary) AS text")
    frequent = collocations.word_counts(texts).where("n >= 30")
    names = {r["code"]: r["word"] for r in frequent.collect()} | {0: "-"}
    windows = collocations.longest_windows(texts, collocations.dictionary_of(frequent), 11)
    found = Counter()
    for row in windows.collect():
        found[" ".join(names[x] for x in tuple(row)[:4])] += row["n"]
    assert found == {"x y z q": 35, "x y - -": 9, "y z q -": 35, "y - - -": 12, "z q - -": 35, "q - - -": 47, "x - - -": 3}
