"""Encoding through the transducer against the tokenizers library."""

from __future__ import annotations

import hashlib
import json
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from stayledger.llm import token_lexicon as lexicon
from tests_llm_helpers import odd_rows
from tokenizers import Tokenizer

FILE = public_tokenizers.path("word_bpe_49k.json")
SPECIAL = ["<|endoftext|>", "<|startoftext|> <|endoftext|>x", "a<|endof<|endoftext|>text|>", "<|x|>"]
PLAIN = [
    "The cat's they're I'll 12345 x-y  --- \t\n!!", "ÉCOLE été É İstanbul ß ﬁ", "a\x1cb \x1f\x00 \x85c\xa0d",
    "ΣΑΣ ς Σ 日本語テキスト ไทย", "𝔸 😀😀 é ͅ", "don'T 'S 's's", "aaaaaaa" * 3, "antidisestablishmentarianism",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def tokenizer():
    with open(FILE, encoding="utf-8") as file:
        return json.load(file)


def make(tokenizer, words):
    arrays = lexicon.compiled(words, tokenizer)
    return lexicon.Lexicon(arrays, lexicon.cutting_rules(tokenizer))


def same(own, library, texts):
    for text, (ids, decoded) in zip(texts, own.encoded(texts)):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == wanted, repr(text[:80])
        assert decoded.decode() == library.decode(wanted, skip_special_tokens=False), repr(text[:80])


@pytest.mark.parametrize("words", [[], [b"cat", b"they", b"the", "été".encode(), b"anti", b"dis", b"12345"]])
def test_texts(tokenizer, library, words):
    """The same ids whatever the automaton holds."""
    rng = random.Random(3)
    letters = "abcdefgh 'sS.É\n12"
    drawn = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(400)]
    same(make(tokenizer, words), library, SPECIAL + PLAIN + drawn + ["", " \n"])


def test_every_character(tokenizer, library):
    """Normalising and cutting below U+0370 is done here; the library is the measure."""
    characters = [chr(k) for k in range(0x370)]
    texts = [f"a{c}b {c}{c} 1{c}" for c in characters] + ["x" + c for c in map(chr, range(0x300, 0x370))]
    same(make(tokenizer, []), library, texts)


def test_far_characters(tokenizer, library):
    rng = random.Random(4)
    points = [k for k in range(0x370, min(sys.maxunicode, 0x20000)) if not 0xD800 <= k < 0xE000]
    same(make(tokenizer, []), library, ["".join(chr(rng.choice(points)) for _ in range(12)) for _ in range(300)])


def test_long_words(tokenizer, library):
    rng = random.Random(5)
    long = ["".join(rng.choice("ab") for _ in range(n)) for n in (47, 48, 49, 50, 700, 3000)]
    same(make(tokenizer, []), library, long + ["ha" * 4000])


def test_automaton_is_minimal_and_complete():
    words = sorted({a + b + c for a in (b"be", b"st", b"k") for b in (b"", b"ar", b"op") for c in (b"ing", b"ed", b"s")})
    machine = lexicon.minimal_automaton(words)
    held = words + [b"be", b"x", b"bearin", b"starsx", b""]
    offsets = np.append(0, np.cumsum([len(w) for w in held]))
    got = lexicon.places(machine, np.frombuffer(b"".join(held), np.uint8), offsets)
    assert got.tolist() == list(range(len(words))) + [-1] * 5
    ends: dict[bytes, set] = {}  # states of the minimal automaton: distinct sets of continuations
    for word in words:
        for k in range(len(word) + 1):
            ends.setdefault(word[:k], set()).add(word[k:])
    assert len(machine["final"]) == len({frozenset(v) for v in ends.values()})


def test_empty_automaton():
    machine = lexicon.minimal_automaton([])
    assert lexicon.places(machine, np.frombuffer(b"ab", np.uint8), np.array([0, 2])).tolist() == [-1]


def brute(library, rows):
    out = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        ids_hash = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        out.append((doc, len(ids), ids_hash, hashlib.sha256(decoded.encode()).hexdigest()))
    return sorted(out, key=str)


def test_digest(make_docs, library):
    rows = odd_rows() + [(100 + k, t) for k, t in enumerate(SPECIAL + PLAIN)]
    found = lexicon.encoding_digest(make_docs(rows).withColumnRenamed("lang", "word"), FILE)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(library, rows)


def test_empty_table(make_docs):
    assert lexicon.encoding_digest(make_docs([]), FILE).collect() == []


def test_encode_and_frequent_words(spark, make_docs, library):
    docs = make_docs([(k, "one two two three three three three") for k in range(8)])
    counts = lexicon.word_counts(docs, lexicon.cutting_rules(json.load(open(FILE, encoding="utf-8"))))
    assert sorted(lexicon.frequent_words(counts, 2)) == [b"three", b"two"]
    assert sorted(lexicon.frequent_words(counts, 1)) == [b"three"]
    opened = lexicon.build_lexicon(docs, FILE, limit=2)
    row = lexicon.encode(docs, opened).where("doc_id = 3").first()
    wanted = library.encode("one two two three three three three", add_special_tokens=False).ids
    assert (row["ids"], row["decoded"]) == (wanted, library.decode(wanted, skip_special_tokens=False))
