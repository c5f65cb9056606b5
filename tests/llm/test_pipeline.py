"""The pipeline's stages on a small folder, against what each must do with planted documents."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from tests_llm_helpers import words_of

import corpus_pipeline
from stayledger.session import materialize, new_path


@pytest.fixture(scope="module")
def folder(spark, make_docs):
    """Clean texts, spam, near copies, copies of a benchmark item, personal data; odd rows."""
    rng = random.Random(12)
    vocabulary = [f"{a}{b}{c}" for a in ("tor", "mel", "is", "qua") for b in ("en", "u", "ra") for c in ("th", "ga", "lo")]
    rare = [f"rare{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]

    def text(n, share=0.03):
        return " ".join(rng.choice(rare) if rng.random() < share else rng.choice(vocabulary) for _ in range(n))

    items = [(k, text(30, 0.5)) for k in range(5)]
    rows, labels = [], []
    for k in range(300):
        source = f"s{k % 3}"
        if k % 5 == 0:
            rows.append((k, " | ".join(text(40).upper().split()), source))
        else:
            rows.append((k, text(rng.randrange(40, 120)), source))
        labels.append((k, int(k % 5 != 0), 0))
    base = text(100).split()
    for k in range(300, 320):
        rows.append((k, " ".join([*base[:-1], f"end{k}"]), "s0"))
    for k in range(320, 330):
        rows.append((k, f"{text(30)} {items[k % 5][1]} {text(30)}", "s1"))
    for k in range(330, 340):
        rows.append((k, f"{text(30)} me{k}@mail.example.com {text(20)}", None))
    rows += [(340, None, "s0"), (341, "", "s1"), (None, text(50), "s2")]
    where = new_path(spark, "corpus")
    make_docs(rows).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return where, rows, items


def test_stages(spark, folder):
    where, rows, items = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    columns, texts = docs.columns, dict((d, t) for d, t, _ in rows)
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, where), name)
        assert docs.columns == columns
        seen[name] = docs.select("doc_id", "text").collect()
    ids = {name: {r.doc_id for r in found} for name, found in seen.items()}
    good = ids["quality_classifier"]
    spam = {k for k in range(0, 300, 5)}
    assert len(good & spam) <= 2 and len((set(texts) - spam) - good) <= 4
    left = ids["jaccard_join"]
    assert good - left == {k for k in range(301, 320)} & good
    clean = ids["decontamination"]
    assert left - clean == {k for k in range(320, 330)} & left
    assert ids["pii"] == clean
    for r in seen["pii"]:
        original = texts[r.doc_id]
        assert r.text == (original and re.sub(r"me\d+@mail\.example\.com", "<email>", original))
    copies = Counter(r.doc_id for r in seen["mixing"])
    assert set(copies) <= clean and max(copies.values()) <= 2
    assert {(r.doc_id, r.text) for r in seen["mixing"]} <= {(r.doc_id, r.text) for r in seen["pii"]}
    taken = sum(len(words_of(r.text)) for r in seen["mixing"])
    size = sum(len(words_of(r.text)) for r in seen["pii"])
    assert taken == pytest.approx(1.5 * size, rel=0.05)


def test_run_gives_the_mix(spark, folder):
    where, _, _ = folder
    out = corpus_pipeline.run(spark, where)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() > 200


def test_stages_take_an_empty_table(spark, folder):
    where, _, _ = folder
    docs = spark.read.parquet(f"{where}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, where).collect() == []
