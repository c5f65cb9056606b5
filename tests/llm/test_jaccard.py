"""The Jaccard join against comparing all pairs."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import odd_rows, words_of

from stayledger.llm import components, jaccard_join


def shingles(text):
    w = [x.lower() for x in words_of(text)]
    if not w:
        return frozenset()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))


def brute(rows):
    """(doc_id, size, least reachable id); a null id is greater than all others and never least."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    least = {}
    for k, (doc, _) in enumerate(rows):
        rank = (doc is None, doc or 0)
        least[find(k)] = min(least.get(find(k), rank), rank)
    return sorted(((d, len(sets[k]), None if least[find(k)][0] else least[find(k)][1]) for k, (d, _) in enumerate(rows)), key=str)


def family(rng, first_id, copies, size, edits):
    base = [f"w{rng.randrange(300)}" for _ in range(size)]
    rows = []
    for k in range(copies):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        rows.append((first_id + k, " ".join(own)))
    return rows


def many_rows(seed):
    rng = random.Random(seed)
    rows, n = [], 100
    for copies, size, edits in [(30, 120, 6), (25, 60, 3), (12, 300, 20), (8, 6, 1), (40, 200, 12)]:
        rows += family(rng, n, copies, size, edits)
        n += copies
    common = " ".join(f"c{k}" for k in range(40))  # a passage that unlike documents share
    rows += [(n + k, common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60)))) for k in range(40)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, make_docs, seed):
    rows = many_rows(seed) + odd_rows()
    got = jaccard_join.components_digest(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_clusters_in_several_blocks(spark, make_docs, monkeypatch):
    """Small blocks: copies connect through pivots, and what is left goes to the other blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 1000)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 2)
    rows = many_rows(3)
    got = jaccard_join.components_digest(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_second_pass_in_portions(spark, make_docs, monkeypatch):
    """A template in many documents that are not linked: no task gets all of their sets."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 10)
    sizes, compare = [], jaccard_join._compare

    def spy(placed, tokens):
        where = [c for c in ("cluster", "block", "portion") if c in placed.columns]
        sizes.append(placed.groupBy(*where).count().agg({"count": "max"}).first()[0])
        return compare(placed, tokens)

    monkeypatch.setattr(jaccard_join, "_compare", spy)
    rng = random.Random(4)
    template = " ".join(f"c{k}" for k in range(100))
    rows = [(k, template + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(25))) for k in range(150)]
    rows += [(200 + k, rows[k][1] + f" last{k}") for k in range(0, 40, 3)]
    got = jaccard_join.components_digest(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    assert len(sizes) == 2 and sizes[1] <= 50


def test_keep_one(spark, make_docs):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(4, text), (4, text), (9, text), (11, text + " more"), (12, "other words here"), (12, ""), (12, ""), (13, None)]
    docs = make_docs(rows).selectExpr("*", "1 AS part", "2 AS n")
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.collect()) == [4, 12, 12, 12, 13]
    assert jaccard_join.keep_one(docs.where("false")).collect() == []
    with pytest.raises(ValueError):
        jaccard_join.keep_one(docs.withColumnRenamed("n", "_j_doc"))


def test_keep_one_decides_by_row(spark, make_docs):
    """Null and repeated ids with different texts: one row of each group, and every clean row."""
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(30)) for x in "abcde")
    rows = [
        (None, a), (None, b), (None, b + " more"), (None, c), (None, ""), (None, None), (None, c),  # c copies id 3
        (3, c), (3, d), (3, ""), (7, d + " more"), (7, e), (7, e), (8, "f g h i j k l")
    ]
    kept = [tuple(r)[:2] for r in jaccard_join.keep_one(make_docs(rows, 5)).collect()]
    of_b = [r for r in kept if r[1] in (b, b + " more")]
    assert len(of_b) == 1 and of_b[0][0] is None
    left = [r for r in kept if r not in of_b]
    assert sorted(left, key=str) == sorted(
        [(None, a), (None, ""), (None, None), (3, c), (3, d), (3, ""), (7, e), (8, "f g h i j k l")], key=str
    )
    # as many rows as groups when a third of many rows has a null id, also with a copy of a row with an id
    rows = [(None if k % 3 == 0 else k, " ".join(f"t{k}x{j}" for j in range(12))) for k in range(120)]
    extra = [(None, rows[1][1]), (None, rows[3][1]), (5, rows[4][1])]
    kept = jaccard_join.keep_one(make_docs(rows + extra)).collect()
    assert sorted((tuple(r)[:2] for r in kept), key=str) == sorted(rows, key=str)


def test_tree_rules_out_no_link():
    rng = np.random.default_rng(1)
    base = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64)) for _ in range(6)]
    sets = []
    for k in range(60):
        own = base[k % 6].copy()
        drop = rng.random(len(own)) < rng.random() * 0.15
        sets.append(np.unique(np.append(own[~drop], rng.integers(0, 1 << 63, drop.sum(), dtype=np.uint64))))
    tree = jaccard_join.SignatureTree(sets, np.ones(60, bool))
    offered = {tuple(sorted(p)) for a, b in tree.pairs() for p in zip(a.tolist(), b.tolist())}
    linked = {(i, j) for j in range(60) for i in range(j) if jaccard_join._linked(sets[i], sets[j])}
    assert linked and linked <= offered and len(offered) < 60 * 59 / 2


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(60)] + [(1000, k) for k in range(1001, 1040)]
    links = [(a, b) for a, b in links if a != b]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components.components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    assert sorted((r[0], r[1]) for r in got) == sorted((x, find(x)) for x in list(root))
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("code_parts", [11, 131071, 131101, 1 << 22, (1 << 26) - 5])
def test_codes_keep_their_order_beside_the_band(spark, code_parts):
    """Whatever the number of partitions, the lowest fifth of a set is told from the rest."""
    rng = np.random.default_rng(3)
    shift, rows, wanted = jaccard_join.code_shift(code_parts), [], {}
    for k in range(40):
        own = np.sort(rng.integers(0, 1 << 64, 30 + 9 * k, dtype=np.uint64))
        low = jaccard_join._lowest(len(own))
        rows.append((k + 1, len(own), int(own[low - 1].astype(np.int64)), 1, jaccard_join.pack(own >> shift)))
        wanted[k + 1] = low
    alive = spark.createDataFrame(rows, "set_id long, n long, last long, need long, codes binary")
    nodes = jaccard_join.banded(alive, code_parts).toArrow().to_batches()
    name = {n: s for b in nodes for n, s in zip(b.column("node").to_pylist(), b.column("set_id").to_pylist())}
    found = {}
    for near, _ in jaccard_join._spread(nodes, all_codes=False):
        for node in near.tolist():
            found[node] = found.get(node, 0) + 1
    assert len(found) == 80 and all(wanted[name[node]] == n for node, n in found.items())


def test_too_many_partitions_are_refused():
    with pytest.raises(ValueError, match="no room"):
        jaccard_join.band_shift(1 << 27)


def test_near_copies_without_ids_are_joined_once(spark):
    """Near copies under null: the texts that are read for their tokens are no more than the rows."""
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, f"{text} x{k}") for k in range(300)] + [(None, text)] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = jaccard_join.with_key(jaccard_join.rows_by_document(docs))
    sets = jaccard_join.sets_of(rows)
    wanted = sets.groupBy("set_id").agg(F.min("doc").alias("doc"), F.min("key").alias("key"))
    assert rows.join(wanted, ["doc", "key"]).count() == 350
    tokens = jaccard_join.tokens_of(rows, wanted)
    assert tokens.select("set_id").distinct().count() == 301 and tokens.count() <= 301 + 8
    assert {r["component"] for r in jaccard_join.linked_documents(docs).collect()} == {jaccard_join.NO_ID}


def test_links_across_bands(spark, make_docs):
    """Pairs of one band and of two neighbouring bands, each alone in its cluster."""
    rng, rows = random.Random(8), []
    for k, size in enumerate([40, 50, 56, 60, 70, 75, 87, 95, 109, 120, 136, 150]):
        words = [f"b{rng.randrange(10**9)}" for _ in range(size + 4)]
        for step, cut in enumerate((0, size // 20, size // 6, size // 4)):
            rows.append((10 * k + step, " ".join(words[: len(words) - cut])))
    got = jaccard_join.components_digest(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    bands = [jaccard_join.band_of(np.array([len(shingles(t))]))[0] for _, t in rows]
    pairs = list(zip(bands[::4], bands[1::4]))
    assert any(a == b for a, b in pairs) and any(a != b for a, b in pairs)


def test_sieve_keeps_what_can_link():
    """Probes against the block's sets, and those against the probes that stay."""
    codes = [range(10), range(20, 30), range(6, 16), range(0, 8), range(40, 50)]
    table = pa.table(
        {
            "set_id": [1, 2, 3, 4, 5],
            "cluster": [0] * 5,
            "block": [0] * 5,
            "portion": [0] * 5,
            "probe": [True, True, False, False, False],
            "label": [1, 2, 3, 4, 5],
            "need": [4, 4, 5, 8, 4],
            "codes": pa.array([np.array(c, np.uint64).tobytes() for c in codes], pa.binary()),
        }
    )
    # 2 shares nothing, 3 shares four tokens of the five that it needs, 5 shares nothing
    assert jaccard_join._sieve(table).column("set_id").to_pylist() == [1, 4]
    assert jaccard_join._sieve(table.slice(1)).num_rows == 0
    assert jaccard_join._sieve(table.slice(0, 2)).num_rows == 0
    assert jaccard_join._sieve(table.slice(0, 0)).num_rows == 0
