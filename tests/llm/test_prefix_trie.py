"""The conversation trie against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from stayledger.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def code(role, text):
    return hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0, code(role, text)), role or "", text or ""))
    turns = {c: [x[1:] for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + mine[h:]
    members, ends = {}, {}
    for c, sequence in rebuilt.items():
        for d in range(len(sequence) + 1):
            members.setdefault(tuple(sequence[:d]), []).append(c)
        ends.setdefault(tuple(sequence), []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, own in members.items():
        value = (len(own) - 1) * len(node[-1][1].encode().split()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] = leaves.get(node[:d], 0) + (node not in children)
            saved[node[:d]] = saved.get(node[:d], 0) + value
    out = []
    for node, own in members.items():
        text = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        figures = (len(own), children.get(node, 0), leaves[node], saved[node])
        out.append((min(own), len(node), parent, *figures, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=4):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in prefix_trie.trie_digest(frame).collect()), key=str)


def drawn(seed, n=150, most=7):
    rng = random.Random(seed)
    texts = ["hello there", "yes", "no no\tno", "", None, "été x"]
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, most)):
            rows.append((c, rng.choice([t, t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = drawn(seed)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "x"), (-5, 1, "user", "x"), (-20, 0, "user", "y"), (-20, 1, "user", "z"), (7, 3, None, None)]
    rows += [(7, 3, None, None), (7, 3, "a", "b"), (9, None, "user", "w " * 30_000), (3, 0, "user", "x"), (10**18, 0, "u", "v")]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_one_conversation_many_times(spark):
    """Conversations that share all turns stand in several slices."""
    rows = [(c, t, "user", f"turn {t}") for c in range(1, 900) for t in range(4)]
    rows += [(c, t, "user", f"turn {t} of {c % 3}") for c in range(1000, 1040) for t in range(3)]
    assert found(spark, rows) == brute(rows)


def test_long_conversations_travel_in_segments(spark, monkeypatch):
    """Also lengths that end with a segment, and copies that part late."""
    monkeypatch.setattr(prefix_trie, "DEPTH", 4)
    rng = random.Random(6)
    rows = drawn(4, n=60, most=14)
    for c in range(200, 330):
        stop = rng.choice([4, 5, 8, 12, 16, 23])
        rows += [(c, t, "user", f"same {t}" if t < stop - 2 else rng.choice(["a", "b", f"same {t}"])) for t in range(stop)]
    frame = spark.createDataFrame(rows, SCHEMA)
    turns = prefix_trie.rebuilt_turns(prefix_trie.placed_turns(frame))
    segments = prefix_trie.segments_of(*turns)
    assert segments.agg(F.max(F.size("words"))).first()[0] == 4
    # workers get the module by value, with the depth of this test
    assert found(spark, rows) == brute(rows)


@pytest.fixture
def small_partitions(spark):
    """Spark would join the partitions of a test's few rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_conversation_is_cut(spark, small_partitions):
    """A conversation with most of the turns is numbered over several slices."""
    rows = [(5, t, "user", f"t{t}") for t in range(3000)] + drawn(5, n=30)
    placed = prefix_trie.placed_turns(spark.createDataFrame(rows, SCHEMA).repartition(8))
    assert placed.where("conv = 5").select("slice").distinct().count() > 1
    whole, lengths = prefix_trie.rebuilt_turns(placed)
    depths = sorted(r["depth"] for r in whole.where("conv = 5").collect())
    assert depths == list(range(1, len(depths) + 1)) and lengths.where("conv = 5").first()["length"] == len(depths)
    nodes = found(spark, rows)
    assert len(nodes) == len(brute_short(rows)) and max(n[1] for n in nodes) == len(depths)


def brute_short(rows):
    """Only the nodes' members; the full brute force is quadratic in length."""
    turns = {}
    for c, t, r, x in rows:
        turns.setdefault(c, []).append(((t is not None, t or 0, code(r, x)), r or "", x or ""))
    turns = {c: [code(*x[1:]) for x in sorted(v)] for c, v in turns.items()}
    nodes = set()
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        state = ""
        nodes.add(state)
        for x in turns.get(c - c % 20, [])[:h] + mine[h:]:
            state = hashlib.md5((state + x).encode()).hexdigest()
            nodes.add(state)
    return nodes


def test_find_close():
    rng = np.random.default_rng(1)
    for n in (1, 5, 40, 700, 9000):
        steps, open_now = [], 0
        for k in range(2 * n):
            up = open_now == 0 or (2 * n - k > open_now and rng.random() < 0.5)
            steps.append(1 if up else -1)
            open_now += steps[-1]
        steps = np.array(steps + [-1] * open_now, np.int8)
        held, closes = [], {}
        for k, s in enumerate(steps):
            if s > 0:
                held.append(k)
            else:
                closes[held.pop()] = k
        trie = prefix_trie.Parentheses(steps)
        assert trie.find_close(trie.opens).tolist() == [closes[k] for k in trie.opens.tolist()]
