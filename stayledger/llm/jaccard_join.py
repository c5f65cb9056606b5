"""Exact join of documents by the Jaccard of their word shingles, with signature trees.

1. A document is the set of 64-bit hashes of its five-word shingles; equal sets are one class
   with one representative. All that follows is between classes.
2. Links need 80 of 100 shingles in common, so the lowest fifth of two linked sets (by hash)
   shares one, and the lowest 35 of 100 share about 15. Sets announce these; a set that shares
   too few of them with others can have no link and stops.
3. The rest stand in their size band and the next. There the count is taken again, against what
   is left of the band. Sets of a band that share one of their lowest fifth, directly or through
   others, are a cluster. No link crosses clusters.
4. In a cluster a signature tree is built: sets in order of their least hashes, nodes with the
   OR of their members' token bitmaps and their range of sizes. The tree is traversed against
   itself; a pair of nodes is left out when the greatest overlap that bitmaps and sizes allow
   is too small, or when all members are connected already. What stays is compared exactly.
5. Large clusters are split into blocks of bounded size. Some sets (pivots) stand in every
   block, so that copies connect across blocks; sets that are not in their cluster's main
   component then go to the other blocks whose sets share a token with them, in portions of
   bounded size beside that block's sets. Nothing is dropped, and no task sees more than a block
   and a portion. First only announced tokens travel there, and whole sets follow where a probe
   shares enough of them with the block, or a set of the block with the portion's probes.

Defined cases: null, empty and word-less texts have an empty set, link with nothing and are
their own component; fewer than five words are one shingle; rows with equal ids are compared
as any others; a null id comes after all others; an empty table gives no rows. ``keep_one``
decides row by row, whatever the ids: of linked rows one with the least id stays (of several the
one with the least hash of its columns), texts that link with nothing stay under null and
repeated ids too, and so do all rows without words; further columns pass through (names
starting with ``_j_`` are refused).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DatetimeType, NumericType, StringType

from stayledger.llm.components import LINKS, components, forest
from stayledger.llm.exchange import (
    CODES,
    CODES_ARROW,
    FLUSH_CODES,
    NO_ID,
    announced,
    by_code,
    dealt,
    next_prime,
    opened,
    partition_counts,
    rows_by_document,
    shared_codes,
)
from stayledger.llm.units import Rolling, byte_table, chunks, mix, pack, word_hashes, words
from stayledger.session import broadcast_if_small, materialize, stored

SHINGLE = 5
PER_CENT = 80
#: Part of a set that is announced beyond the fifth in which linked sets must share a token.
SURPLUS = 15
#: A block holds about so many shingles and so many sets at most.
BLOCK_SHINGLES = 1 << 20
BLOCK_SETS = 1 << 11
PIVOTS = 16
FAN_OUT = 8
BAND = 1.25
#: Columns of these types tell rows with equal ids apart; others cannot all be hashed.
PLAIN = (BinaryType, BooleanType, DatetimeType, NumericType, StringType)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The distinct shingle hashes of each text of a chunk, in order."""
    starts, ends, rows = words(data, offsets)
    hashes = word_hashes(data, starts, ends, byte_table("shingle", True))
    grams = Rolling(hashes).grams(SHINGLE)
    edges = np.searchsorted(rows, np.arange(len(offsets)))
    out = []
    for a, b in zip(edges.tolist(), edges[1:].tolist()):
        if b - a >= SHINGLE:
            own = np.sort(grams[a : b - SHINGLE + 1])
            out.append(own[np.append(True, own[1:] != own[:-1])])
        elif b > a:
            whole = Rolling(hashes[a:b]).span(np.array([0]), np.array([b - a])) ^ np.uint64(b - a)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _set_id(own: np.ndarray) -> int:
    """A 64-bit name for a set; 0 for the empty one."""
    if not len(own):
        return 0
    sums = np.array([mix(own).sum(dtype=np.uint64), mix(own ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)])
    return int((mix(sums[:1]) ^ (sums[1:] + np.uint64(len(own)))).astype(np.int64)[0])


def _lowest(n: int) -> int:
    """How many of the lowest tokens hold one of any partner's: n - ceil(0.8 n) + 1."""
    return n - -(-PER_CENT * n // 100) + 1


def _announced_part(own: np.ndarray) -> np.ndarray:
    return own[: min(len(own), _lowest(len(own)) + SURPLUS * len(own) // 100)]


def sets_of(rows: DataFrame, make=shingle_sets) -> DataFrame:
    """(doc, n, set_id, last) by document; ``last`` is the greatest of the lowest fifth, as signed.

    Columns ``row`` and ``key`` of ``rows`` come along."""
    keys = [c for c in ("doc", "row", "key") if c in rows.columns]

    def run(batches):
        for batch in batches:
            out = {"n": [], "set_id": [], "last": []}
            for _, data, offsets in chunks(batch.column("text")):
                for own in make(data, offsets):
                    out["n"].append(len(own))
                    out["set_id"].append(_set_id(own))
                    out["last"].append(int(own[_lowest(len(own)) - 1].astype(np.int64)) if len(own) else 0)
            made = [pa.array(values, pa.int64()) for values in out.values()]
            yield pa.record_batch([*[batch.column(k) for k in keys], *made], names=[*keys, *out])

    schema = ", ".join(f"{c} long" for c in (*keys, "n", "set_id", "last"))
    return materialize(rows.mapInArrow(run, schema), "jaccard_sets")


def code_shift(code_parts: int) -> np.uint64:
    """Tokens travel as their first bits: 32 and those of the partition; this keeps their order."""
    return np.uint64(32 - (code_parts.bit_length() - 1))


def _gather(table: pa.Table) -> pa.Table:
    names, codes = opened(table)
    order = np.lexsort((codes, names))
    names, codes = names[order], codes[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (codes[1:] != codes[:-1])
    names, codes = names[fresh], codes[fresh]
    heads = np.flatnonzero(np.append(True, names[1:] != names[:-1])[: len(names)])
    ends = np.append(heads[1:], len(names))
    return pa.table(
        {
            "set_id": pa.array(names[heads], pa.int64()),
            "shared": pa.array(ends - heads, pa.int64()),
            "codes": pa.array([pack(codes[a:b]) for a, b in zip(heads, ends)], pa.binary()),
        }
    )


#: Announced codes lie on disk until they are answered; their partitions take turns, so only a part does at a time.
TURNS = 2


def _in_turns(source: DataFrame, announce, code_parts: int, text_parts: int, narrow: int) -> DataFrame:
    """The answers of ``shared_codes`` to what ``announce`` takes from the batches of ``source``, stored by turn."""

    def told(turn: int):
        def run(batches):
            def pairs():
                for names, codes in announce(batches):
                    now = codes % np.uint64(code_parts) % np.uint64(TURNS) == turn
                    yield names[now], codes[now]

            return announced(pairs(), code_parts, bool(narrow), False)

        return run

    turns = [shared_codes(source.mapInArrow(told(k), CODES), text_parts, narrow, False) for k in range(TURNS)]
    return reduce(DataFrame.union, [materialize(answers, "jaccard_answers") for answers in turns])


def shared_tokens(rows: DataFrame, code_parts: int, text_parts: int, make=shingle_sets) -> DataFrame:
    """(set_id, shared, codes): of each set, the announced tokens that other sets announce too."""
    shift = code_shift(code_parts)

    def announce(batches):
        for batch in batches:
            for _, data, offsets in chunks(batch.column("text")):
                sets = [s for s in make(data, offsets) if len(s)]
                parts = [_announced_part(s) for s in sets]
                if parts:
                    names = np.array([_set_id(s) for s in sets], np.int64)
                    yield np.repeat(names, [len(p) for p in parts]), np.concatenate(parts) >> shift

    answers = _in_turns(rows, announce, code_parts, text_parts, code_parts)
    return answers.groupBy("part").applyInArrow(_gather, "set_id long, shared long, codes binary")


def band_of(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / np.log(BAND) + 1e-9).astype(np.int64)


def node_id(set_ids: np.ndarray, bands: np.ndarray) -> np.ndarray:
    """A name for a set within a band."""
    return mix(set_ids.astype(np.uint64) ^ mix(bands.astype(np.uint64) + np.uint64(1))).astype(np.int64)


BAND_LIMIT = 1 << 7  # bands of sets up to 10^12 shingles


def band_shift(code_parts: int) -> np.uint64:
    """A code has 32 bits and those of its partition; its band stands above them."""
    shift = 31 + code_parts.bit_length()
    if (1 << (64 - shift)) < BAND_LIMIT:
        raise ValueError(f"{code_parts} partitions of codes leave no room for the bands of sets")
    return np.uint64(shift)


NODES = "node long, set_id long, n long, last long, need long, step long, codes binary"
#: No code: codes and the bands above them leave the highest value free.
NO_CODE = np.uint64((1 << 64) - 1)
ROUNDS = 2
#: A round of pruning is followed by another if it removed this share of the nodes.
WORTH = 0.1


def _in_bands(code_parts: int):
    """See ``banded``."""
    shift, high = code_shift(code_parts), band_shift(code_parts)

    def run(batches):
        for batch in batches:
            names, n = batch.column("set_id").to_numpy(), batch.column("n").to_numpy()
            last = batch.column("last").to_numpy().astype(np.uint64) >> shift
            codes = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("codes")]
            for step in (0, 1):
                bands = band_of(n) + step
                above = bands.astype(np.uint64) << high
                columns = [node_id(names, bands), names, n, (above | last).astype(np.int64), batch.column("need").to_numpy()]
                columns.append(np.full(len(names), step, np.int64))
                packed = pa.array([pack(c | a) for c, a in zip(codes, above)], pa.binary())
                yield pa.record_batch([*[pa.array(c, pa.int64()) for c in columns], packed], names=NODES.replace(" long", "").replace(" binary", "").split(", "))

    return run


def banded(alive: DataFrame, code_parts: int) -> DataFrame:
    """Each set in its size band and the next: two linked sets stand in one band together."""
    return alive.mapInArrow(_in_bands(code_parts), NODES)


def _spread(batches, all_codes: bool = True):
    """(node, code) of a portion of nodes; without the surplus if not all are wanted."""
    for batch in batches:
        values = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("codes")]
        codes = np.concatenate([np.zeros(0, np.uint64), *values])
        row = np.repeat(np.arange(len(values)), [len(v) for v in values])
        if not all_codes:
            low = codes <= batch.column("last").to_numpy().astype(np.uint64)[row]
            codes, row = codes[low], row[low]
        yield batch.column("node").to_numpy()[row], codes


def _portions(pairs):
    """(nodes, codes) put together until they have ``FLUSH_CODES`` codes."""
    nodes, codes, held = [], [], 0
    for a, b in pairs:
        nodes.append(a)
        codes.append(b)
        held += len(b)
        if held >= FLUSH_CODES:
            yield np.concatenate(nodes), np.concatenate(codes)
            nodes, codes, held = [], [], 0
    if held:
        yield np.concatenate(nodes), np.concatenate(codes)


def pruned(nodes: DataFrame, code_parts: int, text_parts: int, alive: DataFrame | None = None) -> DataFrame:
    """Nodes that share enough tokens with the others of their band that are left, with those tokens.

    ``alive``: what ``nodes`` are the bands of; they are then made where they are announced, in one pass."""

    source, place = (nodes, iter) if alive is None else (alive, _in_bands(code_parts))

    def announce(batches):
        return _spread(place(batches))

    def survivors() -> DataFrame:
        shared = _in_turns(source, announce, code_parts, text_parts, 0)
        kept = shared.groupBy("part").applyInArrow(_gather, "set_id long, shared long, codes binary")
        kept = kept.withColumnRenamed("set_id", "node").join(nodes.drop("codes"), "node").where("shared >= need")
        return kept.select("node", "set_id", "n", "last", "need", "step", "codes")

    return stored(nodes.sparkSession, "jaccard_nodes", survivors)


def _least_codes(batch) -> np.ndarray:
    """The least code of each node; ``NO_CODE`` where it has none of the lowest fifth."""
    values = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch.column("codes")]
    least = np.array([v[0] if len(v) else NO_CODE for v in values], np.uint64)
    return np.where(least <= batch.column("last").to_numpy().astype(np.uint64), least, NO_CODE)


def clusters(nodes: DataFrame) -> DataFrame:
    """(node, set_id, n, step, cluster): nodes that may be linked with others.

    A node goes by its least code: nodes that have the same one are linked already, so of a group of
    near copies a few names travel, and only codes that join two names make a link."""
    # as many names and codes in a partition as texts give to theirs, and not fewer where texts have little in common
    codes = nodes.agg(F.sum(F.octet_length("codes"))).first()[0] or 0
    parts = next_prime(max(11, -(-codes // 8 // FLUSH_CODES)))

    def named(batches):
        for batch in batches:
            least = dict(zip(batch.column("node").to_pylist(), _least_codes(batch).astype(np.int64).tolist()))
            for near, codes in _spread([batch], all_codes=False):
                yield np.array([least[x] for x in near.tolist()], np.int64), codes

    def announce(batches):
        # as many nodes at once as the batches are small: what a task settles itself does not depend on them
        for near, codes in _portions(named(batches)):
            own, codes, least, _ = by_code(near, codes)
            ask = own == least
            a, root = forest(own[~ask], least[~ask])
            yield dealt(a, root.astype(np.uint64), a % parts, settled=True)
            own, codes = own[ask], codes[ask]
            yield dealt(own, codes, (codes % np.uint64(parts)).astype(np.int64))

    def join(table: pa.Table) -> pa.Table:
        own, _, least, _ = by_code(*opened(table))
        near, root = opened(table, settled=True)
        a, b = forest(np.append(own, near), np.append(least, root.astype(np.int64)))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def name(batches):
        for batch in batches:
            least = _least_codes(batch)
            columns = [batch.column(c) for c in ("node", "set_id", "n", "step")]
            made = pa.record_batch([*columns, pa.array(least.astype(np.int64))], names=["node", "set_id", "n", "step", "name"])
            yield made.filter(pa.array(least != NO_CODE))

    links = materialize(nodes.mapInArrow(announce, CODES).groupBy("part").applyInArrow(join, LINKS), "jaccard_names")
    joined = components(links).select(F.col("node").alias("name"), "root")
    own = nodes.select("node", "set_id", "n", "step", "last", "codes").mapInArrow(name, "node long, set_id long, n long, step long, name long")
    return own.join(joined, "name", "left").select("node", "set_id", "n", "step", F.coalesce("root", "name").alias("cluster"))


class SignatureTree:
    """Sets of a block under nodes with OR-combined bitmaps and size ranges."""

    def __init__(self, sets: list[np.ndarray], probe: np.ndarray, resident: np.ndarray | None = None):
        self.sets = sets
        n = np.array([len(s) for s in sets], np.int64)
        width = 256
        while width < min(4 * n.max(), 1 << 16):
            width *= 2
        bits = np.zeros((len(sets), width // 64), np.uint64)
        for k, own in enumerate(sets):
            at = (own >> np.uint64(20)) % np.uint64(width)
            np.bitwise_or.at(bits[k], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        extra = n - np.bitwise_count(bits).sum(1).astype(np.int64)  # tokens that share a bit
        resident = np.ones(len(sets), bool) if resident is None else resident
        self.levels = [(bits, n, n, extra, probe, resident)]
        while len(bits) > 1:
            heads = np.arange(0, len(bits), FAN_OUT)
            _, low, high, extra, probe, resident = self.levels[-1]
            bits = np.bitwise_or.reduceat(bits, heads)
            low, high = np.minimum.reduceat(low, heads), np.maximum.reduceat(high, heads)
            extra, probe = np.maximum.reduceat(extra, heads), np.logical_or.reduceat(probe, heads)
            resident = np.logical_or.reduceat(resident, heads)
            self.levels.append((bits, low, high, extra, probe, resident))

    def possible(self, level: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """For pairs of nodes: could any of their members be linked by sizes and bitmaps?"""
        bits, low, high, extra, probe, resident = self.levels[level]
        ok = (PER_CENT * low[left] <= 100 * high[right]) & (PER_CENT * low[right] <= 100 * high[left])
        ok &= (probe[left] & resident[right]) | (resident[left] & probe[right])
        at = np.flatnonzero(ok)
        step = max(1, (1 << 18) // bits.shape[1])
        for k in range(0, len(at), step):
            part = at[k : k + step]
            x, y = left[part], right[part]
            most = np.bitwise_count(bits[x] & bits[y]).sum(1).astype(np.int64) + np.minimum(extra[x], extra[y])
            most = np.minimum(most, np.minimum(high[x], high[y]))
            ok[part] = (100 + PER_CENT) * most >= PER_CENT * (low[x] + low[y])
        return ok

    def pairs(self):
        """Pairs of sets that the tree cannot rule out, in portions."""
        stack = [(len(self.levels) - 1, np.array([0]), np.array([0]))]
        while stack:
            level, left, right = stack.pop()
            ok = self.possible(level, left, right)
            left, right = left[ok], right[ok]
            if not len(left):
                continue
            if level == 0:
                apart = left != right
                yield left[apart], right[apart]
                continue
            below = len(self.levels[level - 1][1])
            step = np.arange(FAN_OUT)
            x = np.repeat(left * FAN_OUT, FAN_OUT * FAN_OUT) + np.tile(np.repeat(step, FAN_OUT), len(left))
            y = np.repeat(right * FAN_OUT, FAN_OUT * FAN_OUT) + np.tile(step, FAN_OUT * len(left))
            keep = (x < below) & (y < below) & (x <= y)
            x, y = x[keep], y[keep]
            # small copies, so that what waits on the stack stays small
            for k in range(0, len(x), 1 << 12):
                stack.append((level - 1, x[k : k + (1 << 12)].copy(), y[k : k + (1 << 12)].copy()))


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int((b[at] == a).sum())
    return 100 * shared >= PER_CENT * (len(a) + len(b) - shared)


def link_block(ids, sets, labels=None, probe=None) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links between a block's sets; pairs in one component are not compared.

    ``labels``: what is connected before; ``probe``: compare only probes with others."""
    order = sorted(range(len(ids)), key=lambda k: (int(sets[k][0]), len(sets[k]), ids[k]))
    ids, sets = np.asarray(ids, np.int64)[order], [sets[k] for k in order]
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    if labels is not None:
        _, first, group = np.unique(np.asarray(labels)[order], return_index=True, return_inverse=True)
        parent = first[group].tolist()
    # two probes meet where one of them is at home
    resident = None if probe is None else ~np.asarray(probe, bool)[order]
    probe = np.ones(len(ids), bool) if probe is None else ~resident
    a, b = [], []
    for left, right in SignatureTree(sets, probe, resident).pairs() if len(ids) > 1 else ():
        for x, y in zip(left.tolist(), right.tolist()):
            u, v = find(x), find(y)
            if u != v and _linked(sets[x], sets[y]):
                parent[max(u, v)] = min(u, v)
                a.append(ids[max(x, y)])
                b.append(ids[min(x, y)])
    return np.array(a, np.int64), np.array(b, np.int64)


def _block_links(table: pa.Table) -> pa.Table:
    """Links of one block: set_id, tokens, probe, label."""
    names = table.column("set_id").to_numpy()
    probe = np.array(table.column("probe").to_pylist(), bool)
    # a set that stands in the block already and comes again counts once
    order = np.lexsort((~probe, names))
    own = order[np.append(True, names[order][1:] != names[order][:-1])] if len(order) else order
    tokens = table.column("tokens").combine_chunks()
    sets = [np.frombuffer(tokens[int(k)].as_buffer(), np.uint64) for k in own]
    labels = table.column("label").to_numpy()[own]
    second = bool(probe.any())
    a, b = link_block(names[own], sets, labels, probe[own] if second else None)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


PLACED = "set_id long, cluster long, block long, portion long, probe boolean, label long"


def _sieve(table: pa.Table) -> pa.Table:
    """Of a portion of probes and the sets of a block, those that can have a link across.

    From set_id, need, probe, label and codes, the announced tokens that others of the band share."""
    probe = np.array(table.column("probe").to_pylist(), bool)
    need = table.column("need").to_numpy()
    codes = [np.frombuffer(v.as_buffer(), np.uint64) for v in table.column("codes").combine_chunks()]
    row = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    flat = np.concatenate([np.zeros(0, np.uint64), *codes])
    stays = np.ones(len(codes), bool)
    # probes among the block's sets first, then those sets among the probes that stay
    for side in (probe, ~probe):
        others = np.unique(flat[(stays & ~side)[row]])
        shared = np.bincount(row, weights=np.isin(flat, others), minlength=len(codes))
        stays &= ~side | (shared >= need)
    if not (stays & probe).any() or not (stays & ~probe).any():
        stays[:] = False
    return table.filter(pa.array(stays)).select(PLACED.replace(" long", "").replace(" boolean", "").split(", "))


PLACE = ("cluster", "block", "portion", "probe", "label")


def _compare(placed: DataFrame, tokens: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Links from placements (set_id, cluster, block, portion, probe, label); ``tokens`` adds the sets' tokens."""
    where = ("cluster", "block", "portion")
    return materialize(tokens(placed).groupBy(*where).applyInArrow(_block_links, LINKS), "jaccard_links")


def placed_tokens(placed: DataFrame, rows: DataFrame, at: DataFrame, make=shingle_sets) -> DataFrame:
    """Placements with the tokens of their sets, which go from the texts to all their places at once.

    ``at`` (set_id, doc, key): a row that has the set."""
    places = placed.groupBy("set_id").agg(F.collect_list(F.struct(*PLACE)).alias("places"))
    wanted = materialize(places.join(at, "set_id").select("doc", "key", "set_id", "places"), "jaccard_wanted")
    size = wanted.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("places")), F.lit(0))).first()[0]
    # while the wanted ids are few, texts need not be shuffled to find them
    found = tokens_of(rows, broadcast_if_small(wanted, size, row_bytes=64), make)
    full = found.select("set_id", F.explode("places").alias("place"), "tokens")
    return full.select(*[F.col(f"place.{c}") for c in PLACE], "set_id", "tokens")


def tokens_of(rows: DataFrame, wanted: DataFrame, make=shingle_sets) -> DataFrame:
    """(set_id, tokens) of wanted (doc, key, set_id), with what other columns these have.

    A set is looked for in rows of one id and one text. Where such a row is repeated, each task
    gives its set once."""
    carried = [c for c in wanted.columns if c not in ("doc", "key")]

    def run(batches):
        seen = set()
        for batch in batches:
            want = batch.column("set_id").to_numpy()
            at, tokens = [], []
            for first, data, offsets in chunks(batch.column("text")):
                for k, own in enumerate(make(data, offsets)):
                    if int(want[first + k]) not in seen and _set_id(own) == want[first + k]:
                        seen.add(int(want[first + k]))
                        at.append(first + k)
                        tokens.append(pack(own))
            kept = [batch.column(c).take(pa.array(at, pa.int64())) for c in carried]
            yield pa.record_batch([*kept, pa.array(tokens, pa.binary())], names=[*carried, "tokens"])

    source = rows.join(wanted, ["doc", "key"]).select(*carried, "text")
    return source.mapInArrow(run, source.select(*carried).schema.add("tokens", "binary"))


def _elsewhere(labelled: DataFrame, nodes: DataFrame, code_parts: int) -> DataFrame:
    """For sets outside the main component of their cluster: the other blocks of it in which one of
    their lowest tokens occurs. Tokens travel in arrays, and what comes back is a set and a block."""
    spot = F.xxhash64("cluster", "block")
    full = labelled.join(nodes.select("node", "last", "codes"), "node").withColumn("spot", spot)

    def announce(batches):
        for batch in batches:
            other = np.array(batch.column("other").to_pylist(), bool)
            spots = batch.column("spot").to_numpy()
            where = dict(zip(batch.column("node").to_numpy().tolist(), range(batch.num_rows)))
            for names, codes in _spread([batch], all_codes=False):
                row = np.array([where[x] for x in names.tolist()], np.int64)
                parts = (codes % np.uint64(code_parts)).astype(np.int64)
                yield dealt(spots[row], codes, parts)
                asks = other[row]
                yield dealt(names[asks], codes[asks], parts[asks], settled=True)

    def meet(table: pa.Table) -> pa.Table:
        spots, there, _, _ = by_code(*opened(table))
        asking, codes, _, _ = by_code(*opened(table, settled=True))
        lows, highs = np.searchsorted(there, codes), np.searchsorted(there, codes, "right")
        sizes = highs - lows
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(lows, sizes)
        a, b = np.repeat(asking, sizes), spots[at]
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        fresh = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))[: len(a)]
        return pa.table({"node": pa.array(a[fresh], pa.int64()), "spot": pa.array(b[fresh], pa.int64())})

    met = full.mapInArrow(announce, CODES).groupBy("part").applyInArrow(meet, "node long, spot long").distinct()
    blocks = labelled.select("cluster", "block", spot.alias("spot")).distinct()
    own = labelled.select("node", "set_id", "n", "label", F.col("block").alias("own"))
    return (
        met.join(own, "node").join(blocks, "spot").where("block <> own").select("node", "set_id", "n", "cluster", "block", "label")
    )


def linked_sets(rows: DataFrame, sets: DataFrame, make=shingle_sets) -> DataFrame:
    """(node, root) for sets that are linked with another."""
    code_parts, text_parts = partition_counts(rows)
    first = sets.where("n > 0").groupBy("set_id").agg(
        F.min(F.struct("doc", "key")).alias("at"), F.first("n").alias("n"), F.first("last").alias("last")
    )
    first = first.select("set_id", "n", "last", "at.doc", "at.key")
    # a partner has four fifths of the tokens at least; a few may share their first bits
    spare = F.floor(F.col("n") / 1000) + 1
    need = F.greatest(F.floor(F.floor(F.col("n") * SURPLUS / 100) * PER_CENT / 100) - spare, F.lit(1))

    def survivors() -> DataFrame:
        shared = shared_tokens(rows, code_parts, text_parts, make).join(first.withColumn("need", need), "set_id")
        return shared.where("shared >= need")

    alive = stored(rows.sparkSession, "jaccard_alive", survivors)
    nodes, left = banded(alive, code_parts), 2 * alive.count()
    for turn in range(ROUNDS):
        nodes, before = pruned(nodes, code_parts, text_parts, None if turn else alive), left
        left = nodes.count()
        if left > (1 - WORTH) * before:
            break  # another round would find as little
    grouped = materialize(clusters(nodes), "jaccard_clusters")
    sizes = grouped.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("sets"), F.sum("n").alias("weight"), F.min("step").alias("step")
    )
    # sets that all come from the band below stand together there
    sizes = sizes.where("sets > 1 and step = 0").drop("step").withColumn(
        "blocks", F.ceil(F.greatest(F.col("weight") / BLOCK_SHINGLES, F.col("sets") / BLOCK_SETS))
    )
    member = grouped.join(sizes, "cluster")
    own = F.pmod(F.xxhash64("set_id"), F.col("blocks"))
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("set_id", F.lit(1)), F.greatest(F.floor(F.col("sets") / PIVOTS), F.lit(1))) == 0)
    placed = materialize(member.select("node", "set_id", "n", "cluster", "blocks", own.alias("block"), pivot.alias("pivot")), "jaccard_placed")
    where = F.when(F.col("pivot"), F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array("block"))
    everywhere = placed.select(
        "set_id",
        "cluster",
        F.explode(where).alias("block"),
        F.lit(0).cast("long").alias("portion"),
        F.lit(False).alias("probe"),
        F.col("set_id").alias("label"),
    )
    tokens = partial(placed_tokens, rows=rows, at=alive.select("set_id", "doc", "key"), make=make)
    links = _compare(everywhere, tokens)
    roots = materialize(components(links), "jaccard_roots")
    split = placed.where("blocks > 1")
    if split.isEmpty():
        return roots
    labelled = split.join(roots, split["set_id"] == roots["node"], "left").select(
        split["node"], split["set_id"], "n", "cluster", "block", F.coalesce("root", "set_id").alias("label")
    )
    labelled = materialize(labelled, "jaccard_labelled")  # one row per node
    counted = labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("size"))
    main = counted.groupBy("cluster").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
    labelled = labelled.join(main, "cluster").withColumn("other", F.col("label") != F.col("main")).drop("main")
    probes = materialize(_elsewhere(labelled, nodes, code_parts), "jaccard_probes")
    if probes.isEmpty():
        return roots
    # the probes of a block come in portions, and its own sets stand beside each
    loads = probes.groupBy("cluster", "block").agg(F.count(F.lit(1)).alias("asked"), F.sum("n").alias("weight"))
    portions = F.ceil(F.greatest(F.col("weight") / BLOCK_SHINGLES, F.col("asked") / BLOCK_SETS))
    loads = loads.select("cluster", "block", portions.alias("portions"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("portions") - 1)).alias("portion")
    residents = labelled.join(loads, ["cluster", "block"]).select(
        "node", "set_id", "cluster", "block", each, F.lit(False).alias("probe"), "label"
    )
    portion = F.pmod(F.xxhash64("set_id", F.lit(2)), F.col("portions")).alias("portion")
    asked = probes.join(loads, ["cluster", "block"]).select(
        "node", "set_id", "cluster", "block", portion, F.lit(True).alias("probe"), "label"
    )
    # shared tokens are counted before whole sets travel
    meeting = residents.union(asked).join(nodes.select("node", "need", "codes"), "node").drop("node")
    meeting = meeting.groupBy("cluster", "block", "portion").applyInArrow(_sieve, PLACED)
    more = _compare(materialize(meeting, "jaccard_meeting"), tokens)
    return components(links.union(more))


def with_key(rows: DataFrame) -> DataFrame:
    """A hash of the text: rows of one id, null ids too, are told apart by it."""
    return rows.withColumn("key", F.xxhash64("text"))


def linked_documents(docs: DataFrame, id_col="doc_id", text_col="text", make=shingle_sets) -> DataFrame:
    """(doc, n, set_id, component) by row; the component is the least id that links lead to.

    ``make`` gives the texts' sets of hashes, in order; by default those of their shingles."""
    rows = with_key(rows_by_document(docs, id_col, text_col))
    return _with_components(rows, sets_of(rows, make), make).select("doc", "n", "set_id", "component")


def _with_components(rows: DataFrame, sets: DataFrame, make=shingle_sets) -> DataFrame:
    """``sets`` with the root of the sets that links lead to and the least id among their rows."""

    def find() -> DataFrame:
        roots = linked_sets(rows, sets, make)
        named = sets.where("n > 0").groupBy("set_id").agg(F.min("doc").alias("least"))
        named = named.join(roots, named["set_id"] == roots["node"], "left").select(
            "set_id", "least", F.coalesce("root", "set_id").alias("root")
        )
        whole = named.groupBy("root").agg(F.min("least").alias("component"))
        # equal sets and large components are hot keys here: narrow rows, which Spark splits
        return named.join(whole, "root").select("set_id", "root", "component")

    found = stored(sets.sparkSession, "jaccard_components", find)
    names = sets.drop("last", "key").columns
    full = sets.where("n > 0").join(found, "set_id").select(*names, "root", "component")
    alone = sets.where("n = 0").select(*names, F.col("set_id").alias("root"), F.col("doc").alias("component"))
    return full.union(alone)


def _row_key(docs: DataFrame) -> Column:
    """A hash of the text and the other plain columns: rows with equal ids are told apart by it."""
    plain = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, PLAIN) and f.name != "text"]
    return F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), *plain)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group of rows that are linked, directly or not: one with the least id."""
    if bad := [c for c in docs.columns if c.lower().startswith("_j_")]:
        raise ValueError(f"reserved column names: {bad}")
    rows = with_key(rows_by_document(docs, more=[_row_key(docs).alias("row")]))
    found = stored(docs.sparkSession, "jaccard_documents", lambda: _with_components(rows.drop("row"), sets_of(rows)))
    keys = [F.col("doc").alias("_j_doc"), F.col("row").alias("_j_row")]
    # several rows with the least id of their group: the one with the least key stays
    least = found.where("n > 0 and doc = component")
    tied = least.groupBy("root").agg(F.min("row").alias("stays"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    tied = materialize(tied.select("root", "stays"), "jaccard_tied")
    ties = tied.count()
    among = least.join(broadcast_if_small(tied, ties, row_bytes=48), "root")
    gone = found.where("doc <> component").select(*keys).union(among.where("row <> stays").select(*keys))
    gone = materialize(gone.distinct(), "jaccard_gone")
    names = [F.col(f"`{c}`") for c in docs.columns]
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_j_doc")
    keyed = docs.select(*names, key, _row_key(docs).alias("_j_row"))
    kept = keyed.join(broadcast_if_small(gone, gone.count(), row_bytes=48), ["_j_doc", "_j_row"], "left_anti")
    if not ties:
        return kept.select(*names)
    # rows with equal keys are the same row several times
    again = among.where("row = stays").groupBy(*keys).count().where("count > 1").select("_j_doc", "_j_row")
    again = materialize(again, "jaccard_again")
    small = broadcast_if_small(again, again.count(), row_bytes=48)
    once = kept.join(small, ["_j_doc", "_j_row"], "left_semi").dropDuplicates(["_j_doc", "_j_row"])
    return kept.join(small, ["_j_doc", "_j_row"], "left_anti").select(*names).union(once.select(*names))


def components_digest(docs: DataFrame) -> DataFrame:
    found = linked_documents(docs.select("doc_id", "text"))
    shown = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("doc", "doc_id"), ("component", "component_id"))]
    return found.select(shown[0], F.col("n").alias("n_shingles"), shown[1])
