"""Benchmark decontamination by latent semantic retrieval.

The vocabulary are the words of the benchmark items, and each document is stored once as the
numbers of its words in it. Over all passages of 32 words Spark counts in how many each word
is, and a randomised SVD of the TF-IDF matrix gives a latent space: one pass for the sketch
``A'(A G)``, one for the small matrix ``(A Q)'(A Q)``; only sums of fixed size travel. Words in
too many passages have no weight, but each item keeps its rarest ones. Windows of every
document that are long enough to hold an item whole are compared with the items by cosine.
Candidates are checked: longest common subsequence of all words against the item, and of the
item's last quarter (its answer) by itself.

Items are a query set, taken in blocks of ``BLOCK_BYTES``, so that what tasks are sent is
bounded. Words are runs of letters, digits and non-ASCII characters; Latin-1 capitals are folded.

Defined cases: null or empty texts hold nothing; an item without words, or null, is never
found; an item in a document several times is reported once, at its best place; an empty
benchmark finds nothing; repeated documents are reported each; a null doc_id is kept; further
columns pass through ``drop_contaminated`` (names starting with ``_dc_`` are refused).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import PARTS, blocks_of, summed_blocks
from stayledger.llm.units import binary_parts, byte_table, chunks, pack, word_hashes, words
from stayledger.session import broadcast_if_small, materialize, stored

BLOCK_BYTES = 8 << 20
PORTION_BYTES = 1 << 18
PASSAGE = 32
RANK = 128
EXTRA = 16
COMMON_SHARE = 0.002
KEPT_PER_ITEM = 8
COSINE_FROM = 0.35
COMMON_FROM = 0.7
ANSWER_FROM = 0.6
FOUND = "_dc_row long, item_id long, cosine double, common double, answer double, start int, words int"
_FOUND = [f.split()[0] for f in FOUND.split(", ")]


def separators() -> np.ndarray:
    table = np.ones(256, bool)
    table[128:] = False
    for a, b in ((48, 58), (65, 91), (97, 123)):
        table[a:b] = False
    return table


def folded(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with the capitals of Latin-1 beyond ASCII in lower case (A-Z is up to the hash)."""
    second = (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    second[1:] &= data[:-1] == 0xC3
    second[:1] = False
    return data + np.uint8(0x20) * second


def _hashed(texts: list[bytes]) -> list[np.ndarray]:
    data = folded(np.frombuffer(b"".join(texts), np.uint8))
    offsets = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    starts, ends, rows = words(data, offsets, separators())
    hashes = word_hashes(data, starts, ends, byte_table("latent", True))
    return np.split(hashes, np.searchsorted(rows, np.arange(1, len(texts)))) if texts else []


class Items:
    """A block of benchmark items as numbers of their words; 0 is any other word."""

    def __init__(self, ids: list[int], texts: list[bytes]):
        hashed = _hashed(texts)
        self.vocabulary = np.unique(np.concatenate([np.zeros(0, np.uint64), *hashed]))
        self.kind = np.uint16 if len(self.vocabulary) < 65_000 else np.uint32
        pairs = [(i, self.number(h)) for i, h in zip(ids, hashed) if len(h)]
        self.ids, self.words = [p[0] for p in pairs], [p[1] for p in pairs]
        self.size = len(self.vocabulary) + 1

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def coded(docs: DataFrame, items: Items) -> DataFrame:
    """(_dc_row, codes) of documents with a word of the vocabulary, stored."""

    def run(batches):
        table, gaps = byte_table("latent", True), separators()
        for batch in batches:
            rows = batch.column("_dc_row").to_pylist()
            names, codes = [], []
            for first, data, offsets in chunks(batch.column("_dc_text")):
                data = folded(data)
                starts, ends, owner = words(data, offsets, gaps)
                numbers = items.number(word_hashes(data, starts, ends, table)).astype(items.kind)
                edges = np.searchsorted(owner, np.arange(len(offsets)))
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    if numbers[a:b].any():
                        names.append(rows[first + k])
                        codes.append(pack(numbers[a:b]))
            yield pa.record_batch(
                [pa.array(names, pa.int64()), pa.array(codes, pa.binary())], names=["_dc_row", "codes"]
            )

    return materialize(docs.mapInArrow(run, "_dc_row long, codes binary"), "latent_coded")


def _portions(batches, size: int = PORTION_BYTES):
    """Arrow batches cut into runs of rows with bounded codes, for bounded memory in what follows."""
    for batch in batches:
        _, offsets = binary_parts(batch.column("codes"))
        first = 0
        while first < batch.num_rows:
            last = max(int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1, first + 1)
            yield batch.slice(first, last - first)
            first = last


def _codes(batch, kind) -> tuple[np.ndarray, np.ndarray]:
    """The words' numbers of all rows, and where rows begin."""
    data, offsets = binary_parts(batch.column("codes"))
    codes = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), kind).astype(np.int64)
    return codes, (offsets - offsets[0]) // np.dtype(kind).itemsize


def _collected(batch, kind, weight=None):
    """(passage, word) entries of a batch, passages numbered through; weighted words only if weights are given."""
    codes, offsets = _codes(batch, kind)
    sizes = np.diff(offsets)
    passages = -(-sizes // PASSAGE)
    base = np.cumsum(passages) - passages
    at = np.flatnonzero(codes if weight is None else weight[codes])
    owner = (np.searchsorted(offsets, at, "right") - 1).astype(np.int64)
    return base[owner] + (at - offsets[owner]) // PASSAGE, codes[at], int(passages.sum())


def passage_counts(docs: DataFrame, items: Items) -> np.ndarray:
    """In how many passages each word is; at 0 the number of passages."""

    def run(batches):
        total = np.zeros(items.size)
        for batch in _portions(batches):
            passages, numbers, n = _collected(batch, items.kind)
            pairs = np.unique(passages * items.size + numbers)
            total += np.bincount(pairs % items.size, minlength=items.size)
            total[0] += n
        yield blocks_of(total, 1 << 15)

    return summed_blocks(docs.mapInArrow(run, PARTS))


def weights(counts: np.ndarray, items: Items) -> np.ndarray:
    """Inverse passage frequency of the words that tell; 0 for others."""
    idf = np.log((1 + counts[0]) / (1 + counts)) + 1e-6
    keep = counts <= COMMON_SHARE * counts[0]
    for own in items.words:
        distinct = np.unique(own)
        keep[distinct[np.argsort(counts[distinct], kind="stable")[:KEPT_PER_ITEM]]] = True
    keep[0] = False
    return np.where(keep, idf, 0.0)


class _Matrix:
    """Unit TF-IDF rows of a batch's passages, as entries sorted by passage."""

    def __init__(self, batch, kind, weight):
        passages, numbers, _ = _collected(batch, kind, weight)
        self.numbers, value = numbers, weight[numbers]
        self.heads = np.flatnonzero(np.append(True, passages[1:] != passages[:-1])[: len(passages)])
        self.sizes = np.diff(np.append(self.heads, len(passages)))
        if len(self.heads):
            # a word that stands twice counts twice; its entries are close enough to one for the norm
            value = value / np.repeat(np.sqrt(np.add.reduceat(value**2, self.heads)), self.sizes)
        self.value = value

    def times(self, right: np.ndarray) -> np.ndarray:
        if not len(self.heads):
            return np.zeros((0, right.shape[1]))
        return np.add.reduceat(right[self.numbers] * self.value[:, None], self.heads)

    def back(self, left: np.ndarray, out: np.ndarray) -> None:
        """out += A' left."""
        order = np.argsort(self.numbers, kind="stable")
        if len(order):
            entries = np.repeat(left, self.sizes, axis=0)[order] * self.value[order, None]
            names, firsts = np.unique(self.numbers[order], return_index=True)
            out[names] += np.add.reduceat(entries, firsts)


def latent_basis(docs: DataFrame, items: Items, weight: np.ndarray, rank: int = RANK) -> np.ndarray:
    """Words x rank: right singular vectors of the passages' TF-IDF matrix, by a randomised SVD."""
    width = min(rank + EXTRA, items.size)
    start = np.random.default_rng(11).normal(size=(items.size, width)) * (weight > 0)[:, None]

    def sketch(batches):
        total = np.zeros((items.size, width))
        for batch in _portions(batches):
            a = _Matrix(batch, items.kind, weight)
            a.back(a.times(start), total)
        yield blocks_of(total, 1 << 15)

    basis, _ = np.linalg.qr(summed_blocks(docs.mapInArrow(sketch, PARTS)).reshape(items.size, width))

    def small(batches):
        total = np.zeros((width, width))
        for batch in _portions(batches):
            t = _Matrix(batch, items.kind, weight).times(basis)
            total += t.T @ t
        yield blocks_of(total, 1 << 15)

    square = summed_blocks(docs.mapInArrow(small, PARTS)).reshape(width, width)
    _, turned = np.linalg.eigh(square)
    return (basis @ turned[:, ::-1][:, : min(rank, width)]).astype(np.float32)


def common_length(masks: dict[int, int], width: int, text: list[int]) -> int:
    """Longest common subsequence of a pattern, given as bits by word, and a text."""
    row = (1 << width) - 1
    for word in text:
        hits = row & masks.get(word, 0)
        if hits:
            row = ((row + hits) | (row - hits)) & ((1 << width) - 1)
    return width - row.bit_count()


def _masks(pattern: list[int]) -> dict[int, int]:
    found: dict[int, int] = {}
    for k, word in enumerate(pattern):
        found[word] = found.get(word, 0) | (1 << k)
    return found


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def search(docs: DataFrame, items: Items, weight: np.ndarray, basis: np.ndarray) -> DataFrame:
    """Items found in documents, at their best place."""
    scales: dict[int, list[int]] = {}
    for k, own in enumerate(items.words):
        step = 16
        while step < len(own):
            step *= 2
        scales.setdefault(step, []).append(k)
    vectors = _unit(np.stack([(weight[w][:, None] * basis[w]).sum(0) for w in items.words])).astype(np.float32)
    patterns = []
    for own in items.words:
        tail = own[-max(3, len(own) // 4) :].tolist()
        patterns.append((_masks(own.tolist()), len(own), _masks(tail), len(tail)))

    padded = np.zeros((len(items.words), max(map(len, items.words))), np.int64)
    for k, own in enumerate(items.words):
        padded[k, : len(own)] = own
    least = np.array([COMMON_FROM * len(own) for own in items.words])
    scales = {step: np.array(own) for step, own in scales.items()}

    def check(codes: np.ndarray, start: int, end: int, k: int):
        text = [w for w in codes[start:end].tolist() if w]
        masks, width, tail, tail_width = patterns[k]
        common = common_length(masks, width, text) / width
        if common < COMMON_FROM:
            return None
        answer = common_length(tail, tail_width, text) / tail_width
        return (common, answer) if answer >= ANSWER_FROM else None

    widest = max(scales)

    def run(batches):
        scaled = (basis * weight[:, None]).astype(np.float32)
        present = np.zeros(items.size, bool)
        for batch in _portions(batches):
            rows = batch.column("_dc_row").to_pylist()
            codes, offsets = _codes(batch, items.kind)
            # texts stand apart by a block of the widest scale, so that no window reaches into the next
            room = -(-np.diff(offsets) // widest) * widest + widest
            base = np.cumsum(room) - room
            owner = np.repeat(np.arange(len(rows)), np.diff(offsets))
            at = np.flatnonzero(weight[codes])
            if not len(at):
                continue
            place = at + (base - offsets[:-1])[owner[at]]
            entries = scaled[codes[at]]
            best: dict[tuple[int, int], tuple] = {}
            for step, members in scales.items():
                block = place // step
                heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
                own = owner[at[heads]]
                sums = np.add.reduceat(entries, heads)
                # the window of a block and the next, and that of a block and an empty one before it
                filled = block[heads]
                follows = np.append(filled[1:] == filled[:-1] + 1, False)
                windows = sums.copy()
                windows[follows] += sums[1:][follows[:-1]]
                cosine = _unit(windows) @ vectors[members].T
                near, item = np.nonzero(cosine >= COSINE_FROM)
                edges = np.flatnonzero(np.append(True, near[1:] != near[:-1]))[: len(near)]
                for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(near)]):
                    w = int(near[a])
                    doc = int(own[w])
                    shift = int(offsets[doc] - base[doc])
                    start = int(filled[w]) * step + shift
                    end = min(start + 2 * step, int(offsets[doc + 1]))
                    # an item may begin in the block before, where it has no weighted word
                    start = max(start - step, int(offsets[doc]))
                    # no subsequence is longer than the item's words that the window has at all
                    present[codes[start:end]] = True
                    present[0] = False
                    own_items = members[item[a:b]]
                    enough = present[padded[own_items]].sum(1) >= least[own_items]
                    present[codes[start:end]] = False
                    for m, k in zip(item[a:b][enough].tolist(), own_items[enough].tolist()):
                        hit = check(codes, start, end, k)
                        if hit and ((doc, k) not in best or hit[0] > best[doc, k][1]):
                            best[doc, k] = (float(cosine[w, m]), *hit, start - int(offsets[doc]), end - start)
            if not best:
                continue
            out = {n: [] for n in _FOUND}
            for (doc, k), found in best.items():
                for name, x in zip(_FOUND, (rows[doc], items.ids[k], *found)):
                    out[name].append(x)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]
            yield pa.record_batch([pa.array(out[n], t) for n, t in zip(_FOUND, kinds)], names=_FOUND)

    return docs.mapInArrow(run, FOUND)


def item_blocks(bench: DataFrame, limit: int = BLOCK_BYTES):
    """The benchmark in blocks of bounded size, read piece by piece."""
    ids, texts, size = [], [], 0
    for row in bench.where(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"].encode())
        size += len(texts[-1])
        if size >= limit:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield Items(ids, texts)


def find_items(rows: DataFrame, bench: DataFrame) -> DataFrame:
    """Found items by ``_dc_row``; rows have ``_dc_row`` and ``_dc_text`` (bytes)."""
    found = []
    for items in item_blocks(bench):
        if items.words:
            stored = coded(rows, items)
            counts = passage_counts(stored, items)
            if not len(counts) or not counts[0]:
                continue
            weight = weights(counts, items)
            found.append(search(stored, items, weight, latent_basis(stored, items, weight)))
    return materialize(reduce(DataFrame.union, found or [rows.sparkSession.createDataFrame([], FOUND)]), "latent_found")


def leaks(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """A row per document and item: doc_id, item_id, cosine, common, answer, start, words."""
    rows = docs.select(F.col("doc_id").alias("_dc_row"), F.col("text").cast("binary").alias("_dc_text"))
    return find_items(rows, bench).withColumnRenamed("_dc_row", "doc_id")


def drop_contaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents without a benchmark item."""
    if bad := [c for c in docs.columns if c.lower().startswith("_dc_")]:
        raise ValueError(f"reserved column names: {bad}")
    key = F.xxhash64("text", "doc_id").alias("_dc_row")
    rows = docs.select(key, F.col("text").cast("binary").alias("_dc_text"))
    bad_rows = stored(docs.sparkSession, "latent_rows", lambda: find_items(rows, bench).select("_dc_row").distinct())
    keyed = docs.withColumn("_dc_row", F.xxhash64("text", "doc_id"))
    bad_rows = broadcast_if_small(bad_rows, bad_rows.count(), row_bytes=32)
    return keyed.join(bad_rows, "_dc_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
