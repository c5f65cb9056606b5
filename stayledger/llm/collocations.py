r"""Phrase collocations by marginalising the longest windows.

Each word starts one window: itself and the next three words of its piece, in columns led by
one, two and three places, padded where the piece ends. Only these windows are counted. A
phrase of k words is a prefix of the windows that it starts, so Spark's ``ROLLUP`` over the
window's columns gives the counts of all shorter phrases as sums over the longest.

So that rare windows neither travel as text nor reach the rollup:

* Words are counted first. A word below the threshold is in no candidate and pads the window. The
  ``DICTIONARY`` most frequent words get small numbers, other frequent words keep their hash;
  which word has which only decides how many bytes a window takes.
* Windows are dealt by their first two words, packed by column. A partition sees all
  windows of its prefixes, so it pads those whose prefixes stay below the threshold. Prefixes
  of words that are all very frequent (``HOT`` occurrences) are dealt by one word more, up to
  four, and are left to the rollup.

A candidate's counts of parts come from the same sums: each part of a phrase that reaches the
threshold reaches it too. Words are told apart by 63-bit hashes of language and word.

Defined cases: a null text is empty, a null language is ``und``; a language without candidates
has no rows; repeated rows count as often as they stand there; equal scores are ordered by count,
then by phrase; a piece of any length is cut into windows as a whole; further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.exchange import next_prime
from stayledger.llm.units import Rolling, byte_table, chunks, mix, pack, word_hashes, words
from stayledger.session import broadcast_if_small, materialize

LONGEST = 4
LEAST = 30
INSIDE_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
#: Words with numbers, and bits of the table of other frequent words: what every task gets.
DICTIONARY = 1 << 18
CELLS = 1 << 24
#: Occurrences from which a word is very frequent, windows of a partition, windows packed at once.
HOT = 1 << 22
PARTITION = 1 << 21
FLUSH = 1 << 20
CHUNK = 1 << 21
COLUMNS = [f"w{k}" for k in range(1, LONGEST + 1)]
TOP_BIT = np.uint64(1 << 63)
PAD = np.uint64(0)
CODEC = "zstd"


def _breaks() -> np.ndarray:
    """True for the bytes that part words or pieces."""
    table = np.zeros(256, bool)
    table[[9, 32]] = True
    return table | _piece_ends()


def _piece_ends() -> np.ndarray:
    table = np.zeros(256, bool)
    table[[10, 11, 12, 13, *b".,;:!?"]] = True
    return table


class Words:
    """The words of a chunk of texts: their places, their codes and the room up to their piece's end."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray):
        self.data = data
        self.starts, self.ends, self.rows = words(data, offsets, _breaks())
        n = len(self.starts)
        stops = np.append(0, np.cumsum(_piece_ends()[data]))
        piece = stops[self.starts] if n else self.starts
        ends_here = np.ones(n, bool)
        ends_here[:-1] = (piece[1:] != piece[:-1]) | (self.rows[1:] != self.rows[:-1])
        last = np.flatnonzero(ends_here)
        self.room = np.minimum(last[np.searchsorted(last, np.arange(n))] - np.arange(n) + 1, LONGEST)
        hashes = word_hashes(data, self.starts, self.ends, byte_table("phrase", fold_case=True))
        self.codes = mix(hashes + languages[self.rows]) | TOP_BIT


def _languages(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    """(hash by row, name by row) of the languages."""
    names = batch.column("lang").to_pylist()
    known = {}
    for name in names:
        if name not in known:
            raw = np.frombuffer(name.encode(), np.uint8)
            known[name] = Rolling(byte_table("language", False)[raw]).span(np.array([0]), np.array([len(raw)]))[0]
    return np.array([known[n] for n in names], np.uint64), names


def _grouped(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, heads in that order, group of each) of equal codes."""
    order = np.argsort(codes, kind="stable")
    fresh = np.append(True, codes[order][1:] != codes[order][:-1])[: len(codes)]
    group = np.zeros(len(codes), np.int64)
    group[order] = np.cumsum(fresh) - 1
    return order, np.flatnonzero(fresh), group


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each chunk with their counts."""
    for batch in batches:
        languages, names = _languages(batch)
        for first, data, offsets in chunks(batch.column("text"), CHUNK):
            found = Words(data, offsets, languages[first : first + len(offsets) - 1])
            if not len(found.codes):
                continue
            order, heads, _ = _grouped(found.codes)
            at = order[heads]
            folded = data.copy()
            folded[(folded >= 65) & (folded <= 90)] += 32
            text = folded.tobytes()
            spans = zip(found.starts[at].tolist(), found.ends[at].tolist())
            yield pa.record_batch(
                [
                    pa.array(found.codes[at].view(np.int64)),
                    pa.array([names[first + r] for r in found.rows[at].tolist()], pa.string()),
                    pa.array([text[a:b].decode("utf-8", "replace") for a, b in spans], pa.string()),
                    pa.array(np.diff(np.append(heads, len(order)))),
                ],
                names=["code", "lang", "word", "n"],
            )


def word_counts(texts: DataFrame) -> DataFrame:
    """(code, lang, word, n)"""
    rows = texts.mapInArrow(_count_words, "code long, lang string, word string, n long")
    return rows.groupBy("code", "lang", "word").agg(F.sum("n").alias("n"))


class Dictionary:
    """Numbers of the most frequent words from 1 on, and bits that all other frequent words have."""

    def __init__(self, codes: np.ndarray, hot: int, bits: np.ndarray | None):
        self.codes, self.hot, self.bits = codes, hot, bits
        self.order = np.argsort(codes)
        self.sorted = codes[self.order]

    def tokens(self, codes: np.ndarray) -> np.ndarray:
        """The word's number, its code, or padding for a word that is surely too rare."""
        out = np.zeros(len(codes), np.uint64)
        if self.bits is not None:
            cells = (codes & np.uint64(CELLS - 1)).astype(np.int64)
            maybe = (self.bits[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
            out[maybe] = codes[maybe]
        if len(self.sorted):
            at = np.minimum(np.searchsorted(self.sorted, codes), len(self.sorted) - 1)
            known = self.sorted[at] == codes
            out[known] = self.order[at[known]].astype(np.uint64) + np.uint64(1)
        return out

    def is_hot(self, tokens: np.ndarray) -> np.ndarray:
        return (tokens != PAD) & (tokens <= np.uint64(self.hot))

    def words(self, tokens: np.ndarray) -> np.ndarray:
        """Codes again."""
        out = tokens.copy()
        numbered = (tokens != PAD) & (tokens < TOP_BIT)
        out[numbered] = self.codes[(tokens[numbered] - np.uint64(1)).astype(np.int64)]
        return out


def _bits_of(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(CELLS // 16, bool)
    for batch in batches:
        bits[batch.column("cell").to_numpy() % len(bits)] = True
    yield pa.record_batch([pa.array([key[0].as_py()]), pa.array([pack(np.packbits(bits))], pa.binary())], names=["block", "bits"])


def dictionary_of(frequent: DataFrame, limit: int = DICTIONARY) -> Dictionary:
    """At most ``limit`` words come to the driver: those above the least power of two that leaves so many."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["m"] for r in frequent.groupBy(power.alias("p")).agg(F.count("*").alias("m")).collect()}
    floor, held = 64, 0
    for p in sorted(sizes, reverse=True):
        if held + sizes[p] > limit:
            break
        floor, held = p, held + sizes[p]
    rows = sorted(frequent.where(power >= floor).select("n", "code").collect(), reverse=True)
    codes = np.array([r["code"] for r in rows], np.int64).view(np.uint64)
    bits = None
    if held < sum(sizes.values()):
        cell = F.col("code").bitwiseAND(F.lit(CELLS - 1))
        others = frequent.where(power < floor).select(cell.alias("cell")).distinct()
        blocks = others.withColumn("block", F.floor(F.col("cell") / (CELLS // 16)))
        parts = blocks.groupBy("block").applyInArrow(_bits_of, "block long, bits binary").collect()
        bits = np.zeros(CELLS // 8, np.uint8)
        for row in parts:
            own = np.frombuffer(row["bits"], np.uint8)
            bits[row["block"] * len(own) : (row["block"] + 1) * len(own)] = own
    return Dictionary(codes, sum(r["n"] >= HOT for r in rows), bits)


def _prefix_codes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """A hash of the first word, the first two, and so on."""
    found, last = [], np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        last = mix(last * np.uint64(0x9E3779B97F4A7C15) + mix(column + np.uint64(1)))
        found.append(last)
    return found


def _dealt_by(columns: list[np.ndarray], dictionary: Dictionary) -> np.ndarray:
    """How many words decide a window's partition: up to the first that is not very frequent, two at least."""
    length = np.full(len(columns[0]), 1)
    hot = dictionary.is_hot(columns[0])
    for column in columns[1:]:
        length += hot | (length < 2)
        hot &= dictionary.is_hot(column)
    return length


def _packed(columns: list[np.ndarray], counts: np.ndarray, parts: int, dictionary: Dictionary) -> pa.RecordBatch:
    """One row per partition: the windows' columns byte by byte, compressed."""
    prefixes, length = _prefix_codes(columns), _dealt_by(columns, dictionary)
    key = np.choose(length - 1, prefixes)
    part = (key % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((columns[1], columns[0], part))
    part = part[order]
    heads = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
    codec, values, sizes = pa.Codec(CODEC), [], []
    table = np.stack([c[order] for c in columns] + [counts[order].astype(np.uint64)])
    for a, b in zip(heads, np.append(heads[1:], len(part))):
        planes = np.ascontiguousarray(table[:, a:b]).view(np.uint8).reshape(LONGEST + 1, b - a, 8).transpose(0, 2, 1)
        values.append(codec.compress(pack(planes), asbytes=True))
        sizes.append(b - a)
    columns_out = [pa.array(part[heads]), pa.array(sizes, pa.int64()), pa.array(values, pa.binary())]
    return pa.record_batch(columns_out, names=["part", "size", "windows"])


def _unpacked(table: pa.Table) -> np.ndarray:
    codec, found = pa.Codec(CODEC), [np.zeros((LONGEST + 1, 0), np.uint64)]
    for size, value in zip(table.column("size").to_pylist(), table.column("windows").to_pylist()):
        planes = np.frombuffer(codec.decompress(value, size * 8 * (LONGEST + 1)), np.uint8)
        flat = np.ascontiguousarray(planes.reshape(LONGEST + 1, 8, size).transpose(0, 2, 1))
        found.append(flat.view(np.uint64).reshape(LONGEST + 1, size))
    return np.concatenate(found, axis=1)


def _distinct(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    order, heads, _ = _grouped(_prefix_codes(columns)[-1])
    at = order[heads]
    return [c[at] for c in columns], np.add.reduceat(counts[order], heads) if len(heads) else counts


def _chunk_windows(found: Words, dictionary: Dictionary) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows of a chunk: columns led by one, two and three places, padded from the first gap on."""
    n = len(found.codes)
    tokens, columns, on = dictionary.tokens(found.codes), [], np.ones(n, bool)
    for k in range(LONGEST):
        led = np.append(tokens[k:], np.zeros(min(k, n), np.uint64))[:n]
        on &= (found.room > k) & (led != PAD)
        columns.append(np.where(on, led, PAD))
    some = columns[0] != PAD
    columns = [c[some] for c in columns]
    return _distinct(columns, np.ones(len(columns[0]), np.int64))


def longest_windows(texts: DataFrame, dictionary: Dictionary, parts: int, least: int = LEAST) -> DataFrame:
    """(w1..w4 as codes, n): windows padded from the first prefix that stays below ``least``."""
    shared = texts.sparkSession.sparkContext.broadcast(dictionary)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flushed() -> pa.RecordBatch:
            columns = [np.concatenate(c) for c in zip(*(h[0] for h in held))]
            counts = np.concatenate([h[1] for h in held])
            held.clear()
            return _packed(*_distinct(columns, counts), parts, shared.value)

        for batch in batches:
            languages, _ = _languages(batch)
            for first, data, offsets in chunks(batch.column("text"), CHUNK):
                held.append(_chunk_windows(Words(data, offsets, languages[first : first + len(offsets) - 1]), shared.value))
                size += len(held[-1][1])
                if size >= FLUSH:
                    yield flushed()
                    size = 0
        if size:
            yield flushed()

    def padded(table: pa.Table) -> pa.Table:
        *columns, counts = _unpacked(table)
        counts = counts.astype(np.int64)
        length = _dealt_by(columns, shared.value)
        for k in range(LONGEST, 1, -1):
            order, heads, group = _grouped(_prefix_codes(columns[:k])[-1])
            total = np.add.reduceat(counts[order], heads)
            rare = (total[group] < least) & (length <= k)
            for column in columns[k - 1 :]:
                column[rare] = PAD
        columns, counts = _distinct(columns, counts)
        codes = [pa.array(shared.value.words(c).view(np.int64)) for c in columns]
        return pa.table([*codes, pa.array(counts)], names=[*COLUMNS, "n"])

    dealt = texts.mapInArrow(deal, "part long, size long, windows binary")
    types = ", ".join(f"{c} long" for c in COLUMNS)
    return dealt.groupBy("part").applyInArrow(padded, f"{types}, n long")


def phrase_counts(windows: DataFrame, least: int = LEAST) -> DataFrame:
    """(words as an array of codes, n): phrases of one to four words that reach ``least``."""
    sums = windows.rollup(*COLUMNS).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    # a level's last column is kept; padding there means a window that was shorter
    length = LONGEST - F.bit_count("level")
    last = F.element_at(F.array(*COLUMNS), F.greatest(length, F.lit(1)))
    whole = (length >= 1) & (F.col("n") >= least) & (last != 0)
    return sums.where(whole).select(F.slice(F.array(*COLUMNS), 1, length).alias("words"), "n")


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (words, a, l, r, score) with their lowest-scoring cut; products are decimals, so they are exact."""
    known = broadcast_if_small(phrases.select(F.col("words").alias("part"), F.col("n").alias("f")), phrases.count())
    cuts = (
        phrases.where(F.size("words") > 1)
        .select("words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
        .withColumn("first", F.slice("words", 1, F.col("k")))
        .withColumn("rest", F.slice("words", F.col("k") + 1, F.size("words")))
    )
    left = known.select(F.col("part").alias("first"), F.col("f").alias("l"))
    right = known.select(F.col("part").alias("rest"), F.col("f").alias("r"))
    parts = cuts.join(left, "first").join(right, "rest")
    score = F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return parts.groupBy("words", "a").agg(lowest).select("words", "a", "cut.l", "cut.r", "cut.score")


def _inner_phrases(words: Column) -> Column:
    """All contiguous phrases of two or more words that are shorter than the whole."""
    sizes = F.sequence(F.lit(2), F.size(words) - 1)
    at_size = lambda m: F.transform(
        F.sequence(F.lit(1), F.size(words) - m + 1), lambda s: F.slice(words, s, m)
    )
    return F.array_distinct(F.flatten(F.transform(sizes, at_size)))


def without_inner(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates that no longer one holds in ``INSIDE_PERCENT`` of their occurrences."""
    inside = (
        phrases.where(F.size("words") > 2)
        .select("n", F.explode(_inner_phrases(F.col("words"))).alias("words"))
        .groupBy("words")
        .agg(F.max("n").alias("_outer"))
    )
    exact = "decimal(20,0)"
    outer = F.coalesce(F.col("_outer"), F.lit(0)).cast(exact)
    held = outer * 100 >= F.col("a").cast(exact) * INSIDE_PERCENT
    return candidates.join(inside, "words", "left").where(~held).drop("_outer")


def named(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Candidates with language and text in place of codes."""
    names = broadcast_if_small(frequent.select("code", "lang", "word"), frequent.count())
    figures = ["a", "l", "r", "score"]
    spread = candidates.select("words", *figures, F.posexplode("words").alias("place", "code"))
    own = spread.join(names, "code").groupBy("words", *figures).agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("place", "word"))).alias("text")
    )
    phrase = F.array_join(F.transform("text", lambda t: t["word"]), " ").alias("phrase")
    return own.select("lang", phrase, *figures)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int | None = TOP) -> DataFrame:
    """The best phrases of each language: (lang, rank, phrase, a, l, r, n, score)."""
    texts = docs.select(
        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )
    counts = materialize(word_counts(texts), "words")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counts.where(F.col("n") >= LEAST)
    total = counts.agg(F.sum("n")).first()[0] or 0
    windows = longest_windows(texts, dictionary_of(frequent), next_prime(max(11, -(-total // PARTITION))))
    phrases = materialize(phrase_counts(windows), "phrase_counts")
    kept = named(without_inner(scored(phrases), phrases), frequent).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
