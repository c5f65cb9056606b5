"""Repeated word windows by level-wise doubling.

A window of 13 words can only repeat if the shorter runs inside it do. The first level takes
runs of 7 words (of each window the one with the least hash, so that equal windows choose
alike) and finds those that several documents have; only windows around them are extended to
twice the length, cut at 13 where levels end, and only those that then still repeat in an
earlier document remove words. Levels stop when no candidates are left.

Defined cases: a null or empty text has no words and keeps nothing; a text shorter than the
window loses nothing; rows with equal ids do not remove each other's words; a null id comes
after all others; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.exchange import (
    CODES,
    CODES_ARROW,
    NO_ID,
    Answers,
    Windows,
    announced,
    partition_counts,
    rows_by_document,
    shared_codes,
    short_code,
)
from stayledger.llm.units import byte_table, chunks, covered, word_hashes, words

WINDOW = 13
RESULT = "doc long, n_words long, n_removed long, kept binary, spans array<struct<start:int,words:int>>"


def levels(window: int, seed: int | None = None) -> list[int]:
    """Lengths from the seed on, doubled up to the window: 7, 13."""
    found = [seed or -(-window // 2)]
    while found[-1] < window:
        found.append(min(2 * found[-1], window))
    return found


def _texts(batch):
    """(rows' documents, bytes, word starts, word ends, words' rows, word hashes) by chunk."""
    docs = batch.column("doc").to_numpy()
    table = byte_table("word", fold_case=False)
    for first, data, offsets in chunks(batch.column("text")):
        starts, ends, rows = words(data, offsets)
        yield docs[first:], len(offsets) - 1, data, starts, ends, rows, word_hashes(data, starts, ends, table)


def repeated_windows(rows: DataFrame, window: int = WINDOW, seed: int | None = None):
    """Answers by document partition for windows that an earlier document has; and the partition count."""
    code_parts, text_parts = partition_counts(rows)
    lengths = levels(window, seed)

    def code(hashes, gram):
        return hashes if gram == window else short_code(hashes, code_parts)

    def seeds(batches):
        def pairs():
            for batch in batches:
                for docs, _, _, _, _, owner, hashes in _texts(batch):
                    at = Windows(hashes, owner, window, lengths[0])
                    yield docs[at.rows], code(at.codes, lengths[0])

        return announced(pairs(), code_parts, lengths[0] < window, lengths[0] == window)

    found = rows.mapInArrow(seeds, CODES)
    texts = by_document(rows, text_parts)
    for shorter, gram in zip(lengths, [*lengths[1:], None]):
        answers = shared_codes(found, text_parts, code_parts if shorter < window else 0, gram is None)
        if gram is None:
            return texts, answers

        extend = _extension(window, shorter, gram, code, code_parts)
        found = texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(extend, CODES)


def _extension(window: int, shorter: int, gram: int, code, code_parts: int):
    """A function that announces the longer grams of windows whose shorter gram is shared."""

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Answers(right)

        def pairs():
            for docs, _, _, _, _, owner, hashes in _texts(left):
                low = Windows(hashes, owner, window, shorter)
                keep = np.zeros(len(hashes), bool)
                hit = known.has(docs[low.rows], code(low.codes, shorter))
                keep[low.starts] = np.repeat(hit, low.sizes)
                high = Windows(hashes, owner, window, gram)
                # a run of equal codes is a candidate if any of its windows is
                ends = np.cumsum(high.sizes)
                hits = np.append(0, np.cumsum(keep[high.starts]))
                good = hits[ends] > hits[ends - high.sizes]
                yield docs[high.rows[good]], code(high.codes[good], gram)

        return pa.Table.from_batches(announced(pairs(), code_parts, gram < window, gram == window), CODES_ARROW)

    return extend


def by_document(rows: DataFrame, text_parts: int) -> DataFrame:
    return rows.select(F.pmod("doc", F.lit(text_parts).cast("long")).alias("part"), "doc", "text")


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int | None = None, id_col="doc_id", text_col="text"):
    """Per document: its id, words, removed words, what is kept (bytes, words joined by one space)
    and the removed runs as (first word, words)."""
    texts, answers = repeated_windows(rows_by_document(docs, id_col, text_col), window, seed)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        known = Answers(right)
        out = {n: [] for n in ("doc", "n_words", "n_removed", "kept", "spans")}
        for docs, n, data, starts, ends, owner, hashes in _texts(left):
            at = Windows(hashes, owner, window, window)
            hit = at.starts[np.repeat(known.has(docs[at.rows], at.codes), at.sizes)]
            gone = covered(hit, window, len(hashes))
            first = np.searchsorted(owner, np.arange(n + 1))
            raw = data.tobytes()
            for row in range(n):
                a, b = first[row], first[row + 1]
                mask = gone[a:b]
                out["doc"].append(int(docs[row]))
                out["n_words"].append(int(b - a))
                out["n_removed"].append(int(mask.sum()))
                text = raw[starts[a] : ends[b - 1]].split() if b > a else []
                if out["n_removed"][-1]:
                    text = [w for w, g in zip(text, mask.tolist()) if not g]
                out["kept"].append(b" ".join(text))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
                out["spans"].append(
                    [{"start": int(s), "words": int(e - s)} for s, e in zip(edges[::2], edges[1::2])]
                )
        return pa.Table.from_pydict(out, _result_arrow())

    return texts.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(cut, RESULT)


def _result_arrow():
    spans = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())]))
    return pa.schema(
        [("doc", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("spans", spans)]
    )


def repeats_digest(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        "n_words",
        "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"),
    )


