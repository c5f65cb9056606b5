"""Exchange of gram codes between texts and code partitions, for repeats across documents.

Texts announce codes of grams; a partition by code finds those that several documents have
and answers to a partition by document, where the answers meet the texts again. Codes travel
as arrays in one binary value per (task, partition), so a gram costs a few bytes and no row.
Partition counts follow the size of the text: what one task holds stays the same at any scale.

Before the shuffle a task settles what its own documents decide: of a code that many of them
have, one or two go on, and the others are answered at once and travel dealt by document. So a
code that a third of all documents share reaches its partition a few times per task only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.units import Rolling, mix, pack, runs_within, sliding_min

#: Text bytes whose codes meet in one task, and whose rows meet in one task.
CODE_SHARE = 8 << 20
TEXT_SHARE = 16 << 20
FLUSH_CODES = 1 << 19
NO_ID = (1 << 63) - 1

CODES = "part long, docs binary, counts binary, codes binary, settled boolean"
_BINARY = ("docs", "counts", "codes")
CODES_ARROW = pa.schema([("part", pa.int64()), *[(n, pa.binary()) for n in _BINARY], ("settled", pa.bool_())])


def next_prime(n: int) -> int:
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def rows_by_document(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more=()) -> DataFrame:
    """(doc, text as bytes, more); a null id sorts after all others, a null text is empty."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
        *more,
    )


def partition_counts(rows: DataFrame) -> tuple[int, int]:
    """How many code partitions and document partitions the text needs."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return next_prime(max(11, -(-total // CODE_SHARE))), next_prime(max(11, -(-total // TEXT_SHARE)))


def short_code(h: np.ndarray, parts: int) -> np.ndarray:
    """32 bits of the hash beside its partition; enough to tell a partition's codes apart."""
    n = np.uint64(parts)
    return ((h // n) & np.uint64(0xFFFFFFFF)) * n + h % n


def dealt(docs: np.ndarray, codes: np.ndarray, parts: np.ndarray, narrow: int = 0, settled: bool = False):
    """A record batch with a row per partition; documents are run-length coded.

    ``narrow``: the number of code partitions if codes are short; then four bytes travel."""
    order = np.argsort(parts, kind="stable")
    docs, codes, parts = docs[order], codes[order], parts[order]
    if narrow:
        codes = (codes // np.uint64(narrow)).astype(np.uint32)
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (parts[1:] != parts[:-1])
    heads = np.flatnonzero(fresh)
    counts = np.diff(np.append(heads, len(docs))).astype(np.uint32)
    names, firsts = np.unique(parts, return_index=True)
    ends = np.append(firsts[1:], len(parts))
    lows, highs = np.searchsorted(heads, firsts), np.searchsorted(heads, ends)
    columns = [[], [], []]
    for a, b, x, y in zip(firsts, ends, lows, highs):
        columns[0].append(pack(docs[heads[x:y]]))
        columns[1].append(pack(counts[x:y]))
        columns[2].append(pack(codes[a:b]))
    return pa.record_batch(
        [
            pa.array(names.astype(np.int64)),
            *[pa.array(c, pa.binary()) for c in columns],
            pa.array([settled] * len(names), pa.bool_()),
        ],
        schema=CODES_ARROW,
    )


def opened(table: pa.Table, narrow: int = 0, settled: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The documents and codes of the rows of one partition that are settled, or are not."""
    docs, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for part, d, n, c, done in zip(*(table.column(x).to_pylist() for x in CODES_ARROW.names)):
        if done != settled:
            continue
        docs.append(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(n, np.uint32)))
        if narrow and not done:
            codes.append(np.frombuffer(c, np.uint32).astype(np.uint64) * np.uint64(narrow) + np.uint64(part))
        else:
            codes.append(np.frombuffer(c, np.uint64))
    return np.concatenate(docs), np.concatenate(codes)


def by_code(docs: np.ndarray, codes: np.ndarray):
    """Distinct pairs in order of code, with the least and greatest document of each code."""
    order = np.lexsort((docs, codes))
    docs, codes = docs[order], codes[order]
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (docs[1:] != docs[:-1])
    docs, codes = docs[fresh], codes[fresh]
    if not len(codes):
        return docs, codes, docs, docs
    heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    sizes = np.diff(np.append(heads, len(codes)))
    return docs, codes, np.repeat(docs[heads], sizes), np.repeat(docs[heads + sizes - 1], sizes)


def announced(pairs, code_parts: int, narrow: bool, later_only: bool):
    """Record batches for an iterator of (documents, codes); see ``shared_codes``."""
    docs, codes, held = [], [], 0
    for d, c in pairs:
        docs.append(d)
        codes.append(c)
        held += len(d)
        if held >= FLUSH_CODES:
            yield from _announce(docs, codes, code_parts, narrow, later_only)
            docs, codes, held = [], [], 0
    if held:
        yield from _announce(docs, codes, code_parts, narrow, later_only)


def _announce(docs, codes, code_parts, narrow, later_only):
    docs, codes, least, most = by_code(np.concatenate(docs), np.concatenate(codes))
    known = docs > least if later_only else most > least
    ask = ~known if later_only else (docs == least) | (docs == most)
    if known.any():
        yield dealt(docs[known], codes[known], docs[known] % code_parts, settled=True)
    order = np.argsort(docs[ask], kind="stable")
    docs, codes = docs[ask][order], codes[ask][order]
    yield dealt(docs, codes, (codes % np.uint64(code_parts)).astype(np.int64), code_parts if narrow else 0)


def shared_codes(announced_rows: DataFrame, text_parts: int, narrow: int, later_only: bool) -> DataFrame:
    """Answers by document partition: codes that other documents have too.

    ``later_only``: only to documents for which a smaller id has the code."""

    def resolve(table: pa.Table) -> pa.Table:
        docs, codes, least, most = by_code(*opened(table, narrow))
        keep = docs > least if later_only else most > least
        done = opened(table, settled=True)
        docs, codes = np.append(docs[keep], done[0]), np.append(codes[keep], done[1])
        order = np.argsort(docs, kind="stable")
        docs, codes = docs[order], codes[order]
        return pa.Table.from_batches([dealt(docs, codes, docs % text_parts)], CODES_ARROW)

    return announced_rows.groupBy("part").applyInArrow(resolve, CODES)


class Answers:
    """Which (document, code) pairs were answered."""

    def __init__(self, table: pa.Table):
        docs, codes = opened(table)
        self.marks = np.unique(self._mark(docs, codes))
        self.docs = np.unique(docs)

    @staticmethod
    def _mark(docs: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return mix(docs.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) ^ codes

    def has(self, docs: np.ndarray, codes: np.ndarray) -> np.ndarray:
        if not len(self.marks) or not len(docs):
            return np.zeros(len(docs), bool)
        marks = self._mark(docs, codes)
        at = np.searchsorted(self.marks, marks)
        at[at == len(self.marks)] = 0
        return self.marks[at] == marks


class Windows:
    """Windows of ``width`` units of a chunk in runs that share their least gram."""

    def __init__(self, hashes: np.ndarray, rows: np.ndarray, width: int, gram: int):
        grams = Rolling(hashes).grams(gram)
        self.starts = np.flatnonzero(runs_within(rows, width))
        if not len(self.starts):
            self.codes, self.first, self.sizes = np.zeros(0, np.uint64), self.starts, self.starts
            self.rows = rows[:0]
            return
        codes = sliding_min(grams, width - gram + 1)[self.starts]
        fresh = np.append(True, (codes[1:] != codes[:-1]) | (self.starts[1:] != self.starts[:-1] + 1))
        heads = np.flatnonzero(fresh)
        self.codes, self.first = codes[heads], self.starts[heads]
        self.sizes = np.diff(np.append(heads, len(codes)))
        self.rows = rows[self.first]
