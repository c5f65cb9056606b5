"""Repeated byte strings through suffix order and longest previous factors.

A string of 50 bytes is looked up by its least gram of 20 bytes (by hash, so that equal
strings choose alike). A run of strings with the same least gram is announced with that
gram's code and a hash of all its bytes. Grams that one document alone has cannot lie in a
repeat and stop there. A run that a smaller document has with all its bytes is a later copy
and settled. Where runs around the same gram differ, their bytes travel to the gram's
partition; the suffixes that start in them are put in order (to the depth of 50 bytes, which
is all that decides), and for each suffix the nearest ones before and after it in that order
that lie in a smaller document are its possible earlier matches: its previous factor is long
enough if it shares 50 bytes with one of them. Later copies go, the first stays.

Defined cases: a null or empty text has no bytes; a text shorter than 50 bytes loses nothing;
rows with equal ids do not remove each other's bytes; a null id comes after all others; an
empty table gives no rows; bytes that are not UTF-8 are bytes like others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.exchange import NO_ID, Windows, partition_counts, rows_by_document
from stayledger.llm.substring_dedup import by_document
from stayledger.llm.units import Rolling, byte_table, chunks, mix, pack

LENGTH = 50
GRAM = 20
FLUSH_RUNS = 1 << 19
FLUSH_BYTES = 16 << 20

#: Columns of the exchanges: everything but the partition is an array in a binary value.
_TYPES = {
    "docs": np.int64, "counts": np.uint32, "codes": np.uint32, "low": np.uint32, "high": np.uint16,
    "marks": np.uint64, "texts": np.uint64, "starts": np.int32, "sizes": np.int32, "bytes": np.uint8,
}
RUNS = ("docs", "codes", "low", "high", "marks")
MARKS = ("docs", "marks")
AROUND = ("docs", "texts", "starts", "sizes", "bytes")
FOUND = ("docs", "texts", "starts", "sizes")
RESULT = "doc long, n_bytes long, n_removed long, kept binary, spans array<struct<start:int,bytes:int>>"
#: Lowest bit of a mark: the run is a later copy, or its bytes are to be compared.
COPY, COMPARE = 0, 1


def _schema(names: tuple[str, ...]) -> tuple[str, pa.Schema]:
    """For Spark and for Arrow. Documents are run-length coded in docs and counts."""
    names = ("docs", "counts", *names[1:])
    said = "part long, " + ", ".join(f"{n} binary" for n in names)
    return said, pa.schema([("part", pa.int64()), *[(n, pa.binary()) for n in names]])


def _texts(batch, length: int, gram: int):
    docs = batch.column("doc").to_numpy()
    table = byte_table("byte", fold_case=False)
    for first, data, offsets in chunks(batch.column("text")):
        rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        yield docs[first : first + len(offsets) - 1], data, offsets, Windows(table[data], rows, length, gram), table


def _whole(data, offsets, table) -> np.ndarray:
    return Rolling(table[data]).span(offsets[:-1], offsets[1:])


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of many pieces, one after the other."""
    ends = np.cumsum(sizes)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)]


def _split(names, columns: dict[str, np.ndarray], parts: np.ndarray, data=None) -> pa.RecordBatch:
    """A record batch with a row per partition; data: (bytes, starts, sizes) of each entry.

    Columns that are not given are empty."""
    schema = _schema(names)[1]
    order = np.argsort(parts, kind="stable")
    found, firsts = np.unique(parts[order], return_index=True)
    out = {n: [] for n in schema.names[1:]}
    for a, b in zip(firsts, np.append(firsts[1:], len(order))):
        own = order[a:b]
        docs = columns["docs"][own]
        heads = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
        out["docs"].append(pack(docs[heads]))
        out["counts"].append(pack(np.diff(np.append(heads, len(docs))).astype(np.uint32)))
        for name in schema.names[3:]:
            if name in columns:
                out[name].append(pack(columns[name][own].astype(_TYPES[name])))
            else:
                out[name].append(pack(gather(data[0], data[1][own], data[2][own])) if name == "bytes" and data else b"")
    return pa.record_batch([pa.array(found.astype(np.int64)), *[pa.array(c, pa.binary()) for c in out.values()]], schema=schema)


def _joined(table: pa.Table, names, filled: str) -> dict[str, np.ndarray]:
    """The columns of the rows of one partition in which the column ``filled`` is not empty."""
    rows = [r for r in zip(*(table.column(n).to_pylist() for n in _schema(names)[1].names))]
    at = {n: k for k, n in enumerate(_schema(names)[1].names)}
    rows = [r for r in rows if r[at[filled]]]
    out = {}
    for name in ("counts", *names):
        kind = _TYPES[name]
        out[name] = np.concatenate([np.zeros(0, kind), *[np.frombuffer(r[at[name]], kind) for r in rows]])
    out["docs"] = np.repeat(out["docs"], out.pop("counts"))
    sizes = [len(r[at["docs"]]) and int(np.frombuffer(r[at["counts"]], np.uint32).sum()) for r in rows]
    out["part"] = np.repeat(np.array([r[0] for r in rows], np.int64), np.array(sizes, np.int64))
    return out


def _mark(codes: np.ndarray, low: np.ndarray, high: np.ndarray, kind: int) -> np.ndarray:
    """A number for a run: its gram's code and the hash of its bytes, with the kind of answer."""
    whole = (high.astype(np.uint64) << np.uint64(32)) | low
    return (mix(codes.astype(np.uint64) ^ mix(whole)) & ~np.uint64(1)) | np.uint64(kind)


def _groups(*keys: np.ndarray) -> np.ndarray:
    """True where sorted keys change."""
    fresh = np.ones(len(keys[0]), bool)
    fresh[1:] = False
    for key in keys:
        fresh[1:] |= key[1:] != key[:-1]
    return fresh


def _least(values: np.ndarray, fresh: np.ndarray, pick=np.minimum) -> np.ndarray:
    heads = np.flatnonzero(fresh)
    if not len(heads):
        return values
    return np.repeat(pick.reduceat(values, heads), np.diff(np.append(heads, len(values))))


def _sorted_runs(docs, codes, whole):
    order = np.lexsort((docs, whole, codes))
    docs, codes, whole = docs[order], codes[order], whole[order]
    fresh = _groups(docs, codes, whole)
    return docs[fresh], codes[fresh], whole[fresh]


def announce_runs(docs, codes, whole, code_parts: int):
    """Runs of a task: of equal ones only that of the least document asks, later copies are settled."""
    docs, codes, whole = _sorted_runs(docs, codes, whole)
    n = np.uint64(code_parts)
    columns = {
        "docs": docs,
        "codes": (codes // n).astype(np.uint32),
        "low": (whole & np.uint64(0xFFFFFFFF)).astype(np.uint32),
        "high": (whole >> np.uint64(48)).astype(np.uint16),
    }
    # equal to all bits that travel, so that both ends name a run alike
    ask = docs == _least(docs, _groups(codes, columns["low"], columns["high"]))
    rest = ~ask
    if rest.any():
        marks = _mark(columns["codes"][rest], columns["low"][rest], columns["high"][rest], COPY)
        order = np.argsort(docs[rest], kind="stable")
        own = docs[rest][order]
        yield _split(RUNS, {"docs": own, "marks": marks[order]}, own % code_parts)
    order = np.flatnonzero(ask)[np.argsort(docs[ask], kind="stable")]
    yield _split(RUNS, {k: v[order] for k, v in columns.items()}, (codes[order] % n).astype(np.int64))


def resolve_runs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(documents, marks) of later copies, and of runs to compare: first ones of their bytes
    around a gram that other documents have in other surroundings."""
    done, open_ = _joined(table, RUNS, "marks"), _joined(table, RUNS, "codes")
    whole = (open_["high"].astype(np.uint64) << np.uint64(32)) | open_["low"]
    docs, codes, whole = _sorted_runs(open_["docs"], open_["codes"], whole)
    by_gram, by_run = _groups(codes), _groups(codes, whole)
    copy = docs > _least(docs, by_run)
    shared = _least(docs, by_gram) < _least(docs, by_gram, np.maximum)
    kinds = _least(by_run.astype(np.int64), by_gram, np.add)
    compare = ~copy & shared & (kinds > 1)
    low, high = whole & np.uint64(0xFFFFFFFF), whole >> np.uint64(32)
    out_docs = np.concatenate([done["docs"], docs[copy], docs[compare]])
    out = [done["marks"], _mark(codes[copy], low[copy], high[copy], COPY)]
    out.append(_mark(codes[compare], low[compare], high[compare], COMPARE))
    return out_docs, np.concatenate(out)


def _counts(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... size-1 for each size in turn."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def _merged(docs, texts, starts, sizes):
    """Intervals of window starts, those that touch as one."""
    order = np.lexsort((starts, texts, docs))
    docs, texts, starts, sizes = docs[order], texts[order], starts[order].astype(np.int64), sizes[order].astype(np.int64)
    fresh = _groups(docs, texts)
    ends = starts + sizes
    if len(ends) > 1:
        group = np.cumsum(fresh) * (np.int64(1) << 33)
        reach = np.maximum.accumulate(ends + group) - group
        fresh[1:] |= starts[1:] > reach[:-1]
    else:
        reach = ends
    heads = np.flatnonzero(fresh)
    last = np.append(heads[1:], len(docs))[: len(heads)] - 1
    return {"docs": docs[heads], "texts": texts[heads], "starts": starts[heads], "sizes": reach[last] - starts[heads]}


def previous_factor(docs: np.ndarray, starts: np.ndarray, data: np.ndarray, length: int) -> np.ndarray:
    """True for the suffixes whose longest previous factor has ``length`` bytes.

    Suffixes in order; neighbours that share ``length`` bytes stand in one block. The previous
    (next) smaller position of a suffix lies in its block exactly if the least document before
    (after) it in the block is smaller than its own.
    """
    eight = np.zeros(len(data), np.uint64)
    for k in range(8):
        eight[: len(data) - k] |= data[k:].astype(np.uint64) << np.uint64(56 - 8 * k)
    depths = [*range(0, length - 7, 8)] + ([length - 8] if length % 8 else []) if length >= 8 else [0]
    keys = [eight[starts + d] for d in depths]
    if length < 8:
        keys[0] >>= np.uint64(64 - 8 * length)
    order = np.lexsort(keys[::-1])
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for key in keys:
        key = key[order]
        fresh[1:] |= key[1:] != key[:-1]
    block = np.cumsum(fresh) - 1
    names, rank = np.unique(docs[order], return_inverse=True)
    step = len(names) + 1
    before = np.minimum.accumulate(rank - block * step) + block * step
    after = (np.minimum.accumulate((rank + block * step)[::-1]))[::-1] - block * step
    found = np.zeros(len(order), bool)
    found[order] = (before < rank) | (after < rank)
    return found


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col="doc_id", text_col="text"):
    """Per document: its id, bytes, removed bytes, the bytes kept and the removed runs."""
    rows = rows_by_document(docs, id_col, text_col)
    code_parts, text_parts = partition_counts(rows)
    texts = by_document(rows, text_parts)

    def around(at: Windows, data, table):
        return Rolling(table[data]).span(at.first, at.first + at.sizes + length - 1)

    def announce(batches):
        held, size = [], 0
        for batch in batches:
            for docs, data, _, at, table in _texts(batch, length, gram):
                held.append((docs[at.rows], at.codes, around(at, data, table)))
                size += len(at.codes)
                if size >= FLUSH_RUNS:
                    yield from announce_runs(*map(np.concatenate, zip(*held)), code_parts)
                    held, size = [], 0
        if size:
            yield from announce_runs(*map(np.concatenate, zip(*held)), code_parts)

    def resolve(table: pa.Table) -> pa.Table:
        docs, marks = resolve_runs(table)
        order = np.argsort(docs, kind="stable")
        columns = {"docs": docs[order], "marks": marks[order]}
        return pa.Table.from_batches([_split(MARKS, columns, docs[order] % text_parts)], _schema(MARKS)[1])

    def surround(left: pa.Table, right: pa.Table) -> pa.Table:
        known = _joined(right, MARKS, "docs")
        known = np.unique(mix(known["docs"].astype(np.uint64)) ^ known["marks"])

        def has(docs, marks):
            keys = mix(docs.astype(np.uint64)) ^ marks
            at = np.searchsorted(known, keys)
            at[at == len(known)] = 0
            return known[at] == keys if len(known) else np.zeros(len(keys), bool)

        out, held, size = [], [], 0

        def flush():
            columns = {n: np.concatenate([h[0][n] for h in held]) for n in held[0][0]}
            spans, parts = (np.concatenate([h[k] for h in held]) for k in (2, 3))
            data = np.concatenate([h[1] for h in held])
            out.append(_split(AROUND, columns, parts, (data, np.cumsum(spans) - spans, spans)))

        for docs, data, offsets, at, table in _texts(left, length, gram):
            whole = around(at, data, table)
            low, high = (whole & np.uint64(0xFFFFFFFF)), whole >> np.uint64(48)
            codes = ((at.codes // np.uint64(code_parts)).astype(np.uint32)).astype(np.uint64)
            owner = docs[at.rows]
            text = _whole(data, offsets, table)[at.rows]
            start = at.first - offsets[at.rows]
            copy = has(owner, _mark(codes, low, high, COPY))
            if copy.any():
                intervals = _merged(owner[copy], text[copy], start[copy], at.sizes[copy])
                out.append(_split(AROUND, intervals, intervals["docs"] % code_parts))
            hit = np.flatnonzero(has(owner, _mark(codes, low, high, COMPARE)) & ~copy)
            if len(hit):
                spans = at.sizes[hit] + length - 1
                columns = {"docs": owner[hit], "texts": text[hit], "starts": start[hit], "sizes": at.sizes[hit]}
                parts = (at.codes[hit] % np.uint64(code_parts)).astype(np.int64)
                held.append((columns, gather(data, at.first[hit], spans), spans, parts))
                size += int(spans.sum())
                if size >= FLUSH_BYTES:
                    flush()
                    held, size = [], 0
        if held:
            flush()
        return pa.Table.from_batches(out, _schema(AROUND)[1])

    def match(table: pa.Table) -> pa.Table:
        c = _joined(table, AROUND, "bytes")
        sizes = c["sizes"].astype(np.int64)
        spans = sizes + length - 1
        entry = np.repeat(np.arange(len(sizes)), sizes)
        offset = _counts(sizes)
        found = previous_factor(c["docs"][entry], (np.cumsum(spans) - spans)[entry] + offset, c["bytes"], length)
        entry, offset = entry[found], offset[found]
        matched = c["docs"][entry], c["texts"][entry], c["starts"][entry] + offset, np.ones(len(entry), np.int64)
        # intervals of later copies come along without bytes
        whole = _joined(_without_bytes(table), AROUND, "docs")
        copies = whole["docs"], whole["texts"], whole["starts"], whole["sizes"]
        columns = _merged(*(np.concatenate(x) for x in zip(matched, copies)))
        return pa.Table.from_batches([_split(FOUND, columns, columns["docs"] % text_parts)], _schema(FOUND)[1])

    marked = rows.mapInArrow(announce, _schema(RUNS)[0]).groupBy("part").applyInArrow(resolve, _schema(MARKS)[0])
    compared = texts.groupBy("part").cogroup(marked.groupBy("part")).applyInArrow(surround, _schema(AROUND)[0])
    found = compared.groupBy("part").applyInArrow(match, _schema(FOUND)[0])

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        c = _joined(right, FOUND, "docs")
        order = np.lexsort((c["texts"], c["docs"]))
        c = {n: v[order] for n, v in c.items()}
        table = byte_table("byte", False)
        out = {n: [] for n in ("doc", "n_bytes", "n_removed", "kept", "spans")}
        docs = left.column("doc").to_numpy()
        for first, data, offsets in chunks(left.column("text")):
            whole = _whole(data, offsets, table)
            own = docs[first : first + len(whole)]
            lows, highs = np.searchsorted(c["docs"], own), np.searchsorted(c["docs"], own, "right")
            for row in range(len(whole)):
                piece = data[offsets[row] : offsets[row + 1]]
                a, b = lows[row], highs[row]
                here = np.flatnonzero(c["texts"][a:b] == whole[row]) + a
                out["doc"].append(int(own[row]))
                out["n_bytes"].append(len(piece))
                if not len(here):
                    out["n_removed"].append(0)
                    out["kept"].append(piece.tobytes())
                    out["spans"].append([])
                    continue
                mask = np.zeros(len(piece) + 1, np.int64)
                np.add.at(mask, c["starts"][here], 1)
                np.subtract.at(mask, np.minimum(c["starts"][here] + c["sizes"][here] + length - 1, len(piece)), 1)
                gone = np.cumsum(mask[:-1]) > 0
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
                out["n_removed"].append(int(gone.sum()))
                out["kept"].append(piece[~gone].tobytes())
                out["spans"].append(
                    [{"start": int(s), "bytes": int(e - s)} for s, e in zip(edges[::2], edges[1::2])]
                )
        return pa.Table.from_pydict(out, _result_arrow())

    return texts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(cut, RESULT)


def _without_bytes(table: pa.Table) -> pa.Table:
    return table.filter(pa.array([len(x.as_py()) == 0 for x in table.column("bytes")], pa.bool_()))


def _result_arrow():
    spans = pa.list_(pa.struct([("start", pa.int32()), ("bytes", pa.int32())]))
    return pa.schema(
        [("doc", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()), ("spans", spans)]
    )


def repeats_digest(docs: DataFrame) -> DataFrame:
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
