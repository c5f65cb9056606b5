"""Document fingerprints from spot signatures.

After each common word (anchor) the next two content words form a signature. So that texts
with few common words, or in other languages, have signatures too, the start of a text and
every word whose hash falls into one class of eight are anchors as well. A
fingerprint is the set of signatures, as hashes in hexadecimal, in order. Likeness is the
Jaccard of two sets. ``similar_documents`` compares the fingerprints of many documents: a set
meets only sets of its length class and the next, and pairs that their lengths or summaries
rule out are dropped before they are compared.

Words are runs of letters, digits and non-ASCII characters, A-Z folded.

Defined cases: a null or empty text, and one without words, has the empty fingerprint; two
empty fingerprints are alike (1), an empty and another one are not (0); equal texts have equal
fingerprints; documents follow each other by id, null last, then text; a single document is
its own next; an empty table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.exchange import NO_ID
from stayledger.llm.jaccard_join import linked_documents
from stayledger.llm.units import byte_table, mix, random_words, word_hashes, words

# Common words of four languages.
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were with not "
    "au aux avec ce dans de des du elle en est et il la le les ne par pas pour qui que sur un une "
    "als auch auf das dem den der des die ein eine einer für im in ist mit nicht sich und von zu "
    "al como con del el en es la las lo los no para por que se su una y"
)
CHAIN = 2
CLASSES = 8
GROUP_BYTES = 16 << 20
CHUNK = 1 << 20
RESULT = (
    "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _separators() -> np.ndarray:
    table = np.ones(256, bool)
    table[128:] = False
    for a, b in ((48, 58), (65, 91), (97, 123)):
        table[a:b] = False
    return table


def _anchor_hashes(table: np.ndarray) -> np.ndarray:
    names = sorted(set(ANCHORS.split()))
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]))
    return np.unique(word_hashes(data, starts, ends, table))


def signature_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) of the texts, distinct and in order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    offsets = np.append(0, np.cumsum(sizes))
    data = np.frombuffer(b"".join(texts), np.uint8)
    table = byte_table("spot", fold_case=True)
    starts, ends, rows = words(data, offsets, _separators())
    hashes = word_hashes(data, starts, ends, table)
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    common = _anchor_hashes(table)
    at = np.searchsorted(common, hashes)
    at[at == len(common)] = 0
    listed = common[at] == hashes
    anchor = listed | (hashes % np.uint64(CLASSES) == 0)
    content = np.flatnonzero(~listed)
    first_word = np.append(True, rows[1:] != rows[:-1])
    # from each anchor and each text's start, the next content words of the same text
    opened = np.concatenate([np.flatnonzero(anchor) + 1, np.flatnonzero(first_word)])
    owner = np.concatenate([rows[anchor], rows[first_word]])
    name = np.concatenate([hashes[anchor], np.full(int(first_word.sum()), random_words("start", 1)[0])])
    nxt = np.searchsorted(content, opened)
    code = mix(name)
    padded = np.append(content, np.full(CHAIN, -1))
    took = np.zeros(len(opened), bool)
    for k in range(CHAIN):
        pos = padded[np.minimum(nxt + k, len(content))]
        ok = (pos >= 0) & (rows[np.maximum(pos, 0)] == owner)
        word = np.where(ok, hashes[np.maximum(pos, 0)], np.uint64(0))
        code = mix(code * np.uint64(0x9E3779B97F4A7C15) + word)
        took |= ok
    # an anchor that nothing follows says nothing, but a text of common words alone keeps its start
    keep = took | (name == random_words("start", 1)[0])
    pairs = np.unique((owner[keep].astype(np.uint64) << np.uint64(32)) | (code[keep] >> np.uint64(32)))
    return (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _hexes(rows: np.ndarray, codes: np.ndarray, n: int) -> list[str]:
    edges = np.searchsorted(rows, np.arange(n + 1)) * 4
    raw = codes.astype(">u4").tobytes()
    return [raw[a:b].hex() for a, b in zip(edges, edges[1:])]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Jaccard of the n sets of a and of b, row by row."""
    x, y = (r.astype(np.uint64) << np.uint64(32) | c for r, c in (a, b))
    both = np.intersect1d(x, y, assume_unique=True) >> np.uint64(32)
    shared = np.bincount(both.astype(np.int64), minlength=n)
    union = np.bincount(a[0], minlength=n) + np.bincount(b[0], minlength=n) - shared
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def edit(text: str, following: str) -> str:
    """The last quarter of the text gives way to the start of the following one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _followed(docs: DataFrame) -> DataFrame:
    """Rows in ranges of ids; each range also holds the first row of the next one as a guest."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    bounds, least = id_ranges(rows)

    @F.pandas_udf("array<struct<range:long,turn:int>>")
    def ranges(ids):
        import pandas as pd

        own = np.searchsorted(bounds, ids.to_numpy(), "right")
        first = np.isin(ids.to_numpy(), bounds)
        start = ids.to_numpy() == least
        last = len(bounds)
        return pd.Series(
            [
                [{"range": int(r), "turn": 0}]
                + ([{"range": int(r) - 1, "turn": 1}] if f else [])
                + ([{"range": last, "turn": 2}] if s else [])
                for r, f, s in zip(own, first, start)
            ]
        )

    return rows.select("doc", "text", F.explode(ranges("doc")).alias("x")).select("x.range", "x.turn", "doc", "text")


def id_ranges(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Ids at which ranges of about ``GROUP_BYTES`` of text begin, and the least id."""
    total, n, least = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1)), F.min("doc")).first()
    parts = max(12, -(-(total or 0) // GROUP_BYTES))
    if not n:
        return np.zeros(0, np.int64), 0
    at = [k / parts for k in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc", at, 100 * parts)).first()[0]
    return np.array(sorted({b for b in found if b > least}), np.int64), least


def _judge(table: pa.Table) -> pa.Table:
    order = table.sort_by([("turn", "ascending"), ("doc", "ascending"), ("text", "ascending")])
    turns = order.column("turn").to_numpy()
    n = int((turns == 0).sum())
    docs = order.column("doc").to_numpy()[:n]
    texts = order.column("text")
    out = {f.split()[0]: [] for f in RESULT.split(", ")}
    first = 0
    # a guest from the next range follows the last row; only the last range has the first row of all
    while first < n:
        last, size = first, 0
        while last < n and (last == first or size < CHUNK):
            size += len(texts[last].as_py())
            last += 1
        own = [t.as_py() for t in texts[first : min(last + 1, len(texts))]]
        if len(own) == last - first:
            own.append(own[-1])
        edited = [edit(a, b).encode() for a, b in zip(own, own[1:])]
        k = len(edited)
        rows, codes = signature_sets([t.encode() for t in own])
        low, high = np.searchsorted(rows, [k, 1])
        mine = rows[:low], codes[:low]
        following = rows[high:] - 1, codes[high:]
        changed = signature_sets(edited)
        out["doc"] += docs[first:last].tolist()
        out["n_chars"] += [len(t) for t in own[:k]]
        out["edited_sha256"] += [hashlib.sha256(t).hexdigest() for t in edited]
        out["fingerprint"] += _hexes(*mine, k)
        out["edited_fingerprint"] += _hexes(*changed, k)
        out["near_edited"] += likeness(mine, changed, k).tolist()
        out["near_next"] += likeness(mine, following, k).tolist()
        first = last
    return pa.Table.from_pydict(out, _result_arrow())


def _result_arrow():
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in RESULT.split(", ")])


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    found = _followed(docs.select("doc_id", "text")).groupBy("range").applyInArrow(_judge, RESULT)
    return found.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), *found.columns[1:])


def _chunk_sets(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    raw = data.tobytes()
    rows, codes = signature_sets([raw[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist())])
    spread = mix(codes.astype(np.uint64))
    return [np.sort(x) for x in np.split(spread, np.searchsorted(rows, np.arange(1, len(offsets) - 1)))]


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_signatures, component_id): documents whose fingerprints are alike by 0.8, directly or
    through others, share the least id among them; one without words is alone."""
    found = linked_documents(docs.select("doc_id", "text"), make=_chunk_sets)
    shown = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("doc", "doc_id"), ("component", "component_id"))]
    return found.select(shown[0], F.col("n").alias("n_signatures"), shown[1])
