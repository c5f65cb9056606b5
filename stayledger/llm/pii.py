"""Personal data: fixed formats, and identifiers learnt from the contexts of those.

Formats find e-mail addresses, IP addresses, card and phone numbers. Their occurrences are
the seeds. Patterns are the words around an occurrence (two before; one before with one
after). Words that look like identifiers (six characters and four digits at least) are the
instances that patterns may discover. Spark scores the graph of patterns and instances in
turns: a pattern by the share of its distinct instances that are known, an instance by its
patterns, ``1 - product(1 - score)``. Patterns need several distinct seeds and a high share,
so that a chance context discovers nothing.

Defined cases: a null or empty text has no spans; spans count code points; equal rows get
equal spans; very long runs of digits or letters are read in linear time; an empty table
gives no rows; further columns pass through ``redact`` (names starting with ``_pii_`` are
reserved and refused).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.llm.units import chunks
from stayledger.session import materialize

KINDS = ("email", "ip", "card", "phone")
LEARNT = "id"

MIN_SEEDS = 3
PATTERN_LIMIT = 0.75
INSTANCE_LIMIT = 0.9
ROUNDS = 3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# the text before a match decides nothing here, so a run of digits is tried once only
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_EDGES = frozenset(" \t\n\r\x0b\x0c\"'<>()[]{},;|=")

FOUND = T.StructType(
    [
        T.StructField("_pii_spans", T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (
            ("kind", T.StringType()), ("start", T.IntegerType()), ("end", T.IntegerType()))]))),
        T.StructField("_pii_seen", T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (
            ("start", T.IntegerType()), ("end", T.IntegerType()), ("seed", T.BooleanType()),
            ("instance", T.StringType()), ("patterns", T.ArrayType(T.StringType())))]))),
    ]
)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: the part before an @ starts as far left as it can."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            free = m.end()
            found.append((start, free))
        at = text.find("@", max(at + 1, free))
    return found


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _small(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    found = [("email", s, e) for s, e in emails(text)]
    found += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isascii() and c.isdigit() for c in m.group()) <= 15:
            found.append(("phone", *m.span()))
    return found


def _plain(word: str) -> str:
    return re.sub("[0-9]+", "0", word.lower())


def contexts(text: str, start: int, end: int) -> list[str]:
    before = [_plain(w) for w in text[max(0, start - 80) : start].split()[-2:]]
    after = [_plain(w) for w in text[end : end + 60].split()[:1]]
    found = [" ".join(before) + " _"] if len(before) == 2 else []
    if before and after:
        found.append(f"{before[-1]} _ {after[0]}")
    return [p for p in found if any(c.isalpha() for c in p)]  # marks alone tell nothing


def identifiers(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Words with four digits and six characters at least, outside the spans taken."""
    found, done = [], 0
    spans = sorted((s, e) for _, s, e in taken)
    for m in _DIGITS.finditer(text):
        if m.start() < done:
            continue
        start, end = m.span()
        while start > done and text[start - 1] not in _EDGES:
            start -= 1
        while end < len(text) and text[end] not in _EDGES:
            end += 1
        done = end
        while end > start and not text[end - 1].isalnum():
            end -= 1
        word = text[start:end]
        if len(word) >= 6 and sum(c in "0123456789" for c in word) >= 4:
            found.append((start, end))
    if not spans or not found:
        return found
    starts, ends = np.array(spans).T
    ends = np.maximum.accumulate(ends)
    return [(s, e) for s, e in found if (k := int(np.searchsorted(starts, e))) == 0 or ends[k - 1] <= s]


def _scan(batches):
    """Adds the spans and the occurrences with their patterns; needs ``_pii_text``.

    Texts are read in runs of bounded size, and each run goes back on its own."""
    kinds = [pa.field(f.name, _ARROW[f.name]) for f in FOUND]
    for batch in batches:
        for first, data, offsets in chunks(batch.column("_pii_text")):
            yield _scan_run(batch.slice(first, len(offsets) - 1), data, offsets, kinds)


def _scan_run(batch, data, offsets, kinds):
    telling = np.append(0, np.cumsum((data - np.uint8(48) < 10) | (data == 64), dtype=np.int32))
    some = telling[offsets[1:]] > telling[offsets[:-1]]
    spans, seen = [], []
    for row, any_here in enumerate(some.tolist()):
        own, here = [], []
        if any_here:
            text = data[offsets[row] : offsets[row + 1]].tobytes().decode("utf-8", "replace")
            own = base_spans(text)
            for s, e, seed in [(s, e, True) for _, s, e in own] + [(s, e, False) for s, e in identifiers(text, own)]:
                here.append({"start": s, "end": e, "seed": seed, "instance": text[s:e], "patterns": contexts(text, s, e)})
        spans.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
        seen.append(here)
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(spans, kinds[0].type), pa.array(seen, kinds[1].type)],
        schema=pa.schema([*batch.schema, *kinds]),
    )


_SPAN = [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]
_SEEN = [
    ("start", pa.int32()), ("end", pa.int32()), ("seed", pa.bool_()), ("instance", pa.string()),
    ("patterns", pa.list_(pa.string())),
]
_ARROW = {"_pii_spans": pa.list_(pa.struct(_SPAN)), "_pii_seen": pa.list_(pa.struct(_SEEN))}


def learnt_instances(seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Instances that patterns discover, from (instance, seed, patterns)."""
    edges = (
        seen.select("instance", "seed", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "instance")
        .agg(F.max("seed").alias("seed"))
    )
    # a pattern without a seed can only gain from instances that other patterns discover
    edges = materialize(edges, "pii_edges")
    scores = edges.withColumn("score", F.col("seed").cast("double"))
    for _ in range(rounds):
        patterns = scores.groupBy("pattern").agg(
            F.sum("score").alias("known"), F.count(F.lit(1)).alias("all")
        )
        patterns = patterns.where(F.col("known") >= MIN_SEEDS).select(
            "pattern", (F.col("known") / (F.col("all") + 0.5)).alias("strength")
        )
        patterns = patterns.where(F.col("strength") >= PATTERN_LIMIT)
        doubt = F.sum(F.log1p(-F.col("strength")))
        instances = materialize(
            edges.where(~F.col("seed"))
            .join(patterns, "pattern")
            .groupBy("instance")
            .agg((1 - F.exp(doubt)).alias("found")),
            "pii_instances",
        )
        scores = edges.join(instances, "instance", "left").select(
            "pattern",
            "instance",
            F.when(F.col("seed"), F.lit(1.0)).otherwise(F.coalesce("found", F.lit(0.0))).alias("score"),
        )
    return instances.where(F.col("found") >= INSTANCE_LIMIT).select("instance")


def _without_text(batches):
    for batch in _scan(batches):
        yield batch.drop_columns(["_pii_text"])


def find(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, with_text: bool = False) -> DataFrame:
    """The columns in ``keep`` (all by default) with ``_pii_spans``: kind, start, end of every span.

    ``with_text``: the text that was read comes along as ``_pii_text``, so that it need not stand in ``keep``."""
    if bad := [c for c in docs.columns if c.lower().startswith("_pii_")]:
        raise ValueError(f"reserved column names: {bad}")
    keep = docs.columns if keep is None else keep
    source = docs.select(
        *[F.col(f"`{c}`") for c in keep],
        F.monotonically_increasing_id().alias("_pii_row"),
        F.col(text_col).cast("binary").alias("_pii_text"),
    )
    kept = [f for f in source.schema if with_text or f.name != "_pii_text"]
    scan = _scan if with_text else _without_text
    scanned = materialize(source.mapInArrow(scan, T.StructType([*kept, *FOUND])), "pii_scanned")
    seen = scanned.select("_pii_row", F.explode("_pii_seen").alias("x")).select("_pii_row", "x.*")
    learnt = learnt_instances(seen)
    span = F.struct(F.lit(LEARNT).alias("kind"), "start", "end")
    more = (
        seen.where(~F.col("seed"))
        .join(learnt, "instance")
        .groupBy("_pii_row")
        .agg(F.sort_array(F.collect_list(span)).alias("_pii_more"))
    )
    more = materialize(more, "pii_learnt")  # its size is known now, so Spark can tell whether to broadcast it
    empty = F.array().cast(FOUND["_pii_spans"].dataType)
    joined = scanned.join(more, "_pii_row", "left")
    return joined.withColumn("_pii_spans", F.concat("_pii_spans", F.coalesce("_pii_more", empty))).drop(
        "_pii_row", "_pii_seen", "_pii_more"
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets."""
    others = [c for c in docs.columns if c != text_col]
    found = find(docs, text_col, keep=others, with_text=True)
    ordered = F.array_sort(
        F.transform("_pii_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    text = F.col("_pii_text").cast(docs.schema[text_col].dataType)
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(state, span):
        # spans of two kinds may overlap; what is covered already is not put out again
        head = F.substr(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] >= state["at"], F.concat(F.lit("<"), span["kind"], F.lit(">"))).otherwise(F.lit(""))
        return F.struct(
            F.concat(state["out"], head, mark).alias("out"), F.greatest(state["at"], span["end"]).alias("at")
        )

    done = F.aggregate(
        ordered, start, put, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.length(text)))
    )
    cleaned = F.when(F.size("_pii_spans") == 0, text).otherwise(done)
    return found.select(*[cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])


def pii_digest(docs: DataFrame) -> DataFrame:
    found = find(docs, keep=["doc_id"])
    spans = F.col("_pii_spans")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def said(array):
        return F.array_join(
            F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = said(F.filter(spans, lambda s: s["kind"] != LEARNT))
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"), said(spans).alias("spans")
    )
