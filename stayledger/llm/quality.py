"""Quality classifier: random-indexing word vectors, pooled, under a two-layer network.

Tokens are words, runs of punctuation, and a token for the shape of each word (case, digits,
length, repeat of the word before). Every token has a bucket by its hash, and every bucket a
sparse random index vector of +1 and -1. The vector of a bucket is the sum of the index
vectors of its neighbours, two on either side, over the whole corpus: tasks sum their part
and Spark adds the parts block by block. A document is pooled as mean and spread of its
tokens' vectors and the share of each shape. The network (numpy, two layers) is fitted on a
bounded sample of labelled documents, about ``SAMPLE`` at most, chosen by hash; part of it sets the
temperature that calibrates the probabilities.

The table of vectors has ``BUCKETS * DIMENSIONS`` numbers whatever the corpus, so it may be
collected and sent to all tasks (4 MB).

Defined cases: an empty or null text has the zero vector and a score like any other; without
labels, or with one label only, every score is the smoothed share of good labels; repeated
label rows count by their mean; null labels are left out; an empty table gives no rows;
further columns pass through ``keep_good`` (names starting with ``_q_`` are refused).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.llm.units import byte_table, chunks, pack, random_words, space_table, word_hashes
from stayledger.session import materialize, scratch

BUCKETS = 1 << 15
DIMENSIONS = 32
NONZERO = 2
REACH = 2
TEXT_CHUNK = 1 << 18
STREAM = 1 << 19
BLOCK = 512
SHAPES = 16
SAMPLE = 20_000
HIDDEN = 24
THRESHOLD = 0.3
FOLDS = 5

POOLED = DIMENSIONS * 2 + SHAPES + 1


def _classes() -> np.ndarray:
    """0 space, 1 word, and 2 and on for each punctuation byte, so that a run is of one kind."""
    kinds = np.ones(256, np.uint8)
    kinds[:128] = np.arange(128) + 2
    for a, b in ((48, 58), (65, 91), (97, 123)):
        kinds[a:b] = 1
    kinds[space_table()] = 0
    return kinds


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, shape) of the tokens of a chunk; shape -1 for punctuation."""
    kinds = _classes()[data]
    edge = np.ones(len(data) + 1, bool)
    edge[1:-1] = kinds[1:] != kinds[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    real = kinds[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    rows = np.searchsorted(offsets, starts, "right") - 1
    word = kinds[starts] == 1
    hashes = word_hashes(data, starts, ends, byte_table("quality", False))
    folded = word_hashes(data, starts, ends, byte_table("quality", True))
    upper = np.append(0, np.cumsum((data >= 65) & (data <= 90)))
    digit = np.append(0, np.cumsum((data >= 48) & (data <= 57)))
    size = ends - starts
    capitals = upper[ends] - upper[starts]
    first = (data[starts] >= 65) & (data[starts] <= 90)
    shape = np.where(capitals == 0, 0, np.where((capitals == 1) & first, 1, 2))
    shape = np.where(digit[ends] > digit[starts], 3, shape) + 4 * (size > 7)
    again = np.zeros(len(starts), bool)
    again[1:] = (folded[1:] == folded[:-1]) & (rows[1:] == rows[:-1])
    shape = np.where(word, shape + 8 * again, -1)
    return rows, (np.where(word, folded, hashes) % np.uint64(BUCKETS)).astype(np.int64), shape


def _stream(rows, buckets, shapes):
    """The tokens with each word's shape after it, as rows and buckets."""
    word = shapes >= 0
    times = 1 + word
    out_rows, out = np.repeat(rows, times), np.repeat(buckets, times)
    ends = np.cumsum(times) - 1
    out[ends[word]] = shape_buckets()[shapes[word]]
    return out_rows, out


def _streams(batches):
    """(rows, buckets) of many texts, put together until there are ``STREAM`` tokens.

    Texts are taken in small chunks, as finding tokens takes many times a chunk's bytes; what is kept is narrow."""
    held, size, first = [], 0, 0
    for batch in batches:
        for _, data, offsets in chunks(batch.column("text"), TEXT_CHUNK):
            rows, own = _stream(*tokens(data, offsets))
            held.append(((rows + first).astype(np.int32), own.astype(np.int32)))
            first, size = first + len(offsets) - 1, size + len(rows)
            if size >= STREAM:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size, first = [], 0, 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def shape_buckets() -> np.ndarray:
    return (random_words("shape", SHAPES) % np.uint64(BUCKETS)).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(dimensions, signs) of the entries of each bucket's index vector."""
    draws = random_words("index", BUCKETS * NONZERO).reshape(BUCKETS, NONZERO)
    return (draws % np.uint64(DIMENSIONS)).astype(np.int64), np.where(draws >> np.uint64(63), 1, -1)


def _context_sums(batches):
    dims, signs = index_vectors()
    total = np.zeros(BUCKETS * DIMENSIONS, np.int64)
    for rows, own in _streams(batches):
        for step in range(1, REACH + 1):
            same = np.flatnonzero(rows[step:] == rows[:-step])
            left, right = own[same], own[same + step]
            for a, b in ((left, right), (right, left)):
                for k in range(NONZERO):
                    at, sign = a * DIMENSIONS + dims[b, k], signs[b, k]
                    total += np.bincount(at[sign > 0], minlength=len(total))
                    total -= np.bincount(at[sign < 0], minlength=len(total))
    blocks = total.reshape(-1, BLOCK * DIMENSIONS)
    yield pa.record_batch(
        [pa.array(np.arange(len(blocks))), pa.array([pack(b) for b in blocks], pa.binary())], names=["block", "sums"]
    )


def _add_blocks(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("sums"))
    return pa.table({"block": table.column("block")[:1], "sums": pa.array([pack(total)], pa.binary())})


def word_vectors(docs: DataFrame) -> np.ndarray:
    """BUCKETS x DIMENSIONS: context sums of the corpus, centred and of unit length."""
    texts = docs.select(F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    parts = texts.mapInArrow(_context_sums, "block long, sums binary")
    # tasks first add up within groups, so that no block's parts all meet at once
    grouped = parts.withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(64)))
    summed = grouped.groupBy("block", "lane").applyInArrow(_add_lanes, "block long, sums binary")
    blocks = summed.groupBy("block").applyInArrow(_add_blocks, "block long, sums binary").collect()
    sums = np.zeros((BUCKETS, DIMENSIONS))
    for row in blocks:
        at = row["block"] * BLOCK
        sums[at : at + BLOCK] = np.frombuffer(row["sums"], np.int64).reshape(BLOCK, DIMENSIONS)
    sums = np.sign(sums) * np.log1p(np.abs(sums))
    sums -= sums.mean(0)
    return (sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _add_lanes(table: pa.Table) -> pa.Table:
    return _add_blocks(table.select(["block", "sums"]))


def pool(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """A row of ``POOLED`` numbers for each text of a chunk."""
    n = len(offsets) - 1
    out = np.zeros((n, POOLED), np.float32)
    rows, buckets, shapes = tokens(data, offsets)
    if not len(rows):
        return out
    heads = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    count = np.diff(np.append(heads, len(rows)))[:, None]
    here = rows[heads]
    own = vectors[buckets]
    mean = np.add.reduceat(own, heads) / count
    out[here, :DIMENSIONS] = mean
    np.multiply(own, own, out=own)
    out[here, DIMENSIONS : 2 * DIMENSIONS] = np.sqrt(np.maximum(np.add.reduceat(own, heads) / count - mean**2, 0))
    kind = np.bincount(rows * (SHAPES + 1) + shapes + 1, minlength=n * (SHAPES + 1)).reshape(n, SHAPES + 1)
    out[:, 2 * DIMENSIONS :] = kind / np.maximum(kind.sum(1, keepdims=True), 1)
    return out


def pooled(docs: DataFrame, keep: list[str], vectors: np.ndarray) -> DataFrame:
    """The columns in ``keep`` with the pooled vector, stored."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for batch in batches:
            table = shared.value
            made = [pack(row) for _, d, o in chunks(batch.column("_q_text"), TEXT_CHUNK) for row in pool(d, o, table)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(made, pa.binary())], names=[*keep, "_q_vector"]
            )

    source = docs.select(*[F.col(f"`{c}`") for c in keep], _text().alias("_q_text"))
    fields = [f for f in source.schema if f.name != "_q_text"]
    made = source.mapInArrow(run, T.StructType([*fields, T.StructField("_q_vector", T.BinaryType())]))
    return materialize(made, "quality_pooled")


def _text():
    return F.coalesce(F.col("text").cast("binary"), F.lit(b""))


class Network:
    """Two layers of numpy; ``temperature`` divides the logit."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7, epochs: int = 60):
        self.middle, self.spread = x.mean(0), x.std(0) + 1e-3
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(x))
        calib, fit = order[: len(x) // 5], order[len(x) // 5 :]
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN)]
        w += [rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1)]
        self.weights, self.temperature = w, 1.0
        first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        scaled, step = self._scaled(x), 0
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // 256)):
                step += 1
                a, target = scaled[batch], y[batch, None]
                hidden = np.maximum(a @ w[0] + w[1], 0)
                error = (_sigmoid(hidden @ w[2] + w[3]) - target) / len(batch)
                back = (error @ w[2].T) * (hidden > 0)
                grads = [a.T @ back + 1e-4 * w[0], back.sum(0), hidden.T @ error + 1e-4 * w[2], error.sum(0)]
                for k, g in enumerate(grads):
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    rate = 3e-3 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    w[k] -= rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        if len(calib):
            logits = self.logits(x[calib])
            losses = {t: _loss(logits / t, y[calib]) for t in np.geomspace(0.25, 8, 41)}
            self.temperature = float(min(losses, key=losses.get))

    def _scaled(self, x):
        return np.clip((x - self.middle) / self.spread, -8, 8)

    def logits(self, x):
        w = self.weights
        return (np.maximum(self._scaled(x) @ w[0] + w[1], 0) @ w[2] + w[3])[:, 0]

    def score(self, x):
        return _sigmoid(self.logits(x) / self.temperature)


class Constant:
    def __init__(self, share: float):
        self.share = share

    def score(self, x):
        return np.full(len(x), self.share)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _loss(z, y):
    return float(np.mean(np.logaddexp(0, np.where(y > 0, -z, z))))


def held_out(doc_id):
    """True where the checksum of the id's text falls into the fold kept for tests."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def training_rows(pooled_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Id, vector and label of about ``SAMPLE`` labelled documents at most, none of the held-out fold.

    Rows of one id draw their lots by their vectors, and equal ones count once. So an id or a
    group of copies with a large part of all rows brings its share or one row, never all.
    """
    marks = labels.where(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.groupBy(F.col("doc_id").alias("_q_id")).agg((F.avg("quality") >= 0.5).cast("int").alias("_q_y"))
    known = pooled_docs.join(marks, F.col(id_col) == F.col("_q_id")).select("_q_id", "_q_vector", "_q_y")
    lot = F.pmod(F.xxhash64("_q_id", "_q_vector"), F.lit(1 << 20))
    n = known.count()
    if n > SAMPLE:  # by hash on the executors; the driver gets about as many as it may
        known = known.where(lot < int((1 << 20) * SAMPLE / n))
    return known.distinct()


def fit(pooled_docs: DataFrame, labels: DataFrame, id_col: str = "doc_id"):
    """A model from the training rows, cut to ``SAMPLE``."""
    found = training_rows(pooled_docs, labels, id_col).collect()
    rows = sorted(found, key=lambda r: (r["_q_id"], r["_q_vector"]))[:SAMPLE]
    y = np.array([r["_q_y"] for r in rows], float)
    if len(rows) < 10 or y.min() == y.max():
        return Constant((y.sum() + 1) / (len(y) + 2))
    return Network(np.stack([np.frombuffer(r["_q_vector"], np.float32) for r in rows]).astype(float), y)


def _check_names(docs: DataFrame) -> None:
    if bad := [c for c in docs.columns if c.lower().startswith("_q_")]:
        raise ValueError(f"reserved column names: {bad}")


def scored(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """The columns in ``keep`` with ``_q_score``; needs doc_id and text."""
    _check_names(docs)
    stored = pooled(docs, keep, word_vectors(docs))
    model = fit(stored, labels)

    @F.pandas_udf("double")
    def score(vectors):
        import pandas as pd

        return pd.Series(model.score(np.stack([np.frombuffer(v, np.float32) for v in vectors]).astype(float)))

    return stored.withColumn("_q_score", score("_q_vector")).drop("_q_vector")


def _scores(docs: DataFrame, model, vectors: np.ndarray):
    """The score of a row's text as a column: only texts go to a Python worker, and only numbers come back."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        found = [model.score(pool(d, o, shared.value).astype(float)) for _, d, o in chunks(texts, TEXT_CHUNK)]
        return pa.array(np.concatenate([np.zeros(0), *found]))

    return score(_text())


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected.

    Only ids and vectors are stored to learn from, for as long as it takes; whole documents pass once more and
    are scored on their way."""
    _check_names(docs)
    vectors = word_vectors(docs)
    with scratch(docs.sparkSession):
        model = fit(pooled(docs, ["doc_id"], vectors), labels)
    found = docs.withColumn("_q_score", _scores(docs, model, vectors))
    return found.where(F.col("_q_score") >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs.select("doc_id", "text"), labels, ["doc_id"])
    return found.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_q_score").alias("score"),
        (F.col("_q_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
