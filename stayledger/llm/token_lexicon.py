r"""BPE encoding through a minimal acyclic transducer of frequent words.

Words are counted over all texts. Those of the highest counts (at most ``LEXICON_WORDS``) are
merged once and compiled into a minimal acyclic automaton: words share prefixes and suffixes,
each transition carries the number of words that it passes by, and the sum along a word's path
is the word's place in a table of token ids. The arrays of the automaton, the ids and the merge
table form one file in the shared folder. Spark hands it to each executor
(``SparkContext.addFile``), where all Python workers map the same file into memory. Words outside the
automaton are merged exactly, many at a time; which words are inside never changes a result.

Texts are cut as the tokenizer's file says. Texts of characters below U+0370 are normalised
and cut here, others by the library's own normaliser and cutter, whose tables of letters this
module does not repeat.

Defined cases: a null or empty text, and one of white space alone, has no tokens and decodes to
the empty text; the strings of special tokens in a text are these tokens; a word of any length
is merged whole; ids of documents are carried as they are, null and repeated ones too; an empty
table gives no rows; further columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import json
import unicodedata
import uuid
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.session import materialize, work_folder

LEXICON_WORDS = 1 << 17
#: Longer words are left out of the automaton and merged with a heap, one by one.
LONG_WORD = 48
#: Bytes of text whose words stand in memory together, but for one longer text.
CHUNK = 1 << 20
#: Words whose tokens a task keeps from one run of texts to the next.
KEPT_WORDS = 1 << 18
WORD_END = "</w>"
NO_RANK = np.int64(1 << 40)

_FAR = regex.compile(r"[^\x00-\u036f]")
_CUT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\x09-\x0d\x20\x85\xa0\p{L}\p{N}]+")


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + rest.index(b)) for b in range(256)]


# --- The automaton -------------------------------------------------------------------------


def minimal_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Arrays of the minimal automaton of distinct words in byte order.

    ``keys`` are state * 256 + byte in order, ``targets`` and ``passed`` belong to them;
    ``final`` is by state. The last state is the start."""
    known: dict[tuple, int] = {}
    edges: list[tuple] = []
    sizes: list[int] = []
    path: list[list] = [[False, []]]  # nodes of the last word, which may still get edges

    def settle(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in known:
            known[key] = len(edges)
            edges.append(key)
            sizes.append(node[0] + sum(sizes[t] for _, t in node[1]))
        return known[key]

    last = b""
    for word in [*words, None]:
        common = 0
        if word is not None:
            while common < min(len(last), len(word)) and last[common] == word[common]:
                common += 1
        for depth in range(len(path) - 1, common, -1):
            path[depth - 1][1].append((last[depth - 1], settle(path.pop())))
        if word is not None:
            path += [[False, []] for _ in word[common:]]
            path[-1][0] = True
            last = word
    settle(path[0])
    keys, targets, passed = [], [], []
    for state, (final, out) in enumerate(edges):
        before = int(final)
        for byte, target in out:
            keys.append(state * 256 + byte)
            targets.append(target)
            passed.append(before)
            before += sizes[target]
    arrays = {"keys": keys, "targets": targets, "passed": passed, "final": [int(f) for f, _ in edges]}
    return {name: np.array(a, np.int64) for name, a in arrays.items()}


def places(automaton: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The place of each word among the automaton's words, -1 for words that it does not have.

    All words take their steps together."""
    keys, n = automaton["keys"], len(offsets) - 1
    state = np.full(n, len(automaton["final"]) - 1, np.int64)
    place, sizes = np.zeros(n, np.int64), np.diff(offsets)
    on = np.flatnonzero(sizes > 0)
    place[sizes == 0] = -1
    step = 0
    while len(on):
        wanted = state[on] * 256 + data[offsets[on] + step]
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        found = keys[at] == wanted if len(keys) else np.zeros(len(on), bool)
        place[on[~found]] = -1
        on, at = on[found], at[found]
        state[on] = automaton["targets"][at]
        place[on] += automaton["passed"][at]
        step += 1
        ends = sizes[on] == step
        place[on[ends & (automaton["final"][state[on]] == 0)]] = -1
        on = on[~ends]
    return place


# --- Merges --------------------------------------------------------------------------------


class Merges:
    """Merges pairs of tokens in the order of their ranks, the leftmost of equal ones first."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.keys, self.ranks, self.made = arrays["pair_keys"], arrays["pair_ranks"], arrays["pair_made"]
        self.inner, self.last = arrays["byte_ids"], arrays["last_byte_ids"]

    def look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank * 2**20 + new token of pairs, or at least ``NO_RANK`` * 2**20; padding is -1."""
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = (self.keys[at] == wanted) & (left >= 0) & (right >= 0)
        return np.where(found, (self.ranks[at] << 20) | self.made[at], NO_RANK << 20)

    def short(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, lengths) of words of at most ``LONG_WORD`` bytes, merged side by side."""
        sizes = np.diff(offsets)
        out = [None] * len(sizes)
        order = np.argsort(sizes, kind="stable")
        for size in np.unique(sizes[sizes > 0]):
            rows = order[np.searchsorted(sizes[order], size) : np.searchsorted(sizes[order], size, "right")]
            raw = data[offsets[rows][:, None] + np.arange(size)]
            tokens = self.inner[raw]
            tokens[:, -1] = self.last[raw[:, -1]]
            for row, merged in zip(rows, self._together(tokens)):
                out[row] = merged
        out = [np.zeros(0, np.int64) if x is None else x for x in out]
        return np.concatenate([np.zeros(0, np.int64), *out]), np.array([len(x) for x in out], np.int64)

    def _together(self, tokens: np.ndarray) -> list[np.ndarray]:
        n, width = tokens.shape
        result = np.full((n, width), -1, np.int64)
        rows = np.arange(n)
        pairs = np.full((n, width), NO_RANK << 20, np.int64)
        pairs[:, :-1] = self.look(tokens[:, :-1], tokens[:, 1:])
        while len(rows):
            at = np.argmin(pairs, axis=1)
            best = pairs[np.arange(len(rows)), at]
            done = best >= NO_RANK << 20
            if done.any():
                result[rows[done], : tokens.shape[1]] = tokens[done]
                rows, tokens, pairs, at, best = (x[~done] for x in (rows, tokens, pairs, at, best))
                if not len(rows):
                    break
            every = np.arange(len(rows))
            tokens[every, at] = best & ((1 << 20) - 1)
            width = tokens.shape[1]
            kept = np.arange(width - 1) + (np.arange(width - 1) > at[:, None])
            tokens = np.take_along_axis(tokens, kept, axis=1)
            pairs = np.take_along_axis(pairs, kept, axis=1)
            after = np.minimum(at + 1, width - 2)
            right = np.where(at + 1 < width - 1, tokens[every, after], -1)
            pairs[every, at] = self.look(tokens[every, at], right)
            before = np.maximum(at - 1, 0)
            has = at > 0
            new = self.look(tokens[every, before], tokens[every, at])
            pairs[every[has], before[has]] = new[has]
        return [row[row >= 0] for row in result]

    @cached_property
    def by_pair(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), ((self.ranks << 20) | self.made).tolist()))

    def long(self, word: bytes) -> np.ndarray:
        """Tokens of one word of any length, with a heap of the pairs that may be merged."""
        raw = np.frombuffer(word, np.uint8)
        tokens = self.inner[raw]
        tokens[-1] = self.last[raw[-1]]
        n = len(tokens)
        values, after, before = tokens.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        limit = int(NO_RANK << 20)
        table = self.by_pair

        def pair(k: int) -> int:
            return table.get((values[k] << 32) | values[after[k]], limit) if after[k] < n else limit

        heap = [(p, k) for k in range(n) if (p := pair(k)) < limit]
        heapq.heapify(heap)
        while heap:
            p, k = heapq.heappop(heap)
            if values[k] < 0 or pair(k) != p:
                continue
            gone = after[k]
            values[k], values[gone] = p & ((1 << 20) - 1), -1
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            for place in (before[k], k):
                if place >= 0 and (q := pair(place)) < limit:
                    heapq.heappush(heap, (q, place))
        return np.array([v for v in values if v >= 0], np.int64)


def merge_table(model: dict) -> dict[str, np.ndarray]:
    """The tokenizer's merges as arrays in order of the pair, and the tokens of single bytes."""
    vocabulary = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
    right = np.array([vocabulary[b] for _, b in pairs], np.int64)
    made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
    keys = (left << 32) | right
    order = np.argsort(keys, kind="stable")
    shown = byte_characters()
    return {
        "pair_keys": keys[order],
        "pair_ranks": order.astype(np.int64),
        "pair_made": made[order],
        "byte_ids": np.array([vocabulary[c] for c in shown], np.int64),
        "last_byte_ids": np.array([vocabulary[c + WORD_END] for c in shown], np.int64),
    }


# --- Cutting texts -------------------------------------------------------------------------


class Cutter:
    """Words (as bytes) and special tokens (as their ids) of a text."""

    def __init__(self, rules: str):
        said = json.loads(rules)
        self.special = {t["content"]: t["id"] for t in said["added_tokens"]}
        self.marks = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        self.rules, self._library = rules, None
        self.bytes_of = {ord(c): b for b, c in enumerate(byte_characters())}

    def words(self, text: str) -> list:
        if "<|" not in text:
            return self._cut(text)
        found, start = [], 0
        for mark in self.marks.finditer(text):
            found += self._cut(text[start : mark.start()])
            found.append(self.special[mark.group()])
            start = mark.end()
        return found + self._cut(text[start:])

    def _cut(self, text: str) -> list[str | bytes]:
        if _FAR.search(text) is None:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            return _CUT.findall(text.lower())
        return self._by_library(text)

    def _by_library(self, text: str) -> list[bytes]:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.rules)
        plain = self._library.normalizer.normalize_str(text)
        pieces = self._library.pre_tokenizer.pre_tokenize_str(plain)
        return [w.translate(self.bytes_of).encode("latin-1") for w, _ in pieces]


def cutting_rules(tokenizer: dict) -> str:
    """The tokenizer's file without its vocabulary."""
    model = tokenizer["model"] | {"vocab": {}, "merges": []}
    return json.dumps(tokenizer | {"model": model})


# --- The lexicon file ----------------------------------------------------------------------


class Lexicon:
    """What a task needs: the mapped arrays, the rules for cutting and the names of tokens."""

    def __init__(self, arrays: dict[str, np.ndarray], rules: str):
        self.arrays = arrays
        self.merges, self.cutter = Merges(arrays), Cutter(rules)
        ends = arrays["name_ends"].tolist()
        names = arrays["names"].astype(np.uint8).tobytes()
        self.names = [names[a:b] for a, b in zip([0, *ends], ends)]
        self._forget()

    def tokens(self, words: list) -> tuple[np.ndarray, np.ndarray]:
        """(tokens one after the other, lengths) of distinct words and special tokens."""
        raw = [b"" if isinstance(w, int) else w.encode() if isinstance(w, str) else w for w in words]
        sizes = np.array([len(w) for w in raw], np.int64)
        offsets = np.append(0, np.cumsum(sizes))
        data = np.frombuffer(b"".join(raw), np.uint8)
        place = places(self.arrays, data, offsets)
        lengths, parts = np.zeros(len(words), np.int64), {}
        known = np.flatnonzero(place >= 0)
        starts = self.arrays["id_starts"]
        lengths[known] = starts[place[known] + 1] - starts[place[known]]
        unseen = np.flatnonzero((place < 0) & (sizes > 0) & (sizes <= LONG_WORD))
        picked = np.concatenate([np.zeros(0, np.int64), *[np.arange(offsets[k], offsets[k + 1]) for k in unseen]])
        merged, lengths[unseen] = self.merges.short(data[picked], np.append(0, np.cumsum(sizes[unseen])))
        for k in np.flatnonzero(sizes > LONG_WORD):
            if place[k] < 0:
                parts[k] = self.merges.long(raw[k])
        for k, word in enumerate(words):
            if isinstance(word, int):
                parts[k] = np.array([word], np.int64)
        for k, tokens in parts.items():
            lengths[k] = len(tokens)
        ends = np.cumsum(lengths)
        out = np.zeros(ends[-1] if len(ends) else 0, np.int64)
        out[spans(ends[known] - lengths[known], lengths[known])] = self.arrays["ids"][
            spans(starts[place[known]], lengths[known])
        ]
        out[spans(ends[unseen] - lengths[unseen], lengths[unseen])] = merged
        for k, tokens in parts.items():
            out[ends[k] - len(tokens) : ends[k]] = tokens
        return out, lengths

    def learn(self, words: set) -> None:
        """Keeps the tokens of new words; ``KEPT_WORDS`` at most besides those of the texts at hand."""
        new = list(words - self.seen.keys())
        if len(self.seen) + len(new) > KEPT_WORDS:
            self._forget()
            new = list(words)
        tokens, lengths = self.tokens(new)
        ends = np.cumsum(lengths)
        names = [self.names[t] for t in tokens.tolist()]
        self.pieces += [b" ".join(names[a:b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
        self.seen.update(zip(new, range(len(self.seen), len(self.seen) + len(new))))
        self.starts = np.append(self.starts, ends - lengths + len(self.flat))
        self.lengths = np.append(self.lengths, lengths)
        self.flat = np.append(self.flat, tokens)

    def _forget(self) -> None:
        self.seen, self.pieces = {}, []
        self.flat = self.starts = self.lengths = np.zeros(0, np.int64)

    def encoded(self, texts: list[str]) -> Iterator[tuple[np.ndarray, bytes]]:
        """(token ids, decoded text) of each text."""
        cut = [self.cutter.words(t) for t in texts]
        self.learn(set().union(*cut))
        for own in cut:
            at = np.fromiter(map(self.seen.__getitem__, own), np.int64, len(own))
            decoded = b" ".join(map(self.pieces.__getitem__, at.tolist()))
            yield self.flat[spans(self.starts[at], self.lengths[at])], decoded


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of several runs, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def compiled(words: list[bytes], tokenizer: dict) -> dict[str, np.ndarray]:
    """The arrays of a lexicon of distinct words."""
    words = sorted(words)
    arrays = merge_table(tokenizer["model"])
    data = np.frombuffer(b"".join(words), np.uint8)
    offsets = np.append(0, np.cumsum([len(w) for w in words])).astype(np.int64)
    ids, lengths = Merges(arrays).short(data, offsets)
    names = token_names(tokenizer)
    return {
        **arrays,
        **minimal_automaton(words),
        "ids": ids,
        "id_starts": np.append(0, np.cumsum(lengths)),
        "names": np.frombuffer(b"".join(names), np.uint8),
        "name_ends": np.cumsum([len(x) for x in names]),
    }


def token_names(tokenizer: dict) -> list[bytes]:
    found = tokenizer["model"]["vocab"] | {t["content"]: t["id"] for t in tokenizer["added_tokens"]}
    names = [b""] * (max(found.values()) + 1)
    for name, k in found.items():
        names[k] = name.encode()
    return names


def _shared_file(spark: SparkSession, arrays: dict[str, np.ndarray]) -> tuple[str, dict[str, tuple[int, int]]]:
    """Writes the arrays to the shared folder, hands the file to all executors; its name and the arrays' places."""
    held, where, total = [], {}, 0
    for key, array in arrays.items():
        where[key] = (total, total + len(array))
        held.append(array.astype(np.int64))
        total += len(array)
    body = io.BytesIO()
    np.save(body, np.concatenate(held))
    name = f"lexicon-{uuid.uuid4().hex}.npy"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_folder(spark)}/{name}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        stream.write(bytearray(body.getvalue()))
    finally:
        stream.close()
    spark.sparkContext.addFile(f"{work_folder(spark)}/{name}")
    return name, where


class LexiconFile:
    """Opens the lexicon within a task, once; only the file's name and the rules travel with the task."""

    def __init__(self, name: str, where: dict[str, tuple[int, int]], rules: str):
        self.name, self.where, self.rules, self._open = name, where, rules, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_open": None}

    def __call__(self) -> Lexicon:
        if self._open is None:
            mapped = np.load(SparkFiles.get(self.name), mmap_mode="r")
            self._open = Lexicon({key: mapped[a:b] for key, (a, b) in self.where.items()}, self.rules)
        return self._open


# --- On Spark ------------------------------------------------------------------------------


def _runs(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of about ``CHUNK`` characters."""
    first, held = 0, 0
    for k, text in enumerate(texts):
        held += len(text or "")
        if held >= CHUNK or k == len(texts) - 1:
            yield first, [t or "" for t in texts[first : k + 1]]
            first, held = k + 1, 0


def _batched(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """Runs of the texts of a batch; at most a few hundred texts stand as Python strings."""
    texts = batch.column(column)
    for first in range(0, len(texts), 256):
        for start, run in _runs(texts.slice(first, 256).to_pylist()):
            yield first + start, run


def word_counts(docs: DataFrame, rules: str, text_col: str = "text") -> DataFrame:
    """(word as bytes, n) of all texts but for words over ``LONG_WORD`` bytes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, found = Cutter(rules), Counter()

        def flushed() -> pa.RecordBatch:
            raw = Counter()
            for word, n in found.items():
                if not isinstance(word, int):
                    raw[word.encode() if isinstance(word, str) else word] += n
            keep = [(w, n) for w, n in raw.items() if 0 < len(w) <= LONG_WORD]
            found.clear()
            columns = [pa.array([w for w, _ in keep], pa.binary()), pa.array([n for _, n in keep], pa.int64())]
            return pa.record_batch(columns, names=["word", "n"])

        for batch in batches:
            for _, run in _batched(batch, text_col):
                for text in run:
                    found.update(cutter.words(text))
                if len(found) > 1 << 18:
                    yield flushed()
        yield flushed()

    return (
        docs.select(text_col)
        .mapInArrow(count, "word binary, n long")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def frequent_words(counts: DataFrame, limit: int) -> list[bytes]:
    """The words whose count reaches the least power of two that leaves at most ``limit`` words."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["m"] for r in counts.groupBy(power.alias("p")).agg(F.count("*").alias("m")).collect()}
    floor, held = 64, 0
    for p in sorted(sizes, reverse=True):
        if held + sizes[p] > limit:
            break
        floor, held = p, held + sizes[p]
    return [bytes(r["word"]) for r in counts.where(power >= floor).select("word").collect()]


def build_lexicon(docs: DataFrame, tokenizer_file: str, limit: int = LEXICON_WORDS, text_col: str = "text") -> LexiconFile:
    """Compiles the frequent words of all texts into a file that tasks open."""
    with open(tokenizer_file, encoding="utf-8") as file:
        tokenizer = json.load(file)
    rules = cutting_rules(tokenizer)
    counts = materialize(word_counts(docs, rules, text_col), "word_counts")
    arrays = compiled(frequent_words(counts, limit), tokenizer)
    return LexiconFile(*_shared_file(docs.sparkSession, arrays), rules)


def encode(docs: DataFrame, lexicon: LexiconFile, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded): the token ids of each text and the text that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batched(batch, "text"):
                found = list(lexicon().encoded(texts))
                yield pa.record_batch(
                    [
                        batch.column("id").slice(first, len(texts)),
                        pa.array([ids.astype(np.int32) for ids, _ in found], pa.list_(pa.int32())),
                        pa.array([decoded.decode() for _, decoded in found], pa.string()),
                    ],
                    names=["id", "ids", "decoded"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, ids array<int>, decoded string").withColumnRenamed("id", id_col)


def encoding_digest(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Per document the number of tokens and the hashes of its ids and of the decoded text."""
    lexicon = build_lexicon(docs, tokenizer_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _batched(batch, "text"):
                counts, hashes, decoded_hashes = [], [], []
                for ids, decoded in lexicon().encoded(texts):
                    counts.append(len(ids))
                    hashes.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    decoded_hashes.append(hashlib.sha256(decoded).hexdigest())
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(first, len(texts)),
                        pa.array(counts, pa.int64()),
                        pa.array(hashes, pa.string()),
                        pa.array(decoded_hashes, pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
