r"""Prefix trie of conversations in balanced parentheses.

Each conversation becomes a sequence of turn codes (128 bits of role and text). Sequences are
put in order over the whole cluster by ranges, so that a slice holds neighbours in the trie.
A task writes the trie of its slice as balanced parentheses with the running excess in blocks
and a tree of block minima. The matching parenthesis (``find_close``) delimits a subtree; counts
of leaf pairs and cumulative sums of members and savings between a node's two parentheses
give the node's figures.

Only nodes on the paths to a slice's first and last sequence (its spines) can stand in several slices.
Their parts are merged by key, and what hangs below them is added up along the merged spines.
Everything else is finished within its slice. A sequence that many conversations share is
spread over several slices, as conversations are the last part of the order.

No task holds a conversation of any length as a whole: its turns are numbered across
slices and it travels in segments of ``DEPTH`` turns. The trie of the segments from a depth on is
built first, and its totals hang on the ends of the segments above.

Defined cases: turns of one number (null first) are ordered by their code, whatever the order of
rows, and repeated turns stay; null role or text is empty; rows without a conversation's id
belong to no conversation and are left out; a conversation without turns after rebuilding
ends at the root; an empty table has no nodes, not even a root; further columns do not matter.
Turns and prefixes are told apart by 120 to 128 bits of MD5.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.units import pack
from stayledger.session import materialize

#: Turns of a segment.
DEPTH = 256
#: Turns of a slice of the trie, about.
SLICE = 1 << 18
CODE = 16
BLOCK = 64
IDS = 512
EMPTY = hashlib.sha256(b"").hexdigest()
WORD = r"[^\x20\x09-\x0D]+"
INDEX_BITS = 33  # Spark documents: the lower 33 bits of the id count rows within a partition.

FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
#: done: a finished node; hung: finished but for its parent, which is on a spine; spine: a part
#: of a spine's node; ids: conversations that end where the slice begins or ends.
BUILT = (
    "kind string, slice long, band long, local long, key string, parent_key string, path array<string>, root string, "
    "next_root string, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, words long, ends_sha256 string, ids binary"
)


# --- Balanced parentheses ------------------------------------------------------------------


class Parentheses:
    """+1 for an opening, -1 for a closing parenthesis, with minima of the excess by block."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        self.opens = np.flatnonzero(steps > 0)
        self.excess = np.cumsum(steps, dtype=np.int64)
        width = -(-max(len(steps), 1) // BLOCK)
        high = np.int64(1 << 40)
        self.blocks = np.full(width * BLOCK, high)
        self.blocks[: len(steps)] = self.excess
        self.blocks = self.blocks.reshape(width, BLOCK)
        self.levels = [self.blocks.min(axis=1)]
        while len(self.levels[-1]) > 1:
            below = self.levels[-1]
            if len(below) % 2:
                below = self.levels[-1] = np.append(below, high)
            self.levels.append(below.reshape(-1, 2).min(axis=1))

    def find_close(self, opens: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one."""
        target = self.excess[opens] - 1
        found = np.full(len(opens), -1, np.int64)
        for a in range(0, len(opens), 1 << 14):
            some = slice(a, a + (1 << 14))
            block, place = opens[some] // BLOCK, opens[some] % BLOCK
            fits = (self.blocks[block] <= target[some, None]) & (np.arange(BLOCK) > place[:, None])
            at = fits.argmax(axis=1)
            found[some] = np.where(fits[np.arange(len(at)), at], block * BLOCK + at, -1)
        far = np.flatnonzero(found < 0)
        block = self._next_block(opens[far] // BLOCK, target[far])
        for a in range(0, len(far), 1 << 14):
            some = slice(a, a + (1 << 14))
            at = (self.blocks[block[some]] <= target[far[some], None]).argmax(axis=1)
            found[far[some]] = block[some] * BLOCK + at
        return found

    def _next_block(self, block: np.ndarray, target: np.ndarray) -> np.ndarray:
        """The next block that goes down to the target: up the tree of minima, then down."""
        at, level_of = block.copy(), np.full(len(block), -1, np.int64)
        climbing = np.arange(len(block))
        for level, least in enumerate(self.levels):
            own = at[climbing]
            beside = np.minimum(own + 1, len(least) - 1)
            hit = (own % 2 == 0) & (own + 1 < len(least)) & (least[beside] <= target[climbing])
            at[climbing[hit]] += 1
            level_of[climbing[hit]] = level
            climbing = climbing[~hit]
            at[climbing] //= 2
        for level in range(len(self.levels) - 1, 0, -1):
            down = np.flatnonzero(level_of == level)
            left = at[down] * 2
            at[down] = left + (self.levels[level - 1][left] > target[down])
            level_of[down] = level - 1
        return at

    def between(self, values: np.ndarray, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Sums of values, given by opening parenthesis, from each opening one to its closing one."""
        spread = np.zeros(len(self.steps) + 1, np.int64)
        spread[self.opens + 1] = values
        total = np.cumsum(spread)
        return total[closes + 1] - total[opens]


# --- The trie of a slice -------------------------------------------------------------------


def _key(band: int, root: str, codes: bytes) -> str:
    return hashlib.md5(f"{band}:{root}:".encode() + codes).hexdigest()


def _next_root(band: int, root: str, codes: bytes) -> str:
    """As ``_with_roots`` says it in Spark: three sums of 40 bits of the segments' hashes."""
    digest = hashlib.md5(f"{band}:{codes.hex().upper()}".encode()).hexdigest()
    lanes = [int(digest[k : k + 10], 16) for k in (0, 10, 20)]
    before = [int(x) for x in root.split(":")] if root else [0, 0, 0]
    return ":".join(str(a + b) for a, b in zip(lanes, before))


class SliceTrie:
    """The trie of the segments of one slice, which come in order."""

    def __init__(self, rows: dict[str, list]):
        self.rows = rows
        same = [rows["band"], rows["root"], rows["codes"]]
        n = len(rows["codes"])
        self.heads = [k for k in range(n) if not k or any(c[k] != c[k - 1] for c in same)]
        self.sizes = np.diff(np.append(self.heads, n))
        self._place()

    def _place(self) -> None:
        """Nodes in preorder: depth, parent, sequence, words; and the parentheses."""
        band, root, codes, words = (self.rows[c] for c in ("band", "root", "codes", "words"))
        depth, parent, sequence, amount, runs = [], [], [], [], []
        path: list[int] = []
        last = None
        for s, k in enumerate(self.heads):
            own = codes[k]
            length, common = len(own) // CODE, -1
            if last is not None and (band[k], root[k]) == (band[last], root[last]):
                before, common = codes[last], 0
                limit = min(length, len(before) // CODE)
                while common < limit and before[CODE * common : CODE * common + CODE] == own[CODE * common : CODE * common + CODE]:
                    common += 1
            runs += [len(path) - 1 - common, length - common]
            del path[common + 1 :]
            for d in range(common + 1, length + 1):
                parent.append(path[-1] if path else -1)
                path.append(len(depth))
                depth.append(d)
                sequence.append(s)
                amount.append(words[k][d - 1] if d else self.rows["root_words"][k] or 0)
            last = k
        runs.append(len(path))
        kinds = np.tile(np.array([-1, 1], np.int8), len(runs))[: len(runs)]
        self.trie = Parentheses(np.repeat(kinds, runs))
        self.depth, self.parent = np.array(depth, np.int64), np.array(parent, np.int64)
        self.sequence, self.words = np.array(sequence, np.int64), np.array(amount, np.int64)
        lengths = np.array([len(codes[k]) // CODE for k in self.heads], np.int64)
        self.ends = np.flatnonzero(self.depth == lengths[self.sequence])  # the last node of each sequence
        self.first_spine, self.last_spine = np.arange(lengths[0] + 1), np.array(path, np.int64)

    def figures(self) -> None:
        trie, n = self.trie, len(self.depth)
        opens, closes = trie.opens, trie.find_close(trie.opens)
        self.spine = np.zeros(n, bool)
        self.spine[self.first_spine] = self.spine[self.last_spine] = True
        carrier = self.depth == DEPTH
        own = np.zeros(n, np.int64)
        own[self.ends] = self.sizes
        self.members = trie.between(own, opens, closes)
        leaf = (closes == opens + 1) & ~carrier & ~self.spine
        value = np.where(carrier | self.spine, 0, (self.members - 1) * self.words)
        more = [np.add.reduceat(np.array(self.rows[c], np.int64), self.heads) for c in ("x_leaves", "x_saved")]
        leaf = leaf.astype(np.int64)
        leaf[self.ends] += more[0]
        value[self.ends] += more[1]
        self.leaves = trie.between(leaf, opens, closes)
        self.saved = trie.between(value, opens, closes)
        inner = self.parent >= 0
        self.children = np.bincount(self.parent[inner & ~self.spine], minlength=n)
        least = np.full(n, np.iinfo(np.int64).max)
        conv = np.array(self.rows["conv"], np.int64)
        least[self.ends] = conv[self.heads]
        by_depth = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[by_depth])) + 1
        for level in np.split(by_depth, cuts):  # at most DEPTH + 1 levels
            level = level[self.parent[level] >= 0]
            np.minimum.at(least, self.parent[level], least[level])
        self.least = least
        # what hangs on a spine's node itself: all below it less what its children on the spine have
        self.own_leaves, self.own_saved = self.leaves.copy(), self.saved.copy()
        on = np.flatnonzero(self.spine & inner)
        np.subtract.at(self.own_leaves, self.parent[on], self.leaves[on])
        np.subtract.at(self.own_saved, self.parent[on], self.saved[on])

    def batches(self, number: int) -> Iterator[pa.RecordBatch]:
        self.figures()
        rows, heads = self.rows, self.heads
        edge = {0, len(heads) - 1}
        ends_of = {}
        for s, node in enumerate(self.ends.tolist()):
            if s not in edge and self.depth[node] < DEPTH:
                ids = rows["conv"][heads[s] : heads[s] + int(self.sizes[s])]
                ends_of[node] = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        columns: dict[str, list] = {f.split()[0]: [] for f in BUILT.split(", ")}

        def put(**values) -> None:
            for name, held in columns.items():
                held.append(values.get(name))

        def batch() -> pa.RecordBatch:
            types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string())}
            kinds = [types[f.split()[1]] for f in BUILT.split(", ")]
            made = pa.record_batch([pa.array(c, t) for c, t in zip(columns.values(), kinds)], names=list(columns))
            for held in columns.values():
                held.clear()
            return made

        arrays = (self.depth, self.parent, self.sequence, self.least, self.members, self.words, self.spine)
        least, spine = self.least.tolist(), self.spine.tolist()
        for node, (d, parent, s, conv, members, words, on) in enumerate(zip(*(a.tolist() for a in arrays))):
            k = heads[s]
            band, root, codes = rows["band"][k], rows["root"][k], rows["codes"][k]
            common = {"slice": number, "band": band, "local": d, "conv_id": conv, "n_convs": members, "words": words}
            common["n_children"] = int(self.children[node])
            if d == DEPTH:
                common["next_root"] = _next_root(band, root, codes)
            if d == 0:
                common["root"] = root
            if on:
                path = [_key(band, root, codes[: CODE * j]) for j in range(d + 1)]
                put(
                    kind="spine", key=path[-1], parent_key=path[-2] if d else None, path=path, **common,
                    n_leaves=int(self.own_leaves[node]), saved_tokens=int(self.own_saved[node]),
                    ends_sha256=ends_of.get(node),
                )
            else:
                known = parent < 0 or not spine[parent]
                put(
                    kind="done" if known else "hung",
                    parent_conv_id=least[parent] if parent >= 0 and known else None,
                    parent_key=None if known else _key(band, root, codes[: CODE * (d - 1)]), **common,
                    n_leaves=int(self.leaves[node]), saved_tokens=int(self.saved[node]),
                    ends_sha256=ends_of.get(node, EMPTY),
                )
            if len(columns["kind"]) >= 1 << 14:
                yield batch()
        for s in sorted(edge):
            if self.depth[self.ends[s]] == DEPTH:
                continue
            k, size = heads[s], int(self.sizes[s])
            key = _key(rows["band"][k], rows["root"][k], rows["codes"][k])
            for a in range(k, k + size, IDS):
                ids = np.array(rows["conv"][a : min(a + IDS, k + size)], np.int64)
                put(kind="ids", key=key, conv_id=int(ids[0]), ids=pack(ids))
                if len(columns["kind"]) >= 1 << 10:
                    yield batch()
        yield batch()


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slice's trie; a slice has a bounded number of turns."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    table = pa.Table.from_batches(tables)
    rows = {name: table.column(name).to_pylist() for name in table.column_names}
    yield from SliceTrie(rows).batches(rows["slice"][0])


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each key's ids, which come in order; the state is one hash."""
    key, state = None, None

    def made(key: str, state) -> pa.RecordBatch:
        return pa.record_batch([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends"])

    for batch in batches:
        for own, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            text = ",".join(map(str, np.frombuffer(ids, np.int64).tolist())).encode()
            if own != key:
                if key is not None:
                    yield made(key, state)
                key, state = own, hashlib.sha256(text)
            else:
                state.update(b"," + text)
    if key is not None:
        yield made(key, state)


# --- Merging the slices --------------------------------------------------------------------


def _slices(segments: DataFrame) -> DataFrame:
    turns = segments.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    order = ["band", "root", "codes", "conv"]
    placed = segments.repartitionByRange(max(8, -(-turns // SLICE)), *order).sortWithinPartitions(*order)
    numbered = placed.withColumn("slice", F.spark_partition_id().cast("long"))
    return materialize(numbered.mapInArrow(_build, BUILT), "trie_slices")


def _merged_spines(built: DataFrame) -> DataFrame:
    """Whole figures of the nodes that may stand in several slices."""
    parts = built.where("kind = 'spine'")
    sums = [F.sum(c).alias(c) for c in FIGURES]
    firsts = [F.first(c).alias(c) for c in ("band", "local", "parent_key", "path", "root", "next_root", "words")]
    nodes = parts.groupBy("key").agg(*firsts, F.min("conv_id").alias("conv_id"), *sums, F.max("ends_sha256").alias("ends"))
    nodes = materialize(nodes, "trie_spines")
    children = nodes.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    ids = built.where("kind = 'ids'").select("key", "conv_id", "ids")
    hashed = ids.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_hash_ids, "key string, ends string")
    counted = nodes.join(children, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    carrier = F.col("local") == DEPTH
    own = counted.withColumns(
        {
            "n_leaves": F.col("n_leaves") + ((F.col("n_children") == 0) & ~carrier).cast("long"),
            "saved_tokens": F.col("saved_tokens") + F.when(carrier, 0).otherwise((F.col("n_convs") - 1) * F.col("words")),
        }
    )
    below = (
        own.select(F.explode("path").alias("key"), "n_leaves", "saved_tokens")
        .groupBy("key")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    whole = (
        own.drop("n_leaves", "saved_tokens", "path", "more")
        .join(below, "key")
        .join(parents, "parent_key", "left")
        .join(hashed.withColumnRenamed("ends", "edge_ends"), "key", "left")
        .withColumn("ends_sha256", F.coalesce("edge_ends", "ends", F.lit(EMPTY)))
    )
    return materialize(whole.drop("edge_ends", "ends"), "trie_merged")


NODE = ["band", "local", "root", "next_root", "conv_id", "parent_conv_id", *FIGURES, "ends_sha256"]


def _nodes(segments: DataFrame) -> DataFrame:
    """All nodes of the segments' tries, ends of whole segments (``next_root``) among them."""
    built = _slices(segments)
    spines = _merged_spines(built)
    parents = (
        built.where("kind = 'spine'")
        .select("slice", "key")
        .join(spines.select("key", F.col("conv_id").alias("parent_conv_id")), "key")
        .withColumnRenamed("key", "parent_key")
    )
    hung = built.where("kind = 'hung'").drop("parent_conv_id").join(parents, ["slice", "parent_key"])
    return built.where("kind = 'done'").select(NODE).unionByName(hung.select(NODE)).unionByName(spines.select(NODE))


def _with_roots(segments: DataFrame) -> DataFrame:
    """Each segment's trie: the hash of the turns before it, and the words of the last of them."""
    digest = F.md5(F.concat(F.col("band").cast("string"), F.lit(":"), F.hex("codes")).cast("binary"))
    so_far = Window.partitionBy("conv").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    lanes = [
        F.sum(F.conv(F.substring(digest, k + 1, 10), 16, 10).cast("long")).over(so_far).cast("string") for k in (0, 10, 20)
    ]
    before = F.lag(F.try_element_at("words", F.lit(-1))).over(Window.partitionBy("conv").orderBy("band"))
    return segments.select(
        "*",
        F.when(F.col("band") > 0, F.concat_ws(":", *lanes)).otherwise("").alias("root"),
        F.coalesce(before, F.lit(0)).alias("root_words"),
    )


def prefix_trie(segments: DataFrame) -> DataFrame:
    """The nodes of all prefixes of the conversations.

    ``segments``: (conv, band, codes, words, whole) as ``segments_of`` makes them. Result:
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    none = {"x_leaves": F.lit(0).cast("long"), "x_saved": F.lit(0).cast("long")}
    flat = segments.where("whole").select("conv", "band", "codes", "words", F.lit("").alias("root"), F.lit(0).cast("long").alias("root_words"))
    deep = segments.where("NOT whole")
    if deep.isEmpty():
        found = _nodes(flat.withColumns(none))
        above = None
    else:
        rooted = materialize(_with_roots(deep.drop("whole")), "trie_segments")
        roots = _nodes(rooted.where("band > 0").withColumns(none)).where("local = 0")
        totals = roots.select(F.col("conv_id").alias("conv"), "band", F.col("n_leaves").alias("l"), F.col("saved_tokens").alias("s"))
        later = Window.partitionBy("conv").orderBy(F.desc("band")).rowsBetween(Window.unboundedPreceding, -1)
        extra = {c: F.coalesce(F.sum(v).over(later), F.lit(0)) for c, v in (("x_leaves", "l"), ("x_saved", "s"))}
        carried = rooted.join(totals, ["conv", "band"], "left").withColumns(extra).drop("l", "s")
        found = materialize(_nodes(flat.withColumns(none).unionByName(carried)), "trie_nodes")
        above = found.where("next_root IS NOT NULL").select(F.col("next_root").alias("root"), F.col("parent_conv_id").alias("above"))
    depth = (F.col("band") * DEPTH + F.col("local")).alias("depth")
    told = found.where("next_root IS NULL")
    if above is None:
        return told.select("conv_id", depth, "parent_conv_id", *FIGURES, "ends_sha256")
    parent = F.coalesce("parent_conv_id", "above").alias("parent_conv_id")
    return told.join(above, "root", "left").select("conv_id", depth, parent, *FIGURES, "ends_sha256")


# --- Conversations -------------------------------------------------------------------------


def placed_turns(conversations: DataFrame) -> DataFrame:
    """(conv, turn, code, words, slice, at): turns in order over ranges, numbered within their slice."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(whole.cast("binary")).alias("code"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("conv").asc(), F.col("turn").asc_nulls_first(), F.col("code").asc()]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    written = materialize(ranged.withColumn("id", F.monotonically_increasing_id()), "placed_turns")
    return written.select(
        "conv",
        "turn",
        "code",
        "words",
        F.shiftright("id", INDEX_BITS).alias("slice"),
        F.col("id").bitwiseAND(F.lit((1 << INDEX_BITS) - 1)).alias("at"),
    )


def rebuilt_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv, depth, code, words), (conv, length)) after the first turns were taken from another conversation.

    Of conversation c the first h = crc32(c) % 4 turns give way to those of c - c % 20. No group
    here is larger than a slice: a long conversation has one row per slice that it stands in."""
    pieces = turns.groupBy("slice", "conv").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    in_order = Window.partitionBy("conv").orderBy("slice")
    pieces = pieces.withColumns(
        {
            "before": F.sum("n").over(in_order) - F.col("n"),
            "total": F.sum("n").over(Window.partitionBy("conv")),
            "h": F.crc32(F.col("conv").cast("string").cast("binary")) % 4,
            "base": F.col("conv") - F.col("conv") % 20,
        }
    )
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "code"))
    first_turns = turns.where(F.col("conv") % 20 == 0).withColumn("rank", rank).where("rank <= 3")
    gifts = first_turns.groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "code", "words"))).alias("gift")
    )
    none = F.array().cast("array<struct<rank:int,code:string,words:bigint>>")
    given = F.when(F.col("h") > 0, F.slice(F.coalesce("gift", none), 1, F.col("h").cast("int"))).otherwise(none)
    joined = pieces.join(gifts, "base", "left").withColumn("gift", given)
    heads = materialize(
        joined.select("slice", "conv", "first", "before", "total", "gift", F.least("h", "total").alias("gone")), "trie_heads"
    )
    starts = heads.where("before = 0")
    kept = turns.join(heads.select("slice", "conv", "first", "before", "gone", F.size("gift").alias("got")), ["slice", "conv"])
    kept = kept.withColumn("position", F.col("at") - F.col("first") + F.col("before") + 1).where("position > gone")
    own = kept.select("conv", (F.col("position") - F.col("gone") + F.col("got")).alias("depth"), "code", "words")
    taken = starts.select("conv", F.explode("gift").alias("g")).select(
        "conv", F.col("g.rank").cast("long").alias("depth"), "g.code", "g.words"
    )
    length = (F.col("total") - F.col("gone") + F.size("gift")).alias("length")
    return own.unionByName(taken), starts.select("conv", length)


def segments_of(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv, band, codes, words, whole): runs of ``DEPTH`` turns; a conversation's last run may be empty."""
    numbered = turns.select(
        "conv", F.floor((F.col("depth") - 1) / DEPTH).alias("band"), F.struct("depth", "code", "words").alias("turn"), F.lit(0).alias("last")
    )
    ends = lengths.select(
        "conv", F.floor(F.col("length") / DEPTH).alias("band"), F.lit(None).cast(numbered.schema["turn"].dataType).alias("turn"), F.lit(1).alias("last")
    )
    runs = numbered.unionByName(ends).groupBy("conv", "band").agg(
        F.sort_array(F.collect_list("turn")).alias("turns"), F.max("last").alias("last")
    )
    return materialize(
        runs.select(
            "conv",
            "band",
            F.unhex(F.array_join(F.transform("turns", lambda t: t["code"]), "")).alias("codes"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
            ((F.col("band") == 0) & (F.col("last") == 1)).alias("whole"),
        ),
        "conversations",
    )


def trie_digest(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(segments_of(*rebuilt_turns(placed_turns(conversations))))
