"""SimHash near-duplicate groups through a hierarchical index in Gray order.

A document's fingerprint has 64 bits; a bit is 1 if it is set in over half of the XXH64
hashes of the document's ``k``-word shingles (A-Z lowered, repeats included). Documents whose
fingerprints differ in at most ``distance`` bits are linked; groups are what links connect.

The join runs over distinct fingerprints, so copies cost nothing. The 64 bits are cut into
``distance + free`` blocks. Of two linked fingerprints some ``free`` blocks agree, so each
choice of ``free`` blocks is a view: its bits are a group's upper pattern, and only rows of one
group can link there. ``free`` follows the number of fingerprints (about 256 rows a group at
most, were they evenly spread) and changes no result. Inside a group rows are sorted by the
Gray rank of their other bits, which puts near ones side by side, and indexed: 16 rows a leaf,
16 leaves a branch, each node holding the bits all its rows share (mask and value) that no
node above holds. A search goes down from the group, adds up the differences along the path
and leaves a node, with all its rows, as soon as they pass ``distance``. Neighbours in Gray
order are linked first, and a node whose rows all belong to the searcher's own component is
left too, so a dense group is never expanded into its pairs; a task writes at most one link
per row and view, to the least of its component.

No task holds a whole group: rows are dealt by ranges of (view, group, rank) and cut into
pieces of at most ``piece`` rows. Pieces of one group that are neither apart by their common
patterns nor already one component are searched against each other, pair by pair of pieces,
each pair in whichever task has room. A group of many rows that stay unlinked therefore takes
work in the square of its pieces.

Defined results: a null, empty or blank text has fingerprint zero and is linked like any
other; fewer than ``k`` words make one shingle; texts are read whole; rows that share an id
are documents of their own; a null id gets its group's component, null if the whole group has
none; an empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from regispark.llm.common import LOWER, components, encoded, partitions, slices, staged

SEED = 42
#: Hashes whose bits are counted at a time, rows of a leaf and leaves of a branch.
HASHES, FAN = 1 << 14, 16
#: Rows a group should have at most if fingerprints were evenly spread.
GROUP_ROWS = 256
#: (searcher, node) pairs taken at a time.
PAIRS = 1 << 19
_SIGN = np.uint64(1 << 63)


def fingerprint(text: bytes, k: int = 4) -> int:
    """The 64-bit fingerprint of a whole text."""
    words = text.translate(LOWER).split()  # bytes split at blank and \t\n\v\f\r
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts, ends = (starts[: 1 - k or None], ends[k - 1 :]) if len(words) >= k else (starts[:1], ends[-1:])
    n, counts, digest = len(starts), np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for lo in range(0, n, HASHES):
        a, b = starts[lo : lo + HASHES].tolist(), ends[lo : lo + HASHES].tolist()
        h = np.fromiter((digest(joined[i:j], SEED) for i, j in zip(a, b)), dtype=np.uint64, count=len(a))
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, k: int = 4) -> DataFrame:
    """(doc_id, fp) of each row of ``docs`` (doc_id, text); ``fp`` as a signed long."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, k) for t in encoded(batch)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(sign, "doc_id long, fp long")


# ---- Gray order and views ---------------------------------------------------------------


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each word in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def gray_word(rank: np.ndarray) -> np.ndarray:
    return rank ^ (rank >> np.uint64(1))


def views(distance: int, free: int) -> np.ndarray:
    """The masks of all choices of ``free`` out of ``distance + free`` blocks of the 64 bits."""
    edges = np.linspace(0, 64, distance + free + 1).round().astype(int).tolist()
    blocks = [((1 << hi) - 1) ^ ((1 << lo) - 1) for lo, hi in zip(edges, edges[1:])]
    return np.array([sum(c) for c in itertools.combinations(blocks, free)], dtype=np.uint64)


def free_blocks(n: int, distance: int) -> int:
    """As many agreeing blocks as keep an evenly spread group within ``GROUP_ROWS``."""
    for free in range(1, 5):
        if n <= GROUP_ROWS << (64 * free // (distance + free)):
            return free
    return 4


def _viewed(masks: np.ndarray):
    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for i, m in enumerate(masks):
                rank = gray_rank(fp & ~m) ^ _SIGN  # so that signed order is rank order
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(fp), i, dtype=np.int32)), pa.array((fp & m).view(np.int64)), pa.array(rank.view(np.int64))],
                    names=["view", "key", "rank"])

    return view


# ---- the index --------------------------------------------------------------------------


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, item) for every item of every range start..end."""
    n = np.maximum(end - start, 0)
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + start[owner]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the least row of each row's component) after linking rows a and b."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        la, lb = la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label != label[label]).any():
            label = label[label]


class Index:
    """Leaves and branches over rows ordered by (group, Gray rank)."""

    def __init__(self, fp: np.ndarray, group_start: np.ndarray):
        self.fp = fp
        size = np.diff(np.append(group_start, len(fp)))
        place = np.arange(len(fp)) - np.repeat(group_start, size)
        self.leaf = np.flatnonzero(place % FAN == 0)
        self.branch = np.flatnonzero(place % FAN**2 == 0)
        self.leaf_end = np.append(self.leaf[1:], len(fp))
        self.branch_end = np.append(self.branch[1:], len(fp))
        self.first_leaf = np.searchsorted(self.leaf, self.branch)
        self.last_leaf = np.append(self.first_leaf[1:], len(self.leaf))
        self.branch_mask, self.branch_value = self._common(self.branch)
        mask, self.leaf_value = self._common(self.leaf)
        # a leaf holds only what its branch does not
        self.leaf_mask = mask & ~np.repeat(self.branch_mask, self.last_leaf - self.first_leaf)

    def _common(self, start: np.ndarray):
        low, high = np.bitwise_and.reduceat(self.fp, start), np.bitwise_or.reduceat(self.fp, start)
        mask = ~(low ^ high)
        return mask, low & mask

    def near(self, q: np.ndarray, lo: np.ndarray, hi: np.ndarray, own: np.ndarray, label: np.ndarray, distance: int):
        """(searcher, row) pairs within ``distance`` among rows lo..hi of each searcher, which
        belong to another component (``own`` of the searchers, ``label`` of the rows)."""
        def settled(start, who, node):
            least, most = np.minimum.reduceat(label, start), np.maximum.reduceat(label, start)
            return (least[node] == own[who]) & (most[node] == own[who])

        who, node = _ranges(np.searchsorted(self.branch, lo, side="right") - 1, np.searchsorted(self.branch, hi))
        apart = np.bitwise_count((q[who] ^ self.branch_value[node]) & self.branch_mask[node])
        go = (apart <= distance) & ~settled(self.branch, who, node)
        who, node, apart = who[go], node[go], apart[go]
        at, leaf = _ranges(self.first_leaf[node], self.last_leaf[node])
        who, apart = who[at], apart[at]
        apart = apart + np.bitwise_count((q[who] ^ self.leaf_value[leaf]) & self.leaf_mask[leaf])
        go = (apart <= distance) & (self.leaf_end[leaf] > lo[who]) & (self.leaf[leaf] < hi[who]) & ~settled(self.leaf, who, leaf)
        who, leaf = who[go], leaf[go]
        at, row = _ranges(self.leaf[leaf], self.leaf_end[leaf])
        who = who[at]
        go = (row >= lo[who]) & (row < hi[who]) & (np.bitwise_count(q[who] ^ self.fp[row]) <= distance)
        return who[go], row[go]


def _steps(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive searchers with about ``PAIRS`` rows to look at in all."""
    total, lo = np.cumsum(n), 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + PAIRS)))
        yield lo, min(hi, len(n))
        lo = hi


def linked_within(fp: np.ndarray, group_start: np.ndarray, distance: int) -> np.ndarray:
    """For each row the least row of its component, links being sought inside groups."""
    label = np.arange(len(fp))
    end = np.repeat(np.append(group_start[1:], len(fp)), np.diff(np.append(group_start, len(fp))))
    for gap in range(1, 5):  # neighbours in Gray order first
        a = np.flatnonzero(np.arange(len(fp)) + gap < end)
        a = a[np.bitwise_count(fp[a] ^ fp[a + gap]) <= distance]
        label = merge(label, a, a + gap)
    index, row = Index(fp, group_start), np.arange(len(fp))
    for lo, hi in _steps(end - row):
        who, other = index.near(fp[lo:hi], row[lo:hi] + 1, end[lo:hi], label[lo:hi], label, distance)
        label = merge(label, who + lo, other)
    return label


def linked_across(x: np.ndarray, y: np.ndarray, x_of: np.ndarray, y_of: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between two pieces, one per pair of components found near, from the components
    ``x_of`` and ``y_of`` the rows had."""
    order = np.argsort(gray_rank(y))
    y, y_of = y[order], y_of[order]
    of, label = np.unique(np.concatenate([x_of, y_of]), return_inverse=True)
    root = np.arange(len(of))
    index, n = Index(y, np.array([0])), len(x)
    a, b = [], []
    for lo, hi in _steps(np.full(n, len(y))):
        now = root[label]
        m = hi - lo
        who, other = index.near(x[lo:hi], np.zeros(m, dtype=np.int64), np.full(m, len(y)), now[lo:hi], now[n:], distance)
        _, once = np.unique(now[lo + who] * len(of) + now[n + other], return_index=True)
        a.append(x[lo + who[once]])
        b.append(y[other[once]])
        root = merge(root, label[lo + who[once]], label[n + other[once]])
    return np.concatenate(a), np.concatenate(b)


# ---- the join ---------------------------------------------------------------------------


def _searcher(masks: np.ndarray, piece: int, distance: int):
    """Links inside the pieces of a range of (view, key, rank); pieces whose group may go on
    elsewhere are passed on."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("view", pa.int32()), ("key", pa.int64()), ("piece", pa.list_(pa.int64()))])
        held: list[list[np.ndarray]] = []

        def found(view, key, fp):
            start = np.flatnonzero(np.concatenate([[True], (view[1:] != view[:-1]) | (key[1:] != key[:-1])]))
            label = linked_within(fp, start, distance)
            moved = np.flatnonzero(label != np.arange(len(fp)))
            signed = fp.view(np.int64)
            if len(moved):
                yield pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]]), *(
                    pa.nulls(len(moved), kinds.field(c).type) for c in ("view", "key", "piece"))], schema=kinds)
            # the first and the last group of what a task sees at a time may go on elsewhere
            for g in sorted({0, len(start) - 1}):
                rows = signed[start[g] : start[g + 1] if g + 1 < len(start) else None]
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array(view[start[g]: start[g] + 1]),
                                                  pa.array(key[start[g]: start[g] + 1]), pa.array([rows.tolist()], kinds.field("piece").type)], schema=kinds)

        def flat():
            view, key, rank = (np.concatenate([h[i] for h in held]) for i in range(3))
            held.clear()
            fp = key.view(np.uint64) | gray_word(rank.view(np.uint64) ^ _SIGN)
            return view, key, fp

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, piece):
                rows = batch.slice(at, piece)
                held.append([rows.column(c).to_numpy() for c in ("view", "key", "rank")])
                size += rows.num_rows
                if size >= piece:
                    yield from found(*flat())
                    size = 0
        if held:
            yield from found(*flat())

    return search


def _crosser(distance: int):
    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                xf, xc, yf, yc = (np.array([r[c] for r in side], dtype=np.int64) for side, c in ((x, "fp"), (x, "c"), (y, "fp"), (y, "c")))
                a, b = linked_across(xf.view(np.uint64), yf.view(np.uint64), xc, yc, distance)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return cross


def hamming_links(fps: DataFrame, distance: int = 4, piece: int = 4096, free: int | None = None) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fps`` (fp) that connect all those which differ
    in at most ``distance`` bits; not every link, but every component's."""
    spark = fps.sparkSession
    masks = views(distance, free or free_blocks(fps.count(), distance))
    rows = fps.select("fp").mapInArrow(_viewed(masks), "view int, key long, rank long")
    dealt = rows.repartitionByRange(partitions(spark), "view", "key", "rank").sortWithinPartitions("view", "key", "rank")
    found = staged(dealt.mapInArrow(_searcher(masks, piece, distance), "a long, b long, view int, key long, piece array<long>"))
    links = found.where("piece is null").select("a", "b")
    open_groups = found.where("piece is not null").groupBy("view", "key").agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1").select("view", "key")
    pieces = staged(found.where("piece is not null").join(open_groups, ["view", "key"]).select(
        "view", "key", F.xxhash64("view", F.element_at("piece", 1)).alias("id"), "piece"))
    if pieces.isEmpty():
        return links
    # only pieces not yet in one component, nor apart by their common patterns, are searched
    known = components(links).withColumnRenamed("node", "fp").withColumnRenamed("component_id", "c")
    labelled = staged(pieces.select("view", "key", "id", F.explode("piece").alias("fp")).join(known, "fp", "left").select(
        "view", "key", "id", "fp", F.coalesce("c", "fp").alias("c")).groupBy("view", "key", "id").agg(
            F.collect_list(F.struct("fp", "c")).alias("rows"), F.min("c").alias("least"), F.max("c").alias("most"),
            F.bit_and("fp").alias("low"), F.bit_or("fp").alias("high")))
    side = labelled.select("view", "key", "id", "least", "most", "low", F.expr("~(low ^ high)").alias("mask"))
    x, y = (side.select("view", "key", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "least", "most", "low", "mask"))) for s in "xy")
    pairs = staged(x.join(y, ["view", "key"]).where(
        f"id_x < id_y and not (least_x = most_x and least_y = most_y and least_x = least_y) "
        f"and bit_count((low_x ^ low_y) & mask_x & mask_y) <= {distance}").select("id_x", "id_y"))
    rows = labelled.select("id", "rows")
    paired = pairs.join(rows.toDF("id_x", "x"), "id_x").join(rows.toDF("id_y", "y"), "id_y").select("x", "y")
    return links.union(paired.mapInArrow(_crosser(distance), "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 4, distance: int = 4, piece: int = 4096, free: int | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs`` (doc_id, text)."""
    signed = staged(fingerprints(docs, k))
    fps = staged(signed.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    found = staged(components(hamming_links(fps, distance, piece, free)))
    labelled = staged(fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("component_id", "fp").alias("c")))
    least = labelled.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = staged(labelled.join(least, "c").select("fp", "component_id"))
    return signed.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
