"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

Symbols are A-Z-lowered words (runs of ASCII letters and digits and of non-ASCII
characters), so punctuation, case and line breaks do not hide a passage. A CGK walk reads
a string through a random walk: at step j it emits the symbol under its pointer and moves
on by a random bit drawn from (j, symbol); strings at a small edit distance fall into step
again and emit strings at a small Hamming distance. A repetition samples some positions of
one walk and its key is the symbols emitted there.

An item is embedded from each of its phases to its end, rounded down to the next window size
of :data:`WINDOWS` (a walk of three steps for two words, so that it ends inside the item):
the whole item from its first phase on, what is left of it, half at least, from later ones. Phases
are the words rare among the items and some evenly spaced ones. A document is embedded at every word
that begins a phase, in each window size. Two positions of a window's samples stand at its
beginning, so that most windows drop out after a few steps as no beginning of an item's key;
the others are spread over the whole window. The walks' keys alone propose candidates.

The number of repetitions follows from ``target``: copies of a bounded sample of the block's items
with as many random edits as the bound allows are sought, and repetitions are added until
that share of them is found among short, middling and long items alike. An item none of
whose walks ends inside it is looked up by its first word.

Candidates are verified by the exact word edit distance of the item to the best window of the
document; at most ``max_edits`` per word of the item counts as contaminated, so nothing else
is ever reported. Verbatim copies are always proposed; of copies edited up to the bound a
share of 1 - ``target`` may be missed. The benchmark is read in blocks of ``block_items``
items, each broadcast on its own (its size is bounded by the block, whatever the benchmark's);
every block reads the documents once.

Defined results: a null or wordless text or item matches nothing; repeated items report
each item_id; every document row is judged by itself; texts are read whole; other columns
pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regispark.llm.common import Hasher, blocks, encoded, mix64, slices, word_table, words

#: A word found in more than this share of the items starts no walk of its own, but each item
#: has at least so many phases, evenly spaced.
COMMON, SPACED_PHASES = 0.02, 8
#: Window sizes in words; the walk takes three steps for two words. The smallest serves items
#: of fewer than 2 * ``WINDOWS[1]`` words only.
WINDOWS = (3, 4, 8, 16, 32)
#: Items and edited copies of each that the repetitions are counted on, and the most of these.
TRIAL_ITEMS, TRIAL_COPIES, MOST_REPETITIONS = 60, 4, 24


class Sampler:
    """The walks and sampled positions of all repetitions and window sizes, fixed by the seed."""

    def __init__(self, samples: int, seed: int, repetitions: int = MOST_REPETITIONS):
        rng = np.random.default_rng(seed)
        self.walks = []
        for _ in range(repetitions):
            salts = rng.integers(1, 2**63, WINDOWS[-1] * 3 // 2, dtype=np.uint64)
            at = []
            for words_ in WINDOWS:
                steps = words_ * 3 // 2
                near = int(rng.integers(1, min(4, steps)))
                rest = [x for x in range(1, steps) if x != near]
                far = rng.choice(rest, min(samples - 2, len(rest)), replace=False).tolist()
                at.append([0, *sorted([near, *far])])
            self.walks.append((salts, at))

    def moves(self, symbols: np.ndarray, salt: np.uint64) -> np.ndarray:
        return (((symbols ^ salt) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(63)).astype(np.int64)

    def keys(self, symbols: np.ndarray, walk: int, size: int, rows: np.ndarray, alive=None):
        """(start, key) of the windows of size ``WINDOWS[size]`` at ``rows`` that survive.
        ``alive(level, keys)`` says which keys may still become one of an item's; windows
        that leave ``symbols`` are dropped."""
        salts, at = self.walks[walk][0], self.walks[walk][1][size]
        start, pointer, key = rows, rows.copy(), np.full(len(rows), np.uint64((walk + 1) * len(WINDOWS) + size))
        level = 0
        for step in range(at[-1] + 1):
            inside = pointer < len(symbols)
            if not inside.all():
                start, pointer, key = start[inside], pointer[inside], key[inside]
            seen = symbols[pointer]
            if step == at[level]:
                key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + seen)
                if alive is not None:
                    keep = alive(level, key)
                    start, pointer, key, seen = start[keep], pointer[keep], key[keep], seen[keep]
                level += 1
            pointer = pointer + self.moves(seen, salts[step])
        return start, key

    def item_keys(self, item: np.ndarray, phases: np.ndarray, walk: int, note=None):
        """(size, phases, keys) for each window size of an item's phases."""
        left = len(item) - phases
        size = np.searchsorted(WINDOWS, left, side="right") - 1
        out = []
        for c in range(len(WINDOWS)):
            rows = phases[size == c]
            if len(item) < 2 * WINDOWS[1] and c == 0:
                rows = phases[left >= WINDOWS[0]]  # besides their larger windows
            elif c == 0:
                rows = rows[:0]
            if len(rows):
                out.append((c, *self.keys(item, walk, c, rows, None if note is None else (lambda level, key, c=c: note(c, level, key)))))
        return out


def edit_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least word edit distance of ``item`` to a window of ``text``: (distance, start, end),
    the first shortest window of the least distance. One row of the table per word of the item."""
    m = len(text)
    row, origin = np.zeros(m + 1, dtype=np.int64), np.arange(m + 1)
    for i, symbol in enumerate(item, 1):
        change = row[:-1] + (text != symbol)
        drop = row[1:] + 1
        best = np.where(change <= drop, change, drop)
        came = np.where(change <= drop, origin[:-1], origin[1:])
        new, frm = [i], [0]
        for j in range(m):  # insertions run along the row
            if new[j] + 1 < best[j]:
                new.append(new[j] + 1)
                frm.append(frm[j])
            else:
                new.append(int(best[j]))
                frm.append(int(came[j]))
        row, origin = np.array(new), np.array(frm)
    end = int(np.argmin(row))
    return int(row[end]), int(origin[end]), end


class Index:
    """Keys of a block of items, as sorted arrays, and the items' words."""

    def __init__(self, items: list[tuple[int | None, bytes]], sampler: Sampler, max_edits: float, target: float):
        hasher, flags = Hasher(), word_table("alnum")
        self.sampler, self.max_edits = sampler, max_edits
        self.ids, self.words = [], []
        for item_id, text in items:
            h = words([text], flags, hasher)[0]
            if len(h):
                self.ids.append(item_id)
                self.words.append(h)
        phases = self._phases()
        self.repetitions = self._repetitions(phases, target)
        # flags by the low bits of a key, some 16 for every key
        self.mask = np.uint64((1 << max(16, (16 * self.repetitions * sum(map(len, phases))).bit_length())) - 1)
        noted: dict[tuple[int, int], list[np.ndarray]] = {}
        begun: dict[int, list[np.ndarray]] = {}
        keys, items_, starts = [], [], []

        def note(size, level, key):
            noted.setdefault((size, level), []).append(key)
            return slice(None)

        alone: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            have = 0
            for walk in range(self.repetitions):
                for c, start, key in sampler.item_keys(w, phases[i], walk, note):
                    keys.append(key)
                    starts.append(start)
                    items_.append(np.full(len(key), i))
                    begun.setdefault(c, []).append(w[start])
                    have += len(key)
            if not have:
                alone.setdefault(int(w[0]), []).append(i)
        self.alone = alone
        self.flags = {at: self._flagged(found) for at, found in noted.items()}
        self.begins = {c: self._flagged(found) for c, found in begun.items()}
        none = np.zeros(0, dtype=np.int64)
        keys = np.concatenate(keys or [none.astype(np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.keys, self.items, self.starts = keys[order], np.concatenate(items_ or [none])[order], np.concatenate(starts or [none])[order]

    def _flagged(self, found: list[np.ndarray]) -> np.ndarray:
        """A bit for each value of the low bits of a key, set where there is such a key."""
        bits = np.zeros(int(self.mask) + 1, dtype=bool)
        for keys in found:
            bits[(keys & self.mask).astype(np.int64)] = True
        return np.packbits(bits, bitorder="little")

    def _has(self, flags: np.ndarray, keys: np.ndarray) -> np.ndarray:
        low = (keys & self.mask).astype(np.int64)
        return (flags[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1

    def _phases(self) -> list[np.ndarray]:
        """The phases of each item: the words that stand in few items, and ``SPACED_PHASES``
        evenly spaced ones; walks from common words would start everywhere."""
        once = np.concatenate([np.unique(w) for w in self.words] or [np.zeros(0, dtype=np.uint64)])
        known, df = np.unique(once, return_counts=True)
        out = []
        for w in self.words:
            rare = np.flatnonzero(df[np.searchsorted(known, w)] <= max(1, COMMON * len(self.words)))
            reach = len(w) - len(w) // 2 + 1  # windows of half the item at least
            spaced = np.arange(0, reach, max(1, reach // SPACED_PHASES))
            out.append(np.union1d(rare[rare < reach], spaced))
        return out

    def _repetitions(self, phases: list[np.ndarray], target: float) -> int:
        """The least number of repetitions that finds the share ``target`` of edited copies of a
        sample of the items, of those of fewer than 10, fewer than 25 and more words each."""
        rng = np.random.default_rng(23)
        trials = []
        for i in range(0, len(self.words), max(1, len(self.words) // TRIAL_ITEMS)):
            w = self.words[i]
            slack = int(self.max_edits * len(w))
            for _ in range(TRIAL_COPIES if slack else 0):
                copy = w.tolist()
                for _ in range(slack):
                    at, kind, new = int(rng.integers(len(copy))), int(rng.integers(3)), int(rng.integers(2**62))
                    copy[at : at + (kind != 1)] = [new] if kind < 2 else []
                around = rng.integers(2**62, size=2 * WINDOWS[-1], dtype=np.uint64)
                trials.append((i, 0 if len(w) < 10 else 1 if len(w) < 25 else 2, np.concatenate([around[: WINDOWS[-1]], np.array(copy, dtype=np.uint64), around[WINDOWS[-1] :]])))
        found = np.zeros(len(trials), dtype=bool)
        group = np.array([g for _, g, _ in trials], dtype=int)
        for walk in range(len(self.sampler.walks)):
            for t in np.flatnonzero(~found):
                i, _, text = trials[t]
                rows = np.arange(len(text))
                found[t] = any(np.isin(self.sampler.keys(text, walk, c, rows)[1], key).any()
                               for c, _, key in self.sampler.item_keys(self.words[i], phases[i], walk))
            if walk and all(found[group == g].mean() >= target for g in np.unique(group)):
                return walk + 1
        return len(self.sampler.walks)

    def candidates(self, symbols: np.ndarray) -> set[tuple[int, int]]:
        """(item, word where it would start) for the words of a block of documents."""
        out = set()
        for c, begins in self.begins.items():
            rows = np.flatnonzero(self._has(begins, symbols))

            def alive(level, key, c=c):
                return self._has(self.flags[c, level], key) if (c, level) in self.flags else np.zeros(len(key), dtype=bool)

            for walk in range(self.repetitions):
                start, key = self.sampler.keys(symbols, walk, c, rows, alive)
                lo, hi = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
                for j in np.flatnonzero(hi > lo):
                    out.update(zip(self.items[lo[j] : hi[j]].tolist(), (start[j] - self.starts[lo[j] : hi[j]]).tolist()))
        if self.alone:
            first = np.array(sorted(self.alone), dtype=np.uint64)
            for j in np.flatnonzero(np.isin(symbols, first)):
                out.update((i, int(j)) for i in self.alone[int(symbols[j])])
        return out

    def matches(self, symbols: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
        """{(document, item): (distance, start, end)} over a block, words counted in the document."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        tried = set()
        for item, at in sorted(self.candidates(symbols)):
            w = self.words[item]
            slack = int(self.max_edits * len(w))
            inside = min(max(at + slack, 0), len(symbols) - 1)  # a word that surely belongs to the passage
            anchor = at if 0 <= at < len(symbols) else inside
            for d in {int(doc[anchor]), int(doc[inside])}:
                if (d, item, at // (slack + 1)) in tried:
                    continue
                tried.add((d, item, at // (slack + 1)))
                lo, hi = int(np.searchsorted(doc, d, "left")), int(np.searchsorted(doc, d, "right"))
                a, b = max(lo, at - 2 * slack), min(hi, at + len(w) + 3 * slack + 1)
                # an edit removes at most one word of the item, so this many must be there
                if b - a < len(w) - slack or int(np.isin(w, symbols[a:b]).sum()) < len(w) - slack:
                    continue
                if at >= lo and at + len(w) <= hi and np.array_equal(symbols[at : at + len(w)], w):
                    got = (0, at - lo, at - lo + len(w))
                else:
                    if (d, item) in best and best[d, item][0] == 0:
                        continue
                    distance, s, e = edit_distance(w, symbols[a:b])
                    got = (distance, a + s - lo, a + e - lo)
                if got[0] <= slack and got < best.get((d, item), (1 << 30, 0, 0)):
                    best[d, item] = got
        return best


def _indexes(benchmark: DataFrame, block_items: int, settings: dict):
    """A broadcast index for each block of items; the driver holds one block at a time."""
    sampler = Sampler(settings["samples"], settings["seed"])
    context, block = benchmark.sparkSession.sparkContext, []

    def index():
        return context.broadcast(Index(block, sampler, settings["max_edits"], settings["target"]))

    for row in benchmark.select("item_id", F.col("text").cast("string")).where("text is not null").toLocalIterator():
        block.append((row[0], row[1].encode("utf-8", "surrogatepass")))
        if len(block) == block_items:
            yield index()
            block = []
    if block:
        yield index()


SETTINGS = {"target": 0.995, "samples": 6, "seed": 11, "max_edits": 0.2}


def _batches(batches: Iterator[pa.RecordBatch], index: Index):
    hasher, flags = Hasher(), word_table("alnum")
    for batch in slices(batches):
        texts = encoded(batch)
        found = {}
        for lo, hi in blocks(texts):
            h, doc, _, _ = words(texts[lo:hi], flags, hasher)
            if len(h):
                found |= {(d + lo, i): x for (d, i), x in index.matches(h, doc).items()}
        yield batch, found


def contaminated(docs: DataFrame, benchmark: DataFrame, block_items: int = 5000, **settings) -> DataFrame:
    """(doc_id, item_id, distance, word_start, word_end): for each document row the items it
    contains, with the least edit distance and the words of the document it spans."""
    settings = SETTINGS | settings
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, distance long, word_start long, word_end long"
    names = ["doc_id", "item_id", "distance", "word_start", "word_end"]
    out = None
    for shared in _indexes(benchmark, block_items, settings):
        def scan(batches, shared=shared):
            index = shared.value
            for batch, found in _batches(batches, index):
                at = sorted(found)
                rows = pa.array([d for d, _ in at], type=pa.int64())
                cols = [batch.column("doc_id").take(rows), pa.array([index.ids[i] for _, i in at], type=pa.int64()),
                        *(pa.array([found[k][j] for k in at], type=pa.int64()) for j in range(3))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

        part = docs.mapInArrow(scan, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_items: int = 5000, **settings) -> DataFrame:
    """The rows of ``docs`` that contain no item, with the same columns."""
    settings = SETTINGS | settings
    for shared in _indexes(benchmark, block_items, settings):
        def keep(batches, shared=shared):
            for batch, found in _batches(batches, shared.value):
                mask = np.ones(batch.num_rows, dtype=bool)
                mask[[d for d, _ in found]] = False
                yield batch.filter(pa.array(mask))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs
