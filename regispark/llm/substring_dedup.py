"""Substring dedup by content-defined chunks of a gear rolling hash.

A gear hash over the last 16 bytes decides where a chunk ends, so the same passage is cut
in the same places wherever it stands, and an insertion moves only the cuts around it. A
cut too close behind another candidate is dropped by a rule that looks at the preceding
bytes only, and cuts move on to the next character start. Chunks are keyed by a 64-bit
digest; a digest held by two or more documents is a repeat. Adjacent repeated chunks of a
document join to a passage; passages of at least ``min_words`` words are reported, which
also shields them from chance digests. A passage loses, on average, about a chunk at each
end, so ``min_words`` of 20 finds passages of 50 words and more.

The digest's least document id holds the first copy; ``first`` says that the document is
that holder throughout the passage. Shuffled are digests, ids and offsets, no texts; a digest held
by very many documents is summed before the shuffle and split by AQE in the join.

Defined results: null or blank texts and null ids take no part; rows of the same id are one
document; a text equal to another's is a repeat as a whole; offsets are bytes of UTF-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from regispark._util import fresh
from regispark.llm.common import LOWER, Hasher, blocks, encoded, mix64, slices, staged, word_table

#: Bytes the rolling hash sees, candidates per 2**32 hash values, least distance of cuts.
WINDOW, EVERY, GAP = 16, 24, 6
#: A-Z lowered, white space to a blank.
_FOLDED = bytes(0x20 if b in (*range(0x09, 0x0E), 0x20) else b for b in LOWER)


def gear_table() -> np.ndarray:
    return (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) >> np.uint64(32)).astype(np.uint32)


def gear_hashes(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """The sum of gear[byte] << age over the last 16 bytes, for every position, by doubling."""
    h, step = gear[data], 1
    while step < WINDOW:
        older = np.zeros_like(h)
        older[step:] = h[:-step] << np.uint32(step)
        h, step = h + older, step * 2
    return h


def cuts(texts: list[bytes], gear: np.ndarray):
    """(bytes, chunk starts, chunk ends, text index, start and end in the text itself) of a
    block. Chunks are cut from the A-Z-lowered bytes with white space folded to one blank, so
    a passage set in other lines is the same passage; the last two give the original offsets,
    where a chunk reaches to the next one's start: white space folded at a cut parts no passage."""
    # zero bytes between texts, twice the window: neither a hash nor the gap rule sees a neighbour
    pad = b"\0" * (2 * WINDOW)
    raw = np.frombuffer((pad + pad.join(texts) + pad).translate(_FOLDED), dtype=np.uint8)
    length = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
    begins = np.cumsum(length + len(pad)) - length
    blank = raw == 0x20
    kept = np.flatnonzero(~(blank & np.concatenate([[False], blank[:-1]])))
    data = raw[kept]
    first = np.searchsorted(kept, begins)
    size = np.searchsorted(kept, begins + length) - first
    at = np.flatnonzero(gear_hashes(data, gear) < np.uint32((1 << 32) // EVERY)) + 1
    if len(at):
        at = at[np.concatenate([[True], np.diff(at) > GAP])]
    for _ in range(3):
        at = at + ((data[np.minimum(at, len(data) - 1)] & 0xC0) == 0x80)
    owner = np.searchsorted(first, at, side="right") - 1
    inside = (owner >= 0) & (at > first[np.maximum(owner, 0)]) & (at < (first + size)[np.maximum(owner, 0)])
    start = np.unique(np.concatenate([first[size > 0], at[inside]]))
    text = np.searchsorted(first, start, side="right") - 1
    # an empty text begins where the next one does
    end = np.minimum(np.append(start[1:], len(data)), (first + size)[text])
    here, there = kept[start] - begins[text], kept[end - 1] + 1 - begins[text]
    inner = np.flatnonzero(text[1:] == text[:-1])
    there[inner] = here[inner + 1]
    return data, start, end, text, here, there


def _chunker():
    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, gear, flags = Hasher(), gear_table(), word_table("space")
        flags[0] = False  # the bytes between texts
        for batch in slices(batches):
            texts = encoded(batch)
            for lo, hi in blocks(texts):
                data, start, end, text, here, there = cuts(texts[lo:hi], gear)
                digest = hasher.ranges(hasher.prefix(data), start, end)
                word = flags[data]
                begun = np.zeros(len(data) + 1, dtype=np.int64)
                np.cumsum(word & ~np.concatenate([[False], word[:-1]]), out=begun[1:])
                ids = batch.column("doc_id").slice(lo, hi - lo).take(pa.array(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest.view(np.int64)), ids, pa.array(here), pa.array(there - here), pa.array(begun[end] - begun[start])],
                    names=["digest", "doc_id", "start", "size", "words"])

    return chunk


def chunks(docs: DataFrame) -> DataFrame:
    """(digest, doc_id, start, size, words) of every chunk."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.where("doc_id is not null and text is not null").mapInArrow(
        _chunker(), "digest long, doc_id long, start long, size long, words long")


def repeated_passages(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """(doc_id, start, end, n_words, holder, first): the passages of each document whose
    chunks all stand in another document too; ``holder`` is the least id that holds a chunk of it."""
    found = chunks(docs)
    repeated = staged(found.groupBy("digest").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last")).where("holder < last").select("digest", "holder"))
    hits = found.select("digest", "doc_id", "start", "size", "words").join(repeated, "digest").select(
        "doc_id", "start", (F.col("start") + F.col("size")).alias("end"), "words", "holder").distinct()
    in_doc = Window.partitionBy("doc_id").orderBy("start", "end")
    reach = F.max("end").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = hits.withColumn("new", F.coalesce((F.col("start") > reach).cast("int"), F.lit(1))).withColumn("island", F.sum("new").over(in_doc))
    return islands.groupBy("doc_id", "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.min("holder").alias("holder"),
        F.bool_and(F.col("holder") == F.col("doc_id")).alias("first")).where(F.col("n_words") >= min_words).drop("island")


def without_repeats(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """``docs`` with the later copies of repeated passages cut out of ``text``."""
    hidden = fresh(docs.columns, "spans")
    spans = repeated_passages(docs, min_words).where("not first").groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(hidden))
    work = docs.join(spans, "doc_id", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column(hidden).to_pylist()):
                if spans:
                    data, at, kept = text.encode(), 0, []
                    for s in spans:
                        kept.append(data[at : s["start"]])
                        at = max(at, s["end"])
                    text = b"".join([*kept, data[at:]]).decode("utf-8", "replace")
                out.append(text)
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, "text", pa.array(out, batch.schema.field(i).type)).drop_columns([hidden])

    schema = work.drop(hidden).schema
    return work.mapInArrow(cut, schema).select(docs.columns)
