"""Near-duplicate groups by SuperMinHash, banding, full-set verification and union-find.

A document's set holds the distinct ``k``-word shingles of its A-Z-lowered words. Every
document gets a SuperMinHash signature: each shingle draws a random permutation of the
components step by step and offers ``step + r`` to the component drawn, so the values of
one shingle are spread evenly over the components (lower variance than independent hashes)
and a document is done at the first step that can no longer lower any of its values.
Bands of the signature propose pairs; the full sets confirm them; components follow from
the confirmed links.

Rounds, each confirmed on full sets, none of which emits all pairs of a bucket:

1. documents with the same set are one node (their least id);
2. every node against one centre: the least node of all its buckets;
3. every node against the least node of each bucket, where the components still differ;
4. nodes of buckets that still hold several components, by an exact prefix filter.

Misses: a pair at similarity s is proposed with odds 1 - (1 - s**rows)**bands, at the
defaults more than 0.999994 at s = 0.75 and higher above.

Defined results: a null or blank text has no shingles and stands alone; a null id takes
no part in links (``component_id`` null, kept); rows that share an id are one node; fewer
than ``k`` words make one shingle; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from regispark._util import fresh
from regispark.llm.common import Hasher, blocks, components, encoded, mix64, shingle_hashes, slices, staged, word_table, words

_STEP_BITS = np.uint64(57)


def superminhash(doc: np.ndarray, shingle: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """Signatures, (n_docs, m) of uint64, of the shingles sorted by document. A value is
    ``step * 2**57 + r``; a document without shingles keeps the largest value throughout."""
    if m > 128:
        raise ValueError("at most 128 components")
    sig = np.full((n_docs, m), np.uint64(2**64 - 1), dtype=np.uint64)
    flat = sig.reshape(-1)
    perm = None
    for step in range(m):
        x = mix64(shingle + np.uint64((2 * step + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        y = mix64(x + np.uint64(0xA0761D6478BD642F))
        pick = (step + (((y >> np.uint64(32)) * np.uint64(m - step)) >> np.uint64(32)).astype(np.int64)).astype(np.int64)
        if step == 0:
            position = pick
        else:
            rows = np.arange(len(doc))
            position = perm[rows, pick].astype(np.int64)
            perm[rows, pick] = perm[:, step]
            perm[:, step] = position
        np.minimum.at(flat, doc * m + position, (np.uint64(step) << _STEP_BITS) | (x >> np.uint64(7)))
        open_docs = sig.max(axis=1) >= (np.uint64(step + 1) << _STEP_BITS)
        keep = open_docs[doc]
        if not keep.any():
            break
        doc, shingle = doc[keep], shingle[keep]
        if step == 0:
            perm = np.tile(np.arange(m, dtype=np.uint8), (len(doc), 1))
            rows, first = np.arange(len(doc)), pick[keep]
            perm[rows, first] = 0
            perm[:, 0] = first
        else:
            perm = perm[keep]
    return sig


def _sets(texts: list[bytes], k: int, hasher: Hasher, flags: np.ndarray):
    h, doc, _, _ = words(texts, flags, hasher)
    return shingle_hashes(h, doc, len(texts), k)


def _signer(k: int, bands: int, rows: int):
    m = bands * rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, flags = Hasher(), word_table("space")
        for batch in slices(batches):
            texts = encoded(batch)
            for lo, hi in blocks(texts):
                doc, s = _sets(texts[lo:hi], k, hasher, flags)
                n = np.bincount(doc, minlength=hi - lo)
                sig = superminhash(doc, s, hi - lo, m)
                key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (hi - lo, 1))
                for r in range(rows):
                    key = mix64(key * np.uint64(0xD6E8FEB86659FD93) + sig[:, r::rows])
                digests = []
                for c in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    out = np.zeros(hi - lo, dtype=np.uint64)
                    if len(s):
                        out[n > 0] = np.add.reduceat(mix64(s ^ np.uint64(c)), (np.cumsum(n) - n)[n > 0])
                    digests.append(pa.array(out.view(np.int64)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, key.size + 1, bands, dtype=np.int32)), pa.array(key.view(np.int64).reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), pa.array(n.astype(np.int64)), *digests, lists],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands"])

    return sign


def _set_maker(k: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, flags = Hasher(), word_table("space")
        for batch in slices(batches):
            texts = encoded(batch)
            for lo, hi in blocks(texts):
                doc, s = _sets(texts[lo:hi], k, hasher, flags)
                ends = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo), batch.column("centre").slice(lo, hi - lo),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(s.view(np.int64)))],
                    names=["doc_id", "centre", "shingles"])

    return make


def _measured(pairs: DataFrame) -> DataFrame:
    """(a, b, na, nb, both) of pairs (a, b, sa, sb): the set sizes and the overlap."""
    return pairs.select("a", "b", F.size("sa").cast("long").alias("na"), F.size("sb").cast("long").alias("nb"),
                        F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"))


def _linked(measured: DataFrame, percent: int) -> DataFrame:
    """The links: 100 * |A & B| >= percent * |A | B|."""
    return measured.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _size_fit(pairs: DataFrame, percent: int) -> DataFrame:
    """Sets whose sizes differ too much cannot overlap enough."""
    return pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))


def _across(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes of different components that may still be linked, by an exact
    prefix filter over ``sets`` (doc_id, shingles, c, centre, near). Shingles are ranked:
    first those found in one component only, which can join nothing, then the others from
    rare to frequent. Three exact bounds on the overlap, all inside the join, drop pairs:

    - two sets that overlap enough share a shingle among the first
      ``n - ceil(n * percent / 100) + 1`` of each, so a common passage pairs nobody;
    - at the first shared shingle, enough shingles must follow in both;
    - sets measured against the same centre (``near`` shingles shared with it) share at
      most the lesser part inside it plus the lesser part outside it.
    """
    n = F.size("shingles").cast("long")
    tokens = sets.select("doc_id", n.alias("n"), "c", "centre", "near", F.explode("shingles").alias("s"))
    mixed = staged(tokens.groupBy("s").agg(F.count(F.lit(1)).alias("f"), F.min("c").alias("c0"), F.max("c").alias("c1"))
                   .where("c0 < c1").select("s", "f"))
    in_doc = Window.partitionBy("doc_id")
    ranked = tokens.join(mixed, "s").withColumn("m", F.count(F.lit(1)).over(in_doc)).withColumn(
        "r", F.row_number().over(in_doc.orderBy("f", "s")))
    # n - m shingles of one component come before the ranked ones
    prefix = staged(ranked.withColumn("at", F.col("r") + F.col("n") - F.col("m"))
                    .where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / F.lit(100)) + 1)
                    .select("s", "doc_id", "n", "c", "centre", "near", "at"))
    x, y = (prefix.select("s", F.col("doc_id").alias(i), *(F.col(v).alias(v + i) for v in ("n", "c", "centre", "near", "at")))
            for i in "ab")
    # |A & B| >= percent / (100 + percent) * (|A| + |B|) is what a link takes
    need = f"{percent} * (na + nb)"
    return x.join(y, "s").where(f"""a < b and ca <> cb and 100 * least(na, nb) >= {percent} * greatest(na, nb)
        and {100 + percent} * (1 + least(na - ata, nb - atb)) >= {need}
        and (centrea <> centreb or {100 + percent} * (least(neara, nearb) + least(na - neara, nb - nearb)) >= {need})
        """).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75, bands: int = 32, rows: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = staged(docs.mapInArrow(_signer(k, bands, rows), "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"))
    nodes = signed.where("n_shingles > 0 and doc_id is not null")

    classes = staged(nodes.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")))
    member = staged(nodes.join(classes, ["d1", "d2"]).select(
        "doc_id", "n_shingles", "rep", F.when(F.col("doc_id") == F.col("rep"), F.col("bands")).alias("bands")))

    entries = member.where("bands is not null").select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    lows = staged(entries.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key", "lo"))
    shared = staged(entries.join(lows, "key").select("key", "rep", "n", "lo").distinct())

    # round 2: one centre per node; the sets of all nodes in any shared bucket
    centre = shared.groupBy("rep").agg(F.min("lo").alias("centre")).withColumnRenamed("rep", "doc_id")
    held = staged(docs.join(centre, "doc_id").mapInArrow(_set_maker(k), "doc_id long, centre long, shingles array<long>"))
    a = held.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    star = held.where("doc_id <> centre").select(F.col("centre").alias("a"), F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    measured = staged(_measured(star.join(a, "a")))
    links = _linked(measured, percent)
    known = measured.select("a", "b")
    near = measured.select(F.col("b").alias("doc_id"), F.col("both").alias("near"))

    for centres in (True, False):
        found = components(links)
        labelled = shared.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
            "key", "rep", "n", "lo", F.coalesce("component_id", "rep").alias("c"))
        if centres:
            base = labelled.where("rep = lo").select("key", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca"))
            other = labelled.where("rep > lo").select("key", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"))
            pairs = base.join(other, "key").where("ca <> cb")
            pairs = _size_fit(pairs, percent).select("a", "b").distinct()
        else:
            mixed = labelled.groupBy("key").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).where("c0 < c1").select("key")
            unsettled = labelled.join(staged(mixed), "key").select(F.col("rep").alias("doc_id"), "c").distinct()
            sets = held.join(unsettled, "doc_id").join(near, "doc_id", "left").withColumn(
                "near", F.coalesce("near", F.size("shingles").cast("long")))
            pairs = _across(staged(sets), percent)
        pairs = staged(pairs.join(known, ["a", "b"], "left_anti"))
        ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
        few = staged(held.select("doc_id", "shingles").join(ids, "doc_id"))
        left = pairs.join(few.toDF("a", "sa"), "a")
        links = staged(links.union(_linked(_measured(left.join(few.toDF("b", "sb"), "b")), percent)))
        known = known.union(pairs)

    found = components(links)
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    grouped = member.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "rep").alias("component_id"))
    return grouped.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that stay: the least doc_id of each group, one row of an id
    (the least text, where several share it); rows with a null id stay."""
    kept = near_duplicates(docs, **settings).where("kept and doc_id is not null").select("doc_id").distinct()
    number = fresh(docs.columns, "row")
    once = Window.partitionBy("doc_id").orderBy("text", *(c for c in docs.columns if c not in ("doc_id", "text")))
    named = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi").withColumn(number, F.row_number().over(once))
    return named.where(F.col(number) == 1).drop(number).select(docs.columns).unionByName(docs.where("doc_id is null"))
