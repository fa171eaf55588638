"""Audit of how quality filters interact, by an incremental stream with retractions.

Five filters judge whole texts: A too few words, B too few distinct ones, C too many capitals,
D a symbol, E identical to the text of a smaller id. A to D need the text alone. E needs the
whole table, and the file stream reads it in micro-batches whose order is not that of the
ids. So a keyed state holds, per text, the smallest id so far and whom it stands for. A
smaller id that comes later retracts what the former one had added to the part counters
(-1 without E, +1 with E) and takes its place; the sum of all changes does not depend on the
order or number of the micro-batches. Texts are kept in small buckets of their digest, about
``BUCKET`` a bucket, since a call per text costs some milliseconds and one per bucket the same.

Per micro-batch: each task measures its texts (words, capitals, a 256-bit digest) and drops
them; labels join on the id; each task then adds up the rows of equal texts, so a text that
a third of all rows share arrives as a few rows; rows above the least id of such a sum can
never pass E and go by the state. The changes are added up per task and appended by the
exactly-once file sink. Stream checkpoint, state and changes lie below
``spark.checkpoint.dir``, so a lost executor repeats only its tasks. The state store is the
session's (``spark.sql.streaming.stateStore.providerClass``); Spark's default holds it on the
executors' heaps, some 100 bytes a distinct text, RocksDB on their disks.

The counters, at most 32 masks per part, then give every order of the five filters.

Defined results: a null text is empty, a null part the empty string; rows of one id are
separate documents, and equal texts of one smallest id all pass E; a null id is neither
smaller nor larger than another, so it passes E and fails nobody; a document with several
label rows has what any of them says; null labels count as 0; an empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from regispark.llm.common import encoded, slices, staged
from regispark.session import ensure_checkpoint_dir

#: The thresholds of the five filters.
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SYMBOLS = 200, 50, 2, b"#$%&*|"
FILTERS = "ABCDE"
E_BIT = 1 << FILTERS.index("E")
#: Distinct texts whose sums a task holds before it hands them on.
HELD = 50_000
#: Rows per state bucket, about.
BUCKET = 2_000

_CAPITALS = bytes(range(0x41, 0x5B))
_NOT_CAPITALS = bytes(b for b in range(256) if b not in _CAPITALS)
_SYMBOL = re.compile(b"[" + re.escape(SYMBOLS) + b"]")
_MEASURED = "doc_id long, part string, text_key binary, mask int"
_CHANGE = "part string, mask int, quality int, toxic int, n long"


def failing(text: bytes) -> int:
    """The mask of the filters A to D that a whole text fails."""
    words = text.split()  # bytes split at blank and \t\n\v\f\r
    capitals = len(text.translate(None, _NOT_CAPITALS))
    points = len(text) - sum(text.count(bytes((b,))) for b in range(0x80, 0xC0)) if not text.isascii() else len(text)
    mask = 1 if len(words) < LEAST_WORDS else 0
    mask |= 2 if 100 * len(set(words)) < DISTINCT_PERCENT * len(words) else 0
    mask |= 4 if 100 * capitals > CAPITAL_PERCENT * points else 0
    return mask | (8 if _SYMBOL.search(text) else 0)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = encoded(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
             pa.array([failing(t) for t in texts], pa.int32())], names=["doc_id", "part", "text_key", "mask"])


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal texts as one: the least id, the rows that hold it and the rows above."""
    held: dict = {}

    def given():
        keys = list(held)
        kind = pa.list_(pa.struct([("part", pa.string()), ("quality", pa.int32()), ("toxic", pa.int32()), ("n", pa.int64())]))

        def rows(at):
            return pa.array([[dict(zip(("part", "quality", "toxic", "n"), (*who, n))) for who, n in held[k][at].items()] for k in keys], kind)

        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.binary()), pa.array([held[k][0] or 0 for k in keys], pa.int64()), pa.array([not k[1] for k in keys]),
             pa.array([held[k][3] for k in keys], pa.int32()), rows(1), rows(2)], names=["text_key", "doc_id", "named", "mask", "least", "above"])

    for batch in batches:
        for doc_id, part, key, mask, quality, toxic in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "text_key", "mask", "quality", "toxic"))):
            who, at = (part, quality, toxic), (key, doc_id is None)  # null ids stand by themselves
            have = held.get(at)
            if have is None:
                held[at] = [doc_id, {who: 1}, {}, mask]
                continue
            if have[0] != doc_id and doc_id < have[0]:
                for w, n in have[1].items():
                    have[2][w] = have[2].get(w, 0) + n
                have[0], have[1] = doc_id, {}
            side = have[1] if have[0] == doc_id else have[2]
            side[who] = side.get(who, 0) + 1
        if len(held) >= HELD:
            yield given()
            held.clear()
    if held:
        yield given()


def _update(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The changes of the part counters that the new rows of a bucket of texts make. The state
    is a dictionary: text -> (least id, {(part, quality, toxic): rows that hold it})."""
    change: dict = defaultdict(int)
    texts = pickle.loads(state.get[0]) if state.exists else {}
    for frame in rows:
        for text, doc_id, named, mask, new, above in zip(*(frame[c] for c in ("text_key", "doc_id", "named", "mask", "least", "above"))):
            text, doc_id, mask = bytes(text), int(doc_id), int(mask)
            who = {(r["part"], int(r["quality"]), int(r["toxic"])): int(r["n"]) for r in new}
            for r in above:
                change[r["part"], mask | E_BIT, int(r["quality"]), int(r["toxic"])] += int(r["n"])
            if not named:  # compared with nobody
                for w, n in who.items():
                    change[w[0], mask, w[1], w[2]] += n
                continue
            least, holders = texts.get(text, (doc_id, {}))
            if doc_id > least:
                for w, n in who.items():
                    change[w[0], mask | E_BIT, w[1], w[2]] += n
                continue
            if doc_id < least:  # retract the former holders
                for w, n in holders.items():
                    change[w[0], mask, w[1], w[2]] -= n
                    change[w[0], mask | E_BIT, w[1], w[2]] += n
                holders = {}
            for w, n in who.items():
                holders[w] = holders.get(w, 0) + n
                change[w[0], mask, w[1], w[2]] += n
            texts[text] = (doc_id, holders)
    state.update((pickle.dumps(texts, pickle.HIGHEST_PROTOCOL),))
    out = [(*w, n) for w, n in change.items() if n]
    if out:
        yield pd.DataFrame(out, columns=["part", "mask", "quality", "toxic", "n"])


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The changes of a task, one row per counter."""
    names = ["part", "mask", "quality", "toxic", "n"]
    total: dict = defaultdict(int)
    for batch in batches:
        for *who, n in zip(*(batch.column(c).to_pylist() for c in names)):
            total[tuple(who)] += n
    left = [(*w, n) for w, n in total.items() if n]
    if left:
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*left), kinds)], names=names)


def counters(spark: SparkSession, path: str, labels: DataFrame, part: str = "source", batches: int = 4) -> DataFrame:
    """(part, mask, quality, toxic, n) of the Parquet documents (doc_id, text, ``part``) at
    ``path``: how many fail exactly the filters of ``mask``. All files are read, in about
    ``batches`` micro-batches; each joins ``labels`` (doc_id, quality, toxic) anew, which is
    why their number does not grow with the input."""
    static = spark.read.parquet(path)
    files = max(1, -(-len(static.inputFiles()) // batches))
    path = path.rstrip("/")
    # as a pattern: a stream takes a plain path for a folder, and a table may be one file
    stream = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", files).parquet(f"{path[:-1]}[{path[-1]}]")
    narrow = stream.select(F.col("doc_id").cast("long"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col("text").cast("string"))
    measured = narrow.mapInArrow(_measure, _MEASURED)
    # null ids join nothing; a second key spreads them over the tasks
    spread = measured.withColumn("spread", F.when(F.col("doc_id").isNull(), F.xxhash64("text_key")).otherwise(F.lit(0).cast("long")))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("if(quality = 1, 1, 0)")).alias("quality"), F.max(F.expr("if(toxic = 1, 1, 0)")).alias("toxic")).withColumn("spread", F.lit(0).cast("long"))
    labelled = spread.join(known, ["doc_id", "spread"], "left").select(
        "doc_id", "part", "text_key", "mask", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("quality", "toxic")))
    who = "array<struct<part:string,quality:int,toxic:int,n:bigint>>"
    by_text = labelled.mapInArrow(_add_up, f"text_key binary, doc_id long, named boolean, mask int, least {who}, above {who}")
    bucket = F.pmod(F.xxhash64("text_key"), F.lit(max(1, static.count() // BUCKET)))
    changes = by_text.withColumn("bucket", bucket).groupBy("bucket").applyInPandasWithState(_update, _CHANGE, "texts binary", "append", GroupStateTimeout.NoTimeout)
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/audit-{uuid.uuid4().hex}"
    query = changes.mapInArrow(_sum_up, _CHANGE).writeStream.format("parquet").option("path", f"{base}/changes").option(
        "checkpointLocation", f"{base}/stream").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    written = spark.read.schema(_CHANGE).parquet(f"{base}/changes")
    return written.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n")).where("n <> 0")


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it)."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, f in enumerate(order, 1):
            bit = 1 << FILTERS.index(f)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """600 rows of a part from its counters by mask."""
    steps, masks = orders(), np.arange(1 << len(FILTERS))
    bit, before = (np.array([s[i] for s in steps])[:, None] for i in (2, 3))
    fails, gone = (masks & bit) > 0, (masks & before) > 0
    share = [0, *(len(steps) // len(FILTERS) // k for k in range(1, len(FILTERS) + 1))]  # a mask of k filters is each one's in 120 / k orders
    weight = np.array([share[m.bit_count()] for m in masks.tolist()])
    for batch in batches:
        for part, n, good, toxic in zip(*(batch.column(c).to_pylist() for c in ("part", "n", "good", "toxic"))):
            n, good, toxic = (np.array(x, dtype=np.int64) for x in (n, good, toxic))
            first = fails & ~gone
            columns = [(~fails & ~gone) @ n, first @ n, (fails & gone) @ n, (masks == bit) @ n, first @ good, first @ toxic, fails @ (n * weight)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(steps)), pa.array([s[0] for s in steps]), pa.array([s[1] for s in steps], pa.int32()), *(pa.array(c, pa.int64()) for c in columns)],
                names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])


def interactions(counted: DataFrame) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, from the counters."""
    def by_mask(value):
        return F.array(*[F.sum(F.when(F.col("mask") == m, value).otherwise(0)) for m in range(1 << len(FILTERS))])

    n = F.col("n")
    parts = counted.groupBy("part").agg(by_mask(n).alias("n"), by_mask(F.when(F.col("quality") == 1, n).otherwise(0)).alias("good"),
                                        by_mask(F.when(F.col("toxic") == 1, n).otherwise(0)).alias("toxic"))
    return parts.mapInArrow(_unfold, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
                                     "good_lost long, toxic_lost long, shapley long")


def audit(spark: SparkSession, path: str, labels: DataFrame, part: str = "source", batches: int = 4) -> DataFrame:
    """The whole audit of the Parquet documents at ``path``."""
    return interactions(staged(counters(spark, path, labels, part, batches)))


def oracle() -> str:
    """DuckDB SQL for ``audit`` of documents by source."""
    letters = ", ".join(f"'{f}'" for f in FILTERS)
    names = "abcde"
    word = r"[^\x20\x09-\x0D]+"
    return f"""
WITH l AS (SELECT doc_id, max(coalesce(CAST(quality = 1 AS INT), 0)) AS good, max(coalesce(CAST(toxic = 1 AS INT), 0)) AS bad FROM labels GROUP BY doc_id),
 t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{word}') AS w FROM documents),
 m AS (SELECT t.doc_id, t.part, coalesce(l.good, 0) AS good, coalesce(l.bad, 0) AS bad,
   CAST(len(w) < {LEAST_WORDS} AS INT) + 2 * CAST(100 * len(list_distinct(w)) < {DISTINCT_PERCENT} * len(w) AS INT)
   + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text) AS INT)
   + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT) + {E_BIT} * CAST(coalesce(min(t.doc_id) OVER (PARTITION BY text) < t.doc_id, false) AS INT) AS mask
   FROM t LEFT JOIN l ON l.doc_id = t.doc_id),
 c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY part, mask),
 f AS (SELECT unnest([{letters}]) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
 o AS (SELECT {" || ".join(f"{x}.f" for x in names)} AS filter_order, [{", ".join(f"{x}.bit" for x in names)}] AS bits
       FROM f a, f b, f c, f d, f e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
 s AS (SELECT filter_order, CAST(i AS INTEGER) AS step, bits[i] AS bit, CAST(list_sum(bits[1:i]) - bits[i] AS INTEGER) AS before FROM o, range(1, 6) r(i)),
 r AS (SELECT part, filter_order, step, bit,
   sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
   sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
   sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN bad ELSE 0 END) AS toxic_lost
   FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""
