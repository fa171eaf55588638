"""Vector code compression: product codes whose codebooks are fitted by Ball k-means.

Components become integers floor(1024 * x); vectors are cut into ``parts`` equal consecutive
parts, and each part position has a codebook of at most ``entries`` entries, which start as
that part of the vectors with the smallest ids. A round assigns every part to the nearest
entry (squared Euclidean distance, ties to the lower index) and then moves each entry to the
componentwise floor of the mean of its parts; unused entries stay. After the last round parts
are assigned once more.

The first round measures all entries. From then on every entry is a ball: its centre, and as
radius the farthest of its parts plus the way the centre has moved since. With D the squared
distance of two centres and R the squared radius,

- the neighbours of a ball are the entries with D <= 4 R: no other can win one of its parts;
- a part nearer to its centre than half the way to the nearest neighbour lies in the stable
  core and is passed over;
- any other part lies in a ring between the halves of two neighbours' distances, and only the
  neighbours up to its ring (D <= 4 * its own squared distance) are measured.

All of this is exact in integers, so the codes are those of a full search. A round is one
pass over the vectors, which writes them with their codes and one row of sums per task; only
those sums (at most parts x entries rows) reach the driver, whose codebooks go back in the
tasks' closures (parts x entries x width numbers, whatever the number of vectors).

Defined results: vectors that are null or hold null or non-finite components are dropped; a
null id is encoded and counts as the largest; rows of one id are separate vectors, ordered by
their components; a shorter vector is filled up with 0 to the longest one's length, itself
rounded up to a multiple of ``parts``; with fewer than ``entries`` vectors there are as many
entries; an empty table gives no rows. Components so large that a squared distance might not
fit a long raise an error. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regispark.llm.common import staged

#: Vectors a worker holds at a time.
BLOCK = 16_384
#: Label sums up to this many are broadcast (about 1 MB); more are joined by shuffle.
BROADCAST_LABELS = 50_000

_SUMS = "sums array<struct<slot:int,n:bigint,far:bigint,total:array<bigint>>>"
_STATE = f"vec_id long, label string, v array<long>, codes array<int>, dist array<long>, {_SUMS}"


def as_integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v) of the vectors that take part; ``label`` as text."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    whole = F.transform(x, lambda e: F.when(F.abs(e) < float(1 << 40), F.floor(e * 1024)).otherwise(
        F.raise_error(F.lit("a component is too large: its squared distances do not fit a long")).cast("long")))
    return vectors.where(F.col("embedding").isNotNull()).where(good).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), whole.alias("v"))


class Balls:
    """The codebook of one part position, as balls with sorted neighbours."""

    def __init__(self, centres: np.ndarray, radius: np.ndarray | None = None):
        self.centres = centres
        if radius is None:  # no parts assigned yet
            self.near = None
            return
        square = (centres * centres).sum(axis=1)
        apart = square[:, None] + square[None, :] - 2 * (centres @ centres.T)
        self.near, self.apart = [], []
        for i in range(len(centres)):
            others = np.flatnonzero(apart[i] <= 4 * radius[i])
            others = others[others != i]
            order = others[np.argsort(apart[i, others], kind="stable")]
            self.near.append(order)
            self.apart.append(apart[i, order])
        self.core = np.array([a[0] if len(a) else np.inf for a in self.apart])

    def nearest(self, x: np.ndarray, codes: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """(code, squared distance) of each row, from the codes it had."""
        if codes is None or self.near is None:
            square = (self.centres * self.centres).sum(axis=1)
            code, dist = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=x.dtype)
            for lo in range(0, len(x), 2048):
                y = x[lo : lo + 2048]
                d = square[None, :] - 2 * (y @ self.centres.T)
                code[lo : lo + 2048] = d.argmin(axis=1)  # the first, so the lower index
                dist[lo : lo + 2048] = d.min(axis=1) + (y * y).sum(axis=1)
            return code, dist
        code = codes.copy()
        away = x - self.centres[codes]
        dist = (away * away).sum(axis=1)
        restless = np.flatnonzero(4 * dist >= self.core[codes])
        restless = restless[np.argsort(codes[restless], kind="stable")]
        edges = np.flatnonzero(np.diff(codes[restless])) + 1
        for members in np.split(restless, edges):
            if len(members):
                self._rings(x, members, code, dist)
        return code, dist

    def _rings(self, x: np.ndarray, members: np.ndarray, code: np.ndarray, dist: np.ndarray) -> None:
        """Settle ``members``, parts of one ball outside its core, ring by ring; rings of one
        to two, two to four, ... neighbours are taken together, to be few."""
        ball = code[members[0]]
        near, apart = self.near[ball], self.apart[ball]
        ring = np.searchsorted(apart, 4 * dist[members], side="right")
        step = np.ceil(np.log2(ring)).astype(np.int64)
        for s in np.unique(step):
            rows = members[step == s]
            among = near[: ring[step == s].max()]
            y = x[rows]
            c = self.centres[among]
            d = (c * c).sum(axis=1)[None, :] - 2 * (y @ c.T) + (y * y).sum(axis=1)[:, None]
            least = d.min(axis=1)
            who = np.where(d == least[:, None], among[None, :], len(self.centres)).min(axis=1)
            better = (least < dist[rows]) | ((least == dist[rows]) & (who < ball))
            code[rows[better]], dist[rows[better]] = who[better], least[better]


def _matrix(column: pa.Array, dims: int, dtype) -> np.ndarray:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(len(sizes), dims).astype(dtype)
    out = np.zeros((len(sizes), dims), dtype=dtype)
    out[np.arange(dims)[None, :] < sizes[:, None]] = flat
    return out


def _assigner(books: list[Balls], dims: int, dtype):
    """One pass: every vector with its codes and distances, then a row with the task's sums."""
    parts = len(books)
    width = dims // parts
    state = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int64())), ("codes", pa.list_(pa.int32())),
                       ("dist", pa.list_(pa.int64())), ("sums", pa.list_(pa.struct([
                           ("slot", pa.int32()), ("n", pa.int64()), ("far", pa.int64()), ("total", pa.list_(pa.int64()))])))])

    def lists(rows: np.ndarray, kind) -> pa.ListArray:
        offsets = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.reshape(-1), type=kind))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = max(len(b.centres) for b in books)
        n = np.zeros(parts * k, dtype=np.int64)
        far = np.zeros(parts * k, dtype=np.int64)
        total = np.zeros((parts * k, width), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                rows = batch.slice(at, BLOCK)
                x = _matrix(rows.column("v"), dims, dtype)
                old = None
                if "codes" in rows.schema.names:
                    old = rows.column("codes").flatten().to_numpy(zero_copy_only=False).reshape(-1, parts).astype(np.int64)
                codes, dist = np.zeros((len(x), parts), dtype=np.int32), np.zeros((len(x), parts), dtype=np.int64)
                for p, book in enumerate(books):
                    y = x[:, p * width : (p + 1) * width]
                    code, d = book.nearest(y, None if old is None else old[:, p])
                    codes[:, p], dist[:, p] = code, d
                    slot = p * k + code
                    n += np.bincount(slot, minlength=parts * k)
                    np.maximum.at(far, slot, dist[:, p])
                    np.add.at(total, slot, y.astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"), lists(x.astype(np.int64), pa.int64()), lists(codes, pa.int32()),
                     lists(dist, pa.int64()), pa.nulls(len(x), state.field("sums").type)], schema=state)
        used = np.flatnonzero(n)
        if len(used):
            sums = [{"slot": int(s), "n": int(n[s]), "far": int(far[s]), "total": total[s].tolist()} for s in used]
            yield pa.RecordBatch.from_pydict({"vec_id": [None], "label": [None], "v": [None], "codes": [None], "dist": [None], "sums": [sums]}, schema=state)

    return assign


def _summed(state: DataFrame, width: int) -> list:
    """One row per used entry: what the tasks counted, added up. Only ``sums`` is read."""
    s = state.where("sums is not null").select(F.explode("sums").alias("s")).select("s.*")
    totals = [F.sum(F.col("total")[i]).alias(f"t{i}") for i in range(width)]
    return s.groupBy("slot").agg(F.sum("n").alias("n"), F.max("far").alias("far"), *totals).collect()


def _moved(books: list[np.ndarray], sums: list, k: int, dtype) -> tuple[list[np.ndarray], list[Balls]]:
    """The next entries and their balls, from the sums of a round."""
    fresh = [b.copy() for b in books]
    radius = [np.zeros(len(b)) for b in books]
    for row in sums:
        p, e = divmod(row["slot"], k)
        fresh[p][e] = [row[f"t{i}"] // row["n"] for i in range(fresh[p].shape[1])]
        radius[p][e] = np.sqrt(float(row["far"]))
    balls = []
    for p, (old, new) in enumerate(zip(books, fresh)):
        way = np.sqrt(((new - old).astype(float) ** 2).sum(axis=1))
        balls.append(Balls(new.astype(dtype), (radius[p] + way) ** 2 * (1 + 1e-9) + 1))
    return fresh, balls


def encode(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, list[np.ndarray]]:
    """``vectors`` (vec_id, embedding, label) encoded: (vec_id, label, codes, dist), one code
    and squared distance per part position, and the final codebooks."""
    whole = as_integers(vectors)
    size, low, high = whole.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    dims = -(-(size or 0) // parts) * parts
    if not dims:  # no vector, or none with a component
        zero = F.array(*[F.lit(0)] * parts)
        return whole.select("vec_id", "label", zero.alias("codes"), zero.cast("array<long>").alias("dist")), [np.zeros((0, 0), dtype=np.int64)] * parts
    reach = (dims // parts) * (2 * max(abs(low), abs(high), 1)) ** 2 * 4
    if reach >= 1 << 62:
        raise ValueError("components are too large: their squared distances do not fit a long")
    dtype = np.float64 if reach < 1 << 53 else np.int64  # both exact
    first = whole.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").toArrow().combine_chunks()
    column = first.column("v")
    start = _matrix(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, dims, np.int64)
    width, k = dims // parts, len(start)
    books = [start[:, p * width : (p + 1) * width] for p in range(parts)]
    balls = [Balls(b.astype(dtype)) for b in books]
    state = whole
    for _ in range(rounds):
        state = staged(state.mapInArrow(_assigner(balls, dims, dtype), _STATE))
        books, balls = _moved(books, _summed(state, width), k, dtype)
        state = state.where("sums is null").select("vec_id", "label", "v", "codes")
    state = staged(state.mapInArrow(_assigner(balls, dims, dtype), _STATE).where("sums is null").select("vec_id", "label", "codes", "dist"))
    return state, books


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components, by part, entry and position, joined with commas."""
    return hashlib.sha256(",".join(str(int(x)) for b in books for x in b.reshape(-1)).encode()).hexdigest()


def vector_codes(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): two hexadecimal digits per part."""
    if entries > 256:
        raise ValueError("two hexadecimal digits hold 256 entries")
    state, books = encode(vectors, parts, entries, rounds)
    pair = F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0")))
    rows = state.select("vec_id", "label", F.concat_ws("", pair).alias("code"),
                        F.aggregate("dist", F.lit(0).cast("long"), lambda a, d: a + d).alias("error"))
    by_label = staged(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    small = F.broadcast(by_label) if by_label.count() <= BROADCAST_LABELS else by_label
    return rows.join(small, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def oracle(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """DuckDB SQL for ``vector_codes``: every part against every entry, round by round."""
    def nearest(book):
        return f"""SELECT p.row, p.part, min({{'d': p.sq + e.sq - 2 * list_inner_product(p.x, e.x), 'i': e.i}}) AS best
                   FROM parts p JOIN {book} e ON e.part = p.part GROUP BY p.row, p.part"""

    steps = []
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({nearest(f'b{r}')})")
        steps.append(f"""c{r} AS (SELECT part, i, pos, floor(sum(x) / count(*)) AS x FROM (
            SELECT p.part, a.best.i AS i, unnest(p.x) AS x, generate_subscripts(p.x, 1) AS pos FROM parts p JOIN a{r} a ON a.row = p.row AND a.part = p.part) GROUP BY ALL)""")
        steps.append(f"""b{r + 1} AS MATERIALIZED (SELECT part, i, x, list_inner_product(x, x) AS sq FROM (
            SELECT b.part, b.i, coalesce(n.x, b.x) AS x FROM b{r} b LEFT JOIN (SELECT part, i, list(x ORDER BY pos) AS x FROM c{r} GROUP BY part, i) n
            ON n.part = b.part AND n.i = b.i))""")
    return f"""
WITH v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
 parts AS MATERIALIZED (SELECT row, part, x, list_inner_product(x, x) AS sq FROM (
    SELECT row, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x FROM v, range({parts}) t(part))),
 b0 AS MATERIALIZED (SELECT part, row - 1 AS i, x, sq FROM parts WHERE row <= {entries}),
 {", ".join(steps)},
 a AS ({nearest(f'b{rounds}')}),
 coded AS (SELECT v.vec_id, v.label, string_agg(lower(lpad(to_hex(a.best.i), 2, '0')), '' ORDER BY a.part) AS code, CAST(sum(a.best.d) AS BIGINT) AS error
           FROM v JOIN a ON a.row = v.row GROUP BY v.row, v.vec_id, v.label),
 whole AS (SELECT sha256(string_agg(CAST(CAST(x AS BIGINT) AS VARCHAR), ',' ORDER BY part, i, pos)) AS h FROM (
    SELECT part, i, unnest(x) AS x, generate_subscripts(x, 1) AS pos FROM b{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, whole"""
