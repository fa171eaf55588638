"""Language identification in two levels: the family first, then one-versus-one linear
support vector machines between the languages of that family.

Features are relative frequencies of hashed byte trigrams of the lower-cased text, letters
only (all else is a blank), over the whole text. A prediction is a table lookup and a sum
per trigram, so long texts stream through numpy in blocks; nothing but the text enters it.

The classifier is fitted on at most ``max_rows`` labelled rows, equally many of each
language where there are enough and one of each at least, chosen by a hash of the id; more
languages than rows raise an error. Only their sparse trigram counts reach the driver. Families one against the rest, then every pair inside a family, by
stochastic subgradient steps on the hinge loss in a fixed order: refits agree.

Defined results: null text or no letter: ``und``, score 0; no labelled row at all: ``und``
for every text; a language code without a known family belongs to ``other``; of languages or
families that tie, the first in alphabetical order is predicted. The result columns take
fresh names where the caller says so; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regispark._util import fresh
from regispark.llm.common import blocks, slices, strings

#: Language families by ISO 639-1 code.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nl", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "ky", "tr", "tt", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
    "semitic": ["am", "ar", "he", "mt"],
}
BITS = 12
#: ASCII other than letters is blank; bytes of non-ASCII characters count as letters.
_LETTERS = bytes(c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def family(lang: str) -> str:
    return next((f for f, langs in FAMILIES.items() if lang in langs), "other")


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of a block and the range of each text (every text has at least one)."""
    parts = [b" " + t.lower().encode("utf-8", "surrogatepass").translate(_LETTERS) + b"  " for t in texts]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    gram = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    size = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    start = np.cumsum(size) - size
    return gram.astype(np.int32), start, start + size - 2


def _counter():
    """(lang, grams, counts) of each labelled row, as packed 16-bit indices and 32-bit counts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            texts = strings(batch)
            for lo, hi in blocks(texts):
                gram, start, end = _grams(texts[lo:hi])
                out += [np.unique(gram[s:e], return_counts=True) for s, e in zip(start, end)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array([g.astype(np.uint16).tobytes() for g, _ in out], pa.binary()),
                 pa.array([c.astype(np.float32).tobytes() for _, c in out], pa.binary())], names=["lang", "grams", "counts"])

    return count


def svm(x: np.ndarray, rows: np.ndarray, y: np.ndarray, epochs: int = 20, penalty: float = 1e-4, seed: int = 5) -> tuple[np.ndarray, float]:
    """A linear support vector machine (weights, bias) for labels -1 and 1 of some rows, both
    classes weighing the same, by mini-batch subgradient steps with averaging of the last half."""
    rng = np.random.default_rng(seed)
    share = np.where(y > 0, 0.5 / max((y > 0).mean(), 1e-9), 0.5 / max((y < 0).mean(), 1e-9))
    w, b, mean_w, mean_b, kept, t = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0, 0, 0
    steps = epochs * -(-len(y) // 64)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            i, t = order[lo : lo + 64], t + 1
            part = x[rows[i]]
            wrong = y[i] * (part @ w + b) < 1
            rate = 1.0 / (penalty * (t + 1000))
            g = (share[i] * y[i])[wrong]
            w = (1 - rate * penalty) * w + rate / len(i) * (g @ part[wrong])
            b += rate / len(i) * 0.01 * g.sum()
            if t > steps // 2:
                mean_w, mean_b, kept = mean_w + w, mean_b + b, kept + 1
    return mean_w / max(kept, 1), mean_b / max(kept, 1)


class Model:
    """The fitted machines: one column of ``weights`` each, over trigram frequencies."""

    def __init__(self, langs: list[str], x: np.ndarray, label: np.ndarray):
        """``x``: a row of trigram frequencies for each label; it is scaled in place."""
        self.langs = langs
        fams = sorted({family(c) for c in langs})
        self.families = [[i for i, c in enumerate(langs) if family(c) == f] for f in fams]
        scale = 1.0 / np.sqrt(x.mean(axis=0) + np.float32(1e-5)) if len(x) else np.ones(1 << BITS)
        x *= scale
        machines = []
        if len(fams) > 1:
            everyone = np.arange(len(x))
            machines += [svm(x, everyone, np.where(np.isin(label, members), 1.0, -1.0)) for members in self.families]
        self.pairs = [list(combinations(members, 2)) for members in self.families]
        for i, j in (p for pairs in self.pairs for p in pairs):
            rows = np.flatnonzero((label == i) | (label == j))
            machines.append(svm(x, rows, np.where(label[rows] == i, 1.0, -1.0)))
        self.weights = np.array([w * scale for w, _ in machines]).T.reshape(1 << BITS, len(machines)).copy()
        self.bias = np.array([b for _, b in machines])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        gram, start, end = _grams(texts)
        n = len(texts)
        margin = np.zeros((n, len(self.bias)))
        if len(self.bias):
            cuts = np.stack([start, end], axis=1).reshape(-1)[: 2 * n - 1]
            for m in range(len(self.bias)):
                margin[:, m] = np.add.reduceat(self.weights[:, m][gram], cuts)[::2] / (end - start) + self.bias[m]
        many = len(self.families) > 1
        fam = margin[:, : len(self.families)].argmax(axis=1) if many else np.zeros(n, dtype=int)
        sure = 1 / (1 + np.exp(-2 * np.clip(margin, -30, 30)))
        lang, score = np.zeros(n, dtype=int), np.ones(n)
        at = len(self.families) if many else 0
        for f, (members, pairs) in enumerate(zip(self.families, self.pairs)):
            rows = np.flatnonzero(fam == f)
            place = {c: k for k, c in enumerate(members)}
            votes, belief = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for k, (i, j) in enumerate(pairs):
                p = sure[rows, at + k]
                votes[:, place[i]] += p >= 0.5
                votes[:, place[j]] += p < 0.5
                belief[:, place[i]] += p
                belief[:, place[j]] += 1 - p
            at += len(pairs)
            best = (votes + belief / (len(members) + 1)).argmax(axis=1)
            lang[rows] = np.array(members)[best]
            if pairs:
                score[rows] = belief[np.arange(len(rows)), best] / (len(members) - 1)
            if many:
                score[rows] *= sure[rows, f]
        return [self.langs[i] for i in lang], score


def fit(labelled: DataFrame, max_rows: int = 2000) -> Model:
    """A model of ``labelled`` (doc_id, text, lang), fitted on at most ``max_rows`` rows, of
    every language that has a text with a letter."""
    labelled = labelled.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    labelled = labelled.where("lang is not null").where(F.col("text").rlike(r"\p{L}"))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min(draw).alias("least")).limit(max_rows + 1).collect()
    if not counts:
        return Model([], np.zeros((0, 1 << BITS)), np.zeros(0, dtype=int))
    if len(counts) > max_rows:
        raise ValueError(f"more than max_rows = {max_rows} languages")
    share = max(1, max_rows // len(counts))
    cuts = [(r["lang"], r["least"], max(r["least"], int((1 << 30) * min(1.0, share / r["count"])))) for r in counts]
    table = F.broadcast(labelled.sparkSession.createDataFrame(cuts, "of string, least long, cut long"))
    drawn = labelled.join(table, F.col("lang") == F.col("of")).withColumn("draw", draw).where("draw <= cut")
    # the first of each language, then by the share of its language's draws that comes before
    sample = drawn.orderBy(F.when(F.col("draw") == F.col("least"), -1.0).otherwise(F.col("draw") / F.col("cut")), "draw", "doc_id", "text").limit(max_rows)
    rows = sample.select("lang", "text").mapInArrow(_counter(), "lang string, grams binary, counts binary").collect()
    langs = sorted({r["lang"] for r in rows})
    x = np.zeros((len(rows), 1 << BITS), dtype=np.float32)
    for i, r in enumerate(rows):
        n = np.frombuffer(r["counts"], dtype=np.float32)
        x[i, np.frombuffer(r["grams"], dtype=np.uint16)] = n / n.sum()
    return Model(langs, x, np.array([langs.index(r["lang"]) for r in rows], dtype=int))


def identify(docs: DataFrame, model: Model, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows and columns of ``docs`` with the predicted language and its score (0 to 1) as
    columns of these names; columns that had them are replaced."""
    docs = docs.drop(lang_pred, score)
    lettered = fresh(docs.columns, "lettered")
    work = docs.withColumn(lettered, F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [*docs.columns, lang_pred, score]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = strings(batch)
            lang, sure = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            rows = np.flatnonzero(np.array(batch.column(batch.num_columns - 1).to_pylist(), dtype=bool))
            for lo, hi in blocks([texts[i] for i in rows]):
                part = rows[lo:hi]
                lang[part], sure[part] = shared.value.predict([texts[i] for i in part])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lang.tolist(), pa.string()), pa.array(sure)], names=names)

    schema = docs.withColumns({lang_pred: F.lit("").cast("string"), score: F.lit(0.0)}).schema
    return work.mapInArrow(apply, schema)


def held_out(doc_id: str = "doc_id"):
    """The fold of the contract: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), learned from the rows that are not held out."""
    model = fit(docs.where("doc_id is not null").where(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), model).drop("text")
