"""Secret scans: candidates by pattern, then a random forest that removes false positives.

Candidates are long runs of key characters, values assigned to a name such as ``password``,
quoted or not, and private keys from their header to their end (without one: to the last line
of key characters). A run is cut where such a value or key begins in it. The forest judges each by its length,
character transitions (how unlike the letters of ordinary words they follow each other),
dictionary coverage (the share of it that ordinary words cover), the path it was found
under and the words next to it. It is Spark ML's random forest, trained on labelled findings;
its trees are read from the saved model and walked inside the scan, so texts are read once and
never shuffled.

Labelled findings are a table (value, before, after, path, label) of the caller's, or the
default ones below: made by rule from published credential shapes against look-alikes
(checksums, commit and object ids, card and phone numbers, addresses, placeholders, words).
The forest is fitted on every one of them; their features are computed in tasks.
Transitions are counted over every word of all documents, and the dictionary is the most
frequent of them by exact counts; its size is a parameter of the classifier, since in the
whole vocabulary the letters of every secret would be words. Only the counts of character
pairs and the dictionary reach the driver.

Defined results: null or empty texts hold nothing; offsets are code points; overlapping
candidates are one finding, the first and longest; a text is read whole.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from regispark._util import fresh
from regispark.llm.common import slices, staged, strings
from regispark.session import ensure_checkpoint_dir

#: Words that name a secret, or say that a value is none.
NAMES = ["access_key", "apikey", "api_key", "auth", "bearer", "credential", "key", "passwd", "password", "private", "pwd", "secret", "token"]
DECOYS = ["blob", "checksum", "commit", "digest", "dummy", "etag", "example", "fingerprint", "hash", "md5", "object", "order", "placeholder", "request", "revision", "sha", "trace", "uuid"]
PATHS = ["doc", "example", "fixture", "mock", "sample", "test"]
PLAIN = ["required", "optional", "default", "string", "invalid", "missing", "expired", "changed", "disabled", "unknown", "undefined", "incorrect", "generated", "stored", "rotated"]
PREFIXES = ["AKIA", "ASIA", "AIza", "eyJ", "ghp_", "gho_", "glpat-", "hf_", "sk-", "sk_live_", "xoxb-", "xoxp-"]

#: Labelled findings that one task of the forest's fit holds.
FIT_ROWS = 20_000

_RUN = re.compile(r"(?<![A-Za-z0-9+/_=\-])[A-Za-z0-9+/_=\-]{16,}")
_ASSIGNED = re.compile(r"""(?i)(?:passwd|password|pwd|secret|token|api_?key|access_?key)["']?\s*[:=]\s*["']([^"'\s]{6,})["']""")
_UNQUOTED = re.compile(r"""(?i)(?:passwd|password|pwd|secret|token|api_?key|access_?key)["']?[ \t]*(?::=|=>|={1,3}|:)[ \t]*([^"'\s]{6,})""")
_NEXT_PARAMETER = re.compile(r"&\w+=")
_MARK = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]{0,30}PRIVATE KEY(?: BLOCK)?-----")
_KEY_LINES = re.compile(r"""(?:(?:\\[nr]|[\s"'+,])*[A-Za-z0-9+/]{16,}={0,2})*""")
_NAMED = re.compile(r"(?i)passw|pwd|secret|token|api_?key|access_?key")
_WORD = re.compile(r"[A-Za-z_]{2,}")
_ALNUM = re.compile(r"[A-Za-z0-9]")
_LETTERS = re.compile(r"[^\W\d_]{3,}")


def candidates(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind), by position, overlaps joined into the first and longest."""
    marked = []
    if _NAMED.search(text):
        marked += [(*m.span(1), "assigned") for m in _ASSIGNED.finditer(text)]
        for m in _UNQUOTED.finditer(text):
            value = _NEXT_PARAMETER.split(m.group(1), maxsplit=1)[0].rstrip(",;.)]}>")
            if len(value) >= 6:
                marked.append((m.start(1), m.start(1) + len(value), "assigned"))
    if "PRIVATE KEY" in text:
        marks = list(_MARK.finditer(text))
        for m, after in zip(marks, [*marks[1:], None]):
            if m.group(1) == "BEGIN":
                ended = after is not None and after.group(1) == "END"
                marked.append((m.start(), after.end() if ended else _KEY_LINES.match(text, m.end()).end(), "header"))
    begins, out = sorted(c[0] for c in marked), []
    for m in _RUN.finditer(text):
        start, end = m.span()
        i = bisect_right(begins, start)
        end = min([end, *begins[i : i + 1]])
        if end - start >= 16 and _ALNUM.search(text, start, end):
            out.append((start, end, "run"))
    out += marked
    out.sort(key=lambda c: (c[0], -c[1]))
    kept: list[tuple[int, int, str]] = []
    for c in out:
        if not kept or c[0] >= kept[-1][1]:
            kept.append(c)
    return kept


class Language:
    """Character transitions, from the counts of ``transitions_of``, and a dictionary."""

    def __init__(self, pairs: np.ndarray, dictionary: list[str]):
        counts = 1.0 + pairs
        self.surprise = -np.log2(counts / counts.sum(axis=1, keepdims=True))
        self.known = set(dictionary)

    def transitions(self, value: str) -> float:
        codes = np.minimum(np.frombuffer(f" {value.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32), 127)
        return float(self.surprise[codes[:-1], codes[1:]].mean())

    def coverage(self, value: str) -> float:
        """The share of the value that dictionary words of 3 to 12 letters cover, longest first."""
        low, covered = value.lower(), 0
        for run in _LETTERS.finditer(low):  # words are letters
            at, end = run.span()
            while at < end:
                n = next((n for n in range(min(12, end - at), 2, -1) if low[at : at + n] in self.known), 0)
                covered, at = covered + n, at + max(n, 1)
        return covered / max(len(low), 1)


FEATURES = ["length", "transitions", "coverage", "entropy", "digits", "upper", "symbols", "hex", "prefix", "named", "decoy", "path", "kind", "assigned"]


def features(language: Language, value: str, before: str, after: str, path: str, kind: str) -> list[float]:
    n = max(len(value), 1)
    counts = Counter(value)
    near = [w.lower() for w in _WORD.findall(before)[-4:]]
    near += [w.lower() for w in _WORD.findall(after)[:2]]
    path = path.lower()
    return [
        float(len(value)), language.transitions(value), language.coverage(value),
        -sum(c / n * math.log2(c / n) for c in counts.values()),
        sum(c.isdigit() for c in value) / n, sum(c.isupper() for c in value) / n, sum(not c.isalnum() for c in value) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in value)), float(any(value.startswith(p) for p in PREFIXES)),
        float(any(name in w for w in near for name in NAMES)), float(any(d in w for w in near for d in DECOYS)),
        float(any(p in path for p in PATHS)), float(["run", "assigned", "header"].index(kind)),
        float(bool(re.search(r"[:=]\s*[\"']?$", before)))]


def context(text: str, start: int, end: int) -> tuple[str, str, str]:
    return text[start:end], text[max(0, start - 60) : start], text[end : end + 30]


def default_findings(rows: int = 3000, seed: int = 3, ordinary: list[str] | None = None) -> list[tuple[str, str, str, str, int]]:
    """(value, before, after, path, label): published credential shapes and look-alikes, then half
    as many of private keys, unquoted values and runs of letters against placeholders, references
    and ``ordinary`` words."""
    rng = np.random.default_rng(seed)
    lower, digits = "abcdefghijklmnopqrstuvwxyz", "0123456789"
    alnum = lower + lower.upper() + digits

    def draw(alphabet, n):
        return "".join(alphabet[i] for i in rng.integers(0, len(alphabet), n))

    def pick(options):
        return options[int(rng.integers(0, len(options)))]

    def words(n):
        return " ".join(draw(lower, int(rng.integers(2, 9))) for _ in range(n))

    out = []
    for i in range(rows):
        path, quote = pick(["src/app.py", "web/main.js", "conf/settings.yml", "notes", "src3", "src17"]), pick(['"', "'", '"'])
        name, sign, glue = pick(NAMES), pick([" = ", "=", ": "]), pick(["", "", "_id", "_value"])
        value = [draw("0123456789abcdef", int(pick([32, 40, 40, 64]))), draw(alnum, int(rng.integers(16, 65))), pick(PREFIXES[:2]) + draw(lower.upper() + digits, 16),
                 pick(PREFIXES[2:]) + draw(alnum, 36), draw(alnum + "+/", 40), draw(alnum + "!#%&", int(rng.integers(8, 15)))][i // 2 % 6]
        if rng.random() < 0.2:
            name, value = name.upper(), value.upper()
        if i % 2:
            out.append((value, f"{words(4)} {name}{sign}{quote}", f"{quote} {words(2)}", path, 1))
            continue
        if rng.random() < 0.1:
            path = pick(["tests/fixtures/keys.py", "docs/example.md"])
        kind = i // 2 % 8
        hexes = draw("0123456789abcdef", int(pick([32, 40, 64])))
        value, before = [
            (hexes, f"{words(3)} {pick(DECOYS)} "), (hexes, f"{words(3)} {pick(DECOYS)}{sign}{quote}"), (draw(digits, int(rng.integers(16, 20))), words(5) + " "),
            (str(uuid.UUID(hexes[:32])), f"{words(3)} {pick(['uuid', 'request', 'trace'])} "), (f"{words(4).replace(' ', '-')}-{draw(digits, 3)}", words(4) + " "),
            (draw("x", 20) + draw(digits, 2), f"{words(2)} {name}{sign}{quote}"), (f"your_{words(2).replace(' ', '_')}_key_1{draw(digits, 1)}", f"{words(2)} {name}{sign}{quote}"),
            (f"{words(3).replace(' ', '/')}/{draw(digits, 4)}", words(4) + " ")][kind]
        out.append((value, before, f" {words(2)}", path, 0))
    letters, b64 = lower + lower.upper(), alnum + "+/"
    ordinary = [w for w in ordinary or PLAIN if len(w) >= 3] or PLAIN
    long = [w for w in ordinary if len(w) >= 6] or PLAIN
    for i in range(rows // 2):
        path = pick(["src/app.py", "web/main.js", "conf/settings.yml", ".env", "notes", "src3", "src17", ""])
        name, sign = pick(["password", "passwd", "pwd", "secret", "token", "api_key", "DB_PASSWORD", "API_KEY"]), pick(["=", "=", ": ", ": ", " = ", ":"])
        prose, secret, shape = " ".join(pick(ordinary) for _ in range(int(rng.integers(0, 6)))), i % 2, i // 2 % 3
        if shape == 0:  # private keys
            kind, cut = pick(["RSA ", "EC ", "", "OPENSSH ", "DSA ", "ENCRYPTED "]), pick(["\n", "\n", "\r\n", "\\n"])
            body = [draw(b64, 64) for _ in range(int(rng.integers(1, 40)))] + [draw(b64, int(rng.integers(16, 63))) + "="]
            ended = not secret or rng.random() < 0.6
            if not ended and rng.random() < 0.5:
                body = []  # the header alone; with a body the key is cut off
            if not secret:
                body = pick([["..."], ["your key here"], ["<private key>"], [draw("x", 64)] * int(rng.integers(1, 5)), ["[REDACTED]"], ["*" * 40],
                             [" ".join(pick(ordinary) for _ in range(int(rng.integers(3, 60))))]])
            value = cut.join([f"-----BEGIN {kind}PRIVATE KEY-----", *body, *([f"-----END {kind}PRIVATE KEY-----"] if ended else [])])
            before = pick(["", f"{prose}\n", f"{prose} {name}{sign}", f'{prose} {name}{sign}"'])
        elif shape == 1:  # unquoted values
            value = pick([draw(lower, int(rng.integers(4, 9))) + draw(digits, int(rng.integers(1, 5))), draw(alnum + "!#%@$", int(rng.integers(8, 17))), draw(alnum, int(rng.integers(16, 41))),
                          draw(letters, int(rng.integers(10, 41))), pick(long) + draw(digits, int(rng.integers(1, 4))) + pick(["", "!", "$"]), pick(ordinary).title() + draw("!@#$", 1) + draw(alnum, 5)])
            if not secret:
                value = pick([pick(long), pick(long), pick(long), pick(PLAIN), f"{pick(long)}-{pick(long)}", f"${{{name.upper()}}}", f"<{name}>", f"your_{name}_here", "os.environ[", f"self.{name}",
                              f"get_{pick(long)}()", f"config.{pick(long)}", "*" * 8, draw("x", 12), f"process.env.{name.upper()}",
                              f"${{{pick(ordinary).upper()}}}", f"${{{name.upper()}}}", f"${name.upper()}", f"${pick(long).upper()}", f"{{{{{name}}}}}", f"${{{pick(long)}}}"])
            before = f"{prose} {name}{sign}"
        else:  # runs of letters
            value, before = draw(letters, int(rng.integers(16, 65))), f"{prose} {name}{sign}{pick(['', chr(34)])}"
            if not secret:
                value = pick(["-".join, "_".join, "/".join, "".join, "=".join])([pick(long).title() if i % 4 else pick(long) for _ in range(int(rng.integers(3, 7)))])
                before = prose + " "
        out.append((value, before, pick(["", "\n", f" {pick(ordinary)}"]), path, secret))
    return out


class Forest:
    """The trees of a Spark ML forest as arrays: for each node the feature (-1: leaf), the
    threshold, both children and the leaf's share of label 1."""

    def __init__(self, rows):
        trees: dict[int, dict[int, object]] = {}
        for tree, node in rows:
            trees.setdefault(tree, {})[node["id"]] = node
        self.trees = []
        for nodes in trees.values():
            n = max(nodes) + 1
            feature, threshold, left, right, share = (np.full(n, -1), np.zeros(n), np.zeros(n, dtype=int), np.zeros(n, dtype=int), np.zeros(n))
            for i, x in nodes.items():
                stats = x["impurityStats"]
                share[i] = stats[1] / max(sum(stats), 1e-12) if len(stats) > 1 else 0.0
                if x["leftChild"] >= 0:
                    feature[i], threshold[i] = x["split"]["featureIndex"], x["split"]["leftCategoriesOrThreshold"][0]
                    left[i], right[i] = x["leftChild"], x["rightChild"]
            self.trees.append((feature, threshold, left, right, share))

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), dtype=int)
            while (inner := feature[at] >= 0).any():
                go = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                at = np.where(inner, np.where(go, left[at], right[at]), at)
            total += share[at]
        return total / max(len(self.trees), 1)


class Model:
    def __init__(self, language: Language, forest: Forest):
        self.language, self.forest = language, forest

    def findings(self, text: str, path: str, least: float) -> list[tuple[int, int, str, float]]:
        found = candidates(text)
        if not found:
            return []
        x = np.array([features(self.language, *context(text, s, e), path, kind) for s, e, kind in found])
        return [(s, e, kind, float(p)) for (s, e, kind), p in zip(found, self.forest.score(x)) if p >= least]


def ordinary_words(docs: DataFrame) -> DataFrame:
    """(w, n): every word of letters of all documents, lower-cased, and its count; staged, since
    ``train`` reads it several times."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    words = texts.select(F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z]{2,24}"), F.lit(0))).alias("w"))
    return staged(words.groupBy(F.lower("w").alias("w")).agg(F.count(F.lit(1)).alias("n")))


def transitions_of(words: DataFrame) -> np.ndarray:
    """How often each character follows another in ``words`` (w, n), a blank before and after
    each: 128 by 128, all beyond ASCII as 127."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(128 * 128, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                held = strings(batch, "w")
                codes = np.minimum(np.frombuffer(f" {' '.join(held)} ".encode("utf-32-le"), dtype=np.uint32), 127).astype(np.int64)
                np.add.at(total, codes[:-1] * 128 + codes[1:], np.repeat(batch.column("n").to_numpy(), [len(w) + 1 for w in held]))
        pairs = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(total[pairs], pa.int64())], names=["pair", "n"])

    pairs = np.zeros(128 * 128)
    for pair, n in words.select("w", "n").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        pairs[pair] = n
    return pairs.reshape(128, 128)


def judged(findings: DataFrame, language: Language) -> DataFrame:
    """(features, label) of labelled findings (value, before, after, path, label), computed where the rows are."""
    shared = findings.sparkSession.sparkContext.broadcast(language)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = list(zip(*(strings(batch, c) for c in ("value", "before", "after", "path"))))
            kinds = [next((k for s, e, k in candidates(b + v + a) if s <= len(b) < e), "run") for v, b, a, _ in rows]
            x = [features(shared.value, *row, kind) for row, kind in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column("label")], names=["features", "label"])

    columns = [F.col(c).cast("string").alias(c) for c in ("value", "before", "after", "path")]
    return findings.select(*columns, F.col("label").cast("double").alias("label")).mapInArrow(measure, "features array<double>, label double")


def train(spark: SparkSession, words: DataFrame, findings=None, max_findings: int | None = None, trees: int = 20, depth: int = 7, dictionary: int = 20_000) -> Model:
    """A model from the ``words`` (w, n) of ``ordinary_words``, whose ``dictionary`` most frequent
    of three letters and more are the dictionary, and from all labelled ``findings``, a DataFrame
    (value, before, after, path, label), or the default ones. Only a caller that sets
    ``max_findings`` gets a model of at most so many. Refits agree however the rows are laid out."""
    order = [F.desc("n"), "w"]
    language = Language(transitions_of(words), [r["w"] for r in words.where(F.length("w") >= 3).orderBy(*order).limit(dictionary).collect()])
    whole = findings is not None and max_findings is None
    if findings is None:
        rows = default_findings(ordinary=[r["w"] for r in words.orderBy(*order).limit(2000).collect()])
        findings = spark.createDataFrame(rows, "value string, before string, after string, path string, label int").coalesce(1)
    elif max_findings is not None:
        findings = findings.orderBy(F.xxhash64("value", "before")).limit(max_findings)
    data = staged(judged(findings, language))
    if whole:  # rows of equal hash and order are equal: the forest draws by position in a partition
        data = data.repartition(-(-data.count() // FIT_ROWS) or 1, "features", "label").sortWithinPartitions("features", "label")
    else:
        data = data.coalesce(1)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7, featureSubsetStrategy="sqrt")
    fitted = forest.fit(data.select(array_to_vector("features").alias("features"), "label"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/forest-{uuid.uuid4().hex}"
    fitted.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    tree = nodes.columns[0]
    return Model(language, Forest([(r[0], r[1]) for r in nodes.select(tree, nodes.columns[1]).collect()]))


def _path(docs: DataFrame, path_column: str):
    return F.coalesce(F.col(path_column).cast("string"), F.lit("")) if path_column in docs.columns else F.lit("")


def find_secrets(docs: DataFrame, model: Model, least: float = 0.5, path_column: str = "source") -> DataFrame:
    """(doc_id, start, end, kind, score) of every finding in ``docs`` (doc_id, text, path)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), _path(docs, path_column).alias("path"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [(i, *x) for i, (t, p) in enumerate(zip(strings(batch), strings(batch, "path"))) for x in shared.value.findings(t, p, least)]
            at, start, end, kind, score = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(kind, pa.string()), pa.array(score, pa.float64())],
                names=["doc_id", "start", "end", "kind", "score"])

    return rows.mapInArrow(scan, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, start long, end long, kind string, score double")


def redact(docs: DataFrame, model: Model, least: float = 0.5, path_column: str = "source", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mark``; no row goes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    hidden = fresh(docs.columns, "path")
    work = docs.withColumn(hidden, _path(docs, path_column))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, out = batch.column("text").to_pylist(), []
            for text, path in zip(texts, strings(batch, hidden)):
                at, kept = 0, []
                for s, e, _, _ in shared.value.findings(text or "", path, least):
                    kept += [text[at:s], mark]
                    at = e
                out.append("".join([*kept, text[at:]]) if at else text)
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, "text", pa.array(out, batch.schema.field(i).type)).drop_columns([hidden])

    return work.mapInArrow(scan, docs.schema)
