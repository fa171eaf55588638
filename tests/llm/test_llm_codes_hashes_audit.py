"""Vector codes, SimHash groups and the filter audit against brute force and on awkward rows."""

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from regispark.llm import common, filter_audit, simhash, vector_codes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
AWKWARD = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n", "en", "a", 3), (4, "The quick brown fox jumps", "en", "a", 9),
    (4, "The quick brown fox jumps", "en", "b", 9), (5, "the Quick\tbrown  fox JUMPS", "en", None, 9), (6, LONG, None, "b", 9), (7, LONG, None, "", 9),
    (None, "The quick brown fox jumps", "en", "a", 9), (None, "alone é", "en", "a", 9), (8, "a $ a a a", "en", "é", 1), (9, "one two three", "en", "a", 8),
    (10, "漢字 かな ABC", None, "a", 5), (-3, LONG, "de", "b", 1)]


@pytest.fixture(scope="module")
def awkward(spark):
    names = ("fp", "key", "part", "mask", "n", "component_id", "view", "rep", "c", "spread")
    return spark.createDataFrame(AWKWARD, SCHEMA).withColumns({c: F.lit("x") for c in names})


# ---- vector codes


def brute_codes(rows, parts=4, entries=256, rounds=4):
    kept = [(i, e, lab) for i, e, lab in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    dims = -(-max(len(e) for _, e, _ in kept) // parts) * parts
    ints = [(i, [int(np.floor(1024 * x)) for x in e] + [0] * (dims - len(e)), lab) for i, e, lab in kept]
    width = dims // parts
    order = sorted(ints, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    books = [[r[1][p * width : (p + 1) * width] for r in order[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        held = [defaultdict(list) for _ in range(parts)]
        for _, v, _ in ints:
            for p in range(parts):
                x = v[p * width : (p + 1) * width]
                held[p][nearest(p, x)[1]].append(x)
        for p in range(parts):
            for i, xs in held[p].items():
                books[p][i] = [sum(c) // len(xs) for c in zip(*xs)]
    out, errors = [], Counter()
    for i, v, lab in ints:
        found = [nearest(p, v[p * width : (p + 1) * width]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), lab))
        errors[lab] += out[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, errors[lab], digest) for i, c, e, lab in out), key=str)


def coded(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({"v": F.lit(1), "codes": F.lit("c"), "of": F.lit(2)})
    return sorted((tuple(r) for r in vector_codes.vector_codes(df.repartition(3), **settings).collect()), key=str)


@pytest.mark.parametrize("kind", ["spread", "ties", "few", "wide"])
def test_vector_codes_match_a_full_search(spark, kind):
    rng = np.random.default_rng(7)
    n, dims = {"spread": (150, 8), "ties": (120, 8), "few": (5, 4), "wide": (60, 12)}[kind]
    x = rng.integers(-2, 3, (n, dims)) / 1024 if kind == "ties" else rng.normal(size=(n, dims)) * (3e4 if kind == "wide" else 1)
    rows = [(int(i), [float(c) for c in v], None if i % 5 == 0 else int(i % 3)) for i, v in zip(rng.permutation(n), x)]
    assert coded(spark, rows, entries=12) == brute_codes(rows, entries=12)


def test_vector_codes_awkward(spark):
    rows = [(1, [0.5, 1.0, -0.25, 0.1], 1), (1, [0.5, 1.0, -0.25, 0.1], 1), (1, [0.1, 1.0, -0.25, 0.1], 2), (2, None, 1), (3, [1.0, None, 0.0, 0.0], 1),
            (4, [float("nan")] * 4, 1), (5, [float("inf"), 0.0, 0.0, 0.0], None), (6, [0.25], None), (7, [], 3), (None, [1.0, 1.0, 1.0, 1.0, 1.0], None)]
    assert coded(spark, rows) == brute_codes(rows) and coded(spark, [r for r in rows if r[0] is None]) == brute_codes([rows[-1]])
    assert coded(spark, []) == [] and coded(spark, [rows[3]]) == [] and coded(spark, [(7, [], 3)])[0][:4] == (7, "00000000", 0, 0)
    with pytest.raises(Exception, match="too large"):
        coded(spark, [(1, [1e30] * 4, 1)])
    with pytest.raises(ValueError, match="too large"):
        coded(spark, [(1, [1e9] * 4, 1), (2, [-1e9] * 4, 1)])


def test_balls_pass_over_cores_and_agree_in_whole_numbers():
    rng = np.random.default_rng(3)
    centres = rng.integers(-500, 500, (40, 6)).astype(float)
    x = (centres[rng.integers(0, 40, 3000)] + rng.integers(-150, 150, (3000, 6))).astype(float)
    full, dist = vector_codes.Balls(centres).nearest(x, None)
    old = np.where(rng.random(3000) < 0.3, rng.integers(0, 40, 3000), full)
    far = np.zeros(40)
    np.maximum.at(far, old, ((x - centres[old]) ** 2).sum(axis=1))
    for dtype in (float, np.int64):
        balls = vector_codes.Balls(centres.astype(dtype), far)
        got = balls.nearest(x.astype(dtype), old)
        assert (got[0] == full).all() and (got[1] == dist).all()
    assert (4 * dist < balls.core[full]).any()


# ---- SimHash


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_roots(fps, distance=4):
    fps = sorted(set(fps))
    a, root = np.array(fps, dtype=np.uint64), list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a[i + 1 :]) <= distance) + i + 1:
            p, q = sorted((find(i), find(int(j))))
            root[q] = p
    return {f: find(i) for i, f in enumerate(fps)}


def grouped(got):
    out = defaultdict(set)
    for member, group in got.items():
        out[group].add(member)
    return {frozenset(s) for s in out.values()}


def test_simhash_matches_brute_force(spark):
    docs = common.table(spark, "/root/testdata/sf0.001", "documents")
    fps = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    roots, least = brute_roots(fps.values()), {}
    for d in sorted(fps, reverse=True):
        least[roots[fps[d]]] = d
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {d: (f"{f:016x}", least[roots[f]]) for d, f in fps.items()}


@pytest.mark.parametrize("piece,free", [(4096, None), (8, 1), (8, 2), (3, 3)])
def test_hamming_links_connect_dense_balls_chains_and_strangers(spark, piece, free):
    """One dense ball, a chain whose ends are far apart, pairs at exactly 4 and at 5 bits."""
    rng = np.random.default_rng(5)
    centre, fps = int(rng.integers(0, 2**63)), set()
    for _ in range(250):
        fps.add(centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    chain = int(rng.integers(0, 2**63))
    for i in range(20):
        fps.add(chain := chain ^ sum(1 << (3 * i + j) % 64 for j in range(1 + i % 4)))
    for i in range(60):
        f = int(rng.integers(0, 2**64, dtype=np.uint64))
        fps |= {f, f ^ sum(1 << int(b) for b in rng.choice(64, 4 + i % 2, replace=False))}
    fps |= {0, 2**64 - 1, 1 << 63, 0b1111}
    df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long").repartition(4)
    links = simhash.hamming_links(df, 4, piece, free)
    assert links.count() < 40 * len(fps)
    got = {f: f for f in fps} | {r.node % 2**64: r.component_id % 2**64 for r in common.components(links).collect()}
    assert grouped(got) == grouped(brute_roots(fps))


def test_gray_order_and_views():
    words = gray_words = simhash.gray_word(np.arange(64, dtype=np.uint64))
    assert (np.bitwise_count(words[1:] ^ words[:-1]) == 1).all() and (simhash.gray_rank(gray_words) == np.arange(64)).all()
    for free in (1, 2, 3):
        masks = simhash.views(4, free)
        for bits in itertools.islice(itertools.combinations(range(0, 64, 5), 4), 200):
            apart = np.uint64(sum(1 << b for b in bits))
            assert ((masks & apart) == 0).any()
    assert [simhash.free_blocks(n, 4) for n in (0, 10**6, 10**8, 10**10)] == [1, 1, 2, 3]


def test_simhash_awkward(spark, awkward):
    got = simhash.near_duplicates(awkward).collect()
    assert sorted((str(r.doc_id), int(r.fingerprint, 16)) for r in got) == sorted((str(r[0]), brute_fingerprint(r[1])) for r in AWKWARD)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[1].component_id == by[2].component_id == by[3].component_id == 1 and by[1].fingerprint == "0" * 16
    assert by[5].component_id == 4 and by[7].component_id == -3
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == [4, None]
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


# ---- filter audit


def brute_audit(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, part in docs:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    fails = []
    for d, text, part in docs:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
             "D": bool(re.search(r"[#$%&*|]", text)), "E": d is not None and least[text] < d}
        fails.append((part or "", {x for x in f if f[x]}, d in good, d in toxic))
    out = []
    for part in {f[0] for f in fails}:
        mine, shapley = [f for f in fails if f[0] == part], Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                removed = [f for f in left if x in f[1]]
                left = [f for f in left if x not in f[1]]
                redundant = sum(x in f[1] for f in mine) - len(removed)
                shapley[x] += len(removed)
                out.append([part, "".join(order), step, len(left), len(removed), redundant, sum(f[1] == {x} for f in mine),
                            sum(f[2] for f in removed), sum(f[3] for f in removed), x])
        for row in out:
            if row[0] == part:
                row[9] = shapley[row[1][row[2] - 1]]
    return sorted(map(tuple, out))


def written(df, path, files):
    """One file after the other, so that the stream reads them in this order."""
    for i in files:
        df.where(f"file = {i}").drop("file").coalesce(1).write.mode("append").parquet(path)
    return path


@pytest.mark.parametrize("files", [[0, 1, 2], [2, 0, 1]])
def test_audit_retracts_when_smaller_ids_arrive_later(spark, tmp_path, files):
    rng = np.random.default_rng(1)
    base = [" ".join(f"w{i}" for i in range(230)), "short $ text", "Same WORDS " * 150, "", "x " * 250, " ".join(f"é{i}" for i in range(300))]
    docs = [(int(d), base[int(rng.integers(0, len(base)))] if rng.random() < 0.8 else f"own {d} " * 120, ["a", None, "b"][int(rng.integers(0, 3))])
            for d in rng.permutation(60)]
    labels = [(d, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for d in range(0, 60, 2)] + [(0, 1, None), (None, 1, 1), (2, None, 1)]
    df = spark.createDataFrame([(*r, int(rng.integers(0, 3))) for r in docs], "doc_id long, text string, source string, file int")
    path = written(df, str(tmp_path / "docs.parquet"), files)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(spark, path, known, batches=3)
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)


def test_audit_awkward(spark, awkward, tmp_path):
    big = 2**60
    more = [(big + 1, "same text", "en", "a", 1), (big, "same text", "en", "a", 1), (big, "same text", "en", "c", 1)]
    rows = awkward.select("doc_id", "text", "source", "mask", "n", "part").unionByName(
        spark.createDataFrame(more, SCHEMA).select("doc_id", "text", "source", F.lit("x").alias("mask"), F.lit("x").alias("n"), F.lit("x").alias("part")))
    path = str(tmp_path / "awkward.parquet")
    rows.repartition(5).write.parquet(path)
    labels = [(4, 1, 0), (4, 0, 1), (7, 1, 1), (None, 1, 1), (big, 1, None)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    docs = [(r[0], r[1], r[3]) for r in [*AWKWARD, *more]]
    got = filter_audit.audit(spark, path, known, batches=2)
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, labels)
    none = str(tmp_path / "none.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(none)
    assert filter_audit.audit(spark, none, known).count() == 0


def test_audit_sums_of_a_task_do_not_depend_on_when_they_are_handed_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filter_audit, "HELD", 1)
    docs = [(d, f"text {d % 7}", "s") for d in range(50)]
    path = str(tmp_path / "d.parquet")
    spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3).write.parquet(path)
    got = filter_audit.audit(spark, path, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert sorted(map(tuple, got.collect())) == brute_audit(docs, [])
