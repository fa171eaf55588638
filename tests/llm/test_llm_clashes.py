"""Ties, bounds and clashing names; brute force for operators that SQL cannot express."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from regispark.llm import chat_format, common, decontaminate, inner_product, language_id, secret_scan, substring_dedup

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
EN = "the quick brown fox jumps over the lazy dog while other animals watch from a hill near the old stone mill by the river"
DE = "der schnelle braune Fuchs springt über den faulen Hund während andere Tiere von einem Hügel nahe der alten Mühle zuschauen"
HIDDEN = ["lettered", "lang_pred", "score", "path", "spans", "row", "position", "copy", "payload", "__bucket", "rep", "kept", "start", "end"]


def clashing(spark, rows):
    return spark.createDataFrame(rows, DOC).withColumns({c: F.concat(F.lit(f"{c} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for c in HIDDEN})


# ---- inner products


def brute_scores(rows, query):
    v = {i: [int(np.floor(1024 * x)) for x in e] for i, e in rows}
    found = [(sum(a * b for a, b in zip(v[query], v[i])), i) for i in v if i != query]
    return [(query, r, i, s) for r, (s, i) in enumerate(sorted(found, key=lambda x: (-x[0], x[1]))[:10], 1)]


@pytest.mark.parametrize("size", [100_000.0, 3e6, 1.1e5 + 1 / 3])
def test_large_components_are_scored_in_full(spark, size):
    rows = [(0, [size, 0.0]), (1, [size, 1.0]), (2, [0.7 * size, 2.0]), (3, [65_536.0, 3.0]), (4, [-size, 0.0]), (5, [0.999999999 * size, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if 1024 * size * 1024 * size >= 2**63:
        with pytest.raises(Exception, match="does not fit a long"):
            inner_product.top_k(df, F.col("vec_id") == 0).collect()
        return
    got = sorted(tuple(r) for r in inner_product.top_k(df, F.col("vec_id") == 0).collect())
    assert got == brute_scores(rows, 0)


def test_scores_near_the_end_of_a_long_are_exact(spark):
    big = 2.0**31.4 / 1024
    rows = [(0, [big, big / 3])] + [(i, [big - i / 1024, -big / 7]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in inner_product.top_k(df, F.col("vec_id") == 0).collect()) == brute_scores(rows, 0)
    with pytest.raises(Exception, match="too large"):
        inner_product.top_k(df.union(spark.createDataFrame([(99, [1e300, 0.0])], df.schema)), F.col("vec_id") == 0).collect()


def test_a_repeated_query_id_asks_by_its_least_vector(spark):
    rows = [(0, [0.5, 0.0]), (0, [0.0, 0.5])] + [(i, [i / 10, 1 - i / 10]) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    first = [tuple(r) for r in inner_product.top_k(df.repartition(5), F.col("vec_id") == 0, k=3).orderBy("rank").collect()]
    assert first == [tuple(r) for r in inner_product.top_k(df.coalesce(1), F.col("vec_id") == 0, k=3).orderBy("rank").collect()]
    assert [i for _, _, i, _ in first] == [1, 2, 3]  # [0, 512] is the lesser


# ---- chat


def test_turns_that_tie_are_ordered_by_what_was_said(spark):
    rows = [(7, 0, "assistant", "<s>"), (7, 0, "assistant", "A"), (7, 0, "[INST]", "z"), (7, 0, "Z", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.digests(chat_format.format_conversations(df)).first()
    turns = sorted((r, t) for _, _, r, t in rows)
    assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert got.loss_sha256 == hashlib.sha256(b"<s>A").hexdigest() and got.loss_chars == 4 and got.n_turns == 4


def test_loss_is_read_through_the_mask(spark):
    rows = [(1, 0, "user", "é</s>"), (1, 1, "assistant", "ans[INST]wer"), (1, 2, "assistant", ""), (None, 0, "assistant", "alone")]
    out = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    good = {r.conv_id: r for r in chat_format.digests(out).collect()}
    assert good[1].loss_sha256 == hashlib.sha256(b"ans[INST]wer").hexdigest() and good[None].loss_chars == 5
    for wrong in ("transform(loss_spans, s -> named_struct('start', s.start + 1, 'length', s.length))",
                  "transform(loss_spans, s -> named_struct('start', s.start, 'length', s.length - 1))", "slice(loss_spans, 1, 0)"):
        bad = {r.conv_id: r for r in chat_format.digests(out.withColumn("loss_spans", F.expr(wrong))).collect()}
        assert bad[1].loss_sha256 != good[1].loss_sha256 and bad[1].turns_sha256 == good[1].turns_sha256


# ---- language identification


def test_predictions_are_sums_over_trigrams(spark):
    """One text at a time, one trigram at a time, in plain Python."""
    model = language_id.fit(common.table(spark, SMALL, "documents"))
    for text in (EN, DE, "Das ist the end", "la casa de"):
        data = b" " + bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in text.lower().encode()) + b"  "
        grams = [((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 2654435761 % 2**32) >> (32 - language_id.BITS) for i in range(len(data) - 2)]
        margin = [sum(float(model.weights[g, m]) for g in grams) / len(grams) + float(model.bias[m]) for m in range(len(model.bias))]
        many = len(model.families) > 1
        fam = max(range(len(model.families)), key=lambda f: (margin[f], -f)) if many else 0
        at = (len(model.families) if many else 0) + sum(len(p) for p in model.pairs[:fam])
        sure = [1 / (1 + np.exp(-2 * m)) for m in margin]
        votes, belief = defaultdict(float), defaultdict(float)
        for k, (i, j) in enumerate(model.pairs[fam]):
            p = sure[at + k]
            votes[i if p >= 0.5 else j] += 1
            belief[i] += p
            belief[j] += 1 - p
        members = model.families[fam]
        best = max(members, key=lambda c: (votes[c] + belief[c] / (len(members) + 1), -members.index(c)))
        score = (belief[best] / (len(members) - 1) if model.pairs[fam] else 1.0) * (sure[fam] if many else 1.0)
        got = model.predict([text])
        assert got[0] == [model.langs[best]] and got[1][0] == pytest.approx(score, abs=1e-9)


def test_every_labelled_language_is_learned(spark):
    """Many languages, one of them with a single row; more than rows are refused."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join("".join(chr(97 + (c + i) % 26) for c in rng.integers(0, 4, 5)) for _ in range(30)), f"l{i % 230}", "s", 0) for i in range(460)]
    df = spark.createDataFrame(rows + [(900, "žžž qqq", "zz", "s", 0), (901, "123", "digits", "s", 0)], DOC)
    assert set(language_id.fit(df).langs) == {f"l{i}" for i in range(230)} | {"zz"}
    assert set(language_id.fit(df, max_rows=231).langs) == {f"l{i}" for i in range(230)} | {"zz"}
    with pytest.raises(ValueError, match="languages"):
        language_id.fit(df, max_rows=100)


# ---- substring duplicates


def test_repeated_passages_match_a_dictionary_of_all_chunks(spark):
    docs = common.table(spark, SMALL, "documents")
    holders, found = defaultdict(set), defaultdict(set)
    for c in substring_dedup.chunks(docs).collect():
        holders[c.digest].add(c.doc_id)
        found[c.doc_id].add((c.start, c.start + c.size, c.words, c.digest))
    want = set()
    for d, chunks in found.items():
        run = []
        for start, end, words, digest in [*sorted(x for x in chunks if len(holders[x[3]]) > 1), (1 << 60, 0, 0, None)]:
            if run and start > max(r[1] for r in run):
                if sum(r[2] for r in run) >= 20:
                    least = [min(holders[r[3]]) for r in run]
                    want.add((d, run[0][0], max(r[1] for r in run), sum(r[2] for r in run), min(least), all(x == d for x in least)))
                run = []
            run.append((start, end, words, digest))
    got = {(r.doc_id, r.start, r.end, r.n_words, r.holder, r.first) for r in substring_dedup.repeated_passages(docs).collect()}
    assert got == want and want


# ---- names


def test_columns_with_the_names_of_helpers_pass_through(spark):
    secret = 'x token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" the end of it'
    rows = [(1, EN + " " + EN, "en", "a", 1), (2, DE, "de", "a", 2), (3, None, None, None, None), (4, secret, "en", "b", 3), (5, EN + " " + EN + " tail", "en", "b", 4),
            (None, EN, "en", None, 5)]
    docs = clashing(spark, rows)
    kept = {str(r.doc_id): r for r in language_id.identify(docs, language_id.fit(docs), "l", "s").collect()}
    assert kept["1"].lettered == "lettered 1" and kept["1"].score == "score 1" and kept["1"].l == "en" and kept["3"].l == "und"
    clean = {str(r.doc_id): r for r in secret_scan.redact(docs, secret_scan.train(spark, secret_scan.ordinary_words(docs))).collect()}
    assert clean["4"].path == "path 4" and "[SECRET]" in clean["4"].text and clean["-" if "-" in clean else "None"].path == "path -"
    cut = substring_dedup.without_repeats(docs)
    assert cut.columns == docs.columns and {r.spans for r in cut.collect()} == {r.spans for r in docs.collect()}


def test_pipeline_stages_keep_the_callers_columns(spark):
    rows = [(i, f"{EN} number {i} {i * 7} {EN[: 40 + i]}", "en", ["a", "b", None][i % 3], 9) for i in range(12)]
    rows += [(50, DE, "de", "a", 1), (51, None, "en", "a", 1), (None, EN, "en", "a", 1), (50, DE, "de", "a", 1), (52, "12 34", None, None, None)]
    docs = clashing(spark, rows)
    before = {str(r.doc_id): [r[c] for c in HIDDEN] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = common.staged(stage(spark, docs, SMALL))
        if name != "mixing":
            assert out.columns == docs.columns
        got = out.collect()
        assert got and all([r[c] for c in HIDDEN] == before[str(r.doc_id)] for r in got)
        docs = out
    none = clashing(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        none = common.staged(stage(spark, none, SMALL))
        assert none.count() == 0


def test_the_secrets_stage_learns_from_every_document(spark, monkeypatch):
    """1,200 documents, each with a word of its own; the stage's model is trained on all of them."""
    given, trained = [], secret_scan.train
    monkeypatch.setattr(secret_scan, "train", lambda spark, words, *rest: (given.append(words), trained(spark, words, *rest))[1])
    own = ["own" + "".join("abcdefghij"[int(c)] for c in f"{i:04}") for i in range(1200)]
    rows = [(i, f'{w} common token = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b" end', "en", "a", 0) for i, w in enumerate(own)] + [(None, "common", "en", "a", 0), (1300, None, "en", "a", 0)]
    got = corpus_pipeline.secrets(spark, spark.createDataFrame(rows, DOC), SMALL).collect()
    assert sorted((r.text or "", r.n_chars or 0) for r in got) == sorted([("", 0), ("common", 6)] + [(t, len(t)) for t in (f'{w} common token = "[SECRET]" end' for w in own)])
    counted = {r.w: r.n for r in given[0].collect()}
    assert len(given) == 1 and all(counted[w] == 1 for w in own) and counted["common"] == 1201 and counted["token"] == 1200


# ---- decontamination


def least_distance(item, text):
    """Word edit distance of ``item`` to the best window of ``text``, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def alnum_words(text):
    import re
    return re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def test_contamination_matches_brute_force_both_ways(spark):
    """Every pair of a document and an item: copies with up to twice the edits that count."""
    rng = np.random.default_rng(31)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(5, 60))))) for i in range(50)]
    rows = []
    for d in range(150):
        i, text = items[d % 50]
        w = text.split()
        for _ in range(int(rng.integers(0, int(0.4 * len(w)) + 1))):
            p = int(rng.integers(len(w)))
            [lambda: w.__setitem__(p, f"e{p}"), lambda: w.pop(p), lambda: w.insert(p, "new")][int(rng.integers(3))]()
        around = [" ".join(rng.choice(vocabulary, int(rng.integers(0, 60)))) for _ in range(2)]
        rows.append((d, f"{around[0]} {' '.join(w)}. {around[1]}", "en", "s", 0))
    want = {}
    for d, text, *_ in rows:
        for i, item in items:
            a = alnum_words(item)
            distance = least_distance(a, alnum_words(text))
            if distance <= int(0.2 * len(a)):
                want[d, i] = distance
    found = decontaminate.contaminated(spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string"), block_items=17)
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    assert all(got[k] == want.get(k) for k in got) and len(got) >= 0.95 * len(want) > 60


@pytest.mark.parametrize("kind", ["short", "template", "long"])
def test_walks_reach_the_target_recall(spark, kind):
    """Edited up to the bound, all kinds of edits at random places; the walks alone propose."""
    rng = np.random.default_rng(77)

    def made(seed, n):
        return " ".join(f"p{x}" for x in np.random.default_rng(seed).integers(0, 5000, n))

    items = [(i, {"short": made(i, 5 + i % 8), "template": f"{made(9000, 20)} {made(i, 6)}", "long": made(i, 30 + i % 20)}[kind]) for i in range(120)]
    rows = []
    for i, text in items:
        w = text.split()
        for _ in range(int(0.2 * len(w))):
            p = int(rng.integers(len(w)))
            [lambda: w.__setitem__(p, f"e{p}"), lambda: w.pop(p), lambda: w.insert(p, "new")][int(rng.integers(3))]()
        rows += [(i, f"{made(20_000 + i, 40)} {' '.join(w)} {made(30_000 + i, 40)}", "en", "s", 0), (1000 + i, f"{made(40_000 + i, 9)} {text}", "en", "s", 0)]
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(spark.createDataFrame(rows, DOC), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert sum((i, i) in got for i, _ in items) >= 0.95 * len(items) and all((1000 + i, i) in got for i, _ in items)
