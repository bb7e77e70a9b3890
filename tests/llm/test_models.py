"""Classifiers by held-out accuracy, nearest neighbours by recall, the registered queries and the pipeline."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyspark.llm import quality, queries, toxicity, vp_trees
from tallyspark.llm.tables import is_held_out, table

FOLDER = "/root/testdata/sf0.01"


def accuracy(found, labels, label):
    held = found.filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    return sum(a == b for a, b in held) / len(held)


def test_quality_on_held_out_rows(spark, scratch):
    found = quality.op5_quality_voting(spark, FOLDER)
    assert found.count() == table(spark, FOLDER, "documents").count()
    assert accuracy(found, table(spark, FOLDER, "labels"), "quality") > 0.95


def test_quality_is_not_fitted_on_the_driver(spark, documents, monkeypatch):
    """The driver gets the finished space: neither the sample's terms nor the decomposition pass its memory."""
    rows = [(i, f"word{i % 7} other{i % 5} " * (i % 9 + 1)) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], LABELS)
    known = {r["doc_id"]: r["y"] for r in labels.filter(~is_held_out(F.col("doc_id"))).selectExpr("doc_id", "quality AS y").collect()}
    terms = [(known[i], quality.term_vector(text)) for i, text in rows if i in known]
    terms.sort(key=lambda t: (t[0], np.flatnonzero(t[1]).astype(np.int32).tobytes(), t[1][np.flatnonzero(t[1])].tobytes()))
    how = quality.Voting(neighbours=5, rank=6)
    want = quality.space_of(np.stack([t for _, t in terms]), np.array([y for y, _ in terms], dtype=float), how)

    def refuse(*args):
        raise AssertionError("fitted on the driver")

    monkeypatch.setattr(quality, "space_of", refuse)
    space = quality.fit(documents(*rows), labels, how)
    some = np.stack([t for _, t in terms[::5]])
    assert space.vote(some, how) == pytest.approx(want.vote(some, how), rel=1e-4)


def test_toxicity_on_held_out_rows(spark, scratch):
    found = toxicity.op7_toxicity(spark, FOLDER)
    assert found.count() == table(spark, FOLDER, "documents").count()
    assert accuracy(found, table(spark, FOLDER, "labels"), "toxic") > 0.9


LABELS = "doc_id long, quality int, toxic int"
ODD = [(1, None), (2, ""), (None, "x"), (3, "word " * 50_000), (3, "word " * 50_000), (4, "idiot")]


@pytest.mark.parametrize("labels", [[], [(1, None, None), (None, 1, 1)], [(i, 1, 1) for i in range(40)]])
def test_classifiers_with_odd_rows_and_labels(documents, spark, scratch, labels):
    known = spark.createDataFrame(labels, LABELS)
    for rated in (quality.rate(documents(*ODD), known), toxicity.rate(documents(*ODD), known, scratch)):
        rows = rated.collect()
        assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.rate(documents(), known).collect() == []


def test_votes_are_the_blocked_products():
    rng = np.random.default_rng(2)
    space = quality.Space(np.ones(quality.TERMS, np.float32), rng.normal(size=(quality.TERMS, 8)).astype(np.float32),
                          quality.unit(rng.normal(size=(60, 8))), rng.integers(0, 2, 60).astype(float))
    how, terms = quality.Voting(neighbours=5), rng.random((7, quality.TERMS)).astype(np.float32)
    for score, row in zip(space.vote(terms, how), space.project(terms)):
        cosine = sorted(((float(np.clip(row @ v, 0, None)), y) for v, y in zip(space.vectors, space.labels)), reverse=True)[:5]
        assert score == pytest.approx(sum(c ** 8 * y for c, y in cosine) / sum(c ** 8 for c, _ in cosine), abs=1e-4)


def test_random_letters_are_like_nothing_labelled(spark):
    rng, labels = np.random.default_rng(8), table(spark, FOLDER, "labels")
    docs = table(spark, FOLDER, "documents")
    how = quality.Voting()
    space = quality.fit(docs, labels, how)
    good = [r["text"] for r in docs.join(labels.filter("quality = 1"), "doc_id").orderBy("doc_id").limit(80).collect()]
    consonants = "bcdfghjklmnpqrstvwxz"

    def scrambled(text):
        drawn = [consonants[i] for i in rng.integers(0, len(consonants), len(text))]
        return "".join((d.upper() if c.isupper() else d) if c.isalpha() else c for c, d in zip(text, drawn))

    def accepted(texts):
        return (space.vote(np.stack([quality.term_vector(t) for t in texts]), how) >= how.accept).mean()

    assert accepted(good) > 0.97
    assert accepted([" ".join(t.split()[:8]) for t in good]) > 0.95
    assert accepted([" ".join(good[i:i + 20]) for i in range(40)]) > 0.95
    assert accepted([scrambled(t) for t in good]) < 0.3


def test_a_score_by_hand():
    rng = np.random.default_rng(9)
    texts = [" ".join(rng.choice(["one", "two", "three", "Four.", "five,"], 6 + i)) for i in range(60)]
    y, how = rng.integers(0, 2, 60).astype(float), quality.Voting(neighbours=4, rank=6)
    space = quality.space_of(np.stack([quality.term_vector(t) for t in texts]), y, how)
    for text in ["one two", "Four. three three five,", "xyzzy plugh 77 $$ qqq", texts[3]]:
        parts = np.split(quality.term_vector(text) * space.weights, quality.ENDS[:-1])
        whole = np.concatenate([part / (np.linalg.norm(part) or 1) * share for part, (_, share) in zip(parts, quality.KINDS.values())])
        place = whole / np.linalg.norm(whole) @ space.axes
        near = sorted(((max(float(place @ v), 0.0) ** 8, label) for v, label in zip(space.vectors, y)), reverse=True)[:4]
        words = len(text.split())
        least = 4 * (space.likeness * words / (words + how.few_words)) ** 8
        want = sum(w * label for w, label in near) / max(sum(w for w, _ in near), least)
        assert space.vote(quality.term_vector(text)[None, :], how)[0] == pytest.approx(want, rel=1e-3, abs=1e-6)


def test_the_latent_space_is_fitted_without_a_whole_matrix():
    rng = np.random.default_rng(4)
    at = [np.unique(rng.integers(0, quality.TERMS, 300)).astype(np.int32) for _ in range(1500)]
    packed = quality.PackedRows(at, [rng.random(len(a)).astype(np.float32) for a in at], 256)
    tracemalloc.start()
    space = quality.space_of(packed, rng.integers(0, 2, 1500).astype(float), quality.Voting())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert space.vectors.shape == (1500, 32) and peak < 1500 * quality.TERMS * 4


def test_the_regression_finds_the_word():
    x = np.zeros((200, 3), dtype=np.float32)
    x[:50, 0], x[::3, 1] = 1, 1
    weights, bias = toxicity.regression(x, (x[:, 0] > 0).astype(np.float32), toxicity.Model())
    assert weights[0] > 2 > abs(weights[1]) and bias < 0


def test_a_toxic_passage_counts_in_a_long_text(documents, spark, scratch):
    rng = np.random.default_rng(6)
    words, kind = [f"word{i}" for i in range(40)], [f"kindly{i}" for i in range(20)]

    def clean():
        return " ".join([*rng.choice(words, 25), *rng.choice(kind, 5)])

    def toxic():
        return " ".join([*rng.choice(words, 25), "idiot", *rng.choice(words, 4)])

    texts = [clean() if i % 4 else toxic() for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)], LABELS)
    around = [" ".join(clean() for _ in range(n)) for n in (10, 100, 6000)]
    new = [toxic(), clean(), *around, *[f"{a} {toxic()} {a}" for a in around], *[f"{toxic()} {a}" for a in around],
           *[f"{a} {toxic()}" for a in around]]
    rows = toxicity.rate(documents(*enumerate([*texts, *new])), labels, scratch).filter("doc_id >= 400").orderBy("doc_id").collect()
    assert [r["predicted"] for r in rows] == [1, 0, 0, 0, 0] + [1] * 9


def test_ngrams_are_told_apart_exactly():
    text = " the cat, THE cafés 1 \x00z" * 3
    plain = bytes(toxicity._LETTERS[toxicity.bytes_of(text)])
    want = {int.from_bytes(plain[i:i + n], "little") for n in toxicity.SIZES for i in range(len(plain) - n + 1)}
    assert set(toxicity.present(text).tolist()) == want
    kept = toxicity.Kept.of(np.array(sorted(want)[::3], dtype=np.uint64))
    assert set(kept.codes[kept.find(text)[1]].tolist()) == set(kept.codes.tolist())
    assert [len(toxicity.present(t)) for t in (None, "", "a", "ab")] == [0, 0, 0, 1]


def plain_grams(text):
    plain = bytes(toxicity._LETTERS[toxicity.bytes_of(text)])
    return [(i, int.from_bytes(plain[i:i + n], "little")) for n in toxicity.SIZES for i in range(len(plain) - n + 1)]


def test_toxic_counts_ratios_and_windows_by_brute_force(spark):
    rng = np.random.default_rng(3)
    words = ["idiot", "clown", "kind", "tree", "Été", "x", "river,", "1984"]
    texts = [(" ".join(rng.choice(words, rng.integers(0, 40))), int(rng.integers(0, 2))) for _ in range(60)] + [(None, 1), ("", 0)]
    rows, how = spark.createDataFrame(texts, "text string, y int"), toxicity.Model(features=40)
    holds = [({c for _, c in plain_grams(t)}, y) for t, y in texts]
    want = {c: (sum(c in h for h, y in holds if y), sum(c in h for h, y in holds if not y)) for c in set().union(*(h for h, _ in holds))}
    assert {np.uint64(np.int64(r[0])).item(): (r[1], r[2]) for r in toxicity.counted(rows, how).collect()} == want
    n = sum(y for _, y in texts)
    m, ranked = len(texts) - n, []
    for code, (a, b) in want.items():
        if a + b >= how.least_docs:
            chi2 = (n + m) * (a * m - b * n) ** 2 / ((a + b) * (n + m - a - b + 1) * n * m)
            ranked.append((chi2, code, math.log((a + 1) / (n + 2)) - math.log((b + 1) / (m + 2))))
    codes, ratios = toxicity.chosen(rows, how)
    least = sorted(ranked, reverse=True)[how.features - 1][0]
    known = {code: (chi2, ratio) for chi2, code, ratio in ranked}
    for code, ratio in zip(codes.view(np.uint64).tolist(), ratios):
        assert known[code][0] >= least - 1e-9 and ratio == pytest.approx(known[code][1])
    kept = np.sort(codes.view(np.uint64))
    weights = dict(zip(kept.tolist(), rng.normal(size=len(kept))))
    model = toxicity.Classifier(toxicity.Kept.of(kept), np.array(list(weights.values())), -0.3, 50)
    for text in [t for t, _ in texts[:25]] + [None, "", " ".join(rng.choice(words, 500))]:
        found, length = [(i, c) for i, c in plain_grams(text) if c in weights], len(toxicity.bytes_of(text))
        starts = [k * 25 for k in range(length) if k * 25 < length - 50]
        sets = [{c for i, c in found if s <= i < s + 50} for s in starts] + [{c for i, c in found if i >= length - 50}]
        best = max(sum(weights[c] for c in s) for s in sets)
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(0.3 - best)))


def brute(rows, queries, k):
    out = {}
    for q, a in queries:
        near = sorted((math.sqrt(sum((x - y) ** 2 for x, y in zip(a, b))), i) for i, b in rows if i != q and len(a) == len(b))
        out[q] = near[:k]
    return out


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (0.9, 0.95)])
def test_vp_trees_against_brute_force(spark, scratch, factor, least):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(5, 8)) * 4
    rows = [(i, [float(x) for x in centres[i % 5] + rng.normal(size=8)]) for i in range(900)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(2000, [1.0, 2.0]), (2100, [3.0, 4.0])]
    odd = [(3000, None), (3100, []), (3200, [0.0] * 8), (3300, [math.nan] * 8), (3400, [math.inf] + [1.0] * 7), (None, [1.0] * 8),
           (3500, [None] + [1.0] * 7)]
    frame = spark.createDataFrame([(*r, 1) for r in rows + odd], "vec_id long, embedding array<double>, rank int")
    how = vp_trees.Search(factor=factor, shard_rows=300, block_rows=4, leaf=16)
    found = vp_trees.nearest(frame, frame.filter("vec_id % 100 = 0"), scratch, how).collect()
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert set(got) == set(want)
    if factor == 1.0:
        assert {q: [i for _, i in v] for q, v in got.items()} == {q: [i for _, i in v] for q, v in want.items()}
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= least
    empty = frame.limit(0)
    assert vp_trees.nearest(empty, empty, vp_trees.Scratch(spark), how).collect() == []


@pytest.mark.parametrize("factor, least", [(1.0, 1.0), (0.9, 0.95)])
def test_far_cells_are_not_visited(spark, scratch, factor, least):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(40, 16)) * 30
    rows = [(i, [float(x) for x in centres[i % 40] + rng.normal(size=16)]) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    how = vp_trees.Search(factor=factor, shard_rows=200, leaf=16)
    asked = frame.filter("vec_id % 50 = 7")
    raw = scratch.keep(vp_trees.found(frame, asked, vp_trees.Scratch(spark), how), "raw")
    assert raw.agg({"compared": "sum"}).first()[0] < 0.15 * 4000 * asked.count()
    want = brute(rows, [r for r in rows if r[0] % 50 == 7], 10)
    got = {}
    for r in vp_trees.best_of(raw, how).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {i for _, i in want[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= least


def test_every_operator_has_a_query():
    assert [q.split("_")[0] for q in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_queries_equal_their_sql(spark, scratch, name):
    from checks.compare import database, difference

    assert difference(spark, database("/root/testdata/sf0.001"), name, "/root/testdata/sf0.001") is None


def test_pipeline_stage_by_stage(spark, scratch, folder):
    docs, seen = table(spark, FOLDER, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{folder}/{i}")
        if i < 4:
            assert out.columns == docs.columns
        docs = spark.read.parquet(f"{folder}/{i}")
        seen.append(docs.count())
    assert seen[0] > seen[1] >= seen[2] and seen[4] == seen[3]
    assert docs.filter("NOT exact").isEmpty()
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/1").collect()]
    assert len(texts) == len(set(texts))
    labels = table(spark, FOLDER, "labels")
    kept = spark.read.parquet(f"{folder}/0").join(labels, "doc_id")
    good = table(spark, FOLDER, "documents").join(labels.filter("quality = 1"), "doc_id").count()
    assert kept.filter("quality = 1").count() > 0.98 * good and kept.filter("quality = 0").count() < 5
