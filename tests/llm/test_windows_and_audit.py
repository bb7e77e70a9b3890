"""Hard negatives, substring dedup and the filter audit against brute force."""

import random
import re
from itertools import combinations, permutations

import numpy as np
import pytest

from tallyspark.llm import filter_audit, hard_negatives, substring_dedup
from tallyspark.llm.substring_dedup import Windows, difference_cover

VECTORS = "vec_id long, embedding array<float>, label int, q string, dim int, score double"
LABELS = "doc_id long, quality int, toxic int, part string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- substring dedup -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("period", range(1, 16))
def test_difference_cover_gives_every_shift(period):
    cover = difference_cover(period)
    for i in range(period):
        for j in range(period):
            assert any((i + d) % period in cover and (j + d) % period in cover for d in range(period))


def brute_windows(docs, n=20):
    """Words removed of each document, by comparing all windows."""
    first, words = {}, [(i, WORD.findall(t or "")) for i, t in docs]
    key = lambda i: (i is None, i or 0)
    for i, w in words:
        for s in range(len(w) - n + 1):
            at = (key(i), s)
            win = tuple(w[s:s + n])
            first[win] = min(first.get(win, at), at)
    out = []
    for i, w in words:
        gone = set()
        for s in range(len(w) - n + 1):
            if first[tuple(w[s:s + n])] < (key(i), s):
                gone.update(range(s, s + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def planted(seed, docs=60):
    """Texts that share passages of 15 to 60 words at any offset, in part very common ones, and some that repeat themselves."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(15, 60))] for _ in range(8)]
    out = []
    for i in range(docs):
        words = []
        for _ in range(rng.randint(0, 5)):
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
            if rng.random() < 0.6:
                words += passages[min(rng.randrange(8), rng.randrange(8))]
        out.append((rng.randrange(docs), rng.choice([" ", "\n", "\t "]).join(words)))
    return out


ODD = [(1, None), (2, ""), (None, "a " * 30), (None, "a " * 30), (3, "b " * 45), (3, "b " * 45), (4, "x y z " * 9_000),
       (5, "x y z " * 9_000), (6, " \x0b\x0c"), (7, "é É " * 25), (8, "\x1cq " * 25), (9, "short text")]


@pytest.mark.parametrize("docs", [planted(1), planted(2), ODD, planted(3) + ODD], ids=["seed1", "seed2", "odd", "both"])
def test_substring_dedup_is_brute_force(documents, scratch, docs):
    frame = documents(*docs).repartition(5)
    how = Windows(pack_bytes=2_000, bucket_bytes=4_000, rows_out=3)
    found = substring_dedup.without_repeats(frame, scratch, how)
    assert found.columns == ["doc_id", "n_words", "n_removed", "removed", "kept"]
    rows = found.collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in rows), key=str) == brute_windows(docs)
    for r in rows:
        assert sum(s["end"] - s["first"] for s in r["removed"]) == r["n_removed"]


def test_substring_dedup_does_not_depend_on_packs_or_buckets(documents, scratch, spark):
    docs = planted(4)
    results = []
    for parts, how in ((1, Windows()), (7, Windows(pack_bytes=500, bucket_bytes=900)), (3, Windows(period=7))):
        found = substring_dedup.without_repeats(documents(*docs).repartition(parts), substring_dedup.Scratch(spark), how)
        results.append(sorted(map(str, found.collect())))
    assert results[0] == results[1] == results[2]


def test_substring_dedup_of_nothing(documents, scratch):
    assert substring_dedup.without_repeats(documents(), scratch).collect() == []


def test_unique_texts_ask_for_no_windows():
    how = Windows()
    pack = substring_dedup.Pack([1], [" ".join(f"u{i}" for i in range(400)).encode()], how)
    anchors = substring_dedup.Anchors(pack, 1)
    assert len(anchors.at) == sum(1 for p in range(393) if p % 13 in difference_cover(13))
    silent = anchors.repeated({0: substring_dedup.packed(np.zeros(len(anchors.distinct), dtype=bool))})
    assert list(substring_dedup.Found(pack, silent, 1).asked()) == []


# -- hard negatives --------------------------------------------------------------------------------------------------

def brute_negatives(rows, anchor_ids, how=hard_negatives.Mining()):
    best = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        one = (label, [int(np.floor(how.scale * float(np.float32(x)))) for x in v])
        best[i] = min(best.get(i, one), one)
    out = []
    for a in sorted(set(anchor_ids) & set(best)):
        label, q = best[a]
        scored = sorted((-sum(x * y for x, y in zip(q, r)), i, other == label) for i, (other, r) in best.items()
                        if i != a and len(r) == len(q))
        for score, p, _ in [x for x in scored if x[2]][:how.positives]:
            fits = [(s, i) for s, i, same in scored if not same and how.low * -score <= 100 * -s <= how.high * -score]
            out += [(a, p, r + 1, i, -score, -s) for r, (s, i) in enumerate(fits[:how.negatives])]
    return sorted(out)


def mined(spark, scratch, rows, anchors, **how):
    frame = spark.createDataFrame([(i, v, label, "q", 1, 0.5) for i, v, label in rows], VECTORS)
    found = hard_negatives.mine(frame, spark.createDataFrame([(a,) for a in anchors], "vec_id long"), scratch,
                                hard_negatives.Mining(**how))
    return sorted(tuple(r) for r in found.collect())


def clusters(seed, n=400, dim=24, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    return [(i, (middle[i % centres] + 0.2 * rng.normal(size=dim)).tolist(), int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize("how", [{}, {"shard_rows": 64, "block_rows": 5, "tile": 7}, {"segments": (5, 1)}], ids=["one", "many", "uneven"])
def test_hard_negatives_are_brute_force(spark, scratch, how):
    rows = clusters(5)
    anchors = [r[0] for r in rows if r[0] % 20 == 0]
    found = mined(spark, scratch, rows, anchors, **how)
    assert found and found == brute_negatives(rows, anchors)


def test_hard_negatives_of_odd_rows(spark, scratch):
    whole = [1.0, 2.0, -1.0]
    rows = [(0, whole, 1), (0, whole, 2), (None, whole, 1), (2, whole, None), (3, None, 1), (4, [1.0, None, 2.0], 1),
            (5, [1.0, float("nan"), 2.0], 1), (6, [float("inf"), 1.0, 1.0], 2), (8, whole, 1), (8, whole, 1), (9, [0.5, 1.0, -0.5], 3),
            (10, [0.5, 1.0, -0.5], 3), (11, [0.0, 0.0, 0.0], 1), (12, [], 1), (13, [], 2), (15, [1.0, 2.0], 1), (16, [-1.0, -2.0, 1.0], 1),
            (7, [0.9, 1.5, -0.6], 0), (14, [3.0e5, 1.0, 1.0], 5)]
    anchors = [0, 8, 11, 12, 16, 99, 14]
    assert mined(spark, scratch, rows, anchors) == brute_negatives(rows, anchors)
    assert mined(spark, scratch, [], []) == []


def test_scores_beyond_doubles_stay_exact(spark, scratch):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x)) for x in rng.uniform(1e6, 2e6, size=4)], i % 3) for i in range(60)]
    anchors = [r[0] for r in rows if r[0] % 6 == 0]
    assert mined(spark, scratch, rows, anchors) == brute_negatives(rows, anchors)


def test_bounds_leave_few_pairs_of_clustered_vectors():
    rng = np.random.default_rng(3)
    # Neighbouring components go together, as in vectors whose components are sorted by topic.
    middle = np.repeat(rng.normal(size=(10, 8)), 8, axis=1)
    values = np.floor(256 * (middle[np.arange(2000) % 10] + 0.2 * rng.normal(size=(2000, 64)))).astype(np.int64)
    how = hard_negatives.Mining()
    rows = hard_negatives.Vectors(np.arange(2000), np.arange(2000) % 7, values, how.segments, np.float64)
    anchors = hard_negatives.Vectors(np.arange(40), np.arange(40) % 7, values[:40], how.segments, np.float64)
    _, scorer = hard_negatives.nearest_same(anchors, rows, how)
    assert scorer.scored < 0.2 * 40 * 2000
    assert scorer.bounded[0] > scorer.bounded[1] > scorer.bounded[2]


def test_limits_are_exact():
    how = hard_negatives.Mining()
    scores = np.array([0, 1, 19, 20, 99, 101, 2 ** 62 - 1, -1, -37, -(2 ** 62)])
    low, high = hard_negatives.limits(scores, how)
    for s, a, b in zip(scores.tolist(), low.tolist(), high.tolist()):
        assert a == -(-how.low * s // 100) and b == how.high * s // 100


# -- filter audit ----------------------------------------------------------------------------------------------------

def brute_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    known = {}
    for i, q, x in labels:
        old = known.get(i, (None, None))
        known[i] = tuple(max((v for v in pair if v is not None), default=None) for pair in zip(old, (q, x)))
    rows = []
    for i, t, source in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            re.search("[#$%&*|]", t) is not None, i is not None and i > first[t])) if bad}
        rows.append((source or "", fails, *(known.get(i, (None, None)) if i is not None else (None, None))))
    out = []
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        report, total = [], {}
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] = total.get(f, 0) + len(lost)
                report.append((part, order, step, len(left), len(lost), sum(f in r[1] for r in mine) - len(lost),
                               sum(r[1] == {f} for r in mine), sum(r[2] == 1 for r in lost), sum(r[3] == 1 for r in lost)))
        out += [(*r, total[r[1][r[2] - 1]]) for r in report]
    return sorted(out)


def audited(spark, documents, scratch, docs, labels):
    frame = spark.createDataFrame([(*x, "p") for x in labels], LABELS)
    return sorted(tuple(r) for r in filter_audit.audit(documents(*docs), frame, scratch).collect())


def test_filter_audit_is_brute_force(spark, documents, scratch):
    rng = random.Random(6)
    pieces = ["plain ", "Some Words ", "# mark ", "word " * 120, " ".join(f"v{i}" for i in range(220)) + " ", "é ", "\x0b|"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 4))) for _ in range(40)]
    docs = [(rng.randrange(90), rng.choice(texts), rng.choice(["a", "b", None, ""])) for _ in range(120)]
    docs += [(None, texts[0], "a"), (1, None, "c"), (2, "", "c"), (2, "", "c"), (3, "Q" * 400_000, "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(60)] + [(5, 1, 1), (5, 0, 0), (None, 1, 1)]
    assert audited(spark, documents, scratch, docs, labels) == brute_audit(docs, labels)


def test_filter_audit_of_nothing(spark, documents, scratch):
    assert audited(spark, documents, scratch, [], [(1, 1, 1)]) == []
    assert len(audited(spark, documents, scratch, [(1, None, None)], [])) == 600


def test_gray_walk_gives_every_subset():
    counts = np.random.default_rng(1).integers(0, 50, size=(3, 32, 3))
    states = filter_audit.survivors(counts)
    for subset in range(32):
        chosen = [f for f in range(32) if not f & subset]
        assert (states[:, subset] == counts[:, chosen].sum(axis=1)).all()
    assert len({"".join(x) for n in range(6) for x in combinations("ABCDE", n)}) == 32
