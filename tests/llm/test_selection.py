"""Exact dedup, SimHash and sharding against brute force."""

import hashlib
import random
import uuid
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyspark.llm import exact_dedup, sharding, simhash
from tallyspark.llm.components import components

ODD = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "a b c"), (None, "a b c"), (None, "lonely"), (5, "word " * 40_000),
       (6, "word " * 40_000), (7, "\x1c   x"), (8, "é É é")]


@pytest.fixture
def index(spark):
    index = exact_dedup.DigestIndex(spark, f"index_{uuid.uuid4().hex}", buckets=4)
    yield index
    index.drop()


def test_exact_dedup_of_odd_rows(documents, index, scratch):
    rows = exact_dedup.deduplicate(documents(*ODD), index, scratch).collect()
    assert len(rows) == len(ODD)
    for row in rows:
        same = [i for i, t in ODD if hashlib.sha256((t or "").encode()).digest() == bytes(row["digest"])]
        assert row["group_size"] == len(same)
        best = max((i for i in same if i is not None), default=None)
        assert row["keep_id"] == best and row["kept"] == (row["doc_id"] == best)


def test_kept_documents_are_one_of_each_text(documents, index, scratch):
    docs = documents(*ODD)
    kept = exact_dedup.kept_documents(docs, exact_dedup.deduplicate(docs, index, scratch))
    assert kept.columns == docs.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ODD})


def test_index_persists_over_batches(documents, index, scratch, spark):
    exact_dedup.deduplicate(documents((1, "a"), (2, "b"), (5, "a")), index, scratch).collect()
    found = exact_dedup.deduplicate(documents((9, "a"), (3, "c"), (4, "c")), index, exact_dedup.Scratch(spark)).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in found} == {(9, 5, False), (3, 4, False), (4, 4, True)}
    assert {r["keep_id"] for r in index.rows().collect()} == {5, 2, 4}


def test_the_index_side_is_neither_shuffled_nor_sorted(documents, index, scratch, spark):
    for i in range(3):  # several appends: one file per bucket in each run
        exact_dedup.deduplicate(documents(*((i * 50 + n, f"text {i} {n}") for n in range(50))), index, exact_dedup.Scratch(spark))
    groups = spark.table(index.runs()[0]).select("digest", F.lit(1).alias("keep_id"))
    with index.sorted_scans():
        plan = index.unseen(groups, "other")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and "Exchange" not in plan and "Sort [" not in plan


def test_a_repeated_batch_keeps_what_it_kept(documents, index, spark):
    docs = documents((1, "a"), (2, "b"), (3, "b"))
    for _ in range(2):
        found = exact_dedup.deduplicate(docs, index, exact_dedup.Scratch(spark), batch="one").collect()
        assert {(r["doc_id"], r["kept"]) for r in found} == {(1, True), (2, False), (3, True)}
    assert index.rows().count() == 2
    later = exact_dedup.deduplicate(documents((9, "a"), (8, "c")), index, exact_dedup.Scratch(spark), batch="two").collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in later} == {(9, 1, False), (8, 8, True)}


def test_runs_are_merged(documents, spark):
    index = exact_dedup.DigestIndex(spark, f"index_{uuid.uuid4().hex}", buckets=2, most_runs=2)
    for i in range(5):
        exact_dedup.deduplicate(documents((i, f"t{i}"), (i, "all")), index, exact_dedup.Scratch(spark))
    assert len(index.runs()) <= 2 and index.rows().count() == 6
    found = exact_dedup.deduplicate(documents((7, "t2"), (8, "new")), index, exact_dedup.Scratch(spark)).collect()
    assert {(r["doc_id"], r["kept"]) for r in found} == {(7, False), (8, True)}
    index.drop()
    assert index.runs() == []


@pytest.mark.parametrize("batches", [1, 3, 4])
def test_exact_dedup_of_all_in_batches(documents, index, scratch, batches):
    draw = random.Random(3)
    docs = ODD + [(draw.choice([None, *range(40)]), draw.choice(["p", "q", "r", "", None])) for _ in range(60)]
    docs += [(100 + i, f"single {i}") for i in range(30)]
    rows = exact_dedup.deduplicate_all(documents(*docs), index, scratch, batches).collect()
    assert len(rows) == len(docs)
    for row in rows:
        same = [i for i, t in docs if hashlib.sha256((t or "").encode()).digest() == bytes(row["digest"])]
        best = max((i for i in same if i is not None), default=None)
        assert (row["group_size"], row["keep_id"], row["kept"]) == (len(same), best, row["doc_id"] == best)


def test_exact_dedup_of_nothing(documents, index, scratch):
    assert exact_dedup.deduplicate(documents(), index, scratch).collect() == []


def brute_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b  c\td", "x y z " * 500, "É é É a", "a b c d e f"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_xxh64_is_sparks(spark):
    from pyspark.sql import functions as F

    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"one two three", 42)


def brute_components(values, distance):
    label = list(range(len(values)))
    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= distance and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("distance", [1, 2, 3, 5])
def test_links_lose_nothing(spark, scratch, distance):
    rnd = random.Random(distance)
    values = set()
    for _ in range(40):
        base = rnd.getrandbits(64)
        for _ in range(6):
            values.add(base)
            for _ in range(rnd.randint(0, 3)):
                base ^= 1 << rnd.randrange(64)
    values = sorted(values)
    fps = spark.createDataFrame([(simhash.signed(v), simhash.signed(v)) for v in values], "fp long, label long")
    plan = simhash.search_plan(fps, distance)
    assert sum(p.threshold + 1 for p in plan) == distance + 1
    found = {frozenset(x % (1 << 64) for x in r) for r in simhash.linked(fps, plan, distance).collect()}
    want = {frozenset((a, b)) for a in values for b in values if a < b and bin(a ^ b).count("1") <= distance}
    assert found == want


def test_unequal_thresholds_are_allocated():
    total, thresholds = simhash.allocate([[0, 5, 6, 90, 95], [0, 1, 50, 95, 99], [0, 9, 90, 95, 99]], 3)
    assert thresholds == [1, 0, 0] and total == 16


def test_near_duplicates_of_odd_rows(documents, scratch):
    words = [f"w{i}" for i in range(400)]
    near = [(20 + k, " ".join(words[:k * 40] + ["changed"] + words[k * 40 + 1:])) for k in range(8)]
    rows = [*ODD, (19, " ".join(words)), *near]
    found = simhash.near_duplicates(documents(*rows), scratch).collect()
    assert len(found) == len(rows)
    values = [r["fp"] % (1 << 64) for r in found]
    label = brute_components(values, 3)
    for i, row in enumerate(found):
        same = [found[j]["doc_id"] for j in range(len(rows)) if label[j] == label[i] and found[j]["doc_id"] is not None]
        assert row["component_id"] == min(same, default=None)
    assert simhash.near_duplicates(documents(), scratch).collect() == []


def test_one_of_each_keeps_all_groups(documents, scratch):
    docs = documents(*ODD)
    kept = simhash.one_of_each(docs, scratch)
    assert kept.columns == docs.columns
    assert len({simhash.fingerprint(r["text"]) for r in kept.collect()}) == kept.count()
    assert {simhash.fingerprint(r["text"]) for r in kept.collect()} == {simhash.fingerprint(t) for _, t in ODD}


def test_one_of_each_where_ids_repeat_or_lack(documents, scratch):
    base = [f"w{i}" for i in range(600)]
    variants = (" ".join([*base[:k], "other", *base[k + 1:]]) for k in range(600))
    print_of_base = simhash.fingerprint(" ".join(base))
    near = next(t for t in variants if 0 < bin(print_of_base ^ simhash.fingerprint(t)).count("1") <= 3)
    nameless = [(None, " ".join(base)), (None, near)]
    assert simhash.one_of_each(documents(*nameless), scratch).count() == 1
    # Id 5 stands for two texts: smallest of one group, of the other not.
    rows = [(5, " ".join(base)), (9, near), (5, "x y z u v w"), (3, "x y z u v w")]
    kept = simhash.one_of_each(documents(*rows), scratch).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([rows[0], rows[3]])
    # Smallest of both.
    kept = simhash.one_of_each(documents(*rows[:3]), scratch).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([rows[0], rows[2]])


def test_components_of_a_chain_and_a_star(spark, scratch):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(links, "u long, v long"), scratch, "c").distinct().collect())
    assert found == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}}


def slow_jump(key, n):
    b, j = -1, 0
    while j < n:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_hash():
    keys = np.random.default_rng(3).integers(0, 1 << 64, size=2000, dtype=np.uint64)
    for n in (1, 2, 40, 41):
        assert sharding.jump(keys, n).tolist() == [slow_jump(int(k), n) for k in keys]
    old, new = sharding.jump(keys, 40), sharding.jump(keys, 41)
    assert set(new[old != new]) == {40} and 0.01 < (old != new).mean() < 0.05


def test_sharding_of_odd_rows(documents):
    found = sharding.shard_documents(documents(*ODD, *[(100 + i, str(i)) for i in range(300)])).collect()
    assert len(found) == len(ODD) + 300
    for shard in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    sizes = {(i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in ODD}
    assert sizes == {(r["doc_id"], r["size"], r["text_crc32"]) for r in found if (r["doc_id"] or 0) < 100}
    assert {r["grown_shard"] for r in found if r["grown_shard"] != r["shard"]} <= {40}
    assert len({r["shard"] for r in found if r["doc_id"] == 3}) == 1
    assert sharding.shard_documents(documents()).collect() == []


def test_numbering_in_many_parts(documents):
    rows = documents(*[(i, "t") for i in range(500)]).selectExpr("doc_id", "text", "doc_id % 3 as shard")
    found = sharding.numbered(rows, "shard", ["doc_id", "text"], rows_per_part=20).collect()
    for shard in range(3):
        own = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_shards_are_written(documents, folder, spark):
    docs = documents(*[(i, str(i)) for i in range(200)])
    sharding.write_shards(docs, folder + "/out", shards=5, files_per_shard=2)
    assert spark.read.parquet(folder + "/out").count() == 200
