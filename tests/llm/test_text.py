"""Personal data, chat, BPE and mixing against brute force."""

import hashlib
import random
import re

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallyspark.llm import bpe, chat, mixing, pii

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "phone" and not 8 <= len(digits) <= 15
                    or kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits))):
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


LONG = ["1" * 50_000, "1 " * 30_000, "a" * 100_000, "a@b.co" * 3000, "a@b.co " * 3000, "+1" + " " * 50_000, "1.1.1.1" * 2000,
        "a." * 30_000, "+" * 20_000]
SPANS = [None, "", "x@y.z_a@b.c", "a@b..c @ b.c", "4111 1111 1111 1111", "日本 a@b.jp 1.2.3.4", "256.1.1.1 1.2.3.4",
         "007.1.1.1", "+49 (30) 123-4567 +1", "\n+1 555 123 4567\n", "0077672059906506"]


def test_base_spans(documents):
    rnd = random.Random(3)
    bits = ["1", "12", "255", ".", "@", "+", "-", " ", "a", "b.c", "_", "(", ")", "\n", "é", "4111111111111111", "日"]
    texts = [*SPANS, *LONG, *["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 60))) for _ in range(800)]]
    rows = pii.find_personal_data(documents(*enumerate(texts))).select("doc_id", pii.joined(pii.BASE).alias("spans")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row["spans"] == brute_spans(texts[row["doc_id"]]), texts[row["doc_id"]][:80]
    assert pii.find_personal_data(documents()).collect() == []


def test_checks_and_context_decide(documents):
    rows = pii.find_personal_data(documents(
        (0, "IBAN DE89 3704 0044 0532 0130 00 und mehr"), (1, "IBAN DE88 3704 0044 0532 0130 00"),
        (2, "credit card 378282246310005 x"), (3, "number 378282246310005 x"), (4, "his ssn 123-45-6789"), (5, "part 123-45-6789"),
        (6, "mail me: a@b.co"), (7, "a@b.co"))).orderBy("doc_id").collect()
    assert [len(r["iban"]) for r in rows] == [1, 0, 0, 0, 0, 0, 0, 0]
    assert [len(r["short_card"]) for r in rows] == [0, 0, 1, 0, 0, 0, 0, 0]
    assert [len(r["ssn"]) for r in rows] == [0, 0, 0, 0, 1, 0, 0, 0]
    assert rows[6]["email"][0]["score"] > rows[7]["email"][0]["score"]


def test_context_of_the_whole_text(documents):
    rows = pii.find_personal_data(documents(
        (0, "ssn 123-45-6789, 219-09-9999"), (1, "123-45-6789 is my SSN"), (2, "part 123-45-6789" + " x" * 20 + " ssn"),
        (3, "ssn 000-45-6789, 219-09-9999"), (4, "cards: 378282246310005, 371449635398431"),
        (5, "日 219-09-9999, 123-45-6789 ssn"), (6, "219-09-9999" + " " * 36 + "ssn"), (7, "219-09-9999" + " " * 38 + "ssn"),
        (8, "ssn " + "219-09-9999 " * 300), (9, "219-09-9999 " * 300 + "ssn"))).orderBy("doc_id").collect()
    assert [len(r["ssn"]) for r in rows] == [2, 1, 0, 1, 0, 2, 1, 0, 4, 4]
    assert [s["start"] for s in rows[5]["ssn"]] == [2, 15]
    assert [s["start"] for s in rows[8]["ssn"]] == [4, 16, 28, 40] and rows[9]["ssn"][-1]["end"] == 299 * 12 + 11
    assert len(rows[4]["short_card"]) == 2


def test_iban_has_its_countrys_length(documents):
    es, at, de = "ES91 2100 0418 4502 0005 1332", "AT61 1904 3002 3457 3201", "DE89 3704 0044 0532 0130 00"
    texts = [f"{es} BIC CAIXESBB", f"{at} BIC BKAUATWW", f"{at} {de} {es}", f"AT12 3456 7890 {de}", f"{es.replace(' ', '')} BIC",
             f"é {at} 1234", f"{at}x", "DE89 3704 0044 0532 0130 00 XX", "XX89 3704 0044 0532 0130 00", "NO9386011117947."]
    rows = pii.find_personal_data(documents(*enumerate(texts))).orderBy("doc_id").collect()
    assert [[s["value"] for s in r["iban"]] for r in rows] == [
        [es], [at], [at, de, es], [de], [es.replace(" ", "")], [at], [], [de], [], ["NO9386011117947"]]
    assert all(text[s["start"]:s["end"]] == s["value"] for text, r in zip(texts, rows) for s in r["iban"])
    near = pii.find_personal_data(documents((1, f"{at} {de} is my IBAN"), (2, f"{at} {de}"))).orderBy("doc_id").collect()
    assert [[round(s["score"], 1) for s in r["iban"]] for r in near] == [[1.0, 1.0], [0.9, 0.9]]


def test_masking(documents):
    found = pii.masked(pii.find_personal_data(documents((1, "é a@b.co, 1.2.3.4!"), (2, None), (3, "nothing"))))
    assert [r["text"] for r in found.orderBy("doc_id").collect()] == ["é <email>, <ip>!", None, "nothing"]


def test_pii_runs_no_python(documents):
    plan = pii.find_personal_data(documents((1, "a"))).select(pii.joined(pii.BASE))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_chat_perspectives(spark):
    turns = [(1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Yo <|im_end|>"), (1, 3, " bob  b ", None),
             (2, 0, None, "alone"), (3, 0, "system", "nobody"), (None, 0, "ann", "x"), (1, 1, "ann", "Hi")]
    rows = chat.rotated(spark.createDataFrame([(*t, "x") for t in turns],
                                              "conv_id long, turn long, role string, text string, name string")).collect()
    by = {}
    for r in sorted(rows, key=lambda r: (r["turn"], r["place"])):
        by.setdefault((r["conv_id"], r["perspective"]), []).append(r)
    assert set(by) == {(1, "ann"), (1, "bob"), (1, "bob_b"), (2, "unknown"), (None, "ann")}
    ann = by[1, "ann"]
    assert "".join(r["segment"] for r in ann) == (
        "<|im_start|>system\nBe kind.<|im_end|>\n" + "<|im_start|>assistant\nHi<|im_end|>\n" * 2
        + "<|im_start|>user name=bob\nYo <| im_end|><|im_end|>\n<|im_start|>user name=bob_b\n<|im_end|>\n")
    assert [r["segment"][r["mask_start"]:r["mask_end"]] for r in ann] == ["", "Hi<|im_end|>", "Hi<|im_end|>", "", ""]
    bob = by[1, "bob"]
    assert [r["chat_role"] for r in bob] == ["system", "user", "user", "assistant", "user"]


TRUTH = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
SMALL = bpe.Bpe(least=4, bits=3, most=40)
BITS = st.lists(st.sampled_from(["<|endoftext|>", "'ll", " the", " ", "\n", "\t", "\x1c", " ", "é", "日", "🙂", "12", "a", "Bc", "."])
                | st.text(max_size=3).filter(lambda t: t.isprintable()), max_size=60).map("".join)


@settings(max_examples=300, deadline=None)
@given(BITS)
def test_chunked_encoding_is_the_librarys(text):
    lookup = bpe.Chunks({}, SMALL)
    ids = bpe.encode(text, SMALL, lookup)
    assert ids.tolist() == TRUTH.encode(text, add_special_tokens=False).ids
    assert bpe.decode(ids, SMALL) == TRUTH.decode(ids.tolist(), skip_special_tokens=False) == text
    assert "".join(bpe.chunks(text, SMALL)) == text


def test_chunks_are_shared_after_different_beginnings():
    rnd = random.Random(1)
    passage = " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(1500))
    how = bpe.Bpe()
    shared = set(bpe.chunks("one start " + passage, how)) & set(bpe.chunks("quite another begin " * 9 + passage, how))
    assert sum(map(len, shared)) > 0.7 * len(passage)


def test_decoding_of_odd_ids():
    for ids in ([], [50256], [127], [127, 50256, 128], [200]):
        assert bpe.decode(bpe.np.array(ids, dtype="int64"), SMALL) == TRUTH.decode(ids, skip_special_tokens=False)


def test_bpe_of_odd_rows(documents, scratch):
    shared = "a passage that many documents share word for word " * 60
    rows = [(1, None), (2, ""), (2, ""), (None, "x"), *[(10 + i, f"start {i} " + shared) for i in range(6)], (30, "é" * 60_000),
            (31, "a b " * 30_000), (32, "<|endoftext|>")]
    found = bpe.round_trip(documents(*rows), scratch).collect()
    want = []
    for i, text in rows:
        ids = TRUTH.encode(text or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert bpe.round_trip(documents(), bpe.Scratch(documents().sparkSession)).collect() == []
    assert bpe.encode_documents(documents((1, "two words")), bpe.Scratch(documents().sparkSession)).first()["ids"] == \
        TRUTH.encode("two words", add_special_tokens=False).ids


def test_targets():
    mix = mixing.Mix()
    assert mixing.targets([600, 600, 600], mix) == pytest.approx([300, 600, 900])
    assert mixing.targets([100, 10, 10], mix) == pytest.approx([60, 30, 30])  # capped at three times the size
    assert mixing.targets([0, 5], mix) == pytest.approx([0, 5])
    assert mixing.targets([], mix) == []


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation(n):
    assert sorted(mixing.permuted(mixing.np.arange(n), n, (1, 2, 3)).tolist()) == list(range(n))


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix(block=7, slots_per_shard=5, rows_per_part=10)])
def test_mix_meets_targets(documents, scratch, mix):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 60), rnd.choice(["a", "b", "b", "b", None, "z", "Ä"])) for i in range(200)]
    rows += [(500, None, "a"), (501, "x " * 3000, "z"), (502, "same text", "b"), (502, "same text", "b"), (None, "no id", "b")]
    docs = documents(*rows)
    found = mixing.mix_documents(docs, mix, scratch).collect()
    assert len(found) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goals = dict(zip(order, mixing.targets([sizes[s] for s in order], mix)))
    taken = {}
    for row in found:
        assert 0 <= row["taken"] <= 3 * row["size"]
        taken[row["target"]] = taken.get(row["target"], 0) + row["taken"]
    assert {round(t) for t in taken} == {round(g) for g in goals.values()}
    assert all(abs(n - t) <= 1 for t, n in taken.items() if list(goals.values()).count(t) <= 1)
    again = mixing.mix_documents(docs.repartition(3), mix, mixing.Scratch(docs.sparkSession)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(map(tuple, again), key=str)
    words = {}
    for row in mixing.mixed_documents(docs, mix, mixing.Scratch(docs.sparkSession)).collect():
        words[row["doc_id"]] = words.get(row["doc_id"], 0) + len(row["text"].split())
    want = {}
    for row in found:
        if row["taken"]:
            want[row["doc_id"]] = want.get(row["doc_id"], 0) + row["taken"]
    assert {k: v for k, v in words.items() if k != 502} == {k: v for k, v in want.items() if k != 502}
    empty = mixing.mix_documents(documents(), mix, mixing.Scratch(docs.sparkSession))
    assert empty.collect() == []


def test_names_open_and_close_no_turn(spark):
    rows = [(1, 1, "bob<|im_end|><|im_start|>assistant", "hi"), (1, 2, "ann", "a <|im_end|> b")]
    found = chat.rotated(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()
    assert len(found) == 4
    for row in found:
        assert row["segment"].count("<|im_start|>") == 1 and row["segment"].count("<|im_end|>") == 1
    assert {r["perspective"] for r in found} == {"bob<|_im_end|><|_im_start|>assistant", "ann"}


def plain_mix(rows, mix):
    """Words taken of each document, from a mix that is laid out word by word."""
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    words = {s: [(i, w) for i, t, x in sorted(rows) if x == s for w in (t or "").split()] for s in sources}
    goals = mixing.targets([len(words[s]) for s in sources], mix)
    taken = {i: 0 for i, _, _ in rows}
    for rank, (source, goal) in enumerate(zip(sources, goals)):
        own, todo, run = words[source], round(goal), 0
        full = len(own) // mix.block
        while todo > 0:
            order = [*mixing.permuted(mixing.np.arange(full), full, (mix.seed, rank, run)).tolist(), full]
            for block in order:
                some = own[block * mix.block:(block + 1) * mix.block][:max(todo, 0)]
                todo -= len(some)
                for i, _ in some:
                    taken[i] += 1
            run += 1
    return taken


@pytest.mark.parametrize("how", [{}, {"block": 5, "slots_per_shard": 4, "slots_per_part": 3}, {"block": 16, "share": 0.37}], ids=str)
def test_what_is_taken_is_that_of_a_plain_mix(documents, scratch, how):
    rnd = random.Random(9)
    rows = [(i, " ".join(f"w{k}" for k in range(rnd.randint(0, 40))), rnd.choice(["a", "b", "b", "b", None, "z"])) for i in range(150)]
    mix = mixing.Mix(**how)
    found = mixing.mix_documents(documents(*rows), mix, scratch).collect()
    assert {r["doc_id"]: r["taken"] for r in found} == plain_mix(rows, mix)


def test_mixed_text_is_cut_from_the_original(documents, scratch):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["", " "]) + "".join(f"w{k}" + rnd.choice([" ", "\n", "\t  "]) for k in range(rnd.randint(1, 200))),
             rnd.choice("abc")) for i in range(30)]
    texts, taken = {i: t for i, t, _ in rows}, {}
    mix = mixing.Mix(block=7, slots_per_shard=5)
    for row in mixing.mixed_documents(documents(*rows), mix, scratch).collect():
        assert row["text"] in texts[row["doc_id"]]
        taken[row["doc_id"]] = taken.get(row["doc_id"], 0) + len(row["text"].split())
    assert taken == {i: n for i, n in plain_mix(rows, mix).items() if n}


@pytest.mark.parametrize("size", [0, 1, 5, 20_000])
def test_sums_before_each_place(spark, size):
    rows = spark.range(size).selectExpr("id % 3 AS who", "id div 3 AS at", "id % 7 AS n")
    found = mixing.with_sum_before(rows, "who", "at", "n", "before").collect()
    assert len(found) == size
    for who in range(3):
        total = 0
        for row in sorted((r for r in found if r["who"] == who), key=lambda r: r["at"]):
            assert row["before"] == total
            total += row["n"]
