"""Small cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retentia.llm import bpe, fingerprints, language, licenses, linededup, mixing, neardup, repeats, sharding, topk
from retentia.llm.queries import QUERIES
from retentia.llm.texthash import WordHasher

SCHEMA = "doc_id long, text string, lang string, source string, size int, slot int, shard string, score double, lang_pred string, kept string, ids string, row int, place int"


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))


BASE = words(1, 200).split()
TEXTS = [
    (1, " ".join(BASE)),
    (2, " ".join(BASE[:100] + ["other"] + BASE[101:])),  # near copy
    (3, " ".join(BASE)),  # exact copy
    (4, words(2, 3000)),
    (5, "Under THE MIT License. Apache License, Version 2.0 <|endoftext|> x"),
    (5, "Under THE MIT License. Apache License, Version 2.0 <|endoftext|> x"),  # repeated row
    (6, ""),
    (7, None),
    (8, " \n\t \n"),
    (9, "!!! 123"),
    (None, "one two\nthree four\nfive six"),
    (10, "first\none two\nthree four\nfive six\nlast"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rest = (1, 2, "x", 0.5, "y", "z", "w", 3, 4)
    return spark.createDataFrame([(i, t, "en" if i and i % 2 else None, "s" if i and i < 6 else None, *rest) for i, t in TEXTS], SCHEMA)


def test_slots_are_claimed_in_turns(odd):
    names = [f"n{i}" for i in range(7)]
    owner = sharding.fill_slots(names, 101)
    counts = [owner.count(i) for i in range(7)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 101
    fewer = sharding.fill_slots(names[:-1], 101)
    assert sum(a == b for a, b in zip(owner, fewer)) > 60
    placed = sharding.assign_shards(odd, "doc_id", names, 101).collect()
    assert len(placed) == len(TEXTS) and all(r["shard"] == names[owner[r["slot"]]] for r in placed)
    assert sharding.assign_shards(odd.limit(0), "doc_id", names, 101).count() == 0
    with pytest.raises(ValueError, match="prime"):
        sharding.fill_slots(names, 100)


def test_mix_meets_targets(spark, odd):
    docs = spark.createDataFrame([(i, words(i, 1 + i % 9), "abc"[min(2, i // 100)]) for i in range(600)], "doc_id long, text string, source string")
    rows = mixing.mix_counts(docs, keep=["source"]).collect()
    for s in "abc":
        own = [r for r in rows if r["source"] == s]
        assert abs(sum(r["size"] * r["copies"] for r in own) - own[0]["target"]) <= 27 and max(r["copies"] for r in own) <= 3
    assert sum({r["source"]: r["target"] for r in rows}.values()) == pytest.approx(sum(r["size"] for r in rows))
    assert mixing.mix_counts(odd).count() == len(TEXTS)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.mix(odd.limit(0)).count() == 0


def test_license_places_and_labels(odd):
    out = licenses.scan_licenses(odd).collect()
    assert len(out) == len(TEXTS)
    five = [r for r in out if r["doc_id"] == 5]
    assert len(five) == 2 and five[0] == five[1]
    assert (five[0]["n_base"], five[0]["first_word"], five[0]["last_word"], five[0]["base_labels"]) == (2, 1, 4, "apache-2,mit")
    blank = next(r for r in out if r["doc_id"] == 7)
    assert (blank["n_words"], blank["n_base"], blank["first_word"], blank["labels"], blank["score"]) == (0, 0, None, "", 0.0)
    assert licenses.scan_licenses(odd.limit(0)).count() == 0


def test_near_duplicates(odd):
    out = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["kept"]) for r in neardup.near_duplicates(odd).collect()}
    assert out[(1, 196)] == (1, True) and out[(2, 196)] == (1, False) and out[(3, 196)] == (1, False)
    assert out[(6, 0)] == (6, True) and out[(7, 0)] == (7, True) and out[(8, 0)] == (8, True) and out[(None, 2)] == (None, True)


def test_equal_shingle_sets_are_one_class_and_bands_cover_all_registers(spark):
    settings, hasher = neardup.NearDuplicates(), WordHasher()

    def filled(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return np.flatnonzero(neardup.registers(settings.shingles(hasher(data, np.array([0, len(data)]))[0])))

    # Words whose only shingle falls into one of the last registers, and a word in another register.
    last = next(w for w in map("w{}".format, range(10_000)) if filled(" ".join([w] * 5))[0] >= 125)
    texts = {i: " ".join([w] * n) for i, (w, n) in enumerate([(last, 5), (last, 9), ("spam", 5), ("spam", 9), ("spam", 4)])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    out = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    assert out == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}
    for rows in (4, 5):
        settings = neardup.NearDuplicates(rows=rows)
        assert settings.bands * settings.rows >= neardup.REGISTERS
    # Different sets that meet in the last band alone: of 128 registers all but the last three differ.
    sketches = np.stack([np.arange(1, 129), np.arange(1001, 1129)]).astype(np.uint16)
    sketches[1, 125:] = sketches[0, 125:]
    members = neardup._Finder.__new__(neardup._Finder)
    members.settings = neardup.NearDuplicates()
    members.classes = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(sketches)], "id long, registers binary")
    assert [(r["id"], r["band"]) for r in members.members().orderBy("id").collect()] == [(0, 25), (1, 25)]


def test_bpe_equals_the_library(odd):
    path = public_tokenizers.path("word_bpe_49k.json")
    content, library = bpe.load(path), Tokenizer.from_file(path)
    out = bpe.decode(bpe.encode(odd, content, keep=["doc_id", "text"]), content).collect()
    assert len(out) == len(TEXTS)
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)
    assert bpe.encode(odd.limit(0), content, keep=["doc_id"]).count() == 0


def test_later_line_runs_go(odd):
    out = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(odd).collect()}
    assert out[10]["kept"] == "first\none two\nthree four\nfive six\nlast" and out[None]["kept"] == "" and out[None]["n_removed"] == 3
    assert out[7]["kept"] is None and out[6]["kept"] == "" and out[8]["n_removed"] == 0
    assert linededup.dedup_lines(odd.limit(0)).count() == 0


def test_runs_that_stood_earlier_go_whatever_stands_around_the_first_place(spark):
    texts = ["a\nb\nc", "x\nb\nd\ny", "p\nb\nd\nq", "k\n\n\n\n\n\n\nl", "k\n\n\n\n\n\n\nl\nm", "e\ne\ne", "c\n\nd\n", "r\nc\n\nd\n\n"]
    rng = random.Random(5)
    texts += ["\n".join(rng.choice(["f", "g", "h", "", " "]) for _ in range(rng.randint(1, 9))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for least in (1, 2, 3):
        seen, want = set(), {}
        for d, text in enumerate(texts):  # ids are in order; every stretch by brute force
            lines = [x.strip(" ") for x in text.split("\n")]
            gone = set()
            for a in range(len(lines)):
                for b in range(a + 1, len(lines) + 1):
                    if sum(x != "" for x in lines[a:b]) >= least:
                        if tuple(lines[a:b]) in seen:
                            gone.update(range(a, b))
                        seen.add(tuple(lines[a:b]))
            want[d] = (len(gone), "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone))
        out = linededup.dedup_lines(docs, settings=linededup.LineSettings(least=least)).collect()
        assert {r["row"]["doc_id"]: (r["n_removed"], r["kept"]) for r in out} == want


def test_fingerprints(odd):
    out = fingerprints.edited_fingerprints(odd).collect()
    assert len(out) == len(TEXTS)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["fingerprint"] == by_id[3]["fingerprint"] and all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in out)
    in_order = [t or "" for _, t in sorted(TEXTS, key=lambda x: -(x[0] or -1))]
    assert by_id[10]["edited_sha256"] == hashlib.sha256(edited(in_order[0], in_order[1]).encode()).hexdigest()
    assert by_id[None]["edited_sha256"] == hashlib.sha256(edited(in_order[-1], in_order[0]).encode()).hexdigest()
    assert fingerprints.edited_fingerprints(odd.limit(0)).count() == 0


def edited(text, following):
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def test_language(spark, odd):
    english, german = "the cat and the dog ", "der hund und die katze "
    train = spark.createDataFrame([(i, (english if i % 2 else german) * (1 + i % 5), "en" if i % 2 else "de") for i in range(60)], "doc_id long, text string, lang string")
    model = language.fit(train)
    asked = spark.createDataFrame([(1, "the dog"), (2, "und der hund"), (3, None), (4, ""), (5, "12 !?")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(asked, model).orderBy("doc_id").collect()] == ["en", "de", "und", "und", "und"]
    assert {r["lang_pred"] for r in language.with_language(odd).collect()} == {"en", "und"}
    assert language.with_language(odd.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.with_language(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_repeats_against_brute_force(spark, odd):
    rng = random.Random(9)
    shared = [words(100 + i, 60) for i in range(3)]
    texts = [words(i, rng.randint(1, 60)) + " " + rng.choice(shared)[: rng.randint(150, 400)] + words(50 + i, 20) for i in range(12)]
    texts += ["ab" * 200, "", None, "short", texts[0], texts[1][:220] + "é" + texts[1][221:]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    places = {}
    raw = [(t or "").encode() for t in texts]
    for d, b in enumerate(raw):
        for i in range(len(b) - 159):
            places.setdefault(b[i : i + 160], []).append((d, i))
    gone = [set() for _ in raw]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d].update(range(i, i + 160))
    for r in repeats.remove_repeats(docs, length=160, gram=40).collect():
        d = r["row"]["doc_id"]
        assert r["n_removed"] == len(gone[d]) and bytes(r["kept"]) == bytes(x for i, x in enumerate(raw[d]) if i not in gone[d])
    assert repeats.remove_repeats(odd).count() == len(TEXTS)
    assert repeats.remove_repeats(odd.limit(0)).count() == 0


def test_top_k_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(120)]
    rows += [(200, None), (201, [0.1, None, 0.2, 0.1, 0.1, 0.1]), (202, [float("nan")] * 6), (203, [float("inf")] * 6), (None, [0.1] * 6), (250, [0.5, 0.5])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.whole_vectors(table, "vec_id", "embedding", 256)
    whole = {r["vec_id"]: r["values"] for r in vectors.collect()}
    assert set(whole) == {*range(120), 250}
    out = topk.top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5).collect()
    for q in (0, 50, 100):
        scores = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == 6))[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, -s) for s, i in scores]
    assert {r["query_id"] for r in out} == {0, 50, 100}
    assert topk.top_k(vectors.limit(0), vectors.limit(0)).count() == 0


def test_license_query_counts_the_whole_phrases_of_its_contract(spark, tmp_path):
    """The license named without "under" is no base place, and a place starts at "under"."""
    texts = ["see the MIT License", "x, Under the MIT-License! under the mit license", "under the the mit license cc by nc by nc", "Apache License, Version 2.0", "under the mıt license", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r["doc_id"]: tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels")) for r in QUERIES["op3_license_scan"](spark, str(tmp_path)).collect()}
    none = (0, None, None, "", "")
    assert out == {0: (4, *none), 1: (9, 2, 1, 5, "mit", "mit"), 2: (10, 1, 5, 5, "cc-by-nc", "cc-by-nc"), 3: (5, 1, 0, 0, "apache-2", "apache-2"), 4: (4, *none), 5: (0, *none)}
