"""Texts across the borders of pieces and chunks, buckets across the borders of blocks, clashing names, frequent keys."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retentia.llm import bpe, fingerprints, language, licenses, linededup, mixing, neardup, repeats, sharding
from retentia.llm.texthash import PIECE

MEGABYTE = 1 << 20


def long_words(seed, size):
    rng = random.Random(seed)
    parts, n = [], 0
    while n < size:
        parts.append("".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 9))))
        n += len(parts[-1].encode()) + 1
    return parts


@pytest.fixture(scope="module")
def long_text():
    """3 MB, with a license phrase across the end of the first piece."""
    parts, n = long_words(1, 3 * MEGABYTE), 0
    for i, w in enumerate(parts):
        n += len(w.encode()) + 1
        if n > PIECE - 12:
            return " ".join([*parts[:i], *"under the mit license".split(), *parts[i:]])


@pytest.fixture(scope="module")
def long_docs(spark, long_text):
    other = " ".join(long_words(2, MEGABYTE))
    rows = [(1, long_text, "a"), (2, long_text[:1000] + "x" + long_text[1000:], "a"), (3, other, None), (4, "short", "b"), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)


def test_long_texts_in_sharding_and_mixing(long_docs, long_text):
    assert sharding.assign_shards(long_docs, "doc_id", ["x", "y"], 101).count() == 5
    sizes = {r["doc_id"]: r["size"] for r in mixing.mix_counts(long_docs).collect()}
    assert sizes[1] == len(long_text.split()) and sizes[4] == 1 and sizes[5] == 0


def test_long_texts_in_the_license_scan(spark):
    """A phrase at the end of 40,000 words."""
    words = long_words(5, MEGABYTE // 4)
    docs = spark.createDataFrame([(1, " ".join([*words, "under", "the", "MIT", "license"])), (2, " ".join(words))], "doc_id long, text string")
    out = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    assert (out[1]["n_words"], out[1]["n_base"], out[1]["first_word"], out[1]["base_labels"]) == (len(words) + 4, 1, len(words) + 1, "mit")
    assert (out[2]["n_words"], out[2]["n_base"]) == (len(words), 0)


def test_long_texts_in_near_duplicates(long_docs):
    out = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(long_docs).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5}


def test_long_texts_in_bpe(spark):
    """Three texts that fill more than one chunk together, one of them more than a chunk alone."""
    path = public_tokenizers.path("word_bpe_49k.json")
    content, library = bpe.load(path), Tokenizer.from_file(path)
    texts = [" ".join(long_words(i, n)) for i, n in enumerate((100, bpe.CHUNK_BYTES + 5000, MEGABYTE))]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    for r in bpe.decode(bpe.encode(docs, content), content).collect():
        want = library.encode(texts[r["id"]], add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_whole_table_in_bpe(spark):
    """Every document of the small table against the library."""
    from compare import DATA

    path = public_tokenizers.path("word_bpe_49k.json")
    content, library = bpe.load(path), Tokenizer.from_file(path)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, content), content).collect()
    assert len(out) == docs.count()
    for r in out:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == want and r["decoded"] == library.decode(want, skip_special_tokens=False)


def test_long_texts_of_equal_lines(spark):
    texts = [(1, "same line\n" * 30_000), (2, "first\n" + "same line\n" * 30_000 + "last")]
    out = {r["row"]["doc_id"]: r for r in linededup.dedup_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    # The first run of two stays; all later ones go, each a line further on.
    assert (out[1]["n_lines"], out[1]["kept"]) == (30_001, "same line\n") and out[2]["kept"] == "first\nlast"


def test_long_texts_in_fingerprints_and_language(spark, long_docs, long_text):
    out = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(long_docs).collect()}
    third = len(long_text) // 3
    assert out[1]["n_chars"] == len(long_text)
    assert out[1]["edited_sha256"] == hashlib.sha256(long_text[: len(long_text) - third].encode()).hexdigest()  # the next text is empty
    train = spark.createDataFrame([(i, ("the cat and the dog " if i % 2 else "der hund und die katze ") * 3, "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, lang string")
    model = language.fit(train)
    asked = spark.createDataFrame([(1, "the dog and the cat " * 200_000), (2, "die katze und der hund " * 200_000)], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.identify(asked, model).orderBy("doc_id").collect()] == ["en", "de"]


def test_long_texts_in_byte_repeats(spark, long_text):
    """A passage that lies across the end of a piece in one text and inside another."""
    raw = long_text.encode()
    at = len(raw[: PIECE - 300].decode(errors="ignore"))
    passage = long_text[at : at + 700]
    docs = spark.createDataFrame([(1, long_text), (2, "before " + passage + " after")], "doc_id long, text string")
    out = {r["row"]["doc_id"]: r for r in repeats.remove_repeats(docs).collect()}
    n = len(passage.encode())
    assert (out[1]["n_removed"], out[1]["n_spans"]) == (n, 1) and bytes(out[2]["kept"]) == b"before  after"
    assert bytes(out[1]["kept"]) == long_text.replace(passage, "", 1).encode()


def families(n):
    """Texts of three families whose sketches share bands: near copies within a family, no links between them."""
    rng = random.Random(n)
    base = [f"w{i}" for i in range(120)]
    heads = [base, base[:-32] + [f"u{i}" for i in range(32)], [f"v{i}" for i in range(32)] + base[32:]]
    texts = []
    for i in range(n):
        words = list(heads[i % 3])
        if i % 5 == 4:  # a text of its own
            words[20:80] = [f"own{i}-{j}" for j in range(60)]
        words[rng.randint(40, 60)] = f"x{i}"
        texts.append(" ".join(words))
    return texts


def components_by_brute_force(texts, settings):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    label = list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if settings.threshold[1] * both >= settings.threshold[0] * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("block", [16, 512])
def test_buckets_of_several_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = families(150)
    settings = neardup.NearDuplicates()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = neardup._Finder(docs, "doc_id", "text", settings).members()
    assert members.agg(F.max("size")).first()[0] > 16
    out = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, settings=settings).collect()}
    assert [out[i] for i in range(len(texts))] == components_by_brute_force(texts, settings)


def test_a_bucket_beyond_a_block_of_full_size(spark):
    texts = families(2000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    members = neardup._Finder(docs, "doc_id", "text", neardup.NearDuplicates()).members()
    assert members.agg(F.max("size")).first()[0] > neardup.BLOCK
    out = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs).collect()}
    # Texts of the same family are linked by their heads; the others stand alone.
    assert {out[i] for i in range(2000) if i % 5 != 4} == {0, 1, 2} and all(out[i] == i for i in range(2000) if i % 5 == 4)


def test_clashing_names_are_kept_apart(spark):
    docs = spark.createDataFrame([(1, "a b c", "s", 9, 8)], "doc_id long, text string, source string, size int, copies int")
    row = mixing.mix_counts(docs, keep=["size", "copies", "source"]).first()
    assert (row["size"], row["kept_size"], row["kept_copies"], row["source"]) == (3, 9, 8, "s")


def test_half_of_the_keys_null(spark):
    docs = spark.range(400).selectExpr("case when id % 2 = 0 then null else id end as doc_id", "concat('text ', cast(id as string), ' of some words') as text", "'s' as source")
    assert mixing.mix_counts(docs).agg(F.sum("copies")).first()[0] == 400
    out = fingerprints.edited_fingerprints(docs).collect()
    assert len(out) == 400 and sum(r["doc_id"] is None for r in out) == 200
    assert np.isfinite([r["near_next"] for r in out]).all()
