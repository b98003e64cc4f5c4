import corpus_pipeline
import pytest
from compare import DATA
from pyspark.sql import functions as F

from retentia.llm.common import documents, written


def test_stages_pass_documents_on(spark):
    docs = documents(spark, DATA)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = written(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        if name in ("language_id", "line_dedup", "minhash_near_dedup"):
            assert 0.8 * before < docs.count() <= before


def test_near_copies_from_similarity_0_8_go(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles

    def changed(i, n):
        return " ".join(base[: 104 - n] + [f"x{i}-{j}" for j in range(n)])

    # 90 of 110 shingles are shared with the base, 89 of 111 and 88 of 112: 0.818, 0.802 and 0.786.
    texts = [(1, " ".join(base)), (2, changed(2, 10)), (3, changed(3, 11)), (4, changed(4, 12)), (5, "something else")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in corpus_pipeline.minhash_near_dedup(spark, docs, DATA).collect()) == [1, 4, 5]


def test_documents_that_share_an_id_go_only_as_near_copies(spark):
    base = [f"w{i}" for i in range(104)]
    near = " ".join(base[:-5] + ["x"] * 5)
    texts = [(1, "one clean text"), (1, "another clean text"), (1, "one clean text"), (2, " ".join(base)), (2, near), (3, near), (None, near), (None, "n")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    out = [(r["doc_id"], r["text"]) for r in corpus_pipeline.minhash_near_dedup(spark, docs, DATA).collect()]
    assert sorted(t for i, t in out if i == 1) == ["another clean text", "one clean text"]
    assert len([t for i, t in out if i == 2]) == 1 and not [t for i, t in out if i == 3]
    assert sorted(t for i, t in out if i is None) == sorted(["n", near])


EXTRA = {"row": "int", "size": "int", "kept": "string", "ids": "string", "place": "int", "score": "double", "_row": "string"}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_tables_and_extra_columns(spark, name, stage):
    docs = documents(spark, DATA)
    wide = docs.select("*", *[F.lit(None).cast(kind).alias(c) for c, kind in EXTRA.items()])
    wide = wide.withColumn("text", F.when(F.col("doc_id") % 97 == 0, F.lit(None)).when(F.col("doc_id") % 89 == 0, "").otherwise(F.col("text")))
    wide = written(wide.unionByName(wide.where("doc_id % 100 = 0")), "wide")  # repeated rows
    out, empty = stage(spark, wide, DATA), stage(spark, written(docs.limit(0), "empty"), DATA)
    assert empty.count() == 0
    if stage is corpus_pipeline.STAGES[-1][1]:
        assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"] and out.count() == wide.count()
    else:
        assert out.columns == wide.columns and empty.columns == docs.columns and 0 < out.count()


def test_no_document_is_lost_between_stages(spark):
    """What a stage keeps is what it was given, apart from what the stage is there to change."""
    docs = written(documents(spark, DATA), "docs")
    kept = written(corpus_pipeline.language_id(spark, docs, DATA), "kept")
    assert kept.exceptAll(docs).count() == 0
    shorter = written(corpus_pipeline.line_dedup(spark, kept, DATA), "shorter")
    both = shorter.select("doc_id", F.col("text").alias("short"), F.col("n_chars").alias("n")).join(kept, "doc_id")
    assert both.count() == shorter.count() and both.where("n <> length(short) OR length(short) > length(text)").count() == 0
    assert both.where("short = text").count() > 0.5 * both.count()
    single = written(corpus_pipeline.minhash_near_dedup(spark, shorter, DATA), "single")
    assert single.exceptAll(shorter).count() == 0
    mixed = written(corpus_pipeline.mix_sources(spark, single, DATA), "mixed")
    assert mixed.distinct().exceptAll(single.distinct()).count() == 0
    ids = corpus_pipeline.bpe_tokens(spark, mixed, DATA)
    assert ids.groupBy("doc_id").count().exceptAll(mixed.groupBy("doc_id").count()).count() == 0
