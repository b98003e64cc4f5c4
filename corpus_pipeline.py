"""A corpus pipeline over ``documents``: five stages, each one operator of ``retentia.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentia.llm import bpe, language, linededup, mixing, neardup
from retentia.llm.common import documents, fresh, written

#: The general rule for near duplicates on word shingles; 85/100 is the contract of op4's query alone. A pair at 0.8 misses all
#: 32 bands with a chance of 5e-8, and the slack is 5.1 deviations of the estimate.
NEAR = neardup.NearDuplicates(words=5, threshold=(80, 100), rows=4, slack=0.18)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null, empty and letterless texts go. Rows held out of the fit are scored like all others.

    Ties go to the language that comes first by name. Texts of any length are read whole, repeated rows are judged alike, other columns stay, and an
    empty table stays empty.
    """
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    scored = language.identify(docs.select(F.struct("*").alias("row"), "text"), model, keep=["row"])
    return scored.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; ``n_chars`` follows. A document of which nothing is left goes.

    Null and empty texts stay as they are. Repeated rows are one document and lose the same lines. Texts of any length are read whole,
    other columns stay, and an empty table stays empty.
    """
    done = linededup.dedup_lines(docs)
    left = done.where(~((F.col("n_removed") > 0) & (F.trim("kept") == "")))
    changed = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {"text": F.col("kept")}
    return left.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (links of similarity 0.8 or more), the one with the smallest id.

    Rows without an id stay. Rows that share an id but not the text are documents of their own; of rows that share both
    one stays, and of near copies with the same smallest id the one with the smallest key. Null and empty texts are nobody's copies.
    Texts of any length are compared whole, other columns stay, and an empty table stays empty.
    """
    own = fresh(docs, "_near_dedup_key")
    keyed = docs.withColumn(own, F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")))
    groups = neardup.near_duplicates(keyed, key=own, settings=NEAR).select(F.col("doc_id").alias(own), "component_id").distinct()
    ids = keyed.select(own, "doc_id").join(groups, own)
    kept = written(ids.groupBy("component_id").agg(F.min(F.struct("doc_id", own)).alias("first")).select(f"first.{own}"), "kept-keys")
    named = keyed.join(kept, own, "left_semi")
    same = Window.partitionBy(own, "doc_id", F.md5("text")).orderBy(F.xxhash64(*docs.columns))  # texts whose keys clash all stay
    named = named.withColumn(place := fresh(keyed, "_near_dedup_place"), F.row_number().over(same)).where(F.col(place) == 1)
    return named.select(*docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them.

    Null and empty texts have size 0. A null source is a source of its own, the last. Documents of equal size stand in order of a hash of their id,
    repeated rows count one by one, texts of any length count whole, other columns stay, and an empty table stays empty.
    """
    return mixing.mix(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and what the ids decode to.

    Null and empty texts have no ids and decode to the empty text. Repeated rows stay, texts of any length are encoded whole, other columns go, and an
    empty table stays empty.
    """
    import public_tokenizers  # only this stage needs the vocabulary files

    content = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    encoded = bpe.encode(docs, content, keep=["doc_id", "lang", "source"])
    return bpe.decode(encoded, content).select("doc_id", "lang", "source", F.size("ids").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

#: The first stage fits a classifier, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each but the last is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
