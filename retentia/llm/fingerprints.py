"""Document fingerprints by I-Match over several randomised lexicons.

The lexicon holds the terms within a band of inverse document frequency. Each of several random subsets of it,
from one half to a few thousandths, gives one hash of the text's distinct terms in that subset. The hash is the
exclusive or of the terms' own hashes, which doesn't depend on their order and so stands for hashing the sorted
terms; it adds up on the map side. Large subsets tell nearly equal texts apart, small ones still agree after larger edits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.functions.ordered import with_range
from retentia.llm.common import written
from retentia.llm.licenses import WORD

BROADCAST_TERMS = 1_000_000


@dataclass(frozen=True)
class MatchSettings:
    common: float = 0.2  # terms in more than this share of the documents are left out
    rare: float = 0.001  # and terms in less, or in one document; so a lexicon has at most (terms per document) / rare terms
    each: int = 4  # subsets per size
    halvings: int = 8  # sizes: 1/2, 1/4, ... of the lexicon
    seed: int = 7

    @property
    def subsets(self) -> int:
        return self.each * self.halvings


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def _terms(text: Column) -> Column:
    """The distinct words, in lower case."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    return F.array_distinct(F.transform(words, lambda w: F.lower(w)))


def lexicon(docs: DataFrame, text: str = "text", settings: MatchSettings = MatchSettings()) -> DataFrame:
    """(term, code, subsets): the terms of the band over all documents; ``subsets`` has a bit per subset."""
    total = docs.count()
    counts = docs.select(F.explode(_terms(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    band = counts.where((F.col("n") >= 2) & (F.col("n") >= settings.rare * total) & (F.col("n") <= settings.common * total))
    bits = [
        F.when(_hash(F.concat(F.lit(f"{settings.seed}:{i}:"), F.col("term"))) % (2 ** (i // settings.each + 1)) == 0, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        for i in range(settings.subsets)
    ]
    return written(band.select("term", _hash(F.concat(F.lit(f"{settings.seed}:"), F.col("term"))).alias("code"), sum(bits[1:], bits[0]).alias("subsets")), "lexicon")


def fingerprint_texts(texts: DataFrame, keys: list[str], text: str, terms: DataFrame, settings: MatchSettings = MatchSettings(), info: Column | None = None) -> DataFrame:
    """(*keys, fingerprint, info) for texts with distinct keys.

    A fingerprint lists a hash per subset, ``-`` where the text has no term of it. A text without any term of the
    lexicon gets the hash of itself instead, so that equal texts always agree.
    """
    info = F.lit(None).cast("string") if info is None else info
    whole = F.struct(F.lit(None).cast("string").alias("term"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("whole"), info.alias("info"))
    kind = f"struct<term:string,whole:string,info:{texts.select(info).schema[0].dataType.simpleString()}>"
    # The last entry stands for the text itself; it alone carries what is not a term.
    single = F.transform(_terms(F.col(text)), lambda t: F.struct(t.alias("term"), F.lit(None).alias("whole"), F.lit(None).alias("info")).cast(kind))
    rows = texts.select(*keys, F.explode(F.concat(single, F.array(whole.cast(kind)))).alias("_t")).select(*keys, "_t.*")
    known = F.broadcast(terms) if terms.count() <= BROADCAST_TERMS else terms
    rows = rows.join(known, "term", "left").where(F.col("term").isNull() | F.col("code").isNotNull())
    hashes = [F.bit_xor(F.when(F.col("subsets").bitwiseAND(F.lit(1 << i)) != 0, F.col("code"))).alias(f"h{i}") for i in range(settings.subsets)]
    summed = rows.groupBy(*keys).agg(*hashes, F.max("whole").alias("whole"), F.max("info").alias("info"))
    parts = [F.coalesce(F.lower(F.hex(f"h{i}")), F.lit("-")) for i in range(settings.subsets)]
    some = F.coalesce(*[F.col(f"h{i}") for i in range(settings.subsets)]).isNotNull()
    return summed.select(*keys, F.when(some, F.concat_ws(".", *parts)).otherwise(F.concat(F.lit("text:"), F.col("whole"))).alias("fingerprint"), "info")


def likeness(a: Column, b: Column) -> Column:
    """Share of the subsets with a term of either text on which both agree; 1 for equal fingerprints."""
    pairs = F.arrays_zip(F.split(a, r"\.").alias("x"), F.split(b, r"\.").alias("y"))
    used = F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-"))
    same = F.filter(used, lambda p: p["x"] == p["y"])
    comparable = (F.size(F.split(a, r"\.")) == F.size(F.split(b, r"\."))) & (F.size(used) > 0)
    return F.when(a == b, F.lit(1.0)).when(comparable, F.size(same) / F.size(used)).otherwise(F.lit(0.0))


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(slice, place, next_slice, next_place, key, text, next_text): each row with the next one in descending key order.

    After the last row comes the first. Null keys come last; rows of equal key stand by a hash of their text. Keys
    are cut into ranges, as many as the session has shuffle partitions, rounded up to a power of two; the first row
    of a range is also given to the range before it.
    """
    spark = docs.sparkSession
    ranges = 1 << (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    cuts = rows.agg(F.percentile_approx("key", shares, 10 * ranges)).first()[0] or []
    cut = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    rows = with_range(rows.withColumn("cuts", cut), "key", "cuts", ranges, "low").drop("cuts")
    rows = rows.withColumn("slice", F.when(F.col("key").isNull(), ranges).otherwise(ranges - 1 - F.col("low"))).drop("low")
    # The first row of each range, and the range before it (for the first range: the last one).
    firsts = rows.groupBy("slice").agg(F.max("key").alias("first"))
    in_slice = Window.partitionBy("slice").orderBy(F.xxhash64("text"), "text")
    heads = rows.join(F.broadcast(firsts), "slice").where(F.col("key").eqNullSafe(F.col("first")))
    heads = heads.withColumn("n", F.row_number().over(in_slice)).where(F.col("n") == 1).drop("n", "first")
    order = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # a row per range
    before = firsts.select("slice", F.coalesce(F.lag("slice").over(Window.orderBy("slice")), F.last("slice").over(order)).alias("host"))
    guests = heads.join(F.broadcast(before), "slice")
    guests = guests.select("key", "text", F.col("host").alias("slice"), F.col("slice").alias("home"))
    placed = rows.withColumn("home", F.lit(None).cast("int")).unionByName(guests)
    own = Window.partitionBy("slice").orderBy(F.col("home").isNotNull(), F.col("key").desc_nulls_last(), F.xxhash64("text"), "text")
    placed = placed.withColumn("place", F.row_number().over(own)).withColumn("next_text", F.lead("text").over(own)).withColumn("_next", F.lead("home").over(own))
    placed = placed.where(F.col("home").isNull())
    return placed.select(
        "slice",
        "place",
        F.coalesce("_next", "slice").alias("next_slice"),
        F.when(F.col("_next").isNotNull(), 1).otherwise(F.col("place") + 1).alias("next_place"),
        F.col("key").alias(key),
        "text",
        "next_text",
    )


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", settings: MatchSettings = MatchSettings()) -> DataFrame:
    """Per row: key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last third of the text's characters replaced by as many first ones of the next row's text.
    Null texts are empty; the only row of a table is its own next row; repeated rows stand next to each other. Texts of any
    length count whole. An empty table gives an empty result. Columns other than key and text are not read, whatever their names.
    """
    terms = lexicon(docs, text, settings)
    rows = with_next(docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")))
    third = F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - third), F.substring(F.col("next_text"), F.lit(1), third))
    rows = rows.withColumn("edited", edited)
    about = F.struct("next_slice", "next_place", "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.col("text"), about.alias("about")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"), F.lit(None).cast(rows.select(about).schema[0].dataType).alias("about")))
    texts = rows.select("slice", "place", F.explode(kinds).alias("k")).select("slice", "place", "k.*")
    prints = fingerprint_texts(texts, ["slice", "place", "kind"], "text", terms, settings, F.col("about"))
    both = prints.groupBy("slice", "place").agg(
        F.max("info").alias("about"),
        F.max(F.when(F.col("kind") == 0, F.col("fingerprint"))).alias("fingerprint"),
        F.max(F.when(F.col("kind") == 1, F.col("fingerprint"))).alias("edited_fingerprint"),
    )
    both = written(both, "fingerprints")
    following = both.select(F.col("slice").alias("next_slice"), F.col("place").alias("next_place"), F.col("fingerprint").alias("next_fingerprint"))
    joined = both.select("about.*", "fingerprint", "edited_fingerprint").join(following, ["next_slice", "next_place"])
    return joined.select(
        F.col("doc_id").alias(key),
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
