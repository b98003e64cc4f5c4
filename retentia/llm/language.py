"""Language identification by string kernels.

The kernel of two texts is the share of character n-grams of several lengths that both hold (a blended-spectrum
presence kernel, normalised). A sample of labelled rows gives the landmarks of a Nyström approximation, and
one-versus-rest kernel ridge regression is solved in that space. Scoring is two matrix products per batch: n-gram
presence by landmarks, then landmarks by languages.

The n-grams are hashed to ``bins`` presence bits. The classifier is fitted on at most ``sample`` labelled rows;
scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, draw, releasing

UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
ROWS_AT_ONCE = 128
MULTIPLIER = np.uint32(2654435761)


@dataclass(frozen=True)
class KernelSettings:
    lengths: tuple[int, ...] = (1, 2, 3)
    bins: int = 1 << 14
    sample: int = 1200  # labelled rows used for the fit, all languages together
    landmarks: int = 240
    ridge: float = 0.1
    seed: int = 8


@dataclass(frozen=True)
class KernelModel:
    settings: KernelSettings
    languages: tuple[str, ...]
    landmarks: np.ndarray  # packed presence bits, one row per landmark
    weights: np.ndarray  # landmarks by languages


def presence_bits(texts: list[str], settings: KernelSettings, out: np.ndarray | None = None) -> np.ndarray:
    """Rows by bins: 1 where a text holds an n-gram of that bin. Whole texts, lower case."""
    rows = np.zeros((len(texts), settings.bins), np.float32) if out is None else out
    shift = np.uint32(32 - (settings.bins.bit_length() - 1))
    for row, text in zip(rows, texts):
        code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        gram = np.zeros(len(code) + 1, np.uint32)
        for length in range(1, max(settings.lengths) + 1):
            if len(code) < length:
                break
            gram = gram[: len(code) - length + 1] * np.uint32(1000003) + code[length - 1 :] + np.uint32(1)
            if length in settings.lengths:
                row[(gram * MULTIPLIER) >> shift] = 1
    return rows


def _unpacked(bits: np.ndarray, bins: int) -> np.ndarray:
    return np.unpackbits(bits, axis=1, count=bins).astype(np.float32)


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None, :]
    return (a @ b.T) / norm


def _presence_rows(settings: KernelSettings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), ROWS_AT_ONCE):
                bits = np.packbits(presence_bits(texts[at : at + ROWS_AT_ONCE], settings).astype(bool), axis=1)
                labels = batch.column("lang").slice(at, ROWS_AT_ONCE)
                yield pa.RecordBatch.from_arrays([labels, pa.array([r.tobytes() for r in bits], pa.binary())], ["lang", "bits"])

    return run


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: KernelSettings = KernelSettings()) -> KernelModel:
    """Fit on at most ``settings.sample`` rows, spread evenly over the languages and picked by a hash of the key.

    Rows without text or language are not used. Each chosen row sends its presence bits, 1/8 byte per bin, to
    the driver. No labelled row gives a model without languages.
    """
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0))
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), draw(settings.seed, "sample", F.col(key)).alias("place"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return KernelModel(settings, (), np.zeros((0, settings.bins // 8), np.uint8), np.zeros((0, 0), np.float32))
    each = max(1, settings.sample // len(counts))
    # About twice the wanted rows pass a cut on the hash, so that no language is sorted whole.
    cut = F.create_map(*[F.lit(x) for n in counts for x in (n, min(1.0, (2 * each + 50) / counts[n]))])
    near = rows.where(F.col("place").cast("double") / F.lit(float(1 << 60)) <= F.element_at(cut, F.col("lang")))
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("place", "text")))
    chosen = ranked.where(F.col("rank") <= each).select("text", "lang", "place")
    picked = chosen.orderBy("place", "lang").mapInArrow(releasing(_presence_rows(settings)), "lang string, bits binary").collect()
    languages = tuple(sorted(counts))
    bits = np.stack([np.frombuffer(r["bits"], np.uint8) for r in picked])
    truth = np.array([[float(r["lang"] == n) for n in languages] for r in picked], np.float64)
    return _solve(bits, truth, languages, settings)


def _solve(bits: np.ndarray, truth: np.ndarray, languages: tuple[str, ...], settings: KernelSettings) -> KernelModel:
    # Rows stand in hash order; the landmarks are the first of each language in turn.
    by_language = [np.flatnonzero(truth[:, i])[: max(1, settings.landmarks // len(languages))] for i in range(len(languages))]
    marks = bits[np.sort(np.concatenate(by_language))]
    features, landmarks = _unpacked(bits, settings.bins), _unpacked(marks, settings.bins)
    inner = _kernel(landmarks, landmarks).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    useful = values > 1e-6 * values.max()
    root = vectors[:, useful] / np.sqrt(values[useful])
    mapped = _kernel(features, landmarks).astype(np.float64) @ root
    # Every language weighs the same, however many rows the sample holds of it.
    weight = (truth / truth.sum(0)).sum(1)[:, None] * len(truth) / len(languages)
    left = mapped.T @ (weight * mapped) + settings.ridge * np.eye(mapped.shape[1])
    ridge = np.linalg.solve(left, mapped.T @ (weight * truth))
    return KernelModel(settings, languages, marks, (root @ ridge).astype(np.float32))


def _scored_rows(model: KernelModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = np.empty((ROWS_AT_ONCE, model.settings.bins), np.float32)
        landmarks = _unpacked(model.landmarks, model.settings.bins)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            places = [i for i, t in enumerate(texts) if t is not None and model.languages and LETTER.search(t)]
            for at in range(0, len(places), ROWS_AT_ONCE):
                some = places[at : at + ROWS_AT_ONCE]
                rows = buffer[: len(some)]
                rows[:] = 0
                result = _kernel(presence_bits([texts[i] for i in some], model.settings, rows), landmarks) @ model.weights
                best = result.argmax(1)
                for i, b, s in zip(some, best, result[np.arange(len(some)), best]):
                    names[i], scores[i] = model.languages[b], min(1.0, max(0.0, float(s)))
            rest = [batch.column(c) for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*[c for c in batch.schema.names if c != "text"], "_pred", "_score"])

    return run


def identify(docs: DataFrame, model: KernelModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) with ``lang_pred`` and ``score``; existing columns of these names are replaced.

    ``und`` with score 0 where the text is null, empty or has no letter, or the model knows no language. Each row is
    scored from its own text alone, so repeated rows agree; ties go to the first language by name. Texts of any length are read whole.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    bounded_batches(docs.sparkSession)
    row = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    schema = f"row {row.schema['row'].dataType.simpleString()}, _pred string, _score double"
    scored = row.mapInArrow(releasing(_scored_rows(model)), schema)
    return scored.select("row.*", F.col("_pred").alias("lang_pred"), F.col("_score").alias("score"))


def held_out(key: Column) -> Column:
    """The rows no model learns from: crc32 of the key as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def with_language(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", settings: KernelSettings = KernelSettings()) -> DataFrame:
    """Fit on the rows that are not held out, then score all rows. An empty table stays empty."""
    model = fit(docs.where(~held_out(F.col(key))), key, text, lang, settings)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    return identify(rows, model, "text", ["doc_id", "held_out"])
