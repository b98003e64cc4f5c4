"""BPE encoding and decoding through a table of distinct words.

Texts are cut at ASCII white space, which no token of the tokenizer crosses. Documents stand in chunks of a few
megabytes. A chunk asks for its distinct words; the words of all chunks meet by hash, where each distinct word
is encoded once; the ids go back to the chunks that asked and are joined to their words by position. What moves
is one word per chunk and distinct word, and the packed chunks, not one row per occurrence. Decoding joins ids
to their pieces.

Chunks are named by their content, so both passes over the documents agree on them. ``docs`` is read twice and
must give the same rows in the same partitions both times, as a stored table does; else the run fails.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentia.llm.common import bounded_batches, release_memory, releasing

CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20  # of text per bucket of the word table
WORDS_AT_ONCE = 5_000
TOKENS_AT_ONCE = 1 << 19


def load(path: str) -> str:
    """The tokenizer file's content, which tasks get with their code; the path is needed on the driver only."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _tokenizer(content: str):
    """Made anew for each bucket of words, as one that a reused worker kept would hold 50 MB to its end."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    made = Tokenizer.from_str(content)
    made.no_truncation()
    made.no_padding()
    return made


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows of about CHUNK_BYTES of text, one row at least, wherever the batches begin and end."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        for i, n in enumerate(lengths):
            if size and size + n > CHUNK_BYTES:
                held.append(batch.slice(at, i - at))
                yield pa.Table.from_batches(held)
                held, size, at = [], 0, i
            size += int(n)
        held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _texts(chunk: pa.Table) -> list[bytes]:
    return [t or b"" for t in chunk.column("text").cast(pa.binary()).to_pylist()]


def _name(texts: list[bytes]) -> bytes:
    digest = hashlib.blake2b(digest_size=16)
    for t in texts:
        digest.update(len(t).to_bytes(8, "big") + t)
    return digest.digest()


def _distinct(texts: list[bytes], buckets: int) -> list[list[bytes]]:
    """The distinct words of a chunk by bucket, sorted."""
    words: set[bytes] = set()
    for t in texts:
        words.update(t.split())
    out: list[list[bytes]] = [[] for _ in range(buckets)]
    for w in sorted(words):
        out[zlib.crc32(w) % buckets].append(w)
    return out


def _requests(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            texts = _texts(chunk)
            asked = [(b, _pack(b"\n".join(words))) for b, words in enumerate(_distinct(texts, buckets)) if words]
            columns = [pa.array([b for b, _ in asked], pa.int32()), pa.array([_name(texts)] * len(asked), pa.binary()), pa.array([w for _, w in asked], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "words"])

    return run


def _encoded_bucket(content: str):
    def run(requests: pa.Table) -> pa.Table:
        tokenizer = _tokenizer(content)
        lists = [_unpack(w).split(b"\n") for w in requests.column("words").to_pylist()]
        table: dict[bytes, np.ndarray] = dict.fromkeys(w for words in lists for w in words)
        distinct = list(table)
        for at in range(0, len(distinct), WORDS_AT_ONCE):
            some = distinct[at : at + WORDS_AT_ONCE]
            for word, coded in zip(some, tokenizer.encode_batch([w.decode() for w in some], add_special_tokens=False)):
                table[word] = np.array(coded.ids, np.int32)
        del tokenizer
        sizes = [_pack(np.array([len(table[w]) for w in words], np.int32).tobytes()) for words in lists]
        ids = [_pack(np.concatenate([table[w] for w in words]).tobytes()) for words in lists]
        del lists, table, distinct
        release_memory()
        return pa.table({"chunk": requests.column("chunk"), "bucket": requests.column("bucket"), "sizes": pa.array(sizes, pa.binary()), "ids": pa.array(ids, pa.binary())})

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in _chunks(batches):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, chunk.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(chunk)
        columns = [pa.array([_name(_texts(chunk))], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "rows"])


def _assembled(buckets: int):
    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        out = []
        answers = {r["bucket"]: r for r in replies.to_pylist()}
        for blob in packed.column("rows").to_pylist():
            chunk = pa.ipc.open_stream(blob).read_all()
            texts = _texts(chunk)
            place: dict[bytes, int] = {}
            sizes, ids = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
            for bucket, words in enumerate(_distinct(texts, buckets)):
                if not words:
                    continue
                if bucket not in answers:
                    raise RuntimeError("the documents were cut into other chunks when they were read again; store them first")
                sizes.append(np.frombuffer(_unpack(answers[bucket]["sizes"]), np.int32))
                ids.append(np.frombuffer(_unpack(answers[bucket]["ids"]), np.int32))
                if len(sizes[-1]) != len(words):
                    raise RuntimeError("the replies don't fit the words that were asked for")
                place.update(zip(words, range(len(place), len(place) + len(words))))
            size, all_ids = np.concatenate(sizes).astype(np.int64), np.concatenate(ids)
            first = np.cumsum(size) - size
            rows, ends = [], [0]
            for t in texts:
                at = np.array([place[w] for w in t.split()], np.int64)
                n = size[at]
                before = np.cumsum(n) - n
                rows.append(all_ids[np.repeat(first[at] - before, n) + np.arange(n.sum())])
                ends.append(ends[-1] + len(rows[-1]))
            values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            out.append(chunk.drop_columns(["text"]).append_column("_ids", lists))
        release_memory()
        return pa.concat_tables(out) if out else pa.table({"row": [], "_ids": []})

    return run


def encode(docs: DataFrame, content: str, text: str = "text", keep: list[str] | None = None, ids: str = "ids") -> DataFrame:
    """``keep`` (all columns by default) with ``ids``: the token ids of each whole text, as the library encodes it
    without special tokens, truncation and padding.

    Null and empty texts and texts of white space get no ids. Repeated rows stay. Texts of any length are encoded whole; one longer
    than a chunk is a chunk of its own. A column of ``keep`` already
    named as ``ids`` is replaced. An empty table gives an empty result.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != ids.lower()]
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.struct(*keep).alias("row"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = int(max(16, total // BUCKET_BYTES))
    requests = rows.select("text").mapInArrow(releasing(_requests(buckets)), "bucket int, chunk binary, words binary")
    replies = requests.groupBy("bucket").applyInArrow(_encoded_bucket(content), "chunk binary, bucket int, sizes binary, ids binary")
    packed = rows.mapInArrow(releasing(_packed), "chunk binary, rows binary")
    schema = f"row {rows.schema['row'].dataType.simpleString()}, _ids array<int>"
    done = packed.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_assembled(buckets), schema)
    return done.select("row.*", F.col("_ids").alias(ids))


def pieces(content: str) -> list[str | None]:
    """Id to piece, special tokens included; null for an id that the vocabulary leaves out."""
    read = json.loads(content)
    named = dict(read["model"]["vocab"]) | {t["content"]: t["id"] for t in read["added_tokens"]}
    out: list[str | None] = [None] * (max(named.values()) + 1)
    for piece, i in named.items():
        out[i] = piece
    return out


def _decoded(table: list[str | None]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = pa.array(table, pa.string())
        for batch in batches:
            lists = batch.column("_ids").fill_null([])
            ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            at = 0
            while at < len(batch):
                end = max(at + 1, int(np.searchsorted(ends, ends[at] + TOKENS_AT_ONCE, "right")) - 1)
                part = lists.slice(at, end - at)
                joined = pa.ListArray.from_arrays(pa.array(ends[at : end + 1] - ends[at], pa.int32()), by_id.take(part.flatten()))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(at, end - at) for c in ("row", "_ids")], pc.binary_join(joined, " ")], ["row", "_ids", "_text"])
                at = end

    return run


def decode(encoded: DataFrame, content: str, ids: str = "ids", keep: list[str] | None = None, decoded: str = "decoded") -> DataFrame:
    """``keep`` (all columns by default) with ``decoded``: the pieces of the ids joined as the library does for a
    tokenizer without a decoder, by one space, special tokens included. No ids, or null, give the empty text. An
    id beyond the vocabulary is an error. A column of ``keep`` already named as ``decoded`` is replaced.
    """
    if json.loads(content).get("decoder"):
        raise ValueError("only tokenizers without a decoder step are supported")
    keep = [c for c in (encoded.columns if keep is None else keep) if c.lower() != decoded.lower()]
    bounded_batches(encoded.sparkSession)
    rows = encoded.select(F.struct(*keep).alias("row"), F.col(ids).alias("_ids"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, _ids array<int>, _text string"
    return rows.mapInArrow(releasing(_decoded(pieces(content))), schema).select("row.*", F.col("_text").alias(decoded))
