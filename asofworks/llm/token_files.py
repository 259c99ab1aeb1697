"""Operator 10: token ids of documents in Simple-8b files, written in ascending doc_id order."""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofworks.llm import simple8b
from asofworks.llm.store import read_table, shared_folder
from asofworks.llm.textbytes import SPACE, blocks, span_hashes
from asofworks.llm.units import UnitCache, gather

TOKENIZER = "byte_bpe_50k.json"
#: The id that ends each document.
END_ID = 0
#: Ids in a record of a file, at least; a record holds whole documents.
RECORD = 1 << 16

FILES = "part int, seq int, doc_ids array<long>, lengths array<long>, words binary, offsets binary, escapes binary"

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


@cache
def _tokenizer(name: str):  # noqa: ANN202
    """The tokenizer and the worker's cache for it; a path is taken as it is."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return tokenizer, UnitCache(aside=END_ID)


def _other_space(data: np.ndarray) -> np.ndarray:
    """Places of white space beyond ASCII, which the cut into units doesn't know: U+0085, 00A0, 1680, 2000-200A, 2028, 2029, 202F, 205F, 3000."""
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE1) | (data == 0xE2) | (data == 0xE3))
    a = data[lead]
    b = data[np.minimum(lead + 1, len(data) - 1)]
    c = data[np.minimum(lead + 2, len(data) - 1)]
    low = (c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)
    hit = (
        ((a == 0xC2) & ((b == 0x85) | (b == 0xA0)))
        | ((a == 0xE1) & (b == 0x9A) & (c == 0x80))
        | ((a == 0xE2) & (((b == 0x80) & low) | ((b == 0x81) & (c == 0x9F))))
        | ((a == 0xE3) & (b == 0x80) & (c == 0x80))
    )
    return lead[hit]


def token_ids(column: pa.Array, name: str = TOKENIZER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block of texts: their ids, each text's followed by END_ID, and the number of each.

    Units begin where a text does, where white space follows other text, and
    where ASCII punctuation follows an ASCII letter or digit: the tokenizer's
    pattern never reaches over such a place.  Texts with white space beyond
    ASCII are encoded whole.
    """
    tokenizer, units = _tokenizer(name)

    def encoded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.int32), np.array([len(ids) for ids in found], np.int64)

    for _, _, data, offsets in blocks(column):
        n = len(offsets) - 1
        begins = np.zeros(len(data), bool)
        if len(data):
            space = SPACE[data]
            begins[1:] = (space[1:] & ~space[:-1]) | (_PUNCTUATION[data[1:]] & _ALNUM[data[:-1]])
            begins[offsets[:-1][offsets[:-1] < len(data)]] = True
            odd = np.unique(np.searchsorted(offsets, _other_space(data), "right") - 1)
            for row in odd:
                begins[offsets[row] : offsets[row + 1]] = False
                begins[offsets[row]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        raw = data.tobytes()
        start, length = units.slots(
            span_hashes(data, starts, ends),
            lambda k: encoded([raw[a:b].decode() for a, b in zip(starts[k].tolist(), ends[k].tolist(), strict=True)]),  # noqa: B023
        )
        per_text = np.searchsorted(starts, offsets)
        # the end of a text is one more unit, whose id is the one set aside
        flat = gather(units.ids, np.insert(start, per_text[1:], 0), np.insert(length, per_text[1:], 1))
        total = np.concatenate([[0], np.cumsum(length)])
        yield flat, np.diff(total[per_text]) + np.ones(n, np.int64)


def _record(part: int, seq: int, doc_ids: list, lengths: list[np.ndarray], ids: list[np.ndarray]) -> pa.RecordBatch:
    words, offsets, escapes = simple8b.encode(np.concatenate(ids))
    of = lambda x, kind: pa.array([x], kind)
    return pa.record_batch(
        [of(part, pa.int32()), of(seq, pa.int32()), of(doc_ids, pa.list_(pa.int64())), of(np.concatenate(lengths), pa.list_(pa.int64())), of(words.tobytes(), pa.binary()), of(offsets.tobytes(), pa.binary()), of(escapes.tobytes(), pa.binary())],
        ["part", "seq", "doc_ids", "lengths", "words", "offsets", "escapes"],
    )


def _encoded(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    doc_ids, lengths, ids, held = [], [], [], 0
    for batch in batches:
        at = 0
        for flat, count in token_ids(batch.column(1), name):
            doc_ids += batch.column(0).slice(at, len(count)).to_pylist()
            lengths.append(count)
            ids.append(flat)
            at, held = at + len(count), held + len(flat)
            if held >= RECORD:
                yield _record(part, seq, doc_ids, lengths, ids)
                seq, doc_ids, lengths, ids, held = seq + 1, [], [], [], 0
    if lengths:
        yield _record(part, seq, doc_ids, lengths, ids)


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER) -> None:
    """Write the ids of each document, each followed by END_ID, in ascending doc_id order.

    Part files follow each other in doc_id order, and so do the records of a
    part: whole documents of some 65,536 ids, coded with Simple-8b.  A null
    text is empty, so only END_ID stands for it; null doc_ids come first; rows
    that repeat a doc_id are in the order of their texts.  Other columns are
    ignored.  An empty table makes files without records.
    """
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(lambda b: _encoded(b, tokenizer), FILES).write.option("compression", "none").parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths = np.array(row["lengths"], np.int64)
            of = lambda k, kind: np.frombuffer(row[k], kind)  # noqa: E731, B023
            ids = simple8b.decode(of("words", np.uint64), of("offsets", np.uint32), of("escapes", np.uint64), int(lengths.sum())).astype("<u4")
            ends = np.cumsum(lengths)
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), row["lengths"], strict=True)]
            yield pa.record_batch(
                [pa.array([row["part"]] * len(crc), pa.int32()), pa.array([row["seq"]] * len(crc), pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())],
                ["part", "seq", "doc_id", "before", "n_tokens", "ids_crc32"],
            )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document in the files of write_tokens()."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                of = lambda k, kind: np.frombuffer(row[k], kind)  # noqa: E731, B023
                ids = simple8b.decode(of("words", np.uint64), of("offsets", np.uint32), of("escapes", np.uint64), int(lengths.sum())).astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.record_batch([pa.array(row["doc_ids"], pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids))], ["doc_id", "ids"])

    return spark.read.schema(FILES).parquet(path).mapInArrow(each, "doc_id long, ids array<long>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of write_tokens().

    start counts the ids of all documents before it: of earlier parts (one sum
    for each part file), of earlier records of its part, and of its record.
    """
    files = spark.read.schema(FILES).parquet(path)
    records = files.select("part", "seq", F.expr("aggregate(lengths, 0L, (a, x) -> a + x)").alias("ids"))
    parts = records.groupBy("part").agg(F.sum("ids").alias("ids"))
    earlier = lambda w: F.coalesce(F.sum("ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", earlier(Window.orderBy("part")).alias("part_start"))
    records = records.select("part", "seq", earlier(Window.partitionBy("part").orderBy("seq")).alias("record_start"))
    decoded = files.mapInArrow(_decoded, "part int, seq int, doc_id long, before long, n_tokens long, ids_crc32 long")
    start = F.col("part_start") + F.col("record_start") + F.col("before")
    return decoded.join(records.join(parts, "part"), ["part", "seq"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def op10_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write_tokens(read_table(spark, sf_dir, "documents"), path)
    return read_digests(spark, path)
