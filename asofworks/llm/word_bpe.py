"""Operator 12: word-level BPE by tree concatenation, and decoding.

White space never gets into a token
of this tokenizer, so texts fall into units at ASCII white space (and where
ASCII punctuation follows an ASCII letter or digit); each unit is encoded once
per worker.  Inside a long unit the tokenizer's own rules find the words.  A
word longer than LEAF is halved again and again, the leaves are encoded each for
itself, and at each join a window around it is encoded again, growing until its
first token is the left side's there and its last the right side's.

Two encodings that overlap in a whole token can be joined there: BPE merges the
best pair first, from the left, and a merge that never crosses the borders of
that token can be told apart as belonging to one side or the other, so both
sides' merges, in their order, are the merges of the whole.  So the ids are
exactly those of the tokenizer.

Texts over LONG are dealt to many tasks: runs of units, and the halves' leaves
of long words; then each text's parts are joined.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from asofworks.llm.store import read_table
from asofworks.llm.textbytes import SPACE, blocks, span_hashes, spans
from asofworks.llm.units import UnitCache, gather

TOKENIZER = "word_bpe_49k.json"
#: Symbols (bytes) of a leaf; tokens on either side of a join that are encoded again first.
LEAF, WINDOW = 256, 4
#: Bytes of a text from which its parts go to several tasks, and bytes of a part, about.
LONG, PART = 1 << 16, 1 << 14
#: Ids that are decoded at once.
AT_ONCE = 1 << 16

#: Kinds of parts: a run of units; a piece of a word; a word's last piece.
RUN, PIECE, LAST = range(3)
_PARTS = "key string, seq int, kind int, part string"

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


class WordTokenizer:
    """The tokenizer, a cache of its units' ids, and its merges with and without the end of a word."""

    def __init__(self, name: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.path = path
        self.suffix = self.whole.model.end_of_word_suffix or ""
        vocab = self.whole.get_vocab(with_added_tokens=True)
        size = 1 + max(vocab.values())
        tokens = [""] * size
        for token, i in vocab.items():
            tokens[i] = token
        self.known = np.array([bool(t) for t in tokens])
        self.symbols = [t.removesuffix(self.suffix) for t in tokens]
        self.added = sorted((t.content for t in self.whole.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile(b"|".join(re.escape(t.encode()) for t in self.added)) if self.added else None
        # each token's text and a space, one after another
        spelt = [f"{t} ".encode() for t in tokens]
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.spelt_length = np.array([len(t) for t in spelt], np.int64)
        self.spelt_start = np.concatenate([[0], np.cumsum(self.spelt_length)[:-1]])
        self.units = UnitCache()

    @cached_property
    def inner(self):  # noqa: ANN201
        """The merges without the end of a word; only long words need them."""
        from tokenizers import models

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        return models.BPE(model["vocab"], [tuple(m) for m in model["merges"]])

    def _leaf(self, symbols: str, last: bool) -> list[int]:
        """The merges of one run of symbols, the last of which ends the word if last says so."""
        return [t.id for t in (self.whole.model if last else self.inner).tokenize(symbols)]

    def joined(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """The ids of a run of symbols from those of its two halves."""
        reach = WINDOW
        while left and right:
            a, b = min(reach, len(left)), min(reach, len(right))
            window = self._leaf("".join(self.symbols[i] for i in left[-a:] + right[:b]), last and b == len(right))
            if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
                return left[:-a] + window + right[b:]
            reach *= 2
        return left + right

    def word(self, symbols: str, last: bool = True) -> list[int]:
        """The ids of a word of any length, or of a part of one."""
        if len(symbols) <= LEAF:
            return self._leaf(symbols, last)
        middle = len(symbols) // 2
        return self.joined(self.word(symbols[:middle], False), self.word(symbols[middle:], last), last)

    def together(self, parts: list[list[int]], last: bool = True) -> list[int]:
        """The ids of a word from those of its parts, neighbours joined in rounds."""
        while len(parts) > 1:
            pairs = [parts[k : k + 2] for k in range(0, len(parts), 2)]
            parts = [self.joined(*p, last and k == len(pairs) - 1) if len(p) == 2 else p[0] for k, p in enumerate(pairs)]
        return parts[0]

    def words(self, unit: str) -> list[str]:
        """The words of a unit, each symbol of which stands for a byte."""
        return [w for w, _ in self.whole.pre_tokenizer.pre_tokenize_str(self.whole.normalizer.normalize_str(unit))]

    def encoded(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and lengths of units: short ones by the tokenizer, long ones word by word."""
        ids: list[list[int]] = [[]] * len(units)
        short = [k for k, u in enumerate(units) if len(u) <= LEAF]
        for k, e in zip(short, self.whole.encode_batch_fast([units[k].decode() for k in short], add_special_tokens=False), strict=True):
            ids[k] = e.ids
        for k, u in enumerate(units):
            if len(u) > LEAF:
                ids[k] = [i for w in self.words(u.decode()) for i in self.word(w)]
        return np.array([i for one in ids for i in one], np.int32), np.array([len(one) for one in ids], np.int64)

    def cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the units of all texts; an added token's string is a unit of its own."""
        runs, run_ends, _ = spans(~SPACE[data], offsets)
        if not len(runs):
            return runs, run_ends
        begins = np.zeros(len(data) + 1, bool)
        begins[runs] = True
        begins[1:-1] |= _PUNCTUATION[data[1:]] & _ALNUM[data[:-1]]
        raw = data.tobytes()
        for m in self.special.finditer(raw) if self.special else ():
            begins[m.start() + 1 : m.end()] = False
            begins[m.start()] = begins[m.end()] = True
        starts = np.flatnonzero(begins[:-1] & ~SPACE[data])
        run = np.searchsorted(runs, starts, "right") - 1
        return starts, np.minimum(np.append(starts[1:], len(data)), run_ends[run])

    def texts(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each block of texts: their ids, and the number of each."""
        for _, _, data, offsets in blocks(column):
            starts, ends = self.cuts(data, offsets)
            raw = data.tobytes()
            start, length = self.units.slots(span_hashes(data, starts, ends), lambda k: self.encoded([raw[a:b] for a, b in zip(starts[k].tolist(), ends[k].tolist(), strict=True)]))  # noqa: B023
            total = np.concatenate([[0], np.cumsum(length)])
            yield gather(self.units.ids, start, length), np.diff(total[np.searchsorted(starts, offsets)])

    def parts(self, text: str) -> Iterator[tuple[int, str]]:
        """(kind, part) of a long text, in order: runs of units of some PART bytes, and the pieces of words longer than that."""
        data = np.frombuffer(text.encode(), np.uint8)
        starts, ends = self.cuts(data, np.array([0, len(data)]))
        raw, at = data.tobytes(), 0
        while at < len(starts):
            begin = int(starts[at])
            end = max(at + 1, int(np.searchsorted(ends, begin + PART, "right")))
            unit = raw[begin : int(ends[end - 1])].decode()
            at = end
            if ends[end - 1] - begin <= PART:
                yield RUN, unit
                continue
            for word in self.words(unit):
                pieces = 1 << (max(len(word) - 1, 0) // PART).bit_length()
                bounds = [len(word) * k // pieces for k in range(pieces + 1)]
                for k in range(pieces):
                    yield LAST if k == pieces - 1 else PIECE, word[bounds[k] : bounds[k + 1]]

    def spelt_out(self, ids: np.ndarray, counts: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The texts of rows of so many ids each, one after another, and the lengths of all: tokens with spaces between.

        An id that stands for no token is left out.
        """
        row = np.repeat(np.arange(len(counts)), counts)
        fine = (ids >= 0) & (ids < len(self.known))
        fine[fine] = self.known[ids[fine]]
        ids, row = ids[fine], row[fine]
        length = self.spelt_length[ids]
        length[np.append(row[1:] != row[:-1], True)[: len(row)]] -= 1  # no space behind a row's last
        out = [gather(self.spelt, self.spelt_start[ids[k : k + AT_ONCE]], length[k : k + AT_ONCE]).tobytes() for k in range(0, len(ids), AT_ONCE)]
        return b"".join(out), np.bincount(row, length, len(counts)).astype(np.int64)


tokenizer = cache(WordTokenizer)


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(flat.astype(np.int32)))


def _encode(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for flat, counts in tokenizer(name).texts(batch.column(1)):
            yield pa.record_batch([batch.column(0).slice(at, len(counts)), _lists(flat, counts)], ["doc_id", "ids"])
            at += len(counts)


def _cut(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            kinds, parts = [], []
            for kind, part in tokenizer(name).parts(text.as_py()):
                kinds.append(kind)
                parts.append(part)
            yield pa.record_batch([pa.array([key] * len(parts), pa.string()), pa.array(range(len(parts)), pa.int32()), pa.array(kinds, pa.int32()), pa.array(parts, pa.string())], ["key", "seq", "kind", "part"])


def _encode_parts(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    own = tokenizer(name)
    for batch in batches:
        kinds = batch.column(2).to_pylist()
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(kinds)
        runs = [k for k, kind in enumerate(kinds) if kind == RUN]
        at = iter(runs)
        for flat, counts in own.texts(batch.column(3).take(pa.array(runs, pa.int64()))):
            for one in np.split(flat, np.cumsum(counts)[:-1]):
                ids[next(at)] = one
        for k, kind in enumerate(kinds):
            if kind != RUN:
                ids[k] = np.array(own.word(batch.column(3)[k].as_py(), kind == LAST), np.int32)
        yield pa.record_batch([*batch.columns[:3], _lists(np.concatenate(ids), np.array([len(x) for x in ids]))], ["key", "seq", "kind", "ids"])


def _join(table: pa.Table, name: str) -> pa.Table:
    """One text's parts, in order; those of one word are joined in rounds."""
    table = table.sort_by("seq")
    out, word = [], []
    for kind, ids in zip(table["kind"].to_pylist(), table["ids"], strict=True):
        if kind == RUN:
            out.append(ids.values.to_numpy())
            continue
        word.append(ids.values.to_pylist())
        if kind == LAST:
            out.append(np.array(tokenizer(name).together(word), np.int32))
            word = []
    flat = np.concatenate(out)
    return pa.table([table["key"].slice(0, 1).combine_chunks(), _lists(flat, np.array([len(flat)]))], ["key", "ids"])


def encode(docs: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, as the tokenizer without added special tokens gives them.

    Texts up to LONG bytes are encoded where they stand.  Of longer ones each
    distinct text is cut once, its parts are dealt to all tasks, encoded, and
    joined; the ids then go back to every row that has the text.

    A null or empty text has no ids.  Strings of added tokens in a text are those tokens, as in
    the tokenizer.  Rows that repeat an id or a text each give a row; a null
    doc_id stays null.  Other columns are ignored.  An empty table gives an
    empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = F.octet_length("text")
    short = rows.where(size <= LONG).mapInArrow(lambda b: _encode(b, name), "doc_id long, ids array<int>")
    long = rows.where(size > LONG).withColumn("key", F.sha2("text", 256))
    parts = long.select("key", "text").dropDuplicates(["key"]).mapInArrow(lambda b: _cut(b, name), _PARTS)
    ids = parts.repartition("key", "seq").mapInArrow(lambda b: _encode_parts(b, name), "key string, seq int, kind int, ids array<int>")
    whole = ids.groupBy("key").applyInArrow(lambda t: _join(t, name), "key string, ids array<int>")
    # a text of white space only has no parts
    found = long.select("doc_id", "key").join(whole, "key", "left").select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return short.unionAll(found)


def _decode(batches: Iterator[pa.RecordBatch], at: int, name: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(at)
        counts = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(counts), 0
        while first < len(batch):
            end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + AT_ONCE, "right")))
            rows = batch.slice(first, end - first)
            raw, length = tokenizer(name).spelt_out(rows.column(at).flatten().to_numpy(zero_copy_only=False), counts[first:end])
            offsets = np.concatenate([[0], np.cumsum(length)])
            text = pa.LargeStringArray.from_buffers(len(length), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)).cast(pa.string())
            if lists.null_count:
                text = pc.if_else(rows.column(at).is_null(), pa.scalar(None, pa.string()), text)
            yield pa.record_batch([*rows.columns, text], [*batch.schema.names, "decoded"])
            first = end


def decode(encoded: DataFrame, name: str = TOKENIZER) -> DataFrame:
    """The rows of encoded (with a column ids) and decoded, the text that the tokenizer makes of the ids, special tokens too; null where ids is null."""
    schema = StructType([*encoded.schema.fields, StructField("decoded", StringType())])
    at = encoded.columns.index("ids")
    return encoded.mapInArrow(lambda b: _decode(b, at, name), schema)


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(encode(read_table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
