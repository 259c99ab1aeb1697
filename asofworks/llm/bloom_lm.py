"""Operator 2: language-model scores from log-frequency Bloom filters of quantised bigram counts.

A filter holds (key, level) for every level that a key's count reaches; a count
is read back by probing level after level until one misses.  The model is

    P(w | h) = (c(h, w) + MU * U(w)) / (c(h) + MU),   U(w) = (c(w) + 1) / (N + V + 1)

so a history seen once gives its one follower 1 / (1 + MU), not all it has.

A filter that held every n-gram would grow with the corpus past any worker's
memory.  So only that of the frequent bigrams is broadcast, beside exact counts
of the frequent words; the rest is cut by hash into filters that are each built
and probed where their bigrams meet.  What a filter finds by mistake is no
count: a frequent bigram is one of a broadcast list of keys, and no bigram
counts more than its words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.store import kept, read_table
from asofworks.llm.textbytes import blocks, mix, words

#: Words as frequent as one in HEAD tokens are in a broadcast table, of HEAD rows (32 MB) at most; rarer ones meet in the parts.
HEAD = 1 << 21
#: Bigrams as frequent as one in OFTEN tokens are in a broadcast filter, OFTEN of them at most (some 60 levels each: 6 MB); all others are in the filters of the parts.
OFTEN = 1 << 16
#: Counters by which the search for frequent bigrams is narrowed down; every bigram is counted.
COUNTERS = 1 << 18
#: Training tokens for each part; tokens that a task gathers before it deals them out.
PART, BATCH = 1 << 20, 1 << 20
#: A count is kept as the power of BASE that it reaches.
BASE = 1.3
#: Bits for each (key, level) and hashes of it: 0.4 % of the keys that were never put in are found.
EACH, HASHES = 12, 6
#: Weight of the unigram, in occurrences of a history: of 16, 64, 256 and 1024 the best for the held-out documents of sf0.1 (-3.73 a token; unigrams alone -4.19).
MU = 256.0

#: Stands for the end of a text, and for what is before its first word.
END = np.uint64(0x5EED0FE4D0C0FFEE)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 7; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _with_ends(hashes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens: each text's words and one end."""
    return np.insert(hashes, begin[1:], END), begin + np.arange(len(begin))


def _history(tokens: np.ndarray, begin: np.ndarray, end: object) -> np.ndarray:
    """What stands before each token; before a text's first, the end."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[begin[:-1]] = end
    return before


def _tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    codes, unique = pd.factorize(keys)
    return unique, np.bincount(codes, counts, len(unique)).astype(np.int64)


def _counter(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(before * np.uint64(0xD6E8FEB86659FD93) + tokens) % np.uint64(COUNTERS)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (of, key, n): words (of 1), summed within the batch, and the counters of bigrams (of 2), summed within the task."""
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        parts = []
        for _, _, data, offsets in blocks(batch.column(0)):
            tokens, begin = _with_ends(*words(data, offsets))
            parts.append(_tally(tokens))
            total += np.bincount(_counter(_history(tokens, begin, END), tokens), minlength=COUNTERS)
        if parts:
            key, n = _tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pa.record_batch([pa.array(np.ones(len(key), np.int32)), pa.array(key.view(np.int64)), pa.array(n)], ["of", "key", "n"])
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(np.full(len(some), 2, np.int32)), pa.array(some), pa.array(total[some])], ["of", "key", "n"])


def levels(counts: np.ndarray) -> np.ndarray:
    """The level that each count reaches: 1 at 1, then at BASE, at its square, and so on."""
    return np.floor(np.log(np.maximum(counts, 1.0)) / np.log(BASE) + 1e-9).astype(np.int64) + 1


class LogFrequencyBloom:
    """A Bloom filter of (key, level) for every level that a key's count reaches, sized by what goes in.

    Where all counts are known to be least or more, the levels below least's are left out.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, least: float = 1.0) -> None:
        self.first = int(levels(np.array([least]))[0])
        level = np.maximum(levels(counts), self.first)
        self.size = np.uint64(max(64, EACH * int((level - self.first + 1).sum())))
        marks = np.zeros(int(self.size), bool)
        for j in range(self.first, int(level.max(initial=0)) + 1):
            some = keys[level >= j] if j > self.first else keys
            for place in self._places(some, j):
                marks[place] = True
        self.bits = np.packbits(marks, bitorder="little")

    def _places(self, keys: np.ndarray, level: int) -> Iterator[np.ndarray]:
        a = mix(keys.astype(np.uint64) ^ mix(np.array([level], np.uint64)))
        with np.errstate(over="ignore"):
            step = mix(a) | np.uint64(1)
            for _ in range(HASHES):
                yield ((a >> np.uint64(32)) * self.size >> np.uint64(32)).astype(np.int64)
                a = a + step

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """What the filter has as each key's count (0: not in it), by probes level after level until one misses."""
        level = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        at = self.first - 1
        while len(left):
            at += 1
            ok = np.ones(len(left), bool)
            for place in self._places(keys[left], at):
                ok &= (self.bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            left = left[ok]
            level[left] = at
        return np.where(level > 0, BASE ** (level - 1.0), 0.0)


@dataclass
class Model:
    """What goes to the workers: frequent words with counts, the filter of frequent bigrams, and the number of parts."""

    head: np.ndarray
    count: np.ndarray
    tokens: int
    distinct: int
    often: LogFrequencyBloom
    parts: int
    mu: float
    batch: int
    often_keys: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    heavy: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def size(self) -> float:
        return float(self.tokens + self.distinct + 1)

    def index(self, hashes: np.ndarray) -> np.ndarray:
        """Each token's row in head, or -1."""
        codes, unique = pd.factorize(hashes)
        at = np.minimum(np.searchsorted(self.head, unique), max(len(self.head) - 1, 0))
        found = np.where(self.head[at] == unique, at, -1) if len(self.head) else np.full(len(unique), -1)
        return found[codes]

    def often_counts(self, pairs: np.ndarray) -> np.ndarray:
        """The counts of pairs of head words that are frequent bigrams, as the filter has them; 0 for all others."""
        out = np.zeros(len(pairs))
        if len(self.often_keys):
            listed = self.often_keys[np.minimum(np.searchsorted(self.often_keys, pairs), len(self.often_keys) - 1)] == pairs
            some = pairs[listed]
            words = np.minimum(self.count[(some >> np.uint64(32)).astype(np.int64)], self.count[(some & np.uint64(0xFFFFFFFF)).astype(np.int64)])
            out[listed] = np.minimum(self.often.counts(some), words)
        return out


def _pair(previous: np.ndarray, token: np.ndarray) -> np.ndarray:
    return (previous.astype(np.uint64) << np.uint64(32)) | token.astype(np.uint64)


def _count_heavy(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(key, n) of bigrams of head words on heavy counters, summed within the batch."""
    for batch in batches:
        parts = []
        for _, _, data, offsets in blocks(batch.column(0)):
            tokens, begin = _with_ends(*words(data, offsets))
            before = _history(tokens, begin, END)
            some = model.heavy[_counter(before, tokens)]
            prior, index = model.index(before[some]), model.index(tokens[some])
            both = (prior >= 0) & (index >= 0)
            parts.append(_tally(_pair(prior[both], index[both])))
        if parts:
            key, n = _tally(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(n)], ["key", "n"])


def fit(train: DataFrame, mu: float = MU) -> Model:
    """The broadcast part of the model, from the column text of train.

    Every word and every bigram of train is counted.  What comes to the driver
    is of a bounded number of rows: the words and bigrams above a relative
    frequency, and COUNTERS counters.
    """
    texts = train.select("text")
    counted = texts.mapInArrow(_count, "of int, key long, n long").groupBy("of", "key").agg(F.sum("n").alias("n"))
    counted = kept(counted, "counts")
    total = counted.where("of = 1").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    head = counted.where((F.col("of") == 1) & (F.col("n") * HEAD >= total["n"])).toPandas()
    key, n = head["key"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64)
    order = np.argsort(key)
    least = max(1.0, total["n"] / OFTEN)
    model = Model(key[order], n[order], total["n"], total["v"], LogFrequencyBloom(np.zeros(0, np.uint64), np.zeros(0), least), 1 + total["n"] // PART, mu, BATCH)
    heavy = counted.where((F.col("of") == 2) & (F.col("n") >= least)).select("key").toPandas()
    model.heavy = np.zeros(COUNTERS, bool)
    model.heavy[heavy["key"].to_numpy(np.int64)] = True
    shared = texts.sparkSession.sparkContext.broadcast(model)
    often = texts.mapInArrow(lambda b: _count_heavy(b, shared.value), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).toPandas()
    model.often_keys = np.sort(often["key"].to_numpy(np.int64).view(np.uint64))
    model.often = LogFrequencyBloom(often["key"].to_numpy(np.int64).view(np.uint64), often["n"].to_numpy(np.int64), least)
    model.heavy = np.zeros(0, bool)
    return model


#: Kinds of packed rows: a batch's documents; its bigrams that end in a head word, or in another word; what a part has found about a batch.
DOCS, OF_HEAD, OF_RARE, FOUND = range(4)
PACKED = "part long, batch long, kind int, bits binary"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: Bits of a history's hash in the key of a bigram that ends in a head word.
_OWN = np.uint64(42)


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of equal length as bytes, the first bytes of all values first: sorted values then compress."""
    n = np.array([len(columns[0])], np.uint32).tobytes()
    return n + b"".join(np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns)


def _unpack(bits: bytes, *kinds: type) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(bits, np.uint32, 1)[0]), 4, []
    for kind in kinds:
        width = np.dtype(kind).itemsize
        planes = np.frombuffer(bits, np.uint8, n * width, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * width
    return out


def _rows(part: object, batch: object, kind: int, bits: list[bytes]) -> pa.RecordBatch:
    n = len(bits)
    full = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.int64), (n,)).copy())
    return pa.record_batch([full(part), full(batch), pa.array(np.full(n, kind, np.int32)), pa.array(bits, pa.binary())], ["part", "batch", "kind", "bits"])


def _dealt(part: np.ndarray, batch: int, kind: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed row for each part, sorted by the first column."""
    if not len(part):
        return
    order = np.lexsort((columns[0], part))
    part = part[order]
    columns = tuple(c[order] for c in columns)
    cut = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    ends = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
    yield _rows(part[cut[:-1]], batch, kind, [_pack(*(c[a:b] for c in columns)) for a, b in ends])


def _deal_batch(ids: list[pa.Array], held: list[np.ndarray], texts: list[tuple[np.ndarray, np.ndarray]], batch: int, model: Model) -> Iterator[pa.RecordBatch]:
    held_flags = np.concatenate(held)
    n = len(held_flags)
    length = np.concatenate([np.diff(begin) for _, begin in texts])
    tokens = np.concatenate([t for t, _ in texts])
    begin = np.concatenate([[0], np.cumsum(length)])
    doc = np.repeat(np.arange(n, dtype=np.uint32), length)
    before = _history(tokens, begin, END)
    index = model.index(tokens)
    end_index = int(model.index(np.array([END]))[0])
    prior = _history(index, begin, end_index)
    marked = doc * np.uint32(2) + held_flags.astype(np.uint32)[doc]

    # what head words and frequent bigrams tell
    inside = np.flatnonzero(index >= 0)
    one = (model.count + 1.0) / model.size
    own = index[inside]
    base = np.bincount(doc[inside], np.log10(one)[own], n)
    gain = np.bincount(doc[inside], -np.log10(1.0 + model.count / model.mu)[own], n)
    known = np.bincount(doc[inside], minlength=n)
    rest = np.ones(len(inside), bool)
    asked = np.flatnonzero(prior[inside] >= 0)
    codes, unique = pd.factorize(_pair(prior[inside][asked], own[asked]))
    seen = model.often_counts(unique)[codes]
    got = asked[seen > 0]
    rest[got] = False
    gain += np.bincount(doc[inside[got]], np.log10(1.0 + seen[seen > 0] / (model.mu * one[own[got]])), n)
    table = pa.record_batch(
        [pa.concat_arrays(ids), pa.array(held_flags), pa.array(length.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base), pa.array(gain)],
        ["doc_id", "held_out", "n_tokens", "n_known", "base", "gain"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as stream:
        stream.write_batch(table)
    yield _rows(-1 - batch, batch, DOCS, [sink.getvalue().to_pybytes()])

    inside = inside[rest]
    key = (index[inside].astype(np.uint64) << _OWN) | (before[inside] >> (np.uint64(64) - _OWN))
    yield from _dealt((mix(key) % np.uint64(model.parts)).astype(np.int64), batch, OF_HEAD, key, marked[inside])
    rare = np.flatnonzero(index < 0)
    key = tokens[rare]
    yield from _dealt((mix(key) % np.uint64(model.parts)).astype(np.int64), batch, OF_RARE, key, (before[rare] >> np.uint64(32)).astype(np.uint32), marked[rare])


def _deal(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text) to packed rows; a batch of some BATCH tokens at a time."""
    number = TaskContext.get().partitionId() << 32
    ids, held, texts, have = [], [], [], 0
    for batch in batches:
        for at, end, data, offsets in blocks(batch.column(2)):
            tokens, begin = _with_ends(*words(data, offsets))
            ids.append(batch.column(0).slice(at, end - at))
            held.append(batch.column(1).slice(at, end - at).to_numpy(zero_copy_only=False).astype(bool))
            texts.append((tokens, begin))
            have += len(tokens)
            if have >= model.batch:
                yield from _deal_batch(ids, held, texts, number, model)
                number, ids, held, texts, have = number + 1, [], [], [], 0
    if ids:
        yield from _deal_batch(ids, held, texts, number, model)


def _found(row: np.ndarray, marked: np.ndarray, batch: list[int], known: np.ndarray | None, base: np.ndarray | None, gain: np.ndarray) -> list[tuple[int, bytes]]:
    """For each row that asked: its batch, and the sums of each of its documents that has any."""
    code, place = np.unique(row.astype(np.int64) << 32 | (marked >> np.uint32(1)).astype(np.int64), return_inverse=True)
    sums = [np.zeros(len(code), np.uint32) if known is None else np.bincount(place, known, len(code)).astype(np.uint32)]
    sums += [np.zeros(len(code)) if base is None else np.bincount(place, base, len(code)), np.bincount(place, gain, len(code)).astype(np.float32)]
    some = (sums[2] != 0) | (sums[1] != 0)
    code, sums = code[some], [s[some] for s in sums]
    cut = np.searchsorted(code, np.arange(len(batch) + 1, dtype=np.int64) << 32)
    doc = (code & 0xFFFFFFFF).astype(np.uint32)
    return [(number, _pack(doc[a:b], *(s[a:b] for s in sums))) for number, a, b in zip(batch, cut[:-1].tolist(), cut[1:].tolist(), strict=True) if b > a]


def _part(table: pa.Table, model: Model) -> pa.Table:
    """All rows of a part: its training bigrams make its filter, which every bigram of the part then probes."""
    if table["part"][0].as_py() < 0:
        return table.select(["batch", "kind", "bits"])
    kinds, batch = table["kind"].to_numpy(), table["batch"].to_numpy()
    rows = {kind: np.flatnonzero(kinds == kind) for kind in (OF_HEAD, OF_RARE)}
    got = {}
    for kind, types in ((OF_HEAD, (np.uint64, np.uint32)), (OF_RARE, (np.uint64, np.uint32, np.uint32))):
        each = [_unpack(table["bits"][int(k)].as_py(), *types) for k in rows[kind]]
        columns = [np.concatenate(c) for c in zip(*each, strict=True)] if each else [np.zeros(0, t) for t in types]
        got[kind] = (np.repeat(np.arange(len(each)), [len(e[0]) for e in each]), *columns)
    row, key, marked = got[OF_HEAD]
    rare_row, word, second, rare_marked = got[OF_RARE]
    rare_key = mix(word ^ mix(second.astype(np.uint64) + np.uint64(1))) | np.uint64(1 << 63)
    learnt = [k[m & np.uint32(1) == 0] for k, m in ((key, marked), (rare_key, rare_marked))]
    filter_ = LogFrequencyBloom(*np.unique(np.concatenate(learnt), return_counts=True))
    del learnt
    out: list[tuple[int, bytes]] = []
    if len(key):
        one = (model.count + 1.0) / model.size
        own = (key >> _OWN).astype(np.int64)
        gain = np.log10(1.0 + np.minimum(filter_.counts(key), model.count[own]) / (model.mu * one[own]))
        some = gain > 0
        out += _found(row[some], marked[some], batch[rows[OF_HEAD]].tolist(), None, None, gain[some])
    if len(word):
        # a rare word's bigrams are all here, so its count is that of its training rows here
        codes, unique = pd.factorize(word)
        count = np.bincount(codes, rare_marked & np.uint32(1) == 0, len(unique))[codes]
        one = (count + 1.0) / model.size
        gain = np.log10(1.0 + np.minimum(filter_.counts(rare_key), count) / (model.mu * one)) - np.log10(1.0 + count / model.mu)
        out += _found(rare_row, rare_marked, batch[rows[OF_RARE]].tolist(), count > 0, np.log10(one), gain)
    return pa.table([pa.array([b for b, _ in out], pa.int64()), pa.array(np.full(len(out), FOUND, np.int32)), pa.array([x for _, x in out], pa.binary())], ["batch", "kind", "bits"])


def _sum(table: pa.Table, tokens: int) -> pa.Table:
    """A batch's documents with what the parts have found about them."""
    kinds = table["kind"].to_numpy()
    bits = table["bits"]
    docs = pa.ipc.open_stream(bits[int(np.flatnonzero(kinds == DOCS)[0])].as_py()).read_all()
    known, base, gain = (docs[c].to_numpy().copy() for c in ("n_known", "base", "gain"))
    for k in np.flatnonzero(kinds == FOUND).tolist():
        doc, more, sums, gains = _unpack(bits[k].as_py(), np.uint32, np.uint32, np.float64, np.float32)
        known[doc] += more
        base[doc] += sums
        gain[doc] += gains
    return pa.table(
        [docs["doc_id"], docs["held_out"], docs["n_tokens"], pa.array(known), pa.array(np.full(len(known), tokens)), pa.array(base), pa.array(base + gain)],
        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def score(docs: DataFrame, mu: float = MU) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the lower-cased (A-Z) words of the whole text and one end.  The
    model learns from rows that held_out() doesn't name.  base_score sums the
    add-one unigram log10 probabilities, score the model's (see the module).

    Every word and bigram of the training rows counts, however rare.  Frequent
    words, of which there can only be a fixed number, are broadcast with exact
    counts, and frequent bigrams in a filter.  All other bigrams are dealt by
    hash to parts of some PART tokens (those that end in a rare word by that
    word, whose count is thus known there).  A part builds its filter from what
    the training texts sent and answers every probe that came with it; answers
    are summed for each batch of texts.  Bigrams travel packed, some 8 bytes
    each, and once.

    A null or empty text has the end as its only token.  A null doc_id counts
    as empty text for the split and is scored.  Repeated rows are scored each.
    With no training rows N and V are 0.  Other columns are ignored.  An empty
    table gives an empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    model = fit(rows.where(~F.col("held_out")), mu)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    tokens = model.tokens
    packed = rows.mapInArrow(lambda b: _deal(b, shared.value), PACKED)
    found = packed.groupBy("part").applyInArrow(lambda t: _part(t, shared.value), "batch long, kind int, bits binary")
    return found.groupBy("batch").applyInArrow(lambda t: _sum(t, tokens), SCORED)


def op2_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"))
