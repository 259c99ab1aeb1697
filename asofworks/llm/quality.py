"""Operator 5: a byte-level convolutional network that scores the quality of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.store import read_table
from asofworks.llm.textbytes import blocks, give_back, tidy

#: Labelled rows that the network learns from at most, and bytes of a text up to which it is among them.
SAMPLE_ROWS, SAMPLE_BYTES = 3000, 16384
#: Values of a byte's embedding, filters, bytes from one place of a filter to the next (a filter sees twice as many), and places in a chunk.
EMBED, FILTERS, STRIDE, PLACES = 8, 24, 4, 128
EPOCHS, BATCH, RATE, DECAY, SEED = 14, 32, 6e-3, 1e-4, 11

_PAD = 256


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 1 modulo 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as rows of STRIDE for chunks of PLACES + 1 rows, each chunk beginning with the last row of the one before, and each text's first chunk.

    The last chunk of a text is filled up with a padding value; an empty text
    has one chunk of padding.
    """
    size = PLACES * STRIDE
    length = np.diff(offsets)
    count = np.maximum(1, -(-length // size))
    first = np.concatenate([[0], np.cumsum(count)])
    flat = np.full(first[-1] * size + STRIDE, _PAD, np.int16)
    if len(data):
        to = np.arange(len(data)) + np.repeat(first[:-1] * size - offsets[:-1], length)
        flat[to] = data
    # the row behind a chunk is the next chunk's first, or padding behind a text
    body = flat[: first[-1] * size].reshape(-1, PLACES, STRIDE)
    behind = np.full((len(body), 1, STRIDE), _PAD, np.int16)
    behind[:-1, 0] = body[1:, 0]
    behind[first[1:] - 1] = _PAD
    return np.concatenate([body, behind], axis=1), first


@dataclass
class Network:
    """embed: a vector for each byte and for padding; near, far: the filters' two halves; then the weights of the pooled values."""

    embed: np.ndarray
    near: np.ndarray
    far: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: np.ndarray

    @classmethod
    def start(cls) -> Network:
        rng = np.random.default_rng(SEED)
        draw = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        width = STRIDE * EMBED
        return cls(draw(257, EMBED, by=0.5), draw(width, FILTERS, by=0.2), draw(width, FILTERS, by=0.2), np.zeros(FILTERS, np.float32), draw(2 * FILTERS, by=0.1), np.zeros(1, np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.near, self.far, self.bias, self.weight, self.offset]

    def respond(self, chunks: np.ndarray) -> np.ndarray:
        """Each filter's response at each place of each chunk."""
        rows = self.embed[chunks].reshape(len(chunks), PLACES + 1, STRIDE * EMBED)
        return rows[:, :-1] @ self.near + rows[:, 1:] @ self.far + self.bias

    def pool(self, peaks: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each text, the largest and the mean of its chunks' peaks."""
        most = np.maximum.reduceat(peaks, first[:-1])
        mean = np.add.reduceat(peaks, first[:-1]) / np.diff(first)[:, None].astype(np.float32)
        return np.concatenate([most, mean], axis=1)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each text."""
        chunks, first = _chunks(data, offsets)
        peaks = np.concatenate([np.maximum(self.respond(part).max(1), 0) for part in np.array_split(chunks, -(-len(chunks) // 256))])
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.pool(peaks, first) @ self.weight + self.offset).astype(np.float64)))


def fit(texts: list[bytes], labels: np.ndarray) -> Network:
    """Train on texts by Adam; both labels weigh the same in sum.  The same rows give the same network."""
    net = Network.start()
    labels = labels.astype(np.float32)
    share = labels.mean() if len(labels) else 0.0
    if not 0 < share < 1:
        # one label only, or none: nothing to tell apart
        net.weight[:] = 0
        net.offset[:] = 0.0 if not len(labels) else (4.0 if share else -4.0)
        return net
    weights = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    rng = np.random.default_rng(SEED)
    moment = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parts()]
    step, steps = 0, EPOCHS * -(-len(texts) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(texts))
        for some in np.array_split(order, -(-len(order) // BATCH)):
            step += 1
            batch = [texts[k] for k in some]
            data = np.frombuffer(b"".join(batch), np.uint8)
            chunks, first = _chunks(data, np.concatenate([[0], np.cumsum([len(t) for t in batch])]))
            response = net.respond(chunks)
            place = response.argmax(1)
            top = np.take_along_axis(response, place[:, None], 1)[:, 0]
            peaks = np.maximum(top, 0)
            pooled = net.pool(peaks, first)
            y, w = labels[some], weights[some]
            p = 1 / (1 + np.exp(-(pooled @ net.weight + net.offset)))
            slope = ((p - y) * w / len(some)).astype(np.float32)
            back = slope[:, None] * net.weight
            text = np.repeat(np.arange(len(some)), np.diff(first))
            # the largest chunk of each text takes the maximum's share, every chunk the mean's
            largest = peaks >= np.repeat(pooled[:, :FILTERS], np.diff(first), axis=0)
            ties = np.add.reduceat(largest.astype(np.float32), first[:-1])[text]
            grad = back[text, :FILTERS] * largest / ties + back[text, FILTERS:] / np.diff(first)[text, None].astype(np.float32)
            grad = grad * (top > 0)
            chunk = np.arange(len(chunks))[:, None]
            seen_near, seen_far = chunks[chunk, place], chunks[chunk, place + 1]
            rows_near = net.embed[seen_near].reshape(len(chunks), FILTERS, -1)
            rows_far = net.embed[seen_far].reshape(len(chunks), FILTERS, -1)
            g_near = np.einsum("ckw,ck->wk", rows_near, grad)
            g_far = np.einsum("ckw,ck->wk", rows_far, grad)
            g_embed = np.zeros_like(net.embed)
            for seen, half in ((seen_near, net.near), (seen_far, net.far)):
                into = (grad[:, :, None] * half.T[None]).reshape(-1, EMBED)
                np.add.at(g_embed, seen.reshape(-1), into)
            grads = [g_embed, g_near, g_far, grad.sum(0), pooled.T @ slope + DECAY * net.weight, np.array([slope.sum()], np.float32)]
            rate = RATE * min(1.0, 2 * (1 - step / (steps + 1)))
            for value, (m, v), g in zip(net.parts(), moment, grads, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                value -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame) -> Network:
    """Fit on labelled documents that held_out() doesn't name.

    At most SAMPLE_ROWS rows of at most SAMPLE_BYTES bytes come to the driver,
    those whose id has the smallest hash.  Only text and label are learnt from.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("y"))
    able = docs.where(~held_out() & (F.octet_length("text") <= SAMPLE_BYTES))
    # ids first, so that only the sample's texts move
    chosen = able.select("doc_id").join(known, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    rows = able.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(SAMPLE_ROWS).select("text", "y").toArrow()
    net = fit([t.encode() for t in rows["text"].to_pylist()], rows["y"].to_numpy())
    del rows
    give_back()
    return net


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    score is the network's probability that the whole text is of label 1; only
    the text's bytes go in.  Filters slide over the bytes of chunks that
    overlap, so every place of the text is seen; each chunk keeps a filter's
    largest response, a text the largest and the mean of its chunks.

    A null or empty text is scored as one chunk of padding.  A null doc_id
    counts as empty text for the split.  Repeated rows are scored each; a label
    that repeats with both values counts as 0; labels of no use are ignored,
    and with none the score is 0.5.  Other columns are ignored.  An empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.score(data, offsets) for _, _, data, offsets in blocks(batch.column(2))]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(tidy(each), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents, all columns, that the classifier does not reject."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    schema = docs.schema
    place = docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # block by block, so that no second copy of a batch's texts is made
            for at, end, data, offsets in blocks(batch.column(place)):
                yield batch.slice(at, end - at).filter(pa.array(shared.value.score(data, offsets) >= 0.5))

    return docs.mapInArrow(tidy(each), schema)


def op5_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
