"""Operator 6: SentencePiece BPE with seeded merge-dropout, and its lossless decoding."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from asofworks.llm.store import read_table
from asofworks.llm.textbytes import blocks, mix, span_hashes, tidy
from asofworks.llm.units import UnitCache, gather

MODEL = "piece_bpe_32k.model"
#: Share of candidate merges that are skipped, and the seed of the skips.
DROPOUT, SEED = 0.1, 20240607
#: Symbols of a unit up to which units are worked on side by side; a longer unit has an agenda of its own.
SIDE_BY_SIDE = 32
#: Bytes of units and their merges that a worker keeps, about.
UNITS = 1 << 25
#: Bytes of text that are worked on at once; merging takes some 300 bytes for each.
BLOCK = 1 << 19

_NONE = np.int32(1 << 30)
_SPACE = 0x2581


class Pieces:
    """Pieces, merges and where text may be cut, read from a SentencePiece BPE model with byte fallback."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        names = [model.id_to_piece(k) for k in range(n)]
        plain = [k for k in range(n) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k) or model.is_unused(k))]
        self.byte_id = np.zeros(256, np.int32)
        surface = [b""] * n
        for k in range(n):
            if model.is_byte(k):
                value = int(names[k][3:-1], 16)
                self.byte_id[value] = k
                surface[k] = bytes([value])
        for k in plain:
            surface[k] = names[k].replace(chr(_SPACE), " ").encode()
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.surface_length = np.array([len(x) for x in surface], np.int64)
        self.surface_start = np.concatenate([[0], np.cumsum(self.surface_length)[:-1]])
        ids = {names[k]: k for k in plain}
        # merges are tried in the order of the made piece's score, equal scores from left to right
        order = sorted(plain, key=lambda k: -model.get_score(k))
        scores = [model.get_score(k) for k in order]
        rank = np.zeros(n, np.int32)
        level = -1
        for k, (piece, score) in enumerate(zip(order, scores, strict=True)):
            level = level + 1 if not k or score != scores[k - 1] else level
            rank[piece] = level
        merges = {}
        for k in plain:
            name = names[k]
            for cut in range(1, len(name)):
                left, right = ids.get(name[:cut]), ids.get(name[cut:])
                if left is not None and right is not None:
                    merges[left << 32 | right] = k
        self.merge_key = np.array(sorted(merges), np.int64)
        self.merge_to = np.array([merges[k] for k in sorted(merges)], np.int32)
        self.rank = rank
        single = sorted((ord(names[k]), k) for k in plain if len(names[k]) == 1)
        self.char = np.array([c for c, _ in single], np.int64)
        self.char_id = np.array([k for _, k in single], np.int32)
        # bytes that stand side by side in some piece; a cut is safe between other ASCII bytes
        self.together = np.zeros((256, 256), bool)
        for k in plain:
            raw = np.frombuffer(surface[k], np.uint8)
            self.together[raw[:-1], raw[1:]] = True
        self.together[0x80:] = True
        self.together[:, 0x80:] = True
        inner_space = any(chr(_SPACE) in names[k].lstrip(chr(_SPACE)) for k in plain)
        self.space_starts = not inner_space

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each two neighbours make, or -1."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.merge_key, key), len(self.merge_key) - 1)
        return np.where((self.merge_key[at] == key) & (left >= 0) & (right >= 0), self.merge_to[at], np.int32(-1))


#: Bits of a symbol's place within a unit of at most SIDE_BY_SIDE symbols.
_BITS = 6


def _merge_hash(left: np.ndarray, right: np.ndarray, end: np.ndarray) -> np.ndarray:
    """What names a candidate merge within its unit: the places where its two sides begin and where it ends."""
    with np.errstate(over="ignore"):
        place = (left.astype(np.uint64) << np.uint64(42)) ^ (right.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
        return mix(place + np.uint64(0x51ED270B35AE5C67))


#: The same for every code of three places, as merges of short units are kept.
_CODES = np.arange(1 << (3 * _BITS))
_CODE_HASH = _merge_hash(_CODES >> (2 * _BITS), (_CODES >> _BITS) & ((1 << _BITS) - 1), _CODES & ((1 << _BITS) - 1))


def _skipped(keys: np.ndarray, merges: np.ndarray, dropout: float) -> np.ndarray:
    """Whether candidate merges are skipped, by a hash keyed with seed, doc_id and the unit's place in the text."""
    return mix(keys ^ merges) < np.uint64(min(int(dropout * 2.0**64), (1 << 64) - 1))


def _side_by_side(pieces: Pieces, symbols: np.ndarray, length: np.ndarray, keys: np.ndarray | None, dropout: float) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Merge units (rows of symbols) in step: each round does every unit's best candidate, unless a hash under its key skips it.

    Symbols (-1: none) and lengths left, and the merges done: rows and codes,
    round by round.  Without keys nothing is skipped.
    """
    n, width = symbols.shape
    column = np.arange(width)
    begin = np.broadcast_to(column, (n, width)).astype(np.int32).copy()
    end = begin + 1
    done = []

    def price(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        made = pieces.merged(symbols[rows, at], symbols[rows, at + 1])
        return np.where((made >= 0) & (at + 1 < length[rows]), pieces.rank[made], _NONE)

    cost = np.full((n, width), _NONE, np.int32)
    rows, at = np.nonzero(column[None, :-1] + 1 < length[:, None])
    cost[rows, at] = price(rows, at)
    rows = np.arange(n)
    while len(rows):
        best = cost[rows].argmin(1)
        on = cost[rows, best] < _NONE
        rows, best = rows[on], best[on]
        if not len(rows):
            break
        code = (begin[rows, best] << (2 * _BITS)) | (begin[rows, best + 1] << _BITS) | end[rows, best + 1]
        merging, at = rows, best
        if keys is not None:
            skip = _skipped(keys[rows], _CODE_HASH[code], dropout)
            cost[rows[skip], best[skip]] = _NONE
            merging, at, code = rows[~skip], best[~skip], code[~skip]
        else:
            done.append((merging, code))
        symbols[merging, at] = pieces.merged(symbols[merging, at], symbols[merging, at + 1])
        end[merging, at] = end[merging, at + 1]
        take = np.minimum(column + (column > at[:, None]), width - 1)
        for table in (symbols, begin, end, cost):
            table[merging] = np.take_along_axis(table[merging], take, 1)
        length[merging] -= 1
        for place in (at - 1, at):
            ok = place >= 0
            cost[merging[ok], place[ok]] = price(merging[ok], np.minimum(place[ok], width - 2))
    return symbols, length, done


def _agenda(pieces: Pieces, symbols: np.ndarray, key: np.uint64, dropout: float) -> list[int]:
    """The same for one long unit, with a heap of candidates: the symbols left."""
    import heapq

    n = len(symbols)
    made = symbols.tolist()
    before, after, end = list(range(-1, n - 1)), [*range(1, n), -1], list(range(1, n + 1))
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(left: list[int], right: list[int]) -> None:
        if not left:
            return
        to = pieces.merged(np.array([made[k] for k in left], np.int32), np.array([made[k] for k in right], np.int32))
        ends = np.array([end[k] for k in right])
        drop = _skipped(np.full(len(left), key), _merge_hash(np.array(left), np.array(right), ends), dropout)
        for a, b, t, e, d in zip(left, right, to.tolist(), ends.tolist(), drop.tolist(), strict=True):
            if t >= 0 and not d:
                heapq.heappush(heap, (int(pieces.rank[t]), a, b, e, t))

    offer(list(range(n - 1)), list(range(1, n)))
    while heap:
        _, a, b, e, to = heapq.heappop(heap)
        if after[a] != b or end[b] != e or end[a] != b:
            continue
        made[a], end[a], after[a] = to, e, after[b]
        if after[b] >= 0:
            before[after[b]] = a
        end[b] = -1
        left = [before[a]] if before[a] >= 0 else []
        offer(left, [a] * len(left))
        right = [after[a]] if after[a] >= 0 else []
        offer([a] * len(right), right)
    out, at = [], 0
    while at >= 0:
        out.append(made[at])
        at = after[at]
    return out


def _runs(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after another."""
    before = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def _merge_all(pieces: Pieces, symbol: np.ndarray, start: np.ndarray, size: np.ndarray, keys: np.ndarray | None, dropout: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of symbols to (flat symbols left, number of each, flat codes of merges done, number of each); no codes with keys, or of long units."""
    n = len(start)
    count, merges = np.zeros(n, np.int64), np.zeros(n, np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    codes: list[tuple[np.ndarray, np.ndarray]] = []
    # rows of about equal width, so that little padding is moved
    for low, high in ((0, 4), (4, 8), (8, 12), (12, 20), (20, SIDE_BY_SIDE)):
        some = np.flatnonzero((size > low) & (size <= high))
        for part in np.array_split(some, max(1, -(-len(some) // 20000))):
            if not len(part):
                continue
            width = high + 1
            inside = np.arange(width) < size[part, None]
            table = np.where(inside, symbol[np.minimum(start[part, None] + np.arange(width), len(symbol) - 1)], np.int32(-1))
            table, left, done = _side_by_side(pieces, table, size[part].copy(), None if keys is None else keys[part], dropout)
            parts.append((part, table[np.arange(width) < left[:, None]]))
            count[part] = left
            if done:
                rows, code = (np.concatenate(x) for x in zip(*done, strict=True))
                order = np.argsort(rows, kind="stable")
                codes.append((part, code[order]))
                merges[part] = np.bincount(rows, minlength=len(part))
    for k in np.flatnonzero(size > SIDE_BY_SIDE).tolist():
        own = np.array(_agenda(pieces, symbol[start[k] : start[k] + size[k]], np.uint64(0) if keys is None else keys[k], 0.0 if keys is None else dropout), np.int32)
        parts.append((np.array([k]), own))
        count[k] = len(own)
    out = []
    for number, found in ((count, parts), (merges, codes)):
        begin = np.cumsum(number) - number
        flat = np.zeros(int(number.sum()), np.int32)
        for part, values in found:
            flat[_runs(begin[part], number[part])] = values
        out += [flat, number]
    return tuple(out)


@cache
def _model(name: str) -> Pieces:
    import public_tokenizers

    return Pieces(name if os.path.isabs(name) else public_tokenizers.path(name))


@cache
def _units(name: str) -> UnitCache:
    return UnitCache(UNITS)


def encode_batch(doc_ids: pa.Array, column: pa.Array, name: str, dropout: float, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each block of texts: their ids and the number of each text.

    A unit's merges without dropout are kept with its ids.  Where the hash of an
    occurrence skips none of these, its ids are the kept ones: candidates that
    were never best don't matter.  All other occurrences get an agenda of their
    own.  A character without a piece, and a literal U+2581, becomes its bytes'
    pieces.
    """
    pieces, units = _model(name), _units(name)
    salt = mix(np.array([seed], np.uint64))[0]
    doc_keys = mix(doc_ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) ^ salt)
    for at, end, data, offsets in blocks(column, BLOCK):
        n = end - at
        # the model puts a space before each text
        bounds = offsets + np.arange(n + 1)
        spaced = np.full(len(data) + n, 0x20, np.uint8)
        inside = np.ones(len(spaced), bool)
        inside[bounds[:-1]] = False
        spaced[inside] = data
        bounds = bounds[:-1]
        begins = np.zeros(len(spaced), bool)
        begins[bounds] = True
        begins[1:] |= ~pieces.together[spaced[:-1], spaced[1:]]
        if pieces.space_starts:
            begins[1:] |= (spaced[1:] == 0x20) & (spaced[:-1] != 0x20)
        starts = np.flatnonzero(begins)
        per_text = np.append(np.searchsorted(starts, bounds), len(starts))
        text = np.repeat(np.arange(n), np.diff(per_text))
        hashes = span_hashes(spaced, starts, np.append(starts[1:], len(spaced)))
        with np.errstate(over="ignore"):
            keys = mix(doc_keys[at:end][text] + np.arange(len(starts), dtype=np.uint64) - per_text[text].astype(np.uint64))
        # characters, their symbols (unknown ones: -2 and less), and each unit's
        first_bytes = np.flatnonzero((spaced & 0xC0) != 0x80)
        code = np.frombuffer(spaced.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        code = np.where(code == _SPACE, -1, np.where(code == 0x20, _SPACE, code))
        place = np.minimum(np.searchsorted(pieces.char, code), len(pieces.char) - 1)
        symbol = np.where(pieces.char[place] == code, pieces.char_id[place], (-2 - np.arange(len(code)))).astype(np.int32)
        start = np.searchsorted(first_bytes, starts)
        size = np.diff(np.append(start, len(code)))
        plain = (np.add.reduceat(symbol < 0, start) == 0) & (size <= SIDE_BY_SIDE)

        def kept_units(k: np.ndarray, symbol=symbol, start=start, size=size, known=np.flatnonzero(plain)) -> tuple[np.ndarray, np.ndarray]:
            """A record for each unit: the number of its merges, their codes, its ids."""
            flat, count, codes, merges = _merge_all(pieces, symbol, start[known[k]], size[known[k]], None, 0.0)
            length = 1 + merges + count
            begin = np.cumsum(length) - length
            record = np.zeros(int(length.sum()), np.int32)
            record[begin] = merges
            record[_runs(begin + 1, merges)] = codes
            record[_runs(begin + 1 + merges, count)] = flat
            return record, length

        known = np.flatnonzero(plain)
        from_, length = units.slots(hashes[known], kept_units)
        merges = units.ids[from_].astype(np.int64)
        codes = units.ids[_runs(from_ + 1, merges)]
        owner = np.repeat(np.arange(len(known)), merges)
        hit = np.zeros(len(known), bool)
        if dropout > 0:
            hit[owner[_skipped(keys[known][owner], _CODE_HASH[codes], dropout)]] = True
        whole, length, from_ = known[~hit], (length - 1 - merges)[~hit], (from_ + 1 + merges)[~hit]
        own = np.ones(len(starts), bool)
        own[whole] = False
        own = np.flatnonzero(own)
        flat, count, _, _ = _merge_all(pieces, symbol, start[own], size[own], keys[own], dropout)
        unknown = np.flatnonzero(flat < 0)
        if len(unknown):
            char = -2 - flat[unknown].astype(np.int64)
            width = np.diff(np.append(first_bytes, len(spaced)))[char]
            many = np.ones(len(flat), np.int64)
            many[unknown] = width
            unit = np.repeat(np.arange(len(own)), count)
            flat = np.repeat(flat, many)
            flat[flat < 0] = pieces.byte_id[spaced[_runs(first_bytes[char], width)]]
            count = np.bincount(unit, many, len(own)).astype(np.int64)
        many = np.zeros(len(starts), np.int64)
        many[whole], many[own] = length, count
        # a text without bytes is only the space before it, and has no ids
        many[(np.diff(offsets) == 0)[text]] = 0
        to = np.cumsum(many) - many
        out = np.zeros(int(many.sum()), np.int32)
        out[_runs(to[whole], many[whole])] = gather(units.ids, from_, many[whole])
        out[_runs(to[own], many[own])] = gather(flat, np.cumsum(count) - count, many[own])
        total = np.append(to, len(out))
        yield out, np.diff(total[per_text])


def decode_flat(ids: np.ndarray, count: np.ndarray, name: str) -> list[bytes]:
    """The bytes of each text, less the space that the model put before it."""
    pieces = _model(name)
    raw = gather(pieces.surface, pieces.surface_start[ids], pieces.surface_length[ids]).tobytes()
    width = np.concatenate([[0], np.cumsum(pieces.surface_length[ids])])
    ends = np.concatenate([[0], np.cumsum(count)])
    bounds = width[ends].tolist()
    return [raw[a + 1 : b] if b > a else b"" for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def encode(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """(doc_id, ids, n_tokens): each whole text as piece ids.

    Candidate merges go by the score of the piece they make, equal scores from
    the left; each is skipped if a hash keyed by seed, doc_id, the unit's place
    in the text and the merge's place in the unit falls under the dropout share.
    So every occurrence of a word is drawn for itself, a rerun gives the same
    ids and another seed gives others.  Dropout 0 gives the model's own segmentation.  A null or
    empty text has no ids; a null doc_id and repeated rows are encoded like any
    other; other columns are ignored; an empty table gives an empty result.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for flat, count in encode_batch(batch.column(0), batch.column(1), model, dropout, seed):
                bounds = pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32))
                yield pa.record_batch([batch.column(0).slice(at, len(count)), pa.ListArray.from_arrays(bounds, pa.array(flat)), pa.array(count)], ["doc_id", "ids", "n_tokens"])
                at += len(count)

    return docs.select("doc_id", "text").mapInArrow(tidy(each), "doc_id long, ids array<int>, n_tokens long")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of encoded documents; exactly the text that was encoded, null as empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            count = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            yield pa.record_batch([batch.column(0), pa.array([t.decode() for t in decode_flat(ids, count, model)], pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(tidy(each), "doc_id long, text string")


def round_trip(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, text_crc32, lossless): encode, decode and compare, in one pass."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            texts = batch.column(1)
            for flat, count in encode_batch(batch.column(0), texts, model, dropout, seed):
                back = decode_flat(flat, count, model)
                ends = np.cumsum(count)
                ids = memoryview(flat.astype("<u4").tobytes())
                same = [t == (x or "").encode() for t, x in zip(back, texts.slice(at, len(count)).to_pylist(), strict=True)]
                yield pa.record_batch(
                    [
                        batch.column(0).slice(at, len(count)),
                        pa.array(count),
                        pa.array([zlib.crc32(ids[4 * (e - k) : 4 * e]) for e, k in zip(ends.tolist(), count.tolist(), strict=True)], pa.int64()),
                        pa.array([zlib.crc32(t) for t in back], pa.int64()),
                        pa.array(same),
                    ],
                    ["doc_id", "n_tokens", "ids_crc32", "text_crc32", "lossless"],
                )
                at += len(count)

    return docs.select("doc_id", "text").mapInArrow(tidy(each), "doc_id long, n_tokens long, ids_crc32 long, text_crc32 long, lossless boolean")


def op6_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"))
