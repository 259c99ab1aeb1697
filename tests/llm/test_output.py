"""Operators 6, 7, 8 and 10."""

import uuid
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from asofworks.llm import mixing, pieces, sharding, simple8b, token_files
from asofworks.llm.store import shared_folder
from asofworks.llm.textbytes import mix
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import rows


@given(st.lists(st.one_of(st.integers(0, 70000), st.integers(0, 2**64 - 1), st.just(0)), max_size=700))
@settings(max_examples=60, deadline=None)
def test_simple8b_round_trip(values):
    array = np.array(values, np.uint64)
    words, offsets, escapes = simple8b.encode(array)
    assert (simple8b.decode(words, offsets, escapes, len(array)) == array).all()


def test_small_ids_share_words():
    words, _, _ = simple8b.encode(np.arange(2560) % 1000)
    assert len(words) <= 2560 / 5


def expected_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in rows()]


def test_token_files(spark, docs):
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    token_files.write_tokens(docs, path)
    got = token_files.read_digests(spark, path).orderBy("start").collect()
    ids = expected_ids()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((r[0], len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for r, i in zip(rows(), ids, strict=True))
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    back = Counter((r.doc_id, tuple(r.ids)) for r in token_files.read_ids(spark, path).collect())
    assert back == Counter((r[0], tuple(i)) for r, i in zip(rows(), ids, strict=True))


def test_token_files_of_nothing(spark, no_docs):
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    token_files.write_tokens(no_docs, path)
    assert token_files.read_digests(spark, path).count() == 0


def agenda(model, text, dropout, skipped):
    """Ids of a text by one agenda over the whole of it: the best candidate first, from the left, unless it is skipped."""
    symbols = [[c, k, k + 1] for k, c in enumerate("\u2581" + text.replace(" ", "\u2581"))] if text else []
    known = {model.id_to_piece(k): (-model.get_score(k), k) for k in range(model.vocab_size()) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))}
    dead = set()
    while True:
        best = None
        for k in range(len(symbols) - 1):
            (a, left, _), (b, right, end) = symbols[k], symbols[k + 1]
            if a + b in known and (left, right, end) not in dead and "\u2581" not in text and (best is None or known[a + b][0] < best[0]):
                best = (known[a + b][0], k)
        if best is None:
            break
        k = best[1]
        left, right, end = symbols[k][1], symbols[k + 1][1], symbols[k + 1][2]
        if dropout and skipped(left, right, end):
            dead.add((left, right, end))
            continue
        symbols[k : k + 2] = [[symbols[k][0] + symbols[k + 1][0], left, end]]
    out = []
    for piece, _, _ in symbols:
        out += [known[piece][1]] if piece in known else [model.piece_to_id(f"<0x{x:02X}>") for x in piece.encode()]
    return out


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def test_pieces_without_dropout_are_the_models(docs, processor):
    want = Counter((r[0], tuple(processor.encode(r[1] or "", out_type=int))) for r in rows() if r[0] != 81)
    # the model's own normalisation changes this text, which is encoded as it stands
    odd = next(r[1] for r in rows() if r[0] == 81)
    want[(81, tuple(agenda(processor, odd.replace("\u2581", "\u2582"), 0, None)))] += 1
    got = Counter((r.doc_id, tuple(r.ids)) for r in pieces.encode(docs, dropout=0.0).collect())
    odd_ids = next(ids for i, ids in got if i == 81)
    assert {k: v for k, v in got.items() if k[0] != 81} == {k: v for k, v in want.items() if k[0] != 81}
    assert pieces.decode_flat(np.array(odd_ids), np.array([len(odd_ids)]), pieces.MODEL)[0].decode() == odd


@pytest.mark.parametrize("side_by_side", [32, 0])
def test_dropout_equals_a_plain_agenda(spark, processor, monkeypatch, side_by_side):
    """Each occurrence's own skips, by the keyed hash, in an agenda over its unit."""
    monkeypatch.setattr(pieces, "SIDE_BY_SIDE", side_by_side)
    texts = ["the the the the antidisestablishment international", "naive words again and again and again", "na\u00efve caf\u00e9 \u2014 and", ""]
    doc_ids = pa.array([5, None, 7, 8], pa.int64())
    flat, count = next(pieces.encode_batch(doc_ids, pa.array(texts), pieces.MODEL, 0.3, 11))
    got = [x.tolist() for x in np.split(flat, np.cumsum(count)[:-1])]
    salt = mix(np.array([11], np.uint64))[0]
    for doc_id, text, ids in zip([5, -1, 7, 8], texts, got, strict=True):
        doc = mix(np.array([doc_id], np.int64).view(np.uint64) ^ salt)[0]
        want, bounds = [], pieces_units(" " + text) if text else []
        for number, unit in enumerate(bounds):
            with np.errstate(over="ignore"):
                key = mix(np.array([doc + np.uint64(number)]))
            skipped = lambda left, right, end, key=key: bool(pieces._skipped(key, pieces._merge_hash(np.array([left]), np.array([right]), np.array([end])), 0.3)[0])
            want += agenda(processor, unit, 0.3, skipped)
        assert ids == want


def pieces_units(spaced):
    """The units of a text with its leading space, each less the space that agenda() puts before it."""
    model = pieces._model(pieces.MODEL)
    raw = spaced.encode()
    cuts = [k for k in range(1, len(raw)) if not model.together[raw[k - 1], raw[k]] or (raw[k] == 0x20 and raw[k - 1] != 0x20)]
    units = [raw[a:b].decode() for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)]
    assert all(u.startswith(" ") for u in units), units
    return [u[1:] for u in units]


def test_each_occurrence_of_a_word_is_drawn_for_itself(spark):
    data = spark.createDataFrame([(k, " ".join(["international"] * 200)) for k in range(4)], "doc_id long, text string")
    got = pieces.encode(data, dropout=0.3).collect()
    assert len({tuple(r.ids) for r in got}) == 4
    words = [tuple(processor_words(r.ids)) for r in got]
    forms = Counter(w for x in words for w in x)
    assert len(forms) > 8 and forms.most_common(1)[0][1] < 780


def processor_words(ids):
    """The ids of each word: the texts of these tests have pieces that begin with a space at words only."""
    model = pieces._model(pieces.MODEL)
    words = []
    for i in ids:
        if model.surface[model.surface_start[i]] == 0x20:
            words.append([])
        words[-1].append(i)
    return [tuple(w) for w in words]


def test_dropout_varies_and_decodes_losslessly(docs):
    seeds = {}
    for seed in (1, 1, 2):
        encoded = pieces.encode(docs, dropout=0.3, seed=seed).collect()
        seeds.setdefault(seed, []).append(Counter((r.doc_id, tuple(r.ids)) for r in encoded))
    assert seeds[1][0] == seeds[1][1] != seeds[2][0]
    back = pieces.decode(pieces.encode(docs, dropout=0.3)).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((r[0], r[1] or "") for r in rows())
    digest = pieces.round_trip(docs).collect()
    assert all(r.lossless for r in digest) and len(digest) == len(rows())
    assert {r.n_tokens for r in digest if r.doc_id in (70, 71)} == {0}


def test_pieces_of_nothing(no_docs):
    assert pieces.round_trip(no_docs).count() == 0


@pytest.mark.parametrize("shards", [1, 7, 24, 100])
def test_shards_are_even_and_keep_the_mixture(docs, shards):
    got = sharding.shard(docs, shards).collect()
    n = docs.count()
    sizes = Counter(r.shard for r in got)
    assert len(got) == n and set(sizes) <= set(range(shards))
    assert max(sizes.values()) - (min(sizes.values()) if len(sizes) == shards else 0) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows())
    if shards == 7:
        share = Counter(r[3] for r in rows())
        for source in share:
            each = Counter(r.shard for r in got if r.source == source)
            assert max(each.values()) - min(each[s] for s in range(7)) <= 2


def test_shards_of_nothing(no_docs):
    assert sharding.shard(no_docs).count() == 0


def target_by_rounds(sizes):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), list(names), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / whole > 2 * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / whole for s in open_}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    return out


def test_mix_meets_its_targets(docs):
    got = mixing.mix(docs).collect()
    words = lambda t: len([w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t or "").split(" ") if w])
    sizes = Counter()
    for r in rows():
        sizes[r[3]] += words(r[1])
    want = target_by_rounds(sizes)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], words(r[1])) for r in rows())
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken <= 2 * r.size and r.taken == r.copies * r.size
    largest = {s: max(words(r[1]) for r in rows() if r[3] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    again = mixing.mix(docs.repartition(2)).collect()
    assert Counter((r.doc_id, r.source, r.taken) for r in again) == Counter((r.doc_id, r.source, r.taken) for r in got)
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({k: v for k, v in sum((Counter({r.doc_id: r.copies}) for r in got), Counter()).items() if v})


def test_a_source_at_its_cap_is_spread(spark, monkeypatch):
    rows = [(k, "a b c", "capped" if k < 400 else f"other{k % 2}") for k in range(1200)]
    places = []
    real = mixing.running
    monkeypatch.setattr(mixing, "running", lambda df, *a: places.append(df) or real(df, *a))
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.copies for r in got if r.source == "capped"} == {2}
    assert places[0].where("source = 'capped' and p = 0").select("place").distinct().count() == 400


def test_frequencies_follow_the_inclusion_odds(spark):
    """Documents of unlike length have unlike odds within a source, and are taken as often as these say; how many are taken doesn't depend on the draw."""
    docs = spark.createDataFrame([(k, " ".join(["w"] * (1 + (k * k) % 197)), f"s{k % 3}") for k in range(6000)], "doc_id long, text string, source string").cache()
    totals = []
    for seed in (1, 2):
        got = mixing.mix(docs, seed=seed).collect()
        totals.append(Counter({s: sum(r.copies for r in got if r.source == s) for s in ("s0", "s1", "s2")}))
        by = defaultdict(list)
        for r in got:
            if r.p > 0:
                # expected copies are whole + p, so what was drawn is copies - whole: 0 or 1
                by[r.source, round(r.p, 1)].append((r.copies, r.p))
        assert len(by) > 6
        for drawn in by.values():
            if len(drawn) > 150:
                low = min(c for c, _ in drawn)
                share = sum(c - low for c, _ in drawn) / len(drawn)
                assert share == pytest.approx(sum(p for _, p in drawn) / len(drawn), abs=4 * (0.25 / len(drawn)) ** 0.5 + 0.01)
    assert totals[0] == totals[1]


def test_mix_of_nothing(no_docs):
    assert mixing.mix(no_docs).count() == 0
    assert mixing.mixed(no_docs).count() == 0
