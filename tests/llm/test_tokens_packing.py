"""Tokens against the tokenizer libraries, packings against their rules."""

import random
import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlake.llm import packing, sentencepiece_codec, token_counts
from fleetlake.llm.packing import planned
from fleetlake.llm.piece_model import NORMAL, UNIGRAM, load_pieces
from tests.llm.helpers import LONG, frame

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, " ", "   ", "  a  b ", "\n\n x\n", "<s> a </s>", "▁x ▁", "café 𝄞\t\ta", "a\x00b", "漢字かな", "é", "----------------",
    "<|endoftext|> x <|startoftext|>", "it's THE're 12345", "a\x1cb\u2003c\x85d", "x" * 3000, " " * 50, "ﬁ ½ Ⅷ", LONG[:20_000],
]


def noise(seed, n=300):
    rng = random.Random(seed)
    letters = "ab \n▁the ing*-=  .é漢\t0123𝄞'"
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_token_counts_are_the_library_s(spark, library):
    texts = ODD + noise(1)
    for r in token_counts.token_counts(frame(spark, texts), PIECES, limit=40).collect():
        text = texts[r["doc_id"]] or ""
        n = len(library.encode(text))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 40), text[:80]


def test_token_counts_of_real_texts(spark, library, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    for r in token_counts.token_counts(docs, PIECES).collect():
        assert r["n_tokens"] == len(library.encode(texts[r["doc_id"]]))


def test_encoding_is_the_library_s(spark, library, small):
    texts = ODD + noise(2) + [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    rows = sentencepiece_codec.encoded(frame(spark, texts), PIECES)
    for r in rows.collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]] or ""), texts[r["doc_id"]]
        assert r["round_trip"]
    back = sentencepiece_codec.decoded(rows, PIECES)
    for r in back.collect():
        assert r["text"] == (texts[r["doc_id"]] or "").replace("▁", " ")


def test_a_small_cache_encodes_nothing_twice(library, small, monkeypatch):
    """Units that the cache forgets within a batch are not encoded again, one by one."""
    monkeypatch.setattr(sentencepiece_codec, "CACHE", 50)
    codec = sentencepiece_codec.Codec(PIECES)
    lattices, real = [], codec._learned
    monkeypatch.setattr(codec, "_learned", lambda units: lattices.append(len(units)) or real(units))
    texts = [r["text"] for r in pq.read_table(f"{small}/documents.parquet", columns=["text"]).to_pylist()] * 2
    assert [np.frombuffer(raw, "<i4").tolist() for raw in codec.encode(texts)] == [library.encode(t) for t in texts]
    assert len(lattices) == 1 and lattices[0] > 1000 and len(codec) + len(codec.older) <= 100


@pytest.mark.parametrize("long", [1, 1024])
def test_long_units_and_what_the_cache_keeps(library, monkeypatch, long):
    """Texts without white space, of any length, also against the batched lattice; none of them is kept."""
    monkeypatch.setattr(sentencepiece_codec, "LONG", long)
    codec = sentencepiece_codec.Codec(PIECES)
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcXYZ019+/é漢") for _ in range(n)) for n in (70, 500, 3000)] + ["ab" * 700, "-" * 999, "plain words here"]
    assert [np.frombuffer(raw, "<i4").tolist() for raw in codec.encode(texts)] == [library.encode(t) for t in texts]
    assert max(map(len, codec)) <= sentencepiece_codec.KEPT


def test_a_megabyte_without_white_space(library):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEF0123456789+/") for _ in range(1 << 20))
    began = time.process_time()
    (raw,) = sentencepiece_codec.codec(PIECES).encode([text])
    assert time.process_time() - began < 120
    assert np.frombuffer(raw, "<i4").tolist() == library.encode(text)


def test_verdicts_are_those_of_merging():
    verdicts = sentencepiece_codec.PairVerdicts(PIECES)
    rng, pieces = random.Random(6), verdicts.pieces
    normal = [i for i, t in enumerate(verdicts.merger.model.types) if t == NORMAL]
    number = {pieces[i]: i for i in normal}
    pairs = [(rng.choice(normal), rng.choice(normal)) for _ in range(2000)]
    for text in rng.sample(sorted(number), 2000):  # pairs that could merge
        cut = rng.randint(1, max(1, len(text) - 1))
        if text[:cut] in number and text[cut:] in number:
            pairs.append((number[text[:cut]], number[text[cut:]]))
    for one, two in pairs:
        symbols = [s for s in verdicts.merger.merged(pieces[one] + pieces[two])[0] if s]
        assert verdicts.judged(one * verdicts.width + two) == (symbols == [pieces[one], pieces[two]])


@pytest.mark.parametrize("encode", [sentencepiece_codec.encoded, token_counts.token_counts])
def test_tokens_of_odd_tables(spark, encode):
    """Null and repeated ids, repeated rows, no rows, columns called like the results."""
    rows = frame(spark, [(1, "a b"), (1, "a b"), (None, "x"), (2, None)]).withColumns({c: F.lit("z") for c in ("ids", "round_trip", "n_tokens", "over_limit", "n_bytes")})
    found = encode(rows, PIECES).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found) == [(False, 1), (False, 1), (False, 2), (True, 0)]
    assert encode(rows.limit(0), PIECES).count() == 0


def test_decoding_odd_lists(spark, library):
    lists = [[], None, [259, 3, 200, 31999, None, 1], [0], [230, 150, 160]]
    rows = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    found = {r["doc_id"]: r["text"] for r in sentencepiece_codec.decoded(rows, PIECES).collect()}
    assert found[0] == "" and found[1] is None
    assert found[3] == library.decode([0]) or found[3].strip() == "⁇"


def test_unigram_models_maximise_the_sum_of_scores(tmp_path):
    """A hand-written unigram model, against the library and against all segmentations."""
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -4.6, "▁a": -4.0, "ba": -3.1, "aba": -6.0, "▁ab": -6.1}

    def field(number, kind, value):
        if kind == 0:
            return bytes([number << 3]) + bytes([value])
        return bytes([number << 3 | 2, len(value)]) + value

    def piece(text, score, kind=1):
        raw = field(1, 2, text.encode()) + bytes([2 << 3 | 5]) + np.float32(score).tobytes() + field(3, 0, kind)
        return field(1, 2, raw)

    model = piece("<unk>", 0, 2) + b"".join(piece(p, s) for p, s in scores.items())
    model += field(2, 2, field(3, 0, UNIGRAM)) + field(3, 2, field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1))
    path = tmp_path / "tiny.model"
    path.write_bytes(model)
    assert load_pieces(str(path)).kind == UNIGRAM
    theirs = sentencepiece.SentencePieceProcessor(model_file=str(path))
    coder = sentencepiece_codec.Codec(str(path))
    rng = random.Random(3)
    texts = ["".join(rng.choice("aab  xy") for _ in range(rng.randint(0, 12))) for _ in range(200)]
    for text, raw in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(raw, "<i4").tolist() == theirs.encode(text), text


def pieces_of(text, capacity, encode):
    ids = [*encode(text or ""), 1]
    return [(k, at, ids[at : at + capacity]) for k, at in enumerate(range(0, len(ids), capacity))]


def check_packing(rows, texts, capacity):
    encoder = Tokenizer.from_file(WORDS)
    encode = lambda t: encoder.encode(t, add_special_tokens=False).ids
    found = {(r["doc_id"], r["piece"]): r for r in rows}
    expected = {(i, k): (at, ids) for i, t in texts.items() for k, at, ids in pieces_of(t, capacity, encode)}
    assert found.keys() == expected.keys()
    sequences = defaultdict(list)
    for key, (at, ids) in expected.items():
        r = found[key]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (r["start"], r["length"], r["ids_crc32"]) == (at, len(ids), crc)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def test_packing_of_odd_texts(spark):
    texts = dict(enumerate(ODD + noise(4, 60)))
    for capacity in (4096, 32, 3):
        rows = packing.packed_sequences(frame(spark, list(texts.values())), WORDS, capacity=capacity).collect()
        n = check_packing(rows, texts, capacity)
        tokens = sum(r["length"] for r in rows)
        assert n <= 1.08 * tokens / capacity + 1


def test_packing_of_real_texts_is_tight(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").withColumn("number", F.lit(1)).withColumn("length", F.lit(2))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = packing.packed_sequences(docs, WORDS).collect()
    assert check_packing(rows, texts, 4096) <= sum(r["length"] for r in rows) / 4096 + 2


def test_packing_nothing_and_repeated_rows(spark):
    assert packing.packed_sequences(frame(spark, ["x"]).limit(0), WORDS).count() == 0
    rows = packing.packed_sequences(frame(spark, [(1, "a b"), (1, "a b"), (None, "a b"), (None, None)]), WORDS).collect()
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    assert len(rows) == 4 and len({p[:2] for p in places}) == 4 and len({p[0] for p in places}) == 1


@pytest.mark.parametrize("seed", range(6))
def test_plans_fill_no_sequence_beyond_its_capacity(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 30, 97])
    counts = {rng.randint(1, capacity): rng.randint(1, 40) for _ in range(rng.randint(1, 40))}
    numbers, fill = defaultdict(list), defaultdict(list)
    for length, first, n, sequence, offset in planned(counts, capacity):
        numbers[length] += range(first, first + n)
        for i in range(n):
            fill[sequence + i].append((offset, length))
    assert {k: sorted(v) for k, v in numbers.items()} == {k: list(range(c)) for k, c in counts.items()}
    for places in fill.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(k * c for k, c in counts.items())
    alone = sum(c for k, c in counts.items() if 2 * k > capacity)
    assert len(fill) <= 11 / 9 * max(-(-total // capacity), alone) + 2
