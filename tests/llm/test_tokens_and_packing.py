"""Token counts, byte-pair coding and packing against the public libraries."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers

from farelens.llm import bpe, packing, queries, token_counts
from farelens.llm.common import BoundedCache
from tests.llm import data

ODD = ["", " ", "  a  b ", "a▁b", "▁", "日本語 テキスト😀 x", "<s> </s> <unk> <0x0A>", "x\n\n y \t z",
       " nb\u00a0sp\u3000id", "<|endoftext|> a<|endoftext|>", "a <|endoftext|>  b", "it's we'll 'S \r\n",
       "1234 5678９ ²½", "a" * 3000, "\0x", "a.b.c  \n", "\n", "é" * 900, "\x85 a\x1cb"]


def mixed(count, seed):
    rng = random.Random(seed)
    letters = " \n\tab1.,'sé▁日<|>"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(count)]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(queries.BYTE_BPE)


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*mixed(150, 1), *data.random_texts(60, 2)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(0, "again", "y"), (None, "no id", "z")]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, ids STRING").repartition(3).cache()


def test_counts_equal_the_library():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_BPE)
    pieces = token_counts.PieceCounter(queries.PIECE_BPE)
    for text in mixed(500, 3):
        assert pieces.count(text) == len(model.encode(text)), text
    pieces.cuts = False
    assert [pieces.count(t) for t in ODD] == [len(model.encode(t)) for t in ODD]


def test_token_counts_query(spark, docs):
    pieces = token_counts.PieceCounter(queries.PIECE_BPE)
    rows = token_counts.token_counts(docs, queries.PIECE_BPE, limit=40).collect()
    expected = sorted((pieces.count(r.text or ""), len((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.n_tokens, r.n_bytes) for r in rows) == expected
    assert all(r.over_limit == (r.n_tokens > 40) for r in rows)
    assert token_counts.token_counts(docs.limit(0), queries.PIECE_BPE).collect() == []


def test_coding_equals_the_library(library):
    vocabulary = bpe.ByteVocabulary(queries.BYTE_BPE)
    cached = bpe.RoundTrip(vocabulary)
    cached.parts.limit = cached.joined.limit = 20
    for text in mixed(500, 4):
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text, vocabulary) == ids, text
        digits, count, decoded = cached.both_ways(text)
        assert digits == ",".join(map(str, ids)) and count == len(ids)
        assert decoded.decode() == library.decode(ids, skip_special_tokens=False) == bpe.decode(ids, vocabulary)
    assert bpe.decode(vocabulary.first[0xC3:0xC4], vocabulary) == "\ufffd"


def test_coding_queries(spark, docs, library):
    texts = {r.doc_id: r.text or "" for r in docs.filter("doc_id > 0").collect()}
    rows = {r.doc_id: r for r in bpe.round_trip_digests(docs.filter("doc_id > 0"), queries.BYTE_BPE).collect()}
    whole = {r.doc_id: r for r in bpe.encoded(docs.filter("doc_id > 0"), queries.BYTE_BPE).collect()}
    for i, text in texts.items():
        ids = library.encode(text, add_special_tokens=False).ids
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (whole[i].ids, whole[i].decoded) == (ids, text)


def test_blanks_beside_white_space_are_found():
    """As a plain pattern over every character finds them."""
    pattern, rng = re.compile(r"\s | \s| \Z"), random.Random(4)
    texts = ["".join(rng.choices(" \n\t\x85\xa0\u2009\u3000\x1cab\u200bé", k=rng.randint(0, 6))) for _ in range(20_000)]
    assert all(bpe.uneven(text) == bool(pattern.search(text)) for text in texts)


def test_words_of_letters_are_kept_once(library):
    """Of 390,000 new words none is forgotten, and their parts are not kept beside them."""
    letters = "abcdefghij"
    words = ["".join(letters[int(digit)] for digit in str(i)) for i in range(390_000)]
    coder = packing.LibraryIds(queries.BYTE_BPE)
    for at in range(0, len(words), 1000):
        coder.ids("x " + " ".join(words[at:at + 1000]))
    assert all(word in coder.joined for word in words)
    assert not any(" " + word in coder.parts for word in words)
    text = "x jjj, jjj! jjj\nabc déjà."
    assert coder.ids(text) == np.array(library.encode(text).ids, np.uint32).tobytes()


def test_merges_take_the_leftmost_lowest_rank():
    pairs = {(0, 0): (1, 5), (5, 0): (0, 6)}
    assert bpe.merge_all([0, 0, 0, 0, 0], pairs) == [6, 5]
    assert bpe.merge_all([], pairs) == [] and bpe.merge_all([0], pairs) == [0]


def test_cache_forgets_but_answers():
    cache = BoundedCache(len, limit=3)
    assert [cache["a" * n] for n in (1, 2, 3, 4, 1, 5, 100, 2)] == [1, 2, 3, 4, 1, 5, 100, 2]
    assert len(cache) <= 3 and "a" * 100 not in cache


@pytest.mark.parametrize("per_group", [60_000, 40])
def test_packing(spark, docs, library, per_group):
    """One group, and several levels of groups."""
    rows = packing.pack(packing.token_pieces(docs, queries.BYTE_BPE, 64), 64, per_group).collect()
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    total = 0
    pieces: dict = {}
    for row in rows:
        pieces.setdefault((row.doc_id, row.ids_crc32, row.start, row.length), []).append(row)
    for doc_id, text in texts:
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        total += len(ids)
        start, end, piece = 0, len(ids) % 64 or 64, 0
        while start < len(ids):
            crc = zlib.crc32(np.array(ids[start:end], "<u4").tobytes())
            assert pieces[doc_id, crc, start, end - start].pop().piece == piece
            start, end, piece = end, end + 64, piece + 1
    assert not any(pieces.values())
    bins: dict = {}
    for row in rows:
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-total // 64) * 1.02 + 1


def test_sum_of_squares_picks_the_smallest_sum():
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 20, 300)
    bins, fills = packing.sum_of_squares(lengths, 20)
    gaps: list[int] = []
    for item, size in enumerate(lengths.tolist()):
        def total(after):
            counts = np.bincount([g for g in after if g], minlength=21)
            return int((counts ** 2).sum())
        options = {b: total(gaps[:b] + [gaps[b] - size] + gaps[b + 1:])
                   for b in range(len(gaps)) if gaps[b] >= size}
        options[len(gaps)] = total(gaps + [20 - size])
        assert options[int(bins[item])] == min(options.values())
        if bins[item] == len(gaps):
            gaps.append(20)
        gaps[bins[item]] -= size
    assert fills.tolist() == [20 - g for g in gaps]


@pytest.mark.parametrize("mix", ["copies", "long", "short"])
def test_packing_keeps_every_group_bounded(spark, mix):
    """Lengths of which most leave gaps that nothing fills; none may meet in one task."""
    rng = np.random.default_rng(9)
    lengths = {"copies": np.where(np.arange(12_000) % 3 == 0, 1500, rng.lognormal(6.3, 0.7, 12_000)),
               "long": rng.integers(1025, 2048, 12_000),
               "short": rng.lognormal(5, 0.7, 12_000)}[mix].astype(int).clip(1, 2047)
    pieces = spark.createDataFrame([(7, 0, 0, n, i, i) for i, n in enumerate(lengths.tolist())],
                                   packing.PIECES)
    rows = packing.pack(pieces, 2048, 1000).collect()
    assert sorted(r.ids_crc32 for r in rows) == list(range(12_000))
    fills: dict = {}
    groups: dict = {}
    for r in rows:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
        groups[r.sequence_id >> 26] = groups.get(r.sequence_id >> 26, 0) + 1
    assert max(fills.values()) <= 2048 and max(groups.values()) <= 1200
    assert len(fills) <= (packing.best_fit(lengths, 2048).max() + 1) * 1.02


@pytest.mark.parametrize("scale, placed, above_bound", [("sf0.01", 0.65, 2), ("sf0.1", 0.9, 0)])
def test_sum_of_squares_places_most_documents(library, scale, placed, above_bound):
    """How many keep the place that sum-of-squares gave them, and that no fewer sequences
    could hold them all, give or take what a small table's end leaves."""
    import pyarrow.parquet as pq
    texts = pq.read_table(f"/root/testdata/{scale}/documents.parquet", columns=["text"])["text"].to_pylist()
    sizes = np.array([len(found.ids) + 1 for found in library.encode_batch(
        [t or "" for t in texts], add_special_tokens=False)])
    lengths = sizes % 2048
    lengths = lengths[lengths > 0]
    order = np.argsort(-lengths, kind="stable")
    first = np.empty(len(lengths), np.int64)
    first[order], fills = packing.sum_of_squares(lengths[order], 2048)
    bins, done = packing.pack_items(lengths, 2048, True)
    assert done.all() and np.mean(bins == first) >= placed
    assert len(np.unique(bins)) <= -(-int(lengths.sum()) // 2048) + above_bound
    stays = packing.pack_items(lengths, 2048, False)[1]
    assert (bins[stays] == first[stays]).all()


def test_packing_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert packing.packed_documents(empty, public_tokenizers.path("byte_bpe_50k.json")).collect() == []
