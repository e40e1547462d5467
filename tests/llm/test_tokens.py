"""op2 and op10 against the libraries, and round trips."""

import base64
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm import brute
from tidemark.llm import bpe, token_files, word_bpe
from tidemark.llm.registry import RANK_FILE, WORD_FILE, op2_byte_bpe, op10_token_files
from tidemark.llm.words import chunks

TOKENS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
FILES = ["doc_id", "start", "n_tokens", "ids_crc32"]


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    with open(RANK_FILE, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANK_FILE, public_tokenizers.PATTERN)


def _tokens(rows, plain):
    out = []
    for d, t in rows:
        ids = plain.encode_ordinary(t or "")
        out.append((d, len(ids), brute.hexed(" ".join(map(str, ids))), brute.hexed(t or "")))
    return out


def test_bpe(spark, edge, pairs, small, plain, same):
    same(bpe.with_token_columns(edge, RANK_FILE, public_tokenizers.PATTERN), TOKENS, _tokens(pairs, plain))
    same(op2_byte_bpe(spark, SF), TOKENS, _tokens(small[1], plain))


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.sampled_from(" \n\t'  aest019.,"), st.characters(exclude_categories=("Cs",))), max_size=80))
def test_bpe_of_any_text(text, encoder, plain):
    assert np.frombuffer(encoder.encode(text), "<i4").tolist() == plain.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(data=st.binary(max_size=60), more=st.binary(max_size=20), at=st.integers(0, 60), size=st.integers(0, 20))
def test_prefixes_append_and_edit(data, more, at, size, encoder, plain):
    of = lambda x: plain._encode_single_piece(x) if x else []
    p = bpe.Prefixes(encoder.ranks, data)
    assert p.ids() == of(data)
    p.append(more)
    assert p.ids() == of(data + more) and p.ids(len(data)) == of(data)
    at = min(at, len(data))
    p.replace(at, at + size, b" the")
    whole = data + more
    assert p.ids() == of(whole[:at] + b" the" + whole[at + size :])


def _files(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_FILE)
    out, start = [], 0
    for d, text in sorted(rows, key=lambda r: (brute.key(r[0]), (r[1] or "").encode())):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, edge, pairs, small, same):
    for shard_ids in (1 << 20, 500):
        path = token_files.new_path(spark, "test-tokens")
        token_files.write_tokens(edge, path, WORD_FILE, shard_ids=shard_ids)
        same(token_files.read_tokens(spark, path), FILES, _files(pairs))
    same(op10_token_files(spark, SF), FILES, _files(small[1]))


def test_no_files(spark, none):
    path = token_files.new_path(spark, "test-tokens")
    token_files.write_tokens(none, path, WORD_FILE)
    assert token_files.read_tokens(spark, path).count() == 0
    assert bpe.with_token_columns(none, RANK_FILE, public_tokenizers.PATTERN).count() == 0


def test_words_with_special_tokens_and_odd_letters():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(WORD_FILE)
    texts = ["a<|endoftext|>b c", "<|startoftext|> x", "İSTANBUL ß ſ ŉ", "e\u0301 \u00a0 a\u2003b", "don't I'LL 12ab", "\x85x \x1f y", "ÀÉÎ œŒ", "x" * 300]
    cache = token_files.WordCache(WORD_FILE, 4)
    assert [np.frombuffer(b, "<u4").tolist() for b in cache.bodies(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**40), max_size=300))
def test_elias_fano(values):
    values.sort()
    seq = token_files.EliasFano.of(np.array(values, np.uint64))
    back, end = token_files.EliasFano.read(memoryview(seq.tobytes()), 0)
    assert end == len(seq.tobytes()) and back.all().tolist() == values and [back[i] for i in range(len(values))] == values


def test_boundaries_take_few_bits():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 10_000))
    assert 8 * len(token_files.EliasFano.of(ends).tobytes()) < 14.5 * len(ends)


def test_one_document_by_select(spark, small):
    path = token_files.new_path(spark, "test-tokens")
    token_files.write_tokens(small[0], path, WORD_FILE)
    row = spark.read.parquet(path).orderBy("part", "seq").first()
    shard = token_files.Shard(row.data)
    texts = dict(small[1])
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(WORD_FILE).encode(texts[shard.doc_id(3)], add_special_tokens=False).ids
    assert shard.ids(3).tolist() == [*ids, 2]
    with pytest.raises(ValueError):
        token_files.Shard(b"NOTTHEIR" + row.data[8:])
    assert spark.read.parquet(path).agg(F.sum("docs")).first()[0] == len(texts)


ODD = st.lists(st.one_of(st.sampled_from(["the ", "'s", "'LL", " ", "\n", "0", "19", ".,", "É", "ß", "×", "œ", "é", "日本", "İ", "\x00", "\x1f", " ", "<|endoftext|>", "abcdefghijklmnopqrst"]), st.characters(exclude_categories=("Cs",))), max_size=25).map("".join)


@pytest.fixture(scope="module")
def words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORD_FILE), [word_bpe.WordEncoder(WORD_FILE), word_bpe.WordEncoder(WORD_FILE, remembered=30)]


def _by_words(encoder, texts):
    out = []
    for _, _, data, offsets in chunks(pa.array(texts, pa.string())):
        ids, at = encoder.encode(data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]
    return out


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(ODD, min_size=1, max_size=6))
def test_words_of_any_texts(texts, words):
    """Also where what is remembered is forgotten at every call."""
    library, encoders = words
    for e in encoders:
        assert _by_words(e, texts) == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_of_documents(small, words):
    library, encoders = words
    texts = [t or "" for _, t in small[1]]
    expected = [library.encode(x, add_special_tokens=False).ids for x in texts]
    assert all(_by_words(e, texts) == expected for e in encoders)


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(ODD, min_size=1, max_size=6))
def test_many_texts_by_prefixes(texts, plain, encoders):
    """Also where what is remembered is forgotten at every call."""
    for e in encoders:
        for _, _, data, offsets in chunks(pa.array(texts, pa.string())):
            ids, at = e.encode_all(data, offsets)
            assert [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)] == [plain.encode_ordinary(x) for x in texts]
            raw, ends = e.decode(ids)
            assert raw.tobytes() == "".join(texts).encode() and [int(ends[x]) for x in at] == offsets.tolist()


@pytest.fixture(scope="module")
def encoders(encoder):
    small = bpe.Encoder(RANK_FILE, public_tokenizers.PATTERN)
    small.short.most = small.long.most = 30
    return [encoder, small]


@settings(max_examples=200, deadline=None)
@given(pieces=st.lists(st.binary(min_size=1, max_size=16), min_size=1, max_size=20))
def test_columns_are_prefixes(pieces, encoder):
    """The last token of every prefix, many pieces at once and one by one."""
    rows = np.frombuffer(b"".join(x.ljust(16, b"\0") for x in pieces), np.uint8).reshape(-1, 16)
    last = encoder.columns.last(rows, np.array([len(x) for x in pieces]))
    for i, x in enumerate(pieces):
        assert last[i, : len(x) + 1].tolist() == bpe.Prefixes(encoder.ranks, x).last
