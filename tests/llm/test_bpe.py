"""Byte-level BPE against the public encoder and against its own decoding."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from llm_rows import docs

from shopflow.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def coders():
    ranks = bpe.parse_ranks(bpe.read_ranks(PATH))
    return bpe.Encoder(ranks, P.PATTERN), tiktoken.Encoding(
        "own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_equals_the_public_encoder(coders, text):
    own, public = coders
    assert ids(own.encode(text)) == public.encode_ordinary(text)
    assert own.decode(own.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "'s", " ", "  ", "\n", "\t", " ", "\x1c", "　", "1", "?", "é"]), max_size=12))
def test_white_space_runs(coders, parts):
    own, public = coders
    assert ids(own.encode("".join(parts))) == public.encode_ordinary("".join(parts))


@pytest.mark.parametrize("text", [
    "a" * 3000, "ab" * 2000, "the" * 1500 + "é" * 700, "日本語" * 600, " " * 900, "x" + "\n" * 500 + "y"])
def test_long_pre_tokens(coders, text):
    own, public = coders
    assert ids(own.encode(text)) == public.encode_ordinary(text)


def test_queue_is_empty_after_every_pre_token(coders):
    merge = bpe.Merger(bpe.parse_ranks(bpe.read_ranks(PATH)))
    rng = random.Random(3)
    for _ in range(200):
        merge.merge(bytes(rng.choice(b"theinrdsaou") for _ in range(rng.randint(2, 40))))
        assert not merge.buckets and not any(merge.low)


def plain_ids(ranks, data):
    """The definition: the lowest pair of all, the leftmost of equal ones, is merged next."""
    runs = [bytes((b,)) for b in data]
    while len(runs) > 1:
        rank, at = min((ranks.get(a + b, 1 << 40), k) for k, (a, b) in enumerate(zip(runs, runs[1:])))
        if rank == 1 << 40:
            break
        runs[at:at + 2] = [runs[at] + runs[at + 1]]
    return [ranks[r] for r in runs]


def test_a_shared_queue_merges_each_pre_token_as_if_alone():
    rng = random.Random(5)
    for _ in range(30):
        # Tokens in any order: a merge may make a pair of a lower rank than its own.
        tokens = {bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(60)}
        tokens = [b"a", b"b", b"c", b"\0", *tokens]
        rng.shuffle(tokens)
        ranks = {token: 7 * k for k, token in enumerate(tokens)}
        shared = bpe.SharedMerger(ranks)
        pieces = [bytes(rng.choice(b"aaabc\0") for _ in range(rng.randint(1, 24))) for _ in range(150)]
        found, counts = shared.merge(pieces)
        found = found.tolist()
        assert found == [i for p in pieces for i in plain_ids(ranks, p)]
        assert counts.tolist() == [len(plain_ids(ranks, p)) for p in pieces]
        assert not shared.buckets and not shared.top and not any(shared.low)
    assert [x.tolist() for x in shared.merge([])] == [[], []]


def test_a_byte_without_a_rank_is_refused_unless_merged():
    ranks = {b"a": 0, b"b": 1, b"ax": 2, b"axb": 3}
    merge = bpe.SharedMerger(ranks).merge
    assert merge([b"baxb", b"ax"])[0].tolist() == [1, 3, 2]
    with pytest.raises(KeyError):
        merge([b"ax", b"xa"])


def test_rare_words_share_a_queue(coders, monkeypatch):
    own, public = bpe.Encoder(bpe.parse_ranks(bpe.read_ranks(PATH)), P.PATTERN), coders[1]
    alone, merge = [], own.merge
    monkeypatch.setattr(own, "merge", lambda data: alone.append(data) or merge(data))
    monkeypatch.setattr(bpe, "MERGED_BYTES", 3000)
    rng = random.Random(11)
    words = ["".join(rng.choice("theinrdsaouéß") for _ in range(rng.randint(5, 15))) for _ in range(2000)]
    words[700] = "q" * (bpe.LONG_BYTES + 1)
    texts = [" ".join(words[k:k + 100]) + rng.choice(["", ",", "\n", " "]) for k in range(0, 2000, 50)]
    found, first = own.encode_block(texts)
    for text, a, b in zip(texts, first, first[1:]):
        assert found[a:b].tolist() == public.encode_ordinary(text)
    assert set(alone) <= {words[700].encode(), b" " + words[700].encode()}


def test_a_pattern_that_leaves_spaces_out(coders):
    own = bpe.Encoder(bpe.parse_ranks(bpe.read_ranks(PATH)), r"\p{L}+")
    assert own.decode(own.encode("one two, three")) == b"onetwothree"


def test_what_is_remembered_is_bounded_and_forgotten(coders, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_BYTES", 3000)
    monkeypatch.setattr(bpe, "GATHERED", 5)
    own, public = bpe.Encoder(bpe.parse_ranks(bpe.read_ranks(PATH)), P.PATTERN), coders[1]
    texts = [" ".join(f"wordy{i % 7}, word{i % k}." for i in range(60)) for k in range(1, 12)]
    for low in range(0, len(texts), 3):
        ids_of, first = own.encode_block(texts[low:low + 3])
        for text, a, b in zip(texts[low:], first, first[1:]):
            assert ids_of[a:b].tolist() == public.encode_ordinary(text)
        assert own.weight < 3000 + 40_000
    own.clear()
    assert not own.spaced and not own.pieces and not own.ids


def test_unknown_ids_have_no_bytes(coders):
    with pytest.raises(KeyError):
        coders[0].decode(np.array([10**6], "<u4").tobytes())


def test_rows_of_every_kind(spark, coders):
    rows = [(1, "Hello  world"), (2, None), (3, ""), (1, "Hello  world"), (None, "x"), (5, "word " * 30_000)]
    got = {}
    for r in bpe.digests(docs(spark, rows), PATH, P.PATTERN).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert len(got[1]) == 2 and got[1][0] == got[1][1]
    for doc_id, text in rows:
        want = coders[1].encode_ordinary(text or "")
        r = got[doc_id][0]
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.digests(docs(spark, []), PATH, P.PATTERN).count() == 0


def test_decode_of_stored_ids(spark):
    frame = docs(spark, [(1, "naïve café"), (2, None)])
    coded = bpe.encode(frame, PATH, P.PATTERN)
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, PATH).collect()}
    assert back == {1: "naïve café".encode(), 2: b""}


def test_a_huge_vocabulary_is_refused(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "VOCABULARY_BYTES", 10)
    (tmp_path / "v").write_bytes(b"x" * 11)
    with pytest.raises(ValueError):
        bpe.read_ranks(str(tmp_path / "v"))


def test_other_work_frees_what_was_remembered():
    import pyarrow as pa

    from shopflow.llm import arrow

    coder = bpe._encoder(bpe.read_ranks(PATH), P.PATTERN)
    assert bpe._encoder(bpe.read_ranks(PATH), P.PATTERN) is coder
    list(arrow.text_blocks(pa.array(["a"])))
    assert not bpe._encoders
