"""The transducer against the tiktoken library, the decoder against the codecs module, the operator on odd rows."""

import codecs
import hashlib

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN

from stratum.llm import bpe_transducer as bpe
from stratum.llm import queries

RANKS = bpe.read_ranks(bpe.default_vocabulary())
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER, VOCABULARY = bpe.codec(bpe.default_vocabulary())
TEXTS = st.one_of(st.text(max_size=60), st.text("ab thing's'll \n\t19.,!?éüß日本語　\xa0 \x85\x1c​😀&*", max_size=80), st.text("aeinrst ", max_size=200))


def ids_of(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_ids_are_those_of_the_library(text):
    assert ids_of(ENCODER.encode(text)) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", " ", "a" * 7000, "ab" * 3000, "=" * 5000, "日本語" * 2000, " the" * 500, "\n" * 999 + " x", "x " * 9 + "\xa0  y", "un" + "believ" * 700, "'s 's's", "Ａ" * 300])
def test_long_and_odd_matches(text):
    assert ids_of(ENCODER.encode(text)) == LIBRARY.encode_ordinary(text)


def test_ids_do_not_depend_on_what_is_kept():
    words = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(4000))
    small = bpe.Encoder(RANKS, PATTERN, max_cache=3)
    small.transducer.max_states = 20
    for text in (words, " ".join(words[i : i + i % 9] for i in range(900)), "été " * 50 + words):
        assert ids_of(small.encode(text)) == LIBRARY.encode_ordinary(text)


def test_pairs_are_those_that_merging_keeps():
    rng = np.random.default_rng(5)
    t = ENCODER.transducer
    for a, b in rng.integers(0, len(RANKS), (3000, 2)).tolist():
        joined = VOCABULARY.bytes_of[a] + VOCABULARY.bytes_of[b]
        assert t._may_follow(a, b) == (LIBRARY._encode_single_piece(joined) == [a, b])


def keeps(ranks, left, right):
    """By merging the joined bytes, the lowest rank first, the leftmost of equals."""
    parts, border = [bytes([b]) for b in left + right], len(left)
    while True:
        joined = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
        if not joined:
            return parts == [x for x in (left, right) if x]
        i = min(joined)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if border and border not in (sum(map(len, parts[:k])) for k in range(len(parts))):
            return False


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abc", min_size=2, max_size=7), unique=True, max_size=25))
def test_pairs_of_any_vocabulary(words):
    """Also where a part of a token has a higher rank than the token, or merging does not give it."""
    ranks = {w.encode(): i for i, w in enumerate(["a", "b", "c", *words])}
    t = bpe.Transducer(ranks)
    for left in (b"", *ranks):
        for right in ranks:
            assert t._may_follow(ranks.get(left), ranks[right]) == keeps(ranks, left, right)


def test_pairs_cut_from_tokens():
    rng, t = np.random.default_rng(6), ENCODER.transducer
    for whole in rng.choice([x for x in RANKS if len(x) > 3], 3000, replace=False).tolist():
        for at in range(1, len(whole)):
            left, right = whole[:at], whole[at:] + b"s"
            if left in RANKS and right in RANKS:
                assert t._may_follow(RANKS[left], RANKS[right]) == keeps(RANKS, left, right)


class Counted(dict):
    asked = 0

    def get(self, key, default=None):
        self.asked += 1
        return super().get(key, default)


def test_a_pair_takes_a_lookup_for_each_part_at_its_border():
    """Merging every pair anew took a lookup for each two neighbours after each merge."""
    t = bpe.Transducer(RANKS)
    t.ranks = Counted(RANKS)
    long = [RANKS[x] for x in sorted((x for x in RANKS if x.isalpha()), key=len)[-30:]]
    pairs = [(a, b) for a in long for b in long]
    for a, _ in pairs:
        t._may_follow(a, a)
    t.ranks.asked = 0
    for a, b in pairs:
        t._may_follow(a, b)
    assert 0 < t.ranks.asked <= sum(len(t.bytes_of[a] + t.bytes_of[b]) for a, b in pairs)


@pytest.mark.parametrize("text", ["word\xa0word word\xa0word word", "word! word? word; word&&& word)", "\nwörd? wörd! wörd; wörd&&&"])
def test_a_match_goes_through_the_transducer_once(text):
    encoder, asked = bpe.Encoder(RANKS, PATTERN), []
    encode = encoder.transducer.encode
    encoder.transducer.encode = lambda match: asked.append(match) or encode(match)
    assert ids_of(encoder.encode(text)) == LIBRARY.encode_ordinary(text)
    assert sorted(asked) == sorted(set(asked))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, len(RANKS) - 1)), max_size=40), st.lists(st.integers(1, 9), min_size=1, max_size=5))
def test_streaming_decoder_in_any_portions(ids, sizes):
    data = b"".join(VOCABULARY.bytes_of[i] for i in ids)
    decoder, out, at, n = bpe.StreamingDecoder(VOCABULARY), [], 0, 0
    incremental = codecs.getincrementaldecoder("utf-8")("replace")
    ids = np.array(ids, dtype="<u4")
    while at < len(ids):
        part = ids[at : at + sizes[n % len(sizes)]]
        out.append(decoder.feed(part))
        assert out[-1] == incremental.decode(b"".join(VOCABULARY.bytes_of[i] for i in part.tolist()))
        at, n = at + len(part), n + 1
    assert "".join(out) + decoder.finish() == data.decode("utf-8", "replace")


def expected(text):
    ids = LIBRARY.encode_ordinary(text or "")
    packed = np.array(ids, dtype="<u4").tobytes()
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_operator_on_odd_rows(spark):
    long = "Ünder the 日本 sea 12.5, it's\n\n  " * 8000
    rows = [(1, None, 9, "x"), (2, "", 9, "x"), (3, "a b", 9, "x"), (3, "a b", 9, "x"), (None, "a b", 9, None), (4, long, 9, "x"), (5, " \n\t ", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, ids_sha256 string")
    got = sorted(map(tuple, bpe.encoded_documents(docs).collect()), key=str)
    assert got == sorted(((i, *expected(t)) for i, t, _, _ in rows), key=str)
    assert {r.doc_id: list(r.ids) for r in bpe.encoded_texts(docs).where("doc_id = 4").collect()} == {4: LIBRARY.encode_ordinary(long)}
    assert bpe.encoded_documents(docs.limit(0)).collect() == []


def test_query_over_the_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = queries.op12_transducer_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:] == expected(docs[r.doc_id])
