"""Token counts and pieces against the public libraries."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricebeam.llm.pieces import Pieces, decode_pieces, encode_pieces, rank_scores
from pricebeam.llm.token_counts import MergeTable, count_tokens

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def samples(texts):
    rng = random.Random(3)
    odd = ["", "a" * 500, "aaa aaaa aaaaa", "<|endoftext|>x<|endoftext|>", " \n\n  x\t\ty  ", "日本語テキスト😀😀",
           "don't we'll I'M 12345 ½", "\x00\x01a b", "q \x00b \x00", " a  b", "\x1ca \x1cb", "▁a ▁ b▁", " ", "  "]
    odd += ["".join(rng.choice("ab \n'sé字  1.\t") for _ in range(rng.randint(1, 80))) for _ in range(400)]
    return odd + [x.text[:3000] for x in texts.collect() if x.text]


def test_counts_equal_the_library(samples):
    library = Tokenizer.from_file(BPE)
    expected = [len(x.ids) for x in library.encode_batch(samples, add_special_tokens=False)]
    assert MergeTable(BPE).counts(samples) == expected


def test_count_tokens(texts, nothing):
    library = Tokenizer.from_file(BPE)
    for x in count_tokens(texts, BPE).collect():
        n = len(library.encode(x.text or "", add_special_tokens=False).ids)
        assert (x.n_bytes, x.n_tokens, x.over_limit) == (len((x.text or "").encode()), n, n > 512)
    assert count_tokens(nothing, BPE).collect() == []


@pytest.fixture(scope="module")
def library():
    """The library's own unigram segmentation with the scores that our pieces use."""
    proto = pytest.importorskip("sentencepiece.sentencepiece_model_pb2").ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    pieces = Pieces(MODEL, "rank")
    for i, piece in enumerate(proto.pieces):
        if i in pieces.score:
            piece.score = pieces.score[i]
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_viterbi_equals_the_library(samples, library):
    pieces = Pieces(MODEL, "rank")
    # Sums of 32-bit scores are exact up to a few hundred pieces; beyond, the library's own round.
    short = [x[:400] for x in samples]
    assert [pieces.encode(x).tolist() for x in short] == [library.encode(x) for x in short]


def test_whole_text_equals_word_by_word(samples):
    pieces = Pieces(MODEL, "rank")
    for x in samples[:200]:
        assert pieces.encode(x).tolist() == pieces.best(pieces.model.normalize(x)) if x else True


def test_decoding(samples, library):
    pieces = Pieces(MODEL, "rank")
    for x in samples:
        ids = pieces.encode(x).tolist()
        assert pieces.decode(ids) == library.decode(ids)
        if "▁" not in x:
            assert pieces.decode(ids) == x


def test_rank_scores_are_probabilities():
    scores = rank_scores([-1.0, -3.0, -2.0, -4.0])
    assert scores[0] > scores[2] > scores[1] > scores[3]
    assert abs(sum(2.718281828 ** s for s in scores) - 1) < 0.01


def test_encode_pieces(texts, odd, nothing):
    coded = encode_pieces(texts, MODEL, "rank", decoded="decoded")
    for x in coded.collect():
        assert x.decoded == (x.text or "") and x.n_pieces == len(x.ids)
    assert encode_pieces(nothing, MODEL, "rank").collect() == []
    coded = encode_pieces(odd, MODEL, "rank")
    assert coded.columns == [c for c in odd.columns if c != "ids"] + ["ids", "n_pieces"]
    again = decode_pieces(coded.withColumn("ids", F.when(F.col("doc_id") != 1, F.col("ids"))), MODEL)
    assert all(x.decoded == ((x.text or "") if x.doc_id != 1 and x.doc_id is not None else None) for x in again.collect())
