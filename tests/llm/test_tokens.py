import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgermill.llm import bpe, token_counts
from ledgermill.llm.pieces import cut
from tests.llm.samples import awkward, empty, frame, row

PATH = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts():
    rng = random.Random(1)
    fixed = [
        "  a  b ", "x\n\ny", "foo<|endoftext|> bar<|endoftext|>", "a b c　 d", "it's 's we'll  'll", "\t\t a",
        "日本語 テスト 1234 ½ ٣", "a" * 3000, "ab " * 500, " ", "\n", "é é 😀😀", "<|endoftext|>", "x < y <| z",
        "\x1c a \x1c b", "\x85 a\x85 b", "a \x0b b", "   ", "a\r\n b", "�퟿ é",
    ]
    return fixed + ["".join(rng.choice(" \n\tab'st<|é1.。 ") for _ in range(rng.randint(0, 40))) for _ in range(400)]


@pytest.fixture(scope="module")
def rows():
    return awkward() + [row(100 + k, t) for k, t in enumerate(odd_texts())]


def test_encoding_equals_the_library(spark, rows):
    library = Tokenizer.from_file(PATH)
    want = {}
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = library.decode(ids, skip_special_tokens=False)
        want[r[0]] = (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    got = bpe.encoding_digests(frame(spark, rows), PATH).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == want


def test_round_trip(spark, rows):
    got = bpe.encode_and_decode(frame(spark, rows), PATH).collect()
    assert {r.doc_id: r.decoded for r in got} == {r[0]: r[1] or "" for r in rows}


def test_segment_tree_takes_the_leftmost_lowest_pair():
    with open(PATH, "rb") as file:
        model = bpe.ByteBpe(file.read())
    rank = {(int(p) // model.size, int(p) % model.size): int(r) for p, r in zip(model.pairs, model.ranks)}
    rng = random.Random(3)
    words = [bytes(rng.choice(b"thean ion.") for _ in range(rng.randint(1, 70))) for _ in range(200)]
    for word, ids in zip(words, model.merge(words)):
        plain = [int(model.first_ids[b]) for b in word]
        while True:
            found = [(rank[p], k) for k, p in enumerate(zip(plain, plain[1:])) if p in rank]
            if not found:
                break
            best, k = min(found)
            plain[k : k + 2] = [int(model.into[best])]
        assert list(memoryview(ids).cast("I")) == plain


def test_damaged_ids_decode_with_replacement():
    with open(PATH, "rb") as file:
        model = bpe.ByteBpe(file.read())
    import numpy as np

    assert model.decode(model.first_ids[[0xC3, 0x41]]) == "�A" and model.decode(np.zeros(0, np.int64)) == ""


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_equal_the_library(spark, rows, name):
    path = public_tokenizers.path(name)
    if name.endswith(".json"):
        library = Tokenizer.from_file(path)
        library.no_truncation()
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        processor = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(processor.encode(t))
    got = token_counts.count_tokens(frame(spark, rows), path, limit=100).collect()
    want = {r[0]: (len((r[1] or "").encode()), count(r[1] or "")) for r in rows}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)


def test_pieces_put_texts_together_again():
    texts = odd_texts()
    pieces = cut(pa.array(texts))
    spans = zip(pieces.first[:-1], pieces.first[1:])
    assert ["".join(pieces.distinct[i] for i in pieces.index[a:b]) for a, b in spans] == texts


def test_empty_tables_and_repeated_rows(spark):
    assert bpe.encoding_digests(empty(spark), PATH).collect() == []
    assert token_counts.count_tokens(empty(spark), PATH).collect() == []
    twice = frame(spark, [row(1, "a b"), row(1, "a b")])
    assert [r.n_tokens for r in token_counts.count_tokens(twice, PATH).collect()] == [2, 2]
    assert bpe.encoding_digests(twice, PATH).count() == 2


def test_long_words_have_the_ids_of_the_library_and_take_seconds():
    with open(PATH, "rb") as file:
        model = bpe.ByteBpe(file.read())
    library = Tokenizer.from_file(PATH)
    rng = random.Random(9)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(1 << 20))
    for word in (letters[: bpe.LONG_WORD], letters[: bpe.LONG_WORD + 1], letters[:5000], "a" * 5000, "é" * 3001):
        want = library.encode(word, add_special_tokens=False).ids
        assert model.merge([word.encode()]) == [b"".join(i.to_bytes(4, "little") for i in want)]
    begun = time.monotonic()
    (got,) = model.merge([letters.encode()])
    assert time.monotonic() - begun < 60
    assert model.decode(np.frombuffer(got, np.uint32)) == letters
    want = library.encode(letters, add_special_tokens=False).ids
    assert np.frombuffer(got, np.uint32).tolist() == want
