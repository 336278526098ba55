"""Token files: exact round trips, damage, and the query against plain encoding."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskbook.llm import token_files as tf
from riskbook.llm.common import read_table
from riskbook.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
SIZE = 49408


@pytest.mark.parametrize("n", [0, 1, 2, 127, 128, 129, 5000, 70_001])
@pytest.mark.parametrize("spread", [1, 3, 500, SIZE])
def test_blocks_give_back_the_ids(n, spread):
    ids = np.random.default_rng(n + spread).integers(0, spread, n) ** 2 % SIZE
    keys, lengths, back = tf.read_block(tf.write_block([None, 7], [0, n], ids, SIZE), SIZE)
    assert keys == [None, 7] and lengths.tolist() == [0, n] and np.array_equal(back, ids)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, SIZE - 1), max_size=400))
def test_any_ids_come_back(ids):
    back = tf.read_block(tf.write_block([1], [len(ids)], np.array(ids, np.int64), SIZE), SIZE)[2]
    assert back.tolist() == ids


def test_repeating_ids_take_little_room():
    ids = np.tile(np.arange(50) * 37, 4000)
    assert len(tf.write_block([1], [len(ids)], ids, SIZE)) < len(ids) // 4


def test_damage_is_noticed():
    block = bytearray(tf.write_block([1], [9], np.arange(9), SIZE))
    block[-3] ^= 1
    with pytest.raises(ValueError):
        tf.read_block(bytes(block), SIZE)


def test_encoder_agrees_with_the_tokenizer():
    texts = [
        "", "Plain words, and MORE!!", "It's <|endoftext|> a≠b  Ａ x́ y 'S", "ΑΣ Σ", "a\x1cb", "ÀÉx.Yz,12ß",
        "don't we'll", "tab\tand\nline", "x" * 3000, "×÷ ª",
    ]
    flat, sizes = tf.Encoder(PATH).encode(texts)
    plain = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert flat.tolist() == sum(plain, []) and sizes.tolist() == [len(p) for p in plain]


def test_encoder_forgets_without_changing_ids():
    small = tf.Encoder(PATH, most=3)
    texts = ["one two three four", "five six seven", "one two eight"]
    first = [small.encode([t])[0].tolist() for t in texts]
    assert first == [tf.Encoder(PATH).encode([t])[0].tolist() for t in texts]


def _expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    start, found = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        found.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_query_on_whole_table(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    assert _rows(QUERIES["op1_token_files"](spark, sf_dir)) == _expected([tuple(d) for d in docs])


def test_odd_rows(spark):
    rows = [(5, None), (3, ""), (None, "null id"), (9, "word " * 60_000), (3, ""), (4, "a\nb")]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, tie string")
    assert _rows(tf.tokenized(docs, PATH)) == _expected(rows)


def test_files_and_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    tf.write_files(docs, str(tmp_path / "t"), PATH, 1)
    found = {r.doc_id: r.ids for r in tf.read_ids(tf.read_files(spark, str(tmp_path / "t")), SIZE).collect()}
    tokenizer = Tokenizer.from_file(PATH)
    assert found == {1: [*tokenizer.encode("one two").ids, 1], 2: [*tokenizer.encode("three").ids, 1]}


def test_empty_table(spark):
    assert tf.tokenized(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []


def test_encoder_remembers_a_bounded_number_of_pieces():
    """Pieces that come once do not pile up in a worker, and those that come again are not learnt anew."""
    one, two = tf.Encoder(PATH), tf.Encoder(PATH, most=200)
    letters = "abcdefghij"
    texts = [
        " ".join(["the", "house"] + [f"q{letters[i % 10]}{letters[i // 10 % 10]}{letters[i // 100]}x{letters[j]}" for j in range(10)])
        for i in range(300)
    ]
    learnt = []
    learn = two._learn
    two._learn = lambda new: (learnt.extend(new), learn(new))
    for at in range(0, len(texts), 5):
        expected, actual = one.encode(texts[at : at + 5]), two.encode(texts[at : at + 5])
        assert all((a == b).all() for a, b in zip(expected, actual))
        assert len(two.numbers) <= 200 + 60 and len(two.flat) == two.starts[-1]
    assert learnt.count("house") == 1
    plain = two.tokenizer.encode_batch(texts[:5], add_special_tokens=False)
    assert two.encode(texts[:5])[0].tolist() == [i for e in plain for i in e.ids]


def test_pieces_are_looked_up_once_for_the_texts_that_hold_them():
    class Counted(tf._Numbers):
        looked = 0

        def __getitem__(self, piece):
            Counted.looked += 1
            return super().__getitem__(piece)

    encoder = tf.Encoder(PATH)
    encoder.numbers = Counted()
    texts = ["The house, the HOUSE and the house. "] * 500 + ["It's odd <|endoftext|>", "", "ÀÉ àé × ÷ <", "|"]
    flat, sizes = encoder.encode(texts)
    plain = [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert flat.tolist() == sum(plain, []) and sizes.tolist() == [len(p) for p in plain]
    assert Counted.looked < 30  # 4,500 pieces


def test_shares_are_found_where_a_search_finds_them():
    models = tf.Models(1, SIZE)
    models.refresh_shares(np.random.default_rng(5).zipf(1.3, 20_000) % SIZE)
    values = np.random.default_rng(6).integers(0, 1 << tf.ID_BITS, 50_000).astype(np.uint64)
    values[:2] = 0, (1 << tf.ID_BITS) - 1
    assert (models.find(values) == np.searchsorted(models.ids, values, "right") - 1).all()
