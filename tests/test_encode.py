"""Encoding edges."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from extractkit.functions import tokens as K
from extractkit.operators.encode import all_masked, encode_pairs, encode_tokens, encode_with, pad_and_mask


def tid(token):
    return int(hashlib.md5(token.encode()).hexdigest()[:7], 16) + 1


def split(text):
    return re.findall(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\x0b\f\r]", text)


def pairs(spark, *rows):
    return spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(rows)], "id long, prompt string, completion string")


def test_padding_and_labels(spark):
    row = encode_pairs(pairs(spark, ("a b c", "{d")), max_length=6).first()
    a, b, c, brace, d = map(tid, "abc{d")
    assert row.input_ids == [a, b, c, brace, d, 0]
    assert row.labels == [-100, -100, -100, brace, d, -100]
    assert row.attention_mask == [1, 1, 1, 1, 1, 0]


def test_prompt_fills_the_sequence(spark):
    encoded = encode_pairs(pairs(spark, ("a b c d", "{e"), ("a", "{e")), max_length=3)
    rows = {r.id: r for r in encoded.collect()}
    assert len(rows[0].input_ids) == 3 and rows[0].labels == [-100] * 3
    assert [r.id for r in all_masked(encoded).collect()] == [0]


def test_word_across_the_seam_is_one_token(spark):
    rows = {r.id: r for r in encode_tokens(pairs(spark, ("ab", "cd e"), ("ab ", "cd"), ("a.", "b"), ("", "x"), ("é", "é"))).collect()}
    texts = ["abcd e", "ab cd", "a.b", "x", "éé"]
    assert [rows[i].ids for i in range(5)] == [[tid(t) for t in split(text)] for text in texts]
    assert [rows[i].prompt_len for i in range(5)] == [1, 1, 2, 0, 1]


def test_joint_tokens_equal_tokens_of_the_joined_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    halves = docs.select(F.substring("text", 1, 500).alias("p"), F.expr("substring(text, 501)").alias("c"))
    joint = K.joint_tokens(F.col("p"), F.col("c"), K.tokens(F.col("p")))
    assert halves.filter(joint != K.tokens(F.concat("p", "c"))).count() == 0


def test_pad_id_falls_back_to_eos_and_masks_real_eos(spark):
    df = pairs(spark, ("a", "{b}"))
    row = encode_pairs(df, max_length=6, eos_id=tid("b")).first()
    assert row.input_ids[4:] == [tid("b")] * 2
    assert row.labels == [-100, tid("{"), -100, tid("}"), -100, -100]
    assert row.attention_mask == [1, 1, 1, 1, 0, 0]
    row = encode_pairs(df, max_length=6, pad_id=0, eos_id=tid("b")).first()
    assert row.labels == [-100, tid("{"), tid("b"), tid("}"), -100, -100]


def test_own_tokenizer(spark):
    def make():
        return lambda text: [len(w) for w in text.split()]

    row = pad_and_mask(encode_with(pairs(spark, ("aa b ", "ccc")), make, max_length=4), 4).first()
    assert (row.input_ids, row.labels, row.attention_mask) == ([2, 1, 3, 0], [-100, -100, 3, -100], [1, 1, 1, 0])


@pytest.mark.parametrize("length", [1, 512])
def test_arrays_are_max_length(spark, length):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    df = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("prompt"), F.lit("{}").alias("completion"))
    sizes = encode_pairs(df, length).select(F.size("input_ids"), F.size("labels"), F.size("attention_mask")).distinct()
    assert [tuple(r) for r in sizes.collect()] == [(length, length, length)]
