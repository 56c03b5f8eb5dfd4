"""Training arrays from prompt/completion pairs, with the prompt masked out of the labels."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.functions import tokens as K
from extractkit.functions.once import pin

# Fixed value: longest encoded sequence.
MAX_LENGTH = 512

# Distinct tokens a task remembers the ids of.
MOST_TOKENS = 200_000

# Bytes of text given to a tokenizer at once: its lists of ids take many times as much until they are cut.
CALL_BYTES = 1 << 20

Tokenize = Callable[[str], list[int]]
TokenizeBatch = Callable[[list[str]], list[list[int]]]


def encode_tokens(df: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """Add ``ids`` (unpadded, cut at max_length) and ``prompt_len``. Whole texts are tokenized."""
    df = df.withColumn("__prompt", K.tokens(F.col("prompt")))
    joint = K.joint_tokens(F.col("prompt"), F.col("completion"), F.col("__prompt"))
    return df.withColumns(
        {
            "ids": K.token_ids(joint, max_length),
            "prompt_len": F.least(F.size("__prompt"), F.lit(max_length)),
        }
    ).drop("__prompt")


def encode_batches(df: DataFrame, make_tokenizer: Callable[[], TokenizeBatch], key: str = "id",
                   max_length: int = MAX_LENGTH) -> DataFrame:
    """key, ids, prompt_len by a caller's own tokenizer, built once per task and called once per Arrow batch, or
    once for every ``CALL_BYTES`` of a larger one, so that what a call holds doesn't follow the length of texts.

    It gets the prompts and the prompts with their completions in one list. Ids leave as one
    flat buffer and its offsets; no row becomes a Python object but its lists of ids. A null text is empty. A
    tokenizer that gives another number of lists than it got texts stops the job.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize = make_tokenizer()
        for batch in chain.from_iterable(map(_pieces, batches)):
            prompts, completions = ([t or "" for t in batch.column(i).to_pylist()] for i in (1, 2))
            n = len(prompts)
            lists = tokenize([*prompts, *(p + c for p, c in zip(prompts, completions, strict=True))]) if n else []
            if len(lists) != 2 * n:
                raise ValueError(f"{len(lists)} lists of ids for {2 * n} texts")
            sizes = np.minimum(np.fromiter(map(len, lists), np.int64, 2 * n), max_length)
            offsets = np.concatenate([[0], np.cumsum(sizes[n:])])
            flat = np.fromiter(chain.from_iterable(x[:max_length] for x in lists[n:]), np.int32, offsets[-1])
            columns = [
                batch.column(0),
                pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())),
                pa.array(sizes[:n], pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "prompt_len"])

    key_type = df.schema[key].dataType.simpleString()
    return df.select(key, "prompt", "completion").mapInArrow(run, f"{key} {key_type}, ids array<int>, prompt_len int")


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts are ``CALL_BYTES`` at most, but for the run's last; at least one."""
    prompt, completion = (pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy().astype(np.int64) for i in (1, 2))
    run = np.cumsum(2 * prompt + completion) // CALL_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for first, stop in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(first, stop - first)


def encode_with(df: DataFrame, make_tokenizer: Callable[[], Tokenize], key: str = "id",
                max_length: int = MAX_LENGTH) -> DataFrame:
    """``encode_batches`` for a tokenizer of one text."""

    def make() -> TokenizeBatch:
        tokenize = make_tokenizer()
        return lambda texts: [tokenize(t) for t in texts]

    return encode_batches(df, make, key, max_length)


def word_tokenizer() -> TokenizeBatch:
    """The tokenizer of ``encode_tokens`` as a caller's own: each distinct token is hashed once."""
    token = re.compile(K.TOKEN_PATTERN, re.ASCII)
    known: dict[str, int] = {}

    def number(text: str) -> int:
        if text not in known:
            if len(known) >= MOST_TOKENS:
                known.clear()
            known[text] = K.python_id(text)
        return known[text]

    return lambda texts: [[number(t) for t in token.findall(text)] for text in texts]


def pad_and_mask(
    df: DataFrame, max_length: int = MAX_LENGTH, pad_id: int | None = None, eos_id: int = K.EOS_ID
) -> DataFrame:
    """Replace ``ids`` and ``prompt_len`` by input_ids, labels, attention_mask.

    Without a pad id the eos id pads; masking is by id, so real eos tokens are masked as well.
    """
    pad_id = eos_id if pad_id is None else pad_id
    padded = df.withColumns(
        {
            "input_ids": K.pad(F.col("ids"), max_length, pad_id),
            "attention_mask": K.attention_mask(F.col("ids"), max_length),
        }
    )
    labelled = padded.withColumn("labels", K.label_mask(F.col("input_ids"), F.col("prompt_len"), pad_id))
    return labelled.drop("ids", "prompt_len")


def encode_pairs(
    df: DataFrame, max_length: int = MAX_LENGTH, pad_id: int | None = None, eos_id: int = K.EOS_ID
) -> DataFrame:
    """input_ids, labels, attention_mask in place of prompt and completion."""
    return pad_and_mask(encode_tokens(df, max_length), max_length, pad_id, eos_id).drop("prompt", "completion")


def all_masked(encoded: DataFrame) -> DataFrame:
    """Encoded rows with nothing to learn: the prompt filled the sequence."""
    return pin(encoded, "labels").filter(K.all_masked(F.col("labels")))
