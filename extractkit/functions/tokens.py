"""Array expressions that turn prompt/completion text into padded, label-masked token ids."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of word characters or one other visible character.
TOKEN_PATTERN = r"(\w+|[^\w\s])"
IGNORED_LABEL = -100

EOS_ID = 0
FIRST_TOKEN_ID = 1
_ID_DIGITS = 7


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(1))


def joint_tokens(prompt: Column, completion: Column, prompt_tokens: Column) -> Column:
    """Tokens of prompt and completion as one text.

    Only where a word would run across the seam is the joined text tokenized; everywhere else
    the two token lists, put end to end, are the same thing for half the work.
    """
    runs_on = prompt.rlike(r"\w\z") & completion.rlike(r"^\w")
    return F.when(runs_on, tokens(F.concat(prompt, completion))).otherwise(
        F.concat(prompt_tokens, tokens(completion))
    )


def token_id(token: Column) -> Column:
    """A stable positive INT for a token."""
    value = F.conv(F.substring(F.md5(token), 1, _ID_DIGITS), 16, 10).cast("int")
    return value + F.lit(FIRST_TOKEN_ID)


def python_id(token: str) -> int:
    """``token_id`` outside Spark."""
    return int(hashlib.md5(token.encode()).hexdigest()[:_ID_DIGITS], 16) + FIRST_TOKEN_ID


def token_ids(token_list: Column, max_length: int) -> Column:
    """Ids of the first ``max_length`` tokens; only those are hashed."""
    return F.transform(F.slice(token_list, 1, max_length), token_id)


def pad(ids: Column, max_length: int, pad_id: int) -> Column:
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(max_length) - F.size(ids)))


def attention_mask(ids: Column, max_length: int) -> Column:
    """1 per token of the unpadded ids, 0 per pad."""
    return F.concat(
        F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.lit(max_length) - F.size(ids))
    )


def label_mask(padded_ids: Column, prompt_length: Column, pad_id: int) -> Column:
    """The ignored label on prompt positions and wherever the id is the pad id; else the id."""
    return F.transform(
        padded_ids,
        lambda x, i: F.when((i < prompt_length) | (x == F.lit(pad_id)), F.lit(IGNORED_LABEL)).otherwise(x),
    )


def all_masked(labels: Column) -> Column:
    return ~F.exists(labels, lambda x: x != F.lit(IGNORED_LABEL))
