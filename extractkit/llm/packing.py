"""Best-fit packing of token sequences under several capacities.

Documents are encoded, cut into pieces where they are longer than a sequence, and packed into as few
sequences as possible. A sequence has three capacities: tokens, pieces, and attention cost (the sum
of squared lengths, as attention stays within a piece). Pieces go in decreasing length; of the open
sequences that can take a piece under every constraint, the one with the best score is chosen: the
smallest weighted norm of what is left after placing it, or the largest weighted dot product of the
piece's demand with what is left. If none can, a new one is opened.

Pieces that fill a sequence alone need no search. The others are dealt out evenly, by a hash of their
row, to groups of about ``GROUP`` pieces, each packed by one task: at most the last sequences of a
group are left partly empty.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from extractkit.llm.tables import saved
from extractkit.llm.textscan import release, released
from extractkit.llm.tokens import CACHED_WORDS, kept

#: Pieces packed together by one task.
GROUP = 20_000


def pieces(
    docs: DataFrame, path: str, most: int, id_col: str, text_col: str, cached: int = CACHED_WORDS
) -> DataFrame:
    """Per piece: id, piece int, start long, length long, ids_crc32 long."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept(path, cached)
        for batch in released(batches):
            owner, piece, start, length, crc = [], [], [], [], []
            for row, ids in enumerate(encoder.encode(batch.column(1).to_pylist())):
                for number, at in enumerate(range(0, len(ids), most)):
                    part = ids[at : at + most]
                    owner.append(row)
                    piece.append(number)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.astype("<u4").tobytes()))
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "piece", "start", "length", "ids_crc32"])
        release()

    shape = f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long"
    return docs.select(id_col, text_col).mapInArrow(run, shape)


def _tightest(lengths: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Best fit by tokens: open bins by the room left, in each room the earliest opened first."""
    chosen, offset, opened = [], [], 0
    rooms: list[int] = []
    bins: dict[int, list[int]] = {}
    for length in lengths:
        at = bisect_left(rooms, length)
        if at < len(rooms):
            room = rooms[at]
            bin_ = heappop(bins[room])
            if not bins[room]:
                del rooms[at], bins[room]
        else:
            room, bin_, opened = most, opened, opened + 1
        chosen.append(bin_)
        offset.append(most - room)
        left = room - length
        if left > 0:
            if left not in bins:
                insort(rooms, left)
            heappush(bins.setdefault(left, []), bin_)
    return np.array(chosen, dtype=np.int64), np.array(offset, dtype=np.int64)


def best_fit(
    lengths: np.ndarray, capacity: tuple, weights: tuple = (1.0, 0.01, 0.01), rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; ``lengths`` must be in decreasing order.

    ``capacity`` is (tokens, pieces, attention cost); None is no limit. A piece that exceeds a
    capacity on its own gets a bin of its own. Where only tokens are limited, the smallest norm is the least
    room left, which is looked up.
    """
    if rule == "norm" and capacity[0] is not None and capacity[1] is None and capacity[2] is None:
        return _tightest(lengths.tolist(), capacity[0])
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(float) ** 2], axis=1)
    limit = np.array([np.inf if c is None else c for c in capacity], dtype=float)
    scale = np.where(np.isinf(limit), 0.0, 1 / np.where(np.isinf(limit), 1.0, limit))
    weight = np.sqrt(np.array(weights)) * scale
    used = np.zeros((len(lengths), 3))
    chosen, offset = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64)
    opened, candidates = 0, np.empty(0, dtype=np.int64)
    # open bins with any room for the smallest piece, by number
    least = demand.min(axis=0) if len(lengths) else np.zeros(3)
    for i, d in enumerate(demand):
        left = limit - used[candidates] if len(candidates) else np.empty((0, 3))
        room = (left >= d).all(axis=1)
        if room.any():
            fits = np.flatnonzero(room)
            if rule == "norm":
                rest = np.where(np.isinf(left[fits]), 0.0, left[fits] - d) * weight
                best = fits[np.argmin((rest * rest).sum(axis=1))]
            else:
                rest = np.where(np.isinf(left[fits]), 0.0, left[fits]) * (weight * weight * d)
                best = fits[np.argmax(rest.sum(axis=1))]
            bin_ = candidates[best]
        else:
            bin_, opened = opened, opened + 1
            candidates = np.append(candidates, bin_)
        chosen[i], offset[i] = bin_, used[bin_, 0]
        used[bin_] += d
        if (limit - used[bin_] < least).any():
            candidates = candidates[candidates != bin_]
    return chosen, offset


def packed(
    docs: DataFrame,
    tokenizer: str,
    most: int = 4096,
    documents: int | None = None,
    attention: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: str = "norm",
    cached: int = CACHED_WORDS,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is the file of the vocabulary, which every node must have. Null and empty texts are
    one end id; repeated rows are packed each; null ids stay null; an empty table gives no rows. Only
    documents of more than ``most`` ids are cut. ``documents`` and ``attention`` limit the pieces and
    the sum of squared lengths of a sequence; a piece that exceeds the latter alone stands alone.
    About ``cached`` words are kept by each worker between batches and tasks; results do not depend on it.
    """
    cut = pieces(docs, tokenizer, most, id_col, text_col, cached)
    cut = saved(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = cut.where(F.col("length") == most).select(
        *cut.columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = cut.where(F.col("length") < most)
    n = -(-rest.count() // GROUP)
    capacity = (most, documents, attention)

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], kind="stable")
        bins, offset = best_fit(frame["length"].to_numpy(), capacity, rule=rule)
        group = int(frame["group"].iloc[0])
        return frame.drop(columns="group").assign(
            sequence_id=(group << 32) + bins, offset=offset
        )

    shape = whole._jdf.schema().toDDL()
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(max(1, n))).cast("long"))
    return whole.unionByName(dealt.groupBy("group").applyInPandas(pack, shape)).drop("row")
