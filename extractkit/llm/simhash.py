"""SimHash fingerprints in DataFrame functions, and search within a Hamming radius by permuted block tables.

Every word of a text votes on 64 signed bits with the bits of its 64-bit hash, weighted by its length (short
words say little); a bit of the fingerprint is set where the votes for it outweigh those against. Words
are summed where they stand: the text's row is exploded into words and aggregated again in one task, without
a shuffle. Two 32-bit counters share one long, so 32 sums hold all votes.

Two fingerprints at most ``radius`` bits apart agree on all but ``radius`` of any blocks their bits are cut
into. Each table moves the bits of some choice of the other blocks to the front; fingerprints that agree there
meet in the table. A pair is reported by the first table in which it meets.

Splitting a text into words holds its words in memory at once.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from extractkit.llm.tables import saved, small_side

#: What parts words: ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
BITS = 64
#: Rows of one chunk of the descending order of ids, and the most chunks there are.
CHUNK_ROWS, MOST_CHUNKS = 1_024, 16_384

_HALF = 32
_PAIR = (1 << _HALF) | 1
_LOW = (1 << _HALF) - 1


def _ors(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def _signed(bit: int) -> int:
    """2**bit as a signed 64-bit number."""
    return (1 << bit) - (1 << BITS if bit == BITS - 1 else 0)


def weight(word: Column) -> Column:
    """Votes of a word: its code points less two, at least one; none for the empty word."""
    n = F.char_length(word)
    return F.when(n > 0, F.greatest(n - 2, F.lit(1))).otherwise(0).cast("long")


def fingerprints(df: DataFrame, text: str, out: str = "fingerprint") -> DataFrame:
    """One row per distinct value of the other columns, ``text`` replaced by its fingerprint (a long).

    The other columns must tell rows apart, unless rows that don't differ are to be one. Rows should be
    partitioned by one of them: then nothing is shuffled. Null, empty and blank texts have fingerprint 0.
    Upper and lower case are the same.
    """
    keys = [c for c in df.columns if c != text]
    words = df.select(*keys, F.explode(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACE)).alias("__word"))
    votes = words.select(*keys, weight(F.col("__word")).alias("__w"), F.xxhash64("__word").alias("__h"))
    sums = [
        F.sum(F.col("__w") * F.shiftrightunsigned("__h", i).bitwiseAND(F.lit(_PAIR))).alias(f"__{i}")
        for i in range(_HALF)
    ]
    summed = votes.groupBy(*keys).agg(F.sum("__w").alias("__all"), *sums)

    def bit(votes_for: Column, at: int) -> Column:
        return F.when(votes_for * 2 > F.col("__all"), F.lit(_signed(at))).otherwise(F.lit(0))

    low = [bit(F.col(f"__{i}").bitwiseAND(F.lit(_LOW)), i) for i in range(_HALF)]
    high = [bit(F.shiftrightunsigned(f"__{i}", _HALF), i + _HALF) for i in range(_HALF)]
    return summed.select(*keys, _ors([*low, *high]).cast("long").alias(out))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return 1.0 - distance(a, b).cast("double") / BITS


def shown(fingerprint: Column) -> Column:
    """Sixteen lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), BITS // 4, "0")


def masks(radius: int, blocks: int) -> list[int]:
    """Per table, the bits that must be equal: all blocks but ``radius`` of them."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("blocks must outnumber the radius")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    block = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    tables = [sum(m for i, m in enumerate(block) if i not in out) for out in combinations(range(blocks), radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in tables]


def within(
    queries: DataFrame, table: DataFrame, radius: int = 3, blocks: int = 6, column: str = "fingerprint"
) -> DataFrame:
    """query, found, distance: all pairs of a query's and a table's fingerprint at most ``radius`` bits apart.

    Both inputs have their fingerprints as longs in ``column``; each distinct one counts once, so that copies
    add nothing, and a null one is left out. Pairs of equal fingerprints are included.
    """
    keep = masks(radius, blocks)
    numbered = [F.struct(F.lit(i).alias("table"), F.col("f").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(keep)]

    def tables(df: DataFrame, name: str) -> DataFrame:
        distinct = df.select(F.col(column).alias("f")).where("f is not null").distinct()
        return distinct.select(F.col("f").alias(name), F.inline(F.array(*numbered)))

    both = F.col("query").bitwiseXOR(F.col("found"))
    first = F.lit(len(keep))
    for i, m in reversed(list(enumerate(keep))):
        first = F.when(both.bitwiseAND(F.lit(m)) == 0, i).otherwise(first)
    met = tables(queries, "query").join(tables(table, "found"), ["table", "key"])
    pairs = met.where((F.bit_count(both) <= radius) & (F.col("table") == first))
    return pairs.select("query", "found", F.bit_count(both).alias("distance"))


def _chunk(ids: Column, tie: Column, cuts: list[int]) -> Column:
    """Number of the chunk of (id, tie); chunks are ascending ranges.

    ``cuts`` are ascending ids. An id that stands in them several times has as many chunks more, dealt out by
    tie. Both searches halve the list, step by step.
    """
    if not cuts:
        return F.lit(0)
    size = 1 << (len(cuts).bit_length() - 1)
    listed = F.array(*[F.lit(c).cast("long") for c in cuts])
    steps = F.array(*[F.lit(size >> i) for i in range(size.bit_length())])

    def below(or_equal: bool) -> Column:
        def step(at: Column, n: Column) -> Column:
            cut = F.get(listed, at + n - 1)
            passed = (cut <= ids) if or_equal else (cut < ids)
            return F.when(passed, at + n).otherwise(at)

        return F.aggregate(steps, F.lit(0), step)

    first, last = below(False), below(True)
    share = F.shiftright(F.shiftrightunsigned(tie, 33) * (last - first + 1).cast("long"), 31)
    return (first + share).cast("int")


def edited_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """chunk, place, id, n_chars, edited_sha256, which, text: each text (which = 0) and its edited text (1).

    Documents stand in descending order of (id, hash of the text), null ids last; the one after the last is
    the first. The last third of a text's characters, rounded down, is replaced by as many (or all) first
    ones of the next document. Rows with id and text alike take places next to each other.

    The order is cut into chunks by quantiles of the ids, so no task ranks all rows, and texts move once.
    Each chunk also holds a copy of the document that follows its last one, with a null place.
    """
    least = F.lit(-(1 << 63)).cast("long")
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    order = F.coalesce("id", least)
    n = source.count()
    chunks = min(MOST_CHUNKS, -(-n // CHUNK_ROWS))
    cuts = []
    if chunks > 1:
        shares = [i / chunks for i in range(1, chunks)]
        quantiles = source.agg(F.percentile_approx(order, shares, 10 * chunks).alias("q")).first()["q"]
        cuts = sorted(quantiles)
    tie = F.xxhash64("text")
    placed = source.withColumns({"tie": tie, "chunk": _chunk(order, tie, cuts)})
    at = F.struct(order.alias("o"), F.col("tie"))
    # one row per chunk: its last document, and the chunk that needs it as the one before its first
    ends = placed.groupBy("chunk").agg(F.max(at).alias("last")).sort("chunk").collect()
    numbers = [r["chunk"] for r in ends]
    wanted = [
        (r["chunk"], r["last"]["o"], r["last"]["tie"], numbers[(i + 1) % len(numbers)]) for i, r in enumerate(ends)
    ]
    spark = docs.sparkSession
    copies = spark.createDataFrame(wanted, "chunk int, o long, t long, into int")
    is_last = (placed["chunk"] == copies["chunk"]) & (order == copies["o"]) & (placed["tie"] == copies["t"])
    dealt = placed.join(F.broadcast(copies), is_last, "left").select(
        "id",
        "tie",
        "text",
        F.explode(
            F.when(
                F.col("into").isNotNull(),
                F.array(
                    F.struct(placed["chunk"].alias("chunk"), F.lit(False).alias("copy")),
                    F.struct(F.col("into").alias("chunk"), F.lit(True).alias("copy")),
                ),
            ).otherwise(F.array(F.struct(placed["chunk"].alias("chunk"), F.lit(False).alias("copy"))))
        ).alias("__at"),
    )
    dealt = dealt.select("id", "tie", "text", "__at.chunk", "__at.copy").repartition("chunk")
    # ascending: the next document in descending order is the row before
    ascending = W.partitionBy("chunk").orderBy(F.desc("copy"), order, "tie")
    ranked = dealt.withColumns(
        {"next": F.coalesce(F.lag("text").over(ascending), F.lit("")), "place": F.row_number().over(ascending)}
    )
    length = F.char_length("text")
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next"), F.lit(1), cut)
    )
    made = ranked.withColumn("n_chars", length.cast("long")).withColumn("edited", edited)
    both = F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("text")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("text")),
    )
    return made.select(
        "chunk", "place", "copy", "id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), F.inline(both)
    ).where("not copy or which = 0")


def digest(docs: DataFrame, radius: int = 3, blocks: int = 6, every: int = 20) -> DataFrame:
    """The contract's columns for every document, and n_near.

    n_near is, for ids divisible by ``every`` (the queries), the number of other documents whose fingerprint is
    at most ``radius`` bits away, by the block tables; else null. Null texts are empty; an empty table gives
    no rows; repeated rows give one each; other columns don't matter. Null ids stay and come last in the order.
    """
    made = fingerprints(edited_copies(docs), "text")
    rows = made.groupBy("chunk", "place", "copy", "id", "n_chars").agg(
        F.max(F.when(F.col("which") == 0, F.col("fingerprint"))).alias("own"),
        F.max(F.when(F.col("which") == 1, F.col("fingerprint"))).alias("edited"),
        F.max("edited_sha256").alias("edited_sha256"),
    )
    following = F.lag("own").over(W.partitionBy("chunk").orderBy("place"))
    rows = rows.withColumn("following", following).where("not copy").drop("chunk", "place", "copy")
    rows = saved(rows, "fingerprints")
    asked = F.coalesce(F.col("id") % every == 0, F.lit(False))
    sizes = rows.groupBy(F.col("own").alias("found")).agg(F.count("*").alias("n"))
    pairs = within(rows.where(asked), rows, radius, blocks, "own")
    near = saved(pairs.join(sizes, "found").groupBy(F.col("query").alias("own")).agg(F.sum("n").alias("n")), "near")
    return rows.join(small_side(near, near.count()), "own", "left").select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        shown(F.col("own")).alias("fingerprint"),
        shown(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
        F.when(asked, F.col("n") - 1).alias("n_near"),
    )
