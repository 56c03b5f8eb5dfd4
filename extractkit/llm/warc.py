"""WARC archives: written with revisit records, read back by boundary-chain verification.

Writing: one record per page, by Spark's own text writer (each record ends with the line separator
that closes a WARC record). The first page of equal payloads is a response record, the others revisit
it.

Reading: archives are cut at the bytes that open a record, wherever they stand, also inside payloads,
and large files in any number of blocks. Every piece is a candidate record; its declared length gives
the offset of its successor. From offset 0 of each file, pointer jumping marks the runs of candidates
that can be reached: in each round what is marked marks what it points to, and all pointers double.
Candidates inside payloads are never reached; a negative length is no record. Pieces between two reached records belong to the first of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from extractkit.llm.tables import saved, small_side
from extractkit.session import fresh_path

MAGIC = "WARC/1.1\r\n"
ENDS = "\r\n\r\n"
#: Payloads of fewer bytes are stored each.
LEAST_BYTES = 100
#: Bytes searched first for the end of a header.
NEAR_BYTES = 16_384
PREFIX = "page-"


def _first_of_equal(pages: DataFrame, id_col: str, least: int) -> DataFrame:
    """(id, digest, first) of pages that repeat an earlier page's payload."""
    keys = saved(
        pages.where(F.col("_bytes") >= least).select(F.col(id_col).alias("id"), "_digest"), "payloads"
    )
    first = keys.groupBy("_digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    first = saved(first.where("first < last").drop("last"), "repeats")
    return saved(
        keys.join(small_side(first, first.count(), 300_000), "_digest").where("id > first").distinct(),
        "revisits",
    )


def write(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least: int = LEAST_BYTES,
) -> None:
    """Write one record per row to files in the folder ``path``.

    Null payloads are empty. Of rows with equal payloads of ``least`` bytes or more, the row with the
    least id is a response record and those with other ids revisit it; rows that repeat an id and its
    payload are responses each. A null id is written without a number and never takes part in that.
    Payload digests are SHA-256 of the whole payload, also in revisit records, whose stored HTTP
    header keeps its length. A null url is left out. Other columns are not written.
    """
    body = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"),
        F.regexp_replace(F.col(url_col), r"[\r\n]", "").alias("url"),
        body.alias("body"),
        F.octet_length(body).cast("long").alias("_bytes"),
        F.sha2(body, 256).alias("_digest"),
    )
    seen = _first_of_equal(rows, "id", least)
    rows = rows.join(small_side(seen, seen.count(), 300_000), ["id", "_digest"], "left")
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("_bytes"),
        F.lit(ENDS),
    )
    again = F.col("first").isNotNull()
    block = F.when(again, http).otherwise(F.concat(http, "body"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(f"<urn:{PREFIX}"), F.col("id"), F.lit(">"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("_digest"))),
        line("WARC-Refers-To", F.concat(F.lit(f"<urn:{PREFIX}"), F.col("first"), F.lit(">"))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", ENDS).text(path)


def _header(data: Column) -> Column:
    """The header lines of a piece, as text, or null if they do not end within it.

    Most end within the first bytes; the whole piece is searched where they don't.
    """
    near = F.locate(ENDS, F.decode(F.substring(data, 1, NEAR_BYTES), "ISO-8859-1"))
    far = F.locate(ENDS, F.decode(data, "ISO-8859-1"))
    end = F.when((near == 0) & (F.octet_length(data) > NEAR_BYTES), far).otherwise(near)
    return F.when(end > 0, F.decode(F.substring(data, F.lit(1), end + 3), "ISO-8859-1"))


def _field(head: Column, name: str) -> Column:
    value = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.when(value != "", value)


def pieces(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The bytes between the places where the opening bytes of a record stand, and where they stand.

    First table: place (a number), file, block, data (what follows the opening bytes, binary), size,
    head_bytes (length of the header lines, null if they do not end within it) and reach (from the
    opening bytes to the end by the declared length, or null). Second: place, file, block, size, start
    (offset of the opening bytes, -10 for what stands before the first), next (where the declared
    length says that a record opened there ends, or null). Offsets are sums of the lengths before: of
    pieces in a block of the file and of its blocks. Data stays where the one scan put it.
    """
    text = spark.read.option("lineSep", MAGIC).text(path)
    data = F.col("value").cast("binary")
    head = _header(data)
    length = _field(head, "Content-Length").try_cast("long")
    reach = F.when(length >= 0, len(MAGIC) + F.length(head) + length + len(ENDS))
    cut = text.select(
        F.monotonically_increasing_id().alias("place"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        data.alias("data"),
        F.octet_length("value").cast("long").alias("size"),
        F.length(head).alias("head_bytes"),
        reach.alias("reach"),
    )
    cut = saved(cut, "pieces", "zstd")
    step = F.col("size") + len(MAGIC)
    narrow = cut.select("place", "file", "block", "size", "reach")
    blocks = narrow.groupBy("file", "block").agg(F.sum(step).alias("sum"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "file", "block", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("base")
    )
    blocks = saved(blocks, "blocks")
    inside = (
        Window.partitionBy("file", "block")
        .orderBy("place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = narrow.withColumn("inner", F.coalesce(F.sum(step).over(inside), F.lit(0)))
    placed = placed.join(small_side(blocks, blocks.count()), ["file", "block"]).withColumn(
        "start", F.col("base") + F.col("inner") - len(MAGIC)
    )
    follows = F.when(F.col("start") >= 0, F.col("start") + F.col("reach"))
    spots = placed.select("place", "file", "block", "size", "start", follows.alias("next"))
    return cut, saved(spots, "spots")


def reachable(candidates: DataFrame) -> DataFrame:
    """The places of the candidates (place, file, block, start, next) that a chain from start 0 reaches.

    Candidates of a block that follow each other without a gap are one run: whoever reaches one of
    them reaches those after it. Pointer jumping goes over runs, not records: ceil(log2(runs of the
    longest chain)) + 1 rounds of joins of narrow rows. An archive without opening bytes in payloads
    has one run a block.
    """
    near = Window.partitionBy("file", "block").orderBy("start")
    head = F.lag("next").over(near).eqNullSafe(F.col("start"))
    runs_of = candidates.withColumn("head", F.when(~head, F.col("start"))).select(
        "place", "file", "start", "next", F.last("head", ignorenulls=True).over(near).alias("run")
    )
    placed = saved(runs_of, "runs-of-records")
    runs = saved(placed.groupBy("file", "run").agg(F.max("next").alias("entry")), "runs")
    n_runs = runs.count()
    targets = placed.select("file", F.col("start").alias("entry"), F.col("run").alias("to"))
    links = saved(targets.join(small_side(runs, n_runs, 300_000), ["file", "entry"]), "links")
    jump = links.select("file", "run", "to")
    marked = runs.where("run = 0").select("file", "run")
    n = marked.count()
    while n:
        hop = jump.join(small_side(marked, n, 300_000), ["file", "run"])
        hop = hop.select("file", F.col("to").alias("run"))
        grown = saved(marked.unionByName(hop).distinct(), "marked")
        total = grown.count()
        if total == n:
            break
        marked, n = grown, total
        onward = jump.select("file", F.col("run").alias("to"), F.col("to").alias("after"))
        jump = jump.join(small_side(onward, n_runs, 300_000), ["file", "to"])
        jump = saved(jump.select("file", "run", F.col("after").alias("to")), "jumps")
    # a chain enters a run once; what stands before that place in the run is not on it
    entered = links.join(small_side(marked, n, 300_000), ["file", "run"], "left_semi")
    entered = entered.select("file", F.col("to").alias("run"), "entry").unionByName(
        marked.where("run = 0").select("file", "run", F.lit(0).cast("long").alias("entry"))
    )
    entered = entered.groupBy("file", "run").agg(F.min("entry").alias("entry"))
    reached = placed.join(small_side(entered, n, 300_000), ["file", "run"])
    return reached.where("start >= entry").select("place")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives in ``path``.

    Columns: file, place (its order in the file), type, record_id, url, refers_to, digest (header
    fields), http, payload binary (null for revisit records), payload_bytes long (of the full payload; of
    a revisited one from the stored HTTP header). Anything that no chain from a file's start reaches is
    no record; a file that does not open with a record has none.

    Only pieces that are not a whole record each, which an archive without opening bytes in payloads
    has one of a file, are joined with others; the rest are parsed where they are.
    """
    cut, spots = pieces(spark, path)
    marked = reachable(spots.where("next is not null")).withColumn("real", F.lit(True))
    spots = spots.join(marked, "place", "left")
    whole = F.col("start") + len(MAGIC) + F.col("size") >= F.col("next")
    odd = saved(spots.where(~F.coalesce(F.col("real") & whole, F.lit(False))), "odd-pieces")
    records = cut.join(small_side(odd.select("place"), odd.count()), "place", "left_anti")
    # a payload with opening bytes in it was cut: put its pieces together again
    owner = F.last(F.when(F.col("real"), F.struct("place", "next")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("start")
    )
    parts = (
        odd.withColumn("owner", owner)
        .where("start < owner.next")
        .select("place", F.col("owner.place").alias("owner"), F.col("start").alias("at"))
    )
    parts = saved(parts, "parts")
    data = F.transform(F.sort_array(F.collect_list(F.struct("at", "data"))), lambda x: F.hex(x["data"]))
    joined = (
        cut.join(small_side(parts, parts.count()), "place")
        .groupBy("owner")
        .agg(
            F.first("file").alias("file"),
            F.min_by("head_bytes", "at").alias("head_bytes"),
            F.unhex(F.array_join(data, MAGIC.encode().hex())).alias("data"),
        )
    )
    columns = ["place", "file", "head_bytes", "data"]
    records = records.select(columns).unionByName(joined.withColumnRenamed("owner", "place"))
    head = F.decode(F.substring("data", F.lit(1), F.col("head_bytes")), "ISO-8859-1")
    records = records.withColumn("head", head)
    length = _field(F.col("head"), "Content-Length").cast("int")
    block = F.substring("data", F.col("head_bytes") + 1, length)
    parsed = records.select("file", "place", "head", block.alias("block")).withColumn(
        "http", _header(F.col("block"))
    )
    kind = _field(F.col("head"), "WARC-Type")
    payload = F.when(
        kind != "revisit", F.substring("block", F.length("http") + 1, F.octet_length("block"))
    )
    stored = _field(F.col("http"), "Content-Length").cast("long")
    digest = _field(F.col("head"), "WARC-Payload-Digest")
    return parsed.select(
        "file",
        "place",
        kind.alias("type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Target-URI").alias("url"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        digest.alias("digest"),
        "http",
        payload.alias("payload"),
        F.coalesce(F.octet_length(payload).cast("long"), stored).alias("payload_bytes"),
    )


def digest(pages: DataFrame) -> DataFrame:
    """Write the pages, read the archives back, and return one row per record."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write(pages, path)

    def number(name: str) -> Column:
        return F.regexp_extract(F.col(name), rf"^<urn:{PREFIX}(-?\d+)>$", 1).try_cast("long")

    return read(spark, path).select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        F.coalesce(F.sha2("payload", 256), F.regexp_replace("digest", "^sha256:", "")).alias(
            "payload_digest"
        ),
        F.col("type").alias("record_type"),
        number("refers_to").alias("refers_to"),
    )
