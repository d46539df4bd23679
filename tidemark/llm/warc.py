"""WARC archives: written with revisits for equal payloads, read back along the chain of record boundaries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import new_folder

VERSION = "WARC/1.1"
LEAST_REVISIT_BYTES = 100
#: Bytes of a file whose candidate records one task walks through.
SEGMENT_BYTES = 16 << 20
#: Records of a file; with pages of usual size it stays below a GB.
RECORDS_PER_FILE = 50_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"
_ID = "urn:x-page:"


def warc_records(pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One WARC record, without its two closing line breaks, for each page, as ``value``.

    Of pages with equal payloads of ``LEAST_REVISIT_BYTES`` or more, those with the smallest id are stored and the
    others refer to it. A null payload is empty, a null URL is left out. A page without an id is always stored.
    """
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    # Written first: where few payloads occur twice, the size of the table lets Spark send it to the pages, which then stay in place.
    folder = new_folder(pages.sparkSession, "warc-repeats")
    large = rows.where((F.octet_length("payload") >= LEAST_REVISIT_BYTES) & F.col("id").isNotNull())
    large.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").select("digest", "first").write.parquet(folder)
    repeats = pages.sparkSession.read.parquet(folder)
    rows = rows.join(repeats, "digest", "left").withColumn("revisit", F.coalesce(F.col("id") > F.col("first"), F.lit(False)))
    stored = F.when(F.col("revisit"), F.lit("")).otherwise(F.col("payload"))
    # A URL can't hold white space or the magic that starts a record.
    url = F.regexp_replace(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), "WARC/", "WARC%2F")
    fields = [
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit(f"WARC-Record-ID: <{_ID}"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.octet_length("payload").cast("string")),
        F.when(F.col("revisit"), F.concat(F.lit(f"WARC-Refers-To: <{_ID}"), F.col("first").cast("string"), F.lit(">"))),
        F.when(F.col("revisit"), F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(stored).cast("string")),
    ]
    return rows.select(F.concat(F.concat_ws("\r\n", *fields), F.lit(_END), stored).alias("value"))


def write_archives(pages: DataFrame, folder: str, **columns: str) -> None:
    """Archives of ``pages`` in ``folder``, uncompressed; the two line breaks that end a record are the writer's separator."""
    warc_records(pages, **columns).write.option("lineSep", _END).option("maxRecordsPerFile", RECORDS_PER_FILE).text(folder)


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)", 1)


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Everything between two occurrences of the magic, with its place in the file and what it would be as a record.

    ``at`` is the offset of the magic, ``next`` that of the record that has to follow. Files are split: a task knows
    sizes only, and offsets are sums of sizes before, within the block and over the blocks of the file.
    """
    magic = f"{VERSION}\r\n"
    body = F.col("value").cast("binary")
    head = F.substring_index("value", _END, 1)
    chunks = (
        spark.read.option("lineSep", magic)
        .text(folder)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))
        .withColumn("size", F.octet_length("value").cast("long"))
        .withColumn("header", F.when(F.contains(F.col("value"), F.lit(_END)), F.concat(F.lit("\r\n"), head)))
        .withColumn("length", F.expr("try_cast(regexp_extract(header, '(?i)\\r\\nContent-Length:[ \\t]*([0-9]+)', 1) as bigint)"))
        .withColumn("head_size", F.octet_length("header") + 2)
        .select(
            "file",
            "block",
            "seq",
            "size",
            "length",
            "head_size",
            F.lower(_field("WARC-Type")).alias("record_type"),
            _field("WARC-Record-ID").alias("record_id"),
            _field("WARC-Refers-To").alias("refers_to"),
            _field("WARC-Payload-Digest").alias("header_digest"),
            F.expr("try_cast(regexp_extract(header, '(?i)\\r\\nWARC-Payload-Length:[ \\t]*([0-9]+)', 1) as bigint)").alias("header_length"),
            F.sha2(F.substring(body, F.col("head_size") + 1, F.col("length").cast("int")), 256).alias("digest"),
        )
    )
    places = F.expr(f"sum(size + {len(magic)}) over (partition by file, block order by seq rows between unbounded preceding and current row)")
    placed = chunks.withColumn("upto", places - F.col("size") - len(magic))
    blocks = chunks.groupBy("file", "block").agg(F.sum(F.col("size") + len(magic)).alias("bytes"))
    starts = blocks.select("file", "block", F.expr("sum(bytes) over (partition by file order by block rows between unbounded preceding and current row) - bytes").alias("before"))
    at = F.col("before") + F.col("upto") - len(magic)
    return (
        placed.join(starts, ["file", "block"])
        .withColumn("at", at)
        .withColumn("next", F.col("at") + len(magic) + F.col("head_size") + F.col("length") + len(_END))
        .drop("block", "seq", "before", "upto")
    )


def _next_in_segment(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Index of each candidate's successor among the sorted ones; itself where that isn't one of them."""
    place = np.searchsorted(at, following)
    inside = place < len(at)
    inside[inside] = at[place[inside]] == following[inside]
    return np.where(inside, place, np.arange(len(at)))


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """Pointer jumping to the last candidate of each chain in the segment, and the offset it points at."""
    group = group.sort_values("at")
    at, following = group["at"].to_numpy(), group["next"].to_numpy()
    jump = _next_in_segment(at, following)
    while (jump[jump] != jump).any():
        jump = jump[jump]
    return pd.DataFrame({"file": group["file"].to_numpy(), "at": at, "exit": following[jump]})


def _reached(group: pd.DataFrame) -> pd.DataFrame:
    """The candidates that the chain from the segment's entry goes through, by doubling the reach."""
    group = group.sort_values("at")
    at = group["at"].to_numpy()
    jump = _next_in_segment(at, group["next"].to_numpy())
    seen = at == group["entry"].to_numpy()
    for _ in range(max(1, len(at).bit_length())):
        seen[jump[seen]] = True
        jump = jump[jump]
    return group.loc[seen, ["file", "at"]]


def reachable(found: DataFrame) -> DataFrame:
    """(file, at) of the candidates that lie on the chain from the start of their file.

    Chains are followed inside segments of a file first. What is left are segment entries and exits, a few a segment, over
    which pointers are doubled until nothing new is reached: as many rounds as the logarithm of a file's segments.
    """
    rows = found.where("next is not null and at >= 0").select("file", "at", "next", F.expr(f"at div {SEGMENT_BYTES}").alias("segment"))
    jumps = rows.groupBy("file", "segment").applyInPandas(_exits, "file string, at long, exit long").checkpoint()
    entry = jumps.where("at = 0").select("file", "at")
    targets = jumps.select("file", F.col("exit").alias("at")).unionByName(entry).distinct()
    pointer = jumps.join(targets, ["file", "at"], "left_semi").checkpoint()
    reach, size = entry, -1
    while (now := reach.count()) != size:
        size = now
        reach = reach.unionByName(reach.join(pointer, ["file", "at"]).select("file", F.col("exit").alias("at")).join(pointer.select("file", "at"), ["file", "at"], "left_semi")).distinct().checkpoint()
        ahead = pointer.select("file", F.col("at").alias("exit"), F.col("exit").alias("far"))
        pointer = pointer.join(ahead, ["file", "exit"], "left").select("file", "at", F.coalesce("far", "exit").alias("exit")).checkpoint()
    entries = reach.select("file", F.expr(f"at div {SEGMENT_BYTES}").alias("segment"), F.col("at").alias("entry"))
    return rows.join(entries, ["file", "segment"]).groupBy("file", "segment").applyInPandas(_reached, "file string, at long")


def _whole_digests(spark: SparkSession, folder: str, broken: DataFrame) -> DataFrame:
    """Digests of records whose payload holds the magic: their pieces, found by segment, put together again."""
    magic = f"{VERSION}\r\n"
    raw = spark.read.option("lineSep", magic).text(folder)
    raw = raw.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"))
    size = F.octet_length("value").cast("long") + len(magic)
    raw = raw.withColumn("bytes", size).withColumn("upto", F.expr("sum(bytes) over (partition by file, block order by seq rows between unbounded preceding and current row) - bytes"))
    blocks = raw.groupBy("file", "block").agg(F.sum("bytes").alias("total"))
    starts = blocks.select("file", "block", F.expr("sum(total) over (partition by file order by block rows between unbounded preceding and current row) - total").alias("before"))
    pieces = raw.join(starts, ["file", "block"]).select("file", (F.col("before") + F.col("upto") - len(magic)).alias("piece"), "value").withColumn("segment", F.expr(f"piece div {SEGMENT_BYTES}"))
    spread = broken.select("file", "at", "next", "head_size", "length", F.explode(F.sequence(F.expr(f"at div {SEGMENT_BYTES}"), F.expr(f"next div {SEGMENT_BYTES}"))).alias("segment"))
    parts = spread.join(pieces, ["file", "segment"]).where("piece >= at and piece < next")
    whole = parts.groupBy("file", "at", "head_size", "length").agg(F.sort_array(F.collect_list(F.struct("piece", "value"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, F.lit(magic.encode()), p["value"]))
    return whole.select("file", "at", F.sha2(F.substring(joined, F.col("head_size") + len(magic) + 1, F.col("length").cast("int")), 256).alias("whole_digest"))


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the archives: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``, ``intact``.

    Only records on the boundary chain count, so the magic inside a payload starts none. Bytes and digest of a stored
    payload are those read back, of a revisit those in its header. ``intact`` says that a stored payload has the digest in its
    header. An empty folder gives an empty result.
    """
    found = candidates(spark, folder)
    chunks = new_folder(spark, "warc-candidates")
    found.write.parquet(chunks)
    found = spark.read.parquet(chunks)
    records = found.join(reachable(found), ["file", "at"])
    rest = F.col("size") - F.col("head_size")
    broken = records.where(rest < F.col("length"))
    if broken.take(1):
        records = records.join(_whole_digests(spark, folder, broken), ["file", "at"], "left").withColumn("digest", F.coalesce("whole_digest", "digest"))
    number = lambda column: F.expr(f"try_cast(regexp_extract({column}, '{_ID}(-?[0-9]+)>', 1) as bigint)")
    stored = F.col("record_type") == "response"
    own = F.regexp_replace("header_digest", "^sha256:", "")
    return records.select(
        number("record_id").alias("page_id"),
        F.when(stored, F.col("length")).otherwise(F.col("header_length")).alias("payload_bytes"),
        F.when(stored, F.col("digest")).otherwise(own).alias("payload_digest"),
        "record_type",
        F.when(~stored, number("refers_to")).alias("refers_to"),
        (~stored | (F.col("digest") == own)).alias("intact"),
    )


def archive_round_trip(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Write archives of ``pages`` and read them back, as :func:`read_archives`: one row for each input row.

    Repeated rows that share the smallest id of their payload are all stored. An empty table gives an empty result, columns
    other than id, URL and payload are not read.
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    write_archives(pages, folder, **columns)
    return read_archives(spark, folder)
