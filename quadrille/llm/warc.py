"""Writing pages as WARC archives and reading them back by verified record chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import met, staged, unstage

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(content: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are eight groups of 20, four characters each."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
    hexed = F.sha1(content)
    groups = [F.lpad(F.conv(F.substring(hexed, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), digits, BASE32)


def header(text: Column, name: str) -> Column:
    found = F.regexp_extract(text, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*)", 1)
    return F.nullif(F.trim(found), F.lit(""))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0, records_per_file: int = 1000) -> None:
    """Write one record per page below ``path``, gzip-compressed a file.

    Of pages with equal payloads of at least ``min_bytes`` bytes the smallest id is
    a response, others are revisits without payload that refer to it. A null payload
    is empty; a null id or URL leaves its header out; rows repeating the smallest id
    are all responses. An empty table writes no record. Only the three columns named are
    read, so others can't clash.

    The text sink does the writing on the executors: a record is a row and the
    line separator is the blank line that ends a record.
    """
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.regexp_replace(F.col(f"`{url_col}`"), r"[\r\n]+", " ").alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.encode("payload", "UTF-8"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    # Copies are told from first ids alone; payloads meet only the table of repeated digests, those of a hot one in many tasks.
    first = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"), F.count("*").alias("n"))
    first, staging = staged(first.filter(F.col("first") != F.col("last")).drop("last"), "warc-first")
    rows = met(rows, first, ["digest"], ["id"], how="left")
    revisit = F.coalesce(F.col("first") < F.col("id"), F.lit(False))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))).otherwise("")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("payload")))
    record = F.concat(
        F.lit(MAGIC),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit("\r\n"),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("id").cast("string"), F.lit(">"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:page:"), F.col("first").cast("string"), F.lit(">\r\n"))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit(END),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)
    unstage(pages.sparkSession, staging)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The stretches between magic lines, in file order: each may be a record, or lie inside a payload.

    Spark deals the files out (plain ones by byte ranges); ``at`` orders the
    segments of a file.
    """
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth")).alias("at"), "value")


def candidates(segs: DataFrame) -> DataFrame:
    """(file, at, off, next): the byte offset of each segment's magic line, and where its record says it ends."""
    head = F.substring_index("value", END, 1)
    length = F.regexp_extract(head, r"(?i)(?:^|\r\n)Content-Length:[ \t]*(\d{1,17})[ \t]*(?:\r\n|$)", 1)
    size = F.octet_length("value").cast("long")
    header_size = F.octet_length(head).cast("long") + len(END)
    told = F.when(F.instr("value", END) > 0, len(MAGIC) + header_size + F.nullif(length, F.lit("")).cast("long") + len(END))
    narrow = segs.select("file", "at", size.alias("size"), told.alias("told"))
    before = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    # A segment follows its magic line, so the magic of the n-th one (from 0) starts before it; the first has none.
    passed = F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(before), F.lit(0))
    narrow = narrow.withColumn("off", passed - len(MAGIC))
    return narrow.select("file", "at", "off", F.when(F.col("off") >= 0, F.col("off") + F.col("told")).alias("next"))


def reachable(links: DataFrame) -> DataFrame:
    """The offsets that record lengths reach from the start of each file, by pointer jumping.

    ``links`` is (file, off, next). Every round squares the jump and marks what
    marked offsets jump to, so the rounds are logarithmic in the records of a file.
    """
    spark = links.sparkSession
    nodes = links.select("file", "off", F.col("next").alias("jump"), (F.col("off") == 0).alias("mark"))
    nodes, path = staged(nodes, "warc-chain")
    seen = nodes.filter("mark").count()
    while True:
        ends = nodes.select("file", F.col("off").alias("jump"), F.col("jump").alias("further"), F.lit(True).alias("real"))
        stepped = nodes.join(ends, ["file", "jump"], "left")
        moved = stepped.select("file", "off", F.col("further").alias("jump"), "mark")
        marks = stepped.filter(F.col("mark") & F.col("real")).select("file", F.col("jump").alias("off"), F.lit(None).cast("long").alias("jump"), F.lit(True).alias("mark"))
        step, new_path = staged(moved.unionByName(marks).groupBy("file", "off").agg(F.max("jump").alias("jump"), F.max("mark").alias("mark")), "warc-chain")
        unstage(spark, path)
        nodes, path = step, new_path
        now = nodes.filter("mark").count()
        if now == seen:
            return nodes.filter("mark").select("file", "off")
        seen = now


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``: their headers and block, only where a chain of lengths reaches them.

    Tasks emit each magic line with the offset of the record said to follow;
    pointer jumping from offset 0 keeps the reachable ones, so magic lines inside
    payloads make no records: their segments are joined back into the payload.
    The segments are staged, as their numbers hold for one scan only.
    Returns file, off, head (string) and block (binary). An archive with no valid
    record yields nothing. What follows a broken link of a chain is left out.
    """
    segs, _ = staged(segments(spark, path), "warc-segments", compression="zstd")
    cands, _ = staged(candidates(segs), "warc-candidates")
    real = reachable(cands.select("file", "off", "next").filter(F.col("off") >= 0))
    marked = cands.join(real.withColumn("start", F.col("off")), ["file", "off"], "left")
    so_far = W.partitionBy("file").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    owned = marked.withColumn("start", F.max("start").over(so_far)).filter(F.col("start").isNotNull())
    owned = owned.withColumn("parts", F.count("*").over(W.partitionBy("file", "start"))).select("file", "at", "start", "parts")
    bodies = segs.join(owned, ["file", "at"]).withColumn("value", F.col("value").cast("binary"))
    whole = bodies.filter("parts = 1").select("file", F.col("start").alias("off"), "value")
    pieces = bodies.filter("parts > 1").groupBy("file", F.col("start").alias("off")).agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("all"))
    glue = F.lit(MAGIC).cast("binary")
    joined = F.aggregate(F.slice("all", 2, F.size("all") - 1), F.col("all")[0]["value"], lambda a, x: F.concat(a, glue, x["value"]))
    records = whole.unionByName(pieces.select("file", "off", joined.alias("value")))
    head = F.substring_index(F.col("value").cast("string"), END, 1)
    records = records.withColumn("head", head)
    length = header(F.col("head"), "Content-Length").cast("long").cast("int")
    return records.select("file", "off", "head", F.substring(F.col("value"), F.octet_length("head") + len(END) + 1, length).alias("block"))


def page_records(records: DataFrame) -> DataFrame:
    """Pages out of response and revisit records: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    A row per record, repeated ones too; what a record has no header for is null, and no
    records give no rows.
    """
    http = F.substring_index(F.col("block").cast("string"), END, 1)
    page = lambda c: F.regexp_extract(c, r"<urn:page:(-?\d+)>", 1)
    number = lambda name: F.nullif(page(F.coalesce(header(F.col("head"), name), F.lit(""))), F.lit("")).cast("long")
    out = records.withColumn("http", http).withColumn("record_type", header(F.col("head"), "WARC-Type"))
    out = out.withColumn("payload", F.substring(F.col("block"), F.octet_length("http") + len(END) + 1, F.lit(2**31 - 1)))
    full = F.col("record_type") == "response"
    return out.select(
        number("WARC-Record-ID").alias("page_id"),
        header(F.col("head"), "WARC-Target-URI").alias("url"),
        "payload",
        F.when(full, F.octet_length("payload").cast("long")).otherwise(header(F.col("http"), "Content-Length").cast("long")).alias("payload_bytes"),
        F.when(full, base32_sha1(F.col("payload"))).otherwise(F.regexp_replace(header(F.col("head"), "WARC-Payload-Digest"), "^sha1:", "")).alias("payload_digest"),
        "record_type",
        number("WARC-Refers-To").alias("refers_to"),
    )
