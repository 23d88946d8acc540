r"""WARC archives without repeated payloads: revisit records refer to the original response.

Headers (page, digest, length) are shuffled by payload digest and give the original of each
payload that is there more than once: the row with the largest page id. A bitmap of fixed size of
these payloads' hashes parts the pages: those outside of it are responses and go from the scan to
the archive; only pages inside of it are shuffled, to the exact join. (Where far more payloads repeat
than it has bits, all pages are.) An archive begins with a warcinfo record. Each page becomes a
WARC/1.1 record with a fresh header: a response with the payload, or a revisit without. Spark
writes the records as text archives, a record and its closing CRLF CRLF a "line", so that a
lost executor's files are written again. Reading splits at the version line and the
``WARC-Warcinfo-ID`` of the run after it, which no payload can hold since it is new in every
run; lengths and digests are checked, a broken record is an error.

Defined cases: a null html is the empty payload, a null url leaves the target out, and blanks
or control characters in a url are written %XX. Payloads are equal if digest and length are.
All rows that repeat the largest page id of a payload are responses; a null page id is smaller
than any, and a payload of null ids only has responses. Other columns are ignored. Archives are
compressed as files; a compressed one is read as a stream, by one task, a plain one in splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rolepulse.llm.texts import shared, stored, table

END = "\r\n"
#: Bits of the map of repeated payloads.
MAP_BITS = 1 << 23
#: Payloads of fewer bytes are stored again each time.
LEAST_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: each ten hexadecimal digits are eight of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def resolved(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest and refers_to, which is null for responses."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": base32_sha1(F.col("payload"))})
    rows = rows.withColumn("bit", F.pmod(F.xxhash64("payload_digest", "payload_bytes"), F.lit(MAP_BITS)))
    rows = rows.withColumns({"word": F.expr("bit div 64"), "own": F.expr("shiftleft(1L, cast(bit % 64 as int))")}).drop("bit")
    originals = (rows.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes", "word", "own")
                 .agg(F.max("page_id").alias("original"), F.count("*").alias("rows")).where("rows > 1").drop("rows"))
    originals = stored(originals, "repeated-payloads")
    # At most MAP_BITS / 64 rows.
    bitmap = originals.groupBy("word").agg(F.bit_or("own").alias("set"))
    parted = rows.join(F.broadcast(bitmap), "word", "left").withColumn("inside", F.coalesce(F.col("set").bitwiseAND(F.col("own")) != 0, F.lit(False)))
    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest"]
    alone = parted.where(~F.col("inside")).select(*columns, F.lit(None).cast("long").alias("refers_to"))
    again = F.col("original").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("original")))
    shared_ones = parted.where("inside").select(*columns).join(originals.drop("word", "own"), ["payload_digest", "payload_bytes"], "left")
    return alone.union(shared_ones.select(*columns, F.when(again, F.col("original")).alias("refers_to")))


def record_id(page_id: Column) -> Column:
    """A record's name: the MD5 of its page id in the form of a UUID."""
    h = F.md5(F.coalesce(page_id.cast("string"), F.lit("")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def target(url: Column) -> Column:
    """A url that fits in a header line."""
    out = url
    for code in [*range(33), 127]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(url.rlike(r"[\x00-\x20\x7F]"), out).otherwise(url)


def records(rows: DataFrame, archive: str, date: str = DATE) -> DataFrame:
    """The records of resolved pages, each without the last of its line ends."""
    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))

    is_revisit = F.col("refers_to").isNotNull()
    block = F.when(is_revisit, F.lit("")).otherwise(
        F.concat(F.lit(_HTTP), F.col("payload_bytes").cast("string"), F.lit(END + END), F.col("payload")))
    header = [
        F.lit(f"WARC/1.1{END}WARC-Warcinfo-ID: {archive}{END}WARC-Date: {date}{END}"),
        field("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        field("WARC-Record-ID", record_id(F.col("page_id"))),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("X-Payload-Length", F.col("payload_bytes").cast("string")),
        field("WARC-Profile", F.when(is_revisit, F.lit(PROFILE))),
        field("WARC-Refers-To", F.when(is_revisit, record_id(F.col("refers_to")))),
        field("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        field("WARC-Target-URI", target(F.col("url"))),
        field("Content-Type", F.when(~is_revisit, F.lit("application/http;msgtype=response"))),
    ]
    return (rows.withColumn("block", block)
            .select(F.concat(*header, field("Content-Length", F.octet_length("block").cast("string")), F.lit(END), F.col("block"), F.lit(END)).alias("value")))


def warcinfo(spark: SparkSession, archive: str, date: str) -> DataFrame:
    """The record that the others refer to, in the form of :func:`records`."""
    block = f"software: rolepulse{END}format: WARC File Format 1.1{END}"
    head = [f"WARC/1.1{END}WARC-Warcinfo-ID: {archive}{END}WARC-Date: {date}{END}WARC-Type: warcinfo", f"WARC-Record-ID: {archive}",
            "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return spark.createDataFrame([(END.join(head) + END + END + block + END,)], "value string").coalesce(1)


def write(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES, date: str = DATE, compression: str = "gzip") -> str:
    """Write deduplicated archives to ``path``; returns the id that :func:`read` splits them by."""
    archive = f"<urn:uuid:{uuid.uuid4()}>"
    rows = warcinfo(pages.sparkSession, archive, date).union(records(resolved(pages, least_bytes), archive, date))
    rows.write.option("lineSep", END).text(path, compression=compression)
    return archive


def read(spark: SparkSession, path: str, archive: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to and html (null for revisits) of each record."""
    start = f"WARC/1.1{END}WARC-Warcinfo-ID: {archive}{END}"
    blank = END + END
    head = F.substring_index("value", blank, 1)
    rows = (spark.read.option("lineSep", start).text(path).where("value <> ''").withColumn("head", head)
            .withColumn("block", F.expr("substring(value, length(head) + 5, length(value) - length(head) - 8)")))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("head", rf"(?:^|\n){name}: ([^\r]*)", 1), F.lit(""))

    kind, size = field("WARC-Type"), field("X-Payload-Length").cast("long")
    rows = rows.where(kind != "warcinfo")
    html = F.when(kind == "response", F.expr("substring(block, length(substring_index(block, '\\r\\n\\r\\n', 1)) + 5)"))
    rows = rows.select(
        field("X-Page-ID").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"), size.alias("payload_bytes"),
        F.substring(field("WARC-Payload-Digest"), 6, 32).alias("payload_digest"), kind.alias("record_type"),
        field("X-Refers-To-Page-ID").cast("long").alias("refers_to"), html.alias("html"),
        (F.octet_length("block") == field("Content-Length").cast("long")).alias("whole"))
    same = F.col("html").isNull() | ((F.octet_length("html") == F.col("payload_bytes")) & (base32_sha1(F.col("html")) == F.col("payload_digest")))
    checked = F.when(F.col("whole") & same, F.col("payload_digest")).otherwise(F.raise_error(F.lit("broken WARC record")))
    return rows.withColumn("payload_digest", checked).drop("whole")


def op8_warc(spark, sf_dir: str) -> DataFrame:
    path = shared(spark, "warc")
    archive = write(table(spark, sf_dir, "pages"), path)
    return read(spark, path, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
