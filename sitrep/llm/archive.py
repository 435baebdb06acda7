"""Content-addressed web archive: payloads once by digest, with the exact header of their record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitrep.operators import scale

# Digits of base 32 as numbers are written, and as digests are.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FIELDS = ("digest", "header", "page_id", "record_type", "url", "named_digest", "refers_to", "length", "payload", "record")
# Two line ends close a record.
END = b"\r\n\r\n"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base 32 of a SHA-1 in hexadecimal, five digits at a time."""
    groups = [
        F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


@dataclass
class Archive:
    """Folders of an archive.

    ``payloads``: ``digest`` (SHA-256), ``payload``, one row per distinct payload, and the
    ``header`` of a response with it; null if none lies there. ``headers``: ``digest`` and
    ``header`` of all other records. A header is the exact bytes of a record up to its payload.
    """

    path: str

    def payloads(self, spark: SparkSession) -> DataFrame:
        return self.responses(spark).select("digest", "payload")

    def headers(self, spark: SparkSession) -> DataFrame:
        beside = self.responses(spark).where("header IS NOT NULL").select("digest", "header")
        return self.apart(spark).unionByName(beside)

    def responses(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest string, header binary, payload binary").parquet(f"{self.path}/payloads")

    def apart(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("digest string, header binary").parquet(f"{self.path}/headers")


def _record_id(page_id: Column, digest: Column) -> Column:
    name = F.md5(F.concat_ws(":", page_id, digest).cast("binary"))
    parts = [F.substring(name, *at) for at in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null. Line ends inside a value are escaped."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write_archive(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0
) -> Archive:
    """Store a record for every page below ``path``.

    Of pages with equal payloads of ``min_bytes`` or more, the one with the largest id is a
    ``response``; the others are ``revisit`` records that refer to it. Null html is an empty
    payload; pages that repeat the largest id are all responses; a null id is smaller than any
    other and refers, as a response, to nothing. A null url leaves its line out.

    Only digests and ids are shuffled to find the copies. A payload moves once, to its
    response's header, and lies beside it.
    """
    rows = pages.select(
        pages[page_id].cast("long").alias("page_id"),
        pages[url].alias("url"),
        F.coalesce(pages[html].cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    short = rows.select("page_id", "url", "digest", F.sha1("payload").alias("sha1"), F.octet_length("payload").alias("n"))
    short = scale.materialize(short, "records")
    leads = short.groupBy("digest").agg(F.max("page_id").alias("lead_id"))

    named = short.join(leads, "digest")
    leads_copies = F.col("page_id").eqNullSafe(F.col("lead_id"))
    revisit = (F.col("n") >= min_bytes) & ~leads_copies
    digest = F.concat(F.lit("sha1:"), base32(F.col("sha1")))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Page-ID", F.col("page_id")),
        _line("WARC-Payload-Digest", digest),
        _line("WARC-Profile", F.when(revisit, IDENTICAL)),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("lead_id"), F.col("digest")))),
        _line("WARC-Refers-To-Page", F.when(revisit, F.col("lead_id"))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.when(revisit, 0).otherwise(F.col("n"))),
        F.lit("\r\n"),
    )
    name = F.concat_ws(":", "digest", "page_id").alias("name")
    headed = named.select("digest", name, leads_copies.alias("leads"), header.cast("binary").alias("header"))
    # Of pages that repeat the largest id, which bring the same bytes, one has its header beside them.
    first = Window.partitionBy("name").orderBy("header")
    responses = headed.where("leads").withColumn("place", F.row_number().over(first))
    responses = scale.materialize(responses.select("digest", "name", "header", "place"), "responses")
    apart = headed.where(~F.col("leads")).select("digest", "header").unionByName(responses.where("place > 1").select("digest", "header"))
    apart.write.parquet(f"{path}/headers")
    keyed = rows.select(name, "payload")
    once = responses.where("place = 1").join(keyed, "name").dropDuplicates(["name"])
    once.select("digest", "header", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    return Archive(path)


def parse_headers(headers: DataFrame) -> DataFrame:
    """Rows with the fields of their headers, null where a header has none."""
    text = F.col("header").cast("string")

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract(text, f"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))

    return headers.select(
        "*",
        field("WARC-Page-ID").cast("long").alias("page_id"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Payload-Digest").alias("named_digest"),
        field("WARC-Refers-To-Page").cast("long").alias("refers_to"),
        field("Content-Length").cast("long").alias("length"),
    )


def verified(payloads: DataFrame) -> DataFrame:
    """Payloads with digests taken anew from their bytes; a wrong digest stops the job."""
    right = F.sha2("payload", 256) == F.col("digest")
    checked = F.when(right, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not have digest "), F.col("digest"))).cast("binary")
    )
    return payloads.withColumn("payload", checked)


def _rebuilt(records: DataFrame) -> DataFrame:
    """Responses with header and payload put together, and held against what the header says."""
    record = F.concat("header", "payload", F.lit(END))
    size = F.octet_length("record") - F.octet_length("header") - len(END)
    body = F.substring("record", F.octet_length("header") + 1, size)
    return _held(records.withColumn("record", record), size, size, base32(F.sha1(body)))


def _held(records: DataFrame, length: Column, size: Column, digest: Column) -> DataFrame:
    """Records with size and digest of their payload; one whose header has others stops the job."""
    right = (F.col("named_digest") == F.concat(F.lit("sha1:"), digest)) & (F.col("length") == length)
    wrong = F.raise_error(F.concat(F.lit("record does not fit its payload: "), F.col("header").cast("string")))
    return records.select(
        *FIELDS,
        F.when(right, size.cast("long")).otherwise(wrong.cast("long")).alias("payload_bytes"),
        F.when(right, digest).otherwise(wrong.cast("string")).alias("payload_digest"),
    )


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """The original records: exact header and payload, revisits with what they refer to.

    ``record`` are the bytes of the record in a WARC file. ``payload_bytes`` and
    ``payload_digest`` are taken from them, for a revisit from the payload it refers to. A
    record whose payload is missing, or differs from the header's digest or length, stops
    the job.

    A response is put together where it lies. Size and digest of a payload go to the revisits
    that refer to it; its bytes only if they are asked for.
    """
    stored = verified(archive.responses(spark))
    beside = parse_headers(stored.where("header IS NOT NULL"))
    apart = parse_headers(archive.apart(spark))
    response = F.col("record_type").eqNullSafe("response")
    # Few headers of responses lie apart; only the payloads of these move to them.
    alone = apart.where(response)
    wanted = scale.lookup_join(stored.select("digest", "payload"), alone.select("digest").distinct(), ["digest"], "left_semi")
    facts = stored.select("digest", "payload", F.octet_length("payload").alias("size"), base32(F.sha1("payload")).alias("sha1"))
    revisits = apart.where(~response).join(facts, "digest", "left").withColumn("record", F.concat("header", F.lit(END)))
    body = F.octet_length("record") - F.octet_length("header") - len(END)
    found = _rebuilt(beside).unionByName(_rebuilt(alone.join(wanted, "digest", "left")))
    return found.unionByName(_held(revisits, body, F.col("size"), F.col("sha1")))


def export_warc(spark: SparkSession, archive: Archive, path: str) -> None:
    """Write the records to WARC files; the line end of the text sink ends each record."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    records = read_records(spark, archive).select(F.concat("header", body).cast("string").alias("value"))
    records.write.option("lineSep", "\r\n\r\n").text(path)


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Store every page in a new archive and read the archive back: one row per page."""
    spark = pages.sparkSession
    archive = write_archive(pages, scale.scratch_dir(spark, "archive"), page_id, url, html)
    found = read_records(spark, archive)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
