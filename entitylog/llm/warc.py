"""A content-addressed web archive: payloads once, exact record headers beside them.

``write`` makes a WARC 1.1 record of every page and stores it as two tables below a
path: ``payloads`` holds each different payload once, under its SHA-256, and
``records`` the exact header of every record, with the digest as the address of its
payload. ``read`` joins them to the original records again. ``write_files`` lays the
records out as standard WARC files and ``read_files`` parses such files.

A digest stands for one payload: its copies must agree in length and in a second,
independent hash when they are stored, or the job fails. Reading computes the digest
of every stored payload anew and fails where it differs or where a payload is missing.

Of records with equal payloads of ``least`` bytes or more the one with the smallest
page id is the response, of equal ids the one with the smallest URL, then the one
stored first; nulls come last. The others are revisits of it: their records hold no
payload, only its digest and the response's record id. Smaller payloads are written
with every record. A payload that any share of the records has is summed up before
it moves, and joined over as many tasks as its share asks for.

A null payload is the empty one. A page without id or URL is a record without that
field; line ends in a URL are percent-encoded, as they would end the header. Repeated
rows are records of their own. Only the three columns named are read, so others may
have any name.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylog.llm.common import spread_join, stored

# Executors get the functions of this module with the job, and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Payloads of fewer bytes are written with every record.
LEAST = 100
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ADDRESS = "digest string, payload binary"
RECORD = "digest string, header string, http string"


def _record_id(page: Column, digest: Column, at: Column) -> Column:
    made = F.md5(F.concat_ws("/", page.cast("string"), digest, at.cast("string")).cast("binary"))
    parts = (F.substring(made, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line; none for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def _clean(url: Column) -> Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write(
    df: DataFrame,
    path: str,
    page: str = "page_id",
    url: str = "url",
    content: str = "html",
    least: int = LEAST,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Archive every row: ``path/payloads`` and ``path/records``. All records get the one date given."""
    rows = df.select(
        F.col(page).cast("long").alias("page"),
        _clean(F.col(url).cast("string")).alias("url"),
        F.coalesce(F.col(content).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    seen = F.struct(F.length("payload").alias("bytes"), F.xxhash64("payload").alias("hash"))
    payloads = rows.groupBy("digest").agg(
        F.any_value("payload").alias("payload"), F.min(seen).alias("low"), F.max(seen).alias("high")
    )
    clash = F.raise_error(F.concat(F.lit("different payloads under digest "), "digest")).cast("binary")
    payloads.select(
        "digest", F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(clash).alias("payload")
    ).write.parquet(f"{path}/payloads")

    short = stored(
        rows.select("page", "url", "digest", F.length("payload").alias("bytes"))
        .withColumn("at", F.monotonically_increasing_id()),
        "pages",
    )
    order = (F.col("page").isNull().alias("no_page"), "page", F.col("url").isNull().alias("no_url"), "url", "at")
    firsts = short.filter(F.col("bytes") >= least).groupBy("digest").agg(F.min(F.struct(*order)).alias("first"))
    rows = spread_join(short, firsts, ["digest"], "left")
    again = F.col("first").isNotNull() & (F.col("first.at") != F.col("at"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END + END),
    )
    only = lambda value: F.when(again, value)
    header = F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page"), F.col("digest"), F.col("at"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Profile", only(F.lit(PROFILE))),
        _line("WARC-Refers-To", only(_record_id(F.col("first.page"), F.col("digest"), F.col("first.at")))),
        _line("WARC-Refers-To-Target-URI", only(F.col("first.url"))),
        _line("WARC-Refers-To-Date", only(F.lit(date))),
        # Fields of this archive's own, which the format allows.
        _line("Page-ID", F.col("page")),
        _line("Refers-To-Page-ID", only(F.col("first.page"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.length("http") + F.when(again, 0).otherwise(F.col("bytes"))),
        F.lit(END),
    )
    rows.withColumn("http", http).select("digest", header.alias("header"), "http").write.parquet(f"{path}/records")


def _field(name: str) -> Column:
    """The value of a header field, null if it isn't there."""
    line = f"\\r\\n{name}: ([^\\r\\n]*)\\r\\n"
    return F.when(F.col("header").rlike(line), F.regexp_extract("header", line, 1))


def parsed(records: DataFrame) -> DataFrame:
    """Adds the fields of the headers: ``record_type``, ``record_id``, ``url``, ``page``, ``refers_to``, ``refers_to_page``."""
    return records.withColumns(
        {
            "record_type": _field("WARC-Type"),
            "record_id": _field("WARC-Record-ID"),
            "url": _field("WARC-Target-URI"),
            "page": _field("Page-ID").cast("long"),
            "refers_to": _field("WARC-Refers-To"),
            "refers_to_page": _field("Refers-To-Page-ID").cast("long"),
        }
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of an archive, one row each.

    ``record`` are the exact bytes of the record, ``header`` and ``http`` its headers,
    ``payload`` the full payload (a revisit's too, which its record leaves out), and
    the columns of ``parsed``.
    """
    payloads = spark.read.schema(ADDRESS).parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload is not that of digest "), "digest")).cast("binary")
    payloads = payloads.select(
        "digest", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(wrong).alias("payload")
    )
    records = spark.read.schema(RECORD).parquet(f"{path}/records")
    rows = spread_join(records, payloads, ["digest"], "left")
    missing = F.raise_error(F.concat(F.lit("no payload of digest "), "digest")).cast("binary")
    rows = parsed(rows.withColumn("payload", F.coalesce("payload", missing)))
    kept = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    ends = F.lit((END + END).encode())
    parts = F.col("header").cast("binary"), F.col("http").cast("binary"), kept, ends
    return rows.withColumn("record", F.concat(*parts))


def write_files(records: DataFrame, path: str, rows: int = 10_000) -> None:
    """The records as WARC files of at most so many records, compressed with gzip."""
    ends = len(END + END)
    text = F.expr(f"substring(record, 1, length(record) - {ends})").cast("string")
    options = {"lineSep": END + END, "compression": "gzip", "maxRecordsPerFile": rows}
    records.select(text.alias("value")).write.options(**options).text(path)


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of whole files, by their lengths, as a payload may look like a record."""
    import gzip

    for batch in batches:
        for (content,) in zip(batch.column("content").to_pylist()):
            data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
            out: dict[str, list] = {"header": [], "block": [], "record": []}
            at = 0
            while at < len(data):
                body = data.index(b"\r\n\r\n", at) + 4
                header = data[at:body]
                fields = dict(line.split(b": ", 1) for line in header.split(b"\r\n") if b": " in line)
                end = body + int(fields[b"Content-Length"])
                if data[end : end + 4] != b"\r\n\r\n":
                    raise ValueError(f"no end of record at byte {end}")
                out["header"].append(header.decode())
                out["block"].append(data[body:end])
                out["record"].append(data[at : end + 4])
                at = end + 4
            kinds = {"header": pa.string(), "block": pa.binary(), "record": pa.binary()}
            yield pa.RecordBatch.from_pydict({n: pa.array(out[n], kind) for n, kind in kinds.items()})


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: ``header``, ``block``, ``record``, and the columns of ``parsed``. A file is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return parsed(files.mapInArrow(_split, "header string, block binary, record binary"))
