"""WARC archives: write captures, read records, and assemble them into transactions.

A capture is three records: a request, a response (or a revisit, which refers to the response that
has the payload), and metadata. The response or revisit is the one that the other two name in
``WARC-Concurrent-To``; the assembly joins them by that id and gives one nested row per capture.

Writing. Of equal payloads of at least ``least_bytes`` the capture with the largest id is stored as a
response, the others revisit it: payloads are compared by their SHA-1 digest, and only digests and ids
shuffle, combined before the shuffle, so a large group of copies is no large task. Records are
text whose separator is the record end, so Spark's text sink writes whole archives; each file has at
most ``CAPTURES_PER_FILE`` captures, which bounds what a reader holds.

Reading. A file is read at once and cut by each record's Content-Length, so payloads may hold
anything, also what looks like a record. The digest of every payload is computed anew.

Defined cases: a null payload is empty; a capture without a url is written with ``urn:none``; rows
with a null id are written and read back with a null id; of rows that share id and payload one
is the response and the others revisit it; an empty table gives no capture; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textforge.llm.frames import checked_broadcast, table
from textforge.session import materialize, scratch_path

LEAST_BYTES = 0
CAPTURES_PER_FILE = 500
_END = "\r\n"
_RECORD_END = "\r\n\r\n"
_DATE = "2024-01-01T00:00:00Z"  # captures carry no time of their own


def _sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32(digest_hex: Column) -> Column:
    """Base 32 of a digest given as 40 hexadecimal digits: 5 of them are 4 characters."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

    def four(i: Column) -> Column:
        value = F.conv(F.substring(digest_hex, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        places = [F.shiftright(value, bits).bitwiseAND(31) + 1 for bits in (15, 10, 5, 0)]
        return F.concat(*[F.substring(F.lit(alphabet), p, F.lit(1)) for p in places])

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), four), "")


def _record(kind: Column, record_id: Column, fields: dict[str, Column], body: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind)]
    lines += [F.lit(f"WARC-Date: {_DATE}"), F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">"))]
    # A field without a value is left out.
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields.items()]
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(body)))
    return F.concat(F.concat_ws(_END, *lines), F.lit(_END + _END), body)


def captures(pages: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``key, id, url, payload, bytes, payload_digest, refers_key, refers_id`` of every row; the last two for revisits.

    A row's key is its id, its digest, and 0 but for repeated rows; those are written as a table to get
    numbers that stay the same.
    """
    sized = pages.select("id", "url", "payload", F.octet_length("payload").cast("long").alias("bytes"))
    sized = sized.withColumn("digest", F.sha1("payload"))  # joins compare the hexadecimal form
    keys = materialize(sized.select("id", "digest"), "warc-keys")
    each = keys.groupBy("id", "digest").agg(F.count("*").alias("n"))
    groups = each.groupBy("digest").agg(F.max("id").alias("last"), F.sum("n").alias("size")).where("size > 1")
    groups = checked_broadcast(materialize(groups.select("digest", "last"), "warc-groups"), 64)
    repeated = materialize(each.where("n > 1").select(F.col("id").alias("i"), F.col("digest").alias("d")), "warc-repeated")
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d"))
    alone = sized.join(checked_broadcast(repeated, 64), same, "left_anti").withColumn("nth", F.lit(0).cast("long"))
    several = sized.join(checked_broadcast(repeated, 64), same, "left_semi")
    several = materialize(several.withColumn("nth", F.monotonically_increasing_id()), "warc-several")
    first = several.groupBy(F.col("id").alias("i"), F.col("digest").alias("d")).agg(F.min("nth").alias("first"))
    numbered = several.join(first, same).withColumn("nth", F.when(F.col("nth") == F.col("first"), 0).otherwise(F.col("nth") + 1))
    rows = alone.unionByName(numbered.select(*alone.columns)).join(groups, "digest", "left")

    def key(page: Column, nth: Column) -> Column:
        return F.concat_ws("-", F.coalesce(page.cast("string"), F.lit("none")), "digest", nth.cast("string"))

    # ``last`` is null for a payload without copies, and for copies of which none has an id.
    copied = F.coalesce("last", "id").eqNullSafe(F.col("id")) & (F.col("nth") == 0)
    revisit = ~copied & (F.col("bytes") >= least_bytes)
    return rows.withColumns(
        {
            "payload_digest": base32(F.col("digest")),
            "key": key(F.col("id"), F.col("nth")),
            "refers_key": F.when(revisit, key(F.coalesce("last", "id"), F.lit(0))),
            "refers_id": F.when(revisit, F.coalesce("last", "id")),
        }
    )


def records(found: DataFrame) -> DataFrame:
    """The three records of each capture as one ``value`` each."""
    name = lambda part, key: F.concat(F.lit(f"urn:capture:{part}:"), key.cast("string"))
    key, revisit = F.col("key"), F.col("refers_key").isNotNull()
    page = F.coalesce(F.col("id").cast("string"), F.lit(""))
    url = F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit("urn:none"))
    to = {"WARC-Target-URI": url}
    linked = to | {"WARC-Concurrent-To": F.concat(F.lit("<"), name("response", key), F.lit(">"))}
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.when(revisit, "").otherwise(F.col("payload")))
    response = _record(
        F.when(revisit, "revisit").otherwise("response"),
        name("response", key),
        to
        | {
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("payload_digest")),
            "WARC-Profile": F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            "WARC-Refers-To": F.concat(F.lit("<"), name("response", F.col("refers_key")), F.lit(">")),
            "Content-Type": F.lit("application/http; msgtype=response"),
        },
        answer,
    )
    request = _record(F.lit("request"), name("request", key), linked | {"Content-Type": F.lit("application/http; msgtype=request")}, F.lit("GET / HTTP/1.1\r\n\r\n"))
    notes = F.concat(F.lit("page: "), page, F.lit("\r\npayload-bytes: "), F.col("bytes").cast("string"), F.lit("\r\n"))
    metadata = _record(F.lit("metadata"), name("metadata", key), linked | {"Content-Type": F.lit("application/warc-fields")}, notes)
    return found.select(F.explode(F.array(request, response, metadata)).alias("value"))


def write_archives(found: DataFrame, path: str) -> None:
    writer = records(found).write.option("lineSep", _RECORD_END).option("maxRecordsPerFile", 3 * CAPTURES_PER_FILE)
    writer.text(path)


_FIELD = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r\n")
_SCHEMA = (
    "kind string, record_id string, uri string, concurrent_to string, refers_to string, digest string, "
    "payload_bytes long, payload_digest string, page long, noted_bytes long, payload binary"
)


def _parsed(data: bytes, with_payload: bool):
    at = 0
    while at < len(data):
        begin = data.index(b"\r\n", at) + 2
        end = data.index(b"\r\n\r\n", at)
        fields = {k.decode().lower(): v.decode() for k, v in _FIELD.findall(data, begin, end + 2)}
        body_at = end + 4
        stop = body_at + int(fields["content-length"])
        kind = fields["warc-type"]
        link = lambda name: fields[name].strip("<>") if name in fields else None  # noqa: B023, E731
        row = [kind, link("warc-record-id"), fields.get("warc-target-uri"), link("warc-concurrent-to"), link("warc-refers-to")]
        row.append(fields.get("warc-payload-digest", "").removeprefix("sha1:") or None)
        if kind in ("response", "revisit"):
            payload = data[data.index(b"\r\n\r\n", body_at, stop) + 4 : stop]
            row += [len(payload), _sha1(payload), None, None, payload if with_payload else None]
        elif kind == "metadata":
            notes = {k: v.decode() for k, v in _FIELD.findall(data, body_at, stop)}
            page = notes[b"page"]
            row += [None, None, int(page) if page else None, int(notes[b"payload-bytes"]), None]
        else:
            row += [None] * 5
        yield row
        at = stop + 4


def read_records(spark, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    arrow = pa.schema(list(zip(names, kinds, strict=True)))

    def parse(batches):
        for batch in batches:
            for value in batch.column(0):
                rows = list(_parsed(value.as_py(), with_payload))
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*rows, strict=True), strict=True)), arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(parse, _SCHEMA)


def assemble(found: DataFrame) -> DataFrame:
    """One row per capture: ``uri`` and the nested ``request``, ``response`` and ``metadata``."""
    answer = found.where("kind IN ('response', 'revisit')")
    response = answer.select(
        "uri",
        "record_id",
        F.struct("kind", "record_id", "refers_to", "digest", "payload_bytes", "payload_digest", "payload").alias("response"),
    )
    request = found.where("kind = 'request'").select(
        F.col("concurrent_to").alias("record_id"), F.struct(F.col("record_id").alias("record_id")).alias("request")
    )
    metadata = found.where("kind = 'metadata'").select(
        F.col("concurrent_to").alias("record_id"), F.struct("record_id", "page", "noted_bytes").alias("metadata")
    )
    both = response.join(request, "record_id", "left").join(metadata, "record_id", "left")
    return both.select("uri", "request", "response", "metadata")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("long").alias("id"), "url", F.coalesce("html", F.lit("")).alias("payload")
    )
    path = scratch_path(spark, "archives")
    write_archives(captures(pages), path)
    done = assemble(materialize(read_records(spark, path, with_payload=False), "records"))
    rows = done.select(
        F.col("metadata.page").alias("page_id"),
        F.when(F.col("response.kind") == "response", F.col("response.payload_bytes"))
        .otherwise(F.col("metadata.noted_bytes"))
        .alias("payload_bytes"),
        F.when(F.col("response.kind") == "response", F.col("response.payload_digest"))
        .otherwise(F.col("response.digest"))
        .alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").alias("refers_record"),
        F.col("response.record_id").alias("record_id"),
    )
    rows = materialize(rows, "assembled")
    referred = rows.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_record"), F.col("page_id").alias("refers_to")
    )
    wanted = rows.where("refers_record IS NOT NULL").join(referred, "refers_record", "left")
    alone = rows.where("refers_record IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return alone.select(*columns).union(wanted.select(*columns))
