"""WARC archives of pages: writing with revisits, segments and chunked transfer framing; reading with reassembly.

Archives are rows (archive_id, content), so any store that Spark reaches can hold them; read_files() takes .warc and
.warc.gz files as well. Records longer than a segment go on in continuation records, which may lie anywhere; a reader
groups them by the id of their origin, orders them by number, verifies the total length and undoes the chunk framing.
"""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, small_batches, split_by_ids
from .exact_dedup import frequent

#: Record ids: the page's id, percent-encoded, with #d for the d-th further payload of a repeated id and ~r for the r-th
#: repeat of a row; or none, with a running number.
_PAGE, _NO_PAGE = "urn:page:", "urn:nopage"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "record_id string, type string, url string, refers_to string, digest string, number int, total long, block binary, payload binary, complete boolean"


def decisions(pages: DataFrame, least: int = 1000, id_col: str = "page_id", html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """(revisits, repeated). revisits: page_id, digest, refers_to, variant of the pages to be written as revisits: of equal
    payloads of at least `least` bytes all but those with the largest id. The digests are SHA-1; a null payload is empty.
    variant counts the other payloads of the id referred to that precede this one by digest, 0 unless that id is
    repeated. A null id is no revisit and not referred to. Copies of a payload that is very frequent are resolved where
    they lie. repeated: the page_ids of several rows."""
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    d = cut(pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("page_id"), F.octet_length(html).alias("bytes"), F.unhex(F.sha1(html)).alias("digest")))
    repeated = cut(d.groupBy("page_id").count().where("count > 1").select("page_id"), light=True)
    variants = d.join(repeated, "page_id").select("page_id", "digest").distinct().withColumn("variant", F.row_number().over(Window.partitionBy("page_id").orderBy("digest")) - 1)
    large = d.where(F.col("bytes") >= least).drop("bytes")
    first = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("low")).where("low < refers_to").drop("low")
    first = cut(first.join(variants.withColumnRenamed("page_id", "refers_to"), ["refers_to", "digest"], "left").withColumn("variant", F.coalesce("variant", F.lit(0))), light=True)
    hot = first.join(F.broadcast(frequent(large)), "digest")
    found = large.join(F.broadcast(hot), "digest").unionByName(large.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(first, "digest"))
    return cut(found.where("page_id < refers_to").select("page_id", "digest", "refers_to", "variant").distinct(), light=True), repeated


def _name(page: object, variant: int | None, repeat: int | None = 0) -> str:
    return _PAGE + quote(str(page), safe="").replace("~", "%7E") + (f"#{variant}" if variant else "") + (f"~{repeat}" if repeat else "")


def page_of(record_id: str, kind: str) -> Column:
    """The page's id in a column of record ids, as `kind`; null where there is none."""
    return F.url_decode(F.nullif(F.regexp_extract(record_id, f"^{_PAGE}([^#~]*)", 1), F.lit(""))).try_cast(kind)


def _header(fields: list[tuple[str, object]], block: bytes, level: int) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", level, mtime=0)


def _framed(payload: bytes, size: int) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join([b"%x\r\n%b\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def unframed(body: bytes) -> bytes:
    """The payload of a body in chunked transfer framing; extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        n = int(body[at:stop].split(b";")[0], 16)
        if not n:
            return b"".join(out)
        at = stop + 2 + n
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk does not end where it says")
        out.append(body[stop + 2 : at])
        at += 2


def write(pages: DataFrame, least: int = 1000, segment: int = 32768, chunk: int = 4096, archive: int = 2 << 20, level: int = 3, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(archive_id, content): gzipped archives of about `archive` bytes, one record per page.

    Payloads of `chunk` bytes or more are sent in chunks of that size, and blocks of more than `segment` bytes in
    segments. A null payload is empty, a null address is left out, control characters in addresses are
    percent-encoded. Every row has a record of its own, also where an id is null, of any type or repeated, with the same
    payload or another one. Other columns are ignored.
    """
    again, repeated = decisions(pages, least, id_col, html_col)
    plain = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    plain = plain.withColumn("digest", F.unhex(F.sha1(F.coalesce("html", F.lit("")).cast("binary"))))
    # only revisits and repeated ids, and a few others, are shuffled
    clear, rest = split_by_ids(plain.where("page_id IS NOT NULL"), again.select("page_id").unionByName(repeated).distinct(), "page_id")
    one = Window.partitionBy("page_id").orderBy("digest")
    rest = rest.withColumns({"_variant": F.dense_rank().over(one) - 1, "_repeat": F.row_number().over(one) - F.rank().over(one)})
    refers = again.groupBy("page_id").agg(F.collect_list(F.struct("digest", "refers_to", "variant")).alias("r"))
    rest = rest.join(refers, "page_id", "left").withColumn("r", F.get(F.filter("r", lambda x: x["digest"] == F.col("digest")), F.lit(0)))
    rest = rest.select("page_id", "url", F.when(F.col("r").isNull(), F.col("html")).alias("html"), "digest", "_variant", "_repeat", F.col("r.refers_to").alias("refers_to"), F.col("r.variant").alias("variant"))
    joined = clear.unionByName(plain.where("page_id IS NULL")).unionByName(rest, allowMissingColumns=True)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, held, size, n, serial = TaskContext.get().partitionId() << 32, [], 0, 0, 0

        def one() -> pa.RecordBatch:
            nonlocal held, size, n
            content, held, size, n = b"".join(held), [], 0, n + 1
            return pa.RecordBatch.from_arrays([pa.array([base + n - 1]), pa.array([content], pa.binary())], ["archive_id", "content"])

        for batch in batches:
            for row in range(batch.num_rows):
                page, url, html, sha1, mine, repeat, refers, variant = (c[row].as_py() for c in batch.columns)
                payload, serial = (html or "").encode(), serial + 1
                name = f"{_NO_PAGE}~{base + serial}" if page is None else _name(page, mine, repeat)
                url = None if url is None else "".join(f"%{ord(c):02X}" if c < " " else c for c in url)
                digest = f"sha1:{sha1.hex()}"
                head = [("WARC-Record-ID", f"<{name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Target-URI", url), ("WARC-Payload-Digest", digest)]
                http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                kind = ("Content-Type", "application/http; msgtype=response")
                if refers is not None:
                    held.append(_header([("WARC-Type", "revisit"), *head, ("WARC-Refers-To", f"<{_name(refers, variant)}>"), ("WARC-Profile", _PROFILE), kind], http + b"\r\n", level))
                else:
                    body = _framed(payload, chunk) if len(payload) >= chunk else payload
                    block = http + (b"Transfer-Encoding: chunked\r\n" if len(payload) >= chunk else b"Content-Length: %d\r\n" % len(payload)) + b"\r\n" + body
                    if len(block) <= segment:
                        held.append(_header([("WARC-Type", "response"), *head, kind], block, level))
                    else:
                        parts = [block[i : i + segment] for i in range(0, len(block), segment)]
                        held.append(_header([("WARC-Type", "response"), *head, kind, ("WARC-Segment-Number", 1)], parts[0], level))
                        for k, part in enumerate(parts[1:], 2):
                            last = len(block) if k == len(parts) else None
                            held.append(_header([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{name}:{k}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Segment-Origin-ID", f"<{name}>"), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", last)], part, level))
                size += len(held[-1])
                if size >= archive:
                    yield one()
        if held:
            yield one()

    columns = ("page_id", "url", "html", "digest", "_variant", "_repeat", "refers_to", "variant")
    return joined.select(*columns).mapInArrow(archives, "archive_id long, content binary")


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and blocks. What follows a record without a readable length is passed over up to the
    next gzip member; a damaged or cut-off member ends the archive."""
    for data in _split(content):
        at = 0
        while (stop := data.find(b"\r\n\r\n", at)) >= 0:
            lines = data[at:stop].decode(errors="replace").split("\r\n")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            if not head.get("content-length", "").isdecimal():
                break
            n = int(head["content-length"])
            if stop + 4 + n > len(data):
                break
            yield head, data[stop + 4 : stop + 4 + n]
            at = stop + 4 + n + 4


def _split(content: bytes) -> Iterator[bytes]:
    view, at = memoryview(content), 0
    if content[:2] != b"\x1f\x8b":
        yield content
        return
    while at < len(content):
        d = zlib.decompressobj(31)
        out, step = [], 1 << 16
        while not d.eof and at < len(content):
            try:
                out.append(d.decompress(view[at : at + step]))
            except zlib.error:
                return
            at += step
        at = min(at, len(content)) - len(d.unused_data)
        yield b"".join(out)


def records(archives: DataFrame) -> DataFrame:
    """One row per record of archives (content): RECORD, without warcinfo and other kinds. Ids are bare of brackets.
    Records in one piece come decoded, segments as blocks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 5 + [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
        names = [x.split()[0] for x in RECORD.split(", ")]
        for batch in batches:
            for content in batch.column(0):
                out: list[tuple] = []
                for h, block in _records(content.as_py()):
                    if h.get("warc-type") not in ("response", "revisit", "continuation"):
                        continue
                    own = h.get("warc-segment-origin-id") or h.get("warc-record-id")
                    if own is None:
                        continue
                    refers = h.get("warc-refers-to")
                    number, payload = _int(h, "warc-segment-number"), None
                    if number is None and h["warc-type"] != "revisit":
                        payload = _payload(block)
                    done = number is None and (payload is not None or h["warc-type"] == "revisit")
                    out.append((own.strip("<>"), h["warc-type"], h.get("warc-target-uri"), refers and refers.strip("<>"), h.get("warc-payload-digest"), number, _int(h, "warc-segment-total-length"), None if number is None else block, payload, done))
                    if len(out) >= 256:
                        yield _batch(out, kinds, names)
                        out = []
                yield _batch(out, kinds, names)

    return archives.select("content").mapInArrow(read, RECORD)


def _int(head: dict[str, str], name: str) -> int | None:
    return int(head[name]) if head.get(name, "").isdecimal() else None


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)


def _payload(block: bytes) -> bytes | None:
    """What an HTTP response carries; null where its chunk framing is broken."""
    head, _, body = block.partition(b"\r\n\r\n")
    if b"transfer-encoding: chunked" not in head.lower():
        return body
    try:
        return unframed(body)
    except ValueError:
        return None


def _reassembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs over (record_id, type, url, refers_to, digest, numbers, total, blocks)."""
    kinds, names = [pa.string()] * 5 + [pa.binary(), pa.bool_()], ["record_id", "type", "url", "refers_to", "digest", "payload", "complete"]
    for batch in batches:
        rows = []
        for row in range(batch.num_rows):
            *head, numbers, total, blocks = (c[row].as_py() for c in batch.columns)
            block = b"".join(blocks)
            payload = _payload(block) if numbers == list(range(1, len(numbers) + 1)) and total == len(block) else None
            rows.append((*head, payload, payload is not None))
        yield _batch(rows, kinds, names)


def payloads(read: DataFrame) -> DataFrame:
    """record_id, type, url, refers_to, digest, payload, complete of each response and revisit.

    Segments are put together: complete is false, and the payload null, where a number is missing, the total length
    differs or the chunk framing is broken. A revisit's payload is null and complete.
    """
    columns = ["record_id", "type", "url", "refers_to", "digest", "payload", "complete"]
    parts = read.where("number IS NOT NULL").groupBy("record_id").agg(
        F.max(F.when(F.col("type") != "continuation", F.col("type"))).alias("type"), F.max("url").alias("url"), F.max("refers_to").alias("refers_to"), F.max("digest").alias("digest"),
        F.max("total").alias("total"), F.sort_array(F.collect_set(F.struct("number", "block"))).alias("s"),
    )
    parts = parts.selectExpr("record_id", "coalesce(type, 'response') AS type", "url", "refers_to", "digest", "s.number AS numbers", "total", "s.block AS blocks")
    out = "record_id string, type string, url string, refers_to string, digest string, payload binary, complete boolean"
    return read.where("number IS NULL").select(*columns).unionByName(parts.mapInArrow(_reassembled, out))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """payloads() of .warc and .warc.gz files; a file of over 2 GB is beyond a Spark row and must be split first."""
    return payloads(records(spark.read.format("binaryFile").load(path)))


def round_trip(pages: DataFrame, id_col: str = "page_id", **options) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, from its archives read back.

    A revisit has the length and digest of the response that it refers to. Each row gives a row, also where its id is
    null or repeated; ids come back in the type of the column. Of rows that repeat the largest id of a payload all are
    responses. An empty table gives no rows.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    with small_batches(pages.sparkSession, 1024):
        archives = cut(write(pages, id_col=id_col, **options))
    with small_batches(pages.sparkSession, 1):
        back = payloads(records(archives)).select("record_id", "type", "refers_to", F.octet_length("payload").cast("long").alias("bytes"), F.sha1("payload").alias("digest"))
        back = cut(back, light=True)
    origin = back.where("type = 'response'").selectExpr("record_id AS refers_to", "bytes AS whole", "digest AS own")
    revisits = back.where("type = 'revisit'").drop("bytes", "digest").join(origin, "refers_to", "left")
    full = back.where("type = 'response'").select("record_id", "type", "bytes", "digest", F.lit(None).cast("string").alias("refers_to"))
    every = full.unionByName(revisits.selectExpr("record_id", "type", "whole AS bytes", "own AS digest", "refers_to"))
    return every.select(page_of("record_id", kind).alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), page_of("refers_to", kind).alias("refers_to"))
