"""WARC archives written and read by Spark, and the merge of their indexes into one ordered history."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricebeam.session import materialize, scratch_path

#: The date given to pages that come without one: this instant plus page_id seconds.
FIRST_DATE = "2024-01-01 00:00:00"
#: Records of an archive file at most.
RECORDS_PER_FILE = 2048
#: Bytes of an archive file at most, so that it fits in memory when it is read. A larger record is alone in its file.
FILE_BYTES = 32 << 20
#: Larger pages are written to files of fewer records: as many as fit if all are as large as any of them can be.
FILE_RECORDS = (RECORDS_PER_FILE, 64, 4, 1)
#: Bytes of a record's header fields beside its URL, at most.
HEADER_BYTES = 1024
#: Captures that one task merges.
CAPTURES_PER_RANGE = 200_000

INDEX_SCHEMA = ("run string, urlkey string, timestamp string, page_id long, record_type string, refers_to long, "
                "payload_bytes long, payload_digest string, offset long, length long, url string")


def base32_sha1(payload: Column) -> Column:
    """SHA-1 of UTF-8 bytes in upper-case base 32: 5 hexadecimal digits are 4 digits of base 32."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _uuid(name: Column) -> Column:
    digest = F.md5(F.concat(F.lit("page:"), name.cast("string")))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def with_roles(pages: DataFrame, payload: str = "html") -> DataFrame:
    """(page_id, url, body, payload_digest, refers_to): refers_to is the smallest page_id with an equal
    payload, null for that page itself. Equal payloads are counted by digest before anything moves; only
    digests that occur twice are joined back."""
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("payload_digest", base32_sha1(F.col("body")))
    first = materialize(rows.groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                        .filter("n > 1").drop("n"), "payloads")
    return (rows.join(first, "payload_digest", "left")
            .withColumn("refers_to", F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first")))
            .drop("first"))


def record() -> Column:
    """A WARC record as text, but for the two line ends behind it, out of `with_roles` columns."""
    def field(name: str, value: Column | str) -> Column:
        return F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n"))

    size = F.octet_length("body")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    size.cast("string"), F.lit("\r\n\r\n"))
    revisit = F.col("refers_to").isNotNull()
    content = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    date = F.date_format(F.lit(FIRST_DATE).cast("timestamp_ntz")
                         + F.make_dt_interval(secs=F.coalesce(F.col("page_id"), F.lit(0)).cast("decimal(18,6)")),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]+", "%0A")), field("WARC-Date", date),
        field("WARC-Record-ID", _uuid(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        F.coalesce(field("Page-ID", F.col("page_id").cast("string")), F.lit("")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(
            field("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            field("WARC-Refers-To", _uuid(F.col("refers_to"))),
            field("Refers-To-Page-ID", F.col("refers_to").cast("string")))).otherwise(F.lit("")),
        field("Content-Type", "application/http;msgtype=response"),
        field("Content-Length", F.octet_length(content).cast("string")), F.lit("\r\n"), content)


def write_archives(pages: DataFrame, path: str, payload: str = "html") -> None:
    """One record per row, in uncompressed WARC 1.1 files below `path` on any file system of Spark's.
    Of equal payloads the smallest page_id is written as response, the others as revisits. Pages are written
    by size, each size with as many records to a file as FILE_BYTES hold."""
    def size(url: str, body: str) -> Column:  # of a record, at most: a line end in a URL becomes three bytes
        return (F.lit(HEADER_BYTES) + 3 * F.octet_length(F.coalesce(F.col(url).cast("string"), F.lit(""))).cast("long")
                + F.octet_length(F.coalesce(F.col(body).cast("string"), F.lit(""))))

    def group(bytes_: Column) -> Column:
        return sum((F.when(bytes_ > FILE_BYTES // n, 1).otherwise(0) for n in FILE_RECORDS[:-1]), F.lit(0))

    used = sorted(x[0] for x in pages.select(group(size("url", payload)).alias("g")).distinct().collect())
    rows = with_roles(pages, payload)
    for g in used or [0]:
        part = rows.filter(group(size("url", "body")) == g) if len(used) > 1 else rows
        (part.select(record().alias("value")).write.mode("errorifexists" if g == (used or [0])[0] else "append")
         .option("lineSep", "\r\n\r\n").option("maxRecordsPerFile", min(FILE_RECORDS[g], RECORDS_PER_FILE)).text(path))


def url_key(url: str) -> str:
    """Sort key of a URL: host labels from the last, path and sorted query in lower case, no scheme,
    no leading www, no fragment."""
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.strip().lower()
    host = re.sub(r"^www\d*\.", "", host)
    query = "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return (",".join(reversed(host.split("."))) + (f":{port}" if port and port not in (80, 443) else "") + ")"
            + (parts.path.lower() or "/") + (f"?{query}" if query else ""))


def records_of(archive: bytes) -> Iterator[tuple[int, int, dict[str, str], memoryview]]:
    """(offset, length, header fields in lower case, content) of each record, by Content-Length alone."""
    at, view = 0, memoryview(archive)
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        stop = end + 4 + int(fields["content-length"])
        if archive[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where it says")
        yield at, stop - at, fields, view[end + 4 : stop]
        at = stop + 4


def _capture(run: str, offset: int, length: int, fields: dict[str, str], content: memoryview) -> tuple:
    raw = bytes(content)
    http = raw.index(b"\r\n\r\n") + 4
    size = int(re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", raw[:http])[1])
    digest = fields["warc-payload-digest"].partition(":")[2]
    if fields["warc-type"] == "response":
        payload = raw[http:]
        if len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of the record at byte {offset} of {run} is damaged")
    page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
    return (run, url_key(fields["warc-target-uri"]), re.sub(r"\D", "", fields["warc-date"]),
            None if page is None else int(page), fields["warc-type"], None if refers is None else int(refers),
            size, digest, offset, length, fields["warc-target-uri"])


def _order(capture: tuple) -> tuple:
    """URL key, time, then page and place, so that equal captures have one order too."""
    return capture[1], capture[2], capture[3] is None, capture[3] or 0, capture[0], capture[8]


def _table(captures: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*captures)) if captures else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(columns, schema)], schema=schema)


ARROW = pa.schema([("run", pa.string()), ("urlkey", pa.string()), ("timestamp", pa.string()), ("page_id", pa.int64()),
                   ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                   ("payload_digest", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("url", pa.string())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives below `path`: one run per file, each sorted by URL key and time.
    Payload digests are computed again; a damaged record fails the job."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _table(sorted((_capture(run, *x) for x in records_of(content)), key=_order), ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(work, INDEX_SCHEMA)


class LoserTree:
    """Merges sorted runs: inner nodes keep the loser of each match, so the next item takes one match per
    level along a single path, whatever the number of runs."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = runs
        self.k = len(runs)
        self.heads = [next(x, None) for x in runs]
        self.keys = [None if x is None else _order(x) for x in self.heads]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i, building=True)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.keys[a], self.keys[b]
        return y is None or x is not None and (x, a) < (y, b)

    def _play(self, winner: int, building: bool = False) -> None:
        node = (winner + self.k) // 2
        while node:
            other = self.losers[node]
            if other < 0 and building:
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (head := self.heads[winner := self.losers[0]]) is not None:
            yield head
            following = self.heads[winner] = next(self.runs[winner], None)
            self.keys[winner] = None if following is None else _order(following)
            self._play(winner)


def merged_index(captures: DataFrame, per_range: int = CAPTURES_PER_RANGE) -> DataFrame:
    """One globally ordered history of captures out of locally sorted runs.

    Runs are cut at common bounds of (URL key, time, page, place), which part a URL with a third of all captures too;
    each task merges its slices of all runs by a loser tree. Returns the index and `range`, `place`: rows
    ordered by both are in global order.
    """
    spark = captures.sparkSession
    runs = materialize(captures, "runs")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), runs.count() // per_range)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        slices: dict[str, list[pa.RecordBatch]] = {}
        for batch in batches:
            for name, rows in _by_run(batch):
                slices.setdefault(name, []).append(rows)
        # Rows of a run come in its order from one writer; slices of several writers are runs apart.
        tree = LoserTree([iter(x) for name in sorted(slices) for x in _ascending(slices[name])])
        place, waiting = 0, []
        number = TaskContext.get().partitionId()
        for capture in tree:
            waiting.append((*capture, number, place))
            place += 1
            if len(waiting) == 8192:
                yield _table(waiting, RANGED)
                waiting = []
        if waiting:
            yield _table(waiting, RANGED)

    cut = runs.repartitionByRange(ranges, "urlkey", "timestamp", F.col("page_id").asc_nulls_last(), "run", "offset")
    return cut.mapInArrow(work, INDEX_SCHEMA + ", range int, place long")


RANGED = ARROW.append(pa.field("range", pa.int32())).append(pa.field("place", pa.int64()))


def _by_run(batch: pa.RecordBatch) -> list[tuple[str, list[tuple]]]:
    rows = list(zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))))
    names = np.array([x[0] for x in rows], object)
    cuts = [0, *(np.flatnonzero(names[1:] != names[:-1]) + 1).tolist(), len(rows)] if rows else [0]
    return [(rows[a][0], rows[a:b]) for a, b in zip(cuts, cuts[1:])]


def _ascending(pieces: list[list[tuple]]) -> Iterator[list[tuple]]:
    """The fewest runs in order: pieces are joined for as long as they ascend."""
    run: list[tuple] = []
    for row in (x for piece in pieces for x in piece):
        if run and _order(row) < _order(run[-1]):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def archived_history(pages: DataFrame, payload: str = "html") -> DataFrame:
    """Write `pages` (page_id, url, payload) to WARC files in the shared folder, read them back, and merge
    their indexes: one row per page with page_id, url, urlkey, timestamp, record_type, refers_to,
    payload_bytes, payload_digest, the file, and the record's offset and length in it.

    A null payload is empty; empty payloads are equal payloads. A null url is written empty. Rows that
    repeat the smallest page_id of a payload are all responses; a row without page_id is a revisit if
    its payload has a page with one, else a response.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path, payload)
    return merged_index(read_archives(spark, path)).withColumnRenamed("run", "file")


ORACLE = """
WITH payloads AS (
    SELECT page_id, url, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM payloads GROUP BY digest),
urls AS (
    SELECT page_id, lower(regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1), '^www[0-9]*\\.', '')) AS host,
           lower(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)) AS path,
           lower(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1)) AS query
    FROM pages)
SELECT p.page_id, octet_length(encode(body))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda s:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  ((('0x' || substr(digest, (5 * i + 1)::BIGINT, 5))::BIGINT >> s) & 31) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN p.page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id > first THEN first END AS refers_to,
       array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || CASE WHEN path = '' THEN '/' ELSE path END
           || CASE WHEN query = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(query, '&')), '&') END AS urlkey,
       strftime(TIMESTAMP '2024-01-01' + to_seconds(p.page_id), '%Y%m%d%H%M%S') AS timestamp
FROM payloads p JOIN firsts USING (digest) JOIN urls USING (page_id)
"""
