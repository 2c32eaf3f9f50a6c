"""WARC archives and their globally ordered capture index.

Writing: each record is one text row in WARC/1.1 form, written by Spark's text
writer with the record separator as line separator, compressed by gzip.  Of
records with equal payloads of at least ``LEAST_REVISIT`` bytes the one with the largest id is the response,
the others are revisit records without payload.  Records are sorted by URL key
and time within their archive.

Reading: each archive is parsed by the lengths in its headers, which gives one
locally sorted run of index entries per archive.  The runs are merged by key
ranges: a range holds a bounded share of every run, and a loser tree merges the runs'
shares by URL key and time.  So the entries of all ranges together are in global order, and
each entry's place says which range it is in and where.

Edge cases: a null payload is empty, a null URL has an empty key, a URL comes back without line ends and white space around it, a null id is
written as none and read back as null; an id is smaller if null.  Repeated rows with the largest id are all
responses.  Payloads may hold anything, header-like lines too.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.llm.common import scratch_path, stored

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 32 << 20
RANGE_ROWS = 200_000
END = "\r\n\r\n"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY = (
    "archive string, place bigint, offset bigint, url_key string, captured string, url string, id bigint, "
    "payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
)


def url_key(url: Column) -> Column:
    """Host labels from last to first, joined by commas, then the rest of the URL; empty for null."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^:/?#]*://", "")
    host = F.lower(F.regexp_extract(rest, r"^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"^[^/?#]*([\s\S]*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), path)


def records(captures: DataFrame, *, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Add url_key, digest, size and refers_to (null for responses) to captures (id, url, captured, payload)."""
    # White space around a URL and line ends in it would not come back from a header.
    clean = F.regexp_replace(F.coalesce("url", F.lit("")), r"^\s+|\s+$|[\r\n]", "")
    known = captures.withColumn("url", clean).withColumns(
        {
            "payload": F.coalesce("payload", F.lit("")), "url_key": url_key(F.col("url")),
            "digest": F.sha1(F.coalesce("payload", F.lit("")).cast("binary")),
            "size": F.octet_length(F.coalesce("payload", F.lit(""))).cast("long"),
        }
    )
    # Only digests are moved: the largest id of every payload that comes more than once.
    large = known.where(F.col("size") >= least_revisit)
    copies = large.groupBy("digest", "size").agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = stored(copies.select("digest", "size", "first"), "copies")
    # Stored, so that the join sees plain exchanges and a payload of very many copies can be split.
    joined = known.join(copies, ["digest", "size"], "left")
    other = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def _record(text_id: Column) -> Column:
    """A record as text: WARC headers, HTTP headers, payload."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size"), F.lit(END))
    body = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    profile = F.concat(
        F.lit(f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: <urn:capture:"), F.col("refers_to").cast("string"), F.lit(">\r\n")
    )
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: <urn:capture:"), text_id, F.lit(">\r\nWARC-Date: "), F.col("captured"),
        F.lit("\r\nWARC-Target-URI: "), F.col("url"), F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"), F.lit("\r\n"),
        F.when(revisit, profile).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(body), F.lit(END),
    )
    return F.concat(head, body)


def write_archives(captures: DataFrame, path: str, *, archive_bytes: int = ARCHIVE_BYTES, least_revisit: int = LEAST_REVISIT) -> None:
    """Write captures (id, url, captured, payload) as gzipped archives of about ``archive_bytes``."""
    known = records(captures, least_revisit=least_revisit)
    total = captures.agg(F.sum(F.coalesce(F.octet_length("payload"), F.lit(0)).cast("long") + 600).alias("n")).first()["n"] or 0
    archives = max(1, -(-total // archive_bytes))
    dealt = known.repartition(archives, F.xxhash64("url_key", "id")).sortWithinPartitions("url_key", "captured", "id")
    text = _record(F.coalesce(F.col("id").cast("string"), F.lit("none")))
    dealt.select(text.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def _headers(block: bytes) -> dict[bytes, bytes]:
    return {name.lower(): value.strip() for name, _, value in (line.partition(b":") for line in block.split(b"\r\n")[1:])}


def _number(urn: bytes | None) -> int | None:
    value = (urn or b"<urn:capture:none>")[len(b"<urn:capture:") : -1]
    return None if value == b"none" else int(value)


def parse_archive(content: bytes) -> Iterator[tuple[int, dict[bytes, bytes], bytes]]:
    """(offset, WARC headers, HTTP payload) of each record of an uncompressed archive."""
    at = 0
    while at < len(content):
        if not content.startswith(b"WARC/1.1\r\n", at):
            raise ValueError(f"no record at {at}")
        end = content.index(b"\r\n\r\n", at)
        headers = _headers(content[at:end])
        begin, size = end + 4, int(headers[b"content-length"])
        block = content[begin : begin + size]
        if len(block) < size or content[begin + size : begin + size + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at {at} is cut off")
        headers[b"http-length"] = _headers(block[: block.index(b"\r\n\r\n")])[b"content-length"]
        yield at, headers, block[block.index(b"\r\n\r\n") + 4 :]
        at = begin + size + 4


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives below ``path``; those of one archive are one sorted run."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                archive = batch.column(0)[row].as_py().rsplit("/", 1)[-1]
                content = zlib.decompress(batch.column(1)[row].as_buffer(), wbits=47)
                rows = []
                for place, (offset, headers, payload) in enumerate(parse_archive(content)):
                    digest = headers[b"warc-payload-digest"].decode().removeprefix("sha1:")
                    kind = headers[b"warc-type"].decode()
                    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"{archive} at {offset}: the payload has another digest")
                    rows.append(
                        {
                            "archive": archive, "place": place, "offset": offset, "captured": headers[b"warc-date"].decode(),
                            "url": headers[b"warc-target-uri"].decode(), "id": _number(headers[b"warc-record-id"]),
                            "payload_bytes": int(headers[b"http-length"]), "payload_digest": digest, "record_type": kind,
                            "refers_to": _number(headers.get(b"warc-refers-to")),
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, _RUN_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    schema = _ENTRY.replace("url_key string, ", "")
    return files.mapInArrow(parse, schema).withColumn("url_key", url_key(F.col("url")))


_RUN_SCHEMA = pa.schema(
    [
        ("archive", pa.string()), ("place", pa.int64()), ("offset", pa.int64()), ("captured", pa.string()), ("url", pa.string()),
        ("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
)


class LoserTree:
    """Merges sorted lists: every inner node keeps the loser of its match, the winner goes up.

    After the winner is taken only the matches on its way to the root are played again.
    """

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [run for run in runs if run]
        self.at = [0] * len(self.runs)
        self.size = max(1, len(self.runs))
        self.losers = [-1] * self.size
        for run in range(len(self.runs)):
            self._enter(run)

    def _less(self, a: int, b: int) -> bool:
        """Whether run a's head comes first; an ended run comes last, equal heads by run."""
        a_ended, b_ended = self.at[a] >= len(self.runs[a]), self.at[b] >= len(self.runs[b])
        if a_ended or b_ended:
            return b_ended and not a_ended
        return (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def _enter(self, run: int) -> None:
        """A run's first match: it waits where nobody else does."""
        node, winner = (run + self.size) // 2, run
        while node:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._less(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs:
            winner = self.losers[0]
            if self.at[winner] >= len(self.runs[winner]):
                return
            yield self.runs[winner][self.at[winner]]
            self.at[winner] += 1
            node = (winner + self.size) // 2
            while node:
                if self._less(self.losers[node], winner):
                    self.losers[node], winner = winner, self.losers[node]
                node //= 2
            self.losers[0] = winner


def merge_runs(runs: DataFrame, *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All entries in global order: the ranges in order of their number, each in order of its places.

    Adds key_range and key_place.  A range's bounds take the archive and the place in it into account,
    so that captures of one URL can fill many ranges.
    """
    entries = stored(runs, "runs")
    total = entries.count()
    ranges = max(1, -(-total // range_rows))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(batch.num_rows for batch in held):
            return
        table = pa.Table.from_batches(held)
        heads: dict[str, list[tuple]] = {}
        names = ("archive", "place", "url_key", "captured", "id")
        # The shuffle keeps no order between blocks: a run's entries are put by their place in the archive.
        for row, (archive, place, key, captured, number) in enumerate(zip(*(table.column(n).to_pylist() for n in names), strict=True)):
            heads.setdefault(archive, []).append((place, (key, captured, -1 if number is None else number, archive, place, row)))
        merged = [entry[-1] for entry in LoserTree([[entry for _, entry in sorted(heads[archive])] for archive in sorted(heads)])]
        ordered = table.take(pa.array(merged, pa.int64()))
        ordered = ordered.append_column("key_range", pa.array([TaskContext.get().partitionId()] * len(merged), pa.int64()))
        ordered = ordered.append_column("key_place", pa.array(range(len(merged)), pa.int64()))
        yield from ordered.combine_chunks().to_batches()

    order = ["url_key", "captured", F.coalesce("id", F.lit(-1)), "archive", "place"]
    dealt = entries.repartitionByRange(ranges, *order) if ranges > 1 else entries.coalesce(1)
    schema = ", ".join(f"{name} {kind}" for name, kind in entries.dtypes) + ", key_range bigint, key_place bigint"
    return dealt.mapInArrow(merge, schema)


def archive_histories(captures: DataFrame, *, path: str | None = None, least_revisit: int = LEAST_REVISIT) -> DataFrame:
    """Write captures as archives, read them back and give their merged index."""
    spark = captures.sparkSession
    path = scratch_path(spark, "warc") if path is None else path
    write_archives(captures, path, least_revisit=least_revisit)
    return merge_runs(read_runs(spark, path))
