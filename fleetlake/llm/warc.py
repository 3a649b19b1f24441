"""WARC archives of page captures and the external merge of their index runs.

Writing: the least page id with a payload (grouped by its SHA-1, a second hash
and its length, pre-aggregated) is the response, all others are revisits that
name it.  Each task writes one ``.warc.gz`` below the shared folder, one gzip
member per record, so that a record can be read by its offset.

Indexing: each archive is read back from its first byte to its last; the
records' metadata, sorted by URL key and timestamp, form one capture run per
archive, with the place of every record.

Merging: runs are cut at common range boundaries, and each range merges its
pieces of all runs by a loser tree, which costs one comparison per level for
each row.  Ranges in order make the global capture history.

Cases: a null html is an empty payload; a null URL has the empty key; rows with
a null page id are responses if no other row holds their payload, else revisits
of the least page id; rows that repeat the least page id of a payload are all
responses; an empty table gives no archives.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import datetime
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm.common import cut, table
from fleetlake.llm.storage import open_input, open_output
from fleetlake.session import scratch_path

CAPTURE = ("url_key string, captured string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, run int, file string, offset long, length long")
FIELDS = [x.rsplit(" ", 1)[0] for x in CAPTURE.split(", ")]
SCHEMA = pa.schema([(x.rsplit(" ", 1)[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[x.rsplit(" ", 1)[1]]) for x in CAPTURE.split(", ")])
ARCHIVE = "run int, file string, records long"
EPOCH = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)
ROWS = 4096


def url_key(url: str | None) -> str:
    """Host labels reversed, then the rest: ``http://a.b.c/x?y`` -> ``c,b,a)/x?y``."""
    rest = (url or "").split("#", 1)[0].strip()
    if not rest:
        return ""
    rest = rest.split("://", 1)[-1]
    cut = min((i for i in (rest.find("/"), rest.find("?")) if i >= 0), default=len(rest))
    host, path = rest[:cut].lower().rsplit("@", 1)[-1], rest[cut:]
    host, _, port = host.partition(":")
    labels = host.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + (f":{port}" if port not in ("", "80", "443") else "") + ")" + (path or "/")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def render(page_id: int | None, url: str | None, payload: bytes, captured: str, refers_to: int | None, revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {captured}", *([] if url is None else [f"WARC-Target-URI: {_line(url)}"]), f"WARC-Payload-Digest: sha1:{digest_of(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(record: bytes) -> dict:
    """Headers and payload facts of one record; a response's digest is computed
    from its payload and must agree with the header."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(next(x for x in http.decode().split("\r\n") if x.lower().startswith("content-length:")).split(":")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError("payload does not match its digest")
    number = lambda x: int(x[len("<urn:page:"):-1]) if x and x != "<urn:page:>" else None
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "captured": fields["WARC-Date"], "payload_bytes": size,
            "payload_digest": digest, "record_type": kind, "refers_to": number(fields.get("WARC-Refers-To")), "payload": payload}


def _write(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, out, count = TaskContext.get().partitionId(), None, 0
        path = f"{folder}/captures-{part:06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        for batch in batches:
            for page, url, html, captured, refers, revisit in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                out = out or open_output(path)
                out.write(gzip.compress(render(page, url, (html or "").encode(), captured, refers, revisit), 4, mtime=0))
                count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"run": part, "file": path, "records": count}], pa.schema([("run", pa.int32()), ("file", pa.string()), ("records", pa.int64())]))
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", captured_col: str | None = None) -> DataFrame:
    """Write the archives; returns their list.  Without a capture column, page n is
    captured n seconds after a fixed start (a null id: at the start)."""
    page = F.col(id_col).cast("long")
    moment = F.col(captured_col) if captured_col else F.timestamp_seconds(F.lit(int(EPOCH.timestamp())) + F.coalesce(page, F.lit(0)))
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(page.alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("captured"),
                        F.sha1(F.encode(html, "UTF-8")).alias("d1"), F.xxhash64(html).alias("d2"), F.octet_length(html).alias("size"))
    # written out, so that the join's sides are plain exchanges: a payload that many pages share is split
    first = cut(rows.groupBy("d1", "d2", "size").agg(F.min("page_id").alias("first")), "first-pages")
    marked = rows.join(first, ["d1", "d2", "size"])
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    dealt = marked.select("page_id", "url", "html", "captured", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))
    dealt.mapInArrow(_write(folder), ARCHIVE).write.mode("overwrite").parquet(f"{folder}/archives")
    return pages.sparkSession.read.schema(ARCHIVE).parquet(f"{folder}/archives")


def records(path: str) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of an archive, one gzip member at a time."""
    with open_input(path) as f:
        rest, at = b"", 0
        while True:
            made, member, size = zlib.decompressobj(31), [], 0
            while not made.eof:
                if not rest:
                    rest = f.read(1 << 20)
                    if not rest:
                        if size:
                            raise ValueError(f"{path}: cut off")
                        return
                member.append(made.decompress(rest))
                size += len(rest) - len(made.unused_data)
                rest = made.unused_data
            yield at, size, b"".join(member)
            at += size


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for archive in batch.to_pylist():
            run = []
            for at, size, record in records(archive["file"]):
                row = parse(record)
                del row["payload"]
                run.append(row | {"url_key": url_key(row["url"]), "run": archive["run"], "file": archive["file"], "offset": at, "length": size})
            if len(run) != archive["records"]:
                raise ValueError(f"{archive['file']}: {len(run)} of {archive['records']} records")
            run.sort(key=_order)
            for a in range(0, len(run), ROWS):
                yield pa.RecordBatch.from_pylist(run[a:a + ROWS], SCHEMA)


def _order(row: dict) -> tuple:
    return row["url_key"], row["captured"], row["page_id"] is not None, row["page_id"] or 0, row["run"], row["offset"]


class LoserTree:
    """k-way merge of sorted iterators: each inner node keeps the loser of its
    match, so the next winner is found on one path from leaf to root."""

    def __init__(self, sources: list[Iterator], key: Callable):
        self.sources, self.key, k = sources, key, max(1, len(sources))
        self.size = 1 << (k - 1).bit_length()
        self.heads: list = [None] * self.size
        self.keys: list = [None] * self.size
        for i in range(len(sources)):
            self._pull(i)
        self.nodes = [0] * self.size
        winners = [*([0] * self.size), *range(self.size)]
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            win, lose = (a, b) if self._before(a, b) else (b, a)
            winners[node], self.nodes[node] = win, lose
        self.nodes[0] = winners[1] if self.size > 1 else 0

    def _pull(self, i: int) -> None:
        row = next(self.sources[i], None)
        self.heads[i], self.keys[i] = row, None if row is None else self.key(row)

    def _before(self, a: int, b: int) -> bool:
        """Exhausted sources lose; equal keys go by source number."""
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[a] is not None
        return (self.keys[a], a) < (self.keys[b], b)

    def __iter__(self) -> Iterator:
        while self.heads[win := self.nodes[0]] is not None:
            yield self.heads[win]
            self._pull(win)
            node = (win + self.size) // 2
            while node:
                if self._before(self.nodes[node], win):
                    win, self.nodes[node] = self.nodes[node], win
                node //= 2
            self.nodes[0] = win


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by run and place in it; each run's piece is one source."""
    pieces: dict[int, list[pa.RecordBatch]] = {}
    for batch in batches:
        run = batch.column("run").to_pylist()
        edges = [0, *(i for i in range(1, len(run)) if run[i] != run[i - 1]), len(run)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                pieces.setdefault(run[a], []).append(batch.slice(a, b - a))

    def source(parts: list[pa.RecordBatch]) -> Iterator[dict]:
        for part in parts:
            for a in range(0, part.num_rows, 256):
                yield from part.slice(a, 256).to_pylist()

    out = []
    for row in LoserTree([source(pieces[k]) for k in sorted(pieces)], _order):
        out.append(row)
        if len(out) == ROWS:
            yield pa.RecordBatch.from_pylist(out, SCHEMA)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, SCHEMA)


def capture_history(archives: DataFrame) -> DataFrame:
    """Every record of the archives in global order of URL key and timestamp."""
    files = max(1, archives.count())
    runs = archives.repartition(files, "run", "file").mapInArrow(_index, CAPTURE)
    path = scratch_path(archives.sparkSession, "capture-runs")
    runs.write.option("compression", "zstd").parquet(path)
    runs = archives.sparkSession.read.schema(CAPTURE).parquet(path)
    keys = ["url_key", "captured", F.col("page_id").asc_nulls_first(), "run", "offset"]
    return runs.repartitionByRange(*keys).sortWithinPartitions("run", *keys).mapInArrow(_merge, CAPTURE)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return capture_history(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
