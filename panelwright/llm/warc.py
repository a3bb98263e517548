"""WARC archives of captured pages and their merged capture index.

Each task writes one archive of gzip members, a record per page: a response
with the payload, or a revisit that names the response holding an equal
payload. A task's index entries leave it as a locally sorted run; runs are
dealt out by ranges of (URL key, timestamp), and each range merges its runs
k-way with a loser tree, so the index is globally ordered: the capture history
of a URL is consecutive. Ranges are cut by sampled bounds over the whole
key, so a URL with a third of all captures spans several ranges.

Of pages with equal payloads of at least ``least`` bytes the one with the
largest ``page_id`` is the response. Rows: null html is an empty payload; a
null URL is an empty one; a null ``page_id`` is a capture like any other but
never named by a revisit (a group of null ids is all responses); rows that
repeat the largest ``page_id`` are responses all. An empty table gives no
archive. Payloads of any length are written whole.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, columns, commit, runs, shared_path, small_side, store, tmp_name, written

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "url_key string, captured string, page_id long, archive string, offset long, length long, run int"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def url_key(url: str | None) -> str:
    """Sort-friendly form: host labels reversed, port, path and query."""
    try:
        u = urlsplit((url or "").strip().lower())
        host = ",".join(reversed((u.hostname or "").split(".")))
        port = f":{u.port}" if u.port and u.port not in (80, 443) else ""
    except ValueError:
        return (url or "").strip().lower()
    host = host[:-4] if host.endswith(",www") else host
    return f"{host}{port}){u.path or '/'}{'?' + u.query if u.query else ''}"


def capture_time(page_id: int | None) -> str:
    """The pages carry no time: a second per id from a fixed instant."""
    return (datetime(2020, 1, 1, tzinfo=timezone.utc)
            + timedelta(seconds=(page_id or 0) % 1_000_000_000)).strftime("%Y-%m-%dT%H:%M:%SZ")


def record(page_id, url, payload: bytes, digest: str, refers_to, refers_url) -> bytes:
    """A WARC 1.1 record as one gzip member."""
    when, b32 = capture_time(page_id), base64.b32encode(bytes.fromhex(digest)).decode()
    target = "".join(c for c in (url or "") if c not in "\r\n")
    ident = hashlib.md5(f"{page_id}|{target}|{digest}".encode("utf-8", "surrogatepass")).hexdigest()
    head = [f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:uuid:{ident[:8]}-{ident[8:12]}-{ident[12:16]}-{ident[16:20]}-{ident[20:]}>",
            f"WARC-Date: {when}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{b32}",
            f"WARC-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To-Page-ID: {refers_to}", f"WARC-Refers-To-Date: {capture_time(refers_to)}"]
        if refers_url:
            head.append("WARC-Refers-To-Target-URI: " + "".join(c for c in refers_url if c not in "\r\n"))
    body = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    body += f"Content-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        body += payload
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"
    return gzip.compress(raw, compresslevel=1, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of a record; a revisit's payload is empty."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


class LoserTree:
    """K-way merge of sorted iterators: an inner node holds the loser of its
    match, so the next smallest costs one comparison per level."""

    def __init__(self, sources: list[Iterator]):
        self.sources = [iter(s) for s in sources]      # of (key, value)
        self.k = len(self.sources)
        self.heads = [next(s, None) for s in self.sources]
        self.losers = [-1] * max(1, self.k)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return x is not None or (y is None and a < b)
        return (x[0], a) < (y[0], b)

    def __iter__(self):
        if not self.k:
            return
        tree = [-1] * self.k + list(range(self.k))     # winners, for the first round only
        for node in range(self.k - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node], self.losers[node] = (a, b) if self._beats(a, b) else (b, a)
        win = tree[1] if self.k > 1 else 0
        while (head := self.heads[win]) is not None:
            yield head
            self.heads[win] = next(self.sources[win], None)
            node = (win + self.k) // 2
            while node > 0:
                if self._beats(self.losers[node], win):
                    self.losers[node], win = win, self.losers[node]
                node //= 2


def _write_archives(path: str):
    def write(batches):
        files, root = store(path)
        task = TaskContext.get().partitionId()
        name = f"capture-{task:06d}.warc.gz"
        tmp = tmp_name(f"{root}/{name}")
        out, offset, entries = None, 0, []
        for b in columns(batches):
            if out is None:
                out = files.open_output_stream(tmp)
            for page, url, html, digest, ref, ref_url in zip(*(b[c].to_pylist() for c in ("page_id", "url", "html", "digest", "ref", "ref_url"))):
                data = record(page, url, (html or "").encode("utf-8", "surrogatepass"), digest, ref, ref_url)
                out.write(data)
                entries.append((url_key(url), capture_time(page), page, name, offset, len(data), task))
                offset += len(data)
        if out is not None:
            out.close()
            commit(files, tmp, f"{root}/{name}")
            # an entry is some 200 bytes; a task's pages are one input split
            entries.sort(key=_order)
            for lo in range(0, len(entries), 5000):
                yield _entries(entries[lo:lo + 5000])
    return write


def _order(e: tuple):
    return e[0], e[1], (e[2] is not None, e[2] or 0), e[3], e[4]


def _entries(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
    names = ["url_key", "captured", "page_id", "archive", "offset", "length", "run"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _rows(run: pa.Table, step: int = 5000):
    """Entries of a run, a few thousand at a time as Python rows."""
    for lo in range(0, run.num_rows, step):
        part = run.slice(lo, step)
        yield from zip(*(part[c].to_pylist() for c in ("url_key", "captured", "page_id", "archive", "offset", "length", "run")))


def _merge(batches):
    """A range's runs, one after the other in the input, merged into order.
    ``range`` and ``place`` number the ranges and the entries of each."""
    at, place = TaskContext.get().partitionId(), 0
    # the runs stay in Arrow form: only the heads of each are Python rows
    keyed = [((_order(e), e) for e in _rows(t)) for _, t in runs(batches, "run")]
    rows = []

    def out():
        b = _entries(rows)
        n = len(rows)
        return pa.RecordBatch.from_arrays([*b.columns, pa.array([at] * n, pa.int32()), pa.array(range(place, place + n), pa.int64())],
                                          names=[*b.schema.names, "range", "place"])
    for _, e in LoserTree(keyed):
        rows.append(e)
        if len(rows) == 5000:
            yield out()
            place, rows = place + len(rows), []
    if rows:
        yield out()


def _read(path: str, with_payload: bool):
    def read(batches):
        files, root = store(path)
        name = f = None
        for b in columns(batches):
            out = []
            for archive, offset, length in zip(b["archive"].to_pylist(), b["offset"].to_pylist(), b["length"].to_pylist()):
                if archive != name:
                    if f:
                        f.close()
                    name, f = archive, files.open_input_file(f"{root}/{archive}")
                f.seek(offset)
                h, payload = parse(f.read(length))
                kind, page, ref = h["WARC-Type"], h.get("WARC-Page-ID"), h.get("WARC-Refers-To-Page-ID")
                if kind == "response":
                    n, digest = len(payload), hashlib.sha1(payload).hexdigest()
                else:
                    n, payload = int(h["WARC-Payload-Length"]), None
                    digest = base64.b32decode(h["WARC-Payload-Digest"][5:]).hex()
                out.append((None if page is None else int(page), n, digest, kind, None if ref is None else int(ref),
                            h["WARC-Target-URI"], payload if with_payload else None))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)],
                                             names=[x.split()[0] for x in RECORDS.split(", ")])
        if f:
            f.close()
    return read


@dataclass
class Archives:
    spark: SparkSession
    path: str
    index: DataFrame     # (range, place) is the order by (url_key, captured, page_id)

    def ordered(self) -> DataFrame:
        """The index in its global order: ranges are dealt in order and each
        is sorted by its places, so no key is compared again."""
        return self.index.orderBy("range", "place")

    def read(self, with_payload: bool = True) -> DataFrame:
        """Every record through the index, archives read in file order."""
        return (self.index.select("archive", "offset", "length").repartitionByRange("archive", "offset")
                .sortWithinPartitions("archive", "offset").mapInArrow(_read(self.path, with_payload), RECORDS))


def write_archives(pages: DataFrame, least: int = 1000) -> Archives:
    spark = pages.sparkSession
    bounded_batches(spark)
    path = shared_path(spark, "warc")
    files, root = store(path)
    files.create_dir(root)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    src = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"))
    src = src.withColumn("digest", F.sha1(F.col("html").cast("binary"))).withColumn("full", F.sha2("html", 256))
    # the response of each repeated payload: narrow rows, combined map-side
    lead = (src.where(F.octet_length("html") >= least).groupBy("full")
            .agg(F.max(F.struct("page_id", "url")).alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
            .select("full", F.col("lead.page_id").alias("lead"), F.col("lead.url").alias("lead_url")))
    lead = written(lead, "payload-leads")
    rows = src.join(small_side(lead, lead.count()), "full", "left")
    is_lead = F.col("lead").isNull() | F.coalesce(F.col("page_id") == F.col("lead"), F.lit(False))
    rows = rows.select("page_id", "url", "html", "digest", F.when(~is_lead, F.col("lead")).alias("ref"),
                       F.when(~is_lead, F.col("lead_url")).alias("ref_url"))
    found = written(rows.mapInArrow(_write_archives(path), INDEX), "capture-runs")
    order = ["url_key", "captured", F.col("page_id").asc_nulls_first(), "archive", "offset"]
    merged = (found.repartitionByRange(*order).sortWithinPartitions("run", *order)
              .mapInArrow(_merge, INDEX + ", range int, place long"))
    return Archives(spark, path, written(merged, "capture-index"))
