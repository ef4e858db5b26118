"""Web archives: WARC files, their index runs, and the merged index of capture histories."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portacube.llm import remote
from portacube.llm.scratch import Scratch
from portacube.llm.workers import ship_code

MIN_BYTES = 0  # payloads from this size on are stored once
FIRST_CAPTURE = 1_700_000_000  # seconds; a page without a capture time gets this plus its id
RUN_ROWS = 100_000  # index rows sorted together before they form a run
BLOCK_ROWS = 1024  # rows of a run held at once while runs are merged
MERGED_ROWS = 10_000  # merged rows passed on at once
LEVEL = 4
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
INDEX = "urlkey string, ts string, page_id long, run string, seq long, file string, offset long, length long"
RECORD = "file string, offset long, page_id long, type string, refers long, bytes long, digest string"


def url_key(url: Column) -> Column:
    """Sort key of a url: host labels reversed, then path and query, lower-cased, without scheme, www and fragment."""
    rest = F.lower(F.regexp_replace(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?:.*?://)?([^#]*)", 1),
                                    r"^www[0-9]*\.", ""))
    host = F.regexp_extract(rest, r"^[^/?]*", 0)
    return F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"),
                    F.substring(rest, F.length(host) + 1, F.lit(1 << 30)))


def _name(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _number(name: str | None):
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _record(page_id, url, ts, payload: bytes, first) -> bytes:
    """One record; a revisit of page ``first`` carries no payload."""
    revisit = first is not None and first != page_id
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    block = HTTP + f"Content-Length: {len(payload)}\r\n\r\n".encode() + (b"" if revisit else payload)
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}",
            f"WARC-Date: {ts}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        head.append(f"WARC-Target-URI: {clean}")
    if revisit:
        head += [f"WARC-Refers-To: {_name(first)}", f"WARC-Profile: {REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _write(folder: str):
    """Write the rows of a partition to one archive, a gzip member per record, and yield its sorted index runs."""
    def run(batches):
        out, rows, runs = None, [], 0

        def sorted_run():
            rows.sort(key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
            name = f"{out.name}-{runs}"
            cols = list(zip(*[(k, t, p, name, i, out.name, at, n) for i, (k, t, p, at, n) in enumerate(rows)]))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              ["urlkey", "ts", "page_id", "run", "seq", "file", "offset", "length"])
        for batch in batches:
            for page_id, url, html, ts, key, first in zip(*batch.columns):
                out = out or remote.NewFile(folder, ".warc.gz")
                html = html.as_py()
                pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                data = pack.compress(_record(page_id.as_py(), url.as_py(), ts.as_py(),
                                             (html or "").encode("utf-8", "surrogatepass"), first.as_py()))
                data += pack.flush()
                rows.append((key.as_py(), ts.as_py(), page_id.as_py(), out.write(data), len(data)))
                if len(rows) >= RUN_ROWS:
                    yield sorted_run()
                    rows, runs = [], runs + 1
        if out:
            out.close()
        if rows:
            yield sorted_run()
    return run


def records(stream):
    """(offset, header fields, block) of every record of an archive, read in pieces."""
    unpack, plain, at, start, data = zlib.decompressobj(31), [], 0, 0, stream.read(1 << 20)
    while data:
        plain.append(unpack.decompress(data))
        at += len(data)
        if unpack.eof:
            at -= len(unpack.unused_data)
            whole = b"".join(plain)
            head, _, rest = whole.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
                raise ValueError(f"damaged record at {start}")
            yield start, fields, rest[:size]
            data, plain, start = unpack.unused_data, [], at
            unpack = zlib.decompressobj(31)
            if data:
                continue
        data = stream.read(1 << 20)
    if plain:
        raise ValueError("archive ends inside a record")


def _read(folder: str):
    """Rows of every record of the given archives, with size and digest measured on the payload read."""
    def run(batches):
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows = []
                with remote.open_file(folder, name) as stream:
                    for at, fields, block in records(stream):
                        payload = block.partition(b"\r\n\r\n")[2]
                        kind, said = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if kind == "response" and digest != said:
                            raise ValueError(f"{name} at {at}: payload digest differs")
                        rows.append((name, at, _number(fields["WARC-Record-ID"]), kind,
                                     _number(fields.get("WARC-Refers-To")),
                                     len(payload) if kind == "response" else None, said))
                        if len(rows) >= 10_000:
                            yield _rows(rows)
                            rows = []
                if rows:
                    yield _rows(rows)
    return run


def _rows(rows):
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["file", "offset", "page_id", "type", "refers", "bytes", "digest"])


def merge_runs(runs: list):
    """(run, place) of all entries of sorted runs in order, by a loser tree; ties by run.

    A run is anything that yields its keys in order; only its next key is held.
    """
    k, feeds, places = len(runs), [iter(r) for r in runs], [0] * len(runs)
    heads = [next(f, None) for f in feeds]

    def beats(a, b):
        if heads[b] is None:
            return heads[a] is not None or a < b
        return heads[a] is not None and (heads[a], a) < (heads[b], b)
    won, lost = [0] * k + list(range(k)), [0] * max(k, 1)
    for node in range(k - 1, 0, -1):
        a, b = won[2 * node], won[2 * node + 1]
        won[node], lost[node] = (a, b) if beats(a, b) else (b, a)
    top = won[1] if k > 1 else 0
    while k and heads[top] is not None:
        yield top, places[top]
        places[top] += 1
        heads[top] = next(feeds[top], None)
        node = (k + top) // 2
        while node:
            if beats(lost[node], top):
                lost[node], top = top, lost[node]
            node //= 2


class _Run:
    """A stored run, read block by block; yields its keys."""

    def __init__(self):
        self.blocks: list[tuple[int, int]] = []  # place in the file, bytes
        self.file = self.batch = None
        self.first = 0  # place of the batch's first row

    def __iter__(self):
        for i, (at, size) in enumerate(self.blocks):
            self.file.seek(at)
            self.batch, self.first = pa.ipc.open_stream(self.file.read(size)).read_next_batch(), i * BLOCK_ROWS
            urlkey, ts, page = (self.batch.column(c).to_pylist() for c in ("urlkey", "ts", "page_id"))
            yield from zip(urlkey, ts, [(x is not None, x or 0) for x in page])


def _store_runs(batches, file) -> list[_Run]:
    """Write the rows, which come run by run, in blocks of BLOCK_ROWS rows."""
    runs, name, held, rows = [], None, [], 0

    def flush():
        table = pa.Table.from_batches(held).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        data = sink.getvalue()
        runs[-1].blocks.append((file.write(data), data.size))
    for batch in batches:
        names = batch.column("run").to_pylist()
        at = 0
        while at < len(names):
            if names[at] != name:
                if held:
                    flush()
                name, held, rows = names[at], [], 0
                runs.append(_Run())
            to = at
            while to < len(names) and names[to] == name and rows + to - at < BLOCK_ROWS:
                to += 1
            held.append(batch.slice(at, to - at))
            rows, at = rows + to - at, to
            if rows == BLOCK_ROWS:
                flush()
                held, rows = [], 0
    if held:
        flush()
    return runs


def _merge(folder: str):
    """Merge the sorted runs of one key range, which come run by run; adds the place in the range.

    The parts of the runs are stored in the shared folder and read back side
    by side, one block of each at a time.
    """
    def run(batches):
        file = remote.NewFile(folder, ".runs")
        runs = _store_runs(batches, file)
        file.close()
        with remote.open_file(folder, file.name) as stored:
            for r in runs:
                r.file = stored
            out, place = [], 0
            for i, at in merge_runs(runs):
                out.append((runs[i].batch, at - runs[i].first))
                if len(out) == MERGED_ROWS:
                    yield _merged(out, place)
                    out, place = [], place + len(out)
            if out:
                yield _merged(out, place)
    return run


def _merged(rows: list, place: int) -> pa.RecordBatch:
    number: dict[int, int] = {}
    batches, bases, total, at = [], [], 0, []
    for batch, i in rows:
        if id(batch) not in number:
            number[id(batch)] = len(batches)
            batches.append(batch)
            bases.append(total)
            total += batch.num_rows
        at.append(bases[number[id(batch)]] + i)
    table = pa.Table.from_batches(batches).take(pa.array(at, pa.int64())).append_column(
        "place", pa.array(range(place, place + len(rows)), pa.int64()))
    return table.combine_chunks().to_batches()[0]


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, scratch: Scratch,
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) and return the staged index runs.

    Of rows with equal payloads (SHA-1 and size) of ``min_bytes`` or more that
    of the least page_id is stored, the others are revisits of it.  A null
    html is an empty payload; a null page_id is always a response; a null url
    has no target.  Rows of one page_id and payload are all responses.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", "html").withColumns({"sha": F.sha1(payload), "size": F.length(payload)})
    firsts = (rows.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull())
              .groupBy(F.col("sha").alias("s"), F.col("size").alias("n"))
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("c")).where("c > 1"))
    seconds = F.lit(FIRST_CAPTURE) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(1_000_000_000))
    ts = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    decided = rows.join(firsts, (F.col("sha") == F.col("s")) & (F.col("size") == F.col("n")), "left").select(
        "page_id", "url", "html", ts.alias("ts"), url_key(F.col("url")).alias("key"),
        F.when(F.col("page_id").isNotNull(), F.col("first")).alias("first"))
    return scratch.stage(decided.mapInArrow(_write(folder), INDEX), "runs")


def merge_index(spark: SparkSession, runs: DataFrame, scratch: Scratch) -> DataFrame:
    """All index rows in global order of (urlkey, ts, page_id), numbered by ``position``.

    The key space is cut into ranges of about equal rows (a url with many
    captures is cut by time), and each range merges the parts of all runs
    that fall into it, as streams: a task holds a block of every run.
    """
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = (runs.repartitionByRange(parts, "urlkey", "ts", "page_id", "run", "seq")
              .sortWithinPartitions("run", "seq"))
    merged = scratch.stage(ranges.mapInArrow(_merge(scratch.folder("parts")), INDEX + ", place long")
                           .withColumn("range", F.spark_partition_id()), "merged")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range
    bases = merged.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select(
        "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return merged.join(F.broadcast(bases), "range").withColumn("position", F.col("base") + F.col("place")).drop(
        "base", "place")


def histories(merged: DataFrame) -> DataFrame:
    """Captures, first and last time and stretch of index positions of every url key."""
    return merged.groupBy("urlkey").agg(F.count(F.lit(1)).alias("captures"), F.min("ts").alias("first_ts"),
                                        F.max("ts").alias("last_ts"), F.min("position").alias("from_position"))


def read_archives(spark: SparkSession, runs: DataFrame, folder: str, scratch: Scratch) -> DataFrame:
    """Read every archive named by the runs back; a revisit gets size and digest from the response it refers to."""
    files = runs.select("file").distinct()
    read = scratch.stage(files.repartitionByRange(max(1, files.count()), "file").mapInArrow(_read(folder), RECORD), "read")
    stored = (read.where("type = 'response'").groupBy(F.col("page_id").alias("of"), F.col("digest").alias("d"))
              .agg(F.max("bytes").alias("stored")))
    again = (read.where("type = 'revisit'")
             .join(stored, (F.col("refers") == F.col("of")) & (F.col("digest") == F.col("d")))
             .withColumn("bytes", F.col("stored")).select(*read.columns))
    return read.where("type = 'response'").union(again)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``pages`` written to WARC files, indexed, merged and read back, with their place in the merged index and
    the captures of their url key."""
    ship_code(spark)
    scratch = Scratch(spark, "warc")
    folder = scratch.folder("archives")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    runs = write_archives(spark, pages, folder, scratch)
    merged = merge_index(spark, runs, scratch)
    # staged, so that the join deals both sides and can split a url with very many captures
    past = scratch.stage(histories(merged).select(F.col("urlkey").alias("k"), "captures", "first_ts", "last_ts"), "past")
    merged = merged.join(past, F.col("urlkey") == F.col("k"))
    read = read_archives(spark, runs, folder, scratch).withColumnsRenamed({"file": "f", "offset": "o", "page_id": "p"})
    return merged.join(read, (F.col("file") == F.col("f")) & (F.col("offset") == F.col("o"))).select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers").alias("refers_to"), "urlkey", "ts", "position",
        "captures", "first_ts", "last_ts")


WARC_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         lower(regexp_replace(regexp_extract(coalesce(url, ''), '(?s)^(?:.*?://)?([^#]*)', 1), '^www[0-9]*\.', '')) AS rest,
         strftime(make_timestamp((1700000000 + ((coalesce(page_id, 0) % 1000000000) + 1000000000) % 1000000000) * 1000000),
                  '%Y-%m-%dT%H:%M:%SZ') AS ts
  FROM pages),
k AS (
  SELECT *, array_to_string(list_reverse(string_split(regexp_extract(rest, '^[^/?]*'), '.')), ',') || ')'
            || substr(rest, len(regexp_extract(rest, '^[^/?]*')) + 1) AS urlkey
  FROM p),
q AS (SELECT *, strlen(html) AS n, sha1(html) AS h, MIN(page_id) OVER (PARTITION BY html) AS f FROM k)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5))::BIGINT) >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31)::INT, 1)), '')
         AS payload_digest,
       CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> f THEN f END AS refers_to, urlkey, ts,
       row_number() OVER (ORDER BY urlkey, ts, page_id) - 1 AS position,
       COUNT(*) OVER (PARTITION BY urlkey) AS captures, MIN(ts) OVER (PARTITION BY urlkey) AS first_ts,
       MAX(ts) OVER (PARTITION BY urlkey) AS last_ts
FROM q
"""
