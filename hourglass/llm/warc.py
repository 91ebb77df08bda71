"""Operator 10: WARC archives and a globally ordered capture index.

*Write* (DataFrame functions): equal payloads are found by SHA-1; the record with the largest
key stays a ``response`` and the others become ``revisit`` records without payload.  Each task
sorts its records by URL key and time and writes them as gzip archives with Spark's text writer
(records are UTF-8 and end with CR LF CR LF, which is the writer's line separator), so any file
system that Spark writes to will do and a lost task is simply run again.

*Read*: archives are parsed by ``Content-Length``, streaming through the compressed bytes of one
archive at a time; payload digests are verified.  Every archive yields one locally sorted run of
index entries.

*Merge*: index entries (no payloads) are dealt out by ranges of (URL key, time, key), and each range
merges its slices of the runs with a loser tree; the ranges in order are the whole, globally
ordered capture history.  The key takes part in the range, so a URL with a third of all captures is
spread over many ranges.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint, shared_dir, utf8
from hourglass.llm.url_filter import url_host

CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Payload bytes that one archive holds on average.
ARCHIVE_BYTES = 16 << 20
#: Capture time of rows without one: this second plus the key.
EPOCH = 1_577_836_800
INDEX = ("url_key string, ts string, page_id long, record_type string, refers_to long, "
         "payload_bytes long, payload_digest string, url string, archive string, offset long, length long, seq long")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of binary data (160 bits: 32 letters, no padding)."""
    digest = F.sha1(payload)
    letters = []
    for group in range(8):  # 5 hex digits are 4 letters
        n = F.conv(F.substring(digest, 5 * group + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(BASE32), F.shiftright(n, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def url_key(url: Column) -> Column:
    """Sort-friendly URL: host labels reversed, then the rest (``com,example,www)/path?x``)."""
    at = F.instr(url, "://")
    rest = F.regexp_extract(F.substring(url, at + F.lit(3), F.length(url)), "^[^/?#]*([^#]*)", 1)
    host = F.array_join(F.reverse(F.split(url_host(url), "\\.", -1)), ",")
    return F.when(url.isNull() | (at == 0), F.coalesce(url, F.lit(""))).otherwise(F.concat(host, F.lit(")"), rest))


def mark_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                  ts: Column | None = None) -> DataFrame:
    """Captures with digest, record type and the key they refer to.

    Of rows with equal payload the one with the largest key is ``response``; rows that repeat that
    key are too.  Null keys sort below all others; a null payload is empty; empty payloads count as
    equal.
    """
    when = ts if ts is not None else F.timestamp_seconds(F.lit(EPOCH) + F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(10**9)))
    p = pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"),
                     F.coalesce(F.col(payload), F.lit("")).alias("_html"),
                     F.date_format(when, "yyyyMMddHHmmss").alias("ts"))
    p = p.withColumn("_digest", base32_sha1(utf8(F.col("_html"))))
    keeper = p.groupBy("_digest").agg(F.max("page_id").alias("_keep"))
    p = p.join(keeper, "_digest")
    same = F.col("page_id").eqNullSafe(F.col("_keep"))
    return p.select("page_id", "url", "ts", "_html", "_digest",
                    F.when(same, F.lit("response")).otherwise(F.lit("revisit")).alias("record_type"),
                    F.when(~same, F.col("_keep")).alias("refers_to"))


def _record() -> Column:
    """Text of a record without the closing CR LF CR LF."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    optional = lambda c: F.coalesce(c, F.lit(""))
    urn = lambda c: F.concat(F.lit("<urn:page:"), optional(c.cast("string")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    # control characters and blanks would end a header line or value early
    clean = F.regexp_replace("url", r"[\x00-\x20\x7F]", "_")
    t = F.col("ts")
    date = F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 5, 2), F.lit("-"), F.substring(t, 7, 2),
                    F.lit("T"), F.substring(t, 9, 2), F.lit(":"), F.substring(t, 11, 2), F.lit(":"),
                    F.substring(t, 13, 2), F.lit("Z"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.octet_length("_html").cast("string"), F.lit(CRLF + CRLF))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.octet_length("_html"))
    return F.concat(
        F.lit(f"WARC/1.0{CRLF}"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", urn(F.col("page_id"))), line("WARC-Date", date),
        optional(line("WARC-Target-URI", clean)), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "_digest")),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("refers_to"))),
                                 line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", size.cast("string")), F.lit(CRLF), http,
        F.when(revisit, F.lit("")).otherwise(F.col("_html")))


def write_archives(captures: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES,
                   mean_bytes: float = 4096.0, compression: str = "gzip") -> None:
    """One locally sorted run of records per archive, ``archive_bytes`` of payload on average."""
    (captures.withColumn("_url_key", url_key(F.col("url")))
             .sortWithinPartitions("_url_key", "ts", "page_id")
             .select(_record().alias("value"))
             .write.option("lineSep", CRLF + CRLF).option("compression", compression)
             .option("maxRecordsPerFile", max(1, int(archive_bytes // max(mean_bytes, 1.0)))).text(path))


def _chunks(data: bytes) -> Iterator[bytes]:
    """Plain bytes of an archive, member by member where it is compressed."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        member = zlib.decompressobj(31)
        while not member.eof and data:
            out = member.decompress(data, 1 << 20)
            data = member.unconsumed_tail or member.unused_data
            if out:
                yield out


def read_records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """``(offset, length, headers, block)`` of every record of one archive."""
    buffer, base, chunks = bytearray(), 0, _chunks(data)

    def fill(size: int) -> bool:
        while len(buffer) < size:
            chunk = next(chunks, None)
            if chunk is None:
                return False
            buffer.extend(chunk)
        return True

    while fill(1):
        seen = 0
        while (end := buffer.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(buffer) - 3)
            if not fill(len(buffer) + 1):
                raise ValueError(f"archive ends within a record header at {base}")
        lines = buffer[:end].decode("utf-8").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {base}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        start, size = end + 4, int(headers["content-length"])
        if not fill(start + size + 4) or buffer[start + size:start + size + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {base} is cut short")
        yield base, start + size + 4, headers, bytes(buffer[start:start + size])
        del buffer[:start + size + 4]
        base += start + size + 4


def _entry(block: bytes, headers: dict[str, str]) -> tuple[int, str]:
    """Bytes and digest of the full payload; a response's payload must have its digest."""
    end = block.index(b"\r\n\r\n") + 4
    http = {k.lower(): v for k, _, v in (x.partition(": ") for x in block[:end].decode("latin-1").split(CRLF))}
    digest, size = headers["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
    if headers["warc-type"] == "response":
        raw = int.from_bytes(hashlib.sha1(block[end:]).digest(), "big")
        found = "".join(BASE32[raw >> s & 31] for s in range(155, -1, -5))
        if found != digest or len(block) - end != size:
            raise ValueError(f"payload of {headers['warc-record-id']} does not match its digest")
    return size, digest


def _key_of(url: str | None) -> str:
    """The same rule as :func:`url_key`."""
    if url is None or "://" not in url:
        return url or ""
    rest = url.split("://", 1)[1]
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    return ",".join(reversed(host.split("."))) + ")" + rest[cut:].split("#", 1)[0]


def _urn(value: str | None) -> int | None:
    return int(x) if value and (x := value.removeprefix("<urn:page:").removesuffix(">")) else None


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split(" ")[0] for c in INDEX.split(", ")]
    for frame in frames:
        for path, data in zip(frame["path"], frame["content"], strict=True):
            rows = []
            for seq, (offset, length, headers, block) in enumerate(read_records(bytes(data))):
                size, digest = _entry(block, headers)
                url = headers.get("warc-target-uri")
                stamp = "".join(c for c in headers["warc-date"] if c.isdigit())
                rows.append((_key_of(url), stamp, _urn(headers["warc-record-id"]), headers["warc-type"],
                             _urn(headers.get("warc-refers-to")), size, digest, url, path, offset, length, seq))
            out = pd.DataFrame(rows, columns=names)
            for c in ("page_id", "refers_to"):
                out[c] = out[c].astype("Int64")
            yield out


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of every record, one locally sorted run per archive."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInPandas(_parse, INDEX)


def loser_tree_merge(runs: Sequence[Sequence[tuple]]) -> Iterator[tuple]:
    """Merge sorted runs: inner nodes keep the loser of their match, the winner moves up.

    Each next item replays one path, so it costs one comparison a level.  Ties go to the earlier run.
    """
    k = len(runs)
    if not k:
        return
    heads = [0] * k
    done = (1,)
    key = lambda r: ((0, runs[r][heads[r]], r) if heads[r] < len(runs[r]) else done + ((), r))
    keys = [key(r) for r in range(k)]
    tree: list[int] = [-1] * k  # tree[0] is the overall winner

    def build(node: int) -> int:
        if node >= k:
            return node - k
        a, b = build(2 * node), build(2 * node + 1)
        win, lose = (a, b) if keys[a] <= keys[b] else (b, a)
        tree[node] = lose
        return win

    winner = build(1) if k > 1 else 0
    while keys[winner][0] == 0:
        yield runs[winner][heads[winner]]
        heads[winner] += 1
        keys[winner] = key(winner)
        node = (winner + k) // 2
        while node >= 1 and k > 1:
            if keys[tree[node]] < keys[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Slices of the runs arrive one after the other, each in its order."""
    parts = list(frames)
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    missing = rows["page_id"].isna()
    # null keys sort first
    ids = rows["page_id"].astype("Int64").fillna(0).tolist()
    order = list(zip(rows["url_key"], rows["ts"], (~missing).tolist(), ids, range(len(rows)), strict=True))
    runs = [[order[i] for i in at] for at in rows.groupby("archive", sort=False).indices.values()]
    yield rows.iloc[[x[-1] for x in loser_tree_merge(runs)]]


def merge_index(index: DataFrame) -> DataFrame:
    """The capture history in global order of (URL key, time, key): partition by partition.

    A task holds the index entries of one range, never payloads."""
    ranged = index.repartitionByRange("url_key", "ts", "page_id").sortWithinPartitions("archive", "seq")
    return ranged.mapInPandas(_merge, INDEX)


def archive_pages(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url",
                  payload: str = "html", ts: Column | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one WARC record per row below ``path``, read the archives back and merge their index.

    Returns the ordered index (columns of ``INDEX``).  An empty table writes nothing and has an empty
    index; a null URL has no target URI; repeated rows are written as often as they occur.  Extra
    columns are not read.  ``path`` defaults to a new folder in the shared checkpoint folder; the
    archives stay there.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    mean = pages.agg(F.avg(F.coalesce(F.octet_length(payload), F.lit(0)) + F.lit(400))).first()[0]
    write_archives(mark_revisits(pages, key, url, payload, ts), path, archive_bytes, mean or 1.0)
    # range sampling and the merge both read the index: parse the archives once
    return merge_index(checkpoint(read_index(spark, path)))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


_GROUP = " || ".join(
    f"substr('{BASE32}', ((('0x' || substr(h, {5 * g + 1}, 5))::INTEGER >> {s}) & 31) + 1, 1)"
    for g in range(8) for s in (15, 10, 5, 0))
ORACLE_OP10 = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT h, max(page_id) AS keep FROM p GROUP BY h)
SELECT page_id, n::BIGINT AS payload_bytes, {_GROUP.replace('(h,', '(p.h,')} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keep THEN keep END AS refers_to
FROM p JOIN k ON p.h = k.h
"""
