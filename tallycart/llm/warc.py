"""Web archives with a merged capture index.

Pages are written as gzipped WARC records, one member each. Of records with equal
payloads of at least ``min_bytes`` the one with the smallest ``page_id`` is a response; the
others are revisits that refer to it and hold no payload.

The index is an external merge sort. Each writing task keeps the entries of its archive
in memory up to ``RUN`` of them, sorts these by URL key and time and writes them as a run,
with every ``SPARSE``-th key noted. Runs beyond ``FAN_IN`` are first merged in groups. Then
the key range is cut at keys drawn from the noted ones, and a task for each range
merges its slices of the runs through a loser tree, reading them as streams. The
whole sort key (URL key, time, page) is cut, so the captures of one URL may span
ranges. The ranges, one after another, are the globally ordered capture histories.

Defined results. A row without ``page_id`` can't be named and is left out. Null html is an
empty payload, a null url an empty one; control characters and spaces in a url are
percent-encoded. A null time counts as the epoch. Rows that repeat a ``page_id`` are separate
records; as a revisit refers to a smaller id, equal rows are all responses. An empty table
writes no archive. Other columns are not looked at.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycart.llm.batches import map_batches
from tallycart.llm.files import system, written
from tallycart.session import stage

RUN = 100_000  # entries of a run
SPARSE = 128  # a key is noted for every so many entries
FAN_IN = 128  # runs merged at once
RANGE = 20_000  # entries of a range, about
MAX_RANGES = 4_096
DRAWN = 64  # keys drawn for each range to cut at
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def plain_url(url: str | None) -> str:
    return quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")


def url_key(url: str) -> str:
    """Host labels from the right, then path and query: pages of a site sort together."""
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return url
    labels = ",".join(reversed(host.removeprefix("www.").split(".")))
    site = f"{labels}:{port}" if port else labels
    return f"{site}){parts.path or '/'}" + (f"?{parts.query}" if parts.query else "")


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int, url: str, time: str, payload: bytes, refers: int | None) -> bytes:
    block = b"" if refers is not None else HEAD % len(payload) + payload
    told = {
        "WARC-Type": "response" if refers is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{page}>",
        "WARC-Target-URI": url,
        "WARC-Date": time,
        "WARC-Payload-Digest": f"sha1:{digest32(payload)}",
        "X-Payload-Length": len(payload),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block),
    }
    if refers is not None:
        told["WARC-Refers-To"] = f"<urn:page:{refers}>"
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in told.items()) + "\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n", 6, mtime=0)


def members(chunks: Iterable[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of every gzip member of a stream."""
    offset = used = 0
    parser, parts = zlib.decompressobj(31), []
    for chunk in chunks:
        while chunk:
            parts.append(parser.decompress(chunk))
            rest = parser.unused_data
            used += len(chunk) - len(rest)
            chunk = rest
            if parser.eof:
                yield offset, used, b"".join(parts)
                offset, used = offset + used, 0
                parser, parts = zlib.decompressobj(31), []
    if used:
        raise ValueError("the archive ends within a record")


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record and its payload."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


# An index entry: the sort key (url key, time, page), then where the record is.
Entry = tuple[str, str, int, str, int, int]


def entry_line(e: Entry) -> bytes:
    return " ".join(map(str, e)).encode() + b"\n"


def read_entry(line: bytes) -> Entry:
    key, time, page, archive, offset, length = line.decode().split(" ")
    return key, time, int(page), archive, int(offset), int(length)


_RUNS = "path string, size long, n long, keys array<struct<key:string,time:string,page:long>>, offsets array<long>"


def _write_run(path: str, entries: Iterable[Entry], sparse: int) -> pa.RecordBatch:
    """Write sorted entries as a run; the row that describes it."""
    keys, offsets, size, n = [], [], 0, 0
    with written(path) as stream:
        for e in entries:
            if n % sparse == 0:
                keys.append({"key": e[0], "time": e[1], "page": e[2]})
                offsets.append(size)
            line = entry_line(e)
            stream.write(line)
            size, n = size + len(line), n + 1
    kind = pa.list_(pa.struct([("key", pa.string()), ("time", pa.string()), ("page", pa.int64())]))
    kinds = [pa.string(), pa.int64(), pa.int64(), kind, pa.list_(pa.int64())]
    values = [path, size, n, keys, offsets]
    names = ["path", "size", "n", "keys", "offsets"]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, most: int = RUN, sparse: int = SPARSE
) -> DataFrame:
    """Write the archives and their sorted runs of at most ``most`` entries; one row a run.
    ``pages``: page_id, url, html, captured_at (timestamp)."""
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
        F.date_format(
            F.coalesce("captured_at", F.timestamp_seconds(F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'"
        ).alias("time"),
    ).filter("page_id is not null")
    sums = own.filter(F.octet_length("payload") >= min_bytes).select("page_id", F.sha1("payload").alias("sum"))
    firsts = sums.groupBy("sum").agg(F.min("page_id").alias("refers_to"))
    revisits = sums.join(firsts, "sum").filter("page_id > refers_to")
    marked = own.withColumn("sum", F.sha1("payload")).join(revisits.distinct(), ["page_id", "sum"], "left")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"{folder}/part-{TaskContext.get().partitionId():05d}"
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        entries, runs, offset = [], 0, 0
        with written(f"{name}.warc.gz") as stream:
            while batch is not None:
                for page, url, payload, time, refers in zip(*(c.to_pylist() for c in batch.columns)):
                    data = record(page, url := plain_url(url), time, payload, refers)
                    stream.write(data)
                    entries.append((url_key(url), time, page, f"{name}.warc.gz", offset, len(data)))
                    offset += len(data)
                    if len(entries) >= most:
                        yield _write_run(f"{name}.{runs:04d}.cdx", sorted(entries), sparse)
                        entries, runs = [], runs + 1
                batch = next(batches, None)
        if entries:
            yield _write_run(f"{name}.{runs:04d}.cdx", sorted(entries), sparse)

    rows = marked.select("page_id", "url", "payload", "time", "refers_to")
    return stage(rows.transform(map_batches, fill, _RUNS), "runs")


class LoserTree:
    """The least of k sorted streams, found again in log k comparisons after each step."""

    def __init__(self, streams: list[Iterator[Entry]]):
        self.streams = streams
        self.heads = [next(s, None) for s in streams]
        k = len(streams)
        self.losers = [-1] * max(k, 1)
        for leaf in range(k):
            self._climb(leaf)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def _climb(self, leaf: int) -> None:
        """Play from a leaf to the root: losers stay in the nodes, the winner goes on."""
        winner, node = leaf, (leaf + len(self.streams)) // 2
        while node:
            held = self.losers[node]
            if held < 0:
                self.losers[node] = winner
                return
            if self._beats(held, winner):
                self.losers[node], winner = winner, held
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[Entry]:
        if not self.streams:
            return
        while (head := self.heads[top := self.losers[0]]) is not None:
            yield head
            self.heads[top] = next(self.streams[top], None)
            self._climb(top)


def _slice(path: str, start: int, end: int) -> Iterator[Entry]:
    """The entries of a run between two offsets, read in small pieces."""
    store, name = system(path)
    with store.open_input_file(name) as file:
        file.seek(start)
        rest, left = b"", end - start
        while left > 0:
            data = file.read(min(left, 1 << 16))
            left -= len(data)
            *whole, rest = (rest + data).split(b"\n")
            yield from map(read_entry, whole)


def _merged(finish: Callable[[int, Iterator[Entry]], Iterator[pa.RecordBatch]], cuts: list[tuple]):
    """(number, path, start, end), those of a number in succession, merged by number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r["number"], r["path"], r["start"], r["end"]) for b in batches for r in b.to_pylist())
        for number, parts in groupby(rows, key=lambda r: r[0]):
            lo = cuts[number - 1] if cuts and number else None
            hi = cuts[number] if number < len(cuts) else None
            tree = LoserTree([_slice(*part[1:]) for part in parts])
            inside = (e for e in tree if (lo is None or e[:3] >= lo) and (hi is None or e[:3] < hi))
            yield from finish(number, inside)

    return run


_CAPTURES = (
    "number int, place long, url_key string, captured_at string, page_id long, "
    "archive string, offset long, length long"
)


def merge_index(
    runs: DataFrame, folder: str, fan_in: int = FAN_IN, per_range: int = RANGE, sparse: int = SPARSE
) -> DataFrame:
    """The captures in global order of (number, place): by URL key, time and page."""
    n_runs, total = runs.agg(F.count("*"), F.sum("n")).first()
    level = 0
    while n_runs > fan_in:
        # Random groups of half the fan-in on average, each merged into one longer run.
        groups, level = -(-2 * n_runs // fan_in), level + 1

        def longer(number: int, entries: Iterator[Entry], level: int = level) -> Iterator[pa.RecordBatch]:
            yield _write_run(f"{folder}/merged-{level}-{number:06d}.cdx", entries, sparse)

        number = F.pmod(F.xxhash64("path"), F.lit(groups)).cast("int").alias("number")
        parts = runs.select(number, "path", F.lit(0).cast("long").alias("start"), F.col("size").alias("end"))
        merged = parts.repartition("number").sortWithinPartitions("number", "path").transform(map_batches, _merged(longer, []), _RUNS)
        runs = stage(merged, "runs")
        n_runs = runs.count()

    ranges = min(MAX_RANGES, max(1, (total or 0) // per_range))
    noted = runs.select(F.explode("keys").alias("k")).select("k.*")
    drawn = noted.orderBy(F.xxhash64("key", "time", "page")).limit(DRAWN * ranges).collect()  # DRAWN * MAX_RANGES at most
    keys = sorted({tuple(r) for r in drawn})
    cuts = sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                keys = [(k["key"], k["time"], k["page"]) for k in r["keys"]]
                ends = [*r["offsets"], r["size"]]
                for number in range(len(cuts) + 1):
                    # From the noted key before the range to the one behind it.
                    first = max(0, bisect.bisect_right(keys, cuts[number - 1]) - 1) if number else 0
                    last = bisect.bisect_left(keys, cuts[number]) if number < len(cuts) else len(keys)
                    if first < last:
                        rows.append((number, r["path"], ends[first], ends[last]))
            columns = list(zip(*rows)) if rows else [()] * 4
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["number", "path", "start", "end"]
            )

    def captures(number: int, entries: Iterator[Entry]) -> Iterator[pa.RecordBatch]:
        place, part = 0, []
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        names = [p.split()[0] for p in _CAPTURES.split(", ")]

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names)

        for e in entries:
            part.append((number, place, *e))
            place += 1
            if len(part) >= 10_000:
                yield batch()
                part = []
        if part:
            yield batch()

    parts = runs.transform(map_batches, slices, "number int, path string, start long, end long")
    return (
        parts.repartition("number")
        .sortWithinPartitions("number", "path")
        .transform(map_batches, _merged(captures, cuts), _CAPTURES)
    )


_READ = (
    "archive string, offset long, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives (column archive: their paths), read as streams. What a
    response tells of its payload is measured, and checked against its fields."""

    def page_of(name: str) -> int:
        return int(name.removeprefix("<urn:page:").removesuffix(">"))

    def chunks(path: str) -> Iterator[bytes]:
        store, name = system(path)
        with store.open_input_stream(name, compression=None) as stream:
            while data := stream.read(1 << 20):
                yield data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [p.split()[0] for p in _READ.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for path in (p for batch in batches for p in batch.column(0).to_pylist()):
            rows = []
            for offset, _, content in members(chunks(path)):
                told, payload = parse(content)
                size, digest = int(told["X-Payload-Length"]), told["WARC-Payload-Digest"].removeprefix("sha1:")
                refers = None
                if told["WARC-Type"] == "revisit":
                    refers = page_of(told["WARC-Refers-To"])
                elif (size, digest) != (len(payload), digest32(payload)):
                    raise ValueError(f"damaged record at {offset} of {path}")
                rows.append((path, offset, page_of(told["WARC-Record-ID"]), size, digest, told["WARC-Type"], refers))
                if len(rows) >= 5_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return archives.select("archive").repartition("archive").transform(map_batches, run, _READ)
