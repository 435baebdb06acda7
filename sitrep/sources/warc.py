"""Web-archive segments as a Spark data source: ``spark.read.format("warc")``.

A segment is read as a stream, so a task holds one record at a time however large
the segment is. A segment that breaks off yields the rows before the break and one
row whose ``error`` says what happened.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sitrep import schemas
from sitrep.functions.files import open_filesystem

_ARROW = pa.schema(
    [
        ("segment", pa.string()),
        ("rec_type", pa.string()),
        ("target_uri", pa.string()),
        ("content_type", pa.string()),
        ("payload", pa.binary()),
        ("error", pa.string()),
    ]
)
# What a gzip member starts with.
_MEMBER = b"\x1f\x8b\x08"
# Longest payload that becomes one row; ``warc_parts`` reads longer ones in pieces.
MAX_PAYLOAD = 1 << 30
_BATCH_ROWS = 1000
_BATCH_BYTES = 4 * 1024 * 1024


class WarcSource(DataSource):
    """Options: ``path``; ``recordTypes`` and ``contentTypes``, comma-separated; ``splitBytes``.

    Records of other types, and responses whose content type contains none of the
    given texts, are passed over before they reach Spark.

    Each file is one partition. With ``splitBytes``, gzip files above that size are
    read by several tasks, each starting at the first compressed record of its part;
    a broken part then loses its own remaining rows only. Leave it out for archives
    that hold other archives, whose records would be taken for the file's own.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return schemas.WARC_RECORD

    def reader(self, schema) -> DataSourceReader:
        return WarcReader(self.options)


class Segment(InputPartition):
    """The records of a file that start in members from ``start`` up to ``end``."""

    def __init__(self, uri: str, start: int = 0, end: int | None = None):
        self.uri, self.start, self.end = uri, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.record_types = _listed(options.get("recordTypes"))
        self.content_types = _listed(options.get("contentTypes"))
        self.split_bytes = int(options.get("splitBytes") or 0)

    def partitions(self) -> list[InputPartition]:
        from pyarrow import fs

        found = []
        for path in self.path.split(","):
            filesystem, root = open_filesystem(path)
            info = filesystem.get_file_info(root)
            if info.type == fs.FileType.NotFound:
                raise FileNotFoundError(path)
            files = [info]
            if info.type == fs.FileType.Directory:
                files = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
            prefix = path[: len(path) - len(root)] if path.endswith(root) else ""
            found += [
                (prefix + f.path, f.size)
                for f in files
                if f.type == fs.FileType.File and f.size and not f.base_name.startswith(("_", "."))
            ]
        return [part for uri, size in sorted(found) for part in self._parts(uri, size)]

    def _parts(self, uri: str, size: int) -> list[Segment]:
        step = self.split_bytes
        if not step or size <= step or not uri.endswith(".gz"):
            return [Segment(uri)]
        return [Segment(uri, start, min(start + step, size)) for start in range(0, size, step)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for row in self._rows(partition):
            rows.append(row)
            size += len(row[4] or b"")
            if len(rows) >= _BATCH_ROWS or size >= _BATCH_BYTES:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    def _rows(self, part: Segment):
        uri = part.uri
        try:
            filesystem, path = open_filesystem(uri)
            with filesystem.open_input_file(path) as raw:
                start = first_member(raw, part.start, part.end) if part.start else 0
                if start is None:
                    return
                raw.seek(start)
                stream = _Unzipped(raw, start) if path.endswith(".gz") else raw
                for head, _, body in open_records(stream, part.end, self.record_types):
                    kind = head.get("warc-type", "")
                    try:
                        if body.left > MAX_PAYLOAD:
                            raise OversizedPayload(f"record is longer than {MAX_PAYLOAD} bytes")
                        content_type, payload = http_payload(head, body.whole())
                    except OversizedPayload as error:
                        # The record is named, the ones after it are read.
                        yield uri, kind, head.get("warc-target-uri"), None, None, str(error)
                        continue
                    if (
                        self.content_types
                        and kind == "response"
                        and not any(t in content_type for t in self.content_types)
                    ):
                        continue
                    yield uri, kind, head.get("warc-target-uri"), content_type, payload, None
        except (OSError, EOFError, ValueError, zlib.error) as error:
            yield uri, None, None, None, None, f"{type(error).__name__}: {error}"


def _listed(option: str | None) -> list[str]:
    return [x.strip() for x in (option or "").split(",") if x.strip()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
    )


class _Unzipped:
    """Text of a gzip stream of any number of members, handed out as far as it is intact."""

    def __init__(self, raw, offset: int = 0):
        self.raw = raw
        self.pending = b""
        self.member = None
        self.offset = offset  # compressed bytes taken from the file so far
        self.plain = 0  # bytes handed out so far
        self.starts: deque[tuple[int, int]] = deque()  # where members start, in both

    def member_start(self, position: int) -> int:
        """File offset of the member that holds the byte at ``position``; positions only grow."""
        return self.place(position)[0]

    def place(self, position: int) -> tuple[int, int]:
        """That offset, and how far into the member the byte is."""
        while len(self.starts) > 1 and self.starts[1][0] <= position:
            self.starts.popleft()
        plain, offset = self.starts[0]
        return offset, position - plain

    def read(self, n: int) -> bytes:
        while True:
            if not self.pending:
                self.pending = self.raw.read(1 << 16)
                self.offset += len(self.pending)
            if self.member is None:
                if not self.pending:
                    return b""
                self.member = zlib.decompressobj(31)
                self.starts.append((self.plain, self.offset - len(self.pending)))
            cut_off = not self.pending
            out = self.member.decompress(self.pending, n)
            if self.member.eof:
                self.pending, self.member = self.member.unused_data, None
            else:
                self.pending = self.member.unconsumed_tail
            if out:
                self.plain += len(out)
                return out
            if cut_off:
                raise EOFError("compressed data is cut off")


def first_member(raw, start: int, end: int) -> int | None:
    """Offset of the first compressed record from ``start`` on and before ``end``."""
    window = 1 << 16
    at = start
    while at < end:
        raw.seek(at)
        data = raw.read(2 * window)
        found = data.find(_MEMBER, 0, min(window, end - at) + len(_MEMBER) - 1)
        while found >= 0:
            try:
                if zlib.decompressobj(31).decompress(data[found:], 5) == b"WARC/":
                    return at + found
            except zlib.error:
                pass
            found = data.find(_MEMBER, found + 1, min(window, end - at) + len(_MEMBER) - 1)
        at += window
    return None


def _exactly(stream, n: int) -> bytes:
    parts = []
    while n:
        part = stream.read(n)
        if not part:
            raise EOFError("record is cut off")
        parts.append(part)
        n -= len(part)
    return b"".join(parts)


class Body:
    """Content block of a record, handed out as far as it is asked for."""

    def __init__(self, lines: _Lines, length: int):
        self.lines, self.left = lines, length

    def read(self, n: int) -> bytes:
        """Up to ``n`` bytes; none at the end of the block."""
        part = self.lines.some(min(n, self.left))
        self.left -= len(part)
        return part

    def whole(self) -> bytes:
        length, self.left = self.left, 0
        return self.lines.exactly(length)

    def skip(self) -> None:
        length, self.left = self.left, 0
        self.lines.skip(length)


def open_records(
    stream, end: int | None = None, types: Sequence[str] = ()
) -> Iterator[tuple[dict[str, str], int, Body]]:
    """Header fields (lower-case names), position and content block of each record of a stream.

    Stops at the first record whose member starts at or after ``end``. What is not read of a
    block, and records of other types than ``types``, are passed over, never held whole.
    """
    lines = _Lines(stream)
    while True:
        at = lines.position
        line = lines.readline()
        while line in (b"\r\n", b"\n"):
            at = lines.position
            line = lines.readline()
        if not line or (end is not None and stream.member_start(at) >= end):
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not a web-archive record")
        head = _fields(lines)
        body = Body(lines, int(head["content-length"]))
        if not types or head.get("warc-type", "") in types:
            yield head, at, body
        body.skip()


def warc_records(
    stream, end: int | None = None, types: Sequence[str] = ()
) -> Iterator[tuple[dict[str, str], bytes]]:
    """:func:`open_records` with whole content blocks."""
    for head, _, body in open_records(stream, end, types):
        yield head, body.whole()


class _Lines:
    """Lines and fixed-length blocks of a stream that only knows ``read``."""

    def __init__(self, stream):
        self.stream = stream
        self.buffer = b""
        self.position = 0

    def readline(self) -> bytes:
        while True:
            end = self.buffer.find(b"\n")
            if end >= 0:
                line, self.buffer = self.buffer[: end + 1], self.buffer[end + 1:]
                self.position += len(line)
                return line
            more = self.stream.read(1 << 16)
            if not more:
                line, self.buffer = self.buffer, b""
                self.position += len(line)
                return line
            self.buffer += more

    def some(self, n: int) -> bytes:
        """One to ``n`` bytes, none if ``n`` is 0."""
        if n and not self.buffer:
            self.buffer = self.stream.read(1 << 16)
            if not self.buffer:
                raise EOFError("record is cut off")
        taken, self.buffer = self.buffer[:n], self.buffer[n:]
        self.position += len(taken)
        return taken

    def exactly(self, n: int) -> bytes:
        self.position += n
        taken, self.buffer = self.buffer[:n], self.buffer[n:]
        return taken + _exactly(self.stream, n - len(taken))

    def skip(self, n: int) -> None:
        self.position += n
        held = min(n, len(self.buffer))
        self.buffer = self.buffer[held:]
        n -= held
        while n:
            part = self.stream.read(min(n, 1 << 16))
            if not part:
                raise EOFError("record is cut off")
            n -= len(part)


def _fields(lines: _Lines) -> dict[str, str]:
    head: dict[str, str] = {}
    while True:
        line = lines.readline()
        if not line:
            raise EOFError("record header is cut off")
        text = line.decode("utf-8", errors="replace").rstrip("\r\n")
        if not text:
            if "content-length" not in head:
                raise ValueError("record without a length")
            return head
        name, _, value = text.partition(":")
        head.setdefault(name.strip().lower(), value.strip())


def http_payload(head: dict[str, str], block: bytes) -> tuple[str, bytes]:
    """Content type and decoded body of a record; non-HTTP blocks pass unchanged."""
    if not block.startswith(b"HTTP/"):
        return "", block
    start, sep, body = block.partition(b"\r\n\r\n")
    if not sep:
        start, _, body = block.partition(b"\n\n")
    fields: dict[str, str] = {}
    for line in start.decode("utf-8", errors="replace").splitlines()[1:]:
        name, _, value = line.partition(":")
        fields.setdefault(name.strip().lower(), value.strip())
    if "chunked" in fields.get("transfer-encoding", "").lower():
        body = _unchunk(body)
    encoding = fields.get("content-encoding", "").lower()
    if encoding in ("gzip", "x-gzip", "deflate"):
        body = _inflate(body)
    if len(body) > MAX_PAYLOAD:
        raise OversizedPayload(f"payload is longer than {MAX_PAYLOAD} bytes")
    return fields.get("content-type", ""), body


def _unchunk(body: bytes) -> bytes:
    """Joined chunks; a body that is not really chunked passes unchanged."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return b"".join(parts) if parts else body
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return b"".join(parts) if parts else body
        if size < 0:
            # No size at all: a body that goes back over itself would never end.
            return b"".join(parts) if parts else body
        if size == 0:
            return b"".join(parts)
        parts.append(body[end + 2: end + 2 + size])
        at = end + 2 + size + 2


class OversizedPayload(Exception):
    """A payload that a task should not hold, however it is encoded."""


def _inflate(body: bytes) -> bytes:
    for window in (47, -15):  # gzip or zlib header, then a bare deflate stream
        try:
            unzip = zlib.decompressobj(window)
            plain = unzip.decompress(body, MAX_PAYLOAD)
        except zlib.error:
            continue
        if unzip.unconsumed_tail:
            raise OversizedPayload(f"payload is longer than {MAX_PAYLOAD} bytes")
        return plain
    return body


def read_warc(
    spark: SparkSession, path: str, record_types: str = "", content_types: str = "", split_bytes: int = 0
) -> DataFrame:
    """Records of all segments under ``path`` (a file, a folder, or several with commas).

    ``split_bytes`` lets several tasks share a large segment, see :class:`WarcSource`.
    """
    spark.dataSource.register(WarcSource)
    return (
        spark.read.format("warc")
        .option("recordTypes", record_types)
        .option("contentTypes", content_types)
        .option("splitBytes", split_bytes)
        .load(path)
    )


def html_responses(records: DataFrame) -> DataFrame:
    """Response records whose content type contains ``text/html``."""
    return records.where("rec_type = 'response' and contains(content_type, 'text/html')")
