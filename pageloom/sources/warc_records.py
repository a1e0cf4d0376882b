"""WARC records from a range of one archive file, plain or gzip, streaming."""

from __future__ import annotations

import importlib.util
import zlib
from typing import BinaryIO, NamedTuple

CHUNK = 1 << 20
GZIP_START = b"\x1f\x8b\x08"
PLAIN_START = b"WARC/"
_HAS_BROTLI = importlib.util.find_spec("brotli") is not None


class Record(NamedTuple):
    offset: int
    ordinal: int
    headers: dict
    http: dict
    body: bytes | None
    error: str | None


class ByteStream:
    """Inflated bytes of an archive that knows where the current gzip member starts.

    The buffer never holds more than one member's data; a plain file is one member whose
    position is the file position.
    """

    def __init__(self, file: BinaryIO, start: int, is_gzip: bool):
        self.file, self.is_gzip = file, is_gzip
        file.seek(start)
        self.raw, self.position = b"", start
        self.inflate = None
        self.buffer = bytearray()
        self.member = start
        # Bytes that the last read did not find.
        self.missing = 0

    def _raw(self) -> bytes:
        return self.raw or self.file.read(CHUNK)

    def _fill(self) -> bool:
        """Add data to the buffer; False at the end of the file."""
        while True:
            raw = self._raw()
            if self.is_gzip and self.inflate is None:
                # Zero bytes may pad the file behind its last member.
                self.position += len(raw) - len(raw.lstrip(b"\0"))
                raw = raw.lstrip(b"\0")
            if not raw:
                rest = self.inflate.flush() if self.inflate else b""
                self.inflate = None
                self.buffer += rest
                return bool(rest)
            if not self.is_gzip:
                self.raw = b""
                self.position += len(raw)
                self.buffer += raw
                return True
            if self.inflate is None:
                if self.buffer:
                    return True
                self.member = self.position
                self.inflate = zlib.decompressobj(31)
            data = self.inflate.decompress(raw, CHUNK)
            rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.position += len(raw) - len(rest)
            self.raw = rest
            if self.inflate.eof:
                self.inflate = None
            if data:
                self.buffer += data
                return True

    def offset(self) -> int:
        """The position of the next byte of a plain file."""
        return self.position - len(self.buffer)

    def line(self) -> bytes:
        searched = 0
        while True:
            at = self.buffer.find(b"\n", searched)
            if at >= 0:
                break
            searched = len(self.buffer)
            if not self._fill_more():
                at = len(self.buffer) - 1
                break
        return self._take(at + 1)

    def _fill_more(self) -> bool:
        # A line may run over a member's end: keep what there is and add the next data.
        kept = bytes(self.buffer)
        self.buffer.clear()
        more = self._fill()
        self.buffer[:0] = kept
        return more

    def _take(self, size: int) -> bytes:
        data = bytes(self.buffer[:size])
        del self.buffer[:size]
        return data

    def read(self, size: int, keep: bool = True) -> bytes:
        parts = []
        while size > 0 and (self.buffer or self._fill()):
            data = self._take(min(size, len(self.buffer)))
            size -= len(data)
            if keep:
                parts.append(data)
        self.missing = size
        return b"".join(parts)


def _decoded(line: bytes) -> str:
    try:
        return line.decode("utf-8")
    except UnicodeDecodeError:
        return line.decode("latin-1")


def read_headers(next_line) -> dict:
    """Header lines up to a blank one, names in lower case; the first of a name counts."""
    headers: dict = {}
    name = None
    while True:
        line = next_line().rstrip(b"\r\n")
        if not line:
            return headers
        if line[:1] in b" \t" and name is not None:
            headers[name] += " " + _decoded(line).strip()
            continue
        key, colon, value = _decoded(line).partition(":")
        name = None
        if colon and key.strip().lower() not in headers:
            name = key.strip().lower()
            headers[name] = value.strip()


def find_start(file: BinaryIO, start: int, end: int, is_gzip: bool) -> int | None:
    """The first record start in ``[start, end)`` as far as its first bytes tell."""
    mark = GZIP_START if is_gzip else b"\n" + PLAIN_START
    lead = 0 if is_gzip else 1
    position = max(start - lead, 0)
    file.seek(position)
    window = b""
    while position < end:
        data = file.read(CHUNK)
        window += data
        at = window.find(mark)
        while at >= 0 and position + at + lead < end:
            found = position + at + lead
            if not is_gzip or _opens_record(file, found):
                return found
            at = window.find(mark, at + 1)
        if not data:
            return None
        keep = len(mark) - 1
        position += max(len(window) - keep, 0)
        window = window[-keep:]
        file.seek(position + len(window))
    return None


def _opens_record(file: BinaryIO, offset: int) -> bool:
    file.seek(offset)
    try:
        return zlib.decompressobj(31).decompress(file.read(1 << 16), 64).startswith(PLAIN_START)
    except zlib.error:
        return False


def _unchunked(data: bytes) -> bytes:
    """A chunked body joined; bytes that are not chunked come back as they are."""
    parts, position = [], 0
    while position < len(data):
        line_end = data.find(b"\r\n", position)
        try:
            size = int(data[position:line_end].split(b";")[0], 16) if line_end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return b"".join(parts) + data[position:] if parts else data
        if size == 0:
            break
        parts.append(data[line_end + 2 : line_end + 2 + size])
        position = line_end + 2 + size + 2
    return b"".join(parts)


def _inflated(data: bytes, encoding: str) -> bytes:
    if encoding == "br" and _HAS_BROTLI:
        import brotli

        return brotli.decompress(data)
    modes = {"gzip": (31,), "x-gzip": (31,), "deflate": (15, -15)}.get(encoding, ())
    for mode in modes:
        inflate = zlib.decompressobj(mode)
        try:
            return inflate.decompress(data) + inflate.flush()
        except zlib.error:
            continue
    return data


def body_bytes(data: bytes, http: dict) -> bytes:
    """The body without its transfer and content encoding."""
    if "chunked" in http.get("transfer-encoding", "").lower():
        data = _unchunked(data)
    return _inflated(data, http.get("content-encoding", "").strip().lower())


# Record types that hold an HTTP message.
HTTP_RECORDS = ("response", "request", "revisit")


def is_html(rec_type: str, http: dict) -> bool:
    return rec_type == "response" and "text/html" in http.get("content-type", "")


def read_records(file: BinaryIO, size: int, start: int, end: int, types, wants_body):
    """Records that start in ``[start, end)`` of a file of ``size`` bytes.

    A range inside a file begins at the first start found there, and the range before it
    checks that this is where its own last record ends; if not, the file holds bytes that
    look like a record start and the read fails rather than repeat or lose records.
    """
    file.seek(0)
    is_gzip = file.read(3) == GZIP_START
    first = 0 if start == 0 else find_start(file, start, end, is_gzip)
    if first is None:
        return
    stream = ByteStream(file, first, is_gzip)
    last_member, ordinal = None, 0
    while True:
        line, offset = _record_line(stream, size)
        if offset >= end:
            break
        if not line.startswith(PLAIN_START):
            raise ValueError(f"no record starts at byte {offset}")
        ordinal = ordinal + 1 if offset == last_member else 0
        last_member = offset
        headers = read_headers(stream.line)
        left = int(headers.get("content-length", "0") or 0)
        rec_type = headers.get("warc-type", "")
        uri = headers.get("warc-target-uri", "")
        if uri.startswith("<") and uri.endswith(">"):
            uri = headers["warc-target-uri"] = uri[1:-1]
        if types and rec_type not in types:
            stream.read(left, keep=False)
            continue
        http: dict = {}
        body = b""
        if left and rec_type in HTTP_RECORDS and uri.startswith(("http:", "https:")):
            spent = []

            def next_line():
                got = stream.line() if sum(spent) < left else b""
                spent.append(len(got))
                return got

            status = next_line()
            if status.startswith(b"HTTP/") or rec_type == "request":
                http = read_headers(next_line)
            else:
                body = status
            left -= sum(spent)
        if wants_body(rec_type, http):
            body = body_bytes(body + stream.read(left), http)
        else:
            stream.read(left, keep=False)
            body = None
        error = f"{stream.missing} bytes are missing" if stream.missing > 0 else None
        if error is None and body is not None and http.get("content-encoding", "").strip().lower() == "br" and not _HAS_BROTLI:
            error = "the body is left in the encoding br"
        yield Record(offset, ordinal, headers, http, body, error)
    if end < size:
        seen = find_start(file, end, min(offset + 1, size), is_gzip)
        if seen != (offset if offset < size else None):
            raise ValueError(
                f"the record at byte {last_member} cannot be told from its neighbours; "
                "read this file with splitBytes=0"
            )


def _record_line(stream: ByteStream, size: int) -> tuple[bytes, int]:
    """The next line that is not blank and where its record starts; at the end ``size``."""
    while True:
        line = stream.line()
        if not line:
            return line, size
        if line.strip():
            return line, stream.member if stream.is_gzip else stream.offset() - len(line)
