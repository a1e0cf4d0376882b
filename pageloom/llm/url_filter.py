"""URL rules looked up in a sorted array of 64-bit digests.

The rules are kept as one flat file: sorted XXH64 keys, the place of each rule's text, and the
texts themselves. Tasks map the file into memory, so the workers of a machine share its pages,
probe it by vectorised binary search and compare the stored text, so that equal digests of
different texts never match.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A rule file is sent to every executor: more rules than this must be given as a table to join.
MAX_FILE_BYTES = 1 << 30


class DigestArray:
    """Texts of the sorted array, and the number of the text equal to a probe."""

    def __init__(self, raw: np.ndarray):
        n = int(raw[:8].view(np.int64)[0])
        self.keys = raw[8 : 8 + 8 * n].view(np.uint64)
        self.place = raw[8 + 8 * n : 16 + 16 * n].view(np.int64)
        self.texts = raw[16 + 16 * n :]

    @staticmethod
    def built(texts: Sequence[bytes], digest=xxhash.xxh64_intdigest) -> bytes:
        """The file of ``texts``, each kept once."""
        rows = sorted({(digest(t), t) for t in texts})
        place = np.cumsum([0, *(len(t) for _, t in rows)], dtype=np.int64)
        keys = np.array([k for k, _ in rows], np.uint64)
        return b"".join([np.int64(len(rows)).tobytes(), keys.tobytes(), place.tobytes(), *(t for _, t in rows)])

    @classmethod
    def opened(cls, path: str) -> DigestArray:
        return cls(np.memmap(path, np.uint8, "r"))

    def text(self, i: int) -> bytes:
        return self.texts[self.place[i] : self.place[i + 1]].tobytes()

    def find(self, probes: list[bytes], digest=xxhash.xxh64_intdigest) -> np.ndarray:
        """The number of each probe's text, -1 where it is not stored."""
        wanted = np.fromiter(map(digest, probes), np.uint64, len(probes))
        at = np.searchsorted(self.keys, wanted)
        found = np.full(len(probes), -1)
        for i in np.flatnonzero(self.keys[np.minimum(at, len(self.keys) - 1)] == wanted) if len(self.keys) else ():
            k = at[i]
            while k < len(self.keys) and self.keys[k] == wanted[i]:
                if self.text(k) == probes[i]:
                    found[i] = k
                    break
                k += 1
        return found


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id", url: str = "url", default: str = "allow"
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` of every row of ``pages``.

    ``rules`` holds (verdict, host, path). A rule fits its host and all subdomains if the path
    starts with the rule's; the longest rule wins, of equally long ones that of the longest host. Without a rule ``rule`` is null and the verdict
    is ``default``. A null or malformed URL has an empty host and path and no rule. Repeated
    rows are judged each; the last of several verdicts for the same rule counts.
    """
    verdicts = {f"{h}{p}".encode(): v for v, h, p in rules}
    depths = sorted({len(p) for _, _, p in rules})
    # No rule has a host of more labels or characters, so longer suffixes of a host need no probe.
    labels, characters = (max((f(h) for _, h, _ in rules), default=0) for f in (lambda h: h.count(".") + 1, len))
    file = DigestArray.built(list(verdicts))
    if len(file) > MAX_FILE_BYTES:
        raise ValueError("the rule file passes MAX_FILE_BYTES")
    name = f"url-rules-{uuid.uuid4().hex}"
    folder = tempfile.mkdtemp()
    with open(os.path.join(folder, name), "wb") as out:
        out.write(file)
    pages.sparkSession.sparkContext.addFile(os.path.join(folder, name))

    def judged(batches):
        array = DigestArray.opened(SparkFiles.get(name))
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            probes, row = [], []
            for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                heads = [path[:d] for d in depths if d <= len(path)]
                pieces = host.rsplit(".", labels)
                if len(pieces) > labels:
                    host = ".".join(pieces[1:])
                while host:
                    if len(host) <= characters:
                        probes += [f"{host}{x}".encode() for x in heads]
                        row += [i] * len(heads)
                    host = host.partition(".")[2]
            best: list[bytes | None] = [None] * len(hosts)
            found = array.find(probes)
            for j in np.flatnonzero(found >= 0):
                text = probes[j]
                if best[row[j]] is None or len(text) > len(best[row[j]]):
                    best[row[j]] = text
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("key", "host", "path")),
                    pa.array([b and b.decode() for b in best], pa.string()),
                    pa.array([default if b is None else verdicts[b] for b in best], pa.string()),
                ],
                ["key", "host", "path", "rule", "verdict"],
            )

    parts = pages.select(F.col(key).cast("long").alias("key"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    out = parts.mapInArrow(judged, "key long, host string, path string, rule string, verdict string")
    return out.withColumnRenamed("key", key)
