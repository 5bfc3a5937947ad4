"""URL filters: rules in a sorted array of digests, memory-mapped and searched with numpy.

A list file holds, for each rule, the 64-bit xxhash of its string in ascending
order, its verdict, and the string itself. A task maps the file, so the pages are
shared by all workers of a machine and read as needed. Every host suffix of a url
with every path prefix of a length that occurs in the list is hashed and searched
for in one call; a found digest counts only if the stored string is the same.

The file is written to the shared working folder and handed to executors by
Spark's file distribution. ``write_list`` takes the rules from the driver, which
bounds the list: ``MAX_BYTES`` of strings, an error beyond (not a cut).

A rule is a host and a path, together as one string (``example.org/en/1``). It fits
its host and all subdomains if the path of the url starts with its own. Of several
the longest string wins, of equally long ones that with the longer host.

Defined cases: a null url, or one without ``://``, has an empty host and path and
gets the default verdict; an empty list judges all by default; a rule given twice
counts once, with two verdicts it blocks; repeated rows are judged one by one; an
empty table gives an empty result; columns named like the added ones are replaced. A very long url
costs what its text costs: of its host and path only parts as long as those of some rule are looked up.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from pledgeflow.llm.common import LOWER, Rows, with_columns
from pledgeflow.session import shared_folder

ALLOW, BLOCK = "allow", "block"
#: Bytes of rule strings that one list may have.
MAX_BYTES = 256_000_000

_URL = re.compile(r"://([^/?#]*)([^?#]*)")
_ADDED = StructType([StructField(n, StringType()) for n in ("host", "path", "rule", "verdict")])
_HEADER = 3


def parts(url: str | None) -> tuple[str, str]:
    """Host, A-Z lower-cased, and path."""
    found = _URL.search(url or "")
    if not found:
        return "", ""
    return found[1].encode("utf-8", "surrogatepass").translate(LOWER).decode("utf-8", "surrogatepass"), found[2]


class UrlList:
    """The mapped file: [rules, path lengths, 0], digests, ends of strings, verdicts, path lengths, strings."""

    def __init__(self, path: str):
        whole = np.memmap(path, np.uint8, "r")
        n, lengths, hosts = (int(x) for x in whole[: 8 * _HEADER].view(np.uint64))
        at = 8 * _HEADER
        self.digests = whole[at : at + 8 * n].view(np.uint64)
        self.ends = whole[at + 8 * n : at + 16 * n].view(np.uint64)
        self.blocks = whole[at + 16 * n : at + 24 * n].view(np.uint64)
        at += 24 * n
        self.lengths = whole[at : at + 8 * lengths].view(np.uint64).tolist()
        at += 8 * lengths
        self.host_lengths = whole[at : at + 8 * hosts].view(np.uint64).tolist()
        self.strings = whole[at + 8 * hosts :]

    @staticmethod
    def to_bytes(rules: Iterable[tuple[str, str]]) -> bytes:
        """The file of (verdict, rule string)."""
        verdicts: dict[bytes, bool] = {}
        for verdict, rule in rules:
            key = rule.encode()
            verdicts[key] = verdicts.get(key, False) or verdict == BLOCK
        if sum(map(len, verdicts)) > MAX_BYTES:
            raise ValueError(f"the list has more than {MAX_BYTES} bytes; split it and apply the parts in turn")
        keys = sorted(verdicts, key=lambda k: (xxhash.xxh64_intdigest(k), k))
        hosts = {len(k.decode().partition("/")[0]) for k in keys}
        lengths = sorted({len(k.decode()) - len(k.decode().partition("/")[0]) for k in keys})
        numbers = [
            [len(keys), len(lengths), len(hosts)],
            [xxhash.xxh64_intdigest(k) for k in keys],
            np.cumsum([len(k) for k in keys]),
            [verdicts[k] for k in keys],
            lengths,
            sorted(hosts),
        ]
        return b"".join(np.array(x, np.uint64).tobytes() for x in numbers) + b"".join(keys)

    def _string(self, i: int) -> bytes:
        start = int(self.ends[i - 1]) if i else 0
        return self.strings[start : int(self.ends[i])].tobytes()

    def find(self, keys: list[bytes]) -> list[bool | None]:
        """For each key whether its rule blocks; None without a rule."""
        out: list[bool | None] = [None] * len(keys)
        if not keys or not len(self.digests):
            return out
        wanted = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        at = np.searchsorted(self.digests, wanted)
        for k in np.flatnonzero(self.digests[np.minimum(at, len(self.digests) - 1)] == wanted):
            i = int(at[k])
            while i < len(self.digests) and self.digests[i] == wanted[k]:
                if self._string(i) == keys[k]:
                    out[k] = bool(self.blocks[i])
                    break
                i += 1
        return out

    def judge(self, urls: list[tuple[str, str]]) -> list[tuple[str, bool] | None]:
        """The winning rule of each (host, path) and whether it blocks.

        Only ends of the host, and beginnings of the path, that are as long as those of some rule are looked up.
        """
        keys: list[bytes] = []
        of: list[tuple[int, int, int, str]] = []
        for n, (host, path) in enumerate(urls):
            for size in self.host_lengths:
                if 0 < size < len(host) and host[-size - 1] == "." or 0 < size == len(host):
                    suffix = host[-size:]
                    for length in self.lengths:
                        if length <= len(path):
                            key = suffix + path[:length]
                            keys.append(key.encode("utf-8", "surrogatepass"))
                            of.append((n, len(key), len(suffix), key))
        best: list[tuple[int, int, str, bool] | None] = [None] * len(urls)
        for (n, size, host, key), blocks in zip(of, self.find(keys)):
            if blocks is not None and (best[n] is None or (size, host) > best[n][:2]):
                best[n] = (size, host, key, blocks)
        return [b and b[2:] for b in best]


def write_list(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """The list as a file in the shared folder, known to all executors; gives its name there."""
    context = spark.sparkContext
    name = f"url-list-{uuid.uuid4().hex}"
    target = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    files = target.getFileSystem(context._jsc.hadoopConfiguration())
    out = files.create(target)
    out.write(bytearray(UrlList.to_bytes(rules)))
    out.close()
    context.addFile(target.toString())
    return name


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], url: str = "url", default: str = ALLOW) -> DataFrame:
    """``pages`` with ``host``, ``path``, the winning ``rule`` or null, and the ``verdict``. Writes the list when called."""
    name = write_list(pages.sparkSession, rules)

    def start() -> Callable[[pa.RecordBatch], Rows]:
        known = UrlList(SparkFiles.get(name))

        def convert(batch: pa.RecordBatch) -> Rows:
            urls = [parts(u) for u in batch.column(url).to_pylist()]
            found = known.judge(urls)
            return {
                "host": [h for h, _ in urls],
                "path": [p for _, p in urls],
                "rule": [f and f[0] for f in found],
                "verdict": [default if f is None else BLOCK if f[1] else ALLOW for f in found],
            }

        return convert

    return with_columns(pages, _ADDED, start)
