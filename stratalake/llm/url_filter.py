"""URL filter on a memory-mapped, sorted array of 64-bit digests.

The filter's keys are host-and-path texts such as `example.net/en/`. They are stored as one
file: sorted xxhash64 digests, verdicts, and the full texts in the same order. The file goes to
every executor once (`SparkContext.addFile`) and is memory-mapped there, so its pages are shared
by all workers of a machine. A batch of URLs is probed with vectorised binary searches; a
digest that is found counts only if the stored text is equal.

Defined results: null URLs and URLs without `://` have an empty host and path and meet no rule;
repeated rows are judged one by one; an empty table or an empty list gives no rule anywhere; of very long URLs only
what a rule can match is looked at.
Columns of the input other than the URL pass through.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_FILE_BYTES = 2 * 1024**3
HEADER = struct.Struct("<qq")


def pack_rules(rules: dict[str, str]) -> bytes:
    """The file of a rule list: {host and path: verdict}. Hosts are in lower case."""
    keys = sorted(rules, key=lambda k: (xxhash.xxh64_intdigest(k.encode()), k))
    digests = np.array([xxhash.xxh64_intdigest(k.encode()) for k in keys], dtype="<u8")
    texts = [k.encode() for k in keys]
    ends = np.cumsum([0, *map(len, texts)]).astype("<i8")
    allowed = np.array([rules[k] == "allow" for k in keys], dtype="u1")
    return b"".join([HEADER.pack(len(keys), int(ends[-1])), digests.tobytes(), ends.tobytes(), allowed.tobytes(), *texts])


class DigestArray:
    """A mapped rule file."""

    def __init__(self, path: str):
        self.raw = np.memmap(path, np.uint8, "r")
        n, size = HEADER.unpack(self.raw[: HEADER.size].tobytes())
        at = HEADER.size
        self.digests = self.raw[at : at + 8 * n].view("<u8")
        self.ends = self.raw[at + 8 * n : at + 16 * n + 8].view("<i8")
        self.allowed = self.raw[at + 16 * n + 8 : at + 17 * n + 8]
        self.texts = self.raw[at + 17 * n + 8 : at + 17 * n + 8 + size]

    def find(self, keys: list[bytes]) -> np.ndarray:
        """Position of each key in the array, or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        n = len(self.digests)
        if not n or not keys:
            return out
        wanted = np.array([xxhash.xxh64_intdigest(k) for k in keys], dtype=np.uint64)
        at = np.searchsorted(self.digests, wanted)
        for i in np.flatnonzero(self.digests[np.minimum(at, n - 1)] == wanted):
            j = int(at[i])
            while j < n and self.digests[j] == wanted[i]:  # equal digests of different texts lie together
                if self.text(j) == keys[i]:
                    out[i] = j
                    break
                j += 1
        return out

    def text(self, j: int) -> bytes:
        return self.texts[self.ends[j] : self.ends[j + 1]].tobytes()


def with_host_and_path(df: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """Adds both parts of a URL; a null or a text without `://` has two empty ones."""
    rest = F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")
    known = F.coalesce(F.contains(F.col(f"`{url}`"), F.lit("://")), F.lit(False))
    big, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return df.withColumn(
        host, F.when(known, F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), big, small)).otherwise("")
    ).withColumn(path, F.when(known, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(""))


@dataclass(frozen=True)
class Bounds:
    """What the keys of a rule list can look like: labels of their hosts, and slashes and letters of their paths, at most."""

    labels: int
    slashes: int
    letters: int

    @classmethod
    def of(cls, rules: Iterable[str]) -> Bounds:
        parts = [key.partition("/") for key in rules]
        paths = [slash + rest for _, slash, rest in parts]
        return cls(
            max((host.count(".") + 1 for host, _, _ in parts), default=0), max((p.count("/") for p in paths), default=0), max(map(len, paths), default=0)
        )


def candidates(host: str, path: str, bounds: Bounds) -> list[str]:
    """Every key within the bounds that would fit, longest first: host suffixes at dots, path prefixes after each slash.

    A rule's path is empty or ends with a slash, so only such prefixes can be keys. However long a URL is, there are
    no more of them than the rule list allows.
    """
    parts = host.rsplit(".", bounds.labels)
    parts = parts[1:] if len(parts) > bounds.labels else parts
    hosts = [".".join(parts[i:]) for i in range(len(parts))] if host else []
    start = path[: bounds.letters]
    paths, at = [""], start.find("/")
    while at >= 0 and len(paths) <= bounds.slashes:
        paths.append(start[: at + 1])
        at = start.find("/", at + 1)
    return sorted({h + p for h in hosts for p in paths}, key=lambda k: (-len(k), k))


def ship_rules(spark: SparkSession, rules: dict[str, str]) -> str:
    """Packs the list and hands it to all executors; returns the file's name there."""
    for key in rules:
        tail = key.partition("/")
        if tail[1] and not key.endswith("/"):
            raise ValueError(f"a rule's path must end with a slash: {key}")
    packed = pack_rules(rules)
    if len(packed) > MOST_FILE_BYTES:
        raise ValueError(f"the list takes {len(packed)} bytes; split it by host and filter in turns")
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    # Beside the files that Spark keeps for this application; it removes them with it.
    folder = os.path.join(SparkFiles.getRootDirectory(), "url-rules")
    os.makedirs(folder, exist_ok=True)
    local = os.path.join(folder, name)
    with open(local, "wb") as f:
        f.write(packed)
    spark.sparkContext.addFile(local)
    return name


_MAPPED: dict[str, DigestArray] = {}


def judge(df: DataFrame, rules: dict[str, str], url: str = "url", default: str = "allow") -> DataFrame:
    """Adds host, path, rule and verdict. The longest key that fits decides; `default` holds without one.

    Columns of the input that have one of these four names are replaced.
    """
    name, bounds = ship_rules(df.sparkSession, rules), Bounds.of(rules)
    parted = with_host_and_path(df.drop("rule", "verdict"), url)
    schema = T.StructType(parted.schema.fields + [T.StructField("rule", T.StringType()), T.StructField("verdict", T.StringType())])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _MAPPED:
            _MAPPED[name] = DigestArray(SparkFiles.get(name))
        array = _MAPPED[name]
        for batch in batches:
            pairs = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("host", "path")), strict=True))
            kinds = {p: None for p in pairs}
            owner, keys = [], []
            for k, (host, path) in enumerate(kinds):
                own = [c.encode() for c in candidates(host, path, bounds)]
                owner += [k] * len(own)
                keys += own
            found = array.find(keys)
            best: dict[int, int] = {}
            for at in np.flatnonzero(found >= 0):
                best.setdefault(owner[at], int(found[at]))  # candidates come longest first
            answers = {
                p: (array.text(best[k]).decode(), "allow" if array.allowed[best[k]] else "block") if k in best else (None, default)
                for k, p in enumerate(kinds)
            }
            judged = [answers[p] for p in pairs]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in judged], pa.string()), pa.array([y for _, y in judged], pa.string())],
                names=[*batch.schema.names, "rule", "verdict"],
            )

    return parted.mapInArrow(probe, schema)
