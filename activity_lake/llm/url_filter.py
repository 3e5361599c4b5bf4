"""URL filter by a sorted digest array.

Rules (host, path, verdict) become two sorted arrays of 64-bit xxhash digests in one
file: hosts with the path lengths that occur for them, and whole rules with the place
of their full string. Executors get the file through Spark (SparkContext.addFile) and
memory-map it; every worker of a machine shares the mapped pages. A url is probed with the
suffixes of its host that have no more labels and bytes than the longest rule host (vectorised
binary search); for the hosts found, with its path's
prefixes of the lengths known for that host; each hit is confirmed against the stored
string, so a digest collision can't decide. The longest confirmed rule wins.

The rule list is a parameter, not data: `build` refuses one whose file would exceed
MAX_BYTES. A url without a rule gets the default verdict ("allow").

Defined cases: a null url or one without "://" has an empty host and path, which no rule
fits; a url of any length or number of labels costs time and memory in proportion to its
length; two rules for the same host and path are refused; an empty table gives an empty
result; repeated rows are judged alike; other input columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import scratch

MAX_BYTES = 1 << 30
#: Tag, hosts, path lengths, rules, string bytes, most labels and bytes of a rule host.
_HEAD = struct.Struct("<4sQQQQQQ")


def split_rule(rule: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path, which starts at the first slash."""
    host, slash, rest = rule.partition("/")
    return lower(host), slash + rest


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host: after the first :// up to / ? # or the end; path: then up to ? # or the end."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


def _digest(text: bytes) -> int:
    return xxhash.xxh64_intdigest(text)


def build(rules: Iterable[tuple[str, str]], max_bytes: int = MAX_BYTES) -> bytes:
    """The digest file of (verdict, rule) pairs; verdict is allow or block.

    Layout: header; host digests, first place in the lengths, lengths; rule digests,
    string offsets; verdict bytes; string bytes. All parts are sorted by digest."""
    parsed: dict[tuple[str, str], str] = {}
    for verdict, rule in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {verdict!r}")
        key = split_rule(rule)
        if key in parsed:
            raise ValueError(f"rule {rule!r} is given twice")
        parsed[key] = verdict
    lengths: dict[int, set[int]] = {}
    for host, path in parsed:
        lengths.setdefault(_digest(host.encode()), set()).add(len(path.encode()))
    hosts = sorted(lengths)
    first = np.cumsum([0] + [len(lengths[h]) for h in hosts])
    flat = [n for h in hosts for n in sorted(lengths[h])]
    entries = sorted((_digest((h + "\0" + p).encode()), (h + "\0" + p).encode(), v == "block") for (h, p), v in parsed.items())
    offs = np.cumsum([0] + [len(e[1]) for e in entries])
    blob = b"".join(e[1] for e in entries)
    body = [np.array(hosts, "<u8"), first.astype("<i8"), np.array(flat, "<i8"), np.array([e[0] for e in entries], "<u8"),
            offs.astype("<i8"), np.array([e[2] for e in entries], "u1")]
    labels, longest = (max((f(h) for h, _ in parsed), default=0) for f in (lambda h: h.count(".") + 1, lambda h: len(h.encode())))
    out = _HEAD.pack(b"URL2", len(hosts), len(flat), len(entries), len(blob), labels, longest) + b"".join(a.tobytes() for a in body) + blob
    if len(out) > max_bytes:
        raise ValueError(f"the digest file has {len(out)} bytes, more than {max_bytes}")
    return out


class DigestArray:
    """The memory-mapped digest file."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        tag, n_hosts, n_flat, n, n_blob, self.labels, self.longest = _HEAD.unpack(bytes(data[:_HEAD.size]))
        if tag != b"URL2":
            raise ValueError(f"{path} is no digest file")
        at = _HEAD.size

        def part(dtype: str, count: int):
            nonlocal at
            size = np.dtype(dtype).itemsize * count
            out = np.frombuffer(data, dtype, count, at) if count else np.zeros(0, dtype)
            at += size
            return out

        self.hosts, self.first, self.flat = part("<u8", n_hosts), part("<i8", n_hosts + 1), part("<i8", n_flat)
        self.keys, self.offs, self.block = part("<u8", n), part("<i8", n + 1), part("u1", n)
        self.blob = part("u1", n_blob)

    @staticmethod
    def _places(keys: np.ndarray, probes: np.ndarray) -> np.ndarray:
        """Place of the first equal key, or -1."""
        at = np.searchsorted(keys, probes)
        ok = at < len(keys)
        ok[ok] = keys[at[ok]] == probes[ok]
        return np.where(ok, at, -1)

    def judge(self, parts: list[tuple[str, str]]) -> list[tuple[str, str] | None]:
        """(rule, verdict) of the longest fitting rule for each (host, path), or None."""
        suffixes, owner = [], []
        for i, (host, _) in enumerate(parts):
            end = len(host)
            for _ in range(self.labels if host else 0):
                dot = host.rfind(".", 0, end)
                if len(host) - dot - 1 > self.longest:
                    break
                suffixes.append(host[dot + 1:].encode())
                owner.append(i)
                if dot < 0:
                    break
                end = dot
        found = self._places(self.hosts, np.array([_digest(s) for s in suffixes], np.uint64))
        probes, source = [], []
        for s in np.flatnonzero(found >= 0):
            path = parts[owner[s]][1].encode()
            for n in self.flat[self.first[found[s]]:self.first[found[s] + 1]]:
                if n <= len(path):
                    probes.append(suffixes[s] + b"\0" + path[:n])
                    source.append(owner[s])
        out: list[tuple[str, str] | None] = [None] * len(parts)
        best = [0] * len(parts)
        at = self._places(self.keys, np.array([_digest(p) for p in probes], np.uint64))
        for k in np.flatnonzero(at >= 0):
            place, i = at[k], source[k]
            # Entries that share a digest stand side by side: compare each one's string.
            while place < len(self.keys) and self.keys[place] == self.keys[at[k]]:
                if bytes(self.blob[self.offs[place]:self.offs[place + 1]]) == probes[k] and len(probes[k]) > best[i]:
                    best[i] = len(probes[k])
                    out[i] = (probes[k].replace(b"\0", b"", 1).decode(), "block" if self.block[place] else "allow")
                place += 1
        return out


def ship(spark: SparkSession, data: bytes) -> str:
    """The file's name on every executor: written to the shared folder under a name made
    of its content, then registered with Spark, which hands it to executors (also later ones)."""
    jvm, name = spark._jvm, f"url-rules-{xxhash.xxh3_128_hexdigest(data)}.bin"
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch(spark, 'rules')}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(path)
    out.write(bytearray(data))
    out.close()
    if name not in {p.rsplit("/", 1)[-1] for p in spark.sparkContext.listFiles}:
        spark.sparkContext.addFile(str(fs.makeQualified(path).toString()))
    return name


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
               default: str = "allow") -> DataFrame:
    """id, host, path, rule (null if none fits), verdict of every row."""
    name = ship(pages.sparkSession, build(rules))

    def run(batches):
        table = DigestArray(SparkFiles.get(name))
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column("url").to_pylist()]
            found = table.judge(parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([p[0] for p in parts], pa.string()), pa.array([p[1] for p in parts], pa.string()),
                 pa.array([f and f[0] for f in found], pa.string()), pa.array([f[1] if f else default for f in found], pa.string())],
                names=["id", "host", "path", "rule", "verdict"])

    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"))
    kind = src.schema["id"].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, host string, path string, rule string, verdict string")


ORACLE_SQL = r"""
WITH r(rule, rhost, rpath, rverdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
       ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
a AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM a),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
m AS (SELECT h.page_id, h.host, h.path, max({'n': length(r.rule), 'rule': r.rule, 'v': r.rverdict}) FILTER (r.rule IS NOT NULL) AS best
      FROM h LEFT JOIN r ON (h.host = r.rhost OR ends_with(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath)
      GROUP BY ALL)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM m
"""
