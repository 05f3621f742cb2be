"""Verdicts for urls by allow and block entries: a trie over reversed host labels and path segments.

An entry ``(verdict, host, path)`` fits its host and all subdomains of it, if the url's path starts with the entry's.
The longest entry (characters of host and path together) wins; of equally long ones that with the longer host, of
equal ones the blocking.  An empty host fits every url.

The host of a url goes from behind the first ``://`` to the next ``/``, ``?``, ``#`` or the end, with A-Z lower-cased;
a port belongs to it.  The path goes on to the next ``?``, ``#`` or the end.  A null url, or one without ``://``, has
an empty host and an empty path.  Every row is judged on its own, repeated rows alike; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Entries whose trie is broadcast; more of them are joined instead.
BROADCAST_ENTRIES = 500_000
#: Bytes of their text that may be broadcast.
BROADCAST_BYTES = 64 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_PARTS = re.compile(r"://([^/?#]*)([^?#]*)")
_LOWER = str.maketrans(UPPER, LOWER)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    found = _PARTS.search(url) if url else None
    return (found.group(1).translate(_LOWER), found.group(2)) if found else ("", "")


def _labels(host: str) -> list[str]:
    return host.split(".")[::-1] if host else []


class Trie:
    """Entries under the labels of their hosts, last label first, and below that under the segments of their paths.

    Nodes are numbers and edges one flat table, so that depth is no matter for copying it to the workers.  What follows
    the last ``/`` of an entry's path need not be a whole segment; it is kept at the node of the segments before.
    """

    def __init__(self, entries: Iterable[tuple[str, str, str]]):
        self.edges: dict[tuple[int, str], int] = {}
        self.paths: dict[int, int] = {}
        self.ends: dict[int, dict[str, tuple[str, str]]] = {}
        self.nodes = 1
        for verdict, host, path in entries:
            node = 0
            host = host.translate(_LOWER)
            for label in _labels(host):
                node = self._step(node, label)
            if node not in self.paths:
                self.paths[node] = self.nodes
                self.nodes += 1
            node = self.paths[node]
            *whole, rest = path.split("/")
            for segment in whole:
                node = self._step(node, segment)
            ends = self.ends.setdefault(node, {})
            if rest not in ends or verdict == "block":
                ends[rest] = (host + path, verdict)

    def _step(self, node: int, label: str) -> int:
        key = (node, label)
        if key not in self.edges:
            self.edges[key] = self.nodes
            self.nodes += 1
        return self.edges[key]

    def _longest_path(self, node: int, segments: Sequence[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            ends = self.ends.get(node)
            if ends:
                fits = [rest for rest in ends if segment.startswith(rest)]
                if fits:
                    best = ends[max(fits, key=len)]
            node = self.edges.get((node, segment))
            if node is None:
                break
        return best

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """Text and verdict of the longest entry that fits."""
        node, best, segments = 0, None, path.split("/")
        for label in [None, *_labels(host)]:
            if label is not None:
                node = self.edges.get((node, label))
                if node is None:
                    break
            if node in self.paths:
                found = self._longest_path(self.paths[node], segments)
                if found and (best is None or len(found[0]) >= len(best[0])):
                    best = found
        return best


def judge(pages: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
          broadcast_entries: int = BROADCAST_ENTRIES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``page_id, row, host, path, rule, verdict``: the verdict of the longest entry, or ``default`` with a null rule.

    ``entries`` has ``verdict, host, path`` (a null host or path is empty, other verdicts than allow and block raise);
    ``row`` has the other columns of ``pages``.  The trie goes to every task if the entries and their bytes are within
    the limits, both counted first; more entries stay a table and are joined.
    """
    entries = entries.select("verdict", F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"))
    odd, many, size = entries.agg(F.count_if(~F.coalesce(F.col("verdict").isin("allow", "block"), F.lit(False))), F.count(F.lit(1)),
                                  F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path")), F.lit(0))).first()
    if odd:
        raise ValueError("verdicts are allow or block")
    rest = [pages[c] for c in pages.columns if c not in (id_col, url_col)] or [F.lit(None).cast("int").alias("none")]
    held = pages.select(F.col(id_col).alias("page_id"), F.struct(*rest).alias("row"), F.col(url_col).alias("url"))
    if many <= broadcast_entries and size <= broadcast_bytes:
        return _by_trie(held, [tuple(r) for r in entries.collect()], default)
    return _by_join(held, entries, default)


def _by_trie(held: DataFrame, entries: list[tuple[str, str, str]], default: str) -> DataFrame:
    trie = held.sparkSession.sparkContext.broadcast(Trie(entries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            places = [split_url(u) for u in batch.column(2).to_pylist()]
            found = [match(*p) or (None, default) for p in places]
            out = [pa.array([x[k] for x in pairs], pa.string()) for pairs in (places, found) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *out], ["page_id", "row", "host", "path", "rule", "verdict"])

    schema = StructType([held.schema["page_id"], held.schema["row"]])
    for name in ("host", "path", "rule", "verdict"):
        schema = schema.add(name, "string")
    return held.mapInArrow(run, schema)


def _by_join(held: DataFrame, entries: DataFrame, default: str) -> DataFrame:
    """The same rows by joins: every distinct place looks up its host's suffixes and its path's whole segments.

    A place has at most as many keys as the deepest entry allows.  A common suffix is a hot key of a plain join,
    which adaptive execution splits.
    """
    url = F.col("url")
    split = held.withColumns({
        "host": F.coalesce(F.translate(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), UPPER, LOWER), F.lit("")),
        "path": F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^?#]*)", 1), F.lit(""))})
    named = entries.select("verdict", F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"))
    named = named.groupBy("r_host", "r_path").agg(F.max("verdict").alias("verdict"))
    named = named.withColumns({"host_key": F.col("r_host"), "path_key": F.regexp_extract("r_path", "(?s)^(.*/)?", 0)})
    deep = named.agg(F.max(F.size(F.split("r_path", "/"))), F.max(F.size(F.split("r_host", r"\.")))).first()
    places = split.select("host", "path").distinct()
    labels, segments = F.split("host", r"\."), F.split("path", "/")
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deep[1]))),
                        lambda k: F.array_join(F.slice(labels, -k, k), "."))
    heads = F.transform(F.sequence(F.lit(0), F.least(F.size(segments), F.lit(deep[0])) - 1),
                        lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(segments, 1, k), "/"), F.lit("/"))))
    keys = places.select("host", "path", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), tails))).alias("host_key"))
    keys = keys.select("host", "path", "host_key", F.explode(heads).alias("path_key"))
    rank = F.struct(F.char_length("r_host") + F.char_length("r_path"), F.char_length("r_host"))
    best = (keys.join(named, ["host_key", "path_key"]).where(F.col("path").startswith(F.col("r_path")))
            .groupBy("host", "path").agg(F.max_by(F.struct(F.concat("r_host", "r_path").alias("rule"), "verdict"), rank).alias("best")))
    return split.join(best, ["host", "path"], "left").select(
        "page_id", "row", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
