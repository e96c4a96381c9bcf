"""URL filter: a sorted array of 64-bit digests that is memory-mapped and probed by binary search.

A rule is a string ``host/path``. It fits its host and all subdomains if the url's path starts with the
rule's path; the longest rule wins (of equal length that with the longer host; block over allow). A
listed entry has the same form and decides, as block, where no rule fits.

The digests (xxhash64) of all rules and entries are sorted, and lie beside their full strings in one
file. A url's candidates are those suffixes of its host that have as many labels as some rule's host, with each prefix
of its path that has the length of some rule's path, so a long host or path makes no more candidates; their digests are probed in the mapped array by vectorised binary search. A digest that
is there is confirmed by comparing the stored strings, all of those that share the digest, so a
collision can't decide.

Distribution: a narrow pass over the urls, nothing is shuffled and a hot host makes no difference. The
list is cut by hash into blocks of at most ``block_rules`` strings; a block is collected, sorted and
broadcast by itself, and each task maps one file for it and removes the name at once, so that
nothing stays behind. More rules make more blocks, each one more narrow pass.

Defined cases: a url that is null or has no ``://`` has an empty host and path, fits nothing and is
allowed; a rule that repeats counts once; empty tables give empty results or ``allow`` throughout;
extra columns pass through ``judge``.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textforge.llm.frames import fresh, table

BLOCK_RULES = 1 << 20
#: The rules of the query, and the hosts of its block list with each ending.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
LISTED_ENDINGS = ("example.com/", "example.net/", "example.org/")

_MATCH = T.StructType(
    [
        T.StructField("entry", T.StringType()),
        T.StructField("verdict", T.StringType()),
        T.StructField("rank", T.LongType()),
    ]
)
_ARROW = pa.struct([("entry", pa.string()), ("verdict", pa.string()), ("rank", pa.int64())])


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), upper, lower)


def path_of(url: Column) -> Column:
    """After the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


class DigestArray:
    """Sorted digests, the strings they stand for, and each string's verdict and rank."""

    def __init__(self, entries: list[tuple[str, str, int]]):
        keyed = sorted((xxhash.xxh64_intdigest(e), e, v, r) for e, v, r in entries)
        texts = [e.encode() for _, e, _, _ in keyed]
        self.n = len(keyed)
        self.lengths = sorted({len(e[e.find("/") :]) for _, e, _, _ in keyed})
        self.labels = sorted({e[: e.find("/")].count(".") + 1 for _, e, _, _ in keyed})
        ends = np.cumsum([0, *map(len, texts)], dtype=np.uint64)
        keys = np.array([k for k, *_ in keyed], np.uint64)
        marks = np.array([2 * r + (v == "block") for *_, v, r in keyed], np.uint64)
        self.data = keys.tobytes() + ends.tobytes() + marks.tobytes() + b"".join(texts)
        self._map = None

    def __getstate__(self):
        return self.__dict__ | {"_map": None}

    def mapped(self):
        if self._map is None:
            with tempfile.TemporaryFile() as file:  # has no name, and goes with its mapping
                file.write(self.data)
                file.flush()
                whole = np.memmap(file, np.uint8, "r")
            n = self.n
            numbers = whole[: 8 * (3 * n + 1)].view(np.uint64)
            self._map = numbers[:n], numbers[n : 2 * n + 1], numbers[2 * n + 1 :], whole[8 * (3 * n + 1) :]
            self.data = b""  # the file has it
        return self._map

    def probe(self, candidates: list[str]) -> list[tuple[str, str, int] | None]:
        keys, ends, marks, texts = self.mapped()
        wanted = np.array([xxhash.xxh64_intdigest(c) for c in candidates], np.uint64)
        first, last = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right")
        found: list[tuple[str, str, int] | None] = [None] * len(candidates)
        for i in np.flatnonzero(last > first):
            for k in range(first[i], last[i]):
                if texts[int(ends[k]) : int(ends[k + 1])].tobytes() == candidates[i].encode():
                    mark = int(marks[k])
                    found[i] = (candidates[i], "block" if mark % 2 else "allow", mark // 2)
        return found


def _order(match: tuple[str, str, int]) -> tuple:
    """Greater is stronger: rules before listed entries, then the longer string, the longer host, block."""
    entry, verdict, rank = match
    return -rank, len(entry), entry.find("/"), verdict


def _best(array: DigestArray, hosts: list[str], paths: list[str]) -> list[tuple | None]:
    owners, candidates = [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        if not host:
            continue
        labels = host.rsplit(".", array.labels[-1] if array.labels else 0)
        prefixes = [path[:n] for n in array.lengths if n <= len(path)]
        whole = host.count(".") + 1
        for k in array.labels:
            if k > whole:
                break
            suffix = ".".join(labels[-k:])
            candidates.extend(suffix + p for p in prefixes)
            owners.extend([i] * len(prefixes))
    best: list[tuple | None] = [None] * len(hosts)
    for i, match in zip(owners, array.probe(candidates), strict=True):
        if match and (best[i] is None or _order(match) > _order(best[i])):
            best[i] = match
    return best


def judge(
    pages: DataFrame, entries: DataFrame, result: str, url_col: str = "url", block_rules: int = BLOCK_RULES
) -> DataFrame:
    """``pages`` with a struct column: ``host``, ``path``, the ``entry`` that decided, its ``verdict`` and ``rank``.

    ``entries`` has ``entry``, ``verdict`` (allow or block) and ``rank``: 0 for a rule, 1 for a listed entry.
    """
    spark = pages.sparkSession
    kept = [F.col(f"`{c}`") for c in pages.columns]
    host, path, match = fresh(pages, "host"), fresh(pages, "path"), fresh(pages, "match")
    out = pages.select(
        *kept,
        host_of(F.col(f"`{url_col}`")).alias(host),
        path_of(F.col(f"`{url_col}`")).alias(path),
        F.lit(None).cast(_MATCH).alias(match),
    )
    # A rule's path is cut by code points as the url's is, so lengths agree.
    entries = entries.where(F.contains("entry", F.lit("/"))).select("entry", "verdict", F.col("rank").cast("long"))
    entries = entries.groupBy("entry", "rank").agg(F.max("verdict").alias("verdict"))
    entries = entries.groupBy("entry").agg(F.min(F.struct("rank", "verdict")).alias("least"))
    n_blocks = max(1, -(-entries.count() // block_rules))
    at = len(pages.columns)
    for number in range(n_blocks):
        rows = entries.where(F.pmod(F.xxhash64("entry"), F.lit(n_blocks)) == number).collect()
        array = spark.sparkContext.broadcast(
            DigestArray([(r["entry"], r["least"]["verdict"], r["least"]["rank"]) for r in rows])
        )

        def probe(batches, array=array):
            for batch in batches:
                found = _best(array.value, batch.column(at).to_pylist(), batch.column(at + 1).to_pylist())
                before = batch.column(at + 2).to_pylist()
                for i, old in enumerate(before):
                    old = old and (old["entry"], old["verdict"], old["rank"])
                    if old and (found[i] is None or _order(old) > _order(found[i])):
                        found[i] = old
                rows = [m and dict(zip(("entry", "verdict", "rank"), m, strict=True)) for m in found]
                columns = [*batch.columns[: at + 2], pa.array(rows, _ARROW)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        out = out.mapInArrow(probe, out.schema)
    found = F.struct(
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        F.col(f"{match}.entry").alias("entry"),
        F.coalesce(f"{match}.verdict", F.lit("allow")).alias("verdict"),
        F.col(f"{match}.rank").alias("rank"),
    )
    return out.select(*kept, found.alias(result))


def rules_and_list(spark) -> DataFrame:
    listed = [(f"{name}.{ending}", "block", 1) for name in LISTED_NAMES for ending in LISTED_ENDINGS]
    rules = [(rule, verdict, 0) for rule, verdict in RULES]
    return spark.createDataFrame([*rules, *listed], "entry string, verdict string, rank long")


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rules_and_list(spark), "found").select(
        "page_id",
        "found.host",
        "found.path",
        F.when(F.col("found.rank") == 0, F.col("found.entry")).alias("rule"),
        "found.verdict",
    )
