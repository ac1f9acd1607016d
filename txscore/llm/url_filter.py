"""URL filter: a blocked Bloom filter of listed addresses before an exact hash join.

Listed are rules (a host and the beginning of a path; a rule fits the host and all its
subdomains) and canonical addresses (exact). Every URL has a few keys: its canonical address,
and each end of its host with each beginning of its path that is as long as some rule's. The
Bloom filter consists of blocks of eight 32-bit words; a key sets one bit in each word of one
block. It is built by a grouped bitwise OR in Spark and sent to all tasks. Its size follows the
counted keys, at ``KEY_BITS`` to twice as many bits for each, up to ``MAX_BLOCKS`` (16 MB, reached at
8.4 million keys). A longer list fills those blocks further: of other keys 3 % pass at 17 million, a
third at 34 million, 86 % at 67 million; from there on the filter saves nothing. Keys that
it passes go to an equi-join with the list, which removes the false positives whatever
their share; all others never leave their task.

The longest rule that fits decides; a URL that no rule fits is blocked if its canonical
address is listed, else allowed. Every different URL is judged once, so a URL that a third of
the rows share costs no more than another.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; path:
from there up to ``?``, ``#`` or the end; null URLs and those without ``://`` have neither, fit
nothing and are allowed. Repeated rows are judged each. Empty tables and lists are allowed.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.llm.common import require
from txscore.session import materialize

SEED = 42
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
PARTS = re.compile(r"([^/?#]*)([^?#]*)(?:\?([^#]*))?", re.S)
#: A block of the filter has eight 32-bit words.
WORDS = 8
#: Bits of the filter for each key, at least. Share of other keys that passes, as measured: 0.0013
#: at 16 bits, 0.033 at 8, 0.33 at 4, 0.86 at 2.
KEY_BITS = 16
#: Most blocks of a filter: 16 MB.
MAX_BLOCKS = 1 << 19
#: Odd multipliers below 2**30 that pick the bit in each word (powers, so that no two are
#: simple multiples of one another).
SALTS = tuple(pow(0x9E3779B1, i + 1, 1 << 30) | 1 for i in range(WORDS))
#: Query parameters that say where a reader came from, not what the page is.
TRACKING = re.compile(r"(?:utm_[^=]*|gclid|fbclid|ref)(?:=|$)", re.S)
PORT = re.compile(r":(?:80|443)?$")


def split(url: str | None) -> tuple[str, str, str]:
    """Host, path and query of a URL."""
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", ""
    host, path, query = PARTS.match(rest).groups()
    return host.translate(LOWER), path, query or ""


def canonical(host: str, path: str, query: str) -> str:
    """Address without scheme, usual port, slashes at the end, fragment and tracking
    parameters; the other parameters in order. Empty if there is no host."""
    if not host:
        return ""
    kept = sorted(p for p in query.split("&") if p and not TRACKING.match(p))
    return PORT.sub("", host) + path.rstrip("/") + ("?" + "&".join(kept) if kept else "")


def rule_keys(host: str, path: str, lengths: Sequence[int]) -> list[str]:
    """Every rule that could fit: ends of the host at dots, beginnings of the path."""
    ends = [host] + [host[i + 1:] for i, c in enumerate(host) if c == "."]
    return [e + path[:n] for e in ends if e for n in lengths if n <= len(path)]


def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def blocks_for(n: int) -> int:
    """Blocks of a filter of ``n`` keys: a power of two."""
    return min(MAX_BLOCKS, 1 << max(0, math.ceil(math.log2(max(n, 1) * KEY_BITS / (32 * WORDS)))))


def build(keys: DataFrame, blocks: int) -> np.ndarray:
    """The filter of column ``key``, as words by block."""
    h = key_hash(F.col("key"))
    low = h.bitwiseAND(F.lit(0xFFFFFFFF))
    words = []
    for i, salt in enumerate(SALTS):
        bit = F.shiftright((low * F.lit(salt)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int")
        words.append(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias(f"w{i}"))
    rows = (keys.groupBy(F.pmod(F.shiftright(h, 32), F.lit(blocks)).alias("block")).agg(*words)
            .toArrow())  # at most one row for each block
    out = np.zeros((blocks, WORDS), np.uint32)
    at = rows.column("block").to_numpy()
    for i in range(WORDS):
        out[at, i] = rows.column(f"w{i}").to_numpy()
    return out


def passes(bloom: np.ndarray, keys: list[str]) -> np.ndarray:
    """Which keys may be in the filter."""
    import xxhash

    h = np.array([xxhash.xxh64_intdigest(k, SEED) for k in keys], np.uint64)
    block = ((h.view(np.int64) >> 32) % len(bloom)).astype(np.int64)
    low = h & np.uint64(0xFFFFFFFF)
    ok = np.ones(len(h), bool)
    for i, salt in enumerate(SALTS):
        bit = ((low * np.uint64(salt)) & np.uint64(0xFFFFFFFF)) >> np.uint64(27)
        ok &= (bloom[block, i] >> bit.astype(np.uint32)) & np.uint32(1) == 1
    return ok


def addresses(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """url, host, path, address (canonical) of every different URL that isn't null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [split(u) for u in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("url"), pa.array([p[0] for p in parts], pa.string()),
                 pa.array([p[1] for p in parts], pa.string()),
                 pa.array([canonical(*p) for p in parts], pa.string())],
                ["url", "host", "path", "address"])

    urls = pages.select(F.col(url_col).cast("string").alias("url")).where("url is not null").distinct()
    return urls.mapInArrow(run, "url string, host string, path string, address string")


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, id_col: str = "page_id",
          url_col: str = "url", blocks: int | None = None) -> DataFrame:
    """page_id, url, host, path, rule, verdict of every row of ``pages``.

    ``rules``: host, path, verdict. ``listed``: address, canonical addresses to block.
    ``blocks``: size of the filter, by default that of ``blocks_for`` the number of keys."""
    require(pages, id_col, url_col)
    require(rules, "host", "path", "verdict")
    require(listed, "address")
    entries = rules.select(F.concat("host", "path").alias("rule"), F.char_length("path").alias("n"),
                           F.col("verdict")).where("rule is not null and verdict is not null")
    lengths = sorted(r.n for r in entries.select("n").distinct().collect())  # as many as path lengths
    keys = materialize(entries.select(F.concat(F.lit("rule "), "rule").alias("key"), "rule", "verdict").unionByName(
        listed.where("address <> ''").select(F.concat(F.lit("page "), "address").alias("key"),
                                             F.lit(None).cast("string").alias("rule"),
                                             F.lit("block").alias("verdict")).distinct()))
    bloom = build(keys.select("key"), blocks or blocks_for(keys.count()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, keys = [], []
            for i, (host, path, address) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "host", "path", "address")), strict=True)):
                own = ["rule " + k for k in rule_keys(host, path, lengths)]
                if address:
                    own.append("page " + address)
                owner += [i] * len(own)
                keys += own
            ok = passes(bloom, keys) if keys else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [pc.take(batch.column("url"), pa.array(np.asarray(owner, np.int64)[ok])),
                 pa.array(np.asarray(keys, object)[ok], pa.string())], ["url", "key"])

    places = addresses(pages, url_col)
    hits = places.select("url", "host", "path", "address").mapInArrow(probe, "url string, key string")
    best = F.max(F.when(F.col("rule").isNotNull(), F.struct(
        F.char_length("rule").alias("n"), "rule", "verdict"))).alias("best")
    found = hits.join(keys, "key").groupBy("url").agg(best)
    verdicts = (places.join(found.withColumn("hit", F.lit(True)), "url", "left")
                .select("url", "host", "path", "best.rule",
                        F.coalesce("best.verdict", F.when(F.col("hit"), F.lit("block")), F.lit("allow"))
                        .alias("verdict")))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"),
                        F.col(url_col).cast("string").alias("url"))
    return rows.join(verdicts, "url", "left").select(
        "page_id", "url", F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"))
