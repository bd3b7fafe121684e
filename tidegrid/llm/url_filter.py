"""URL lists with a blocked Bloom filter in front of an exact hash join.

A listed entry is a canonical host and path, like ``example.com/de/``; it fits its host and all
subdomains when the path starts with the entry's; one without ``/`` fits whatever the path is. So a URL is
looked up once for each shape that occurs in the list: so many last labels of its host, so many first
characters of its path. Where a list has too many shapes for that, the listed hosts are joined first and say
which path lengths to look up. URLs meet the filter where they are read, so only possible hits are shuffled.
The filter is a table of blocks of 8 words, one bit in each word a key. Its size has a
fixed bound, which makes it safe to broadcast however long the list is; a fuller filter only
lets more through to the exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegrid.operators.lookup import lookup_join
from tidegrid.sources.stage import stage

#: Odd multipliers, one for each word of a block (those of the split block filter of the Parquet format).
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]
MAX_BLOCKS = 1 << 18
#: So many judged URLs are broadcast to the pages; more are joined by a shuffle, as URLs may be long.
BROADCAST_URLS = 20_000
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), CAPITALS, CAPITALS.lower())


def path_of(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """One bit for each word of the key's block, from a second hash."""
    h = F.xxhash64(key, F.lit(1)).bitwiseAND(F.lit(0x7FFFFFFF))
    return [F.call_function("shiftleft", F.lit(1), F.shiftrightunsigned((h * F.lit(s)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int"))
            for s in SALTS]


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: a row for each block that has keys, with its 8 words."""
    return keys.select(_block(F.col(key), blocks).alias("block"),
                       *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))]
                       ).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def passed(keys: DataFrame, listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The rows of ``keys`` that the filter of ``listed`` (same column) lets through, without a shuffle of ``keys``."""
    bloom = F.broadcast(bloom_blocks(listed, key, blocks))
    hits = keys.withColumn("block", _block(F.col(key), blocks)).join(bloom, "block")
    for i, bit in enumerate(_bits(F.col(key))):
        hits = hits.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
    return hits.select(*keys.columns)


def look_ups(urls: DataFrame, entries: DataFrame, blocks: int, max_shapes: int) -> DataFrame:
    """``host``, ``path`` and each ``key`` under which the list may have them."""
    shapes = entries.groupBy("labels", "chars").agg(F.lit(1)).limit(max_shapes + 1).collect()
    # a host or path that is too short gives a key that was already met or that is not listed
    if len(shapes) <= max_shapes:
        wanted = F.array(*[F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["chars"]).alias("chars"))
                           for s in sorted(shapes)]) if shapes else F.array().cast("array<struct<labels:int,chars:int>>")
        keys = urls.select("host", "path", F.explode(wanted).alias("shape")).select(
            "host", "path", _last_labels(F.col("host"), F.col("shape.labels")).alias("end"), "shape.chars")
    else:
        hosts = stage(entries.groupBy("end").agg(F.collect_set("chars").alias("lengths")), "listed_hosts")
        ends = urls.select("host", "path", F.explode(F.sequence(F.lit(1), F.size(F.split("host", r"\.")))).alias("labels"))
        ends = ends.select("host", "path", _last_labels(F.col("host"), F.col("labels")).alias("end"))
        known = passed(ends, hosts.select("end"), "end", blocks).distinct().join(hosts, "end")
        keys = known.select("host", "path", "end", F.explode("lengths").alias("chars"))
    return keys.where(F.length("path") >= F.col("chars")).select(
        "host", "path", F.concat("end", F.substr("path", F.lit(1), F.col("chars"))).alias("key"))


def filter_urls(pages: DataFrame, listed: DataFrame, *, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow", max_blocks: int = MAX_BLOCKS, max_shapes: int = 256) -> DataFrame:
    """``host``, ``path``, ``entry`` (the listed one that won, else null) and ``verdict`` of every page.

    ``listed`` has ``entry`` (host, then a path that begins with ``/``, or a host alone for all its paths),
    ``verdict`` and ``priority``. Among the fitting entries the highest priority wins, then the longest entry, then the
    first in order. Null and empty entries are skipped; repeated ones count once, with their highest priority. A null URL
    or one without ``://`` has an empty host and path and the default verdict. Rows are kept one by one, also with
    equal or no ids; other columns are ignored, and a URL that very many rows share is met on its own by spreading
    them. A list with more than ``max_shapes`` shapes is looked up host first, with the same result.
    """
    host = F.substring_index("entry", "/", 1)
    entries = listed.where("entry <> ''").groupBy("entry").agg(
        F.max(F.struct("priority", "verdict")).alias("v")).select(
        F.col("entry").alias("key"), "v.priority", "v.verdict", host.alias("end"),
        F.size(F.split(host, r"\.")).alias("labels"), (F.length("entry") - F.length(host)).alias("chars"))
    entries = stage(entries, "listed")
    blocks = max(1, min(max_blocks, entries.count() // 16))
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    keys = look_ups(rows.select("host", "path").where("host <> '' OR path <> ''"), entries, blocks, max_shapes)
    hits = passed(keys, entries.select("key"), "key", blocks).distinct()
    exact = hits.join(entries.select("key", "priority", "verdict"), "key")
    best = exact.groupBy("host", "path").agg(F.max_by(
        F.struct(F.col("key").alias("entry"), "verdict"), F.struct("priority", F.length("key"))).alias("best"))
    best = stage(best.select("host", "path", "best.entry", "best.verdict"), "verdicts")
    return lookup_join(rows, best, ["host", "path"], "id", broadcast_rows=BROADCAST_URLS).select(
        F.col("id").alias(id_col), "host", "path", "entry", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def _last_labels(host: Column, labels: Column) -> Column:
    """The last labels of a host; a host with fewer gives itself."""
    parts = F.split(host, r"\.")
    n = F.least(F.size(parts), labels)
    return F.array_join(F.slice(parts, F.size(parts) - n + 1, n), ".")
