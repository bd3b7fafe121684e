"""Near-duplicate documents by SuperMinHash.

A signature holds, for each of its slots, the smallest of the values that the elements give it.
The ranks an element gives are those of one random permutation: at step ``j`` it gives slot
``p[j]`` a value in ``[j, j + 1)``, so each slot gets one value of each element and the signature
varies less than with independent hashes. A value of a later step can never beat one of an
earlier step, so once all slots are filled the search stops; long texts need one step.

Documents with equal sets become one class. Classes that share a band of their signatures are
candidates. In a bucket, all are compared with its most central member, and pairs that this puts into one
component need no more comparison. For buckets whose members stay in several components, the prefixes
of their shingle sets say exactly which pairs are still to be compared, so no link between members of a
bucket is lost and no bucket is written out in pairs. A link counts when the full sets confirm it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegrid.llm.batches import small_batches
from tidegrid.llm.components import components
from tidegrid.llm.shingles import GOLDEN, U, mix, shingle_sets
from tidegrid.llm.word_encoder import in_groups
from tidegrid.sources.stage import stage

EMPTY = U(0xFFFFFFFFFFFFFFFF)
LOW = U(0xFFFFFFFF)
#: What two sets must have in common to be compared: a shingle, bands of sizes, a place among the groups, a salt.
MEET = ["token", "x", "y", "bit", "above", "turn", "salt"]
FULL_MEETING = 4_000_000
MOST_SALTS = 64


def super_minhash(elements: np.ndarray, counts: np.ndarray, slots: int) -> np.ndarray:
    """Signatures, one row for each set; ``elements`` holds the sets one after the other."""
    out = np.full((len(counts), slots), EMPTY, np.uint64)
    flat = out.ravel()
    owner = np.repeat(np.arange(len(counts)), counts)
    places = None
    for step in range(slots):
        if not len(elements):
            break
        draw = mix(elements + U((step + 1) * int(GOLDEN) & int(EMPTY)))
        value = (U(step) << U(32)) | (draw & LOW)
        to = step + ((draw >> U(32)) * U(slots - step) >> U(32)).astype(np.int64)
        if step == 0:
            slot = to
        else:
            slot = places[rows, to]
        np.minimum.at(flat, owner * slots + slot, value)
        open_sets = (out == EMPTY).any(axis=1)
        keep = open_sets[owner]
        if not keep.any():
            break
        if step == 0:
            elements, owner, to = elements[keep], owner[keep], to[keep]
            places = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(elements), 1))
            rows = np.arange(len(elements))
            places[rows, to] = 0
        else:
            places[rows, to] = places[:, step]
            if not keep.all():
                elements, owner, places = elements[keep], owner[keep], places[keep]
                rows = np.arange(len(elements))
    return out


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A hash for each band of each signature, with the band's number in it."""
    n, slots = signatures.shape
    parts = signatures.reshape(n, bands, slots // bands)
    key = np.zeros((n, bands), np.uint64) + np.arange(1, bands + 1, dtype=np.uint64) * GOLDEN
    for j in range(parts.shape[2]):
        key = mix(key ^ parts[:, :, j]) + GOLDEN
    return key


def _signatures(bands: int, rows: int, size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in in_groups(texts, 1_000_000):
                sets, counts = shingle_sets(texts[a:b], size)
                keys = band_keys(super_minhash(sets, counts, bands * rows), bands)
                ends = np.concatenate([[0], np.cumsum(counts)])
                two = [np.concatenate([[U(0)], np.cumsum(mix(sets * U(k)), dtype=np.uint64)]) for k in (3, 5)]
                digest = [(t[ends[1:]] - t[ends[:-1]]).view(np.int64) for t in two]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(counts), pa.array(digest[0]), pa.array(digest[1]),
                     pa.ListArray.from_arrays(np.arange(b - a + 1, dtype=np.int32) * bands, keys.ravel().view(np.int64))],
                    ["id", "n", "d1", "d2", "keys"])
    return run


def _confirm(size: int, percent: int):
    """Keeps the pairs whose full sets are similar enough."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            a, b, left, right = (c.to_pylist() for c in batch.columns)
            good = np.zeros(len(a), bool)
            for begin, end in in_groups(left, 1_000_000):
                sets, counts = shingle_sets(left[begin:end], size)
                own = np.split(sets, np.cumsum(counts)[:-1])
                for i, x in zip(range(begin, end), own):
                    if b[i] not in known:
                        if len(known) >= 64:
                            known.clear()
                        known[b[i]] = shingle_sets([right[i]], size)[0]
                    y = known[b[i]]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good)) for c in batch.columns[:2]], ["a", "b"])
    return run


def _tokens(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for a, b in in_groups(texts, 1_000_000):
                sets, counts = shingle_sets(texts[a:b], size)
                at = pa.array(np.repeat(np.arange(a, b), counts))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(sets.view(np.int64)),
                                                  pa.array(np.repeat(counts, counts))], ["id", "g", "token", "n"])
    return run


def _prefix_pairs(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of different ``g`` that may be similar, found by prefix and position of their rarest shingles.

    Shingles are ordered from the rarest on. Of two similar sets, the first shingle they share stands so far in front in
    both that enough can follow; a pair without such a shingle can't reach the threshold. Copies of one text
    that were edited a little too much differ in their rarest shingles, so they meet nobody. A shingle that very many
    share is no hot key, see :func:`_meetings`.
    """
    tokens = stage(docs.mapInArrow(_tokens(size), "id long, g long, token long, n long"), "tokens")
    shared = stage(tokens.groupBy("token").agg(F.count("*").alias("c")).where("c > 1"), "shared_tokens")
    common = tokens.join(shared, "token")
    own = Window.partitionBy("id")
    # shingles that only this set has come first, whatever their order
    place = F.row_number().over(own.orderBy("c", "token")) - 1 + F.col("n") - F.count("*").over(own)
    front = common.withColumn("room", F.col("n") - place).where(f"100 * room >= {percent} * n")
    front = stage(front.select("id", "g", "token", "n", "room"), "prefixes")
    left, right = _meetings(front, percent)
    return left.join(right, MEET).where(
        "(na < nb OR na = nb AND ida < idb) AND nb <= capa AND na <= capb").select(
        F.col("ida").alias("a"), F.col("idb").alias("b")).distinct()


def _meetings(front: DataFrame, percent: int, full: int = FULL_MEETING) -> tuple[DataFrame, DataFrame]:
    """The smaller and the larger set of each pair, with the key ``MEET`` under which just the right ones meet.

    Where a shared shingle stands bounds the size of the other set (``cap``), so each set goes to bands of sizes that it can
    be paired with, the smaller one only while its place still allows a set of its own size. Sets of one ``g`` are told
    apart from no other: the groups that meet are numbered, and two numbers meet at the highest bit
    in which they differ, so sets of one group never do. What would still be more than ``full``
    comparisons is split by a salt.
    """
    def band(c: str) -> Column:
        return F.floor(F.log(F.col(c)) / F.log(F.lit(1.05))).cast("int")

    rows = front.selectExpr("token", "id", "g", "n", f"{100 + percent} * room div {percent} - n AS cap")
    small = rows.withColumn("hi", F.expr(f"least(cap, 100 * n div {percent})")).where("hi >= n").select(
        "token", band("n").alias("x"), F.explode(F.sequence(band("n"), band("hi"))).alias("y"), "id", "g", "n", "cap", F.lit(0).alias("large"))
    large = rows.withColumns({"lo": F.expr(f"({percent} * n + 99) div 100"), "hi": F.least("n", "cap")}).where("hi >= lo").select(
        "token", F.explode(F.sequence(band("lo"), band("hi"))).alias("x"), band("n").alias("y"), "id", "g", "n", "cap", F.lit(1).alias("large"))
    both = stage(small.unionByName(large), "meetings")
    key = ["token", "x", "y"]
    of_key = Window.partitionBy(*key)
    groups = both.groupBy(*key, "g").agg(F.count_if(F.col("large") == 0).alias("s"), F.count_if(F.col("large") == 1).alias("l"))
    groups = groups.select(
        *key, "g", (F.row_number().over(of_key.orderBy("g")) - 1).alias("no"), F.count("*").over(of_key).alias("groups"),
        F.sum("s").over(of_key).alias("s"), F.sum("l").over(of_key).alias("l")).where("groups > 1 AND s > 0 AND l > 0")
    groups = stage(groups.selectExpr(*key, "g", "no", "length(bin(groups - 1)) AS bits",
                                     f"cast(least({MOST_SALTS}, 1 + s * l div {full}) AS int) AS salts"), "meeting_groups")
    met = both.join(groups, [*key, "g"]).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("bits") - 1)).alias("bit")).withColumns(
        {"above": F.expr("shiftright(no, bit + 1)"), "turn": F.expr("(shiftright(no, bit) & 1) ^ large")})
    left = met.where("large = 0").withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int"))
    right = met.where("large = 1").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    return tuple(side.select(*MEET, *[F.col(c).alias(c + x) for c in ("id", "n", "cap")]) for side, x in ((left, "a"), (right, "b")))


def near_duplicates(docs: DataFrame, *, percent: int = 75, shingle: int = 5, bands: int = 32, rows: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``n_shingles``, ``component_id`` and ``kept`` of every document.

    Documents are linked when their sets of ``shingle``-word shingles have
    ``100 * intersection >= percent * union``; ``component_id`` is the smallest id reachable, and the
    document with that id is kept. A pair just at 75 percent shares none of 32 bands of 4
    slots with a chance of 5 in a million; more similar pairs are missed less often.

    A null text is empty. A text without words is linked with nothing. Ids are integers and should be unique:
    rows that share one are classed by their own texts and have the links of all of them. Rows without
    an id are kept, with no component. Other columns are ignored. An empty table gives no rows.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stage(texts.mapInArrow(_signatures(bands, rows, shingle),
                                    "id long, n long, d1 long, d2 long, keys array<long>"), "signed")
    full = signed.where("n > 0 AND id IS NOT NULL")
    classes = stage(full.groupBy("n", "d1", "d2").agg(F.min("id").alias("rep")), "classes")
    heads = full.join(classes.select("rep", F.col("n").alias("rn"), F.col("d1").alias("r1"), F.col("d2").alias("r2")),
                      (F.col("id") == F.col("rep")) & (F.col("n") == F.col("rn")) & (F.col("d1") == F.col("r1"))
                      & (F.col("d2") == F.col("r2")))
    keys = stage(heads.select("rep", "n", F.explode("keys").alias("key")), "keys")
    shared = stage(keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1"), "shared")
    members = stage(keys.join(shared, "key"), "members")
    weight = stage(members.groupBy("rep").agg(F.sum("c").alias("w")), "weights")
    members = stage(members.join(weight, "rep"), "members")
    candidates = stage(texts.where("id IS NOT NULL").join(
        weight.select(F.col("rep").alias("id")), "id", "left_semi"), "candidates")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left = candidates.select(F.col("id").alias("a"), F.col("text").alias("x"))
        right = candidates.select(F.col("id").alias("b"), F.col("text").alias("y"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
        return both.sortWithinPartitions("b").mapInArrow(_confirm(shingle, percent), "a long, b long")

    similar = (f"100 * least(n, m) >= {percent} * greatest(n, m)")
    hubs = members.groupBy("key").agg(F.max(F.struct("w", "rep", "n")).alias("hub")).select(
        "key", F.col("hub.rep").alias("b"), F.col("hub.n").alias("m"))
    hubs = stage(hubs, "hubs")
    tried = stage(members.withColumnRenamed("rep", "a").join(hubs, "key").where(f"a <> b AND {similar}")
                  .select("a", "b").distinct(), "pairs")
    links = stage(confirmed(tried), "links")
    groups = components(links)

    # what the hubs left open: members of a bucket that are in different components
    label = stage(members.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", F.coalesce("component", "rep").alias("g")), "labels")
    mixed = stage(label.groupBy("key").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.count("*").alias("c"))
                  .where("lo <> hi AND c > 2").select("key"), "mixed")
    if not mixed.isEmpty():
        left = stage(label.join(mixed, "key").select("rep", "g").distinct(), "open")
        more = _prefix_pairs(candidates.join(left.withColumnRenamed("rep", "id"), "id").select("id", "g", "text"), shingle, percent)
        done = tried.select("a", "b").unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
        more = stage(more.join(done, ["a", "b"], "left_anti"), "pairs")
        links = links.unionByName(stage(confirmed(more), "links"))
        groups = components(links)

    best = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "n", "d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    best = stage(best, "best")
    found = full.join(best, ["n", "d1", "d2"]).select("id", "n", "component_id")
    alone = signed.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return found.unionByName(alone).select(
        F.col("id").cast(id_type).alias(id_col), F.col("n").alias("n_shingles"),
        F.col("component_id").cast(id_type).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
