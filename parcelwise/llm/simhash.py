"""SimHash near-duplicates by covering locality-sensitive hashing.

A 64-bit fingerprint per text; two texts are linked when theirs differ in ``radius`` bits at most. The candidate
search cannot miss a pair: every bit gets a non-zero vector of radius + 1 bits, and each non-zero vector v of
that length gives a table whose mask holds the bits with an odd inner product with v. The vectors of at most
``radius`` differing bits never span the whole space, so some v is orthogonal to all of them, and in the table
of that v the two masked fingerprints are equal.

Work is done on distinct fingerprints. A bucket of a table is small: then it is compared in a task, which hands on a
spanning forest of its links. Or it is large: then it is not compared at all. Each member is sent to all points within
2 of it (of the bits outside the mask), and at a point the members meet a hub that lies within 1 of it. Two
members with at most 3 differing bits always share such a point, and hub and member differ in 3 at most,
so the links to hubs connect exactly what all links would. Both ways, the links grow with the members, not with their pairs.

Defined cases: a null text has no words; a text without words has fingerprint zero and is linked like any other;
equal rows all stay in ``classes`` (only ``survivors`` keeps one); a null doc_id never names a component unless all
are null; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from parcelwise.llm.common import TO_LOWER, pieces, text_key, texts, with_fields, without
from parcelwise.llm.components import connected
from parcelwise.session import cut_lineage

SEED = 42
SHINGLE = 3
RADIUS = 3
# Buckets with more distinct fingerprints go the way without comparisons.
SMALL_BUCKET = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned SimHash of a text: the majority of each bit over the hashes of its shingles."""
    words = text.translate(TO_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *stops[:-1]]
    hashes = [xxh64_intdigest(line[a : b - 1], seed) for a, b in zip(starts, stops[shingle - 1 :] or stops[-1:])]
    bits = np.array(hashes, dtype=np.uint64)
    # In blocks, so that a very long text takes no more memory than a short one.
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(bits), 8192):
        block = bits[at : at + 8192].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(bits)).tobytes(), "big")


def fingerprints(df: DataFrame, text: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """The table with the fingerprint of a text column, as the long of the same 64 bits."""
    rows = without(df, [name])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in pieces(batch, text):
                found = np.array([fingerprint(t, shingle) for t in texts(batch, text, start, stop)], dtype=np.uint64)
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found.view(np.int64))], names=[*part.schema.names, name]
                )

    return rows.mapInArrow(work, with_fields(rows, f"`{name}` LONG"))


def masks(radius: int = RADIUS) -> list[int]:
    """The bit mask of every table, as unsigned numbers."""
    size = (1 << (radius + 1)) - 1
    vectors = [1 + bit % size for bit in range(64)]
    return [sum(1 << bit for bit, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def forest(members: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the members of a bucket as all their links would: each new one by one link to a known one."""
    waiting = members
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    while len(waiting):
        reached, waiting = waiting[:1], waiting[1:]
        while len(reached) and len(waiting):
            at, reached = reached[0], reached[1:]
            near = np.bitwise_count(waiting ^ at) <= radius
            if near.any():
                new = waiting[near]
                left.append(np.full(len(new), at))
                right.append(new)
                reached, waiting = np.concatenate([reached, new]), waiting[~near]
    none = np.zeros(0, dtype=members.dtype)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _inside(buckets: DataFrame, radius: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column("members")
            values, stops = cells.values.to_numpy().view(np.uint64), cells.offsets.to_numpy()
            pairs = [forest(np.sort(values[a:b]), radius) for a, b in zip(stops[:-1], stops[1:])]
            out = [np.concatenate([p[i] for p in pairs] or [values[:0]]).view(np.int64) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["a", "b"])

    return buckets.select("members").mapInArrow(work, "a LONG, b LONG")


def _through_points(members: DataFrame, radius: int) -> DataFrame:
    """Links of large buckets: through points within radius - 1 of a member and 1 of a hub."""
    if radius not in (2, 3):
        raise ValueError("large buckets are linked for a radius of 2 or 3")
    reach = radius - 1
    by_table = F.create_map(
        *[
            x
            for v, mask in enumerate(masks(radius))
            for x in (F.lit(v), F.array(*[F.lit(_signed(1 << b)) for b in range(64) if not mask >> b & 1]))
        ]
    )
    free = members.withColumn("_free", F.element_at(by_table, F.col("table")))
    one = F.transform("_free", lambda x: F.struct(x.alias("flip"), F.lit(1).alias("steps")))
    moves = F.concat(F.array(F.struct(F.lit(0).cast("long").alias("flip"), F.lit(0).alias("steps"))), one)
    if reach == 2:
        two = F.flatten(
            F.transform(
                "_free",
                lambda x, i: F.transform(
                    F.slice("_free", i + 2, F.size("_free")),
                    lambda y: F.struct(x.bitwiseXOR(y).alias("flip"), F.lit(2).alias("steps")),
                ),
            )
        )
        moves = F.concat(moves, two)
    points = free.select("table", "fp", F.explode(moves).alias("m")).select(
        "table", F.col("fp").bitwiseXOR(F.col("m.flip")).alias("point"), "fp", "m.steps"
    )
    hub = points.where("steps <= 1").groupBy("table", "point").agg(F.min("fp").alias("hub"))
    return points.join(hub, ["table", "point"]).where("fp <> hub").selectExpr("hub AS a", "fp AS b").distinct()


def links(prints: DataFrame, radius: int = RADIUS, small: int = SMALL_BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect whatever lies within the radius.

    ``prints`` has one column ``fp`` of distinct longs.
    """
    cells = F.array(
        *[
            F.struct(F.lit(v).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for v, mask in enumerate(masks(radius))
        ]
    )
    placed = prints.select("fp", F.explode(cells).alias("t")).select("t.table", "t.key", "fp")
    sizes = placed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = cut_lineage(placed.join(sizes, ["table", "key"]), "simhash-buckets")
    few = placed.where(f"n <= {small}").groupBy("table", "key").agg(F.collect_list("fp").alias("members"))
    found = _inside(few, radius)
    if not placed.where(f"n > {small}").isEmpty():
        found = found.unionAll(_through_points(placed.where(f"n > {small}"), radius))
    return found.distinct()


def grouped(prints: DataFrame, radius: int = RADIUS, small: int = SMALL_BUCKET) -> DataFrame:
    """Of rows with a ``fingerprint`` and a ``doc_id``: ``fingerprint`` and ``component_id``, one row each."""
    distinct = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least"))
    distinct = cut_lineage(distinct, "simhash-prints")
    found = connected(links(distinct.select("fp"), radius, small), "a", "b")
    rooted = distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root").selectExpr("fp AS fingerprint", "component_id")


def classes(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, small: int = SMALL_BUCKET) -> DataFrame:
    """One row per document: doc_id, text_key, fingerprint (long) and component_id.

    A fingerprint may belong to a third of all documents: its component is found once, and adaptive
    execution splits that key when documents and components meet.
    """
    rows = docs.select("doc_id", "text", text_key("text").alias("text_key"))
    prints = cut_lineage(fingerprints(rows, "text", "fingerprint", shingle).drop("text"), "simhash-documents")
    return prints.join(grouped(prints, radius, small), "fingerprint").select(
        "doc_id", "text_key", "fingerprint", "component_id"
    )


def as_hex(fingerprint: str | Column) -> Column:
    """16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def survivors(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without near-duplicates: of every group the one with the least doc_id stays, as one row."""
    found = classes(docs, shingle, radius)
    # One candidate per (doc_id, text); the number of its rows tells whether equal rows must be folded.
    named = found.groupBy("component_id", "fingerprint", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    best = named.groupBy("component_id").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint", "text_key")).alias("best")
    )
    best = cut_lineage(best.select("component_id", "best.doc_id", "best.text_key"), "simhash-best")
    keep = best.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("_key").eqNullSafe(text_key("text"))
    kept = docs.join(keep, same, "left_semi")
    twice = cut_lineage(
        named.where("rows > 1").select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).distinct(),
        "simhash-twice",
    )
    if twice.isEmpty():
        return kept
    folded = kept.join(twice, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(twice, same, "left_anti").unionByName(folded)
