"""Ranked lexical search by pipelined term partitioning.

One pass over the documents writes postings of the items' terms, by shard of documents: a few tens of megabytes of consecutive
texts of a task. The terms belong to ``OWNERS`` owners, the rarest to the first, with about equally many postings each. For every shard, the
bundle of items goes through the owners one after the other: a stage cogroups the bundle's sparse accumulators (documents with their
scores so far) with the owner's postings of that shard, adds the integer contributions and hands the bundle on. The last
stage selects each item's best of the shard, and those meet in the final selection.

A stage drops accumulators that cannot come among the item's best any more: the k-th best score so far is one that
at least k documents of the shard will reach, and what later owners can add has a bound from the largest frequency of each of
their terms. For the same reason a late owner opens no accumulator that it could not win with. Nothing that could rank is dropped, equal
scores included.

The items go to the executors in blocks of at most ``BLOCK_BYTES`` of text, one pass over the documents each; one block is the usual
case. A document's weight of length, the term weights and contributions are the integers of the ranking contract.

Defined cases: null or wordless texts are no documents, null or wordless items find nothing; every row is a document of its own, so
repeated rows rank one after the other; equal scores come by ascending doc_id (a null one first); equal rows of
items are one item; other columns of either table play no part; an empty table on either side gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelwise.llm.common import pieces, share, shared, texts
from parcelwise.llm.fmindex import words_of
from parcelwise.session import cut_lineage

BEST = 20
OWNERS = 4
BLOCK_BYTES = 8 << 20
# Texts of one shard: bounds what a stage holds of it.
SHARD_BYTES = 32 << 20

# Fixed values of the ranking: contributions, and how much of a document's length counts.
SCALE, PER_TERM, PER_LENGTH, FIXED, RELATIVE = 1_000_000_000, 1000, 12, 75, 25

POSTINGS = "shard LONG, term INT, doc ARRAY<INT>, tf ARRAY<INT>, ids ARRAY<LONG>"
BUNDLES = "shard LONG, item INT, doc ARRAY<INT>, score ARRAY<LONG>"
FOUND = "item INT, doc_id LONG, score LONG"
# The row of a shard that lists its documents: their numbers of terms as frequencies, and their names.
LIST = -1


def item_blocks(items: DataFrame, item_id: str, text: str, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The distinct (name, text) in blocks of bounded size, one at a time."""
    rows = items.select(F.col(item_id).alias("item_id"), F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text") + 64).alias("size")).first()["size"] or 0
    count = int(size // block_bytes) + 1
    for block in range(count):
        own = rows if count == 1 else rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield [(r["item_id"], r["text"].encode()) for r in own.collect()]


class Shard:
    """Documents of a task on their way into postings."""

    def __init__(self, number: int):
        self.number = number
        self.terms: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.ids: list[int | None] = []
        self.bytes = 0

    def add(self, doc_id: int | None, words: list[bytes], get) -> None:
        own = np.fromiter(map(get, words, repeat(LIST)), np.int32, len(words))
        own = own[own >= 0]
        self.terms.append(own)
        self.docs.append(np.full(len(own), len(self.sizes), np.int32))
        self.sizes.append(len(words))
        self.ids.append(doc_id)

    def rows(self) -> pa.RecordBatch:
        """The list of the shard's documents, then one row per term."""
        size = len(self.sizes)
        code = np.concatenate(self.terms).astype(np.int64) * size + np.concatenate(self.docs)
        code, tf = np.unique(code, return_counts=True)
        term, doc = code // size, (code % size).astype(np.int32)
        starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
        offsets = np.concatenate([[0, 0], starts[1:], [len(doc)]] if len(doc) else [[0, 0]]).astype(np.int32)
        sizes = np.array(self.sizes, np.int32)
        docs = pa.ListArray.from_arrays(pa.array(offsets), pa.array(doc))
        tfs = pa.ListArray.from_arrays(pa.array(np.concatenate([offsets[:1], offsets[1:] + size]).astype(np.int32)),
                                       pa.array(np.concatenate([sizes, tf.astype(np.int32)])))
        ids = pa.array([self.ids, *[None] * len(starts)], pa.list_(pa.int64()))
        terms = np.concatenate([[LIST], term[starts]]).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(terms), self.number, np.int64)), pa.array(terms), docs, tfs, ids],
            names=["shard", "term", "doc", "tf", "ids"],
        )


def postings(docs: DataFrame, number: dict[bytes, int], shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per shard a row that lists its documents and a row per term of ``number`` that occurs in it.

    ``docs`` has (doc_id, text); only documents with a word are listed.
    """
    sent = share(docs, number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared(sent).get
        number = TaskContext.get().partitionId() << 32
        shard = Shard(number)
        for batch in batches:
            for start, stop in pieces(batch, "text"):
                names = batch.column("doc_id").slice(start, stop - start).to_pylist()
                for name, text in zip(names, texts(batch, "text", start, stop)):
                    if words := words_of(text):
                        shard.add(name, words, get)
                        shard.bytes += len(text)
                        if shard.bytes >= shard_bytes:
                            yield shard.rows()
                            number += 1
                            shard = Shard(number)
        if shard.sizes:
            yield shard.rows()

    return docs.mapInArrow(work, POSTINGS)


class Plan:
    """What the owners know: term weights, which items ask for which terms, and what later owners can add at most."""

    def __init__(self, items: list[Counter], stats: dict[int, tuple[int, int]], n_docs: int, n_words: int, owners: int):
        self.n_docs, self.n_words = n_docs, n_words
        self.weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for t, (df, _) in stats.items()}
        # The shortest document has the largest contribution.
        most = {t: self.weight[t] * (SCALE * tf // (PER_TERM * tf + PER_LENGTH * FIXED)) for t, (_, tf) in stats.items()}
        order = sorted((t for t, w in self.weight.items() if w > 0), key=lambda t: (stats[t][0], t))
        total, at = sum(stats[t][0] for t in order), 0
        self.owner = {}
        for t in order:
            self.owner[t] = (2 * at + stats[t][0]) * owners // (2 * total)  # by the middle of its postings
            at += stats[t][0]
        self.asks: list[dict[int, list[tuple[int, int]]]] = [{} for _ in range(owners)]
        # above[s][item]: the most that the owners from s on can add.
        self.above = [[0] * len(items) for _ in range(owners + 1)]
        for i, terms in enumerate(items):
            for t, times in terms.items():
                if t in self.owner:
                    self.asks[self.owner[t]].setdefault(i, []).append((t, times))
                    self.above[self.owner[t]][i] += times * most[t]
        for s in range(owners - 1, -1, -1):
            self.above[s] = [a + b for a, b in zip(self.above[s], self.above[s + 1])]

    def contributions(self, term: int, tf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What a term adds to the documents that hold it, ``sizes`` being their numbers of words."""
        length = FIXED + RELATIVE * sizes * self.n_docs // self.n_words
        return self.weight[term] * (SCALE * tf // (PER_TERM * tf + PER_LENGTH * length))


def least_of_best(scores: np.ndarray, best: int) -> int:
    """The ``best``-th largest score; with fewer of them there is no bound yet."""
    return int(np.partition(scores, len(scores) - best)[len(scores) - best]) if len(scores) >= best else 0


def lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    """The lists of a column as arrays."""
    out = []
    for chunk in column.chunks:
        flat, offsets = chunk.values.to_numpy(), chunk.offsets.to_numpy()
        out += [flat[a:b] for a, b in zip(offsets, offsets[1:])]
    return out


def pass_owner(plan: Plan, stage: int, best: int, bundles: pa.Table, own: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The bundle of a shard after an owner: (item, documents, scores) with at least one document each."""
    terms = own.column("term").to_pylist()
    docs, tfs = lists(own.column("doc")), lists(own.column("tf"))
    sizes = tfs[terms.index(LIST)].astype(np.int64)
    adds = {
        t: (d, plan.contributions(t, tf.astype(np.int64), sizes[d])) for t, d, tf in zip(terms, docs, tfs) if t != LIST
    }
    items = bundles.column("item").to_pylist()
    carried = dict(zip(items, zip(lists(bundles.column("doc")), lists(bundles.column("score")))))
    none = np.zeros(0, np.int32), np.zeros(0, np.int64)
    out = []
    for item in sorted({*carried, *plan.asks[stage]}):
        doc, score = carried.get(item, none)
        own_terms = [(adds[t], times) for t, times in plan.asks[stage].get(item, ()) if t in adds]
        if own_terms:
            total = np.zeros(len(sizes), np.int64)
            total[doc] = score
            for (d, add), times in own_terms:
                total[d] += times * add
            # New documents come in only if they could still be among the best.
            if plan.above[stage][item] >= least_of_best(score, best):
                doc = np.flatnonzero(total).astype(np.int32)
            score = total[doc]
        rest = plan.above[stage + 1][item]
        if len(doc):
            keep = score + rest >= max(1, least_of_best(score, best))
            doc, score = doc[keep], score[keep]
        if len(doc):
            out.append((item, doc, score))
    return out


def as_lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def passed_on(shard: int, found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.Table:
    """What a stage hands on, as rows of ``BUNDLES``."""
    return pa.table({
        "shard": pa.array([shard] * len(found), pa.int64()),
        "item": pa.array([f[0] for f in found], pa.int32()),
        "doc": as_lists([f[1] for f in found], pa.int32()),
        "score": as_lists([f[2] for f in found], pa.int64()),
    })


def selected(ids: pa.Array, found: list[tuple[int, np.ndarray, np.ndarray]], best: int) -> pa.Table:
    """The best documents of a shard for every item, by name, as rows of ``FOUND``."""
    order = [("score", "descending"), ("doc_id", "ascending")]
    out = [pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())]).empty_table()]
    for item, doc, score in found:
        rows = pa.table({"item": pa.array([item] * len(doc), pa.int32()), "doc_id": ids.take(pa.array(doc)), "score": pa.array(score)})
        out.append(rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start").slice(0, best)))
    return pa.concat_tables(out)


def at_owner(sent, stage: int, best: int, last: bool):
    """The work of an owner on the bundle of one shard."""

    def work(bundles: pa.Table, own: pa.Table) -> pa.Table:
        found = pass_owner(shared(sent), stage, best, bundles, own)
        if not last:
            return passed_on(own.column("shard")[0].as_py(), found)
        return selected(own.column("ids")[own.column("term").to_pylist().index(LIST)].values, found, best)

    return work


def search_block(
    docs: DataFrame, block: list[tuple], best: int, owners: int, shard_bytes: int
) -> tuple[DataFrame, list] | None:
    """The best documents of every shard for the items of a block, and the names of the items; nothing without a term."""
    number: dict[bytes, int] = {}
    items = [Counter(number.setdefault(w, len(number)) for w in words_of(text)) for _, text in block]
    table = cut_lineage(postings(docs, number, shard_bytes), "term-postings")
    listed = F.col("term") == LIST
    sums = table.where(listed).agg(
        F.sum(F.size("tf")).alias("docs"), F.sum(F.aggregate("tf", F.lit(0).cast("long"), lambda s, n: s + n)).alias("words")
    ).first()
    counts = table.where(~listed).groupBy("term").agg(F.sum(F.size("doc")).alias("df"), F.max(F.array_max("tf")).alias("tf"))
    # A row per term of the block at most.
    stats = {r["term"]: (r["df"], r["tf"]) for r in counts.collect()}
    if not stats:
        return None
    plan = Plan(items, stats, sums["docs"], sums["words"], owners)
    sent = share(docs, plan)
    # A row per term of the block.
    known = docs.sparkSession.createDataFrame(list(plan.owner.items()), "term INT, owner INT")
    owned = table.join(F.broadcast(known), "term")
    bundles = docs.sparkSession.createDataFrame([], BUNDLES)
    for stage in range(owners):
        last = stage == owners - 1
        columns = ["shard", "term", "doc", "tf", *["ids"] * last]
        own = owned.where(F.col("owner") == stage).select(*columns).unionAll(table.where(listed).select(*columns))
        grouped = bundles.groupBy("shard").cogroup(own.groupBy("shard"))
        bundles = grouped.applyInArrow(at_owner(sent, stage, best, last), FOUND if last else BUNDLES)
    return bundles, [name for name, _ in block]


def ranked(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    item_id: str = "item_id",
    text: str = "text",
    owners: int = OWNERS,
    block_bytes: int = BLOCK_BYTES,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """For every item its ``best`` documents with a score above 0: (item_id, rank, doc_id, score).

    ``docs`` has a whole number doc_id and a text; both tables name their text alike.
    """
    spark = docs.sparkSession
    bodies = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).where("text IS NOT NULL")
    kind = items.schema[item_id].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank INT, doc_id LONG, score LONG")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    parts = []
    for block in item_blocks(items, item_id, text, block_bytes):
        got = search_block(bodies, block, best, owners, shard_bytes)
        if got is not None:
            found, names = got
            top = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= best)
            # A row per item of the block.
            named = spark.createDataFrame(list(enumerate(names)), f"item INT, item_id {kind}")
            parts.append(top.join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionAll, parts) if parts else out
