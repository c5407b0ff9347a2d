"""Splits by time and by customer, and the segments used in drills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelwise.functions.order_stats import locate, values
from parcelwise.functions.scalar import hash_key

# Fixed values.
TRAIN_SHARE = 0.70
TRAIN_AND_VAL_SHARE = 0.85
NORTH_STATES = ["AC", "AP", "AM", "PA", "RO", "RR", "TO"]
SALE_WEEK = ("2017-11-20", "2017-11-27")
SEED = 42
# The side of rows that have no time or no group.
UNPLACED = "unplaced"


def time_cuts(
    df: DataFrame, shares=(TRAIN_SHARE, TRAIN_AND_VAL_SHARE), ts: str = "order_purchase_timestamp", key: str = "order_id"
) -> list[tuple[int, int] | None]:
    """Where the ordered rows are cut: the (time, key hash) of the first row after each share.

    Rows of the same moment are ordered by a hash of their key. Only the cut rows come to the driver,
    so the split itself is a plain filter on the table and the wide rows are never sorted or shuffled.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    found = locate(values(df, micros), [f"floor(_total * {float(s)!r}D)" for s in shares]).first()
    moments = [found[f"_v{i}"] if found else None for i in range(len(shares))]
    known = [(i, m, found[f"_skip{i}"]) for i, m in enumerate(moments) if m is not None]
    cuts: list[tuple[int, int] | None] = [None] * len(shares)  # None: the share covers every row
    if not known:
        return cuts
    same = df.select(micros.alias("_m"), hash_key(key).alias("_key")).where(F.col("_m").isin([m for _, m, _ in known]))
    ranks = [f"CASE WHEN _m = {m} THEN {skip} END" for _, m, skip in known]
    ties = {r["_m"]: r for r in locate(values(same, "_key", ["_m"]), ranks, ["_m"], few=True).collect()}
    for j, (i, moment, _) in enumerate(known):
        cuts[i] = (moment, ties[moment][f"_v{j}"])
    return cuts


def _before(cut, ts: str, key: str) -> Column:
    """Whether a row comes before the cut row."""
    if cut is None:
        return F.lit(True)
    moment, tie = F.timestamp_micros(F.lit(cut[0])), cut[1]
    at = F.col(ts).cast("timestamp")
    return (at < moment) | ((at == moment) & (hash_key(key) < tie))


def split_label(cuts, ts: str = "order_purchase_timestamp", key: str = "order_id") -> Column:
    """``train``, ``val`` or ``test`` by the cuts of :func:`time_cuts`."""
    first, second = (_before(cut, ts, key) for cut in cuts)
    return F.when(first, "train").when(second, "val").otherwise("test")


def time_split(df: DataFrame, ts: str = "order_purchase_timestamp", key: str = "order_id") -> DataFrame:
    """Add ``split``: the first 70 % by purchase time train, the next 15 % validate, the rest test.

    Rows without a time cannot be placed; they stay, as ``unplaced``.
    """
    cuts = time_cuts(df.where(F.col(ts).isNotNull()), ts=ts, key=key)
    return df.withColumn("split", F.when(F.col(ts).isNull(), UNPLACED).otherwise(split_label(cuts, ts, key)))


def time_parts(df: DataFrame, ts: str = "order_purchase_timestamp", key: str = "order_id") -> dict[str, DataFrame]:
    """The parts of :func:`time_split` as tables of their own, ``unplaced`` among them.

    Each of the three others carries plain bounds on the purchase time, which the scan can use to skip row groups.
    """
    known = df.where(F.col(ts).isNotNull())
    cuts = time_cuts(known, ts=ts, key=key)
    at = F.col(ts).cast("timestamp")
    label = split_label(cuts, ts, key)
    edges = {"train": (None, cuts[0]), "val": cuts, "test": (cuts[1], None)}
    parts = {}
    for name, (start, stop) in edges.items():
        part = known
        if start is not None:
            part = part.where(at >= F.timestamp_micros(F.lit(start[0])))
        if stop is not None:
            part = part.where(at <= F.timestamp_micros(F.lit(stop[0])))
        parts[name] = part.where(label == name).withColumn("split", F.lit(name))
    parts[UNPLACED] = df.where(F.col(ts).isNull()).withColumn("split", F.lit(UNPLACED))
    return parts


def group_split(df: DataFrame, group: str, test_share: float = 0.2, seed: int = SEED) -> DataFrame:
    """Add ``split`` so that all rows of a group are on one side: a share of the groups, rounded up, tests.

    The groups are put in hash order, and the hash of the last test group is the cut. Rows without a group
    stay, as ``unplaced``.
    """
    order = hash_key(group, seed=seed)
    groups = df.select(group).where(F.col(group).isNotNull()).distinct()
    last = locate(values(groups, order), [f"ceil(_total * {float(test_share)!r}D) - 1"])
    cut = last.select("_v0").scalar()
    side = F.when(F.col(group).isNull(), UNPLACED).when(order <= cut, "test").otherwise("train")
    return df.withColumn("split", side)


def split_overlap(split: DataFrame, group: str) -> DataFrame:
    """One row: how many groups are on both sides (it has to be none)."""
    side = lambda name: split.where(F.col("split") == name).select(group)
    return side("train").intersect(side("test")).agg(F.count("*").alias("n_shared"))


def in_north() -> Column:
    return F.col("customer_state").isin(*NORTH_STATES)


def in_days(first: str, last: str, ts: str = "order_purchase_timestamp") -> Column:
    """Whole days, both ends included."""
    start = F.lit(first).cast("timestamp")
    stop = F.lit(last).cast("timestamp") + F.make_interval(days=F.lit(1))
    return (F.col(ts) >= start) & (F.col(ts) < stop)


def north_orders(df: DataFrame) -> DataFrame:
    return df.where(in_north())


def sale_week_orders(df: DataFrame, first: str = SALE_WEEK[0], last: str = SALE_WEEK[1]) -> DataFrame:
    return df.where(in_days(first, last))
