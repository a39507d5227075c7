"""Filling fixed-capacity containers with texts.

Dynamic programming over the histogram of all lengths (at most ``capacity``
bins, however many texts there are) chooses length buckets with the least
padding. Batches are formed bucket by bucket: a container takes items of the
longest bucket first and gives what is left of its token budget to the next
shorter buckets that fit. Batches kept inside one bucket alone leave a quarter
of a container empty wherever items are longer than half of it; passing the
rest on fills it.

Which batches there are follows from the bucket counts alone and is worked out
on the driver in a number of steps that depends on the number of buckets, not
of texts. Texts find their container by their rank within the bucket, computed
from counts per (bucket, salt) and a window within each of some ``SALT_ROWS``
texts, so that no bucket is ever sorted by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

CAPACITY = 2048
BUCKETS = 256
SALT_ROWS = 65_536


def length_buckets(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Upper bounds of the buckets, ascending, that minimise the sum of bound - length."""
    n = len(lengths)
    if n <= buckets:
        return lengths
    many = np.concatenate([[0], np.cumsum(counts)]).astype(np.float64)
    much = np.concatenate([[0], np.cumsum(counts * lengths)]).astype(np.float64)
    cost = np.where(lengths * (many[1:] - many[0]) - much[1:] >= 0, lengths * many[1:] - much[1:], 0)
    choice = []
    # padding of lengths i..j in one bucket: length_j * items - tokens
    pad = lengths[None, :] * (many[None, 1:] - many[:-1, None]) - (much[None, 1:] - much[:-1, None])
    pad[np.tril_indices(n, -1)] = np.inf
    for _ in range(buckets - 1):
        total = np.concatenate([[0.0], cost[:-1]])[:, None] + pad
        choice.append(total.argmin(0))
        cost = total.min(0)
    bounds, j = [], n - 1
    for pick in reversed(choice):
        bounds.append(lengths[j])
        j = pick[j] - 1
        if j < 0:
            break
    else:
        bounds.append(lengths[j])
    return np.array(sorted(set(bounds)))


def plan_batches(bounds: np.ndarray, counts: np.ndarray, capacity: int) -> pd.DataFrame:
    """Runs of equal containers: (bucket, rank_from, rank_to, per_container, first_container)."""
    left = counts.astype(np.int64).copy()
    used = np.zeros(len(bounds), np.int64)
    rows, container = [], 0
    while left.any():
        room, take = capacity, {}
        for k in np.flatnonzero(left)[::-1].tolist():
            if bounds[k] <= room:
                t = int(min(left[k], room // bounds[k]))
                take[k] = t
                room -= t * int(bounds[k])
        times = min(int(left[k]) // t for k, t in take.items())
        for k, t in take.items():
            rows.append((k, int(used[k]), int(used[k]) + t * times, t, container))
            used[k] += t * times
            left[k] -= t * times
        container += times
    return pd.DataFrame(rows, columns=["bucket", "rank_from", "rank_to", "per_container", "first_container"]).astype("int64")


def pieces(sizes: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, part, first_token, n_tokens): texts longer than a container are cut every ``capacity`` tokens."""
    n = F.col("n_tokens")
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / capacity))).alias("part")
    return sizes.filter(n > 0).select("doc_id", n, part).select(
        "doc_id", "part", (F.col("part") * capacity).alias("first_token"), F.least(n - F.col("part") * capacity, F.lit(capacity).cast("long")).alias("n_tokens")
    )


def pack(sizes: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """(container_id, doc_id, part, first_token, n_tokens), every token of every text once.

    sizes: columns doc_id and n_tokens. Texts without tokens, or with null
    size, take no place; a doc_id that occurs twice is packed twice. An empty
    table gives no containers. Only texts longer than a container are cut.
    """
    items = materialise(pieces(sizes.select("doc_id", "n_tokens"), capacity), "items")
    hist = items.groupBy("n_tokens").agg(F.count("*").alias("n")).toPandas().sort_values("n_tokens")  # at most `capacity` rows
    lengths, counts = hist.n_tokens.to_numpy(np.int64), hist.n.to_numpy(np.int64)
    bounds = length_buckets(lengths, counts, buckets)
    at = np.searchsorted(bounds, lengths)
    plan = plan_batches(bounds, np.bincount(at, counts, len(bounds)).astype(np.int64), capacity)
    edges = F.array(*[F.lit(int(b)) for b in bounds]) if len(bounds) else F.array(F.lit(capacity))
    salts = -(-int(counts.sum()) // SALT_ROWS) or 1
    coded = items.withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("n_tokens")))).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "part"), F.lit(salts))
    )
    before = Window.partitionBy("bucket").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = coded.groupBy("bucket", "salt").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    runs = {int(k): g.sort_values("rank_from")[["rank_from", "per_container", "first_container"]].to_numpy() for k, g in plan.groupby("bucket")}
    one = Window.partitionBy("bucket", "salt").orderBy("doc_id", "part")
    ranked = coded.withColumn("rank", F.row_number().over(one) - 1).join(base, ["bucket", "salt"]).withColumn("rank", F.col("rank") + F.col("base"))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = np.zeros(len(f), np.int64)
            rank = f["rank"].to_numpy()
            for b in f.bucket.unique().tolist():
                mine = (f.bucket == b).to_numpy()
                run = runs[b][np.searchsorted(runs[b][:, 0], rank[mine], "right") - 1]
                out[mine] = run[:, 2] + (rank[mine] - run[:, 0]) // run[:, 1]
            yield f.assign(container_id=out)[["container_id", "doc_id", "part", "first_token", "n_tokens"]]

    kind = dict(items.dtypes)["doc_id"]
    return ranked.mapInPandas(place, f"container_id long, doc_id {kind}, part long, first_token long, n_tokens long")


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(n_containers, n_items, n_tokens, fill, fullest, emptiest) over all containers."""
    one = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n"))
    return one.agg(
        F.count("*").alias("n_containers"), F.sum("n").alias("n_items"), F.sum("t").alias("n_tokens"),
        (F.sum("t") / (F.count("*") * capacity)).alias("fill"), F.max("t").alias("fullest"), F.min("t").alias("emptiest"),
    )
