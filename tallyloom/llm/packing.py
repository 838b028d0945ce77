"""Filling containers of fixed capacity: first-fit decreasing with a tournament tree, in randomised groups.

The rows are hashed into groups of about ``GROUP_ITEMS``, by the id and the place of a row; each group is packed by itself, so no
task sees more than a group and the space lost is at most a few containers per group. An item larger
than the capacity is cut into full pieces, each a container of its own, and a rest that is packed
like any other item; no other item is split.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.skew import small

GROUP_ITEMS = 16_384
SEED = 42


def first_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each size, in the order given: the first with room, else a new one. No size exceeds ``capacity``.

    A leaf of the tree is a container's room, an inner node the largest room below it, so the first
    container with room is found by going down once.
    """
    width = 1 << max(0, len(sizes) - 1).bit_length()
    room = [capacity] * (2 * width)
    chosen = np.empty(len(sizes), np.int64)
    for n, size in enumerate(sizes.tolist()):
        at = 1
        while at < width:
            at *= 2
            if room[at] < size:
                at += 1
        chosen[n] = at - width
        room[at] -= size
        at //= 2
        while at:
            left, right = room[2 * at], room[2 * at + 1]
            best = left if left > right else right
            if room[at] == best:
                break
            room[at] = best
            at //= 2
    return chosen


def pack_group(items: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """``item``, ``piece_no``, ``tokens``, ``container_no`` for the ``item`` and ``tokens`` of one group.

    Ties are packed in the order of the items. Items of size 0 take no room and go to container 0. A
    whole item has piece_no 0; pieces of a split item count from 1.
    """
    items = items.sort_values(["tokens", "item"], ascending=[False, True], kind="stable", ignore_index=True)
    size = items["tokens"].to_numpy(np.int64)
    full = np.where(size > capacity, size // capacity, 0)
    rest = size - full * capacity
    at = np.repeat(np.arange(len(items)), full)
    number = np.arange(len(at)) - np.repeat(np.cumsum(full) - full, full) + 1
    left = np.flatnonzero((rest > 0) | (full == 0))
    left = left[np.argsort(-rest[left], kind="stable")]
    chosen = first_fit(rest[left], capacity)
    used = int(chosen[rest[left] > 0].max(initial=-1)) + 1
    chosen[rest[left] == 0] = 0
    return pd.DataFrame(
        {
            "item": items["item"].to_numpy()[np.concatenate([left, at])],
            "piece_no": np.concatenate([np.where(full[left] > 0, full[left] + 1, 0), number]),
            "tokens": np.concatenate([rest[left], np.full(len(at), capacity, np.int64)]),
            "container_no": np.concatenate([chosen, used + np.arange(len(at))]),
        }
    )


def pack(sizes: DataFrame, row_id: str, capacities: DataFrame, rows: int, group_items: int = GROUP_ITEMS, seed: int = SEED) -> DataFrame:
    """Each item of ``sizes`` (``row_id``, ``tokens``) in a container of each kind of ``capacities``.

    ``rows`` is about the number of items and sets the number of groups. Sizes that are null or negative
    count as 0. Kinds without a positive capacity are left out; repeated items are packed each, however
    many there are of one, and lie in different groups; an empty table gives an empty result.
    ``pack_group`` and ``container_no`` together name a container of a kind. A group is packed once for
    each different capacity, a number that the driver reads; the kinds that have it are joined.
    """
    kinds = capacities.select("container_kind", F.col("capacity_tokens").cast("int").alias("capacity_tokens")).filter("capacity_tokens > 0").distinct()
    wanted = sorted(r.capacity_tokens for r in kinds.select("capacity_tokens").distinct().collect())
    groups = max(1, -(-rows // group_items))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [pack_group(pdf, capacity).assign(capacity_tokens=capacity) for capacity in wanted]
        out = pd.concat(parts) if parts else pack_group(pdf.head(0), 1).assign(capacity_tokens=0)
        return out.assign(pack_group=int(pdf["pack_group"].iloc[0]))[["capacity_tokens", "pack_group", "container_no", "item", "piece_no", "tokens"]]

    kind = dict(sizes.dtypes)[row_id]
    group = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed), F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    items = sizes.select(F.col(row_id).alias("item"), F.greatest(F.coalesce(F.col("tokens"), F.lit(0)), F.lit(0)).cast("long").alias("tokens"), group.alias("pack_group"))
    packed = items.groupBy("pack_group").applyInPandas(run, f"capacity_tokens int, pack_group int, container_no long, item {kind}, piece_no int, tokens long")
    named = packed.join(small(kinds), "capacity_tokens").select("container_kind", "capacity_tokens", "pack_group", "container_no", "item", "piece_no", "tokens")
    return named.withColumnRenamed("item", row_id)


def fill(packed: DataFrame) -> DataFrame:
    """Containers, tokens, unused tokens and the filled share of each kind."""
    each = packed.groupBy("container_kind", "capacity_tokens", "pack_group", "container_no").agg(F.sum("tokens").alias("tokens"))
    room = F.count("*") * F.first("capacity_tokens").cast("long")
    return each.groupBy("container_kind", "capacity_tokens").agg(
        F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), (room - F.sum("tokens")).alias("unused_tokens"), (F.sum("tokens") / room).alias("filled_share")
    )
