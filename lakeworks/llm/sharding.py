"""Sharding of whole groups into contiguous ranges of least greatest size.

Groups of equal texts are ordered by their digest. The smallest capacity that `shards` contiguous ranges
need is found by binary search; a capacity is checked greedily, each range taking groups as long as they
fit. A check asks only where the running total of sizes last stays below a bound. So the running totals
stay distributed; the driver holds at most `POINTS` blocks of them (first and last total in each), and
refines those blocks whose inside could still change an answer. With the capacity known, cuts are laid
as evenly as it allows. A shard is a range of digests: rows find theirs by comparing, without a join.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeworks.llm.texts import clean, text_bytes
from lakeworks.runtime import materialise

#: Blocks of running totals that the driver holds at once.
POINTS = 1 << 16


class Totals:
    """Running totals of group sizes, known block by block."""

    def __init__(self, ends: DataFrame, total: int):
        self.ends, self.total, self.width = ends, total, total + 1
        self.blocks = self._blocks([(1, total)])

    def _blocks(self, ranges):
        # at least twice as fine as before; what can still change an answer is some blocks for each two
        # shards, whatever their width
        self.width = max(1, min(self.width // 2, -(-sum(b - a + 1 for a, b in ranges) // POINTS)))
        width = self.width
        inside = None
        for a, b in ranges:
            part = F.col("end").between(a, b)
            inside = part if inside is None else inside | part
        rows = (
            self.ends.where(inside)
            .groupBy(F.expr(f"end div {width}").alias("block"))
            .agg(F.min("end").alias("low"), F.max("end").alias("high"))
            .collect()  # about POINTS rows
        )
        return sorted((r["low"], r["high"]) for r in rows)

    def last_up_to(self, bound: int, hopeful: bool) -> int:
        """The largest total up to `bound`: at most (hopeful) or at least what it is."""
        at = bisect_right(self.blocks, (bound, float("inf"))) - 1
        if at < 0:
            return 0
        low, high = self.blocks[at]
        return high if bound >= high else bound if hopeful and low != high else low

    def cuts(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """Greedy cuts under a capacity."""
        cuts, at = [], 0
        for _ in range(shards):
            at = self.last_up_to(at + capacity, hopeful)
            cuts.append(at)
        return cuts

    def least(self, shards: int, hopeful: bool) -> int:
        """The smallest capacity under which greedy cuts reach the end."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, hopeful)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def capacity(self, shards: int) -> int:
        """The exact smallest capacity; refines blocks until both readings agree."""
        while (low := self.least(shards, True)) < (high := self.least(shards, False)):
            pairs = zip(self.cuts(low, shards, False), self.cuts(high, shards, True), strict=True)
            ranges: list[list[int]] = []
            for a, b in sorted(pairs):
                a = self.blocks[max(0, bisect_right(self.blocks, (a, float("inf"))) - 1)][0]
                b = max(b, self.blocks[max(0, bisect_right(self.blocks, (b, float("inf"))) - 1)][1])
                if ranges and a <= ranges[-1][1]:
                    ranges[-1][1] = max(ranges[-1][1], b)
                else:
                    ranges.append([a, b])
            outside = [x for x in self.blocks if not any(a <= x[0] <= b for a, b in ranges)]
            self.blocks = sorted(outside + self._blocks([(a, b) for a, b in ranges]))
        return high

    def even_cuts(self, shards: int) -> list[int]:
        """Ends of the shards: none above the least capacity, each as near an even share as that allows.

        A group larger than an even share has a shard to itself, and the others share the rest evenly.
        """
        # fewer than `shards` groups are so large
        large = sorted(
            (r["end"] - r["size"], r["end"])
            for r in self.ends.where(F.col("size") * shards > self.total).select("end", "size").collect()
        )
        capacity, known = self.capacity(shards), {0, *(x for pair in (*self.blocks, *large) for x in pair)}
        points, least = sorted(known), [self.total] * (shards + 1)
        for k in range(shards - 1, 0, -1):
            least[k] = points[bisect_left(points, least[k + 1] - capacity)]
        cuts, at = [], 0
        for k in range(1, shards):
            ahead = [(a, b) for a, b in large if a >= at]
            rest = self.total - at - sum(b - a for a, b in ahead)
            share = rest / max(1, shards - k + 1 - len(ahead))
            goal = at + share
            if ahead and ahead[0][0] == at:
                goal = ahead[0][1]
            elif ahead and ahead[0][0] - at < 1.5 * share:
                goal = ahead[0][0]
            first = bisect_left(points, max(least[k], at))
            last = bisect_right(points, at + capacity) - 1
            near = bisect_left(points, goal, first, last + 1)
            at = min((points[i] for i in (near - 1, near) if first <= i <= last), key=lambda p: (abs(p - goal), p))
            cuts.append(at)
        return cuts


def _sums(df: DataFrame, value: Column) -> dict[int, int]:
    """A sum for each partition number: one row for each partition."""
    return {r[0]: r[1] for r in df.groupBy("part").agg(F.sum(value)).collect()}


def _before(sums: dict[int, int]) -> Column:
    """What lies in the partitions before a row's own, by its `part`."""
    offsets, total = [], 0
    for part in range(max(sums, default=-1) + 1):
        offsets.append(total)
        total += sums.get(part, 0)
    return F.element_at(F.array(*(F.lit(x).cast("long") for x in offsets or [0])), F.col("part") + 1)


def shard_by_bytes(df: DataFrame, shards: int = 40, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Every row with its shard (0 to shards - 1) and its slot in the shard.

    A row's size is its text's UTF-8 bytes plus 16; rows of equal texts are one group and stay together
    (null counts as empty). Slots run from 0 without gaps in the order of digest and key.
    Null keys, repeated rows and extra columns do no harm; with fewer groups than shards some shards are
    empty, and an empty table gives an empty result.
    """
    rows = materialise(
        clean(df, doc_id=key, text=text).select(
            "doc_id",
            (text_bytes("text") + 16).alias("size"),
            F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"),
            F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)).alias("group"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "shard-rows",
    )
    groups = materialise(
        rows.groupBy("group").agg(F.sum("size").alias("size")).repartitionByRange("group")
        .withColumn("part", F.spark_partition_id()),
        "shard-groups",
    )
    sums = _sums(groups, F.col("size"))
    running = F.sum("size").over(Window.partitionBy("part").orderBy("group"))
    ends = materialise(groups.select("group", "size", (_before(sums) + running).alias("end")), "shard-ends")
    total = sum(sums.values())
    cuts = Totals(ends, total).even_cuts(shards) if total else []
    digests = {r["end"]: r["group"] for r in ends.where(F.col("end").isin(cuts)).collect()} if cuts else {}
    shard = F.lit(0)
    for cut in cuts:
        shard += (F.col("group") > F.lit(bytes(digests[cut]))).cast("int") if cut else F.lit(1)
    placed = materialise(
        rows.withColumn("shard", shard).repartitionByRange("group", "doc_id", "row")
        .withColumn("part", F.spark_partition_id()),
        "shard-placed",
    )
    position = _before(_sums(placed, F.lit(1))) + F.row_number().over(
        Window.partitionBy("part").orderBy("group", "doc_id", "row")
    )
    counts = {r[0]: r[1] for r in placed.groupBy("shard").count().collect()}  # one row for each shard
    first = [sum(counts.get(i, 0) for i in range(k)) for k in range(shards)]
    first = F.element_at(F.array(*(F.lit(x).cast("long") for x in first)), F.col("shard") + 1)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (position - 1 - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
