"""Mixing sources to target weights by Pfair scheduling.

Rows of a source form blocks of ``block`` rows in a pseudo-random order (by hash of
their id). Slot by slot one block is emitted. With weight w, the i-th block of a
source (from 0) is released at floor(i / w) and due at ceil((i + 1) / w);
earliest deadline first among the released blocks keeps every window, so at any slot
each source deviates from its target by less than one block.

Shares are integers, so the schedule repeats after as many slots as they add up to;
one such period is a small table, and block i of a source has its slot by arithmetic
from it. When a source has no blocks left, the others go on with their shares from
fresh windows: no row is dropped and none is repeated. There are at most as many such
phases as shares. What the driver holds is bounded by the shares given (a parameter),
never by the data: sources that have no share of their own are pooled under one.

Row ranks within a source come from counts per (source, hash range) and a sort within
a range of about ``rows_per_range`` rows, so a source with a third of all rows is
sorted by many tasks.

Defined results: null or unlisted sources are pooled as ``other``; null ids hash like
any value; rows that repeat an id are neighbours in any order among themselves; an
empty table gives an empty mix; the last block of a source may be short.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.llm.common import checkpointed

OTHER = "other"


def pfair_period(shares: dict[str, int]) -> list[str]:
    """The source of each slot of one period."""
    total = sum(shares.values())
    release = lambda i, a: i * total // a
    due = lambda i, a: -(-(i + 1) * total // a)
    waiting = [(0, s, 0) for s in sorted(shares)]
    ready: list[tuple[int, str, int]] = []
    slots = []
    heapq.heapify(waiting)
    for t in range(total):
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due(i, shares[s]), s, i))
        deadline, s, i = heapq.heappop(ready)
        assert t < deadline
        slots.append(s)
        if i + 1 < shares[s]:
            heapq.heappush(waiting, (release(i + 1, shares[s]), s, i + 1))
    return slots


def pfair_phases(shares: dict[str, int], blocks: dict[str, int]) -> list[dict]:
    """Phases of the whole mix: each has its shares, first slot, and first block per source."""
    left = {s: n for s, n in blocks.items() if n > 0}
    done, at, phases = dict.fromkeys(left, 0), 0, []
    while left:
        live = {s: shares[s] for s in left}
        g = math.gcd(*live.values())
        live = {s: a // g for s, a in live.items()}
        period = pfair_period(live)
        total = len(period)
        places = {s: [k for k, x in enumerate(period) if x == s] for s in live}
        ends = {s: (n - 1) // live[s] * total + places[s][(n - 1) % live[s]] for s, n in left.items()}
        length = min(ends.values()) + 1
        phases.append({"shares": live, "places": places, "total": total, "slot": at, "first": dict(done), "length": length})
        for s in live:
            used = length // total * live[s] + sum(k < length % total for k in places[s])
            done[s] += used
            left[s] -= used
        left = {s: n for s, n in left.items() if n}
        at += length
    return phases


def deviation(slots: list[str], shares: dict[str, int]) -> Fraction:
    """Largest distance, in blocks, between what a source got and its target after any slot."""
    total, got, worst = sum(shares.values()), dict.fromkeys(shares, 0), Fraction(0)
    for t, s in enumerate(slots, 1):
        got[s] += 1
        worst = max(worst, *(abs(got[x] - Fraction(t * a, total)) for x, a in shares.items()))
    return worst


def mix(rows: DataFrame, shares: dict[str, int], block: int = 64, other_share: int = 1,
        id_col: str = "doc_id", source_col: str = "source", rows_per_range: int = 1 << 12,
        carry: bool = False, tie_col: str = "text") -> DataFrame:
    """doc_id, mix_source, block, slot, position (0-based place of the row in the mix).

    With ``carry`` the whole input row comes along as the struct ``row``. Rows are ranked in
    ranges of their id's hash. A range far above ``rows_per_range`` (a repeated id, or null) is split
    by the hash of ``tie_col``, if the input has it; only then is that column read. Rows that are
    equal in both stay together, sorted by one task.
    """
    if any(a < 1 for a in [*shares.values(), other_share, block]):
        raise ValueError("shares and block are positive")
    shares = {OTHER: other_share} | shares
    known = F.col(source_col).isin(*[s for s in shares if s != OTHER])
    keyed = rows.select(F.col(id_col).alias("doc_id"),
                        F.when(known, F.col(source_col)).otherwise(F.lit(OTHER)).alias("mix_source"),
                        (F.xxhash64(rows[tie_col]) if tie_col in rows.columns else F.lit(0).cast("long")).alias("tie"),
                        *([F.struct(*[rows[c] for c in rows.columns]).alias("row")] if carry else []))
    kept = [c for c in keyed.columns if c != "tie"]
    n = keyed.count()
    bits = min(31, max(0, math.ceil(math.log2(max(1, n) / rows_per_range))))
    # xxhash64 with its sign bit flipped orders like the unsigned hash; its high bits are the range
    keyed = keyed.withColumn("h", F.xxhash64("doc_id"))
    keyed = keyed.withColumn("range", F.shiftright("h", 64 - bits) if bits else F.lit(0).cast("long"))
    ranges = ["mix_source", "range", "part"]
    keyed = keyed.withColumn("part", F.lit(0).cast("long"))
    counts = checkpointed(keyed.groupBy(*ranges).agg(F.count(F.lit(1)).alias("n")))
    hot = counts.where(F.col("n") > 4 * rows_per_range)
    if tie_col in rows.columns and not hot.isEmpty():
        parts = hot.select("mix_source", "range", F.ceil(F.col("n") / rows_per_range).alias("parts"))
        keyed = (keyed.drop("part").join(parts, ["mix_source", "range"], "left")
                 .withColumn("part", F.pmod("tie", F.coalesce("parts", F.lit(1).cast("long")))).drop("parts"))
        counts = checkpointed(keyed.groupBy(*ranges).agg(F.count(F.lit(1)).alias("n")))
    totals = {r[0]: r[1] for r in counts.groupBy("mix_source").agg(F.sum("n")).collect()}
    phases = pfair_phases(shares, {s: -(-c // block) for s, c in totals.items()})
    spark = rows.sparkSession
    starts = counts.select(*ranges, F.coalesce(F.sum("n").over(
        Window.partitionBy("mix_source").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    ranked = (keyed.withColumn("i", F.row_number().over(
        Window.partitionBy(*ranges).orderBy("h", "doc_id", "tie")) - 1)
        .join(starts, ranges).withColumn("rank", F.col("before") + F.col("i")))
    blocks = ranked.select(*kept, F.floor(F.col("rank") / block).alias("block"),
                           (F.col("rank") % block).alias("within"))
    return _placed(spark, blocks, phases, totals, block)


def _placed(spark, blocks: DataFrame, phases: list[dict], totals: dict[str, int], block: int) -> DataFrame:
    """Slots by arithmetic from the phase tables, whose size the shares bound.

    Only the last block of a source can be short. A row's position is its slot times
    ``block`` less what short blocks before it lack, and these are at most one for each source.
    """
    firsts = {s: [(k, p["first"][s]) for k, p in enumerate(phases) if s in p["shares"]] for s in totals}
    table = [(s, [f for _, f in v], [phases[k]["slot"] for k, _ in v], [phases[k]["total"] for k, _ in v],
              [phases[k]["shares"][s] for k, _ in v], [phases[k]["places"][s] for k, _ in v]) for s, v in firsts.items()]
    shape = ("mix_source string, firsts array<long>, slots array<long>, periods array<long>, "
             "parts array<long>, places array<array<long>>")
    lookup = spark.createDataFrame(table, shape)
    p = F.size(F.filter("firsts", lambda x: x <= F.col("block")))
    at = lambda name: F.element_at(name, F.col("p"))
    placed = (blocks.join(F.broadcast(lookup), "mix_source").withColumn("p", p)
              .withColumn("j", F.col("block") - at("firsts"))
              .withColumn("slot", at("slots") + F.floor(F.col("j") / at("parts")) * at("periods")
                          + F.element_at(at("places"), (F.col("j") % at("parts") + 1).cast("int"))))
    short = []
    for s, n in totals.items():
        if n % block:
            k, first = firsts[s][-1]
            ph, j = phases[k], (n - 1) // block - first
            short.append((ph["slot"] + j // ph["shares"][s] * ph["total"] + ph["places"][s][j % ph["shares"][s]], block - n % block))
    lack = F.lit(0).cast("long")
    for slot, missing in short:
        lack = lack + F.when(F.col("slot") > slot, F.lit(missing).cast("long")).otherwise(F.lit(0).cast("long"))
    return placed.select(*[c for c in blocks.columns if c != "within"], "slot", (F.col("slot") * block + F.col("within") - lack).alias("position"))


def mixed(rows: DataFrame, shares: dict[str, int], block: int = 64, **names) -> DataFrame:
    """``rows`` in the order of the mix; all columns stay."""
    return mix(rows, shares, block, carry=True, **names).orderBy("position").select("row.*")
