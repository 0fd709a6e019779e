"""Organisation tree (C1-C3, D3, M28) by pointer jumping.

Round k knows, for every employee, the ancestor 2^k steps up, the steps taken
so far, and the size and budget of the part of the team fewer than 2^k steps
below. Each round doubles that: the ancestor's ancestor, and the sums of those
exactly 2^k steps below added. So the number of rounds is the logarithm of the
depth, and levels and roll-up come from one pass over one table.

Only trees that hang from a root (``manager_id IS NULL``) have levels. Rows
under a missing manager or in a cycle have none: a cycle shows as rows that
still have an ancestor after more doublings than there are employees.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.session import reliable_checkpoint


def _doubled(emp: DataFrame, sums: bool) -> DataFrame:
    """(employee_id, up, steps, hangs, size, budget) after enough rounds; ``up``
    is null for all but the rows in or under a cycle."""
    salary = F.col("salary") if sums else F.lit(0.0)
    state = reliable_checkpoint(emp.select(
        "employee_id", F.col("manager_id").alias("up"), F.col("manager_id").isNotNull().cast("int").alias("steps"),
        F.lit(True).alias("hangs"), F.lit(1).cast("long").alias("size"), salary.alias("budget")))
    reach, rows = 1, state.count()
    while reach <= 2 * rows and not state.where("up is not null").isEmpty():
        above = state.select(F.col("employee_id").alias("up"), F.col("up").alias("up2"), F.col("steps").alias("steps2"),
                             F.col("hangs").alias("hangs2"))
        nxt = state.join(above, "up", "left")
        if sums:
            below = (state.where("up is not null").groupBy(F.col("up").alias("employee_id"))
                     .agg(F.sum("size").alias("size2"), F.sum("budget").alias("budget2")))
            nxt = nxt.join(below, "employee_id", "left")
        else:
            nxt = nxt.withColumn("size2", F.lit(0)).withColumn("budget2", F.lit(0.0))
        orphan = F.col("up").isNotNull() & F.col("hangs2").isNull()
        state = reliable_checkpoint(nxt.select(
            "employee_id", F.col("up2").alias("up"), (F.col("steps") + F.coalesce("steps2", F.lit(0))).alias("steps"),
            (F.col("hangs") & ~orphan & F.coalesce("hangs2", F.lit(True))).alias("hangs"),
            (F.col("size") + F.coalesce("size2", F.lit(0))).cast("long").alias("size"),
            (F.col("budget") + F.coalesce("budget2", F.lit(0.0))).alias("budget")))
        reach *= 2
    return state


def _rooted(state: DataFrame) -> DataFrame:
    return state.where(F.col("up").isNull() & F.col("hangs"))


def org_levels(emp: DataFrame) -> DataFrame:
    """(employee_id, level) from the roots (``manager_id IS NULL`` = 1)."""
    return _rooted(_doubled(emp, sums=False)).select("employee_id", (F.col("steps") + 1).alias("level"))


def org_closure(emp: DataFrame) -> DataFrame:
    """(manager_id, subordinate_id) for every ancestor, self included. The
    output itself has one row per (ancestor, descendant). Pairs up to 2^k steps
    apart, joined with the jump of 2^k steps, give those up to 2^(k+1); rows in
    or under a cycle have no finite closure and are left out."""
    endless = _doubled(emp, sums=False).where("up is not null").select("employee_id")
    rows = emp.select("employee_id", "manager_id").join(endless, "employee_id", "left_anti")
    jump = reliable_checkpoint(rows.where("manager_id is not null").select("employee_id", F.col("manager_id").alias("up"))
                               .join(rows.select(F.col("employee_id").alias("up")), "up", "left_semi"))
    pairs = reliable_checkpoint(rows.select(F.col("employee_id").alias("manager_id"), F.col("employee_id").alias("subordinate_id")))
    while not jump.isEmpty():
        at = jump.select(F.col("employee_id").alias("manager_id"), F.col("up").alias("_up"))
        pairs = reliable_checkpoint(pairs.unionByName(
            pairs.join(at, "manager_id").select(F.col("_up").alias("manager_id"), "subordinate_id")))
        above = jump.select(F.col("employee_id").alias("up"), F.col("up").alias("_up"))
        jump = reliable_checkpoint(jump.join(above, "up").select("employee_id", F.col("_up").alias("up")))
    return pairs


def org_rollup(emp: DataFrame) -> DataFrame:
    """D3: per rooted employee ``team_size`` (all descendants) and ``budget``
    (salary of self + descendants)."""
    return _rooted(_doubled(emp, sums=True)).select("employee_id", (F.col("size") - 1).alias("team_size"), "budget")


def org_members(emp: DataFrame) -> DataFrame:
    """Employees joined with their levels and roll-up on the id."""
    tree = _rooted(_doubled(emp, sums=True)).select("employee_id", (F.col("steps") + 1).alias("level"),
                                                    (F.col("size") - 1).alias("team_size"), "budget")
    return emp.select("employee_id", "employee_name").join(tree, "employee_id")


def org_report(emp: DataFrame) -> DataFrame:
    """C1, ordered by level asc, budget desc, name asc."""
    return org_members(emp).select("employee_id", "employee_name", "level", "team_size", "budget").orderBy(
        F.col("level").asc(), F.col("budget").desc(), F.col("employee_name").asc())
