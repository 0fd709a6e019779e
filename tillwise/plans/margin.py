"""Price plan under a margin guardrail, end to end.

validate -> candidate metrics -> feasibility figure (max-margin plan, reported
only) -> max-GMV plan -> greedy repair -> reports. Returns DataFrames; the
meta dict holds the scalars the reference prints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwise.operators import pricing as pr
from tillwise.sources import files


def margin_plan_run(candidates: DataFrame, target: float, category: str | None = None,
                    scenario: str | None = None, outdir: str | None = None) -> dict:
    scoped = pr.filter_scope(candidates, category, scenario)
    typed = pr.coerce_numeric(scoped.withColumn("sku", scoped["sku"].cast("string"))
                              .withColumn("category", scoped["category"].cast("string"))) \
        if dict(scoped.dtypes).get("price") == "string" else scoped
    quality = pr.dq_report(typed)
    valid = pr.dedup_candidates(pr.valid_rows(typed)) if "scenario_id" in typed.columns \
        else pr.valid_rows(typed).dropDuplicates(["sku", "category", "cost", "price", "qty"])
    cm = pr.candidate_metrics(valid)
    best_margin = pr.plan_max_margin(cm)
    g, w = pr.totals(best_margin)
    plan0 = pr.plan_max_gmv(cm)
    plan, meta = pr.plan_repair(cm, plan0, target)
    meta["best_possible_margin"] = pr.wm_of(g, w)
    meta["is_infeasible"] = meta["best_possible_margin"] < target
    contrib = pr.plan_contribution(plan)
    out = {
        "quality": quality, "candidates": cm, "plan": plan, "meta": meta,
        "summary": pr.plan_summary(plan, target, by=["category"]),
        "top": pr.top_n(contrib, 20),
        "actions": pr.plan_actions(contrib),
        "alerts": pr.plan_alerts(plan, contrib, target),
    }
    if outdir:
        files.write_tables({"data_quality": quality, "price_plan": plan, "summary": out["summary"],
                            "top_contributors": out["top"], "actions": out["actions"],
                            "alerts": out["alerts"]}, outdir, fmt="csv")
    return out
