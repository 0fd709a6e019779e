"""Spark operators against plain-Python twins on small random inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tillwise.operators import activity as act
from tillwise.operators import pricing as pr
from tillwise.operators import timeseries as ts


def _naive_repair(cands, target):
    by = {}
    for c in cands:
        by.setdefault(c["sku"], []).append(c)
    plan = {}
    for s, g in by.items():
        plan[s] = max(g, key=lambda c: (c["gmv"], c["margin"], -c["price"]))

    def wm(p):
        tot = sum(r["gmv"] for r in p.values())
        return 0.0 if tot <= 0 else sum(r["gmv"] * r["margin"] for r in p.values()) / tot
    if wm(plan) >= target:
        return "already_feasible", plan
    reps = []
    for s, g in by.items():
        cur = plan[s]
        opts = []
        for c in g:
            dm = c["margin"] - cur["margin"]
            if dm <= 0:
                continue
            dg = c["gmv"] - cur["gmv"]
            score = -1e9 if dg >= 0 else max(-dg, 0.0) / dm
            opts.append((score, -dm, c["price"], c))
        if opts:
            best = min(opts, key=lambda o: o[:3])
            reps.append((best[0], best[1], best[2], s, best[3]))
    if not reps:
        return "infeasible_no_repairs", plan
    reps.sort(key=lambda r: r[:4])
    for r in reps:
        plan[r[3]] = r[4]
        if wm(plan) >= target:
            return "feasible_after_repairs", plan
    return "still_infeasible_after_repairs", plan


def test_plan_repair_matches_sequential_loop(spark):
    rng = random.Random(7)
    for trial in range(6):
        rows = []
        for sku in range(rng.randint(3, 25)):
            cost = rng.choice([5.0, 8.0, 10.0])
            for k in range(rng.randint(1, 4)):
                price = cost * rng.choice([0.9, 1.1, 1.3, 1.6, 2.0]) + k * 0.01
                rows.append((sku, "c", cost, price, rng.randint(1, 60)))
        df = pr.candidate_metrics(spark.createDataFrame(rows, "sku int, category string, cost double, price double, qty int"))
        target = rng.choice([0.1, 0.25, 0.35, 0.6])
        out, meta = pr.plan_repair(df, pr.plan_max_gmv(df), target)
        cands = [r.asDict() for r in df.collect()]
        status, plan = _naive_repair(cands, target)
        assert meta["status"] == status, (trial, meta, status)
        got = {r.sku: r.price for r in out.collect()}
        assert got == {s: r["price"] for s, r in plan.items()}


def test_rolling_active_users_matches_brute_force(spark):
    rng = random.Random(3)
    base = dt.date(2024, 1, 1)
    rows = [(rng.randint(1, 12), base + dt.timedelta(days=rng.randint(0, 40))) for _ in range(150)]
    df = spark.createDataFrame(rows, "user_id int, day date")
    got = {r.day: (r.dau, r.wau) for r in act.rolling_active_users(df).collect()}
    days = sorted({d for _, d in rows})
    d = days[0]
    while d <= days[-1]:
        dau = len({u for u, x in rows if x == d})
        wau = len({u for u, x in rows if d - dt.timedelta(days=6) <= x <= d})
        assert got[d] == (dau, wau), d
        d += dt.timedelta(days=1)
    assert all(w >= a for a, w in got.values())


def test_gaps_islands_matches_loop(spark):
    rng = random.Random(5)
    ids = sorted(rng.sample(range(400), 150))
    df = spark.createDataFrame([(i,) for i in ids], "log_id long")
    got = {r.log_id: r.grp for r in ts.gaps_islands(df, ranges=5).collect()}
    grp, prev = 0, None
    for i in ids:
        grp += 0 if prev is not None and i - prev == 1 else 1
        assert got[i] == grp
        prev = i


def test_char_error_rate_matches_python(spark):
    from tillwise.operators import text as tx

    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]
    pairs = [("éte", "ete"), ("kitten", "sitting"), ("", "x"), ("naïve café", "naive cafe")]
    df = spark.createDataFrame(pairs, "ref string, hyp string")
    got = {(r.ref, r.hyp): (r.edits, r.cer) for r in tx.char_error_rate(df).collect()}
    for a, b in pairs:
        assert got[(a, b)][0] == lev(a, b)
        if a:
            assert abs(got[(a, b)][1] - lev(a, b) / len(a)) < 1e-12


def test_bpe_merges_match_python(spark):
    from collections import Counter

    from tillwise.operators import text as tx
    words = {"lower": 5, "lowest": 2, "newer": 6, "wider": 3, "new": 2, "aaa": 4, "abab": 3}

    def naive(n):
        syms = {w: list(w) for w in words}
        out = []
        for _ in range(n):
            c = Counter()
            for w, s in syms.items():
                for a, b in zip(s, s[1:]):
                    c[(a, b)] += words[w]
            if not c:
                break
            (a, b), cnt = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0]
            out.append((a, b, cnt))
            for w, s in syms.items():
                i, t = 0, []
                while i < len(s):
                    if i + 1 < len(s) and s[i] == a and s[i + 1] == b:
                        t.append(a + b)
                        i += 2
                    else:
                        t.append(s[i])
                        i += 1
                syms[w] = t
        return out
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [(r.left, r.right, r["count"]) for r in tx.bpe_merges(df, 8).orderBy("rank").collect()]
    assert got == naive(8)


def test_keyed_sequence_hot_key_spans_ranges(spark):
    from pyspark.sql import functions as F

    from tillwise.functions.prefix import keyed_sequence
    rng = random.Random(11)
    # key 0 holds most rows so it spans several range partitions
    rows = [(0 if rng.random() < 0.7 else rng.randint(1, 5), i, rng.randint(0, 3)) for i in range(400)]
    df = spark.createDataFrame(rows, "k int, t int, v int")
    out = keyed_sequence(df, "k", ["t"], ["t"], {"run": F.col("v")}, ranges=4).collect()
    got = {(r.k, r.t): (r.prev_t, r.run) for r in out}
    by = {}
    for k, t, v in sorted(rows, key=lambda r: (r[0], r[1])):
        prev, acc = by.get(k, (None, 0))
        assert got[(k, t)] == (prev, acc + v)
        by[k] = (t, acc + v)


def test_bundle_delivery_is_optimal_against_brute_force(spark):
    from itertools import product

    from pyspark.sql import functions as F

    from tillwise.operators import inventory as inv
    rng = random.Random(21)
    rows, want = [], {}
    for prod in range(12):
        stock = rng.randint(5, 40)
        sizes = (rng.randint(1, 3), rng.randint(4, 6), rng.randint(9, 12))
        bounds = []
        for mp in ("Ozz", "WB", "YM"):
            lo = rng.randint(0, 8)
            hi = lo + rng.randint(0, 10)
            bounds.append((mp, lo, hi))
            rows.append((prod, mp, lo, hi, stock, *sizes))

        def reach(lo, hi):
            ok = set()
            for a in range(hi // sizes[0] + 1):
                for b in range(hi // sizes[1] + 1):
                    for c in range(hi // sizes[2] + 1):
                        t = a * sizes[0] + b * sizes[1] + c * sizes[2]
                        if lo <= t <= hi:
                            ok.add(t)
            return ok
        opts = [reach(lo, min(hi, stock)) for _, lo, hi in bounds]
        totals = [sum(p) for p in product(*opts) if sum(p) <= stock]
        want[prod] = max(totals) if totals else None
    df = spark.createDataFrame(rows, "product long, marketplace string, min_demand long, max_demand long, "
                                     "stock long, small long, middle long, large long")
    out = inv.bundle_delivery(df).groupBy("product").agg(F.sum("units").alias("u"), F.first("status").alias("s"))
    got = {r["product"]: (r["u"], r["s"]) for r in out.collect()}
    for prod, best in want.items():
        if best is None:
            assert got[prod][1] == "infeasible"
        else:
            assert got[prod] == (best, "optimal"), (prod, got[prod], best)


def test_deliver_by_residues_against_all_combinations():
    from itertools import product

    from tillwise.operators.inventory import deliver
    rng = random.Random(8)
    for _ in range(400):
        sizes = [rng.randint(-1, 9) for _ in range(3)]
        stock = rng.randint(0, 45)
        bounds = [(rng.randint(-2, 15), rng.randint(-1, 25)) for _ in range(rng.randint(1, 3))]
        reach = {0}
        for s in {s for s in sizes if s > 0}:
            reach = {x + s * k for x in reach for k in range((stock - x) // s + 1)}
        options = [[u for u in sorted(reach) if lo <= u <= min(hi, stock)] for lo, hi in bounds]
        totals = [sum(p) for p in product(*options) if sum(p) <= stock]
        units = deliver(stock, sizes, bounds)
        if not totals:
            assert units is None
        else:
            assert sum(units) == max(totals) and all(u in o for u, o in zip(units, options))
    # a stock of a billion takes no more memory than one of ten
    assert sum(deliver(10 ** 9, [7, 11, 13], [(3, 10 ** 9), (5, 40)])) == 10 ** 9


def test_restock_lagrangian_brackets_the_integer_optimum(spark):
    from itertools import product

    from tillwise.operators import inventory as inv
    rng = random.Random(5)
    for trial in range(3):
        rows = []
        for sku in range(4):
            cost = float(rng.randint(2, 9))
            for pct in (10, 50):
                rows.append((sku, pct, rng.randint(1, 6), cost * 1.5, cost, round(rng.uniform(0.1, 2.0), 4)))
        budget = float(rng.randint(10, 40))
        df = spark.createDataFrame(rows, "sku_id long, percentile long, demand_to_buy long, price double, "
                                         "cost double, profit_score double")
        alloc, info = inv.restock_lagrangian(df, budget, "profit")
        by = {}
        for r in rows:
            by.setdefault(r[0], []).append(r)
        best = 0.0
        # every sku picks one percentile and an integer quantity 0..demand
        choices = [[(r, q) for r in opts for q in range(r[2] + 1)] for opts in by.values()]
        for combo in product(*choices):
            spend = sum(r[4] * q for r, q in combo)
            if spend <= budget:
                best = max(best, sum(r[5] * q for r, q in combo))
        assert info["spent"] <= budget + 1e-9
        assert info["value"] <= best + 1e-9
        # the optimum of the relaxation equals the least dual value over all slopes at which a choice can change
        points = {s: [(0.0, 0.0)] + [(r[4] * r[2], r[5] * r[2]) for r in opts] for s, opts in by.items()}
        prices = {0.0} | {(w - v) / (d - c) for p in points.values() for c, v in p for d, w in p if d > c and w > v}
        dual = min(lam * budget + sum(max(v - lam * c for c, v in p) for p in points.values()) for lam in prices)
        assert abs(info["dual_bound"] - dual) < 1e-9
        assert best - 1e-9 <= dual
        # no more is lost than the largest whole purchase
        assert info["gap"] <= max(v for p in points.values() for _, v in p) + 1e-9


def test_restock_lagrangian_of_odd_rows(spark):
    from tillwise.operators import inventory as inv
    schema = "sku_id long, percentile long, demand_to_buy long, price double, cost double, profit_score double"
    empty, info = inv.restock_lagrangian(spark.createDataFrame([], schema), 10.0, "profit")
    assert empty.isEmpty() and info["dual_bound"] == 0.0
    rows = [(1, 10, 3, 2.0, 1.0, 1.0), (1, 50, 3, 2.0, 1.0, 2.0),  # as dear and worth less: never bought
            (2, 10, 3, 2.0, 1.0, -1.0), (3, 10, 3, 2.0, 0.0, 1.0), (4, 10, 0, 2.0, 1.0, 1.0), (5, 10, 2, None, None, None),
            (6, 10, 2, 2.0, 1.0, 1.5), (6, 50, 4, 2.0, 1.0, 1.5)]
    alloc, info = inv.restock_lagrangian(spark.createDataFrame(rows, schema), 100.0, "profit")
    assert {(r.sku_id, r.percentile, r.qty) for r in alloc.collect()} == {(1, 50, 3.0), (6, 50, 4.0)}
    assert info["gap"] == 0.0 and info["value"] == 12.0
    # the budget ends within the second purchase of SKU 6: its larger one is bought in part
    alloc, info = inv.restock_lagrangian(spark.createDataFrame(rows, schema), 6.0, "profit")
    assert {(r.sku_id, r.qty) for r in alloc.collect()} == {(1, 3.0), (6, 3.0)}
    assert info["value"] == info["dual_bound"] == 10.5


def test_salted_top_k_equals_plain_ranking(spark):
    from pyspark.sql import functions as F

    from tillwise.functions.topk import top_k_per_group
    rng = random.Random(9)
    # group 0 is hot (most rows); scores have ties broken by id
    rows = [(0 if rng.random() < 0.6 else rng.randint(1, 6), i, rng.randint(0, 20)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, id int, score int")
    got = {(r.g, r.rank): r.id for r in top_k_per_group(df, ["g"], [F.col("score").desc(), F.col("id")], 5,
                                                         salts=7).collect()}
    by = {}
    for g, i, s in rows:
        by.setdefault(g, []).append((-s, i))
    want = {(g, k + 1): i for g, lst in by.items() for k, (_, i) in enumerate(sorted(lst)[:5])}
    assert got == want


def test_ordered_prefix_sums_and_ntile_match_python(spark):
    from pyspark.sql import functions as F

    from tillwise.functions.prefix import ordered_prefix_sums
    from tillwise.operators.product import ntile_exact
    rng = random.Random(13)
    rows = [(i, rng.randint(0, 9)) for i in range(233)]
    df = spark.createDataFrame(rows, "id int, v int")
    out = ordered_prefix_sums(df, [F.col("v").desc(), F.col("id")], {"cum": F.col("v")}, row_number="pos",
                              ranges=5).collect()
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    acc = 0
    want = {}
    for pos, (i, v) in enumerate(order, 1):
        acc += v
        want[i] = (acc, pos)
    assert {r.id: (r.cum, r.pos) for r in out} == want
    k, n = 7, len(rows)
    nt = {r.id: r.bucket for r in ntile_exact(df, [F.col("v").desc(), F.col("id")], k, "bucket").collect()}
    size, extra = n // k, n % k
    for pos, (i, v) in enumerate(order, 1):
        b = (pos - 1) // (size + 1) + 1 if pos <= extra * (size + 1) else extra + (pos - extra * (size + 1) - 1) // size + 1
        assert nt[i] == b


def test_asof_price_and_retention_match_python(spark):
    from tillwise.operators import product as pa
    rng = random.Random(17)
    base = dt.date(2024, 3, 1)
    obs = [(rng.choice("ab"), base + dt.timedelta(days=rng.randint(0, 20)), float(rng.randint(1, 9)))
           for _ in range(25)]
    got = {(r.k, r.day): r.price_asof for r in
           pa.asof_price(spark.createDataFrame(obs, "k string, d date, p double"), "k", "d", "p").collect()}
    lo, hi = min(o[1] for o in obs), max(o[1] for o in obs)
    for k in {o[0] for o in obs}:
        day, last = lo, None
        while day <= hi:
            same = [o[2] for o in obs if o[0] == k and o[1] == day]
            if same:
                last = sum(same) / len(same)
            assert got[(k, day)] == last
            day += dt.timedelta(days=1)
    acts = [(rng.randint(1, 15), base + dt.timedelta(days=rng.randint(0, 20))) for _ in range(90)]
    ret = {r.n: (r.cohort_users, r.retained_users) for r in
           pa.retention_day_n(spark.createDataFrame(acts, "user_id int, day date"), days=(1, 3)).collect()}
    last_day = max(a[1] for a in acts)
    first = {}
    for u, d in acts:
        first[u] = min(first.get(u, d), d)
    for n in (1, 3):
        cohort = [u for u, d0 in first.items() if d0 + dt.timedelta(days=n) <= last_day]
        kept = [u for u in cohort if (u, first[u] + dt.timedelta(days=n)) in set(acts)]
        assert ret[n] == (len(cohort), len(kept))


def test_mrr_movements_match_python(spark):
    from tillwise.operators import product as pa
    rng = random.Random(23)
    rows = []
    for i in range(60):
        y, m = 2024, rng.randint(1, 6)
        rows.append((rng.randint(1, 6), dt.datetime(y, m, rng.randint(1, 28)), float(rng.choice([10, 20, 30]))))
    df = spark.createDataFrame(rows, "o_custkey int, o_orderdate timestamp_ntz, o_totalprice double")
    got = {r.month: r for r in pa.mrr_movements(df).collect()}
    rev = {}
    for c, d, p in rows:
        k = (c, dt.date(d.year, d.month, 1))
        rev[k] = rev.get(k, 0.0) + p
    last = max(m for _, m in rev)
    months = [dt.date(2024, m, 1) for m in range(1, last.month + 2)]
    want = {m: {"mrr": 0.0, "new": 0.0, "expansion": 0.0, "contraction": 0.0, "churned": 0.0, "reactivated": 0.0}
            for m in months}
    for c in {c for c, _ in rev}:
        m0 = min(m for cc, m in rev if cc == c)
        prev = None
        for m in months:
            if m < m0:
                continue
            cur = rev.get((c, m), 0.0)
            want[m]["mrr"] += cur
            kind = ("new" if prev is None and cur > 0 else "expansion" if prev and cur > prev else
                    "contraction" if prev and 0 < cur < prev else "churned" if prev and cur == 0 else
                    "reactivated" if prev == 0 and cur > 0 else None)
            if kind:
                want[m][kind] += cur - (prev or 0.0)
            prev = cur
    for m, w in want.items():
        if m in got:
            for k, v in w.items():
                assert abs(got[m][k] - v) < 1e-9, (m, k)


def test_week_missed_profits_labels_and_empty_weeks(spark):
    from tillwise.operators import timeseries as ts
    rows = [(dt.date(2024, 1, 1), 5.0, 7.0, 2.0),    # Monday -> week ending Sun 2024-01-07
            (dt.date(2024, 1, 7), 3.0, 1.0, 10.0),   # Sunday -> same week
            (dt.date(2024, 1, 22), 1.0, 4.0, 1.0)]   # weeks ending 01-14 and 01-21 are empty
    df = spark.createDataFrame(rows, "day date, sales double, forecast double, price double")
    got = {r.day: (r.revenue, r.missed_profits) for r in ts.week_missed_profits(df).collect()}
    assert got == {dt.date(2024, 1, 7): (5 * 2 + 3 * 10.0, 2 * 2.0),
                   dt.date(2024, 1, 14): (0.0, 0.0),
                   dt.date(2024, 1, 21): (0.0, 0.0),
                   dt.date(2024, 1, 28): (1.0, 3.0)}


def test_cohort_retention_matches_python(spark):
    from tillwise.operators import product as pa
    rng = random.Random(29)
    base = dt.date(2024, 1, 1)  # a Monday
    acts = [(rng.randint(1, 12), base + dt.timedelta(days=rng.randint(0, 34))) for _ in range(80)]
    got = {(r.cohort, r.period): (r.users, r.cohort_size) for r in
           pa.cohort_retention(spark.createDataFrame(acts, "user_id int, day date")).collect()}

    def monday(d):
        return d - dt.timedelta(days=d.weekday())
    weeks = {(u, monday(d)) for u, d in acts}
    first = {}
    for u, w in weeks:
        first[u] = min(first.get(u, w), w)
    size = {}
    for u, c in first.items():
        size[c] = size.get(c, 0) + 1
    want = {}
    for u, w in weeks:
        k = (first[u], (w - first[u]).days // 7)
        want[k] = want.get(k, 0) + 1
    assert got == {k: (v, size[k[0]]) for k, v in want.items()}


def test_gaps_islands_with_duplicates_uses_range_semantics(spark):
    from tillwise.operators import timeseries as ts
    rng = random.Random(31)
    ids = sorted(rng.choice(range(120)) for _ in range(150))  # with duplicates
    got = {}
    for r in ts.gaps_islands(spark.createDataFrame([(i,) for i in ids], "log_id long"), ranges=4).collect():
        got.setdefault(r.log_id, set()).add(r.grp)
    grp, prev, want = 0, None, {}
    distinct = sorted(set(ids))
    for i in distinct:
        m = ids.count(i)
        first = 0 if prev is not None and i - prev == 1 else 1
        grp += first + (m - 1)
        want[i] = {grp}
        prev = i
    assert got == want


def test_org_tree_with_cycles_orphans_and_a_deep_chain(spark):
    from tillwise.operators import hierarchy as hier
    deep = [(i, f"n{i}", i - 1 if i else None, 1.0) for i in range(300)]
    odd = [(900, "orphan", 899, 5.0), (901, "under orphan", 900, 5.0), (910, "a", 911, 2.0), (911, "b", 910, 2.0), (912, "under cycle", 910, 2.0),
           (920, "root", None, 3.0)]
    emp = spark.createDataFrame(deep + odd, "employee_id long, employee_name string, manager_id long, salary double")
    got = {r.employee_id: (r.level, r.team_size, r.budget) for r in hier.org_report(emp).collect()}
    assert got == {i: (i + 1, 299 - i, 300.0 - i) for i in range(300)} | {920: (1, 0, 3.0)}
    assert {r.employee_id: r.level for r in hier.org_levels(emp).collect()} == {k: v[0] for k, v in got.items()}
    small = emp.where("employee_id < 12 or employee_id >= 900")
    pairs = {(r.manager_id, r.subordinate_id) for r in hier.org_closure(small).collect()}
    want = {(a, b) for a in range(12) for b in range(a, 12)} | {(900, 900), (901, 901), (900, 901), (920, 920)}
    assert pairs == want


def test_near_duplicate_links_need_no_common_representative(spark):
    from tillwise.operators import similarity as sim
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(300)) for _ in range(12)]
    rows = []
    for i, t in enumerate(texts):
        for k in range(4):
            words = t.split()
            words[rng.randrange(300)] = f"x{k}"
            rows.append((4 * i + k, " ".join(words)))
    rows.append((100, rows[0][1]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    groups = {}
    for r in sim.near_duplicate_groups(docs).collect():
        groups.setdefault(r.component, set()).add(r.doc_id)
    assert sorted(map(len, groups.values())) == [4] * 11 + [5]


def _pairs_at(jaccards, seed):
    """Two texts of 400 shingles for each (shared, of all) five-word shingles: the second has other words at its end."""
    rng, rows = random.Random(seed), []
    for i, j in enumerate(jaccards):
        words = [f"v{rng.randrange(10 ** 9)}" for _ in range(404)]
        changed = round(400 * (1 - j) / (1 + j))
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:404 - changed] + [f"c{i}x{k}" for k in range(changed)]))]
    return rows


def test_near_duplicates_are_accepted_on_the_exact_jaccard(spark):
    from tillwise.operators import similarity as sim
    rows = _pairs_at([0.81] * 25 + [0.85] * 25 + [0.78] * 50, 5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component for r in sim.near_duplicate_groups(docs).collect()}
    assert got == {i: i - i % 2 if i < 100 else i for i in range(200)}


@pytest.mark.parametrize("block", [512, 8])
def test_match_items_counts_every_link(spark, block):
    from tillwise.operators import similarity as sim
    rng = random.Random(8)
    rows = []
    for g in range(3):
        words = [f"g{g}v{rng.randrange(10 ** 6)}" for _ in range(300)]
        for k in range(20):
            w = list(words)
            for _ in range(rng.randrange(1, 7)):
                w[rng.randrange(300)] = f"x{rng.randrange(10 ** 9)}"
            rows.append((100 * g + k, " ".join(w)))
    rows += [(900, rows[0][1]), (901, rows[0][1]), (902, None), (903, None), (904, ""), (None, rows[5][1]), (905, "one two")]
    grams = [frozenset(tuple((t or "").split()[i:i + 5]) for i in range(max(len((t or "").split()) - 4, 1))) if t is not None else None for _, t in rows]
    near = lambda a, b: a == b if a is None or b is None else len(a & b) / len(a | b) >= 0.8
    want, label = [], list(range(len(rows)))
    for i, a in enumerate(grams):
        want.append(sum(near(a, b) for j, b in enumerate(grams) if i != j))
        for j, b in enumerate(grams):
            if near(a, b):
                label = [label[i] if x == label[j] else x for x in label]
    least = {x: min(r[0] for r, y in zip(rows, label) if y == x and r[0] is not None) for x in label}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted(map(str, (tuple(r) for r in sim.match_items(docs, block=block, bands=32, rows=2).collect())))
    assert got == sorted(str((r[0], least[x], n)) for r, x, n in zip(rows, label, want))
