"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule (action, host, path) fits its host and all subdomains of it where the url's path
starts with the rule's; of the rules that fit, the longest decides. The urls that a rule
decides are the labelled ones: trees are fitted on them and judge all others.

Features: length, depth of the path, digit ratio, entropy of the characters, number of
parameters, number of host labels, length of the host, and statistics of suffixes: the
share of blocked urls under the last label of the host, its last two labels, the whole host,
and its last two labels with the first step of the path, each smoothed towards that of the
wider suffix. A labelled url's own label does not enter its own statistics.

Trees are grown level by level: one aggregation gives, for each node, feature and bin, the
sums of first and second derivatives of the logistic loss, and the best cuts come from these
few sums. Derivatives are whole numbers (parts of 2 ** 20), so that sums and trees are the same
however rows are dealt. All is DataFrame code; a fitted model is a column expression.

Bound: the trees are fitted on about ``sample`` distinct labelled urls, of least hash (all, if
there are fewer). The suffix statistics come from these too, so their table has at most four
times as many rows of 16 bytes. All urls are judged.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule, and
is judged like any; an empty host has no suffix statistics; null ids stay null, repeated rows
repeat their result; urls of any length are read whole; if the labelled urls are all of one
kind, that is the verdict of the rest, and without any it is ``allow``; an empty table gives no
row; further columns are neither read nor returned, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import ascii_lower, checkpointed

SAMPLE, TREES, DEPTH, BINS, RATE, LAMBDA, LEAST_GAIN, SMOOTH = 20_000, 10, 3, 16, 0.5, 1.0, 1.0, 4.0
UNIT = 1 << 20
#: Characters whose shares enter the entropy, in either case; all others are taken as one more.
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%:#+~,;@"
PLAIN = ["length", "depth", "digits", "entropy", "parameters", "labels", "host_length"]
SUFFIXES = ["tld", "domain", "host", "section"]
#: A suffix that is rare or unknown takes the share of the wider one.
WIDER = {"tld": None, "domain": "tld", "host": "domain", "section": "domain"}
FEATURES = [*PLAIN, *["s_" + s for s in SUFFIXES]]


@dataclass(frozen=True)
class Rule:
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(action: str, text: str) -> Rule:
    """From ``example.net/en/``: the host, and a path from the first slash on."""
    host, _, path = text.partition("/")
    return Rule(action, host, "/" + path)


def parts(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``)."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def decided(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits; null if none does."""
    text = action = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, action = F.when(fits, r.text).otherwise(text), F.when(fits, r.action).otherwise(action)
    return text, action


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    low = F.lower(url)
    n = F.length(url)
    # characters of the alphabet by how much shorter the url is without them
    counts = F.transform(F.array(*[F.lit(c) for c in ALPHABET]), lambda c: n - F.length(F.replace(low, c, F.lit(""))))
    other = F.greatest(n - F.aggregate(counts, F.lit(0), lambda a, x: a + x), F.lit(0))
    entropy = F.aggregate(F.concat(counts, F.array(other)), F.lit(0.0), lambda a, x: a - F.when(x > 0, x / n * F.log2(x / n)).otherwise(0.0))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    return {"length": n.cast("double"),
            "depth": F.size(F.filter(F.split(path, "/"), lambda x: x != "")).cast("double"),
            "digits": F.when(n > 0, (n - F.length(F.translate(url, "0123456789", ""))) / n).otherwise(0.0),
            "entropy": F.when(n > 0, entropy).otherwise(0.0),
            "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")).cast("double"),
            "labels": F.size(F.filter(F.split(host, r"\."), lambda x: x != "")).cast("double"),
            "host_length": F.length(host).cast("double")}


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """Hashes of the suffixes; null for an empty host."""
    domain = F.substring_index(host, ".", -2)
    said = {"tld": F.substring_index(host, ".", -1), "domain": domain, "host": host,
            "section": F.concat(domain, F.lit("/"), F.element_at(F.split(path, "/", 3), F.when(F.instr(path, "/") > 0, 2).otherwise(1)))}
    return {k: F.when(host != "", F.xxhash64(F.lit(k), v)) for k, v in said.items()}


def labelled(urls: DataFrame, sample: int) -> DataFrame:
    """Distinct (url, y) of the urls with an action, about ``sample`` of them by least hash, with what the features need."""
    known = urls.where("action is not null")
    n = known.agg(F.approx_count_distinct("url")).first()[0]
    drawn = F.pmod(F.xxhash64(F.lit("sample"), "url"), F.lit(1 << 30)) < math.ceil((1 << 30) * min(1.0, sample / max(n, 1)))
    one = known.where(drawn).select("url", "host", "path", (F.col("action") == "block").cast("int").alias("y")).distinct()
    return one.select("url", "y", *[c.alias(k) for k, c in lexical(F.col("url"), F.col("host"), F.col("path")).items()],
                      *[c.alias("k_" + k) for k, c in suffixes(F.col("host"), F.col("path")).items()])


def statistics(sample: DataFrame) -> DataFrame:
    """(key, blocked, n) of each suffix."""
    keys = sample.select("y", F.explode(F.array(*["k_" + s for s in SUFFIXES])).alias("key")).where("key is not null")
    return keys.groupBy("key").agg(F.sum("y").alias("blocked"), F.count(F.lit(1)).alias("n"))


def with_shares(rows: DataFrame, table: DataFrame, prior: float, own: Column | None = None) -> DataFrame:
    """``rows`` with the share of each suffix; ``own``: the row's own label, which is taken out."""
    for s in SUFFIXES:
        mine = table.select(F.col("key").alias("k_" + s), F.col("blocked").alias("b_" + s), F.col("n").alias("n_" + s))
        # at most one row for each suffix of the sample: bounded by its parameter
        rows = rows.join(F.broadcast(mine), "k_" + s, "left")
        b, n = F.coalesce("b_" + s, F.lit(0)), F.coalesce("n_" + s, F.lit(0))
        if own is not None:
            b, n = b - F.when(F.col("n_" + s) > 0, own).otherwise(0), n - F.when(F.col("n_" + s) > 0, 1).otherwise(0)
        wider = F.lit(prior) if WIDER[s] is None else F.col("s_" + WIDER[s])
        rows = rows.withColumn("s_" + s, (b + SMOOTH * wider) / (n + SMOOTH)).drop("b_" + s, "n_" + s)
    return rows


@dataclass(frozen=True)
class Tree:
    """A node is (feature, bound, left, right): left where the feature is at most the bound; or its score."""
    root: tuple | float

    def score(self, node=None) -> Column:
        node = self.root if node is None else node
        if isinstance(node, float):
            return F.lit(node)
        name, bound, left, right = node
        return F.when(F.col(name) <= bound, self.score(left)).otherwise(self.score(right))


@dataclass(frozen=True)
class Model:
    base: float
    trees: tuple[Tree, ...]

    def score(self) -> Column:
        out = F.lit(self.base)
        for t in self.trees:
            out = out + t.score()
        return out


def _gain(g: int, h: int) -> float:
    return (g / UNIT) ** 2 / (h / UNIT + LAMBDA)


def _best(sums: list, cuts: dict[str, list[float]]) -> tuple | None:
    """(feature, bound, left's g and h, right's) of greatest gain for a node's (feature, bin, g, h); ties go to the first feature and bound."""
    best, choice = LEAST_GAIN, None
    for f, name in enumerate(FEATURES):
        bins = {b: (g, h) for i, b, g, h in sums if i == f}
        g_all, h_all = sum(g for g, _ in bins.values()), sum(h for _, h in bins.values())
        g = h = 0
        for b, bound in enumerate(cuts[name]):
            g, h = g + bins.get(b, (0, 0))[0], h + bins.get(b, (0, 0))[1]
            gain = _gain(g, h) + _gain(g_all - g, h_all - h) - _gain(g_all, h_all)
            if gain > best + 1e-12:
                best, choice = gain, (name, bound, (g, h), (g_all - g, h_all - h))
    return choice


def boosted(rows: DataFrame, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Model:
    """Trees on (y, one column per feature); what comes to the driver are sums per node, feature and bin."""
    n, positive = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    base = math.log((positive + 0.5) / (n - positive + 0.5))
    quantiles = rows.agg(*[F.percentile(name, F.array(*[F.lit(i / bins) for i in range(1, bins)])).alias(name) for name in FEATURES]).first()
    cuts = {name: sorted(set(quantiles[name])) for name in FEATURES}
    binned = rows.select("y", *FEATURES, F.array(*[
        sum((F.col(name) > c).cast("int") for c in cuts[name]) + F.lit(0) for name in FEATURES]).alias("bins"))
    binned = checkpointed(binned.repartition(max(1, math.ceil(n / 5000))))
    model = Model(base, ())
    for _ in range(trees):
        p = 1 / (1 + F.exp(-model.score()))
        # a node is known by the way to it: (feature, bound, goes left) for each step
        open_, chosen, leaf = [()], {}, {}
        for _ in range(depth):
            node = F.lit(-1)
            for i, way in enumerate(open_):
                here = F.lit(True)
                for name, bound, left in way:
                    here = here & ((F.col(name) <= bound) if left else (F.col(name) > bound))
                node = F.when(here, i).otherwise(node)
            sums = (binned.select(node.alias("node"), F.round((p - F.col("y")) * UNIT).cast("long").alias("g"),
                                  F.round(p * (1 - p) * UNIT).cast("long").alias("h"), F.posexplode("bins").alias("f", "bin"))
                    .where("node >= 0").groupBy("node", "f", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))).collect()
            after = []
            for i, way in enumerate(open_):
                best = _best([(r["f"], r["bin"], r["g"], r["h"]) for r in sums if r["node"] == i], cuts)
                if best:
                    name, bound, left, right = best
                    chosen[way] = name, bound
                    for side, (g, h) in ((True, left), (False, right)):
                        after.append((*way, (name, bound, side)))
                        leaf[after[-1]] = -rate * (g / UNIT) / (h / UNIT + LAMBDA)
            open_ = after
            if not open_:
                break
        if not chosen:
            break  # nothing left to gain

        def built(way: tuple) -> tuple | float:
            if way not in chosen:
                return leaf[way]
            name, bound = chosen[way]
            return name, bound, built((*way, (name, bound, True))), built((*way, (name, bound, False)))

        model = Model(base, (*model.trees, Tree(built(()))))
    return model


@dataclass(frozen=True)
class UrlFilter:
    model: Model | None
    table: DataFrame | None
    prior: float
    default: str


def fit(urls: DataFrame, sample: int = SAMPLE, trees: int = TREES) -> UrlFilter:
    """From rows of (url, host, path, action); action null: not labelled."""
    rows = checkpointed(labelled(urls, sample))
    n, blocked = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    if not n or blocked in (0, n):
        return UrlFilter(None, None, 0.0, "block" if n and blocked else "allow")
    table = checkpointed(statistics(rows))
    return UrlFilter(boosted(with_shares(rows, table, blocked / n, F.col("y")), trees), table, blocked / n, "allow")


def scored(urls: DataFrame, model: UrlFilter) -> DataFrame:
    """``urls`` (url, host, path and others) with ``score``: log odds of block by the trees; null without trees."""
    if model.model is None:
        return urls.withColumn("score", F.lit(None).cast("double"))
    host, path, url = F.col("host"), F.col("path"), F.coalesce("url", F.lit(""))
    wide = urls.select("*", *[c.alias(k) for k, c in lexical(url, host, path).items()], *[c.alias("k_" + k) for k, c in suffixes(host, path).items()])
    return with_shares(wide, model.table, model.prior).select(*urls.columns, model.model.score().alias("score"))


def judge(pages: DataFrame, rules: list[Rule], sample: int = SAMPLE, trees: int = TREES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, score (of the trees, where no rule decides) for each row of ``pages``."""
    host, path = parts(pages[url_col])
    split = pages.select(pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), host.alias("host"), path.alias("path"))
    text, action = decided(F.col("host"), F.col("path"), rules)
    urls = split.select("*", text.alias("rule"), action.alias("action"))
    model = fit(urls, sample, trees)
    out = scored(urls, model)
    score = F.when(F.col("action").isNull(), F.col("score"))
    verdict = F.coalesce("action", F.when(score > 0, "block").when(score <= 0, "allow"), F.lit(model.default))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), score.alias("score"))
