"""Text jobs over whole documents and pages (title-only items T33, T38-T40,
T47-T49). Tokenisation is a built-in regex split (Unicode letters and
digits), so the work stays in JVM expressions and scales with the corpus."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.cells import runs
from tillwise.functions.prefix import ordered_prefix_sums
from tillwise.functions.topk import top_k_per_group
from tillwise.session import measured_checkpoint, reliable_checkpoint

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
EMAIL_CANDIDATE = r"[^ \t\n\r@<>]+@[^ \t\n\r@<>]+"
EMAIL_VALID = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$"
PRICE = r"([0-9]+[.,][0-9]{2})"

# Negation words per language
NEGATORS = {
    "en": ["not", "no", "never", "nobody", "nothing", "none", "neither", "nor"],
    "fr": ["ne", "pas", "jamais", "rien", "personne", "aucun"],
    "de": ["nicht", "kein", "keine", "nie", "niemand", "nichts"],
    "es": ["no", "nunca", "nadie", "nada", "ninguno", "tampoco"],
}


def tokens(text) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), TOKEN_SPLIT), lambda w: w != "")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Corpus word counts (explode + map-side partial counts)."""
    return docs.select(F.explode(tokens(text)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Protocol, host, path, query and fragment of each URL."""
    u = F.col(url)
    return pages.select("page_id", url, *[F.parse_url(u, F.lit(p)).alias(p.lower())
                                          for p in ("PROTOCOL", "HOST", "PATH", "QUERY", "REF")])


def email_candidates(docs: DataFrame, text: str = "text", by: str = "lang") -> DataFrame:
    """Every ``x@y`` token of the whole text, flagged valid or not."""
    e = docs.select("doc_id", by, F.explode(F.regexp_extract_all(F.col(text), F.lit(EMAIL_CANDIDATE), 0))
                    .alias("candidate"))
    return e.withColumn("is_valid", F.col("candidate").rlike(EMAIL_VALID))


def email_validity(docs: DataFrame, text: str = "text", by: str = "lang") -> DataFrame:
    """Candidates, valid addresses and validity rate per group."""
    c = email_candidates(docs, text, by)
    return c.groupBy(by).agg(F.count(F.lit(1)).alias("n_candidates"),
                             F.count_if("is_valid").alias("n_valid"),
                             F.avg(F.col("is_valid").cast("int")).alias("valid_rate"))


def prices_from_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Decimal prices found anywhere in the raw page, one row each."""
    p = pages.select("page_id", F.posexplode(F.regexp_extract_all(F.col(html), F.lit(PRICE), 1))
                     .alias("pos", "raw"))
    return p.withColumn("price", F.regexp_replace("raw", ",", ".").cast("double"))


def suggest_prefix(word_table: DataFrame, k: int = 5) -> DataFrame:
    """For every prefix of every word, the ``k`` most frequent
    completions (count desc, word asc). Hot prefixes are ranked through the
    salted two-stage top-k, not in one task."""
    pre = word_table.where(F.length("word") > 0).select("word", "n", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("len"))
    pre = pre.select(F.expr("substring(word, 1, len)").alias("prefix"), "word", "n")
    return top_k_per_group(pre, ["prefix"], [F.col("n").desc(), F.col("word").asc()], k)


def negation_share(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Share of sentences containing a negation word, per language."""
    neg = F.create_map(*[x for k, v in NEGATORS.items() for x in (F.lit(k), F.array(*[F.lit(w) for w in v]))])
    s = docs.select(lang, F.explode(F.split(F.col(text), r"[.!?]+")).alias("sentence"))
    s = s.where(F.trim("sentence") != "")
    s = s.withColumn("flag", F.coalesce(F.arrays_overlap(tokens("sentence"), F.element_at(neg, F.col(lang))),
                                        F.lit(False)))
    return s.groupBy(lang).agg(F.count(F.lit(1)).alias("n_sentences"), F.count_if("flag").alias("n_negated"),
                               F.avg(F.col("flag").cast("int")).alias("negation_share"))


def char_error_rate(pairs: DataFrame, ref: str = "ref", hyp: str = "hyp") -> DataFrame:
    """Edit distance / reference length per pair (built-in levenshtein)."""
    d = F.levenshtein(F.col(ref), F.col(hyp))
    return pairs.withColumn("edits", d).withColumn(
        "cer", F.when(F.length(ref) > 0, d / F.length(ref)))


def bpe_merges(word_table: DataFrame, n_merges: int = 20) -> DataFrame:
    """Learn the first ``n_merges`` byte-pair merges on the corpus word
    table (word, n). Words are space-separated symbol strings; each round
    counts adjacent pairs (weighted by word frequency, one aggregation),
    takes the most frequent pair (ties: smallest pair) and rewrites every
    word with a non-overlapping left-to-right replacement. One job per merge
    over the distinct-word table, checkpointed each round."""
    from tillwise.session import reliable_checkpoint
    spark = word_table.sparkSession
    w = word_table.select(F.array_join(F.split("word", ""), " ").alias("sym"), "n")
    w = reliable_checkpoint(w)
    merges = []
    for rank in range(1, n_merges + 1):
        parts = F.split("sym", " ")
        pairs = w.select("n", F.explode(F.arrays_zip(F.slice(parts, 1, F.size(parts) - 1),
                                                     F.slice(parts, 2, F.size(parts)))).alias("p"))
        best = (pairs.groupBy(F.col("p.0").alias("a"), F.col("p.1").alias("b")).agg(F.sum("n").alias("count"))
                .orderBy(F.col("count").desc(), "a", "b").first())
        if best is None:
            break
        a, b = best["a"], best["b"]
        merges.append((rank, a, b, a + b, int(best["count"])))
        pat = " " + "\\Q" + a + "\\E" + " " + "\\Q" + b + "\\E" + "(?= )"
        padded = F.concat(F.lit(" "), F.col("sym"), F.lit(" "))
        w = reliable_checkpoint(w.select(F.trim(F.regexp_replace(padded, F.lit(pat), F.lit(" " + a + b)))
                                         .alias("sym"), "n"))
    return spark.createDataFrame(merges, "rank int, left string, right string, merged string, count long")


# ------------------------------------------------------------ T15 / T45 search
K1, B = 1.2, 0.75


def _bm25_part(tf: Column, dl: Column, n: Column, avg_dl: Column, df: Column) -> Column:
    idf = F.log(F.lit(1.0) + (n - df + 0.5) / (df + 0.5))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * dl / avg_dl))


def bm25(docs: DataFrame, terms: list[str], text: str = "text", key: str = "doc_id") -> DataFrame:
    """BM25 of a fixed list of terms over every document: (key, score),
    documents without any of the terms left out. Term frequencies are counted
    inside the row; the corpus statistics are one aggregated row, so the scores
    need no shuffle."""
    def count(term: str) -> Column:
        return F.size(F.filter("w", lambda x: x == F.lit(term))).cast("double")

    found = {f"tf{i}": count(t) for i, t in enumerate(terms)}
    rows = docs.select(key, tokens(text).alias("w")).select(key, F.size("w").cast("double").alias("dl"),
                                                            *[c.alias(n) for n, c in found.items()])
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avg_dl"),
                     *[F.count_if(F.col(n) > 0).alias(n) for n in found]).first()
    score = F.lit(0.0)
    for name in found:
        score = score + _bm25_part(F.col(name), F.col("dl"), F.lit(float(stats["n"])), F.lit(float(stats["avg_dl"] or 1.0)),
                                   F.lit(float(stats[name])))
    return rows.where(F.greatest(*[F.col(n) for n in found], F.lit(0.0)) > 0).select(key, score.alias("score"))


def _best(table: pa.Table, k: int) -> pa.RecordBatch | None:
    """Of one cell: each query's ``k`` best documents. Rows of the queries have query, word and weight, those
    of the documents doc, word and part, sorted by document."""
    asks = np.asarray(table.column("query").is_valid())
    whole = lambda name, rows: table.column(name).filter(pa.array(rows)).to_numpy()
    queries, query = np.unique(whole("query", asks), return_inverse=True)
    words, word = np.unique(whole("word", asks), return_inverse=True)
    doc_of, at, part = whole("doc", ~asks), whole("word", ~asks), whole("part", ~asks)
    if not queries.size or not doc_of.size:
        return None
    # the queries of each word, one after another
    order = np.argsort(word, kind="stable")
    query, weight = query[order], whole("weight", asks)[order]
    starts = np.searchsorted(word[order], np.arange(words.size + 1))
    place = np.minimum(np.searchsorted(words, at), words.size - 1)
    asked = words[place] == at
    doc_of, place, part = doc_of[asked], place[asked], part[asked]
    docs, doc = np.unique(doc_of, return_inverse=True)
    out = []
    step = max(k, 2_000_000 // queries.size)
    for lo in range(0, docs.size, step):
        n = min(step, docs.size - lo)
        first, last = np.searchsorted(doc, [lo, lo + n])
        score = np.zeros(queries.size * n)
        hits = np.cumsum(starts[place[first:last] + 1] - starts[place[first:last]])
        cuts = first + np.searchsorted(hits, np.arange(0, hits[-1], 1_000_000))
        for a, b in zip(cuts, [*cuts[1:], last]):  # about a million hits at a time
            many = starts[place[a:b] + 1] - starts[place[a:b]]
            hit = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts[place[a:b]], many)
            # in the order of the rows, as a plain sum
            np.add.at(score, query[hit] * n + np.repeat(doc[a:b] - lo, many), np.repeat(part[a:b], many) * weight[hit])
        score = score.reshape(queries.size, n)
        # every part of a score is over zero, and scores rank as rounded to 6 decimals
        micros = np.where(score > 0, np.floor(score * 1e6 + 0.5), -1.0)
        top = np.empty((queries.size, min(k, n)), dtype=np.intp)
        for q in range(queries.size):
            kth = np.partition(micros[q], n - min(k, n))[n - min(k, n)]
            over = np.flatnonzero(micros[q] > kth)
            top[q] = np.concatenate([over, np.flatnonzero(micros[q] == kth)[:min(k, n) - over.size]])
        value = np.take_along_axis(micros, top, axis=1).ravel()
        q = np.repeat(np.arange(queries.size), top.shape[1])
        found = value >= 0
        out.append((queries[q[found]], docs[lo + top.ravel()[found]], value[found] / 1e6))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[i] for o in out])) for i in range(3)], names=["query", "doc", "score"])


def retrieve_topk(docs: DataFrame, queries: DataFrame, query_key: str, k: int = 10, text: str = "text",
                  key: str = "doc_id", block: int = 200_000, chunk: int = 1024) -> DataFrame:
    """For each row of a stated query set the ``k`` documents of highest
    BM25 over its distinct words: (query_key, key, score, rank). The corpus is
    reduced to counts per (document, word) of the words that queries have. About
    ``block`` of these counts, of whole documents, and ``chunk`` queries meet in a cell,
    which returns ``k`` documents of each query at most: neither a frequent word nor the
    scores of all documents come together in a task. Scores are rounded before ranking so
    that ties go by document."""
    spark = docs.sparkSession
    asked = queries.select(F.col(query_key).alias("query_key"), F.explode(F.array_distinct(tokens(text))).alias("word"))
    asked = asked.groupBy("query_key", "word").agg(F.count(F.lit(1)).alias("times"))
    names = reliable_checkpoint(asked.select("query_key").distinct().withColumn("query", F.monotonically_increasing_id()))
    vocabulary = measured_checkpoint(asked.select("word").distinct().withColumn("number", F.monotonically_increasing_id()))
    # a file may hold all documents in one row group: dealt out, no task splits and counts the words of a file
    dealt = docs.select(F.col(key).alias("doc_key"), F.col(text).alias("text")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_key", "text")
    words = (dealt.select("doc_key", tokens("text").alias("w")).select("doc_key", F.size("w").cast("double").alias("dl"), "w")
             .select("doc_key", "dl", F.explode("w").alias("word")))
    tf = (words.join(vocabulary, "word").groupBy("doc_key", F.col("number").alias("word"))
          .agg(F.count(F.lit(1)).cast("double").alias("tf"), F.first("dl").alias("dl")))
    tf = reliable_checkpoint(tf)
    all_docs = dealt.select(F.size(tokens("text")).alias("dl")).agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avg_dl")).first()
    n_docs, avg_dl = F.lit(float(all_docs["n"])), F.lit(float(all_docs["avg_dl"] or 1.0))
    ids = reliable_checkpoint(ordered_prefix_sums(tf.select("doc_key").distinct(), [F.col("doc_key")], {}, row_number="doc"))
    df = tf.groupBy("word").agg(F.count(F.lit(1)).cast("double").alias("df"))
    parts = max(1, math.ceil(tf.count() / block))
    chunks = max(1, math.ceil(names.count() / chunk))
    cells = ["part_no", "chunk_no"]
    columns = [*cells, "doc", "word", "query", "weight", "part"]
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    null = F.lit(None)
    # a score is the sum of idf * times * f(tf, dl); the queries bring the first two
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    mine = (asked.join(names, asked["query_key"].eqNullSafe(names["query_key"])).drop("query_key").join(vocabulary, "word")
            .select("query", F.col("number").alias("word"), "times").join(df, "word")
            .select("query", "word", (idf * F.col("times")).alias("weight"), F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int").alias("chunk_no"))
            .withColumn("part_no", each(parts)).withColumns({"doc": null.cast("long"), "part": null.cast("double")}))
    share = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / avg_dl))
    theirs = (tf.join(ids.withColumnRenamed("doc_key", "same_key"), F.col("doc_key").eqNullSafe(F.col("same_key")))
              .select("doc", "word", share.alias("part"), F.pmod(F.xxhash64("doc"), F.lit(parts)).cast("int").alias("part_no"))
              .withColumn("chunk_no", each(chunks)).withColumns({"query": null.cast("long"), "weight": null.cast("double")}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in runs(batches, cells):
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                found = _best(table.slice(lo, hi - lo).combine_chunks(), k)
                if found:
                    yield found

    hits = (mine.select(*columns).unionByName(theirs.select(*columns))
            .repartition(min(parts * chunks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts * chunks // 16)), *cells)
            .sortWithinPartitions(*cells, "doc", "word").mapInArrow(run, "query long, doc long, score double"))
    # documents are numbered in the order of their keys
    best = reliable_checkpoint(top_k_per_group(hits, ["query"], [F.col("score").desc(), F.col("doc").asc()], k))
    return (best.join(ids, "doc").join(names, "query")
            .select(F.col("query_key").alias(query_key), F.col("doc_key").alias(key), "score", "rank"))


def holding(best: DataFrame, docs: DataFrame, queries: DataFrame, query_key: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``best`` with ``hit``: 1 if the document's text holds the query's whole text. The few rows of
    ``best`` bring the text asked for to the documents, whose texts are read past them: no task sorts
    or keeps the texts of its share."""
    asked = best.join(queries.select(query_key, F.col(text).alias("_asked")), query_key)
    asked = reliable_checkpoint(asked)
    size = asked.agg(F.coalesce(F.sum(F.octet_length("_asked") + 64), F.lit(0))).first()[0]
    asked = asked.hint("broadcast" if size <= 16 << 20 else "shuffle_hash")
    hit = F.col("_text").contains(F.col("_asked")).cast("int").alias("hit")
    return reliable_checkpoint(docs.select(key, F.col(text).alias("_text")).join(asked, key).select(*best.columns, hit))
