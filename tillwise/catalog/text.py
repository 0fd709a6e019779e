"""Registered text queries over whole documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwise.catalog.base import query
from tillwise.operators import text as tx
from tillwise.sources.tables import read_table

TOK = r"list_filter(regexp_split_to_array(lower({t}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"
WORDS_SQL = ("words as (select w as word, count(*) as n from documents, unnest(" + TOK.format(t="text")
             + ") as u(w) group by 1)")


@query("word_count", sql=f"with {WORDS_SQL} select * from words")
def q_word_count(spark, sf_dir):
    return tx.word_counts(read_table(spark, sf_dir, "documents"))


@query("url_parts",
       sql=r"""select page_id, url,
                      nullif(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1), '') as protocol,
                      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1) as host,
                      regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path,
                      case when regexp_matches(url, '^[^#]*\?') then regexp_extract(url, '^[^#]*\?([^#]*)', 1) end
                        as query,
                      case when contains(url, '#') then regexp_extract(url, '#(.*)$', 1) end as ref
               from pages""")
def q_url_parts(spark, sf_dir):
    return tx.url_parts(read_table(spark, sf_dir, "pages"))


EMAIL_SQL = r"""
cand as (select doc_id, lang, c as candidate,
                regexp_matches(c, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}$') as is_valid
         from documents, unnest(regexp_extract_all(text, '[^ \t\n\r@<>]+@[^ \t\n\r@<>]+')) as u(c))"""


@query("valid_emails",
       sql=f"""with {EMAIL_SQL} select lang, count(*) as n_candidates, count(*) filter (where is_valid) as n_valid,
                    avg(cast(is_valid as integer)) as valid_rate from cand group by lang""",
       doubles=("valid_rate",))
def q_valid_emails(spark, sf_dir):
    return tx.email_validity(read_table(spark, sf_dir, "documents"))


@query("email_candidates", sql=f"with {EMAIL_SQL} select * from cand")
def q_email_candidates(spark, sf_dir):
    return tx.email_candidates(read_table(spark, sf_dir, "documents"))


@query("price_from_pages",
       sql="""select page_id, u.pos - 1 as pos, u.raw, cast(replace(u.raw, ',', '.') as double) as price
              from pages, unnest(regexp_extract_all(html, '([0-9]+[.,][0-9]{2})', 1))
                            with ordinality as u(raw, pos)""",
       doubles=("price",), longs=("pos",))
def q_price_from_pages(spark, sf_dir):
    return tx.prices_from_pages(read_table(spark, sf_dir, "pages"))


@query("suggest_prefix",
       sql=f"""with {WORDS_SQL},
               p as (select substring(word, 1, cast(l as integer)) as prefix, word, n
                     from words, unnest(range(1, length(word) + 1)) as r(l))
               select prefix, word, n, row_number() over (partition by prefix order by n desc, word) as rank
               from p qualify rank <= 5""",
       longs=("rank",))
def q_suggest_prefix(spark, sf_dir):
    return tx.suggest_prefix(tx.word_counts(read_table(spark, sf_dir, "documents")), k=5)


def _neg_case() -> str:
    arms = " ".join(f"when '{k}' then [{', '.join(repr(w) for w in v)}]" for k, v in tx.NEGATORS.items())
    return f"case lang {arms} end"


@query("negation_flags",
       sql=f"""with s as (select lang, sentence from documents,
                                 unnest(regexp_split_to_array(text, '[.!?]+')) as u(sentence)
                          where trim(sentence) <> ''),
               f as (select lang, coalesce(list_has_any({TOK.format(t="sentence")}, {_neg_case()}), false) as flag
                     from s)
               select lang, count(*) as n_sentences, count(*) filter (where flag) as n_negated,
                      avg(cast(flag as integer)) as negation_share from f group by lang""",
       doubles=("negation_share",))
def q_negation_flags(spark, sf_dir):
    return tx.negation_share(read_table(spark, sf_dir, "documents"))


# The accented letters of the four languages. DuckDB's levenshtein counts
# UTF-8 bytes, Spark's characters, so the oracle gives each letter a control character.
ACCENTED = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
CONTROLS = [*range(1, 9), *range(14, 32)][:len(ACCENTED)]
ONE_BYTE = "translate({t}, '" + ACCENTED + "', " + " || ".join(f"chr({c})" for c in CONTROLS) + ")"


@query("ocr_error_rate",
       sql="""with s as (select conv_id, text, lag(turn) over w as turn, lag(text) over w as ref from conversations
                         window w as (partition by conv_id order by turn)),
                   d as (select conv_id, turn, length(ref) as n, levenshtein(""" + ONE_BYTE.format(t="ref") + ", " + ONE_BYTE.format(t="text") + """) as edits
                         from s where ref is not null)
              select conv_id, turn, edits, case when n > 0 then edits / n end as cer from d""",
       doubles=("cer",), longs=("edits", "turn"))
def q_ocr_error_rate(spark, sf_dir):
    """T49 on consecutive conversation turns (reference = a turn, hypothesis
    = the next one)."""
    from tillwise.functions.prefix import keyed_sequence
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    # pair each turn with the previous one of its conversation (range-split,
    # so a very long conversation is not one task)
    s = keyed_sequence(c, "conv_id", ["turn"], ["text", "turn"])
    pairs = s.where(F.col("prev_text").isNotNull()).select(
        "conv_id", F.col("prev_turn").alias("turn"), F.col("prev_text").alias("ref"), F.col("text").alias("hyp"))
    return tx.char_error_rate(pairs).select("conv_id", "turn", "edits", "cer")


BM25_TERMS = ["the", "license", "idiot", "ention", "que"]
#: BM25 from counts per (document, word): k1 = 1.2, b = 0.75
BM25_SQL = f"""
doc as (select doc_id, {TOK.format(t="text")} as w from documents),
size as (select doc_id, cast(len(w) as double) as dl from doc),
whole as (select count(*) as n, avg(dl) as avg_dl from size),
tf as (select doc_id, u.w as word, cast(count(*) as double) as tf from doc, unnest(doc.w) as u(w) group by all),
df as (select word, cast(count(*) as double) as df from tf group by word),
part as (select tf.doc_id, tf.word, ln(1.0 + (whole.n - df.df + 0.5) / (df.df + 0.5)) * tf.tf * 2.2
                / (tf.tf + 1.2 * (0.25 + 0.75 * size.dl / whole.avg_dl)) as part
         from whole, tf join df on df.word = tf.word join size on size.doc_id = tf.doc_id)"""


@query("bm25", sql=f"""with {BM25_SQL} select doc_id, sum(part) as score from part
                       where word in ({", ".join(repr(t) for t in BM25_TERMS)}) group by doc_id""", doubles=("score",))
def q_bm25(spark, sf_dir):
    """BM25 of a fixed list of terms over all documents."""
    return tx.bm25(read_table(spark, sf_dir, "documents"), BM25_TERMS)


RETRIEVE_SQL = f"""with {BM25_SQL},
asked as (select distinct item_id, u.w as word from benchmark, unnest({TOK.format(t="text")}) as u(w)),
score as (select item_id, doc_id, round(sum(part), 6) as score from part join asked on asked.word = part.word group by all),
best as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from score qualify rank <= 10)"""


@query("retrieve_topk", sql=RETRIEVE_SQL + " select * from best", doubles=("score",), longs=("rank",))
def q_retrieve_topk(spark, sf_dir):
    """The ten best documents for every benchmark item."""
    return tx.retrieve_topk(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), "item_id", 10)


@query("retrieve_eval",
       sql=RETRIEVE_SQL + """, j as (select item_id, rank, score, case when contains(d.text, b.text) then 1 else 0 end as hit
                                     from best join documents d using (doc_id) join benchmark b using (item_id)),
            i as (select *, row_number() over (partition by item_id order by hit desc, rank) as ideal from j)
            select item_id, sum(hit) as hits, case when sum(hit) > 0 then sum(hit / log2(rank + 1.0)) / sum(hit / log2(ideal + 1.0)) end as ndcg_at_10
            from i group by item_id""",
       doubles=("ndcg_at_10",), longs=("hits",))
def q_retrieve_eval(spark, sf_dir):
    """T45 scored with T16: a retrieved document is relevant if it holds the item's whole text."""
    from tillwise.operators.metrics import ranking_metrics
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    best = tx.retrieve_topk(docs, items, "item_id", 10)
    j = tx.holding(best, docs, items, "item_id").withColumn("order", -F.col("rank"))
    m = ranking_metrics(j, "item_id", "order", "hit", "doc_id", 10)
    return m.select("item_id", F.col("relevant").cast("long").alias("hits"), "ndcg_at_10")
