import hashlib
import string
from collections import Counter

from tillwise.llm import exact_dedup

LOW = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def expected(rows, pick):
    norm = [(i, (t or "").translate(LOW)) for i, t, *_ in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = Counter()
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = pick(ids) if ids else None
        out[i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()] += 1
    return out


def test_classes(docs, docs_rows):
    for keep, pick in (("smallest", min), ("largest", max)):
        got = Counter(tuple(r) for r in exact_dedup.exact_classes(docs, keep).collect())
        assert got == expected(docs_rows, pick)


def test_drop_keeps_columns_and_one_text_each(docs, clashing, empty_docs):
    kept = exact_dedup.drop_exact_copies(clashing)
    assert kept.columns == clashing.columns
    texts = [(r["text"] or "").translate(LOW) for r in kept.select("doc_id", "text").distinct().collect()]
    assert len(texts) == len(set(texts)) == exact_dedup.exact_classes(docs).select("text_sha256").distinct().count()
    assert exact_dedup.drop_exact_copies(empty_docs).count() == 0
    assert exact_dedup.exact_classes(empty_docs).count() == 0


def test_one_row_of_each_class_stays(spark):
    rows = [(None, "Copy", "a"), (None, "copy", "b"), (None, "copy", "c"), (4, "x", "d"), (4, "x", "e"), (5, "X", "f"), (4, "copies", "g"),
            (None, None, "h"), (None, "", "i"), (7, "one", "j")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    for keep, x in (("smallest", 4), ("largest", 5)):
        got = [(r["doc_id"], (r["text"] or "").lower()) for r in exact_dedup.drop_exact_copies(docs, keep).collect()]
        assert sorted(got, key=str) == sorted([(None, "copy"), (x, "x"), (4, "copies"), (None, ""), (7, "one")], key=str)
