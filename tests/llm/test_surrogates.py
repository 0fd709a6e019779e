import re

import pytest
from pyspark.sql import functions as F

from tillwise.llm import surrogates

ROWS = [
    (1, "mail the.72@mail3.example.com or THE.72@MAIL3.example.com. call +1 (017) 555-7713, +10175557713 x"),
    (2, "ip 169.122.221.182. card 4952935900253052*** 4111 1111 1111 1111 and 4111-1111-1111-1111!! ssn 123-45-6789"),
    (3, None), (4, ""), (None, "again 169.122.221.182"),
    (5, "Mrs Anna met Mr. José Müller and Госпожа Иванова; Frau Anna, Mr Anna. IBAN DE89370400440532013000 end"),
    (6, '555-123-4567 plain 12 34 version 1.2.3 token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"'),
    (6, '555-123-4567 plain 12 34 version 1.2.3 token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"'),
]


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


@pytest.fixture(scope="module")
def out(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("n_replaced", F.lit("clashes")).repartition(3)
    return surrogates.replace(docs, "key").collect()


def test_replaced(out):
    by = {r["doc_id"]: r for r in out}
    assert len(out) == len(ROWS) and by[3]["text"] is None and by[4]["text"] == ""
    one = by[1]["text"]
    m = re.fullmatch(r"mail (\S+) or (\S+)\. call (\+1 \(\d{3}\) \d{3}-\d{4}), (\+1\d{10}) x", one)
    assert m and m[1].lower() == m[2].lower() and m[1].endswith(".com")  # one entity, however it is written
    assert re.sub(r"[^+\d]", "", m[3]) == m[4] and "0175557713" not in re.sub(r"\D", "", one)
    two = by[2]["text"]
    m = re.fullmatch(r"ip (\S+)\. card (\d{16})\*\*\* (\d{4} \d{4} \d{4} \d{4}) and (\d{4}-\d{4}-\d{4}-\d{4})!! ssn (\d{3}-\d{2}-\d{4})", two)
    assert m and all(0 <= int(x) <= 255 for x in m[1].split("."))
    assert luhn(m[2]) == luhn("4952935900253052") and luhn(m[3]) and m[3].replace(" ", "") == m[4].replace("-", "")
    assert by[None]["text"] == "again " + m[1]  # the same in every document
    m = re.fullmatch(r"Mrs (\w+) met Mr\. (\w+) (\w+) and Госпожа (\w+); Frau (\w+), Mr (\w+)\. IBAN (DE\d{20}) end", by[5]["text"])
    assert m and m[1] == m[5] and m[1].endswith("a") and m[2].endswith("é") and re.fullmatch(r"[А-Я][а-я]{5}а", m[4])
    assert by[6]["text"].endswith('plain 12 34 version 1.2.3 token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"')
    assert [r["n_replaced"] for r in out if r["doc_id"] == 6] == [1, 1]
    for _, text in ROWS:
        for entity in re.findall(r"\S+@\S+\w|\d{3}-\d{2}-\d{4}|\d+\.\d+\.\d+\.\d+|4952935900253052", text or ""):
            assert not any(entity in (r["text"] or "") for r in out)


def test_distinct_and_keyed(spark):
    rows = [(a * 256 + b, f"{a}.{b}.7.9 and {a % 10}{b % 10}1-55-{a * 256 + b:04d} Mr Al{chr(97 + b % 26)}") for a in range(12) for b in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    one = {r["doc_id"]: r["text"] for r in surrogates.replace(docs, "k1").collect()}
    ips = {i: t.split()[0] for i, t in one.items()}
    assert len(set(ips.values())) == len(rows) and all(ips[i] != t.split()[0] for i, t in rows)
    names = {t.split()[-1]: one[i].split()[-1] for i, t in rows}
    assert len(names) == 26 == len(set(names.values())) and all(a != b for a, b in names.items())
    two = {r["doc_id"]: r["text"] for r in surrogates.replace(docs, "k2").collect()}
    assert one != two


def twin(m, kind, key, attempt=0):
    """The permutation in plain Python: (canonical form, surrogate)."""
    import hashlib
    head = tail = ""
    if kind == "phone":
        head = re.match(r"(?:\+\d{1,3}(?=[ .(-])|\+\d)?", m)[0]
    elif kind == "name":
        head = re.match(rf"^{surrogates.TITLED}", m)[0]
    elif kind == "iban":
        head = m[:2]
    elif kind == "email":
        tail = re.search(r"\.[^.]*$", m)[0]
    elif kind == "card":
        tail = m[-1]
    core = m[len(head):len(m) - len(tail)]
    said = head.lower() if kind != "name" else "f" if re.match(rf"(?:{surrogates.FEMALE})\b", head) else "m"
    if kind == "ip":
        cells = [(None, int(o), 256) for o in core.split(".")]
    else:
        cells = []
        for k, c in enumerate(core):
            alphabet = next((a for a in surrogates.CLASSES if c.lower() in a), None)
            if alphabet is None or kind == "name" and (k + 1 == len(core) or core[k + 1] == " "):
                cells.append((c, 0, 1))
            else:
                cells.append((alphabet, alphabet.index(c.lower()), len(alphabet)))
    own = [x for x in cells if x[2] > 1]
    write = lambda part: ",".join(f"{i}:{r}" for _, i, r in part)
    endings = "".join(a.lower() for a, _, r in cells if r == 1) if kind == "name" else ""
    canonical = "|".join([said, tail.lower(), endings, write(own)])
    half = -(-len(own) // 2)
    x, y = own[:half], own[half:]
    for n in range(4):
        moved, other = (y, x) if n % 2 == 0 else (x, y)
        tag = "|".join([key, kind, str(attempt), said, tail.lower() if kind != "card" else "", str(n), write(other)])
        digest = hashlib.sha256(tag.encode()).hexdigest()
        moved = [(a, (i + int(digest[j % 16 * 4:j % 16 * 4 + 4], 16)) % r, r) for j, (a, i, r) in enumerate(moved)]
        x, y = (x, moved) if n % 2 == 0 else (moved, y)
    new = x + y
    if kind == "ip":
        return canonical, head + ".".join(str(i) for _, i, _ in new)
    out, queue = "", iter(new)
    for c, (a, _, r) in zip(core, cells):
        if r == 1:
            out += a
        else:
            a, i, _ = next(queue)
            out += a[i].upper() if c != c.lower() else a[i]
    if kind == "card":
        check = lambda part: -sum(sum(divmod(2 * d, 10)) if (len(part) - k) % 2 else d for k, d in enumerate(part)) % 10
        digits = lambda part: [i for _, i, r in part if r == 10]
        tail = str((check(digits(new)) + int(tail) - check(digits(own))) % 10)
    return canonical, head + out + tail


KNOWN = [("the.72@mail3.example.com", "email"), ("A@B.c", "email"), ("169.122.221.182", "ip"), ("4111 1111 1111 1111", "card"), ("4952935900253052", "card"),
         ("123-45-6789", "ssn"), ("+1 (017) 555-7713", "phone"), ("555-123-4567", "phone"), ("DE89370400440532013000", "iban"), ("Mrs Anna", "name"),
         ("Mr. José Müller", "name"), ("Госпожа Иванова", "name"), ("Herr Dr. Łukasz Żak", "name"), ("Mr Νίκος Παπαδόπουλος", "name"), ("Ms Արմեն", "name")]


def test_against_the_permutation_in_plain_python(spark):
    rows = spark.createDataFrame([(m, k) for m, k in KNOWN], "m string, want string")
    for attempt in (0, 3):
        got = {r.m: r for r in rows.select("m", "want", surrogates.surrogate(F.col("m"), "key", lambda k, c: F.lit(attempt)).alias("x")).select("m", "want", "x.*").collect()}
        for m, kind in KNOWN:
            assert got[m].kind == kind
            assert (got[m].canonical, got[m].s) == twin(m, kind, "key", attempt), m


def test_whole_texts_against_plain_python(spark):
    docs = spark.createDataFrame([(i, f"one {m}, two {KNOWN[i - 1][0]} end") for i, (m, _) in enumerate(KNOWN)], "doc_id long, text string").repartition(3)
    assert surrogates.attempts(docs, "key") is None
    new = {m: twin(m, k, "key")[1] for m, k in KNOWN}
    for r in surrogates.replace(docs, "key").collect():
        assert r.text == f"one {new[KNOWN[r.doc_id][0]]}, two {new[KNOWN[r.doc_id - 1][0]]} end" and r.n_replaced == 2


def test_full_formats_stay_distinct(spark):
    """All 25 names of one format, and all 50 addresses of another: some would keep their own at first, and none is free for them."""
    names = [f"Mr A{a}{b}t" for a in "aeiou" for b in "aeiou"] + [f"Mr {A}{b}t" for A in "EIOU" for b in "aeiou"]
    addresses = [f"{a}@{d}.com" for a in "aeiou" for d in range(10)]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(names + addresses)], "doc_id long, text string").repartition(3)
    tokens = 0
    for key in ("a", "b"):
        got = [r.text for r in surrogates.replace(docs, key).orderBy("doc_id").collect()]
        assert len(set(got)) == len(got)
        assert all(x != y for x, y in zip(got, names + addresses))
        assert all(x.startswith("Mr ") for x in got[:len(names)]) and all(re.fullmatch(r"[a-z]+@[a-z0-9]+\.com", x) for x in got[len(names):])
        tokens += sum(len(x) > 8 for x in got)
    assert tokens


def test_scripts(spark):
    names = ["Mr Νίκος", "Mr Σ" + "ς" * 3, "Mr Ǆǆǆ", "Ms Արմեն", "Frau Çiğdem", "Mr Łżź", "Господин Їжак", "Mr Ꭰꭰꭰ", "Mr Ⲁⲁⲁ", "Mr Ⴀⴀⴀ"]
    docs = spark.createDataFrame([(i, f"{x} called. {x} left") for i, x in enumerate(names)], "doc_id long, text string").repartition(4)
    got = surrogates.replace(docs, "key").orderBy("doc_id").collect()
    seen = set()
    for r, x in zip(got, names):
        title, own = x.split(" ")
        m = re.fullmatch(rf"{title} (\w+) called\. {title} (\w+) left", r.text)
        assert m and m[1] == m[2] != own and r.n_replaced == 2, (x, r.text)
        seen.add(m[1])
    assert len(seen) == len(names)


def test_empty(empty_docs):
    assert surrogates.replace(empty_docs, "k").count() == 0


def test_groupings_and_titles_of_four_languages(spark):
    found = ["+44 20 7946 0958", "+33 1 42 68 53 00", "+49 30 901820", "+34 612 345 678", "555 123 4567", "+1 415 555 2671", "3782 822463 10005",
             "01 42 68 53 00", "020 7946 0958", "030 901820", "612 345 678", "Dr. Anna Schmidt", "Prof. Weber", "M. Dupont", "Mme Claire Petit", "Sr. Gomez",
             "Sra. Lopez", "Herr Dr. Meyer", "555-123-4567", "4111 1111 1111 1111"]
    plain = ["in 2019 12 345 people", "1 234 567 890 1234", "M Theory", "10 000 000"]
    docs = spark.createDataFrame([(i, f"say {x}, yes") for i, x in enumerate(found + plain)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["text"], r["n_replaced"]) for r in surrogates.replace(docs, "key").collect()}
    for i, x in enumerate(found):
        text, n = got[i]
        new = text.removeprefix("say ").removesuffix(", yes")
        assert n == 1 and new != x and re.sub(r"\w", "x", new) == re.sub(r"\w", "x", x), (x, text, n)
    assert luhn(got[6][0]) == luhn(found[6]) and got[0][0].startswith("say +44 ") and got[17][0].startswith("say Herr Dr. ")
    assert all(got[len(found) + i] == (f"say {x}, yes", 0) for i, x in enumerate(plain))
