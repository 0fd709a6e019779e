"""Surrogates for personal data, in DataFrame operations only.

Entities (e-mail addresses, telephone numbers, IPv4 addresses, payment cards, social
security numbers, account numbers, names after a title) are found by one pattern. A
surrogate is a keyed permutation of the entity's own format: its letters and digits
pass four Feistel rounds whose round function is a keyed SHA-256 of the other half, and
each character stays in its class (digit, vowel, consonant, accented letter, each by
script), keeps its case and its place among the separators. So:

* type and format: an address stays an address, an octet is 0 to 255, a card keeps
  whether its check digit is right, a calling code and a top-level domain stay;
* gender and script: titles stay, each part of a name keeps its last letter and its script;
* coreference: letter case and separators do not enter the rounds, so one entity has one
  surrogate in every document, however it is written;
* distinctness: a permutation has no collisions within a format. It is still checked over
  all distinct entities; entities that would share a surrogate, or keep their own, go to a
  next attempt (the smallest stays). What has none after ``ATTEMPTS`` of them, because its
  format is full or it has no letter of a known class, gets a keyed token of 96 bits in its
  place (after its title; as an address if it is one). These exceptions, usually none,
  are joined by document; all others need no join and no shuffle.

Names become letter strings of the same script, not names from a list.

Defined results: null text stays null, empty text empty; texts of any length are read whole;
null ids and repeated rows are treated like any; an empty table gives an empty result; of the
input's columns only the text changes, except that one called ``n_replaced`` is replaced by the
operator's own; other names may clash with none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import checkpointed, fresh

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Sra|Srta|Dra|Госпожа"
TITLES = ("Mrs|Mr|Ms|Miss|Herr|Frau|Monsieur|Madame|Mme|Mlle|M(?=\\.)|Señora|Señor|Sra|Srta|Sr|Dra|Dr|Prof|"
          "Господин|Госпожа")
TITLED = rf"(?:(?:{TITLES})\.? ){{1,3}}"
NAME = rf"(?<!\p{{L}}){TITLED}\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IPV4 = rf"(?<![\w.])(?:{OCTET}\.){{3}}{OCTET}(?!\w|\.\d)"
SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
NATIONAL = (r"\d{3} \d{3} \d{4}|0\d(?:[ .-]\d{2}){4}|0\d{2,4}[ -]\d{3,4}[ -]\d{3,4}|0\d{2,4}[ /-]\d{5,8}"
            r"|[6-9]\d{2}(?: \d{3}){2}|[6-9]\d{2}(?: \d{2}){3}")
PHONE = (r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[.-])\d{3}[ .-]?\d{4}(?!\w)|(?<!\w)\+\d{8,15}(?!\w)"
         r"|(?<![\w+])\+(?:\d[ .()/-]{0,2}){7,14}\d(?!\w)"
         rf"|(?<![\w+])(?<!\d[ .,/-])(?:{NATIONAL})(?![\w]|[ .,/-]\d)")
CARDS = r"\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}"
CARD = rf"(?<![\w-])(?:{CARDS})(?!\w)"
IBAN = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)"
ENTITY = "|".join((EMAIL, NAME, IPV4, SSN, PHONE, CARD, IBAN))
#: Whatever ENTITY finds has a digit, an at sign or a title: a cheap test that most texts fail.
HINT = rf"@|\d\d|\d\.\d|{TITLES}"
#: Classes of characters, each permuted within itself.
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåèéêëìíîïòóôöõùúûü", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ",
           "çñýðþ", "æøœ", "āăąēĕėęěĩīĭįōŏőũūŭůűų", "ćĉċčďđĝğġģĥħĵķĺļľłńņňŕŗřśŝşšţťŧŵŷźżž", "іїєў", "ґђћљњџѓќјѕ",
           "αεηιουωάέήίόύώϊϋ", "βγδζθκλμνξπρστφχψ", "".join(map(chr, range(0x561, 0x587))))
ATTEMPTS = 8
#: Letters for the 16 digits of a hash.
TOKEN = "bcdfghjklmnpqrst"


def _let(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def kind_of(m: Column) -> Column:
    return (F.when(m.contains("@"), "email")
            .when(m.rlike(rf"^{TITLED}"), "name")
            .when(m.rlike(rf"^{IPV4}$"), "ip")
            .when(m.rlike(rf"^{SSN}$"), "ssn")
            .when(m.rlike(r"^[A-Z]{2}\d\d"), "iban")
            .when(m.rlike(rf"^(?:{CARDS})$"), "card")
            .otherwise("phone"))


def _element(c: Column) -> Column:
    """(alphabet, index, radix) of a character; one outside the classes stays as it is, with radix 1."""
    low = F.lower(c)
    out = F.struct(c.alias("a"), F.lit(0).alias("i"), F.lit(1).alias("r"))
    for alphabet in CLASSES:
        out = F.when(F.instr(F.lit(alphabet), low) > 0,
                     F.struct(F.lit(alphabet).alias("a"), (F.instr(F.lit(alphabet), low) - 1).alias("i"),
                              F.lit(len(alphabet)).alias("r"))).otherwise(out)
    return out


def _said(half: Column) -> Column:
    return F.concat_ws(",", F.transform(half, lambda x: F.concat_ws(":", x["i"], x["r"])))


def _round(moved: Column, other: Column, tag: Column) -> Column:
    """``moved`` shifted, each element within its radix, by a keyed hash of ``other``."""
    def shift(digest: Column) -> Column:
        def one(x: Column, j: Column) -> Column:
            part = F.conv(F.substr(digest, (j % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
            return F.struct(x["a"].alias("a"), ((x["i"] + part) % x["r"]).alias("i"), x["r"].alias("r"))
        return F.transform(moved, one)
    return _let(F.sha2(F.concat_ws("|", tag, _said(other)), 256), shift)


def _luhn(digits: Column) -> Column:
    """Check digit for an array of digits."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, k: F.when((n - k) % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return (10 - F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10) % 10


def surrogate(m: Column, key: str, attempt) -> Column:
    """struct(kind, canonical, s, s_canonical) for a matched entity; ``attempt(kind, canonical)`` gives its attempt."""
    def said_head(p: Column) -> Column:
        """The kept beginning as it enters the rounds: of a title, only the gender."""
        return (F.when(p["kind"] != "name", F.lower(p["head"]))
                .when(p["head"].rlike(rf"^(?:{FEMALE})\b"), "f").otherwise("m"))

    def parts(k: Column) -> Column:
        head = (F.when(k == "phone", F.regexp_extract(m, r"^(?:\+\d{1,3}(?=[ .(-])|\+\d)?", 0))
                .when(k == "name", F.regexp_extract(m, rf"^{TITLED}", 0))
                .when(k == "iban", F.substring(m, 1, 2)).otherwise(F.lit("")))
        tail = (F.when(k == "email", F.regexp_extract(m, r"\.[^.]*$", 0))
                .when(k == "card", F.substring(m, -1, 1)).otherwise(F.lit("")))
        return F.struct(k.alias("kind"), head.alias("head"), tail.alias("tail"))

    def endings(e: Column) -> Column:
        """The letters that a name keeps."""
        kept = F.concat_ws("", F.transform(F.filter(e["all"], lambda x: x["r"] == 1), lambda x: F.lower(x["a"])))
        return F.when(e["p"]["kind"] == "name", kept).otherwise(F.lit(""))

    def elements(p: Column) -> Column:
        core = F.substr(m, F.length(p["head"]) + 1, F.length(m) - F.length(p["head"]) - F.length(p["tail"]))
        octets = F.transform(F.split(core, r"\."), lambda o: F.struct(F.lit("ip").alias("a"), o.cast("int").alias("i"), F.lit(256).alias("r")))
        def ending(chars: Column) -> Column:
            # each part of a name keeps its last letter, which often shows the gender
            def one(c: Column, k: Column) -> Column:
                last = (p["kind"] == "name") & (F.coalesce(F.get(chars, k + 1), F.lit(" ")) == " ")
                return F.when(last, F.struct(c.alias("a"), F.lit(0).alias("i"), F.lit(1).alias("r"))).otherwise(_element(c))
            return F.transform(chars, one)
        chars = _let(F.filter(F.split(core, ""), lambda c: c != ""), ending)
        return F.struct(p.alias("p"), core.alias("core"), F.when(p["kind"] == "ip", octets).otherwise(chars).alias("all"))

    def halves(e: Column) -> Column:
        own = F.filter(e["all"], lambda x: x["r"] > 1)
        # what identifies the entity: its elements, and the kept parts without case
        canonical = F.concat_ws("|", said_head(e["p"]), F.lower(e["p"]["tail"]), endings(e), _said(own))
        half = F.ceil(F.size(own) / 2).cast("int")
        return F.struct(e.alias("e"), canonical.alias("canonical"),
                        F.slice(own, F.lit(1), half).alias("x"), F.slice(own, half + 1, F.size(own)).alias("y"),
                        attempt(e["p"]["kind"], canonical).alias("n"),
                        F.concat_ws("|", F.lit(key), e["p"]["kind"],
                                    attempt(e["p"]["kind"], canonical).cast("string"), said_head(e["p"]),
                                    F.when(e["p"]["kind"] != "card", F.lower(e["p"]["tail"])).otherwise(F.lit(""))).alias("tag"))

    def turn(n: int):
        """Round n moves the second half by the first, or the other way round."""
        def step(o: Column) -> Column:
            tag = F.concat_ws("|", o["tag"], F.lit(n).cast("string"))
            x, y = (o["x"], _round(o["y"], o["x"], tag)) if n % 2 == 0 else (_round(o["x"], o["y"], tag), o["y"])
            return F.struct(o["e"].alias("e"), o["canonical"].alias("canonical"), x.alias("x"), y.alias("y"), o["n"].alias("n"), o["tag"].alias("tag"))
        return step

    def feistel(h: Column) -> Column:
        for n in range(4):
            h = _let(h, turn(n))
        return h

    def written(f: Column) -> Column:
        def text(new: Column) -> Column:
            e = f["e"]
            p = e["p"]

            def char(x: Column, k: Column) -> Column:
                at = F.size(F.filter(F.slice(e["all"], F.lit(1), k + 1), lambda y: y["r"] > 1))
                z = F.get(new, at - 1)
                c = F.substr(z["a"], z["i"] + 1, F.lit(1))
                old = F.substr(e["core"], k + 1, F.lit(1))
                return F.when(x["r"] == 1, x["a"]).when(old != F.lower(old), F.upper(c)).otherwise(c)

            digits = lambda a: F.transform(F.filter(a, lambda y: y["r"] == 10), lambda y: y["i"])
            check = (_luhn(digits(new)) + p["tail"].cast("int") - _luhn(digits(e["all"])) + 10) % 10
            core = F.when(p["kind"] == "ip", F.concat_ws(".", F.transform(new, lambda y: y["i"].cast("string")))) \
                .otherwise(F.concat_ws("", F.transform(e["all"], char)))
            tail = F.when(p["kind"] == "card", check.cast("string")).otherwise(p["tail"])
            digest = F.translate(F.sha2(F.concat_ws("|", F.lit(key), F.lit("token"), p["kind"], f["canonical"]), 256), "0123456789abcdef", TOKEN)
            token = (F.when(p["kind"] == "email", F.concat(F.substring(digest, 1, 16), F.lit("@"), F.substring(digest, 17, 8)))
                     .otherwise(F.concat(F.upper(F.substring(digest, 1, 1)), F.substring(digest, 2, 23))))
            core = F.when(f["n"] < 0, token).otherwise(core)
            return F.struct(p["kind"].alias("kind"), f["canonical"].alias("canonical"),
                            F.concat(p["head"], core, tail).alias("s"),
                            F.concat_ws("|", said_head(p), F.lower(tail), endings(e), _said(new)).alias("s_canonical"))
        return _let(F.concat(f["x"], f["y"]), text)

    return _let(_let(_let(_let(_let(kind_of(m), parts), elements), halves), feistel), written)


def entities(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def attempts(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame | None:
    """(kind, canonical, attempt) of the entities that may not have their first surrogate; None if all may."""
    found = checkpointed(docs.select(F.explode(entities(docs[text_col])).alias("m"))
                         .select(surrogate(F.col("m"), key, lambda k, c: F.lit(0)).alias("x"), "m")
                         .groupBy("x.kind", "x.canonical").agg(F.min("m").alias("m"), F.min("x.s_canonical").alias("s")))
    state = found.withColumn("attempt", F.lit(0))
    for n in range(1, ATTEMPTS + 1):
        first = state.groupBy("kind", "s").agg(F.min("canonical").alias("first"), F.count(F.lit(1)).alias("n"))
        shared = first.where("n > 1").select("kind", "s", "first")
        bad = (state.join(shared, ["kind", "s"], "left")
               .where((F.col("first") != F.col("canonical")) | (F.col("s") == F.col("canonical"))))
        bad = checkpointed(bad.select("kind", "canonical", "m"))
        if bad.isEmpty():
            return None if n == 1 else state.where("attempt > 0").select("kind", "canonical", "attempt")
        again = (bad.withColumn("x", surrogate(F.col("m"), key, lambda k, c, n=n: F.lit(n)))
                 .select("kind", "canonical", "m", F.col("x.s_canonical").alias("s"), F.lit(n).alias("attempt")))
        state = checkpointed(state.join(bad.select("kind", "canonical"), ["kind", "canonical"], "left_anti").unionByName(again))
    first = state.groupBy("kind", "s").agg(F.min("canonical").alias("first"))
    left = state.join(first, ["kind", "s"]).where((F.col("first") != F.col("canonical")) | (F.col("s") == F.col("canonical")))
    tokens = left.select("kind", "canonical", F.lit(-1).alias("attempt"))
    return checkpointed(state.join(tokens.select("kind", "canonical"), ["kind", "canonical"], "left_anti").where("attempt > 0")
                        .select("kind", "canonical", "attempt").unionByName(tokens))


def replace(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with surrogates in the text, and ``n_replaced``."""
    exceptions = attempts(docs, key, text_col)
    found, own, chosen = fresh(docs, "__found", "__id", "__map")
    again = F.lit(0)
    choose = lambda k, c: again
    columns = [docs[c] for c in docs.columns if c != "n_replaced"]
    if exceptions is None:
        rows = docs.select(*columns, entities(docs[text_col]).alias(found))
    else:
        mine = (docs.select(docs[id_col].alias(own), F.explode(entities(docs[text_col])).alias("m"))
                .select(own, surrogate(F.col("m"), key, lambda k, c: F.lit(0)).alias("x")).select(own, "x.kind", "x.canonical").distinct()
                .join(exceptions, ["kind", "canonical"])
                .groupBy(own).agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "canonical"), "attempt"))).alias(chosen)))
        rows = (docs.join(mine, docs[id_col].eqNullSafe(F.col(own)), "left")
                .select(*columns, chosen, entities(docs[text_col]).alias(found)))
        choose = lambda k, c: F.coalesce(F.element_at(F.col(chosen), F.concat_ws("|", k, c)), F.lit(0))
    text = F.col(text_col)
    new = F.transform(found, lambda m: surrogate(m, key, choose)["s"])
    filled = F.array_join(F.zip_with(F.split(text, ENTITY), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.when(F.size(found) > 0, filled).otherwise(text)
    names = [c for c in docs.columns if c != "n_replaced"]
    return rows.select(*[changed.alias(c) if c == text_col else F.col(c) for c in names],
                       F.when(text.isNull(), F.lit(0)).otherwise(F.size(found)).alias("n_replaced"))
