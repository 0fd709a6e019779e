"""Collocations by partitioned mining (SON): local supports, union, exact global counts.

Texts fall into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words ``[^\\x20\\x09]+``, A-Z
lower-cased. A phrase is 2 to ``longest`` words in a row within a piece; all counts are per
language (null: ``und``).

1. Words. The counts of their hashes give a filter of the words that can reach the support.
2. Shards. What a task reads, some ``SHARD_BYTES`` at a time, is a shard. It is mined
   completely, length by length, at the support ceil(support * its share of all bytes), as a
   phrase that reaches the support must reach that in some shard.
   The shards' results are united by sum, which leaves out no more than t - 1 occurrences for
   each shard: phrases that cannot reach the support even so go.
3. Counts. The united phrases, as a filter of fixed size, go to all tasks, which count every
   phrase that passes by its text. A filter may pass too much, never too little, and the
   sums decide: the counts are exact.
4. Scores, containment and ranks are joins and aggregations over the frequent phrases.

What is broadcast are two filters of 2 ** ``FILTER_BITS`` bits (4 MB), whatever the input. Texts
are never shuffled; shards send sorted, packed hashes (some 4 bytes each) and, of phrases that
pass, the text, dealt over as many ranges of hashes as there are shards, so that one range is
bounded. With more than ``support`` shards the local support is 1, and the shards then send
the hashes of all phrases of frequent words, which is still linear in the input.

Defined results: null and empty texts have no words; a word may be of any length; ids are not
read, so null ids count and repeated rows count again; an empty table gives no row; columns
other than the text and the language are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.cells import runs
from tillwise.functions.topk import top_k_per_group
from tillwise.llm.common import slices, stored, texts

SHARD_BYTES, FILTER_BITS = 24 << 20, 25
BREAKS, BLANKS = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09"
_KIND = np.zeros(256, dtype="u1")
_KIND[list(BLANKS)], _KIND[list(BREAKS)] = 1, 2
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of all words on end, their lengths, and the number of the piece of each."""
    text = text.cast(pa.large_string())
    at = np.frombuffer(text.buffers()[1], dtype="i8")[text.offset:text.offset + len(text) + 1]
    lo, hi = int(at[0]), int(at[-1])
    raw = text.buffers()[2].slice(lo, hi - lo).to_pybytes().translate(_LOWER) if hi > lo else b""
    raw = np.frombuffer(raw, dtype="u1")
    kind = _KIND[raw]
    new = (kind == 2).astype("i4")
    np.add.at(new, at[:-1][at[:-1] < hi] - lo, 1)
    piece = np.cumsum(new, dtype="i4")
    inside = kind == 0
    before = np.zeros(inside.size, dtype=bool)
    before[1:] = inside[:-1]
    # a word also starts where a text does
    first = at[:-1][at[:-1] < hi] - lo
    before[first] = False
    starts = np.flatnonzero(inside & ~before)
    place = np.cumsum(inside, dtype="i8")
    begin = place[starts] - 1
    total = int(place[-1]) if place.size else 0
    return raw[inside].tobytes(), np.diff(np.append(begin, total)), piece[starts]


class Words:
    """Words of a shard in one language, as numbers, with the piece of each."""

    def __init__(self, lang: str):
        self.lang = lang
        self.data: list[bytes] = []
        self.lengths: list[np.ndarray] = []
        self.pieces: list[np.ndarray] = []
        self.last = 0

    def add(self, text: pa.Array) -> int:
        """Its bytes."""
        data, lengths, pieces = words_of(text)
        if lengths.size:
            self.data.append(data)
            self.lengths.append(lengths.astype("i4"))
            self.pieces.append(pieces + self.last)
            self.last = int(self.pieces[-1][-1]) + 1
        return pc.sum(pc.binary_length(text)).as_py() or 0

    def close(self) -> Words:
        """``words`` (distinct), ``codes`` and ``piece`` of each word, ``hashes`` of the distinct ones."""
        lengths = np.concatenate(self.lengths) if self.lengths else np.zeros(0, dtype="i4")
        ends = np.zeros(lengths.size + 1, dtype="i8")
        np.cumsum(lengths, out=ends[1:])
        every = pa.Array.from_buffers(pa.large_binary(), lengths.size, [None, pa.py_buffer(ends), pa.py_buffer(b"".join(self.data))])
        self.data = []
        coded = every.dictionary_encode()
        self.words = coded.dictionary
        self.codes = np.asarray(coded.indices)
        self.piece = np.concatenate(self.pieces) if self.pieces else np.zeros(0, dtype="i4")
        seed = xxhash.xxh64_intdigest(self.lang)
        self.hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words.to_pylist()], dtype="u8")
        return self


def shards(batches: Iterator[pa.RecordBatch], size: int = SHARD_BYTES) -> Iterator[tuple[int, list[Words]]]:
    """(bytes, words by language) of each shard of what the task reads (columns ``lang`` and ``text``)."""
    open_: dict[str, Words] = {}
    held = 0
    for batch in batches:
        for part in slices([batch], "text", size // 4):
            text = pc.fill_null(part.column("text"), "")
            for lang in pc.unique(part.column("lang")).to_pylist():
                held += open_.setdefault(lang, Words(lang)).add(text.filter(pc.equal(part.column("lang"), lang)))
            if held >= size:
                yield held, list(open_.values())
                open_, held = {}, 0
    if open_:
        yield held, list(open_.values())


def longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all its words but the last, and that of the last."""
    x = h * np.uint64(0x9E3779B97F4A7C15) + word
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


Keep = Callable[[int, np.ndarray, np.ndarray], np.ndarray]


def phrases(shard: Words, longest: int, keep: Keep) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(words, first place, count, hash) of the shard's phrases that ``keep(words, counts, hashes)`` keeps.

    A phrase is looked at only if it without its last and without its first word is kept."""
    codes, piece = shard.codes, shard.piece
    width = np.int64(max(len(shard.words), 1))
    count = np.bincount(codes, minlength=len(shard.words))
    ok = keep(1, count, shard.hashes)
    first = np.zeros(len(shard.words), dtype="i8")
    first[codes[::-1]] = np.arange(codes.size)[::-1]
    yield 1, first[ok], count[ok], shard.hashes[ok]
    at = np.flatnonzero(ok[codes])
    mine, h = codes[at].astype("i8"), shard.hashes
    for k in range(2, longest + 1):
        # ``at``: places of kept phrases of k - 1 words; ``mine``: their numbers; ``h``: hash by number
        there = np.zeros(codes.size + 1, dtype=bool)
        there[at] = True
        end = at + (k - 1)
        inside = end < codes.size
        at, mine, end = at[inside], mine[inside], end[inside]
        fits = there[at + 1] & (piece[at] == piece[end])
        at, mine, end = at[fits], mine[fits], end[fits]
        if not at.size:
            return
        number, distinct = pd.factorize(mine * width + codes[end])
        count = np.bincount(number)
        h = longer(h[distinct // width], shard.hashes[distinct % width])
        ok = keep(k, count, h)
        first = np.zeros(distinct.size, dtype="i8")
        first[number[::-1]] = at[::-1]
        yield k, first[ok], count[ok], h[ok]
        renumbered = np.cumsum(ok) - 1
        kept = ok[number]
        at, mine, h = at[kept], renumbered[number[kept]], h[ok]


class Filter:
    """A set of hashes in 2 ** ``FILTER_BITS`` bits, two of them for each: never misses one, may pass others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def of(marks: DataFrame) -> Filter:
        """From column ``mark``, by a grouped OR over 64-bit parts; at most 2 ** (FILTER_BITS - 6) of these come to the driver."""
        mask = F.lit((1 << FILTER_BITS) - 1).cast("long")
        probes = F.array(F.col("mark").bitwiseAND(mask), F.shiftrightunsigned("mark", FILTER_BITS).bitwiseAND(mask))
        parts = (marks.select(F.explode(probes).alias("p"))
                 .groupBy(F.shiftright("p", 6).alias("part"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("bits"))).toArrow()
        bits = np.zeros(1 << (FILTER_BITS - 6), dtype="i8")
        bits[np.asarray(parts.column("part").combine_chunks())] = np.asarray(parts.column("bits").combine_chunks())
        return Filter(bits.view("u8"))

    @staticmethod
    def mark(top: np.ndarray) -> np.ndarray:
        """What stands in the filter for the highest 40 bits of a hash."""
        return longer(top, np.uint64(1))

    def __call__(self, h: np.ndarray) -> np.ndarray:
        mask, six, m = np.uint64((1 << FILTER_BITS) - 1), np.uint64(63), self.mark(h >> np.uint64(24))
        out = np.ones(h.size, dtype=bool)
        for p in (m & mask, (m >> np.uint64(FILTER_BITS)) & mask):
            out &= (self.bits[(p >> np.uint64(6)).astype("i8")] >> (p & six) & np.uint64(1)).astype(bool)
        return out


def edges(buckets: int) -> np.ndarray:
    """Where each of the equal ranges of hashes but the first begins."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], dtype="u8")


def packed(h: np.ndarray, count: np.ndarray, untold: int, buckets: int) -> pa.RecordBatch:
    """A row for each range of hashes: the highest 40 bits of each hash and its count, sorted, byte by byte so that they compress."""
    order = np.argsort(h)
    h, count = h[order], count[order].astype(">u4").view("u1").reshape(-1, 4)
    top = (h >> np.uint64(24)).astype(">u8").view("u1").reshape(-1, 8)[:, 3:]
    cut = [0, *np.searchsorted(h, edges(buckets)).tolist(), h.size]
    parts = [top[lo:hi].T.tobytes() + count[lo:hi].T.tobytes() for lo, hi in zip(cut, cut[1:])]
    return pa.RecordBatch.from_arrays([pa.array(range(buckets), pa.int32()), pa.array([untold] * buckets, pa.int64()), pa.array(parts, pa.binary())],
                                      names=["bucket", "untold", "hashes"])


PACKED = "bucket int, untold long, hashes binary"


def reaching(sent: DataFrame, support: int, buckets: int) -> DataFrame:
    """``mark`` of the hashes whose counts, with what no shard told of, can reach the support."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in runs(batches, ["bucket"]):
            untold = table.column("untold").to_numpy()
            hashes = table.column("hashes").to_pylist()
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                parts = [np.frombuffer(x, dtype="u1").reshape(9, -1) for x in hashes[lo:hi] if x]
                if not parts:
                    continue
                whole = np.concatenate(parts, axis=1).T
                wide = np.zeros((len(whole), 8), dtype="u1")
                wide[:, 3:] = whole[:, :5]
                top = wide.view(">u8").ravel().astype("u8")
                count = np.ascontiguousarray(whole[:, 5:]).view(">u4").ravel().astype("i8")
                order = np.argsort(top)
                top, count = top[order], count[order]
                first = np.flatnonzero(np.append(True, top[1:] != top[:-1]))
                there = np.add.reduceat(count, first) + int(untold[lo:hi].sum()) >= support
                yield pa.RecordBatch.from_arrays([pa.array(Filter.mark(top[first[there]]).view("i8"))], names=["mark"])
    return (sent.repartition(buckets, "bucket").sortWithinPartitions("bucket")).mapInArrow(run, "mark long")


def frequent_words(rows: DataFrame, support: int, buckets: int, shard: int = SHARD_BYTES) -> Filter:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in shards(batches, shard):
            closed = [s.close() for s in parts]
            h = np.concatenate([s.hashes for s in closed])
            n = np.concatenate([np.bincount(s.codes, minlength=len(s.words)) for s in closed])
            yield packed(h, np.minimum(n, support), 0, buckets)
    return Filter.of(reaching(rows.mapInArrow(run, PACKED), support, buckets))


def candidates(rows: DataFrame, total: int, support: int, longest: int, words: Callable, buckets: int,
               shard: int = SHARD_BYTES) -> Filter:
    """Phrases that reach the support t of a shard, with count - (t - 1); each shard leaves out t - 1 of any other at most."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for size, parts in shards(batches, shard):
            least = max(1, -(-support * size // max(1, total)))

            def keep(k: int, count: np.ndarray, h: np.ndarray, least=least) -> np.ndarray:
                return (count >= least) & words(h) if k == 1 else count >= least

            found = [(h, count) for s in parts for k, _, count, h in phrases(s.close(), longest, keep) if k > 1]
            h = np.concatenate([np.zeros(0, dtype="u8"), *(x for x, _ in found)])
            count = np.concatenate([np.zeros(0, dtype="i8"), *(x for _, x in found)])
            yield packed(h, np.minimum(count - (least - 1), support), least - 1, buckets)
    return Filter.of(reaching(rows.mapInArrow(run, PACKED), support, buckets))


def exact_counts(rows: DataFrame, support: int, longest: int, words: Callable, found: Callable, buckets: int,
                 shard: int = SHARD_BYTES) -> DataFrame:
    """(lang, k, phrase, f) of all words and phrases that reach the support; of the empty phrase, k = 0, f is the number of all words."""
    names = ["bucket", "lang", "phrase", "f"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, parts in shards(batches, shard):
            for s in parts:
                s.close()
                text, f, hashes = [pa.array([b""], pa.large_binary())], [np.array([s.codes.size])], [np.zeros(1, dtype="u8")]
                for k, first, count, h in phrases(s, longest, lambda k, n, h: words(h) if k == 1 else found(h)):
                    at = [s.words.take(pa.array(s.codes[first + j])) for j in range(k)]
                    text.append(at[0] if k == 1 else pc.binary_join_element_wise(*at, pa.scalar(b" ", pa.large_binary())))
                    f.append(count)
                    hashes.append(h)
                # sorted by text within a range, as texts then compress well
                text = pa.concat_arrays(text)
                order = np.asarray(pc.sort_indices(text))
                of = np.searchsorted(edges(buckets), np.concatenate(hashes)[order], side="right")
                order, of = order[np.argsort(of, kind="stable")], np.sort(of, kind="stable")
                text, f = text.take(pa.array(order)).cast(pa.large_string()), np.concatenate(f)[order].astype("i8")
                cut = np.searchsorted(of, np.arange(buckets + 1)).tolist()
                for b, (lo, hi) in enumerate(zip(cut, cut[1:])):
                    if lo < hi:
                        ends = pa.array([0, hi - lo], pa.int32())
                        yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([s.lang]),
                                                          pa.ListArray.from_arrays(ends, text.slice(lo, hi - lo).cast(pa.string())),
                                                          pa.ListArray.from_arrays(ends, pa.array(f[lo:hi]))], names=names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in runs(batches, ["bucket"]):
            for lo, hi in zip(cut[:-1].tolist(), cut[1:].tolist()):
                part = table.slice(lo, hi - lo).combine_chunks()
                owner = pc.list_parent_indices(part.column("phrase").combine_chunks())
                whole = pa.table({"lang": part.column("lang").take(owner), "phrase": pc.list_flatten(part.column("phrase")), "f": pc.list_flatten(part.column("f"))})
                sums = whole.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
                sums = sums.filter(pc.or_(pc.greater_equal(sums.column("f_sum"), support), pc.equal(sums.column("phrase"), "")))
                yield from sums.select(["lang", "phrase", "f_sum"]).rename_columns(["lang", "phrase", "f"]).to_batches()

    sent = rows.mapInArrow(run, "bucket int, lang string, phrase array<string>, f array<long>")
    return (sent.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(add, "lang string, phrase string, f long")
            .select("lang", F.when(F.col("phrase") == "", 0).otherwise(F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit(""))) + 1).alias("k"), "phrase", "f"))


def _big(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def scored(frequent: DataFrame, totals: DataFrame, share: int) -> DataFrame:
    """Phrases that no longer phrase contains nearly as often, with the lowest-scoring cut of each."""
    every = frequent.where("k > 1").withColumn("w", F.split("phrase", " ", -1))
    inner = (every.where("k > 2").select("lang", "f", F.explode(F.array(
        F.concat_ws(" ", F.expr("slice(w, 1, k - 1)")), F.concat_ws(" ", F.expr("slice(w, 2, k - 1)")))).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("around")))
    # a containing phrase of two more words is no more frequent than one of one more word that also contains it
    own = (every.join(inner, ["lang", "phrase"], "left")
           .where(F.col("around").isNull() | (100 * F.col("around") < share * F.col("f"))))
    cuts = (own.select("lang", "phrase", F.col("f").alias("a"), "w", "k", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
            .select("lang", "phrase", "a", "cut", F.concat_ws(" ", F.expr("slice(w, 1, cut)")).alias("left"),
                    F.concat_ws(" ", F.expr("slice(w, cut + 1, k - cut)")).alias("right")))
    part = frequent.select("lang", "phrase", "f")
    both = (cuts.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .join(totals, "lang")
            .withColumns({"x": (_big("a") * _big("n")).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)"),
                          "y": (_big("l") * _big("r")).cast("decimal(38,0)")})
            .withColumn("score", F.expr("cast(x div y as long)")))
    return (both.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "a", "l", "r", "n")).alias("b"))
            .select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score"))


def collocations(docs: DataFrame, support: int = 100, longest: int = 5, top: int = 2000, share: int = 100,
                 text_col: str = "text", lang_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language.

    A phrase goes if a longer one that reaches the support contains it and has ``share`` percent
    or more of its occurrences."""
    rows = texts(docs.select(docs[text_col].cast("string").alias("text"), F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang")))
    sc = docs.sparkSession.sparkContext
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(1, -(-total // shard_bytes))
    words = sc.broadcast(frequent_words(rows, support, buckets, shard_bytes))
    found = sc.broadcast(candidates(rows, total, support, longest, lambda h: words.value(h), buckets, shard_bytes))
    counted = stored(exact_counts(rows, support, longest, lambda h: words.value(h), lambda h: found.value(h), buckets, shard_bytes))
    best = scored(counted.where("k > 0"), counted.where("k = 0").select("lang", F.col("f").alias("n")), share)
    ranked = top_k_per_group(best, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
