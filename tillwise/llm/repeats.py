"""Substring dedup with automata of repeated phrases.

A passage repeats if a window of ``window`` consecutive words starts at two places or
more, in one document or several. Every word that such a window covers goes.

1. Anchors. Each window is filed under its least hashed run of ``gram`` words. Equal
   windows have equal anchors, and neighbouring windows mostly share one, so a document
   has an anchor for about every 14 words. A *piece* is the stretch of words of
   neighbouring windows that share an anchor (``2 * window - gram`` = 62 words at most).
   Only pieces of anchors that occur at two places can hold a repeated window.
2. Confirmed passages. Equal pieces are one distinct piece with its number of copies; one
   with copies is a repeated passage as a whole. Where an anchor has several distinct
   pieces, the windows within these are counted by hash. Both are partial sums, so a
   passage in a third of all documents costs one row per task.
3. Automata. Distinct pieces and the hashes of windows found twice are dealt over shards
   by anchor (an anchor with very many distinct pieces over several, each with the hashes of its pieces).
   A shard compiles Aho-Corasick automata of its passages, a bounded number at a time, as
   sequences of words, and streams its pieces through them. Matches are in words, not
   hashes; what a piece covers is a 62-bit mask.
4. The masks go back to all places of each piece, and each document drops its words.

Texts are shuffled once, into a table bucketed by document in the shared folder, which
both later joins read in place. Nothing is gathered beyond one document's own places.

Defined results: a null text has no words; texts shorter than a window lose nothing; documents
are told apart by 128 bits of their id and text, and rows equal in both count as two places;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.cells import runs
from tillwise.llm.common import shared_dir, slices, stored, texts

GRAM, PIECES_PER_SHARD, PASSAGES_AT_ONCE, SLICE = 8, 1024, 2000, 4 << 20
#: Bytes of pieces (and, by 64 each, hashes) that a task gathers before it compiles automata for them.
GATHERED = 1 << 20
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_INVERSE = pow(_P, -1, 1 << 64)


class Hashed:
    """Word hashes of a list of words, and from them the hash of any stretch."""

    def __init__(self, words: list[bytes]):
        digest = xxhash.xxh64_digest
        h = np.frombuffer(b"".join([digest(w) for w in words]), dtype=">u8").astype("u8")
        n = h.size + 1
        up, self.down = np.ones(n, dtype="u8"), np.ones(n, dtype="u8")
        up[1:], self.down[1:] = _P, _INVERSE
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(self.down, out=self.down)
        self.sums = np.zeros(n, dtype="u8")
        np.cumsum(h * up[:-1], out=self.sums[1:])

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype("u8")
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


def pieces_of(docs: list[list[bytes]], window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document's index, anchor hash, piece hash, first window, whether the anchor is at several places, number of windows) of each piece."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    if not (sizes >= window).any():
        return tuple(np.zeros(0, dtype=t) for t in ("i8", "u8", "u8", "i8", "?", "i8"))
    hashed = Hashed([w for d in docs for w in d])
    ends = np.cumsum(sizes)
    total = int(ends[-1])
    at = np.arange(total - gram + 1)
    grams = hashed.stretch(at, at + gram)
    span = window - gram + 1
    chosen = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1) + np.arange(total - window + 1)
    doc = np.repeat(np.arange(len(docs)), sizes)[:chosen.size]
    first = np.flatnonzero(np.arange(chosen.size) + window <= ends[doc])
    anchor = grams[chosen[first]]
    new = np.ones(first.size, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[first[1:]] != doc[first[:-1]])
    # a run of windows over periodic text can be long: it is cut after every ``span`` windows
    runs_at = np.flatnonzero(new)
    new |= (np.arange(first.size) - np.repeat(runs_at, np.diff(np.append(runs_at, first.size)))) % span == 0
    heads = np.flatnonzero(new)
    windows = np.diff(np.append(heads, first.size))
    start, last = first[heads], first[heads + windows - 1]
    several = chosen[start] != chosen[last]  # the anchor at more than one place of the piece
    return (doc[start], anchor[heads], hashed.stretch(start, start + windows + window - 1),
            start - (ends - sizes)[doc[start]], several, windows)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view("i8"))


def places(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, piece, k, th, at) of every piece; ``at`` holds the first window, a bit for ``several``, and in its last 6 bits the number of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE):
            docs = [t.as_buffer().to_pybytes().split() if t.is_valid else [] for t in batch.column("text")]
            doc, anchor, piece, first, several, number = pieces_of(docs, window, gram)
            rows = pa.array(doc)
            yield pa.RecordBatch.from_arrays([_signed(anchor), _signed(piece), batch.column("k").take(rows), batch.column("th").take(rows),
                                              pa.array(first << 7 | several.astype("i8") << 6 | number)], names=["anchor", "piece", "k", "th", "at"])

    return texts(rows.select("k", "th", "text")).mapInArrow(run, "anchor long, piece long, k long, th long, at long")


def _kept(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without repeats are done; the others' stay for later."""
    for batch in slices(batches, "text", SLICE):
        number, digest = [], []
        for t, later in zip(batch.column("text"), batch.column("later").to_pylist()):
            words = t.as_buffer().to_pybytes().split() if t.is_valid and not later else []
            number.append(None if later else len(words))
            digest.append(None if later else _kept(words))
        text = pa.array([t if later else None for t, later in zip(batch.column("text").to_pylist(), batch.column("later").to_pylist())], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("k"), batch.column("th"), text, pa.array(number, pa.int64()),
                                          pa.array(digest, pa.string())], names=["doc_id", "k", "th", "text", "n_words", "kept_sha256"])


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The words of the pieces that are asked for."""
    for batch in slices(batches, "text", SLICE):
        out: list[list] = [[], [], [], [], [], []]
        for i, t in enumerate(batch.column("text")):
            words = t.as_buffer().to_pybytes().split()
            at = np.asarray(batch.column("at")[i].values)
            for a in at.tolist():
                first = a >> 7
                out[5].append(b" ".join(words[first:first + (a & 63) + window - 1]))
            for k, name in enumerate(("anchor", "piece", "copies", "shards", "whole")):
                out[k].append(batch.column(name)[i].values)
        if out[0]:
            yield pa.RecordBatch.from_arrays([*(pa.concat_arrays(x) for x in out[:5]), pa.array(out[5], pa.binary()).cast(pa.string())],
                                             names=["anchor", "piece", "copies", "shards", "whole", "words"])


def _windows(lists: list[list[bytes]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list's index, first word, hash) of each window of each list."""
    sizes = np.array([len(x) for x in lists])
    starts = np.cumsum(sizes) - sizes
    number = np.maximum(sizes - window + 1, 0)
    owner = np.repeat(np.arange(len(lists)), number)
    first = np.arange(owner.size) - np.repeat(np.cumsum(number) - number, number)
    at = starts[owner] + first
    return owner, first, Hashed([w for x in lists for w in x]).stretch(at, at + window)


def _counted(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            owner, _, h = _windows([w.as_buffer().to_pybytes().split(b" ") for w in batch.column("words")], window)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays([batch.column("anchor").take(rows), _signed(h), batch.column("shard").take(rows), batch.column("shards").take(rows)],
                                             names=["anchor", "hash", "shard", "shards"])


def _locate(pieces: list[tuple], confirmed: dict[int, set[int]], window: int) -> Iterator[tuple[int, int, int]]:
    """(anchor, piece, mask of words that repeated passages cover): automata over words as numbers.

    The passages: pieces with copies, and windows whose hash was found twice.
    """
    lists = [p[3].split(b" ") for p in pieces]
    numbers: dict[bytes, int] = {}
    coded = [tuple([numbers.setdefault(w, len(numbers)) for w in x]) for x in lists]
    passages = {x for p, x in zip(pieces, coded) if p[2] > 1}
    some = [i for i, p in enumerate(pieces) if p[0] in confirmed]
    if some:
        known = set()
        owner, first, h = _windows([lists[i] for i in some], window)
        for o, f, x in zip(owner.tolist(), first.tolist(), h.view("i8").tolist()):
            anchor = pieces[some[o]][0]
            if x in confirmed[anchor] and (anchor, x) not in known:
                known.add((anchor, x))
                passages.add(coded[some[o]][f:f + window])
        del known, owner, first, h
    del lists, numbers
    masks, todo = [0] * len(pieces), list(passages)
    for k in range(0, len(todo), PASSAGES_AT_ONCE):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for passage in todo[k:k + PASSAGES_AT_ONCE]:
            automaton.add_word(passage, len(passage))
        automaton.make_automaton()
        for i, x in enumerate(coded):
            for end, n in automaton.iter(x):
                masks[i] |= (1 << n) - 1 << end - n + 1
    return ((p[0], p[1], m) for p, m in zip(pieces, masks) if m)


def _shard(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Groups of (anchor, shard): hashes found twice (words null) and pieces, gathered up to a bounded size."""
    def flush() -> pa.RecordBatch:
        found = list(_locate(pieces, confirmed, window))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], names=["anchor", "piece", "mask"])

    pieces, confirmed, held = [], {}, 0
    for table, bounds in runs(batches, ["anchor", "shard"]):
        anchor, value, copies, words = (table.column(c).to_pylist() for c in ("anchor", "value", "copies", "words"))
        for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            for i in range(lo, hi):
                if words[i] is None:
                    confirmed.setdefault(anchor[i], set()).add(value[i])
                    held += 64
                else:
                    pieces.append((anchor[i], value[i], copies[i], words[i].encode()))
                    held += len(words[i])
            if held >= GATHERED:
                yield flush()
                pieces, confirmed, held = [], {}, 0
    yield flush()


def _dropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", SLICE):
        number, removed, digest = [], [], []
        for i, t in enumerate(batch.column("text")):
            if not t.is_valid:
                number.append(batch.column("n_words")[i].as_py())
                removed.append(0)
                digest.append(batch.column("kept_sha256")[i].as_py())
                continue
            words = t.as_buffer().to_pybytes().split()
            gone = np.zeros(len(words) + 64, dtype=bool)
            if batch.column("mask")[i].is_valid:
                first = np.asarray(batch.column("at")[i].values) >> 7
                bits = (np.asarray(batch.column("mask")[i].values)[:, None] >> np.arange(63)) & 1
                where = (first[:, None] + np.arange(63))[bits.astype(bool)]
                gone[where] = True
            gone = gone[:len(words)]
            number.append(len(words))
            removed.append(int(gone.sum()))
            digest.append(_kept([w for w, g in zip(words, gone.tolist()) if not g]))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(number, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest, pa.string())],
                                         names=["doc_id", "n_words", "n_removed", "kept_sha256"])


def _told_apart(doc_id: str, text: str) -> list[Column]:
    """k and th: 128 bits of a document's id and text, by which all steps know it."""
    return [F.xxhash64(F.lit(seed), F.col(doc_id).isNull(), doc_id, text).alias(name) for seed, name in ((1, "k"), (2, "th"))]


def drop_repeats(docs: DataFrame, window: int, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by blanks) for each row of ``docs``."""
    if not gram <= window or 2 * window - gram > 62:
        raise ValueError("a piece must have at most 62 words")
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    rows = rows.select("doc_id", "text", *_told_apart("doc_id", "text"))
    every = stored(places(rows, window, gram))
    several = F.col("at").bitwiseAND(F.lit(64).cast("long")) > 0
    twice = (every.groupBy("anchor").agg(F.sum(F.when(several, 2).otherwise(1)).alias("n")).where("n > 1").select("anchor"))
    again = stored(every.join(twice, "anchor"))

    distinct = again.groupBy("anchor", "piece").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("k", "th", "at")).alias("one"))
    variants = (distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
                .select("anchor", "n", F.ceil(F.col("n") / PIECES_PER_SHARD).alias("shards")))
    wanted = (distinct.join(variants, "anchor").withColumn("whole", (F.col("n") == 1) & (F.col("copies") > 1))
              .groupBy("one.k", "one.th").agg(F.collect_list(F.struct(F.col("one.at").alias("at"), "anchor", "piece", "copies", "shards", "whole")).alias("x"))
              .select("k", "th", "x.at", "x.anchor", "x.piece", "x.copies", "x.shards", "x.whole"))

    # all texts once, bucketed by document; those without any such piece leave only their result
    later = again.select("k", "th").distinct().withColumn("later", F.lit(True))
    name = f"llm_{uuid.uuid4().hex}"
    (rows.join(later, ["k", "th"], "left").select("doc_id", "k", "th", "text", F.coalesce("later", F.lit(False)).alias("later"))
     .mapInArrow(_whole, "doc_id long, k long, th long, text string, n_words long, kept_sha256 string")
     .write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "k", "th")
     .option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name))
    table = spark.table(name)

    pieces = stored(table.where("text is not null").select("k", "th", "text").join(wanted, ["k", "th"])
                    .select("text", "at", "anchor", "piece", "copies", "shards", "whole")
                    .mapInArrow(lambda x: _cut(x, window), "anchor long, piece long, copies long, shards long, whole boolean, words string"))
    shard = F.pmod(F.col("piece"), "shards").cast("int").alias("shard")
    windows = (pieces.where("not whole").select("anchor", shard, "shards", "words")
               .mapInArrow(lambda x: _counted(x, window), "anchor long, hash long, shard int, shards long")
               .groupBy("anchor", "hash", "shard").agg(F.count(F.lit(1)).alias("n"), F.max("shards").alias("shards")))
    confirmed = windows.where("shards = 1 and n > 1")
    if not pieces.where("shards > 1").isEmpty():
        # a hash goes only to those shards of a hot anchor that have it
        spread = stored(windows.where("shards > 1"))
        twice = spread.groupBy("anchor", "hash").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
        confirmed = confirmed.unionByName(spread.join(twice, ["anchor", "hash"], "left_semi"))
    shards = (pieces.select("anchor", shard, F.col("piece").alias("value"), "copies", "words")
              .unionByName(confirmed.select("anchor", "shard", F.col("hash").alias("value"), F.lit(0).cast("long").alias("copies"),
                                            F.lit(None).cast("string").alias("words"))))
    masks = (shards.repartition("anchor", "shard").sortWithinPartitions("anchor", "shard")
             .mapInArrow(lambda x: _shard(x, window), "anchor long, piece long, mask long"))
    gone = (again.join(masks, ["anchor", "piece"]).groupBy("k", "th").agg(F.collect_set(F.struct("at", "mask")).alias("x"))
            .select("k", "th", "x.at", "x.mask"))
    return (table.join(gone, ["k", "th"], "left").select("doc_id", "text", "n_words", "kept_sha256", "at", "mask")
            .mapInArrow(_dropped, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
