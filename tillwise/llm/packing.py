"""Vector bin packing of training sequences.

A sequence has limits on several measures at once: tokens, segments (pieces of
examples) and tokens that bear loss. An open sequence takes, of the waiting pieces
that fit under every limit, the one whose demand has the largest dot product with
what the sequence still has left (both as fractions of the limits). So a piece that
uses much of what is plentiful goes first.

Each task packs its own rows as they stream by: no shuffle. A sequence is closed once
``waiting`` pieces wait and together reach one of its limits, so there are never more than
``waiting`` pieces or what one sequence can hold. Where cutting is allowed, a gap
that no waiting piece fits is filled with the head of one, and the last tokens of a
task are laid into sequences whose lengths are powers of two, which need no padding.

Defined results: a null text is empty, an empty text is its end mark alone; null ids
and repeated rows are packed like any row; a text longer than a sequence is cut into as many as it
needs, and is held whole while it is; an empty table gives no piece; the input's
further columns are not read. An example that exceeds a limit by itself is an error
where cutting is not allowed. Sequence ids are unique, not dense.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillwise.llm.common import slices, texts

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long")
CACHED_WORDS = 500_000
CACHED_LENGTH = 32


class Packer:
    """Places pieces (key, start, tokens, loss tokens) in sequences under ``limits``.

    Where an example is cut, its loss-bearing tokens are taken to be its first ones.
    """

    def __init__(self, limits: tuple[int, int, int], cut: bool, waiting: int = 256):
        self.limits, self.cut = np.array(limits, dtype="f8"), cut
        self.room = waiting
        self.demand = np.zeros((3, waiting))
        self.keys: list = [None] * waiting
        self.used = 0
        self.held = np.zeros(3)
        self.sequence = 0
        self.out: list[tuple] = []

    def add(self, key, start: int, tokens: int, loss: int, segments: int = 1) -> None:
        size = int(self.limits[0])
        if self.cut:
            size = min(size, int(self.limits[2])) if loss else size
            while tokens >= size == int(self.limits[0]):
                bears = min(loss, size)
                self.out.append((key, start, size, self.sequence, 0, bears))
                self.sequence += 1
                start, tokens, loss = start + size, tokens - size, loss - bears
            while tokens > size:
                self._wait(key, start, size, min(loss, size), segments)
                start, tokens, loss = start + size, tokens - size, max(0, loss - size)
        elif tokens > size or segments > self.limits[1] or loss > self.limits[2]:
            raise ValueError(f"example {key!r} exceeds a limit: {tokens} tokens, {segments} segments, {loss} bear loss")
        if tokens:
            self._wait(key, start, tokens, loss, segments)

    def _wait(self, key, start: int, tokens: int, loss: int, segments: int) -> None:
        while self.used >= self.room and (self.held >= self.limits).any():
            self._fill()
        if self.used == len(self.keys):  # what waits cannot fill a sequence yet
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)], axis=1)
            self.keys += [None] * len(self.keys)
        self.demand[:, self.used] = tokens, segments, loss
        self.held += tokens, segments, loss
        self.keys[self.used] = (key, start)
        self.used += 1

    def _take(self, i: int, offset: int, tokens: int) -> None:
        key, start = self.keys[i]
        whole, bears = tokens == self.demand[0, i], int(self.demand[2, i])
        loss = bears if whole else min(tokens, bears)
        self.held -= tokens, self.demand[1, i] if whole else 0, loss
        self.out.append((key, start, tokens, self.sequence, offset, loss))
        if whole:
            self.used -= 1
            self.demand[:, i], self.keys[i] = self.demand[:, self.used], self.keys[self.used]
        else:
            self.demand[0, i] -= tokens
            self.demand[2, i] -= loss
            self.keys[i] = (key, start + tokens)

    def _fill(self) -> None:
        """Close one sequence from the waiting list."""
        left, offset, scale = self.limits.copy(), 0, 1 / self.limits ** 2
        while self.used:
            d = self.demand[:, :self.used]
            score = (left * scale) @ d
            score[(d > left[:, None]).any(axis=0)] = -1.0
            i = int(score.argmax())
            if score[i] < 0:
                if self.cut and left[0] and left[1] >= 1:
                    i = int(d[0].argmax())
                    gap = int(min(left[0], d[0, i], left[2] if d[2, i] else left[0]))
                    if gap:
                        self._take(i, offset, gap)
                break
            taken = d[:, i].copy()
            self._take(i, offset, int(taken[0]))
            left -= taken
            offset += int(taken[0])
            if not left[0]:
                break
        self.sequence += 1

    def finish(self) -> None:
        while self.used:
            rest = int(self.demand[0, :self.used].sum())
            if self.cut and rest < self.limits[0]:
                size = 1 << (rest.bit_length() - 1)
                limits, self.limits = self.limits, self.limits.copy()
                self.limits[0] = size
                self._fill()
                self.limits = limits
            else:
                self._fill()


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


#: Texts of these characters are cut by ``PIECE`` just as the vocabulary's own rules cut them.
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")
#: The characters that stand for the 256 bytes in a byte-level vocabulary: printable
#: Latin-1 stands for itself, the other bytes in their order for U+0100 and up.
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255)]
BYTE_CHARS = {b: 256 + i for i, b in enumerate(_OTHERS)}


#: A vocabulary is taken word by word only if it gives these texts the same ids both ways.
PROBES = ["It's 12.5% of don't\tx\r\ny  z", "Été Straße ÄÖÜ ''s''", "a,b--c 1234 ***the&&& x_y", "THE  quick\n\nBrown fox!?"]


class WordIds(dict):
    """Ids of a word as little-endian unsigned 32-bit integers, in a bounded cache.

    The vocabulary lower-cases, cuts a text into words and merges within each, so words
    are independent and caching them is exact. Texts of other characters, or with what
    may be a special token, go through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        tokenizer = _tokenizer(path)
        self.encode, self.merge = tokenizer.encode, tokenizer.model.tokenize
        ids = lambda t: np.array(self.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        try:
            self.by_word = all(self._words(t) == ids(t) for t in PROBES)
        except Exception:  # a model that does not merge characters
            self.by_word = False

    def __missing__(self, word: str) -> bytes:
        chars = word if word.isascii() else word.encode().decode("latin-1").translate(BYTE_CHARS)
        ids = b"".join([t.id.to_bytes(4, "little") for t in self.merge(chars)])
        if len(self) < CACHED_WORDS and len(word) <= CACHED_LENGTH:
            self[word] = ids
        return ids

    def _words(self, text: str) -> bytes:
        return b"".join([self[w] for w in PIECE.findall(text.lower())])

    def text(self, text: str) -> bytes:
        if self.by_word and PLAIN.fullmatch(text) and "<|" not in text:
            return self._words(text)
        return np.array(self.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, tokens: int = 4096, segments: int = 4096,
                   loss_tokens: int | None = None, waiting: int = 256, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Tokenize texts and pack their ids, each closed by ``end_id``; every token bears loss.

    ``tokenizer``: a file of the tokenizers library; one whose own rules for words are not those
    that ``WordIds`` knows encodes each text as a whole.

    One row per piece: see ``PIECES``. ``ids_crc32`` is that of the piece's ids as
    little-endian unsigned 32-bit integers.
    """
    limits = (tokens, segments, loss_tokens or tokens)
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [x.split()[0] for x in PIECES.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, sizes, buffers = word_ids(tokenizer), Packer(limits, True, waiting), {}, {}
        base, serial = TaskContext.get().partitionId() << 33, 0

        def placed() -> pa.RecordBatch:
            rows = []
            for (k, doc), start, length, sequence, offset, loss in packer.out:
                ids = buffers[k]
                rows.append((doc, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), sizes[k],
                             base + sequence, offset, loss))
            packer.out.clear()
            still = {packer.keys[i][0][0] for i in range(packer.used)}
            for k in [k for k in buffers if k not in still]:
                del buffers[k], sizes[k]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * len(names))], names=names)

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = words.text(text.as_py() or "") + end
                n = len(ids) // 4
                buffers[serial], sizes[serial] = memoryview(ids), n
                packer.add((serial, doc), 0, n, n)
                serial += 1
            yield placed()
        packer.finish()
        yield placed()

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return texts(narrow).mapInArrow(pack, PIECES)


PLACES = "example_id long, tokens long, segments long, loss_tokens long, sequence_id long, offset long"


def pack_examples(examples: DataFrame, tokens: int, segments: int, loss_tokens: int, waiting: int = 256) -> DataFrame:
    """Place whole examples (example_id, tokens, segments, loss_tokens) in sequences; none is cut.

    Null measures count as zero; an example without tokens is not placed.
    """
    names = [x.split()[0] for x in PLACES.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer((tokens, segments, loss_tokens), False, waiting)
        base, size = TaskContext.get().partitionId() << 33, {}

        def placed() -> pa.RecordBatch:
            rows = [(k[1], n, size.pop(k)[0], loss, base + q, o) for k, _, n, q, o, loss in packer.out]
            packer.out.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * len(names))], names=names)

        serial = 0
        for batch in batches:
            for r in batch.to_pylist():
                key = (serial, r["example_id"])
                size[key] = (r["segments"] or 0,)
                if r["tokens"]:
                    packer.add(key, 0, r["tokens"], r["loss_tokens"] or 0, r["segments"] or 0)
                serial += 1
            yield placed()
        packer.finish()
        yield placed()

    return examples.select("example_id", "tokens", "segments", "loss_tokens").mapInArrow(pack, PLACES)
