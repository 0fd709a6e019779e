"""Secret scan: fixed detectors, and automata inferred from what they label.

Detectors (the base) give labelled credentials of three kinds. For each kind a prefix
tree of a bounded sample of them is built, and states whose outgoing and ending
frequencies agree within a Hoeffding bound, all the way down, are merged (ALERGIA),
which leaves a probabilistic automaton of the format. A further automaton of the same
make describes ordinary long words. Every candidate in every text, however many there are,
is scored, also one that a base span touches or lies in (only what lies within a base
span adds nothing): it becomes a span of kind ``format`` when a
credential automaton gives it the per-character log-likelihood that all but a few of
its own credentials reach, less ``SLACK`` (one odd character in forty), and is at least ``MARGIN`` nats likelier than under
the automaton of ordinary words.

What the driver holds is bounded by ``SAMPLE`` strings for each of the four automata,
taken by least hash over all documents; strings over ``LONGEST`` characters are not
used for inference, but are scored.

Defined results: a null or empty text has no spans; texts of any length are scanned whole; a table without credentials has
base spans only (no automaton, none added); repeated rows repeat their result; null ids
stay null; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import checkpointed, slices, texts

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{12,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ALPHABET = 68  # characters that a candidate can hold
SAMPLE, LONGEST, ALPHA, LOW_SHARE, SLACK, MARGIN, CACHED = 1000, 128, 0.05, 0.01, 0.35, 8.0, 200_000


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, credential), ordered by start, then kind. ``{n,}`` of a single class takes maximal runs."""
    out = []
    if "=" in text or ":" in text:
        low = text.lower()
        if any(k in low for k in KEYWORDS):
            out += [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, spans: list[tuple]) -> Iterator[tuple[int, str, bool]]:
    """(start, run, whether it overlaps a base span) of all candidate runs but those within a base span.

    ``spans`` are ordered by start, so both lists are gone through once: of the spans that begin before
    the run ends, the one that ends last decides."""
    k, last, inner = 0, -1, -1
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        while k < len(spans) and spans[k][0] < e:
            last = max(last, spans[k][2])  # of all spans begun so far
            if spans[k][0] <= s:
                inner = max(inner, spans[k][2])  # of those that begin no later than the run
            k += 1
        if inner < e:
            yield s, m[0], last > s
        # spans that begin within this run begin before all later runs
        inner = max(inner, last)


class Automaton:
    """Deterministic probabilistic automaton by state merging of a prefix tree."""

    def __init__(self, words: list[str], alpha: float = ALPHA):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.ends = [0]
        self.arrivals = [len(words)]
        for w in words:
            at = 0
            for c in w:
                self.count[at][c] = self.count[at].get(c, 0) + 1
                if c not in self.next[at]:
                    self.next[at][c] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.ends.append(0)
                    self.arrivals.append(0)
                at = self.next[at][c]
                self.arrivals[at] += 1
            self.ends[at] += 1
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge()

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return bool(n1 and n2) and abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.arrivals[a], self.arrivals[b]
            if self._differ(self.ends[a], n1, self.ends[b], n2):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if self._differ(self.count[a].get(c, 0), n1, self.count[b].get(c, 0), n2):
                    return False
                if c in self.next[a] and c in self.next[b] and self.next[a][c] != self.next[b][c]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the states from ``a`` on."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.arrivals[a] += self.arrivals[b]
            self.ends[a] += self.ends[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge(self) -> None:
        red = [0]
        while True:
            known = set(red)
            blue = sorted((-self.arrivals[t], r, c, t) for r in red for c, t in self.next[r].items() if t not in known)
            if not blue:
                break
            _, r, c, t = blue[0]
            for q in red:
                if self._compatible(q, t):
                    self.next[r][c] = q
                    self._fold(q, t)
                    break
            else:
                red.append(t)
        self.states = {q: ({c: (math.log((n + 0.5) / (self.arrivals[q] + 0.5 * (ALPHABET + 1))), self.next[q][c])
                            for c, n in self.count[q].items()},
                           math.log((self.ends[q] + 0.5) / (self.arrivals[q] + 0.5 * (ALPHABET + 1))),
                           math.log(0.5 / (self.arrivals[q] + 0.5 * (ALPHABET + 1)))) for q in red}
        del self.next, self.count, self.ends, self.arrivals

    def log_likelihood(self, word: str) -> float:
        """Of the whole word; an unseen character costs its smoothed share and leaves the state."""
        at, total = 0, 0.0
        for c in word:
            steps, _, unseen = self.states[at]
            if c in steps:
                p, at = steps[c]
                total += p
            else:
                total += unseen
        return total + self.states[at][1]


class Formats:
    """Automata of the credential kinds, each with its floor, against that of ordinary words."""

    def __init__(self, credentials: dict[str, list[str]], words: list[str]):
        self.kinds = []
        for kind in sorted(credentials):
            if values := credentials[kind]:
                a = Automaton(values)
                scores = sorted(a.log_likelihood(v) / (len(v) + 1) for v in values)
                self.kinds.append((a, scores[int(LOW_SHARE * len(scores))] - SLACK))
        self.words = Automaton(words)
        self.known: dict[str, bool] = {}

    def is_credential(self, word: str) -> bool:
        hit = self.known.get(word)
        if hit is None:
            hit, plain = False, None
            for a, floor in self.kinds:
                score = a.log_likelihood(word)
                if score / (len(word) + 1) >= floor:
                    plain = self.words.log_likelihood(word) if plain is None else plain
                    hit = hit or score - plain >= MARGIN
            if len(self.known) < CACHED:
                self.known[word] = hit
        return hit


def labelled_sample(docs: DataFrame, sample: int) -> DataFrame:
    """(kind, h, value): of each kind, the strings of least hash in each task's documents.

    The least hashes of all are among those of the parts, so the sample is the same
    however the documents are dealt over tasks. ``word`` is what the base leaves.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[str, dict[str, int]] = {k: {} for k in (*KINDS[:3], "word")}
        floor = dict.fromkeys(least, 1 << 64)

        def shrink(kind: str) -> None:
            best = sorted(least[kind].items(), key=lambda x: (x[1], x[0]))[:sample]
            least[kind] = dict(best)
            floor[kind] = best[-1][1] if len(best) == sample else floor[kind]

        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                if t:
                    spans = base_spans(t)
                    for kind, v in [*((KINDS[k], v) for _, k, _, v in spans), *(("word", v) for _, v, touches in candidates(t, spans) if not touches)]:
                        if len(v) <= LONGEST and (h := xxhash.xxh64_intdigest(v)) <= floor[kind]:
                            least[kind][v] = h
                            if len(least[kind]) >= 4 * sample:
                                shrink(kind)
        for kind in least:
            shrink(kind)
        rows = [(k, h - (1 << 63), v) for k, x in least.items() for v, h in x.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.string())], names=["kind", "h", "value"])

    return texts(docs.select("text")).mapInArrow(run, "kind string, h long, value string")


def infer(docs: DataFrame, sample: int = SAMPLE) -> Formats | None:
    """Automata from at most ``sample`` distinct strings of each kind, of least hash over all documents."""
    rows = checkpointed(labelled_sample(docs, sample).distinct())
    got = {}
    for kind in (*KINDS[:3], "word"):
        top = rows.where(F.col("kind") == kind).orderBy("h", "value").limit(sample)
        got[kind] = [r[0] for r in top.select("value").collect()]
    words = got.pop("word")
    return Formats(got, words) if any(got.values()) else None


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for s, k, e in spans])


def find_secrets(docs: DataFrame, formats: Formats | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_format, base_sha256 and spans (``kind:start:end`` by start, then kind) per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for doc, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                spans, more = base_spans(t or ""), []
                if t and formats:
                    more = [(s, 3, s + len(v)) for s, v, _ in candidates(t, spans) if formats.is_credential(v)]
                base = [x[:3] for x in spans]
                counts = [sum(k == i for _, k, _ in base) for i in range(3)]
                rows.append((doc, *counts, len(more), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + more))))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "n_format", "base_sha256", "spans"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return texts(narrow).mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, n_format long, base_sha256 string, spans string")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    return find_secrets(docs, infer(docs.select(docs[text_col].alias("text")), sample), id_col, text_col)
