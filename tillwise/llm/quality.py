"""Quality classifier from weak labels.

Each aspect of a bad document (shouting, symbol noise, tables, repetition, toxicity)
has three overlapping labellers that vote bad, good or nothing. Per aspect,
expectation-maximisation over the counts of vote patterns of ALL documents (at most 27
patterns, whatever the input) estimates how often each labeller votes what on bad and
on good documents, and with that the posterior of each pattern. A document is bad if
any aspect is. The posteriors train a linear scorer over hashed features (words, their
stems, and the labellers' measures in steps), which then scores every document.

One toxicity labeller is a list of stems found in labelled rows: those that nearly
only toxic documents have. It is fitted on at most ``LABELLED`` labelled rows of least
hash; the scorer is trained on about ``TRAIN`` documents chosen by hash. Everything
else covers all documents. Training is by iterative parameter mixing: every task runs
FTRL-proximal over its part of the sample, the driver averages states of fixed size.

Defined results: a null or empty text has no word, hence only votes for "good", and is
scored like any other; null ids are kept as they are; repeated rows get equal scores; an
empty table gives an empty result; without labelled rows that labeller abstains.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import slices, stored, texts

LABELLED, TRAIN, DIMENSIONS, PARTS, ROUNDS, EPOCHS = 20_000, 20_000, 1 << 17, 8, 4, 3
STEMS, STEM_SUPPORT, STEM_PRECISION = (3, 4, 5, 6, 8), 6, 0.98
CACHED_WORDS = 300_000
FEATURES_AT_ONCE = 1 << 20  # bytes of text whose features are held as Python objects
#: Insults that the English labeller knows.
INSULTS = frozenset("clown disgusting idiot loser moron pathetic scum stupid trash worthless".split())
ASPECTS = ("shouting", "symbols", "tables", "repetition", "toxicity")
EDGES = ".,;:!?\"'()[]{}|*$%&#@^~"
SYMBOLS = "*$%&#@^~"
SYMBOL_END = re.compile(r"[*$%&#@^~]{2,}(?!\S)")


def measures(text: str, words: list[str], counts: Counter) -> list[float]:
    """Shares by word that the labellers look at."""
    n = max(1, len(words))
    symbols = sum(map(text.count, SYMBOLS))
    ends = len(SYMBOL_END.findall(text)) if symbols else 0
    return [sum(map(str.isupper, words)) / n, text.count("!") / n, sum(map(str.islower, words)) / n,
            symbols / n, ends / n, sum(map(str.isalpha, words)) / n,
            counts["|"] / n, text.count(" | ") / n, list(map(len, words)).count(1) / n,
            sum(map(operator.eq, words, words[1:])) / n, len(counts) / n, list(counts.values()).count(1) / n]


#: For each measure: bad from this share on (or up to it, if the second is larger), good on the other side of the second.
LIMITS = [(0.5, 0.2), (0.3, 0.05), (0.3, 0.5), (0.3, 0.05), (0.3, 0.05), (0.3, 0.5),
          (0.1, 0.02), (0.08, 0.02), (0.25, 0.15), (0.2, 0.05), (0.15, 0.4), (0.05, 0.2)]
SHORT = 20  # under so many words, low variety says nothing


def votes(words: list[str], seen: list[float], known: int, stems: int, listed: bool) -> list[int]:
    """Of the 15 labellers, three for each aspect: 2 bad, 1 good, 0 nothing."""
    out = []
    for k, (x, (bad, good)) in enumerate(zip(seen, LIMITS)):
        if not words:
            out.append(1)
        elif k >= 10 and len(words) < SHORT:
            out.append(0)
        elif bad > good:
            out.append(2 if x >= bad else 1 if x <= good else 0)
        else:
            out.append(2 if x <= bad else 1 if x >= good else 0)
    return [*out, 2 if known else 1, (2 if stems else 1) if listed else 0, 2 if known + stems > 1 else 0 if known + stems else 1]


def clean(word: str) -> str:
    return word.strip(EDGES).lower()


def stems_of(word: str) -> list[str]:
    """Beginnings of some lengths, and the word itself with an end mark."""
    return [*(word[:k] for k in STEMS if len(word) >= k), word + "$"]


def label_em(counts: dict[tuple[int, ...], int], rounds: int = 500, tolerance: float = 1e-9) -> dict[tuple[int, ...], float]:
    """Posterior of "bad" for each vote pattern; a labeller that does not vote says nothing."""
    patterns = sorted(counts)
    if not patterns:
        return {}
    weight = np.array([counts[p] for p in patterns], dtype="f8")
    one = np.eye(3)[np.array(patterns)][:, :, 1:]  # pattern, labeller, vote (good, bad)
    start = np.array([[0.3, 0.7], [0.98, 0.02]]).T[None]  # vote by class (bad, good)
    rates, share = np.repeat(start, one.shape[1], axis=0), 0.1
    before = None
    for _ in range(rounds):
        logs = np.einsum("plv,lvc->pc", one, np.log(rates)) + np.log([share, 1 - share])
        bad = 1 / (1 + np.exp(np.clip(logs[:, 1] - logs[:, 0], -700, 700)))
        if before is not None and np.abs(bad - before).max() < tolerance:
            break
        before = bad
        by = np.stack([bad, 1 - bad], axis=1) * weight[:, None]
        rates = np.einsum("plv,pc->lvc", one, by) + start  # one document's worth of the start, so that no rate is zero
        rates /= rates.sum(axis=1, keepdims=True)
        share = float(np.clip((by[:, 0].sum() + 0.1) / (weight.sum() + 1), 1e-6, 0.5))
    return dict(zip(patterns, bad.tolist()))


def toxic_stems(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> frozenset[str]:
    """Stems and words that nearly only documents labelled toxic have."""
    chosen = (labels.where("doc_id is not null and toxic is not null").select("doc_id", "toxic")
              .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", FEATURES_AT_ONCE):
            stems, toxic = [], []
            for t, x in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found = {x for w in map(clean, set((t or "").split())) for x in stems_of(w)}
                stems += found
                toxic += [x] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(toxic, pa.int64())], names=["stem", "toxic"])

    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", F.col("toxic").cast("long").alias("toxic"))
    sums = texts(rows).mapInArrow(run, "stem string, toxic long").groupBy("stem").agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n"))
    good = sums.where((F.col("n") >= STEM_SUPPORT) & (F.col("t") >= STEM_PRECISION * F.col("n")))
    return frozenset(r[0] for r in good.select("stem").collect())


def _hash(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) & (DIMENSIONS - 1)


def word_features(word: str) -> tuple[int, int, int]:
    w = clean(word)
    return _hash("w" + w), _hash("s" + w[:4]), _hash("s" + w[:6])


def step_features(seen: list[float]) -> list[int]:
    return [_hash(f"m{k}:{min(10, math.ceil(10 * x))}") for k, x in enumerate(seen)]


class Cached(dict):
    """A function of words, remembered for a bounded number of them."""

    def __init__(self, f):
        self.f = f

    def __missing__(self, word: str):
        value = self.f(word)
        if len(self) < CACHED_WORDS and len(word) <= 32:
            self[word] = value
        return value


def toxic_marks(stems: frozenset[str]) -> Cached:
    """1 for an insult, 2 for another word with a listed stem, else 0."""
    beginnings = {x[:3] for x in stems} | {x.rstrip("$") for x in stems if len(x) <= 3}

    def mark(word: str) -> int:
        w = clean(word)
        if w in INSULTS:
            return 1
        return 2 if w[:3] in beginnings and not stems.isdisjoint(stems_of(w)) else 0
    return Cached(mark)


def _read(text: str | None) -> tuple[list[str], Counter, list[float]]:
    text = text or ""
    words = text.split()
    counts = Counter(words)
    return words, counts, measures(text, words, counts)


def _votes(words: list[str], counts: Counter, seen: list[float], marks: Cached, listed: bool) -> list[int]:
    marked = list(map(marks.__getitem__, counts))
    insults = marked.count(1)
    return votes(words, seen, insults, marked.count(2) + (insults if listed else 0), listed)


def vote_counts(docs: DataFrame, stems: frozenset[str]) -> dict[str, dict[tuple[int, ...], int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, found = toxic_marks(stems), Counter()
        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                v = _votes(*_read(t), marks, bool(stems))
                found.update((a, *v[3 * a:3 * a + 3]) for a in range(len(ASPECTS)))
        keys = list(found)
        cols = [pa.array([k[i] for k in keys], pa.int64()) for i in range(4)] + [pa.array([found[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["aspect", "a", "b", "c", "n"])

    counted = texts(docs.select("text")).mapInArrow(run, "aspect long, a long, b long, c long, n long")
    out: dict[str, dict[tuple[int, ...], int]] = {a: {} for a in ASPECTS}
    for r in counted.groupBy("aspect", "a", "b", "c").agg(F.sum("n").alias("n")).collect():
        out[ASPECTS[r[0]]][tuple(r)[1:4]] = r[4]
    return out


def posterior(vote: list[int], tables: list[dict[tuple[int, ...], float]]) -> float:
    fine = 1.0
    for a, table in enumerate(tables):
        fine *= 1 - table.get(tuple(vote[3 * a:3 * a + 3]), 0.0)
    return 1 - fine


class Ftrl:
    """FTRL-proximal logistic regression over hashed features, soft labels."""

    ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.3, 0.05

    def __init__(self, z: np.ndarray | None = None, n: np.ndarray | None = None):
        self.z = np.zeros(DIMENSIONS + 1) if z is None else z
        self.n = np.zeros(DIMENSIONS + 1) if n is None else n

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = -(z - np.sign(z) * self.L1) / ((self.BETA + np.sqrt(n)) / self.ALPHA + self.L2)
        return np.where(np.abs(z) <= self.L1, 0.0, w)

    def learn(self, i: np.ndarray, x: np.ndarray, label: float) -> None:
        """One row: its features, how often each comes, and its label."""
        w = self.weights(i)
        error = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w @ x))))) - label
        g = error * x
        step = (np.sqrt(self.n[i] + g * g) - np.sqrt(self.n[i])) / self.ALPHA
        self.z[i] += g - step * w
        self.n[i] += g * g


def train(sample: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights (the last is the constant's) from rows (features array<int>, bad double)."""
    z = n = np.zeros(DIMENSIONS + 1)
    for _ in range(rounds):
        state = (z, n)

        def run(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            model = Ftrl(*(x.copy() for x in state))
            rows = []  # a part of the sample, hence bounded
            for batch in batches:
                for f, bad in zip(batch.column("features"), batch.column("bad").to_pylist()):
                    i, x = np.unique(np.append(np.asarray(f.values), DIMENSIONS), return_counts=True)
                    rows.append((i, x, bad))
            for _ in range(EPOCHS):
                for row in rows:
                    model.learn(*row)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([x.astype("f4").tobytes()], pa.binary()) for x in (model.z, model.n)], names=["z", "n"])

        parts = sample.mapInArrow(run, "z binary, n binary").collect()
        if parts:
            z, n = (np.mean([np.frombuffer(p[k], dtype="f4") for p in parts], axis=0, dtype="f8") for k in (0, 1))
    return Ftrl(z, n).weights()


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN) -> tuple[frozenset[str], list[dict], np.ndarray]:
    """(stems, posterior tables by aspect, scorer weights)."""
    stems = toxic_stems(docs, labels)
    tables = [label_em(counts) for counts in vote_counts(docs, stems).values()]
    rows = docs.count()
    share = min(1.0, train_rows / max(1, rows))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, cached = toxic_marks(stems), Cached(word_features)
        for batch in slices(batches, "text", FEATURES_AT_ONCE):
            features, bad = [], []
            for t in batch.column("text").to_pylist():
                words, counts, seen = _read(t)
                features.append([f for w in sorted(counts) for f in cached[w]] + step_features(seen))
                bad.append(posterior(_votes(words, counts, seen, marks, bool(stems)), tables))
            yield pa.RecordBatch.from_arrays([pa.array(features, pa.list_(pa.int32())), pa.array(bad, pa.float64())], names=["features", "bad"])

    sample = stored(texts(chosen.select("text")).mapInArrow(run, "features array<int>, bad double")
                    .repartition(PARTS, F.xxhash64("features")).sortWithinPartitions(F.xxhash64("features", F.lit(1))))
    return stems, tables, train(sample.coalesce(PARTS))


class Scorer:
    """The linear scorer over hashed features, with a bounded cache of the weights of words."""

    def __init__(self, weights: np.ndarray):
        self.table = w = weights.tolist()

        def weigh(word: str) -> float:
            a, b, c = word_features(word)
            return w[a] + w[b] + w[c]
        self.words = Cached(weigh)

    def __call__(self, counts: Counter, seen: list[float]) -> float:
        s = self.table[-1] + sum(self.table[f] for f in step_features(seen)) + math.fsum(map(self.words.__getitem__, counts))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, s))))


def classify(docs: DataFrame, model: tuple, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = 0.5) -> DataFrame:
    """doc_id, score (probability of a bad document), weak_label (posterior of the labellers), kept per row."""
    stems, tables, weights = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, scorer = toxic_marks(stems), Scorer(weights)
        for batch in slices(batches, "text"):
            score, weak = [], []
            for t in batch.column("text").to_pylist():
                words, counts, seen = _read(t)
                score.append(scorer(counts, seen))
                weak.append(posterior(_votes(words, counts, seen, marks, bool(stems)), tables))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score, pa.float64()), pa.array(weak, pa.float64()),
                                              pa.array([s < threshold for s in score], pa.bool_())], names=["doc_id", "score", "weak_label", "kept"])

    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    return texts(narrow).mapInArrow(run, "doc_id long, score double, weak_label double, kept boolean")


def keep_good(docs: DataFrame, model: tuple, threshold: float = 0.5) -> DataFrame:
    """``docs`` without what the classifier rejects; all columns stay, row by row, without a join."""
    weights, columns = model[2], docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights)
        for batch in slices(batches, "text"):
            kept = [scorer(*_read(t)[1:]) < threshold for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(kept, pa.bool_())).select(columns)

    return texts(docs).mapInArrow(run, docs.schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    narrow = docs.select("doc_id", "text")
    return classify(narrow, fit(narrow, labels))
