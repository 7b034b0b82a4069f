"""Toxicity scores by a support vector machine on a gapped-subsequence kernel of words, with Nyström landmarks."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varstrata.llm.groups import text_parts

ORDER = 3  # characters of a subsequence
DECAY = 0.5  # for each character that a subsequence spans
SHARPNESS = 4  # the power of the kernel of two words: a power of a kernel is a kernel
SILENT = 0.02  # smaller kernel values count as 0
WINDOW = 24  # longer words are several, each this long and half overlapping
LANDMARKS = 48
NEAR = 0.55**SHARPNESS  # landmarks are less alike than this
TRAINING_ROWS = 20_000
CACHED_WORDS = 500_000  # without marks around them; few have values
CACHED_FORMS = 150_000  # as they stand in texts
TEXT_CHARS = 1_000_000
_SPELLED = re.compile(r"(?<!\S)(?:\w\s){3,}\w(?!\S)")
_EDGES = string.punctuation + "«»“”„’‘…¿¡–—"


def subsequence_kernel(a: np.ndarray, b: np.ndarray, order: int = ORDER, decay: float = DECAY) -> np.ndarray:
    """Gap-weighted subsequence kernel of row i of a with row i of b (code points, padded by 0).

    Adds up, for each common subsequence of ``order`` characters and each place of it in both strings, decay to the power of what
    it spans in both, so that characters inserted between cost a factor and do not hide it. One step for each two positions, over all pairs at once.
    """
    m, n = a.shape[1], b.shape[1]
    factor = np.float32(decay)
    columns, others = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    zero = np.zeros(len(a), np.float32)
    # prefix[i][j]: the kernel of one order less on the first i and j characters, its spans counted to their ends
    prefix = [[np.ones(len(a), np.float32)] * (n + 1)] * (m + 1)
    total = zero
    for level in range(1, order + 1):
        grown = [[zero] * (n + 1) for _ in range(m + 1)]
        for i in range(level, m + 1):
            row = zero
            for j in range(level, n + 1):
                same = (columns[i - 1] == others[j - 1]) & (columns[i - 1] != 0)
                hit = same * prefix[i - 1][j - 1] * (factor * factor)
                if level == order:
                    total = total + hit
                else:
                    row = row * factor + hit
                    grown[i][j] = grown[i - 1][j] * factor + row
        prefix = grown
    return total


def codes(words: list[str]) -> np.ndarray:
    """Words as code points with a mark of the beginning, padded by 0."""
    out = np.zeros((len(words), max(map(len, words), default=0) + 1), np.int32)
    out[:, 0] = 1
    for i, word in enumerate(words):
        out[i, 1 : len(word) + 1] = np.frombuffer(word.encode("utf-32-le"), np.int32)
    return out


def _self_kernel(coded: np.ndarray) -> np.ndarray:
    return subsequence_kernel(coded, coded)


class Triples:
    """The subsequences of three characters of all landmarks, as numbers, with what each weighs in each landmark."""

    def __init__(self, landmarks: list[str]):
        marks = codes(landmarks)
        self.alphabet = np.unique(marks[marks > 0])
        base = self.base = len(self.alphabet) + 1
        numbers, owner, weight = [], [], []
        for j, mark in enumerate(landmarks):
            i1, i2, i3, span = _places(len(mark) + 1)
            c = self.letters(marks[j : j + 1, : len(mark) + 1])[0]
            numbers.append((c[i1] * base + c[i2]) * base + c[i3])
            owner.append(np.full(len(i1), j))
            weight.append(span)
        self.known, at = np.unique(np.concatenate(numbers), return_inverse=True)
        self.weight = np.zeros((len(self.known) + 1, len(landmarks)), np.float32)  # row 0: in no landmark
        np.add.at(self.weight, (at + 1, np.concatenate(owner)), np.concatenate(weight))
        self.own = (self.weight.astype(np.float64) ** 2).sum(0)
        self.table = None
        if base**3 <= 1 << 24:
            self.table = np.zeros(base**3, np.int32)
            self.table[self.known] = np.arange(len(self.known)) + 1

    def letters(self, coded: np.ndarray) -> np.ndarray:
        """Numbers of characters from 1; 0 for those that no landmark has."""
        at = np.minimum(np.searchsorted(self.alphabet, coded), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == coded, at + 1, 0).astype(np.int64)

    def rows(self, numbers: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[numbers]
        at = np.minimum(np.searchsorted(self.known, numbers), len(self.known) - 1)
        return np.where(self.known[at] == numbers, at + 1, 0)

    def kernel(self, coded: np.ndarray) -> np.ndarray:
        """Plain kernel values of words of one length, with all landmarks."""
        i1, i2, i3, span = _places(coded.shape[1])
        c = self.letters(coded)
        found = self.rows((c[:, i1] * self.base + c[:, i2]) * self.base + c[:, i3])
        word, place = np.nonzero(found)
        out = np.zeros((len(coded), self.weight.shape[1]), np.float32)
        if len(word):
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            out[word[starts]] = np.add.reduceat(self.weight[found[word, place]] * span[place, None], starts)
        return out


@cache
def _places(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All three places in order among n, and the decay of what they span."""
    triples = np.array(list(combinations(range(n), ORDER)), np.int64).reshape(-1, ORDER)
    return triples[:, 0], triples[:, 1], triples[:, 2], (DECAY ** (triples[:, 2] - triples[:, 0] + 1)).astype(np.float32)


@lru_cache(maxsize=4)
def _triples(landmarks: tuple[str, ...]) -> Triples:
    return Triples(list(landmarks))


TRIPLES_TOGETHER = 100_000


def alike(words: list[str], landmarks: list[str], least: float = SILENT) -> np.ndarray:
    """Which words are near enough to a landmark that their kernel value may be ``least`` or more, and is above 0.

    The kernel is a sum over common subsequences, added up here from a table of the landmarks' own. A word's kernel with itself is at least the sum of the squares of what
    its subsequences weigh place by place, which depends on its length alone. So the quotient bounds the normalised kernel from above: no other pair can be heard.
    """
    out = np.zeros((len(words), len(landmarks)), bool)
    if not len(words):
        return out
    triples = _triples(tuple(landmarks))
    coded = codes(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        n = int(lengths[same[0]])
        if n < ORDER:
            continue
        span = _places(n)[3].astype(np.float64)
        own = np.sqrt((span**2).sum() * triples.own)
        step = max(1, TRIPLES_TOGETHER // len(span))
        for low in range(0, len(same), step):
            some = same[low : low + step]
            values = triples.kernel(coded[some, :n])
            out[some] = (values > 0) & ((values / own) ** SHARPNESS >= 0.99 * least)  # less what rounding takes
    return out


def kernel(words: list[str], landmarks: list[str], least: float = 0.0) -> np.ndarray:
    """Normalised kernel of words and landmarks, sharpened; values below ``least`` may be given as 0.

    Only pairs that are ``alike`` are computed, those of about one length together.
    """
    out = np.zeros((len(words), len(landmarks)), np.float32)
    marks = codes(landmarks)
    sizes = np.fromiter(map(len, landmarks), np.int64, len(landmarks)) + 1
    own = _self_kernel(marks)
    i, j = np.nonzero(alike(words, landmarks, least))
    used, at = np.unique(i, return_inverse=True)
    coded = codes([words[k] for k in used])
    lengths = np.fromiter((len(words[k]) for k in used), np.int64, len(used)) + 1
    among = np.zeros(len(used), np.float32)
    order = np.argsort(lengths, kind="stable")
    for low in range(0, len(order), 4096):
        p = order[low : low + 4096]
        among[p] = _self_kernel(coded[p, : lengths[p].max()])
    order = np.lexsort((sizes[j], lengths[at]))
    for low in range(0, len(order), 4096):
        p = order[low : low + 4096]
        a, b = coded[at[p], : lengths[at[p]].max()], marks[j[p], : sizes[j[p]].max()]
        out[i[p], j[p]] = subsequence_kernel(a, b) / np.sqrt(np.maximum(among[at[p]] * own[j[p]], 1e-30))
    return np.where(np.isfinite(out), out, 0) ** SHARPNESS


def words_of(text: str) -> list[str]:
    """White-space parted words in lower case, and words spelled out in single letters."""
    text = text.lower()
    return text.split() + ["".join(m.split()) for m in _SPELLED.findall(text)]


def windows(word: str) -> list[str]:
    """A word without marks at its ends; several overlapping ones for a long word; none for marks alone."""
    word = word.strip(_EDGES)
    if len(word) <= WINDOW:
        return [word] if word else []
    return [word[i : i + WINDOW] for i in range(0, len(word) - WINDOW // 2, WINDOW // 2)]


class Summer:
    """Sums of the kernel values of a text's words with each landmark."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        self._forget()

    def _forget(self) -> None:
        self.forms: dict[str, int] = {}
        self.row: dict[str, int] = {}  # of a word without marks; -1 if all its values are 0
        self.values = np.zeros((0, len(self.landmarks)), np.float32)

    def _learn(self, raw: list[str]) -> None:
        bare = [w.strip(_EDGES) for w in raw]
        fresh = [w for w in dict.fromkeys(bare) if w not in self.row]  # forms of a word that differ in marks around it are computed once
        owner = [i for i, w in enumerate(fresh) if 0 < len(w) <= WINDOW]
        parts = [fresh[i] for i in owner]
        for i, w in enumerate(fresh):
            if len(w) > WINDOW:
                pieces = windows(w)
                owner += [i] * len(pieces)
                parts += pieces
        self.row.update(dict.fromkeys(fresh, -1))
        values = kernel(parts, self.landmarks, SILENT)
        values[values < SILENT] = 0
        loud = np.flatnonzero(values.any(1))
        rows, at = np.unique(np.array(owner, np.int64)[loud], return_inverse=True)
        new = np.zeros((len(rows), len(self.landmarks)), np.float32)
        np.add.at(new, at, values[loud])
        base = len(self.values)
        self.row.update((fresh[i], base + k) for k, i in enumerate(rows))
        self.forms.update(zip(raw, map(self.row.__getitem__, bare), strict=True))
        self.values = np.vstack([self.values, new])

    def sums(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.landmarks)), np.float32)
        if len(self.row) > CACHED_WORDS:
            self._forget()
        if len(self.forms) > CACHED_FORMS:
            self.forms = {}
        split = [words_of(text) for text in texts]
        unknown = set().union(*split).difference(self.forms)
        if unknown:
            self._learn(sorted(unknown))
        for i, ws in enumerate(split):
            rows = [r for r in map(self.forms.__getitem__, ws) if r >= 0]
            if rows:
                out[i] = self.values[rows].sum(0)
        return out


def nystrom(landmarks: list[str]) -> np.ndarray:
    """The matrix that turns kernel values with the landmarks into coordinates: K to the power -1/2."""
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray  # one for each landmark, the coordinates' matrix multiplied in; the last is the bias
    slope: float
    offset: float

    def margin(self, sums: np.ndarray) -> np.ndarray:
        return damped(sums) @ self.weights[:-1] + self.weights[-1]

    def score(self, sums: np.ndarray) -> np.ndarray:
        z = np.clip(self.slope * self.margin(sums) + self.offset, -30, 30)
        return 1 / (1 + np.exp(-z))


def damped(sums: np.ndarray) -> np.ndarray:
    """A second insult of a kind says less than the first."""
    return np.log1p(sums.astype(np.float64))


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 100) -> np.ndarray:
    """Squared-hinge linear support vector machine by Newton steps; y is 0 or 1, classes count alike; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    sign = 2.0 * y - 1
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y) * cost
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        slack = 1 - sign * (x @ w)
        on = slack > 0
        gradient = ridge @ w - x[on].T @ (weight[on] * sign[on] * slack[on])
        step = np.linalg.solve(ridge + (x[on].T * weight[on]) @ x[on], gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1 as a logistic function of the margin, by damped Newton steps."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.column_stack([margin, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-6)) @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        w = w - step * min(1, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def stems(text: str) -> set[str]:
    """What landmarks are chosen from: the words of a text and their beginnings of 4 letters or more."""
    out = set()
    for word in set(words_of(text)):
        for w in windows(word):
            out.update(w[:k] for k in range(4, min(len(w), 10) + 1))
            if len(w) >= 4:
                out.add(w)
    return out


def choose_landmarks(counted: list[tuple[str, int, int]], toxic: int, clean: int, n: int = LANDMARKS) -> list[str]:
    """The stems that tell the classes apart best, leaving out those close to one already chosen. counted: (stem, toxic, clean texts)."""
    def gain(t: int, c: int) -> float:
        p, q = (t + 0.5) / (toxic + 1), (c + 0.5) / (clean + 1)
        return abs(p - q) * abs(np.log(p / q))

    order = sorted(counted, key=lambda x: (-gain(x[1], x[2]), -len(x[0]), x[0]))[: 20 * n]
    if not order:
        return ["landmark"]
    names = [x[0] for x in order]
    near = kernel(names, names, NEAR) > NEAR
    chosen: list[int] = []
    for i in range(len(names)):
        if len(chosen) < n and not near[i, chosen].any():
            chosen.append(i)
    return [names[i] for i in chosen]


def _stems(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist(), strict=True):
                found = sorted(stems(text or ""))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], names=["stem", "y"])

    return rows.select("text", "y").mapInArrow(run, "stem string, y int")


_held: dict[tuple, Summer] = {}


def _summer(landmarks: list[str]) -> Summer:
    """One for each worker process, so that words are learned once."""
    key = tuple(landmarks)
    if key not in _held:
        _held.clear()
        _held[key] = Summer(landmarks)
    return _held[key]


def toxicity_model(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", train: Column | None = None,
    landmarks: int = LANDMARKS, training_rows: int = TRAINING_ROWS, cost: float = 1.0,
) -> Model | float:
    """A model of label 1, fitted on labelled rows for which ``train`` (a condition on labels) holds.

    At most ``training_rows`` labelled ids are used, those of least hash; that is the only bound, and a parameter. Landmarks
    are the words or beginnings of words that tell the classes apart best, counted over those texts. A text is the sum of its words, mapped by the Nyström
    method from their kernel values with the landmarks; the machine is fitted on the driver, on a row of
    ``landmarks`` numbers for each training text.

    An id with several labels counts as 1 if one of them is 1; null ids and labels are left out. Without rows of both
    labels there is nothing to fit: the share of label 1 is returned (0 without any), which then is every text's score.
    """
    usable = labels.filter(train) if train is not None else labels
    known = usable.filter(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id).alias("__id")).agg(F.max(label).cast("int").alias("y"))
    chosen = known.orderBy(F.xxhash64("__id"), "__id").limit(training_rows)  # ids and labels only, of bounded number
    plain = docs.select(F.col(id).alias("__doc"), F.col(text).alias("text"))
    rows = plain.join(F.broadcast(chosen), F.col("__doc") == F.col("__id")).select("text", "y")
    sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    toxic, clean = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)
    if not toxic or not clean:
        return 1.0 if toxic else 0.0
    counted = _stems(rows).groupBy("stem").agg(F.count_if(F.col("y") == 1).alias("t"), F.count_if(F.col("y") != 1).alias("c"))
    p, q = (F.col("t") + 0.5) / (toxic + 1), (F.col("c") + 0.5) / (clean + 1)
    best = counted.withColumn("gain", F.abs(p - q) * F.abs(F.log(p / q))).orderBy(F.desc("gain"), F.desc(F.length("stem")), "stem").limit(20 * landmarks)
    names = choose_landmarks([(r["stem"], r["t"], r["c"]) for r in best.collect()], toxic, clean, landmarks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch, "text", TEXT_CHARS):
                sums = _summer(names).sums(texts)
                yield pa.RecordBatch.from_arrays([part.column("y"), pa.array(list(sums), pa.list_(pa.float32()))], names=["y", "x"])

    features = rows.mapInArrow(run, "y int, x array<float>").toPandas()  # at most training_rows rows of numbers
    x, y = np.vstack(features["x"].to_numpy()), (features["y"].to_numpy() == 1).astype(int)
    order = np.lexsort((*x.T, y))  # rows come in any order; sums of them should not
    x, y = x[order], y[order]
    coordinates = nystrom(names)
    w = fit_svm(damped(x) @ coordinates, y, cost)
    model = Model(names, np.append(coordinates @ w[:-1], w[-1]), 1.0, 0.0)
    model.slope, model.offset = fit_sigmoid(model.margin(x), y)
    return model


def toxicity_scores(docs: DataFrame, model: Model | float, text: str = "text") -> DataFrame:
    """Adds score, a double from 0 to 1 for each whole text: higher, the likelier label 1.

    Null and empty texts have the score of a text without any words that matter. Words are scored once for each task and
    kept, up to a bound on their number. Nothing but the text is an input; other columns are carried along, one named score is replaced.
    """
    docs = docs.drop("score")
    if not isinstance(model, Model):
        return docs.withColumn("score", F.lit(float(model)))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        summer = _summer(model.landmarks)
        for batch in batches:
            for part, texts in text_parts(batch, text, TEXT_CHARS):
                scores = model.score(summer.sums(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], names=[*part.schema.names, "score"])

    return docs.mapInArrow(run, docs.selectExpr("*", "cast(0 as double) score").schema)
