"""Secret scan: candidate strings, judged by a random forest that learned from labelled findings."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varstrata.plans.runtime import written

DICTIONARY = 5000
LEARNER_ROWS = 20_000  # labelled findings in one partition of what the forest learns from, on average
OWN_SPLITS = 10_000  # findings up to which MLlib looks at all of them for its split points; of more it would draw so many
_KEY = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]++(?:={1,2}(?![A-Za-z0-9+/_=-]))?")
_VALUE = re.compile(r"""[=:](?=[ \t]{0,8}(?:(["'`])([^\n"'`]{6,4096})\1|((?![=:/>])[^\s"'`,;&=]{6,4096}={0,2})))""")
_NAME = re.compile(r"""[A-Za-z_][\w.-]{0,60}["'`]?[ \t]{0,8}\Z""")
_SAYS_SECRET = re.compile(r"token|secret|passw|api|key|auth|credential|private|bearer", re.I)
_SAYS_OTHER = re.compile(r"sha|md5|hash|digest|commit|checksum|uuid|guid|version|etag|rev", re.I)
_HARMLESS_PATH = re.compile(r"test|example|sample|mock|fixture|lock|\.min\.|vendor|doc", re.I)
FEATURES = [
    "length", "digits", "upper", "hex", "kinds", "entropy", "transition", "dictionary", "harmless_path", "says_secret", "says_other",
    "assigned", "quoted", "word_before", "word_after", "groups",
]


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Where what may be a secret begins and ends, in order.

    That is runs of 16 or more key characters with a digit among them, with '=' as padding at the end only, and values of 6 or more characters of
    any kind assigned to a name: quoted ones and those after '='; with spaces, or after ':' without quotes, only if the name says secret.
    """
    found = {m.span() for m in _KEY.finditer(text) if m.end() - m.start() >= 16}
    for m in _VALUE.finditer(text):
        name = _NAME.search(text[max(0, m.start() - 80) : m.start()])
        quoted = m.group(1) is not None
        plain = quoted and not re.search(r"\s", m.group(2)) or not quoted and text[m.start()] == "="
        if name and (plain or _SAYS_SECRET.search(name.group())):
            found.add(m.span(2 if quoted else 3))
    yield from sorted(found)


def _class(c: str) -> int:
    code = ord(c)
    if 97 <= code <= 122:
        return code - 97
    if 65 <= code <= 90:
        return code - 65
    return 26 if c.isdigit() else 27


def transition_table(counted: dict[str, int]) -> np.ndarray:
    """Log probabilities of a letter, digit or mark after another, from counted words."""
    table = np.full((28, 28), 0.5)
    for word, n in counted.items():
        classes = [_class(c) for c in word if c.isascii()]
        for a, b in zip(classes, classes[1:], strict=False):
            table[a, b] += n
    return np.log(table / table.sum(1, keepdims=True))


def coverage(candidate: str, dictionary: frozenset[str]) -> float:
    """The share of a candidate that words of the dictionary cover, longest first from each place."""
    lower, at, covered = candidate.lower(), 0, 0
    while at < len(lower):
        size = next((n for n in range(12, 2, -1) if lower[at : at + n] in dictionary and at + n <= len(lower)), 0)
        covered += size
        at += size or 1
    return covered / max(1, len(candidate))


def features(candidate: str, path: str, before: str, after: str, table: np.ndarray, dictionary: frozenset[str]) -> list[float]:
    """Numbers in the order of FEATURES. before and after are the text on either side, some words of it."""
    n = len(candidate)
    counts = Counter(candidate)
    classes = [_class(c) for c in candidate]
    steps = table[classes[:-1], classes[1:]] if n > 1 else np.zeros(1)
    words_before, words_after = before.split(), after.split()
    return [
        math.log(n), sum(c.isdigit() for c in candidate) / n, sum(c.isupper() for c in candidate) / n,
        float(all(c in "0123456789abcdefABCDEF" for c in candidate)),
        sum((any(c.isdigit() for c in candidate), any(c.islower() for c in candidate), any(c.isupper() for c in candidate))),
        -sum(k / n * math.log2(k / n) for k in counts.values()), float(steps.mean()), coverage(candidate, dictionary),
        float(bool(_HARMLESS_PATH.search(path))), float(bool(_SAYS_SECRET.search(before))), float(bool(_SAYS_OTHER.search(before))),
        float(bool(re.search(r"[=:]\s*[\"'`]?$", before))), float(before[-1:] in "\"'`" and before != "" and after[:1] == before[-1:]),
        float(bool(words_before and words_before[-1].lower().strip(".,:=") in dictionary)),
        float(bool(words_after and words_after[0].lower().strip(".,:=\"'") in dictionary)), float(len(re.findall(r"[-_/=+]", candidate))),
    ]


def findings(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = "source", around: int = 40) -> DataFrame:
    """All ``candidates``: (id, start, end, candidate, path, before, after); offsets in characters, end exclusive.

    before and after are the ``around`` characters on either side. Null and empty texts have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i in range(batch.num_rows):
                value = batch.column(1)[i].as_py() or ""
                for start, end in candidates(value):
                    at.append(i)
                    out.append((start, end, value[start:end], value[max(0, start - around) : start], value[end : end + around]))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), *(pa.array(c, pa.int64()) for c in columns[:2]), pa.array(columns[2], pa.string()), batch.column(2).take(rows),
                 *(pa.array(c, pa.string()) for c in columns[3:])],
                names=["id", "start", "end", "candidate", "path", "before", "after"],
            )

    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), where.alias("path"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, start bigint, end bigint, candidate string, path string, before string, after string")


def label_by_assignment(found: DataFrame) -> DataFrame:
    """Labelled findings where nobody has labelled any: adds label.

    1 for candidates assigned to a name that says secret, 0 for all others. So that a forest does not only learn that name, every
    second labelled finding (by hash) loses the text around it.
    """
    secret = F.col("before").rlike(r"(?i)(token|secret|passw\w*|api_?key|auth|credential|private_?key)\w*[\"'`]?\s*[=:]\s*[\"'`]?$")
    blind = F.pmod(F.xxhash64("candidate", "id"), F.lit(2)) == 0
    labelled = found.withColumn("label", secret.cast("int"))
    return labelled.withColumns({c: F.when(blind, F.lit("")).otherwise(F.col(c)) for c in ("before", "after")})


class SecretModel:
    """A fitted forest with the word statistics its features need."""

    def __init__(self, forest: PipelineModel | None, share: float, table: np.ndarray, dictionary: frozenset[str]):
        self.forest, self.share, self.table, self.dictionary = forest, share, table, dictionary


def _with_features(found: DataFrame, table: np.ndarray, dictionary: frozenset[str]) -> DataFrame:
    held = found.sparkSession.sparkContext.broadcast((table, dictionary))  # DICTIONARY words and 28 x 28 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, dictionary = held.value
        for batch in batches:
            texts = [batch.column(c).to_pylist() for c in ("candidate", "path", "before", "after")]
            rows = [features(c, p or "", b or "", a or "", table, dictionary) for c, p, b, a in zip(*texts, strict=True)]
            numbers = np.array(rows, np.float64).reshape(len(rows), len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(numbers[:, k]) for k in range(len(FEATURES)))], names=[*batch.schema.names, *(f"f_{n}" for n in FEATURES)]
            )

    schema = found.selectExpr("*", *(f"cast(0 as double) f_{n}" for n in FEATURES)).schema
    return found.mapInArrow(run, schema)


def _bins(rows: DataFrame) -> Bucketizer:
    """Bins of all features, bounded by quantiles over all findings of each label, least and largest included: 34 bounds at most."""
    names = [f"f_{n}" for n in FEATURES]
    levels = [k / 16 for k in range(17)]
    by_label = rows.groupBy("label").agg(*(F.percentile_approx(n, levels, 10_000).alias(n) for n in names)).collect()  # two rows
    bounds = [[-math.inf, *sorted({x for r in by_label for x in r[n]}), math.inf] for n in names]
    return Bucketizer(splitsArray=bounds, inputCols=names, outputCols=[f"b_{n}" for n in FEATURES])


def secret_model(
    docs: DataFrame, labelled: DataFrame | None = None, id: str = "doc_id", text: str = "text", path: str | None = "source",
    trees: int = 40, depth: int = 8, seed: int = 42,
) -> SecretModel:
    """A forest fitted on all labelled findings: (candidate, path, before, after, label).

    Without them, the findings of all docs are labelled by ``label_by_assignment``. All docs also give the words from which letter
    transitions and the dictionary (the 5000 commonest words) are taken. With one label only there is no forest: every score is the share of label 1.

    MLlib draws 10,000 rows, or the square of maxBins if that is more, for its split points. So more findings than that are put into bins
    first, by quantiles over all of them, and maxBins is raised until none is left out; bins in use stay at most 35 a feature. Findings are dealt to partitions
    by a hash and sorted there, so that what each tree draws does not depend on how tables are cut into files.
    """
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), (F.col(path).cast("string") if path else F.lit("")).alias("path"))
    words = source.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+")).alias("word")).filter("length(word) > 2")
    counted = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    # written, so that the commonest words of each partition meet in a task, not in the driver
    common = written(counted.orderBy(F.desc("n"), "word").limit(DICTIONARY), "words").collect()
    dictionary = frozenset(r["word"] for r in common if r["n"] > 1)
    table = transition_table({r["word"]: r["n"] for r in common})
    if labelled is None:
        labelled = label_by_assignment(findings(source, "id", "text", "path"))
    place = [F.col(c) for c in ("id", "start") if c in labelled.columns]  # copies are spread where their places are known
    known = labelled.filter(F.col("label").isNotNull()).select(
        "candidate", "path", "before", "after", F.col("label").cast("double").alias("label"),
        F.xxhash64("candidate", "before", "after").alias("__h"), F.xxhash64("candidate", "path", "before", "after", "label", *place).alias("__deal"),
    )
    names = [f"f_{n}" for n in FEATURES]
    rows = written(_with_features(known, table, dictionary).select("label", "__h", "__deal", *names), "findings")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return SecretModel(None, max(sizes, default=0.0), table, dictionary)
    total = sum(sizes.values())
    weighted = rows.withColumn("weight", F.when(F.col("label") == 1, total / (2 * sizes[1.0])).otherwise(total / (2 * (total - sizes[1.0]))))
    dealt = weighted.repartition(1 + (total - 1) // LEARNER_ROWS, "__deal").sortWithinPartitions("__h", "label", *names)
    binned = [] if total <= OWN_SPLITS else [_bins(rows)]
    most = 32 if not binned else min(max(64, math.isqrt(total) + 1), 46_340)  # its square is a 32-bit number
    assembler = VectorAssembler(inputCols=binned[0].getOutputCols() if binned else names, outputCol="f_all")
    forest = RandomForestClassifier(labelCol="label", featuresCol="f_all", weightCol="weight", numTrees=trees, maxDepth=depth, maxBins=most, seed=seed)
    return SecretModel(Pipeline(stages=[*binned, assembler, forest]).fit(dealt), sizes[1.0] / total, table, dictionary)


def secret_scan(
    docs: DataFrame, model: SecretModel, id: str = "doc_id", text: str = "text", path: str | None = "source", threshold: float = 0.5
) -> DataFrame:
    """All candidates of the whole texts with the forest's judgement: (id, start, end, candidate, score, is_secret).

    Null and empty texts give no rows; repeated rows give repeated findings; rows of null id give findings of null id; an empty table gives none. Of other
    columns only ``path`` is read; null paths count as empty.
    """
    found = findings(docs, id, text, path)
    if model.forest is None:
        scored = found.withColumn("score", F.lit(float(model.share)))
    else:
        judged = model.forest.transform(_with_features(found, model.table, model.dictionary))
        scored = judged.withColumn("score", vector_to_array("probability")[1])
    return scored.select(F.col("id").alias(id), "start", "end", "candidate", "score", (F.col("score") >= threshold).alias("is_secret"))
