"""Personal data: patterns, and a skip-chain conditional random field that carries their labels to like tokens of a document."""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1  # 0 is none
BUCKETS = 4096  # of hashed features
TRAINING_ROWS = 5000  # documents, at most
TRAINING_TOKENS = 200_000
ROUNDS = 20  # of messages
SURE = 0.6  # marginal probability of an added label

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+")
_TRIM = ".,;:!?\"'()[]{}<>|*#$%&"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every @ is looked at once: the local part reaches back to the first character that can't be in one, or to the last match."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        floor = domain.end() if domain else at + 1
        if domain:
            yield start, floor
        at = text.find("@", floor)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Numbers joined by dots, in fours from the left; fours with a number over 255 are left out."""
    for run in _NUMBERS.finditer(text):
        parts, at = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "") if m.end() - m.start() <= 37 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            yield m.span()


_FINDERS = {"email": emails, "ip": addresses, "card": cards, "phone": phones}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all patterns, by kind and place; kind is the number in KINDS."""
    if not _MARK.search(text):
        return []
    return [(k, *span) for k, kind in enumerate(KINDS) for span in _FINDERS[kind](text)]


# ---- the random field ---------------------------------------------------------------------------


@dataclass
class Graph:
    """Tokens with a digit or an @ of some texts, and what ties them."""

    text: list[int]  # which text
    start: list[int]
    end: list[int]
    features: list[list[int]]
    base: list[int]  # the label of a pattern that the token is part of, or 0
    chain: list[tuple[int, int]]  # next to each other
    skip: list[tuple[int, int]]  # far apart, equal or alike

    @staticmethod
    def empty() -> Graph:
        return Graph([], [], [], [], [], [], [])


N_FEATURES = 10


def _shape(word: str) -> str:
    out = []
    for c in word[:40]:
        kind = "9" if c.isdigit() else "a" if c.isalpha() else c
        if not out or out[-1] != kind or kind not in "9a":
            out.append(kind)
    return "".join(out)


def _features(word: str, before: str, after: str) -> list[int]:
    digits = sum(c.isdigit() for c in word)
    names = (
        f"shape {_shape(word)}", f"digits {min(digits, 20)}", f"length {min(len(word), 24)}", f"first {word[0] if not word[0].isalnum() else _shape(word[0])}",
        f"last {word[-1] if not word[-1].isalnum() else _shape(word[-1])}", f"dots {min(word.count('.'), 4)} at {'@' in word}",
        f"before {_shape(before)}", f"after {_shape(after)}", f"word before {before.lower()[:12]}", "any",
    )
    return [zlib.crc32(n.encode()) % BUCKETS for n in names]


def add_text(graph: Graph, number: int, text: str, base: list[tuple[int, int, int]]) -> None:
    """Tokens of a text and their ties. A token is tied to the last one before it with the same letters and digits, and with the same digits if
    it has six or more, so ties are as many as tokens, and a name that occurs often hangs together."""
    first = len(graph.start)
    seen: dict[str, int] = {}
    spans = sorted((s, e, k) for k, s, e in base)
    at = 0
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        i = len(graph.start)
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        label = next((k + 1 for s, e, k in spans[at : at + 4] if s < end and start < e), 0)
        word = m.group()
        before, after = text[max(0, start - 24) : start].split(), text[end : end + 24].split()
        graph.features.append(_features(word, before[-1] if before else "", after[0] if after else ""))
        graph.text.append(number)
        graph.start.append(start)
        graph.end.append(end)
        graph.base.append(label)
        if i > first and not text[graph.end[i - 1] : start].strip():
            graph.chain.append((i - 1, i))
        plain = re.sub(r"[\W_]+", "", word).lower()
        digits = re.sub(r"[^0-9]+", "", word)
        for key in {f"w{plain}" if plain else "", f"d{digits}" if len(digits) >= 6 else ""} - {""}:
            if key in seen and (seen[key], i) not in graph.chain[-1:]:
                graph.skip.append((seen[key], i))
            seen[key] = i


@dataclass
class Field:
    """Weights of features, of neighbours' labels, and of the labels of tied tokens."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def fit(graph: Graph, rounds: int = 150, rate: float = 0.3, ridge: float = 1e-3) -> Field:
    """Weights that make each token's label likely given its features and the labels it is tied to (pseudo-likelihood), by scaled gradient steps.

    Every token counts twice, the second time with its features hidden, so that ties get weights although features alone would do.
    """
    n = len(graph.start)
    field = Field(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    if not n:
        return field
    x, y = np.array(graph.features), np.array(graph.base)
    chain, skip = (np.array(e, np.int64).reshape(-1, 2) for e in (graph.chain, graph.skip))
    own = np.eye(LABELS)[y]
    known = np.ones(x.shape, bool)
    hidden = known.copy()
    hidden[:, :-1] = False
    squares = [np.full(w.shape, 1e-8) for w in (field.unary, field.chain, field.skip)]
    for _ in range(rounds):
        ties = np.zeros((n, LABELS))
        for edges, weights in ((chain, field.chain), (skip, field.skip)):
            np.add.at(ties, edges[:, 1], weights[y[edges[:, 0]]])
            np.add.at(ties, edges[:, 0], weights.T[y[edges[:, 1]]])
        unary, error = np.zeros_like(field.unary), np.zeros((n, LABELS))
        for seen in (known, hidden):
            logits = ties + (field.unary[x] * seen[:, :, None]).sum(1)
            p = np.exp(logits - logits.max(1, keepdims=True))
            part = own - p / p.sum(1, keepdims=True)
            np.add.at(unary, x[seen], np.repeat(part, seen.sum(1), 0))
            error += part
        steps = [unary]
        for edges in (chain, skip):
            step = np.zeros((LABELS, LABELS))
            np.add.at(step, (y[edges[:, 0]],), error[edges[:, 1]])
            np.add.at(step.T, (y[edges[:, 1]],), error[edges[:, 0]])
            steps.append(step)
        for weights, step, square in zip((field.unary, field.chain, field.skip), steps, squares, strict=True):
            step = step / n - ridge * weights
            square += step * step
            weights += rate * step / np.sqrt(square)
    return field


def marginals(graph: Graph, field: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of all tokens by loopy message passing (sum-product, damped); tokens of patterns keep their label."""
    n = len(graph.start)
    if not n:
        return np.zeros((0, LABELS))
    base = np.array(graph.base)
    own = field.unary[np.array(graph.features)].sum(1)
    own[base > 0] = -30.0
    own[base > 0, base[base > 0]] = 0.0
    edges = [np.array(e, np.int64).reshape(-1, 2) for e in (graph.chain, graph.skip)]
    source = np.concatenate([edges[0][:, 0], edges[1][:, 0], edges[0][:, 1], edges[1][:, 1]])
    target = np.concatenate([edges[0][:, 1], edges[1][:, 1], edges[0][:, 0], edges[1][:, 0]])
    count = [len(e) for e in edges]
    tables = np.concatenate([
        np.repeat(field.chain[None], count[0], 0), np.repeat(field.skip[None], count[1], 0),
        np.repeat(field.chain.T[None], count[0], 0), np.repeat(field.skip.T[None], count[1], 0),
    ])
    back = np.roll(np.arange(len(source)), len(source) // 2)  # the same edge the other way
    message = np.zeros((len(source), LABELS))
    for _ in range(rounds):
        belief = own.copy()
        np.add.at(belief, target, message)
        held = (belief[source] - message[back])[:, :, None] + tables
        top = held.max(1, keepdims=True)
        new = np.log(np.exp(held - top).sum(1)) + top[:, 0]
        new -= new.max(1, keepdims=True)
        change = np.abs(new - message).max(initial=0)
        message = 0.5 * message + 0.5 * new
        if change < 1e-4:
            break
    belief = own.copy()
    np.add.at(belief, target, message)
    p = np.exp(belief - belief.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(graph: Graph, texts: list[str], base: list[list[tuple[int, int, int]]], field: Field, sure: float = SURE) -> list[list[tuple[int, int, int]]]:
    """For each text, (kind, start, end) of tokens outside all patterns that are ``sure`` to have a label, neighbours joined, without the marks around them."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    p = marginals(graph, field)
    best = p.argmax(1) if len(p) else np.zeros(0, int)
    if not len(p):
        return out
    next_to = {b: a for a, b in graph.chain}
    chosen = (best > 0) & (np.array(graph.base) == 0) & (p.max(1) >= sure)
    last = None
    for i in np.flatnonzero(chosen):
        t, kind = graph.text[i], int(best[i]) - 1
        joins = last is not None and next_to.get(i) == last and best[last] == best[i]
        start = out[t].pop()[1] if joins and out[t] else graph.start[i]
        word = texts[t][start : graph.end[i]]
        start, end = graph.end[i] - len(word.lstrip(_TRIM)), start + len(word.rstrip(_TRIM))
        last = i if start < end else None
        if start < end:
            out[t].append((kind, start, end))
    return out


def pii_model(docs: DataFrame, id: str = "doc_id", text: str = "text", training_rows: int = TRAINING_ROWS) -> Field:
    """A field fitted on documents whose labels are those of the patterns.

    At most ``training_rows`` documents, those of least id hash, and of their tokens with a digit or an @ at most TRAINING_TOKENS, are
    used; both are bounds of the fit only. The driver gets those documents' digit-bearing surroundings as numbers. An empty table gives a
    field without weights, which adds nothing.
    """
    ids = docs.select(F.col(id).alias("__id")).filter("__id is not null").distinct().orderBy(F.xxhash64("__id"), "__id").limit(training_rows)
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    sample = rows.join(F.broadcast(ids), F.col("id") == F.col("__id"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column("text").to_pylist():
                graph = Graph.empty()
                add_text(graph, 0, value, base_spans(value))
                n = len(graph.start)
                columns = [
                    [np.array(graph.features, np.int32).ravel().tolist()], [graph.base], [np.array(graph.chain, np.int32).ravel().tolist()], [np.array(graph.skip, np.int32).ravel().tolist()],
                ]
                if n:
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.list_(pa.int32())) for c in columns), pa.array([zlib.crc32(value.encode())], pa.int64())], names=["x", "y", "chain", "skip", "h"])

    found = sample.mapInArrow(run, "x array<int>, y array<int>, chain array<int>, skip array<int>, h bigint")
    used = found.orderBy("h", F.size("y")).limit(training_rows)
    graph = Graph.empty()
    for r in used.toLocalIterator():  # training_rows rows of numbers
        first = len(graph.base)
        if first + len(r["y"]) > TRAINING_TOKENS:
            break
        graph.base += r["y"]
        graph.start += [0] * len(r["y"])
        graph.features += np.array(r["x"]).reshape(-1, N_FEATURES).tolist()
        graph.chain += [(first + a, first + b) for a, b in np.array(r["chain"], int).reshape(-1, 2)]
        graph.skip += [(first + a, first + b) for a, b in np.array(r["skip"], int).reshape(-1, 2)]
    return fit(graph)


def find_pii(docs: DataFrame, field: Field, text: str = "text", sure: float = SURE) -> DataFrame:
    """Adds base and spans (arrays of struct kind, start, end) for each whole text; offsets in code points, end exclusive.

    base has the matches of the patterns, spans also what the field adds: tokens that no pattern covers, but whose like is covered
    elsewhere in the text, or that look and stand like those. Both are ordered by kind (as in KINDS) and place. Every text is a field
    of its own: ties don't leave it; texts of a batch are only computed together.

    Null and empty texts have no spans. Rows are handled one by one, so repeated rows and null ids need no rule. Other columns are carried along; those named base
    and spans are replaced.
    """
    docs = docs.drop("base", "spans")
    held = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans: list[tuple[int, int, int]]) -> list[dict]:
        return [{"kind": KINDS[k], "start": s, "end": e} for k, s, e in sorted(spans)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                texts = [t or "" for t in part.column(text).to_pylist()]
                base = [base_spans(t) for t in texts]
                graph = Graph.empty()
                for i, t in enumerate(texts):
                    if _MARK.search(t):
                        add_text(graph, i, t, base[i])
                more = added_spans(graph, texts, base, held.value, sure)
                both = [a + b for a, b in zip(base, more, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array([rows(s) for s in x], kind) for x in (base, both))], names=[*part.schema.names, "base", "spans"]
                )

    span = "array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.mapInArrow(run, docs.selectExpr("*", f"cast(null as {span}) base", f"cast(null as {span}) spans").schema)
