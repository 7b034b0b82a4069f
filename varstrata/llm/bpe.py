"""Byte-pair encoding with word ends, by rounds of merges over flat arrays, and decoding."""

from __future__ import annotations

import json
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from varstrata.llm.groups import text_parts

# fixed values of the vocabulary's format: white space, pieces, and the characters that stand for bytes
SPACE = r"\t-\r \x85\xa0  -     　"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
WORD_END = "</w>"

TEXT_CHARS = 1_000_000  # characters handled at once; a longer text is handled alone
CACHED_PIECES = 100_000
_NEVER = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself if printable, else one from 256 on, in order."""
    spare = iter(range(256, 512))
    return [chr(b) if b in PRINTABLE else chr(next(spare)) for b in range(256)]


class WordBpe:
    """Encoder and decoder for one vocabulary file, given as its text."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {**{i: name for name, i in vocab.items()}, **{i: name for name, i in self.special.items()}}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        characters = byte_characters()
        self.inner = np.array([vocab[c] for c in characters], np.int64)
        self.final = np.array([vocab[c + WORD_END] for c in characters], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in merges], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.piece = regex.compile(PIECE)
        self.space = regex.compile(f"[{SPACE}]+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.packed: list[bytes] = []

    def merge_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of non-empty words: rounds in which each word merges its pair of lowest rank wherever it stands."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8)
        ids = self.inner[raw]
        last = np.cumsum(lengths) - 1
        ids[last] = self.final[raw[last]]
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_words = [], []
        while len(ids):
            inside = word[:-1] == word[1:]
            key = (ids[:-1] << 32) | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(inside & (self.keys[at] == key), self.ranks[at], _NEVER)
            rank = np.append(rank, _NEVER)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            least = np.minimum.reduceat(rank, starts)
            least = np.repeat(least, np.diff(np.append(starts, len(ids))))
            open_ = least != _NEVER
            chosen = np.flatnonzero(open_ & (rank == least))
            if len(chosen):
                # of overlapping pairs, as in aaa, every second one, from the left
                run = np.append(True, np.diff(chosen) != 1)
                first = np.flatnonzero(run)
                place = np.arange(len(chosen)) - np.repeat(first, np.diff(np.append(first, len(chosen))))
                chosen = chosen[place % 2 == 0]
                ids[chosen] = self.merged[rank[chosen]]
                keep = np.ones(len(ids), bool)
                keep[chosen + 1] = False
            else:
                keep = np.ones(len(ids), bool)
            over = ~open_
            done_ids.append(ids[over])
            done_words.append(word[over])
            keep &= open_
            ids, word = ids[keep], word[keep]
        all_words = np.concatenate(done_words)
        all_ids = np.concatenate(done_ids)[np.argsort(all_words, kind="stable")]
        return np.split(all_ids, np.cumsum(np.bincount(all_words, minlength=len(words)))[:-1])

    def _pieces(self, text: str) -> list[str]:
        text = self.space.sub(" ", unicodedata.normalize("NFC", text))
        return self.piece.findall(text.replace("Σ", "σ").lower())

    def _numbers(self, text: str) -> list[int]:
        """Numbers of a text's pieces; special tokens have numbers below 0."""
        parts = self.specials.split(text) if self.specials and "<" in text else [text]
        out: list[int] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(-1 - self.special[part])
            elif part:
                out.extend(map(self.number.__getitem__, self._pieces(part)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        if len(self.number) > CACHED_PIECES:
            self._forget()
        numbers = [self._numbers(text) for text in texts]
        new = [p.encode() for p in islice(self.number, len(self.packed), None)]
        if new:
            self.packed.extend(ids.astype("<u4").tobytes() for ids in self.merge_words(new))
        packed = self.packed
        special = {-1 - i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        return [b"".join([packed[n] if n >= 0 else special[n] for n in row]) for row in numbers]

    def decode(self, packed: bytes) -> str:
        return " ".join(map(self.names.__getitem__, np.frombuffer(packed, "<u4").tolist()))


def _content(vocabulary: str) -> str:
    with open(vocabulary, encoding="utf-8") as file:
        return file.read()


_held: dict[int, WordBpe] = {}


def _coder(content: str) -> WordBpe:
    """One coder for each worker process: its tables are built once."""
    if hash(content) not in _held:
        _held.clear()
        _held[hash(content)] = WordBpe(content)
    return _held[hash(content)]


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """Adds ids (binary, little-endian unsigned 32-bit numbers) and n_tokens; with ``decoded`` also what ``bpe_decode`` makes of
    the ids, in the same pass and the same worker process.

    vocabulary: a vocabulary file in the JSON format of the tokenizers library, with word ends. The driver reads it
    (a few MB, of fixed size) and sends it out once. Texts are cut into words; the words of many texts that are new to a
    task are merged together: in each round every word's lowest-rank pair, found by binary search over the sorted pair keys.

    Null and empty texts have no ids (empty binary, 0); text that looks like a special token is encoded as that token, as
    the library does. Whole texts are encoded; a task holds about a million characters, or one longer text, at a time.
    Rows are handled one by one, so repeated rows and null ids need no rule; columns named ids and n_tokens (and decoded) are replaced, others carried along.
    """
    docs = docs.drop("ids", "n_tokens", *(["decoded"] if decoded else []))
    spec = docs.sparkSession.sparkContext.broadcast(_content(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec.value)
        for batch in batches:
            for rows, part in text_parts(batch, text, TEXT_CHARS):
                packed = coder.encode(part)
                back = [pa.array(map(coder.decode, packed), pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(packed, pa.binary()), pa.array([len(p) // 4 for p in packed], pa.int64()), *back],
                    names=[*rows.schema.names, "ids", "n_tokens", *(["decoded"] if decoded else [])],
                )

    added = ["cast('' as binary) ids", "cast(0 as bigint) n_tokens", *(["'' decoded"] if decoded else [])]
    return docs.mapInArrow(run, docs.selectExpr("*", *added).schema)


def bpe_decode(rows: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """Adds decoded: the names of the tokens of ids (packed as by ``bpe_encode``), with blanks between them.

    Null and empty ids give an empty text. Ids outside the vocabulary raise an error. A column named decoded is replaced.
    """
    rows = rows.drop("decoded")
    spec = rows.sparkSession.sparkContext.broadcast(_content(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(spec.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [coder.decode(p or b"") for p in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "decoded"])

    return rows.mapInArrow(run, rows.selectExpr("*", "'' decoded").schema)
