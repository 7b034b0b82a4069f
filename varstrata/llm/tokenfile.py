"""Flat files of token ids with offsets: written in order by many tasks, read by memory maps."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varstrata.llm.groups import text_parts
from varstrata.plans.runtime import scratch_path, written

END_ID = 1
FILE_TOKENS = 1 << 26  # a file ends with the document that reaches so many tokens, or so many documents
FILE_DOCS = 1 << 20
TEXT_CHARS = 2_000_000  # encoded at once; a longer text alone
READ_TOKENS = 1 << 20  # given out at once; a longer document alone
CACHED_PIECES = 1_000_000
# fixed values of the vocabulary's format: its pieces, for texts of these letters and white space only
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile(r"[\t-\r -~À-ÿ]*")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9\t-\r ]+")
_SPECIAL = "<|"
_WORD_END = "</w>"


class WordCoder:
    """The tokenizers library over pieces that are new; what is known is looked up.

    A vocabulary with word ends encodes piece by piece. Texts are cut into the vocabulary's pieces if their letters make that safe. Other texts, and any that may hold a special token,
    are cut at the white space of ASCII, which no piece and no normal form goes over, and the chunks that are not safe go to the library whole.
    """

    def __init__(self, content: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab()
        size = max([END_ID, *vocabulary.values()]) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.ends = np.zeros(size, bool)
        for name, i in vocabulary.items():
            self.ends[i] = name.endswith(_WORD_END)
        self.pieces: dict[str, bytes] = {}

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _cut(self, text: str) -> list[str]:
        """The pieces of a text, in lower case; chunks that have to be encoded whole begin with a blank, as no piece does."""
        if _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return _PIECE.findall(text.lower())
        out = []
        for chunk in text.encode().split():
            part = chunk.decode()
            if _PLAIN.fullmatch(part) and _SPECIAL not in part:
                out += _PIECE.findall(part.lower())
            else:
                out.append(" " + part)
        return out

    def _learn(self, new: list[str]) -> None:
        whole = [p for p in new if p[0] == " "]
        for low in range(0, len(whole), 1000):
            some = whole[low : low + 1000]
            coded = self.tokenizer.encode_batch_fast([p[1:] for p in some], add_special_tokens=False)
            self.pieces.update((p, self._packed(x.ids)) for p, x in zip(some, coded, strict=True))
        single = [p for p in new if p[0] != " "]
        for low in range(0, len(single), 1000):
            some = single[low : low + 1000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, self.dtype)
            cuts = (self.dtype.itemsize * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            flat = ids.tobytes()
            self.pieces.update((p, flat[a:b]) for p, a, b in zip(some, [0, *cuts[:-1]], cuts, strict=True))

    def encode(self, texts: list[str], end: int | None = END_ID) -> list[bytes]:
        """Ids of each text, and after them ``end``, as little-endian numbers of the smallest type that holds all ids."""
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {}
        cut = [self._cut(text) for text in texts]
        new = set().union(*cut).difference(self.pieces)
        if new:
            self._learn(list(new))
        tail = b"" if end is None else self._packed([end])
        known = self.pieces.__getitem__
        return [b"".join(map(known, pieces)) + tail for pieces in cut]


_held: dict[int, WordCoder] = {}


def _coder(content: str) -> WordCoder:
    """One for each worker process, so that words are learned once."""
    if hash(content) not in _held:
        _held.clear()
        _held[hash(content)] = WordCoder(content)
    return _held[hash(content)]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class _Writer:
    """The files of one task: ``.bin`` the ids, ``.idx`` 64-bit offsets of the documents and the end, ``.doc`` 64-bit ids and a byte each, 0 for null."""

    def __init__(self, uri: str, dtype: np.dtype, tokens: int, docs: int):
        self.fs, self.path = _place(uri)
        self.tokens, self.docs = tokens, docs
        self.fs.create_dir(self.path, recursive=True)
        self.dtype = dtype
        self.part = TaskContext.get().partitionId()
        self.seq = -1
        self._open()

    def _open(self) -> None:
        self.seq += 1
        # an attempt's own name: the files that count are those that the manifest names
        self.name = f"part-{self.part:06d}-{self.seq:04d}-{uuid.uuid4().hex}"
        self.out, self.offsets, self.ids = None, [0], []

    def add(self, id: int | None, packed: bytes) -> tuple | None:
        if self.out is None:
            self.out = self.fs.open_output_stream(f"{self.path}/{self.name}.bin")
        self.out.write(packed)
        self.offsets.append(self.offsets[-1] + len(packed) // self.dtype.itemsize)
        self.ids.append(id)
        return self.close() if self.offsets[-1] >= self.tokens or len(self.ids) >= self.docs else None

    def close(self) -> tuple | None:
        if self.out is None:
            return None
        self.out.close()
        with self.fs.open_output_stream(f"{self.path}/{self.name}.idx") as out:
            out.write(np.array(self.offsets, "<u8").tobytes())
        with self.fs.open_output_stream(f"{self.path}/{self.name}.doc") as out:
            out.write(np.array([i or 0 for i in self.ids], "<i8").tobytes())
            out.write(np.array([i is not None for i in self.ids], "u1").tobytes())
        told = (self.part, self.seq, self.name, self.dtype.itemsize, len(self.ids), self.offsets[-1])
        self._open()
        return told


MANIFEST = "part int, seq int, name string, width int, n_docs bigint, n_tokens bigint"


def write_tokens(
    docs: DataFrame, vocabulary: str, path: str | None = None, id: str = "doc_id", text: str = "text", end: int | None = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> str:
    """Encode whole texts and write their ids, ascending by ``id``, to files under ``path`` (default: in the shared folder); returns the path.

    ``{path}/manifest`` is a table of the files in order: name, width (bytes of an id), n_docs, n_tokens and base, the tokens of all files before it. ``{name}.bin``
    holds the ids one after the other, unsigned and little-endian, 2 bytes each if the vocabulary allows, else 4; ``{name}.idx`` n_docs + 1 unsigned 64-bit offsets into it, in tokens;
    ``{name}.doc`` the documents' ids as 64-bit numbers, then a byte for each, 0 where the id is null. path is a folder that all executors reach, as a plain path or with a scheme that pyarrow knows.

    How: texts are dealt by ranges of ``id``; each task encodes its range in order, by the tokenizers library, and writes it to files of bounded size as rows come. So texts are shuffled
    once, ids never. Files' names are their attempt's own, and the manifest, written by Spark, names those that count, so that lost or doubled attempts leave no trace in it. The bases are prefix sums over the
    manifest: one row for each file. Columns other than the two are not read.

    Nulls: a null text is empty; an empty text has the end id alone (nothing, if ``end`` is None). Null ids come first. Rows of equal id are all written, in the order of a hash of
    their texts; many of them may go over several files. A text of any length is one document, never cut. An empty table makes an empty manifest. ``id`` must be an integer column.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()  # a few MB, of fixed size
    dtype = WordCoder(content).dtype
    spec = spark.sparkContext.broadcast(content)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(files: list[tuple]) -> pa.RecordBatch:
            types = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            names = [field.split()[0] for field in MANIFEST.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*files, strict=True), types, strict=True)], names=names)

        coder, writer = _coder(spec.value), None
        for batch in batches:
            writer = writer or _Writer(path, dtype, file_tokens, FILE_DOCS)
            for rows, texts in text_parts(batch, "text", TEXT_CHARS):
                for id, packed in zip(rows.column("id").to_pylist(), coder.encode(texts, end), strict=True):
                    file = writer.add(id, packed)
                    if file:
                        yield told([file])
        file = writer.close() if writer else None
        if file:
            yield told([file])

    numbered = docs.select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"))
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("row")]
    dealt = numbered.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    files = written(dealt.mapInArrow(write, MANIFEST), "files")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    files.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0))).write.parquet(f"{path}/manifest")
    return path


def _bytes(where: fs.FileSystem, path: str) -> np.ndarray | pa.NativeFile:
    """A file's bytes: mapped, if it is on a local or mounted disk, else a file to read ranges of."""
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    return where.open_input_file(path)


def _part(source: np.ndarray | pa.NativeFile, low: int, high: int) -> np.ndarray:
    if isinstance(source, np.ndarray):
        return source[low:high]
    return np.frombuffer(source.read_at(high - low, low), np.uint8)


def read_tokens(spark: SparkSession, path: str, id: str = "doc_id", together: int = READ_TOKENS) -> DataFrame:
    """(id, start, n_tokens, ids): the documents of :func:`write_tokens`, from its files.

    start counts the tokens of all documents before; ids are little-endian unsigned 32-bit numbers. Each file is a task's row and is mapped to memory; documents of about ``together`` tokens are given out at a
    time. A document without tokens has empty ids; a null id is null again; an empty manifest gives no rows.
    """
    files = spark.read.parquet(f"{path}/manifest")
    n_files = files.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, folder = _place(path)
        for batch in batches:
            for file in batch.to_pylist():
                n, width, stem = file["n_docs"], file["width"], f"{folder}/{file['name']}"
                index, docs = _bytes(where, f"{stem}.idx"), _bytes(where, f"{stem}.doc")
                flat = _bytes(where, f"{stem}.bin") if file["n_tokens"] else np.zeros(0, np.uint8)
                low = 0
                while low < n:
                    high = min(n, low + 8192)
                    offsets = _part(index, 8 * low, 8 * (high + 1)).view("<u8").astype(np.int64)
                    high = low + max(1, int(np.searchsorted(offsets, offsets[0] + together, "right")) - 1) if offsets[-1] - offsets[0] > together else high
                    offsets = offsets[: high - low + 1]
                    ids = _part(flat, width * int(offsets[0]), width * int(offsets[-1])).view(f"<u{width}").astype("<u4")
                    known = _part(docs, 8 * low, 8 * high).view("<i8")
                    valid = _part(docs, 8 * n + low, 8 * n + high) == 0
                    cuts = (4 * (offsets - offsets[0])).astype(np.int64)
                    packed = pa.Array.from_buffers(pa.large_binary(), high - low, [None, pa.py_buffer(cuts), pa.py_buffer(ids)]).cast(pa.binary())
                    columns = [pa.array(known, pa.int64(), mask=valid), pa.array(file["base"] + offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64()), packed]
                    yield pa.RecordBatch.from_arrays(columns, names=[id, "start", "n_tokens", "ids"])
                    low = high

    return files.repartition(max(1, n_files)).mapInArrow(read, f"`{id}` bigint, start bigint, n_tokens bigint, ids binary")
