"""Token-ID output (operator 3): Arrow files of equal-length sequences with zero-copy random access.

Format. A data set is a folder of Arrow IPC files ``part-NNNNNN.arrow``. Each holds, in record batches of
``BATCH_ROWS`` rows, the columns ``ids`` (fixed-size list of ``seq_len`` uint16, or uint32 for vocabularies of over 65,536
ids) and ``mask`` (fixed-size list of ``seq_len`` bits: set for a token, clear for padding). All batches but the last of a file have
equally many rows, so row r of a file is row r % BATCH_ROWS of batch r // BATCH_ROWS, and a memory map gives it
without a copy. Documents run on across sequences; only the last sequence of a file is padded. Beside it,
``part-NNNNNN.docs.arrow`` has one row per document: ``doc_id``, ``start`` (offset in the file's tokens) and
``n_tokens``. Files follow each other in ascending doc_id order.

Documents are spread over files by ranges of doc_id (sampled by Spark; a very frequent doc_id stays in one file)
and sorted inside a file, null ids first, equal ids by text. Each task streams its range: it never holds more
than one batch of documents and ``BATCH_ROWS`` sequences. A file is written under a name of the attempt and then
moved, so retried or speculative tasks leave one whole file; what it holds does not depend on the attempt.

Empty and null texts give the end id alone. An empty table gives an empty data set.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recengine.llm.common import batches_of, new_path, table

SEQ_LEN = 2048
BATCH_ROWS = 256
END_ID = 0
#: Rough characters of text per output file.
CHARS_PER_FILE = 16 << 20
#: Pieces, and chunks, of one generation whose ids a worker keeps.
CACHE_PIECES, CACHE_CHUNKS = 100_000, 600_000

MANIFEST = "part long, file string, n_docs long, file_tokens long, n_rows long"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


class ChunkEncoder:
    """Ids of texts by the tokenizers library, with the ids of repeated pieces remembered.

    A byte-level BPE splits a text into pieces by a fixed pattern and merges inside each piece, so ids are looked up
    per piece and the library's model is asked for new pieces only. One step above, a text is cut before each single
    blank between two characters that are no white space: the pattern always begins a piece there, so the ids of
    such chunks are remembered too. Texts where white space meets a blank are split by the pattern alone. A tokenizer of another kind
    encodes whole texts, and so does any where a text holds the string of an added token, which the library takes as that token. With
    ``escape`` such strings are ordinary text.
    """

    def __init__(self, path: str, escape: bool = False):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = escape
        self.added = [] if escape else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = id_type(self.tokenizer.get_vocab_size())
        self.pieces = Remembered(self.model_ids, CACHE_PIECES)
        self.chunks = Remembered(self.chunk_ids, CACHE_CHUNKS)
        kind = json.loads(self.tokenizer.to_str())
        split = kind["pre_tokenizer"] or {}
        self.by_piece = (kind["normalizer"] is None and kind["model"]["type"] == "BPE" and split.get("type") == "ByteLevel"
                         and split.get("use_regex") and not split.get("add_prefix_space"))
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.byte_chars = byte_chars()

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def model_ids(self, piece: str) -> bytes:
        found = self.tokenizer.model.tokenize(piece.encode().decode("latin-1").translate(self.byte_chars))
        return np.array([t.id for t in found], self.dtype).tobytes()

    def chunk_ids(self, chunk: str) -> bytes:
        """Ids of a blank and the characters behind it."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            raise Uneven
        return self.by_pieces(" " + chunk)

    def by_pieces(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def __call__(self, text: str | None) -> bytes:
        """The ids of a text, as little-endian integers of ``dtype``."""
        if not text:
            return b""
        if not self.by_piece or any(t in text for t in self.added):
            return self.whole(text)
        rest = text.split(" ")
        if len(rest) == 1:
            return self.by_pieces(text)
        first, last = rest[0], rest.pop()
        if not first or first[-1].isspace() or not last or last[0].isspace():
            return self.by_pieces(text)
        try:
            inner = b"".join(map(self.chunks.__getitem__, islice(rest, 1, None)))
        except Uneven:
            return self.by_pieces(text)
        self.chunks.age()
        self.pieces.age()
        return self.by_pieces(first) + inner + self.by_pieces(" " + last)


class Uneven(Exception):
    """White space meets a blank."""


class Remembered(dict):
    """Values made when first asked for; of two generations of keys, the one not used for longer is forgotten."""

    def __init__(self, make, limit: int):
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def age(self) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()


def byte_chars() -> dict[int, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


@functools.lru_cache(1)
def encoder(path: str, escape: bool = False) -> ChunkEncoder:
    return ChunkEncoder(path, escape)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Hadoop-style URI (file:, hdfs:, s3:, ...) and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if uri.startswith("/"):
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def sequence_schema(seq_len: int, dtype: np.dtype) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), seq_len)), ("mask", pa.list_(pa.bool_(), seq_len))])


class SequenceWriter:
    """Writes a run of token ids as equal-length sequences, and the documents' places."""

    def __init__(self, fs: pafs.FileSystem, path: str, seq_len: int, dtype: np.dtype):
        self.fs, self.seq_len, self.dtype, self.rows, self.tokens = fs, seq_len, dtype, 0, 0
        self.sinks = [fs.open_output_stream(path), fs.open_output_stream(path.removesuffix(".arrow") + ".docs.arrow")]
        self.schema = sequence_schema(seq_len, dtype)
        self.data = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], DOCS)
        self.buffer, self.held = [], 0

    def add(self, doc_ids: list[int | None], ids: list[bytes]) -> None:
        """Appends documents; the ids come without the end id."""
        end = np.array([END_ID], self.dtype).tobytes()
        sizes = np.array([len(x) // self.dtype.itemsize + 1 for x in ids], np.int64)
        starts = self.tokens + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch([pa.array(doc_ids, pa.int64()), starts, sizes], schema=DOCS))
        flat = np.frombuffer(b"".join(x + end for x in ids), self.dtype)
        self.tokens += len(flat)
        self.buffer.append(flat)
        self.held += len(flat)
        block = self.seq_len * BATCH_ROWS
        if self.held >= block:
            flat = np.concatenate(self.buffer)
            whole = len(flat) // block * block
            for i in range(0, whole, block):
                self._write(flat[i:i + block], block)
            self.buffer, self.held = [flat[whole:].copy()], len(flat) - whole

    def _write(self, flat: np.ndarray, tokens: int) -> None:
        mask = np.arange(len(flat)) < tokens
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.seq_len) for x in (flat, mask)]
        batch = pa.record_batch(lists, schema=self.schema)
        self.data.write_batch(batch)
        self.rows += batch.num_rows

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.buffer)
            self._write(np.pad(flat, (0, -len(flat) % self.seq_len)), len(flat))
        for x in (self.data, self.docs, *self.sinks):
            x.close()


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, seq_len: int = SEQ_LEN, escape: bool = False) -> DataFrame:
    """Encodes ``docs`` (doc_id, text) and writes the data set; returns its manifest, a row per file. ``escape``: strings of added
    tokens are ordinary text.

    The manifest (part, file, n_docs, file_tokens, n_rows) is computed by the writing tasks, so persist or write it.
    """
    tokenizer = tokenizer or default_tokenizer()
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chars = d.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-chars // CHARS_PER_FILE))
    fs_uri = folder

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, root = filesystem(fs_uri)
        fs.create_dir(root, recursive=True)
        name, out, n = f"part-{part:06d}.arrow", None, 0
        draft = f"{root}/.attempt-{TaskContext.get().taskAttemptId()}-{name}"
        encode = encoder(tokenizer, escape)
        for b in batches_of(batches, 500):
            out = out or SequenceWriter(fs, draft, seq_len, encode.dtype)
            out.add(b["doc_id"].to_pylist(), [encode(x) for x in b["text"].to_pylist()])
            n += b.num_rows
        if out:
            out.close()
            for suffix in (".docs.arrow", ".arrow"):
                fs.move(draft.removesuffix(".arrow") + suffix, f"{root}/{name.removesuffix('.arrow')}{suffix}")
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [f"{fs_uri}/{name}"], "n_docs": [n],
                                              "file_tokens": [out.tokens], "n_rows": [out.rows]})

    return (d.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).mapInArrow(write, MANIFEST))


def open_ipc(uri: str) -> pa.RecordBatchFileReader:
    """Opens a file for random access, memory-mapped where the file system is local."""
    fs, path = filesystem(uri)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path))


def sequence(reader: pa.RecordBatchFileReader, row: int) -> tuple[np.ndarray, pa.Array]:
    """Ids (numpy) and mask (Arrow booleans) of one sequence of a file, as views of the file's bytes."""
    batch = reader.get_batch(row // BATCH_ROWS)
    n, i = batch["ids"].type.list_size, row % BATCH_ROWS
    ids, mask = (c.values.slice((c.offset + i) * n, n) for c in (batch["ids"], batch["mask"]))
    return ids.to_numpy(), mask


def read_documents(manifest: DataFrame) -> DataFrame:
    """Reads a data set back: a row (doc_id, start, n_tokens, ids_crc32) per document.

    ``start`` counts the ids of all documents before. The running sum over files is a window over the manifest alone
    (one small row per file).
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("base"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, base in zip(b["file"].to_pylist(), b["base"].to_pylist()):
                data = open_ipc(uri)
                docs = open_ipc(uri.removesuffix(".arrow") + ".docs.arrow")
                held, held_at, k = np.empty(0, data.schema.field("ids").type.value_type.to_pandas_dtype()), 0, 0
                for j in range(docs.num_record_batches):
                    d = docs.get_batch(j)
                    sums = []
                    for start, n in zip(d["start"].to_pylist(), d["n_tokens"].to_pylist()):
                        while held_at + len(held) < start + n:
                            more = data.get_batch(k)
                            flat = more["ids"].flatten().to_numpy()
                            held, held_at, k = np.concatenate([held[start - held_at:], flat]), start, k + 1
                        sums.append(zlib.crc32(held[start - held_at:start - held_at + n].astype("<u4")))
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": d["doc_id"], "start": pa.array(d["start"].to_numpy() + base),
                        "n_tokens": d["n_tokens"], "ids_crc32": pa.array(sums, pa.int64())})

    n = max(1, manifest.count())
    return (files.repartitionByRange(n, "base", "file").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_output(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None,
                 seq_len: int = SEQ_LEN, escape: bool = False) -> DataFrame:
    """Writes the data set (a new folder in the shared folder by default) and reads its documents back."""
    spark = docs.sparkSession
    folder = (folder or new_path(spark, "tokens")).rstrip("/")
    write_tokens(docs, folder, tokenizer, seq_len, escape).write.parquet(f"{folder}/manifest")
    return read_documents(spark.read.parquet(f"{folder}/manifest"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))
