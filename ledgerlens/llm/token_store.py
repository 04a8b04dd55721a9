"""Token ids in Arrow files of equal-length sequences.

Documents are range-partitioned and sorted by doc_id; every partition streams
its tokens into one Arrow IPC file (the stream format with a footer, so any
batch can be reached by number) whose batches hold fixed-size lists: ``ids``
(the narrowest unsigned type the vocabulary fits) and ``mask`` (a bit each, set on
real tokens; only the last sequence of a file has padding). Sequence ``i`` of a file
is a slice of batch ``i // BATCH_SEQUENCES``: a memory-mapped read copies
nothing. A small Parquet table tells where each document's tokens lie. Files
carry a random name and count only once the task's row set is committed, so a
repeated task leaves an orphan at worst.

Tokens come from the tokenizers library. Its pieces never cross white space, so
each distinct word between ASCII white space is encoded once for a chunk of many
texts; the ids of words and of their parts are kept in bounded caches.

Defined cases: null text counts as empty and has the end id only; rows with
equal ids are ordered by text, a null id comes first; an empty table gives no
file and an empty result; other columns are ignored. Special-token strings in
a text are what the library makes of them: their own ids.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunks, id_text, id_type, scratch, stored

SEQUENCE = 512           # tokens of a sequence
BATCH_SEQUENCES = 256    # sequences of a record batch
CACHE_WORDS = 200_000    # words kept per worker (and those of one more chunk)
CACHE_PIECES = 800_000   # the same of word parts
CHUNK_BYTES = 8 << 20    # of text encoded at once
END_ID = 1
RANGE_CHARS = 100         # of a text that take part in its range


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Ids of words, learnt when a word is first asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class WordEncoder:
    """Ids of texts as little-endian unsigned integers, word by word.

    A word of LETTERS with marks after it is two pieces for the library: the
    letters, which its normaliser only lower-cases one by one (none of them
    composes with another), and the marks. Both are given to the library's model
    directly. Every other word goes to the library whole and unchanged, also one
    that holds a special-token string."""

    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark already runs a task per core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.words = _Words(self._word)    # those that go to the library whole
        self.pieces = _Words(self._piece)  # letters and marks
        self.simple = f"^(?P<letters>[{self.LETTERS}]+)(?P<marks>[.,!?;:]*)$"
        # how the library writes each small letter for its model
        letters = [chr(c) for c in range(ord("a"), 0x100) if re.match(f"[{self.LETTERS}]", chr(c))]
        self.written = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})

    def _pack(self, ids) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, piece: bytes) -> bytes:
        return self._pack([t.id for t in self.tokenizer.model.tokenize(piece.decode().translate(self.written))])

    def _word(self, word: bytes) -> bytes:
        return self._pack(self.tokenizer.encode(word.decode(), add_special_tokens=False).ids)

    @staticmethod
    def _look_up(cache: _Words, words: pa.Array) -> pa.Array:
        """Ids of every word (without white space); null for a null one. Each distinct word is looked up once."""
        found = words.dictionary_encode()
        if not len(found.dictionary):
            return pa.nulls(len(words), pa.large_binary())
        kind = pa.large_binary() if pa.types.is_large_string(words.type) else pa.binary()
        whole = pa.ListArray.from_arrays(pa.array([0, len(found.dictionary)], pa.int32()), found.dictionary.cast(kind))
        distinct = pc.binary_join(whole, pa.scalar(b" ", kind))[0].as_py().split(b" ")
        return pa.array(list(map(cache.__getitem__, distinct)), pa.large_binary()).take(found.indices)

    def _distinct(self, words: pa.Array) -> pa.Array:
        parts = pc.extract_regex(words, self.simple)
        letters, marks = parts.flatten()  # null for words of another form
        ids = pc.binary_join_element_wise(self._look_up(self.pieces, pc.utf8_lower(letters)),
                                          self._look_up(self.pieces, marks), pa.scalar(b"", pa.large_binary()))
        other = parts.is_null()
        return pc.replace_with_mask(ids, other, self._look_up(self.words, words.filter(other)))

    def encode_rows(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many of them each text has."""
        for cache, most in ((self.words, CACHE_WORDS), (self.pieces, CACHE_PIECES)):
            if len(cache) > most:  # the older half goes
                left = list(islice(cache.items(), len(cache) // 2, None))
                cache.clear()
                cache.update(left)
        split = pc.ascii_split_whitespace(texts)  # an empty word, as before leading white space, has no ids
        found = split.flatten().dictionary_encode()
        taken = self._distinct(found.dictionary).take(found.indices)
        ends = np.frombuffer(taken.buffers()[1], np.int64)[:len(taken) + 1]
        ids = np.frombuffer(taken.buffers()[2] or b"", np.uint8)[:ends[-1]].view(self.dtype)
        offsets = split.offsets.to_numpy()
        return ids, np.diff(ends[offsets - offsets[0]]) // self.dtype.itemsize

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not texts:
            return []
        ids, counts = self.encode_rows(pa.array(texts, pa.binary()).cast(pa.string()))
        return [part.tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------ files
def file_system(uri: str):
    """Arrow file system and path of a URI as Spark writes it."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class SequenceWriter:
    """Packs a token stream into fixed-size-list batches of one file."""

    def __init__(self, uri: str, dtype: np.dtype, sequence: int):
        self.values = pa.from_numpy_dtype(dtype)
        self.dtype, self.sequence = dtype, sequence
        self.schema = pa.schema([("ids", pa.list_(self.values, sequence)), ("mask", pa.list_(pa.bool_(), sequence))])
        fs, path = file_system(uri)
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        self.out = fs.open_output_stream(path)
        self.writer = pa.ipc.new_file(self.out, self.schema)
        self.waiting: list[np.ndarray] = []
        self.held = self.total = 0

    def write(self, ids: np.ndarray) -> None:
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        size = self.sequence * BATCH_SEQUENCES
        if self.held >= size:
            flat = np.concatenate(self.waiting)
            whole = len(flat) // size * size
            for a in range(0, whole, size):
                self._batch(flat[a:a + size], size)
            self.waiting, self.held = [flat[whole:]], len(flat) - whole

    def _batch(self, flat: np.ndarray, real: int) -> None:
        mask = np.zeros(len(flat), bool)
        mask[:real] = True
        self.writer.write_batch(pa.RecordBatch.from_arrays(
            [pa.FixedSizeListArray.from_arrays(pa.array(flat, self.values), self.sequence),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), self.sequence)], schema=self.schema))

    def close(self) -> None:
        if self.held:
            flat = np.concatenate(self.waiting)
            padded = np.zeros(-(-len(flat) // self.sequence) * self.sequence, self.dtype)
            padded[:len(flat)] = flat
            self._batch(padded, len(flat))
        self.writer.close()
        self.out.close()


class SequenceFile:
    """Random access to one file; the arrays are views of the mapped file."""

    def __init__(self, uri: str):
        fs, path = file_system(uri)
        local = fs.type_name == "local"
        self.source = pa.memory_map(path) if local else fs.open_input_file(path)
        self.reader = pa.ipc.open_file(self.source)
        self.sequence = self.reader.schema.field("ids").type.list_size

    def _flat(self, batch: int, column: str) -> pa.Array:
        return self.reader.get_batch(batch).column(column).flatten()

    def sequence_at(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of the ``i``-th sequence; both are views of the mapped
        file (the mask as an Arrow array, whose values are bits)."""
        batch, at = divmod(i, BATCH_SEQUENCES)
        row = slice(at * self.sequence, (at + 1) * self.sequence)
        return self._flat(batch, "ids").to_numpy()[row], self._flat(batch, "mask").slice(row.start, self.sequence)

    def tokens(self, start: int, count: int) -> Iterator[np.ndarray]:
        """Views of ``count`` tokens from position ``start``, batch by batch."""
        size = self.sequence * BATCH_SEQUENCES
        while count > 0:
            batch, at = divmod(start, size)
            part = self._flat(batch, "ids").to_numpy()[at:at + count]
            yield part
            start, count = start + len(part), count - len(part)

    def close(self) -> None:
        self.source.close()


# -------------------------------------------------------------- operators
def write(docs: DataFrame, path: str, tokenizer: str | None = None, sequence: int = SEQUENCE,
          end_id: int | None = END_ID) -> DataFrame:
    """Encode ``docs`` and write the files under ``path`` in ascending doc_id
    order. Returns the (stored) table of documents: doc_id, part, file, pos
    (the tokens before it in its file), n_tokens, start (those in all files)."""
    model = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, out = TaskContext.get().partitionId(), None
        enc = encoder(model)
        name = f"{path.rstrip('/')}/tokens-{part:06d}-{uuid.uuid4().hex[:8]}.arrow"
        try:
            for doc, text in chunks(batches, CHUNK_BYTES):
                out = out or SequenceWriter(name, enc.dtype, sequence)
                ids, count = enc.encode_rows(text)
                if end_id is not None:
                    ids, count = np.insert(ids, np.cumsum(count), end_id), count + 1
                pos = out.total + np.cumsum(count) - count
                out.write(ids)
                n = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array([part] * n, pa.int32()), pa.array([name] * n), pa.array(pos, pa.int64()),
                     pa.array(count, pa.int64())], names=["doc_id", "part", "file", "pos", "n_tokens"])
        finally:
            if out:
                out.close()

    # rows of one id (or none) are spread by the start of their texts, in the same order
    ordered = (id_text(docs).repartitionByRange("doc_id", F.substring("text", 1, RANGE_CHARS))
               .sortWithinPartitions("doc_id", "text"))
    rows = stored(ordered.mapInArrow(
        run, f"doc_id {id_type(docs)}, part int, file string, pos bigint, n_tokens bigint"), "token-index")
    # One row per file: a window over them is bounded by the number of partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (rows.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
             .select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before")))
    return rows.join(F.broadcast(parts), "part").withColumn("start", F.col("before") + F.col("pos")).drop("before")


def read_back(index: DataFrame) -> DataFrame:
    """Read every document's tokens from the files: doc_id, start, n_tokens,
    ids_crc32 (over the ids as little-endian unsigned 32-bit integers)."""
    doc = id_type(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, name = None, None
        for b in batches:
            crcs, lengths = [], []
            for file, pos, n in zip(b.column("file").to_pylist(), b.column("pos").to_pylist(),
                                    b.column("n_tokens").to_pylist()):
                if file != name:
                    if opened:
                        opened.close()
                    opened, name = SequenceFile(file), file
                crc = length = 0
                for part in opened.tokens(pos, n):
                    crc = zlib.crc32(part.astype("<u4"), crc)
                    length += len(part)
                crcs.append(crc)
                lengths.append(length)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (index.select("doc_id", "start", "file", "pos", "n_tokens")
            .mapInArrow(run, f"doc_id {doc}, start bigint, n_tokens bigint, ids_crc32 bigint"))


def write_and_check(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to a new folder of the shared store and read it back."""
    return read_back(write(docs, scratch(docs.sparkSession, "tokens"), tokenizer))
