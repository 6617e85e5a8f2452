"""Token ids in seekable files of independent zstandard frames.

File format, readable by any zstandard tool: frames one after another, each a
complete zstandard stream of its own; then one skippable frame (magic
0x184D2A5E) with a 12-byte entry per frame (compressed size, size, low 32 bits of
the content's xxh64; little-endian unsigned 32) and a 9-byte footer: number of
frames, a descriptor byte (0x80: entries have checksums) and 0x8F92EAB1. A
frame's content is: number of documents n; n doc_ids (signed 64, or the lowest
value for null); n token counts (unsigned 32); then all ids (unsigned 32).
A reader of some documents fetches the seek table and the frames they are in,
which the manifest's first and last doc_id of each frame tell.

Writing range-partitions documents by doc_id, one file per partition, so that
files and frames follow the order of ids; a file is written under a temporary
name and renamed when it is complete, so a task that runs again leaves no half
file, and the manifest names the file of the attempt that counted. Files go
through pyarrow's file systems to the scratch folder of the session.

Defined results: null and empty texts are documents of one id, the end id; a
null doc_id comes first; rows that share a doc_id are ordered by a hash of
their text; an empty table gives no files and an empty result; a document that
was asked for and is not there has no row. Words are looked up by 64-bit hashes.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridpanel.llm import textkit
from gridpanel.llm.common import stage
from gridpanel.scratch import open_folder as _open
from gridpanel.scratch import scratch_path

#: Fixed values of the seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
DESCRIPTOR = 0x80

NULL_ID = -(1 << 63)
FRAME_IDS = 1 << 18
CACHE_WORDS = 1_000_000
CACHE_PARTS = 350_000
CHUNK_BYTES = 1 << 20
_ENTRY = struct.Struct("<III")
_FOOTER = struct.Struct("<IBI")
#: Signs that part from a word before them; the apostrophe is not one of them.
_TAIL = ".,!?:;|"


class Encoder:
    """Ids of whole texts; words seen before come from a bounded table.

    A byte-level pre-tokenizer never joins what a single space between two
    non-spaces parts, nor what a single line break parts, nor a word and the
    signs behind it. So a text is the concatenation of its words, each with its
    space before it. The words of a batch are cut and hashed as one byte array,
    its distinct new words are sent to the tokenizer's model one by one, and all
    ids are gathered at once. Texts that use spaces in any other way, or hold a
    special token's string, and tokenizers of another kind, are encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        made = json.loads(self.tokenizer.to_str())
        steps = made["pre_tokenizer"] or {}
        self.by_word = steps.get("type") == "ByteLevel" and steps.get("use_regex") and not steps.get("add_prefix_space") and not (made["normalizer"] or made["post_processor"])
        self.by_word = self.by_word and made["model"]["type"] == "BPE" and not any(made["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        # The byte-level alphabet: printable bytes stand for themselves, the others for signs from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        self.alphabet = {b: 256 + k for k, b in enumerate(others)}
        self.space = chr(self.alphabet[32])
        self.parts: dict[str, bytes] = {}
        self._forget()

    def _forget(self) -> None:
        """Empties the table: sorted word hashes, and for each where its ids lie in the pool (length -1: text to be encoded whole)."""
        self.hashes = np.zeros(0, np.uint64)
        self.begin = self.length = np.zeros(0, np.int32)
        self.pool = np.zeros(0, np.uint32)

    def encode(self, raw: np.ndarray, at: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each with end_id behind it, and their numbers; texts are raw[at[i]:at[i + 1]]."""
        text = raw.tobytes()
        whole = np.zeros(len(at) - 1, bool)
        if not self.by_word:
            whole[:] = True
        elif any(s.encode() in text for s in self.special):
            whole[:] = [any(s.encode() in text[a:b] for s in self.special) for a, b in zip(at[:-1], at[1:], strict=True)]
        heads = raw == 32
        heads[at[:-1][at[1:] > at[:-1]]] = True
        starts = np.flatnonzero(heads)
        ends = np.append(starts[1:], len(raw))
        first = np.searchsorted(starts, at)
        begin, length = self._places(text, starts, ends, ~whole[textkit.row_of(first)])
        whole |= textkit.per_row(length < 0, first) > 0
        # the words of whole texts give way to one entry at the pool's end
        kept = ~whole[textkit.row_of(first)]
        extra = [np.frombuffer(self._plain(text[at[i] : at[i + 1]].decode()), "<u4") for i in np.flatnonzero(whole)]
        if end_id is not None:
            extra.append(np.array([end_id], np.uint32))
        pool = np.concatenate([self.pool, *extra])
        sizes = np.array([len(e) for e in extra], np.int64)
        places = len(self.pool) + np.cumsum(sizes) - sizes
        words = np.diff(np.concatenate([[0], np.cumsum(kept)])[first]) if len(first) else np.zeros(0, np.int64)
        ahead = np.cumsum(words)
        begin, length = begin[kept], length[kept]
        n = int(whole.sum())
        begin, length = np.insert(begin, ahead[whole], places[:n]), np.insert(length, ahead[whole], sizes[:n])
        ahead = np.cumsum(words + whole)
        if end_id is not None:
            begin, length = np.insert(begin, ahead, places[-1]), np.insert(length, ahead, 1)
            ahead = np.cumsum(words + whole + 1)
        total = np.concatenate([[0], np.cumsum(length)])
        ids = pool[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        return ids, np.diff(total[np.concatenate([[0], ahead])])

    def _places(self, text: bytes, starts: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each word's ids lie in the pool, and how many there are; words not seen before are encoded first."""
        if len(self.hashes) >= CACHE_WORDS:
            self._forget()
        hashes = textkit.Hasher(np.frombuffer(text, np.uint8), lower=False).ranges(starts, ends)
        local, distinct = pd.factorize(hashes)
        asked = np.zeros(len(distinct), bool)
        asked[local[wanted]] = True
        one = np.zeros(len(distinct), np.int64)
        one[local[::-1]] = np.arange(len(local))[::-1]
        at = np.searchsorted(self.hashes, distinct)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == distinct[known]
        new = np.flatnonzero(asked & ~known)
        if len(new):
            made = [self._unit(text[a:b].decode()) for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)]
            sizes = np.array([-1 if m is None else len(m) // 4 for m in made], np.int64)
            room = np.maximum(sizes, 0)
            begin = len(self.pool) + np.cumsum(room) - room
            self.pool = np.concatenate([self.pool, np.frombuffer(b"".join(m for m in made if m), np.uint32)])
            # put in their places one array at a time: the table is large and each worker has its own
            order = np.argsort(distinct[new], kind="stable")
            place = np.searchsorted(self.hashes, distinct[new][order])
            self.hashes = np.insert(self.hashes, place, distinct[new][order])
            self.begin = np.insert(self.begin, place, begin[order])
            self.length = np.insert(self.length, place, sizes[order])
            at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        if not len(self.hashes):
            return np.zeros(len(local), np.int64), np.zeros(len(local), np.int64)
        at = np.minimum(at, len(self.hashes) - 1)
        begin, length = self.begin[at].astype(np.int64), self.length[at].astype(np.int64)
        return np.where(wanted, begin[local], 0), np.where(wanted, length[local], 0)

    def _unit(self, unit: str) -> bytes | None:
        """A word with its space; None if its text has to be encoded as a whole."""
        body = unit[1:] if unit[:1] == " " else unit
        if not body or body[0].isspace() or body[-1].isspace():
            return None
        if "\n" not in unit:
            return self._piece(unit)
        lines = unit.split("\n")
        if any(not x or x[-1].isspace() or (k and x[0].isspace()) for k, x in enumerate(lines)):
            return self._plain(unit)
        return self._part("\n").join(map(self._piece, lines))

    def _piece(self, piece: str) -> bytes:
        word = piece.rstrip(_TAIL)
        if len(word) < len(piece) and word and word[-1].isalnum():
            return self._part(word) + self._part(piece[len(word) :])
        return self._part(piece)

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            letters = part[1:] if part[:1] == " " else part
            if letters.isalpha() and max(letters) < "\u0250":
                if letters.isascii():  # stand for themselves
                    symbols = part.replace(" ", self.space)
                else:
                    symbols = part.encode().decode("latin-1").translate(self.alphabet)
                ids = array("I", [t.id for t in self.model.tokenize(symbols)]).tobytes()
            else:
                ids = self._plain(part)
            if len(self.parts) >= CACHE_PARTS:
                self.parts.clear()
            self.parts[part] = ids
        return ids

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def frame(doc_ids: np.ndarray, counts: np.ndarray, tokens: np.ndarray) -> bytes:
    """doc_ids (NULL_ID for null), token counts and the ids of all."""
    return struct.pack("<I", len(doc_ids)) + doc_ids.astype("<i8").tobytes() + counts.astype("<u4").tobytes() + tokens.astype("<u4").tobytes()


def read_frame(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, token counts, all ids."""
    (n,) = struct.unpack_from("<I", content)
    ids = np.frombuffer(content, "<i8", n, 4)
    counts = np.frombuffer(content, "<u4", n, 4 + 8 * n)
    return ids, counts, np.frombuffer(content, "<u4", offset=4 + 12 * n)


class Writer:
    """Frames to one open stream; close() adds the seek table."""

    def __init__(self, stream):
        self.stream, self.entries = stream, []
        self.compressor = zstandard.ZstdCompressor(level=3)

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, tokens: np.ndarray) -> int:
        """Write one frame; its number."""
        content = frame(doc_ids, counts, tokens)
        packed = self.compressor.compress(content)
        self.stream.write(packed)
        self.entries.append((len(packed), len(content), xxhash.xxh64_intdigest(content) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def close(self) -> None:
        table = b"".join(_ENTRY.pack(*e) for e in self.entries) + _FOOTER.pack(len(self.entries), DESCRIPTOR, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class Reader:
    """Random access to one token file (an open, seekable stream)."""

    def __init__(self, stream, size: int):
        self.stream = stream
        stream.seek(size - _FOOTER.size)
        frames, descriptor, magic = _FOOTER.unpack(stream.read(_FOOTER.size))
        if magic != SEEKABLE_MAGIC or descriptor != DESCRIPTOR:
            raise ValueError("not a seekable zstandard file")
        stream.seek(size - _FOOTER.size - frames * _ENTRY.size)
        table = stream.read(frames * _ENTRY.size)
        self.entries = [_ENTRY.unpack_from(table, k * _ENTRY.size) for k in range(frames)]
        self.starts = np.concatenate([[0], np.cumsum([e[0] for e in self.entries])]).astype(np.int64)

    def content(self, k: int) -> bytes:
        """Frame k, checked against its size and checksum."""
        packed, size, checksum = self.entries[k]
        self.stream.seek(int(self.starts[k]))
        content = zstandard.ZstdDecompressor().decompress(self.stream.read(packed), max_output_size=size)
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {k} is damaged")
        return content


MANIFEST = "file int, path string, frame int, documents long, tokens long, first_doc long, last_doc long"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, frame_ids: int = FRAME_IDS) -> DataFrame:
    """Encode and write all documents; the manifest, one row per frame: file, path, frame, documents, tokens, first_doc, last_doc.

    Files are numbered in the order of doc_id; first_doc and last_doc are NULL_ID
    for null. A frame is closed when it has frame_ids ids. The manifest is
    written, so the files are complete when this returns.
    """
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ordered = texts.withColumn("_tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").select("doc_id", "text")

    def write(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        store, root = _open(folder)
        name = f"{number:06d}-{uuid.uuid4().hex}.zst"
        writer, rows = None, []
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)]
        encode = encoder(tokenizer).encode

        def close_frame(documents: int, tokens: int) -> None:
            own = [held[0][:documents], held[1][:documents], held[2][:tokens]]
            rows.append((writer.add(*own), documents, tokens, int(own[0][0]), int(own[0][-1])))
            held[:] = [held[0][documents:], held[1][documents:], held[2][tokens:]]

        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))
            for a, b, raw, at in textkit.chunks(batch, CHUNK_BYTES):
                if writer is None:
                    store.create_dir(root, recursive=True)
                    stream = store.open_output_stream(f"{root}/_{name}", compression=None)
                    writer = Writer(stream)
                tokens, counts = encode(raw, at, end_id)
                held = [np.concatenate([x, y]) for x, y in zip(held, (ids[a:b], counts, tokens), strict=True)]
                ends = np.cumsum(held[1])
                done = 0
                while len(ends) and ends[-1] - done >= frame_ids:
                    last = int(np.searchsorted(ends, done + frame_ids))
                    close_frame(last + 1 - (len(ends) - len(held[0])), int(ends[last]) - done)
                    done = int(ends[last])
        if writer is None:
            return
        if len(held[0]):
            close_frame(len(held[0]), len(held[2]))
        writer.close()
        stream.close()
        store.move(f"{root}/_{name}", f"{root}/{name}")
        n = len(rows)
        columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([number] * n, pa.int32()), pa.array([f"{root}/{name}"] * n), columns[0].cast(pa.int32()), *columns[1:]], ["file", "path", "frame", "documents", "tokens", "first_doc", "last_doc"])

    return stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with start, the number of ids before each frame: over files, then inside each file."""
    files = manifest.groupBy("file").agg(F.sum("tokens").alias("_all"))
    before = files.select("file", (F.sum("_all").over(Window.orderBy("file")) - F.col("_all")).alias("_before"))
    inside = F.sum("tokens").over(Window.partitionBy("file").orderBy("frame")) - F.col("tokens")
    return manifest.withColumn("_inside", inside).join(before, "file").withColumn("start", F.col("_before") + F.col("_inside")).drop("_inside", "_before")


def _asked(manifest: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """file, frame, wanted (sorted ids): the frames that may hold the documents asked for.

    Files follow the order of doc_id, so an id finds its file among their borders
    (one row per file that was written); frames are met by an equi-join inside it.
    """
    # one row per partition of the write, whatever the data
    borders = manifest.groupBy("file").agg(F.min("first_doc").alias("low"), F.max("last_doc").alias("high")).orderBy("file").collect()
    files, low, high = (np.array([r[k] for r in borders], np.int64) for k in ("file", "low", "high"))

    def find(batches):
        for batch in batches:
            ids = np.asarray(batch.column("doc_id").fill_null(NULL_ID))
            first, end = np.searchsorted(high, ids, "left"), np.searchsorted(low, ids, "right")
            counts = np.maximum(end - first, 0)
            place = np.repeat(first, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays([pa.array(files[place], pa.int32()), pa.array(np.repeat(ids, counts))], ["file", "id"])

    ids = doc_ids.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().mapInArrow(find, "file int, id long")
    met = manifest.select("file", "frame", "first_doc", "last_doc").join(ids, "file").where("id between first_doc and last_doc")
    return met.groupBy("file", "frame").agg(F.sort_array(F.collect_set("id")).alias("wanted"))


def read_documents(spark: SparkSession, manifest: DataFrame, folder: str | None = None, doc_ids: DataFrame | None = None, with_ids: bool = False) -> DataFrame:
    """Documents read back from their frames: doc_id, start, n_tokens, ids_crc32, and ids (array) if asked for.

    doc_ids (a column doc_id) names the documents wanted; frames that hold none
    of them are not read. Without it, all frames of the manifest are.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    chosen = doc_ids is not None

    def read(batches):
        for batch in batches:
            open_files: dict[str, Reader] = {}
            asked = batch.column("wanted").to_pylist() if chosen else [None] * len(batch)
            for path, number, start, wanted in zip(batch.column("path").to_pylist(), batch.column("frame").to_pylist(), batch.column("start").to_pylist(), asked, strict=True):
                if path not in open_files:
                    open_files.clear()
                    store, inner = _open(folder or path)
                    inner = inner if folder is None else path
                    open_files[path] = Reader(store.open_input_file(inner), store.get_file_info(inner).size)
                ids, counts, tokens = read_frame(open_files[path].content(number))
                ends = np.cumsum(counts, dtype=np.int64)
                raw = memoryview(tokens).cast("B")
                mine = np.arange(len(ids)) if wanted is None else np.flatnonzero(np.isin(ids, np.array(wanted, np.int64)))
                begins = ends - counts
                checks = [zlib.crc32(raw[4 * int(b) : 4 * int(e)]) for b, e in zip(begins[mine], ends[mine], strict=True)]
                columns = [pa.array(ids[mine], pa.int64(), mask=ids[mine] == NULL_ID), pa.array(start + begins[mine]), pa.array(counts[mine].astype(np.int64)), pa.array(checks, pa.int64())]
                if with_ids:
                    columns.append(pa.array([tokens[int(b) : int(e)].astype(np.int64) for b, e in zip(begins[mine], ends[mine], strict=True)], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    # A manifest is small and its frames are not: dealt out by hand.
    frames = with_starts(manifest)
    if chosen:
        frames = frames.join(_asked(manifest, doc_ids), ["file", "frame"])
    frames = frames.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "frame")
    return frames.mapInArrow(read, schema)
