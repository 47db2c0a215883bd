"""Token ids in seekable zstandard files.

A file is independent zstandard frames, then two skippable frames: an index
of the documents, and last a seek table in the public seekable format (sizes
and a checksum of every frame), which a reader finds from the end of the file.
A reader decompresses only the frames of the documents it wants and checks
them against the table.
"""

from __future__ import annotations

import json
import string
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from byteloom.llm import common

# --- fixed values of the seekable format ---------------------------------------
SKIPPABLE_INDEX = 0x184D2A5D
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Ids in a frame, unless one document has more.
FRAME_IDS = 1 << 16
#: Words whose ids a worker remembers in each of two generations, and the longest of them in bytes.
KNOWN_WORDS, KNOWN_BYTES = 400_000, 48

#: Bytes of text that are encoded at a time, unless one text has more.
PIECE_BYTES = 8 << 20

INDEX = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("frame", "<u4"), ("at", "<u8"), ("n", "<u8")])


# --- the file ------------------------------------------------------------------


class Writer:
    """Writes documents' ids to an open binary file."""

    def __init__(self, out):
        self.out, self.frames, self.docs, self.held, self.held_ids = out, [], [], [], 0
        self.squeeze = zstandard.ZstdCompressor(level=3)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """`ids` are little-endian unsigned 32-bit integers."""
        if self.held and self.held_ids + len(ids) // 4 > FRAME_IDS:
            self._flush()
        self.docs.append((doc_id or 0, doc_id is None, len(self.frames), self.held_ids, len(ids) // 4))
        self.held.append(ids)
        self.held_ids += len(ids) // 4

    def _flush(self) -> None:
        data = b"".join(self.held)
        packed = self.squeeze.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        index = self.squeeze.compress(np.array(self.docs, INDEX).tobytes())
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class Reader:
    """Reads single documents, or all, from a seekable binary file."""

    def __init__(self, source):
        self.source = source
        end = source.seek(0, 2)
        source.seek(end - 9)
        n, flags, magic = struct.unpack("<IBI", source.read(9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        start = end - 9 - 12 * n
        source.seek(start)
        self.table = np.frombuffer(source.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.table[:, 0])])
        source.seek(int(self.starts[-1]))
        kind, size = struct.unpack("<II", source.read(8))
        if kind != SKIPPABLE_INDEX:
            raise ValueError("no document index")
        self.docs = np.frombuffer(zstandard.ZstdDecompressor().decompress(source.read(size)), INDEX)
        self._open = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self._open[0] != i:
            size, length, checksum = map(int, self.table[i])
            self.source.seek(int(self.starts[i]))
            data = zstandard.ZstdDecompressor().decompress(self.source.read(size), max_output_size=length)
            if len(data) != length or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise ValueError(f"frame {i} is damaged")
            self._open = (i, data)
        return self._open[1]

    def read(self, position: int) -> np.ndarray:
        """Ids of the document at a position of the file."""
        d = self.docs[position]
        at = int(d["at"]) * 4
        return np.frombuffer(self.frame(int(d["frame"])), "<u4", int(d["n"]), at)

    def find(self, doc_id: int) -> np.ndarray:
        """Ids of the first document of that id; documents are in ascending order, NULL first."""
        nulls = int(self.docs["is_null"].sum())
        i = nulls + int(np.searchsorted(self.docs["doc_id"][nulls:], doc_id))
        if i >= len(self.docs) or self.docs["doc_id"][i] != doc_id:
            raise KeyError(doc_id)
        return self.read(i)


# --- ids -----------------------------------------------------------------------


def pieces(batch: pa.RecordBatch, column: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """All rows of a batch, so many at a time that their texts have up to `limit` bytes; a longer text is alone."""
    before = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False), dtype=np.int64)])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(before, before[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of every text's runs without white space (ASCII), one after another: their numbers; what each number stands for; how many each text has.

    White space at an end of a text gives an empty word there.
    """
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten().dictionary_encode()
    return words.indices.to_numpy(), words.dictionary, lists.value_lengths().to_numpy()


def halves(words: pa.Array) -> pa.Array:
    """Two for each word: its letters and the ASCII marks behind them, or the whole word and nothing."""
    heads = pc.ascii_rtrim(words, characters=string.punctuation)
    whole = pc.binary_length(words).to_numpy().astype(np.int64)
    length = np.where(pc.utf8_is_alpha(heads).to_numpy(zero_copy_only=False), pc.binary_length(heads).to_numpy(), whole)
    # The same bytes, cut at more places.
    words = pa.concat_arrays([words.cast(pa.large_string())])
    starts = np.cumsum(whole) - whole
    cuts = np.append(np.stack([starts, starts + length], axis=1).ravel(), whole.sum())
    first = np.frombuffer(words.buffers()[1], np.int64, 1, 8 * words.offset)[0] if len(words) else 0
    return pa.LargeStringArray.from_buffers(2 * len(words), pa.py_buffer(cuts + first), words.buffers()[2])


def gathered(items: np.ndarray, lengths: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of `items`, one of each length after another, in the order of `place`; and where each ends."""
    n = lengths[place]
    ends = np.cumsum(n)
    at = np.repeat((np.cumsum(lengths) - lengths)[place] - (ends - n), n)
    at += np.arange(len(at))
    return items[at], ends


#: What keeps letters apart from marks and does not look across white space.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKENIZERS = [
    {
        "type": "Split",
        "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
#: Words of letters that are encoded at a time.
JOINED = 100


def letters_and_marks(word: str) -> bool:
    """Whether a word is letters, then ASCII marks, either of which may be missing."""
    head = word.rstrip(string.punctuation)
    return not head or head.isalpha()


@dataclass
class Encoder:
    """Ids of texts as bytes, by the tokenizer of a file.

    White space ends tokens, so words are encoded one by one and the ids of
    frequent words are remembered.  Only for tokenizers that drop white space
    before anything else looks across it.  Where a tokenizer also keeps letters
    apart from marks, a word of letters and then ASCII marks is encoded as two,
    so far fewer words are met, and words of letters are encoded many at a time:
    each then gives one id that ends a piece, by which the ids are dealt.
    """

    path: str

    def __post_init__(self):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(self.path)
        self.ends = self._ends()
        # When the recent words are many, they become the older ones, and words
        # that are met again move back; so frequent words stay.
        self.recent: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; distinct words are looked up once."""
        place, words, counts = split_words(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string()))
        ids, ends = gathered(*self.ids_of(words), place)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].tolist()
        return [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]

    def encode_words(self, texts: list[list[bytes]]) -> list[list[bytes]]:
        """Ids of every word of every text."""
        words = list(set().union(*texts)) if texts else []
        ids, lengths = self.ids_of(pa.array(words, pa.large_binary()).cast(pa.large_string()))
        data, bounds = ids.tobytes(), [0, *(4 * np.cumsum(lengths)).tolist()]
        known = dict(zip(words, (data[a:b] for a, b in zip(bounds, bounds[1:]))))
        return [list(map(known.__getitem__, text)) for text in texts]

    def ids_of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each has."""
        parts = (words if self.ends is None else halves(words)).dictionary_encode()
        codes = self._remembered(parts.dictionary.cast(pa.large_string()).cast(pa.large_binary()).to_pylist())
        lengths = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
        place = parts.indices.to_numpy()
        ids, _ = gathered(np.frombuffer(b"".join(codes), "<u4"), lengths, place)
        return ids, lengths[place].reshape(len(words), 1 if self.ends is None else 2).sum(axis=1)

    def _ends(self) -> np.ndarray | None:
        """Which ids end a piece; None if letters and marks are not known to be kept apart."""
        from tokenizers.models import BPE

        model = self.tokenizer.model
        suffix = model.end_of_word_suffix if isinstance(model, BPE) else None
        parts = json.loads(self.tokenizer.to_str())
        added = [t["content"] for t in parts["added_tokens"]]
        plain = (parts["normalizer"] or {}).get("normalizers"), (parts["pre_tokenizer"] or {}).get("pretokenizers")
        if not suffix or plain != (NORMALIZERS, PRE_TOKENIZERS) or any(letters_and_marks(t) for t in added):
            return None
        out = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = token.endswith(suffix)
        return out

    def _coded(self, words: list[str]) -> list[bytes]:
        return [np.array(code.ids, "<u4").tobytes() for code in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _coded_letters(self, words: list[str]) -> list[bytes]:
        """Words of letters, JOINED at a time; where one gives more than one piece, they are encoded one by one."""
        out = []
        groups = [words[i : i + JOINED] for i in range(0, len(words), JOINED)]
        for some, code in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(code.ids, "<u4")
            last = np.nonzero(self.ends[ids])[0]
            if len(last) != len(some) or last[-1] != len(ids) - 1:
                out += self._coded(some)
                continue
            data, bounds = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
            out += [data[a:b] for a, b in zip(bounds, bounds[1:])]
        return out

    def _coded_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        letters = [w for w in words if w.isalpha()] if self.ends is not None else []
        others = [w for w in words if not w.isalpha()] if self.ends is not None else words
        yield from zip(letters, self._coded_letters(letters))
        yield from zip(others, self._coded(others))

    def _remembered(self, words: list[bytes]) -> list[bytes]:
        """Ids of distinct words."""
        if len(self.recent) > KNOWN_WORDS:
            self.recent, self.older = {}, self.recent
        recent, older, once = self.recent, self.older, {}
        met = [w for w in words if w not in recent]
        fresh = []
        for word in met:
            if word in older:
                recent[word] = older[word]
            else:
                fresh.append(word)
        for start in range(0, len(fresh), 50_000):
            for text, ids in self._coded_words([w.decode() for w in fresh[start : start + 50_000]]):
                word = text.encode()
                (recent if len(word) <= KNOWN_BYTES else once)[word] = ids
        return [recent[w] if w in recent else once[w] for w in words] if once else list(map(recent.__getitem__, words))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- the operator --------------------------------------------------------------


def write_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write every document's ids, and the end id, in ascending id order.

    Rows are range-partitioned and sorted by id; each task writes the file of
    its range under another name and then renames it, so a task that runs
    again leaves the same file.  Returns (file, path, documents, ids), a row
    per file; `file` follows the order of the ids.

    NULL ids come first; a NULL text has only the end id; repeated rows are
    written as often as they come.  An empty table writes no file.
    """
    end = struct.pack("<I", end_id)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        task = TaskContext.get()
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"{base}/tokens-{task.partitionId():06d}.zst"
        held = f"{name}.attempt-{task.taskAttemptId()}"
        ids = docs_written = 0
        with fs.open_output_stream(held) as out:
            writer = Writer(out)
            batch = first
            while batch is not None:
                for some in pieces(batch, 1):
                    for doc_id, code in zip(some.column(0).to_pylist(), encoder(tokenizer_path).encode(some.column(1))):
                        writer.add(doc_id, code + end)
                        ids += len(code) // 4 + 1
                        docs_written += 1
                batch = next(batches, None)
            writer.close()
        fs.move(held, name)
        yield pa.RecordBatch.from_pydict(
            {"file": [task.partitionId()], "path": [f"{folder}/tokens-{task.partitionId():06d}.zst"], "documents": [docs_written], "ids": [ids]}
        )

    return common.checkpointed(
        docs.select(F.col(id_col).cast("bigint").alias("id"), common.text_of(text_col).alias("body"))
        .repartitionByRange("id")
        .sortWithinPartitions("id", "body")
        .mapInArrow(write, "file bigint, path string, documents bigint, ids bigint")
    )


def read_files(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of `write_files`.

    `start` counts the ids of all documents before it, over all files.
    """
    spark = files.sparkSession
    # A row per file, as many as tasks wrote.
    listed = sorted(files.collect(), key=lambda r: r.file)
    before = np.concatenate([[0], np.cumsum([r.ids for r in listed])]) if listed else [0]
    rows = [(r.path, int(before[i])) for i, r in enumerate(listed)]
    table = spark.createDataFrame(rows, "path string, base bigint").repartition(max(1, len(rows)), "path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as source:
                    reader = Reader(source)
                    docs = reader.docs
                    starts = base + np.concatenate([[0], np.cumsum(docs["n"])[:-1]]).astype(np.int64)
                    for lo in range(0, len(docs), 10_000):
                        part = slice(lo, lo + 10_000)
                        crc = [zlib.crc32(reader.read(i)) for i in range(lo, min(lo + 10_000, len(docs)))]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(docs["doc_id"][part].astype(np.int64), mask=docs["is_null"][part].astype(bool)),
                                pa.array(starts[part]), pa.array(docs["n"][part].astype(np.int64)), pa.array(crc, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return table.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write the files and read them back."""
    import public_tokenizers

    docs = common.table(spark, sf_dir, "documents")
    folder = common.shared_folder(spark, "token-files")
    return read_files(write_files(docs, folder, str(public_tokenizers.path("word_bpe_49k.json")), 1))
