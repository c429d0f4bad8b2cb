"""Token files: frequency-ranked ids in a byte-aligned coding, written and read as a Spark data source.

A dataset is a folder:

* ``ids.bin``: the vocabulary's ids by falling frequency, 32-bit little endian. Files hold
  the place of an id in this list, so frequent ids take one byte.
* ``*.tok``: eight bytes of magic, then blocks of whole documents. A block is a header
  (documents, numbers, control bytes, data bytes, checksum), the documents' ids, flags and
  sizes, the control bytes and the data bytes (``token_codec``).
* ``manifest.json``: the files in the order of their documents, with the number of
  documents and ids of each. It is written when all tasks are done; files that it does
  not name (of lost or repeated attempts) are no part of the dataset.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import struct
import sys
import types
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ..session import scratch_folder
from . import token_codec
from .store import materialise

FORMAT = "token_files"
MAGIC = b"TOKIDS01"
HEADER = "<QQQQI"  # documents, ids, control bytes, data bytes, checksum
END_ID = 0  # follows each document
BATCH_BYTES = 1 << 22  # of the texts that a task tokenises at once; a longer one goes alone
COUNT_ROWS = 64  # documents whose ids a task counts at once
BLOCK_IDS = 1 << 20  # ids of a block at least, but for the last of a file
FILE_IDS = 1 << 27  # a file is closed at the first block that reaches this
#: what byte-level vocabularies write for the 256 bytes
BYTES = {chr(c) for c in (*range(33, 127), *range(161, 173), *range(174, 324))}
PACKED = "part int, seq bigint, doc_id bigint, n bigint, ids binary"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids binary"


def place(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named as Spark names it (``file:/x``, ``s3://b/x`` or a plain path)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _read(system: fs.FileSystem, path: str) -> bytes:
    with system.open_input_stream(path) as f:
        return f.read()


def _write(system: fs.FileSystem, path: str, data: bytes) -> None:
    with system.open_output_stream(path) as f:
        f.write(data)


# ---- tokenising and ranks

class WholeCoder:
    """Ids of whole texts, each text an item of the library's call."""

    ITEMS = 64  # items of a call

    def __init__(self, tool, kind: np.dtype):
        self.tool, self.kind = tool, kind

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and the ids of all texts one after the other."""
        return self._items(lambda i, j: texts.slice(i, j - i).to_pylist(), len(texts))

    def _items(self, items: Callable[[int, int], list[str]], count: int) -> tuple[np.ndarray, np.ndarray]:
        sizes, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=self.kind)]
        for i in range(0, count, self.ITEMS):
            found = [e.ids for e in self.tool.encode_batch_fast(items(i, min(i + self.ITEMS, count)), add_special_tokens=False)]
            sizes.append(np.array([len(x) for x in found], dtype=np.int64))
            ids += [np.array(x, dtype=self.kind) for x in found]
        return np.concatenate(sizes), np.concatenate(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        sizes, ids = self.column(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(sizes))[:-1]]


def _kept(key: str, make: Callable):
    """What an earlier task of this worker process made under a key, or what ``make`` makes now."""
    shelf = sys.modules.setdefault("_token_pieces", types.ModuleType("_token_pieces")).__dict__  # outlives the task
    if key not in shelf:
        shelf[key] = make()
    return shelf[key]


@dataclass
class Known:
    """Pieces by number with their ids, all in one array, and the bytes of each id of the vocabulary."""

    width: np.ndarray
    number: dict[bytes, int]
    starts: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray

    @classmethod
    def of(cls, tool, kind: np.dtype) -> Known:
        vocabulary = tool.get_vocab()
        width = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        width[list(vocabulary.values())] = [len(token) for token in vocabulary]  # a byte-level token has a character a byte
        return cls(width, {}, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=kind))

    def add(self, pieces: list[bytes], found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        """Starts, sizes and ids of new pieces in their order, part by part."""
        base = len(self.ids) + np.cumsum([0, *(len(ids) for _, _, ids in found)])
        self.starts = np.concatenate((self.starts, *(first + b for (first, _, _), b in zip(found, base))))
        self.sizes = np.concatenate((self.sizes, *(sizes for _, sizes, _ in found)))
        self.ids = np.concatenate((self.ids, *(ids for _, _, ids in found)))
        self.number.update(zip(pieces, range(len(self.number), len(self.starts))))

    def clear(self) -> None:
        self.number, self.starts, self.sizes, self.ids = {}, self.starts[:0], self.sizes[:0], self.ids[:0]


class PieceCoder(WholeCoder):
    """The same ids from remembered pieces, for byte-level vocabularies with the usual word pattern.

    That pattern always cuts at the places of ``_cuts``, so the pieces between such places
    encode on their own. A batch's different pieces are looked up once. Unknown ones go to
    the library in long texts, in which the pattern cuts between them as well; a token's
    number of bytes then tells whose it is. What is white space or a letter beyond Latin-1
    need not be known here: there are no cuts where that decides. A worker process keeps
    what it knows from task to task and forgets it all beyond ``LIMIT`` pieces or ``IDS`` ids.
    """

    LIMIT = 1 << 20
    IDS = 1 << 24
    JOINED = 4096  # pieces of one text
    LETTER = np.array([chr(c).isalpha() for c in range(128)] + [False] * 128)
    MARK = np.array([33 <= c < 127 and not chr(c).isalnum() for c in range(256)])
    OPEN = MARK & (np.arange(256) != ord("'"))  # a letter may belong to an apostrophe before it
    FIRM = np.array([33 <= c < 127 or c >= 128 for c in range(256)])  # but for what _firm takes out

    def __init__(self, tool, kind: np.dtype, key: str):
        super().__init__(tool, kind)
        self.known = _kept(f"pieces {key}", lambda: Known.of(tool, kind))

    @classmethod
    def _firm(cls, raw: np.ndarray) -> np.ndarray:
        """Bytes of characters that are surely no white space, whatever the tables of letters."""
        firm = cls.FIRM[raw]
        lead = np.flatnonzero((raw == 0xC2) | (raw >= 0xE1) & (raw <= 0xE3))
        first, second = raw[lead], raw.take(lead + 1, mode="clip")
        white = (first == 0xC2) & ((second == 0x85) | (second == 0xA0)) | (first == 0xE1) & (second == 0x9A)
        white |= (first == 0xE2) & ((second == 0x80) | (second == 0x81)) | (first == 0xE3) & (second == 0x80)
        for k in range(3):
            firm[np.minimum(lead[white] + k, len(raw) - 1)] = False
        return firm

    @classmethod
    def _cuts(cls, raw: np.ndarray) -> np.ndarray:
        """Marks of bytes before which the pattern cuts.

        These are a space and a line end, each between two characters that are no white
        space, the character after such a line end, an ASCII mark after a letter, and an
        ASCII letter after a mark other than an apostrophe.
        """
        cut = np.zeros(len(raw), dtype=bool)
        firm = cls._firm(raw)
        inner = raw[1:-1]
        between = firm[:-2] & firm[2:]
        line = between & (inner == 10)
        cut[1:-1] = between & (inner == 32) | line
        cut[2:] |= line
        letter = cls.LETTER[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)  # Latin-1: all letters but two signs
        letter[lead + 1] = (raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)
        cut[1:] |= letter[:-1] & cls.MARK[raw[1:]] | cls.OPEN[raw[:-1]] & cls.LETTER[raw[1:]]
        return cut

    @staticmethod
    def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts one after the other, and where each begins and the last ends."""
        texts = texts.cast(pa.large_binary())
        _, at, data = texts.buffers()
        at = np.frombuffer(at, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
        raw = np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]] if data else np.zeros(0, dtype=np.uint8)
        return raw, at - at[0]

    @classmethod
    def _pieces(cls, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces in order, none of them empty, and the number of the first of each text and after the last."""
        raw, at = cls._bytes(texts)
        if not len(raw):
            return pa.array([], pa.large_binary()), np.zeros(len(at), dtype=np.int64)
        cut = np.append(cls._cuts(raw), True)
        cut[at] = True
        ends = np.flatnonzero(cut)
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(raw)])
        return found, np.searchsorted(ends, at)

    @staticmethod
    def pieces(text: str) -> list[str]:
        return [p.decode() for p in PieceCoder._pieces(pa.array([text], pa.string()))[0].to_pylist()]

    def _learn(self, pieces: list[bytes]) -> None:
        """Look up all pieces, joined where the pattern cuts between them and one by one elsewhere."""
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths)
        starts = ends - lengths
        raw = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        firm = self._firm(raw)
        closed = firm[ends - 1]
        spaced = closed & (raw[starts] == 32) & firm[np.minimum(starts + 1, len(raw) - 1)]
        plain = closed & firm[starts]
        order: list[bytes] = []
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for chosen, glue in ((spaced, b""), (plain, b"\n")):
            own = [pieces[i] for i in np.flatnonzero(chosen).tolist()]
            found += [self._joined(own[i:i + self.JOINED], glue) for i in range(0, len(own), self.JOINED)]
            order += own
        alone = [pieces[i] for i in np.flatnonzero(~spaced & ~plain).tolist()]
        sizes, ids = self._items(lambda i, j: [p.decode() for p in alone[i:j]], len(alone))
        self.known.add([*order, *alone], [*found, (np.cumsum(sizes) - sizes, sizes, ids)])

    def _joined(self, pieces: list[bytes], glue: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each piece's ids begin, how many they are, and the ids of all pieces, those of ``glue`` among them."""
        [text] = self.tool.encode_batch_fast([glue.join(pieces).decode()], add_special_tokens=False)
        ids = np.array(text.ids, dtype=self.kind)
        at = np.append(0, np.cumsum(self.known.width[ids]))
        lengths = np.array([len(p) for p in pieces])
        ends = np.cumsum(lengths + len(glue)) - len(glue)
        first, last = np.searchsorted(at, ends - lengths), np.searchsorted(at, ends)
        if at[-1] != ends[-1] or (at[first] != ends - lengths).any() or (at[last] != ends).any():
            raise ValueError("a token spans two pieces")
        return first, last - first, ids

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, at = self._pieces(texts)
        known = self.known
        if len(known.number) > self.LIMIT or len(known.ids) > self.IDS:
            known.clear()
        numbered = pieces.dictionary_encode()
        different = numbered.dictionary.to_pylist()
        slots = np.fromiter(map(known.number.get, different, repeat(-1)), dtype=np.int64, count=len(different))
        new = np.flatnonzero(slots < 0)
        if len(new):
            unknown = [different[i] for i in new.tolist()]
            self._learn(unknown)
            slots[new] = [known.number[p] for p in unknown]
        slots = slots[numbered.indices.to_numpy()]
        sizes = known.sizes[slots]
        ends = np.append(0, np.cumsum(sizes))
        ids = known.ids[np.repeat(known.starts[slots] - ends[:-1], sizes) + np.arange(ends[-1])]
        return np.diff(ends[at]), ids


def cuts_at_spaces(description: str) -> bool:
    """Whether a tokenizer file describes a byte-level vocabulary that ``PieceCoder`` may take apart."""
    d = json.loads(description)
    pre = d.get("pre_tokenizer") or {}
    model = d["model"]
    return (
        model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        and BYTES <= model["vocab"].keys() and not any(d.get(k) for k in ("normalizer", "truncation", "padding"))
        and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and all(t["special"] for t in d.get("added_tokens", []))
    )


def tokenise(docs: DataFrame, vocabulary: str, doc: str, text: str, end: int | None, special_as_text: bool = True) -> DataFrame:
    """Rows (part, seq, doc_id, n, ids) in ascending document order, ids as they are in the vocabulary.

    ``part`` numbers ranges of documents, ``seq`` the documents of a range. NULL ids come
    first, rows that share an id in the order of a digest of their text. The vocabulary file
    is read once and travels with the tasks, so workers need the library only.
    """
    with open(vocabulary, encoding="utf-8") as f:
        description = f.read()
    in_pieces = special_as_text and cuts_at_spaces(description)
    key = hashlib.sha256(description.encode()).hexdigest()
    rows = docs.select(F.col(doc).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = ["doc_id", "tie"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the cores
        from tokenizers import Tokenizer

        tool = _kept(f"tool {key}", lambda: Tokenizer.from_str(description))
        tool.encode_special_tokens = special_as_text
        kind = np.dtype("<u2" if tool.get_vocab_size() <= 1 << 16 else "<u4")
        coder = PieceCoder(tool, kind, key) if in_pieces else WholeCoder(tool, kind)
        seq = 0
        for b in batches:
            for i, j in _windows(pc.binary_length(b.column("text")).to_numpy(), BATCH_BYTES):
                sizes, ids = coder.column(b.column("text").slice(i, j - i))
                if end is not None:
                    ids = np.insert(ids, np.cumsum(sizes), end)
                    sizes = sizes + 1
                at = pa.array(np.append(0, np.cumsum(sizes)) * kind.itemsize, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    b.column("part").slice(i, j - i), pa.array(np.arange(seq, seq + j - i)), b.column("doc_id").slice(i, j - i),
                    pa.array(sizes, pa.int64()), pa.BinaryArray.from_buffers(pa.binary(), j - i, [None, at.buffers()[1], pa.py_buffer(ids)]),
                ], names=["part", "seq", "doc_id", "n", "ids"])
                seq += j - i

    return ranged.select("part", "doc_id", "text").mapInArrow(pack, PACKED)


def _unpacked(n: int, ids: bytes) -> np.ndarray:
    """Ids of one row of ``tokenise``, whose width follows from their number."""
    return np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4")


def frequencies(packed: DataFrame) -> DataFrame:
    """Rows (id, n) over all documents; tasks add up their own counts first."""

    def count(batches):
        total = np.zeros(0, dtype=np.int64)
        for b in batches:
            rows = zip(b.column("n").to_pylist(), b.column("ids").to_pylist())
            while some := list(islice(rows, COUNT_ROWS)):
                own = np.bincount(np.concatenate([_unpacked(n, ids) for n, ids in some]))
                if len(own) > len(total):
                    total = np.pad(total, (0, len(own) - len(total)))
                total[:len(own)] += own
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return packed.select("n", "ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def ranked_ids(packed: DataFrame) -> np.ndarray:
    """All ids that occur, the most frequent first and the smaller id at a tie; no longer than the vocabulary."""
    rows = frequencies(packed).orderBy(F.desc("n"), "id").select("id").toArrow()
    return rows.column("id").to_numpy().astype("<u4")


# ---- the data source

class TokenFiles(DataSource):
    """``spark.write.format("token_files")`` takes rows of ``tokenise``; reading gives documents in any order."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ROWS

    def writer(self, schema, overwrite: bool):
        return TokenWriter(self.options["path"])

    def reader(self, schema):
        return TokenReader(self.options["path"])


@dataclass
class Files(WriterCommitMessage):
    files: list[dict]


class TokenWriter(DataSourceArrowWriter):
    """Tasks write files under names of their own; only the commit makes them part of the dataset."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        system, folder = place(self.path)
        ids = np.frombuffer(_read(system, posixpath.join(folder, "ids.bin")), dtype="<u4")
        rank = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.uint32)
        rank[ids] = np.arange(len(ids), dtype=np.uint32)
        done: list[dict] = []
        out = _OpenFile(system, folder)
        for b in iterator:
            for part, seq, doc, n, packed in zip(*(b.column(k).to_pylist() for k in ("part", "seq", "doc_id", "n", "ids"))):
                if not out.continues(part, seq):
                    done += out.close()
                out.add(part, seq, doc, rank[_unpacked(n, packed)])
        return Files(done + out.close())

    def commit(self, messages: list[Files | None]) -> None:
        system, folder = place(self.path)
        files = sorted((f for m in messages if m is not None for f in m.files), key=lambda f: (f["part"], f["seq"]))
        start = 0
        for f in files:
            f["start"] = start
            start += f["ids"]
        _write(system, posixpath.join(folder, "manifest.json"), json.dumps({"ids": start, "files": files}).encode())

    def abort(self, messages: list[Files | None]) -> None:
        system, folder = place(self.path)
        for name in (f["name"] for m in messages if m is not None for f in m.files):
            system.delete_file(posixpath.join(folder, name))


class _OpenFile:
    """One file in the making: documents gather to blocks, blocks go out at once."""

    def __init__(self, system: fs.FileSystem, folder: str):
        self.system, self.folder, self.stream = system, folder, None
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.held = 0

    def continues(self, part: int, seq: int) -> bool:
        return self.stream is not None and (part, seq) == self.next and self.info["ids"] < FILE_IDS

    def add(self, part: int, seq: int, doc: int | None, numbers: np.ndarray) -> None:
        if self.stream is None:
            name = f"{part:08d}-{seq:012d}-{uuid.uuid4().hex}.tok"
            self.stream = self.system.open_output_stream(posixpath.join(self.folder, name))
            self.stream.write(MAGIC)
            self.info = {"name": name, "part": part, "seq": seq, "docs": 0, "ids": 0}
        self.docs.append((doc, numbers))
        self.held += len(numbers)
        self.next = (part, seq + 1)
        if self.held >= BLOCK_IDS:
            self._flush()

    def _flush(self) -> None:
        if not self.docs:
            return
        control, data = token_codec.encode(np.concatenate([x for _, x in self.docs]))
        body = b"".join((
            np.array([d or 0 for d, _ in self.docs], dtype="<i8").tobytes(),
            np.array([d is not None for d, _ in self.docs], dtype=np.uint8).tobytes(),
            np.array([len(x) for _, x in self.docs], dtype="<u8").tobytes(), control, data,
        ))
        self.stream.write(struct.pack(HEADER, len(self.docs), self.held, len(control), len(data), zlib.crc32(body)))
        self.stream.write(body)
        self.info["docs"] += len(self.docs)
        self.info["ids"] += self.held
        self.docs, self.held = [], 0

    def close(self) -> list[dict]:
        if self.stream is None:
            return []
        self._flush()
        self.stream.close()
        self.stream = None
        return [self.info]


@dataclass
class OneFile(InputPartition):
    name: str
    start: int
    ids: int


class TokenReader(DataSourceReader):
    """One task per file; a task holds one block at a time."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[OneFile]:
        system, folder = place(self.path)
        files = json.loads(_read(system, posixpath.join(folder, "manifest.json")))["files"]
        return [OneFile(f["name"], f["start"], f["ids"]) for f in files] or [OneFile("", 0, 0)]

    def read(self, partition: OneFile) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        system, folder = place(self.path)
        ids = np.frombuffer(_read(system, posixpath.join(folder, "ids.bin")), dtype="<u4")
        start = partition.start
        with system.open_input_stream(posixpath.join(folder, partition.name)) as f:
            for docs, sizes, numbers in blocks(f):
                ends = np.cumsum(sizes)
                raw = ids[numbers].tobytes()
                offsets = pa.array(4 * np.concatenate(([0], ends)), pa.int64())
                texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(docs), [None, offsets.buffers()[1], pa.py_buffer(raw)])
                # 32-bit offsets where a block allows them; a longer document goes alone
                for i, j in _windows(4 * sizes):
                    yield pa.RecordBatch.from_arrays([
                        docs.slice(i, j - i), pa.array(start + ends[i:j] - sizes[i:j]), pa.array(sizes[i:j]),
                        texts.slice(i, j - i).cast(pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])
                start += int(ends[-1])
        if start != partition.start + partition.ids:
            raise ValueError(f"{partition.name} holds {start - partition.start} ids, not {partition.ids}")


def _windows(sizes: np.ndarray, most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``most`` bytes, or of one row."""
    i, held = 0, 0
    for j, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield i, j
            i, held = j, 0
        held += n
    yield i, len(sizes)


def blocks(f) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Document ids, sizes and ranks of each block of an open file."""
    if f.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    while header := f.read(struct.calcsize(HEADER)):
        docs, count, n_control, n_data, check = struct.unpack(HEADER, header)
        body = f.read(17 * docs + n_control + n_data)
        if zlib.crc32(body) != check:
            raise ValueError("damaged block of a token file")
        known = np.frombuffer(body, dtype=np.uint8, count=docs, offset=8 * docs) > 0
        ids = pa.array(np.frombuffer(body, dtype="<i8", count=docs), pa.int64(), mask=~known)
        sizes = np.frombuffer(body, dtype="<u8", count=docs, offset=9 * docs).astype(np.int64)
        at = 17 * docs
        yield ids, sizes, token_codec.decode(body[at:at + n_control], body[at + n_control:], count)


# ---- the operator

def write(
    docs: DataFrame, path: str, vocabulary: str, doc: str = "doc_id", text: str = "text", end: int | None = END_ID,
    special_as_text: bool = True,
) -> None:
    """Tokenise whole texts and write them as token files to ``path``, a new folder that driver and executors share.

    Documents stand in ascending order of the integer ``doc``, NULL first; rows that share
    an id are all written, in the order of a digest of their text. A NULL or empty text has
    only the ``end`` id, if there is one. The names of special tokens are ordinary text in a
    text, unless ``special_as_text`` is off. An empty table gives a dataset without files.
    Other columns are not read.
    """
    spark = docs.sparkSession
    packed = materialise(tokenise(docs, vocabulary, doc, text, end, special_as_text))
    system, folder = place(path)
    system.create_dir(folder, recursive=True)
    _write(system, posixpath.join(folder, "ids.bin"), ranked_ids(packed).tobytes())
    spark.dataSource.register(TokenFiles)
    packed.write.format(FORMAT).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per written document: doc_id, ``start`` (ids of all documents before it), ``n_tokens``, ``ids`` (32-bit little endian)."""
    spark.dataSource.register(TokenFiles)
    return spark.read.format(FORMAT).load(path)


def round_trip(docs: DataFrame, vocabulary: str, **options) -> DataFrame:
    """Write the texts to a folder below the shared one and read the files back."""
    path = scratch_folder(docs.sparkSession)
    write(docs, path, vocabulary, **options)
    return read(docs.sparkSession, path)
