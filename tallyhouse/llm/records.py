"""Token ids as length-delimited binary records with an offset index.

A record is one frame:

    uint64 length of the payload | uint32 masked checksum of these 8 bytes | payload | uint32 masked checksum of it | 0x0A

All numbers are little-endian. The payload is the document's id (int64), a byte that is 1 if there is an id and 0 if it is
null, a byte with the width of an id (2 where the vocabulary fits, else 4), and the ids. A checksum is the CRC-32 of the
bytes, rotated right by 15 bits, plus a constant, so that a checksum over bytes that hold checksums stays useful. The closing
byte lets Spark's own text sink write the frames: they go through its commit protocol to any file system that Spark
reaches, and a task that is lost or runs twice leaves nothing behind.

* `write`: a range shuffle by doc_id; every task encodes its share and writes one file, so files and the records in them
  ascend by doc_id. The number of files follows the bytes of the texts.
* `build_index`: reads the files back, verifies both checksums of every record, and stores file, offset, length, doc_id,
  number of ids, checksum of the ids and the number of ids before it as a table beside the files.
* `read_records`: ids of any selection of the index, by seeking to its offsets; `shuffled` reads all in a seeded order.

The text is cut at spaces and line feeds, which no token of the vocabulary and no rule of its normaliser spans, and between
letters and ASCII digits or signs, where its pre-tokeniser cuts too. Arrow cuts the texts of some megabytes at a time and numbers their
different parts; the library encodes those that a worker has not met. The ids are those of the whole text.

Defined results: a null or empty text is the end id alone; documents without an id come first; rows with the same id are
records of their own, ordered by a hash of the text; an empty table gives an empty index; other columns are ignored. A
damaged file raises ValueError with its name and the offset.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.operators import scratch

#: Bytes of text a file; bytes of texts encoded at a time.
FILE_BYTES, SLICE = 32 << 20, 4 << 20
#: Parts remembered by a worker, the longest of them, and words encoded in one call.
MEMO, LONGEST, TOGETHER = 600_000, 64, 1000
_MASK = 0xA282EAD8
#: Struct formats of a length, a checksum and the head of a payload, and the size of the head.
_LENGTH, _CRC, _HEAD, HEAD = "<Q", "<I", "<qBB", 10
#: Bytes of a frame beside its payload, and of those in front of it.
AROUND, BEFORE = 17, 12
_WORD = re.compile(r"[^\W\d_]+")
#: Digits and signs cut from letters: all of ASCII but `_`, and behind letters also `'` and `<`. With `'` contractions begin,
#: and `<|` and `|>` enclose special tokens.
_SIGNS = r"!-&(-;=-@\[-^`{}~"
#: Letters; not those that the normaliser takes apart, as the mark they end in stays with signs behind it.
_LETTER = r"[^\P{L}\x{130}\x{958}-\x{95F}\x{9DC}-\x{9DF}\x{A33}-\x{A5E}\x{B5C}-\x{B5D}\x{F43}-\x{F69}\x{FB1D}-\x{FB4E}]"
_BEFORE_SIGN, _BEHIND_SIGN = rf"({_LETTER})(['<{_SIGNS}])", rf"([{_SIGNS}])(\p{{L}})"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack(_LENGTH, len(payload))
    return b"".join((length, struct.pack(_CRC, masked(length)), payload, struct.pack(_CRC, masked(payload)), b"\n"))


def payload_at(data: bytes, offset: int, file: str) -> bytes:
    """The payload of the frame at the offset, both checksums verified."""
    length = data[offset : offset + 8]
    if len(length) < 8 or data[offset + 8 : offset + BEFORE] != struct.pack(_CRC, masked(length)):
        raise ValueError(f"{file}: no record length at {offset}")
    end = offset + BEFORE + struct.unpack(_LENGTH, length)[0]
    payload = data[offset + BEFORE : end]
    if data[end : end + 5] != struct.pack(_CRC, masked(payload)) + b"\n":
        raise ValueError(f"{file}: damaged record at {offset}")
    return payload


def ids_of(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and ids."""
    doc, given, width = struct.unpack_from(_HEAD, payload)
    return doc if given else None, np.frombuffer(payload, f"<u{width}", offset=HEAD)


class Encoder(dict):
    """Ids, as bytes, of the parts of texts between spaces; the library encodes a part when it is first met."""

    def __init__(self, tokenizer: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        vocabulary = self.library.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, f"<u{self.width}")

    def words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters, many encoded in one call.

        Each of them should end in one token that ends a word; where one doesn't, the two halves are encoded alone.
        """
        ids = self.ids(" ".join(words))
        ends = ((np.flatnonzero(self.ends[ids]) + 1) * self.width).tolist()
        whole = ids.tobytes()
        if len(words) == 1:
            return {words[0]: whole}
        if len(ends) != len(words):
            half = len(words) // 2
            return self.words(words[:half]) | self.words(words[half:])
        return {w: whole[a:b] for w, a, b in zip(words, [0, *ends], ends, strict=False)}

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of parts that are not known yet; short ones are remembered."""
        plain = {part: _bare(part) for part in parts}
        words, new = [w for w in dict.fromkeys(plain.values()) if w not in self and _WORD.fullmatch(w)], {}
        for i in range(0, len(words), TOGETHER):
            new |= self.words(words[i : i + TOGETHER])
        for part, bare in plain.items():
            if part not in new:
                ids = new.get(bare, self.get(bare))
                new[part] = self.ids(part).tobytes() if ids is None else ids
        if len(self) + len(new) > MEMO:
            self.clear()
        if len(new) <= MEMO:
            self.update((part, ids) for part, ids in new.items() if len(part) <= LONGEST)
        return new

    def encode(self, texts: pa.Array) -> list[memoryview]:
        """Ids, as bytes, of every text: the different parts are looked up once, and their ids gathered by Arrow."""
        parts = parts_of(texts)
        coded = parts.flatten().dictionary_encode()
        unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.get, unique))
        new = self.learn([part for part, known in zip(unique, ids, strict=True) if known is None])
        ids = [new[part] if known is None else known for part, known in zip(unique, ids, strict=True)]
        gathered = pa.array(ids, pa.binary()).take(coded.indices)
        _, offsets, content = gathered.buffers()
        at = np.concatenate([[0], np.cumsum(parts.value_lengths().to_numpy())])
        at = np.frombuffer(offsets, np.int32)[at].tolist()
        content = memoryview(content or b"")
        return [content[a:b] for a, b in zip(at, at[1:], strict=False)]


def _bare(part: str) -> str:
    return part.lower() if part.isascii() and "<" not in part else part


def parts_of(texts: pa.Array) -> pa.ListArray:
    """Parts that the library encodes alike whether alone or in the text; ASCII texts in lower case, as its normaliser has them."""
    texts = pc.fill_null(texts, "")
    # Special tokens are looked for before the normaliser.
    lower = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<")))
    texts = pc.if_else(lower, pc.ascii_lower(texts), texts)
    for pattern in (_BEFORE_SIGN, _BEHIND_SIGN):
        texts = pc.replace_substring_regex(texts, pattern=pattern, replacement=r"\1 \2")
    return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Stretches of rows with about SLICE bytes of text; one longer text is a stretch of its own or ends one."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // SLICE, prepend=-1)).tolist()
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=False):
        yield batch.slice(a, b - a)


def _frames(held, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker keeps what is broadcast, and so the encoder with the words it knows, from task to task.
        encoder = held.value.get("encoder") or held.value.setdefault("encoder", Encoder(held.value["tokenizer"]))
        end = b"" if end_id is None else np.array([end_id], f"<u{encoder.width}").tobytes()
        for some in (part for batch in batches for part in _slices(batch)):
            out = []
            for doc, ids in zip(some["doc_id"].to_pylist(), encoder.encode(some["text"]), strict=True):
                head = struct.pack(_HEAD, doc or 0, doc is not None, encoder.width)
                # The sink writes the closing byte.
                out.append(frame(b"".join((head, ids, end)))[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    return run


def write(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int | None = 1, file_bytes: int = FILE_BYTES) -> None:
    """Writes the documents' ids as records into files under folder/records, ascending by doc_id."""
    held = docs.sparkSession.sparkContext.broadcast({"tokenizer": Path(tokenizer_file).read_text(encoding="utf-8")})
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"),
        # Many rows with one id and text may lie in several files.
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.repartitionByRange(max(1, math.ceil(size / file_bytes)), "doc_id", "tie", "row")
    rows = rows.sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    frames = rows.mapInArrow(_frames(held, end_id), "frame binary")
    frames.select(F.col("frame").cast("string")).write.option("lineSep", "\n").option("compression", "none").text(f"{folder}/records")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/records")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every record of the files, in their order."""
    for batch in batches:
        for file, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
            data, offset, before, rows = memoryview(content.as_buffer()).cast("B"), 0, 0, []
            while offset < len(data):
                payload = payload_at(data, offset, file)
                doc, ids = ids_of(payload)
                rows.append((offset, len(payload) + AROUND, doc, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), before))
                offset, before = offset + len(payload) + AROUND, before + len(ids)
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                names = ["file", "offset", "length", "doc_id", "n_tokens", "ids_crc32", "start"]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(rows)), *columns], names=names)


def build_index(spark: SparkSession, folder: str) -> DataFrame:
    """Index of the records under the folder, stored in folder/index: one row a record, `start` over all files.

    Numbers of ids are summed over files in a window of one row a file.
    """
    longs = ", ".join(f"{c} long" for c in ("offset", "length", "doc_id", "n_tokens", "ids_crc32", "start"))
    found, _ = scratch.store(_files(spark, folder).select("path", "content").mapInArrow(_scan, f"file string, {longs}"), "records-found")
    # Names are part-<number>-<job>-c<number>: as text, numbers beyond five digits would not ascend.
    at = [F.regexp_extract("file", r"part-(\d+)", 1).cast("long"), F.regexp_extract("file", r"-c(\d+)", 1).cast("long")]
    files = found.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", "n", *[c.alias(f"at{i}") for i, c in enumerate(at)])
    earlier = Window.orderBy("at0", "at1").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    found.join(files, "file").withColumn("start", F.col("start") + F.col("before")).drop("before").write.parquet(f"{folder}/index")
    return index(spark, folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/index")


def _pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content, offsets in zip(batch["path"].to_pylist(), batch["content"], batch["offsets"].to_pylist(), strict=True):
            data, docs, ids = memoryview(content.as_buffer()).cast("B"), [], []
            for offset in offsets:
                doc, own = ids_of(payload_at(data, offset, file))
                docs.append(doc)
                ids.append(own.astype(np.int64))
            columns = [pa.array([file] * len(offsets)), pa.array(offsets, pa.int64()), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.list_(pa.int64()))], names=["file", "offset", "doc_id", "ids"])


def read_records(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """file, offset, doc_id, ids of the wanted rows of the index: each file is opened once, and only those places are read."""
    places = wanted.groupBy("file").agg(F.collect_list("offset").alias("offsets"))
    files = _files(spark, folder).select("path", "content").join(places, F.col("path") == F.col("file")).select("path", "content", "offsets")
    return files.mapInArrow(_pick, "file string, offset long, doc_id long, ids array<long>")


def shuffled(spark: SparkSession, folder: str, seed: int) -> DataFrame:
    """doc_id and ids of all records in an order that the seed fixes, whatever the partitions."""
    place = F.xxhash64(F.lit(seed), F.regexp_extract("file", r"part-(\d+)", 1), "offset")
    rows = read_records(spark, folder, index(spark, folder)).withColumn("place", place)
    return rows.orderBy("place", "offset").select("doc_id", "ids")
