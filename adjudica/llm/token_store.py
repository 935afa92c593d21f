"""Token ids of documents in binary files, each document compressed with a shared dictionary.

File layout (little endian): ``TIDS`` and a version byte, the SHA-256 of the zstandard
dictionary (zeros: none), one zstandard frame per document, then the index: per document
has-id (u8), id (i64), frame offset (u64), frame length (u32), ids (u64); at the end the
number of documents (u64), the offset of the index (u64) and ``TIDS``. A reader that wants
one document reads the index and that document's frame.

The folder is the whole store: ``files``, ``manifest`` and ``head``, a row with the dictionary, its digest, the digest of the
vocabulary file and the end id. Another process reads it with the folder's name alone, and refuses a damaged dictionary.

Files are written by tasks into the folder under names of their own; the manifest, a
table that Spark commits after all tasks, names the files that count, so the files of a lost
attempt are never read. They are written through Arrow's file systems (local or mounted
paths, hdfs, s3, gcs), under the full address that Spark gives a path without a scheme, and read back through Spark.

Defined results: a null or empty text has only the end id; a null id comes first; repeated
rows are documents of their own, in any order among themselves; an empty table has no file.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import work_dir
from .shared import batches_of, draw_bound, parts_for, raw_text, record_batch, releasing, stored, text_bytes

MAGIC = b"TIDS"
_HEAD = "<4sB32s"
_ENTRY = np.dtype([("has_id", "u1"), ("id", "<i8"), ("offset", "<u8"), ("length", "<u4"), ("ids", "<u8")])
_TAIL = "<QQ4s"
#: Pieces of the dictionary's training sample: how many, and how much text each stands for, in bytes.
SAMPLE_DOCUMENTS = 400
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
HEAD = "dictionary binary, dictionary_digest string, vocabulary_digest string, end_id int"


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: ASCII and Latin-1 letters, in either case: a run of them is one word of the splitter, and only its case is changed before
#: the merges. What follows the run in a chunk may be cut off if it is ASCII punctuation.
_ACCENTED = "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_LETTERS = string.ascii_letters + _ACCENTED
_WORD = f"^[a-z{_ACCENTED}]+$"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Bytes of text in a block, new units in one call of the tokenizer, and the longest unit that is remembered.
BLOCK_BYTES = 2_000_000
CALL_UNITS = 10_000
REMEMBERED_BYTES = 48


class Encoder:
    """Ids of texts as little-endian u32 bytes, by the tokenizer of a file; the texts of a block share the work.

    The tokenizer drops white space and treats runs of letters by themselves, whatever
    their case. So the texts are cut at ASCII white space, and a chunk of letters with punctuation behind them
    once more between the two. Each distinct unit of a block is looked up once; the new ones are encoded
    CALL_UNITS in a call, and short ones are remembered: about ``remembered`` since the last turn, and those of the turn before.
    """

    def __init__(self, path: str, remembered: int = 60_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.remembered = remembered
        self.tokenizer = _tokenizer(path)
        # neither normaliser nor splitter changes small letters: the same merges, and no more
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocabulary, suffix = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix or ""
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def __call__(self, text: bytes) -> bytes:
        return next(self.each([text]))

    def each(self, texts: Iterable[bytes]) -> Iterator[bytes]:
        """Ids of each text, in their order."""
        held, size = [], 0
        for text in texts:
            if held and size + len(text) > BLOCK_BYTES:
                yield from self._block(held)
                held, size = [], 0
            if len(text) > BLOCK_BYTES:
                yield b"".join(self._block([piece])[0] for piece in _cut(text, BLOCK_BYTES))
            else:
                held.append(text)
                size += len(text)
        if held:
            yield from self._block(held)

    def forget(self) -> None:
        """Give memory back: the worker process goes on to other stages."""
        self.known, self.older = {}, {}

    def _block(self, texts: list[bytes]) -> list[bytes]:
        # a view, as the stored bytes need not be valid UTF-8
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        words = split.flatten().dictionary_encode()
        chunks = words.dictionary
        low = pc.ascii_lower(chunks)
        stems = pc.ascii_rtrim(low, characters=string.punctuation)
        plain = pc.match_substring_regex(stems, _WORD)
        tails = pc.utf8_ltrim(low.filter(plain), characters=_LETTERS)
        units = pa.concat_arrays([pc.if_else(plain, stems, chunks), tails]).dictionary_encode()
        is_plain, codes = plain.to_numpy(zero_copy_only=False), units.indices.to_numpy()
        is_word = np.zeros(len(units.dictionary), bool)
        is_word[codes[: len(chunks)][is_plain]] = True
        found = self._ids(units.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False).tolist(), is_word.tolist())
        # a chunk is its first unit, and its tail if that was cut off; then a text is its chunks
        first, second = np.arange(len(chunks)), np.flatnonzero(is_plain) + 0.5
        order = np.argsort(np.concatenate([first, second]), kind="stable")
        ids, ends = _strung(np.frombuffer(b"".join(found), "<u4"), np.cumsum([0, *map(len, found)]) // 4, codes[order])
        ids, ends = _strung(ids, ends[np.cumsum(np.concatenate([[0], 1 + is_plain]))], words.indices.to_numpy())
        data, at = ids.tobytes(), (ends[split.offsets.to_numpy()] * 4).tolist()
        return [data[a:b] for a, b in zip(at, at[1:])]

    def _ids(self, units: list[bytes], is_word: list[bool]) -> list[bytes]:
        """Ids of distinct units; ``is_word`` marks those that go straight to the merges."""
        if len(self.known) >= self.remembered:
            self.known, self.older = {}, self.known
        found = list(map(self.known.get, units))
        asked: tuple[list[int], list[int]] = ([], [])
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = kept = self.older.get(units[i])
                if kept is None:
                    asked[is_word[i]].append(i)
                else:
                    self.known[units[i]] = kept
        for which, encode in zip(asked, (self._whole, self._words)):
            for at in range(0, len(which), CALL_UNITS):
                some = which[at : at + CALL_UNITS]
                new = [units[i] for i in some]
                for i, unit, ids in zip(some, new, encode(new)):
                    found[i] = ids
                    if len(unit) <= REMEMBERED_BYTES:
                        self.known[unit] = ids
        return found

    def _words(self, words: list[bytes]) -> list[bytes]:
        (encoded,) = self.merges.encode_batch_fast([b" ".join(words).decode().lower()], add_special_tokens=False)
        ids = np.array(encoded.ids, "<u4")
        # the last token of each word, and no other, has the suffix
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("the vocabulary does not mark the ends of words")
        return _pieces(ids, ends)

    def _whole(self, units: list[bytes]) -> list[bytes]:
        texts = [u.decode("utf-8", "replace") for u in units]
        encoded = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
        of = np.array(encoded.word_ids, np.int64)
        return _pieces(np.array(encoded.ids, "<u4"), np.searchsorted(of, np.arange(len(units)), "right"))


def _pieces(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    data, at = ids.tobytes(), [0, *(ends * 4).tolist()]
    return [data[a:b] for a, b in zip(at, at[1:])]


def _strung(ids: np.ndarray, bounds: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ids one behind the other, run k being ids[bounds[k] : bounds[k + 1]], and the bounds in the result."""
    lengths = np.diff(bounds)[order]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return ids[np.arange(ends[-1]) + np.repeat(bounds[order] - ends[:-1], lengths)], ends


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """A long text in pieces of about ``size`` bytes, cut at white space."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + size)
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


@functools.lru_cache(maxsize=2)
def encoder_of(path: str) -> Encoder:
    """One per worker process; each task forgets at its end what it remembered."""
    return Encoder(path)


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, key: str, text: str) -> bytes:
    """A zstandard dictionary from about SAMPLE_DOCUMENTS pieces of id arrays, drawn by digest from texts of every length.

    A text is one piece, a longer one a piece for every SAMPLE_BYTES; pieces are cut from the ids of the whole text.
    """
    schema = pa.schema([("draw", pa.int64()), ("piece", pa.int64()), ("ids", pa.binary())])
    texts = docs.select(raw_text(text).alias("text")).where(F.octet_length("text") > 0)
    held = texts.select("text", F.xxhash64("text").alias("draw"), F.ceil(F.octet_length("text") / SAMPLE_BYTES).alias("pieces"))
    pieces = held.agg(F.sum("pieces")).first()[0] or 0
    # the expected number of pieces, whatever the table's size; equal texts are drawn once
    bound = draw_bound(SAMPLE_DOCUMENTS / max(pieces, 1))
    chosen = F.filter(
        F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1),
        lambda p: F.when(p == 0, F.col("draw")).otherwise(F.xxhash64("draw", p)) <= bound,
    )

    def encode_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder_of(tokenizer), np.uint32(end_id).tobytes()

        def rows():
            for batch in batches:
                texts = encode.each(value.as_py() for value in batch["text"])
                for ids, draw, n, chosen in zip(texts, *(batch[c].to_pylist() for c in ("draw", "pieces", "chosen"))):
                    ids += end
                    units = len(ids) // 4
                    for p in chosen:
                        yield draw, p, ids[units * p // n * 4 : units * (p + 1) // n * 4]

        yield from batches_of(rows(), schema, 100)
        encode.forget()

    drawn = held.withColumn("chosen", chosen).where(F.size("chosen") > 0).dropDuplicates(["draw"])
    sample = drawn.mapInArrow(releasing(encode_pieces), "draw long, piece long, ids binary").collect()
    sample.sort(key=lambda r: (r.draw, r.piece))
    samples = [bytes(r.ids) for r in sample if r.ids]
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too little to learn from: the ids themselves serve
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _dictionary(data: bytes):
    if not data:
        return None
    kind = zstandard.DICT_TYPE_AUTO
    return zstandard.ZstdCompressionDict(data, dict_type=kind)


def write_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    file_bytes: int = 8_000_000,
    key: str = "doc_id",
    text: str = "text",
    folder: str | None = None,
) -> tuple[str, bytes]:
    """Write all documents in ascending id order; returns the folder and the dictionary.

    Without a ``folder`` the store is an intermediate one below the shared root. Texts are encoded and compressed where
    they are read: only compressed ids are shuffled.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, tokenizer, end_id, key, text)
    folder = full_address(spark, folder or work_dir(spark, "token-ids"))
    with open(tokenizer, "rb") as vocabulary:
        head = (bytearray(dictionary), _digest(dictionary).hex(), hashlib.sha256(vocabulary.read()).hexdigest(), end_id)
    spark.createDataFrame([head], HEAD).coalesce(1).write.parquet(f"{folder}/head")
    schema = pa.schema([("has_id", pa.int8()), ("id", pa.int64()), ("tie", pa.int64()), ("ids", pa.int64()), ("frame", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(tokenizer), np.uint32(end_id).tobytes()
        squeeze = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary))

        def rows():
            for batch in batches:
                texts = encoder.each(value.as_py() for value in batch["text"])
                for doc, ids in zip(batch["doc_id"].to_pylist(), texts):
                    ids += end
                    yield int(doc is not None), doc or 0, zlib.crc32(ids), len(ids) // 4, squeeze.compress(ids)

        yield from batches_of(rows(), schema, 2000)
        encoder.forget()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        frames, entries, offset, number, out = [], [], struct.calcsize(_HEAD), 0, []

        def close():
            nonlocal frames, entries, offset, number
            if not entries:
                return
            name = f"ids-{part:06d}-{number:06d}-{attempt}.bin"
            index = np.array(entries, _ENTRY)
            _put(
                f"{folder}/files/{name}",
                [struct.pack(_HEAD, MAGIC, 1, _digest(dictionary)), *frames, index.tobytes(), struct.pack(_TAIL, len(index), offset, MAGIC)],
            )
            out.append((part, number, name, len(index), int(index["ids"].sum())))
            frames, entries, offset, number = [], [], struct.calcsize(_HEAD), number + 1

        for batch in batches:
            for has, doc, ids, frame in zip(*(batch[c].to_pylist() for c in ("has_id", "id", "ids", "frame"))):
                frames.append(frame)
                entries.append((has, doc, offset, len(frame), ids))
                offset += len(frame)
                if offset >= file_bytes:
                    close()
        close()
        if out:
            yield record_batch(out, pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]))

    parts = parts_for(text_bytes(docs, text), 32_000_000, 2)
    # stored, as finding the range bounds would otherwise encode every text a second time
    packed = stored(
        docs.select(F.col(key).cast("long").alias("doc_id"), raw_text(text).alias("text")).mapInArrow(
            releasing(encode), "has_id byte, id long, tie long, ids long, frame binary"
        ),
        "token-frames",
    )
    ordered = packed.repartitionByRange(parts, "has_id", "id", "tie").sortWithinPartitions("has_id", "id", "tie")
    manifest = ordered.mapInArrow(releasing(write), "part int, number int, file string, documents long, ids long")
    manifest.write.parquet(f"{folder}/manifest")
    return folder, dictionary


def full_address(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme and authority that Spark's own file system would use for it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    address = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub(r"^file:/+", "file:///", address)


def read_head(spark: SparkSession, folder: str) -> tuple[bytes, str, int]:
    """(dictionary, digest of the vocabulary file, end id) of a store."""
    head = spark.read.schema(HEAD).parquet(f"{folder}/head").first()
    dictionary = bytes(head.dictionary)
    if _digest(dictionary).hex() != head.dictionary_digest:
        raise ValueError(f"{folder}: the dictionary is damaged")
    return dictionary, head.vocabulary_digest, head.end_id


def _digest(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest() if dictionary else bytes(32)


def _put(path: str, parts: list[bytes]) -> None:
    from pyarrow import fs

    if re.match(r"\w+:", path):
        system, path = fs.FileSystem.from_uri(path)
    else:
        system = fs.LocalFileSystem()
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(path) as out:
        for p in parts:
            out.write(p)


def read_index(content: bytes) -> np.ndarray:
    n, at, magic = struct.unpack_from(_TAIL, content, len(content) - struct.calcsize(_TAIL))
    if magic != MAGIC or content[:4] != MAGIC:
        raise ValueError("not a file of token ids")
    return np.frombuffer(content, _ENTRY, n, at)


def read_ids(content: bytes, entry: np.void, dictionary: bytes) -> bytes:
    """Ids of one document, as bytes, from the frame its index entry names."""
    if content[5:37] != _digest(dictionary):
        raise ValueError("the file was written with another dictionary")
    frame = content[int(entry["offset"]) : int(entry["offset"]) + int(entry["length"])]
    return zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary)).decompress(frame)


def read_documents(spark: SparkSession, folder: str, dictionary: bytes | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files. The dictionary is the folder's own, if none is given."""
    if dictionary is None:
        dictionary = read_head(spark, folder)[0]
    manifest = spark.read.schema("part int, number int, file string, documents long, ids long").parquet(f"{folder}/manifest")
    # one row per file; a file holds megabytes, so this window is small
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("file_start"))
    schema = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def decode(batches):
        grow = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

        def rows():
            for batch in batches:
                for path, content in zip(batch["path"].to_pylist(), batch["content"]):
                    data, local, name = content.as_py(), 0, path.rpartition("/")[2]
                    if data[5:37] != _digest(dictionary):
                        raise ValueError(f"{path} was written with another dictionary")
                    for e in read_index(data):
                        ids = grow.decompress(data[int(e["offset"]) : int(e["offset"]) + int(e["length"])])
                        if len(ids) != 4 * int(e["ids"]):
                            raise ValueError(f"{path}: a frame and its index disagree")
                        yield name, int(e["id"]) if e["has_id"] else None, local, len(ids) // 4, zlib.crc32(ids)
                        local += len(ids) // 4

        yield from batches_of(rows(), schema)

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").load(f"{folder}/files").select("path", "content")
    found = files.mapInArrow(releasing(decode), "file string, doc_id long, local long, n_tokens long, ids_crc32 long")
    return found.join(starts, "file").select(
        "doc_id", (F.col("file_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )
