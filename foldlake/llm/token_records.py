"""Token-ID output: length-delimited binary records with masked checksums and a separate offset index.

A shard file is the magic `TOKREC1\\n`, one byte with the bytes per id (2 or 4), then records:

    u64 payload length | u32 masked crc32 of those 8 bytes | payload | u32 masked crc32 of the payload

A payload is one byte (1 if the document has an id), the i64 document id, and the token ids. All integers are
little-endian. The mask rotates the checksum right by 15 bits and adds a constant, so that a checksum of data that
itself holds checksums stays sound. The index of a shard (`<shard>.idx`) has for each record the u64 offset and the u64
number of ids, so records can be read singly and in any order (`read_at`, `shuffled`).
"""

from __future__ import annotations

import io
import json
import os
import random
import re
import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldlake.llm import common

MAGIC = b"TOKREC1\n"
MASK_DELTA = 0xA282EAD8
GENERATION = 200_000
#: Characters of text that are encoded at a time; their pieces take about ten times as many bytes.
CHUNK = 2_000_000
#: Parts of a text, of CHUNK characters and up to the next single space between two characters that are no white space.
_PARTS = re.compile(rf".{{{CHUNK}}}.*?\S(?= \S)|.+", re.S)
#: Where pieces can't simply be cut at each space: white space beside a space, or a space at an end.
_UNSAFE_RE2 = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|  |\n | \n|^ | $|^$"
)
_UNSAFE = re.compile(r"\s \s*| \s|^ | $|^$")
#: Marks that may follow a word; fixed values.
MARKS = ".,;:!?|%&$*#)]}\""
MANIFEST = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("path", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("ids", T.LongType()),
    ]
)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(file) -> bytes | None:
    """The next payload of an open file, None at its end; raises ValueError on damage."""
    head = file.read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    size = struct.unpack("<Q", head[:8])[0]
    body = file.read(size + 4)
    if len(body) < size + 4 or struct.unpack("<I", body[size:])[0] != masked(body[:size]):
        raise ValueError("damaged record payload")
    return body[:size]


class PieceEncoder:
    """Encodes texts as a file of the tokenizers library does with add_special_tokens=False, remembering pieces seen before.

    A byte-level pre-tokenizer starts a new token at a single space between two characters that are no white space, so a
    text can be cut there and its pieces encoded on their own; it also separates a word from the marks after it. Texts
    are cut only there, and only if the file has that pre-tokenizer and no normalizer; with any other file each text is
    encoded whole. Added tokens that stand in a text are found first, as the library does it. Of the pieces, those used
    since the last two times that GENERATION new ones were met are remembered.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4
        parts = json.loads(self.tokenizer.to_str())
        before, added = parts.get("pre_tokenizer") or {}, parts.get("added_tokens") or []
        self.cuts = (
            before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and parts.get("normalizer") is None
            and parts["model"].get("type") == "BPE"
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        )
        self.added = {t["content"]: t["id"] for t in added}
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if added else None
        self.newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, f"<u{self.width}").tobytes()

    @staticmethod
    def pieces(text: str) -> list[str]:
        """The pieces of a text, as keys: a piece that begins with one space without that space, another one after a space."""
        parts = text.split(" ")
        if not _UNSAFE.search(text):
            parts[0] = " " + parts[0]
            return parts
        out = [parts[0]]
        for part in parts[1:]:
            before = out[-1]
            if part and before and not part[0].isspace() and not before[-1].isspace():
                out.append(" " + part)
            else:
                out[-1] = f"{before} {part}"
        return [x[1:] if x[:1] == " " and x[1:2] != " " and x != " " else " " + x for x in out]

    def learn(self, stems: list[str], others: list[str]) -> None:
        """Puts the ids of keys into known. Stems are words of letters only: those of ASCII letters are their own bytes'
        symbols and go to the model at once, the others to the library joined by newlines, one call for many of them."""
        known, wide = self.known, self.width
        merge = self.tokenizer.model.tokenize
        ascii_stems = [x for x in stems if x.isascii()]
        ids, stops = [], []
        for key in ascii_stems:
            ids += [t.id for t in merge("\u0120" + key)]
            stops.append(len(ids))
        data, start = self.pack(ids), 0
        for key, stop in zip(ascii_stems, stops, strict=True):
            known[key] = data[start * wide : stop * wide]
            start = stop
        stems = [x for x in stems if not x.isascii()]
        if len(self.newline) != 1:
            stems, others = [], stems + others
        for at in range(0, len(stems), 512):
            some = stems[at : at + 512]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + "\n ".join(some)], add_special_tokens=False)[0].ids, f"<u{wide}")
            cuts = (np.flatnonzero(ids == self.newline[0]) * wide).tolist()
            data, start = ids.tobytes(), 0
            cuts.append(len(data))
            for key, cut in zip(some, cuts, strict=True):
                known[key] = data[start:cut]
                start = cut + wide
        for at in range(0, len(others), 512):
            some = others[at : at + 512]
            texts = [key[1:] if key[:1] == " " else " " + key for key in some]
            for key, got in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                known[key] = self.pack(got.ids)

    def encode(self, text: str) -> bytes:
        """The ids of one text. Texts of several CHUNKs are encoded part by part where they can be cut."""
        if not self.cuts:
            return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.at_added and self.at_added.search(text):
            return b"".join(self.pack([self.added[x]]) if x in self.added else self.encode(x) for x in self.at_added.split(text) if x)
        parts = _PARTS.findall(text) if len(text) > 2 * CHUNK else [text]
        return b"".join(value for part in parts for value in self.values(self.pieces(part)))

    def values(self, keys: list[str]) -> list[bytes]:
        """The ids of each key; those not known are learned, singly."""
        known = self._remembered(keys)
        return [known[key] for key in keys]

    def _remembered(self, keys: list[str], stems: bool = False) -> dict[str, bytes]:
        """known, holding all keys. stems: whether they are words of letters only."""
        if len(self.known) > GENERATION:
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set(keys).difference(known)
        again = [key for key in new if key in older]
        known.update((key, older[key]) for key in again)
        new.difference_update(again)
        self.learn(*((list(new), []) if stems else ([], list(new))))
        return known

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of an Arrow column. Texts that can be cut at each space are cut, told apart and put
        together as columns: Python sees each different word once, without the marks after it."""
        unsafe = pc.match_substring_regex(texts, _UNSAFE_RE2)
        for content in self.added:
            unsafe = pc.or_(unsafe, pc.match_substring(texts, content))
        unsafe = unsafe.to_numpy(zero_copy_only=False) if self.cuts else np.ones(len(texts), bool)
        out: list[bytes] = [b""] * len(texts)
        for at in np.flatnonzero(unsafe).tolist():
            out[at] = self.encode(texts[at].as_py())
        where = np.flatnonzero(~unsafe)
        if not len(where):
            return out
        parts = pc.split_pattern(texts.take(pa.array(where)), " ")
        offsets = parts.offsets.to_numpy()
        offsets = offsets - offsets[0]
        coded = parts.flatten().dictionary_encode()
        pieces, index = coded.dictionary, coded.indices.to_numpy().astype(np.int32)
        first = offsets[:-1]
        starts = [" " + x for x in pieces.take(pa.array(index[first])).to_pylist()]  # no space stands before a text
        index[first] = np.arange(len(pieces), len(pieces) + len(starts))

        # Pieces of letters and then marks are put together from both, all others are looked up whole.
        bare = pc.utf8_rtrim(pieces, MARKS)
        letters = pc.utf8_is_alpha(bare)
        marked = pc.and_(letters, pc.less(pc.binary_length(bare), pc.binary_length(pieces))).to_numpy(zero_copy_only=False)
        stems = bare.filter(letters).dictionary_encode()
        letters = letters.to_numpy(zero_copy_only=False)
        tails = pc.replace_substring_regex(pieces.filter(pa.array(marked)), f"^.*?([{re.escape(MARKS)}]*)$", " \\1").dictionary_encode()
        words, others = stems.dictionary.to_pylist(), pieces.filter(pa.array(~letters)).to_pylist() + starts
        marks = tails.dictionary.to_pylist()
        known = self._remembered(words, stems=True)
        values = [known[key] for key in words]
        known = self._remembered(others + marks)
        values += [known[key] for key in others]
        values += [known[key] for key in marks]
        values.append(b"")
        head = np.empty(len(pieces) + len(starts), np.int32)
        head[: len(pieces)][letters] = stems.indices.to_numpy()
        head[: len(pieces)][~letters] = len(words) + np.arange(len(others) - len(starts))
        head[len(pieces) :] = len(words) + len(others) - len(starts) + np.arange(len(starts))
        tail = np.full(len(head), len(values) - 1, np.int32)
        tail[: len(pieces)][marked] = len(words) + len(others) + tails.indices.to_numpy()
        sizes = np.fromiter(map(len, values), np.int32, len(values)) // self.width
        whole = _gather(np.frombuffer(b"".join(values), f"<u{self.width}"), sizes, np.column_stack([head, tail]).reshape(-1))
        sizes = sizes[head] + sizes[tail]
        data = _gather(whole, sizes, index).tobytes()
        stops = (np.cumsum(sizes[index], dtype=np.int64)[offsets[1:] - 1] * self.width).tolist()
        start = 0
        for at, stop in zip(where.tolist(), stops, strict=True):
            out[at] = data[start:stop]
            start = stop
        return out


def _gather(items: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The runs of items, whose sizes are given in order, in the order that index names them."""
    begin = np.cumsum(sizes, dtype=np.int32) - sizes
    each = sizes[index]
    ends = np.cumsum(each, dtype=np.int32)
    return items[np.repeat(begin[index] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]


@common.remembered
def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker, which runs many tasks."""
    return PieceEncoder(path)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about CHUNK bytes of text, or one longer text."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(size, before + CHUNK, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def write(
    docs: DataFrame, out: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Writes every document of docs below out, shards and records in ascending order of id; returns the manifest.

    The manifest has a row for each shard that holds records: shard (in file order), path, records, ids. Documents
    without id come first; equal ids are ordered by their text, so repeated rows give the same files. A null or empty
    text gives the end id alone. Other columns are ignored, whatever their names. An empty table gives an empty
    manifest. A task that runs again writes new files, and only the paths in the manifest count.
    """
    common.small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    rows = rows.repartitionByRange("id").sortWithinPartitions("id", "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer_path)
        end = coder.pack([end_id])
        shard = TaskContext.get().partitionId()
        path = f"{out}/{shard:06d}-{uuid4().hex}.rec"
        index, ids, offset = [], 0, len(MAGIC) + 1
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return

        def rest():
            yield first
            yield from batches

        with common.writing(path) as file:
            file.write(MAGIC + bytes([coder.width]))
            for part in chunks(rest()):
                for doc, body in zip(part["id"].to_pylist(), coder.encode_column(part["text"]), strict=True):
                    record = frame(struct.pack("<Bq", doc is not None, doc or 0) + body + end)
                    file.write(record)
                    n = len(body) // coder.width + 1
                    index.append(struct.pack("<QQ", offset, n))
                    offset += len(record)
                    ids += n
        with common.writing(path + ".idx") as file:
            file.write(b"".join(index))
        yield pa.RecordBatch.from_pydict(
            {"shard": pa.array([shard], pa.int32()), "path": [path], "records": [len(index)], "ids": [ids]}
        )

    return common.materialize(rows.mapInArrow(shards, MANIFEST), "token-manifest")


def _split(payload: bytes, width: int) -> tuple[int | None, bytes]:
    has, doc = struct.unpack("<Bq", payload[:9])
    ids = payload[9:]
    if width == 2:
        ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
    return (doc if has else None), ids


def records(path: str) -> Iterator[tuple[int | None, bytes]]:
    """Document id and token ids (as u32 bytes) of each record of a shard, in file order."""
    with common.reading(path) as file:
        stream = io.BufferedReader(file, 1 << 20)
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"not a token record file: {path}")
        width = stream.read(1)[0]
        while (payload := unframe(stream)) is not None:
            yield _split(payload, width)


def offsets(path: str) -> list[tuple[int, int]]:
    """Offset and number of ids of each record, from the index of a shard."""
    with common.reading(path + ".idx") as file:
        return list(struct.iter_unpack("<QQ", file.read()))


def read_at(path: str, offset: int) -> tuple[int | None, bytes]:
    """The record at an offset of a shard."""
    with common.reading(path) as file:
        file.seek(len(MAGIC))
        width = file.read(1)[0]
        file.seek(offset)
        return _split(unframe(file), width)


def shuffled(path: str, seed: int) -> Iterator[tuple[int | None, bytes]]:
    """The records of a shard in a random order, read singly through the index."""
    at = offsets(path)
    random.Random(seed).shuffle(at)
    for offset, _ in at:
        yield read_at(path, offset)


def summarize(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Reads all shards back: doc_id, start (ids of all documents before), n_tokens, ids_crc32 (of the ids as u32).

    The only rows that meet in one task are the manifest's, one a shard.
    """
    before = F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    jobs = manifest.select("shard", "path", "ids", before.cast("long").alias("start"))
    jobs = jobs.repartition(max(1, min(jobs.count(), 100_000)))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for job in batch.to_pylist():
                rows, start = [], job["start"]
                for doc, ids in records(job["path"]):
                    rows.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
                    start += len(ids) // 4
                if start - job["start"] != job["ids"]:
                    raise ValueError(f"{job['path']} lacks ids")
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return jobs.mapInArrow(digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids, read back from the record files; write() says what odd rows give."""
    docs = common.table(spark, sf_dir, "documents")
    return summarize(spark, write(docs, common.work_path(spark, "token-records"), default_tokenizer()))
