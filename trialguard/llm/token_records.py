"""Token ids in length-delimited binary record files, with an offset index for shuffled reads.

A record file is a run of frames::

    length of the payload   unsigned 64 bit, little-endian
    masked checksum of the length bytes, unsigned 32 bit
    payload
    masked checksum of the payload, unsigned 32 bit

A payload is ``has_id`` (1 byte), ``width`` (1 byte: 2 or 4), the document id (signed 64 bit) and the token ids as
little-endian unsigned integers of that width. The checksum is CRC-32; masking rotates it right by 15 bits and adds
``MASK_DELTA``, so that a checksum of data that holds checksums stays sound. Beside ``part-N.rec`` lies ``part-N.idx``:
for each record the byte offset of its frame and the number of ids before it in the file, and one closing pair with
both totals, as unsigned 64-bit integers. Any record can thus be read alone, in any order.

Spark sorts by range over (id, hash of the text), so that equal or null ids spread over files, and each task streams
its rows into one file. File names carry the task attempt and only files named in the manifest count, so a repeated
task can't spoil a file. Files are written under the shared folder through ``pyarrow.fs``.
"""

from __future__ import annotations

import array
import struct
import sys
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trialguard.llm.common import filesystem, pieces, shared_path, staged, worker_cache

MASK_DELTA = 0xA282EAD8
END_ID = 1
HEAD, HEAD_SIZE = "<BBq", 10
PAIR, PAIR_SIZE = "<QQ", 16
#: Pieces that a worker process remembers at most.
CACHE_PIECES = 1_000_000
MANIFEST = "part long, path string, records long, tokens long"


class CorruptRecord(ValueError):
    """A frame whose length or payload does not fit its checksum."""


def masked_checksum(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, masked_checksum(length).to_bytes(4, "little"), payload, masked_checksum(payload).to_bytes(4, "little"))
    )


def read_frame(stream) -> bytes | None:
    """The next payload of ``stream``, or None at its end."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked_checksum(head[:8]) != int.from_bytes(head[8:], "little"):
        raise CorruptRecord("the length of a record doesn't fit its checksum")
    size = int.from_bytes(head[:8], "little")
    body = stream.read(size + 4)
    if len(body) < size + 4 or masked_checksum(body[:size]) != int.from_bytes(body[size:], "little"):
        raise CorruptRecord("a record doesn't fit its checksum")
    return body[:size]


def pack(doc_id: int | None, ids: bytes, width: int) -> bytes:
    return struct.pack(HEAD, doc_id is not None, width, doc_id or 0) + ids


def unpack(payload: bytes) -> tuple[int | None, np.ndarray]:
    """Document id and token ids (unsigned 32 bit) of a payload."""
    has_id, width, doc_id = struct.unpack_from(HEAD, payload)
    ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=HEAD_SIZE).astype("<u4")
    return (doc_id if has_id else None), ids


class Encoder:
    """Ids of texts by a ``tokenizers`` model whose pieces never cross white space.

    Texts are cut at white space and each different piece is encoded by the library once. A piece of letters with
    closing ASCII punctuation is cut between them too, where the tokenizer's own pattern cuts, and its letters go to
    the library's model in lower case. This holds for the pattern and normalizer stated in ``supports``; other
    tokenizers, and texts with U+001C to U+001F (which Python takes for white space and the library doesn't), are
    encoded whole.
    """

    PUNCTUATION = ".,!?;:#$%&*|"

    def __init__(self, path: str, cache: dict[str, bytes] | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.cache = {} if cache is None else cache
        self.by_piece = self.supports()
        self.marks = str.maketrans(self._byte_letters())

    def supports(self) -> bool:
        import json

        spec = json.loads(self.tokenizer.to_str())
        norm = [x.get("type") for x in (spec["normalizer"] or {}).get("normalizers", [])]
        first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        return norm == ["NFC", "Replace", "Lowercase"] and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    @staticmethod
    def _byte_letters() -> dict[int, str]:
        """The letters that byte-level models write for bytes: printable Latin-1 as it is, the rest from U+0100 on."""
        kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(kept)]
        return {b: chr(b) for b in kept} | {b: chr(0x100 + k) for k, b in enumerate(rest)}

    def pack_ids(self, ids: list[int]) -> bytes:
        packed = array.array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def letters(self, core: str) -> bytes:
        """Ids of lower-case letters."""
        got = self.cache.get(core)
        if got is None:
            written = core if core.isascii() else core.encode().decode("latin-1").translate(self.marks)
            got = self.cache[core] = self.pack_ids([t.id for t in self.model.tokenize(written)])
        return got

    def piece(self, piece: str) -> bytes:
        core = piece.rstrip(self.PUNCTUATION)
        if core.isalpha() and (core.isascii() or self.plain(core)):
            got = self.letters(core.lower())
            if closing := piece[len(core) :]:
                got += self.cache.get(closing) or self.cache.setdefault(closing, self.whole(closing))
        else:
            got = self.whole(piece)
        self.cache[piece] = got
        return got

    @staticmethod
    def plain(core: str) -> bool:
        """Whether lower case is letter by letter and normal form is kept."""
        low = core.lower()
        return "Σ" not in core and len(low) == len(core) and low.isalpha() and (
            unicodedata.is_normalized("NFC", core) and unicodedata.is_normalized("NFC", low)
        )

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_piece or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.whole(text)
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        pieces = text.split()
        got = list(map(self.cache.get, pieces))
        if None in got:
            piece = self.piece
            got = [piece(p) if g is None else g for g, p in zip(got, pieces, strict=True)]
        return b"".join(got)


def _writer(folder: str, tokenizer_path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        encoder = Encoder(tokenizer_path, worker_cache(f"pieces of {tokenizer_path}"))
        end = encoder.pack_ids([end_id])
        path = f"{root}/part-{part:06d}-{attempt}"
        out, index, at, tokens, records = None, None, 0, 0, 0
        for batch in pieces(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, text in zip(ids, texts, strict=True):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    out, index = fs.open_output_stream(f"{path}.rec"), fs.open_output_stream(f"{path}.idx")
                coded = encoder.encode(text) + end
                data = frame(pack(doc_id, coded, encoder.width))
                out.write(data)
                index.write(struct.pack(PAIR, at, tokens))
                at, tokens, records = at + len(data), tokens + len(coded) // encoder.width, records + 1
        if out is not None:
            index.write(struct.pack(PAIR, at, tokens))
            out.close()
            index.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": f"{folder}/part-{part:06d}-{attempt}", "records": records, "tokens": tokens}]
            )

    return run


def write_records(
    docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID,
) -> DataFrame:
    """Encode ``docs`` into record files under ``folder`` in ascending id order (null ids first); their manifest.

    A null text counts as empty, so each row gives one record, which holds at least the end id. Repeated ids give
    repeated records. An empty table writes no file and gives an empty manifest.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    keyed = rows.withColumn("tie", F.xxhash64("text"))
    dealt = keyed.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie", "text")
    written = dealt.select("id", "text").mapInArrow(_writer(folder, tokenizer_path, end_id), MANIFEST)
    return staged(written, "manifest")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            fs, path = filesystem(row["path"])
            with fs.open_input_file(f"{path}.idx") as f:
                index = np.frombuffer(f.read(), "<u8").reshape(-1, 2)
            if len(index) != row["records"] + 1:
                raise CorruptRecord(f"{path}.idx has another number of records than the manifest")
            with fs.open_input_stream(f"{path}.rec", buffer_size=1 << 20) as stream:
                out = []
                for k in range(row["records"]):
                    doc_id, ids = unpack(read_frame(stream))
                    start, after = int(index[k, 1]), int(index[k + 1, 1])
                    if after - start != len(ids):
                        raise CorruptRecord(f"{path}.idx has another length for record {k}")
                    out.append((doc_id, row["base"] + start, len(ids), zlib.crc32(ids.tobytes())))
                    if len(out) == 4096 or k == row["records"] - 1:
                        columns = [pa.array(c, pa.int64()) for c in zip(*out, strict=True)]
                        yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n_tokens", "ids_crc32"])
                        out = []


def read_records(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """``id, start, n_tokens, ids_crc32`` of each record, read back from the files of ``manifest`` and verified.

    ``start`` is the number of ids in all records before it. One task reads one file; the running total is over one
    row a file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    files = max(1, manifest.count())
    return placed.repartition(files).mapInArrow(_reader, "id long, start long, n_tokens long, ids_crc32 long")


def read_record(folder_path: str, record: int) -> tuple[int | None, np.ndarray]:
    """One record of a file, through its index (for shuffled reads)."""
    fs, path = filesystem(folder_path)
    with fs.open_input_file(f"{path}.idx") as f:
        f.seek(record * PAIR_SIZE)
        offset, _ = struct.unpack(PAIR, f.read(PAIR_SIZE))
    with fs.open_input_file(f"{path}.rec") as f:
        f.seek(offset)
        return unpack(read_frame(f))


def token_records(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` as record files in the shared folder and return what they hold, one row a document."""
    spark = docs.sparkSession
    manifest = write_records(docs, tokenizer_path, shared_path(spark, "token-records"), id_col, text_col)
    return read_records(spark, manifest).withColumnRenamed("id", id_col)
