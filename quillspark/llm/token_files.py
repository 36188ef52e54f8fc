"""Token ids in seekable files: one zstandard frame per document, a seek table at the end.

A file is a sequence of independent zstandard frames, one per document, in ascending ``doc_id`` order; then a
skippable frame with the documents' ids and a bit for each that is not null; then the seek table of the public seekable format (a skippable frame
of ``compressed size, plain size, checksum`` per frame, where the checksum is the low half of XXH64 over the
plain bytes, and a 9-byte footer).  A reader fetches the tail of a file, then only the frames that it wants.

Files are written and read through ``pyarrow.fs``, at the shared folder's own scheme.

Defined cases: a null or empty text is a document of the end id alone; a null ``doc_id`` comes first (it
may stand beside the smallest 64-bit number, if many rows share them, but is told from it); rows that share a ``doc_id`` are all kept, beside each other, in any order; an empty table gives no file; further
columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import Scratch, shuffle_partitions, slices
from quillspark.llm.tokenise import encoder

END_ID = 0
SKIPPABLE = 0x184D2A50  # the document ids; the format gives the seek table the magic number + 14
SEEK_TABLE = SKIPPABLE + 14
SEEKABLE = 0x8F92EAB1
_NULL_ID = -(2**63)
FILE_BYTES = 32 << 20  # of text in a file, about
FRAMES = "file int, named boolean, doc_id long, n_tokens long, plain_size long, checksum long, frame binary"
MANIFEST = "file int, path string, n_docs long, n_tokens long, n_bytes long"
DOCS = "file int, place long, doc_id long, before long, n_tokens long, ids_crc32 long, ids binary"


def _open(path: str):
    return fs.FileSystem.from_uri(path)


def frame_rows(docs: DataFrame, tokenizer_path: str, bounds: list[int], level: int = 1) -> DataFrame:
    """Each document tokenised and compressed as a frame of its own, with the number of its file."""
    cuts = np.array(bounds, np.int64)

    def build(batches):
        compress = zstandard.ZstdCompressor(level=level, write_checksum=True).compress
        encode = encoder(tokenizer_path).encode
        for whole in batches:
            for part in slices(whole, 8 << 20):
                ids, at = encode(part.column(1).to_pylist(), END_ID)
                named = part.column(0).is_valid()
                doc_ids = part.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
                low, high = np.searchsorted(cuts, doc_ids, "left"), np.searchsorted(cuts, doc_ids, "right")
                # an id with more rows than a file holds owns a run of files: deal its rows over them
                spread = np.arange(len(doc_ids)) % np.maximum(high - low, 1)
                plain = [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((low + spread).astype(np.int32)),
                        named,
                        pa.array(doc_ids),
                        pa.array(np.diff(at)),
                        pa.array([len(p) for p in plain], pa.int64()),
                        pa.array([xxhash.xxh64_intdigest(p) & 0xFFFFFFFF for p in plain], pa.int64()),
                        pa.array([compress(p) for p in plain], pa.binary()),
                    ],
                    names=["file", "named", "doc_id", "n_tokens", "plain_size", "checksum", "frame"],
                )

    return docs.select("doc_id", "text").mapInArrow(build, FRAMES)


class _FileWriter:
    def __init__(self, folder: str, file: int):
        # a retried or doubled task writes under another name; only a finished task reports its files
        self.file, self.path = file, f"{folder}/part-{file:05d}-{uuid.uuid4().hex}.zst"
        system, inner = _open(folder)
        system.create_dir(inner, recursive=True)
        self.out = system.open_output_stream(f"{inner}/{self.path.rpartition('/')[2]}", compression=None)
        self.sizes, self.ids, self.named, self.tokens, self.bytes = [], [], [], 0, 0

    def add(self, named: bool, doc_id: int, n_tokens: int, plain: int, checksum: int, frame: bytes) -> None:
        self.out.write(frame)
        self.sizes.append((len(frame), plain, checksum))
        self.ids.append(doc_id)
        self.named.append(named)
        self.tokens += n_tokens
        self.bytes += len(frame)

    def close(self) -> tuple:
        ids = np.array(self.ids, "<i8").tobytes() + np.packbits(self.named).tobytes()
        self.out.write(struct.pack("<II", SKIPPABLE, len(ids)) + ids)
        # the ids' frame is a frame of the file too: the table lists it with no plain bytes
        entries = np.array([*self.sizes, (len(ids) + 8, 0, 0)], "<u4")
        body = entries.tobytes() + struct.pack("<IBI", len(entries), 0x80, SEEKABLE)
        self.out.write(struct.pack("<II", SEEK_TABLE, len(body)) + body)
        self.out.close()
        return self.file, self.path, len(self.ids), self.tokens, self.bytes


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, files: int | None = None) -> DataFrame:
    """Write all documents' ids in ascending ``doc_id`` order; return the files' manifest, already written."""
    spark = docs.sparkSession
    if not files:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        files = max(1, -(-size // FILE_BYTES))
    keys = docs.select(F.coalesce("doc_id", F.lit(_NULL_ID)).alias("k"))
    cut = [i / files for i in range(1, files)] or [0.5]
    found = keys.select(F.percentile_approx("k", cut, 100 * files).alias("b")).first()["b"]
    frames = frame_rows(docs, tokenizer_path, found or [] if files > 1 else [])
    dealt = frames.repartitionById(files, "file").sortWithinPartitions("file", "named", "doc_id")

    def write(batches):
        now, done = None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if now is None or now.file != row[0]:
                    if now:
                        done.append(now.close())
                    now = _FileWriter(folder, row[0])
                now.add(*row[1:])
        if now:
            done.append(now.close())
        columns = list(zip(*done)) or [[]] * 5
        kinds = (pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["file", "path", "n_docs", "n_tokens", "n_bytes"]
        )

    manifest = dealt.mapInArrow(write, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_file(path: str, wanted: set[int] | None = None):
    """(place, doc_id, ids before it in the file, id bytes) of a file's documents, or of the wanted ones only."""
    system, inner = _open(path)
    with system.open_input_file(inner) as file:
        size = file.size()
        frames, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE or flags != 0x80:
            raise ValueError(f"{path}: no seek table")
        table = np.frombuffer(file.read_at(12 * frames, size - 9 - 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        starts = np.cumsum(table[:, 0]) - table[:, 0]
        noted = file.read_at(int(table[-1, 0]) - 8, int(starts[-1]) + 8)
        ids = np.frombuffer(noted, "<i8", frames - 1)
        named = np.unpackbits(np.frombuffer(noted, np.uint8, offset=8 * len(ids)), count=len(ids)).astype(bool)
        before = np.cumsum(table[:, 1]) // 4 - table[:, 1] // 4
        expand = zstandard.ZstdDecompressor().decompress
        places = np.arange(len(ids))
        if wanted is not None:
            places = places[named & np.isin(ids, list(wanted))]
        for run in np.split(places, np.flatnonzero(np.diff(places) > 1) + 1):
            for some in np.array_split(run, max(1, len(run) // 2048)):  # one read for a run of neighbours
                if not len(some):
                    continue
                low = int(starts[some[0]])
                block = file.read_at(int(starts[some[-1]] + table[some[-1], 0]) - low, low)
                for i in some:
                    at = int(starts[i]) - low
                    plain = expand(block[at : at + int(table[i, 0])])
                    if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != table[i, 2] or len(plain) != table[i, 1]:
                        raise ValueError(f"{path}: frame {i} is damaged")
                    yield int(i), int(ids[i]) if named[i] else None, int(before[i]), plain


def read_token_files(manifest: DataFrame, doc_ids: list[int] | None = None, with_ids: bool = True) -> DataFrame:
    """Documents from the files: ids as little-endian unsigned 32-bit bytes, their number, checksum and place."""
    wanted = None if doc_ids is None else set(doc_ids)

    def read(batches):
        for batch in batches:
            for number, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []

                def flush():
                    c = list(zip(*rows)) or [[]] * 7
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    names = ["file", "place", "doc_id", "before", "n_tokens", "ids_crc32", "ids"]
                    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(c, kinds)], names=names)

                for place, doc_id, before, plain in read_file(path, wanted):
                    rows.append((number, place, doc_id, before, len(plain) // 4, zlib.crc32(plain), plain if with_ids else None))
                    if len(rows) >= 1024:
                        yield flush()
                        rows = []
                yield flush()

    spread = manifest.select("file", "path").repartition(max(1, manifest.count()), "path")
    return spread.mapInArrow(read, DOCS)


def document_offsets(manifest: DataFrame, documents: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all documents before one, over all files.  The manifest has a row per file."""
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = manifest.select("file", before.alias("base"))
    return documents.join(base, "file").withColumn("start", F.col("base") + F.col("before")).drop("base")


def token_file_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write files below the shared folder, read all of them back, and report on each document."""
    spark = docs.sparkSession
    with Scratch(spark, "token-files") as scratch:
        manifest = write_token_files(docs, scratch.folder, tokenizer_path)
        back = read_token_files(manifest, with_ids=False)
        placed = document_offsets(manifest, back)
        return scratch.keep(placed.select("doc_id", "start", "n_tokens", "ids_crc32"))


