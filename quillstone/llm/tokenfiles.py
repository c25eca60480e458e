"""Token ids in seekable files: one zstandard frame for each document, a seek table with checksums at the end.

A file of bucket b, `tokens-<b>-<part>.tzs`, holds the frames of FILE_DOCS documents at most in ascending order of ids,
then two skippable frames: an index of documents (id, flag of a null id, number of tokens) and a seek table of the seekable zstandard format
(compressed size, size and xxh64 checksum of each frame; then the count, a descriptor and a magic number). A frame is the
document's ids as little-endian unsigned 32-bit integers. Readers fetch the tables from the end of the file and
decompress the frames they want only.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import finder, shared_dir

END_ID = 2
BUCKET_DOCS = 8192
MOST_BUCKETS = 32_768  # beyond, a bucket has more files
FILE_DOCS = 65_536  # documents of a file; the tables of one file are in memory at a time
READ_TASKS = 20_000  # tasks that read files, at most
LEVEL = 1
CACHE = 500_000  # pieces that a worker process keeps, over its tasks
_ENCODERS: dict[str, Encoder] = {}
# Fixed values of the format
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A5D, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
SEEK_ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
DOC_ENTRY = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("tokens", "<u4")])


def plain(text: str) -> bool:
    """Whether normal form and lower case of each character are its own."""
    try:
        text.encode("latin-1")  # quick, and true of most
        return True
    except UnicodeEncodeError:
        return max(text) < "\u0250" and "\u0130" not in text


class Encoder:
    """Ids of texts by a tokenizer that drops white space.

    Texts are lower-cased and cut by the tokenizer's own pattern into pieces, which are kept; pieces not seen before go to
    the tokenizer's model, their bytes written in its signs. Where normal form or lower case of a
    character could depend on its neighbours (from U+0250 on, and U+0130), the tokenizer gets the text's words between
    ASCII blanks as they are, each word once: such blanks are white space to it and always split words.
    """

    def __init__(self, tokenizer_json: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.known, self.pieces = Tokenizer.from_str(tokenizer_json), {}, {}
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        conf = json.loads(tokenizer_json)
        split, level = conf["pre_tokenizer"]["pretokenizers"]
        if (split["type"], level["type"]) != ("Split", "ByteLevel") or level["add_prefix_space"] or level["use_regex"]:
            raise ValueError("a tokenizer with a pattern, then bytes, is wanted")
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0x250)}
        self.find = finder(split["pattern"]["Regex"])

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, pieces: set[str]) -> None:
        tokenize, signs = self.tokenizer.model.tokenize, self.signs
        for x in pieces:
            if x not in self.pieces:
                if max(x) < "\u0250":
                    self.pieces[x] = array("I", [t.id for t in tokenize(x.translate(signs))]).tobytes()
                else:
                    self.pieces[x] = self.whole(x)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        for cache in (self.known, self.pieces):
            if len(cache) > CACHE:
                cache.clear()
        known, pieces, cut = self.known, self.pieces, []
        for text in texts:
            if any(s in text for s in self.specials):  # such a string may hold blanks
                cut.append(None)
            elif plain(text):
                cut.append(self.find(text.lower()))
            else:
                cut.append(text.encode().split())
                for w in set(cut[-1]) - known.keys():
                    known[w] = self.whole(w.decode())
        self.learn({x for parts in cut if parts and isinstance(parts[0], str) for x in parts})
        out = []
        for text, parts in zip(texts, cut, strict=True):
            if parts is None:
                raw = self.whole(text)
            else:
                raw = b"".join(map((pieces if parts and isinstance(parts[0], str) else known).__getitem__, parts))
            out.append(np.append(np.frombuffer(raw, "<u4"), np.uint32(END_ID)).astype("<u4"))
        return out


def encoder_of(tokenizer_json: str) -> Encoder:
    """The worker process's encoder, which keeps its pieces for the tasks that run there later."""
    if tokenizer_json not in _ENCODERS:
        _ENCODERS[tokenizer_json] = Encoder(tokenizer_json)
    return _ENCODERS[tokenizer_json]


def footer(docs: np.ndarray, frames: np.ndarray) -> bytes:
    index = struct.pack("<II", SKIPPABLE_INDEX, docs.nbytes) + docs.tobytes()
    seek = frames.tobytes() + struct.pack("<IBI", len(frames), CHECKSUMS, SEEKABLE)
    return index + struct.pack("<II", SKIPPABLE_SEEK, len(seek)) + seek


class Reader:
    """Random access to one file: tables from its end, then single documents."""

    def __init__(self, file):
        self.file, size = file, file.size()
        file.seek(size - 9)
        count, descriptor, magic = struct.unpack("<IBI", file.read(9))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError("not a seekable file")
        seek_bytes, index_bytes = count * SEEK_ENTRY.itemsize, count * DOC_ENTRY.itemsize
        file.seek(size - 9 - seek_bytes - 8 - index_bytes - 8)
        raw = file.read(8 + index_bytes + 8 + seek_bytes)
        if struct.unpack_from("<II", raw) != (SKIPPABLE_INDEX, index_bytes) or struct.unpack_from("<II", raw, 8 + index_bytes) != (SKIPPABLE_SEEK, seek_bytes + 9):
            raise ValueError("tables do not fit")
        self.docs = np.frombuffer(raw, DOC_ENTRY, count, 8)
        self.frames = np.frombuffer(raw, SEEK_ENTRY, count, 16 + index_bytes)
        self.at = np.concatenate([[0], np.cumsum(self.frames["packed"].astype(np.int64))])

    def ids(self, i: int) -> np.ndarray:
        """Ids of the i-th document of the file; reads and decompresses its frame only."""
        import xxhash
        import zstandard

        self.file.seek(int(self.at[i]))
        raw = zstandard.ZstdDecompressor().decompress(self.file.read(int(self.frames["packed"][i])), max_output_size=int(self.frames["size"][i]))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames["check"][i]:
            raise ValueError(f"checksum of frame {i}")
        return np.frombuffer(raw, "<u4")

    def of(self, doc_id: int) -> np.ndarray:
        rows = np.flatnonzero((self.docs["doc_id"] == doc_id) & (self.docs["is_null"] == 0))
        if not len(rows):
            raise KeyError(doc_id)
        return self.ids(int(rows[0]))


def write(docs: DataFrame, tokenizer_json: str, *, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes the files; returns bucket, path, docs, tokens of each; by bucket and path they are in ascending order.

    Bounds of the buckets are percentiles of the ids, one bucket for about BUCKET_DOCS documents, MOST_BUCKETS at most. Texts are encoded and
    compressed before the shuffle, so frames travel, not texts. A file is written under a name of its own and then
    renamed, so a task that is run again, or twice, leaves whole files.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex[:12]}"
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    n = rows.count()
    cuts = min(MOST_BUCKETS, max(1, -(-n // BUCKET_DOCS)))
    quantiles = [i / cuts for i in range(1, cuts)]
    bounds = rows.agg(F.percentile_approx("doc_id", quantiles, 100_000)).first()[0] if quantiles else []
    bounds = np.array(sorted(set(bounds or [])), np.int64)

    def pack(batches):
        import xxhash
        import zstandard

        encoder, zip_ = encoder_of(tokenizer_json), zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        for b in batches:
            for at in range(0, b.num_rows, 128):
                ids = b.column(0).slice(at, 128)
                null = np.array([not x.is_valid for x in ids])
                number = ids.fill_null(0).to_numpy()
                bucket = np.where(null, 0, np.searchsorted(bounds, number, "right")).astype(np.int32)
                raw = [x.tobytes() for x in encoder.encode(b.column(1).slice(at, 128).to_pylist())]
                cols = [pa.array(bucket), pa.array(null), pa.array(number), pa.array([zip_.compress(r) for r in raw], pa.binary()), pa.array([len(r) for r in raw], pa.int64()), pa.array([xxhash.xxh64_intdigest(r) & 0xFFFFFFFF for r in raw], pa.int64())]
                yield pa.RecordBatch.from_arrays(cols, ["bucket", "is_null", "doc_id", "frame", "size", "check"])

    def save(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        now = out = None
        entries, docs_, sums, part = [], [], [], 0

        def close():
            frames = np.array(entries, SEEK_ENTRY)
            out.write(footer(np.array(docs_, DOC_ENTRY), frames))
            out.close()
            name = f"tokens-{now:06d}-{part:08d}.tzs"
            store.move(draft, f"{base}/{name}")
            sums.append((now, name, len(entries), int(frames["size"].astype(np.int64).sum()) // 4))

        for b in batches:
            for bucket, null, number, frame, size, check in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                if bucket != now or len(entries) >= FILE_DOCS:
                    if now is not None:
                        close()
                    part = part + 1 if bucket == now else 0
                    now, entries, docs_ = bucket, [], []
                    draft = f"{base}/.draft-{bucket:06d}-{uuid.uuid4().hex}"
                    out = store.open_output_stream(draft)
                out.write(frame)
                entries.append((len(frame), size, check))
                docs_.append((number, null, size // 4))
        if now is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in sums], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64(), pa.int64()))], ["bucket", "path", "docs", "tokens"])

    packed = rows.mapInArrow(pack, "bucket int, is_null boolean, doc_id long, frame binary, size long, check long")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(bounds) + 1)
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket", F.desc("is_null"), "doc_id", "check")
    saved = dealt.mapInArrow(save, "bucket int, path string, docs long, tokens long").collect()  # one small row for each file
    listing = [(r["bucket"], f"{folder}/{r['path']}", r["docs"], r["tokens"]) for r in sorted(saved)]
    return spark.createDataFrame(listing, "bucket int, path string, docs long, tokens long")


def read(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    listing = files.orderBy("bucket", "path").collect()  # one row for each file
    starts, total = [], 0
    for r in listing:
        starts.append((r["path"], total))
        total += r["tokens"]
    spark = files.sparkSession

    def load(batches):
        from pyarrow import fs

        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    r = Reader(file)
                    crc = [zlib.crc32(r.ids(i).tobytes()) for i in range(len(r.docs))]
                n = r.docs["tokens"].astype(np.int64)
                ids = pa.array(r.docs["doc_id"], mask=r.docs["is_null"].astype(bool))
                yield pa.RecordBatch.from_arrays([ids, pa.array(start + np.cumsum(n) - n), pa.array(n), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    shape = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not starts:
        return spark.createDataFrame([], shape)
    return spark.createDataFrame(starts, "path string, start long").repartition(min(READ_TASKS, len(starts)), "path").mapInArrow(load, shape)


def op6_seekable_token_files(spark, sf_dir: str) -> DataFrame:
    """Cases: null and empty texts are the end id alone; a null id comes first; repeated ids are ordered by their checksum."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        tokenizer = f.read()
    return read(write(spark.read.parquet(f"{sf_dir}/documents.parquet"), tokenizer))
