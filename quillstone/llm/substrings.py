"""Removal of repeated substrings by a depth-limited radix sort of suffixes, most significant digit first.

Suffixes are ordered through LENGTH bytes only, in passes over growing digits. The digit of a suffix in a pass is its
least gram of 16, then 34, then 50 bytes (by a hash) among those within LENGTH bytes: neighbouring suffixes share it, so
a run of them travels as one record, with the bytes of the whole run as its second key. Runs equal in both are settled;
groups of one document end; only where runs with one digit differ do their suffixes go on to the next pass. The last
digit is the suffix's LENGTH bytes themselves, so the equal groups are exactly the repeated windows. Digits and runs are
compared by 88 bits of hashes together.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.common import byte_codes, materialise, mix, shared_dir, utf8

LENGTH = 50
DIGITS = (16, 34, 50)
PIECE = 1 << 20  # bytes of a text taken at once; longer texts are cut with LENGTH - 1 bytes of overlap
BLOCK = 1 << 21
FLUSH = 1_000_000  # records that a task compares among themselves before it sends them on
BUCKET = 1_000_000  # records for each bucket of the first digit, about
PLACE = np.uint64((1 << 22) - 1)
TEXT_BUCKET = 48_000_000  # bytes of text in a bucket of the table of texts
MOST_TEXT_BUCKETS = 50_000  # beyond, the buckets grow
MOST_FILES = 8192
MULTIPLIERS = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93)]


def grams(data: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` bytes (16, 34 or 50), and of all windows of LENGTH bytes, in two halves of places.

    The second is a pair (h16, h2) from which window_hash() takes what it needs.
    """
    g = byte_codes(1000 + seed)[data]
    a, b, c, d, e, f = MULTIPLIERS
    h2 = g[:-1] * a + g[1:]
    h4 = h2[:-2] * b + h2[2:]
    h8 = h4[:-4] * c + h4[4:]
    h16 = h8[:-8] * d + h8[8:]
    if size == 16:
        return h16, (h16, h2)
    out = h16[: len(data) - size + 1] * e + h16[16 : 16 + len(data) - size + 1]
    if size == 50:
        out = out * f + h16[32 : 32 + len(data) - size + 1]
    return out * e + h2[size - 2 : size - 2 + len(data) - size + 1], (h16, h2)


def window_hash(h16: np.ndarray, h2: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Hash of the 50 bytes (three grams of 16 and one of 2) from each place in s on."""
    e, f = MULTIPLIERS[4:]
    return mix(((h16[s] * e + h16[s + 16]) * f + h16[s + 32]) * e + h2[s + 48])


def runs(data: np.ndarray, off: np.ndarray, size: int, only: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(k1, k2, piece, start, n) of each run of windows with one least gram of `size` bytes.

    data holds pieces with offsets off; only: the windows that take part, by their starts.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(data) < LENGTH:
        return none
    valid = np.ones(len(data) - LENGTH + 1, bool)
    for o in off[1:-1]:
        valid[max(0, o - LENGTH + 1) : o] = False
    if only is not None:
        valid &= only[: len(valid)]
    s = np.flatnonzero(valid)
    if not len(s):
        return none
    h, (h16, h2) = grams(data, size)
    many, step = LENGTH - size + 1, 1
    low = (mix(h) & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    while 2 * step <= many:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if many > step:
        low = np.minimum(low[: step - many], low[many - step :])
    p = (low[s] & PLACE).astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)
    at = np.flatnonzero(new)
    first, last, p = s[at], s[np.append(at[1:], len(s)) - 1], p[at]
    if size == LENGTH:
        k2 = mix(grams(data, LENGTH, 1)[0][first])
    else:
        shape = ((p - first) * 64 + (last - first)).astype(np.uint64)
        k2 = mix(window_hash(h16, h2, first) * MULTIPLIERS[0] + window_hash(h16, h2, last) * MULTIPLIERS[2] + mix(shape + np.uint64(7)))
    k1 = mix(h[p] * MULTIPLIERS[3])
    return k1 >> np.uint64(16), k2 >> np.uint64(24), np.searchsorted(off, first, "right") - 1, first, last - first + 1


def _planes(x: np.ndarray, width: int) -> bytes:
    """The `width` low bytes of each number, bytes of equal weight together, which compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1)[:, :width].T).tobytes() if len(x) else b""


def _from_planes(raw: bytes, kind: str, width: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    out = np.zeros((len(raw) // width, size), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    return out.view(kind).ravel()


# name, type and bytes sent of each field; those of records known to be repeated have no digits
FIELDS = (("k1", "<u8", 6), ("k2", "<u8", 5), ("doc", "<i8", 8), ("start", "<i4", 4), ("n", "u1", 1), ("sure_doc", "<i8", 8), ("sure_start", "<i4", 4), ("sure_n", "u1", 1))
PACKED = "bucket int, " + ", ".join(f"{f} binary" for f, _, _ in FIELDS)


class Sender:
    """Collects records of a task and packs them by bucket of the first digit.

    Of records with equal digits only those of the least document go on; the others are known to be repeated. However many
    documents hold a passage, a bucket gets it at most once from each task's block of records.
    """

    def __init__(self, buckets: int, per_id: int):
        self.buckets, self.per_id, self.parts, self.n = buckets, per_id, [], 0

    def add(self, k1, k2, doc, start, n):
        if len(k1):
            self.parts.append((k1, k2, doc, start, n))
            self.n += len(k1)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self):
        if not self.n:
            return
        k1, k2, doc, start, n = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.n = [], 0
        sure = repeated(k1, k2, doc // self.per_id)[0]
        bucket = (k1 >> np.uint64(16)).astype(np.int64) * self.buckets >> 32
        bucket[sure] = np.arange(int(sure.sum())) * self.buckets // max(1, int(sure.sum()))
        order = np.argsort(bucket, kind="stable")
        present, first = np.unique(bucket[order], return_index=True)
        for b, x, y in zip(present.tolist(), first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
            rows = order[x:y]
            s, o = rows[sure[rows]], rows[~sure[rows]]
            cols = [k1[o], k2[o], doc[o], start[o], n[o], doc[s], start[s], n[s]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), *[pa.array([_planes(np.ascontiguousarray(c.astype(t)), w)], pa.binary()) for c, (_, t, w) in zip(cols, FIELDS, strict=True)]],
                ["bucket", *[f for f, _, _ in FIELDS]],
            )


def repeated(k1: np.ndarray, k2: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which records are in a document above the least one with both digits; which need the next digit.

    The latter: the others of groups of the first digit with several second digits and several documents.
    """
    order = np.lexsort((doc, k2, k1))
    a, b, d = k1[order], k2[order], doc[order]
    outer = np.ones(len(a), bool)
    outer[1:] = a[1:] != a[:-1]
    inner = outer.copy()
    inner[1:] |= b[1:] != b[:-1]
    least = d[np.flatnonzero(inner)][np.cumsum(inner) - 1]
    above = d > least
    at = np.flatnonzero(outer)
    group = np.cumsum(outer) - 1
    several = np.add.reduceat(inner.astype(np.int64), at) > 1
    several &= np.minimum.reduceat(d, at) < np.maximum.reduceat(d, at)
    out, more = np.zeros(len(a), bool), np.zeros(len(a), bool)
    out[order] = above
    more[order] = several[group] & ~above
    return out, more


def settle(packed: DataFrame, per_id: int) -> DataFrame:
    """uid, codes of all records that are repeated (code >= 0) or need the next digit (code < 0).

    A code is start * 256 + n, or its complement.
    """

    def run(table: pa.Table) -> pa.Table:
        cols = [np.concatenate([_from_planes(r.as_py(), t, w) for r in table.column(f)]) for f, t, w in FIELDS]
        k1, k2, doc, start, n, sd, ss, sn = cols
        del cols
        above, more = repeated(k1, k2, doc // per_id) if len(k1) else (np.zeros(0, bool), np.zeros(0, bool))
        code = start.astype(np.int64) * 256 + n
        uid = np.concatenate([doc[above], doc[more], sd])
        return pa.table({"uid": uid, "code": np.concatenate([code[above], ~code[more], ss.astype(np.int64) * 256 + sn])})

    flat = packed.groupBy("bucket").applyInArrow(run, "uid long, code long")
    return flat.groupBy("uid").agg(F.collect_list("code").alias("codes"))


def _pieces(data: np.ndarray, off: np.ndarray):
    """Blocks of pieces of texts: lists of (row, base, bytes)."""
    block, size = [], 0
    for row in range(len(off) - 1):
        for base in range(0, max(1, int(off[row + 1] - off[row]) - LENGTH + 1), PIECE):
            piece = data[off[row] + base : min(off[row + 1], off[row] + base + PIECE + LENGTH - 1)]
            if block and size + len(piece) > BLOCK:
                yield block
                block, size = [], 0
            block.append((row, base, piece))
            size += len(piece)
    if block:
        yield block


def _covered(size: int, codes: np.ndarray) -> np.ndarray:
    """Bytes covered by the windows of the given codes."""
    step = np.zeros(size + 1, np.int64)
    start, n = codes >> 8, codes & 255
    np.add.at(step, start, 1)
    np.add.at(step, start + n - 1 + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def _digest(text: np.ndarray, codes: np.ndarray) -> tuple[int, int, int, str]:
    gone = _covered(len(text), codes)
    edges = np.diff(gone.astype(np.int8), prepend=0)
    return len(text), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(text[~gone].tobytes()).hexdigest()


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def repeated_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of docs.

    Removes each byte covered by a string of LENGTH bytes that also starts in a document with a smaller id, judged on the
    input. Cases: null text is empty; texts shorter than LENGTH lose nothing; rows with one id are not smaller than each
    other and each is judged on its own text; a null id is smaller than all; an empty table gives no rows; other columns
    are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    size, ids, nulls, low, high = rows.agg(F.sum(F.octet_length("text")), F.count("doc_id"), F.count(F.when(F.col("doc_id").isNull(), 1)), F.min("doc_id"), F.max("doc_id")).first()
    plain = not nulls and rows.groupBy("doc_id").count().where("count > 1").isEmpty()
    per_id = 1
    if plain:
        rows = rows.withColumn("uid", F.col("doc_id"))
    else:  # rows with one id get numbers of their own, one for each text
        rows = rows.withColumn("th", F.xxhash64("text"))
        texts = rows.select("doc_id", "th").distinct().withColumn("place", F.row_number().over(Window.partitionBy("doc_id").orderBy("th")) - 1)
        texts = materialise(texts, "ids")
        per_id = int(texts.agg(F.max("place")).first()[0] or 0) + 1
        if max(abs(low or 0) + 1, abs(high or 0)) * per_id >= 2**62:
            raise ValueError("ids too large for so many texts of one id")
        number = F.coalesce("doc_id", F.lit((low or 0) - 1))
        texts = texts.select(number.alias("k"), "th", (number * per_id + F.col("place")).alias("uid"))
        rows = rows.withColumn("k", number).join(texts, ["k", "th"]).drop("k", "th")
    size = int(size or 0)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (17 * BUCKET)))
    texts = _by_uid(rows.select("doc_id", "uid", "text"), size)

    def digits(level: int):
        """Records of all windows, or in later passes of those that the pass before left open."""

        def run(batches):
            send = Sender(buckets, per_id)
            for b in batches:
                uid = b.column(0).to_numpy()
                starts = [~np.array(c.values)[np.array(c.values) < 0] for c in b.column(2)] if level else None
                for block in _pieces(*utf8(b.column(1))):
                    row, base = np.array([x[0] for x in block]), np.array([x[1] for x in block])
                    off = np.cumsum([0, *[len(x[2]) for x in block]])
                    only = None
                    if level:
                        step = np.zeros(off[-1] + 1, np.int64)
                        for r, at, o, e in zip(row.tolist(), base.tolist(), off[:-1].tolist(), off[1:].tolist(), strict=True):
                            lo = np.clip((starts[r] >> 8) - at, 0, e - o) + o
                            hi = np.clip((starts[r] >> 8) + (starts[r] & 255) - at, 0, e - o) + o
                            np.add.at(step, lo, 1)
                            np.add.at(step, hi, -1)
                        only = np.cumsum(step) > 0
                    k1, k2, piece, first, n = runs(np.concatenate([x[2] for x in block]), off, DIGITS[level], only)
                    yield from send.add(k1, k2, uid[row[piece]] if len(k1) else k1, first - off[piece] + base[piece] if len(k1) else k1, n)
            yield from send.flush()

        return run

    settled = []
    for level in range(len(DIGITS)):
        source = rows.select("uid", "text")
        if level:
            left = settled[-1].where(F.exists("codes", lambda c: c < 0))
            source = texts.join(left, "uid").select("uid", "text", "codes").dropDuplicates(["uid"]) if per_id > 1 else texts.join(left, "uid").select("uid", "text", "codes")
        settled.append(materialise(settle(source.mapInArrow(digits(level), PACKED), per_id), f"digit-{DIGITS[level]}"))
    found = settled[0].unionByName(settled[1]).unionByName(settled[2])
    found = found.select("uid", F.filter("codes", lambda c: c >= 0).alias("codes")).where(F.size("codes") > 0)
    found = found.groupBy("uid").agg(F.flatten(F.collect_list("codes")).alias("codes"))

    def conclude(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            out = []
            for i, c in enumerate(b.column(2)):
                out.append(_digest(data[off[i] : off[i + 1]], np.array(c.values) if c.is_valid else np.zeros(0, np.int64)))
            cols = [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return texts.join(found, "uid", "left").select("doc_id", "text", "codes").mapInArrow(conclude, f"doc_id long, {DIGEST}")


def _by_uid(rows: DataFrame, size: int) -> DataFrame:
    """A table of the texts in buckets of the uid in the shared folder, so that no later pass shuffles texts.

    Where as many tasks as read the input would write more than MOST_FILES files, texts are shuffled once before.
    """
    spark = rows.sparkSession
    n = min(MOST_TEXT_BUCKETS, max(8, -(-size // TEXT_BUCKET)))
    if rows.rdd.getNumPartitions() * n > MOST_FILES:
        rows = rows.repartition(n, "uid")
    name = f"qs_texts_{uuid.uuid4().hex[:12]}"
    rows.write.format("parquet").option("compression", "zstd").option("path", f"{shared_dir(spark)}/{name}").bucketBy(n, "uid").saveAsTable(name)
    out = spark.table(name)
    out.schema  # noqa: B018  resolves the table before its name goes
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return out


def op5_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of all documents; cases as repeated_substrings()."""
    return repeated_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
