"""Helpers shared by the corpus operators: the shared folder, Arrow text buffers and vectorised hashing."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors see: spark.checkpoint.dir, or in local mode a temporary one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "dir" not in _LOCAL:
            _LOCAL["dir"] = tempfile.mkdtemp(prefix="quillstone-")
            atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
        base = f"file://{_LOCAL['dir']}"
    return f"{base.rstrip('/')}/quillstone-{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Cuts the lineage: writes df as Parquet to the shared folder and reads it back; lost executors lose none of it."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an Arrow string column in a row, and their n + 1 offsets; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents with at most `limit` bytes together, or one longer document."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (multiply and shift)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def latin_findall(pattern: str) -> Callable[[str], list[str]] | None:
    """findall of a pattern for texts below U+0100 alone: the standard engine, quicker, with the classes of `regex` spelt out.

    None if the pattern has other escapes than \\p{L}, \\p{N}, \\s and \\S.
    """
    import re

    import regex

    def members(escape: str) -> str:
        return "".join(f"\\x{c:02x}" for c in range(256) if regex.fullmatch(escape, chr(c)))

    known = {e: members(e) for e in (r"\p{L}", r"\p{N}", r"\s")}
    out, inside, at = [], False, 0
    while at < len(pattern):
        escape = next((e for e in (*known, r"\S") if pattern.startswith(e, at)), None)
        if escape == r"\S" and not inside:
            out.append(f"[^{known[chr(92) + 's']}]")
        elif escape in known:
            out.append(known[escape] if inside else f"[{known[escape]}]")
        elif escape or pattern[at] == chr(92):
            return None
        else:
            out.append(pattern[at])
            inside = pattern[at] == "[" or (inside and pattern[at] != "]")
        at += len(escape or " ")
    return re.compile("".join(out)).findall


def finder(pattern: str) -> Callable[[str], list[str]]:
    """All matches of a pattern in a text, by the quicker engine where it gives the same."""
    import regex

    every, quick = regex.compile(pattern).findall, latin_findall(pattern)

    def find(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return every(text)
        return quick(text)

    return find if quick else every


def byte_codes(seed: int) -> np.ndarray:
    """A fixed random 64-bit code for each of 256 bytes."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def string_column(df: DataFrame, name: str) -> Column:
    return df[name].cast("string")
