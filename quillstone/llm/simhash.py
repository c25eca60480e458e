"""Near-duplicates by SimHash fingerprints and multi-index hashing."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialise, utf8
from quillstone.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 3
HALF = 32  # bits of one of the two segments; with RADIUS 3 one segment differs by at most 1 bit
HEAVY = 100_000  # rows of one fingerprint from which its class is broadcast to them
HOT = 8192  # fingerprints with the same segment from which they are dealt over several tasks


def fingerprint(text: bytes) -> int:
    """Majority of the bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    import xxhash

    words = text.lower().split()  # bytes: lower() and split() know A-Z, space and 9 to 13 only
    if not words:
        return 0
    if len(words) < SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    total, n = np.zeros(64, np.int64), len(words) - SHINGLE + 1
    for at in range(0, n, 1 << 16):  # bounded memory on very long texts
        part = words[at : at + (1 << 16) + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(SHINGLE)), strict=False))
        h = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
        total += np.unpackbits(h.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            raw = data.tobytes()
            fp = np.fromiter((fingerprint(raw[off[i] : off[i + 1]]) for i in range(len(off) - 1)), np.uint64, len(off) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _spanning(a: np.ndarray, b: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Merges the links a[i]-b[i] into roots, in place."""
    while True:
        ra, rb = roots[a], roots[b]
        low, high = np.minimum(ra, rb), np.maximum(ra, rb)
        apart = low != high
        if not apart.any():
            return roots
        np.minimum.at(roots, high[apart], low[apart])
        while not np.array_equal(up := roots[roots], roots):
            roots = up


def links(classes: DataFrame) -> DataFrame:
    """Links (u, v) between distinct fingerprints at RADIUS bits or fewer, cut to a spanning forest in each task.

    classes: node, fp; fp unique. Each fingerprint is stored under the value of either 32-bit segment and asks for that
    value and the 32 values one bit away; 3 differing bits leave at most 1 in one segment, so every link is met. A
    segment value that more than HOT fingerprints share is dealt over several tasks: its stored fingerprints in parts,
    its questions to every part. There are 2 n / HOT such values at most, and their list is bounded by raising HOT.
    """
    spark = classes.sparkSession
    seg = F.explode(F.array(F.shiftrightunsigned("fp", HALF), F.col("fp").bitwiseAND(F.lit((1 << HALF) - 1)) + F.lit(1 << HALF)))
    counted = classes.select(seg.alias("key")).groupBy("key").count()
    n = classes.count()
    hot = max(HOT, 2 * n // 50_000)  # at most 50,000 keys can have more
    parts = {r["key"]: -(-r["count"] // hot) for r in counted.where(F.col("count") > hot).collect()}
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * 68 // 500_000)

    def deal(batches):
        flips = np.concatenate([[0], np.left_shift(np.uint64(1), np.arange(HALF, dtype=np.uint64))]).astype(np.uint64)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                node = batch.column(0).slice(at, 8192).to_numpy(zero_copy_only=False)
                fp = batch.column(1).slice(at, 8192).to_numpy(zero_copy_only=False).view(np.uint64)
                low = fp & np.uint64((1 << HALF) - 1)
                for s, value in ((0, fp >> np.uint64(HALF)), (1, low)):
                    base = np.uint64(s << HALF)
                    ask = (value[:, None] ^ flips[None, :]).ravel() + base
                    key = np.concatenate([value + base, ask]).view(np.int64)
                    who = np.concatenate([np.arange(len(fp)), np.repeat(np.arange(len(fp)), len(flips))])
                    asks = np.concatenate([np.zeros(len(fp), bool), np.ones(len(ask), bool)])
                    part = np.zeros(len(key), np.int32)
                    if parts:
                        size = np.fromiter((parts.get(k, 1) for k in key.tolist()), np.int64, len(key))
                        part[~asks] = (fp[who[~asks]] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)).astype(np.int64) % size[~asks]
                        more = np.repeat(np.arange(len(key)), np.where(asks, size, 1))
                        first = np.cumsum(np.where(asks, size, 1)) - np.where(asks, size, 1)
                        part = np.where(asks[more], np.arange(len(more)) - first[more], part[more]).astype(np.int32)
                        key, who, asks = key[more], who[more], asks[more]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(part), pa.array(asks), pa.array(node[who]), pa.array(fp[who].view(np.int64))],
                        ["key", "part", "asks", "node", "fp"],
                    )

    def match(batches):
        rows = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not rows:
            return
        t = pa.concat_tables(rows)
        key, part, asks, node, fp = (t.column(i).to_numpy() for i in range(5))
        fp = fp.view(np.uint64)
        names, code = np.unique(node, return_inverse=True)
        roots = np.arange(len(names))
        stored, asking = np.flatnonzero(~asks), np.flatnonzero(asks)
        stored = stored[np.lexsort((part[stored], key[stored]))]
        both = np.zeros(len(stored), dtype=[("k", "<i8"), ("p", "<i4")])
        both["k"], both["p"] = key[stored], part[stored]
        new = np.ones(len(stored), bool)
        new[1:] = both[1:] != both[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(stored))
        groups = both[first]
        want = np.zeros(len(asking), dtype=both.dtype)
        want["k"], want["p"] = key[asking], part[asking]
        # places of the questions among the groups, by a joint sort of their keys
        order = np.lexsort((np.concatenate([np.zeros(len(groups), np.int8), np.ones(len(want), np.int8)]), np.concatenate([groups["p"], want["p"]]), np.concatenate([groups["k"], want["k"]])))
        seen = np.cumsum(order < len(groups)) - 1
        at = np.empty(len(order), np.int64)
        at[order] = seen
        at = at[len(groups) :]
        ok = at >= 0
        ok[ok] = groups[at[ok]] == want[ok]
        asking, at = asking[ok], at[ok]
        sizes = last[at] - first[at]
        step, i = 1 << 21, 0
        while i < len(asking):  # pairs in portions of bounded size
            total = np.cumsum(sizes[i:])
            j = i + max(1, int(np.searchsorted(total, step, "right")))
            s = sizes[i:j]
            q = np.repeat(np.arange(i, j), s)
            r = stored[first[at[q]] + np.arange(len(q)) - np.repeat(np.cumsum(s) - s, s)]
            q = asking[q]
            near = np.bitwise_count(fp[q] ^ fp[r]) <= RADIUS
            a, b = code[q[near]], code[r[near]]
            roots = _spanning(a, b, roots)
            i = j
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        if len(moved):
            yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[roots[moved]])], ["u", "v"])

    dealt = classes.select("node", "fp").mapInArrow(deal, "key long, part int, asks boolean, node long, fp long")
    return dealt.repartition(tasks, "key", "part").mapInArrow(match, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of docs.

    Equal fingerprints form one class; links are found between classes. component_id is the smallest id reachable over
    links. Cases: null, empty or blank text has fingerprint zero and is linked like any other; repeated ids and rows are
    rows of their own; a null id takes part and is the smallest id only if its component has no other; an empty table
    gives no rows.
    """
    fps = materialise(fingerprints(docs, id_col, text_col), "fingerprints")
    lone = F.min(F.coalesce("doc_id", F.lit(2**63 - 1)))
    raw = fps.groupBy("fp").agg(lone.alias("least"), F.count(F.lit(1)).alias("n"))
    # a class is named by its fingerprint: ids may repeat
    classes = materialise(raw.withColumn("node", F.col("fp")), "classes")
    edges = materialise(links(classes), "links")
    found = components(edges)
    linked = classes.join(found, "node", "left").select("fp", "least", "n", F.coalesce("component", "node").alias("component"))
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named = linked.join(smallest, "component").select("fp", "n", F.expr("nullif(component_id, 9223372036854775807)").alias("component_id"))
    named = materialise(named, "named")
    # rows of a fingerprint that very many share stay where they are; there are rows / HEAVY such fingerprints at most
    heavy = F.broadcast(named.where(F.col("n") > HEAVY).drop("n"))
    light = fps.join(heavy, "fp", "left_anti").join(named.where(F.col("n") <= HEAVY).drop("n"), "fp")
    return fps.join(heavy, "fp").unionByName(light).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of all documents: 3-word shingles, links at 3 bits; cases as near_duplicates()."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
