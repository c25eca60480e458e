"""Near copies by the Jaccard similarity of word shingles: SimHash links first, an exact prefix-filtered join for the rest."""

from __future__ import annotations

from functools import reduce
from itertools import repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialise, utf8
from quillstone.llm.components import components
from quillstone.llm.simhash import SEED, links

SHINGLE = 5
SIMILARITY = 0.8
SAMPLE = 8192  # documents from which frequent shingles are told; they only come last in the order, whatever the sample
FREQUENT = 4
MOST = 200_000
STEP = 1 << 21
LEAST_BITS, MOST_BITS = 1 << 10, 1 << 17  # of the parity sketch of a set; between them some four for each shingle
MANY = 32  # nodes of a shingle from which its pairs are tested by their sketches where they meet
PART = 2048  # nodes of such a shingle that one task compares with as many others
ROWS = "kind int, key long, node long, size int, pos int, many int"
NONE = 2**63 - 1


def hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 of all word shingles, repeats included; a shorter text is one shingle, none without words."""
    import xxhash

    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64)


def least_common(total: np.ndarray | int, similarity: float) -> np.ndarray:
    """Fewest common shingles of two sets of `total` shingles together at that similarity."""
    return np.ceil(similarity / (1 + similarity) * total - 1e-9)


def sketch(own: np.ndarray) -> bytes:
    """Parities of the hashes that fall on each bit: two sketches differ in no more bits than their sets in hashes."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (4 * len(own)).bit_length()))
    return np.packbits(np.bincount((own >> np.uint64(17)).astype(np.int64) % bits, minlength=bits).astype(np.uint8) & 1).tobytes()


def folded(raw: bytes, size: int) -> np.ndarray:
    """A sketch folded to `size` bytes, which keeps what it says: bits that fall together add up to their parity."""
    out = np.frombuffer(raw, np.uint8)
    while len(out) > size:
        half = len(out) // 2
        out = out[:half] ^ out[half:]
    return out


def may_be_similar(a: bytes, b: bytes, sizes: int, similarity: float) -> bool:
    width = min(len(a), len(b))
    apart = int(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum(dtype=np.int64))
    return apart <= sizes - 2 * least_common(sizes, similarity)


def _frequent(texts: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample, sorted, and their counts."""

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(0))
            raw = data.tobytes()
            for i in range(len(off) - 1):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes(raw[off[i] : off[i + 1]], shingle)).view(np.int64))], ["key"])

    n = texts.count()
    some = texts.sample(min(1.0, SAMPLE / max(1, n)), seed=7).mapInArrow(run, "key long")
    rows = some.groupBy("key").count().where(F.col("count") >= FREQUENT).orderBy(F.desc("count")).limit(MOST).collect()
    keys, counts = np.array([r["key"] for r in rows], np.int64).view(np.uint64), np.array([r["count"] for r in rows], np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def _signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: float) -> DataFrame:
    """doc_id, node (hash of the set of shingles), fp (SimHash), size, prefix (first shingles in the common order), sketch, text."""
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    frequent, counts = _frequent(rows.select("text"), shingle)

    def run(batches):
        import xxhash

        for b in batches:
            data, off = utf8(b.column(1))
            raw, out = data.tobytes(), ([], [], [], [], [])
            for i in range(len(off) - 1):
                h = hashes(raw[off[i] : off[i + 1]], shingle)
                bits = np.zeros(64, np.int64)
                for at in range(0, len(h), 1 << 16):
                    bits += np.unpackbits(h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
                own = np.unique(h)
                rank = np.zeros(len(own), np.int64)
                if len(frequent):
                    place = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
                    rank = np.where(frequent[place] == own, counts[place], 0)
                n = len(own)
                first = own[np.lexsort((own, rank))][: n - ceil(similarity * n - 1e-9) + 1 if n else 0]
                out[0].append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
                out[1].append(int.from_bytes(np.packbits(2 * bits > len(h)).tobytes(), "big"))
                out[2].append(n)
                out[3].append(first.view(np.int64))
                out[4].append(sketch(own))
            long = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            ends = np.cumsum([0, *map(len, out[3])]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *out[3]])))
            yield pa.RecordBatch.from_arrays([b.column(0), long(out[0]), long(out[1]), pa.array(out[2], pa.int32()), prefix, pa.array(out[4], pa.binary()), b.column(1)], ["doc_id", "node", "fp", "size", "prefix", "sketch", "text"])

    return rows.mapInArrow(run, "doc_id long, node long, fp long, size int, prefix array<long>, sketch binary, text string")


def _table(batches) -> list[np.ndarray]:
    """Columns of all batches of a task, none if there are no rows."""
    rows = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
    return [c.to_numpy() for c in pa.concat_tables(rows).columns] if rows else []


def _possible(size, pos, a, b, similarity: float) -> np.ndarray:
    """Whether a and b can be similar if this shingle is their first common one; true for every similar pair there."""
    more = np.minimum(size[a] - pos[a], size[b] - pos[b])
    return more >= least_common(size[a].astype(np.int64) + size[b], similarity)


def _unique(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)], 1), axis=0)


def _as_batch(both: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))], ["u", "v"])


def _pairs(node, a, b) -> pa.RecordBatch:
    return _as_batch(_unique(node[a], node[b]))


def _shared(similarity: float):
    """Postings of shingles that two nodes or more have, each once (kind 0), and a few pairs of each shingle: with its
    least node, and neighbours in size (kind 1; key and node are the pair)."""

    def run(batches):
        if not (t := _table(batches)):
            return
        order = np.lexsort((t[1], t[0]))
        key, node, size, pos = (c[order] for c in t)
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        key, node, size, pos = key[new], node[new], size[new], pos[new]
        start = np.append(True, key[1:] != key[:-1])
        group = np.cumsum(start) - 1
        many = np.bincount(group)[group]
        some = many > 1
        key, node, size, pos, many = key[some], node[some], size[some], pos[some], many[some]
        zero = np.zeros(len(key), np.int32)
        yield _rows(zero, key, node, size, pos, many)
        for by in (node, size):
            order = np.lexsort((node, by, key))
            k = key[order]
            new = np.append(True, k[1:] != k[:-1])[: len(k)]
            first = np.flatnonzero(new)[np.cumsum(new) - 1] if by is node else np.arange(len(k)) - 1
            b = np.flatnonzero(~new)
            a, b = order[first[b]], order[b]
            ok = _possible(size, pos, a, b, similarity)
            if ok.any():
                pairs = _unique(node[a[ok]], node[b[ok]])
                none = np.zeros(len(pairs), np.int32)
                yield _rows(none + 1, pairs[:, 0], pairs[:, 1], none, none, none)

    return run


def _rows(kind, key, node, size, pos, many) -> pa.RecordBatch:
    small = (pa.array(x.astype(np.int32)) for x in (size, pos, many))
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(key), pa.array(node), *small], ["kind", "key", "node", "size", "pos", "many"])


def _few(similarity: float):
    """All pairs of a shingle of MANY nodes at most whose components differ and whose similarity is possible."""

    def run(batches):
        if not (t := _table(batches)):
            return
        order = np.lexsort((t[4], t[0]))
        key, node, size, pos, comp = (c[order] for c in t)
        at = np.arange(len(key))
        end = lambda new: np.append(np.flatnonzero(new)[1:], len(at))[np.cumsum(new) - 1]
        other = np.append(True, key[1:] != key[:-1])
        start = end(other | np.append(True, comp[1:] != comp[:-1]))
        count = end(other) - start
        total = np.cumsum(count)
        i = 0
        while i < len(at):  # pairs in portions of bounded size
            base = total[i] - count[i]
            j = max(i + 1, int(np.searchsorted(total, base + STEP, "right")))
            n = count[i:j]
            a = np.repeat(at[i:j], n)
            b = np.repeat(start[i:j], n) + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            ok = _possible(size, pos, a, b, similarity)
            if ok.any():
                yield _pairs(node, a[ok], b[ok])
            i = j

    return run


def _many(similarity: float):
    """Pairs of a shingle of more nodes, from one or two of its parts: only those whose sketches allow it leave the task.

    Rows come sorted by key, low and high part; columns: key, low, high, part, node, size, pos, component, sketch.
    """

    def pairs_of(rows: list) -> np.ndarray:
        part, node, size, pos, comp = (np.array([r[k] for r in rows], np.int64) for k in range(5))
        raw = [r[5] for r in rows]
        width = min(map(len, raw))
        bits = np.stack([folded(x, width) for x in raw]).view(np.uint64)
        two = part.min() != part.max()
        out = [np.zeros((0, 2), np.int64)]
        for i in range(len(rows)):
            b = np.flatnonzero(part > part[i]) if two else np.arange(i + 1, len(rows))
            b = b[comp[b] != comp[i]]
            b = b[_possible(size, pos, i, b, similarity)]
            if not len(b):
                continue
            sizes = size[b] + size[i]
            near = b[np.bitwise_count(bits[b] ^ bits[i]).sum(1, dtype=np.int64) <= sizes - 2 * least_common(sizes, similarity)]
            near = [j for j in near.tolist() if may_be_similar(raw[i], raw[j], int(size[i] + size[j]), similarity)] if width < max(map(len, raw)) else near
            if len(near):
                out.append(_unique(np.full(len(near), node[i]), node[near]))
        return np.concatenate(out)

    def run(batches):
        now, rows = None, []
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(9)]
            for row in zip(*cols, strict=True):
                if row[:3] != now:
                    if len(rows) > 1:
                        yield _as_batch(pairs_of(rows))
                    now, rows = row[:3], []
                rows.append(row[3:])
        if len(rows) > 1:
            yield _as_batch(pairs_of(rows))

    return run


def _verified(pairs: DataFrame, rows: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Pairs (u, v) whose sets of shingles are that similar."""

    def run(batches):
        last, own = None, None
        for b in batches:
            (left, lo), (right, ro) = utf8(b.column(2)), utf8(b.column(3))
            left, right = left.tobytes(), right.tobytes()
            ok = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                text = left[lo[i] : lo[i + 1]]
                if text != last:
                    last, own = text, np.unique(hashes(text, shingle))
                other = np.unique(hashes(right[ro[i] : ro[i + 1]], shingle))
                common = len(np.intersect1d(own, other, assume_unique=True))
                ok[i] = common >= least_common(len(own) + len(other), similarity)
            yield pa.RecordBatch.from_arrays([b.column(k).filter(pa.array(ok)) for k in (0, 1)], ["u", "v"])

    def close(batches):
        for b in batches:
            total = b.column(2).to_numpy().astype(np.int64) + b.column(3).to_numpy()
            sketches = zip(b.column(4).to_pylist(), b.column(5).to_pylist(), total.tolist(), strict=True)
            ok = pa.array([may_be_similar(x, y, n, similarity) for x, y, n in sketches], pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(k).filter(ok) for k in (0, 1)], ["u", "v"])

    pairs = pairs.where("u <> v").distinct()
    known = rows.select("node", "size", "sketch").dropDuplicates(["node"])
    drawn = pairs.join(known.toDF("u", "m", "a"), "u").join(known.toDF("v", "n", "b"), "v").select("u", "v", "m", "n", "a", "b")
    pairs = materialise(drawn.mapInArrow(close, "u long, v long"), "candidates")
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    texts = materialise(rows.select("node", "text").join(nodes, "node", "left_semi").dropDuplicates(["node"]), "texts")
    both = pairs.join(texts.toDF("u", "a"), "u").join(texts.toDF("v", "b"), "v").select("u", "v", F.coalesce("a", F.lit("")).alias("a"), F.coalesce("b", F.lit("")).alias("b"))
    return materialise(both.mapInArrow(run, "u long, v long"), "similar")


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, component_id, text_hash, component of every row of docs; links are all pairs with a Jaccard similarity of `similarity` or more.

    Texts with one set of shingles form one class. SimHash links and a few pairs of each shingle are verified first, so
    that large groups are joined by few pairs; then all pairs of classes still apart that share one of the first
    n - ceil(similarity n) + 1 shingles in a common order are verified, where more than MANY share it only those that
    their parity sketches (an exact bound) allow. Similar sets always share one of these, so none
    is missed. component_id is the smallest id reachable over links; text_hash (XXH64 of the text) tells rows of one id
    apart, component names the component. Cases: null, empty and blank texts are one class;
    repeated ids and rows are rows of their own; a null id is the smallest only if its component has no other; an empty
    table gives no rows.
    """
    if not 0 < similarity <= 1:
        raise ValueError("similarity above 0, 1 at most")
    rows = materialise(_signatures(docs, id_col, text_col, shingle, similarity), "signatures")
    spark = docs.sparkSession
    listed = rows.select("node", "size", F.posexplode("prefix").alias("pos", "key")).select("key", "node", "size", "pos")
    prefixes = rows.agg(F.sum(F.size("prefix"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), prefixes // 1_000_000)
    met = materialise(listed.repartition(tasks, "key").mapInArrow(_shared(similarity), ROWS), "postings")
    postings = met.where("kind = 0").drop("kind")
    classes = materialise(rows.groupBy("node").agg(F.min("fp").alias("fp"), F.min(F.coalesce("doc_id", F.lit(NONE))).alias("least")), "classes")

    few = met.where("kind = 1").select(F.col("key").alias("u"), F.col("node").alias("v"))
    found = [_verified(links(classes).union(few), rows, shingle, similarity)]
    near = components(found[0])
    apart = postings.join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
    cold = apart.where(F.col("many") <= MANY).select("key", "node", "size", "pos", "component")
    rest = cold.repartition(tasks, "key").mapInArrow(_few(similarity), "u long, v long")
    sketches = rows.select("node", "sketch").dropDuplicates(["node"])
    parts = F.ceil(F.col("many") / PART).cast("int")
    hot = apart.where(F.col("many") > MANY).withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
    hot = hot.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1))).join(sketches, "node")
    hot = hot.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node", "size", "pos", "component", "sketch")
    dealt = hot.repartition(tasks, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    rest = rest.union(dealt.mapInArrow(_many(similarity), "u long, v long"))
    found.append(_verified(rest, rows, shingle, similarity))

    named = components(reduce(DataFrame.union, found))
    linked = classes.join(named, "node", "left").select("node", "least", F.coalesce("component", "node").alias("component"))
    smallest = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = linked.join(smallest, "component").select("node", "component", F.expr(f"nullif(component_id, {NONE})").alias("component_id"))
    named = rows.select("doc_id", "node", text_hash("text").alias("text_hash"))
    return named.join(ids, "node").select("doc_id", "component_id", "text_hash", "component")


def representatives(copies: DataFrame) -> DataFrame:
    """doc_id, text_hash of the row that stands for each component: the smallest id (null last), then the smallest hash."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("r")
    return copies.groupBy("component").agg(first).select("r.doc_id", "r.text_hash")


def text_hash(text: str):
    """Of a text column; null counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))
