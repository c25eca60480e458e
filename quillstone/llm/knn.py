"""Exact top-k by integer inner product: a KD-tree in each shard, best-first descent, a kth score handed from shard to shard."""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.common import materialise

SHARDS = 64  # shards of a table, until they reach MOST_ROWS
LEAST_ROWS, MOST_ROWS = 8_192, 262_144  # vectors of a shard
LEAF = 128
QUERY_BLOCK = 512
SLICE = 256  # query blocks that one task brings to one shard
SAMPLE = 20_000  # vectors from which the bounds of the shards are fitted
EXACT = 2.0**53  # doubles hold integers below it


def _packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpacked(raw: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(raw)))


def _small(v: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(v).max(initial=0)
    return v.astype(np.int8 if most < 2**7 else np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.float64)


def quantised(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their components floor(scale * x) as doubles, shorter vectors filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.array([len(v) if v.is_valid else -1 for v in column], np.int64)
    flat = column.flatten().cast(pa.float64())
    x = np.asarray(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
    width = int(sizes.max(initial=0))
    real = np.maximum(sizes, 0)
    row = np.repeat(np.arange(len(sizes)), real)
    place = np.arange(len(x)) - np.repeat(np.cumsum(real) - real, real)
    dense = np.zeros((len(sizes), width))
    with np.errstate(over="ignore"):
        dense[row, place] = scale * x
    ok = (sizes >= 0) & np.isfinite(dense).all(axis=1)
    return np.flatnonzero(ok), np.floor(dense[ok])


def _split(rows: np.ndarray) -> tuple[int, np.ndarray] | None:
    """Widest side of the box and an order of rows whose halves lie on either side of the median; None if all are equal."""
    wide = rows.max(0) - rows.min(0) if rows.size else np.zeros(0)
    if not wide.size or not wide.max() > 0:
        return None
    side = int(np.argmax(wide))
    return side, np.argpartition(rows[:, side], len(rows) // 2)


def build(ids: np.ndarray, v: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """Median splits at the widest side of the box down to `leaf` rows; tight boxes of all nodes.

    Nodes are numbered from the root, 0; left[i] < 0 marks a leaf of rows start[i] to end[i] of the reordered vectors.
    Rows that are all equal are cut in the middle, so that no leaf grows.
    """
    order = np.arange(len(ids))
    start, end, left, right, low, high = [0], [len(ids)], [-1], [-1], [], []
    i = 0
    while i < len(start):
        rows = v[order[start[i] : end[i]]]
        low.append(rows.min(0))
        high.append(rows.max(0))
        if len(rows) > leaf:
            cut = _split(rows)
            half = len(rows) // 2
            if cut is not None:
                order[start[i] : end[i]] = order[start[i] : end[i]][cut[1]]
            left[i], right[i] = len(start), len(start) + 1
            start += [start[i], start[i] + half]
            end += [start[i] + half, end[i]]
            left += [-1, -1]
            right += [-1, -1]
        i += 1
    nodes = {"start": start, "end": end, "left": left, "right": right}
    return {"ids": ids[order], "v": _small(v[order]), "low": np.array(low), "high": np.array(high)} | {k: np.array(x) for k, x in nodes.items()}


def _wide(a: np.ndarray, width: int) -> np.ndarray:
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Largest inner product of each query with any point of each box; no less, however large the components are."""
    out = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    size = np.abs(q) @ np.maximum(np.abs(low), np.abs(high)).T
    return np.where(size < EXACT, out, np.inf)


def scores(q: np.ndarray, v: np.ndarray, size: float) -> np.ndarray:
    """Inner products as exact integers: in floats while no sum can exceed what they hold, else in Python's integers."""
    if size < 2.0**24:
        return q.astype(np.float32) @ v.T.astype(np.float32)
    if size < EXACT:
        return q.astype(float) @ v.T.astype(float)
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)
    return whole(q.astype(float)) @ whole(v.astype(float)).T


def _best(q: np.ndarray, ids: np.ndarray, s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best hits of each query by falling score, then smaller id; and their places."""
    if s.dtype == object:
        order = np.array(sorted(range(len(q)), key=lambda i: (q[i], -s[i], ids[i])), np.int64)
    else:
        order = np.lexsort((ids, -s, q))
    q, ids, s = q[order], ids[order], s[order]
    first = np.flatnonzero(np.diff(q, prepend=-1))
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    keep = place < k
    return q[keep], ids[keep], s[keep], place[keep]


def search(tree: dict, q_ids: np.ndarray, q: np.ndarray, k: int, kth: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vec_id, score) of each query's k best in the tree with scores of kth[query] at least; ties to smaller ids.

    A block of queries descends together: a queue hands out the node with the highest bound of any query left. Queries
    whose bound of the node is below their kth score leave it; where none is left its whole subtree is cut. kth comes
    from other shards and rises with the hits.
    """
    ids, v, start, end, left, right = (tree[x] for x in ("ids", "v", "start", "end", "left", "right"))
    width = max(v.shape[1], q.shape[1])
    q, v, low, high = (_wide(m, width) for m in (q, v, tree["low"], tree["high"]))
    floor = kth.astype(float).copy()
    reach = float(np.sqrt((q * q).sum(1).max(initial=0)) * 1.000001)
    hits = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float64))
    root = bounds(q, low[:1], high[:1])[:, 0]
    queue = [(-root.max(initial=-np.inf), 0, np.arange(len(q)), root)]
    while queue:
        _, node, who, bound = heapq.heappop(queue)
        stay = bound >= floor[who]
        who = who[stay]
        if not len(who):
            continue
        if left[node] >= 0:
            both = [left[node], right[node]]
            of = bounds(q[who], low[both], high[both])
            for child, b in zip(both, of.T, strict=True):
                go = b >= floor[who]
                if go.any():
                    heapq.heappush(queue, (-b[go].max(), int(child), who[go], b[go]))
            continue
        rows = slice(start[node], end[node])
        own = v[rows].astype(float)
        score = scores(q[who], own, reach * float(np.sqrt((own * own).sum(1).max(initial=0))))
        x, y = np.nonzero(score >= floor[who][:, None])
        other = ids[rows][y] != q_ids[who][x]
        x, y = x[other], y[other]
        if not len(x):
            continue
        new = who[x], ids[rows][y], score[x, y].astype(object if score.dtype == object else np.float64)
        touched = np.zeros(len(q), bool)
        touched[new[0]] = True
        old = touched[hits[0]]
        top = _best(*(np.concatenate([o[old], n]) for o, n in zip(hits, new, strict=True)), k)
        last = top[3] == k - 1
        # a float just below a larger whole number never rules out an equal score
        full = top[2][last].astype(float)
        floor[top[0][last]] = np.maximum(floor[top[0][last]], np.where(np.abs(full) < EXACT, full, np.nextafter(full, -np.inf)))
        hits = tuple(np.concatenate([o[~old], n]) for o, n in zip(hits, top[:3], strict=True))
    return hits


def _cells(sample: np.ndarray, n: int) -> list[tuple]:
    """Bounds of n cells by median splits of a sample: nodes (side, threshold, left, right), or (cell,) for a cell."""
    nodes: list = [None]
    open_ = [(0, sample)]
    cells = 0
    while open_:
        at, rows = open_.pop(0)
        # open nodes and cells together make the n cells
        cut = _split(rows) if cells + len(open_) + 1 < n and len(rows) > 1 else None
        if cut is None:
            nodes[at] = (cells,)
            cells += 1
            continue
        side = cut[0]
        threshold = float(np.median(rows[:, side]))
        below = rows[:, side] < threshold
        if not below.any():
            threshold = float(rows[rows[:, side] > threshold, side].min())
            below = rows[:, side] < threshold
        nodes[at] = (side, threshold, len(nodes), len(nodes) + 1)
        open_ += [(len(nodes), rows[below]), (len(nodes) + 1, rows[~below])]
        nodes += [None, None]
    return nodes


def _cell_of(v: np.ndarray, nodes: list[tuple]) -> np.ndarray:
    out = np.zeros(len(v), np.int32)
    open_ = [(0, np.arange(len(v)))]
    while open_:
        at, rows = open_.pop()
        if len(nodes[at]) == 1:
            out[rows] = nodes[at][0]
            continue
        side, threshold, a, b = nodes[at]
        x = v[rows, side] if side < v.shape[1] else np.zeros(len(rows))
        open_ += [(a, rows[x < threshold]), (b, rows[x >= threshold])]
    return out


def _whole(s: np.ndarray) -> pa.Array:
    """Scores as longs; those beyond their range at its end."""
    most = 2**63 - 1
    return pa.array([max(-most - 1, min(most, int(x))) for x in s.tolist()], pa.int64())


HITS = "block long, place int, query_id long, vec_id long, score long"
ROUTES = "block long, shard int, slice int, queries binary"
STATE = "block long, queries binary"


def _hits(block: int, q_ids: np.ndarray, place: np.ndarray, found: tuple) -> pa.RecordBatch:
    who, ids, score = found
    cols = [pa.array(np.full(len(who), block, np.int64)), pa.array(place[who].astype(np.int32)), pa.array(q_ids[who]), pa.array(ids), _whole(score)]
    return pa.RecordBatch.from_arrays(cols, ["block", "place", "query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, *, k: int = 20, every: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each row whose id is divisible by `every`.

    Vectors are dealt into shards by the cells of a top tree (fitted on SAMPLE rows; a cell with more rows than a shard
    holds is dealt by the ids' hash), each a KD-tree. A block of queries first searches the shard it lies in. From then on
    it visits others in the order of their bounds, twice as many in each round, with the kth scores so far: shards whose
    box is below them are never visited, and only the queries that a shard may better travel to it. So trees move once a
    round, queries once a visit; what a task holds is one tree and one block. All scores are exact.

    Cases: null vectors and vectors with null or non-finite components (scaled ones too) take no part, neither do null
    ids; rows with equal ids are one query each and are never each other's neighbours; shorter vectors count as filled
    with zeros; equal vectors are ordered by id; scores beyond 64 bits count as the end of the
    range, in no order among each other; fewer than k candidates give fewer rows; an empty table gives none; other columns are left out.
    """
    spark = vectors.sparkSession
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vectors[vec_col].alias("vec")).where("id is not null")
    total = rows.count()
    size = min(MOST_ROWS, max(LEAST_ROWS, -(-total // SHARDS)))
    leaf, per_block, per_slice = LEAF, QUERY_BLOCK, SLICE
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(max(1, total // SAMPLE))) == 0).limit(2 * SAMPLE).select("vec")
    sample = quantised(some.toArrow().column("vec"), scale)[1]
    nodes = _cells(sample, max(1, min(4096, -(-total // size))))

    def deal(batches):
        for b in batches:
            ok, v = quantised(b.column(1), scale)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(ok)), b.column(1).take(pa.array(ok)), pa.array(_cell_of(v, nodes))], ["id", "vec", "cell"])

    kind = vectors.schema[vec_col].dataType.simpleString()
    dealt = rows.mapInArrow(deal, f"id long, vec {kind}, cell int")
    counts = {r["cell"]: r["count"] for r in dealt.groupBy("cell").count().collect()}  # one row a cell, 4096 at most
    first, at = {}, 0
    for cell, n in sorted(counts.items()):
        first[cell] = (at, -(-n // size))
        at += first[cell][1]
    n_shards = at
    if not n_shards:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    pairs = [F.lit(x) for cell, (a, n) in first.items() for x in (cell, a * 2**20 + n)]
    where = F.create_map(*pairs)[F.col("cell")] if len(pairs) > 2 else F.lit(first[next(iter(first))][0] * 2**20 + first[next(iter(first))][1])
    packed = where.cast("long")
    shard = (F.shiftright(packed, 20) + F.pmod(F.xxhash64("id"), packed.bitwiseAND(2**20 - 1))).cast("int")

    def pack(table: pa.Table) -> pa.Table:
        ok, v = quantised(table.column("vec"), scale)
        ids, own = table.column("id").to_numpy()[ok], int(table.column("shard")[0].as_py())
        tree = build(ids, v, leaf)
        asks = np.flatnonzero(tree["ids"] % every == 0)  # in the order of the leaves, so neighbours share a block
        blocks = [asks[i : i + per_block] for i in range(0, len(asks), per_block)]
        box = _packed(low=tree["low"][:1], high=tree["high"][:1])
        number = [own * 2**32 + i for i in range(len(blocks))]
        queries = [_packed(ids=tree["ids"][b], v=tree["v"][b], place=np.arange(len(b)), kth=np.full(len(b), -np.inf)) for b in blocks]
        rest = [None] * len(blocks)
        return pa.table({
            "shard": pa.array([own] * (1 + len(blocks)), pa.int32()), "tree": pa.array([_packed(**tree), *rest], pa.binary()),
            "box": pa.array([box, *rest], pa.binary()), "block": pa.array([None, *number], pa.int64()), "queries": pa.array([None, *queries], pa.binary()),
        })

    shaped = dealt.select("id", "vec", shard.alias("shard")).repartition(n_shards, "shard")
    built = materialise(shaped.groupBy("shard").applyInArrow(pack, "shard int, tree binary, box binary, block long, queries binary"), "trees")
    trees = built.where("tree is not null").select("shard", "tree")
    boxes = [(r["shard"], _unpacked(r["box"])) for r in built.where("box is not null").select("shard", "box").collect()]  # one box a shard
    boxes.sort(key=lambda r: r[0])
    width = max(b["low"].shape[1] for _, b in boxes)
    names = np.array([s for s, _ in boxes])
    low, high = (np.concatenate([_wide(b[x], width) for _, b in boxes]) for x in ("low", "high"))

    def visit(batches):
        """Rows sorted by shard and slice, the tree first: each block that follows searches it."""
        tree = None
        for b in batches:
            for i in range(b.num_rows):
                if b.column("tree")[i].is_valid:
                    tree = _unpacked(b.column("tree")[i].as_py())
                elif tree is not None:
                    q = _unpacked(b.column("queries")[i].as_py())
                    yield _hits(b.column("block")[i].as_py(), q["ids"], q["place"], search(tree, q["ids"], q["v"].astype(float), k, q["kth"]))

    def visits(routed: DataFrame) -> DataFrame:
        wanted = routed.select("shard", "slice").distinct()
        none = F.lit(None)
        both = trees.join(wanted, "shard").select("shard", "slice", "tree", none.cast("long").alias("block"), none.cast("binary").alias("queries"))
        both = both.unionByName(routed.select("shard", "slice", none.cast("binary").alias("tree"), "block", "queries"))
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_shards)
        ordered = both.repartition(tasks, "shard", "slice").sortWithinPartitions("shard", "slice", F.col("block").asc_nulls_first())
        return ordered.mapInArrow(visit, HITS)

    def best(hits: DataFrame) -> DataFrame:
        ranked = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)

    state = built.where("block is not null").select("block", "queries")
    home = state.select("block", F.shiftright("block", 32).cast("int").alias("shard"), F.lit(0).alias("slice"), "queries")
    found = materialise(best(visits(home)).drop("rank"), "hits-0")
    number, done = 0, 1
    while done < n_shards:
        many = 2**number

        def raised(table: pa.Table, hits: pa.Table) -> pa.Table:
            """The block with its queries' kth scores so far."""
            if not table.num_rows:
                return table
            q = _unpacked(table.column("queries")[0].as_py())
            place, score = hits.column("place").to_numpy(), hits.column("score").to_numpy()
            count = np.bincount(place, minlength=len(q["ids"]))
            least = np.full(len(q["ids"]), np.iinfo(np.int64).max)
            np.minimum.at(least, place, score)
            # scores at the end of the range may stand for others beyond it
            sure = (count >= k) & (np.abs(least.astype(float)) < EXACT)
            q["kth"] = np.where(sure, least.astype(float), -np.inf)
            return pa.table({"block": table.column("block"), "queries": pa.array([_packed(**q)], pa.binary())})

        def route(batches, done=done, many=many):
            for b in batches:
                for block, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    q = _unpacked(raw)
                    v = _wide(q["v"].astype(float), width)
                    reach = bounds(v, _wide(low, v.shape[1]), _wide(high, v.shape[1]))
                    # the order is by bounds alone, so that every round sees the same
                    order = np.lexsort((names, -reach.max(0), names != block >> 32))
                    to, out = order[done : done + many], []
                    for s in to.tolist():
                        live = reach[:, s] >= q["kth"]
                        if live.any():
                            out.append((block, int(names[s]), (block & 0xFFFFFFFF) // per_slice + (block >> 32) * 2**10 % 2**20, _packed(**{x: q[x][live] for x in ("ids", "v", "place", "kth")})))
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["block", "shard", "slice", "queries"])

        now = state.groupBy("block").cogroup(found.select("block", "place", "score").groupBy("block")).applyInArrow(raised, STATE)
        routed = materialise(now.mapInArrow(route, ROUTES), "routes")
        if not routed.isEmpty():
            found = materialise(best(found.unionByName(visits(routed))).drop("rank"), f"hits-{number + 1}")
        done += many
        number += 1
    return best(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""


def op9_kd_tree_top_k(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score of every 20th vector over all embeddings; cases as top_k()."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
