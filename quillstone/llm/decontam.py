"""Benchmark decontamination by greedy string tiling: shared-token seeds, longest matches by running Karp-Rabin, coverage."""

from __future__ import annotations

import heapq
from collections import defaultdict
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import blocks, byte_codes, mix

MATCH = 5  # tokens of the shortest tile
COVERAGE = 0.5  # of an item's tokens, from which a document is taken to hold it
ITEM_BLOCK = 32_000_000  # bytes of benchmark text that go to all tasks at once
BLOCK = 1 << 21
PAIRS = 1 << 20
BASE = 911_382_323_371


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts and offsets of texts: lower-cased runs of ASCII letters, digits and other scripts."""
    raw = "\n".join([t.lower() for t in texts]).encode() + b"\n"
    data = np.frombuffer(raw, np.uint8)
    table = np.zeros(256, bool)
    table[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    inside = table[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sizes = np.fromiter((len(t.lower().encode()) + 1 for t in texts), np.int64, len(texts))
    off = np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))
    if not len(start):
        return np.zeros(0, np.uint64), off
    at = np.flatnonzero(inside)
    place = at - np.repeat(start, end - start)
    code = byte_codes(77)[data[at]] * mix((place & 4095).astype(np.uint64) * np.uint64(2) + np.uint64(1))
    return mix(np.add.reduceat(code, np.cumsum(end - start) - (end - start)) + (end - start).astype(np.uint64)), off


def seeds(tok: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n tokens."""
    h = np.zeros(max(0, len(tok) - n + 1), np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + tok[i : i + len(h)]
    return mix(h)


def _rolled(codes: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of n codes, from running sums modulo 2 ** 64."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    up = np.cumprod(np.full(len(codes), BASE, np.uint64))
    down = np.cumprod(np.full(len(codes), pow(BASE, -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes.astype(np.uint64) * down)])
    return mix((sums[n:] - sums[:-n]) * up[: len(codes) - n + 1])


def _maximal(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """(-length, place in a, place in b) of all matches of n codes or more that no side can extend.

    Places with one hash are compared in portions of PAIRS; those whose codes before them agree belong to a longer match
    and are passed over, so a long repetition is one match for each of its diagonals.
    """
    of_a, of_b = _rolled(a, n), _rolled(b, n)
    order = np.argsort(of_a, kind="stable")
    sorted_a = of_a[order]
    low, high = np.searchsorted(sorted_a, of_b), np.searchsorted(sorted_a, of_b, "right")
    hit = np.flatnonzero(high > low)
    count = (high - low)[hit]
    total = np.cumsum(count)
    out: list[tuple[int, int, int]] = []
    x = 0
    while x < len(hit):
        y = max(x + 1, int(np.searchsorted(total, total[x] - count[x] + PAIRS, "right")))
        m = count[x:y]
        j = np.repeat(hit[x:y], m)
        i = order[np.repeat(low[hit[x:y]], m) + np.arange(len(j)) - np.repeat(np.cumsum(m) - m, m)]
        first = (i == 0) | (j == 0) | (a[i - 1] != b[j - 1])
        i, j = i[first], j[first]
        size, live = np.zeros(len(i), np.int64), np.arange(len(i))
        while len(live):
            at_i, at_j = i[live] + size[live], j[live] + size[live]
            inside = (at_i < len(a)) & (at_j < len(b))
            live, at_i, at_j = live[inside], at_i[inside], at_j[inside]
            live = live[a[at_i] == b[at_j]]
            size[live] += 1
        ok = size >= n
        out += zip((-size[ok]).tolist(), i[ok].tolist(), j[ok].tolist(), strict=True)
        x = y
    return out


def tile(item: list[int], doc: list[int], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in item, place in doc, length) of non-overlapping matches, longest first.

    Running Karp-Rabin with falling search lengths: hashes of the document's runs are looked up among the item's, matches
    are checked, extended and handed out longest first; what a tile leaves of a match goes back if it is long enough, else
    a later, shorter search finds it. Ties go to the earlier place in the item, then in the document.
    """
    names: dict[int, int] = {}
    codes = np.array([names.setdefault(t, len(names) + 2) for t in (*item, *doc)], np.int64)
    a, b, tiles = codes[: len(item)].copy(), codes[len(item) :].copy(), []
    length = max(least, len(item) // 2)
    while True:
        queue = _maximal(a, b, length)
        heapq.heapify(queue)
        while queue:
            k, i, j = heapq.heappop(queue)
            k = -k
            free = (a[i : i + k] > 1) & (b[j : j + k] > 1)
            if free.all():
                a[i : i + k], b[j : j + k] = 0, 1  # marked places equal nothing
                tiles.append((i, j, k))
                continue
            edges = np.flatnonzero(np.diff(free.astype(np.int8), prepend=0, append=0))
            for x, y in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if y - x >= length:
                    heapq.heappush(queue, (x - y, i + x, j + x))
        if length <= least:
            return tiles
        length = max(least, length // 2)


def contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", coverage: float = COVERAGE, match: int = MATCH) -> DataFrame:
    """doc_id, item_id, item_tokens, covered, coverage, n_tiles of each document and item it covers to `coverage` at least.

    Seeds are runs of `match` tokens (the whole item where it has fewer) that document and item share. Only the stretches
    of a document within seeds of an item are tiled, which no tile of that length can leave, so the order of passages and
    what stands between them do not matter. Items go to all tasks in blocks of ITEM_BLOCK bytes, whatever their number.
    Cases: null, empty or tokenless texts and items match nothing; texts of any length and repetition are tiled whole; repeated items are items of their own; a null id is kept;
    repeated rows are reported as often as they occur; empty tables give no rows; other columns are left out.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    every = items.select(items[item_id].cast("long").alias("item_id"), items[item_text].cast("string").alias("text")).where("text is not null")
    size = every.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    parts = max(1, -(-size // ITEM_BLOCK))
    shape = "doc_id long, item_id long, item_tokens int, covered int, coverage double, n_tiles int"
    out = []
    for part in range(parts):
        some = every.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else every
        block = [(r["item_id"], r["text"]) for r in some.collect()]
        if block:
            out.append(rows.mapInArrow(_tiler(block, coverage, match), shape))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], shape)


def _tiler(block: list[tuple[int, str]], coverage: float, match: int):
    def run(batches):
        tok, off = tokens([t for _, t in block])
        sizes = np.diff(off)
        names, whole = [i for i, _ in block], tok.tolist()
        tables = {}  # length of seeds -> sorted hashes, item of each
        for n in sorted({min(match, int(s)) for s in sizes if s}):
            of = np.flatnonzero(np.minimum(sizes, match) == n)
            hashes = [seeds(tok[off[i] : off[i + 1]], n) for i in of]
            item = np.repeat(of, [len(h) for h in hashes])
            h = np.concatenate(hashes)
            order = np.argsort(h, kind="stable")
            there = np.zeros(1 << 20, bool)
            there[h >> np.uint64(44)] = True
            tables[n] = (h[order], item[order], there)

        def check(doc: np.ndarray, hits: dict[int, list[tuple[int, int]]]):
            for i, places in hits.items():
                inside = np.zeros(len(doc) + 1, np.int64)
                for p, n in places:
                    inside[p] += 1
                    inside[p + n] -= 1
                at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
                text = doc[at].tolist()
                cut = np.flatnonzero(np.diff(at) > 1) + 1
                for c in cut[::-1].tolist():  # a token that no item has, between stretches
                    text.insert(c, -1 - c)
                item = whole[off[i] : off[i + 1]]
                tiles = tile(item, text, min(match, len(item)))
                covered = sum(k for _, _, k in tiles)
                if covered >= coverage * len(item) and covered:
                    yield names[i], len(item), covered, covered / len(item), len(tiles)

        for b in batches:
            ids, texts, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            lengths = np.concatenate([[0], np.cumsum([len(t or "") + 1 for t in texts])])
            for x, y in blocks(lengths, BLOCK):
                tok_d, off_d = tokens([t or "" for t in texts[x:y]])
                hits: dict[int, dict[int, list]] = defaultdict(lambda: defaultdict(list))
                for n, (h, item, there) in tables.items():
                    s = seeds(tok_d, n)
                    at = np.flatnonzero(there[s >> np.uint64(44)])
                    lo, hi = np.searchsorted(h, s[at]), np.searchsorted(h, s[at], "right")
                    for p, a, z in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
                        d = int(np.searchsorted(off_d, p, "right")) - 1
                        if p + n <= off_d[d + 1]:
                            for i in set(item[a:z].tolist()):
                                hits[d][i].append((p - int(off_d[d]), n))
                for d in sorted(hits):
                    for row in check(tok_d[off_d[d] : off_d[d + 1]], hits[d]):
                        out.append((ids[x + d], *row))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["doc_id", "item_id", "item_tokens", "covered", "coverage", "n_tiles"])

    return run


def op7_greedy_string_tiling(spark, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they hold, over all documents and items; cases as contaminated()."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs, items)
