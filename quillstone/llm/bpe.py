"""Byte-level BPE by ranks: corpus-level merge replay over an inverted index from token pairs to word positions."""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import finder

CACHE = 700_000  # words that a worker process keeps, over its tasks
REPLAY = 50_000  # words that are merged together
_ENCODERS: dict[tuple[str, str], Encoder] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """Pairs of token ids that merge, with the id of the result, which is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes[rank] = token
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pairs = pairs
        single = self.single
        self.starts = np.array([[a << 32 | b in pairs for b in single.tolist()] for a in single.tolist()], bool)

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word. Index: pair -> places of its left token, all words in one array with links to neighbours.

        A heap hands out the pairs in the order of their ranks. A pair's places are merged from left to right in each
        word, and the pairs on both sides of a merge enter the index. Should a merge bring up a pair of lower rank than
        the present one, the heap gives that pair next; places of the present pair in that word wait for it, so each word
        sees its merges in the order in which it alone would: lowest rank first, leftmost first.
        """
        flat = np.frombuffer(b"".join(words), np.uint8)
        codes, n = self.single[flat], len(flat)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        begin = (ends - np.fromiter(map(len, words), np.int64, len(words))).tolist()
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = before[begin] = -1
        first = np.flatnonzero((after[:-1] >= 0) & self.starts[flat[:-1], flat[1:]])
        keys = codes[first] << 32 | codes[first + 1]
        order = np.argsort(keys, kind="stable")
        keys, first = keys[order], first[order]
        cuts = np.flatnonzero(np.diff(keys, prepend=-1))
        edges = [*cuts.tolist(), len(keys)]
        first = first.tolist()
        pairs, index = self.pairs, {pair: first[i:j] for pair, i, j in zip(keys[cuts].tolist(), edges, edges[1:], strict=False)}
        get, token, after, before = pairs.get, codes.tolist(), after.tolist(), before.tolist()
        heap = [(pairs[p], p) for p in index]
        heapq.heapify(heap)
        alive = bytearray(b"\1") * n
        while heap:
            rank, pair = heapq.heappop(heap)
            places = index.pop(pair, None)
            if not places:
                continue
            left, right = pair >> 32, pair & 0xFFFFFFFF
            places.sort()
            held: list[int] = []  # places that wait for a lower pair
            stop = -1  # places up to here are held
            for i in places:
                j = after[i]
                if not alive[i] or token[i] != left or j < 0 or token[j] != right:
                    continue
                if i < stop:
                    held.append(i)
                    continue
                token[i], alive[j] = rank, 0
                k, h = after[j], before[i]
                after[i] = k
                low = False
                if k >= 0:
                    before[k] = i
                    r = get(new := rank << 32 | token[k])
                    if r is not None:
                        low |= r < rank
                        if new in index:
                            index[new].append(i)
                        else:
                            index[new] = [i]
                            heapq.heappush(heap, (r, new))
                if h >= 0:
                    r = get(new := token[h] << 32 | rank)
                    if r is not None:
                        low |= r < rank
                        if new in index:
                            index[new].append(h)
                        else:
                            index[new] = [h]
                            heapq.heappush(heap, (r, new))
                if low:
                    stop = i
                    while after[stop] >= 0:  # the rest of this word waits
                        stop = after[stop]
                    stop += 1
            if held:
                index[pair] = held + index.get(pair, [])
                heapq.heappush(heap, (rank, pair))
        out = []
        for i in begin:
            ids = []
            while i >= 0:
                ids.append(token[i])
                i = after[i]
            out.append(ids)
        return out


class Encoder:
    """Ids of texts: words by the pattern, each distinct word merged once, its ids kept as bytes while there is room."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges, self.words, self.ids = merges, finder(pattern), {}

    def learn(self, texts: list[list[str]]) -> None:
        if len(self.ids) > CACHE:
            self.ids.clear()
        new = [w for w in set().union(*texts) if w not in self.ids]
        size, part = 0, []
        for w in new:
            part.append(w)
            size += len(w)
            if len(part) >= REPLAY or size >= 8 * REPLAY:
                self._keep(part)
                size, part = 0, []
        self._keep(part)

    def _keep(self, words: list[str]) -> None:
        if words:
            for w, ids in zip(words, self.merges.replay([w.encode() for w in words]), strict=True):
                self.ids[w] = array("i", ids).tobytes()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.merges.bytes.__getitem__, ids))


def encoder_of(items: list[tuple[bytes, int]], pattern: str, name: str) -> Encoder:
    """The worker process's encoder, which keeps its words for the tasks that run there later."""
    if (name, pattern) not in _ENCODERS:
        _ENCODERS[name, pattern] = Encoder(Merges(dict(items)), pattern)
    return _ENCODERS[name, pattern]


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """doc_id, ids (array; left out without with_ids), n_tokens, ids_sha256, decoded_sha256 of every row of docs.

    Ids are those of the rank table alone: each match of the pattern apart, no special tokens. Null text is empty; a text
    without a match has no ids, and the sha256 of nothing; repeated rows are encoded alike; an empty table gives no rows;
    other columns are left out.
    """
    items = sorted(ranks.items())
    name = hashlib.sha256(repr(items).encode()).hexdigest()

    def run(batches):
        encoder = encoder_of(items, pattern, name)
        for b in batches:
            size = 64
            for at in range(0, b.num_rows, size):
                texts = [encoder.words(t or "") for t in b.column(1).slice(at, size).to_pylist()]
                encoder.learn(texts)
                ids = [np.frombuffer(b"".join(map(encoder.ids.__getitem__, words)), "<i4") for words in texts]
                counts, digests = np.array([len(i) for i in ids], np.int64), []
                for i in map(np.ndarray.tolist, ids):
                    shown = str(i)[1:-1].replace(" ", "").encode()
                    digests.append((hashlib.sha256(shown).hexdigest(), hashlib.sha256(encoder.decode(i)).hexdigest()))
                cols = [pa.array(counts), *(pa.array(list(d)) for d in zip(*digests, strict=True))]
                if with_ids:
                    cols = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), pa.array(np.concatenate(ids))), *cols]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, size), *cols], ["doc_id", *["ids"] * with_ids, "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + "ids array<int>, " * with_ids + "n_tokens long, ids_sha256 string, decoded_sha256 string")


def op8_bpe_merge_replay(spark, sf_dir: str) -> DataFrame:
    """Cases: null and empty texts have no ids and the digests of nothing; repeated rows are encoded alike; no rows, no result."""
    import public_tokenizers

    ranks = load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), ranks, public_tokenizers.PATTERN, with_ids=False)
