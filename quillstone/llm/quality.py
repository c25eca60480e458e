"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import held_out, mix

SAMPLE = 8000  # labelled documents to learn from, at most
BITS = 18
ALPHA, BETA, L1, L2 = 0.5, 0.1, 0.0005, 0.001
EPOCHS = 4
CUT = 0.7
CACHE = 300_000
MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_OTHER = re.compile(r"[^\W\d_]+|\d+")


def shape(word: str) -> str:
    """Case and kind of a word's characters: Aa for a capitalised word, A, a, 0 for digits, others as they are."""

    def kind(m: re.Match) -> str:
        s = m.group()
        return "0" if s.isdigit() else "a" if s.islower() else ("A" if s.isupper() else "Aa") if s[0].isupper() else "aA"

    return kind(re.match(r".+", word)) if word.isalpha() else _OTHER.sub(kind, word)[:12]


class Hashes(dict):
    """Word to (hash of the lower-cased word << 32 | hash of its shape); forgets all when it grows too large."""

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(shape(word).encode())
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value


def ngrams(words: list[str], hashes: Hashes, forms: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a document's features: runs of one, two and three words, lower-cased; with forms also the
    same runs of the words' shapes. The runs of one length sum to 1."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    both = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    parts = []
    for kind, x in enumerate((both >> np.uint64(32), both & np.uint64(0xFFFFFFFF))[: 1 + forms]):
        run = np.full(len(x), np.uint64(kind + 1))
        for n in range(min(3, len(x))):
            run = run[: len(x) - n] * MULTIPLIERS[n] + x[n:]
            parts.append(mix(run * MULTIPLIERS[0] + np.uint64(n)))
    weight = np.concatenate([np.full(len(p), 1.0 / len(p)) for p in parts])
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64), weight


def follow_leader(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-proximal updates, one document after the other."""
    size = (1 << BITS) + 1  # the last is the bias
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        w = -(z[at] - np.sign(z[at]) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(z[at]) <= L1, 0.0, w)

    for _ in range(epochs):
        for at, x, y in examples:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - y) * x
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size))
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """Weights learned from `sample` labelled documents at most that are not held out, in an order by a hash of the id.

    Cases: an id with several labels counts as 1 if any label is 1; labels other than 0 and 1 and null ones are not used,
    neither are null ids; null and empty texts teach the bias alone; texts count whole, however long; repeated rows each
    count, up to 2 * sample rows in all; without labels or documents the score of every text is 0.5; other columns of
    either table do not matter.
    """
    known = labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull() & ~held_out(labels[id_col]))
    marks = known.groupBy(known[id_col].cast("long").alias("_qs_id")).agg(F.max(known[label_col]).alias("y"))
    at = F.xxhash64("_qs_id", F.lit(5))
    picked = marks.withColumn("at", at).orderBy("at", "_qs_id").limit(sample)  # a bounded list of ids and labels
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    joined = rows.join(F.broadcast(picked), rows["id"] == picked["_qs_id"]).select("at", "id", "y", "text")
    # ids that occur several times could exceed the bound
    bounded = joined.repartition(1).sortWithinPartitions("at", "id", F.xxhash64("text")).limit(2 * sample)

    def learn(batches):
        hashes, examples = Hashes(), []
        for b in batches:
            for y, text in zip(b.column("y").to_pylist(), b.column("text").to_pylist(), strict=True):
                bucket, weight = ngrams((text or "").split(), hashes)
                at, inverse = np.unique(bucket, return_inverse=True)
                x = np.append(np.bincount(inverse, weight, len(at)), 1.0)
                examples.append((np.append(at, 1 << BITS), x, y))
        w, bias = follow_leader(examples)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array([bias]), pa.array([at.astype("<i4").tobytes()]), pa.array([w[at].astype("<f8").tobytes()])], ["bias", "at", "w"])

    learned = bounded.mapInArrow(learn, "bias double, at binary, w binary").collect()
    w = np.zeros(1 << BITS)
    if not learned:
        return {"w": w, "bias": 0.0}
    (row,) = learned
    w[np.frombuffer(row["at"], "<i4")] = np.frombuffer(row["w"], "<f8")
    return {"w": w, "bias": row["bias"]}


def score(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of docs and _qs_score, the chance of label 1, of every row.

    Cases: a null, empty or blank text has the bias alone; texts are scored whole, one at a time; repeated rows get equal
    scores; an empty table stays empty; columns named _qs_text or _qs_score are replaced, all others kept.
    """
    w, bias = model["w"], model["bias"]

    def run(batches):
        hashes = Hashes()
        for b in batches:
            out = np.empty(b.num_rows)
            for i, text in enumerate(b.column(b.num_columns - 1).to_pylist()):
                words = (text or "").split()
                total = bias
                if words:
                    bucket, weight = ngrams(words, hashes)
                    total += w[bucket] @ weight
                out[i] = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(b.num_columns - 1)], pa.array(out)], [*b.schema.names[:-1], "_qs_score"])

    docs = docs.select(*[docs[c] for c in docs.columns if c not in ("_qs_text", "_qs_score")])
    rows = docs.withColumn("_qs_text", docs[text_col].cast("string"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return rows.mapInArrow(run, f"{kept}, _qs_score double")


def op4_ftrl_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted of all documents; cases as train() and score()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_qs_score").alias("score"), (F.col("_qs_score") >= CUT).cast("int").alias("predicted"))
