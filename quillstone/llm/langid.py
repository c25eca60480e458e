"""Language identification: scripts narrow the candidates, Viterbi over per-word scores labels spans."""

from __future__ import annotations

import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.common import held_out, mix

DOCS_PER_LANG = 400  # documents of a language to learn from, about; the bound of the sample
WIDE = 64  # languages beyond which fewer words are held at once
BITS = 15
ORDERS = 4  # grams of 1 to 3 characters, and whole words
SMOOTHING = 0.5
SWITCH = 14.0  # cost of a change of language between words, in nats of the mean score of the four orders
SCRIPT_SHARE = 0.01
WORD = 40  # characters; longer words are scored in parts
CACHE = 200_000

# First code points of ranges of scripts (Unicode blocks), and the script of each range
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0700, "other"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"), (0x0B00, "other"), (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"),
    (0x0D00, "malayalam"), (0x0D80, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other"), (0xFB50, "arabic"), (0xFE00, "other"),
    (0x20000, "han"), (0x32000, "other"),
)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of script ranges, script numbers, and which code points are letters."""
    names = sorted({s for _, s in SCRIPTS})
    letters = np.fromiter((unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)), bool, 0x110000)
    return np.array([c for c, _ in SCRIPTS]), np.array([names.index(s) for _, s in SCRIPTS]), letters


class Words:
    """Features of words: n-gram buckets, letters and script, all words in one pass over their code points."""

    def __init__(self):
        self.starts, self.script, self.letters = _tables()

    def features(self, words: list[str]) -> tuple:
        """(bucket, word, order) of each feature, and letters and script of each word."""
        cp = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), np.uint32).astype(np.int64)
        space = cp == 32
        word = np.cumsum(space) - 1
        letter = self.letters[cp]
        n = len(words)
        count = np.bincount(word[letter], minlength=n + 1)[:n]
        script = self.script[np.searchsorted(self.starts, cp, "right") - 1]
        kinds = int(self.script.max()) + 1
        of_word = np.bincount(word[letter] * kinds + script[letter], minlength=(n + 1) * kinds)[: n * kinds].reshape(n, kinds).argmax(1)
        c = np.where(letter, cp, 32).astype(np.uint64)  # other characters end a gram as spaces do
        gap = ~letter
        out = []
        for order in range(3):
            m = len(c) - order
            h = np.zeros(m, np.uint64)
            for i in range(order + 1):
                h = h * np.uint64(0x100000001B3) + c[i : i + m]
            ok = ~gap[:m] if order == 0 else ~(gap[:m] & gap[order:]) if order == 1 else ~gap[1 : m + 1]
            # a gram belongs to the word of its first character; a space belongs to the word behind it
            w = word[:m]
            ok = ok & (w < n) & ~(space[1 : m + 1] if order == 2 else np.zeros(m, bool))
            at = np.flatnonzero(ok)
            out.append(((mix(h[at] + np.uint64(order * 977)) >> np.uint64(64 - BITS)).astype(np.int64), w[at], order))
        place = np.arange(len(c)) - np.flatnonzero(space)[word]
        power = mix(np.arange(1, WORD + 3, dtype=np.uint64))
        total = np.add.reduceat(np.where(letter, c * power[np.minimum(place, WORD + 1)], np.uint64(0)), np.flatnonzero(space))[:n]
        some = np.flatnonzero(count > 0)
        out.append(((mix(total[some]) >> np.uint64(64 - BITS)).astype(np.int64), some, 3))
        return out, count, of_word


def split_words(text: str) -> list[str]:
    words = text.lower().split()
    if any(len(w) > WORD for w in words):
        words = [w[i : i + WORD] for w in words for i in range(0, len(w), WORD)]
    return words


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = DOCS_PER_LANG) -> dict:
    """Model of the languages: log-probabilities of hashed grams, scripts in use. Learns from documents that are not held out.

    The sample is bounded: of each language about docs_per_lang documents, chosen by a hash of the id, twice as many at
    most; the documents with its least hash are always among them, so no language is left out.
    """
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang"))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    u = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    known = known.select("lang", "text", u.alias("u"))
    bounds = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(docs_per_lang)) / F.count(F.lit(1))).alias("share"), F.min("u").alias("least"))
    near = known.join(F.broadcast(bounds), "lang").where((F.col("u") < F.col("share")) | (F.col("u") == F.col("least")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("u", F.xxhash64("text")))
    sample = near.withColumn("place", place).where(F.col("place") <= 2 * docs_per_lang).select("lang", "text")

    def learn(batches):
        seen: dict[str, Counter] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(split_words(text))
        features = Words()
        kinds = int(features.script.max()) + 1
        for lang in sorted(seen):
            grams, scripts = np.zeros((ORDERS, 1 << BITS)), np.zeros(kinds)
            words = list(seen[lang])
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                weight = np.array([seen[lang][w] for w in part], float)
                found, letters, script = features.features(part)
                for bucket, word, order in found:
                    grams[order] += np.bincount(bucket, weight[word], 1 << BITS)
                scripts += np.bincount(script, weight * letters, kinds)
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([grams.astype("<f4").tobytes()]), pa.array([scripts.tobytes()])], ["lang", "grams", "scripts"])

    learned = sample.repartition(1).mapInArrow(learn, "lang string, grams binary, scripts binary").collect()
    if not learned:
        return {"langs": []}
    learned.sort(key=lambda r: r["lang"])
    grams = np.stack([np.frombuffer(r["grams"], "<f4").reshape(ORDERS, -1) for r in learned], 2).astype(float)
    log = np.log((grams + SMOOTHING) / (grams.sum(1, keepdims=True) + SMOOTHING * grams.shape[1]))
    scripts = np.stack([np.frombuffer(r["scripts"]) for r in learned], 1)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(0, keepdims=True))
    return {"langs": [r["lang"] for r in learned], "log": log.astype(np.float32), "allowed": allowed}


class Scorer:
    """Scores of words, kept for words that come again."""

    def __init__(self, model: dict):
        self.model, self.words, self.known = model, Words(), {}
        self.table = np.zeros((0, len(model["langs"])), np.float32)
        self.letters = np.zeros((0, 2), np.int64)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Score of each word in each language, its letters and those of scripts that a language was seen in."""
        known = self.known
        if len(known) > CACHE * WIDE // max(WIDE, self.table.shape[1]):
            known.clear()
            self.table, self.letters = self.table[:0], self.letters[:0]
        new = [w for w in set(words) if w not in known]
        if new:
            score, letters = self.score(new)
            known.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
            self.table, self.letters = np.concatenate([self.table, score]), np.concatenate([self.letters, letters])
        at = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        return self.table[at], self.letters[at]

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found, letters, script = self.words.features(words)
        total = np.zeros((len(words), self.table.shape[1]))
        for bucket, word, order in found:
            rows = self.model["log"][order][bucket]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            total[word[first]] += np.add.reduceat(rows, first, axis=0) if len(first) else 0
        total /= ORDERS
        allowed = self.model["allowed"][script]
        some = allowed.any(1)
        total[some] = np.where(allowed[some], total[some], total[some].min(1, keepdims=True) - 2 * SWITCH)
        total[~some | (letters == 0)] = 0
        return total.astype(np.float32), np.stack([letters, letters * some], 1)


def viterbi(score: np.ndarray, switch: float) -> np.ndarray:
    """Best sequence of labels for rows of scores, less `switch` for each change; ties to the smaller label."""
    n, k = score.shape
    back = np.empty((n, k), np.int32)
    best = score[0].astype(float)
    own = np.arange(k)
    for t in range(1, n):
        top = int(best.argmax())
        stay = best >= best[top] - switch
        back[t] = np.where(stay, own, top)
        best = np.where(stay, best, best[top] - switch) + score[t]
    path = np.empty(n, np.int32)
    path[-1] = int(best.argmax())
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t, path[t]]
    return path


def paths(score: np.ndarray, off: np.ndarray, switch: float) -> np.ndarray:
    """Labels of all words of documents with word offsets off.

    A document keeps its best single language b if no stretch of words prefers another language to b by over half the
    switching penalty, which no path of several spans can then make up for. Others run Viterbi.
    """
    label = np.zeros(len(score), np.int32)
    if not len(score):
        return label
    full = np.flatnonzero(np.diff(off))
    first = off[full]
    doc = np.repeat(np.arange(len(full)), np.diff(off)[full])
    best = np.add.reduceat(score.astype(float), first, axis=0).argmax(1)
    label[:] = best[doc]
    gain = score - score[np.arange(len(score)), label][:, None]
    sums = np.cumsum(gain.astype(float), axis=0)
    base = np.concatenate([np.zeros((1, score.shape[1])), sums])[first]
    sums -= base[doc]
    big = 1.0 + 2 * np.abs(sums).max()
    before = np.concatenate([np.zeros((1, score.shape[1])), sums[:-1]])
    before[first] = 0
    low = np.minimum.accumulate(before - (doc * big)[:, None], axis=0) + (doc * big)[:, None]
    rise = np.maximum.reduceat((sums - low).max(1), first)
    for d in np.flatnonzero(rise > switch / 2):
        a, b = first[d], off[full[d] + 1]
        label[a:b] = viterbi(score[a:b], switch)
    return label


SPAN = "lang string, first_word int, last_word int"


def identify(docs: DataFrame, model: dict, *, id_col: str = "doc_id", text_col: str = "text", switch: float = SWITCH) -> DataFrame:
    """doc_id, lang_pred, score, spans (language and words of each span) of every row of docs.

    lang_pred has the most letters in spans (ties: first in the order of names), score is their share. Cases: null, empty
    or letterless text gives `und`, score 0 and no spans, as does a model without languages; words in a script that no
    language was seen in weigh for none, and a text of such words alone gets the first language with score 0 and no spans;
    very long words are scored in parts; repeated rows are judged alike; an empty table gives no rows; other columns are
    left out.
    """
    langs = model["langs"]

    def run(batches):
        scorer = Scorer(model) if langs else None
        for b in batches:
            texts, out = b.column(1).to_pylist(), []
            i = 0
            while i < len(texts):
                words, off = [], [0]
                while i < len(texts) and (len(words) < 100_000 * WIDE // max(WIDE, len(langs)) or off == [0]):
                    words += split_words(texts[i] or "") if langs else []
                    off.append(len(words))
                    i += 1
                if not langs:
                    out += [("und", 0.0, [])] * (len(off) - 1)
                    continue
                score, letters = scorer.of(words)
                ends = np.array(off)
                label = paths(score, ends, switch)
                doc = np.repeat(np.arange(len(off) - 1), np.diff(ends))
                sums = np.bincount(doc * len(langs) + label, letters[:, 1], (len(off) - 1) * len(langs)).reshape(-1, len(langs))
                total = sums.sum(1)
                some = np.bincount(doc, letters[:, 0], len(off) - 1)
                top = sums.argmax(1)
                for d in range(len(off) - 1):
                    if not total[d]:
                        out.append((langs[0] if some[d] else "und", 0.0, []))
                        continue
                    part = label[off[d] : off[d + 1]]
                    cut = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                    spans = [{"lang": langs[part[a]], "first_word": a, "last_word": z - 1} for a, z in zip(cut, cut[1:], strict=False)]
                    out.append((langs[top[d]], float(sums[d, top[d]] / total[d]), spans))
            kinds = [pa.string(), pa.float64(), pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int32()), ("last_word", pa.int32())]))]
            cols = [pa.array([x[k] for x in out], t) for k, t in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["doc_id", "lang_pred", "score", "spans"])

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, lang_pred string, score double, spans array<struct<{SPAN.replace(' ', ':').replace(',:', ',')}>>")


def op1_viterbi_language_spans(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans of all documents, from the part that is not held out; cases as identify()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = identify(docs, train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
