"""Corpus operators against brute force on a small table with nulls, empty and long texts, ties, repeats and clashing columns."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quillstone.llm import bpe, common, decontam, knn, langid, linededup, nearcopies, quality, sharding, simhash, substrings, tokenfiles

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, count int, key int, bucket int, uid string, size int, score double"


def texts():
    r = random.Random(3)
    word = lambda: "".join(r.choice(["an", "ber", "ció", "the", "ß", "o"]) for _ in range(r.randint(1, 3)))
    prose = lambda n: " ".join(word() for _ in range(n))
    base = prose(60)
    out = [base, base, base.replace(" the", " teh", 1), None, "", " \n\t ", "one", "x" * 60, "x" * 130, prose(8000), prose(30) + "\n" + base[:80], "A" * 49, "...", "日本語のテキスト 日本語", base.upper(), "é" * 40]
    return out + [prose(r.randint(1, 40)) + "\nShared footer line of the whole group here.\n" + prose(5) for _ in range(14)]


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(texts())] + [(3, "again with one id"), (0, texts()[0]), (None, texts()[0])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", f"s{k % 12}" if k % 7 else None, 1, 1, 1, 1, "u", 1, 0.5) for k, (i, t) in enumerate(rows)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *cols):
    return sorted([tuple(r[c] for c in cols) for r in df.collect()], key=repr)


def test_sharding(docs, none, rows):
    out = sharding.shards(docs, n_shards=7).collect()
    assert sorted((r["text_crc32"], r["size"]) for r in out) == sorted((zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for _, t in rows)
    places = [r["slot"] * 7 + r["shard"] for r in out]
    assert sorted(places) == list(range(len(rows))) and places != sorted(places)
    assert sharding.shards(none).count() == 0
    again = sharding.shards(docs.repartition(5), n_shards=7)
    assert collected(again, "doc_id", "text_crc32", "shard", "slot") == collected(sharding.shards(docs, n_shards=7), "doc_id", "text_crc32", "shard", "slot")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000])
def test_permutation(spark, n):
    out = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, 5)).collect()]
    assert sorted(out) == list(range(n))


def test_substrings(docs, none, rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    first, wanted = {}, []
    for i, t in order:
        b = (t or "").encode()
        for s in range(len(b) - 49):
            first.setdefault(b[s : s + 50], -1 if i is None else i)
    for i, t in rows:
        b, gone = (t or "").encode(), np.zeros(len((t or "").encode()), bool)
        for s in range(len(b) - 49):
            if first[b[s : s + 50]] < (-1 if i is None else i):
                gone[s : s + 50] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        wanted.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    assert collected(substrings.repeated_substrings(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(wanted, key=repr)
    assert substrings.repeated_substrings(none).count() == 0


def test_simhash(docs, none, rows, monkeypatch):
    def fp(t):
        w = (t or "").encode().lower().split()
        s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    f = [fp(t) for _, t in rows]
    label = list(range(len(f)))
    for _ in f:
        for a in range(len(f)):
            for b in range(len(f)):
                if (f[a] ^ f[b]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[label[k]] = min(i, least.get(label[k], i))
    wanted = [(i, f"{f[k]:016x}", least.get(label[k])) for k, (i, _) in enumerate(rows)]
    assert collected(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(wanted, key=repr)
    assert simhash.near_duplicates(none).count() == 0
    monkeypatch.setattr(simhash, "HEAVY", 2)
    assert collected(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == sorted(wanted, key=repr)


def test_near_copies(spark, docs, none, rows, monkeypatch):
    monkeypatch.setattr(nearcopies, "MANY", 3)  # so that both ways of comparing are taken
    monkeypatch.setattr(nearcopies, "PART", 8)

    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()

    r = random.Random(5)
    base = [f"w{r.randrange(900)}" for _ in range(200)]
    edited = [" ".join(f"x{k}" if i in r.sample(range(200), 3) else w for i, w in enumerate(base)) for k in range(40)]
    apart = [" ".join(base[:100] + [f"y{k}-{i}" for i in range(60)]) for k in range(20)]
    more = rows + [(100 + k, t) for k, t in enumerate([" ".join(base), *edited, *apart, " ".join(base[:170]), " ".join(base[:155])])]
    sets, label = [shingles(t) for _, t in more], list(range(len(more)))
    alike = [(a, b) for a in range(len(more)) for b in range(a) if len(sets[a] & sets[b]) * 10 >= 8 * len(sets[a] | sets[b])]
    for _ in more:
        for a, b in alike:
            label[a] = label[b] = min(label[a], label[b])
    least = {}
    for k, (i, _) in enumerate(more):
        if i is not None:
            least[label[k]] = min(i, least.get(label[k], i))
    wanted = sorted([(i, least.get(label[k])) for k, (i, _) in enumerate(more)], key=repr)
    table = spark.createDataFrame(more, "doc_id long, text string")
    assert collected(nearcopies.near_copies(table), "doc_id", "component_id") == wanted
    kept = [r["doc_id"] for r in corpus_pipeline.keep_one(spark, table, SF).where("doc_id >= 100").collect()]
    assert sorted(kept) == sorted({c for i, c in wanted if i is not None and i >= 100})
    assert nearcopies.near_copies(none).count() == 0


def test_sketches_never_rule_out_similar_sets():
    r = np.random.default_rng(1)
    for n in (1, 3, 40, 700, 5000):
        base = r.integers(0, 2**63, n, dtype=np.uint64)
        for share in (0.0, 0.05, 0.1, 0.3):
            other = np.unique(np.concatenate([base[int(share * n) :], r.integers(0, 2**63, int(share * n / 2), dtype=np.uint64)]))
            own = np.unique(base)
            similar = len(np.intersect1d(own, other)) * 10 >= 8 * len(np.union1d(own, other))
            assert nearcopies.may_be_similar(nearcopies.sketch(own), nearcopies.sketch(other), len(own) + len(other), 0.8) or not similar


def test_hot_segments_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", 4)
    fps = [(1 << i) | 7 << 40 for i in range(30)] + [0x1234 << 36 | i for i in range(16)]
    classes = spark.createDataFrame([(x, x) for x in fps], "node long, fp long")
    found = {r["u"]: r["v"] for r in simhash.components(simhash.links(classes)).toDF("u", "v").collect()}
    assert {found.get(x) for x in fps[:30]} == {min(fps[:30])} and {found.get(x) for x in fps[30:]} == {min(fps[30:])}


def test_line_dedup(docs, none, rows):
    line = "Shared footer line of the whole group here."
    out = linededup.without_boilerplate(docs, min_sites=5).collect()
    holders = [i for i, t in rows if t and line in t.split("\n")]
    kept = [r["doc_id"] for r in out if r["text"] and line in r["text"].split("\n")]
    assert kept == [min(holders)] and len(out) == len(rows)
    assert sum(r["_qs_removed"] for r in out) == len(holders) - 1
    assert sum(r["text"] is None for r in out) == 1
    assert linededup.without_boilerplate(none).count() == 0


def test_short_lines(spark, tmp_path):
    texts = [f"Own words of document {i}.\nAll rights reserved.\n \n\n- 1 -" for i in range(12)] + ["Own words.\nRare."] * 2
    table = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: (r["n_removed"], r["text"]) for r in linededup.op2_cross_site_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {i: (2, f"Own words of document {i}.\n \n") if 0 < i < 12 else (0, t) for i, t in enumerate(texts)}
    cleaned = corpus_pipeline.drop_lines(spark, table, str(tmp_path))
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == {i: t for i, (_, t) in out.items()}


@pytest.mark.parametrize("least, precision", [(2, 12), (12, 4), (90, 12), (90, 4), (300, 5)])
def test_thresholds_near_and_above(spark, least, precision):
    """Lines on least - 1, least and least + 1 sites, some often on one site, with a null id, clashing and empty columns."""
    spread = {"below": least - 1, "at": least, "above": least + 1, "far above": 4 * least}
    rows = [(k, f"line {name}\r\nline {name}", f"s{i}", "x") for name, n in spread.items() for k, i in enumerate(range(n))]
    rows += [(7, "line below", "s0", "x")] * 50 + [(None, "line at", None, "y"), (9, None, "s1", "z"), (10, "", None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, key string")
    sites = {}
    for _, text, site, _ in rows:
        for line in (text or "").split("\n"):
            sites.setdefault(line.strip(), set()).add(site or "")
    first = {}
    for i, text, _, _ in rows:
        for line in (text or "").split("\n"):
            if i is not None:
                first[line.strip()] = min(i, first.get(line.strip(), i))
    wanted = []
    for i, text, _, key in rows:
        gone = [bool(x.strip()) and len(sites[x.strip()]) >= least and first[x.strip()] != i for x in (text or "").split("\n")]
        kept = None if text is None else "\n".join(x for x, g in zip(text.split("\n"), gone, strict=True) if not g)
        wanted.append((i, kept, key, sum(gone)))
    out = linededup.without_boilerplate(table, min_sites=least, precision=precision)
    assert collected(out, "doc_id", "text", "key", "_qs_removed") == sorted(wanted, key=repr)


def test_bpe(docs, none, rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe.encode(docs, bpe.load_ranks(path), public_tokenizers.PATTERN)
    assert collected(out, "doc_id", "ids") == sorted(((i, enc.encode_ordinary(t or "")) for i, t in rows), key=repr)
    assert {r["decoded_sha256"] for r in out.collect()} == {hashlib.sha256((t or "").encode()).hexdigest() for _, t in rows}
    assert bpe.encode(none, ranks, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("most", [tokenfiles.FILE_DOCS, 3])
def test_token_files(docs, none, rows, monkeypatch, most):
    monkeypatch.setattr(tokenfiles, "FILE_DOCS", most)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, text = Tokenizer.from_file(path), open(path, encoding="utf-8").read()
    files = tokenfiles.write(docs, text)
    assert sum(r["docs"] for r in files.collect()) == len(rows) and all(r["docs"] <= most for r in files.collect())
    out = tokenfiles.read(files).collect()
    ids = [np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in rows]
    assert sorted((r["doc_id"] is not None, r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out if r["doc_id"] is not None) == sorted((True, i, len(x), zlib.crc32(x.tobytes())) for (i, _), x in zip(rows, ids, strict=True) if i is not None)
    ordered = sorted(out, key=lambda r: r["start"])
    assert [r["start"] for r in ordered] == [0, *np.cumsum([r["n_tokens"] for r in ordered])[:-1].tolist()]
    assert [r["doc_id"] for r in ordered if r["doc_id"] is not None] == sorted(i for i, _ in rows if i is not None)
    from pyarrow import fs

    found = 0
    for r in files.collect():
        store, name = fs.FileSystem.from_uri(r["path"])
        with store.open_input_file(name) as f:
            reader = tokenfiles.Reader(f)
            if 9 in reader.docs["doc_id"][reader.docs["is_null"] == 0]:
                assert (reader.of(9) == ids[9]).all()
                found += 1
    assert found == 1
    assert tokenfiles.read(tokenfiles.write(none, text)).count() == 0


@pytest.mark.parametrize("rows_a_shard, spread", [(40, 1.0), (1000, 1.0), (25, 1e-9), (30, 1e9)])
def test_top_k(spark, monkeypatch, rows_a_shard, spread):
    """Several shards, one, equal vectors only, and components whose sums exceed 64 bits."""
    monkeypatch.setattr(knn, "LEAST_ROWS", rows_a_shard)
    monkeypatch.setattr(knn, "MOST_ROWS", rows_a_shard)
    monkeypatch.setattr(knn, "LEAF", 4)
    monkeypatch.setattr(knn, "QUERY_BLOCK", 3)
    monkeypatch.setattr(knn, "SLICE", 1)
    r = random.Random(1)
    rows = [(i, [round(r.gauss(0, 1), 1) * (spread if i % 3 or spread < 1 else 1.0) for _ in range(4)]) for i in range(150)]
    rows += [(i, [0.5, -0.5, 0.25, 0.125]) for i in range(300, 330)] + [(20, [1.0, 0.0, 0.0, 0.0])]
    rows += [(200, None), (201, [None, 1.0, 1.0, 1.0]), (202, [float("nan")] * 4), (203, [1.0]), (204, []), (None, [1.0] * 4), (206, [float("inf")] * 4)]
    v = [(i, [int(np.floor(64 * np.float64(np.float32(x)))) for x in e] + [0] * (4 - len(e))) for i, e in rows if i is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)]
    most = 2**63 - 1
    wanted = []
    for q, own in v:
        if q % 20 == 0:
            best = sorted((-sum(a * b for a, b in zip(own, other, strict=True)), c) for c, other in v if c != q)[:5]
            wanted += [(q, k + 1, c, max(-most - 1, min(most, -s))) for k, (s, c) in enumerate(best)]
    df = spark.createDataFrame([(i, e, 1, 2) for i, e in rows], "vec_id long, embedding array<float>, shard int, block int")
    got = collected(knn.top_k(df, k=5), "query_id", "rank", "vec_id", "score")
    if spread > 1:  # beyond 64 bits ids are those of equal shown scores
        assert sorted((a, b, d) for a, b, _, d in got) == sorted((a, b, d) for a, b, _, d in wanted)
    else:
        assert got == sorted(wanted, key=repr)
    assert knn.top_k(df.limit(0)).count() == 0


def test_descent_cuts_subtrees():
    r = np.random.default_rng(0)
    centres = r.normal(size=(40, 8)) * 300
    v = np.floor(centres[r.integers(0, 40, 8000)] + r.normal(size=(8000, 8)))
    tree = knn.build(np.arange(8000), v, 64)
    seen = []
    real = knn.scores
    knn.scores = lambda q, w, size: seen.append(len(q) * len(w)) or real(q, w, size)
    try:
        found = knn.search(tree, np.arange(5), v[:5], 3, np.full(5, -np.inf))
    finally:
        knn.scores = real
    assert sum(seen) < 5 * 8000 / 4
    for i in range(5):
        s = v @ v[i]
        top = sorted((-x, j) for j, x in enumerate(s) if j != i)[:3]
        assert sorted((-x, int(j)) for q, j, x in zip(*found, strict=True) if q == i) == top


def test_tiling(spark, docs, none):
    a, b, c = "one two three four five six", "seven eight nine ten eleven twelve", "red green blue cyan pink grey"
    items = spark.createDataFrame([(1, f"{a} {b} {c}", 0), (2, None, 0), (3, "...", 0), (4, "lone word", 0)], "item_id long, text string, doc_id int")
    d = spark.createDataFrame([(1, f"x {c}! y {a}, z {b}. end"), (2, "one two three four"), (3, None), (4, "a LONE word b"), (5, f"{a} only")], "doc_id long, text string")
    out = {(r["doc_id"], r["item_id"]): (r["covered"], r["n_tiles"]) for r in decontam.contaminated(d, items).collect()}
    assert out == {(1, 1): (18, 3), (4, 4): (2, 1)}
    assert decontam.contaminated(docs, items).count() == 0 and decontam.contaminated(none, items).count() == 0
    assert decontam.contaminated(d, items.limit(0)).count() == 0


def plain_tiles(item, doc, least):
    """The longest common run of unmarked tokens, again and again."""
    a, b, tiles = list(item), list(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] is not None and a[i + k] == b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return tiles
        a[i : i + k], b[j : j + k] = [None] * k, [None] * k
        tiles.append((i, j, k))


def test_tiles_against_brute_force():
    r = random.Random(4)
    for n in range(150):
        letters = r.choice([1, 2, 3, 8])
        item, doc = ([r.randrange(letters) for _ in range(r.randrange(25))] for _ in range(2))
        if n % 3 == 0 and item:
            doc = doc[:4] + item[len(item) // 2 :] + doc[4:9] + item[: len(item) // 2]
        least = r.choice([1, 2, 5])
        assert sorted(decontam.tile(item, doc, least)) == sorted(plain_tiles(item, doc, least))
    assert decontam.tile([7] * 400, [7] * 20_000, 5) == [(0, 0, 400)]


def test_tiling_cases(spark):
    words = [f"t{i}" for i in range(30)]
    items = spark.createDataFrame([(1, " ".join(words)), (1, " ".join(words)), (None, " ".join(words[:12])), (5, "")], "item_id long, text string")
    long = "same word " * 20_000 + " ".join(words[10:]) + " x " + " ".join(words[:10])
    d = spark.createDataFrame([(1, long, 1), (1, long, 1), (None, " ".join(words[:12]), 2), (2, "", 3)], "doc_id long, text string, item_id int")
    out = collected(decontam.contaminated(d, items), "doc_id", "item_id", "covered", "n_tiles")
    assert out == sorted([(1, 1, 30, 2)] * 4 + [(1, None, 10, 1)] * 2 + [(None, None, 12, 1)], key=repr)


def test_language(spark, docs, none):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(d)
    out = langid.identify(d, model).join(d.select("doc_id", "lang"), "doc_id").where(common.held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) >= 0.95
    odd = {r["doc_id"]: r for r in langid.identify(docs.where("doc_id in (4, 5, 12) or text is null"), model).collect()}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in odd.values())
    fr, en = (d.where(f"lang = '{x}' and n_chars > 1500").first()["text"][:1500] for x in ("fr", "en"))
    mixed = spark.createDataFrame([(1, f"{fr} {en}")], "doc_id long, text string")
    assert [s["lang"] for s in langid.identify(mixed, model).first()["spans"]] == ["fr", "en"]
    assert langid.identify(none, langid.train(none)).count() == 0


def test_many_languages_and_planes(spark):
    r = random.Random(2)
    word = lambda k: chr(97 + k % 26) * 2 + chr(97 + k // 26) + r.choice(["q", "zz", "vy"])
    some = [(i, " ".join(word(i % 70) for _ in range(30)), f"l{i % 70:02}") for i in range(70 * 12)]
    model = langid.train(spark.createDataFrame(some, "doc_id long, text string, lang string"), docs_per_lang=3)
    assert model["langs"] == [f"l{k:02}" for k in range(70)]
    one_id = [(1, f"w{i} same", "xx") for i in range(500)] + [(2 + i, "other words", "yy") for i in range(9)]
    assert langid.train(spark.createDataFrame(one_id, "doc_id long, text string, lang string"), docs_per_lang=2)["langs"] == ["xx", "yy"]
    high = spark.createDataFrame([(1, "\U0001e900\U0001e901 \U00010330"), (2, "\U0001f600")], "doc_id long, text string")
    assert {x["doc_id"]: (x["lang_pred"] == "und", x["score"]) for x in langid.identify(high, model).collect()} == {1: (False, 0.0), 2: (True, 0.0)}
    mixed = spark.createDataFrame([(1, f"{some[5][1]} Россия 中国"), (1, f"{some[5][1]} Россия 中国")], "doc_id long, text string")
    assert [(x["lang_pred"], x["score"]) for x in langid.identify(mixed, model).collect()] == [("l05", 1.0)] * 2


def test_viterbi_shortcut():
    r = np.random.default_rng(0)
    score = r.normal(size=(300, 3)) * 4
    off = np.array([0, 0, 100, 101, 300])
    got = langid.paths(score, off, 9.0)
    for a, b in zip(off, off[1:], strict=False):
        if b > a:
            value = lambda p: score[np.arange(a, b), p].sum() - 9.0 * (np.diff(p) != 0).sum()  # noqa: B023, E731
            assert value(got[a:b]) == pytest.approx(value(langid.viterbi(score[a:b], 9.0)))


def test_one_row_of_each_group_stays(spark, none):
    a, b, c = (" ".join(f"{x}{i}" for i in range(20)) for x in "abc")
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, c, "x"), (3, c, "y"), (3, c, "x"), (None, c, "x"), (None, "only here in full", "x"), (5, None, "x"), (6, " ", "x"), (6, "", "x"), (4, b + " and", "x")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = collected(corpus_pipeline.keep_one(spark, table, SF), "doc_id", "text")
    assert out == sorted([(1, a), (2, b), (3, c), (None, "only here in full"), (5, None)], key=repr)
    assert corpus_pipeline.keep_one(spark, none, SF).columns == none.columns


def test_training_against_plain_updates():
    r = np.random.default_rng(3)
    examples = [(np.append(np.unique(r.integers(0, 50, 6)), 1 << quality.BITS), None, int(i % 3 > 0)) for i in range(40)]
    examples = [(at, np.append(r.random(len(at) - 1), 1.0), y) for at, _, y in examples]
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= quality.L1:
            return 0.0
        return -(z[i] - (quality.L1 if z[i] > 0 else -quality.L1)) / ((quality.BETA + n[i] ** 0.5) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for at, x, y in examples:
            own = [weight(i) for i in at.tolist()]
            p = 1 / (1 + np.exp(-sum(a * b for a, b in zip(own, x, strict=True))))
            for i, v, w in zip(at.tolist(), x.tolist(), own, strict=True):
                g, before = (p - y) * v, n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (n[i] ** 0.5 - before**0.5) / quality.ALPHA * w
    got, bias = quality.follow_leader(examples)
    assert bias == pytest.approx(weight(1 << quality.BITS))
    assert all(got[i] == pytest.approx(weight(i)) for i in range(50))


def test_quality(spark, docs, none):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality.train(d, labels)
    out = quality.score(d, model).join(labels, "doc_id").where(common.held_out(F.col("doc_id"))).collect()
    assert np.mean([(r["_qs_score"] >= quality.CUT) == (r["quality"] == 1) for r in out]) >= 0.95
    assert quality.score(docs, model).where("_qs_score between 0 and 1").count() == docs.count()
    assert quality.score(none, model).count() == 0
    assert quality.train(none, labels)["bias"] == 0


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts, cols = [docs.count()], docs.columns
    for _, stage in corpus_pipeline.STAGES:
        docs = common.materialise(stage(spark, docs, SF), "stage")
        counts.append(docs.count())
        assert stage is corpus_pipeline.STAGES[-1][1] or docs.columns == cols
    assert counts == sorted(counts, reverse=True) and counts[2] == counts[1] and counts[3] < counts[2]
    assert sorted(r["ids_sha256"] for r in corpus_pipeline.run(spark, SF).collect()) == sorted(r["ids_sha256"] for r in docs.collect())


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, r"'s|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"])
def test_quick_finder_of_latin_texts(pattern):
    import random

    import regex

    from quillstone.llm.common import finder, latin_findall

    quick, every, find, r = latin_findall(pattern), regex.compile(pattern).findall, finder(pattern), random.Random(7)
    signs = [chr(c) for c in range(256)] + list(" '\n\t sdtm ") * 8
    for _ in range(20_000):
        text = "".join(r.choices(signs, k=r.randrange(14)))
        assert quick(text) == every(text) == find(text)
    assert find("a \u0416\u0416 1") == every("a \u0416\u0416 1") and latin_findall(r"\w+") is None
