"""The ten operators against plain versions on a small table with nulls, empty and long texts, ties and repeated rows."""

import hashlib
import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402
import corpus_pipeline  # noqa: E402

from scriptorium.llm import _common, bpe, components, decontaminate, lengths, quality, simhash, substrings, suffixes, token_files, topk, warc  # noqa: E402


def table():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared, passage = text(60), text(120)
    rows = [(k, text(rnd.randint(1, 80))) for k in range(12)]
    rows += [(12, None), (13, ""), (14, "one"), (15, rows[3][1]), (16, rows[3][1]), (17, f"{text(5)} {shared} {text(9)}"), (18, f"{text(3)} {shared}\n{text(4)}"), (19, f"{passage} {passage}"), (20, f"x {passage}"), (20, f"x {passage}"), (21, "ab " * 400), (22, shared.replace(" ", "  ").upper()), (23, "a" * 3000)]
    return rows


SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in table()], SCHEMA + ", unit string, data int")  # names that operators use inside


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_token_files(spark, docs, empty):
    path = public_tokenizers.path("word_bpe_49k.json")
    made = token_files.write_shards(docs, path, _common.work_dir(spark, "t"), end_id=1)
    tok, at, want = Tokenizer.from_file(path), 0, []
    for i, t in sorted(table(), key=lambda r: (r[0], r[1] or "")):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows(token_files.read_shards(made)) == sorted(want)
    assert [r.ids for r in token_files.read_documents(made, [14]).collect()] == [tok.encode("one", add_special_tokens=False).ids + [1]]
    assert token_files.read_shards(token_files.write_shards(empty, path, _common.work_dir(spark, "t"), end_id=1)).count() == 0


def test_token_ids_are_exact():
    """Every assigned code point after capitals and marks, alone and composed, as the library encodes the whole text."""
    path = public_tokenizers.path("word_bpe_49k.json")
    tok, enc = Tokenizer.from_file(path), token_files.Encoder(path)
    odd = ["Y\u030a", "W\u030a", "H\u0331", "T\u0308", "J\u030c", "<|ENDOFTEXT|> Y\u030a A.", "<|endoftext|>Word, word", "WORD WORD. \u0130 \u03a3 \ufb01", "a\x1cb\x85c\u2003d"]
    points = [chr(c) for c in range(0x20, 0x30000) if not 0xD800 <= c < 0xE000]
    texts = odd + [f"Ab {''.join(points[k : k + 3])} X{points[k]} Y{points[k + 1 if k + 1 < len(points) else k]}." for k in range(0, len(points), 7)]
    assert [np.frombuffer(x, "<u2").tolist() for x in enc.encode([t.encode() for t in texts])] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_damaged_frame(tmp_path):
    with open(tmp_path / "x", "wb") as f:
        w = token_files.ShardWriter(f, 4)
        w.add(7, np.arange(600_000, dtype="<u4").tobytes())
        w.add(8, b"")
        w.close()
    r = token_files.ShardReader(f"file://{tmp_path}/x")
    assert len(r.table) == 4 and r.ids(0).tolist() == list(range(600_000)) and not len(r.ids(1))
    data = bytearray((tmp_path / "x").read_bytes())
    data[int(r.starts[1]) + 40] ^= 1
    (tmp_path / "x").write_bytes(data)
    with pytest.raises(Exception):  # noqa: B017  either the frame or its checksum is wrong
        token_files.ShardReader(f"file://{tmp_path}/x").ids(0)


def test_bpe(spark, docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok, want = Tokenizer.from_file(path), []
    for i, t in table():
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert rows(bpe.digest(docs, path)) == sorted(want)
    assert rows(bpe.decode(bpe.encode(docs, path), path)) == sorted((i, t or "") for i, t in table())
    assert bpe.digest(empty, path).count() == 0
    c, rnd = bpe.codec(path), random.Random(1)
    for _ in range(3000):
        s = "".join(rnd.choice(["a", "é", " ", "  ", "\n", "1", "!", "'s", "<|endoftext|>", "中", "\x85", "the"]) for _ in range(rnd.randint(0, 30)))
        assert np.frombuffer(c.encode(s), "<u4").tolist() == tok.encode(s, add_special_tokens=False).ids


def test_lengths(docs, empty):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    n = sorted(len(tok.encode(t or "", add_special_tokens=False).ids) for _, t in table())
    hist = lengths.histogram(docs, path)
    want = [(x, n.count(x), sum(y >= x for y in n), sum(y for y in n if y >= x), sum(min(x, y) for y in n)) for x in set(n)]
    assert rows(hist) == sorted(want)
    assert lengths.truncated_total(hist, 17) == sum(min(17, x) for x in n)
    assert [lengths.quantile(hist, q) for q in (0.1, 0.5, 1.0)] == [n[max(0, -(-len(n) * k // 10) - 1)] for k in (1, 5, 10)]
    assert lengths.histogram(empty, path).count() == 0 and lengths.quantile(lengths.histogram(empty, path), 0.5) is None


def test_suffixes(docs, empty):
    got = suffixes.remove_repeats(docs)
    assert {"unit", "data"} <= set(got.columns)
    want = sorted((i, n, g, s, h) for i, n, g, s, h in brute.op4(table()))
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.text)).hexdigest()) for r in got.collect()) == want
    assert suffixes.remove_repeats(empty).count() == 0


def test_large_groups():
    rnd, pairs = random.Random(2), []
    core = bytes(rnd.randrange(97, 100) for _ in range(300))
    for _ in range(90):
        pairs.append((bytes(rnd.randrange(97, 99) for _ in range(rnd.randint(0, 90))) + core[:120], core[120:] + bytes(rnd.randrange(97, 99) for _ in range(rnd.randint(0, 90)))))
    pairs = sorted({(r, x) for x, r in pairs})
    right, left = [p[0] for p in pairs], [p[1] for p in pairs]
    prefix = [0] + [suffixes.common(a, b) for a, b in zip(right, right[1:])]
    many = suffixes.stretches(right, prefix, left, [1] * len(right), 320)
    limit, suffixes.PAIRWISE = suffixes.PAIRWISE, 10**6
    try:
        assert many == suffixes.stretches(right, prefix, left, [1] * len(right), 320)
    finally:
        suffixes.PAIRWISE = limit


def test_loser_tree():
    rnd = random.Random(3)
    runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 9))) for _ in range(rnd.randint(1, 20))) for _ in range(7)]
    coded = [suffixes.front_code(r) for r in runs]
    assert [suffixes.front_decode(*c) for c in coded] == runs
    out = list(suffixes.merge([(r, c[0].tolist()) for r, c in zip(runs, coded)]))
    merged = [runs[k][i] for k, i, _ in out]
    assert merged == sorted(sum(runs, [])) and [p for _, _, p in out][1:] == [suffixes.common(a, b) for a, b in zip(merged, merged[1:])]


def test_simhash(docs, empty):
    assert rows(simhash.near_duplicates(docs, shingle=3)) == sorted(brute.op6(table()))
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_ids_connect_nothing(spark):
    """Null and repeated ids: each text meets its own copies only."""
    rnd = random.Random(7)
    a, b, c = (" ".join(f"w{rnd.randrange(10**6)}" for _ in range(60)) for _ in range(3))
    docs = spark.createDataFrame([(None, a), (None, b), (1, a), (2, b), (9, c), (9, a), (None, c)], SCHEMA)
    want = sorted([(None, 1), (None, 2), (1, 1), (2, 2), (9, 9), (9, 1), (None, 9)], key=str)
    for got in (simhash.near_duplicates(docs).select("doc_id", "component_id"), simhash.similar_documents(docs)):
        assert sorted((tuple(r) for r in got.collect()), key=str) == want
    alone = spark.createDataFrame([(None, a), (None, a), (4, b)], SCHEMA)
    assert sorted((tuple(r) for r in simhash.similar_documents(alone).collect()), key=str) == [(4, 4), (None, None), (None, None)]


def test_hot_groups(spark):
    """Keys of a third of all rows are met by broadcast; nothing changes."""
    rows_ = [(k, 0) for k in range(1, 400)] + [(k, k - 1) for k in range(1000, 1300)] + [(5, 999)]
    links = spark.createDataFrame(rows_, "u long, v long")
    got = dict(map(tuple, components.components(links, _common.work_dir(spark, "c")).collect()))
    assert got == {k: 0 for k in [*range(1, 400), *range(999, 1300)]}
    one = components.join_groups(links, links.groupBy("v").agg(F.max("u").alias("top"), F.count("*").alias("n")), "v", links.count())
    assert sorted((r.u, r.v, r.top) for r in one.collect()) == sorted((u, v, max(x for x, y in rows_ if y == v)) for u, v in rows_)


def test_left_out(spark):
    rows_ = spark.range(3000).selectExpr("case when id % 100 = 7 then null else id end id", "id x", "'t' _flag", "1 _page")
    gone = spark.range(0, 9000, 3).toDF("id")
    got = _common.left_out(rows_, gone, "id")
    assert got.columns == rows_.columns and sorted(r.x for r in got.collect()) == [k for k in range(3000) if k % 3 or k % 100 == 7]
    assert _common.left_out(rows_, gone.where("false"), "id").count() == 3000
    assert _common.flagged(rows_, gone, "id", "f").where("f").count() < 1100


def test_golay_keys():
    rnd = np.random.default_rng(1)
    fp = rnd.integers(0, 1 << 63, 400, dtype=np.uint64)
    other = fp.copy()
    for k in range(len(fp)):
        for b in rnd.choice(64, rnd.integers(0, 4), replace=False):
            other[k] ^= np.uint64(1 << int(b))
    a, b = (set(zip(r.tolist(), k.tolist())) for r, k in map(simhash.keys_of, (fp, other)))
    assert {r for r, _ in a & b} == set(range(len(fp)))


def test_similar(spark):
    rnd = random.Random(4)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(300)]
    near = [*words[:150], "changed", *words[151:]]
    docs = spark.createDataFrame([(5, " ".join(words)), (2, " ".join(near)), (9, " ".join(words).upper()), (7, " ".join(reversed(words))), (8, None)], SCHEMA)
    assert rows(simhash.similar_documents(docs)) == [(2, 2), (5, 2), (7, 7), (8, 8), (9, 2)]


def similar_groups(texts, least=0.8):
    """Brute force: the smallest index of each text's group over all pairs of five-word shingle sets."""
    words = [t.lower().split() for t in texts]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in words]
    group = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= least * len(a | sets[j]) - 1e-9:
                x, y = sorted((group[i], group[j]))
                group = [x if g == y else g for g in group]
    return group


def edited(rnd, n, share, kind, word):
    """Words, and a copy with about the share of them appended, cut off or replaced."""
    w, k = [word() for _ in range(n)], max(1, round(share * n))
    if kind == "appended":
        return w, w + [word() for _ in range(k)]
    if kind == "cut":
        return w, w[k:]
    return w, [word() if x in set(rnd.sample(range(n), max(1, k // 5))) else y for x, y in enumerate(w)]


def test_similar_is_complete(spark):
    rnd, texts = random.Random(8), []
    word = lambda: f"w{rnd.randrange(10**6)}"
    boiler = [word() for _ in range(60)]
    for k in range(90):
        a, b = edited(rnd, rnd.randint(30, 400), rnd.choice((0.05, 0.1, 0.15, 0.19, 0.24)), ("appended", "cut", "replaced")[k % 3], word)
        texts += [" ".join(x + boiler * (k % 4 == 0)) for x in (a, b)]
    want = similar_groups(texts)
    assert 100 < len(set(want)) < 150
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert rows(simhash.similar_documents(docs)) == list(enumerate(want))


def test_family_of_versions(spark, monkeypatch):
    """Pages of one vocabulary in other orders, each with an edit of it: failed links between pages hide none of the true ones."""
    rnd = random.Random(10)
    vocabulary, passage, texts = [f"w{k}" for k in range(120)], [f"p{k}" for k in range(300)], []
    for _ in range(40):
        page = rnd.sample(vocabulary, 120)
        texts += [" ".join(page), " ".join([*page[:60], "edit", *page[61:]])]
    for k in range(60):  # a chain of cuts, all over one passage, so that groups are large and their ends aren't similar
        texts.append(" ".join(passage[k * 3 : 120 + k * 3]))
    want = similar_groups(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    for limit in (simhash.PAIRWISE, 2):
        monkeypatch.setattr(simhash, "PAIRWISE", limit)
        assert rows(simhash.similar_documents(docs)) == list(enumerate(want))


def test_large_group_search():
    """A search over links that can fail leaves out true pairs; all pairs across labels bring them back."""
    rnd = np.random.default_rng(11)
    base = np.unique(rnd.integers(0, 1 << 63, 150, dtype=np.uint64))
    s = [np.sort(np.concatenate((base[:110], rnd.choice(base[110:], int(rnd.integers(5, 35)), replace=False)))) for _ in range(50)]
    n, at = np.array([len(x) for x in s]), np.zeros(50, np.int32)
    g = simhash.Sketches(np.arange(50), n, at, [simhash.sketch(x) for x in s], 0.8)
    true = {(i, j) for j in range(50) for i in range(j) if (b := len(np.intersect1d(s[i], s[j]))) >= 0.8 * (n[i] + n[j] - b)}
    pairs = {(int(a), int(b)) for u, v in g.across(np.arange(50)) for a, b in zip(u, v)}
    assert true <= pairs and sum(len(u) for u, _ in g.search()) < 50 and not list(g.across(np.zeros(50)))


def test_prefix_and_sketch():
    rnd = np.random.default_rng(9)
    for _ in range(300):
        n = int(rnd.integers(1, 200))
        x = np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64))
        y = np.unique(np.concatenate((x[rnd.random(len(x)) < 0.9], rnd.integers(0, 1 << 63, n // 10, dtype=np.uint64))))
        both = len(np.intersect1d(x, y))
        common = rnd.choice(x, len(x) // 3)
        p, q = (simhash.prefix(s, common, 0.8) for s in (x, y))
        assert simhash._differ(*(np.frombuffer(simhash.sketch(s), np.uint8) for s in (x, y))) <= len(x) + len(y) - 2 * both
        if both >= 0.8 * (len(x) + len(y) - both):
            i = next(k for k, m in enumerate(p) if m in q)
            assert simhash._may(len(x), len(y), i, q.tolist().index(p[i]), 0.8)


def test_stages_decide_by_row(spark, tmp_path):
    """Null and repeated ids: rows go for their own text only, and one row of a group stays."""
    rnd = random.Random(12)
    text = lambda: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(80))
    copy, twice, leak, *clean = (text() for _ in range(8))
    data = [(None, copy), (None, copy), (4, copy + " more"), (None, clean[0]), (None, clean[1]), (7, twice), (7, twice), (7, clean[2]), (8, clean[3]), (None, clean[4]), (None, clean[4])]
    docs = spark.createDataFrame(data, SCHEMA).withColumn("n_chars", F.length("text"))
    key = lambda r: (str(r[0]), r[1])
    got = corpus_pipeline.near_dedup_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r[:2] for r in map(tuple, got.collect())), key=key) == sorted([(4, copy + " more"), (None, clean[0]), (None, clean[1]), (7, twice), (7, clean[2]), (8, clean[3]), (None, clean[4])], key=key)
    spark.createDataFrame([("a", leak)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    data = [(None, leak), (None, clean[0]), (5, leak), (5, clean[1]), (6, clean[2])]
    got = corpus_pipeline.decontamination_stage(spark, spark.createDataFrame(data, SCHEMA), str(tmp_path))
    assert sorted(map(tuple, got.collect()), key=key) == sorted([(None, clean[0]), (5, clean[1]), (6, clean[2])], key=key)


def test_warc(spark):
    pages = [(1, "http://a/é x", "same"), (2, None, "same"), (3, "u", ""), (4, "u", None), (5, "v", "own\r\n\r\nbody é")]
    made = warc.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), _common.work_dir(spark, "w"))
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_archives(made).collect()}
    assert got == {1: (4, "revisit", 2), 2: (4, "response", None), 3: (0, "revisit", 4), 4: (0, "response", None), 5: (14, "response", None)}
    none = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), _common.work_dir(spark, "w"))
    assert warc.read_archives(none).count() == 0


def test_decontamination(spark, docs, empty):
    bench = [("a", " ".join(table()[17][1].split()[6:30])), ("b", "ONE"), ("c", None), (None, "x"), ("d", "!!"), ("e", "ab " * 30)]
    items = spark.createDataFrame(bench, "item_id string, text string")
    for size in (1 << 20, 40):
        got = decontaminate.contamination(docs, items, block_bytes=size)
        assert rows(decontaminate.digest(got)) == sorted(brute.op8(table(), bench))
    assert decontaminate.contamination(empty, items).count() == 0
    assert {r.n_hit for r in decontaminate.digest(decontaminate.contamination(docs, items.where("false"))).collect()} == {0}


def near_items(text, bench, width, slop):
    """Brute force of proximity: items with a window whose words all stand in some run of width + slop words."""
    w, out = decontaminate.words((text or "").encode()), set()
    for item, b in bench:
        b = decontaminate.words((b or "").encode())
        for k in range(max(1, len(b) - width + 1) if b and item else 0):
            need = set(b[k : k + width])
            reach = len(b[k : k + width]) + slop
            if any(need <= set(w[i : i + reach]) for i in range(len(w))):
                out.add(item)
    return sorted(out)


def test_proximity(spark):
    rnd = random.Random(13)
    line = lambda n: " ".join(rnd.choice("abcdefgh") + rnd.choice("xy") for _ in range(n))
    data = [(k, line(rnd.randint(0, 40))) for k in range(60)] + [(60, None), (60, "")]
    bench = [(f"i{k}", line(rnd.randint(3, 8))) for k in range(12)] + [("n", None), (None, "ax"), ("s", "bx")]
    docs, items = spark.createDataFrame(data, SCHEMA), spark.createDataFrame(bench, "item_id string, text string")
    for slop, size in ((0, 1 << 20), (4, 30)):
        got = decontaminate.contamination(docs, items, width=4, slop=slop, block_bytes=size).collect()
        assert sorted((r.doc_id, sorted(r["items"])) for r in got) == sorted((i, near_items(t, bench, 4, slop)) for i, t in data)


def test_topk(spark):
    rnd = np.random.default_rng(3)
    data = [(int(i), rnd.normal(size=40).astype("f4").tolist()) for i in range(90)] + [(90, None), (91, [float("nan")] * 40), (92, [None] * 40), (93, [1.0]), (100, [0.5] * 40), (101, [0.5] * 40), (102, [1e30] * 40), (None, [0.25] * 40)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    q = {i: np.floor(64 * np.array(v, float)) for i, v in data if v and None not in v and np.isfinite(v).all() and max(map(abs, v)) < 1e6}
    want = []
    for i in [i for i in q if i is not None and i % 20 == 0]:
        best = sorted(((-int(q[i] @ x), 1 << 62 if j is None else j) for j, x in q.items() if j != i and len(x) == len(q[i])))[:7]
        want += [(i, r, j, -s) for r, (s, j) in enumerate(best, 1)]
    got = [(a, b, 1 << 62 if c is None else c, d) for a, b, c, d in map(tuple, topk.exact_topk(df, df.where("vec_id % 20 = 0"), 7).collect())]
    assert sorted(got) == sorted(want)
    assert topk.exact_topk(df, df.where("false"), 3).count() == 0


def test_substrings(docs, empty):
    got = substrings.remove_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(" ".join(brute.words(r.text)).encode()).hexdigest()) for r in got) == sorted(brute.op10(table()))
    assert substrings.remove_repeats(empty).count() == 0


def test_quality(spark, empty):
    rnd = random.Random(6)
    good = lambda: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(60)) + "."
    data = [(k, good() if k % 5 else "!!! $$$ ### " * 30) for k in range(600)] + [(600, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(0, 600, 2)] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == 601 and all(0 <= r.score <= 1 for r in got) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert sum(r.predicted == (r.doc_id % 5 > 0) for r in got if r.doc_id < 600) > 590
    assert {r.score for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0


def test_non_negative_risk(spark):
    """The clamped risk of the fitted weights against plain subgradient descent, with a prior so high that the bracket clamps."""
    rnd = np.random.default_rng(14)
    x = np.concatenate((rnd.normal(1, 1, (60, 3)), rnd.normal(0, 1, (300, 3))))
    x = np.hstack((x, np.zeros((360, quality.WIDTH - 3)))).astype("<f4")
    kind = np.array([1] * 60 + [0] * 300)
    train = spark.createDataFrame([(r.tobytes(), int(k)) for r, k in zip(x, kind)], "f binary, kind int")
    for prior in (0.2, 0.95):
        m = quality.fit(train, prior)
        y = np.hstack((np.clip((x - m.mean) / m.scale, -8, 8), np.ones((len(x), 1))))
        w0 = np.append(np.ones(quality.WIDTH), 1e-6)

        def risk(w):
            g = y @ w
            a = prior * np.logaddexp(0, -g[kind == 1]).mean()
            b = np.logaddexp(0, g[kind == 0]).mean() - prior * np.logaddexp(0, g[kind == 1]).mean()
            return a + max(0, b) + quality.RIDGE * (w0 @ w**2), b

        w, best = np.zeros(len(w0)), np.inf
        for k in range(5000):
            g = y @ w
            p = 1 / (1 + np.exp(-g))
            grad = prior * ((p - 1)[kind == 1, None] * y[kind == 1]).mean(0) + 2 * quality.RIDGE * w0 * w
            if risk(w)[1] > 0:
                grad = grad + (p[kind == 0, None] * y[kind == 0]).mean(0) - prior * (p[kind == 1, None] * y[kind == 1]).mean(0)
            w = w - grad / (1 + k) ** 0.6
            best = min(best, risk(w)[0])
        assert risk(m.w)[1] >= 0 and risk(m.w)[0] < best + quality.SLACK


def test_clashing_counts(spark):
    """Columns called like a count are replaced, unless the counts get other names."""
    docs = spark.createDataFrame([(1, "a b", 7, 8, 9), (2, None, 7, 8, 9)], "doc_id long, text string, N_removed int, n_words int, n_spans int")
    for op, own in ((substrings, ("n_words", "n_removed")), (suffixes, ("n_bytes", "n_removed", "n_spans"))):
        got = op.remove_repeats(docs)
        assert len({c.lower() for c in got.columns}) == len(got.columns) and {r.n_removed for r in got.select("n_removed").collect()} == {0}
        free = tuple(_common.fresh(docs.columns, c) for c in own)
        assert {r.N_removed for r in op.remove_repeats(docs, names=free).select("N_removed").collect()} == {7}


def test_stages_shrink_heaps(spark, docs):
    """Executors (here the local one) collect their garbage when a stage of the pipeline starts, whatever the stage runs itself."""
    beans = lambda: spark.sparkContext._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    full = lambda: sum(b.getCollectionCount() for b in beans() if "Old" in b.getName() or "MarkSweep" in b.getName())
    before = full()
    corpus_pipeline.encoding_stage(spark, docs, "")  # writes nothing before its result is asked for
    assert full() > before
