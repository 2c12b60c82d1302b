"""Operators beyond SQL, against brute force, exact round trips and held-out rows."""

import hashlib
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from strata.llm import bpe, common, language_id, quality_rda, sharding, shingles
from strata.llm.queries import TOKENIZER

from .conftest import doc, frame, words

SF = "/root/testdata/sf0.01"
ALPHABET = [chr(c) for c in [*range(0x180), 0x85, 0xA0, 0x1680, 0x2028, 0x3000, 0x301, 0x4E2D, 0x1F600, 0x200D, 0x660, 0x10400]]


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(TOKENIZER)


def test_bpe_rows_against_the_library(odd_docs, tokenizer):
    rows = bpe.encode(odd_docs, TOKENIZER, with_ids=True).collect()
    expected = Counter()
    for r in odd_docs.select("doc_id", "text").collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        expected[(r["doc_id"], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                  hashlib.sha256(text.encode()).hexdigest(), tuple(ids))] += 1
    assert Counter((r[0], r[1], r[2], r[3], tuple(r["ids"])) for r in rows) == expected
    assert bpe.encode(odd_docs.limit(0), TOKENIZER).count() == 0


def test_bpe_any_characters_and_special_tokens(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    texts += ["a<|endoftext|>b <|endoftext|>", "<|endoftext|", "aaaaaaaaaaaaaaaaaaaa", "   x\n\n  ", "ab" * 500]
    codec = bpe.Codec(bpe.load(TOKENIZER), cache_bytes=100_000)
    for part in (texts[:1500], texts[1500:]):
        for text, packed, ref in zip(part, codec.encode_block(part), tokenizer.encode_batch(part, add_special_tokens=False)):
            assert packed == struct.pack(f"<{len(ref.ids)}I", *ref.ids), text
            assert codec.decode(packed) == tokenizer.decode(ref.ids, skip_special_tokens=False)


def _shingle_set(text):
    ws = text.encode().lower().split()
    return {b" ".join(ws[i:i + 5]) for i in range(max(len(ws) - 4, 1))} if ws else set()


def test_shingle_sets_are_those_of_the_words(monkeypatch):
    texts = [None, "", " ", "one two", "ONE  two", words(1, 300, 5), words(2, 40), "é É " * 9, "x" * 500 + " y z a b c",
             "a\x0bb\x0cc\rd\te f", words(3, 2000)]
    whole = [s.tolist() for s in shingles.shingle_sets(texts)]
    assert [len(s) for s in whole] == [len(_shingle_set(t or "")) for t in texts]
    assert whole[3] == whole[4] and all(s == sorted(set(s)) for s in whole)
    for block in (16, 100, 1000):  # texts hashed in pieces have the same sets
        monkeypatch.setattr(shingles, "BLOCK_BYTES", block)
        assert [s.tolist() for s in shingles.shingle_sets(texts)] == whole


def test_quality_held_out(spark):
    docs, labels = common.read_table(spark, SF, "documents"), common.read_table(spark, SF, "labels")
    rows = quality_rda.classify(docs, labels).join(labels, "doc_id").collect()
    held = [(r["score"], r["quality"]) for r in rows if r["held_out"]]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_quality_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 16)] + [(4, None, 0), (None, 1, 0), (999, 1, 1), (10, 5, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_rda.classify(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    for few, share in ((labels.limit(0), 0.5), (labels.where("doc_id = 10"), None)):
        scores = {r["score"] for r in quality_rda.classify(odd_docs, few).collect()}
        assert len(scores) == 1 and (share is None or scores.pop() == pytest.approx(share))
    assert quality_rda.classify(odd_docs.limit(0), labels).count() == 0


def test_quality_factors_are_the_density():
    rng = np.random.default_rng(0)
    d = len(quality_rda.FEATURES)
    covs = [np.cov(rng.normal(size=(d, 3 * d))) for _ in range(2)]
    means = rng.normal(size=(2, d))
    model = {"share": 0.4, "means": means, "factors": [np.linalg.inv(np.linalg.cholesky(c)) for c in covs]}
    x = rng.normal(size=(5, d))
    density = lambda c, m: np.array([-0.5 * (v - m) @ np.linalg.solve(c, v - m) - 0.5 * np.linalg.slogdet(c)[1] for v in x])
    expected = density(covs[1], means[1]) - density(covs[0], means[0]) + np.log(0.4 / 0.6)
    assert np.allclose(quality_rda.log_ratio(model, x), expected)


def test_language_held_out(spark):
    docs = common.read_table(spark, SF, "documents")
    rows = language_id.identify(docs, language_id.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r["lang_pred"] == r["lang"] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.97


def _best_path(scores):
    """Brute force: the usual Viterbi recursion, one word at a time."""
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        step = value[None, :] - language_id.SWITCH * (1 - np.eye(len(row)))
        back.append(step.argmax(1))
        value = step.max(1) + row
    total, path = value.max(), [int(value.argmax())]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return total, path[::-1]


def test_paths_of_a_block_are_the_best_ones():
    rng = np.random.default_rng(1)
    sizes = [3, 0, 1, 40, 7, 40, 0, 12]
    bounds = np.cumsum([0] + sizes)
    scores = rng.normal(scale=15, size=(bounds[-1], 4))
    labels = language_id._best_paths(scores, bounds)
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b > a:
            own = labels[a:b]
            total = scores[np.arange(a, b), own].sum() - language_id.SWITCH * (own[1:] != own[:-1]).sum()
            assert total == pytest.approx(_best_path(scores[a:b])[0])


@pytest.fixture(scope="module")
def trained(spark):
    texts = {"en": "the weather and the whole thing with that house", "fr": "que les oiseaux avec une maison pour la nuit",
             "ru": "это большой дом и много хороших слов", "el": "αυτό είναι ένα μεγάλο σπίτι"}
    rows = [doc(i, f"{t} {t}", lang) for i in range(40) for lang, t in texts.items()]
    return texts, language_id.train(frame(spark, rows + [doc(900, "text", None), doc(901, None, "xx"), doc(903, "123", "yy")]))


def test_language_scripts_spans_and_odd_rows(spark, trained, odd_docs, monkeypatch):
    texts, model = trained
    assert model["langs"] == sorted(texts)
    mixed = f"{texts['en']}. {texts['ru']}! {texts['fr']}"
    df = frame(spark, [doc(1, mixed), doc(2, texts["el"]), doc(3, None), doc(4, "12 + 3"), doc(5, "漢字"), doc(6, texts["fr"].upper())])
    got = {r["doc_id"]: r for r in language_id.identify(df, model, with_spans=True).collect()}
    assert [s["lang"] for s in got[1]["spans"]] == ["en", "ru", "fr"]
    assert mixed[got[1]["spans"][1]["start"]:got[1]["spans"][1]["end"]] == texts["ru"]
    assert got[2]["lang_pred"] == "el" and got[6]["lang_pred"] == "fr" and got[5]["lang_pred"] in model["langs"]
    assert (got[3]["lang_pred"], got[3]["score"]) == (got[4]["lang_pred"], got[4]["score"]) == ("und", 0.0)
    odd = language_id.identify(odd_docs, model)
    assert odd.count() == odd_docs.count() and language_id.identify(odd_docs.limit(0), model).count() == 0
    kept = language_id.keep(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.count() == odd.where("lang_pred != 'und' and score >= 0.3").count()


def test_language_pieces_and_blocks_agree(trained, monkeypatch):
    texts, model = trained
    sample = [" ".join(texts.values()), "", texts["fr"] * 3, "word"] * 3
    whole = [tuple(map(list, w[1:])) for w in language_id._labelled(model, sample)]
    for block, piece in ((25, 25), (1000, 25), (25, 1000)):
        monkeypatch.setattr(language_id, "BLOCK_CHARS", block)
        monkeypatch.setattr(language_id, "PIECE_CHARS", piece)
        assert [tuple(map(list, w[1:])) for w in language_id._labelled(model, sample)] == whole


def test_a_worker_keeps_no_memory_of_its_tasks(trained):
    """Over rounds of tagging and encoding, what a process holds does not go up."""
    import os
    _, model = trained
    texts = [words(i, 3000, 60_000) for i in range(300)]
    table = bpe.load(TOKENIZER)

    def held():
        return int(open("/proc/self/statm").read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 1e6

    def tasks():
        list(common.released(lambda b: (list(language_id._labelled(model, texts)), iter(b))[1])(iter([])))
        list(common.released(lambda b: (bpe.Codec(table).encode_block(texts), iter(b))[1])(iter([])))

    tasks()
    first = held()
    for _ in range(3):
        tasks()
    assert held() < first + 40


def test_language_without_training_rows(spark, odd_docs):
    model = language_id.train(odd_docs.limit(0))
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, model).collect()} == {"und"}


@pytest.mark.parametrize("shards", [1, 7, 16, 50])
def test_sharding_laws(spark, shards):
    rows = [doc(i, words(i, i % 9), "en", ["hot", "hot", "hot", "a", "b", None][i % 6]) for i in range(997)]
    df = frame(spark, rows)
    got = sharding.shard(df, shards).collect()
    assert len(got) == 997 and {r["law"] for r in got} == {"rows"}
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(shards)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(n))
    source = {r["doc_id"]: r["source"] for r in rows and df.select("doc_id", "source").collect()}
    per = Counter((r["shard"], source[r["doc_id"]]) for r in got)
    for name in set(source.values()):
        share = sum(1 for v in source.values() if v == name) / 997
        assert all(abs(per[(s, name)] - share * n) <= 2 for s, n in sizes.items())
    text = {r["doc_id"]: (r["text"] or "").encode() for r in df.select("doc_id", "text").collect()}
    assert all(r["size"] == len(text[r["doc_id"]]) + 1 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]]) for r in got)


def test_sharding_follows_fractional_ranks(spark):
    """Brute force: rank by seeded hash in each source, sort by fraction, cut."""
    df = frame(spark, [doc(i, f"t{i}", "en", "ab"[i % 3 == 0]) for i in range(200)])
    rows = df.select("doc_id", "source").collect()
    key = {r["doc_id"]: hashlib.md5(f"strata:{r['doc_id']}".encode()).hexdigest() for r in rows}
    fraction = []
    for s in "ab":
        own = sorted((key[r["doc_id"]], r["doc_id"]) for r in rows if r["source"] == s)
        fraction += [((i + 0.5) / len(own), s, d) for i, (_, d) in enumerate(own)]
    order = [d for _, _, d in sorted(fraction)]
    got = sorted(sharding.shard(df, 8).collect(), key=lambda r: (r["shard"], r["slot"]))
    assert [r["doc_id"] for r in got] == order


def test_sharding_odd_rows(odd_docs):
    got = sharding.shard(odd_docs).collect()
    assert len(got) == odd_docs.count() and [r["size"] for r in got if r["doc_id"] == 1] == [1]
    assert sharding.shard(odd_docs.limit(0)).count() == 0


def test_discriminant_fit_is_that_of_the_labelled_rows(spark):
    rng = np.random.default_rng(5)
    d = len(quality_rda.FEATURES)
    vectors = [rng.normal(size=d) @ rng.normal(size=(d, d)) + (i % 3) for i in range(400)]
    rows = [(i, zlib.crc32(str(i).encode()) % 5 == 0, [float(x) for x in v]) for i, v in enumerate(vectors)]
    marks = [(i, int(i % 3 == 0)) for i in range(380)] + [(5, None), (900, 1)]
    model = quality_rda.fit(spark.createDataFrame(rows, "doc_id long, held_out boolean, x array<double>"),
                            spark.createDataFrame(marks, "doc_id long, quality int"))
    learned = [np.array([vectors[i] for i in range(380) if int(i % 3 == 0) == y and not rows[i][1]]) for y in (0, 1)]
    total = sum(map(len, learned))
    assert model["share"] == len(learned[1]) / total
    pooled = sum(len(x) * np.cov(x.T, bias=True) for x in learned) / total
    for x, mean, factor in zip(learned, model["means"], model["factors"], strict=True):
        np.testing.assert_allclose(mean, x.mean(0), rtol=1e-9, atol=1e-9)
        own = (1 - quality_rda.SHRINK) * np.cov(x.T, bias=True) + quality_rda.SHRINK * pooled
        cov = (1 - quality_rda.DIAGONAL) * own + quality_rda.DIAGONAL * np.diag(np.diag(pooled)) + quality_rda.RIDGE * np.eye(d)
        np.testing.assert_allclose(factor.T @ factor, np.linalg.inv(cov), rtol=1e-5, atol=1e-7)


def test_language_counts_are_those_of_the_training_words(spark):
    texts = {"aa": ["Ábc abc, d", None, "", "été 12 xy"], "bb": ["где мы", "abc", "où"], None: ["zzz"]}
    rows = [doc(10 * n + i, t, lang) for n, (lang, ts) in enumerate(texts.items()) for i, t in enumerate(ts)]
    model = language_id.train(frame(spark, rows))
    bucket = lambda h: ((h * 0x9E3779B1) >> 17) & (language_id.BUCKETS - 1)
    counts = {}
    scripts = {}
    for r in rows:
        if r[2] is None or r[1] is None or zlib.crc32(str(r[0]).encode()) % 5 == 0:
            continue
        own, letters = counts.setdefault(r[2], Counter()), scripts.setdefault(r[2], Counter())
        for word in "".join(c.lower() if c.isalpha() else " " for c in r[1]).split():
            letters.update("cyrillic" if "а" <= c <= "я" else "latin" for c in word)
            codes = [0, 0, *map(ord, word), 0]
            for two, one, c in zip(codes, codes[1:], codes[2:]):
                own[bucket(one * 1_000_003 + c + 0x51ED)] += 1
                own[bucket(one * 1_000_003 + c + (two if one else 0) * 998_244_353 + 0xA3C7)] += 1
    assert model["langs"] == sorted(counts)
    for lang, logs in zip(model["langs"], model["logs"], strict=True):
        expected = np.full(language_id.BUCKETS, 0.5)
        for slot, n in counts[lang].items():
            expected[slot] += n
        np.testing.assert_allclose(logs, np.log(expected / expected.sum()), rtol=1e-5)
    for script, place in (("latin", 1), ("cyrillic", 3)):
        has = [scripts[x][script] / sum(scripts[x].values()) >= language_id.MIN_SCRIPT_SHARE for x in model["langs"]]
        assert model["known"][place] == any(has) and model["candidates"][place].tolist() == (has if any(has) else [True] * 2)
