"""Token files, periodic runs and spelling variants, against the library and brute force."""

import hashlib
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from strata.llm import periodic_runs, spelling, token_file
from strata.llm.common import read_table, slices
from strata.llm.queries import TOKENIZER
from strata.session import scratch_dir

from .conftest import doc, frame, words

SF = "/root/testdata/sf0.001"
ALPHABET = [chr(c) for c in [*range(0x180), 0x85, 0xA0, 0x1680, 0x2028, 0x3000, 0x301, 0x4E2D, 0x1F600, 0x200D, 0x660]]


@pytest.fixture(scope="module")
def tokenizer():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(TOKENIZER)


# ---- token files


def test_parts_have_the_ids_of_the_whole(tokenizer):
    rng = random.Random(5)
    encoder = token_file.Encoder(Path(TOKENIZER).read_text(), cache_bytes=20_000)
    white = [" ", " ", " ", "\n", "\t", " ", "\x1c", "a", "é", "'s", ",", "7", "<|endoftext|>", "漢"]
    texts = ["".join(rng.choice(white) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    texts += ["a  b", "a   b ", "  ", " ", "", "x \n y", "x\n  y", "x  <|endoftext|>y", "it's  'll  ", words(3, 3000)]
    for part in (texts[:3000], texts[3000:]):
        expected = tokenizer.encode_batch(part, add_special_tokens=False)
        for text, ids, ref in zip(part, encoder.encode(part), expected, strict=True):
            assert ids.tolist() == ref.ids, repr(text)
    assert encoder.type == np.uint16


def _stream(rows, tokenizer):
    """(doc_id, text) in stream order, with their ids and the end id."""
    return [(d, [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]) for d, t in rows]


def test_files_hold_the_stream(spark, odd_docs, tokenizer):
    folder = scratch_dir(spark, "token-file-test")
    manifest = token_file.write(odd_docs, TOKENIZER, folder, sequence=64, batch=4)
    files = sorted(manifest.collect(), key=lambda r: r["part"])
    expected = Counter((d, tuple(ids)) for d, ids in _stream([(r["doc_id"], r["text"]) for r in odd_docs.collect()], tokenizer))
    found, order = Counter(), []
    for row in files:
        file = token_file.SequenceFile(row["file"], row["documents"])
        ids = np.concatenate([file.ids(i) for i in range(len(file))])
        mask = np.concatenate([np.array(file.mask(i)) for i in range(len(file))])
        assert all(len(file.ids(i)) == 64 == len(file.mask(i)) for i in range(len(file)))
        assert mask[:row["n_ids"]].all() and not mask[row["n_ids"]:].any() and not ids[row["n_ids"]:].any()
        assert len(mask) - row["n_ids"] < 64
        for batch in file.document_rows():
            for d, first, n in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.concatenate(list(file.stretch(first, n)))
                assert own.tolist() == ids[first:first + n].tolist()
                found[(d, tuple(own.tolist()))] += 1
                order.append(d)
        assert row["n_documents"] == sum(b.num_rows for b in file.document_rows())
    assert found == expected
    assert order == sorted(order, key=lambda d: (d is not None, d))


def test_sequences_are_views_of_the_map(spark, tokenizer):
    df = frame(spark, [doc(i, words(i, 300)) for i in range(20)]).coalesce(1)
    row = token_file.write(df, TOKENIZER, scratch_dir(spark, "token-file-test"), sequence=32, batch=8).first()
    file = token_file.SequenceFile(row["file"], row["documents"])
    before = pa.total_allocated_bytes()
    views = [file.ids(i) for i in (0, 5, len(file) - 1, 3)]
    assert pa.total_allocated_bytes() - before < 1000 and not any(v.flags.writeable or v.flags.owndata for v in views)
    assert views[0].dtype == np.uint16


def test_digest_and_starts(spark, odd_docs, tokenizer):
    for df in (read_table(spark, SF, "documents"), odd_docs):
        rows = token_file.digest(token_file.write(df, TOKENIZER, scratch_dir(spark, "token-file-test"))).collect()
        stream = _stream([(r["doc_id"], r["text"]) for r in df.collect()], tokenizer)
        crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
        assert Counter((d, len(ids), crc(ids)) for d, ids in stream) == Counter((r[0], r[2], r[3]) for r in rows)
        rows.sort(key=lambda r: r["start"])
        assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()
        assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d))
    empty = token_file.write(odd_docs.limit(0), TOKENIZER, scratch_dir(spark, "token-file-test"))
    assert empty.count() == 0 and token_file.digest(empty).count() == 0


def test_a_hot_id_spreads_over_files(spark):
    df = frame(spark, [doc(7, words(1, 200))] * 400 + [doc(i, words(i, 50)) for i in range(100)]).repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_file.write(df, TOKENIZER, scratch_dir(spark, "token-file-test"))
        assert max(r["n_documents"] for r in manifest.collect()) < 200
        assert token_file.digest(manifest).where("doc_id = 7").count() == 401
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_files_of_a_lost_attempt_are_ignored(spark, tokenizer):
    folder = scratch_dir(spark, "token-file-test")
    df = frame(spark, [doc(i, words(i, 20)) for i in range(30)])
    manifest = token_file.write(df, TOKENIZER, folder)
    stray = token_file.SequenceWriter(f"{folder}/data", "part-000000-stray", np.dtype("<u2"))
    stray.add(pa.array([99]), [np.array([1, 2], np.uint16)], 0)
    stray.close()
    assert token_file.digest(manifest).count() == 30 and token_file.digest(manifest).where("doc_id = 99").count() == 0


# ---- periodic runs


def _runs_by_hand(s, least=2, repeats=2):
    """Every run, straight from the definition."""
    found = set()
    for p in range(1, len(s) // repeats + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            if j - i + p >= max(least, repeats * p):
                # p is the smallest period of the stretch
                if not any(all(s[k] == s[k + q] for k in range(i, j + p - q)) for q in range(1, p)):
                    found.add((i, j - i + p, p))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def test_runs_of_all_small_and_many_random_strings():
    rng = random.Random(9)
    for n in range(9):
        for code in range(2 ** n):
            s = [code >> k & 1 for k in range(n)]
            assert [tuple(r) for r in periodic_runs.runs_of(np.array(s, np.int64)).tolist()] == _runs_by_hand(s), s
    for _ in range(400):
        s = []
        while len(s) < rng.randint(1, 60):
            s += [rng.randrange(rng.choice([2, 3, 9])) for _ in range(rng.randint(1, 5))] * rng.randint(1, 5)
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(s, np.int64)).tolist()] == _runs_by_hand(s), s
        assert [tuple(r) for r in periodic_runs.runs_of(np.array(s, np.int64), 6, 3).tolist()] == _runs_by_hand(s, 6, 3), s


def test_common_extensions():
    rng = np.random.default_rng(2)
    s = np.concatenate([rng.integers(0, 2, 40), np.zeros(30, np.int64), rng.integers(0, 3, 40)]).tolist()
    tour, leaf_at = periodic_runs.suffix_tree([*s, 3], 4)
    a, b = rng.integers(0, len(s) + 1, (2, 500))
    a, b = a[a != b], b[a != b]
    full = [*s, 3]
    brute = [next(k for k in range(len(full)) if max(i, j) + k >= len(full) or full[i + k] != full[j + k]) for i, j in zip(a, b)]
    assert periodic_runs.common_extensions(tour, leaf_at, a, b).tolist() == brute


def _expected_row(doc_id, text):
    ws = [w for w in (text or "").encode().split()]
    n, h = len(ws), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[a + (i - a) % p] if i >= a else w for i, w in enumerate(ws)]
    runs = _runs_by_hand(ws, 24, 3)
    drop = {i for a, n_, p in runs for i in range(a + p, a + n_)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(ws) if i not in drop)).hexdigest())


@pytest.fixture(scope="module")
def periodic_docs(spark):
    rng = random.Random(4)
    rows = [doc(100 + i, " ".join(words(i, 3 + i % 11, 50).split() * rng.randint(1, 12)) + " " + words(i, i % 40)) for i in range(120)]
    rows += [doc(300 + i, words(i, 60, 2)) for i in range(40)]  # two words: runs inside runs
    rows += [doc(400, "a " * 24), doc(401, "a " * 23), doc(402, "a b c d e f g h " * 3), doc(403, "a b c d e f g h " * 2 + "a b c d e f g"),
             doc(404, " x " * 30), doc(405, "y\x0by\x0cy\x1cy " * 30), doc(406, words(1, 40) + " " + "p q r " * 20 + words(2, 40) + " q r" * 30)]
    return frame(spark, rows)


def test_periodic_rows_against_brute_force(spark, periodic_docs, odd_docs):
    for df in (periodic_docs, odd_docs.where("doc_id is null or doc_id not in (4, 5)")):
        expected = Counter(_expected_row(r["doc_id"], r["text"]) for r in df.collect())
        assert Counter(map(tuple, periodic_runs.detect(df, rewrite=True).collect())) == expected
    assert sum(n > 0 for _, n, *_ in expected) >= 1
    assert periodic_runs.detect(odd_docs.limit(0)).count() == 0 and periodic_runs.detect(odd_docs).count() == odd_docs.count()


def test_periodic_blocks_and_trees_of_any_size(periodic_docs, monkeypatch):
    rows = periodic_docs.select("doc_id", "text").collect()
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    whole = periodic_runs._block_rows(ids, texts, 24, 3, True)
    monkeypatch.setattr(periodic_runs, "TREE_WORDS", 30)
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    blocks = list(slices(batch.slice(3), 1, 300))
    assert len(blocks) > 20 and sum(map(len, blocks)) == len(ids) - 3
    assert [r for b in blocks for r in periodic_runs._block_rows(b[0].to_pylist(), b[1].to_pylist(), 24, 3, True)] == whole[3:]


def test_a_very_long_periodic_text():
    text = " ".join((words(1, 1000, 10_000).split()) * 60 + words(2, 500, 10_000).split())
    row, = periodic_runs._block_rows([1], [text], 24, 3, False)
    assert row[:4] == (1, 0, 60_000, 1000) or row[0] >= 1 and row[1:4][1] >= 60_000 and row[3] == 1000


# ---- spelling variants


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _groups_by_hand(rows):
    import re
    n = Counter()
    for doc_id, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [x for x in n if _near(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.fixture(scope="module")
def misspelt(spark):
    rng = random.Random(8)
    base = ["".join(rng.choice("abéÀÿ÷") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    base += [b[:i] + c + b[i + 1:] for b in base[:20] for i in (0, 2, len(b) - 1) for c in "aé"]
    base += [b[:i] + b[i + 1:] for b in base[:30] for i in (0, 1, len(b) - 1)] + [b + "a" for b in base[:20]]
    weights = [rng.choice([1, 2, 5, 20, 90]) for _ in base]
    rows = [doc(i if i % 50 else None, " ".join(rng.choices(base, weights, k=60)).upper() if i % 7 == 0
                else "-".join(rng.choices(base, weights, k=60))) for i in range(150)]
    rows += [doc(900 + i, "x" * 300 + " " + "x" * 150 + "y" + "x" * 149 + " " + "x" * 299 + " aaaaa aaaaaa aaaaaaa") for i in range(9)]
    return frame(spark, rows)


@pytest.mark.parametrize("tile", [spelling.TILE, 8])
def test_groups_against_brute_force(spark, misspelt, odd_docs, tile, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 50)
    for df in (misspelt, odd_docs):
        rows = spelling.group(df, drop_one_in=97, tile=tile).collect()
        assert len(rows) == len(set(rows)) and set(map(tuple, rows)) == _groups_by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
    assert spelling.group(odd_docs.limit(0)).count() == 0


def test_words_of_the_given_table_keep_their_pairs(spark):
    df = read_table(spark, SF, "documents")
    rows = spelling.group(df, drop_one_in=97).collect()
    assert {r["word"]: r["n"] for r in rows if r["root"] == r["word"]}.keys() >= {r["root"] for r in rows}
    count = {r["word"]: r["n"] for r in rows}
    near = Counter(a for a in count for b in _one_edit(a) if b in count)
    assert {r["word"]: r["n_near"] for r in rows} == {w: near[w] for w in count}
    assert all(r["form_n"] == count[r["form"]] >= 2 * r["n"] for r in rows if r["form"])
    steps = {r["word"]: r["form"] for r in rows}
    for r in rows:
        at = r["word"]
        while steps[at]:
            at = steps[at]
        assert at == r["root"]


def _one_edit(w):
    letters = [chr(c) for c in [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]]
    out = {w[:i] + w[i + 1:] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    return (out | {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}) - {w}
