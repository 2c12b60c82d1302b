"""The corpus pipeline, stage by stage, against the SQL form or brute force of each operator."""

import hashlib
import struct

import corpus_pipeline
import pytest

from strata.llm import decontaminate, language_id, ngram_jaccard, quality_rules
from strata.llm.common import read_table
from strata.llm.queries import TOKENIZER
from strata.session import scratch_dir

from .conftest import oracle

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage gets and gives, each written and read again."""
    docs, out = read_table(spark, SF, "documents"), {}
    root = scratch_dir(spark, "stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{root}/{name}")
        out[name] = (docs, docs := spark.read.parquet(f"{root}/{name}"))
    return out


def test_stages_are_in_order_and_keep_the_columns(spark, stages):
    assert list(stages) == ["language_id", "quality_rules", "ngram_jaccard", "decontaminate", "bpe"]
    columns = read_table(spark, SF, "documents").dtypes
    for name in list(stages)[:-1]:
        assert stages[name][1].dtypes == columns


def test_language_stage(stages):
    before, after = stages["language_id"]
    verdicts = language_id.identify(before, language_id.train(before))
    assert ids(after) == ids(verdicts.where("lang_pred != 'und' and score >= 0.3"))


def test_language_stage_rejects_what_was_never_learned(spark):
    docs = read_table(spark, SF, "documents")
    foreign = ["漢字學習中文文本 天氣很好 我們今天去公園", "это большой дом и много хороших слов", "αυτό είναι ένα μεγάλο σπίτι",
               "gdzie jest najbliższa stacja kolejowa proszę pana", "Pohjois-Suomessa sataa lunta ja järvet ovat jäässä koko talven",
               "wkjq zxvq pqkx jjqz wvkx qqzx kkwj", "漢字學習中文文本天氣很好 the and"]
    ids_of = range(10**9, 10**9 + len(foreign))
    rows = spark.createDataFrame([(i, t, "xx", "s", len(t)) for i, t in zip(ids_of, foreign)], docs.schema)
    model = language_id.with_limits(docs, language_id.train(docs))
    assert language_id.keep(rows, model).count() == 0
    assert language_id.identify(rows, model).where("lang_pred != 'und' and score >= 0.3").count() == len(foreign)
    before = docs.join(language_id.identify(docs, model).where("lang_pred != 'und' and score >= 0.3"), "doc_id", "left_semi")
    assert ids(language_id.keep(docs, model)) == ids(before)


def test_quality_stage(stages):
    before, after = stages["quality_rules"]
    rows, names = oracle(quality_rules.ORACLE_SQL, documents=before)
    kept = [r[names.index("doc_id")] for r in rows if r[names.index("kept")]]
    assert ids(after) == sorted(kept) and len(kept) < before.count()


def test_near_duplicate_stage(stages):
    before, after = stages["ngram_jaccard"]
    rows, names = oracle(ngram_jaccard.ORACLE_SQL, documents=before)
    assert ids(after) == sorted({r[names.index("component_id")] for r in rows})


def test_decontamination_stage(spark, stages):
    before, after = stages["decontaminate"]
    rows, names = oracle(decontaminate.ORACLE_SQL, documents=before, benchmark=read_table(spark, SF, "benchmark"))
    assert ids(after) == sorted(r[names.index("doc_id")] for r in rows if not r[names.index("contaminated")])


def test_bpe_stage_and_run(spark, stages):
    before, after = stages["bpe"]
    tokenizer = pytest.importorskip("tokenizers").Tokenizer.from_file(TOKENIZER)
    expected = []
    for r in before.collect():
        found = tokenizer.encode(r["text"], add_special_tokens=False).ids
        expected.append((r["doc_id"], len(found), hashlib.sha256(struct.pack(f"<{len(found)}I", *found)).hexdigest(),
                         hashlib.sha256(r["text"].encode()).hexdigest()))
    assert sorted(map(tuple, after.collect())) == sorted(expected)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(expected)


def test_stages_on_odd_and_empty_rows(spark, odd_docs):
    plain = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (plain, plain.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF).columns == docs.columns
            assert stage(spark, docs, SF).count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
