"""The operators that SQL can state, against it, on odd rows and on driver tables."""

import random
import textwrap
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strata.llm import common, decontaminate, licenses, ngram_jaccard, quality_rules, url_rules, warc_revisit

from .conftest import doc, frame, same, words

SF = "/root/testdata/sf0.001"


def python_nodes(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [n for n in ("Python", "Pandas", "Arrow", "MapIn") if n in plan]


def test_decontaminate_odd_rows(odd_docs, odd_benchmark):
    got = decontaminate.judge(odd_docs, odd_benchmark)
    same(got, decontaminate.ORACLE_SQL, documents=odd_docs, benchmark=odd_benchmark)
    assert not python_nodes(got)


def test_decontaminate_blocks_give_the_same(odd_docs, odd_benchmark):
    one = decontaminate.judge(odd_docs, odd_benchmark).collect()
    for blocks in ({"block_windows": 3}, {"block_bytes": 2500}):
        many = decontaminate.judge(odd_docs, odd_benchmark, **blocks).collect()
        assert sorted(map(str, one)) == sorted(map(str, many))


def test_decontaminate_windows_that_begin_alike(spark):
    """Question templates: many items, and places in the texts, share their opening words."""
    opening = "one of the "
    bench = spark.createDataFrame([(i, opening + words(i, 24, 9000)) for i in range(300)], "item_id long, text string")
    df = frame(spark, [doc(i, (opening + words(500 + i, 20, 9000) + " ") * 30) for i in range(60)]
               + [doc(900, words(7, 9) + " " + opening + words(17, 24, 9000) + " " + words(8, 9))])
    got = decontaminate.judge(df, bench)
    same(got, decontaminate.ORACLE_SQL, documents=df, benchmark=bench)
    assert got.where("n_hit > 0").select("doc_id").first()[0] == 900
    # each test window has a key of its own, whatever it begins with
    grams = decontaminate.test_windows(bench)
    assert grams.select("hash").distinct().count() == grams.select("gram").distinct().count()


def test_copies_are_put_out_in_chunks(spark):
    df = spark.createDataFrame([(1, 10), (2, 1), (None, 3)], "id long, copies long")
    for chunk in (1, 3, 100):
        assert Counter(r["id"] for r in common.repeated(df, "copies", chunk).collect()) == {1: 10, 2: 1, None: 3}
    assert common.repeated(df.limit(0), "copies").count() == 0


def test_broadcasts_are_bounded_in_bytes(spark):
    wide = spark.createDataFrame([(i, {"h": "x" * 1000}) for i in range(50)], "id long, headers map<string,string>")
    hinted = lambda df: "Hint" in df._jdf.queryExecution().logical().toString()
    assert hinted(common.broadcast_if_small(wide)) and not hinted(common.broadcast_if_small(wide, max_bytes=10_000))
    assert not hinted(common.broadcast_if_small(wide, max_rows=10))


def test_filters_keep_columns_named_like_their_helpers(odd_docs, odd_benchmark):
    names = ("_bad_id", "_bad_key", "_hit_id", "_hit_key", "_spans", "_pieces", "_left", "_kept_id", "_again")
    clash = odd_docs.selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(names)])
    for act in (lambda d: decontaminate.drop_contaminated(d, odd_benchmark), lambda d: decontaminate.cut_spans(d, odd_benchmark),
                ngram_jaccard.keep_one, quality_rules.keep):
        out, plain = act(clash), act(odd_docs)
        assert out.columns == clash.columns
        assert sorted(map(str, out.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_decontaminate_empty_tables(spark, odd_docs, odd_benchmark):
    assert decontaminate.judge(odd_docs.limit(0), odd_benchmark).count() == 0
    clean = decontaminate.judge(odd_docs, odd_benchmark.limit(0))
    assert clean.count() == odd_docs.count() and clean.where("n_hit > 0").count() == 0


def test_decontaminate_filters(odd_docs, odd_benchmark, spark, passage):
    verdicts = decontaminate.judge(odd_docs, odd_benchmark)
    kept = decontaminate.drop_contaminated(odd_docs, odd_benchmark)
    assert kept.columns == odd_docs.columns
    assert kept.count() == verdicts.where("not contaminated").count()
    text = f"Before, it.  {passage}! After, it."
    cut = decontaminate.cut_spans(frame(spark, [doc(1, text), doc(2, "clean, text"), doc(3, None)]), odd_benchmark)
    assert [r["text"] for r in cut.orderBy("doc_id").collect()] == ["Before, it.  After, it.", "clean, text", None]


def test_very_long_texts(spark, passage):
    """A text of 150,000 words: everything in it counts, to its last words."""
    text = words(9, 150_000, 40_000) + " " + passage + "\nAll rights reserved."
    df = frame(spark, [doc(1, text), doc(2, text + " x")])
    bench = spark.createDataFrame([(5, passage)], "item_id long, text string")
    got = decontaminate.judge(df, bench).where("doc_id = 1").first()
    assert (got["n_words"], got["n_hit"], got["n_items"], got["contaminated"]) == (150_043, 40, 1, False)
    stats = quality_rules.judge(df).where("doc_id = 1").first()
    ws = text.split()
    grams = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
    seen = Counter(grams)
    covered = {j for i, g in enumerate(grams) if seen[g] > 1 for j in (i, i + 1, i + 2)}
    assert (stats["n_words"], stats["n_repeat_words"]) == (len(ws), len(covered))
    assert licenses.scan(df).where("doc_id = 1").first()["licences"] == "proprietary"
    both = {r["component_id"] for r in ngram_jaccard.components(df).collect()}
    assert both == {1}


def test_quality_rules_odd_rows(odd_docs):
    got = quality_rules.judge(odd_docs)
    same(got, quality_rules.ORACLE_SQL, documents=odd_docs)
    assert not python_nodes(got)


def test_quality_rules_thresholds_follow_their_group(spark):
    """Symbols are normal in one source and junk in the other."""
    plain, rich = "a plain word ", "a # $ word "
    rows = [doc(i, words(i, 60), "en", "plain") for i in range(300)]
    rows += [doc(1000 + i, words(i, 60) + " #" * 60, "en", "rich") for i in range(300)]
    rows += [doc(5000, words(1, 60) + " #" * 60, "en", "plain"), doc(5001, words(2, 60) + " #" * 60, "en", "rich")]
    df = frame(spark, rows)
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(df).collect()}
    assert plain != rich and not kept[5000] and kept[5001] and all(kept[i] for i in range(300))
    same(quality_rules.judge(df), quality_rules.ORACLE_SQL, documents=df)
    stay = quality_rules.keep(df)
    assert stay.columns == df.columns and stay.count() == sum(kept.values())


def test_quality_rules_fences_differ_between_groups(spark):
    """On the given documents the fences of groups, and of their languages, are not one constant."""
    docs = common.read_table(spark, "/root/testdata/sf0.01", "documents").withColumn("source", F.substring("source", 1, 3))
    stats = quality_rules.full_stats(docs, "lang", "source").withColumnsRenamed({"_c0": "lang", "_c1": "source"})
    sketch = common.settled(quality_rules.sketches(stats))
    by_lang = quality_rules._limits(sketch, ["lang"]).collect()
    for feature in ("upper_pm", "dup_line_pm"):
        assert len({r["limit"] for r in by_lang if r["feature"] == feature}) > 1, feature
    good = docs.join(common.read_table(spark, "/root/testdata/sf0.01", "labels").where("quality = 1"), "doc_id", "left_semi")
    verdicts = quality_rules.judge(docs).join(good.select("doc_id"), "doc_id", "left_semi").where("not base_failed")
    assert verdicts.where("not kept").count() <= 0.005 * verdicts.count()


def test_quality_rules_empty(odd_docs):
    assert quality_rules.judge(odd_docs.limit(0)).count() == 0
    assert quality_rules.keep(odd_docs.limit(0)).count() == 0


NOTICE = ("# Licensed under the Apache License, Version 2.0 (the \"License\"); you may\nnot use this file except in compliance "
          "with the License.\nYou may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\n")


def test_licenses_odd_rows(spark, odd_docs):
    more = frame(spark, [doc(50, NOTICE), doc(51, "Some words.\nAll rights reserved.\nReleased under the MIT License."),
                         doc(52, "All rights reserved. " * 300)])
    df = odd_docs.unionByName(more)
    got = licenses.scan(df)
    same(got, licenses.ORACLE_SQL, documents=df)
    assert not python_nodes(got)
    found = {r["doc_id"]: r for r in got.where("n_known > 0").collect()}
    assert found[50]["sentence_ids"] == "apache-may-not,apache-obtain" and found[50]["licences"] == "Apache-2.0"
    assert found[51]["licences"] == "MIT,proprietary" and found[52]["n_known"] == 300


def test_licenses_first_rule_is_credited(spark):
    known, rules = {"a": "First one.", "b": "Second one."}, [("both", ["a", "b"]), ("a-only", ["a"]), ("b-only", ["b"])]
    df = frame(spark, [doc(1, "First one. Second one."), doc(2, "First one. Other. Second one."), doc(3, "Second one. First one.")])
    got = {r["doc_id"]: r["licences"] for r in licenses.scan(df, known, rules).collect()}
    assert got == {1: "both", 2: "a-only,b-only", 3: "a-only,b-only"}
    assert licenses.scan(df.limit(0)).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. N. Other

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY.
"""
APACHE = """Copyright 2020 A. N. Other

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""


def test_licenses_published_texts_however_wrapped_and_prefixed(spark):
    texts = {"MIT": (MIT, "mit-grant"), "Apache-2.0": (APACHE, "apache-may-not,apache-obtain,apache-as-is"),
             "GPL-3.0-or-later": (GPL, "gpl-free,gpl-hope"), "BSD-2-Clause": (BSD, "bsd-use,bsd-source,bsd-binary"),
             "BSD-3-Clause": (BSD3, "bsd-use,bsd-source,bsd-binary,bsd-names"), "MPL-2.0": (MPL, "mpl2-subject")}
    forms = [lambda t: t, lambda t: t.replace("\n", "\r\n"), lambda t: "code();\n" + t,
             lambda t: "/*\n" + "".join(f" * {x}\n" for x in t.split("\n")) + " */\n"] + [
             lambda t, p=p: "".join(f"{p}{x}\n" for x in t.split("\n")) for p in ("# ", "// ", "    ", ";; ")]
    cases = [(form(text), licence, ids) for licence, (text, ids) in texts.items() for form in forms]
    df = frame(spark, [doc(i, c[0]) for i, c in enumerate(cases)])
    got = {r["doc_id"]: (r["licences"], r["sentence_ids"]) for r in licenses.scan(df).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}
    same(licenses.scan(df), licenses.ORACLE_SQL, documents=df)


def test_licenses_each_known_sentence_at_every_width(spark):
    known = licenses.SENTENCES | licenses.PUBLISHED_SENTENCES
    cases = [(textwrap.fill(" ".join(s.split()), width, initial_indent=p, subsequent_indent=p, break_long_words=False), sid)
             for sid, s in known.items() for width in (30, 60, 72) for p in ("", " * ")]
    df = frame(spark, [doc(i, c[0]) for i, c in enumerate(cases)])
    got = {r["doc_id"]: r["sentence_ids"] for r in licenses.scan(df).collect()}
    assert got == {i: sid for i, (_, sid) in enumerate(cases)}
    same(licenses.scan(df), licenses.ORACLE_SQL, documents=df)


def test_licenses_shuffled_sentences_against_sql(spark):
    """Known sentences, list numbers and other words in random order and wrapping, with the SQL's answer."""
    rng = random.Random(9)
    known = list((licenses.SENTENCES | licenses.PUBLISHED_SENTENCES).values())
    between = ["", "", "\n", "\n\n", " 1. ", "\n(a) ", "\n * ", " some words ", "\nMore words\n", "K E \x01 ", ". ", "\r\n", "\t"]
    texts = []
    for _ in range(300):
        text = "".join(rng.choice(between) + rng.choice(known) for _ in range(rng.randint(1, 6)))
        texts.append("".join("\n" if c == " " and rng.random() < 0.05 else c for c in text))
    df = frame(spark, [doc(i, t) for i, t in enumerate(texts)])
    same(licenses.scan(df), licenses.ORACLE_SQL, documents=df)
    assert licenses.scan(df).where("licences <> ''").count() > 200


def test_licenses_words_between_or_ends_inside_are_no_match(spark):
    df = frame(spark, [doc(1, "All rights.\nReserved."), doc(2, "All rights are reserved."), doc(3, "Not all rights reserved."),
                       doc(4, "no end\nAll rights reserved\nSo be it"), doc(5, "All rights reserved\nby us")])
    assert {r["doc_id"]: r["n_known"] for r in licenses.scan(df).collect()} == {1: 0, 2: 0, 3: 0, 4: 1, 5: 0}
    same(licenses.scan(df), licenses.ORACLE_SQL, documents=df)


@pytest.fixture(scope="module")
def odd_pages(spark):
    urls = [None, "", "no scheme", "http://", "http://example.org", "HTTP://EXAMPLE.ORG/es/x", "http://a.b.example.org/en/12",
            "https://notexample.org/es/", "http://example.com/fr/?q=/de/", "http://x.com/de/#a", "http://com/fr/", "ftp://org/",
            "http://u@h.org:80/en/1", "http://a..org/x", "://example.org/es/", "http://example.org/a://com/fr/", "http://org./",
            "http://example.org/\nes/", "http://ÉX.ORG/es/"]
    return spark.createDataFrame([(i, u, "h", "x") for i, u in enumerate(urls + urls[:6])] + [(None, "http://a.org/", None, "x")],
                                 "page_id long, url string, html string, rule string")


def test_url_rules_odd_rows(odd_pages):
    same(url_rules.judge(odd_pages), url_rules.ORACLE_SQL, pages=odd_pages)
    assert url_rules.judge(odd_pages.limit(0)).count() == 0


def test_url_rules_against_brute_force(spark):
    import random
    rng = random.Random(5)
    label = lambda: rng.choice("abc")
    host = lambda n: ".".join(label() for _ in range(rng.randint(1, n)))
    path = lambda n: "/" + "".join(rng.choice("xy/") for _ in range(rng.randint(0, n)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(3), path(2)) for _ in range(60))}.values())
    pages = [(i, f"http://{host(5)}{path(4)}") for i in range(600)]

    def expected(url):
        h, _, p = url[7:].partition("/")
        fits = [(len(a + b), len(a), a + b, v) for a, b, v in rules if (h == a or h.endswith("." + a)) and ("/" + p).startswith(b)]
        return max(fits)[2:] if fits else (None, "allow")

    df = spark.createDataFrame(pages, "page_id long, url string")
    for block in (1000, 7, 20):
        got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge(df, rules, block_rules=block).collect()}
        wrong = [(u, got[i], expected(u)) for i, u in pages if got[i] != expected(u)]
        assert not wrong  # of equally long rules that of the longer host, in blocks of any size


def test_url_rules_given_twice_do_not_depend_on_blocks(spark):
    df = spark.createDataFrame([(1, "http://a.org/x/y")], "page_id long, url string")
    for rules in ([("a.org", "/x", "block"), ("a.org", "/x", "allow")], [("a.org", "/x", "allow"), ("a.org", "/x", "block")],
                  [("org", "/x/y", "allow"), ("a.org", "/x", "block")], [("a.org", "/x", "block"), ("org", "/x/y", "allow")]):
        for block in (10, 1):
            row = url_rules.judge(df, rules, block_rules=block).first()
            assert (row["rule"], row["verdict"]) == ("a.org/x", "block")


def test_jaccard_odd_rows(odd_docs):
    small = odd_docs.where("doc_id is null or doc_id not in (4, 5)")
    same(ngram_jaccard.components(small), ngram_jaccard.ORACLE_SQL, documents=small)
    by_id = {r["doc_id"]: r["component_id"] for r in ngram_jaccard.components(odd_docs).collect() if r["doc_id"]}
    assert by_id[4] == by_id[5] == 4 and by_id[11] == by_id[12] == 10
    assert ngram_jaccard.components(odd_docs.limit(0)).count() == 0


@pytest.mark.parametrize("rare", [1, 3, 32])
def test_jaccard_chains_groups_and_shared_passages(spark, rare, monkeypatch):
    """Near copies by a chain of edits, one group in which many tokens are frequent, and a common passage."""
    import random
    rng = random.Random(rare)
    monkeypatch.setattr(ngram_jaccard, "RARE_UP_TO", rare)
    texts, common_part = [], words(77, 20)
    base = words(78, 60).split()
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 2)):
            copy[rng.randrange(60)] = f"e{rng.randrange(999)}"
        texts.append(" ".join(copy))
    chain = words(79, 80).split()
    for step in range(15):
        chain[5 * step] = f"c{step}"
        texts.append(" ".join(chain))
    texts += [common_part + " " + words(100 + i, rng.randint(3, 60)) for i in range(40)]
    texts += texts[:5]
    rng.shuffle(texts)
    df = frame(spark, [doc(i, t) for i, t in enumerate(texts)])
    same(ngram_jaccard.components(df), ngram_jaccard.ORACLE_SQL, documents=df)


def test_jaccard_keep_one(spark):
    a, b = words(1, 50), words(2, 50)
    df = frame(spark, [doc(3, a), doc(2, a), doc(5, b), doc(5, b), doc(6, None), doc(7, ""), doc(None, a), doc(8, a + " z")])
    kept = ngram_jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "5", "6", "7"]


def test_jaccard_keep_one_of_null_ids(spark):
    """Copies without an id go with their group; of a group without any id one row stays; rows without words stay."""
    a, b, c = words(1, 50), words(2, 50), words(3, 50)
    df = frame(spark, [doc(3, a), doc(None, a), doc(None, a + " z"), *[doc(None, b)] * 3, doc(None, b + " z"), doc(None, c),
                       doc(None, ""), doc(None, None), doc(None, " \t")])
    kept = [(r["doc_id"], r["text"]) for r in ngram_jaccard.keep_one(df).collect()]
    assert sum(t in (b, b + " z") for _, t in kept) == 1
    assert sorted((str(i), str(t)) for i, t in kept if t not in (b, b + " z")) == sorted(
        [("3", a), ("None", c), ("None", ""), ("None", "None"), ("None", " \t")])
    assert ngram_jaccard.keep_one(df.limit(0)).count() == 0


def test_revisits_against_sql(spark):
    pages = common.read_table(spark, SF, "pages")
    odd = spark.createDataFrame([(None, "http://a.org/", "x"), (90001, None, "x"), (90002, "http://a.org/", None),
                                 (90003, "odd", ""), (90004, "http://A.org:80/?b=2&utm_x=1&a=1#f", "y")],
                                "page_id long, url string, html string")
    both = pages.unionByName(odd)
    got = warc_revisit.digest(warc_revisit.resolve(warc_revisit.captures_of(both)))
    same(got, warc_revisit.ORACLE_SQL, pages=both)
    # every page gives the revisit of itself, also without id or address
    assert got.where("record_id IS NULL").count() == 2 and got.where("record_id = 360005 AND outcome = 'no_response'").count() == 1
    clash = both.selectExpr("*", "1 AS slice", "2 AS near", "3 AS key", "4 AS ts", "5 AS _key", "6 AS headers")
    again = warc_revisit.digest(warc_revisit.resolve(warc_revisit.captures_of(clash)))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))


def test_revisits_of_one_hot_url_and_odd_captures(spark):
    """One URL over many slices: each revisit finds the latest response before it."""
    rows = [(i, "http://Hot.org/", i // 3, 200 if i % 50 == 0 else 304, {"ETag": f"{i // 400}", "X": "1", "DATE": str(i)})
            for i in range(3000)]
    rows += [(9001, None, 5, 304, None), (9002, "http://b.org", None, 304, {}), (9003, "http://b.org", 5, 200, None),
             (9004, "http://b.org/", 6, 304, None), (9005, "http://b.org", 5, 304, {"etag": "1"}), (9006, "http://b.org", 7, 500, {})]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, status int, headers map<string,string>")
    got = {r["record_id"]: r for r in warc_revisit.resolve(df).collect()}
    full = [r for r in rows[:3000] if r[3] == 200]
    for i, _, ts, status, headers in rows[:3000]:
        if status == 304:
            base = max((f for f in full if f[2] < ts), key=lambda f: (f[2], f[0]), default=None)
            same_tag = base is not None and base[4]["ETag"] == headers["ETag"]
            assert got[i]["outcome"] == ("no_response" if base is None else "resolved" if same_tag else "not_validated")
            assert got[i]["refers_to"] == (base[0] if same_tag else None)
            if same_tag:
                assert got[i]["headers"] == {"etag": headers["ETag"], "x": "1", "date": str(i)}
    assert [got[k]["outcome"] for k in (9001, 9002, 9004, 9005)] == ["no_response", "no_response", "not_validated", "no_response"]
    assert warc_revisit.resolve(df.limit(0)).count() == 0
