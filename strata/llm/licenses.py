"""Licence scans by sentence rules.

A text is normalised to lower-case ASCII words. A known sentence is found wherever
its words follow each other from one cut to another, and runs of identifiers are
matched against ordered rules: a rule is a list of identifiers that must follow
each other, sentence by sentence. Rules that overlap are told apart by
their order: each known sentence is credited to the first rule that covers it, and
a rule's licence is reported where it is credited with a sentence.

Both tables are fixed and small, so both are broadcast; only sentences that are
known are shuffled. Rules are matched by the places their sentences imply (place
minus number in the rule), so a text of many licences costs no more than its
known sentences. DataFrame functions only; no Python runs on the executors.

Cuts are ends of sentences, and line breaks unless the next line goes on in lower
case. Inside a known sentence any line breaks, blank lines and comment prefixes
(``*``, ``#``, ``//``, all that is no word) may stand, but no end of a sentence that
it does not have itself, so texts are recognised however they are wrapped. Of the
sentences known at one place the longest counts. Nothing but the number of a list
item may stand between two sentences that follow each other.

``ORACLE_SQL`` states the same definition over the same two tables.

Defined results: null or empty text has no sentence and no licence. Repeated
documents give one row each. Extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import broadcast_if_small, settled, text_key

# Known licence sentences, as they are written in the licences, and their identifiers.
SENTENCES = {
    "mit-name": "Released under the MIT License.",
    "mit-name-2": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                 "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                 "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
                 "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
                 "subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be "
                 "included in all copies or substantial portions of the Software.",
    "apache-name": "Licensed under the Apache License, Version 2.0.",
    "apache-may-not": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                      "in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                    "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
                    "implied.",
    "gpl3-name": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-name": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-name": "Licensed under CC BY-SA 4.0.",
    "cc-by-name": "Licensed under CC BY 4.0.",
    "cc0-name": "This work is in the public domain.",
    "reserved": "All rights reserved.",
}
# Fixed values: (licence, sentences that follow each other), first rules first.
RULES = [
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("Apache-2.0", ["apache-may-not", "apache-obtain", "apache-as-is"]),
    ("Apache-2.0", ["apache-may-not", "apache-obtain"]),
    ("Apache-2.0", ["apache-may-not"]),
    ("Apache-2.0", ["apache-name"]),
    ("MIT", ["mit-grant"]),
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-name-2"]),
    ("GPL-3.0-only", ["gpl3-name"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    ("CC-BY-4.0", ["cc-by-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("proprietary", ["reserved"]),
]


# Sentences of further published licences and notices.
PUBLISHED_SENTENCES = {
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                 "or (at your option) any later version.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                   "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                   "License, or (at your option) any later version.",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                  "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                  "License, or (at your option) any later version.",
    "bsd-use": "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
               "that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                  "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
                 "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
# Their rules, after the others.
PUBLISHED_RULES = [
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("LGPL-2.1-or-later", ["lgpl21-free"]),
    ("LGPL-3.0-or-later", ["lgpl3-free"]),
    ("AGPL-3.0-or-later", ["agpl3-free"]),
    ("BSD-3-Clause", ["bsd-use", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-use", "bsd-source", "bsd-binary"]),
    ("ISC", ["isc-grant"]),
    ("MPL-2.0", ["mpl2-subject"]),
    ("Unlicense", ["unlicense"]),
]
# Marks the end of a sentence in a normalised text; the text's own become blanks.
_END = "\x01"


def _pattern(known: dict[str, str]) -> str:
    """A regular expression for the known sentences in a normalised text, longest first."""
    def one(sentence: str) -> str:
        words = re.split(r"([^A-Za-z0-9]+)", sentence)
        gaps = {i: rf"[ \n{_END}]++" if re.search(r"[.!?]\s", w) else r"[ \n]++" for i, w in enumerate(words) if i % 2}
        return "".join(gaps.get(i, w.lower()) for i, w in enumerate(words)).removesuffix(gaps.get(len(words) - 2, ""))

    longest = sorted({one(s) for s in known.values()}, key=lambda x: (-len(x), x))
    return rf"(?<![^{_END}\n]) *+({'|'.join(longest)})(?= *+(?:[{_END}\n]|\z))"


def pieces(text: Column, known: dict[str, str]) -> Column:
    """Known sentences, each behind a K, and what stands between them, in order."""
    clean = F.translate(F.coalesce(text, F.lit("")), _END, " ")
    unwrapped = F.regexp_replace(clean, r"([^.!?\n])\n([a-z(])", "$1 $2")
    ended = F.regexp_replace(unwrapped, r"([.!?])[ \t\n\r\f]+", f"$1{_END}")
    # pure ASCII from here, so lower() changes A-Z alone, and K and E are no part of it
    normal = F.lower(F.regexp_replace(ended, rf"[^A-Za-z0-9\n{_END}]+", " "))
    cut = F.split(F.regexp_replace(normal, _pattern(known), "K$1E"), "(?=K)|E")
    return F.filter(cut, lambda p: p.startswith("K") | ~p.rlike(rf"\A[ \n{_END}]*+(?:(?:[0-9]{{1,2}}|[a-z])[ \n{_END}]++)?\z"))


def _normalised(sentence: str) -> str:
    """The normal form of a known sentence, whole."""
    return " ".join("".join(c.lower() if c.isascii() and c.isalnum() else " " for c in sentence).split())


def scan(docs: DataFrame, known: dict[str, str] = SENTENCES | PUBLISHED_SENTENCES,
         rules: list[tuple[str, list[str]]] = RULES + PUBLISHED_RULES) -> DataFrame:
    """One row per document: doc_id, n_known, sentence_ids, licences (both comma-joined, in order and sorted)."""
    spark = docs.sparkSession
    table = F.broadcast(spark.createDataFrame([(_normalised(s), k) for k, s in known.items()], "sentence string, sid string"))
    parts = F.broadcast(spark.createDataFrame(
        [(n, licence, sid, j, len(sids)) for n, (licence, sids) in enumerate(rules) for j, sid in enumerate(sids)],
        "rule int, licence string, sid string, j int, m int"))
    cut = docs.select(F.col("doc_id").alias("id"), text_key(F.col("text")).alias("key"),
                      F.posexplode(pieces(F.col("text"), known)).alias("place", "raw")).where(F.col("raw").startswith("K"))
    found_words = F.trim(F.regexp_replace(F.substring("raw", 2, 1 << 30), rf"[ \n{_END}]+", " "))
    hits = settled(cut.withColumn("words", found_words).join(table, F.col("words") == F.col("sentence")).select("id", "key", "place", "sid").distinct())
    runs = (hits.join(parts, "sid").withColumn("start", F.col("place") - F.col("j"))
            .groupBy("id", "key", "rule", "licence", "m", "start").agg(F.count("*").alias("n")).where("n = m"))
    credit = (runs.select("id", "key", "rule", "licence", F.explode(F.expr("sequence(start, start + m - 1)")).alias("place"))
              .groupBy("id", "key", "place").agg(F.min_by("licence", "rule").alias("licence")))
    found = hits.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct("place", "sid"))).alias("s"))
    licences = credit.groupBy("id", "key").agg(F.array_join(F.array_sort(F.collect_set("licence")), ",").alias("licences"))
    on = lambda a, b: F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.key") == F.col(f"{b}.key"))
    each = settled(found.alias("f").join(licences.alias("l"), on("f", "l"), "left").select(
        F.col("f.id").alias("id"), F.col("f.key").alias("key"), F.size("s").cast("long").alias("n_known"),
        F.array_join(F.transform("s", lambda x: x["sid"]), ",").alias("sentence_ids"), "licences"))
    own = docs.select("doc_id", text_key(F.col("text")).alias("own_key"))
    return own.join(broadcast_if_small(each), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("own_key") == F.col("key")), "left").select(
        "doc_id", F.coalesce("n_known", F.lit(0).cast("long")).alias("n_known"),
        F.coalesce("sentence_ids", F.lit("")).alias("sentence_ids"), F.coalesce("licences", F.lit("")).alias("licences"))


def _values(rows: list[tuple]) -> str:
    quoted = lambda v: str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(quoted, r)) + ")" for r in rows)


def _oracle_pattern(known: dict[str, str]) -> str:
    """``_pattern`` without looking around: it takes in the cut before and behind, of which the text has two each."""
    cut = rf"[{_END}\n]"
    sentences = _pattern(known).split("(", 2)[2].rsplit(")(?=", 1)[0].replace("++", "+")
    return rf"(^|{cut}) *({sentences}) *({cut}|$)"


ORACLE_SQL = rf"""
WITH known(sentence, sid) AS (VALUES {_values([(_normalised(s), k) for k, s in (SENTENCES | PUBLISHED_SENTENCES).items()])}),
parts(rule, licence, sid, j, m) AS (VALUES {_values([(n, x, sid, j, len(sids)) for n, (x, sids) in enumerate(RULES + PUBLISHED_RULES)
                                                     for j, sid in enumerate(sids)])}),
normal AS (SELECT row_number() OVER () AS rid, doc_id, lower(regexp_replace(regexp_replace(
             regexp_replace(replace(coalesce(text, ''), chr(1), ' '), '([^.!?\n])\n([a-z(])', '\1 \2', 'g'),
             '([.!?])[ \t\n\r\f]+', '\1' || chr(1), 'g'), '[^A-Za-z0-9\n' || chr(1) || ']+', ' ', 'g')) AS s FROM documents),
marked AS (SELECT rid, doc_id, regexp_replace(regexp_replace(s, '([\n' || chr(1) || '])', '\1\1', 'g'),
             '{_oracle_pattern(SENTENCES | PUBLISHED_SENTENCES)}', '\1EK\2E\3', 'g') AS s FROM normal),
docs AS (SELECT rid, doc_id, list_filter(string_split(s, 'E'), lambda p: starts_with(p, 'K') OR NOT regexp_full_match(
           p, '[ \n' || chr(1) || ']*(([0-9]{{1,2}}|[a-z])[ \n' || chr(1) || ']+)?')) AS ss FROM marked),
hits AS (SELECT rid, place, sid FROM (SELECT rid, unnest(ss) AS s, generate_subscripts(ss, 1) AS place FROM docs)
         JOIN known ON starts_with(s, 'K') AND trim(regexp_replace(substr(s, 2), '[ \n' || chr(1) || ']+', ' ', 'g')) = sentence),
runs AS (SELECT rid, rule, licence, m, place - j AS start FROM hits JOIN parts USING (sid) GROUP BY ALL HAVING count(*) = m),
credit AS (SELECT rid, place, arg_min(licence, rule) AS licence
           FROM (SELECT rid, rule, licence, unnest(range(start, start + m)) AS place FROM runs) GROUP BY rid, place),
found AS (SELECT rid, count(*) AS n, string_agg(sid, ',' ORDER BY place) AS ids FROM hits GROUP BY rid),
named AS (SELECT rid, string_agg(licence, ',' ORDER BY licence) AS ls FROM (SELECT DISTINCT rid, licence FROM credit) GROUP BY rid)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_known, coalesce(ids, '') AS sentence_ids, coalesce(ls, '') AS licences
FROM docs LEFT JOIN found USING (rid) LEFT JOIN named USING (rid)
"""
