"""Licence scan with a positional index of rare template words. DataFrame operations only.

Base labels come from phrases whose words stand consecutively. For the method's labels, document frequencies of all
template words are counted over the corpus; each template is indexed under its own rarest words, so many of them that no
alignment with enough words in place can miss. A text looks up the rare words of the templates whose key phrase stands in
it, their postings give (template, offset) alignments, and one that enough rare words agree on is compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE_WORDS, MIN_HITS, MIN_MATCH = 6, 2, 0.7
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: (label, licence notice, key phrase that must stand in the text)
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the terms of the mit license", "mit license"),
    ("apache-2", "licensed under the apache license version 2 0", "apache license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4"),
    ("bsd-3", "redistribution and use in source and binary forms with or without modification are permitted provided that", "redistribution and use in source and binary forms"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced", "all rights reserved"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions "
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense",
    ),
    (
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "unless required by applicable law or agreed to in writing software distributed under the license",
    ),
    (
        "bsd-3",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "may be used to endorse or promote products derived from this software",
    ),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "for any purpose with or without fee is hereby granted"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "either version 3 of the license"),
    ("gpl-2", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version", "either version 2 of the license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    ("agpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software", "free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "including commercial applications and to alter it and redistribute it freely"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "has waived all copyright and related or neighboring rights"),
]


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased, in order; none for null."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _strings(words) -> str:
    return "array(" + ", ".join(f"'{w}'" for w in words) + ")" if words else "cast(array() as array<string>)"


def _phrase_places(phrases: dict[str, str]) -> str:
    """SQL: starts of each phrase as structs (label, at); a text without the phrase is not searched word by word."""
    each = []
    for phrase, label in phrases.items():
        n = len(phrase.split())
        each.append(f"CASE WHEN contains(joined, ' {phrase} ') THEN transform(filter(sequence(0, size(words) - {n}), i -> slice(words, i + 1, {n}) = {_strings(phrase.split())}), i -> named_struct('label', '{label}', 'at', cast(i as bigint))) ELSE cast(array() as array<struct<label:string,at:bigint>>) END")
    return f"concat({', '.join(each)})"


def document_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """How many texts have each template word, counted over all documents. A row for each such word at most."""
    vocabulary = sorted({w for _, text, _ in templates for w in text.split()})
    held = docs.select(F.explode(F.array_intersect(words_of(F.col("text")), F.expr(_strings(vocabulary)))).alias("w"))
    return {r.w: r["count"] for r in held.groupBy("w").count().collect()}


def rarest_places(template: str, rank: dict[str, int], rare_words: int, min_hits: int, min_match: float) -> list[tuple[str, int]]:
    """The template's rarest words with their places.

    At least rare_words, and so many that an alignment with a share of min_match holds min_hits of them, whichever words it lacks.
    """
    words = template.split()
    lacking = len(words) - next(k for k in range(len(words) + 1) if k / len(words) >= min_match)
    return sorted(((w, p) for p, w in enumerate(words)), key=lambda x: (rank[x[0]], x[1]))[: max(rare_words, lacking + min_hits)]


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, rare_words: int = RARE_WORDS, min_hits: int = MIN_HITS, min_match: float = MIN_MATCH) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every document.

    A null or empty text has no words, no labels, null places and score 0. Equal texts get equal rows, repeated rows each
    their own. score is 1 with a base label, else the best share of a template's words found in place; of equal ones any, the
    figure is the same. Very long texts are searched in whole, in time proportional to their words. An empty table gives no
    rows; other columns are not read.
    """
    seen, vocabulary = document_frequencies(docs, templates), sorted({w for _, text, _ in templates for w in text.split()})
    rank = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (seen.get(w, 0), w)))}  # highest IDF first
    rare = [rarest_places(text, rank, rare_words, min_hits, min_match) for _, text, _ in templates]
    postings: dict[str, list[tuple[int, int]]] = {}
    for t, places in enumerate(rare):
        for w, p in places:
            postings.setdefault(w, []).append((t, p))
    posting_map = "map(" + ", ".join(f"'{w}', array({', '.join(f'struct({t} as t, {p} as p)' for t, p in found)})" for w, found in postings.items()) + ")"
    template_words = "array(" + ", ".join(_strings(text.split()) for _, text, _ in templates) + ")"
    rare_of = "array(" + ", ".join(_strings(sorted({w for w, _ in places})) for places in rare) + ")"
    key_of, label_of = _strings([k for _, _, k in templates]), _strings([x for x, _, _ in templates])
    none = "cast(array() as array<struct<label:string,share:double>>)"
    base = docs.select(F.col("doc_id"), words_of(F.col("text")).alias("words"))
    base = base.withColumn("joined", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    keyed = f"filter(sequence(0, {len(templates) - 1}), t -> contains(joined, concat(' ', get({key_of}, t), ' ')))"
    base = base.select("doc_id", "words", F.expr(_phrase_places(phrases)).alias("places"), F.expr(keyed).alias("keyed"))
    base = base.withColumn("rare", F.expr(f"CASE WHEN size(keyed) > 0 THEN array_distinct(flatten(transform(keyed, t -> get({rare_of}, t)))) END"))
    # Alignments, sorted: every occurrence of a keyed template's rare word, at each of its places there. Equal ones stand together.
    base = base.withColumn("aligned", F.expr(f"CASE WHEN rare IS NOT NULL THEN array_sort(flatten(transform(filter(transform(words, (w, i) -> struct(w, i)), x -> array_contains(rare, x.w)), x -> transform(filter(element_at({posting_map}, x.w), q -> array_contains(keyed, q.t)), q -> struct(q.t AS t, x.i - q.p AS at))))) END"))
    base = base.withColumn("likely", F.expr(f"CASE WHEN aligned IS NOT NULL THEN filter(aligned, (a, i) -> coalesce(get(aligned, i + {min_hits - 1}) = a, false) AND (i = 0 OR get(aligned, i - 1) != a)) END"))
    share = f"size(filter(transform(get({template_words}, a.t), (w, i) -> coalesce(get(words, a.at + i) = w, false)), m -> m)) / size(get({template_words}, a.t))"
    base = base.withColumn("method", F.expr(f"CASE WHEN likely IS NOT NULL THEN filter(transform(likely, a -> named_struct('label', get({label_of}, a.t), 'share', cast({share} as double))), s -> s.share >= {min_match}) ELSE {none} END"))
    return base.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.size("places").cast("long").alias("n_base"),
        F.expr("array_min(transform(places, x -> x.at))").alias("first_word"),
        F.expr("array_max(transform(places, x -> x.at))").alias("last_word"),
        F.expr("array_join(array_sort(array_distinct(transform(places, x -> x.label))), ',')").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(transform(places, x -> x.label), transform(method, x -> x.label)))), ',')").alias("labels"),
        F.expr("CASE WHEN size(places) > 0 THEN 1D ELSE round(coalesce(array_max(transform(method, x -> x.share)), 0D), 6) END").alias("score"),
    )


def oracle_sql(phrases: dict[str, str] = PHRASES, templates=TEMPLATES, min_match: float = MIN_MATCH) -> str:
    """The same without an index: every template against every alignment that has one of its words in place."""
    phrase_rows = ", ".join(f"('{label}', '{phrase}', {len(phrase.split())})" for phrase, label in phrases.items())
    heads = ", ".join(f"({t}, '{label}', '{key}', {len(text.split())})" for t, (label, text, key) in enumerate(templates))
    words = ", ".join(f"({t}, {p}, '{w}')" for t, (_, text, _) in enumerate(templates) for p, w in enumerate(text.split()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents),
j AS (SELECT *, ' ' || array_to_string(words, ' ') || ' ' AS joined FROM d),
ph(label, phrase, n) AS (VALUES {phrase_rows}),
near AS (SELECT i, words, label, phrase, n FROM j JOIN ph ON contains(joined, ' ' || phrase || ' ')),
place AS (SELECT i, label, start FROM (SELECT i, words, label, phrase, n, unnest(range(0, len(words) - n + 1)) AS start FROM near) WHERE array_to_string(words[start + 1 : start + n], ' ') = phrase),
b AS (SELECT i, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word, list(DISTINCT label) AS labels FROM place GROUP BY i),
h(t, label, key, n) AS (VALUES {heads}),
tw(t, p, w) AS (VALUES {words}),
keyed AS (SELECT i, t, label, n FROM j JOIN h ON contains(joined, ' ' || key || ' ')),
wd AS (SELECT i, unnest(words) AS w, unnest(range(0, len(words))) AS pos FROM j WHERE i IN (SELECT i FROM keyed)),
hit AS (SELECT k.i, any_value(k.label) AS label, count(*) / any_value(k.n) AS share FROM wd JOIN tw USING (w) JOIN keyed k ON k.i = wd.i AND k.t = tw.t GROUP BY k.i, tw.t, wd.pos - tw.p HAVING count(*) / any_value(k.n) >= {min_match}),
m AS (SELECT i, list(DISTINCT label) AS labels, max(share) AS share FROM hit GROUP BY i)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word, array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ',') AS labels, CASE WHEN n_base > 0 THEN 1.0 ELSE round(coalesce(m.share, 0.0), 6) END::DOUBLE AS score
FROM d LEFT JOIN b USING (i) LEFT JOIN m USING (i)"""
