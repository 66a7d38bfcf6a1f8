"""Licence scan: base phrases, and a positional index of rare licence words.

Every template is a licence notice, a part of one, or a short form (name, SPDX line). Word
rarity is measured over all documents; of each template the ``RARE`` words of highest IDF
(all but the commonest of a short one) are indexed with their positions. A document looks
up its words: only if enough indexed words of a template are among them, its
positions post votes for the place where the template would begin (word position minus
template position). Places up to ``SLACK`` words apart vote together, as copies of
notices miss or add a word here and there. A template with enough different words in line
is a candidate, and its label is given only if the template's mandatory phrases stand in the
text as well.

Only DataFrame functions are used: one pass over the texts counts the documents of each
licence word, a second one leaves base phrases, and positions and phrases of candidates.

Null and empty texts have no words, no labels and score 0; repeated rows give one
result each; empty tables give no rows; columns beside id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import documents_view, stage

# Phrases of the base rule and their labels.
PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"),
           ("cc by", "cc-by"), ("mit license", "mit"))

# Fixed values, public licence notices in normalised words: label, notice, mandatory phrases.
NOTICES = (
    ("gpl", "this work is licensed under the gnu general public license",
     ("gnu general public license",)),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation",
     ("gnu general public license", "free software foundation")),
    ("gpl", "this program is distributed in the hope that it will be useful but without any "
     "warranty without even the implied warranty of merchantability or fitness for a particular "
     "purpose see the gnu general public license for more details",
     ("gnu general public license for more details",)),
    ("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the "
     "free software foundation", ("gnu lesser general public license",)),
    ("agpl", "gnu affero general public license", ("gnu affero general public license",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the "
     "free software foundation", ("gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0",
     ("apache license version 2 0",)),
    ("apache-2.0", "you may not use this file except in compliance with the license you may "
     "obtain a copy of the license at http www apache org licenses license 2 0",
     ("www apache org licenses license 2 0",)),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software "
     "distributed under the license is distributed on an as is basis without warranties or "
     "conditions of any kind either express or implied",
     ("unless required by applicable law or agreed to in writing",
      "without warranties or conditions of any kind")),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
     "this software and associated documentation files",
     ("permission is hereby granted free of charge",)),
    ("mit", "the software is provided as is without warranty of any kind express or implied "
     "including but not limited to the warranties of merchantability fitness for a particular "
     "purpose and noninfringement",
     ("the software is provided as is", "particular purpose and noninfringement")),
    ("bsd", "redistribution and use in source and binary forms with or without modification "
     "are permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms",)),
    ("bsd", "redistributions of source code must retain the above copyright notice this list "
     "of conditions",
     ("redistributions of source code must retain the above copyright notice",)),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this "
     "list of conditions",
     ("redistributions in binary form must reproduce the above copyright notice",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose "
     "with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no "
     "event will the authors be held liable for any damages arising from the use of this software",
     ("without any express or implied warranty", "in no event will the authors be held liable")),
    ("bsl-1.0", "boost software license version 1 0", ("boost software license",)),
    ("epl", "eclipse public license", ("eclipse public license",)),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license v 2 0",)),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license version 2 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nd", "licensed under cc by nd 4 0", ("cc by nd",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc", "cc by nc", ("cc by nc",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc-by-nd", "cc by nd", ("cc by nd",)),
    ("cc-by-4.0", "cc by 4 0", ("cc by 4 0",)),
    ("cc-by-4.0", "creative commons attribution 4 0 international",
     ("creative commons attribution 4 0",)),
    ("cc-by-nc", "creative commons attribution noncommercial",
     ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "creative commons attribution sharealike",
     ("creative commons attribution sharealike",)),
    ("cc-by-nd", "creative commons attribution noderivatives",
     ("creative commons attribution noderivatives",)),
    ("cc0", "licensed under cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
)

# SPDX identifiers and the label of each; `-only` and `-or-later` may follow.
SPDX = (("MIT", "mit"), ("Apache-2.0", "apache-2.0"), ("GPL-2.0", "gpl"), ("GPL-3.0", "gpl"),
        ("LGPL-2.1", "lgpl"), ("LGPL-3.0", "lgpl"), ("AGPL-3.0", "agpl"), ("BSD-2-Clause", "bsd"),
        ("BSD-3-Clause", "bsd"), ("ISC", "isc"), ("Zlib", "zlib"), ("BSL-1.0", "bsl-1.0"),
        ("EPL-2.0", "epl"), ("MPL-2.0", "mpl-2.0"), ("Unlicense", "unlicense"), ("CC0-1.0", "cc0"),
        ("CC-BY-4.0", "cc-by-4.0"), ("CC-BY-SA-4.0", "cc-by-sa"), ("CC-BY-NC-4.0", "cc-by-nc"),
        ("CC-BY-ND-4.0", "cc-by-nd"))


def _spdx_line(identifier: str) -> str:
    return "spdx license identifier " + identifier.lower().replace("-", " ").replace(".", " ")


TEMPLATES = NOTICES + tuple((label, _spdx_line(i), (_spdx_line(i),)) for i, label in SPDX)
RARE = 6            # indexed words of a template, at most
LEAST_SHARE = 0.75  # of them in line, at least
SLACK = 8           # words by which places in line may differ

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
VOCABULARY = sorted({w for _, notice, _ in TEMPLATES for w in notice.split()})


def normalised(text: Column) -> Column:
    """Words in lower case, joined and enclosed by single spaces."""
    # the Kelvin sign is the one character beyond A-Z whose lower case is ASCII alone
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ")))
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(plain, GAPS, " ")), F.lit(" "))


def _spaces(s: Column) -> Column:
    return F.octet_length(s) - F.octet_length(F.replace(s, F.lit(" ")))


def _phrase_columns(norm: Column, n_words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(places, first, last): number of places, smallest and largest start."""
    inside = F.instr(norm, f" {phrase} ")
    count = F.when(inside > 0, F.regexp_count(norm, F.lit(f"(?<= ){phrase}(?= )"))).otherwise(0)
    first = F.when(inside > 0, _spaces(F.substring(norm, F.lit(1), inside)) - 1)
    back = F.reverse(norm)
    behind = F.instr(back, f" {phrase} "[::-1])
    after = _spaces(F.substring(back, F.lit(1), behind)) - 1
    last = F.when(inside > 0, n_words - after - len(phrase.split()))
    return count, first, last


def _words(view: DataFrame) -> DataFrame:
    norm = view.select("doc_id", normalised(F.col("text")).alias("norm"))
    return norm.withColumn("words", F.split(F.trim("norm"), " ", -1)).withColumn(
        "present", F.array_intersect("words", F.array(*[F.lit(w) for w in VOCABULARY])))


def word_documents(view: DataFrame) -> tuple[dict[str, int], int]:
    """(documents of each licence word, all documents); at most a row per licence word."""
    every = F.array_union(F.array(F.lit("")), "present")
    seen = {r["word"]: r["count"] for r in _words(view).select(F.explode(every).alias("word"))
            .where(F.col("word").isin([*VOCABULARY, ""])).groupBy("word").count().collect()}
    return seen, seen.get("", 0)


def rare_index(frequency: dict[str, int], n_docs: int) -> list[tuple[str, int, int, int]]:
    """(word, template, position, indexed words): the highest-IDF words of
    every template, all but one of a short one; ties by word."""
    def idf(w):
        return math.log((n_docs + 1) / (frequency.get(w, 0) + 1))
    out = []
    for t, (_, notice, _) in enumerate(TEMPLATES):
        words = notice.split()
        kinds = sorted(set(words), key=lambda w: (-idf(w), w))
        rare = kinds[:max(1, min(RARE, len(kinds) - 1))]
        out += [(w, t, i, len(rare)) for i, w in enumerate(words) if w in rare]
    return out


def _read(view: DataFrame, index: list[tuple[str, int, int, int]]) -> DataFrame:
    """Base columns of every text; positions and phrases where a template may stand."""
    counted = _words(view).withColumn(
        "n_words", F.when(F.octet_length("norm") <= 2, 0).otherwise(_spaces(F.col("norm")) - 1))
    cols = [_phrase_columns(F.col("norm"), F.col("n_words"), p) for p, _ in PHRASES]
    rare: dict[int, set[str]] = {}
    for word, t, _, _ in index:
        rare.setdefault(t, set()).add(word)
    near = F.lit(False)
    for words in rare.values():
        here = F.size(F.array_intersect("present", F.array(*[F.lit(w) for w in sorted(words)])))
        near = near | (here >= math.ceil(LEAST_SHARE * len(words)))
    mandatory = sorted({p for _, _, need in TEMPLATES for p in need})
    phrases = F.filter(F.array(*[F.lit(p) for p in mandatory]),
                       lambda p: F.col("norm").contains(F.concat(F.lit(" "), p, F.lit(" "))))
    indexed = sorted({word for word, _, _, _ in index})
    at = F.filter(F.transform(F.col("words"), lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
                  lambda x: x["word"].isin(indexed))
    return counted.withColumn("near", near).select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"),
        sum((c for c, _, _ in cols[1:]), cols[0][0]).cast("long").alias("n_base"),
        F.least(*[f for _, f, _ in cols]).cast("long").alias("first_word"),
        F.greatest(*[x for _, _, x in cols]).cast("long").alias("last_word"),
        F.array_compact(F.array(*[F.when(c > 0, F.lit(label))
                                  for (c, _, _), (_, label) in zip(cols, PHRASES)]))
        .alias("base_labels"),
        F.when(F.col("near"), phrases).alias("phrases"), F.when(F.col("near"), at).alias("places"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels`` (sorted arrays) and ``score``, the share of indexed words in
    line of the best label found by the index, or 0."""
    spark = docs.sparkSession
    view = documents_view(docs, id_col, text_col)
    entries = rare_index(*word_documents(view))
    index = spark.createDataFrame(entries, "word string, template int, position int, indexed int")
    read = stage(_read(view, entries).withColumn("row", F.monotonically_increasing_id()), "licences")
    start = F.col("at") - F.col("position")
    # two rows of bands, half a band apart: places within SLACK words share a band
    bands = F.array(F.struct(F.lit(0).alias("phase"), F.floor(start / (2 * SLACK)).alias("band")),
                    F.struct(F.lit(1).alias("phase"), F.floor((start + SLACK) / (2 * SLACK)).alias("band")))
    votes = (read.where("places IS NOT NULL")
             .select("row", F.explode("places").alias("x")).select("row", "x.word", "x.at")
             .join(F.broadcast(index), "word")  # as long as the templates
             .select("row", "template", "indexed", "word", F.explode(bands).alias("b")).distinct()
             .groupBy("row", "template", "b")
             .agg((F.count("*") / F.first("indexed")).alias("share"))
             .groupBy("row", "template").agg(F.max("share").alias("share"))
             .where(F.col("share") >= LEAST_SHARE))
    needs = spark.createDataFrame([(t, label, list(need)) for t, (label, _, need)
                                   in enumerate(TEMPLATES)],
                                  "template int, label string, needs array<string>")
    found = (votes.join(F.broadcast(needs), "template")
             .join(read.where("places IS NOT NULL").select("row", "phrases"), "row")
             .where(F.size(F.array_except("needs", "phrases")) == 0)
             .groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("score")))
    own = F.coalesce("own", F.array().cast("array<string>"))
    return read.join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.sort_array("base_labels").alias("base_labels"),
        F.sort_array(F.array_union("base_labels", own)).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
