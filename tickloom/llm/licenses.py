"""License notices found by a positional index of their rarest words.

Words of licence texts are indexed with their positions.  (1) One pass over the corpus
keeps, of every whole text, the places of those words and counts in how many documents
each occurs.  (2) Of every template the words of highest inverse document frequency are
its keys: as many positions as a match can miss, and one more, so a text without any of
them cannot match and is left.  (3) The places of all licence words of the texts that are
left meet the template's postings; a word ``p`` of the text that stands at ``q`` in the
template votes for a copy that begins at ``p - q``.  Votes for one beginning are one bit
each, so words are counted by position, never by name alone.  (4) A template is found
where enough of its words stand in place, within ``SLACK`` inserted or lost words, and
each of its mandatory phrases stands there word by word.

Everything is DataFrame expressions.  Work follows the number of words; no group is
larger than one document.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import materialise

#: Between words: ASCII but digits and small letters, after A-Z were lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words that may be inserted or lost inside a copy of a template.
SLACK = 8
#: Share of a template's words that must stand in place.
SHARE = 0.8
#: Words of a template at most: one bit each.
WIDTH = 62


class Template(NamedTuple):
    """A notice: its label, its words, phrases that must stand as they are, the share that is needed."""

    label: str
    text: str
    phrases: tuple[str, ...] = ()
    share: float = SHARE
    base: bool = False

    @property
    def words(self) -> list[str]:
        return words_of(self.text)

    @property
    def need(self) -> int:
        return max(1, math.ceil(self.share * len(self.words) - 1e-9))

    def masks(self) -> list[int]:
        """One mask of word positions for each mandatory phrase, at its first place in the template."""
        own, out = self.words, []
        for phrase in map(words_of, self.phrases):
            at = next((i for i in range(len(own)) if own[i : i + len(phrase)] == phrase), None)
            if at is None or not phrase:
                raise ValueError(f"template {self.label!r} lacks its phrase {' '.join(phrase)!r}")
            out.append(((1 << len(phrase)) - 1) << at)
        return out


# Phrases of the contract, and sentences of public licence notices.
BASE = (
    Template("mit", "mit license", ("mit license",), 1.0, True),
    Template("apache", "apache license", ("apache license",), 1.0, True),
    Template("gpl", "general public license", ("general public license",), 1.0, True),
)
NOTICES = (
    Template("mit-notice", "Released under the MIT License", ("mit license",)),
    Template(
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        ("to deal in the software without restriction", "free of charge"),
    ),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license version 2 0",)),
    Template(
        "apache-2.0-text",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        ("except in compliance with the license",),
    ),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", ("general public license version 3",)),
    Template(
        "gpl-text",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version",
        ("general public license", "free software foundation"),
    ),
    Template("lgpl-text", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("lesser general public license",)),
    Template("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("in source and binary forms",)),
    Template(
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        ("for any purpose with or without fee",),
    ),
    Template(
        "mpl-2.0-text",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        ("mozilla public license",),
    ),
    Template("unlicense-text", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution",)),
)


def words_of(text: str) -> list[str]:
    """The words of a short text, as ``words`` finds them in a column."""
    return [w for w in re.split(BETWEEN, text.translate(str.maketrans(UPPER, LOWER))) if w]


def words(text: Column) -> Column:
    """Words of a whole text in order; null counts as empty."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN), "")


def postings(templates: tuple[Template, ...]) -> list[tuple[str, int, int]]:
    """(word, number of the template, position) of every word of every template."""
    for t in templates:
        if not 1 <= len(t.words) <= WIDTH:
            raise ValueError(f"template {t.label!r} must have 1 to {WIDTH} words")
    return [(w, k, q) for k, t in enumerate(templates) for q, w in enumerate(t.words)]


def keys(templates: tuple[Template, ...], documents: dict[str, int]) -> list[set[str]]:
    """The words of each template that a text must hold at least one of: the rarest positions, one more than a match can miss."""
    found = []
    for t in templates:
        rare = sorted(range(len(t.words)), key=lambda q, own=t.words: (documents.get(own[q], 0), own[q], q))
        found.append({t.words[q] for q in rare[: len(t.words) - t.need + 1]})
    return found


def read(docs: DataFrame, templates: tuple[Template, ...], text: str, keep: tuple[str, ...]) -> DataFrame:
    """Written once: __row, the columns of ``keep``, __n words, __hits (word, place) of licence words."""
    vocabulary = sorted({w for w, _, _ in postings(templates)})
    rows = docs.select(*[docs[c] for c in keep], words(docs[text]).alias("__words"))
    placed = F.transform("__words", lambda w, i: F.struct(w.alias("w"), i.cast("bigint").alias("p")))
    hits = F.filter(placed, lambda h: h["w"].isin(vocabulary))
    return materialise(rows.select(*keep, F.monotonically_increasing_id().alias("__row"), F.size("__words").cast("bigint").alias("__n"), hits.alias("__hits")))


def beginnings(texts: DataFrame, templates: tuple[Template, ...]) -> DataFrame:
    """(__row, t, start, mask): the words of template ``t`` that stand in place for a copy that begins at ``start``."""
    spark = texts.sparkSession
    counted = texts.select(F.explode(F.array_distinct(F.transform("__hits", lambda h: h["w"]))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    documents = {r["w"]: r["n"] for r in counted.collect()}  # one row for each word of the templates
    wanted = keys(templates, documents)
    found = F.array_intersect(F.transform("__hits", lambda h: h["w"]), F.array(*map(F.lit, sorted(set().union(*wanted)))))
    some = texts.select("__row", "__hits", found.alias("__keys")).where(F.size("__keys") > 0)
    possible = F.array(*[F.when(F.arrays_overlap("__keys", F.array(*map(F.lit, sorted(own)))), F.lit(k)) for k, own in enumerate(wanted)])
    listed = some.select("__row", F.array_compact(possible).alias("__possible"), F.inline("__hits"))
    index = F.broadcast(spark.createDataFrame(postings(templates), "w string, t int, q int"))  # as large as the templates
    votes = listed.join(index, "w").where(F.array_contains("__possible", F.col("t")))
    return votes.groupBy("__row", "t", (F.col("p") - F.col("q")).alias("start")).agg(F.bit_or(F.expr("shiftleft(1L, q)")).alias("mask"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = NOTICES, text: str = "text", keep: tuple[str, ...] = ("doc_id",), base: tuple[Template, ...] = BASE) -> DataFrame:
    """Notices of every document: ``keep``, n_words, n_base, first_word, last_word, base_labels, labels, score.

    ``base`` templates are phrases that count at each place where they stand in full:
    n_base places, first_word and last_word their smallest and largest start, from 0, null
    without any.  ``labels`` adds those of ``templates``; both are sorted and joined by
    commas, empty without any.  ``score`` is the largest share of words in place of any
    template that was found, 1 for a base phrase, 0 without any.

    Null texts are empty texts without words; repeated rows and null ids are rows of their
    own; an empty table gives no rows; texts of any length are read whole.  Only the columns
    of ``keep`` and ``text`` are read, whatever the others are called.
    """
    every = tuple(t._replace(base=True) for t in base) + tuple(t._replace(base=False) for t in templates)
    texts = read(docs, every, text, keep)
    masks = [t.masks() for t in every]
    at_most = max(1, max(map(len, masks)))
    facts = [(k, t.label, t.base, len(t.words), t.need, (1 << len(t.words)) - 1, [*m, *[0] * (at_most - len(m))]) for k, (t, m) in enumerate(zip(every, masks, strict=True))]
    about = F.broadcast(docs.sparkSession.createDataFrame(facts, "t int, label string, base boolean, n int, need int, whole long, phrases array<long>"))
    told = beginnings(texts, every).join(about, "t")
    places = told.where(F.col("base") & (F.col("mask") == F.col("whole"))).select("__row", "label", F.lit(True).alias("base"), F.lit(1.0).alias("share"), "start", F.lit(1).cast("bigint").alias("places"))

    near = F.floor(F.col("start") / SLACK)
    held = [(F.col("mask").bitwiseAND(F.col("phrases")[i]) == F.col("phrases")[i]).alias(f"held{i}") for i in range(at_most)]
    binned = told.where(~F.col("base")).select("__row", "t", "label", "n", "need", "mask", *held, F.explode(F.array(near - 1, near)).alias("bin"))
    joined = binned.groupBy("__row", "t", "label", "n", "need", "bin").agg(F.bit_count(F.bit_or("mask")).alias("stand"), *[F.bool_or(f"held{i}").alias(f"held{i}") for i in range(at_most)])
    enough = joined.where((F.col("stand") >= F.col("need")) & F.expr(" and ".join(f"held{i}" for i in range(at_most))))
    notices = enough.select("__row", "label", F.lit(False).alias("base"), (F.col("stand") / F.col("n")).alias("share"), F.lit(None).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("places"))

    joined_labels = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  as many as templates
    summary = places.unionByName(notices).groupBy("__row").agg(
        F.sum("places").alias("n_base"),
        F.min("start").alias("first_word"),
        F.max("start").alias("last_word"),
        joined_labels(F.when(F.col("base"), F.col("label"))).alias("base_labels"),
        joined_labels(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    out = texts.select(*keep, "__row", F.col("__n").alias("n_words")).join(summary, "__row", "left")
    return out.select(*keep, "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word", *[F.coalesce(c, F.lit("")).alias(c) for c in ("base_labels", "labels")], F.coalesce("score", F.lit(0.0)).alias("score"))


def scan_sql(templates: tuple[Template, ...] = NOTICES, base: tuple[Template, ...] = BASE) -> str:
    """The same for ``documents`` in DuckDB's SQL, by all places of all words."""
    every = tuple(t._replace(base=True) for t in base) + tuple(t._replace(base=False) for t in templates)
    masks = [t.masks() for t in every]
    at_most = max(1, max(map(len, masks)))
    index = ", ".join(f"('{w}', {k}, {q})" for w, k, q in postings(every))
    facts = ", ".join(f"({k}, '{t.label}', {str(t.base).lower()}, {len(t.words)}, {t.need}, {(1 << len(t.words)) - 1}, {', '.join(str(x) for x in [*m, *[0] * (at_most - len(m))])})" for k, (t, m) in enumerate(zip(every, masks, strict=True)))
    phrases = [f"k{i}" for i in range(at_most)]
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
placed AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS p FROM texts),
idx(word, t, q) AS (VALUES {index}),
about(t, label, base, n, need, whole, {', '.join(phrases)}) AS (VALUES {facts}),
begun AS (SELECT r, t, p - q AS start, bit_or(CAST(1 AS BIGINT) << q) AS mask FROM placed JOIN idx USING (word) GROUP BY 1, 2, 3),
told AS (SELECT * FROM begun JOIN about USING (t)),
binned AS (SELECT *, CAST(floor(start / {SLACK}.0) AS BIGINT) - s AS bin FROM told, (VALUES (0), (1)) AS two(s) WHERE NOT base),
joined AS (
  SELECT r, label, n, need, bit_count(bit_or(mask)) AS stand, {', '.join(f'bool_or((mask & {k}) = {k}) AS {k}' for k in phrases)}
  FROM binned GROUP BY r, t, label, n, need, bin),
found AS (
  SELECT r, label, true AS base, 1.0 AS share, start, 1 AS places FROM told WHERE base AND mask = whole
  UNION ALL SELECT r, label, false, stand / n, NULL, 0 FROM joined WHERE stand >= need AND {' AND '.join(phrases)}),
summary AS (
  SELECT r, sum(places) AS n_base, min(start) AS first_word, max(start) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM found GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM texts LEFT JOIN summary USING (r)
"""
