"""Operator 6: license scans as an exact set-similarity join (DataFrame functions only).

Two layers.  The base layer finds the places where the words of fixed phrases stand
consecutively.  The method's layer cuts every text into blocks (lines, long lines as
overlapping windows) and joins the blocks' token sets with the token sets of license
templates: a pair qualifies when the block holds at least ``threshold`` of the template's
distinct words (containment), and among them those that tell its license from others
(``TELLING``).  Tokens are ordered by their document frequency over all
documents, rarest first; a qualifying pair then shares a token among the first
``|T| - a + 1`` of the template (``a`` words are needed), the block needs ``a`` of the
template vocabulary (length filter), and the positions of a shared token bound the overlap
that is still possible (positional filter).  Survivors are verified exactly.

Notices may be wrapped.  Templates of ``LONG`` distinct words or more are therefore also joined with
overlapping windows of the whole text; shorter ones, whose few words soon meet by chance in such a
window, count across lines where all their words stand consecutively.

Words that occur in no template cannot add to an overlap, so blocks are reduced to the
template vocabulary.  The templates are literals of the plan: their size is bounded by the
caller.  Every text is cut into words once; what that gives is written, and the frequencies,
the places and the join start from it.  No text is shuffled; only (document, label) rows of
matching blocks are.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourglass.llm.common import checkpoint, utf8

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Base layer of the registered query: (label, phrase).
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
#: License notices of the method's layer: (label, text).
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a "
               "copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms "
            "of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are "
            "permitted provided that the following conditions are met"),
)
#: Words that tell a label's notices from others: a block must hold those that the template has.
TELLING = {"mit": ("mit",), "apache": ("apache",), "gpl": ("general", "public"), "cc-by-nc": ("nc",)}
#: Least containment of a template in a block, in percent.
THRESHOLD = 80
#: Distinct words from which on a template is looked for in windows that run across lines.
LONG = 10


_LOWER = {c: c + 32 for c in range(65, 91)}


def _template_words(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(WORD, text.translate(_LOWER))))


def _lower(text: Column) -> Column:
    """Lower case, cheaper than a translation of A-Z; no other character becomes an ASCII letter as a
    whole (the Kelvin sign would, and is replaced by a private one), so the same words match."""
    return F.lower(F.replace(text, F.lit("\u212a"), F.lit("\ue000")))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _places(phrase: str) -> Column:
    """Word positions (from 0) at which the phrase stands."""
    parts = phrase.split(" ")
    here = lambda i: reduce(
        lambda a, b: a & b, [F.get("_words", i + F.lit(k)) == F.lit(w) for k, w in enumerate(parts)])
    maybe = reduce(lambda a, b: a & b, [F.col("_low").contains(w) for w in parts])
    last = F.size("_words") - F.lit(len(parts))
    none = F.array().cast("array<int>")
    return F.when(maybe & (last >= 0), F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(none)


def _need(words: Sequence[str], threshold: int) -> int:
    return -(-threshold * len(words) // 100)


def _telling(label: str, words: Sequence[str]) -> list[str]:
    return [w for w in TELLING.get(label, ()) if w in words]


def analysed(docs: DataFrame, phrases: Sequence[tuple[str, str]], templates: Sequence[tuple[str, str]], threshold: int,
             key: str, text: str) -> DataFrame:
    """The one pass over the texts, written: ``(_key, _md5, n_words, _p0.., _s0.., _vocabulary, _low)``.

    Every text is cut into words here and nowhere else.  ``_vocabulary`` is the template words that it
    holds, ``_p``/``_s`` the places of phrases and short templates; ``_low`` is kept only where
    the words of the whole text could meet some template (else null).
    """
    sets = [(label, _template_words(t)) for label, t in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    short = [re.findall(WORD, t.translate(_LOWER)) for t, (_, ws) in zip([t for _, t in templates], sets, strict=True) if len(ws) < LONG]
    low = _lower(F.coalesce(F.col(text), F.lit("")))
    d = docs.select(F.col(key).alias("_key"), F.md5(utf8(F.col(text))).alias("_md5"), low.alias("_low"))
    d = d.withColumn("_words", words_of(F.col("_low")))
    d = d.select("_key", "_md5", "_low", F.size("_words").cast("long").alias("n_words"),
                 F.array_intersect(F.lit(vocabulary), F.col("_words")).alias("_vocabulary"),
                 *[_places(p).alias(f"_p{i}") for i, (_, p) in enumerate(phrases)],
                 *[_places(" ".join(ws)).alias(f"_s{i}") for i, ws in enumerate(short)])
    possible = reduce(lambda a, b: a | b, [
        (F.size(F.array_intersect("_vocabulary", F.lit(ws))) >= _need(ws, threshold))
        & (F.size(F.array_except(F.array(*map(F.lit, _telling(label, ws))).cast("array<string>"), F.col("_vocabulary"))) == 0)
        for label, ws in sets])
    return checkpoint(d.withColumn("_low", F.when(possible, F.col("_low"))))


def template_frequencies(words: DataFrame) -> dict[str, int]:
    """Documents that hold each word of the vocabulary, over all documents."""
    rows = words.select(F.explode("_vocabulary").alias("w")).groupBy("w").count().collect()  # one row per template word
    return {r["w"]: r["count"] for r in rows}


def match_templates(words: DataFrame, templates: Sequence[tuple[str, str]], threshold: int) -> DataFrame:
    """``(_key, _md5, _found, _best)``: labels of all templates met by a block and the greatest
    containment, for each document with such a block."""
    sets = [(label, _template_words(text)) for label, text in templates]
    vocabulary = sorted({w for _, ws in sets for w in ws})
    df = template_frequencies(words)
    order = sorted(vocabulary, key=lambda w: (df.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    longest = max(len(re.findall(WORD, text)) for _, text in templates)
    index, wide = [], set()
    for label, ws in sets:
        ws = sorted(ws, key=rank.__getitem__)
        need = _need(ws, threshold)
        index += [(w, label, i, len(ws), need, ws, _telling(label, ws)) for i, w in enumerate(ws[:len(ws) - need + 1])]
        wide |= set(ws[:len(ws) - need + 1]) if len(ws) >= LONG else set()
    prefix = sorted({x[0] for x in index})
    idx = words.sparkSession.createDataFrame(
        index, "_token string, _label string, _i int, _t int, _need int, _set array<string>, _telling array<string>")

    def cuts(ws: Column, make) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(ws) - F.lit(longest) - 1, F.lit(0)), F.lit(longest))
        return F.transform(starts, lambda s: make(F.slice(ws, s + 1, F.lit(2 * longest))))

    def holding(parts: Column, tokens: list[str], across: bool) -> Column:
        kept = F.filter(parts, lambda ws: F.arrays_overlap(ws, F.lit(tokens)))
        return F.transform(kept, lambda ws: F.struct(ws.alias("words"), F.lit(across).alias("across")))

    # only texts that may meet a template are cut again, into lines
    whole = words.where(F.col("_low").isNotNull()).select(
        "_key", "_md5", F.transform(F.split("_low", "\n", -1), words_of).alias("_lines")).withColumn("_words", F.flatten("_lines"))
    parts = holding(F.col("_lines"), prefix, False)
    if wide:  # a text of one line has no windows across lines
        held = (F.size("_lines") > 1) & F.arrays_overlap("_words", F.lit(sorted(wide)))
        across = F.when(held, cuts(F.col("_words"), lambda ws: ws)).otherwise(F.array().cast("array<array<string>>"))
        parts = F.concat(parts, holding(across, sorted(wide), True))
    lines = whole.select("_key", "_md5", F.explode(parts).alias("_line"))
    blocks = lines.select("_key", "_md5", F.col("_line.across").alias("_across"), F.explode(cuts(
        F.col("_line.words"), lambda ws: F.array_intersect(F.lit(order), ws))).alias("_block"))
    probes = blocks.select("_key", "_md5", "_across", "_block", F.posexplode("_block").alias("_j", "_token"))
    b, overlap = F.size("_block"), F.size(F.array_intersect("_block", "_set"))
    bound = F.least("_i", "_j") + 1 + F.least(F.col("_t") - F.col("_i") - 1, b - F.col("_j") - 1)
    hits = (probes.join(idx, "_token").where((~F.col("_across") | (F.col("_t") >= LONG)) & (b >= F.col("_need")) & (bound >= F.col("_need")))
                  .withColumn("_n", overlap).where(F.col("_n") >= F.col("_need"))
                  .where(F.size(F.array_except("_telling", "_block")) == 0))
    return hits.groupBy("_key", "_md5").agg(F.collect_set("_label").alias("_found"),
                                            F.max(F.col("_n") / F.col("_t")).alias("_best"))


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
                  templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: int = THRESHOLD,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    A null or empty text has no words, no places and empty labels; null keys and repeated rows
    each give their row (rows with equal key and text share one result); other columns are not
    read, so their names cannot clash.  Labels are distinct, sorted and comma-joined; ``score`` is 1
    with a base place or a short template word for word, else the greatest containment of a matching template, else 0.
    """
    words = analysed(docs, phrases, templates, threshold, key, text)
    short = [label for label, t in templates if len(_template_words(t)) < LONG]
    s = words
    places = F.concat(*[F.col(f"_p{i}") for i in range(len(phrases))])
    base = F.array_compact(F.array(*[F.when(F.size(f"_p{i}") > 0, F.lit(label))
                                     for i, (label, _) in enumerate(phrases)]))
    whole = F.array_compact(F.array(*[F.when(F.size(f"_s{i}") > 0, F.lit(label)) for i, label in enumerate(short)]
                                    ).cast("array<string>"))
    s = s.select("_key", "_md5", "n_words", places.alias("_at"), base.alias("_base"), whole.alias("_whole"))
    m = match_templates(words, templates, threshold).withColumnsRenamed({"_key": "_k", "_md5": "_m"})
    j = s.join(m, (F.col("_md5") == F.col("_m")) & F.col("_key").eqNullSafe(F.col("_k")), "left")
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    found = F.coalesce(F.col("_found"), F.array().cast("array<string>"))
    return j.select(
        F.col("_key").alias(key), "n_words", F.size("_at").cast("long").alias("n_base"),
        F.array_min("_at").cast("long").alias("first_word"), F.array_max("_at").cast("long").alias("last_word"),
        joined(F.col("_base")).alias("base_labels"), joined(F.concat("_base", "_whole", found)).alias("labels"),
        F.when((F.size("_at") > 0) | (F.size("_whole") > 0), F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _oracle() -> str:
    """The same rule in SQL: blocks are lines (cut into windows) and, for long templates in texts of several
    lines, windows of the whole text; short templates also count word for word across lines."""
    sets = [(label, _template_words(text)) for label, text in TEMPLATES]
    longest = max(len(re.findall(WORD, text)) for _, text in TEMPLATES)
    lit = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]::VARCHAR[]"
    values = ", ".join(f"('{label}', {lit(ws)}, {_need(ws, THRESHOLD)}, {lit(_telling(label, ws))})" for label, ws in sets)

    def places(label: str, words: Sequence[str]) -> str:
        return (f"SELECT rid, '{label}' AS label, i FROM w, unnest(range(len(ws))) AS u(i) WHERE "
                + " AND ".join(f"ws[i + {k + 1}] = '{x}'" for k, x in enumerate(words)))

    hits = " UNION ALL ".join(places(label, phrase.split(" ")) for label, phrase in PHRASES)
    whole = " UNION ALL ".join(places(label, re.findall(WORD, text.translate(_LOWER)))
                               for (label, text), (_, ws) in zip(TEMPLATES, sets, strict=True) if len(ws) < LONG)
    windows = f"unnest(range(0, greatest(len(ws) - {longest} - 1, 0) + 1, {longest})) AS u(s)"
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
w AS (SELECT rid, doc_id, regexp_extract_all(low, '{WORD}') AS ws, contains(low, chr(10)) AS wrapped FROM d),
lines AS (SELECT rid, regexp_extract_all(l, '{WORD}') AS ws
          FROM (SELECT rid, unnest(string_split(low, chr(10))) AS l FROM d)),
blocks AS (
  SELECT rid, false AS across, list_distinct(ws[s + 1 : s + {2 * longest}]) AS b FROM lines, {windows}
  UNION ALL
  SELECT rid, true, list_distinct(ws[s + 1 : s + {2 * longest}]) FROM w, {windows} WHERE wrapped),
t(label, tset, need, telling) AS (VALUES {values}),
m AS (SELECT rid, label, len(list_intersect(b, tset)) AS n, len(tset) AS t FROM blocks, t
      WHERE len(list_intersect(b, tset)) >= need AND len(list_intersect(b, telling)) = len(telling)
        AND (NOT across OR len(tset) >= {LONG})),
b AS ({hits}),
sh AS ({whole}),
bl AS (SELECT rid, count(*) AS n_base, min(i) AS f, max(i) AS l,
              string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY rid),
al AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
       FROM (SELECT rid, label FROM b UNION ALL SELECT rid, label FROM sh UNION ALL SELECT rid, label FROM m) GROUP BY rid),
best AS (SELECT rid, max(n / t) AS s FROM m GROUP BY rid)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
       bl.f::BIGINT AS first_word, bl.l::BIGINT AS last_word, coalesce(bl.labels, '') AS base_labels,
       coalesce(al.labels, '') AS labels,
       CASE WHEN bl.rid IS NOT NULL OR w.rid IN (SELECT rid FROM sh) THEN 1.0::DOUBLE ELSE coalesce(best.s, 0)::DOUBLE END AS score
FROM w LEFT JOIN bl ON bl.rid = w.rid LEFT JOIN al ON al.rid = w.rid LEFT JOIN best ON best.rid = w.rid
"""


ORACLE_OP6 = _oracle()
