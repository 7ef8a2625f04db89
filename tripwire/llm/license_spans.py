"""License scan by diagonal voting.

Every pair of neighbouring words of a text is joined, by its hash, to the places
where license templates hold it. A match of a template at word p of a text puts
all its votes on the diagonal p; a word too much or too few moves the votes to a
neighbour. Votes of neighbouring diagonals are merged in overlapping bands. A
band that holds most of a template's pairs is verified: its words are put in the
order in which the text has them and aligned with the template, and the share of
template words left after all edits is the span's cover. So words in another
order than the template's make no span, however many votes they get.

The templates are a fixed list in this module (short notices and whole license
texts of up to some hundred words), so their side of the join is broadcast; a
template may have any length of two words or more. Texts are never shuffled, only
hits. A band holds at most 2 * DRIFT votes for each place of its template.

Defined results: a null text counts as empty: no words, no labels, score 0;
repeated rows and null ids get the results of their own text; texts of any length
are scanned whole; overlapping places all count, and of spans of one template that
begin at the same word the best counts; an empty table gives no rows; other columns
are not looked at. Non-ASCII capitals are folded too, which can change no word made
of a-z and 0-9 but by the Kelvin sign, which becomes a k.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.llm.common import text_of

GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DRIFT = 3  # diagonals at most so far apart are merged
PAIRS = 0.6  # of a template's word pairs that a band must hold to be verified
COVER = 0.75  # of a template's words that must be left after the edits between it and a span


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False  # counts where its words stand consecutively, and only there


# The phrases to report, and the notices this scan adds.
TEMPLATES = (
    Template("cc-by", "cc by", True),
    Template("gpl", "general public license", True),
    Template("reserved", "all rights reserved", True),
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("gpl-3", "gnu general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0"),
    Template("apache-2.0", """
        you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache
        org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the
        license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the
        license for the specific language governing permissions and limitations under the license"""),
    Template("bsd", """
        redistributions of source code must retain the above copyright notice this list of conditions and the following
        disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the
        following disclaimer in the documentation and or other materials provided with the distribution"""),
    Template("gpl", """
        this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
        as published by the free software foundation either version 3 of the license or at your option any later version this
        program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of
        merchantability or fitness for a particular purpose see the gnu general public license for more details"""),
    Template("isc", """
        permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
        provided that the above copyright notice and this permission notice appear in all copies"""),
    Template("mit", """
        permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
        files the software to deal in the software without restriction including without limitation the rights to use copy modify
        merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
        furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the software"""),
    Template("unlicense", """
        this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile
        sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non
        commercial and by any means"""),
    Template("zlib", """
        this software is provided as is without any express or implied warranty in no event will the authors be held liable for
        any damages arising from the use of this software permission is granted to anyone to use this software for any purpose
        including commercial applications and to alter it and redistribute it freely subject to the following restrictions"""),
)


def template_pairs(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per place of a pair; ``pattern`` is the template with a letter for each of its different words."""
    rows = []
    for k, t in enumerate(templates):
        words = t.text.split()
        if len(words) < 2:
            raise ValueError(f"template {t.label} needs two words or more")
        letter = {w: chr(0x4E00 + i) for i, w in enumerate(dict.fromkeys(words))}
        pattern = "".join(letter[w] for w in words)
        rows += [(k, t.label, t.base, at, len(words) - 1, pattern, words[at], words[at + 1]) for at in range(len(words) - 1)]
    return spark.createDataFrame(
        rows, "template int, label string, base boolean, at int, pairs int, pattern string, first string, second string",
    ).withColumn("hash", F.xxhash64("first", "second"))


def _words(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select("doc_id", F.xxhash64(text).alias("version"),
                       F.array_remove(F.split(F.lower(text), GAPS), "").alias("words"))


def find_spans(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """``doc_id, version, template, label, base, start, end, cover``: one row per base place and per other span.

    ``version`` is a hash of the text; it tells rows with the same id apart.
    ``start`` is the first word that matches, ``end`` the word after the last.
    """
    pairs = template_pairs(docs.sparkSession, templates)
    hits = (
        _words(docs)
        .select("doc_id", "version", F.posexplode(F.arrays_zip(
            F.col("words").alias("one"), F.slice("words", 2, F.greatest(F.size("words") - 1, F.lit(0))).alias("two"))))
        .select("doc_id", "version", "pos", F.col("col.one").alias("one"), F.col("col.two").alias("two"),
                F.xxhash64("col.one", "col.two").alias("hash"))
        .join(F.broadcast(pairs.drop("pattern", "label", "pairs")), "hash")
        .filter((F.col("one") == F.col("first")) & (F.col("two") == F.col("second")))
    )
    # A base phrase stands on its own diagonal; other diagonals meet their neighbours in two bands.
    start = (F.col("pos") - F.col("at")).cast("long")
    band = F.floor(start / DRIFT)
    bands = F.when(F.col("base"), F.array(start)).otherwise(F.array(band, band + 1))
    whole = F.broadcast(pairs.filter("at = 0").select("template", "label", "base", "pairs", "pattern"))
    voted = (
        hits.select("doc_id", "version", "template", F.explode(bands).alias("band"), F.struct("pos", "at").alias("vote"))
        .groupBy("doc_id", "version", "template", "band").agg(F.collect_set("vote").alias("votes"))
        .join(whole, "template")
        .filter(F.size(F.array_distinct("votes.at")) >= F.col("pairs") * F.when(F.col("base"), 1.0).otherwise(PAIRS))
    )
    spans = _verified(voted).filter(F.col("cover") >= F.when(F.col("base"), 1.0).otherwise(COVER))
    return spans.groupBy("doc_id", "version", "template", "label", "base", "start").agg(
        F.max_by("end", "cover").alias("end"), F.max("cover").alias("cover"))


def _verified(voted: DataFrame) -> DataFrame:
    """``start, end, cover`` of the words that the votes of a band stand for.

    Between the first and the last of them, words without a vote are blanks,
    which are in no template; the edit distance to the template counts them all.
    """
    def letters(shift: int):
        return F.transform("votes", lambda v: F.struct(
            (v["pos"] + shift).alias("pos"), F.substring(F.col("pattern"), v["at"] + 1 + shift, F.lit(1)).alias("letter")))

    known = voted.withColumn("known", F.map_from_entries(F.array_distinct(F.concat(letters(0), letters(1)))))
    first, last = F.array_min("votes.pos"), F.array_max("votes.pos") + 1
    seen = F.array_join(F.transform(F.sequence(first, last), lambda p: F.coalesce(F.element_at("known", p), F.lit(" "))), "")
    edits = F.levenshtein(seen, F.col("pattern"))
    return known.withColumns({
        "start": first, "end": last + 1, "cover": F.greatest(1 - edits / F.length("pattern"), F.lit(0.0))})


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with counts, labels and score."""
    base = F.col("base")
    labels = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",")
    found = find_spans(docs, templates).groupBy("doc_id", "version").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        labels(F.when(base, F.col("label"))).alias("base_labels"), labels(F.col("label")).alias("labels"),
        F.max("cover").alias("score"),
    ).select(F.col("doc_id").alias("id"), F.col("version").alias("of"),
             "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = _words(docs).select("doc_id", "version", F.size("words").cast("long").alias("n_words"))
    return rows.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("version") == F.col("of")), "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        F.col("first_word").cast("long").alias("first_word"), F.col("last_word").cast("long").alias("last_word"),
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
