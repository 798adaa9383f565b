"""License scans by a positional index of rare words. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# What parts words: ASCII other than digits and letters.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Share of a template's weight that must stand in place.
COVER = 0.6


@dataclass(frozen=True)
class Template:
    """A phrase that names a licence; ``key``, a part of it, must stand whole. ``base`` phrases stand whole themselves."""

    label: str
    phrase: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.phrase.split()

    @property
    def key_at(self) -> int:
        words, key = self.words, self.key.split()
        return next(i for i in range(len(words)) if words[i:i + len(key)] == key)


BASE = [Template(label, phrase, phrase, True) for phrase, label in (
    ("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))]
MORE = [Template(*t) for t in (
    ("mit", "released under the mit license", "mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby granted"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license version 2 0", "mozilla public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa", "cc by sa"),
    ("cc-by-nc", "licensed under cc by nc", "cc by nc"),
    ("cc0", "cc0 1 0 universal", "cc0 1 0"),
    ("unlicense", "free and unencumbered software released into the public domain", "unencumbered software"),
    ("public-domain", "released into the public domain", "public domain"),
    ("proprietary", "confidential and proprietary information do not distribute", "confidential and proprietary"),
)]
# The words of whole notices as they are published, with a phrase that each must hold.
NOTICES = [Template(*t) for t in (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the rights to use "
     "copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the "
     "software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
     "shall be included in all copies or substantial portions of the software the software is provided as is without warranty of "
     "any kind express or implied including but not limited to the warranties of merchantability fitness for a particular "
     "purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other "
     "liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or "
     "the use or other dealings in the software", "associated documentation files the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and "
     "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and "
     "fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages "
     "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action "
     "arising out of or in connection with the use or performance of this software", "for any purpose with or without fee"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions "
     "and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of "
     "conditions and the following disclaimer in the documentation and or other materials provided with the distribution 3 neither "
     "the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
     "this software without specific prior written permission", "endorse or promote products derived from this software"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable "
     "law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or "
     "conditions of any kind either express or implied see the license for the specific language governing permissions and "
     "limitations under the license", "unless required by applicable law or agreed to in writing"),
    ("gpl-3.0-or-later", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option any later "
     "version this program is distributed in the hope that it will be useful but without any warranty without even the implied "
     "warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details you "
     "should have received a copy of the gnu general public license along with this program",
     "free software foundation either version 3"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable "
     "for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose "
     "including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
     "including commercial applications and to alter it"),
)]


def words_of(text: Column) -> Column:
    """Words of a text: runs of digits, letters and all beyond ASCII, lower-cased for A-Z."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS), "")


def word_weights(docs: DataFrame, templates: Sequence[Template], text_col: str = "text") -> dict[str, float]:
    """Inverse document frequency, over all documents, of each word of the templates."""
    lexicon = sorted({w for t in templates for w in t.words})
    found = docs.select(F.explode(F.array_distinct(F.filter(
        words_of(F.col(text_col)), lambda w: w.isin(lexicon)))).alias("word"))
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = docs.count()
    return {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1 for w in lexicon}


def scan(docs: DataFrame, templates: Sequence[Template] = (), cover: float = COVER, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words and places, an array of (template, label, base, start, score).

    ``templates`` are looked for beside the base ones. The index has the postings (template, position) of the two words of each
    template's key with the highest inverse document frequency. A document looks those of its words up, and the places
    at which a template would begin by the one and by the other are intersected; there its other words are compared by
    relative position. A place counts if the key stands whole and the
    words in place have ``cover`` of the template's weight; all of it for a base phrase. ``score`` is that share.

    ``start`` may be before the text for a template whose beginning is cut off. Null text counts as empty.
    Null and repeated ids are rows like others; an empty table gives no rows. Other columns are not read.
    """
    known = [*BASE, *templates]
    weights = word_weights(docs, known, text_col)
    postings: dict[str, list[tuple[int, int, int]]] = {}
    for number, t in enumerate(known):
        key = t.key.split()
        rare = sorted(range(len(key)), key=lambda i: (-weights[key[i]], i))[:2]
        for turn, i in enumerate(rare if len(rare) == 2 else rare * 2):
            postings.setdefault(key[i], []).append((number, t.key_at + i, turn))
    ints = lambda values: F.array(*[F.lit(v) for v in values])
    index = F.create_map(*[x for word, found in sorted(postings.items()) for x in (
        F.lit(word), F.array(*[F.struct(F.lit(n).alias("t"), F.lit(i).alias("at"), F.lit(k).alias("turn")) for n, i, k in found]))])
    # A place as one number: the template and the beginning, which may be before the text.
    before = max(len(t.words) for t in known)
    phrases = F.array(*[F.array(*map(F.lit, t.words)) for t in known])
    shares = F.array(*[F.array(*[F.lit(weights[w] / sum(weights[x] for x in t.words)) for w in t.words]) for t in known])
    labels, base = ints(t.label for t in known), ints(t.base for t in known)
    key_at, key_size = ints(t.key_at for t in known), ints(len(t.key.split()) for t in known)
    least = ints(1 - 1e-9 if t.base else cover - 1e-9 for t in known)

    def places(words: Column) -> Column:
        hits = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(sorted(postings)), i)))
        looked = F.flatten(F.transform(hits, lambda i: F.transform(F.element_at(index, F.get(words, i)), lambda p: F.struct(
            p["turn"].alias("turn"), (F.shiftleft(p["t"].cast("long"), 40) + i - p["at"] + before).alias("place")))))
        by = lambda turn: F.transform(F.filter(looked, lambda p: p["turn"] == turn), lambda p: p["place"])
        could = F.transform(F.array_intersect(by(0), by(1)), lambda c: F.struct(
            F.shiftright(c, 40).cast("int").alias("t"), (c.bitwiseAND(F.lit((1 << 40) - 1)) - before).cast("int").alias("start")))

        def compared(c: Column) -> Column:
            phrase, share = F.get(phrases, c["t"]), F.get(shares, c["t"])
            there = lambda k: F.coalesce(F.get(words, c["start"] + k) == F.get(phrase, k), F.lit(False))
            total = F.aggregate(F.transform(F.sequence(F.lit(0), F.size(phrase) - 1), lambda k: F.when(
                there(k), F.get(share, k)).otherwise(F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
            first = F.get(key_at, c["t"])
            whole = F.forall(F.sequence(first, first + F.get(key_size, c["t"]) - 1), there)
            return F.struct(c["t"].alias("template"), F.get(labels, c["t"]).alias("label"), F.get(base, c["t"]).alias("base"),
                            c["start"].cast("long").alias("start"), F.when(whole, total).alias("score"))

        return F.filter(F.transform(could, compared), lambda p: p["score"] >= F.get(least, p["template"]))

    found = lambda words: F.struct(F.size(words).cast("long").alias("n_words"), places(words).alias("places"))
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.element_at(F.transform(F.array(words_of(F.col(text_col))), found), 1).alias("found"))
    return rows.select("doc_id", "found.n_words", "found.places")


def summary(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of :func:`scan`'s rows."""
    base = F.filter("places", lambda p: p["base"])
    names = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    starts = F.transform(base, lambda p: p["start"])
    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), names(base).alias("base_labels"), names(F.col("places")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("places", lambda p: p["score"])), F.lit(0.0)), 6).alias("score"))
