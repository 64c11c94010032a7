"""Licence detection by a positional index of rare words.

The templates' content words form an index (word -> template, position). Of
each file only the content words that the index knows are kept, with their
positions. A template matches where enough of its words agree on one relative
position (file position - template position) and its mandatory key phrase
stands at that place.

Only the words of highest IDF, counted over all files, look up postings: a
template of n words that must agree in k of them cannot match without one of
its n - k + 1 rarest postings, so those alone give every place in question and
none of a file's licences can crowd out another. The places at which the key
phrase stands are then intersected with all postings of their template.

Null and empty texts have no words and no labels; files are read whole; equal
files are judged alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.common import any_case_words, ascii_lower, positions, stored, words_at

# The base phrases and their labels.
BASE_PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    key: str  # mandatory phrase, part of the text

    @property
    def words(self) -> list[str]:
        return re.findall(r"[a-z0-9]+", self.text.lower())

    @property
    def key_words(self) -> list[str]:
        return re.findall(r"[a-z0-9]+", self.key.lower())

    @property
    def key_at(self) -> int:
        w, k = self.words, self.key_words
        return next(i for i in range(len(w)) if w[i:i + len(k)] == k)


# Opening passages, notices and whole texts of well-known licences.
TEMPLATES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", "Apache License Version 2.0"),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
             "You may obtain a copy of the License at", "you may not use this file except in compliance"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
             "redistribution and use in source and binary forms"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", "CC BY NC 4.0"),
    Template("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", "CC BY SA 4.0"),
    Template("gpl-3.0", "This work is licensed under the GNU General Public License, version 3", "GNU General Public License version 3"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
             "as published by the Free Software Foundation", "redistribute it and or modify it under the terms"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
             "distribute this software for any purpose"),
    Template("mit", "Released under the MIT License", "MIT License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
             "to deal in the Software without restriction", "permission is hereby granted free of charge"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License"),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
             "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, "
             "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
             "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial "
             "portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
             "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
             "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
             "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", "sublicense and or sell copies of the software"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
             "above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL "
             "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
             "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
             "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
             "SOFTWARE.", "the author disclaims all warranties with regard to this software"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are "
             "met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
             "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
             "documentation and/or other materials provided with the distribution.", "redistributions of source code must retain the above copyright notice"),
    Template("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
             "this software without specific prior written permission.", "used to endorse or promote products derived from this software"),
    Template("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages "
             "arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial "
             "applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
             "be misrepresented; you must not claim that you wrote the original software.", "the origin of this software must not be misrepresented"),
    Template("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
             "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
             "means.", "free and unencumbered software released into the public domain"),
    Template("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
             "documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to "
             "prepare derivative works of the Software", "to any person or organization obtaining a copy of the software"),
    Template("wtfpl", "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the "
             "name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE", "do what the fuck you want to public license"),
    Template("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
             "the Free Software Foundation; either version 2 of the License, or (at your option) any later version.", "either version 2 of the License"),
    Template("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
             "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", "either version 3 of the License"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published "
             "by the Free Software Foundation", "GNU Lesser General Public License"),
    Template("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published "
             "by the Free Software Foundation", "GNU Affero General Public License"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
             "file, You can obtain one at", "if a copy of the MPL was not distributed with this file"),
    Template("epl-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "Eclipse Public License 2.0"),
    Template("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
             "waived all copyright and related or neighboring rights"),
)
# Words of the templates that any text has.
FUNCTION_WORDS = frozenset("a and any are as at by can for in is it may not of or that the this to under use with without you".split())
FULL_WORDS = 12  # agreeing words that count as a whole template, however long it is
AGREE = 0.6  # share of a template's content words (FULL_WORDS at most) that must agree on one place
SLACK = 2  # words by which the key phrase may stand off that place


def postings(templates: tuple[Template, ...] = TEMPLATES) -> list[tuple[str, int, int]]:
    """(word, template number, position) of the content words."""
    return [(w, t, i) for t, x in enumerate(templates) for i, w in enumerate(x.words) if w not in FUNCTION_WORDS]


def starts_of(phrase: list[str]) -> Column:
    """Starts (words from 0) where ``phrase`` stands in the column ``w``;
    looked for only if the text has its longest word at all."""
    def here(i: Column) -> Column:
        return reduce(and_, [ascii_lower(x) == F.lit(p) for x, p in zip(words_at(F.col("w"), i, len(phrase)), phrase)])
    none = F.array().cast("array<int>")
    return F.when(F.contains(F.col("low"), F.lit(max(phrase, key=len))), F.filter(positions(F.size("w") - len(phrase) + 1), here)).otherwise(none)


def signals(docs: DataFrame, templates: tuple[Template, ...], id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts, stored: word count, places of the base
    phrases and key phrases, and the known content words with positions."""
    vocab = sorted({w for w, _, _ in postings(templates)})
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), any_case_words(text).alias("w"), F.lower(text).alias("low"))
    known = F.array_compact(F.transform("w", lambda x, i: F.when(F.lower(x).isin(vocab), F.struct(i.alias("pos"), F.lower(x).alias("word")))))
    keys = sorted({" ".join(t.key_words) for t in templates})
    d = d.select("doc_id", F.size("w").cast("long").alias("n_words"), F.expr("uuid()").alias("row"),
                 F.struct(*[starts_of(p.split()).alias(label) for p, label in BASE_PHRASES.items()]).alias("base"),
                 known.alias("known"), F.struct(*[starts_of(k.split()).alias(f"k{i}") for i, k in enumerate(keys)]).alias("keys"))
    return stored(d, "licence-signals")


def content(templates: tuple[Template, ...]) -> dict[int, list[tuple[str, int]]]:
    """Content words and positions of each template."""
    out: dict[int, list[tuple[str, int]]] = {t: [] for t in range(len(templates))}
    for w, t, i in postings(templates):
        out[t].append((w, i))
    return out


def needed(n_words: int) -> int:
    """Words of a template's ``n_words`` that must agree on one place."""
    return max(2, math.ceil(AGREE * min(n_words, FULL_WORDS)))


def probes(templates: tuple[Template, ...], files: dict[str, int]) -> list[tuple[str, int, int]]:
    """The rarest postings of each template (``files``: files that hold a
    word): as many as leave fewer than ``needed`` words without a look-up."""
    out = []
    for t, words in content(templates).items():
        rarest = sorted(words, key=lambda x: (files.get(x[0], 0), x))
        out += [(w, t, i) for w, i in rarest[:max(len(words) - needed(len(words)) + 1, 0)]]
    return out


def file_counts(sig: DataFrame) -> dict[str, int]:
    """Files per index word over all files: a row per word of the templates."""
    words = sig.select(F.explode(F.array_distinct(F.transform("known", lambda k: k["word"]))).alias("word"))
    return {r["word"]: r["count"] for r in words.groupBy("word").count().collect()}


def alignments(sig: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(row, template, label, offset, agreed, share) that pass the key phrase.

    Every step is an equality join on places, so a long file that holds a
    phrase many times costs in proportion to its matches."""
    spark = sig.sparkSession
    keys = sorted({" ".join(t.key_words) for t in templates})
    of = content(templates)
    facts = {t: (len(of[t]), needed(len(of[t])), x.key_at, keys.index(" ".join(x.key_words)), x.label) for t, x in enumerate(templates)}
    # both tables: the templates' words, whatever the files
    rare = F.broadcast(spark.createDataFrame([(w, t, i, facts[t][2], facts[t][3]) for w, t, i in probes(templates, file_counts(sig))],
                                             "word string, template int, tpos int, key_at int, key int"))
    index = F.broadcast(spark.createDataFrame([(w, t, i, facts[t][0], facts[t][1], facts[t][4]) for w, t, i in postings(templates)],
                                              "word string, template int, tpos int, words int, needed int, label string"))
    places = F.array(*[F.col("keys")[f"k{i}"] for i in range(len(keys))])
    some = sig.where(F.exists(places, lambda p: F.size(p) > 0) & (F.size("known") > 0))  # no other file can match
    hits = some.select("row", F.explode("known").alias("s")).select("row", "s.*")
    near = F.explode(F.array(*[F.lit(i) for i in range(-SLACK, SLACK + 1)]))
    phrases = (some.select("row", F.posexplode(places).alias("key", "starts")).select("row", "key", F.explode("starts").alias("start"))
               .select("row", "key", "start", near.alias("by")).select("row", "key", (F.col("start") + F.col("by")).alias("key_place")))
    offset = F.col("pos") - F.col("tpos")
    found = (hits.join(rare, "word").select("row", "template", offset.alias("offset"), "key", (offset + F.col("key_at")).alias("key_place")).distinct()
             .join(phrases, ["row", "key", "key_place"], "left_semi"))
    wanted = found.join(index, "template").select("row", "template", "offset", "words", "needed", "label", "word", (F.col("offset") + F.col("tpos")).alias("pos"))
    votes = (wanted.join(hits, ["row", "pos", "word"]).groupBy("row", "template", "label", "offset", "words", "needed")
             .agg(F.count("*").alias("agreed")).where(F.col("agreed") >= F.col("needed")))
    return votes.select("row", "template", "label", "offset", "agreed",
                        F.least(F.lit(1.0), F.col("agreed") / F.least(F.col("words"), F.lit(FULL_WORDS))).alias("share"))


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: counts, first and last base place, labels
    and the best share of a template found in place (a base phrase alone
    scores 0.5)."""
    sig = signals(docs, templates, id_col, text_col)
    own = alignments(sig, templates).groupBy("row").agg(F.collect_set("label").alias("own"), F.max("share").alias("best"))
    labels = list(BASE_PHRASES.values())
    starts = F.concat(*[F.col("base")[x] for x in labels])
    found = F.filter(F.array(*[F.when(F.size(F.col("base")[x]) > 0, F.lit(x)) for x in labels]), lambda x: x.isNotNull())
    d = sig.select("doc_id", "n_words", "row", starts.alias("starts"), F.array_sort(found).alias("base_labels")).join(own, "row", "left")
    return d.select(
        "doc_id", "n_words", F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").cast("long").alias("first_word"), F.array_max("starts").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base_labels", F.coalesce("own", F.array().cast("array<string>")))), ",").alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.size("starts") > 0, 0.5).otherwise(0.0)).alias("score"))


__all__ = ["BASE_PHRASES", "TEMPLATES", "Template", "alignments", "scan"]
