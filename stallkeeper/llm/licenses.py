"""Find license notices: exact phrases, and text blocks that contain most of a template's words.

An exact set-similarity join of word blocks with templates, in DataFrame functions only.  Blocks are at
least twice as long as the templates they meet, whatever their length.  Template words are ordered by the
number of documents that hold them, rarest first.  A block that contains enough of a template shares a word
of the template's short prefix, so documents without such a word make no blocks.  The remaining prefixes
meet in an equality join; length and position filters drop pairs that cannot reach the threshold; what is
left is counted exactly.  Templates that are nearly the same are told apart by the words that are not.  The
templates are a parameter and small; texts are read twice (word counts, blocks) and never shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallkeeper.llm.text import NOT_WORD, lower_ascii
from stallkeeper.session import Cut, table_cut

# Phrases that name a license, and its label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening words of well-known license notices, and their labels.
TEMPLATES = [
    ("mit", "released under the terms of the MIT license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the Apache License Version 2.0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "licensed under CC BY NC 4.0"),
    ("cc-by-sa", "licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("gpl-3", "licensed under the GNU General Public License version 3"),
    ("lgpl", "licensed under the GNU Lesser General Public License version 3"),
    ("mpl-2", "subject to the terms of the Mozilla Public License v 2.0"),
    ("public-domain", "free and unencumbered software released into the public domain"),
    (
        "mit",
        "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors "
        "or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or "
        "otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    ),
    (
        "bsd",
        "redistributions of source code must retain the above copyright notice this list of conditions and the following "
        "disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution",
    ),
    (
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www "
        "apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under "
        "the license is distributed on an as is basis without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license",
    ),
    (
        "gpl-3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    (
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general "
        "public license as published by the free software foundation either version 3 of the license or at your option any "
        "later version",
    ),
]

# Share of a template's words that a block must contain.
THRESHOLD = 0.8
# The shortest blocks are this many words long; longer templates meet blocks twice, four times ... as long.
# Blocks start at every half of their length.
BLOCK = 64


def word_list(text: Column) -> Column:
    """Words of a text; null and empty have none."""
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def _words(text: str) -> list[str]:
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans({c: c.lower() for c in text if "A" <= c <= "Z"}))) if w]


def _places(words: Column, phrase: list[str]) -> Column:
    """Word numbers (from 0) where a phrase stands; sought only in lists that hold all its words."""
    n = len(phrase)
    last = F.size(words) - n

    def stands(i: Column) -> Column:
        here = F.lit(True)
        for k, word in enumerate(phrase):
            here = here & (F.get(words, i + k) == word)
        return here

    held = last >= 0
    for word in sorted(set(phrase), key=len, reverse=True):
        held = held & F.array_contains(words, word)
    none = F.array().cast("array<int>")
    return F.when(held, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), stands)).otherwise(none)


def _literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words)).cast("array<string>")


@dataclass(frozen=True)
class Template:
    """A template's words and how many a block must hold.

    ``apart``: of each list the block must hold a word, as another label's notice has all the rest.
    ``yields_to``: templates of other labels that hold all its words; where one of them is found in a block,
    this one says nothing.
    """

    label: str
    words: tuple[str, ...]
    need: int
    block: int
    apart: tuple[tuple[str, ...], ...]
    yields_to: tuple[int, ...]


def judged_templates(templates: list[tuple[str, str]], threshold: float, block: int) -> list[Template]:
    """What to look for; templates without words are left out."""
    known = [(label, _words(text)) for label, text in templates]
    known = [(label, words, frozenset(words)) for label, words in known if words]
    out = []
    for label, words, held in known:
        need = max(1, -int(-len(held) * threshold // 1))
        length = block
        while length < 2 * len(words):
            length *= 2
        near = [(u, other) for u, (of, _, other) in enumerate(known) if of != label and len(held & other) >= need]
        apart = sorted({tuple(sorted(held - other)) for _, other in near if held - other})
        inside = tuple(u for u, other in near if held < other)
        out.append(Template(label, tuple(sorted(held)), need, length, tuple(apart), inside))
    return out


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] | None = None,
    templates: list[tuple[str, str]] | None = None,
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    cut: Cut | None = None,
) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row of ``docs``.

    ``base_labels`` are the sorted labels of phrases that stand in the text, ``n_base`` all their places,
    ``first_word`` and ``last_word`` the smallest and largest start (null without any).  ``labels`` adds
    those of templates of which some block of words contains at least ``threshold``.  ``score`` is 1 with
    a base label, else the largest such containment, else 0.  A template lies in one block wherever it
    stands: blocks have ``block`` words, doubled until they are twice as long as it.  Where another label's
    template would do as well, a block must hold a word that tells them apart, and of templates of which
    one holds all words of the other, the longer counts (see :class:`Template`).

    Null or empty text: no words, no labels, score 0.  Null ids are carried; repeated rows are judged
    each and alike; no rows give no rows; other columns of ``docs`` are not looked at.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    cut = cut or table_cut(docs.sparkSession)
    wanted = judged_templates(templates, threshold, block)

    text = docs[text_col]
    rows = docs.select(
        docs[id_col].alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"), word_list(text).alias("words")
    )

    # Documents that hold each template word; as many rows as the templates have words.
    used = sorted({w for t in wanted for w in t.words})
    held = rows.select(F.explode(F.array_intersect(_literal(used), F.col("words"))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    order = sorted(used, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}

    # A prefix of the rest plus one must be met.
    prefix_of = [sorted(t.words, key=rank.__getitem__)[: len(t.words) - t.need + 1] for t in wanted]
    least = {length: min(t.need for t in wanted if t.block == length) for length in sorted({t.block for t in wanted})}
    prefix_words = sorted({w for words in prefix_of for w in words}, key=rank.__getitem__)

    def blocks_of(length: int) -> Column:
        words = _literal(sorted({w for t in wanted if t.block == length for w in t.words}, key=rank.__getitem__))
        starts = F.sequence(F.lit(1), F.greatest(F.size("words"), F.lit(1)), F.lit(length // 2))
        blocks = F.transform(
            starts, lambda s: F.struct(F.lit(length).alias("length"), s.alias("start"), F.array_intersect(words, F.slice("words", s, length)).alias("held"))
        )
        return F.filter(blocks, lambda b: F.size(b["held"]) >= least[length])

    blocks = F.concat(*map(blocks_of, least)) if wanted else F.array()
    no_blocks_type = "array<struct<length:int,start:int,held:array<string>>>"
    no_blocks = F.array().cast(no_blocks_type)
    places = [(_places(F.col("words"), _words(p)), label) for p, label in phrases.items()]
    scanned = rows.select(
        "id",
        "version",
        F.size("words").cast("long").alias("n_words"),
        F.array(*[F.struct(F.lit(label).alias("label"), at.alias("at")) for at, label in places])
        .cast("array<struct<label:string,at:array<int>>>")
        .alias("found"),
        F.when(F.arrays_overlap("words", _literal(prefix_words)), blocks.cast(no_blocks_type)).otherwise(no_blocks).alias("blocks"),
    )
    scanned = cut(scanned, "license_blocks")

    spark = docs.sparkSession
    prefixes = spark.createDataFrame(
        [
            (word, t.block, k, t.label, sorted(t.words, key=rank.__getitem__), at, t.need, [list(x) for x in t.apart], list(t.yields_to))
            for k, t in enumerate(wanted)
            for at, word in enumerate(prefix_of[k])
        ],
        "word string, length int, template int, label string, words array<string>, at int, need int, "
        "apart array<array<string>>, yields_to array<int>",
    )
    # Block prefixes, rarest words first; a block matches no template beyond its own prefix.
    fewest = F.create_map(*[F.lit(x) for pair in least.items() for x in pair]) if least else F.create_map(F.lit(0), F.lit(0))
    parts = scanned.select("id", "version", F.explode("blocks").alias("b")).select("id", "version", "b.*")
    parts = parts.select("*", F.posexplode(F.slice("held", 1, F.size("held") - fewest[F.col("length")] + 1)).alias("place", "word"))
    rest = F.least(F.size("words") - F.col("at"), F.size("held") - F.col("place"))
    overlap = F.size(F.array_intersect("words", "held"))
    told = F.forall("apart", lambda words: F.arrays_overlap(words, F.col("held")))
    found = (
        parts.join(prefixes, ["word", "length"])
        .where(F.size("held") >= F.col("need"))
        .where(rest >= F.col("need"))
        .select("id", "version", "length", "start", "template", "label", "yields_to", "need", overlap.alias("overlap"), F.size("words").alias("size"), told.alias("told"))
        .where("overlap >= need and told")
    )
    # The templates of one block are few.
    of_block = found.groupBy("id", "version", "length", "start").agg(
        F.collect_set(F.struct("template", "label", "yields_to", (F.col("overlap") / F.col("size")).alias("share"))).alias("all")
    )
    counted = F.filter("all", lambda t: ~F.exists("all", lambda u: F.array_contains(t["yields_to"], u["template"])))
    matched = (
        of_block.select("id", "version", F.explode(counted).alias("t"))
        .groupBy("id", "version")
        .agg(F.collect_set("t.label").alias("more"), F.max("t.share").alias("best"))
        .select(F.col("id").alias("of"), F.col("version").alias("of_version"), "more", "best")
    )

    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("version") == F.col("of_version"))
    joined = scanned.join(matched, same, "left").select("id", "n_words", "found", "more", "best")
    at = F.flatten(F.transform("found", lambda f: f["at"]))
    base = F.transform(F.filter("found", lambda f: F.size(f["at"]) > 0), lambda f: f["label"])
    base = F.array_sort(F.array_distinct(base))
    return joined.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        base.alias("base_labels"),
        F.array_sort(F.array_union(base, F.coalesce("more", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size(base) > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
