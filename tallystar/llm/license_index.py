"""License scan by a positional rare-token index, in DataFrame functions only (operator 2).

Each notice (template) is indexed by its words with the highest inverse document frequency
over all documents: word -> notice, position. One pass normalises every text, counts the base phrases
and notes which words of any notice the text has. From those notes come the document frequencies.
A text that has all words of some notice's key phrase keeps its words; it looks its own notice words up
in the index, and notices of which it holds enough weight get their postings intersected by relative
position: words that stand at the same distance as in the notice vote for (notice, offset). A notice is
found where the votes reach `least` of its weight and its key phrase stands at its place.

Beside it, the base phrases are counted wherever their words stand consecutively.

Words are runs of letters and digits, lower-case in A-Z. Null, empty and wordless texts have no
words, places or labels, and score 0. Repeated rows and null ids are scanned like any other; very long
texts are scanned whole; columns beside id and text are left out, whatever their names; an
empty table gives no rows. Of notices found equally well all count.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, texts

# Phrases and labels of the base scan.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


class Notice(NamedTuple):
    """A licence notice: its label, its words, and the phrase that must stand in it."""

    label: str
    text: str
    key: str


# Public licence notices, opening words and whole texts.
NOTICES = [
    Notice("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    Notice("gpl-3.0", "licensed under the gnu general public license version 3", "general public license version 3"),
    Notice("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    Notice("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", "gnu lesser general public license"),
    Notice("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation", "gnu affero general public license"),
    Notice("mit", "released under the mit license", "the mit license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee is hereby granted"),
    Notice("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    Notice("epl-2.0", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse public license 2 0"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered software released into the public domain"),
    Notice("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    Notice("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    Notice("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    Notice(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
        "copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions the above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the software the software is provided as is without warranty "
        "of any kind express or implied including but not limited to the warranties of merchantability "
        "fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
        "holders be liable for any claim damages or other liability whether in an action of contract tort or "
        "otherwise arising from out of or in connection with the software or the use or other dealings in the "
        "software",
        "shall be included in all copies or substantial portions of the software",
    ),
    Notice(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is "
        "hereby granted provided that the above copyright notice and this permission notice appear in all "
        "copies the software is provided as is and the author disclaims all warranties with regard to this "
        "software including all implied warranties of merchantability and fitness in no event shall the author "
        "be liable for any special direct indirect or consequential damages or any damages whatsoever "
        "resulting from loss of use data or profits whether in an action of contract negligence or other "
        "tortious action arising out of or in connection with the use or performance of this software",
        "the author disclaims all warranties with regard to this software",
    ),
    Notice(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors "
        "be held liable for any damages arising from the use of this software permission is granted to anyone "
        "to use this software for any purpose including commercial applications and to alter it and "
        "redistribute it freely subject to the following restrictions the origin of this software must not be "
        "misrepresented you must not claim that you wrote the original software",
        "to alter it and redistribute it freely",
    ),
    Notice(
        "unlicense",
        "anyone is free to copy modify publish use compile sell or distribute this software either in source "
        "code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "use compile sell or distribute this software",
    ),
]
#: Least number of indexed words of a notice; a longer notice has one for every EVERY words.
RARE, EVERY = 6, 10


def normal(text: Column) -> Column:
    """The words of a text, each between single blanks."""
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    plain = F.regexp_replace(plain, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.concat(F.lit(" "), F.trim(plain), F.lit(" "))


def _blanks(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def base_scan(rows: DataFrame) -> DataFrame:
    """Adds n_words, n_base, first_word, last_word and base_labels to rows with `words_text`."""
    # The blank before each place becomes a mark; blanks and marks before it number its word.
    place = " (?=(?:" + "|".join(PHRASES) + ") )"
    parts = F.split(F.regexp_replace("words_text", place, "\x01"), "\x01", -1)
    rows = rows.withColumn("n_words", F.greatest(_blanks(F.col("words_text")) - 1, F.lit(0).cast("long")))
    rows = rows.withColumn("n_words", F.when(F.trim("words_text") == "", 0).otherwise(F.col("n_words")))
    rows = rows.withColumn("parts", parts)
    found = F.size("parts") > 1
    labels = [
        F.when(F.contains("words_text", F.lit(f" {phrase} ")), F.lit(label))
        for phrase, label in PHRASES.items()
    ]
    return rows.withColumns(
        {
            "n_base": (F.size("parts") - 1).cast("long"),
            "first_word": F.when(found, _blanks(F.element_at("parts", 1))),
            "last_word": F.when(found, F.col("n_words") - _blanks(F.element_at("parts", -1))),
            "base_list": F.when(found, F.array_compact(F.array(*labels))).otherwise(
                F.array().cast("array<string>")
            ),
        }
    ).drop("parts")


def document_frequencies(rows: DataFrame) -> tuple[int, dict[str, int]]:
    """Number of rows, and of rows that list each word in `own`; as many rows as notices have words."""
    counted = rows.select(F.explode(F.concat("own", F.array(F.lit("")))).alias("word"))
    found = dict(counted.groupBy("word").count().collect())
    return found.pop("", 0), found


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def noted(docs: DataFrame, split: list[list[str]], keys: list[list[str]], id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: base columns, the words of any notice that a row has (`own`), and the
    words of texts that have all words of some key phrase (else null); each row with its number.

    Words of notices and keys are two literal arrays, so the plan does not grow with the notices.
    """
    rows = texts(docs, id_col, text_col).select("doc_id", normal(F.col("text")).alias("words_text"))
    known = _literal(sorted({w for s in split for w in s}))
    distinct = sorted({tuple(sorted(set(k))) for k in keys})
    wanted = F.array(*[_literal(list(k)) for k in distinct])
    own = F.array_intersect(known, F.split("words_text", " "))
    maybe = F.exists(wanted, lambda k: F.size(F.array_except(k, F.col("own"))) == 0)
    return (
        base_scan(rows)
        .withColumn("own", own)
        .withColumn("words_text", F.when(maybe, F.col("words_text")))
        .withColumn("row", F.monotonically_increasing_id())
    )


def postings_of(
    split: list[list[str]], weight: dict[str, float], rare: int, every: int
) -> list[tuple[str, int, int, float]]:
    """The index: (word, notice, position, share of the notice's indexed weight)."""
    index = []
    for notice, own in enumerate(split):
        n = max(rare, len(own) // every)
        top = sorted(set(own), key=lambda w: (-weight[w], w))[:n]
        whole = sum(weight[w] for w in top)
        index += [(w, notice, p, weight[w] / whole) for p, w in enumerate(own) if w in top]
    return index


def scan(
    docs: DataFrame,
    notices: list[Notice] = NOTICES,
    rare: int = RARE,
    least: float = 0.7,
    id_col: str = "doc_id",
    text_col: str = "text",
    every: int = EVERY,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    places: found notices as (label, word where the notice begins, score).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    split, keys = [n.text.split() for n in notices], [n.key.split() for n in notices]
    seen = scratch.saved(noted(docs, split, keys, id_col, text_col), "seen")
    total, have = document_frequencies(seen)
    # Natural logarithms of inverse document frequencies; sizes are those of the notices.
    weight = inverse_frequencies(total, have, {w for s in split for w in s})
    # As many rows as the notices have indexed words, whatever the documents.
    index = postings_of(split, weight, rare, every)
    postings = spark.createDataFrame(index, "word string, notice int, at int, share double")
    once = sorted({(w, notice, share) for w, notice, _, share in index})
    shares = spark.createDataFrame(once, "word string, notice int, share double")
    files = seen.where("words_text is not null")
    # A file that lacks the weight of a notice cannot reach `least` at any offset.
    looked_up = (
        files.select("row", F.explode("own").alias("word"))
        .join(F.broadcast(shares), "word")
        .groupBy("row", "notice")
        .agg(F.sum("share").alias("held"))
        .where(F.col("held") >= least - 1e-9)
    )
    # A word that a notice has more than once votes once for an offset.
    votes = (
        files.select("row", F.posexplode(F.split(F.trim("words_text"), " ")).alias("pos", "word"))
        .join(F.broadcast(postings), "word")
        .select("row", "notice", "word", "share", (F.col("pos") - F.col("at")).alias("offset"))
        .join(looked_up, ["row", "notice"], "left_semi")
        .groupBy("row", "notice", "offset", "word")
        .agg(F.max("share").alias("share"))
        .groupBy("row", "notice", "offset")
        .agg(F.sum("share").alias("score"))
        .where(F.col("score") >= least - 1e-9)
    )
    places = spark.createDataFrame(
        [(i, n.label, k, _inside(s, k)) for i, (n, s, k) in enumerate(zip(notices, split, keys))],
        "notice int, label string, key array<string>, key_at int",
    )
    from_word = F.col("offset") + F.col("key_at")
    words = files.select("row", F.split(F.trim("words_text"), " ").alias("words"))
    # Rounded, so that the order in which shares were added up does not show.
    score = F.round(F.least("score", F.lit(1.0)), 9).alias("score")
    place = F.struct("label", F.col("offset").alias("word"), score)
    verified = (
        votes.join(F.broadcast(places), "notice")
        .join(words, "row")
        .where(from_word >= 0)
        .where(F.slice("words", from_word.cast("int") + 1, F.size("key")) == F.col("key"))
        .groupBy("row")
        .agg(F.array_sort(F.collect_set(place)).alias("places"))
    )
    joined = seen.drop("own", "words_text").join(scratch.saved(verified, "verified"), "row", "left")
    none = F.array().cast("array<struct<label:string,word:int,score:double>>")
    joined = joined.withColumn("places", F.coalesce("places", none))
    labels = F.array_union("base_list", F.transform("places", lambda p: p.label))
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.concat_ws(",", F.array_sort(F.array_distinct("base_list"))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_distinct(labels))).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p.score)), F.lit(0.0)).alias("score"),
        "places",
    )


def inverse_frequencies(total: int, have: dict[str, int], words: set[str]) -> dict[str, float]:
    """Above 0 for words of every row, too, so that a notice in all rows keeps its weight."""
    return {w: math.log(1 + (total + 1) / (have.get(w, 0) + 1)) for w in words}


def _inside(words: list[str], key: list[str]) -> int:
    for i in range(len(words)):
        if words[i : i + len(key)] == key:
            return i
    raise ValueError(f"{' '.join(key)} is not a part of its notice")
