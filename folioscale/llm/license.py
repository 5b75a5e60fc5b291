"""License scans by diagonal voting, in DataFrame functions only.

The rolling hashes of k consecutive words are joined to the positions of the
same k-grams in license templates. A match votes for its diagonal, the word
position less the template position. A diagonal with every k-gram of a phrase
is an exact place. Neighbouring diagonals (up to ``GAP`` words more or fewer
between) merge into one span, and a span stands if its votes hold at least
``COVERAGE`` of the template's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import ascii_lower

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
COVERAGE = 0.8
#: Diagonals that lie no further apart belong together: so many words may stand between two parts of a notice.
GAP = 3
#: Templates of so many words and more vote with three words, shorter ones with two.
LONG = 8

# The phrases of the contract and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Sentences of public licenses, found also with some words changed, left out or put in.
NOTICES = (
    ("licensed under the gnu general public license version 3", "gpl-3.0-notice"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "gpl-warranty"),
    ("you should have received a copy of the gnu general public license along with this program", "gpl-copy"),
    ("you should have received a copy of the gnu affero general public license along with this program", "agpl-copy"),
    ("you should have received a copy of the gnu lesser general public license along with this library", "lgpl-copy"),
    ("licensed under the apache license version 2 0", "apache-2.0-notice"),
    ("you may not use this file except in compliance with the license", "apache-compliance"),
    ("unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "apache-basis"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0-notice"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0-notice"),
    ("this work is licensed under a creative commons attribution sharealike 4 0 international license", "cc-by-sa-4.0-notice"),
    ("to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "cc0-notice"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit-grant"),
    ("the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit-condition"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc-grant"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd-grant"),
    ("redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd-condition"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0-notice"),
    ("this program and the accompanying materials are made available under the terms of the eclipse public license", "epl-notice"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)


def template_rows() -> list[tuple[str, str, bool, int, int, int, str]]:
    """(template, label, base, words, k, position, k-gram) of every k-gram of every template."""
    out = []
    for base, group in ((True, BASE), (False, NOTICES)):
        for phrase, label in group:
            w = phrase.split()
            k = 3 if len(w) >= LONG and not base else 2
            out += [(phrase, label, base, len(w), k, i, " ".join(w[i : i + k])) for i in range(len(w) - k + 1)]
    return out


def _templates(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame(template_rows(), "template string, label string, base boolean, words int, k int, at int, gram string")
    return df.withColumn("h", F.xxhash64("gram"))


def _votes(words: Column) -> Column:
    """(position, hash, k-gram) where the hash of k words is that of a template's k-gram; a first entry stands for the row itself."""
    rows = template_rows()
    wanted = {k: sorted({r[6] for r in rows if r[4] == k}) for k in (2, 3)}
    heads = sorted({r[6].split()[0] for r in rows})
    # words that begin no k-gram of a template are not hashed
    places = F.filter(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.get(words, i).isin(heads))
    gram = lambda i, k: F.array_join(F.slice(words, i + 1, F.lit(k)), " ")

    def found(k: int) -> Column:
        hashes = [F.xxhash64(F.lit(g)) for g in wanted[k]]
        grams = F.transform(F.filter(places, lambda i: i + k <= F.size(words)), lambda i: F.struct(i.alias("pos"), F.xxhash64(gram(i, k)).alias("h"), gram(i, k).alias("gram")))
        return F.filter(grams, lambda g: g["h"].isin(*hashes))

    own = F.array(F.struct(F.lit(-1).alias("pos"), F.lit(None).cast("long").alias("h"), F.lit(None).cast("string").alias("gram")))
    return F.when(F.size(words) >= 2, F.concat(own, found(2), found(3))).otherwise(own)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_notices: one row for each row of ``docs``.

    Null and empty texts have no words, no places, empty labels and score 0.
    Repeated rows are each returned. The score is the largest share of a
    template's words in one span, 0 if no span stands. Only the two named
    columns are read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    words = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    base = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("mark"), words.alias("words"))
    rows = base.select("doc_id", "mark", F.size("words").cast("long").alias("n_words"), F.inline(_votes(F.col("words"))))

    # some hundred rows, whatever the input: the templates above
    voted = rows.join(F.broadcast(_templates(spark).withColumnRenamed("gram", "own")), "h", "left").filter("pos = -1 or gram = own")
    key = ["doc_id", "mark", "n_words"]
    template = ["template", "label", "base", "words", "k"]
    # equal rows vote for the same places: count them apart, and each place once
    places = voted.groupBy(*key, *template, "pos", "at").agg(F.count("*").alias("copies"))
    diagonals = places.groupBy(*key, *template, (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.collect_set("at").alias("ats"), F.max("copies").alias("copies"))
    order = Window.partitionBy(*key, "template").orderBy("diagonal")
    near = diagonals.withColumn("fresh", F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > GAP) | F.col("base"), F.lit(True)).cast("int"))
    spans = near.withColumn("span", F.sum("fresh").over(order))
    spans = spans.groupBy(*key, *template, "span").agg(F.min("diagonal").alias("first"), F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"), F.max("copies").alias("copies"))
    exact = F.col("base") & (F.size("ats") == F.col("words") - F.col("k") + 1)
    held = F.size(F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(a, a + F.col("k") - 1)))))
    spans = spans.withColumn("exact", exact).withColumn("share", held / F.col("words"))
    stands = F.col("exact") | (~F.col("base") & (F.col("share") >= COVERAGE))
    first = F.col("first").cast("long")
    found = spans.groupBy(*key).agg(
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("rows"),
        F.count(F.when(F.col("exact"), 1)).alias("n_base"),
        F.min(F.when(F.col("exact"), first)).alias("first_word"),
        F.max(F.when(F.col("exact"), first)).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set(F.when(stands, F.col("label")))), ",").alias("labels"),
        F.coalesce(F.max(F.when(stands, F.col("share"))), F.lit(0.0)).alias("score"),
        F.count(F.when(stands & ~F.col("base"), 1)).alias("n_notices"),
    )
    each = found.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return each.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_notices")
