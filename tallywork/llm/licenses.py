"""License scans by diagonal voting, in Spark expressions.

Every k-word window of every text meets the windows of the license templates in a join; a hit votes for
the diagonal ``place in text - place in template``. Votes are sets of template places per text, template and
diagonal; those of neighbouring diagonals (a word inserted or left out) are united, so a window that is said
again adds nothing and a span is no longer than its template and a few words. A span counts when enough of its
template's windows are found and its words, read beside the template, are not too far from it.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 3
SLACK = 3  # words by which merged diagonals may differ
COVERAGE = 0.6  # share of a template's windows that a span must hold

# Phrases that count wherever their words stand consecutively, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Longer texts of common licenses.
TEMPLATES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "you may not use this file except in compliance with the license you may obtain a copy of the license at": "apache-2",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "it under the terms of the gnu general public license as published by the free software foundation": "gpl",
    "under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted": "isc",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by",
    "licensed under a creative commons attribution noncommercial 4 0 international license": "cc-by-nc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text in lower case; NULL has none."""
    lower = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))


def _windows(spark) -> DataFrame:
    """(template, label, exact, need, place, gram, whole): every window of every template. Grows with the fixed
    list above only, some hundred short rows."""
    rows, number = [], 0
    for exact, group in ((True, PHRASES), (False, TEMPLATES)):
        for phrase, label in group.items():
            parts = phrase.split()
            n = len(parts) - K + 1
            need = n if exact else max(2, round(COVERAGE * n))
            rows += [
                f"({number}, '{label}', {exact}, {need}, {i}, split('{' '.join(parts[i : i + K])}', ' '), '{phrase}')" for i in range(n)
            ]
            number += 1
    made = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t(template, label, exact, need, place, gram, whole)")
    return made.withColumn("key", _hash(F.transform("gram", lambda x: F.xxhash64(x))))


def _hash(parts: Column) -> Column:
    return F.xxhash64(*(F.get(parts, F.lit(i)) for i in range(K)))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: words, places of the fixed phrases, and labels.

    A phrase counts at each place where all its windows lie on one diagonal; other templates need COVERAGE
    of their windows on diagonals that differ by SLACK words at most, and so much of their letters in the text of
    that span. ``score`` is the best covered share of any template found. NULL and empty texts have no words and
    no labels. Repeated rows and NULL ids are kept apart by a row number.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"), words(F.col(f"`{text_col}`")).alias("w")
    ).withColumn("h", F.concat(F.transform("w", lambda x: F.xxhash64(x)), F.array(F.lit(None).cast("bigint"))))
    # the last element of h is a mark that keeps one row of every text
    spots = base.select("doc_id", "row", "w", "h", F.posexplode_outer("h").alias("at", "one")).select(
        "doc_id", "row", "w", "at", F.col("one").isNull().alias("mark"), F.size("w").alias("n_words"),
        F.when(F.col("at") + K <= F.size("w"), F.xxhash64(*(F.get("h", F.col("at") + i) for i in range(K)))).alias("key"),
    )
    # the join is by hash; what it finds is compared word by word
    same = F.slice("w", F.col("at") + 1, K) == F.col("gram")
    diagonal = F.col("at") - F.col("place")
    # the words that the template would cover on this diagonal, and a few more
    beside = F.slice("w", F.greatest(diagonal, F.lit(0)) + 1, F.size(F.split("whole", " ")) + F.least(diagonal, F.lit(0)) + SLACK)
    hits = (
        spots.join(F.broadcast(_windows(spark)), "key", "left")
        .where(F.col("mark") | same)
        .groupBy("doc_id", "row", "template", "label", "exact", "need", "whole", diagonal.alias("diagonal"))
        .agg(
            F.max("n_words").alias("n_words"),
            F.bit_or(F.expr("shiftleft(1L, place)")).alias("places"),
            F.min("at").alias("first"),
            F.max(F.when(~F.col("exact"), F.array_join(beside, " "))).alias("text"),
        )
    )
    near = Window.partitionBy("doc_id", "row", "template").orderBy("diagonal").rangeBetween(0, SLACK)
    votes = F.bit_count(F.when(F.col("exact"), F.col("places")).otherwise(F.bit_or("places").over(near)))
    # letters to change, but for those that follow a template in a longer text
    size, more = F.char_length("whole"), F.greatest(F.char_length("text") - F.char_length("whole"), F.lit(0))
    alike = F.levenshtein(F.col("text"), F.col("whole")) - more <= (1 - COVERAGE) * size
    spans = hits.withColumn("votes", votes).withColumn(
        "found", F.coalesce((F.col("votes") >= F.col("need")) & (F.col("exact") | alike), F.lit(False))
    )
    phrase = F.col("found") & F.col("exact")
    label = F.when(F.col("found"), F.col("label"))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return (
        spans.groupBy("doc_id", "row")
        .agg(
            F.max("n_words").cast("bigint").alias("n_words"),
            F.count_if(phrase).alias("n_base"),
            F.min(F.when(phrase, F.col("first"))).cast("bigint").alias("first_word"),
            F.max(F.when(phrase, F.col("first"))).cast("bigint").alias("last_word"),
            joined(F.when(phrase, F.col("label"))).alias("base_labels"),
            joined(label).alias("labels"),
            F.coalesce(
                F.max(F.when(F.col("found"), F.least(F.lit(1.0), F.col("votes") * COVERAGE / F.col("need")))), F.lit(0.0)
            ).alias("part"),
        )
        .withColumn("score", F.when(F.col("n_base") > 0, 1.0).otherwise(F.least(F.lit(1.0), F.col("part"))))
        .select(F.col("doc_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    )
