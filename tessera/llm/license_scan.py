"""Licence scan by diagonal voting, in DataFrame functions only.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased.
Every rolling word k-gram of every document is hashed and joined to the
positions of the same k-gram in the templates. A match votes for the diagonal
document position minus template position; neighbouring diagonals of a
template (a word inserted or left out) merge into one span. The span is verified
along the text: a k-gram counts if it stands later in the template than all that
counted before it, and a place counts once, so words out of order don't add up. A
template's label counts where at least ``LEAST_SHARE`` of its k-grams are verified so.

Templates are phrases, short notices, and whole texts (``license_texts``: six licences
of up to 260 words and two standard notices; longer licences are found by their
notices). A span's ``whole`` tells whether its template is such a text.

Phrases are templates of one k-gram, so each verified match is a place of the
phrase. K-grams have three words, or two for a template of two words: the join
is on the first two and checks the third where the template has one.

NULL and empty texts have no words, no places and score 0. Repeated rows are
scanned one by one. The template table is fixed (under 2,000 rows), so it is
broadcast. One pass reads the texts: a closing row per document, which joins to
a row of the template table of its own, carries the word count along, and only
matches and closing rows are shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.license_texts import WHOLE

SPLIT = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_SHARE = 0.7
NEIGHBOURS = 3  # diagonals this near merge


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False
    whole: bool = False


#: Phrases to report every place of, and licence notices; fixed texts.
TEMPLATES = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
    Template("mit", "released under the mit license"),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
    ),
    Template("apache", "licensed under the apache license version 2 0"),
    Template(
        "apache",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at "
        "http www apache org licenses license 2 0",
    ),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public license as published by "
        "the free software foundation",
    ),
    Template(
        "lgpl",
        "under the terms of the gnu lesser general public license as published by the free software foundation",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "all rights reserved no part of this publication may be reproduced"),
    *(Template(label, text, whole=True) for label, text in WHOLE),
)
CLOSING = -1  # the template number of closing rows


def template_grams(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """One row per k-gram position of a template, and the row that closing rows join to."""
    rows = []
    for i, t in enumerate(templates):
        words = [w for w in re.split(SPLIT, t.text.translate(str.maketrans(UPPER, LOWER))) if w]
        k = min(3, len(words))
        for p in range(len(words) - k + 1):
            third = words[p + 2] if k == 3 else None
            rows.append((i, t.label, t.base, t.whole, p, len(words) - k + 1, words[p], words[p + 1], third))
    rows.append((CLOSING, "", False, False, 0, 1, None, None, None))
    table = spark.createDataFrame(
        rows, "template int, label string, base boolean, whole boolean, tpos int, grams int, a string, b string, c string"
    )
    return table.withColumn("key", gram_key("a", "b"))


def gram_key(a: str, b: str) -> Column:
    """Hash of the first two words; a closing row (no first word) has a key that no word pair has."""
    closing = F.xxhash64(F.lit("closing"), F.lit(0), F.lit(0))
    return F.when(F.col(a).isNull(), closing).otherwise(F.xxhash64(F.lower(a), F.lower(b)))


def matches(docs: DataFrame, key: str, text: str, templates: tuple[Template, ...]) -> DataFrame:
    """Verified k-gram matches (row, id, template, label, base, whole, tpos, grams, pos) and closing rows.

    ``lower`` serves the hash only (it also folds letters beyond A-Z); the
    words are compared after folding A-Z alone.
    """
    words = F.filter(F.split(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), SPLIT), lambda w: w != "")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{key}`").alias("id"), words.alias("w"))
    most = F.greatest(F.size("w"), F.lit(1))
    grams = F.arrays_zip(
        F.concat("w", F.array(F.lit(None).cast("string"))).alias("x"),  # the closing row is the one after the last word
        F.slice("w", F.lit(2), most).alias("y"),
        F.slice("w", F.lit(3), most).alias("z"),
    )
    rows = rows.select("row", "id", F.posexplode(grams).alias("pos", "g"))
    rows = rows.select("row", "id", "pos", F.col("g.x").alias("x"), F.col("g.y").alias("y"), F.col("g.z").alias("z"))
    rows = rows.withColumn("key", gram_key("x", "y"))
    table = F.broadcast(template_grams(docs.sparkSession, templates))
    third = F.col("c").isNull() | (F.col("c") == F.lower("z"))
    hit = rows.join(table.withColumnRenamed("key", "tkey"), (F.col("key") == F.col("tkey")) & third)
    fold = lambda w: F.translate(w, UPPER, LOWER)
    same = (fold("x") == F.col("a")) & (fold("y") == F.col("b")) & (F.col("c").isNull() | (fold("z") == F.col("c")))
    hit = hit.where((F.col("template") == CLOSING) | same)
    return hit.select("row", "id", "template", "label", "base", "whole", "tpos", "grams", "pos")


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    templates: tuple[Template, ...] = TEMPLATES,
    least_share: float = LEAST_SHARE,
) -> DataFrame:
    """Per row: ``id``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``,
    ``score`` (largest verified share of a template) and ``spans`` (first and last word, label, share, whole)."""
    hits = matches(docs, key, text, templates).repartition("row")
    votes = hits.groupBy("row", "id", "template", "label", "base", "whole", "grams", (F.col("pos") - F.col("tpos")).alias("diagonal"))
    votes = votes.agg(
        F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_set(F.struct("pos", "tpos")).alias("places")
    )
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    near = F.col("diagonal") - F.lag("diagonal").over(along)
    starts = F.when(F.col("base") | (F.col("grams") == 1) | near.isNull() | (near > NEIGHBOURS), 1).otherwise(0)
    votes = votes.withColumn("cluster", F.sum(starts).over(along))
    spans = votes.groupBy("row", "id", "template", "label", "base", "whole", "grams", "cluster").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sort_array(F.flatten(F.collect_list("places"))).alias("places"),
    )
    none = F.struct(F.lit(-1).alias("pos"), F.lit(-1).alias("at"), F.lit(0).alias("n"))
    step = lambda s, p: F.struct(p["pos"].alias("pos"), p["tpos"].alias("at"), (s["n"] + 1).alias("n"))
    further = lambda s, p: F.when((p["pos"] > s["pos"]) & (p["tpos"] > s["at"]), step(s, p)).otherwise(s)
    spans = spans.withColumn("voted", F.aggregate("places", none, further)["n"]).drop("places")
    share = F.col("voted") / F.col("grams")
    spans = spans.withColumn("share", share).where((F.col("template") == CLOSING) | (share >= least_share))
    closing, base = F.col("template") == CLOSING, F.col("base")
    labels = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    span = F.struct("first", "last", "label", "share", "whole")
    return spans.groupBy("row", "id").agg(
        F.max(F.when(closing, F.col("first"))).cast("long").alias("n_words"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"),
        labels(~closing).alias("labels"),
        F.coalesce(F.max(F.when(~closing, F.least(F.col("share"), F.lit(1.0)))), F.lit(0.0)).alias("score"),
        F.sort_array(F.collect_list(F.when(~closing, span))).alias("spans"),
    ).drop("row")
