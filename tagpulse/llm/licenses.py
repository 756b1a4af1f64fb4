"""License notices by diagonal voting: word k-grams of texts meet those of templates, and agree on an offset."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

GRAM = 3  # words; the shortest phrase has three

# The phrases of the base labels.
PHRASES = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
# The opening or defining words of common licenses and notices.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction including without limitation the "
            "rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
                 "with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license as published by the free software foundation"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("all-rights-reserved", "all rights reserved"),
]


def words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, lower-cased in A-Z."""
    # lower() is exact for A-Z; of the characters beyond, these two alone would become ASCII letters
    text = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ")), F.lit("İ"), F.lit("ı"))
    return F.array_remove(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def grams(found: Column) -> Column:
    """Hashes of every GRAM consecutive words."""
    at = F.sequence(F.lit(0), F.size(found) - GRAM)
    each = F.transform(at, lambda i: F.xxhash64(*[F.get(found, i + k) for k in range(GRAM)]))
    return F.when(F.size(found) >= GRAM, each).otherwise(F.array().cast("array<long>"))


def template_grams(spark: SparkSession) -> DataFrame:
    """One row per template and place in it: a fixed, small table."""
    rows = [F.struct(F.lit(k).alias("template"), F.lit(label).alias("label"), F.lit(k < len(PHRASES)).alias("base"), F.lit(text).alias("text"))
            for k, (label, text) in enumerate(PHRASES + NOTICES)]
    texts = spark.range(1).select(F.inline(F.array(*rows))).withColumn("found", words(F.col("text")))
    places = texts.select("template", "label", "base", "found", F.posexplode(grams(F.col("found"))).alias("place", "gram"))
    return places.select(
        "template", "label", "base", "place", "gram", (F.size("found") - GRAM + 1).alias("places"),
        F.slice("found", F.col("place") + 1, GRAM).alias("spelled"))


def scan(docs: DataFrame, coverage: float = 0.5, slack: int = 3) -> DataFrame:
    """License notices in every text of `docs` (`doc_id`, `text`).

    All rolling hashes of three words are joined to the places of the templates, spelling compared. A hit votes for its
    diagonal, the offset between text and template; diagonals at most `slack` apart merge if they have no place in
    common, as a word more or less shifts what follows. A phrase of the base is found where one diagonal has all its places. A notice is found where merged
    diagonals cover at least `coverage` of its places, over no more than twice its length.

    Per row: doc_id, n_words, n_base (places of base phrases), first_word and last_word (their smallest and largest start,
    else NULL), base_labels, labels (with those of notices; distinct, sorted, comma-joined, empty if none), score (the
    largest coverage of a template, 1 for a base phrase), spans (label, start, end in words).
    A NULL or empty text has no words and no labels; a NULL doc_id is kept; repeated rows come out once each; an empty table
    gives no rows; other columns are ignored. Texts are read once; only hits and one row per document are shuffled.
    """
    templates = template_grams(docs.sparkSession)
    mark = F.lit(-1).cast("long")  # ends every document's hashes, so that a document without hits has a row too
    ends = templates.limit(1).select(
        F.lit(-1).alias("template"), F.lit("").alias("label"), F.lit(False).alias("base"), F.lit(0).alias("place"),
        mark.alias("gram"), F.lit(1).alias("places"), F.array().cast("array<string>").alias("spelled"))
    hashed = (
        docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("found"))
        .select("row", "doc_id", "found", F.size("found").cast("long").alias("n_words"), F.concat(grams(F.col("found")), F.array(mark)).alias("grams"))
        .select("row", "doc_id", "n_words", "found", F.posexplode("grams").alias("at", "gram")))
    spelled = F.slice("found", F.col("at") + 1, GRAM) == F.col("spelled")
    closing = (F.col("template") < 0) & (F.col("at") == F.greatest(F.col("n_words") - GRAM + 1, F.lit(0)))
    hits = (
        hashed.join(F.broadcast(templates.union(ends)), "gram")
        .where(F.when(F.col("template") < 0, closing).otherwise(spelled))
        .select("row", "doc_id", "n_words", "template", "label", "base", "places", F.col("at").cast("long"), "place")
        .repartition("row"))  # every later grouping is within a row, so this is the one shuffle

    own = ["row", "doc_id", "n_words", "template", "label", "base", "places"]
    diagonal = (F.col("at") - F.col("place")).alias("diagonal")
    votes = hits.groupBy(*own, diagonal).agg(
        F.collect_set("place").alias("seen"), F.min("at").alias("start"), (F.max("at") + GRAM).alias("end"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    before = F.lag("diagonal").over(along)
    again = F.arrays_overlap("seen", F.lag("seen").over(along))  # a place twice: the notice is there once more
    apart = F.col("base") | before.isNull() | (F.col("diagonal") - before > slack) | again
    merged = (
        votes.withColumn("apart", apart.cast("int")).withColumn("group", F.sum("apart").over(along))
        .groupBy(*own, "group").agg(
            F.size(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"),
            F.min("diagonal").alias("diagonal"), F.min("start").alias("start"), F.max("end").alias("end")))
    covered = F.col("seen") / F.col("places")
    near = F.col("end") - F.col("start") <= 2 * (F.col("places") + GRAM)
    real = F.when(F.col("base"), F.col("seen") == F.col("places")).otherwise((covered >= coverage) & near)
    found = merged.withColumn("real", F.coalesce(real & (F.col("template") >= 0), F.lit(False))).withColumn("covered", covered)
    base = F.col("real") & F.col("base")
    name = lambda condition: F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("diagonal"))).alias("first_word"), F.max(F.when(base, F.col("diagonal"))).alias("last_word"),
        name(base).alias("base_labels"), name(F.col("real")).alias("labels"),
        F.coalesce(F.max(F.when(F.col("template") >= 0, F.least(F.when(near, F.col("covered")).otherwise(0.0), F.lit(1.0)))), F.lit(0.0)).alias("score"),
        F.array_sort(F.collect_list(F.when(F.col("real"), F.struct("label", "start", "end")))).alias("spans")).drop("row")
