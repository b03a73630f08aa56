"""Licence statements found through a positional index of rare words.

The index is a table of postings: for every licence template its words of highest inverse document frequency,
with where they stand in it. The words of all files meet their postings in one join, and a hit proposes where
its template would start, so the work for a hit does not grow with the number of templates. Proposals for one
start are intersected by counting their words; a start counts when its mandatory key phrase stands word by word
and enough of the template's weight is there. Base phrases are templates that must match whole; every place of
theirs contains the looked-up word, so none is missed.

Everything is SQL. Templates are a table, frequencies are counted over all documents, and only files that hold
a rare word are looked at again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from addrspark.llm.shared import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# All ASCII characters but letters and digits.
BETWEEN = "".join(chr(c) for c in [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
RARE_WORDS = 3
MIN_SHARE = 0.6


class Template(NamedTuple):
    """A statement in words, and the phrase in it without which it does not count."""

    label: str
    text: str
    key: str


# Base phrases, all of whose places count.
BASE = (
    Template("cc-by", "cc by", "cc by"),
    Template("gpl", "general public license", "general public license"),
    Template("reserved", "all rights reserved", "all rights reserved"),
)
TEMPLATES = (
    Template("agpl-3.0", "gnu affero general public license version 3", "gnu affero general public license"),
    Template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc"),
    Template("cc0-1.0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license version", "gnu lesser general public license"),
    Template("mit", "released under the mit license", "mit license"),
    Template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    Template("mpl-2.0", "mozilla public license version 2 0", "mozilla public license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)


def template_table(spark: SparkSession, templates: tuple[Template, ...] = TEMPLATES, base: tuple[Template, ...] = BASE) -> DataFrame:
    """Templates as a table: label, text, key, whole (true for base phrases)."""
    rows = [(*t, False) for t in templates] + [(*t, True) for t in base]
    return spark.createDataFrame(rows, "label string, text string, key string, whole boolean")


def words_of(text: Column) -> Column:
    """Words in order: runs of letters, digits and non-ASCII characters, A-Z lower-cased; none of a null text.

    One translation makes every other character a space, which is much cheaper than a pattern.
    """
    spaced = F.translate(F.coalesce(text, F.lit("")), UPPER + BETWEEN, LOWER + " " * len(BETWEEN))
    return F.array_remove(F.split(spaced, " "), "")


def build_index(docs: DataFrame, templates: DataFrame, rare: int, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(templates, postings), both written.

    Templates get a number, the arrays ``words`` and ``weights`` (inverse document frequencies over all of
    ``docs``) and the place of their key phrase. Postings are (word, template, at, vote): the ``rare`` words of
    highest weight of each template (one word of a base phrase), ties by place, each with a bit of its own. A
    template whose key phrase does not stand in it can never count and is left out.
    """
    said = templates.select(
        F.xxhash64("label", "text", "key", "whole").alias("template"), "label", "whole",
        words_of(F.col("text")).alias("words"), words_of(F.col("key")).alias("key"),
    ).dropDuplicates(["template"])
    n = F.size("key")
    places = F.filter(F.sequence(F.lit(0), F.greatest(F.size("words") - n, F.lit(0))), lambda k: F.slice("words", k + 1, n) == F.col("key"))
    said = said.filter(n > 0).withColumn("key_at", F.get(places, F.lit(0))).filter(F.col("key_at").isNotNull())
    said = written(said, "templates")
    placed = said.select("template", "whole", F.posexplode("words").alias("at", "word"))
    vocabulary = written(placed.select("word").distinct(), "vocabulary")
    # How words meet the vocabulary is Spark's choice by its size, which a written table tells.
    seen = docs.select(F.explode(F.array_distinct(words_of(F.col(f"`{text_col}`")))).alias("word"))
    counts = seen.join(vocabulary, "word").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = docs.count()
    n = F.coalesce("n", F.lit(0))
    weight = F.ln(1 + (F.lit(total) - n + 0.5) / (n + 0.5))
    weighed = written(placed.join(counts, "word", "left").withColumn("weight", weight).drop("n"), "weights")
    ranked = F.row_number().over(Window.partitionBy("template").orderBy(F.col("weight").desc(), "at"))
    postings = weighed.withColumn("rank", ranked).filter(F.col("rank") <= F.when(F.col("whole"), 1).otherwise(rare))
    postings = postings.select("word", "template", "at", F.call_function("shiftleft", F.lit(1), F.col("rank") - 1).alias("vote"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("at", "weight"))), lambda x: x["weight"])
    weights = weighed.groupBy("template").agg(in_order.alias("weights"))
    return written(said.join(weights, "template"), "index"), written(postings, "postings")


def files_with(docs: DataFrame, postings: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, n_words, words) of every row, ``words`` only where a file holds one of the looked-up words.

    The table is written, as all later steps read it. The looked-up words, a few for each template, become
    a literal of the plan.
    """
    rare = [r["word"] for r in postings.select("word").distinct().collect()]
    text = F.col(f"`{text_col}`")
    split = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("digest"), words_of(text).alias("words")
    )
    holds = F.arrays_overlap("words", F.lit(sorted(rare)).cast("array<string>"))
    return written(split.select("id", "digest", F.size("words").cast("bigint").alias("n_words"), F.when(holds, F.col("words")).alias("words")), "files")


def proposed_starts(docs: DataFrame, templates: DataFrame, postings: DataFrame, rare: int) -> DataFrame:
    """(id, digest, template, start) where enough rare words of a template stand in their places.

    Two of a template's rare words are enough, all of them where it has fewer. ``start`` may lie before the
    text's first word.
    """
    words = docs.select("id", "digest", F.posexplode("words").alias("pos", "word"))
    hits = words.join(postings, "word").select("id", "digest", "template", (F.col("pos") - F.col("at")).alias("start"), "vote")
    # Repeated rows and repeated words set the same bits.
    met = hits.groupBy("id", "digest", "template", "start").agg(F.bit_count(F.bit_or("vote")).alias("votes"))
    needed = templates.select("template", F.when(F.col("whole"), 1).otherwise(F.least(F.lit(2), F.lit(rare), F.size("words"))).alias("needed"))
    return met.join(needed, "template").filter(F.col("votes") >= F.col("needed")).select("id", "digest", "template", "start")


def _verified(starts: DataFrame, docs: DataFrame, templates: DataFrame, min_share: float) -> DataFrame:
    """(id, digest, label, start, share): share is 1 where a base phrase stands, null for no row."""
    sized = starts.join(templates.select("template", F.size("words").alias("length")), "template")
    each = sized.groupBy("id", "digest").agg(F.collect_list(F.struct("template", "start", "length")).alias("starts"))
    keyed = each.withColumnsRenamed({"id": "at_id", "digest": "at_digest"})
    same = F.col("id").eqNullSafe(F.col("at_id")) & (F.col("digest") == F.col("at_digest"))
    # Rows equal in id and text are one here.
    held = docs.join(keyed, same).dropDuplicates(["id", "digest"]).select("id", "digest", "words", "starts")
    skip = lambda s: F.greatest(-s["start"], F.lit(0))
    cut = F.transform("starts", lambda s: F.struct(
        s["template"].alias("template"), s["start"].alias("start"), skip(s).alias("skip"),
        F.slice("words", s["start"] + skip(s) + 1, s["length"] - skip(s)).alias("there"),
    ))
    found = held.select("id", "digest", F.inline(cut)).join(templates, "template")
    rest = F.greatest(F.size("words") - F.col("skip"), F.lit(0))
    wanted = F.slice("words", F.col("skip") + 1, rest)
    worth = F.slice("weights", F.col("skip") + 1, rest)
    weights = F.zip_with(F.zip_with("there", wanted, lambda a, b: a.eqNullSafe(b)), worth, lambda same, x: F.when(same, x).otherwise(0.0))
    add = lambda values: F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    share = add(weights) / add(F.col("weights"))
    key_from = F.col("key_at") - F.col("skip")
    stands = (key_from >= 0) & (F.slice("there", F.greatest(key_from, F.lit(0)) + 1, F.size("key")) == F.col("key"))
    share = F.when(F.col("whole"), F.when(F.col("there") == F.col("words"), 1.0)).otherwise(F.when(stands, share))
    judged = found.select("id", "digest", "label", "whole", F.col("start").cast("bigint").alias("start"), share.alias("share"))
    return judged.filter(F.col("whole") & (F.col("share") == 1.0) | ~F.col("whole") & (F.col("share") >= min_share))


def scan_licenses(
    docs: DataFrame,
    templates: DataFrame | None = None,
    rare: int = RARE_WORDS,
    min_share: float = MIN_SHARE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    ``templates`` are a table as ``template_table`` makes it, of any number of texts of any length. A null or
    empty text has no words, empty labels and score 0. ``score`` is the largest share of a template found, to six
    places, 1 for a base phrase. ``places`` has (label, start) of every base place. Other columns of ``docs``
    are not looked at; repeated rows are scanned each. A text is known by its id and a digest, so
    that rows equal in both are scanned alike; an empty table gives an empty result.
    """
    table = template_table(docs.sparkSession) if templates is None else templates
    index, postings = build_index(docs, table, rare, text_col)
    files = files_with(docs, postings, id_col, text_col)
    known = files.filter(F.col("words").isNotNull())
    starts = written(proposed_starts(known, index, postings, rare), "starts")
    found = _verified(starts, known, index, min_share)
    base = F.col("whole")
    spots = F.array_sort(F.collect_list(F.when(base, F.struct("start", "label"))))
    per_text = found.groupBy("id", "digest").agg(
        spots.alias("places"), F.collect_set("label").alias("labels"), F.collect_set(F.when(base, F.col("label"))).alias("base_labels"),
        F.max(F.when(~base, F.col("share"))).alias("share"),
    )
    per_text = per_text.withColumnsRenamed({"id": "at_id", "digest": "at_digest"})
    same = F.col("id").eqNullSafe(F.col("at_id")) & (F.col("digest") == F.col("at_digest"))
    none = F.array().cast("array<string>")
    n_base = F.when(F.col("places").isNull(), 0).otherwise(F.size("places"))
    first = F.transform("places", lambda x: x["start"])
    score = F.when(n_base > 0, 1.0).otherwise(F.round(F.least(F.coalesce("share", F.lit(0.0)), F.lit(1.0)), 6))
    return files.join(per_text, same, "left").select(
        F.col("id").alias(id_col), "n_words", n_base.cast("bigint").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        F.array_join(F.array_sort(F.coalesce("base_labels", none)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.coalesce("labels", none)), ",").alias("labels"),
        score.alias("score"), "places",
    )
