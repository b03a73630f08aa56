"""Groups of spelling variants: words one edit apart, found along a trie that is a table.

States (word, edited word, position, node) move through a distributed table of edges, one branching node a
round. A word leaves its own path at a branching node, by another letter there or by leaving its own letter
out, and from then on follows edges that spell the rest; a state that ends where a word ends is a pair. An
insertion is the other word's deletion, and of two words of one length that with the smaller letter starts.

An edit lies in the first or the second half of a word. So two tries are kept, of the words and of the words
reversed, and words leave their path in the second half only, where few words share it. Edges run from one
branching node to the next, which keeps rounds and rows few for words of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.llm import words as W
from addrspark.llm.shared import with_common, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT = 7, 2
DROP_EVERY = 31
TIMES_MORE = 10
WORDS_AT_ONCE = 1 << 18
# In no word.
END = "\n"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of at least 7 letters that occur twice or more, with their counts.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case. Where 31 divides the checksum of
    ``<id>:<word>``, the letter at checksum % length is left out. Null texts hold no words, a null id is empty.
    """
    # A run shorter than the least length stays too short when it loses a letter.
    runs = F.regexp_extract_all(text_col, F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{MIN_LENGTH},}}+"), F.lit(0))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    found = docs.select(name.alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8"))
    found = found.select("run", hashed.alias("h"), F.length("run").alias("length"))
    at = (F.col("h") % F.col("length")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("length")))
    word = F.when(F.col("h") % DROP_EVERY == 0, shorter).otherwise(F.col("run"))
    counted = found.select(word.alias("word")).filter(F.length("word") >= MIN_LENGTH).groupBy("word")
    return counted.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)


def _prefixes(least: int):
    """(word_id, way, t, node, letter): every prefix of ``t`` letters, forwards and backwards, and the letter after it."""
    lows = (least // 2, (least + 1) // 2)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in W.row_slices(batch.column("word"), WORDS_AT_ONCE):
                ids = batch.column("word_id").slice(lo, hi - lo).to_numpy()
                joined = "\n".join(batch.column("word").slice(lo, hi - lo).to_pylist()) + "\n"
                letters = np.frombuffer(joined.encode("utf-32-le"), "<u4")
                ends = np.flatnonzero(letters == 10)
                starts = np.concatenate([[0], ends[:-1] + 1])
                for way, symbols, first in ((0, letters, starts), (1, letters[::-1], len(letters) - ends)):
                    length = ends - starts
                    size = np.maximum(length - lows[way] + 1, 0)
                    of = np.repeat(np.arange(len(length)), size)
                    t = lows[way] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
                    stop = first[of] + t
                    node = W.span_hashes(symbols, first[of], stop, seed=21 + 2 * way).view(np.int64)
                    after = np.where(t < length[of], symbols[np.minimum(stop, len(symbols) - 1)], 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[of]), pa.array(np.full(len(of), way, np.int32)), pa.array(t.astype(np.int32)),
                         pa.array(node), pa.array(after.astype(np.int32))],
                        names=["word_id", "way", "t", "node", "letter"],
                    )

    return prefixes


def _paths(words: DataFrame, least: int) -> DataFrame:
    """(word, way, stops): every word, reversed where way is 1, with the branching nodes on its path."""
    numbered = written(words.select("word", F.monotonically_increasing_id().alias("word_id")), "words")
    prefixes = numbered.mapInArrow(_prefixes(least), "word_id bigint, way int, t int, node bigint, letter int")
    prefixes = written(prefixes, "prefixes")
    branching = prefixes.groupBy("node").agg(F.min("letter").alias("low"), F.max("letter").alias("high"), F.count(F.lit(1)).alias("times"))
    branching = written(branching.filter("low != high").select("node", "times"), "branching")
    stops = with_common(prefixes.drop("letter"), branching, ["node"], "times")
    stops = stops.groupBy("word_id", "way").agg(F.sort_array(F.collect_list(F.struct("t", "node"))).alias("stops"))
    ways = stops.join(numbered, "word_id")
    return written(ways.select(F.when(F.col("way") == 1, F.reverse("word")).otherwise(F.col("word")).alias("word"), "way", "stops"), "paths")


def _edges(paths: DataFrame) -> DataFrame:
    """(node, first, label, child, onward): the letters from a branching node to the next one, or to the end of a word.

    ``child`` is null at the end of a word. ``onward`` are the letters that go on from the child, with END where a
    word ends there, so that a state can see whether it will go on before it is made.
    """
    each = paths.select("word", "stops", F.posexplode("stops").alias("i", "stop"))
    child = F.get("stops", F.col("i") + 1)
    begin = F.col("stop.t") + 1
    label = F.when(child.isNull(), F.expr("substring(word, stop.t + 1)")).otherwise(F.substring("word", begin, child["t"] - F.col("stop.t")))
    edges = each.select(F.col("stop.node").alias("node"), label.alias("label"), child["node"].alias("child")).distinct()
    edges = written(edges.select("node", F.substring("label", 1, 1).alias("first"), "label", "child"), "edges")
    letters = F.array_join(F.collect_set(F.when(F.col("first") == "", END).otherwise(F.col("first"))), "")
    onward = edges.groupBy(F.col("node").alias("child")).agg(letters.alias("onward"))
    return written(edges.join(onward, "child", "left").select("node", "first", "label", "child", "onward"), "edges")


def _spells(word: str, position: Column, label: Column) -> Column:
    """Whether ``word`` goes on with the label from ``position``, to its end where the edge ends a word, and on from there."""
    rest = F.when(F.col("child").isNull(), F.length(word)).otherwise(F.length(label))
    after = F.substring(word, position + 1 + F.length(label), F.lit(1))
    goes_on = F.col("child").isNull() | (F.instr(F.col("onward"), F.when(after == "", END).otherwise(after)) > 0)
    return (F.substring(word, position + 1, rest) == label) & goes_on


def _left_paths(paths: DataFrame, edges: DataFrame) -> DataFrame:
    """The states right after the edit: (word, edited, way, t, node); no node where the edited word is complete."""
    length = F.length("word")
    half = F.when(F.col("way") == 0, F.floor(length / F.lit(2))).otherwise(F.ceil(length / F.lit(2)))
    at = paths.select("word", "way", F.explode("stops").alias("stop"))
    at = at.filter((F.col("stop.t") >= half) & (F.col("stop.t") < length)).select(
        "word", "way", F.col("stop.t").alias("t"), F.col("stop.node").alias("node"),
        F.substring("word", F.col("stop.t") + 1, F.lit(1)).alias("own"), F.substring("word", F.col("stop.t") + 2, F.lit(1)).alias("next"),
    )
    at = written(at, "leaving")
    common = at.groupBy("node").agg(F.count(F.lit(1)).alias("times"))
    ways_on = written(edges.join(common, "node"), "ways")
    met = with_common(at, ways_on, ["node"], "times").filter(F.col("first") != F.col("own"))
    t = F.col("t")
    replaced = (F.col("first") > F.col("own")) & _spells("word", t + 1, F.expr("substring(label, 2)"))
    deleted = (F.col("first") == F.col("next")) & _spells("word", t + 1, F.col("label"))
    before, after = F.substring("word", F.lit(1), t), F.expr("substring(word, t + 2)")
    met = met.filter(replaced | deleted).select(
        "word", "way", "child", "label", "t",
        F.explode(F.array_compact(F.array(
            F.when(replaced, F.concat(before, "first", after)), F.when(deleted, F.concat(before, after))
        ))).alias("edited"),
    )
    return met.select("word", "edited", "way", (t + F.length("label")).alias("t"), F.col("child").alias("node"))


def near_words(words: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(word, near): all pairs of words, in both directions, that one inserted, deleted or replaced letter tells apart.

    ``words`` are distinct and have at least ``least`` letters. Node names are 64-bit hashes; words that
    share one by chance share edges as well, and the comparison at the end rejects what comes of it.
    """
    paths = _paths(words, least)
    edges = _edges(paths)
    reached = [written(_left_paths(paths, edges), "states")]
    while not (states := reached[-1].filter(F.col("node").isNotNull())).isEmpty():
        on = states.withColumn("first", F.substring("edited", F.col("t") + 1, F.lit(1)))
        met = on.join(edges, ["node", "first"]).filter(_spells("edited", F.col("t"), F.col("label")))
        moved = met.select("word", "edited", "way", (F.col("t") + F.length("label")).alias("t"), F.col("child").alias("node"))
        reached.append(written(moved, "states"))
    pairs = reached[0]
    for more in reached[1:]:
        pairs = pairs.unionByName(more)
    turned = {c: F.when(F.col("way") == 1, F.reverse(c)).otherwise(F.col(c)) for c in ("word", "edited")}
    pairs = pairs.filter(F.col("node").isNull()).select(turned["word"].alias("word"), turned["edited"].alias("near")).distinct()
    pairs = pairs.filter(F.levenshtein("word", "near", 1) == 1)
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where a chain of forms ends. Counts grow tenfold a step, so chains and rounds are short."""
    roots = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = roots.join(onward, "root", "left")
        longer = written(longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        roots = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return roots


def group_variants(words: DataFrame, least: int = MIN_LENGTH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every row of ``words`` (word, n).

    A word's form is its most frequent near word, the smaller one of equals, if that is at least ten times as
    frequent. ``root`` is where the forms end, the word itself if it has none.
    """
    words = written(words, "vocabulary")
    near = near_words(words.select("word"), least)
    counted = near.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    likely = -F.col("best.less") >= F.col("n") * TIMES_MORE
    known = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(likely, F.col("best.near")).alias("form"), F.when(likely, -F.col("best.less")).alias("form_n"),
    )
    known = written(known, "forms")
    roots = _roots(known.filter(F.col("form").isNotNull()).select("word", "form"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The words of a table of documents with their spelling forms, as ``group_variants`` gives them.

    Repeated rows count again; an empty table has no words. Other columns are not read.
    """
    return group_variants(vocabulary(docs, id_col, text_col))
