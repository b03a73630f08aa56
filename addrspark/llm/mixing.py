"""Mixing sources to target weights by blocks of a fixed number of words.

The texts of a source, in a fixed order, form one stream of words that is cut into blocks. A source's
target becomes a number of slots. Every output shard draws its counts of slots per source: as many draws as it
has slots, each falling on a source with the source's share of all slots. Totals over the shards are then
brought to the targets by scaling a source's counts. The counts give each shard its slots of a source; slots
reach blocks through a pseudorandom permutation of the source's block indices, a new one for each epoch, and
slots and blocks meet in a join on (source, index).

Everything is SQL. A source of any size is spread: its order is found bucket by bucket, its slots are made
in chunks, and both sides of the join are keyed by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.llm.shared import numbered, restored, written
from addrspark.operators.skew import null_safe_join

BLANKS = "\t\n\x0b\f\r"
BLOCK_WORDS = 128
ROUNDS = 12
ORDER_BUCKETS = 4096
CHUNK_SLOTS = 4096
MOST_REPEATS = 3


def blank_split(text: Column) -> Column:
    """Words in order: runs without blanks and line breaks. Much cheaper than a pattern's matches."""
    return F.array_remove(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), "")


def _number(hashed: Column, digits: int = 12) -> Column:
    return F.conv(F.substring(hashed, 1, digits), 16, 10).cast("bigint")


def _permuted(index: Column, blocks: Column, seed: Column, backwards: bool = False) -> Column:
    """A permutation of 0..blocks-1 by swap-or-not rounds; each round is its own inverse."""

    def turn(x: Column, r: Column) -> Column:
        named = F.concat_ws("/", seed, r.cast("string"))
        other = F.pmod(_number(F.md5(named)) - x, blocks)
        bit = F.substring(F.md5(F.concat_ws("/", named, F.greatest(x, other).cast("string"))), 1, 1)
        return F.when(bit < "8", other).otherwise(x)

    order = range(ROUNDS - 1, -1, -1) if backwards else range(ROUNDS)
    return F.aggregate(F.array(*[F.lit(r) for r in order]), index.cast("bigint"), turn)


def sized_documents(docs: DataFrame, *more: str, id_col: str = "doc_id") -> DataFrame:
    """id, source, size in words, and the bucket of the source's order that the row belongs to."""
    # Rows without an id are many in one place unless their texts spread them.
    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    hashed = F.md5(F.concat(F.lit("order/"), key))
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col("source").cast("string").alias("source"),
        F.size(blank_split(F.coalesce("text", F.lit("")))).cast("bigint").alias("size"),
        _number(hashed, 3).cast("int").alias("bucket"),
        *more,
    )


def source_targets(sizes: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: rank, source_size, weight, target, epochs, left, blocks, short, slots.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the total of all sizes.
    Targets stop at three times the source's size; what is over goes to the others by weight. That is the
    level at which the sources with the least size per weight are full, found by running sums. Takes the
    sums per source only, so the unpartitioned windows see a row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = by_source.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", (F.col("rank") - 1) % 3 + 1)
    most = F.col("source_size") * MOST_REPEATS
    fullest_first = Window.orderBy(most / F.col("weight"), "rank")
    before = fullest_first.rowsBetween(Window.unboundedPreceding, -1)
    after = fullest_first.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    rest = F.sum("source_size").over(everything) - F.coalesce(F.sum(most).over(before), F.lit(0))
    leveled = ranked.withColumn("level", rest / F.sum("weight").over(after))
    open_level = F.when(most / F.col("weight") > F.col("level"), F.col("level"))
    leveled = leveled.withColumn("level", F.max(open_level).over(everything))
    target = F.least(most.cast("double"), F.coalesce(F.col("level") * F.col("weight"), most.cast("double")))
    wanted = leveled.withColumn("target", target).withColumn("words", F.floor(F.col("target") + 0.5))
    size = F.col("source_size")
    some = F.when(size > 0, size)
    wanted = wanted.withColumns(
        {
            "epochs": F.coalesce(F.floor(F.col("words") / some), F.lit(0)).cast("bigint"),
            "left": F.coalesce(F.pmod("words", some), F.lit(0)).cast("bigint"),
            "blocks": F.ceil(size / F.lit(block_words)).cast("bigint"),
        }
    )
    # The stream's last block is short by this much; where the last epoch meets it decides the slot count.
    lack = F.col("blocks") * block_words - size
    seed = F.concat_ws("/", F.col("rank"), F.col("epochs"))
    wanted = wanted.withColumns(
        {
            "lack": lack,
            "short": F.when(size > 0, _permuted(F.col("blocks") - 1, F.col("blocks"), seed, backwards=True)),
        }
    )
    plain = F.ceil(F.col("left") / F.lit(block_words))
    slots = F.when(F.col("short") < plain, F.ceil((F.col("left") + F.col("lack")) / F.lit(block_words))).otherwise(plain)
    return wanted.withColumn("last_slots", F.coalesce(slots, F.lit(0)).cast("bigint"))


def _chunks(df: DataFrame, total: Column, *columns: str) -> DataFrame:
    """``columns`` of each row with ``slot``, the numbers below ``total``, made in chunks by many tasks."""
    last_chunk = F.floor((total - 1) / F.lit(CHUNK_SLOTS))
    chunks = df.filter(total > 0).select(
        *columns, total.alias("total"), F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)).alias("chunk")
    )
    first = F.col("chunk") * CHUNK_SLOTS
    last = F.least(first + CHUNK_SLOTS, F.col("total")) - 1
    # With a number given, adaptive execution does not merge the chunks, which are few but grow to many slots.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = chunks.repartition(tasks, *[c for c in columns if c in ("rank", "shard")], "chunk")
    return spread.select(*columns, F.explode(F.sequence(first, last)).alias("slot"))


def shard_counts(targets: DataFrame, shards: int) -> DataFrame:
    """(rank, upto): per source the slots that shards 0, 1, ... hold up to and with each, by multinomial draws.

    Shard j of n draws a source once for each of its slots, by a hash seeded with the shard. A source's counts
    over the shards are then scaled, in running sums rounded down, so that they add up to its slots; a source
    that no shard has drawn is spread evenly. Draws are counted per shard and source before the shuffle.
    """
    slots = (F.col("epochs") * F.col("blocks") + F.col("last_slots")).alias("slots")
    wanted = targets.select("rank", slots)
    lists = F.sort_array(F.collect_list(F.struct("rank", "slots")))
    one = wanted.agg(lists.alias("by_rank"), F.sum("slots").alias("n"))
    sums = F.transform("by_rank", lambda x: F.aggregate(
        F.filter("by_rank", lambda y: y["rank"] <= x["rank"]), F.lit(0).cast("bigint"), lambda a, y: a + y["slots"]
    ))
    each = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    one = one.filter("n > 0").select(sums.alias("sums"), "n", each)
    own = F.floor(F.col("n") / F.lit(shards)) + F.when(F.col("shard") < F.pmod("n", F.lit(shards)), 1).otherwise(0)
    draws = _chunks(one, own, "shard", "sums", "n")
    drawn = F.pmod(_number(F.md5(F.concat_ws("/", F.lit("draw"), "shard", "slot"))), F.col("n"))
    found = draws.select("shard", "sums", drawn.alias("drawn"))
    rank = F.size(F.filter("sums", lambda x: x <= F.col("drawn"))) + 1
    counted = found.select("shard", rank.alias("rank")).groupBy("rank", "shard").agg(F.count(F.lit(1)).alias("c"))
    by_shard = counted.groupBy("rank").agg(F.map_from_entries(F.collect_list(F.struct("shard", "c"))).alias("counts"))
    met = wanted.join(by_shard, "rank", "left")
    filled = F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda k: F.when(
        F.col("counts").isNull(), F.lit(1).cast("bigint")).otherwise(F.coalesce(F.element_at("counts", k), F.lit(0).cast("bigint")))
    )
    met = met.withColumn("c", filled)
    running = F.transform("c", lambda _, k: F.aggregate(F.slice("c", 1, k + 1), F.lit(0).cast("bigint"), lambda a, x: a + x))
    met = met.withColumn("running", running)
    wide = "transform(running, r -> cast(r as decimal(19, 0)) * cast(slots as decimal(19, 0)) div cast(running[size(running) - 1] as decimal(19, 0)))"
    return met.select("rank", F.expr(wide).alias("upto"))


def mixture_slots(targets: DataFrame, shards: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every slot of the mixture: shard, rank, epoch, index (of the block), words (taken from its start).

    An epoch but the last one takes each block of the source once. The last one ends after ``left`` words,
    so that the words of a source's slots add up to its target. Slots belong to shards as ``shard_counts`` says.
    """
    columns = ["rank", "epochs", "left", "blocks", "lack", "short", "upto"]
    total = F.col("epochs") * F.col("blocks") + F.col("last_slots")
    slots = _chunks(targets.join(shard_counts(targets, shards), "rank"), total, *columns)
    slots = slots.select(
        "*",
        F.floor(F.col("slot") / F.col("blocks")).alias("epoch"),
        F.pmod("slot", "blocks").alias("turn"),
        F.size(F.filter("upto", lambda x: x <= F.col("slot"))).alias("shard"),
    )
    seed = F.concat_ws("/", F.col("rank"), F.col("epoch"))
    slots = slots.withColumn("index", _permuted(F.col("turn"), F.col("blocks"), seed))
    full = F.lit(block_words) - F.when(F.col("index") == F.col("blocks") - 1, F.col("lack")).otherwise(0)
    taken = F.col("turn") * block_words - F.when(F.col("turn") > F.col("short"), F.col("lack")).otherwise(0)
    words = F.when(F.col("epoch") < F.col("epochs"), full).otherwise(F.least(full, F.col("left") - taken))
    return slots.select("shard", "rank", "epoch", "index", words.cast("bigint").alias("words"))


def placed_documents(sizes: DataFrame, targets: DataFrame, *more: str) -> DataFrame:
    """Rows of ``sizes`` with the source's rank and ``start``, the place of their first word in its stream.

    The order in a source is (hash bucket, id, size); rows equal in these are interchangeable.
    """
    ranks = targets.select("source", "rank")
    ranked = null_safe_join(sizes, ranks, ["source"], "inner").select("id", "rank", "size", "bucket", *more)
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        null_safe_join(sizes.groupBy("source", "bucket").agg(F.sum("size").alias("n")), ranks, ["source"], "inner")
        .select("rank", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = Window.partitionBy("rank", "bucket").orderBy(F.col("id").asc_nulls_last(), "size")
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranked.withColumn("upto", F.sum("size").over(upto)).join(offsets, ["rank", "bucket"])
    return summed.select(
        "id", "rank", "size", (F.col("offset") + F.col("upto") - F.col("size")).alias("start"), *more
    )


def block_pieces(placed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """What each text puts into each block: rank, index, start (of the text), begin and end in the block."""
    last = F.floor((F.col("start") + F.col("size") - 1) / F.lit(block_words))
    blocks = F.sequence(F.floor(F.col("start") / F.lit(block_words)), last)
    pieces = placed.filter(F.col("size") > 0).select("rank", "start", "size", F.explode(blocks).alias("index"))
    first = F.col("index") * block_words
    return pieces.select(
        "rank", "start", "index",
        (F.greatest(F.col("start"), first) - first).alias("begin"),
        (F.least(F.col("start") + F.col("size"), first + block_words) - first).alias("end"),
    )


def taken_pieces(placed: DataFrame, targets: DataFrame, shards: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixture as parts of texts: shard, rank, start (of the text), epoch, offset (in the text), words."""
    slots = mixture_slots(targets, shards, block_words)
    # The planner sees the few source rows that slots are made from and would broadcast them.
    met = block_pieces(placed, block_words).join(slots.hint("merge"), ["rank", "index"])
    words = F.least(F.col("end"), F.col("words")) - F.col("begin")
    offset = F.col("index") * block_words + F.col("begin") - F.col("start")
    return met.filter(F.col("words") > F.col("begin")).select(
        "shard", "rank", "start", "epoch", offset.alias("offset"), words.alias("words")
    )


def mix_sources(docs: DataFrame, shards: int = 24, block_words: int = BLOCK_WORDS, id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, size, source_size, target, taken and taken_by_shard.

    ``taken`` are the words that the mix takes, repeats counted; ``taken_by_shard`` tells them apart as
    ``shard:words``, in order of shards. A null text has no words; rows without words take part with nothing
    taken. Null is a source of its own. No text is taken more than three times over. The words taken of a source
    are its target, rounded. Rows repeated in the table are texts of their own. Empty tables give an empty result.
    """
    sizes = written(sized_documents(docs, id_col=id_col), "sizes")
    targets = written(source_targets(sizes, block_words), "targets")
    placed = written(placed_documents(sizes, targets), "placed")
    pieces = taken_pieces(placed, targets, shards, block_words)
    by_shard = pieces.groupBy("rank", "start", "shard").agg(F.sum("words").alias("words"))
    shown = F.transform(F.sort_array(F.collect_list(F.struct("shard", "words"))), lambda x: F.concat_ws(":", x["shard"], x["words"]))
    taken = by_shard.groupBy("rank", "start").agg(F.sum("words").alias("taken"), F.array_join(shown, ",").alias("taken_by_shard"))
    known = targets.select("rank", "source_size", "target")
    filled = placed.filter(F.col("size") > 0).join(taken, ["rank", "start"], "left")
    nothing = {"taken": F.lit(0).cast("bigint"), "taken_by_shard": F.lit("")}
    rows = filled.unionByName(placed.filter(F.col("size") == 0).withColumns(nothing))
    return rows.join(known, "rank").select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        *[F.coalesce(c, value).alias(c) for c, value in nothing.items()],
    )


def mixed_texts(docs: DataFrame, shards: int = 24, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mixture as rows like those of ``docs``, one per document, epoch and output shard that takes words of it.

    A row that takes a document whole repeats it unchanged; otherwise the text is the words taken, in
    order, joined by one space, and n_chars (where there is such a column) follows it. Texts without words give
    no rows; a null source is a source of its own, null ids are texts of their own, and so are repeated rows.
    """
    lines = numbered(docs, "lines")
    field = {c: F.col("row").getField(f"in_{docs.columns.index(c)}").alias(c) for c in ("doc_id", "source", "text")}
    sizes = sized_documents(lines.select("line", *field.values()), "line").filter(F.col("size") > 0)
    sizes = written(sizes, "sizes")
    targets = written(source_targets(sizes, block_words), "targets")
    placed = written(placed_documents(sizes, targets, "line"), "placed")
    pieces = taken_pieces(placed, targets, shards, block_words)
    parts = pieces.groupBy("rank", "start", "epoch", "shard").agg(
        F.sort_array(F.collect_list(F.struct("offset", "words"))).alias("parts"), F.sum("words").alias("taken")
    )
    # A document's parts are as many as its blocks and epochs, so they fit beside its text.
    parts = placed.join(parts, ["rank", "start"]).groupBy("line").agg(
        F.first("size").alias("size"), F.collect_list(F.struct("epoch", "shard", "parts", "taken")).alias("takes")
    )
    met = lines.select("line", "row", field["text"]).join(parts, "line")
    split = blank_split(F.col("text"))

    def text_of(words: Column, take: Column) -> Column:
        cut = F.transform(take["parts"], lambda p: F.slice(words, (p["offset"] + 1).cast("int"), p["words"].cast("int")))
        return F.when(take["taken"] == F.col("size"), F.col("text")).otherwise(F.array_join(F.flatten(cut), " "))

    # The one-element array makes the words a bound variable, split once per document.
    texts = F.flatten(F.transform(F.array(split), lambda w: F.transform("takes", lambda t: text_of(w, t))))
    rows = met.select("row", F.explode(texts).alias("mixed_text"))
    changed = {"text": F.col("mixed_text").alias("text"), "n_chars": F.length("mixed_text").cast("bigint").alias("n_chars")}
    given = dict(zip(docs.columns, restored(rows, docs.columns), strict=True))
    return rows.select(*[changed.get(c, given[c]) for c in docs.columns])
