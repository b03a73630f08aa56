"""Joins of points with the spans that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from addrspark.operators.asof import _micros
from addrspark.operators.checks import require_columns

# Bins of a level are this many bits wider than those of the level below: four times as wide.
LEVEL_BITS = 2
# Totals: blocks of a level hold sixteen of the level below, blocks of the lowest this many different places at most.
BLOCK_BITS = 4
MOST_PLACES = 128

_PARTS = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
_MERGED = _PARTS | {"count": F.sum}


def span_levels(spans: DataFrame, start: str, end: str) -> DataFrame:
    """``spans`` with low, high (whole numbers) and level, the least with bins as wide as they are.

    Spans that end before they start, or lack an end, hold nothing and are left out.
    """
    low, high = _micros(spans, start), _micros(spans, end)
    sized = spans.withColumns({"span_low": low, "span_high": high}).filter(F.col("span_low") <= F.col("span_high"))
    length = F.col("span_high") - F.col("span_low") + 1
    # Twice rounded logarithms may be one off; a comparison of whole numbers settles it.
    guess = F.ceil(F.log(float(1 << LEVEL_BITS), length.cast("double"))).cast("int")
    level = F.when(_width(guess) < length, guess + 1).when((guess > 0) & (_width(guess - 1) >= length), guess - 1).otherwise(guess)
    return sized.withColumn("span_level", level)


def _width(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), level * LEVEL_BITS)


def _bin(place: str) -> Column:
    """The bin of a whole number at its row's level, rounded down."""
    return F.call_function("shiftright", F.col(place), F.col("span_level") * LEVEL_BITS)


def join_spans(
    points: DataFrame,
    spans: DataFrame,
    at: str,
    start: str,
    end: str,
    keys: list[str] | None = None,
    totals: dict[str, tuple[str, str]] | None = None,
    most_places: int = MOST_PLACES,
) -> DataFrame:
    """Pairs of a point and a span with ``start`` <= ``at`` <= ``end``, equal in ``keys``; all columns of both.

    Columns besides the keys must have different names. Dates, timestamps and whole numbers will do. Null keys and
    null places meet nothing. Each repeated row makes pairs of its own.

    A span goes into the bins of its own level, which are at least as wide as the span and at most four times
    as wide, so that there are two at most, however long it is. A point goes into one bin of each level that some
    span has, so a pair meets once. Levels number 32 at most and are counted first. What meets in a bin is near
    enough for about one pair in four or more to be wanted; a crowded bin is split by adaptive execution.

    There are as many pairs as points times spans where spans are long. Who wants totals only names them: ``totals``
    gives new columns as (count, sum, min or max; column of ``points``, ``*`` for a count of rows). The points of a span
    then come in parts, a row of the span's columns and the part's totals for each; every point that the span holds is in
    exactly one of them, so that the totals of a span are those of its rows (a count is their sum).

    For that, points of one place are one row, and rows are totalled by blocks of places: the lowest have the greatest
    width at which none holds more than ``most_places`` places, each further one is sixteen times as wide. A span takes
    whole blocks from its middle, as wide as fit, and places from the block at each end. So it has at most
    2 * ``most_places`` parts and 30 for each level up to its own length, however many points and spans lie there.
    """
    keys = keys or []
    require_columns(points, *keys, at)
    require_columns(spans, *keys, start, end)
    if totals is not None:
        return _join_totals(points, spans, at, start, end, keys, totals, most_places)
    clash = sorted((set(points.columns) & set(spans.columns)) - set(keys))
    if clash:
        raise ValueError(f"both sides have columns {clash}")
    leveled = span_levels(spans, start, end)
    levels = [r[0] for r in leveled.select("span_level").distinct().collect()]
    binned = leveled.withColumn("span_bin", F.explode(F.sequence(_bin("span_low"), _bin("span_high"))))
    placed = points.withColumn("span_at", _micros(points, at)).filter(F.col("span_at").isNotNull())
    placed = placed.withColumn("span_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    placed = placed.withColumn("span_bin", _bin("span_at"))
    met = placed.join(binned, [*keys, "span_level", "span_bin"])
    held = met.filter((F.col("span_at") >= F.col("span_low")) & (F.col("span_at") <= F.col("span_high")))
    return held.select(*points.columns, *[F.col(c) for c in spans.columns if c not in keys])


def _block(place: str, level: Column, known: Column | None = None) -> Column:
    """The block at a level of a whole number, or of its block at the level ``known``; above the last level there is one."""
    bits = (level if known is None else level - known) * BLOCK_BITS
    shifted = F.call_function("shiftright", F.col(place), bits)
    return F.when(level * BLOCK_BITS < 64, shifted).otherwise(F.lit(0).cast("bigint"))


def _join_totals(
    points: DataFrame, spans: DataFrame, at: str, start: str, end: str, keys: list[str], totals: dict[str, tuple[str, str]], most: int
) -> DataFrame:
    unknown = sorted({kind for kind, _ in totals.values()} - set(_PARTS))
    if unknown:
        raise ValueError(f"totals are {sorted(_PARTS)}, not {unknown}")
    if clash := sorted(set(totals) & {*spans.columns, *keys}):
        raise ValueError(f"both spans and totals have columns {clash}")
    require_columns(points, *[c for _, c in totals.values() if c != "*"])
    ends = spans.withColumns({"span_low": _micros(spans, start), "span_high": _micros(spans, end)})
    ends = ends.filter(F.col("span_low") <= F.col("span_high"))
    # The highest level at which the ends lie in different blocks of one block above; -1 when they are one place.
    bits = F.length(F.bin(F.col("span_low").bitwiseXOR(F.col("span_high"))))
    same = F.col("span_low") == F.col("span_high")
    ends = ends.withColumn("span_top", F.when(same, F.lit(-1)).otherwise(F.floor((bits - 1) / F.lit(BLOCK_BITS)).cast("int")))
    top = ends.agg(F.max("span_top")).first()[0]
    parts = [_PARTS[kind](F.lit(1) if c == "*" else F.col(f"`{c}`")).alias(name) for name, (kind, c) in totals.items()]
    merged = [_MERGED[kind](f"`{name}`").alias(name) for name, (kind, _) in totals.items()]
    placed = points.withColumn("span_place", _micros(points, at))
    for c in [*keys, "span_place"]:
        placed = placed.filter(F.col(c).isNotNull())
    places = placed.groupBy(*keys, "span_place").agg(*parts)
    lowest = 0 if top is None else _lowest_level(places, keys, top + 1, most)

    # Children of one block: places of the lowest blocks are a level below them, above that blocks of the level below.
    low, below, level = F.lit(lowest), F.lit(lowest - 1), F.col("span_level")
    blocks = places.groupBy(*keys, _block("span_place", low).alias("span_block")).agg(*merged)
    levels = [F.lit(k) for k in range(lowest, (top or 0) + 1)]
    blocks = blocks.withColumn("span_level", F.explode(F.array(*levels).cast("array<int>")))
    blocks = blocks.withColumn("span_place", _block("span_block", level, low))
    blocks = blocks.groupBy(*keys, "span_level", "span_place").agg(*merged)
    children = blocks.withColumn("span_parent", _block("span_place", level + 1, level)).unionByName(
        places.withColumns({"span_level": below, "span_parent": _block("span_place", low)})
    )

    # A span is cut into runs of children: at its top level those between its ends, below it those up to the block's end
    # behind its low end (side 0) and from the block's begin to its high end (side 1). Ends count as places only.
    runs = ends.withColumn("span_level", F.explode(F.sequence(below, F.greatest("span_top", below))))
    between = level >= F.greatest("span_top", below)
    runs = runs.withColumn("span_side", F.explode(F.when(between, F.array(F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))))
    side = F.col("span_side")
    first = F.when(level < low, F.col("span_low")).otherwise(_block("span_low", level) + 1)
    last = F.when(level < low, F.col("span_high")).otherwise(_block("span_high", level) - 1)
    parent = F.when(side == 1, _block("span_high", level + 1)).otherwise(_block("span_low", level + 1))
    runs = runs.withColumns({"span_parent": parent, "span_first": F.when(side != 1, first), "span_last": F.when(side != 0, last)})
    met = runs.join(children, [*keys, "span_level", "span_parent"])
    held = met.filter(
        F.coalesce(F.col("span_place") >= F.col("span_first"), F.lit(True))
        & F.coalesce(F.col("span_place") <= F.col("span_last"), F.lit(True))
    )
    return held.select(*spans.columns, *totals)


def _lowest_level(places: DataFrame, keys: list[str], highest: int, most: int) -> int:
    """The highest level, ``highest`` at most, whose blocks hold ``most`` different places each at most; 0 holds one."""
    lows, highs, n = F.min("span_place"), F.max("span_place"), F.count(F.lit(1))
    extents = places.groupBy(*keys).agg(lows.alias("low"), highs.alias("high"), n.alias("n"))
    blocks = [_block("high", F.lit(k)).cast("double") - _block("low", F.lit(k)).cast("double") + 1 for k in range(highest + 1)]
    means = extents.agg(*[F.max(F.col("n") / b) for b in blocks]).first()
    # A block with more than most places is sure to be there if the mean is above, or if a block above holds more than
    # its blocks could; levels that may do get their blocks counted, widest first.
    level = max((k for k in range(highest + 1) if means[k] is None or means[k] <= most), default=0)
    while level > 0 and means[level] is not None:
        counts = places.groupBy(*keys, _block("span_place", F.lit(level)).alias("span_block")).agg(n.alias("n"))
        fullest = counts.agg(F.max("n")).first()[0]
        if fullest <= most:
            break
        while level > 0 and fullest > most:
            level, fullest = level - 1, fullest / (1 << BLOCK_BITS)
    return level
