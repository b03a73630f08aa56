"""Nested documents: one per street or city block."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from addrspark.functions import text
from addrspark.functions.once import evaluate_once
from addrspark.functions.shapes import centroid
from addrspark.functions.wkb import decoded
from addrspark.operators.checks import pick_column, require_columns
from addrspark.operators.dedup import last_wins, unique_doors
from addrspark.schemas import DOCUMENT_SCALARS

def collect_items(
    rows: DataFrame, keys: list[str], item: Column, alias: str, max_items: int | None = None
) -> DataFrame:
    """One row per key with the sorted array of its items (none of them null); ``part`` is 0.

    With ``max_items`` an array is cut into consecutive runs of that length, numbered by ``part`` from 0,
    by the same rule for every key. Items are numbered before they are collected, by a window that spills, so
    no array grows beyond the limit on the way.
    """
    items = rows.select(*keys, item.alias("item"))
    collected = F.sort_array(F.collect_list("item")).alias(alias)
    if max_items is None:
        return items.groupBy(*keys).agg(collected).withColumn("part", F.lit(0).cast("bigint"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("item")) - 1
    numbered = items.withColumn("part", F.floor(place / F.lit(max_items)))
    return numbered.groupBy(*keys, "part").agg(collected).select(*keys, alias, "part")


def house(number: Column, lon: Column, lat: Column) -> Column:
    """``{number, location: {lon, lat}}``"""
    return F.struct(
        number.cast("string").alias("number"),
        F.struct(lon.alias("lon"), lat.alias("lat")).alias("location"),
    )


def with_district(
    documents: DataFrame, districts: DataFrame, how: str, context: bool, key: str = "postcode"
) -> DataFrame:
    """Add district names by postcode. The documents are already grouped, so only they are probed.

    How the two sides meet is left to adaptive execution.
    """
    names = ["cod_departament", "cod_province", "cod_district"] + (["context"] if context else [])
    right = districts.select(F.col("postcode").alias(key), *names)
    return documents.join(right, key, how)


def _document(documents: DataFrame, **overrides: Column) -> DataFrame:
    shaped = documents.withColumns({**overrides, "type": F.lit("street")})
    return shaped.select(*DOCUMENT_SCALARS, "housenumbers", "part")


def street_documents(
    doors: DataFrame, districts: DataFrame, max_items: int | None = None
) -> DataFrame:
    """Deduplicated doors nested by street; streets with an unknown district keep null names.

    ``districts`` holds one row per postcode (see ``district_dimension``).
    """
    unique = unique_doors(doors)
    grouped = collect_items(
        unique,
        ["id_via", "name", "postcode"],
        house(text.number_text(unique, "numpuerta"), F.col("lon"), F.col("lat")),
        "housenumbers",
        max_items,
    )
    return _document(with_district(grouped, districts, "left", context=True))


def door_maps(doors: DataFrame, max_items: int | None = None) -> DataFrame:
    """Door number to location map per street (doors without a number have no map key)."""
    unique = unique_doors(doors).dropna(subset=["numpuerta"])
    entry = F.struct(
        text.number_text(unique, "numpuerta").alias("key"),
        F.struct("lon", "lat").alias("value"),
    )
    grouped = collect_items(
        unique, ["id_via", "name", "postcode"], entry, "entries", max_items
    )
    return grouped.select(
        "id_via", "name", "postcode", F.map_from_entries("entries").alias("housenumbers"), "part"
    )


def block_documents(
    lots: DataFrame,
    districts: DataFrame,
    block: str = "manzana",
    lot: str = "lote",
    estate: str = "nombre_urbanizacion",
    estate_id: str = "id_urb",
    max_items: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Lots with coordinates nested by block: (documents, rejects).

    Blank block or lot names are dropped, null ones are not blank. A null grouping value or an unknown
    district drops the row, as grouping on such keys does; those rows are the rejects.
    """
    require_columns(lots, block, lot, estate, estate_id, "postcode", "lon", "lat")
    named = lots.filter(text.not_blank(F.col(block)) & text.not_blank(F.col(lot)))
    keys = [estate, block, estate_id, "postcode"]
    grouped = collect_items(
        named.dropna(subset=keys), keys, house(F.col(lot), F.col("lon"), F.col("lat")), "housenumbers", max_items
    )
    complete = _complete(districts)
    documents = _document(
        with_district(grouped, complete, "inner", context=False),
        id_via=text.digits_id(F.col(estate_id)),
        name=F.col(estate),
        context=F.col(block),
    )
    return documents, _block_rejects(named, complete, keys)


def shape_block_documents(
    lots: DataFrame,
    districts: DataFrame,
    block: str = "name_manzana",
    lot: str = "name_lote",
    estate: str = "name_urb",
    postcode: str = "postcode",
    max_items: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Lots with a shape nested by block, each lot placed at its centroid: (documents, rejects).

    The shape column is ``geometry`` or ``geom``, WKB or already decoded; null bytes place nowhere. Rows
    with a postcode that is no number and rows whose bytes are no shape are rejected.
    """
    require_columns(lots, block, lot, postcode)
    shape = pick_column(lots, "geometry", "geom")
    named = lots.filter(text.not_blank(F.col(block)) & text.not_blank(F.col(lot)))
    code = text.strip(F.col(postcode).cast("string"))
    tried = evaluate_once(named, {"decoded_shape": decoded(named, shape)})
    broken = F.col("decoded_shape").isNull() & F.col(shape).isNotNull()
    placed = (
        tried.filter(~broken)
        .withColumn("center", centroid("decoded_shape"))
        .withColumn("postcode_number", code.try_cast("bigint"))
        .withColumns({"lon": F.col("center.x"), "lat": F.col("center.y")})
        .drop("center", "decoded_shape", shape)
    )
    keys = [estate, block, postcode, "postcode_number"]
    grouped = collect_items(
        placed.dropna(subset=keys), keys, house(F.col(lot), F.col("lon"), F.col("lat")), "housenumbers", max_items
    )
    complete = _complete(districts)
    documents = _document(
        with_district(grouped, complete, "inner", context=False, key="postcode_number"),
        id_via=F.lit(None).cast("bigint"),
        name=F.col(estate),
        postcode=F.col("postcode_number"),
        context=F.col(block),
    )
    numbered = tried.withColumn("postcode_number", code.try_cast("bigint"))
    no_shape = numbered.filter(broken).withColumn("reason", F.lit("no valid WKB")).drop(shape, "decoded_shape")
    rejects = _block_rejects(numbered.filter(~broken).drop(shape, "decoded_shape"), complete, keys, key="postcode_number")
    return documents, rejects.unionByName(no_shape)


def _complete(districts: DataFrame) -> DataFrame:
    """Districts usable as block keys: grouping drops null names."""
    return districts.dropna(subset=["cod_departament", "cod_province", "cod_district"])


def _block_rejects(
    named: DataFrame, districts: DataFrame, keys: list[str], key: str = "postcode"
) -> DataFrame:
    known = districts.select(F.col("postcode").alias(key), F.lit(True).alias("known"))
    missing = F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in keys])
    reason = (
        F.when(missing != "", F.concat(F.lit("null in "), missing))
        .when(F.col("known").isNull(), F.lit("unknown district"))
    )
    return (
        named.join(known, key, "left")
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select(*named.columns, "reason")
    )


def district_dimension(sheet: DataFrame, order: str | None = None) -> DataFrame:
    """The district sheet renamed to document terms, one row per postcode.

    Files have no row order in Spark: where a postcode repeats, the row with the highest ``order``
    wins, or without one the last in column order.
    """
    # The sheet's column names and the documents' own.
    renamed = sheet.withColumnsRenamed(
        {
            "ubigeo": "postcode",
            "NOMBDEP": "cod_departament",
            "NOMBPROV": "cod_province",
            "NOMBDIST": "cod_district",
            "REGION NATURAL": "context",
        }
    )
    wanted = ["postcode", "cod_departament", "cod_province", "cod_district", "context"]
    if order:
        return last_wins(renamed.select(*wanted, order), ["postcode"], order).drop(order)
    ranked = renamed.select(*wanted).withColumn("rank_key", F.struct(*wanted[1:]))
    return last_wins(ranked, ["postcode"], "rank_key").drop("rank_key")


def sorted_names(
    df: DataFrame, group: str, name: str, group_alias: str, names_alias: str, max_items: int | None = None
) -> DataFrame:
    """Sorted distinct names per group, without blanks around them and without accents.

    A row with any null is dropped first. Every column is stripped, so a text of blanks only becomes
    ``""`` and stays. Repeated names collapse map-side before accents are looked at.
    """
    # The optimizer would drop the first of two distincts; the generator between them keeps it.
    raw = df.dropna("any").select(F.col(group).alias("raw_group"), F.col(name).alias("raw_name")).distinct()
    clean = evaluate_once(
        raw,
        {
            group_alias: text.remove_accents(text.strip(F.col("raw_group"))),
            "name": text.remove_accents(text.strip(F.col("raw_name"))),
        },
    ).select(group_alias, "name")
    return collect_items(clean.distinct(), [group_alias], F.col("name"), names_alias, max_items)


def flatten_documents(documents: DataFrame) -> DataFrame:
    """One row per house number with the document's scalars; documents without houses give none."""
    scalars = [c for c in DOCUMENT_SCALARS if c in documents.columns]
    return documents.select(*scalars, F.explode("housenumbers").alias("house")).select(
        *scalars,
        F.col("house.number").alias("number"),
        F.col("house.location.lon").alias("lon"),
        F.col("house.location.lat").alias("lat"),
    )


def placed_points(points: DataFrame, need_number: bool = False) -> tuple[DataFrame, DataFrame]:
    """(points, rejects): a house without coordinates cannot become a point."""
    usable = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    if need_number:
        usable = usable & F.col("number").isNotNull()
    return points.filter(usable), points.filter(~usable)
