"""Explicit schemas of the inputs and of the indexed document."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


DOORS = _struct(
    ("id_via", T.LongType()),
    ("numpuerta", T.LongType()),
    ("tipo_via", T.StringType()),
    ("nom_via", T.StringType()),
    ("ubigeo", T.LongType()),
    ("lon_x", T.DoubleType()),
    ("lat_y", T.DoubleType()),
)

# `lote` and `id_urb` are text: inference would turn all-numeric columns into integers.
LOTS = _struct(
    ("manzana", T.StringType()),
    ("lote", T.StringType()),
    ("nombre_urbanizacion", T.StringType()),
    ("id_urb", T.StringType()),
    ("postcode", T.LongType()),
    ("lon", T.DoubleType()),
    ("lat", T.DoubleType()),
)

LOTS_WITH_SHAPE = _struct(
    ("name_manzana", T.StringType()),
    ("name_lote", T.StringType()),
    ("name_urb", T.StringType()),
    ("postcode", T.StringType()),
    ("geometry", T.BinaryType()),
)

DISTRICT_SHEET = _struct(
    ("ubigeo", T.LongType()),
    ("NOMBDEP", T.StringType()),
    ("NOMBPROV", T.StringType()),
    ("NOMBDIST", T.StringType()),
    ("REGION NATURAL", T.StringType()),
)

DISTRICTS = _struct(
    ("postcode", T.LongType()),
    ("cod_departament", T.StringType()),
    ("cod_province", T.StringType()),
    ("cod_district", T.StringType()),
    ("context", T.StringType()),
)

LOCATION = _struct(("lon", T.DoubleType()), ("lat", T.DoubleType()))
HOUSENUMBER = _struct(("number", T.StringType()), ("location", LOCATION))

DOCUMENT = _struct(
    ("id_via", T.LongType()),
    ("name", T.StringType()),
    ("postcode", T.LongType()),
    ("cod_departament", T.StringType()),
    ("cod_province", T.StringType()),
    ("cod_district", T.StringType()),
    ("context", T.StringType()),
    ("type", T.StringType()),
    ("housenumbers", T.ArrayType(HOUSENUMBER)),
)

DOCUMENT_FIELDS = DOCUMENT.fieldNames()
DOCUMENT_SCALARS = [name for name in DOCUMENT_FIELDS if name != "housenumbers"]

VERTEX = _struct(("x", T.DoubleType()), ("y", T.DoubleType()))
RING = T.ArrayType(VERTEX)
PARTS = T.ArrayType(T.ArrayType(RING))
SHAPE = _struct(("kind", T.StringType()), ("parts", PARTS))

_MAPPED_TYPES = {
    "long": T.LongType(),
    "integer": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "text": T.StringType(),
    "keyword": T.StringType(),
}


def keyword_text(limit: int = 256) -> dict:
    """A text field with an exact-match sub-field for values of up to ``limit`` characters."""
    return {"type": "text", "fields": {"keyword": {"type": "keyword", "ignore_above": limit}}}


# Field names and types of the target index.
INDEX_MAPPING = {
    "mappings": {
        "properties": {
            "id_via": {"type": "long"},
            "name": keyword_text(),
            "postcode": {"type": "long"},
            "cod_departament": keyword_text(),
            "cod_province": keyword_text(),
            "cod_district": keyword_text(),
            "context": keyword_text(),
            "type": keyword_text(),
            "housenumbers": {
                "type": "nested",
                "properties": {
                    "number": keyword_text(),
                    "location": {"properties": {"lon": {"type": "float"}, "lat": {"type": "float"}}},
                },
            },
        }
    }
}


def schema_from_mapping(mapping: dict) -> T.StructType:
    """The StructType an index mapping (a parsed JSON object) describes."""
    body = mapping.get("mappings", mapping)
    fields = []
    for name, spec in body["properties"].items():
        kind = spec.get("type", "object")
        if kind == "nested":
            column = T.ArrayType(schema_from_mapping(spec))
        elif kind == "object":
            column = schema_from_mapping(spec)
        elif kind in _MAPPED_TYPES:
            column = _MAPPED_TYPES[kind]
        else:
            raise ValueError(f"field {name!r}: mapping type {kind!r} is not supported")
        fields.append(T.StructField(name, column, True))
    return T.StructType(fields)


def keyword_limits(mapping: dict) -> dict[str, int]:
    """Text fields that carry an exact-match sub-field, with its length limit; nested ones as ``outer.inner``."""
    body = mapping.get("mappings", mapping)
    limits = {}
    for name, spec in body["properties"].items():
        keyword = spec.get("fields", {}).get("keyword")
        if keyword:
            limits[name] = keyword.get("ignore_above", 2**31 - 1)
        if "properties" in spec:
            limits |= {f"{name}.{inner}": limit for inner, limit in keyword_limits(spec).items()}
    return limits
