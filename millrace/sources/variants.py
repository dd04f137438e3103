"""Manifests whose rows have any fields (SC1, PF2, PF3, SF18): VARIANT values tell a field that is null from one that is not there.

An alias chain takes the first field that a row has, even if it is null; what a null counts as is the caller's: nothing, or the text
that a null prints as.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import non_blank, padded_id

#: How null and the truth values print.
NONE, TRUE, FALSE = "None", "True", "False"


def read_variants(spark: SparkSession, paths: list[str], column: str = "v") -> DataFrame:
    """_file (its number among the paths), and one VARIANT for each line of JSON lines; blank lines are skipped, and a line that is no
    object fails."""
    found = None
    for k, path in enumerate(paths):
        lines = spark.read.text(path).where(F.trim("value") != "").select(F.lit(k).alias("_file"), F.parse_json("value").alias(column))
        found = lines if found is None else found.unionByName(lines)
    if found is None:
        raise ValueError("a path is needed")
    is_object = F.schema_of_variant(F.col(column)).startswith("OBJECT")
    return found.where(is_object | F.raise_error(F.lit("a line is no object")).cast("boolean"))


def field(v: Column, key: str) -> Column:
    """A field as VARIANT: SQL's null if it is not there, VARIANT's if it is null."""
    quote = '"' if "'" in key else "'"
    if quote in key:
        raise ValueError("a name cannot have both kinds of quotes")
    return F.variant_get(v, f"$[{quote}{key}{quote}]", "variant")


def has(v: Column, key: str) -> Column:
    return field(v, key).isNotNull()


def printed(value: Column, none: str | None = NONE) -> Column:
    """The text of a value: null counts as `none`, truth values print with capitals; SQL's null where there is no value."""
    text = F.variant_get(value, "$", "string")
    kind = F.schema_of_variant(value)
    return F.when(value.isNull(), None).when(F.is_variant_null(value), F.lit(none)).when(kind == "BOOLEAN", F.when(text == "true", TRUE).otherwise(FALSE)).otherwise(text)


def first_field(v: Column, *keys: str) -> Column:
    """PF2, PF3: the first field of a chain that a row has, null or not."""
    return F.coalesce(*(field(v, k) for k in keys))


def filter_rows(rows: DataFrame, order: str, none: str | None = None, column: str = "v") -> DataFrame:
    """PF2, PF3: sample_id, image_path, raw of each row, by the chains of the filters; rows without an id get one by their place in `order`,
    which numbers them from 0. none: what an explicit null counts as (None: as a field that is not there)."""
    v = F.col(column)
    if none is None:
        path = F.coalesce(*(non_blank(printed(field(v, k), None)) for k in ("image_path", "imagepath", "path")))
    else:
        path = non_blank(printed(first_field(v, "image_path", "imagepath", "path"), none))
    own = non_blank(printed(field(v, "sample_id"), none))
    path = F.coalesce(path, F.raise_error(F.lit("a row has no image path")).cast("string"))
    return rows.select(F.coalesce(own, padded_id("row_", F.col(order), 7)).alias("sample_id"), path.alias("image_path"), v.alias("raw"))


def merged_schema(rows: DataFrame, column: str = "v") -> str:
    """The schema that all rows fit, as text: types that differ become VARIANT; one value, found by a tree of tasks."""
    return rows.agg(F.schema_of_variant_agg(F.col(column))).first()[0]


def as_object(fields: Column) -> Column:
    """A map of VARIANTs as one VARIANT."""
    return F.to_variant_object(fields)


def as_variant(c: Column) -> Column:
    """A column as VARIANT; null as VARIANT's null."""
    return F.variant_get(F.parse_json(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"})), "$.v", "variant")


def fields_of(v: Column) -> Column:
    """An object's fields as a map; an empty one where there is no object."""
    return F.coalesce(v.cast("map<string,variant>"), F.create_map().cast("map<string,variant>"))


def with_fields(fields: Column, changes: dict[str, Column]) -> Column:
    """A map of VARIANTs with some of them set."""
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*changes))
    return F.map_concat(kept, F.create_map(*(x for k, c in changes.items() for x in (F.lit(k), c))))


def with_nested(v: Column, changes: dict[tuple[str, str, str], Column]) -> Column:
    """An object with fields (outer, middle, inner) set to columns; objects that are not there are made. SQL's null stays."""
    outer = fields_of(v)
    wanted: dict[str, dict[str, dict[str, Column]]] = {}
    for (a, b, c), value in changes.items():
        wanted.setdefault(a, {}).setdefault(b, {})[c] = as_variant(value)
    made = {}
    for a, middle in wanted.items():
        node = fields_of(F.try_element_at(outer, F.lit(a)))
        made[a] = as_object(with_fields(node, {b: as_object(with_fields(fields_of(F.try_element_at(node, F.lit(b))), inner)) for b, inner in middle.items()}))
    return F.when(v.isNotNull(), as_object(with_fields(outer, made)))
