"""Records whose schema drifts: JSON kept as variants, one schema merged over all of them, typed columns, and what doesn't fit kept apart with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Reasons for which a record is kept apart.
NO_JSON, NO_OBJECT, MISSING, OTHER_TYPE = "not JSON", "not an object", "missing: ", "not a "


def as_variants(rows: DataFrame, column: str, name: str = "record") -> DataFrame:
    """rows with their JSON as a variant: null where it isn't JSON."""
    return rows.withColumn(name, F.try_parse_json(column))


def merged_schema(rows: DataFrame, record: str = "record") -> DataFrame:
    """field, type: the fields of all records and their common types, by one aggregate with partial results; VARIANT where records have types that have none in common."""
    return rows.agg(F.schema_of_variant_agg(record).alias("schema"))


def typed(rows: DataFrame, column: str, fields: Mapping[str, str], required: Sequence[str] = (), record: str = "record") -> DataFrame:
    """rows with a column for each field, cast to its type, and the reason for which a record doesn't fit, null if it does.

    A field may be of another type in older or newer records: what can be cast is cast. A record doesn't fit if its text is no JSON or no object, if a required field is missing or null, or if a
    field can't be cast; the first field in the order given is told. Null texts are no JSON. Fields that aren't asked for stay in the variant.
    """
    v = F.col(record)
    kind = F.schema_of_variant(v)
    reason = F.when(v.isNull(), NO_JSON).when(~kind.startswith("OBJECT"), NO_OBJECT)
    columns = {}
    for name, wanted in fields.items():
        path = f'$["{name}"]' if '"' not in name else f"$['{name}']"
        raw, value = F.try_variant_get(v, path, "variant"), F.try_variant_get(v, path, wanted)
        absent = raw.isNull() | F.is_variant_null(raw)
        if name in required:
            reason = reason.when(absent, MISSING + name)
        reason = reason.when(~absent & value.isNull(), f"{OTHER_TYPE}{wanted}: {name}")
        columns[name] = value
    return rows.withColumns(columns | {"reason": reason})


def parted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records that fit, and the others with their reasons."""
    return rows.where("reason is null").drop("reason"), rows.where("reason is not null")
