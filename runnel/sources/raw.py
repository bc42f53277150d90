"""Raw zone: JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.schemas import CORRUPT_COL, RAW_DDL, UNKNOWN_COL, column_names

READ_DDL = f"{RAW_DDL}, {CORRUPT_COL} STRING"
#: An object of fields that each keep their own type.
TYPED, TEXTS = "map<string,variant>", "map<string,string>"
#: Types that hold whole numbers; a fraction does not fit them.
WHOLE = ("tinyint", "smallint", "int", "bigint")


def read_raw_logs(spark: SparkSession, path: str, ddl: str = READ_DDL) -> DataFrame:
    """Reads JSON lines with a fixed schema, so without an inference pass.

    A broken line stays as a row of nulls with its text in ``_corrupt_record``.
    """
    return (
        spark.read.schema(ddl)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COL)
        .json(path)
    )


def parse_raw_lines(lines: DataFrame, ddl: str = READ_DDL) -> DataFrame:
    """The events of text lines (column ``value``), also with fields that ``ddl`` lacks.

    Those are kept as one JSON object in ``_unknown_fields``, each with its own type; null if
    there are none. (Where an object inside repeats a key, the values are kept as texts.)
    Only lines with an unknown name, or whose names cannot be told, are read as such an object.
    Other columns of ``lines`` stay behind them. Blank lines are passed over.
    """
    line = F.col("value")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    known = column_names(ddl)

    def unknown(kind: str) -> Column:
        fields = F.from_json(line, kind, {"mode": "PERMISSIVE"})
        return F.to_json(F.map_filter(fields, lambda name, _: ~name.isin(known)))

    others = [c for c in lines.columns if c != "value"]
    odd = F.coalesce(F.exists(F.json_object_keys(line), lambda name: ~name.isin(known)), F.lit(True))
    rest = F.nullif(F.coalesce(unknown(TYPED), unknown(TEXTS)), F.lit("{}"))
    event = F.from_json(line, ddl.replace(" NOT NULL", ""), options)
    return (
        lines.where(F.trim(line) != "")
        .select(
            event.alias("event"),
            F.when(odd, rest).alias(UNKNOWN_COL),
            *others,
        )
        .select("event.*", UNKNOWN_COL, *others)
    )


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_raw_logs`, with unknown fields kept and the file's path."""
    lines = spark.read.text(path, recursiveFileLookup=True)
    return parse_raw_lines(lines.select("value", F.col("_metadata.file_path").alias("_source_file")))


def unknown_fields(events: DataFrame) -> DataFrame:
    """``column, kind, non_null``: the unknown fields, the type that holds all their values,
    and how many events have a value in them.

    Nested types are written out, as ``OBJECT<n: BIGINT>``; a field with values of several
    kinds is a ``VARIANT``, one with nulls alone is ``VOID``.
    """
    found = events.where(F.col(UNKNOWN_COL).isNotNull()).select(
        F.explode(F.from_json(UNKNOWN_COL, TYPED)).alias("column", "value")
    )
    return found.groupBy("column").agg(
        F.schema_of_variant_agg("value").alias("kind"),
        F.count_if(~F.is_variant_null("value")).alias("non_null"),
    )


def _shown(value: Column, typed: Column, kind: str) -> Column:
    """Whether ``typed`` holds all of the variant ``value``."""
    if kind in WHOLE:
        return F.try_variant_get(value, "$", "decimal(38,9)") == typed
    if "<" in kind:
        return F.to_json(value) == F.to_json(typed)
    return typed.isNotNull()


def promote_fields(events: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Events with a column for each of the named unknown fields, of the given type.

    What the column shows leaves ``_unknown_fields``. A value that does not fit stays there
    and the column is null: text for a number, a fraction for a whole number, a nested value
    that the type would cut or change. A field that an event lacks is null.
    """
    fields = F.from_json(UNKNOWN_COL, TYPED)
    kinds = {name: kind.strip().lower() if "<" not in kind else kind for name, kind in kinds.items()}
    taken = sorted(set(kinds) & set(events.columns))
    if taken:
        raise ValueError(f"columns of that name are there: {taken}")
    made, moved = {}, F.array().cast("array<string>")
    for name, kind in kinds.items():
        value = F.try_element_at(fields, F.lit(name))
        typed = F.try_variant_get(value, "$", kind)
        fits = F.coalesce(_shown(value, typed, kind), F.lit(False))
        made[name] = F.when(fits, typed)
        gone = fits | F.coalesce(F.is_variant_null(value), F.lit(False))
        moved = F.concat(moved, F.when(gone, F.array(F.lit(name))).otherwise(F.array().cast("array<string>")))
    rest = F.to_json(F.map_filter(fields, lambda name, _: ~F.array_contains(moved, name)))
    return events.withColumns({**made, UNKNOWN_COL: F.nullif(rest, F.lit("{}"))})


def register_raw_logs(spark: SparkSession, path: str, view: str) -> None:
    """Declares the same files as a temporary SQL view."""
    quoted = path.replace("'", "\\'")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {view} ({RAW_DDL.replace(' NOT NULL', '')}) USING json "
        f"OPTIONS (path '{quoted}', multiLine 'false', mode 'PERMISSIVE')"
    )


def land_raw_logs(df: DataFrame, path: str, at: Column) -> None:
    """Appends events as JSON lines to ``year=/month=/day=`` folders of the landing time."""
    parts = {
        "year": F.date_format(at, "yyyy"),
        "month": F.date_format(at, "MM"),
        "day": F.date_format(at, "dd"),
    }
    df.withColumns(parts).write.mode("append").partitionBy(*parts).json(path)
