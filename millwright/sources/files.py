"""CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millwright.operators.quality import validate

# --- fixed values: cells that mean NULL in the producers' files -----------------------------------
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
# --- end of fixed values -------------------------------------------------------------------------


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    null_texts: tuple[str, ...] = NULL_TEXTS,
) -> DataFrame:
    """CSV with a header. Cells equal to one of ``null_texts`` are NULL, in columns of any type: leave out "None" to keep
    a category of that name. With ``schema``, whose names must be the header's, the file is read once; without, types
    come from one more pass over the cells (``inferred``)."""
    reader = spark.read.options(header=True, nullValue="", enforceSchema=False)
    if schema:
        return _without(reader.schema(schema).csv(path), null_texts)
    cells = _without(reader.option("inferSchema", False).csv(path), null_texts)
    return cells.select(*[_as_type(f).alias(f.name) for f in inferred(cells).fields])


def read_csv_checked(
    spark: SparkSession, path: str, contract: T.StructType, null_texts: tuple[str, ...] = NULL_TEXTS
) -> DataFrame:
    """CSV with a header, its columns named as in ``contract``, in the contract's types, with ``reasons``: which cells don't
    fit, as for messages (``quality.validate``), and empty for a good row. No cell that doesn't fit becomes NULL without
    a trace: ``quality.accepted`` and ``quality.quarantined`` part the rows. Other columns of the file are kept as text;
    ``file`` names the row's file."""
    cells = spark.read.options(header=True, nullValue="", enforceSchema=False, inferSchema=False).csv(path)
    names = cells.columns
    rows = _without(cells.select(*[F.col(_quoted(n)) for n in names]), null_texts)
    return validate(rows.withColumn("file", F.input_file_name()), contract)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _without(rows: DataFrame, null_texts: tuple[str, ...]) -> DataFrame:
    wanted = [t for t in null_texts if t]
    return rows.select(*[
        F.when(~cell.isin(*wanted), cell).alias(f.name)
        if wanted and isinstance(f.dataType, T.StringType) else cell
        for f in rows.schema.fields
        for cell in [F.col(_quoted(f.name))]
    ])


_WHOLE, _DECIMAL = r"^[+-]?\d{1,18}$", r"^[+-]?\d+\.\d+$"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,9})?(Z|[+-]\d{2}:\d{2})?$"


def inferred(cells: DataFrame) -> T.StructType:
    """The narrowest type that holds every non-NULL cell of each text column: BOOLEAN, BIGINT, DECIMAL of up to 18 digits,
    DOUBLE, TIMESTAMP, else STRING (also where all cells are NULL). Each cell is looked at once; one row per column and
    kind of cell is counted."""
    cell = F.col("cell")
    digits = F.regexp_replace(cell, "^[+-]", "")
    long = cells.select(F.posexplode(F.array(*[F.col(_quoted(n)) for n in cells.columns])).alias("i", "cell"))
    kind = (
        F.when(F.lower(cell).isin("true", "false"), "boolean")
        .when(cell.rlike(_WHOLE), "whole")
        .when(cell.rlike(_DECIMAL), "decimal")
        .when(cell.rlike(_NUMBER), "number")
        .when(cell.rlike(_TIME), F.when(cell.try_cast("timestamp").isNotNull(), "time").otherwise("text"))
        .otherwise("text")
    )
    seen = long.where(cell.isNotNull()).select(
        "i", kind.alias("kind"), F.length(F.substring_index(digits, ".", 1)).alias("left"),
        F.length(F.substring_index(digits, ".", -1)).alias("right"),
    ).groupBy("i", "kind").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    found: dict[int, dict[str, tuple[int, int]]] = {}
    for row in seen.collect():  # at most six kinds per column
        found.setdefault(row["i"], {})[row["kind"]] = (row["left"], row["right"])

    def type_of(kinds: dict[str, tuple[int, int]]) -> T.DataType:
        if kinds.keys() == {"boolean"}:
            return T.BooleanType()
        if kinds.keys() == {"whole"}:
            return T.LongType()
        if kinds.keys() == {"time"}:
            return T.TimestampType()
        if kinds.keys() and kinds.keys() <= {"whole", "decimal"}:
            left, right = max(k[0] for k in kinds.values()), kinds["decimal"][1]
            return T.DecimalType(left + right, right) if left + right <= 18 else T.DoubleType()
        return T.DoubleType() if kinds and kinds.keys() <= {"whole", "decimal", "number"} else T.StringType()

    return T.StructType([T.StructField(n, type_of(found.get(i, {}))) for i, n in enumerate(cells.columns)])


def _as_type(field: T.StructField):
    cell = F.col(_quoted(field.name))
    return cell if isinstance(field.dataType, T.StringType) else cell.try_cast(field.dataType)


def read_tagged(
    spark: SparkSession,
    files: dict[tuple[bool, bool], str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """One file or folder per (is_anomalous, is_optimised) cell, read with the cell's flags and
    united by column name. Every file is scanned once."""
    return tagged_union({cell: read_csv(spark, path, schema) for cell, path in files.items()})


def tagged_union(cells: dict[tuple[bool, bool], DataFrame]) -> DataFrame:
    tagged = [
        rows.withColumns({
            "is_anomalous": F.lit(is_anomalous), "is_optimised": F.lit(is_optimised),
        })
        for (is_anomalous, is_optimised), rows in cells.items()
    ]
    united = tagged[0]
    for rows in tagged[1:]:
        united = united.unionByName(rows)
    return united
