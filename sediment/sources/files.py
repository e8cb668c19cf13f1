"""File and object readers, and the layout of the staged tree."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.session import materialise

# The formats a source may have, and the folders of the staged tree.
FILE_TYPES = ("csv", "json", "parquet")
STAGED = "00_staged_files"
LOADED = "01_loaded_files"
ERRORED = "00_errored_files"


def check_file_type(file_type: str) -> str:
    if file_type not in FILE_TYPES:
        raise ValueError(f"Unsupported file_type '{file_type}'; expected one of {', '.join(FILE_TYPES)}")
    return file_type


# Quoting as in RFC 4180: quotes are doubled, spaces belong to the value.
CSV_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def format_options(file_type: str, lines: bool) -> dict[str, object]:
    """Reader options of a format; with ``lines`` no record spans lines, so files can be split."""
    options: dict[str, object] = {}
    if check_file_type(file_type) != "parquet":
        options["multiLine"] = not lines
    if file_type == "csv":
        options.update(CSV_OPTIONS)
    return options


# The column that holds the text of a record that does not fit its schema.
CORRUPT = "_corrupt_record"


def as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _by_header(
    spark: SparkSession, path: str | list[str], schema: T.StructType, options: dict[str, object]
) -> T.StructType:
    """The schema in the order of the csv header, which must have the same names."""
    header = spark.read.options(**options).csv(path).columns  # reads one line
    if sorted(header) != sorted(schema.names):
        raise ValueError(f"csv header {header} does not have the columns of the schema {schema.names}")
    return T.StructType([schema[name] for name in header])


def read_files(
    spark: SparkSession,
    path: str | list[str],
    file_type: str,
    schema: T.StructType | str | None = None,
    lines: bool = False,
    **options: object,
) -> DataFrame:
    """Read csv (with header), json or parquet.

    By default csv values may hold line breaks and a JSON document holds an array of
    records. With ``lines`` each line is one record, and a large file is read in parallel.
    Give a schema for csv and json: without one Spark reads the data an extra time. Under a
    schema csv columns are found by their names in the header, and a record that does not
    fit is an error; ``read_records`` sets such records aside.
    """
    options = {**format_options(file_type, lines), **options}
    if schema is None:
        options |= {"inferSchema": True} if file_type == "csv" else {}
        return spark.read.options(**options).format(file_type).load(path)
    if file_type == "parquet":
        return spark.read.options(**options).schema(schema).parquet(path)
    wanted = as_schema(schema)
    reader = spark.read.options(mode="FAILFAST", enforceSchema=False, **options)
    if file_type == "json":
        return reader.schema(wanted).json(path)
    return reader.schema(_by_header(spark, path, wanted, options)).csv(path).select(*[f"`{n}`" for n in wanted.names])


def read_records(
    spark: SparkSession,
    path: str | list[str],
    file_type: str,
    schema: T.StructType | str,
    lines: bool = False,
    **options: object,
) -> tuple[DataFrame, DataFrame]:
    """The records that fit the schema, and ``file_path`` and ``record`` text of the others.

    Each file is parsed once, into the shared folder, from where both are read. Parquet
    files have no such records.
    """
    wanted, options = as_schema(schema), {**format_options(file_type, lines), **options}
    if file_type == "parquet":
        rows = spark.read.options(**options).schema(wanted).parquet(path)
        return rows, spark.createDataFrame([], "file_path string, record string")
    ordered = _by_header(spark, path, wanted, options) if file_type == "csv" else wanted
    reader = spark.read.options(columnNameOfCorruptRecord=CORRUPT, enforceSchema=False, **options)
    rows = reader.schema(T.StructType([*ordered.fields, T.StructField(CORRUPT, T.StringType())])).format(file_type).load(path)
    parsed = materialise(rows.withColumn("file_path", F.col("_metadata.file_path")), "records")
    good = parsed.where(F.col(CORRUPT).isNull()).select(*[f"`{n}`" for n in wanted.names])
    return good, parsed.where(F.col(CORRUPT).isNotNull()).select("file_path", F.col(CORRUPT).alias("record"))


def object_path(root: str, bucket: str, key: str) -> str:
    """Path of an object; ``root`` is a scheme such as ``s3a://`` or a folder."""
    return f"{root}{'' if root.endswith('/') else '/'}{bucket}/{key.lstrip('/')}"


def read_object(
    spark: SparkSession,
    bucket: str,
    key: str,
    file_type: str,
    root: str = "s3a://",
    schema: T.StructType | str | None = None,
    lines: bool = False,
) -> DataFrame:
    """Read one object of a bucket; a missing object is Spark's path-not-found error."""
    return read_files(spark, object_path(root, bucket, key), file_type, schema, lines)


def staged_path(root: str, source: str, at: datetime, file_type: str, state: str = STAGED) -> str:
    day = f"{at.year}/{at.month:02d}/{at.day:02d}"
    stamp = at.strftime("%Y_%m_%d_%H_%M_%S")
    return f"{root.rstrip('/')}/{source}/{state}/{day}/{source}_{stamp}.{file_type}"


def with_staged_path(df: DataFrame, state: str = STAGED, path: str = "_metadata.file_path") -> DataFrame:
    """Add source, state and load time as the file's place in the staged tree tells them.

    The path is ``<source>/<state>/Y/M/D/<source>_Y_M_D_h_m_s.<ext>``, a landed file being
    a folder of parts. Plain cuts, not patterns: the path is looked at once per row.
    """
    file_path = F.col(path)
    source = F.substring_index(F.substring_index(file_path, f"/{state}/", 1), "/", -1)
    below = F.substring_index(file_path, f"/{state}/", -1)
    name = F.substring_index(F.substring_index(below, "/", 4), "/", -1)
    stamp = F.substring_index(F.substring_index(name, "_", -6), ".", 1)
    return df.withColumns(
        {
            "staged_source": source,
            "staged_state": F.lit(state),
            "staged_at": F.try_to_timestamp(stamp, F.lit("yyyy_M_d_H_m_s")).cast("timestamp_ntz"),
        }
    )


def read_staged(
    spark: SparkSession,
    root: str,
    source: str,
    file_type: str,
    schema: T.StructType | str | None = None,
    state: str = STAGED,
    lines: bool | None = None,
) -> DataFrame:
    """All files of a source in one state, with what their paths tell.

    As ``land`` writes them: JSON by lines, csv with line breaks inside values.
    """
    rows = read_files(
        spark, f"{root.rstrip('/')}/{source}/{state}", file_type, schema, by_lines(file_type, lines), recursiveFileLookup=True
    )
    return with_staged_path(rows, state)


def by_lines(file_type: str, lines: bool | None) -> bool:
    """Whether landed files of a type are read by lines, unless told."""
    return file_type == "json" if lines is None else lines


def staged_files(spark: SparkSession, root: str, source: str, file_type: str, state: str = STAGED) -> DataFrame:
    """The files of a source in one state: ``file``, ``length``, ``modified``, and the load they belong to.

    A load is named by ``staged_at`` and ``path``, its folder or file; both are null where
    a file's place or name does not tell a load of the source. Listing only; no file is read.
    """
    base = f"{root.rstrip('/')}/{source}/{state}"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base)
    listed = found.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    placed = with_staged_path(listed, state, "file")
    below = F.substring_index("file", f"/{state}/", -1)
    whole = F.concat(F.substring_index("file", f"/{state}/", 1), F.lit(f"/{state}/"), F.substring_index(below, "/", 4))
    name = F.substring_index(F.substring_index(below, "/", 4), "/", -1)
    # The day in the path must be that in the name, as ``land`` has it.
    day = F.concat_ws("/", F.date_format("staged_at", "yyyy/MM/dd"), name)
    fits = F.col("staged_at").isNotNull() & name.startswith(f"{source}_") & name.endswith(f".{file_type}")
    fits = F.coalesce(fits & (F.substring_index(below, "/", 4) == day), F.lit(False))
    return placed.select(
        "file",
        "length",
        "modified",
        F.when(fits, F.col("staged_at")).alias("staged_at"),
        F.when(fits, whole).alias("path"),
    )


def staged_loads(spark: SparkSession, root: str, source: str, file_type: str, state: str = STAGED) -> DataFrame:
    """The loads of a source: ``staged_at`` and ``path``, the folder (or file) of each.

    Paths only; no file is read. Files that belong to no load are left out: see ``misplaced_files``.
    """
    found = staged_files(spark, root, source, file_type, state)
    return found.where(F.col("path").isNotNull()).select("staged_at", "path").distinct()


def misplaced_files(spark: SparkSession, root: str, source: str, file_type: str, state: str = STAGED) -> DataFrame:
    """Files of a source, ``file`` and ``length``, whose place or name does not tell a load."""
    return staged_files(spark, root, source, file_type, state).where(F.col("path").isNull()).select("file", "length")


def empty_files(spark: SparkSession, path: str) -> DataFrame:
    """Zero-byte files, of which no reader ever reports a row.

    Spark's own file listing names them; the files that do give a row are taken off. The
    names of all files pass through the driver, which lists them for any read.
    """
    filled = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    listed = spark.createDataFrame([(name,) for name in filled.inputFiles()], "path string")
    # A URI may have one slash after its scheme or three.
    plain = F.regexp_replace("path", r"^(\w+):/+", "$1:/").alias("path")
    return listed.select(plain).join(filled.select(plain), "path", "left_anti")
