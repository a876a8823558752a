"""Raw file sources: CSV, JSON, file inventories and partition-pruned scans.

Raw datasets are Hive-style directories ``{base}/{key}={value}/...``. A load
reads every planned partition in *one* scan: the planned values become one
glob, so only those directories are listed, and the partition value is taken
from the file path for grouping (per-partition counts, validation, writes).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.functions.params import format_of_path

# --- fixed values (must equal the reference's rules) -------------------------
CSV_OPTIONS = {"header": "true", "delimiter": ";", "nullValue": "\\N"}
JSON_OPTIONS = {"multiLine": "true"}
# -----------------------------------------------------------------------------


def csv_reader(spark: SparkSession, infer: bool = False, header: bool = True, delimiter: str = ";",
               null_value: str | None = "\\N"):
    opts = dict(CSV_OPTIONS)
    opts["header"] = str(header).lower()
    opts["delimiter"] = delimiter
    if null_value is None:  # the first loader version had no null marker
        opts.pop("nullValue")
    else:
        opts["nullValue"] = null_value
    # Without inference every column is text: no extra pass over the data,
    # and validation checks the text against the declared types instead.
    opts["inferSchema"] = str(infer).lower()
    # Every file's header is checked against the columns taken from the first
    # file: a column-order change between files fails loudly instead of
    # silently shifting values (the CSV reader maps columns by position).
    opts["enforceSchema"] = "false"
    return spark.read.options(**opts)


def ext_glob(ext: str) -> str:
    """Case-insensitive file-name glob for an extension (``*.[cC][sS][vV]``)."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in ext)


def read_csv(spark: SparkSession, path, infer: bool = False, header: bool = True,
             delimiter: str = ";", base_path: str | None = None, null_value: str | None = "\\N") -> DataFrame:
    r = csv_reader(spark, infer, header, delimiter, null_value).option("pathGlobFilter", ext_glob("csv"))
    if base_path:
        r = r.option("basePath", base_path)
    return r.csv(path)


def read_json(spark: SparkSession, path, schema: StructType | None = None,
              base_path: str | None = None, glob: str | None = "*.[jJ][sS][oO][nN]") -> DataFrame:
    """Multi-line JSON (each file one document or an array of documents).

    Without a schema Spark infers one (a pass over the files); supplying the
    declared field names as text skips that pass.
    """
    r = spark.read.options(**JSON_OPTIONS)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if base_path:
        r = r.option("basePath", base_path)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def require_rows(df: DataFrame, fmt: str) -> DataFrame:
    """Fail on an empty read (the first loader version's guard); stops at the first row."""
    if df.isEmpty():
        raise ValueError(f"{fmt.upper()} read returned empty DataFrame")
    return df


def text_schema(names: list[str], partition_col: str | None = None) -> StructType:
    fields = [StructField(n, StringType(), True) for n in names]
    if partition_col and partition_col not in names:
        fields.append(StructField(partition_col, StringType(), True))
    return StructType(fields)


def read_raw(spark: SparkSession, path, fmt: str, **kw) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, **kw)
    if fmt == "json":
        return read_json(spark, path, **kw)
    if fmt == "excel":
        from tidewater.sources.xlsx import read_xlsx
        return read_xlsx(spark, path, **kw)
    raise RuntimeError(f"Unsupported file type: {fmt}")


def partition_glob(base: str, key: str, values: list[str]) -> str:
    base = base.rstrip("/")
    if len(values) == 1:
        return f"{base}/{key}={values[0]}"
    return f"{base}/{key}={{{','.join(values)}}}"


def read_partitions(spark: SparkSession, base: str, key: str, values: list[str], fmt: str,
                    partition_alias: str | None = None, **kw) -> DataFrame | None:
    """One scan over the planned partitions ``{base}/{key}={v}`` for v in values.

    Each directory is read as a leaf, so a file column named as the key stays
    what it is; the partition value comes from the file path, as text, under
    ``partition_alias`` (``key`` when not given: it then hides a file column of
    that name). Workbooks also keep ``_source_path``. Returns None when none of
    the planned directories exists.
    """
    if not values:
        return None
    name = partition_alias or key
    try:
        if fmt == "excel":
            from tidewater.sources.xlsx import read_xlsx
            df = read_xlsx(spark, partition_glob(base, key, values), keep_path=True, **kw)
            return df.withColumn(name, partition_of(F.col("_source_path"), key))
        df = read_raw(spark, partition_glob(base, key, values), fmt, **kw)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            return None
        raise
    return df.withColumn(name, partition_of(F.col("_metadata.file_path"), key))


def partition_of(path: Column, key: str) -> Column:
    """The partition value in a file path (planned values are dates, which paths hold as they are)."""
    return F.regexp_extract(path, f"/{key}=([^/]+)/", 1)


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str | None]:
    """First line that is not blank of each file (one small read a file, by the driver's file system client)."""
    from concurrent.futures import ThreadPoolExecutor
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def one(path: str) -> str | None:
        p = jvm.org.apache.hadoop.fs.Path(path)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(p.getFileSystem(conf).open(p), "UTF-8"))
        try:
            line = lines.readLine()
            while line is not None and not line.strip():
                line = lines.readLine()
            return line
        finally:
            lines.close()

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(paths, pool.map(one, paths), strict=True))


def json_keys(spark: SparkSession, paths, key: str) -> DataFrame:
    """(value, name): the record keys that occur in each partition of the JSON files, also with null values."""
    text = (spark.read.option("wholetext", "true").option("pathGlobFilter", ext_glob("json"))
                 .text(paths))
    one = "map<string,string>"
    records = F.coalesce(F.from_json("value", f"array<{one}>"), F.array(F.from_json("value", one)))
    found = text.select(partition_of(F.col("_metadata.file_path"), key).alias("value"), F.explode(records).alias("r"))
    return found.select("value", F.explode(F.map_keys("r")).alias("name")).distinct()


def file_inventory(spark: SparkSession, base: str) -> DataFrame:
    """Every file under ``base``: path, size, modification time (content is not read).

    Hidden files (``_SUCCESS``, ``.crc``) are skipped by Spark's listing.
    """
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
                 .select("path", "length", "modificationTime"))


def detect_formats(inventory: DataFrame) -> DataFrame:
    """Format of each directory: the first (by key order) file with a supported
    extension decides; directories without one are reported with NULL format."""
    inv = inventory.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("directory"),
        F.col("path"),
        format_of_path(F.col("path")).alias("format"))
    return inv.groupBy("directory").agg(
        F.min_by(F.col("format"), F.when(F.col("format").isNotNull(), F.col("path"))).alias("format"),
        F.min(F.when(F.col("format").isNotNull(), F.col("path"))).alias("sample_path"),
        F.count(F.lit(1)).alias("files"))
