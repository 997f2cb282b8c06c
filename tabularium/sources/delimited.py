"""Delimited text: readers for files and for lines, null tokens, comments, fixed layouts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.casts import null_tokens

# The 17 columns of a GAF 2.2 annotation file.
GAF_COLUMNS = (
    "db", "db_object_id", "db_object_symbol", "qualifier", "go_id", "db_reference", "evidence_code", "with_from",
    "aspect", "db_object_name", "db_object_synonym", "db_object_type", "taxon", "date", "assigned_by",
    "annotation_extension", "gene_product_form_id",
)

# The 15 leading columns of a MITAB 2.7 interaction file.
MITAB_COLUMNS = (
    "idA", "idB", "altA", "altB", "aliasA", "aliasB", "method", "author", "publication", "taxonA", "taxonB",
    "interaction_type", "source_db", "interaction_id", "confidence",
)


def text_schema(names: Sequence[str]) -> T.StructType:
    """All columns as text, the safe way to read a file whose values are cast later."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _options(sep: str, comment: str | None, quote: str | None) -> dict[str, str]:
    options = {"sep": sep, "mode": "PERMISSIVE", "quote": quote or "", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
    if comment:
        options["comment"] = comment
    return options


def read_table(spark: SparkSession, path: str | list[str], schema: str | T.StructType, sep: str = "\t", header: bool = True,
               comment: str | None = None, quote: str | None = None, null_values: Iterable[str] = (),
               partitions: int | None = None) -> DataFrame:
    """Delimited file (plain or gzip) with a declared schema.

    With a header, values go to columns by name: a declared column that the file lacks is null,
    a value that does not parse is null, and columns that are not declared follow as text. All
    files of one read must have the same header; another one fails the job. Without a header
    the declared order counts. Surplus fields of a row are dropped and short rows filled with
    nulls. A gzip file cannot be split and is read by one task; ``partitions`` spreads its rows
    right after the read.
    """
    options = _options(sep, comment, quote)
    df = _by_name(spark, path, schema, options) if header else spark.read.schema(schema).options(header=False, **options).csv(path)
    if partitions:
        df = df.repartition(partitions)
    tokens = list(null_values)
    return null_tokens(df, tokens) if tokens else df


def _by_name(spark: SparkSession, path: str | list[str], schema: str | T.StructType, options: dict[str, str]) -> DataFrame:
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    found = spark.read.options(header=True, **options).csv(path).columns
    if not found:
        return spark.createDataFrame([], declared)
    rows = spark.read.schema(text_schema(found)).options(header=True, enforceSchema=False, **options).csv(path)
    named = {f.name for f in declared.fields}
    return rows.select(*[(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in found else F.lit(None).cast(f.dataType)).alias(f.name) for f in declared.fields],
                       *[F.col(f"`{n}`") for n in found if n not in named])


def parse_lines(df: DataFrame, line: str, schema: str | T.StructType, sep: str = "\t", quote: str | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """The same for lines that are already in a column."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"sep": sep, "quote": quote or "\u0000", "mode": "PERMISSIVE"}
    return df.select(*keep, F.from_csv(F.col(line), ddl, options).alias("_row")).select(*keep, "_row.*")


def content_lines(df: DataFrame, line: str, comment: str) -> DataFrame:
    """Lines that are neither blank nor comments."""
    value = F.col(line)
    return df.filter((F.length(F.trim(value)) > 0) & ~value.startswith(comment))


def read_annotations(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """GAF 2.2 file: 17 text columns, ``!`` comments anywhere, no header."""
    return read_table(spark, path, text_schema(GAF_COLUMNS), header=False, comment="!")


def ragged(c: Column, sep: str, n_fields: int) -> Column:
    """How a line departs from its number of fields: negative is short, positive is long."""
    return F.size(F.split(c, "\\Q" + sep + "\\E", -1)) - F.lit(n_fields)
