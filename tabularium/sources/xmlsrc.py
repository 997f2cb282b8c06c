"""XML documents: rows by tag, declared fields, conditional items, acquisition metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.casts import utc_timestamp


def read_xml(spark: SparkSession, path: str | list[str], row_tag: str, schema: str | T.StructType) -> DataFrame:
    """One row per element of the tag; repeated children are arrays, absent ones null."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def parse_xml(doc: Column, schema: str) -> Column:
    """One document as a struct of the declared shape, parsed once; prefixes are ignored."""
    return F.from_xml(doc, schema, {"ignoreNamespace": "true", "mode": "PERMISSIVE"})


def text_path(tag: str) -> str:
    """XPath of the elements with the local name."""
    return f"//*[local-name()='{tag}']"


def item_path(item: str, key: str, wanted: str, value: str) -> str:
    """XPath of the value of the first item whose key element has the wanted text."""
    return f"//*[local-name()='{item}'][*[local-name()='{key}']='{wanted}'][1]/*[local-name()='{value}']"


def xml_text(doc: Column, tag: str) -> Column:
    """Trimmed text of the first element with the local name, empty when absent."""
    return F.trim(F.xpath_string(doc, F.lit(text_path(tag))))


def xml_item(doc: Column, item: str, key: str, wanted: str, value: str) -> Column:
    """Value of the first item whose key element has the wanted text, empty when absent."""
    return F.trim(F.xpath_string(doc, F.lit(item_path(item, key, wanted, value))))


#: A character that no XML document can hold.
_BETWEEN = "\u0001"


def xml_fields(df: DataFrame, doc: str, paths: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """A column per XPath with the trimmed text of its first element, empty when absent.

    Each document is read once: one XPath joins the texts, and they are split again.
    """
    joined = f", '{_BETWEEN}', ".join(f"string({p})" for p in paths.values())
    texts = df.select(*keep, F.split(F.xpath_string(doc, F.lit(f"concat({joined}, '')")), _BETWEEN).alias("_texts"))
    return texts.select(*keep, *[F.trim(F.get("_texts", F.lit(i))).alias(n) for i, n in enumerate(paths)])


ACQUISITION_SCHEMA = """
Metadata struct<
  Scaling: struct<Items: struct<Distance: array<struct<_Id: string, Value: double>>>>,
  Information: struct<
    Document: struct<CreationDate: string>,
    Image: struct<Dimensions: struct<Channels: struct<Channel: array<struct<_Id: string, _Name: string, Fluor: string>>>>>,
    Instrument: struct<Objectives: struct<Objective: array<struct<
      Manufacturer: struct<Model: string>, NominalMagnification: string, LensNA: string>>>>>>
"""


def acquisition_columns(doc: Column) -> dict[str, Column]:
    """Columns of one image-metadata document (root element, then ``Metadata``).

    Pixel sizes arrive in metres and leave in micrometres; a channel is named by its name,
    dye or id, with the dye in brackets unless the name already holds it.
    """
    return _acquisition(parse_xml(doc, ACQUISITION_SCHEMA)["Metadata"])


def _acquisition(meta: Column) -> dict[str, Column]:
    info = meta["Information"]
    distances = meta["Scaling"]["Items"]["Distance"]
    channels = info["Image"]["Dimensions"]["Channels"]["Channel"]
    objective = F.get(info["Instrument"]["Objectives"]["Objective"], F.lit(0))

    def pixel(axis: str) -> Column:
        hits = F.filter(distances, lambda d: d["_Id"] == axis)
        return F.round(F.get(hits, F.size(hits) - 1)["Value"] * F.lit(1e6), 4)

    def label(ch: Column) -> Column:
        dye = F.nullif(ch["Fluor"], F.lit(""))
        name = F.coalesce(F.nullif(ch["_Name"], F.lit("")), dye, F.nullif(ch["_Id"], F.lit("")), F.lit("?"))
        return F.when(dye.isNotNull() & ~F.contains(name, dye), F.concat(name, F.lit(" ("), dye, F.lit(")"))).otherwise(name)

    return {
        "n_channels": F.coalesce(F.size(channels), F.lit(0)),
        "channels": F.nullif(F.array_join(F.transform(channels, label), " | "), F.lit("")),
        "px_um_x": pixel("X"), "px_um_y": pixel("Y"), "px_um_z": pixel("Z"),
        "created": utc_timestamp(info["Document"]["CreationDate"]),
        "objective": objective["Manufacturer"]["Model"],
        "magnification": objective["NominalMagnification"],
        "na": objective["LensNA"],
    }


def select_acquisition(df: DataFrame, doc: str, keep: Sequence[str] = (), columns: Mapping[str, Column] | None = None) -> DataFrame:
    """Acquisition row per image-metadata document; an unreadable one is all null with an error text.

    A document is read once, whatever the number of columns.
    """
    read = df.withColumn("_meta", parse_xml(F.col(doc), ACQUISITION_SCHEMA)["Metadata"])
    cols = dict(columns or _acquisition(F.col("_meta")))
    return read.select(*keep, *[c.alias(n) for n, c in cols.items()],
                       F.when(F.col("_meta").isNull(), F.lit("unreadable metadata")).alias("error"))
