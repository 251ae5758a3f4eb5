"""Landed search pages and association pages."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_CORRUPT = "_corrupt_record"
#: Lines of a compressed file at most.
FILE_ROWS = 200_000


def read_pages(spark: SparkSession, path: str, schema: T.StructType, required: str = "results") -> DataFrame:
    """Every landed page under ``path``, one row each, with a fixed schema.

    No schema inference, so the files are read once, and an empty folder gives an empty frame of
    the right shape. A line that is no JSON, or a page without its ``required`` field (an error
    body, say), stops the job with the name of its file; an empty list is a page like any other.
    """
    landed = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    rows = spark.read.schema(landed).option("columnNameOfCorruptRecord", _CORRUPT).json(path)
    # The file's name from its metadata: unlike input_file_name() it lets filters pass down to the scan.
    message = F.concat(F.lit(f"no page with {required} in "), F.col("_metadata.file_path"))
    unreadable = F.col(_CORRUPT).isNotNull() | F.col(required).isNull()
    # The test stands in the one column that every reader of the page uses.
    checked = F.when(unreadable, F.raise_error(message).cast(schema[required].dataType)).otherwise(F.col(required))
    return rows.select(*[checked.alias(c) if c == required else F.col(c) for c in schema.fieldNames()])


def parse_pages(df: DataFrame, column: str, schema: T.StructType) -> DataFrame:
    """Pages held as JSON text in a column, one row each."""
    return df.select(F.from_json(F.col(column), schema).alias("page")).select("page.*")


def exploded(df: DataFrame, items: str | Column, name: str, *kept: str | Column) -> DataFrame:
    """One row per array element, under ``name``, next to the ``kept`` columns.

    The outer form with a test afterwards: for the plain one the optimizer adds a test of the
    array itself, and over an array parsed from text that parses every document twice.
    """
    return df.select(*kept, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def page_records(pages: DataFrame) -> DataFrame:
    """One row per record over all pages, with the record's ``properties`` as plain columns."""
    records = exploded(pages, "results", "record").select("record.*")
    return records.select(
        *[c for c in records.columns if c != "properties"], "properties.*"
    )


def bridge(association_pages: DataFrame, left: str, right: str) -> DataFrame:
    """(record, associated record) pairs; a record without associations gives no row."""
    return exploded(association_pages, "results.id", right, F.col("record_id").alias(left))


def existing_only(links: DataFrame, records: DataFrame, link_key: str, record_key: str) -> DataFrame:
    """The links whose target record was really delivered."""
    targets = records.select(F.col(record_key).alias(link_key))
    return links.join(targets, link_key, "left_semi")


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Every nested struct field as a column named by its path.

    The walk goes over the schema only; arrays stay as they are.
    """

    def leaves(schema: T.StructType, column: Column | None, path: str) -> list[Column]:
        out: list[Column] = []
        for field in schema.fields:
            name = f"{path}{sep}{field.name}" if path else field.name
            value = F.col(f"`{field.name}`") if column is None else column.getField(field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, value, name)
            else:
                out.append(value.alias(name))
        return out

    return df.select(*leaves(df.schema, None, ""))


def discovered_schema(df: DataFrame, column: str) -> T.DataType:
    """The type of all JSON documents of a column together, found by an aggregation that merges partial results; the
    driver gets one line of text. A field whose values are of different kinds is a VARIANT."""
    found = df.select(F.schema_of_variant_agg(F.parse_json(column))).first()[0]
    if found is None or found == "VOID":
        return T.StructType([])
    # Nothing is known of fields that are always null; as text they can be read.
    return T.DataType.fromDDL(re.sub(r"(: |<)VOID\b", r"\1STRING", found).replace("OBJECT<", "STRUCT<"))


def flatten_open(df: DataFrame, column: str, sep: str = ".") -> DataFrame:
    """Every field that any document of a column holds, as :func:`flatten` names them: nothing is dropped for a schema
    that does not list it. Fields without a value in any document are text, those of mixed kinds JSON text."""
    kind = discovered_schema(df, column)
    if not isinstance(kind, T.StructType):
        raise TypeError(f"the documents in {column} are of type {kind.simpleString()}, not objects")
    if not kind.fields:
        return df.select()
    document = F.variant_get(F.parse_json(column), "$", kind.simpleString())
    flat = flatten(df.select(document.alias("_d")).select("_d.*"), sep)
    return flat.select(*[F.to_json(f"`{c}`").alias(c) if t == "variant" else F.col(f"`{c}`") for c, t in flat.dtypes])


def write_jsonl(
    df: DataFrame,
    path: str,
    by: str | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    compression: str | None = None,
) -> None:
    """JSON lines; with ``by`` in a folder for each of its values, which readers see as a column.

    ``finish`` makes the written columns, ``by`` among them, of rows that are in their place already: what is small
    before it and large after it is moved and sorted while it is small. A file compressed with a codec that cannot be
    split is read by one task, so it holds at most ``FILE_ROWS`` lines.
    """
    if by is not None:
        df = df.hint("rebalance", by)
        df = df if finish is None else df.sortWithinPartitions(by)
    df = df if finish is None else finish(df)
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    if compression is not None:
        writer = writer.options(compression=compression, maxRecordsPerFile=FILE_ROWS)
    (writer if by is None else writer.partitionBy(by)).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
