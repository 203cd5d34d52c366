"""Schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, IntegerType, MapType, StringType, StructField, StructType

# Table columns, header line, spellings read as null.
COLUMNS = ("item_no", "part_no", "description", "uoc", "quantity")
HEADER = "\t".join(COLUMNS)
NA_SPELLINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

#: Element JSON: only the fields in use, so image payloads are never materialised.
ELEMENTS = ArrayType(
    StructType(
        [
            StructField("type", StringType()),
            StructField("element_id", StringType()),
            StructField("text", StringType()),
            StructField("metadata", StructType([StructField("page_number", IntegerType())])),
        ]
    )
)

PAIRING = MapType(
    StringType(),
    StructType(
        [
            StructField("figure_pages", ArrayType(IntegerType())),
            StructField("figure_texts", ArrayType(StringType())),
            StructField("table_pages", ArrayType(IntegerType())),
        ]
    ),
)

MANIFEST_PATHS = ("figure_path", "table_path", "tsv_path")
