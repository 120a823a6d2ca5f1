"""Input settings of a run: perturbation blocks of ``.cell`` files and ``.param`` settings.

Both are small text files that need their own line order, so each is read whole, one row per file,
and taken apart by array functions in that row: no shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scfsweep.functions import is_number_text
from scfsweep.sources.paths import file_path

# Block names of a cell file and the line shapes inside.
BLOCK_NAMES = {"U": "HUBBARD_U", "ALPHA": "HUBBARD_ALPHA"}
ITEM_LINE_PATTERN = r"^([A-Za-z]+)\s*(\d*)\s+[spdfSPDF]\s*:"
ORBITAL_PATTERN = r"([spdfSPDF])\s*:\s*([-+0-9.eE]+)"
ITEM_TYPE = (
    "array<struct<block:string,pos:int,element:string,atom_id:int,orbital:string,value:double>>"
)
SETTING_TYPE = "array<struct<pos:int,key:string,value:string>>"

# Products of earlier runs that lie next to the inputs.
PRODUCT_SUFFIXES = (".castep", ".txt", ".csv", ".xsd", ".xms")


def input_files(spark: SparkSession, paths: str | list[str], suffix: str | None = None) -> DataFrame:
    """Files as (file, text), searched at any depth; with no ``suffix``, all but earlier products."""
    reader = spark.read.option("recursiveFileLookup", True)
    if suffix is not None:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    files = reader.text(paths, wholetext=True).select(file_path().alias("file"), F.col("value").alias("text"))
    if suffix is None:
        for product in PRODUCT_SUFFIXES:
            files = files.filter(~F.col("file").endswith(product))
    return files


def text_lines(text: Column) -> Column:
    """Lines of a text, with either line ending."""
    return F.split(text, r"\r?\n")


def block_lines(text: Column, block: str) -> Column:
    """Trimmed, non-empty lines inside a block; an empty array when the file has none."""
    name = BLOCK_NAMES[block]
    body = F.regexp_extract(text, rf"(?is)%BLOCK[ \t]+{name}[ \t]*\r?\n(.*?)%ENDBLOCK[ \t]+{name}\b", 1)
    trimmed = F.transform(text_lines(body), lambda line: F.regexp_replace(line, r"^\s+|\s+$", ""))
    return F.filter(trimmed, lambda line: line != "")


def _line_items(block: str, line: Column, index: Column) -> Column:
    orbitals = F.regexp_extract_all(line, F.lit(ORBITAL_PATTERN), F.lit(1))
    values = F.regexp_extract_all(line, F.lit(ORBITAL_PATTERN), F.lit(2))
    atom = F.nullif(F.regexp_extract(line, ITEM_LINE_PATTERN, 2), F.lit(""))
    return F.zip_with(
        orbitals,
        values,
        lambda orbital, value: F.struct(
            F.lit(block).alias("block"),
            (index + 1).cast("int").alias("pos"),
            F.regexp_extract(line, ITEM_LINE_PATTERN, 1).alias("element"),
            atom.try_cast("int").alias("atom_id"),
            F.lower(orbital).alias("orbital"),
            value.try_cast("double").alias("value"),
        ),
    )


def items_of(text: Column) -> Column:
    """Items of both blocks in file order; ``pos`` is the line within the block, from 1."""
    per_block = []
    for block in BLOCK_NAMES:
        lines = F.filter(block_lines(text, block), lambda line: line.rlike(ITEM_LINE_PATTERN))
        nested = F.transform(lines, lambda line, i: _line_items(block, line, i))
        per_block.append(F.flatten(nested))
    return F.concat(*per_block).cast(ITEM_TYPE)


def cell_items(files: DataFrame) -> DataFrame:
    """(file, text, ...) -> (file, ..., items), one row per cell file."""
    rest = [c for c in files.columns if c != "text"]
    return files.select(*rest, items_of(F.col("text")).alias("items"))


def settings_of(text: Column) -> Column:
    """``key : value`` lines of a settings text in file order; comments and blank lines are left out."""
    numbered = F.transform(
        text_lines(text),
        lambda line, i: F.struct(
            (i + 1).cast("int").alias("pos"),
            F.trim(F.get(F.split(line, ":", 2), F.lit(0))).alias("key"),
            F.trim(F.get(F.split(line, ":", 2), F.lit(1))).alias("value"),
        ),
    )
    return F.filter(
        numbered,
        lambda s: s["value"].isNotNull() & (s["key"] != "") & ~s["key"].rlike("^[!#]"),
    ).cast(SETTING_TYPE)


def number_or_null(text: Column) -> Column:
    return F.when(is_number_text(text), text.try_cast("double"))


def param_settings(files: DataFrame) -> DataFrame:
    """(file, text, ...) -> (file, ..., pos, key, value, value_num), one row per setting."""
    rest = [c for c in files.columns if c != "text"]
    # An outer explode, because a plain one adds a size test that parses every text a second time.
    return (
        files.select(*rest, F.explode_outer(settings_of(F.col("text"))).alias("s"))
        .filter(F.col("s").isNotNull())
        .select(*rest, "s.pos", "s.key", "s.value")
        .withColumn("value_num", number_or_null(F.col("value")))
    )
