"""Language sections of a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.arrays import posexplode_rows
from quarry.functions.text import CODE, preamble, section_structs


def sections(df: DataFrame, keys: list[str], text_col: str, markers: str = CODE) -> DataFrame:
    """One row per tagged section: keys + (section_no, lang, text). Narrow: no shuffle.

    Text before the first marker (the whole text without markers), if not blank, is
    section -1 with a NULL language.
    """
    text = F.col(text_col)
    before = F.struct(F.lit(None).cast("string").alias("lang"), preamble(text, markers).alias("text"))
    z = df.select(*keys, F.concat(F.array(before), section_structs(text, markers)).alias("__s"))
    rows = posexplode_rows(z, list(keys), "__s", "__no", "__e").select(
        *keys, (F.col("__no") - 1).alias("section_no"), F.lower(F.col("__e.lang")).alias("lang"),
        F.col("__e.text").alias("text"))
    return rows.filter((F.col("section_no") >= 0) | (F.trim("text") != ""))
