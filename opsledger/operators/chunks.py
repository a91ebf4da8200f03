"""Splitting markdown documents at their second-level headings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsledger.functions.text import SPACES, heading, strip


def markdown_title(text: Column, fallback: Column) -> Column:
    """The `# ` heading on the first line of the stripped text, else `fallback`."""
    return F.coalesce(heading(F.ltrim(text, F.lit(SPACES)), "#"), fallback)


def chunk_sections(
    docs: DataFrame, id_col: str, text_col: str, fallback_title: Column | None = None
) -> DataFrame:
    """(chunk_id, doc_title, section_title, text), one row per section.

    A piece that is nothing but the document's title is skipped; text before the first section is
    an "Overview". Ids are `id::n`, where n counts skipped pieces too.
    """
    fallback = F.col(id_col).cast("string") if fallback_title is None else fallback_title
    # The title is settled before the split, so it is found once per document and not per section.
    titled = docs.select(
        F.col(id_col).cast("string").alias("_id"),
        markdown_title(F.col(text_col), fallback).alias("doc_title"),
        F.transform(F.split(F.col(text_col), "\n(?=## )"), strip).alias("_pieces"),
    )
    # Outer, so that no filter on the pieces is inferred that would split every text a second time.
    pieces = titled.select("_id", "doc_title", F.posexplode_outer("_pieces").alias("_n", "text"))
    text = F.col("text")
    title_only = text.startswith("# ") & ~text.contains("\n")
    return pieces.where((text != "") & ~title_only).select(
        F.concat_ws("::", "_id", "_n").alias("chunk_id"),
        "doc_title",
        F.coalesce(heading(text, "##"), F.lit("Overview")).alias("section_title"),
        "text",
    )


def corpus_order(chunk_id: str) -> Column:
    """The chunk id as text that sorts in corpus order: by document, then by the number of the piece."""
    number = F.substring_index(chunk_id, "::", -1)
    return F.concat(F.regexp_replace(chunk_id, "::[0-9]+$", ""), F.lit("\u0001::"), F.lpad(number, 10, "0"))


def chunk_of(position: str) -> Column:
    """The chunk id behind `corpus_order`."""
    number = F.regexp_replace(F.substring_index(position, "::", -1), "^0+(?=[0-9])", "")
    return F.concat(F.regexp_replace(position, "\u0001::[0-9]+$", ""), F.lit("::"), number)
