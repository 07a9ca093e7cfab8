"""Reading what was written: search, paging, single documents, counts and sizes of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def term_hits(text: Column, term: str) -> Column:
    """How often a term occurs, without regard to case."""
    wanted = term.lower()
    return F.when(F.lit(not wanted), F.lit(0)).otherwise(((F.char_length(F.lower(text)) - F.char_length(F.replace(F.lower(text), F.lit(wanted), F.lit("")))) / F.lit(max(1, len(wanted)))).cast("int"))


def search(docs: DataFrame, term: str, key: str, text: str = "text", limit: int = 20, offset: int = 0) -> DataFrame:
    """The page of documents with most occurrences of a term: key, score; ties by key."""
    scored = docs.select(F.col(key), term_hits(F.col(text), term).alias("score")).where("score > 0")
    return scored.orderBy(F.desc("score"), key).offset(offset).limit(limit)


def search_total(docs: DataFrame, term: str, text: str = "text") -> DataFrame:
    """How many documents hold a term."""
    return docs.where(term_hits(F.col(text), term) > 0).agg(F.count("*").alias("total"))


def get_document(docs: DataFrame, key: str, value: object) -> DataFrame:
    """The document of a key; the filter reaches the files. No row: there is none."""
    return docs.where(F.col(key) == F.lit(value))


def row_count(table: DataFrame) -> DataFrame:
    return table.agg(F.count("*").alias("row_count"))


def share_of_total(table: DataFrame, group: str) -> DataFrame:
    """Rows by group, and their share of all rows."""
    own = table.groupBy(group).agg(F.count("*").alias("row_count"))
    return own.crossJoin(F.broadcast(own.agg(F.sum("row_count").alias("_all")))).select(group, "row_count", F.round(F.col("row_count") / F.col("_all"), 9).alias("share"))


def text_sizes(table: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Bytes in text columns by group."""
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns[1:]), F.coalesce(F.octet_length(columns[0]), F.lit(0)))
    return table.groupBy(group).agg(F.sum(size.cast("bigint")).alias("size_bytes"), F.count("*").alias("row_count"))


def schema_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns (name, type) of ``left`` that ``right`` lacks."""
    table = lambda d: d.sparkSession.createDataFrame([*d.dtypes, ("", "")], "name string, type string").where("name <> ''")
    return table(left).exceptAll(table(right))
