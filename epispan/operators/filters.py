"""Accent-blind text search and name lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, without_accents
from ..session import dimension

#: Compares letters whatever their case, accents or way of composition.
BLIND = "UNICODE_CI_AI"
#: Letters of a key that names and queries are matched by.
GRAM = 3


def folded(text: Column | str) -> Column:
    return F.lower(F.trim(without_accents(col(text))))


def search_text(df: DataFrame, fields: list[str], term: str) -> DataFrame:
    """Rows whose joined fields contain the term, accents and case aside; an empty term finds nothing.

    The collation decides what is equal, so composed and decomposed spellings are.
    """
    wanted = F.trim(F.lit(term))
    joined = F.collate(F.concat_ws(" ", *[F.col(f) for f in fields]), BLIND)
    return df.where((wanted != "") & F.contains(joined, F.collate(wanted, BLIND)))


def _grams(text: Column, size: int) -> Column:
    places = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - (size - 1)))
    return F.coalesce(F.transform(places, lambda i: F.substring(text, i, F.lit(size))), F.array().cast("array<string>"))


def find_by_name(df: DataFrame, name: str, tie_break: str, queries: list[str] | DataFrame) -> DataFrame:
    """Best match per query: the exact name, else a name starting with it, else one containing it.

    ``df`` is a gazetteer with one row per place, ``queries`` a list or a table with the column query.
    A name that contains a query contains each of its grams: names are posted under their grams, and a
    query meets only the names of its rarest one (a query below ``GRAM`` letters is a gram itself).
    Places of one name are told apart by ``tie_break`` alone, so a name is posted once, with its first place.
    The size of what is posted is unknown before it runs, so its joins shuffle: no side passes through the driver.
    The best match is an aggregate. Empty queries and null names match nothing; among equal ranks
    the smallest ``tie_break`` wins.
    """
    if isinstance(queries, list):
        queries = dimension(df.sparkSession, [(q,) for q in queries], "query string")
    words = queries.select("query").distinct().withColumn("_query", folded("query")).where("_query <> ''")
    first = F.min_by(F.struct(*df.columns), F.struct(tie_break)).alias("_place")
    places = df.withColumn("_name", folded(name)).where("_name <> ''").groupBy("_name").agg(first)
    sizes = [_grams(F.col("_name"), n) for n in range(1, GRAM + 1)]
    posted = places.withColumn("_gram", F.explode(F.array_distinct(F.concat(*sizes))))
    known = posted.groupBy("_gram").agg(F.count(F.lit(1)).alias("_places"))
    own = F.when(F.length("_query") < GRAM, F.array("_query")).otherwise(_grams(F.col("_query"), GRAM))
    asked = words.withColumn("_gram", F.explode(F.array_distinct(own))).join(known.hint("merge"), "_gram", "left").fillna(0, subset=["_places"])
    rarest = asked.groupBy("query", "_query").agg(F.min(F.struct("_places", "_gram")).alias("_least"))
    met = posted.hint("merge").join(rarest.select("query", "_query", F.col("_least._gram").alias("_gram")), "_gram")
    rank = (
        F.when(F.col("_name") == F.col("_query"), 0)
        .when(F.startswith("_name", "_query"), 1)
        .when(F.contains("_name", "_query"), 2)
    )
    best = met.withColumn("_rank", rank).where("_rank IS NOT NULL").groupBy("query").agg(
        F.min_by("_place", F.struct("_rank", F.col(f"_place.`{tie_break}`"))).alias("_best")
    )
    return best.select(*[F.col(f"_best.`{c}`").alias(c) for c in df.columns], "query")
