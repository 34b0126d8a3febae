"""Match free place names to a list of known cities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastre.functions.text import fold


#: length of the pieces that texts are indexed by
GRAM = 3


def _grams(text: Column, size: int) -> Column:
    """Distinct substrings of one length, as many as the text has places."""
    return F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length(text) - (size - 1)), lambda at: text.substr(at, F.lit(size))))


def _contained(inner: DataFrame, outer: DataFrame) -> DataFrame:
    """Distinct pairs of ``inner`` and ``outer`` texts (columns of those names) where one holds the other.

    An inner text is looked up by the rarest of its pieces, an outer one is indexed by all of its
    pieces of that length: candidates grow with the length of a text, not with its square.  Shorter
    inner texts are their own piece; the empty text is in every other.
    """
    found = []
    length = F.length("inner")
    for size in range(1, GRAM + 1):
        some = inner.where(length >= size if size == GRAM else length == size)
        pieces = outer.where(F.length("outer") >= size).select("outer", F.explode(_grams(F.col("outer"), size)).alias("piece"))
        known = some.select("inner", F.explode(_grams(F.col("inner"), size)).alias("piece"))
        often = known.select("piece").distinct().join(pieces, "piece", "left").groupBy("piece").agg(F.count("outer").alias("n"))
        rarest = known.join(often, "piece").groupBy("inner").agg(F.min(F.struct("n", "piece"))["piece"].alias("piece"))
        found.append(rarest.join(pieces, "piece").where(F.contains("outer", "inner")).select("inner", "outer"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.union(more)
    return pairs


def match_names(names: DataFrame, cities: DataFrame) -> DataFrame:
    """First city (in name order) equal to, inside or around each name.

    ``names`` has ``(name)``, ``cities`` has ``(city)``.  Candidates for containment share a
    short piece, so they come from hash joins instead of comparing every name with every city.
    """
    folded = names.where(F.col("name").isNotNull() & (F.col("name") != "")).select(
        "name", fold(F.col("name")).alias("folded")).distinct()
    known = cities.where(F.col("city").isNotNull()).select(
        "city", fold(F.col("city")).alias("city_folded")).distinct()
    smallest = known.groupBy("city_folded").agg(F.min("city").alias("city"))

    places = folded.select("folded").distinct()
    inside = (_contained(smallest.select(F.col("city_folded").alias("inner")), places.select(F.col("folded").alias("outer")))
              .select(F.col("outer").alias("folded"), F.col("inner").alias("city_folded")))
    around = (_contained(places.select(F.col("folded").alias("inner")), smallest.select(F.col("city_folded").alias("outer")))
              .select(F.col("inner").alias("folded"), F.col("outer").alias("city_folded")))
    cities_of = inside.union(around).join(smallest, "city_folded").select("folded", "city")
    # a name that folds to nothing is inside every city, a city that does is inside every name
    least, nowhere = (some.agg(F.min("city")).scalar() for some in (smallest, smallest.where("city_folded = ''")))
    blank = (places.where("folded = ''").withColumn("city", least)
             .union(places.withColumn("city", nowhere)).where("city is not null"))
    first = cities_of.union(blank).groupBy("folded").agg(F.min("city").alias("city"))
    return folded.join(first, "folded").select("name", "city")


def match_places(df: DataFrame, key: str, candidates: Sequence[str], cities: DataFrame) -> DataFrame:
    """City of each row from its candidate columns, the first that matches winning.

    Distinct names are matched once, whatever the number of rows that use them.
    Returns ``(key, city)``; the city is NULL when no candidate matches.
    """
    ranked = df.select(F.col(key), F.posexplode(
        F.array(*[F.col(c) for c in candidates])).alias("rank", "name"))
    matched = match_names(ranked.select("name").distinct(), cities)
    order = F.struct("rank", "city")
    # min ignores rows without a match; NULL remains when there is none
    return (ranked.join(matched, "name", "left").groupBy(key)
            .agg(F.min(F.when(F.col("city").isNotNull(), order))["city"].alias("city")))
