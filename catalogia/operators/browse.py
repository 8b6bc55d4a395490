"""Searching, filtering and sorting a catalogue, and its navigation counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions import title_lc
from catalogia.functions.nearness import near_window


def _pieces(text: str, n: int) -> list[str]:
    size, extra = divmod(len(text), n)
    cuts = [i * size + min(i, extra) for i in range(n + 1)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if b > a]


def matches_text(text: Column, q: str, allowed: int) -> Column:
    """A lower-case text holds the query, or a window of its length within the allowed edits.

    With k edits allowed, one of k + 1 pieces of the query is untouched and therefore in the text;
    only such texts are compared, all their windows at once.
    """
    exact = F.contains(text, F.lit(q))
    if not q or allowed == 0:
        return exact
    candidate = F.lit(False)
    for piece in _pieces(q, allowed + 1):
        candidate = candidate | F.contains(text, F.lit(piece))
    # Texts that need no look are null to the comparison.
    asked = F.when(candidate & ~exact, text)
    return exact | near_window(asked, q, allowed)


def title_matches(query: str, tolerance: float = V.SEARCH_TOLERANCE) -> Column:
    """The query is in the title, or a window of its length is within the edit tolerance."""
    q = query.strip().lower()
    return matches_text(title_lc(), q, int(len(q) * tolerance)) if q else F.lit(True)


def search_titles(items: DataFrame, query: str, tolerance: float = V.SEARCH_TOLERANCE) -> DataFrame:
    return items.filter(title_matches(query, tolerance))


def filter_platform(items: DataFrame, platform: str = "all") -> DataFrame:
    return items if platform == "all" else items.filter(F.col("source") == platform)


def plays() -> Column:
    """View count unless absent (0 counts as present), else play count, else 0."""
    return F.coalesce(F.col("view_count"), F.col("play_count"), F.lit(0))


def sort_items(items: DataFrame, sort: str = "plays", desc: bool = True) -> DataFrame:
    key = F.coalesce("published_at", F.lit("")) if sort == "date" else plays()
    return items.orderBy(F.desc(key) if desc else F.asc(key), "profile", "file_id", "ord")


def browse(
    items: DataFrame, query: str = "", platform: str = "all", sort: str = "plays",
    desc: bool = True, limit: int | None = None, offset: int = 0,
) -> DataFrame:
    """A page of the catalogue; sorting replaces any order by relevance."""
    found = sort_items(filter_platform(search_titles(items, query), platform), sort, desc)
    if offset:
        found = found.offset(offset)
    return found if limit is None else found.limit(limit)


def facets(items: DataFrame, query: str = "", platform: str = "all") -> DataFrame:
    """Counts per platform and of the rows that the current filters show."""
    shown = title_matches(query)
    if platform != "all":
        shown = shown & (F.col("source") == platform)
    return items.groupBy("profile", "category").agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(F.col("source") == "youtube").alias("n_youtube"),
        F.count_if(F.col("source") == "bilibili").alias("n_bilibili"),
        F.count_if(shown).alias("n_shown"),
    )


def category_items(items: DataFrame, profile: str, category: str) -> DataFrame:
    return items.filter((F.col("profile") == profile) & (F.col("category") == category))


def nav_counts(items: DataFrame, categories: DataFrame) -> DataFrame:
    """Items per navigation entry, empty entries included, plus a TOTAL row per profile."""
    counted = items.groupBy("profile", "category").agg(F.count(F.lit(1)).alias("n"))
    listed = categories.select(
        "profile", F.col("key").alias("category"), "label", F.coalesce("sub", F.lit("")).alias("sub")
    )
    filled = listed.join(counted, ["profile", "category"], "left").fillna(0, ["n"])
    summed = filled.groupingSets(
        [["profile", "category", "label", "sub"], ["profile"]], "profile", "category", "label", "sub"
    ).agg(F.sum("n").alias("n"), F.grouping("category").alias("_total"))
    return summed.select(
        "profile", F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("category")).alias(
            "category"
        ), "label", "sub", "n",
    )


def profiles_with_data(profiles: DataFrame, items: DataFrame) -> DataFrame:
    """Profiles with an English name that have items in the catalogue."""
    named = profiles.filter(F.coalesce("artist.names.english", F.lit("")) != "")
    return named.join(items.select("profile").distinct(), "profile", "left_semi")


def landing_cards(profiles: DataFrame) -> DataFrame:
    """Card line (year · genre · first award, without empty parts) and category count."""
    award = F.get(F.coalesce("artist.awards", F.array().cast("array<string>")), F.lit(0))
    parts = F.array(F.col("artist.birth_year").cast("string"), F.col("artist.genre"), award)
    filled = F.filter(parts, lambda p: F.coalesce(p, F.lit("")) != "")
    return profiles.select(
        "profile", F.col("artist.names.primary").alias("primary"),
        F.col("artist.names.english").alias("english"),
        F.array_join(filled, " · ").alias("card"), F.size("categories").alias("n_categories"),
    )
