"""Search queries from profile dimensions and a table of templates."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.operators.distribution import attach, dealt, first_by
from catalogia.operators.profiles import dims as profile_dims

_PLACEHOLDER = re.compile(r"\{(\w+)\}")
_HEAD_FIELDS = ["primary", "english", "group", "group_alias"]
_ENTRY_FIELDS = sorted(
    {f for t in V.QUERY_TEMPLATES for f in _PLACEHOLDER.findall(t[4])} - set(_HEAD_FIELDS)
)
# Dimensions that exist only for a profile with a group.
_GROUP_ONLY = [
    "group", "group_alias", "group_concerts", "group_shows", "group_tracks", "group_tracks_first",
]


def _render(text: str) -> str:
    """SQL that fills the placeholders of a template from columns."""
    parts = [
        f"`{piece}`" if i % 2 else f"'{piece}'"
        for i, piece in enumerate(_PLACEHOLDER.split(text)) if piece
    ]
    return f"concat({', '.join(parts)})"


def _templates() -> str:
    """SQL: for the dimension of a row, the list of its queries."""
    rows: dict[str, list[str]] = {}
    for k, (dim, step, phase, tool, text, page, category) in enumerate(V.QUERY_TEMPLATES):
        rows.setdefault(dim, []).append(
            f"struct(struct({step} as step, i, {phase} as phase, j, {k} as k) as ord, "
            f"'{tool}' as tool, {_render(text)} as query, {page} as page, '{category}' as category)"
        )
    return "case dim " + " ".join(
        f"when '{dim}' then array({', '.join(structs)})" for dim, structs in rows.items()
    ) + " end"


# What an entry of a kind holds besides its places; absent fields are null.
ENTRY = ", ".join([
    "kind string", "i bigint", "j bigint", "n_songs bigint", "network string", *[f"{f} string" for f in _ENTRY_FIELDS]])
_KIND_FIELDS = ["n_songs", "network", *_ENTRY_FIELDS]


def entry_sql(kind: str, i: str, j: str = "0", **fields: str) -> str:
    """SQL: one entry struct; fields are SQL expressions."""
    values = [f"cast({fields.get(f, 'null')} as {'bigint' if f == 'n_songs' else 'string'}) as {f}" for f in _KIND_FIELDS]
    return f"struct('{kind}' as kind, cast({i} as bigint) as i, cast({j} as bigint) as j, {', '.join(values)})"


_SOURCED = "coalesce(source, '') <> ''"
# Dimensions that the entries of a kind belong to, with conditions on their fields.
_DIMS_OF_KIND = {
    "tracks": [("tracks", "true")], "albums": [("albums", "true")], "aliases": [("aliases", "true")],
    "ost": [("ost", "true"), ("ost_with_source", _SOURCED), ("ost_other_source", f"{_SOURCED} and source <> name"),
            ("ost_no_source", f"not ({_SOURCED})")],
    "variety_singles": [("variety_singles", "true")], "concerts": [("concerts", "true")],
    "concert_aliases": [("concert_aliases", "true")], "concert_venues": [("concert_venues", "true")],
    "group_concerts": [("group_concerts", "true")],
    "shows": [("shows", "true"), ("group_shows", "coalesce(network, '') <> ''")],
    "interviewers": [("interviewers", "true")], "interview_channels": [], "group_mvs": [("group_tracks", "true")],
    "collabs": [("collab_no_songs", "n_songs = 0")], "collab_songs": [("collab_songs", "true")],
    "collab_aliases": [("collab_aliases", "true")],
}
# Kinds whose first entries are a dimension of their own: (dimension, how many, per what besides the profile).
_FIRST_OF_KIND = {
    "tracks": ("tracks_first", V.TRACKS_PER_ALBUM, "i"), "ost": ("ost_first", V.TOP_OST, "0"),
    "interview_channels": ("channels_first", V.TOP_MEDIA_CHANNELS, "0"),
    "group_mvs": ("group_tracks_first", V.TOP_GROUP_TRACKS, "0"),
}


# Documents that one task turns into entries.
DOCUMENTS = 1_000


def document_entries(profiles: DataFrame) -> DataFrame:
    """(profile, kind, i, j, fields..) of every list of the profile documents, which are dealt over tasks first."""
    d = "discography"

    def each(path, make):
        return f"transform(coalesce({path}, array()), (e, p) -> {make})"

    def inner(path, owner, make):
        return f"flatten(transform(coalesce({path}, array()), (o, q) -> transform(coalesce({owner}, array()), (e, p) -> {make})))"

    short = "coalesce(get(o.aliases, 0), o.name)"
    lists = [
        each("_aliases", entry_sql("aliases", "p", alias="e")),
        each(f"{d}.solo_albums", entry_sql("albums", "p", album="e.name", year="e.year")),
        inner(f"{d}.solo_albums", "o.tracks", entry_sql("tracks", "q", "p", album="o.name", track="e")),
        each(f"{d}.ost_singles", entry_sql("ost", "p", name="e.name", source="e.source")),
        each(f"{d}.variety_show_singles", entry_sql("variety_singles", "p", name="e.name", source="e.source")),
        each(f"{d}.concerts", entry_sql("concerts", "p", name="e.name")),
        inner(f"{d}.concerts", "o.aliases", entry_sql("concert_aliases", "q", "p", alias="e")),
        inner(f"{d}.concerts", "o.venues", entry_sql("concert_venues", "q", "p", venue="e", short_name=short)),
        each(f"{d}.group_concerts", entry_sql("group_concerts", "p", name="e.name")),
        each(f"{d}.variety_shows", entry_sql("shows", "p", name="e.name", network="e.network")),
        each(f"{d}.notable_interviewers", entry_sql("interviewers", "p", name="e")),
        each(f"{d}.interview_channels", entry_sql("interview_channels", "p", name="e")),
        each(f"{d}.group_mvs", entry_sql("group_mvs", "p", track="e")),
        each(f"{d}.collaborators", entry_sql("collabs", "p", name="e.name", n_songs="coalesce(size(e.songs), 0)")),
        inner(f"{d}.collaborators", "o.songs", entry_sql("collab_songs", "q", "p", collab="o.name", song="e")),
        inner(f"{d}.collaborators", "o.aliases", entry_sql("collab_aliases", "q", "p", alias="e")),
    ]
    read = profiles.select("profile", F.col("artist.names.aliases").alias("_aliases"), d)
    return dealt(read, DOCUMENTS).select("profile", F.inline(F.expr(f"concat({', '.join(lists)})")))


def dims_of_documents(profiles: DataFrame) -> dict[str, DataFrame]:
    """What query generation and search plans need of the profile documents."""
    return {"entries": document_entries(profiles), **profile_dims(profiles, "profiles", "categories")}


def _entries(entries: DataFrame) -> DataFrame:
    """Entries with the dimension (``dim``) of the templates that they fill, once per dimension."""
    kinds = " ".join(
        f"when '{kind}' then filter(array({', '.join(f"if({condition}, '{dim}', null)" for dim, condition in dims)}), x -> x is not null)"
        for kind, dims in _DIMS_OF_KIND.items() if dims)
    every = entries.withColumn("dim", F.explode(F.expr(f"case kind {kinds} end")))
    firsts = " ".join(f"when '{kind}' then {per}" for kind, (_, _, per) in _FIRST_OF_KIND.items())
    names = " ".join(f"when '{kind}' then '{dim}'" for kind, (dim, _, _) in _FIRST_OF_KIND.items())
    limits = " ".join(f"when '{kind}' then {n}" for kind, (_, n, _) in _FIRST_OF_KIND.items())
    listed = entries.filter(F.col("kind").isin(list(_FIRST_OF_KIND))).withColumn("_per", F.expr(f"case kind {firsts} end"))
    first = first_by(listed, ["profile", "kind", "_per"], ["i", "j"], max(n for _, n, _ in _FIRST_OF_KIND.values()), "_rank")
    kept = first.filter(F.expr(f"_rank <= case kind {limits} end")).withColumn("dim", F.expr(f"case kind {names} end"))
    return every.unionByName(kept.drop("_rank", "_per"))


def emitted_queries(dims: dict[str, DataFrame]) -> DataFrame:
    """Every query the templates give, repeats included, with its place of emission.

    ``dims``: ``entries`` (see ``document_entries``) and ``profiles``, one row each.
    """
    heads = dims["profiles"].select(
        "profile", "primary", "english", F.col("group_name").alias("group"), "group_alias"
    )
    alone = heads.select("*", F.explode(F.array(
        *[F.lit(d) for d in ("primary", "other_english", "group", "group_alias")]
    )).alias("dim"), F.lit(0).cast("bigint").alias("i"), F.lit(0).cast("bigint").alias("j"))
    named = attach(_entries(dims["entries"]), heads, ["profile"], ["i", "j"], "inner")
    rows = named.unionByName(alone, allowMissingColumns=True).filter(
        (~F.col("dim").isin(_GROUP_ONLY) | F.col("group").isNotNull())
        & ((F.col("dim") != "group_alias") | F.col("group_alias").isNotNull())
        & ((F.col("dim") != "other_english") | (F.col("english") != F.col("primary")))
    )
    return rows.select("profile", F.inline(F.expr(_templates())))


def gen_queries(dims: dict[str, DataFrame]) -> DataFrame:
    """Distinct queries; the category that emits one first owns it."""
    return emitted_queries(dims).groupBy("profile", "tool", "query", "page").agg(
        F.min_by("category", "ord").alias("category"), F.min("ord").alias("ord")
    )


def search_plan(queries: DataFrame, dims: dict[str, DataFrame], nested=False) -> DataFrame:
    """Categories in profile order with their queries; those without queries stay.

    One row per query, in (``pos``, ``ord``) order; ``nested`` gives one row per category.
    """
    heads = dims["profiles"].select("profile", "primary")
    categories = dims["categories"].join(heads, "profile").select(
        "profile", "pos", F.col("id").alias("file_id"), F.col("key").alias("category"),
        "output_path", F.concat("primary", "label").alias("title"), "description",
    )
    # The long side, queries, is never shuffled to meet its category.
    named = attach(
        queries, categories, ["profile", "category"], ["tool", "query", "page"], "inner"
    )
    used = queries.select("profile", "category").distinct()
    unused = categories.join(used, ["profile", "category"], "left_anti")
    flat = named.unionByName(unused, allowMissingColumns=True)
    if not nested:
        return flat
    search = F.when(F.col("query").isNotNull(), F.struct("ord", "tool", "query", "page"))
    return flat.groupBy(*categories.columns).agg(
        F.array_sort(F.collect_list(search)).alias("searches")
    )


def query_counts(queries: DataFrame) -> DataFrame:
    """Number of queries by tool and by category in one pass."""
    return queries.groupingSets(
        [["profile", "tool"], ["profile", "category"]], "profile", "tool", "category"
    ).agg(F.count(F.lit(1)).alias("n"))
