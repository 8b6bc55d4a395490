"""SQL building blocks that restate views and rules for the side-by-side check."""

from __future__ import annotations

from catalogia import fixed_values as V
from catalogia.plans.tables import LANGS, PROFILES, items_sql


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def rx(pattern: str) -> str:
    return q(pattern.replace("(?U)", ""))


def is_in(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ", ".join(
        "(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in row) + ")" for row in rows
    )
    return f"{name}({columns}) as (values {body})"


def _per_profile(pick) -> list[tuple]:
    return [(lang, *row) for lang in LANGS for row in pick(PROFILES[lang])]


def _collabs(p: dict) -> list[tuple]:
    found: dict[str, list] = {}
    for c in p["discography"]["collaborators"]:
        for name in [c["name"], *c["aliases"]]:
            found[name] = c["songs"]
    return [(i, name, song) for i, (name, songs) in enumerate(found.items()) for song in songs or [""]]


def _tracks(p: dict) -> list[str]:
    return [t for a in p["discography"]["solo_albums"] for t in a["tracks"]]


def _concerts(p: dict) -> list[str]:
    d = p["discography"]
    return [n for c in d["concerts"] for n in [c["name"], *c["aliases"]]] + [
        c["name"] for c in d["group_concerts"]
    ]


PROFILE_CTES = ",\n".join([
    _values("p_names", "profile, term", _per_profile(lambda p: [
        (p["artist"]["names"]["primary"],), (p["artist"]["names"]["english"],),
        *[(a,) for a in p["artist"]["names"]["aliases"]],
    ])),
    _values("p_group", "profile, term", _per_profile(lambda p: [
        (n,) for n in ([p["group"]["name"], *p["group"]["aliases"]] if p["group"] else [])
    ])),
    _values("p_official", "profile, term", _per_profile(
        lambda p: [(c,) for c in p["artist"]["official_channels"]])),
    _values("p_labels", "profile, term", _per_profile(
        lambda p: [(c,) for c in p["artist"]["labels"]])),
    _values("p_tracks", "profile, term", _per_profile(lambda p: [(t,) for t in _tracks(p)])),
    _values("p_ost", "profile, term, src", _per_profile(
        lambda p: [(o["name"], o["source"]) for o in p["discography"]["ost_singles"]])),
    _values("p_vs", "profile, term", _per_profile(
        lambda p: [(o["name"],) for o in p["discography"]["variety_show_singles"]])),
    _values("p_concerts", "profile, term", _per_profile(lambda p: [(c,) for c in _concerts(p)])),
    _values("p_gconcerts", "profile, term", _per_profile(
        lambda p: [(c["name"].replace("SHE ", ""),) for c in p["discography"]["group_concerts"]])),
    _values("p_shows", "profile, term", _per_profile(
        lambda p: [(s["name"],) for s in p["discography"]["variety_shows"]])),
    _values("p_nets", "profile, term", _per_profile(
        lambda p: [(s["network"],) for s in p["discography"]["variety_shows"] if s["network"]]
        + [(n,) for n in V.TV_NETWORKS])),
    _values("p_collab", "profile, pos, term, song", _per_profile(_collabs)),
    _values("p_gmv", "profile, term", _per_profile(
        lambda p: [(t,) for t in p["discography"]["group_mvs"]])),
    _values("p_wrong", "profile, term", _per_profile(
        lambda p: [(t.lower(),) for t in p["discography"]["wrong_context_patterns"]]
        + [(t,) for t in V.WRONG_CONTEXT_DEFAULTS])),
    _values("p_west", "profile, term", _per_profile(
        lambda p: [(t.lower(),) for t in p["discography"]["western_artist_blacklist"]])),
    _values("p_cn", "profile, term", _per_profile(
        lambda p: [(t,) for t in p["discography"]["other_chinese_artist_blacklist"]])),
    _values("p_venues", "term", [(v,) for v in V.VENUES]),
    _values("p_media", "term", [(v,) for v in V.INTERVIEW_MEDIA]),
    _values("p_cats", "profile, id, key, label, sub, description, output_path", _per_profile(
        lambda p: [(c["id"], c["key"], c["label"], c["sub"], c["description"], c["output_path"])
                   for c in p["categories"]])),
    _values("p_heads", "profile, prim", _per_profile(
        lambda p: [(p["artist"]["names"]["primary"],)])),
])

SECONDS = """case len(string_split(duration, ':'))
  when 3 then try_cast(string_split(duration, ':')[1] as bigint) * 3600
    + try_cast(string_split(duration, ':')[2] as bigint) * 60
    + try_cast(string_split(duration, ':')[3] as bigint)
  when 2 then try_cast(string_split(duration, ':')[1] as bigint) * 60
    + try_cast(string_split(duration, ':')[2] as bigint) end"""

WHO = "coalesce(nullif(channel, ''), nullif(author, ''), '')"
VIEWS = "coalesce(nullif(view_count, 0), play_count)"

ITEMS = f"items as ({items_sql()})"


def _has(table: str, condition: str, profiled: bool = True) -> str:
    scope = "p.profile = b.profile and " if profiled else ""
    return f"exists (select 1 from {table} p where {scope}({condition}))"


_IN_TITLE = "contains(b.title, p.term)"
_IN_LC = "contains(b.t_lc, lower(p.term))"
_T = "regexp_matches(t_lc, {})"


def _t(pattern: str) -> str:
    return f"regexp_matches(t_lc, {rx(pattern)})"


BASE = f"""base as (
  select *, lower(title) as t_lc, {WHO} as who, {VIEWS} as plays, {SECONDS} as dur_s from items
)"""

FACTS = f"""solo_hits as (
  select b.profile, b.ord from base b join p_tracks t on t.profile = b.profile and contains(b.title, t.term)
  where not exists (select 1 from p_ost o where o.profile = t.profile and o.term = t.term
    and o.src <> '' and contains(b.title, o.src))
  group by all
),
song_counts as (
  select profile, ord, count(*) as n_songs from (
    select b.profile, b.ord, t.term, 'track' as what from base b
      join p_tracks t on t.profile = b.profile and contains(b.title, t.term)
    union select b.profile, b.ord, t.term, 'ost' from base b
      join p_ost t on t.profile = b.profile and contains(b.title, t.term)
  ) s group by profile, ord
),
collab_hits as (
  select profile, ord, arg_min(reason, pos) as collab_reason from (
    select b.profile, b.ord, c.pos,
      case when bool_or(c.song <> '' and contains(b.title, c.song)) then 'rule4_collab_known_song'
        when bool_or({_t(V.COLLAB_MARKER)} and {_has('p_names', _IN_LC)})
        then 'rule4_collab_pattern' end as reason
    from base b join p_collab c on c.profile = b.profile
      and (contains(b.title, c.term) or contains(b.t_lc, lower(c.term)))
    group by b.profile, b.ord, c.pos
  ) h where reason is not null group by profile, ord
),
facts as (
  select b.*,
    {_has('p_names', _IN_LC)} as artist,
    {_has('p_group', _IN_LC)} as grp,
    {_has('p_group', 'true')} as has_group,
    {_has('p_official', 'p.term = b.who')} as official,
    {_has('p_labels', 'p.term = b.who')} as label_channel,
    {_has('p_wrong', 'contains(b.t_lc, p.term)')} as wrong,
    {_has('p_west', 'contains(b.t_lc, p.term) or contains(lower(b.who), p.term)')} as western,
    {_has('p_cn', 'contains(b.title, p.term) or contains(b.who, p.term)')} as chinese,
    {_has('p_tracks', _IN_TITLE)} as track,
    {_has('p_tracks', _IN_LC)} as track_lc,
    {_has('p_ost', _IN_TITLE)} as ost,
    {_has('p_ost', _IN_LC)} as ost_lc,
    {_has('p_ost', "p.src <> '' and contains(b.title, p.term) and contains(b.title, p.src)")} as ost_src,
    {_has('p_ost', "contains(b.title, p.term) and not (exists (select 1 from p_tracks t where t.profile = p.profile and t.term = p.term) and p.src <> '' and not contains(b.title, p.src))")} as ost_released,
    {_has('p_ost', "contains(b.title, p.term) and not exists (select 1 from p_tracks t where t.profile = p.profile and t.term = p.term)")} as ost_only,
    {_has('p_vs', _IN_TITLE)} as vsingle,
    {_has('p_concerts', _IN_LC)} as concert,
    {_has('p_gconcerts', _IN_TITLE)} as gconcert,
    {_has('p_shows', _IN_TITLE)} as shown,
    {_has('p_shows', _IN_LC)} as show_lc,
    {_has('p_nets', 'contains(b.who, p.term) or contains(b.title, p.term)')} as network,
    {_has('p_gmv', _IN_LC)} as gtrack,
    {_has('p_collab', "p.song <> '' and contains(b.title, p.song)")} as csong,
    {_has('p_collab', _IN_TITLE)} as cname,
    {_has('p_collab', _IN_LC)} as cname_lc,
    {_has('p_venues', _IN_TITLE, False)} as venue,
    {_has('p_media', 'contains(b.who, p.term)', False)} as media,
    s.ord is not null as solo, coalesce(n.n_songs, 0) as n_songs, h.collab_reason
  from base b
  left join solo_hits s on s.profile = b.profile and s.ord = b.ord
  left join song_counts n on n.profile = b.profile and n.ord = b.ord
  left join collab_hits h on h.profile = b.profile and h.ord = b.ord
),
facts2 as (
  select *, {_t(V.LIVE)} as live, {_t(V.MV)} as mv,
    {_t(V.OTHER_CONCERT)} or concert or shown or {_t(V.OTHER_GALA)} or {_t(V.OTHER_INTERVIEW)}
      or {_t(V.OTHER_COLLAB)} or cname as other,
    not shown and (((track or ost or gtrack) and (concert
      or ({_t(V.SONG_LIVE)} and not {_t(V.SONG_INTERVIEW_FRAME)}))) or n_songs >= 2) as performance,
    artist or grp as either
  from facts
)"""

CLASSIFIED = f"""reasoned as (
  select *, case
    when wrong then 'rule0_wrong_context'
    when western and not artist then 'rule0_western_blacklist'
    when chinese and not artist then 'rule0_chinese_blacklist'
    when not (official or artist or grp or track or concert or ost or shown or gtrack or csong
      or venue) then 'rule0_artist_not_primary'
    when official and not grp and {_t(V.OFFICIAL_MV)} then 'rule1_official_mv'
    when not live and mv and solo and not grp then 'rule1_known_track_mv'
    when not live and not other and solo and artist and not grp then 'rule1_known_track_broad'
    when has_group and grp and mv and not live then 'rule2_she_mv'
    when has_group and not live and gtrack and mv then 'rule2_she_known_track_mv'
    when has_group and not live and not other and grp and gtrack then 'rule2_she_known_track_broad'
    when ost_src and not live then 'rule3_ost_with_source'
    when ost_released and {_t(V.OST_MARKER)} and not live then 'rule3_ost_official'
    when vsingle and {_t(V.SINGLE_MARKER)} then 'rule3_variety_single'
    when not live and ost_only and artist then 'rule3_ost_broad'
    when collab_reason is not null then collab_reason
    when concert then 'rule5_known_concert'
    when gconcert then 'rule5_she_concert'
    when {_t(V.CONCERT_KEYWORD)} and either then 'rule5_concert_keyword'
    when dur_s > {V.LONG_LIVE_SECONDS} and {_t(V.LONG_LIVE)} and artist and not shown then 'rule5_long_live'
    when venue and either and {_t(V.VENUE_LIVE)} then 'rule5_venue'
    when not performance and shown
      and not ({_t(V.SHOW_INTERVIEW)} and not {_t(V.SHOW_PERFORMANCE)}) then 'rule6_known_show'
    when not performance and not shown and network and either then 'rule6_tv_network'
    when not performance and not shown and {_t(V.GALA)} and either then 'rule6_award_gala'
    when not performance and not shown and either
      and regexp_matches(title, {rx(V.EPISODE_RAW_TITLE)}) then 'rule6_episode_pattern'
    when not performance and {_t(V.INTERVIEW_KEYWORD)} then 'rule7_interview_keyword'
    when not performance and {_t(V.BEHIND_SCENES)} then 'rule7_behind_scenes'
    when not performance and {_t(V.NEWS)} and artist then 'rule7_news'
    when not performance and media and either then 'rule7_media_channel'
    else 'no_rule_match' end as classification_reason
  from facts2
),
classified as (
  select *, case substr(classification_reason, 1, 5)
    when 'rule0' then 'discard' when 'rule1' then 'personal_mv' when 'rule2' then 'group_mv'
    when 'rule3' then 'ost_singles' when 'rule4' then 'collabs' when 'rule5' then 'concerts'
    when 'rule6' then 'variety' when 'rule7' then 'interviews' else 'unclassified' end as category
  from reasoned
)"""

_BANDS = ", ".join(f"({q(c)}, {a}, {b}, {d}, {e})" for c, (a, b, d, e) in V.DURATION_BANDS.items())
_TOTAL = sum(V.SIGNAL_WEIGHTS.values())


def scored_cte(source: str, name: str) -> str:
    """Signals and confidence of the rows of ``source``, which holds all facts."""
    return f"""{name}_signals as (
  select s.*,
    case when classification_reason in {is_in(V.STRONG_REASONS)} then 1e0
      when classification_reason in {is_in(V.MEDIUM_REASONS)} then 0.7e0
      when starts_with(classification_reason, 'llm_') then 0.5e0
      when classification_reason = 'no_rule_match' then 0e0 else 0.6e0 end as s_rule,
    case when official then 1e0
      when contains(who, '- Topic') or contains(who, '- 主題') then 0.85e0
      when source = 'youtube' and verified then 0.7e0
      when source = 'bilibili' and verified then 0.6e0
      when label_channel then 0.9e0 when not verified then 0.3e0 else 0.5e0 end as s_source,
    case when dur_s is null or r.lo is null then 0.5e0
      when dur_s between r.ilo and r.ihi then 1e0
      when dur_s between r.lo and r.ilo
        then cast(printf('%.2f', 0.4e0 * (dur_s - r.lo) / (r.ilo - r.lo) + 0.6e0) as double)
      when dur_s between r.ihi and r.hi
        then cast(printf('%.2f', 0.4e0 * (r.hi - dur_s) / (r.hi - r.ihi) + 0.6e0) as double)
      else 0.2e0 end as s_duration,
    case when plays >= 1000000 then 1e0 when plays >= 100000 then 0.85e0
      when plays >= 10000 then 0.7e0 when plays >= 1000 then 0.55e0 else 0.4e0 end as s_views,
    case category
      when 'personal_mv' then case when {_t(V.OFFICIAL_MV)} then 1e0
        when regexp_matches(t_lc, '(^|[^\\p{{L}}\\p{{N}}_])mv($|[^\\p{{L}}\\p{{N}}_])|music\\s*video') then 0.8e0
        when track_lc then 0.6e0 else 0.3e0 end
      when 'group_mv' then case
        when grp and regexp_matches(t_lc, '(^|[^\\p{{L}}\\p{{N}}_])mv($|[^\\p{{L}}\\p{{N}}_])|music\\s*video') then 1e0
        when grp or regexp_matches(t_lc, '(^|[^\\p{{L}}\\p{{N}}_])mv($|[^\\p{{L}}\\p{{N}}_])|music\\s*video') then 0.6e0
        else 0.3e0 end
      when 'concerts' then case when {_t(V.CONCERT_KEYWORD)} then 1e0
        when {_t(V.SCORE_CONCERT_LIVE)} then 0.7e0 else 0.3e0 end
      when 'variety' then case when show_lc then 1e0 when {_t(V.SCORE_GALA)} then 0.8e0 else 0.3e0 end
      when 'interviews' then case when {_t(V.INTERVIEW_KEYWORD)} then 1e0
        when {_t(V.SCORE_BEHIND)} then 0.8e0 else 0.3e0 end
      when 'ost_singles' then case when ost_lc then 0.9e0 when {_t(V.SCORE_OST)} then 0.8e0
        else 0.3e0 end
      when 'collabs' then case when {_t(V.SCORE_COLLAB)} then 1e0 when cname_lc then 0.8e0
        else 0.3e0 end
      else 0.5e0 end as s_title
  from {source} s left join (values {_BANDS}) r(cat, lo, ilo, ihi, hi) on r.cat = s.category
),
{name} as (
  select *, case when category = 'discard' then s_rule else round((s_rule * 0.35e0
    + s_source * 0.2e0 + s_duration * 0.1e0 + s_views * 0.1e0 + s_title * 0.25e0)
    / {_TOTAL!r}e0, 3) end as confidence
  from {name}_signals
)"""


SCORED = scored_cte("classified", "scored")

_LIMITS = " ".join(f"when {q(c)} then {n}" for c, n in V.VIEW_THRESHOLDS.items())
FILTERED = f"""filtered as (
  select * replace (
    case when low then 'discard' else category end as category,
    case when low then 'filtered_low_views' else classification_reason end as classification_reason
  ) from (
    select *, category not in ('discard', 'unclassified') and coalesce(plays, 0) <> 0 and not official
      and plays < case category {_LIMITS} else {V.VIEW_THRESHOLD_DEFAULT} end as low
    from scored
  ) f
)"""

_CHAIN = {
    "items": ITEMS, "profiles": PROFILE_CTES, "base": BASE, "facts": FACTS,
    "classified": CLASSIFIED, "scored": SCORED, "filtered": FILTERED,
}


def with_ctes(upto: str, query: str, *more: str, items: str | None = None) -> str:
    """``query`` after every CTE up to the named one, and any extra ones.

    ``items`` replaces the CTEs that end in the item rows.
    """
    names = list(_CHAIN)
    chain = {**_CHAIN, "items": items or ITEMS}
    parts = [chain[n] for n in names[: names.index(upto) + 1]]
    return "with " + ",\n".join([*parts, *more]) + "\n" + query
