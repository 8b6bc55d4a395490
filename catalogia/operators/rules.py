"""Classification: one ordered waterfall of conditions, first match wins.

Everything is a SQL condition over an item row that carries the dictionaries of its
profile in ``_p``.  Facts that several rules ask for are projected once; facts that only
later rules need stay null for rows that rule 0 already settles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalogia import fixed_values as V
from catalogia.functions import duration_seconds, title, title_lc, who
from catalogia.operators.automaton import attach_found, worthwhile
from catalogia.operators.profiles import DICTIONARY, wide, with_dictionary

_RESULT = ["category", "classification_reason"]

_CATEGORY_OF_RULE = {
    "rule0": V.DISCARD, "rule1": "personal_mv", "rule2": "group_mv", "rule3": "ost_singles",
    "rule4": "collabs", "rule5": "concerts", "rule6": "variety", "rule7": "interviews",
}


def has(terms: str, text: str = "_t") -> str:
    """SQL: some dictionary entry is a substring of the text."""
    return f"exists({DICTIONARY}.{terms}, x -> contains({text}, x))"


def has_word(terms: str, text: str) -> str:
    """SQL: like ``has``, but the entry must not touch a letter or digit."""
    bounded = r"concat(r'(?<![\p{L}\p{N}])\Q', x, r'\E(?![\p{L}\p{N}])')"
    return f"exists({DICTIONARY}.{terms}, x -> rlike({text}, {bounded}))"


def _required(branch: str) -> tuple[str, bool] | None:
    """The longest text that every match of a branch holds, and whether the branch is that text alone.

    None where the branch has more than characters, escapes and the quantifiers ``?*+``.
    """
    runs, whole, at = [""], True, 0
    while at < len(branch):
        c = branch[at]
        if c in "()[]{}^$|.?*+":
            return None
        plain = c != "\\" or not branch[at + 1].isalnum()
        size = 1 if c != "\\" else 2
        counted = branch[at + size:at + size + 1]
        counted = counted if counted and counted in "?*+" else ""
        if plain and not counted:
            runs[-1] += branch[at + size - 1]
        else:
            runs.append("")
            whole = False
        at += size + len(counted)
    return max(runs, key=len), whole


def matches(pattern: str, text: str = "_t_lc") -> str:
    """SQL: the pattern occurs in the text.

    An alternation is tried branch by branch at every character, so branches without pattern signs
    are looked for as substrings, and the pattern only where a text that one of the others needs occurs.
    """
    flag = "(?U)" if pattern.startswith("(?U)") else ""
    branches = pattern.removeprefix(flag).split("|")
    needed = [_required(b) for b in branches]
    if any(n is None or not n[0] for n in needed):
        return f"rlike({text}, r'{pattern}')"
    found = [f"contains({text}, '{n}')" for n, whole in needed if whole]
    signs = [(n, b) for (n, whole), b in zip(needed, branches, strict=True) if not whole]
    if signs:
        held = " or ".join(f"contains({text}, '{n}')" for n in dict.fromkeys(n for n, _ in signs))
        found.append(f"(({held}) and rlike({text}, r'{flag}{'|'.join(b for _, b in signs)}'))")
    return f"({' or '.join(found)})"


def _first_of(*rules: tuple[str, str]) -> str:
    """SQL: reason of the first condition that holds."""
    branches = " ".join(f"when {condition} then '{reason}'" for reason, condition in rules)
    return f"case {branches} end"


def _facts(word_boundary: bool) -> dict[str, str]:
    """Facts every row needs for rule 0."""
    listed = has_word if word_boundary else has
    return {
        "_artist": has("names_lc", "_t_lc"),
        "_group": has("group_lc", "_t_lc"),
        "_official": f"array_contains({DICTIONARY}.official, _who)",
        "_wrong": has("wrong_context", "_t_lc"),
        "_western": f"{listed('western_lc', '_t_lc')} or {listed('western_lc', '_who_lc')}",
        "_chinese": f"{listed('chinese', '_t')} or {listed('chinese', '_who')}",
        "_track": has("tracks"),
        "_ost": has("ost_names"),
        "_show": has("shows"),
        "_concert": f"{has('concerts_lc', '_t_lc')} or {has('concerts')}",
        "_group_track": has("group_mvs_lc", "_t_lc"),
    }


_KNOWN = (
    "_official or _artist or _group or _track or _concert or _ost or _show or _group_track or "
    f"{has('collab_songs')} or {has('venues')}"
)
_RULE0 = _first_of(
    ("rule0_wrong_context", "_wrong"),
    ("rule0_western_blacklist", "not _artist and _western"),
    ("rule0_chinese_blacklist", "not _artist and _chinese"),
    ("rule0_artist_not_primary", f"not ({_KNOWN})"),
)

_SONG = "(_track or _ost or _group_track)"
_LATER_FACTS = {
    "_live": matches(V.LIVE),
    "_mv": matches(V.MV),
    # Signs of a category other than a music video.
    "_other": " or ".join([
        matches(V.OTHER_CONCERT), has("concerts_lc", "_t_lc"), "_show", matches(V.OTHER_GALA),
        matches(V.OTHER_INTERVIEW), matches(V.OTHER_COLLAB),
        f"exists({DICTIONARY}.collabs, c -> contains(_t, c.name))",
    ]),
    # A known track outside the film or drama that also uses it.
    "_solo": f"_track and exists({DICTIONARY}.solo, s -> contains(_t, s.track) "
             "and not exists(s.sources, x -> contains(_t, x)))",
    # A song performance rather than a show or an interview.
    "_performance": f"not _show and (({_SONG} and _concert) or ({_SONG} and "
                    f"{matches(V.SONG_LIVE)} and not {matches(V.SONG_INTERVIEW_FRAME)}) or "
                    f"size(filter({DICTIONARY}.tracks, x -> contains(_t, x))) + "
                    f"size(filter({DICTIONARY}.ost_names, x -> contains(_t, x))) >= 2)",
    "_either": "_artist or _group",
}


def _ost(condition: str) -> str:
    return f"exists({DICTIONARY}.ost, o -> contains(_t, o.name) and {condition})"


_RULE1 = f"if(_group, null, {_first_of(
    ('rule1_official_mv', f'_official and {matches(V.OFFICIAL_MV)}'),
    ('rule1_known_track_mv', 'not _live and _mv and _solo'),
    ('rule1_known_track_broad', 'not _live and not _other and _artist and _solo'),
)})"
_RULE2 = f"if({DICTIONARY}.has_group and not _live, {_first_of(
    ('rule2_she_mv', '_group and _mv'),
    ('rule2_she_known_track_mv', '_group_track and _mv'),
    ('rule2_she_known_track_broad', 'not _other and _group and _group_track'),
)}, null)"
_RULE3 = _first_of(
    ("rule3_ost_with_source",
     f"not _live and _ost and {_ost("o.source <> '' and contains(_t, o.source)")}"),
    ("rule3_ost_official", f"not _live and _ost and {matches(V.OST_MARKER)} and " + _ost(
        "not (o.also_track and o.source <> '' and not contains(_t, o.source))"
    )),
    ("rule3_variety_single", f"{matches(V.SINGLE_MARKER)} and {has('variety_singles')}"),
    ("rule3_ost_broad", f"not _live and _ost and _artist and {_ost('not o.also_track')}"),
)
# Reason of the first collaborator, in profile order, that matches either way.
_NAMED = (
    f"filter({DICTIONARY}.collabs, c -> contains(_t, c.name) or contains(_t_lc, c.name_lc))"
)
_COLLAB_REASONS = f"transform({_NAMED}, c -> {_first_of(
    ('rule4_collab_known_song', 'exists(c.songs, x -> contains(_t, x))'),
    ('rule4_collab_pattern', f'_artist and {matches(V.COLLAB_MARKER)}'),
)})"
_RULE4 = f"get(filter({_COLLAB_REASONS}, r -> r is not null), 0)"
_RULE5 = _first_of(
    ("rule5_known_concert", "_concert"),
    ("rule5_she_concert", has("group_concerts_short")),
    ("rule5_concert_keyword", f"_either and {matches(V.CONCERT_KEYWORD)}"),
    ("rule5_long_live", f"_seconds > {V.LONG_LIVE_SECONDS} and _artist and not _show "
                        f"and {matches(V.LONG_LIVE)}"),
    ("rule5_venue", f"_either and {matches(V.VENUE_LIVE)} and {has('venues')}"),
)
_ONLY_TALK = f"({matches(V.SHOW_INTERVIEW)} and not {matches(V.SHOW_PERFORMANCE)})"
_RULE6 = f"case when _performance then null when _show then if({_ONLY_TALK}, null, " + (
    f"'rule6_known_show') else {_first_of(
        ('rule6_tv_network',
         f"_either and ({has('networks', '_who')} or {has('networks')})"),
        ('rule6_award_gala', f'_either and {matches(V.GALA)}'),
        ('rule6_episode_pattern', f"_either and {matches(V.EPISODE_RAW_TITLE, '_t')}"),
    )} end"
)
_RULE7 = f"if(_performance, null, {_first_of(
    ('rule7_interview_keyword', matches(V.INTERVIEW_KEYWORD)),
    ('rule7_behind_scenes', matches(V.BEHIND_SCENES)),
    ('rule7_news', f'_artist and {matches(V.NEWS)}'),
    ('rule7_media_channel', f"_either and {has('media', '_who')}"),
)})"
_REASON = "coalesce(" + ", ".join([
    "_rule0", _RULE1, _RULE2, _RULE3, _RULE4, _RULE5, _RULE6, _RULE7, "'no_rule_match'",
]) + ")"


def category_of(reason: str) -> Column:
    branches = " ".join(
        f"when '{rule}' then '{category}'" for rule, category in _CATEGORY_OF_RULE.items()
    )
    return F.expr(f"case left({reason}, 5) {branches} else '{V.UNCLASSIFIED}' end")


def settle(df: DataFrame, kept: list[str], **results: Column) -> DataFrame:
    """``kept`` columns plus ``results``, each computed once per row.

    The results come out of a one-row ``inline``.  A later filter on them is applied to
    the values instead of being rewritten in terms of every condition behind them.
    """
    row = F.struct(*[value.alias(name) for name, value in results.items()])
    return df.select(*kept, F.inline(F.array(row)))


def classify(
    items: DataFrame, profiles: DataFrame, word_boundary: bool = False, keep_dictionary=False,
    way: str = "measured", **lists,
) -> DataFrame:
    """Items plus ``category`` and ``classification_reason``.

    ``way``: "scan" tests each name of the profile on each title; "automaton" finds the names that
    occur in one pass and tests those; "measured" takes the latter for large profiles.  Both give
    the same rows.
    """
    kept = [c for c in items.columns if c not in (*_RESULT, DICTIONARY)]
    if way == "automaton" or (way == "measured" and DICTIONARY not in items.columns and worthwhile(wide(profiles, **lists))):
        items = attach_found(items, profiles, **lists)
    named = with_dictionary(items, profiles, **lists).select(
        *kept, DICTIONARY, title().alias("_t"), title_lc().alias("_t_lc"), who().alias("_who"),
        F.lower(who()).alias("_who_lc"), duration_seconds(F.col("duration")).alias("_seconds"),
    )
    facts = {name: F.expr(sql) for name, sql in _facts(word_boundary).items()}
    later = {name: F.expr(f"if(_rule0 is null, {sql}, null)") for name, sql in _LATER_FACTS.items()}
    reasoned = (
        named.withColumns(facts).withColumn("_rule0", F.expr(_RULE0)).withColumns(later)
        .withColumn("_reason", F.expr(_REASON))
    )
    return settle(
        reasoned, [*kept, DICTIONARY] if keep_dictionary else kept,
        category=category_of("_reason"), classification_reason=F.col("_reason"),
    )
