"""Fixed values.

Everything in this module is a constant that results depend on: word lists,
patterns, thresholds, ranges and text formats.  Patterns run on the lower-cased
title unless the name says otherwise.  ``(?U)`` makes ``\\s``, ``\\d`` and ``\\b``
Unicode-aware in the JVM.
"""

# Category key -> file id.
CATEGORY_FILE_IDS = {
    "personal_mv": 2,
    "ost_singles": 3,
    "concerts": 4,
    "variety": 5,
    "interviews": 6,
    "group_mv": 7,
    "collabs": 8,
}
DISCARD = "discard"
UNCLASSIFIED = "unclassified"

# Title patterns of the rule waterfall.
LIVE = "live|演唱会|演唱會|concert|现场|現場|演出"
OTHER_CONCERT = "演唱会|演唱會|concert|巡演|巡迴"
OTHER_GALA = r"(?U)颁奖|頒獎|晚会|晚會|典礼|典禮|盛典|跨年|第\d+期|EP\d+"
OTHER_INTERVIEW = (
    "采访|採訪|专访|專訪|访谈|訪談|interview|幕后|幕後|花絮|记者会|記者會|发布会|發布會"
)
OTHER_COLLAB = r"feat|ft\.|合唱|合作|duet|×"
SONG_LIVE = "live|現場|现场|演唱會|演唱会|concert"
SONG_INTERVIEW_FRAME = "采访|採訪|专访|專訪|访谈|訪談|interview|幕后|幕後"
OFFICIAL_MV = r"(?U)official\s*mv|official\s*music\s*video|官方\s*mv"
MV = r"(?U)mv|music\s*video"
OST_MARKER = r"(?U)official|mv|官方|music\s*video|lyrics?\s*video|lyric"
SINGLE_MARKER = "单曲|digital|数位"
COLLAB_MARKER = r"feat|ft\.?|×|合唱|合作|duet|collaboration|&"
CONCERT_KEYWORD = "演唱会|演唱會|concert"
LONG_LIVE = "live|现场|現場|全场|全場"
LONG_LIVE_SECONDS = 1800
VENUE_LIVE = "live|现场|現場|演出|演唱"
SHOW_INTERVIEW = "专访|採訪|采访|访谈|訪談|interview"
SHOW_PERFORMANCE = "表演|演唱|演出|perform"
GALA = "颁奖|頒獎|晚会|晚會|典礼|典禮|盛典|跨年"
EPISODE_RAW_TITLE = r"(?U)第\d+期|EP\d+|ep\d+"
INTERVIEW_KEYWORD = "采访|採訪|专访|專訪|访谈|訪談|interview"
BEHIND_SCENES = r"(?U)幕后|幕後|花絮|记者会|記者會|发布会|發布會|press\s*conference"
NEWS = "新闻|新聞|报道|報導|独家|獨家"

# Title patterns of the scoring ladder.
SCORE_MV_WORD = r"(?U)\bmv\b|music\s*video"
SCORE_CONCERT_LIVE = "live|现场|現場|巡演"
SCORE_GALA = "颁奖|頒獎|晚会|晚會|典礼|典禮|跨年"
SCORE_BEHIND = "幕后|幕後|花絮|记者会|記者會"
SCORE_OST = "ost|主题曲|主題曲|插曲|片尾曲"
SCORE_COLLAB = r"feat|ft\.|×|合唱|duet"
TOPIC_CHANNEL_MARKS = ["- Topic", "- 主題"]

# Word lists.
WRONG_CONTEXT_DEFAULTS = [
    "reaction", "反應", "反应", "翻唱", "cover version", "教學", "tutorial",
    "鈴聲", "铃声", "ringtone", "karaoke", "ktv",
    "piano cover", "guitar cover", "drum cover", "bass cover",
]
TV_NETWORKS = [
    "浙江卫视", "湖南卫视", "芒果TV", "芒果tv", "中天电视", "三立电视", "东方卫视",
    "CCTV", "央视", "江苏卫视", "北京卫视", "浙江衛視", "湖南衛視", "東方衛視",
]
VENUES = [
    "小巨蛋", "红馆", "紅館", "巨蛋", "体育馆", "體育館",
    "卫武营", "衛武營", "Legacy", "两厅院", "兩廳院",
]
INTERVIEW_MEDIA = [
    "娱乐星天地", "ETtoday", "TVBS", "三立新闻", "东森新闻", "中时", "联合报",
    "自由时报", "苹果日报", "壹周刊", "GQ", "ELLE", "Vogue", "BAZAAR", "InStyle",
    "Marie Claire", "Esquire", "理科太太", "唐绮阳", "聯合報", "自由時報",
]
GROUP_CONCERT_PREFIXES = ["SHE ", "S.H.E "]
SINGING_SHOW_WORDS = [
    "歌手", "我是歌手", "梦想的声音", "蒙面", "好声音", "声入人心",
    "天赐的声音", "唱将", "音乐", "歌", "singer",
]

# Rule strength by reason.
STRONG_REASONS = [
    "rule1_official_mv", "rule1_known_track_mv", "rule2_she_mv", "rule2_she_known_track_mv",
    "rule3_ost_with_source", "rule3_ost_official", "rule4_collab_known_song",
    "rule5_known_concert", "rule5_she_concert", "rule6_known_show",
    "rule0_wrong_context", "rule0_western_blacklist", "rule0_chinese_blacklist",
    "rule0_artist_not_primary",
]
MEDIUM_REASONS = [
    "rule1_known_track_broad", "rule2_she_known_track_broad", "rule3_ost_broad",
    "rule3_variety_single", "rule4_collab_pattern", "rule5_concert_keyword",
    "rule5_long_live", "rule5_venue", "rule6_tv_network", "rule6_award_gala",
    "rule6_episode_pattern", "rule7_interview_keyword", "rule7_behind_scenes",
    "rule7_news", "rule7_media_channel",
]

# Duration bands in seconds: (lowest, ideal from, ideal to, highest).
DURATION_BANDS = {
    "personal_mv": (120, 180, 360, 480),
    "group_mv": (120, 180, 360, 480),
    "ost_singles": (120, 180, 360, 480),
    "collabs": (120, 180, 420, 600),
    "concerts": (300, 1800, 7200, 14400),
    "variety": (120, 300, 5400, 7200),
    "interviews": (60, 180, 3600, 7200),
}

# Signal weights, in the order in which they are summed.
SIGNAL_WEIGHTS = {
    "rule_strength": 0.35,
    "source_reliability": 0.20,
    "duration_fit": 0.10,
    "view_count": 0.10,
    "title_match": 0.25,
}

# Lowest view count that keeps an item, by category.
VIEW_THRESHOLDS = {
    "personal_mv": 500,
    "group_mv": 500,
    "ost_singles": 500,
    "collabs": 500,
    "concerts": 1000,
    "variety": 1000,
    "interviews": 500,
}
VIEW_THRESHOLD_DEFAULT = 1000

# Link checks.
VALID_STATUSES = [200, 206, 301, 302, 303, 307, 308]
LINK_CHUNK = 50
LABEL_BATCH = 20

# Text lengths.
VIDEO_DESCRIPTION_CHARS = 300
SECOND_PLATFORM_DESCRIPTION_CHARS = 250
LABEL_DESCRIPTION_CHARS = 200
WEB_SNIPPET_CHARS = 80

# Limits of query generation.
TRACKS_PER_ALBUM = 5
TOP_OST = 8
TOP_MEDIA_CHANNELS = 8
TOP_GROUP_TRACKS = 10

REVIEW_THRESHOLD = 0.7
SEARCH_TOLERANCE = 0.35
SHORT_ALBUM_TRACKS = 3

# Keys of the compact payload.
COMPACT_KEYS = [
    "title", "url", "source", "published_at", "view_count", "play_count", "channel",
    "author", "duration", "description", "snippet", "bvid", "date", "verified",
    "verify_status",
]

# Formats of the rendered documents.
SECTION_TITLES = {
    "youtube": "## YouTube 视频",
    "bilibili": "## Bilibili 视频",
    "google": "## 其他来源",
}
VIDEO_TABLE_HEADER = "| 内容名称 | 链接 | 平台 | 发布日期 | 播放量 | 频道/作者 | 时长 |"
VIDEO_TABLE_RULE = "|---------|------|------|---------|-------|---------|------|"
VIDEO_LINK_LABEL = "观看"
WEB_TABLE_HEADER = "| 内容名称 | 链接 | 来源 | 日期 | 摘要 |"
WEB_TABLE_RULE = "|---------|------|------|------|------|"
WEB_LINK_LABEL = "链接"
SOURCES_LINE = "> 数据来源：YouTube Data API v3、Bilibili 搜索 API、Google 搜索（Serper.dev）"
TOTAL_LINE = "> 共收录 %d 条结果 | 最后更新：%s"
EMPTY_NOTICE = "*暂无搜索结果。*"
UNVERIFIED_MARK = "⚠️"

# Format of one row of a label request: index, title, who, duration, description.
LABEL_ITEM_FORMAT = "[%d] 标题: %s\n    频道: %s\n    时长: %s\n    简介: %s"
LABEL_MESSAGE_FORMAT = "请对以下 %d 条视频进行分类：\n\n%s"
LABEL_DISCARD_LINE = "- discard: 与%s无关的内容"

# Search query templates in emission order: (dimension, step, phase, tool, format, page,
# category).  Rows of one dimension and step are emitted together per dimension entry.
QUERY_TEMPLATES = [
    ("primary", 1, 0, "youtube", "{primary} MV official", 1, "personal_mv"),
    ("primary", 1, 1, "youtube", "{english} MV official", 1, "personal_mv"),
    ("tracks", 2, 0, "youtube", "{primary} {track} MV", 1, "personal_mv"),
    ("ost", 3, 0, "youtube", "{primary} {name} MV", 1, "personal_mv"),
    ("primary", 4, 0, "bilibili", "{primary} MV 官方", 1, "personal_mv"),
    ("primary", 4, 1, "bilibili", "{english} {primary} MV", 1, "personal_mv"),
    ("tracks_first", 5, 0, "bilibili", "{primary} {track} MV", 1, "personal_mv"),
    ("aliases", 6, 0, "youtube", "{alias} MV", 1, "personal_mv"),
    ("aliases", 6, 1, "bilibili", "{alias} MV", 1, "personal_mv"),
    ("aliases", 6, 2, "youtube", "{alias} 演唱会", 1, "concerts"),
    ("aliases", 6, 3, "youtube", "{alias} interview", 1, "interviews"),
    ("primary", 7, 0, "google", "{primary} MV site:bilibili.com", 1, "personal_mv"),
    ("ost_with_source", 8, 0, "youtube", "{primary} {name} {source}", 1, "ost_singles"),
    ("ost_other_source", 8, 1, "youtube", "{primary} {name} MV", 1, "ost_singles"),
    ("ost_no_source", 8, 0, "youtube", "{primary} {name}", 1, "ost_singles"),
    ("ost_first", 9, 0, "bilibili", "{primary} {name}", 1, "ost_singles"),
    ("variety_singles", 10, 0, "youtube", "{primary} {name} 单曲 {source}", 1, "ost_singles"),
    ("variety_singles", 10, 1, "bilibili", "{primary} {name} {source}", 1, "variety"),
    ("primary", 11, 0, "bilibili", "{primary} 影视歌曲", 1, "ost_singles"),
    ("concerts", 12, 0, "youtube", "{primary} {name}", 1, "concerts"),
    ("concert_aliases", 12, 1, "youtube", "{primary} {alias}", 1, "concerts"),
    ("concert_venues", 12, 2, "youtube", "{primary} {short_name} {venue}", 1, "concerts"),
    ("concerts", 12, 3, "bilibili", "{primary} {name}", 1, "concerts"),
    ("concert_aliases", 12, 4, "bilibili", "{primary} {alias}", 1, "concerts"),
    ("primary", 13, 0, "youtube", "{primary} 演唱会 full", 1, "concerts"),
    ("primary", 13, 1, "bilibili", "{primary} 演唱会 全场", 1, "concerts"),
    ("primary", 13, 2, "bilibili", "{primary} 演唱会 全场", 2, "concerts"),
    ("primary", 13, 3, "google", "{primary} 演唱会 全场 site:bilibili.com", 1, "concerts"),
    ("primary", 13, 4, "google", "{primary} {english} concert live", 1, "concerts"),
    ("group_concerts", 14, 0, "youtube", "{name}", 1, "concerts"),
    ("group_concerts", 14, 1, "bilibili", "{name}", 1, "concerts"),
    ("group", 15, 0, "youtube", "{group} 演唱会", 1, "concerts"),
    ("group", 15, 1, "bilibili", "{group} {primary} 演唱会", 1, "concerts"),
    ("shows", 16, 0, "youtube", "{primary} {name}", 1, "variety"),
    ("shows", 16, 1, "bilibili", "{primary} {name}", 1, "variety"),
    ("primary", 17, 0, "youtube", "{primary} 综艺", 1, "variety"),
    ("primary", 17, 1, "youtube", "{primary} 节目", 1, "variety"),
    ("group_shows", 18, 0, "youtube", "{group} {name}", 1, "variety"),
    ("primary", 19, 0, "bilibili", "{primary} 综艺", 1, "variety"),
    ("primary", 19, 1, "youtube", "{primary} 现场 live", 1, "variety"),
    ("primary", 19, 2, "bilibili", "{primary} 现场", 1, "variety"),
    ("primary", 19, 3, "google", "{primary} 综艺 site:bilibili.com", 1, "variety"),
    ("variety_singles", 20, 0, "youtube", "{primary} {source} {name}", 1, "variety"),
    ("primary", 21, 0, "youtube", "{primary} 跨年 演唱 表演", 1, "variety"),
    ("primary", 21, 1, "bilibili", "{primary} 跨年 跨年晚会", 1, "variety"),
    ("primary", 22, 0, "youtube", "{primary} 采访", 1, "interviews"),
    ("other_english", 22, 1, "youtube", "{english} interview", 1, "interviews"),
    ("primary", 23, 0, "bilibili", "{primary} 采访", 1, "interviews"),
    ("primary", 23, 1, "bilibili", "{primary} 专访", 1, "interviews"),
    ("primary", 23, 2, "google", "{english} interview", 1, "interviews"),
    ("primary", 23, 3, "google", "{primary} 深度专访", 1, "interviews"),
    ("albums", 24, 0, "youtube", "{primary} 专访 {year} {album}", 1, "interviews"),
    ("interviewers", 25, 0, "youtube", "{primary} {name} 采访", 1, "interviews"),
    ("interviewers", 25, 1, "bilibili", "{primary} {name}", 1, "interviews"),
    ("channels_first", 26, 0, "youtube", "{primary} {name}", 1, "interviews"),
    ("channels_first", 26, 1, "bilibili", "{primary} {name}", 1, "interviews"),
    ("group", 27, 0, "youtube", "{group} MV official", 1, "group_mv"),
    ("group_alias", 27, 1, "youtube", "{group_alias} MV official", 1, "group_mv"),
    ("group_tracks", 28, 0, "youtube", "{group} {track} MV", 1, "group_mv"),
    ("group", 29, 0, "bilibili", "{group} MV", 1, "group_mv"),
    ("group_tracks_first", 30, 0, "bilibili", "{group} {track} MV", 1, "group_mv"),
    ("collab_songs", 31, 0, "youtube", "{primary} {collab} {song}", 1, "collabs"),
    ("collab_songs", 31, 0, "bilibili", "{primary} {collab} {song}", 1, "collabs"),
    ("collab_no_songs", 31, 0, "youtube", "{primary} {name}", 1, "collabs"),
    ("collab_no_songs", 31, 0, "bilibili", "{primary} {name}", 1, "collabs"),
    ("collab_aliases", 31, 1, "youtube", "{alias} {primary}", 1, "collabs"),
    ("primary", 32, 0, "youtube", "{primary} 合唱", 1, "collabs"),
    ("primary", 32, 1, "bilibili", "{primary} 合唱", 1, "collabs"),
    ("primary", 32, 2, "bilibili", "{primary} 合作", 1, "collabs"),
    ("primary", 32, 3, "google", "{primary} 合唱 合作 site:bilibili.com", 1, "collabs"),
]
