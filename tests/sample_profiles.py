"""Profile documents that several test modules use."""


def document(**changes):
    """A small invented performer."""
    d = {
        "artist": {
            "names": {"primary": "林星河", "english": "Star Lin", "aliases": ["Starry", "星河"]},
            "official_channels": ["遠聲唱片", "Yuansheng Music"], "labels": ["遠聲唱片", "Label Two"],
            "birth_year": 1990, "genre": "Pop", "awards": ["最佳新人"], "social_links": {"x": "y"},
            "channels": [{"platform": "youtube", "id": "UC1", "name": "one"}],
        },
        "group": {"name": "N.O.W", "aliases": ["NOWBAND"], "members": [], "member_names": []},
        "discography": {
            "solo_albums": [
                {"name": "First Light", "year": 2010, "tracks": ["海邊的信", "HELLO!", "夏天的風"]},
                {"name": "Two", "year": 2012, "tracks": ["雙重身份", "短歌"]},
            ],
            "ost_singles": [
                {"name": "小雨", "source": "那年的約定", "year": 2015},
                {"name": "雙重身份", "source": "暗戰", "year": 2012},
                {"name": "獨立單曲", "source": "", "year": 2013},
            ],
            "variety_show_singles": [{"name": "翻頁", "source": "星夜舞台", "year": 2017}],
            "concerts": [{"name": "光年plus", "years": "2016", "aliases": ["光年PLUS"], "venues": ["台北"]}],
            "group_concerts": [{"name": "SHE 海洋樂園", "years": "2006"}],
            "variety_shows": [{"name": "星夜舞台", "network": "浙江卫视"}],
            "collaborators": [
                {"name": "四月天", "aliases": ["April"], "songs": ["滿足"]},
                {"name": "阿海", "aliases": [], "songs": []},
            ],
            "group_mvs": ["未滿的我們", "Super Moon"], "venues": [], "interview_channels": ["電視台"],
            "notable_interviewers": [], "western_artist_blacklist": ["taylor swift", "ive"],
            "other_chinese_artist_blacklist": ["別家歌手"], "wrong_context_patterns": ["錯誤場合"],
        },
        "categories": [
            {"id": i, "key": k, "label": k, "sub": "", "output_path": f"{k}.md", "description": ""}
            for i, k in [(2, "personal_mv"), (3, "ost_singles"), (4, "concerts"), (5, "variety"),
                         (6, "interviews"), (7, "group_mv"), (8, "collabs")]
        ],
        "classification": {"priority": ["personal_mv"]},
    }
    d.update(changes)
    return d
