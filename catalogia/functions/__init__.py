"""Column expressions: no joins, no Python code in tasks."""

from catalogia.functions.display import (  # noqa: F401
    browser_mark, table_mark, views_mk, views_wan, views_yi,
)
from catalogia.functions.durations import (  # noqa: F401
    duration_seconds, duration_text, epoch_to_date, iso_duration_text, year_month,
)
from catalogia.functions.items import (  # noqa: F401
    compact_item, richness, title, title_lc, views, who,
)
from catalogia.functions.text import (  # noqa: F401
    blank_to_null, contains_any, escape_md, slug, strip_fences, strip_tags, trim_all,
    truncate_desc,
)
from catalogia.functions.urls import (  # noqa: F401
    batch_key, catalog_key, tracker_key, uploads_playlist_id, url_host, video_id_parsed,
    video_id_simple,
)
