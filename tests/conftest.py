import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from catalogia.schema import ITEM, PROFILE
from catalogia.session import build_session
from sample_profiles import document


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_profiles(spark):
    def make(*documents):
        rows = [{"profile": d["artist"]["names"]["english"].lower().replace(" ", "_"), **d}
                for d in documents]
        parsed = F.from_json(F.lit(json.dumps(rows, ensure_ascii=False)), T.ArrayType(PROFILE))
        return spark.range(1).select(F.inline(parsed))

    return make


@pytest.fixture(scope="session")
def profiles(make_profiles):
    return make_profiles(document())


@pytest.fixture(scope="session")
def make_items(spark):
    def make(*rows):
        filled = [
            {**{f.name: None for f in ITEM.fields}, "profile": "star_lin", "file_id": 2, "ord": i, **row}
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame([tuple(r[f.name] for f in ITEM.fields) for r in filled], ITEM)

    return make
