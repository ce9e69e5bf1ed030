import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from threadloom.session import local_session
    s = local_session(shuffle_partitions=8)
    yield s


POST_SCHEMA = "source string, topic_id string, url string, author_id string, author_name string, text string, html string, pos bigint"


def make_posts(spark, rows, source="t", topic="1", url="https://example.org/t/1"):
    """rows: (pos, author, text[, html[, url]])"""
    out = []
    for r in rows:
        pos, author, text = r[0], r[1], r[2]
        html = r[3] if len(r) > 3 else None
        u = r[4] if len(r) > 4 else url
        out.append((source, topic, u, author, author, text, html, pos))
    return spark.createDataFrame(out, POST_SCHEMA)
