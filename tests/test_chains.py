import random

from threadloom.operators import chains
from tests.conftest import make_posts


def _pairs(df):
    return [(r.speaker0_text, r.speaker1_text) for r in df.orderBy("emit_pos", "emit_k").collect()]


FIXTURES = [
    ([(0, "a", "Q1"), (1, "b", "A1"), (2, "a", "Q2"), (3, "b", "A2")], [("Q1", "A1")], [("Q1", "A1"), ("Q2", "A2")]),
    ([(0, "a", "Q1"), (1, "a", "Q1x"), (2, "b", "A1"), (3, "a", "Q2")], [("Q1Q1x", "A1")], [("Q1 Q1x", "A1")]),
    ([(0, "a", "Q1"), (1, "b", "A1"), (2, "b", "A1x"), (3, "c", "A2"), (4, "a", "Q2")],
     [("Q1", "A1"), ("Q1", "A2")], [("Q1", "A1 A1x")]),
    ([(0, "s", "X"), (1, "a", "Q1"), (2, "b", "A1")], [], [("X", "Q1")]),
    ([(0, "a", "Q1")], [], []),
]


def test_fixtures_variant2(spark):
    for rows, v2, _ in FIXTURES:
        got = _pairs(chains.dialog_starter_chain(make_posts(spark, rows)))
        assert got == v2, rows


def test_fixtures_variant1(spark):
    for rows, _, v1 in FIXTURES:
        got = _pairs(chains.dialog_two_speaker(make_posts(spark, rows)))
        assert sorted(got) == sorted(v1), rows


def test_five_answer_cap(spark):
    rows = [(0, "a", "Q")] + [(i, f"u{i}", f"A{i}") for i in range(1, 8)] + [(8, "a", "Q2")]
    got = _pairs(chains.dialog_starter_chain(make_posts(spark, rows)))
    assert got == [("Q", f"A{i}") for i in range(1, 6)]
    got1 = _pairs(chains.dialog_two_speaker(make_posts(spark, rows)))
    assert got1 == [("Q", "A1")]


# ---------------------------------------------------------------------------
# property test: windows == sequential fold of the reference semantics
# ---------------------------------------------------------------------------
CM = {ord(" "): " ", ord("\n"): " ", ord("\t"): " ", ord("\r"): None}


def fold_variant2(posts):
    """posts: list of (pos, author, text, is_quote) in order."""
    out = []
    starter = posts[0][1]
    part = {starter: (posts[0][2] or "").strip()}
    order = [starter]
    for pos, author, text, isq in posts[1:]:
        if isq:
            continue
        if not text:
            continue
        t = text.translate(CM).strip()
        if starter is not None and author == starter:
            if len(part) > 1:
                for a in [x for x in order if x != starter][:5]:
                    out.append((part[starter], part[a]))
                part, order = {starter: t}, [starter]
            else:
                part[starter] += t
        else:
            if not part.get(author):
                if author not in part:
                    order.append(author)
                part[author] = t
    return out


def fold_variant1(posts):
    posts = [p for p in posts if p[2] is not None]
    if not posts:
        return []
    s0 = posts[0][1]
    s1 = next((p[1] for p in posts if p[1] != s0), None)
    if s1 is None:
        return []
    cur, sent, cell, dialog = s0, "", [], []
    for _, author, text, _ in posts:
        if author not in (s0, s1):
            continue
        t = text.translate(CM)
        if author == cur:
            sent += t if not sent else f" {t}"
        else:
            cell.append(sent)
            if cur == s1:
                dialog.append(tuple(cell))
                cell = []
            cur, sent = author, t
    if cur == s1 and len(cell) and sent:
        cell.append(sent)
        dialog.append(tuple(cell))
    return dialog


import pytest


@pytest.mark.parametrize("bucket_size", [1 << 20, 2, 3])
def test_property_against_fold(spark, bucket_size):
    rng = random.Random(7)
    texts = ["x", "y z", " ", "", None, "w\nv", "q\tq", "  pad  "]
    topics = []
    for tid in range(120):
        n = rng.randint(1, 12)
        authors = [rng.choice("abcdefg") for _ in range(n)]
        topics.append([(i, authors[i], rng.choice(texts) if i else rng.choice(texts[:-1]), False)
                       for i in range(n)])
    rows = []
    for tid, ps in enumerate(topics):
        for pos, a, t, _ in ps:
            rows.append(("t", str(tid), "u", a, a, t, None, pos))
    df = spark.createDataFrame(rows, "source string, topic_id string, url string, author_id string, "
                                     "author_name string, text string, html string, pos bigint")
    got2 = {}
    for r in chains.dialog_starter_chain(df, bucket_size=bucket_size).collect():
        got2.setdefault(r.topic_id, []).append((r.emit_pos, r.emit_k, r.speaker0_text, r.speaker1_text))
    got1 = {}
    for r in chains.dialog_two_speaker(df, bucket_size=bucket_size).collect():
        got1.setdefault(r.topic_id, []).append((r.emit_k, r.speaker0_text, r.speaker1_text))
    for tid, ps in enumerate(topics):
        exp2 = fold_variant2(ps)
        g2 = [(a, b) for _, _, a, b in sorted(got2.get(str(tid), []), key=lambda x: (x[0], x[1]))]
        assert g2 == exp2, (ps, g2, exp2)
        exp1 = fold_variant1(ps)
        g1 = [(a, b) for _, a, b in sorted(got1.get(str(tid), []))]
        assert g1 == exp1, (ps, g1, exp1)


def test_hot_topic_spread_over_buckets(spark):
    rng = random.Random(11)
    hot = [(i, rng.choice("aab" if i % 50 else "a"), rng.choice(["x", "y z", "", " w "]), False) for i in range(3000)]
    small = [[(i, rng.choice("ab"), "t", False) for i in range(5)] for _ in range(20)]
    rows = [("t", "hot", "u", a, a, t, None, p) for p, a, t, _ in hot]
    for k, ps in enumerate(small):
        rows += [("t", f"s{k}", "u", a, a, t, None, p) for p, a, t, _ in ps]
    df = spark.createDataFrame(rows, "source string, topic_id string, url string, author_id string, "
                                     "author_name string, text string, html string, pos bigint")
    out = chains.dialog_starter_chain(df, bucket_size=64)
    got = [(r.speaker0_text, r.speaker1_text) for r in out.filter("topic_id = 'hot'").orderBy("emit_pos", "emit_k").collect()]
    assert got == fold_variant2(hot)
    # the hot topic's scan partitions: one per 64-post bucket
    from threadloom.operators.ranking import with_bucket
    assert with_bucket(df.filter("topic_id = 'hot'"), "pos", 64).select("_bk").distinct().count() == 47
