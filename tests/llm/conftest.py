"""Small tables with every awkward row: nulls, empty and long texts, ties, repeats, clashing extra columns."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, _id string, size string"


def make_documents() -> list[tuple]:
    r = random.Random(5)
    words = ["".join(r.choice("abcdefgéß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    sentence = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, footer = sentence(40), "  Shared FOOTER line "
    texts = [sentence(r.randint(1, 80)) for _ in range(60)]
    texts += [sentence(20) + " " + passage + " " + sentence(15) for _ in range(12)]
    texts += [sentence(12) + "\n" + (footer if i % 2 else footer.lower().strip()) + "\n\n" + sentence(6) for i in range(14)]
    base = sentence(200)
    texts += [base] * 30 + [base.replace(" ", "\n", i) for i in range(1, 6)] + [base + " " + w for w in words[:12]]
    texts += ["", "", None, None, " \t\n", "\n", "a", "A b", "one  two\x0bthree\x0cfour\r\n", "x y   z", "\x1c \x85", "naïve\n\nİstanbul"]
    texts += ["ha " * 400, "na na na na na na na na na na na na na na na na", sentence(30000), "\n".join(["dup"] * 3000 + texts[:2])]
    texts += ["<|endoftext|> don't I'LL 12345 ½ ﬁ é ́x '' !!"]
    docs = [(i, t, "en", ["b", "a", None, "ünder", "Z"][i % 5] if i % 3 else "hot", len(t or ""), None, "x", "y") for i, t in enumerate(texts)]
    docs += [docs[3], docs[3], docs[62]]  # repeated rows
    docs += [(None, texts[4], None, None, None, None, None, None), (None, None, None, None, None, None, None, None),
             (None, "only here in a row without id", "en", "a", 1, True, "q", "r"), (-7, base, "en", "a", 1, True, "q", "r")]
    return docs


def make_embeddings() -> list[tuple]:
    r = random.Random(6)
    rows = [(i, [r.uniform(-1, 1) if r.random() < 0.7 else 0.0 for _ in range(12)], 0) for i in range(230)]
    rows += [(i, rows[i - 230][1], 1) for i in range(230, 260)]  # ties
    rows += [(300, None, 0), (301, [None] * 12, 0), (302, [float("nan")] + [0.5] * 11, 0), (303, [float("-inf")] + [0.5] * 11, 0),
             (304, [0.5, 0.25], 0), (305, [], 0), (None, [1.0] * 12, 0), (350, [0.001] * 12, 0), rows[50], rows[7]]
    return rows


def make_pages() -> list[tuple]:
    page = lambda lang, text: f"<html{lang}><head><script>var x='<p>der die das'</script></head><body><p>{text}</p></body></html>"
    en, de = "the cat and the dog with this that", "der hund und die katze mit dem nicht"
    rows = [(i, f"https://en.example.com/{i}", page(' lang="en"', f"{en} {i}")) for i in range(12)]
    rows += [(20 + i, f"http://de.example.org/{i}", page(" class=x LANG=de-DE", de)) for i in range(12)]
    rows += [(40, "http://de.example.org/blank", page("", "")), (41, None, None), (42, "", ""), (None, "no url at all", page("", en)),
             (43, "https://user@en.example.com:80/x", page(' lang=""', "&amp; 12 % !")), (1, "https://en.example.com/1", page(' lang="en"', f"{en} 1")),
             (44, "https://other.example.net/", page(' lang="de"', de * 2000))]
    return rows


def write_tables(spark, path, docs, labels, embeddings, pages) -> str:
    for name, rows, schema in (("documents", docs, SCHEMA), ("labels", labels, "doc_id long, quality int, toxic int"),
                               ("embeddings", embeddings, "vec_id long, embedding array<float>, label int"),
                               ("pages", pages, "page_id long, url string, html string")):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.fixture(scope="session")
def mini(spark, tmp_path_factory):
    docs = make_documents()
    labels = [(d[0], int("na na" not in (d[1] or "") and "ha ha" not in (d[1] or "")), 0) for d in docs if d[0] is not None]
    labels += [(None, 1, 0), (5, None, 0), (6, 7, 0), (10**9, 1, 0)]
    return write_tables(spark, tmp_path_factory.mktemp("mini"), docs, labels, make_embeddings(), make_pages())


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return write_tables(spark, tmp_path_factory.mktemp("empty"), [], [], [], [])


@pytest.fixture(scope="session")
def docs():
    return make_documents()
