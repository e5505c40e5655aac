"""The pause queries give the rows of their SQL on texts that hold any character, not only on the driver's."""

import random
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from corvane.functions import pause as P
from corvane.plans import registry

TEXTS = ["one, two #", "#", "a#b, c! ##", "one, two", "#, one", "", None, "é, x🙂; y# 。", "xx, x#x", ", # :"]


@pytest.fixture(scope="module")
def odd_texts(spark, tmp_path_factory):
    """Each text twice: as one that the alignment has a letter more of, and as one that it has all of."""
    d = str(tmp_path_factory.mktemp("odd"))
    rows = [(11 * i + k, t) for i, t in enumerate(TEXTS) for k in (4, 5)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{d}/documents.parquet")
    return d


def plain(v):
    return float(v) if hasattr(v, "as_tuple") else v


@pytest.mark.parametrize("name", ["pause_plan", "pause_summary", "text_pause", "pause_preview"])
def test_pause_query(spark, odd_texts, name):
    df = registry.QUERIES[name](spark, odd_texts)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{odd_texts}/documents.parquet/*.parquet'")
    rel = con.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert {r["doc_id"]: r.asDict() for r in df.collect()} == {r[rel.columns.index("doc_id")]: dict(zip(rel.columns, map(plain, r))) for r in rel.fetchall()}


def test_text_pause_of_a_long_text(spark, odd_texts, tmp_path):
    """10,000 marks take the time of their text, not of all its characters times all its marks (97.8 s for the three texts)."""
    spark.createDataFrame([(k, "ab, " * 10_000) for k in (4, 5, 6)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    registry.QUERIES["text_pause"](spark, odd_texts).collect()
    begin = time.monotonic()
    got = dict(registry.QUERIES["text_pause"](spark, str(tmp_path)).collect())
    took = time.monotonic() - begin
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == dict(con.sql(f"select doc_id, t_md5 from ({registry.ORACLES['text_pause']})").fetchall())
    assert took < 15


def by_characters(text, plan):
    """The tokens put in a character at a time."""
    at = {e[0]: e[4] for e in plan or [] if e and e[0] is not None and 0 <= e[0] < len(text) and text[e[0]] == e[1]}
    put = {"no_pause": lambda c: "", "short": lambda c: c + P.SHORT_TOKEN, "long": lambda c: c + P.LONG_TOKEN}
    return "".join(put.get(at.get(i), str)(c) for i, c in enumerate(text))


def test_text_pause_of_any_plan(spark):
    """Plans out of order, of another text, with several events at an offset, or none."""
    pick, rows = random.Random(5), []
    for i in range(600):
        event = lambda: None if pick.random() < 0.05 else (pick.choice([None, -1, *range(13)]), pick.choice(["，", "。", "a", "🙂", "", None]), "normal", None, pick.choice(["no_pause", "short", "long", None]))
        plan = None if i % 40 == 0 else [event() for _ in range(pick.randrange(9))]
        rows.append((i, "".join(pick.choice("ab，。🙂é\n") for _ in range(pick.randrange(12))), plan))
    df = spark.createDataFrame(rows, f"i int, t string, plan {P.PLAN}")
    got = dict(df.select("i", P.text_pause(F.col("t"), F.col("plan"))).collect())
    assert got == {i: by_characters(t, plan) for i, t, plan in rows}
