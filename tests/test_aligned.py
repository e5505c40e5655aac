"""Plans of texts that are aligned where they are walked are those of the same characters given as a column."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.functions import pause as P
from corvane.plans import registry
from corvane.plans.fixtures import aligned

TEXTS = ["one, two #", "", "x, é🙂中; y。", "a" * 70 + ", b", ", c", "d,"]


@pytest.mark.parametrize("kind, most", [(P.PLAN, 1), (P.PLAN, 40), (P.TIMED, 1 << 20)])
def test_plan_aligned(spark, monkeypatch, kind, most):
    """A text at a time, some at once, and all at once; of doc_id 4, 15 and 26 the alignment has a letter more."""
    monkeypatch.setattr(P, "ALIGNED", most)
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(30)]
    chars = aligned(pa.array([t for _, t in rows]), pa.array([i for i, _ in rows])).to_pylist()
    df = spark.createDataFrame([(*r, c) for r, c in zip(rows, chars)], "doc_id long, t string, c array<struct<ch:string,start_sec:double,end_sec:double>>").coalesce(1)
    given = (P.pause_plan if kind == P.PLAN else P.preview)(F.col("t"), F.col("c"), F.lit(10.0))
    got = df.select("doc_id", given.alias("g"), P.plan_aligned(F.col("t"), aligned, [F.col("doc_id")], F.lit(10.0), kind).alias("p")).collect()
    assert all(r["g"] == r["p"] for r in got) and [r["doc_id"] for r in got if r["p"]["unalignable"]] == [4, 15, 26]
    assert sum(len(r["p"]["plan"]) for r in got) > 20


@pytest.mark.parametrize("name", ["pause_summary", "pause_plan", "text_pause", "pause_preview"])
def test_no_column_of_characters(spark, sf_dir, name):
    """The aligned characters of whole texts are in no plan as a column."""
    assert "start_sec" not in registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().toString()
