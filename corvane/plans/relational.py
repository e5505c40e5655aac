"""Queries of joins, sets, and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from corvane.plans.fixtures import fx, load, with_fx
from corvane.plans.registry import query


@query("join_manifest", with_fx("select s.id, a.agreement, t.tier from fx_segments s join fx_agreement a on s.id = a.id join fx_tiers_old t on s.id = t.id"))
def join_manifest(spark, d):
    return fx(spark, d, "fx_segments").select("id").join(fx(spark, d, "fx_agreement").select("id", "agreement"), "id").join(fx(spark, d, "fx_tiers_old").select("id", "tier"), "id")


@query("join_left_on_pred", with_fx("select s.id, f.pass from fx_segments s left join fx_filters_old f on s.id = f.id and f.provenance = 'filter_decide'"))
def join_left_on_pred(spark, d):
    return fx(spark, d, "fx_segments").select("id").join(fx(spark, d, "fx_filters_old").where("provenance = 'filter_decide'").select("id", "pass"), "id", "left")


@query("anti_not_in", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem where l_quantity > 45)")
def anti_not_in(spark, d):
    return load(spark, d, "orders").join(load(spark, d, "lineitem").where("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@query("semi_exists", "select o_orderkey from orders o where exists (select 1 from lineitem l where l.l_orderkey = o.o_orderkey and l_quantity > 45)")
def semi_exists(spark, d):
    return load(spark, d, "orders").join(load(spark, d, "lineitem").where("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("semi_literal", with_fx("select id from fx_tiers_old where tier in ('gold', 'silver')"))
def semi_literal(spark, d):
    return fx(spark, d, "fx_tiers_old").where(F.col("tier").isin("gold", "silver")).select("id")


@query("set_union", with_fx("select id from fx_tiers_old union select id from fx_labels_music"))
def set_union(spark, d):
    return fx(spark, d, "fx_tiers_old").select("id").union(fx(spark, d, "fx_labels_music").select("id")).distinct()


@query("set_diff", with_fx("select id from fx_segments except select id from fx_labels_music"))
def set_diff(spark, d):
    return fx(spark, d, "fx_segments").select("id").distinct().join(fx(spark, d, "fx_labels_music").select("id"), "id", "left_anti")


@query("set_intersect", with_fx("select id from fx_tiers_old intersect select id from fx_labels_overlap"))
def set_intersect(spark, d):
    return fx(spark, d, "fx_tiers_old").select("id").intersect(fx(spark, d, "fx_labels_overlap").select("id"))


@query("arch_count", with_fx("select id from fx_asr_results group by id having count(distinct case when model <> 'gamma' then model end) >= 2"))
def arch_count(spark, d):
    return fx(spark, d, "fx_asr_results").groupBy("id").agg(F.count_distinct(F.when(F.col("model") != "gamma", F.col("model"))).alias("n")).where("n >= 2").select("id")


@query("pause_delta", with_fx("select raw_id, turn_idx, start_sec - lag(end_sec) over (partition by raw_id order by turn_idx) delta from fx_turns"))
def pause_delta(spark, d):
    from pyspark.sql import Window

    return fx(spark, d, "fx_turns").select("raw_id", "turn_idx", (F.col("start_sec") - F.lag("end_sec").over(Window.partitionBy("raw_id").orderBy("turn_idx"))).alias("delta"))


@query("sample_n", "select lang, greatest(30, cast(round(count(*) * 0.1) as bigint)) n from documents group by lang")
def sample_n(spark, d):
    return load(spark, d, "documents").groupBy("lang").agg(F.greatest(F.lit(30), F.round(F.count("*") * F.lit(0.1)).cast("long")).alias("n"))
