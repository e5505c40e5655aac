"""Quality rules: fixed base rules, then robust multivariate outliers, with DataFrame functions only.

Each language and source gets a minimum-covariance-determinant (MCD) estimate of a vector of transformed text
statistics. It is found by concentration steps from a start of medians and interquartile ranges: rows are ordered by
their Mahalanobis distance under the present estimate, the nearest `SUPPORT` share gives the next. A step is one
aggregation by group and distance bin (`BINS` bins a factor of e in 1 + d^2, so a group of any size meets as at most
a few thousand partial sums), and a running count over a group's bins picks the support. Variances have floors, since most
clean texts share statistics of exactly 0. A text is rejected where its squared distance is over `CUTOFF`.

Text is read once, into a narrow table of statistics in the shared folder; all further shuffles are of that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import WS_CHARS, Cuts, table, whole

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SUPPORT = 0.75
STEPS = 4
#: Groups of fewer rows are pooled by language; if that is too few, they are judged by all rows of their language, then by what is left
#: of all languages, then by all rows of the table. Only where those are fewer too is there no estimate, and all rows stay.
MIN_ROWS = 200
BINS, MAX_BIN = 64, 4095
#: Estimates (about 300 bytes each) are broadcast up to so many groups, and joined by a shuffle beyond.
BROADCAST_GROUPS = 20_000
#: The statistics, and the least standard deviation of each.
FLOORS = {"v_length": 0.10, "v_symbols": 0.40, "v_upper": 0.35, "v_punct": 0.40, "v_repeat": 1.0, "v_lines": 1.2}
#: Median of the chi-squared distribution with as many degrees of freedom as statistics, for consistency at the normal.
CHI2_MEDIAN = 5.348
CUTOFF = 30.0

STATS = list(FLOORS)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds _rep, the words in 3-word windows found twice or more, to df with the words _w and their number _n.

    A window is its 64-bit hash shifted left by the bits a position needs, with the position in those bits: sorted,
    equal windows stand together and still say where they are. Work is n log n in the words of one text.
    """
    df = df.withColumn("_bits", F.expr("cast(length(bin(_n)) as int)"))
    packed = "case when _n >= 4 then sort_array(transform(sequence(0, _n - 3), i -> shiftleft(xxhash64(get(_w, i), get(_w, i + 1), get(_w, i + 2)), _bits) | cast(i as bigint))) else cast(array() as array<bigint>) end"
    df = df.withColumn("_packed", F.expr(packed))
    same = "shiftright(x, _bits) = shiftright(get(_packed, j {} 1), _bits)"
    at = f"sort_array(filter(transform(_packed, (x, j) -> case when {same.format('+')} or (j > 0 and {same.format('-')}) then x & (shiftleft(1L, _bits) - 1) end), p -> p is not null))"
    df = df.withColumn("_at", F.expr(at))
    return df.withColumn("_rep", F.expr("aggregate(transform(_at, (p, j) -> coalesce(least(get(_at, j + 1) - p, 3L), 3L)), 0L, (a, b) -> a + b)"))


def text_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df's columns without the text, with the base counts (see the contract of op7) and the counts _upper, _punct, _lines."""
    rest = [c for c in df.columns if c != text_col]
    df = df.select(*rest, whole(F.col(text_col)).alias("_t"))
    df = df.withColumn("_trim", F.btrim("_t", F.lit(WS_CHARS)))
    df = df.withColumn("_w", F.when(F.col("_trim") == "", F.array().cast("array<string>")).otherwise(F.split("_trim", r"[\x20\x09-\x0D]+")))
    df = df.withColumn("_l", F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(WS_CHARS)) != ""))
    size = lambda c: F.length(c).cast("long")
    df = df.select(
        *rest,
        "_w",
        F.size("_w").alias("_n"),
        size(F.translate("_t", WS_CHARS, "")).alias("word_chars"),
        (size("_t") - size(F.translate("_t", "#*$%&|<>", ""))).alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").alias("_lines"),
        size(F.regexp_replace("_t", r"[^\p{Lu}]+", "")).alias("_upper"),
        size(F.regexp_replace("_t", r"[\p{L}\p{N}\s]+", "")).alias("_punct"),
    )
    df = _repeat_words(df)
    return df.select(*rest, F.col("_n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("_rep").alias("n_repeat_words"), "_upper", "_punct", "_lines")


def _vector() -> list[Column]:
    share = lambda a, b: F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    by_name = {
        "v_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))),
        "v_symbols": share("n_symbols", "word_chars"),
        "v_upper": share("_upper", "word_chars"),
        "v_punct": share("_punct", "word_chars"),
        "v_repeat": share("n_repeat_words", "n_words"),
        "v_lines": share("n_dup_lines", "_lines"),
    }
    return [by_name[v].alias(v) for v in STATS]


def _start(rows: DataFrame) -> DataFrame:
    """Medians and interquartile ranges of each statistic of each group, from counts of bins of 1/50."""
    bins = rows.select("_group", F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.floor(F.col(v) * 50).alias("b")) for k, v in enumerate(STATS)))).alias("x")).groupBy("_group", "x.k", "x.b").agg(F.count("*").alias("c"))
    w = Window.partitionBy("_group", "k")
    bins = bins.withColumn("upto", F.sum("c").over(w.orderBy("b"))).withColumn("of", F.sum("c").over(w))
    q = lambda p, k: F.min(F.when((F.col("k") == k) & (F.col("upto") >= p * F.col("of")), (F.col("b") + 0.5) / 50))
    out = bins.groupBy("_group").agg(*(q(p, k).alias(f"_q{k}_{int(p * 100)}") for k in range(len(STATS)) for p in (0.25, 0.5, 0.75)))
    mu = [F.col(f"_q{k}_50").alias(f"_m{k}") for k in range(len(STATS))]
    cov = [F.pow((F.col(f"_q{i}_75") - F.col(f"_q{i}_25")) / 1.349, 2).alias(f"_c{i}{j}") if i == j else F.lit(0.0).alias(f"_c{i}{j}") for i in range(len(STATS)) for j in range(i + 1)]
    return out.select("_group", *mu, *cov, F.lit(1.0).alias("_scale"))


def _factor(est: DataFrame) -> DataFrame:
    """The Cholesky factor _f of each covariance with its floors; one row a group."""
    d = len(STATS)
    for i in range(d):
        for j in range(i + 1):
            a = F.col(f"_c{i}{j}") + (F.lit(FLOORS[STATS[i]] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                a = a - F.col(f"_f{i}{k}") * F.col(f"_f{j}{k}")
            est = est.withColumn(f"_f{i}{j}", F.sqrt(F.greatest(a, F.lit(1e-9))) if i == j else a / F.col(f"_f{j}{j}"))
    return est.select("_group", "_scale", *(f"_m{k}" for k in range(d)), *(f"_f{i}{j}" for i in range(d) for j in range(i + 1)))


def _distance(rows: DataFrame, est: DataFrame) -> DataFrame:
    """rows with _d2, the squared Mahalanobis distance under their group's estimate; null without one.

    est is a written table: where it has few groups it is broadcast, so that a hot group stays dealt out as it was read.
    """
    small = est.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    rows = rows.join(F.broadcast(_factor(est)) if small else _factor(est), "_group", "left")
    for i, v in enumerate(STATS):
        y = F.col(v) - F.col(f"_m{i}")
        for k in range(i):
            y = y - F.col(f"_f{i}{k}") * F.col(f"_y{k}")
        rows = rows.withColumn(f"_y{i}", y / F.col(f"_f{i}{i}"))
    d2 = sum((F.col(f"_y{i}") * F.col(f"_y{i}") for i in range(1, len(STATS))), F.col("_y0") * F.col("_y0"))
    return rows.withColumn("_d2", d2 / F.col("_scale")).drop(*(f"_y{i}" for i in range(len(STATS))))


def _step(rows: DataFrame, est: DataFrame) -> DataFrame:
    """One concentration step: mean and covariance of the nearest SUPPORT share of each group."""
    d = len(STATS)
    b = F.least(F.floor(F.log1p("_d2") * BINS), F.lit(MAX_BIN))
    sums = [F.sum(v).alias(f"_s{i}") for i, v in enumerate(STATS)] + [F.sum(F.col(STATS[i]) * F.col(STATS[j])).alias(f"_p{i}{j}") for i in range(d) for j in range(i + 1)]
    bins = _distance(rows, est).groupBy("_group", b.alias("_b")).agg(F.count("*").alias("_n"), *sums)
    w = Window.partitionBy("_group")
    bins = bins.withColumn("_upto", F.sum("_n").over(w.orderBy("_b"))).withColumn("_of", F.sum("_n").over(w))
    inside = F.col("_upto") - F.col("_n") < SUPPORT * F.col("_of")
    total = lambda c: F.sum(F.when(inside, F.col(c)))
    middle = F.min(F.when(F.col("_upto") >= 0.5 * F.col("_of"), F.expm1((F.col("_b") + 0.5) / BINS)))
    out = bins.groupBy("_group").agg(total("_n").alias("_n"), middle.alias("_middle"), *(total(f"_s{i}").alias(f"_s{i}") for i in range(d)), *(total(f"_p{i}{j}").alias(f"_p{i}{j}") for i in range(d) for j in range(i + 1)))
    mu = [(F.col(f"_s{i}") / F.col("_n")).alias(f"_m{i}") for i in range(d)]
    cov = [(F.col(f"_p{i}{j}") / F.col("_n") - F.col(f"_s{i}") * F.col(f"_s{j}") / F.col("_n") / F.col("_n")).alias(f"_c{i}{j}") for i in range(d) for j in range(i + 1)]
    return out.select("_group", *mu, *cov, F.greatest(F.col("_middle") / CHI2_MEDIAN, F.lit(1.0)).alias("_scale"))


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance) for each row of df.

    Null texts have no words. Null languages and sources are groups of their own. Texts that fail the base rules take no
    part in the estimates and have no distance. Repeated rows each count. An empty table gives an empty result. Other
    columns are not read, so their names cannot clash.
    """
    cuts = Cuts(df.sparkSession)
    rows = df.select(F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("_lang"), F.col(source_col).cast("string").alias("_source"), F.col(text_col).alias("_text"))
    rows = text_statistics(rows, "_text")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = cuts.cut(rows.withColumn("base_failed", failed).select("*", *_vector()), "quality-statistics", narrow=True)
    name = lambda *c: F.to_json(F.array(*(F.coalesce(F.concat(F.lit("="), x), F.lit("null")) for x in c)))
    sized = rows.where(~F.col("base_failed")).groupBy("_lang", "_source").agg(F.count("*").alias("c"))
    small, of_language = (F.sum(x).over(Window.partitionBy("_lang")) for x in (F.when(F.col("c") < MIN_ROWS, F.col("c")).otherwise(0), F.col("c")))
    fine, language = F.col("c") >= MIN_ROWS, name(F.col("_lang"))
    sized = sized.withColumn("_small", small).withColumn("_own", F.when(fine, name(F.col("_lang"), F.col("_source"))).when(of_language >= MIN_ROWS, language).otherwise("all"))
    sized = cuts.cut(sized, "quality-sizes", narrow=True)
    left = sized.agg(F.coalesce(F.sum(F.when(F.col("_own") == "all", F.col("c"))), F.lit(0)).alias("_left"))  # one row
    # estimates that lack rows of their own take in those of other groups, which are judged by their own
    lends = lambda to_few, group: F.when(to_few & (F.col("_own") != group), group)
    to_language, to_all = (F.col("_small") > 0) & (F.col("_small") < MIN_ROWS) & fine, (F.col("_left") > 0) & (F.col("_left") < MIN_ROWS)
    groups = F.array_compact(F.array("_own", lends(to_language, language), lends(to_all, F.lit("all"))))
    sized = sized.crossJoin(F.broadcast(left)).select(F.col("_lang").alias("_l"), F.col("_source").alias("_s"), groups.alias("_groups"))
    good = rows.where(~F.col("base_failed")).join(sized, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")))
    good = good.select("_id", F.posexplode("_groups").alias("_lent", "_group"), *STATS, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    good = cuts.cut(good, "quality-groups", narrow=True)
    est = cuts.cut(_start(good), "quality-start", narrow=True)
    for k in range(STEPS):
        est = cuts.cut(_step(good, est), f"quality-step-{k}", narrow=True)
    enough = good.groupBy("_group").agg(F.count("*").alias("c")).where(F.col("c") >= MIN_ROWS).select("_group")
    judged = _distance(good.where("_lent = 0"), cuts.cut(est.join(enough, "_group", "left_semi"), "quality-estimates", narrow=True))
    columns = [F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = judged.select(*columns, F.coalesce(F.col("_d2") <= cutoff, F.lit(True)).alias("kept"), F.col("_d2").alias("distance"))
    return judged.unionByName(rows.where("base_failed").select(*columns, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance")))


def op7_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))
