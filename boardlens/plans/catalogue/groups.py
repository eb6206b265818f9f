"""Aggregates, windows and the statistics of repeated runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardlens.functions.bins import bin_number, label_bins
from boardlens.functions.text import matches_ci, yes_no
from boardlens.operators import aggregates, compare
from boardlens.operators.windows import row_lag
from boardlens.plans.catalogue.registry import query
from boardlens.plans.governance import last_change
from boardlens.sources.tables import read_tables


@query("multi_agg", """
SELECT o_custkey, o_orderpriority, round(avg(o_totalprice) + 1e-7, 4) AS uniscoreavg,
       CAST(max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS INTEGER) AS bachelors,
       strftime(min(o_orderdate), '%Y-%m-%d') AS startdate,
       strftime(max(o_orderdate), '%Y-%m-%d') AS enddate
FROM orders GROUP BY o_custkey, o_orderpriority
""")
def multi_agg(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    return orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.round(F.avg("o_totalprice") + 1e-7, 4).alias("uniscoreavg"),
        F.bool_or(F.col("o_orderstatus") == "F").cast("int").alias("bachelors"),
        F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("startdate"),
        F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("enddate"),
    )


@query("firm_rollup", """
SELECT o_custkey, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority,
       round(avg(o_totalprice) + 1e-7, 4) AS o_totalprice,
       CAST(max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS INTEGER) AS pending,
       CAST(sum(year(o_orderdate)) AS BIGINT) AS tenure
FROM orders GROUP BY o_custkey ORDER BY o_custkey
""")
def firm_rollup(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    rows = orders.withColumns(
        {"pending": F.col("o_orderstatus") == "P", "tenure": F.year("o_orderdate")}
    )
    rolled = aggregates.firm_rollup(
        rows,
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        first=["o_orderpriority"],
        mean=["o_totalprice"],
        any_of=["pending"],
        total=["tenure"],
    )
    return rolled.withColumns(
        {"o_totalprice": F.round(F.col("o_totalprice") + 1e-7, 4), "pending": F.col("pending").cast("int")}
    ).orderBy("o_custkey")


@query("distinct_counts_left", """
SELECT o_custkey::VARCHAR AS ticker, count(DISTINCT l_partkey) AS num_committees, count(DISTINCT l_suppkey) AS dirs
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
GROUP BY o_custkey
""")
def distinct_counts_left(spark, root):
    lineitem, orders = read_tables(spark, root, "lineitem", "orders")
    settled = orders.where("o_orderstatus <> 'P'")
    joined = lineitem.join(settled, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    counts = {"num_committees": "l_partkey", "dirs": "l_suppkey"}
    firms = joined.withColumn("ticker", F.col("o_custkey").cast("string"))
    return aggregates.distinct_counts(firms, ["ticker"], counts)


ATTENDANCE = """
  SELECT l_orderkey,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END) // count(*) AS BIGINT)
           AS over75_pct,
         count(CASE WHEN l_linenumber > 2 THEN l_shipdate END) AS num_meetings
  FROM lineitem GROUP BY l_orderkey
"""


def _attendance(lineitem):
    return (
        lineitem.withColumn("attend", F.when(F.col("l_returnflag") == "R", 0).otherwise(1))
        .withColumn("meetingdate", F.when(F.col("l_linenumber") > 2, F.col("l_shipdate")))
        .groupBy("l_orderkey")
        .agg(
            aggregates.integer_share("attend").alias("over75_pct"),
            F.count("meetingdate").alias("num_meetings"),
        )
    )


@query("attendance_div", ATTENDANCE)
def attendance_div(spark, root):
    (lineitem,) = read_tables(spark, root, "lineitem")
    return _attendance(lineitem)


@query("avg_meetings_ratio", f"""
WITH a AS ({ATTENDANCE}),
     c AS (SELECT l_orderkey, count(DISTINCT CASE WHEN l_linestatus = 'F' THEN l_suppkey END)
             AS num_committees FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, num_meetings, num_committees,
       round(num_meetings / nullif(num_committees, 0), 6) AS avg_meetings
FROM a JOIN c USING (l_orderkey)
""")
def avg_meetings_ratio(spark, root):
    (lineitem,) = read_tables(spark, root, "lineitem")
    finished = lineitem.withColumn(
        "committee", F.when(F.col("l_linestatus") == "F", F.col("l_suppkey"))
    )
    counts = aggregates.distinct_counts(finished, ["l_orderkey"], {"num_committees": "committee"})
    ratio = F.try_divide("num_meetings", "num_committees")
    return (
        _attendance(lineitem)
        .drop("over75_pct")
        .join(counts, "l_orderkey")
        .withColumn("avg_meetings", F.round(ratio, 6))
    )


@query("flag_share", """
SELECT o_custkey,
       round(count(*) FILTER (WHERE o_orderstatus = 'P') / count(*), 6) AS female_pct
FROM orders GROUP BY o_custkey HAVING count(*) FILTER (WHERE o_orderstatus = 'P') > 0
""")
def flag_share(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    status = F.when(F.col("o_orderstatus") == "P", "Yes").when(F.col("o_orderstatus") == "F", "No")
    flagged = orders.withColumn("female", yes_no(status))
    shares = aggregates.flag_share(flagged, "o_custkey", F.col("female") == "Yes", "female_pct")
    return shares.withColumn("female_pct", F.round("female_pct", 6))


@query("keyword_any", """
SELECT source || '/' || lang AS ticker,
       CAST(bool_or(coalesce(regexp_matches(text, '(?i)licen|secret|apache'), FALSE)) AS INTEGER)
         AS diversity_board
FROM documents GROUP BY 1
""")
def keyword_any(spark, root):
    (documents,) = read_tables(spark, root, "documents")
    firms = documents.select(F.concat_ws("/", "source", "lang").alias("ticker"), "text")
    named = matches_ci(F.col("text"), "licen|secret|apache")
    any_named = aggregates.any_true(firms, "ticker", named, "diversity_board")
    return any_named.withColumn("diversity_board", F.col("diversity_board").cast("int"))


@query("shannon_index", """
WITH e AS (SELECT user_id, nullif(event_type, 'error') AS kind FROM events),
     c AS (SELECT user_id, kind, count(*) AS n FROM e GROUP BY ALL),
     t AS (SELECT user_id, count(*) AS total FROM e GROUP BY ALL)
SELECT user_id, round(abs(sum(n / total * ln(n / total))), 6) AS shannon
FROM c JOIN t USING (user_id) WHERE kind IS NOT NULL GROUP BY user_id
""")
def shannon_index(spark, root):
    (events,) = read_tables(spark, root, "events")
    kinds = events.withColumn("kind", F.nullif("event_type", F.lit("error")))
    index = aggregates.shannon_index(kinds, "user_id", "kind", "shannon")
    return index.withColumn("shannon", F.round("shannon", 6))


LAG = """
WITH s AS (
  SELECT DISTINCT o_custkey, o_orderdate, o_orderkey,
         CASE WHEN o_orderkey % 11 > 0 THEN o_totalprice / 1e6 END AS roa
  FROM orders
), l AS (
  SELECT *, lag(roa, 4) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev
  FROM s
)
"""
LAST_CHANGE = LAG + """, changes AS (
  SELECT o_custkey, arg_max(roa - prev, (o_orderdate, o_orderkey))
           FILTER (WHERE roa IS NOT NULL) AS change
  FROM l WHERE prev IS NOT NULL GROUP BY o_custkey
)
"""
ORDER = ["o_orderdate", "o_orderkey"]


def _series(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    roa = F.when(F.col("o_orderkey") % 11 > 0, F.col("o_totalprice") / F.lit(1e6))
    return orders.select("o_custkey", *ORDER, roa.alias("roa"))


@query("lag_rows", LAG + """
SELECT o_custkey, o_orderkey, round(roa, 8) AS roa, round(prev, 8) AS roa_prev_year FROM l
""")
def lag_rows(spark, root):
    lagged = row_lag(_series(spark, root), "o_custkey", ORDER, "roa", 4, "roa_prev_year")
    return lagged.select(
        "o_custkey",
        "o_orderkey",
        F.round("roa", 8).alias("roa"),
        F.round("roa_prev_year", 8).alias("roa_prev_year"),
    )


@query("lag_delta", LAST_CHANGE + "SELECT o_custkey, round(change, 8) AS roachange FROM changes")
def lag_delta(spark, root):
    change = last_change(_series(spark, root), "o_custkey", ORDER, "roa", 4, "roachange")
    return change.withColumn("roachange", F.round("roachange", 8))


@query("bin_labels", LAST_CHANGE + """
, rounded AS (SELECT o_custkey, round(change + 1e-9, 2) AS change FROM changes)
SELECT o_custkey,
       CASE WHEN change <= -0.10e0 THEN 'Significant Decrease'
            WHEN change <= -0.03e0 THEN 'Moderate Decrease'
            WHEN change <= 0.0e0 THEN 'Slight Decrease'
            WHEN change <= 0.01e0 THEN 'Stable'
            WHEN change <= 0.02e0 THEN 'Slight Increase'
            WHEN change <= 0.10e0 THEN 'Moderate Increase'
            WHEN change > 0.10e0 THEN 'Significant Increase' END AS roachange,
       CAST(CASE WHEN change <= -0.10e0 THEN 0 WHEN change <= -0.03e0 THEN 1
                 WHEN change <= 0.0e0 THEN 2 WHEN change <= 0.01e0 THEN 3
                 WHEN change <= 0.02e0 THEN 4 WHEN change <= 0.10e0 THEN 5
                 WHEN change > 0.10e0 THEN 6 END AS DOUBLE) AS bin
FROM rounded
""")
def bin_labels(spark, root):
    change = last_change(_series(spark, root), "o_custkey", ORDER, "roa", 4, "change")
    label = label_bins(F.round(F.col("change") + 1e-9, 2))
    return change.select("o_custkey", label.alias("roachange")).withColumn(
        "bin", bin_number(F.col("roachange")).cast("double")
    )


MOMENTS = """
WITH g AS (SELECT event_type AS model, count(value) AS n, avg(value) AS mean,
                  stddev_samp(value) AS sd FROM events GROUP BY event_type)
"""


def _moments(spark, root):
    (events,) = read_tables(spark, root, "events")
    return compare.group_moments(events, "event_type", "value")


@query("model_summary", MOMENTS + """
SELECT model, n, round(mean, 6) AS mean, round(sd, 6) AS sd, round(sd / sqrt(n), 6) AS se,
       round((mean - 50) / (sd / sqrt(n)), 6) AS t
FROM g
""")
def model_summary(spark, root):
    tested = compare.against_baseline(_moments(spark, root), 50.0)
    return tested.select("model", "n", *[F.round(c, 6).alias(c) for c in ("mean", "sd", "se", "t")])


@query("welch_top2", MOMENTS + """
, r AS (SELECT *, row_number() OVER (ORDER BY mean DESC, model) AS rn FROM g),
v AS (SELECT a.model AS best, b.model AS second, a.mean - b.mean AS gap,
             a.sd * a.sd / a.n AS va, b.sd * b.sd / b.n AS vb, a.n AS na, b.n AS nb
      FROM r a, r b WHERE a.rn = 1 AND b.rn = 2)
SELECT best, second, round(gap / sqrt(va + vb), 6) AS t,
       round(pow(va + vb, 2) / (va * va / (na - 1) + vb * vb / (nb - 1)), 4) AS df
FROM v
""")
def welch_top2(spark, root):
    pair = compare.welch_top2(_moments(spark, root))
    return pair.select("best", "second", F.round("t", 6).alias("t"), F.round("df", 4).alias("df"))


@query("anova_f", MOMENTS + """
, m AS (SELECT sum(n * mean) / sum(n) AS grand FROM g)
SELECT round((sum(n * pow(mean - grand, 2)) / (count(*) - 1))
             / (sum((n - 1) * sd * sd) / (sum(n) - count(*))), 6) AS f,
       CAST(count(*) - 1 AS DOUBLE) AS df_between,
       CAST(sum(n) - count(*) AS DOUBLE) AS df_within
FROM g, m
""")
def anova_f(spark, root):
    table = compare.anova_f(_moments(spark, root))
    return table.select(F.round("f", 6).alias("f"), "df_between", "df_within")


# Upper 10 % points: of t for the hundreds or thousands of degrees of freedom of a group here, and
# of F for four and as many degrees of freedom. They stand for p < 0.10, which SQL can't compute.
T_POINT, F_POINT = 1.2819, 1.9455


@query("model_verdict", MOMENTS + f"""
, tested AS (SELECT *, (mean - 45) / (sd / sqrt(n)) AS t FROM g),
s AS (SELECT *, row_number() OVER (ORDER BY mean DESC, model) AS rn FROM tested WHERE abs(t) > {T_POINT}),
w AS (SELECT a.model AS best, (a.mean - b.mean) / sqrt(a.sd * a.sd / a.n + b.sd * b.sd / b.n) AS t
      FROM s a, s b WHERE a.rn = 1 AND b.rn = 2),
f AS (SELECT (sum(n * pow(mean - (SELECT sum(n * mean) / sum(n) FROM s), 2)) / (count(*) - 1))
             / (sum((n - 1) * sd * sd) / (sum(n) - count(*))) AS f FROM s),
rule AS (SELECT CASE WHEN count(*) = 0 THEN 'none significant' WHEN count(*) = 1 THEN 'only significant model'
                     WHEN (SELECT t FROM w) > {T_POINT} THEN 'welch' WHEN (SELECT f FROM f) > {F_POINT} THEN 'anova'
                     ELSE 'no difference' END AS rule FROM s)
SELECT g.model, g.n, round(g.mean, 6) AS mean_accuracy, round(g.sd, 6) AS sd, round(t.t, 6) AS t,
       CAST(abs(t.t) > {T_POINT} AS INTEGER) AS significant, rule,
       CAST(coalesce(rule IN ('only significant model', 'welch', 'anova') AND g.model = (SELECT model FROM s WHERE rn = 1), FALSE) AS INTEGER) AS chosen
FROM g JOIN tested t USING (model), rule
""")
def model_verdict(spark, root):
    (events,) = read_tables(spark, root, "events")
    runs = events.select(F.col("event_type").alias("model"), F.col("value").alias("accuracy"))
    out = compare.report(runs, baseline=45.0).drop("p_value")
    flags = {c: F.col(c).cast("int") for c in ("significant", "chosen")}
    return out.withColumns(flags | {c: F.round(c, 6) for c in ("mean_accuracy", "sd", "t")})


@query("lag_long_keys", """
SELECT event_type, event_id, round(lag(value, 3) OVER (PARTITION BY event_type ORDER BY day NULLS FIRST, event_id), 6) AS before
FROM (SELECT *, CASE WHEN event_id % 7 > 0 THEN CAST(ts AS DATE) END AS day FROM events)
""")
def lag_long_keys(spark, root):
    """A row lag whose keys are all longer than a run; the first order column is null on some rows."""
    (events,) = read_tables(spark, root, "events")
    day = F.when(F.col("event_id") % 7 > 0, F.to_date("ts"))
    rows = events.select("event_type", day.alias("day"), "event_id", "value")
    lagged = row_lag(rows, "event_type", ["day", "event_id"], "value", 3, "before", split_rows=500)
    return lagged.select("event_type", "event_id", F.round("before", 6).alias("before"))
