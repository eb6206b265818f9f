"""Join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardlens.functions.text import contains_ci
from boardlens.operators.features import complete_rows
from boardlens.operators.fuzzy import best_match
from boardlens.operators.joins import (
    flag_matching,
    inner_on,
    keep_matching,
    null_safe_left,
    preceded_by_other,
)
from boardlens.operators.windows import first_of_newest, first_per_key
from boardlens.plans.catalogue.registry import query
from boardlens.sources.tables import read_tables


@query("distinct_group", """
SELECT DISTINCT l_suppkey, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def distinct_group(spark, root):
    lineitem, orders = read_tables(spark, root, "lineitem", "orders")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_suppkey", "o_orderpriority").distinct()


@query("null_safe_left", """
WITH c AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
     s AS (SELECT nullif(c_mktsegment, 'BUILDING') AS segment, count(*)::DOUBLE AS firms,
                  round(avg(c_acctbal) + 1e-7, 4) AS balance
           FROM customer WHERE c_mktsegment <> 'FURNITURE' GROUP BY 1)
SELECT c_custkey, c.segment AS segment, firms, balance
FROM c LEFT JOIN s ON c.segment IS NOT DISTINCT FROM s.segment
""")
def null_safe_join(spark, root):
    (customer,) = read_tables(spark, root, "customer")
    segment = F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    per_segment = (
        customer.where("c_mktsegment <> 'FURNITURE'")
        .groupBy(segment)
        .agg(F.count("*").cast("double").alias("firms"), F.round(F.avg("c_acctbal") + 1e-7, 4).alias("balance"))
    )
    firms = customer.select("c_custkey", segment)
    return null_safe_left(firms, per_segment, ["segment"])


@query("suffix_join", """
SELECT o.custkey AS custkey, o.n AS n_x, c.n AS n_y
FROM (SELECT o_custkey AS custkey, count(*) AS n FROM orders GROUP BY 1) o
JOIN (SELECT c_custkey AS custkey, c_name AS n FROM customer) c ON o.custkey = c.custkey
""")
def suffix_join(spark, root):
    orders, customer = read_tables(spark, root, "orders", "customer")
    counts = orders.groupBy(F.col("o_custkey").alias("custkey")).agg(F.count("*").alias("n"))
    names = customer.select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("n"))
    return inner_on(counts, names, "custkey")


@query("internal_promotion", """
WITH e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, event_type, ts FROM events)
SELECT user_id, day, event_type,
       CAST(event_type = 'purchase' AND EXISTS (
         SELECT 1 FROM e a JOIN e b ON a.user_id = b.user_id AND a.day = b.day
         WHERE a.user_id = d.user_id AND a.day = d.day AND a.event_type = 'purchase'
           AND b.event_type <> 'purchase' AND a.ts >= b.ts) AS INTEGER) AS internal_promotion
FROM (SELECT DISTINCT user_id, day, event_type FROM e) d
""")
def internal_promotion(spark, root):
    (events,) = read_tables(spark, root, "events")
    spells = events.withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    keys = ["user_id", "day"]
    target = contains_ci(F.col("event_type"), "purchase")
    promoted = preceded_by_other(spells, keys, "event_type", target, F.col("ts"))
    labels = spells.select(*keys, "event_type").distinct()
    flagged = flag_matching(labels, promoted, [*keys, "event_type"], "internal_promotion")
    return flagged.withColumn("internal_promotion", F.col("internal_promotion").cast("int"))


@query("semi_join", """
SELECT c_custkey, c_mktsegment FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
""")
def semi_join(spark, root):
    customer, orders = read_tables(spark, root, "customer", "orders")
    big = orders.where("o_totalprice > 450000").withColumnRenamed("o_custkey", "c_custkey")
    return keep_matching(customer, big, ["c_custkey"]).select("c_custkey", "c_mktsegment")


@query("first_per_key", """
SELECT o_custkey, o_orderkey, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey)
        AS rn FROM orders) WHERE rn = 1
""")
def newest_order(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    newest = first_per_key(orders, ["o_custkey"], [F.col("o_orderdate").desc(), "o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus")


@query("latest_then_first", """
WITH newest AS (
  SELECT o_custkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, o_orderkey) AS rn
  FROM orders
), mine AS (
  SELECT o.*, row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderkey) AS pos
  FROM orders o JOIN newest n
    ON n.rn = 1 AND o.o_custkey = n.o_custkey AND o.o_orderpriority = n.o_orderpriority
)
SELECT o_custkey, o_orderkey, o_orderpriority FROM mine WHERE pos = 1
""")
def latest_then_first(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    rows = orders.select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("started")
    )
    picked = first_of_newest(rows, "o_custkey", "o_orderpriority", "started", ["o_orderkey"])
    return picked.drop("started")


@query("fuzzy_many_choices", """
WITH c AS (SELECT c_custkey, substr(md5(c_custkey::VARCHAR), 1, 15) AS code FROM customer),
q AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN substr(code, 2) WHEN 1 THEN code || 'zz' ELSE 'q' || substr(code, 1, 13) END AS name FROM c),
p AS (SELECT q.c_custkey, c.code, 100.0e0 * (greatest(length(name), length(code)) - levenshtein(name, code)) / greatest(length(name), length(code)) AS score
      FROM q JOIN c ON abs(length(name) - length(code)) <= 3)
SELECT c_custkey, code AS match, round(score, 6) AS score FROM p WHERE score >= 75
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY score DESC, code) = 1
""")
def fuzzy_many_choices(spark, root):
    """As many choices as customers; each name is a choice with letters lost or added."""
    (customer,) = read_tables(spark, root, "customer")
    code = F.substr(F.md5(F.col("c_custkey").cast("string")), F.lit(1), F.lit(15))
    kind = F.col("c_custkey") % 3
    name = (
        F.when(kind == 0, F.substr(code, F.lit(2)))
        .when(kind == 1, F.concat(code, F.lit("zz")))
        .otherwise(F.concat(F.lit("q"), F.substr(code, F.lit(1), F.lit(13))))
    )
    names = customer.select("c_custkey", name.alias("name"))
    found = best_match(names, "name", customer.select(code.alias("code")), "code", 75)
    return names.join(found, "name").select("c_custkey", "match", F.round("score", 6).alias("score"))


@query("fuzzy_low_cutoff", """
WITH q AS (
  SELECT p_partkey, substr(p_name, 1, length(p_name) // 2) || ' ' || substr(md5(p_partkey::VARCHAR), 1, CAST(p_partkey % 12 AS INTEGER)) AS name
  FROM part
), a AS (
  SELECT p_partkey, array_to_string(list_sort(string_split(trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS a FROM q
), c AS (
  SELECT DISTINCT p_name AS name, array_to_string(list_sort(string_split(
           trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS b
  FROM part
), s AS (
  SELECT p_partkey, name, 100.0e0 * (greatest(length(a), length(b)) - levenshtein(a, b)) / greatest(length(a), length(b)) AS score
  FROM a CROSS JOIN c WHERE a <> '' AND b <> ''
  QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY score DESC, name) = 1
)
SELECT p_partkey, cutoff, name AS match, round(score, 6) AS score
FROM s CROSS JOIN (VALUES (0), (30), (50)) t(cutoff) WHERE score >= cutoff
""")
def fuzzy_low_cutoff(spark, root):
    """Half a name and some noise against all names, down to cutoffs that no shared segment reaches."""
    (part,) = read_tables(spark, root, "part")
    noise = F.substr(F.md5(F.col("p_partkey").cast("string")), F.lit(1), (F.col("p_partkey") % 12).cast("int"))
    half = F.substr("p_name", F.lit(1), F.floor(F.length("p_name") / 2).cast("int"))
    names = part.select("p_partkey", F.concat(half, F.lit(" "), noise).alias("name"))
    found = [
        names.join(best_match(names, "name", part, "p_name", cutoff), "name").select(
            "p_partkey", F.lit(cutoff).alias("cutoff"), "match", F.round("score", 6).alias("score")
        )
        for cutoff in (0, 30, 50)
    ]
    return found[0].union(found[1]).union(found[2])


@query("fuzzy_best_match", """
WITH q AS (
  SELECT p_partkey, CASE p_partkey % 4
           WHEN 0 THEN upper(split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1))
           WHEN 1 THEN left(p_name, length(p_name) - 1)
           WHEN 2 THEN 'x' || p_name
           ELSE 'university of ' || p_name END AS university
  FROM part
), names AS (
  SELECT DISTINCT university AS raw, array_to_string(list_sort(string_split(
           trim(regexp_replace(lower(university), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS a
  FROM q
), choices AS (
  SELECT DISTINCT p_name AS name, array_to_string(list_sort(string_split(
           trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS b
  FROM part
), scored AS (
  SELECT raw, name, 100.0e0 * (greatest(length(a), length(b)) - levenshtein(a, b))
                    / greatest(length(a), length(b)) AS score
  FROM names CROSS JOIN choices
), best AS (
  SELECT raw, name, score,
         row_number() OVER (PARTITION BY raw ORDER BY score DESC, name) AS rn
  FROM scored WHERE score >= 80
)
SELECT p_partkey, university, name AS "match", round(score, 6) AS score
FROM q LEFT JOIN best ON university = raw AND rn = 1
""")
def fuzzy_best_match(spark, root):
    (part,) = read_tables(spark, root, "part")
    kind, name = F.col("p_partkey") % 4, F.col("p_name")
    words = F.split(name, " ")
    wanted = part.select(
        "p_partkey",
        F.when(kind == 0, F.upper(F.concat(words[1], F.lit(", "), words[0])))
        .when(kind == 1, F.substr(name, F.lit(1), F.length(name) - 1))
        .when(kind == 2, F.concat(F.lit("x"), name))
        .otherwise(F.concat(F.lit("university of "), name))
        .alias("university"),
    )
    matched = best_match(wanted, "university", part, "p_name", cutoff=80)
    return wanted.join(
        matched.withColumn("score", F.round("score", 6)), "university", "left"
    )


@query("dropna_any", """
WITH big AS (
  SELECT o_custkey, count(*) AS n, nullif(max(o_orderpriority), '5-LOW') AS worst
  FROM orders WHERE o_totalprice > 400000 GROUP BY o_custkey
)
SELECT c_custkey, n, worst
FROM customer JOIN big ON c_custkey = o_custkey WHERE worst IS NOT NULL
""")
def dropna_any(spark, root):
    customer, orders = read_tables(spark, root, "customer", "orders")
    big = (
        orders.where("o_totalprice > 400000")
        .groupBy("o_custkey")
        .agg(
            F.count("*").alias("n"),
            F.nullif(F.max("o_orderpriority"), F.lit("5-LOW")).alias("worst"),
        )
    )
    joined = customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left")
    return complete_rows(joined.select("c_custkey", "n", "worst"))
