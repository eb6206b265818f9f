"""Stage tables and model preparation, with the test tables in the part of the source tables.

Orders are firms' boards, line items their seats and roles, parts the degrees and rankings.
The SQL texts join everything with everything the way the tables are described, so they also
check the shortcuts of the stage functions.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from boardlens.operators import features
from boardlens.plans import governance as gov
from boardlens.plans.catalogue.registry import query
from boardlens.plans.experiments import BINARY, NUMERIC, prepare_features
from boardlens.sources.tables import read_tables, snapshot

YEAR = 1998
AS_OF = "2003-06-30"

SOURCES = """
WITH companies AS (
  SELECT CASE WHEN c_custkey % 97 > 0 THEN c_custkey::VARCHAR END AS ticker,
         c_mktsegment AS spindex
  FROM customer
), orgs AS (
  SELECT o_orderkey AS boardid, CASE WHEN o_custkey % 101 > 0 THEN o_custkey::VARCHAR END AS ticker
  FROM orders
), committees AS (
  SELECT l_orderkey AS boardid,
         CASE WHEN l_returnflag = 'R' AND l_linenumber = 4 THEN 'Social Inclusion'
              ELSE 'C' || l_linenumber || l_returnflag END AS committeename,
         l_suppkey AS directorid
  FROM lineitem
), directors AS (
  SELECT o_custkey::VARCHAR AS ticker, year(o_orderdate)::DOUBLE AS year,
         o_orderkey % 50 AS director_detail_id,
         CASE o_orderstatus WHEN 'P' THEN 'Yes' WHEN 'F' THEN 'No' END AS female,
         nullif(o_orderpriority, '5-LOW') AS ethnicity,
         CASE WHEN o_orderkey % 17 = 0 THEN 'Yes' WHEN o_orderkey % 2 = 0 THEN 'No' END
           AS attend_less75_pct,
         CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate::DATE END AS meetingdate
  FROM orders
), roles AS (
  SELECT l_orderkey AS companyid, l_suppkey % 25 AS directorid,
         CASE WHEN l_partkey % 3 = 0 THEN 'D ' ELSE 'D' END || (l_suppkey % 25) AS directorname,
         CASE l_linenumber WHEN 1 THEN 'CEO' WHEN 2 THEN 'Regional CEO' WHEN 3 THEN 'CFO'
              WHEN 4 THEN 'Co-CEO' WHEN 5 THEN 'Founder/CEO' WHEN 6 THEN 'Director' END AS rolename,
         strftime(l_shipdate, '%Y-%m-%d') AS datestartrole,
         CASE WHEN l_quantity < 10 THEN 'N'
              WHEN l_quantity < 40 THEN strftime(l_shipdate + INTERVAL 500 DAY, '%Y-%m-%d')
              END AS dateendrole
  FROM lineitem
), education AS (
  SELECT p_partkey % 20 AS directorid,
         CASE p_partkey % 5
           WHEN 0 THEN split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
           WHEN 1 THEN left(p_name, length(p_name) - 1) WHEN 2 THEN 'y' || p_name
           WHEN 3 THEN 'university of ' || p_name END AS companyname,
         CASE p_type WHEN 'ECONOMY' THEN 'MBA' WHEN 'SMALL' THEN 'BSc (Hons)'
              WHEN 'MEDIUM' THEN 'MSc' WHEN 'LARGE' THEN 'PhD' WHEN 'PROMO' THEN 'Diploma'
              END AS qualification
  FROM part
), rankings AS (
  SELECT CASE WHEN p_brand = 'Brand#1' THEN 'Reporter' WHEN p_brand <> 'Brand#2' THEN p_brand END
           AS rank,
         p_name AS name,
         CASE p_size % 4 WHEN 0 THEN '—' WHEN 1 THEN p_size || '—' || (p_size + 10)
              WHEN 2 THEN p_size || '–' || (p_size + 20) ELSE p_size::VARCHAR END
           AS scores_overall
  FROM part
), ratios AS (
  SELECT o_custkey::VARCHAR AS ticker, o_orderdate::DATE AS qdate,
         CASE WHEN o_orderkey % 11 > 0 AND o_orderkey % 13 > 0 THEN o_totalprice / 1e6 END AS roa
  FROM orders
)
"""

COUNTS = ["num_committees", "dirs", "over75_pct", "num_meetings"]
COUNTS_SQL = ", ".join(f"{c}::DOUBLE AS {c}" for c in COUNTS)
BOARD_FLAG_SQL = "diversity_board::INTEGER::DOUBLE AS diversity_board"

UNIVERSITIES = """
, universities AS (
  SELECT name, avg(CASE WHEN contains(s, '-')
                   THEN (split_part(s, '-', 1)::DOUBLE + split_part(s, '-', 2)::DOUBLE) / 2
                   ELSE s::DOUBLE END) AS uniscoreavg
  FROM (SELECT name, regexp_replace(scores_overall, '[—–]', '-') AS s FROM rankings
        WHERE rank IS DISTINCT FROM 'Reporter' AND scores_overall NOT IN ('—', '-'))
  GROUP BY name
)
"""

CEO = UNIVERSITIES + """
, listed AS (SELECT DISTINCT ticker FROM companies WHERE ticker IS NOT NULL),
held AS (
  SELECT DISTINCT ticker, directorid, directorname, rolename, datestartrole, dateendrole
  FROM roles JOIN orgs ON boardid = companyid JOIN listed USING (ticker)
),
names AS (
  SELECT DISTINCT companyname AS raw, array_to_string(list_sort(string_split(
           trim(regexp_replace(lower(companyname), '[^a-z0-9]+', ' ', 'g')), ' ')), ' ') AS a
  FROM education WHERE companyname IS NOT NULL
), choices AS (
  SELECT name, uniscoreavg, array_to_string(list_sort(string_split(name, ' ')), ' ') AS b
  FROM universities
), matched AS (
  SELECT raw, uniscoreavg FROM names CROSS JOIN choices
  WHERE 100.0e0 * (greatest(length(a), length(b)) - levenshtein(a, b))
        / greatest(length(a), length(b)) >= 80
  QUALIFY row_number() OVER (PARTITION BY raw ORDER BY
    100.0e0 * (greatest(length(a), length(b)) - levenshtein(a, b))
    / greatest(length(a), length(b)) DESC, name) = 1
), degrees AS (
  SELECT DISTINCT directorid, companyname, qualification, uniscoreavg,
         lower(coalesce(qualification, '')) AS q
  FROM education LEFT JOIN matched ON companyname = raw
), pulled AS (
  SELECT h.*, uniscoreavg, coalesce(q, '') IN ('mba', 'bsc (hons)') AS bachelors,
         coalesce(q, '') IN ('msc', 'diploma') AS masters, coalesce(q, '') = 'mba' AS mba,
         coalesce(q, '') = 'phd' AS phd
  FROM held h LEFT JOIN degrees USING (directorid)
  WHERE rolename ILIKE '%ceo%' AND NOT rolename ILIKE '%regional%'
    AND NOT rolename ILIKE '%division%'
), spells AS (
  SELECT ticker, directorid, directorname, rolename, avg(uniscoreavg) AS uniscoreavg,
         bool_or(bachelors) AS bachelors, bool_or(masters) AS masters, bool_or(mba) AS mba,
         bool_or(phd) AS phd, min(datestartrole::DATE) AS s,
         max(coalesce(try_cast(dateendrole AS DATE), DATE '2003-06-30')) AS e
  FROM pulled GROUP BY ALL
), promoted AS (
  SELECT DISTINCT c.ticker, c.directorid, c.rolename
  FROM held c JOIN held n ON c.ticker = n.ticker AND c.directorid = n.directorid
  WHERE c.rolename ILIKE '%ceo%' AND NOT n.rolename ILIKE '%ceo%'
    AND c.datestartrole >= n.datestartrole
), ceo AS (
  SELECT s.*, p.ticker IS NOT NULL AS internal_promotion, year(e) - year(s) AS tenure,
         rolename ILIKE '%founder%' AS founder, rolename ILIKE '%co-ceo%' AS is_co_ceo,
         CASE WHEN rolename ILIKE '%co-ceo%' THEN 12345 ELSE directorid END AS holder,
         CASE WHEN rolename ILIKE '%co-ceo%' THEN 2030 ELSE year(s) END AS validstart
  FROM spells s LEFT JOIN promoted p USING (ticker, directorid, rolename)
), newest AS (
  SELECT ticker, holder FROM ceo QUALIFY row_number() OVER (
    PARTITION BY ticker ORDER BY validstart DESC, directorid, directorname, rolename) = 1
), ceo_v0 AS (
  SELECT ticker, round(uniscoreavg, 6) AS uniscoreavg, bachelors, masters, mba, phd,
         internal_promotion, tenure::INTEGER AS tenure, founder, is_co_ceo
  FROM ceo JOIN newest USING (ticker, holder)
  QUALIFY row_number() OVER (
    PARTITION BY ticker ORDER BY directorid, directorname, rolename) = 1
)
"""

BOARD = """
, comms AS (
  SELECT ticker, count(DISTINCT committeename) AS num_committees, count(DISTINCT directorid) AS dirs
  FROM committees LEFT JOIN orgs USING (boardid) GROUP BY ticker
), attended AS (
  SELECT ticker, CASE WHEN attend_less75_pct = 'Yes' THEN 0 ELSE 1 END AS attend, meetingdate
  FROM directors WHERE year = 1998
), dirs AS (
  SELECT ticker, CAST(sum(attend) // count(attend) AS BIGINT) AS over75_pct,
         count(meetingdate) AS num_meetings
  FROM attended GROUP BY ticker
), board_v0 AS (
  SELECT c.ticker, spindex, num_committees, m.dirs AS dirs, over75_pct, num_meetings,
         round(num_meetings / num_committees, 6) AS avg_meetings
  FROM companies c LEFT JOIN comms m ON c.ticker IS NOT DISTINCT FROM m.ticker
                   LEFT JOIN dirs d ON c.ticker IS NOT DISTINCT FROM d.ticker
)
"""

DIVERSITY = """
, people AS (
  SELECT DISTINCT d.ticker, director_detail_id, female, ethnicity, committeename
  FROM directors d LEFT JOIN orgs o ON o.ticker = d.ticker
                   LEFT JOIN committees c ON c.boardid = o.boardid
  WHERE d.year = 1998 AND d.ticker IS NOT NULL
), total AS (
  SELECT ticker, count(*) AS total, count(*) FILTER (WHERE female = 'Yes') AS women,
         coalesce(bool_or(regexp_matches(committeename, '(?i)divers|incl|sustai')), FALSE) AS board
  FROM people GROUP BY ticker
), shares AS (
  SELECT ticker, count(*) / any_value(total) AS p
  FROM people JOIN total USING (ticker) WHERE ethnicity IS NOT NULL GROUP BY ticker, ethnicity
), div AS (
  SELECT ticker, women / total AS female_pct, board AS diversity_board, abs(h) AS shannon
  FROM total JOIN (SELECT ticker, sum(p * ln(p)) AS h FROM shares GROUP BY ticker) USING (ticker)
  WHERE women > 0
), div_v0 AS (
  SELECT c.ticker, spindex, round(female_pct, 6) AS female_pct, diversity_board,
         round(shannon, 6) AS shannon
  FROM companies c LEFT JOIN div d ON c.ticker IS NOT DISTINCT FROM d.ticker
)
"""

ROA = """
, series AS (
  SELECT *, lag(roa, 4) OVER (PARTITION BY ticker ORDER BY qdate, roa NULLS FIRST) AS prev
  FROM (SELECT DISTINCT ticker, qdate, roa FROM ratios)
), roa AS (
  SELECT ticker, arg_max(roa - prev, (qdate, roa)) FILTER (WHERE roa IS NOT NULL) AS change
  FROM series WHERE prev IS NOT NULL GROUP BY ticker
), roa_v0 AS (
  SELECT ticker, CASE WHEN change <= -0.10e0 THEN 'Significant Decrease'
            WHEN change <= -0.03e0 THEN 'Moderate Decrease'
            WHEN change <= 0.0e0 THEN 'Slight Decrease'
            WHEN change <= 0.01e0 THEN 'Stable'
            WHEN change <= 0.02e0 THEN 'Slight Increase'
            WHEN change <= 0.10e0 THEN 'Moderate Increase'
            WHEN change > 0.10e0 THEN 'Significant Increase' END AS roachange
  FROM roa
)
"""

WIDE = SOURCES + CEO + BOARD + DIVERSITY + ROA + """
, full_v0 AS (
  SELECT c.*, female_pct, diversity_board, shannon, spindex, num_committees, dirs, over75_pct,
         num_meetings, avg_meetings, roachange
  FROM ceo_v0 c JOIN (SELECT * EXCLUDE (spindex) FROM div_v0) USING (ticker)
       JOIN board_v0 USING (ticker) JOIN roa_v0 USING (ticker)
)
"""


def sources(spark, root):
    """The source tables by name."""
    customer, orders, lineitem, part = read_tables(
        spark, root, "customer", "orders", "lineitem", "part"
    )
    key, firm = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    line, director = F.col("l_linenumber"), F.col("l_suppkey") % 25
    name, size = F.col("p_name"), F.col("p_size")
    shipped = F.to_date("l_shipdate")

    def case(column, values):
        out = F.when(F.lit(False), None)
        for value, result in values.items():
            out = out.when(column == value, result)
        return out

    return {
        "companies": customer.select(
            F.when(F.col("c_custkey") % 97 > 0, F.col("c_custkey").cast("string")).alias("ticker"),
            F.col("c_mktsegment").alias("spindex"),
        ),
        "orgs": orders.select(
            key.alias("boardid"), F.when(F.col("o_custkey") % 101 > 0, firm).alias("ticker")
        ),
        "committees": lineitem.select(
            F.col("l_orderkey").alias("boardid"),
            F.when((F.col("l_returnflag") == "R") & (line == 4), "Social Inclusion")
            .otherwise(F.concat(F.lit("C"), line, "l_returnflag"))
            .alias("committeename"),
            F.col("l_suppkey").alias("directorid"),
        ),
        "directors": orders.select(
            firm.alias("ticker"),
            F.year("o_orderdate").cast("double").alias("year"),
            (key % 50).alias("director_detail_id"),
            case(F.col("o_orderstatus"), {"P": "Yes", "F": "No"}).alias("female"),
            F.nullif("o_orderpriority", F.lit("5-LOW")).alias("ethnicity"),
            F.when(key % 17 == 0, "Yes").when(key % 2 == 0, "No").alias("attend_less75_pct"),
            F.when(key % 5 > 0, F.to_date("o_orderdate")).alias("meetingdate"),
        ),
        "roles": lineitem.select(
            F.col("l_orderkey").alias("companyid"),
            director.alias("directorid"),
            F.concat(F.when(F.col("l_partkey") % 3 == 0, "D ").otherwise("D"), director).alias("directorname"),
            case(
                line,
                {
                    1: "CEO", 2: "Regional CEO", 3: "CFO", 4: "Co-CEO", 5: "Founder/CEO",
                    6: "Director",
                },
            ).alias("rolename"),
            shipped.cast("string").alias("datestartrole"),
            F.when(F.col("l_quantity") < 10, "N")
            .when(F.col("l_quantity") < 40, F.date_add(shipped, 500).cast("string"))
            .alias("dateendrole"),
        ),
        "education": part.select(
            (F.col("p_partkey") % 20).alias("directorid"),
            F.when(
                F.col("p_partkey") % 5 == 0,
                F.concat(F.split(name, " ")[1], F.lit(", "), F.split(name, " ")[0]),
            )
            .when(F.col("p_partkey") % 5 == 1, F.substr(name, F.lit(1), F.length(name) - 1))
            .when(F.col("p_partkey") % 5 == 2, F.concat(F.lit("y"), name))
            .when(F.col("p_partkey") % 5 == 3, F.concat(F.lit("university of "), name))
            .alias("companyname"),
            case(
                F.col("p_type"),
                {
                    "ECONOMY": "MBA", "SMALL": "BSc (Hons)", "MEDIUM": "MSc", "LARGE": "PhD",
                    "PROMO": "Diploma",
                },
            ).alias("qualification"),
        ),
        "rankings": part.select(
            F.when(F.col("p_brand") == "Brand#1", "Reporter")
            .when(F.col("p_brand") != "Brand#2", F.col("p_brand"))
            .alias("rank"),
            name.alias("name"),
            F.when(size % 4 == 0, "—")
            .when(size % 4 == 1, F.concat(size, F.lit("—"), size + 10))
            .when(size % 4 == 2, F.concat(size, F.lit("–"), size + 20))
            .otherwise(size.cast("string"))
            .alias("scores_overall"),
        ),
        "ratios": orders.select(
            firm.alias("ticker"),
            F.to_date("o_orderdate").alias("qdate"),
            F.when((key % 11 > 0) & (key % 13 == 0), float("nan"))
            .when(key % 11 > 0, F.col("o_totalprice") / F.lit(1e6))
            .alias("roa"),
        ),
    }


def _rounded(df, *cols, places=6):
    return df.withColumns({c: F.round(c, places) for c in cols})


def _as_double(df, *cols):
    """Columns that may be null as doubles, so that any client shows them alike."""
    return df.withColumns({c: F.col(c).cast("int").cast("double") for c in cols})


def _ceo(t):
    universities = gov.universities(t["rankings"])
    return gov.ceo_background(
        t["companies"], t["roles"], t["orgs"], t["education"], universities, AS_OF
    )


def _board(t):
    return gov.board_structure(t["companies"], t["committees"], t["orgs"], t["directors"], YEAR)


def _diversity(t):
    return gov.director_diversity(
        t["companies"], t["directors"], t["orgs"], t["committees"], YEAR
    )


def wide(spark, root):
    """The wide table over the source tables."""
    t = sources(spark, root)
    roa = gov.roa_change_class(gov.roa_change(t["ratios"]))
    return gov.wide_table(_ceo(t), _diversity(t), _board(t), roa)


@query("universities", SOURCES + UNIVERSITIES + """
SELECT name, round(uniscoreavg, 6) AS uniscoreavg FROM universities
""")
def universities(spark, root):
    return _rounded(gov.universities(sources(spark, root)["rankings"]), "uniscoreavg")


@query("ceo_background", SOURCES + CEO + "SELECT * FROM ceo_v0")
def ceo_background(spark, root):
    return _rounded(_ceo(sources(spark, root)), "uniscoreavg")


@query("board_structure", SOURCES + BOARD + f"SELECT * REPLACE ({COUNTS_SQL}) FROM board_v0")
def board_structure(spark, root):
    return _as_double(_rounded(_board(sources(spark, root)), "avg_meetings"), *COUNTS)


@query(
    "director_diversity",
    SOURCES + DIVERSITY + f"SELECT * REPLACE ({BOARD_FLAG_SQL}) FROM div_v0",
)
def director_diversity(spark, root):
    rounded = _rounded(_diversity(sources(spark, root)), "female_pct", "shannon")
    return _as_double(rounded, "diversity_board")


@query("roa_change", SOURCES + ROA + """
SELECT r.ticker, round(change, 8) AS change, roachange FROM roa r JOIN roa_v0 USING (ticker)
""")
def roa_change(spark, root):
    changes = gov.roa_change(sources(spark, root)["ratios"])
    labelled = changes.select("ticker", "roachange", F.round("roachange", 8).alias("change"))
    return gov.roa_change_class(labelled)


FULL = WIDE + f", full_rows AS (SELECT * REPLACE ({COUNTS_SQL}, {BOARD_FLAG_SQL}) FROM full_v0)"


def rounded(full):
    return _rounded(full, "uniscoreavg", "female_pct", "shannon", "avg_meetings")


def as_double(full):
    return _as_double(full, *COUNTS, "diversity_board")


@query("full_assembly", FULL + "SELECT * FROM full_rows")
def full_assembly(spark, root):
    return as_double(rounded(wide(spark, root)))


def _scaled_sql():
    parts = []
    for c in [*NUMERIC, *BINARY]:
        x = f"{c}::{'INTEGER::' if c in BINARY else ''}DOUBLE"
        parts.append(
            f"round(coalesce(({x} - avg({x}) OVER ()) / nullif(stddev_pop({x}) OVER (), 0), 0), 4)"
            f" AS {c}"
        )
    return ", ".join(parts)


@query("feature_frame", WIDE + f"""
, complete AS (SELECT * FROM full_v0 f WHERE NOT EXISTS (
    SELECT 1 WHERE f.uniscoreavg IS NULL OR f.female_pct IS NULL OR f.shannon IS NULL
      OR f.over75_pct IS NULL OR f.avg_meetings IS NULL OR f.roachange IS NULL))
SELECT ticker, CAST(dense_rank() OVER (ORDER BY roachange) - 1 AS INTEGER) AS label,
       {_scaled_sql()}
FROM complete
""")
def feature_frame(spark, root):
    frame = prepare_features(snapshot(full_assembly(spark, root))).frame
    x = vector_to_array("features")
    return frame.select(
        "ticker",
        F.col("label").cast("int").alias("label"),
        *[F.round(x[i], 4).alias(c) for i, c in enumerate([*NUMERIC, *BINARY])],
    )


@query("label_encode", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS label
FROM customer
""")
def label_encode(spark, root):
    (customer,) = read_tables(spark, root, "customer")
    indexed = features.fit_labels(customer, "c_mktsegment", "label").transform(customer)
    return indexed.select("c_custkey", F.col("label").cast("int").alias("label"))


@query("label_decode", "SELECT o_orderkey, o_orderpriority AS label FROM orders")
def label_decode(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    labels = features.fit_labels(orders, "o_orderpriority", "prediction")
    indexed = labels.transform(orders).select("o_orderkey", "prediction")
    decoded = features.labels_back(labels, "prediction", "label").transform(indexed)
    return decoded.drop("prediction")


@query("argmax_label", """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS label
FROM embeddings
""")
def argmax_label(spark, root):
    (embeddings,) = read_tables(spark, root, "embeddings")
    return embeddings.select("vec_id", features.argmax(F.col("embedding")).alias("label"))


@query("onehot_counts", """
SELECT CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS slot, count(*) AS n
FROM orders GROUP BY o_orderpriority
""")
def onehot_counts(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    encoded = features.one_hot(orders, "o_orderpriority", "vector")
    slot = features.argmax(vector_to_array("vector"))
    return encoded.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))


@query("indicator_slots", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS slot FROM orders
""")
def indicator_slots(spark, root):
    """One slot per customer, without an index on the driver."""
    (orders,) = read_tables(spark, root, "orders")
    slots = features.indicator_slots(orders.select("o_orderkey", "o_custkey"), "o_custkey", "slot")
    return slots.select("o_orderkey", "slot")


@query("standardise", """
SELECT o_orderkey,
       round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6)
         AS o_totalprice,
       0.0e0 AS fixed
FROM orders
""")
def standardise(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    rows = orders.select("o_orderkey", "o_totalprice", F.lit(7).alias("fixed"))
    return _rounded(features.standardise(rows, ["o_totalprice", "fixed"]), "o_totalprice")


@query("class_weights", """
SELECT c_custkey, round(sum(1) OVER () / (5.0e0 * count(*) OVER (PARTITION BY c_mktsegment)), 6)
         AS balanced,
       CASE c_mktsegment WHEN 'BUILDING' THEN 2.0e0 WHEN 'FURNITURE' THEN 3.0e0 ELSE 1.0e0 END
         AS listed
FROM customer
""")
def class_weights(spark, root):
    (customer,) = read_tables(spark, root, "customer")
    listed = {"BUILDING": 2.0, "FURNITURE": 3.0}
    balanced = features.balanced_weights(customer, "c_mktsegment", "balanced")
    both = features.explicit_weights(balanced, "c_mktsegment", listed, out="listed")
    return _rounded(both, "balanced").select("c_custkey", "balanced", "listed")


@query("hash_split", """
SELECT o_orderkey, CAST(coalesce(
  CAST('0x' || substr(md5(o_orderkey::VARCHAR || '#42'), 1, 8) AS BIGINT) % 100 < 20, FALSE) AS INTEGER)
  AS is_test
FROM (SELECT CASE WHEN o_orderkey % 31 > 0 THEN o_orderkey END AS o_orderkey FROM orders)
""")
def hash_split(spark, root):
    """Rows without a key train."""
    (orders,) = read_tables(spark, root, "orders")
    keys = orders.select(F.when(F.col("o_orderkey") % 31 > 0, F.col("o_orderkey")).alias("o_orderkey"))
    train, test = features.hash_split(keys, "o_orderkey", seed=42)
    return train.withColumn("is_test", F.lit(0)).unionByName(test.withColumn("is_test", F.lit(1)))
