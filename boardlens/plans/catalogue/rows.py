"""Sources, projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from boardlens.functions.dates import date_or, strict_date, tenure_years
from boardlens.functions.text import (
    MBA,
    PHD,
    POSTGRADUATE,
    UNDERGRAD,
    contains_ci,
    degree_flags,
    differs,
    score_midpoint,
)
from boardlens.operators.rows import overwrite_where, union_later_wins
from boardlens.plans.catalogue.registry import query
from boardlens.plans.governance import clean_scores
from boardlens.plans.governance import companies as gov_companies
from boardlens.sources.csvio import RANKING_YEARS, read_csv, read_rankings, write_csv
from boardlens.sources.html import elements, first_table, page_tables, visible_text
from boardlens.sources.runlists import (
    explode_runs,
    format_run_lists,
    list_text,
    parse_lines,
    read_run_lists,
    write_run_lists,
)
from boardlens.sources.tables import pull, read_tables, scratch, snapshot


@query("pull_filtered", """
SELECT c_custkey AS ticker, c_mktsegment AS spindex FROM customer WHERE c_nationkey = 7
""")
def pull_filtered(spark, root):
    (customer,) = read_tables(spark, root, "customer")
    pulled = pull(
        spark, "SELECT c_custkey, c_mktsegment FROM {t} WHERE c_nationkey = 7", t=customer
    )
    return pulled.withColumnsRenamed({"c_custkey": "ticker", "c_mktsegment": "spindex"})


@query("csv_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority
FROM orders
""")
def csv_roundtrip(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    day = orders.withColumn("o_orderdate", F.to_date("o_orderdate"))
    path = scratch(spark)
    write_csv(day, f"{path}/csv")
    back = snapshot(read_csv(spark, f"{path}/csv", day.schema), f"{path}/parquet")
    return back.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query("yearly_scores", """
WITH rankings AS (
  SELECT nullif(o_orderpriority, '1-URGENT') AS rank, o_orderstatus AS name,
         CASE o_orderkey % 3 WHEN 0 THEN '—' WHEN 1 THEN '-' ELSE o_totalprice::VARCHAR END
           AS scores_overall
  FROM orders
)
SELECT name, round(avg(scores_overall::DOUBLE), 4) AS uniscoreavg, count(*) AS n
FROM rankings
WHERE rank IS DISTINCT FROM '4-NOT SPECIFIED' AND scores_overall NOT IN ('—', '-')
GROUP BY name
""")
def yearly_scores(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    third = F.col("o_orderkey") % 3
    rankings = orders.select(
        F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("rank"),
        F.col("o_orderstatus").alias("name"),
        F.when(third == 0, "—")
        .when(third == 1, "-")
        .otherwise(F.col("o_totalprice").cast("string"))
        .alias("scores_overall"),
    )
    score = F.col("scores_overall")
    return (
        rankings.where(differs(F.col("rank"), "4-NOT SPECIFIED"))
        .where(differs(score, "—") & differs(score, "-"))
        .groupBy("name")
        .agg(F.round(F.avg(score_midpoint(score)), 4).alias("uniscoreavg"), F.count("*").alias("n"))
    )


@query("score_midpoint", """
WITH t AS (
  SELECT p_partkey,
         p_size || CASE p_partkey % 4 WHEN 0 THEN '-' || (p_size + 9)
                                      WHEN 1 THEN '—' || (p_size + 10)
                                      WHEN 2 THEN '–' || p_retailprice::VARCHAR
                                      ELSE '' END AS score
  FROM part
), s AS (SELECT p_partkey, string_split(regexp_replace(score, '[—–]', '-'), '-') AS parts FROM t)
SELECT p_partkey,
       round(CASE WHEN len(parts) > 1 THEN (parts[1]::DOUBLE + parts[2]::DOUBLE) / 2
                  ELSE parts[1]::DOUBLE END, 6) AS midpoint
FROM s
""")
def score_midpoint_rows(spark, root):
    (part,) = read_tables(spark, root, "part")
    kind, size = F.col("p_partkey") % 4, F.col("p_size")
    tail = (
        F.when(kind == 0, F.concat(F.lit("-"), size + 9))
        .when(kind == 1, F.concat(F.lit("—"), size + 10))
        .when(kind == 2, F.concat(F.lit("–"), F.col("p_retailprice").cast("string")))
        .otherwise("")
    )
    score = F.concat(size.cast("string"), tail)
    return part.select("p_partkey", F.round(score_midpoint(score), 6).alias("midpoint"))


@query("role_filter", """
WITH t AS (SELECT p_partkey, nullif(p_name, 'hot widget') AS rolename, p_brand FROM part)
SELECT p_partkey, rolename, CAST(contains(lower(rolename), 'small') AS INTEGER) AS founder
FROM t
WHERE rolename ILIKE '%WIDGET%' AND NOT rolename ILIKE '%red%' AND NOT rolename ILIKE '%blue%'
  AND p_brand IS NOT NULL
""")
def role_filter(spark, root):
    (part,) = read_tables(spark, root, "part")
    role = F.col("rolename")
    return (
        part.withColumn("rolename", F.nullif("p_name", F.lit("hot widget")))
        .where(
            contains_ci(role, "WIDGET")
            & ~contains_ci(role, "red")
            & ~contains_ci(role, "blue")
            & F.col("p_brand").isNotNull()
        )
        .select(
            "p_partkey",
            "rolename",
            contains_ci(role, "small", null_as=False).cast("int").alias("founder"),
        )
    )


LEVELS = {"bachelors": UNDERGRAD, "masters": POSTGRADUATE, "mba": MBA, "phd": PHD}
KEYWORDS = [w for words in LEVELS.values() for w in words]


def _sql_list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _sql_any(words: list[str]) -> str:
    return f"len(list_filter({_sql_list(words)}, lambda w: contains(q, lower(w)))) > 0"


@query("degree_flags", f"""
WITH t AS (
  SELECT p_partkey, lower(coalesce(CASE WHEN p_type = 'PROMO' THEN NULL ELSE
           CASE p_partkey % 3 WHEN 0 THEN upper(w) WHEN 1 THEN 'Honorary ' || w ELSE w END END, '')) AS q
  FROM (SELECT *, ({_sql_list(KEYWORDS)})[CAST(p_partkey % {len(KEYWORDS)} AS INTEGER) + 1] AS w FROM part)
)
SELECT p_partkey, CAST({_sql_any(UNDERGRAD)} AS INTEGER) AS bachelors,
       CAST({_sql_any(POSTGRADUATE)} AND NOT ({_sql_any(UNDERGRAD)}) AS INTEGER) AS masters,
       CAST({_sql_any(MBA)} AS INTEGER) AS mba, CAST({_sql_any(PHD)} AS INTEGER) AS phd
FROM t
""")
def degree_flags_rows(spark, root):
    """Every keyword of the four levels, as it is, in capitals and inside a longer text."""
    (part,) = read_tables(spark, root, "part")
    word = F.get(F.array(*map(F.lit, KEYWORDS)), (F.col("p_partkey") % len(KEYWORDS)).cast("int"))
    kind = F.col("p_partkey") % 3
    written = F.when(kind == 0, F.upper(word)).when(kind == 1, F.concat(F.lit("Honorary "), word)).otherwise(word)
    flags = degree_flags(F.when(F.col("p_type") != "PROMO", written))
    return part.select("p_partkey", *[f.cast("int").alias(n) for n, f in flags.items()])


@query("ranking_files", """
WITH r AS (
  SELECT CAST(2011 + p_partkey % 14 AS INTEGER) AS year,
         CASE WHEN p_brand = 'Brand#1' THEN 'Reporter' WHEN p_brand <> 'Brand#2' THEN p_brand END AS rank,
         CASE p_size % 3 WHEN 0 THEN '—' ELSE p_size::VARCHAR END AS score
  FROM part
)
SELECT year, count(*) AS n, round(avg(score::DOUBLE), 6) AS score
FROM r WHERE rank IS DISTINCT FROM 'Reporter' AND score <> '—' GROUP BY year
""")
def ranking_files(spark, root):
    """Fourteen yearly files, each with its columns in another order and columns of its own."""
    (part,) = read_tables(spark, root, "part")
    folder = scratch(spark)
    rows = part.select(
        (2011 + F.col("p_partkey") % 14).alias("of"),
        F.when(F.col("p_brand") == "Brand#1", "Reporter")
        .when(F.col("p_brand") != "Brand#2", F.col("p_brand"))
        .alias("rank"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 3 == 0, "—").otherwise(F.col("p_size").cast("string")).alias("scores_overall"),
        F.lit("UK").alias("location"),
    )
    names = ["rank", "name", "scores_overall", "location"]
    for i, year in enumerate(RANKING_YEARS):
        order = names[i % 4 :] + names[: i % 4]
        write_csv(rows.where(F.col("of") == year).select(*order), f"{folder}/{year}_rankings.csv")
    clean = clean_scores(read_rankings(spark, folder))
    return clean.groupBy("year").agg(F.count("*").alias("n"), F.round(F.avg("scores_overall"), 6).alias("score"))


@query("run_list_files", """
SELECT 'm' || vec_id AS model, CAST(i AS INTEGER) AS run,
       CASE WHEN vec_id % 3 = 0 THEN -1.0e0 ELSE 1.0e0 END * floor(embedding[i + 1]::DOUBLE * 1000) AS accuracy
FROM embeddings, range(4) t(i)
""")
def run_list_files(spark, root):
    """Two text files of runs; a model in both takes the later file's."""
    lists = _vector_lists(spark, root).select(F.concat(F.lit("m"), "model").alias("model"), F.slice("values", 1, 4).alias("values"))
    third = F.substr("model", F.lit(2)).cast("long") % 3 == 0
    later = lists.where(third).withColumn("values", F.transform("values", lambda x: -x))
    folder = scratch(spark)
    write_run_lists(explode_runs(lists), f"{folder}/first")
    write_run_lists(explode_runs(later), f"{folder}/later")
    return read_run_lists(spark, [f"{folder}/first", f"{folder}/later"])


@query("html_table", """
SELECT c_custkey // 50 AS page, CAST(row_number() OVER (PARTITION BY c_custkey // 50 ORDER BY c_custkey) - 1 AS INTEGER) AS row,
       c_name || ' & <co>' AS company, c_mktsegment AS sector
FROM customer
""")
def html_table(spark, root):
    """Customers rendered as pages of fifty table rows, and read back from the first table."""
    (customer,) = read_tables(spark, root, "customer")
    cells = F.concat(
        F.lit("<tr><td>"), "c_mktsegment", F.lit("</td>\n<td class='x'><a href='#'>"), "c_name", F.lit(" &amp;\n &lt;co&gt;</a></td></tr>")
    )
    pages = (
        customer.groupBy(F.floor(F.col("c_custkey") / 50).alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("c_custkey", cells.alias("tr")))).alias("rows"))
        .select(
            "page",
            F.concat(
                F.lit("<p>no</p><!-- <table><tr><td>old</td></tr></table> --><table id=1><tr><th>Sector</th><th>Company </th></tr>"),
                F.array_join(F.col("rows.tr"), ""),
                F.lit("</table><table><tr><td>2</td></tr></table>"),
            ).alias("html"),
        )
    )
    return first_table(pages, "html", {"Company": "company", "Sector": "sector"}, ["page"])


@query("nested_tables", """
WITH n AS (
  SELECT s_nationkey, s_suppkey, s_name, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS i
  FROM supplier
), outer_rows AS (
  SELECT s_nationkey AS page, 0 AS "table", CAST(i AS INTEGER) AS row,
         'nation ' || s_nationkey || ' <é>|' || s_name || '|' || s_name || '|' AS cells
  FROM n
), inner_rows AS (
  SELECT s_nationkey, CAST(i AS INTEGER), 0, s_suppkey::VARCHAR FROM n
  UNION ALL SELECT s_nationkey, CAST(i AS INTEGER), 1, CASE WHEN s_acctbal < 0 THEN 'debt' ELSE 'credit' END FROM n
)
SELECT * FROM outer_rows UNION ALL SELECT * FROM inner_rows
UNION ALL SELECT DISTINCT s_nationkey, 0, 0, 'Nation|Supplier|Supplier|More' FROM n
""")
def nested_tables(spark, root):
    """Suppliers rendered as a table per nation: its name spans all rows, each name two columns, and the
    last cell of a row holds a table of its own; end tags of cells and rows are left out."""
    (supplier,) = read_tables(spark, root, "supplier")
    inner = F.concat(
        F.lit("<TABLE><tr><td>"), F.col("s_suppkey").cast("string"), F.lit("<tr><td>"),
        F.when(F.col("s_acctbal") < 0, "debt").otherwise("credit"), F.lit("</table>"),
    )
    cells = F.concat(F.lit("<td colspan=2>"), "s_name", F.lit("<!-- <td> --><td><script>'<td>'</script>"), inner)
    pages = (
        supplier.groupBy(F.col("s_nationkey").alias("page"))
        .agg(F.array_sort(F.collect_list(F.struct("s_suppkey", cells.alias("td")))).alias("rows"))
        .select(
            "page",
            F.concat(
                F.lit("<table><thead><tr><th>Nation<th colspan='2'>Supplier</th><th>More<tbody><tr><td rowspan=0>nation "),
                F.col("page").cast("string"),
                F.lit("\n &#60;&#xE9;&gt;</td>"),
                F.array_join(F.col("rows.td"), "<tr>"),
                F.lit("</table>"),
            ).alias("html"),
        )
    )
    return page_tables(pages, "html", ["page"]).select("page", "table", "row", F.array_join("cells", "|").alias("cells"))


@query("companies", """
SELECT DISTINCT o_custkey::VARCHAR AS ticker, o_orderpriority AS spindex FROM orders WHERE year(o_orderdate) = 1998
""")
def companies(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    governance = orders.select(
        F.col("o_custkey").cast("string").alias("ticker"), F.col("o_orderpriority").alias("spindex"), F.year("o_orderdate").alias("year")
    ).distinct()
    return gov_companies(governance, 1998)


@query("clean_dates", """
WITH t AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS started,
         CASE o_orderkey % 10 WHEN 0 THEN 'N' WHEN 1 THEN NULL
              ELSE strftime(o_orderdate + INTERVAL 400 DAY, '%Y-%m-%d') END AS ended
  FROM orders
)
SELECT o_orderkey, started::DATE::VARCHAR AS startdate,
       coalesce(try_cast(ended AS DATE), DATE '2024-01-31')::VARCHAR AS enddate
FROM t
""")
def clean_dates(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    last = F.col("o_orderkey") % 10
    day = F.to_date("o_orderdate")
    texts = orders.select(
        "o_orderkey",
        day.cast("string").alias("started"),
        F.when(last == 0, "N")
        .when(last != 1, F.date_add(day, 400).cast("string"))
        .alias("ended"),
    )
    return texts.select(
        "o_orderkey",
        strict_date(F.col("started")).cast("string").alias("startdate"),
        date_or(F.col("ended"), "2024-01-31").cast("string").alias("enddate"),
    )


@query("tenure_years", """
SELECT o_custkey, CAST(year(max(o_orderdate)) - year(min(o_orderdate)) AS INTEGER) AS tenure
FROM orders GROUP BY o_custkey
""")
def tenure_years_rows(spark, root):
    (orders,) = read_tables(spark, root, "orders")
    years = tenure_years(F.min("o_orderdate"), F.max("o_orderdate"))
    return orders.groupBy("o_custkey").agg(years.alias("tenure"))


@query("flag_overwrite", """
SELECT s_suppkey AS supplier,
       CASE WHEN s_acctbal < 0 THEN 'Co-CEO' ELSE s_name END AS s_name,
       CASE WHEN s_acctbal < 0 THEN 12345 ELSE s_suppkey END AS s_suppkey,
       CAST(CASE WHEN s_acctbal < 0 THEN 2030 ELSE s_nationkey END AS INTEGER) AS s_nationkey
FROM supplier
""")
def flag_overwrite(spark, root):
    (supplier,) = read_tables(spark, root, "supplier")
    values = {"s_name": "Co-CEO", "s_suppkey": 12345, "s_nationkey": 2030}
    rows = supplier.withColumn("supplier", F.col("s_suppkey"))
    return overwrite_where(rows, F.col("s_acctbal") < 0, values).drop("s_acctbal")


@query("keyed_union", """
SELECT key, arg_max(name, source) AS name
FROM (SELECT c_custkey AS key, c_name AS name, 0 AS source FROM customer
      UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier
      UNION ALL SELECT p_partkey, p_name, 2 FROM part WHERE p_size > 40)
GROUP BY key
""")
def keyed_union(spark, root):
    customer, supplier, part = read_tables(spark, root, "customer", "supplier", "part")
    frames = [
        customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")),
        supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")),
        part.where("p_size > 40").select(
            F.col("p_partkey").alias("key"), F.col("p_name").alias("name")
        ),
    ]
    return union_later_wins(frames, "key")


LISTS = """
WITH lists AS (
  SELECT vec_id::VARCHAR AS model,
         [CAST(floor(x::DOUBLE * 1000) AS BIGINT) FOR x IN embedding] AS vals
  FROM embeddings
)
"""


def _vector_lists(spark, root):
    """(model, run, accuracy) with one run per vector component, in thousandths."""
    (embeddings,) = read_tables(spark, root, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    return embeddings.select(F.col("vec_id").cast("string").alias("model"), whole.alias("values"))


@query("parse_run_lists", LISTS + """
SELECT model, CAST(i - 1 AS INTEGER) AS run, vals[i]::DOUBLE AS accuracy
FROM (SELECT model, vals, unnest(generate_series(1, len(vals))) AS i FROM lists)
""")
def parse_run_lists(spark, root):
    lists = _vector_lists(spark, root)
    lines = lists.select(F.concat("model", F.lit(": "), list_text(F.col("values"))).alias("value"))
    return explode_runs(parse_lines(lines))


@query("format_run_lists", LISTS + """
SELECT model || ': [' || array_to_string(vals, ', ') || ']' AS value FROM lists
""")
def format_run_lists_rows(spark, root):
    return format_run_lists(explode_runs(_vector_lists(spark, root)))


@query("html_rows", r"""
WITH items AS (
  SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1) AS li FROM pages
), cells AS (SELECT page_id, li, unnest(generate_series(1, len(li))) AS i FROM items)
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos,
       regexp_extract(li[i], 'href="([^"]*)"', 1) AS href,
       trim(regexp_replace(replace(replace(replace(replace(replace(replace(
         regexp_replace(li[i], '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
         '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '\s+', ' ', 'g')) AS label
FROM cells
""")
def html_rows(spark, root):
    (pages,) = read_tables(spark, root, "pages")
    items = pages.select("page_id", F.posexplode(elements(F.col("html"), "li")).alias("pos", "li"))
    return items.select(
        "page_id",
        "pos",
        F.regexp_extract("li", 'href="([^"]*)"', 1).alias("href"),
        visible_text(F.col("li")).alias("label"),
    )
