"""Projection, filters, expressions, joins, aggregates, sorting and set operations (rows C, D1-D9, D15, E1-E9, G, H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lamina.functions.registry import register_functions
from lamina.operators.grid import salted_join
from lamina.plans.catalog import query, sql_query
from lamina.plans.fixtures import table, views

# ---------------------------------------------------------------- C: projection, filters, expressions

sql_query("proj_star", "SELECT n.*, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey")

sql_query("proj_expr", """
    SELECT o.O_ORDERKEY AS okey, c.c_name AS customer, o.o_totalprice * 2 AS double_price
    FROM orders o JOIN customer c ON o.o_custkey = c.C_CUSTKEY""")


@query("proj_const", """
    SELECT n_nationkey, 17 AS i, 'left' || '-right' AS joined, CAST(2.25 AS DOUBLE) AS f, CAST(NULL AS VARCHAR) AS nothing FROM nation""")
def proj_const(spark, sf):
    views(spark, sf)
    # constant selects without FROM, used as values of a projection
    return spark.sql("""
        SELECT n_nationkey, (SELECT 17) AS i, (SELECT 'left' || '-right') AS joined, (SELECT 2.25D) AS f, (SELECT CAST(NULL AS STRING)) AS nothing
        FROM nation""")


sql_query("filter_logic", """
    SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE NOT (l.quality = 1 AND l.toxic = 0) OR (l.quality IS NULL AND d.lang = 'en')""")

sql_query("filter_compare", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_quantity >= 10 AND l_quantity <= 40 AND l_discount < 0.05 AND l_tax > 0.01 AND l_linenumber <> 3 AND l_returnflag != 'R'
      AND l_linestatus = 'O'""")

sql_query("filter_is", """
    SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE (l.quality IS NULL AND l.toxic IS NOT DISTINCT FROM NULL) OR (l.quality IS NOT NULL AND l.quality IS DISTINCT FROM l.toxic)""")

sql_query("filter_like", """
    SELECT p_partkey, p_name, p_type FROM part
    WHERE (p_name ILIKE '%A%' AND p_type NOT LIKE '%z%') OR p_type LIKE 'S%' OR p_brand NOT ILIKE 'brand#1%'""")

sql_query("filter_regexp_glob", """
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_brand RLIKE '^Brand#[1-3]' OR p_name RLIKE '^p.*[0-9]7$' OR p_type RLIKE '^(?s:S.*)$'""", """
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE regexp_matches(p_brand, '^Brand#[1-3]') OR regexp_matches(p_name, '^p.*[0-9]7$') OR p_type GLOB 'S*'""")

sql_query("filter_in_list", """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('1-URGENT', '5-LOW')""")

sql_query("expr_arith", """
    SELECT p_partkey, 7 div 2 AS int_div, p_size div 7 AS size_div, p_size % 7 AS size_mod, -p_size AS neg, +p_size AS pos,
           p_size * 2 - 1 AS int_expr, round(p_retailprice / p_size, 4) AS real_div, round(p_retailprice + p_size, 4) AS mixed FROM part""", """
    SELECT p_partkey, CAST(7 // 2 AS BIGINT) AS int_div, CAST(p_size // 7 AS BIGINT) AS size_div, p_size % 7 AS size_mod, -p_size AS neg,
           +p_size AS pos, p_size * 2 - 1 AS int_expr, round(p_retailprice / p_size, 4) AS real_div, round(p_retailprice + p_size, 4) AS mixed
    FROM part""")

sql_query("expr_concat", """
    SELECT d.doc_id, d.lang || '/' || d.source AS tag, d.lang || CAST(l.quality AS VARCHAR(10)) AS with_null
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")

sql_query("expr_case", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band,
           CASE WHEN o_orderstatus = 'F' THEN 1 END AS done, CASE WHEN o_custkey % 2 <> 0 THEN 'odd' ELSE 'even' END AS parity FROM orders""")

sql_query("expr_cast", """
    SELECT c_custkey, CAST(c_custkey AS DOUBLE) AS as_real, CAST(c_nationkey AS STRING) AS as_text,
           CAST(try_cast(substring(c_name, 10) AS INT) AS INT) AS name_number, try_cast(c_mktsegment AS INT) AS bad_int,
           CAST(trunc_acct AS BIGINT) AS acct FROM (SELECT *, floor(c_acctbal) AS trunc_acct FROM customer)""", """
    SELECT c_custkey, CAST(c_custkey AS DOUBLE) AS as_real, CAST(c_nationkey AS VARCHAR) AS as_text,
           try_cast(substring(c_name, 10) AS INTEGER) AS name_number, try_cast(c_mktsegment AS INTEGER) AS bad_int,
           CAST(floor(c_acctbal) AS BIGINT) AS acct FROM customer""")


@query("geo_cast_scalar", """
    SELECT s_suppkey, CAST(trunc(s_acctbal) AS BIGINT) AS as_integer, CAST(s_suppkey AS DOUBLE) AS as_double,
           CAST(s_nationkey AS VARCHAR) AS as_text, CAST(NULL AS BIGINT) AS not_a_number FROM supplier""")
def geo_cast_scalar(spark, sf):
    from lamina.functions.registry import register_functions

    register_functions(spark, ["CastToInteger", "CastToDouble", "CastToText"])
    views(spark, sf)
    return spark.sql("""
        SELECT s_suppkey, CastToInteger(CAST(s_acctbal AS STRING)) AS as_integer, CastToDouble(CAST(s_suppkey AS STRING)) AS as_double,
               CastToText(CAST(s_nationkey AS STRING)) AS as_text, CastToInteger('n' || s_name) AS not_a_number FROM supplier""")


# ---------------------------------------------------------------- D: joins and subqueries

# both sides of the product are the two fixed dimension tables (25 and 5 rows)
sql_query("join_cross", """
    SELECT n.n_name, r.r_name, n.n_regionkey = r.r_regionkey AS own FROM nation n CROSS JOIN region r
    UNION ALL SELECT n.n_name, r.r_name, NULL FROM nation n, region r WHERE n.n_nationkey < r.r_regionkey""")

sql_query("join_inner", """
    SELECT o.o_orderkey, c.c_name, l.l_linenumber, l.l_quantity FROM lineitem l
    JOIN orders o ON l.l_orderkey = o.o_orderkey INNER JOIN customer c ON o.o_custkey = c.c_custkey""")

sql_query("join_left", """
    SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey FROM orders o LEFT OUTER JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")


@query("join_using", """
    SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)""")
def join_using(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), on=["doc_id"]).select("doc_id", "lang", "quality")


sql_query("join_natural", """
    SELECT doc_id, lang, source, quality, toxic FROM documents NATURAL LEFT JOIN labels""")

@query("join_theta", """
    SELECT p.p_partkey, s.s_suppkey FROM part p JOIN supplier s ON abs(p.p_retailprice - s.s_acctbal) < 2""")
def join_theta(spark, sf):
    # a band condition becomes an equi-join on value steps, each part looking into the neighbouring steps
    # too; steps crowded with rows are split over tasks
    step = F.floor(F.col("v") / 2)
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("v")).select(
        "p_partkey", F.col("v").alias("price"), F.explode(F.array(step - 1, step, step + 1)).alias("step"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey", F.col("s_acctbal").alias("v")).select(
        "s_suppkey", F.col("v").alias("balance"), step.alias("step"))
    pairs = salted_join(parts, suppliers, ["step"], extra=F.abs(F.col("price") - F.col("balance")) < 2)
    return pairs.select("p_partkey", "s_suppkey")


sql_query("join_self_alias", """
    SELECT a.n_name AS a_name, b.n_name AS b_name, xa.n AS a_suppliers, xb.n AS b_suppliers FROM nation AS a
    JOIN nation AS b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey
    JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) AS xa ON xa.s_nationkey = a.n_nationkey
    JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) AS xb ON xb.s_nationkey = b.n_nationkey""")

sql_query("semi_in_exists", """
    SELECT 'in' AS kind, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    UNION ALL
    SELECT 'exists', o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 49)""")

sql_query("anti_not_in_exists", """
    SELECT 'not_in' AS kind, c_custkey AS id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL
    SELECT 'not_exists', o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")

sql_query("subq_scalar", """
    SELECT c.c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders,
           round(c.c_acctbal - (SELECT avg(c_acctbal) FROM customer), 4) AS over_mean FROM customer c""")

# ---------------------------------------------------------------- E1-E9: aggregates

sql_query("agg_count", """
    SELECT d.lang, count(*) AS n, count(l.quality) AS n_labelled FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")

sql_query("agg_count_distinct", """
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_partkey, l_suppkey) AS pairs FROM lineitem GROUP BY l_returnflag""", """
    SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT (l_partkey, l_suppkey)) AS pairs FROM lineitem GROUP BY l_returnflag""")


@query("agg_sum_total_avg", """
    SELECT d.source, CAST(sum(l.quality) AS BIGINT) AS sum_quality, coalesce(CAST(sum(l.quality) AS DOUBLE), 0.0) AS total_quality,
           coalesce(CAST(sum(CASE WHEN l.quality > 5 THEN 1.0 END) AS DOUBLE), 0.0) AS total_none, round(avg(d.n_chars), 4) AS avg_chars
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source""")
def agg_sum_total_avg(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left")

    def total(c):
        return F.coalesce(F.sum(c).cast("double"), F.lit(0.0))

    return docs.groupBy("source").agg(
        F.sum("quality").alias("sum_quality"), total(F.col("quality")).alias("total_quality"),
        total(F.when(F.col("quality") > 5, 1.0)).alias("total_none"), F.round(F.avg("n_chars"), 4).alias("avg_chars"))


sql_query("agg_min_max", """
    SELECT o_orderstatus, min(o_totalprice) AS lo, max(o_totalprice) AS hi, min(o_orderpriority) AS first_pr, max(o_orderpriority) AS last_pr
    FROM orders GROUP BY o_orderstatus""")


@query("agg_group_concat", """
    SELECT r_name, string_agg(n_name, ',' ORDER BY n_name) AS nations, string_agg(CAST(n_nationkey AS VARCHAR), '-' ORDER BY n_nationkey) AS keys
    FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def agg_group_concat(spark, sf):
    views(spark, sf)
    return spark.sql("""
        SELECT r_name, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS nations,
               array_join(transform(array_sort(collect_list(n_nationkey)), k -> CAST(k AS STRING)), '-') AS keys
        FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")


sql_query("agg_var_stddev", """
    SELECT p_brand, round(var_pop(p_size), 6) AS var_p, round(var_samp(p_size), 6) AS var_s, round(stddev_pop(p_size), 6) AS dev_p,
           round(stddev_samp(p_size), 6) AS dev_s FROM part GROUP BY p_brand""")

sql_query("group_having", """
    SELECT l_suppkey % 10 AS bucket, l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS amount FROM lineitem
    GROUP BY l_suppkey % 10, l_returnflag HAVING count(*) > 10 AND sum(l_quantity) > 100""")


@query("group_pick_row", """
    SELECT o_custkey, count(*) AS n, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS o_orderkey,
           arg_min(o_orderstatus, (o_totalprice, o_orderkey)) AS o_orderstatus, min(o_totalprice) AS o_totalprice
    FROM orders GROUP BY o_custkey""")
def group_pick_row(spark, sf):
    row = F.struct("o_orderkey", "o_orderstatus", "o_totalprice")
    picked = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.min_by(row, F.struct("o_totalprice", "o_orderkey")).alias("row"))
    return picked.select("o_custkey", "n", "row.*")


sql_query("select_distinct", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")

# ---------------------------------------------------------------- G: sorting and set operations

sql_query("sort", """
    SELECT d.doc_id, l.quality, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ORDER BY l.quality ASC, d.n_chars DESC, d.doc_id""", """
    SELECT d.doc_id, l.quality, d.n_chars FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    ORDER BY l.quality ASC NULLS FIRST, d.n_chars DESC, d.doc_id""")

# top-k report: the limit is the feature
sql_query("limit_offset", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 5""")

sql_query("set_union", """
    SELECT c_nationkey AS nationkey, c_custkey % 50 AS k FROM customer UNION SELECT s_nationkey, s_suppkey % 50 FROM supplier""")
sql_query("set_union_all", """
    SELECT c_nationkey AS nationkey, c_custkey % 50 AS k FROM customer UNION ALL SELECT s_nationkey, s_suppkey % 50 FROM supplier""")
sql_query("set_intersect", """
    SELECT c_nationkey AS nationkey, c_custkey % 50 AS k FROM customer INTERSECT SELECT s_nationkey, s_suppkey % 50 FROM supplier""")
sql_query("set_except", """
    SELECT c_nationkey AS nationkey, c_custkey % 50 AS k FROM customer EXCEPT SELECT s_nationkey, s_suppkey % 50 FROM supplier""")

# ---------------------------------------------------------------- H: scalar functions over a table

sql_query("fn_string", """
    SELECT p_partkey, CAST(length(p_name) AS BIGINT) AS len, lower(p_brand) AS lo, upper(p_name) AS up, p_name ILIKE 'P%' AS lk,
           trim('  ' || p_type || ' ') AS tr, ltrim('  ' || p_type) AS lt, rtrim(p_type || '  ') AS rt, replace(p_brand, '#', '-') AS rep,
           substring(p_name, 2, 4) AS sub, hex(p_type) AS hx, concat('''', replace(p_type, '''', ''''''), '''') AS quoted,
           p_type RLIKE '^S.*$' AS glb FROM part""", """
    SELECT p_partkey, length(p_name) AS len, lower(p_brand) AS lo, upper(p_name) AS up, p_name ILIKE 'P%' AS lk,
           trim('  ' || p_type || ' ') AS tr, ltrim('  ' || p_type) AS lt, rtrim(p_type || '  ') AS rt, replace(p_brand, '#', '-') AS rep,
           substring(p_name, 2, 4) AS sub, hex(p_type) AS hx, '''' || replace(p_type, '''', '''''') || '''' AS quoted, p_type GLOB 'S*' AS glb FROM part""")


# letters as digits, h and w (7) left out, equal neighbours once, vowels and others (0) left out, the first letter in front
@query("fn_soundex", """
    WITH c AS (SELECT p_partkey, upper(p_name) AS u, translate(regexp_replace(upper(p_name), '[^A-Z]', '0', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202') AS d FROM part),
    n AS (SELECT p_partkey, u, CASE WHEN left(d, 1) = '7' THEN '0' ELSE left(d, 1) END || replace(substr(d, 2), '7', '') AS d FROM c),
    s AS (SELECT p_partkey, u, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
            d, '1+', '1', 'g'), '2+', '2', 'g'), '3+', '3', 'g'), '4+', '4', 'g'), '5+', '5', 'g'), '6+', '6', 'g') AS d FROM n)
    SELECT p_partkey, left(u, 1) || left(replace(substr(d, 2), '0', '') || '000', 3) AS sound FROM s""")
def fn_soundex(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.soundex("p_name").alias("sound"))


sql_query("fn_null", """
    SELECT d.doc_id, coalesce(l.quality, l.toxic, -1) AS co, nvl(l.quality, 0) AS nv, nullif(d.lang, 'en') AS nf,
           CASE typeof(l.quality) WHEN 'int' THEN 'integer' WHEN 'bigint' THEN 'integer' ELSE typeof(l.quality) END AS ty,
           CASE typeof(d.lang) WHEN 'string' THEN 'text' ELSE typeof(d.lang) END AS ty2
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""", """
    SELECT d.doc_id, coalesce(l.quality, l.toxic, -1) AS co, ifnull(l.quality, 0) AS nv, nullif(d.lang, 'en') AS nf,
           CASE typeof(l.quality) WHEN 'INTEGER' THEN 'integer' WHEN 'BIGINT' THEN 'integer' WHEN '"NULL"' THEN 'integer' ELSE typeof(l.quality) END AS ty,
           CASE typeof(d.lang) WHEN 'VARCHAR' THEN 'text' ELSE typeof(d.lang) END AS ty2
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")

_MATH = """
    SELECT c_custkey, round(abs(c_acctbal), 2) AS ab, round(acos(u), 6) AS ac, round(asin(u), 6) AS asn, round(atan(c_acctbal), 6) AS att,
           round(cos(c_acctbal), 6) AS cs, round(cot(1 + u), 6) AS ct, round(degrees(u), 6) AS dg, round(exp(u), 6) AS ex,
           CAST(floor(c_acctbal) AS BIGINT) AS fl, round(ln(2 + u), 6) AS lg, round(log2(2 + u), 6) AS l2, round(log10(2 + u), 6) AS l10,
           round(pi(), 6) AS p, round(radians(c_acctbal), 6) AS rd, round(c_acctbal, 1) AS ro, CAST(sign(c_acctbal) AS INT) AS sg,
           round(sin(c_acctbal), 6) AS sn, round(sqrt(abs(c_acctbal)), 6) AS sq, round(tan(u), 6) AS tn,
           least(c_acctbal, CAST(c_custkey AS DOUBLE)) AS mn, greatest(c_acctbal, CAST(c_custkey AS DOUBLE)) AS mx
    FROM (SELECT *, (c_custkey % 100) / 100.0D AS u FROM customer) AS c"""
sql_query("fn_math", _MATH, _MATH.replace("100.0D", "CAST(100 AS DOUBLE)"))

sql_query("fn_date", """
    SELECT o_orderkey, CAST(to_date(o_orderdate) AS STRING) AS d, date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS dt,
           round(unix_date(to_date(o_orderdate)) + (hour(o_orderdate) * 3600 + minute(o_orderdate) * 60
             + CAST(extract(SECOND FROM o_orderdate) AS DOUBLE)) / 86400D + 2440587.5D, 6) AS jd, date_format(o_orderdate, 'yyyy/MM') AS ym FROM orders""", """
    SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS dt,
           round(epoch_us(o_orderdate) / CAST(86400000000 AS DOUBLE) + CAST(2440587.5 AS DOUBLE), 6) AS jd, strftime(o_orderdate, '%Y/%m') AS ym FROM orders""")


@query("fn_random_sample", """
    SELECT o_orderkey, r FROM (SELECT o_orderkey, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR) || ' 7'), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS r FROM orders) AS t WHERE r < 0.1""")
def fn_random_sample(spark, sf):
    # the sampling operator itself: about a tenth of the orders by a random number drawn from each
    # order's key and a seed, so that a rerun or a lost executor draws the same rows
    drawn = F.conv(F.substring(F.md5(F.concat(F.col("o_orderkey").cast("string"), F.lit(" 7")).cast("binary")), 1, 8), 16, 10).cast("double")
    return table(spark, sf, "orders").select("o_orderkey", (drawn / 4294967296.0).alias("r")).filter("r < 0.1")


# the letters of the time formats, weekday, day and week of the year among them
@query("fn_strftime", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS full_time, strftime(o_orderdate, '%w') || '|' || strftime(o_orderdate, '%j') || '|' || strftime(o_orderdate, '%W') AS days,
           CAST(CAST(epoch(o_orderdate) AS BIGINT) AS VARCHAR) AS seconds, '100%: ' || strftime(o_orderdate, '%S') || '.000' AS other FROM orders""")
def fn_strftime(spark, sf):
    register_functions(spark, ["strftime"])
    orders = table(spark, sf, "orders")
    return orders.selectExpr("o_orderkey", "strftime('%Y-%m-%d %H:%M:%S', o_orderdate) AS full_time", "strftime('%w|%j|%W', o_orderdate) AS days", "strftime('%s', o_orderdate) AS seconds", "strftime('100%%: %f', o_orderdate) AS other")
