"""SQL statements giving the results of ``__spark_entry__.queries()`` over the same tables."""

# Characters removed around a comment before it is compared, as one SQL text.
TRIMMED = " || ".join(f"chr({c})" for c in [*range(9, 14), 32, 160, 0x1680, *range(0x2000, 0x200B)])

# Everything but word characters, whitespace and ASCII punctuation.
SYMBOLS = r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x85\p{Z}\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"

# A blank, an emoji, e with a combining accent, a check mark, a numero sign, a half, a no-break space.
MARKS = (
    "(' ' || chr(128512) || ' e' || chr(769) || ' ' || chr(10004) || ' ' || chr(8470) || ' '"
    " || chr(189) || ' a' || chr(160) || 'b')"
)

NA_TOKENS = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', '<NA>',"
    " 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)

SPEND = """
SELECT {category} AS category_id, {name} AS category_name, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS spent_money
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
GROUP BY ALL
"""

SHIP_HOURS = """
SELECT CAST(substr(p_brand, 7) AS INTEGER) AS category_id, p_brand AS category,
       sum(epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 3.6e9 AS rental_hours
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
WHERE {condition}
GROUP BY ALL ORDER BY rental_hours DESC, category_id LIMIT 1
"""

BOM = r"""
bom AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         l_partkey AS produced_material,
         CASE WHEN p.p_size = 50 THEN 'FIN' ELSE 'PROD' END AS produced_release,
         CASE WHEN p.p_type <> 'PROMO' THEN CAST(length(p.p_type) AS INTEGER) END AS produced_type,
         CAST(l_quantity AS DECIMAL(18,6)) AS produced_quantity,
         c.p_partkey AS component_material,
         CASE WHEN c.p_size = 50 THEN 'FIN' ELSE 'PROD' END AS component_release,
         CASE WHEN c.p_type <> 'PROMO' THEN CAST(length(c.p_type) AS INTEGER) END AS component_type,
         CAST(l_quantity * l_linenumber AS DECIMAL(18,6)) AS component_quantity,
         l_linestatus AS plant_id
  FROM lineitem JOIN part p ON p.p_partkey = l_partkey JOIN part c ON c.p_partkey = l_partkey // (l_linenumber + 1)
),
edges AS (
  SELECT DISTINCT plant_id, produced_material AS src, component_material AS dst FROM bom
  WHERE component_material IN (SELECT produced_material FROM bom)
),
fins AS (SELECT DISTINCT produced_material AS fin_id FROM bom WHERE produced_release = 'FIN')
"""

REVIEWS = """
reviews AS (
  SELECT lpad(CAST(d.doc_id AS VARCHAR), 12, '0') AS "reviewId", source AS "userName", text AS content,
         CAST(quality * 4 + 1 AS INTEGER) AS score, CAST(n_chars % 7 AS INTEGER) AS "thumbsUpCount",
         '2024-01-' || lpad(CAST(n_chars % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' AS at
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
)
"""

CHANGES = """
changes AS (
  SELECT o_custkey AS c_custkey, o_orderpriority AS c_name, CAST(NULL AS INTEGER) AS c_nationkey,
         o_totalprice AS c_acctbal, o_orderstatus AS c_mktsegment, o_orderdate AS changed, o_orderkey AS change_id
  FROM orders
  UNION ALL
  SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER', TIMESTAMP '2000-01-01', s_suppkey FROM supplier
)
"""


def describe(source: str, keys: str, column: str) -> str:
    return f"""
    SELECT {keys}, '{column}' AS "column", count({column}) AS count, round(avg({column}), 6) AS mean,
           round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min,
           round(quantile_cont(CAST({column} AS DOUBLE), 0.25), 6) AS p25,
           round(quantile_cont(CAST({column} AS DOUBLE), 0.5), 6) AS p50,
           round(quantile_cont(CAST({column} AS DOUBLE), 0.75), 6) AS p75, CAST(max({column}) AS DOUBLE) AS max
    FROM {source} GROUP BY {keys}
    """


def described(source: str, keys: str, columns: list[str]) -> str:
    return " UNION ALL ".join(describe(source, keys, c) for c in columns)


def profiled(numbers: list[str], texts: list[str]) -> str:
    statistics = {
        "count": "count({c})", "mean": "avg({c})", "stddev": "stddev_samp({c})", "min": "min({c})", "max": "max({c})",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS summary, "
        + ", ".join(f"round(CAST({how.format(c=c)} AS DOUBLE), 6) AS {c}" for c in numbers)
        + ", "
        + ", ".join(
            f"CAST({'NULL' if name in ('mean', 'stddev') else how.format(c=c)} AS VARCHAR) AS {c}" for c in texts
        )
        + " FROM part"
        for name, how in statistics.items()
    )


LINE_VECTOR = "[l_linenumber, CAST(round(l_discount * 100) AS INTEGER), CAST(round(l_tax * 100) AS INTEGER)]"

SIZE_GROUP = (
    "CASE WHEN p_size > 0 AND p_size <= 15 THEN 'small' WHEN p_size > 15 AND p_size <= 35 THEN 'medium'"
    " WHEN p_size > 35 AND p_size <= 49 THEN 'large' END"
)

BIN_COUNTS = f"""
SELECT size_group, CAST(count(p_partkey) AS BIGINT) AS count, ord
FROM (VALUES ('small', 0), ('medium', 1), ('large', 2)) g(size_group, ord)
LEFT JOIN (SELECT p_partkey, {SIZE_GROUP} AS label FROM part) ON label = size_group
GROUP BY ALL
"""

SERIES = """
series AS (
  SELECT user_id, ts, event_id, event_type, CAST(floor(value) AS INTEGER) AS level FROM events
)
"""

# What a finished material made in a month; equal quantities of a month are one.
FIN_MONTHS = """
          SELECT plant_id, produced_material, year, month, list_sum(list(DISTINCT produced_quantity)) AS made
          FROM bom WHERE produced_release = 'FIN' GROUP BY ALL
        """

STATEMENTS = {
    "parts_per_type": """
        SELECT p_type AS category_id, p_type AS category_name, count(*) AS movie_count FROM part GROUP BY p_type
    """,
    "top10_suppliers_by_lines": """
        WITH best AS (
          SELECT l_suppkey, CAST(sum(n) AS BIGINT) AS rentals
          FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
          JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey) USING (l_partkey)
          GROUP BY l_suppkey ORDER BY rentals DESC, l_suppkey LIMIT 10
        )
        SELECT s_suppkey AS actor_id, s_name AS first_name, 'of nation ' || s_nationkey AS last_name, rentals
        FROM best JOIN supplier ON s_suppkey = l_suppkey
    """,
    "spend_per_brand": SPEND.format(category="CAST(substr(p_brand, 7) AS INTEGER)", name="p_brand"),
    "top_type_by_revenue": f"""
        WITH spend AS ({SPEND.format(category="p_type", name="p_type")})
        SELECT * FROM spend WHERE spent_money = (SELECT max(spent_money) FROM spend)
    """,
    "orders_without_lines": """
        SELECT CAST(o_orderkey AS VARCHAR) AS title FROM orders
        WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
    """,
    "top3_counts_suppliers_promo": """
        WITH seen AS (
          SELECT l_suppkey, count(DISTINCT l_partkey) AS appearances
          FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_type = 'PROMO' GROUP BY l_suppkey
        )
        SELECT s_suppkey AS actor_id, s_name AS first_name, 'of nation ' || s_nationkey AS last_name, appearances
        FROM (SELECT *, dense_rank() OVER (ORDER BY appearances DESC) AS place FROM seen)
        JOIN supplier ON s_suppkey = l_suppkey WHERE place <= 3
    """,
    "customers_by_nation_balance": """
        SELECT n_nationkey AS city_id, n_name AS city,
               count(*) FILTER (c_acctbal >= 0) AS active_customers, count(*) FILTER (c_acctbal < 0) AS inactive_customers
        FROM customer, nation WHERE n_nationkey = c_nationkey GROUP BY ALL
    """,
    "top_brand_by_ship_hours": f"""
        SELECT 'part starts with s' AS filter, category, round(rental_hours, 3) AS rental_hours
        FROM ({SHIP_HOURS.format(condition="p_name ILIKE 's%'")})
        UNION ALL
        SELECT 'nation contains 1', category, round(rental_hours, 3)
        FROM ({SHIP_HOURS.format(condition="n_name LIKE '%1%'")})
    """,
    "lines_per_order": """
        SELECT o_orderkey AS id, o_orderpriority AS name, count(l_linenumber) AS student_count
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
    """,
    "lowest_avg_order_age": """
        SELECT c_custkey AS id, c_name AS name,
               CAST(CAST(avg(date_part('year', age(TIMESTAMP '2002-01-01', o_orderdate))) AS DECIMAL(10,2)) AS DOUBLE) AS avg_age_years
        FROM customer JOIN orders ON o_custkey = c_custkey
        GROUP BY ALL ORDER BY avg_age_years ASC NULLS LAST, id LIMIT 5
    """,
    "largest_order_span": """
        SELECT c_custkey AS id, c_name AS name,
               CAST(date_part('year', age(max(o_orderdate), min(o_orderdate))) AS INTEGER) AS age_diff_years
        FROM customer JOIN orders ON o_custkey = c_custkey
        GROUP BY ALL ORDER BY age_diff_years DESC NULLS FIRST, id LIMIT 5
    """,
    "orders_mixed_flags": """
        SELECT o_orderkey AS id, o_orderpriority AS name FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY ALL HAVING count(DISTINCT l_returnflag) > 1
    """,
    "fill_event_types": """
        SELECT event_id, coalesce(nullif(event_type, 'error'), '-') AS event_type,
               CASE WHEN event_type <> 'click' THEN value END AS value
        FROM events
    """,
    "sort_by_time": """
        SELECT event_id, CASE event_type
            WHEN 'error' THEN '-'
            WHEN 'click' THEN strftime(ts, '%Y-%m-%d') || ' 00:00:00'
            ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at
        FROM events
    """,
    "strip_document_symbols": f"""
        SELECT doc_id, regexp_replace(text || {MARKS}, '{SYMBOLS}', '', 'g') AS text FROM documents
    """,
    "clean_documents": f"""
        WITH {REVIEWS}, marked AS (
          SELECT * REPLACE (
            CASE WHEN score = 5 THEN content || {MARKS} WHEN "thumbsUpCount" = 3 THEN 'NA' || chr(128512)
                 WHEN "thumbsUpCount" = 4 THEN NULL ELSE content END AS content,
            CASE WHEN "thumbsUpCount" <> 5 THEN "at" ELSE '-' END AS "at")
          FROM reviews
        ), stripped AS (
          SELECT * REPLACE (regexp_replace(coalesce(content, '-'), '{SYMBOLS}', '', 'g') AS content) FROM marked
        )
        SELECT * REPLACE (CASE WHEN content NOT IN {NA_TOKENS} THEN content END AS content) FROM stripped
    """,
    "top_documents_text": f"""
        WITH {REVIEWS}, keyed AS (
          SELECT *, lower(trim(content, {TRIMMED})) AS key FROM reviews WHERE content NOT IN ('', '-')
        )
        SELECT count(*) AS count, CAST(coalesce(sum("thumbsUpCount"), 0) AS BIGINT) AS "totalThumbsUp",
               arg_min(content, "at" || "reviewId") AS comment, round_even(avg(score), 2) AS "avgScore"
        FROM keyed GROUP BY key ORDER BY count DESC, key LIMIT 5
    """,
    "short_text": """
        SELECT conv_id || '-' || turn AS "reviewId", role AS "userName", text AS content, turn AS score, '-' AS at
        FROM conversations WHERE length(text) < 40
    """,
    "avg_value_per_day": """
        SELECT count(*) AS reviews, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
               round_even(avg(CASE WHEN event_type <> 'view' THEN value END), 2) AS "avgScore"
        FROM events WHERE event_type <> 'error' GROUP BY 2
    """,
    "produced_materials": f"WITH {BOM} SELECT DISTINCT produced_material AS material_id FROM bom",
    "fin_materials": f"WITH {BOM} SELECT fin_id FROM fins",
    "produced_edges": f"WITH {BOM} SELECT DISTINCT src, dst FROM edges",
    "reachable_materials": f"""
        WITH RECURSIVE {BOM}, walk AS (
          SELECT DISTINCT plant_id, src AS root, dst AS node, 1 AS depth FROM edges WHERE src IN (SELECT fin_id FROM fins)
          UNION
          SELECT w.plant_id, w.root, e.dst, w.depth + 1
          FROM walk w JOIN edges e ON e.plant_id = w.plant_id AND e.src = w.node AND e.dst <> w.node
        )
        SELECT plant_id, root, node, min(depth) AS depth FROM walk GROUP BY ALL
    """,
    "fin_quantity": f"""
        WITH {BOM}, monthly AS ({FIN_MONTHS})
        SELECT plant_id, produced_material AS fin_id, year, CAST(sum(made) AS DOUBLE) AS fin_production_quantity
        FROM monthly GROUP BY plant_id, produced_material, year
    """,
    "fin_attr": f"""
        WITH {BOM}
        SELECT DISTINCT plant_id, produced_material AS fin_id, produced_release AS fin_material_release_type,
               produced_type AS fin_material_production_type
        FROM bom WHERE produced_release = 'FIN'
    """,
    "fin_attributes": f"""
        WITH {BOM}
        SELECT DISTINCT plant_id, year, month, produced_material AS fin_material_id,
               produced_release AS fin_material_release_type, produced_type AS fin_material_production_type,
               CAST(produced_quantity AS DOUBLE) AS fin_production_quantity
        FROM bom WHERE produced_material IN (SELECT fin_id FROM fins)
    """,
    "bom_explosion_annual": f"""
        WITH RECURSIVE {BOM}, below AS (
          SELECT plant_id, src AS top, dst AS part FROM edges WHERE src IN (FROM fins)
          UNION
          SELECT below.plant_id, top, dst FROM below, edges WHERE edges.plant_id = below.plant_id AND src = part
        ), consumed AS (
          SELECT plant_id, year, produced_material AS part, produced_release, produced_type, component_material,
                 component_release, component_type, sum(produced_quantity) AS made, sum(component_quantity) AS used
          FROM bom GROUP BY ALL
        ), monthly AS ({FIN_MONTHS}), yearly AS (
          SELECT plant_id, produced_material AS top, year, sum(made) AS ready FROM monthly GROUP BY ALL
        ), kinds AS (
          SELECT plant_id, top, unnest(found) AS kind FROM (
            SELECT plant_id, produced_material AS top, array_agg(DISTINCT produced_type) AS found
            FROM bom WHERE produced_release = 'FIN' GROUP BY plant_id, produced_material
          )
        )
        SELECT plant_id AS plant, top AS fin_material_id, 'FIN' AS fin_material_release_type,
               kind AS fin_material_production_type, CAST(ready AS DOUBLE) AS fin_production_quantity,
               part AS prod_material_id, produced_release AS prod_material_release_type,
               produced_type AS prod_material_production_type, CAST(made AS DOUBLE) AS prod_material_production_quantity,
               component_material AS component_id, component_release AS component_material_release_type,
               component_type AS component_material_production_type,
               CAST(used AS DOUBLE) AS component_consumption_quantity, year
        FROM consumed JOIN below USING (plant_id, part) JOIN yearly USING (plant_id, top, year)
        JOIN kinds USING (plant_id, top)
    """,
    "bom_explosion_monthly": f"""
        WITH RECURSIVE {BOM}, links AS (SELECT DISTINCT src, dst FROM edges), walk AS (
          SELECT src AS fin_id, dst AS material FROM links WHERE src IN (SELECT fin_id FROM fins)
          UNION
          SELECT w.fin_id, e.dst FROM walk w JOIN links e ON e.src = w.material
        ), finished AS (
          SELECT DISTINCT plant_id, year, month, produced_material AS fin_id, produced_release AS fin_release,
                 produced_type AS fin_type, produced_quantity AS fin_quantity
          FROM bom WHERE produced_material IN (SELECT fin_id FROM fins)
        )
        SELECT b.plant_id AS plant, w.fin_id AS fin_material_id, fin_release AS fin_material_release_type,
               fin_type AS fin_material_production_type, CAST(sum(fin_quantity) AS DOUBLE) AS fin_production_quantity,
               b.produced_material AS prod_material_id, produced_release AS prod_material_release_type,
               produced_type AS prod_material_production_type,
               CAST(sum(produced_quantity) AS DOUBLE) AS prod_material_production_quantity,
               component_material AS component_id, component_release AS component_material_release_type,
               component_type AS component_material_production_type,
               CAST(sum(component_quantity) AS DOUBLE) AS component_consumption_quantity, b.year
        FROM walk w JOIN bom b ON b.produced_material = w.material
        JOIN finished f ON f.fin_id = w.fin_id AND f.plant_id = b.plant_id AND f.year = b.year AND f.month = b.month
        GROUP BY b.plant_id, b.year, w.fin_id, fin_release, fin_type, b.produced_material, produced_release,
                 produced_type, component_material, component_release, component_type
    """,
    "flag_counts": "SELECT l_returnflag, count(*) AS count FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY 1",
    "mean_qty_returned": "SELECT round(avg(l_quantity), 6) AS mean_qty FROM lineitem WHERE l_returnflag = 'R'",
    "share_building": """
        SELECT round(avg(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END), 9) AS share FROM customer
    """,
    "mean_std_by_event": """
        SELECT event_type, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std FROM events GROUP BY 1
    """,
    "all_large_parts_in_types": """
        SELECT coalesce(bool_and(p_type IN ('PROMO', 'STANDARD', 'SMALL')), true) AS all_in FROM part WHERE p_size > 40
    """,
    "large_part_exceptions": """
        SELECT * FROM part WHERE p_size > 40 AND p_type NOT IN ('PROMO', 'STANDARD', 'SMALL')
    """,
    "describe_price_by_brand_type": described("part", "p_brand, p_type", ["p_size", "p_retailprice"]),
    "describe_lines_by_flags": described(
        "lineitem", "l_returnflag, l_linestatus", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
    "max_price_of_group": """
        SELECT max(p_retailprice) AS max_price FROM part WHERE p_brand = 'Brand#7' AND p_type = 'PROMO'
    """,
    "share_by_prefix": """
        SELECT starts_with(o_orderpriority, '1-') AS has_prefix,
               round(avg(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 9) AS share
        FROM orders GROUP BY 1
    """,
    "max_qty_share": """
        SELECT max(l_quantity) AS maximum, count(*) AS rows,
               round(100.0 * count(*) FILTER (l_returnflag = 'R') / count(*), 6) AS percent
        FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)
    """,
    "avg_balance_pivot": "SELECT c_nationkey, "
    + ", ".join(
        f"round(avg(c_acctbal) FILTER (c_mktsegment = '{s}'), 6) AS \"{s}\""
        for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM customer GROUP BY c_nationkey",
    "sized_parts": f"SELECT p_partkey, {SIZE_GROUP} AS size_group FROM part",
    "bin_counts": BIN_COUNTS,
    "top_bin": f"SELECT * FROM ({BIN_COUNTS}) ORDER BY count DESC, ord LIMIT 1",
    "group_describe": """
        SELECT c_nationkey, count(*) AS count, CAST(1 AS BIGINT) AS "unique", c_nationkey AS top, count(*) AS freq
        FROM customer GROUP BY c_nationkey
    """,
    "group_filter": """
        SELECT * FROM customer WHERE c_nationkey IN (
          SELECT c_nationkey FROM customer GROUP BY c_nationkey
          HAVING avg(c_acctbal) <= 4500 AND bool_and(c_acctbal > -980))
    """,
    "negate_between": """
        SELECT event_id, CASE WHEN value > 3 AND value < 8 THEN -value ELSE value END AS value FROM events
    """,
    "zero_max": """
        SELECT l_orderkey, l_partkey, l_linenumber,
               CASE WHEN l_quantity = (SELECT max(l_quantity) FROM lineitem) THEN 0 ELSE l_quantity END AS l_quantity
        FROM lineitem
    """,
    "direct_product": """
        SELECT p_partkey, word, kind, size
        FROM part, unnest(string_split(p_name, ' ')) w(word), unnest([p_brand, p_type]) k(kind),
             unnest([p_size, p_size * 2]) s(size)
    """,
    "rows_hitting_all": f"""
        SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM region WHERE NOT list_has_any({LINE_VECTOR}, [r_regionkey, r_regionkey + 1]))
    """,
    "rows_not_constant": f"""
        SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE len(list_distinct({LINE_VECTOR})) > 1
    """,
    "unique_flags": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "diagonal_product": """
        SELECT l_orderkey,
               coalesce(product(l_quantity) FILTER (l_linenumber = round(l_tax * 100) + 1 AND l_quantity <> 0), 1.0) AS product
        FROM lineitem GROUP BY l_orderkey
    """,
    "same_multiset": """
        SELECT 'orders, lines' AS pair,
               NOT EXISTS (SELECT o_orderkey FROM orders EXCEPT ALL SELECT l_orderkey FROM lineitem)
               AND NOT EXISTS (SELECT l_orderkey FROM lineitem EXCEPT ALL SELECT o_orderkey FROM orders) AS same
        UNION ALL
        SELECT 'joined lines, lines',
               NOT EXISTS (SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey
                           EXCEPT ALL SELECT l_orderkey FROM lineitem)
               AND NOT EXISTS (SELECT l_orderkey FROM lineitem
                               EXCEPT ALL SELECT o_orderkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey)
    """,
    "max_after_level": f"""
        WITH {SERIES}, paired AS (
          SELECT user_id, level, lag(level) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM series
        )
        SELECT user_id, max(CASE WHEN before = 5 THEN level END) AS max_after FROM paired GROUP BY user_id
    """,
    "event_runs": f"""
        WITH {SERIES}, flagged AS (
          SELECT *, lag(event_type) OVER w IS DISTINCT FROM event_type AS starts FROM series
          WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
        ), numbered AS (
          SELECT *, CAST(sum(CAST(starts AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS run_no
          FROM flagged
        )
        SELECT user_id, run_no, max(event_type) AS event_type, count(*) AS length FROM numbered GROUP BY user_id, run_no
    """,
    "pairwise_distance": """
        SELECT vec_id, CAST(i AS INTEGER) AS x_id, CAST(j AS INTEGER) AS y_id,
               round(sqrt(list_sum(list_transform(list_zip(
                 list_slice(embedding, i * 8 + 1, i * 8 + 8), list_slice(embedding, 32 + j * 8 + 1, 32 + j * 8 + 8)),
                 lambda p: pow(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE), 2)))), 6) AS d
        FROM embeddings, range(4) a(i), range(4) b(j)
    """,
    "mean_gap": """
        SELECT round(avg(l_extendedprice), 4) AS mean, round(avg(l_extendedprice) - 60, 4) AS gap FROM lineitem
    """,
    "sorted_values": "SELECT p_retailprice FROM part ORDER BY p_retailprice",
    "median_price": "SELECT round(quantile_cont(l_extendedprice, 0.5), 6) AS median FROM lineitem",
    "lowest_percentile_above": """
        SELECT min(n) AS percentile, round(arg_min(value, n), 6) AS value
        FROM (SELECT CAST(unnest(range(1, 101)) AS INTEGER) AS n,
                     unnest((SELECT quantile_cont(l_extendedprice, [x / 100.0 for x in range(1, 101)]) FROM lineitem)) AS value)
        WHERE value > 25000
    """,
    "share_above": """
        SELECT round(100.0 * avg(CASE WHEN l_extendedprice > 25000 THEN 1 ELSE 0 END), 6) AS share_above FROM lineitem
    """,
    "std_price": "SELECT round(stddev_pop(p_retailprice), 6) AS std FROM part",
    "upsert_customers": f"""
        WITH {CHANGES}, latest AS (
          SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY changed DESC, change_id DESC) = 1
        )
        SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM latest)
        UNION ALL
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM latest
    """,
    "insert_if_absent": f"""
        WITH {CHANGES}, moved AS (
          SELECT * REPLACE (c_custkey + CASE WHEN change_id % 4 = 0 THEN 1000000000 ELSE 0 END AS c_custkey)
          FROM changes
        )
        SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM moved
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer)
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY changed, change_id) = 1
    """,
    "constraint_violations": """
        SELECT 'key repeats' AS rule, 'l_orderkey,l_linenumber' AS "column", l_orderkey || ',' || l_linenumber AS value,
               count(*) AS rows
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
        UNION ALL
        SELECT 'too long', 'l_returnflag', l_returnflag || l_linestatus, count(*) FROM lineitem GROUP BY 3
        UNION ALL
        SELECT 'unknown reference', 'l_orderkey', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey
        UNION ALL
        SELECT 'unknown reference', 'l_partkey', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 2) GROUP BY l_partkey
    """,
    "profile": profiled(["p_partkey", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"]),
    "json_round_trip": "SELECT * REPLACE (nullif(o_orderpriority, '1-URGENT') AS o_orderpriority) FROM orders",
    "json_missing_keys": """
        SELECT 'c_acctbal' AS "column", count(*) AS records FROM customer WHERE c_acctbal < 0 HAVING count(*) > 0
    """,
    "xml_round_trip": "SELECT * REPLACE (CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS s_acctbal) FROM supplier",
    "csv_with_missing_values": """
        SELECT event_id,
               CASE event_type WHEN 'view' THEN 'say "view"' || chr(10) || 'now' WHEN 'click' THEN NULL ELSE event_type END AS event_type,
               CASE WHEN event_type <> 'error' THEN value END AS value
        FROM events
    """,
    "csv_in_ranges": """
        SELECT doc_id, text || chr(10) || 'from "' || source || '",' || chr(10) || chr(10) || 'in ' || coalesce(lang, 'no language') AS note, lang AS spoken
        FROM documents
    """,
    "number_lists": " UNION ALL ".join(
        f"SELECT {i} AS idx, count(*) AS lines, round(sum(CAST({c} AS DOUBLE)), 2) AS total, max(CAST({c} AS DOUBLE)) AS greatest FROM part"
        for i, c in enumerate(["p_partkey", "p_size", "p_retailprice"])
    ),
    "empty_files": """
        SELECT kind AS event_type, count(event_id) AS rows, count(event_id) > 0 AS passes
        FROM (VALUES ('click'), ('view'), ('purchase'), ('signup'), ('error'), ('none')) k(kind) LEFT JOIN events ON event_type = kind GROUP BY kind
    """,
    "json_document": "SELECT * REPLACE (nullif(o_orderpriority, '1-URGENT') AS o_orderpriority) FROM orders",
    "xml_document": "SELECT * REPLACE (CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal) FROM customer",
    "switched_table": "SELECT * FROM part",
    "reachable_over_successors": """
        WITH ring AS (SELECT p_partkey AS node, row_number() OVER (ORDER BY p_partkey) AS place, count(*) OVER () AS size FROM part),
             starts AS (SELECT p_brand AS root, min(p_partkey) AS node FROM part GROUP BY p_brand)
        SELECT root, ring.node, CAST((ring.place - first.place + ring.size) % ring.size + 1 AS INT) AS depth
        FROM starts JOIN ring AS first USING (node) CROSS JOIN ring
    """,
    "reloaded_table": """
        SELECT count(*) AS loaded, count(*) + count(*) FILTER (p_size > 40) AS stored, CAST(5 AS BIGINT) AS shown,
               CAST(0 AS BIGINT) AS left, count(*) FILTER (p_size > 2) + count(*) FILTER (p_size > 40) AS prices
        FROM part
    """,
    "short_text_count": "SELECT count(*) AS reviews FROM conversations WHERE length(text) < 40",
}


def ordered(name: str, order: str, columns: str, source: str | None = None) -> str:
    """Position and key of each row of a statement's result in ``order``."""
    return f"SELECT row_number() OVER (ORDER BY {order}) AS position, {columns} FROM ({source or STATEMENTS[name]})"


STATEMENTS |= {
    "bom_from_csv": STATEMENTS["fin_quantity"],
    "picked_up_files": STATEMENTS["clean_documents"],
    "processed_folder": STATEMENTS["clean_documents"],
    "published_merges": f"""
        SELECT *, (SELECT count(DISTINCT o_custkey) FROM orders) AS changed, (SELECT count(*) FROM supplier) AS added
        FROM ({STATEMENTS["upsert_customers"]})
    """,
    "keyed_merges": f"""
        SELECT *, (SELECT count(DISTINCT o_custkey) FROM orders) AS changed, (SELECT count(*) FROM supplier) AS added
        FROM ({STATEMENTS["upsert_customers"]})
    """,
    "order_of_parts_per_type": ordered("parts_per_type", "movie_count DESC, category_id", "category_id"),
    "order_of_top10_suppliers_by_lines": ordered("top10_suppliers_by_lines", "rentals DESC, actor_id", "actor_id"),
    "order_of_top3_counts_suppliers_promo": ordered("top3_counts_suppliers_promo", "appearances DESC, actor_id", "actor_id"),
    "order_of_customers_by_nation_balance": ordered("customers_by_nation_balance", "inactive_customers DESC, city_id", "city_id"),
    "order_of_sort_by_time": ordered(
        "sort_by_time", "time NULLS LAST, event_id", "event_id",
        """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN date_trunc('day', ts)
           WHEN 'view' THEN date_trunc('second', ts) ELSE ts END AS time FROM events""",
    ),
    "order_of_avg_value_per_day": ordered("avg_value_per_day", "day", "day"),
    "order_of_unique_flags": ordered(
        "unique_flags", "l_returnflag, l_linestatus, l_linenumber", "l_returnflag, l_linestatus, l_linenumber"
    ),
    "order_of_sorted_values": ordered("sorted_values", "p_retailprice", "p_retailprice"),
    "order_of_bom_explosion_annual": ordered(
        "bom_explosion_annual", "plant, fin_material_id, prod_material_id, component_id, year",
        "plant, fin_material_id, prod_material_id, component_id, year",
    ),
}
