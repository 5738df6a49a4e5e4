"""The test-table mapping of ``sources.fixtures`` as DuckDB CTEs.

Prepended to every oracle query; reads only the pre-registered driver views.
"""

D = "DATE '1998-07-01'"
EPOCH = "DATE '1992-01-01'"


def n_of(col: str = "date") -> str:
    return f"date_diff('day', {EPOCH}, {col})"


N = n_of("date")
BT = "(40 + (17 * a + 31 * r + 5 * m + 11 * s) % 150)"
MILLI = "(7 + (a * 37 + m * 11) % 240)"

FIXTURE_CTES = f"""
sales_t AS (
  SELECT CAST(l.l_shipdate AS DATE) AS date,
         CAST(l.l_partkey AS INTEGER) AS a,
         CAST(cn.n_regionkey AS INTEGER) AS r,
         CAST(l.l_suppkey % 3 AS INTEGER) AS m,
         CAST((l.l_suppkey // 3) % 2 AS INTEGER) AS s,
         sn.n_regionkey AS src_region,
         l.l_quantity, l.l_extendedprice, l.l_linenumber
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN nation cn ON cu.c_nationkey = cn.n_nationkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation sn ON su.s_nationkey = sn.n_nationkey
),
sales_x AS (
  SELECT date,
         CASE m WHEN 0 THEN 'Ozon' WHEN 1 THEN 'WB' ELSE 'YM' END AS mp,
         'S' || s AS seller, 'K' || m || '-' || a AS sku, 'A' || a AS article_1c, 'C' || a AS code_1c,
         'R' || r AS cluster_to,
         CASE WHEN src_region = 0 THEN 'Основной' ELSE 'R' || src_region END AS cluster_from,
         CAST(l_quantity AS BIGINT) AS quantity_orders,
         l_extendedprice * CASE WHEN l_linenumber = 7 THEN 0.25 ELSE 1.0 END AS orders_sum,
         l_extendedprice * 0.5 AS cost_value_orders,
         a, r, m, s
  FROM sales_t
),
sales AS (SELECT date, mp, seller, sku, article_1c, code_1c, cluster_to, cluster_from,
                 quantity_orders, orders_sum, cost_value_orders FROM sales_x),
k AS (SELECT DISTINCT mp, seller, sku, article_1c, code_1c, cluster_to, a, r, m, s FROM sales_x),
act AS (
  SELECT DISTINCT mp, seller, sku, article_1c, code_1c, cluster_to, a, r, m, s,
         CAST(date + CAST(unnest(range(-10, 26)) AS INTEGER) AS DATE) AS date
  FROM (SELECT DISTINCT mp, seller, sku, article_1c, code_1c, cluster_to, a, r, m, s, date FROM sales_x) x
),
article_one AS (
  SELECT DISTINCT article_1c, code_1c, sku, mp, seller, 'name-A' || a AS name,
         CASE WHEN a % 4 = 1 AND m = 2 THEN 'РЕСЕЙЛ' ELSE 'B' || (a % 2) END AS brand,
         CASE WHEN a % 4 = 3 AND m = 0 THEN 1 ELSE 0 END AS discounted,
         'WC' || a AS warehouse_code,
         CASE WHEN a % 4 = 2 AND m = 1 AND s = 1 THEN ''
              ELSE '0.' || lpad(CAST({MILLI} AS VARCHAR), 3, '0') END AS volume_m3, a, m
  FROM k WHERE a % 50 <> 13
),
article_mp AS (
  SELECT * EXCLUDE (a, m) FROM article_one
  UNION ALL SELECT * EXCLUDE (a, m) REPLACE ('B9' AS brand) FROM article_one WHERE a % 50 = 11
  UNION ALL SELECT * EXCLUDE (a, m) REPLACE ('0.' || lpad(CAST({MILLI} + 5 AS VARCHAR), 3, '0') AS volume_m3)
            FROM article_one WHERE a % 50 = 17
),
warehouses AS (SELECT DISTINCT mp, 'W-' || cluster_to AS warehouse_name, cluster_to AS cluster FROM k),
stocks AS (
  SELECT date, mp, seller, sku, article_1c, code_1c,
         CASE WHEN a % 50 = 19 THEN 'W-unknown' ELSE 'W-' || cluster_to END AS warehouse_name,
         CAST(({N} * (2 + m) + 13 * a + 7 * r + 5 * s) % 41 AS BIGINT) AS quantity,
         CAST(({N} * (2 + m) + 13 * a + 7 * r + 5 * s) % 41 AS BIGINT) AS quantityFree,
         CAST(({N} * (2 + m) + 13 * a + 7 * r + 5 * s) % 41 + 3 AS BIGINT) AS quantityFull
  FROM act
  UNION ALL
  SELECT date, '1C', '', '', article_1c, code_1c, 'Основной',
         CAST((3 * {N} + 17 * a) % 97 AS BIGINT), CAST((3 * {N} + 17 * a) % 97 AS BIGINT),
         CAST((3 * {N} + 17 * a) % 97 + 5 AS BIGINT)
  FROM (SELECT DISTINCT article_1c, code_1c, a, date FROM act) ka
),
buffer_main AS (
  SELECT 2 AS id_ver, date, 'name-A' || a AS name, article_1c, code_1c, mp, seller, sku, cluster_to,
         CAST(10 * a + r AS BIGINT) AS total_quantity_orders,
         CAST(a % 4 + 3 AS BIGINT) AS max_quantity_order,
         (8 * (a % 4) + r) / 16 AS avg_quantity_orders,
         CAST(r AS BIGINT) AS days_oos_number, CAST(a % 4 AS BIGINT) AS days_bp_number,
         CAST(7 AS BIGINT) AS avg_day_to_cluster, CAST(0 AS BIGINT) AS insurance_reserv_cluster,
         CAST(28 AS BIGINT) AS buffer_cluster_norm,
         CAST({BT} + 5 * second AS BIGINT) AS buffer_cluster,
         CAST(0 AS BIGINT) AS deliveries_to_cluster,
         0.0::DOUBLE AS buffer_cluster_marker_current, 0.0::DOUBLE AS buffer_cluster_marker,
         CAST(({N} * (1 + m) + a + r) % 13 AS BIGINT) AS quantity_orders,
         CAST(CASE WHEN (a + r + m) % 3 = 0 THEN {BT} - ({N} + s) % 11
                   ELSE greatest(0, ({N} * (3 + m) + 29 * a + 17 * r + 23 * s) % (30 + 40 * (a % 4) + 12 * r) - 5 * r)
              END + 3 * second AS BIGINT) AS quantity_stocks,
         CAST(0 AS BIGINT) AS quantity_supplies, CAST(0 AS BIGINT) AS quantity_supplies_within_rt,
         CAST(({N} + a + r) % 6 AS BIGINT) AS new_buffer
  FROM (SELECT *, unnest(CASE WHEN a % 50 = 7 THEN [0, 1] ELSE [0] END) AS second FROM act
        WHERE date < {D} AND NOT (r = 4 AND ({N} + a) % 2 = 0) AND NOT (r = 3 AND a % 4 >= 2)) h
),
buffer_supplies AS (
  SELECT 2 AS id_ver, mp || '_' || seller || '_' || cluster_to AS supply_id,
         CAST(date - 3 AS DATE) AS shipping_date, CAST(date - 3 + CAST(5 + 4 * (a % 3) AS INTEGER) AS DATE) AS closing_date,
         article_1c, code_1c, mp, seller, sku, cluster_to,
         CAST(quantity_orders AS INTEGER) AS quantity_supplies
  FROM sales_x WHERE date - 3 < {D} AND ({N} + quantity_orders) % 3 = 0
),
calc_keys_fx AS (
  SELECT {D} AS date, mp, seller, sku, article_1c, code_1c, cluster_to,
         CASE WHEN r = 3 AND a % 4 >= 2 THEN 'first_init'
              WHEN (a + r + m + s) % 3 IN (0, 1) THEN 'recalc_day' ELSE 'simulate_day' END AS calc_type,
         CASE (a + r + m + s) % 3 WHEN 0 THEN 'UP' WHEN 1 THEN 'DOWN' ELSE 'HOLD' END AS action_suggested,
         CAST(30 + (13 * a + 7 * r) % 60 AS BIGINT) AS min_buffer,
         CAST(0 AS BIGINT) AS new_buffer_prev, CAST(0 AS BIGINT) AS is_first_day,
         CAST(0 AS BIGINT) AS is_recalc_day, 2 AS id_ver
  FROM k
),
goods_supplies AS (
  SELECT {D} AS date, 'SUP' || a || '-' || r || '-' || m || '-' || s AS supply_id,
         mp, seller, article_1c, code_1c, CAST((7 * a + 5 * r + m) % 12 AS BIGINT) AS quantity
  FROM k
),
supplies_list AS (SELECT 'SUP' || a || '-' || r || '-' || m || '-' || s AS supply_id,
                         'W-' || cluster_to AS fc_warehouse FROM k),
import_supplies AS (SELECT DISTINCT code_1c, article_1c, CAST(100 + 10 * (a % 4) AS BIGINT) AS quantity FROM k),
dimensions AS (SELECT DISTINCT article_1c, sku, seller, mp,
                      CASE a % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'M' ELSE 'L' END AS mark_mp FROM k)
"""
