"""The same queries as SQL text for DuckDB over the tables of the star schema."""

_OBSERVATIONS = """observations AS (
  SELECT o_custkey AS location, CAST(o_orderdate AS DATE) AS date, o_totalprice AS total_cases,
         CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS new_cases,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS total_deaths,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS new_deaths
  FROM orders)"""

_CLEAN = (
    _OBSERVATIONS
    + """, clean AS (
  SELECT location, date, coalesce(total_cases, 0.0) AS total_cases,
         coalesce(new_cases, 0.0) AS new_cases, coalesce(total_deaths, 0.0) AS total_deaths,
         coalesce(new_deaths, 0.0) AS new_deaths
  FROM observations)"""
)

_DAILY = (
    _CLEAN
    + """, daily AS (
  SELECT location, date,
         CAST(sum(CAST(total_cases AS DECIMAL(18, 2))) AS DOUBLE) AS total_cases,
         CAST(sum(CAST(new_cases AS DECIMAL(18, 2))) AS DOUBLE) AS new_cases,
         CAST(sum(CAST(total_deaths AS DECIMAL(18, 2))) AS DOUBLE) AS total_deaths,
         CAST(sum(CAST(new_deaths AS DECIMAL(18, 2))) AS DOUBLE) AS new_deaths
  FROM clean GROUP BY location, date)"""
)

_RATED = """counted AS (
  SELECT user_id AS location, count(*) AS "Confirmed",
         count(CASE WHEN event_type = 'error' THEN 1 END) AS "Deaths",
         count(CASE WHEN event_type = 'purchase' THEN 1 END) AS "Recovered"
  FROM events GROUP BY user_id), rated AS (
  SELECT *, CASE WHEN "Confirmed" > 0 THEN CAST("Deaths" AS DOUBLE) / "Confirmed"
                 ELSE 0.0 END AS mortality_rate,
         CASE WHEN "Confirmed" > 0 THEN CAST("Recovered" AS DOUBLE) / "Confirmed"
              ELSE 0.0 END AS recovery_rate
  FROM counted)"""

_JOINED = (
    f"{_DAILY}, {_RATED}"
    + """, joined AS (
  SELECT d.*, r."Confirmed", r."Deaths", r."Recovered", r.mortality_rate, r.recovery_rate
  FROM daily d JOIN rated r ON d.location = r.location), latest AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY location ORDER BY date DESC NULLS LAST) AS place
    FROM joined) AS placed WHERE place = 1)"""
)

_RANKING = (
    _JOINED
    + """, ranking AS (
  SELECT location, recovery_rate FROM latest
  ORDER BY recovery_rate DESC NULLS LAST, location LIMIT 40)"""
)

_WITH_RATES = f"WITH {_JOINED} SELECT * FROM joined"

_OUTPUTS = """outputs AS (
  SELECT kind || ' ' || id AS task, kind || '-' || id AS name, 'data/' || kind || '/' || id AS path
  FROM (SELECT 'region' AS kind, CAST(r_regionkey AS VARCHAR) AS id FROM region
        UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR) FROM nation
        UNION ALL SELECT 'customer', CAST(c_custkey AS VARCHAR) FROM customer
        UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR) FROM supplier
        UNION ALL SELECT 'part', CAST(p_partkey AS VARCHAR) FROM part
        UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR) FROM orders) AS rows_)"""

_CONSUMERS = """consumers AS (
  SELECT 'nation ' || n_nationkey AS task, 'region-' || n_regionkey AS dataset FROM nation
  UNION ALL SELECT 'customer ' || c_custkey, 'data/nation/' || c_nationkey FROM customer
  UNION ALL SELECT 'supplier ' || s_suppkey, 'data/nation/' || s_nationkey FROM supplier
  UNION ALL SELECT 'order ' || o_orderkey, 'customer-' || o_custkey FROM orders
  UNION ALL SELECT 'line ' || l_orderkey || ' ' || l_linenumber, 'data/order/' || l_orderkey
            FROM lineitem
  UNION ALL SELECT 'line ' || l_orderkey || ' ' || l_linenumber, 'part-' || l_partkey
            FROM lineitem
  UNION ALL SELECT 'line ' || l_orderkey || ' ' || l_linenumber, 'supplier-' || l_suppkey
            FROM lineitem)"""

_EDGES = f"""{_OUTPUTS}, {_CONSUMERS}, producers AS (
  SELECT task, name AS dataset FROM outputs UNION ALL SELECT task, path FROM outputs), edges AS (
  SELECT DISTINCT p.task AS src, c.task AS dst
  FROM consumers c JOIN producers p ON c.dataset = p.dataset)"""

_SELECT_EDGES = f"WITH {_EDGES} SELECT src, dst FROM edges"


def _fan_in(parts=1):
    return f"""WITH {_EDGES}, grouped AS (
  SELECT dst, CAST('0x' || substr(md5(src), 1, 8) AS BIGINT) % {parts} AS part, count(*) AS n,
         array_to_string(list_sort(list(src)), ', ') AS names
  FROM edges GROUP BY ALL)
SELECT dst, CAST(part AS INTEGER) AS part, CAST(n AS INTEGER) AS upstreams,
       CASE WHEN n = 1 THEN names ELSE '[' || names || ']' END || ' >> ' || dst AS line
FROM grouped"""


def _acyclic(graph, edges, column_type):
    """No vertex reaches itself. `edges` defines the relation `graph_edges(src, dst)`."""
    return f"""WITH RECURSIVE {edges}, reach(src, dst) AS (
  SELECT CAST(src AS {column_type}), CAST(dst AS {column_type}) FROM graph_edges
  UNION
  SELECT r.src, CAST(e.dst AS {column_type}) FROM reach r JOIN graph_edges e ON r.dst = e.src)
SELECT '{graph}' AS graph, NOT EXISTS (SELECT 1 FROM reach WHERE src = dst) AS acyclic"""


_STOCK_EDGES = """graph_edges AS (
  SELECT DISTINCT f.l_orderkey AS src, o.l_orderkey AS dst
  FROM lineitem f JOIN lineitem o
    ON f.l_partkey = o.l_partkey AND f.l_suppkey = o.l_suppkey
   AND f.l_linestatus = 'F' AND o.l_linestatus = 'O')"""

_TRADE = """trade AS (
  SELECT DISTINCT c_nationkey AS src, s_nationkey AS dst
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

_ROW_GRAPH = f"{_EDGES}, graph_edges AS (SELECT src, dst FROM edges)"


def _check(relation, columns, keys, ranges):
    parts = [
        "count(*) AS row_count",
        "(SELECT count(*) FROM keyed) AS key_count",
        "(SELECT count(*) FROM keyed WHERE n > 1) AS repeated_keys",
        f"count(*) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in keys)}) AS null_key_rows",
    ]
    parts += [
        f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in columns if c not in keys
    ]
    parts += [
        f"count(*) FILTER (WHERE {c} < {low} OR {c} > {high}) AS outside_{c}"
        for c, (low, high) in ranges.items()
    ]
    key_list = ", ".join(keys)
    return (
        f", keyed AS (SELECT {key_list}, count(*) AS n FROM {relation} GROUP BY {key_list})"
        f"\nSELECT {', '.join(parts)} FROM {relation}"
    )


_ALL = ["location", "date", "total_cases", "new_cases", "total_deaths", "new_deaths"]

_NET_TRADE = """sold AS (
  SELECT s_nationkey AS src, c_nationkey AS dst, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL), graph_edges AS (
  SELECT a.src, a.dst FROM sold a LEFT JOIN sold b ON a.src = b.dst AND a.dst = b.src
  WHERE a.n > coalesce(b.n, 0))"""

# Of each pair of vertices that reach each other.
_ON_CYCLES = """reach AS (
  SELECT src, dst FROM graph_edges
  UNION SELECT reach.src, e.dst FROM reach JOIN graph_edges e ON reach.dst = e.src), on_cycle AS (
  SELECT a.src, a.dst FROM reach a JOIN reach b ON a.src = b.dst AND a.dst = b.src)"""

_FAULTY = "location % 97 = 0 OR location % 89 = 1 OR location % 83 = 2"

ORACLE = {
    "top_recovery_locations": f"WITH {_RANKING} SELECT * FROM ranking",
    "observations_clean": f"WITH {_CLEAN} SELECT * FROM clean",
    "observations_daily": f"WITH {_DAILY} SELECT * FROM daily",
    "snapshot_rates": f"WITH {_RATED} SELECT * FROM rated",
    "observations_with_rates": _WITH_RATES,
    "observations_with_rates_salted": _WITH_RATES,
    "lost_locations": f"""WITH {_DAILY}, {_RATED}
SELECT location, count(*) AS rows FROM daily
WHERE NOT EXISTS (SELECT 1 FROM rated WHERE rated.location = daily.location) GROUP BY location""",
    "one_row_per_location": f"WITH {_JOINED} SELECT * FROM latest",
    "largest_order_per_location": f"""WITH {_CLEAN}
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY location ORDER BY total_cases DESC, date DESC,
         new_cases DESC, total_deaths DESC, new_deaths DESC) AS place
  FROM clean) AS placed WHERE place = 1""",
    "any_row_per_location": f"""WITH {_JOINED}
SELECT DISTINCT location, "Confirmed", "Deaths", "Recovered", mortality_rate, recovery_rate
FROM joined""",
    "top_recovery_semi": f"WITH {_RANKING} SELECT * FROM ranking",
    "csv_scan_roundtrip": f"""WITH {_DAILY}
SELECT CAST(location AS VARCHAR) AS location, * EXCLUDE (location) FROM daily""",
    "csv_scan_by_name": f"""WITH {_DAILY}
SELECT CAST(location AS VARCHAR) AS location, * EXCLUDE (location) FROM daily""",
    "csv_snapshot_scan": f"""WITH {_RATED}
SELECT CAST(location AS VARCHAR) AS location, "Confirmed",
       "Confirmed" - "Deaths" - "Recovered" AS "Active",
       CAST(CASE WHEN "Recovered" = 0 THEN 1 ELSE 0 END AS INTEGER) AS no_recovery,
       CASE WHEN "Recovered" > 0
            THEN round(100 * "Deaths" / CAST("Recovered" AS DOUBLE), 2) END AS deaths_per_100,
       CAST(0 AS DOUBLE) AS week_increase, 'All' AS region
FROM rated""",
    "parquet_publish_twice": f"WITH {_DAILY} SELECT * FROM daily",
    "parquet_replace_twice": f"WITH {_DAILY} SELECT * FROM daily",
    "rank_published_csv": f"""WITH {_JOINED}
SELECT CAST(location AS VARCHAR) AS location, recovery_rate FROM latest
ORDER BY recovery_rate DESC NULLS LAST, CAST(location AS VARCHAR) LIMIT 40""",
    "rank_published_checked": f"""WITH {_JOINED}
SELECT CAST(location AS VARCHAR) AS location, recovery_rate FROM latest
ORDER BY recovery_rate DESC NULLS LAST, CAST(location AS VARCHAR) LIMIT 40""",
    "load_ready_rows": f"WITH {_RANKING} SELECT * FROM ranking",
    "output_check": f"WITH {_RANKING}"
    + _check(
        "ranking", ["location", "recovery_rate"], ["location"], {"recovery_rate": (0.0, 1.0)}
    ),
    "output_check_daily": f"WITH {_DAILY}"
    + _check(
        "daily",
        _ALL,
        ["location", "date"],
        {"total_cases": (0.0, 400000.0), "new_cases": (0.0, 400000.0)},
    ),
    "output_check_clean": f"WITH {_OBSERVATIONS}"
    + _check("observations", _ALL, ["location"], {"new_deaths": (1000.0, 250000.0)}),
    "lineage_edges": _SELECT_EDGES,
    "lineage_edges_salted": _SELECT_EDGES,
    "lineage_fan_in": _fan_in(),
    "lineage_fan_in_parts": _fan_in(3),
    "lineage_dependency_lines": _fan_in(),
    "lineage_acyclic": _acyclic("rows", _ROW_GRAPH, "VARCHAR"),
    "lineage_acyclic_orders": _acyclic("orders", _STOCK_EDGES, "BIGINT"),
    "lineage_acyclic_trade": _acyclic(
        "trade", f"{_TRADE}, graph_edges AS (SELECT src, dst FROM trade)", "INTEGER"
    ),
    "lineage_acyclic_net_trade": _acyclic(
        "net trade",
        _NET_TRADE,
        "INTEGER",
    ),
    "lineage_output_contract": """WITH lines AS (
  SELECT l_orderkey, count(DISTINCT l_partkey || '/' || l_suppkey) FILTER (l_linestatus = 'F') AS n,
         count(*) FILTER (l_linestatus <> 'F') AS bare
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS task, coalesce(n, 0) AS outputs, coalesce(bare, 0) AS without_path
FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
WHERE coalesce(n, 0) <> 1 OR coalesce(bare, 0) > 0""",
    "csv_checked_daily": f"""WITH {_DAILY}
SELECT * REPLACE (CAST(location AS VARCHAR) AS location) FROM daily WHERE NOT ({_FAULTY})""",
    "csv_malformed_rows": f"""WITH {_OBSERVATIONS}, faults AS (
  SELECT location, location % 83 = 2 AS short, location % 89 = 1 AS dated, location % 97 = 0 AS worded,
         strftime(date, '%d/%m/%Y') AS day
  FROM observations WHERE {_FAULTY})
SELECT location, CASE WHEN short THEN 'not 6 fields'
  ELSE concat_ws('; ', CASE WHEN dated THEN 'date is not date: ' || day END,
                 CASE WHEN worded THEN 'total_cases is not double: n/a' END) END AS reason
FROM faults""",
    "nearest_lost_names": """WITH named AS (
  SELECT c_custkey, c_name, CASE WHEN c_custkey % 50 = 7 THEN reverse(c_name)
    WHEN c_custkey % 15 = 0 THEN replace(c_name, 'Customer', 'Custommer')
    WHEN c_custkey % 15 = 5 THEN replace(c_name, 'Customer', 'Custmer')
    WHEN c_custkey % 15 = 10 THEN replace(c_name, 'Customer', 'Cuztomer') ELSE c_name END AS name
  FROM customer), lost AS (
  SELECT name, count(*) AS rows FROM named JOIN orders ON o_custkey = c_custkey
  WHERE name NOT IN (SELECT c_name FROM customer) GROUP BY name), near AS (
  SELECT name, c_name, levenshtein(name, c_name) AS d FROM lost, customer WHERE levenshtein(name, c_name) <= 1)
SELECT lost.name AS location, rows, arg_min(c_name, (d, c_name)) AS nearest, min(d)::INTEGER AS distance
FROM lost LEFT JOIN near USING (name) GROUP BY ALL""",
    "lineage_cycle_net_trade": f"""WITH RECURSIVE {_NET_TRADE}, {_ON_CYCLES}
SELECT src AS nation, min(dst) AS component, count(*) AS size FROM on_cycle GROUP BY src""",
    "lineage_cycle_customers": f"""WITH RECURSIVE large AS (
  SELECT DISTINCT o_custkey AS task, l_partkey AS d, l_linestatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_quantity >= 45), supplied AS (
  SELECT task, d FROM large WHERE status = 'F'), taken AS (
  SELECT task, d FROM large WHERE status = 'O'), graph_edges AS (
  SELECT DISTINCT supplied.task AS src, taken.task AS dst FROM supplied JOIN taken USING (d)
  WHERE supplied.task IN (SELECT task FROM taken) AND taken.task IN (SELECT task FROM supplied)), {_ON_CYCLES}
SELECT src::VARCHAR AS task, min(dst::VARCHAR) AS component, count(*) AS size FROM on_cycle GROUP BY src""",
}
