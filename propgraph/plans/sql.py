"""For each registered query the SQL that DuckDB answers on the same tables."""

from __future__ import annotations

from propgraph.plans.catalog import HEAD, INGEST_GROUPS, LATER_LOAD, N_GROUPS

RATINGS = """ratings AS (
  SELECT o_custkey AS source_id, l_partkey AS target_id, CAST(l_quantity AS FLOAT) AS rating,
    CAST(epoch(l_shipdate) AS INTEGER) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FLIGHTS = """flights AS (
  SELECT CAST(row_number() OVER (
      ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate) - 1 AS BIGINT) AS key,
    CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
    CAST(day(l_shipdate) AS INTEGER) AS day, s_name AS airline, l_linenumber AS flight_number,
    sn.n_name AS origin_airport, cn.n_name AS destination_airport
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey),
airports AS (SELECT origin_airport AS name FROM flights UNION SELECT destination_airport FROM flights),
edges AS (
  SELECT key AS source_key, origin_airport AS target_name, 'FROM' AS type FROM flights
  UNION ALL SELECT key, destination_airport, 'TO' FROM flights),
regions AS (SELECT n_name AS name, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _group(col: str, n: int) -> str:
    return f"CAST(('0x' || substr(md5(CAST({col} AS VARCHAR)), 1, 8))::BIGINT % {n} AS INTEGER)"


def _groups(n: int) -> str:
    return f"""grouped AS (
  SELECT *, {_group("source_id", n)} AS source_group, {_group("target_id", n)} AS target_group FROM ratings),
batched AS (SELECT *, CAST((target_group - source_group + {n}) % {n} AS INTEGER) AS batch FROM grouped)"""


GROUPS = _groups(N_GROUPS)

TWICE = """twice AS (
  SELECT name FROM airports
  UNION ALL SELECT CASE WHEN region = 'ASIA' THEN name WHEN region <> 'EUROPE' THEN 'NEW ' || name END FROM regions)"""


def _snake(rank: str) -> str:
    n = N_GROUPS
    return f"CAST(CASE WHEN ({rank} // {n}) % 2 = 0 THEN {rank} % {n} ELSE {n - 1} - {rank} % {n} END AS INTEGER)"


def _top10(count: str, types: str) -> str:
    return f"""WITH {FLIGHTS}
SELECT target_name AS airport_name, count(*) AS {count} FROM edges WHERE type IN ({types})
GROUP BY target_name ORDER BY {count} DESC, airport_name LIMIT 10"""


SUMMARY = f"""WITH {FLIGHTS}
SELECT 'node' AS kind, 'Airports' AS name, count(*) AS n FROM airports
UNION ALL SELECT 'node', 'Flights', count(*) FROM flights
UNION ALL SELECT 'rel', type, count(*) FROM edges GROUP BY type"""

ORACLE: dict[str, str] = {
    "ratings": f"WITH {RATINGS} SELECT * FROM ratings",
    "edge_list_csv": f"WITH {RATINGS} SELECT * FROM ratings",
    "flights_csv": f"""WITH {FLIGHTS}
SELECT year, month, day, airline, flight_number, origin_airport, destination_airport FROM flights""",
    "sources": f"WITH {RATINGS} SELECT DISTINCT source_id FROM ratings",
    "targets": f"WITH {RATINGS} SELECT DISTINCT target_id FROM ratings",
    "sources_head": f"WITH {RATINGS} SELECT DISTINCT source_id FROM ratings ORDER BY source_id LIMIT 5",
    "flights": f"WITH {FLIGHTS} SELECT * FROM flights",
    "flights_head": f"WITH {FLIGHTS} SELECT * FROM flights WHERE key < {HEAD}",
    "airports": f"WITH {FLIGHTS} SELECT name FROM airports",
    "flights_from": f"WITH {FLIGHTS} SELECT origin_airport AS target_name, key AS source_key FROM flights",
    "flights_to": f"WITH {FLIGHTS} SELECT destination_airport AS target_name, key AS source_key FROM flights",
    "flights_from_x3": f"""WITH {FLIGHTS}
SELECT origin_airport AS target_name, key AS source_key FROM flights, range(3)""",
    "node_scan": f"WITH {FLIGHTS} SELECT key, airline, flight_number FROM flights",
    "rel_scan": f"""WITH {FLIGHTS}
SELECT f.key AS source_key, f.airline AS source_airline, a.name AS target_name
FROM edges e JOIN flights f ON e.source_key = f.key JOIN airports a ON e.target_name = a.name
WHERE e.type = 'FROM'""",
    "graph_summary": SUMMARY,
    "stored_graph_summary": SUMMARY,
    "stored_rel_scan": f"""WITH {FLIGHTS}
SELECT key AS source_key, airline AS source_airline, destination_airport AS target_name FROM flights""",
    "node_count": f"""WITH {FLIGHTS}
SELECT (SELECT count(*) FROM flights) + (SELECT count(*) FROM airports) AS node_count""",
    "rel_count": f"WITH {FLIGHTS} SELECT count(*) AS rel_count FROM edges",
    "rel_count_undirected": f"""WITH {FLIGHTS}
SELECT CAST(sum(CASE WHEN origin_airport = destination_airport THEN 1 ELSE 2 END) AS BIGINT) AS rel_count
FROM flights""",
    "airport_top10": _top10("flight_count", "'FROM', 'TO'"),
    "airport_top10_from": _top10("flight_start_count", "'FROM'"),
    "airport_top10_to": _top10("flight_end_count", "'TO'"),
    "node_upsert": """WITH e AS (
  SELECT c_custkey AS source_id, c_acctbal AS balance, c_mktsegment AS segment FROM customer WHERE c_acctbal >= 0),
o AS (
  SELECT o_custkey AS source_id, CASE WHEN bool_or(o_orderstatus <> 'F') THEN max(o_totalprice) END AS balance
  FROM orders GROUP BY o_custkey
  UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0),
i AS (SELECT source_id, max(balance) AS balance FROM o GROUP BY source_id)
SELECT coalesce(e.source_id, i.source_id) AS source_id,
  CASE WHEN i.source_id IS NOT NULL THEN i.balance ELSE e.balance END AS balance, segment
FROM e FULL JOIN i ON e.source_id = i.source_id""",
    "node_append": f"WITH {FLIGHTS} SELECT name FROM airports UNION ALL SELECT name FROM airports",
    "endpoint_upsert": f"""WITH {RATINGS},
known AS (SELECT c_custkey AS source_id, c_acctbal AS balance FROM customer WHERE c_acctbal >= 0)
SELECT source_id, balance FROM known
UNION ALL SELECT DISTINCT source_id, CAST(NULL AS DOUBLE)
FROM (SELECT source_id FROM ratings UNION ALL SELECT c_custkey FROM customer WHERE c_acctbal < 0)
WHERE source_id NOT IN (SELECT source_id FROM known)""",
    "rel_upsert": f"""WITH {RATINGS}
SELECT source_id, target_id, "timestamp", rating FROM ratings
QUALIFY row_number() OVER (PARTITION BY source_id, target_id ORDER BY "timestamp" DESC, rating DESC) = 1""",
    "rel_upsert_with_ends": f"""WITH {RATINGS},
rels AS (SELECT * FROM ratings
  QUALIFY row_number() OVER (PARTITION BY source_id, target_id ORDER BY "timestamp" DESC, rating DESC) = 1)
SELECT source_id, target_id, "timestamp", rating, 'rel' AS kind FROM rels
UNION ALL SELECT source_id, NULL, NULL, NULL, 'Source'
FROM (SELECT source_id FROM ratings UNION SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL SELECT NULL, p_partkey, NULL, NULL, 'Target' FROM part""",
    "rel_append_match_int": f"""WITH {RATINGS}
SELECT CAST(source_id AS INTEGER) AS source_id, CAST(target_id AS INTEGER) AS target_id, rating, "timestamp"
FROM ratings JOIN part ON target_id = p_partkey WHERE p_size <= 25""",
    "rel_append_match": f"""WITH {FLIGHTS}
SELECT key AS source_key, origin_airport AS target_name
FROM flights JOIN regions ON origin_airport = name, range(3) WHERE region <> 'AFRICA'""",
    "rel_merge_bare": f"""WITH {FLIGHTS}
SELECT DISTINCT source_key, target_name FROM edges""",
    "rel_merge_keyed": f"""WITH {RATINGS},
e AS (
  SELECT DISTINCT source_id, target_id, "timestamp", CAST(0 AS FLOAT) AS rating
  FROM ratings WHERE "timestamp" < {LATER_LOAD}),
i AS (
  SELECT source_id, target_id, "timestamp", max(rating) AS rating
  FROM ratings JOIN part ON target_id = p_partkey JOIN customer ON source_id = c_custkey
  WHERE p_size <= 25 GROUP BY ALL)
SELECT source_id, target_id, "timestamp", coalesce(i.rating, e.rating) AS rating
FROM e FULL JOIN i USING (source_id, target_id, "timestamp")""",
    "edge_groups": f"WITH {RATINGS}, {GROUPS} SELECT * FROM grouped",
    "edge_groups_balanced": f"""WITH {RATINGS},
s AS (SELECT source_id, row_number() OVER (ORDER BY count(*) DESC, source_id) - 1 AS r FROM ratings GROUP BY source_id),
t AS (SELECT target_id, row_number() OVER (ORDER BY count(*) DESC, target_id) - 1 AS r FROM ratings GROUP BY target_id)
SELECT source_id, target_id, rating, "timestamp", {_snake("s.r")} AS source_group, {_snake("t.r")} AS target_group
FROM ratings JOIN s USING (source_id) JOIN t USING (target_id)""",
    "edge_batches": f"WITH {RATINGS}, {GROUPS} SELECT * FROM batched",
    "batch_heatmap": f"""WITH {RATINGS}, {GROUPS}
SELECT batch, source_group, target_group, count(*) AS rel_count FROM batched GROUP BY ALL""",
    "ingest_union": f"WITH {RATINGS}, {_groups(INGEST_GROUPS)} SELECT batch, count(*) AS rel_count FROM batched GROUP BY batch",
    "unique_violations": f"""WITH {FLIGHTS}, {TWICE}
SELECT name, count(*) AS n_nodes FROM twice WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 1""",
    "key_violations": f"""WITH {FLIGHTS}, {TWICE}
SELECT name, count(*) AS n_nodes FROM twice GROUP BY name HAVING count(*) > 1 OR name IS NULL""",
    "constraint_report": f"""WITH {FLIGHTS}, {TWICE},
d AS (SELECT count(*) AS n FROM (SELECT name FROM twice WHERE name IS NOT NULL GROUP BY name HAVING count(*) > 1)),
z AS (SELECT count(*) AS n FROM twice WHERE name IS NULL),
f AS (SELECT count(*) AS n FROM (SELECT key FROM flights GROUP BY key HAVING count(*) > 1))
SELECT 'Airports' AS label, 'name' AS property, 'unique' AS kind, d.n AS violations FROM d
UNION ALL SELECT 'Airports', 'name', 'key', d.n + z.n FROM d, z
UNION ALL SELECT 'Flights', 'key', 'unique', f.n FROM f""",
    "delete_rels": f"""WITH {FLIGHTS}
SELECT type, count(*) FILTER (WHERE type <> 'FROM') AS rel_count FROM edges GROUP BY type""",
    "detach_delete": f"""WITH {FLIGHTS}
SELECT type, count(*) AS rel_count FROM edges
WHERE target_name NOT IN (SELECT name FROM regions WHERE region = 'AFRICA') GROUP BY type""",
    "plain_delete": f"""WITH {FLIGHTS}
SELECT 'node' AS kind, 'Airports' AS name, count(*) AS n FROM regions WHERE region <> 'AFRICA'
UNION ALL SELECT 'node', 'Flights', count(*) FROM flights
UNION ALL SELECT DISTINCT 'rel', type, 0 FROM edges""",
    "delete_everything": """SELECT unnest(['node', 'node', 'rel', 'rel']) AS kind,
  unnest(['Airports', 'Flights', 'FROM', 'TO']) AS name, CAST(0 AS BIGINT) AS n""",
}
ORACLE["ingest_merge_keyed"] = ORACLE["rel_merge_keyed"]
ORACLE["ingest_append_match"] = ORACLE["rel_append_match"]
ORACLE["ingest_resumed"] = ORACLE["ingest_union"]
ORACLE["rel_append_retried"] = ORACLE["rel_append_match"]
ORACLE["stored_upsert"] = ORACLE["rel_upsert_with_ends"]
ORACLE["stored_merge_keyed"] = ORACLE["rel_merge_keyed"]
ORACLE["stored_delete"] = f"""WITH {FLIGHTS},
kept AS (
  SELECT type, year FROM edges JOIN flights ON source_key = key
  WHERE target_name NOT IN (SELECT name FROM regions WHERE region = 'AFRICA')),
counted AS (
  SELECT 'node' AS kind, 'Airports' AS name, count(*) AS n FROM regions WHERE region <> 'AFRICA'
  UNION ALL SELECT 'node', 'Flights', count(*) FROM flights
  UNION ALL SELECT 'rel', type, count(*) FILTER (type = 'FROM' OR year >= 1998) FROM kept GROUP BY type)
SELECT state, counted.* FROM counted, (SELECT unnest(['hidden', 'compacted']) AS state)"""
ORACLE["flights_extended"] = f"""WITH {FLIGHTS}
SELECT row_number() OVER (ORDER BY year >= 1998, key) - 1 AS key, year, month, day, airline, flight_number,
  origin_airport, destination_airport
FROM flights"""
ORACLE["stored_constraint"] = "SELECT c_custkey AS source_id, c_acctbal AS balance FROM customer"
ORACLE["part_top10"] = f"""WITH {RATINGS}
SELECT target_id, count(*) AS rating_count FROM ratings GROUP BY target_id
ORDER BY rating_count DESC, target_id LIMIT 10"""
