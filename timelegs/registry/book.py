"""The register of queries and their reference SQL.

The SQL is written for DuckDB and from the rules alone. It shares no text with the Spark
side; the common tables below state the sample network a second time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from timelegs.sources.sample_network import SampleNetwork

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: list[str] | None = None):
    """Register a function of the network under ``name``, with SQL over the named views."""

    def register(build: Callable[[SampleNetwork], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: build(SampleNetwork(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql, views or [])
        return build

    return register


def with_views(sql: str, views: list[str]) -> str:
    """The statement with the views it names, and those they need, in front of it."""
    ordered: list[str] = []

    def add(view: str) -> None:
        if view in ordered:
            return
        needs, _ = VIEWS[view]
        for need in needs:
            add(need)
        ordered.append(view)

    for view in views:
        add(view)
    if not ordered:
        return sql.strip()
    tables = ",\n".join(f"{v} AS ({VIEWS[v][1].strip()})" for v in ordered)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {tables},\n{body[5:]}"
    return f"WITH {tables}\n{body}"


def code(key: str) -> str:
    """A stop code, as SQL over a key expression."""
    return (
        f"CASE WHEN {key} < 3 THEN concat('LOCAL', {key}) "
        f"ELSE concat(100 + {key} % 7, 'S', {key}) END"
    )


BLANK = "({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def blank(column: str) -> str:
    return BLANK.format(c=column)


RAW_COLUMNS = [
    "source_file",
    "vehicle_journey_code",
    "service_ref",
    "line_ref",
    "journey_pattern_ref",
    "departure_time",
    "vehicle_timing_link_id",
    "journey_pattern_timing_link_ref",
    "from_sequence",
    "from_stop_ref",
    "from_timing_status",
    "from_activity",
    "to_sequence",
    "to_stop_ref",
    "to_timing_status",
    "to_activity",
    "route_link_ref",
    "runtime_iso",
    "runtime_seconds",
    "runtime_minutes",
]

REQUIRED = (
    "source_file",
    "vehicle_journey_code",
    "line_ref",
    "departure_time",
    "from_stop_ref",
    "to_stop_ref",
)

COMPLETE = " AND ".join(f"trim({c}) <> ''" for c in REQUIRED)

# view -> (views it needs, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {
    "lines": (
        [],
        """
        SELECT l.*, p.p_brand, p.p_size,
               CAST(l_quantity AS INT) AS quantity,
               CAST(floor(l_tax * 100.0 + 0.5) AS INT) AS tax,
               CAST(floor(l_discount * 100.0 + 0.5) AS INT)
                   * CASE WHEN l_quantity >= 49 THEN 4 ELSE 1 END AS minutes,
               l_partkey % (SELECT count(*) FROM supplier) AS to_key
        FROM lineitem l JOIN part p ON l_partkey = p_partkey
        """,
    ),
    "raw": (
        ["lines"],
        f"""
        SELECT concat('file_', l_orderkey % 20) AS source_file,
               concat('VJ', l_orderkey) AS vehicle_journey_code,
               concat('SV', p_size) AS service_ref,
               CASE WHEN quantity = 9 AND tax = 8 THEN '  ' ELSE p_brand END AS line_ref,
               concat('JP', l_partkey) AS journey_pattern_ref,
               CASE WHEN quantity = 10 AND tax = 8 THEN 'late'
                    ELSE concat(lpad(CAST(l_orderkey % 27 AS VARCHAR), 2, '0'), ':',
                                lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0'), ':00')
               END AS departure_time,
               concat('VL', l_orderkey, '_', l_linenumber) AS vehicle_timing_link_id,
               concat('JL', l_partkey) AS journey_pattern_timing_link_ref,
               l_linenumber AS from_sequence,
               {code("l_suppkey")} AS from_stop_ref,
               CASE l_returnflag WHEN 'A' THEN 'PTP' WHEN 'N' THEN 'OTH' ELSE 'TIP' END
                   AS from_timing_status,
               CASE WHEN l_linenumber = 1 THEN 'pickUp' ELSE 'pickUpAndSetDown' END AS from_activity,
               CASE WHEN quantity = 11 AND tax = 8 THEN l_linenumber ELSE l_linenumber + 1 END
                   AS to_sequence,
               {code("to_key")} AS to_stop_ref,
               CASE l_linestatus WHEN 'F' THEN 'PTP' ELSE 'OTH' END AS to_timing_status,
               CASE WHEN l_linenumber = 7 THEN 'setDown' ELSE 'pickUpAndSetDown' END AS to_activity,
               concat('RL', l_partkey) AS route_link_ref,
               CASE WHEN quantity = 7 AND tax = 8 THEN NULL
                    WHEN quantity = 8 AND tax = 8 THEN 'P1D'
                    ELSE concat('PT', minutes, 'M0S') END AS runtime_iso,
               CASE WHEN quantity IN (7, 8) AND tax = 8 THEN NULL ELSE minutes * 60 END
                   AS runtime_seconds,
               CASE WHEN quantity IN (7, 8) AND tax = 8 THEN NULL ELSE CAST(minutes AS DOUBLE) END
                   AS runtime_minutes
        FROM (SELECT * FROM lines
              UNION ALL
              SELECT * FROM lines WHERE quantity = 12 AND tax = 8) copies
        """,
    ),
    "cleaned": (
        ["raw"],
        f"""
        SELECT *,
               CASE WHEN hour BETWEEN 7 AND 9 OR hour BETWEEN 16 AND 18 THEN 1 ELSE 0 END
                   AS is_peak_hour,
               CASE WHEN hour BETWEEN 5 AND 11 THEN 'Morning'
                    WHEN hour BETWEEN 12 AND 16 THEN 'Afternoon'
                    WHEN hour BETWEEN 17 AND 21 THEN 'Evening'
                    ELSE 'Night' END AS time_of_day,
               concat_ws('_', from_stop_ref, to_stop_ref) AS segment_key
        FROM (SELECT *, TRY_CAST(split_part(departure_time, ':', 1) AS INT) % 24 AS hour
              FROM (SELECT DISTINCT * FROM raw) u
              WHERE {COMPLETE} AND runtime_seconds > 0 AND to_sequence > from_sequence
                AND from_stop_ref <> to_stop_ref) v
        """,
    ),
    "fence": (
        ["cleaned"],
        """
        SELECT quantile_disc(runtime_minutes, 0.25) AS q1,
               quantile_disc(runtime_minutes, 0.75) AS q3
        FROM cleaned
        """,
    ),
    "segments": (
        ["cleaned", "fence"],
        """
        SELECT c.* EXCLUDE (hour), hour AS departure_hour,
               CASE WHEN runtime_minutes > (SELECT q3 + 1.5 * (q3 - q1) FROM fence)
                    THEN 1 ELSE 0 END AS is_iqr_high_duration
        FROM cleaned c
        """,
    ),
    "stops": (
        [],
        f"""
        SELECT {code("s_suppkey")} AS stop_ref,
               s_name AS timetable_common_name,
               CASE WHEN s_acctbal > 9000 THEN ' ' ELSE concat('St ', s_name, '''s') END
                   AS naptan_common_name,
               r_name AS locality_name, n_name AS town,
               CASE WHEN s_acctbal >= 0 THEN CAST(50.0 AS DOUBLE) + (s_suppkey % 97) * CAST(0.0001 AS DOUBLE)
                    + CASE WHEN s_suppkey % 11 = 0 THEN CAST(0.03 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
               END AS latitude,
               CASE WHEN s_acctbal >= 0 THEN (s_suppkey % 89) * CAST(0.0001 AS DOUBLE) END AS longitude,
               CASE WHEN s_acctbal >= 0 THEN 1 ELSE 0 END AS has_coordinates,
               CASE s_nationkey % 3 WHEN 0 THEN 'BCT' WHEN 1 THEN 'BCS' ELSE 'BCE' END AS stop_type,
               CASE WHEN s_acctbal < 1000 THEN 'inactive' ELSE 'active' END AS status,
               lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS administrative_area_code,
               CASE WHEN s_suppkey < 3 THEN '' ELSE CAST(100 + s_suppkey % 7 AS VARCHAR) END
                   AS atco_area_code
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        """,
    ),
    "pairs": (
        ["stops"],
        """
        SELECT o.stop_ref AS pair_from, d.stop_ref AS pair_to,
               2 * 6371.0088 * asin(sqrt(
                   sin(radians(d.latitude - o.latitude) / 2) * sin(radians(d.latitude - o.latitude) / 2)
                   + cos(radians(o.latitude)) * cos(radians(d.latitude))
                     * sin(radians(d.longitude - o.longitude) / 2)
                     * sin(radians(d.longitude - o.longitude) / 2))) AS km
        FROM stops o, stops d
        """,
    ),
    "banded": (
        ["pairs"],
        """
        SELECT pair_from, pair_to, km AS distance_km,
               CASE WHEN km IS NULL THEN 'Missing' WHEN km = 0 THEN 'Zero'
                    WHEN km < 0.25 THEN 'Under 0.25 km' WHEN km < 0.5 THEN '0.25-0.50 km'
                    WHEN km < 1 THEN '0.50-1.00 km' WHEN km < 2 THEN '1.00-2.00 km'
                    ELSE '2.00 km or more' END AS distance_band
        FROM pairs
        """,
    ),
    "enriched": (
        ["segments", "banded", "stops"],
        """
        SELECT g.*, b.distance_km, coalesce(b.distance_band, 'Missing') AS distance_band,
               o.naptan_common_name AS origin_stop_name, o.latitude AS origin_latitude,
               o.longitude AS origin_longitude, o.stop_type AS origin_stop_type,
               d.naptan_common_name AS destination_stop_name, d.latitude AS destination_latitude,
               d.longitude AS destination_longitude, d.stop_type AS destination_stop_type
        FROM segments g
        LEFT JOIN banded b ON b.pair_from = g.from_stop_ref AND b.pair_to = g.to_stop_ref
        LEFT JOIN stops o ON o.stop_ref = g.from_stop_ref
        LEFT JOIN stops d ON d.stop_ref = g.to_stop_ref
        """,
    ),
    "predicted": (
        ["enriched"],
        """
        SELECT *, runtime_minutes AS label,
               round(avg(runtime_minutes) OVER (PARTITION BY line_ref), 6) AS prediction
        FROM enriched WHERE runtime_minutes > 0 AND distance_km > 0
        """,
    ),
    "residuals": (
        ["predicted"],
        """
        SELECT *, label - prediction AS residual_minutes,
               abs(label - prediction) AS absolute_error_minutes
        FROM predicted
        """,
    ),
    "flagged": (
        ["residuals"],
        """
        SELECT *, CASE WHEN NOT unusual THEN 'Within expected range'
                       WHEN residual_minutes > 0 THEN 'Longer than expected'
                       ELSE 'Shorter than expected' END AS anomaly_direction,
               CAST(unusual AS INT) AS is_model_anomaly
        FROM (SELECT *, absolute_error_minutes
                        > (SELECT quantile_disc(absolute_error_minutes, 0.95) FROM residuals) AS unusual
              FROM residuals) r
        """,
    ),
    "serving_stops": (
        ["stops"],
        """
        SELECT stop_ref,
               CASE WHEN trim(naptan_common_name) <> '' THEN trim(naptan_common_name)
                    WHEN trim(timetable_common_name) <> '' THEN trim(timetable_common_name)
                    ELSE 'Unknown stop' END AS stop_name,
               locality_name, town, latitude, longitude, stop_type, status,
               administrative_area_code, atco_area_code
        FROM stops
        """,
    ),
    "predictions": (
        ["flagged"],
        """
        SELECT *, runtime_minutes AS actual_runtime_minutes, prediction AS predicted_runtime_minutes
        FROM flagged
        """,
    ),
    "records": (
        ["lines"],
        f"""
        SELECT {code("l_suppkey")} AS stop_ref,
               CASE WHEN l_returnflag = 'A' THEN '' ELSE concat('Stop ', l_suppkey, ' ', l_linestatus) END
                   AS common_name,
               CASE WHEN l_linestatus = 'F' THEN '' ELSE concat('Locality ', l_suppkey % 25) END
                   AS locality_name,
               '' AS latitude, '' AS longitude, '0' AS has_coordinates,
               'annotated_reference' AS source_type,
               concat('file_', l_orderkey % 20) AS source_file,
               l_orderkey * 10 + l_linenumber AS position
        FROM lines
        UNION ALL
        SELECT {code("to_key")}, concat('Local ', to_key),
               CASE WHEN l_linestatus = 'O' THEN '' ELSE 'Depot' END,
               CASE WHEN l_returnflag = 'R' AND to_key % 5 = 0 THEN '51.5' ELSE '' END,
               CASE WHEN l_returnflag = 'R' AND to_key % 5 = 0 THEN '51.5' ELSE '' END,
               CASE WHEN l_returnflag = 'R' AND to_key % 5 = 0 THEN '1' ELSE '0' END,
               'local_definition', concat('file_', l_orderkey % 20),
               l_orderkey * 10 + l_linenumber
        FROM lines
        """,
    ),
    "scored": (
        ["records"],
        """
        SELECT *, CAST(common_name <> '' AS INT) + CAST(locality_name <> '' AS INT)
                  + CAST(latitude <> '' AS INT) + CAST(longitude <> '' AS INT) AS score
        FROM records
        """,
    ),
    "catalogue": (
        ["scored"],
        """
        SELECT * EXCLUDE (position, score) FROM scored
        QUALIFY row_number() OVER (
            PARTITION BY stop_ref
            ORDER BY score DESC, source_file, source_type, position, common_name, locality_name, latitude
        ) = 1
        """,
    ),
    "register_files": (
        [],
        f"""
        SELECT 1 AS part, c_custkey AS pos,
               CASE WHEN c_acctbal >= 0 THEN {code("c_custkey")} ELSE concat('OLDC', c_custkey) END AS code, c_name AS name,
               c_mktsegment AS locality, '' AS town,
               CASE c_mktsegment WHEN 'MACHINERY' THEN NULL WHEN 'HOUSEHOLD' THEN NULL
                                 ELSE CAST(51.25 AS DOUBLE) END AS lat,
               CAST(-0.5 AS DOUBLE) AS lon, 'BCT' AS stop_type, 'active' AS status,
               lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS area
        FROM customer
        UNION ALL
        SELECT 2, s_suppkey, CASE WHEN s_acctbal > 5000 THEN {code("s_suppkey")} ELSE concat('OLDS', s_suppkey) END, s_name, '', 'Town', 50.5, 0.0, 'BCS', 'inactive',
               lpad(CAST(s_nationkey AS VARCHAR), 3, '0')
        FROM supplier
        """,
    ),
    "matched": (
        ["register_files", "catalogue"],
        """
        SELECT code AS stop_ref, common_name AS timetable_common_name, name AS naptan_common_name,
               locality AS locality_name, town, lat AS latitude, lon AS longitude,
               CASE WHEN lat IS NULL THEN 0 ELSE 1 END AS has_coordinates,
               r.stop_type, r.status, area AS administrative_area_code,
               CASE WHEN code LIKE 'LOCAL%' THEN '' ELSE substr(code, 1, 3) END AS atco_area_code
        FROM (SELECT * FROM register_files
              QUALIFY row_number() OVER (PARTITION BY code ORDER BY part DESC, pos DESC) = 1) r
        JOIN catalogue c ON c.stop_ref = r.code
        """,
    ),
    "links": (
        ["lines"],
        f"""
        SELECT concat('file_', l_orderkey % 20) AS source_file,
               concat(CASE WHEN l_returnflag = 'N' THEN 'JM' ELSE 'JL' END, l_partkey) AS link_ref,
               l_orderkey, l_linenumber, l_suppkey, minutes, l_linestatus,
               {code("l_suppkey")} AS from_stop_ref, {code("to_key")} AS to_stop_ref,
               CASE WHEN quantity = 7 AND tax = 8 THEN ''
                    WHEN quantity = 8 AND tax = 8 THEN 'PT1H30'
                    ELSE concat('PT', minutes, 'M') END AS link_run_time
        FROM lines
        """,
    ),
    "lookup": (
        ["links"],
        """
        SELECT * FROM links
        QUALIFY row_number() OVER (
            PARTITION BY source_file, link_ref
            ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, minutes DESC, l_linestatus DESC
        ) = 1
        """,
    ),
}
