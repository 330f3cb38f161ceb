"""DuckDB twins of the registered queries, written against the same tables."""

from __future__ import annotations


def _round(expr: str, digits: int = 2) -> str:
    factor = 10**digits
    return f"(round_even(({expr})*{factor}.0::double,0)/{factor}.0::double+0.0::double)"


def _draw(key: str, salt: str) -> str:
    return f"md5({key}::varchar||':{salt}')"


def _number(key: str, salt: str) -> str:
    return f"('0x'||substr({_draw(key, salt)},1,8))::bigint"


def _weighted(key: str, salt: str, weights: dict[str, float]) -> str:
    total, reached, cases = sum(weights.values()), 0.0, []
    for label in list(weights)[:-1]:
        reached += weights[label]
        cases.append(
            f"WHEN {_number(key, salt)} < floor({reached / total!r}::double*4294967296) THEN '{label}'"
        )
    return f"CASE {' '.join(cases)} ELSE '{list(weights)[-1]}' END"


_WEIGHTS = {
    "Manhattan": 0.902, "Queens": 0.055, "Brooklyn": 0.028, "Bronx": 0.009,
    "Staten Island": 0.002, "EWR": 0.002, "Unknown": 0.002,
}
_FIVE = {k: v for k, v in _WEIGHTS.items() if k not in ("EWR", "Unknown")}
_ZONES = {"Manhattan": 69, "Queens": 69, "Brooklyn": 61, "Bronx": 43, "Staten Island": 23}
_SERVICE = {"Yellow Zone": 0.35, "Boro Zone": 0.55, "Airports": 0.08, "EWR": 0.02}

_ZONE_CTE = """zones AS (
  SELECT n_nationkey AS LocationID, nullif(r_name,'MIDDLE EAST') AS Borough, n_name AS Zone,
         'Service '||n_regionkey AS service_zone
  FROM nation LEFT JOIN region ON n_regionkey=r_regionkey)"""


def _calendar(ts: str) -> str:
    return f"""strftime({ts},'%Y-%m-%d') AS pickup_date,
  year({ts})::smallint AS pickup_year, month({ts})::tinyint AS pickup_month,
  day({ts})::tinyint AS pickup_day, hour({ts})::tinyint AS pickup_hour,
  (isodow({ts})-1)::tinyint AS pickup_dayofweek, isodow({ts}) IN (6,7) AS is_weekend"""


_RAW = f"""raw AS (
  SELECT l_linenumber AS VendorID, o_orderdate AS tpep_pickup_datetime, l_shipdate AS tpep_dropoff_datetime,
    1.0::double AS passenger_count, l_quantity AS trip_distance, l_linenumber::double AS RatecodeID,
    l_returnflag AS store_and_fwd_flag, s_nationkey AS PULocationID, c_nationkey AS DOLocationID,
    CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 9 END::bigint AS payment_type,
    l_extendedprice AS fare_amount, 0.0::double AS extra, 0.5::double AS mta_tax,
    {_round('l_extendedprice*l_tax')} AS tip_amount, 0.0::double AS tolls_amount,
    1.0::double AS improvement_surcharge, l_tax+0.0::double AS congestion_surcharge,
    l_discount+0.0::double AS airport_fee
  FROM lineitem LEFT JOIN orders ON l_orderkey=o_orderkey LEFT JOIN customer ON o_custkey=c_custkey
  LEFT JOIN supplier ON l_suppkey=s_suppkey),
priced AS (
  SELECT *, {_round('fare_amount+extra+mta_tax+tip_amount+tolls_amount+improvement_surcharge+congestion_surcharge+airport_fee')} AS total_amount,
    (epoch_us(tpep_dropoff_datetime)-epoch_us(tpep_pickup_datetime))/1000000.0::double AS sec
  FROM raw)"""

_CURATED = f"""WITH {_ZONE_CTE}, {_RAW}
SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID,
  store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount,
  tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee,
  coalesce(p.Borough,'Unknown') AS pickup_borough, p.Zone AS pickup_zone, p.service_zone AS pickup_service_zone,
  coalesce(d.Borough,'Unknown') AS dropoff_borough, d.Zone AS dropoff_zone,
  {_calendar('tpep_pickup_datetime')},
  sec AS trip_duration_sec, {_round('sec/60')} AS trip_duration_min,
  CASE WHEN sec>0 THEN {_round('trip_distance/(sec/3600)')} END AS avg_speed_mph,
  CASE WHEN fare_amount>0 THEN {_round('tip_amount/fare_amount*100')} END AS tip_pct,
  CASE WHEN trip_distance>0 THEN {_round('fare_amount/trip_distance')} END AS fare_per_mile,
  coalesce(airport_fee,0)>0 AS is_airport_trip,
  CASE payment_type WHEN 1 THEN 'credit_card' WHEN 2 THEN 'cash' WHEN 3 THEN 'no_charge'
    WHEN 4 THEN 'dispute' ELSE 'other' END AS payment_label
FROM priced LEFT JOIN zones p ON PULocationID=p.LocationID LEFT JOIN zones d ON DOLocationID=d.LocationID"""

_SKEWED = f"skewed AS (SELECT event_id, {_weighted('event_id', 'pickup', _WEIGHTS)} AS pickup_borough, value FROM events)"
_K = "regexp_extract(props,'\"k\": ([0-9]+)',1)"

# ---- the dirty table: rank rows by each class's draw, take the exact number
_RATES = {
    "null_PULocationID": 0.012, "negative_fare": 0.004, "absurd_fare": 0.001,
    "zero_passengers": 0.03, "out_of_range_date": 0.002, "negative_duration": 0.0015,
    "malformed_date_string": 0.001, "duplicate_rows": 0.02,
}


def _turned(key: str, place: int) -> str:
    """The draw of the class at ``place``: four classes share one MD5, turned by eight digits each."""
    text, at = _draw(key, f"defects{place // 4}"), 8 * (place % 4)
    return f"(substr({text},{at + 1})||substr({text},1,{at}))"


_RANKS = ",\n    ".join(
    f"row_number() OVER (ORDER BY {_turned('trip_id', i)}) AS r_{name}" for i, name in enumerate(_RATES)
)


def _hit(name: str) -> str:
    return f"r_{name} <= floor(n*{_RATES[name]!r}::double)"


_DIRTY = f"""base AS (
  SELECT event_id AS trip_id, ts AS tpep_pickup_datetime, user_id::integer AS PULocationID,
    value AS fare_amount, (event_id%6+1)::double AS passenger_count,
    strftime(ts,'%Y-%m-%d') AS pickup_date, {_K}::double*60 AS trip_duration_sec
  FROM events),
ranked AS (
  SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY trip_id) AS pos,
    {_RANKS}
  FROM base),
changed AS (
  SELECT trip_id, tpep_pickup_datetime,
    CASE WHEN {_hit('null_PULocationID')} THEN NULL ELSE PULocationID END AS PULocationID,
    CASE WHEN {_hit('absurd_fare')} THEN 99999.99::double
         WHEN {_hit('negative_fare')} THEN -abs(fare_amount)+0.0::double ELSE fare_amount END AS fare_amount,
    CASE WHEN {_hit('zero_passengers')} THEN 0.0::double ELSE passenger_count END AS passenger_count,
    CASE WHEN {_hit('malformed_date_string')} THEN '31/02/2024'
         WHEN r_out_of_range_date <= floor(floor(n*0.002::double)/2) THEN '2002-01-01'
         WHEN {_hit('out_of_range_date')} THEN '2098-06-15' ELSE pickup_date END AS pickup_date,
    CASE WHEN {_hit('negative_duration')} THEN -abs(trip_duration_sec)+0.0::double
         ELSE trip_duration_sec END AS trip_duration_sec,
    CASE WHEN pos > floor(n*0.7::double) THEN 0.75::double END AS cbd_congestion_fee,
    {_hit('duplicate_rows')} AS copied
  FROM ranked),
dirty AS (
  SELECT * EXCLUDE (copied) FROM changed
  UNION ALL SELECT * EXCLUDE (copied) FROM changed WHERE copied)"""

_BAD_DATE = "pickup_date IS NOT NULL AND try_strptime(pickup_date,'%Y-%m-%d') IS NULL"
_OUT_DATE = (
    "coalesce(try_strptime(pickup_date,'%Y-%m-%d')::date NOT BETWEEN DATE '2024-01-01' AND DATE '2026-12-31', false)"
)
_GATES = {
    "null_PULocationID": "PULocationID IS NULL",
    "fare_lt_0": "fare_amount < 0",
    "fare_gt_10000": "fare_amount > 10000",
    "passenger_count_eq_0": "passenger_count = 0",
    "duration_lt_0": "trip_duration_sec < 0",
    "date_unparseable": _BAD_DATE,
    "date_out_of_range": _OUT_DATE,
}
_ANY = " OR ".join(f"({g})" for g in _GATES.values())
_REASONS = "concat_ws(',', " + ", ".join(f"CASE WHEN {g} THEN '{n}' END" for n, g in _GATES.items()) + ")"
_MEASURED_FOR = {
    "null_PULocationID": "null_PULocationID", "negative_fare": "fare_lt_0",
    "absurd_fare": "fare_gt_10000", "zero_passengers": "passenger_count_eq_0",
    "out_of_range_date": "date_out_of_range", "negative_duration": "duration_lt_0",
    "malformed_date_string": "date_unparseable",
}
_PER_METRIC = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, (SELECT floor(count(*)*{_RATES[m]!r}::double)::bigint FROM base) AS injected, "
    f"(SELECT count(*) FROM single WHERE {_GATES[g]}) AS measured"
    for m, g in _MEASURED_FOR.items()
)
_INJECTED_SUM = "+".join(f"floor(count(*)*{_RATES[m]!r}::double)::bigint" for m in _MEASURED_FOR)

_RECONCILED = f"""WITH {_DIRTY}, single AS (SELECT DISTINCT * FROM dirty),
counts AS ({_PER_METRIC}
  UNION ALL SELECT 'duplicate_rows', (SELECT floor(count(*)*0.02::double)::bigint FROM base),
    (SELECT count(*) FROM dirty)-(SELECT count(*) FROM single)
  UNION ALL SELECT 'clean_rows', (SELECT count(*)-({_INJECTED_SUM}) FROM base),
    (SELECT count(*) FROM single WHERE NOT ({_ANY}))
  UNION ALL SELECT 'total_rows', (SELECT count(*)+floor(count(*)*0.02::double)::bigint FROM base),
    (SELECT count(*) FROM dirty))"""

_MANIFEST = (
    _RECONCILED
    + ", m AS ("
    + " UNION ALL ".join(
        [
            f"SELECT 'injected.{m}' AS metric, floor(count(*)*{r!r}::double)::bigint AS value, NULL::varchar AS detail FROM base"
            for m, r in _RATES.items()
        ]
        + ["SELECT 'measured.total_rows', count(*), NULL FROM dirty"]
        + [
            f"SELECT 'measured.{g}', count(*) FILTER (WHERE {_GATES[g]}), NULL FROM dirty"
            for g in ("null_PULocationID", "fare_lt_0", "fare_gt_10000", "passenger_count_eq_0", "duration_lt_0")
        ]
        + [
            "SELECT 'measured.unparseable_or_out_of_range_date', "
            "count(*) FILTER (WHERE NOT coalesce(regexp_matches(pickup_date,'^202[4-6]-'),false)), NULL FROM dirty",
            "SELECT 'measured.exact_duplicates', (SELECT count(*) FROM dirty)-(SELECT count(*) FROM single), NULL",
            "SELECT 'injected.schema_drift_column', NULL, 'cbd_congestion_fee is null for the first 70% of rows'",
            "SELECT 'clean_rows_expected', injected, 'a lower bound, classes overlap; exact '||measured "
            "FROM counts WHERE metric='clean_rows'",
        ]
    )
    + ") SELECT metric, value, detail FROM m"
)

def _histogram(rows: str) -> str:
    """Bins by comparing every value with the bin's own edges."""
    return f"""WITH {rows}, e AS (
  SELECT min(x) AS lo, max(x) AS hi, CASE WHEN max(x)=min(x) THEN 1.0::double ELSE (max(x)-min(x))/10 END AS w FROM v),
b AS (SELECT i::integer AS bin, lo+i*w AS from_value, lo+(i+1)*w AS to_value, hi FROM e, range(0,10) t(i))
SELECT bin, from_value, to_value,
  count(x) FILTER (WHERE x >= from_value AND x < to_value OR (bin=9 AND x=hi)) AS n
FROM b LEFT JOIN v ON true GROUP BY ALL"""


def _by_nation() -> str:
    return """SELECT s_nationkey, count(*) AS trips, sum(l_quantity::bigint)::bigint AS quantity
FROM lineitem LEFT JOIN supplier ON l_suppkey=s_suppkey GROUP BY 1"""


_SKEW_JOIN = """SELECT source, first_source, count(*) AS documents, sum(n_chars)::bigint AS chars
FROM documents LEFT JOIN (SELECT lang, min(source) AS first_source FROM documents GROUP BY 1) USING (lang) GROUP BY ALL"""

_LAYOUTS = "(VALUES ('csv'),('json'),('flat'),('partitioned'),('small')) l(layout)"

# The columns of the tables, with how their values are written as text.
_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal:number c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal:number",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice:number",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice:number o_orderdate:time o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity:number l_extendedprice:number"
    " l_discount:number l_tax:number l_returnflag l_linestatus l_shipdate:time",
    "events": "event_id ts:time user_id event_type value:number props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding:numbers label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}
_AS_TEXT = {
    "": "{}::varchar",
    "number": "{}::double::decimal(38,6)::varchar",
    "time": "epoch_us({})::varchar",
    "numbers": "array_to_string(list_transform({}, lambda x: coalesce('V'||strlen(x::double::decimal(38,6)::varchar)"
    "||':'||x::double::decimal(38,6)::varchar, 'N')), ',')",
}


def _fingerprint(name: str) -> str:
    """The table's rows as text, their MD5 in four numbers, and the sums of these."""
    parts = []
    for column in sorted(_COLUMNS[name].split()):
        column, _, kind = column.partition(":")
        text = _AS_TEXT[kind].format(f'"{column}"')
        parts.append(f"'{column}=' || coalesce('V'||strlen({text})||':'||{text}, 'N')")
    sums = " || ':' || ".join(
        f"coalesce(sum(('0x'||substr(h,{1 + 8 * i},8))::bigint), 0)::varchar" for i in range(4)
    )
    return (
        f"SELECT '{name}' AS source, count(*) AS rows, {sums} AS content "
        f"FROM (SELECT md5({" || ';' || ".join(parts)}) AS h FROM {name})"
    )


def _dimension(name: str, key: str) -> str:
    return f"""SELECT '{name}.{key}' AS dimension, coalesce(sum(n),0)::bigint AS row_count, count({key}) AS key_count,
  coalesce(sum(n) FILTER (WHERE {key} IS NULL),0)::bigint AS missing_keys,
  count(*) FILTER (WHERE n>1 AND {key} IS NOT NULL) AS repeated_keys,
  coalesce(sum(n),0) > 100 AND count(*) FILTER (WHERE {key} IS NULL OR n>1) = 0 AS accepted
FROM (SELECT {key}, count(*) AS n FROM {name} GROUP BY 1)"""


ORACLE: dict[str, str] = {
    "key_share": f"""WITH {_ZONE_CTE}
SELECT coalesce(Borough,'Unknown') AS pickup_borough, count(*) AS trips,
  count(*)/(SELECT count(*) FROM lineitem) AS share,
  count(*)/(SELECT count(*) FROM lineitem) >= 0.5 AS dominates,
  sum(round_even(l_extendedprice*100,0)::bigint)::bigint/100.0::double/count(*) AS avg_fare,
  sum(l_quantity::bigint)::bigint/count(*) AS avg_distance
FROM lineitem LEFT JOIN supplier ON l_suppkey=s_suppkey LEFT JOIN zones ON s_nationkey=LocationID
GROUP BY 1 ORDER BY share DESC, pickup_borough""",
    "curate_wide": _CURATED,
    "dominant_key": """SELECT lang, count(*) AS n, count(*)/(SELECT count(lang) FROM documents) AS share,
  count(*)/(SELECT count(lang) FROM documents) >= 0.5 AS dominates
FROM documents WHERE lang IS NOT NULL GROUP BY 1 ORDER BY n DESC, lang LIMIT 1""",
    "distinct_values": "SELECT DISTINCT p_type FROM part ORDER BY p_type",
    "bucket_groups": "SELECT count(DISTINCT o_orderkey%97) AS groups FROM orders",
    "bucket_counts": "SELECT o_orderkey%97 AS k, count(*) AS n FROM orders GROUP BY 1",
    "date_parts": f"""SELECT event_id, {_calendar('ts')},
  ts+to_seconds({_K}::integer) AS dropoff, {_K}::double AS trip_duration_sec,
  (epoch_us(date_trunc('day',ts)::timestamp)-epoch_us(ts))/1000000.0::double AS seconds_to_midnight
FROM events""",
    "guarded_ratios": f"""SELECT l_orderkey, l_linenumber, l_extendedprice, sec AS duration_sec,
  {_round('sec/60')} AS duration_min,
  CASE WHEN sec>0 THEN {_round('l_quantity/(sec/3600)')} END AS speed,
  CASE WHEN l_discount>0 THEN {_round('l_tax/l_discount*100')} END AS tip_pct,
  CASE WHEN l_quantity>0 THEN {_round('l_extendedprice/l_quantity')} END AS fare_per_unit
FROM (SELECT *, (epoch_us(l_shipdate)-epoch_us(o_orderdate))/1000000.0::double AS sec
      FROM lineitem JOIN orders ON l_orderkey=o_orderkey)""",
    "charge_total": f"""SELECT l_orderkey, l_linenumber, l_extendedprice AS fare_amount,
  {_round('l_extendedprice+l_quantity+0.5::double+l_extendedprice*l_tax+6.94::double+1.0::double+(l_tax+0.0::double)+(l_discount+0.0::double)')} AS total_amount,
  {_round('greatest(0.0::double, l_extendedprice-50000)')} AS above_50000,
  -abs(l_extendedprice)+0.0::double AS negated
FROM lineitem""",
    "label_codes": """SELECT o_orderkey,
  CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'credit_card' WHEN '2' THEN 'cash'
    WHEN '3' THEN 'no_charge' ELSE 'other' END AS payment_label,
  CASE o_orderstatus WHEN 'P' THEN 'Unknown' ELSE o_orderstatus END AS status
FROM orders""",
    "string_parts": """SELECT page_id, format('Zone {:03d}', page_id) AS zone,
  split_part(url,'?',1) AS address, substr(split_part(html, chr(10), 1),1,80) AS head FROM pages""",
    "schema_normalise": """SELECT c_custkey, c_name, c_nationkey, 1.5::double AS c_acctbal, 'N' AS c_mktsegment
FROM customer""",
    "join_broadcast": _by_nation(),
    "join_hash": _by_nation().replace("LEFT JOIN", "JOIN"),
    "join_merge": _by_nation(),
    "join_skew_aqe": _SKEW_JOIN,
    "join_skew_salted": _SKEW_JOIN,
    "key_sample": f"""SELECT * EXCLUDE (r) FROM (
  SELECT *, row_number() OVER (ORDER BY {_draw('event_id', 'sample')}) AS r FROM events)
WHERE r <= (SELECT floor(count(*)*0.02::double) FROM events)""",
    "weighted_key": f"""WITH {_SKEWED}
SELECT pickup_borough, count(*) AS n, count(*)/(SELECT count(*) FROM events) AS share FROM skewed GROUP BY 1""",
    "slice_rows": """SELECT * EXCLUDE (r, n) FROM (
  SELECT *, row_number() OVER (ORDER BY event_id)-1 AS r, count(*) OVER () AS n FROM events)
WHERE r >= floor(n/4) AND r < floor(n/2)""",
    "head_rows": """SELECT * EXCLUDE (r, n) FROM (
  SELECT *, row_number() OVER (ORDER BY o_orderkey) AS r, count(*) OVER () AS n FROM orders)
WHERE r <= floor(n*0.3::double)""",
    "replicate_rows": """WITH t AS (
  SELECT event_id, event_type, value, row_number() OVER (ORDER BY event_id) AS r, count(*) OVER () AS n FROM events)
SELECT event_id, event_type, value, c AS copy FROM (
  SELECT *, unnest(range(0, (floor(n*2.5)//n)::bigint + CASE WHEN r <= floor(n*2.5)::bigint % n THEN 1 ELSE 0 END)) AS c FROM t)""",
    "union_drift": """SELECT event_id, ts, value,
  CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN 0.75::double END AS cbd_congestion_fee FROM events""",
    "exact_duplicates": f"""WITH {_DIRTY}
SELECT 'documents' AS source, sum(n)::bigint AS rows, count(*) AS distinct_rows, sum(n-1)::bigint AS duplicates
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)
UNION ALL SELECT 'texts', sum(n)::bigint, count(*), sum(n-1)::bigint FROM (SELECT count(*) AS n FROM documents GROUP BY text)
UNION ALL SELECT 'dirty_events', (SELECT count(*) FROM dirty), count(*), (SELECT count(*) FROM dirty)-count(*)
FROM (SELECT DISTINCT * FROM dirty)""",
    "dedup": f"WITH {_DIRTY} SELECT DISTINCT * FROM dirty",
    "dirty_events": f"WITH {_DIRTY} SELECT * FROM dirty",
    "gate_counts": f"""WITH {_DIRTY} SELECT count(*) AS total_rows,
  count(*) FILTER (WHERE PULocationID IS NULL) AS null_PULocationID,
  count(*) FILTER (WHERE fare_amount < 0) AS fare_lt_0,
  count(*) FILTER (WHERE fare_amount > 10000) AS fare_gt_10000,
  count(*) FILTER (WHERE passenger_count = 0) AS passenger_count_eq_0,
  count(*) FILTER (WHERE trip_duration_sec < 0) AS duration_lt_0,
  count(*) FILTER (WHERE NOT coalesce(regexp_matches(pickup_date,'^202[4-6]-'),false)) AS unparseable_or_out_of_range_date
FROM dirty""",
    "gate_split": f"""WITH {_DIRTY} SELECT trip_id, pickup_date, {_REASONS} AS reasons, NOT ({_ANY}) AS is_clean FROM dirty""",
    "defect_reconcile": f"""{_RECONCILED}
SELECT metric, injected, measured, measured-injected AS difference,
  CASE WHEN measured=injected THEN 'equal' WHEN measured<injected THEN 'fewer' ELSE 'more' END AS verdict FROM counts""",
    "defect_manifest": _MANIFEST,
    "drift_profile": f"""WITH {_DIRTY} SELECT strftime(tpep_pickup_datetime,'%Y-%m-%d') AS day, count(*) AS n,
  count(*)-count(cbd_congestion_fee) AS nulls, (count(*)-count(cbd_congestion_fee))/count(*) AS null_rate
FROM dirty GROUP BY 1""",
    "histogram": _histogram("v AS (SELECT value AS x FROM events)"),
    "stage_stats": f"""SELECT event_type, tasks, {_round('med')} AS median_s, {_round('mx')} AS max_s,
  {_round('ms/1000', 1)} AS total_s, {_round('mx/med', 1)} AS skew_ratio, {_round('mx/med', 1)}>=3 AS straggler
FROM (SELECT event_type, count(*) AS tasks, median(value) AS med, max(value) AS mx,
        sum(round_even(value*1000,0)::bigint)::bigint AS ms FROM events GROUP BY 1)""",
    "nested_fields": f"""SELECT event_id, coalesce(json_extract(props,'$.k')::bigint,0) AS k, 0::bigint AS net_bytes,
  value/1000 AS seconds, coalesce(json_extract(props,'$.k')::bigint,0)/1048576.0::double AS megabytes
FROM events WHERE event_type='click'""",
    "sane_intervals": """SELECT l_orderkey, l_linenumber, o_orderstatus <> 'P' AND l_shipdate >= o_orderdate AS sane,
  CASE WHEN o_orderstatus <> 'P' AND l_shipdate >= o_orderdate
       THEN (epoch_us(l_shipdate)-epoch_us(o_orderdate))/1000000.0::double END AS seconds
FROM lineitem JOIN orders ON l_orderkey=o_orderkey""",
    "dimension_gate": " UNION ALL ".join(
        _dimension(*x)
        for x in (
            ("nation", "n_nationkey"), ("customer", "c_custkey"), ("customer", "c_nationkey"),
            ("part", "p_partkey"), ("pages", "page_id"), ("labels", "doc_id"), ("lineitem", "l_orderkey"),
        )
    ),
    "report_totals": f"""SELECT count(*) AS stages, sum(tasks)::bigint AS tasks, max({_round('mx')}) AS longest_s,
  coalesce(max({_round('mx/med', 1)}),0.0::double) AS max_skew, count(*) FILTER (WHERE {_round('mx/med', 1)} >= 3) AS stragglers
FROM (SELECT event_type, count(*) AS tasks, median(value) AS med, max(value) AS mx FROM events GROUP BY 1)""",
    "fingerprint": " UNION ALL ".join(_fingerprint(name) for name in _COLUMNS),
    "text_roundtrip": """SELECT doc_id AS id, ' '||text AS body, nullif(lang,'de') AS lang,
  CASE source WHEN 'src1' THEN 'NA' ELSE source END AS place, l.layout
FROM documents, (VALUES ('documents csv'),('documents json')) l(layout)
UNION ALL SELECT page_id, html, '', url, l.layout FROM pages, (VALUES ('pages csv'),('pages json')) l(layout)""",
    "layout_sizes": """SELECT l.layout, l.files::bigint AS files, true AS has_bytes
FROM (VALUES ('csv',3),('json',4),('flat',5),('small',50)) l(layout, files)""",
    "append_days": """SELECT event_id, value, strftime(ts,'%Y-%m-%d') AS pickup_date, d.delivery
FROM events, (VALUES (1),(2)) d(delivery)""",
    "skip_if_built": """SELECT o_orderkey, o_totalprice, 'skipped' AS build FROM orders
UNION ALL SELECT o_orderkey, o_totalprice+1, 'forced' FROM orders""",
    "replicate_csv": """WITH e AS (
  SELECT event_id, event_type, row_number() OVER (ORDER BY event_id) AS r, count(*) OVER () AS n FROM events),
size AS (SELECT sum(strlen(event_id::varchar)+strlen(event_type)+2)::double AS total, count(*) AS n FROM events),
goal AS (SELECT ceil(floor(total/n*n*2.5::double)/(total/n))::bigint AS goal FROM size)
SELECT event_id, event_type, c AS copy FROM (
  SELECT e.*, unnest(range(0, goal//n + CASE WHEN r <= goal % n THEN 1 ELSE 0 END)) AS c FROM e, goal)""",
    "layout_roundtrip": f"SELECT *, strftime(ts,'%Y-%m-%d') AS pickup_date FROM events, {_LAYOUTS}",
    "layout_fingerprints": f"SELECT layout, count(*) AS rows, true AS same_content FROM events, {_LAYOUTS} GROUP BY 1",
    "partition_prune": """SELECT layout, event_type, count(*) AS n, sum(round_even(value*100,0)::bigint)::bigint AS value_cents
FROM events, (VALUES ('partitioned'),('flat')) l(layout) WHERE strftime(ts,'%Y-%m-%d')='2024-01-10' GROUP BY 1,2""",
    "column_prune": f"""WITH {_ZONE_CTE}
SELECT coalesce(Borough,'Unknown') AS pickup_borough, count(*) AS n, count(*)/(SELECT count(*) FROM lineitem) AS share
FROM lineitem LEFT JOIN supplier ON l_suppkey=s_suppkey LEFT JOIN zones ON s_nationkey=LocationID GROUP BY 1""",
    "compact_files": "SELECT * FROM events",
    "idempotent_day": """SELECT event_id, strftime(ts,'%Y-%m-%d') AS pickup_date,
  CASE WHEN strftime(ts,'%Y-%m-%d')='2024-01-02' THEN value+1 ELSE value END AS value FROM events""",
    "artifact_check": """WITH daily AS (
  SELECT CASE WHEN event_id % 10 = 3 THEN '31/02/2024' ELSE strftime(ts,'%Y-%m-%d') END AS pickup_date, value FROM events)
SELECT DISTINCT pickup_date FROM daily EXCEPT SELECT pickup_date FROM daily WHERE value > 300""",
    "dataset_floor": """SELECT count(*) AS row_count, count(DISTINCT date_trunc('month',l_shipdate)) AS month_count,
  count(*) >= 40000000 AS rows_ok, count(DISTINCT date_trunc('month',l_shipdate)) >= 6 AS months_ok,
  sum(72+strlen(l_returnflag)+strlen(l_linestatus))::bigint AS raw_bytes,
  sum(72+strlen(l_returnflag)+strlen(l_linestatus)) >= 3000000000 AS bytes_ok FROM lineitem""",
    "keyed_redelivery": """WITH days AS (SELECT event_id, value, strftime(ts,'%Y-%m-%d') AS pickup_date FROM events),
again AS (SELECT * FROM days WHERE pickup_date IN ('2024-01-02','2024-01-10'))
SELECT event_id, CASE WHEN event_id % 10 = 3 AND pickup_date IN ('2024-01-02','2024-01-10') THEN value+1 ELSE value END AS value,
  pickup_date FROM days WHERE NOT (event_id % 10 = 4 AND pickup_date IN ('2024-01-02','2024-01-10'))
UNION ALL SELECT event_id+1000000000, value, pickup_date FROM again WHERE event_id % 50 = 0""",
    "compact_table": "SELECT * FROM events",
    "schema_versions": """SELECT event_id, user_id, CASE WHEN day < '2024-01-10' THEN value::float::double ELSE value END AS value, day,
  CASE WHEN day >= '2024-01-20' THEN 'c'||(user_id % 5) END AS channel
FROM (SELECT *, strftime(ts,'%Y-%m-%d') AS day FROM events)""",
    "schema_history": """WITH e AS (SELECT strftime(ts,'%Y-%m-%d') AS day FROM events)
SELECT v.name, v.kind, count(*) AS rows FROM e JOIN (VALUES
  ('event_id','bigint','2024-01-01','2024-01-31'), ('day','string','2024-01-01','2024-01-31'),
  ('user_id','int','2024-01-01','2024-01-09'), ('user_id','bigint','2024-01-10','2024-01-31'),
  ('value','float','2024-01-01','2024-01-09'), ('value','double','2024-01-10','2024-01-31'),
  ('channel','string','2024-01-20','2024-01-31')) v(name, kind, since, till) ON day BETWEEN since AND till
GROUP BY 1,2""",
    "clustered_read": """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_extendedprice, t.layout, t.layout='clustered' AS fewer_groups
FROM lineitem, (VALUES ('clustered'),('flat')) t(layout)
WHERE (l_shipdate BETWEEN '1996-01-01' AND '1996-03-31' AND l_quantity BETWEEN 5 AND 9)
   OR (l_shipdate BETWEEN '2000-01-01' AND '2000-03-31' AND l_quantity BETWEEN 30 AND 33)""",
    "layout_difference": """WITH flat AS (SELECT *, strftime(ts,'%Y-%m-%d') AS pickup_date FROM events),
copy AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN value+1 ELSE value END AS value) FROM flat WHERE event_id % 101 <> 0
  UNION ALL SELECT * FROM flat WHERE event_id % 103 = 0)
SELECT *, 'left' AS side, count(*) AS times FROM (SELECT * FROM flat EXCEPT ALL SELECT * FROM copy) GROUP BY ALL
UNION ALL SELECT *, 'right', count(*) FROM (SELECT * FROM copy EXCEPT ALL SELECT * FROM flat) GROUP BY ALL""",
    "hot_key_sketch": """WITH line AS (SELECT CASE WHEN l_orderkey % 5 = 0 THEN -1 WHEN l_orderkey % 7 = 0 THEN -2
    WHEN l_orderkey % 40 = 3 THEN -(l_orderkey % 3)-3 ELSE l_orderkey*10+l_linenumber END AS key FROM lineitem)
SELECT key, count(*) AS n, count(*)/(SELECT count(*) FROM line) AS share FROM line GROUP BY 1
HAVING count(*)/(SELECT count(*) FROM line) >= 0.005""",
    "weighted_sample": """SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 0
QUALIFY row_number() OVER (ORDER BY -ln((('0x'||substr(md5(o_orderkey::varchar||':race'),1,13))::bigint+1)/4503599627370496.0::double)
  / o_totalprice) <= (SELECT count(*) FROM orders WHERE o_totalprice > 0) // 20""",
    "drift_points": """SELECT c AS "column", d AS day, k AS kind FROM (VALUES ('appears','2024-01-12','appeared'),
  ('vanishes','2024-01-20','vanished'),('twice','2024-01-08','drifted'),('twice','2024-01-23','drifted')) v(c,d,k)
WHERE (SELECT count(DISTINCT ts::date) FROM events) > 0""",
    "strongest_drift": """WITH e AS (SELECT strftime(ts,'%Y-%m-%d') AS day, event_id, value, user_id,
    CASE WHEN event_type='click' THEN strftime(ts,'%Y-%m-%d') >= '2024-01-15' ELSE strftime(ts,'%Y-%m-%d') >= '2024-01-09' END AS late FROM events),
per AS (SELECT 'value' AS "column", day, count(*) AS n, count(*) FILTER (NOT (late OR event_id % 7 = 0) OR value IS NULL) AS missing FROM e GROUP BY day
  UNION ALL SELECT 'user_id', day, count(*), count(*) FILTER (NOT (NOT late OR event_id % 3 = 0) OR user_id IS NULL) FROM e GROUP BY day),
cuts AS (SELECT "column", day,
    (sum(n) OVER ahead)::double AS n1, (sum(missing) OVER ahead)::double AS m1,
    (sum(n) OVER (PARTITION BY "column"))::double AS n, (sum(missing) OVER (PARTITION BY "column"))::double AS m
  FROM per WINDOW ahead AS (PARTITION BY "column" ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
scored AS (SELECT "column", day, m1/n1 AS share_before, (m-m1)/(n-n1) AS share_after,
    CASE WHEN n1*(n-n1)*(m*(n-m)) > 0 THEN (m1*(n-n1)-(m-m1)*n1)/(n1*(n-n1)*(m*(n-m)))*(m1*(n-n1)-(m-m1)*n1)*n ELSE 0.0 END AS score
  FROM cuts WHERE n1 IS NOT NULL)
SELECT * FROM scored WHERE score >= 20 AND abs(share_after-share_before) >= 0.1
QUALIFY row_number() OVER (PARTITION BY "column" ORDER BY score DESC, day) = 1""",
    "quarantine_lines": """WITH e AS (SELECT event_id, event_type, user_id, '{"event_id":'||event_id||',"event_type":"'||event_type||
    '","user_id":'||CASE WHEN event_id % 50 = 9 THEN '"many"' ELSE user_id::varchar END||'}' AS row FROM events)
SELECT event_id, event_type, user_id, NULL::varchar AS line, NULL::varchar AS reason FROM e WHERE event_id % 50 NOT IN (7,9,11,13,15)
UNION ALL SELECT NULL, NULL, NULL,
  CASE event_id % 50 WHEN 7 THEN substr(row,1,length(row)-4) WHEN 11 THEN '' WHEN 13 THEN '[1, 2]'
    WHEN 15 THEN replace(row,'"event_id"','"id"') ELSE row END,
  CASE event_id % 50 WHEN 7 THEN 'not JSON' WHEN 9 THEN 'type of user_id' WHEN 11 THEN 'blank' WHEN 13 THEN 'not an object' ELSE 'no event_id' END
FROM e WHERE event_id % 50 IN (7,9,11,13,15)""",
    "quoted_csv_split": "SELECT page_id, url, html FROM pages",
    "csv_null_tokens": """SELECT c_custkey, nullif(nullif(c_mktsegment,'FURNITURE'),'MACHINERY') AS c_mktsegment,
  nullif(c_nationkey,7) AS c_nationkey FROM customer""",
}
