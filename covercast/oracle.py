"""The registered queries once more, as plain DuckDB SQL over the raw tables.

Written the direct way (inequality joins, full cross products, a turn-by-turn
seating simulation), so that agreement with the Spark plans means something.
"""

from __future__ import annotations

from covercast.operators.evaluate import CORRECT
from covercast.sources.benchmark import durations_sql, pacing_sql

AS_OF = "DATE '2001-01-01'"
NOW = "TIMESTAMP '2001-01-01 12:00:00'"

_SHIFT = "(['lunch', 'brunch', 'dinner'])[{0} + 1]"
_NAME = "(['Lunch', 'Brunch', 'Dinner'])[{0} + 1]"
_START = "([660, 600, 1080])[{0} + 1]"
_END = "([900, 870, 60])[{0} + 1]"

# --- the six source tables ----------------------------------------------------

_SOURCES = f"""
coded AS (
  SELECT l_suppkey // 5 AS venue, l_linenumber % 3 AS shift,
         date_diff('day', DATE '1995-01-02', CAST(l_shipdate AS DATE)) // 7 AS week,
         l_orderkey AS o, l_partkey AS p, l_linenumber AS n, l_returnflag AS flag,
         CAST(l_quantity AS INTEGER) AS quantity
  FROM lineitem),
placed AS (
  SELECT *,
         CASE WHEN o % 50 = 7 THEN DATE '1999-07-05' + CAST(week % 4 * 7 AS INTEGER)
              WHEN o % 50 = 8 THEN DATE '1998-06-01' + CAST(week % 2 * 7 AS INTEGER)
              ELSE DATE '2000-07-03' + CAST(week % 34 * 7 AS INTEGER) END
           + CAST((venue + shift // 2 + CASE WHEN o % 3 = 0 THEN 3 ELSE 0 END) % 7 AS INTEGER) AS service,
         CASE WHEN p % 97 = 1 THEN 380 WHEN p % 83 = 5 THEN -1
              WHEN p % 10 = 0 THEN (p * 7 + n * 3) % 30 + 30 * (o % 5)
              ELSE (p * 7 + n * 3) % 30 END AS lead_days
  FROM coded),
reservation AS (
  SELECT venue AS venue_key_id, {_SHIFT.format('shift')} AS shift_persistent_id,
         CASE WHEN o % 97 <> 0 THEN CAST(service AS TIMESTAMP)
              + to_minutes(CAST({_START.format('shift')} + (o % 9) * (30 + 30 * (shift // 2)) AS INTEGER)) END AS marked_time,
         service AS date,
         CASE WHEN o % 89 <> 0 THEN CAST(service - CAST(lead_days AS INTEGER) AS TIMESTAMP)
              + to_minutes(CAST(o % 1440 AS INTEGER)) END AS created,
         CASE WHEN p % 101 <> 0 THEN CASE flag WHEN 'R' THEN 'CANCELED' WHEN 'A' THEN 'COMPLETE'
              ELSE 'CONFIRMED' END END AS status,
         CASE WHEN p % 61 <> 3 AND (venue + week % 34) % 23 <> 5 THEN CAST(1 + quantity % 8 AS INTEGER) END AS max_guests
  FROM placed),
template AS (
  SELECT venue, t, t % 3 AS shift, t // 3 AS version, category,
         (venue + (t % 3) // 2) % 7 AS wd1,
         CASE WHEN venue % 2 = 0 THEN (venue + (t % 3) // 2 + 3) % 7 END AS wd2,
         ([DATE '1999-07-05', DATE '2000-07-03', DATE '2000-10-02', DATE '2000-10-02', DATE '1998-06-01'])[t // 3 + 1] AS opens
  FROM (SELECT p_partkey // 100 AS venue, (p_partkey % 100) % 15 AS t, min(p_type) AS category
        FROM part GROUP BY 1, 2)),
shift_default AS (
  SELECT venue * 100 + t AS int_id, venue AS venue_key_id, {_SHIFT.format('shift')} AS persistent_id,
         {_NAME.format('shift')} || ' v' || version AS name, category,
         opens AS effective_start_date,
         CASE version WHEN 0 THEN DATE '1999-08-01' WHEN 1 THEN DATE '2000-10-01'
              WHEN 2 THEN CASE WHEN venue % 2 = 0 THEN DATE '2001-02-25' END
              WHEN 4 THEN DATE '1998-06-14' END AS effective_end_date,
         CASE WHEN venue % 10 = 9 THEN mask[1:5]
              WHEN venue % 4 = 1 THEN list_transform(mask, lambda x: nullif(x, false)) ELSE mask END AS day_of_week,
         CASE WHEN venue % 3 = 2 THEN NULL
              WHEN venue % 3 = 1 THEN [opens + CAST(wd1 AS INTEGER), NULL, opens + CAST(wd1 + 21 AS INTEGER)]
              ELSE [opens + CAST(wd1 AS INTEGER), opens + CAST(wd1 + 21 AS INTEGER)] END AS excluded_dates,
         CASE WHEN version = 3 AND venue % 2 = 0 THEN TIMESTAMP '2000-11-01' END AS archived,
         CASE WHEN version = 3 AND venue % 2 = 1 THEN TIMESTAMP '2000-11-01' END AS deleted
  FROM (SELECT *, list_transform(range(7), lambda i: i = wd1 OR (wd2 IS NOT NULL AND i = wd2)) AS mask FROM template)),
special AS (SELECT s_suppkey // 5 AS venue, (s_suppkey % 5) % 3 AS j FROM supplier),
shift_override AS (
  SELECT DATE '2000-10-05' + CAST((venue * 11 + j * 17) % 120 AS INTEGER) AS date,
         1000000000 + venue * 10 + j AS int_id, venue AS venue_key_id,
         CASE WHEN j = 1 THEN 'HOLIDAY' ELSE 'EVENT' END AS category,
         CASE WHEN venue % 7 = 4 AND j = 2 THEN TIMESTAMP '2000-09-01' END AS deleted
  FROM special),
venue AS (SELECT s_suppkey // 5 AS id, min(s_name) AS name FROM supplier GROUP BY 1),
tables AS (
  SELECT *, t % 3 AS shift, t // 3 AS version
  FROM (SELECT p_size AS size, p_partkey // 100 AS venue, (p_partkey % 100) % 15 AS t FROM part)),
shift_denorm AS (
  SELECT venue * 100 + t AS int_id, venue AS venue_key_id, {_SHIFT.format('shift')} AS persistent_id,
         {_NAME.format('shift')} || ' v' || version AS name,
         CASE WHEN t = 12 AND venue % 4 = 3 THEN NULL ELSE ([15, 30, 60])[(venue + t) % 3 + 1] END AS interval_minutes,
         TIMESTAMP '1900-01-01' + to_minutes({_START.format('shift')}) AS start_time,
         TIMESTAMP '1900-01-01' + to_minutes({_END.format('shift')}) AS end_time,
         CASE WHEN size < 50 THEN ([2, 4, 6, 8, 10, 12])[size % 6 + 1] END AS table_size,
         {pacing_sql('(venue * 7 + t) % 8')} AS custom_pacing_str,
         CASE WHEN (venue + t) % 11 <> 10 THEN CAST(2 + (venue + t) % 5 AS INTEGER) END AS covers_per_seating_interval,
         CASE WHEN t = 13 AND venue % 4 = 2 THEN NULL ELSE {_START.format('shift')} END AS shift_start_time_min,
         {_END.format('shift')} AS shift_end_time_min,
         {durations_sql('(venue * 5 + t * 3) % 16', '(45 + (venue + t) % 40)')} AS duration_dict_ranges_str
  FROM tables
  UNION ALL
  SELECT 1000000000 + venue * 10 + j, venue, {_SHIFT.format('j')}, {_NAME.format('j')} || ' special',
         ([15, 30, 60])[j + 1],
         TIMESTAMP '1900-01-01' + to_minutes({_START.format('j')}),
         TIMESTAMP '1900-01-01' + to_minutes({_END.format('j')}),
         size, '{{}}', CAST(3 + j AS INTEGER), {_START.format('j')}, {_END.format('j')},
         {durations_sql('0', '(60 + j * 5)')}
  FROM special, (SELECT unnest([2, 4, 8, 12]) AS size)),
active AS (SELECT * FROM reservation WHERE status NOT IN ('CANCELED'))"""

# --- seating: one turn after the other -----------------------------------------

_SEATING = """
seat_case AS (
  SELECT row_number() OVER () AS c, *
  FROM (SELECT DISTINCT duration_dict_ranges_str AS doc, table_size AS size,
               shift_start_time_min AS s, shift_end_time_min AS raw_e FROM shift_denorm)),
seat_key AS (
  SELECT c, doc, size, s, CASE WHEN raw_e < s THEN raw_e + 1440 ELSE raw_e END AS e,
         unnest(json_keys(doc)) AS k, generate_subscripts(json_keys(doc), 1) AS i, len(json_keys(doc)) AS n
  FROM seat_case WHERE CASE WHEN json_valid(doc) THEN json_type(doc) = 'OBJECT' ELSE false END),
seat_open AS (
  SELECT *, CAST(split_part(k, ':', 1) AS INTEGER) * 60 + CAST(split_part(k, ':', 2) AS INTEGER) AS opens,
         json_extract(doc, '$."' || k || '"') AS sizes, CAST(least(size, 9) AS VARCHAR) AS sz
  FROM seat_key),
seat_close AS (
  SELECT *, CASE WHEN i = n THEN e ELSE lead(opens) OVER (PARTITION BY c ORDER BY i) END AS raw_closes FROM seat_open),
seat_range AS (
  SELECT *, CASE WHEN raw_closes < opens THEN raw_closes + 1440 ELSE raw_closes END AS closes,
         list_contains(json_keys(sizes), sz) AS listed,
         TRY_CAST(json_extract_string(sizes, '$."' || sz || '"') AS DOUBLE) AS turn
  FROM seat_close),
seat_plan AS (
  SELECT c, any_value(s) AS s, any_value(e) AS e, any_value(size) AS size, any_value(n) AS n,
         list(opens ORDER BY i) AS opens, list(closes ORDER BY i) AS closes, list(turn ORDER BY i) AS turn,
         list(coalesce(NOT (s >= closes), true) AND coalesce(NOT (e <= opens), true) ORDER BY i) AS reached,
         bool_or(coalesce(NOT (s >= closes), true) AND coalesce(NOT (e <= opens), true)
                 AND listed AND (turn IS NULL OR turn < 1)) AS failed
  FROM seat_range GROUP BY c),
seat_step AS (
  SELECT c, 1 AS i, CAST(s AS DOUBLE) AS seen, CASE WHEN s IS NOT NULL THEN CAST(greatest(s, opens[1]) AS DOUBLE) END AS pos, 0 AS guests
  FROM seat_plan WHERE NOT failed
  UNION ALL
  SELECT c, i, seen, pos, guests FROM (
    SELECT q.c, q.seating, q.n,
           CASE WHEN q.seating THEN q.i ELSE q.i + 1 END AS i,
           q.seen2 AS seen,
           CASE WHEN q.seating THEN q.pos + q.turn[q.i]
                WHEN q.seen2 IS NOT NULL THEN greatest(q.seen2, q.opens[q.i + 1]) END AS pos,
           q.guests + CASE WHEN q.seating THEN q.size ELSE 0 END AS guests
    FROM (SELECT x.*, p.n, p.opens, p.turn, p.size,
                 p.reached[x.i] AND coalesce(x.pos < least(p.e, p.closes[x.i]) OR (x.i = p.n AND x.pos = least(p.e, p.closes[x.i])), false) AS seating,
                 CASE WHEN NOT p.reached[x.i] THEN x.seen
                      WHEN x.seen IS NOT NULL AND x.pos IS NOT NULL
                      THEN CASE WHEN p.reached[x.i] AND coalesce(x.pos < least(p.e, p.closes[x.i]) OR (x.i = p.n AND x.pos = least(p.e, p.closes[x.i])), false)
                                THEN x.seen ELSE greatest(x.seen, x.pos) END END AS seen2
          FROM seat_step x JOIN seat_plan p USING (c) WHERE x.i <= p.n) q) ),
seat_total AS (
  SELECT doc, size, s, raw_e,
         CASE WHEN size IS NULL OR NOT json_valid(doc) THEN NULL
              WHEN json_keys(doc) = [] THEN 0.0
              WHEN failed THEN NULL ELSE CAST(guests AS DOUBLE) END AS guests
  FROM seat_case LEFT JOIN (SELECT c, failed FROM seat_plan) USING (c)
  LEFT JOIN (SELECT c, max(guests) AS guests FROM seat_step GROUP BY c) USING (c)),
pace_case AS (
  SELECT DISTINCT custom_pacing_str AS doc, covers_per_seating_interval AS f, shift_start_time_min AS s,
         shift_end_time_min AS e, interval_minutes AS step FROM shift_denorm),
pace_minute AS (
  SELECT *, unnest(CASE WHEN step IS NULL THEN [coalesce(s, 0)]
                   ELSE range(coalesce(s, 0), CASE WHEN e < coalesce(s, 0) THEN e + 1440 ELSE e END + 1, step) END) AS m
  FROM pace_case WHERE json_valid(doc)),
pace_value AS (
  SELECT *, list_contains(json_keys(doc), CAST(m % 1440 AS VARCHAR)) AS listed,
         CAST(json_extract_string(doc, '$."' || (m % 1440) || '"') AS DOUBLE) AS v FROM pace_minute),
pace_total AS (
  SELECT doc, f, s, e, step,
         sum(CASE WHEN listed AND v IS NULL THEN 0 WHEN v >= 0 THEN v ELSE coalesce(f, 0) END) AS cap
  FROM pace_value GROUP BY ALL),
denorm AS (
  SELECT d.*, t.guests AS table_capacity, CAST(p.cap AS DOUBLE) AS max_shift_capacity
  FROM shift_denorm d
  JOIN seat_total t ON t.doc IS NOT DISTINCT FROM d.duration_dict_ranges_str AND t.size IS NOT DISTINCT FROM d.table_size
   AND t.s IS NOT DISTINCT FROM d.shift_start_time_min AND t.raw_e IS NOT DISTINCT FROM d.shift_end_time_min
  LEFT JOIN pace_total p ON p.doc IS NOT DISTINCT FROM d.custom_pacing_str AND p.f IS NOT DISTINCT FROM d.covers_per_seating_interval
   AND p.s IS NOT DISTINCT FROM d.shift_start_time_min AND p.e IS NOT DISTINCT FROM d.shift_end_time_min
   AND p.step IS NOT DISTINCT FROM d.interval_minutes)"""


def _calendar(start: str, end: str) -> str:
    return f"""
spine AS (SELECT CAST(unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS DATE) AS date),
excluded AS (SELECT int_id, venue_key_id AS venue_id, unnest(excluded_dates) AS excluded_date FROM shift_default),
masks AS (SELECT int_id, venue_key_id, array_to_string(
            list_transform(range(1, 8), lambda i: CASE WHEN day_of_week[i] THEN i ELSE 0 END), '') AS days FROM shift_default),
calendar_default AS (
  SELECT d.date, CAST(isodow(d.date) AS INTEGER) AS day_of_week, t.venue_key_id, t.int_id, t.category AS shift_category
  FROM spine d JOIN shift_default t ON t.effective_start_date <= d.date
   AND (t.effective_end_date >= d.date OR t.effective_end_date IS NULL)
  LEFT JOIN excluded x ON x.venue_id = t.venue_key_id AND x.int_id = t.int_id AND x.excluded_date = d.date
  JOIN masks m ON m.int_id = t.int_id AND m.venue_key_id = t.venue_key_id
  WHERE t.archived IS NULL AND t.deleted IS NULL AND x.excluded_date IS NULL
    AND instr(m.days, CAST(isodow(d.date) AS VARCHAR)) > 0),
calendar_override AS (
  SELECT d.date, CAST(isodow(d.date) AS INTEGER) AS day_of_week, o.venue_key_id, o.int_id, o.category AS shift_category
  FROM spine d JOIN shift_override o ON o.date = d.date WHERE o.deleted IS NULL),
calendar AS (SELECT * FROM calendar_default UNION ALL SELECT * FROM calendar_override)"""


_PLAIN = ()
_TIMES = ("interval_minutes", "start_time", "end_time", "duration_dict_ranges_str")
_SLOTS = (
    "interval_minutes", "custom_pacing_str", "covers_per_seating_interval",
    "shift_start_time_min", "shift_end_time_min",
)


def _capacity(start: str, end: str, extra: tuple[str, ...] = _PLAIN) -> str:
    """Capacity rows, grouped only after the tables are spread over the days."""
    more = "".join(f", d.{c}" for c in extra)
    return f"""{_SEATING},{_calendar(start, end)},
capacity AS (
  SELECT *, CASE WHEN max_shift_capacity < calculated_capacity THEN max_shift_capacity ELSE calculated_capacity END AS util_capacity
  FROM (SELECT c.date, c.venue_key_id, c.int_id, d.persistent_id, d.name, c.shift_category{more}, d.max_shift_capacity,
               sum(d.table_capacity) AS calculated_capacity
        FROM calendar c LEFT JOIN denorm d ON d.int_id = c.int_id AND d.venue_key_id = c.venue_key_id
        GROUP BY ALL))"""


_PAST = ("DATE '1989-01-01'", "DATE '2000-12-31'")
_PAST_2Y = ("DATE '1999-01-01'", "DATE '2000-12-31'")
_PAST_400D = ("DATE '2001-01-01' - 400", "DATE '2000-12-31'")
_FUTURE = ("DATE '2001-01-01'", "DATE '2001-01-01' + 365")
_ALL_DAYS = ("DATE '1989-01-01'", "DATE '2001-01-01' + 365")

_ACTUAL = """
actual AS (
  SELECT venue_key_id, shift_persistent_id AS persistent_id, CAST(marked_time AS DATE) AS shift_date,
         CAST(sum(max_guests) AS BIGINT) AS final_actual_covers, count(*) AS total_reservations, avg(max_guests) AS avg_party_size
  FROM active WHERE marked_time IS NOT NULL GROUP BY 1, 2, 3)"""

_BOOKED = """
booked AS (
  SELECT venue_key_id, shift_persistent_id AS persistent_id, CAST(marked_time AS DATE) AS shift_date,
         CAST(created AS DATE) AS creation_day, CAST(sum(max_guests) AS BIGINT) AS covers_created_on_day,
         count(*) AS reservations_created_on_day, avg(max_guests) AS avg_party_size_created_on_day,
         avg(date_diff('day', CAST(created AS DATE), CAST(marked_time AS DATE))) AS avg_lead_time_for_day
  FROM active WHERE marked_time IS NOT NULL AND created IS NOT NULL{0} GROUP BY 1, 2, 3, 4)"""

_CURRENT = f"""
current_books AS (
  SELECT venue_key_id, shift_persistent_id AS persistent_id, date AS shift_date,
         CAST(sum(max_guests) AS BIGINT) AS current_total_covers, count(*) AS total_reservations,
         avg(max_guests) AS avg_party_size, min(created) AS first_booking_timestamp, max(created) AS latest_booking_timestamp
  FROM active WHERE created <= {NOW} GROUP BY 1, 2, 3)"""

_USING = "USING (venue_key_id, persistent_id, shift_date)"


def _hot(covers: str, capacity: str, threshold: float) -> str:
    return f"CASE WHEN {capacity} > 0 AND coalesce({covers}, 0) / {capacity} > {threshold}::DOUBLE THEN 1 ELSE 0 END AS is_hot"


def _labelled(window: tuple[str, str], threshold: float = 0.85) -> str:
    return f"""{_capacity(*window)},{_ACTUAL},
labelled AS (
  SELECT c.*, a.final_actual_covers, a.total_reservations, a.avg_party_size, {_hot('a.final_actual_covers', 'c.util_capacity', threshold)}
  FROM (SELECT * RENAME (date AS shift_date) FROM capacity) c LEFT JOIN actual a {_USING})"""


def _parts(day: str) -> str:
    return (
        f"CAST(dayofweek({day}) + 1 AS INTEGER) AS day_of_week, CAST(month({day}) AS INTEGER) AS month, "
        f"CAST(year({day}) AS INTEGER) AS year"
    )


def _holiday(day: str) -> str:
    dow, dom, mon = f"dayofweek({day})", f"day({day})", f"month({day})"
    return f"""CASE WHEN {mon} = 1 AND {dom} = 1 THEN 'New Year''s Day'
  WHEN {mon} = 2 AND {dom} = 14 THEN 'Valentine''s Day'
  WHEN {mon} = 5 AND {dow} = 0 AND {dom} BETWEEN 8 AND 14 THEN 'Mother''s Day'
  WHEN {mon} = 5 AND {dow} = 1 AND {dom} >= 25 THEN 'Memorial Day'
  WHEN {mon} = 7 AND {dom} = 4 THEN 'Independence Day'
  WHEN {mon} = 9 AND {dow} = 1 AND {dom} <= 7 THEN 'Labor Day'
  WHEN {mon} = 11 AND {dow} = 4 AND {dom} BETWEEN 22 AND 28 THEN 'Thanksgiving'
  WHEN {mon} = 12 AND {dom} = 24 THEN 'Christmas Eve'
  WHEN {mon} = 12 AND {dom} = 25 THEN 'Christmas Day'
  WHEN {mon} = 12 AND {dom} = 31 THEN 'New Year''s Eve' END"""


def _is_holiday(day: str) -> str:
    return f"CASE WHEN {_holiday(day)} IS NOT NULL THEN 1 ELSE 0 END AS is_holiday"


def _seasons(day: str) -> str:
    months = {"is_winter": "12, 1, 2", "is_spring": "3, 4, 5", "is_summer": "6, 7, 8", "is_fall": "9, 10, 11"}
    flags = [f"CASE WHEN month({day}) IN ({m}) THEN 1 ELSE 0 END AS {n}" for n, m in months.items()]
    return ", ".join([*flags, f"CASE WHEN dayofweek({day}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"])


def _horizons(day_prior: str) -> str:
    spans = {"is_within_week": 7, "is_within_month": 30, "is_within_quarter": 90}
    return ", ".join(f"CASE WHEN {day_prior} <= {n} THEN 1 ELSE 0 END AS {name}" for name, n in spans.items())


def _with(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join((_SOURCES, *parts)) + "\n"


def _names(day: str) -> str:
    return f"lower(dayname({day})) AS day_of_week, lower(monthname({day})) AS month"


# --- slots ----------------------------------------------------------------------


def _slots(window: tuple[str, str]) -> str:
    return f"""{_capacity(*window, extra=_SLOTS)},
sitting AS (SELECT * RENAME (date AS shift_date) FROM capacity),
slot AS (
  SELECT s.*, CAST(g AS INTEGER) AS slot_index,
         (shift_start_time_min + g * interval_minutes) % 1440 AS slot_start_time_min,
         (shift_start_time_min + (g + 1) * interval_minutes) % 1440 AS slot_end_time_min,
         CAST(shift_date AS TIMESTAMP) + to_minutes((shift_start_time_min + g * interval_minutes) % 1440)
           + to_days((shift_start_time_min + g * interval_minutes) // 1440) AS slot_start_timestamp,
         CAST(shift_date AS TIMESTAMP) + to_minutes((shift_start_time_min + (g + 1) * interval_minutes) % 1440)
           + to_days((shift_start_time_min + (g + 1) * interval_minutes) // 1440) AS slot_end_timestamp
  FROM (SELECT *, unnest(generate_series(0, CAST(round(CAST(CASE WHEN shift_end_time_min >= shift_start_time_min
                 THEN shift_end_time_min - shift_start_time_min ELSE shift_end_time_min + 1440 - shift_start_time_min END AS DOUBLE)
                 / interval_minutes) AS INTEGER) - 1)) AS g
        FROM sitting) s),
slot_weight AS (
  SELECT *, coalesce(raw_pacing, covers_per_seating_interval, 1) AS pacing_weight
  FROM (SELECT *, CASE WHEN json_valid(custom_pacing_str)
                  THEN CAST(trunc(TRY_CAST(json_extract_string(custom_pacing_str, '$."' || slot_start_time_min || '"') AS DOUBLE)) AS BIGINT) END AS raw_pacing
        FROM slot)),
slot_cap AS (
  SELECT *, CASE WHEN total_weight = 0 THEN util_capacity / slots_in_shift
            ELSE util_capacity * (CAST(pacing_weight AS DOUBLE) / total_weight) END AS slot_capacity
  FROM (SELECT *, CAST(sum(pacing_weight) OVER w AS BIGINT) AS total_weight, count(*) OVER w AS slots_in_shift
        FROM slot_weight WINDOW w AS (PARTITION BY venue_key_id, persistent_id, shift_date, int_id)))"""


def _slot_covers(condition: str) -> str:
    return f"""
slot_cov AS (
  SELECT s.venue_key_id, s.persistent_id, s.shift_date, s.int_id, s.slot_index, CAST(sum(r.max_guests) AS BIGINT) AS covers_in_slot
  FROM slot s JOIN active r ON r.venue_key_id = s.venue_key_id
   AND r.marked_time >= s.slot_start_timestamp AND r.marked_time < s.slot_end_timestamp
  WHERE {condition} GROUP BY ALL)"""


_SLOT_PAST = f"r.marked_time >= {NOW} - INTERVAL 1095 DAY AND r.marked_time <= {NOW}"
_SLOT_FUTURE = (
    f"r.created <= {NOW} AND r.marked_time >= {NOW} - INTERVAL 400 DAY "
    f"AND r.marked_time <= {NOW} + INTERVAL 400 DAY"
)
_SLOT_TABLE = f"""s.shift_date, s.venue_key_id, s.persistent_id, s.int_id, s.shift_category, s.util_capacity, s.interval_minutes,
  s.slot_index, CAST(s.slot_start_time_min AS INTEGER) AS slot_start_time_min, s.slot_start_timestamp, s.slot_capacity, {_parts('s.shift_date')},
  coalesce(v.covers_in_slot, 0) AS covers_as_of_date"""
_SLOT_JOIN = "FROM slot_cap s LEFT JOIN slot_cov v USING (venue_key_id, persistent_id, shift_date, int_id, slot_index) WHERE s.util_capacity > 0"

# --- scored rows -----------------------------------------------------------------

_SCORED = f"""WITH scored AS (
  SELECT shift_date, venue_key_id, persistent_id, day_prior, CAST(dayofweek(shift_date) + 1 AS INTEGER) AS day_of_week,
         CASE WHEN s + (o * 13) % 60 > 80 THEN 1 ELSE 0 END AS is_hot, s / 100.0::DOUBLE AS hot_probability
  FROM (SELECT 5 * CAST(round(100 * l_discount) AS BIGINT) + (l_partkey * 31 + l_suppkey * 7) % 51 AS s, l_orderkey AS o,
               l_suppkey // 5 AS venue_key_id, {_SHIFT.format('(l_linenumber % 3)')} AS persistent_id,
               CAST(l_shipdate AS DATE) AS shift_date, CAST(l_quantity AS INTEGER) - 1 AS day_prior FROM lineitem)),
judged AS (SELECT *, CASE WHEN hot_probability > 0.5 THEN 1 ELSE 0 END AS predicted_hot,
             is_hot = CASE WHEN hot_probability > 0.5 THEN 1 ELSE 0 END AS {CORRECT} FROM scored),
confusion AS (
  SELECT count(*) FILTER (is_hot = 1 AND predicted_hot = 1) AS true_positives,
         count(*) FILTER (is_hot = 0 AND predicted_hot = 1) AS false_positives,
         count(*) FILTER (is_hot = 0 AND predicted_hot = 0) AS true_negatives,
         count(*) FILTER (is_hot = 1 AND predicted_hot = 0) AS false_negatives FROM judged),
level AS (
  SELECT hot_probability AS threshold, CAST(sum(is_hot) AS BIGINT) AS pos, CAST(sum(1 - is_hot) AS BIGINT) AS neg FROM scored GROUP BY 1),
curve AS (
  SELECT threshold, pos, neg, CAST(sum(pos) OVER (ORDER BY threshold DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER (ORDER BY threshold DESC) AS DOUBLE) AS fp,
         CAST(sum(pos) OVER () AS DOUBLE) AS all_pos, CAST(sum(neg) OVER () AS DOUBLE) AS all_neg FROM level),
auc AS (
  SELECT round(sum(CASE WHEN a.threshold > b.threshold THEN 1.0::DOUBLE WHEN a.threshold = b.threshold THEN 0.5::DOUBLE ELSE 0 END
             * a.pos * b.neg) / ((SELECT sum(pos) FROM level) * CAST((SELECT sum(neg) FROM level) AS DOUBLE)), 9) AS auc_score
  FROM level a, level b)
"""

_RATES = """
rates AS (
  SELECT *, coalesce(CAST(true_positives AS DOUBLE) / nullif(true_positives + false_positives, 0), 0) AS hp,
         coalesce(CAST(true_positives AS DOUBLE) / nullif(true_positives + false_negatives, 0), 0) AS hr,
         coalesce(CAST(true_negatives AS DOUBLE) / nullif(true_negatives + false_negatives, 0), 0) AS cp,
         coalesce(CAST(true_negatives AS DOUBLE) / nullif(true_negatives + false_positives, 0), 0) AS cr,
         true_positives + false_negatives AS hots, true_negatives + false_positives AS colds,
         true_positives + false_positives + true_negatives + false_negatives AS n FROM confusion),
f1s AS (SELECT *, coalesce(2 * hp * hr / nullif(hp + hr, 0), 0) AS hf, coalesce(2 * cp * cr / nullif(cp + cr, 0), 0) AS cf FROM rates)
"""

_ACCURACY = """round(avg(CASE WHEN is_hot = predicted_hot THEN 1 ELSE 0 END), 4) AS accuracy, count(is_hot) AS shifts,
  CAST(sum(is_hot) AS BIGINT) AS hot_shifts, CAST(sum(predicted_hot) AS BIGINT) AS predicted_hot_shifts"""


def _histogram(by: str | None) -> str:
    g = by or "0"
    return f"""{_SCORED}, r AS (SELECT {g} AS g, min(hot_probability) AS lo, max(hot_probability) AS hi FROM scored GROUP BY 1),
 spine AS (SELECT r.*, CAST(b AS INTEGER) AS bin, (hi - lo) / 30 AS width FROM r, range(30) t(b)),
 hits AS (SELECT {g} AS g, least(CAST(floor((hot_probability - r.lo) / ((r.hi - r.lo) / 30)) AS INTEGER), 29) AS bin, count(*) AS n
          FROM scored JOIN r ON r.g = {g} GROUP BY 1, 2)
SELECT {'s.g AS ' + by + ', ' if by else ''}s.bin, round(s.lo + s.bin * s.width, 9) AS bin_start, round(s.lo + (s.bin + 1) * s.width, 9) AS bin_end,
       coalesce(h.n, 0) AS rows FROM spine s LEFT JOIN hits h ON h.g = s.g AND h.bin = s.bin"""


def _stratified() -> str:
    return f"""{_SCORED}, h AS (
  SELECT *, md5('42|' || CAST(shift_date AS VARCHAR) || '|' || venue_key_id || '|' || persistent_id || '|' ||
         day_prior || '|' || day_of_week || '|' || CAST(hot_probability AS VARCHAR)) AS h FROM scored),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY is_hot ORDER BY h) AS rn, count(*) OVER (PARTITION BY is_hot) AS n FROM h)
SELECT * EXCLUDE (h, rn, n), rn <= ceil(0.2::DOUBLE * n) AS is_validation FROM ranked"""


def _metrics_by(rows: str, by: str) -> str:
    """Metrics per group of ``by`` over the statement ``rows``."""
    return f"""{rows}, j AS (SELECT *, CASE WHEN hot_probability > 0.5 THEN 1 ELSE 0 END AS hot FROM marked),
 rung AS (SELECT {by}, hot_probability AS x, sum(is_hot) AS pos, sum(1 - is_hot) AS neg FROM j GROUP BY ALL),
 climb AS (SELECT *, sum(neg) OVER (PARTITION BY {by} ORDER BY x) - neg AS beaten FROM rung),
 area AS (SELECT {by}, round(sum(pos * (beaten + 0.5::DOUBLE * neg)) / nullif(sum(pos) * CAST(sum(neg) AS DOUBLE), 0), 9) AS auc_score
  FROM climb GROUP BY ALL),
 split AS (SELECT {by}, CAST(sum(is_hot * hot) AS BIGINT) AS true_positives, CAST(sum((1 - is_hot) * hot) AS BIGINT) AS false_positives,
  CAST(sum((1 - is_hot) * (1 - hot)) AS BIGINT) AS true_negatives, CAST(sum(is_hot * (1 - hot)) AS BIGINT) AS false_negatives FROM j GROUP BY ALL),
 {_RATES.strip().replace('FROM confusion', 'FROM split')}
SELECT {by}, CAST(true_positives + true_negatives AS DOUBLE) / n AS accuracy, auc_score, hp AS precision_hot, hr AS recall_hot, hf AS f1_score,
 true_positives, false_positives, true_negatives, false_negatives FROM f1s JOIN area USING ({by})"""


# --- queries -----------------------------------------------------------------------


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    out = "venue_key_id, persistent_id, shift_date"

    q["scan_reservations"] = _with() + "SELECT * FROM reservation"
    q["active_reservations"] = _with() + f"SELECT * FROM active WHERE {_SLOT_PAST.replace('r.', '')}"
    q["date_spine"] = _with() + """, bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM reservation)
SELECT d.date, CAST(isodow(d.date) AS INTEGER) AS day_of_week, coalesce(r.n, 0) AS reservations
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds) d
LEFT JOIN (SELECT date, count(*) AS n FROM reservation GROUP BY 1) r USING (date)"""
    q["holidays"] = _with() + f""", bounds AS (SELECT min(date) AS lo, max(date) AS hi FROM reservation),
 days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS check_date FROM bounds)
SELECT d.check_date, {_holiday('d.check_date')} AS holiday_name, CAST(coalesce(r.guests, 0) AS BIGINT) AS guests
FROM days d LEFT JOIN (SELECT date, sum(max_guests) AS guests FROM active GROUP BY 1) r ON r.date = d.check_date
WHERE {_holiday('d.check_date')} IS NOT NULL"""

    q["excluded_dates"] = _with(_calendar(*_ALL_DAYS)) + "SELECT * FROM excluded WHERE excluded_date IS NOT NULL"
    q["shift_calendar"] = _with(_calendar(*_ALL_DAYS)) + "SELECT * FROM calendar_default"
    q["override_calendar"] = _with(_calendar(*_ALL_DAYS)) + "SELECT * FROM calendar_override"
    q["shift_calendar_all"] = _with(_calendar(*_ALL_DAYS)) + "SELECT * FROM calendar"

    q["table_capacity"] = _with(_SEATING) + "SELECT venue_key_id, int_id, table_size, table_capacity FROM denorm"
    q["pacing_capacity"] = _with(_SEATING) + "SELECT venue_key_id, int_id, table_size, max_shift_capacity FROM denorm"
    q["shift_capacity"] = _with(_capacity(*_ALL_DAYS)) + "SELECT * FROM capacity"
    q["future_capacity"] = _with(_capacity(*_FUTURE)) + "SELECT * RENAME (date AS shift_date) FROM capacity WHERE util_capacity > 0"
    shifted = "({0} - (TIMESTAMP '1900-01-01' - TIMESTAMP '1970-01-01'))"
    q["shift_times"] = _with(_capacity(*_ALL_DAYS, extra=_TIMES)) + f""", timed AS (
  SELECT * EXCLUDE (start_time, end_time), {shifted.format('start_time')} AS normalized_start_time, {shifted.format('end_time')} AS end_time FROM capacity),
 ended AS (SELECT *, CASE WHEN end_time < normalized_start_time THEN end_time + INTERVAL 24 HOUR ELSE end_time END AS normalized_end_time FROM timed)
SELECT date, venue_key_id, int_id, persistent_id, name, shift_category, interval_minutes, util_capacity,
       normalized_start_time, end_time, normalized_end_time, CAST(day(normalized_end_time) AS INTEGER) AS normalized_end_time_dom,
       CAST(hour(normalized_end_time) * 60 + minute(normalized_end_time) AS INTEGER) AS normalized_end_time_minutes,
       CAST(hour(normalized_start_time) * 60 + minute(normalized_start_time) AS INTEGER) AS normalized_start_time_minutes,
       date - CAST(dayofweek(date) AS INTEGER) AS date_partition FROM ended"""

    clock = "CAST(date AS TIMESTAMP) + (normalized_{0}_time - TIMESTAMP '1970-01-01')"
    timed = q["shift_times"].replace(_with(_capacity(*_ALL_DAYS, extra=_TIMES)), "")
    q["interval_covers"] = _with(_capacity("DATE '2001-01-01' - 400", AS_OF, extra=_TIMES)) + timed.split("\nSELECT date")[0] + f""",
 sitting AS (SELECT venue_key_id, persistent_id, date, int_id, {clock.format('start')} AS opens, {clock.format('end')} AS closes FROM ended),
 due AS (SELECT venue_key_id, marked_time, coalesce(max_guests, 0) AS max_guests FROM reservation WHERE status NOT IN ('CANCELED')),
 met AS (SELECT s.venue_key_id, s.persistent_id, s.date, s.int_id, CAST(sum(max_guests) AS BIGINT) AS guests, count(*) AS parties
  FROM sitting s JOIN due d ON d.venue_key_id = s.venue_key_id AND d.marked_time >= s.opens AND d.marked_time < s.closes GROUP BY ALL)
SELECT s.*, coalesce(guests, 0) AS guests, coalesce(parties, 0) AS parties FROM sitting s LEFT JOIN met USING (venue_key_id, persistent_id, date, int_id)"""

    q["actual_covers"] = _with(_ACTUAL) + "SELECT * FROM actual"
    buckets = ", ".join(
        f"CAST(sum(CASE WHEN date_diff('day', CAST(created AS DATE), CAST(marked_time AS DATE)) >= {n} THEN max_guests ELSE 0 END) AS BIGINT) "
        f"AS covers_booked_{n}_{'day' if n == 1 else 'days'}_prior"
        for n in (30, 14, 7, 3, 1)
    )
    bucket_cte = f"""
buckets AS (SELECT venue_key_id, shift_persistent_id AS persistent_id, CAST(marked_time AS DATE) AS shift_date,
  CAST(sum(max_guests) AS BIGINT) AS final_actual_covers, {buckets}
  FROM active WHERE marked_time IS NOT NULL AND created IS NOT NULL GROUP BY 1, 2, 3)"""
    q["lead_time_buckets"] = _with(bucket_cte) + "SELECT * FROM buckets"
    q["bookings_by_creation_day"] = _with(_BOOKED.format("")) + "SELECT * FROM booked"
    q["current_bookings"] = _with(_CURRENT) + "SELECT * FROM current_books"
    timing = f"""date_diff('day', CAST(first_booking_timestamp AS DATE), shift_date)::INTEGER AS days_since_first_booking,
  date_diff('day', CAST(latest_booking_timestamp AS DATE), {AS_OF})::INTEGER AS days_since_latest_booking"""
    q["booking_timing"] = _with(_CURRENT) + f"SELECT *, {timing} FROM current_books"
    velocity = ", ".join(
        f"avg(CASE WHEN date_diff('day', creation_day, shift_date) <= {n} THEN covers_created_on_day ELSE 0 END) AS avg_covers_{n}_days_out"
        for n in (7, 14, 30, 60)
    )
    velocity_cte = f"""
velocity AS (SELECT venue_key_id, persistent_id, CAST(dayofweek(shift_date) + 1 AS INTEGER) AS day_of_week,
  CAST(month(shift_date) AS INTEGER) AS month, {velocity} FROM booked GROUP BY 1, 2, 3, 4)"""
    booked_2y = _BOOKED.format(" AND marked_time >= DATE '1999-01-01'")
    q["booking_velocity"] = _with(booked_2y, velocity_cte) + "SELECT * FROM velocity"
    patterns = ", ".join(
        f"avg(CASE WHEN date_diff('day', CAST(created AS DATE), date) <= {n} THEN max_guests ELSE 0 END) AS avg_covers_last_{n}_days"
        for n in (30, 60, 90)
    )
    patterns_cte = f"""
patterns AS (SELECT venue_key_id, shift_persistent_id AS persistent_id, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
  CAST(month(date) AS INTEGER) AS month, {patterns}, avg(date_diff('day', CAST(created AS DATE), date)) AS avg_lead_time_days
  FROM active WHERE created IS NOT NULL AND date >= DATE '1999-01-01' AND date < {AS_OF} GROUP BY 1, 2, 3, 4)"""
    q["booking_patterns"] = _with(patterns_cte) + "SELECT * FROM patterns"

    q["calendar_names"] = _with(_ACTUAL) + f"SELECT {out}, {_names('shift_date')}, CAST(year(shift_date) AS INTEGER) AS year, final_actual_covers FROM actual"
    q["calendar_flags"] = _with(_BOOKED.format("")) + f"""SELECT {out}, creation_day, day_prior, covers_created_on_day, {_seasons('shift_date')}, {_horizons('day_prior')}
FROM (SELECT *, CAST(date_diff('day', creation_day, shift_date) AS INTEGER) AS day_prior FROM booked)"""
    q["holiday_flag"] = _with(_ACTUAL) + f"SELECT {out}, final_actual_covers, {_is_holiday('shift_date')} FROM actual"
    q["venue_lookup"] = _with(_ACTUAL) + "SELECT a.*, v.name AS venue_name FROM actual a LEFT JOIN venue v ON v.id = a.venue_key_id"

    q["label_ratio"] = _with(_labelled(_PAST)) + "SELECT * FROM labelled"
    q["backtest_window"] = _with(_labelled(_PAST)) + f"SELECT * FROM labelled WHERE shift_date BETWEEN {AS_OF} - 90 AND {AS_OF} - 1"
    outcomes = f"""{_capacity(*_PAST, extra=_TIMES)},{_BOOKED.format(f" AND marked_time < {AS_OF}")},
sitting AS (SELECT * RENAME (date AS shift_date) FROM capacity),
outcome AS (
  SELECT s.venue_key_id, s.persistent_id, s.shift_date, CAST(dayofweek(s.shift_date) + 1 AS INTEGER) AS day_of_week, s.util_capacity,
         CAST(sum(b.covers_created_on_day) AS BIGINT) AS final_actual_covers
  FROM sitting s LEFT JOIN booked b {_USING} GROUP BY 1, 2, 3, 4, 5),
threshold AS (
  SELECT venue_key_id, day_of_week, quantile_disc(final_actual_covers / util_capacity, 0.8) AS hot_threshold
  FROM outcome WHERE util_capacity > 0 GROUP BY 1, 2),
quantile_label AS (
  SELECT o.*, t.hot_threshold,
         CASE WHEN o.util_capacity > 0 AND o.final_actual_covers / o.util_capacity >= t.hot_threshold THEN 1 ELSE 0 END AS is_hot
  FROM outcome o LEFT JOIN threshold t USING (venue_key_id, day_of_week))"""
    q["final_outcomes"] = _with(outcomes) + "SELECT * FROM outcome"
    q["weekday_threshold"] = _with(outcomes) + "SELECT * FROM threshold"
    q["weekday_threshold_exact"] = q["weekday_threshold"]
    q["label_quantile"] = _with(outcomes) + "SELECT * FROM quantile_label"

    days_2y = f"""{_labelled(_PAST_2Y)},
sitting AS (SELECT * FROM labelled WHERE util_capacity > 0)"""
    scaffold = "SELECT s.*, CAST(d AS INTEGER) AS day_prior, shift_date - CAST(d AS INTEGER) AS snapshot_timestamp FROM sitting s, range(366) t(d)"
    q["snapshot_scaffold"] = _with(days_2y) + f"SELECT {out}, int_id, util_capacity, day_prior, snapshot_timestamp FROM ({scaffold}) WHERE day_prior BETWEEN 1 AND 180 OR day_prior IN (0, 365)"
    q["asof_covers"] = _with(days_2y, _BOOKED.format("")) + f"""SELECT {out}, int_id, day_prior, snapshot_timestamp, CAST(coalesce(sum(b.covers_created_on_day), 0) AS BIGINT) AS covers_as_of_date
FROM ({scaffold}) s LEFT JOIN booked b ON b.venue_key_id = s.venue_key_id AND b.persistent_id = s.persistent_id AND b.shift_date = s.shift_date
 AND b.creation_day <= s.snapshot_timestamp GROUP BY ALL""".replace(out, "s.venue_key_id, s.persistent_id, s.shift_date", 1)
    q["recent_pace"] = _with(days_2y, _BOOKED.format("")) + """SELECT s.venue_key_id, s.persistent_id, s.shift_date, int_id, day_prior, snapshot_timestamp,
 CAST(coalesce(sum(b.covers_created_on_day), 0) AS BIGINT) AS covers_recent
FROM (SCAFFOLD) s LEFT JOIN booked b ON b.venue_key_id = s.venue_key_id AND b.persistent_id = s.persistent_id AND b.shift_date = s.shift_date
 AND b.creation_day BETWEEN s.snapshot_timestamp - 7 AND s.snapshot_timestamp GROUP BY ALL""".replace("SCAFFOLD", scaffold)
    running = "CAST(sum(coalesce({0}, 0)) OVER (PARTITION BY venue_key_id, persistent_id, shift_date ORDER BY {1}) AS BIGINT) AS {2}"
    q["running_sum_rows"] = _with(_BOOKED.format("")) + f"""SELECT {out}, creation_day,
 {running.format('covers_created_on_day', 'creation_day ROWS UNBOUNDED PRECEDING', 'running_covers')},
 {running.format('reservations_created_on_day', 'creation_day ROWS UNBOUNDED PRECEDING', 'running_reservations')} FROM booked"""
    q["running_sum_range"] = _with(_BOOKED.format("")) + f"""SELECT {out}, creation_day, creation_week,
 {running.format('covers_created_on_day', 'creation_week', 'running_covers')},
 {running.format('reservations_created_on_day', 'creation_week', 'running_reservations')}
FROM (SELECT *, creation_day - CAST(dayofweek(creation_day) AS INTEGER) AS creation_week FROM booked)"""

    total = "CAST(sum(coalesce({0}, 0)) OVER (PARTITION BY venue_key_id ORDER BY {1}) AS BIGINT) AS {2}"
    by_venue = "creation_day NULLS FIRST, persistent_id NULLS FIRST, shift_date NULLS FIRST ROWS UNBOUNDED PRECEDING"
    q["running_total_rows"] = _with(_BOOKED.format("")) + f"""SELECT {out}, creation_day,
 {total.format('covers_created_on_day', by_venue, 'running_covers')},
 {total.format('reservations_created_on_day', by_venue, 'running_reservations')} FROM booked"""
    q["running_total_range"] = _with(_BOOKED.format("")) + f"""SELECT {out}, creation_day, creation_week,
 {total.format('covers_created_on_day', 'creation_week NULLS FIRST', 'running_covers')},
 {total.format('reservations_created_on_day', 'creation_week NULLS FIRST', 'running_reservations')}
FROM (SELECT *, creation_day - CAST(dayofweek(creation_day) AS INTEGER) AS creation_week FROM booked)"""

    names = ("shift_persistent_id", "status", "visit")
    numbers = ", ".join(
        f"n_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS n FROM (SELECT DISTINCT {c} AS v FROM named WHERE date < {AS_OF} AND {c} IS NOT NULL))"
        for c in names
    )
    q["encoded_categories"] = _with() + f""", named AS (SELECT venue_key_id, shift_persistent_id, status, date,
  concat_ws('/', CAST(venue_key_id AS VARCHAR), shift_persistent_id, CAST(date AS VARCHAR)) AS visit FROM reservation), {numbers}
SELECT named.*, {", ".join(f"coalesce(n_{c}.n, (SELECT count(*) FROM n_{c})) AS {c}_index" for c in names)}
FROM named {" ".join(f"LEFT JOIN n_{c} ON n_{c}.v = named.{c}" for c in names)}"""

    slot_key = "venue_key_id, persistent_id, shift_date, int_id, slot_index"
    q["shift_slots"] = _with(_slots(_PAST_400D)) + f"""SELECT {slot_key}, shift_category, CAST(slot_start_time_min AS INTEGER) AS slot_start_time_min,
 CAST(slot_end_time_min AS INTEGER) AS slot_end_time_min, slot_start_timestamp, slot_end_timestamp FROM slot"""
    q["pacing_at_minute"] = _with(_slots(_PAST_400D)) + f"""SELECT {slot_key}, CAST(coalesce(raw_pacing, covers_per_seating_interval) AS BIGINT) AS pacing FROM slot_weight"""
    q["slot_capacity"] = _with(_slots(_PAST_400D)) + f"""SELECT {slot_key}, util_capacity, raw_pacing, CAST(pacing_weight AS BIGINT) AS pacing_weight, total_weight, slot_capacity FROM slot_cap"""
    q["slot_covers"] = _with(_slots(_PAST_400D), _slot_covers(_SLOT_PAST)) + "SELECT * FROM slot_cov"
    q["training_slot"] = _with(_slots(_PAST_400D), _slot_covers(_SLOT_PAST)) + f"""SELECT {_SLOT_TABLE}, 0 AS day_prior,
 {_hot('v.covers_in_slot', 's.slot_capacity', 0.85)} {_SLOT_JOIN}"""
    q["upcoming_slot"] = _with(_slots(_FUTURE), _slot_covers(_SLOT_FUTURE)) + f"""SELECT {_SLOT_TABLE},
 CAST(date_diff('day', {AS_OF}, s.shift_date) AS INTEGER) AS day_prior {_SLOT_JOIN}"""

    q["training_shift_final"] = _with(_capacity(*_PAST, extra=_TIMES), bucket_cte) + f"""SELECT c.shift_date AS date, c.venue_key_id, v.name AS venue_name, c.name AS shift_name,
 c.persistent_id AS shift_persistent_id, c.util_capacity, coalesce(b.final_actual_covers, 0) AS final_actual_covers,
 {', '.join(f"coalesce(b.covers_booked_{n}_prior, 0) AS covers_booked_{n}_prior" for n in ('30_days', '14_days', '7_days', '3_days', '1_day'))},
 {_hot('b.final_actual_covers', 'c.util_capacity', 0.6)}
FROM (SELECT * RENAME (date AS shift_date) FROM capacity) c LEFT JOIN buckets b {_USING} LEFT JOIN venue v ON v.id = c.venue_key_id
WHERE c.util_capacity IS NOT NULL"""
    pairs = """FROM (SCAFFOLD) t LEFT JOIN booked r ON r.venue_key_id = t.venue_key_id AND r.persistent_id = t.persistent_id
 AND r.shift_date = t.shift_date AND t.snapshot_timestamp >= r.creation_day""".replace("SCAFFOLD", scaffold)
    q["training_shift_running"] = _with(_labelled(_PAST), "sitting AS (SELECT * FROM labelled WHERE util_capacity > 0)", _BOOKED.format("")) + f"""
SELECT t.shift_date, t.venue_key_id, t.persistent_id, t.snapshot_timestamp, t.shift_category, t.day_prior, t.util_capacity, {_parts('t.shift_date')},
 CAST(sum(coalesce(r.covers_created_on_day, 0)) OVER (PARTITION BY t.venue_key_id, t.persistent_id, t.shift_date ORDER BY t.snapshot_timestamp) AS BIGINT) AS covers_as_of_date,
 t.is_hot {pairs}"""
    q["training_shift_asof"] = _with(outcomes) + f""", names AS (SELECT venue_key_id, persistent_id, max_by(name, int_id) AS shift_name FROM shift_default GROUP BY 1, 2),
 snaps AS (SELECT o.*, CAST(d AS INTEGER) AS day_prior FROM quantile_label o, range(365) t(d) WHERE o.util_capacity > 0),
 seen AS (SELECT s.*, CAST(coalesce(sum(b.covers_created_on_day), 0) AS BIGINT) AS cumulative_covers_as_of_snapshot
   FROM snaps s LEFT JOIN booked b ON b.venue_key_id = s.venue_key_id AND b.persistent_id = s.persistent_id AND b.shift_date = s.shift_date
    AND b.creation_day <= s.shift_date - s.day_prior GROUP BY ALL)
SELECT s.shift_date AS reservation_date, s.venue_key_id, v.name AS venue_name, n.shift_name, s.persistent_id AS shift_persistent_id, {_parts('s.shift_date')},
 s.util_capacity, s.day_prior, s.cumulative_covers_as_of_snapshot, coalesce(s.final_actual_covers, 0) AS final_actual_covers, {_is_holiday('s.shift_date')}, s.is_hot
FROM seen s LEFT JOIN venue v ON v.id = s.venue_key_id LEFT JOIN names n ON n.venue_key_id = s.venue_key_id AND n.persistent_id = s.persistent_id"""
    q["training_shift_rich"] = _with(days_2y, booked_2y, velocity_cte) + f""", visible AS (
  SELECT t.*, r.creation_day, coalesce(r.covers_created_on_day, 0) AS c, coalesce(r.reservations_created_on_day, 0) AS n,
         CASE WHEN t.snapshot_timestamp - r.creation_day <= 7 THEN coalesce(r.covers_created_on_day, 0) ELSE 0 END AS recent
  {pairs} WHERE t.day_prior BETWEEN 1 AND 180 OR t.day_prior IN (0, 365)),
 summed AS (SELECT *, CAST(sum(c) OVER w AS BIGINT) AS covers_as_of_date, CAST(sum(n) OVER w AS BIGINT) AS reservations_as_of_date, CAST(sum(recent) OVER w AS BIGINT) AS covers_last_7_days
   FROM visible WINDOW w AS (PARTITION BY venue_key_id, persistent_id, shift_date ORDER BY snapshot_timestamp, creation_day NULLS FIRST, int_id, shift_category ROWS UNBOUNDED PRECEDING))
SELECT s.shift_date, s.venue_key_id, s.persistent_id, s.snapshot_timestamp, s.shift_category, s.day_prior, {_parts('s.shift_date')}, s.util_capacity, s.covers_as_of_date, s.reservations_as_of_date,
 CASE WHEN s.reservations_as_of_date > 0 THEN CAST(s.covers_as_of_date AS DOUBLE) / s.reservations_as_of_date ELSE 0 END AS avg_party_size_as_of_date,
 s.covers_as_of_date / s.util_capacity AS utilization_as_of_date, s.covers_last_7_days,
 {', '.join(f"coalesce(v.avg_covers_{n}_days_out, 0) AS historical_avg_covers_{n}d" for n in (7, 14, 30, 60))},
 {_seasons('s.shift_date')}, {_horizons('s.day_prior')}, s.is_hot
FROM summed s LEFT JOIN velocity v ON v.venue_key_id = s.venue_key_id AND v.persistent_id = s.persistent_id
 AND v.day_of_week = dayofweek(s.shift_date) + 1 AND v.month = month(s.shift_date)"""

    future = f"""{_capacity(*_FUTURE)},
coming AS (SELECT * RENAME (date AS shift_date) FROM capacity WHERE util_capacity > 0)"""
    ahead = f"CAST(date_diff('day', {AS_OF}, c.shift_date) AS INTEGER) AS day_prior"
    q["upcoming_shift"] = _with(future, _CURRENT) + f"""SELECT c.shift_date, c.venue_key_id, c.persistent_id, c.shift_category, {ahead}, c.util_capacity, {_parts('c.shift_date')},
 coalesce(b.current_total_covers, 0) AS covers_as_of_date FROM coming c LEFT JOIN current_books b {_USING}"""
    q["upcoming_shift_holiday"] = _with(_capacity(*_FUTURE, extra=_TIMES)) + f""", coming AS (SELECT * RENAME (date AS shift_date) FROM capacity WHERE util_capacity > 0),
 upcoming AS (SELECT venue_key_id, shift_persistent_id AS persistent_id, CAST(marked_time AS DATE) AS shift_date, CAST(sum(max_guests) AS BIGINT) AS guests
   FROM active WHERE CAST(marked_time AS DATE) >= {AS_OF} GROUP BY 1, 2, 3)
SELECT c.shift_date AS reservation_date, c.venue_key_id, v.name AS venue_name, c.name AS shift_name, c.persistent_id AS shift_persistent_id, {_parts('c.shift_date')},
 c.util_capacity, {ahead}, coalesce(u.guests, 0) AS cumulative_covers_as_of_snapshot, {_is_holiday('c.shift_date')}
FROM coming c LEFT JOIN upcoming u {_USING} LEFT JOIN venue v ON v.id = c.venue_key_id"""
    q["upcoming_shift_rich"] = _with(future, _CURRENT, patterns_cte) + f"""SELECT c.shift_date, c.venue_key_id, c.persistent_id, c.shift_category, {ahead}, {_parts('c.shift_date')}, c.util_capacity,
 coalesce(b.current_total_covers, 0) AS covers_as_of_date, coalesce(b.total_reservations, 0) AS current_reservation_count, coalesce(b.avg_party_size, 0) AS current_avg_party_size,
 coalesce(b.current_total_covers, 0) / c.util_capacity AS current_utilization_rate, {timing.replace('shift_date', 'c.shift_date')},
 {', '.join(f"coalesce(h.avg_covers_last_{n}_days, 0) AS historical_avg_covers_{n}d" for n in (30, 60, 90))},
 coalesce(h.avg_lead_time_days, 0) AS historical_avg_lead_time, {_seasons('c.shift_date')}
FROM coming c LEFT JOIN current_books b {_USING} LEFT JOIN patterns h ON h.venue_key_id = c.venue_key_id AND h.persistent_id = c.persistent_id
 AND h.day_of_week = dayofweek(c.shift_date) + 1 AND h.month = month(c.shift_date)"""

    q["clean_training_rows"] = """SELECT * FROM (SELECT l_orderkey, l_linenumber,
 TRY_CAST(CASE WHEN l_partkey % 10 = 0 THEN 'n/a' ELSE CAST(CAST(trunc(l_extendedprice) AS BIGINT) AS VARCHAR) END AS DOUBLE) AS util_capacity,
 TRY_CAST(CASE WHEN l_partkey % 15 = 0 THEN '' WHEN l_partkey % 7 = 3 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS DOUBLE) AS covers_as_of_date,
 CASE WHEN l_tax > 0.04 THEN 1 ELSE 0 END AS is_hot FROM lineitem) WHERE util_capacity IS NOT NULL AND covers_as_of_date IS NOT NULL"""

    q["prepared_rows"] = """SELECT l_orderkey, l_linenumber,
 coalesce(TRY_CAST(CASE WHEN l_partkey % 10 = 0 THEN 'n/a' ELSE CAST(CAST(trunc(l_extendedprice) AS BIGINT) AS VARCHAR) END AS DOUBLE), 0) AS util_capacity,
 coalesce(TRY_CAST(CASE WHEN l_partkey % 15 = 0 THEN '' WHEN l_partkey % 7 = 3 THEN NULL ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS DOUBLE), 0) AS covers_as_of_date,
 0 AS covers_last_7_days, 0 AS is_holiday FROM lineitem"""
    q["exported_results"] = _SCORED + f"""SELECT shift_date, venue_key_id, persistent_id, is_hot, predicted_hot, hot_probability, {CORRECT},
 strftime(shift_date, '%Y-%m') AS result_month FROM judged"""
    q["backtest_results"] = _SCORED + f"SELECT shift_date, venue_key_id, persistent_id, is_hot, predicted_hot, hot_probability, {CORRECT} FROM judged"
    q["class_balance"] = _SCORED + """SELECT count(*) FILTER (is_hot = 0) AS negatives, count(*) FILTER (is_hot = 1) AS positives,
 CAST(count(*) FILTER (is_hot = 0) AS DOUBLE) / count(*) FILTER (is_hot = 1) AS scale_pos_weight FROM scored"""
    q["score_summary"] = _SCORED + """SELECT count(*) AS total_shifts, CAST(sum(predicted_hot) AS BIGINT) AS predicted_hot_shifts,
 100 * (CAST(sum(predicted_hot) AS DOUBLE) / count(*)) AS predicted_hot_percent, round(avg(hot_probability), 9) AS avg_hot_probability,
 min(shift_date) AS first_date, max(shift_date) AS last_date FROM judged"""
    q["accuracy_by_weekday"] = _SCORED + f"SELECT day_of_week, {_ACCURACY} FROM judged GROUP BY 1"
    q["accuracy_by_horizon"] = _SCORED + f""", bins(horizon, lo, hi) AS (VALUES ('(0, 7]', 0, 7), ('(7, 30]', 7, 30), ('(30, 90]', 30, 90), ('(90, 365]', 90, 365)),
 found AS (SELECT horizon, {_ACCURACY} FROM judged JOIN bins ON day_prior > lo AND day_prior <= hi GROUP BY 1)
SELECT b.horizon, f.accuracy, coalesce(f.shifts, 0) AS shifts, coalesce(f.hot_shifts, 0) AS hot_shifts, coalesce(f.predicted_hot_shifts, 0) AS predicted_hot_shifts
FROM bins b LEFT JOIN found f USING (horizon)"""
    q["top_hot_shifts"] = _SCORED + """SELECT shift_date, venue_key_id, persistent_id, hot_probability, predicted_hot FROM judged
ORDER BY hot_probability DESC, shift_date, venue_key_id, persistent_id LIMIT 10"""
    q["confusion_counts"] = _SCORED + "SELECT * FROM confusion"
    q["classification_metrics"] = _SCORED + f""",{_RATES}SELECT CAST(true_positives + true_negatives AS DOUBLE) / n AS accuracy, (SELECT auc_score FROM auc) AS auc_score,
 hp AS precision_hot, hr AS recall_hot, hf AS f1_score, true_positives, false_positives, true_negatives, false_negatives FROM f1s"""
    q["class_report"] = _SCORED + f""",{_RATES}SELECT '0' AS class_label, cp AS "precision", cr AS recall, cf AS f1_score, colds AS support FROM f1s
UNION ALL SELECT '1', hp, hr, hf, hots FROM f1s
UNION ALL SELECT 'accuracy', NULL, NULL, CAST(true_positives + true_negatives AS DOUBLE) / n, n FROM f1s
UNION ALL SELECT 'macro avg', (cp + hp) / 2, (cr + hr) / 2, (cf + hf) / 2, n FROM f1s
UNION ALL SELECT 'weighted avg', (cp * colds + hp * hots) / n, (cr * colds + hr * hots) / n, (cf * colds + hf * hots) / n, n FROM f1s"""
    q["roc_auc"] = _SCORED + "SELECT auc_score FROM auc"
    q["roc_points"] = _SCORED + "SELECT threshold, fp / all_neg AS fpr, tp / all_pos AS tpr FROM curve UNION ALL SELECT NULL, 0, 0"
    q["pr_points"] = _SCORED + "SELECT threshold, tp / (tp + fp) AS \"precision\", tp / all_pos AS recall FROM curve UNION ALL SELECT NULL, 1, 0"
    q["score_histogram"] = _histogram("is_hot")
    q["score_histogram_all"] = _histogram(None)
    q["row_weights"] = _SCORED + """, b AS (SELECT sum(CAST(is_hot = 0 AS BIGINT)) AS n, sum(CAST(is_hot = 1 AS BIGINT)) AS p
  FROM scored WHERE month(shift_date) % 5 <> 0)
SELECT shift_date, venue_key_id, persistent_id, day_prior, is_hot,
 CASE WHEN is_hot = 1 AND b.n > 0 AND b.p > 0 THEN CAST(b.n AS DOUBLE) / b.p ELSE 1.0::DOUBLE END AS weight FROM scored, b"""
    q["fixed_sample"] = _SCORED + """SELECT shift_date, venue_key_id, persistent_id, day_prior, is_hot FROM scored
ORDER BY md5('42|' || CAST(shift_date AS VARCHAR) || '|' || venue_key_id || '|' || persistent_id || '|' || day_prior),
 shift_date, venue_key_id, persistent_id, day_prior LIMIT 200"""
    q["calibration_curve"] = _SCORED + """, bins AS (SELECT CAST(b AS INTEGER) AS bin, b / 10.0::DOUBLE AS lo, (b + 1) / 10.0::DOUBLE AS hi FROM range(10) t(b))
SELECT bin, (2 * bin + 1) / 20.0::DOUBLE AS bin_center, coalesce(avg(is_hot), 0) AS fraction_of_positives, count(is_hot) AS rows
FROM bins LEFT JOIN scored ON hot_probability > lo AND hot_probability <= hi GROUP BY bin"""
    q["stratified_split"] = _stratified()
    marked = _stratified().replace("SELECT * EXCLUDE (h, rn, n)", ", marked AS (SELECT * EXCLUDE (h, rn, n)") + ")"
    q["metrics_by_split"] = _metrics_by(marked, "is_validation")
    q["metrics_by_shift"] = _metrics_by(_SCORED.rstrip() + ", marked AS (SELECT * FROM scored)", "persistent_id, day_of_week")
    return q
