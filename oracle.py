"""SQL that states each registered query on its own terms, over the given tables."""

from __future__ import annotations

from tapwise.sources import sample

TAPS = """
SELECT event_id, user_id AS card_id,
       ts + CASE WHEN user_id % 2 = 1 THEN INTERVAL 182 DAY ELSE INTERVAL 0 DAY END AS ride_start_time,
       CAST((event_id * 7 + user_id) % 9 AS INT) AS operator_id,
       CAST(event_id * 5 % 7 AS INT) AS origin_location,
       CAST((event_id * 3 + 1) % 7 AS INT) AS destination_location,
       CAST(sub_type AS INT) AS fare_transaction_sub_type,
       CAST(event_id * 11 % 6 AS INT) AS route_id,
       CAST(user_id % 5 AS INT) AS fare_category,
       CAST(event_id % 3 * 25 AS BIGINT) AS fare_discount,
       amount AS purse_amount,
       CAST(CASE WHEN event_id % 10 = 0 THEN 520 ELSE event_id % 23 END AS INT) AS contract_id,
       CAST(CASE WHEN user_id % 11 < 10 THEN user_id % 11 END AS INT) AS institution_id
FROM (
  SELECT *, CAST(round(value * 100) AS BIGINT) AS amount,
         CASE event_type WHEN 'error' THEN 3 + 2 * (event_id % 2) WHEN 'click' THEN 2
              WHEN 'purchase' THEN 4 ELSE CASE WHEN event_id % 97 = 0 THEN 9 ELSE 1 END END AS sub_type
  FROM events
  UNION ALL
  SELECT *, CAST(round(value * 100) AS BIGINT) % 300, CASE event_type WHEN 'click' THEN 3 ELSE 5 END
  FROM events WHERE event_type IN ('click', 'purchase') AND event_id % 5 <> 0
)
"""

# Some without a card, some twice, and some with another tag-on beside them.
ODD_TAPS = f"""
SELECT * EXCLUDE (copy) REPLACE (
  CASE WHEN event_id % 37 = 0 THEN NULL ELSE card_id END AS card_id,
  purse_amount + CASE copy WHEN 2 THEN 50 ELSE 0 END AS purse_amount)
FROM ({TAPS}) taps, (VALUES (0), (1), (2)) copies(copy)
WHERE copy = 0 OR (copy = 1 AND event_id % 41 = 0)
   OR (copy = 2 AND event_id % 29 = 0 AND fare_transaction_sub_type IN (1, 2, 4))
"""

FARES = f"""
SELECT t.operator,
       CASE WHEN o.k = 5 THEN '0' ELSE t.operator || ' L' || o.k END AS origin_location,
       CASE WHEN d.k = 5 THEN '0' ELSE t.operator || ' L' || d.k END AS destination_location,
       t.route_type, 2024 AS fare_year, h.fare_month,
       CAST(2 + 0.25 * (o.k + d.k) + CASE h.fare_month WHEN 7 THEN 1 ELSE 0 END AS DECIMAL(10,2))
         AS adult_fare
FROM ({sample.values_sql(("operator", "route_type"), sample.fare_types())}) t,
     range(6) o(k), range(6) d(k), (VALUES (1), (7)) h(fare_month)
"""

# Fixed values, stated here on the oracle's side: participant, LIKE pattern of the route type, label.
LABEL_ROWS = [
    ("Golden Gate Transit", "Marin Transit Route", "Marin Transit"),
    ("Napa Solano", "FAST Local", "FAST"),
    ("Napa Solano", "Napa VINE 29 to BART", "Napa Vine"),
    ("Napa Solano", "Napa VINE Express", "Napa Vine"),
    ("Napa Solano", "Napa VINE Local", "Napa Vine"),
    ("Napa Solano", "SolTrans Express", "SolTrans"),
    ("Napa Solano", "SolTrans S82", "SolTrans"),
    ("Napa Solano", "Vacaville Local", "Vacaville"),
    ("East Bay", "County Connection%", "County Connection"),
    ("East Bay", "TriDelta%", "Tri Delta"),
    ("East Bay", "WestCAT%", "WestCAT"),
    ("East Bay", "Wheels Local", "Wheels"),
    ("Corridor 101", "Petaluma Transit Local Route", "Petaluma"),
    ("Corridor 101", "Santa Rosa City Bus Local Route", "Santa Rosa"),
]
LABELS = sample.values_sql(("participant_name", "pattern", "label"), LABEL_ROWS)

CTES = {
    "fare_tx": TAPS,
    **{table: sample.values_sql(*rows) for table, rows in sample.fixed_rows().items()},
    "fare_table": FARES,
    "labels": LABELS,
    "subset": """
SELECT fare_tx.* EXCLUDE (event_id), coalesce(c.name, 'Undefined') AS fare_category_name
FROM fare_tx LEFT JOIN (VALUES (0, 'Adult'), (1, 'Senior'), (2, 'RTC'), (3, 'Youth')) c(code, name)
  ON c.code = fare_tx.fare_category
WHERE ride_start_time >= TIMESTAMP '2024-01-02'
""",
    "ons": "SELECT * FROM subset WHERE fare_transaction_sub_type IN (1, 2, 4)",
    "offs": "SELECT * FROM subset WHERE fare_transaction_sub_type IN (3, 5)",
    "complete": """
SELECT offs.*, offs.purse_amount * CASE fare_transaction_sub_type WHEN 3 THEN -1 ELSE 1 END
         + CASE fare_transaction_sub_type WHEN 3 THEN paid.amount ELSE 0 END AS fare_charged
FROM (SELECT card_id, ride_start_time, purse_amount AS amount FROM ons) paid
JOIN offs USING (card_id, ride_start_time)
""",
    "off_only": """
SELECT *, purse_amount * CASE fare_transaction_sub_type WHEN 3 THEN -1 ELSE 1 END AS fare_charged
FROM offs WHERE NOT EXISTS (
  FROM ons WHERE ons.card_id = offs.card_id AND ons.ride_start_time = offs.ride_start_time)
""",
    "on_only": """
SELECT *, purse_amount AS fare_charged
FROM ons WHERE NOT EXISTS (
  FROM offs WHERE ons.card_id = offs.card_id AND ons.ride_start_time = offs.ride_start_time)
""",
    "trips": """
SELECT DISTINCT *, CAST(year(ride_start_time) AS INT) AS fare_year,
       CAST(CASE WHEN quarter(ride_start_time) >= 3 THEN 7 ELSE 1 END AS INT) AS fare_month
FROM (SELECT *, 'Tag-on and Tag-off' AS trip_type FROM complete
      UNION ALL BY NAME SELECT *, 'Tag-off Only' AS trip_type FROM off_only
      UNION ALL BY NAME SELECT *, 'Tag-on Only' AS trip_type FROM on_only)
""",
    # Every (operator, route) that occurs, with what is known of it.
    "services": """
SELECT s.operator_id, s.route_id, p.participant_name, rt.route_name, rt.route_type,
       coalesce(labels.label, p.participant_name) AS operator_name
FROM (SELECT DISTINCT operator_id, route_id FROM fare_tx) s
LEFT JOIN participant p ON p.participant_id = s.operator_id
LEFT JOIN route r ON r.participant_id = s.operator_id AND r.route_id = s.route_id
LEFT JOIN route_type rt ON rt.participant_name = p.participant_name
  AND rt.route_name IS NOT DISTINCT FROM r.route_name
LEFT JOIN labels ON labels.participant_name = p.participant_name AND rt.route_type LIKE labels.pattern
""",
    "places": """
SELECT participant_id AS operator_id, location_code AS code, location_name AS place FROM location
""",
    "first_taps": """
SELECT ons.card_id, ride_start_time, operator_name, allowable_transfer_time,
       coalesce(o.place, 'Unknown') AS origin, coalesce(d.place, 'Unknown') AS destination
FROM ons
JOIN services USING (operator_id, route_id)
JOIN transfer_time_rules ON operator_transferred_from = operator_name
LEFT JOIN places o ON o.operator_id = ons.operator_id AND o.code = origin_location
LEFT JOIN places d ON d.operator_id = ons.operator_id AND d.code = destination_location
""",
    "moves": """
SELECT a.card_id, a.operator_name AS trip_1_operator, a.ride_start_time AS trip_1_tag_on_time,
       min(b.ride_start_time) AS trip_2_tag_on_time, a.origin AS trip_1_origin_location_name,
       a.destination AS trip_1_destination_location_name, a.allowable_transfer_time,
       CAST(1 AS INT) AS transfer_flag
FROM first_taps a JOIN ons b ON a.card_id = b.card_id AND a.ride_start_time < b.ride_start_time
WHERE b.ride_start_time - a.ride_start_time < to_minutes(CAST(a.allowable_transfer_time AS INT))
GROUP BY ALL
""",
    "named": """
SELECT t.*, s.participant_name, s.route_name AS known_route, s.route_type AS known_type,
       s.operator_name, o.place AS origin_name, d.place AS destination_name,
       products.description AS product_name
FROM trips t
LEFT JOIN services s USING (operator_id, route_id)
LEFT JOIN places o ON o.operator_id = t.operator_id AND o.code = t.origin_location
LEFT JOIN places d ON d.operator_id = t.operator_id AND d.code = t.destination_location
LEFT JOIN (contract_product LEFT JOIN product USING (issuer_id, product_type)) products
  ON products.contract_type = t.contract_id
""",
    "priced": """
SELECT named.*, f.adult_fare,
       CAST(EXISTS (FROM coupon_contract WHERE id = contract_id) AS INT) AS start_flag,
       CAST(contract_id IS NOT DISTINCT FROM 520 AS INT) AS program_flag
FROM named LEFT JOIN fare_table f
  ON (f.operator, f.origin_location, f.destination_location, f.route_type, f.fare_year, f.fare_month)
   = (participant_name, coalesce(origin_name, '0'), coalesce(destination_name, '0'),
      coalesce(known_type, '0'), named.fare_year, named.fare_month)
""",
    "linked": """
SELECT priced.*, m.transfer_flag AS moved, m.trip_1_operator, m.trip_1_origin_location_name,
       m.trip_1_destination_location_name,
       CAST(m.trip_1_operator IS DISTINCT FROM operator_name AND operator_name IS NOT NULL
            AND m.trip_1_operator IS NOT NULL AS INT) AS interop,
       CAST(coalesce(m.trip_1_operator = operator_name, FALSE) AS INT) AS intraop,
       CASE WHEN m.trip_1_destination_location_name = 'Unknown' THEN coalesce(origin_name, 'Unknown')
            ELSE m.trip_1_destination_location_name END AS transfer_location
FROM priced LEFT JOIN moves m
  ON m.card_id = priced.card_id AND m.trip_2_tag_on_time = priced.ride_start_time
""",
    "discounted": """
SELECT linked.*, coalesce(adult_fare, 0) AS fare,
       coalesce(CAST(r.transfer_discount_available AS INT) * coalesce(adult_fare, 0), 0) AS discount
FROM linked LEFT JOIN transfer_discount_rules r
  ON r.operator_transferred_from = trip_1_operator AND r.operator_transferred_to = operator_name
""",
    "enriched": """
SELECT card_id, ride_start_time, trip_type, fare_discount, fare_charged, fare_category_name,
       institution_id, operator_name, coalesce(origin_name, 'Unknown') AS origin_location_name,
       coalesce(destination_name, 'Unknown') AS destination_location_name, product_name, start_flag,
       program_flag, coalesce(known_route, 'N/A') AS route_name,
       coalesce(known_type, 'N/A') AS route_type_name, adult_fare AS estimated_adult_fare,
       CAST(coalesce(moved, 0) AS INT) AS transfer_flag,
       trip_1_operator AS operator_transferred_from, interop AS interop_transfer_flag,
       intraop AS intraop_transfer_flag, transfer_location, trip_1_origin_location_name,
       trip_1_destination_location_name,
       CAST(discount AS DECIMAL(18,2)) AS estimated_transfer_discount,
       CAST(fare - discount AS DECIMAL(18,2)) AS estimated_adult_fare_with_transfers
FROM discounted
""",
}

RIDE = "card_id, ride_start_time"

FINAL = {
    "fare_tx_subset": "SELECT * FROM subset",
    "card_layout": "SELECT * FROM subset",
    "tag_ons": "SELECT * FROM ons",
    "tag_offs": "SELECT * FROM offs",
    "complete_trips": "SELECT * FROM complete",
    "tagoff_only_trips": "SELECT * FROM off_only",
    "tagon_only_trips": "SELECT * FROM on_only",
    "trips": "SELECT * FROM trips",
    "union_trips": "SELECT * FROM trips",
    "operator_label": f"""
SELECT {RIDE}, operator_id, route_id, participant_name, route_name, route_type, operator_name
FROM subset LEFT JOIN services USING (operator_id, route_id)""",
    "tap_locations": f"""
SELECT {RIDE}, s.operator_id, origin_location, destination_location,
       coalesce(o.place, 'Unknown') AS origin_location_name,
       coalesce(d.place, 'Unknown') AS destination_location_name
FROM subset s
LEFT JOIN places o ON o.operator_id = s.operator_id AND o.code = origin_location
LEFT JOIN places d ON d.operator_id = s.operator_id AND d.code = destination_location""",
    "transfers": "SELECT * FROM moves",
    "transfers_over_cutoff": "SELECT * FROM moves WHERE trip_2_tag_on_time >= TIMESTAMP '2024-01-05 19:30:00'",
    "product_lookup": f"SELECT {RIDE}, trip_type, contract_id, product_name FROM named",
    "program_flags": f"SELECT {RIDE}, trip_type, contract_id, start_flag, program_flag FROM priced",
    "adult_fare_lookup": f"""
SELECT {RIDE}, trip_type, participant_name, fare_year, fare_month, adult_fare AS estimated_adult_fare
FROM priced""",
    "transfer_context": f"""
SELECT {RIDE}, trip_type, operator_name, CAST(coalesce(moved, 0) AS INT) AS transfer_flag,
       trip_1_operator AS operator_transferred_from, interop AS interop_transfer_flag,
       intraop AS intraop_transfer_flag, transfer_location, trip_1_origin_location_name,
       trip_1_destination_location_name
FROM linked""",
    "transfer_discount": f"""
SELECT {RIDE}, trip_type, operator_name, trip_1_operator AS operator_transferred_from,
       adult_fare AS estimated_adult_fare,
       CAST(discount AS DECIMAL(18,2)) AS estimated_transfer_discount,
       CAST(fare - discount AS DECIMAL(18,2)) AS estimated_adult_fare_with_transfers
FROM discounted""",
    "enriched_trips": "SELECT * FROM enriched",
    "enriched_over_cutoff": "SELECT * FROM enriched WHERE ride_start_time >= TIMESTAMP '2024-01-05 19:30:00'",
    "enrich": "SELECT * FROM enriched",
    "enrich_stored": "SELECT * FROM enriched",
    "all_period_trips": "SELECT DISTINCT * FROM enriched",
    "full_refresh": "SELECT DISTINCT * FROM enriched",
}


ODD = {
    "odd_trips": "SELECT * FROM trips",
    "odd_transfers": "SELECT * FROM moves",
    "odd_enriched_trips": "SELECT * FROM enriched",
}


def oracle_sql() -> dict[str, str]:
    def over(taps: str, finals: dict[str, str]) -> dict[str, str]:
        steps = ",\n".join(f"{name} AS ({text.strip()})" for name, text in (CTES | {"fare_tx": taps}).items())
        return {name: f"WITH {steps}\n{final.strip()}" for name, final in finals.items()}

    return over(TAPS, FINAL) | over(ODD_TAPS, ODD)
