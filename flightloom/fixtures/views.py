"""Derived views over the test tables, as SQL text that Spark and DuckDB both accept.

Roles: a ``lineitem`` row is a flight event, a ``part`` an aircraft, ``p_brand`` the
airline; ``l_suppkey`` picks the airports.
"""

# The airports in scope.
AIRPORTS = """
select * from (values
 ('LFPG','CDG','Charles de Gaulle','Paris','France'),
 ('EGLL','LHR','Heathrow','London','United Kingdom'),
 ('EHAM','AMS','Schiphol','Amsterdam','Netherlands'),
 ('EDDF','FRA','Frankfurt','Frankfurt','Germany'),
 ('LEMD','MAD','Adolfo Suárez Barajas','Madrid','Spain'),
 ('LIRF','FCO','Leonardo da Vinci Fiumicino','Rome','Italy'),
 ('LEBL','BCN','El Prat','Barcelona','Spain'),
 ('EBBR','BRU','Brussels','Brussels','Belgium'),
 ('LSZH','ZRH','Zurich','Zurich','Switzerland'),
 ('LPPT','LIS','Humberto Delgado','Lisbon','Portugal')
) as t(icao_code, iata_code, name, city, country)
"""

RAW_FLIGHTS = """
with base as (
 select 'ac' || lpad(cast(l_partkey as string), 6, '0') as icao24,
  {EPOCH} + (l_orderkey * 7919 + l_linenumber * 613 + l_suppkey * 31) % 86400 as first_seen,
  (cast(l_quantity as bigint) - 2) * 331 as dur,
  case when l_linestatus = 'O' then 'departure' else 'arrival' end as flight_type,
  case l_suppkey % 12 when 0 then 'EGLL' when 1 then 'LFPG' when 2 then 'EHAM' when 3 then 'EDDF'
   when 4 then 'LEMD' when 5 then 'LIRF' when 6 then 'LEBL' when 7 then 'EBBR' when 8 then 'LSZH'
   when 9 then 'LPPT' when 10 then 'KJFK' end as est_departure_airport,
  case (l_suppkey + l_linenumber * 5) % 12 when 0 then 'EGLL' when 1 then 'LFPG' when 2 then 'EHAM'
   when 3 then 'EDDF' when 4 then 'LEMD' when 5 then 'LIRF' when 6 then 'LEBL' when 7 then 'EBBR'
   when 8 then 'LSZH' when 9 then 'LPPT' when 10 then 'KJFK' end as est_arrival_airport,
  'FL' || cast(l_orderkey % 1000 as string) || '  ' as callsign,
  l_orderkey, l_linenumber
 from lineitem)
select icao24, first_seen, est_departure_airport, first_seen + dur as last_seen, est_arrival_airport,
 callsign, flight_type, cast(1700000000 + l_linenumber as string) as _dlt_load_id from base
union all
select icao24, first_seen, est_departure_airport, first_seen + dur + 60, est_arrival_airport,
 callsign, flight_type, cast(1700086400 + l_linenumber as string) from base where l_orderkey % 20 = 0
union all
select icao24, cast(null as bigint), est_departure_airport, cast(null as bigint), est_arrival_airport,
 callsign, flight_type, cast(1700000000 as string) from base where l_orderkey % 500 = 0
"""

AIRCRAFT_ALL = """
select p_partkey, 'ac' || lpad(cast(p_partkey as string), 6, '0') as icao24,
 case p_partkey % 10 when 0 then 'AIRBUS SAS' when 1 then 'The Boeing Company' when 2 then 'Boing'
  when 3 then 'Empresa Brasileira De Aeronautica' when 4 then 'EMBRAER S.A.' when 5 then 'bombardier inc'
  when 6 then 'Dassault Aviation' when 7 then 'Gulfstream Aerospace' when 8 then 'Cessna'
  end as manufacturername,
 p_type as model, 'T' || cast(p_size as string) as typecode,
 case when p_partkey % 7 = 0 then '  '
  else ' Op ' || p_brand || '/' || cast(p_partkey % 3 as string) || ' ' end as operator,
 upper(p_name) as operatorcallsign,
 case when p_partkey % 7 = 0 then '' else replace(p_brand, 'Brand#', 'B') end as operatoricao,
 case when p_partkey % 13 = 0 then ' ' else substr(p_brand, 7, 2) end as operatoriata
from part
"""

RAW_AIRCRAFT = """
select * from aircraft_all where p_partkey % 11 <> 0
union all
select * from aircraft_all where p_partkey % 11 <> 0 and p_partkey % 50 = 1
"""

RAW_AIRCRAFT_V2 = """
select p_partkey, icao24, manufacturername,
 case when p_partkey % 5 = 3 then model || ' MK2' else model end as model, typecode,
 case when p_partkey % 5 = 2 then 'New Op' else operator end as operator,
 operatorcallsign, operatoricao, operatoriata
from aircraft_all
where p_partkey % 17 <> 0 and (p_partkey % 11 <> 0 or p_partkey % 2 = 0)
"""
