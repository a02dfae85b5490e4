"""DuckDB SQL equal in meaning to each registered query (the correctness
oracle).  Written independently of the Spark plans: plain window functions,
joins and recursive CTEs over the driver's tables."""

from __future__ import annotations

HOUR = 3_600_000
DAY = 86_400_000

# Bindings (same definitions as auctionflow.sources.bindings).
EV = """ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS ts, user_id + 1 AS person_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, value, event_type,
         ((event_id * 7919) % 25) * 3600000 AS delay
  FROM events)"""
PERSONS = """persons AS (
  SELECT ts, person_id,
         'F' || CAST(person_id AS VARCHAR) || ' ' || 'L' || CAST(k AS VARCHAR) AS name,
         'F' || CAST(person_id AS VARCHAR) || '.' || 'L' || CAST(k AS VARCHAR) || '@mail' || CAST(k % 7 AS VARCHAR) || '.com' AS email,
         'city' || CAST(k % 13 AS VARCHAR) AS city,
         'country' || CAST(person_id % 5 AS VARCHAR) AS country,
         CAST(event_id % 1000 - 500 AS VARCHAR) AS province,
         CAST(event_id % 97 AS VARCHAR) AS zipcode,
         'F' || CAST(person_id AS VARCHAR) || '.' || 'L' || CAST(k AS VARCHAR) || '@mail' || CAST(k % 7 AS VARCHAR) || '.com' AS homepage,
         CAST(event_id * 1000003 AS VARCHAR) AS creditcard,
         ts + delay AS ingestion_ts
  FROM ev WHERE event_type = 'signup')"""
AUCTIONS = """auctions AS (
  SELECT ts, k AS auction_id, person_id, event_id AS item_id, value AS initial_price,
         ts AS "start", ts + 86400000 AS "end", event_id % 10 AS category_id, ts + delay AS ingestion_ts,
         'item' || CAST(k AS VARCHAR) AS name, 'auction ' || CAST(event_id AS VARCHAR) AS descr
  FROM ev WHERE event_type = 'view')"""
BIDS = """bids AS (
  SELECT ts + delay AS ingestion_ts, ts, k AS auction_id, person_id, event_id AS bid_id, value AS bid
  FROM ev WHERE event_type IN ('click', 'purchase'))"""
VBIDS = """vbids AS (
  SELECT epoch_us(l_shipdate) // 1000 + (((l_orderkey * 8 + l_linenumber) * 7919) % 25) * 3600000 AS ingestion_ts,
         epoch_us(l_shipdate) // 1000 AS ts, l_orderkey AS auction_id, l_suppkey + 1 AS person_id,
         l_orderkey * 8 + l_linenumber AS bid_id, l_extendedprice AS bid
  FROM lineitem)"""
VAUCTIONS = """vauctions AS (
  SELECT epoch_us(o_orderdate) // 1000 AS ts, o_orderkey AS auction_id, o_custkey + 1 AS person_id,
         o_orderkey AS item_id, o_totalprice AS initial_price, epoch_us(o_orderdate) // 1000 AS "start",
         epoch_us(o_orderdate) // 1000 + 31536000000 AS "end", o_orderkey % 10 AS category_id,
         epoch_us(o_orderdate) // 1000 + ((o_orderkey * 7919) % 25) * 3600000 AS ingestion_ts,
         'order' || CAST(o_orderkey AS VARCHAR) AS name, o_orderpriority AS descr
  FROM orders)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _bid_stats_window(size: int, slide: int) -> str:
    n = size // slide
    return with_(EV, BIDS, f"""w AS (
  SELECT b.*, (ts - ts % {slide}) - r.k * {slide} AS ws
  FROM bids b, range(0, {n}) AS r(k))""") + f"""
SELECT ws AS window_start, ws + {size} AS window_end, auction_id, max(bid) AS max_price,
       max(ts) AS last_ts, arg_max(ingestion_ts, (ts, -ingestion_ts)) AS last_ingestion_ts,
       count(*) AS bid_count
FROM w GROUP BY ws, auction_id"""


def _sessions(gap: int) -> str:
    return f"""o AS (
  SELECT person_id, ts, ingestion_ts,
         CASE WHEN lag(ts) OVER (PARTITION BY person_id ORDER BY ts) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY person_id ORDER BY ts) > {gap} THEN 1 ELSE 0 END AS nw
  FROM bids),
s AS (SELECT *, sum(nw) OVER (PARTITION BY person_id ORDER BY ts, nw DESC ROWS UNBOUNDED PRECEDING) AS sid FROM o),
sess AS (
  SELECT person_id, min(ts) AS session_start, max(ts) + {gap} AS session_end, max(ts) AS last_ts,
         max(ingestion_ts) AS last_ingestion_ts, count(*) AS bid_count
  FROM s GROUP BY person_id, sid)"""


def _new_user_windows(size: int, slide: int) -> str:
    n = size // slide
    return with_(EV, PERSONS, AUCTIONS, f"""pw AS (
  SELECT p.person_id, p.ts, p.ingestion_ts, (p.ts - p.ts % {slide}) - r.k * {slide} AS ws
  FROM persons p, range(0, {n}) AS r(k)),
aw AS (
  SELECT a.person_id, (a.ts - a.ts % {slide}) - r.k * {slide} AS ws,
         arg_max(a.ts, (a.ingestion_ts, -a.ts, -a.auction_id)) AS ats,
         max(a.ingestion_ts) AS aing
  FROM auctions a, range(0, {n}) AS r(k) GROUP BY 1, 2)""") + f"""
SELECT pw.ws + {size} AS window_evicting_ts, pw.ts AS person_creation_ts, pw.ingestion_ts AS person_ingestion_ts,
       aw.ats AS auction_creation_ts, aw.aing AS auction_ingestion_ts, pw.person_id
FROM pw JOIN aw ON pw.person_id = aw.person_id AND pw.ws = aw.ws"""


def _new_user_session(gap: int) -> str:
    return with_(EV, PERSONS, AUCTIONS, f"""u AS (
  SELECT person_id, ts, ingestion_ts, 1 AS side, NULL::BIGINT AS auction_id FROM persons
  UNION ALL SELECT person_id, ts, ingestion_ts, 2, auction_id FROM auctions),
o AS (
  SELECT *, CASE WHEN lag(ts) OVER (PARTITION BY person_id ORDER BY ts) IS NULL
                   OR ts - lag(ts) OVER (PARTITION BY person_id ORDER BY ts) > {gap} THEN 1 ELSE 0 END AS nw
  FROM u),
s AS (SELECT *, sum(nw) OVER (PARTITION BY person_id ORDER BY ts, nw DESC ROWS UNBOUNDED PRECEDING) AS sid FROM o),
b AS (SELECT person_id, sid, max(ts) + {gap} AS send FROM s GROUP BY 1, 2),
a AS (
  SELECT person_id, sid, arg_max(ts, (ingestion_ts, -ts, -auction_id)) AS ats, max(ingestion_ts) AS aing
  FROM s WHERE side = 2 GROUP BY 1, 2)""") + """
SELECT b.send AS window_evicting_ts, s.ts AS person_creation_ts, s.ingestion_ts AS person_ingestion_ts,
       a.ats AS auction_creation_ts, a.aing AS auction_ingestion_ts, s.person_id
FROM s JOIN a ON s.person_id = a.person_id AND s.sid = a.sid
       JOIN b ON s.person_id = b.person_id AND s.sid = b.sid
WHERE s.side = 1"""


def _sample(phase: str) -> str:
    keep = "seq % 7 = 0" if phase == "nth" else "(seq - 1) % 7 = 0"
    return with_(EV, BIDS, """n AS (
  SELECT *, CAST(abs(auction_id) % 4 AS INTEGER) AS subtask FROM bids),
r AS (SELECT *, row_number() OVER (PARTITION BY subtask ORDER BY ts, ingestion_ts, bid_id) AS seq FROM n)""") + f"""
SELECT ingestion_ts, ts, auction_id, person_id, bid_id, bid, subtask, seq FROM r WHERE {keep}"""


ORACLE: dict[str, str] = {
    "bid_stats_tumbling": _bid_stats_window(DAY, DAY),
    "bid_stats_sliding": _bid_stats_window(DAY, HOUR),
    "bid_stats_volume": with_(VBIDS) + """
SELECT auction_id, year(make_timestamp(ts * 1000)) AS year, max(bid) AS max_price, max(ts) AS last_ts,
       arg_max(ingestion_ts, (ts, -ingestion_ts)) AS last_ingestion_ts, count(*) AS bid_count
FROM vbids GROUP BY 1, 2""",
    "bidder_sessions": with_(EV, BIDS, _sessions(6 * HOUR)) + """
SELECT person_id, session_start, session_end, last_ts, last_ingestion_ts, bid_count FROM sess""",
    "highest_session_per_window": with_(EV, BIDS, _sessions(6 * HOUR)) + f"""
SELECT (session_end - 1) - (session_end - 1) % {DAY} AS window_start,
       (session_end - 1) - (session_end - 1) % {DAY} + {DAY} AS window_end,
       arg_max(person_id, (last_ts, -person_id, -session_start)) AS person_id,
       arg_max(session_start, (last_ts, -person_id, -session_start)) AS session_start,
       arg_max(session_end, (last_ts, -person_id, -session_start)) AS session_end,
       max(last_ts) AS last_ts,
       arg_max(last_ingestion_ts, (last_ts, -person_id, -session_start)) AS last_ingestion_ts,
       arg_max(bid_count, (last_ts, -person_id, -session_start)) AS bid_count
FROM sess GROUP BY 1, 2""",
    "new_user_auctions_tumbling": _new_user_windows(6 * HOUR, 6 * HOUR),
    "new_user_auctions_sliding": _new_user_windows(DAY, 6 * HOUR),
    "new_user_auctions_session": _new_user_session(6 * HOUR),
    "tagged_union": with_(EV, PERSONS, AUCTIONS) + """
SELECT person_id AS key, ts AS one_ts, ingestion_ts AS one_ingestion_ts, NULL::BIGINT AS two_ts,
       NULL::BIGINT AS two_ingestion_ts, NULL::BIGINT AS two_auction_id FROM persons
UNION ALL
SELECT person_id, NULL, NULL, ts, ingestion_ts, auction_id FROM auctions""",
    "connect_persons_auctions": with_(EV, PERSONS, AUCTIONS, """r AS (
  SELECT *, row_number() OVER (PARTITION BY abs(person_id) % 4
                               ORDER BY ts, ingestion_ts, auction_id, person_id, item_id) AS seq
  FROM auctions)""") + """
SELECT 0::BIGINT AS window_evicting_ts, ts AS person_creation_ts, ingestion_ts AS person_ingestion_ts,
       0::BIGINT AS auction_creation_ts, 0::BIGINT AS auction_ingestion_ts, person_id FROM persons
UNION ALL
SELECT 0, 0, 0, ts, ingestion_ts, -person_id FROM r WHERE seq % 100 = 0""",
    "person_auction_state": with_(EV, PERSONS, AUCTIONS, """p AS (
  SELECT person_id, arg_max(ts, (ts, ingestion_ts)) AS person_ts,
         arg_max(ingestion_ts, (ts, ingestion_ts)) AS person_ingestion_ts, count(*) AS person_events
  FROM persons GROUP BY 1),
a AS (
  SELECT person_id, count(*) AS auction_count, min(ts) AS first_auction_ts, max(ts) AS last_auction_ts,
         max(ingestion_ts) AS last_auction_ingestion_ts
  FROM auctions GROUP BY 1)""") + """
SELECT coalesce(p.person_id, a.person_id) AS person_id, person_ts, person_ingestion_ts,
       coalesce(person_events, 0) AS person_events, coalesce(auction_count, 0) AS auction_count,
       first_auction_ts, last_auction_ts, last_auction_ingestion_ts
FROM p FULL JOIN a ON p.person_id = a.person_id""",
    "sample_every_nth": _sample("nth"),
    "sample_every_first": _sample("first"),
}


def with_rec(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _chain(src: str, key: str, close_expr: str, tie: str) -> list[str]:
    """Round openers of ``src`` (one row per key and ts, with columns ts and
    the close expression) as CTEs a (ranked), nx (next candidate), r
    (recursive chain) and o (openers with next opener rank)."""
    return [f"""a AS (
  SELECT *, {close_expr} AS close, row_number() OVER (PARTITION BY {key} ORDER BY ts{tie}) AS rn FROM {src})""",
            f"""nx AS (
  SELECT a.*, (SELECT min(b.rn) FROM a b WHERE b.{key} = a.{key} AND b.rn > a.rn AND b.ts >= a.close) AS nxt
  FROM a)""",
            f"""r AS (
  SELECT {key}, rn, nxt, 1::BIGINT AS round_no FROM nx WHERE rn = 1
  UNION ALL
  SELECT nx.{key}, nx.rn, nx.nxt, r.round_no + 1 FROM r JOIN nx ON nx.{key} = r.{key} AND nx.rn = r.nxt)""",
            f"""o AS (
  SELECT r.{key}, r.round_no, r.rn, nx.ts AS open_ts, nx.close AS close_ts,
         lead(r.rn) OVER (PARTITION BY r.{key} ORDER BY r.rn) AS next_rn
  FROM r JOIN nx ON nx.{key} = r.{key} AND nx.rn = r.rn)"""]


def _auction_rounds_ctes(src: str) -> list[str]:
    first = f"""f AS (
  SELECT auction_id, ts, arg_min("end", (ingestion_ts, item_id)) AS close0, count(*) AS n
  FROM {src} GROUP BY 1, 2)"""
    return [first] + _chain("f", "auction_id", "close0", "") + ["""rounds AS (
  SELECT o.auction_id, o.round_no, o.open_ts, o.close_ts, CAST(sum(a.n) AS BIGINT) AS auctions_in_round
  FROM o JOIN a ON a.auction_id = o.auction_id AND a.rn >= o.rn AND (o.next_rn IS NULL OR a.rn < o.next_rn)
  GROUP BY 1, 2, 3, 4)"""]


def _last_bids_ctes(bids: str, strict: bool) -> list[str]:
    cond = " AND b.ts >= o.open_ts" if strict else ""
    # one row per bid row (bids may repeat exactly, so no grouping by identity)
    return [f"""own AS (
  SELECT * FROM (
    SELECT b.auction_id, b.ts, b.ingestion_ts,
           (SELECT min(o.close_ts) FROM rounds o WHERE o.auction_id = b.auction_id AND o.close_ts > b.ts) AS close_ts
    FROM {bids} b) WHERE close_ts IS NOT NULL)""", f"""lastbids AS (
  SELECT o.auction_id, o.round_no, o.close_ts, max(w.ts) AS last_ts, max(w.ingestion_ts) AS last_ingestion_ts,
         count(*) AS bid_count
  FROM own w JOIN rounds o ON o.auction_id = w.auction_id AND o.close_ts = w.close_ts
  WHERE TRUE{cond.replace('b.ts', 'w.ts')}
  GROUP BY 1, 2, 3 HAVING max(w.ts) > 0)"""]


def _bid_rounds_ctes(duration: int) -> list[str]:
    first = """g AS (
  SELECT auction_id, ts, max(bid) AS mx, count(*) AS n, min(ingestion_ts) AS ing FROM bids GROUP BY 1, 2)"""
    return [first] + _chain("g", "auction_id", f"ts + {duration}", "") + ["""bround AS (
  SELECT o.auction_id, o.round_no, o.open_ts AS round_start, o.close_ts AS round_end, max(a.mx) AS max_price,
         max(a.ts) AS last_ts, arg_max(a.ing, a.ts) AS last_ingestion_ts, CAST(sum(a.n) AS BIGINT) AS bid_count
  FROM o JOIN a ON a.auction_id = o.auction_id AND a.rn >= o.rn AND (o.next_rn IS NULL OR a.rn < o.next_rn)
  GROUP BY 1, 2, 3, 4)"""]


def _connect_ctes(n: int, subtasks: int) -> list[str]:
    return [f"""cr AS (
  SELECT *, row_number() OVER (PARTITION BY abs(person_id) % {subtasks}
                               ORDER BY ts, ingestion_ts, auction_id, person_id, item_id) AS seq
  FROM auctions)""", f"""conn AS (
  SELECT 0::BIGINT AS window_evicting_ts, ts AS person_creation_ts, ingestion_ts AS person_ingestion_ts,
         0::BIGINT AS auction_creation_ts, 0::BIGINT AS auction_ingestion_ts, person_id FROM persons
  UNION ALL
  SELECT 0, 0, 0, ts, ingestion_ts, -person_id FROM cr WHERE seq % {n} = 0)"""]


def _std(n: str, s: str, ss: str) -> str:
    return (f"CASE WHEN {n} > 1 THEN sqrt(CAST({n}::HUGEINT * {ss} - {s}::HUGEINT * {s} AS DOUBLE) "
            f"/ CAST({n} * ({n} - 1) AS DOUBLE)) WHEN {n} = 1 THEN 0.0 END")


def _running(src: str, series: dict[str, str], order: str, with_std: bool) -> str:
    """Running statistics per subtask over ``src`` (columns subtask,
    processed_ts, the series and _emit)."""
    w = f"(PARTITION BY subtask ORDER BY processed_ts, {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    sel = ["subtask", "processed_ts AS ts"]
    cnt, mean, mn, mx, std, sm = [], [], [], [], [], []
    for s, name in series.items():
        c, su, ss = f"count({s}) OVER {w}", f"sum({s}) OVER {w}", f"sum({s}::HUGEINT * {s}) OVER {w}"
        cnt.append(f"{c} AS {name}Count")
        mean.append(f"CASE WHEN {c} > 0 THEN {su} / {c} END AS {name}Mean")
        mn.append(f"min({s}) OVER {w} AS {name}Min")
        mx.append(f"max({s}) OVER {w} AS {name}Max")
        std.append(f"{_std(c, su, ss)} AS {name}Std")
        sm.append(f"CAST({su} AS BIGINT) AS {name}Sum")
    cols = sel + cnt + mean + (std if with_std else []) + mn + mx + (sm if with_std else [])
    return f"SELECT * EXCLUDE (_emit) FROM (SELECT {', '.join(cols)}, _emit FROM {src}) WHERE _emit"


def _bid_latency(src: str, processed: str, key: str, order: str, with_std: bool) -> str:
    return f""", lat AS (
  SELECT CAST(abs({key}) % 4 AS INTEGER) AS subtask, {processed} AS processed_ts, *,
         CASE WHEN {processed} - last_ts <= 600000 THEN {processed} - last_ts END AS bidl,
         CASE WHEN {processed} - last_ts <= 600000 THEN {processed} - last_ingestion_ts END AS flight,
         ({processed} - last_ts <= 600000) AS _emit
  FROM {src})
""" + _running("lat", {"bidl": "bidLatency", "flight": "flightTime"}, order, with_std)


ORACLE.update({
    "auction_rounds": with_rec(EV, AUCTIONS, *_auction_rounds_ctes("auctions")) + "SELECT * FROM rounds",
    "open_auctions": with_rec(EV, AUCTIONS, *_auction_rounds_ctes("auctions")) +
    "SELECT auction_id, round_no, open_ts, close_ts FROM rounds",
    "last_bids_per_round": with_rec(EV, AUCTIONS, BIDS, *_auction_rounds_ctes("auctions"),
                                    *_last_bids_ctes("bids", False)) + "SELECT * FROM lastbids",
    "last_bids_per_round_strict": with_rec(EV, AUCTIONS, BIDS, *_auction_rounds_ctes("auctions"),
                                           *_last_bids_ctes("bids", True)) + "SELECT * FROM lastbids",
    "round_bids_volume": with_rec(VAUCTIONS, VBIDS, *_auction_rounds_ctes("vauctions"),
                                  *_last_bids_ctes("vbids", True)) + "SELECT * FROM lastbids",
    "bid_rounds": with_rec(EV, BIDS, *_bid_rounds_ctes(DAY)) + "SELECT * FROM bround",
    "bid_chunks": with_(EV, BIDS, """r AS (
  SELECT *, row_number() OVER (PARTITION BY auction_id ORDER BY ts, ingestion_ts, bid_id) AS seq FROM bids)""") + """
SELECT auction_id, (seq - 1) // 32 AS chunk, count(*) AS bid_count, min(ts) AS first_ts, max(ts) AS last_ts,
       max(ingestion_ts) AS last_ingestion_ts, max(bid) AS max_price
FROM r GROUP BY 1, 2""",
    "latency_q8": with_(EV, PERSONS, AUCTIONS, *_connect_ctes(5, 4)) + """, lat AS (
  SELECT CAST(abs(person_id) % 4 AS INTEGER) AS subtask,
         greatest(person_ingestion_ts, auction_ingestion_ts) AS processed_ts, *,
         CASE WHEN person_id > 0 AND greatest(person_ingestion_ts, auction_ingestion_ts) - person_creation_ts < 600000
              THEN greatest(person_ingestion_ts, auction_ingestion_ts) - person_creation_ts END AS person,
         CASE WHEN person_id <= 0 AND greatest(person_ingestion_ts, auction_ingestion_ts) - auction_creation_ts <= 600000
              THEN greatest(person_ingestion_ts, auction_ingestion_ts) - auction_creation_ts END AS auction,
         CASE WHEN person_id <= 0 AND greatest(person_ingestion_ts, auction_ingestion_ts) - auction_creation_ts <= 600000
              THEN greatest(person_ingestion_ts, auction_ingestion_ts) - auction_ingestion_ts END AS flight,
         (person_id <= 0 AND greatest(person_ingestion_ts, auction_ingestion_ts) - auction_creation_ts <= 600000) AS _emit
  FROM conn)
""" + _running("lat", {"person": "person", "auction": "auction", "flight": "flightTime"},
               "person_creation_ts, auction_creation_ts, person_id", False),
    "latency_q5": with_rec(EV, BIDS, *_bid_rounds_ctes(HOUR)) +
    _bid_latency("bround", "round_end", "auction_id", "last_ts, last_ingestion_ts, auction_id, round_no", False),
    "latency_session": with_(EV, BIDS, _sessions(5 * 60_000)) +
    _bid_latency("sess", "session_end", "person_id", "last_ts, last_ingestion_ts, person_id, session_start", False),
    "latency_winning": with_rec(EV, AUCTIONS, BIDS, *_auction_rounds_ctes("auctions"),
                                *_last_bids_ctes("bids", False)) +
    _bid_latency("lastbids", "close_ts", "auction_id", "last_ts, last_ingestion_ts, auction_id, round_no", True),
    "latency_quantiles": with_(EV, BIDS) + f""", st AS (
  SELECT ts - ts % {DAY} + {DAY} AS we, max(ts) AS last_ts, arg_max(ingestion_ts, (ts, -ingestion_ts)) AS last_ing
  FROM bids GROUP BY ts - ts % {DAY}, auction_id),
v AS (SELECT we - last_ts AS bid, we - last_ing AS flight FROM st),
r AS (SELECT bid, flight, row_number() OVER (ORDER BY bid) AS rb, row_number() OVER (ORDER BY flight) AS rf,
             count(*) OVER () AS n FROM v)
SELECT """ + ", ".join(f"min({c}) FILTER (WHERE {r} >= ceil({q}::DOUBLE * n)) AS {c}_p{round(100 * q)}"
                       for c, r in (("bid", "rb"), ("flight", "rf")) for q in (0.5, 0.9, 0.99)) + """
FROM r""",
    "latency_summary": with_(EV, BIDS) + f""", st AS (
  SELECT ts - ts % {DAY} + {DAY} AS we, max(ts) AS last_ts, arg_max(ingestion_ts, (ts, -ingestion_ts)) AS last_ing
  FROM bids GROUP BY ts - ts % {DAY}, auction_id),
v AS (SELECT we - last_ts AS bid, we - last_ing AS flight FROM st),
agg AS (SELECT count(bid) AS bn, sum(bid) AS bs, min(bid) AS bmin, max(bid) AS bmax, sum(bid::HUGEINT * bid) AS bss,
               count(flight) AS fn, sum(flight) AS fs, min(flight) AS fmin, max(flight) AS fmax,
               sum(flight::HUGEINT * flight) AS fss FROM v)
SELECT bn AS bid_count, bs / bn AS bid_mean, bmin AS bid_min, bmax AS bid_max, CAST(bs AS BIGINT) AS bid_sum,
       {_std('bn', 'bs', 'bss')} AS bid_std,
       fn AS flight_count, fs / fn AS flight_mean, fmin AS flight_min, fmax AS flight_max,
       CAST(fs AS BIGINT) AS flight_sum, {_std('fn', 'fs', 'fss')} AS flight_std
FROM agg""",
})


def _paged(src: str, key: str, order: str, cap: int) -> str:
    return f"""pg AS (
  SELECT *, ({key}) % 2 AS part,
         (row_number() OVER (PARTITION BY ({key}) % 2 ORDER BY {order}) - 1) // {cap} AS page
  FROM {src}),
pt AS (SELECT *, max(ts) OVER (PARTITION BY part, page) AS page_ts FROM pg)"""


ORACLE.update({
    "pages_bids_roundtrip": with_(EV, BIDS, _paged("bids", "auction_id", "ts, bid_id", 255)) + """
SELECT page_ts AS ingestion_ts, ts, auction_id, person_id, -1::BIGINT AS bid_id, bid FROM pt""",
    "pages_auctions_roundtrip": with_(EV, AUCTIONS, _paged("auctions", "auction_id", "ts, item_id", 30)) + """
SELECT ts, auction_id, person_id, item_id, CAST(CAST(trunc(initial_price) AS INTEGER) AS DOUBLE) AS initial_price,
       "start", "end", category_id, page_ts AS ingestion_ts, name, descr FROM pt""",
    "pages_persons_roundtrip": with_(EV, PERSONS, _paged("(SELECT p.*, e.event_id * 1000003 AS card0 FROM persons p "
                                                         "JOIN ev e ON e.event_type = 'signup' AND "
                                                         "CAST(e.event_id * 1000003 AS VARCHAR) = p.creditcard)",
                                                         "person_id", "ts, card0", 39)) + """
SELECT ts, person_id, name, email, city, country, province, zipcode, homepage, creditcard,
       page_ts AS ingestion_ts FROM pt""",
    "page_progress": with_(EV, BIDS, """c AS (SELECT auction_id % 2 AS part, count(*) AS n FROM bids GROUP BY 1)""") + """
SELECT 'bids' AS topic, CAST(part AS INTEGER) AS "partition", CAST((n + 254) // 255 AS BIGINT) AS pages,
       CAST(n AS BIGINT) AS items, CAST(n - ((n + 254) // 255 - 1) * 255 AS BIGINT) AS min_backlog,
       TRUE AS is_complete
FROM c""",
})


# Generators: the same portable hash written out for DuckDB.
from auctionflow.functions.hashing import portable_hash_sql  # noqa: E402
from auctionflow.sources import generate as _g  # noqa: E402


def _r(salt: int, seed: int = 42) -> str:
    return portable_hash_sql(f"e * 64 + subtask + {seed * 7919}", salt)


def _lst(values: list[str], r: str) -> str:
    lit = "[" + ", ".join("'" + v + "'" for v in values) + "]"
    return f"{lit}[CAST(({r}) % {len(values)} AS BIGINT) + 1]"


GEN_BASE = f"""c AS (
  SELECT CAST(event_id % 4 AS INTEGER) AS subtask, event_id // 4 AS e FROM events),
g AS (
  SELECT subtask, e, e // 9 AS epoch, e % 9 AS "offset", subtask * 10800000::BIGINT AS min_person,
         subtask * 10800000000::BIGINT AS min_auction, {_g.DEFAULT_BASE_MS}::BIGINT + (e * 1000) // {_g.DEFAULT_RATE} AS ts
  FROM c)"""


def _pool(width: int, seed: int = 42) -> str:
    h = portable_hash_sql(f"id * 1024 + i + {seed * 7919 + width}", 31)
    return f"""p{width} AS (
  SELECT id AS pool_id,
         array_to_string(list_transform(range(0, {width}),
             lambda i: CASE WHEN ({h}) % 13 = 0 THEN ' ' ELSE chr(CAST(({h}) % 26 + 97 AS INTEGER)) END), '') AS txt
  FROM range(0, 2000) t(id))"""


ORACLE.update({
    "gen_persons": with_(GEN_BASE) + f"""
SELECT ts, min_person + epoch AS person_id,
       {_lst(_g.FIRST_NAMES, _r(4))} || ' ' || {_lst(_g.LAST_NAMES, _r(5))} AS name,
       {_lst(_g.DOMAINS, _r(3))} AS email, {_lst(_g.CITIES, _r(1))} AS city,
       {_lst(_g.COUNTRIES, _r(2))} AS country, {_lst(_g.DOMAINS, _r(6))} AS province,
       NULL::VARCHAR AS zipcode, {_lst(_g.FIRST_NAMES, _r(7))} AS homepage, '00000000000' AS creditcard,
       ts AS ingestion_ts
FROM g""",
    "gen_auctions": with_(GEN_BASE, _pool(20), _pool(200), f"""a AS (
  SELECT ts,
         min_auction + (CASE WHEN "offset" < 1 THEN epoch - 1 ELSE epoch END) * 4 + 3 AS auction_id,
         CASE WHEN ({_r(11)}) % 100 > 85 THEN min_person + (epoch // 100) * 100
              ELSE min_person + (epoch + 1) + least(epoch + 1, 20000)
                   - ({_r(12)}) % (least(epoch + 1, 20000) + 100) END AS person_id,
         ({_r(13)}) % 2000 AS n20, ({_r(14)}) % 2000 AS n200
  FROM g)""") + """
SELECT ts, auction_id, person_id, 0::BIGINT AS item_id, 0.0::DOUBLE AS initial_price, ts AS "start",
       ts + 10000 AS "end", 0::BIGINT AS category_id, ts AS ingestion_ts, p20.txt AS name, p200.txt AS descr
FROM a JOIN p20 ON p20.pool_id = a.n20 JOIN p200 ON p200.pool_id = a.n200""",
    "gen_bids": with_(GEN_BASE, """b AS (SELECT *, epoch * 4 + 3 AS bb, greatest(0, epoch * 4 + 3 - 20000) AS lo FROM g)""") + f"""
SELECT ts AS ingestion_ts, ts,
       abs(min_auction + CASE WHEN ({_r(21)}) % 100 > 85 THEN (bb // 100) * 100
                              ELSE lo + ({_r(22)}) % (bb - lo + 101) END) AS auction_id,
       abs(CASE WHEN ({_r(23)}) % 100 > 85 THEN min_person + (epoch // 100) * 100
                ELSE min_person + epoch + least(epoch, 60000) - ({_r(24)}) % (least(epoch, 60000) + 100) END) AS person_id,
       -1::BIGINT AS bid_id, (({_r(25)}) % 1000000000) / 100.0 AS bid
FROM b""",
})


ORACLE["bid_round_snapshots"] = with_rec(EV, BIDS, *_bid_rounds_ctes(DAY), f"""rb AS (
  SELECT b.*, (SELECT max(o.round_no) FROM o WHERE o.auction_id = b.auction_id AND o.open_ts <= b.ts) AS round_no
  FROM bids b)""", """run AS (
  SELECT *, count(*) OVER w AS pos, max(bid) OVER w AS mx
  FROM rb WINDOW w AS (PARTITION BY auction_id, round_no ORDER BY ts, ingestion_ts, bid_id
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
nf AS (
  SELECT *, row_number() OVER (PARTITION BY abs(auction_id) % 4 ORDER BY ts, ingestion_ts, bid_id) AS seq
  FROM run WHERE pos > 1),
firsts AS (SELECT auction_id, round_no, ts, min(ingestion_ts) AS ing FROM rb GROUP BY 1, 2, 3)""") + """
SELECT nf.auction_id, nf.round_no, nf.mx AS max_price, nf.ts AS last_ts, f.ing AS last_ingestion_ts,
       nf.pos AS bid_count
FROM nf JOIN firsts f ON f.auction_id = nf.auction_id AND f.round_no = nf.round_no AND f.ts = nf.ts
WHERE (nf.seq - 1) % 5 = 0"""


# Jobs over the tables: the same SQL as the operators they chain.
ORACLE.update({
    "job_new_users": ORACLE["latency_q8"],
    "job_bid_stats": ORACLE["latency_q5"],
    "job_combo_probe": with_(EV, BIDS) + """, probe AS (
  SELECT auction_id, bid_id, ts AS last_ts, ingestion_ts AS last_ingestion_ts
  FROM (SELECT *, row_number() OVER (PARTITION BY abs(auction_id) % 4 ORDER BY ts, ingestion_ts, bid_id) AS rn FROM bids)
  WHERE (rn - 1) % 5 = 0)
""" + _bid_latency("probe", "last_ingestion_ts", "auction_id", "last_ts, last_ingestion_ts, auction_id, bid_id", True),
    "new_user_auctions_by_type": "\nUNION ALL\n".join(
        f"SELECT {kind} AS window_type, * FROM ({sql})" for kind, sql in
        ((0, _new_user_windows(6 * HOUR, 6 * HOUR)), (1, _new_user_windows(6 * HOUR, 3 * HOUR)), (2, _new_user_session(6 * HOUR)))),
    "flagship": f"""WITH nu AS (SELECT * FROM ({_new_user_windows(6 * HOUR, 6 * HOUR)})),
""" + with_(EV, AUCTIONS, BIDS).removeprefix("WITH ") + f""", st AS (
  SELECT auction_id, ts - ts % {6 * HOUR} + {6 * HOUR} AS window_evicting_ts, max(bid) AS mx, count(*) AS n
  FROM bids GROUP BY ALL),
own AS (SELECT DISTINCT person_id, auction_id FROM auctions),
pp AS (SELECT person_id, window_evicting_ts, CAST(sum(n) AS BIGINT) AS bids_on_own_auctions, max(mx) AS max_price_on_own_auctions
       FROM st JOIN own USING (auction_id) GROUP BY ALL)
SELECT nu.*, pp.bids_on_own_auctions, pp.max_price_on_own_auctions
FROM nu LEFT JOIN pp USING (person_id, window_evicting_ts)""",
})
