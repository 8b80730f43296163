"""Independent SQL for every query, to be run by DuckDB on the same tables.

Cycles are found here by plain recursion from the smallest account, not by half paths.
"""

from __future__ import annotations

from ledgerloop.checks.registry import CASE_ACCOUNTS, CHUNK_ROWS, EXPORT_ROWS, TOP_ROWS
from ledgerloop.functions import labels

_RULE = labels.ENGLISH

# -- common table expressions ----------------------------------------------------------------

_OFFSET = """((l_partkey * 37 + l_linenumber * 11) % 90
    + CASE WHEN l_partkey % 5 = 0 THEN 2880 ELSE 0 END)"""

_TIME = f"(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST({_OFFSET} AS INTEGER)))"

_LABEL = """CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_discount >= 0.09
    THEN 1 ELSE 0 END"""

_KEY = "concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

_DETAILS = f"""CAST(CAST(CASE WHEN l_partkey % 3 = 0 THEN round(l_extendedprice * 30, 2)
      ELSE round(l_extendedprice + 2500000, 2) END AS DECIMAL(18,2)) AS DECIMAL(30,10)) AS amount,
    {_TIME} AS "timestamp",
    CASE l_linenumber WHEN 1 THEN 'ACH' WHEN 2 THEN 'Wire' WHEN 3 THEN 'Cheque'
      WHEN 4 THEN 'Cash' ELSE 'Credit Card' END AS transaction_type,
    {_LABEL} AS is_laundering"""

TRANSFERS = f"""lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
transfers AS (
  SELECT {_KEY} AS transaction_id,
    concat(o_custkey % 25, '_', o_custkey) AS source_account,
    concat(l_suppkey % 25, '_', l_suppkey) AS target_account,
    {_DETAILS}
  FROM lines),
edges AS (SELECT * FROM transfers WHERE source_account <> target_account),
spread_lines AS (SELECT *, l_suppkey * 15 + l_partkey % 15 AS receiver FROM lines),
ring_transfers AS (
  SELECT {_KEY} AS transaction_id,
    concat(o_custkey % 25, '_', o_custkey * 10 + o_orderkey % 10) AS source_account,
    concat(receiver % 25, '_', receiver * 10 + (l_partkey + l_linenumber) % 10) AS target_account,
    {_DETAILS}
  FROM spread_lines),
rings AS (SELECT * FROM ring_transfers WHERE source_account <> target_account)"""

EVENTS = """numbered_events AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
rings AS (
  SELECT * FROM (
    SELECT CAST(x.event_id AS VARCHAR) AS transaction_id,
      concat((x.user_id * 20 + x.event_id % 20) % 10, '_', x.user_id * 20 + x.event_id % 20)
        AS source_account,
      concat((y.user_id * 20 + y.k % 20) % 10, '_', y.user_id * 20 + y.k % 20) AS target_account,
      CAST(x.value AS DECIMAL(30,10)) AS amount, x.ts AS "timestamp"
    FROM numbered_events x JOIN numbered_events y ON y.event_id = x.event_id + 1)
  WHERE source_account <> target_account)"""

RAW = f"""lines AS (
  SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
raw AS (
  SELECT {_KEY} AS row_key, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_orderkey % 103 = 0 THEN 'not-a-date' WHEN l_orderkey % 107 = 0 THEN ''
      ELSE strftime({_TIME}, '%Y/%m/%d %H:%M') END AS t,
    CASE WHEN l_orderkey % 109 = 0 THEN NULL
      WHEN l_orderkey % 5 = 0 THEN concat(' 0', o_custkey % 25, ' ')
      ELSE concat('0', o_custkey % 25) END AS from_bank,
    CASE WHEN l_orderkey % 113 = 0 THEN 'None' ELSE CAST(o_custkey AS VARCHAR) END AS from_account,
    concat('0', l_suppkey % 25) AS to_bank,
    CASE WHEN l_orderkey % 127 = 0 THEN 'nan' ELSE CAST(l_suppkey AS VARCHAR) END AS to_account,
    CASE WHEN l_orderkey % 131 = 0 THEN 'abc' WHEN l_orderkey % 137 = 0 THEN '0'
      WHEN l_orderkey % 139 = 0 THEN '-5.00' WHEN l_orderkey % 151 = 0 THEN '1e14'
      WHEN l_orderkey % 157 = 0 THEN '1,000,000,000,000,000' WHEN l_orderkey % 163 = 0 THEN '4e-7'
      WHEN l_orderkey % 167 = 0 THEN '1e25' WHEN l_orderkey % 173 = 0 THEN '1e-12'
      ELSE concat(' ', format('{{:,.2f}}', l_extendedprice)) END AS paid,
    CASE l_linenumber WHEN 1 THEN ' ACH' WHEN 2 THEN 'Wire ' WHEN 3 THEN 'Cheque'
      WHEN 4 THEN 'Cash' WHEN 5 THEN '' ELSE 'Credit Card' END AS payment_format,
    CASE WHEN l_orderkey % 149 = 0 THEN 'x' ELSE CAST({_LABEL} AS VARCHAR) END AS label
  FROM lines),
texts AS (
  SELECT *,
    CASE WHEN trim(from_bank) NOT IN ('', 'nan', 'None') THEN trim(from_bank) END AS fb,
    CASE WHEN trim(from_account) NOT IN ('', 'nan', 'None') THEN trim(from_account) END AS fa,
    CASE WHEN trim(to_bank) NOT IN ('', 'nan', 'None') THEN trim(to_bank) END AS tb,
    CASE WHEN trim(to_account) NOT IN ('', 'nan', 'None') THEN trim(to_account) END AS ta,
    CASE WHEN trim(payment_format) NOT IN ('', 'nan', 'None') THEN trim(payment_format) END AS pf
  FROM raw),
normalized AS (
  SELECT row_key, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN length(ltrim(fb, '0')) > 0 THEN ltrim(fb, '0') WHEN fb IS NOT NULL THEN '0' END
      || '_' || fa AS source_account,
    CASE WHEN length(ltrim(tb, '0')) > 0 THEN ltrim(tb, '0') WHEN tb IS NOT NULL THEN '0' END
      || '_' || ta AS target_account,
    TRY_CAST(replace(trim(paid), ',', '') AS DECIMAL(30,10)) AS amount,
    try_strptime(trim(t), '%Y/%m/%d %H:%M') AS "timestamp",
    pf AS transaction_type,
    coalesce(TRY_CAST(trim(label) AS INTEGER), 0) AS is_laundering,
    coalesce(trim(paid) IN ('1e25', '1e-12'), false) AS amount_unfit
  FROM texts)"""

_VALID = """(source_account IS NOT NULL AND target_account IS NOT NULL
    AND amount IS NOT NULL AND amount > 0 AND "timestamp" IS NOT NULL)"""

CHUNKED = f"""{RAW},
numbered AS (
  SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS n
  FROM normalized),
chunked AS (
  SELECT *, n // {CHUNK_ROWS} + 1 AS chunk_id,
    printf('T%04d_%07d', n // {CHUNK_ROWS} + 1, n % {CHUNK_ROWS}) AS transaction_id
  FROM numbered),
report AS (
  SELECT count(*) AS rows_before,
    count(*) FILTER ({_VALID}) AS rows_after_cleaning,
    count(*) - count(*) FILTER ({_VALID}) AS rows_removed,
    count(*) FILTER ((amount IS NULL OR amount <= 0) AND NOT amount_unfit) AS invalid_amount,
    count(*) FILTER ("timestamp" IS NULL) AS invalid_timestamp,
    count(*) FILTER (source_account IS NULL OR target_account IS NULL) AS missing_accounts,
    count(*) FILTER (source_account = target_account) AS self_loop_rows_kept_in_clean_data,
    chunk_id,
    count(*) FILTER ({_VALID} AND source_account <> target_account) AS graph_edge_rows,
    count(*) FILTER (amount_unfit) AS amount_unfit_rows
  FROM chunked GROUP BY chunk_id)"""


def _first(source: str) -> str:
    """Earliest transfer per pair."""
    return f"""(SELECT DISTINCT ON (source_account, target_account)
    source_account AS src, target_account AS dst, transaction_id, "timestamp", amount
  FROM {source} ORDER BY source_account, target_account, "timestamp", transaction_id)"""


def _cycles(source: str, low: int = 2, high: int = 6, name: str = "cyc") -> str:
    return f"""{name}_pairs AS (
  SELECT DISTINCT source_account AS src, target_account AS dst FROM {source}),
{name}_walk(root, tail, nodes, n) AS (
  SELECT src, dst, [src, dst], 2 FROM {name}_pairs WHERE dst > src
  UNION ALL
  SELECT w.root, p.dst, list_append(w.nodes, p.dst), w.n + 1
  FROM {name}_walk w JOIN {name}_pairs p ON w.tail = p.src
  WHERE p.dst > w.root AND NOT list_contains(w.nodes, p.dst) AND w.n < {high}),
{name} AS (
  SELECT w.nodes, w.n, array_to_string(list_append(w.nodes, w.root), ' -> ') AS path
  FROM {name}_walk w JOIN {name}_pairs p ON p.src = w.tail AND p.dst = w.root
  WHERE w.n BETWEEN {low} AND {high})"""


def _measures(known: str) -> str:
    """Hops and measures of the cycles over the transfers of `known`."""
    return f"""steps AS (
  SELECT path, n, unnest(range(1, n + 1)) AS hop, nodes FROM cyc),
hops AS (
  SELECT s.path, s.n, s.hop, s.nodes[s.hop] AS src, s.nodes[s.hop % s.n + 1] AS dst FROM steps s),
matched AS (
  SELECT h.*, f.transaction_id, f."timestamp", f.amount
  FROM hops h LEFT JOIN {_first(known)} f ON h.src = f.src AND h.dst = f.dst),
measured AS (
  SELECT path, CAST(n AS INTEGER) AS n_accounts, count(transaction_id) AS found,
    sum(amount) AS total, min(amount) AS low, max(amount) AS high,
    date_diff('second', min("timestamp"), max("timestamp")) // 60 AS minutes
  FROM matched GROUP BY path, n),
spreads AS (
  SELECT *, CASE WHEN found > 0 THEN
      CASE WHEN CAST(total AS DOUBLE) = 0 THEN 1.0
      ELSE CAST(high - low AS DOUBLE) / (CAST(total AS DOUBLE) / found) END END AS spread
  FROM measured),
rules AS (
  SELECT *,
    found > 0 AND n_accounts BETWEEN 3 AND 5 AS r1,
    found > 0 AND minutes <= 1440 AS r2,
    found > 0 AND spread <= 0.10 AS r3,
    found > 0 AND total >= 10000000 AS r4,
    found > 0 AND minutes <= 60 AND n_accounts >= 3 AS r5
  FROM spreads),
scored AS (
  SELECT *, CAST(least(100, CASE WHEN r1 THEN 20 ELSE 0 END + CASE WHEN r2 THEN 25 ELSE 0 END
    + CASE WHEN r3 THEN 20 ELSE 0 END + CASE WHEN r4 THEN 20 ELSE 0 END
    + CASE WHEN r5 THEN 15 ELSE 0 END) AS INTEGER) AS risk_score
  FROM rules),
levels AS (
  SELECT *, CASE WHEN risk_score >= 70 THEN 'High' WHEN risk_score >= 40 THEN 'Medium'
    ELSE 'Low' END AS risk_level,
    printf('C%03d', row_number() OVER (ORDER BY n_accounts, path)) AS cycle_id,
    concat_ws(', ',
      CASE WHEN r1 THEN concat('ring of ', n_accounts) END,
      CASE WHEN r2 THEN concat('over in ', minutes, ' min') END,
      CASE WHEN r3 THEN 'even amounts (spread up to 10%)' END,
      CASE WHEN r4 THEN concat('sum ', format('{{:,.0f}}', CAST(total AS DOUBLE)),
        ' (from 10,000,000)') END,
      CASE WHEN r5 THEN 'quick relay' END) AS reasons
  FROM scored),
cases AS (
  SELECT cycle_id, path, coalesce(CAST(round(total, 2) AS DOUBLE), 0.0) AS total_amount,
    minutes AS duration_minutes, round(spread, 4) AS amount_variance, risk_score, risk_level,
    CASE WHEN found = 0 THEN concat(cycle_id, ': transfers missing')
      WHEN reasons <> '' THEN concat(cycle_id, ' / ', risk_level, ' / ', reasons)
      ELSE concat(cycle_id, ': a ring, otherwise ordinary') END AS explanation
  FROM levels)"""


RING_CYCLES = f"RECURSIVE {TRANSFERS},\n{_cycles('rings')}"

RING_CASES = f"{RING_CYCLES},\n{_measures('rings')}"

SHORT_CYCLES = f"RECURSIVE {TRANSFERS},\n{_cycles('edges', 2, CASE_ACCOUNTS)}"

CASES = f"{SHORT_CYCLES},\n{_measures('edges')}"


def _both(columns: str, table: str) -> str:
    """From the cycles of 2 to 4 accounts of all transfers, and of 2 to 6 of the ring transfers."""
    return f"""SELECT * FROM (WITH {CASES} SELECT {columns} FROM {table})
UNION ALL SELECT * FROM (WITH {RING_CASES} SELECT {columns} FROM {table})"""


def _money(value: str) -> str:
    return f"""CASE WHEN abs({value}) >= 1e9 THEN format('{{:,.2f}}', {value} / 1e9) || ' billion VND'
    WHEN abs({value}) >= 1e6 THEN format('{{:,.2f}}', {value} / 1e6) || ' million VND'
    ELSE format('{{:,.0f}}', {value}) || ' VND' END"""


_ACTION = """CASE urgency
      WHEN 1 THEN 'Open a file today and ask the banks for statements before more money leaves.'
      WHEN 2 THEN 'Put on this week''s list; look up earlier cases of the same accounts first.'
      ELSE 'Nothing to do until one of its accounts turns up in another case.' END"""

_SENTENCE = f"""concat(risk_level_norm, ' (', format('{{:,.1f}}', risk_score), ' points): ', cycle_length,
      ' accounts passed on ', {_money('total_amount')}, ', first to last transfer ',
      format('{{:.0f}}', duration_minutes), ' min. Stops: ', array_to_string(nodes, ' → '))"""

DIRTY_QUEUE = """texts AS (
  SELECT o_orderkey AS key, concat('1_', o_custkey) AS a, concat('2_', o_orderkey % 97) AS b,
    CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders),
read AS (
  SELECT concat('C', key) AS cycle_id,
    CASE key % 4 WHEN 0 THEN [a, b, '3_x'] WHEN 1 THEN [a, b, a] WHEN 2 THEN [a, b] ELSE [] END
      AS nodes,
    CAST(CASE WHEN key % 5 = 0 THEN 0 WHEN key % 7 = 0 THEN -12.5 WHEN key % 11 = 0 THEN price
      ELSE CAST(price AS DECIMAL(24,2)) * 10000 END AS DOUBLE) AS total_amount,
    CAST(CASE WHEN key % 13 = 0 OR key % 17 = 0 THEN 0 ELSE key % 5000 END AS DOUBLE)
      AS duration_minutes,
    CAST(CASE WHEN key % 19 = 0 THEN 0 WHEN key % 23 = 0 THEN 55.5
      ELSE greatest(0, least(100, key % 141 - 20)) END AS DOUBLE) AS risk_score,
    CASE WHEN key % 8 < 2 THEN 'High' WHEN key % 8 < 4 THEN 'Medium' WHEN key % 8 < 6 THEN 'Low'
      ELSE 'Unknown' END AS risk_level_norm
  FROM texts),
graded AS (
  SELECT *, CAST(len(list_distinct(nodes)) AS INTEGER) AS cycle_length,
    CASE WHEN risk_level_norm = 'High' OR risk_score >= 70 THEN 1
      WHEN risk_level_norm = 'Medium' OR risk_score >= 40 THEN 2 ELSE 3 END AS urgency
  FROM read)"""

QUEUE = f"""{CASES},
graded AS (
  SELECT cycle_id, path, total_amount,
    CAST(coalesce(duration_minutes, 0) AS DOUBLE) AS duration_minutes, amount_variance,
    CAST(risk_score AS DOUBLE) AS risk_score, risk_level, explanation,
    string_split(path, ' -> ') AS nodes, risk_level AS risk_level_norm,
    CAST(len(list_distinct(string_split(path, ' -> '))) AS INTEGER) AS cycle_length,
    CASE WHEN risk_score >= 70 THEN 1 WHEN risk_score >= 40 THEN 2 ELSE 3 END AS urgency
  FROM cases),
queue AS (
  SELECT *,
    CASE urgency WHEN 1 THEN '{_RULE.p1}' WHEN 2 THEN '{_RULE.p2}' ELSE '{_RULE.p3}' END AS priority,
    CASE urgency WHEN 1 THEN '{_RULE.escalate}' WHEN 2 THEN '{_RULE.in_review}'
      ELSE '{_RULE.monitoring}' END AS case_status,
    {_ACTION} AS recommended_action,
    {_SENTENCE}
      AS case_explanation,
    row_number() OVER (ORDER BY urgency, risk_score DESC, total_amount DESC, cycle_id) AS queue_rank
  FROM graded),
chosen AS (SELECT nodes[1] AS a, nodes[2] AS b FROM queue WHERE queue_rank = 1),
visited AS (SELECT DISTINCT unnest(nodes) AS account_id, cycle_id FROM queue),
route AS (
  SELECT cycle_id, nodes, CAST(unnest(range(1, len(nodes))) AS INTEGER) AS step FROM queue),
flow AS (
  SELECT cycle_id, step, nodes[step] AS source, nodes[step + 1] AS target FROM route)"""

_PLAIN = """CAST(amount AS DOUBLE) AS amount, CAST("timestamp" AS VARCHAR) AS "timestamp" """

_TRANSFER_COLUMNS = f"""transaction_id, source_account, target_account, {_PLAIN},
  transaction_type, is_laundering"""

SIX = f"""{TRANSFERS},
six AS (
  SELECT DISTINCT source_account, target_account, amount, "timestamp", transaction_type,
    is_laundering
  FROM edges)"""

DEDUP = f"""{TRANSFERS},
dedup AS (
  SELECT source_account AS src, target_account AS dst, amount, "timestamp",
    min((transaction_type, is_laundering)) AS kept
  FROM edges GROUP BY ALL)"""

MOTIFS = f"""{DEDUP},
two AS (
  SELECT x.src AS a, x.dst AS b, x.amount AS a1, x."timestamp" AS t1,
    y.amount AS a2, y."timestamp" AS t2
  FROM dedup x JOIN dedup y ON x.src = y.dst AND x.dst = y.src AND x.src < x.dst),
three AS (
  SELECT x.src AS a, x.dst AS b, y.dst AS c, x.amount AS a1, x."timestamp" AS t1,
    y.amount AS a2, y."timestamp" AS t2, z.amount AS a3, z."timestamp" AS t3
  FROM dedup x JOIN dedup y ON x.dst = y.src AND x.src < x.dst AND x.src < y.dst
  JOIN dedup z ON y.dst = z.src AND z.dst = x.src),
motif2 AS (
  SELECT concat('S2_', md5(concat_ws('|', concat(a, ' -> ', b, ' -> ', a), t1, a1, t2, a2)))
      AS cycle_id,
    concat(a, ' -> ', b, ' -> ', a) AS path, 2 AS cycle_length,
    CAST(a1 + a2 AS DOUBLE) AS total_amount, 'spark_2_cycle' AS detection_method,
    [(t1, a1), (t2, a2)] AS choice
  FROM two),
motif3 AS (
  SELECT concat('S3_', md5(concat_ws('|', concat(a, ' -> ', b, ' -> ', c, ' -> ', a),
      t1, a1, t2, a2, t3, a3))) AS cycle_id,
    concat(a, ' -> ', b, ' -> ', c, ' -> ', a) AS path, 3 AS cycle_length,
    CAST(a1 + a2 + a3 AS DOUBLE) AS total_amount, 'spark_3_cycle' AS detection_method,
    [(t1, a1), (t2, a2), (t3, a3)] AS choice
  FROM three),
motifs AS (SELECT * FROM motif2 UNION ALL SELECT * FROM motif3)"""

_MOTIF_COLUMNS = "cycle_id, path, cycle_length, total_amount, detection_method"

PATHS = f"""{TRANSFERS},
parsed AS (
  SELECT transaction_id,
    CASE transaction_type WHEN 'ACH' THEN [source_account, target_account, transaction_id]
      WHEN 'Wire' THEN [source_account, target_account, source_account]
      WHEN 'Cheque' THEN [source_account, target_account, source_account]
      WHEN 'Cash' THEN [source_account, target_account]
      ELSE [] END AS accounts
  FROM transfers)"""

LEVELS = """levels AS (
  SELECT o_orderkey, o_orderpriority AS word,
    o_totalprice * pow(10.0, o_orderkey % 6 - 1) AS value
  FROM orders)"""

# -- one statement per query -----------------------------------------------------------------

# Accounts as numbers, and only those that are both reached and left.
NUMBERED_PAIRS = f"""{TRANSFERS},
named AS (SELECT DISTINCT source_account AS s, target_account AS d FROM edges),
names AS (
  SELECT a, CAST(row_number() OVER () AS INTEGER) AS i
  FROM (SELECT s AS a FROM named INTERSECT SELECT d FROM named)),
pairs AS (
  SELECT x.i AS s, y.i AS d FROM named JOIN names x ON named.s = x.a JOIN names y ON named.d = y.a)"""


def _count_walks(most: int) -> str:
    """Cycles of 2..most accounts, counted by joining their pairs from the smallest account on."""
    lengths = []
    for n in range(2, most + 1):
        joins = ["FROM pairs p1"]
        for k in range(2, n):
            before = ", ".join(f"p{j}.d" for j in range(1, k))
            joins.append(f"JOIN pairs p{k} ON p{k}.s = p{k - 1}.d AND p{k}.d > p1.s")
            joins.append(f"AND p{k}.d NOT IN ({before})")
        joins.append(f"JOIN pairs p{n} ON p{n}.s = p{n - 1}.d AND p{n}.d = p1.s")
        joins.append("WHERE p1.d > p1.s")
        lengths.append(f"SELECT {n} AS n_accounts, count(*) AS cycles\n" + "\n".join(joins))
    return "\nUNION ALL\n".join(lengths)


# A closed walk of n transfers is one of ceil(n/2) and one of floor(n/2), end to end.
TRAILS = f"""{TRANSFERS},
steps1 AS (
  SELECT source_account AS a, target_account AS z, [transaction_id] AS ids, [source_account] AS nodes
  FROM rings),
steps2 AS (
  SELECT x.a, y.z, x.ids || y.ids AS ids, x.nodes || y.nodes AS nodes
  FROM steps1 x JOIN steps1 y ON x.z = y.a WHERE x.ids[1] <> y.ids[1]),
steps3 AS (
  SELECT x.a, y.z, x.ids || y.ids AS ids, x.nodes || y.nodes AS nodes
  FROM steps2 x JOIN steps1 y ON x.z = y.a WHERE NOT list_contains(x.ids, y.ids[1])),
trails AS (
  SELECT x.ids || y.ids AS ids, x.nodes || y.nodes AS nodes FROM steps1 x JOIN steps1 y
    ON x.z = y.a AND y.z = x.a WHERE NOT list_has_any(x.ids, y.ids)
  UNION ALL
  SELECT x.ids || y.ids, x.nodes || y.nodes FROM steps2 x JOIN steps1 y
    ON x.z = y.a AND y.z = x.a WHERE NOT list_has_any(x.ids, y.ids)
  UNION ALL
  SELECT x.ids || y.ids, x.nodes || y.nodes FROM steps2 x JOIN steps2 y
    ON x.z = y.a AND y.z = x.a WHERE NOT list_has_any(x.ids, y.ids)
  UNION ALL
  SELECT x.ids || y.ids, x.nodes || y.nodes FROM steps3 x JOIN steps2 y
    ON x.z = y.a AND y.z = x.a WHERE NOT list_has_any(x.ids, y.ids)
  UNION ALL
  SELECT x.ids || y.ids, x.nodes || y.nodes FROM steps3 x JOIN steps3 y
    ON x.z = y.a AND y.z = x.a WHERE NOT list_has_any(x.ids, y.ids))"""

ORACLE: dict[str, str] = {
    "assign_transaction_id": f"WITH {CHUNKED} SELECT row_key, transaction_id, chunk_id FROM chunked",
    "clean_text": f"""WITH {RAW}
SELECT row_key, fa AS account, ta AS target, pf AS payment_format FROM texts""",
    "account_key": f"""WITH {RAW}
SELECT n.row_key, n.source_account, t.fb || '_' || t.fa AS source_with_zeros
FROM normalized n JOIN texts t ON n.row_key = t.row_key""",
    "parse_amount": f"""WITH {RAW}
SELECT row_key, CAST(amount AS DOUBLE) AS amount, amount_unfit FROM normalized""",
    "parse_timestamp": f"""WITH {RAW}
SELECT row_key, CAST("timestamp" AS VARCHAR) AS "timestamp" FROM normalized""",
    "parse_label": f"WITH {RAW} SELECT row_key, is_laundering FROM normalized",
    "normalize_transfers": f"""WITH {RAW}
SELECT row_key AS {_TRANSFER_COLUMNS}, amount_unfit
FROM normalized""",
    "clean_transfers": f"WITH {RAW} SELECT row_key AS {_TRANSFER_COLUMNS} FROM normalized WHERE {_VALID}",
    "graph_edges": f"""WITH {RAW} SELECT row_key AS {_TRANSFER_COLUMNS} FROM normalized
WHERE {_VALID} AND source_account <> target_account""",
    "quality_report": f"WITH {CHUNKED} SELECT * FROM report",
    "quality_totals": f"""WITH {CHUNKED}
SELECT count(*) AS chunks, CAST(sum(rows_before) AS BIGINT) AS rows_before,
  CAST(sum(rows_after_cleaning) AS BIGINT) AS rows_after_cleaning,
  CAST(sum(rows_removed) AS BIGINT) AS rows_removed,
  CAST(sum(invalid_amount) AS BIGINT) AS invalid_amount,
  CAST(sum(invalid_timestamp) AS BIGINT) AS invalid_timestamp,
  CAST(sum(missing_accounts) AS BIGINT) AS missing_accounts,
  CAST(sum(self_loop_rows_kept_in_clean_data) AS BIGINT) AS self_loop_rows_kept_in_clean_data,
  CAST(sum(graph_edge_rows) AS BIGINT) AS graph_edge_rows,
  CAST(sum(amount_unfit_rows) AS BIGINT) AS amount_unfit_rows
FROM report""",
    "labelled_accounts": f"""WITH {TRANSFERS}
SELECT source_account AS account_id FROM edges WHERE is_laundering = 1
UNION SELECT target_account FROM edges WHERE is_laundering = 1""",
    "labelled_subgraph": f"""WITH {TRANSFERS},
marked AS (
  SELECT source_account AS account FROM edges WHERE is_laundering = 1
  UNION SELECT target_account FROM edges WHERE is_laundering = 1)
SELECT {_TRANSFER_COLUMNS} FROM edges
WHERE source_account IN (SELECT account FROM marked)
  OR target_account IN (SELECT account FROM marked)""",
    "label_totals": f"""WITH {TRANSFERS},
marked AS (
  SELECT source_account AS account FROM edges WHERE is_laundering = 1
  UNION SELECT target_account FROM edges WHERE is_laundering = 1)
SELECT count(*) AS edge_rows, count(*) FILTER (is_laundering = 1) AS labelled_rows,
  (SELECT count(*) FROM marked) AS labelled_accounts
FROM edges""",
    "edge_pairs": f"""WITH {TRANSFERS},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source_account, target_account
    ORDER BY "timestamp", transaction_id) AS place FROM edges)
SELECT source_account AS src, target_account AS dst,
  max(transaction_id) FILTER (place = 1) AS first_id,
  CAST(max(amount) FILTER (place = 1) AS DOUBLE) AS first_amount,
  CAST(max("timestamp") FILTER (place = 1) AS VARCHAR) AS first_time,
  max(transaction_type) FILTER (place = 1) AS first_type,
  count(*) AS n_transfers, CAST(sum(amount) AS DOUBLE) AS total_amount
FROM placed GROUP BY source_account, target_account""",
    "pair_transfer_lists": f"""WITH {TRANSFERS}
SELECT source_account AS src, target_account AS dst, transaction_id, {_PLAIN} FROM edges""",
    "first_transfer_per_pair": f"""WITH {TRANSFERS}
SELECT src, dst, transaction_id, {_PLAIN} FROM {_first('edges')}""",
    "account_nodes": f"""WITH {TRANSFERS}
SELECT source_account AS account_id FROM edges UNION SELECT target_account FROM edges""",
    "graph_summary": f"""WITH {TRANSFERS},
n AS (SELECT count(*) AS nodes FROM (
  SELECT source_account FROM edges UNION SELECT target_account FROM edges)),
m AS (SELECT count(*) AS edges FROM (SELECT DISTINCT source_account, target_account FROM edges))
SELECT nodes, edges, edges / (CAST(nodes AS DOUBLE) * (nodes - 1)) AS density FROM n, m""",
    "detect_profile": f"""WITH {TRANSFERS}
SELECT count(*) AS "rows", count(DISTINCT source_account) AS source_accounts,
  count(DISTINCT target_account) AS target_accounts,
  CAST(sum(is_laundering) AS BIGINT) AS labelled_rows FROM edges""",
    "detect_input_topn": f"""WITH {TRANSFERS},
capped AS (SELECT * FROM transfers ORDER BY "timestamp", transaction_id LIMIT {TOP_ROWS})
SELECT {_TRANSFER_COLUMNS} FROM capped WHERE source_account <> target_account""",
    "bounded_cycles": f"""WITH {RING_CYCLES}
SELECT path, CAST(n AS INTEGER) AS n_accounts FROM cyc""",
    "short_cycles_all_transfers": f"""WITH RECURSIVE {TRANSFERS},
{_cycles('edges', 2, 4)} SELECT path, CAST(n AS INTEGER) AS n_accounts FROM cyc""",
    "cycle_counts_all_transfers": f"""WITH {NUMBERED_PAIRS},
{_count_walks(6)}""",
    "event_cycles": f"""WITH RECURSIVE {EVENTS},
{_cycles('rings')},
steps AS (SELECT path, n, unnest(range(1, n + 1)) AS hop, nodes FROM cyc),
matched AS (
  SELECT s.path, s.n, f."timestamp" AS t, f.amount FROM steps s JOIN {_first('rings')} f
  ON s.nodes[s.hop] = f.src AND s.nodes[s.hop % s.n + 1] = f.dst)
SELECT path, CAST(n AS INTEGER) AS n_accounts, CAST(sum(amount) AS DOUBLE) AS total,
  CAST(min(t) AS VARCHAR) AS first_time, CAST(max(t) AS VARCHAR) AS last_time
FROM matched GROUP BY path, n""",
    "canonical_rotation": f"""WITH {TRANSFERS},
turned AS (
  SELECT transaction_id,
    [target_account, source_account, transaction_type, transaction_id] AS r FROM transfers),
started AS (SELECT *, list_position(r, list_min(r)) AS i FROM turned)
SELECT transaction_id,
  array_to_string(list_concat(r[i:], list_slice(r, 1, i - 1)), '|') AS ring FROM started""",
    "closed_trails": f"""WITH {TRAILS}
SELECT CAST(len(ids) AS INTEGER) AS n_hops,
  array_to_string(list_append(nodes, nodes[1]), ' -> ') AS path,
  array_to_string(ids, ',') AS transaction_ids
FROM trails""",
    "edge_adapter": f"""WITH {TRANSFERS}
SELECT source_account AS src, target_account AS dst, CAST(0 AS DOUBLE) AS amount,
  CAST("timestamp" AS VARCHAR) AS "timestamp", '' AS transaction_type, 0 AS is_laundering
FROM edges""",
    "dedup_edges": f"""WITH {DEDUP}
SELECT src, dst, {_PLAIN}, kept[1] AS transaction_type, kept[2] AS is_laundering FROM dedup""",
    "motif_two_account": f"WITH {MOTIFS} SELECT {_MOTIF_COLUMNS} FROM motif2",
    "motif_three_account": f"WITH {MOTIFS} SELECT {_MOTIF_COLUMNS} FROM motif3",
    "motif_union": f"WITH {MOTIFS} SELECT {_MOTIF_COLUMNS} FROM motifs",
    "motif_counts": f"""WITH {MOTIFS}
SELECT 2 AS cycle_length, count(*) AS cycles FROM motif2
UNION ALL SELECT 3, count(*) FROM motif3""",
    "motif_export_topn": f"""WITH {MOTIFS}
SELECT {_MOTIF_COLUMNS} FROM motifs ORDER BY motifs.cycle_length, motifs.path, choice
LIMIT {EXPORT_ROWS}""",
    "pattern_two_hop": f"""WITH {SIX}
SELECT concat(x.source_account, ' -> ', x.target_account, ' -> ', x.source_account) AS path,
  concat_ws(',', x."timestamp", y."timestamp") AS timestamps,
  concat_ws(',', x.amount, y.amount) AS amounts
FROM six x JOIN six y ON x.target_account = y.source_account
  AND y.target_account = x.source_account""",
    "pattern_three_hop": f"""WITH {SIX}
SELECT concat(x.source_account, ' -> ', y.source_account, ' -> ', z.source_account, ' -> ',
    x.source_account) AS path,
  concat_ws(',', x."timestamp", y."timestamp", z."timestamp") AS timestamps,
  concat_ws(',', x.amount, y.amount, z.amount) AS amounts
FROM six x JOIN six y ON x.target_account = y.source_account
JOIN six z ON y.target_account = z.source_account AND z.target_account = x.source_account""",
    "cycle_hops": f"""WITH {CASES}
SELECT path, CAST(hop AS INTEGER) AS hop, src, dst, transaction_id, {_PLAIN} FROM matched""",
    "cycle_measures": f"""WITH {CASES}
SELECT path, n_accounts, CAST(total AS DOUBLE) AS total_amount, minutes AS duration_minutes,
  round(spread, 4) AS amount_variance FROM spreads""",
    "risk_score": _both("path, risk_score, risk_level", "levels"),
    "risk_level_counts": f"""SELECT risk_level, count(*) AS cycles
FROM ({_both("risk_level", "levels")}) GROUP BY risk_level""",
    "risk_explanation": f"WITH {CASES} SELECT cycle_id, explanation FROM cases",
    "score_missing_hops": f"""WITH {SHORT_CYCLES},
known AS (SELECT * FROM edges WHERE transaction_type <> 'Cash'),
{_measures('known')} SELECT * FROM cases""",
    "case_ids": f"WITH {CASES} SELECT cycle_id, path FROM cases",
    "ranked_cases": f"WITH {CASES} SELECT * FROM cases",
    "ranked_ring_cases": f"WITH {RING_CASES} SELECT * FROM cases",
    "top_cases": f"""SELECT * FROM ({_both("*", "cases")}) ORDER BY risk_score DESC, total_amount DESC, path LIMIT 10""",
    "normalize_risk_level": f"""WITH {LEVELS}
SELECT o_orderkey,
  CASE word WHEN '1-URGENT' THEN 'High' WHEN '2-HIGH' THEN 'High' WHEN '3-MEDIUM' THEN 'Medium'
    WHEN '5-LOW' THEN 'Low' ELSE 'Unknown' END AS risk_level,
  CASE word WHEN '1-URGENT' THEN 'Cao' WHEN '2-HIGH' THEN 'Cao' WHEN '3-MEDIUM' THEN 'Trung bình'
    WHEN '5-LOW' THEN 'Thấp' ELSE 'Không xác định' END AS risk_level_vi
FROM levels""",
    "format_money": f"WITH {LEVELS} SELECT o_orderkey, {_money('value')} AS money FROM levels",
    "bank_id": f"""WITH {TRANSFERS}
SELECT transaction_id, split_part(source_account, '_', 1) AS source_bank,
  split_part(target_account, '_', 1) AS target_bank, 'UNKNOWN' AS no_bank FROM transfers""",
    "parse_path": f"""WITH {PATHS}
SELECT transaction_id, array_to_string(accounts, '|') AS accounts FROM parsed""",
    "cycle_length": f"""WITH {PATHS}
SELECT transaction_id, CAST(len(list_distinct(accounts)) AS INTEGER) AS cycle_length FROM parsed""",
    "case_queue": f"""WITH {QUEUE}
SELECT cycle_id, path, total_amount, duration_minutes, amount_variance, risk_score, risk_level,
  explanation, risk_level_norm, cycle_length, priority, case_status, recommended_action,
  case_explanation FROM queue""",
    "dirty_case_queue": f"""WITH {DIRTY_QUEUE}
SELECT cycle_id, total_amount, duration_minutes, risk_score, risk_level_norm, cycle_length,
  CASE urgency WHEN 1 THEN '{_RULE.p1}' WHEN 2 THEN '{_RULE.p2}' ELSE '{_RULE.p3}' END AS priority,
  CASE urgency WHEN 1 THEN '{_RULE.escalate}' WHEN 2 THEN '{_RULE.in_review}'
    ELSE '{_RULE.monitoring}' END AS case_status,
  {_ACTION} AS recommended_action, {_SENTENCE} AS case_explanation
FROM graded""",
    "case_queue_localized": f"""WITH {QUEUE}
SELECT cycle_id,
  CASE risk_level WHEN 'High' THEN 'Cao' WHEN 'Medium' THEN 'Trung bình' ELSE 'Thấp' END
    AS risk_level_norm,
  CASE urgency WHEN 1 THEN 'P1 - Ưu tiên cao' WHEN 2 THEN 'P2 - Cần rà soát'
    ELSE 'P3 - Theo dõi' END AS priority,
  CASE urgency WHEN 1 THEN 'Cần chuyển cấp' WHEN 2 THEN 'Đang rà soát'
    ELSE 'Đang theo dõi' END AS case_status
FROM queue""",
    "case_priority": f"WITH {QUEUE} SELECT cycle_id, risk_level_norm, risk_score, priority FROM queue",
    "case_explanation": f"WITH {QUEUE} SELECT cycle_id, case_explanation FROM queue",
    "queue_order": f"WITH {QUEUE} SELECT queue_rank, cycle_id FROM queue",
    "queue_projection": f"""WITH {QUEUE}
SELECT cycle_id AS case_id, priority, case_status AS status, risk_level_norm AS risk_level,
  risk_score, cycle_length AS accounts, total_amount, duration_minutes, recommended_action
FROM queue""",
    "queue_detail": f"""WITH {QUEUE}
SELECT cycle_id AS case_id, path, case_explanation AS explanation,
  recommended_action AS recommendation FROM queue""",
    "queue_header": f"""WITH {QUEUE}
SELECT count(*) AS cases, count(*) FILTER (cycle_length = 2) AS two_account_cases,
  count(*) FILTER (cycle_length = 3) AS three_account_cases FROM queue""",
    "queue_filter_numeric": f"""WITH {QUEUE}
SELECT cycle_id, total_amount, risk_score, cycle_length FROM queue
WHERE total_amount >= 9e6 AND risk_score >= 40 AND cycle_length BETWEEN 3 AND 5""",
    "queue_filter_membership": f"""WITH {QUEUE}
SELECT cycle_id, risk_level_norm, priority, case_status FROM queue
WHERE risk_level_norm IN ('High', 'Medium') AND case_status = 'In review'""",
    "queue_mode_filter": f"""WITH {QUEUE}
SELECT cycle_id, cycle_length FROM queue WHERE cycle_length IN (2, 3)""",
    "cases_with_two_accounts": f"""WITH {QUEUE}
SELECT q.cycle_id, q.path FROM queue q, chosen c
WHERE list_contains(q.nodes, c.a) AND list_contains(q.nodes, c.b)""",
    "indexed_cases_with_two_accounts": f"""WITH {QUEUE}
SELECT q.cycle_id, q.path FROM queue q, chosen c
WHERE list_contains(q.nodes, c.a) AND list_contains(q.nodes, c.b)""",
    "queue_kpis": f"""WITH {QUEUE}
SELECT count(*) AS cases, CAST(sum(CAST(total_amount AS DECIMAL(36,10))) AS DOUBLE) AS total_amount,
  avg(risk_score) AS mean_score, (SELECT count(DISTINCT account_id) FROM visited) AS accounts
FROM queue""",
    "risk_distribution": f"""WITH {QUEUE},
names AS (SELECT * FROM (VALUES (1, 'Low'), (2, 'Medium'), (3, 'High')) v(position, risk_level))
SELECT n.position, n.risk_level, count(q.cycle_id) AS cases
FROM names n LEFT JOIN queue q ON q.risk_level_norm = n.risk_level GROUP BY ALL""",
    "length_distribution": f"""WITH {QUEUE}
SELECT cycle_length, count(*) AS cases FROM queue GROUP BY cycle_length""",
    "status_distribution": f"""WITH {QUEUE}
SELECT case_status, count(*) AS cases FROM queue GROUP BY case_status""",
    "amount_vs_score": f"""WITH {QUEUE}
SELECT cycle_id, total_amount, risk_score, cycle_length, risk_level_norm, priority, case_status
FROM queue""",
    "filter_domains": f"""WITH {QUEUE}
SELECT greatest(max(total_amount), 1.0) AS max_amount, min(cycle_length) AS min_length,
  max(cycle_length) AS max_length,
  concat_ws('|', CASE WHEN count(*) FILTER (risk_level_norm = 'Low') > 0 THEN 'Low' END,
    CASE WHEN count(*) FILTER (risk_level_norm = 'Medium') > 0 THEN 'Medium' END,
    CASE WHEN count(*) FILTER (risk_level_norm = 'High') > 0 THEN 'High' END) AS risk_options,
  array_to_string(list_sort(list_distinct(list(priority))), '|') AS priority_options,
  array_to_string(list_sort(list_distinct(list(case_status))), '|') AS status_options
FROM queue""",
    "case_summary": f"""WITH {QUEUE},
figures AS (
  SELECT count(*) AS n, count(*) FILTER (cycle_length = 2) AS n2,
    count(*) FILTER (cycle_length = 3) AS n3,
    CAST(sum(CAST(total_amount AS DECIMAL(36,10))) AS DOUBLE) AS total FROM queue)
SELECT 'Cases' AS measure, CAST(n AS VARCHAR) AS value FROM figures
UNION ALL SELECT 'Two-account cycles', CAST(n2 AS VARCHAR) FROM figures
UNION ALL SELECT 'Three-account cycles', CAST(n3 AS VARCHAR) FROM figures
UNION ALL SELECT 'Total amount', {_money('total')} FROM figures""",
    "accounts_in_cases": f"WITH {QUEUE} SELECT DISTINCT account_id FROM visited",
    "account_case_membership": f"WITH {QUEUE} SELECT account_id, cycle_id FROM visited",
    "case_edges": f"WITH {QUEUE} SELECT cycle_id, step, source, target FROM flow",
    "case_steps": f"""WITH {QUEUE}
SELECT cycle_id, concat('Transfer ', step) AS transfer, source AS sender, target AS receiver,
  concat(source, ' → ', target) AS flow FROM flow""",
    "direct_edges": f"""WITH {QUEUE}
SELECT f.cycle_id, f.step, f.source, f.target FROM flow f, chosen c
WHERE (f.source = c.a AND f.target = c.b) OR (f.source = c.b AND f.target = c.a)""",
    "case_detail": f"""WITH {QUEUE}
SELECT cycle_id, cycle_length AS accounts, CAST(len(nodes) - 1 AS INTEGER) AS transfers,
  total_amount, risk_score FROM queue""",
    "export_edges": f"""WITH {SIX}
SELECT source_account, target_account, {_PLAIN}, transaction_type, is_laundering FROM six""",
    "export_nodes": f"""WITH {SIX},
ids AS (SELECT source_account AS account_id FROM six UNION SELECT target_account FROM six)
SELECT account_id, split_part(account_id, '_', 1) AS bank_id, 'Account' AS label FROM ids""",
    "merge_nodes": f"""WITH {SIX},
incoming AS (SELECT source_account AS id FROM six UNION SELECT target_account FROM six),
existing AS (
  SELECT source_account AS id FROM edges WHERE transaction_type = 'ACH'
  UNION SELECT target_account FROM edges WHERE transaction_type = 'ACH'
  UNION SELECT source_account FROM rings UNION SELECT target_account FROM rings)
SELECT id AS account_id, split_part(id, '_', 1) AS bank_id,
  CASE WHEN id IN (SELECT id FROM existing) THEN 'Client' ELSE 'Account' END AS label
FROM (SELECT id FROM incoming UNION SELECT id FROM existing)""",
    "merged_nodes_table": f"""WITH {SIX},
known AS (
  SELECT source_account AS id FROM six WHERE transaction_type = 'ACH'
  UNION SELECT target_account FROM six WHERE transaction_type = 'ACH')
SELECT id AS account_id, split_part(id, '_', 1) AS bank_id,
  CASE WHEN id IN (SELECT id FROM known) THEN 'Client' ELSE 'Account' END AS label
FROM (SELECT source_account AS id FROM six UNION SELECT target_account FROM six)""",
    "merge_edges": f"""WITH {SIX},
existing AS (
  SELECT * FROM six WHERE transaction_type = 'ACH'
  UNION
  SELECT source_account, target_account, amount, "timestamp", transaction_type, is_laundering
  FROM rings WHERE transaction_type = 'Wire'),
known AS (
  SELECT * FROM six WHERE CAST(split_part(source_account, '_', 1) AS INTEGER) < 12
    AND CAST(split_part(target_account, '_', 1) AS INTEGER) < 12),
merged AS (SELECT * FROM existing UNION SELECT * FROM known)
SELECT source_account, target_account, {_PLAIN}, transaction_type, is_laundering FROM merged""",
}
