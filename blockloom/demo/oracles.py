"""For each registered query, the SQL that must give the same rows.

Written from the table definitions, over the sales tables themselves.
"""

from __future__ import annotations

_SIZE = 1000

# Orders as blocks.
_O = """o AS (
  SELECT o_orderkey AS k, o_custkey AS cust, o_orderstatus AS st, o_orderpriority AS prio,
    CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
    CAST(floor(epoch(o_orderdate)) AS BIGINT) AS ts
  FROM orders)"""

# Postings of an order: its transactions in the nested layout.
_P = """p AS (
  SELECT *, 0 AS kind, 0 AS idx FROM o WHERE st <> 'P'
  UNION ALL SELECT *, 1, 1 FROM o WHERE st = 'F'
  UNION ALL SELECT *, 2, CASE WHEN st = 'F' THEN 2 ELSE 1 END FROM o
    WHERE st <> 'P' AND prio = '1-URGENT')"""

# Line items: transactions in the split layout.
_L = """l AS (
  SELECT *,
    't' || k || '-' || line || '-' || part || '-' || supp AS hash,
    CASE line WHEN 2 THEN '' WHEN 3 THEN '0x' || cents WHEN 4 THEN cents || repeat('0', 32)
      WHEN 5 THEN '-' || cents WHEN 6 THEN '+' || cents WHEN 7 THEN '000' || cents
      ELSE CAST(cents AS VARCHAR) END AS amount
  FROM (SELECT l_orderkey AS k, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part,
    l_suppkey AS supp, l_returnflag AS flag, l_linestatus AS state,
    CAST(l_quantity AS BIGINT) AS qty,
    CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
    CAST(floor(epoch(l_shipdate)) AS BIGINT) AS ts FROM lineitem))"""

# Chain events.
_E = """e AS (
  SELECT event_id AS seq,
    CASE event_type WHEN 'error' THEN 'BLOCK_REMOVED' WHEN 'signup' THEN 'UNKNOWN'
      ELSE 'BLOCK_ADDED' END AS kind_of_event,
    CASE event_type WHEN 'error' THEN greatest(event_id - 1, 0) ELSE event_id END AS height
  FROM events)"""


def _decimal(text: str) -> str:
    """Decimal text as the digits of a DECIMAL(38,0), NULL when invalid."""
    return (
        f"CASE WHEN {text} = '' THEN '0' "
        f"WHEN regexp_full_match({text}, '[+-]?[0-9]+') "
        f"AND length(regexp_replace({text}, '^-', '')) <= 38 "
        f"THEN CAST(CAST(ltrim({text}, '+') AS DECIMAL(38,0)) AS VARCHAR) END"
    )


def _layout(position: str) -> str:
    return (
        f'{position} // {_SIZE} * {_SIZE} AS "_partition_by", '
        f'{position} AS "_repartition_by_range"'
    )


def _list(count: str) -> str:
    """Length of a list that is NULL when it has no elements, as -1."""
    return f"CAST(CASE WHEN {count} > 0 THEN {count} ELSE -1 END AS BIGINT)"


_EVENT = 'e.seq AS "_sequence_number", e.kind_of_event AS "_event_type",'

_HEADER = """
  CASE WHEN o.k > 0 THEN 'b' || (o.k - 1) ELSE '' END AS parent_hash,
  'c' || o.cust AS miner, o.ts AS mined_at,
  CASE WHEN o.st = 'O' THEN 0 ELSE o.cust END AS base_fee_per_gas"""

_POSTING_VALUE = """CASE p.kind WHEN 0 THEN CAST(p.cents AS VARCHAR)
  WHEN 2 THEN '1' || repeat('0', 38)
  ELSE CASE WHEN p.prio = '2-HIGH' THEN '0x3' ELSE '' END END"""

_POSTING = f"""
  't' || p.k || '-' || p.kind AS transaction_hash, CAST(p.idx AS BIGINT) AS transaction_index,
  'b' || p.k AS block_hash, p.k AS block_number, p.ts AS block_timestamp,
  'c' || p.cust AS from_address, CASE WHEN p.kind = 2 THEN '' ELSE 's' || p.kind END AS to_address,
  p.cust AS nonce, {_POSTING_VALUE} AS value_string,
  CAST(21000 + p.kind AS BIGINT) AS gas, p.cust + 1 AS gas_price, '0x' || p.kind AS input,
  CAST(p.kind AS BIGINT) AS transaction_type,
  CASE WHEN p.kind = 0 THEN 0 ELSE p.cents END AS max_fee_per_gas,
  CAST(CASE WHEN p.kind = 2 THEN 5 ELSE 0 END AS BIGINT) AS max_priority_fee_per_gas,
  CAST(0 AS BIGINT) AS priority_fee_per_gas,
  {_decimal("(" + _POSTING_VALUE + ")")} AS value,
  CASE WHEN p.k > 0 THEN 'b' || (p.k - 1) ELSE '' END AS parent_hash,
  'c' || p.cust AS miner, p.ts AS mined_at,
  CASE WHEN p.st = 'O' THEN 0 ELSE p.cust END AS base_fee_per_gas,
  CAST(CASE WHEN p.kind = 1 THEN 0 ELSE 1 END AS BIGINT) AS status,
  CASE WHEN p.kind = 2 THEN 'new-t' || p.k || '-2' ELSE '' END AS contract_address,
  CAST(CASE WHEN p.kind = 0 THEN 2 ELSE -1 END AS BIGINT) AS logs,
  CAST(CASE WHEN p.kind = 2 THEN -1 ELSE 2 - p.kind END AS BIGINT) AS traces,"""

_BLOCK = f"""
  'b' || o.k AS hash, CASE WHEN o.k > 0 THEN 'b' || (o.k - 1) ELSE '' END AS parent_hash,
  o.k AS number, 'n' || o.k AS nonce, '' AS sha3_uncles, '0x00' AS logs_bloom,
  'tr' || o.k AS transactions_root, o.st AS state_root, o.prio AS receipts_root,
  'c' || o.cust AS miner, o.cust * 1000 + 7 AS difficulty,
  CASE WHEN o.st = 'P' THEN '0' ELSE o.cents || repeat('0', 20) END AS total_difficulty,
  o.cust + 500 AS size, 'x' || o.prio AS extra_data, CAST(30000000 AS BIGINT) AS gas_limit,
  o.cents % 30000000 AS gas_used, o.ts AS timestamp,
  CAST(CASE WHEN o.st = 'P' THEN 0 ELSE 1 + (o.st = 'F')::INT + (o.prio = '1-URGENT')::INT END
    AS BIGINT) AS transaction_count,
  CASE WHEN o.st = 'O' THEN 0 ELSE o.cust END AS base_fee_per_gas,
  {_list("(SELECT count(*) FROM p WHERE p.k = o.k)")} AS transactions,
  {_list("o.cust % 3")} AS uncles, {_list("o.cust % 3")} AS uncle_blocks,
  {_list("o.k % 4")} AS withdrawals,
  CASE WHEN o.k % 4 > 0 THEN 'w' || o.k ELSE '' END AS withdrawals_root,"""

_RECEIPT = """
  hash AS transaction_hash, line - 1 AS transaction_index, 'b' || k AS block_hash,
  k AS block_number, 'p' || part AS from_address,
  CASE WHEN line = 7 THEN '' ELSE 's' || supp END AS to_address,
  (21000 + qty) * 2 AS cumulative_gas_used, 21000 + qty AS gas_used,
  CASE WHEN line = 7 THEN 'new-' || hash ELSE '' END AS contract_address,
  '0x00' AS logs_bloom, '' AS root, line % 3 AS type,
  CAST(CASE WHEN line % 3 = 1 THEN 0 ELSE 1 END AS BIGINT) AS status,
  CASE WHEN line % 3 = 2 THEN 0 ELSE supp + 1 END AS effective_gas_price"""

_LOGS = """logs AS (
  SELECT l.*, n.i FROM l JOIN (VALUES (0), (1)) n(i)
    ON n.i < CASE flag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 0 END)"""

_TRACES = "traces AS (SELECT l.*, CAST(n.i AS BIGINT) AS i FROM l, (VALUES (0), (1)) n(i) WHERE state = 'O')"

_NUMBERS = "(VALUES (0), (1), (2)) n(i)"

_BITCOIN_HEADER = """
  'b' || o.k AS hash, o.cust + 900 AS size, o.cust + 800 AS stripped_size, o.cust * 4 AS weight,
  o.k AS number, CAST(2 AS BIGINT) AS version, 'm' || o.k AS merkle_root, o.ts AS timestamp,
  o.cents AS nonce, '1d00ffff' AS bits, o.cust || '.5' AS difficulty, '' AS chain_work,
  (SELECT count(*) FROM p WHERE p.k = o.k) AS transaction_count,
  CASE WHEN o.k > 0 THEN 'b' || (o.k - 1) ELSE '' END AS previous_block_hash,
  'b' || (o.k + 1) AS next_block_hash,"""

_BITCOIN_TX = """
  {name} AS hash, t.cents % 1000 AS size, t.cents % 900 AS virtual_size,
  t.cents % 4000 AS weight, CAST(2 AS BIGINT) AS version, CAST(0 AS BIGINT) AS lock_time,
  CAST({index} = 0 AS BIGINT) AS mints, CAST({index} AS BIGINT) AS index,
  'b' || o.k AS block_hash, o.k AS block_number, o.ts AS block_timestamp, '' AS chain_work,
  (SELECT count(*) FROM p WHERE p.k = o.k) AS block_transactions,
  CAST(CASE WHEN {index} = 0 THEN 1 ELSE 2 END AS BIGINT) AS inputs,
  CAST(CASE WHEN {index} = 0 THEN 1 ELSE {index} % 2 + 1 END AS BIGINT) AS outputs,
  CAST(CASE WHEN {index} = 0 THEN 1 ELSE 2 END AS BIGINT) AS input_count,
  CAST(CASE WHEN {index} = 0 THEN 1 ELSE {index} % 2 + 1 END AS BIGINT) AS output_count,
  CASE WHEN {index} = 0 THEN 0 ELSE t.cents * 2 + 1 END AS input_value,
  t.cents AS output_value, CASE WHEN {index} = 0 THEN 0 ELSE t.cents % 100 END AS fee,"""

_INPUTS = """inputs AS (
  SELECT l.*, CAST(n.i AS BIGINT) AS i, line = 1 AS mints FROM l, (VALUES (0), (1)) n(i)
  WHERE n.i = 0 OR line <> 1)"""

_ROSETTA_TX_METADATA = """CASE p.kind
  WHEN 0 THEN '{"cents":' || p.cents || ',"status":"' || p.st || '"}' ELSE '' END"""

_ROSETTA_METADATA = r"""
  '{"Nested\u003c1\u003e":{"k":' || k || ',"t":"x \u0026 y"},"a\"b":' || k
  || ',"priority":"' || prio || '"}'"""

_OPERATIONS = """ops AS (
  SELECT p.*, CAST(n.i AS BIGINT) AS i FROM p, (VALUES (0), (1)) n(i)
  WHERE n.i = 0 OR p.kind <> 1)"""

_STREAMED_VALUES = f"""WITH {_O}, {_P}, {_E}
SELECT {_EVENT} 't' || p.k || '-' || p.kind AS transaction_hash,
  CAST(p.idx AS BIGINT) AS transaction_index,
  {_decimal("(" + _POSTING_VALUE + ")")} AS value, {_layout("e.seq")}
FROM e JOIN p ON p.k = e.height"""

_ORACLES = {
    "tip": "SELECT max(o_orderkey) - 100 AS tip_height FROM orders",
    "earliest": """SELECT CAST(0 AS BIGINT) AS start_height,
        count(*) FILTER (o_orderkey >= 0) AS blocks FROM orders""",
    "stream_tip": "SELECT max(event_id) AS stream_tip FROM events",
    "stream_earliest": "SELECT min(event_id) AS stream_earliest FROM events",
    "batch_range": """SELECT min(o_orderkey) AS first_height, max(o_orderkey) AS last_height,
        count(*) AS blocks FROM orders
        WHERE o_orderkey >= 0 AND o_orderkey < (SELECT max(o_orderkey) - 100 FROM orders)""",
    "stream_range": """SELECT min(event_id) AS first_sequence, max(event_id) AS last_sequence,
        count(*) AS events FROM events""",
    "batch_slices": """WITH t AS (SELECT max(o_orderkey) - 100 AS tip FROM orders)
        SELECT s AS slice_start, least(s + 100, tip) AS slice_end
        FROM t, LATERAL (SELECT unnest(range(0, tip, 100)) AS s)""",
    "stream_slices": """WITH t AS (SELECT min(event_id) AS a, max(event_id) + 1 AS z FROM events)
        SELECT s AS slice_start, least(s + 64, z) AS slice_end
        FROM t, LATERAL (SELECT unnest(range(a, z, 64)) AS s)""",
    "scan_blocks_range": f"""WITH {_O} SELECT k AS number, 'b' || k AS hash, ts AS timestamp
        FROM o WHERE k < (SELECT max(k) - 100 FROM o)""",
    "scan_events_range": f"""WITH {_E} SELECT seq AS sequence_num, kind_of_event AS type,
        CAST(1 AS BIGINT) AS tag, height, 'b' || height AS hash FROM e""",
    "missing_heights": """SELECT h AS height FROM
        (SELECT unnest(range(0, (SELECT max(o_orderkey) - 100 FROM orders))) AS h)
        WHERE h NOT IN (SELECT l_orderkey FROM lineitem)""",
    "decimal_lenient": f"""WITH {_L} SELECT k, line, part, supp, amount,
        {_decimal("amount")} AS value FROM l""",
    "decimal_strict": f"""WITH {_O} SELECT k,
        CASE WHEN cents % 2 = 0 THEN CAST(cents AS VARCHAR) ELSE '0' END AS value FROM o""",
    "partition_floor": f"""WITH {_L}
        SELECT CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS bucket,
          count(*) AS transactions FROM l
        UNION ALL SELECT 7, k // 7 * 7, count(*) FROM l GROUP BY 2
        UNION ALL SELECT {_SIZE}, k // {_SIZE} * {_SIZE}, count(*) FROM l GROUP BY 2""",
    "epoch_seconds": f"WITH {_L} SELECT k, line, part, supp, ts AS seconds FROM l",
    "metadata_json": f"WITH {_O} SELECT k, {_ROSETTA_METADATA} AS metadata FROM o",
    "enum_names": """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'UNKNOWN'
        ELSE CASE o_custkey % 4 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'BLOCK_ADDED'
          WHEN 2 THEN 'BLOCK_REMOVED' ELSE '3' END END AS event_type FROM orders""",
    "evm_transactions_split": f"""WITH {_O}, {_L} SELECT
        l.hash AS transaction_hash, line - 1 AS transaction_index, 'b' || l.k AS block_hash,
        l.k AS block_number, l.ts AS block_timestamp, 'p' || part AS from_address,
        CASE WHEN line = 7 THEN '' ELSE 's' || supp END AS to_address, part AS nonce,
        amount AS value_string, 21000 + qty AS gas, supp + 1 AS gas_price,
        flag || state AS input, line % 3 AS transaction_type,
        CASE WHEN flag = 'N' THEN 0 ELSE part END AS max_fee_per_gas,
        CASE WHEN flag = 'R' THEN supp ELSE 0 END AS max_priority_fee_per_gas,
        CAST(0 AS BIGINT) AS priority_fee_per_gas, {_decimal("amount")} AS value, {_HEADER},
        CAST(CASE WHEN line % 3 = 1 THEN 0 ELSE 1 END AS BIGINT) AS status,
        CASE WHEN line = 7 THEN 'new-' || l.hash ELSE '' END AS contract_address,
        CAST(CASE flag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE -1 END AS BIGINT) AS logs,
        CAST(CASE WHEN state = 'O' THEN 2 ELSE -1 END AS BIGINT) AS traces,
        {_layout("l.k")} FROM l JOIN o ON o.k = l.k""",
    "evm_transactions_nested": f"WITH {_O}, {_P} SELECT {_POSTING} {_layout('p.k')} FROM p",
    "evm_transaction_values": f"""WITH {_L},
        v AS (SELECT *, {_decimal("amount")} AS value FROM l)
        SELECT 'p' || part AS from_address, k // {_SIZE} * {_SIZE} AS "_partition_by",
          count(*) AS transactions, count(value) AS valid,
          CAST(max(CAST(value AS DECIMAL(38,0))) AS VARCHAR) AS largest
        FROM v GROUP BY 1, 2""",
    "evm_blocks_table": f"WITH {_O}, {_P} SELECT {_BLOCK} {_layout('o.k')} FROM o",
    "evm_block_transactions": f"""WITH {_O}, {_P} SELECT k AS number,
        CAST(idx AS BIGINT) AS position, 't' || k || '-' || kind AS item FROM p""",
    "evm_uncle_hashes": f"""WITH {_O} SELECT k AS number, CAST(i AS BIGINT) AS position,
        'b' || k || 'u' || i AS item FROM o, {_NUMBERS} WHERE i < cust % 3""",
    "evm_uncle_blocks": f"""WITH {_O} SELECT k AS block_number, CAST(i AS BIGINT) AS position,
        'b' || k || 'u' || i AS hash, CASE WHEN k > 0 THEN 'b' || (k - 1) ELSE '' END AS parent_hash,
        greatest(k - 1, 0) AS number, ts - 12 * (i + 1) AS timestamp, 'c' || cust AS miner,
        cust * 1000 + 7 AS difficulty, CAST(30000000 AS BIGINT) AS gas_limit,
        cents % 30000000 AS gas_used, CAST(0 AS BIGINT) AS base_fee_per_gas
        FROM o, {_NUMBERS} WHERE i < cust % 3""",
    "evm_withdrawals": f"""WITH {_O} SELECT k AS number, CAST(i AS BIGINT) AS position,
        k * 10 + i AS index, cust + i AS validator_index, 'c' || cust AS address,
        CAST(i * 100 AS BIGINT) AS amount FROM o, {_NUMBERS} WHERE i < k % 4""",
    "evm_receipts": f"WITH {_L} SELECT {_RECEIPT} FROM l",
    "evm_receipts_arbitrum": f"""WITH {_L} SELECT {_RECEIPT},
        CASE WHEN state = 'O' THEN 21001 + qty ELSE 0 END AS l1_gas_used FROM l""",
    "evm_receipts_optimism": f"""WITH {_L} SELECT {_RECEIPT},
        CASE WHEN state = 'O' THEN 21001 + qty ELSE 0 END AS l1_gas_used,
        CASE WHEN state = 'O' THEN supp + 3 ELSE 0 END AS l1_gas_price,
        CASE WHEN state = 'O' THEN 21003 + qty ELSE 0 END AS l1_fee,
        CASE WHEN state = 'O' THEN '0.684' ELSE '' END AS l1_fee_scalar FROM l""",
    "evm_logs": f"""WITH {_L}, {_LOGS} SELECT (line - 1) * 10 + i AS log_index,
        hash AS transaction_hash, line - 1 AS transaction_index, 'b' || k AS block_hash,
        k AS block_number, CASE WHEN line = 7 THEN '' ELSE 's' || supp END AS address,
        'd' || i AS data, CAST(CASE WHEN flag = 'R' THEN 2 ELSE -1 END AS BIGINT) AS topics,
        CAST(i AS BIGINT) AS removed FROM logs""",
    "evm_log_topics": f"""WITH {_L}, {_LOGS} SELECT hash AS transaction_hash,
        (line - 1) * 10 + i AS log_index, CAST(t.j AS BIGINT) AS position,
        CASE t.j WHEN 0 THEN state ELSE 's' || supp END AS topic
        FROM logs, (VALUES (0), (1)) t(j) WHERE flag = 'R'""",
    "evm_traces": f"""WITH {_L}, {_TRACES}, v AS (
          SELECT *, CASE i WHEN 0 THEN amount ELSE '-0x1' END AS val FROM traces)
        SELECT hash AS transaction_hash, line - 1 AS transaction_index, 'b' || k AS block_hash,
        k AS block_number, 'p' || part AS from_address,
        CASE WHEN line = 7 THEN '' ELSE 's' || supp END AS to_address, {_decimal("val")} AS value,
        val AS value_string, flag || state AS input, '' AS output, 'CALL' AS type,
        CASE i WHEN 0 THEN 'call' ELSE 'create' END AS trace_type,
        CASE i WHEN 0 THEN 'call' ELSE '' END AS call_type, 21000 + qty - i AS gas,
        21000 + qty - 2 * i AS gas_used, 1 - i AS subtraces,
        CAST(CASE i WHEN 0 THEN -1 ELSE 2 END AS BIGINT) AS trace_address,
        CASE i WHEN 0 THEN 'out of gas' ELSE '' END AS error, i AS status,
        'call_' || hash || '_' || i AS trace_id FROM v""",
    "evm_trace_addresses": f"""WITH {_L}, {_TRACES} SELECT 'call_' || hash || '_' || i AS trace_id,
        CAST(j AS BIGINT) AS position, CAST(j AS BIGINT) AS step
        FROM traces, (VALUES (0), (1)) t(j) WHERE i = 1""",
    "evm_unsigned_decimals": f"""WITH {_L} SELECT hash AS transaction_hash,
        CAST(part AS VARCHAR) AS nonce, CAST(supp + 1 AS VARCHAR) AS gas_price,
        CAST(k // {_SIZE} * {_SIZE} AS VARCHAR) AS "_partition_by",
        CAST(k AS VARCHAR) AS "_repartition_by_range" FROM l""",
    "evm_parsed_json_blocks": f"""WITH {_O}, {_P}
        SELECT 't' || p.k || '-' || p.kind AS transaction_hash, p.cust AS nonce,
          {_decimal("(" + _POSTING_VALUE + ")")} AS value, p.k AS "_repartition_by_range"
        FROM p""",
    "bitcoin_transactions_split": f"""WITH {_O}, {_P}, {_L} SELECT
        {_BITCOIN_TX.format(name="t.hash", index="(t.line - 1)")} {_layout("o.k")}
        FROM l t JOIN o ON o.k = t.k""",
    "bitcoin_transactions_nested": f"""WITH {_O}, {_P} SELECT
        {_BITCOIN_TX.format(name="'t' || t.k || '-' || t.kind", index="t.idx")} {_layout("o.k")}
        FROM p t JOIN o ON o.k = t.k""",
    "bitcoin_blocks_table": f"""WITH {_O}, {_P} SELECT {_BITCOIN_HEADER}
        coalesce((SELECT string_agg('t' || p.k || '-' || p.kind, ',' ORDER BY p.idx)
          FROM p WHERE p.k = o.k), 'none') AS transactions, {_layout("o.k")} FROM o""",
    "bitcoin_inputs": f"""WITH {_L}, {_INPUTS} SELECT hash, i AS index,
        CASE WHEN mints THEN 'cb' || hash ELSE '' END AS minted,
        CASE WHEN mints THEN '' ELSE 'prev-' || hash END AS spent_transaction_hash,
        CASE WHEN mints THEN 0 ELSE i END AS spent_output_index,
        CASE WHEN mints THEN '' ELSE 'asm' || i END AS script_asm,
        CASE WHEN mints THEN '' ELSE 'hex' || i END AS script_hex,
        4294967295 - i AS sequence,
        CAST(CASE WHEN i = 1 THEN 2 ELSE -1 END AS BIGINT) AS transaction_input_witnesses,
        CASE WHEN mints THEN '' ELSE 'pubkeyhash' END AS type,
        CASE WHEN mints THEN '' ELSE 'a' || supp END AS address,
        CASE WHEN mints THEN 0 ELSE cents + i END AS value FROM inputs""",
    "bitcoin_input_witnesses": f"""WITH {_L}, {_INPUTS} SELECT hash, i AS input,
        CAST(j AS BIGINT) AS position, CASE j WHEN 0 THEN 'w1' ELSE 'w' || hash END AS witness
        FROM inputs, (VALUES (0), (1)) t(j) WHERE i = 1""",
    "bitcoin_outputs": f"""WITH {_L} SELECT hash, CAST(i AS BIGINT) AS index,
        CASE i WHEN 0 THEN 'OP_DUP' ELSE '' END AS script_asm,
        CASE i WHEN 0 THEN '76' ELSE '' END AS script_hex,
        CASE i WHEN 0 THEN 'pubkeyhash' ELSE '' END AS type,
        CASE i WHEN 0 THEN 'a' || supp ELSE '' END AS address, cents - i AS value
        FROM l, (VALUES (0), (1)) n(i) WHERE i = 0 OR (line - 1) % 2 = 1""",
    "rosetta_transactions_table": f"""WITH {_O}, {_P} SELECT
        't' || k || '-' || kind AS transaction_hash, CAST(idx AS BIGINT) AS transaction_index,
        'b' || k AS block_hash, k AS block_number, ts AS block_timestamp,
        CAST(CASE WHEN kind = 1 THEN 1 ELSE 2 END AS BIGINT) AS operations,
        CAST(CASE WHEN kind = 1 THEN 1 ELSE 2 END AS BIGINT) AS operation_count,
        {_list("kind")} AS related_transactions, {_ROSETTA_TX_METADATA} AS metadata,
        {_layout("k")} FROM p""",
    "rosetta_blocks_table": f"""WITH {_O}, {_P} SELECT 'b' || k AS hash,
        CASE WHEN k > 0 THEN 'b' || (k - 1) ELSE '' END AS parent_hash, k AS number,
        greatest(k - 1, 0) AS parent_number, ts AS timestamp,
        (SELECT count(*) FROM p WHERE p.k = o.k) AS transaction_count,
        coalesce((SELECT string_agg('t' || p.k || '-' || p.kind, ',' ORDER BY p.idx)
          FROM p WHERE p.k = o.k), 'none') AS transactions,
        CASE WHEN st = 'O' THEN '' ELSE {_ROSETTA_METADATA} END AS metadata,
        {_layout("k")} FROM o""",
    "rosetta_operations": f"""WITH {_O}, {_P}, {_OPERATIONS}, v AS (SELECT *,
          CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN repeat('9', 39)
            WHEN i = 0 THEN '-' || cents ELSE CAST(cents AS VARCHAR) END AS val FROM ops)
        SELECT 't' || k || '-' || kind AS transaction_hash, i AS operation_index,
        CASE WHEN i > 0 THEN i + 5 ELSE 0 END AS network_index,
        {_list("i")} AS related_operations,
        CASE WHEN kind = 2 THEN 'FEE' ELSE 'TRANSFER' END AS type, 'SUCCESS' AS status,
        CASE WHEN kind = 1 THEN '' ELSE 'c' || cust END AS account_address,
        CASE WHEN kind = 1 OR i = 0 THEN '' ELSE 'sub' || cust END AS sub_account_address,
        {_decimal("val")} AS amount_value, val AS amount_string,
        CASE WHEN kind = 1 THEN '' ELSE 'USD' END AS amount_symbol,
        CAST(CASE WHEN kind = 1 THEN 0 ELSE 2 END AS BIGINT) AS amount_decimals,
        CASE WHEN kind = 2 THEN 'coin' || i ELSE '' END AS coin_change_identifier,
        CASE WHEN kind = 2 THEN CASE i WHEN 0 THEN 'COIN_CREATED' ELSE 'COIN_SPENT' END
          ELSE 'COIN_ACTION_UNSPECIFIED' END AS coin_change_action,
        CASE WHEN kind = 0 THEN '{{"from":"c' || cust || '","step":' || i || '}}' ELSE '' END
          AS metadata FROM v""",
    "rosetta_related_operations": f"""WITH {_O}, {_P}, {_OPERATIONS}
        SELECT 't' || k || '-' || kind AS transaction_hash, i AS operation,
          CAST(0 AS BIGINT) AS operation_index, CAST(0 AS BIGINT) AS network_index
        FROM ops WHERE i = 1""",
    "rosetta_related_transactions": f"""WITH {_O}, {_P}
        SELECT 't' || k || '-' || kind AS of_transaction, 't' || k || '-' || i AS transaction_hash,
          CASE i WHEN 0 THEN 'DIRECTION_UNSPECIFIED' ELSE 'BACKWARD' END AS direction
        FROM p, (VALUES (0), (1)) n(i) WHERE i < kind""",
    "rosetta_parsed_json_blocks": f"""WITH {_O}, {_P}
        SELECT 't' || k || '-' || kind AS transaction_hash,
          CAST(idx AS BIGINT) AS transaction_index,
          CAST(CASE WHEN kind = 1 THEN 1 ELSE 2 END AS BIGINT) AS operation_count,
          {_ROSETTA_TX_METADATA} AS metadata, k AS "_repartition_by_range" FROM p""",
    "resolved_events": f"""WITH {_O}, {_E} SELECT seq AS sequence_num, k AS number,
        'b' || k AS hash, 'c' || cust AS miner FROM e JOIN o ON k = height""",
    "missing_event_blocks": f"""WITH {_O}, {_E} SELECT seq AS sequence_num,
        kind_of_event AS type, CAST(1 AS BIGINT) AS tag, height, 'b' || height AS hash
        FROM e WHERE height NOT IN (SELECT k FROM o WHERE st = 'F')""",
    "evm_streamed_transactions": f"""WITH {_O}, {_P}, {_E}
        SELECT {_EVENT} {_POSTING} {_layout("e.seq")} FROM e JOIN p ON p.k = e.height""",
    "evm_streamed_split_transactions": f"""WITH {_L}, {_E} SELECT {_EVENT}
        l.hash AS transaction_hash, line - 1 AS transaction_index, {_decimal("amount")} AS value,
        {_layout("e.seq")} FROM e JOIN l ON l.k = e.height""",
    "evm_streamed_blocks": f"""WITH {_O}, {_P}, {_E}
        SELECT {_EVENT} {_BLOCK} {_layout("e.seq")} FROM e JOIN o ON o.k = e.height""",
    "evm_raw_streamed_transactions": f"""WITH {_O}, {_P}, {_E} SELECT {_EVENT}
        't' || p.k || '-' || p.kind AS transaction_hash, CAST(p.idx AS BIGINT) AS transaction_index,
        'b' || p.k AS block_hash, p.k AS block_number, p.ts AS block_timestamp,
        't' || p.k || '-' || p.kind AS payload_hash, p.cust AS payload_nonce,
        CAST(2 - p.kind AS BIGINT) AS payload_traces, {_layout("e.seq")}
        FROM e JOIN p ON p.k = e.height""",
    "rosetta_raw_streamed_transactions": f"""WITH {_O}, {_P}, {_E} SELECT {_EVENT}
        p.k AS number, 'b' || p.k AS hash, greatest(p.k - 1, 0) AS parent_number,
        CASE WHEN p.k > 0 THEN 'b' || (p.k - 1) ELSE '' END AS parent_hash, p.ts AS timestamp,
        CAST(p.idx AS BIGINT) AS transaction_index, 't' || p.k || '-' || p.kind AS payload_hash,
        CAST(CASE WHEN p.kind = 1 THEN 1 ELSE 2 END AS BIGINT) AS payload_operations,
        {_layout("e.seq")} FROM e JOIN p ON p.k = e.height""",
    "reorganised_blocks": f"""WITH {_E} SELECT height AS number,
        count(*) FILTER (kind_of_event = 'BLOCK_ADDED') AS added,
        count(*) FILTER (kind_of_event = 'BLOCK_REMOVED') AS removed,
        count(*) FILTER (kind_of_event = 'UNKNOWN') AS unknown FROM e GROUP BY 1""",
    "batch_query": f"""WITH {_O}, {_P} SELECT 't' || p.k || '-' || p.kind AS transaction_hash,
        {_decimal("(" + _POSTING_VALUE + ")")} AS value, {_layout("p.k")}
        FROM p WHERE p.k < (SELECT max(k) - 100 FROM o)""",
    "stream_query": f"""WITH {_O}, {_P}, {_E} SELECT {_EVENT} 'b' || o.k AS hash,
        (SELECT count(*) FROM p WHERE p.k = o.k) AS transaction_count,
        CASE WHEN o.st = 'P' THEN '0' ELSE o.cents || repeat('0', 20) END AS total_difficulty,
        {_layout("e.seq")} FROM e JOIN o ON o.k = e.height""",
    "stream_replay": _STREAMED_VALUES,
    "stream_run": _STREAMED_VALUES,
    "stream_restart": _STREAMED_VALUES,
    "stream_backfill": _STREAMED_VALUES,
    "sink_round_trip": f"""WITH {_L} SELECT hash AS transaction_hash,
        line - 1 AS transaction_index, {_decimal("amount")} AS value, {_layout("k")} FROM l""",
    "sink_range": f"""WITH {_L}, t AS (SELECT max(o_orderkey) - 99 AS z FROM orders)
        SELECT hash AS transaction_hash, line - 1 AS transaction_index,
          {_decimal("amount")} AS value, {_layout("k")}
        FROM l, t WHERE k >= z // 2 AND k < z""",
    "catalog_tables": f"""WITH {_O}, {_P}, {_E},
        counts AS (SELECT (SELECT count(*) FROM p) AS txs, (SELECT count(*) FROM o) AS blocks,
          (SELECT count(*) FROM e JOIN p ON p.k = e.height) AS streamed_txs,
          (SELECT count(*) FROM e) AS events)
        SELECT chain, 'table=' || t || '/format=' || f || '/encoding=' || enc AS table_key,
          CAST(width AS BIGINT) AS columns,
          CASE t WHEN 'transactions' THEN txs WHEN 'blocks' THEN blocks
            WHEN 'streamed_blocks' THEN events ELSE streamed_txs END AS rows
        FROM counts, (VALUES
          ('ethereum', 'transactions', 'native', 'none', 22),
          ('ethereum', 'blocks', 'native', 'none', 26),
          ('ethereum', 'streamed_transactions', 'native', 'none', 24),
          ('ethereum', 'streamed_blocks', 'native', 'none', 28),
          ('ethereum', 'streamed_transactions', 'native', 'raw', 10),
          ('ethereum', 'transactions', 'rosetta', 'none', 11),
          ('ethereum', 'blocks', 'rosetta', 'none', 10),
          ('ethereum', 'streamed_transactions', 'rosetta', 'raw', 7),
          ('bitcoin', 'transactions', 'native', 'none', 18),
          ('bitcoin', 'blocks', 'native', 'none', 18)) v(chain, t, f, enc, width)""",
    "blocks_processed": "SELECT count(*) AS blocks_processed FROM orders",
}

_TIP = "(SELECT max(o_orderkey) - 100 FROM orders)"
_GAPS = f"""gone AS (
  SELECT k, k - row_number() OVER (ORDER BY k) AS island FROM (
    SELECT unnest(range(0, {_TIP})) AS k EXCEPT SELECT l_orderkey FROM lineitem))"""

_ORACLES |= {
    "chain_metadata": """SELECT (SELECT min(o_orderkey) FROM orders) AS block_start_height,
        m AS irreversible_distance, (SELECT max(o_orderkey) FROM orders) - m AS tip_height
        FROM (SELECT max(n) AS m FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey))""",
    "stream_positions": """WITH b AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events),
        p AS (SELECT 'EARLIEST' AS position, lo AS s FROM b UNION ALL SELECT 'LATEST', hi FROM b
          UNION ALL SELECT 'MIDDLE', (lo + hi) // 2 FROM b)
        SELECT position, min(event_id) AS first_sequence, count(*) AS events
        FROM p JOIN events ON event_id >= s GROUP BY position""",
    "required_members": """SELECT o_orderstatus AS status, count(*) AS blocks,
        CAST(sum(o_orderkey) AS BIGINT) AS numbers FROM orders GROUP BY 1""",
    "height_gaps": f"""WITH {_GAPS} SELECT min(k) AS gap_start, max(k) + 1 AS gap_end
        FROM gone GROUP BY island""",
    "doubled_heights": f"""SELECT l_orderkey AS height, count(*) AS blocks FROM lineitem
        WHERE l_orderkey < {_TIP} GROUP BY 1 HAVING count(*) > 1""",
    "event_store_replay": _STREAMED_VALUES,
    "event_store_range": f"""WITH {_E} SELECT seq AS sequence_num, kind_of_event AS type,
        CAST(1 AS BIGINT) AS tag, height, 'b' || height AS hash
        FROM e WHERE seq >= (SELECT (min(seq) + max(seq)) // 2 FROM e)""",
    "bucketed_events": _STREAMED_VALUES,
    "ledger_split": f"""WITH {_O}, {_L} SELECT l.hash AS transaction_hash,
        line - 1 AS transaction_index, {_decimal("amount")} AS value, 'c' || o.cust AS miner,
        {_layout("l.k")} FROM l JOIN o ON o.k = l.k WHERE l.k < {_TIP}""",
    "ledger_split_stream": _ORACLES["evm_streamed_split_transactions"],
    "ledger_spread": _ORACLES["batch_query"],
    "batch_backfill": f"""WITH {_L} SELECT hash AS transaction_hash, line - 1 AS transaction_index,
        {_decimal("amount")} AS value, {_layout("k")} FROM l WHERE k < {_TIP}""",
    "backfill_progress": f"""SELECT 'blocks' AS table_name, CAST({_TIP} AS BIGINT) AS blocks_processed
        UNION ALL SELECT 'streamed_blocks', count(*) FROM events""",
    "stream_small_batches": _STREAMED_VALUES,
    "stream_overlap": _STREAMED_VALUES,
    "catalog_statistics": f"""WITH {_O}, {_P}, t AS (SELECT {_TIP} AS z),
        r AS (SELECT 'transactions' AS "table", k FROM p UNION ALL SELECT 'blocks', k FROM o)
        SELECT "table", count(*) AS rows,
          count(*) FILTER (k // {_SIZE} * {_SIZE} >= z // 2 // {_SIZE} * {_SIZE}) AS later_rows
        FROM r, t WHERE k < z GROUP BY 1""",
}

_ORACLES["missing_event_blocks_shuffled"] = _ORACLES["missing_event_blocks"]


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
