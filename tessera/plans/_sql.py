"""DuckDB building blocks for oracle queries (views of the test tables)."""

from ..functions.lexicon import AB_GROUPS, EVENT_TYPE_ROLES, INTERACTION_WEIGHTS

INTER = """inter AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         event_type AS interaction_type, ts
  FROM events)"""

CATALOG = """cat AS (
  SELECT p_partkey AS item_id, p_name AS name, p_type AS category, p_retailprice AS price,
         concat_ws(' ', p_name, p_brand, p_type) AS features, p_name AS tags
  FROM part)"""

RATINGS = """ratings AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber) AS rid, o_custkey AS user_id, l_partkey AS item_id, CAST(ceil(l_quantity / 10) AS INTEGER) AS rating,
         o_orderdate AS ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def weight_case(col: str = "interaction_type") -> str:
    table = {src: INTERACTION_WEIGHTS[dst] for src, dst in EVENT_TYPE_ROLES.items()}
    for k, v in INTERACTION_WEIGHTS.items():
        table.setdefault(k, v)
    whens = " ".join(f"WHEN '{k}' THEN {float(v)}" for k, v in table.items())
    return f"CASE {col} {whens} ELSE 1.0 END"


def decay_expr(ts: str = "ts", ref: str = "(SELECT max(ts) FROM events)", hl: float = 14.0) -> str:
    return (f"pow(0.5, greatest(0.0, date_diff('microsecond', {ts}, {ref}) / 86400e6) / {float(hl)})")


def md5_bucket(col: str, n: int) -> str:
    digits = f"list_transform(range(1, 33), lambda i: instr('0123456789abcdef', substr(md5(CAST({col} AS VARCHAR)), i, 1)) - 1)"
    return f"(list_reduce({digits}, lambda a, d: (a * 16 + d) % {n}) % {n})"


def group_name(bucket: str) -> str:
    names = ", ".join(f"'{g}'" for g, _, _ in AB_GROUPS)
    return f"[{names}][{bucket} + 1]"
