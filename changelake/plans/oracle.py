"""The registered queries in DuckDB SQL."""

from __future__ import annotations

from changelake.plans.feeds import BATCH_ROWS, DROPPED_ON, RENAMED_ON
from changelake.plans.queries import TABLES

ORACLE: dict[str, str] = {}

# Fixed values, written out again so that a change in the library shows: white space
# beyond tab and line ends, and the characters a code keeps.
_SPACE = (
    "\x0b\x0c\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
_CODE = "0-9A-Za-z\u00c0-\u1ef9"

# Target column, type, source column and cleaner of the two silver sources.
_SILVER_A = """
    STT | string | stt | raw
    Mã KH | string |  | raw
    Mã HĐ | string |  | raw
    Mã nhân viên | string | ma_nv | code
    NV quản lý | string |  | raw
    Mã lái xe | string |  | raw
    ID cuốc xe | string |  | raw
    Số thẻ | string | so_the | raw
    Tên trên thẻ | string | ten_in_tren_the | ws
    Sản phẩm | string | san_pham | ws
    Số tiền | bigint | so_tien | number
    Số giao dịch | string | so_giao_dich | code
    Mã giao dịch | string |  | raw
    Mã tài | string |  | raw
    Ngày giao dịch | date |  | raw
    Thời điểm giao dịch | string |  | raw
    Ngày đi thực tế | string | ngay_di_thuc_te | date
    Ngày hiệu lực | string | ngay_hieu_luc | date
    Biển số xe | string | bs_xe | code
    Điểm đón | string | diem_don_ghi_chu | ws
    Điểm trả | string | diem_tra | ws
    Đơn vị phát sinh | string | don_vi_phat_sinh | ws
    Mã ĐV phát sinh | string |  | raw
    Tên ĐV phát sinh | string |  | raw
    Mã ĐV quản lý KH | string |  | raw
    Tên ĐV quản lý KH | string |  | raw
    Trạng thái giao dịch | string |  | raw
    Loại giao dịch | string |  | raw
    Ghi chú | string |  | raw
"""
_SILVER_B = """
    STT | string | stt | int
    Mã KH | string | ma_kh | code
    Mã HĐ | string | ma_hd | code
    Mã nhân viên | string |  | raw
    NV quản lý | string | nv_quan_ly | code
    Mã lái xe | string | ma_lai_xe | code
    ID cuốc xe | string | id_cuoc_xe | code
    Số thẻ | string | so_the | raw
    Tên trên thẻ | string | ten_in_tren_the | ws
    Sản phẩm | string | san_pham | ws
    Số tiền | bigint | so_tien | number
    Số giao dịch | string |  | raw
    Mã giao dịch | string | ma_gd | code
    Mã tài | string | so_tai | code
    Ngày giao dịch | date |  | raw
    Thời điểm giao dịch | string | thoi_diem_giao_dich | date
    Ngày đi thực tế | string |  | raw
    Ngày hiệu lực | string |  | raw
    Biển số xe | string |  | raw
    Điểm đón | string |  | raw
    Điểm trả | string |  | raw
    Đơn vị phát sinh | string |  | raw
    Mã ĐV phát sinh | string | ma_dv_phat_sinh_gd | code
    Tên ĐV phát sinh | string | ten_dv_phat_sinh_gd | ws
    Mã ĐV quản lý KH | string |  | raw
    Tên ĐV quản lý KH | string |  | raw
    Trạng thái giao dịch | string | trang_thai | ws
    Loại giao dịch | string | loai_gd | ws
    Ghi chú | string |  | raw
"""


def _trim(x: str) -> str:
    return f"trim({x}, chr(9) || chr(10) || chr(13) || '{_SPACE}')"


def _ws(x: str) -> str:
    return rf"CASE WHEN {x} <> '' THEN trim(regexp_replace({x}, '[\s]+', ' ', 'g'), ' ') END"


def _code(x: str) -> str:
    # DuckDB maps the sharp s to one capital letter; full case mapping makes it SS.
    x = f"replace({x}, 'ß', 'ss')"
    return f"CASE WHEN {x} <> '' THEN upper(regexp_replace({x}, '[^{_CODE}]', '', 'g')) END"


def _number(x: str) -> str:
    digits = _trim(f"translate({x}, ',. ', '')")
    return f"CASE WHEN regexp_full_match({digits}, '[0-9]+') THEN TRY_CAST({digits} AS BIGINT) END"


def _date(x: str) -> str:
    p = f"string_split(translate({_trim(x)}, '/. ', '---'), '-')"
    whole = " AND ".join(f"regexp_full_match({p}[{i}], '[+]?[0-9]+')" for i in (1, 2, 3))
    n = [f"TRY_CAST({p}[{i}] AS BIGINT)" for i in (1, 2, 3)]

    def text(y: str, m: str, d: str) -> str:
        iso = f"printf('%04d-%02d-%02d', {y}, {m}, {d})"
        return f"strftime(TRY_CAST({iso} AS DATE), '%d-%m-%Y')"

    return (
        f"CASE WHEN len({p}) = 3 AND {whole} THEN"
        f" CASE WHEN {n[0]} BETWEEN 1000 AND 9999 THEN {text(*n)}"
        f" WHEN {n[2]} BETWEEN 1000 AND 9999 THEN {text(n[2], n[1], n[0])} END END"
    )


# Inputs, as in `feeds`

SNAPSHOTS = """
prev AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'),
cur AS (SELECT * REPLACE (
    CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE o_orderstatus <> 'F')
"""

FEED = f"""
feed AS (SELECT user_id, event_id AS seq,
    CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
    value, event_type, event_id // {BATCH_ROWS} AS batch_id, ts,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 50 THEN 'shop.users' ELSE 'crm.users' END AS table_key
  FROM events),
load_feed AS (SELECT * REPLACE (
    CASE WHEN ts < TIMESTAMP '2024-01-04' THEN 'INITIAL_LOAD' ELSE operation END AS operation) FROM feed)
"""

ENVELOPES = """
rows AS (SELECT event_id AS seq, k,
    CASE WHEN ts < TIMESTAMP '2024-01-04' THEN 'INITIAL_LOAD' WHEN event_type = 'signup' THEN 'insert'
      WHEN event_type = 'error' THEN 'DELETE' WHEN event_type = 'view' AND value > 100 THEN 'TRUNCATE'
      ELSE 'Update' END AS operation,
    CASE WHEN k < 25 THEN 'public.Orders' WHEN k < 50 THEN 'dbo.VISITS' WHEN k < 75 THEN ' Accounts'
      WHEN k < 95 THEN 'public.leads' WHEN k < 98 THEN '' END AS tbl,
    CASE WHEN value < 0.5 THEN '' WHEN k < 50 THEN 'shop' ELSE ' crm ' END AS db,
    CASE WHEN value < 10 THEN 'mssql' WHEN value < 300 THEN 'postgresql' ELSE 'oracle' END AS source,
    ts, user_id, event_type AS kind, props AS raw_props,
    CAST(round(value * 100) AS BIGINT) AS raw_cents,
    event_type = 'click' AND value < 1 AS broken, event_type = 'click' AND value >= 1 AND value < 3 AS repeated
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)),
parsed AS (SELECT *, upper(operation) AS op, trim(db) AS database,
    lower(trim(string_split(tbl, '.')[-1])) AS "table",
    CASE WHEN operation <> 'DELETE' THEN raw_cents END AS cents,
    CASE WHEN operation <> 'DELETE' THEN kind END AS event_type,
    CASE WHEN operation <> 'DELETE' THEN raw_props END AS props,
    CASE WHEN broken THEN 'malformed' WHEN operation = 'TRUNCATE' THEN 'unknown operation'
      WHEN db = '' THEN 'no database' WHEN coalesce(tbl, '') = '' THEN 'no table'
      WHEN repeated THEN 'repeated name' END AS fault
  FROM rows),
good AS (SELECT *, database || '.' || "table" AS table_key,
    database || '_' || "table" || '_' || user_id AS record_id FROM parsed WHERE fault IS NULL)
"""

CATALOGS = """
lines AS (SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag, min(l_linestatus) AS status,
    any_value(o_orderpriority) AS prio, any_value(o_orderstatus) AS state
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL),
typed AS (SELECT *, CASE flag WHEN 'A' THEN 'text' WHEN 'N' THEN 'integer' ELSE 'date' END AS data_type,
    CASE WHEN status = 'F' THEN '0' END AS zero, prio <> '1-URGENT' AND flag = 'R' AS returned FROM lines),
old AS (SELECT 'shop.o' || l_orderkey AS table_full, 'c' || l_linenumber AS "column",
    l_linenumber AS ordinal, data_type, zero AS column_default FROM typed
  WHERE NOT (prio = '2-HIGH' AND state = 'P') AND NOT (prio <> '1-URGENT' AND flag = 'N' AND status = 'O')),
new AS (SELECT 'shop.' || CASE WHEN prio = '1-URGENT' THEN 'r' ELSE 'o' END || l_orderkey AS table_full,
    CASE WHEN returned THEN 'd' ELSE 'c' END || l_linenumber AS "column", l_linenumber AS ordinal, data_type,
    CASE WHEN returned AND status = 'O' THEN '1' ELSE zero END AS column_default FROM typed
  WHERE NOT (prio = '2-HIGH' AND state = 'F') AND NOT (prio <> '1-URGENT' AND flag = 'A' AND status = 'F'))
"""


def _fingerprints(name: str) -> str:
    return f"""(SELECT table_full, string_agg("column" || ':' || data_type || ':' || coalesce(column_default, '-'),
        ',' ORDER BY "column") AS fp FROM {name} GROUP BY table_full)"""


def _only(name: str, other: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY fp ORDER BY md5(table_full)) AS rank
      FROM {_fingerprints(name)} WHERE table_full NOT IN (SELECT table_full FROM {other})"""


TABLE_CHANGES = f"""{CATALOGS},
gone AS ({_only("old", "new")}), come AS ({_only("new", "old")}),
tables AS (SELECT g.table_full AS old_table, c.table_full AS new_table
  FROM gone g FULL JOIN come c ON g.fp = c.fp AND g.rank = c.rank)
"""


def _column_changes(match_default: bool) -> str:
    default = ", column_default" if match_default else ""
    same = "AND g.column_default IS NOT DISTINCT FROM c.column_default" if match_default else ""

    def only(name: str, other: str) -> str:
        return f"""SELECT *, row_number() OVER (
            PARTITION BY table_full, data_type{default} ORDER BY ordinal) AS rank
          FROM {name} x WHERE table_full IN (SELECT table_full FROM {other})
          AND NOT EXISTS (SELECT 1 FROM {other} y WHERE y.table_full = x.table_full AND y."column" = x."column")"""

    return f"""{CATALOGS},
    gone_columns AS ({only("old", "new")}), come_columns AS ({only("new", "old")}),
    columns AS (SELECT coalesce(g.table_full, c.table_full) AS "table", g."column" AS old_column,
        c."column" AS new_column, c.data_type AS data_type, c.column_default AS "default"
      FROM gone_columns g FULL JOIN come_columns c ON g.table_full = c.table_full
        AND g.data_type = c.data_type AND g.rank = c.rank {same})
    """


# A state follows from one sequential pass, written here as windows over each key

_W = "OVER (PARTITION BY {} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND"


def _state(feed: str) -> str:
    return f"""
    numbered AS (SELECT *, max(CASE WHEN operation <> 'DELETE' THEN 1 ELSE 0 END)
        {_W.format("user_id")} CURRENT ROW) AS present FROM {feed}),
    flagged AS (SELECT *, CASE WHEN operation = 'DELETE' THEN true
        WHEN operation IN ('INSERT', 'INITIAL_LOAD') THEN false END AS flag FROM numbered WHERE present = 1),
    final AS (SELECT user_id, arg_max(value, seq) FILTER (operation <> 'DELETE') AS value,
        arg_max(event_type, seq) FILTER (operation <> 'DELETE') AS event_type,
        arg_max(operation, seq) AS _operation, max(seq) AS _seq,
        coalesce(arg_max(flag, seq) FILTER (flag IS NOT NULL), false) AS deleted
      FROM flagged GROUP BY user_id)
    """


_ROW = "table_key, user_id"


def _side(frame: str, name: str) -> str:
    def last(column: str, where: str) -> str:
        return f"last_value(CASE WHEN {where} THEN {column} END IGNORE NULLS) {_W.format(_ROW)} {frame})"

    image = "operation <> 'DELETE'"
    return f"""{last("value", image)} AS {name}_value, {last("event_type", image)} AS {name}_event_type,
      CASE WHEN {last("true", image)} THEN coalesce({last("flag", "flag IS NOT NULL")}, false) END
        AS {name}_deleted"""


CHANGE_LOG = f"""{FEED},
numbered AS (SELECT *, max(CASE WHEN operation <> 'DELETE' THEN 1 ELSE 0 END)
    {_W.format(_ROW)} CURRENT ROW) AS present FROM feed),
flagged AS (SELECT *, CASE WHEN operation = 'DELETE' THEN CASE WHEN present = 1 THEN true END
    WHEN operation = 'INSERT' THEN false END AS flag FROM numbered),
log AS (SELECT user_id, seq, operation, batch_id, table_key, {_side("1 PRECEDING", "before")},
  {_side("CURRENT ROW", "after")} FROM flagged)
"""

SUMMARY = f"""{FEED},
summary AS (SELECT table_key, batch_id,
    CASE WHEN bool_and(operation = 'INITIAL_LOAD') THEN 'batch' ELSE 'stream' END AS commit_type,
    CASE WHEN bool_and(operation = 'INITIAL_LOAD') THEN 'batch' WHEN min(operation) = max(operation)
      THEN lower(min(operation)) ELSE 'mixed' END AS operation,
    count(*) AS total, count(*) FILTER (operation IN ('INSERT', 'INITIAL_LOAD')) AS inserts,
    count(*) FILTER (operation = 'UPDATE') AS updates, count(*) FILTER (operation = 'DELETE') AS deletes
  FROM load_feed GROUP BY ALL),
births AS (SELECT table_key, batch_id, count(*) AS new_rows FROM
    (SELECT table_key, user_id, min(batch_id) AS batch_id FROM load_feed WHERE operation <> 'DELETE' GROUP BY ALL)
  GROUP BY ALL),
commits AS (SELECT s.*, coalesce(b.new_rows, 0) AS new_rows,
    CAST(sum(coalesce(b.new_rows, 0)) OVER (PARTITION BY s.table_key ORDER BY s.batch_id) AS BIGINT) AS total_records
  FROM summary s LEFT JOIN births b USING (table_key, batch_id))
"""

ALL_TABLES = """
all_tables AS (SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'pg_catalog' WHEN '2-HIGH' THEN 'INFORMATION_SCHEMA'
      WHEN '3-MEDIUM' THEN 'sys' WHEN '4-NOT SPECIFIED' THEN 'dbo' ELSE 'public' END AS table_schema,
    't' || o_orderkey AS table_name, o_orderkey, o_orderstatus FROM orders),
user_tables AS (SELECT *, table_schema || '.' || table_name AS table_full FROM all_tables
  WHERE table_schema IN ('dbo', 'public') AND o_orderstatus <> 'P')
"""

WRITTEN = """
written AS (SELECT *, CASE WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN o_orderpriority = '2-HIGH' THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN o_orderpriority = '3-MEDIUM' THEN strftime(o_orderdate, '%-d.%-m.%Y')
    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN strftime(o_orderdate, ' %Y/%-m/%-d ')
    WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%d-%m') ELSE 'n/a' END AS written FROM orders)
"""

SOURCES = f"""{WRITTEN},
source_a AS (SELECT CAST(o_orderkey AS VARCHAR) AS stt, o_orderpriority AS ma_nv, '9704-' || o_custkey AS so_the,
    '  NGUYỄN ' || chr(9) || ' Văn  ' || o_custkey || chr(10) AS ten_in_tren_the,
    CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus || '  ' || chr(13) || chr(10) || ' ' || o_orderpriority
      END AS san_pham,
    format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) AS so_tien,
    'gd/' || o_orderkey || '-' || o_orderstatus AS so_giao_dich, written AS ngay_di_thuc_te,
    strftime(o_orderdate, '%d.%m.%Y') AS ngay_hieu_luc, '51đ-' || o_custkey || '.é' AS bs_xe,
    CASE WHEN o_orderstatus = 'P' THEN '   ' ELSE ' sân  bay ' || o_custkey END AS diem_don_ghi_chu,
    'quận   1' AS diem_tra,
    CASE WHEN o_orderstatus <> 'O' THEN 'đơn vị' || chr(9) || o_orderstatus END AS don_vi_phat_sinh,
    CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'True' WHEN o_orderstatus = 'F' THEN 'false'
      WHEN o_orderstatus = 'O' THEN 'None' END AS deleted
  FROM written),
live_a AS (SELECT * FROM source_a WHERE deleted IS DISTINCT FROM 'True'),
live_b AS (SELECT CASE WHEN l_returnflag = 'R' THEN 'x' ELSE '' END || l_orderkey AS stt, 'kh-' || l_suppkey AS ma_kh,
    'hđ/' || l_orderkey AS ma_hd, 'nv ' || l_suppkey AS nv_quan_ly, 'lx_' || l_partkey AS ma_lai_xe,
    l_orderkey || '#' || l_linenumber AS id_cuoc_xe, '9704-' || l_partkey AS so_the,
    ' TRẦN  ' || l_suppkey AS ten_in_tren_the, l_returnflag || chr(9) || chr(9) || l_linestatus AS san_pham,
    CASE WHEN l_returnflag = 'A' THEN '-' || CAST(floor(l_extendedprice) AS BIGINT)
      ELSE CAST(floor(l_extendedprice) AS BIGINT) || '.00' END AS so_tien,
    'gd-' || l_orderkey AS ma_gd, '---' AS so_tai, strftime(l_shipdate, '%-d/%-m/%Y') AS thoi_diem_giao_dich,
    'đv.' || l_suppkey AS ma_dv_phat_sinh_gd, 'Đơn  vị ' || l_suppkey AS ten_dv_phat_sinh_gd,
    CASE WHEN l_returnflag = 'N' THEN 'thành  công' ELSE '' END AS trang_thai,
    'loại' || chr(10) || l_linestatus AS loai_gd
  FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_linestatus = 'O'))
"""

_CLEAN = {
    "raw": str,
    "ws": _ws,
    "code": _code,
    "number": _number,
    "date": _date,
    "int": lambda x: f"TRY_CAST({x} AS INT)",
}


def _conform(mapping: str, source: str) -> str:
    columns = []
    for line in mapping.strip().splitlines():
        name, kind, column, cleaner = [part.strip() for part in (line + " | |").split("|")][:4]
        value = _CLEAN[cleaner](column) if column else "NULL"
        columns.append(f'CAST({value} AS {"VARCHAR" if kind == "string" else kind}) AS "{name}"')
    return f"SELECT {', '.join(columns)} FROM {source}"


def _sql(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = (f"WITH {','.join(ctes)} {body}") if ctes else body


# Sources

_sql("catalog_tables", "SELECT table_full FROM user_tables", ALL_TABLES)
_sql(
    "catalog_columns",
    """SELECT table_full, 'c' || l_linenumber AS "column", l_linenumber AS ordinal,
      CASE WHEN max(l_returnflag) = 'A' THEN 'text' ELSE 'integer' END AS data_type,
      CAST(NULL AS VARCHAR) AS column_default
    FROM lineitem JOIN user_tables ON l_orderkey = o_orderkey GROUP BY table_full, l_linenumber""",
    ALL_TABLES,
)
_sql("snapshot_scan", "SELECT * FROM orders")
_sql(
    "silver_sources",
    """SELECT 'customer' AS source, 'ok' AS status, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'supplier', 'ok', count(*) FROM supplier
    UNION ALL SELECT 'missing', 'PATH_NOT_FOUND', NULL""",
)
_sql(
    "row_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES),
)
_sql("preview_top3", "SELECT * FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 3")

# Identity and text

_sql(
    "row_id",
    """SELECT doc_id, CASE WHEN quality = 1 THEN CAST(doc_id AS VARCHAR) ELSE md5('{"doc_id":' || doc_id
      || ',"quality":' || quality || ',"toxic":' || toxic || '}') END AS row_id FROM labels""",
)
_sql(
    "row_id_keyless",
    """SELECT l_orderkey, l_linenumber, count(*) AS n_ids FROM (SELECT DISTINCT * FROM lineitem)
    GROUP BY l_orderkey, l_linenumber""",
)
_sql("normalize_table_name", 'SELECT seq, database, "table" FROM parsed', ENVELOPES)
_sql(
    "record_id",
    """SELECT seq, concat_ws('_', database, "table", CAST(user_id AS VARCHAR)) AS record_id FROM parsed""",
    ENVELOPES,
)
_sql(
    "stringify_row",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
      CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CASE WHEN event_type <> 'view' THEN props END AS props,
      '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS nested,
      '[' || event_id || ',' || user_id || ']' AS list FROM events""",
)
_sql(
    "clean_number",
    f"SELECT l_orderkey, l_linenumber, amount, {_number('amount')} AS cleaned FROM amounts",
    """amounts AS (SELECT *, CASE l_returnflag WHEN 'A' THEN format('{:,.2f}', l_extendedprice)
      WHEN 'N' THEN ' ' || CAST(floor(l_extendedprice) AS BIGINT) ELSE '-' || CAST(l_quantity AS INT) END AS amount
    FROM lineitem)""",
)
_sql("clean_date", f"SELECT o_orderkey, written, {_date('written')} AS cleaned FROM written", WRITTEN)
_sql("clean_whitespace", f"SELECT doc_id, {_ws('text')} AS cleaned FROM documents")
_sql("clean_code", f"SELECT doc_id, {_code('text')} AS cleaned FROM documents")

# Snapshots

_ORDER = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_SAME = " AND ".join(f"p.{c} IS NOT DISTINCT FROM c.{c}" for c in _ORDER)
_IMAGES = ", ".join(
    f"{alias}.{c} AS {side}_{c}" for alias, side in (("p", "before"), ("c", "after")) for c in _ORDER
)
_DIFF = f"""SELECT CAST(coalesce(p.o_orderkey, c.o_orderkey) AS VARCHAR) AS row_id,
    CASE WHEN p.o_orderkey IS NULL THEN 'INSERT' WHEN c.o_orderkey IS NULL THEN 'DELETE' ELSE 'UPDATE' END
      AS operation, {_IMAGES}
  FROM prev p FULL JOIN cur c ON p.o_orderkey = c.o_orderkey
  WHERE p.o_orderkey IS NULL OR c.o_orderkey IS NULL OR NOT ({_SAME})"""
_sql("snapshot_diff", _DIFF, SNAPSHOTS)
_sql("snapshot_diff_narrow", _DIFF, SNAPSHOTS)
_LINE = """line l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag
    l_linestatus l_shipdate note""".split()
for _name in ("snapshot_diff_wide", "snapshot_diff_wide_narrow", "snapshot_diff_kept"):
    _sql(
        _name,
        f"""SELECT line AS row_id, 'UPDATE' AS operation, {", ".join(f"{c} AS before_{c}" for c in _LINE)},
          {", ".join(f"{c} + 1 AS after_{c}" if c == "l_extendedprice" else f"{c} AS after_{c}" for c in _LINE)}
        FROM wide WHERE l_suppkey % 100 = 0 AND l_orderkey % 7 = 0""",
        """wide AS (SELECT *, 'line ' || line AS note FROM (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey,
          strftime(l_shipdate, '%Y%m%d')) AS line FROM lineitem))""",
    )
_sql(
    "snapshot_diff_keyless",
    """SELECT * FROM (
      SELECT 'INSERT' AS operation, * FROM (SELECT * FROM c EXCEPT SELECT * FROM p)
      UNION ALL SELECT 'DELETE', * FROM (SELECT * FROM p EXCEPT SELECT * FROM c))""",
    "p AS (SELECT * FROM lineitem WHERE l_returnflag <> 'N' OR l_linestatus <> 'O')",
    "c AS (SELECT * FROM lineitem WHERE l_returnflag <> 'R')",
)
_sql("snapshot_inserts", "SELECT * FROM cur WHERE o_orderkey NOT IN (SELECT o_orderkey FROM prev)", SNAPSHOTS)
_sql(
    "snapshot_deletes",
    "SELECT * FROM prev WHERE o_orderkey NOT IN (SELECT o_orderkey FROM cur)",
    SNAPSHOTS,
)
_sql(
    "snapshot_updates",
    f"SELECT c.* FROM prev p JOIN cur c ON p.o_orderkey = c.o_orderkey WHERE NOT ({_SAME})",
    SNAPSHOTS,
)
_sql(
    "snapshot_last_wins",
    """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
      l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_shipdate DESC, l_quantity DESC, l_discount DESC,
      l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""",
)

# Envelopes

_sql(
    "envelope_build",
    """SELECT seq, operation, tbl AS "table", db AS database, source,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') AS timestamp, CAST(user_id AS VARCHAR) AS user_id,
      CAST(cents AS VARCHAR) AS cents, event_type, props FROM parsed""",
    ENVELOPES,
)
_FLAT = """SELECT seq, database AS _source_database, "table" AS _source_table, source AS _source_type,
    op AS _operation, record_id AS _record_id, CAST(user_id AS VARCHAR) AS user_id,
    CAST(cents AS VARCHAR) AS cents, event_type, props FROM good WHERE op {} 'INITIAL_LOAD'"""
_sql("envelope_flatten", _FLAT.format("<>"), ENVELOPES)
_sql("initial_load_flatten", _FLAT.format("="), ENVELOPES)
_sql(
    "route_operations",
    """SELECT seq, CASE WHEN NOT broken THEN op END AS operation, CASE WHEN broken OR op = 'TRUNCATE' THEN 'other'
      WHEN op = 'INITIAL_LOAD' THEN 'initial_load' ELSE 'change' END AS route FROM parsed""",
    ENVELOPES,
)
_sql("quarantine_rows", "SELECT seq, fault FROM parsed WHERE fault IS NOT NULL", ENVELOPES)
_sql("route_topics", """SELECT seq, database || '-' || "table" || '-topic' AS topic FROM good""", ENVELOPES)
_sql(
    "route_ddl_topics",
    """SELECT seq, CASE WHEN source = 'oracle' THEN 'unknown-ddl-topic' ELSE database || '-ddl-topic' END AS topic
    FROM parsed""",
    ENVELOPES,
)
_sql("events_per_table", "SELECT table_key, count(*) AS n FROM good GROUP BY table_key", ENVELOPES)

# Polls

_sql(
    "poll_row_messages",
    """SELECT 'shop-orders-topic' AS topic, row_id AS "key", operation, '2024-02-01T08:30:00' AS timestamp, row_id,
      row_id AS o_orderkey, after_o_custkey AS o_custkey, after_o_orderstatus AS o_orderstatus,
      after_o_totalprice AS o_totalprice, after_o_orderdate AS o_orderdate, after_o_orderpriority AS o_orderpriority
    FROM (""" + _DIFF + ")",
    SNAPSHOTS,
)
_sql(
    "poll_load_messages",
    """SELECT 'shop-customer-topic' AS topic, CAST(c_custkey AS VARCHAR) AS "key", 'INITIAL_LOAD' AS operation,
      'mssql' AS source, * FROM customer""",
)
_sql(
    "poll_schema_messages",
    """SELECT 'shop-ddl-topic' AS topic, "table" AS "key",
      CASE WHEN old_column IS NULL THEN 'ADD_COLUMN' WHEN new_column IS NULL THEN 'DROP_COLUMN'
        ELSE 'RENAME_COLUMN' END AS operation, "table", NULL AS old_table, NULL AS new_table,
      CASE WHEN new_column IS NULL OR old_column IS NULL THEN coalesce(new_column, old_column) END AS "column",
      CASE WHEN new_column IS NOT NULL THEN old_column END AS old_column,
      CASE WHEN old_column IS NOT NULL THEN new_column END AS new_column,
      CASE WHEN new_column IS NOT NULL THEN data_type END AS data_type,
      CASE WHEN old_column IS NULL THEN "default" END AS "default" FROM columns
    UNION ALL SELECT 'shop-ddl-topic', coalesce(old_table, new_table),
      CASE WHEN old_table IS NULL THEN 'ADD_TABLE' WHEN new_table IS NULL THEN 'DROP_TABLE' ELSE 'RENAME_TABLE' END,
      CASE WHEN old_table IS NULL OR new_table IS NULL THEN coalesce(old_table, new_table) END,
      CASE WHEN new_table IS NOT NULL THEN old_table END, CASE WHEN old_table IS NOT NULL THEN new_table END,
      NULL, NULL, NULL, NULL, NULL
    FROM tables""",
    TABLE_CHANGES,
    _column_changes(False).replace(CATALOGS + ",", ""),
)
_sql(
    "poll_tables",
    """SELECT 'shop-customer-topic' AS topic, CAST(c_custkey AS VARCHAR) AS "key", 'UPDATE' AS operation,
      c_acctbal + 1 AS amount, 5 AS n_columns FROM customer WHERE c_nationkey = 1
    UNION ALL SELECT 'shop-supplier-topic', CAST(s_suppkey AS VARCHAR), 'DELETE', NULL, 1 FROM supplier WHERE s_nationkey = 2
    UNION ALL SELECT 'shop-part-topic', CAST(p_partkey AS VARCHAR), 'INITIAL_LOAD', p_retailprice, 6 FROM part
    UNION ALL SELECT 'missing', NULL, 'PATH_NOT_FOUND', NULL, NULL""",
)


def _fields(topic: str, operation: str, key: str, source: str, **columns: str) -> str:
    """A row for each column of each message; numbers and texts apart."""
    one = f"""SELECT 'shop-{topic}-topic' AS topic, CAST({key} AS VARCHAR) AS "key", '{operation}' AS operation, '{{name}}' AS "column",
      {{text}} AS text, {{number}} AS number FROM {source}"""
    return " UNION ALL ".join(
        one.format(name=name, text=value, number="CAST(NULL AS DOUBLE)") if "_name" in name or name in ("c_mktsegment", "p_brand", "p_type")
        else one.format(name=name, text="CAST(NULL AS VARCHAR)", number=f"CAST({value} AS DOUBLE)")
        for name, value in columns.items()
    )


_CUSTOMER = {"c_custkey": "c_custkey", "c_name": "c_name", "c_nationkey": "c_nationkey", "balance": "c_acctbal + 1", "c_mktsegment": "c_mktsegment"}
_PART = {name: name for name in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")}
_sql(
    "poll_stored",
    " UNION ALL ".join(
        [
            _fields("customer", "UPDATE", "c_custkey", "customer WHERE c_nationkey = 1", **_CUSTOMER),
            _fields("supplier", "DELETE", "s_suppkey", "supplier WHERE s_nationkey = 2", s_suppkey="s_suppkey"),
            _fields("part", "INITIAL_LOAD", "p_partkey", "part", **_PART),
            "SELECT 'missing', NULL, 'PATH_NOT_FOUND', NULL, NULL, NULL",
        ]
    ),
)
_sql("poll_to_state_keyless", "SELECT DISTINCT * FROM lineitem WHERE l_returnflag <> 'R'")
_sql(
    "poll_to_state_timestamp_key",
    """SELECT * REPLACE (CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value) FROM events
    WHERE event_type <> 'error' QUALIFY row_number() OVER (PARTITION BY ts ORDER BY event_id DESC) = 1""",
)
_sql(
    "poll_to_state_null_key",
    """SELECT *, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN ' ' WHEN '5-LOW' THEN NULL
      ELSE CAST(o_orderkey AS VARCHAR) END AS okey FROM cur""",
    SNAPSHOTS,
)
_sql("stream_key_rename", "SELECT * EXCLUDE (o_orderkey), o_orderkey AS number FROM cur", SNAPSHOTS)

# Change application

for _name, _feed in {
    "cdc_apply_state": "feed",
    "bronze_compact": "feed",
    "stream_keyed_state": "feed",
    "stream_state_tws": "feed",
    "stream_state_read": "feed",
    "initial_load_then_changes": "load_feed",
}.items():
    _sql(_name, "SELECT * FROM final", FEED, _state(_feed))
for _name in ("cdc_change_log", "stored_change_log"):
    _sql(_name, "SELECT * EXCLUDE (batch_id) FROM log", CHANGE_LOG)
_sql("cdc_batch_summary", "SELECT * FROM summary", SUMMARY)
_sql(
    "cdc_effective_counts",
    """SELECT table_key, batch_id,
      count(*) FILTER (before_deleted IS NULL AND after_deleted IS NOT NULL) AS new_rows,
      count(*) FILTER (operation = 'DELETE' AND before_deleted IS NOT NULL) AS effective_deletes
    FROM log GROUP BY ALL""",
    CHANGE_LOG,
)
for _name in ("commit_running_total", "commit_totals_of_log"):
    _sql(_name, "SELECT table_key, batch_id, new_rows, total_records FROM commits", SUMMARY)
_sql("commit_latest", "SELECT * FROM commits QUALIFY row_number() OVER (PARTITION BY table_key ORDER BY batch_id DESC) = 1", SUMMARY)

# Schema drift

_sql("ddl_add_table", 'SELECT new_table AS "table" FROM tables WHERE old_table IS NULL', TABLE_CHANGES)
_sql("ddl_drop_table", 'SELECT old_table AS "table" FROM tables WHERE new_table IS NULL', TABLE_CHANGES)
_sql(
    "ddl_rename_table",
    "SELECT old_table, new_table FROM tables WHERE old_table IS NOT NULL AND new_table IS NOT NULL",
    TABLE_CHANGES,
)
_sql(
    "ddl_add_column",
    'SELECT "table", new_column AS "column", data_type, "default" FROM columns WHERE old_column IS NULL',
    _column_changes(True),
)
_sql(
    "ddl_drop_column",
    'SELECT "table", old_column AS "column" FROM columns WHERE new_column IS NULL',
    _column_changes(True),
)
_RENAMED = """SELECT "table", old_column, new_column, data_type FROM columns
    WHERE old_column IS NOT NULL AND new_column IS NOT NULL"""
_sql("ddl_rename_column", _RENAMED, _column_changes(True))
_sql("ddl_rename_column_by_type", _RENAMED, _column_changes(False))
_sql(
    "schema_versions",
    """SELECT "table", CAST(sum(version) AS BIGINT) AS version FROM (
      SELECT coalesce(new_table, table_full) AS "table", version FROM
        (SELECT table_full, max(ordinal) % 3 AS version FROM old GROUP BY table_full)
        LEFT JOIN tables ON table_full = old_table
        WHERE old_table IS NULL OR new_table IS NOT NULL
      UNION ALL SELECT new_table, 1 FROM tables WHERE old_table IS NULL
      UNION ALL SELECT "table", 1 FROM columns)
    GROUP BY ALL""",
    TABLE_CHANGES,
    _column_changes(True).replace(CATALOGS + ",", ""),
)

# Schema events

_sql(
    "apply_add_table",
    """SELECT table_full AS table_key, "column", data_type FROM new JOIN tables ON table_full = new_table
    WHERE old_table IS NULL""",
    TABLE_CHANGES,
)
_sql(
    "added_table_columns",
    'SELECT new.* FROM new JOIN tables ON table_full = new_table WHERE old_table IS NULL',
    TABLE_CHANGES,
)
_sql(
    "apply_add_column",
    """SELECT *, 'web' AS channel, CAST(1 AS INT) AS parcels, CAST(NULL AS DATE) AS checked
    FROM orders""",
)
_sql("apply_rename_column", "SELECT * EXCLUDE (o_totalprice), o_totalprice AS amount FROM orders")
_sql(
    "apply_drop_column",
    "SELECT * EXCLUDE (o_orderpriority), o_orderpriority AS o_orderpriority_deleted FROM orders",
)
for _name, _new in {"apply_rename_table": "shop.sales", "apply_drop_table": "shop.orders_deleted"}.items():
    _sql(
        _name,
        f"""SELECT seq, CASE WHEN table_key = 'shop.orders' AND ts < TIMESTAMP '{RENAMED_ON}' THEN '{_new}'
          ELSE table_key END AS table_key, CAST(user_id AS VARCHAR) AS user_id, CAST(cents AS VARCHAR) AS cents,
          event_type, props FROM good""",
        ENVELOPES,
    )

# Silver

_sql("prune_soft_dropped", "SELECT stt, so_the, so_tien FROM source_a", SOURCES)
_sql("filter_soft_deleted", "SELECT stt, deleted FROM live_a", SOURCES)
_sql("conform_a", _conform(_SILVER_A, "live_a"), SOURCES)
_sql("conform_b", _conform(_SILVER_B, "live_b"), SOURCES)
_sql("silver_unified", f"{_conform(_SILVER_A, 'live_a')} UNION ALL {_conform(_SILVER_B, 'live_b')}", SOURCES)
_sql(
    "append_evolve",
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment,
      CAST(NULL AS DOUBLE) AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, s_acctbal FROM supplier""",
)

# Streams

_sql(
    "stream_envelope_parse",
    """SELECT seq, CASE WHEN NOT broken THEN op END AS operation,
      CASE WHEN broken THEN '' ELSE concat_ws('.', database, "table") END AS table_key, fault,
      CASE WHEN broken OR op = 'TRUNCATE' THEN 'other' WHEN op = 'INITIAL_LOAD' THEN 'initial_load'
        ELSE 'change' END AS route FROM parsed""",
    ENVELOPES,
)


def _record_state(source: str, columns: str) -> str:
    """Like `_state`, per record of many tables."""
    picked = ", ".join(
        f"(arg_max({{'v': {c}}}, seq) FILTER (op <> 'DELETE')).v AS {c}" for c in columns.split()
    )
    return f"""
    numbered AS (SELECT *, max(CASE WHEN op <> 'DELETE' THEN 1 ELSE 0 END) OVER (PARTITION BY record_id
        ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS present FROM {source}),
    flagged AS (SELECT *, CASE WHEN op = 'DELETE' THEN true WHEN op IN ('INSERT', 'INITIAL_LOAD') THEN false END
        AS flag FROM numbered WHERE present = 1),
    final AS (SELECT record_id, {picked}, arg_max(op, seq) AS _operation, max(seq) AS _seq,
        coalesce(arg_max(flag, seq) FILTER (flag IS NOT NULL), false) AS deleted FROM flagged GROUP BY record_id)
    """


_sql(
    "stream_cdc_apply",
    "SELECT * FROM final",
    ENVELOPES,
    "texts AS (SELECT * REPLACE (CAST(cents AS VARCHAR) AS cents) FROM good)",
    _record_state("texts", "cents event_type props"),
)
_sql(
    "stream_events_per_table",
    """SELECT table_key, count(*) AS total, count(*) FILTER (op IN ('INSERT', 'INITIAL_LOAD')) AS inserts,
      count(*) FILTER (op = 'UPDATE') AS updates, count(*) FILTER (op = 'DELETE') AS deletes
    FROM good GROUP BY table_key""",
    ENVELOPES,
)
_EVOLVING = f"""
valid AS (SELECT *, database || '.' || "table" AS table_key FROM parsed
  WHERE coalesce(tbl, '') <> '' AND db <> '' AND op <> 'TRUNCATE' AND NOT repeated),
evolving AS (SELECT seq * 2 + 1 AS seq, op, seq // {BATCH_ROWS} AS batch_id, table_key,
    CASE WHEN table_key = 'crm.leads' THEN 'crm_prospects_' || user_id
      ELSE database || '_' || "table" || '_' || user_id END AS record_id,
    CASE WHEN table_key <> 'shop.orders' THEN CAST(raw_cents AS VARCHAR) END AS cents,
    CASE WHEN table_key = 'shop.orders' THEN CAST(raw_cents AS VARCHAR) END AS amount,
    CASE WHEN table_key <> 'shop.visits' THEN kind END AS event_type,
    CASE WHEN table_key = 'shop.visits' AND ts < TIMESTAMP '{DROPPED_ON}' THEN kind END AS event_type_deleted,
    CASE WHEN table_key = 'crm.accounts' AND ts < TIMESTAMP '{DROPPED_ON}' THEN 'basic' END AS tier, ts
  FROM valid)
"""
_sql(
    "stream_ddl_apply",
    "SELECT * FROM final",
    ENVELOPES,
    _EVOLVING,
    _record_state("evolving", "cents amount event_type event_type_deleted tier"),
)
_sql(
    "commit_schema_changes",
    """SELECT table_key, batch_id, count(*) AS new_columns FROM (
      SELECT table_key, "column", min(batch_id) AS batch_id FROM named GROUP BY ALL) GROUP BY ALL""",
    ENVELOPES,
    f"""written AS (SELECT seq // {BATCH_ROWS} AS batch_id, op, ts >= TIMESTAMP '{RENAMED_ON}' AS late,
        ts >= TIMESTAMP '{DROPPED_ON}' AS last, database || '.' || "table" AS key FROM parsed
      WHERE coalesce(tbl, '') <> '' AND db <> '' AND op <> 'TRUNCATE'),
    keyed AS (SELECT *, CASE WHEN key = 'crm.leads' AND late THEN 'crm.prospects' ELSE key END AS table_key
      FROM written),
    named AS (SELECT table_key, batch_id, 'user_id' AS "column" FROM keyed
      UNION ALL SELECT table_key, batch_id, CASE WHEN key = 'shop.orders' AND late THEN 'amount' ELSE 'cents' END
        FROM keyed WHERE op <> 'DELETE'
      UNION ALL SELECT table_key, batch_id, 'event_type' FROM keyed
        WHERE op <> 'DELETE' AND NOT (key = 'shop.visits' AND last))""",
)
