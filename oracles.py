"""SQL that DuckDB runs on the same Parquet tables, one text per query.

Written apart from the library: each statement states the result in plain SQL
over the star schema.
"""

from __future__ import annotations

# Common table expressions over the star schema.
_PARTS = {
    # The status words.
    "sale": """sale AS (SELECT o_orderkey AS id, o_custkey AS id_user,
        nullif(o_orderkey % 26, 25) AS id_adress, o_orderdate AS buy_date,
        CASE o_orderstatus WHEN 'F' THEN 'sent' WHEN 'O' THEN 'not processed'
        WHEN 'P' THEN 'formation' END AS status FROM orders)""",
    "sale_detail": """sale_detail AS (SELECT l_orderkey * 1048576 + l_linenumber AS id,
        l_orderkey AS id_sale, min(l_partkey) AS id_flower,
        CAST(min(l_quantity) AS INTEGER) AS amount
        FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
    "sale_flower": """sale_flower AS (SELECT l_orderkey * 1048576 + l_linenumber AS id_sale_detail,
        l_suppkey AS id_flower_warehouse,
        CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS amount
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_suppkey)""",
    "flower": """flower AS (SELECT p_partkey AS id,
        CAST(nullif(p_size % 10, 0) AS BIGINT) AS id_parent, p_name AS name FROM part)""",
    "lot": """lot AS (SELECT s_suppkey AS id, abs(CAST(s_acctbal AS DECIMAL(19,2))) AS cost,
        nullif(s_suppkey % 10, 9) AS id_greenhouse, s_suppkey * 20 AS id_flower,
        s_suppkey % 5 <> 0 AS ready_to_sale, DATE '2001-01-01' AS date,
        CAST(s_suppkey % 50 AS INTEGER) AS amount, CAST(NULL AS VARCHAR) AS notes FROM supplier)""",
    "stock_lot": """stock_lot AS (SELECT l_partkey AS id_flower,
        sum(CAST(l_quantity AS INTEGER)) AS amount, l_suppkey % 5 <> 0 AS ready_to_sale
        FROM lineitem GROUP BY l_partkey, l_suppkey)""",
    "place": """place AS (
        SELECT 'r' || r_regionkey AS id, CAST(NULL AS VARCHAR) AS id_parent, r_name AS name FROM region
        UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, n_name FROM nation
        UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey, c_name FROM customer)""",
    "account": """account AS (SELECT c_custkey AS id,
        CASE WHEN c_custkey % 40 <> 3 THEN c_name END AS name,
        CASE WHEN c_custkey % 30 = 4 THEN repeat(c_mktsegment, 4) ELSE c_mktsegment END AS surname,
        CASE WHEN c_custkey % 70 = 6 THEN NULL WHEN c_custkey % 60 = 5 THEN 'shared@example.com'
        WHEN c_custkey % 50 = 7 THEN lower(c_name) ELSE lower(c_name) || '@example.com' END AS e_mail,
        CAST(c_nationkey AS VARCHAR) AS code, repeat(c_mktsegment, 4) AS city, c_name AS street
        FROM customer)""",
    "raw_line": """raw_line AS (SELECT l_orderkey * 1048576 + l_linenumber AS id, l_orderkey AS id_sale,
        CASE WHEN l_partkey % 97 = 0 THEN l_partkey + 1000000000 ELSE nullif(l_partkey, 13) END
        AS id_flower, CAST(l_quantity AS INTEGER) - 1 AS amount FROM lineitem)""",
    "raw_lot": """raw_lot AS (SELECT l_orderkey * 1048576 + l_linenumber AS id_sale_detail,
        l_suppkey AS id_flower_warehouse, CAST(l_quantity AS INTEGER) AS amount FROM lineitem)""",
}


def _with(names: str, *more: str, recursive: bool = False) -> str:
    parts = [_PARTS[name] for name in names.split()] + list(more)
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ", ".join(parts) + " "


_YEAR = """buy_date BETWEEN TIMESTAMP '2001-08-01' - INTERVAL 1 YEAR AND TIMESTAMP '2001-08-01'"""
_MONTH = """buy_date BETWEEN TIMESTAMP '2001-08-01' - INTERVAL 1 MONTH AND TIMESTAMP '2001-08-01'"""

_SOLD = f"""sold AS (SELECT f.id AS flower, CAST(sum(sd.amount) AS BIGINT) AS sum_amount
    FROM flower f, sale_detail sd, sale s, sale_flower sf
    WHERE sd.id_flower = f.id AND s.id = sd.id_sale AND sf.id_sale_detail = sd.id AND s.{_YEAR}
    GROUP BY f.id)"""
_SALES = "sale sale_detail sale_flower flower"

_REVENUE = f"""revenue AS (SELECT CAST(month(s.buy_date) AS INTEGER) AS month,
    CAST(sum(lot.cost * sd.amount) AS DECIMAL(38,2)) AS sum
    FROM sale s, sale_detail sd, sale_flower sf, lot
    WHERE sd.id_sale = s.id AND sf.id_sale_detail = sd.id AND lot.id = sf.id_flower_warehouse
    AND s.{_YEAR} GROUP BY 1)"""

_INFO = """SELECT s.id AS id_sale, s.status, c.c_name || ' ' || c.c_mktsegment AS client,
    CASE WHEN a.n_nationkey IS NULL THEN CAST(h.n_nationkey AS VARCHAR) ELSE 'N' END AS code,
    CASE WHEN a.n_nationkey IS NULL THEN h.n_name ELSE a.n_name END AS city,
    f.name AS product, sd.amount
    FROM sale s JOIN customer c ON c.c_custkey = s.id_user
    LEFT JOIN nation h ON h.n_nationkey = c.c_nationkey
    LEFT JOIN nation a ON a.n_nationkey = s.id_adress
    JOIN sale_detail sd ON sd.id_sale = s.id JOIN flower f ON f.id = sd.id_flower"""


def _cost(value: str) -> str:
    return f"""SELECT s.id AS id_sale, CAST(sum({value}) AS DECIMAL(38,2)) AS cost
    FROM sale s, sale_detail sd, sale_flower sf, lot WHERE sd.id_sale = s.id
    AND sf.id_sale_detail = sd.id AND lot.id = sf.id_flower_warehouse"""


_TREATED = """treated AS (SELECT user_id % 7 AS id_greenhouse, count(event_id) AS treatments
    FROM events WHERE event_type = 'error' AND CAST(ts AS DATE)
    BETWEEN DATE '2024-01-15' - INTERVAL 1 MONTH AND DATE '2024-01-15'
    AND user_id % 7 IN (SELECT nullif(s_suppkey % 10, 9) FROM supplier) GROUP BY 1)"""


def _paths(nodes: str) -> str:
    return f"""path AS (SELECT id, '' AS fullname FROM {nodes} WHERE id_parent IS NULL
    UNION SELECT n.id, p.fullname || ' ' || n.name FROM {nodes} n JOIN path p ON p.id = n.id_parent)"""


_STOCK = """stock AS (SELECT coalesce(r.id_flower, q.id_flower) AS id_flower,
    CAST(coalesce(r.ready, 0) AS BIGINT) AS ready, CAST(coalesce(q.sold, 0) AS BIGINT) AS sold,
    CAST(coalesce(r.ready, 0) - coalesce(q.sold, 0) AS BIGINT) AS available
    FROM (SELECT id_flower, sum(CASE WHEN ready_to_sale THEN amount ELSE 0 END) AS ready
          FROM stock_lot GROUP BY 1) r
    FULL JOIN (SELECT sd.id_flower, sum(sd.amount) AS sold FROM sale_detail sd
               JOIN sale s ON s.id = sd.id_sale {condition} GROUP BY 1) q
    ON q.id_flower = r.id_flower)"""
_STOCK_OLD = _STOCK.format(condition="WHERE s.buy_date < TIMESTAMP '1998-01-01'")
_NEW = """new_line AS (SELECT sd.* FROM sale_detail sd JOIN sale s ON s.id = sd.id_sale
    WHERE s.buy_date >= TIMESTAMP '1998-01-01')"""
_STOCK_TABLES = "sale sale_detail stock_lot"


def _admit(lines: str, stock: str) -> str:
    """Admission by recursion over the line numbers of each product."""
    return f"""numbered AS (SELECT l.*, row_number() OVER (PARTITION BY l.id_flower ORDER BY l.id) AS rn,
        coalesce(s.available, 0) AS available
        FROM {lines} l LEFT JOIN {stock} s ON s.id_flower = l.id_flower),
    step AS (SELECT id, id_sale, id_flower, amount, rn, amount <= available AS accepted,
        available - CASE WHEN amount <= available THEN amount ELSE 0 END AS rest
        FROM numbered WHERE rn = 1
        UNION ALL
        SELECT n.id, n.id_sale, n.id_flower, n.amount, n.rn, n.amount <= p.rest,
        p.rest - CASE WHEN n.amount <= p.rest THEN n.amount ELSE 0 END
        FROM numbered n JOIN step p ON p.id_flower = n.id_flower AND n.rn = p.rn + 1)
    SELECT id, id_sale, id_flower, amount, accepted FROM step"""


# Fixed value: the mail rule.
_MAIL = (
    r"^[a-zA-Z0-9.!#$%&''*+/=?^_`{|}~-]+@[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?"
    r"(?:\.[a-zA-Z0-9](?:[a-zA-Z0-9-]{0,61}[a-zA-Z0-9])?)*\z"
)


def _count(table: str, rule: str, source: str, condition: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule,"
        f" CAST(count(*) AS BIGINT) AS violations FROM {source} WHERE {condition}"
    )


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _nulls(table: str, source: str, *columns: str) -> list[str]:
    return [_count(table, f"not_null:{c}", source, f"{c} IS NULL") for c in columns]


def _checks(table: str, source: str, *conditions: str) -> list[str]:
    return [_count(table, f"check:{c}", source, f"NOT ({c})") for c in conditions]


def _surplus(table: str, rule: str, source: str, key: str) -> str:
    present = " AND ".join(f"{c} IS NOT NULL" for c in key.split(","))
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, CAST(coalesce(sum(n - 1), 0) AS BIGINT)"
        f" AS violations FROM (SELECT count(*) AS n FROM {source} WHERE {present} GROUP BY {key})"
    )


def _orphans(table: str, source: str, column: str, parent: str, keys: str) -> str:
    return _count(
        table,
        f"foreign_key:{column}->{parent}",
        source,
        f"{column} IS NOT NULL AND {column} NOT IN ({keys})",
    )


def _primary(table: str, source: str, key: str) -> list[str]:
    missing = " OR ".join(f"{c} IS NULL" for c in key.split(","))
    label = f"primary_key:{key}"
    return [_surplus(table, label, source, key), _count(table, f"{label}:null", source, missing)]


_FLAWED = "account flower sale raw_line raw_lot lot"
_ON_HOLD = "CASE status WHEN 'formation' THEN 'on hold' ELSE status END"

_NOT_NULL_USER = _nulls("user", "account", "id", "name", "surname", "e_mail")
_NOT_NULL_LINE = _nulls("sale_detail", "raw_line", "id", "id_sale", "id_flower", "amount")
_CHECKS = [
    *_checks("flower", "flower", "id_parent > 0"),
    *_checks("sale", "sale", "id_user > 0 AND id_adress > 0"),
    *_checks("sale_detail", "raw_line", "amount > 0", "id_sale > 0 AND id_flower > 0"),
    *_checks(
        "sale_flower", "raw_lot", "amount > 0", "id_sale_detail > 0 AND id_flower_warehouse > 0"
    ),
]
# The status words that are allowed.
_ENUM = _count(
    "sale",
    "enum:status",
    "sale",
    f"{_ON_HOLD} NOT IN ('not processed', 'formation', 'ready to send', 'sent')",
)
_LENGTH_USER = [
    _count("user", "length:name", "account", "length(name) > 20"),
    _count("user", "length:surname", "account", "length(surname) > 30"),
    _count("user", "length:adress.code", "account", "length(code) > 15"),
    _count("user", "length:adress.city", "account", "length(city) > 30"),
    _count("user", "length:adress.street", "account", "length(street) > 30"),
    _count("user", "length:adress.phone_number", "account", "false"),
]
_LENGTH_FLOWER = [_count("flower", "length:name", "flower", "length(name) > 20")]
_EMAIL = _count("user", "email:e_mail", "account", f"NOT regexp_matches(e_mail, '{_MAIL}')")
_KEYS = [
    *_primary("sale_detail", "raw_line", "id"),
    *_primary("sale_flower", "raw_lot", "id_sale_detail,id_flower_warehouse"),
]
_UNIQUE = [
    _surplus("user", "unique:e_mail", "account", "e_mail"),
    _surplus("flower", "unique:name", "flower", "name"),
]
_FOREIGN = [
    _orphans("flower", "flower", "id_parent", "flower", "SELECT id FROM flower"),
    _orphans("sale", "sale", "id_user", "user", "SELECT id FROM account"),
    _orphans("sale", "sale", "id_adress", "adress_sale", "SELECT n_nationkey FROM nation"),
    _orphans("sale_detail", "raw_line", "id_sale", "sale", "SELECT id FROM sale"),
    _orphans("sale_detail", "raw_line", "id_flower", "flower", "SELECT id FROM flower"),
]
_REPORT = [
    *_NOT_NULL_USER,
    *_LENGTH_USER,
    _EMAIL,
    *_primary("user", "account", "id"),
    _UNIQUE[0],
    *_nulls("adress_sale", "(SELECT n_nationkey AS id, n_name AS adress FROM nation)", "id", "adress"),
    _count("adress_sale", "length:adress.code", "nation", "false"),
    _count("adress_sale", "length:adress.city", "nation", "length(n_name) > 30"),
    _count("adress_sale", "length:adress.street", "nation", "false"),
    _count("adress_sale", "length:adress.phone_number", "nation", "false"),
    *_primary("adress_sale", "(SELECT n_nationkey AS id FROM nation)", "id"),
    *_nulls("flower", "flower", "id", "name"),
    *_LENGTH_FLOWER,
    *_primary("flower", "flower", "id"),
    _UNIQUE[1],
    *_nulls("sale", "sale", "id", "id_user", "buy_date", "status"),
    _ENUM,
    *_primary("sale", "sale", "id"),
    *_NOT_NULL_LINE,
    *_nulls("sale_flower", "raw_lot", "id_sale_detail", "id_flower_warehouse", "amount"),
    *_CHECKS,
    *_KEYS,
    *_FOREIGN,
    _orphans(
        "sale_flower",
        "raw_lot",
        "id_sale_detail",
        "sale_detail",
        "SELECT id FROM raw_line",
    ),
    _orphans(
        "sale_flower", "raw_lot", "id_flower_warehouse", "flower_warehouse", "SELECT id FROM lot"
    ),
    *_nulls(
        "flower_warehouse", "lot", "id", "id_flower", "ready_to_sale", "date", "amount", "cost"
    ),
    *_checks("flower_warehouse", "lot", "amount > 0", "cost > 0", "id_flower > 0"),
    *_primary("flower_warehouse", "lot", "id"),
    _orphans("flower_warehouse", "lot", "id_flower", "flower", "SELECT id FROM flower"),
    # Greenhouses are not among the tables of the report: not checked.
    "SELECT 'flower_warehouse', 'foreign_key:id_greenhouse->greenhouse', CAST(NULL AS BIGINT)",
]

# The other tables, each as a source in SQL and what is declared for it.
_LINE = "l_orderkey * 1048576 + l_linenumber"
_BOUGHT = "CASE o_orderstatus WHEN 'F' THEN 'received' WHEN 'O' THEN 'not processed' ELSE 'ordered' END"
_HOUSES = "SELECT DISTINCT nullif(s_suppkey % 10, 9) AS id FROM supplier WHERE s_suppkey % 10 <> 9"
_TODAY = "date <= {as_of}"
_OTHER = {
    "dead_flowers": f"""SELECT {_LINE} AS id, l_suppkey + CASE WHEN l_linenumber = 3 THEN 100000 ELSE 0 END
        AS id_flower_warehouse, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS INTEGER) - 2 AS count
        FROM lineitem""",
    "disease": "SELECT p_partkey AS id, p_type AS name FROM part",
    "disease_flower": f"""SELECT {_LINE} AS id, l_partkey AS id_flower, l_suppkey * 30 AS id_disease,
        l_shipdate AS date, CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag END AS foto FROM lineitem""",
    "pest": """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 30 = 8 THEN repeat(s_name, 2) ELSE s_name END AS name
        FROM supplier""",
    "pest_flower": f"""SELECT {_LINE} AS id, CASE WHEN l_linenumber = 5 THEN -l_partkey ELSE l_partkey END AS id_flower,
        l_suppkey * 2 AS id_pest, CAST(l_shipdate AS DATE) AS date FROM lineitem""",
    "greenhouse": f"SELECT id, id * 3 AS id_staff FROM ({_HOUSES})",
    "prevention": """SELECT event_id AS id, nullif(user_id % 20, 11) AS id_staff, ts AS date,
        user_id % 12 AS id_greenhouse FROM events""",
    "prevention_detail": """SELECT user_id * 3 AS id_preparation, event_id - event_id % 5 AS id_prevention
        FROM events""",
    "sheduled_prevention": """SELECT event_id - event_id % 2 AS id, nullif(user_id % 11, 10) AS id_greenhouse,
        CASE WHEN event_type <> 'view' THEN ts END AS date FROM events""",
    "preparation": """SELECT p_partkey AS id, p_size - 1 AS id_type,
        CASE WHEN p_size = 9 THEN repeat(p_name, 4) ELSE p_name END AS name FROM part""",
    "preparation_type": """SELECT n_nationkey AS id,
        CASE WHEN n_nationkey % 6 = 5 THEN 'other' ELSE n_name END AS name FROM nation""",
    "position_rate": """SELECT n_nationkey AS id, CASE WHEN n_nationkey % 9 = 4 THEN 'gardener' ELSE n_name END
        AS position, (n_nationkey - 2) * 10 AS rate FROM nation""",
    "staff": """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 50 = 7 THEN NULL
        WHEN s_suppkey % 45 = 6 THEN s_name || 'xyz' ELSE s_name END AS name,
        CASE WHEN s_suppkey % 40 = 3 THEN repeat(s_name, 2) ELSE s_name END AS surname,
        CASE WHEN s_suppkey % 3 = 0 THEN repeat(s_name, 2) END AS patronymie,
        s_nationkey + CASE WHEN s_suppkey % 20 = 9 THEN 900 ELSE 0 END AS id_position,
        s_acctbal AS salary, 0 AS allowance FROM supplier""",
    "purchase": f"""SELECT o_orderkey AS id, o_custkey % 120 AS id_staff, o_orderdate AS date,
        {_BOUGHT} AS status FROM orders""",
    "purchase_detail": """SELECT l_partkey AS id_flower, l_orderkey - l_orderkey % 4 AS id_purchase,
        CAST(l_quantity AS INTEGER) - 1 AS amount, CAST(l_extendedprice AS DECIMAL(19,2)) - 5000 AS cost
        FROM lineitem""",
    "stock": "SELECT p_partkey AS id, p_size - 1 AS id_type, p_name AS name, p_size - 3 AS amount FROM part",
    "stock_type": "SELECT n_nationkey * 2 AS id, repeat(n_name, 1 + n_nationkey % 5) AS name FROM nation",
    "stock_purchase": f"""SELECT o_orderkey AS id, nullif(o_custkey % 70, 5) AS id_staff, o_orderdate AS date,
        {_BOUGHT} AS status FROM orders""",
    "stock_purchase_detail": """SELECT l_partkey + CASE WHEN l_linenumber = 2 THEN 1000000 ELSE 0 END AS id_stock,
        l_orderkey - l_orderkey % 3 AS id_stock_purchase, nullif(CAST(l_quantity AS INTEGER) - 2, 5) AS amount,
        CASE WHEN l_linenumber > 1 THEN CAST(l_extendedprice AS DECIMAL(19,2)) - 9000 END AS cost FROM lineitem""",
}
_KEYS_OF = {
    "flower": "SELECT id FROM flower",
    "flower_warehouse": "SELECT id FROM lot",
    **{name: f"SELECT id FROM ({text})" for name, text in _OTHER.items() if " AS id," in text or text.startswith("SELECT id,")},
}


def _other(
    table: str,
    required: str,
    key: str,
    checks: tuple[str, ...] = (),
    widths: str = "",
    unique: str = "",
    references: str = "",
    allowed: str = "",
) -> list[str]:
    """Statements of all rules of one of the other tables."""
    source = f"({_OTHER[table]})"
    parts = _nulls(table, source, *required.split())
    for name, width in (w.split(":") for w in widths.split()):
        parts.append(_count(table, f"length:{name}", source, f"length({name}) > {width}"))
    if allowed:
        parts.append(_count(table, "enum:status", source, f"status NOT IN ({allowed})"))
    for text in checks:
        condition = text.replace("{as_of}", "DATE '2001-08-01'")
        parts.append(_count(table, f"check:{text}", source, f"NOT ({condition})"))
    parts += _primary(table, source, key)
    parts += [_surplus(table, f"unique:{c}", source, c) for c in unique.split()]
    for column, parent in (r.split(">") for r in references.split()):
        parts.append(_orphans(table, source, column, parent, _KEYS_OF[parent]))
    return parts


# Fixed value: the status words of purchases.
_PURCHASE_WORDS = "'not processed', 'formation', 'received'"
_EVERY_REPORT = [
    *_REPORT[:-1],
    _orphans("flower_warehouse", "lot", "id_greenhouse", "greenhouse", _HOUSES),
    *_other("dead_flowers", "id id_flower_warehouse date count", "id", ("count > 0", "id_flower_warehouse > 0"),
            references="id_flower_warehouse>flower_warehouse"),
    *_other("disease", "id name", "id", widths="name:30", unique="name"),
    *_other("disease_flower", "id id_flower id_disease date foto", "id", ("id_flower > 0 AND id_disease > 0",),
            references="id_flower>flower id_disease>disease"),
    *_other("pest", "id name", "id", widths="name:30", unique="name"),
    *_other("pest_flower", "id id_flower id_pest date", "id", (_TODAY, "id_flower > 0", "id_pest > 0"),
            references="id_flower>flower id_pest>pest"),
    *_other("greenhouse", "id id_staff", "id", ("id_staff > 0",), references="id_staff>staff"),
    *_other("prevention", "id id_staff date id_greenhouse", "id", ("id_greenhouse > 0", "id_staff > 0"),
            references="id_staff>staff id_greenhouse>greenhouse"),
    *_other("prevention_detail", "id_preparation id_prevention", "id_preparation,id_prevention",
            ("id_preparation > 0 AND id_prevention > 0",),
            references="id_preparation>preparation id_prevention>prevention"),
    *_other("sheduled_prevention", "id id_greenhouse date", "id", ("id_greenhouse > 0",),
            references="id_greenhouse>greenhouse"),
    *_other("preparation", "id id_type name", "id", ("id_type > 0",), "name:30", references="id_type>preparation_type"),
    *_other("preparation_type", "id name", "id", widths="name:30", unique="name"),
    *_other("position_rate", "id position rate", "id", ("rate > 0",), "position:30", "position"),
    *_other("staff", "id name surname id_position salary allowance", "id", ("id_position > 0",),
            "name:20 surname:30 patronymie:30", references="id_position>position_rate"),
    *_other("purchase", "id id_staff date status", "id", ("id_staff > 0",), references="id_staff>staff",
            allowed=_PURCHASE_WORDS),
    *_other("purchase_detail", "id_flower id_purchase amount cost", "id_flower,id_purchase",
            ("amount > 0", "id_flower > 0 AND id_purchase > 0", "cost > 0"),
            references="id_flower>flower id_purchase>purchase"),
    *_other("stock", "id id_type name amount", "id", ("amount > 0", "id_type > 0"), "name:30", "name", "id_type>stock_type"),
    *_other("stock_type", "id name", "id", widths="name:30", unique="name"),
    *_other("stock_purchase", "id id_staff date status", "id", ("id_staff > 0",), references="id_staff>staff",
            allowed=_PURCHASE_WORDS),
    *_other("stock_purchase_detail", "id_stock id_stock_purchase", "id_stock,id_stock_purchase",
            ("amount > 0", "id_stock > 0 AND id_stock_purchase > 0", "cost > 0"),
            references="id_stock>stock id_stock_purchase>stock_purchase"),
]

_SURFACE_ORDERS = "SELECT id FROM sale"


def _fingerprint(table: str, source: str, *columns: str) -> str:
    """Rows and an order-free hash over all columns of a table."""
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return (
        f"SELECT '{table}' AS table_name, count(*) AS row_count,"
        f" CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 8) AS BIGINT)) AS BIGINT)"
        f" AS fingerprint FROM {source}"
    )

_GONE = "gone AS (SELECT id FROM flower WHERE name LIKE 'red %')"
_GONE_LINES = "gone_line AS (SELECT * FROM sale_detail WHERE id_flower IN (SELECT id FROM gone))"
_MOVED = (
    "CASE WHEN {0} IN (SELECT id FROM flower WHERE name LIKE 'blue %')"
    " THEN {0} + 1000000000 ELSE {0} END"
)

_LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,"
    " l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
)


# The tables of a saved snapshot as they are, without flaws put in.
_CLEAN = (
    "client AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS surname,"
    " lower(c_name) || '@example.com' AS e_mail, h.n_name AS city FROM customer"
    " LEFT JOIN nation h ON h.n_nationkey = c_nationkey)",
    "office AS (SELECT n_nationkey AS id, n_name AS adress FROM nation)",
)


def _lengths(table: str, source: str, **widths: int) -> list[str]:
    return [_count(table, f"length:{c}", source, f"length({c}) > {w}") for c, w in widths.items()]


def _address_lengths(table: str, source: str, city: str) -> list[str]:
    wide = [(f"length:adress.{part}", "false") for part in ("code", "street", "phone_number")]
    return [_count(table, rule, source, text) for rule, text in (*wide, ("length:adress.city", f"length({city}) > 30"))]


_RESTORED = [
    *_nulls("user", "client", "id", "name", "surname", "e_mail"),
    *_lengths("user", "client", name=20, surname=30),
    *_address_lengths("user", "client", "city"),
    _count("user", "email:e_mail", "client", f"NOT regexp_matches(e_mail, '{_MAIL}')"),
    *_primary("user", "client", "id"),
    _surplus("user", "unique:e_mail", "client", "e_mail"),
    *_nulls("adress_sale", "office", "id", "adress"),
    *_address_lengths("adress_sale", "office", "adress"),
    *_primary("adress_sale", "office", "id"),
    *_nulls("flower", "flower", "id", "name"),
    *_lengths("flower", "flower", name=20),
    *_checks("flower", "flower", "id_parent > 0"),
    *_primary("flower", "flower", "id"),
    _surplus("flower", "unique:name", "flower", "name"),
    _orphans("flower", "flower", "id_parent", "flower", "SELECT id FROM flower"),
    *_nulls("flower_warehouse", "lot", "id", "id_flower", "ready_to_sale", "date", "amount", "cost"),
    *_checks("flower_warehouse", "lot", "amount > 0", "cost > 0", "id_flower > 0"),
    *_primary("flower_warehouse", "lot", "id"),
    _orphans("flower_warehouse", "lot", "id_flower", "flower", "SELECT id FROM flower"),
    "SELECT 'flower_warehouse', 'foreign_key:id_greenhouse->greenhouse', CAST(NULL AS BIGINT)",
    *_nulls("sale", "sale", "id", "id_user", "buy_date", "status"),
    _count("sale", "enum:status", "sale", "status NOT IN ('not processed', 'formation', 'ready to send', 'sent')"),
    *_checks("sale", "sale", "id_user > 0 AND id_adress > 0"),
    *_primary("sale", "sale", "id"),
    _orphans("sale", "sale", "id_user", "user", "SELECT id FROM client"),
    _orphans("sale", "sale", "id_adress", "adress_sale", "SELECT id FROM office"),
    *_nulls("sale_detail", "sale_detail", "id", "id_sale", "id_flower", "amount"),
    *_checks("sale_detail", "sale_detail", "amount > 0", "id_sale > 0 AND id_flower > 0"),
    *_primary("sale_detail", "sale_detail", "id"),
    _orphans("sale_detail", "sale_detail", "id_sale", "sale", "SELECT id FROM sale"),
    _orphans("sale_detail", "sale_detail", "id_flower", "flower", "SELECT id FROM flower"),
    *_nulls("sale_flower", "sale_flower", "id_sale_detail", "id_flower_warehouse", "amount"),
    *_checks("sale_flower", "sale_flower", "amount > 0", "id_sale_detail > 0 AND id_flower_warehouse > 0"),
    *_primary("sale_flower", "sale_flower", "id_sale_detail,id_flower_warehouse"),
    _orphans("sale_flower", "sale_flower", "id_sale_detail", "sale_detail", "SELECT id FROM sale_detail"),
    _orphans("sale_flower", "sale_flower", "id_flower_warehouse", "flower_warehouse", "SELECT id FROM lot"),
]


def statements() -> dict[str, str]:
    sales = _with(_SALES, _SOLD)
    chain = _with("sale sale_detail sale_flower lot")
    flawed = _with(_FLAWED)
    return {
        "product_sales_last_year": sales + "SELECT * FROM sold",
        "product_sales_calendar_year": _with(_SALES)
        + """SELECT sd.id_flower AS flower, CAST(sum(sd.amount) AS BIGINT) AS sum_amount
        FROM sale_detail sd JOIN sale s ON s.id = sd.id_sale
        WHERE year(s.buy_date) = 2000 AND sd.id_flower IN (SELECT id FROM flower)
        AND sd.id IN (SELECT id_sale_detail FROM sale_flower) GROUP BY 1""",
        "product_sales_ranked": sales
        + """SELECT flower, sum_amount, CAST(dense_rank() OVER (ORDER BY sum_amount) AS INTEGER)
        AS rank FROM sold""",
        "least_sold_products": sales
        + """SELECT f.name FROM flower f JOIN (SELECT flower, dense_rank() OVER
        (ORDER BY sum_amount) AS r FROM sold) t ON t.flower = f.id WHERE t.r = 1""",
        "best_selling_products": sales
        + """SELECT f.name FROM flower f JOIN (SELECT flower, dense_rank() OVER
        (ORDER BY sum_amount DESC) AS r FROM sold) t ON t.flower = f.id WHERE t.r = 1""",
        "unsold_products_last_month": _with("sale sale_detail flower")
        + f"""SELECT name FROM flower WHERE id_parent IS NOT NULL AND id NOT IN
        (SELECT sd.id_flower FROM sale s JOIN sale_detail sd ON sd.id_sale = s.id WHERE s.{_MONTH})""",
        "revenue_by_month": _with("sale sale_detail sale_flower lot", _REVENUE)
        + "SELECT * FROM revenue",
        "revenue_running_total": _with("sale sale_detail sale_flower lot", _REVENUE)
        + """SELECT month, CAST(sum(sum) OVER (ORDER BY month) AS DECIMAL(38,2)) AS sum
        FROM revenue""",
        "order_info": _with("sale sale_detail flower") + _INFO,
        "order_info_one": _with("sale sale_detail flower") + _INFO + " WHERE s.id = 77",
        "order_cost": chain + _cost("lot.cost * sf.amount") + " GROUP BY s.id",
        "order_cost_one": chain
        + f"SELECT CAST(77 AS INTEGER) AS id_sale, sum(cost)::DECIMAL(38,2) AS cost FROM ("
        f"{_cost('lot.cost * sf.amount')} AND s.id = 77 GROUP BY s.id)",
        "order_unit_cost_sum": chain + _cost("lot.cost") + " GROUP BY s.id",
        "treatment_counts": _with("lot", _TREATED) + "SELECT * FROM treated",
        "untreated_lots": _with("lot flower", _TREATED)
        + """SELECT lot.id AS lot_id, f.name FROM lot JOIN flower f ON f.id = lot.id_flower
        WHERE lot.id_greenhouse NOT IN (SELECT id_greenhouse FROM treated) ORDER BY 1""",
        "full_names": _with("place", _paths("place"), recursive=True)
        + "SELECT n.id, p.fullname FROM place n LEFT JOIN path p ON p.id = n.id",
        "full_names_rounds": _with("place", _paths("place"), recursive=True)
        + "SELECT n.id, p.fullname FROM place n LEFT JOIN path p ON p.id = n.id",
        "full_name_one": _with("place", _paths("place"), recursive=True)
        + "SELECT id, fullname FROM path WHERE id = 'c42'",
        "product_full_names": _with("flower", _paths("flower"), recursive=True)
        + "SELECT n.id, p.fullname FROM flower n LEFT JOIN path p ON p.id = n.id",
        "available_stock": _with(_STOCK_TABLES, _STOCK.format(condition="")) + "SELECT * FROM stock",
        "products_with_stock": _with("flower stock_lot")
        + """SELECT f.id, f.name, CAST(coalesce(sum(l.amount), 0) AS BIGINT) AS ready FROM flower f
        LEFT JOIN stock_lot l ON l.id_flower = f.id AND l.ready_to_sale GROUP BY f.id, f.name""",
        # Fixed value: the sentence of the refusal.
        "check_order_lines": _with(_STOCK_TABLES, _STOCK_OLD, _NEW)
        + """SELECT id, id_sale, id_flower, amount, available, amount <= available AS ok,
        CASE WHEN amount > available THEN 'Количество цветов в заказе (' || amount
        || ') превышает количество на складе (' || available || ')' END AS message
        FROM (SELECT n.*, CAST(coalesce(s.available, 0) - coalesce(sum(n.amount) OVER
        (PARTITION BY n.id_flower ORDER BY n.id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS BIGINT) AS available FROM new_line n LEFT JOIN stock s ON s.id_flower = n.id_flower)""",
        "admit_order_lines_sequential": _with(
            _STOCK_TABLES, _STOCK_OLD, _NEW, _admit("new_line", "stock"), recursive=True
        ),
        "stream_admission": _with(
            "sale_detail stock_lot",
            "ready AS (SELECT id_flower, sum(amount) AS available FROM stock_lot"
            " WHERE ready_to_sale GROUP BY 1)",
            _admit("sale_detail", "ready"),
            recursive=True,
        ),
        "increment_values": "SELECT p_partkey, p_size + 1 AS next_size FROM part",
        "decode_address": """SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code,
        c_mktsegment AS city, c_name || ', ' || c_custkey AS street,
        CAST(NULL AS VARCHAR) AS phone_number FROM customer""",
        "decode_money": "SELECT c_custkey, CAST(c_acctbal AS DECIMAL(19,2)) AS balance FROM customer",
        "decode_binary": "SELECT c_custkey, c_name AS decoded FROM customer",
        "dq_not_null": flawed + _union(*_NOT_NULL_USER, *_NOT_NULL_LINE),
        "dq_check": flawed + _union(*_CHECKS),
        "dq_email": flawed
        + f"""SELECT id, e_mail, 'email:e_mail' AS rule FROM account
        WHERE NOT regexp_matches(e_mail, '{_MAIL}')""",
        "dq_enum": flawed + _ENUM,
        "dq_length": flawed + _union(*_LENGTH_USER, *_LENGTH_FLOWER),
        "dq_primary_key": flawed + _union(*_KEYS),
        "dq_repeated_lines": flawed
        + "SELECT id, count(*) AS row_count FROM raw_line GROUP BY id HAVING count(*) > 1",
        "dq_unique": flawed + _union(*_UNIQUE),
        "dq_foreign_key": flawed + _union(*_FOREIGN),
        "dq_orphan_lines": flawed
        + """SELECT * FROM raw_line WHERE id_flower IS NOT NULL
        AND id_flower NOT IN (SELECT id FROM flower)""",
        "quality_report": flawed + _union(*_REPORT),
        "quality_report_every_table": flawed + _union(*_EVERY_REPORT),
        "cascade_delete": _with("flower sale_detail sale_flower lot", _GONE, _GONE_LINES)
        + """SELECT * FROM sale_flower WHERE id_sale_detail NOT IN (SELECT id FROM gone_line)
        AND id_flower_warehouse NOT IN (SELECT id FROM lot WHERE id_flower IN (SELECT id FROM gone))""",
        "cascade_deleted_lines": _with("flower sale_detail", _GONE, _GONE_LINES)
        + "SELECT * FROM gone_line",
        "cascade_blockers": _with("flower", _GONE)
        + """SELECT 'flower' AS table_name, 'id_parent' AS column_name, id_parent AS parent_key,
        count(*) AS row_count FROM flower WHERE id_parent IN (SELECT id FROM gone)
        AND id NOT IN (SELECT id FROM gone) GROUP BY id_parent""",
        "cascade_delete_lots": _with("sale_flower lot")
        + """SELECT * FROM sale_flower WHERE id_flower_warehouse NOT IN
        (SELECT id FROM lot WHERE id_greenhouse = 3)""",
        "cascade_update_blockers": _with("flower")
        + """SELECT 'flower' AS table_name, 'id:changed_twice' AS column_name, id AS parent_key,
        CAST(2 AS BIGINT) AS row_count FROM flower WHERE id % 50 = 0
        UNION ALL SELECT 'flower', 'id:taken', id, 2 FROM flower
        WHERE id % 10 = 1 AND id - 1 IN (SELECT id FROM flower)""",
        "cascade_update_keys": _with("sale_detail flower")
        + f"SELECT id, id_sale, {_MOVED.format('id_flower')} AS id_flower, amount FROM sale_detail",
        "cascade_update_self": _with("flower")
        + f"SELECT {_MOVED.format('id')} AS id, {_MOVED.format('id_parent')} AS id_parent, name"
        " FROM flower",
        "assign_ids": f"""SELECT {_LINE_COLUMNS},
        row_number() OVER (ORDER BY {_LINE_COLUMNS}) + 999 AS id FROM lineitem""",
        "fill_defaults": _with("sale")
        + """SELECT id, id_user, id_adress, TIMESTAMP '2001-08-01' AS buy_date,
        'not processed' AS status FROM sale""",
        "append_roundtrip": _with("sale")
        + """SELECT id, id_user, id_adress, buy_date, CASE WHEN buy_date < TIMESTAMP '1998-01-01'
        THEN status ELSE 'not processed' END AS status FROM sale""",
        "snapshot_roundtrip": _with("sale sale_detail sale_flower flower lot")
        + _union(
            _fingerprint(
                "user",
                "customer LEFT JOIN nation ON n_nationkey = c_nationkey",
                "c_custkey", "c_name", "c_mktsegment", "lower(c_name) || '@example.com'",
                "n_nationkey", "n_name", "NULL", "NULL",
            ),
            _fingerprint("adress_sale", "nation", "n_nationkey", "'N'", "n_name", "NULL", "NULL"),
            _fingerprint("flower", "flower", "id", "id_parent", "name"),
            _fingerprint(
                "flower_warehouse", "lot", "id", "id_flower", "ready_to_sale", "date", "amount",
                "cost", "notes", "id_greenhouse",
            ),
            _fingerprint("sale", "sale", "id", "id_user", "id_adress", "buy_date", "status"),
            _fingerprint("sale_detail", "sale_detail", "id", "id_sale", "id_flower", "amount"),
            _fingerprint(
                "sale_flower", "sale_flower", "id_sale_detail", "id_flower_warehouse", "amount"
            ),
        ),
        "restored_report": _with("flower sale sale_detail sale_flower lot", *_CLEAN)
        + _union(*_RESTORED),
        "numbered_append": _with("sale")
        + """SELECT id, id_user, id_adress, buy_date, status FROM sale UNION ALL
        SELECT (SELECT max(id) FROM sale) + row_number() OVER (ORDER BY id_user, id_adress NULLS FIRST,
        buy_date, status NULLS FIRST), id_user, id_adress, buy_date, status FROM sale
        WHERE buy_date >= TIMESTAMP '2001-01-01'""",
        "stock_from_totals": _with(_STOCK_TABLES, _STOCK.format(condition="")) + "SELECT * FROM stock",
        "stored_order_cost_one": chain
        + "SELECT CAST(77 AS INTEGER) AS id_sale, sum(cost)::DECIMAL(38,2) AS cost FROM ("
        f"{_cost('lot.cost * sf.amount')} AND s.id = 77 GROUP BY s.id)",
        "admit_order_lines_rounds": _with(
            _STOCK_TABLES, _STOCK_OLD, _NEW, _admit("new_line", "stock"), recursive=True
        ),
        "stream_admission_batches": _with(
            "sale_detail stock_lot",
            "ready AS (SELECT id_flower, sum(amount) AS available FROM stock_lot"
            " WHERE ready_to_sale GROUP BY 1)",
            _admit("sale_detail", "ready"),
            recursive=True,
        ),
        "accepted_order_lines": _with(_STOCK_TABLES, _STOCK_OLD, _NEW)
        + """SELECT id, id_sale, id_flower, amount FROM (SELECT n.*, coalesce(s.available, 0)
        - sum(n.amount) OVER (PARTITION BY n.id_flower ORDER BY n.id) AS rest
        FROM new_line n LEFT JOIN stock s ON s.id_flower = n.id_flower) WHERE rest >= 0""",
        "sql_increment": "SELECT p_partkey, p_size + 1 AS next_size FROM part",
        "sql_cost": chain
        + f"""SELECT s.id AS id_sale, t.cost FROM ({_SURFACE_ORDERS}) s
        LEFT JOIN ({_cost('lot.cost * sf.amount')} GROUP BY s.id) t ON t.id_sale = s.id""",
        "sql_sale_cost": chain
        + f"""SELECT s.id AS id_sale, t.cost FROM ({_SURFACE_ORDERS}) s
        LEFT JOIN ({_cost('lot.cost')} GROUP BY s.id) t ON t.id_sale = s.id""",
        "sql_full_name": _with("flower", _paths("flower"), recursive=True)
        + "SELECT n.id, p.fullname FROM flower n LEFT JOIN path p ON p.id = n.id",
        "sql_sale_info": _with("sale sale_detail flower")
        + f"SELECT id_sale, status, client, city, product, amount FROM ({_INFO})"
        f" WHERE id_sale IN ({_SURFACE_ORDERS})",
        "sql_running_revenue": _with("sale sale_detail sale_flower lot", _REVENUE)
        + """SELECT month, CAST(sum(sum) OVER (ORDER BY month) AS DECIMAL(38,2)) AS sum
        FROM revenue""",
        "materialised_sum": _with("sale_detail")
        + "SELECT CAST(sum(amount) AS BIGINT) AS sum FROM sale_detail",
    }
