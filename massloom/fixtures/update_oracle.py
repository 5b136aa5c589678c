"""The queries of ``update_queries`` as SQL for an independent engine."""

from __future__ import annotations

from massloom.fixtures.oracle import _sql

_TERMS = """stanzas AS (SELECT p_partkey AS n, p_name FROM part),
parents AS (SELECT DISTINCT n, unnest([CASE WHEN n > 0 THEN printf('MS:%07d', n // 2) END,
 CASE WHEN n > 0 AND n % 7 = 0 THEN printf('MS:%07d', n // 3) END, CASE WHEN n % 13 = 6 THEN 'UO:0000000' END,
 CASE WHEN n % 23 = 10 THEN 'MS:0000001' END]) AS parent FROM stanzas),
terms AS (SELECT printf('MS:%07d', n) AS accession, min(CASE WHEN n % 11 <> 5 THEN p_name END) AS term,
 bool_and(n % 17 = 8 AND n % 23 <> 10) AS obsolete, n FROM stanzas GROUP BY n),
is_a AS (SELECT printf('MS:%07d', n) AS accession, parent FROM parents WHERE parent IS NOT NULL)"""
_CLOSURE = f"""{_TERMS}, ways(accession, ancestor, distance) AS (SELECT accession, parent, 1 FROM is_a
 UNION SELECT w.accession, i.parent, w.distance + 1 FROM ways w JOIN is_a i ON i.accession = w.ancestor WHERE w.distance < 30),
closure AS (SELECT accession, ancestor, min(distance) AS distance FROM ways GROUP BY ALL)"""


def _value(text: str) -> str:
    return f"coalesce(length({text}) || ':' || {text}, 'n')"


_POWERS = "powers AS MATERIALIZED (SELECT e, pow(2::DOUBLE, e) AS p FROM range(-200, 200) t(e))"
_MANTISSA = 4503599627370496


def _split(table: str, doubles: list[str], rest: str) -> str:
    """Rows with exponents of their doubles found by counting the powers of two they reach."""
    exponents = ", ".join(f"len(list_filter(ps, lambda p: p <= abs({d}))) - 201 AS e_{d}" for d in doubles)
    return f"SELECT {rest}, {exponents} FROM {table}, (SELECT list(p ORDER BY e) AS ps FROM powers)"


def _double(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} = 0 THEN '0' ELSE CASE WHEN {x} < 0 THEN '-' ELSE '' END || e_{x} || ':' || "
        f"(abs({x}) / pow(2::DOUBLE, e_{x}) * {_MANTISSA})::BIGINT END"
    )


def _buckets(table: str, key: list[str], columns: dict[str, str]) -> str:
    """Bucket digests; ``columns`` maps names to kinds: d for doubles, else plain."""
    doubles = [c for c, kind in columns.items() if kind == "d"]
    row = " || ".join(_value(f"({_double(c)})" if kind == "d" else f"({c}::VARCHAR)") for c, kind in columns.items())
    named = " || ".join(_value(f"({c}::VARCHAR)") for c in key)
    return f"""SELECT bucket::INTEGER AS bucket, count(*) AS n_rows, sum(('0x' || substr(r, 1, 15))::HUGEINT) || ':' || sum(('0x' || substr(r, 16, 15))::HUGEINT) AS digest
 FROM (SELECT md5({row}) AS r, ('0x' || substr(md5({named}), 1, 7))::BIGINT % 1024 AS bucket FROM ({_split(table, doubles, "*")})) GROUP BY bucket"""


_ORDERS = {"o_orderkey": "p", "o_custkey": "p", "o_orderstatus": "p", "o_totalprice": "d", "o_orderdate": "p", "o_orderpriority": "p"}
_LINES = {
    "l_orderkey": "p", "l_partkey": "p", "l_suppkey": "p", "l_linenumber": "p", "l_quantity": "d", "l_extendedprice": "d",
    "l_discount": "d", "l_tax": "d", "l_returnflag": "p", "l_linestatus": "p", "l_shipdate": "p",
}
_EVENTS = {"event_id": "p", "ts": "p", "user_id": "p", "event_type": "p", "value": "d", "props": "p"}
_PRICED = {"o_orderkey": "p", "o_orderpriority": "p", "price": "d", "flag": "p"}
_ALTERED = """altered AS (SELECT t.* FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 97 = 3 THEN o_totalprice * (1 + pow(2::DOUBLE, -50)) ELSE o_totalprice END AS o_totalprice)
 FROM orders WHERE o_orderkey % 101 <> 7) t, range(1, 3) c(k) WHERE k = 1 OR o_orderkey % 103 = 5
 UNION ALL SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey) FROM orders WHERE o_orderkey % 107 = 9)"""


def _tables() -> str:
    parts = [
        f"SELECT '{name}' AS dataset_id, sum(n_rows)::BIGINT AS n_rows, count(*) AS n_buckets, "
        f"md5(string_agg(bucket || ' ' || n_rows || ' ' || digest, chr(10) ORDER BY bucket)) AS digest FROM ({_buckets(name, key, columns)})"
        for name, key, columns in (
            ("orders", ["o_orderkey"], _ORDERS), ("lineitem", ["l_orderkey", "l_linenumber"], _LINES), ("events", ["event_id"], _EVENTS)
        )
    ]
    return f"WITH {_POWERS} " + " UNION ALL ".join(parts)


def _profile() -> str:
    names = list(_LINES)
    numbers = names[:8]
    return " UNION ALL ".join(
        f"SELECT 'lineitem' AS dataset_id, '{c}' AS column_name, {at} AS ordinal_position, count(*) AS n_rows, count(*) - count({c}) AS null_count, "
        f"true AS distinct_fits, {f'min({c})::DOUBLE + 0' if c in numbers else 'NULL::DOUBLE'} AS low, {f'max({c})::DOUBLE + 0' if c in numbers else 'NULL::DOUBLE'} AS high, "
        f"{'true' if c in numbers else 'NULL::BOOLEAN'} AS quantiles_fit FROM lineitem"
        for at, c in enumerate(names, 1)
    )


UPDATE_ORACLE: dict[str, str] = {
    "cv_terms": f"""WITH {_TERMS} SELECT t.accession, term, coalesce(p.is_a, '') AS is_a, obsolete FROM terms t
 LEFT JOIN (SELECT accession, string_agg(parent, ',' ORDER BY parent) AS is_a FROM is_a GROUP BY 1) p USING (accession)""",
    "cv_ancestors": f"WITH RECURSIVE {_CLOSURE} SELECT * FROM closure",
    "header_eav_vocabulary": _sql(["v_headers"], "") + f""", {_TERMS}
SELECT basename, accession, name, value, "group" FROM (SELECT *, row_number() OVER (PARTITION BY basename, accession
 ORDER BY "group", seq) AS rn FROM (SELECT basename, seq, "group",
 CASE kind WHEN 'cv' THEN h.accession ELSE 'user:' || "group" || ':' || coalesce(name, 'user_param') END AS accession,
 CASE kind WHEN 'cv' THEN coalesce(name, term, h.accession) ELSE coalesce(name, 'user_param') END AS name,
 CASE kind WHEN 'cv' THEN coalesce(value, name) ELSE value END AS value
 FROM v_headers h LEFT JOIN terms t ON h.accession = t.accession WHERE kind <> 'cv' OR h.accession IS NOT NULL)) WHERE rn = 1""",
    "params_under": f"""WITH RECURSIVE {_CLOSURE}, headers AS (SELECT p_brand AS basename, CASE WHEN p_partkey % 29 <> 1 THEN printf('MS:%07d', p_size) END AS accession FROM part)
SELECT basename, count(*) AS n FROM headers WHERE accession = 'MS:0000003'
 OR accession IN (SELECT accession FROM closure WHERE ancestor = 'MS:0000003') GROUP BY 1""",
    "dir_rollup_delta": _sql(["v_items"], "SELECT * FROM v_items"),
    "table_digests": _tables(),
    "bucket_digests": f"""WITH {_POWERS}, priced AS (SELECT o_orderkey, o_orderpriority, CASE o_orderkey % 5 WHEN 0 THEN o_totalprice / (o_orderkey + 1) / 1e9
 WHEN 1 THEN -o_totalprice / 3 WHEN 2 THEN 0 END AS price, o_orderkey % 3 = 0 AS flag FROM orders) {_buckets("priced", ["o_orderkey"], _PRICED)}""",
    "manifest_diff": f"""WITH {_ALTERED}, o AS (SELECT o_orderkey, list(t ORDER BY t::VARCHAR) AS rows FROM orders t GROUP BY 1),
 a AS (SELECT o_orderkey, list(t ORDER BY t::VARCHAR) AS rows FROM altered t GROUP BY 1)
SELECT o_orderkey, CASE WHEN o.rows IS NULL THEN 'added' WHEN a.rows IS NULL THEN 'removed' ELSE 'changed' END AS change
 FROM o FULL JOIN a USING (o_orderkey) WHERE o.rows IS DISTINCT FROM a.rows""",
    "manifest_diff_buckets": f"""WITH {_POWERS}, {_ALTERED}, o AS ({_buckets("orders", ["o_orderkey"], _ORDERS)}), a AS ({_buckets("altered", ["o_orderkey"], _ORDERS)})
SELECT bucket, coalesce(o.n_rows, 0) AS rows_before, coalesce(a.n_rows, 0) AS rows_after FROM o FULL JOIN a USING (bucket)
 WHERE o.digest IS DISTINCT FROM a.digest OR o.n_rows IS DISTINCT FROM a.n_rows""",
    "profile_merged": _profile(),
}
