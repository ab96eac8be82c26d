"""The same results in plain SQL, written independently of the operators, for cross-checking."""

from __future__ import annotations

from caseline.functions.text import CAPITALS

_CASE_ORDERS = """
  SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS order_day,
         CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) END AS completion_day,
         NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS decision
  FROM orders"""


def _ends(nulls: str, having: str = "") -> str:
    order = ", ".join(f"{c} ASC NULLS {nulls}" for c in ("completion_day", "decision", "o_orderkey"))
    return f"""
WITH o AS ({_CASE_ORDERS}),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {order}) AS i,
             count(*) OVER (PARTITION BY o_custkey) AS n FROM o)
SELECT o_custkey,
       max(CASE WHEN i = 1 THEN order_day END) AS first_day,
       max(CASE WHEN i = 1 THEN decision END) AS first_decision,
       max(CASE WHEN i = n THEN completion_day END) AS last_completion,
       max(CASE WHEN i = n THEN decision END) AS last_decision,
       max(CASE WHEN i = n THEN o_totalprice END) AS last_price,
       max(CASE WHEN i = n THEN o_orderstatus END) AS last_status
FROM r GROUP BY o_custkey {having}"""


_ORACLES: dict[str, str] = {}

_ORACLES["collapse_first_last"] = _ends("LAST")
_ORACLES["collapse_na_first"] = _ends("FIRST")
_ORACLES["collapse_constant_type"] = _ends(
    "LAST", "HAVING count(DISTINCT decision) + max(CASE WHEN decision IS NULL THEN 1 ELSE 0 END) = 1"
)

_ORACLES["collapse_first_second_last"] = """
WITH e AS (SELECT user_id, event_id, ts, value, NULLIF(event_type, 'view') AS kind FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY kind ASC NULLS LAST, ts, event_id) AS i,
             count(*) OVER (PARTITION BY user_id) AS n FROM e)
SELECT user_id,
       max(CASE WHEN i = 1 THEN event_id END) AS event_id_first,
       max(CASE WHEN i = 1 THEN kind END) AS kind_first,
       max(CASE WHEN i = 1 THEN value END) AS value_first,
       max(CASE WHEN i = 2 THEN event_id END) AS event_id_second,
       max(CASE WHEN i = 2 THEN kind END) AS kind_second,
       max(CASE WHEN i = 2 THEN value END) AS value_second,
       max(CASE WHEN i = n THEN event_id END) AS event_id_last,
       max(CASE WHEN i = n THEN kind END) AS kind_last,
       max(CASE WHEN i = n THEN value END) AS value_last
FROM r GROUP BY user_id"""

_ORACLES["first_n_wide"] = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events)
SELECT user_id,
       max(CASE WHEN i = 1 THEN event_type END) AS kind_1, max(CASE WHEN i = 2 THEN event_type END) AS kind_2,
       max(CASE WHEN i = 3 THEN event_type END) AS kind_3, max(CASE WHEN i = 4 THEN event_type END) AS kind_4,
       max(CASE WHEN i = 1 THEN value END) AS value_1, max(CASE WHEN i = 2 THEN value END) AS value_2,
       max(CASE WHEN i = 3 THEN value END) AS value_3, max(CASE WHEN i = 4 THEN value END) AS value_4
FROM r GROUP BY user_id"""

_ORACLES["conditional_last"] = """
WITH r AS (
  SELECT o_custkey, o_orderpriority, NULLIF(o_orderstatus, 'P') AS decision,
         row_number() OVER (
           PARTITION BY o_custkey, o_orderpriority
           ORDER BY CAST(o_orderdate AS DATE) DESC,
                    CASE o_orderstatus WHEN 'F' THEN 3 WHEN 'O' THEN 2 WHEN 'P' THEN 1 ELSE 0 END DESC,
                    o_orderdate DESC, o_orderkey DESC) AS back
  FROM orders)
SELECT o_custkey,
       max(CASE WHEN back = 1 AND o_orderpriority = '1-URGENT' THEN decision END) AS urgent_last,
       max(CASE WHEN back = 1 AND o_orderpriority = '2-HIGH' THEN decision END) AS high_last,
       max(CASE WHEN back = 1 AND o_orderpriority = '3-MEDIUM' THEN decision END) AS medium_last,
       max(CASE WHEN back = 1 AND o_orderpriority = '5-LOW' THEN decision END) AS low_last
FROM r GROUP BY o_custkey"""

_ORACLES["group_invariant_filter"] = """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, NULLIF(l_returnflag, 'N') AS flag FROM lineitem)
SELECT * FROM l WHERE l_orderkey IN (
  SELECT l_orderkey FROM l GROUP BY l_orderkey HAVING count(DISTINCT coalesce(flag, '<none>')) = 1)"""

_ORACLES["distinct_keep_first"] = """
SELECT l_orderkey, l_returnflag, l_linenumber, l_partkey, l_suppkey, ship_day, l_extendedprice FROM (
  SELECT *, CAST(l_shipdate AS DATE) AS ship_day,
         row_number() OVER (PARTITION BY l_orderkey, l_returnflag
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS i
  FROM lineitem) AS r WHERE i = 1"""

_ORACLES["top1_by_weight"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice AS price FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS i
  FROM lineitem) AS r WHERE i = 1"""

_ORACLES["decode_many"] = """
SELECT l_orderkey, l_linenumber, l_extendedprice, c_nationkey, s_nationkey,
       a.n_name || ' (' || a.n_nationkey || ')' AS customer_nation,
       b.n_name || ' (' || b.n_nationkey || ')' AS supplier_nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
     JOIN supplier ON l_suppkey = s_suppkey
     LEFT JOIN nation a ON c_nationkey = a.n_nationkey LEFT JOIN nation b ON s_nationkey = b.n_nationkey"""

_ORACLES["decode_guarded"] = """
SELECT c_custkey, c_nationkey, n_name AS nation, n_regionkey AS region_key, r_name AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""

_ORACLES["unique_lookup_only"] = """
WITH p AS (SELECT p_partkey, p_brand || '|' || p_name AS code, p_type FROM part)
SELECT p_partkey, code, CASE WHEN count(*) OVER (PARTITION BY code) = 1 THEN p_type END AS part_type FROM p"""

_ORACLES["nullsafe_decode"] = """
WITH p AS (SELECT p_partkey, p_brand, NULLIF(p_type, 'SMALL') AS kind, p_retailprice FROM part),
k AS (SELECT p_brand, kind, max(p_retailprice) AS top_price, count(*) AS parts FROM p GROUP BY p_brand, kind)
SELECT p.p_partkey, p.p_brand, p.kind, k.top_price, k.parts
FROM p LEFT JOIN k ON p.p_brand IS NOT DISTINCT FROM k.p_brand AND p.kind IS NOT DISTINCT FROM k.kind"""

_ORACLES["inner_join_drop_report"] = """
WITH c AS (
  SELECT count(*) AS n_before,
         count(CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 1 END) AS n_after
  FROM customer)
SELECT n_before, n_after, n_before - n_after AS n_dropped,
       CAST(n_before - n_after AS DOUBLE) / n_before AS fraction_dropped,
       CASE WHEN CAST(n_before - n_after AS DOUBLE) / n_before > 0.01 THEN 'warn' ELSE 'pass' END AS level
FROM c"""

_ORACLES["bycase_assembly"] = f"""
WITH o AS ({_ends("LAST")}),
e AS (SELECT user_id, max(CASE WHEN i = 1 THEN event_type END) AS event_1,
             max(CASE WHEN i = 2 THEN event_type END) AS event_2
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events) AS r
      GROUP BY user_id)
SELECT c_custkey AS idncase, first_day, last_completion, event_1, event_2, c_name, c_nationkey, c_acctbal,
       c_mktsegment, last_status
FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN e ON c_custkey = user_id"""

_ORACLES["row_count_match"] = """
SELECT (SELECT count(*) FROM customer) AS expected, count(*) AS actual,
       (SELECT count(*) FROM customer) = count(*) AS matches
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

_ORACLES["cohort_filter"] = """
SELECT o_orderkey, o_custkey, o_orderstatus AS kind, CAST(o_orderdate AS DATE) AS start
FROM orders WHERE o_orderdate >= DATE '1997-10-01' AND o_orderstatus IN ('F', 'P')"""


def _title(x: str) -> str:
    tokens = rf"regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}][\p{{L}}\p{{M}}\p{{N}}_]*|[^\p{{L}}\p{{N}}]+')"
    return f"list_aggregate(list_transform({tokens}, lambda t: upper(t[1]) || t[2:]), 'string_agg', '')"


_ORACLES["map_columns"] = f"""
SELECT o_orderkey AS orderkey, o_orderstatus AS status_code, {_title("o_orderpriority")} AS priority,
       CAST(o_orderdate AS DATE) AS placed FROM orders"""

_ORACLES["clean_text"] = r"""
WITH t AS (SELECT 'document' AS origin, doc_id AS id, CAST(0 AS BIGINT) AS turn, text FROM documents
           UNION ALL SELECT 'conversation', conv_id, CAST(turn AS BIGINT), text FROM conversations)
SELECT origin, id, turn,
       NULLIF(trim(regexp_replace(regexp_replace(text, '\p{Cc}', '', 'g'), '[\t\n\f\r\p{Z}]+', ' ', 'g')), '') AS text
FROM t"""

_ORACLES["zip_normalise"] = r"""
WITH z AS (SELECT c_custkey, NULLIF(regexp_extract(c_custkey || '-' || c_nationkey, '^\d{3,5}'), '') AS digits FROM customer)
SELECT c_custkey, lpad(digits, 5, '0') AS zip FROM z"""

_ORACLES["year_extract"] = """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year FROM orders"""

#: The citation is put together from the same pieces of the part as its code, not read out of the code.
_ORACLES["charge_citation"] = r"""
WITH p AS (
  SELECT p_partkey, p_size, substr(p_name, 1, 1) AS initial, substr(p_type, 1, 1) AS head, substr(p_type, 2, 2) AS more,
         CASE WHEN p_size > 30 THEN '212' WHEN p_size > 20 THEN '237' WHEN p_size > 10 THEN '2153' ELSE '' END AS section,
         CASE WHEN p_type = 'SMALL' THEN 'A' ELSE 'a' END AS letter
  FROM part)
SELECT p_partkey,
       section || CASE WHEN section = '2153' THEN initial WHEN p_size > 45 THEN 'a03F'
            ELSE concat(letter, lpad(CAST(p_size AS VARCHAR), 2, '0'), head, '-', lower(more), upper(initial)) END AS charge,
       CASE WHEN section = '' THEN NULL
            WHEN p_size > 45 THEN '212(a)(3)(F)'
            WHEN section = '2153' AND initial IN ('g', 'h') THEN concat('215(', initial, ')')
            WHEN section = '2153' THEN concat('2153(', initial, ')')
            ELSE concat(section, '(a)(', p_size, ')(', head, ')(', lower(more), ')(', upper(initial), ')') END AS citation
FROM p"""

_ORACLES["recode_default"] = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' ELSE o_orderstatus END AS status
FROM orders"""

_ORACLES["recode_strict"] = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' END AS status,
       CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' ELSE 'No application' END AS filled
FROM orders"""

_ORACLES["conditional_null"] = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'O' THEN o_totalprice
            WHEN o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0.0::DOUBLE END AS amount
FROM orders"""

_ORACLES["later_date"] = """
WITH s AS (SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS shipped FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey),
o AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS placed FROM orders)
SELECT o_orderkey, CASE WHEN shipped > placed THEN shipped ELSE placed END AS last_day
FROM o LEFT JOIN s ON o_orderkey = l_orderkey"""

_ORACLES["flag_from_code"] = """
SELECT o_orderkey, o_orderpriority = '1-URGENT' AS urgent, o_orderstatus <> 'O' AS completed FROM orders"""

_ORACLES["duration_days"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS DOUBLE) AS days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_LABELS = """
  SELECT o_orderkey, o_orderpriority || CASE o_orderstatus WHEN 'F' THEN ' (NO BOND SET BY DHS)'
         WHEN 'O' THEN '/GRANT WCAT v/d' ELSE ' CATALOG 2ND_TRY' END AS raw
  FROM orders"""


def _caps(x: str) -> str:
    for a in CAPITALS:
        pattern = a if "/" in a else rf"\b{a}\b"
        x = f"regexp_replace({x}, '{pattern}', '{a}', 'gi')"
    return x


_ORACLES["title_case"] = f"WITH l AS ({_LABELS}) SELECT o_orderkey, {_title('raw')} AS label FROM l"
_ORACLES["abbr_caps"] = f"""
WITH l AS ({_LABELS}), t AS (SELECT o_orderkey, {_title('raw')} AS titled FROM l)
SELECT o_orderkey, {_caps('titled')} AS label FROM t"""
_ORACLES["prefix_title"] = rf"""
WITH l AS ({_LABELS}), h AS (SELECT *, regexp_extract(raw, '^[^(]*') AS head FROM l)
SELECT o_orderkey, {_title('head')} || substr(raw, length(head) + 1) AS label FROM h"""

_ORACLES["string_template"] = """
SELECT s_suppkey, s_name || ' (' || s_nationkey || ')' AS label, substr(s_name, 1, 2) AS prefix FROM supplier"""

_TEXT_EVENTS = r"""
  SELECT event_id,
         CASE WHEN event_type = 'error' THEN props ELSE NULLIF(regexp_extract(props, '\d+'), '') END AS number,
         CASE WHEN event_type <> 'error' THEN CAST(value AS VARCHAR) END AS amount,
         CASE WHEN event_type = 'click' THEN strftime(ts, '%Y-%m-%d') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '.000' END AS moment,
         CASE WHEN event_type = 'click' THEN substr(strftime(ts, '%Y-%m-%d'), 3) ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS day,
         ts, value, event_type
  FROM events"""

_ORACLES["typed_convert"] = f"""
WITH e AS ({_TEXT_EVENTS})
SELECT event_id, TRY_CAST(number AS INTEGER) AS number, TRY_CAST(amount AS DOUBLE) AS amount,
       CASE WHEN length(moment) > 10 THEN substr(moment, 1, 19) END AS moment,
       CASE WHEN event_type <> 'click' THEN CAST(ts AS DATE) END AS day
FROM e"""

_ORACLES["typed_convert_report"] = f"""
WITH e AS ({_TEXT_EVENTS}),
bad AS (SELECT 'number' AS variable, number AS value FROM e WHERE event_type = 'error'
        UNION ALL SELECT 'moment', moment FROM e WHERE event_type = 'click'
        UNION ALL SELECT 'day', day FROM e WHERE event_type = 'click'),
n AS (SELECT variable, count(*) AS failed FROM bad GROUP BY variable),
x AS (SELECT variable, string_agg(value, ', ' ORDER BY value) AS examples FROM (
        SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY value) AS i
        FROM (SELECT DISTINCT variable, value FROM bad) AS d) AS r WHERE i <= 5 GROUP BY variable),
v AS (SELECT unnest(['number', 'amount', 'moment', 'day']) AS variable)
SELECT v.variable, coalesce(failed, 0) AS failed, (SELECT count(*) FROM events) AS total,
       CAST(coalesce(failed, 0) AS DOUBLE) / (SELECT count(*) FROM events) AS rate,
       CAST(coalesce(failed, 0) AS DOUBLE) / (SELECT count(*) FROM events) > 0.001 AS exceeds, examples
FROM v LEFT JOIN n ON v.variable = n.variable LEFT JOIN x ON v.variable = x.variable"""


def _rules(source: str, lines: list[tuple[str, str, str, float | None, float | None]]) -> str:
    """Report of (rule, failing condition, scope, warn, stop) lines over a source."""
    parts = []
    for name, fails, scope, warn, stop in lines:
        if warn is None:
            level = "CASE WHEN failed > 0 THEN 'stop' ELSE 'pass' END"
        else:
            level = f"CASE WHEN fraction >= {stop} THEN 'stop' WHEN fraction >= {warn} THEN 'warn' ELSE 'pass' END"
        parts.append(
            f"SELECT rule, failed, total, fraction, {level} AS level FROM (SELECT *, coalesce(CAST(failed AS DOUBLE) / NULLIF(total, 0), 0) AS fraction"
            f" FROM (SELECT '{name}' AS rule, count(CASE WHEN {scope} AND ({fails}) THEN 1 END) AS failed,"
            f" count(CASE WHEN {scope} THEN 1 END) AS total FROM src) AS c) AS f"
        )
    return f"WITH src AS ({source})\n" + "\nUNION ALL ".join(parts)


_ORACLES["rules_report"] = _rules(
    """SELECT *, NULLIF(l_returnflag, 'N') AS flag,
              l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) AS solvent FROM lineitem""",
    [
        ("not_null(flag)", "flag IS NULL", "TRUE", 0.25, 0.5),
        ("matches(flag)", "NOT regexp_matches(flag, '^[A-Z]$')", "TRUE", None, None),
        ("matches(l_linestatus)", "l_linestatus <> 'F'", "TRUE", 0.0001, 0.001),
        ("in_set(flag)", "flag <> 'A'", "TRUE", 0.5, 0.9),
        ("in_set(l_linestatus)", "l_linestatus NOT IN ('O', 'F') OR l_linestatus IS NULL", "TRUE", None, None),
        ("not_in_set(l_returnflag)", "l_returnflag = 'R'", "TRUE", 0.9, 0.95),
        ("at_least(l_discount)", "l_discount < 0.02", "TRUE", 0.1, 0.5),
        ("above(l_tax)", "l_tax <= 0", "TRUE", 0.1, 0.9),
        ("between(l_quantity)", "l_quantity < 1 OR l_quantity > 50", "TRUE", None, None),
        ("holds(discount below tax)", "l_discount > l_tax", "TRUE", 0.2, 0.9),
        ("holds(l_linenumber <= l_partkey)", "l_linenumber > l_partkey", "TRUE", 0.01, 0.1),
        ("valid_text(l_returnflag)", "FALSE", "TRUE", None, None),
        ("in_lookup(l_suppkey)", "NOT solvent", "TRUE", 0.0001, 0.9),
    ],
)

_ORACLES["rules_conditional"] = (
    _rules(
        _CASE_ORDERS,
        [
            ("not_null(label)", "o_orderstatus NOT IN ('F', 'O')", "decision IS NOT NULL", 0.01, 0.05),
            ("not_null(completion_day)", "completion_day IS NULL", "o_orderstatus = 'F'", 0.01, 0.05),
            ("above(o_totalprice)", "o_totalprice <= 1000", "o_orderstatus <> 'F'", 0.0001, 0.001),
        ],
    )
    + """
UNION ALL SELECT 'aggregate(3 to 5 statuses)', CASE WHEN count(DISTINCT o_orderstatus) BETWEEN 3 AND 5 THEN 0 ELSE 1 END, 1,
  CASE WHEN count(DISTINCT o_orderstatus) BETWEEN 3 AND 5 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END,
  CASE WHEN count(DISTINCT o_orderstatus) BETWEEN 3 AND 5 THEN 'pass' ELSE 'stop' END FROM src
UNION ALL SELECT 'aggregate(one urgent order)', CASE WHEN bool_or(decision = '1-URGENT') THEN 0 ELSE 1 END, 1,
  CASE WHEN bool_or(decision = '1-URGENT') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END,
  CASE WHEN bool_or(decision = '1-URGENT') THEN 'pass' ELSE 'stop' END FROM src"""
)

_ORACLES["rules_distinct"] = """
WITH l AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber),
o AS (SELECT count(*) AS n FROM orders GROUP BY o_orderkey),
c AS (SELECT 'distinct(l_orderkey, l_linenumber)' AS rule, CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS failed,
             CAST(sum(n) AS BIGINT) AS total, 0.01 AS stop_at FROM l
      UNION ALL SELECT 'distinct(o_orderkey)', CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT),
             CAST(sum(n) AS BIGINT), NULL FROM o)
SELECT rule, failed, total, CAST(failed AS DOUBLE) / total AS fraction,
       CASE WHEN stop_at IS NULL THEN CASE WHEN failed > 0 THEN 'stop' ELSE 'pass' END
            WHEN CAST(failed AS DOUBLE) / total >= 0.01 THEN 'stop'
            WHEN CAST(failed AS DOUBLE) / total >= 0.001 THEN 'warn' ELSE 'pass' END AS level
FROM c"""

_ORACLES["global_stats"] = """
SELECT count(*) AS n, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS open_orders,
       count(DISTINCT o_custkey) AS customers, round(avg(o_totalprice), 4) AS mean_price,
       max(o_totalprice) AS top_price, CAST(max(o_orderdate) AS DATE) AS last_day
FROM orders"""

_CASE_COLUMNS = ("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "order_day", "completion_day", "decision")

_ORACLES["missingness_long"] = f"WITH o AS ({_CASE_ORDERS})\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS variable, avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS prop_missing FROM o"
    for c in _CASE_COLUMNS
)

_RELEASES = f"""new_release AS ({_CASE_ORDERS}),
old_release AS (
  SELECT o_custkey, o_orderkey, o_totalprice * CASE WHEN o_orderstatus = 'F' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS o_totalprice,
         order_day + 5000 AS order_day, completion_day,
         CASE WHEN o_orderstatus <> 'P' THEN decision END AS decision, o_orderstatus AS old_status
  FROM new_release WHERE order_day < DATE '1999-01-01')"""

_KINDS = {
    "o_custkey": "numeric", "o_orderkey": "numeric", "o_totalprice": "numeric", "order_day": "Date",
    "completion_day": "Date", "decision": "character", "o_orderstatus": "character", "old_status": "character",
}
_OLD_COLUMNS = ("o_custkey", "o_orderkey", "o_totalprice", "order_day", "completion_day", "decision", "old_status")


def _profile(release: str, names: tuple[str, ...]) -> str:
    parts = []
    for c in names:
        kind = _KINDS[c]
        number, days, words = kind == "numeric", kind == "Date", kind == "character"

        def only(wanted: bool, sql: str, as_type: str) -> str:
            return sql if wanted else f"CAST(NULL AS {as_type})"

        parts.append(
            f"SELECT '{kind}' AS kind, '{c}' AS variable, count(*) - count({c}) AS n_missing,"
            f" round(CAST(count({c}) AS DOUBLE) / count(*), 4) AS complete_rate,"
            f" {only(number, f'round(avg({c}), 4)', 'DOUBLE')} AS mean,"
            f" {only(number, f'round(stddev_samp({c}), 4)', 'DOUBLE')} AS sd,"
            f" {only(number, f'round(CAST(min({c}) AS DOUBLE), 4)', 'DOUBLE')} AS low,"
            f" {only(number, f'round(CAST(max({c}) AS DOUBLE), 4)', 'DOUBLE')} AS high,"
            f" {only(days, f'min({c})', 'DATE')} AS date_min, {only(days, f'max({c})', 'DATE')} AS date_max,"
            f" {only(words, f'CAST(min(length({c})) AS BIGINT)', 'BIGINT')} AS length_min,"
            f" {only(words, f'CAST(max(length({c})) AS BIGINT)', 'BIGINT')} AS length_max,"
            f" {only(words, f'''count(CASE WHEN {c} = '' THEN 1 END)''', 'BIGINT')} AS empty,"
            f" '{release}' AS release FROM {release}_release"
        )
    return " UNION ALL ".join(parts)


_ORACLES["column_profile"] = f"WITH {_RELEASES}\n{_profile('old', _OLD_COLUMNS)}\nUNION ALL {_profile('new', _CASE_COLUMNS)}"

_DISTRIBUTION_KINDS = {**{c: _KINDS[c] for c in _CASE_COLUMNS}, "is_open": "logical", "note": "character"}


def _distribution(c: str, kind: str) -> str:
    def only(wanted: str, sql: str, as_type: str) -> str:
        return sql if kind == wanted else f"CAST(NULL AS {as_type})"

    quartiles = ", ".join(
        only("numeric", f"round(quantile_cont(CAST({c} AS DOUBLE), {share}), 4)", "DOUBLE") + f" AS {name}"
        for share, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))
    )
    epoch = "DATE '1970-01-01'"
    days = f"CAST(floor(quantile_cont(CAST({c} - {epoch} AS DOUBLE), 0.5)) AS INTEGER)"
    blank = f"count(CASE WHEN trim({c}) = '' THEN 1 END)"
    return (
        f"SELECT '{kind}' AS kind, '{c}' AS variable, count(DISTINCT {c}) AS n_distinct, {only('character', blank, 'BIGINT')} AS n_blank,"
        f" {only('logical', f'count(CASE WHEN {c} THEN 1 END)', 'BIGINT')} AS n_true,"
        f" {only('logical', f'count(CASE WHEN NOT {c} THEN 1 END)', 'BIGINT')} AS n_false, {quartiles},"
        f" {only('Date', f'{epoch} + {days}', 'DATE')} AS date_median FROM o"
    )


_ORACLES["column_distributions"] = (
    f"WITH c AS ({_CASE_ORDERS}), o AS (SELECT *, o_orderstatus = 'O' AS is_open, coalesce(decision, '  ') AS note FROM c)\n"
    + "\nUNION ALL ".join(_distribution(c, kind) for c, kind in _DISTRIBUTION_KINDS.items())
)

_ORACLES["profile_join"] = f"""
WITH {_RELEASES}, n AS ({_profile('new', _CASE_COLUMNS)}), o AS ({_profile('old', _OLD_COLUMNS)})
SELECT n.kind, n.variable, n.n_missing AS n_missing_new, n.complete_rate AS complete_rate_new, n.mean AS mean_new,
       o.n_missing AS n_missing_old, o.complete_rate AS complete_rate_old, o.mean AS mean_old
FROM n JOIN o ON n.kind = o.kind AND n.variable = o.variable"""

_ORACLES["drift_flags"] = f"""
WITH {_RELEASES},
miss AS (
  {" UNION ALL ".join(
      f"SELECT '{c}' AS variable, (SELECT avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) FROM new_release)"
      f" - (SELECT avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) FROM old_release) AS shift"
      for c in _OLD_COLUMNS if c != "old_status")}),
means AS (
  {" UNION ALL ".join(
      f"SELECT '{c}' AS variable, ((SELECT avg({c}) FROM new_release) - (SELECT avg({c}) FROM old_release))"
      f" / (SELECT avg({c}) FROM old_release) AS shift" for c in ("o_custkey", "o_orderkey", "o_totalprice"))}),
latest AS (
  {" UNION ALL ".join(
      f"SELECT '{c}' AS variable, (SELECT max({c}) FROM new_release) AS new_max, (SELECT max({c}) FROM old_release) AS old_max"
      for c in ("order_day", "completion_day"))}),
flags AS (
  SELECT variable, 1 AS place, printf('missing %+.1fpp', 100 * shift) AS flag FROM miss WHERE abs(shift) >= 0.02
  UNION ALL SELECT variable, 2, printf('mean %+.1f%%', 100 * shift) FROM means WHERE abs(shift) >= 0.05
  UNION ALL SELECT variable, 3, 'max date ' || old_max || ' → ' || new_max FROM latest WHERE new_max < old_max)
SELECT variable, string_agg(flag, '; ' ORDER BY place) AS flag FROM flags GROUP BY variable"""

_ORACLES["label_dictionary"] = """
SELECT 'c_name' AS variable, c_name AS value, row_number() OVER (ORDER BY c_name) AS code
FROM (SELECT DISTINCT c_name FROM customer) AS n
UNION ALL SELECT 'c_mktsegment', c_mktsegment, row_number() OVER (ORDER BY c_mktsegment)
FROM (SELECT DISTINCT c_mktsegment FROM customer) AS s"""

_ORACLES["label_encode"] = """
SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) AS c_name, c_nationkey, c_acctbal,
       dense_rank() OVER (ORDER BY c_mktsegment) AS c_mktsegment
FROM customer"""

_ORACLES["label_release"] = """
SELECT s_suppkey, dense_rank() OVER (ORDER BY s_name) AS name_of_the_supplier_as_registrd,
       dense_rank() OVER (ORDER BY n_name) AS nation_that_the_supplr_dlvrs_frm,
       dense_rank() OVER (ORDER BY n_name || '/' || s_suppkey % 7) AS nation_that_the_supplr_dlvrs_f_1
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_ORACLES["ragged_reader"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status,
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
       CASE WHEN o_orderstatus = 'O' THEN '|' || o_orderkey END AS overflow
FROM orders"""

_ORACLES["manifest_lines"] = """
SELECT n_name AS table_name, CAST(n_nationkey * 100 AS BIGINT) AS expected FROM nation WHERE n_nationkey % 5 NOT IN (1, 2)"""

_ORACLES["lookup_cleaning"] = """
SELECT CAST(s_suppkey AS VARCHAR) AS str_code, replace(s_name, '#', ' #') AS supplier_name,
       CASE WHEN s_suppkey % 3 <> 0 THEN 'x' END AS bln_active
FROM supplier"""

_ORACLES["release_row_delta"] = """
WITH c AS (SELECT count(*) AS n_new, count(CASE WHEN o_orderdate < DATE '1999-01-01' THEN 1 END) AS n_old FROM orders)
SELECT n_new, n_old, n_new - n_old AS delta, 100.0::DOUBLE * (n_new - n_old) / n_old AS pct,
       CASE WHEN n_new < n_old THEN 'row count decreased'
            WHEN 100.0::DOUBLE * (n_new - n_old) / n_old < 0.01 THEN 'row count hardly grew' END AS warning
FROM c"""

_ORACLES["recency_gap"] = """
WITH m AS (SELECT max(CAST(o_orderdate AS DATE)) AS event_max FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '2001-07-01')
SELECT DATE '2001-07-31' AS last_modified, event_max, CAST(date_diff('day', event_max, DATE '2001-07-31') AS INTEGER) AS gap_days,
       CASE WHEN date_diff('day', event_max, DATE '2001-07-31') > 7 THEN 'data is older than the file' END AS warning
FROM m"""

_ORACLES["schema_delta"] = """
SELECT 'added' AS change, 'o_orderstatus' AS column_name, count(*) AS n_rows, count(o_orderstatus) AS n_filled FROM orders
UNION ALL SELECT 'removed', 'old_status', count(*), count(o_orderstatus) FROM orders WHERE o_orderdate < DATE '1999-01-01'"""

_ORACLES["manifest_check"] = """
WITH c AS (
  SELECT o_orderpriority AS table_name, count(*) AS actual,
         CASE WHEN o_orderpriority <> '3-MEDIUM' THEN
           count(CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')) THEN 1 END) END AS expected
  FROM orders GROUP BY o_orderpriority)
SELECT table_name, actual, expected, abs(actual - expected) AS diff,
       CASE WHEN abs(actual - expected) >= 5 THEN 'warn' ELSE 'pass' END AS level
FROM c"""

_TEXT_ORDERS = """
  SELECT CAST(o_orderkey AS VARCHAR) AS ORDERKEY, CAST(o_custkey AS VARCHAR) AS CUSTKEY, o_orderstatus AS STATUS,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS PLACED, o_orderpriority AS PRIORITY,
         CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS COMPLETED,
         o_orderpriority = '1-URGENT' AS urgent,
         o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'F' AS two,
         o_orderpriority = '5-LOW' AND o_orderstatus = 'P' AS hidden,
         o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' AS lost
  FROM orders"""

_ORACLES["ragged_repair"] = f"""
WITH t AS ({_TEXT_ORDERS})
SELECT ORDERKEY, CUSTKEY, STATUS, PLACED, PRIORITY, COMPLETED, CASE WHEN NOT hidden THEN PRIORITY END AS NOTE
FROM t WHERE NOT lost"""

_ORACLES["ragged_repair_log"] = f"""
WITH t AS ({_TEXT_ORDERS}),
x AS (SELECT *, coalesce(COMPLETED, 'NA') AS done,
             'PLACED=' || PLACED || '; COMPLETED=' || coalesce(COMPLETED, 'NA') || '; STATUS=' || STATUS || '; PRIORITY=' || PRIORITY AS good
      FROM t WHERE urgent OR two OR hidden OR lost)
SELECT ORDERKEY AS row_n, CASE WHEN two OR lost THEN 2 ELSE 1 END AS n_extra,
       CASE WHEN lost THEN NULL WHEN two THEN 'CUSTKEY' ELSE 'STATUS' END AS shift_col,
       'overflow' AS pass, CASE WHEN lost THEN 'dropped' ELSE 'fixed' END AS status,
       CASE WHEN lost THEN NULL
            WHEN two THEN 'PLACED=''' || CUSTKEY || ''' (expected date)'
            ELSE 'PLACED=''' || STATUS || ''' (expected date); COMPLETED=''' || PRIORITY || ''' (expected date); PRIORITY='''
                 || PLACED || ''' (unexpected date)' END AS original_violations,
       CASE WHEN lost THEN 'PLACED=NA; COMPLETED=' || PLACED || '; STATUS=NA; PRIORITY=' || STATUS
            WHEN two THEN 'PLACED=' || CUSTKEY || '; COMPLETED=' || PLACED || '; STATUS=NA; PRIORITY=' || STATUS
            ELSE 'PLACED=' || STATUS || '; COMPLETED=' || PRIORITY || '; STATUS=NA; PRIORITY=' || PLACED END AS original_vals,
       CAST(NULL AS VARCHAR) AS fixed_violations,
       CASE WHEN lost THEN 'PLACED=NA; COMPLETED=' || PLACED || '; STATUS=NA; PRIORITY=' || STATUS ELSE good END AS fixed_vals
FROM x"""

_ORACLES["ragged_repair_summary"] = f"""
WITH t AS ({_TEXT_ORDERS})
SELECT count(*) AS rows_in, count(CASE WHEN urgent OR two OR hidden THEN 1 END) AS fixed,
       count(CASE WHEN lost THEN 1 END) AS dropped, CAST(0 AS BIGINT) AS dropped_after_fix,
       count(CASE WHEN NOT lost THEN 1 END) AS rows_out, CAST(0 AS BIGINT) AS fixed_without_cause
FROM t"""

_ORACLES["address_repair"] = """
SELECT CAST(c_custkey AS VARCHAR) AS IDNCASE,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'EAST BUILDING' ELSE c_mktsegment END AS ALIEN_CITY,
       'CA' AS ALIEN_STATE, '9' || c_custkey AS ALIEN_ZIPCODE, 'MX' AS NAT, '2001-02-03 00:00:00' AS E_28_DATE, 'D' AS CUSTODY
FROM customer"""

# --- the stages, each as a named subquery that the release reads too ---------------------------------

_PRIORITY = "substr(o_orderpriority, 1, 1)"
_DAY = "CAST(o_orderdate AS DATE)"

_STAGES: dict[str, str] = {}

_STAGES["proceedings"] = f"""
  WITH p AS (
    SELECT o_custkey AS idncase, o_orderkey AS id, {_DAY} + 800 AS nta, substr(o_orderpriority, 3, 3) AS court,
           {_PRIORITY} AS place, substr(o_orderpriority, 3, 2) AS judge, o_orderstatus = 'F' AS absent,
           CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AND o_totalprice > 450000 THEN 'WHO' ELSE 'RMV' END AS kind,
           CASE WHEN o_orderstatus <> 'O' THEN {_DAY} + 30 END AS comp,
           CASE WHEN o_orderstatus <> 'O' THEN CASE {_PRIORITY} WHEN '1' THEN 'R' WHEN '2' THEN 'D' END END AS dec,
           CASE WHEN o_orderstatus <> 'O' AND {_PRIORITY} = '3' THEN 'A' END AS other,
           CASE WHEN {_PRIORITY} = '2' THEN 'N2' END AS deported
    FROM orders),
  r AS (SELECT *, count(*) OVER (PARTITION BY idncase) AS n,
               row_number() OVER (PARTITION BY idncase ORDER BY comp NULLS LAST, dec NULLS LAST, other NULLS LAST, id) AS i FROM p)
  SELECT CAST(idncase AS INTEGER) AS idncase, max(CASE WHEN i = 1 THEN nta END) AS nta_date, max(CASE WHEN i = 1 THEN court END) AS first_court_code,
         min(kind) AS case_type_code, max(CASE WHEN i = 1 THEN place END) AS first_hearing_location_code,
         max(CASE WHEN i = 1 THEN judge END) AS first_judge_code, max(CASE WHEN i = n THEN comp END) AS final_completion_date,
         max(CASE WHEN i = n THEN court END) AS final_court_code, max(CASE WHEN i = n THEN dec END) AS dec_code,
         max(CASE WHEN i = n THEN other END) AS other_comp, bool_or(i = n AND absent) AS in_absentia,
         max(CASE WHEN i = n THEN place END) AS last_hearing_location_code, max(CASE WHEN i = n THEN judge END) AS last_judge_code,
         max(CASE WHEN i = n THEN deported END) AS deported_1_code, CAST(NULL AS VARCHAR) AS deported_2_code
  FROM r GROUP BY idncase HAVING min(kind) = max(kind)"""

_STAGES["cases"] = r"""
  SELECT CAST(c_custkey AS INTEGER) AS idncase, lpad(NULLIF(regexp_extract(c_custkey || '-1234', '^\d{3,5}'), ''), 5, '0') AS alien_zipcode,
         'N' || c_nationkey AS nat, substr(c_mktsegment, 1, 3) AS lang,
         CASE substr(c_mktsegment, 1, 1) WHEN 'A' THEN 'N' WHEN 'B' THEN 'R' WHEN 'F' THEN 'D' END AS custody_code,
         CASE WHEN c_acctbal < 5000 THEN 'F' ELSE 'M' END AS sex_code,
         CASE substr(c_mktsegment, 1, 1) WHEN 'A' THEN 'I' WHEN 'B' THEN 'E' WHEN 'F' THEN 'J' END AS asylum_claim_type_code,
         CASE WHEN c_acctbal < 5000 THEN 'D1' ELSE 'D2' END AS case_priority_code, CASE WHEN c_acctbal > 1000 THEN DATE '2001-02-03' END AS e28_date,
         DATE '1999-01-01' AS entry_date, CAST(c_nationkey + 1950 AS INTEGER) AS birth_year, c_acctbal > 1000 AS represented
  FROM customer"""

_STAGES["custody"] = """
  WITH e AS (SELECT user_id, event_id, CASE WHEN event_type <> 'error' THEN CAST(ts AS DATE) END AS detained,
                    CASE WHEN event_type = 'click' THEN CAST(ts AS DATE) + 5 END AS released FROM events),
  r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY detained NULLS LAST, event_id) AS i FROM e)
  SELECT CAST(user_id AS INTEGER) AS idncase, """ + ", ".join(
    f"max(CASE WHEN i = {i} THEN {source} END) AS detention_{end}_{i}"
    for end, source in (("start", "detained"), ("end", "released"))
    for i in range(1, 5)
) + " FROM r GROUP BY user_id"

_STAGES["appeals"] = f"""
  WITH a AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_orderstatus, {_DAY} + 40 AS filed,
                    CASE WHEN o_orderpriority <> '1-URGENT' THEN {_DAY} + 100 END AS decided FROM orders),
  r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY decided DESC NULLS FIRST, filed DESC, o_orderkey DESC) AS back FROM a)
  SELECT CAST(o_custkey AS INTEGER) AS idncase, substr(o_orderpriority, 3, 3) AS bia_decision, o_orderstatus AS bia_decision_type_code,
         {_PRIORITY} AS appeal_type, CASE WHEN o_orderstatus = 'F' THEN 'A' END AS appeal_filed_by_code,
         CASE {_PRIORITY} WHEN '2' THEN 'N' WHEN '3' THEN 'R' WHEN '4' THEN 'D' END AS custody_at_appeal_code,
         CAST(NULL AS DATE) AS e27_date, decided AS bia_decision_date, filed AS appeal_filed_date
  FROM r WHERE back = 1"""

_APPLICATION_COLUMNS = (
    ("asylum", 1), ("withholding", 2), ("cat", 3), ("adjustment", 4), ("non_lpr_cancellation", 5), ("lpr_cancellation", 6),
)
_STAGES["applications"] = """
  WITH a AS (SELECT *, CASE WHEN l_linestatus = 'F' THEN CASE l_returnflag WHEN 'A' THEN 'D' WHEN 'N' THEN 'F' WHEN 'R' THEN 'Q' END
                            WHEN l_returnflag = 'A' THEN 'W' END AS dec FROM lineitem),
  r AS (SELECT *, row_number() OVER (
                 PARTITION BY l_suppkey, l_linenumber
                 ORDER BY CAST(l_shipdate AS DATE) DESC, CASE dec WHEN 'F' THEN 14 WHEN 'D' THEN 12 WHEN 'W' THEN 2 ELSE 0 END DESC,
                          l_orderkey DESC, dec DESC NULLS LAST) AS back FROM a)
  SELECT CAST(l_suppkey AS INTEGER) AS idncase, """ + ", ".join(
    f"max(CASE WHEN back = 1 AND l_linenumber = {n} THEN CASE dec WHEN 'D' THEN 'DENY' WHEN 'F' THEN 'FULL GRANT'"
    f" WHEN 'W' THEN 'WITHDRAWN' ELSE dec END END) AS {name}_decision_last"
    for name, n in _APPLICATION_COLUMNS
) + " FROM r GROUP BY l_suppkey"

_BOND_LABEL = """CASE {p} WHEN '1' THEN 'BOND GRANTED-AMOUNT DECREASED' WHEN '2' THEN 'BOND DENIED-NO JURISDICTION'
 WHEN '3' THEN 'BOND GRANTED-OWN RECOGNIZANCE' WHEN '4' THEN 'FLORES - RELEASE' END""".format(p=_PRIORITY)
_BOND_COLUMNS = {
    "bond_completion_date": "comp", "bond_court_code": "court", "bond_judge_code": "judge", "hearing_location_code": "place",
    "bond_hearing_request_date": "asked", "bond_decision": "dec", "initial_bond_amount": "5000.0::DOUBLE", "new_bond_amount": "new_bond",
}
_STAGES["bonds"] = f"""
  WITH b AS (SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN {_DAY} + 10 END AS comp, {_DAY} AS asked,
                    substr(o_orderpriority, 3, 3) AS court, {_PRIORITY} AS place, substr(o_orderpriority, 3, 2) AS judge,
                    {_BOND_LABEL} AS dec, CASE WHEN o_totalprice < 250000 THEN 0.0::DOUBLE ELSE 1500.5::DOUBLE END AS new_bond
             FROM orders),
  r AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n,
               row_number() OVER (PARTITION BY o_custkey ORDER BY comp NULLS LAST, asked, o_orderkey) AS i FROM b)
  SELECT CAST(o_custkey AS INTEGER) AS idncase, """ + ", ".join(
    f"max(CASE WHEN i = {at} THEN {source} END) AS {name}_{place}"
    for place, at in (("first", "1"), ("second", "2"), ("last", "n"))
    for name, source in _BOND_COLUMNS.items()
) + " FROM r GROUP BY o_custkey"

_STAGES["charges"] = """
  WITH c AS (SELECT l_partkey, l_orderkey, l_suppkey * 10 + l_linenumber AS id,
                    CASE l_linenumber WHEN 1 THEN '212(a)(6)(C)(i)' WHEN 2 THEN '237(a)(2)(B)(iv)' WHEN 3 THEN '212(a)(6)(C)(i)'
                         WHEN 4 THEN '237(a)(2)(A)(i)(I)' WHEN 5 THEN '215(g)' WHEN 6 THEN '212(a)(7)(B)' END AS section FROM lineitem),
  d AS (SELECT l_partkey, l_orderkey, section, min(id) AS id FROM c GROUP BY l_partkey, l_orderkey, section),
  r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, id) AS i FROM d)
  SELECT CAST(l_partkey AS INTEGER) AS idncase, """ + ", ".join(
    f"max(CASE WHEN i = {i} THEN section END) AS charge_section_{i}" for i in range(1, 5)
) + " FROM r GROUP BY l_partkey"

for _name, _sql in _STAGES.items():
    _ORACLES[f"stage_{_name}"] = _sql

_ORACLES["court_decision_lookups"] = """
SELECT DISTINCT CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'O' ELSE 'C' END AS kind,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'WHO' ELSE 'RMV' END AS case_type_code,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'R' WHEN '2' THEN 'D' WHEN '3' THEN 'A' END AS code,
       substr(o_orderpriority, 3) || ' OUTCOME' AS label
FROM orders"""


def _cased(x: str) -> str:
    return _caps(_title(x))


_HELD = "WHEN 'N' THEN 'Never Detained' WHEN 'R' THEN 'Released' WHEN 'D' THEN 'Detained Throughout'"
# Code columns that one of the order priorities names: the column and the part of the priority it holds.
_WORD_JOINS = [
    ("first_court_code", "three"), ("final_court_code", "three"), ("first_hearing_location_code", "digit"),
    ("last_hearing_location_code", "digit"), ("first_judge_code", "two"), ("last_judge_code", "two"),
    *[(f"{c}_{p}", key) for p in ("first", "second", "last")
      for c, key in (("bond_court_code", "three"), ("hearing_location_code", "digit"), ("bond_judge_code", "two"))],
]
_WORD_OF = {code: f"w{i}" for i, (code, _) in enumerate(_WORD_JOINS)}
# Code column, its output names and what the priority says there.
_END_WORDS = [
    ("first_court_code", "court_code_first", "court_first", "town"), ("final_court_code", "court_code_last", "court_last", "town"),
    ("first_hearing_location_code", "hearing_location_code_first", "hearing_location_first", "hall"),
    ("last_hearing_location_code", "hearing_location_code_last", "hearing_location_last", "hall"),
    ("first_judge_code", "judge_code_first", "judge_first", "judge"), ("last_judge_code", "judge_code_last", "judge_last", "judge"),
]
_DATED = {"ij_completion_date_last": "final_completion_date", "ij_or_bia_completion_date_last": "ended"}
_SPANS = [
    *[("nta_date", b) for b in (*_DATED, *(f"bond_completion_date_{p}" for p in ("first", "second", "last")))],
    ("appeal_filed_date", "bia_decision_date"),
    *[(f"bond_hearing_request_date_{p}", f"bond_completion_date_{p}") for p in ("first", "second", "last")],
]


def _ends_of(code: str, code_name: str, name: str, part: str) -> str:
    return f"{code} AS {code_name}, {_WORD_OF[code]}.{part} AS {name}"


def _bond(p: str) -> str:
    """Columns of one bond hearing; a zero amount stays for granted bonds and one kind of release."""
    kept = f"new_bond_amount_{p} <> 0 OR bond_decision_{p} LIKE '%GRANTED%' OR bond_decision_{p} = 'FLORES - RELEASE'"
    return ", ".join([
        _ends_of(f"bond_court_code_{p}", f"bond_court_code_{p}", f"bond_court_{p}", "town"),
        _ends_of(f"hearing_location_code_{p}", f"bond_hearing_location_code_{p}", f"bond_hearing_location_{p}", "hall"),
        _ends_of(f"bond_judge_code_{p}", f"bond_judge_code_{p}", f"bond_judge_{p}", "judge"),
        f"bond_hearing_request_date_{p}, bond_completion_date_{p}, {_cased(f'bond_decision_{p}')} AS bond_decision_{p}",
        f"initial_bond_amount_{p}, CASE WHEN {kept} THEN new_bond_amount_{p} END AS new_bond_amount_{p}",
    ])


# A decision of R or D has its own outcome, A the other completion's; without any code the entry
# without a code applies.
_RELEASE = f"""
WITH {", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in _STAGES.items())},
areas AS (SELECT substr(lpad(CAST(s_suppkey AS VARCHAR), 5, '0'), 1, 5) AS zcta, min(s_nationkey) AS n FROM supplier GROUP BY 1),
words AS (SELECT DISTINCT o_orderpriority AS p, substr(o_orderpriority, 1, 1) AS digit, substr(o_orderpriority, 3, 3) AS three,
                substr(o_orderpriority, 3, 2) AS two, substr(o_orderpriority, 3) AS raw FROM orders),
word AS MATERIALIZED (SELECT *, {_cased('raw')} AS name, {_cased("raw || ' TOWN'")} || ' (' || three || ')' AS town,
                {_cased("raw || ' to bia'")} AS appeal, raw || ', J.' AS judge,
                CASE WHEN digit NOT IN ('4', '5') THEN {_cased('raw')} END AS hall FROM words),
j AS MATERIALIZED (
  SELECT p.*, k.* EXCLUDE (idncase), a.* EXCLUDE (idncase), b.* EXCLUDE (idncase), x.* EXCLUDE (idncase), c.* EXCLUDE (idncase),
         h.* EXCLUDE (idncase), areas.n AS area,
         CASE WHEN a.bia_decision_date > p.final_completion_date THEN a.bia_decision_date ELSE p.final_completion_date END AS ended
  FROM proceedings p JOIN cases k USING (idncase) LEFT JOIN custody h USING (idncase) LEFT JOIN appeals a USING (idncase)
       LEFT JOIN applications x USING (idncase) LEFT JOIN bonds b USING (idncase) LEFT JOIN charges c USING (idncase)
       LEFT JOIN areas ON alien_zipcode = zcta)
SELECT idncase, case_type_code, CASE case_type_code WHEN 'RMV' THEN 'Removal' WHEN 'WHO' THEN 'Withholding' END AS case_type,
       case_priority_code, CASE case_priority_code WHEN 'D1' THEN 'Detained' WHEN 'D2' THEN 'Released' END AS case_priority,
       sex_code, CASE sex_code WHEN 'F' THEN 'Female' ELSE 'Male' END AS sex, birth_year, nat AS nationality_code,
       {_cased("n_name")} AS nationality, lang AS language_code, {_cased("segment")} AS language,
       CASE WHEN area IS NOT NULL THEN 'CA' END AS state, CASE WHEN area IS NOT NULL THEN '06' END AS state_fips_code,
       'County ' || area AS county, lpad(CAST(area AS VARCHAR), 5, '0') AS county_fips_code,
       CASE WHEN area > 10 THEN 'place ' || area END AS place, CASE WHEN area > 10 THEN lpad(CAST(area AS VARCHAR), 7, '0') END AS place_fips_code,
       entry_date, nta_date, charge_section_1, charge_section_2, charge_section_3, charge_section_4,
       {", ".join(_ends_of(*x) for x in _END_WORDS)},
       deported_1_code, CASE WHEN deported_1_code IS NOT NULL THEN (SELECT {_cased("n_name")} FROM nation WHERE n_nationkey = 2) END AS deported_1,
       deported_2_code, CAST(NULL AS VARCHAR) AS deported_2, e28_date, represented, in_absentia,
       final_completion_date AS ij_completion_date_last, ended AS ij_or_bia_completion_date_last,
       custody_code, CASE custody_code {_HELD} END AS custody,
       {", ".join(f"detention_{e}_{i}" for i in range(1, 5) for e in ("start", "end"))},
       {", ".join(_bond(p) for p in ("first", "second", "last"))},
       asylum_claim_type_code,
       CASE asylum_claim_type_code WHEN 'I' THEN 'Affirmative' WHEN 'E' THEN 'Defensive' WHEN 'J' THEN 'J' END AS asylum_claim_type,
       {", ".join(f"CASE {n}_decision_last WHEN 'DENY' THEN 'Deny' WHEN 'FULL GRANT' THEN 'Full Grant' WHEN 'WITHDRAWN' THEN 'Withdrawn' WHEN 'Q' THEN 'Q' ELSE 'No Application' END AS {n}_decision_last" for n, _ in _APPLICATION_COLUMNS)},
       CASE WHEN case_type_code <> 'RMV' THEN NULL WHEN dec_code = 'R' THEN 'Urgent Outcome' WHEN dec_code = 'D' THEN 'High Outcome'
            WHEN dec_code IS NULL THEN 'Not Specified Outcome' END AS case_outcome,
       j.appeal_type AS appeal_type_code, ap.appeal AS appeal_type, appeal_filed_by_code,
       CASE WHEN appeal_filed_by_code = 'A' THEN 'Filed' END AS appeal_filed_by, appeal_filed_date, e27_date,
       custody_at_appeal_code, CASE custody_at_appeal_code {_HELD} END AS custody_at_appeal,
       j.bia_decision AS bia_decision_code, bd.name AS bia_decision, bia_decision_type_code, CAST(NULL AS VARCHAR) AS bia_decision_type,
       bia_decision_date,
       {", ".join(f"CAST({_DATED.get(b, b)} - {a} AS DOUBLE) AS {a}_to_{b}_days" for a, b in _SPANS)}
FROM j LEFT JOIN nation ON nat = 'N' || n_nationkey
     LEFT JOIN (SELECT DISTINCT c_mktsegment AS segment FROM customer) AS s ON lang = substr(segment, 1, 3)
     LEFT JOIN word ap ON j.appeal_type = ap.digit LEFT JOIN word bd ON j.bia_decision = bd.three
     {" ".join(f"LEFT JOIN word w{i} ON {code} = w{i}.{key}" for i, (code, key) in enumerate(_WORD_JOINS))}
WHERE nta_date >= DATE '1997-10-01' AND case_type_code IN ('RMV', 'WHO')"""

_ORACLES["release_table"] = _RELEASE


# --- evidence ------------------------------------------------------------------------------------------

_ORACLES["stage_counts"] = """
WITH t AS (
  SELECT 'proceedings' AS table_name, count(*) AS n, count(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 1 END) AS fixed, 0 AS off FROM orders
  UNION ALL SELECT 'cases', count(*), count(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 END), 0 FROM customer
  UNION ALL SELECT 'custody', count(*), 0, 0 FROM events
  UNION ALL SELECT 'appeals', count(*), 0, NULL FROM orders
  UNION ALL SELECT 'applications', count(*), 0, NULL FROM lineitem
  UNION ALL SELECT 'bonds', count(*), 0, 7 FROM orders
  UNION ALL SELECT 'charges', count(*), 0, 0 FROM lineitem)
SELECT table_name, n AS rows_in, fixed, CAST(0 AS BIGINT) AS dropped, CAST(0 AS BIGINT) AS dropped_after_fix, n AS rows_out,
       CAST(n - off AS BIGINT) AS expected, CASE WHEN off >= 5 THEN 'warn' ELSE 'pass' END AS level
FROM t"""

_PRINT = "('0x' || substr(md5(array_to_string(list_transform({cells}[1:7], lambda x: CASE WHEN x IS NULL THEN '' ELSE '=' || x END), chr(31))), 1, 15))::HUGEINT"
_ORACLES["untouched_fingerprint"] = f"""
WITH t AS ({_TEXT_ORDERS}),
c AS (SELECT *, CASE WHEN urgent THEN [ORDERKEY, CUSTKEY, NULL, STATUS, PLACED, PRIORITY, COMPLETED]
                     WHEN two THEN [ORDERKEY, NULL, NULL, CUSTKEY, STATUS, PLACED, PRIORITY]
                     WHEN lost THEN [ORDERKEY, CUSTKEY, NULL, NULL, STATUS, PLACED, PRIORITY]
                     WHEN hidden THEN [ORDERKEY, CUSTKEY, NULL, STATUS, PLACED, PRIORITY, COMPLETED]
                     ELSE [ORDERKEY, CUSTKEY, STATUS, PLACED, PRIORITY, COMPLETED, PRIORITY] END AS cells FROM t),
h AS (SELECT {_PRINT.format(cells="cells")} AS h, urgent OR two OR hidden OR lost AS touched FROM c)
SELECT CAST(sum(h) AS VARCHAR) AS print_before, CAST(coalesce(sum(h) FILTER (WHERE touched), 0) AS VARCHAR) AS print_touched,
       CAST(sum(h) FILTER (WHERE NOT touched) AS VARCHAR) AS print_after, TRUE AS unchanged
FROM h"""


def _rule_lines(source: str, label: str, lines: list[tuple[str, str, str, float | None, float | None]]) -> str:
    """Lines of (rule, failed, total, warn, stop), the counts as aggregates over a source."""
    counts = ", ".join(f"CAST({failed} AS BIGINT) AS f{i}, CAST({total} AS BIGINT) AS t{i}" for i, (_, failed, total, _, _) in enumerate(lines))
    parts = []
    for i, (rule, _, _, warn, stop) in enumerate(lines):
        share = f"CASE WHEN t{i} = 0 THEN 0.0::DOUBLE ELSE f{i}::DOUBLE / t{i} END"
        if warn is None and stop is None:
            level = f"CASE WHEN f{i} > 0 THEN 'stop' ELSE 'pass' END"
        else:
            level = "CASE " + (f"WHEN {share} >= {stop!r} THEN 'stop' " if stop is not None else "") + (f"WHEN {share} >= {warn!r} THEN 'warn' " if warn is not None else "") + "ELSE 'pass' END"
        name = rule.replace("'", "''")
        parts.append(f'SELECT \'{label}\' AS "table", \'{name}\' AS rule, f{i} AS failed, t{i} AS total, {share} AS fraction, {level} AS level FROM c')
    return f"SELECT * FROM (WITH c AS (SELECT {counts} FROM {source}) " + " UNION ALL ".join(parts) + ")"


# Warn and stop levels of the rules.
_KEYS, _CODES, _DATES, _FILLED = (0.005, 0.01), (0.0001, 0.001), (0.001, 0.01), (0.01, 0.05)
_PARSED, _UNCHECKED = (None, 0.0010000000000000002), (None, 2.0)


def _count(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"



_MANY = (0.0001, 0.005)
_UNTIL: dict[str, dict[tuple, str]] = {
    "proceedings source": {
        _KEYS: "not_null(IDNPROCEEDING) | not_null(IDNCASE) | holds(second country needs a first)",
        _CODES: "matches(IDNPROCEEDING) | in_lookup(CASE_TYPE) | in_lookup(CUSTODY) | in_set(ABSENTIA) | in_set(TRANSFER_STATUS) | in_lookup(NAT)"
        " | in_lookup(DEPORTED_1) | in_lookup(DEPORTED_2) | in_lookup(LANG) | in_lookup(BASE_CITY_CODE) | in_lookup(HEARING_LOC_CODE)"
        " | in_lookup(SCHEDULED_HEAR_LOC) | in_lookup(PREV_HEARING_LOC) | in_lookup(PREV_HEARING_BASE) | in_lookup(DEC_CODE) | in_lookup(OTHER_COMP)",
        (None, None): "matches(IDNCASE)",
        _DATES: "in_set(DEC_TYPE) | holds(countries differ)",
        _FILLED: "holds(deportation has a country)",
        (0.0001, 0.025): "in_lookup(TRANSFER_TO)",
        (0.0001, 0.0025): "in_lookup(IJ_CODE) | in_lookup(PREV_IJ_CODE)",
        _UNCHECKED: "parses(IDNPROCEEDING: integer) | parses(IDNCASE: integer) | parses(OSC_DATE: date) | parses(INPUT_DATE: date)"
        " | parses(TRANS_IN_DATE: date) | parses(HEARING_DATE: date) | parses(COMP_DATE: date) | parses(VENUE_CHG_GRANTED: date)"
        " | parses(DATE_APPEAL_DUE_STATUS: date) | parses(DATE_DETAINED: date) | parses(DATE_RELEASED: date)",
    },
    "proceedings typed": {_DATES: "holds(nta_date <= comp_date) | holds(date_detained <= date_released)"},
    "proceedings result": {
        (0.25, 0.5): "not_null(final_completion_date)",
        _FILLED: "not_null(nta_date) | not_null(first_court_code) | not_null(final_court_code) | not_null(first_judge_code) | not_null(last_judge_code)",
        _DATES: "holds(nta_date <= final_completion_date)",
    },
    "cases source": {
        _KEYS: "not_null(IDNCASE)",
        (None, None): "matches(IDNCASE)",
        _CODES: "in_lookup(Sex) | in_set(C_ASY_TYPE) | in_lookup(CASE_TYPE) | in_lookup(CUSTODY) | in_set(LPR) | in_lookup(NAT) | in_lookup(LANG)"
        " | in_lookup(CASEPRIORITY_CODE) | matches(DETENTION_DATE)",
        _DATES: "matches(ALIEN_STATE) | matches(ALIEN_ZIPCODE)",
        _PARSED: "parses(IDNCASE: integer) | parses(E_28_DATE: datetime) | parses(LATEST_HEARING: datetime) | parses(UP_BOND_DATE: datetime)"
        " | parses(DATE_OF_ENTRY: datetime) | parses(C_RELEASE_DATE: datetime) | parses(ADDRESS_CHANGEDON: datetime) | parses(DATE_DETAINED: datetime)"
        " | parses(DATE_RELEASED: datetime)",
    },
    "cases result": {_DATES: "between(birth_year)"},
    "custody source": {
        _KEYS: "not_null(IDNCUSTODY) | not_null(IDNCASE)",
        _CODES: "in_lookup(CUSTODY)",
        _PARSED: "parses(IDNCUSTODY: integer) | parses(IDNCASE: integer) | parses(DATDETAINED: datetime) | parses(DATRELEASED: datetime)",
    },
    "custody typed": {_DATES: "holds(date_detained <= date_released)"},
    "custody result": {_DATES: "holds(detention_start_1 <= detention_start_2) | holds(detention_start_2 <= detention_start_3)"},
    "appeals source": {
        _KEYS: "not_null(idncase)",
        (None, None): "matches(idncase) | matches(idnAppeal) | in_set(strAppealCategory)",
        _CODES: "matches(idnProceeding) | in_lookup(strBIADecision) | in_lookup(strAppealType) | in_lookup(strCaseType) | in_set(strCustody)"
        " | in_lookup(strNat) | in_lookup(strLang) | in_set(strProbono)",
        (0.00001, 0.0001): "in_lookup(strBIADecisionType)",
        _PARSED: "parses(idnAppeal: integer) | parses(idnProceeding: integer) | parses(idncase: integer) | parses(datAppealFiled: datetime)"
        " | parses(datBIADecision: datetime) | parses(datAttorneyE27: datetime)",
    },
    "appeals typed": {_DATES: "holds(appeal_filed_date <= bia_decision_date)"},
    "appeals result": {_CODES: "in_set(custody_at_appeal_code)"},
    "applications source": {
        _KEYS: "not_null(IDNPROCEEDINGAPPLN) | not_null(IDNPROCEEDING) | not_null(IDNCASE)",
        (None, None): "matches(IDNPROCEEDINGAPPLN) | matches(IDNPROCEEDING) | matches(IDNCASE)",
        _MANY: "in_lookup(APPL_CODE) | in_lookup(APPL_DEC)",
        _CODES: "matches(APPL_RECD_DATE)",
        _PARSED: "parses(IDNPROCEEDINGAPPLN: integer) | parses(IDNPROCEEDING: integer) | parses(IDNCASE: integer) | parses(APPL_RECD_DATE: datetime)",
    },
    "applications result": {_CODES: " | ".join(f"in_lookup({name}_decision_last)" for name, _ in _APPLICATION_COLUMNS)},
    "bonds source": {
        _KEYS: "not_null(IDNASSOCBOND) | not_null(IDNPROCEEDING) | not_null(IDNCASE)",
        (None, None): "matches(IDNASSOCBOND) | matches(IDNPROCEEDING) | matches(IDNCASE)",
        _CODES: "in_lookup(DEC) | in_set(BOND_TYPE) | in_lookup(BASE_CITY_CODE) | in_lookup(HEARING_LOC_CODE) | in_lookup(FILING_METHOD)"
        " | in_lookup(FILING_PARTY) | matches(INITIAL_BOND) | matches(NEW_BOND)",
        (0.001, 0.005): "in_lookup(IJ_CODE)",
        _PARSED: "parses(IDNASSOCBOND: integer) | parses(IDNPROCEEDING: integer) | parses(IDNCASE: integer) | parses(OSC_DATE: datetime)"
        " | parses(UPDATE_DATE: datetime) | parses(INPUT_DATE: datetime) | parses(COMP_DATE: date) | parses(BOND_HEAR_REQ_DATE: date)"
        " | parses(DATE_APPEAL_DUE: datetime) | parses(E_28_DATE: datetime) | parses(DECISION_DUE_DATE: datetime) | parses(INITIAL_BOND: double)"
        " | parses(NEW_BOND: double)",
    },
    "bonds typed": {
        (None, None): "at_least(initial_bond_amount) | at_least(new_bond_amount)",
        _DATES: "holds(bond_hearing_request_date <= bond_completion_date)",
    },
    "bonds result": {_CODES: "not_in_set(bond_decision_first) | not_in_set(bond_decision_second) | not_in_set(bond_decision_last)"},
    "charges source": {
        _KEYS: "not_null(IDNPRCDCHG) | not_null(IDNCASE) | not_null(IDNPROCEEDING)",
        (None, None): "matches(IDNPRCDCHG) | matches(IDNCASE) | matches(IDNPROCEEDING)",
        _MANY: "not_null(CHARGE)",
        _DATES: "matches(CHARGE)",
        _CODES: "in_set(CHG_STATUS)",
        _PARSED: "parses(IDNPRCDCHG: integer) | parses(IDNCASE: integer) | parses(IDNPROCEEDING: integer)",
    },
    "charges result": {_FILLED: "not_null(charge_section_1)"},
    "final": {
        _CODES: "in_set(state) | matches(county_fips_code) | matches(place_fips_code) | in_set(asylum_claim_type) | in_lookup(case_type_code)"
        " | in_lookup(bia_decision_type_code) | in_set(custody) | "
        + " | ".join(f"{rule}_bond_amount_{p})" for rule in ("at_least(initial", "at_least(new", "above(new") for p in ("first", "second", "last")),
        _KEYS: "not_null(idncase)",
        _FILLED: "not_null(language) | not_null(nationality) | not_null(deported_1) | not_null(deported_2) | not_null(sex) | not_null(case_priority)"
        " | not_null(case_type) | not_null(last_judge_name) | not_null(first_judge_name) | not_null(appeal_type) | not_null(appeal_filed_by)"
        " | not_null(bia_decision) | not_null(bia_decision_type) | not_null(custody) | not_null(custody_at_appeal)",
    },
}

#: Conditions of the rows that fail; all other rules hold on these tables.
_FAILS = {
    ("proceedings source", "in_lookup(HEARING_LOC_CODE)"): "o_orderpriority = '5-LOW'",
    ("proceedings typed", "holds(nta_date <= comp_date)"): "o_orderstatus <> 'O'",
    ("proceedings result", "not_null(final_completion_date)"): "final_completion_date IS NULL",
    ("proceedings result", "holds(nta_date <= final_completion_date)"): "nta_date > final_completion_date",
    ("appeals source", "in_lookup(strBIADecisionType)"): "o_orderstatus NOT IN ('A', 'N', 'R')",
    ("applications source", "in_lookup(APPL_CODE)"): "l_linenumber > 3",
    ("applications source", "in_lookup(APPL_DEC)"): "l_linestatus = 'F' OR l_returnflag = 'A'",
    **{("applications result", f"in_lookup({n}_decision_last)"): f"{n}_decision_last NOT IN ('DENY', 'FULL GRANT', 'WITHDRAWN')" for n, _ in _APPLICATION_COLUMNS},
    ("bonds source", "in_lookup(DEC)"): "substr(o_orderpriority, 1, 1) IN ('1', '2', '4')",
    ("bonds source", "in_lookup(HEARING_LOC_CODE)"): "o_orderpriority = '5-LOW'",
    ("charges source", "not_null(CHARGE)"): "l_linenumber = 7",
    ("charges source", "matches(CHARGE)"): "l_linenumber = 5",
    ("charges result", "not_null(charge_section_1)"): "charge_section_1 IS NULL",
    **{("final", f"above(new_bond_amount_{p})"): f"new_bond_amount_{p} = 0 AND bond_decision_{p} = 'FLORES - RELEASE'" for p in ("first", "second", "last")},
    ("final", "not_null(bia_decision_type)"): "bia_decision_type_code IS NOT NULL",
    ("final", "in_lookup(bia_decision_type_code)"): "bia_decision_type_code NOT IN ('A', 'N', 'R')",
}

#: Conditions of the rows that a rule looks at, where those aren't all.
_LOOKS = {
    **{
        ("final", f"above(new_bond_amount_{p})"): f"coalesce(bond_decision_{p}, '') NOT IN ('AMELIORATION GRANTED', 'BOND GRANTED-AMOUNT DECREASED', 'BOND GRANTED-OWN RECOGNIZANCE')"
        for p in ("first", "second", "last")
    },
    **{("final", f"not_null({n})"): f"{n}_code IS NOT NULL" for n in ("deported_1", "deported_2", "appeal_filed_by", "custody", "custody_at_appeal", "bia_decision_type")},
    ("final", "not_null(appeal_type)"): "bia_decision_type_code IS NOT NULL",
    ("final", "not_null(bia_decision)"): "bia_decision_type_code IS NOT NULL",
}

_RULE_SOURCES = {"proceedings": "orders", "cases": "customer", "custody": "events", "appeals": "orders", "applications": "lineitem", "bonds": "orders", "charges": "lineitem"}


def _count(condition: str | None) -> str:
    return "count(*)" if condition is None else f"count(CASE WHEN {condition} THEN 1 END)"


def _stage_lines(label: str, source: str) -> str:
    lines = [
        (rule.strip(), _count(_FAILS.get((label, rule.strip()), "FALSE")), _count(_LOOKS.get((label, rule.strip()))), *levels)
        for levels, names in _UNTIL[label].items()
        for rule in names.split(" | ")
    ]
    return _rule_lines(source, label, lines)


_ORACLES["stage_rules"] = " UNION ALL ".join(
    _stage_lines(label, f"({_STAGES[label.split()[0]]})" if label.endswith("result") else _RULE_SOURCES[label.split()[0]])
    for label in _UNTIL
    if label != "final"
)
_JOINED = f"""({_STAGES["proceedings"]}) p JOIN ({_STAGES["cases"]}) c USING (idncase)
 LEFT JOIN ({_STAGES["appeals"]}) a USING (idncase) LEFT JOIN ({_STAGES["bonds"]}) b USING (idncase)"""
_ORACLES["final_rules"] = _stage_lines("final", _JOINED)

_ORACLES["lookup_duplicates"] = """
WITH k AS (
  SELECT 'nation' AS lookup, CAST(n_nationkey AS VARCHAR) AS key FROM nation UNION ALL SELECT 'region', CAST(n_regionkey AS VARCHAR) FROM nation
  UNION ALL SELECT 'supplier', s_nationkey || '|' || s_suppkey % 3 FROM supplier WHERE s_suppkey % 3 > 0),
d AS (SELECT lookup, key, count(*) AS lines FROM k GROUP BY lookup, key HAVING count(*) > 1),
u AS (
  SELECT 'nation' AS lookup, CAST(c_nationkey AS VARCHAR) AS key FROM customer UNION ALL SELECT 'region', CAST(c_custkey % 9 AS VARCHAR) FROM customer
  UNION ALL SELECT 'supplier', c_nationkey || '|' || c_custkey % 4 FROM customer)
SELECT lookup, key, lines, count(*) AS rows FROM d JOIN u USING (lookup, key) GROUP BY lookup, key, lines"""

_ORACLES["share_crosswalk"] = """
WITH s AS (SELECT lpad(CAST(s_suppkey % 40 AS VARCHAR), 5, '0') AS zcta, s_nationkey AS n, max(s_acctbal) AS share FROM supplier GROUP BY ALL),
c AS (SELECT zcta, arg_min(n, (-share, lpad(CAST(n AS VARCHAR), 5, '0'))) AS n FROM s GROUP BY zcta),
p AS (SELECT zcta, arg_min(n, (-share, lpad(CAST(n AS VARCHAR), 7, '0'))) AS n FROM s WHERE n % 2 = 0 GROUP BY zcta),
t AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zcta, n_nationkey AS n, n_name FROM nation WHERE n_regionkey = 0)
SELECT zcta, 'CA' AS state, substr(lpad(CAST(c.n AS VARCHAR), 5, '0'), 1, 2) AS state_fips_code, 'County ' || c.n AS county,
       lpad(CAST(c.n AS VARCHAR), 5, '0') AS county_fips_code, 'place ' || p.n AS place, lpad(CAST(p.n AS VARCHAR), 7, '0') AS place_fips_code
FROM c LEFT JOIN p USING (zcta) WHERE zcta NOT IN (SELECT zcta FROM t)
UNION ALL SELECT zcta, 'PR', substr(CAST(n + 72000 AS VARCHAR), 1, 2), n_name, CAST(n + 72000 AS VARCHAR), NULL, NULL FROM t"""

_ORACLES["ragged_files"] = """
SELECT CASE WHEN odd THEN 'ORDERKEY' ELSE CAST(o_orderkey AS VARCHAR) END AS ORDERKEY, CASE WHEN odd THEN 'STATUS' ELSE o_orderstatus END AS STATUS,
       CASE WHEN odd THEN 'PRIORITY' ELSE o_orderpriority END AS PRIORITY
FROM (SELECT *, o_orderkey % 50 = 0 AS odd FROM orders)"""

_ORACLES["broken_text"] = f"""
SELECT rule, failed, total, fraction, level FROM ({_rule_lines("documents", "documents", [
    ("valid_text(text)", _count("doc_id % 7 = 0 OR doc_id % 5 = 0"), "count(*)", 0.1, 0.9),
    ("valid_text(text)", _count("doc_id % 7 = 0 OR doc_id % 5 = 0 OR doc_id % 11 = 0"), "count(*)", 0.0001, 0.3),
    ("valid_text(lang)", "0", "count(*)", None, None),
])})"""

_RECENCY_LINES = """
  SELECT 'recency' AS part, 'last_modified' AS name, CAST(last_modified AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS warning FROM g
  UNION ALL SELECT 'recency', 'latest', CAST(event_max AS VARCHAR), NULL FROM g
  UNION ALL SELECT 'recency', 'gap_days', CAST(gap_days AS VARCHAR), warning FROM g"""
_ORACLES["release_check_first"] = f"""
WITH g AS ({_ORACLES["recency_gap"]})
{_RECENCY_LINES} UNION ALL SELECT 'rows', 'new', CAST(count(*) AS VARCHAR), NULL FROM orders"""
_ORACLES["release_check"] = f"""
WITH g AS ({_ORACLES["recency_gap"]}), d AS ({_ORACLES["release_row_delta"]}), s AS ({_ORACLES["schema_delta"]}), f AS ({_ORACLES["drift_flags"]})
{_RECENCY_LINES}
UNION ALL SELECT 'rows', 'new', CAST(n_new AS VARCHAR), NULL FROM d UNION ALL SELECT 'rows', 'old', CAST(n_old AS VARCHAR), NULL FROM d
UNION ALL SELECT 'rows', 'delta', CAST(delta AS VARCHAR), warning FROM d
UNION ALL SELECT 'schema', column_name, CAST(n_filled AS VARCHAR), 'column ' || change FROM s
UNION ALL SELECT 'drift', variable, NULL, flag FROM f"""


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
