"""The relational surface that free SELECT text reaches: one query a feature, over the raw tables."""

from __future__ import annotations

from collections.abc import Callable

from .dialect import Dialect

PASSTHROUGH: dict[str, Callable[[Dialect], str]] = {}


def feature(make: Callable[[Dialect], str]) -> Callable[[Dialect], str]:
    PASSTHROUGH[f"passthru_{make.__name__.rstrip('_')}"] = make
    return make


def _exact(x: str) -> str:
    """A sum of cents that doesn't depend on the order of its rows."""
    return f"CAST(sum(CAST({x} AS DECIMAL(18,2))) AS DOUBLE)"


@feature
def join_inner(x):
    return f"SELECT n_name, count(*) AS orders, {_exact('o_totalprice')} AS total FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"


@feature
def join_left(x):
    return "SELECT c_custkey, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F' GROUP BY c_custkey"


@feature
def join_full(x):
    return """WITH a AS (SELECT n_nationkey AS k, n_name FROM nation WHERE n_nationkey < 15), b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier WHERE s_nationkey > 8 GROUP BY s_nationkey)
SELECT coalesce(a.k, b.k) AS k, n_name, suppliers FROM a FULL OUTER JOIN b ON a.k = b.k"""


@feature
def join_cross(x):
    return "SELECT r_name, n_name FROM region CROSS JOIN nation"


@feature
def semi(x):
    return "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)"


@feature
def anti(x):
    return "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)"


@feature
def scalar_subquery(x):
    return "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > (SELECT avg(p_retailprice) FROM part)"


@feature
def in_subquery(x):
    return "SELECT p_partkey, p_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)"


_MEASURES = f"count(*) AS n, {_exact('l_quantity')} AS qty"


@feature
def rollup(x):
    return f"SELECT l_returnflag, l_linestatus, CAST({'grouping_id' if x.spark else 'grouping_id'}({'' if x.spark else ''}l_returnflag, l_linestatus) AS BIGINT) AS g, {_MEASURES} FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)"


@feature
def cube(x):
    return f"SELECT l_returnflag, l_linestatus, CAST(grouping_id(l_returnflag, l_linestatus) AS BIGINT) AS g, {_MEASURES} FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)"


@feature
def grouping_sets(x):
    return f"SELECT l_returnflag, l_linestatus, {_MEASURES} FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), (l_linestatus), ())"


@feature
def having(x):
    return f"SELECT l_suppkey, {_exact('l_extendedprice')} AS total FROM lineitem GROUP BY l_suppkey HAVING count(*) > 550"


@feature
def count_distinct(x):
    return "SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag"


@feature
def window_rank(x):
    w = "OVER (PARTITION BY o_orderstatus ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderkey)"
    p = "OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority)"
    return f"""SELECT o_orderkey, CAST(row_number() {w} AS BIGINT) AS rn, CAST(rank() {p} AS BIGINT) AS rk, CAST(dense_rank() {p} AS BIGINT) AS dr, CAST(ntile(4) {w} AS BIGINT) AS nt, round(percent_rank() {p}, 9) AS pr
FROM orders"""


@feature
def window_frame(x):
    w = "PARTITION BY user_id ORDER BY ts, event_id"
    d = "CAST(value AS DECIMAL(18,6))"
    return f"""SELECT event_id, CAST(sum({d}) OVER ({w} ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running, CAST(max({d}) OVER ({w} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE) AS recent,
count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS in_day FROM events"""


@feature
def window_lag_lead(x):
    w = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
    return f"SELECT event_id, lag(event_type) {w} AS prev, lead(event_type, 2, 'none') {w} AS next2 FROM events"


@feature
def window_first_last(x):
    w = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    return f"SELECT event_id, first_value(event_type) {w} AS first_type, last_value(event_type) {w} AS last_type, nth_value(event_id, 2) {w} AS second FROM events"


@feature
def union_all(x):
    return "SELECT c_nationkey AS k FROM customer UNION ALL SELECT s_nationkey FROM supplier"


@feature
def union(x):
    return "SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier"


@feature
def intersect(x):
    return "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier"


@feature
def except_(x):
    return "SELECT n_nationkey AS k FROM nation EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000"


@feature
def recursive_cte(x):
    return """WITH RECURSIVE reach(a, b, depth) AS (
SELECT n_nationkey, (n_nationkey * 3 + 1) % 25, 1 FROM nation UNION ALL SELECT a, (b * 3 + 1) % 25, depth + 1 FROM reach WHERE depth < 4)
SELECT a, b, min(depth) AS depth FROM reach GROUP BY a, b"""


@feature
def string(x):
    return """SELECT c_custkey, upper(c_name) AS u, CAST(length(c_name) AS BIGINT) AS n, substr(c_name, 1, 8) AS head, replace(c_name, '#', '-') AS dashed, lpad(CAST(c_custkey AS VARCHAR(10)), 6, '0') AS padded, concat(c_mktsegment, '/', c_name) AS joined FROM customer""".replace("VARCHAR(10)", x.string)


@feature
def date(x):
    return f"SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS y, CAST(month(o_orderdate) AS BIGINT) AS m, CAST(date_trunc('month', o_orderdate) AS DATE) AS first_day, {x.days('DATE ' + chr(39) + '2001-01-01' + chr(39), 'CAST(o_orderdate AS DATE)')} AS age FROM orders"


@feature
def math(x):
    return "SELECT p_partkey, round(sqrt(p_retailprice), 6) AS r, p_size % 7 AS m, abs(p_size - 25) AS d, CAST(floor(p_retailprice / 10) AS BIGINT) AS f, greatest(p_size, 20) AS g, sign(p_size - 25) AS s FROM part".replace("sign(p_size - 25)", "CAST(sign(p_size - 25) AS DOUBLE)")


@feature
def array(x):
    parts = "split(p_name, ' ')" if x.spark else "string_split(p_name, ' ')"
    size, first, has = ("size", "element_at({}, 1)", "array_contains({}, 'red')") if x.spark else ("len", "{}[1]", "list_contains({}, 'red')")
    return f"SELECT p_partkey, CAST({size}({parts}) AS BIGINT) AS n, {first.format(parts)} AS head, {has.format(parts)} AS red FROM part"


@feature
def map(x):  # noqa: A001
    made = "map('a', p_size, 'b', p_size * 2)" if x.spark else "MAP {'a': p_size, 'b': p_size * 2}"
    keys = "array_join(map_keys({}), ',')" if x.spark else "array_to_string(map_keys({}), ',')"
    value = "{}['b']" if x.spark else "element_at({}, 'b')[1]"
    return f"SELECT p_partkey, {value.format(made)} AS b, {keys.format(made)} AS keys FROM part"


@feature
def json(x):
    return f"SELECT event_id, {x.json_int('props', 'k')} AS k FROM events WHERE {x.json_int('props', 'k')} > 90"


@feature
def regex(x):
    match = "rlike" if x.spark else "SIMILAR TO"
    like = "c_name rlike '^Customer#0+1[0-9]*$'" if x.spark else "regexp_matches(c_name, '^Customer#0+1[0-9]*$')"
    return f"SELECT c_custkey, regexp_extract(c_name, '#0*([0-9]+)', 1) AS num FROM customer WHERE {like}" if match else ""


@feature
def percentile(x):
    f = "percentile(CAST(l_extendedprice AS DOUBLE), {})" if x.spark else "quantile_cont(l_extendedprice, {})"
    return f"SELECT l_returnflag, round({f.format(0.5)}, 6) AS p50, round({f.format(0.97)}, 6) AS p97 FROM lineitem GROUP BY l_returnflag"


@feature
def pivot(x):
    kinds = ["view", "signup", "purchase", "click", "error"]
    if x.spark:
        return f"SELECT * FROM (SELECT user_id, event_type FROM events) PIVOT (count(*) FOR event_type IN ({', '.join(f"'{k}' AS {k}_n" for k in kinds)}))"
    return "SELECT user_id, " + ", ".join(f"nullif(count(*) FILTER (WHERE event_type = '{k}'), 0) AS {k}_n" for k in kinds) + " FROM events GROUP BY user_id"


@feature
def case_coalesce(x):
    return "SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN 'owed' WHEN s_acctbal < 5000 THEN 'low' ELSE 'high' END AS band, coalesce(nullif(s_nationkey, 0), -1) AS k FROM supplier"


@feature
def distinct(x):
    return "SELECT DISTINCT c_mktsegment, c_nationkey FROM customer"


@feature
def correlated(x):
    return "SELECT s_suppkey, (SELECT count(*) FROM customer WHERE c_nationkey = s_nationkey) AS customers FROM supplier"


@feature
def tumbling(x):
    bucket = "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)" if x.spark else "date_trunc('hour', ts)"
    return f"SELECT {bucket} AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2"


@feature
def sample_approx(x):
    if not x.spark:
        return "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, true AS near FROM lineitem GROUP BY l_returnflag"
    # a sketch with a standard error of 1 % is ten of these from the bound, the default's 5 % only two; pairs are made distinct first, as a sketch a pair would be shuffled otherwise
    near = "abs(approx_count_distinct(l_partkey, 0.01) - count(l_partkey)) <= 0.1 * count(l_partkey)"
    return f"SELECT l_returnflag, count(l_partkey) AS parts, {near} AS near FROM (SELECT DISTINCT l_returnflag, l_partkey FROM lineitem) p GROUP BY l_returnflag"
