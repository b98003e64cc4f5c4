"""The registered queries again as plain DuckDB SQL, for the side-by-side check.

They use plain windows and set operations throughout: independent of how the operators are built, and
fine at the small scale the check runs at.
"""

from __future__ import annotations

from retentia.plans import bindings as b
from retentia.plans.customer360 import CUTOFF, SERVICE_START, SERVICES
from retentia.functions.hashing import HASH_BITS

ORACLE: dict[str, str] = {}

_KINDS = list(SERVICES.items())

C360 = f"""
hist AS (
  SELECT o_custkey, min(o_orderdate) AS first_dt, max(o_orderdate) AS last_dt, count(*) AS n_orders,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total_charges
  FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF} 00:00:00' GROUP BY o_custkey),
svc AS (
  SELECT o.o_custkey, {', '.join(f"max(CASE WHEN p_type = '{k}' THEN 1 ELSE 0 END) AS {n}" for n, k in _KINDS)}
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  WHERE o.o_orderdate >= TIMESTAMP '{SERVICE_START} 00:00:00' AND o.o_orderdate < TIMESTAMP '{CUTOFF} 00:00:00'
  GROUP BY o.o_custkey),
fut AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '{CUTOFF} 00:00:00'),
c360 AS (
  SELECT c.c_custkey AS customer_id, c.c_mktsegment AS segment, r.r_name AS region,
         CASE WHEN h.n_orders < 7 THEN 'Month-to-Month' WHEN h.n_orders < 10 THEN 'One Year' ELSE 'Two Year' END AS contract,
         CASE WHEN c.c_acctbal < 0 THEN 'Mailed Check' WHEN c.c_acctbal < 5000 THEN 'Bank Withdrawal' ELSE 'Credit Card' END AS payment_method,
         CASE WHEN s.o_custkey IS NULL THEN 'No' ELSE 'Yes' END AS internet_service,
         CASE WHEN s.o_custkey IS NULL THEN NULL WHEN svc_economy = 1 THEN 'Fiber Optic' WHEN svc_small = 1 THEN 'Cable' ELSE 'DSL' END AS internet_type,
         {', '.join(f"CASE WHEN {n} = 1 THEN 'Yes' WHEN {n} = 0 THEN 'No' END AS {n}" for n, _ in _KINDS)},
         CAST(floor(datediff('day', h.first_dt, TIMESTAMP '{CUTOFF} 00:00:00') / 30.0) AS INTEGER) AS tenure_in_months,
         CAST(datediff('day', h.last_dt, TIMESTAMP '{CUTOFF} 00:00:00') AS INTEGER) AS recency_days,
         CAST(h.n_orders AS INTEGER) AS n_orders,
         CAST(h.total_charges AS DOUBLE) AS total_charges,
         CAST(h.total_charges AS DOUBLE) / greatest(CAST(floor(datediff('day', h.first_dt, TIMESTAMP '{CUTOFF} 00:00:00') / 30.0) AS INTEGER), 1) AS monthly_charge,
         CASE WHEN f.o_custkey IS NULL THEN 'Yes' ELSE 'No' END AS churn_label
  FROM customer c JOIN hist h ON c.c_custkey = h.o_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN svc s ON s.o_custkey = c.c_custkey LEFT JOIN fut f ON f.o_custkey = c.c_custkey),
scored AS (
  SELECT *, CASE WHEN churn_label = 'Yes' THEN 1 ELSE 0 END AS churn,
         least(recency_days / CAST(400.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS score,
         CASE WHEN least(recency_days / CAST(400.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) >= 0.5 THEN 1 ELSE 0 END AS prediction,
         CAST(1.0 AS DOUBLE) - least(n_orders / CAST(20.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) AS score_2,
         CASE WHEN CAST(1.0 AS DOUBLE) - least(n_orders / CAST(20.0 AS DOUBLE), CAST(1.0 AS DOUBLE)) >= 0.5 THEN 1 ELSE 0 END AS prediction_2
  FROM c360)"""


def oracle(name: str, sql: str, *ctes: str, base: bool = False) -> None:
    parts = ([C360] if base else []) + list(ctes)
    ORACLE[name] = ("WITH " + ",\n".join(p.strip() for p in parts) + "\n" if parts else "") + sql.strip()


def hashed(seed: int, stream: str, key: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', '{seed}', '{stream}', CAST({key} AS VARCHAR))), 1, {HASH_BITS // 4}) AS BIGINT)"


def uniform(seed: int, stream: str, key: str) -> str:
    return f"(CAST({hashed(seed, stream, key)} AS DOUBLE) / {float(1 << HASH_BITS)!r}::DOUBLE)"


def unpivoted(source: str, columns, cast: str, extra: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {extra}'{c}' AS \"column\", CAST({c} AS {cast}) AS value FROM {source}" for c in columns)


_all = ", ".join
SVC = list(SERVICES)

# ---- source table and contracts ---------------------------------------------------------------------

oracle(
    "customer_base",
    f"""SELECT customer_id, segment, region, contract, payment_method, internet_service, internet_type, {_all(SVC)},
        tenure_in_months, recency_days, n_orders, total_charges, monthly_charge,
        churn_label FROM c360""",
    base=True,
)


def _contract_rules(contract, raw_text: bool = False) -> list[tuple[str, str, str]]:
    rules = []
    for f in contract.fields:
        c = f.name
        typed = f"TRY_CAST({c} AS {f.type})" if raw_text else c
        if raw_text and f.type != "string":
            rules.append(("type", c, f"{c} IS NOT NULL AND {typed} IS NULL"))
        elif f.type != "string":
            rules.append(("type", c, "FALSE"))
        if not f.nullable:
            rules.append(("not_null", c, f"{c} IS NULL"))
        if f.allowed:
            rules.append(("allowed", c, f"{c} NOT IN ({_all(repr(a) for a in f.allowed)})"))
        if f.low is not None:
            rules.append(("min", c, f"{typed} < {f.low}"))
        if f.high is not None:
            rules.append(("max", c, f"{typed} > {f.high}"))
    return rules


def _violations(source: str, contract, raw_text: bool = False) -> str:
    parts = [
        f"SELECT '{rule}' AS rule, '{c}' AS \"column\", count(*) FILTER (WHERE {bad}) AS n_violations FROM {source}"
        for rule, c, bad in _contract_rules(contract, raw_text)
    ]
    parts += [
        f"SELECT 'unique' AS rule, '{f.name}' AS \"column\", count({f.name}) - count(DISTINCT {f.name}) AS n_violations FROM {source}"
        for f in contract.fields
        if f.unique
    ]
    return " UNION ALL ".join(parts)


def _error_text(contract) -> str:
    return "concat_ws(',', " + _all(f"CASE WHEN {bad} THEN '{rule}:{c}' END" for rule, c, bad in _contract_rules(contract)) + ")"


def _any_error(contract) -> str:
    return " OR ".join(f"coalesce({bad}, FALSE)" for _, _, bad in _contract_rules(contract))


oracle("contract_violations", _violations("orders", b.ORDERS_CONTRACT))
oracle(
    "contract_quarantine",
    f"SELECT c_custkey, {_error_text(b.CUSTOMER_CONTRACT)} AS errors FROM customer WHERE {_any_error(b.CUSTOMER_CONTRACT)}",
)
oracle("contract_clean_rows", f"SELECT * FROM customer WHERE NOT ({_any_error(b.CUSTOMER_CONTRACT)})")
oracle(
    "contract_coercion",
    """SELECT * FROM (VALUES ('type', 'p_size', 0), ('not_null', 'p_size', 0), ('type', 'p_brand', 0), ('not_null', 'p_brand', 0),
         ('min', 'p_type', 0), ('not_null', 'p_type', 0)) AS zero(rule, "column", n_violations)
       UNION ALL SELECT 'min', 'p_size', count(*) FILTER (WHERE p_size < 5) FROM part
       UNION ALL SELECT 'min', 'p_brand', count(*) FILTER (WHERE CAST(split_part(p_brand, '#', 2) AS BIGINT) < 5) FROM part
       UNION ALL SELECT 'type', 'p_type', count(*) FILTER (WHERE TRY_CAST(p_type AS BIGINT) IS NULL) FROM part""",
)
oracle(
    "coerce_fractions",
    """WITH t AS (SELECT l_linenumber AS n, l_suppkey % 3 AS d, l_extendedprice AS p, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
       c AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE n < 2) AS low, count(*) FILTER (WHERE d <> 0) AS tiny, count(*) FILTER (WHERE d = 0 AND n < 2) AS tiny_low,
         count(*) FILTER (WHERE p <> floor(p)) AS price, count(*) FILTER (WHERE p = floor(p) AND p < 2) AS price_low FROM t)
       SELECT rule, "column", n_violations FROM c, LATERAL (VALUES ('type', 'zero', 0), ('not_null', 'zero', 0), ('min', 'zero', low), ('type', 'tiny', tiny), ('not_null', 'tiny', 0),
         ('min', 'tiny', tiny_low), ('type', 'price', price), ('not_null', 'price', 0), ('min', 'price', price_low),
         ('type', 'exponent', n_rows), ('not_null', 'exponent', 0), ('min', 'exponent', 0)) v(rule, "column", n_violations)""",
)
oracle(
    "contract_duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
oracle(
    "scoring_request_errors",
    f"""SELECT customer_id, CAST(CASE WHEN errors = '' THEN 0 ELSE len(string_split(errors, ',')) END AS INTEGER) AS n_errors, errors
        FROM (SELECT customer_id, {_error_text(b.SCORING_CONTRACT)} AS errors FROM scored)""",
    base=True,
)
oracle(
    "unknown_values",
    "SELECT c_custkey, count(*) AS n_rows FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL) GROUP BY c_custkey",
)
oracle("known_values", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL ORDER BY p_brand")

# ---- profiling --------------------------------------------------------------------------------------

oracle("profile_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
oracle(
    "profile_missing",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, round(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 6) AS pct_missing FROM scored"
        for c in ["customer_id", *b.TEXT, *SVC, *b.NUMERIC, "churn_label"]
    )
    + ") WHERE n_missing > 0",
    base=True,
)
oracle(
    "profile_nunique",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM orders"
        for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
    ),
)
oracle(
    "profile_constant",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\" FROM wide HAVING count(DISTINCT {c}) = 1" for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "quarter", "country"]
    ),
    "wide AS (SELECT *, 'Q3' AS quarter, 'US' AS country FROM orders)",
)
oracle(
    "profile_duplicates",
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)",
)
oracle(
    "profile_duplicate_keys",
    "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem",
)
oracle(
    "profile_describe",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min,
            round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,
            round(max({c}), 4) AS max FROM lineitem"""
        for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    ),
)
oracle(
    "median_by_class",
    " UNION ALL ".join(
        f"SELECT churn, '{c}' AS \"column\", round(median(CAST({c} AS DOUBLE)), 4) AS median FROM scored GROUP BY churn" for c in b.NUMERIC
    ),
    base=True,
)


def _histogram(source: str, columns, bins: int, by: str = "") -> str:
    keys = f'{by + ", " if by else ""}"column"'
    rows = unpivoted(source, columns, "DOUBLE", f"{by}, " if by else "")
    return f"""rows AS ({rows}),
    spans AS (SELECT {keys}, min(value) AS lo, (max(value) - min(value)) / {bins} AS width, count(*) AS total FROM rows GROUP BY {keys}),
    binned AS (SELECT {keys}, CAST(least(floor((value - lo) / width), {bins - 1}) AS BIGINT) AS bin, lo, width, total
               FROM rows JOIN spans USING ({keys}))"""


oracle(
    "profile_histogram",
    """SELECT "column", bin, round(lo + bin * width, 6) AS lower, round(lo + (bin + 1) * width, 6) AS upper, count(*) AS n
       FROM binned GROUP BY "column", bin, lo, width""",
    _histogram("lineitem", ["l_quantity", "l_extendedprice"], 30),
)
oracle(
    "histogram_by_class",
    """SELECT churn, "column", bin, round(lo + bin * width, 4) AS lower, round(lo + (bin + 1) * width, 4) AS upper, count(*) AS n,
              round(count(*) / (total * width), 8) AS density
       FROM binned GROUP BY churn, "column", bin, lo, width, total""",
    _histogram("scored", ["tenure_in_months", "monthly_charge"], 40, "churn"),
    base=True,
)
oracle(
    "profile_corr",
    " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 6) AS r FROM scored" for x in b.NUMERIC for y in b.NUMERIC),
    base=True,
)
oracle(
    "value_counts",
    """SELECT internet_type AS value, count(*) AS n, round(count(*) / (SELECT count(internet_type) FROM scored), 6) AS share
       FROM scored WHERE internet_type IS NOT NULL GROUP BY internet_type""",
    base=True,
)
oracle(
    "value_counts_many",
    f"""SELECT "column", value, count(*) AS n FROM ({unpivoted('scored', b.TEXT, 'VARCHAR')}) WHERE value IS NOT NULL GROUP BY ALL""",
    base=True,
)
oracle(
    "class_balance",
    """SELECT count(churn) AS n, CAST(sum(churn) AS BIGINT) AS n_pos, round(sum(churn) / count(churn) * 100, 6) AS pct_pos,
              round((count(churn) - sum(churn)) / sum(churn), 6) AS neg_per_pos FROM scored""",
    base=True,
)
oracle(
    "churn_rate_by_category",
    """SELECT internet_type AS value, count(*) AS n, round(avg(churn) * 100, 6) AS churn_rate FROM scored
       WHERE internet_type IS NOT NULL GROUP BY internet_type""",
    base=True,
)
oracle(
    "churn_rate_ordinal",
    """SELECT k.value, CAST(k.pos AS BIGINT) AS pos, n, churn_rate
       FROM (VALUES (0, 'Month-to-Month'), (1, 'One Year'), (2, 'Two Year'), (3, 'Three Year')) AS k(pos, value)
       LEFT JOIN (SELECT contract, count(*) AS n, round(avg(churn) * 100, 6) AS churn_rate FROM scored GROUP BY contract) t ON t.contract = k.value
       ORDER BY pos""",
    base=True,
)
oracle(
    "service_churn",
    " UNION ALL ".join(
        f"SELECT '{s}' AS service, {s} AS state, count(*) AS n, round(avg(churn) * 100, 6) AS churn_rate FROM scored WHERE {s} IN ('Yes', 'No') GROUP BY {s}"
        for s in SVC
    ),
    base=True,
)
oracle(
    "top_reasons",
    "SELECT props AS value, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY props ORDER BY n DESC, value LIMIT 10",
)
oracle(
    "value_domains",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(min(CAST({c} AS DOUBLE)), 6) AS low, round(max(CAST({c} AS DOUBLE)), 6) AS high FROM scored" for c in b.NUMERIC
    ),
    base=True,
)
_ERA = "TIMESTAMP '1998-01-01 00:00:00'"
oracle(
    "out_of_domain",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} < (SELECT min({c}) FROM orders WHERE o_orderdate < {_ERA})) AS n_below,
            count(*) FILTER (WHERE {c} > (SELECT max({c}) FROM orders WHERE o_orderdate < {_ERA})) AS n_above
            FROM orders WHERE o_orderdate >= {_ERA}"""
        for c in ["o_totalprice", "o_custkey"]
    ),
)
oracle("preview_head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5")
oracle("preview_tail", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5")

# ---- features and consistency -----------------------------------------------------------------------

_COUNT_YES = " + ".join(f"CASE WHEN {s} = 'Yes' THEN 1 ELSE 0 END" for s in SVC)
oracle(
    "feature_table",
    f"""SELECT customer_id, segment, region, contract, payment_method, internet_service, internet_type, {_all(SVC)}, tenure_in_months, n_orders,
        total_charges, monthly_charge, churn AS churn_label,
        CASE WHEN tenure_in_months < {b.FEATURES.new_customer_tenure} THEN 1 ELSE 0 END AS is_new_customer,
        {_COUNT_YES} AS num_extra_services FROM scored""",
    base=True,
)
oracle(
    "fill_missing_levels",
    """SELECT coalesce(internet_type, 'Missing') AS internet_type, coalesce(svc_economy, 'Missing') AS svc_economy, count(*) AS n
       FROM scored GROUP BY 1, 2""",
    base=True,
)
_NO_NET = "internet_service = 'No'"
oracle(
    "consistency_repair",
    f"""SELECT customer_id, CASE WHEN {_NO_NET} THEN NULL ELSE internet_type END AS internet_type,
        {_all(f"CASE WHEN {_NO_NET} THEN 'No' ELSE {s} END AS {s}" for s in SVC)},
        CASE WHEN svc_economy = 'Yes' AND n_orders < 9 THEN 9 ELSE n_orders END AS n_orders,
        CASE WHEN monthly_charge < 20000 THEN 20000.0::DOUBLE ELSE monthly_charge END AS monthly_charge FROM scored""",
    base=True,
)
oracle(
    "inconsistent_rows",
    f"""SELECT customer_id FROM scored WHERE monthly_charge < 20000 OR coalesce(svc_economy = 'Yes' AND n_orders < 9, FALSE)
        OR ({_NO_NET} AND (internet_type IS NOT NULL OR {" OR ".join(f"coalesce({s}, '') <> 'No'" for s in SVC)}))""",
    base=True,
)
oracle(
    "determined_fields",
    f"""SELECT customer_id, CASE WHEN {_NO_NET} THEN '{",".join(sorted(["internet_type", "under_30", *SVC]))}' ELSE 'under_30' END AS determined
        FROM scored""",
    base=True,
)
oracle("sentinel_to_null", "SELECT internet_type, count(*) AS n FROM scored GROUP BY internet_type", base=True)

# ---- sampling and drifted batches -------------------------------------------------------------------


def _split(source: str, label: str, key: str) -> str:
    return f"""sizes AS (SELECT {label} AS cls, count(*) AS n FROM {source} GROUP BY 1),
    shares AS (SELECT cls, n, sum(n) OVER () AS total, CAST(sum(n) OVER () - ceil(CAST(sum(n) OVER () AS DOUBLE) * 0.2::DOUBLE) AS BIGINT) AS want FROM sizes),
    floors AS (SELECT *, CAST(n * want AS DOUBLE) / total AS share FROM shares),
    quotas AS (SELECT cls, n, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, cls) <= want - sum(floor(share)) OVER ()
                      THEN 1 ELSE 0 END AS n_train FROM floors),
    ranked AS (SELECT {key}, {label} AS cls, row_number() OVER (PARTITION BY {label} ORDER BY {hashed(42, 'split', key)}, {key}) AS rn FROM {source})"""


oracle(
    "stratified_split",
    "SELECT customer_id, cls AS churn, CASE WHEN rn <= n - n_train THEN 1 ELSE 0 END AS is_test FROM ranked JOIN quotas USING (cls)",
    _split("scored", "churn", "customer_id"),
    base=True,
)
oracle(
    "split_events",
    """SELECT cls AS event_type, CASE WHEN rn <= n - n_train THEN 1 ELSE 0 END AS is_test, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum
       FROM ranked JOIN quotas USING (cls) GROUP BY 1, 2""",
    _split("events", "event_type", "event_id"),
)
oracle(
    "stratified_folds",
    f"""SELECT customer_id, churn, CAST((rn - 1) * 5 // n AS INTEGER) AS fold FROM (
        SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY {hashed(42, 'fold', 'customer_id')}, customer_id) AS rn,
               count(*) OVER (PARTITION BY churn) AS n FROM scored)""",
    base=True,
)


def _bootstrap(source: str, key: str, n: str, seed: int) -> str:
    return f"""indexed AS (SELECT {key}, row_number() OVER (ORDER BY {hashed(0, 'row', key)}, {key}) - 1 AS row_index FROM {source}),
    drawn AS (SELECT i AS draw, {hashed(seed, 'draw', 'i')} % (SELECT count(*) FROM {source}) AS row_index FROM range({n}) t(i)),
    boot AS (SELECT draw, {key} FROM drawn JOIN indexed USING (row_index))"""


oracle("bootstrap_batch", "SELECT draw, customer_id FROM boot", _bootstrap("scored", "customer_id", "500", 42), base=True)
oracle(
    "bootstrap_lineitem_orders",
    "SELECT times, count(*) AS n_orders FROM (SELECT l_orderkey, count(*) AS times FROM boot GROUP BY 1) GROUP BY times",
    _bootstrap("lineitem", "l_orderkey", "(SELECT count(*) FROM orders)", 7),
)
oracle("bootstrap_repeated_keys", "SELECT draw, l_orderkey, 1 AS known FROM boot", _bootstrap("lineitem", "l_orderkey", "2000", 11))
oracle(
    "numeric_shift",
    """SELECT customer_id, round(mc + (monthly_charge - mc) * (1.0::DOUBLE + 0.75::DOUBLE * 0.4::DOUBLE) + 0.75::DOUBLE * 1500, 4) AS monthly_charge,
       round(greatest(mt + (tenure_in_months - mt) * 1.0::DOUBLE + 0.75::DOUBLE * -60, 0), 6) AS tenure_in_months
       FROM scored, (SELECT avg(monthly_charge) AS mc, avg(CAST(tenure_in_months AS DOUBLE)) AS mt FROM scored)""",
    base=True,
)


def _reweight(name: str, source: str, column: str, target: dict[str, float], intensities: str, kind: str = "VARCHAR") -> str:
    rows = ", ".join(f"(CAST('{k}' AS {kind}), {v}::DOUBLE)" for k, v in target.items())
    return f"""{name}_now AS (SELECT {column} AS level, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1),
    {name}_target(level, target) AS (VALUES {rows}),
    {name}_levels AS (SELECT coalesce(a.level, t.level) AS level, coalesce(n, 0) / (SELECT CAST(sum(n) AS DOUBLE) FROM {name}_now) AS now, coalesce(target, 0.0::DOUBLE) AS target
        FROM {name}_now a FULL JOIN {name}_target t ON a.level = t.level),
    {name}_mix AS (SELECT CAST(intensity AS DOUBLE) AS intensity, level, (1.0::DOUBLE - CAST(intensity AS DOUBLE)) * now + CAST(intensity AS DOUBLE) * target AS w
        FROM {name}_levels, (SELECT unnest({intensities}) AS intensity)),
    {name}_edges AS (SELECT intensity, level, sum(w) OVER (PARTITION BY intensity ORDER BY level) / sum(w) OVER (PARTITION BY intensity) AS hi,
        coalesce(sum(w) OVER (PARTITION BY intensity ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(w) OVER (PARTITION BY intensity) AS lo
        FROM {name}_mix)"""


_CONTRACT_TARGET = dict(b.BATCHES.specs["contract"].target)
_PAYMENT_TARGET = dict(b.BATCHES.specs["payment_method"].target)
oracle(
    "categorical_reweight",
    """SELECT customer_id, c.level AS contract, t.level AS internet_type FROM draws
       JOIN ct_edges c ON uc >= c.lo AND uc < c.hi JOIN it_edges t ON ut >= t.lo AND ut < t.hi""",
    _reweight("ct", "scored", "contract", _CONTRACT_TARGET, "[0.5]"),
    _reweight("it", "scored", "internet_type", {"DSL": 0.5, "Satellite": 0.5}, "[0.5]"),
    f"draws AS (SELECT customer_id, {uniform(42, 'reweight:contract', 'customer_id')} AS uc, {uniform(42, 'reweight:internet_type', 'customer_id')} AS ut FROM scored)",
    base=True,
)

oracle(
    "reweight_many_levels",
    "SELECT o_orderkey, level AS o_custkey FROM draws JOIN ck_edges ON u >= lo AND u < hi",
    _reweight("ck", "orders", "o_custkey", {"7": 0.25, "100": 0.5, "99999999": 0.25}, "[0.5]", "BIGINT"),
    f"draws AS (SELECT o_orderkey, {uniform(42, 'reweight:o_custkey', 'o_orderkey')} AS u FROM orders)",
)

def _sweep(source: str, extra: str = "") -> list[str]:
    """CTEs ending in ``batches``: the drifted batches drawn from ``source``; ``extra`` lists more columns that stay."""
    return [
        _bootstrap(source, "customer_id", "500", 42),
        f"base AS (SELECT boot.draw, s.* FROM boot JOIN {source} s USING (customer_id))",
        _reweight("ct", "base", "contract", _CONTRACT_TARGET, str(list(b.BATCHES.intensities))),
        _reweight("pm", "base", "payment_method", _PAYMENT_TARGET, str(list(b.BATCHES.intensities))),
        f"""means AS (SELECT avg(monthly_charge) AS mc, avg(CAST(tenure_in_months AS DOUBLE)) AS mt FROM base),
    steps AS (SELECT CAST(unnest({list(b.BATCHES.intensities)}) AS DOUBLE) AS intensity),
    draws AS (SELECT draw, {uniform(42, 'reweight:contract', 'draw')} AS uc, {uniform(42, 'reweight:payment_method', 'draw')} AS up FROM base),
    batches AS (
      SELECT printf('batch_intensity_%.2f', s.intensity) AS batch_name, s.intensity, base.draw, customer_id, segment, region, internet_service, internet_type,
             c.level AS contract, p.level AS payment_method, recency_days, n_orders, total_charges, {extra}
             greatest(mt + (tenure_in_months - mt) * 1.0::DOUBLE + s.intensity * -8, 0) AS tenure_in_months,
             mc + (monthly_charge - mc) * (1.0::DOUBLE + s.intensity * 0.5::DOUBLE) + s.intensity * 5000 AS monthly_charge
      FROM base JOIN draws USING (draw), steps s, means, ct_edges c, pm_edges p
      WHERE c.intensity = s.intensity AND uc >= c.lo AND uc < c.hi AND p.intensity = s.intensity AND up >= p.lo AND up < p.hi)""",
    ]


_SWEEP = _sweep("scored")
oracle(
    "drift_sweep",
    """SELECT batch_name, intensity, draw, customer_id, contract, payment_method, round(tenure_in_months, 6) AS tenure_in_months,
       round(monthly_charge, 4) AS monthly_charge FROM batches""",
    *_SWEEP,
    base=True,
)

oracle(
    "dataset_sides",
    """SELECT CASE WHEN rn <= n - n_train THEN 'test' ELSE 'train' END AS side, cls AS churn_label, count(*) AS n, CAST(sum(customer_id) AS BIGINT) AS id_sum
       FROM ranked JOIN quotas USING (cls) GROUP BY 1, 2""",
    _split("scored", "churn", "customer_id"),
    base=True,
)

def _codes(column: str, name: str) -> str:
    return f"""{name}_level AS (SELECT {column} AS lv, count(*) AS n, sum(y) AS s FROM o GROUP BY ALL), {name}_fold AS (SELECT {column} AS lv, f, count(*) AS n, sum(y) AS s FROM o GROUP BY ALL),
    {name} AS (
      SELECT o_orderkey, round((l.s + 20.0::DOUBLE * w.s / w.n) / (l.n + 20), 9) AS score,
        round((l.s - p.s + 20.0::DOUBLE * (w.s - x.s) / (w.n - x.n)) / (l.n - p.n + 20), 9) AS code
      FROM o JOIN {name}_level l ON l.lv = {column} JOIN {name}_fold p ON p.lv = {column} AND p.f = o.f JOIN folds x ON x.f = o.f, whole w)"""


oracle(
    "target_codes",
    """SELECT o_orderkey, c.code AS customer_code, p.code AS priority_code, c.score AS customer_score, p.score AS priority_score
       FROM customer_codes c JOIN priority_codes p USING (o_orderkey)""",
    f"""o AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y,
         {hashed(42, 'encode', 'o_orderkey')} % 5 AS f FROM orders),
    whole AS (SELECT count(*) AS n, sum(y) AS s FROM o), folds AS (SELECT f, count(*) AS n, sum(y) AS s FROM o GROUP BY f)""",
    _codes("customer", "customer_codes"),
    _codes("o_orderpriority", "priority_codes"),
)
oracle(
    "level_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n FROM documents" for c in ("lang", "source", "text")),
)

# ---- drift ------------------------------------------------------------------------------------------


def _drift(ref: str, cur: str, batch: str, numeric, text, ref_where: str = "TRUE", cur_where: str = "TRUE") -> str:
    """CTEs ending in ``cols(batch, column, kind, method, score, drifted)`` by the distance tests."""
    parts = []
    if numeric:
        cur_rows = " UNION ALL ".join(f"SELECT {batch} AS batch, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {cur} WHERE {cur_where}" for c in numeric)
        ref_rows = " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {ref} WHERE {ref_where}" for c in numeric)
        parts.append(f"""nref AS ({ref_rows}), ncur AS ({cur_rows}),
        nr AS (SELECT col, v, count(*) AS nr FROM nref WHERE v IS NOT NULL GROUP BY ALL), nc AS (SELECT batch, col, v, count(*) AS nc FROM ncur WHERE v IS NOT NULL GROUP BY ALL),
        nt AS (SELECT col, sum(nr) AS tr, count(*) AS nd FROM nr GROUP BY col), nct AS (SELECT batch, col, sum(nc) AS tc FROM nc GROUP BY ALL),
        grid AS (SELECT batch, col, v FROM nr JOIN (SELECT DISTINCT batch, col FROM nc) USING (col) UNION SELECT batch, col, v FROM nc),
        joined AS (SELECT g.*, coalesce(nr, 0) AS nr, coalesce(nc, 0) AS nc FROM grid g LEFT JOIN nr USING (col, v) LEFT JOIN nc USING (batch, col, v)),
        cum AS (SELECT *, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc, lead(v) OVER w AS nv FROM joined WINDOW w AS (PARTITION BY batch, col ORDER BY v)),
        sd AS (SELECT col, stddev_pop(v) AS s FROM nref GROUP BY col),
        nstat AS (SELECT batch, col, max(abs(cr / CAST(tr AS DOUBLE) - cc / CAST(tc AS DOUBLE))) AS ks, any_value(nd) AS nd, any_value(tr) AS n_ref, any_value(tc) AS n_cur,
            sum(abs(cr / CAST(tr AS DOUBLE) - cc / CAST(tc AS DOUBLE)) * (coalesce(nv, v) - v)) AS w1,
            sum(CASE WHEN nr > 0 THEN nr / CAST(tr AS DOUBLE) * log2(2 * (nr / CAST(tr AS DOUBLE)) / (nr / CAST(tr AS DOUBLE) + nc / CAST(tc AS DOUBLE))) ELSE 0 END
              + CASE WHEN nc > 0 THEN nc / CAST(tc AS DOUBLE) * log2(2 * (nc / CAST(tc AS DOUBLE)) / (nr / CAST(tr AS DOUBLE) + nc / CAST(tc AS DOUBLE))) ELSE 0 END) AS js
            FROM cum JOIN nt USING (col) JOIN nct USING (batch, col) GROUP BY batch, col),
        ncols AS (SELECT batch, col AS "column", 'numeric' AS kind, 'wasserstein' AS method,
            w1 / greatest(s, 0.001) AS score FROM nstat JOIN sd USING (col))""")
    if text:
        cur_rows = " UNION ALL ".join(f"SELECT {batch} AS batch, '{c}' AS col, {c} AS v FROM {cur} WHERE {cur_where}" for c in text)
        ref_rows = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS v FROM {ref} WHERE {ref_where}" for c in text)
        parts.append(f"""tref AS ({ref_rows}), tcur AS ({cur_rows}),
        lr AS (SELECT col, v, count(*) / CAST(sum(count(*)) OVER (PARTITION BY col) AS DOUBLE) AS p, count(*) AS nr FROM tref WHERE v IS NOT NULL GROUP BY col, v),
        lc AS (SELECT batch, col, v, count(*) / CAST(sum(count(*)) OVER (PARTITION BY batch, col) AS DOUBLE) AS q, count(*) AS nc FROM tcur WHERE v IS NOT NULL GROUP BY batch, col, v),
        lgrid AS (SELECT batch, col, v FROM lr JOIN (SELECT DISTINCT batch, col FROM lc) USING (col) UNION SELECT batch, col, v FROM lc),
        lv AS (SELECT g.*, coalesce(p, 0) AS p, coalesce(q, 0) AS q, coalesce(nr, 0) AS nr, coalesce(nc, 0) AS nc FROM lgrid g LEFT JOIN lr USING (col, v) LEFT JOIN lc USING (batch, col, v)),
        lstat AS (SELECT batch, col, count(*) AS n_levels, count(*) FILTER (WHERE nr > 0) AS n_ref_values,
            sqrt(greatest(0.5 * sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END), 0)) AS js
            FROM lv GROUP BY batch, col),
        tcols AS (SELECT batch, col AS "column", 'text' AS kind, 'jensen_shannon' AS method, js AS score FROM lstat)""")
    sides = [s for s, on in (("ncols", numeric), ("tcols", text)) if on]
    parts.append("cols AS (" + " UNION ALL ".join(f"SELECT *, score >= 0.1 AS drifted FROM {s}" for s in sides) + ")")
    return ",\n".join(parts)


def _era_drift(numeric, text) -> str:
    return _drift("orders", "orders", "'current'", numeric, text, f"o_orderdate < {_ERA}", f"o_orderdate >= {_ERA}")


oracle(
    "drift_wasserstein",
    'SELECT col AS "column", CAST(n_ref AS BIGINT) AS n_ref, CAST(n_cur AS BIGINT) AS n_cur, round(w1 / s, 6) AS score FROM nstat JOIN sd USING (col)',
    _era_drift(["o_totalprice", "o_custkey"], []),
)
oracle("drift_ks", 'SELECT col AS "column", round(ks, 6) AS ks FROM nstat', _era_drift(["o_totalprice", "o_custkey"], []))
oracle(
    "drift_jensen_shannon",
    'SELECT col AS "column", n_levels, round(js, 6) AS jensen_shannon FROM lstat',
    _era_drift([], ["o_orderpriority", "o_orderstatus"]),
)
oracle(
    "drift_chi2",
    """SELECT col AS "column", count(*) FILTER (WHERE nr > 0) AS n_ref_values,
       round(sum((nc - p * tc) * (nc - p * tc) / (p * tc)), 6) AS chi2
       FROM lv JOIN (SELECT batch, col, CAST(sum(nc) AS DOUBLE) AS tc FROM lc GROUP BY batch, col) USING (batch, col) GROUP BY col""",
    _era_drift([], ["o_orderpriority", "o_orderstatus"]),
)
oracle(
    "drift_z",
    """SELECT 'l_linestatus' AS "column", round(abs(p - q) / sqrt(pool * (1 - pool) * (1 / n1 + 1 / n2)), 6) AS z FROM (
       SELECT x1 / n1 AS p, x2 / n2 AS q, (x1 + x2) / (n1 + n2) AS pool, n1, n2 FROM (
       SELECT CAST(count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-01-01') AS DOUBLE) AS n1, CAST(count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-01-01') AS DOUBLE) AS n2,
              count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1998-01-01' AND l_linestatus = top) AS x1,
              count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_linestatus = top) AS x2
       FROM lineitem, (SELECT max(l_linestatus) AS top FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01')))""",
)
oracle(
    "drift_columns",
    'SELECT batch, "column", kind, method, round(score, 6) AS score, 0.1::DOUBLE AS threshold, drifted FROM cols',
    _era_drift(["o_totalprice", "o_custkey"], ["o_orderpriority", "o_orderstatus"]),
)
oracle(
    "drift_many_batches",
    'SELECT batch, "column", kind, method, round(score, 6) AS score, 0.1::DOUBLE AS threshold, drifted FROM cols',
    _drift(
        "orders", "orders", "printf('group %03d', o_custkey % 500)", ["o_totalprice", "o_custkey"], ["o_orderpriority", "o_orderstatus"],
        f"o_orderdate < {_ERA}", f"o_orderdate >= {_ERA}",
    ),
)
oracle(
    "drift_ks_exact",
    """SELECT "column", 'ks_exact' AS method, round(p, 6) AS score, p < 0.05 AS drifted FROM (
       WITH RECURSIVE sides AS MATERIALIZED (
         SELECT col, least(n_ref, n_cur)::BIGINT AS a, greatest(n_ref, n_cur)::BIGINT AS b, round(ks * n_ref * n_cur)::BIGINT AS h FROM nstat),
       walk AS (
         SELECT col, a, b, h, 0::BIGINT AS s, list_transform(range(a + 1), lambda i: CASE WHEN i = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) AS v FROM sides
         UNION ALL
         SELECT col, a, b, h, s + 1, list_transform(range(a + 1), lambda i: CASE
             WHEN i > s + 1 OR s + 1 - i > b THEN 0.0::DOUBLE
             WHEN abs(i * (a + b) - (s + 1) * a) >= h THEN 1.0::DOUBLE
             ELSE (i * coalesce(v[i], 0.0::DOUBLE) + (s + 1 - i) * v[i + 1]) / (s + 1) END)
         FROM walk WHERE s < a + b)
       SELECT col AS "column", v[a + 1] AS p FROM walk WHERE s = a + b)""",
    _drift("scored", "scored", "'current'", b.NUMERIC, [], "tenure_in_months < 55", "tenure_in_months >= 55"),
    base=True,
)
oracle(
    "drift_p_values",
    """SELECT "column", kind, method, round(p, 6) AS score, 0.05::DOUBLE AS threshold, p < 0.05 AS drifted FROM (
       SELECT col AS "column", 'numeric' AS kind, 'ks' AS method, CASE WHEN t < 0.2 THEN 1.0::DOUBLE ELSE least(greatest(
           2 * list_sum(list_transform(range(1, 101), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2.0::DOUBLE * k * k * t * t))), 0), 1) END AS p
       FROM (SELECT col, ks * sqrt(CAST(n_ref AS DOUBLE) * CAST(n_cur AS DOUBLE) / CAST(n_ref + n_cur AS DOUBLE)) AS t FROM nstat)
       UNION ALL
       SELECT col, 'text', 'chi_square', CASE WHEN new_level THEN 0.0::DOUBLE ELSE
           1 - list_sum(list_transform(range(0, 5000), lambda i: exp((a + i) * ln(h) - h - lgamma(a + i + 1)))) END
       FROM (SELECT col, bool_or(p = 0 AND nc > 0) AS new_level, (count(*) - 1) / 2.0::DOUBLE AS a,
                    greatest(sum(CASE WHEN p > 0 THEN (nc - p * tc) * (nc - p * tc) / (p * tc) ELSE 0 END) / 2, 1e-300::DOUBLE) AS h
             FROM lv JOIN (SELECT batch, col, CAST(sum(nc) AS DOUBLE) AS tc FROM lc GROUP BY batch, col) USING (batch, col) GROUP BY col))""",
    _drift("scored", "scored", "'current'", b.NUMERIC, b.TEXT, "tenure_in_months < 55", "tenure_in_months >= 55"),
    base=True,
)
oracle(
    "drift_summary",
    """SELECT batch AS batch_name, count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted_columns,
       round(avg(CASE WHEN drifted THEN 1 ELSE 0 END), 6) AS dataset_drift_share, avg(CASE WHEN drifted THEN 1 ELSE 0 END) >= 0.5 AS dataset_drifted
       FROM cols GROUP BY batch""",
    *_SWEEP,
    _drift("scored", "batches", "batch_name", b.NUMERIC, b.TEXT),
    base=True,
)
oracle(
    "retrain_decision",
    """SELECT observed_value > 0 AS should_retrain, 'dataset_drift_share' AS trigger_metric, round(observed_value, 6) AS observed_value, 0.0::DOUBLE AS threshold,
       batch AS triggering_batch FROM (SELECT batch, avg(CASE WHEN drifted THEN 1 ELSE 0 END) AS observed_value FROM cols GROUP BY batch)
       ORDER BY observed_value DESC, batch LIMIT 1""",
    _drift("scored", "scored", "region", b.NUMERIC, ["segment", "contract", "payment_method", "internet_type"]),
    base=True,
)

# ---- preparation ------------------------------------------------------------------------------------

_SCALED = ["tenure_in_months", "monthly_charge", "n_orders"]
oracle(
    "impute_scale",
    "SELECT customer_id, "
    + _all(f"round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled), 6) AS {c}" for c in _SCALED)
    + " FROM filled",
    "partial AS (SELECT customer_id, CAST(tenure_in_months AS DOUBLE) AS tenure_in_months, monthly_charge, CASE WHEN internet_type IS NOT NULL THEN CAST(n_orders AS DOUBLE) END AS n_orders FROM scored)",
    "filled AS (SELECT customer_id, " + _all(f"coalesce({c}, (SELECT median({c}) FROM partial)) AS {c}" for c in _SCALED) + " FROM partial)",
    base=True,
)
oracle(
    "onehot_long",
    """SELECT customer_id, 'categorical__contract_' || contract AS feature FROM scored
       UNION ALL SELECT customer_id, 'categorical__internet_type_' || coalesce(internet_type, 'Missing') FROM scored""",
    base=True,
)
oracle(
    "class_weights",
    "SELECT churn, count(*) AS n, round((SELECT count(*) FROM scored) / CAST(2 * count(*) AS DOUBLE), 6) AS weight FROM scored GROUP BY churn",
    base=True,
)

# ---- metrics ----------------------------------------------------------------------------------------


def _metrics(source: str, label: str, pred: str, score: str, group: str = "'all'", x: str = "") -> str:
    """CTE ``<x>m(grp, n, n_pos, six metrics)``; the AUC comes from mid-ranks, not from running counts."""
    return f"""{x}pts AS (SELECT {group} AS grp, {label} AS y, {pred} AS yhat, CAST({score} AS DOUBLE) AS s FROM {source}),
    {x}mid AS (SELECT *, rank() OVER (PARTITION BY grp ORDER BY s) + (count(*) OVER (PARTITION BY grp, s) - 1) / 2.0::DOUBLE AS mr FROM {x}pts),
    {x}steps AS (SELECT grp, s, sum(y) AS tp, count(*) AS cnt FROM {x}pts GROUP BY grp, s),
    {x}curve AS (SELECT grp, tp, sum(tp) OVER w AS ctp, sum(cnt) OVER w AS cc, sum(tp) OVER (PARTITION BY grp) AS p FROM {x}steps
              WINDOW w AS (PARTITION BY grp ORDER BY s DESC)),
    {x}ap AS (SELECT grp, sum(tp / CAST(p AS DOUBLE) * (ctp / CAST(cc AS DOUBLE))) AS ap FROM {x}curve GROUP BY grp),
    {x}conf AS (SELECT grp, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_pos, CAST(sum(y * yhat) AS DOUBLE) AS tp, sum((1 - y) * yhat) AS fp, sum(y * (1 - yhat)) AS fn,
             sum(CASE WHEN y = 1 THEN mr ELSE 0 END) AS rs FROM {x}mid GROUP BY grp),
    {x}m AS (SELECT grp, n, n_pos,
          round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1,
          round((n - fp - fn) / n, 6) AS accuracy,
          round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
          round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS recall,
          round((rs - n_pos * (n_pos + 1) / 2.0::DOUBLE) / (CAST(n_pos AS DOUBLE) * (n - n_pos)), 6) AS roc_auc,
          round(ap, 6) AS pr_auc,
          CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1_exact FROM {x}conf JOIN {x}ap USING (grp) WHERE n_pos > 0 AND n_pos < n)"""


_SIX = "f1, accuracy, precision, recall, roc_auc, pr_auc"
_DOCS = "docs AS (SELECT n_chars, quality, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS prediction FROM documents JOIN labels USING (doc_id))"
oracle("classification_metrics", f"SELECT n, n_pos, {_SIX} FROM m", _metrics("scored", "churn", "prediction", "score"), base=True)
oracle("roc_auc", "SELECT n, roc_auc FROM m", _DOCS, _metrics("docs", "quality", "prediction", "n_chars"))
oracle("average_precision", "SELECT n_pos, pr_auc FROM m", _DOCS, _metrics("docs", "quality", "prediction", "n_chars"))
oracle(
    "metrics_at_scale",
    f"SELECT grp AS l_linestatus, n, n_pos, {_SIX} FROM m",
    "items AS (SELECT l_linestatus, l_extendedprice, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned, CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END AS prediction FROM lineitem)",
    _metrics("items", "returned", "prediction", "l_extendedprice", "l_linestatus"),
)


def _segments(score: str, pred: str, name: str) -> str:
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS sc, {c} AS sv, churn, {pred} AS pred, {score} AS sco FROM scored WHERE {c} IS NOT NULL" for c in b.SEGMENTS
    ) + f" UNION ALL SELECT 'overall', 'overall', churn, {pred}, {score} FROM scored)"


def _two(first: tuple[str, str], second: tuple[str, str]) -> list[str]:
    """CTEs ``champ`` and ``chall`` (sc, sv, f1x, metrics) for champion and challenger score columns."""
    out = []
    for name, (score, pred) in (("champ", first), ("chall", second)):
        out += [_segments(score, pred, f"{name}_rows"), _metrics(f"{name}_rows", "churn", "pred", "sco", "sc || '=' || sv", f"{name}_")]
    return out


oracle(
    "segment_metrics",
    f"SELECT split_part(grp, '=', 1) AS segment_column, split_part(grp, '=', 2) AS segment_value, n, n_pos, {_SIX}, grp AS segment FROM m WHERE grp <> 'overall=overall'",
    _segments("score", "prediction", "seg_rows"),
    _metrics("seg_rows", "churn", "pred", "sco", "sc || '=' || sv"),
    base=True,
)
_S1, _S2 = ("score", "prediction"), ("score_2", "prediction_2")
_DELTAS = "deltas AS (SELECT a.grp, a.f1_exact AS cv, c.f1_exact AS nv, c.f1_exact - a.f1_exact AS delta FROM champ_m a JOIN chall_m c USING (grp))"
oracle(
    "segment_regressions",
    """SELECT split_part(grp, '=', 1) AS segment_column, split_part(grp, '=', 2) AS segment_value, round(cv, 6) AS champion_value,
       round(nv, 6) AS challenger_value, round(delta, 6) AS delta FROM deltas WHERE grp <> 'overall=overall' AND delta < -0.03""",
    *_two(_S2, _S1),
    _DELTAS,
    base=True,
)


def _promotion(margin: float) -> str:
    return f"""SELECT margin >= {margin} AND bad = '' AS promote,
       CASE WHEN NOT margin >= {margin} THEN 'margin not reached' WHEN bad <> '' THEN 'segment regression' ELSE 'wins' END AS reason,
       round(margin, 6) AS aggregate_margin, CASE WHEN margin >= {margin} THEN bad ELSE '' END AS regressions,
       CASE WHEN margin >= {margin} THEN bad_deltas ELSE '' END AS regression_deltas
       FROM (SELECT max(CASE WHEN grp = 'overall=overall' THEN delta END) AS margin,
             coalesce(string_agg(CASE WHEN grp <> 'overall=overall' AND delta < -0.03 THEN grp END, ',' ORDER BY grp), '') AS bad,
             coalesce(string_agg(CASE WHEN grp <> 'overall=overall' AND delta < -0.03 THEN grp || ':' || printf('%.6f', delta) END, ',' ORDER BY grp), '') AS bad_deltas
             FROM deltas)"""


oracle("promotion_decision", _promotion(0.01), *_two(_S1, _S2), _DELTAS, base=True)
oracle("promotion_blocked", _promotion(-1.0), *_two(_S2, _S1), _DELTAS, base=True)
oracle(
    "model_ranking",
    f"""SELECT 'recency' AS family, {_SIX} FROM champ_m WHERE grp = 'overall=overall'
        UNION ALL SELECT 'volume', {_SIX} FROM chall_m WHERE grp = 'overall=overall' ORDER BY f1 DESC, family""",
    *_two(_S1, _S2),
    base=True,
)
oracle(
    "best_model",
    """SELECT * FROM (SELECT 'recency' AS family, accuracy, f1 FROM champ_m WHERE grp = 'overall=overall'
       UNION ALL SELECT 'volume', accuracy, f1 FROM chall_m WHERE grp = 'overall=overall') ORDER BY accuracy DESC, family LIMIT 1""",
    *_two(_S1, _S2),
    base=True,
)
oracle(
    "registry_writers",
    """SELECT r_name AS model_name, count(*) AS n_versions, count(*) AS n_numbers, count(*) AS latest, count(DISTINCT n_name) AS n_runs, count(*) AS n_moves,
       count(*) AS last_step FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
_K = "json_extract_string(props, '$.k')"
oracle(
    "latest_versions",
    f"SELECT user_id AS model_name, max(CAST({_K} AS BIGINT)) AS latest FROM events WHERE event_type = 'signup' GROUP BY user_id",
)
oracle(
    "champion_lookup",
    f"""SELECT model_name, version FROM (SELECT user_id AS model_name, {_K} AS version, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
        FROM events WHERE event_type = 'purchase') WHERE rn = 1""",
)
oracle(
    "run_metrics_map",
    """SELECT region, 'challenger_n' AS metric, round(CAST(count(*) AS DOUBLE), 6) AS metric_value FROM scored GROUP BY region
       UNION ALL SELECT region, 'challenger_rate', round(avg(prediction), 6) FROM scored GROUP BY region""",
    base=True,
)
oracle(
    "segment_names",
    """SELECT 'contract=' || contract AS segment, round(avg(churn), 6) AS share, printf('batch_intensity_%.2f', round(avg(churn), 6)) AS batch_name
       FROM scored GROUP BY contract""",
    base=True,
)

# ---- value and explanation --------------------------------------------------------------------------

_VALUED = """term AS (SELECT *, CASE contract WHEN 'Month-to-Month' THEN 1 WHEN 'One Year' THEN 12 WHEN 'Two Year' THEN 24 END AS term FROM scored),
months AS (SELECT *, CASE WHEN term <= 1 THEN term WHEN tenure_in_months % term = 0 THEN term ELSE term - tenure_in_months % term END AS remaining_months FROM term),
risk AS (SELECT *, monthly_charge * remaining_months AS value_at_risk FROM months),
loss AS (SELECT *, score * value_at_risk AS expected_loss FROM risk),
valued AS (SELECT *, expected_loss - 50000 AS net_benefit, expected_loss - 50000 > 0 AS worth_retaining FROM loss)"""
oracle(
    "retention_value",
    """SELECT customer_id, remaining_months, value_at_risk, expected_loss, net_benefit, worth_retaining FROM valued""",
    _VALUED,
    base=True,
)
oracle(
    "retention_portfolio",
    """SELECT contract, count(*) AS n_customers, count(*) FILTER (WHERE worth_retaining) AS n_worth, round(sum(value_at_risk), 2) AS value_at_risk,
       round(sum(expected_loss), 2) AS expected_loss, round(coalesce(sum(net_benefit) FILTER (WHERE worth_retaining), 0), 2) AS net_benefit
       FROM valued GROUP BY contract""",
    _VALUED,
    base=True,
)
oracle(
    "retention_targets",
    "SELECT customer_id, contract, net_benefit FROM valued WHERE worth_retaining ORDER BY net_benefit DESC, customer_id LIMIT 100",
    _VALUED,
    base=True,
)
_WEIGHTS = {"tenure_in_months": -0.03, "recency_days": 0.004, "n_orders": -0.08, "monthly_charge": 0.00002}
_LONG = "contrib AS (" + " UNION ALL ".join(
    f"SELECT customer_id, '{c}' AS f, {w!r}::DOUBLE * ({c} - (SELECT avg(CAST({c} AS DOUBLE)) FROM scored)) AS v FROM scored" for c, w in _WEIGHTS.items()
) + ")"
oracle("linear_score_explain", "SELECT customer_id, 'numeric__' || f AS feature, round(v, 6) AS contribution FROM contrib", _LONG, base=True)
oracle(
    "top_attributions",
    """SELECT customer_id, CAST(rn AS INTEGER) AS rank, f AS feature, round(v, 6) AS value, CASE WHEN v > 0 THEN 'raises risk' ELSE 'lowers risk' END AS direction
       FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY abs(v) DESC, 'numeric__' || f) AS rn FROM contrib) WHERE rn <= 2""",
    _LONG,
    base=True,
)
oracle(
    "readable_features",
    """SELECT feature, label, count(*) AS n FROM (
       SELECT 'categorical__contract_' || contract AS feature, 'contract: ' || contract AS label FROM scored
       UNION ALL SELECT 'categorical__internet_type_' || coalesce(internet_type, 'Missing'), 'internet_type: ' || coalesce(internet_type, 'Missing') FROM scored
       UNION ALL SELECT 'categorical__internet_service_' || internet_service, 'internet_service: ' || internet_service FROM scored) GROUP BY 1, 2""",
    base=True,
)

# ---- files, reports, registry and encoded frames ----------------------------------------------------

oracle("csv_customers", f"SELECT {_all(b.CUSTOMER360_CONTRACT.names)} FROM scored", base=True)


def _differences(name: str, declared) -> str:
    listed = _all(f"('{c}')" for c in declared)
    return f"""SELECT '{name}' AS "table", 'missing' AS kind, c AS "column" FROM (VALUES {listed}) v(c) WHERE c NOT IN (SELECT column_name FROM (DESCRIBE {name}))
        UNION ALL SELECT '{name}', 'unexpected', column_name FROM (DESCRIBE {name}) WHERE column_name NOT IN (SELECT c FROM (VALUES {listed}) v(c))"""


oracle("column_differences", f"{_differences('orders', b.ORDERS_CONTRACT.names)} UNION ALL {_differences('customer', [*b.CUSTOMER_CONTRACT.names, 'c_segment_code', 'c_since'])}")
oracle("renamed_requests", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
oracle(
    "report_round_trip",
    "SELECT region, round(avg(churn) * 100, 6) AS churn_rate, CAST(2 AS BIGINT) AS n_reads, CAST(2 AS INTEGER) AS n_absent FROM scored GROUP BY region",
    base=True,
)
oracle("value_list", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL")
oracle("stored_parameters", "SELECT c_mktsegment AS name, count(*) AS value FROM customer GROUP BY 1 UNION ALL SELECT 'fixed', 7")
oracle("drift_detail_files", "SELECT o_orderstatus AS batch, o_orderpriority AS \"column\", count(*) AS score FROM orders GROUP BY ALL")
oracle(
    "run_log",
    """SELECT 'balances' AS experiment, 'nation ' || c_nationkey AS run_name, count(*) AS n, round(avg(c_acctbal), 4) AS balance, CAST(1 AS INTEGER) AS n_metrics
       FROM customer GROUP BY c_nationkey""",
)


def _roles(name: str, text) -> str:
    wide = " UNION ALL ".join(f"SELECT '{name}', '{c}', 'wide text' FROM {name} HAVING count(DISTINCT {c}) > 100" for c in text)
    return f"""SELECT '{name}' AS "table", column_name AS "column", CASE WHEN column_type = 'VARCHAR' THEN 'text' ELSE 'numeric' END AS role
        FROM (DESCRIBE {name}) WHERE column_type IN ('VARCHAR', 'BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT') UNION ALL {wide}"""


oracle(
    "column_roles",
    " UNION ALL ".join(
        [_roles("documents", ["text", "lang", "source"]), _roles("orders", ["o_orderstatus", "o_orderpriority"]), _roles("part", ["p_name", "p_brand", "p_type"])]
    ),
)
oracle("under_30_flags", "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'unknown' WHEN c_custkey % 60 < 30 THEN 'Yes' ELSE 'No' END AS under_30 FROM customer")
oracle(
    "zipped_names",
    " UNION ALL ".join(f"SELECT customer_id, '{c}' AS name, CAST({c} AS DOUBLE) AS value FROM scored" for c in b.NUMERIC),
    base=True,
)
oracle(
    "fold_scores",
    """WITH f AS (SELECT o_custkey % 20 AS trial, o_orderkey % 5 AS fold, avg(o_totalprice) AS f1 FROM orders GROUP BY ALL),
       m AS (SELECT trial, avg(f1) AS mean_f1 FROM f GROUP BY trial)
       SELECT trial, round(mean_f1, 6) AS mean_f1, row_number() OVER (ORDER BY mean_f1 DESC, trial) = 1 AS best FROM m""",
)
oracle(
    "encoded_customers",
    " UNION ALL ".join(
        [f"SELECT customer_id, 'numeric__{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM scored WHERE {c} <> 0" for c in b.NUMERIC]
        + [f"SELECT customer_id, 'categorical__{c}_' || coalesce({c}, 'Missing'), 1.0::DOUBLE FROM scored" for c in b.TEXT]
    ),
    base=True,
)

# ---- models -----------------------------------------------------------------------------------------

_SIDES = _split("scored", "churn", "customer_id")
_TRAIN = f"""train AS (SELECT s.*, CASE WHEN tenure_in_months < 48 THEN 1 ELSE 0 END AS is_new_customer,
    {" + ".join(f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in SVC)} AS num_extra_services
    FROM scored s JOIN ranked r USING (customer_id) JOIN quotas q USING (cls) WHERE rn > n - n_train)"""
oracle(
    "model_selection",
    """SELECT family, n_test, n_positive, FALSE AS out_of_range, TRUE AS f1_fits, TRUE AS ranked
       FROM (VALUES ('logistic_regression'), ('boosted_trees'), ('boosted_trees_deep'), ('native_categories')) f(family),
       (SELECT count(*) AS n_test, CAST(sum(cls) AS BIGINT) AS n_positive FROM ranked JOIN quotas USING (cls) WHERE rn <= n - n_train)""",
    _SIDES,
    base=True,
)
_TRIAL = {name: uniform(42, f"trial:{name}", "trial") for name in ("n_estimators", "max_depth", "learning_rate")}
oracle(
    "cv_search",
    f"""SELECT CAST(trial AS BIGINT) AS trial, 2 + least(floor({_TRIAL["n_estimators"]} * 3), 2) AS n_estimators, 2 + least(floor({_TRIAL["max_depth"]} * 2), 1) AS max_depth,
       round(exp(ln(0.05::DOUBLE) + {_TRIAL["learning_rate"]} * (ln(0.3::DOUBLE) - ln(0.05::DOUBLE))), 9) AS learning_rate, TRUE AS f1_in_range, CAST(1 AS BIGINT) AS version
       FROM range(2) t(trial)""",
)
oracle(
    "promotion_flow",
    "SELECT CAST(step AS INTEGER) AS step, TRUE AS verdict_fits, TRUE AS reason_fits, CAST(2 AS BIGINT) AS latest, TRUE AS alias_fits FROM (VALUES (1), (2)) t(step)",
)
oracle(
    "score_batch",
    """SELECT customer_id, TRUE AS is_probability, TRUE AS class_fits, '1' AS model_version, remaining_months, value_at_risk,
       TRUE AS loss_fits, TRUE AS benefit_fits FROM valued""",
    _VALUED,
    base=True,
)
for _name in ("tree_explain", "linear_model_explain"):
    oracle(_name, "SELECT customer_id, TRUE AS adds_up, CAST(15 AS BIGINT) AS n_reasons, TRUE AS in_order FROM scored", base=True)
oracle(
    "monitoring_flow",
    """SELECT batch AS batch_name, CAST(right(batch, 4) AS DOUBLE) AS intensity, n_drifted_columns, round(share, 6) AS dataset_drift_share,
       CASE WHEN row_number() OVER (ORDER BY share DESC, batch) = 1 THEN share > 0.1 END AS should_retrain
       FROM (SELECT batch, count(*) FILTER (WHERE drifted) AS n_drifted_columns, avg(CASE WHEN drifted THEN 1 ELSE 0 END) AS share FROM cols GROUP BY batch)""",
    _SIDES,
    _TRAIN,
    *_sweep("train", _all([*SVC, "is_new_customer", "num_extra_services", ""]).rstrip(" ")),
    _drift(
        "train", "batches", "batch_name", ["tenure_in_months", "n_orders", "total_charges", "monthly_charge", "is_new_customer", "num_extra_services"], [*b.TEXT, *SVC]
    ),
    base=True,
)
oracle(
    "reference_without_label",
    "SELECT region, count(*) AS n, CAST(sum(num_extra_services) AS BIGINT) AS n_services, FALSE AS has_label FROM train GROUP BY region",
    _SIDES,
    _TRAIN,
    base=True,
)
