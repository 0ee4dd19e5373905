"""SQL for the checks: the applications view, draws, corruption and repair steps as CTEs.

Written from the rules, for a single-node SQL engine; nothing here runs on Spark.
"""

from __future__ import annotations

import zlib

from plumbline.sources.applications import APPLICATIONS, COLUMNS

MASK = 4294967295
NAMES = list(COLUMNS)
NUMBERS = [c for c, t in COLUMNS.items() if t != "string"]
TEXTS = [c for c, t in COLUMNS.items() if t == "string"]

def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join((APPLICATIONS_CTE, *ctes)) + "\n" + select


def half(key: str, first: int, second: int) -> str:
    k = f"CAST({key} AS BIGINT)"
    x = f"xor(({k} & {MASK}), (((({k} >> 32) & {MASK}) * 739982445) & {MASK}))"
    x = f"(({x} * {first}) & {MASK})"
    return f"((xor({x}, ({x} >> 15)) * {second}) & {MASK})"


APPLICATIONS_CTE = f"""applications AS (
  SELECT o.o_orderkey AS id, o.o_orderstatus AS status, o.o_orderpriority AS priority,
         c.c_mktsegment AS segment, r.r_name AS region, o.o_totalprice AS amount,
         l.total_qty, l.avg_qty, l.n_lines, l.avg_discount,
         CAST(1 + coalesce(l.returned, 0) AS INTEGER) AS category, o.o_orderdate AS ordered_at,
         {half('o.o_orderkey', 2146121005, 830770091)} AS ka, {half('o.o_orderkey', 830770091, 739982445)} AS kb
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS total_qty, avg(l_quantity) AS avg_qty,
                    CAST(count(*) AS INTEGER) AS n_lines, round(avg(l_discount), 6) AS avg_discount,
                    max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned
             FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def hash32(tag: str, seed: int = 42) -> str:
    salt = f"{seed}:{tag}"
    first, second = zlib.crc32(salt.encode()), zlib.crc32(salt[::-1].encode())
    x = f"(xor((xor(ka, {first}) * 2146121005), kb) & {MASK})"
    return f"((((xor({x}, ({x} >> 15)) + {second}) & {MASK}) * 830770091) & {MASK})"


def u(tag: str, seed: int = 42) -> str:
    return f"({hash32(tag, seed)} / CAST(4294967296 AS DOUBLE))"


def ticket(tag: str, seed: int = 42) -> str:
    return f"({hash32(tag + '|hi', seed)} * 2097152 + ({hash32(tag + '|lo', seed)} >> 11))"


def num(x: float) -> str:
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def text(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def span(lo: float, hi: float, draw: str) -> str:
    return f"({num(lo)} + {num(float(hi) - float(lo))} * {draw})"


def choose(values: list[str], draw: str) -> str:
    return f"list_extract([{', '.join(values)}], CAST(floor({draw} * {num(len(values))}) + 1 AS BIGINT))"


def step(name: str, source: str, changes: dict[str, str], columns=("id", *NAMES, "ka", "kb")) -> str:
    """A CTE that changes some columns of its source and keeps the others."""
    return f"{name} AS (SELECT " + ", ".join(
        f"{changes[c]} AS {c}" if c in changes else c for c in columns) + f" FROM {source})"


def missing(name: str, source: str, scenario: str) -> str:
    return step(name, source, {
        c: f"CASE WHEN row_number() OVER (ORDER BY {ticket('missing:' + c)}, id) <= {k} AND count(*) OVER () > {k} "
           f"THEN NULL ELSE {c} END"
        for c, k in APPLICATIONS.missing_counts[scenario].items()})


def outliers(name: str, source: str, scenario: str) -> str:
    params = APPLICATIONS.outliers[scenario]
    changes = {}
    for c, p in params.probability.items():
        v = f"CAST({c} AS DOUBLE)"
        scaled = f"{v} * {span(*params.multiplier[c], u(f'outlier:{c}:size'))}"
        if c in APPLICATIONS.extreme_values:
            extreme = choose([num(x) for x in APPLICATIONS.extreme_values[c]], u(f"outlier:{c}:pick"))
        elif c in APPLICATIONS.extreme_multiplier:
            extreme = f"{v} * {span(*APPLICATIONS.extreme_multiplier[c], u(f'outlier:{c}:pick'))}"
        else:
            extreme = scaled
        changes[c] = (f"CASE WHEN {u(f'outlier:{c}:hit')} < {num(p)} THEN CASE WHEN {u(f'outlier:{c}:extreme')} < "
                      f"{num(params.extreme_share)} THEN {extreme} ELSE {scaled} END ELSE {v} END")
    return step(name, source, changes)


def categories(name: str, source: str, scenario: str) -> str:
    p, columns = APPLICATIONS.category_errors[scenario]
    return step(name, source, {
        c: f"CASE WHEN {u(f'category:{c}:hit')} < {num(p)} THEN "
           f"{choose([text(v) for v in APPLICATIONS.invalid_values[c]], u(f'category:{c}:pick'))} ELSE {c} END"
        for c in columns})


def labels(name: str, source: str, scenario: str) -> str:
    p = APPLICATIONS.label_flip[scenario]
    return step(name, source, {"category": f"CASE WHEN {u('label:hit')} < {num(p)} THEN 3 - category ELSE category END"})


def relation(name: str, source: str, scenario: str) -> str:
    p = APPLICATIONS.relation[scenario]
    return step(name, source, {"total_qty": f"CASE WHEN {u('relation:hit')} < {num(p)} AND amount > 0 THEN "
                                            f"amount * {span(1.1, 2.0, u('relation:size'))} ELSE total_qty END"})


def conjoined(name: str, source: str, scenario: str) -> list[str]:
    return [missing(f"{name}_m", source, scenario), outliers(f"{name}_o", f"{name}_m", scenario),
            categories(f"{name}_c", f"{name}_o", scenario), relation(name, f"{name}_c", scenario)]


# --- suites ---------------------------------------------------------------------------

def literal(x) -> str:
    return text(x) if isinstance(x, str) else repr(x)


def bad_and_missing(e) -> tuple[str, str, str]:
    """Conditions: unexpected, missing, and whether percent counts all rows."""
    k = e.kwargs
    c = e.column
    if e.type == "expect_column_values_to_not_be_null":
        return f"{c} IS NULL", "false", "all"
    if e.type == "expect_column_values_to_be_in_set":
        return f"{c} NOT IN ({', '.join(literal(v) for v in k['value_set'])})", f"{c} IS NULL", ""
    if e.type == "expect_column_values_to_be_between":
        return f"NOT ({c} BETWEEN {k['min_value']} AND {k['max_value']})", f"{c} IS NULL", ""
    if e.type == "expect_column_pair_values_A_to_be_greater_than_B":
        a, b = k["column_A"], k["column_B"]
        op = ">=" if k.get("or_equal") else ">"
        both = f"({a} IS NULL AND {b} IS NULL)"
        return f"NOT {both} AND NOT coalesce({a} {op} {b}, false)", both, ""
    raise ValueError(e.type)


RESULT_COLUMNS = ("idx", "expectation_type", "column", "column_b", "severity", "success", "element_count",
                  "missing_count", "unexpected_count", "unexpected_percent", "observed_value")


def result_row(i, e, source, bad, gone, base, success=None, keys=()) -> str:
    column = text(e.column) if e.column else "CAST(NULL AS VARCHAR)"
    pair = text(f"{e.kwargs['column_A']},{e.kwargs['column_B']}") if "column_A" in e.kwargs else "CAST(NULL AS VARCHAR)"
    whole = "count(*)" if base == "all" else f"(count(*) - count(*) FILTER (WHERE {gone}))"
    picked = "".join(f"{k}, " for k in keys)
    grouped = f" GROUP BY {', '.join(keys)}" if keys else ""
    return (
        f"SELECT {picked}CAST({i} AS INTEGER) AS idx, {text(e.type)} AS expectation_type, {column} AS \"column\", {pair} AS column_b, "
        f"{text(e.severity)} AS severity, count(*) FILTER (WHERE {bad}) = 0 AS success, count(*) AS element_count, "
        f"count(*) FILTER (WHERE {gone}) AS missing_count, count(*) FILTER (WHERE {bad}) AS unexpected_count, "
        f"coalesce(count(*) FILTER (WHERE {bad}) / CAST(nullif({whole}, 0) AS DOUBLE), 0) * 100 AS unexpected_percent, "
        f"CAST(NULL AS VARCHAR) AS observed_value FROM {source}{grouped}"
    )


def suite_results(name: str, source: str, suite, keys=()) -> str:
    """CTE with the result rows of a suite of row rules."""
    rows = [result_row(i, e, source, *bad_and_missing(e), keys=keys) for i, e in enumerate(suite.expectations)]
    return f"{name} AS (" + "\n UNION ALL ".join(rows) + ")"


SHOW_RESULTS = ("idx, expectation_type, \"column\", column_b, severity, success, element_count, missing_count, "
                "unexpected_count, round(unexpected_percent, 6) AS unexpected_percent, observed_value")


# --- repair ---------------------------------------------------------------------------

def mode_of(c: str, source: str, where: str = "true") -> str:
    return (f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL AND {where} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")


def quantile(c: str, p: float, source: str, where: str = "true") -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), {p}) FROM {source} WHERE {where})"


def fill(name: str, source: str, columns, suite) -> str:
    changes = {}
    for c in columns:
        if c in NUMBERS:
            value = f"(SELECT avg({c}) FROM {source})" if c in APPLICATIONS.mean_filled else quantile(c, 0.5, source)
            changes[c] = f"coalesce(CAST({c} AS DOUBLE), {value})"
        else:
            allowed = suite.valid_values(c)
            inside = f"{c} IN ({', '.join(text(v) for v in allowed)})" if allowed else "true"
            last = text(allowed[0]) if allowed else "'UNKNOWN'"
            changes[c] = f"coalesce({c}, {mode_of(c, source, inside)}, {last})"
    return step(name, source, changes)


def cap(name: str, source: str, columns, flag: str = "true", tag: str = "cap", keep=("id", *NAMES, "ka", "kb")) -> list[str]:
    """Two CTEs: statistics per column, then the capped table."""
    stats = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_q3" for c in columns)
    bounds = ", ".join(f"CASE WHEN {c}_q3 > {c}_q1 THEN {c}_q3 + 1.5 * ({c}_q3 - {c}_q1) END AS {c}_ub" for c in columns)
    high = {c: f"(CAST({c} AS DOUBLE) > {c}_ub AND {flag})" for c in columns}
    normal = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.75) FILTER (WHERE NOT {high[c]}) AS {c}_lo, "
        f"quantile_cont(CAST({c} AS DOUBLE), 0.95) FILTER (WHERE NOT {high[c]}) AS {c}_hi" for c in columns)
    changes = {
        c: f"CASE WHEN {c}_ub IS NOT NULL AND {high[c]} THEN CASE WHEN {c}_lo IS NULL THEN {c}_ub WHEN {c}_lo = {c}_hi "
           f"THEN least({c}_ub, {c}_hi) ELSE {c}_lo + ({c}_hi - {c}_lo) * {u(f'{tag}:{c}')} END ELSE CAST({c} AS DOUBLE) END"
        for c in columns}
    return [
        f"{name}_b AS (SELECT {bounds} FROM (SELECT {stats} FROM {source}))",
        f"{name}_n AS (SELECT {normal} FROM {source}, {name}_b)",
        step(name, f"{source}, {name}_b, {name}_n", changes, keep),
    ]


def fix_categories(name: str, source: str, columns, suite) -> str:
    changes = {}
    for c in columns:
        inside = f"{c} IN ({', '.join(text(v) for v in suite.valid_values(c))})"
        changes[c] = (f"CASE WHEN {c} IS NOT NULL AND NOT {inside} THEN "
                      f"coalesce({mode_of(c, source, inside)}, {text(suite.valid_values(c)[0])}) ELSE {c} END")
    return step(name, source, changes)


def fix_pair(name: str, source: str) -> str:
    return step(name, source, {"amount": f"CASE WHEN amount < total_qty THEN total_qty * {span(10, 50, u('pair'))} ELSE amount END"})


def fix_range(name: str, source: str) -> str:
    lo, hi = APPLICATIONS.age_range
    c = APPLICATIONS.age
    return step(name, source, {c: f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN coalesce("
                                  f"{quantile(c, 0.5, source, f'{c} BETWEEN {lo} AND {hi}')}, {c}) ELSE {c} END"})


NOT_NULL_COLUMNS = ("status", "priority", "segment", "region", "amount", "total_qty")
BETWEEN_COLUMNS = ("amount", "total_qty", "avg_qty", "n_lines", "avg_discount")
IN_SET_COLUMNS = ("status", "priority", "segment", "region")


def basic_repair(name: str, source: str, suite) -> list[str]:
    """All of the deterministic repairs, for a table in which every rule of the shipped suite but
    the target's fails."""
    return [
        fill(f"{name}_1", source, NOT_NULL_COLUMNS, suite),
        *cap(f"{name}_2", f"{name}_1", BETWEEN_COLUMNS),
        fix_categories(f"{name}_3", f"{name}_2", IN_SET_COLUMNS, suite),
        fix_pair(f"{name}_4", f"{name}_3"),
        fix_range(name, f"{name}_4"),
    ]


def shown(source: str, digits: int | None = None, columns=("id", *NAMES)) -> str:
    """Row-level output: numbers as doubles, rounded where the arithmetic involves averages."""
    def one(c):
        if c == "id" or c in TEXTS:
            return c
        v = f"CAST({c} AS DOUBLE)"
        # the average discount is given to six places, fewer would round halves
        places = 6 if c == "avg_discount" else digits
        return f"round({v}, {places}) AS {c}" if digits is not None else f"{v} AS {c}"
    return "SELECT " + ", ".join(one(c) for c in columns) + f" FROM {source}"
