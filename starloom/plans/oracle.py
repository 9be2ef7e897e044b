"""Independent SQL oracle (DuckDB dialect) for the registered queries.

Written from the specification as plain SQL over the given tables: the shared
fixture SQL makes the raw survey, and everything after it (cleaning, star,
encoded view, reports) is ordinary SQL with window functions, so a mismatch
with the Spark side points at a real semantic difference.
"""

from __future__ import annotations

from starloom import spec as S
from starloom.sources.survey import derived_survey_sql_text

RAW = derived_survey_sql_text("orders")
RAW_YEAR = ("SELECT r.*, CAST(year(o.o_orderdate) AS INTEGER) AS DATA_YEAR "
            f"FROM ({RAW}) r JOIN orders o ON r.row_key = o.o_orderkey")

SURVEY_COLS = list(S.SELECTED_COLUMNS)


def _lst(vals) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in vals)


def _case(col: str, mapping: dict, otherwise: str | None = None) -> str:
    whens = " ".join(f"WHEN {_lst([k])} THEN {_lst([v])}" for k, v in mapping.items())
    tail = f" ELSE {otherwise}" if otherwise is not None else ""
    return f"CASE {col} {whens}{tail} END"


def with_ctes(ctes: list[tuple[str, str]], final: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{q}\n)" for n, q in ctes) + "\n" + final


# --- cleaning ---------------------------------------------------------------

def clean_sql(src: str = "raw", ordinal: bool = True, validate: bool = True,
              year: bool = False) -> str:
    """E1 over relation ``src`` (declared 1/2 binaries)."""
    keys = ["row_key"] + (["DATA_YEAR"] if year else [])
    conds = [f"{c} IS NOT NULL" for c in keys + SURVEY_COLS]
    conds.append(f"DIABETE3 IN ({_lst(S.TARGET_LABELS)})")
    conds += [f"{b} IN (1, 2)" for b in S.BINARY_COLUMNS]
    if ordinal:
        conds += [f"{c} IN ({_lst(d)})" for c, d in S.ORDINAL_DOMAINS.items()]
    sel = list(keys)
    for c in SURVEY_COLS:
        name = S.RENAME[c]
        if c == "DIABETE3":
            sel.append(f"{_case(c, S.TARGET_LABELS)} AS {name}")
        elif c in S.BINARY_COLUMNS:
            sel.append(f"CASE WHEN {c} = 1 THEN 'Yes' ELSE 'No' END AS {name}")
        elif c == "_BMI5":
            sel.append(f"{c} / 100.0 AS {name}")
        elif c == "SEX":
            sel.append(f"{_case(c, S.SEX_LABELS)} AS {name}")
        else:
            sel.append(f"{c} AS {name}")
    inner = f"SELECT {', '.join(sel)} FROM {src} WHERE " + " AND ".join(conds)
    if not validate:
        return inner
    return f"SELECT * FROM ({inner}) x WHERE {validation_predicate()}"


def validation_predicate() -> str:
    return " AND ".join(f"COALESCE({c} IN ({_lst(v)}), FALSE)"
                        for c, v in S.VALIDATION_DOMAINS.items())


def lenient_sql(src: str = "raw") -> str:
    """Raw -> final-format labels, nothing filtered, unmapped codes -> NULL."""
    sel = ["row_key"]
    for c in SURVEY_COLS:
        name = S.RENAME[c]
        if c == "DIABETE3":
            sel.append(f"{_case(c, S.TARGET_LABELS)} AS {name}")
        elif c in S.BINARY_COLUMNS:
            sel.append(f"CASE {c} WHEN 1 THEN 'Yes' WHEN 2 THEN 'No' END AS {name}")
        elif c == "_BMI5":
            sel.append(f"{c} / 100.0 AS {name}")
        elif c == "SEX":
            sel.append(f"{_case(c, S.SEX_LABELS)} AS {name}")
        else:
            sel.append(f"{c} AS {name}")
    return f"SELECT {', '.join(sel)} FROM {src}"


def base_ctes(year: bool = False, ordinal: bool = True, validate: bool = True):
    return [("raw", RAW_YEAR if year else RAW),
            ("clean", clean_sql("raw", ordinal, validate, year))]


# --- star -------------------------------------------------------------------

def dim_sql(d: S.DimSpec, clean: str = "clean") -> str:
    srcs = ", ".join(d.sources)
    outs = ", ".join(f"{s} AS {o}" for s, o in d.columns)
    return (f"SELECT CAST(row_number() OVER (ORDER BY first_seen) AS INTEGER) AS {d.key}, {outs} "
            f"FROM (SELECT {srcs}, min(row_key) AS first_seen FROM {clean} GROUP BY {srcs}) t")


def fact_sql(layout: S.StarLayout = S.MAIN_STAR, clean: str = "clean", prefix: str = "") -> str:
    meas = []
    for src, out, cast in layout.measures:
        ty = {"string": "VARCHAR", "double": "DOUBLE"}.get(cast or "", None)
        meas.append(f"CAST(c.{src} AS {ty}) AS {out}" if ty else f"c.{src} AS {out}")
    joins, keys = [], []
    for i, d in enumerate(layout.dims):
        on = " AND ".join(f"c.{s} IS NOT DISTINCT FROM d{i}.{o}" for s, o in d.columns)
        joins.append(f"LEFT JOIN {prefix}{d.table} d{i} ON {on}")
        keys.append(f"d{i}.{d.key}")
    return (f"SELECT CAST(row_number() OVER (ORDER BY c.row_key) AS BIGINT) AS {layout.record_key}, "
            f"{', '.join(meas)}, {', '.join(keys)} FROM {clean} c " + " ".join(joins))


def star_ctes(layout: S.StarLayout = S.MAIN_STAR, clean: str = "clean", prefix: str = ""):
    ctes = [(f"{prefix}{d.table}", dim_sql(d, clean)) for d in layout.dims]
    ctes.append((f"{prefix}{layout.fact_table}", fact_sql(layout, clean, prefix)))
    return ctes


def encoded_ctes():
    flag = lambda c: f"CAST({_case(c, S.FLAG_CODES)} AS INTEGER) AS {c}"
    ctes = []
    for d in S.MAIN_STAR.dims:
        cols = [d.key]
        for o in d.outputs:
            if o == "sex":
                cols.append(o)
            elif o in ("age_group", "education_level", "income_bracket"):
                cols.append(f"CAST({o} AS INTEGER) AS {o}")
            else:
                cols.append(flag(o))
        ctes.append((f"enc_{d.table}", f"SELECT {', '.join(cols)} FROM {d.table}"))
    ctes.append(("enc_fact", (
        "SELECT record_id, "
        f"CAST({_case('diabetes_status', S.STATUS_CODES)} AS INTEGER) AS diabetes_status, "
        "CAST(bmi_value AS DECIMAL(5,2)) AS bmi_value, "
        "CAST(mental_health_days AS INTEGER) AS mental_health_days, "
        "CAST(physical_health_days AS INTEGER) AS physical_health_days, "
        "CAST(general_health_score AS INTEGER) AS general_health_score, "
        + ", ".join(d.key for d in S.MAIN_STAR.dims) + " FROM fact_health_records")))
    return ctes


def view_select() -> str:
    alias = {"demographics": "d", "lifestyle": "l", "medical": "m", "healthcare": "h"}
    labels = [f"CASE {alias[role]}.{src} WHEN 0 THEN '{zero}' ELSE '{other}' END AS {out}"
              for out, (role, src, zero, other) in S.VIEW_FLAG_LABELS.items()]
    return (
        "SELECT f.record_id, f.diabetes_status, "
        f"{_case('f.diabetes_status', S.VIEW_STATUS_LABELS)} AS diabetes_label, "
        "f.bmi_value, f.mental_health_days, f.physical_health_days, f.general_health_score, "
        "d.sex, d.age_group, d.education_level, d.income_bracket, " + ", ".join(labels) +
        " FROM enc_fact f"
        " JOIN enc_dim_demographics d ON f.demographic_id = d.demographic_id"
        " JOIN enc_dim_lifestyle l ON f.lifestyle_id = l.lifestyle_id"
        " JOIN enc_dim_medical_conditions m ON f.medical_conditions_id = m.medical_conditions_id"
        " JOIN enc_dim_healthcare_access h ON f.healthcare_access_id = h.healthcare_access_id")


def table_counts_select(layout: S.StarLayout = S.MAIN_STAR, distinct_dims: bool = True,
                        col: str = "n") -> str:
    parts = [f"SELECT '{layout.fact_table}' AS table_name, count(*) AS {col} FROM {layout.fact_table}"]
    for d in layout.dims:
        agg = f"count(DISTINCT {d.key})" if distinct_dims else "count(*)"
        parts.append(f"SELECT '{d.table}' AS table_name, {agg} AS {col} FROM {d.table}")
    return " UNION ALL ".join(parts)


# --- reports ----------------------------------------------------------------

def step_predicates() -> list[tuple[str, str]]:
    steps = [("drop_any_null", " AND ".join(f"{c} IS NOT NULL" for c in ["row_key"] + SURVEY_COLS)),
             ("valid_target", f"COALESCE(DIABETE3 IN ({_lst(S.TARGET_LABELS)}), FALSE)")]
    steps += [(f"binary:{b}", f"COALESCE({b} IN (1, 2), FALSE)") for b in S.BINARY_COLUMNS]
    steps += [(f"ordinal:{c}", f"COALESCE({c} IN ({_lst(d)}), FALSE)")
              for c, d in S.ORDINAL_DOMAINS.items()]
    return steps


def step_deltas_sql() -> str:
    steps = step_predicates()
    running, aggs = [], ["count(*) AS c0"]
    for i, (_, p) in enumerate(steps, start=1):
        running.append(f"({p})")
        aggs.append(f"count(*) FILTER (WHERE {' AND '.join(running)}) AS c{i}")
    # validation on the recoded values: equivalent membership of the raw codes
    valid = [f"COALESCE(DIABETE3 IN ({_lst(S.TARGET_LABELS)}), FALSE)"]
    valid += [f"COALESCE({b} IN (1, 2), FALSE)" for b in S.BINARY_COLUMNS]
    valid += [f"COALESCE({c} IN ({_lst(d)}), FALSE)" for c, d in S.ORDINAL_DOMAINS.items()]
    aggs.append(f"count(*) FILTER (WHERE {' AND '.join(running + valid)}) AS c{len(steps) + 1}")
    names = [n for n, _ in steps] + ["validate"]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step_no, '{n}' AS step, c{i - 1} AS rows_before, c{i} AS rows_after, "
        f"c{i - 1} - c{i} AS removed FROM counts" for i, n in enumerate(names, start=1))
    return with_ctes([("raw", RAW), ("counts", f"SELECT {', '.join(aggs)} FROM raw")], rows)


def _mixed_raw(recodes: dict) -> str:
    cols = ", ".join(f"CAST({q} AS DOUBLE) AS {c}" for c, q in recodes.items())
    return f"SELECT * REPLACE ({cols}) FROM ({RAW}) r"


def _mixed_binary(modes: dict) -> list[tuple[str, str]]:
    """Filter per binary column under the modes the fixture was made for (None: no filter)."""
    codes = {b: modes.get(b, (1, 2)) for b in S.BINARY_COLUMNS}
    return [(b, "TRUE" if c is None else f"COALESCE({b} IN ({_lst(c)}), FALSE)") for b, c in codes.items()]


def inferred_step_deltas_sql(recodes: dict, modes: dict) -> str:
    steps = step_predicates()
    binary = dict(_mixed_binary(modes))
    steps = [(n, binary.get(n.removeprefix("binary:"), p) if n.startswith("binary:") else p) for n, p in steps]
    last = [p for _, p in steps] + (["FALSE"] if None in modes.values() else [])
    aggs = ["count(*) AS c0"] + [
        f"count(*) FILTER (WHERE {' AND '.join(f'({p})' for _, p in steps[:i])}) AS c{i}"
        for i in range(1, len(steps) + 1)]
    aggs.append(f"count(*) FILTER (WHERE {' AND '.join(f'({p})' for p in last)}) AS c{len(steps) + 1}")
    names = [n for n, _ in steps] + ["validate"]
    rows = " UNION ALL ".join(
        f"SELECT {i} AS step_no, '{n}' AS step, c{i - 1} AS rows_before, c{i} AS rows_after, "
        f"c{i - 1} - c{i} AS removed FROM counts" for i, n in enumerate(names, start=1))
    return with_ctes([("raw", _mixed_raw(recodes)), ("counts", f"SELECT {', '.join(aggs)} FROM raw")], rows)


def inferred_clean_sql(recodes: dict, modes: dict) -> str:
    """The cleaned rows before validation: labels by mode, an unpatterned column as text."""
    sel = ["row_key"]
    for c in SURVEY_COLS:
        name = S.RENAME[c]
        if c == "DIABETE3":
            sel.append(f"{_case(c, S.TARGET_LABELS)} AS {name}")
        elif c in S.BINARY_COLUMNS:
            mode = modes.get(c, (1, 2))
            sel.append(f"CASE WHEN {c} = 1 THEN 'Yes' ELSE 'No' END AS {name}" if mode is not None
                       else f"CAST({c} AS VARCHAR) AS {name}")
        elif c == "_BMI5":
            sel.append(f"{c} / 100.0 AS {name}")
        elif c == "SEX":
            sel.append(f"{_case(c, S.SEX_LABELS)} AS {name}")
        else:
            sel.append(f"{c} AS {name}")
    conds = [f"{c} IS NOT NULL" for c in ["row_key"] + SURVEY_COLS]
    conds += [f"DIABETE3 IN ({_lst(S.TARGET_LABELS)})"] + [p for _, p in _mixed_binary(modes)]
    conds += [f"{c} IN ({_lst(d)})" for c, d in S.ORDINAL_DOMAINS.items()]
    return with_ctes([("raw", _mixed_raw(recodes))], f"SELECT {', '.join(sel)} FROM raw WHERE {' AND '.join(conds)}")


def first_failure_ctes() -> list[tuple[str, str]]:
    rules = list(S.VALIDATION_DOMAINS.items())
    first = "CASE " + " ".join(
        f"WHEN NOT COALESCE({c} IN ({_lst(v)}), FALSE) THEN {i}"
        for i, (c, v) in enumerate(rules, start=1)) + " END"
    bad = "CASE rule_no " + " ".join(
        f"WHEN {i} THEN CAST({c} AS VARCHAR)" for i, (c, _) in enumerate(rules, start=1)) + " END"
    name = "CASE rule_no " + " ".join(
        f"WHEN {i} THEN '{c}'" for i, (c, _) in enumerate(rules, start=1)) + " END"
    return [("raw", RAW), ("lenient", lenient_sql("raw")),
            ("ranked", f"SELECT *, {first} AS rule_no FROM lenient"),
            ("charged", f"SELECT rule_no, {name} AS column_name, {bad} AS bad FROM ranked "
                        "WHERE rule_no IS NOT NULL")]


def incremental_star_ctes(layout: S.StarLayout = S.MAIN_STAR) -> list[tuple[str, str]]:
    """Star as loaded year by year: keys by (first year seen, first key that year)."""
    ctes = [("raw", RAW_YEAR), ("clean", clean_sql("raw", year=True))]
    for d in layout.dims:
        srcs = ", ".join(d.sources)
        outs = ", ".join(f"{s} AS {o}" for s, o in d.columns)
        ctes.append((f"{d.table}", (
            f"SELECT CAST(row_number() OVER (ORDER BY y, k) AS INTEGER) AS {d.key}, {outs} FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY {srcs} ORDER BY y) AS rn FROM ("
            f"SELECT {srcs}, DATA_YEAR AS y, min(row_key) AS k FROM clean GROUP BY {srcs}, DATA_YEAR"
            ") a) b WHERE rn = 1")))
    fact = fact_sql(layout, "clean").replace(
        "row_number() OVER (ORDER BY c.row_key)", "row_number() OVER (ORDER BY c.DATA_YEAR, c.row_key)")
    ctes.append((layout.fact_table, fact))
    return ctes


def correlation_select() -> str:
    """Pearson correlation of every pair of encoded clean columns, by the engine's own aggregate."""
    def code(c: str) -> str:
        name = S.RENAME[c]
        if c == "DIABETE3":
            return f"CASE {name} WHEN 'Healthy' THEN 0 WHEN 'Prediabetic' THEN 1 WHEN 'Diabetic' THEN 2 END"
        if c == "SEX":
            return f"CASE {name} WHEN 'Male' THEN 0 WHEN 'Female' THEN 1 END"
        return f"CASE {name} WHEN 'Yes' THEN 1 ELSE 0 END" if c in S.BINARY_COLUMNS else name
    coded = ", ".join(f"CAST({code(c)} AS DOUBLE) AS {S.RENAME[c]}" for c in SURVEY_COLS)
    names = [S.RENAME[c] for c in SURVEY_COLS]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) AS n, round(corr({a}, {b}), 7) AS r "
        f"FROM (SELECT {coded} FROM clean) e" for a, b in pairs)


def value_profile_by_step_sql() -> str:
    """Each raw value's count by the first cleaning step removing its row."""
    steps = step_predicates()
    valid = [f"COALESCE(DIABETE3 IN ({_lst(S.TARGET_LABELS)}), FALSE)"]
    valid += [f"COALESCE({b} IN (1, 2), FALSE)" for b in S.BINARY_COLUMNS]
    valid += [f"COALESCE({c} IN ({_lst(d)}), FALSE)" for c, d in S.ORDINAL_DOMAINS.items()]
    preds = [p for _, p in steps] + [" AND ".join(valid)]
    first = "CASE " + " ".join(f"WHEN NOT ({p}) THEN {i}" for i, p in enumerate(preds, start=1)) + " END"
    union = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value, removed_at_step FROM tagged"
        for c in S.SELECTED_COLUMNS)
    return with_ctes(
        [("raw", RAW), ("tagged", f"SELECT *, CAST({first} AS INTEGER) AS removed_at_step FROM raw")],
        f"SELECT column_name, value, removed_at_step, count(*) AS n FROM ({union}) u "
        "WHERE value IS NOT NULL GROUP BY column_name, value, removed_at_step")
