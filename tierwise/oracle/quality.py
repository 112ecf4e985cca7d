"""Oracle statements of the data-quality queries: one grouped SELECT per check."""

from __future__ import annotations

from collections.abc import Sequence

from tierwise.operators import quality as q
from tierwise.oracle import suites
from tierwise.oracle.relations import using

_CLOCKED = "SELECT *, now() AS ingested_at, now() AS processed_at FROM "
_SOURCES = {
    "taxi/bronze": ("bronze_trips", "SELECT *, now() AS ingested_at FROM bronze_trips"),
    "taxi/silver": ("silver_trips", _CLOCKED + "silver_trips"),
    "weather/bronze": ("bronze_weather", "SELECT *, now() AS ingested_at FROM bronze_weather"),
    "weather/silver": ("silver_weather", _CLOCKED + "silver_weather"),
}
_BATCH = {
    "taxi": "printf('%d_%02d', source_year, source_month)",
    "weather": "CAST(source_year AS VARCHAR)",
}
# Attribute columns are not part of the station days made from the base tables.
_ABSENT = tuple(c for c in suites.EXISTING["weather/bronze"].split() if c.endswith("_ATTRIBUTES"))


def _text(value) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value).upper()


def _judged(check: q.Check) -> tuple[str, str]:
    """Which rows a check judges, and which of those pass."""
    c = f'"{check.column}"'
    if check.kind == q.NOT_NULL:
        return "TRUE", f"{c} IS NOT NULL"
    if check.kind == q.BETWEEN:
        low = "TRUE" if check.low is None else f"{c} >= {check.low}"
        high = "TRUE" if check.high is None else f"{c} <= {check.high}"
        return f"{c} IS NOT NULL", f"({low}) AND ({high})"
    if check.kind == q.IN_SET:
        return f"{c} IS NOT NULL", f"{c} IN ({', '.join(map(_text, check.values))})"
    if check.kind == q.PAIR_GREATER:
        other = f'"{check.other}"'
        return f"{c} IS NOT NULL OR {other} IS NOT NULL", f"coalesce({c} > {other}, FALSE)"
    keys = [f'"{k}"' for k in check.columns]
    return " OR ".join(f"{k} IS NOT NULL" for k in keys), "same_key = 1"


def _select(check: q.Check, domain: str, layer: str, source: str) -> str:
    batch = _BATCH[domain]
    label = check.label()
    nothing = "CAST(NULL AS BIGINT) AS missing_count, CAST(NULL AS BIGINT) AS unexpected_count, "
    nothing += "CAST(NULL AS DOUBLE) AS unexpected_pct"
    if check.kind in (q.EXISTS, q.ROW_COUNT, q.UNIQUE_COUNT):
        success, observed = ("FALSE" if check.column in _ABSENT else "TRUE"), "CAST(NULL AS VARCHAR)"
        if check.kind != q.EXISTS:
            value = "count(*)" if check.kind == q.ROW_COUNT else f'count(DISTINCT "{check.column}")'
            success = f"{value} BETWEEN {check.low} AND {check.high}"
            observed = f"CAST({value} AS VARCHAR)"
        counts = nothing
    else:
        judged, passes = _judged(check)
        if check.kind == q.COMPOUND_UNIQUE:
            keys = ", ".join(f'"{k}"' for k in check.columns)
            source = f"(SELECT *, count(*) OVER (PARTITION BY {batch}, {keys}) AS same_key FROM {source} s)"
        good = f"count(*) FILTER (WHERE ({judged}) AND ({passes}))"
        all_judged = f"count(*) FILTER (WHERE {judged})"
        success = (
            f"{all_judged} = 0 OR CAST({good} AS DOUBLE) / {all_judged} >= CAST({check.mostly} AS DOUBLE)"
        )
        counts = (
            f"count(*) - {all_judged} AS missing_count, {all_judged} - {good} AS unexpected_count, "
            f"CAST({all_judged} - {good} AS DOUBLE) * 100 / nullif(CAST({all_judged} AS DOUBLE), 0)"
            " AS unexpected_pct"
        )
        observed = "CAST(NULL AS VARCHAR)"
    name = "CAST(NULL AS VARCHAR)" if label is None else f"'{label}'"
    return (
        f"SELECT '{domain}' AS domain, '{layer}' AS layer, {batch} AS batch, "
        f"'{check.kind}' AS expectation, {name} AS \"column\", {success} AS success, "
        f"count(*) AS element_count, {counts}, {observed} AS observed FROM {source} x GROUP BY {batch}"
    )


def report(
    names: Sequence[str],
    then: str = "SELECT * FROM report",
    kind: str | None = None,
    also: dict[str, str] | None = None,
    rows: tuple[int, int] | None = None,
) -> str:
    parts, sources, clocked = [], [], {}
    for name in names:
        domain, layer = name.split("/")
        relation, body = _SOURCES[name]
        sources.append(relation)
        clocked[f"clocked_{relation}"] = body
        for check in suites.suite(name, rows):
            if kind in (None, check.kind):
                parts.append(_select(check, domain, layer, f"clocked_{relation}"))
    bodies = {**clocked, "report": "\nUNION ALL\n".join(parts), **(also or {})}
    return using(*sources, then=then, also=bodies)


def statements(gate_rows: tuple[int, int]) -> dict[str, str]:
    trips, weather = ("taxi/bronze", "taxi/silver"), ("weather/bronze", "weather/silver")
    verdicts = """
SELECT domain, layer, batch, count(*) FILTER (WHERE success) AS passed, count(*) AS total,
    bool_and(success) AS success
FROM report GROUP BY domain, layer, batch"""
    gate = f"""
SELECT v.*, CASE WHEN v.success THEN n.admitted ELSE 0 END AS admitted
FROM ({verdicts}) v
JOIN (SELECT {_BATCH["taxi"]} AS batch, count(*) AS admitted FROM bronze_trips GROUP BY 1) n
    ON v.batch = n.batch"""
    both_silver = ("taxi/silver", "weather/silver")
    return {
        "dq_row_count": report(trips + weather, kind=q.ROW_COUNT),
        "dq_columns_exist": report(("taxi/bronze", "weather/bronze"), kind=q.EXISTS),
        "dq_not_null": report(trips, kind=q.NOT_NULL),
        "dq_between": report(both_silver, kind=q.BETWEEN),
        "dq_pair_greater": report(("taxi/silver",), kind=q.PAIR_GREATER),
        "dq_in_set": report(both_silver, kind=q.IN_SET),
        "dq_unique_count": report(("weather/silver",), kind=q.UNIQUE_COUNT),
        "dq_compound_unique": report(("weather/silver",), kind=q.COMPOUND_UNIQUE),
        "dq_suite_trips": report(trips),
        "dq_suite_weather": report(weather),
        "dq_report": report(trips + weather),
        "dq_pipeline_weather": report(
            ("weather/silver",),
            then="""
SELECT domain, layer, batch, expectation, "column", element_count, unexpected_count
FROM report WHERE NOT success""",
            rows=gate_rows,
        ),
        "dq_gate": report(("taxi/bronze",), then=gate, rows=gate_rows),
    }
