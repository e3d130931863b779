"""SQL for DuckDB that computes the registered queries a second time, independently."""

from __future__ import annotations

from registry import shapes
from registry.shapes import AS_OF, DIRTY, INSIGHTS, LOADED_AT, METRICS, PARENTS, RELOADED_AT, RESPONSES, TRIAL, Shape

LINEAGE = ["_source_system", "_source_schema", "_source_table", "_ingested_at", "_row_hash", "_is_deleted", "_deleted_at"]

# The texts that the results must hold, written out here a second time.
DOMAIN = "AACT clinical trials with CDC-aware Bronze and Silver layers"
NO_FAILURES = "No failing checks in the latest run."
EXPLANATIONS = {
    "null_rate": ("values are missing at the source or were lost on load", "compare the column's nulls with the source table"),
    "duplicate_rate": ("the same key was loaded more than once", "review the business key and the merge of this table"),
    "schema_conformity": ("a column was dropped or changed its type upstream", "align the expected schema with the source"),
    "outlier_rate": ("values are far from the usual range, as after a change of unit", "inspect the extreme values of the column"),
    "freshness_hours": ("the load has not delivered new records", "check the last runs of the ingest job"),
    "referential_integrity": (
        "child rows arrived without their parent or the parent was deleted", "reload the referenced table, then list the orphan rows"),
}
PROMPT_TEMPLATE = """# Data quality review

You review the automated checks of a layered data platform for readers who do not write code.

## Metrics of the newest run

{{METRICS_SUMMARY}}

## Worst failures

{{SAMPLE_FAILURES}}

## What to answer

Answer with one JSON object and nothing around it. It has these keys, each with at most 150 words:

- "summary": two or three plain sentences on the state of the data
- "root_cause": the likeliest technical cause of the first failure
- "suggested_action": one concrete step for the data team
- "severity": critical, high, medium or low, by number and kind of failures

Name tables, columns and values exactly as above and use no others. If every check passed, say so and answer low.
"""


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rows_of(shape: Shape, **extra: str) -> str:
    copies = f"unnest(CASE WHEN {shape.copy_when} THEN [0, 1] ELSE [0] END) AS _copy"
    return f"SELECT {', '.join(shape.selection(**extra))} FROM (SELECT *, {copies} FROM {shape.base})"


def stamped(rows: str, columns, system: str, schema: str, table: str, at: str,
            deleted: str = "false", deleted_at: str = "CAST(NULL AS timestamp)") -> str:
    names = ", ".join(columns)
    texts = ", ".join(f"coalesce(CAST({c} AS varchar), '<NULL>')" for c in columns)
    return (f"SELECT {names}, '{system}' AS _source_system, '{schema}' AS _source_schema, '{table}' AS _source_table, "
            f"{at} AS _ingested_at, {deleted} AS _is_deleted, {deleted_at} AS _deleted_at, "
            f"md5(concat_ws('||', {texts})) AS _row_hash FROM ({rows})")


def number(value: str) -> str:
    trimmed = rf"regexp_replace(printf('%.4f', round({value}, 4)), '(\.\d+?)0+$', '\1')"
    return f"CASE WHEN {value} = CAST('infinity' AS double) THEN 'inf' ELSE {trimmed} END"


# Ingest ---------------------------------------------------------------------------------

def orders_stamped(table_sql: str, at: str, **options: str) -> str:
    return stamped(table_sql, shapes.ORDER_COLUMNS, "files", "tpch", "orders", f"timestamp '{at}'", **options)


def orders_target() -> str:
    return orders_stamped("SELECT * FROM orders", LOADED_AT)


def orders_deleted_target() -> str:
    return orders_stamped(
        "SELECT * FROM orders", LOADED_AT, deleted="o_orderkey % 5 = 2",
        deleted_at=f"CASE WHEN o_orderkey % 5 = 2 THEN timestamp '{LOADED_AT}' END")


def orders_source() -> str:
    return orders_stamped("""SELECT CASE WHEN o_orderkey % 10 = 0 THEN o_orderkey + 10000000000 ELSE o_orderkey END AS o_orderkey,
        o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
        o_orderdate, o_orderpriority FROM orders""", RELOADED_AT)


def orders_wider_source() -> str:
    name, value = shapes.NEW_COLUMN
    return stamped(f"SELECT *, {value.replace('AS string', 'AS varchar')} AS {name} FROM ({orders_source()})",
                   [*shapes.ORDER_COLUMNS, name], "files", "tpch", "orders", f"timestamp '{RELOADED_AT}'")


_LINE_NUMBER = "CASE WHEN l_linenumber <> 7 THEN l_linenumber END AS l_linenumber"


def lines_target() -> str:
    return stamped(f"SELECT * REPLACE ({_LINE_NUMBER}) FROM lineitem", shapes.LINE_COLUMNS,
                   "files", "tpch", "lineitem", f"timestamp '{LOADED_AT}'")


def lines_source() -> str:
    changed = f"""SELECT * REPLACE ({_LINE_NUMBER},
        CASE WHEN l_orderkey % 10 = 0 THEN l_orderkey + 10000000000 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_orderkey % 7 = 0 THEN 0.5 ELSE l_tax END AS l_tax) FROM lineitem"""
    return stamped(changed, shapes.LINE_COLUMNS, "files", "tpch", "lineitem", f"timestamp '{RELOADED_AT}'")


ROW_HASH_SAFE = r"""
SELECT *, sha256(to_json({'n_nationkey': n_nationkey, 'left': "left", 'right': "right"})::varchar) AS _row_hash
FROM (SELECT n_nationkey, concat('a', CASE WHEN n_nationkey % 2 = 0 THEN '||b' ELSE '' END) AS "left",
        CASE WHEN n_nationkey % 5 <> 0 THEN concat(CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE 'b||' END, 'say "c"\') END AS "right" FROM nation)
"""


def loaded_events() -> str:
    columns = ("event_id", "ts", "user_id", "event_type", "value", "props")
    first = f"SELECT * FROM events WHERE ts < timestamp '{shapes.EVENTS_BEFORE}'"
    rest = f"SELECT * FROM events WHERE ts > (SELECT max(ts) FROM ({first}))"
    return " UNION ALL ".join(
        f"SELECT * FROM ({stamped(rows, columns, 'files', 'tpch', 'events', f"timestamp '{at}'")})"
        for rows, at in ((first, LOADED_AT), (rest, RELOADED_AT)))


_HASHED = "md5(concat_ws('||', {}))".format(", ".join(f"coalesce(CAST({c} AS varchar), '<NULL>')" for c in shapes.LINE_COLUMNS))
REJECTED_BECAUSE = """CASE WHEN o_orderkey % 97 = 0 THEN 'o_custkey: ''many'' is not int'
    WHEN o_orderkey % 89 = 0 THEN concat('o_orderkey: ''x', CAST(o_orderkey AS varchar), ''' is not bigint; o_custkey: ''lots'' is not int')
    WHEN o_orderkey % 83 = 0 THEN 'more than 4 values' WHEN o_orderkey % 79 = 0 THEN 'not 4 values' END"""
LOADED_LINES = f"""
WITH first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_HASHED}) AS n FROM lineitem) WHERE n = 1),
changed AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 = 0 THEN 0.5 ELSE l_tax END AS l_tax) FROM lineitem WHERE l_orderkey % 10 <> 0),
second AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_HASHED}) AS n FROM changed) WHERE n = 1),
paired AS (SELECT f.l_tax AS old_tax, s.l_tax AS new_tax, s.l_orderkey IS NULL AS gone,
    {_HASHED.replace("CAST(l_", "CAST(f.l_")} <> {_HASHED.replace("CAST(l_", "CAST(s.l_")} AS differs
    FROM first f LEFT JOIN second s ON f.l_orderkey = s.l_orderkey AND f.l_linenumber = s.l_linenumber)
SELECT count(*) AS row_count, count(*) FILTER (WHERE gone) AS deleted,
    CAST(sum(CASE WHEN gone THEN old_tax ELSE new_tax END) AS decimal(18,2)) AS tax,
    count(*) AS first_insert, (SELECT count(*) FROM lineitem) - count(*) AS first_surplus,
    0 AS insert, count(*) FILTER (WHERE NOT gone AND differs) AS update, 0 AS resurrect,
    count(*) FILTER (WHERE gone) AS delete, count(*) FILTER (WHERE NOT gone AND NOT differs) AS unchanged,
    (SELECT count(*) FROM changed) - (SELECT count(*) FROM second) AS surplus
FROM paired
"""


def latest(rows: str, keys) -> str:
    return (f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY _ingested_at DESC, _row_hash) AS _rn FROM ({rows})) WHERE _rn = 1")


def merged(target: str, source: str, keys, columns, full: bool = True, added=()) -> str:
    """`added` names columns that only the source has."""
    everything = [*columns, *added, *LINEAGE]
    same = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    deletion = "WHEN NOT here AND NOT gone THEN 'delete'" if full else ""

    def kept(c: str) -> str:
        value = f"CASE WHEN _op IN ('update', 'resurrect') THEN s_{c} ELSE t_{c} END"
        if c == "_is_deleted":
            value = f"CASE WHEN _op = 'delete' THEN true ELSE {value} END"
        if c == "_deleted_at":
            value = f"CASE WHEN _op = 'delete' THEN timestamp '{RELOADED_AT}' ELSE {value} END"
        return f"{value} AS {c}"

    both = ", ".join([f"{'NULL' if c in added else f't.{c}'} AS t_{c}, s.{c} AS s_{c}" for c in everything])
    return f"""WITH t AS ({target}), s AS ({latest(source, keys)}),
        paired AS (SELECT {both}, s._row_hash IS NOT NULL AS here, coalesce(t._is_deleted, false) AS gone
            FROM t LEFT JOIN s ON {same}),
        judged AS (SELECT *, CASE WHEN here AND gone THEN 'resurrect'
            WHEN here AND t__row_hash <> s__row_hash THEN 'update' {deletion} ELSE 'unchanged' END AS _op FROM paired)
        SELECT {', '.join(map(kept, everything))}, _op FROM judged
        UNION ALL
        SELECT {', '.join(everything)}, 'insert' AS _op FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {same})"""


ORDERS_MERGE = dict(keys=["o_orderkey"], columns=shapes.ORDER_COLUMNS)
LINES_MERGE = dict(keys=["l_orderkey", "l_linenumber"], columns=shapes.LINE_COLUMNS)
NEWEST = f"(SELECT max(o_orderdate) FROM orders WHERE o_orderdate < timestamp '{shapes.WATERMARK_BEFORE}')"

# Cleaning -------------------------------------------------------------------------------

# Per table: key, required column, trimmed columns, trimmed and lower-cased columns, parsed columns.
CLEANING = {
    "studies": (["nct_id"], "nct_id", ["brief_title", "official_title", "phase"], ["overall_status", "study_type"],
                ["last_update_posted_date"]),
    "sponsors": (["nct_id", "name", "lead_or_collaborator"], "nct_id", ["name"], ["lead_or_collaborator"], []),
    "conditions": (["nct_id", "name"], "nct_id", ["name"], [], []),
    "interventions": (["nct_id", "intervention_type", "name"], "nct_id", ["name"], ["intervention_type"], []),
    "eligibilities": (["nct_id"], "nct_id", ["minimum_age", "maximum_age"], ["gender"], []),
    "facilities": (["nct_id", "name", "city", "country"], "nct_id", ["name", "city", "state", "country"], [], []),
    "outcomes": (["id"], "nct_id", ["title"], ["outcome_type"], []),
    "outcome_analyses": (["id"], "outcome_id", [], [], []),
}


def bronze(table: str) -> str:
    shape = TRIAL[table]
    rows = rows_of(shape, _copy="_copy", _flag=shape.deleted)
    return stamped(rows, shape.columns, "postgresql_aact", "ctgov", table,
                   f"timestamp '{LOADED_AT}' + _copy * interval '1' day", deleted="_flag")


def cleaned(rows: str, trim=(), lower=(), parse=()) -> str:
    changes = [f"trim({c}) AS {c}" for c in trim]
    changes += [f"lower(trim({c})) AS {c}" for c in lower]
    changes += [f"try_cast({c} AS timestamp) AS {c}" for c in parse]
    return f"SELECT * REPLACE ({', '.join(changes)}) FROM ({rows})" if changes else rows


def silver(table: str, source: str | None = None) -> str:
    keys, required, trim, lower, parse = CLEANING[table]
    active = f"SELECT * FROM ({source or bronze(table)}) WHERE NOT _is_deleted"
    rows = cleaned(latest(active, keys), trim, lower, parse)
    return f"SELECT * FROM ({rows}) WHERE {required} IS NOT NULL"


# Aggregates -----------------------------------------------------------------------------

def status_counts(studies: str) -> str:
    return f"SELECT overall_status, count(DISTINCT nct_id) AS study_count FROM ({studies}) GROUP BY overall_status"


def phases(studies: str) -> str:
    return f"SELECT phase, study_type, count(DISTINCT nct_id) AS study_count FROM ({studies}) GROUP BY phase, study_type"


def coverage(studies: str, conditions: str, interventions: str) -> str:
    return f"""SELECT c.name AS condition_name, i.intervention_type, count(DISTINCT s.nct_id) AS study_count
        FROM ({studies}) s LEFT JOIN ({conditions}) c ON s.nct_id = c.nct_id
        LEFT JOIN ({interventions}) i ON s.nct_id = i.nct_id GROUP BY c.name, i.intervention_type"""


# Checks ---------------------------------------------------------------------------------

def metric(table: str, layer: str, check: str, column: str, summary: str, *, value: str, threshold: float,
           passed: str, details: str, digits: int = 4) -> str:
    return f"""SELECT 'registered' AS run_id, timestamp '{AS_OF}' AS run_timestamp, {text(table)} AS table_name,
        {text(layer)} AS layer, '{check}' AS check_name, {text(column)} AS column_name,
        round({value}, {digits}) AS metric_value, CAST({threshold} AS double) AS threshold,
        {passed} AS passed, {details} AS details FROM ({summary})"""


def _share(part: str, whole: str) -> str:
    return f"coalesce(CAST({part} AS double) / nullif({whole}, 0), 0.0)"


class Subject:
    """Check SQL for the rows `source` of a table."""

    def __init__(self, source: str, table: str, layer: str) -> None:
        self.source, self.table, self.layer = source, table, layer

    def _metric(self, check, column, summary, **parts) -> str:
        return metric(self.table, self.layer, check, column, summary, **parts)

    def nulls(self, columns) -> list[str]:
        rate = _share("missing", "total")
        return [self._metric(
            "null_rate", c, f"SELECT count(*) AS total, count(*) - count({c}) AS missing FROM ({self.source})",
            value=rate, threshold=0.05, passed=f"{rate} <= 0.05",
            details="concat(missing, ' nulls out of ', total, ' active rows')") for c in columns]

    def duplicates(self, columns) -> list[str]:
        names = ", ".join(columns)
        rate = _share("total - kinds", "total")
        summary = f"""SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT {names} FROM ({self.source}))) AS kinds
            FROM ({self.source})"""
        return [self._metric(
            "duplicate_rate", ",".join(columns), summary, value=rate, threshold=0.02, passed=f"{rate} <= 0.02",
            details="concat(total - kinds, ' duplicates out of ', total, ' active rows')")]

    def schema(self, expected) -> list[str]:
        """`expected` holds column, whether it fits, and the details."""
        return [self._metric(
            "schema_conformity", c, "SELECT 1", value="1.0" if fits else "0.0", threshold=1.0,
            passed=str(fits).lower(), details=text(why)) for c, fits, why in expected]

    def outliers(self, columns) -> list[str]:
        rate = _share("far", "total")
        return [self._metric(
            "outlier_rate", c, f"""SELECT any_value(m) AS m, any_value(sd) AS sd, count(*) AS total,
                count(*) FILTER (WHERE sd > 0 AND abs((CAST({c} AS double) - m) / sd) > 3.0) AS far
                FROM ({self.source}), (SELECT avg(CAST({c} AS double)) AS m, stddev_samp(CAST({c} AS double)) AS sd
                    FROM ({self.source}))""",
            value=rate, threshold=0.01, passed=f"{rate} <= 0.01",
            details=f"CASE WHEN sd IS NULL OR sd = 0 THEN 'std=0' ELSE concat('mean=', {number('m')}, ', std=', {number('sd')}) END")
            for c in columns]

    def freshness(self, column) -> list[str]:
        age = f"coalesce(date_diff('microsecond', newest, timestamp '{AS_OF}') / 1e6 / 3600.0, CAST('infinity' AS double))"
        return [self._metric(
            "freshness_hours", column, f"SELECT max(try_cast({column} AS timestamp)) AS newest FROM ({self.source})",
            value=age, threshold=720.0, passed=f"{age} <= 720", digits=2,
            details="concat('latest active record at ', coalesce(CAST(newest AS varchar), 'None'))")]

    def integrity(self, column, reference: str, ref_table: str, ref_column: str) -> list[str]:
        rate = _share("orphans", "checked")
        summary = f"""SELECT count(*) AS checked, count(*) FILTER (WHERE r.k IS NULL) AS orphans
            FROM (SELECT {column} AS fk FROM ({self.source}) WHERE {column} IS NOT NULL) c
            LEFT JOIN (SELECT DISTINCT {ref_column} AS k FROM ({reference})) r ON c.fk = r.k"""
        return [self._metric(
            "referential_integrity", column, summary, value=rate, threshold=0.0, passed=f"{rate} = 0",
            details=f"concat(orphans, ' orphan rows out of ', checked, ' checked against {ref_table}.{ref_column}')")]


def active(rows: str) -> str:
    return f"SELECT * FROM ({rows}) WHERE NOT coalesce(_is_deleted, false)"


def union(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def incremental() -> str:
    source = f"SELECT * FROM ({orders_source()}) WHERE o_orderkey % 50 <> 1"
    rows = Subject(active(merged(orders_target(), source, **ORDERS_MERGE)), "orders", "bronze_orders")
    columns = [*shapes.ORDER_COLUMNS, *[c for c in LINEAGE if c != "_deleted_at"]]
    return union([*rows.nulls(columns), *rows.outliers(["o_orderkey", "o_custkey", "o_totalprice"]),
                  *rows.freshness("o_orderdate"), *rows.duplicates(["o_orderkey"])])


DIRTY_COLUMNS = [*DIRTY.columns]
DIRTY_KEYS = ["o_orderkey"]
DIRTY_SCHEMA = [
    ("o_orderkey", True, ""),
    ("o_custkey", False, "expected StringType(), got LongType()"),
    ("o_totalprice", True, ""),
    ("o_clerk", False, "expected StringType(), got MISSING"),
]
dirty = Subject(active(rows_of(DIRTY)), "orders", "bronze_orders")
dirty_all = Subject(rows_of(DIRTY), "orders", "bronze_orders")
lines = Subject("SELECT * FROM lineitem", "lineitem", "bronze_lineitem")


# The given tables: key, numeric columns, text and time columns, time column, references.
GIVEN = {
    "customer": (["c_custkey"], ["c_custkey", "c_nationkey", "c_acctbal"], ["c_name", "c_mktsegment"], None,
                 [("c_nationkey", "nation", "n_nationkey")]),
    "orders": (["o_orderkey"], ["o_orderkey", "o_custkey", "o_totalprice"],
               ["o_orderstatus", "o_orderdate", "o_orderpriority"], "o_orderdate",
               [("o_custkey", "customer", "c_custkey")]),
    "lineitem": (["l_orderkey", "l_linenumber"],
                 ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                 ["l_returnflag", "l_linestatus", "l_shipdate"], "l_shipdate",
                 [("l_orderkey", "orders", "o_orderkey"), ("l_partkey", "part", "p_partkey"),
                  ("l_suppkey", "supplier", "s_suppkey")]),
    "part": (["p_partkey"], ["p_partkey", "p_size", "p_retailprice"], ["p_name", "p_brand", "p_type"], None, []),
    "supplier": (["s_suppkey"], ["s_suppkey", "s_nationkey", "s_acctbal"], ["s_name"], None,
                 [("s_nationkey", "nation", "n_nationkey")]),
    "nation": (["n_nationkey"], ["n_nationkey", "n_regionkey"], ["n_name"], None,
               [("n_regionkey", "region", "r_regionkey")]),
    "region": (["r_regionkey"], ["r_regionkey"], ["r_name"], None, []),
    "events": (["event_id"], ["event_id", "user_id", "value"], ["ts", "event_type", "props"], "ts", []),
    "documents": (["text"], ["doc_id", "n_chars"], ["text", "lang", "source"], None, [("doc_id", "labels", "doc_id")]),
    "labels": (["doc_id"], ["doc_id", "quality", "toxic"], [], None, [("doc_id", "documents", "doc_id")]),
    "pages": (["page_id"], ["page_id"], ["url", "html"], None, []),
    "benchmark": (["item_id"], ["item_id"], ["text"], None, []),
    "conversations": (["conv_id", "turn"], ["conv_id", "turn"], ["role", "text"], None, []),
    "embeddings": (["vec_id"], ["vec_id", "label"], ["embedding"], None, []),
}


def suite_given() -> str:
    selects = []
    for table, (keys, numbers, others, time, references) in GIVEN.items():
        subject = Subject(f"SELECT * FROM {table}", table, f"bronze_{table}")
        selects += subject.nulls([*numbers, *others]) + subject.duplicates(keys) + subject.outliers(numbers)
        selects += subject.freshness(time) if time else []
        for column, ref_table, ref_column in references:
            selects += subject.integrity(column, f"SELECT * FROM {ref_table}", ref_table, ref_column)
    return union(selects)


def suite_layers() -> str:
    ctes, selects = {}, []
    for table, shape in TRIAL.items():
        ctes[f"bronze_{table}"] = bronze(table)
        ctes[f"silver_{table}"] = silver(table, f"SELECT * FROM bronze_{table}")
    for short in [*ctes]:
        ctes[f"active_{short}"] = active(f"SELECT * FROM {short}")
    ctes["gold_study_status_counts"] = status_counts("SELECT * FROM silver_studies")
    ctes["gold_phase_summary"] = phases("SELECT * FROM silver_studies")
    ctes["gold_condition_intervention_summary"] = coverage(
        *(f"SELECT * FROM silver_{t}" for t in ("studies", "conditions", "interventions")))
    kept = [c for c in LINEAGE if c != "_deleted_at"]
    for stage in ("bronze", "silver"):
        for table, shape in TRIAL.items():
            subject = Subject(f"SELECT * FROM active_{stage}_{table}", f"dq_project.{stage}_{table}", f"{stage}_{table}")
            selects += subject.nulls([*shape.columns, *kept]) + subject.duplicates(CLEANING[table][0])
            selects += subject.outliers(shape.numbers)
            keys, _, trim, lower, parse = CLEANING[table]
            layout = [*[k for k in keys if k != "id"], *trim, *lower, *(parse if stage == "silver" else [])]
            selects += subject.schema([(c, True, "") for c in dict.fromkeys(layout)])
            selects += subject.freshness("last_update_posted_date" if table == "studies" else "_ingested_at")
            if table == "outcome_analyses":
                selects += subject.integrity("outcome_id", "SELECT * FROM active_silver_outcomes", "dq_project.silver_outcomes", "id")
            elif table != "studies":
                selects += subject.integrity("nct_id", "SELECT * FROM active_silver_studies", "dq_project.silver_studies", "nct_id")
    for short, layer, keys in (
            ("gold_study_status_counts", "gold_study_status", ["overall_status"]),
            ("gold_phase_summary", "gold_phase_summary", ["phase", "study_type"]),
            ("gold_condition_intervention_summary", "gold_condition_intervention", ["condition_name", "intervention_type"])):
        subject = Subject(f"SELECT * FROM {short}", f"dq_project.{short}", layer)
        selects += subject.nulls([*keys, "study_count"]) + subject.duplicates(keys) + subject.outliers(["study_count"])
        selects += subject.schema([(c, True, "") for c in [*keys, "study_count"]])
    defined = ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in ctes.items())
    return f"WITH {defined}\n{union(selects)}"


# Monitoring and insights ----------------------------------------------------------------

def over_metrics(query: str) -> str:
    return over(rows_of(METRICS), query)


def over(metrics: str, query: str) -> str:
    return f"""WITH m AS MATERIALIZED ({metrics}), newest AS (SELECT * FROM m WHERE (run_timestamp, run_id) =
        (SELECT (run_timestamp, run_id) FROM m ORDER BY run_timestamp DESC, run_id DESC LIMIT 1)) {query}"""


def over_insights(query: str) -> str:
    return f"WITH insights AS ({rows_of(INSIGHTS)}) {query}"


SCORE = "round(avg(CASE WHEN passed THEN 1.0 ELSE 0.0 END) * 100, 1) AS quality_score_pct"
RANKED = """(SELECT *, CAST(row_number() OVER (PARTITION BY run_id, run_timestamp, layer, table_name ORDER BY passed, check_name,
    column_name, metric_value, details) AS integer) AS rank FROM m)"""
TALLY = """count(*) AS total_checks, count(*) FILTER (WHERE passed) AS passed_check_count,
    count(*) FILTER (WHERE NOT passed) AS failed_check_count,
    count(*) FILTER (WHERE NOT passed AND check_name IN ('referential_integrity', 'schema_conformity')) AS failed_structural_count"""
COUNTS = f"(SELECT run_id, run_timestamp, {TALLY} FROM m GROUP BY run_id, run_timestamp)"
_VALUES = f"' | value=', {number('metric_value')}, ' | threshold=', {number('threshold')}"
LINE = (f"concat('layer=', layer, ' | table=', table_name, ' | check=', check_name, ' | column=', column_name, {_VALUES}, "
        "' | passed=', CASE WHEN passed THEN 'True' ELSE 'False' END, ' | details=', details)")
FAILURE = (f"concat('layer=', layer, ' | table=', table_name, ' | column=', column_name, ' | check=', check_name, {_VALUES}, "
           "' | details=', details)")
ISO = r"regexp_replace(strftime(run_timestamp, '%Y-%m-%dT%H:%M:%S.%f'), '\.000000$', '')"
SUMMARIES = f"""SELECT run_id, run_timestamp, layer, table_name, concat('Latest run timestamp: ', {ISO}, chr(10), 'Total checks: ', total_checks,
    ' | Passed: ', passed_check_count, ' | Failed: ', failed_check_count, chr(10), {text('Dataset domain: ' + DOMAIN)},
    chr(10), 'Checks of this table: ', own_total, ' | Passed: ', own_passed, ' | Failed: ', own_total - own_passed,
    chr(10), body) AS metrics_summary
    FROM {COUNTS} JOIN (SELECT run_id, run_timestamp, layer, table_name, string_agg({LINE}, chr(10) ORDER BY rank) AS body,
        count(*) AS own_total, count(*) FILTER (WHERE passed) AS own_passed FROM {RANKED}
        GROUP BY run_id, run_timestamp, layer, table_name) USING (run_id, run_timestamp)"""
FAILURES = f"""SELECT run_id, run_timestamp, layer, table_name, coalesce(string_agg({FAILURE}, chr(10) ORDER BY rank) FILTER (WHERE NOT passed),
    {text(NO_FAILURES)}) AS sample_failures FROM {RANKED} GROUP BY run_id, run_timestamp, layer, table_name"""
PROMPTS = f"""SELECT run_id, run_timestamp, layer, table_name,
    replace(replace({text(PROMPT_TEMPLATE)}, '{{{{METRICS_SUMMARY}}}}', metrics_summary),
    '{{{{SAMPLE_FAILURES}}}}', sample_failures) AS prompt FROM ({SUMMARIES}) JOIN ({FAILURES})
    USING (run_id, run_timestamp, layer, table_name)"""


JOURNAL = f"""SELECT sha256(prompt) AS prompt_hash,
    CASE WHEN table_name <> 't1' THEN concat('{{"summary": "', length(prompt), ' characters", "severity": "low"}}') END AS raw_response,
    CASE WHEN table_name = 't1' THEN 'ValueError: no answer' END AS error,
    CASE WHEN table_name = 't1' THEN 2 ELSE 1 END AS asked FROM ({PROMPTS})"""
RUN_BASELINE = f"""SELECT table_name, layer, check_name, column_name, run_id, moved AS run_timestamp, round(v, 6) AS current_value,
    round(avg(v) OVER before, 6) AS baseline_value, round(v - avg(v) OVER before, 6) AS deviation
    FROM (SELECT table_name, layer, check_name, column_name, run_id, moved, avg(metric_value) AS v
        FROM (SELECT *, {shapes.TWO_A_DAY} AS moved FROM m) GROUP BY ALL)
    WINDOW before AS (PARTITION BY table_name, layer, check_name, column_name ORDER BY moved
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"""


def _explained(position: int) -> str:
    cases = " ".join(f"WHEN {text(check)} THEN {text(words[position])}" for check, words in EXPLANATIONS.items())
    return f"CASE check_name {cases} END"


FIRST = """(SELECT *, row_number() OVER (PARTITION BY run_id, run_timestamp ORDER BY passed, layer, table_name, check_name,
    column_name, metric_value, details) AS place FROM m)"""
RULES = f"""SELECT run_id, run_timestamp,
    CASE WHEN failed_check_count = 0 THEN concat('All ', total_checks, ' checks passed.')
        ELSE concat(failed_check_count, ' of ', total_checks, ' checks failed. The first is ', check_name, ' on ', layer, ' ',
            table_name, '.', column_name, ' at ', {number('metric_value')}, '.') END AS summary,
    CASE WHEN failed_check_count = 0 THEN '' ELSE concat(layer, ' ', table_name, '.', column_name, ': ', {_explained(0)}) END AS root_cause,
    CASE WHEN failed_check_count = 0 THEN '' ELSE concat(layer, ' ', table_name, '.', column_name, ': ', {_explained(1)}) END AS suggested_action,
    CASE WHEN failed_check_count = 0 THEN 'low' WHEN failed_check_count / total_checks >= 0.5 THEN 'critical'
        WHEN failed_check_count / total_checks >= 0.2 OR failed_structural_count > 0 THEN 'high' ELSE 'medium' END AS severity,
    failed_check_count, passed_check_count
    FROM {COUNTS} JOIN (SELECT * FROM {FIRST} WHERE place = 1) USING (run_id, run_timestamp)"""
RULE_JSON = """concat('{"summary":"', summary, '","root_cause":"', root_cause, '","suggested_action":"', suggested_action,
    '","severity":"', severity, '"}')"""
RULE_INSIGHTS = f"""SELECT timestamp '{AS_OF}' AS run_timestamp, run_timestamp AS metrics_run_timestamp, summary, root_cause,
    suggested_action, severity, failed_check_count, passed_check_count, {RULE_JSON} AS raw_response, run_id,
    CAST(NULL AS varchar) AS table_name, true AS parse_ok FROM ({RULES})"""
PART_ROWS = f"""SELECT timestamp '{AS_OF}' AS run_timestamp, run_timestamp AS metrics_run_timestamp,
    CASE WHEN table_name IN ('t1', 't2') THEN '' ELSE concat(layer, ' ', table_name) END AS summary, '' AS root_cause,
    '' AS suggested_action, CASE WHEN table_name IN ('t1', 't2') THEN 'unknown' ELSE 'high' END AS severity,
    failed_check_count, passed_check_count, {shapes.PART_RESPONSE} AS raw_response, run_id, table_name,
    table_name NOT IN ('t1', 't2') AS parse_ok
    FROM {COUNTS} JOIN (SELECT DISTINCT run_id, run_timestamp, layer, table_name FROM m) USING (run_id, run_timestamp)"""

_BARE = r"regexp_replace(raw_response, '^\s+|\s+$', '', 'g')"
_UNFENCED = rf"regexp_replace({_BARE}, '^`+|`+$', '', 'g')"
_UNLABELLED = rf"regexp_replace(regexp_replace({_UNFENCED}, '^json', ''), '^\s+|\s+$', '', 'g')"


_ONE_OBJECT = "json_valid(j) AND j LIKE '{%'"


def _field(name: str) -> str:
    return f"CASE WHEN {_ONE_OBJECT} THEN json_extract_string(j, '$.{name}') END"


PARSED = f"""WITH r AS (SELECT o_orderkey, CASE WHEN starts_with({_BARE}, '```') THEN {_UNLABELLED} ELSE {_BARE} END AS j
        FROM ({rows_of(RESPONSES)}))
    SELECT o_orderkey, j AS raw_response, coalesce({_field('summary')}, '') AS summary,
    coalesce({_field('root_cause')}, '') AS root_cause, coalesce({_field('suggested_action')}, '') AS suggested_action,
    CASE WHEN lower(trim({_field('severity')})) IN ('critical', 'high', 'medium', 'low') THEN lower(trim({_field('severity')}))
        ELSE 'unknown' END AS severity, {_ONE_OBJECT} AS parse_ok FROM r"""

# Defects --------------------------------------------------------------------------------


def drawn(rate: float, seed: str, key: str = "o_orderkey") -> str:
    shifted = f"(({key} % 1000003 + ({seed}) * 7919) % 1000003)"
    return f"(({shifted} * {shifted} * 427799) % 1000003 < {rate} * 1000003)"


def corrupted() -> str:
    nulls = ", ".join(
        f"CASE WHEN NOT {drawn(0.05, str(42 + 10 * i))} THEN {c} END AS {c}"
        for i, c in enumerate(("o_custkey", "o_totalprice", "o_orderstatus")))
    copies = f"unnest(CASE WHEN {drawn(0.03, '43')} THEN [0, 1] ELSE [0] END) AS _copy"
    return f"""SELECT o_orderkey, o_custkey, o_orderstatus,
        CASE WHEN {drawn(0.01, '44 + 100 * _copy')} THEN o_totalprice * 100.0 ELSE o_totalprice END AS o_totalprice,
        CASE WHEN {drawn(0.02, '45 + 100 * _copy')} THEN timestamp '{AS_OF}' - interval '730' day ELSE o_orderdate END AS o_orderdate
        FROM (SELECT o_orderkey, o_orderdate, {nulls}, {copies} FROM orders)"""


def corrupted_checks() -> str:
    subject = Subject(corrupted(), "orders", "corrupted_orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    return union(subject.nulls(columns) + subject.duplicates(["o_orderkey"])
                 + subject.outliers(["o_orderkey", "o_custkey", "o_totalprice"]) + subject.freshness("o_orderdate"))


def oracle_sql() -> dict[str, str]:
    studies = rows_of(TRIAL["studies"])
    key_merge = lambda **kw: merged(kw.pop("target", orders_target)(), orders_source(), **ORDERS_MERGE, **kw)
    parents = rows_of(PARENTS)
    normalised = cleaned(f"SELECT * FROM ({bronze('interventions')}) WHERE NOT _is_deleted", ["name"], ["intervention_type"])
    statements = {
        "lineage_stamp": f"""SELECT *, 'files' AS _source_system, 'tpch' AS _source_schema, 'orders' AS _source_table,
            timestamp '{LOADED_AT}' AS _ingested_at, false AS _is_deleted, CAST(NULL AS timestamp) AS _deleted_at FROM orders""",
        "row_hash": "SELECT *, md5(concat_ws('||', {})) AS _row_hash FROM lineitem".format(
            ", ".join(f"coalesce(CAST({c} AS varchar), '<NULL>')" for c in shapes.LINE_COLUMNS)),
        "high_watermark": f"SELECT {NEWEST} AS max_watermark",
        "incremental_extract": f"SELECT * FROM orders WHERE o_orderdate > {NEWEST}",
        "incremental_extract_inclusive": f"SELECT * FROM orders WHERE o_orderdate >= {NEWEST}",
        "cdc_merge": key_merge(),
        "cdc_merge_incremental": key_merge(full=False),
        "cdc_merge_repeated_keys": merged(lines_target(), lines_source(), **LINES_MERGE),
        "cdc_merge_new_column": merged(orders_target(), orders_wider_source(), added=[shapes.NEW_COLUMN[0]], **ORDERS_MERGE),
        "cdc_change_summary": f"SELECT _op, count(*) AS row_count FROM ({key_merge(target=orders_deleted_target)}) GROUP BY _op",
        "cdc_resurrect": f"SELECT * FROM ({key_merge(target=orders_deleted_target)}) WHERE _op = 'resurrect'",
        "cdc_soft_delete": f"SELECT * FROM ({key_merge()}) WHERE _op = 'delete'",
        "load_full_extracts": f"SELECT * EXCLUDE (_op) FROM ({key_merge()})",
        "load_repeated_keys": LOADED_LINES,
        "load_events_by_watermark": loaded_events(),
        "row_hash_safe": ROW_HASH_SAFE,
        "dq_incremental": incremental(),
        "csv_rejects": f"SELECT line AS record, reason FROM ({rows_of(shapes.ORDER_LINES, reason=REJECTED_BECAUSE)})",
        "jdbc_balanced_ranges": "SELECT count(*) AS row_count, count(*) AS covered_once, 16 AS parts, true AS balanced FROM orders",
        "insight_journal": over_metrics(JOURNAL),
        "inject_exact_duplicates":
            "SELECT count(*) + CAST(floor(count(*) * 0.03) AS bigint) AS row_count, count(DISTINCT o_orderkey) AS kinds FROM orders",
        "mon_run_baseline": over_metrics(RUN_BASELINE),
        "cdc_surplus_keys": f"""SELECT l_orderkey, l_linenumber, count(*) AS copies FROM ({lines_source()})
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "csv_roundtrip": "SELECT * FROM orders",
        "active_rows": active(rows_of(DIRTY)),
        "active_rows_strict": f"SELECT * FROM ({rows_of(DIRTY)}) WHERE NOT _is_deleted",
        "include_deleted_rows": rows_of(DIRTY),
        "silver_dedupe": latest(lines_target(), ["l_orderkey", "l_linenumber"]),
        "silver_dedupe_normalised": f"SELECT * FROM ({latest(normalised, CLEANING['interventions'][0])}) WHERE nct_id IS NOT NULL",
        "silver_trim_lower": cleaned(studies, ["brief_title", "phase"], ["overall_status"]),
        "silver_parse_ts": cleaned(studies, parse=["last_update_posted_date"]),
        "silver_key_not_null": f"SELECT * FROM ({studies}) WHERE nct_id IS NOT NULL",
        "silver_metadata_last": bronze("facilities"),
        "gold_status_counts": status_counts(silver("studies")),
        "gold_phase_summary": phases(silver("studies")),
        "gold_condition_intervention": coverage(silver("studies"), silver("conditions"), silver("interventions")),
        "dq_null_rate": union(dirty.nulls(DIRTY_COLUMNS)),
        "dq_duplicate_rate": union(dirty.duplicates(DIRTY_KEYS)),
        "dq_duplicate_rate_all_columns": union(dirty.duplicates(shapes.ORDER_COLUMNS)),
        "dq_schema_conformity": union(dirty.nulls(DIRTY_COLUMNS) + dirty.schema(DIRTY_SCHEMA)),
        "dq_outlier_rate": union(dirty.outliers(DIRTY.numbers)),
        "dq_outlier_rate_events": union(
            Subject("SELECT * FROM events", "events", "bronze_events").outliers(["event_id", "user_id", "value"])),
        "dq_freshness": union(dirty.freshness("o_orderdate")),
        "dq_referential_integrity": union(lines.integrity("l_orderkey", active(parents), "orders", "o_orderkey")),
        "dq_ref_include_deleted": union(lines.integrity("l_orderkey", parents, "orders", "o_orderkey")),
        "dq_orphan_rows": "SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "dq_run_all": union(
            dirty.nulls(DIRTY_COLUMNS) + dirty.duplicates(DIRTY_KEYS) + dirty.schema(DIRTY_SCHEMA)
            + dirty.outliers(DIRTY.numbers) + dirty.freshness("o_orderdate")
            + dirty.integrity("o_custkey", "SELECT * FROM customer", "customer", "c_custkey")),
        "dq_run_all_include_deleted": union(
            dirty_all.nulls(DIRTY_COLUMNS) + dirty_all.duplicates(DIRTY_KEYS) + dirty_all.outliers(DIRTY.numbers)
            + dirty_all.freshness("o_orderdate")),
        "dq_suite_given": suite_given(),
        "dq_suite": suite_layers(),
        "mon_quality_score": over_metrics(f"SELECT {SCORE} FROM newest"),
        "mon_failed_checks": over_metrics("SELECT count(*) AS failed_checks FROM newest WHERE NOT passed"),
        "mon_score_by_layer": over_metrics(
            f"SELECT CAST(run_timestamp AS date) AS run_date, layer, {SCORE} FROM m GROUP BY 1, 2 ORDER BY 1, 2"),
        "mon_score_by_stage": over_metrics(
            f"SELECT CAST(run_timestamp AS date) AS run_date, split_part(layer, '_', 1) AS stage, {SCORE} FROM m GROUP BY 1, 2"),
        "mon_score_by_table": over_metrics(f"SELECT table_name, {SCORE} FROM newest GROUP BY 1 ORDER BY 2, 1"),
        "mon_failing_checks": over_metrics(
            """SELECT layer, table_name, check_name, column_name, metric_value, threshold, details FROM newest
            WHERE NOT passed ORDER BY 1, 2, 3, 4"""),
        "mon_ri_failures": over_metrics(
            """SELECT layer, table_name, column_name, metric_value AS orphan_rate, details FROM m
            WHERE check_name = 'referential_integrity' AND metric_value > 0 ORDER BY run_timestamp DESC, 1, 2, 3"""),
        "mon_null_hotspots": over_metrics(
            """SELECT concat(layer, ' | ', column_name) AS layer_column, metric_value AS null_rate FROM newest
            WHERE check_name = 'null_rate' ORDER BY null_rate DESC, layer_column"""),
        "mon_latest_insight": over_insights(
            """SELECT run_timestamp, metrics_run_timestamp, severity, failed_check_count, passed_check_count, summary,
            root_cause, suggested_action FROM insights ORDER BY run_timestamp DESC, metrics_run_timestamp DESC LIMIT 1"""),
        "mon_severity_trend": over_insights(
            "SELECT CAST(run_timestamp AS date) AS run_date, severity, count(*) AS insight_count FROM insights GROUP BY 1, 2"),
        "mon_score_alerts": over_metrics(
            """SELECT layer, table_name, round(count(*) FILTER (WHERE passed) / count(*), 4) AS score,
            count(*) FILTER (WHERE NOT passed) AS failed_checks, CAST(0.8 AS double) AS alert_below FROM newest
            GROUP BY 1, 2 HAVING count(*) FILTER (WHERE passed) / count(*) < 0.8"""),
        "mon_rolling_baseline": over_metrics(
            """SELECT a.table_name, a.layer, a.check_name, a.column_name, a.run_date, round(a.v, 6) AS current_value,
            round(avg(b.metric_value), 6) AS baseline_value, round(a.v - avg(b.metric_value), 6) AS deviation
            FROM (SELECT table_name, layer, check_name, column_name, CAST(run_timestamp AS date) AS run_date,
                avg(metric_value) AS v FROM m GROUP BY 1, 2, 3, 4, 5) a
            LEFT JOIN m b ON a.table_name = b.table_name AND a.layer = b.layer AND a.check_name = b.check_name
                AND a.column_name = b.column_name AND CAST(b.run_timestamp AS date) BETWEEN a.run_date - 7 AND a.run_date - 1
            GROUP BY 1, 2, 3, 4, 5, a.v"""),
        "insight_latest_run": over_metrics("SELECT * FROM newest"),
        "insight_ranked_metrics": over_metrics(f"SELECT * FROM {RANKED}"),
        "insight_pass_fail": over_metrics(f"SELECT * FROM {COUNTS}"),
        "insight_metric_lines": over_metrics(SUMMARIES),
        "insight_top_failures": over_metrics(FAILURES),
        "insight_prompt": over_metrics(PROMPTS),
        "insight_parse": PARSED,
        "insight_rule_based": over_metrics(f"SELECT run_id, run_timestamp, {RULE_JSON} AS raw_response FROM ({RULES})"),
        "insight_rows": over_metrics(RULE_INSIGHTS),
        "insight_rows_of_parts": over_metrics(PART_ROWS),
        "insight_whole_suite": over(suite_layers(), SUMMARIES),
        "insight_latest": over_metrics(
            f"SELECT * FROM ({RULE_INSIGHTS}) WHERE (metrics_run_timestamp, run_id) = (SELECT (run_timestamp, run_id) FROM newest LIMIT 1)"),
        "inject_nulls": f"""SELECT * REPLACE (CASE WHEN NOT {drawn(0.05, '7')} THEN o_custkey END AS o_custkey,
            CASE WHEN NOT {drawn(0.05, '17')} THEN o_totalprice END AS o_totalprice) FROM orders""",
        "inject_duplicates": f"SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE {drawn(0.03, '5')}",
        "inject_outliers": f"""SELECT * REPLACE (CASE WHEN {drawn(0.01, '11')} THEN o_totalprice * 100.0 ELSE o_totalprice END
            AS o_totalprice) FROM orders""",
        "inject_stale": f"""SELECT * REPLACE (CASE WHEN {drawn(0.02, '13')} THEN timestamp '{AS_OF}' - interval '730' day
            ELSE o_orderdate END AS o_orderdate) FROM orders""",
        "inject_schema_drift": "SELECT * EXCLUDE (o_orderstatus) FROM orders",
        "inject_all": corrupted(),
        "inject_then_check": corrupted_checks(),
    }
    statements |= {f"silver_{t}_like": silver(t) for t in TRIAL}
    return statements
