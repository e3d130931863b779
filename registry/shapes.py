"""Tables derived from the given ones, written once for both engines.

The given tables hold no nulls, orphans or padding. Each shape derives such defects by
arithmetic on a key, over all rows of its base table. The expressions are plain SQL that
Spark and DuckDB read alike. A row for which `copy_when` holds appears twice, with `_copy`
0 and 1.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Shape:
    base: str
    columns: dict[str, str]
    copy_when: str = "false"
    numbers: tuple[str, ...] = ()
    deleted: str = "false"

    def selection(self, **extra: str) -> list[str]:
        return [f"{text} AS {name}" for name, text in {**self.columns, **extra}.items()]


AS_OF = "2024-06-01 00:00:00"
LOADED_AT = "2024-01-01 00:00:00"
RELOADED_AT = "2024-02-01 00:00:00"
WATERMARK_BEFORE = "2001-01-01 00:00:00"
EVENTS_BEFORE = "2024-01-20 00:00:00"

ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


def _flag(key: str) -> str:
    return (f"CASE WHEN _copy = 1 THEN false WHEN {key} % 17 = 0 THEN CAST(NULL AS boolean) "
            f"WHEN {key} % 13 = 0 THEN true ELSE false END")


# Orders with null customers, spiked prices, soft deletes and a second copy of some rows.
DIRTY = Shape(
    base="orders",
    copy_when="o_orderkey % 23 = 0",
    columns={
        "o_orderkey": "o_orderkey",
        "o_custkey": "CASE WHEN o_orderkey % 11 = 0 AND _copy = 0 THEN NULL ELSE o_custkey END",
        "o_orderstatus": "o_orderstatus",
        "o_totalprice": "CASE WHEN o_orderkey % 97 = 0 AND _copy = 0 THEN o_totalprice * 100 ELSE o_totalprice END",
        "o_orderdate": "o_orderdate",
        "o_orderpriority": "o_orderpriority",
        "_is_deleted": _flag("o_orderkey"),
    },
    numbers=("o_orderkey", "o_custkey", "o_totalprice"),
)

# Orders as a parent table of which some rows are soft-deleted.
PARENTS = Shape(
    base="orders",
    columns={"o_orderkey": "o_orderkey", "_is_deleted": "o_orderkey % 13 = 0"},
    numbers=("o_orderkey",),
)

# The eight clinical-trial tables. `_copy` 1 is a later load of the same key with other content.
TRIAL = {
    "studies": Shape(
        base="orders",
        copy_when="o_orderkey % 23 = 0",
        deleted=_flag("o_orderkey"),
        columns={
            "nct_id": "CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE concat('NCT', CAST(o_orderkey AS string)) END",
            "brief_title": "concat('  Study ', CAST(o_orderkey AS string), ' v', CAST(_copy AS string), ' ')",
            "official_title": "concat(o_orderpriority, ' trial of ', CAST(o_custkey AS string), '  ')",
            "overall_status": "concat(' ', CASE o_orderstatus WHEN 'O' THEN 'RECRUITING' WHEN 'F' THEN 'Completed' ELSE 'Withdrawn' END, ' ')",
            "phase": "concat(' ', o_orderpriority)",
            "study_type": "CASE WHEN o_totalprice > 250000 THEN ' Interventional' ELSE 'OBSERVATIONAL ' END",
            "enrollment": "CAST(CASE WHEN o_orderkey % 97 = 0 THEN (o_custkey % 500) * 1000 ELSE o_custkey % 500 END AS int)",
            "last_update_posted_date": "CASE WHEN o_orderkey % 89 = 0 THEN 'not a date' ELSE CAST(o_orderdate AS string) END",
        },
        numbers=("enrollment",),
    ),
    "sponsors": Shape(
        base="lineitem",
        copy_when="l_suppkey % 23 = 0",
        deleted=_flag("(l_orderkey + l_linenumber)"),
        columns={
            "nct_id": "concat('NCT', CAST(l_orderkey AS string))",
            "name": "CASE WHEN l_partkey % 29 = 0 THEN NULL ELSE concat(' Supplier ', CAST(l_suppkey AS string), ' ') END",
            "lead_or_collaborator": "CASE WHEN l_linenumber = 1 THEN 'LEAD ' ELSE ' Collaborator' END",
        },
    ),
    "conditions": Shape(
        base="lineitem",
        copy_when="l_partkey % 23 = 0",
        deleted=_flag("(l_orderkey + l_partkey)"),
        columns={
            "nct_id": "concat('NCT', CAST(l_orderkey AS string))",
            "name": "concat(' ', l_returnflag, '-', CAST(l_partkey % 7 AS string), ' ')",
        },
    ),
    "interventions": Shape(
        base="lineitem",
        copy_when="l_partkey % 19 = 0",
        deleted=_flag("(l_orderkey + l_suppkey)"),
        columns={
            "nct_id": "concat('NCT', CAST(l_orderkey AS string))",
            "intervention_type": "concat(CASE l_linestatus WHEN 'O' THEN ' DRUG' ELSE 'Device ' END, CASE WHEN l_linenumber > 5 THEN ' ' ELSE '' END)",
            "name": "concat('Part ', CAST(l_partkey AS string), '  ')",
        },
    ),
    "eligibilities": Shape(
        base="customer",
        copy_when="c_custkey % 7 = 0",
        deleted=_flag("c_custkey"),
        columns={
            "nct_id": "concat('NCT', CAST(c_custkey * 11 AS string))",
            "gender": "CASE c_nationkey % 3 WHEN 0 THEN ' ALL' WHEN 1 THEN 'Female ' ELSE NULL END",
            "minimum_age": "concat(' ', CAST(18 + c_nationkey AS string), ' Years')",
            "maximum_age": "concat(CAST(60 + c_nationkey + _copy AS string), ' Years ')",
        },
    ),
    "facilities": Shape(
        base="supplier",
        copy_when="s_suppkey % 5 = 0",
        deleted=_flag("s_suppkey"),
        columns={
            "nct_id": "concat('NCT', CAST(s_suppkey AS string))",
            "name": "concat(s_name, ' ')",
            "city": "concat(' City ', CAST(s_nationkey AS string))",
            "state": "CASE WHEN s_nationkey % 4 = 0 THEN NULL ELSE concat('State ', CAST(s_nationkey % 4 + _copy AS string), ' ') END",
            "country": "concat(' Nation ', CAST(s_nationkey AS string))",
        },
    ),
    "outcomes": Shape(
        base="events",
        copy_when="event_id % 31 = 0",
        deleted=_flag("event_id"),
        columns={
            "id": "event_id",
            "nct_id": "CASE WHEN event_id % 37 = 0 THEN NULL ELSE concat('NCT', CAST(user_id AS string)) END",
            "outcome_type": "concat(' ', upper(event_type), ' ')",
            "title": "concat('Outcome ', CAST(event_id + _copy AS string), ' ')",
            "measured": "value",
        },
        numbers=("id", "measured"),
    ),
    "outcome_analyses": Shape(
        base="documents",
        copy_when="doc_id % 9 = 0",
        deleted=_flag("doc_id"),
        columns={
            "id": "doc_id",
            "outcome_id": "CASE WHEN doc_id % 8 = 0 THEN NULL ELSE doc_id * 11 END",
            "length": "n_chars + _copy",
        },
        numbers=("id", "outcome_id", "length"),
    ),
}
# Ten runs of metrics: ten orders in a row are the ten measurements of one series. The last two runs have the same time.
METRICS = Shape(
    base="orders",
    columns={
        "run_id": "concat('run', CAST(o_orderkey % 10 AS string))",
        "run_timestamp": "timestamp '2024-01-01 00:00:00' + (CASE WHEN o_orderkey % 10 = 9 THEN 8 ELSE o_orderkey % 10 END) * interval '1' day",
        "layer": "CASE CAST(floor(o_orderkey / 10) AS bigint) % 3 WHEN 0 THEN 'bronze_orders' WHEN 1 THEN 'silver_orders' ELSE 'gold_orders' END",
        "table_name": "concat('t', CAST(CAST(floor(o_orderkey / 10) AS bigint) % 5 AS string))",
        "check_name": "CASE CAST(floor(o_orderkey / 30) AS bigint) % 4 WHEN 0 THEN 'null_rate' WHEN 1 THEN 'duplicate_rate' WHEN 2 THEN 'outlier_rate' ELSE 'referential_integrity' END",
        "column_name": "concat('c', CAST(CAST(floor(o_orderkey / 10) AS bigint) AS string))",
        "metric_value": "CAST((o_orderkey * 7919) % 100 AS double) / 100",
        "threshold": "CAST(0.3 AS double)",
        "passed": "CAST((o_orderkey * 7919) % 100 AS double) / 100 <= CAST(0.3 AS double)",
        "details": "concat('order ', CAST(o_orderkey AS string))",
    },
)

# Every second run moved to the day before, six hours after the run of that day.
TWO_A_DAY = "CASE WHEN day(run_timestamp) % 2 = 0 THEN run_timestamp - interval '18' hour ELSE run_timestamp END"

# Orders as lines of a file, of which some hold values that do not parse, one value more or one less.
_KEY, _REST = "CAST(o_orderkey AS string)", "',', o_orderstatus, ',', o_orderpriority"
ORDER_LINES = Shape(
    base="orders",
    columns={"line": f"""CASE WHEN o_orderkey % 97 = 0 THEN concat({_KEY}, ',many', {_REST})
        WHEN o_orderkey % 89 = 0 THEN concat('x', {_KEY}, ',lots', {_REST})
        WHEN o_orderkey % 83 = 0 THEN concat({_KEY}, ',', CAST(o_custkey AS string), {_REST}, ',extra')
        WHEN o_orderkey % 79 = 0 THEN concat({_KEY}, ',', CAST(o_custkey AS string), ',', o_orderstatus)
        ELSE concat({_KEY}, ',', CAST(o_custkey AS string), {_REST}) END"""},
)

# One insight per order.
INSIGHTS = Shape(
    base="orders",
    columns={
        "run_timestamp": "o_orderdate + o_orderkey * interval '1' second",
        "metrics_run_timestamp": "o_orderdate",
        "summary": "concat('order ', CAST(o_orderkey AS string))",
        "root_cause": "concat('customer ', CAST(o_custkey AS string))",
        "suggested_action": "o_orderpriority",
        "severity": "CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'critical' WHEN '2' THEN 'high' WHEN '3' THEN 'medium' WHEN '4' THEN 'low' ELSE 'unknown' END",
        "failed_check_count": "o_custkey",
        "passed_check_count": "o_orderkey",
    },
)

_FULL = ("""concat('{"summary": "order ', CAST(o_orderkey AS string), '", "root_cause": "', o_orderstatus, """
         """'", "suggested_action": "call ', CAST(o_custkey AS string), '", "severity": "', """)
# Answers as models give them: plain, fenced with and without a label, incomplete, no JSON, odd severity, with text
# after the object, two objects, an array.
RESPONSES = Shape(
    base="orders",
    columns={
        "o_orderkey": "o_orderkey",
        "raw_response": f"""CASE o_orderkey % 10
            WHEN 0 THEN concat(chr(10), {_FULL} 'high"}}'), ' ')
            WHEN 1 THEN concat('```json', chr(10), {_FULL} 'Low"}}'), chr(10), '```')
            WHEN 2 THEN concat('```', chr(10), {_FULL} 'critical"}}'), chr(10), '```', chr(10))
            WHEN 3 THEN concat('{{"summary": "order ', CAST(o_orderkey AS string), '"}}')
            WHEN 4 THEN concat('I cannot say more about order ', CAST(o_orderkey AS string))
            WHEN 5 THEN {_FULL} 'urgent"}}')
            WHEN 6 THEN concat({_FULL} 'high"}}'), ' and more text')
            WHEN 7 THEN concat({_FULL} 'high"}}'), chr(10), {_FULL} 'low"}}'))
            WHEN 8 THEN concat('[', {_FULL} 'high"}}'), ']')
            ELSE concat({_FULL} 'high"}}'), ', ', {_FULL} 'low"}}')) END""",
    },
)

# A model's answer for each run and table of METRICS, some of which cannot be read; by columns of the metrics.
PART_RESPONSE = """CASE WHEN table_name = 't1' THEN concat('Sorry, nothing to say about ', run_id)
    WHEN table_name = 't2' THEN concat('{"summary": "', layer, '"} and more')
    ELSE concat('{"summary": "', layer, ' ', table_name, '", "severity": "High"}') END"""

# Orders with a column that the loaded table does not have.
NEW_COLUMN = ("o_channel", "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('channel ', CAST(o_orderkey % 3 AS string)) END")
