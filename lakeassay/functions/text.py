"""SQL fragments for rates and for text that does not depend on float printing.

Fragments keep the plans of many checks cheap to build: one expression per row of
output instead of one call into the JVM per operator.
"""

from __future__ import annotations


def literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(column: str) -> str:
    """A quoted column name, also one that holds a dot."""
    return "`" + column.replace("`", "``") + "`"


def share(part: str, whole: str) -> str:
    """part / whole as double, 0.0 for an empty whole."""
    return f"coalesce(try_divide(double({part}), double({whole})), 0D)"


def number_text(value: str, digits: int = 4) -> str:
    """A double with at most `digits` decimals and at least one: 0.05, 1.0, inf."""
    trimmed = rf"regexp_replace(format_string('%.{digits}f', round({value}, {digits})), r'(\.\d+?)0+$', '$1')"
    return f"CASE WHEN {value} = double('infinity') THEN 'inf' ELSE {trimmed} END"


def iso_text(moment: str) -> str:
    """ISO 8601 text; microseconds only where there are any."""
    full = f"""date_format({moment}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")"""
    return rf"regexp_replace({full}, r'\.000000$', '')"


def truth_text(flag: str) -> str:
    return f"if({flag}, 'True', 'False')"
