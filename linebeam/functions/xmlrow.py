"""Attribute rows: ``<row a="v" b="w" />`` one per line."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# An attribute is a name, '=', and a double-quoted value;
# entities inside the value stay escaped. Single quotes are not read.
ATTRIBUTE = '([^\\s="<>/]+)\\s*=\\s*"([^"]*)"'
ROW_START = "<row "
NAME_END = " \t\n\u000b\f\r"   # what ``\s`` matches between a name and its '='

# The creation-date text format (milliseconds required,
# trailing text ignored) and the pattern that cuts the parsable prefix.
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
DATE_PREFIX = "^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\\.[0-9]{3}"


def is_row_line(line: Column) -> Column:
    """Header, root element and blank lines are not rows."""
    return F.ltrim(line).startswith(ROW_START)


def attr_map(line: Column) -> Column:
    """map<string,string> of the attributes of one row line; the last of
    duplicate names wins; a line without attributes gives an empty map.

    The line is matched once: an attribute's name ends at its first ``=`` and its
    value lies between its two quotes, so both are cut from the match. Lines that
    repeat a name, which are rare, sort their entries to find the last ones."""
    def build(found):
        names = F.transform(found, lambda a: F.rtrim(F.substring_index(a, "=", 1), F.lit(NAME_END)))
        values = F.transform(found, lambda a: F.substring_index(F.substring(a, F.instr(a, '"') + 1, F.length(a)), '"', 1))
        return F.transform(F.array(F.struct(names.alias("k"), values.alias("v"))), unique)[0]

    def unique(nv):
        names, values = nv["k"], nv["v"]
        placed = F.array_sort(F.transform(names, lambda k, i: F.struct(k.alias("k"), i.alias("i"), F.get(values, i).alias("v"))))
        repeated = F.transform(F.array(placed), last_ones)[0]
        return F.when(F.size(F.array_distinct(names)) == F.size(names), F.map_from_arrays(names, values)).otherwise(repeated)

    def last_ones(entries):
        is_last = F.filter(entries, lambda e, i: F.coalesce(F.get(entries, i + 1)["k"] != e["k"], F.lit(True)))
        return F.map_from_entries(F.transform(is_last, lambda e: F.struct(e["k"], e["v"])))

    # the one-element arrays bind the match, and names with values, once per row for the lambdas
    return F.transform(F.array(F.regexp_extract_all(line, F.lit(ATTRIBUTE), 0)), build)[0]


def attr(line_or_map: Column, name: str) -> Column:
    """One attribute; NULL when absent."""
    return F.element_at(line_or_map, F.lit(name))


def attr_value(line: Column, name: str) -> Column:
    """One attribute read straight from the line without building the map;
    NULL when absent. Cheaper than ``attr(attr_map(line), name)``.

    The pattern consumes every attribute in turn, so a name inside another
    attribute's value is never taken for one; group 1 is the quoted value of
    attributes of this name and empty for the others. The last one wins."""
    pattern = f'{re.escape(name)}\\s*=\\s*("[^"]*")|[^\\s="<>/]+\\s*=\\s*"[^"]*"'
    quoted = F.try_element_at(F.filter(F.regexp_extract_all(line, F.lit(pattern), 1), lambda v: v != ""), F.lit(-1))
    return F.regexp_replace(quoted, '^"|"$', "")


def xml_escape(text: Column) -> Column:
    """Escape a value for a double-quoted attribute (``&`` first)."""
    out = F.regexp_replace(text, "&", "&amp;")
    out = F.regexp_replace(out, "<", "&lt;")
    out = F.regexp_replace(out, ">", "&gt;")
    out = F.regexp_replace(out, '"', "&quot;")
    out = F.regexp_replace(out, "\n", "&#10;")
    return F.regexp_replace(out, "\r", "&#13;")


def creation_year(text: Column) -> Column:
    """Year of a creation-date string, NULL when it does not parse.

    No lenient roll-over: month 13 or day 32 give NULL, i.e. the row is dropped.
    """
    cut = F.regexp_extract(text, DATE_PREFIX, 0)  # '' when there is no such prefix
    ts = F.try_to_timestamp(cut, F.lit(DATE_FORMAT))
    return F.year(ts)


def typed_attrs(line: Column, fields: dict[str, str]) -> Column:
    """struct of the named attributes with Spark types (``{"Id": "string",
    "Reputation": "int"}``), parsed with ``from_xml``: entities are unescaped,
    an absent attribute or a value that does not fit its type is NULL, a
    broken line gives all NULLs."""
    ddl = ", ".join(f"`{name}` string" for name in fields)
    parsed = F.from_xml(F.ltrim(line), ddl, {"attributePrefix": ""})
    # the one-element array binds the parse once for the per-field casts
    return F.transform(F.array(parsed), lambda s: F.struct(
        *[s[name].try_cast(typ).alias(name) for name, typ in fields.items()]))[0]
