"""Small value expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_millis(value: Column, kind: T.DataType) -> Column:
    """Milliseconds since 1970 of a date or time; without a zone it reads as UTC, whatever the session's zone is."""
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(value)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint") * 86_400_000
    days, seconds = F.unix_date(value.cast("date")).cast("bigint"), F.floor(F.extract(F.lit("SECOND"), value) * 1000).cast("bigint")
    return days * 86_400_000 + F.hour(value) * 3_600_000 + F.minute(value) * 60_000 + seconds


def from_epoch_millis(millis: Column, kind: T.DataType) -> Column:
    """The reverse of ``epoch_millis``; a date comes back as a time."""
    if isinstance(kind, T.TimestampNTZType):
        zero = F.lit("1970-01-01").cast("timestamp_ntz")
        return zero + F.make_dt_interval(secs=(millis / 1000).cast("decimal(18,6)"))
    return F.timestamp_millis(millis)


def html_escape(text: Column) -> Column:
    """Escape the five characters that are special in HTML (fixed values)."""
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


def facet_path(segments) -> str:
    """``["a", "b"]`` to ``/a/b``; no segments is the root ``/``."""
    return "/" + "/".join(segments)


def under_facet(path: Column, prefix: str, *, exact: bool = False) -> Column:
    """``path`` is ``prefix`` or, unless ``exact``, lies below it."""
    if prefix == "/":
        return path == "/" if exact else path.isNotNull()
    return path == prefix if exact else (path == prefix) | path.startswith(prefix + "/")


def facet_child(path: Column, prefix: str) -> Column:
    """The direct child of ``prefix`` that ``path`` falls under, else NULL."""
    depth = 0 if prefix == "/" else prefix.count("/")
    head = "/" if prefix == "/" else prefix + "/"
    child = F.substring_index(path, "/", depth + 2)
    return F.when(path.startswith(head) & (F.length(path) > len(head)), child)


def facet_ancestors(path: Column) -> Column:
    """Every level of a path from the top down: ``/a/b`` gives ``/a``, ``/a/b``."""
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    return F.transform(
        parts, lambda _, i: F.concat(F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i + 1), "/"))
    )


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# One decimal octet, four of them.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(\.{_OCTET}){{3}}"


def ip_canonical(text: Column) -> Column:
    """Canonical text of an IP address, comparable as a string; NULL if unreadable.

    IPv4 stays dotted, IPv4-mapped IPv6 becomes IPv4, and other IPv6 addresses
    get lower-case groups without leading zeros and ``::`` for the longest run
    of two or more zero groups.
    """
    return F.when(text.rlike(f"^{_DOTTED}$"), text).otherwise(let(_hex_tail(text), _canonical_v6))


def _hex_tail(text: Column) -> Column:
    """A dotted tail (``::1.2.3.4``) rewritten as two hexadecimal groups."""
    tail = F.regexp_extract(text, f":({_DOTTED})$", 1)

    def rewrite(t: Column) -> Column:
        o = [F.split_part(t, F.lit("."), F.lit(i + 1)).try_cast("int") for i in range(4)]
        words = F.concat_ws(":", F.hex(o[0] * 256 + o[1]), F.hex(o[2] * 256 + o[3]))
        return F.when(t != "", F.concat(F.left(text, F.length(text) - F.length(t)), words)).otherwise(text)

    return F.lower(let(tail, rewrite))


def _canonical_v6(flat: Column) -> Column:
    def groups_of(part: Column) -> Column:
        return F.filter(F.split(F.coalesce(part, F.lit("")), ":"), lambda g: g != "")

    def expand(halves: Column) -> Column:
        head, rest = groups_of(F.get(halves, F.lit(0))), groups_of(F.get(halves, F.lit(1)))
        missing = F.lit(8) - F.size(head) - F.size(rest)
        padded = F.concat(head, F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), rest)
        complete = ((F.size(halves) == 1) & (missing == 0)) | ((F.size(halves) == 2) & (missing >= 1))
        return F.when(complete, F.transform(padded, lambda g: F.regexp_replace(g, "^0+(?=.)", "")))

    def shown(groups: Column) -> Column:
        well_formed = (F.size(groups) == 8) & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
        word = [F.conv(F.get(groups, F.lit(i)), 16, 10).cast("int") for i in (6, 7)]
        as_v4 = F.concat_ws(".", *[p.cast("string") for w in word for p in (F.shiftright(w, 8), w.bitwiseAND(255))])
        is_mapped = F.array_join(F.slice(groups, 1, 6), ":") == "0:0:0:0:0:ffff"
        return F.when(well_formed, F.when(is_mapped, as_v4).otherwise(let(F.array_join(groups, ":"), _shortest)))

    stray = flat.rlike("^:[^:]|[^:]:$|:::")
    return F.when(~stray, let(let(F.split(flat, "::", -1), expand), shown))


def _shortest(joined: Column) -> Column:
    """``::`` in place of the longest run of zero groups, the first of equal ones."""
    out = joined
    for run in range(2, 9):  # the longest run is tried first, so it is wrapped last
        zeros = f"(?:^|:)0(?::0){{{run - 1}}}(?::|$)"
        out = F.when(joined.rlike(zeros), F.regexp_replace(joined, f"^(.*?){zeros}", "$1::")).otherwise(out)
    return out


def is_json_object(text: Column) -> Column:
    """The string parses as a JSON object (arrays and scalars do not count)."""
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def json_value(column: Column, path: str, data_type: str) -> Column:
    """One value out of a JSON string field, e.g. ``json_value(c, "$.k", "bigint")``."""
    return F.try_variant_get(F.try_parse_json(column), path, data_type)
