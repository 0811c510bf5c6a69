"""Identity, hash and strict-parsing expressions (built-in functions only)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of version 5 identities.
NAMESPACE = "5832c301-3d9e-5927-8f15-fa6262c8fc4e"
UNIT = "\x1f"
U64_MAX = 18446744073709551615
U32_MAX = 4294967295


def _dashed(hex32: Column) -> Column:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *(F.substring(hex32, a, n) for a, n in cuts))


def _variant(nibble: Column) -> Column:
    """The RFC 9562 variant nibble: 8, 9, a or b by the two low bits."""
    value = F.conv(nibble, 16, 10).cast("int")
    return F.lower(F.hex(value.bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    raw = F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(name, "UTF-8"))
    h = F.sha1(raw)
    return _dashed(
        F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), _variant(F.substring(h, 17, 1)), F.substring(h, 18, 15))
    )


def shaped_uuid(name: Column, prefix: str) -> Column:
    """A version-5-shaped id from the sha256 of `prefix NUL name`."""
    h = F.sha2(F.concat(F.lit(prefix), F.lit("\0"), name), 256)
    return _dashed(
        F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), _variant(F.substring(h, 17, 1)), F.substring(h, 18, 15))
    )


def row_id(projection: Column, record: Column) -> Column:
    return F.sha2(F.concat(projection, F.lit("\0"), record), 256)


def prefixed_sha256(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def bare_hash(value: Column) -> Column:
    return F.regexp_replace(value, "^sha256:", "")


def is_hash(value: Column) -> Column:
    return value.rlike(r"^sha256:[0-9a-f]{64}$")


def canonical_name(*parts: Column) -> Column:
    """Version tag and trimmed parts, joined by the unit separator; null where a part is empty or holds one."""
    clean = [F.trim(p) for p in parts]
    ok = reduce(lambda a, b: a & b, [(p != "") & ~p.contains(UNIT) for p in clean])
    return F.when(ok, F.concat_ws(UNIT, F.lit("sdar-id-v1"), *clean))


def derived_id(identity: Column, discriminator: Column) -> Column:
    size = lambda c: F.octet_length(c).cast("string")
    return F.concat_ws(":", F.lit("derived-v1"), size(identity), identity, size(discriminator), discriminator)


def strict_utc(text: Column) -> Column:
    """A real UTC instant of up to nine fraction digits, cut to milliseconds; null for anything else."""
    form = r"^\d{4}-(0[1-9]|1[0-2])-\d{2}T([01]\d|2[0-3]):[0-5]\d:[0-5]\d(\.\d{1,9})?Z$"
    seconds = F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    fraction = F.rpad(F.regexp_extract(text, r"\.(\d{1,3})", 1), 3, "0")
    millis = F.unix_millis(seconds) + fraction.cast("int")
    return F.when(text.rlike(form), F.timestamp_millis(millis))


def unsigned(text: Column, most: int = U64_MAX) -> Column:
    """A canonical decimal string within bounds, as decimal(20,0); null for anything else."""
    value = F.when(text.rlike(r"^(0|[1-9][0-9]{0,19})$"), text.cast("decimal(20,0)"))
    return F.when(value <= F.lit(str(most)).cast("decimal(20,0)"), value)


def sequence_key(text: Column) -> Column:
    """Numeric order of canonical decimal strings of any length up to 38 digits."""
    return text.cast("decimal(38,0)")


def normalised(strings: Column) -> Column:
    """Trimmed, without empties, distinct, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(strings, lambda s: F.trim(s)), lambda s: s != "")))


def escaped_label(text: Column) -> Column:
    """A metrics label value: backslash, line end and quote escaped."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")), F.lit('"'), F.lit('\\"'))


def freshness(lag_seconds: Column) -> Column:
    return F.when(lag_seconds.isNull(), "degraded").when(lag_seconds < 60, "fresh").otherwise("stale")
