"""Stable identifiers built from natural keys (md5), replacing random uuids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def tracking_id(shipment_id, index) -> Column:
    """``TRK-`` + first 12 hex digits of md5("<shipment_id>:<index>"), upper case."""
    h = F.md5(F.concat(_c(shipment_id).cast("string"), F.lit(":"), _c(index).cast("string")))
    return F.concat(F.lit("TRK-"), F.upper(F.substring(h, 1, 12)))


def keyed_id(prefix: str, *parts) -> Column:
    """``PREFIX-`` + the whole upper-case md5 of the natural key parts joined
    by ':' (these ids are keys of upserts, so no digest prefix)."""
    h = F.md5(F.concat_ws(":", *[_c(p).cast("string") for p in parts]))
    return F.concat(F.lit(prefix + "-"), F.upper(h))


def time_text(ts) -> Column:
    """A timestamp as text to the microsecond, for use inside an id."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def order_number(created, key) -> Column:
    """``ORD-yyyymmdd-XXXXXXXX`` with a stable md5 suffix of the key."""
    return F.concat(F.lit("ORD-"), F.date_format(_c(created), "yyyyMMdd"), F.lit("-"),
                    F.upper(F.substring(F.md5(_c(key).cast("string")), 1, 8)))


def sample_order_key(seed: str, *parts) -> Column:
    """md5 over seed and key parts: a reproducible random order for sampling."""
    return F.md5(F.concat_ws("|", F.lit(seed), *[_c(p).cast("string") for p in parts]))
