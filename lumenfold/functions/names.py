"""Facts encoded in file names and in small texts beside them, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _found(c: Column) -> Column:
    return F.when(c != "", c)


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def infer_axis(path: Column, axis: str) -> Column:
    """'01' of -z01- in the name, else of a parent folder correctionsNN; an error where there is neither."""
    own = _found(F.regexp_extract(basename(path), rf"-{axis}(\d+)-", 1))
    parent = _found(F.regexp_extract(path, r"corrections(\d+)[^/]*/[^/]*$", 1))
    return F.coalesce(own, parent, F.raise_error(F.concat(F.lit(f"no {axis} in "), path)))


def infer_laser(path: Column) -> Column:
    """Wavelength as text, or null."""
    return F.coalesce(_found(F.regexp_extract(path, r"[Ee]xc[-_]?(\d{3,4})\s*nm", 1)), _found(F.regexp_extract(path, r"(?i)(\d{3,4})\s*nm", 1)))


def is_dark(path: Column) -> Column:
    return F.lower(path).contains("dark")


def folder_number(name: Column, axis: str) -> Column:
    return _found(F.regexp_extract(name, rf"(?i){axis}(\d+)", 1)).cast("int")


def sort_key(name: Column, axis: str = "y") -> Column:
    """Numeric key; names without a number come last."""
    return F.coalesce(_found(F.regexp_extract(name, rf"(?i){axis}(\d+)", 1)).cast("long"), F.lit(1_000_000_000).cast("long"))


def chunk_number(name: Column, prefix: str = "") -> Column:
    """The digits after the prefix, else the first digits."""
    return F.coalesce(_found(F.regexp_extract(name, rf"^{prefix}(\d+)", 1)), _found(F.regexp_extract(name, r"(\d+)", 1))).cast("int")


def last_number(name: Column) -> Column:
    return _found(F.regexp_extract(name, r"(\d+)\D*$", 1)).cast("int")


def safe_root(name: Column) -> Column:
    """Without the spool extension, spaces and other characters as underscores."""
    return F.regexp_replace(F.regexp_replace(name, r"\.fli(\.zst)?$", ""), r"[^A-Za-z0-9_.\-]", "_")


def padded(n: Column, width: int) -> Column:
    """Zero-padded; longer numbers stay whole."""
    return F.when(F.length(n.cast("string")) >= width, n.cast("string")).otherwise(F.lpad(n.cast("string"), width, "0"))


def cut_number(n: Column, width: int) -> Column:
    """Exactly so many characters, as LPAD gives them: zero-padded, and of longer numbers the first ones."""
    return F.lpad(n.cast("string"), width, "0")


def plane_number(name: Column) -> Column:
    return _found(F.regexp_extract(name, r"_plane(\d{3})", 1)).cast("int")


def channel_number(name: Column) -> Column:
    return _found(F.regexp_extract(name, r"_ch?(\d)", 1)).cast("int")


def slab_number(name: Column) -> Column:
    return _found(F.regexp_extract(name, r"_z(\d{2})", 1)).cast("int")


#: Suffixes of stage outputs.
STAGES = ["bg_subtracted", "laser_corrected", "transformed", "registered", "unmixed"]


def stage_of(name: Column) -> Column:
    out = F.lit("raw")
    for s in STAGES:
        out = F.when(name.contains("_" + s), s).otherwise(out)
    return out


def other_camera(name: Column, own: str = "272", other: str = "088") -> Column:
    """Name of the second camera's spool of the same strip."""
    return F.regexp_replace(name, rf"{own}\.fli", f"{other}.fli")


def is_spool(name: Column) -> Column:
    return F.lower(name).rlike(r"\.fli(\.zst)?$")


def is_compressed(name: Column) -> Column:
    """By extension; anything but a spool is an error."""
    return F.when(F.lower(name).endswith(".fli.zst"), True).when(F.lower(name).endswith(".fli"), False).otherwise(F.raise_error(F.concat(F.lit("not a spool: "), name)).cast("boolean"))


def flags(column: Column, fields: str) -> Column:
    """A run's flags out of base64-coded JSON, as a structure of the given fields; null where it can't be read."""
    return F.from_json(F.try_to_binary(column, F.lit("base64")).cast("string"), fields)


def encode_flags(struct: Column) -> Column:
    return F.base64(F.to_json(struct).cast("binary"))


def log_time(line: Column) -> Column:
    """The time at the start of a log line, or null."""
    return F.try_to_timestamp(F.regexp_extract(line, r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d)", 1), F.lit("yyyy-MM-dd HH:mm:ss"))
