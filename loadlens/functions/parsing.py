"""Measurement line parsing and encoding as Catalyst expressions.

Wire format: headerless CSV ``id,timestamp,value,property,plug_id,household_id,house_id``.
Integers must be plain decimal literals (an optional sign, digits only) and
fit an int (the id a long); the value is a float (``NaN``/``Infinity`` accepted).  Extra
fields after the seventh are ignored, fewer than seven make the row bad.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Field order of the wire format and the id separator.
FIELDS = ("id", "timestamp", "value", "property", "plug_id", "household_id", "house_id")
INT_FIELDS = ("id", "timestamp", "property", "plug_id", "household_id", "house_id")
HHP_SEP = ":"
# Fixed value: the 7-group line pattern (digits only, unescaped dot in the value).
LINE_PATTERN = r"([0-9]*),([0-9]*),([0-9]*.[0-9]*),([0-9]*),([0-9]*),([0-9]*),([0-9]*)"

_INT_RE = r"^[+-]?[0-9]+$"
# Fixed value: the float literals a Java parser takes (case matters in NaN and Infinity).
_FLOAT_RE = r"^\s*[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\s*$"


def hhp_id(house="house_id", household="household_id", plug="plug_id") -> Column:
    """Display id ``house:household:plug``; group by the three ints, not this."""
    return F.concat_ws(HHP_SEP, F.col(house), F.col(household), F.col(plug))


def _typed(name: str, raw: Column) -> Column:
    if name in INT_FIELDS:
        return F.when(raw.rlike(_INT_RE), raw.try_cast("long" if name == "id" else "int"))
    return F.when(raw.rlike(_FLOAT_RE), raw.try_cast("float"))


def _field_exprs(parts: Column) -> dict[str, Column]:
    return {name: _typed(name, F.get(parts, i)) for i, name in enumerate(FIELDS)}


_ROW_TYPE = ("struct<id:bigint,timestamp:int,value:float,property:int,plug_id:int,"
             "household_id:int,house_id:int>")


def _typed_struct(fields: dict[str, Column]) -> Column:
    return F.struct(*[fields[n].alias(n) for n in FIELDS])


def _all_present(fields: dict[str, Column]) -> Column:
    ok = F.lit(True)
    for c in fields.values():
        ok = ok & c.isNotNull()
    return ok


def _emit(staged: DataFrame, fields: dict[str, Column], mode: str) -> DataFrame:
    """Keep good rows (or bad lines) with a generator instead of a filter.

    A filter on the parsed columns would be pushed below the parse with every
    field expression inlined into each conjunct (the split and casts would run
    once per conjunct).  Emitting 0 or 1 rows from one projection evaluates
    the staged split once per line.
    """
    ok = _all_present(fields)
    row = _typed_struct(fields)
    empty = F.array().cast(f"array<{_ROW_TYPE}>")
    if mode == "drop":
        return _finish(staged.select(F.inline(F.when(ok, F.array(row)).otherwise(empty))))
    if mode == "failfast":
        bad = F.raise_error(F.concat(F.lit("malformed measurement line: "), F.col("_line")))
        return _finish(staged.select(F.inline(F.when(ok, F.array(row)).otherwise(bad))))
    if mode == "reject":
        rej = F.array(F.struct(F.col("_line").alias("line")))
        return staged.select(F.inline(F.when(~ok, rej).otherwise(F.array().cast("array<struct<line:string>>"))))
    raise ValueError(f"unknown mode {mode!r}")


def parse_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """Typed fields and an ``_ok`` flag for every line (nothing dropped)."""
    staged = lines.select(F.split(F.col(value_col), ",", -1).alias("_p"))
    fields = _field_exprs(F.col("_p"))
    return staged.select(*[fields[n].alias(n) for n in FIELDS], _all_present(fields).alias("_ok"))


def _finish(df: DataFrame) -> DataFrame:
    return df.select(*FIELDS, hhp_id().alias("hhp_id"))


def parse_csv(lines: DataFrame, value_col: str = "value", mode: str = "drop") -> DataFrame:
    """CSV lines -> measurement rows.

    ``mode='drop'``: bad rows are left out; ``'reject'``: only bad rows, as
    ``line``; ``'failfast'``: a bad row fails the job, as the reference does.
    """
    staged = lines.select(F.split(F.col(value_col), ",", -1).alias("_p"), F.col(value_col).alias("_line"))
    return _emit(staged, _field_exprs(F.col("_p")), mode)


def parse_csv_with_rejects(lines: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows and rejected lines from one parse (cache ``lines`` if reused)."""
    return parse_csv(lines, value_col, "drop"), parse_csv(lines, value_col, "reject")


def parse_regex(lines: DataFrame, value_col: str = "value", pattern: str = LINE_PATTERN,
                mode: str = "drop") -> DataFrame:
    """Pattern-match parse: the whole line must match (anchored); else dropped."""
    anchored = f"^{pattern}$"
    v = F.col(value_col)
    staged = lines.select(v.rlike(anchored).alias("_m"), v.alias("_line"),
                          *[F.regexp_extract(v, anchored, i + 1).alias(f"_g{i}") for i in range(len(FIELDS))])
    fields = {n: F.when(F.col("_m"), _typed(n, F.col(f"_g{i}"))) for i, n in enumerate(FIELDS)}
    return _emit(staged, fields, mode)


def regex_split(lines: DataFrame, value_col: str = "value", pattern: str = LINE_PATTERN) -> DataFrame:
    """Use the line pattern as a *split delimiter*, with Java split semantics.

    A line the pattern swallows whole yields no tokens at all.
    """
    from loadlens.functions.text import java_split

    return lines.select(F.explode(java_split(F.col(value_col), pattern)).alias("token"))


def encode_csv() -> Column:
    """Measurement row -> CSV line (the producer's payload)."""
    return F.concat_ws(",", *[F.col(n).cast("string") for n in FIELDS])
