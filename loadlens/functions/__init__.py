"""Scalar building blocks (all native Catalyst expressions)."""

from loadlens.functions.output import finish
from loadlens.functions.parsing import (
    FIELDS,
    LINE_PATTERN,
    encode_csv,
    hhp_id,
    parse_csv,
    parse_csv_with_rejects,
    parse_regex,
    regex_split,
)
from loadlens.functions.stats import copysign, shifted_median, shifted_median_ranks
from loadlens.functions.text import java_split, lines_of, words
from loadlens.functions.timeslice import (
    DEFAULT_TF,
    FULL_DAY,
    ORIGIN_TS,
    epoch_seconds,
    event_time,
    idiv,
    pane,
    time_slice,
    time_slice_sql_function,
)

__all__ = [
    "DEFAULT_TF", "FIELDS", "FULL_DAY", "LINE_PATTERN", "ORIGIN_TS", "copysign",
    "encode_csv", "epoch_seconds", "event_time", "finish", "hhp_id", "idiv", "java_split", "lines_of", "pane",
    "parse_csv", "parse_csv_with_rejects", "parse_regex", "regex_split", "shifted_median",
    "shifted_median_ranks", "time_slice", "time_slice_sql_function", "words",
]
