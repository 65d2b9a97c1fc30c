"""Column expressions: all built-in, JVM-side, inside whole-stage codegen."""

from feedloom.functions.casts import lenient, lenient_in, lenient_number, lost_in_cast, strict
from feedloom.functions.labels import quad_label
from feedloom.functions.text import country_code, non_blank, blank_to_null
from feedloom.functions.time import (
    day_of, fmt_minute, hour_of, minute_of, parse_compact_day, parse_stamp, parse_weather_time, slot_of,
)

__all__ = [
    "lenient", "lenient_in", "lenient_number", "lost_in_cast", "strict", "quad_label", "country_code", "non_blank",
    "blank_to_null", "day_of", "fmt_minute", "hour_of", "minute_of", "parse_compact_day", "parse_stamp",
    "parse_weather_time", "slot_of",
]
