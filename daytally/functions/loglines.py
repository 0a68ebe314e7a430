"""Log line parsers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: microseconds are written out, since the default pattern cuts them. Reading takes them without a pattern,
# and faster.
TIMESTAMP_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_CORRUPT = "_corrupt_line"


@dataclass(frozen=True)
class LineParser:
    """How a line becomes a record.

    ``parse`` turns the line column into a struct that holds at least the fields of ``schema``. ``failed`` tells from
    the struct and the line whether the line is a reject. They are apart because each use of the struct inside one
    expression would parse the line again.
    """

    schema: T.StructType
    parse: Callable[[Column], Column]
    failed: Callable[[Column, Column], Column]


def to_json_line(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": TIMESTAMP_PATTERN})


def json_lines(schema: T.StructType, required: tuple[str, ...] = ()) -> LineParser:
    """One JSON object per line. Broken JSON, a field of the wrong type, or text after the object fails the line.

    So does a ``required`` field that is missing or null, and a number that is NaN or infinite: neither can be summed.
    """
    full = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "allowNonNumericNumbers": "false"}

    def parse(line: Column) -> Column:
        return F.from_json(line, full, options)

    def failed(record: Column, line: Column) -> Column:
        broken = record.isNull() | record[_CORRUPT].isNotNull()
        for name in required:
            broken |= record[name].isNull()
        return broken | ~_one_object(line)

    return LineParser(schema, parse, failed)


def _one_object(line: Column) -> Column:
    """Whether a line that starts with a JSON object holds nothing else.

    from_json stops at the end of the first object, so that what follows would vanish. Nothing follows if the line's
    first closing brace is its last byte. All other lines are read once more, as the elements of an array.
    """
    to_first_brace = F.octet_length(F.substring_index(line, "}", 1)) + 1
    elements = F.json_array_length(F.concat(F.lit("["), line, F.lit("]")))
    return F.when(to_first_brace == F.octet_length(line), F.lit(True)).otherwise(elements.eqNullSafe(F.lit(1)))
