"""Sort order of a sample: nulls lowest, then NaN, then the values, with full tie-breaking."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sampleward.sources.catalog import UNORDERABLE, column_paths, is_orderable

VARIABLE_LENGTH = (T.StringType, T.BinaryType)
UNBOUNDED_LENGTH = (*VARIABLE_LENGTH, *UNORDERABLE)


@dataclass(frozen=True)
class Mark:
    """A value of a sort column, carried as text so that no type loses precision."""

    kind: str
    text: str | None = None


@dataclass(frozen=True)
class OrderKey:
    column: Column
    data_type: T.DataType
    ascending: bool = True

    @property
    def floating(self) -> bool:
        return isinstance(self.data_type, (T.FloatType, T.DoubleType))

    def sort_columns(self) -> list[Column]:
        parts = [self.column]
        if self.floating:
            # Spark puts NaN above every number; here it comes right after null.
            rank = F.when(self.column.isNull(), 0).when(F.isnan(self.column), 1).otherwise(2)
            parts = [rank, self.column]
        if self.ascending:
            return [part.asc_nulls_first() for part in parts]
        return [part.desc_nulls_last() for part in parts]

    def mark_columns(self) -> tuple[Column, Column]:
        """Kind and text of the value, from which `Mark` is rebuilt."""
        kind = F.when(self.column.isNull(), "null")
        if self.floating:
            kind = kind.when(F.isnan(self.column), "nan")
        if isinstance(self.data_type, T.TimestampType):
            text = F.unix_micros(self.column).cast("string")
        elif isinstance(self.data_type, T.BinaryType):
            text = F.hex(self.column)
        else:
            text = self.column.cast("string")
        return kind.otherwise("value"), text

    def literal(self, mark: Mark) -> Column:
        if isinstance(self.data_type, T.TimestampType):
            return F.timestamp_micros(F.lit(int(mark.text)))
        if isinstance(self.data_type, T.BinaryType):
            return F.unhex(F.lit(mark.text))
        return F.lit(mark.text).cast(self.data_type)

    def same(self, mark: Mark) -> Column:
        if mark.kind == "null":
            return self.column.isNull()
        if mark.kind == "nan":
            return F.isnan(self.column)
        return self.column == self.literal(mark)

    def _below(self, mark: Mark, inclusive: bool = False) -> Column:
        if mark.kind == "null":
            return self.column.isNull() if inclusive else F.lit(False)
        below = self.column.isNull()
        if self.floating and (mark.kind == "value" or inclusive):
            below = below | F.isnan(self.column)
        if mark.kind == "nan":
            return below
        value = self.literal(mark)
        return below | (self.column <= value if inclusive else self.column < value)

    def _above(self, mark: Mark, inclusive: bool = False) -> Column:
        if mark.kind == "null":
            return F.lit(True) if inclusive else self.column.isNotNull()
        if mark.kind == "nan":
            given = self.column.isNotNull()
            return given if inclusive else given & ~F.isnan(self.column)
        value = self.literal(mark)
        above = self.column >= value if inclusive else self.column > value
        return above & ~F.isnan(self.column) if self.floating else above

    def before(self, mark: Mark) -> Column:
        return self._below(mark) if self.ascending else self._above(mark)

    def until(self, mark: Mark) -> Column:
        """Before the mark or at it."""
        return self._below(mark, True) if self.ascending else self._above(mark, True)

    def after(self, mark: Mark) -> Column:
        return self._above(mark) if self.ascending else self._below(mark)


def column_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a column or nested field, found without regard to case."""
    for path, data_type in column_paths(df.schema):
        if path.lower() == name.lower():
            return data_type
    raise ValueError(f"Unknown column <{name}>")


def tie_breakers(df: DataFrame, used: set[str] = frozenset()) -> list[OrderKey]:
    """All other orderable columns, ascending: those of fixed length first."""
    fields = [
        field
        for field in df.schema.fields
        if is_orderable(field.dataType) and field.name.lower() not in used
    ]
    fields.sort(key=lambda field: isinstance(field.dataType, VARIABLE_LENGTH))
    return [OrderKey(F.col(f"`{field.name}`"), field.dataType) for field in fields]


def sample_order(df: DataFrame, by: str, direction: str) -> list[OrderKey]:
    """Order of a sorted sample: the requested column, then the tie-breakers."""
    data_type = column_type(df, by)
    if not is_orderable(data_type):
        raise ValueError(f"Column <{by}> of type {data_type.simpleString()} has no order")
    first = OrderKey(F.col(by), data_type, direction.strip().upper() == "ASC")
    return [first, *tie_breakers(df, {by.lower()})]


def sort_columns(keys: list[OrderKey]) -> list[Column]:
    return [column for key in keys for column in key.sort_columns()]
