"""Row-local cleaning, lookups and factor rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN poisons window averages in Spark; null is skipped."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in names}) if names else df


def fill_constant(df: DataFrame, value: float = 0.0, subset: Sequence[str] | None = None) -> DataFrame:
    names = subset or [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return df.fillna(value, subset=list(names))


def bool_to_int(col: Column | str) -> Column:
    return _c(col).cast("int")


def map_values(col: Column | str, mapping: Mapping) -> Column:
    """Value lookup for a short fixed mapping; unmapped values become null."""
    table = F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])
    return F.try_element_at(table, _c(col))


# What reads as a number
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"
WHOLE_NUMBER = r"^\s*[+-]?\d+\s*$"


def to_numeric(col: Column | str) -> Column:
    """Number or null, whatever the text. The pattern keeps junk away from the cast, where every
    failure costs an exception."""
    c = _c(col)
    return F.when(c.cast("string").rlike(NUMBER), c.try_cast("double"))


def clip_negative(col: Column | str) -> Column:
    return F.greatest(_c(col), F.lit(0))


def residual(y_true: Column | str, y_pred: Column | str) -> Column:
    return _c(y_true) - _c(y_pred)


def uplift(y: Column | str, when: Column, factor: float) -> Column:
    """Scale the target where the condition holds and cut the result to a whole number."""
    return F.when(when, (_c(y) * F.lit(factor)).cast("bigint").cast("double")).otherwise(_c(y).cast("double"))


def scale_where(y: Column | str, when: Column, factor: float) -> Column:
    """Scale the target where the condition holds, without cutting."""
    return F.when(when, _c(y) * F.lit(factor)).otherwise(_c(y))


def log_target(y: Column | str) -> Column:
    return F.log1p(_c(y))


def unlog_target(y: Column | str) -> Column:
    return F.expm1(_c(y))


def peak_factor(hour: Column) -> Column:
    # Morning peak 8..10 x1.5, evening peak 18..20 x1.8
    return F.when(hour.between(18, 20), 1.8).when(hour.between(8, 10), 1.5).otherwise(1.0)


def weekend_factor(weekday: Column) -> Column:
    # Fixed value: 0.7 on Saturday and Sunday
    return F.when(weekday >= 5, 0.7).otherwise(1.0)


def tier(name: Column, tiers: Mapping[str, float], default: float) -> Column:
    """First tier whose text occurs in the name."""
    return reduce(lambda rest, kv: F.when(name.contains(kv[0]), F.lit(float(kv[1]))).otherwise(rest), reversed(list(tiers.items())), F.lit(float(default)))


def season_factor(category: Column, month: Column, seasons: Mapping[str, tuple[Sequence[int], float]]) -> Column:
    """Category x month factor; 1.0 outside the listed seasons."""
    out = F.lit(1.0)
    for name, (months, factor) in seasons.items():
        out = F.when((category == name) & month.isin(list(months)), F.lit(float(factor))).otherwise(out)
    return out


def promotion_factor(flag: Column) -> Column:
    # Fixed value: x1.3 under promotion
    return F.when(flag == 1, 1.3).otherwise(1.0)


def price_factor(price: Column, top_price: Column) -> Column:
    # 1.5 minus the relative price, at least 0.5
    return F.greatest(F.lit(0.5), F.lit(1.5) - F.try_divide(price, top_price))


def first_present(entries: Column | str, *keys: str, default=None) -> Column:
    """First non-null value among renamed keys of a map column. A stored 0.0 counts as present."""
    found = [F.try_element_at(_c(entries), F.lit(k)) for k in keys]
    return F.coalesce(*found, *([F.lit(default)] if default is not None else []))


def params_with_prefix(params: Column | str, prefix: str) -> Column:
    """Sorted (key, value) entries of a map whose keys start with the prefix, prefix removed."""
    kept = F.map_filter(_c(params), lambda k, v: k.startswith(prefix))
    bare = F.transform_keys(kept, lambda k, v: F.substr(k, F.lit(len(prefix) + 1)))
    return F.array_sort(F.map_entries(bare))


def filter_values(df: DataFrame, **wanted) -> DataFrame:
    """Keep rows whose columns equal a value or lie in a list of values."""
    for name, value in wanted.items():
        df = df.filter(F.col(name).isin(list(value)) if isinstance(value, (list, tuple, set)) else F.col(name) == value)
    return df


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def flatten(df: DataFrame, sep: str = ".", max_chars: int | None = None) -> DataFrame:
    """Nested structs become columns ``a.b``; strings stay whole unless ``max_chars`` is given."""

    def walk(fields: list[T.StructField], path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType.fields, here)
                continue
            c = F.col(".".join(f"`{p}`" for p in here))
            if max_chars is not None and isinstance(f.dataType, T.StringType):
                c = F.substring(c, 1, max_chars)
            out.append(c.alias(sep.join(here)))
        return out

    return df.select(*walk(df.schema.fields, ()))


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left lookup join. Spark broadcasts the dimension when its measured size allows, and joins by
    shuffle otherwise."""
    return df.join(dim, on, "left")
