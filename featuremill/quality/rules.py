"""The data-quality tests: one class each, which owns its parameters, checks them and says what it counts.

A test is measured as (failed_rows, observed): failed_rows > 0 is a failure, 0 a pass, < 0 means that there was nothing to
compare with. Row tests say which rows are bad and are counted in a shared pass, like the tests on counts; tests on groups or
on other tables bring a plan of their own.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import MISSING, dataclass, fields
from datetime import date, timedelta
from functools import reduce
from operator import and_, or_
from typing import Any, ClassVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featuremill.functions.dates import day


class DqConfigError(ValueError):
    """The configuration of a table's tests is not valid."""


#: All tests by name.
RULES: dict[str, type[Rule]] = {}


@dataclass(frozen=True)
class Table:
    """What a test is told about the checked table."""

    primary_key: tuple[str, ...]
    on: date
    date_column: str = "date"
    whole: bool = False
    others: Mapping[str, DataFrame] = None

    @property
    def day(self) -> Column:
        return F.col(self.date_column).cast("date")

    def rows(self, where: str | None) -> Column:
        """Rows that a test looks at, in a form that prunes partitions."""
        looked_at = [] if self.whole else [self.day == day(self.on)]
        return reduce(and_, [*looked_at, *([F.expr(where)] if where else [])], F.lit(True))


def sure(condition: Column) -> Column:
    """NULL counts as not true."""
    return F.coalesce(condition, F.lit(False))


def either(conditions: list[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


@dataclass(frozen=True, kw_only=True)
class Rule:
    name: ClassVar[str]
    family: ClassVar[str]
    always: ClassVar[bool] = False  # runs for every table unless it is switched off
    reads: ClassVar[str] = "rows"  # or "days": the day and the one before; "dates": the dates of all rows
    severity: str = "error"
    where: str | None = None

    def __init_subclass__(cls) -> None:
        if "name" in cls.__dict__:
            RULES[cls.name] = cls

    def faults(self) -> Iterator[str]:
        if self.severity not in ("error", "warn"):
            yield f"severity {self.severity!r} is neither error nor warn"

    @property
    def parameters(self) -> dict[str, Any]:
        return {f.name: getattr(self, f.name) for f in fields(self) if f.name not in ("severity", "where")}

    @property
    def subject(self) -> str | None:
        """What the label shows of the parameters."""
        return None

    @property
    def key(self) -> str:
        """A label; several tests may share it."""
        return self.name if self.subject is None else f"{self.name}[{self.subject}]"

    def demand(self) -> str:
        return "no violating rows"

    def text(self, table: Table) -> str:
        """What is counted, as an expression."""
        return f"{self.key}: {self.demand()}" + (f" where {self.where}" if self.where else "")

    def measured(self, table: Table) -> tuple[Column, Column] | None:
        """(failed_rows, observed) as aggregates, or None for tests with a plan."""
        return None

    def plan(self, df: DataFrame, table: Table) -> DataFrame:
        """One row (failed_rows, observed), for tests that are not aggregates of the table."""
        raise NotImplementedError(self.name)

    def examples(self, df: DataFrame, table: Table) -> DataFrame | None:
        """Rows that break the rule."""
        return None


def one_row(df: DataFrame, failed: Column, observed: Column) -> DataFrame:
    return df.agg(failed.cast("bigint").alias("failed_rows"), observed.cast("double").alias("observed"))


@dataclass(frozen=True, kw_only=True)
class RowRule(Rule):
    """A test of single rows: it fails with the number of bad ones, or above ``limit`` as a share of all."""

    def bad(self, table: Table) -> Column:
        raise NotImplementedError(self.name)

    @property
    def shown(self) -> list[str]:
        return []

    @property
    def limit(self) -> float | None:
        return None

    def demand(self) -> str:
        return "no violating rows" if self.limit is None else f"null share <= {self.limit}"

    def text(self, table: Table) -> str:
        return str(table.rows(self.where) & self.bad(table)).removeprefix("Column<'").removesuffix("'>")

    def measured(self, table: Table) -> tuple[Column, Column]:
        looked_at = sure(table.rows(self.where))
        n = F.count_if(looked_at & self.bad(table))
        if self.limit is None:
            return n, n.cast("double")
        share = F.try_divide(n.cast("double"), F.count_if(looked_at))
        return F.when(share > float(self.limit), n).otherwise(0), share

    def examples(self, df: DataFrame, table: Table) -> DataFrame:
        return df.where(table.rows(self.where) & self.bad(table)).select(*dict.fromkeys([*table.primary_key, *self.shown]))


@dataclass(frozen=True, kw_only=True)
class ColumnsRule(RowRule):
    columns: list[str]

    @property
    def subject(self) -> str:
        return ",".join(self.columns)

    @property
    def shown(self) -> list[str]:
        return list(self.columns)


@dataclass(frozen=True, kw_only=True)
class ColumnRule(RowRule):
    column: str

    @property
    def subject(self) -> str:
        return self.column

    @property
    def shown(self) -> list[str]:
        return [self.column]

    def or_null(self, bad: Column) -> Column:
        """Bad, or NULL where the test does not ignore it."""
        return sure(bad) if self.ignore_nulls else sure(bad) | F.col(self.column).isNull()


# Names, families, parameters and defaults below are fixed values of the configuration format.


@dataclass(frozen=True, kw_only=True)
class PrimaryKeyNotNull(RowRule):
    name, family, always = "primary_key_not_null", "null_checks", True

    def bad(self, table: Table) -> Column:
        return either([F.col(c).isNull() for c in table.primary_key])


@dataclass(frozen=True, kw_only=True)
class UniqueRule(Rule):
    family = "uniqueness"

    def group(self, table: Table) -> list[str]:
        raise NotImplementedError

    def repeated(self, df: DataFrame, table: Table) -> DataFrame:
        return df.where(table.rows(self.where)).groupBy(*self.group(table)).count().where("count > 1")

    def plan(self, df: DataFrame, table: Table) -> DataFrame:
        n = F.count(F.lit(1))
        return one_row(self.repeated(df, table), n, n)

    def examples(self, df: DataFrame, table: Table) -> DataFrame:
        return self.repeated(df, table)


@dataclass(frozen=True, kw_only=True)
class PrimaryKeyUnique(UniqueRule):
    name, always = "primary_key_unique", True

    def group(self, table: Table) -> list[str]:
        return list(table.primary_key)


@dataclass(frozen=True, kw_only=True)
class RowCountMin(Rule):
    name, family, always = "row_count_min", "consistency", True
    min_rows: int = 0

    def demand(self) -> str:
        return f"row_count > {self.min_rows}"

    def measured(self, table: Table) -> tuple[Column, Column]:
        n = F.count_if(sure(table.rows(self.where)))
        return (n <= int(self.min_rows)).cast("int"), n.cast("double")


@dataclass(frozen=True, kw_only=True)
class RowCountGrowth(Rule):
    name, family, always, reads = "row_count_growth", "consistency", True, "days"
    max_growth_ratio: float = 0.2
    direction: str = "both"

    def faults(self) -> Iterator[str]:
        yield from super().faults()
        if self.direction not in ("both", "up", "down"):
            yield f"direction {self.direction!r} is neither both, up nor down"

    def demand(self) -> str:
        return f"|growth| <= {self.max_growth_ratio} ({self.direction})"

    def measured(self, table: Table) -> tuple[Column, Column]:
        now, before = (F.count_if(table.day == day(table.on - timedelta(days=back))).cast("double") for back in (0, 1))
        above, below = now > before * (1 + float(self.max_growth_ratio)), now < before * (1 - float(self.max_growth_ratio))
        off = {"both": above | below, "up": above, "down": below}[self.direction]
        return F.when(before == 0, -1).otherwise(off.cast("int")), F.try_divide(now, before) - F.lit(1)


@dataclass(frozen=True, kw_only=True)
class Freshness(Rule):
    name, family, always, reads = "freshness", "recency", True, "dates"
    max_lag_days: int = 2

    def demand(self) -> str:
        return f"lag <= {self.max_lag_days} days"

    def measured(self, table: Table) -> tuple[Column, Column]:
        lag = F.datediff(day(table.on), F.max(table.day))
        return (~sure(lag <= self.max_lag_days)).cast("int"), lag.cast("double")


@dataclass(frozen=True, kw_only=True)
class NotNull(ColumnsRule):
    name, family = "not_null", "null_checks"
    max_null_share: float | None = None

    @property
    def limit(self) -> float | None:
        return self.max_null_share

    def bad(self, table: Table) -> Column:
        return either([F.col(c).isNull() for c in self.columns])


@dataclass(frozen=True, kw_only=True)
class NullShareBelow(ColumnRule):
    name, family = "null_share_below", "null_checks"
    max_share: float

    @property
    def limit(self) -> float:
        return self.max_share

    def bad(self, table: Table) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True, kw_only=True)
class UniqueCombination(UniqueRule):
    name = "unique_combination"
    columns: list[str]

    @property
    def subject(self) -> str:
        return ",".join(self.columns)

    def group(self, table: Table) -> list[str]:
        return list(self.columns)


@dataclass(frozen=True, kw_only=True)
class AcceptedValues(ColumnRule):
    name, family = "accepted_values", "domain_values"
    values: list[Any]
    ignore_nulls: bool = True

    def bad(self, table: Table) -> Column:
        return self.or_null(~F.col(self.column).isin(*self.values))


@dataclass(frozen=True, kw_only=True)
class NotAcceptedValues(ColumnRule):
    name, family = "not_accepted_values", "domain_values"
    values: list[Any]
    ignore_nulls: bool = True

    def bad(self, table: Table) -> Column:
        return sure(F.col(self.column).isin(*self.values))


@dataclass(frozen=True, kw_only=True)
class BoundsRule(Rule):
    min: float | None = None
    max: float | None = None

    def faults(self) -> Iterator[str]:
        yield from super().faults()
        if self.min is None and self.max is None:
            yield "neither min nor max is given"

    def demand(self) -> str:
        return f"{self.min} <= value <= {self.max}"


@dataclass(frozen=True, kw_only=True)
class AcceptedRange(BoundsRule, ColumnRule):
    name, family = "accepted_range", "domain_values"
    min_inclusive: bool = True
    max_inclusive: bool = True
    ignore_nulls: bool = True

    def bad(self, table: Table) -> Column:
        c = F.col(self.column)
        low = F.lit(True) if self.min is None else c >= F.lit(self.min) if self.min_inclusive else c > F.lit(self.min)
        high = F.lit(True) if self.max is None else c <= F.lit(self.max) if self.max_inclusive else c < F.lit(self.max)
        return self.or_null(~(low & high))


@dataclass(frozen=True, kw_only=True)
class NonNegative(ColumnsRule):
    name, family = "non_negative", "domain_values"
    ignore_nulls: bool = True

    def bad(self, table: Table) -> Column:
        return either([sure(F.col(c) < 0) | (F.lit(False) if self.ignore_nulls else F.col(c).isNull()) for c in self.columns])


@dataclass(frozen=True, kw_only=True)
class StringNotBlank(ColumnsRule):
    name, family = "string_not_blank", "domain_values"

    def bad(self, table: Table) -> Column:
        return either([F.coalesce(F.trim(F.col(c)), F.lit("")) == "" for c in self.columns])


@dataclass(frozen=True, kw_only=True)
class DistinctCountBetween(BoundsRule):
    name, family = "distinct_count_between", "consistency"
    columns: list[str]

    @property
    def subject(self) -> str:
        return ",".join(self.columns)

    def plan(self, df: DataFrame, table: Table) -> DataFrame:
        n = F.count(F.lit(1))
        low, high = (F.lit(None) if x is None else F.lit(int(x)) for x in (self.min, self.max))
        return one_row(df.where(table.rows(self.where)).select(*self.columns).distinct(), (sure(n < low) | sure(n > high)).cast("int"), n)


@dataclass(frozen=True, kw_only=True)
class ColumnsSumEquals(RowRule):
    name, family = "columns_sum_equals", "consistency"
    parts: list[str]
    total: str
    tolerance: float = 1e-6

    @property
    def subject(self) -> str:
        return self.total

    @property
    def shown(self) -> list[str]:
        return [*self.parts, self.total]

    def bad(self, table: Table) -> Column:
        return sure(F.abs(reduce(lambda a, b: a + b, map(F.col, self.parts)) - F.col(self.total)) > self.tolerance)


@dataclass(frozen=True, kw_only=True)
class RowCountMatchesReference(Rule):
    name, family = "row_count_matches_reference", "consistency"
    reference_table: str
    reference_date_column: str
    reference_where: str | None = None
    tolerance_ratio: float = 0.0

    @property
    def subject(self) -> str:
        return self.reference_table

    def demand(self) -> str:
        return f"|target/reference - 1| <= {self.tolerance_ratio}"

    def plan(self, df: DataFrame, table: Table) -> DataFrame:
        wanted = F.col(self.reference_date_column).cast("date") == day(table.on)
        other = table.others[self.reference_table].where(wanted & F.expr(self.reference_where) if self.reference_where else wanted)
        # Both counts stacked and added up: nothing has to be joined.
        counts = [rows.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(side).alias("side")) for side, rows in enumerate((df.where(table.rows(self.where)), other))]
        n, m = (F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0)).cast("double") for side in (0, 1))
        off = F.try_divide(n, m) - F.lit(1)
        return one_row(counts[0].unionByName(counts[1]), F.when(m == 0, -1).otherwise((F.abs(off) > float(self.tolerance_ratio)).cast("int")), off)


@dataclass(frozen=True, kw_only=True)
class ExpressionIsTrue(RowRule):
    name, family = "expression_is_true", "row_expr"
    expression: str

    @property
    def subject(self) -> str:
        return self.expression

    def bad(self, table: Table) -> Column:
        return ~sure(F.expr(self.expression))


@dataclass(frozen=True, kw_only=True)
class Relationships(Rule):
    """``where`` filters the parent table here."""

    name, family = "relationships", "referential_integrity"
    column: str
    to_table: str
    to_column: str

    @property
    def subject(self) -> str:
        return self.column

    @property
    def parameters(self) -> dict[str, Any]:
        return {**super().parameters, "where": self.where}

    def without_parent(self, rows: DataFrame, table: Table) -> DataFrame:
        parent = table.others[self.to_table].where(self.where or "true")
        return rows.join(parent.select(F.col(self.to_column).alias(self.column)).distinct(), self.column, "left_anti")

    def children(self, df: DataFrame, table: Table) -> DataFrame:
        return df.where(table.rows(None) & F.col(self.column).isNotNull())

    def plan(self, df: DataFrame, table: Table) -> DataFrame:
        # Counted per value before the anti join: a value that fills the table is one row.
        counted = self.children(df, table).groupBy(self.column).agg(F.count(F.lit(1)).alias("_n"))
        n = F.coalesce(F.sum("_n"), F.lit(0))
        return one_row(self.without_parent(counted, table), n, n)

    def examples(self, df: DataFrame, table: Table) -> DataFrame:
        return self.without_parent(self.children(df, table), table).select(*dict.fromkeys([*table.primary_key, self.column]))


def rule_from(entry: Mapping[str, Any]) -> Rule:
    """A test from its configuration; says all that is wrong with it."""
    kind = RULES.get(entry.get("name"))
    if kind is None:
        raise DqConfigError(f"no test is named {entry.get('name')!r}; there are {', '.join(sorted(RULES))}")
    given = {k: v for k, v in entry.items() if k not in ("name", "enabled")}
    own = {f.name: f.default is MISSING for f in fields(kind)}
    faults = [f"{k!r} is not a parameter" for k in given.keys() - own.keys()] + [f"{k!r} is missing" for k, needed in own.items() if needed and k not in given]
    rule = None if faults else kind(**given)
    if faults := faults or list(rule.faults()):
        raise DqConfigError(f"{kind.name}: " + "; ".join(sorted(faults)))
    return rule
