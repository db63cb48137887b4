"""Rule-driven casting, NULL handling and constraint checks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.columns import parse_date
from tierflow.operators.dedup import keep_latest


#: Wide enough for amounts before they are compared.
EXACT = "decimal(28,10)"

Step = Callable[[Column], Column]


class Outcome(NamedTuple):
    """A value as it was read, and whether something was given that could not be read."""

    value: Column
    lost: Column


def reader(type_name: str, formats: Sequence[str] = ()) -> Step:
    """How text becomes a value of a type; NULL where it cannot."""
    if type_name == "date" and formats:
        return lambda text: parse_date(text, formats)
    return lambda text: text.try_cast(type_name)


@dataclass(frozen=True)
class Rule:
    """How one output column is made: the column it comes from, what is done to its text, how that is read.

    ``formats`` only applies to dates.
    """

    target: str
    type: str
    trim: bool = False
    upper: bool = False
    formats: tuple[str, ...] = ()
    source: str | None = None
    steps: tuple[Step, ...] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        wanted = ((self.trim, F.trim), (self.upper, F.upper), (True, reader(self.type, self.formats)))
        object.__setattr__(self, "steps", tuple(step for on, step in wanted if on))

    @property
    def outcome(self) -> Outcome:
        given = F.col(f"`{self.source or self.target}`")
        value = reduce(lambda column, step: step(column), self.steps, given)
        filled = given.isNotNull() & (F.trim(given.cast("string")) != "")
        return Outcome(value, filled & value.isNull())


def _first_of_each(rules: Sequence[Rule]) -> dict[str, Outcome]:
    found: dict[str, Outcome] = {}
    for rule in rules:
        if rule.target not in found:
            found[rule.target] = rule.outcome
    return found


def _lost_names(outcomes: Mapping[str, Outcome]) -> Column:
    return F.array_compact(F.array(*[F.when(o.lost, F.lit(name)) for name, o in outcomes.items()]))


def apply_rules(df: DataFrame, rules: Sequence[Rule], strict: bool = False, mark: str | None = None) -> DataFrame:
    """Output columns are exactly the rule targets. A repeated target keeps its first rule.

    Unreadable values become NULL (an error with ``strict``). ``mark`` names one more column with the
    names of the row's unreadable columns.
    """
    outcomes = _first_of_each(rules)
    columns = []
    for name, (value, lost) in outcomes.items():
        if strict:
            value = F.when(lost, F.raise_error(F.lit(f"unreadable value in {name}"))).otherwise(value)
        columns.append(value.alias(name))
    return df.select(*columns, *([] if mark is None else [_lost_names(outcomes).alias(mark)]))


def unreadable(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows in which some given value was lost by its rule, with the names of these columns."""
    return df.withColumn("_unreadable", _lost_names({r.target: r.outcome for r in rules})).filter(F.size("_unreadable") > 0)


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop a row when any listed column is NULL."""
    return df.dropna(subset=list(columns))


def fill(df: DataFrame, defaults: Mapping[str, object], mark: str | None = None) -> DataFrame:
    """Per-column default for NULL, cast to the column's own type. Columns named in the row's ``mark`` stay
    NULL: something was given there."""
    types = dict(df.dtypes)

    def filled(name: str, default: object) -> Column:
        value = F.coalesce(F.col(name), F.lit(default).cast(types[name]))
        return value if mark is None else F.when(~F.array_contains(mark, name), value)

    return df.withColumns({c: filled(c, v) for c, v in defaults.items()})


@dataclass(frozen=True)
class EntityRules:
    """Everything that defines one cleaned entity."""

    key: str
    rules: tuple[Rule, ...]
    required: tuple[str, ...] = ()
    defaults: Mapping[str, object] | None = None


def clean_entity(raw: DataFrame, entity: EntityRules) -> DataFrame:
    """Cast and rename, keep one row per key, drop rows without required values, fill defaults.

    Only what was missing or blank gets a default; an unreadable value stays NULL. ``rejected`` lists both
    unreadable values and dropped rows.
    """
    df = keep_latest(apply_rules(raw, entity.rules, mark="_lost"), [entity.key])
    if entity.required:
        df = require(df, entity.required)
    if entity.defaults:
        df = fill(df, entity.defaults, "_lost")
    return df.drop("_lost")


def rejected(raw: DataFrame, entity: EntityRules) -> DataFrame:
    """``column, reason, rows`` of what cleaning cannot use: ``unreadable`` values, and ``missing`` keys and
    required values, for which the row is dropped."""
    read = apply_rules(raw, entity.rules, mark="_lost")
    needed = dict.fromkeys([entity.key, *entity.required])
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull() & ~F.array_contains("_lost", c), F.lit(c)) for c in needed]))
    each = read.select(F.explode(F.concat(
        F.transform("_lost", lambda c: F.struct(c.alias("column"), F.lit("unreadable").alias("reason"))),
        F.transform(missing, lambda c: F.struct(c.alias("column"), F.lit("missing").alias("reason"))),
    )).alias("r"))
    return each.groupBy("r.column", "r.reason").agg(F.count("*").alias("rows"))


def check_balance(df: DataFrame, flag: str = "is_balance_valid") -> DataFrame:
    """Add ``closing = opening + credit - debit`` as a flag, tested in decimals that no amount is rounded to."""
    exact = {c: F.col(c).cast(EXACT) for c in
             ("opening_balance", "credit_amount", "debit_amount", "closing_balance")}
    expected = exact["opening_balance"] + exact["credit_amount"] - exact["debit_amount"]
    return df.withColumn(flag, exact["closing_balance"] == expected)


def keep_valid(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """All keys present and the flag true (an unknown flag is not true)."""
    present = reduce(and_, [F.col(k).isNotNull() for k in keys])
    return df.filter(present & F.col(flag))
