"""Quality rules. Each finds the violating rows; a summary counts them.

Rules on single rows are counted together in one scan of the table. Rules
on groups shuffle only the key columns, combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.convert import to_bigint
from terrace.functions.text import has_outer_blanks, is_present, text_length
from terrace.operators.history import next_in_key
from terrace.operators.joins import key_combinations, with_known
from terrace.operators.joins import unconnected as unconnected_rows

# The allowed results of a check.
PASS, WARN, FAIL = "Pass", "Warn", "Fail"
# The accepted range of a raw yyyymmdd date and of a birth date.
COMPACT_RANGE = (19000101, 20500101)
EARLIEST_BIRTH = date(1924, 1, 1)


@dataclass(frozen=True)
class Rule:
    """Either ``broken``, which makes a test of one row, or ``find``, a query.

    Both are called when the rule runs, so rules can be listed beforehand.
    """

    name: str
    broken: Callable[[], Column] | None = None
    find: Callable[[DataFrame], DataFrame] | None = None
    severity: str = FAIL
    weight: str | None = None  # the column of `find` that counts rows, where one row stands for several

    def violations(self, df: DataFrame) -> DataFrame:
        return df.filter(self.broken()) if self.find is None else self.find(df)


@dataclass(frozen=True)
class RuleSet:
    """Rules that are counted together: ``count`` gives test_name, _severity, failed_row_count, details."""

    count: Callable[[DataFrame], DataFrame]


def duplicates(df: DataFrame, columns: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Each value combination that occurs more than once, NULL being a value."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)).filter(F.col(name) > 1)


def null_or_duplicate(df: DataFrame, columns: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Keys that occur more than once or are NULL."""
    missing = F.lit(False)
    for c in columns:
        missing |= F.col(c).isNull()
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))
    return counted.filter((F.col(name) > 1) | missing)


def domain(df: DataFrame, *columns: str) -> DataFrame:
    """The distinct values, or value combinations, that occur."""
    return df.select(*columns).distinct()


def not_null(c: str) -> Rule:
    return Rule(f"not_null_{c}", lambda: F.col(c).isNull())


def unique(c: str) -> Rule:
    return Rule(f"unique_{c}", find=lambda df: duplicates(df.filter(F.col(c).isNotNull()), [c]))


def unique_together(*columns: str) -> Rule:
    return Rule(f"unique_{'_'.join(columns)}", find=lambda df: duplicates(df, columns))


def unique_where_present(*columns: str) -> Rule:
    """Natural key: unique among rows where every part is present."""

    def find(df: DataFrame) -> DataFrame:
        return duplicates(df.dropna(how="any", subset=list(columns)), columns)

    return Rule(f"natural_key_{'_'.join(columns)}", find=find)


def primary_key(*columns: str) -> Rule:
    return Rule(f"primary_key_{'_'.join(columns)}", find=lambda df: null_or_duplicate(df, columns))


def surrogate_key(c: str) -> Rule:
    return Rule(f"surrogate_key_{c}", find=lambda df: duplicates(df, [c]))


def related(c: str, parent: DataFrame, key: str, severity: str = FAIL) -> Rule:
    """Every non-NULL value exists in the parent. One row per orphaned value, with its number of rows.

    Values are counted before the join, so a frequent one costs one row; what
    fails are the rows.
    """

    def find(df: DataFrame) -> DataFrame:
        used = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("row_count"))
        known = parent.select(F.col(key).alias("_parent_key"))
        return used.join(known, used[c] == known["_parent_key"], "left_anti")

    return Rule(f"related_{c}", find=find, severity=severity, weight="row_count")


def _any(tests: Sequence[Column]) -> Column:
    """True when some test is; a test that is NULL does not count."""
    return reduce(or_, [F.coalesce(t, F.lit(False)) for t in tests], F.lit(False))


def no_outer_blanks(*columns: str) -> Rule:
    return Rule(
        f"no_outer_blanks_{'_'.join(columns)}",
        lambda: _any([has_outer_blanks(F.col(c)) for c in columns]),
    )


def not_negative(c: str) -> Rule:
    return Rule(f"not_negative_{c}", lambda: F.col(c).isNull() | (F.col(c) < 0))


def ends_after_start(start: str, end: str) -> Rule:
    return Rule(f"ends_after_start_{end}", lambda: F.col(end) < F.col(start))


def valid_compact_date(c: str) -> Rule:
    """Raw yyyymmdd, text or integer; a missing value is no violation."""

    def broken() -> Column:
        low, high = COMPACT_RANGE
        number = to_bigint(F.col(c))
        unreadable = F.col(c).isNotNull() & number.isNull()
        return _any([unreadable, number <= 0, text_length(number) != 8, number > high, number < low])

    return Rule(f"valid_date_{c}", broken)


def in_date_order(first: str, *later: str) -> Rule:
    return Rule(f"date_order_{first}", lambda: _any([F.col(first) > F.col(c) for c in later]))


def broken_measures(sales: str, quantity: str, price: str) -> Column:
    s, q, p = F.col(sales), F.col(quantity), F.col(price)
    missing = s.isNull() | q.isNull() | p.isNull()
    return missing | (s != q * p) | (s <= 0) | (q <= 0) | (p <= 0)


def consistent_measures(sales: str, quantity: str, price: str) -> Rule:
    """Distinct offending triples, sorted, where sales is not quantity x price."""
    triple = (sales, quantity, price)
    return Rule(
        f"consistent_{sales}",
        find=lambda df: df.filter(broken_measures(*triple)).select(*triple).distinct().orderBy(*triple),
        severity=WARN,
    )


def date_in_range(c: str, latest: Column, earliest: date = EARLIEST_BIRTH) -> Rule:

    def find(df: DataFrame) -> DataFrame:
        return df.filter((F.col(c) < F.lit(earliest)) | (F.col(c) > latest)).select(c).distinct()

    return Rule(f"in_range_{c}", find=find, severity=WARN)


def accepted_values(c: str, values: Sequence[str]) -> Rule:
    return Rule(f"accepted_{c}", lambda: ~F.col(c).isin(*values))


def converts(raw: str, conversion: Callable[[Column], Column]) -> Rule:
    """A raw value that is present must convert."""
    return Rule(
        f"converts_{raw}",
        lambda: is_present(F.col(raw)) & conversion(F.col(raw)).isNull(),
        severity=WARN,
    )


def connected(dimensions: Sequence[tuple[str, DataFrame, str]], severity: str = WARN) -> Rule:
    name = "connected_" + "_".join(c for c, _, _ in dimensions)
    return Rule(name, find=lambda df: unconnected_rows(df, dimensions), severity=severity)


def relations(
    dimensions: Sequence[tuple[str, DataFrame, str]], delivered: DataFrame | None = None, severity: str = FAIL
) -> RuleSet:
    """``related`` of each dimension, ``connected`` of all, and that there are as many rows as ``delivered``, from one scan.

    The fact is aggregated to its key combinations; all rules are sums over these. More
    or fewer rows than delivered mean that a join has multiplied or lost some.
    """
    columns = [c for c, _, _ in dimensions]

    def count(df: DataFrame) -> DataFrame:
        expected = delivered.count() if delivered is not None else None  # from file footers
        judged = with_known(key_combinations(df, list(dict.fromkeys(columns))), dimensions)
        known = [F.col(f"_known_{i}") for i in range(len(columns))]
        tests = [(f"related_{c}", severity, F.col(c).isNotNull() & ~k, [c]) for c, k in zip(columns, known)]
        tests.append((f"connected_{'_'.join(columns)}", WARN, ~reduce(and_, known), columns))
        sums = [F.sum(F.when(broken, F.col("row_count"))) for _, _, broken, _ in tests]
        shown = [F.min(F.when(broken, told(c))) for _, _, broken, c in tests]
        one = judged.agg(
            F.coalesce(F.sum("row_count"), F.lit(0)).alias("_rows"),
            *[F.coalesce(n, F.lit(0)).alias(f"_n{i}") for i, n in enumerate(sums)], *[d.alias(f"_d{i}") for i, d in enumerate(shown)],
        )
        lines = [_line(name, level, F.col(f"_n{i}"), F.col(f"_d{i}")) for i, (name, level, _, _) in enumerate(tests)]
        if expected is not None:
            apart = F.abs(F.col("_rows") - expected)
            shown = F.when(apart > 0, F.concat(F.col("_rows").cast("string"), F.lit(f" rows of {expected} delivered")))
            lines.append(_line("rows_as_delivered", severity, apart, shown))
        return one.select(F.inline(F.array(*lines)))

    return RuleSet(count)


def no_overlap(
    keys: Sequence[str], start: str, end: str, tie: Sequence[str] = ()
) -> Rule:
    """A version must end before the next one of its key starts."""

    def find(df: DataFrame) -> DataFrame:
        chained = next_in_key(df, keys, [start, *tie], start, "_next_start")
        runs_over = F.col(end).isNull() | (F.col(end) >= F.col("_next_start"))
        return chained.filter(F.col("_next_start").isNotNull() & runs_over).drop("_next_start")

    return Rule(f"no_overlap_{start}", find=find, severity=WARN)


def told(columns: Sequence[str]) -> Column:
    """Columns of a row as text, those that are NULL left out."""
    shown = [F.concat(F.lit(f"{c}="), F.col(f"`{c}`").cast("string")) for c in columns]
    return F.concat_ws(", ", *shown)


def _line(name: str, severity: str, failed: Column, details: Column) -> Column:
    return F.struct(
        F.lit(name).alias("test_name"), F.lit(severity).alias("_severity"), failed.alias("failed_row_count"), details.alias("details")
    )


def summarized(model: str, df: DataFrame, rules: Sequence[Rule | RuleSet], shown: Sequence[str] | None = None) -> DataFrame:
    """One row per rule: model_name, test_name, test_status, failed_row_count, details.

    ``details`` is the smallest of the violating rows' texts, gathered with the count:
    of rules on rows the columns ``shown`` (default: all), of others what they find.
    """
    parts: list[DataFrame] = []
    row_rules = [r for r in rules if isinstance(r, Rule) and r.find is None]
    if row_rules:
        text = told([c for c, t in df.dtypes if t != "binary"] if shown is None else shown)
        # Each test is made once for a row; its count and its details share the outcome.
        tested = df.select("*", *[r.broken().alias(f"_broken{i}") for i, r in enumerate(row_rules)])
        counts = tested.agg(
            *[F.count_if(f"_broken{i}").alias(f"_n{i}") for i in range(len(row_rules))],
            *[F.min(F.when(F.col(f"_broken{i}"), text)).alias(f"_d{i}") for i in range(len(row_rules))],
        )
        lines = [_line(r.name, r.severity, F.col(f"_n{i}"), F.col(f"_d{i}")) for i, r in enumerate(row_rules)]
        parts.append(counts.select(F.inline(F.array(*lines))))
    for r in rules:
        if isinstance(r, RuleSet):
            parts.append(r.count(df))
        elif r.find is not None:
            found = r.violations(df)
            failed = F.coalesce(F.sum(r.weight), F.lit(0)) if r.weight else F.count(F.lit(1))
            text = told([c for c, t in found.dtypes if t != "binary"])
            line = found.agg(failed.alias("_n"), F.min(text).alias("_d"))
            parts.append(line.select(F.inline(F.array(_line(r.name, r.severity, F.col("_n"), F.col("_d"))))))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    status = F.when(F.col("failed_row_count") == 0, PASS).otherwise(F.col("_severity"))
    return every.select(
        F.lit(model).alias("model_name"), "test_name", status.alias("test_status"), "failed_row_count", "details"
    )


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Rows of each (layer, table), counted in one job from file footers."""
    every = None
    for (layer, table), df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("schema_name"), F.lit(table).alias("table_name"), "row_count"
        )
        every = one if every is None else every.unionByName(one)
    return every
