"""Data checks: each returns its violations as a DataFrame, empty when the data is sound."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.tables import materialise, rebuild

N = "n_records"


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs do not count."""
    present = df.filter(F.col(column).isNotNull())
    return unique_combination(present, [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once; NULL is a value like any other."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(N)).filter(F.col(N) > 1)


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Values outside the list with their number of rows; NULL passes."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(N))
    )


def relationships(df: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Values without a parent row, with their number of rows.

    Children are counted per value before the join, so a frequent value travels as one row.
    """
    values = (
        df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(N))
    )
    return values.join(parent.select(F.col(field).alias(column)), column, "left_anti")


@dataclass(frozen=True)
class Check:
    """A named check. Those that carry their source share passes over it: checks of single rows
    by their condition, checks of keys by the key's columns, and checks for a parent row, which
    count children where the parent's key is counted anyway."""

    name: str
    violations: DataFrame
    severity: str = "error"
    source: DataFrame | None = None
    condition: Column | None = None
    per_value: bool = False  # violations are values with their number of rows
    key: tuple[str, ...] = ()
    null_counts: bool = True  # NULL is a value of the key like any other
    parent: DataFrame | None = None  # rows of `source` have theirs here, by key[0] = field
    field: str = ""

    def failures(self) -> Column:
        if self.per_value:
            return F.coalesce(F.sum(N), F.lit(0)).cast("bigint")
        return F.count(F.lit(1))


def row_check(
    name: str, df: DataFrame, condition: Column, severity: str = "error", columns: list[str] = ()
) -> Check:
    failing = df.filter(condition)
    return Check(name, failing.select(*columns) if columns else failing, severity, df, condition)


def not_null_check(name: str, df: DataFrame, column: str) -> Check:
    return row_check(name, df, F.col(column).isNull())


def unique_check(name: str, df: DataFrame, column: str, severity: str = "error") -> Check:
    return Check(
        name, unique(df, column), severity, df, key=(column,), null_counts=False
    )


def unique_combination_check(
    name: str, df: DataFrame, columns: list[str], severity: str = "error"
) -> Check:
    return Check(name, unique_combination(df, columns), severity, df, key=tuple(columns))


def relationships_check(
    name: str, df: DataFrame, column: str, parent: DataFrame, field: str, severity: str = "error"
) -> Check:
    return Check(
        name, relationships(df, column, parent, field), severity, df, per_value=True,
        key=(column,), parent=parent, field=field,
    )


def _by_key(
    checks: list[Check],
) -> tuple[list[tuple[Check, list[Check]]], list[Check]]:
    """Each check of a key with the checks for a parent row that its grouping answers; the rest.

    Children are grouped with their parent's key if both are of one type, as values of
    different types are equal by the rules of a join.
    """
    keyed = {}
    for check in checks:
        if check.key and check.parent is None:
            keyed.setdefault((id(check.source), check.key), (check, []))
    rest = []
    for check in checks:
        unique_one = keyed.get((id(check.source), check.key), (None,))[0]
        at = keyed.get((id(check.parent), (check.field,)))
        if check is unique_one:
            continue
        if check.parent is not None and at and (
            check.source.schema[check.key[0]].dataType
            == check.parent.schema[check.field].dataType
        ):
            at[1].append(check)
        else:
            rest.append(check)
    return list(keyed.values()), rest


def _grouped(check: Check, children: list[Check], conditions: list[Column] = ()) -> DataFrame:
    """One row for each value of a check's key: its rows, those of each condition, and of each
    child. A frequent value leaves a task as one row."""
    counts = [N, *[f"_f{i}" for i in range(len(conditions))]]
    counts += [f"_c{i}" for i in range(len(children))]
    names = [f"_k{i}" for i in range(len(check.key))]
    own = [F.when(c, 1).otherwise(0) for c in conditions]

    def rows(df: DataFrame, key: tuple[str, ...], values: dict[str, Column]) -> DataFrame:
        return df.select(
            *[F.col(c).alias(k) for c, k in zip(key, names)],
            *[values.get(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        )

    both = rows(check.source, check.key, {N: F.lit(1), **{f"_f{i}": c for i, c in enumerate(own)}})
    for i, child in enumerate(children):
        present = child.source.filter(F.col(child.key[0]).isNotNull())
        both = both.unionByName(rows(present, child.key, {f"_c{i}": F.lit(1)}))
    return both.groupBy(*names).agg(*[F.sum(c).alias(c) for c in counts])


def _repeated(check: Check) -> Column:
    repeated = F.col(N) > 1
    return repeated if check.null_counts else repeated & F.col("_k0").isNotNull()


def check_summary(
    checks: list[Check], known: dict[str, int] | None = None, in_turn: bool = False
) -> DataFrame:
    """One row per check: failing rows and pass, or the severity of the failure.

    Checks of single rows share one pass over their source, with the check of its key if there is
    one; a check for parent rows is part of the grouping of the parent's key. Every other check
    reads the columns it needs and reduces them before anything is shuffled. `known` has the failing rows of checks
    that were counted while their table was written: these scan nothing.

    The summary is lazy, and run as one query it shuffles the keys of all tables at the same time.
    With `in_turn` it is computed now, one pass after the other, so that the disk holds the keys of
    one table at a time.
    """
    parts = _summaries(checks, known or {})
    return materialise(parts, "check-summary") if in_turn else reduce(DataFrame.unionByName, parts)


def _summaries(checks: list[Check], known: dict[str, int]) -> list[DataFrame]:
    """The summary in parts, one for each pass."""

    def rows(name: str, severity: str, failures: str | Column) -> Column:
        failures = F.col(failures) if isinstance(failures, str) else failures
        return F.struct(
            F.lit(name).alias("check_name"),
            F.lit(severity).alias("severity"),
            failures.alias("failures"),
            F.when(failures > 0, severity).otherwise("pass").alias("status"),
        )

    by_source: dict[int, list[Check]] = {}
    parts = []
    told = [c for c in checks if c.name in known]
    if told:
        listed = [rows(c.name, c.severity, F.lit(known[c.name]).cast("bigint")) for c in told]
        one = told[0].violations.sparkSession.range(1)
        parts.append(one.select(F.explode(F.array(*listed)).alias("r")))
    keyed, rest = _by_key([c for c in checks if c.name not in known])
    for check in rest:
        if check.condition is not None:
            by_source.setdefault(id(check.source), []).append(check)
            continue
        counted = check.violations.agg(check.failures().alias("failures"))
        parts.append(counted.select(rows(check.name, check.severity, "failures").alias("r")))
    for check, children in keyed:
        group = by_source.pop(id(check.source), [])
        listed = [check, *group, *children]
        orphans = [F.when(F.col(N) == 0, F.col(f"_c{i}")).otherwise(0) for i in range(len(children))]
        counted = _grouped(check, children, [c.condition for c in group]).agg(
            F.count_if(_repeated(check)).alias("f0"),
            *[
                F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(f"f{i}")
                for i, c in enumerate([*[f"_f{i}" for i in range(len(group))], *orphans], 1)
            ],
        )
        listed = [rows(c.name, c.severity, f"f{i}") for i, c in enumerate(listed)]
        parts.append(counted.select(F.explode(F.array(*listed)).alias("r")))
    for group in by_source.values():
        counted = group[0].source.agg(
            *[F.count_if(c.condition).alias(f"f{i}") for i, c in enumerate(group)]
        )
        listed = [rows(c.name, c.severity, f"f{i}") for i, c in enumerate(group)]
        parts.append(counted.select(F.explode(F.array(*listed)).alias("r")))
    return [part.select("r.*") for part in parts]


def failures(checks: list[Check]) -> DataFrame:
    """(check_name, severity, n, record) of all violations; `record` is the failing row as JSON.

    Checks of single rows share one scan per source: a row is tagged with every check it fails.
    Values of a key and children without their parent share one grouping.
    `n` is the number of rows that a record stands for. Summed by check it is the summary's count.
    """
    return reduce(DataFrame.unionByName, _violations(checks))


def _violations(checks: list[Check]) -> list[DataFrame]:
    """The violations in parts, one for each pass."""
    by_source: dict[int, list[Check]] = {}
    parts = []
    one = F.lit(1).cast("bigint")
    keyed, rest = _by_key(checks)
    for check, children in keyed:
        if not children:
            rest.append(check)
            continue

        def failed(c: Check, when: Column, n: Column, records: Column) -> Column:
            record = F.to_json(F.struct(F.col("_k0").alias(c.key[0]), n.alias(N)))
            return F.when(
                when,
                F.struct(
                    F.lit(c.name).alias("check_name"),
                    F.lit(c.severity).alias("severity"),
                    records.alias("n"),
                    record.alias("record"),
                ),
            )

        found = [failed(check, _repeated(check), F.col(N), one)]
        for i, child in enumerate(children):
            count = F.col(f"_c{i}")
            found.append(failed(child, (F.col(N) == 0) & (count > 0), count, count))
        grouped = _grouped(check, children)
        parts.append(
            grouped.select(F.explode(F.array_compact(F.array(*found))).alias("r")).select("r.*")
        )
    for check in rest:
        if check.condition is not None:
            by_source.setdefault(id(check.source), []).append(check)
            continue
        parts.append(
            check.violations.select(
                F.lit(check.name).alias("check_name"),
                F.lit(check.severity).alias("severity"),
                (F.col(N).cast("bigint") if check.per_value else one).alias("n"),
                F.to_json(F.struct("*")).alias("record"),
            )
        )
    for group in by_source.values():
        source = group[0].source
        tags = F.array(
            *[
                F.when(c.condition, F.struct(F.lit(c.name).alias("name"), F.lit(c.severity).alias("of")))
                for c in group
            ]
        )
        # the condition first, so that a scan can drop the sound rows by it
        failing = reduce(lambda a, b: a | b, [F.coalesce(c.condition, F.lit(False)) for c in group])
        parts.append(
            source.where(failing)
            .select(F.to_json(F.struct("*")).alias("record"), F.explode(F.array_compact(tags)).alias("t"))
            .select(F.col("t.name").alias("check_name"), F.col("t.of").alias("severity"), one.alias("n"), "record")
        )
    return parts


def store_failures(checks: list[Check], folder: str) -> DataFrame:
    """Write the violations of all checks as one table, partitioned by the check's name: one pass
    after the other, so that the disk holds the keys of one table at a time."""
    return rebuild(_violations(checks), folder, "check_name")
