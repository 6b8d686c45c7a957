"""Declared table contracts, checked in one aggregation; findings come back as rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    pass


@dataclass(frozen=True)
class Rule:
    """One column rule: 'not_null', 'min', 'in_range' or 'isin'."""

    column: str
    kind: str
    args: tuple = ()

    def broken(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return c.isNull()
        if self.kind == "min":
            return c < F.lit(self.args[0])
        if self.kind == "in_range":
            return (c < F.lit(self.args[0])) | (c > F.lit(self.args[1]))
        if self.kind == "isin":
            return ~c.isin(list(self.args))
        raise ValueError(f"unknown rule {self.kind!r}")


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    rules: tuple[Rule, ...] = ()
    strict: bool = True

    def all_rules(self) -> list[Rule]:
        nulls = [Rule(f.name, "not_null") for f in self.schema if not f.nullable]
        return [*nulls, *self.rules]


def _contract(doubles: list[str], ints: list[str], rules: list[Rule]) -> Contract:
    fields = [T.StructField(c, T.DoubleType(), False) for c in doubles]
    fields += [T.StructField(c, T.IntegerType(), False) for c in ints]
    return Contract(T.StructType(fields), tuple(rules))


def raw_contract(components: int = 28) -> Contract:
    """Anonymous components, a non-negative time and amount, and a 0/1 label."""
    names = [f"V{i}" for i in range(1, components + 1)]
    return _contract(
        [*names, "Time", "Amount"],
        ["Class"],
        [Rule("Time", "min", (0,)), Rule("Amount", "min", (0,)), Rule("Class", "isin", (0, 1))],
    )


def interim_contract(components: int = 28) -> Contract:
    return raw_contract(components)


def processed_contract(components: int = 28) -> Contract:
    """Components plus engineered features; time, amount and label must be gone."""
    names = [f"V{i}" for i in range(1, components + 1)]
    return _contract(
        [*names, "log_amount", "time_sin", "time_cos"],
        [],
        [Rule("time_sin", "in_range", (-1, 1)), Rule("time_cos", "in_range", (-1, 1))],
    )


def coerce(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast every declared column that is present; unparsable values become null."""
    types = {f.name: f.dataType for f in contract.schema}
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """``(rule, column, violations)`` for every declared rule, in one pass over the data.

    Missing and unexpected columns are reported by name with a count of 1. A value that cannot
    be cast to its declared type is reported by the rule 'coercible'.
    """
    declared = {f.name: f.dataType for f in contract.schema}
    missing = [c for c in declared if c not in df.columns]
    extra = [c for c in df.columns if c not in declared] if contract.strict else []
    cast = coerce(df, contract).select(*[F.col(c) for c in df.columns if c in declared])
    raw = df.select(
        *[F.col(c) for c in df.columns if c in declared],
        *[F.col(c).try_cast(t).alias(f"_c_{c}") for c, t in declared.items() if c in df.columns],
    )
    counts: list[tuple[str, str, Column]] = []
    for c in declared:
        if c in df.columns:
            counts.append(("coercible", c, F.count_if(F.col(c).isNotNull() & F.col(f"_c_{c}").isNull())))
    renames = {c: f"_c_{c}" for c in cast.columns}
    for r in contract.all_rules():
        if r.column in renames:
            counts.append((r.kind, r.column, F.count_if(Rule(renames[r.column], r.kind, r.args).broken())))
    fixed = [("missing", c, F.lit(1).cast("bigint")) for c in missing]
    fixed += [("unexpected", c, F.lit(1).cast("bigint")) for c in extra]
    one = raw.agg(*[e.alias(f"_{i}") for i, (_, _, e) in enumerate(counts)]) if counts else None
    structs = [
        F.struct(F.lit(k).alias("rule"), F.lit(c).alias("column"), F.col(f"_{i}").alias("violations"))
        for i, (k, c, _) in enumerate(counts)
    ]
    structs += [F.struct(F.lit(k).alias("rule"), F.lit(c).alias("column"), e.alias("violations")) for k, c, e in fixed]
    base = one if one is not None else df.sparkSession.range(1)
    return base.select(F.inline(F.array(*structs)))


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Coerced table, or an error that names every broken rule."""
    broken = violations(df, contract).where("violations > 0").collect()
    if broken:
        raise ContractError("; ".join(f"{r['column']}: {r['rule']} ({r['violations']})" for r in broken))
    return coerce(df, contract)


@dataclass(frozen=True)
class Expectations:
    """What a source file must look like; ``None`` skips a check."""

    rows: int | None = None
    columns: int | None = None
    sha256: str | None = None
    found: dict = field(default_factory=dict, compare=False)


def expectation_report(df: DataFrame, expected: Expectations, sha256: str | None = None) -> DataFrame:
    """``(check, expected, actual, passed)`` for each check that is not skipped."""
    checks = []
    if expected.rows is not None:
        checks.append(("rows", F.lit(str(expected.rows)), F.col("n").cast("string")))
    if expected.columns is not None:
        checks.append(("columns", F.lit(str(expected.columns)), F.lit(str(len(df.columns)))))
    if expected.sha256 is not None:
        checks.append(("sha256", F.lit(expected.sha256), F.lit(sha256)))
    rows = [
        F.struct(F.lit(name).alias("check"), e.alias("expected"), a.alias("actual"), e.eqNullSafe(a).alias("passed"))
        for name, e, a in checks
    ]
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    if not rows:
        return counted.select(
            F.lit("").alias("check"), F.lit("").alias("expected"), F.lit("").alias("actual"), F.lit(True).alias("passed")
        ).where("false")
    return counted.select(F.inline(F.array(*rows)))


def require(df: DataFrame, expected: Expectations, sha256: str | None = None) -> None:
    failed = expectation_report(df, expected, sha256).where("not passed").collect()
    if failed:
        raise ContractError("; ".join(f"{r['check']}: expected {r['expected']}, got {r['actual']}" for r in failed))
