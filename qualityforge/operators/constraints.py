"""Evaluate rules with as few passes as the data allows.

The number of jobs does not grow with the number of rules:

* all row rules of a table become one map-side aggregate over one scan,
* all keyed rules of an entity become one aggregation per key. The tables are
  stacked (not joined), so partial aggregation shrinks each before the single
  shuffle and a heavy key arrives as one partial row per task,
* a monotonic rule is one ordered scan.

The few numbers that come out (one or two per rule) make the report. When the
joint job fails, the rules are halved until the failing ones stand alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException, PySparkException, PythonException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualityforge import runtime
from qualityforge.operators.ordered import Skew, not_increasing
from qualityforge.operators.rules import KeyedInput, KeyedRule, Lookup, Measure, MonotonicRule, RowRule, Rule

Tables = Mapping[str, DataFrame]

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("constraint_code", T.StringType()),
        T.StructField("constraint_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("total_checked", T.LongType()),
        T.StructField("violation_count", T.LongType()),
        T.StructField("pass_rate", T.DoubleType()),
        T.StructField("status", T.StringType()),
    ]
)


@dataclass(frozen=True)
class ConstraintReport:
    """``results``: one row per rule. ``ledger``: distinct (entity_id, code)."""

    results: DataFrame
    ledger: DataFrame


# ------------------------------------------------------------------ row rules


def _row_frames(rules: Sequence[RowRule]) -> dict[str, list[RowRule]]:
    by_table: dict[str, list[RowRule]] = {}
    for r in rules:
        by_table.setdefault(r.table, []).append(r)
    return by_table


def _metrics(row: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """One-row frame to (metric, value) rows."""
    items = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("long").alias("value")) for m, c in names.items()]
    return row.select(F.inline(F.array(*items)))


def _row_metrics(df: DataFrame, table: str, rules: Sequence[RowRule]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    names = {f"rows:{table}": "n"}
    for i, r in enumerate(rules):
        aggs.append(F.count_if(F.expr(r.violates)).alias(f"v{i}"))
        names[f"bad:{r.code}"] = f"v{i}"
    return _metrics(df.agg(*aggs), names)


def _row_ledger(df: DataFrame, rules: Sequence[RowRule]) -> DataFrame:
    """One scan: only violating rows survive, each expanded to its codes."""
    by_key: dict[str, list[RowRule]] = {}
    for r in rules:
        by_key.setdefault(r.key, []).append(r)
    frames = []
    for key, group in by_key.items():
        # NULL OR TRUE is TRUE and a filter drops NULL: plain predicates reach the scan.
        any_bad = reduce(lambda a, b: a | b, [F.expr(r.violates) for r in group])
        codes = F.array(*[F.when(F.expr(r.violates), F.lit(r.code)) for r in group])
        frames.append(
            df.filter(any_bad).select(F.col(key).alias("entity_id"), F.explode(F.array_compact(codes)).alias("code"))
        )
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- keyed rules


class _Entity:
    """All keyed rules over one key: one stacked aggregation, many conditions."""

    def __init__(self, rules: Sequence[KeyedRule], tables: Tables, sized: bool = True):
        self.rules = list(rules)
        self.sized = sized  # whether dictionaries are measured before the join
        self.tables = tables
        self.names: dict[tuple, str] = {}  # (table, keys, lookup, how, expr) -> column
        self.parts: dict[tuple, list[Lookup]] = {}  # (table, keys) -> dictionaries
        for rule in self.rules:
            for part in rule.inputs:
                lookups = self.parts.setdefault((part.table, part.keys), [])
                if part.lookup and part.lookup not in lookups:
                    lookups.append(part.lookup)
                for m in part.measures.values():
                    self.names.setdefault(self._id(part, m), f"m{len(self.names)}")
        width = {len(keys) for _, keys in self.parts}
        if len(width) != 1:
            raise ValueError(f"keys of entity {self.rules[0].entity!r} differ in width")
        self.key_cols = [f"k{i}" for i in range(width.pop())]

    @staticmethod
    def _id(part: KeyedInput, m: Measure) -> tuple:
        return part.table, part.keys, part.lookup, m.how, m.expr

    def _branch(self, table: str, keys: tuple[str, ...], lookups: list[Lookup]) -> DataFrame:
        """One scan of a table, whatever the number of rules that read it."""
        df = self.tables[table]
        for i, lk in enumerate(lookups):
            side = self.tables[lk.table].select(
                F.col(lk.key).alias(f"__lk{i}"),
                *[F.col(c).alias(lk.prefix + c) for c in lk.columns],
                F.lit(True).alias(lk.prefix + "found"),
            )
            small = self.sized and runtime.fits_broadcast(side)
            side = side.dropDuplicates([f"__lk{i}"])
            df = df.join(F.broadcast(side) if small else side, F.col(lk.on) == F.col(f"__lk{i}"), "left")
        cols = [F.expr(f"`{k}`").alias(c) for k, c in zip(keys, self.key_cols)]
        for (t, k, _, how, expr), name in self.names.items():
            if (t, k) == (table, keys):
                value = F.expr(expr)
                if how == "count_if":
                    value = F.when(value, F.lit(1)).otherwise(F.lit(0)).cast("long")
                cols.append(value.alias(name))
        cols.append(F.lit(True).alias(f"has_{table}"))
        return df.select(*cols)

    def frame(self) -> DataFrame:
        """One row per key with every measure and presence flag."""
        stacked = reduce(
            lambda a, b: a.unionByName(b, allowMissingColumns=True), [self._branch(t, k, lookups) for (t, k), lookups in self.parts.items()],
        )
        aggs = []
        for (_, _, _, how, _), name in self.names.items():
            fn = {"sum": F.sum, "count_if": F.sum, "max": F.max, "min": F.min}[how]
            aggs.append(fn(name).alias(name))
        for table in {t for t, _ in self.parts}:
            aggs.append(F.coalesce(F.max(f"has_{table}"), F.lit(False)).alias(f"has_{table}"))
        return stacked.groupBy(*self.key_cols).agg(*aggs)

    @property
    def _no_null(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in self.key_cols])

    def violation(self, rule: KeyedRule) -> Column:
        names = {f"has_{t}": f"has_{t}" for t, _ in self.parts}
        for part in rule.inputs:
            for alias, m in part.measures.items():
                names[alias] = self.names[self._id(part, m)]
        names["is_null_key"] = "(" + " OR ".join(f"{k} IS NULL" for k in self.key_cols) + ")"
        cond = F.expr(rule.violates.format(**names))
        for t in rule.requires:
            cond = F.col(f"has_{t}") & cond
        return cond if rule.null_key else self._no_null & cond

    def metrics(self) -> DataFrame:
        aggs, names = [], {}
        for i, r in enumerate(self.rules):
            aggs.append(F.count_if(self.violation(r)).alias(f"v{i}"))
            names[f"bad:{r.code}"] = f"v{i}"
        for i, table in enumerate(sorted({t for t, _ in self.parts})):
            aggs.append(F.count_if(F.col(f"has_{table}") & self._no_null).alias(f"n{i}"))
            names[f"keys:{self.rules[0].entity}:{table}"] = f"n{i}"
        return _metrics(self.frame().agg(*aggs), names)

    def ledger(self) -> DataFrame:
        if len(self.key_cols) != 1:
            raise ValueError("a ledger needs a single-column key")
        codes = F.array(*[F.when(self.violation(r), F.lit(r.code)) for r in self.rules])
        return (
            self.frame()
            .select(F.col(self.key_cols[0]).alias("entity_id"), F.array_compact(codes).alias("codes"))
            .filter(F.size("codes") > 0)
            .select("entity_id", F.explode("codes").alias("code"))
        )


def _entities(rules: Sequence[KeyedRule], tables: Tables) -> list[_Entity]:
    by_entity: dict[str, list[KeyedRule]] = {}
    for r in rules:
        by_entity.setdefault(r.entity, []).append(r)
    return [_Entity(rs, tables) for rs in by_entity.values()]


# ------------------------------------------------------------ monotonic rules


def monotonic_violations(rule: MonotonicRule, df: DataFrame) -> DataFrame:
    if rule.where:
        df = df.filter(rule.where)
    return not_increasing(df, list(rule.group), list(rule.order), rule.value, rule.skew)


# ----------------------------------------------------------------- evaluation


def analysis_error(rule: Rule, tables: Tables) -> str | None:
    """Why a rule cannot run on these tables (missing table or column, an
    expression that does not resolve), or None. The finished frame of the rule is
    analysed; no data is read."""
    try:
        if isinstance(rule, RowRule):
            tables[rule.table].select(F.expr(rule.violates), F.col(rule.key)).schema
            _row_metrics(tables[rule.table], rule.table, [rule]).schema
        elif isinstance(rule, KeyedRule):
            _Entity([rule], tables, sized=False).metrics().schema
        else:
            df = tables[rule.table]
            df = df.filter(rule.where) if rule.where else df
            not_increasing(df, list(rule.group), list(rule.order), rule.value, Skew(enabled=False)).select(rule.key).schema
        if rule.scope and not rule.scope.startswith("keys:"):
            tables[rule.scope].schema
    except KeyError as e:
        return f"missing table {e}"
    except AnalysisException as e:
        return str(e).splitlines()[0]
    return None


def _scope_metric(rule: Rule) -> str:
    scope = rule.scope or rule.table
    if scope.startswith("keys:"):
        return f"keys:{rule.entity}:{scope[5:]}"
    return f"rows:{scope}"


def metric_rows(rules: Sequence[Rule], tables: Tables) -> DataFrame | None:
    """(metric, value): counts of rules and of the scopes they name, in one job."""
    metrics: list[DataFrame] = []
    by_table = _row_frames([r for r in rules if isinstance(r, RowRule)])
    scopes = {m[5:] for m in map(_scope_metric, rules) if m.startswith("rows:")}
    for table in sorted(scopes | set(by_table)):
        if table in tables:
            metrics.append(_row_metrics(tables[table], table, by_table.get(table, [])))
    for e in _entities([r for r in rules if isinstance(r, KeyedRule)], tables):
        metrics.append(e.metrics())
    for r in rules:
        if isinstance(r, MonotonicRule):
            bad = monotonic_violations(r, tables[r.table]).agg(F.count(F.lit(1)).alias("v"))
            metrics.append(_metrics(bad, {f"bad:{r.code}": "v"}))
    return reduce(DataFrame.unionByName, metrics) if metrics else None


# Classes of SQLSTATE that blame the statement or its data: cardinality, data exception,
# failing function, name or syntax.
_RULE_STATES = ("21", "22", "38", "39", "42")


def rule_fault(e: PySparkException) -> bool:
    """Whether an error comes from a rule's expression and not from where it ran."""
    if isinstance(e, AnalysisException | PythonException):
        return True
    return (e.getSqlState() or "")[:2] in _RULE_STATES


def _isolated(rules: Sequence[Rule], tables: Tables) -> tuple[dict[str, int | None], dict[str, str]]:
    """Counts, and the message of every rule that fails while it runs.

    All rules run together; only when that job fails for a reason that lies in a rule
    are they halved until the culprits stand alone. Any other failure surfaces: a lost
    executor or a missing file says nothing about the rules.
    """
    if not rules:
        return {}, {}
    try:
        rows = metric_rows(rules, tables)
        # A few numbers per rule.
        return ({} if rows is None else {r["metric"]: r["value"] for r in rows.collect()}), {}
    except PySparkException as e:
        if not rule_fault(e):
            raise
        if len(rules) == 1:
            return {}, {rules[0].code: str(e).splitlines()[0]}
    counts, errors = {}, {}
    for half in (rules[: len(rules) // 2], rules[len(rules) // 2 :]):
        found, failed = _isolated(half, tables)
        counts.update(found)
        errors.update(failed)
    return counts, errors


def _scope_sizes(rules: Sequence[Rule], tables: Tables) -> dict[str, int]:
    """Rows of the table scopes named by rules that could not run."""
    names = {m[5:] for m in map(_scope_metric, rules) if m.startswith("rows:")}
    return {f"rows:{t}": tables[t].count() for t in names if t in tables}


def _evaluated(rules: Sequence[Rule], tables: Tables) -> tuple[DataFrame, set[str]]:
    errors = {r.code: e for r in rules if (e := analysis_error(r, tables)) is not None}
    counts, failed = _isolated([r for r in rules if r.code not in errors], tables)
    errors.update(failed)
    counts = _scope_sizes([r for r in rules if r.code in errors], tables) | counts
    rows = []
    for r in rules:
        total, bad = counts.get(_scope_metric(r)), counts.get(f"bad:{r.code}")
        if r.code in errors:
            rows.append((r.code, r.name, False, total, None, 0.0, "ERROR"))
        else:
            rate = (total - bad) * 100.0 / total if total else 100.0
            rows.append((r.code, r.name, bad == 0, total, bad, rate, "FAIL" if bad else "PASS"))
    return SparkSession.active().createDataFrame(rows, RESULT_SCHEMA), set(errors)


def evaluate(rules: Sequence[Rule], tables: Tables) -> DataFrame:
    """One report row per rule, in the order given (see RESULT_SCHEMA).

    ``pass_rate = (total - violations) * 100 / total``, 100 for an empty scope. A
    rule that cannot be analysed, or that fails while it runs, is reported with
    status ERROR, pass rate 0 and no violation count; the others are not affected.
    """
    return _evaluated(rules, tables)[0]


def run_verdict(results: DataFrame) -> DataFrame:
    """All-pass flag and the lowest pass rate (0-100); an empty report passes."""
    return results.agg(
        F.coalesce(F.bool_and(F.col("pass_rate") >= 100.0), F.lit(True)).alias("passed"),
        F.coalesce(F.min("pass_rate"), F.lit(100.0)).alias("overall_score"),
    )


def violation_ledger(rules: Sequence[Rule], tables: Tables, distinct: bool = True) -> DataFrame:
    """Distinct (entity_id, code) of every violation the rules find.

    Rules that cannot be analysed are skipped, as a filter cannot act on them.
    """
    good = [r for r in rules if analysis_error(r, tables) is None]
    frames = [_row_ledger(tables[t], rs) for t, rs in _row_frames([r for r in good if isinstance(r, RowRule)]).items()]
    frames += [e.ledger() for e in _entities([r for r in good if isinstance(r, KeyedRule)], tables)]
    for r in good:
        if isinstance(r, MonotonicRule):
            frames.append(
                monotonic_violations(r, tables[r.table]).select(
                    F.col(r.key).alias("entity_id"), F.lit(r.code).alias("code")
                )
            )
    if not frames:
        return SparkSession.active().createDataFrame([], "entity_id long, code string")
    out = reduce(DataFrame.unionByName, frames)
    return out.distinct() if distinct else out


def check(rules: Sequence[Rule], tables: Tables) -> ConstraintReport:
    """Report and ledger of the same rules; rules in error have no ledger entries."""
    results, errors = _evaluated(rules, tables)
    return ConstraintReport(results, violation_ledger([r for r in rules if r.code not in errors], tables))
