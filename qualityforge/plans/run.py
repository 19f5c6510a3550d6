"""Check, profile, filter and score one set of zirconia tables, with appended reports."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge.operators.sampling import check_ratio, key_hash_sample, referential_sample
from qualityforge.presets import zirconia as Z
from qualityforge.sources.reports import RunMeta, append_constraint_report, append_fidelity_report, append_profile

log = logging.getLogger(__name__)
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class RunOptions:
    """``validate`` is the default stage; ``profile`` adds the statistics of the tables,
    ``compliant_path`` the filter, and ``fidelity`` needs ``real`` tables. A ``sample_key`` naming the group column
    samples whole series instead of single samples."""

    database: str
    output_path: str
    real: Tables | None = None
    compliant_path: str | None = None
    validate: bool = False
    fidelity: bool = False
    profile: bool = False
    sample_ratio: float = 1.0
    sample_key: str = Z.KEY
    seed: int = 0
    exact_double: bool = False
    accuracy: int | None = None


def _sampled(tables: Tables, opts: RunOptions) -> dict[str, DataFrame]:
    if opts.sample_ratio == 1:
        return dict(tables)
    if opts.sample_key == Z.KEY:
        return {**tables, **referential_sample(tables, Z.PARENT, Z.KEY, Z.CHILDREN, opts.sample_ratio, opts.seed)}
    kept = key_hash_sample(tables[Z.PARENT], opts.sample_key, opts.sample_ratio, opts.seed)
    children = {c: tables[c].join(kept.select(Z.KEY), Z.KEY, "left_semi") for c in Z.CHILDREN}
    return {**tables, Z.PARENT: kept, **children}


def _rows(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def run_stages(tables: Tables, opts: RunOptions) -> dict[str, object]:
    """Run the requested stages; returns what each produced.

    Violations never fail a run. A stage that raises does not keep the others
    from running; the failures are reported together at the end.
    """
    check_ratio(opts.sample_ratio)
    if opts.fidelity and opts.real is None:
        raise ValueError("fidelity needs the real tables")
    gen = _sampled(tables, opts)
    total = _rows(tables[Z.PARENT])
    sampled = total if opts.sample_ratio == 1 else _rows(gen[Z.PARENT])
    meta = RunMeta(opts.database, total, sampled, opts.sample_ratio)

    def constraints() -> int:
        return append_constraint_report(Z.validate(gen, opts.exact_double), meta, opts.output_path)

    def compliant() -> dict[str, int]:
        counts = Z.save_compliant(gen, opts.compliant_path, opts.exact_double)
        return {r["table"]: r["rows"] for r in counts.collect()}

    def fidelity() -> int:
        return append_fidelity_report(Z.fidelity(opts.real, gen, opts.accuracy), meta, opts.output_path)

    def profile() -> int:
        return append_profile(Z.profile(gen, opts.accuracy), meta, opts.output_path)

    stages = {}
    if opts.validate or not (opts.fidelity or opts.profile):
        stages["hard_constraint"] = constraints
    if opts.profile:
        stages["profile"] = profile
    if opts.compliant_path:
        stages["compliant_filter"] = compliant
    if opts.fidelity:
        stages["fidelity"] = fidelity
    done, failed = {}, {}
    for name, stage in stages.items():
        try:
            done[name] = stage()
        except Exception as e:  # noqa: BLE001 - reported below
            log.exception("stage %s failed for %s", name, opts.database)
            failed[name] = e
    if failed:
        raise RuntimeError(f"failed stage(s): {', '.join(failed)}") from next(iter(failed.values()))
    return done
