"""Preset: doped zirconia conductivity tables.

Schemas, dictionaries, the thirteen hard constraints and the nine fidelity
dimensions. Everything here is configuration for the generic operators.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualityforge.functions.scalars import has_column
from qualityforge.operators import rules as R
from qualityforge.operators.compliant import filter_compliant, write_compliant
from qualityforge.operators.constraints import ConstraintReport, check, evaluate
from qualityforge.operators.fidelity import Categorical, FidelityReport, Joint, Numeric, score_fidelity
from qualityforge.operators.normalize import decodable, encode, multiset_groups
from qualityforge.operators.ordered import Skew
from qualityforge.operators.profile import GroupSizes, Leading, Shares, Summary, profile_tables

Tables = Mapping[str, DataFrame]

# --------------------------------------------------------------------------
# Table and column names, dictionaries, limits and weights that
# must equal the published data set's.
# --------------------------------------------------------------------------

PARENT = "material_samples"
KEY = "sample_id"
CHILDREN = ("sample_dopants", "sintering_steps", "sample_crystal_phases")
DICTIONARIES = ("synthesis_method_dict", "processing_route_dict", "crystal_structure_dict")

SYNTHETIC_REFERENCE = "RULE_BASED_SYNTHETIC"
BASE_SAMPLE_ID = 10000001
SAMPLES_PER_GROUP = 8

CRYSTAL_STRUCTURES = [
    (1, "c", "Cubic"),
    (2, "t", "Tetragonal"),
    (3, "m", "Monoclinic"),
    (4, "o", "Orthogonal"),
    (5, "r", "Rhombohedral"),
    (6, "β", "Beta-phase"),
]
SYNTHESIS_METHODS = [
    "/",
    "Commercialization",
    "Coprecipitation",
    "Coprecipitation method",
    "Directional melt crystallization",
    "Glycine method",
    "Hydrothermal synthesis",
    "Sol–gel method",
    "Solid-state synthesis",
]
PROCESSING_ROUTES = [
    "/",
    "3D printing",
    "chemical vapor deposition",
    "cutting and polishing",
    "dry pressing",
    "isostatic pressing",
    "magnetron sputtering",
    "metal-organic chemical vapor deposition",
    "plasma spray deposition",
    "pulsed laser deposition",
    "RF sputtering",
    "spark plasma sintering",
    "spin coating",
    "spray pyrolysis",
    "tape casting",
    "ultrasonic atomization",
    "ultrasonic spray pyrolysis",
    "vacuum filtration",
    "vapor deposition",
]

SOLUBILITY_LIMITS = {"Sc": 0.12, "Ce": 0.18, "Y": 0.25, "Ca": 0.20}
TOTAL_FRACTION_LIMIT = 0.3005
LOW_DOPING, HIGH_DOPING = 0.05, 0.12
CONDUCTIVITY_RANGE = (1e-8, 1.0)
TEMPERATURE_RANGE = (300.0, 1400.0)


def _struct(ddl: str) -> T.StructType:
    types = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(n, types[t]) for n, t in (c.split() for c in ddl.split(","))])


SCHEMAS: dict[str, T.StructType] = {
    "material_samples": _struct(
        "sample_id long,reference string,material_source_and_purity string,synthesis_method_id int,"
        "processing_route_id int,operating_temperature double,conductivity double"
    ),
    "sample_dopants": _struct(
        "sample_id long,dopant_element string,dopant_ionic_radius double,dopant_valence int,dopant_molar_fraction double"
    ),
    "sintering_steps": _struct("sample_id long,step_order int,sintering_temperature double,sintering_duration double"),
    "sample_crystal_phases": _struct("sample_id long,crystal_id int,is_major_phase boolean"),
    "crystal_structure_dict": _struct("id int,code string,full_name string"),
    "synthesis_method_dict": _struct("id int,name string"),
    "processing_route_dict": _struct("id int,name string"),
}


def dictionaries(spark: SparkSession) -> dict[str, DataFrame]:
    """The three dictionary tables."""
    return {
        "crystal_structure_dict": spark.createDataFrame(CRYSTAL_STRUCTURES, SCHEMAS["crystal_structure_dict"]),
        "synthesis_method_dict": spark.createDataFrame(
            list(enumerate(SYNTHESIS_METHODS, 1)), SCHEMAS["synthesis_method_dict"]
        ),
        "processing_route_dict": spark.createDataFrame(
            list(enumerate(PROCESSING_ROUTES, 1)), SCHEMAS["processing_route_dict"]
        ),
    }


# --------------------------------------------------------------- constraints

_FP = "__fp_n"


def resolve_series(tables: Tables) -> tuple[dict[str, DataFrame], R.MonotonicRule, list[str]]:
    """How samples group into conductivity series, and the rule over them.

    In order of preference: the physical group column; the group encoded in the
    ids, if every id is synthetic; otherwise samples with the same method, route
    and dopant set. Returns the tables (with a group column on the parent in the
    last case), the rule and the columns to drop again.
    """
    tables = dict(tables)
    samples = tables[PARENT]
    skew, where, drop = Skew(), None, []
    title = "Monotonicity within recipe group (temp up -> cond up)"
    if has_column(samples, "recipe_group_id"):
        group = ("recipe_group_id",)
    elif decodable(samples, KEY, BASE_SAMPLE_ID, ("reference", SYNTHETIC_REFERENCE)):
        # Every id is at least the first one here, so the integer division rounds down.
        group = (f"(CAST({KEY} AS BIGINT) - {BASE_SAMPLE_ID}) div {SAMPLES_PER_GROUP}",)
    else:
        title = "Monotonicity within derived recipe group (temp up -> cond up)"
        same = multiset_groups(tables["sample_dopants"], KEY, ["dopant_element", "dopant_molar_fraction"], _FP)
        tables[PARENT] = samples.join(same, KEY, "left").select(*samples.columns, _FP)
        group = ("synthesis_method_id", "processing_route_id", _FP)
        where, drop = f"{_FP} IS NOT NULL", [_FP]
    rule = R.MonotonicRule(
        "HC-7", title, PARENT, KEY, group, ("operating_temperature", KEY), "conductivity", where=where, skew=skew
    )
    return tables, rule, drop


def hard_constraints(monotonic: R.MonotonicRule | None = None, exact_double: bool = False) -> list[R.Rule]:
    """The thirteen constraints in report order.

    Fraction sums are compared after rounding to 6 places, so the result does not
    depend on the order of addition; ``exact_double`` compares plain sums.
    """
    scale = None if exact_double else 6
    dop, phases = "sample_dopants", "sample_crystal_phases"
    total = "{total}" if exact_double else "round({total}, 6)"
    series = monotonic or R.MonotonicRule(
        "HC-7",
        "Monotonicity within recipe group (temp up -> cond up)",
        PARENT,
        KEY,
        ("recipe_group_id",),
        ("operating_temperature", KEY),
        "conductivity",
    )
    major = "CAST(is_major_phase AS INT) = 1"
    structure = R.Lookup("crystal_structure_dict", "crystal_id", "id", ("code",), "cs_")
    coupling = R.cross_table_coupling(
        "HC-8",
        "Phase-dopant coupling constraints",
        KEY,
        [
            R.KeyedInput(dop, (KEY,), {"total": R.Measure("sum", "`dopant_molar_fraction`")}),
            R.KeyedInput(
                phases,
                (KEY,),
                {
                    "phases": R.Measure("count_if", "cs_found"),
                    "cubic": R.Measure("count_if", f"cs_code = 'c' AND {major}"),
                    "mono": R.Measure("count_if", f"cs_code = 'm' AND {major}"),
                },
                structure,
            ),
        ],
        f"({total} < {LOW_DOPING}D AND {{phases}} = 1 AND {{cubic}} > 0)"
        f" OR ({total} > {HIGH_DOPING}D AND {{phases}} = 1 AND {{mono}} > 0)",
        PARENT,
    )
    low, high = CONDUCTIVITY_RANGE
    tlow, thigh = TEMPERATURE_RANGE
    return [
        R.row_predicate("HC-1", "All conductivity > 0", PARENT, KEY, "conductivity <= 0"),
        R.row_predicate("HC-2a", "All molar_fraction > 0", dop, KEY, "dopant_molar_fraction <= 0"),
        R.category_cap(
            "HC-2b", "Element-specific solubility limits", dop, KEY, "dopant_element", "dopant_molar_fraction", SOLUBILITY_LIMITS
        ),
        R.group_sum_cap(
            "HC-3", "Total dopant fraction <= 0.30 per sample", dop, KEY, "dopant_molar_fraction", TOTAL_FRACTION_LIMIT,
            scope=PARENT, entity=KEY, scale=scale,
        ),
        R.group_at_least_one(
            "HC-4", "At least one +2 or +3 valence dopant per sample", dop, KEY, "dopant_valence IN (2, 3)",
            scope=PARENT, entity=KEY,
        ),
        R.group_exactly_one(
            "HC-5", "Exactly one major phase per sample", phases, KEY, "is_major_phase", scope=PARENT, entity=KEY
        ),
        R.foreign_key("HC-6a", "All dopant sample_ids exist in material_samples", dop, KEY, PARENT, KEY, entity=KEY),
        R.foreign_key(
            "HC-6b", "All sintering sample_ids exist in material_samples", "sintering_steps", KEY, PARENT, KEY, entity=KEY
        ),
        R.foreign_key("HC-6c", "All phase sample_ids exist in material_samples", phases, KEY, PARENT, KEY, entity=KEY),
        series,
        coupling,
        R.row_range("HC-9", "Conductivity within bounds [1e-8, 1.0]", PARENT, KEY, "conductivity", low, high),
        R.row_range("HC-10", "Operating temperature within [300, 1400]", PARENT, KEY, "operating_temperature", tlow, thigh),
    ]


def schema_constraints() -> list[R.Rule]:
    """Declared keys, NOT NULLs, lengths and references, which nothing enforces
    in a lake."""
    out: list[R.Rule] = [
        R.unique_key("PK-samples", "sample_id is unique", PARENT, [KEY]),
        R.unique_key("PK-phases", "(sample_id, crystal_id) is unique", "sample_crystal_phases", [KEY, "crystal_id"]),
        R.max_length("LEN-element", "dopant_element at most 10 characters", "sample_dopants", KEY, "dopant_element", 10),
    ]
    out += [R.not_null(f"NN-{t}", f"{t}.{KEY} is not null", t, KEY, KEY) for t in CHILDREN]
    for table, column, target in [
        (PARENT, "synthesis_method_id", "synthesis_method_dict"),
        (PARENT, "processing_route_id", "processing_route_dict"),
        ("sample_crystal_phases", "crystal_id", "crystal_structure_dict"),
    ]:
        # A nullable reference: NULL is allowed, unlike a dangling id.
        out.append(
            R.foreign_key(f"FK-{column}", f"{column} exists in {target}", table, column, target, "id", null_key=False)
        )
    return out


def validate(tables: Tables, exact_double: bool = False) -> DataFrame:
    """Report of the hard constraints on one set of tables."""
    tables, rule, _ = resolve_series(tables)
    return evaluate(hard_constraints(rule, exact_double), tables)


def validate_with_ledger(tables: Tables, exact_double: bool = False) -> ConstraintReport:
    tables, rule, _ = resolve_series(tables)
    return check(hard_constraints(rule, exact_double), tables)


def compliant(tables: Tables, exact_double: bool = False) -> dict[str, DataFrame]:
    """The four fact tables reduced to fully compliant samples."""
    tables, rule, drop = resolve_series(tables)
    return filter_compliant(hard_constraints(rule, exact_double), tables, PARENT, KEY, CHILDREN, drop)


def save_compliant(tables: Tables, path: str, exact_double: bool = False) -> DataFrame:
    """Write the compliant facts and the available dictionaries."""
    tables, rule, drop = resolve_series(tables)
    return write_compliant(
        hard_constraints(rule, exact_double), tables, PARENT, KEY, CHILDREN, path, copy=DICTIONARIES, drop=drop
    )


# ------------------------------------------------------------------ fidelity


def fidelity_dimensions() -> list:
    """The nine dimensions; weights sum to one."""
    return [
        Categorical(
            "Synthesis Method", PARENT, "synthesis_method_id", 0.15, dictionary=("synthesis_method_dict", "id", "name")
        ),
        Categorical(
            "Processing Route", PARENT, "processing_route_id", 0.10, dictionary=("processing_route_dict", "id", "name")
        ),
        Categorical("Dopant Element", "sample_dopants", "dopant_element", 0.15),
        Categorical(
            "Crystal Phase (Major)", "sample_crystal_phases", "crystal_id", 0.10, where="CAST(is_major_phase AS INT) = 1"
        ),
        Numeric(
            "log10(Conductivity)", PARENT, "CASE WHEN conductivity > 0 THEN log10(conductivity) END", 0.20,
            where="conductivity > 0",
        ),
        Numeric("Operating Temperature", PARENT, "operating_temperature", 0.10),
        Numeric("Dopant Molar Fraction", "sample_dopants", "dopant_molar_fraction", 0.10),
        Numeric("Sintering Temperature", "sintering_steps", "sintering_temperature", 0.05),
        Joint(
            "Dopant-Conductivity Correlation", PARENT, KEY, "conductivity", "operating_temperature", 700, 900,
            "sample_dopants", KEY, "dopant_element", "dopant_molar_fraction", 0.05, 3,
        ),
    ]


def fidelity(real: Tables, gen: Tables, accuracy: int | None = None) -> FidelityReport:
    """Score generated tables against real ones. The dictionaries of the
    generated side serve both sides; without them ids are compared."""
    shared = {d: gen[d] for d in DICTIONARIES if d in gen}
    bare = {n: df for n, df in real.items() if n not in DICTIONARIES}
    return score_fidelity(fidelity_dimensions(), {**bare, **shared}, gen, accuracy)


# ------------------------------------------------------------------- profile


def profile_statistics() -> list:
    """What a profile of the tables shows, in report order."""
    dopants, phases = "sample_dopants", "sample_crystal_phases"
    return [
        Shares("Dopant element frequency", dopants, "dopant_element"),
        GroupSizes("Dopant count per sample", dopants, KEY),
        Shares("Synthesis method distribution", PARENT, "synthesis_method_id", ("synthesis_method_dict", "id", "name")),
        Shares("Processing route distribution", PARENT, "processing_route_id", ("processing_route_dict", "id", "name")),
        Summary("Conductivity statistics", PARENT, "conductivity", log10=True),
        Summary("Operating temperature statistics", PARENT, "operating_temperature"),
        Leading(
            "Average conductivity by primary dopant", PARENT, KEY, "conductivity", ("operating_temperature", 750, 850),
            dopants, KEY, "dopant_element", "dopant_molar_fraction",
        ),
        Shares("Crystal phase distribution", phases, "concat(coalesce(CAST(crystal_id AS STRING), '-'), ':', coalesce(CAST(is_major_phase AS STRING), '-'))"),
    ]


def profile(tables: Tables, accuracy: int | None = None) -> DataFrame:
    """(statistic, item, measure, value): totals, distributions, group sizes, summaries and
    the leading dopants of one set of tables."""
    return profile_tables(profile_statistics(), tables, accuracy)


# ---------------------------------------------------------------- normalising


def normalise_flat(flat: Tables, dicts: Tables, collation: str | None = None) -> dict[str, DataFrame]:
    """Flat samples with method and route names to the star layout."""
    samples = encode(
        flat[PARENT],
        {
            "synthesis_method": (dicts["synthesis_method_dict"], "synthesis_method_id"),
            "processing_route": (dicts["processing_route_dict"], "processing_route_id"),
        },
        collation=collation,
    )
    out = {PARENT: samples.select([f.name for f in SCHEMAS[PARENT].fields])}
    for t in CHILDREN:
        lead = ["id"] if has_column(flat[t], "id") else []
        out[t] = flat[t].select(*lead, *[f.name for f in SCHEMAS[t].fields])
    out["sample_crystal_phases"] = out["sample_crystal_phases"].withColumn(
        "is_major_phase", F.coalesce("is_major_phase", F.lit(True))
    )
    return out
