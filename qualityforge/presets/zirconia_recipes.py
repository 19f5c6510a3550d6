"""Preset generator: rule-constrained zirconia recipe groups.

One row per recipe group is built in stages of plain column expressions: recipe,
dopants, phases, sintering, temperatures, conductivities, source text. Every
random value is keyed by the group id, so the data do not depend on how ids are
partitioned, and no step shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.functions.keyed import Draws, Keyed, weighted_choice
from qualityforge.functions.scalars import clamp, let
from qualityforge.operators import synth
from qualityforge.presets import zirconia as Z

# --------------------------------------------------------------------------
# Physical constants, property tables and distributions that must
# equal the published generator's for matching populations.
# --------------------------------------------------------------------------

BOLTZMANN_EV = 8.617333e-5
REFERENCE_K = 1073.15
SEGMENT_C, SEGMENT_K = 600.0, 873.15
MIN_FRACTION, MAX_TOTAL_FRACTION = 0.001, 0.30
LOG_NOISE = 0.05
COMMON_SHARE = 0.7
FALLBACK_ELEMENT = "Y"
MAX_TRIES = 50

# element, ionic radius (pm), valence, frequency, optimal fraction, solubility,
# beta alpha, beta beta, beta scale, high-T activation min and max, low-T
# activation min and max (eV), log10 base conductivity
ELEMENTS = [
    ("Y", 101.9, 3, 0.380, 0.08, 0.25, 3, 4, 0.20, 0.90, 1.05, 1.10, 1.25, -1.54),
    ("Sc", 87.0, 3, 0.330, 0.09, 0.12, 4, 3, 0.15, 0.78, 0.85, 1.05, 1.15, -1.23),
    ("Yb", 98.5, 3, 0.090, 0.08, 0.20, 4, 3, 0.18, 0.85, 0.95, 1.05, 1.20, -2.09),
    ("Ce", 105.3, 4, 0.050, 0.10, 0.18, 4, 3, 0.20, 0.95, 1.10, 1.10, 1.25, -1.43),
    ("Dy", 102.7, 3, 0.030, 0.08, 0.20, 4, 3, 0.18, 0.95, 1.10, 1.10, 1.30, -1.58),
    ("Bi", 96.0, 3, 0.030, 0.05, 0.15, 3, 4, 0.12, 1.00, 1.15, 1.15, 1.30, -1.51),
    ("Gd", 97.0, 3, 0.020, 0.08, 0.20, 4, 3, 0.18, 0.95, 1.10, 1.10, 1.30, -2.00),
    ("Er", 100.4, 3, 0.015, 0.08, 0.20, 4, 3, 0.18, 0.90, 1.05, 1.10, 1.25, -1.80),
    ("Lu", 97.7, 3, 0.010, 0.08, 0.20, 4, 3, 0.18, 0.82, 0.90, 1.05, 1.18, -0.97),
    ("Pr", 112.6, 3, 0.010, 0.05, 0.15, 3, 4, 0.12, 1.00, 1.15, 1.15, 1.30, -2.11),
    ("Ca", 112.0, 2, 0.010, 0.12, 0.20, 3, 2, 0.25, 1.00, 1.20, 1.15, 1.35, -2.12),
    ("Fe", 64.5, 3, 0.005, 0.02, 0.05, 3, 5, 0.06, 1.00, 1.15, 1.15, 1.30, -2.00),
    ("Mn", 83.0, 2, 0.005, 0.01, 0.05, 3, 5, 0.04, 1.00, 1.15, 1.10, 1.30, -2.00),
    ("Zn", 74.0, 2, 0.005, 0.02, 0.05, 3, 5, 0.06, 1.05, 1.20, 1.15, 1.35, -2.50),
    ("Al", 53.5, 3, 0.005, 0.01, 0.03, 3, 6, 0.04, 1.05, 1.20, 1.20, 1.35, -2.50),
    ("In", 80.0, 3, 0.003, 0.05, 0.10, 3, 4, 0.12, 0.95, 1.10, 1.10, 1.30, -2.00),
    ("Eu", 106.6, 3, 0.003, 0.05, 0.15, 3, 4, 0.12, 0.95, 1.10, 1.10, 1.30, -2.10),
    ("Si", 40.0, 4, 0.002, 0.01, 0.02, 3, 6, 0.03, 1.10, 1.25, 1.20, 1.40, -3.00),
    ("Nb", 64.0, 5, 0.002, 0.02, 0.05, 3, 5, 0.06, 1.10, 1.25, 1.20, 1.40, -2.80),
    ("Ti", 60.5, 4, 0.002, 0.02, 0.05, 3, 5, 0.06, 1.05, 1.20, 1.15, 1.35, -2.50),
]
OXIDES = {
    "Y": "Y2O3", "Sc": "Sc2O3", "Yb": "Yb2O3", "Ce": "CeO2", "Dy": "Dy2O3", "Bi": "Bi2O3", "Gd": "Gd2O3",
    "Er": "Er2O3", "Lu": "Lu2O3", "Pr": "Pr6O11", "Ca": "CaO", "Fe": "Fe2O3", "Mn": "MnO", "Zn": "ZnO",
    "Al": "Al2O3", "In": "In2O3", "Eu": "Eu2O3", "Si": "SiO2", "Nb": "Nb2O5", "Ti": "TiO2",
}

DOPANT_COUNTS = [(1, 0.46), (2, 0.46), (3, 0.05), (4, 0.02), (5, 0.01)]
POINT_COUNTS = [(3, 0.40), (4, 0.30), (5, 0.20), (6, 0.05), (7, 0.03), (8, 0.02)]
METHOD_SHARES = [
    ("Solid-state synthesis", 0.456),
    ("Commercialization", 0.200),
    ("Sol–gel method", 0.120),
    ("Coprecipitation method", 0.100),
    ("Hydrothermal synthesis", 0.050),
    ("Glycine method", 0.030),
    ("Coprecipitation", 0.020),
    ("Directional melt crystallization", 0.014),
    ("/", 0.010),
]
ROUTE_SHARES = [
    ("dry pressing", 0.804),
    ("spark plasma sintering", 0.080),
    ("RF sputtering", 0.030),
    ("tape casting", 0.030),
    ("isostatic pressing", 0.030),
    ("spray pyrolysis", 0.026),
]
PHASE_COUNTS = [(1, 0.84), (2, 0.155), (3, 0.005)]
CENTER_TEMPERATURES = [
    (300.0, 0.02), (350.0, 0.02), (400.0, 0.03), (450.0, 0.04), (500.0, 0.06), (550.0, 0.06), (600.0, 0.08),
    (650.0, 0.08), (700.0, 0.12), (750.0, 0.10), (800.0, 0.12), (850.0, 0.10), (900.0, 0.08), (950.0, 0.05),
    (1000.0, 0.04),
]

CUBIC, TETRAGONAL, MONOCLINIC, ORTHOGONAL, RHOMBOHEDRAL = 1, 2, 3, 4, 5
PHASES_SC_HIGH = [(CUBIC, 0.85), (TETRAGONAL, 0.10), (RHOMBOHEDRAL, 0.05)]
PHASES_SC_LOW = [(CUBIC, 0.10), (TETRAGONAL, 0.50), (RHOMBOHEDRAL, 0.25), (MONOCLINIC, 0.15)]
PHASES_HIGH = [(CUBIC, 0.80), (TETRAGONAL, 0.15), (MONOCLINIC, 0.05)]
PHASES_MEDIUM = [(CUBIC, 0.40), (TETRAGONAL, 0.45), (MONOCLINIC, 0.10), (ORTHOGONAL, 0.05)]
PHASES_LOW = [(CUBIC, 0.05), (TETRAGONAL, 0.40), (MONOCLINIC, 0.45), (ORTHOGONAL, 0.10)]
PHASE_OFFSETS = {CUBIC: 0.0, TETRAGONAL: 0.3, MONOCLINIC: 1.0, ORTHOGONAL: 0.8, RHOMBOHEDRAL: 0.5}

# method or route -> temperature min and max (C), duration min and max (min)
DEFAULT_SINTERING = (1300, 1550, 60, 360)
ROUTE_SINTERING = {"spark plasma sintering": (1000, 1300, 3, 30)}
METHOD_SINTERING = {
    "Solid-state synthesis": (1400, 1650, 120, 600),
    "Commercialization": (1300, 1550, 60, 300),
    "Sol–gel method": (1200, 1500, 60, 360),
    "Coprecipitation method": (1200, 1500, 60, 360),
    "Coprecipitation": (1200, 1500, 60, 360),
    "Hydrothermal synthesis": (1200, 1500, 60, 360),
    "Glycine method": (1200, 1500, 60, 360),
    "Directional melt crystallization": (1300, 1550, 60, 360),
}
NO_SINTERING_ROUTE = "RF sputtering"
NO_SINTERING_MAX_CENTER = 800.0
STEP_COUNTS = [(1, 0.97), (2, 0.02), (3, 0.01)]
COMMON_TEMPERATURES = [1100, 1200, 1250, 1300, 1350, 1400, 1450, 1500, 1550, 1600, 1650]
COMMON_DURATIONS = [3, 30, 60, 120, 180, 240, 300, 360, 480, 600]

SUPPLIERS = [
    "Alfa Aesar", "Sigma Aldrich", "Tosoh", "Fluka", "StanfordMaterial", "Innovnano", "Z-Tech", "Kceracell",
    "Praxair", "SCRC", "Adventech", "Kerafol GmbH", "Toyo Soda", "Daiichi Kigenso",
    "Inframat Advanced Materials", "Nano One Materials", "Stanford Advanced Materials",
]
PRECURSORS = ["nitrate", "chloride", "acetate", "carbonate", "alkoxide"]
PURITIES = [("99%", 0.15), ("99.5%", 0.25), ("99.9%", 0.35), ("99.95%", 0.15), ("99.99%", 0.10)]

# --------------------------------------------------------------------------

_FIELDS = (
    "element", "radius", "valence", "frequency", "optimum", "solubility", "a", "b", "scale",
    "high_min", "high_max", "low_min", "low_max", "base",
)
# Draws that most groups need, by the stages that read them; the others are hashed where they are wanted.
_AHEAD = {
    "_recipe_draws": [Draws("method"), Draws("route")],
    "_dopant_draws": [
        Draws("dopant/count"), Draws("dopant/element", parts=len(ELEMENTS)), Draws("dopant/lead", parts=6),
        Draws("dopant/minor", first=1, parts=6),
    ],
    "_phase_draws": [Draws("phase/major"), Draws("phase/second"), Draws("phase/count")],
    "_sintering_draws": [
        Draws("sinter/steps"), *[Draws(f"sinter/{x}/{y}", first=1) for x in "td" for y in ("mode", "pick", "free")],
    ],
    "_temperature_draws": [
        Draws("temp/center"), Draws("temp/points"), Draws("temp/gap"), *[Draws(f"temp/jitter/{x}", indices=5) for x in "ra"],
    ],
    "_conductivity_draws": [
        Draws("cond/ea_high"), Draws("cond/ea_low"), *[Draws(f"cond/level/{x}") for x in "ra"],
        *[Draws(f"cond/noise/{x}", indices=5) for x in "ra"],
    ],
    "_text_draws": [
        Draws("text/template"), Draws("text/variant"), Draws("text/precursor"), Draws("text/zr"), Draws("text/zr_purity"),
        Draws("text/dop", indices=2), Draws("text/dop_purity", indices=2),
    ],
}
_DOPANT = "struct<element:string,radius:double,valence:int,fraction:double,cap:double>"


def _element_struct(row: tuple) -> Column:
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(_FIELDS, row)])


def _properties() -> Column:
    return F.array(*[_element_struct(e) for e in ELEMENTS])


def _lookup(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _recipe(df: DataFrame, k: Keyed) -> DataFrame:
    for name, shares in (("method", METHOD_SHARES), ("route", ROUTE_SHARES)):
        df = df.withColumn(name, k.choice(name, shares))
    return df


def _dopants(df: DataFrame, k: Keyed) -> DataFrame:
    """1 to 5 elements with fractions in budget, one of valence 2 or 3 at least."""

    def with_fraction(x: Column, value: Column) -> Column:
        return F.struct(
            x["element"].alias("element"),
            x["radius"].alias("radius"),
            x["valence"].alias("valence"),
            value.alias("fraction"),
            x["solubility"].alias("cap"),
        )

    def lead_fraction(x: Column, i: Column) -> Column:
        return k.beta_int("dopant/lead", x["a"], x["b"], i) * x["scale"]

    def clipped(ranks: Column, i: Column) -> Column:
        drawn = F.transform(
            F.transform(ranks, lambda x: F.get(named, x["v"])),
            lambda x, j: with_fraction(
                x, F.when(j == 0, lead_fraction(x, i)).otherwise(k.beta_int("dopant/minor", 2, 5, i * 8 + j) * 0.08)
            ),
        )
        return synth.running_budget(drawn, "fraction", "cap", MIN_FRACTION, MAX_TOTAL_FRACTION, 4, _DOPANT)

    def attempt(i: Column) -> Column:
        count = k.choice("dopant/count", DOPANT_COUNTS, i)
        return clipped(k.sample_without_replacement("dopant/element", ranked, "frequency", count, i), i)

    # What is drawn and sorted is an element's rank by name: a lambda copies its whole result.
    by_name = sorted(ELEMENTS)
    named = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(_FIELDS, e) if n in ("element", "radius", "valence", "solubility", "a", "b", "scale")]) for e in by_name])
    frequencies = [(by_name.index(e), e[_FIELDS.index("frequency")]) for e in ELEMENTS]
    ranked = F.array(*[F.struct(F.lit(v).alias("v"), F.lit(w).alias("frequency")) for v, w in frequencies])
    # Two mentions keep the order a column of its own.
    first = F.slice("order", 1, F.least(k.choice("dopant/count", DOPANT_COUNTS), F.size("order")))
    spare = _element_struct(next(e for e in ELEMENTS if e[0] == FALLBACK_ELEMENT))
    spare = let(spare, lambda x: F.array(with_fraction(x, lead_fraction(x, F.lit(MAX_TRIES)))))
    fallback = synth.running_budget(spare, "fraction", "cap", MIN_FRACTION, 1.0, 4, _DOPANT)
    found = synth.retry_until(
        attempt,
        lambda ds: F.exists(ds, lambda d: d["valence"].isin(2, 3)),
        MAX_TRIES,
        fallback,
        f"array<{_DOPANT}>",
        clipped(first, F.lit(0)),
    )
    return (
        df.withColumn("elements", _properties())
        .withColumn("order", k.drawing_order("dopant/element", frequencies))
        .withColumn("dopants", found)
        .withColumn("primary", synth.argmax_item(F.col("dopants"), "fraction"))
        .withColumn("total", synth.total_of(F.col("dopants"), "fraction"))
        .withColumn("prop", F.element_at(F.filter("elements", lambda e: e["element"] == F.col("primary.element")), 1))
        .drop("elements", "order")
    )


def _phases(df: DataFrame, k: Keyed) -> DataFrame:
    """Phase ids, the major one first."""
    u, total = F.col("u_phase"), F.col("total")
    frac, element, valence = F.col("primary.fraction"), F.col("primary.element"), F.col("primary.valence")
    scandium = element == "Sc"
    major = (
        F.when(scandium & (frac >= 0.10), weighted_choice(u, PHASES_SC_HIGH))
        .when(scandium & (frac < 0.08), weighted_choice(u, PHASES_SC_LOW))
        .when((total >= 0.10) & valence.isin(2, 3), weighted_choice(u, PHASES_HIGH))
        .when(total >= 0.05, weighted_choice(u, PHASES_MEDIUM))
        .otherwise(weighted_choice(u, PHASES_LOW))
    )
    m, n = F.col("major"), F.col("n_phases")
    second = (
        F.when((m == TETRAGONAL) & (F.col("u_second") < 0.6), CUBIC)
        .when(m == TETRAGONAL, MONOCLINIC)
        .when(m == RHOMBOHEDRAL, CUBIC)
        .otherwise(TETRAGONAL)
    )
    two = F.array_compact(F.array(m, F.when((n >= 2) & (F.col("second") != m), F.col("second"))))
    third = synth.other_candidate(k, "phase/third", [CUBIC, TETRAGONAL, MONOCLINIC, ORTHOGONAL], F.col("two"))
    listed = F.array_compact(F.concat("two", F.array(F.when(n >= 3, third))))
    alone = F.size("listed") == 1
    # Forbidden combinations: almost undoped cubic, heavily doped monoclinic.
    legal = (
        F.when(alone & (m == CUBIC) & (total < Z.LOW_DOPING), F.array(F.lit(TETRAGONAL)))
        .when(alone & (m == MONOCLINIC) & (total > Z.HIGH_DOPING), F.array(F.lit(CUBIC)))
        .otherwise(F.col("listed"))
    )
    return (
        df.withColumn("u_phase", k.uniform("phase/major"))
        .withColumn("major", major)
        .withColumn("u_second", k.uniform("phase/second"))
        .withColumn("n_phases", k.choice("phase/count", PHASE_COUNTS))
        .withColumn("second", second)
        .withColumn("two", two)
        .withColumn("listed", listed)
        .withColumn("phase_ids", legal)
        .withColumn("major", F.element_at("phase_ids", 1))
        .drop("u_phase", "u_second", "n_phases", "second", "two", "listed")
    )


def _sintering(df: DataFrame, k: Keyed) -> DataFrame:
    names = ["t_min", "t_max", "d_min", "d_max"]
    # The route overrides the method where it has a range of its own.
    df = df.withColumn("range_key", F.when(F.col("route").isin(list(ROUTE_SINTERING)), F.col("route")).otherwise(F.col("method")))
    df = synth.range_lookup(df, "range_key", {**METHOD_SINTERING, **ROUTE_SINTERING}, DEFAULT_SINTERING, names)

    def value(stream: str, common: list, low: str, high: str, i: Column) -> Column:
        return synth.mixture_value(k, stream, common, F.col(low), F.col(high), COMMON_SHARE, 10, i)

    def steps(n: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.struct(
                i.alias("step_order"),
                value("sinter/t", COMMON_TEMPERATURES, "t_min", "t_max", i).alias("sintering_temperature"),
                value("sinter/d", COMMON_DURATIONS, "d_min", "d_max", i).alias("sintering_duration"),
            ),
        )

    none = F.array().cast("array<struct<step_order:int,sintering_temperature:double,sintering_duration:double>>")
    return (
        df.withColumn(
            "steps",
            F.when(F.col("route") == NO_SINTERING_ROUTE, none).otherwise(let(k.choice("sinter/steps", STEP_COUNTS), steps)),
        )
        .withColumn("max_sinter", F.coalesce(F.array_max(F.col("steps.sintering_temperature")), F.lit(0.0)))
        .drop("range_key", *names)
    )


def _temperatures(df: DataFrame, k: Keyed) -> DataFrame:
    center = F.when(
        F.col("route") == NO_SINTERING_ROUTE, F.least(F.col("drawn_center"), F.lit(NO_SINTERING_MAX_CENTER))
    ).otherwise(F.col("drawn_center"))
    low, high = Z.TEMPERATURE_RANGE
    return (
        df.withColumn("drawn_center", k.choice("temp/center", CENTER_TEMPERATURES))
        .withColumn("center", center)
        .withColumn("n_points", k.choice("temp/points", POINT_COUNTS))
        .withColumn(
            "temps",
            synth.ordered_points(
                k, "temp", F.col("center"), F.col("n_points"), (50.0, 100.0), 5.0, low, high, 150.0, 75.0
            ),
        )
        .drop("drawn_center", "center", "n_points")
    )


def _conductivities(df: DataFrame, k: Keyed, strict: bool) -> DataFrame:
    """Two-segment Arrhenius curve through a reference level, with noise."""
    prop, primary = F.col("prop"), F.col("primary")
    deviation = F.abs(primary["fraction"] - prop["optimum"])
    doped = F.size("dopants")
    metal = F.exists("dopants", lambda d: d["element"].isin("Fe", "Mn"))
    level = (
        prop["base"]
        - 15.0 * F.col("dev") * F.col("dev")
        - _lookup(PHASE_OFFSETS)[F.col("major")]
        - F.when(
            (F.col("max_sinter") > 0) & (F.col("max_sinter") < 1300.0),
            0.1 + (1300.0 - F.col("max_sinter")) / 1000.0 * 0.3,
        ).otherwise(0.0)
        - F.when(doped >= 3, 0.05 + (doped - 2) * 0.05).otherwise(0.0)
        + F.when(metal, 0.04 + k.uniform("cond/metal") * 0.1).otherwise(0.0)
        + k.normal("cond/level") * 0.15
    )
    df = (
        df.withColumn("dev", deviation)
        .withColumn("ea_high", k.between("cond/ea_high", prop["high_min"], prop["high_max"]) + F.col("dev") * 2.0)
        .withColumn("ea_low", k.between("cond/ea_low", prop["low_min"], prop["low_max"]) + F.col("dev") * 2.0)
        .withColumn("pre_high", F.pow(F.lit(10.0), level) * REFERENCE_K * F.exp(F.col("ea_high") / (BOLTZMANN_EV * REFERENCE_K)))
        .withColumn(
            "pre_low",
            F.col("pre_high") * F.exp((F.col("ea_low") - F.col("ea_high")) / (BOLTZMANN_EV * SEGMENT_K)),
        )
        .withColumn("degrades", (primary["element"] == "Sc") & (primary["fraction"] < 0.10))
    )

    def at(t: Column, i: Column) -> Column:
        kelvin = t + 273.15
        upper = t >= SEGMENT_C
        ea = F.when(upper, F.col("ea_high")).otherwise(F.col("ea_low"))
        pre = F.when(upper, F.col("pre_high")).otherwise(F.col("pre_low"))
        curve = pre / kelvin * F.exp(-ea / (BOLTZMANN_EV * kelvin))
        loss = F.when(F.col("degrades") & (t < 650.0), 0.2 + k.uniform("cond/loss", i) * 0.3).otherwise(1.0)
        noisy = F.log10(F.greatest(curve * loss, F.lit(1e-15))) + k.normal("cond/noise", i) * LOG_NOISE
        return clamp(F.pow(F.lit(10.0), noisy), *Z.CONDUCTIVITY_RANGE)

    repaired = synth.monotone_repair(
        F.col("raw"), lambda i: 1.01 + k.uniform("cond/bump", i) * 0.05, Z.CONDUCTIVITY_RANGE[1], strict
    )
    return (
        df.withColumn("raw", F.transform("temps", at))
        .withColumn("conds", repaired)
        .drop("dev", "ea_high", "ea_low", "pre_high", "pre_low", "degrades", "raw", "prop", "max_sinter", "total")
    )


def _source_text(df: DataFrame, k: Keyed) -> DataFrame:
    oxide = lambda e: F.coalesce(_lookup(OXIDES)[e], F.concat(e, F.lit("Ox")))
    suppliers = F.array(*[F.lit(s) for s in SUPPLIERS])
    supplier = lambda stream, i=0: F.get(suppliers, k.pick(stream, len(SUPPLIERS), i))
    purity = lambda stream, i=0: k.choice(stream, PURITIES, i)
    dopants, primary = F.col("dopants"), F.col("primary")
    powder = lambda d: F.concat(F.lit("commercial "), oxide(d["element"]), F.lit(" powder supplied by "))

    commercial = F.concat(
        F.lit("Commercial ZrO2 powder supplied by "), supplier("text/zr"), F.lit(" with "), purity("text/zr_purity"),
        F.lit(" purity"),
        F.array_join(
            F.transform(
                dopants,
                lambda d, i: F.concat(
                    F.lit(", and "), powder(d), supplier("text/dop", i), F.lit(" with "), purity("text/dop_purity", i),
                    F.lit(" purity"),
                ),
            ),
            "",
        ),
        F.lit("."),
    )
    precursors = F.array(*[F.lit(p) for p in PRECURSORS])
    precursor = F.get(precursors, k.pick("text/precursor", len(PRECURSORS)))
    wet = F.concat(
        F.lit("Zirconium "), F.col("precursor"), F.lit(" and "),
        F.lower(F.array_join(dopants["element"], ", ")), F.lit(" "), F.col("precursor"),
        F.lit(" were used as starting materials."),
    )
    dry = F.concat(
        F.lit("Self-prepared ZrO2 powder with "), purity("text/self_purity"), F.lit(" purity from "),
        supplier("text/self"), F.lit(", and "),
        F.array_join(F.transform(dopants, lambda d, i: F.concat(powder(d), supplier("text/self_dop", i))), ", and "),
        F.lit("."),
    )
    named = F.concat(
        F.lit("Commercial "), primary["element"], F.lit("-doped ZrO2 material with "),
        F.format_string("%.1f", primary["fraction"] * 100), F.lit(" mol% "), oxide(primary["element"]), F.lit("."),
    )
    stabilized = F.concat(
        F.lit("Commercial "), oxide(primary["element"]), F.lit("-stabilized ZrO2 powder supplied by "),
        supplier("text/stab"), F.lit("."),
    )
    bought = F.col("method") == "Commercialization"
    coin = k.uniform("text/variant") < 0.5
    # Bought powder: 70 % commercial text, rest short. Others: 55 / 30 / 15.
    text = (
        F.when(F.col("u_text") < F.when(bought, 0.70).otherwise(0.55), commercial)
        .when(~bought & (F.col("u_text") < 0.85), F.when(coin, wet).otherwise(dry))
        .otherwise(F.when(coin, named).otherwise(stabilized))
    )
    return (
        df.withColumn("u_text", k.uniform("text/template"))
        .withColumn("precursor", precursor)
        .withColumn("source_text", text)
        .drop("u_text", "precursor")
    )


def recipe_groups(ids: DataFrame, group_id: str = "recipe_group_id", seed: int = 12345, source: str = "xxhash64", strict: bool = False) -> DataFrame:
    """One row per id: the recipe and its four arrays of child rows.

    ``strict`` drops points that stay level at the upper conductivity bound
    instead of leaving them for the compliant filter.
    """
    df, k = Keyed((group_id,), seed, source).ahead(ids.select(group_id), _AHEAD)
    for stage in (_recipe, _dopants, _phases, _sintering, _temperatures):
        df = stage(df, k)
    df = _source_text(_conductivities(df, k, strict), k)
    ids_of = lambda names: _lookup({n: i for i, n in enumerate(names, 1)})
    return df.select(
        group_id,
        F.lit(Z.SYNTHETIC_REFERENCE).alias("reference"),
        F.col("source_text").alias("material_source_and_purity"),
        F.coalesce(ids_of(Z.SYNTHESIS_METHODS)[F.col("method")], F.lit(1)).alias("synthesis_method_id"),
        F.coalesce(ids_of(Z.PROCESSING_ROUTES)[F.col("route")], F.lit(1)).alias("processing_route_id"),
        F.transform(
            F.arrays_zip(F.slice("temps", 1, F.size("conds")).alias("t"), F.col("conds").alias("c")),
            lambda p: F.struct(p["t"].alias("operating_temperature"), p["c"].alias("conductivity")),
        ).alias("points"),
        # The repair keeps every point unless it is strict, so that tables without a
        # conductivity need not compute any.
        F.size("conds" if strict else "temps").alias("n_points"),
        F.transform(
            "dopants",
            lambda d: F.struct(
                d["element"].alias("dopant_element"),
                d["radius"].alias("dopant_ionic_radius"),
                d["valence"].alias("dopant_valence"),
                d["fraction"].alias("dopant_molar_fraction"),
            ),
        ).alias("dopants"),
        F.col("steps"),
        F.transform(
            "phase_ids", lambda p, i: F.struct(p.alias("crystal_id"), (i == 0).alias("is_major_phase"))
        ).alias("phases"),
    )


def expand(groups: DataFrame, group_id: str = "recipe_group_id") -> dict[str, DataFrame]:
    """The four fact tables of a grouped frame."""
    out = synth.fan_out(
        groups,
        group_id,
        "points",
        {"sample_dopants": "dopants", "sintering_steps": "steps", "sample_crystal_phases": "phases"},
        Z.KEY,
        Z.BASE_SAMPLE_ID,
        Z.SAMPLES_PER_GROUP,
        ["reference", "material_source_and_purity", "synthesis_method_id", "processing_route_id"],
        count="n_points",
    )
    return {Z.PARENT: out.pop("parent"), **out}


def generate(spark: SparkSession, n_groups: int, seed: int = 12345, partitions: int | None = None, strict: bool = False) -> dict[str, DataFrame]:
    """Fact tables for groups 0 .. n-1, not materialised."""
    ids = synth.entity_ids(spark, n_groups, "recipe_group_id", partitions)
    return expand(recipe_groups(ids, seed=seed, strict=strict))


def write_generated(groups: DataFrame, base: str, staged: str | None = None) -> None:
    """Write facts and dictionaries. The grouped frame is written once and the
    four tables read only their own columns from it, so a lost executor costs a
    task and not the generation."""
    from qualityforge.sources.tables import write_tables

    spark = groups.sparkSession
    path = staged or runtime.scratch_path(spark, "recipe-groups")
    groups.write.mode("overwrite").parquet(path)
    write_tables({**expand(spark.read.parquet(path)), **Z.dictionaries(spark)}, base)
