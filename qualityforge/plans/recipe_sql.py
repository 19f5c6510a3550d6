"""The preset generator recomputed in SQL, stage by stage, from the engine-neutral source.

Reference for the registered queries only: attempts and candidates are rows here, where
the generator keeps them in arrays. Constants come from the preset.
"""

from __future__ import annotations

from qualityforge.plans.lake import _sql_uniform
from qualityforge.presets import zirconia as Z
from qualityforge.presets import zirconia_recipes as G

# An attempt without an element of valence 2 or 3 is rare: so many in a row do not occur.
ATTEMPTS = 12


def choice(u: str, items: list[tuple], kind: str = "") -> str:
    total, acc, arms = 0.0, 0.0, []
    for _, w in items:
        total += w
    value = (lambda v: f"'{v}'") if isinstance(items[0][0], str) else str
    for v, w in items[:-1]:
        acc += w
        arms.append(f"WHEN {u} * {total!r}::DOUBLE <= {acc!r}::DOUBLE THEN {value(v)}")
    return f"(CASE {' '.join(arms)} ELSE {value(items[-1][0])} END){kind}"


def texts(items: list[str]) -> str:
    return "[" + ", ".join(f"'{i}'" for i in items) + "]"


def numbers(items: list[float]) -> str:
    return "[" + ", ".join(f"{float(i)!r}::DOUBLE" for i in items) + "]"


def recipe_sql(seed: int, prefix: str = "") -> str:
    """CTEs up to the four fact tables, named with ``prefix``, over ``orders``."""
    u = lambda stream, index="0": _sql_uniform(stream, "g", index, seed)
    normal = lambda s, i="0": f"(sqrt(-2.0::DOUBLE * ln({u(s + '/r', i)})) * cos(2.0::DOUBLE * pi() * {u(s + '/a', i)}))"
    part = lambda index, p: f"(({index}) || ':' || {p})"
    beta = lambda s, a, n, i: f"list_sort(list_transform(range(0, {n}), lambda p: {u(s, part(i, 'p'))}))[{a}]"
    fields = ", ".join(G._FIELDS)
    rows = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else (str(v) if isinstance(v, int) else f"{v!r}::DOUBLE") for v in (n, *e)) + ")" for n, e in enumerate(G.ELEMENTS))
    low, total = f"{G.MIN_FRACTION!r}::DOUBLE", f"{G.MAX_TOTAL_FRACTION!r}::DOUBLE"
    kind = "STRUCT(element VARCHAR, radius DOUBLE, valence INT, fraction DOUBLE)[]"
    clip = f"least(greatest({low}, least(x.cap, x.fraction)), {total} - acc.used)"
    spare = next(e for e in G.ELEMENTS if e[0] == G.FALLBACK_ELEMENT)
    spare_fraction = f"floor(greatest({low}, least({spare[5]}::DOUBLE, {beta('dopant/lead', spare[6], spare[6] + spare[7] - 1, str(G.MAX_TRIES))} * {spare[8]}::DOUBLE)) * 10000 + 0.5) / 10000"
    p = prefix
    out = [
        f"{p}ids AS (SELECT o_orderkey AS g FROM orders)",
        f"{p}elements AS (SELECT * FROM (VALUES {rows}) AS e(nr, {fields}))",
        # Dopants: the first attempt with an element of valence 2 or 3.
        f"{p}tries AS (SELECT g, i, {choice(u('dopant/count', 'i'), G.DOPANT_COUNTS)} AS n FROM {p}ids, range(0, {ATTEMPTS}) AS r(i))",
        f"{p}drawn AS (SELECT *, row_number() OVER (PARTITION BY g, i ORDER BY -ln({u('dopant/element', part('i', 'nr'))}) / frequency) - 1 AS j FROM {p}tries, {p}elements)",
        f"{p}listed AS (SELECT g, i, list({{'element': element, 'radius': radius, 'valence': valence, 'cap': solubility, 'fraction':"
        f" CASE WHEN j = 0 THEN {beta('dopant/lead', 'a', 'a + b - 1', 'i')} * scale ELSE {beta('dopant/minor', '2', '6', 'i * 8 + j')} * 0.08::DOUBLE END}} ORDER BY j) AS xs"
        f" FROM {p}drawn WHERE j < n GROUP BY g, i)",
        f"{p}clipped AS (SELECT g, i, list_reduce(xs, lambda acc, x: CASE WHEN {clip} > {low} THEN {{'used': acc.used + {clip}, 'kept': list_append(acc.kept,"
        f" {{'element': x.element, 'radius': x.radius, 'valence': x.valence, 'fraction': floor({clip} * 10000 + 0.5) / 10000}})}} ELSE acc END,"
        f" {{'used': 0.0::DOUBLE, 'kept': []::{kind}}}).kept AS kept FROM {p}listed)",
        f"{p}first AS (SELECT g, arg_min(kept, i) AS kept FROM {p}clipped WHERE len(list_filter(kept, lambda d: d.valence IN (2, 3))) > 0 GROUP BY g)",
        f"{p}doped AS (SELECT g, coalesce(kept, [{{'element': '{spare[0]}', 'radius': {spare[1]}::DOUBLE, 'valence': {spare[2]}, 'fraction': {spare_fraction}}}]::{kind}) AS dopants"
        f" FROM {p}ids LEFT JOIN {p}first USING (g))",
        f"{p}led AS (SELECT *, list_reduce(dopants, lambda a, x: CASE WHEN x.fraction > a.fraction THEN x ELSE a END) AS lead,"
        f" list_reduce(list_transform(dopants, lambda d: d.fraction), lambda s, x: s + x, 0.0::DOUBLE) AS total FROM {p}doped)",
        # Recipe and phases.
        f"{p}recipes AS (SELECT l.*, e.optimum, e.high_min, e.high_max, e.low_min, e.low_max, e.base, {choice(u('method'), G.METHOD_SHARES)} AS method, {choice(u('route'), G.ROUTE_SHARES)} AS route,"
        f" {u('phase/major')} AS up, {u('phase/second')} AS us, {choice(u('phase/count'), G.PHASE_COUNTS)} AS np FROM {p}led l JOIN {p}elements e ON e.element = lead.element)",
        f"{p}majors AS (SELECT *, CASE WHEN lead.element = 'Sc' AND lead.fraction >= 0.10 THEN {choice('up', G.PHASES_SC_HIGH)} WHEN lead.element = 'Sc' AND lead.fraction < 0.08"
        f" THEN {choice('up', G.PHASES_SC_LOW)} WHEN total >= 0.10 AND lead.valence IN (2, 3) THEN {choice('up', G.PHASES_HIGH)} WHEN total >= 0.05 THEN {choice('up', G.PHASES_MEDIUM)}"
        f" ELSE {choice('up', G.PHASES_LOW)} END AS m FROM {p}recipes)",
        f"{p}seconds AS (SELECT *, CASE WHEN m = {G.TETRAGONAL} AND us < 0.6 THEN {G.CUBIC} WHEN m = {G.TETRAGONAL} THEN {G.MONOCLINIC} WHEN m = {G.RHOMBOHEDRAL} THEN {G.CUBIC} ELSE {G.TETRAGONAL} END AS s FROM {p}majors)",
        f"{p}pairs AS (SELECT *, CASE WHEN np >= 2 AND s <> m THEN [m, s] ELSE [m] END AS two FROM {p}seconds)",
        f"{p}thirds AS (SELECT *, list_filter([{G.CUBIC}, {G.TETRAGONAL}, {G.MONOCLINIC}, {G.ORTHOGONAL}], lambda x: NOT list_contains(two, x)) AS free FROM {p}pairs)",
        f"{p}all_phases AS (SELECT *, CASE WHEN np >= 3 AND len(free) > 0 THEN list_append(two, free[1 + CAST(floor({u('phase/third')} * len(free)) AS INT)]) ELSE two END AS ls FROM {p}thirds)",
        f"{p}legal AS (SELECT *, CASE WHEN len(ls) = 1 AND m = {G.CUBIC} AND total < {Z.LOW_DOPING} THEN [{G.TETRAGONAL}] WHEN len(ls) = 1 AND m = {G.MONOCLINIC} AND total > {Z.HIGH_DOPING}"
        f" THEN [{G.CUBIC}] ELSE ls END AS phases FROM {p}all_phases)",
    ]
    # Sintering.
    ranges = {**G.METHOD_SINTERING, **G.ROUTE_SINTERING}
    bound = lambda i: "CASE CASE WHEN route IN (" + ", ".join(f"'{r}'" for r in G.ROUTE_SINTERING) + ") THEN route ELSE method END " + " ".join(f"WHEN '{k}' THEN {float(v[i])!r}::DOUBLE" for k, v in ranges.items()) + f" ELSE {float(G.DEFAULT_SINTERING[i])!r}::DOUBLE END"

    def mixture(stream: str, common: list, lo: str, hi: str) -> str:
        free = f"({lo} + {u(stream + '/free', 'i')} * ({hi} - {lo}))"
        listed = f"list_filter({numbers(common)}, lambda x: x BETWEEN {lo} AND {hi})"
        return (
            f"CASE WHEN {u(stream + '/mode', 'i')} < {G.COMMON_SHARE} THEN coalesce({listed}[1 + CAST(floor({u(stream + '/pick', 'i')} * len({listed})) AS INT)], {free})"
            f" ELSE floor({free} / 10 + 0.5) * 10 END"
        )

    out += [
        f"{p}ranged AS (SELECT *, {bound(0)} AS t0, {bound(1)} AS t1, {bound(2)} AS d0, {bound(3)} AS d1,"
        f" CASE WHEN route = '{G.NO_SINTERING_ROUTE}' THEN 0 ELSE {choice(u('sinter/steps'), G.STEP_COUNTS)} END AS ns FROM {p}legal)",
        f"{p}sintered AS (SELECT g, i, {mixture('sinter/t', G.COMMON_TEMPERATURES, 't0', 't1')} AS t, {mixture('sinter/d', G.COMMON_DURATIONS, 'd0', 'd1')} AS d"
        f" FROM {p}ranged, range(1, 4) AS r(i) WHERE i <= ns)",
        f"{p}hottest AS (SELECT g, max(t) AS hot FROM {p}sintered GROUP BY g)",
    ]
    # Temperatures and the curve.
    t_low, t_high = Z.TEMPERATURE_RANGE
    c_low, c_high = Z.CONDUCTIVITY_RANGE
    point = f"floor(greatest({t_low}::DOUBLE, least({t_high}::DOUBLE, greatest({t_low}::DOUBLE, c - floor((n - 1) / 2.0::DOUBLE * gap)) + i * gap + {normal('temp/jitter', 'i')} * 5)) + 0.5)"
    offset = "CASE phases[1] " + " ".join(f"WHEN {k} THEN {v!r}::DOUBLE" for k, v in G.PHASE_OFFSETS.items()) + " END"
    ref = f"({G.BOLTZMANN_EV!r}::DOUBLE * {G.REFERENCE_K!r}::DOUBLE)"
    level = (
        f"(base - 15.0::DOUBLE * dev * dev - {offset} - CASE WHEN hot > 0 AND hot < 1300 THEN 0.1::DOUBLE + (1300.0::DOUBLE - hot) / 1000.0::DOUBLE * 0.3::DOUBLE ELSE 0 END"
        f" - CASE WHEN len(dopants) >= 3 THEN 0.05::DOUBLE + (len(dopants) - 2) * 0.05::DOUBLE ELSE 0 END"
        f" + CASE WHEN len(list_filter(dopants, lambda d: d.element IN ('Fe', 'Mn'))) > 0 THEN 0.04::DOUBLE + {u('cond/metal')} * 0.1::DOUBLE ELSE 0 END + {normal('cond/level')} * 0.15::DOUBLE)"
    )
    kelvin = f"({G.BOLTZMANN_EV!r}::DOUBLE * (t + 273.15::DOUBLE))"
    curve = f"(CASE WHEN t >= {G.SEGMENT_C} THEN pre_high / (t + 273.15::DOUBLE) * exp(-ea_high / {kelvin}) ELSE pre_low / (t + 273.15::DOUBLE) * exp(-ea_low / {kelvin}) END)"
    loss = f"(CASE WHEN lead.element = 'Sc' AND lead.fraction < 0.10 AND t < 650 THEN 0.2::DOUBLE + {u('cond/loss', 'i')} * 0.3::DOUBLE ELSE 1 END)"
    bump = f"(1.01::DOUBLE + {u('cond/bump', 'len(acc)')} * 0.05::DOUBLE)"
    out += [
        f"{p}centers AS (SELECT r.*, coalesce(hot, 0) AS hot, {choice(u('temp/center'), G.CENTER_TEMPERATURES, '::DOUBLE')} AS c0, {choice(u('temp/points'), G.POINT_COUNTS)} AS n,"
        f" 50.0::DOUBLE + {u('temp/gap')} * 50.0::DOUBLE AS gap FROM {p}ranged r LEFT JOIN {p}hottest USING (g))",
        f"{p}centred AS (SELECT *, CASE WHEN route = '{G.NO_SINTERING_ROUTE}' THEN least(c0, {G.NO_SINTERING_MAX_CENTER}::DOUBLE) ELSE c0 END AS c, abs(lead.fraction - optimum) AS dev FROM {p}centers)",
        f"{p}spaced AS (SELECT *, list_sort(list_distinct(list_transform(range(0, n), lambda i: {point}))) AS ts0,"
        f" high_min + {u('cond/ea_high')} * (high_max - high_min) + dev * 2.0::DOUBLE AS ea_high, low_min + {u('cond/ea_low')} * (low_max - low_min) + dev * 2.0::DOUBLE AS ea_low FROM {p}centred)",
        f"{p}levels AS (SELECT *, CASE WHEN len(ts0) < 2 THEN list_transform(range(0, n), lambda i: least({t_high}::DOUBLE, greatest({t_low}::DOUBLE, c - 150) + i * 75.0::DOUBLE)) ELSE ts0 END AS ts,"
        f" 10 ** {level} * {G.REFERENCE_K!r}::DOUBLE * exp(ea_high / {ref}) AS pre_high FROM {p}spaced)",
        f"{p}curves AS (SELECT *, pre_high * exp((ea_low - ea_high) / ({G.BOLTZMANN_EV!r}::DOUBLE * {G.SEGMENT_K!r}::DOUBLE)) AS pre_low FROM {p}levels)",
        f"{p}points AS (SELECT g, i, t, greatest({c_low!r}::DOUBLE, least({c_high!r}::DOUBLE, 10 ** (log10(greatest({curve} * {loss}, 1e-15::DOUBLE)) + {normal('cond/noise', 'i')} * {G.LOG_NOISE}::DOUBLE))) AS v"
        f" FROM (SELECT *, unnest(ts) AS t, unnest(range(0, len(ts))) AS i FROM {p}curves))",
        f"{p}repaired AS (SELECT g, list(t ORDER BY i) AS ts, list_reduce(list(v ORDER BY i), lambda acc, x: CASE WHEN len(acc) = 0 THEN [x] ELSE list_append(acc,"
        f" CASE WHEN x <= acc[len(acc)] THEN least(acc[len(acc)] * {bump}, {c_high!r}::DOUBLE) ELSE x END) END, []::DOUBLE[]) AS vs FROM {p}points GROUP BY g)",
    ]
    # Source text.
    oxide = lambda e: f"CASE {e} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in G.OXIDES.items()) + " END"
    supplier = lambda s, i="0": f"({texts(G.SUPPLIERS)})[1 + CAST(floor({u(s, i)} * {len(G.SUPPLIERS)}) AS INT)]"
    purity = lambda s, i="0": choice(u(s, i), G.PURITIES)
    each = lambda body, glue: f"array_to_string(list_transform(range(0, len(dopants)), lambda i: {body}), '{glue}')"
    powder = f"'commercial ' || {oxide('dopants[i + 1].element')} || ' powder supplied by '"
    commercial = (
        f"'Commercial ZrO2 powder supplied by ' || {supplier('text/zr')} || ' with ' || {purity('text/zr_purity')} || ' purity' || "
        + each(f"', and ' || {powder} || {supplier('text/dop', 'i')} || ' with ' || {purity('text/dop_purity', 'i')} || ' purity'", "")
        + " || '.'"
    )
    precursor = f"({texts(G.PRECURSORS)})[1 + CAST(floor({u('text/precursor')} * {len(G.PRECURSORS)}) AS INT)]"
    wet = f"'Zirconium ' || {precursor} || ' and ' || lower(array_to_string(list_transform(dopants, lambda d: d.element), ', ')) || ' ' || {precursor} || ' were used as starting materials.'"
    dry = f"'Self-prepared ZrO2 powder with ' || {purity('text/self_purity')} || ' purity from ' || {supplier('text/self')} || ', and ' || " + each(f"{powder} || {supplier('text/self_dop', 'i')}", ", and ") + " || '.'"
    # One decimal of the shortest text of the number, halves up.
    percent = "CAST(round(CAST(CAST(lead.fraction * 100 AS VARCHAR) AS DECIMAL(30, 16)), 1) AS DECIMAL(10, 1))::VARCHAR"
    named = f"'Commercial ' || lead.element || '-doped ZrO2 material with ' || {percent} || ' mol% ' || {oxide('lead.element')} || '.'"
    stabilized = f"'Commercial ' || {oxide('lead.element')} || '-stabilized ZrO2 powder supplied by ' || {supplier('text/stab')} || '.'"
    text = (
        f"CASE WHEN ut < CASE WHEN method = 'Commercialization' THEN 0.70 ELSE 0.55 END THEN {commercial} WHEN method <> 'Commercialization' AND ut < 0.85 THEN"
        f" CASE WHEN coin THEN {wet} ELSE {dry} END WHEN coin THEN {named} ELSE {stabilized} END"
    )
    ident = f"{Z.BASE_SAMPLE_ID} + g * {Z.SAMPLES_PER_GROUP} + pos"
    ids_of = lambda column, names: f"list_position({texts(names)}, {column})"
    spread = f"SELECT *, unnest(range(0, len(vs))) AS pos FROM {p}legal JOIN {p}repaired USING (g)"
    out += [
        f"{p}told AS (SELECT *, {text} AS source_text FROM (SELECT *, {u('text/template')} AS ut, {u('text/variant')} < 0.5 AS coin FROM {p}legal))",
        f"{p}material_samples AS (SELECT {ident} AS sample_id, g AS recipe_group_id, '{Z.SYNTHETIC_REFERENCE}' AS reference, source_text AS material_source_and_purity,"
        f" {ids_of('method', Z.SYNTHESIS_METHODS)} AS synthesis_method_id, {ids_of('route', Z.PROCESSING_ROUTES)} AS processing_route_id, ts[pos + 1] AS operating_temperature, vs[pos + 1] AS conductivity"
        f" FROM (SELECT *, unnest(range(0, len(vs))) AS pos FROM {p}told JOIN {p}repaired USING (g)))",
        f"{p}sample_dopants AS (SELECT {ident} AS sample_id, g AS recipe_group_id, d.element AS dopant_element, d.radius AS dopant_ionic_radius, d.valence AS dopant_valence, d.fraction AS dopant_molar_fraction"
        f" FROM (SELECT *, unnest(dopants) AS d FROM ({spread})))",
        f"{p}sintering_steps AS (SELECT {ident} AS sample_id, g AS recipe_group_id, i::INT AS step_order, t AS sintering_temperature, d AS sintering_duration FROM ({spread}) JOIN {p}sintered USING (g))",
        f"{p}sample_crystal_phases AS (SELECT {ident} AS sample_id, g AS recipe_group_id, x AS crystal_id, k = 1 AS is_major_phase FROM (SELECT *, unnest(phases) AS x, unnest(range(1, len(phases) + 1)) AS k FROM ({spread})))",
    ]
    return ", ".join(out)
