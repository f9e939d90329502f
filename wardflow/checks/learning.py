"""DuckDB SQL for the fits of ``plans.learning``, written out step by step over the views of ``checks.oracle``."""

from __future__ import annotations

from wardflow.plans.learning import NEWTON_FEATURES
from wardflow.plans.modelling import RULE_COEFFICIENTS, RULE_INTERCEPT
from wardflow.profiles import clinical as P

BINS, RATE, PENALTY = 32, 0.3, 1.0
NUMBERS = list(P.NUMERIC_FEATURES)


def _part(split: str, columns) -> str:
    return (f"select f.hadm_id, f.readmission_flag as y, {', '.join(f'f.{c}' for c in columns)} from filled f join parts p "
            f"on p.hadm_id = f.hadm_id where p.split = '{split}'")


def _eliminated(name: str, n: int) -> list[str]:
    """CTEs that take ``name`` (h0_0, ..., g0, ..., c0, ...) to upper triangular form."""
    out = []
    for k in range(n):
        cells = [f"h{i}_{j} - h{i}_{k} / h{k}_{k} * h{k}_{j} as h{i}_{j}" if i > k else f"h{i}_{j}" for i in range(n) for j in range(n)]
        cells += [f"g{i} - h{i}_{k} / h{k}_{k} * g{k} as g{i}" if i > k else f"g{i}" for i in range(n)]
        out.append(f"{name}_{k + 1} as materialized (select {', '.join(cells)}, {', '.join(f'c{i}' for i in range(n))} from {name}_{k})")
    return out


def _newton(steps: int = 5) -> str:
    n = len(NEWTON_FEATURES) + 1
    xs = ["cast(1 as double) as x0", *[f"cast({c} as double) as x{i}" for i, c in enumerate(NEWTON_FEATURES, 1)]]
    ctes = [f"base as materialized (select y, {', '.join(xs)} from ({_part('train', NEWTON_FEATURES)}))",
            f"w0 as (select {', '.join(f'cast(0 as double) as c{i}' for i in range(n))})"]
    for k in range(1, steps + 1):
        z = " + ".join(f"c{i} * x{i}" for i in range(n))
        sums = [f"sum((q - y) * x{i}) + {'0' if i == 0 else f'any_value(c{i})'} as g{i}" for i in range(n)]
        sums += [f"sum(q * (1 - q) * x{i} * x{j}) + {1 if i == j and i else 0} as h{i}_{j}" for i in range(n) for j in range(n)]
        keep = [f"any_value(c{i}) as c{i}" for i in range(n)]
        ctes.append(f"s{k}_0 as materialized (select {', '.join([*sums, *keep])} from (select *, 1 / (1 + exp(-({z}))) as q from base, w{k - 1}))")
        ctes += _eliminated(f"s{k}", n)
        src = f"s{k}_{n}"
        for i in reversed(range(n)):  # back substitution, a column at a time
            rest = "".join(f" - h{i}_{j} * d{j}" for j in range(i + 1, n))
            ctes.append(f"b{k}_{i} as (select *, (g{i}{rest}) / h{i}_{i} as d{i} from {src})")
            src = f"b{k}_{i}"
        ctes.append(f"w{k} as materialized (select {', '.join(f'c{i} - d{i} as c{i}' for i in range(n))} from {src})")
    terms = ["(intercept)", *NEWTON_FEATURES]
    rows = [f"select {k} as step, '{t}' as term, round(c{i}, 6) as coefficient from w{k}" for k in range(1, steps + 1) for i, t in enumerate(terms)]
    return f"with {', '.join(ctes)} {' union all '.join(rows)}"


def _shares(k: int = 5, squarings: int = 14) -> str:
    """Power iteration by squaring: a high power of the matrix is its first component's projection; that is taken off."""
    ctes = [f"values_long as (unpivot (select hadm_id, {', '.join(f'cast({c} as double) as {c}' for c in NUMBERS)} from filled) "
            f"on {', '.join(NUMBERS)} into name feature value v)",
            "m1 as materialized (select a.feature as i, b.feature as j, covar_samp(a.v, b.v) as v from values_long a join values_long b "
            "on a.hadm_id = b.hadm_id group by a.feature, b.feature)"]
    for c in range(1, k + 1):
        ctes.append(f"p{c}_0 as materialized (select i, j, v / (select max(abs(v)) from m{c}) as v from m{c})")
        for s in range(1, squarings + 1):
            square = f"select a.i, b.j, sum(a.v * b.v) as v from p{c}_{s - 1} a join p{c}_{s - 1} b on a.j = b.i group by a.i, b.j"
            ctes.append(f"p{c}_{s} as materialized (select i, j, v / max(abs(v)) over () as v from ({square}))")
        top = f"p{c}_{squarings}"
        ctes.append(f"v{c} as materialized (select i, v / sqrt(sum(v * v) over ()) as v from {top} where j = (select i from {top} where i = j order by v desc limit 1))")
        ctes.append(f"l{c} as materialized (select sum(x.v * m.v * y.v) as l from m{c} m join v{c} x on x.i = m.i join v{c} y on y.i = m.j)")
        ctes.append(f"m{c + 1} as materialized (select m.i, m.j, m.v - (select l from l{c}) * x.v * y.v as v from m{c} m "
                    f"join v{c} x on x.i = m.i join v{c} y on y.i = m.j)")
    rows = [f"select {c} as component, round(l / (select sum(v) from m1 where i = j), 6) as share from l{c}" for c in range(1, k + 1)]
    return f"with {', '.join(ctes)} {' union all '.join(rows)}"


def _binned() -> list[str]:
    """``edges`` (a feature's ends) and ``binned`` (a row per training row and feature, with its bin)."""
    names = "[" + ", ".join(f"'{c}'" for c in NUMBERS) + "]"
    return [f"values_long as materialized (unpivot (select hadm_id, y, {', '.join(f'cast({c} as double) as {c}' for c in NUMBERS)} "
            f"from ({_part('train', NUMBERS)})) on {', '.join(NUMBERS)} into name feature value v)",
            f"edges as materialized (select feature, list_position({names}, feature) as position, min(v) as lo, max(v) as hi from values_long "
            "group by feature having min(v) < max(v))",
            f"binned as materialized (select hadm_id, y, feature, position, least(floor((v - lo) * {BINS} / (hi - lo)), {BINS - 1}) as bin "
            "from values_long join edges using (feature))"]


THRESHOLD = f"lo + (bin + 1) * (hi - lo) / {BINS}"


def _best_splits() -> str:
    gini = "(2.0 * ({y} / {n}) * (1 - {y} / {n}))"
    left, right, whole = gini.format(y="ly", n="ln"), gini.format(y="(ay - ly)", n="(an - ln)"), gini.format(y="ay", n="an")
    ctes = [*_binned(), "hist as (select feature, bin, count(*) as n, sum(y) as y from binned group by feature, bin)",
            "sides as (select feature, bin, sum(n) over upto as ln, sum(y) over upto as ly, sum(n) over (partition by feature) as an, "
            "sum(y) over (partition by feature) as ay, lead(1) over (partition by feature order by bin) as more from hist "
            "window upto as (partition by feature order by bin rows unbounded preceding))",
            f"gains as (select *, round({whole} - (ln / an) * {left} - ((an - ln) / an) * {right}, 9) as gain from sides where more = 1)",
            "best as (select *, row_number() over (partition by feature order by gain desc, bin) as nth from gains)"]
    return (f"with {', '.join(ctes)} select feature, round({THRESHOLD}, 6) as threshold, gain, cast(ln as bigint) as n_left, "
            "cast(ly as bigint) as positives_left, cast(an - ln as bigint) as n_right, cast(ay - ly as bigint) as positives_right "
            "from best join edges using (feature) where nth = 1")


def _stumps(rounds: int = 5) -> str:
    ctes = [*_binned(), "margin0 as (select distinct hadm_id, cast(0 as double) as m from binned)"]
    for k in range(1, rounds + 1):
        ctes += [
            f"hist{k} as (select feature, position, bin, sum(q - y) as g, sum(q * (1 - q)) as h from (select b.*, 1 / (1 + exp(-m)) as q "
            f"from binned b join margin{k - 1} using (hadm_id)) group by feature, position, bin)",
            f"sides{k} as (select feature, position, bin, sum(g) over upto as lg, sum(h) over upto as lh, sum(g) over (partition by feature) as ag, "
            f"sum(h) over (partition by feature) as ah, lead(1) over (partition by feature order by bin) as more from hist{k} "
            "window upto as (partition by feature order by bin rows unbounded preceding))",
            f"stump{k} as materialized (select feature, bin, {-RATE} * lg / (lh + {PENALTY}) as below, {-RATE} * (ag - lg) / (ah - lh + {PENALTY}) as above, "
            f"round(lg * lg / (lh + {PENALTY}) + (ag - lg) * (ag - lg) / (ah - lh + {PENALTY}) - ag * ag / (ah + {PENALTY}), 9) as gain "
            f"from sides{k} where more = 1 order by gain desc, position, bin limit 1)",
            f"margin{k} as materialized (select hadm_id, m + if(b.bin <= s.bin, below, above) as m from margin{k - 1} "
            f"join binned b using (hadm_id) join stump{k} s on s.feature = b.feature)"]
    rows = [f"select {k} as round, feature, round({THRESHOLD}, 6) as threshold, round(gain, 6) as gain, round(below, 6) as below, "
            f"round(above, 6) as above from stump{k} join edges using (feature)" for k in range(1, rounds + 1)]
    return f"with {', '.join(ctes)} {' union all '.join(rows)}"


def _permuted() -> str:
    names = list(RULE_COEFFICIENTS)

    def right(moved: str | None) -> str:
        z = " + ".join([str(RULE_INTERCEPT), *[f"{w} * {'m' if c == moved else 'o'}.{c}" for c, w in RULE_COEFFICIENTS.items()]])
        return f"sum(if(if({z} > 0, 1, 0) = o.y, 1, 0))"

    ctes = [f"held as materialized (select *, row_number() over (order by md5('42:' || hadm_id), hadm_id) as nth, count(*) over () as n "
            f"from ({_part('test', names)}))",
            f"right_counts as (select max(o.n) as n, {right(None)} as own, {', '.join(f'{right(c)} as {c}' for c in names)} "
            "from held o join held m on o.nth = m.nth % m.n + 1)"]
    rows = [f"select '{c}' as feature, round(own / n, 9) as accuracy, round({c} / n, 9) as permuted_accuracy, "
            f"round((own - {c}) / n, 9) as importance from right_counts" for c in names]
    return f"with {', '.join(ctes)} {' union all '.join(rows)}"


COOCCURRENCE = """with placed as (select hadm_id, subject_id, unnest(string_split(diag_icd_codes, ' ')) as code,
  generate_subscripts(string_split(diag_icd_codes, ' '), 1) as place from diagnoses_of),
near as (select a.code as code_a, b.code as code_b, count(*) as n from placed a join placed b
  on a.hadm_id = b.hadm_id and a.subject_id = b.subject_id and abs(a.place - b.place) between 1 and 2 group by a.code, b.code),
sums as (select *, sum(n) over (partition by code_a) as na, sum(n) over (partition by code_b) as nb, sum(n) over () as nn from near)
select code_a, code_b, n, round(greatest(0, ln(cast(n as double) * nn / (cast(na as double) * nb))), 9) as ppmi from sums"""

QUERIES = {"lr_newton": _newton(), "pca_shares": _shares(), "best_splits": _best_splits(), "boosted_stumps": _stumps(),
           "permutation_importance": _permuted(), "code_cooccurrence": COOCCURRENCE}
