"""Logistic fits in SQL: accelerated proximal gradient steps in a recursive query.

``fit_rows(x, y, pick)`` holds the rows, ``x`` with a one at its end, and ``models(m, c, pick)`` the models; a model uses the
rows for which ``uses`` holds.  A model that sees one class only always names that class.
"""

from __future__ import annotations

STEP = "(1 + sqrt(1 + 4 * t * t)) / 2"


def fit_sql(width: int, penalty: str = "l2", steps: int = 1500, uses: str = "true") -> str:
    """``fitted(m, w)``: the weights of every model, the intercept last.  ``width`` counts the one as well."""
    gradient = ", ".join(f"sum((1 / (1 + exp(-z)) - y) * x[{j}])" for j in range(1, width + 1))
    moved = [f"v[{j}] - g[{j}] / big" for j in range(1, width + 1)]
    if penalty == "l2":
        new = [f"v[{j}] - (g[{j}] + v[{j}] / c) / big" for j in range(1, width)]
    else:
        new = [f"sign({x}) * greatest(abs({x}) - 1 / (c * big), 0)" for x in moved[:-1]]
    zero = ", ".join(["0.0::double"] * width)
    return f"""sizes as (select m, any_value(s.c) as c, any_value(s.pick) as pick, min(y) as low, max(y) as high,
  0.25 * sum(list_dot_product(x, x)) {"+ 1 / any_value(s.c)" if penalty == "l2" else ""} as big
  from models s join fit_rows r on {uses} group by m),
steps(k, m, w, v, t) as (
  select 0, m, [{zero}], [{zero}], 1.0::double from models
  union all
  select k + 1, m, new, case when back then new else list_transform(list_zip(new, w), lambda p: p[1] + (t - 1) / ({STEP}) * (p[1] - p[2])) end,
    case when back then 1 else {STEP} end
  from (select *, list_sum(list_transform(list_zip(v, new, w), lambda p: (p[1] - p[2]) * (p[2] - p[3]))) > 0 as back from (
    select *, [{", ".join([*new, moved[-1]])}] as new from (
      select k, m, w, v, t, c, big, [{gradient}] as g
      from (select p.k, p.m, p.w, p.v, p.t, s.c, s.big, r.x, r.y, list_dot_product(p.v, r.x) as z
        from steps p join sizes s on p.m = s.m join fit_rows r on {uses} where p.k < {steps})
      group by k, m, w, v, t, c, big)))),
fitted as (select m, case when low = high then [{", ".join(["0.0::double"] * (width - 1))}, (2 * low - 1) * 'inf'::double] else w end as w
  from steps join sizes using (m) where k = {steps})"""


def logit_sql(w: str = "w", x: str = "x") -> str:
    return f"list_dot_product({w}, {x})"


def chance_sql(w: str = "w", x: str = "x") -> str:
    return f"1 / (1 + exp(-{logit_sql(w, x)}))"
