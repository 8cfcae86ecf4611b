"""SQL twins of fitted models: preparation, Newton steps and boosted trees unrolled into CTEs, for any columns.

A CTE of rows has id, y, the raw columns and `g`, the training set a row belongs to (a table may hold a row once per set).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from binoscope.plans.sqltext import fold_of, hex_of, over

PARTS = f"""parts AS (SELECT *, CASE WHEN row_number() {over(['y'], hex_of('42', "'split'", 'id'))}
  <= floor(0.2 * count(*) {over(['y'])} + 0.5) THEN 'test' ELSE 'train' END AS partition FROM cls_nulls)"""
STEPS = 5                       # Newton steps from zero; the error is squared at each


def folds(source: str, name: str, k: int, seed: str = "42", purpose: str = "folds") -> str:
    return f"{name} AS (SELECT *, {fold_of(k, seed, purpose=purpose)} AS fold FROM {source})"


def training_sets(source: str, name: str, k: int) -> str:
    """Every row once for each fold it trains, g being the held-out fold."""
    return f"{name} AS (SELECT t.*, CAST(f.range AS BIGINT) AS g FROM {source} t, range({k}) f WHERE t.fold <> f.range)"


def design(train: str, rows: str, numeric: Sequence[str], categorical: Mapping[str, Sequence[str]], name: str, scale: bool = True,
           keep: Sequence[str] = ("id", "y")) -> str:
    """CTE `name`: (keep..., g, x0, x1, ...) of `rows`, filled, scaled and coded by the statistics of `train` per g."""
    medians = ", ".join(f"coalesce(quantile_cont({c}, 0.5), 0) AS m{i}" for i, c in enumerate(numeric))
    moments = ", ".join(f"avg(coalesce({c}, m{i})) AS a{i}, stddev_pop(coalesce({c}, m{i})) AS s{i}" for i, c in enumerate(numeric))
    made = [f"{name}_med AS MATERIALIZED (SELECT g{', ' + medians if numeric else ''} FROM {train} GROUP BY g)",
            f"{name}_mom AS MATERIALIZED (SELECT t.g{', ' + moments if numeric else ''} FROM {train} t JOIN {name}_med m ON t.g = m.g GROUP BY t.g)"]
    for i, c in enumerate(categorical):
        made.append(f"{name}_mode{i} AS MATERIALIZED (SELECT g, arg_min({c}, (-n, {c})) AS c{i} FROM (SELECT g, {c}, count(*) AS n FROM {train} "
                    f"WHERE {c} IS NOT NULL GROUP BY g, {c}) GROUP BY g)")
    cells, at = ["1.0::DOUBLE AS x0"], 1
    for i, c in enumerate(numeric):
        filled = f"coalesce(CAST(r.{c} AS DOUBLE), m{i})"
        cells.append((f"({filled} - a{i}) / (CASE WHEN s{i} > 0 THEN s{i} ELSE 1 END)" if scale else filled) + f" AS x{at}")
        at += 1
    for i, (c, levels) in enumerate(categorical.items()):
        for level in levels:
            cells.append(f"CASE WHEN coalesce(r.{c}, c{i}) = '{level}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x{at}")
            at += 1
    joins = " ".join(f"JOIN {name}_{t} USING (g)" for t in ("med", "mom", *[f"mode{i}" for i in range(len(categorical))]))
    made.append(f"{name} AS MATERIALIZED (SELECT {', '.join(f'r.{k}' for k in keep)}, r.g, {', '.join(cells)} FROM {rows} r {joins})")
    return ",\n".join(made)


def width(numeric: Sequence[str], categorical: Mapping[str, Sequence[str]]) -> int:
    return 1 + len(numeric) + sum(map(len, categorical.values()))


def newton(x: str, d: int, name: str, C: float = 1.0, balanced: bool = False, steps: int = STEPS) -> str:
    """CTEs ending in `name`: (g, b0, b1, ...), the penalised logistic coefficients of every training set in `x`."""
    weighted = f"{name}_w"
    weight = "count(*) OVER (PARTITION BY g) / (2.0::DOUBLE * count(*) OVER (PARTITION BY g, y))" if balanced else "1.0::DOUBLE"
    made = [f"{weighted} AS MATERIALIZED (SELECT *, {weight} AS w FROM {x})",
            f"{name}_0 AS MATERIALIZED (SELECT DISTINCT g, {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(d))} FROM {x})"]
    for t in range(steps):
        now = f"{name}_{t}"
        margin = " + ".join(f"b{i} * x{i}" for i in range(d))
        sums = [f"-sum(w * (p - y) * x{i}){f' - any_value(b{i}) / {C!r}::DOUBLE' if i else ''} AS r{i}" for i in range(d)]
        sums += [f"sum(w * p * (1 - p) * x{i} * x{j}){f' + 1 / {C!r}::DOUBLE' if i == j and i else ''} AS a{i}_{j}" for i in range(d) for j in range(i, d)]
        made.append(f"{now}_e AS MATERIALIZED (SELECT g, {', '.join(sums)} FROM (SELECT x.*, n.* EXCLUDE (g), 1 / (1 + exp(-({margin}))) AS p "
                    f"FROM {weighted} x JOIN {now} n ON x.g = n.g) GROUP BY g)")
        # The system as one list, row by row with its right side last; every step clears a column outside its own row.
        cells = ", ".join(", ".join([*(f"a{min(i, j)}_{max(i, j)}" for j in range(d)), f"r{i}"]) for i in range(d))
        made.append(f"{now}_m0 AS MATERIALIZED (SELECT g, [{cells}] AS m FROM {now}_e)")
        n = d + 1
        for k in range(d):
            pivot = k * n + 1
            made.append(f"{now}_m{k + 1} AS MATERIALIZED (SELECT g, list_transform(m, lambda v, i: CASE WHEN (i - 1) // {n} = {k} THEN v "
                        f"ELSE v - m[((i - 1) // {n}) * {n} + {k + 1}] / m[{pivot + k}] * m[{pivot} + (i - 1) % {n}] END) AS m FROM {now}_m{k})")
        moved = ", ".join(f"n.b{i} + s.m[{i * n + n}] / s.m[{i * n + i + 1}] AS b{i}" for i in range(d))
        made.append(f"{name}_{t + 1} AS MATERIALIZED (SELECT n.g, {moved} FROM {now} n JOIN {now}_m{d} s ON n.g = s.g)")
    made.append(f"{name} AS (SELECT * FROM {name}_{steps})")
    return ",\n".join(made)


def linear(x: str, b: str, d: int, name: str, keep: Sequence[str] = ("id", "y")) -> str:
    """CTE `name`: (keep..., g, margin, p) of every row of `x` by the coefficients of its g."""
    margin = " + ".join(f"b{i} * x{i}" for i in range(d))
    return (f"{name} AS (SELECT {comma_of(keep)}g, margin, 1 / (1 + exp(-margin)) AS p FROM (SELECT {', '.join(f'x.{k}' for k in keep)}, x.g, "
            f"{margin} AS margin FROM {x} x JOIN {b} n ON x.g = n.g))")


def comma_of(names: Sequence[str]) -> str:
    return "".join(f"{n}, " for n in names)


def sigmoids(margins: str, name: str, steps: int = 12) -> str:
    """CTE `name`: (g, a, b), the sigmoid with smoothed targets fitted on (g, margin, y) per g."""
    made = [f"{name}_n AS MATERIALIZED (SELECT g, sum(y) AS n1, sum(1 - y) AS n0 FROM {margins} GROUP BY g)",
            f"{name}_t AS MATERIALIZED (SELECT m.g, margin AS m, CASE WHEN y = 1 THEN (n1 + 1) / (n1 + 2.0::DOUBLE) ELSE 1 / (n0 + 2.0::DOUBLE) END AS t "
            f"FROM {margins} m JOIN {name}_n n ON m.g = n.g)",
            f"{name}_0 AS MATERIALIZED (SELECT g, 0.0::DOUBLE AS a, ln((n1 + 1) / (n0 + 1.0::DOUBLE)) AS b FROM {name}_n)"]
    for k in range(steps):
        made.append(f"""{name}_h{k} AS MATERIALIZED (SELECT g, any_value(a) AS a, any_value(b) AS b, sum((p - t) * m) AS ga, sum(p - t) AS gb,
  sum(p * (1 - p) * m * m) AS haa, sum(p * (1 - p) * m) AS hab, sum(p * (1 - p)) AS hbb
  FROM (SELECT r.*, a, b, 1 / (1 + exp(-(a * m + b))) AS p FROM {name}_t r JOIN {name}_{k} s ON r.g = s.g) GROUP BY g)""")
        made.append(f"""{name}_{k + 1} AS MATERIALIZED (SELECT g, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
  b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM {name}_h{k})""")
    made.append(f"{name} AS (SELECT * FROM {name}_{steps})")
    return ",\n".join(made)


def boosted(train: str, rows: str, numeric: Sequence[str], categorical: Mapping[str, Sequence[str]], name: str, rounds: int, rate: float = 0.05,
            leaves: int = 7, least: int = 20, bins: int = 255, l2: float = 0.0) -> str:
    """CTEs ending in `name`: (id, p) of `rows` after `rounds` trees of exactly best-first splits, fitted on `train` (g = 0)."""
    d = width(numeric, categorical) - 1
    made = [design(train, train, numeric, categorical, f"{name}_xt", scale=False), design(train, rows, numeric, categorical, f"{name}_xr", scale=False),
            f"{name}_base AS MATERIALIZED (SELECT ln(sum(y) / CAST(sum(1 - y) AS DOUBLE)) AS f FROM {train})"]
    spread = " UNION ALL ".join(f"SELECT {c} AS v, {i} AS c FROM {train} WHERE {c} IS NOT NULL" for i, c in enumerate(numeric))
    made.append(f"""{name}_cells AS MATERIALIZED (SELECT c, v, n, sum(n) OVER (PARTITION BY c ORDER BY v) AS run, sum(n) OVER (PARTITION BY c) AS total,
  count(*) OVER (PARTITION BY c) AS kinds FROM (SELECT c, CAST(v AS DOUBLE) AS v, count(*) AS n FROM ({spread}) GROUP BY c, v))""")
    edges = [f"SELECT c + 1 AS c, v AS e FROM {name}_cells WHERE run < total AND ((run * {bins}) // total > ((run - n) * {bins}) // total OR kinds <= {bins})"]
    edges += [f"SELECT {k} AS c, 0.5::DOUBLE AS e" for k in range(len(numeric) + 1, d + 1)]
    made.append(f"{name}_edges AS MATERIALIZED ({' UNION ALL '.join(edges)})")
    # The place of every training cell among its column's edges is found once.
    long = " UNION ALL ".join(f"SELECT id, {k} AS c, x{k} AS v FROM {name}_xt" for k in range(1, d + 1))
    made.append(f"{name}_long AS MATERIALIZED (SELECT l.id, l.c, (SELECT min(e) FROM {name}_edges e WHERE e.c = l.c AND e.e >= l.v) AS e FROM ({long}) l)")
    made.append(f"{name}_f0 AS MATERIALIZED (SELECT id, y, f FROM {name}_xt, {name}_base)")
    made.append(f"{name}_p0 AS MATERIALIZED (SELECT id, f FROM {name}_xr, {name}_base)")
    for t in range(rounds):
        tree = f"{name}_t{t}"
        made.append(f"{tree}_w AS MATERIALIZED (SELECT id, 1 / (1 + exp(-f)) - y AS g, (1 / (1 + exp(-f))) * (1 - 1 / (1 + exp(-f))) AS h FROM {name}_f{t})")
        made.append(f"{tree}_l0 AS MATERIALIZED (SELECT id, 0 AS leaf FROM {tree}_w)")
        made.append(f"{tree}_r0 AS MATERIALIZED (SELECT id, 0 AS leaf FROM {name}_p{t})")
        for s in range(leaves - 1):
            # Left of an edge are the cells whose first edge from above is it or an earlier one.
            made.append(f"""{tree}_b{s} AS MATERIALIZED (SELECT leaf, c, e, gain FROM (
  SELECT leaf, c, e, round(lg * lg / (lh + {l2!r} + 1e-15) + (tg - lg) * (tg - lg) / (th - lh + {l2!r} + 1e-15) - tg * tg / (th + {l2!r} + 1e-15), 9) AS gain FROM (
    SELECT leaf, c, e, sum(g) OVER o AS lg, sum(h) OVER o AS lh, sum(n) OVER o AS ln, sum(g) OVER w AS tg, sum(h) OVER w AS th, sum(n) OVER w AS tn FROM (
      SELECT l.leaf, v.c, v.e, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {name}_long v JOIN {tree}_l{s} l ON v.id = l.id JOIN {tree}_w g ON g.id = v.id
      GROUP BY l.leaf, v.c, v.e) WINDOW o AS (PARTITION BY leaf, c ORDER BY e NULLS LAST), w AS (PARTITION BY leaf, c))
  WHERE e IS NOT NULL AND ln >= {least} AND tn - ln >= {least} AND lh >= 1e-3 AND th - lh >= 1e-3)
  WHERE gain > 0 ORDER BY gain DESC, leaf, c, e LIMIT 1)""")
            goes = " ".join(f"WHEN c = {k} THEN x.x{k} <= e" for k in range(1, d + 1))
            for side, cells in (("l", "xt"), ("r", "xr")):
                made.append(f"""{tree}_{side}{s + 1} AS MATERIALIZED (SELECT l.id, CASE WHEN b.leaf IS NULL THEN l.leaf WHEN CASE {goes} END THEN {2 * s + 1} ELSE {2 * s + 2} END AS leaf
  FROM {tree}_{side}{s} l JOIN {name}_{cells} x ON x.id = l.id LEFT JOIN {tree}_b{s} b ON l.leaf = b.leaf)""")
        last = leaves - 1
        made.append(f"{tree}_v AS MATERIALIZED (SELECT leaf, -{rate!r}::DOUBLE * sum(g) / (sum(h) + {l2!r} + 1e-15) AS v FROM {tree}_l{last} JOIN {tree}_w USING (id) GROUP BY leaf)")
        made.append(f"{name}_f{t + 1} AS MATERIALIZED (SELECT f.id, f.y, f.f + v AS f FROM {name}_f{t} f JOIN {tree}_l{last} USING (id) JOIN {tree}_v USING (leaf))")
        made.append(f"{name}_p{t + 1} AS MATERIALIZED (SELECT p.id, p.f + v AS f FROM {name}_p{t} p JOIN {tree}_r{last} USING (id) JOIN {tree}_v USING (leaf))")
    made.append(f"{name} AS (SELECT id, 1 / (1 + exp(-f)) AS p FROM {name}_p{rounds})")
    return ",\n".join(made)
