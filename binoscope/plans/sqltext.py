"""Building blocks of the SQL twins: the views of `bindings`, and metrics over any of them, as CTE text."""

from __future__ import annotations

from collections.abc import Sequence

CLS = """cls AS (
  SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS totalprice, c_acctbal AS acctbal,
         CAST(year(o_orderdate) AS DOUBLE) AS order_year, CAST(month(o_orderdate) AS DOUBLE) AS order_month,
         o_orderpriority AS priority, c_mktsegment AS segment, r_name AS region
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
CLS_NULLS = CLS + """, cls_nulls AS (
  SELECT id, y, CASE WHEN id % 17 <> 0 THEN totalprice END AS totalprice, CASE WHEN id % 13 <> 0 THEN acctbal END AS acctbal,
         order_year, order_month, CASE WHEN id % 11 <> 0 THEN priority END AS priority,
         CASE WHEN id % 19 <> 0 THEN segment END AS segment, region FROM cls)"""
LABELLED = """labelled AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)"""


def hex_of(*parts: str) -> str:
    """md5 of SQL expressions joined by '|'."""
    return "md5(" + " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"


def int_of(*parts: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr({hex_of(*parts)}, 1, {digits}) AS BIGINT)"


def score_of(salt: str | None = None, noise: int = 7, signal: int = 30000, row_id: str = "id") -> str:
    h = int_of(row_id) if salt is None else int_of(f"'{salt}'", row_id)
    return f"CAST((({h} % 10000) * {noise} + y * {signal}) // 10 AS DOUBLE) / CAST(10000.0 AS DOUBLE)"


def scored(source: str = "labelled") -> str:
    return f"scored AS (SELECT *, {score_of()} AS p FROM {source})"


SCORED = f"{LABELLED}, {scored()}"
SCORED_GROUPS = f"{CLS}, {scored('cls')}"
MODELS = {"model_a": (None, 7, 30000), "model_b": ("b", 7, 30000), "model_c": ("c", 8, 20000)}
SCORED_MODELS = LABELLED + ", scored_models AS (" + " UNION ALL ".join(
    f"SELECT id, y, '{name}' AS model, {score_of(*spec)} AS p FROM labelled" for name, spec in MODELS.items()) + ")"


def over(by: Sequence[str], order: str = "") -> str:
    inside = (f"PARTITION BY {', '.join(by)} " if by else "") + (f"ORDER BY {order}" if order else "")
    return f"OVER ({inside.strip()})"


def comma(by: Sequence[str]) -> str:
    return "".join(f"{c}, " for c in by)


def group_by(*columns: str) -> str:
    return f" GROUP BY {', '.join(columns)}" if columns else ""


def fold_of(k: int = 5, seed: str = "42", by: Sequence[str] = (), row_id: str = "id", purpose: str = "folds") -> str:
    """Fold number in hash order inside each class."""
    keys = [*by, "y"]
    return (f"CAST(((row_number() {over(keys, hex_of(seed, repr(purpose), row_id))} - 1) * {k}) // count(*) {over(keys)} AS BIGINT)")


def curve(source: str, by: Sequence[str] = (), name: str = "curve", weight: str = "1") -> str:
    """CTEs name_cells and name: one row per group and score with cumulative and total counts."""
    return f"""{name}_cells AS (
  SELECT {comma(by)}p, CAST(sum(y * {weight}) AS BIGINT) AS n_pos, CAST(sum((1 - y) * {weight}) AS BIGINT) AS n_neg
  FROM {source} GROUP BY {comma(by)}p),
{name} AS (
  SELECT *, CAST(sum(n_pos) {over(by, 'p DESC')} AS BIGINT) AS tp, CAST(sum(n_neg) {over(by, 'p DESC')} AS BIGINT) AS fp,
         CAST(sum(n_pos) {over(by)} AS BIGINT) AS n_p, CAST(sum(n_neg) {over(by)} AS BIGINT) AS n_n FROM {name}_cells)"""


AP = """CASE WHEN max(n_p) > 0 AND max(n_n) > 0
       THEN sum(CAST(n_pos * tp AS DOUBLE) / CAST(tp + fp AS DOUBLE)) / CAST(max(n_p) AS DOUBLE) END"""
AUC = """CASE WHEN max(n_p) > 0 AND max(n_n) > 0
       THEN sum(CAST(n_neg AS DOUBLE) * (tp - CAST(n_pos AS DOUBLE) / 2)) / (CAST(max(n_p) AS DOUBLE) * max(n_n)) END"""


def rate(numerator: str, denominator: str, empty: str = "0.0") -> str:
    """a / b as a double with a fixed value, or NULL, for an empty denominator."""
    quotient = f"CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0)"
    return quotient if empty == "NULL" else f"coalesce({quotient}, {empty})"


RATES = f"""{rate('true_positives', 'true_positives + false_positives')} AS precision,
  {rate('true_positives', 'true_positives + false_negatives')} AS recall,
  {rate('2 * true_positives', '2 * true_positives + false_positives + false_negatives')} AS f1"""


def evaluation(source: str, threshold: float, by: Sequence[str] = (), name: str = "evaluation", weight: str = "1") -> str:
    """CTEs ending in `name`: the full metric row per group."""
    group = group_by(*by)
    return curve(source, by, f"{name}_curve", weight) + f""",
{name}_counts AS (
  SELECT {comma(by)}{AUC} AS roc_auc, {AP} AS pr_auc,
    CAST(sum(n_neg * p * p + n_pos * (1 - p) * (1 - p)) AS DOUBLE) / CAST(max(n_p) + max(n_n) AS DOUBLE) AS brier_score,
    CAST(sum(CASE WHEN p < {threshold} THEN n_neg ELSE 0 END) AS BIGINT) AS true_negatives,
    CAST(sum(CASE WHEN p >= {threshold} THEN n_neg ELSE 0 END) AS BIGINT) AS false_positives,
    CAST(sum(CASE WHEN p < {threshold} THEN n_pos ELSE 0 END) AS BIGINT) AS false_negatives,
    CAST(sum(CASE WHEN p >= {threshold} THEN n_pos ELSE 0 END) AS BIGINT) AS true_positives,
    max(n_p) + max(n_n) AS n, max(n_p) AS positive_count FROM {name}_curve{group}),
{name} AS (
  SELECT {comma(by)}roc_auc, pr_auc, {RATES}, brier_score, CAST({threshold} AS DOUBLE) AS threshold, true_negatives,
         false_positives, false_negatives, true_positives, n, positive_count FROM {name}_counts)"""


GRID = "grid AS (SELECT CAST(round(i * 0.05, 2) AS DOUBLE) AS threshold FROM range(1, 20) t(i))"


def sweep(source: str, by: Sequence[str] = (), name: str = "sweep") -> str:
    """CTEs ending in `name`: confusion counts and rates at every threshold of the grid."""
    return f"""{GRID}, {name}_counts AS (
  SELECT {comma(by)}threshold, CAST(sum(CASE WHEN p < threshold AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS true_negatives,
    CAST(sum(CASE WHEN p >= threshold AND y = 0 THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
    CAST(sum(CASE WHEN p < threshold AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives,
    CAST(sum(CASE WHEN p >= threshold AND y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS true_positives
  FROM {source}, grid GROUP BY {comma(by)}threshold),
{name}_rates AS (SELECT *, {RATES} FROM {name}_counts),
{name} AS (
  SELECT {comma(by)}threshold, precision, recall, f1, {rate('5 * precision * recall', '4 * precision + recall')} AS f2,
    true_negatives, false_positives, false_negatives, true_positives,
    true_negatives + false_positives + false_negatives + true_positives AS n,
    true_positives + false_negatives AS positive_count FROM {name}_rates)"""


def choice(table: str, by: Sequence[str] = (), name: str = "choice") -> str:
    """CTE: the threshold with the highest F2, then precision, then threshold."""
    return f"""{name} AS (
  SELECT {comma(by)}threshold, f2, precision, recall FROM (
    SELECT *, row_number() {over(by, 'f2 DESC, precision DESC, threshold DESC')} AS best FROM {table}) WHERE best = 1)"""


def rounding(select: str, columns: Sequence[str], digits: int = 6) -> str:
    """The final SELECT over `select` (a CTE name) with the named doubles rounded."""
    replaced = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM {select}"


FOLD_METRICS = ["pr_auc", "roc_auc", "precision", "recall", "f1"]
EVALUATION_DOUBLES = ["roc_auc", "pr_auc", "precision", "recall", "f1", "brier_score"]

# Folds of the stand-in models, and the fold table of the comparison queries.
FOLDED_MODELS = (SCORED_MODELS + f""", folds AS (SELECT id, {fold_of()} AS fold FROM labelled),
folded AS (SELECT m.id, m.y, m.model, m.p, f.fold FROM scored_models m JOIN folds f ON m.id = f.id)""")
FOLD_TABLE = (FOLDED_MODELS + ", " + evaluation("folded", 0.5, ["model", "fold"], "per_fold") + ", "
              + sweep("folded", ["model", "fold"], "fold_sweep") + ", " + choice("fold_sweep", ["model", "fold"], "fold_choice")
              + """, others AS (SELECT f.id, f.y, f.model, f.p, o.outer_fold FROM folded f, (SELECT DISTINCT fold AS outer_fold FROM folds) o
  WHERE f.fold <> o.outer_fold), """ + evaluation("others", 0.5, ["model", "outer_fold"], "inside") + """,
fold_scores AS (
  SELECT e.model AS procedure, e.fold AS outer_fold, CASE WHEN e.fold % 2 = 0 THEN e.model ELSE 'model_a' END AS selected_model,
         c.threshold, i.pr_auc AS inner_cv_ap, e.pr_auc, e.roc_auc, e.precision, e.recall, e.f1
  FROM per_fold e JOIN fold_choice c ON e.model = c.model AND e.fold = c.fold
  JOIN inside i ON e.model = i.model AND e.fold = i.outer_fold)""")

# Trials: the same noise and signal settings as the Spark side, one search per outer fold and arm.
TRIAL_SETTINGS = [(9, 10000), (8, 20000), (7, 30000), (6, 40000), (6, 40000)]
TRIAL_SCORES = (LABELLED + f", folds AS (SELECT id, y, {fold_of()} AS fold FROM labelled), trial_scored AS ("
                + " UNION ALL ".join(f"SELECT id, y, fold, CAST({i} AS BIGINT) AS number, {score_of('t', noise, signal)} AS p FROM folds"
                                     for i, (noise, signal) in enumerate(TRIAL_SETTINGS))
                + "), " + evaluation("trial_scored", 0.5, ["number", "fold"], "trial_folds")
                + """, trials AS (
  SELECT number, CASE WHEN number = 1 THEN 'FAIL' ELSE 'COMPLETE' END AS state,
         CASE WHEN number % 2 = 0 THEN 'even' ELSE 'odd' END AS model, 'setting_' || CAST(number AS VARCHAR) AS parameters,
         list(round(pr_auc, 10) ORDER BY fold) AS fold_scores FROM trial_folds GROUP BY number)""")
