"""SQL texts that recompute the deterministic queries from the same tables.

The random draws are recomputed from the hash function itself, written out in wide integer
arithmetic; everything after that is ordinary SQL.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import combinations

import xxhash

from culprit import fixed_values as V
from culprit.operators.scorecard import fixed_scorecards

SEED = V.SEED
WORD = 2**64

# Fixed values of the 64-bit xxHash function.
PRIME_1 = 11400714785074694791
PRIME_2 = 14029467366897019727
PRIME_3 = 1609587929392839161
PRIME_4 = 9650029242287828579
PRIME_5 = 2870177450012600261


def number(x) -> str:
    return f"{float(x)!r}::DOUBLE"


def r6(expression: str, name: str | None = None, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name or expression}"


def draws(name: str, streams: dict[str, str], source: str, key: str) -> str:
    """CTEs that give ``name(id, s, u, z, o)``: uniform, normal and order draw per stream."""

    def wrap(x):
        return f"(({x}) & {WORD - 1}::UHUGEINT)"

    def times(x, prime):
        return wrap(f"({x}) * {prime}::UHUGEINT")

    def right(x, bits):
        return f"({x} >> {bits}::UHUGEINT)"

    def rotate(x, bits):
        return f"({wrap(f'{x} * {2**bits}::UHUGEINT')} + {right(x, 64 - bits)})"

    start = {
        s: (xxhash.xxh64_intdigest(text.encode(), seed=42) + PRIME_5 + 8) % WORD
        for s, text in streams.items()
    }
    values = ", ".join(f"('{s}', {h}::UHUGEINT)" for s, h in start.items())
    return f"""
{name}_s(s, h) AS (VALUES {values}),
{name}_1 AS (SELECT {key} AS id, s, h, {times(f'{key}::UHUGEINT', PRIME_2)} AS k FROM {source}, {name}_s),
{name}_2 AS (SELECT id, s, xor(h, {times(rotate('k', 31), PRIME_1)}) AS h FROM {name}_1),
{name}_3 AS (SELECT id, s, {wrap(times(rotate('h', 27), PRIME_1) + f' + {PRIME_4}::UHUGEINT')} AS h FROM {name}_2),
{name}_4 AS (SELECT id, s, {times(f"xor(h, {right('h', 33)})", PRIME_2)} AS h FROM {name}_3),
{name}_5 AS (SELECT id, s, {times(f"xor(h, {right('h', 29)})", PRIME_3)} AS h FROM {name}_4),
{name}_6 AS (SELECT id, s, xor(h, {right('h', 32)}) AS h FROM {name}_5),
{name} AS (SELECT id, s, {right('h', 12)}::BIGINT AS o,
  ({right('h', 12)}::DOUBLE + 0.5::DOUBLE) * {number(2.0**-52)} AS u,
  sqrt(-2.0::DOUBLE * ln(({right('h', 32)}::DOUBLE + 0.5::DOUBLE) * {number(2.0**-32)}))
    * cos(2.0::DOUBLE * pi() * (((h & {2**32 - 1}::UHUGEINT)::DOUBLE + 0.5::DOUBLE) * {number(2.0**-32)})) AS z
  FROM {name}_6)"""


def stream(name: str) -> str:
    return f"{SEED}|{name}"


def label_case(u: str) -> str:
    total, bound, whens = sum(V.ROOT_CAUSE_PRIOR.values()), 0.0, []
    labels = list(V.ROOT_CAUSE_PRIOR)
    for name in labels[:-1]:
        bound += V.ROOT_CAUSE_PRIOR[name] / total
        whens.append(f"WHEN {u} < {number(bound)} THEN '{name}'")
    return f"CASE {' '.join(whens)} ELSE '{labels[-1]}' END"


def mixture_values() -> str:
    rows = []
    for cause, signals in V.MIXTURE.items():
        for metric, parts in signals.items():
            hi = 0.0
            for k, (p, (mean, std)) in enumerate(parts):
                lo, hi = hi, hi + p
                cells = ", ".join(number(x) for x in (p, mean, std, lo, hi))
                rows.append(f"('{cause}', '{metric}', {k}, {cells})")
    return f"mixture(root_cause, metric, k, p, mean, std, lo, hi) AS (VALUES {', '.join(rows)})"


def poisson(name: str, u: str, rate: str, source: str) -> str:
    return f"""
{name}_cdf AS (SELECT incident_id, {u} AS u,
  sum(exp(j * ln({rate}) - {rate} - lgamma(j + 1))) OVER (PARTITION BY incident_id ORDER BY j) AS cdf
  FROM {source}, range(0, 60) AS steps(j)),
{name} AS (SELECT incident_id, count(*) FILTER (WHERE u >= cdf) AS n FROM {name}_cdf GROUP BY incident_id)"""


def incident_steps() -> str:
    """CTEs from ``events`` to ``incidents``, with each stage under its own name."""
    names = list(V.BASELINES)
    streams = {"label": stream("label"), "oom": stream("oom"), "timeout": stream("timeout")}
    streams |= {f"base_{n}": stream(f"base:{n}") for n in names}
    streams |= {f"pick_{n}": stream(f"pick:{n}") for n in names}
    streams |= {f"shift_{n}": stream(f"shift:{n}") for n in names}
    streams |= {"noise_cpu": stream("noise:avg_cpu"), "noise_latency": stream("noise:latency")}
    uniform = ["label", "oom", "timeout"] + [f"pick_{n}" for n in names]
    picked = [
        f"max({'u' if s in uniform else 'z'}) FILTER (WHERE s = '{s}') AS {s}" for s in streams
    ]
    base = ", ".join(f"{number(m)} + {number(sd)} * base_{n} AS {n}" for n, (m, sd) in V.BASELINES.items())
    joins = "\n".join(
        f"LEFT JOIN mixture m_{n} ON m_{n}.root_cause = b.{V.LABEL} AND m_{n}.metric = '{n}' "
        f"AND b.pick_{n} >= m_{n}.lo AND b.pick_{n} < m_{n}.hi"
        for n in names
    )
    shifts = ", ".join(
        f"b.{n} + coalesce(m_{n}.mean + m_{n}.std * b.shift_{n}, 0.0::DOUBLE) AS {n}, m_{n}.k AS k_{n}"
        for n in names
    )
    pull = " + ".join(f"{number(w)} * {n}" for n, w in V.LATENCY_WEIGHTS.items())
    stress = " + ".join([number(V.STRESS_BIAS)] + [f"{number(w)} * {n}" for n, w in V.STRESS_WEIGHTS.items()])
    return f"""{draws('d', streams, 'events', 'event_id')},
{mixture_values()},
wide AS (SELECT id AS incident_id, {', '.join(picked)} FROM d GROUP BY id),
based AS (SELECT *, {label_case('label')} AS {V.LABEL}, {base} FROM wide),
shifted AS (SELECT b.incident_id, b.{V.LABEL}, b.oom, b.timeout, b.noise_cpu, b.noise_latency, {shifts}
  FROM based b {joins}),
coupled_1 AS (SELECT * REPLACE (
  least(greatest(avg_cpu + ({number(V.CPU_PER_REQUEST)} * request_rate
    + ({number(V.CPU_NOISE[0])} + {number(V.CPU_NOISE[1])} * noise_cpu)), 0.0::DOUBLE), 100.0::DOUBLE) AS avg_cpu,
  dependency_latency + {number(V.DEPENDENCY_PER_EXCESS_REQUEST)}
    * greatest(request_rate - {number(V.NORMAL_REQUEST_RATE)}, 0.0::DOUBLE) AS dependency_latency) FROM shifted),
coupled_2 AS (SELECT * REPLACE (mem_growth + {number(V.MEMORY_PER_CPU)} * avg_cpu AS mem_growth) FROM coupled_1),
coupled AS (SELECT * REPLACE (greatest(latency + ({number(V.LATENCY_NOISE[0])}
  + {number(V.LATENCY_NOISE[1])} * noise_latency + {pull}), {number(V.LATENCY_FLOOR)}) AS latency) FROM coupled_2),
stressed AS (SELECT *, {stress} AS stress FROM coupled),
raised AS (SELECT * REPLACE (error_rate + 1.0::DOUBLE / (1.0::DOUBLE + exp(-stress)) AS error_rate),
  greatest(mem_growth * {number(V.OOM_PER_MEMORY)}, {number(V.OOM_FLOOR)}) AS oom_rate,
  greatest(dependency_latency / {number(V.DEPENDENCY_LATENCY_PER_TIMEOUT)}, {number(V.TIMEOUT_FLOOR)}) AS timeout_rate
  FROM stressed),
{poisson('oom_n', 'oom', 'oom_rate', 'raised')},
{poisson('timeout_n', 'timeout', 'timeout_rate', 'raised')},
incidents AS (SELECT incident_id, avg_cpu AS avg_cpu_usage, greatest(mem_growth, 0.0::DOUBLE) AS mem_growth,
  oom_n.n AS oom_log_count, greatest(request_rate, 0.0::DOUBLE) AS request_rate,
  greatest(error_rate, 0.0::DOUBLE) AS error_rate, latency, upstream_error AS upstream_error_rate,
  greatest(dependency_latency, 1.0::DOUBLE) AS dependency_latency, timeout_n.n AS timeout_log_count, {V.LABEL}
  FROM raised JOIN oom_n USING (incident_id) JOIN timeout_n USING (incident_id))"""


SIMULATED = "WITH " + incident_steps()

OBSERVED = f"""WITH incidents AS (
  SELECT event_id AS incident_id, least(value, 100.0::DOUBLE) AS avg_cpu_usage, value / 10.0::DOUBLE AS mem_growth,
    (user_id % 7)::BIGINT AS oom_log_count, json_extract_string(props, '$.k')::DOUBLE * 10.0::DOUBLE AS request_rate,
    value - floor(value) AS error_rate, value * 2.0::DOUBLE + 50.0::DOUBLE AS latency,
    json_extract_string(props, '$.k')::DOUBLE / 100.0::DOUBLE - 0.5::DOUBLE AS upstream_error_rate,
    extract('minute' FROM ts)::DOUBLE * 5.0::DOUBLE + 1.0::DOUBLE AS dependency_latency,
    extract('second' FROM ts)::BIGINT AS timeout_log_count,
    CASE event_type WHEN 'error' THEN 'bad_deployment' WHEN 'view' THEN 'normal' WHEN 'click' THEN 'traffic_spike'
      WHEN 'purchase' THEN 'external_dependency_failure'
      WHEN 'signup' THEN CASE WHEN value > 40.0::DOUBLE THEN 'memory_leak' ELSE 'cpu_saturation' END END AS {V.LABEL}
  FROM events)"""
DOUBLE_SIGNALS = [s for s in V.SIGNALS if not s.endswith("_count")]
ROUNDED_SIGNALS = ", ".join(s if s.endswith("_count") else r6(s) for s in V.SIGNALS)


def parts(name: str, shares: list[Fraction], source: str = "incidents", label: str = V.LABEL) -> str:
    """CTEs that give ``name(incident_id, part)`` by rank within the class."""
    steps = [draws(f"{name}_d", {"o": stream(name)}, source, "incident_id")]
    steps.append(f"{name}_q AS (SELECT {label}, count(*) AS rest, 0 AS cut FROM {source} GROUP BY {label})")
    left, prev, kept = sum(shares), f"{name}_q", []
    for i, share in enumerate(shares[:-1]):
        f = share / left
        left -= share
        keep = "".join(f", {c}" for c in kept)
        steps.append(
            f"{name}_a{i} AS (SELECT {label}, rest, cut{keep}, sum(rest) OVER () AS total, "
            f"(sum(rest) OVER () * {f.numerator}) // {f.denominator} AS size FROM {prev})"
        )
        steps.append(
            f"{name}_b{i} AS (SELECT *, (rest * size) // total AS base, (rest * size) % total AS rem FROM {name}_a{i})"
        )
        steps.append(
            f"{name}_c{i} AS (SELECT *, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, {label}) "
            f"<= size - sum(base) OVER () THEN 1 ELSE 0 END AS quota FROM {name}_b{i})"
        )
        steps.append(
            f"{name}_e{i} AS (SELECT {label}, rest - quota AS rest, cut + quota AS cut{keep}, "
            f"cut + quota AS cut_{i} FROM {name}_c{i})"
        )
        prev = f"{name}_e{i}"
        kept.append(f"cut_{i}")
    passed = " + ".join(f"CASE WHEN rn > {c} THEN 1 ELSE 0 END" for c in kept)
    steps.append(
        f"{name}_r AS (SELECT incident_id, t.{label}, row_number() OVER (PARTITION BY t.{label} ORDER BY o, incident_id) AS rn "
        f"FROM {source} t JOIN {name}_d ON id = incident_id)"
    )
    steps.append(
        f"{name} AS (SELECT incident_id, {name}_r.{label}, ({passed})::INTEGER AS part FROM {name}_r JOIN {prev} USING ({label}))"
    )
    return ",\n".join(steps)


def splits() -> str:
    train, val = Fraction(V.TRAIN_SHARE), Fraction(V.VAL_SHARE)
    return parts("split", [train, val, 1 - train - val])


SPLIT_NAME = "CASE part WHEN 0 THEN 'train' WHEN 1 THEN 'val' ELSE 'eval' END"


def sample(name: str, stream_name: str, n: int, source: str = "incidents") -> str:
    return f"""{draws(f'{name}_d', {'o': stream(stream_name)}, source, 'incident_id')},
{name} AS (SELECT t.* FROM {source} t JOIN {name}_d ON id = incident_id ORDER BY o, incident_id LIMIT {n})"""


def scored(name: str, card, source: str, keys: str) -> str:
    """CTEs that give ``name(keys.., m0.., p0.., prediction)`` for a scorecard."""
    n = len(card.classes)
    margins = ", ".join(
        " + ".join([number(b)] + [f"{number(w)} * {f}" for w, f in zip(row, card.features)]) + f" AS m{i}"
        for i, (b, row) in enumerate(zip(card.intercepts, card.weights))
    )
    top = f"greatest({', '.join(f'm{i}' for i in range(n))})"
    exps = ", ".join(f"exp(m{i} - {top}) AS e{i}" for i in range(n))
    total = " + ".join(f"e{i}" for i in range(n))
    probas = ", ".join(f"e{i} / ({total}) AS p{i}" for i in range(n))
    best = f"greatest({', '.join(f'p{i}' for i in range(n))})"
    case = " ".join(f"WHEN p{i} = {best} THEN '{c}'" for i, c in enumerate(card.classes))
    return f"""{name}_m AS (SELECT *, {margins} FROM {source}),
{name}_e AS (SELECT *, {exps} FROM {name}_m),
{name}_p AS (SELECT *, {probas} FROM {name}_e),
{name} AS (SELECT {keys}, CASE {case} END AS prediction, {', '.join(f'p{i}' for i in range(n))} FROM {name}_p)"""


CARDS = fixed_scorecards()
CLASSES = CARDS[0].classes
CLASS_VALUES = "classes(c, class) AS (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(CLASSES)) + ")"


def all_scored(source: str = "incidents") -> str:
    ctes = [scored(f"s{i}", card, source, f"'{card.name}' AS model_name, incident_id, {V.LABEL} AS actual") for i, card in enumerate(CARDS)]
    union = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(len(CARDS)))
    return ",\n".join(ctes) + f",\nscores AS ({union})"


def report_steps(source: str = "scores") -> str:
    return f"""cells AS (SELECT model_name, actual, prediction, count(*) AS n FROM {source} GROUP BY ALL),
labels_seen AS (SELECT model_name, actual AS class FROM cells UNION SELECT model_name, prediction FROM cells),
per_class AS (SELECT l.model_name, l.class,
  coalesce((SELECT sum(n) FROM cells c WHERE c.model_name = l.model_name AND c.actual = l.class), 0) AS support,
  coalesce((SELECT sum(n) FROM cells c WHERE c.model_name = l.model_name AND c.prediction = l.class), 0) AS called,
  coalesce((SELECT sum(n) FROM cells c WHERE c.model_name = l.model_name AND c.actual = l.class AND c.prediction = l.class), 0) AS hits
  FROM labels_seen l),
class_report AS (SELECT model_name, class,
  CASE WHEN called = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / called::DOUBLE END AS precision,
  CASE WHEN support = 0 THEN 0.0::DOUBLE ELSE hits::DOUBLE / support::DOUBLE END AS recall,
  CASE WHEN called + support = 0 THEN 0.0::DOUBLE ELSE (2 * hits)::DOUBLE / (called + support)::DOUBLE END AS f1,
  support, hits FROM per_class),
model_avg AS (SELECT model_name, sum(hits)::DOUBLE / sum(support)::DOUBLE AS accuracy,
  avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1,
  sum(precision * support::DOUBLE) / sum(support)::DOUBLE AS weighted_precision,
  sum(recall * support::DOUBLE) / sum(support)::DOUBLE AS weighted_recall,
  sum(f1 * support::DOUBLE) / sum(support)::DOUBLE AS weighted_f1, sum(support) AS support
  FROM class_report GROUP BY model_name),
report AS (
  SELECT model_name, class, precision, recall, f1, support FROM class_report
  UNION ALL SELECT model_name, 'accuracy', accuracy, accuracy, accuracy, support FROM model_avg
  UNION ALL SELECT model_name, 'macro avg', macro_precision, macro_recall, macro_f1, support FROM model_avg
  UNION ALL SELECT model_name, 'weighted avg', weighted_precision, weighted_recall, weighted_f1, support FROM model_avg),
confusion AS (SELECT a.model_name, a.class AS actual, b.class AS predicted, coalesce(c.n, 0)::BIGINT AS n
  FROM labels_seen a JOIN labels_seen b ON a.model_name = b.model_name
  LEFT JOIN cells c ON c.model_name = a.model_name AND c.actual = a.class AND c.prediction = b.class)"""


def auc_steps(source: str, by: str) -> str:
    """CTEs that give ``auc(by.., n_pos, n_neg, roc_auc)`` from ``source(by.., score, positive)``."""
    return f"""ties AS (SELECT {by}, score, count(*) FILTER (WHERE positive) AS pos,
  count(*) FILTER (WHERE NOT positive) AS neg FROM {source} GROUP BY {by}, score),
below AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY score
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lower FROM ties),
auc AS (SELECT {by}, sum(pos)::BIGINT AS n_pos, sum(neg)::BIGINT AS n_neg,
  sum(pos::DOUBLE * (lower::DOUBLE + neg::DOUBLE / 2.0)) / nullif(sum(pos)::DOUBLE * sum(neg)::DOUBLE, 0.0) AS roc_auc
  FROM below GROUP BY {by})"""


def class_scores_long() -> str:
    rows = " UNION ALL ".join(
        f"SELECT model_name, '{c}' AS class, p{i} AS score, actual = '{c}' AS positive FROM scores"
        for i, c in enumerate(CLASSES)
    )
    return f"long_scores AS ({rows})"


def shap_long(card, source: str = "incidents", background: str = "bg") -> str:
    """CTE ``phi(incident_id, c, j, v)`` of linear contributions, and the margins at the mean."""
    means = ", ".join(f"avg({f}) AS mu_{f}" for f in card.features)
    rows = " UNION ALL ".join(
        f"SELECT incident_id, {c} AS c, {j} AS j, {number(w)} * ({f} - mu_{f}) AS v FROM {source}, mu"
        for c, row in enumerate(card.weights)
        for j, (w, f) in enumerate(zip(row, card.features))
    )
    base = " UNION ALL ".join(
        f"SELECT {c} AS c, " + " + ".join([number(b)] + [f"{number(w)} * mu_{f}" for w, f in zip(row, card.features)]) + " AS base FROM mu"
        for c, (b, row) in enumerate(zip(card.intercepts, card.weights))
    )
    return f"mu AS (SELECT {means} FROM {background}),\nphi AS ({rows}),\nbases AS ({base})"


FEATURE_VALUES = "features(j, feature) AS (VALUES " + ", ".join(f"({j}, '{f}')" for j, f in enumerate(V.SIGNALS)) + ")"


def rca_steps(k: int, top: int) -> str:
    long = " UNION ALL ".join(f"SELECT incident_id, {c} AS c, p{c} AS proba FROM s0" for c in range(len(CLASSES)))
    return f"""probas AS ({long}),
causes AS (SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY proba DESC, c) AS class_rank FROM probas),
signals AS (SELECT *, row_number() OVER (PARTITION BY incident_id, c ORDER BY abs(v) DESC, j) AS feature_rank FROM phi),
rca AS (SELECT incident_id, class_rank::INTEGER AS class_rank, class, proba, base, feature_rank::INTEGER AS feature_rank, feature, v AS shap_value
  FROM causes JOIN signals USING (incident_id, c) JOIN bases USING (c) JOIN classes USING (c) JOIN features USING (j)
  WHERE class_rank <= {k} AND feature_rank <= {top})"""


def shapley_steps(card, source: str = "ex", background: str = "bg") -> str:
    """CTEs that give ``phi(incident_id, c, j, v)`` by enumerating all subsets."""
    from math import factorial

    m = len(card.features)
    mixed = ", ".join(
        f"CASE WHEN (mask & {1 << j}) <> 0 THEN x.{f} ELSE b.{f} END AS {f}" for j, f in enumerate(card.features)
    )
    n = len(card.classes)
    means = ", ".join(f"avg(p{c}) AS v{c}" for c in range(n))
    weights = ", ".join(
        f"({s}, {number(factorial(s) * factorial(m - s - 1) / factorial(m) if s < m else 0.0)}, "
        f"{number(factorial(s - 1) * factorial(m - s) / factorial(m) if s > 0 else 0.0)})"
        for s in range(m + 1)
    )
    rows = " UNION ALL ".join(
        f"SELECT incident_id, {c} AS c, {j} AS j, sum(CASE WHEN (mask & {1 << j}) <> 0 THEN w_in ELSE -w_out END * v{c}) AS v "
        f"FROM subset_values JOIN subset_weights ON size = bit_count(mask) GROUP BY incident_id"
        for c in range(n)
        for j in range(m)
    )
    return f"""mixed AS (SELECT x.incident_id, mask, {mixed} FROM {source} x, range(0, {2**m}) AS masks(mask), {background} b),
{scored('ms', card, 'mixed', 'incident_id, mask')},
subset_values AS MATERIALIZED (SELECT incident_id, mask, {means} FROM ms GROUP BY incident_id, mask),
subset_weights(size, w_out, w_in) AS (VALUES {weights}),
phi AS ({rows})"""


def importance_steps() -> str:
    return """importance AS (SELECT feature, j, avg(abs(v)) AS importance FROM phi JOIN features USING (j) GROUP BY feature, j),
ranked AS (SELECT feature, importance, row_number() OVER (ORDER BY importance DESC, j)::INTEGER AS rank FROM importance)"""


def permutation_steps(card) -> str:
    repeats = V.PERMUTATION_REPEATS
    streams = {f"{f}~{r}": stream(f"permute|{f}|{r}") for f in card.features for r in range(repeats)}
    value = "CASE t.feature " + " ".join(f"WHEN '{f}' THEN x.{f}::DOUBLE" for f in card.features) + " END"
    swapped = ", ".join(
        f"CASE WHEN t.feature = '{f}' THEN d.value ELSE x.{f}::DOUBLE END AS {f}" for f in card.features
    )
    return f"""{draws('don', {'o': stream('donor')}, 'ex', 'incident_id')},
{draws('tak', streams, 'ex', 'incident_id')},
donor_places AS (SELECT id, row_number() OVER (ORDER BY o, id) AS place FROM don),
takers AS (SELECT id, split_part(s, '~', 1) AS feature, split_part(s, '~', 2)::INTEGER AS repeat,
  row_number() OVER (PARTITION BY s ORDER BY o, id) AS place FROM tak),
donors AS (SELECT t.feature, t.repeat, p.place, {value} AS value
  FROM (SELECT DISTINCT feature, repeat FROM takers) t, donor_places p JOIN ex x ON x.incident_id = p.id),
swapped AS (SELECT x.incident_id, x.{V.LABEL}, t.feature, t.repeat, {swapped}
  FROM takers t JOIN donors d USING (feature, repeat, place) JOIN ex x ON x.incident_id = t.id),
{scored('sw', card, 'swapped', f'feature, repeat, {V.LABEL}')},
{scored('un', card, 'ex', V.LABEL)},
baseline AS (SELECT count(*) FILTER (WHERE prediction = {V.LABEL})::DOUBLE / count(*)::DOUBLE AS accuracy FROM un),
trial AS (SELECT feature, repeat, count(*) FILTER (WHERE prediction = {V.LABEL}) AS hits, count(*) AS n FROM sw GROUP BY feature, repeat),
drops AS (SELECT feature, j, (SELECT accuracy FROM baseline) - sum(hits)::DOUBLE / sum(n)::DOUBLE AS importance,
  stddev_pop(hits::DOUBLE / n::DOUBLE) AS importance_std FROM trial JOIN features USING (feature) GROUP BY feature, j)"""


# The forest with given splits, (tree, node, signal, threshold, left, right).
FOREST_NODES = """(VALUES
  (0, 0, 'avg_cpu_usage', 35.0, 1, 2), (0, 1, 'request_rate', 500.0, 3, 4), (0, 2, 'mem_growth', 8.0, 5, 6),
  (0, 4, 'avg_cpu_usage', 15.0, 7, 8), (0, 5, 'error_rate', 0.5, 9, 10),
  (1, 0, 'upstream_error_rate', 0.0, 1, 2), (1, 1, 'timeout_log_count', 29.5, 3, 4),
  (1, 2, 'dependency_latency', 150.0, 5, 6), (1, 6, 'upstream_error_rate', 0.25, 7, 8),
  (2, 0, 'latency', 130.0, 1, 2), (2, 1, 'oom_log_count', 3.5, 3, 4), (2, 2, 'latency', 250.0, 5, 6),
  (2, 3, 'latency', 90.0, 7, 8), (2, 5, 'request_rate', 250.0, 9, 10)) AS t(tree, node, signal, threshold, l, r)"""


def forest_steps() -> str:
    """CTEs of the forest with given splits: ``cover`` of every node, ``leaf_share`` per class."""
    unpivot = " UNION ALL ".join(f"SELECT incident_id, {j} AS j, {s}::DOUBLE AS x FROM incidents" for j, s in enumerate(V.SIGNALS))
    names = ", ".join(f"({j}, '{s}')" for j, s in enumerate(V.SIGNALS))
    return f"""signals(j, signal) AS (VALUES {names}),
xs AS ({unpivot}),
splits AS (SELECT tree, node, j, signal, threshold::DOUBLE AS threshold, l, r FROM {FOREST_NODES} JOIN signals USING (signal)),
reach(incident_id, tree, node) AS (
  WITH RECURSIVE g(incident_id, tree, node) AS (
    SELECT incident_id, tree, 0 FROM incidents, (SELECT DISTINCT tree FROM splits)
    UNION ALL
    SELECT g.incident_id, g.tree, CASE WHEN x <= threshold THEN l ELSE r END
    FROM g JOIN splits s ON g.tree = s.tree AND g.node = s.node JOIN xs ON xs.incident_id = g.incident_id AND xs.j = s.j)
  SELECT * FROM g),
cover AS (SELECT tree, node, count(*)::DOUBLE AS n FROM reach GROUP BY tree, node),
class_names AS (SELECT DISTINCT {V.LABEL} AS class FROM incidents),
leaf_count AS (SELECT tree, node, {V.LABEL} AS class, count(*)::DOUBLE AS n FROM reach JOIN incidents USING (incident_id) GROUP BY ALL),
leaf_share AS (
  SELECT c.tree, c.node, k.class, coalesce(m.n, 0.0) / c.n AS share
  FROM cover c CROSS JOIN class_names k LEFT JOIN leaf_count m ON m.tree = c.tree AND m.node = c.node AND m.class = k.class
  WHERE NOT EXISTS (SELECT 1 FROM splits s WHERE s.tree = c.tree AND s.node = c.node))"""


def tree_shap_steps() -> str:
    """CTE ``phi``: the score expected for every subset of a tree's signals, following the cover."""
    return f"""{forest_steps()},
used AS (SELECT tree, bit_or(1 << j) AS bits, count(DISTINCT j) AS m FROM splits GROUP BY tree),
masks AS (SELECT tree, mask::INTEGER AS mask FROM used, range({2 ** len(V.SIGNALS)}) t(mask) WHERE mask & ~bits = 0),
walked AS (
  WITH RECURSIVE w(incident_id, tree, mask, node, part) AS (
    SELECT incident_id, tree, mask, 0, 1.0::DOUBLE FROM incidents, masks
    UNION ALL
    SELECT w.incident_id, w.tree, w.mask, c.node, CASE WHEN w.mask & (1 << s.j) <> 0 THEN w.part ELSE w.part * c.n / p.n END
    FROM w JOIN splits s ON w.tree = s.tree AND w.node = s.node
    JOIN xs ON xs.incident_id = w.incident_id AND xs.j = s.j
    JOIN cover c ON c.tree = w.tree AND c.node IN (s.l, s.r) JOIN cover p ON p.tree = w.tree AND p.node = w.node
    WHERE w.mask & (1 << s.j) = 0 OR c.node = CASE WHEN x <= threshold THEN s.l ELSE s.r END)
  SELECT * FROM w),
worth AS (
  SELECT incident_id, tree, mask, class, sum(part * share) / (SELECT count(*) FROM used) AS v
  FROM walked JOIN leaf_share USING (tree, node) GROUP BY ALL),
phi AS (
  SELECT a.incident_id, a.class, s.j,
    sum((b.v - a.v) * factorial(bit_count(a.mask)) * factorial((u.m - bit_count(a.mask) - 1)::INTEGER) / factorial(u.m::INTEGER)) AS v
  FROM worth a JOIN used u USING (tree) JOIN signals s ON u.bits & (1 << s.j) <> 0 AND a.mask & (1 << s.j) = 0
  JOIN worth b ON b.incident_id = a.incident_id AND b.tree = a.tree AND b.class = a.class AND b.mask = a.mask | (1 << s.j)
  GROUP BY ALL)"""


def oracle_sql() -> dict[str, str]:
    inc, sim, label = OBSERVED, SIMULATED, V.LABEL
    card = CARDS[0]
    sp = splits()
    evaluated = f"{inc},\n{sp},\nheld AS (SELECT i.* FROM incidents i JOIN split USING (incident_id) WHERE part = 2)"
    validated = f"{inc},\n{sp},\nheld AS (SELECT i.* FROM incidents i JOIN split USING (incident_id) WHERE part = 1)"
    whole_scores = f"{inc},\n{all_scored()}"
    eval_scores = f"{evaluated},\n{all_scored('held')}"
    val_scores = f"{validated},\n{all_scored('held')}"
    paths = "CASE model_name " + " ".join(f"WHEN '{c.name}' THEN '{c.name.replace(' ', '_')}_pipeline'" for c in CARDS) + " END"
    names = list(V.BASELINES)
    rounded = ", ".join(r6(n) for n in names)
    proba = ", ".join(r6(f"p{i}", f"proba_{c}") for i, c in enumerate(CLASSES))
    rca = f"{inc},\n{sample('bg', 'background', V.BACKGROUND_ROWS)},\n{shap_long(card)},\n{CLASS_VALUES},\n{FEATURE_VALUES},\n{scored('s0', card, 'incidents', 'incident_id')}"
    exact = f"{inc},\n{sample('bg', 'background', V.KERNEL_BACKGROUND_ROWS)},\n{sample('ex', 'explain', V.EXPLAIN_ROWS)}"
    profile = ", ".join(
        [f"{r6(f'avg({s})', f'avg_{s}')}, {r6(f'stddev_samp({s})', f'std_{s}')}" for s in V.PROFILE_SIGNALS]
        + [r6(f"corr({a}, {b})", f"corr_{a}__{b}") for a, b in combinations(V.PROFILE_SIGNALS, 2)]
    )
    scaled = ", ".join(
        r6(f"({s} - (SELECT avg({s}) FROM fit)) / (SELECT stddev_pop({s}) FROM fit)", s) for s in V.SIGNALS
    )
    bins = V.HISTOGRAM_BINS
    order = draws("d", {"label": stream("label")}, "events", "event_id")
    report_columns = f"model_name, class, {r6('precision')}, {r6('recall')}, {r6('f1')}"
    picks = " UNION ALL ".join(
        f"SELECT {label} AS root_cause, '{n}' AS metric, k_{n} AS k FROM shifted WHERE k_{n} IS NOT NULL" for n in names
    )
    return {
        "read_table": "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_users, round(sum(value), 3) + 0.0 AS total_value FROM events GROUP BY event_type",
        "csv_roundtrip": f"{inc} SELECT {label}, count(*) AS n, {', '.join(r6(f'avg({s})', f'avg_{s}') for s in V.SIGNALS)} FROM incidents GROUP BY {label}",
        "mixture_table": f"{sim}, drawn AS (SELECT root_cause, metric, k, count(*) AS n_drawn FROM ({picks}) GROUP BY ALL) "
        f"SELECT m.root_cause, m.metric, m.k, m.p, m.mean, m.std, {r6('m.lo', 'lo')}, {r6('m.hi', 'hi')}, coalesce(n_drawn, 0) AS n_drawn "
        "FROM mixture m LEFT JOIN drawn USING (root_cause, metric, k)",
        "mixture_check": f"{sim} SELECT m.root_cause, m.metric, {r6('sum(p)', 'total')}, abs(sum(p) - 1.0) <= 1e-8 + 1e-5 AS valid, "
        f"(SELECT count(*) FROM shifted WHERE {label} = m.root_cause) AS n_rows FROM mixture m GROUP BY m.root_cause, m.metric",
        "feature_projection": f"{inc} SELECT incident_id, {ROUNDED_SIGNALS} FROM incidents",
        "head": f"{inc} SELECT incident_id, {ROUNDED_SIGNALS}, {label} FROM incidents ORDER BY incident_id LIMIT 5",
        "row_lookup": f"{inc} SELECT incident_id, {ROUNDED_SIGNALS}, {label} FROM incidents WHERE incident_id IN (SELECT doc_id FROM labels WHERE toxic = 1)",
        "hash_uniform": f"WITH {order} SELECT id AS incident_id, {r6('u', 'u', 12)} FROM d",
        "hash_normal": f"WITH {draws('d', {'n': stream('base:latency')}, 'events', 'event_id')} SELECT id AS incident_id, {r6('z', 'z', 9)} FROM d",
        "hash_poisson": f"WITH {draws('d', {'p': stream('poisson')}, 'events', 'event_id')}, "
        f"rates AS (SELECT event_id AS incident_id, u, 0.5::DOUBLE + abs(value) / 20.0::DOUBLE AS rate FROM events JOIN d ON id = event_id), "
        f"{poisson('pn', 'u', 'rate', 'rates')} SELECT incident_id, {r6('rate')}, n FROM rates JOIN pn USING (incident_id)",
        "weighted_label": f"WITH {order} SELECT id AS incident_id, {label_case('u')} AS {label} FROM d",
        "mixture_shift": f"{sim} SELECT incident_id, {label}, {rounded} FROM shifted",
        "coupled_metrics": f"{sim} SELECT incident_id, {label}, {rounded} FROM coupled",
        "stress_score": f"{sim} SELECT incident_id, {r6('stress', 'stress_score')}, {r6('error_rate')} FROM raised",
        "incidents": f"{sim} SELECT incident_id, {ROUNDED_SIGNALS}, {label} FROM incidents",
        "incident_profile": f"{inc} SELECT {label}, count(*) AS n, {r6('count(*) / (SELECT count(*) FROM incidents)', 'share')}, "
        f"{', '.join(r6(f'avg({s})', f'avg_{s}') for s in V.SIGNALS)} FROM incidents GROUP BY {label}",
        "stratified_split": f"{inc},\n{sp} SELECT incident_id, {label}, {SPLIT_NAME} AS split FROM split",
        "stratified_holdout": f"{inc},\n{parts('holdout', [1 - Fraction(V.HOLDOUT_SHARE), Fraction(V.HOLDOUT_SHARE)])} "
        f"SELECT incident_id, {label}, CASE part WHEN 0 THEN 'train' ELSE 'test' END AS split FROM holdout",
        "stratified_folds": f"{inc},\n{parts('fold', [Fraction(1, V.FOLDS)] * V.FOLDS)} SELECT incident_id, {label}, part AS fold FROM fold",
        "sample_n": f"{inc},\n{sample('ex', 'sample', 200)} SELECT incident_id, {ROUNDED_SIGNALS}, {label} FROM ex",
        "class_distribution": f"{inc},\n{sp}, named AS (SELECT {label}, {SPLIT_NAME} AS split FROM split UNION ALL SELECT {label}, 'raw' FROM split), "
        f"counted AS (SELECT split, {label}, count(*) AS n FROM named GROUP BY ALL) "
        f"SELECT split, {label}, n, {r6('n / sum(n) OVER (PARTITION BY split)', 'share')} FROM counted",
        "split_counts": f"{inc},\n{sp} SELECT {SPLIT_NAME} AS split, count(*) AS n FROM split GROUP BY part",
        "split_roundtrip": f"{inc},\n{sp} SELECT {SPLIT_NAME} AS split, {label}, count(*) AS n, {r6('avg(latency)', 'avg_latency')} "
        f"FROM incidents JOIN split USING (incident_id, {label}) GROUP BY part, {label}",
        "standard_scale": f"{inc},\n{sp}, fit AS (SELECT i.* FROM incidents i JOIN split USING (incident_id) WHERE part = 0) "
        f"SELECT incident_id, {scaled} FROM incidents",
        "label_index": f"{inc} SELECT incident_id, {label}, (SELECT count(DISTINCT o.{label}) FROM incidents o WHERE o.{label} < i.{label})::DOUBLE AS label_index FROM incidents i",
        "scorecard_predict": f"{inc},\n{scored('s0', card, 'incidents', 'incident_id')} SELECT incident_id, prediction, {proba} FROM s0",
        "confusion_matrix": f"{whole_scores},\n{report_steps()} SELECT model_name, actual, predicted, n FROM confusion",
        "confusion_wide": f"{whole_scores} SELECT model_name, actual, "
        + ", ".join(f"count(*) FILTER (WHERE prediction = '{c}') AS {c}" for c in CLASSES)
        + " FROM scores GROUP BY model_name, actual",
        "classification_report": f"{whole_scores},\n{report_steps()} SELECT {report_columns}, support::BIGINT AS support FROM report",
        "leaderboard": f"{val_scores},\n{report_steps()} SELECT model_name, {paths} AS model_path, {r6('accuracy', 'val_accuracy')}, {r6('macro_f1', 'val_f1_macro')} FROM model_avg",
        "eval_summary": f"{eval_scores},\n{report_steps()},\n{class_scores_long()},\n{auc_steps('long_scores', 'model_name, class')}, "
        f"macro AS (SELECT model_name, avg(roc_auc) AS roc_auc FROM auc GROUP BY model_name) "
        f"SELECT model_name, {paths} AS model_path, {r6('accuracy')}, {r6('roc_auc')}, NULL::VARCHAR AS roc_auc_error FROM model_avg JOIN macro USING (model_name)",
        "model_comparison": f"{whole_scores},\n{report_steps()} SELECT model_name, {', '.join(r6(c) for c in ('accuracy', 'macro_precision', 'macro_recall', 'macro_f1'))} FROM model_avg",
        "metrics_unpivot": f"{whole_scores},\n{report_steps()} "
        + " UNION ALL ".join(
            f"SELECT model_name, '{c}' AS variable, {r6(c, 'value')} FROM model_avg"
            for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1")
        ),
        "roc_auc_binary": "WITH pairs AS (SELECT l.quality, d.n_chars AS score, l.toxic = 1 AS positive FROM labels l JOIN documents d USING (doc_id)), "
        f"{auc_steps('pairs', 'quality')} SELECT quality, n_pos, n_neg, {r6('roc_auc')}, NULL::VARCHAR AS roc_auc_error FROM auc",
        "roc_auc_ovr": f"{whole_scores},\n{class_scores_long()},\n{auc_steps('long_scores', 'model_name, class')} "
        f"SELECT model_name, class, n_pos, n_neg, {r6('roc_auc')}, NULL::VARCHAR AS roc_auc_error FROM auc",
        "evaluate_one": f"{inc},\n{scored('s0', card, 'incidents', f'''{chr(39)}{card.name}{chr(39)} AS model_name, incident_id, {label} AS actual''')},\n"
        f"scores AS (SELECT * FROM s0),\n{report_steps()},\n{class_scores_long()},\n{auc_steps('long_scores', 'model_name, class')} "
        + " UNION ALL ".join(
            f"SELECT model_name, 'report' AS part, class, '{c}' AS metric, {r6(f'{c}::DOUBLE', 'value')} FROM report"
            for c in ("precision", "recall", "f1", "support")
        )
        + " UNION ALL SELECT model_name, 'confusion', actual, predicted, n::DOUBLE FROM confusion"
        + f" UNION ALL SELECT model_name, 'auc', 'all', 'roc_auc_ovr_macro', {r6('avg(roc_auc)', 'value')} FROM auc GROUP BY model_name",
        "histogram": f"{inc}, ranges AS (SELECT {label}, min(latency) AS lo, (max(latency) - min(latency)) / {number(bins)} AS w FROM incidents GROUP BY {label}), "
        f"binned AS (SELECT {label}, least(coalesce(floor((latency - lo) / nullif(w, 0.0)), 0), {bins - 1})::INTEGER AS bin, lo, w FROM incidents JOIN ranges USING ({label})) "
        f"SELECT {label}, bin, {r6('lo + bin * w', 'bin_start')}, {r6('lo + (bin + 1) * w', 'bin_end')}, count(*) AS n FROM binned GROUP BY {label}, bin, lo, w",
        "density_curve": f"{inc}, stats AS (SELECT {label}, min(latency) AS lo, max(latency) AS hi, count(*)::DOUBLE AS n, stddev_samp(latency) * pow(count(*)::DOUBLE, -0.2) AS h FROM incidents GROUP BY {label}), "
        f"cells AS (SELECT {label}, least(floor((latency - lo) / ((hi - lo) / 512.0::DOUBLE)), 511) AS cell, count(*) AS k FROM incidents JOIN stats USING ({label}) WHERE hi > lo GROUP BY ALL), "
        f"curve AS (SELECT {label}, g::INTEGER AS point, lo + g * (hi - lo) / 199.0::DOUBLE AS x, n, lo, hi, "
        "sum(k * exp(-0.5::DOUBLE * pow((lo + g * (hi - lo) / 199.0::DOUBLE - (lo + (cell + 0.5) * ((hi - lo) / 512.0::DOUBLE))) / h, 2))) / (n * h * sqrt(2 * pi())) AS density "
        f"FROM cells JOIN stats USING ({label}), range(200) t(g) GROUP BY {label}, g, lo, hi, n, h) "
        f"SELECT {label}, point, {r6('x')}, {r6('density', digits=9)}, {r6('density * n * (hi - lo) / 30', 'height')} FROM curve",
        "pair_table": f"{inc}, ends AS (SELECT {', '.join(f'min({s_}) AS lo_{s_}, max({s_}) AS hi_{s_}' for s_ in V.PROFILE_SIGNALS)} FROM incidents), "
        f"placed AS (SELECT {label}, {', '.join(f'least(floor(({s_} - lo_{s_}) / ((hi_{s_} - lo_{s_}) / 20)), 19)::INTEGER AS {s_}' for s_ in V.PROFILE_SIGNALS)} FROM incidents, ends) "
        + " UNION ALL ".join(
            f"SELECT {label}, '{a}' AS signal_x, '{b}' AS signal_y, {a} AS bin_x, {b} AS bin_y, count(*) AS n FROM placed GROUP BY ALL"
            for a, b in combinations(V.PROFILE_SIGNALS, 2)
        ),
        "signal_profile": f"{inc} SELECT {label}, count(*) AS n, {profile} FROM incidents GROUP BY {label}",
        "linear_shap": f"{rca} SELECT incident_id, class, feature, {r6('v', 'shap_value')} FROM phi JOIN classes USING (c) JOIN features USING (j)",
        "local_explanation": f"{rca},\n{rca_steps(1, V.TOP_FEATURES)} SELECT incident_id, class, {r6('proba')}, {r6('base')}, feature_rank, feature, {r6('shap_value')} FROM rca",
        "topk_rca": f"{rca},\n{rca_steps(V.RCA_CAUSES, V.RCA_FEATURES)} SELECT incident_id, class_rank, class, {r6('proba')}, {r6('base')}, feature_rank, feature, {r6('shap_value')} FROM rca",
        "permutation_importance": f"{inc},\n{FEATURE_VALUES},\n{sample('ex', 'explain', V.EXPLAIN_ROWS)},\n{permutation_steps(card)} "
        f"SELECT feature, {r6('importance')}, {r6('importance_std')}, row_number() OVER (ORDER BY importance DESC, j)::INTEGER AS rank FROM drops",
        "permutation_whole": f"{inc},\n{FEATURE_VALUES},\nex AS (SELECT * FROM incidents),\n{permutation_steps(card)} "
        f"SELECT feature, {r6('importance')}, {r6('importance_std')}, row_number() OVER (ORDER BY importance DESC, j)::INTEGER AS rank FROM drops",
        "model_roundtrip": f"{inc},\n{sp} SELECT count(*) AS n, count(*) AS n_same FROM split WHERE part = 2",
        "tree_nodes": f"{inc}, {forest_steps()} SELECT c.tree, c.node, s.signal AS feature, s.threshold, coalesce(s.l, -1) AS \"left\", coalesce(s.r, -1) AS \"right\", c.n AS cover, "
        + ", ".join(r6(f"max(f.share) FILTER (f.class = '{c}') / 3", f"value_{c}") for c in sorted(V.SCORECARD))
        + " FROM cover c LEFT JOIN splits s USING (tree, node) LEFT JOIN leaf_share f USING (tree, node) GROUP BY ALL",
        "tree_shap": f"{inc}, {tree_shap_steps()} SELECT i.incident_id, k.class, g.signal AS feature, {r6('coalesce(p.v, 0.0)', 'shap_value', 8)} "
        "FROM incidents i CROSS JOIN class_names k CROSS JOIN signals g LEFT JOIN phi p ON p.incident_id = i.incident_id AND p.class = k.class AND p.j = g.j",
        "tree_importance_paths": f"{inc}, {tree_shap_steps()}, means AS (SELECT j, sum(abs(v)) AS total FROM phi GROUP BY j), "
        f"ranked AS (SELECT signal, j, coalesce(total, 0.0) / (SELECT count(*) FROM incidents) / {len(V.SCORECARD)} AS importance FROM signals LEFT JOIN means USING (j)) "
        f"SELECT 'Fixed forest' AS model_name, 'shap_tree' AS method, signal AS feature, {r6('importance')}, row_number() OVER (ORDER BY importance DESC, j)::INTEGER AS rank FROM ranked",
        "exact_shapley": f"{exact},\n{shapley_steps(card)},\n{CLASS_VALUES},\n{FEATURE_VALUES} "
        f"SELECT incident_id, class, feature, {r6('v', 'shap_value')} FROM phi JOIN classes USING (c) JOIN features USING (j)",
        "global_importance": f"{rca},\n{importance_steps()} SELECT '{card.name}' AS model_name, 'shap_linear' AS method, feature, {r6('importance')}, rank FROM ranked",
    }
