"""Fixed values of the incident model and of the training and explaining defaults."""

# ---------------------------------------------------------------------------
# These must equal the published incident model for right results.
# ---------------------------------------------------------------------------

# Share of each root cause, in drawing order.
ROOT_CAUSE_PRIOR = {
    "bad_deployment": 0.2,
    "external_dependency_failure": 0.2,
    "traffic_spike": 0.15,
    "memory_leak": 0.15,
    "cpu_saturation": 0.15,
    "normal": 0.15,
}

# Healthy level of each signal: (mean, standard deviation).
BASELINES = {
    "request_rate": (300.0, 50.0),
    "mem_growth": (0.2, 0.1),
    "error_rate": (0.5, 0.2),
    "upstream_error": (0.3, 0.2),
    "dependency_latency": (150.0, 40.0),
    "latency": (200.0, 50.0),
    "avg_cpu": (40.0, 10.0),
}

# Shift of each signal under each root cause: root cause -> signal -> list of
# [probability, [mean, standard deviation]].
MIXTURE = {
    "traffic_spike": {
        "request_rate": [[0.4, [400, 100]], [0.2, [300, 100]], [0.3, [200, 100]], [0.1, [100, 50]]],
        "avg_cpu": [[0.2, [30, 15]], [0.3, [20, 10]], [0.5, [10, 5]]],
        "latency": [[0.4, [150, 100]], [0.4, [100, 50]], [0.2, [50, 20]]],
        "mem_growth": [[0.2, [1.2, 0.5]], [0.2, [1.0, 0.5]], [0.4, [0.8, 0.4]], [0.2, [0.5, 0.2]]],
        "dependency_latency": [[0.1, [300, 100]], [0.2, [200, 100]], [0.3, [100, 50]], [0.4, [50, 20]]],
        "error_rate": [[0.1, [2.0, 1.0]], [0.1, [1.5, 0.5]], [0.3, [0.8, 0.4]], [0.5, [0.5, 0.2]]],
        "upstream_error": [[0.1, [2.0, 1.0]], [0.2, [1.5, 0.5]], [0.3, [1.0, 0.5]], [0.4, [0.5, 0.2]]],
    },
    "memory_leak": {
        "mem_growth": [[0.4, [1.5, 0.5]], [0.4, [1.2, 0.5]], [0.1, [1.0, 0.5]], [0.1, [0.8, 0.5]]],
        "latency": [[0.2, [150, 100]], [0.3, [120, 60]], [0.3, [80, 40]], [0.2, [50, 20]]],
        "dependency_latency": [[0.1, [300, 100]], [0.1, [200, 100]], [0.3, [100, 50]], [0.5, [50, 20]]],
        "request_rate": [[0.1, [300, 100]], [0.1, [200, 100]], [0.1, [100, 50]], [0.4, [-50, 20]], [0.3, [-20, 5]]],
        "avg_cpu": [[0.2, [30, 15]], [0.3, [20, 10]], [0.5, [10, 5]]],
        "error_rate": [[0.1, [1.0, 0.3]], [0.3, [0.8, 0.4]], [0.6, [0.5, 0.2]]],
        "upstream_error": [[0.1, [2.0, 1.0]], [0.1, [1.5, 0.5]], [0.1, [1.0, 0.5]], [0.7, [0.5, 0.2]]],
    },
    "cpu_saturation": {
        "avg_cpu": [[0.4, [35, 20]], [0.4, [25, 10]], [0.2, [15, 5]]],
        "error_rate": [[0.4, [1.5, 1.0]], [0.4, [1.0, 0.5]], [0.2, [0.5, 0.2]]],
        "latency": [[0.2, [150, 100]], [0.2, [120, 60]], [0.6, [100, 50]]],
        "dependency_latency": [[0.1, [300, 100]], [0.3, [200, 100]], [0.6, [100, 50]]],
        "request_rate": [[0.1, [100, 50]], [0.5, [-50, 20]], [0.4, [-20, 5]]],
        "mem_growth": [[0.3, [1.2, 0.5]], [0.3, [1.0, 0.5]], [0.2, [0.8, 0.4]], [0.2, [0.5, 0.2]]],
        "upstream_error": [[0.1, [2.0, 1.0]], [0.1, [1.5, 0.5]], [0.2, [1.0, 0.5]], [0.6, [0.5, 0.2]]],
    },
    "bad_deployment": {
        "error_rate": [[0.3, [3.0, 1.5]], [0.4, [2.0, 1.0]], [0.3, [1.5, 1.0]]],
        "latency": [[0.2, [120, 60]], [0.3, [100, 50]], [0.5, [80, 40]]],
        "dependency_latency": [[0.1, [300, 100]], [0.1, [200, 100]], [0.4, [100, 50]], [0.4, [50, 20]]],
        "avg_cpu": [[0.1, [30, 15]], [0.2, [20, 10]], [0.7, [10, 5]]],
        "request_rate": [[0.1, [300, 150]], [0.1, [100, 50]], [0.4, [-50, 20]], [0.4, [-20, 5]]],
        "mem_growth": [[0.1, [1.0, 0.5]], [0.1, [0.8, 0.4]], [0.8, [0.5, 0.2]]],
        "upstream_error": [[0.05, [2.0, 1.0]], [0.05, [1.5, 0.5]], [0.2, [1.0, 0.5]], [0.7, [0.5, 0.2]]],
    },
    "external_dependency_failure": {
        "dependency_latency": [[0.4, [300, 50]], [0.3, [200, 50]], [0.3, [100, 50]]],
        "upstream_error": [[0.3, [3.0, 1.5]], [0.4, [2.0, 1.0]], [0.3, [1.0, 0.5]]],
        "avg_cpu": [[0.1, [30, 15]], [0.2, [20, 10]], [0.7, [10, 5]]],
        "request_rate": [[0.1, [300, 150]], [0.1, [100, 50]], [0.5, [-50, 20]], [0.3, [-20, 5]]],
        "mem_growth": [[0.05, [1.0, 0.5]], [0.05, [0.8, 0.4]], [0.9, [0.5, 0.2]]],
        "latency": [[0.1, [150, 100]], [0.3, [100, 50]], [0.6, [80, 40]]],
        "error_rate": [[0.1, [3.0, 2.0]], [0.2, [2.0, 1.0]], [0.7, [1.0, 0.5]]],
    },
    "normal": {},
}

# How signals pull on each other, and the noise that comes with it: (mean, std).
CPU_PER_REQUEST = 0.05
CPU_NOISE = (5.0, 3.0)
MEMORY_PER_CPU = 0.005
DEPENDENCY_PER_EXCESS_REQUEST = 0.1
NORMAL_REQUEST_RATE = 300.0
LATENCY_WEIGHTS = {"avg_cpu": 0.5, "dependency_latency": 0.3, "mem_growth": 10.0}
LATENCY_NOISE = (50.0, 15.0)
LATENCY_FLOOR = 50.0

# Stress score: the logistic of it is added to the error rate.
STRESS_BIAS = -4.0
STRESS_WEIGHTS = {
    "avg_cpu": 0.02,
    "mem_growth": 1.0,
    "dependency_latency": 0.0015,
    "upstream_error": 0.05,
    "request_rate": 0.002,
    "latency": 0.01,
    "error_rate": 2.0,
}

# Mean log counts: out-of-memory = max(2 * memory growth, 0.5),
# timeouts = max(dependency latency / 100, 1).
OOM_PER_MEMORY = 2.0
OOM_FLOOR = 0.5
DEPENDENCY_LATENCY_PER_TIMEOUT = 100.0
TIMEOUT_FLOOR = 1.0

# Published signal columns, in order, and the label.
SIGNALS = [
    "avg_cpu_usage",
    "mem_growth",
    "oom_log_count",
    "request_rate",
    "error_rate",
    "latency",
    "upstream_error_rate",
    "dependency_latency",
    "timeout_log_count",
]
LABEL = "root_cause_label"

# Signals shown in the pair table.
PROFILE_SIGNALS = [
    "latency",
    "request_rate",
    "avg_cpu_usage",
    "mem_growth",
    "error_rate",
    "upstream_error_rate",
    "dependency_latency",
]

# Defaults of building, training and explaining.
SEED = 42
TRAIN_SHARE = "0.70"
VAL_SHARE = "0.15"
HOLDOUT_SHARE = "0.2"
FOLDS = 5
BACKGROUND_ROWS = 100
EXPLAIN_ROWS = 200
KERNEL_BACKGROUND_ROWS = 40
KERNEL_SAMPLES = 80
PERMUTATION_REPEATS = 10
TOP_FEATURES = 20
LOCAL_BACKGROUND_ROWS = 30
LOCAL_EXAMPLES = 3
RCA_CAUSES = 3
RCA_FEATURES = 8
HISTOGRAM_BINS = 30
DENSITY_POINTS = 200
DENSITY_CELLS = 512
PAIR_BINS = 20

# Parameter grids per model family; None means no depth limit.
GRIDS = {
    "Logistic Regression": {"C": [0.01, 0.1, 1, 10]},
    "Random Forest": {"n_estimators": [100, 200], "max_depth": [None, 10, 20]},
    "Gradient Boosting": {"n_estimators": [100, 200], "learning_rate": [0.05, 0.1]},
    "SVM (RBF)": {"C": [0.1, 1, 10], "gamma": ["scale", "auto"]},
}

# The other published grids, which differ for boosting and the support vector machine.
ALTERNATIVE_GRIDS = {
    "Logistic Regression": {"C": [0.01, 0.1, 1, 10]},
    "Random Forest": {"n_estimators": [100, 200], "max_depth": [None, 10, 20]},
    "Gradient Boosting": {"n_estimators": [100, 200], "max_depth": [3, 5]},
    "SVM": {"C": [0.1, 1, 10], "kernel": ["linear", "rbf"]},
}

# ---------------------------------------------------------------------------
# A fixed scorecard (ours): a linear model with constant weights, so that scoring, metrics
# and explanations can be checked exactly without fitting. Class -> (intercept, weight of
# each signal in the order of SIGNALS).
# ---------------------------------------------------------------------------
SCORECARD = {
    "bad_deployment": (-0.824, [0.0039, -0.703, 0.0218, -0.0033, 1.4292, 0.0012, -0.2256, -0.0008, -0.0098]),
    "cpu_saturation": (-4.973, [0.0544, 1.3443, -0.0003, -0.0081, 0.1178, 0.0047, -0.1324, 0.0017, 0.0318]),
    "external_dependency_failure": (-3.117, [-0.0056, -0.9766, 0.0028, -0.0035, 0.4595, 0.0014, 1.7321, 0.0095, 0.0024]),
    "memory_leak": (-1.911, [-0.0036, 3.4066, 0.0155, -0.0015, -0.4571, 0.0019, -0.1883, -0.0016, -0.0321]),
    "normal": (19.373, [-0.0534, -4.0229, -0.02, 0.0003, -1.3516, -0.0129, -1.3398, -0.0079, 0.0325]),
    "traffic_spike": (-8.547, [0.0043, 0.9514, -0.0199, 0.016, -0.1979, 0.0037, 0.154, -0.0009, -0.0247]),
}

# A fixed forest (ours): given splits, so that tree explanations can be checked exactly. Node ->
# (signal, threshold, left node, right node); a node without an entry is a leaf.
FOREST = [
    {
        0: ("avg_cpu_usage", 35.0, 1, 2),
        1: ("request_rate", 500.0, 3, 4),
        2: ("mem_growth", 8.0, 5, 6),
        4: ("avg_cpu_usage", 15.0, 7, 8),
        5: ("error_rate", 0.5, 9, 10),
    },
    {
        0: ("upstream_error_rate", 0.0, 1, 2),
        1: ("timeout_log_count", 29.5, 3, 4),
        2: ("dependency_latency", 150.0, 5, 6),
        6: ("upstream_error_rate", 0.25, 7, 8),
    },
    {
        0: ("latency", 130.0, 1, 2),
        1: ("oom_log_count", 3.5, 3, 4),
        2: ("latency", 250.0, 5, 6),
        3: ("latency", 90.0, 7, 8),
        5: ("request_rate", 250.0, 9, 10),
    },
]
