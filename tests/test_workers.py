"""Functions that run in Python workers reach them without the package on their path."""

import subprocess
import sys
from pathlib import Path

REPO = str(Path(__file__).resolve().parent.parent)
SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from phasewright.operators.pedestrian import low_press_probability
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
rows = spark.createDataFrame([("a", d, p) for d, p in enumerate([1.0, 2.0, 3.0, 4.0])], "k string, d int, papd double")
print("P0", low_press_probability(rows, ["k"]).first()["p0"])
"""


def test_worker_functions_travel_by_value(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, capture_output=True, text=True, timeout=170)
    assert out.returncode == 0, out.stderr[-2000:]
    assert 0 < float(out.stdout.split("P0")[1].split()[0]) < 0.2


def test_gamma_function_against_known_values():
    import math

    import numpy as np

    from phasewright.operators.pedestrian import regularized_gamma

    x = np.array([0.0, 1e-6, 0.3, 1.0, 5.0, 40.0, 300.0])
    assert np.allclose(regularized_gamma(np.ones(7), x), 1 - np.exp(-x), atol=1e-14)
    assert np.allclose(regularized_gamma(np.full(7, 0.5), x), [math.erf(math.sqrt(v)) for v in x], atol=1e-14)
    large = regularized_gamma(np.array([1e4, 1e6, np.nan, -1.0]), np.array([1e4, 1e6, 1.0, 1.0]))
    assert 0.5 < large[0] < 0.51 and 0.5 < large[1] < 0.501 and np.isnan(large[2:]).all()
