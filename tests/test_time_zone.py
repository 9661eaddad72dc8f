"""Zone-free times must not shift when the Python process lives in another zone than the session."""

import os
import subprocess
import sys

SCRIPT = """
import datetime as dt
from pyspark.sql import functions as F
from rhythmica.session import local_session
from rhythmica.operators import backtest, split
spark = local_session(2, 2)
df = spark.sql("select id, to_timestamp_ntz('2024-01-01 00:00:00') + make_dt_interval(0, id) as ts, 'a' as s, double(id) as y from range(100)")
got = {r['split']: r['count'] for r in split.temporal_split(df, ['ts', 'id']).groupBy('split').count().collect()}
assert got == {'train': 70, 'val': 15, 'test': 15}, got
fold = backtest.Fold(0, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2, 5))
rows = backtest.backtest(df, ['s'], ['ts'], 'ts', 'y', [fold]).orderBy('ts').collect()
assert [r['y_true'] for r in rows] == [24.0, 25.0, 26.0, 27.0, 28.0] and rows[0]['naive'] == 23.0, rows
print('fine')
"""


def test_other_process_zone():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, TZ="America/New_York", PYTHONPATH=root)
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=180, check=False)
    assert "fine" in out.stdout, out.stderr[-2000:]
