"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_all_queries_match_oracle():
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        import pytest
        pytest.skip("test tables not present")
    env = dict(os.environ, PAGELAKE_MASTER="local[4]")
    res = subprocess.run([sys.executable, os.path.join(ROOT, "tools", "oracle_check.py"), sf],
                         capture_output=True, text=True, env=env, timeout=3000)
    lines = [ln for ln in res.stdout.splitlines() if ln.startswith(("OK", "FAIL", "ROWS"))]
    fails = [ln for ln in lines if ln.startswith("FAIL")]
    assert lines, res.stderr[-2000:]
    assert not fails, "\n".join(fails)
