"""The command line runs a load and a refresh against a warehouse folder."""

import json
import os
import subprocess
import sys

from tenderlake.plans import landing
from tests.conftest import ROOT, SF_SMALL


def test_cli_codes_load_and_refresh(spark, tmp_dir):
    codes = landing.land_codes(spark, SF_SMALL, f"{tmp_dir}/codes")
    env = dict(os.environ, PYTHONPATH=ROOT)
    base = [sys.executable, "-m", "tenderlake", "--master", "local[2]", "--warehouse", f"{tmp_dir}/wh"]
    out = subprocess.run(base + ["load-codes", codes], capture_output=True, text=True, env=env, timeout=300)
    line = [x for x in out.stdout.splitlines() if x.startswith("{")][-1]
    step = json.loads(line)
    assert step["step"] == "load_codes" and step["checks"][0]["passed"]
    out = subprocess.run(base + ["refresh-codes"], capture_output=True, text=True, env=env, timeout=300)
    assert '"refresh_codes"' in out.stdout
