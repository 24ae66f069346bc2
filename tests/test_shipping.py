"""What runs in Python on executors travels with its task: it loads where the package is not installed."""

import subprocess
import sys

import pytest
from pyspark import cloudpickle

from beaconry.functions import scrub
from beaconry.operators import spans
from beaconry.streaming import stateful


@pytest.mark.parametrize("what", [spans._replay, scrub._scrub_tree, stateful._Crumbs(3, 1), stateful._Sessions(1), stateful._fold_frames])
def test_loads_without_the_package(what, tmp_path):
    done = subprocess.run(
        [sys.executable, "-I", "-c", "import pickle, sys; pickle.load(sys.stdin.buffer); assert 'beaconry' not in sys.modules"],
        input=cloudpickle.dumps(what), cwd=tmp_path, capture_output=True, timeout=60)
    assert done.returncode == 0, done.stderr.decode()[-500:]
