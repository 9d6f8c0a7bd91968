"""The entry works without the optional subpackage, and only without all of it."""

import os
import shutil
import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))"


def copied(workdir):
    folder = os.path.join(workdir, "copy")
    shutil.copytree(os.path.join(ROOT, "shelfline"), os.path.join(folder, "shelfline"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), folder)
    return folder


def run(folder):
    return subprocess.run([sys.executable, "-c", COUNT], cwd=folder, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": folder})


def test_without_the_subpackage(workdir):
    folder = copied(workdir)
    shutil.rmtree(os.path.join(folder, "shelfline", "llm"), ignore_errors=True)
    done = run(folder)
    assert done.returncode == 0, done.stderr
    assert done.stdout.split() == ["50", "50"]


def test_a_broken_subpackage_is_an_error(workdir):
    folder = copied(workdir)
    llm = os.path.join(folder, "shelfline", "llm")
    if not os.path.isdir(llm):
        pytest.skip("the subpackage is not there")
    with open(os.path.join(llm, "queries.py"), "a") as f:
        f.write("\nimport shelfline.llm.not_there\n")
    done = run(folder)
    assert done.returncode != 0 and "not_there" in done.stderr
