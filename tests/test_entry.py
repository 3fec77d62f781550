"""The entry point without the optional parts, or without what they need."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') and n[2].isdigit() for n in q), 'pipeline' in q, set(e.oracle_sql()) <= set(q))"


def shown(folder, code=SHOW):
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    n, ops, pipeline, fits = run.stdout.split()
    return int(n), int(ops), pipeline == "True", fits == "True"


def test_without_a_library():
    """A library that only the optional part needs is hidden: the other queries stay."""
    if not (ROOT / "assayline" / "llm").exists():
        pytest.skip("the optional part is not there")
    whole = shown(ROOT)
    hidden = shown(ROOT, "import sys; sys.modules['zstandard'] = None; " + SHOW)
    assert hidden == (whole[0] - whole[1] - whole[2], 0, False, True) and whole[2]


@pytest.mark.parametrize("gone", ["all", "empty folder", "pipeline"])
def test_without_the_optional_part(tmp_path, gone):
    skip = ["llm", "corpus_pipeline.py"] if gone != "pipeline" else ["corpus_pipeline.py"]
    ignore = shutil.ignore_patterns(*skip, "tests", ".git", "__pycache__")
    shutil.copytree(ROOT, tmp_path / "copy", ignore=ignore)
    if gone == "empty folder":
        (tmp_path / "copy" / "assayline" / "llm").mkdir()
    n, ops, pipeline, fits = shown(tmp_path / "copy")
    assert n >= 100 and not pipeline and fits and (ops > 0) == (gone == "pipeline" and (ROOT / "assayline" / "llm").exists())
