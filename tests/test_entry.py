"""The entry module without the training-data operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAY = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
       "print(len(q), sorted(set(s) - set(q)), sum(n.startswith('op') or n == 'pipeline' for n in q))")


def said(folder, code=SAY):
    out = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, timeout=120,
                         env=os.environ | {"PYTHONPATH": str(folder)})
    assert out.returncode == 0, out.stderr
    return out.stdout.split()


def copy(to, *leave):
    shutil.copytree(os.path.join(ROOT, "tidewater"), to / "tidewater", ignore=shutil.ignore_patterns("__pycache__", *leave))
    for f in ("__spark_entry__.py", "corpus_pipeline.py"):
        if f not in leave and os.path.exists(os.path.join(ROOT, f)):
            shutil.copy(os.path.join(ROOT, f), to / f)


def test_without_the_folder_and_the_pipeline(tmp_path):
    copy(tmp_path, "llm", "corpus_pipeline.py")
    n, unknown, llm = said(tmp_path)
    assert int(n) > 60 and unknown == "[]" and llm == "0"


def test_without_the_folder_alone(tmp_path):
    copy(tmp_path, "llm")
    n, unknown, llm = said(tmp_path)
    assert int(n) > 60 and unknown == "[]" and llm == "0"


def test_where_the_operators_cannot_be_imported(tmp_path):
    copy(tmp_path)
    n, unknown, llm = said(tmp_path, "import sys; sys.modules['tidewater.llm.common'] = None; " + SAY)
    assert int(n) > 60 and unknown == "[]" and llm == "0"
