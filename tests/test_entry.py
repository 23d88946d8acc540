"""The entry file with and without what the training-data operators need."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names(hidden=""):
    code = f"import sys; sys.modules.update({{m: None for m in {hidden.split()!r}}}); import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    return set(out.stdout.split())


def test_other_queries_do_not_need_the_training_data_operators():
    whole = names()
    for hidden in ("ahocorasick", "rolepulse.llm", "rolepulse.llm rolepulse.llm.queries corpus_pipeline"):
        rest = names(hidden)
        assert rest < whole or rest == whole
        assert "role_activity" in rest and not [n for n in rest if n.startswith("op") and n[2].isdigit()]
