import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_queries_are_listed_before_there_is_a_session():
    """No module makes a column or a session when it is imported."""
    code = "import __spark_entry__ as E; q, s = E.queries(), E.oracle_sql(); assert len(q) > 80 and set(s) <= set(q); print('listed')"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert "listed" in done.stdout, done.stderr[-500:]


def test_flow_queries_stay_where_a_library_is_missing():
    """Training-data queries that cannot be imported are left out, with the reason logged."""
    code = ("import sys; sys.modules['ahocorasick'] = None\n"
            "import __spark_entry__ as E; q = E.queries(); assert 'clean_validated' in q; print('flow', len(q), any(k.startswith('op') for k in q))")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.stdout.startswith("flow"), done.stderr[-500:]
    assert "False" not in done.stdout or "left out" in done.stderr
