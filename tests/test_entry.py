import json
import os
import subprocess
import sys

import pytest

from ledgerline.plans import registry
from oracle import registry as oracle_registry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("blocked", ["xxhash", "ledgerline.llm", "ledgerline.llm.queries", "public_tokenizers"])
def test_core_queries_stay_without_what_the_others_import(blocked):
    code = f"import sys, json; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "left out" in done.stderr
    queries, sql = json.loads(done.stdout)
    assert queries == sorted(registry.QUERIES) and sql == sorted(oracle_registry.SQL)


def test_pipeline_alone_missing():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert 'pipeline' not in e.queries(); print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) >= len(registry.QUERIES)
