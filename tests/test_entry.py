"""The entry serves the queries that can be imported."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])


def names(blocked: str) -> list[str]:
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, check=True).stdout
    queries, sql = (line.split() for line in out.splitlines())
    assert set(sql) <= set(queries)
    return queries


def test_queries_do_not_need_what_the_training_data_operators_need():
    for blocked in ("xxhash", "public_tokenizers", "rillmart.llm"):
        found = names(blocked)
        assert len(found) >= 75 and "order_detail_wide" in found and not [n for n in found if n.startswith("op") or n == "pipeline"]
    assert "order_detail_wide" in names("corpus_pipeline")
