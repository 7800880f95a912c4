import ast
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_nothing_imports_the_llm_subpackage():
    for path in (ROOT / "vellumix").rglob("*.py"):
        if "llm" in path.relative_to(ROOT / "vellumix").parts:
            continue
        for node in ast.walk(ast.parse(path.read_text())):
            names = [a.name for a in node.names] if isinstance(node, ast.Import) else [node.module or "", *(a.name for a in node.names)] if isinstance(node, ast.ImportFrom) else []
            assert not any("llm" in n.split(".") for n in names), path


def test_queries_are_listed_without_a_session():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and all(callable(f) for f in queries.values()) and len(queries) > 70
