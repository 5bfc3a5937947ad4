"""The training-data operators are a part that can be taken away."""

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

WITHOUT = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["pledgeflow", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = set(entry.queries())
assert "find_top_success" in names and set(entry.oracle_sql()) <= names
assert not any(n.startswith("op") for n in names) and "pipeline" not in names
"""


def test_entry_works_without_them():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True, timeout=120)


def test_nothing_else_imports_them():
    for file in [*ROOT.glob("pledgeflow/**/*.py"), *ROOT.glob("conformance/*.py"), *ROOT.glob("tests/*.py"), ROOT / "bench.py"]:
        if "llm" not in file.relative_to(ROOT).parts and file.name != "test_layout.py":
            assert not re.search(r"import.*\bllm\b|\bllm\.|corpus_pipeline", file.read_text()), file
