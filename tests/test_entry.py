import os
import subprocess
import sys

ROOT = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..")

WITHOUT = """
import importlib.abc, sys

class Absent(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["sheafline", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Absent())
import __spark_entry__ as entry
from sheafline.plans.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) == set(entry.oracle_sql()) | {"vector_topk_ann"}
"""


def test_the_rest_stands_without_the_corpus_part():
    subprocess.run([sys.executable, "-c", WITHOUT], cwd=ROOT, check=True, timeout=120)
