"""The driver's entry points with and without the optional part."""

import subprocess
import sys

from conftest import ROOT


def count(code: str) -> int:
    got = subprocess.run([sys.executable, "-c", f"{code}\nimport __spark_entry__ as e\n"
                          "assert set(e.oracle_sql()) <= set(e.queries())\nprint(len(e.queries()))"],
                         cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert got.returncode == 0, got.stderr
    return int(got.stdout.split()[-1])


def test_a_missing_package_of_the_optional_part_leaves_the_rest():
    from loadlens.plans.catalog import QUERIES

    for missing in ("public_tokenizers", "loadlens.llm", "corpus_pipeline"):
        code = ("import sys, importlib.abc\n"
                "class Gone(importlib.abc.MetaPathFinder):\n"
                "    def find_spec(self, name, path, target=None):\n"
                f"        if name == {missing!r}: raise ModuleNotFoundError(name, name=name)\n"
                "sys.meta_path.insert(0, Gone())")
        assert count(code) == len(QUERIES)
