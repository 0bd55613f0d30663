"""The entry without the training-data subpackage, or without a library that only it needs."""

import subprocess
import sys

import pytest

from tests.conftest import ROOT

PROGRAM = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f'No module named {{name!r}}', name=name)
sys.meta_path.insert(0, Blocked())
import __spark_entry__ as E
print(len(E.queries()), sum(n.startswith('op') and n[2].isdigit() for n in E.queries()), 'hourly_user_activity' in E.queries())
"""


@pytest.mark.parametrize("name", ["ahocorasick", "public_tokenizers", "tidewater.llm", "corpus_pipeline"])
def test_core_queries_stand_alone(name):
    run = subprocess.run([sys.executable, "-W", "always", "-c", PROGRAM.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    total, numbered, flagship = run.stdout.split()
    assert int(total) >= 49 and numbered == "0" and flagship == "True"
