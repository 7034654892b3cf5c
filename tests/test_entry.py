"""The driver's entry also works where the training-data subpackage is not there."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_training_data_part():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; "
        "names = set(e.queries()); assert 'label_ratio' in names and 'pipeline' not in names; "
        "assert not any(n.startswith('op') for n in names); assert set(e.oracle_sql()) < names"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
