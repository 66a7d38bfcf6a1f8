"""Queries work when the package is importable on the driver only.

The driver may load __spark_entry__ from another working directory; Python
workers then cannot import ``starloom``, so nothing they run may be pickled
by reference to it.
"""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_python_stages_need_no_package_on_workers(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import importlib.util, sys
        sys.path.insert(0, {ROOT!r})
        spec = importlib.util.spec_from_file_location("entry", {ROOT + '/__spark_entry__.py'!r})
        E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .getOrCreate())
        n = E.queries()["parse_port_label"](spark, "/root/testdata/sf0.001").count()
        print("ROWS", n)
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, str(script)], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 200" in res.stdout, res.stderr[-3000:]
