"""The entry module, loaded from another folder: its workers get the package too."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_workers_import_the_package_from_any_folder(tmp_path):
    script = tmp_path / "run.py"
    script.write_text(textwrap.dedent(f"""
        import importlib.util
        spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, '__spark_entry__.py')!r})
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {str(tmp_path / 'shared')!r}).getOrCreate())
        rows = entry.queries()["txn_shape"](spark, "/root/testdata/sf0.001").collect()

        def where(batches):
            import martmetrics.config
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([martmetrics.__file__] * b.num_rows)], names=["f"])

        print("\\nFOUND", spark.range(1).mapInArrow(where, "f string").first().f)
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "FOUND" in out.stdout, out.stderr[-2000:]
    assert ".zip" in out.stdout.split("FOUND")[1]
